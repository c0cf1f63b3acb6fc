"""Dimension tables: zones, weather variables, levels and models. Long variable lists are read from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import RequestError

# Bidding zones with unit data: code, name, country, first year, last year if over.
ZONES = """
10Y1001A1001A016|NIE / SEM(SONI)|Northern Ireland / SEM(SONI)|2015|2025
10Y1001A1001A39I|EE|Estonia|2015|
10Y1001A1001A796|DK|Denmark|2015|
10Y1001A1001A990|MD|Moldova|2020|
10Y1001A1001B012|GE|Georgia|2021|
10Y1001C--00100H|XK|Kosovo|2021|
10YAL-KESH-----5|AL|Albania|2024|
10YAT-APG------L|AT|Austria|2015|
10YBA-JPCC-----D|BA|Bosnia and Herzegovina|2017|
10YBE----------2|BE|Belgium|2015|
10YCA-BULGARIA-R|BG|Bulgaria|2015|
10YCH-SWISSGRIDZ|CH|Switzerland|2015|
10YCS-CG-TSO---S|ME|Montenegro|2015|
10YCS-SERBIATSOV|RS|Serbia|2022|2025
10YCZ-CEPS-----N|CZ|Czech Republic|2015|
10YDE-ENBW-----N|DE(TransnetBW)|Germany (TransnetBW)|2015|
10YDE-EON------1|DE(TenneT GER)|Germany (TenneT)|2015|
10YDE-RWENET---I|DE(Amprion)|Germany (Amprion)|2015|
10YDE-VE-------2|DE(50Hertz) / DE(50HzT)|Germany (50Hertz)|2015|
10YES-REE------0|ES|Spain|2014|
10YFI-1--------U|FI|Finland|2015|
10YFR-RTE------C|FR|France|2014|
10YGB----------A|GB / National Grid|Great Britain / National Grid|2015|2021
10YGR-HTSO-----Y|GR|Greece|2015|
10YHU-MAVIR----U|HU|Hungary|2015|
10YIE-1001A00010|IE / SEM(EirGrid)|Ireland / SEM(EirGrid)|2015|
10YIT-GRTN-----B|IT|Italy|2015|
10YLT-1001A0008Q|LT|Lithuania|2015|
10YLV-1001A00074|LV|Latvia|2015|
10YMK-MEPSO----8|MK|North Macedonia|2018|
10YNL----------L|NL|Netherlands|2015|
10YNO-0--------C|NO|Norway|2020|
10YPL-AREA-----S|PL|Poland|2015|
10YPT-REN------W|PT|Portugal|2014|
10YRO-TEL------P|RO|Romania|2015|
10YSE-1--------K|SE|Sweden|2014|
10YSI-ELES-----O|SI|Slovenia|2015|
10YSK-SEPS-----K|SK|Slovakia|2015|
"""

# Variables of the icosahedral reanalysis: name, code, level type.
ICON = """
2m_temperature T_2M single
10m_u_component_of_wind U_10M single
10m_v_component_of_wind V_10M single
2m_dewpoint_temperature TD_2M single
total_precipitation TOT_PREC single
surface_pressure PS single
mean_sea_level_pressure PMSL single
total_cloud_cover CLCT single
surface_solar_direct_radiation_downwards ASWDIR_S single
surface_solar_diffuse_radiation_downwards ASWDIFD_S single
surface_specific_humidity QV_S single
2m_maximum_temperature TMAX_2M single
2m_minimum_temperature TMIN_2M single
10m_maximum_wind_speed VMAX_10M single
10m_wind_speed WS_10M single
surface_roughness_length Z0 single
evapotranspiration EVAPT single
temperature T model
u_component_of_wind U model
v_component_of_wind V model
pressure P model
specific_humidity QV model
turbulent_kinetic_energy TKE model
wind_speed WS model
density_moist_air DEN model
"""

# Variables of the Australian reanalysis: name, code, level type, models that have it.
BARRA = """
1.5m_temperature tas single R2 C2 C2_20min
1.5m_temperature_mean tasmean single R2 C2
1.5m_maximum_temperature tasmax single R2 C2
1.5m_minimum_temperature tasmin single R2 C2
surface_temperature ts single R2 C2 C2_20min
surface_temperature_mean tsmean single C2
50m_temperature ta50m single R2 C2 C2_20min
100m_temperature ta100m single R2 C2 C2_20min
150m_temperature ta150m single R2 C2 C2_20min
200m_temperature ta200m single R2 C2 C2_20min
250m_temperature ta250m single R2 C2 C2_20min
1500m_temperature ta1500m single R2 C2 C2_20min
10m_u_component_of_wind uas single R2 C2 C2_20min
10m_u_component_of_wind_mean uasmean single R2 C2
10m_u_component_of_wind_maximum uasmax single R2
50m_u_component_of_wind ua50m single R2 C2 C2_20min
100m_u_component_of_wind ua100m single R2 C2 C2_20min
150m_u_component_of_wind ua150m single R2 C2 C2_20min
200m_u_component_of_wind ua200m single R2 C2 C2_20min
250m_u_component_of_wind ua250m single R2 C2 C2_20min
1500m_u_component_of_wind ua1500m single R2 C2 C2_20min
10m_v_component_of_wind vas single R2 C2 C2_20min
10m_v_component_of_wind_mean vasmean single R2 C2
10m_v_component_of_wind_maximum vasmax single R2
50m_v_component_of_wind va50m single R2 C2 C2_20min
100m_v_component_of_wind va100m single R2 C2 C2_20min
150m_v_component_of_wind va150m single R2 C2 C2_20min
200m_v_component_of_wind va200m single R2 C2 C2_20min
250m_v_component_of_wind va250m single R2 C2 C2_20min
1500m_v_component_of_wind va1500m single R2 C2 C2_20min
10m_wind_speed sfcWind single R2 C2
10m_maximum_wind_speed sfcWindmax single R2 C2
wind_gust_speed wsgs single C2
maximum_wind_gust_speed wsgsmax single R2 C2 C2_20min
surface_pressure ps single R2 C2
mean_sea_level_pressure psl single R2 C2 C2_20min
total_precipitation pr single R2 C2
convective_precipitation prc single R2
graupel_sediment_rate prga single C2
large_scale_rainfall_rate prra single C2
maximum_hourly_precipitation prmax single R2 C2
snowfall prsn single R2 C2 C2_20min
maximum_hourly_snowfall prsnmax single C2
precipitable_water prw single R2 C2
1.5m_relative_humidity hurs single R2 C2
1.5m_specific_humidity huss single R2 C2
surface_solar_radiation_downwards rsds single R2 C2
surface_solar_radiation_upwards rsus single R2 C2
surface_solar_radiation_downwards_clear_sky rsdscs single R2 C2
surface_solar_radiation_upwards_clear_sky rsuscs single R2 C2
surface_direct_solar_radiation_downwards rsdsdir single R2 C2 C2_20min
surface_diffuse_solar_radiation_downwards rsdsdif single C2_20min
surface_net_shortwave_radiation rss single C2_20min
toa_incoming_shortwave_radiation rsdt single R2 C2
toa_outgoing_shortwave_radiation rsut single R2 C2
toa_outgoing_shortwave_radiation_clear_sky rsutcs single R2 C2
surface_thermal_radiation_downwards rlds single R2 C2
surface_thermal_radiation_upwards rlus single R2 C2
surface_thermal_radiation_downwards_clear_sky rldscs single R2 C2
surface_thermal_radiation_upwards_clear_sky rluscs single R2 C2
toa_outgoing_longwave_radiation rlut single R2 C2
toa_outgoing_longwave_radiation_clear_sky rlutcs single R2 C2
surface_latent_heat_flux hfls single R2 C2
surface_sensible_heat_flux hfss single R2 C2
evaporation evspsbl single R2 C2
potential_evaporation evspsblpot single R2 C2
total_cloud_cover clt single R2 C2
high_cloud_cover clh single R2 C2
medium_cloud_cover clm single R2 C2
low_cloud_cover cll single R2 C2
condensed_water_path clwvi single R2 C2
ice_water_path clivi single R2 C2
surface_soil_moisture_flux mrfsos single R2 C2
upper_soil_layer_moisture mrsos single R2 C2
total_runoff mrro single C2
surface_runoff mrros single C2
column_total_dry_mass coltotdrym single C2
column_total_wet_mass coltotwetm single C2
lightning_flash_rate flashrate single C2
fog_fraction fogfraction single C2
visibility visibility single C2
maximum_column_reflectivity maxcolrefl single C2
maximum_column_vertical_velocity maxcolwa single C2
radar_reflectivity_at_1km radrefl1km single C2_20min
updraft_helicity_maximum helicitymax single C2
updraft_helicity_minimum helicitymin single C2
boundary_layer_height zmla single R2 C2
tropopause_height ztp single C2
convective_available_potential_energy CAPE single R2 C2
convective_inhibition CIN single R2 C2
downdraft_cape DCAPE single C2
effective_bulk_wind_difference EBWD single C2
bulk_wind_difference_0_3km BWD03 single C2
bulk_wind_difference_0_6km BWD06 single C2
effective_inflow_layer_base EILbase single C2
effective_inflow_layer_depth EILdepth single C2
storm_relative_helicity_0_1km_left SRH01l single C2
storm_relative_helicity_0_1km_right SRH01r single C2
storm_relative_helicity_0_3km_left SRH03l single C2
storm_relative_helicity_0_3km_right SRH03r single C2
effective_storm_relative_helicity_left ESRHl single C2
effective_storm_relative_helicity_right ESRHr single C2
mixed_layer_cape MLCAPE single C2
mixed_layer_cin MLCIN single C2
most_unstable_cape MUCAPE single C2
most_unstable_cin MUCIN single C2
equilibrium_level_height MUEL single C2
most_unstable_lifting_parcel_level MULPL single C2
most_unstable_lifting_parcel_temperature MULPLtemp single C2
most_unstable_lifting_parcel_pressure MULPLpres single C2
most_unstable_lifting_parcel_mixing_ratio MULPLmixr single C2
lifting_condensation_level MLLCL single C2
freezing_level_height FZL single C2
lapse_rate_0_3km LR03 single C2
lapse_rate_700_500hPa LR75 single C2
isobaric_wet_bulb_temperature twiso single R2 C2
pseudo_wet_bulb_temperature twpse single R2 C2
vertical_velocity_500hpa omega500 single R2
temperature ta pressure R2 C2
u_component_of_wind ua pressure R2 C2
v_component_of_wind va pressure R2 C2
specific_humidity hus pressure R2 C2
vertical_velocity wa pressure R2 C2
geopotential_height zg pressure R2 C2
vertical_velocity_in_pressure wap pressure C2
orography orog invariant R2 C2 C2_20min
land_sea_mask sftlf invariant R2 C2 C2_20min
"""

# What is taken if no variables are named, for each reanalysis.
DEFAULTS = {
    "barra": """
1.5m_temperature 1.5m_temperature_mean 1.5m_maximum_temperature 1.5m_minimum_temperature 50m_temperature 100m_temperature 150m_temperature
200m_temperature 250m_temperature 1500m_temperature surface_pressure mean_sea_level_pressure 1.5m_specific_humidity 10m_u_component_of_wind
10m_u_component_of_wind_mean 10m_u_component_of_wind_maximum 50m_u_component_of_wind 100m_u_component_of_wind 150m_u_component_of_wind
200m_u_component_of_wind 250m_u_component_of_wind 1500m_u_component_of_wind 10m_v_component_of_wind 10m_v_component_of_wind_mean
10m_v_component_of_wind_maximum 50m_v_component_of_wind 100m_v_component_of_wind 150m_v_component_of_wind 200m_v_component_of_wind
250m_v_component_of_wind 1500m_v_component_of_wind 10m_wind_speed 10m_maximum_wind_speed total_precipitation evaporation
surface_solar_radiation_downwards total_cloud_cover temperature u_component_of_wind v_component_of_wind specific_humidity geopotential_height
""".split(),
    "icon": """
2m_temperature 2m_maximum_temperature 2m_minimum_temperature 2m_dewpoint_temperature surface_pressure mean_sea_level_pressure surface_specific_humidity
10m_u_component_of_wind 10m_v_component_of_wind 10m_maximum_wind_speed 10m_wind_speed surface_roughness_length total_precipitation evapotranspiration
total_cloud_cover surface_solar_direct_radiation_downwards surface_solar_diffuse_radiation_downwards temperature pressure specific_humidity
u_component_of_wind v_component_of_wind wind_speed density_moist_air turbulent_kinetic_energy
""".split(),
    "era5": """
2m_temperature maximum_2m_temperature_since_previous_post_processing minimum_2m_temperature_since_previous_post_processing 2m_dewpoint_temperature
surface_pressure mean_sea_level_pressure 10m_u_component_of_wind 10m_v_component_of_wind 100m_u_component_of_wind 100m_v_component_of_wind
10m_wind_gust_since_previous_post_processing total_precipitation evaporation total_cloud_cover surface_solar_radiation_downwards temperature
specific_humidity u_component_of_wind v_component_of_wind vertical_velocity geopotential
""".split(),
}

# Variables of the global reanalysis: name, code, level types that have it. The default ones, the invariant
# ones and all of the upper air; the other single-level ones, some two hundred and fifty, come from a file (variables_from_csv).
ERA5 = """
2m_temperature 2t single
maximum_2m_temperature_since_previous_post_processing mx2t single
minimum_2m_temperature_since_previous_post_processing mn2t single
2m_dewpoint_temperature 2d single
surface_pressure sp single
mean_sea_level_pressure msl single
10m_u_component_of_wind 10u single
10m_v_component_of_wind 10v single
100m_u_component_of_wind 100u single
100m_v_component_of_wind 100v single
10m_wind_gust_since_previous_post_processing 10fg single
total_precipitation tp single
evaporation e single
total_cloud_cover tcc single
surface_solar_radiation_downwards ssrd single
lake_cover cl invariant
lake_depth dl invariant
low_vegetation_cover cvl invariant
high_vegetation_cover cvh invariant
type_of_low_vegetation tvl invariant
type_of_high_vegetation tvh invariant
soil_type slt invariant
standard_deviation_of_filtered_subgrid_orography sdfor invariant
standard_deviation_of_orography sdor invariant
anisotropy_of_sub_gridscale_orography isor invariant
angle_of_sub_gridscale_orography anor invariant
slope_of_sub_gridscale_orography slor invariant
land_sea_mask lsm invariant
potential_vorticity pv pressure
relative_humidity r pressure
geopotential z invariant pressure model
specific_rain_water_content crwc pressure model
specific_snow_water_content cswc pressure model
temperature t pressure model
u_component_of_wind u pressure model
v_component_of_wind v pressure model
specific_humidity q pressure model
vertical_velocity w pressure model
vorticity vo pressure model
divergence d pressure model
ozone_mass_mixing_ratio o3 pressure model
specific_cloud_liquid_water_content clwc pressure model
specific_cloud_ice_water_content ciwc pressure model
fraction_of_cloud_cover cc pressure model
eta-coordinate_vertical_velocity etadot model
logarithm_of_surface_pressure lnsp model
"""

# Pressure levels of the Australian reanalysis with the models that have them, and the defaults.
BARRA_LEVELS = """
200 R2 C2
300 R2 C2
400 R2 C2
500 R2 C2
600 R2 C2
700 R2 C2
750 C2
800 C2
850 R2 C2
900 C2
925 R2 C2
950 R2 C2
975 C2
1000 R2 C2
"""
BARRA_DEFAULT_LEVELS = {"R2": [1000, 950], "C2": [1000, 975, 950], "C2_20min": []}
BARRA_PRESSURE = {"ta": "R2 C2", "ua": "R2 C2", "va": "R2 C2", "hus": "R2 C2", "wa": "R2 C2", "zg": "R2 C2", "wap": "C2"}
BARRA_INVARIANT = ["orog", "sftlf"]
BARRA_MODELS = {"R2": ("AUS-11", "BARRA-R2", "1hr", 1979), "C2": ("AUST-04", "BARRA-C2", "1hr", 1979), "C2_20min": ("AUST-04", "BARRA-C2", "20min", 1979)}

# Pressure levels of the global reanalysis, and default levels.
ERA5_PRESSURE_LEVELS = "1 2 3 5 7 10 20 30 50 70 100 125 150 175 200 225 250 300 350 400 450 500 550 600 650 700 750 775 800 825 850 875 900 925 950 975 1000".split()
ERA5_DEFAULT_PRESSURE, ERA5_DEFAULT_MODEL = ["1000", "975", "950"], ["133", "134", "135", "136", "137"]
#: Model levels count from the top, 137 is next to the ground.
ERA5_MODEL_LEVELS = [str(i) for i in range(1, 138)]


def zones(spark: SparkSession) -> DataFrame:
    rows = [x.split("|") for x in ZONES.strip().splitlines()]
    return spark.createDataFrame([(c, n, m, int(a), int(b) if b else None) for c, n, m, a, b in rows], "zone string, name string, alias string, start int, `end` int")


def icon_variables(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(x.split()) for x in ICON.strip().splitlines()], "variable string, code string, level_type string")


def era5_variables(spark: SparkSession) -> DataFrame:
    """A row for each level type that has a variable."""
    rows = [x.split() for x in ERA5.strip().splitlines()]
    return spark.createDataFrame([(n, c, kind) for n, c, *kinds in rows for kind in kinds], "variable string, code string, level_type string")


def barra_variables(spark: SparkSession) -> DataFrame:
    rows = [x.split() for x in BARRA.strip().splitlines()]
    return spark.createDataFrame([(n, c, kind, models) for n, c, kind, *models in rows], "variable string, code string, level_type string, models array<string>")


def variables(spark: SparkSession, source: str) -> DataFrame:
    """The catalogue of a reanalysis as it is listed: ``variable, code, level_type, is_default``."""
    known = {"era5": era5_variables, "barra": barra_variables, "icon": icon_variables}
    if source not in known:
        raise RequestError(f"no variables of {source}")
    rows = known[source](spark).select("variable", "code", "level_type")
    return rows.withColumn("is_default", F.col("variable").isin(DEFAULTS[source])).orderBy("level_type", "variable")


def barra_levels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(int(x.split()[0]), x.split()[1:]) for x in BARRA_LEVELS.strip().splitlines()], "level int, models array<string>")


def variables_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue file with ``variable, code, level_type, models`` (models separated by blanks), such as long lists."""
    df = spark.read.csv(path, header=True, schema="variable string, code string, level_type string, models string")
    return df.withColumn("models", F.split(F.coalesce("models", F.lit("")), " "))


def for_model(df: DataFrame, model: str) -> DataFrame:
    return df.filter(F.array_contains("models", model))


def validate(names: list[str], known: DataFrame, column: str, what: str) -> list[str]:
    """Fails, naming them, if some are unknown; the catalogue is joined where it is."""
    spark = known.sparkSession
    wanted = spark.createDataFrame([(n,) for n in names], f"{column} string")
    bad = wanted.join(known.select(F.col(column).cast("string").alias(column)), column, "left_anti").orderBy(column).limit(20).collect()
    if bad:
        raise RequestError(f"unknown {what}: {[r[0] for r in bad]}")
    return names


def listing(df: DataFrame, *order: str) -> DataFrame:
    return df.orderBy(*order)
