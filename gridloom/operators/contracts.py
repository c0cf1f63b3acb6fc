"""Column contracts, checked on schemas before any job runs, and checks that need one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import ContractError, IncompleteError, NoDataError


def require(df: DataFrame, columns: list[str], what: str = "table") -> DataFrame:
    """Fails if a column is missing; others stay."""
    if lacking := [c for c in columns if c not in df.columns]:
        raise ContractError(f"{what} lacks {lacking}")
    return df


def project(df: DataFrame, columns: list[str], what: str = "table") -> DataFrame:
    """Just these columns, in this order."""
    return require(df, columns, what).select(*[f"`{c}`" for c in columns])


def require_keys(df: DataFrame, column: str, keys: list[str], what: str = "document") -> DataFrame:
    """Rows whose map lacks a key fail when they are read."""
    lacking = F.array_except(F.array(*[F.lit(k) for k in keys]), F.map_keys(column))
    return df.withColumn(column, F.when(F.size(lacking) > 0, F.raise_error(F.concat(F.lit(f"{what} lacks "), F.array_join(lacking, ", ")))).otherwise(F.col(column)))


def arity_differs(column: str, n: int) -> Column:
    return F.coalesce(F.size(column) != n, F.lit(True))


def require_rows(df: DataFrame, what: str = "task") -> DataFrame:
    if df.isEmpty():
        raise NoDataError(f"no rows for {what}")
    return df


def require_total(df: DataFrame, total: int) -> DataFrame:
    """Fails unless as many rows are there as were advertised."""
    if (n := df.count()) != total:
        raise IncompleteError(f"{n} rows of {total}")
    return df


def drop_null(df: DataFrame, *columns: str) -> DataFrame:
    """Drops rows in which any of the columns is null."""
    return df.na.drop("any", subset=list(columns))


def drop_all_null(df: DataFrame, *columns: str) -> DataFrame:
    """Drops rows in which all of the columns are null."""
    return df.na.drop("all", subset=list(columns))


def counted_drop_null(df: DataFrame, column: str, name: str) -> DataFrame:
    """Drops rows with a null column; an Observation of this name learns how many in the job that reads the result."""
    from pyspark.sql import Observation

    seen = df.observe(Observation(name), F.count("*").alias("rows"), F.count_if(F.col(column).isNull()).alias("dropped"))
    return seen.filter(F.col(column).isNotNull())
