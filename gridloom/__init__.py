"""Electricity-generation time series on Spark: plans, contracts, reshaping, quality checks, sources and sinks."""
