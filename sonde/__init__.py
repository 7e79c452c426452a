"""Profiling, cleaning, preparation and classification of labelled sensor series on Spark.

Every operator takes and returns DataFrames.  The sub-packages are ``sources`` (scans and
sinks), ``functions`` (column expressions), ``operators`` (one table operation each),
``plans`` (whole chains of operators) and ``catalog`` (named queries with their SQL twins).
"""
