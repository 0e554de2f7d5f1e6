"""Airline on-time performance analytics on PySpark.

``sources`` read and write tables, ``functions`` are column expressions,
``operators`` map DataFrames to DataFrames without running a job, and ``plans``
put operators together into whole jobs.
"""
