"""Device-telemetry analytics as Spark DataFrame functions.

Raw JSON messages go in, typed history tables, hot serving views, dead letters
and the usual questions about them come out. Every step is a function from
DataFrame to DataFrame, so batch jobs, streaming jobs and tests share one code path.
"""
