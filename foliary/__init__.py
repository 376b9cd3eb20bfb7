"""foliary: document analytics on Spark DataFrames.

Sub-packages: ``functions`` (column expressions), ``operators`` (DataFrame to
DataFrame), ``sources`` (readers and sinks), ``plans`` (assembled queries) and
``streaming`` (incremental forms).
"""
