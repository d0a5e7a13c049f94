"""Feed validation and reconciliation as Spark jobs.

Sub-packages: ``functions`` (column expressions), ``sources`` (scans, listings,
sinks), ``operators`` (DataFrame to DataFrame steps), ``plans`` (whole feeds end
to end and the query catalogue) and ``streaming`` (the same work on a stream).
"""
