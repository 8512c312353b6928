"""strata: metadata-driven bronze -> silver -> gold pipelines on Spark.

Sub-packages:

* ``sources``   -- versioned parquet tables and source extracts
* ``functions`` -- column expressions (mark text, record hash, option parsing)
* ``operators`` -- DataFrame -> DataFrame steps (bronze, SCD2, scope, merge,
  quality, serving, pages)
* ``plans``     -- control tables, source runs, replays, the query catalogue
* ``streaming`` -- micro-batch landing through Structured Streaming
* ``jobs``      -- spark-submit entry points
"""

__version__ = "0.1.0"
