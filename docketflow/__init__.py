"""docketflow — incremental, quality-checked star-schema reporting on Spark.

Layers:
  sources/    landing-file writers, stand-in mapping of the test tables, rescue parsing
  functions/  column expressions (business rules, typing)
  operators/  expectations, silver and gold DataFrame -> DataFrame transforms
  plans/      dashboard datasets and analytic questions over gold
  streaming/  bronze/silver Structured Streaming jobs and the pipeline runner
"""

__all__ = ["AS_OF"]

# Reference date for "last week" style questions; never now() so results are reproducible.
AS_OF = "2024-01-17"
