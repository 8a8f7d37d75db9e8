"""cropcredit: credit-risk analytics for loan portfolios as Spark DataFrame jobs.

Layers:
  sources/    raw delimited ingestion, silver/gold parquet IO, run records, driver-table roles
  functions/  Column-level helpers (cleaning, month deltas, crop year)
  operators/  DataFrame -> DataFrame jobs (labels, features, consolidation, business
              aggregates, metrics, preprocessing, models, validation)
  plans/      end-to-end pipelines wiring the operators together
  streaming/  incremental (file-arrival) ingestion of bronze files
"""

__version__ = "0.1.0"
