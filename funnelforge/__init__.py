"""funnelforge: funnel, experiment and activation analytics as Spark DataFrame plans.

Modules:
  sources    raw tables (CSV / Parquet / catalog), fixture adapters, synthetic generator
  operators  staging, funnel marts, experiment statistics, segments, timing, quality,
             features, ranking metrics, MLlib models
  functions  Column building blocks (normal CDF, md5 draws, week and minute arithmetic)
  plans      exact running totals, the query registry, warehouse build, report orderings
  streaming  per-user funnel flags maintained with Structured Streaming
"""

__version__ = "0.1.0"
