"""lendlake — lending-portfolio analytics as Spark DataFrame jobs.

Sub-packages:
  sources    fixture projection, typed staging, sinks
  functions  column expressions
  operators  marts, ranking, quality checks, profiling, features, metrics,
             models, scoring
  plans      query catalogue and the SQL twins used as the correctness oracle
  streaming  incremental scoring of arriving loan ids
"""

__version__ = "0.1.0"
