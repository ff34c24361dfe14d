"""matchforge: match-telemetry analytics as Spark DataFrame jobs.

Sub-packages:
  sources/    readers for landed documents, CSV interchange and tables
  functions/  column expressions (built-in Spark functions only)
  operators/  relational building blocks: filters, joins, aggregates,
              flattening, dimensions, facts, loading, model
  plans/      the query catalogue (Spark side and DuckDB oracle) and plan checks
  streaming/  incremental loads and scoring over file streams
"""

__version__ = "0.1.0"
