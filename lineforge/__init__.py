"""lineforge: credit-account analytics expressed as Spark DataFrame jobs.

Layout
------
sources/    reference-shaped input tables (fixtures), CSV ingest, union, audit, sinks
functions/  column-expression helpers (numeric coercion, clamps, payment history, dates)
operators/  DataFrame -> DataFrame building blocks (features, segments, risk, credit,
            forecasts, isolation forest, contributions, profiling)
plans/      end-to-end runs and portfolio reports built from the operators
streaming/  Structured Streaming form of the monthly account aggregates
"""

__version__ = "0.1.0"
