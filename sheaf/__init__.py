"""sheaf: DataFrame operators that turn semi-structured entity records into a
modelling table and score it, written for Spark's execution model.

Layout
    sources/    declared schemas, JSON-lines reader, parquet tables, fixtures
    functions/  column expressions (ANSI-safe casts, dates, strings, arithmetic)
    operators/  DataFrame -> DataFrame operators (rollups, profiling, encoders, ...)
    plans/      end-to-end plans (the feature table), the query catalog
    streaming/  the activity rollups over a file stream
"""

__version__ = "0.1.0"
