"""lastro: bank transactions from raw CSV to analytics tables, on Spark.

``sources``    reads and writes: CSV deliveries, catalog tables, staged data
``functions``  column expressions for the cleaning rules
``operators``  DataFrame-level quality checks and cleaning rules
``plans``      the silver table, the gold tables and the whole refresh
``streaming``  incremental ingestion of newly arrived CSV files
"""

__version__ = "0.1.0"
