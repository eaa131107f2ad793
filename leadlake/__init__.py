"""leadlake: CRM and campaign-messaging dumps -> analytics tables, on Spark.

Layout
------
functions/  Column -> Column business expressions, declared JSON schemas, event mappings
operators/  DataFrame -> DataFrame building blocks (guards, flatten, joins, funnel, pivot)
sources/    parquet / catalog / JDBC readers and full-refresh sinks
plans/      the seven jobs composed from the blocks, plus the catalogue run on the test tables
"""

__version__ = "0.1.0"
