"""SQL functions that the business queries call and Spark lacks."""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "dayofweekiso(t TIMESTAMP_NTZ) RETURNS INT": "weekday(t) + 1",
}


def register_sql_functions(spark: SparkSession) -> None:
    """Define them for this session, as SQL expressions that Spark inlines."""
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
