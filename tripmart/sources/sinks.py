"""Ways to write a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tripmart.operators.conform import align_to_schema, keep_known_columns
from tripmart.session import open_files

# Fixed value: rows per written chunk.
CHUNK_ROWS = 100_000


def table_columns(spark: SparkSession, table: str) -> list[str]:
    """Upper-case column names of a table; none if there is no such table."""
    if not spark.catalog.tableExists(table):
        return []
    return [c.upper() for c in spark.table(table).columns]


def append_table(df: DataFrame, table: str) -> None:
    """Append, creating the table if it is missing."""
    df.write.mode("append").saveAsTable(table)


def append_existing(df: DataFrame, table: str) -> None:
    """Append to a table that must exist: its columns only, absent ones as NULL."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    target = spark.table(table).schema
    align_to_schema(keep_known_columns(df, target.names), target).write.insertInto(table)


def replace_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def write_chunked(
    df: DataFrame, path: str, rows: int = CHUNK_ROWS, partition_by: Sequence[str] = ()
) -> None:
    """Replace a dataset by files of at most ``rows`` rows, written in parallel without a sort."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows)
    with open_files(df.sparkSession):
        writer.partitionBy(*partition_by).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def publish(tables: Mapping[str, DataFrame], database: str, path: str) -> None:
    """Write each frame as a table of ``database``, stored below ``path``.

    Afterwards ``spark.sql`` can query them by name.
    """
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{path}'")
    for name, df in tables.items():
        df.write.mode("overwrite").option("path", f"{path}/{name}").saveAsTable(
            f"{database}.{name}"
        )


def publish_views(spark: SparkSession, database: str, views: Mapping[str, str]) -> None:
    """Define views of ``database`` by SQL text, in this order; ``{db}`` in it names the database.

    Nothing is computed: a query through a view is planned together with it.
    """
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text.format(db=database)}")
