"""Incremental backfill: load the months whose files are new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripmart.sources.ingest import (
    MONTH_FILE,
    backfill_months,
    failed_months,
    log_coverage,
    named_months,
)

# Fixed value: columns of Spark's binary-file source.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_backfill(
    spark: SparkSession,
    source: str,
    target: str,
    log: str,
    checkpoint: str,
    glob: str = "*",
    schema: T.StructType | None = None,
    template: str = MONTH_FILE,
) -> StreamingQuery:
    """Load every month with files not seen before, then stop (``availableNow``).

    The stream only detects files: one row for each, empty ones too, and no content is read. A
    touched month is reloaded whole, so a month that arrives in pieces, or a batch that is run
    again after a failure, leaves no gaps or duplicates. Months whose last load failed are tried
    again first, as the stream has seen their files.
    """

    def load(months: list) -> None:
        outcomes = backfill_months(spark, source, months, target, schema, template=template)
        log_coverage(spark, outcomes, log)

    failed = failed_months(spark, log)
    if failed:
        load(failed)
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .load(f"{source}/{glob}")
        .select("path")
    )

    def batch(found: DataFrame, _: int) -> None:
        load(named_months(found))

    return (
        files.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
