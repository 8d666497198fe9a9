"""Trip rows by stream: repeated rows go, as far back as the watermark reaches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# Settings of a stream's state; with the last one, all states of an executor share 500 MB of memory.
_STORE = "spark.sql.streaming.stateStore"
STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
}


def stream_files(
    spark: SparkSession, source: str, schema: T.StructType, files_per_batch: int = 1000
) -> DataFrame:
    """Rows of the Parquet files that arrive in a folder, the oldest files first."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source)


def first_rows(trips: DataFrame, key: Sequence[str], at: str, delay: str) -> DataFrame:
    """The first row of each key to arrive; later ones within ``delay`` of event time go.

    ``at`` is the event time, a zoned timestamp. A row older than the greatest time seen in earlier
    batches less ``delay`` comes too late and goes as well. The state holds the keys of that span
    and no others. A NULL is a value of the key like any other.
    """
    return trips.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(key))


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started in here keep their state in RocksDB, which needs no heap for each key.

    A batch's changes are logged; whole states are written beside the batches. A stream that
    began otherwise goes on as it began.
    """
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def write_first_rows(
    rows: DataFrame, target: str, checkpoint: str
) -> StreamingQuery:
    """Append the rows to a Parquet folder until all files found at the start are read."""
    with _state_on_disk(rows.sparkSession):
        return (
            rows.writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
