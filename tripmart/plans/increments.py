"""Gold month by month: only loaded months that changed are built again, and no key moves.

``load_months`` keeps a fingerprint of every raw month beside the raw layer. ``refresh_gold``
compares them with those of the last build and stages, numbers and writes the changed months alone.

* Date keys come from a stored map (``KeyMap``): an earlier date found later gets the next number.
* Trip ids are the month's offset and the place within the month. The ledger remembers each month's
  offset and how many ids it holds. A month that comes again with no more rows keeps its offset;
  one that outgrows its ids moves behind all others. No other month's ids change.
* The ledger is written last. A refresh that fails before has changed nothing that the next one
  does not write again, with the same keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.key_map import KeyMap
from tripmart.operators.row_id import assign_row_id
from tripmart.plans import gold, silver
from tripmart.session import Kept, folder_names, keep, path_exists, remove_path, small_side
from tripmart.sources.ingest import (
    MONTH_PARTITIONS,
    Month,
    Outcome,
    backfill_months,
    read_raw,
)

MONTH = ("service_type", "load_year", "load_month")
PRINTS_FOLDER = "_prints"
_MONTH_SCHEMA = "service_type string, load_year int, load_month int"
_PRINT_SCHEMA = "n_rows bigint, hash_sum decimal(38,0), hash_xor bigint"
LEDGER_SCHEMA = f"{_MONTH_SCHEMA}, {_PRINT_SCHEMA}, first_id bigint, held bigint, build int"


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


def months_in(months: Iterable[Month], names: Sequence[str]) -> Column:
    """A filter on partition columns: one term a service and year."""
    service, year, month = (F.col(c) for c in names)
    years: dict[tuple[str, int], list[int]] = {}
    for m in months:
        years.setdefault((m.service, m.year), []).append(m.month)
    found = F.lit(False)
    for (s, y), numbers in sorted(years.items()):
        found = found | ((service == s) & (year == y) & month.isin(*numbers))
    return found


def partition_path(folder: str, month: Month, names: Sequence[str]) -> str:
    return "/".join([folder, *[f"{c}={v}" for c, v in zip(names, month, strict=True)]])


# ---------------------------------------------------------------- fingerprints


def month_prints(raw: DataFrame) -> DataFrame:
    """Rows of every month, and two sums of their hashes that no order or file layout changes."""
    data = [F.col(c) for c in sorted(raw.columns) if c.upper() not in MONTH_PARTITIONS]
    # Spark's hash passes over NULLs, so the places of the NULLs are hashed as well.
    nulls = F.array(*[c.isNull() for c in data])
    one, two = F.xxhash64(nulls, *data), F.xxhash64(F.lit(1), nulls, *data)
    return (
        raw.groupBy(*[F.col(c).alias(m) for c, m in zip(MONTH_PARTITIONS, MONTH, strict=True)])
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(one.cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
            F.bit_xor(two).alias("hash_xor"),
        )
    )


def record_prints(spark: SparkSession, target: str, months: Sequence[Month]) -> None:
    """Fingerprint some months of the raw layer; only their files are read."""
    if not months:
        return
    folder = f"{target}/{PRINTS_FOLDER}"
    own = read_raw(spark, target).where(months_in(months, MONTH_PARTITIONS))
    (
        month_prints(own)
        .repartition(*MONTH)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*MONTH)
        .parquet(folder)
    )
    for month in months:
        if not path_exists(spark, partition_path(target, month, MONTH_PARTITIONS)):
            remove_path(spark, partition_path(folder, month, MONTH))


def read_prints(spark: SparkSession, target: str) -> DataFrame:
    folder = f"{target}/{PRINTS_FOLDER}"
    schema = _schema(f"{_PRINT_SCHEMA}, {_MONTH_SCHEMA}")
    if not folder_names(spark, folder):
        return spark.createDataFrame([], schema).select(*MONTH, *_schema(_PRINT_SCHEMA).names)
    return spark.read.schema(schema).parquet(folder).select(*MONTH, *_schema(_PRINT_SCHEMA).names)


def load_months(
    spark: SparkSession, source: str, months: Iterable[Month], target: str, **options
) -> list[Outcome]:
    """``backfill_months``, and the fingerprints of what it loaded."""
    outcomes = backfill_months(spark, source, months, target, **options)
    record_prints(spark, target, [o.month for o in outcomes if o.load_status == "OK"])
    return outcomes


# ---------------------------------------------------------------- ledger


def _builds(spark: SparkSession, folder: str) -> list[int]:
    """Complete builds, in order."""
    names = folder_names(spark, f"{folder}/ledger")
    numbers = sorted(int(n.split("=")[1]) for n in names if n.startswith("build="))
    return [b for b in numbers if path_exists(spark, f"{folder}/ledger/build={b}/_SUCCESS")]


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """One row a month of the fact: its fingerprint, first id less one, ids held, last build."""
    builds = _builds(spark, folder)
    schema = _schema(LEDGER_SCHEMA)
    if not builds:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/ledger/build={builds[-1]}")


def changed_months(prints: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every month of either side, and whether it is new, changed, removed or the same."""
    names = _schema(_PRINT_SCHEMA).names
    now, then = prints.alias("now"), ledger.alias("then")
    same_month = [F.col(f"now.{c}").eqNullSafe(F.col(f"then.{c}")) for c in MONTH]
    equal = F.lit(True)
    for name in names:
        equal = equal & F.col(f"now.{name}").eqNullSafe(F.col(f"then.{name}"))
    change = (
        F.when(F.col("then.n_rows").isNull(), "new")
        .when(F.col("now.n_rows").isNull(), "removed")
        .when(equal, "same")
        .otherwise("changed")
    )
    return now.join(then, same_month, "full").select(
        *[F.coalesce(F.col(f"now.{c}"), F.col(f"then.{c}")).alias(c) for c in MONTH],
        change.alias("change"),
    )


def _next_ledger(
    ledger: DataFrame, prints: DataFrame, counts: DataFrame, gone: Column, build: int
) -> DataFrame:
    """The ledger after a build: rebuilt months keep their ids if those suffice, else get new ones
    behind the last of their service. Windows run over months."""
    top = ledger.groupBy("service_type").agg(F.max(F.col("first_id") + F.col("held")).alias("top"))
    old = ledger.select(*MONTH, F.col("first_id").alias("old_id"), F.col("held").alias("old_held"))
    fits = F.col("n") <= F.coalesce("old_held", F.lit(-1))
    before = Window.partitionBy("service_type").orderBy("load_year", "load_month").rowsBetween(
        Window.unboundedPreceding, -1
    )
    moved = F.coalesce(F.sum(F.when(fits, 0).otherwise(F.col("n"))).over(before), F.lit(0))
    rebuilt = (
        prints.join(counts, list(MONTH), "left")
        .fillna(0, ["n"])
        .join(old, list(MONTH), "left")
        .join(top, "service_type", "left")
        .select(
            *MONTH,
            *_schema(_PRINT_SCHEMA).names,
            F.when(fits, F.col("old_id"))
            .otherwise(F.coalesce("top", F.lit(0)) + moved)
            .cast("bigint")
            .alias("first_id"),
            F.when(fits, F.col("old_held")).otherwise(F.col("n")).cast("bigint").alias("held"),
            F.lit(build).alias("build"),
        )
    )
    return ledger.where(~gone).unionByName(rebuilt)


# ---------------------------------------------------------------- refresh


class Refresh(NamedTuple):
    """What a refresh has done; ``star`` is None if nothing had changed."""

    build: int
    rebuilt: list[Month]
    removed: list[Month]
    star: gold.Star | None = None


def date_keys(spark: SparkSession, folder: str) -> KeyMap:
    return KeyMap(spark, f"{folder}/keys/date", _schema("date_value date"), "date_sk")


def code_members(spark: SparkSession, folder: str) -> KeyMap:
    """Payment types and rate codes met so far; they are their own keys."""
    return KeyMap(spark, f"{folder}/keys/code", _schema("role string, member int"), "code_sk")


def staged_months(
    spark: SparkSession, target: str, months: Sequence[Month], extras: Sequence[str]
) -> DataFrame:
    """Staged trips of some months; only their files are read."""
    raw = read_raw(spark, target).where(months_in(months, MONTH_PARTITIONS))
    staged = [
        silver.stage_trips(raw.where(F.col(MONTH_PARTITIONS[0]) == s), s, extras=extras)
        for s in sorted({m.service for m in months})
    ]
    trips = staged[0]
    for other in staged[1:]:
        trips = trips.unionByName(other)
    return trips


def _star(spark: SparkSession, folder: str, trips: DataFrame, zones: DataFrame, build: int, source: str):
    members = keep(gold.observed_members(trips, source=source), "members").df
    dates = members.where("role = 'date'").select(
        F.date_from_unix_date("member").alias("date_value")
    )
    calendar = keep(gold.calendar(date_keys(spark, folder).grow(dates, build)), "dim_date")
    codes = code_members(spark, folder).grow(members.where("role <> 'date'"), build)
    known = keep(codes.select("role", "member"), "codes")
    return gold.Star(
        dim_date=calendar,
        dim_zone=keep(gold.dim_zone(silver.stage_zones(zones)), "dim_zone"),
        dim_payment_type=Kept(gold.dim_payment_type(known.df), known.rows, known.path),
        dim_ratecode=Kept(gold.dim_ratecode(known.df), known.rows, known.path),
    )


FACT_SORT = (*MONTH, "pickup_date_sk", "pickup_zone_sk", "trip_id")


def refresh_gold(
    spark: SparkSession, target: str, zones: DataFrame, folder: str, source: str = "yellow"
) -> Refresh:
    """Bring the gold layer below ``folder`` up to the raw layer at ``target``.

    The fact is partitioned by service and load month. Which months changed, one row each, is all
    that reaches the driver.
    """
    ledger, prints = read_ledger(spark, folder), read_prints(spark, target)
    moved = changed_months(prints, ledger).where("change <> 'same'").collect()
    rebuilt = sorted(Month(*r[:3]) for r in moved if r["change"] != "removed")
    removed = sorted(Month(*r[:3]) for r in moved if r["change"] == "removed")
    builds = _builds(spark, folder)
    if not moved:
        return Refresh(builds[-1] if builds else 0, [], [])
    build = builds[-1] + 1 if builds else 1
    fact_path = f"{folder}/fct_trips"
    star, counts = None, spark.createDataFrame([], _schema(f"{_MONTH_SCHEMA}, n bigint"))
    numbered = None
    if rebuilt:
        extras = (silver.VENDOR, silver.DURATION, *silver.MINUTES)
        trips = staged_months(spark, target, rebuilt, extras)
        star = _star(spark, folder, trips, zones, build, source)
        implied = {*MONTH, "load_service_type", "pickup_date", "dropoff_date", silver.DURATION}
        order = [c for c in trips.columns if c not in {*implied, *silver.MINUTES}]
        # The numbering is written once, by its own step; here it is only read again.
        numbered = assign_row_id(trips, "place", order, within=MONTH)
        places = numbered.groupBy(*MONTH).agg(F.max("place").alias("n"))
        counts = keep(places, "month-counts").df
    next_ledger = keep(
        _next_ledger(
            ledger,
            prints.where(months_in(rebuilt, MONTH)),
            counts,
            months_in([*rebuilt, *removed], MONTH),
            build,
        ),
        "ledger",
    )
    if rebuilt:
        offsets = next_ledger._replace(df=next_ledger.df.select(*MONTH, "first_id"))
        placed = numbered.join(small_side(offsets), list(MONTH)).withColumn(
            "trip_id", F.col("first_id") + F.col("place")
        )
        measures = (*gold.FACT_MEASURES, "load_year", "load_month")
        fact = gold.fct_trips(placed, star, measures=measures)
        (
            fact.repartitionByRange(*FACT_SORT)
            .sortWithinPartitions(*FACT_SORT)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*MONTH)
            .parquet(fact_path)
        )
        filled = {Month(*r) for r in counts.select(*MONTH).collect()}  # one row a month
        removed_files = [*removed, *[m for m in rebuilt if m not in filled]]
    else:
        removed_files = removed
    for month in removed_files:
        remove_path(spark, partition_path(fact_path, month, MONTH))
    next_ledger.df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/ledger/build={build}")
    return Refresh(build, rebuilt, removed, star)


def read_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact that ``refresh_gold`` maintains; filters on service and load month prune files."""
    return spark.read.option("basePath", f"{folder}/fct_trips").parquet(f"{folder}/fct_trips")


def read_star(spark: SparkSession, folder: str, zones: DataFrame) -> gold.Star:
    """The dimensions as of the last refresh."""
    known = keep(code_members(spark, folder).read().select("role", "member"), "codes")
    return gold.Star(
        dim_date=keep(gold.calendar(date_keys(spark, folder).read()), "dim_date"),
        dim_zone=keep(gold.dim_zone(silver.stage_zones(zones)), "dim_zone"),
        dim_payment_type=Kept(gold.dim_payment_type(known.df), known.rows, known.path),
        dim_ratecode=Kept(gold.dim_ratecode(known.df), known.rows, known.path),
    )
