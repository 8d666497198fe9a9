"""The checks declared on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators import quality, row_checks
from tripmart.plans.gold import PAYMENT_LABELS, RATECODE_LABELS, Star, dim_vendor


def range_violation() -> Column:
    """Implausible trips: duration outside 1-180 minutes, no distance, or a negative total."""
    return (
        ~F.col("trip_duration_min").between(1, 180)
        | (F.col("trip_distance") <= 0)
        | (F.col("total_amount") < 0)
    )


FACT_NOT_NULL = ("trip_id", "pickup_date_sk", "passenger_count")


def _keyed(star: Star) -> dict[str, tuple[DataFrame, str]]:
    return {
        "dim_date": (star.dim_date.df, "date_sk"),
        "dim_zone": (star.dim_zone.df, "zone_sk"),
        "dim_payment_type": (star.dim_payment_type.df, "payment_type_sk"),
        "dim_ratecode": (star.dim_ratecode.df, "ratecode_sk"),
    }


def _parents(star: Star) -> dict[str, tuple[DataFrame, str]]:
    keyed = _keyed(star)
    return {
        "pickup_date_sk": keyed["dim_date"],
        "dropoff_date_sk": keyed["dim_date"],
        "pickup_zone_sk": keyed["dim_zone"],
        "dropoff_zone_sk": keyed["dim_zone"],
        "payment_type_sk": keyed["dim_payment_type"],
        "ratecode_sk": keyed["dim_ratecode"],
    }


def declared_checks(fact: DataFrame, star: Star) -> DataFrame:
    """Seven not-null, six unique and six relationship checks, one result row each.

    Meant for the written tables: each kind of check scans the fact once.
    """
    keyed = _keyed(star)
    vendors = dim_vendor(fact.sparkSession)
    return quality.union_results(
        [
            quality.check_not_null(fact, "fct_trips", FACT_NOT_NULL),
            *[quality.check_not_null(df, name, [key]) for name, (df, key) in keyed.items()],
            quality.check_unique(fact, "fct_trips", ["trip_id"]),
            *[quality.check_unique(df, name, [key]) for name, (df, key) in keyed.items()],
            quality.check_unique(vendors, "dim_vendor", ["vendor_sk"]),
            quality.check_relationships(fact, "fct_trips", _parents(star)),
        ]
    )


def failing_rows(fact: DataFrame, star: Star) -> dict[str, DataFrame]:
    """The rows that each declared check, and the range check, holds against the tables."""
    keyed = _keyed(star)
    tables = {name: (df, [key]) for name, (df, key) in keyed.items()}
    tables["dim_vendor"] = (dim_vendor(fact.sparkSession), ["vendor_sk"])
    out = {f"not_null_fct_trips_{c}": quality.failing_not_null(fact, c) for c in FACT_NOT_NULL}
    out |= {
        f"not_null_{name}_{key}": quality.failing_not_null(df, key)
        for name, (df, key) in keyed.items()
    }
    out |= {
        f"unique_{name}_{key[0]}": quality.failing_unique(df, key)
        for name, (df, key) in {"fct_trips": (fact, ["trip_id"]), **tables}.items()
    }
    out |= {
        f"relationships_fct_trips_{c}": quality.failing_relationships(fact, c, parent, key)
        for c, (parent, key) in _parents(star).items()
    }
    return out | {"range_fct_trips": quality.failing_range(fact, range_violation())}


def store_failures(fact: DataFrame, star: Star, folder: str) -> dict[str, str]:
    """Write the failing rows of every check; path by check."""
    return {
        name: quality.store_failures(rows, folder, name)
        for name, rows in failing_rows(fact, star).items()
    }


def fact_rules(star: Star) -> list[row_checks.Rule]:
    """The declared checks of single rows of the fact, and the range check."""
    parents = {
        "pickup_date_sk": (star.dim_date, "date_sk"),
        "dropoff_date_sk": (star.dim_date, "date_sk"),
        "pickup_zone_sk": (star.dim_zone, "zone_sk"),
        "dropoff_zone_sk": (star.dim_zone, "zone_sk"),
        "payment_type_sk": (star.dim_payment_type, "payment_type_sk"),
        "ratecode_sk": (star.dim_ratecode, "ratecode_sk"),
    }
    return [
        *[row_checks.not_null(c) for c in FACT_NOT_NULL],
        *[row_checks.related(c, *parent) for c, parent in parents.items()],
        row_checks.in_range("trip", range_violation()),
    ]


def staged_rules(star: Star) -> list[row_checks.Rule]:
    """Checks of staged trips: ids that the dimensions must know, and codes that are listed."""
    zones = (star.dim_zone, "zone_sk")
    return [
        row_checks.related("pickup_location_id", *zones),
        row_checks.related("dropoff_location_id", *zones),
        row_checks.accepted("payment_type", list(PAYMENT_LABELS)),
        row_checks.accepted("ratecode_id", list(RATECODE_LABELS)),
        row_checks.not_null("passenger_count"),
    ]
