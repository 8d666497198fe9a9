"""All checks of single rows in one pass over a table, and their failing rows in one write.

Every rule owns a bit. One scan gives each row the mask of the rules it breaks; the counts are
observed on the way, and the rows with a mask go to one folder per rule. Parent keys join by
broadcast if they are few enough. Only failing rows are copied, once per broken rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripmart.session import Kept, open_files, small_side

CHECK = "check_name"
_MASK = "__broken"


class Rule(NamedTuple):
    """A check of one column (or, for a range, of a labelled condition).

    A row fails if ``broken`` holds, or if its non-NULL key is missing in ``parent`` (table, key).
    """

    check: str
    column: str
    broken: Column | None = None
    parent: tuple[Kept, str] | None = None

    @property
    def name(self) -> str:
        return f"{self.check}_{self.column}"


def not_null(column: str) -> Rule:
    return Rule("not_null", column, F.col(column).isNull())


def related(column: str, parent: Kept, key: str) -> Rule:
    return Rule("relationships", column, parent=(parent, key))


def accepted(column: str, values: Sequence[Any]) -> Rule:
    """NULL is accepted."""
    return Rule("accepted_values", column, ~F.col(column).isin(*values))


def in_range(label: str, violation: Column) -> Rule:
    return Rule("range", label, violation)


def marked(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with the mask of the rules each row breaks; at most 63 rules."""
    if len(rules) > 63:
        raise ValueError("a mask holds 63 rules")
    mask = F.lit(0).cast("bigint")
    for place, rule in enumerate(rules):
        broken = rule.broken
        if rule.parent is not None:
            parent, key = rule.parent
            own = f"__parent{place}"
            keys = parent.df.select(F.col(key).alias(own)).where(F.col(own).isNotNull()).distinct()
            side = small_side(parent._replace(df=keys))
            df = df.join(side, F.col(rule.column) == F.col(own), "left")
            broken = F.col(rule.column).isNotNull() & F.col(own).isNull()
        bit = F.lit(1 << place).cast("bigint")
        mask = mask.bitwiseOR(F.when(broken, bit).otherwise(F.lit(0).cast("bigint")))
    parents = [f"__parent{p}" for p, rule in enumerate(rules) if rule.parent is not None]
    return df.withColumn(_MASK, mask).drop(*parents)


def check_rows(df: DataFrame, table: str, rules: Sequence[Rule], folder: str) -> DataFrame:
    """Check a table and store its failing rows below ``folder`` (column ``check_name``).

    One result row per rule: (check, table, column, n_failing, status); only these counts reach
    the driver. A rule that no row breaks has no folder.
    """
    bits = [F.lit(1 << place).cast("bigint") for place in range(len(rules))]
    hit = [F.col(_MASK).bitwiseAND(bit) != 0 for bit in bits]
    seen = Observation()
    names = F.array_compact(
        F.array(*[F.when(h, F.lit(rule.name)) for h, rule in zip(hit, rules, strict=True)])
    )
    failing = (
        marked(df, rules)
        .observe(seen, *[F.count_if(h).alias(rule.name) for h, rule in zip(hit, rules, strict=True)])
        .where(F.col(_MASK) != 0)
        .withColumn(CHECK, F.explode(names))
        .select(*df.columns, CHECK)
    )
    with open_files(df.sparkSession):
        failing.write.mode("overwrite").partitionBy(CHECK).parquet(folder)
    counts = seen.get
    rows = [
        (r.check, table, r.column, counts[r.name], "fail" if counts[r.name] else "pass")
        for r in rules
    ]
    schema = "check string, table string, column string, n_failing bigint, status string"
    return df.sparkSession.createDataFrame(rows, schema)


def stored_failures(df: DataFrame, folder: str) -> DataFrame:
    """The stored rows of a checked table ``df``, with the name of the rule each of them breaks."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, {CHECK} string"
    return df.sparkSession.read.schema(schema).parquet(folder)
