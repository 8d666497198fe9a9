"""URL filter: host and path rules first, then a logistic regression on hashed character n-grams.

DataFrames only. The model learns from ``labelled_urls.csv``, a small table of urls with a label:
three for each word that tells them (alone; in a longer host; in one with a telling path), and some
names that say nothing, which are ordinary. Its features are the distinct n-grams of host and path,
each hashed into one of ``BUCKETS``; what the fit leaves is one weight per bucket, so scoring is one
expression over a row, without a shuffle.
"""

from __future__ import annotations

import csv
from importlib import resources
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 8192
SIZES = (3, 4, 5)
#: Least probability that blocks: an ordinary host that resembles a blocked one should pass.
BLOCK_FROM = 0.9

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def labelled(spark: SparkSession) -> DataFrame:
    """(word, url, label): 1 for urls to block; ``word`` is for folds that share no word."""
    with resources.files(__package__).joinpath("labelled_urls.csv").open() as file:
        rows = [(r["word"], r["url"], int(r["label"])) for r in csv.DictReader(file)]
    return spark.createDataFrame(rows, "word string, url string, label int")


class Rule(NamedTuple):
    """Fits ``host`` and its subdomains where the path begins with ``path``."""

    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end; empty for null or without."""
    return F.coalesce(
        F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _SMALL), F.lit("")
    )


def path_of(url: Column) -> Column:
    """From after the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r.host, r.path)):
        fits = (
            ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
            if rule.path
            else (host == rule.host) | host.endswith("." + rule.host)
        )
        name = F.when(fits, F.lit(rule.host + rule.path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def features(host: Column, path: Column) -> Column:
    """Buckets of the distinct n-grams of host and path, which never share an n-gram.

    Each text goes into a lambda variable, so it is made once and not for each n-gram.
    """

    def grams(text: Column, size: int) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1))),
            lambda i: F.pmod(F.xxhash64(F.lit(size), text.substr(i, F.lit(size))), F.lit(BUCKETS)),
        )

    texts = F.array(F.concat(F.lit("^"), host, F.lit("$")), F.concat(F.lit(" "), path, F.lit(" ")))
    found = F.transform(texts, lambda text: F.concat(*[grams(text, n) for n in SIZES]))
    return F.array_distinct(F.flatten(found))


class Model(NamedTuple):
    weights: list[float]
    bias: float

    def score(self, host: Column, path: Column) -> Column:
        """Probability that the url is one to block."""
        weights = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        total = F.aggregate(
            features(host, path),
            F.lit(self.bias),
            lambda sum_, bucket: sum_ + F.get(weights, bucket.cast("int")),
        )
        return 1 / (1 + F.exp(-total))


def train(table: DataFrame) -> Model:
    """Fit to ``table`` (url, label), which must be small; rows without a label are left out."""
    found = features(host_of(F.col("url")), path_of(F.col("url"))).cast("array<string>")
    as_vector = CountVectorizerModel.from_vocabulary(
        [str(b) for b in range(BUCKETS)], inputCol="found", outputCol="features"
    )
    rows = as_vector.transform(
        table.where("label IS NOT NULL").select(
            found.alias("found"), F.col("label").cast("double").alias("label")
        )
    ).select("features", "label")
    fitted = LogisticRegression(maxIter=50, regParam=0.01).fit(rows)
    return Model([float(w) for w in fitted.coefficients], float(fitted.intercept))


def judge(pages: DataFrame, rules: tuple[Rule, ...], model: Model) -> DataFrame:
    """page_id, host, path, rule, verdict and score of each row of ``pages`` (page_id, url).

    A rule decides; without one, a score of ``BLOCK_FROM`` or more blocks. A null url, or one without
    ``://``, has an empty host and path. Ids may be null or repeated; other columns are ignored.
    """
    rows = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select(
        "*",
        name.alias("rule"),
        verdict.alias("ruled"),
        model.score(F.col("host"), F.col("path")).alias("score"),
    )
    by_score = F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow")
    return rows.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_score).alias("verdict"), "score"
    )
