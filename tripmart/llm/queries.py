"""One query per operator: it runs the operator over its whole table and derives the digest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (
    binary,
    decontaminate,
    gated_lm,
    html_text,
    jaccard,
    licenses,
    line_dedup,
    lloyd,
    packing,
    quality,
    sharding,
    url_filter,
    vectors,
    whitening,
)
from tripmart.session import new_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, with the item and the place."""
    return decontaminate.leaks(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as byte-level tokens, packed into sequences of at most 2048."""
    docs = _table(spark, folder, "documents")
    return packing.pack_documents(docs, "byte_bpe_50k.json", spaces=True, end_id=0)


def op3_gated_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Log-likelihood of every document by the recurrent model and by word shares."""
    return gated_lm.score_documents(_table(spark, folder, "documents"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.verdicts(_table(spark, folder, "documents"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What line de-duplication leaves of every document."""
    return line_dedup.dedup_lines(_table(spark, folder, "documents")).select(
        "doc_id",
        F.col("line_dedup_lines").alias("n_lines"),
        F.col("line_dedup_dropped").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the url of every page."""
    model = url_filter.train(url_filter.labelled(spark))
    return url_filter.judge(_table(spark, folder, "pages"), URL_RULES, model)


def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Links between all documents whose five-word shingles are similar by 0.8 or more."""
    return jaccard.similar_documents(_table(spark, folder, "documents"))


def op8_token_binary(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as bit-packed ids, and what the files say of each."""
    docs = _table(spark, folder, "documents")
    path = new_path(spark, "token-binary")
    binary.write_tokens(docs, path, "word_bpe_49k.json", spaces=False, end_id=1)
    return binary.read_tokens(spark, path)


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_table(spark, folder, "pages"))


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.scan(_table(spark, folder, "documents"))


def op11_bidiagonal_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding along the four directions of most variance, in unit variance."""
    return whitening.whitened(vectors.whole_vectors(_table(spark, folder, "embeddings")))


def op12_feistel_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document in a reproducible shuffle."""
    sizes = sharding.document_sizes(_table(spark, folder, "documents"))
    placed = sharding.sharded(sizes, ["doc_id", "size", "text_crc32"])
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op13_sharded_lloyd(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of every embedding of 64 components, with the inertia and its centroid's hash."""
    return lloyd.digests(
        *lloyd.clustered(vectors.whole_vectors(_table(spark, folder, "embeddings")))
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_gated_lm": op3_gated_lm,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_token_binary": op8_token_binary,
    "op9_html_extraction": op9_html_extraction,
    "op10_license_scan": op10_license_scan,
    "op11_bidiagonal_whitening": op11_bidiagonal_whitening,
    "op12_feistel_sharding": op12_feistel_sharding,
    "op13_sharded_lloyd": op13_sharded_lloyd,
}

#: Twins in DuckDB SQL. The other operators need token ids, models or similarity search, which SQL
#: does not express; tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op4_quality_rules": quality.ORACLE_SQL,
    "op5_line_dedup": line_dedup.ORACLE_SQL,
    "op10_license_scan": licenses.oracle_sql(),
    "op12_feistel_sharding": sharding.oracle_sql(),
    "op13_sharded_lloyd": lloyd.oracle_sql(),
}
