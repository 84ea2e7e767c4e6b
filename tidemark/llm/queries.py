"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import zlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import (
    byte_bpe,
    common,
    cotraining,
    decontaminate,
    jaccard,
    line_dedup,
    periodic,
    pivots,
    reshard,
    secret_scan,
    token_files,
    url_rules,
    warc_index,
    whitening,
)

END_ID = 2


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc_index.archived(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.linked(_table(spark, folder, "embeddings"))


def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(_table(spark, folder, "documents"))


def lines_deduplicated(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.deduplicated(_table(spark, folder, "documents").select("doc_id", "text"))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.reported(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.reported(_table(spark, folder, "documents"))


def token_id_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.read(token_files.write(_table(spark, folder, "documents"), path, END_ID))


def byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = byte_bpe.encoded(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return cotraining.classified(docs, labels)


OLD_SHARDS = 5


def resharding(spark: SparkSession, folder: str) -> DataFrame:
    """From five shards by the hash of the text, where a text of many copies weighs on one, to eight."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    old = F.pmod(F.xxhash64(text), F.lit(OLD_SHARDS)).cast("int")
    layout = reshard.lay_out(docs, old, session.run_dir(spark, "old-shards"))
    return reshard.resharded(layout).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard_no").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# The rules of the query: host, path, verdict.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_rules.judged(_table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


def with_periods(docs: DataFrame) -> DataFrame:
    """One text in ten, by its id, repeats its own words from some word on."""

    def plant(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = []
        for number, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            h = None if number is None else zlib.crc32(str(number).encode())
            if text and h is not None and h % 10 == 0:
                text = _repeating(text, h // 10)
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "text"])

    return common.in_batches(
        docs.select("doc_id", F.col("text").cast("binary").alias("text")), plant, "doc_id long, text binary"
    )


def _repeating(text: bytes, g: int) -> bytes:
    words = text.split()
    n = len(words)
    if not n:
        return text
    a = g % n
    period = words[a : a + 1 + (n - a) // (3 + g % 8)]
    return b" ".join(words[:a] + (period * ((n - a) // len(period) + 1))[: n - a])


def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_periods(_table(spark, folder, "documents"))
    return periodic.collapsed(
        docs,
        columns=(
            "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
        ),
    )


COMPONENTS = 8


def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers made of the embeddings, so that sums are exact; sums beyond 64 bits raise."""
    vectors = whitening.usable(_table(spark, folder, "embeddings").select("vec_id", "embedding"))
    whole = F.transform("embedding", lambda c: F.floor(1024 * c.cast("double")) + 100000)
    vectors = common.store(vectors.select("vec_id", whole.alias("embedding")), "whole-vectors")
    passes = whitening.Passes(vectors)
    fitted = whitening.fit(passes, COMPONENTS)
    d = len(fitted.mean) if fitted else 0
    n, *sums = vectors.agg(
        F.count(F.lit(1)), *[F.coalesce(F.sum(F.col("embedding")[i]), F.lit(0)) for i in range(d)]
    ).first()
    if not fitted:
        fitted = whitening.nothing()
    off = F.zip_with("embedding", F.array(*[F.lit(s).cast("long") for s in sums]), lambda x, s: n * x - s)
    deviation = F.aggregate(off, F.lit(0).cast("long"), lambda total, x: total + x * x)
    rows = whitening.whitened(vectors.withColumn("deviation", deviation), fitted, keep=("vec_id", "deviation"))
    explained = F.array(*[F.lit(float(e)) for e in fitted.explained]).cast("array<double>")
    return rows.select(
        "vec_id",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.posexplode("whitened").alias("place", "whitened"),
        F.lit(whitening.identity_error(passes, fitted)).alias("identity_error"),
    ).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        "identity_error",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_index": warc,
    "op2_embedding_near_dedup": embedding_near_dedup,
    "op3_ngram_jaccard": ngram_jaccard,
    "op4_line_dedup": lines_deduplicated,
    "op5_decontamination": decontamination,
    "op6_secret_scan": secrets,
    "op7_token_files": token_id_files,
    "op8_byte_bpe": byte_level_bpe,
    "op9_quality_classifier": quality_classifier,
    "op10_resharding": resharding,
    "op11_url_rules": url_filter,
    "op12_periodic_runs": periodic_runs,
    "op13_embedding_whitening": embedding_whitening,
}

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)

SQL: dict[str, str] = {
    "op11_url_rules": f"""
        WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULES}),
        places AS (
          SELECT page_id, row_number() OVER () AS row,
                 translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
                           '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
                 coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
          FROM pages
        ),
        best AS (
          SELECT p.row, rule_host || rule_path AS rule, verdict
          FROM places p JOIN rules r
            ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
          QUALIFY row_number() OVER (
            PARTITION BY p.row ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM places LEFT JOIN best USING (row)""",
}
