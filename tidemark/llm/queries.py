"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tidemark.llm import bitplane as _ids
from tidemark.llm import decontaminate as _leaks
from tidemark.llm import digest as _digest
from tidemark.llm import gains as _gains
from tidemark.llm import langid as _langid
from tidemark.llm import linededup as _lines
from tidemark.llm import resample as _resample
from tidemark.llm import rulebits as _rules
from tidemark.llm import runs as _runs
from tidemark.llm import secrets as _secrets
from tidemark.llm import setjoin as _near
from tidemark.llm import sharding as _sharding
from tidemark.llm import triebpe as _bpe
from tidemark.llm.sql import ORACLES
from tidemark.session import staging_path

#: Names of the shards of a run with 32 writers.
SHARDS = [f"shard-{i:02d}" for i in range(32)]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


#: The tokenizer file of the queries and the id that ends a document in the id files.
VOCABULARY, END_ID = "word_bpe_49k.json", 2


def op1_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "ids")
    _ids.write_ids(_table(spark, sf_dir, "documents", "doc_id", "text"), path, public_tokenizers.path(VOCABULARY), END_ID)
    return _ids.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled documents: one row for each that is kept."""
    out = _resample.importance_resample(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return out.select("doc_id", "log_weight", "log_weight_noisy")


def edited(text: str, after: str) -> str:
    """The last quarter of the text's code points replaced by the first as many of the next text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + after[:cut]


def op3_improbable_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return _digest.compare_next(documents, _digest.entropy_ranks(documents), edited)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _lines.dedup_lines(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _langid.identify(_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op6_benchmark_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _leaks.find_leaks(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark", "item_id", "text"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op7_partition_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near.jaccard_classes(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_secret_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _secrets.find_secrets(_table(spark, sf_dir, "documents", "doc_id", "text"))
    base = [r.kind for r in _secrets.RULES if r.base]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select(
        "doc_id", *[count(k) for k in base],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def op9_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return _bpe.encode_documents(documents, public_tokenizers.path(VOCABULARY), with_ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_shard_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sharding.place(_table(spark, sf_dir, "documents", "doc_id"), "doc_id", SHARDS).select("doc_id", "slot", "shard")


def op11_gain_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gains.ranked_sample(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark", "text"))


#: The policy that op12 judges by.
POLICY = "quality-2"


def op12_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rules.ledger(_table(spark, sf_dir, "documents", "doc_id", "text"))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select("doc_id", *measures, (~_rules.passes("base-1")).alias("base_failed"), _rules.passes(POLICY).alias("kept"), "failures")


def tiled(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of one in ten documents, by its id, the words from some place on repeat with a period of at most a third of them."""
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _runs.periodic_runs(_table(spark, sf_dir, "documents", "doc_id", "text"), rewrite=tiled)
    # Runs come by start, then period: only a greater exponent replaces the best so far.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"), "collapsed_text")
    return out.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
