"""From raw documents to token ids in five stages; each writes Parquet that the next one reads.

Every function takes (spark, docs, sf_dir) and works on all of docs; all but the last return the columns of
documents. Rows that a stage rejects are gone for the following ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.linededup import dedup_lines
from tidemark.llm.resample import importance_resample
from tidemark.llm.setjoin import first_of_class
from tidemark.llm.textwork import spare
from tidemark.llm.triebpe import encode_documents
from tidemark.session import scratch, staged

VOCABULARY = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the importance sample of docs; the labelled good documents are the target.

    Null and empty texts have weight one and are drawn like any document without telling n-grams. Equal scores are drawn
    by id; rows that repeat an id share its noise. An empty table stays empty. Columns keep their values, whatever
    their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    names = {c: spare("kept") for c in docs.columns if c.lower() in ("log_weight", "log_weight_noisy")}
    out = importance_resample(docs.withColumnsRenamed(names), labels)
    return out.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops shared lines but for their first document. A document that loses lines and has no text left goes.

    A null text stays null, an empty one empty. Rows that repeat an id own their lines together; rows with a null id stay
    whole. An empty table stays empty. Columns keep their values, whatever their names; n_chars follows the text.
    """
    names = {c: spare("kept") for c in docs.columns if c.lower() in ("n_lines", "n_dropped", "kept_text")}
    out = dedup_lines(docs.withColumnsRenamed(names))
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    left = out.filter((F.col("n_dropped") == 0) | F.col("kept_text").rlike(r"\S"))
    left = left.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return left.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates (five-word shingles, Jaccard 0.8 or more): its smallest id.

    Texts without words and rows with a null id stay. Rows that repeat id and words are one document; rows that repeat an
    id with other words are told apart. An empty table stays empty. Columns keep their values, whatever their names.
    """
    return first_of_class(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that share ten words in a row with a benchmark item, or hold a shorter item whole.

    Null and empty texts stay; repeated rows stay or go together; an empty table stays empty, and an empty benchmark
    drops nothing. Columns keep their values, whatever their names.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) of every document that is left, and digests of ids and decoded text.

    Null and empty texts have no tokens; repeated rows come out as often; an empty table gives an empty one.
    """
    out = encode_documents(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY))
    return out.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("benchmark_leaks", benchmark_leaks), ("bpe", bpe)]

#: The draw of the first stage and the encoding of the last have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents. What a stage stages for itself is deleted once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch(spark, "pipeline-"):
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
