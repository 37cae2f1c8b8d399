"""Each row's successor in ascending key order, without a window over the whole table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bitplane import shard_borders
from tidemark.llm.textwork import quoted
from tidemark.session import ship

FIRST = -(2**63)


def ordered(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = 2_048) -> DataFrame:
    """(shard, last, key, text) in streams for `followed`: each partition sorted by shard, last and key.

    The id range is cut into shards; each shard also gets the first row of the next one that has rows (last = 1), so
    each row finds its successor in a stream over its sorted shard.
    """
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.coalesce(F.col(quoted(id_col)).cast("long"), F.lit(FIRST)).alias("key"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"))
    borders = spark.sparkContext.broadcast(np.array(shard_borders(rows, "key", shard_docs), np.int64))

    @F.pandas_udf("int")
    def shard_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders.value, key.to_numpy(), side="right").astype(np.int32))

    placed = rows.withColumn("shard", shard_of("key"))
    # One row a shard (MOST_SHARDS at most): its smallest key, and the shard that comes before it.
    lows = sorted((r["shard"], r["key"]) for r in placed.groupBy("shard").agg(F.min("key").alias("key")).collect())
    before = [(lows[i - 1][0], key) for i, (_, key) in enumerate(lows)]
    heads = spark.createDataFrame(before, "before int, key long")
    first = rows.join(F.broadcast(heads), "key").groupBy("before", "key").agg(F.min("text").alias("text"))
    stream = placed.select("shard", F.lit(0).alias("last"), "key", "text").unionByName(first.select(F.col("before").alias("shard"), F.lit(1).alias("last"), "key", "text"))
    return stream.repartition("shard").sortWithinPartitions("shard", "last", "key", "text")


def followed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple[int | None, str, str]]]:
    """(id, text, next text) of the rows of `ordered`, in groups of about `most` code points."""
    held, out, size = None, [], 0
    for batch in batches:
        for last, key, text in zip(*[batch.column(c).to_pylist() for c in ("last", "key", "text")], strict=True):
            if held is not None:
                out.append((*held, text))
                size += len(text)
                if size >= most:
                    yield out
                    out, size = [], 0
            if last and out:
                yield out  # the next shard begins with another text
                out, size = [], 0
            held = None if last else (None if key == FIRST else key, text)
    if out:
        yield out


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = 2_048) -> DataFrame:
    """(doc, text, next): next is the text of the row after in ascending id order, after the last row the first's.

    Ids are cast to long. Null texts count as empty. Rows with a null id come first; rows with one id follow each
    other by text. A single row is its own successor. An empty table gives an empty one.
    """

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in followed(batches, 1 << 20):
            keys, texts, after = zip(*group, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.string()), pa.array(after, pa.string())], ["doc", "text", "next"])

    return ordered(df, id_col, text_col, shard_docs).mapInArrow(follow, "doc long, text string, next string")
