"""Importance resampling towards a target text, without exploding documents for their scores.

A text's features are its words and pairs of neighbouring words; each falls into one of `buckets` by its CRC-32. A bucket's
gain is 1000 times the log ratio of its smoothed share in the target and in the documents. Higher-order functions make a
document's array of buckets, and its weight is the floored mean of element_at over the array of gains, which is a literal of
`buckets` numbers: scoring is a projection without a join. Before that, each side's buckets are counted; each task sums its
own first, so a shuffle carries at most `buckets` totals a task.

The sample is the top of weight plus Gumbel noise. Scores are whole numbers of a bounded range, so one histogram of them says
how many rows lie above each; a row's rank is that number plus its place among rows of its own score, and no task sorts more
than one score's rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import textwork as T
from tidemark.session import staged

#: Buckets of features: the length of the literal array of gains.
BUCKETS = 10_000
#: Documents of fewer words are not drawn; of the others this share is.
LEAST_WORDS, SHARE_PERCENT = 20, 25
SEED = 7

# A-Z and what is no letter or digit once they are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _let(value: Column, body) -> Column:
    """body(value), where value is computed once for the row however often body's lambdas read it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bucket_array(text: Column, buckets: int = BUCKETS) -> Column:
    """The buckets of a text's words, then of its pairs of neighbouring words; null and empty texts have none."""
    words = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))

    def of(w: Column) -> Column:
        pairs = F.zip_with(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.transform(F.concat(w, pairs), lambda x: (F.crc32(x.cast("binary")) % buckets).cast("int"))

    return _let(words, of)


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that any falls into."""
    return df.select(F.explode(bucket_array(F.col(T.quoted(text_col)), buckets)).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))). `buckets` numbers come to the driver."""
    s, t = [0] * buckets, [0] * buckets
    for counts, frame, column in ((s, docs, text_col), (t, target, target_col)):
        for r in bucket_counts(frame, column, buckets).collect():
            counts[r["bucket"]] = r["n"]
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(1000 * math.log((y + 1.0) * all_s / ((x + 1.0) * all_t))) for x, y in zip(s, t, strict=True)]


def gumbel(seed: int, ident: Column) -> Column:
    """floor(1000 times) standard Gumbel noise of an id's decimal form, from 32 bits of SHA-256; a null id has that of an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scores(docs: DataFrame, gain: list[int], id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(id_col, n_words, n_features, weight, score) of every row, all long but the id: a projection of docs.

    weight: the mean gain of the features, rounded down; 0 without features.
    """
    table = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<long>")

    def of(b: Column) -> Column:
        total = _let(table, lambda g: F.aggregate(b, F.lit(0).cast("long"), lambda acc, x: acc + F.element_at(g, x + 1)))
        return F.struct(F.size(b).cast("long").alias("n"), total.alias("sum"))

    rows = docs.select(F.col(T.quoted(id_col)).alias("id"), _let(bucket_array(F.col(T.quoted(text_col)), len(gain)), of).alias("f"))
    weight = F.when(F.col("f.n") > 0, F.expr("(f.sum - pmod(f.sum, f.n)) div f.n")).otherwise(F.lit(0)).cast("long")
    out = rows.select("id", F.expr("(f.n + 1) div 2").alias("n_words"), F.col("f.n").alias("n_features"), weight.alias("weight"))
    return out.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", (F.col("weight") + gumbel(seed, F.col("id"))).cast("long").alias("score"))


def ranked_sample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", share_percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS,
    seed: int = SEED, buckets: int = BUCKETS,
) -> DataFrame:
    """(id_col, n_features, weight, score, rank) of every row; rank 1, 2, 3... of the drawn rows, null for the others.

    Of the N rows with at least least_words words the floor(N * share_percent / 100) of largest score are drawn, ties by
    smaller id (nulls last), then fewer features, then smaller weight; rows alike in all of these take their places in any order.
    Noise is a function of seed and id, so rows that repeat an id share it. Null and empty texts have no features, weight
    0, and aren't drawn unless least_words is 0. An empty target has equal shares everywhere; an empty table stays empty.
    Columns beside id and text don't matter, whatever their names. A text is held whole in one task, with about 60 times
    its bytes.
    """
    if not 0 <= share_percent <= 100:
        raise ValueError("share_percent must be 0 to 100")
    ident = T.spare("id")
    gain = gains(docs, target, text_col, target_col, buckets)
    rows = staged(scores(docs, gain, id_col, text_col, seed).withColumnRenamed(id_col, ident), "scores")
    able = F.col("n_words") >= least_words
    # As many rows as there are scores: their range is that of gains and noise, below 10^5 whole numbers.
    counted = sorted(rows.filter(able).groupBy("score").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["score"])
    most = sum(r["n"] for r in counted) * share_percent // 100
    above, before = [], 0
    for r in counted:
        if before >= most:
            break
        above.append((r["score"], before))
        before += r["n"]
    kept = ["n_features", "weight", "score"]
    border = above[-1][0] if above else None
    drawable = able & (F.col("score") >= border) if above else F.lit(False)
    rest = rows.filter(~drawable).select(ident, *kept, F.lit(None).cast("long").alias("rank"))
    if not above:
        return rest.withColumnRenamed(ident, id_col)
    table = F.broadcast(rows.sparkSession.createDataFrame(above, "score long, above long"))
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col(ident).asc_nulls_last(), "n_features", "weight"))
    top = rows.filter(drawable).join(table, "score").withColumn("rank", F.col("above") + place)
    top = top.select(ident, *kept, F.when(F.col("rank") <= most, F.col("rank")).alias("rank"))
    return top.unionByName(rest).withColumnRenamed(ident, id_col)
