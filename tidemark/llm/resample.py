"""Importance resampling of documents: hashed n-gram models of target and raw text, Gumbel top-k.

Two generative models over hashed token n-grams (words and runs of punctuation; unigrams and bigrams in separate
tables, and a back-off n-gram for a run of RUN equal tokens, whatever the token) are fitted by counting in
how many documents a bucket occurs: the target model over labelled good documents, the raw model over every document.
A document's log weight is log p_target / p_raw, the sum over its distinct buckets. Ratios are shrunk: towards zero by
SHRINK, and to zero where the counts differ by fewer than LEAST_SIGMAS standard deviations. Groups of copies, of which
the labels cover more or less than their share, move the ratios of many n-grams by less than that; what only one side
has stands out by far more. Each n-gram is looked up in two tables and the ratio nearer to one holds, so that hash
collisions don't lend weight (a count sketch).

The sample is the k largest of log weight plus Gumbel noise, which draws k documents without replacement, each draw
with probability proportional to the weights. k defaults to the expected number of acceptances of rejection sampling
with weights capped at one: the sum of min(1, weight).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textwork as T
from tidemark.session import ship, staged

#: log2 of the buckets of each of four tables (unigrams and bigrams, twice): the models' fixed size.
BITS = 19
#: The hash of the back-off n-gram of RUN equal tokens. Shorter runs of a frequent word happen in good text.
SAME = np.uint64(0x5BD1E9955BD1E995)
RUN = 6
#: Added to both counts of a bucket.
PRIOR = 2.0
#: Log ratios are shrunk by SHRINK; they count if the counts differ by LEAST_SIGMAS.
SHRINK = 1.0
LEAST_SIGMAS = 3.0
#: Labelled rows that the target model is fitted on, at most about (a bounded, hash-ordered sample).
TARGET_ROWS = 200_000


def buckets(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, other bucket) of the distinct hashed n-grams of each text.

    Each n-gram has a bucket in two tables, by independent bits of its hash, so that a rare n-gram which shares a
    bucket with a telling one is told apart in the other table. Bigrams lie 2**bits higher, the second table
    2**(bits+1) higher. RUN equal tokens in a row are also the back-off n-gram SAME.
    """
    buf, at = T.join_texts(texts)
    low = T.LOWER[buf]
    kind = T.ALNUM[low].astype(np.int8) + 2 * (T.NONSPACE[low] & ~T.ALNUM[low]).astype(np.int8)
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts = np.concatenate([[0], edge]).astype(np.int64)
    ends = np.concatenate([edge, [len(kind)]]).astype(np.int64)
    full = kind[starts] > 0
    starts, ends = starts[full], ends[full]
    hashes = T.word_hash(low, starts, ends)
    offsets = np.searchsorted(starts, at)
    one, owner = T.within(offsets, 1)
    two, owner2 = T.within(offsets, 2)
    run, owner3 = T.within(offsets, RUN)
    same = np.ones(len(run), bool)
    for j in range(1, RUN):
        same &= hashes[run] == hashes[run + j]
    owner3 = owner3[same]
    pair = 2 * bits
    grams = np.concatenate([hashes[one], np.full(len(owner3), SAME), T.grams(hashes, 2)[two]]) >> np.uint64(64 - pair)
    owners = np.concatenate([owner, owner3, owner2])
    higher = np.concatenate([np.zeros(len(owner) + len(owner3), np.int64), np.full(len(owner2), 1 << pair)])
    key = np.unique((owners << (pair + 1)) + higher + grams.astype(np.int64))
    mask = (1 << bits) - 1
    bigram = (key >> pair & 1) << bits
    return key >> (pair + 1), (key >> bits & mask) + bigram, (key & mask) + bigram + (2 << bits)


#: Parts in which a task's counts travel; each is summed in a stream by one task.
SEGMENTS = 64


def fit_counts(df: DataFrame, id_hash: str, text_col: str, wanted: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(target counts, raw counts, target rows, raw rows): in how many rows each bucket occurs."""
    counts, rows = group_counts(df, id_hash, text_col, [wanted], bits)
    return counts[1], counts[0], rows[1], rows[0]


def group_counts(df: DataFrame, id_hash: str, text_col: str, groups: list[np.ndarray], bits: int = BITS) -> tuple[np.ndarray, list[int]]:
    """(counts, rows) of all rows, then of each group: in how many rows each bucket occurs.

    One pass over all rows; rows whose id_hash is in a group (sorted) also count for it. A task sends its count
    vectors once, compressed, in SEGMENTS parts, which are summed part by part; the sums come to the driver, a
    fixed size.
    """
    spark = df.sparkSession
    ids = spark.sparkContext.broadcast(groups)
    sides = 1 + len(groups)
    size = 4 << bits
    width = size // SEGMENTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((sides, size), np.int32)
        rows = np.zeros(sides, np.int64)
        for batch in batches:
            texts = T.as_bytes(batch.column("text"))
            keys = batch.column("id").to_numpy()
            among = [known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys if len(known) else np.zeros(len(keys), bool) for known in ids.value]
            rows += (len(keys), *[mine.sum() for mine in among])
            for a, b in T.chunked([len(t) + 1 for t in texts]):
                owner, first, second = buckets(texts[a:b], bits)
                both = np.concatenate([first, second])
                counts[0] += np.bincount(both, minlength=size).astype(np.int32)
                for side, mine in enumerate(among, 1):
                    part = mine[a:b][owner]
                    if part.any():
                        counts[side] += np.bincount(both[np.concatenate([part, part])], minlength=size).astype(np.int32)
        press = zstandard.ZstdCompressor(level=3)
        for side in range(sides):
            if rows[side]:
                blobs = [press.compress(np.ascontiguousarray(counts[side, i * width : (i + 1) * width]).tobytes()) for i in range(SEGMENTS)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(SEGMENTS, side)), pa.array(np.arange(SEGMENTS)), pa.array([int(rows[side])] + [0] * (SEGMENTS - 1)), pa.array(blobs, pa.binary())], ["side", "segment", "n", "counts"]
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, total, n, at = zstandard.ZstdDecompressor(), None, 0, None

        def done() -> pa.RecordBatch:
            blob = zstandard.ZstdCompressor(level=3).compress(total.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]]), pa.array([n]), pa.array([blob], pa.binary())], ["side", "segment", "n", "counts"])

        for batch in batches:
            for row in batch.to_pylist():
                if (row["side"], row["segment"]) != at:
                    if at is not None:
                        yield done()
                    at, total, n = (row["side"], row["segment"]), np.zeros(width, np.int64), 0
                total += np.frombuffer(press.decompress(row["counts"]), np.int32)
                n += row["n"]
        if at is not None:
            yield done()

    schema = "side long, segment long, n long, counts binary"
    parts = df.select(F.col(id_hash).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    sums = parts.repartition("side", "segment").sortWithinPartitions("side", "segment").mapInArrow(add, schema).collect()
    out, rows = np.zeros((sides, size)), [0] * sides
    press = zstandard.ZstdDecompressor()
    for r in sums:
        out[r["side"], r["segment"] * width : (r["segment"] + 1) * width] = np.frombuffer(press.decompress(r["counts"]), np.int64)
        rows[r["side"]] += r["n"]
    return out, rows


def log_ratios(target: np.ndarray, raw: np.ndarray, n_target: int, n_raw: int) -> np.ndarray:
    """log(p_target / p_raw) of each bucket, shrunk (see the module)."""
    if not n_target or not n_raw:
        return np.zeros(len(raw), np.float32)
    expected = raw * (float(target.sum()) / max(1.0, float(raw.sum())))
    ratio = np.log((target + PRIOR) / (expected + PRIOR))
    sure = np.abs(target - expected) > LEAST_SIGMAS * np.sqrt(np.maximum(expected, 1.0))
    return np.where(sure, np.sign(ratio) * np.maximum(np.abs(ratio) - SHRINK, 0.0), 0.0).astype(np.float32)


def _weights(df: DataFrame, text: str, ratios, bits: int) -> DataFrame:
    """df with log_weight; `text` is dropped, so that it does not travel back."""
    rest = [c for c in df.columns if c != text]
    target = df.select(*T.named(rest), F.lit(0.0).alias("log_weight")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratios.value
        for batch in batches:
            texts, out = T.as_bytes(batch.column(text)), []
            for a, b in T.chunked([len(t) + 1 for t in texts]):
                owner, first, second = buckets(texts[a:b], bits)
                x, y = table[first], table[second]
                both = np.where(x * y > 0, np.where(np.abs(x) < np.abs(y), x, y), 0)
                out.append(np.bincount(owner, weights=both, minlength=b - a))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(np.concatenate(out) if out else np.zeros(0))], [*rest, "log_weight"])

    return df.mapInArrow(run, target)


def gumbel(seed: int, *key: Column) -> Column:
    """Standard Gumbel noise, a function of the seed and the key."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11).cast("double") + 0.5) * 2.0**-53
    return -F.log(-F.log(uniform))


def top_k(df: DataFrame, k: int, score: str, ties: list[str]) -> DataFrame:
    """The k rows of largest score (ties: smaller values of `ties` first), without sorting the table in one place.

    The k-th score is found digit by digit: counts over 2**16 ranges of the remaining interval come to the driver
    until the range that holds it has at most 100,000 rows or the scores in it are equal; only that range is ranked.
    """
    low, high = df.agg(F.min(score), F.max(score)).first()
    if low is None or k <= 0:
        return df.limit(0)
    n = df.count()
    if k >= n:
        return df
    bins, taken, inside = 1 << 16, 0, n
    while inside > 100_000 and high > low:
        width = (high - low) / bins
        if width == 0 or low + width == low:
            break
        bin_of = F.least(F.lit(bins - 1), F.floor((F.lit(high) - F.col(score)) / F.lit(width))).cast("int")
        counts = df.filter(F.col(score).between(low, high)).groupBy(bin_of.alias("b")).agg(F.count("*").alias("n"), F.min(score).alias("lo"), F.max(score).alias("hi")).orderBy("b").collect()
        for r in counts:
            if taken + r["n"] >= k:
                low, high, inside = r["lo"], r["hi"], r["n"]
                break
            taken += r["n"]
        if len(counts) == 1:
            break
    # The window spreads over hash buckets of the ties first: each keeps the rows that could be among the first.
    need = k - taken
    border = df.filter(F.col(score).between(low, high))
    order = [F.col(score).desc(), *[F.col(t).asc_nulls_last() for t in ties]]
    part, rank = T.spare("part"), T.spare("rank")
    if inside > 100_000:
        border = border.withColumn(part, F.pmod(F.xxhash64(*ties), F.lit(256)))
        border = border.withColumn(rank, F.row_number().over(Window.partitionBy(part).orderBy(*order))).filter(F.col(rank) <= need).drop(part, rank)
    first = border.withColumn(rank, F.row_number().over(Window.orderBy(*order))).filter(F.col(rank) <= need).drop(rank)
    return df.filter(F.col(score) > high).unionByName(first)


def importance_resample(
    df: DataFrame, labels: DataFrame, k: int | None = None, share: float | None = None, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
    good: str = "quality", bad: str = "toxic", bits: int = BITS, target_rows: int = TARGET_ROWS, sharpness: float = 1.0, scored: bool = False,
) -> DataFrame:
    """The k sampled rows of df with log_weight and log_weight_noisy, sharpness * log_weight plus noise.

    Columns of those names, in any case, are replaced. labels: (id_col, good, bad); the target is what has good = 1
    and bad = 0 (null: not); other labels are not used. Of more than target_rows target rows a hash-ordered share is
    used. share: k as a share of df's rows; without k and share, k is the sum of min(1, weight ** sharpness), rounded.
    Noise is a function of seed and id, so rows that repeat an id share it; of rows that repeat id and text as many
    as fit are kept. Null and empty texts have no n-grams and log weight 0. Without target rows all weights are 0 and
    without k and share all rows are kept. Ids may be of any type. An empty table stays empty. scored=True returns
    every row with its columns instead. A text is held whole in one task, with about 35 times its bytes.
    """
    spark = df.sparkSession
    ship(spark)
    T.small_batches(spark)
    base = df.select(*T.named(T.others(df, ("log_weight", "log_weight_noisy"))))
    ident, text = F.col(T.quoted(id_col)), F.col(T.quoted(text_col))
    is_target = (F.coalesce(F.col(T.quoted(good)), F.lit(0)) == 1) & (F.coalesce(F.col(T.quoted(bad)), F.lit(0)) == 0)
    known = labels.select(F.col(T.quoted(id_col)).cast("string").alias("id"), is_target.cast("int").alias("target")).filter("id is not null")
    marks = known.groupBy("id").agg(F.min("target").alias("target"))
    slim = base.select(F.xxhash64(ident.cast("string")).alias("h"), text.alias("text"))
    target, raw, n_target, n_raw = fit_counts(slim, "h", "text", _sample(marks, target_rows), bits)
    ratios = spark.sparkContext.broadcast(log_ratios(target, raw, n_target, n_raw))  # 4 bytes a bucket: 8 MB
    keyed = base.select(ident.alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    noisy = F.lit(sharpness) * F.col("log_weight") + gumbel(seed, F.col("id"))
    # Only ids and weights are ranked; texts are read again for what is kept.
    weights = staged(_weights(keyed, "text", ratios, bits).withColumn("log_weight_noisy", noisy), "weights")
    if scored:
        kept = weights.groupBy("id", "hash").agg(F.max("log_weight").alias("log_weight"), F.max("log_weight_noisy").alias("log_weight_noisy"), F.lit(0).alias("n"), F.lit(0).alias("of"))
    else:
        if k is None:
            rows = weights.agg(F.count("*"), F.sum(F.least(F.lit(1.0), F.exp(F.lit(sharpness) * F.col("log_weight"))))).first()
            k = int(round(share * rows[0] if share is not None else rows[1] or 0))
        drawn = top_k(weights, k, "log_weight_noisy", ["id", "hash"])
        drawn = drawn.groupBy("id", "hash").agg(F.max("log_weight").alias("log_weight"), F.max("log_weight_noisy").alias("log_weight_noisy"), F.count("*").alias("n"))
        all_rows = weights.groupBy(F.col("id").alias("id2"), F.col("hash").alias("hash2")).agg(F.count("*").alias("of")).filter("of > 1")
        same = drawn["id"].eqNullSafe(all_rows["id2"]) & drawn["hash"].eqNullSafe(all_rows["hash2"])
        kept = staged(drawn.join(all_rows, same, "left").select("id", "hash", "log_weight", "log_weight_noisy", "n", F.coalesce("of", "n").alias("of")), "drawn", k, 1_000_000)
    names = {c: T.spare(c) for c in ("id", "hash", "n", "of")}
    kept = kept.withColumnsRenamed(names)
    # The hash is a column before the join, so that texts which nobody asks for don't travel.
    mine = T.spare("mine")
    joined = base.withColumn(mine, F.xxhash64(text)).join(kept, ident.eqNullSafe(F.col(names["id"])) & F.col(mine).eqNullSafe(F.col(names["hash"])), "inner")
    out = [*T.named(base.columns), "log_weight", "log_weight_noisy"]
    partly = F.col(names["n"]) < F.col(names["of"])
    if scored or kept.filter(partly).isEmpty():
        return joined.select(*out)
    # The border runs through rows that repeat id and text: so many of them as were drawn.
    row = T.spare("row")
    some = joined.filter(partly).withColumn(row, F.row_number().over(Window.partitionBy(names["id"], names["hash"]).orderBy(F.lit(0)))).filter(F.col(row) <= F.col(names["n"]))
    return joined.filter(~partly).select(*out).unionByName(some.select(*out))


def _sample(marks: DataFrame, most: int) -> np.ndarray:
    """Sorted id hashes of the target rows, or of about `most` of them: 8 bytes each."""
    of_value = marks.filter("target = 1")
    share = min(1.0, most / max(1, of_value.count()))
    inside = F.pmod(F.xxhash64(F.lit("target"), "id"), F.lit(1 << 20)) < int(share * (1 << 20)) + (share >= 1)
    return np.unique(np.array([r["h"] for r in of_value.filter(inside).select(F.xxhash64("id").alias("h")).collect()], np.int64))
