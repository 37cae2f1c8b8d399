"""Benchmark decontamination by winnowing.

Fingerprint: of every `window` consecutive words keep the smallest hash of its k-grams (the rightmost of equal
ones). A span of `window` words that a document shares with an item holds the same k-grams in both, so both
keep the same one: no shared span of that length is missed. Document and item fingerprints are joined; each hit is
then extended to both sides, word by word, and counts only if the common run covers a whole window. Hits are
compared by the words' bytes, so the result does not rest on hashes.

The join is a broadcast one, inside the scan of the documents, where the benchmark's bytes have been measured to be
small. A larger benchmark stays distributed: fingerprints of both sides meet in a shuffle, and only candidate
documents and items travel again to be compared. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textwork as T
from tidemark.session import ship, staged

WINDOW = 10
GRAM = 5
#: A benchmark of at most so many bytes is broadcast; its words take about three times that in a worker.
BROADCAST_BYTES = 12_000_000
#: Words and their pattern for Spark's own functions, for texts of either case.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ADDED = {"n_words": "long", "hit_spans": "array<struct<start:long,end:long>>", "items": "array<string>"}


def winnow(hashes: np.ndarray, offsets: np.ndarray, window: int = WINDOW, k: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, fingerprint, text) of the k-grams that some window of `window` words keeps."""
    g = T.grams(hashes, k)
    width = window - k + 1
    at, owner = T.within(offsets, window)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    best, where = g[at + width - 1], at + width - 1
    for j in range(width - 2, -1, -1):  # right to left, strictly smaller: the rightmost minimum stays
        smaller = g[at + j] < best
        best, where = np.where(smaller, g[at + j], best), np.where(smaller, at + j, where)
    fresh = np.ones(len(where), bool)
    fresh[1:] = (where[1:] != where[:-1]) | (owner[1:] != owner[:-1])
    return where[fresh], best[fresh], owner[fresh]


def _same_runs(words: T.Words, p: int, other: T.Words, q: int, n: int, least: int) -> list[tuple[int, int]]:
    """Runs of at least `least` equal words between words[p:p+n] and other[q:q+n], by hash and then by bytes."""

    def runs(same: np.ndarray) -> list[tuple[int, int]]:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
        return [(a, b) for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True) if b - a >= least]

    same = words.hashes[p : p + n] == other.hashes[q : q + n]
    out = runs(same)
    if any(words.word(p + i) != other.word(q + i) for a, b in out for i in range(a, b)):
        out = runs(same & np.array([words.word(p + i) == other.word(q + i) for i in range(n)]))
    return out


class Block:
    """Fingerprints of several items, sorted, with the places where each occurs."""

    def __init__(self, ids: list[str], texts: list[bytes], window: int, k: int):
        self.ids, self.window, self.k = ids, window, k
        self.words = words = T.Words(texts, T.ALNUM)
        self.hashes, self.offsets = words.hashes, words.offsets
        counts = np.diff(self.offsets)
        at, prints, owner = winnow(self.hashes, self.offsets, window, k)
        order = np.argsort(prints, kind="stable")
        self.prints, self.at, self.owner = prints[order], at[order], owner[order]
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in np.unique(counts[(counts > 0) & (counts < window)]):
            items = np.flatnonzero(counts == n)
            whole = np.array([T.grams(self.hashes[self.offsets[i] : self.offsets[i + 1]], int(n))[0] for i in items], np.uint64)
            order = np.argsort(whole, kind="stable")
            self.short[int(n)] = whole[order], items[order]

    def search(self, words: T.Words) -> dict[int, tuple[list[tuple[int, int]], set[int]]]:
        """For each text with hits: its hit spans (word numbers in the text) and its items."""
        found: dict[int, tuple[list[tuple[int, int]], set[int]]] = {}
        if len(self.prints):
            at, prints, owner = winnow(words.hashes, words.offsets, self.window, self.k)
            low = np.searchsorted(self.prints, prints)
            hits = np.flatnonzero(self.prints[np.minimum(low, len(self.prints) - 1)] == prints)
            done: set[tuple[int, int, int]] = set()
            for h in hits:
                d, p, i = int(owner[h]), int(at[h]), int(low[h])
                begin, end = int(words.offsets[d]), int(words.offsets[d + 1])
                while i < len(self.prints) and self.prints[i] == prints[h]:
                    item, q = int(self.owner[i]), int(self.at[i])
                    i += 1
                    first, last = int(self.offsets[item]), int(self.offsets[item + 1])
                    back, ahead = min(p - begin, q - first), min(end - p, last - q)
                    if (d, item, p - q) in done:
                        continue
                    done.add((d, item, p - q))
                    for a, b in _same_runs(words, p - back, self.words, q - back, back + ahead, self.window):
                        spans, items = found.setdefault(d, ([], set()))
                        spans.append((p - back + a - begin, p - back + b - begin))
                        items.add(item)
        for n, (whole, items_of) in self.short.items():
            g = T.grams(words.hashes, n)
            at, owner = T.within(words.offsets, n)
            if not len(at):
                continue
            mine = g[at]
            low = np.searchsorted(whole, mine)
            for h in np.flatnonzero(whole[np.minimum(low, len(whole) - 1)] == mine):
                d, i, first = int(owner[h]), int(low[h]), int(at[h])
                p = first - int(words.offsets[d])
                while i < len(whole) and whole[i] == mine[h]:
                    item = int(items_of[i])
                    i += 1
                    if _same_runs(words, first, self.words, int(self.offsets[item]), n, n):
                        spans, items = found.setdefault(d, ([], set()))
                        spans.append((p, p + n))
                        items.add(item)
        return found


def _items(benchmark: DataFrame, item_id: str, item_text: str) -> DataFrame:
    return benchmark.select(F.coalesce(F.col(T.quoted(item_id)).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(T.quoted(item_text)), F.lit("")).alias("text"))


def find_leaks(
    documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, k: int = GRAM, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """documents with n_words (long), hit_spans (array of start and end word numbers, merged) and items (sorted array).

    Columns of those names in documents, in any case, are replaced. Words: runs of characters other than ASCII
    non-alphanumerics, A-Z lower-cased. An item of fewer words than `window` (but not none) must occur whole.
    Null and empty texts have no words and no hits; null or empty items match nothing; an item with a null id
    counts under the empty id; repeated documents are each treated alike; an empty table gives an empty one. Ids of
    documents are not looked at. A text is held whole in one task, with about ten times its bytes.
    """
    spark = documents.sparkSession
    ship(spark)
    T.small_batches(spark)
    items = _items(benchmark, item_id, item_text)
    base = documents.select(*T.named(T.others(documents, ADDED)))
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("id") + 8)).first()[0] or 0
    if size > broadcast_bytes:
        return _by_shuffle(base, staged(items, "leak-items"), text_col, window, k)
    rows = items.collect()  # broadcast_bytes at most
    name = T.spare("benchmark")
    shared = spark.sparkContext.broadcast(([r["id"] for r in rows], [r["text"].encode() for r in rows]))
    target = base.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in ADDED.items()]).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = T.held("leaks", name, lambda: Block(*shared.value, window, k))
        for batch in batches:
            yield _scan_batch(batch, block, text_col)

    return base.mapInArrow(scan, target)


def _prints(texts: list[bytes], window: int, k: int, short: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, text number): winnowed fingerprints, and the n-grams of each length in `short`."""
    words = T.Words(texts, T.ALNUM)
    _, prints, owner = winnow(words.hashes, words.offsets, window, k)
    found = [(prints, owner)]
    for n in short:
        at, of = T.within(words.offsets, n)
        found.append((T.mix(T.grams(words.hashes, n)[at] + np.uint64(n)) if len(at) else np.zeros(0, np.uint64), of))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]).astype(np.int64)


def _by_shuffle(base: DataFrame, items: DataFrame, text_col: str, window: int, k: int) -> DataFrame:
    """find_leaks for a benchmark that is too large to broadcast. Documents with one text are one candidate."""
    n_of = F.regexp_count("text", F.lit(WORD_PATTERN))
    short = sorted(r["n"] for r in items.select(n_of.alias("n")).filter(F.col("n").between(1, window - 1)).distinct().collect())  # window - 1 numbers at most

    def rows(batches: Iterator[pa.RecordBatch], of_items: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = T.as_bytes(batch.column("text")), batch.column("key").to_numpy()
            for a, b in T.chunked([len(t) + 1 for t in texts]):
                if of_items:  # an item stands under its winnowed fingerprints, or as a whole if it is short
                    counts = np.diff(T.Words(texts[a:b], T.ALNUM).offsets)
                    groups = [(np.flatnonzero(counts >= window), [])] + [(np.flatnonzero(counts == n), [n]) for n in short]
                else:
                    groups = [(np.arange(b - a), short)]
                for who, lengths in groups:
                    prints, owner = _prints([texts[a + i] for i in who], window, k, lengths)
                    key = keys[a:b][who][owner]
                    pairs = np.unique(np.stack([prints.view(np.int64), key]), axis=1)
                    for i in range(0, pairs.shape[1], 100_000):
                        yield pa.RecordBatch.from_arrays([pa.array(pairs[0, i : i + 100_000]), pa.array(pairs[1, i : i + 100_000])], ["print", "key"])

    text = F.coalesce(F.col(T.quoted(text_col)), F.lit(""))
    numbered = staged(items.withColumn("item", F.monotonically_increasing_id()), "leak-numbered")
    of_items = numbered.select(F.col("item").alias("key"), "text").mapInArrow(lambda it: rows(it, True), "print long, key long").withColumnRenamed("key", "item")
    of_docs = base.select(F.xxhash64(text).alias("key"), text.alias("text")).mapInArrow(lambda it: rows(it, False), "print long, key long").distinct()
    pairs = staged(of_docs.join(of_items, "print").select("key", "item").distinct(), "leak-pairs")
    wanted = base.select(F.xxhash64(text).alias("key"), text.alias("text")).join(pairs.select("key").distinct(), "key", "left_semi").distinct()
    asked = pairs.join(wanted, "key").join(numbered.select("item", F.col("id").alias("item_id"), F.col("text").alias("item_text")), "item")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            spans, keep = [], []
            for text, ident, item in zip(T.as_bytes(batch.column("text")), batch.column("item_id").to_pylist(), T.as_bytes(batch.column("item_text")), strict=True):
                got, _ = Block([ident], [item], window, k).search(T.Words([text], T.ALNUM)).get(0, ([], set()))
                spans.append([{"start": x, "end": y} for x, y in merge_spans(got)])
                keep.append(bool(got))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("text"), batch.column("item_id"), pa.array(spans, pa.list_(pair))], ["key", "text", "item_id", "spans"]).filter(pa.array(keep, pa.bool_()))

    found = asked.select("key", "text", "item_id", "item_text").mapInArrow(verify, "key long, text string, item_id string, spans array<struct<start:long,end:long>>")
    # Spans of one text over all its items, in order, merged where they touch.
    every = F.array_sort(F.flatten(F.collect_list("spans")))
    grouped = found.groupBy("key", "text").agg(every.alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items"))
    start = F.expr("array(spans[0])")
    merged = F.aggregate(
        F.slice("spans", 2, 2**30), start,
        lambda out, s: F.when(s["start"] <= F.element_at(out, -1)["end"], F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(F.element_at(out, -1)["start"].alias("start"), F.greatest(F.element_at(out, -1)["end"], s["end"]).alias("end"))))).otherwise(F.concat(out, F.array(s))),
    )
    key, other, hits, names = (T.spare(x) for x in ("key", "text", "spans", "items"))
    right = staged(grouped.select(F.col("key").alias(key), F.col("text").alias(other), merged.alias(hits), F.col("items").alias(names)), "leak-hits")
    joined = base.join(right, (F.xxhash64(text) == F.col(key)) & (text == F.col(other)), "left")
    none = {"hit_spans": hits, "items": names}
    return joined.select(
        *T.named(base.columns), F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("n_words"),
        *[F.coalesce(F.col(none[c]), F.array().cast(ADDED[c])).alias(c) for c in ("hit_spans", "items")],
    )


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return merged


def _scan_batch(batch: pa.RecordBatch, block: Block, text_col: str) -> pa.RecordBatch:
    texts = T.as_bytes(batch.column(text_col))
    counts, spans, items = [], [], []
    for a, b in T.chunked([len(t) + 1 for t in texts]):
        words = T.Words(texts[a:b], T.ALNUM)
        found = block.search(words)
        counts.extend(np.diff(words.offsets).tolist())
        for i in range(b - a):
            s, hit = found.get(i, ([], set()))
            spans.append(merge_spans(s))
            items.append({block.ids[x] for x in hit})
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    columns = [
        pa.array(counts, pa.int64()), pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], pa.list_(pair)),
        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *ADDED])


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit, with the columns they came with.

    Null and empty texts stay, as do all rows of an empty benchmark; repeated rows stay or go together; a column named
    like one that find_leaks adds keeps its values.
    """
    names = {c: T.spare("kept") for c in documents.columns if c.lower() in ADDED}
    out = find_leaks(documents.withColumnsRenamed(names), benchmark, **options).filter(F.size("hit_spans") == 0)
    return out.select(*[F.col(T.quoted(names.get(c, c))).alias(c) for c in documents.columns])
