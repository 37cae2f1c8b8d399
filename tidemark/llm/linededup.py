"""Line deduplication through a sharded minimal perfect hash.

1. One pass over the texts turns each block of documents (an Arrow batch) into one row: its distinct line
   hashes (128 bits), the smallest document holding each in the block, and which document holds which. The
   rows are written once to the shared folder; from here on no line travels.
2. The distinct hashes of all blocks are reduced to (owner, count) and dealt to shards by hash. Each shard
   builds a minimal perfect hash (levels of bit arrays in which the keys that land alone are placed) whose
   slots index compact arrays: a 32-bit fingerprint, a document count and the owner, the smallest doc_id.
3. Every block sends each of its distinct hashes once to the hash's shard, where the arrays are probed in a
   stream. A line that a third of all documents hold is asked for once a block, not once a document.
4. Answers return to their block, which decides for its documents; decisions meet the texts again by document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textwork as T
from tidemark.session import ship, staged

#: Keys with fewer code points are never dropped.
MIN_CHARS = 10
#: Distinct keys of one index shard, about (about 20 bytes each in memory while it is probed).
SHARD_KEYS = 250_000
#: Keys that a task writes, or builds the index of, about.
TASK_KEYS = 1_000_000
STRIP = b" \t\n\x0b\x0c\r"
#: Bits per key and level of the perfect hash; more bits make fewer levels.
GAMMA = 2.0


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The 16-byte hash of the line's key, or None if the key is too short."""
    key = line.strip(STRIP).translate(T.LOWER_BYTES)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit keys given as two uint64 arrays: levels of bit arrays and ranks."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ranks = np.cumsum(bits, dtype=np.int64) - bits

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        return (T.mix(a ^ T.mix(b + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(a):
            size = max(64, int(GAMMA * len(a)))
            slot = cls._slot(a, b, len(sizes), size)
            alone = np.bincount(slot, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = ~alone[slot]
            a, b = a[left], b[left]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key, in 0..n-1; -1 where no level has one (only keys outside the set)."""
        out = np.full(len(a), -1, np.int64)
        todo = np.arange(len(a))
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            at = self._slot(a[todo], b[todo], level, size) + self.starts[level]
            hit = self.bits[at]
            out[todo[hit]] = self.ranks[at[hit]]
            todo = todo[~hit]
        return out


BLOCK = "block long, n_keys long, docs binary, texts binary, counts binary, uses binary, keys binary, owners binary, holders binary"
INDEX = "shard long, n_keys long, sizes binary, bits binary, prints binary, counts binary, owners binary"


def _block_rows(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId() if TaskContext.get() else 0, 0
    for batch in batches:
        docs = batch.column("__doc").to_numpy(zero_copy_only=False)
        texts = T.as_bytes(batch.column("__text"))
        slots: dict[bytes, int] = {}
        owners: list[int] = []
        holders: list[int] = []
        uses: list[int] = []
        counts: list[int] = []
        for doc, text in zip(docs.tolist(), texts, strict=True):
            mine = {h for line in text.split(b"\n") if (h := line_key(line, min_chars))}
            counts.append(len(mine))
            for h in mine:
                k = slots.setdefault(h, len(slots))
                uses.append(k)
                if k == len(owners):
                    owners.append(doc)
                    holders.append(1)
                else:
                    owners[k] = min(owners[k], doc)
                    holders[k] += 1
        row = {
            "block": (part << 32) + number, "n_keys": len(slots), "docs": np.asarray(docs, np.int64).tobytes(),
            "texts": batch.column("__hash").to_numpy(zero_copy_only=False).tobytes(), "counts": np.array(counts, np.int32).tobytes(),
            "uses": np.array(uses, np.int32).tobytes(), "keys": b"".join(slots), "owners": np.array(owners, np.int64).tobytes(),
            "holders": np.array(holders, np.int32).tobytes(),
        }
        number += 1
        yield pa.RecordBatch.from_pylist([row], _arrow(BLOCK))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _keys(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    pair = np.frombuffer(blob, np.uint64).reshape(-1, 2)
    return pair[:, 0].copy(), pair[:, 1].copy()


def _key_rows(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Every distinct key of every block, with its shard and its number in the block."""
    for batch in batches:
        for row in batch.to_pylist():
            a, b = _keys(row["keys"])
            yield pa.RecordBatch.from_arrays(
                [pa.array((a % np.uint64(shards)).astype(np.int64)), pa.array(np.full(len(a), row["block"])), pa.array(np.arange(len(a))), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                 pa.array(np.frombuffer(row["owners"], np.int64)), pa.array(np.frombuffer(row["holders"], np.int32).astype(np.int64))],
                ["shard", "block", "k", "a", "b", "owner", "n"],
            )


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Slices of the batches with one value of the column each, and whether the value is new."""
    last = None
    for batch in batches:
        values = batch.column(column).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for x, y in zip(edges, edges[1:], strict=False):
            if y > x:
                value = int(values[x])
                yield value, value != last, batch.slice(x, y - x)
                last = value


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def built(shard: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        a, b = (rows.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
        index = PerfectHash.build(a, b)
        order = np.empty(len(a), np.int64)
        order[index.find(a, b)] = np.arange(len(a))
        count = np.minimum(rows.column("n").to_numpy(), 2**32 - 1)
        row = {
            "shard": shard, "n_keys": len(a), "sizes": np.array(index.sizes, np.int64).tobytes(), "bits": np.packbits(index.bits).tobytes(),
            "prints": (b >> np.uint64(32)).astype(np.uint32)[order].tobytes(), "counts": count.astype(np.uint32)[order].tobytes(), "owners": rows.column("owner").to_numpy()[order].tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], _arrow(INDEX))

    parts: list[pa.RecordBatch] = []
    shard = -1
    for value, fresh, rows in _runs(batches, "shard"):
        if fresh and parts:
            yield built(shard, parts)
            parts = []
        shard = value
        parts.append(rows)
    if parts:
        yield built(shard, parts)


def _probe_rows(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows of a shard: first its index, then the keys that blocks ask for. Out: (block, k, owner) of shared keys."""
    index = prints = counts = owners = None
    for _, fresh, rows in _runs(batches, "shard"):
        if fresh:
            row = rows.slice(0, 1).to_pylist()[0]
            sizes = np.frombuffer(row["sizes"], np.int64).tolist()
            index = PerfectHash(sizes, np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool))
            prints, counts, owners = (np.frombuffer(row[c], kind) for c, kind in (("prints", np.uint32), ("counts", np.uint32), ("owners", np.int64)))
            rows = rows.slice(1)
        if not len(rows):
            continue
        a, b = (rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in ("a", "b"))
        slot = index.find(a, b)
        good = (slot >= 0) & (slot < len(prints))
        good[good] = prints[slot[good]] == (b[good] >> np.uint64(32)).astype(np.uint32)
        good[good] = counts[slot[good]] >= min_docs
        at = np.flatnonzero(good)
        yield pa.RecordBatch.from_arrays(
            [rows.column("block").take(pa.array(at)), rows.column("k").take(pa.array(at)), pa.array(owners[slot[at]])], ["block", "k", "owner"]
        )


def _decision_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block: first the block itself, then its answers. Out: the keys that each document loses."""
    schema = pa.schema([("__doc", pa.int64()), ("__hash", pa.int64()), ("__lost", pa.binary())])

    def decided(row: dict, answers: list[pa.RecordBatch]) -> pa.RecordBatch:
        owner = np.full(row["n_keys"], -1, np.int64)
        shared = np.zeros(row["n_keys"], bool)
        for x in answers:
            k = x.column("k").to_numpy()
            owner[k], shared[k] = x.column("owner").to_numpy(), True
        docs, hashes = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["texts"], np.int64)
        uses = np.frombuffer(row["uses"], np.int32)
        of = np.repeat(np.arange(len(docs)), np.frombuffer(row["counts"], np.int32))
        lost = np.flatnonzero(shared[uses] & (owner[uses] != docs[of]))
        out: dict[int, list[bytes]] = {}
        for i in lost.tolist():
            k = int(uses[i])
            out.setdefault(int(of[i]), []).append(row["keys"][16 * k : 16 * k + 16])
        return pa.RecordBatch.from_arrays([pa.array(docs[list(out)]), pa.array(hashes[list(out)]), pa.array([b"".join(x) for x in out.values()], pa.binary())], schema=schema)

    row, answers = None, []
    for _, fresh, rows in _runs(batches, "block"):
        if fresh:
            if row is not None and answers:
                yield decided(row, answers)
            row, answers = rows.slice(0, 1).to_pylist()[0], []
            rows = rows.slice(1)
        if len(rows):
            answers.append(rows)
    if row is not None and answers:
        yield decided(row, answers)


def _nulls(df: DataFrame, ddl: str) -> DataFrame:
    """df's columns in the order of ddl, null where it has none."""
    have = set(df.columns)
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(k).alias(n) for n, k in (x.split() for x in ddl.split(", "))])


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = 2, shard_keys: int = SHARD_KEYS) -> DataFrame:
    r"""df with n_lines, n_dropped (long) and kept_text; columns of those names, in any case, are replaced.

    A text splits at \n. A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of
    at least min_chars code points that at least min_docs documents hold lose their lines everywhere but in the
    smallest id that holds them. A null or empty text is one empty line. Rows with a null id neither own nor share
    lines and stay whole. Rows that repeat an id count as one document for ownership: a line that only they hold
    stays in each; for min_docs above 2 each such row adds to the count. An empty table gives an empty one. Ids are
    cast to long, as SQL casts (a string that is no number is an error). A text is held whole in one task.
    """
    spark = df.sparkSession
    ship(spark)
    T.small_batches(spark)
    base = df.select(*T.named(T.others(df, ("n_lines", "n_dropped", "kept_text"))))
    doc, text_hash, gone = T.spare("doc"), T.spare("hash"), T.spare("lost")
    keyed = base.withColumns({doc: F.col(T.quoted(id_col)).cast("long"), text_hash: F.xxhash64(F.col(T.quoted(text_col)))})
    source = keyed.filter(F.col(doc).isNotNull()).select(F.col(doc).alias("__doc"), F.col(text_hash).alias("__hash"), F.col(T.quoted(text_col)).alias("__text"))
    blocks = staged(source.mapInArrow(lambda it: _block_rows(it, min_chars), BLOCK), "line-blocks")
    total = blocks.agg(F.sum("n_keys")).first()[0] or 0
    shards = max(1, -(-total // shard_keys))
    rows = blocks.select("block", "keys", "owners", "holders").mapInArrow(lambda it: _key_rows(it, shards), "shard long, block long, k long, a long, b long, owner long, n long")
    keys = staged(rows, "line-keys", total, TASK_KEYS)  # they are read twice: for the index, and to ask it
    distinct = keys.groupBy("shard", "a", "b").agg(F.min("owner").alias("owner"), F.sum("n").alias("n"))
    index = staged(distinct.repartition("shard").sortWithinPartitions("shard").mapInArrow(_index_rows, INDEX), "line-index", total, TASK_KEYS)
    asked = "shard long, ask int, block long, k long, a long, b long, n_keys long, sizes binary, bits binary, prints binary, counts binary, owners binary"
    stream = _nulls(index.withColumn("ask", F.lit(0)), asked).unionByName(_nulls(keys.withColumn("ask", F.lit(1)), asked))
    answers = stream.repartition("shard").sortWithinPartitions("shard", "ask").mapInArrow(lambda it: _probe_rows(it, min_docs), "block long, k long, owner long")
    back = "block long, ask int, k long, owner long, n_keys long, docs binary, texts binary, counts binary, uses binary, keys binary"
    meet = _nulls(blocks.withColumn("ask", F.lit(0)), back).unionByName(_nulls(answers.withColumn("ask", F.lit(1)), back))
    lost = meet.repartition("block").sortWithinPartitions("block", "ask").mapInArrow(_decision_rows, "__doc long, __hash long, __lost binary")
    lost = lost.groupBy("__doc", "__hash").agg(F.max("__lost").alias("__lost"))
    mine = lost.withColumnsRenamed({"__doc": doc, "__hash": text_hash, "__lost": gone})
    joined = keyed.join(mine, [doc, text_hash], "left").select(*T.named(base.columns), gone)
    target = base.select("*", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.lit("").cast("string").alias("kept_text")).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, lost in zip(T.as_bytes(batch.column(text_col)), batch.column(gone).to_pylist(), strict=True):
                lines = text.split(b"\n")
                stay = lines
                if lost:
                    dropped = {lost[i : i + 16] for i in range(0, len(lost), 16)}
                    stay = [x for x in lines if line_key(x, min_chars) not in dropped]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            names = [n for n in batch.schema.names if n != gone]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                [*names, "n_lines", "n_dropped", "kept_text"],
            )

    return joined.mapInArrow(apply, target)


def sha256_hex(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()
