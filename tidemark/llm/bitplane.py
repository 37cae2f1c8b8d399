"""Token-id files: fixed-size id blocks, transposed into bit or byte planes, each plane compressed with zstandard.

Layout of a written folder (every table is Parquet without its own compression, so Spark's committer makes the
files whole or absent and any store that Spark reaches can hold them):

- chunks: one row a block: shard, block, first (id number in the shard), n_ids, sizes (bytes of each compressed
  plane: the chunk index within the row), planes (the compressed planes one after the other), and doc_ids and
  doc_starts (the documents that begin in the block and their first id's number in the shard).
- shards: the chunk index over all: shard, n_ids, base (ids of all shards before), n_docs.
- meta: version, width of an id in bytes, planes ("byte" or "bit"), block size, end id.

A shard is a range of document ids; shards and the documents within follow ascending doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import textwork as T
from tidemark.llm.pretokens import LibraryEncoder
from tidemark.session import ship

BLOCK_IDS = 65_536
#: Documents of a shard, about; MOST_SHARDS bounds the range borders that the driver holds.
SHARD_DOCS = 2_048
MOST_SHARDS = 50_000
CHUNKS = pa.schema([
    ("shard", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("sizes", pa.list_(pa.int32())),
    ("planes", pa.binary()), ("doc_ids", pa.binary()), ("doc_nulls", pa.binary()), ("doc_starts", pa.binary()),
])
CHUNKS_DDL = "shard long, block long, first long, n_ids long, sizes array<int>, planes binary, doc_ids binary, doc_nulls binary, doc_starts binary"


def to_planes(ids: np.ndarray, kind: str = "byte", level: int = 3) -> list[bytes]:
    """The compressed planes of a block of ids (any unsigned integer type), most significant plane last."""
    press = zstandard.ZstdCompressor(level=level)
    raw = np.ascontiguousarray(ids).astype(ids.dtype.newbyteorder("<")).view(np.uint8).reshape(len(ids), ids.dtype.itemsize)
    if kind == "bit":
        raw = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1)
        return [press.compress(p.tobytes()) for p in raw]
    return [press.compress(np.ascontiguousarray(raw[:, i]).tobytes()) for i in range(raw.shape[1])]


def from_planes(planes: list[bytes], n: int, width: int, kind: str = "byte") -> np.ndarray:
    """The ids of a block, from all its planes."""
    press = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(press.decompress(p), np.uint8) for p in planes]
    if kind == "bit":
        bits = np.unpackbits(np.stack(raw), axis=1, count=n).T
        flat = np.packbits(np.ascontiguousarray(bits), axis=1, bitorder="little")
    else:
        flat = np.stack(raw, axis=1)
    return np.ascontiguousarray(flat).reshape(-1).view(f"<u{width}")


def _encoder(path: str) -> LibraryEncoder:
    return T.held("encoder", path, lambda: LibraryEncoder(path))


def shard_borders(df: DataFrame, id_col: str, shard_docs: int = SHARD_DOCS) -> list[int]:
    """Ascending ids that cut the table into shards of about shard_docs rows (a sketch over all ids; no row travels)."""
    rows = df.count()
    shards = min(MOST_SHARDS, max(1, -(-rows // shard_docs)))
    if shards == 1:
        return []
    cuts = [i / shards for i in range(1, shards)]
    got = df.select(F.percentile_approx(F.col(id_col).cast("long"), cuts, max(10_000, 4 * shards)).alias("b")).first()["b"]
    return sorted(set(got or []))


def write_ids(
    df: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    planes: str = "byte", block_ids: int = BLOCK_IDS, shard_docs: int = SHARD_DOCS,
) -> None:
    """Encode every whole text, append end_id, and write all ids in ascending id_col order to the folder `path`.

    A null text is an empty one: its ids are the end id. Null ids come first. Rows with the same id follow each
    other in the order of their ids' bytes. An empty table writes tables without rows. Document ids are cast to long,
    as SQL casts (a string that is no number is an error); other columns are not looked at. The ids equal those of the
    library's encode() (LibraryEncoder says how). A text is held whole in one task.
    """
    if planes not in ("byte", "bit"):
        raise ValueError("planes is 'byte' or 'bit'")
    spark = df.sparkSession
    ship(spark)
    T.small_batches(spark)
    rows = df.select(F.col(T.quoted(id_col)).cast("long").alias("doc"), F.col(T.quoted(text_col)).alias("text"))
    borders = spark.sparkContext.broadcast(np.array(shard_borders(rows, "doc", shard_docs), np.int64))
    size = Tokenizer.from_file(vocabulary).get_vocab_size()
    width = 2 if max(size, end_id + 1) <= 1 << 16 else 4

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(vocabulary)
        end = np.array([end_id], f"<u{width}").tobytes()
        for batch in batches:
            docs = batch.column("doc")
            at = np.searchsorted(borders.value, docs.fill_null(-(2**63)).to_numpy(), side="right")
            texts, ids = T.as_bytes(batch.column("text")), []
            for a, b in T.chunked([len(t) for t in texts], 2 * T.CHUNK_BYTES):
                ids += [x.astype(f"<u{width}").tobytes() + end for x in own.encode_utf8(texts[a:b])]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), docs, pa.array(ids, pa.binary())], ["shard", "doc", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _ShardWriter(width, planes, block_ids)
        for batch in batches:
            shards, ids = batch.column("shard").to_pylist(), batch.column("ids").to_pylist()
            for shard, doc, packed in zip(shards, batch.column("doc").to_pylist(), ids, strict=True):
                yield from writer.add(shard, doc, packed)
        yield from writer.close()

    encoded = rows.mapInArrow(encode, "shard long, doc long, ids binary")
    ordered = encoded.repartition("shard").sortWithinPartitions("shard", F.col("doc").asc_nulls_first(), "ids")
    ordered.mapInArrow(write, CHUNKS_DDL).write.option("compression", "uncompressed").parquet(f"{path}/chunks")
    chunks = spark.read.schema(CHUNKS_DDL).parquet(f"{path}/chunks")
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"), F.sum(F.length("doc_starts") / 8).cast("long").alias("n_docs"))
    at = [(r["shard"], r["n_ids"], r["n_docs"]) for r in totals.orderBy("shard").collect()]  # MOST_SHARDS rows at most
    base, index = 0, []
    for shard, n, docs in at:
        index.append((shard, n, base, docs))
        base += n
    spark.createDataFrame(index, "shard long, n_ids long, base long, n_docs long").coalesce(1).write.parquet(f"{path}/shards")
    meta = [(1, width, planes, block_ids, end_id)]
    spark.createDataFrame(meta, "version int, width int, planes string, block_ids long, end_id long").coalesce(1).write.parquet(f"{path}/meta")


class _ShardWriter:
    """Cuts the id stream of consecutive shards into blocks; holds one block."""

    def __init__(self, width: int, kind: str, block_ids: int):
        self.width, self.kind, self.block_ids = width, kind, block_ids
        self.shard: int | None = None

    def _start(self, shard: int) -> None:
        self.shard, self.block, self.first, self.filled = shard, 0, 0, 0
        self.parts: list[bytes] = []
        self.docs: list[int | None] = []
        self.starts: list[int] = []

    def add(self, shard: int, doc: int | None, packed: bytes) -> Iterator[pa.RecordBatch]:
        if shard != self.shard:
            yield from self.close()
            self._start(shard)
        self.docs.append(doc)
        self.starts.append(self.first + self.filled)
        view = memoryview(packed)
        while len(view):
            take = min(len(view) // self.width, self.block_ids - self.filled)
            self.parts.append(bytes(view[: take * self.width]))
            self.filled += take
            view = view[take * self.width :]
            if self.filled == self.block_ids:
                yield self._flush()

    def _flush(self) -> pa.RecordBatch:
        planes = to_planes(np.frombuffer(b"".join(self.parts), f"<u{self.width}"), self.kind)
        row = {
            "shard": self.shard, "block": self.block, "first": self.first, "n_ids": self.filled, "sizes": [len(p) for p in planes], "planes": b"".join(planes),
            "doc_ids": np.array([x or 0 for x in self.docs], "<i8").tobytes(), "doc_nulls": bytes(x is None for x in self.docs), "doc_starts": np.array(self.starts, "<i8").tobytes(),
        }
        self.block, self.first, self.filled, self.parts, self.docs, self.starts = self.block + 1, self.first + self.filled, 0, [], [], []
        return pa.RecordBatch.from_pylist([row], CHUNKS)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.shard is not None and self.filled:
            yield self._flush()
        self.shard = None


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a written folder; ids: little-endian unsigned 32-bit.

    start counts the ids of all documents before. Each shard is decoded in a stream, a block at a time.
    """
    meta = spark.read.parquet(f"{path}/meta").first()
    base = {r["shard"]: r["base"] for r in spark.read.parquet(f"{path}/shards").collect()}  # MOST_SHARDS rows at most
    bases = spark.sparkContext.broadcast(base)
    width, kind = meta["width"], meta["planes"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int | None, int, bytes]] = []
        size = 0
        shard, doc, start, parts = None, None, -1, []

        def flush() -> pa.RecordBatch:
            nonlocal out, size
            made = pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([len(x[2]) // 4 for x in out], pa.int64()), pa.array([x[2] for x in out], pa.binary())],
                ["doc_id", "start", "n_tokens", "ids"],
            )
            out, size = [], 0
            return made

        def end_document() -> None:
            nonlocal size, start, parts
            if start >= 0:
                ids = b"".join(parts)
                out.append((doc, bases.value[shard] + start, ids))
                size += len(ids)
            start, parts = -1, []

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    end_document()
                    shard = row["shard"]
                cuts = np.concatenate([[0], np.cumsum(row["sizes"])])
                planes = [row["planes"][a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
                ids = from_planes(planes, row["n_ids"], width, kind).astype("<u4").tobytes()
                docs, nulls, starts = np.frombuffer(row["doc_ids"], "<i8").tolist(), row["doc_nulls"], np.frombuffer(row["doc_starts"], "<i8").tolist()
                at = 0
                for i, begin in enumerate(starts):
                    cut = 4 * (begin - row["first"])
                    parts.append(ids[at:cut])
                    end_document()
                    doc, start, at = None if nulls[i] else docs[i], begin, cut
                    if size > 4 * T.CHUNK_BYTES:
                        yield flush()
                parts.append(ids[at:])
        end_document()
        yield flush()

    chunks = spark.read.schema(CHUNKS_DDL).parquet(f"{path}/chunks")
    return chunks.repartition("shard").sortWithinPartitions("shard", "block").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
