"""Vectorised text primitives that run inside Arrow batches: word spans, rolling hashes, chunking.

All functions take texts as UTF-8 bytes and work on one concatenated byte buffer, so their cost is a few
numpy passes per byte and no Python object per word.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of text that are processed together; bounds the memory of the numpy passes.
CHUNK_BYTES = 1 << 20

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)

#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = LOWER.tobytes()


def _mask(members: bytes, invert: bool = False) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return ~out if invert else out


#: Word bytes after A-Z are lower-cased: 0-9, a-z and every byte of a non-ASCII character.
ALNUM = _mask(bytes([*range(48, 58), *range(97, 123), *range(128, 256)]))
#: Everything but ASCII white space.
NONSPACE = _mask(b" \t\n\x0b\x0c\r", invert=True)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 4096)
        power = np.full(size, BASE, np.uint64)
        power[0] = 1
        back = np.full(size, np.uint64(pow(int(BASE), -1, 1 << 64)), np.uint64)
        back[0] = 1
        _powers, _inverse = np.cumprod(power, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
        if size > 8 * CHUNK_BYTES:  # one very long text: don't keep its tables
            grown = _powers, _inverse
            _powers, _inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)
            return grown
    return _powers, _inverse


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over the bytes, modulo 2**64; span_hash reads substrings from them."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _tables(len(buf) + 1)[0][: len(buf)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every buf[start:end]; equal spans have equal hashes wherever they lie."""
    return mix((prefix[ends] - prefix[starts]) * _tables(len(prefix))[1][starts])


def code_points(texts: list[str]) -> np.ndarray:
    """The code points of all texts, one after the other."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)


def window_hash(prefix: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n numbers in a row, of the numbers whose prefix_hash it is; not mixed."""
    return (prefix[n:] - prefix[:-n]) * _tables(len(prefix))[1][: len(prefix) - n]


def join_texts(texts: list[bytes], separator: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts, each followed by the separator, and the start of each text in it."""
    lengths = np.fromiter((len(t) + len(separator) for t in texts), np.int64, len(texts))
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return np.frombuffer(b"".join(x for t in texts for x in (t, separator)), np.uint8), offsets


def spans(member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True; member must end with False."""
    edges = np.flatnonzero(member[1:] != member[:-1]) + 1
    if len(member) and member[0]:
        edges = np.concatenate([[0], edges])
    return edges[0::2], edges[1::2]


#: Longer words are hashed one by one; the others eight bytes at a time, all together.
LONG_WORD = 64
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def word_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every buf[start:end], each eight bytes mixed into the state: no polynomial, whose collisions can be built.

    Words of one length up to eight bytes never share a hash. What must be exact still compares bytes.
    """
    padded = np.concatenate([buf, np.zeros(8, np.uint8)]).tobytes()
    eight = np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,))
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) * BASE + STEP)
    left = np.flatnonzero(sizes <= LONG_WORD)
    for j in range(0, LONG_WORD, 8):
        left = left[sizes[left] > j]
        if not len(left):
            break
        out[left] = mix(out[left] ^ (eight[starts[left] + j] & _KEEP[np.minimum(sizes[left] - j, 8)]))
    if len(long := np.flatnonzero(sizes > LONG_WORD)):
        import xxhash  # here, since tables without long words are hashed where it is not installed
    for i in long.tolist():
        out[i] = xxhash.xxh3_64_intdigest(padded[starts[i] : ends[i]], seed=0x5BD1E995)
    return out


class Words:
    """Words of several texts: byte spans in one buffer, hashes, and offsets[i]:offsets[i+1] of text i."""

    def __init__(self, texts: list[bytes], table: np.ndarray, lower: bool = True):
        buf, at = join_texts(texts)
        self.buf = LOWER[buf] if lower else buf
        self.starts, self.ends = spans(table[self.buf])
        self.hashes = word_hash(self.buf, self.starts, self.ends)
        self.offsets = np.searchsorted(self.starts, at)

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i] : self.ends[i]].tobytes()


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive hashes (k-1 fewer than the input; empty if it is shorter)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= STEP
        out += hashes[j : n + j]
    return mix(out)


def within(offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a run of k items starts and stays in its text, and the text of each position."""
    counts = np.maximum(np.diff(offsets) - k + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(len(owner)) - first[owner] + offsets[:-1][owner], owner


def as_bytes(column: pa.Array) -> list[bytes]:
    """The column's values as bytes; null becomes empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def chunked(lengths: list[int], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of about `most` bytes in total; a longer item is a range of its own."""
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield start, len(lengths)


def small_batches(spark, rows: int = 512) -> None:
    """Bound the rows of an Arrow batch, and so the memory of a Python worker, for texts of unknown length.

    The setting is read when a plan runs, which is after the operator returned, so it stays lowered in the session.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def others(df: DataFrame, names) -> list[str]:
    """df's columns that have none of the names; like Spark, without regard to case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def named(columns: list[str]) -> list[Column]:
    return [F.col(quoted(c)) for c in columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def spare(stem: str) -> str:
    """A name for a helper column that no input has."""
    return f"__{stem}_{uuid.uuid4().hex[:12]}"


_held: dict[str, tuple[object, object]] = {}


def held(kind: str, key, make: Callable):
    """This process's one heavy state (tables of a model, a tokenizer), made anew if another is asked for.

    Python workers are used again by later stages; what an earlier one left is dropped first, and given back to the
    system, so that a worker never carries the states of several operators.
    """
    if kind not in _held or _held[kind][0] != key:
        _held.clear()
        release()
        _held[kind] = key, make()
    return _held[kind][1]


def release() -> None:
    """Give freed memory back to the system where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass
