"""Improbable-feature digests: fingerprints whose bit overlap tells how much of two texts is the same.

Every window of 32 bytes has an entropy; entropy levels are ranked by how rarely windows of the whole corpus have
them (a histogram over all documents). Of each 32 windows in a row the one of rarest level is the popular one
(equal levels: smallest hash), and windows that are popular often enough are features. Besides these, every text has
up to 64 base features, picked by hash among its windows of 8 bytes, then of 4, 2 and 1 where there are fewer: so a
text of any size and any entropy has features, and there is no size at which other features take over.

Features go into two chains of Bloom filters of 2,048 bits, five bits a feature, 160 features a filter: base features
into the first filter, improbable ones into the chain behind it. Chains are compared filter by filter: shared bits
beyond those expected by chance, as a share of the most that there could be. The likeness of two texts is the mean of
both chains' likenesses, improbable features counting one each and the base filter BASE_WEIGHT in all.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textwork as T
from tidemark.llm.order import followed, ordered
from tidemark.session import ship

WINDOW = 32
POPULAR = 32
#: How many of the runs of POPULAR windows a feature must win.
LEAST_WINS = 8
FILTER_BITS, FEATURE_BITS, FILTER_FEATURES = 2048, 5, 160
LEVELS = 128
#: Bytes of texts that are fingerprinted together.
PRINT_BYTES = 1 << 18
#: Windows below this level (1.5 of 5 bits) are runs of few characters and never features.
LEAST_LEVEL = int(1.5 / 5 * LEVELS)
#: Base features of a text: the windows of these widths with the smallest keys, wider ones first.
BASE_WIDTHS, BASE_FEATURES = (8, 4, 2, 1), 64
#: What the base filter weighs, in improbable features.
BASE_WEIGHT = 8

_COUNTS = np.arange(WINDOW + 1, dtype=np.float64)
_WEIGHT = np.round(_COUNTS * np.log2(np.maximum(_COUNTS, 1)) * 2**20).astype(np.int64)
#: What one more equal byte adds to the sum of c log c; whole numbers, so that equal windows have equal sums.
_STEP = np.diff(_WEIGHT)


def levels(buf: np.ndarray) -> np.ndarray:
    """The entropy level of the window that starts at each byte (all but the last WINDOW - 1)."""
    n = len(buf) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    before, after = np.zeros(len(buf), np.uint8), np.zeros(len(buf), np.uint8)
    for j in range(1, WINDOW):
        same = (buf[j:] == buf[:-j]).view(np.uint8)
        before[j:] += same
        after[:-j] += same
    total = np.cumsum(_STEP[before])
    total[WINDOW:] -= np.cumsum(_STEP[after])[: len(buf) - WINDOW]
    entropy = np.log2(WINDOW) - total[WINDOW - 1 :] / (2**20 * WINDOW)
    return np.minimum((entropy * (LEVELS / np.log2(WINDOW))).astype(np.int64), LEVELS - 1)


def _inside(offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes at which a window of `width` bytes starts and stays in its text, and the text of each; separators follow texts."""
    ends = offsets.copy()
    counts = np.maximum(np.diff(ends) - 1 - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(len(owner)) - first[owner] + offsets[:-1][owner], owner


def histogram(texts: list[bytes]) -> np.ndarray:
    buf, at = T.join_texts(texts)
    where, _ = _inside(at, WINDOW)
    return np.bincount(levels(buf)[where], minlength=LEVELS) if len(where) else np.zeros(LEVELS, np.int64)


def entropy_ranks(df: DataFrame, text_col: str = "text") -> list[int]:
    """Rank of each entropy level, rarest first, over all windows of all texts. LEVELS numbers come to the driver."""
    ship(df.sparkSession)
    T.small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for batch in batches:
            texts = T.as_bytes(batch.column(0))
            for a, b in T.chunked([len(t) + 1 for t in texts]):
                total += histogram(texts[a:b])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS, dtype=np.int32)), pa.array(total)], ["level", "n"])

    counts = np.zeros(LEVELS, np.int64)
    for r in df.select(text_col).mapInArrow(run, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect():
        counts[r["level"]] = r["n"]
    ranks = np.empty(LEVELS, np.int64)
    ranks[np.lexsort((np.arange(LEVELS), counts))] = np.arange(LEVELS)
    return ranks.tolist()


def _eights(buf: np.ndarray, width: int = 8) -> np.ndarray:
    """The hash of the `width` bytes (8 at most) that begin at each byte; bytes behind the buffer count as zeros."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)]).tobytes()
    chunk = np.ndarray((len(buf),), "<u8", padded, 0, (1,)) & np.uint64((1 << (8 * width)) - 1)
    return T.mix(chunk + np.uint64(width * int(T.STEP) % 2**64))


def _windows(eights: np.ndarray) -> np.ndarray:
    """The hash of the window of WINDOW bytes at each byte, from those of its four parts (all but the last WINDOW - 1)."""
    n = max(0, len(eights) - WINDOW + 1)
    out = eights[:n].copy()
    for j in range(8, WINDOW, 8):
        out *= T.STEP
        out += eights[j : n + j]
    return T.mix(out)


def improbable(buf: np.ndarray, at: np.ndarray, eights: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of the improbable features of texts in one buffer, in order."""
    runs, _ = _inside(at, WINDOW + POPULAR - 1)
    if not len(runs):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    none = np.iinfo(np.uint64).max
    level, hashes = levels(buf), _windows(eights)
    # Windows across two texts have keys too, but no run of one text holds them.
    key = (ranks.astype(np.uint64) << np.uint64(56))[level] | ((hashes >> np.uint64(40)) << np.uint64(32)) | np.arange(len(level), dtype=np.uint64)
    key[level < LEAST_LEVEL] = none
    least, width = key, 1
    while width < POPULAR:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    best = least[runs]
    best = (best[best != none] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    chosen = np.flatnonzero(np.bincount(best, minlength=len(buf)) >= LEAST_WINS)
    return hashes[chosen], np.searchsorted(at, chosen, side="right") - 1


def base(buf: np.ndarray, at: np.ndarray, eights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of the base features: of each text the BASE_FEATURES windows that come first by width and hash."""
    every = np.iinfo(np.uint64).max
    sizes = np.diff(at) - 1
    text_of = np.repeat(np.arange(len(sizes)), sizes + 1)
    room = at[1:][text_of] - 1 - np.arange(len(buf))
    # Long texts are thinned before the sort, to about four times as many windows as are kept.
    limit = np.where(sizes > 4 * BASE_FEATURES, (2.0**64 - 2**12) * np.minimum(1.0, 4 * BASE_FEATURES / np.maximum(sizes, 1)), float(2**64 - 2**12)).astype(np.uint64)
    limit[sizes <= 4 * BASE_FEATURES] = every

    def windows(rank: int, texts: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, text) of the distinct windows, sorted; the top two bits of a key hold the width's rank: wider ones come first."""
        width = BASE_WIDTHS[rank]
        hashes = eights if width == 8 else _eights(buf, width)
        near = (room >= width) & (hashes <= np.repeat(limit, sizes + 1))
        where = np.flatnonzero(near if texts.all() else near & texts[text_of])
        key, owner = (hashes[where] >> np.uint64(2)) | np.uint64(rank << 62), text_of[where]
        order = np.lexsort((key, owner))
        key, owner = key[order], owner[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        return key[fresh], owner[fresh]

    count = lambda owner: np.bincount(owner, minlength=len(sizes))
    key, owner = windows(0, np.ones(len(sizes), bool), limit)
    again = (count(owner) < BASE_FEATURES) & (limit < every)  # long, but of few different windows
    if again.any():
        whole = windows(0, again, np.full(len(sizes), every))
        stay = ~again[owner]
        key, owner = np.concatenate([key[stay], whole[0]]), np.concatenate([owner[stay], whole[1]])
    for rank in range(1, len(BASE_WIDTHS)):
        few = count(owner) < BASE_FEATURES
        if few.any():
            more = windows(rank, few, np.full(len(sizes), every))
            key, owner = np.concatenate([key, more[0]]), np.concatenate([owner, more[1]])
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order].astype(np.int64)
    first = np.arange(len(owner)) - np.searchsorted(owner, owner, side="left") < BASE_FEATURES
    return T.mix(key[first]), owner[first]


Digest = tuple[np.ndarray, np.ndarray]


def features(texts: list[bytes], ranks: np.ndarray) -> list[Digest]:
    """(base features, improbable features) of each text: hashes, in order, each once."""
    buf, at = T.join_texts(texts)
    eights = _eights(buf)

    def split(hashes: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
        # Each hash of a text once, where it comes first.
        order = np.lexsort((np.arange(len(hashes)), hashes, owner))
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        stay = np.sort(order[fresh])
        cuts = np.searchsorted(owner[stay], np.arange(len(texts) + 1))
        return [hashes[stay[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]

    return list(zip(split(*base(buf, at, eights)), split(*improbable(buf, at, eights, ranks)), strict=True))


def chain(hashes: np.ndarray) -> np.ndarray:
    """The chained filters of a list of features: (filters, FILTER_BITS / 8) bytes."""
    n = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((n, FILTER_BITS), np.uint8)
    if len(hashes):
        which = np.arange(len(hashes)) // FILTER_FEATURES
        for j in range(FEATURE_BITS):
            bits[which, ((hashes >> np.uint64(11 * j)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1)


@dataclass
class Print:
    """A fingerprint: the base filter and its features' number, and the chain of improbable features and theirs."""

    few: np.ndarray
    n_few: int
    rare: np.ndarray
    n_rare: int

    @classmethod
    def of(cls, digest: Digest) -> Print:
        return cls(chain(digest[0]), len(digest[0]), chain(digest[1]), len(digest[1]))

    def text(self) -> str:
        return f"2:{self.n_few}:{self.n_rare}:{base64.b64encode(self.few.tobytes() + self.rare.tobytes()).decode()}"

    @classmethod
    def parse(cls, text: str) -> Print:
        _, n_few, n_rare, data = text.split(":", 3)
        filters = np.frombuffer(base64.b64decode(data), np.uint8).reshape(-1, FILTER_BITS // 8)
        cut = -(-int(n_few) // FILTER_FEATURES)
        return cls(filters[:cut], int(n_few), filters[cut:], int(n_rare))


def _overlap(x: np.ndarray, n: int, y: np.ndarray, m: int) -> float:
    """0 to 1: how much of the shorter chain's filters is found in the best filter of the other; 0 if one is empty."""
    if not n or not m:
        return 0.0
    if len(y) < len(x) or (len(x) == len(y) and m < n):
        x, y, n, m = y, x, m, n
    ones_y = np.bitwise_count(y).sum(axis=1, dtype=np.int64)
    total = 0.0
    for i, f in enumerate(x):
        ones = int(np.bitwise_count(f).sum())
        shared = np.bitwise_count(y & f).sum(axis=1, dtype=np.int64)
        chance = ones * ones_y / FILTER_BITS
        most = np.minimum(ones, ones_y)
        best = np.where(most > chance, (shared - chance) / np.maximum(most - chance, 1e-9), 0.0).max()
        total += min(FILTER_FEATURES, n - i * FILTER_FEATURES) * min(1.0, max(0.0, float(best)))
    return total / n


def compare(a: Print, b: Print) -> float:
    """0 to 1, the same either way. A text without features (an empty one) has 0 with any other and 1 with another empty one."""
    if not a.n_few or not b.n_few:
        return float(a.n_few == b.n_few)
    rare = min(a.n_rare, b.n_rare)
    few = _overlap(a.few, a.n_few, b.few, b.n_few)
    return (rare * _overlap(a.rare, a.n_rare, b.rare, b.n_rare) + BASE_WEIGHT * few) / (rare + BASE_WEIGHT)


def likeness(a: str | None, b: str | None) -> float | None:
    """The likeness of two fingerprints in text form: 1 for equal ones, null if one is null."""
    if a is None or b is None:
        return None
    return 1.0 if a == b else compare(Print.parse(a), Print.parse(b))


def fingerprints(df: DataFrame, columns: dict[str, str], ranks: list[int]) -> DataFrame:
    """df with a fingerprint column (value of `columns`) for each text column (its key).

    The fingerprint is a string "version:base features:improbable features:filters in base64". Null counts as the
    empty text, which has no features. Equal texts have equal fingerprints, repeated rows too. Columns of the added
    names, in any case, are replaced. An empty table stays empty. A text is held whole in one task, with about
    60 times its bytes.
    """
    ship(df.sparkSession)
    T.small_batches(df.sparkSession)
    rest = df.select(*T.named(T.others(df, columns.values())))
    target = rest.select("*", *[F.lit("").alias(n) for n in columns.values()]).schema
    table = np.array(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for source in columns:
                texts, out = T.as_bytes(batch.column(source)), []
                for a, b in T.chunked([len(t) + 1 for t in texts], PRINT_BYTES):
                    out += [Print.of(x).text() for x in features(texts[a:b], table)]
                made.append(pa.array(out, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *columns.values()])

    return rest.mapInArrow(run, target)


def likenesses(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """df with a double column (key of `pairs`) for each two fingerprint columns.

    Null if one of them is null. Columns of the added names, in any case, are replaced unless they are compared.
    """
    ship(df.sparkSession)
    rest = df.select(*T.named(T.others(df, pairs)))
    target = rest.select("*", *[F.lit(0.0).alias(n) for n in pairs]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [pa.array([likeness(x, y) for x, y in zip(batch.column(a).to_pylist(), batch.column(b).to_pylist(), strict=True)], pa.float64()) for a, b in pairs.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *pairs])

    return rest.mapInArrow(run, target)


def compare_next(df: DataFrame, ranks: list[int], edit: Callable[[str, str], str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text against the next one (ascending id; order.with_next) and against its edit.

    edit: makes the edited text of a text and the next one. Gives id_col (long), n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next, one row for each row. Each text's fingerprint is made once, in one
    pass over the sorted shards. Null texts count as empty; rows with a null id come first; rows that repeat an id
    follow each other by text. An empty table gives an empty one.
    """
    stream = ordered(df, id_col, text_col)
    T.small_batches(df.sparkSession)
    table = np.array(ranks)
    kinds = {id_col: pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}

    def prints(texts: list[str]) -> list[Print]:
        raw, out = [t.encode() for t in texts], []
        for a, b in T.chunked([len(t) + 1 for t in raw], PRINT_BYTES):
            out += [Print.of(x) for x in features(raw[a:b], table)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Print] = {}  # of the last text of the group before, which begins the next one
        for group in followed(batches, PRINT_BYTES):
            texts = [group[0][1], *[after for _, _, after in group]]
            own = [known[texts[0]], *prints(texts[1:])] if texts[0] in known else prints(texts)
            changed = [edit(text, after) for _, text, after in group]
            made = prints(changed)
            known = {texts[-1]: own[-1]}
            columns = (
                [key for key, _, _ in group], [len(text) for _, text, _ in group], [hashlib.sha256(x.encode()).hexdigest() for x in changed], [x.text() for x in own[:-1]], [x.text() for x in made],
                [compare(x, y) for x, y in zip(own, made, strict=False)], [compare(x, y) for x, y in zip(own, own[1:], strict=False)],
            )
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds.values(), strict=True)], list(kinds))

    return stream.mapInArrow(run, f"{T.quoted(id_col)} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
