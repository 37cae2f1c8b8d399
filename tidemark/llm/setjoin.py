"""Exact Jaccard self-join of shingle sets by partitioning the universe, and its connected classes.

Sizes fall into bands; in a band, partners differ in at most H tokens, H being a fixed share of the size. The
tokens are hashed into H + 1 segments, so two similar sets agree in a whole segment (pigeonhole): sets meet where
the hash of a segment's subset is equal. Segments that are empty tell nothing and are not spent: a set with fewer
than H + 1 telling segments spends two units on some segment instead, where it also meets sets that differ there
by one token (one-deletion neighbourhoods). The allocation takes the segments whose neighbourhoods cost the fewest
rows; they come from the first few segments of the band, for which every set also indexes its own deletions.

Texts of equal words are reduced to one node first. Buckets are then linked by stars: each set is compared with the
most popular set that it meets, which in a group of copies is the one they were made from. Buckets that still hold
several components then compare those across, in cells of bounded size, first by size and parity sketch, which bounds
the difference from below and so rules out no link.

Hashes (64 bits, T.word_hash) only find candidates. Sizes and links come from the shingles' own bytes, and nodes are
told apart by 128-bit BLAKE2 digests of their words.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textwork as T
from tidemark.llm.components import components
from tidemark.session import free_shuffles, ship, staged, unstage

#: Bits of a set's parity sketch, with which pairs are ruled out before their sets are fetched.
PARITY_BITS = 1024
#: Roles of a row in a bucket: it may ask, it may be found.
ASKS, FOUND = 1, 2
#: Comparisons by sketch, and pairs compared by their texts, of one task, about.
COMPARED_ROWS, LINK_ROWS = 20_000_000, 4_000
#: Pairs that may be broadcast (16 bytes each).
BROADCAST_PAIRS = 500_000
#: Parts in which signatures travel, one after the other (a power of two): each is made from the texts again, and only one is on disk.
SIGNATURE_PARTS = 2
#: Parts in which texts travel to their nodes, one after the other: the table is read once for each.
TEXT_PARTS = 2
#: Rows of each side of a cell in which components of a bucket are compared, about (160 bytes each).
CELL_ROWS = 8_192


def words_of(text: bytes) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def shingles(words: list[bytes], k: int) -> set[tuple[bytes, ...]]:
    """The distinct k-word shingles; fewer words are one shingle, no words none."""
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(k)], strict=False))


def digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


@lru_cache(maxsize=None)
def band_border(b: int, num: int, den: int) -> int:
    """The largest set size of band b; band 0 is size 1. The partner of a band's smallest size is in the band."""
    return 1 if b == 0 else (band_border(b - 1, num, den) + 1) * den // num


def bands(sizes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(band of each size, the bands' largest sizes)."""
    borders, b = [], 0
    most = int(sizes.max(initial=1))
    while True:
        borders.append(band_border(b, num, den))
        if borders[-1] >= most:
            break
        b += 1
    tops = np.array(borders, np.int64)
    return np.searchsorted(tops, sizes), tops


def apart(total: np.ndarray, num: int, den: int) -> np.ndarray:
    """The most tokens in which two similar sets with so many tokens in total differ."""
    return (den - num) * total // (den + num)


class Sets:
    """Shingle sets of several texts: sorted distinct hashes in one array, offsets[i]:offsets[i+1] of text i."""

    def __init__(self, texts: list[bytes], k: int):
        words = T.Words(texts, T.NONSPACE)
        at, owner = T.within(words.offsets, k)
        tokens = T.grams(words.hashes, k)[at] if len(at) else np.zeros(0, np.uint64)
        counts = np.diff(words.offsets)
        for i in np.flatnonzero((counts > 0) & (counts < k)):  # fewer words than a shingle: the sequence is one
            n = int(counts[i])
            whole = T.grams(words.hashes[words.offsets[i] : words.offsets[i + 1]], n)
            tokens = np.concatenate([tokens, T.mix(whole + np.uint64(n))])
            owner = np.concatenate([owner, [i]])
        order = np.lexsort((tokens, owner))
        tokens, owner = tokens[order], owner[order]
        fresh = np.ones(len(tokens), bool)
        fresh[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = tokens[fresh], owner[fresh].astype(np.int64)
        self.offsets = np.searchsorted(self.owner, np.arange(len(texts) + 1))
        self.sizes = np.diff(self.offsets)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[np.append(starts[1:], len(values))] - total[starts]


def signatures(sets: Sets, take: np.ndarray, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(signature, text number, role) rows of the texts for which `take` is True."""
    own, tops = bands(sets.sizes, num, den)
    for lower in (0, 1):  # as a member of its band, and as the larger partner of sets one band lower
        texts = take & (sets.sizes > 0) & (own >= lower)
        use = texts[sets.owner]
        if not use.any():
            continue
        tokens, owner = sets.tokens[use], sets.owner[use]
        band = own[owner] - lower
        segments_of_band = apart(tops + tops * den // num, num, den) + 1
        m = segments_of_band[band]
        seg = (T.mix(tokens + (band + 1).astype(np.uint64) * T.STEP) % m.astype(np.uint64)).astype(np.int64)
        order = np.lexsort((seg, owner))
        value, owner, seg = T.mix(tokens[order]), owner[order], seg[order]
        start = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (seg[1:] != seg[:-1])]))
        sums, sizes = _sums(value, start), np.diff(np.append(start, len(value)))
        g_owner, g_seg = owner[start], seg[start]
        g_band = own[g_owner] - lower
        place = T.mix((g_band + 1).astype(np.uint64) * T.BASE + g_seg.astype(np.uint64) * T.STEP)
        role = ASKS if lower else ASKS | FOUND
        yield T.mix(sums ^ place), g_owner, np.full(len(sums), role, np.int8)

        # Units of the texts: one for each segment that isn't empty; what is missing is spent on deletions.
        n_of = sets.sizes
        top = tops[np.maximum(own - lower, 0)]
        wanted = apart(np.minimum(top, n_of) + n_of, num, den) + 1
        telling = np.bincount(g_owner, minlength=len(n_of))
        missing = np.where(texts, np.maximum(wanted - telling, 0), 0)
        m_of = segments_of_band[np.maximum(own - lower, 0)]
        first = np.where(m_of <= 8, m_of, 4 + m_of // 32)
        early = g_seg < first[g_owner]
        spend = np.zeros(len(g_owner), bool)
        if missing.any():
            can = np.flatnonzero(early & (sizes >= 2) & (missing[g_owner] > 0))
            can = can[np.lexsort((sizes[can], g_owner[can]))]
            begin = np.searchsorted(g_owner[can], g_owner[can], side="left")
            rank = np.arange(len(can)) - begin
            spend[can[rank < missing[g_owner[can]]]] = True
            missing = missing - np.bincount(g_owner[spend], minlength=len(n_of))
        group_of = np.repeat(np.arange(len(start)), sizes)
        for which, r in ((early, FOUND), (spend, ASKS)) if not lower else ((spend, ASKS),):
            at = np.flatnonzero(which[group_of])
            g = group_of[at]
            at, g = at[sizes[g] >= 2], g[sizes[g] >= 2]
            if len(at):
                yield T.mix((sums[g] - value[at]) ^ place[g]), g_owner[g], np.full(len(at), r, np.int8)

        # Whatever is still missing is asked for in empty segments; sets are found in theirs.
        hungry = np.flatnonzero(missing > 0)
        empty_role = []
        if not lower:
            empty_role.append((np.flatnonzero(texts & (telling < m_of)), FOUND))
        if len(hungry):
            empty_role.append((hungry, ASKS))
        for who, r in empty_role:
            rep = np.repeat(who, m_of[who])
            every = np.arange(len(rep)) - np.repeat(np.cumsum(m_of[who]) - m_of[who], m_of[who])
            big = int(m_of.max()) + 1
            gone = ~np.isin(rep * big + every, g_owner * big + g_seg)
            rep, every = rep[gone], every[gone]
            b = own[rep] - lower
            yield T.mix(T.mix((b + 1).astype(np.uint64) * T.BASE + every.astype(np.uint64) * T.STEP)), rep, np.full(len(rep), r, np.int8)


def parities(sets: Sets) -> np.ndarray:
    """(texts, PARITY_BITS / 64): each bit is the parity of the tokens that hash to it.

    A token in one of two sets only flips one bit, so two sets differ in as many tokens as their bits, or more.
    """
    bits = np.zeros((len(sets.sizes), PARITY_BITS), np.uint8)
    at = (T.mix(sets.tokens) & np.uint64(PARITY_BITS - 1)).astype(np.int64)
    np.bitwise_xor.at(bits, (sets.owner, at), 1)
    return np.packbits(bits, axis=1).view(np.uint64)


ROW = "sig long, node long, code int"


def _member_rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [words_of(t) for t in T.as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([len(shingles(w, k)) for w in words], pa.int64()), pa.array([digest(w) for w in words], pa.binary())], ["id", "n", "d"]
        )


def _node_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, words joined by a space) of the rows whose words are the node's."""
    for batch in batches:
        words = [words_of(t) for t in T.as_bytes(batch.column("text"))]
        good = [digest(w) == d for w, d in zip(words, batch.column("d").to_pylist(), strict=True)]
        rows = pa.RecordBatch.from_arrays([batch.column("node"), pa.array([b" ".join(w) for w in words], pa.binary())], ["node", "text"])
        yield rows.filter(pa.array(good, pa.bool_()))


def _signature_rows(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int, part: int = 0, parts: int = 1) -> Iterator[pa.RecordBatch]:
    """Signatures, those of one part of all, of every text; code is the size of its set times four plus its role."""
    for batch in batches:
        texts, nodes = T.as_bytes(batch.column("text")), batch.column("node").to_numpy()
        for a, b in T.chunked([len(t) + 1 for t in texts]):
            sets = Sets(texts[a:b], k)
            for sig, owner, role in signatures(sets, np.ones(b - a, bool), num, den):
                mine = sig & np.uint64(parts - 1) == np.uint64(part)
                sig, owner, role = sig[mine], owner[mine], role[mine]
                code = (sets.sizes[owner] * 4 + role).astype(np.int32)
                for i in range(0, len(sig), 100_000):
                    j = slice(i, i + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array(sig[j].view(np.int64)), pa.array(nodes[a:b][owner[j]]), pa.array(code[j])], ["sig", "node", "code"])


def _live_rows(batches: Iterator[pa.RecordBatch], most: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by sig, those of buckets with several texts of which one asks and another is found."""

    def live(sig: np.ndarray, node: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        ends = np.append(start[1:], len(sig))
        roles = np.bitwise_or.reduceat(code & 3, start)
        good = (np.minimum.reduceat(node, start) != np.maximum.reduceat(node, start)) & (roles == ASKS | FOUND)
        keep = np.repeat(good, ends - start)
        return pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(node[keep]), pa.array(code[keep])], ["sig", "node", "code"])

    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy() for c in ("sig", "node", "code")))
        rows += batch.num_rows
        if rows < most:
            continue
        sig, node, code = (np.concatenate(x) for x in zip(*held, strict=True))
        cut = int(np.searchsorted(sig, sig[-1])) if sig[0] != sig[-1] else 0
        if cut:
            yield live(sig[:cut], node[:cut], code[:cut])
            held, rows = [(sig[cut:], node[cut:], code[cut:])], len(sig) - cut
        else:  # one bucket of most rows or more: pass it on as it comes, all but a pair that keeps it alive
            yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(node), pa.array(code)], ["sig", "node", "code"])
            asks, found = int(np.argmax(code & ASKS > 0)), int(np.argmax(code & FOUND > 0))
            other = int(np.argmax(node != node[asks]))
            keep = sorted({asks, found, other})
            held, rows = [(sig[keep], node[keep], code[keep])], len(keep)
    if rows:
        yield live(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _parity_rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = T.as_bytes(batch.column("text"))
        for a, b in T.chunked([len(t) + 1 for t in texts]):
            marks = [x.tobytes() for x in parities(Sets(texts[a:b], k))]
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(a, b - a), pa.array(marks, pa.binary())], ["node", "parity"])


def _similar_rows(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """The pairs that link, by their shingles; rows come with equal a in a row, so a's set is made once."""
    last, mine = None, set()
    for batch in batches:
        good = []
        for a, x, y in zip(batch.column("a").to_pylist(), batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
            if a != last:
                last, mine = a, shingles(x.split(b" "), k)
            other = shingles(y.split(b" "), k)
            shared = len(mine & other)
            good.append(den * shared >= num * (len(mine) + len(other) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


CELL = ("sig", "i", "j")


def _cell_pairs(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs across components whose sizes and parities allow the similarity; rows are sorted by cell and side.

    Side 0 holds rows outside the bucket's largest component, side 1 any rows. A pair whose ends are both outside
    meets in two cells and is compared in one of them.
    """
    names = ("side", "rep", "c", "role", "n", "out")

    def compare(left: list[tuple], right: list[tuple]) -> Iterator[pa.RecordBatch]:
        _, rep, comp, role, n, _, parity = (np.concatenate(x) for x in zip(*left, strict=True))
        _, rep2, comp2, role2, n2, out2, parity2 = (np.concatenate(x) for x in zip(*right, strict=True))
        for i in range(len(rep)):
            fits = (comp2 != comp[i]) & ((out2 == 0) | (rep2 > rep[i])) & (den * np.minimum(n2, n[i]) >= num * np.maximum(n2, n[i]))
            fits &= ((role2 & ASKS > 0) & (role[i] & FOUND > 0)) | ((role2 & FOUND > 0) & (role[i] & ASKS > 0))
            j = np.flatnonzero(fits)
            if len(j):
                j = j[np.bitwise_count(parity2[j] ^ parity[i]).sum(axis=1, dtype=np.int64) <= apart(n2[j] + n[i], num, den)]
            if len(j):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(rep2[j], rep[i])), pa.array(np.maximum(rep2[j], rep[i]))], ["a", "b"])

    cell, left, right, waiting = None, [], [], 0
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in CELL] + [batch.column("side").to_numpy()], axis=1)
        data = [batch.column(c).to_numpy() for c in names]
        data.append(np.frombuffer(b"".join(batch.column("parity").to_pylist()), np.uint64).reshape(batch.num_rows, -1))
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for x, y in zip(edges, edges[1:], strict=False):
            if x == y:
                continue
            if tuple(keys[x, :3]) != cell:
                if left and right:
                    yield from compare(left, right)
                cell, left, right, waiting = tuple(keys[x, :3]), [], [], 0
            if keys[x, 3] == 0:
                left.append(tuple(d[x:y] for d in data))
            elif left:
                right.append(tuple(d[x:y] for d in data))
                waiting += y - x
                if waiting >= CELL_ROWS:
                    yield from compare(left, right)
                    right, waiting = [], 0
    if left and right:
        yield from compare(left, right)


class JaccardClasses:
    """The classes of one table; the steps are methods so that a caller can look at each.

    compared: pairs that were compared in cells by the last step of classes(), by sketch.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int):
        self.spark = df.sparkSession
        ship(self.spark)
        T.small_batches(self.spark)
        self.k, self.num, self.den, self.compared = k, num, den, 0
        self.source = df.select(F.col(T.quoted(id_col)).alias("id"), F.col(T.quoted(text_col)).alias("text"))
        self.id_type = self.source.schema["id"].dataType.simpleString()

    def members(self) -> DataFrame:
        """(id, n, d) of every row: its set's size and the digest of its words."""
        k = self.k
        return staged(self.source.mapInArrow(lambda it: _member_rows(it, k), f"id {self.id_type}, n long, d binary"), "members")

    def nodes(self, members: DataFrame) -> DataFrame:
        """(d, lead, node): one row for each sequence of words, with its smallest id and a number."""
        rows = members.filter("n > 0 and id is not null").groupBy("d").agg(F.min("id").alias("lead"))
        return staged(rows.withColumn("node", F.monotonically_increasing_id()), "nodes", members.count())

    def texts(self, nodes: DataFrame) -> DataFrame:
        """(node, text) of every node. Texts travel in TEXT_PARTS parts by their ids, of which one is on disk beside what was written."""
        rows = self._texts_part(nodes, 0)
        for part in range(1, TEXT_PARTS):
            free_shuffles(self.spark)
            rows = rows.unionByName(self._texts_part(nodes, part))
        if rows.count() == nodes.count():
            return rows
        once = staged(rows.dropDuplicates(["node"]), "node-texts", codec="zstd")  # rows were repeated, id and words
        unstage(rows)
        return once

    def _texts_part(self, nodes: DataFrame, part: int) -> DataFrame:
        mine = lambda df: df.filter(F.pmod(F.xxhash64("id"), F.lit(TEXT_PARTS)) == part)
        found = mine(self.source).join(mine(nodes.withColumnRenamed("lead", "id")), "id").select("node", "d", "text")
        return staged(found.mapInArrow(_node_texts, "node long, text binary"), "node-texts", codec="zstd")

    def live(self, texts: DataFrame) -> DataFrame:
        """(sig, rep, n, role) of the buckets in which different nodes meet.

        Nearly all signatures are met by no other text and are dropped where they arrive, so they are the largest of all
        shuffles and leave little behind: they travel in SIGNATURE_PARTS parts by their last bits, a bucket in one of them.
        """
        rows = self._live_part(texts, 0)
        for part in range(1, SIGNATURE_PARTS):
            free_shuffles(self.spark)
            rows = rows.unionByName(self._live_part(texts, part))
        return rows

    def _live_part(self, texts: DataFrame, part: int) -> DataFrame:
        k, num, den, parts = self.k, self.num, self.den, SIGNATURE_PARTS
        rows = texts.mapInArrow(lambda it: _signature_rows(it, k, num, den, part, parts), ROW)
        met = rows.repartition("sig").sortWithinPartitions("sig").mapInArrow(_live_rows, ROW)
        role, n = F.col("code").bitwiseAND(3), F.shiftright("code", 2)
        return staged(met.groupBy("sig", F.col("node").alias("rep")).agg(F.bit_or(role).cast("int").alias("role"), F.max(n).cast("long").alias("n")), "live", 4 * texts.count() // parts)

    def similar(self, pairs: DataFrame, texts: DataFrame, n_pairs: int) -> DataFrame:
        """The pairs that link. n_pairs: their number; BROADCAST_PAIRS at most go to the texts instead of meeting them in a shuffle."""
        k, num, den = self.k, self.num, self.den
        sent = F.broadcast if n_pairs <= BROADCAST_PAIRS else (lambda df: df)
        # Only texts that some pair names travel.
        texts = texts.join(sent(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "node", "left_semi")
        with_b = sent(pairs.select("a", "b")).join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
        with_a = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").select("a", "b", "x", "y")
        return with_a.mapInArrow(lambda it: _similar_rows(it, k, num, den), "a long, b long")

    def _fits(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a < b) whose sizes allow the similarity, once each."""
        near = F.lit(self.den) * F.least("na", "nb") >= F.lit(self.num) * F.greatest("na", "nb")
        return pairs.filter(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def _across(self, rows: DataFrame, several: DataFrame, texts: DataFrame) -> DataFrame:
        """Candidate pairs between components of one bucket, from cells of about CELL_ROWS rows a side.

        A bucket of r rows, o of them outside its largest component, has o/CELL_ROWS times r/CELL_ROWS cells.
        """
        k, num, den = self.k, self.num, self.den
        rest = rows.join(several.select("sig"), "sig", "left_semi").select("sig", "rep", "c", "role", "n")
        parts = rest.groupBy("sig", "c").agg(F.count("*").alias("m"))
        sizes = parts.groupBy("sig").agg(F.max(F.struct("m", "c")).alias("big"), F.sum("m").alias("all"))
        outside = F.col("all") - F.col("big.m")
        sizes = staged(sizes.select("sig", F.col("big.c").alias("big"), outside.alias("out_rows"), "all", F.ceil(outside / CELL_ROWS).alias("outs"), F.ceil(F.col("all") / CELL_ROWS).alias("alls")), "cells", rows.count())
        self.compared = sizes.agg(F.sum(F.col("out_rows") * F.col("all"))).first()[0] or 0
        logging.getLogger(__name__).info("%d pairs to compare by sketch", self.compared)
        marks = texts.join(rest.select(F.col("rep").alias("node")).distinct(), "node", "left_semi").mapInArrow(lambda it: _parity_rows(it, k), "node long, parity binary")
        rest = rest.join(staged(marks, "parities").withColumnRenamed("node", "rep"), "rep").join(sizes, "sig")
        rest = rest.withColumn("out", (F.col("c") != F.col("big")).cast("int"))
        place = lambda blocks: F.pmod(F.xxhash64("rep"), F.col(blocks))
        every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
        columns = ["rep", "c", "role", "n", "out", "parity"]
        left = rest.filter("out = 1").select("sig", place("outs").alias("i"), every("alls").alias("j"), F.lit(0).alias("side"), *columns)
        right = rest.select("sig", every("outs").alias("i"), place("alls").alias("j"), F.lit(1).alias("side"), *columns)
        cells = left.unionByName(right).repartition(*CELL).sortWithinPartitions(*CELL, "side")
        return cells.mapInArrow(lambda it: _cell_pairs(it, num, den), "a long, b long").distinct()

    def linked(self, texts: DataFrame) -> DataFrame:
        """(rep, c): the nodes that meet others, and the smallest node of the class of each. The staged texts are used up."""
        live = self.live(texts)
        free_shuffles(self.spark)  # every signature travelled
        # How often a set meets others over all its buckets: the centre of a group of copies meets most of them.
        n_live = live.count()
        met = staged(live.groupBy("sig").agg(F.count("*").alias("met")), "met", n_live)
        nodes = staged(live.join(met, "sig").groupBy("rep").agg(F.sum("met").alias("pop")), "live-nodes", n_live)
        n_nodes = nodes.count()
        live = staged(live.join(nodes, "rep"), "live-pop", n_live)
        every, texts = texts, staged(texts.join(nodes.select(F.col("rep").alias("node")), "node", "left_semi"), "live-texts", codec="zstd")
        unstage(every)
        free_shuffles(self.spark)
        links = tried = None
        comp = nodes.select("rep", F.col("rep").alias("c"))
        for round_no in range(3):
            rows = live.join(comp, "rep") if round_no else live.withColumn("c", F.col("rep"))
            lead = F.max(F.struct("pop", "c", "rep", "n")).alias("lead")
            several = rows.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), lead).filter("lo <> hi").select("sig", "lead")
            several = staged(several, "several", n_live)
            open_rows = rows.join(several, "sig").filter("c <> lead.c")
            if round_no == 0:  # every set with the most popular set that it meets
                star = open_rows.groupBy("rep", "n").agg(F.max("lead").alias("lead"))
                pairs = self._fits(star.select(F.col("lead.rep").alias("a"), F.col("rep").alias("b"), F.col("lead.n").alias("na"), F.col("n").alias("nb")))
            elif round_no == 1:  # every component of a bucket, by its most popular set, with the bucket's most popular set
                star = open_rows.groupBy("sig", "c").agg(F.max(F.struct("pop", "rep", "n", "lead")).alias("s"))
                pairs = self._fits(star.select(F.col("s.lead.rep").alias("a"), F.col("s.rep").alias("b"), F.col("s.lead.n").alias("na"), F.col("s.n").alias("nb")))
            else:  # all that is left, across components
                pairs = self._across(rows, several, texts)
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            # Tasks of some seconds: the last round's work is the comparisons, then that of a link is its two texts.
            pairs = staged(pairs, "pairs", n_live if round_no < 2 else self.compared, 250_000 if round_no < 2 else COMPARED_ROWS)
            n_pairs = pairs.count()
            found = staged(self.similar(pairs, texts, n_pairs), "links", n_pairs, LINK_ROWS)
            links = found if links is None else links.unionByName(found)
            tried = pairs if tried is None else tried.unionByName(pairs)
            comp = staged(nodes.select("rep").join(components(links).withColumnRenamed("v", "rep"), "rep", "left").select("rep", F.coalesce("c", "rep").alias("c")), "components", n_nodes)
            free_shuffles(self.spark)
        return comp

    def classes(self) -> tuple[DataFrame, DataFrame]:
        """(members, classes): classes is (d, component, lead), the smallest id that a sequence of words leads to and its own."""
        members = self.members()
        nodes = self.nodes(members)
        texts = self.texts(nodes)
        free_shuffles(self.spark)
        comp = self.linked(texts).withColumnRenamed("rep", "node")
        n_nodes = nodes.count()
        placed = nodes.join(comp, "node", "left").select("d", "lead", F.coalesce("c", "node").alias("c"))
        least = staged(placed.groupBy("c").agg(F.min("lead").alias("component")), "least", n_nodes)
        # Written first: a join of two plain shuffles can split the rows of a sequence that a third of all rows have.
        return members, staged(placed.join(least, "c").select("d", "component", "lead"), "classes", n_nodes)


def jaccard_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    r"""One row per row of df: id_col, n_shingles, component_id.

    Words are runs without ASCII white space, A-Z lower-cased; a set holds the distinct k-word shingles, or the
    whole sequence of a text with fewer words. Documents link when den * intersection >= num * union;
    component_id is the smallest id that links lead to. Texts without words (null, empty) have an empty set and
    link with nothing. Ids may be of any type that sorts. Rows with a null id link with nothing; their component_id is
    null. Rows that repeat an id come out as often, and each has its own text's size and class. An empty table gives
    an empty one. A very long text is held whole in one task, in about thirty times its bytes.
    """
    members, classes = JaccardClasses(df, id_col, text_col, k, num, den).classes()
    out = members.join(classes, "d", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


def first_of_class(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """df's rows without near duplicates: of each class the row with the smallest id.

    Rows without words, or with a null id, stay. Rows that repeat an id and its words are one class, of which one row
    stays; rows that repeat an id with other words are told apart. An empty table gives an empty one. Columns of df
    keep their names and values, whatever they are called.
    """
    steps = JaccardClasses(df, id_col, text_col, k, num, den)
    members, classes = steps.classes()
    ident = F.col(T.quoted(id_col))
    lead, mark = T.spare("lead"), T.spare("d")
    # An id stays if the class of its row's words begins with it.
    stay = members.filter("n > 0 and id is not null").join(classes.filter(F.col("component") == F.col("lead")), (members["d"] == classes["d"]) & (members["id"] == classes["lead"]), "left_semi")
    empty = members.filter("n = 0 and id is not null")
    kept = staged(stay.unionByName(empty).select(F.col("id").alias(lead), F.col("d").alias(mark)).distinct(), "kept")
    repeats = not members.filter("id is not null").groupBy("id").agg(F.count("*").alias("m")).filter("m > 1").isEmpty()
    nulls = df.filter(ident.isNull())
    known = df.filter(ident.isNotNull())
    if not repeats:
        return known.join(kept, ident == F.col(lead), "left_semi").unionByName(nulls)

    @F.pandas_udf("binary")
    def digests(text: pd.Series) -> pd.Series:
        return text.map(lambda t: digest(words_of((t or "").encode())))

    own = T.spare("own")
    rows = known.withColumn(own, digests(F.col(T.quoted(text_col))))
    rows = rows.join(kept, (ident == F.col(lead)) & (F.col(own) == F.col(mark)), "left_semi")
    blank = digest([])
    once = rows.filter(F.col(own) != F.lit(blank)).dropDuplicates([id_col, own])
    return once.unionByName(rows.filter(F.col(own) == F.lit(blank))).drop(own).unionByName(nulls)
