"""Periodic runs of words by Lyndon arrays over an ordered alphabet, in linear time.

A run is a maximal stretch with smallest period q. Each run of at least three periods holds a Lyndon root twice in a row:
some word position i with next_smaller(i) = i + q, in the order under which the word behind the run is the smaller one, so
both the order of the word numbers and its reverse are tried. One pass from left to right keeps the positions whose next
smaller suffix is still open and compares each new position with the last of them. Such a comparison needs the length that
two suffixes share; it is taken from earlier matches:

- from the match of the position that was closed before (suffixes in order share what their neighbours share),
- from the match that reaches farthest to the right, whose copy was compared before, or
- else words are compared, but only behind the farthest place that any match has reached.

So every word is matched once; no suffix array, no hash and no comparison of more than two words at a time is used.
Word numbers only stand for words (Arrow's dictionary encoding gives equal words equal numbers) and give the order.

Text in which nothing repeats is left out first: two neighbouring words of a run of three periods stand at least
twice in it, so a run lies between pairs of words that their stretch holds once. What remains is cut there
again until nothing changes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textwork as T
from tidemark.session import ship

#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Rounds of cutting stretches at pairs that stand once; more would only save work.
ROUNDS = 5

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def next_smaller(t: list[int]) -> tuple[list[int], list[int]]:
    """(next, shared) for every position: where the next smaller suffix starts and how many numbers both share.

    t: numbers from 0 on; the empty suffix is the smallest and starts at len(t).
    """
    n = len(t)
    t = [*t, -1]  # equals no other number: comparisons end here
    following, shared = [n] * (n + 1), [0] * (n + 1)
    before, shared_before = [-1] * (n + 1), [0] * (n + 1)  # the previous smaller suffix
    still_open: list[int] = []
    shift = left = right = reach = 0  # t[left:] and t[right:] share all up to `reach`, where right = left + shift
    for r in range(n):
        closed, c = -1, 0
        while still_open:
            at = still_open[-1]
            known = False
            if closed >= 0:
                m = shared_before[closed]
                if m != c:
                    c, known = min(m, c), True
            if not known:
                if r + c < reach:
                    inside, copy = reach - r, -1
                    if at >= right:
                        a, b = at - shift, r - shift
                        copy = shared[a] if following[a] == b else shared_before[b] if before[b] == a else -1
                    elif r > right:
                        b = r - shift
                        while before[b] > at:
                            b = before[b]
                        copy = shared_before[b] if before[b] == at else -1
                    if 0 <= copy < inside:
                        c, known = copy, True
                    elif copy >= inside:
                        c = inside
                if not known:
                    while t[at + c] == t[r + c]:
                        c += 1
                    if r + c >= reach:
                        shift, left, right, reach = r - at, at, r, r + c
            if t[at + c] < t[r + c]:
                before[r], shared_before[r] = at, c
                break
            still_open.pop()
            following[at], shared[at] = r, c
            closed = at
        still_open.append(r)
    return following, shared


def find_runs(t: list[int], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of t with at least `least` numbers and `periods` (3 or more) times their period.

    Sorted by start, then period. t: numbers from 0 on.
    """
    n = len(t)
    if n < least:
        return []
    found = set()
    top = max(t)
    for order in (t, [top - x for x in t]):
        following, shared = next_smaller(order)
        nxt, both = np.array(following[:n]), np.array(shared[:n])
        period = nxt - np.arange(n)
        roots = np.flatnonzero(both >= period)
        ends = nxt[roots] + both[roots]
        # The leftmost root of a run starts in its first period, so fewer than `period` words lie before it.
        _, first = np.unique(ends * (n + 1) + period[roots], return_index=True)
        for i in first.tolist():
            start, q, end = int(roots[i]), int(period[roots[i]]), int(ends[i])
            while start > 0 and t[start - 1] == t[start - 1 + q]:
                start -= 1
            if end - start >= max(least, periods * q):
                found.add((start, end - start, q))
    return sorted(found, key=lambda x: (x[0], x[2]))


def stretches(numbers: np.ndarray, offsets: np.ndarray, least: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that can hold a run of three periods; none lies in two texts. offsets[i]:offsets[i+1] is text i."""
    sizes = np.diff(offsets)
    big = sizes >= least
    starts, ends = offsets[:-1][big].astype(np.int64), offsets[1:][big].astype(np.int64)
    for _ in range(ROUNDS):
        if not len(starts):
            break
        counts = ends - starts - 1
        owner = np.repeat(np.arange(len(starts)), counts)
        at = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner] + starts[owner]
        a, b = numbers[at].astype(np.int64), numbers[at + 1].astype(np.int64)
        width = int(max(a.max(), b.max())) + 1
        pair = a * width + b
        if width * width > (1 << 62) // max(1, len(starts)):
            pair = np.unique(pair, return_inverse=True)[1]
            width = 1
            pair = owner * (int(pair.max()) + 1) + pair
        else:
            pair = owner * (width * width) + pair
        ordered = np.sort(pair)
        again = ordered[1:][ordered[1:] == ordered[:-1]]
        again = again[np.concatenate([[True], again[1:] != again[:-1]])] if len(again) else again
        place = np.minimum(np.searchsorted(again, pair), max(0, len(again) - 1))
        twice = again[place] == pair if len(again) else np.zeros(len(pair), bool)
        # Consecutive pairs that stand twice, within one stretch.
        joined = np.zeros(len(pair), bool)
        joined[1:] = twice[1:] & twice[:-1] & (owner[1:] == owner[:-1])
        heads = np.flatnonzero(twice & ~joined)
        tails = np.flatnonzero(twice & ~np.concatenate([joined[1:], [False]]))
        new_starts, new_ends = at[heads], at[tails] + 2
        keep = new_ends - new_starts >= least
        new_starts, new_ends = new_starts[keep], new_ends[keep]
        if len(new_starts) == len(starts) and (new_starts == starts).all() and (new_ends == ends).all():
            break
        starts, ends = new_starts, new_ends
    return starts, ends


def periodic_runs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS, periods: int = LEAST_PERIODS, rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(id_col, n_words, runs, collapsed_text): the runs of each text's words and the text without their repetitions.

    Words are stretches without ASCII white space, numbered from 0. runs: (start, length, period) of every run of at least
    `least` words (2 or more) and `periods` periods (3 or more), by start, then period. collapsed_text: the words
    that no run holds behind its first period, joined by one space. rewrite: changes a document's words (UTF-8) first.

    A null or empty text has no words, no runs and an empty collapsed_text; every row gives a row, repeated ones too, and
    ids may be of any type and null. Other columns don't matter, whatever their names. An empty table gives an empty one.
    A text is held whole in one task, with about 60 times its bytes where all of it repeats, 25 times elsewhere.
    """
    if least < 2 or periods < 3:
        raise ValueError("least must be 2 or more, periods 3 or more")
    spark = df.sparkSession
    ship(spark)
    T.small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            texts = T.as_bytes(batch.column("text"))
            names = ids.to_pylist() if rewrite else None
            for a, b in T.chunked([len(t) + 1 for t in texts]):
                words = [t.split() for t in texts[a:b]]
                if rewrite:
                    words = [rewrite(i, w) for i, w in zip(names[a:b], words, strict=True)]
                runs, texts_left = _of_texts(words, least, periods)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array([len(w) for w in words], pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(texts_left, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed_text"]
                )

    slim = df.select(F.col(T.quoted(id_col)).alias("id"), F.col(T.quoted(text_col)).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    out = slim.mapInArrow(run, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed_text string")
    return out.withColumnRenamed("id", id_col)


def _of_texts(words: list[list[bytes]], least: int, periods: int) -> tuple[list[list[dict]], list[bytes]]:
    """Runs and collapsed text of each list of words."""
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=offsets[1:])
    numbers = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode().indices.to_numpy()
    runs: list[list[dict]] = [[] for _ in words]
    texts = [b" ".join(w) for w in words]
    starts, ends = stretches(numbers, offsets, least)
    owners = np.searchsorted(offsets, starts, side="right") - 1
    for s, e, owner in zip(starts.tolist(), ends.tolist(), owners.tolist(), strict=True):
        part = np.unique(numbers[s:e], return_inverse=True)[1].tolist()
        base = s - int(offsets[owner])
        runs[owner] += [{"start": base + start, "length": length, "period": q} for start, length, q in find_runs(part, least, periods)]
    for i in {o for o in owners.tolist() if runs[o]}:
        runs[i].sort(key=lambda x: (x["start"], x["period"]))
        edge = np.zeros(len(words[i]) + 1, np.int64)
        for x in runs[i]:
            edge[x["start"] + x["period"]] += 1
            edge[x["start"] + x["length"]] -= 1
        kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
        texts[i] = b" ".join([words[i][j] for j in kept])
    return runs, texts
