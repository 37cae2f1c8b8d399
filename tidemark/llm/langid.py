"""Language identification by a linear-chain conditional random field over words.

Each word has emission scores per language, summed from affixes (first and last one to three bytes), byte trigrams
with word borders, the word itself and a lexicon learned from the training texts. Learned transition scores join
neighbouring words: training chains run through texts of several languages, so a change of language is learned as well
as staying in one. Forward-backward over the whole text gives each word a distribution over languages, so
code-switched text is labelled word by word; a document's language is the one with the largest share of its words'
probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textwork as T
from tidemark.session import ship

#: The emission table has 2**18 rows, halved while rows times languages exceed 2**24 (64 MB); at least 2**12 rows.
MOST_BITS, MOST_CELLS, LEAST_BITS = 18, 24, 12
#: The bounded training sample: texts of each language, code points of an excerpt from each, words of a training chain.
TRAIN_TEXTS, TRAIN_CHARS, CHAIN = 300, 4_000, 64
#: Training chains stay in one text for about so many words.
STAY = 24
#: Words that forward_backward takes together; boundaries between them are exact.
BLOCK = 64
#: A word is in a language's lexicon if it occurs in this many of its training texts and in few others.
LEXICON_TEXTS, LEXICON_SHARE = 5, 0.9

LETTERS = np.zeros(256, bool)
LETTERS[97:123] = True
LETTERS[128:] = True


class Features:
    """Feature numbers of all words of several texts."""

    def __init__(self, texts: list[bytes], bits: int):
        buf, at = T.join_texts(texts)
        low = T.LOWER[buf]
        letter = LETTERS[low]
        low = np.where(letter, low, np.uint8(32))
        starts, ends = T.spans(letter)
        prefix = T.prefix_hash(low)
        shift = np.uint64(64 - bits)
        self.offsets = np.searchsorted(starts, at)
        self.words = T.span_hash(prefix, starts, ends)
        rows = [(self.words >> shift).astype(np.int64)]
        for n in (1, 2, 3):
            head = T.span_hash(prefix, starts, np.minimum(starts + n, ends))
            tail = T.span_hash(prefix, np.maximum(ends - n, starts), ends)
            rows.append((T.mix(head + np.uint64(n)) >> shift).astype(np.int64))
            rows.append((T.mix(tail + np.uint64(n + 8)) >> shift).astype(np.int64))
        self.once = np.stack(rows, axis=1) if len(starts) else np.zeros((0, 7), np.int64)
        #: Trigrams from one byte before a word to one after it: as many as it has bytes.
        padded = np.concatenate([[np.uint8(32)], low, [np.uint8(32)]]).astype(np.uint64)
        sizes = ends - starts
        first = np.cumsum(sizes) - sizes
        self.first = first
        place = np.arange(int(sizes.sum())) - np.repeat(first - starts, sizes)
        code = (padded[place] << np.uint64(16)) | (padded[place + 1] << np.uint64(8)) | padded[place + 2]
        self.grams = (T.mix(code + np.uint64(1 << 40)) >> shift).astype(np.int64)
        self.sizes = sizes

    def emissions(self, model: Model) -> np.ndarray:
        table = model.table
        if not len(self.words):
            return np.zeros((0, table.shape[1]), np.float32)
        out = np.add.reduceat(table[self.grams], self.first, axis=0)
        for j in range(self.once.shape[1]):
            out += table[self.once[:, j]]
        return out + model.lexicon_weight[model.lookup(self.words)]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (2**bits, languages)
    transitions: np.ndarray
    lexicon: np.ndarray  # sorted word hashes
    lexicon_language: np.ndarray
    lexicon_weight: np.ndarray  # (languages + 1, languages); the last row is for words in no lexicon

    @property
    def bits(self) -> int:
        return int(self.table.shape[0]).bit_length() - 1

    def lookup(self, words: np.ndarray) -> np.ndarray:
        none = len(self.languages)
        if not len(self.lexicon):
            return np.full(len(words), none)
        at = np.minimum(np.searchsorted(self.lexicon, words), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == words, self.lexicon_language[at], none)


def bits_for(languages: int) -> int:
    return max(LEAST_BITS, min(MOST_BITS, MOST_CELLS - (languages - 1).bit_length()))


def _passes(local: np.ndarray, start: np.ndarray, size: np.ndarray, jump: np.ndarray, first: np.ndarray, last: np.ndarray, begins: np.ndarray, pairs: bool):
    """Marginals (and expected transitions) of runs of words, given what stands before and behind each run.

    first: the forward message that enters a run (for runs that begin a chain it is the prior); last: the backward
    message behind its last word. Runs are taken together step by step, longest first, so that step t works on the runs
    that have a word t.
    """
    order = np.argsort(-size, kind="stable")
    start, size, first, last, begins = start[order], size[order], first[order], last[order], begins[order]
    steps = int(size[0]) if len(size) else 0
    alive = [int(np.searchsorted(-size, -t, side="left")) for t in range(steps)]  # runs longer than t
    labels = local.shape[1]
    ahead = []
    for t in range(steps):
        k = alive[t]
        into = np.where(begins[:k, None], first[:k], first[:k] @ jump) if t == 0 else ahead[-1][:k] @ jump
        a = into * local[start[:k] + t]
        ahead.append(a / a.sum(axis=1, keepdims=True))
    out = np.zeros((len(local), labels))
    expected = np.zeros((labels, labels))
    back = last.copy()
    for t in range(steps - 1, -1, -1):
        k = alive[t]
        g = ahead[t] * back[:k]
        out[start[:k] + t] = g / g.sum(axis=1, keepdims=True)
        b = local[start[:k] + t] * back[:k]
        if pairs:
            before = ahead[t - 1][:k] if t else first[:k]
            inner = slice(None) if t else ~begins[:k]
            joint = before[inner, :, None] * jump[None] * b[inner, None, :]
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = b @ jump.T
        back[:k] = b / b.sum(axis=1, keepdims=True)
    return out, expected


def forward_backward(scores: np.ndarray, start: np.ndarray, size: np.ndarray, transitions: np.ndarray, pairs: bool = False, block: int = BLOCK):
    """Marginals of every word of the chains, (words, languages); with pairs also the expected transitions.

    Chains of any length: each is cut into runs of `block` words for which the transfer matrix is worked out, all runs
    at once; messages then pass along a chain run by run, and within the runs again all at once. The cuts change
    nothing but rounding.
    """
    labels = scores.shape[1]
    jump = np.exp(transitions - transitions.max())
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64) + 1e-30
    runs = np.maximum(-(-size // block), 0)
    chain = np.repeat(np.arange(len(size)), runs)
    number = np.arange(len(chain)) - np.repeat(np.cumsum(runs) - runs, runs)
    at = start[chain] + number * block
    length = np.minimum(block, start[chain] + size[chain] - at)
    begins = number == 0
    first = np.full((len(chain), labels), 1.0 / labels)
    last = np.ones((len(chain), labels))
    if len(chain) and int(runs.max()) > 1:
        # transfer[r] = product over the run's words of jump times the word's local scores
        transfer = np.repeat(np.eye(labels)[None], len(chain), axis=0)
        by = np.argsort(-length, kind="stable")
        for t in range(int(length.max())):
            k = by[: int(np.searchsorted(-length[by], -t, side="left"))]
            m = (transfer[k] @ jump) * local[at[k] + t][:, None, :]
            transfer[k] = m / m.sum(axis=(1, 2), keepdims=True)
        ends = np.cumsum(runs)
        # The first word of a chain has no transition: undo it by starting from the local scores alone.
        enter = np.zeros((len(chain), labels))
        longest = int(runs.max())
        head = np.flatnonzero(runs > 1)
        opened = _opened(local, at[ends[head] - runs[head]], length[ends[head] - runs[head]], jump)
        message = opened
        for r in range(1, longest):
            keep = runs[head] > r
            head, message = head[keep], message[keep]
            here = ends[head] - runs[head] + r
            enter[here] = message
            message = np.einsum("ij,ijk->ik", message, transfer[here])
            message /= message.sum(axis=1, keepdims=True)
        first = np.where(begins[:, None], first, enter)
        tail = np.flatnonzero(runs > 1)
        back = np.ones((len(tail), labels))
        for r in range(1, longest):
            keep = runs[tail] > r
            tail, back = tail[keep], back[keep]
            here = ends[tail] - r  # the run behind, seen from the one before
            back = np.einsum("ijk,ik->ij", transfer[here], back)
            back /= back.sum(axis=1, keepdims=True)
            last[here - 1] = back
    out, expected = _passes(local, at, length, jump, first, last, begins, pairs)
    return (out, expected) if pairs else out


def _opened(local: np.ndarray, at: np.ndarray, length: np.ndarray, jump: np.ndarray) -> np.ndarray:
    """The forward message at the end of runs that begin a chain."""
    a = local[at] / local.shape[1]
    for t in range(1, int(length.max(initial=0))):
        k = np.flatnonzero(length > t)
        a[k] = (a[k] / a[k].sum(axis=1, keepdims=True) @ jump) * local[at[k] + t]
    return a / a.sum(axis=1, keepdims=True)


def crossing_chains(offsets: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
    """Word numbers of training chains of CHAIN words: runs of about STAY words, each from a text drawn at random.

    Every word is in one chain; so neighbouring runs are mostly of different texts, and often of different languages.
    """
    runs = []
    for a, b in zip(offsets, offsets[1:], strict=False):
        while a < b:
            n = min(int(b - a), 1 + int(rng.geometric(1 / STAY)))
            runs.append(np.arange(a, a + n))
            a += n
    rng.shuffle(runs)
    words = np.concatenate(runs) if runs else np.zeros(0, np.int64)
    return [words[i : i + CHAIN] for i in range(0, len(words), CHAIN)]


def train(texts: list[bytes], languages: list[str], epochs: int = 3, rate: float = 0.3, decay: float = 1e-4, batch: int = 256, seed: int = 5) -> Model:
    """Fits the field to texts whose words all carry the text's language (stochastic gradient with Adagrad steps).

    Any number of languages; the emission table has fewer rows for more of them (bits_for).
    """
    names = sorted(set(languages))
    if not names:
        raise ValueError("no training text")
    of = np.array([names.index(x) for x in languages])
    bits = bits_for(len(names))
    feats = Features(texts, bits)
    label = np.repeat(of, np.diff(feats.offsets))
    text_no = np.repeat(np.arange(len(texts)), np.diff(feats.offsets))
    size = len(names)
    # lexicon: in how many texts of each language a word is
    seen = np.unique(np.stack([feats.words, text_no.astype(np.uint64)]), axis=1) if len(label) else np.zeros((2, 0), np.uint64)
    words, inverse = np.unique(seen[0], return_inverse=True)
    counts = np.zeros((len(words), size))
    np.add.at(counts, (inverse, of[seen[1].astype(np.int64)]), 1)
    most = counts.max(axis=1, initial=0)
    kept = (most >= LEXICON_TEXTS) & (most >= LEXICON_SHARE * counts.sum(axis=1))
    model = Model(names, np.zeros((1 << bits, size), np.float32), np.zeros((size, size)), words[kept], counts[kept].argmax(axis=1) if len(words) else np.zeros(0, np.int64), np.zeros((size + 1, size), np.float32))
    chains = crossing_chains(feats.offsets, np.random.default_rng(seed))
    in_lexicon = model.lookup(feats.words)
    gains = [np.full_like(x, 1e-8, dtype=np.float64) for x in (model.table, model.transitions, model.lexicon_weight)]
    for _ in range(epochs):
        for i in range(0, len(chains), batch):
            n = np.array([len(c) for c in chains[i : i + batch]])
            at = np.concatenate(chains[i : i + batch])
            gram_at = np.concatenate([np.arange(feats.first[a], feats.first[a] + feats.sizes[a]) for a in at])
            gram_word = np.repeat(np.arange(len(at)), feats.sizes[at])
            scores = np.zeros((len(at), size), np.float32)
            weights = model.table[feats.grams[gram_at]]
            for j in range(size):
                scores[:, j] = np.bincount(gram_word, weights=weights[:, j], minlength=len(at))
            scores += model.table[feats.once[at]].sum(axis=1) + model.lexicon_weight[in_lexicon[at]]
            here = np.concatenate([[0], np.cumsum(n)[:-1]])
            marginal, expected = forward_backward(scores, here, n, model.transitions, pairs=True)
            slope = marginal
            slope[np.arange(len(at)), label[at]] -= 1
            inner = np.ones(len(at), bool)
            inner[here] = False  # a chain's first word follows no other
            follow = np.flatnonzero(inner)
            observed = np.bincount(label[at[follow - 1]] * size + label[at[follow]], minlength=size * size).reshape(size, size)
            rows = np.concatenate([feats.once[at].ravel(), feats.grams[gram_at]])
            spread = np.concatenate([np.repeat(slope, feats.once.shape[1], axis=0), slope[gram_word]])
            touched, where = np.unique(rows, return_inverse=True)
            g_table = np.stack([np.bincount(where, weights=spread[:, j], minlength=len(touched)) for j in range(size)], axis=1) / len(n)
            g_jump = (expected - observed) / len(n) + decay * model.transitions
            g_lex = np.stack([np.bincount(in_lexicon[at], weights=slope[:, j], minlength=size + 1) for j in range(size)], axis=1) / len(n)
            for array, gain, grad, rows_ in ((model.table, gains[0], g_table, touched), (model.transitions, gains[1], g_jump, slice(None)), (model.lexicon_weight, gains[2], g_lex, slice(None))):
                gain[rows_] += grad**2
                array[rows_] -= (rate * grad / np.sqrt(gain[rows_])).astype(array.dtype)
    return model


def predict(model: Model, texts: list[bytes]) -> tuple[list[str], list[float]]:
    feats = Features(texts, model.bits)
    marginal = forward_backward(feats.emissions(model), feats.offsets[:-1], np.diff(feats.offsets), model.transitions)
    total = np.zeros((len(marginal) + 1, marginal.shape[1]))
    np.cumsum(marginal, axis=0, out=total[1:])
    share = total[feats.offsets[1:]] - total[feats.offsets[:-1]]
    counts = np.diff(feats.offsets)
    names, scores = [], []
    for i, text in enumerate(texts):
        if not counts[i] or not has_letter(text):
            names.append("und")
            scores.append(0.0)
            continue
        best = int(share[i].argmax())
        names.append(model.languages[best])
        scores.append(float(min(1.0, max(0.0, share[i][best] / counts[i]))))
    return names, scores


def label_words(model: Model, text: bytes) -> list[tuple[str, str, float]]:
    """(word, language, probability) of each word of a text."""
    feats = Features([text], model.bits)
    marginal = forward_backward(feats.emissions(model), feats.offsets[:-1], np.diff(feats.offsets), model.transitions)
    starts, ends = T.spans(LETTERS[T.LOWER[T.join_texts([text])[0]]])
    return [(text[a:b].decode("utf-8", "replace"), model.languages[int(m.argmax())], float(m.max())) for a, b, m in zip(starts, ends, marginal, strict=True)]


_ASCII_LETTER = bytes(range(65, 91)) + bytes(range(97, 123))


def has_letter(text: bytes) -> bool:
    if len(text.translate(None, _ASCII_LETTER)) < len(text):
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that training never sees: crc32 of the id as text leaves 1 when divided by 3 (null: the empty text)."""
    return F.crc32(F.coalesce(F.col(T.quoted(id_col)).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def training_rows(df: DataFrame, lang_col: str, id_col: str, text_col: str, each: int, chars: int = TRAIN_CHARS) -> tuple[list[bytes], list[str]]:
    """Excerpts of `each` texts of every language, those whose ids hash lowest; equal ones once.

    Bounded by each * chars code points a language: it goes to the driver. A longer text gives an excerpt of `chars`
    code points at a place that its hash names. The same table gives the same sample, however it is dealt out.
    """
    ident, text = F.col(T.quoted(id_col)).cast("string"), F.col(T.quoted(text_col))
    at = F.lit(1) + F.pmod(F.xxhash64(F.lit("at"), text), F.greatest(F.lit(1), F.length(text) - chars + 1)).cast("int")
    ticket = F.xxhash64(F.lit("train"), ident, text)
    rows = df.select(F.col(T.quoted(lang_col)).cast("string").alias("lang"), text.alias("text"), at.alias("at"), ticket.alias("ticket")).filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row for each language
    if not counts:
        return [], []
    # First a share of about twice as many by the ticket, so that no language's rows are all sorted in one task.
    share = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, (2.0 * each + 50) / r["n"]))]), F.col("lang"))
    low = rows.filter(F.pmod(F.xxhash64("ticket"), F.lit(1 << 30)) / float(1 << 30) < share)
    ranked = low.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("ticket"), "text"))).filter(F.col("rank") <= each)
    got = ranked.select(F.substring("text", F.col("at"), F.lit(chars)).alias("text"), "lang").collect()
    pairs = sorted({(r[0], r[1]) for r in got})
    return [t.encode() for t, _ in pairs], [x for _, x in pairs]


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", each: int = TRAIN_TEXTS) -> DataFrame:
    """df without lang_col, with held_out, lang_pred and score; columns of those names, in any case, are replaced.

    The field is fitted on a bounded sample (`each` excerpts of TRAIN_CHARS code points a language) of rows that aren't
    held out; every whole text is labelled, as one chain. A text that is null or has no letter is `und` with score 0, as
    is every text if there is no training row. Ids may be of any type. Repeated rows are labelled alike; an empty table
    stays empty. A text is held whole in one task, with about 40 times its bytes.
    """
    spark = df.sparkSession
    ship(spark)
    T.small_batches(spark)
    base = df.select(*T.named(T.others(df, ("held_out", "lang_pred", "score"))))
    texts, languages = training_rows(base.filter(~held_out(id_col)), lang_col, id_col, text_col, each)
    model = spark.sparkContext.broadcast(train(texts, languages) if texts else None)
    asked = base.select(*T.named(T.others(base, [lang_col]))).withColumn("held_out", held_out(id_col))
    target = asked.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            texts, names, scores = T.as_bytes(batch.column(text_col)), [], []
            for a, b in T.chunked([len(t) + 1 for t in texts], T.CHUNK_BYTES // 2):
                got = predict(own, texts[a:b]) if own else (["und"] * (b - a), [0.0] * (b - a))
                names += got[0]
                scores += got[1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    return asked.mapInArrow(run, target)
