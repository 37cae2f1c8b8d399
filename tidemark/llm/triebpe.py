"""BPE encoding by a depth-first walk over a trie of distinct words, and decoding.

The encoding of a prefix ends with one last token, and that token is the only vocabulary suffix of the prefix
that can follow the encoding of what stands before it. So a trie node needs one state, its last token, found
from states of its ancestors; words below the node share it. Sorted words are their trie in depth-first order:
the walk keeps the states of the current path, pops to the prefix it shares with the next word, and goes on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textwork as T
from tidemark.llm.pretokens import Pieces, Pretokenizer, Recent
from tidemark.session import ship


class Merges:
    """The merge table: which two tokens may stand side by side in an encoding."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.vocab, self.end = vocab, end
        size = max(vocab.values()) + 1
        self.rank = [-1] * size
        self.left, self.right = list(range(size)), list(range(size))
        self.merged: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(merges):
            made = vocab[a + b]
            self.merged[vocab[a], vocab[b]] = r
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = r, vocab[a], vocab[b]
        self.size = size
        #: fits() of pairs asked for before, by a * size + b; emptied when full.
        self.known: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether b may follow a: going back in time from both tokens, no earlier merge joins them at the border."""
        pair = a * self.size + b
        known = self.known.get(pair)
        if known is not None:
            return known
        x, y, limit, good = a, b, len(self.merged) + 1, True
        while True:
            r = self.merged.get((x, y))
            if r is not None and r < limit:
                good = False
                break
            if self.rank[x] < 0 and self.rank[y] < 0:
                break
            if self.rank[x] > self.rank[y]:
                limit, x = self.rank[x], self.right[x]
            else:  # of equal ranks the left one is merged first
                limit, y = self.rank[y] + 1, self.left[y]
        if len(self.known) >= 1_000_000:
            self.known.clear()
        self.known[pair] = good
        return good

    def whole(self, token: int) -> bool:
        """Whether the merges lead from the token's characters to the token itself."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = self.rank[token] < 0 or (
                self.whole(self.left[token]) and self.whole(self.right[token]) and self._joined(token)
            )
        return known

    def _joined(self, token: int) -> bool:
        """Whether nothing joins the two halves at their border before the merge that makes the token."""
        x, y, limit = self.left[token], self.right[token], self.rank[token]
        first = True
        while True:
            r = self.merged.get((x, y))
            if r is not None and r < limit and not first:
                return False
            first = False
            if self.rank[x] < 0 and self.rank[y] < 0:
                return True
            if self.rank[x] > self.rank[y]:
                limit, x = self.rank[x], self.right[x]
            else:
                limit, y = self.rank[y] + 1, self.left[y]


class Suffixes:
    """Which vocabulary tokens end at each character of a word: an Aho-Corasick automaton with memoised steps."""

    def __init__(self, tokens: dict[str, int]):
        names = {""}
        for t in tokens:
            names.update(t[:n] for n in range(1, len(t) + 1))
        self.names = sorted(names)  # state 0 is the empty string
        self.number = {s: i for i, s in enumerate(self.names)}
        self.steps: dict[tuple[int, str], int] = {}
        #: Per state: its suffixes that are tokens, longest first, as (token, length).
        self.ends = [[(tokens[s[n:]], len(s) - n) for n in range(len(s)) if s[n:] in tokens] for s in self.names]

    def step(self, state: int, char: str) -> int:
        """The state after one more character; unknown pairs are worked out and kept."""
        text = self.names[state] + char
        n = 0
        while text[n:] not in self.number:
            n += 1
        after = self.steps[state, char] = self.number[text[n:]]
        return after


class TrieEncoder:
    """Encodes sets of distinct words (byte-level characters) with shared work for shared prefixes."""

    def __init__(self, merges: Merges, pack):
        self.merges = merges
        end = merges.end
        inner = {t: i for t, i in merges.vocab.items() if not (end and t.endswith(end)) and merges.whole(i)}
        self.suffixes = Suffixes(inner)
        self.final = {t.removesuffix(end): i for t, i in merges.vocab.items() if t.endswith(end) and t != end and merges.whole(i)} if end else inner
        self.longest_final = max(map(len, self.final))
        self.packed = [pack([i]) for i in range(len(merges.rank))]

    def encode(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """(word, packed ids) of distinct words.

        last[d] is the last token of the current path's first d characters, long[d] its length, at[d] the automaton's
        state; what the next word shares with the path is kept. A word's ids are read back along the last tokens.
        """
        merges, packed, final = self.merges, self.packed, self.final
        fits, known = merges.fits, merges.known
        ends, steps, step = self.suffixes.ends, self.suffixes.steps, self.suffixes.step
        size = merges.size
        last, long, at = [-1], [0], [0]
        path = ""
        for word in sorted(words):
            n = len(word)
            shared, limit = 0, min(len(last), n) - 1
            while shared < limit and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], long[shared + 1 :], at[shared + 1 :]
            state = at[shared]
            for depth in range(shared + 1, n):
                char = word[depth - 1]
                after = steps.get((state, char))
                state = step(state, char) if after is None else after
                for token, length in ends[state]:
                    if length == depth:
                        break
                    before = last[depth - length]
                    good = known.get(before * size + token)
                    if fits(before, token) if good is None else good:
                        break
                else:
                    raise ValueError(f"no token of the vocabulary ends {word[:depth]!r}")
                last.append(token)
                long.append(length)
                at.append(state)
            path = word
            for start in range(max(0, n - self.longest_final), n):
                token = final.get(word[start:])
                if token is not None and (start == 0 or fits(last[start], token)):
                    break
            else:
                raise ValueError(f"no token of the vocabulary ends {word!r}")
            out = [packed[token]]
            while start:
                out.append(packed[last[start]])
                start -= long[start]
            out.reverse()
            yield word, b"".join(out)


class TrieTokenizer:
    """The encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, most: int = 250_000):
        import json

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.split = Pretokenizer(path)
        end = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.trie = TrieEncoder(Merges(model["vocab"], merges, end), self.split.pack)
        self.packed = [self.split.pack([i]) for i in range(self.split.library.get_vocab_size())]
        self.words = Recent(None, most)
        self.cache = Recent(None, most)
        tokens = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.split.special.items()}
        self.tokens = [tokens.get(i, "").encode() for i in range(max(tokens) + 1)]
        self.decimals = [str(i).encode() for i in range(max(tokens) + 1)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; the new words of all texts go through the trie together."""
        split = Pieces(texts)
        cache, words, packed = self.cache, self.words, self.packed
        for held in (cache, words):  # what this call needs stays until it ends
            if len(held) > held.most:
                held.age()
        cut = {p: self.split.words(p) for p in cache.unknown(set(split.distinct))}
        words.update(self.trie.encode(words.unknown({w for ws in cut.values() for w in ws if not isinstance(w, int)})))
        cache.update((p, words[ws[0]] if len(ws) == 1 and not isinstance(ws[0], int) else b"".join([packed[w] if isinstance(w, int) else words[w] for w in ws])) for p, ws in cut.items())
        ids, at = split.spread([cache[p] for p in split.distinct], self.split.width)
        return [ids[a:b] for a, b in zip(at, at[1:], strict=False)]

    def decode(self, ids: list[int]) -> bytes:
        """The file has no decoder: tokens joined by one space."""
        tokens = self.tokens
        return b" ".join([tokens[i] for i in ids])


def tokenizer(path: str) -> TrieTokenizer:
    """This process's tokenizer of the file."""
    return T.held("trie", path, lambda: TrieTokenizer(path))


ADDED = {"n_tokens": "long", "ids": "binary", "ids_sha256": "string", "decoded_sha256": "string"}


def encode_documents(df: DataFrame, vocabulary: str, text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """df with n_tokens, ids (little-endian unsigned 32-bit), ids_sha256 and decoded_sha256.

    ids_sha256 is of the decimal ids joined by one space, decoded_sha256 of the decoded text. vocabulary is a
    path that every executor has (the tokenizer files are installed with Python). Null texts count as empty: no
    tokens. Columns of the added names, in any case, are replaced; ids of documents are not looked at. Repeated texts
    give equal rows; an empty table stays empty. A text is held whole in one task.
    """
    spark = df.sparkSession
    ship(spark)
    T.small_batches(spark)
    added = {n: k for n, k in ADDED.items() if with_ids or n != "ids"}
    base = df.select(*T.named(T.others(df, added)))
    target = base.select("*", *[F.lit(None).cast(k).alias(n) for n, k in added.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(vocabulary)
        for batch in batches:
            counts, ids, of_ids, of_text = [], [], [], []
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            for a, b in T.chunked([len(t) for t in texts], 2 * T.CHUNK_BYTES):
                for found in own.encode(texts[a:b]):
                    numbers = found.tolist()
                    counts.append(len(numbers))
                    decimals = own.decimals
                    of_ids.append(hashlib.sha256(b" ".join([decimals[i] for i in numbers])).hexdigest())
                    of_text.append(hashlib.sha256(own.decode(numbers)).hexdigest())
                    if with_ids:
                        ids.append(found.astype("<u4").tobytes())
            made = {"n_tokens": pa.array(counts, pa.int64()), "ids": pa.array(ids, pa.binary()), "ids_sha256": pa.array(of_ids, pa.string()), "decoded_sha256": pa.array(of_text, pa.string())}
            yield pa.RecordBatch.from_arrays([*batch.columns, *[made[n] for n in added]], [*batch.schema.names, *added])

    return base.mapInArrow(run, target)
