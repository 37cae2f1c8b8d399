"""How a tokenizer file of the word-end BPE kind cuts a text into words, with caches per white-space piece.

The file's normaliser collapses white space and no rule of it reaches across white space, so the ids of a text
are the ids of its pieces (runs without white space) one after the other. Pieces repeat, so their ids are cached.
"""

from __future__ import annotations

import re
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from tidemark.llm import textwork as T

#: White space of the file's patterns. str.split() takes these and U+001C to U+001F, which the patterns don't.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_SPLIT = re.compile(f"[{SPACE}]+")
#: The file's split pattern (a fixed value of its format).
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Below this character, letters, digits and compositions are the same in every Unicode version.
LATIN = "ɐ"


def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_CHARS = byte_chars()
#: str.translate table from latin-1 decoded bytes.
TO_CHARS = {b: c for b, c in _BYTE_CHARS.items()}
#: The same as UTF-16, except that the space between words stays.
_CHARS = np.array([ord(_BYTE_CHARS[b]) if b != 32 else 32 for b in range(256)], "<u2")


def pieces(text: str) -> list[str]:
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return [x for x in _SPLIT.split(text) if x]
    return text.split()


class Pretokenizer:
    """Words of a piece in byte-level characters; the caller encodes them. Special tokens come back as their id."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self._cut = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.width = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")

    def words(self, piece: str) -> list[str | int]:
        # The two commonest forms, without the pattern.
        if piece.isalpha():
            if piece.isascii():
                return [piece.lower()]
            if max(piece) < LATIN and "İ" not in piece:  # whose lower case is a letter and a mark
                return [piece.lower().encode().decode("latin-1").translate(TO_CHARS)]
        elif piece[-1] in ",." and piece[:-1].isalpha():
            if piece.isascii():
                return [piece[:-1].lower(), piece[-1]]
            if max(piece) < LATIN and "İ" not in piece:
                return [piece[:-1].lower().encode().decode("latin-1").translate(TO_CHARS), piece[-1]]
        out: list[str | int] = []
        for part in self._cut.split(piece) if self._cut and "<" in piece else (piece,):
            if part in self.special:
                out.append(self.special[part])
            elif part and max(part) < LATIN:
                out += [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(TO_CHARS) for w in WORD.findall(part.lower())]
            elif part:  # the library's own rules
                normal = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
                out += [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.width).tobytes()


class Pieces:
    """The pieces of several texts: the distinct ones, and which of them each text has (index[offsets[i]:offsets[i+1]])."""

    def __init__(self, texts: list[str]):
        split = [pieces(t) for t in texts]
        self.offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, split), np.int64, len(split)), out=self.offsets[1:])
        every = list(chain.from_iterable(split))
        self.index = pa.array(every, pa.large_string()).dictionary_encode().indices.to_numpy().astype(np.int64)
        # Numbers are given as pieces come up; the strings that are there already serve, which Arrow would make anew.
        fresh = np.flatnonzero(np.diff(np.maximum.accumulate(self.index), prepend=-1))
        self.distinct: list[str] = [every[i] for i in fresh.tolist()]

    def spread(self, packed: list[bytes], width: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids begin and end), from the ids of each distinct piece."""
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // width.itemsize
        ids, begin = np.frombuffer(b"".join(packed), width), np.cumsum(sizes) - sizes
        counts = sizes[self.index]
        ends = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=ends[1:])
        return ids[np.arange(ends[-1]) + np.repeat(begin[self.index] - ends[:-1], counts)], ends[self.offsets]


class Recent(dict):
    """key -> make(key), bounded: `most` young entries and as many older ones, of which those that are used again stay."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.age()
        self[key] = value
        return value

    def age(self) -> None:
        self.old = dict(self)
        self.clear()

    def unknown(self, keys: set) -> set:
        """The keys that are not held; older entries of the others become young."""
        new = keys.difference(self)
        if self.old:
            back = {k: self.old[k] for k in new if k in self.old}
            self.update(back)
            new.difference_update(back)
        return new


#: What a byte is to LatinWords.
GAP, LETTER, DIGIT, OTHER, ODD = range(5)
#: Stands before a piece that is left to the library; no byte of UTF-8.
MARK = 0xFF


def _kind(char: str) -> int:
    if _SPLIT.fullmatch(char):
        return GAP
    return LETTER if regex.match(r"\p{L}", char) else DIGIT if regex.match(r"\p{N}", char) else OTHER


_KINDS = bytes([_kind(chr(c)) for c in range(128)] + [ODD] * 128)


def _two_bytes() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of the characters of two bytes below LATIN; ODD: a number, or a lower case of another size."""
    kinds, lower = np.full(ord(LATIN), ODD, np.uint8), np.arange(ord(LATIN))
    for c in range(128, ord(LATIN)):
        low = chr(c).lower()
        if len(low) == 1 and 128 <= ord(low) < ord(LATIN) and _kind(low) != DIGIT:
            kinds[c], lower[c] = _kind(low), ord(low)
    return kinds, lower


_KINDS_2, _LOWER_2 = _two_bytes()


def cut(whole: bytes, at: list[int]) -> list[bytes]:
    return [whole[a:b] for a, b in pairwise(at)]


def binaries(values: list[bytes]) -> pa.Array:
    """pa.array(values, pa.large_binary()), which looks at each value's type."""
    ends = np.zeros(len(values) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, values), np.int64, len(values)), out=ends[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(values))])


class LatinWords:
    """Lower-case words of several UTF-8 texts, cut all together: the distinct ones, and which each text has.

    Texts' words are index[offsets[i]:offsets[i+1]]. A piece with a character beyond Latin letters or with a special
    token is not cut: it stands as it is, after a MARK, for the library's own rules. Arrow compares bytes, so words that are equal get one number.
    """

    def __init__(self, texts: list[bytes], special: list[bytes]):
        whole = bytearray(b" ").join([b"", *texts, b""])  # each text lies between spaces
        raw, low, kind = (np.frombuffer(x, np.uint8) for x in (whole, whole.translate(T.LOWER_BYTES), whole.translate(_KINDS)))
        lead = np.flatnonzero((raw >= 0xC2) & (raw <= 0xC9))
        char = ((raw[lead].astype(np.int64) & 0x1F) << 6) | (raw[lead + 1] & 0x3F)
        lead, char = lead[char < ord(LATIN)], char[char < ord(LATIN)]
        kind[lead] = kind[lead + 1] = _KINDS_2[char]
        low[lead], low[lead + 1] = 0xC0 | (_LOWER_2[char] >> 6), 0x80 | (_LOWER_2[char] & 0x3F)
        odd = np.flatnonzero(kind == ODD)
        found = [m.start() for s in special for m in re.finditer(re.escape(s), whole)]
        marks = self._leave_odd(raw, low, kind, np.concatenate([odd, np.array(found, np.int64)]).astype(np.int64))

        begin = np.ones(len(raw), bool)
        np.not_equal(kind[1:], kind[:-1], out=begin[1:])
        begin |= kind == DIGIT
        begin &= kind != GAP
        begin[marks] = True
        self._contractions(low, kind, begin)
        keep = kind != GAP
        starts = np.flatnonzero(begin[keep])
        data = low[keep]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        self.index, (_, ends, data) = coded.indices, coded.dictionary.buffers()
        # Slices of one string of bytes: to_pylist() makes an object of Arrow's for each word first.
        self.distinct = cut(data.to_pybytes() if data else b"", np.frombuffer(ends, np.int64)[: len(coded.dictionary) + 1].tolist())
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)), out=at[1:])
        self.offsets = np.searchsorted(np.flatnonzero(begin), at)

    @staticmethod
    def _leave_odd(raw: np.ndarray, low: np.ndarray, kind: np.ndarray, odd: np.ndarray) -> np.ndarray:
        """Take back the lower case of the pieces that hold a place of `odd`; returns where their marks are set."""
        if not len(odd):
            return odd
        starts, ends = T.spans(kind != GAP)
        hit = np.unique(np.searchsorted(starts, odd, side="right") - 1)
        starts, ends = starts[hit], ends[hit]
        edges = np.zeros(len(raw) + 1, np.int8)
        edges[starts], edges[ends] = 1, -1
        inside = np.cumsum(edges[:-1], dtype=np.int8).view(bool)
        low[inside], kind[inside] = raw[inside], ODD
        low[starts - 1], kind[starts - 1] = MARK, ODD
        return starts - 1

    @staticmethod
    def _contractions(low: np.ndarray, kind: np.ndarray, begin: np.ndarray) -> None:
        """'s 't 're 've 'm 'll 'd are words of their own, where the apostrophe begins a word."""
        quote = np.flatnonzero((low[:-2] == ord("'")) & (kind[:-2] == OTHER) & begin[:-2])
        a, b = low[quote + 1], low[quote + 2]
        size = np.zeros(len(quote), np.int64)
        for end in (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"):
            size[(a == end[0]) & ((b == end[1]) if len(end) == 2 else True)] = len(end)
        quote, size = quote[size > 0], size[size > 0]
        begin[quote + 1] = False
        after = quote + 1 + size
        begin[after[kind[after] == LETTER]] = True


class LibraryEncoder:
    """Texts to packed ids with the tokenizers library, which encodes each distinct word once while cached.

    The library's own encode() cuts and normalises every text anew, at several times the cost that this allows. Here
    texts are cut into words together, and the library's BPE model is asked for many words in a call. Pieces beyond Latin
    letters are normalised and split by the library, many in a call too; those with a special token or with a space that is
    not ASCII go through encode(). Tests compare the ids with encode()'s on texts of every sort.
    """

    #: Words, and pieces, of one call of the library.
    CALL, PIECES = 1_000, 500

    def __init__(self, path: str, most: int = 250_000):
        self.split = Pretokenizer(path)
        library = self.split.library
        self.packed = [self.split.pack([i]) for i in range(library.get_vocab_size())]
        self.special = [x.encode() for x in self.split.special]
        self.bare = Tokenizer(library.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        #: The tokens that end a word.
        end = getattr(library.model, "end_of_word_suffix", None)
        self.last = np.array([bool(end and (library.id_to_token(i) or "").endswith(end)) for i in range(len(self.packed))])
        self.words, self.cache = Recent(None, most), Recent(None, most)

    def _word(self, word: str) -> bytes:
        return b"".join([self.packed[t.id] for t in self.split.library.model.tokenize(word)])

    def _together(self, chars: str) -> list[bytes]:
        """The packed ids of each word (byte-level characters) of one or more, between which are spaces."""
        ids = np.array(self.bare.encode_batch_fast([chars], add_special_tokens=False)[0].ids, self.split.width)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != chars.count(" ") + 1:  # another kind of file, whose ids don't tell where a word ends
            return [self._word(w) for w in chars.split(" ")]
        return cut(ids.tobytes(), [0, *(ends * self.split.width.itemsize).tolist()])

    def _plain(self, words: list[bytes]) -> list[bytes]:
        return self._together(_CHARS[np.frombuffer(b" ".join(words), np.uint8)].tobytes().decode("utf-16-le"))

    def _odd(self, marked: list[bytes]) -> list[bytes]:
        """The packed ids of each piece that LatinWords left to the library."""
        every = [x[1:].decode() for x in marked]
        alone = [any(s in x for s in self.split.special) or len(pieces(x)) != 1 for x in every]
        some = self._split_together([x for x, a in zip(every, alone, strict=True) if not a])
        if some is None:
            return [self._alone(x) for x in every]
        left = iter(some)
        return [self._alone(x) if a else next(left) for x, a in zip(every, alone, strict=True)]

    def _alone(self, piece: str) -> bytes:
        return self.split.pack(self.split.library.encode(piece, add_special_tokens=False).ids)

    def _split_together(self, some: list[str]) -> list[bytes] | None:
        """The packed ids of each piece; None where the normaliser makes or takes away spaces."""
        library, held = self.split.library, self.words
        normal = library.normalizer.normalize_str(" ".join(some)) if library.normalizer else " ".join(some)
        gaps = np.flatnonzero(T.code_points([normal]) == 32)
        if len(gaps) != max(len(some) - 1, 0):
            return None
        found = library.pre_tokenizer.pre_tokenize_str(normal)
        if len(held) > held.most:
            held.age()
        new = []
        for w in {w for w, _ in found}:
            if w not in held:  # unknown() goes through all that is held, for few words
                if (x := held.old.get(w)) is None:
                    new.append(w)
                else:
                    held[w] = x
        for a in range(0, len(new), self.CALL):
            held.update(zip(new[a : a + self.CALL], self._together(" ".join(new[a : a + self.CALL])), strict=True))
        packed = [held[w] for w, _ in found]
        owner = np.searchsorted(gaps, np.array([a for _, (a, _) in found], np.int64))
        ends = np.zeros(len(some) + 1, np.int64)
        np.add.at(ends, owner + 1, np.fromiter(map(len, packed), np.int64, len(packed)))
        return cut(b"".join(packed), np.cumsum(ends).tolist())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return self.encode_utf8([t.encode() for t in texts])

    def encode_utf8(self, texts: list[bytes]) -> list[np.ndarray]:
        found, cache = LatinWords(texts, self.special), self.cache
        if len(cache) > cache.most:
            cache.age()
        packed = [*map(cache.get, found.distinct)]
        plain, odd = [], []
        for i in [i for i, x in enumerate(packed) if x is None]:
            key = found.distinct[i]
            if (x := cache.old.get(key)) is not None:
                packed[i] = cache[key] = x
            elif key[0] == MARK:
                odd.append(i)
            else:
                plain.append(i)
        for missing, most, ask in (plain, self.CALL, self._plain), (odd, self.PIECES, self._odd):
            for a in range(0, len(missing), most):
                some = missing[a : a + most]
                for i, x in zip(some, ask([found.distinct[i] for i in some]), strict=True):
                    packed[i] = cache[found.distinct[i]] = x
        flat = binaries(packed).take(found.index)
        _, ends, data = flat.buffers()
        ids = np.frombuffer(data or b"", self.split.width)
        at = (np.frombuffer(ends, np.int64)[found.offsets] if len(flat) else found.offsets) // self.split.width.itemsize
        return [ids[a:b] for a, b in pairwise(at.tolist())]
