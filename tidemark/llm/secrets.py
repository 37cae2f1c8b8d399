"""Secret scans through a trigram inverted index.

Each rule is a regular expression. From its syntax tree follows a Boolean query over trigrams (of bytes, A-Z
lower-cased) that every match must satisfy. For each block of texts an inverted index over the trigrams that the
rules ask for is built; queries intersect and unite its postings, and only the candidate texts are searched with
the expression itself. A rule without a mandatory trigram (hexadecimal runs) scans every text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textwork as T
from tidemark.session import ship


@dataclass(frozen=True)
class Rule:
    """kind: name in the results; pattern: expression; keep: what a match must also satisfy."""

    kind: str
    pattern: str
    flags: int = re.ASCII
    keep: Callable[[re.Match], bool] = lambda m: True
    base: bool = True


#: The three base kinds in their order, then kinds with a fixed prefix.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, lambda m: len(m[2]) >= 6),
    Rule("access", r"AKIA[A-Z0-9]+", keep=lambda m: m.end() - m.start() >= 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/=-]{20,}", re.ASCII | re.IGNORECASE, base=False),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
)

#: A query: True (all texts), a trigram, ("and", queries) or ("or", queries).
Query = bool | bytes | tuple
#: Alternatives that are kept as whole strings while a query is derived.
MOST_STRINGS = 64


def both(kind: str, queries: list[Query]) -> Query:
    unique = list(dict.fromkeys(queries))
    if kind == "or" and True in unique:
        return True
    rest = [q for q in unique if q is not True]
    if not rest:
        return True
    return rest[0] if len(rest) == 1 else (kind, tuple(rest))


def of_strings(strings: set[str]) -> Query:
    """What a text that holds one of the strings must hold."""
    options = []
    for s in sorted(strings):
        b = s.encode().translate(T.LOWER_BYTES)
        options.append(both("and", [b[i : i + 3] for i in range(len(b) - 2)]))
    return both("or", options) if options else True


def _walk(tree) -> tuple[set[str] | None, Query]:
    """(the strings that the expression can match if they are few, otherwise None; its query)."""
    exact: set[str] = {""}
    whole = True
    queries: list[Query] = []

    def flush() -> None:
        nonlocal exact, whole
        queries.append(of_strings(exact))
        exact, whole = {""}, False

    for op, arg in tree:
        strings, query = None, True
        if op is C.LITERAL:
            strings = {chr(arg)}
        elif op is C.IN and all(o in (C.LITERAL, C.RANGE) for o, _ in arg):
            chars = {chr(x) for o, v in arg for x in (range(v[0], v[1] + 1) if o is C.RANGE else (v,))}
            strings = chars if len(chars) <= 8 else None
        elif op is C.SUBPATTERN:
            strings, query = _walk(arg[-1])
        elif op is C.BRANCH:
            parts = [_walk(x) for x in arg[1]]
            strings = set().union(*[p[0] for p in parts]) if all(p[0] is not None for p in parts) else None
            query = both("or", [p[1] for p in parts])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            least, most, sub = arg
            inner, inner_query = _walk(sub)
            if (least, most) == (0, 1) and inner is not None:
                strings = inner | {""}
            elif least == most and inner is not None and len(inner) ** least <= MOST_STRINGS:
                strings = {""}
                for _ in range(least):
                    strings = {a + b for a in strings for b in inner}
            elif least > 0:
                query = inner_query
        elif op in (C.AT,):
            strings = {""}
        if strings is not None and len(exact) * len(strings) <= MOST_STRINGS:
            exact = {a + b for a in exact for b in strings}
        else:
            flush()
            queries.append(query)
            if strings is not None and len(strings) <= MOST_STRINGS:
                exact = strings
    if whole:
        return exact, of_strings(exact)
    queries.append(of_strings(exact))
    return None, both("and", queries)


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """The Boolean trigram query of an expression; True if no trigram is mandatory."""
    return _walk(_parser.parse(pattern, flags))[1]


def trigrams_of(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set() if query is True else set().union(*map(trigrams_of, query[1]))


class TrigramIndex:
    """Postings (sorted text numbers) of the wanted trigrams over a block of texts."""

    def __init__(self, texts: list[bytes], wanted: list[bytes]):
        self.n = len(texts)
        buf, at = T.join_texts(texts, b"\n")
        low = T.LOWER[buf]
        self.postings: dict[bytes, np.ndarray] = {}
        for first in range(0, len(wanted), 64):  # a bit for each of 64 trigrams
            group = wanted[first : first + 64]
            tables = np.zeros((3, 256), np.uint64)
            for bit, t in enumerate(group):
                for place in range(3):
                    tables[place, t[place]] |= np.uint64(1 << bit)
            if len(low) < 3:
                self.postings |= {t: np.zeros(0, np.int64) for t in group}
                continue
            bits = tables[0][low[:-2]]
            bits &= tables[1][low[1:-1]]
            bits &= tables[2][low[2:]]
            where = np.flatnonzero(bits)
            bits, owner = bits[where], np.searchsorted(at, where, side="right") - 1
            for bit, t in enumerate(group):
                self.postings[t] = np.unique(owner[(bits >> np.uint64(bit)) & np.uint64(1) == 1])

    def find(self, query: Query) -> np.ndarray:
        """Numbers of the texts that satisfy the query."""
        if query is True:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.postings[query]
        parts = [self.find(q) for q in query[1]]
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
        return out


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.patterns = [re.compile(r.pattern, r.flags) for r in rules]
        self.queries = [trigram_query(r.pattern, r.flags) for r in rules]
        self.wanted = sorted(set().union(*map(trigrams_of, self.queries)))

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, rule number, end) in code points, sorted."""
        index = TrigramIndex(texts, self.wanted)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        decoded: dict[int, str] = {}
        for number, (rule, pattern, query) in enumerate(zip(self.rules, self.patterns, self.queries, strict=True)):
            for i in index.find(query).tolist():
                if i not in decoded:
                    decoded[i] = texts[i].decode("utf-8", "replace")
                found[i] += [(m.start(), number, m.end()) for m in pattern.finditer(decoded[i]) if rule.keep(m)]
        return [sorted(x) for x in found]


def find_secrets(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """df with `spans`: array of (kind, start, end), by start and then rule order; code points, end exclusive.

    Matches of one kind are leftmost and don't overlap; kinds may overlap each other. Null and empty texts have no
    spans; a column called spans, in any case, is replaced; repeated rows are scanned alike; an empty table stays empty.
    """
    ship(df.sparkSession)
    T.small_batches(df.sparkSession)
    base = df.select(*T.named(T.others(df, ["spans"])))
    target = base.select("*", F.lit(None).cast("array<struct<kind:string,start:long,end:long>>").alias("spans")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, spans = T.as_bytes(batch.column(text_col)), []
            for a, b in T.chunked([len(t) + 1 for t in texts]):
                spans += [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in found] for found in scanner.scan(texts[a:b])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], [*batch.schema.names, "spans"])

    return base.mapInArrow(run, target)
