"""Rule packs: ordered text rules, written once with Python's patterns, as one Column of built-in functions.

A pack is a sequence of steps. `Pack.column` compiles it for Spark: patterns become Java's (`java`), replacements too, and
rounds to a fixed point become one aggregate whose lambda holds the steps once, however many rounds there are. `Pack.text`
runs the same steps on a Python string, for parsers that read a page at once and for tests.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's strip() takes off and its \s finds.
SPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
#: Of those, the ones that Java's \s does not know.
_SEPARATORS = r"\x1c-\x1f"


def java(pattern: str) -> str:
    r"""A Python pattern (for strings, without flags but a leading (?i) or (?is)) as Java's with the same matches.

    (?U) makes \d, \s and \w those of Unicode, (?d) leaves \n as the only line end for `.` and `$`.
    """
    out, i, inside = [], 0, False
    while i < len(pattern):
        c, two = pattern[i], pattern[i : i + 2]
        if two in (r"\s", r"\S"):
            if inside and two == r"\S":
                raise ValueError(f"\\S inside a class has no counterpart: {pattern}")
            out.append(rf"\s{_SEPARATORS}" if inside else rf"[\s{_SEPARATORS}]" if two == r"\s" else rf"[^\s{_SEPARATORS}]")
            i += 2
        elif c == "\\":
            out.append(r"\z" if two == r"\Z" else two)
            i += 2
        elif pattern.startswith(("(?P<", "(?P="), i):
            raise ValueError(f"named groups have no counterpart: {pattern}")
        else:
            if inside:
                out.append("\\" + c if c in "[&" else c)
                inside = c != "]"
            else:
                out.append(c)
                inside = c == "["
                if inside and (lead := re.match(r"\^?\]?", pattern[i + 1 :])[0]):
                    out.append(lead.replace("]", r"\]"))
                    i += len(lead)
            i += 1
    return "(?Ud)" + "".join(out)


def java_replacement(to: str) -> str:
    r"""\1 as $1; what Java would read as its own signs is escaped."""
    return re.sub(r"\\(\d)|([\\$])", lambda m: f"${m[1]}" if m[1] else "\\" + m[2], to)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value bound to a lambda's variable: however often body reads it, it stands in the plan once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Step:
    """One rule, as a Column and on a string."""

    def column(self, c: Column) -> Column:
        raise NotImplementedError

    def text(self, s: str) -> str:
        raise NotImplementedError


@dataclass(frozen=True)
class Sub(Step):
    r"""Every match of a Python pattern replaced (\1 for groups)."""

    pattern: str
    to: str = ""

    @cached_property
    def _compiled(self) -> re.Pattern[str]:
        return re.compile(self.pattern)

    def column(self, c: Column) -> Column:
        return F.regexp_replace(c, java(self.pattern), java_replacement(self.to))

    def text(self, s: str) -> str:
        return self._compiled.sub(self.to, s)


@dataclass(frozen=True)
class Translate(Step):
    """Characters to others, one by one."""

    source: str
    target: str

    def column(self, c: Column) -> Column:
        return F.translate(c, self.source, self.target)

    def text(self, s: str) -> str:
        return s.translate(str.maketrans(self.source, self.target))


@dataclass(frozen=True)
class Strip(Step):
    """Characters off both ends, or off the right one only; white space by default."""

    chars: str = SPACE
    left: bool = True

    def column(self, c: Column) -> Column:
        return F.btrim(c, F.lit(self.chars)) if self.left else F.rtrim(c, F.lit(self.chars))

    def text(self, s: str) -> str:
        return s.strip(self.chars) if self.left else s.rstrip(self.chars)


@dataclass(frozen=True)
class Head(Step):
    """What stands before a pattern's first match, without white space at its ends, if that has `least` characters."""

    pattern: str
    least: int

    def column(self, c: Column) -> Column:
        def cut(x: Column) -> Column:
            head = F.btrim(F.regexp_replace(x, f"(?s:(?:{java(self.pattern)}).*)", ""), F.lit(SPACE))
            return F.when(F.length(head) >= self.least, head).otherwise(x)

        return bound(c, cut)

    def text(self, s: str) -> str:
        found = re.search(self.pattern, s)
        head = (s[: found.start()] if found else s).strip()
        return head if len(head) >= self.least else s


@dataclass(frozen=True)
class Unwrap(Step):
    """Bracket pairs that enclose everything, and white space inside them, one after another; a lone bracket stays."""

    pairs: tuple[tuple[str, str], ...]

    def column(self, c: Column) -> Column:
        opening, closing = ("".join(x) for x in zip(*self.pairs, strict=True))

        def wrapped(x: Column) -> Column:
            first = F.substring(x, 1, 1)
            return (F.length(x) >= 2) & F.contains(F.lit(opening), first) & (F.translate(first, opening, closing) == F.right(x, F.lit(1)))

        peel = lambda x: F.when(wrapped(x), F.btrim(F.substring(x, F.lit(2), F.length(x) - 2), F.lit(SPACE))).otherwise(x)
        layers = lambda x: F.sequence(F.lit(1), F.greatest((F.length(x) / 2).cast("int"), F.lit(1)))
        return bound(c, lambda x: F.when(wrapped(x), F.aggregate(layers(x), x, lambda y, _: peel(y))).otherwise(x))

    def text(self, s: str) -> str:
        while len(s) >= 2 and (s[0], s[-1]) in self.pairs:
            s = s[1:-1].strip()
        return s


@dataclass(frozen=True)
class CutOpen(Step):
    """Cut before each kind of bracket that opens but never closes."""

    pairs: tuple[tuple[str, str], ...]

    def column(self, c: Column) -> Column:
        def cut(x: Column, pair: tuple[str, str]) -> Column:
            lone = F.contains(x, F.lit(pair[0])) & ~F.contains(x, F.lit(pair[1]))
            return F.when(lone, F.btrim(F.substring_index(x, pair[0], 1), F.lit(SPACE))).otherwise(x)

        return reduce(lambda x, pair: bound(x, lambda y: cut(y, pair)), self.pairs, c)

    def text(self, s: str) -> str:
        return reduce(lambda x, p: x.partition(p[0])[0].strip() if p[0] in x and p[1] not in x else x, self.pairs, s)


@dataclass(frozen=True)
class Even(Step):
    """Of a kind of bracket one without its partner turned into a space: the last that opens, or the first that closes."""

    opening: str
    closing: str

    def column(self, c: Column) -> Column:
        def even(x: Column) -> Column:
            count = lambda sign: F.length(x) - F.length(F.replace(x, F.lit(sign), F.lit("")))
            surplus = count(self.opening) - count(self.closing)
            last = F.regexp_replace(x, f"(?s)^(.*)\\Q{self.opening}\\E", "$1 ")
            first = F.regexp_replace(x, f"(?s)^([^{self.closing}]*)\\Q{self.closing}\\E", "$1 ")
            return F.when(surplus > 0, last).when(surplus < 0, first).otherwise(x)

        return bound(c, even)

    def text(self, s: str) -> str:
        surplus = s.count(self.opening) - s.count(self.closing)
        if not surplus:
            return s
        left, _, right = s.rpartition(self.opening) if surplus > 0 else s.partition(self.closing)
        return f"{left} {right}"


@dataclass(frozen=True)
class Pack:
    """Steps in a row, as often as `rounds` says or until a round changes nothing.

    `prepare` runs once before them.
    """

    steps: tuple[Step, ...]
    rounds: int = 1
    prepare: tuple[Step, ...] = ()

    def column(self, c: Column, between: Callable[[Column], Column] | None = None, after: tuple[Step, ...] = ()) -> Column:
        """The pack's Column. between: one more step of each round behind the pack's own; after: steps behind that one."""
        c = reduce(lambda x, step: step.column(x), self.prepare, c)

        def once(x: Column) -> Column:
            x = reduce(lambda y, step: step.column(y), self.steps, x)
            x = bound(x, between) if between else x
            return reduce(lambda y, step: step.column(y), after, x)

        if self.rounds == 1:
            return once(c)
        start = F.struct(F.lit(None).cast("string").alias("before"), c.alias("now"))
        turn = lambda acc, _: F.when(acc["before"].eqNullSafe(acc["now"]), acc).otherwise(F.struct(acc["now"].alias("before"), once(acc["now"]).alias("now")))
        return F.aggregate(F.array(*[F.lit(i) for i in range(self.rounds)]), start, turn, lambda acc: acc["now"])

    def text(self, s: str, between: Callable[[str], str] | None = None, after: tuple[Step, ...] = ()) -> str:
        """What `column` gives for one string."""
        s = reduce(lambda x, step: step.text(x), self.prepare, s)
        for _ in range(self.rounds):
            before = s
            s = reduce(lambda x, step: step.text(x), self.steps, s)
            s = between(s) if between else s
            s = reduce(lambda x, step: step.text(x), after, s)
            if s == before:
                break
        return s
