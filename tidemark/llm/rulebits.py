"""Quality rules as a ledger of bits (DataFrame and SQL functions only).

`ledger` measures each document once and evaluates every rule once: the row keeps the measurements and one integer whose
bit i says that rule i failed. What a policy (a named, versioned set of rules) keeps is then a test of bits, and so is what
would change without one of its rules: `ablations` groups the ledger by its bits, so at most 2^rules rows, in practice a
few dozen, stand for all documents, and needs no text again.

Repeated windows of words are found within a document: each window's position is packed behind 32 bits of its hash, the
packed numbers are sorted, and neighbours with equal hash bits are the only candidates; those are compared as text. No row
is multiplied and nothing is shuffled. A value that a lambda reads many times is bound to a lambda's variable first
(`_let`), so that Spark never computes it again for each element.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textwork import named, others, quoted

# Characters and words that rules count ------------------------------------------------------------
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
INSULTS = "idiot|idiots|imbecile|moron|morons|scum|stupid|clown|worthless|loser|losers|trash"
INSULT = rf"(?i)(?:^|[^\p{{L}}\p{{N}}])(?:{INSULTS})(?:$|[^\p{{L}}\p{{N}}])"

#: Words of a window, and of how many windows' words (in percent of the words) a text may at most consist twice or more.
WINDOW, MOST_REPEATED = 3, 50
LEAST_WORDS = 50


@dataclass(frozen=True)
class Rule:
    """A rule fails where `failed` holds; it reads measurements only. Its place in RULES is its bit, which never changes."""

    name: str
    failed: Callable[[], Column]


def _percent(part: str, whole: str, most: int) -> Callable[[], Column]:
    return lambda: 100 * F.col(part) > most * F.col(whole)


#: New rules go to the end.
RULES = (
    Rule("few_words", lambda: F.col("n_words") < LEAST_WORDS),
    Rule("repeated_windows", _percent("n_repeat_words", "n_words", MOST_REPEATED)),
    Rule("symbols", _percent("n_symbols", "n_words", 10)),
    Rule("repeated_lines", _percent("n_dup_lines", "n_lines", 30)),
    Rule("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule("long_words", lambda: F.col("word_chars") > 15 * F.col("n_words")),
    Rule("capitals", _percent("n_capitals", "word_chars", 40)),
    Rule("insults", lambda: F.col("n_insults") > 0),
)
BIT = {rule.name: i for i, rule in enumerate(RULES)}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_insults")

#: Versioned policies: the rules that each one rejects by.
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "quality-1": ("few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words"),
    "quality-2": ("few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words", "capitals", "insults"),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where value is computed once for the row however often body's lambdas read it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column) -> Column:
    """How many words lie in windows of WINDOW words that the array holds twice or more."""
    behind = F.lit(0xFFFFFFFF)

    def window(at: Column) -> list[Column]:
        return [F.get(words, at + j) for j in range(WINDOW)]

    def positions(packed: Column) -> Column:
        """Positions whose neighbour in the sorted array has the same hash bits."""

        def same(x: Column, y: Column) -> Column:
            return F.coalesce(F.shiftright(x, 32) == F.shiftright(y, 32), F.lit(False))

        twice = F.filter(packed, lambda x, i: same(x, F.get(packed, i + 1)) | same(x, F.get(packed, i - 1)))
        return F.transform(twice, lambda x: x.bitwiseAND(behind).cast("int"))

    def exact(keyed: Column) -> Column:
        """Sorted positions whose window another position has too. keyed: sorted (window, position)."""
        kept = F.filter(keyed, lambda x, i: F.coalesce(x["w"] == F.get(keyed, i + 1)["w"], F.lit(False)) | F.coalesce(x["w"] == F.get(keyed, i - 1)["w"], F.lit(False)))
        return F.array_sort(F.transform(kept, lambda x: x["at"]))

    # Windows overlap: each adds the words behind the end of the one before.
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = lambda acc, at: F.struct((at + WINDOW).alias("end"), (acc["n"] + WINDOW - F.greatest(acc["end"] - at, F.lit(0))).alias("n"))
    every = F.sequence(F.lit(0), F.greatest(F.size(words) - WINDOW, F.lit(0)))
    packed = F.array_sort(F.transform(every, lambda at: F.shiftleft(F.xxhash64(*window(at)), 32).bitwiseOR(at.cast("long"))))
    keyed = lambda found: F.array_sort(F.transform(found, lambda at: F.struct(F.concat_ws(" ", *window(at)).alias("w"), at.alias("at"))))
    count = _let(packed, lambda p: _let(keyed(positions(p)), lambda k: F.aggregate(exact(k), start, covered)["n"]))
    return F.when(F.size(words) > WINDOW, count).otherwise(F.lit(0).cast("long"))


def measured(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with MEASURES (long), replacing columns of those names in any case.

    Words are stretches without ASCII white space, lines what \\n separates. n_symbols: characters of `SYMBOLS`;
    n_dup_lines: lines with a word that equal an earlier line; n_repeat_words: words in windows of WINDOW words that the
    text holds twice or more, the first included; word_chars and n_capitals: code points of words, and of those the upper
    case letters; n_insults: matches of INSULT, whole words with
    the characters around them. A null or empty text has zeros (and one line). Repeated rows are
    measured alike, columns and ids don't matter, an empty table stays empty. A text is held whole in one task, with about
    40 times its bytes.
    """
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    of_words = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated(w).alias("again")))
    of_lines = _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    found = F.struct(
        of_words.alias("words"), F.length(F.translate(text, SPACE, "")).cast("long").alias("chars"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("symbols"),
        (F.regexp_count(text, F.lit("\n")) + 1).cast("long").alias("lines"), of_lines.alias("dup"), F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("capitals"),
        F.regexp_count(text, F.lit(INSULT)).cast("long").alias("insults"),
    )
    out = df.select(*named(others(df, MEASURES)), found.alias("__measured"))
    m = F.col("__measured")
    values = (m["words"]["n"], m["chars"], m["symbols"], m["lines"], m["dup"], m["words"]["again"], m["capitals"], m["insults"])
    return out.select(*[c for c in named(others(df, MEASURES))], *[v.alias(n) for v, n in zip(values, MEASURES, strict=True)])


def ledger(df: DataFrame, text_col: str = "text", failures: str = "failures") -> DataFrame:
    """df with its measurements and `failures` (replacing columns of those names): bit i is set where rule i failed.

    What `measured` says of nulls, empty and long texts and repeated rows holds here.
    """
    rows = measured(df, text_col)
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(rule.failed(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return rows.select(*named(others(rows, (failures,))), bits.alias(failures))


def mask(rules: tuple[str, ...]) -> int:
    """The bits of the named rules."""
    return sum(1 << BIT[name] for name in set(rules))


def passes(policy: str, failures: str = "failures", policies: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Whether a ledger row failed none of the policy's rules."""
    return F.col(failures).bitwiseAND(F.lit(mask((policies or POLICIES)[policy]))) == 0


def ablations(rows: DataFrame, failures: str = "failures", policies: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(policy, rule, n_rows, n_failed, n_kept, n_kept_without): what each rule of each policy decides.

    rows: a ledger. n_failed: rows that fail the rule; n_kept: rows that the policy keeps; n_kept_without: rows that it
    would keep without this rule. The ledger is grouped by its bits first (partial sums before the shuffle), so nothing
    but those sums grows with the number of rows. An empty ledger gives zeros.
    """
    n, bits = F.col("n"), F.col("bits")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("long")

    def row(policy: str, rule: str, every: int, one: int) -> Column:
        return F.struct(
            F.lit(policy).alias("policy"), F.lit(rule).alias("rule"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("n_rows"), total(bits.bitwiseAND(F.lit(one)) != 0).alias("n_failed"),
            total(bits.bitwiseAND(F.lit(every)) == 0).alias("n_kept"), total(bits.bitwiseAND(F.lit(every & ~one)) == 0).alias("n_kept_without"),
        )

    tests = [row(p, r, mask(rules), 1 << BIT[r]) for p, rules in (policies or POLICIES).items() for r in rules]
    grouped = rows.groupBy(F.col(failures).alias("bits")).agg(F.count("*").alias("n"))
    return grouped.agg(F.array(*tests).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def common_failures(rows: DataFrame, key: str, failures: str = "failures") -> DataFrame:
    """(key, failed_by_any, failed_by_all): the rules that some and that all rows of a key fail, by bitwise aggregates."""
    return rows.groupBy(F.col(quoted(key)).alias(key)).agg(F.bit_or(failures).alias("failed_by_any"), F.bit_and(failures).alias("failed_by_all"))
