"""Classifiers over names, dates, links and designations, as Column expressions with rule packs as parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import rules as R


def classify_date(
    text: Column, recurring: str = R.RECURRING, recurring_date: str = R.RECURRING_DATE, year: str = R.SPECIFIC_YEAR, bare: str = R.BARE_DATE,
    notes: Sequence[str] = (R.NOTE_YEAR, R.NOTE_NO_DATE, R.NOTE_BARE, R.NOTE_OTHER),
) -> Column:
    """STRUCT(schedule, note): a recurring rule with a date is a schedule; all else is kept as a note, never guessed."""
    t = F.trim(text)
    said, vague, plain, other = (F.concat(F.lit(n), t) for n in notes)
    is_rule = t.rlike(recurring) & t.rlike(recurring_date) & ~t.rlike(year)
    note = F.when(t == "", "").when(t.rlike(year), said).when(t.rlike(recurring), F.when(t.rlike(recurring_date), "").otherwise(vague)).when(t.rlike(bare), plain).otherwise(other)
    return F.struct(F.when(is_rule & (t != ""), t).alias("schedule"), note.alias("note"))


def categories(name: Column, venue: Column, municipality: Column | None = None, pack: Sequence[tuple[str, str]] = R.CATEGORIES) -> Column:
    """ARRAY of the labels whose pattern the name or venue has, in pack order; the municipality's own name doesn't count."""
    blob = F.concat_ws(" ", F.coalesce(name, F.lit("")), F.coalesce(venue, F.lit("")))
    if municipality is not None:
        stem = F.when(municipality.rlike(R.MUNICIPAL_SUFFIX), F.regexp_replace(municipality, R.MUNICIPAL_SUFFIX, "")).otherwise(F.lit(""))
        blob = F.replace(F.replace(blob, municipality, F.lit("")), stem, F.lit(""))
    found = F.filter(F.array(*[F.when(blob.rlike(p), F.lit(label)) for label, p in pack]), lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("unclassified")))


def best_date(found: Column, hint: str = R.DATE_HINT, month: str = "月") -> Column:
    """Of an array of date expressions the first recurring one, else the first with a month, else the first, else ''."""
    return F.coalesce(
        F.try_element_at(F.filter(found, lambda x: x.rlike(hint)), F.lit(1)),
        F.try_element_at(F.filter(found, lambda x: F.contains(x, F.lit(month))), F.lit(1)),
        F.try_element_at(found, F.lit(1)), F.lit(""),
    )


def first_venue(text: Column, name: Column, pattern: str = R.VENUE) -> Column:
    """The first venue in the text that isn't part of the name; '' if there is none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.coalesce(F.try_element_at(F.filter(found, lambda v: ~F.contains(name, v)), F.lit(1)), F.lit(""))


def festival_reason(name: Column, municipality: Column, vocabulary: Column | None = None) -> Column:
    """Why a name counts as a candidate: festival_word, seasonal, market, regional_vocab; null if it doesn't.

    vocabulary: an array of regional terms of the row's prefecture (null or empty: none).
    """
    stem = F.when(municipality.rlike(R.MUNICIPAL_SUFFIX), F.regexp_replace(municipality, R.MUNICIPAL_SUFFIX, "")).otherwise(F.lit(""))
    probe = F.replace(F.replace(name, municipality, F.lit("")), stem, F.lit(""))
    refused = (
        ~F.length(name).between(2, 30) | name.rlike(R.EXCLUDED) | name.rlike(R.NOT_A_NAME) | name.rlike(R.NAV_LABEL) | name.rlike(R.ENUMERATED)
        | name.rlike(R.OFFICE_WORDS) | ~name.rlike(R.JAPANESE) | (F.trim(probe) == "")
    )
    out = F.when(refused, F.lit(None)).when(probe.rlike(R.FESTIVAL), "festival_word").when(probe.rlike(R.SEASONAL) & probe.rlike(R.SEASONAL_EVENT), "seasonal").when(probe.rlike(R.MARKET), "market")
    if vocabulary is not None:
        web = F.regexp_replace(probe, R.SITE_WORDS, "")
        out = out.when(F.exists(F.coalesce(vocabulary, F.array().cast("array<string>")), lambda t: F.contains(web, t)), "regional_vocab")
    return out


def level_of(designation: Column) -> Column:
    return (
        F.when(designation.rlike("国指定|重要無形民俗"), "国指定").when(designation.rlike("選択|記録"), "国選択").when(designation.rlike("(都|道|府|県)指定"), "都道府県指定")
        .when(designation.rlike("(市|区|町|村)指定"), "市区町村指定").when(designation.rlike("未指定"), "未指定").otherwise("不明")
    )


def link_priority(label: Column, path: Column, skip: str, festival: str = R.FESTIVAL, event: str = R.EVENT_LABEL, nav: str | None = None) -> Column:
    """Crawl order of a link, smaller first: 90 for what is skipped while other links are left, 0, 1, 3, else 5."""
    blob = F.concat_ws(" ", label, F.lower(path))
    out = F.when(blob.rlike(skip), 90).when(blob.rlike(festival), 0).when(blob.rlike(event), 1)
    return (out.when(blob.rlike(nav), 3) if nav else out).otherwise(5)


def cultural_rank(label: Column, path: Column, strong: str, listing: str, nav: str) -> Column:
    """Rank of a link for the cultural-property lens: -1 strong list, 0 strong, 4 navigation, null otherwise."""
    blob = F.concat_ws(" ", label, F.lower(path))
    return F.when(blob.rlike(strong) & blob.rlike(listing), -1).when(blob.rlike(strong), 0).when(blob.rlike(nav), 4)


def terms_of(name: Column, splitter: str, stopwords: Sequence[str] = R.STOPWORDS, least: int = 2) -> Column:
    """ARRAY of the vocabulary terms of a name: without readings, split, trimmed of brackets, what follows the last の."""
    bare = F.regexp_replace(name, r"(?U)[（(][ぁ-んァ-ヶー・\s]{2,24}[）)]", "")
    cut = r"[（(][^）)]*$"
    trim = r"(?U)^[（(【「『\s]+|[）)】」』\s]+$"

    def term(x: Column) -> Column:
        whole = F.regexp_replace(F.regexp_replace(x, cut, ""), trim, "")
        return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(whole, "^.{1,12}の(?=.)", ""), trim, ""), cut, ""))

    return F.filter(F.transform(F.split(bare, splitter), term), lambda t: (F.length(t) >= least) & ~t.isin(list(stopwords)))


def valid_reading(text: Column) -> Column:
    """The reading without spaces and punctuation if it is hiragana only, otherwise null."""
    bare = F.regexp_replace(text, r"(?U)[\s　・,，、。]", "")
    return F.when(bare.rlike("^[ぁ-ゖー]+$"), bare)


def parse_verdict(cells: Column) -> Column:
    """STRUCT(id, verdict, reason, alias_of, municipality, reading) by the content of the cells; null without an id.

    Answers come with cells missing or shifted, so every cell is told by its form: the first cell is the id, later
    ids are the alias, a verdict word, kana, a name that ends as a municipality does, and the first other cell.
    """
    cells = F.transform(cells, lambda c: F.trim(c))
    rest = F.filter(F.slice(cells, 2, 1_000), lambda c: c != "")
    first_verdict = F.array_position(F.transform(rest, lambda c: c.rlike(R.VERDICT_WORD)), True)
    others = F.filter(rest, lambda c, i: (i + 1) != first_verdict)

    def last(kind: Column) -> Column:
        return F.coalesce(F.try_element_at(kind, F.lit(-1)), F.lit(""))

    is_id, is_kana, is_place = (lambda c: c.rlike(R.VERDICT_ID)), (lambda c: c.rlike(R.VERDICT_READING)), (lambda c: c.rlike(R.VERDICT_PLACE))
    reasons = F.filter(others, lambda c: ~is_id(c) & ~is_kana(c) & ~is_place(c))
    parsed = F.struct(
        F.try_element_at(cells, F.lit(1)).alias("id"),
        F.when(first_verdict > 0, F.lower(F.try_element_at(rest, F.greatest(first_verdict, F.lit(1)).cast("int")))).otherwise("").alias("verdict"),
        F.coalesce(F.try_element_at(reasons, F.lit(1)), F.lit("")).alias("reason"),
        last(F.filter(others, is_id)).alias("alias_of"),
        last(F.filter(others, lambda c: ~is_id(c) & ~is_kana(c) & is_place(c))).alias("municipality"),
        last(F.filter(others, lambda c: ~is_id(c) & is_kana(c))).alias("reading"),
    )
    return F.when(F.coalesce(F.try_element_at(cells, F.lit(1)), F.lit("")).rlike(R.VERDICT_ID), parsed)
