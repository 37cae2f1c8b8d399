"""Name keys as Columns. Five keys exist for five equalities; they are kept apart on purpose.

dedup_key seeds published ids and must never change; merge_key and strong_key only join records, norm_key only
compares with known names.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions import rules as R

KATAKANA = "".join(map(chr, range(0x30A1, 0x30F7)))
HIRAGANA = "".join(map(chr, range(0x3041, 0x3097)))


def hiragana(c: Column) -> Column:
    """Katakana to hiragana; the long-vowel mark stays."""
    return F.translate(c, KATAKANA, HIRAGANA)


def is_kana(c: Column) -> Column:
    """Whether a text is kana throughout (long-vowel and repetition marks, middle dots and spaces included)."""
    return c.rlike(r"(?U)^[ぁ-ゖァ-ヺーゝゞ・　\s]+$")


def squeeze_space(c: Column) -> Column:
    """Runs of white space (ideographic too) to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s　]+", " "))


def dedup_key(c: Column) -> Column:
    """The record key: without readings in brackets, leading dates, rounds, years and punctuation; kana unified."""
    for pattern in (R.KEY_READING, R.KEY_LEAD_DATE, R.KEY_ROUND, R.KEY_YEAR, R.KEY_DROP):
        c = F.regexp_replace(c, pattern, "")
    c = hiragana(c)
    for long, short in R.KEY_SAME:
        c = F.replace(c, F.lit(long), F.lit(short))
    return c


def merge_key(name: Column, municipality: Column) -> Column:
    """The key within a municipality: also without leading marks and years, wrappers and the municipality's stem."""
    s = F.regexp_replace(name, R.MERGE_LEAD, "")
    inside = F.regexp_extract(F.trim(s), R.MERGE_WRAP, 1)
    s = F.regexp_replace(F.when(inside != "", inside).otherwise(s), R.MERGE_YEAR, "")
    key = dedup_key(s)
    stem = F.regexp_replace(municipality, R.MUNICIPAL_SUFFIX, "")
    stem_key = dedup_key(stem)
    drop = (F.length(stem) >= 2) & (stem_key != "") & F.startswith(key, stem_key) & (F.length(key) > F.length(stem_key) + 1)
    return F.when(drop, F.substring(key, F.length(stem_key) + 1, F.length(key))).otherwise(key)


def strong_key(name: Column) -> Column:
    """The key of the published deduplication: without designations and society suffixes, and without の."""
    return F.replace(dedup_key(F.regexp_replace(name, R.STRONG_DECOR, "")), F.lit("の"), F.lit(""))


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode compatibility composition; Spark has no built-in for it."""
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def norm_key(name: Column) -> Column:
    """The comparison key against known names."""
    s = F.regexp_replace(F.regexp_replace(nfkc(name), R.NOVELTY_LEAD, ""), R.NOVELTY_DROP, "")
    return F.lower(F.regexp_replace(s, R.NOVELTY_TAIL, "祭"))


def filter_key(s: Column) -> Column:
    """The key of the published page's search box."""
    return F.regexp_replace(F.lower(nfkc(s)), r"(?U)\s+", "")


def slug(romaji: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(romaji), "[^a-z0-9]+", "-"), F.lit("-"))


def hash_slug(pref: Column, muni: Column, key: Column) -> Column:
    """x and eight hexadecimal digits: the id part of a record whose reading is unknown."""
    return F.concat(F.lit("x"), F.substring(F.sha1(F.concat_ws("/", pref, muni, key).cast("binary")), 1, 8))


def stable_id(pref: Column, muni: Column, key: Column, romaji: Column) -> Column:
    """pref-muni-slug; PENDING while the place's romanisation is unknown."""
    tail = F.when(F.coalesce(romaji, F.lit("")) != "", slug(romaji)).otherwise(hash_slug(pref, muni, key))
    known = (F.coalesce(pref, F.lit("")) != "") & (F.coalesce(muni, F.lit("")) != "")
    return F.when(known, F.concat_ws("-", pref, muni, tail)).otherwise("PENDING")


def host(url: Column) -> Column:
    """Lower-cased authority with its port, as in the ledger; empty for what is no URL."""
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("AUTHORITY"))), F.lit(""))
