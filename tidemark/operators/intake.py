"""Rows that come from outside the crawl: stored bodies, a judge's designations, readings, seeds, target lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.functions.pages import ADDRESS_CELL, LIST_NAME, NO_NAME, designation_name
from tidemark.session import ship, staged

# What a judge's designation row may say ----------------------------------------------------------
LEVELS = ("国指定", "国登録", "県指定", "都指定", "道指定", "府指定", "市指定", "町指定", "村指定")
FOLK = "(?<!有形)(?:無形民俗文化財|民俗文化財|無形民俗|民俗芸能|風俗慣習|民俗行事)"
JUDGE_PROSE = r"https?|www\.|本文へ|お問い合わせ|問合せ|ダウンロード|ページの先頭|[。、！？]|(?:します|ました|しています|ください|されており|について)$"
NOTHING = "NONE"
SEED_VENUE = "(?:に|で)([^、。にで]{2,30}?(?:神社|神宮|八幡宮|寺|院|堂|境内|会館|公園|広場|公民館|集会所))で公開"
SEED_TITLE = "無形文化遺産総合データベース (東京文化財研究所)"


def fetch_stored(pages: DataFrame, bodies: DataFrame, url: str = "fetch_url") -> DataFrame:
    """pages with the stored body of their address (fragment dropped), and found: an offline fetch.

    bodies: (url, ...), one row an address. Addresses that nothing is stored under stay with nulls and found = false.
    """
    key = F.substring_index(F.col(url), "#", 1)
    stored = bodies.withColumnRenamed("url", "__url").withColumn("found", F.lit(True))
    return pages.join(stored, key == F.col("__url"), "left").drop("__url").withColumn("found", F.coalesce("found", F.lit(False)))


def hits_and_misses(fetched: DataFrame) -> DataFrame:
    """(found, n): how many pages have a stored body."""
    return fetched.groupBy("found").agg(F.count("*").alias("n"))


def judged_designations(answers: DataFrame, pages: DataFrame) -> DataFrame:
    """answers with the page's columns, the cleaned name and reject_reason (null: accepted).

    answers: (cells) of a judge's lines: page, level, kind, name. pages: (page_id, prefecture, municipality, url). The
    reasons, in the order of the tests: shape, unknown_id, none (the judge says that there is nothing), designation,
    kind, name.
    """
    ship(answers.sparkSession)
    cell = lambda i: F.trim(F.try_element_at("cells", F.lit(i)))
    rows = answers.select("*", *[cell(i + 1).alias(n) for i, n in enumerate(("page_id", "designation", "kind", "raw_name"))]).withColumn("name", designation_name(F.col("raw_name")))
    known = rows.join(pages.withColumn("__known", F.lit(True)), "page_id", "left")
    unfit = F.col("name").rlike(NO_NAME.pattern) | F.col("name").rlike(JUDGE_PROSE) | F.col("name").rlike(ADDRESS_CELL.pattern)
    reason = (
        F.when(F.size("cells") < 4, "shape").when(F.col("__known").isNull(), "unknown_id")
        .when((F.col("designation") == NOTHING) | (F.col("kind") == NOTHING) | (F.col("raw_name") == NOTHING), "none")
        .when(~F.col("designation").isin(*LEVELS), "designation").when(~F.col("kind").rlike(FOLK), "kind")
        .when(~F.length("name").between(2, LIST_NAME) | unfit, "name")
    )
    return known.withColumn("reject_reason", reason).drop("__known")


def reject_counts(judged: DataFrame) -> DataFrame:
    """(reject_reason, n); accepted rows stand under 'accepted'."""
    return judged.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reject_reason")).agg(F.count("*").alias("n"))


def unanswered(pages: DataFrame, judged: DataFrame) -> DataFrame:
    """Pages that no answer of the right shape names."""
    return pages.join(judged.filter(F.coalesce("reject_reason", F.lit("")) != "shape").select("page_id"), "page_id", "left_anti")


def new_designations(judged: DataFrame, existing: DataFrame, mechanical: DataFrame, ord_col: str) -> DataFrame:
    """Accepted rows that neither the judge's registry (prefecture, name, kind) nor the mechanical one (prefecture, name) has; the first of each."""
    key = ["prefecture", "name", "kind"]
    fresh = judged.filter("reject_reason is null").join(existing.select(*key).distinct(), key, "left_anti").join(mechanical.select(*key[:2]).distinct(), key[:2], "left_anti")
    rest = [c for c in ("municipality", "designation", "url") if c in judged.columns]
    one = fresh.groupBy(*key).agg(F.min_by(F.struct(*rest), ord_col).alias("__r"))
    return one.select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest])


def residue(
    pages: DataFrame, hosts: DataFrame, mechanical: DataFrame, telling: Column, digest: Column, ord_col: str = "ord", per_host: int = 8, limit: int = 120, least: int = 120, done: DataFrame | None = None, have: int = 0,
) -> DataFrame:
    """(page_id, host, prefecture, municipality, url, digest): pages for a judge, because the mechanical rules found nothing there.

    pages: (host, url, ord, ...); hosts: (host, prefecture, municipality). A page counts if `telling` holds, it has an
    address, its host is known, no row of `mechanical` (url) comes from it and its digest has `least` characters. Of pages
    with one page_id (of the address) the first by host and ord counts. Taken are at most per_host pages of a host, in their
    order, and at most limit - have over all, in the order of hosts: the last host may be cut short.

    done: (host) of hosts that an earlier run finished, which had found `have` pages; so a run that was cut off goes on.
    Ranks are counted within hosts. Every host that is taken gives a page, so the first limit - have hosts are enough
    for the sums over hosts before them: those are ordered without ordering the others.
    """
    left = max(0, limit - have)
    known = pages.filter(telling & (F.coalesce("url", F.lit("")) != "")).join(hosts.select("host", "prefecture", "municipality").dropDuplicates(["host"]), "host")
    if done is not None:
        known = known.join(done.select("host").distinct(), "host", "left_anti")
    open_pages = known.join(mechanical.select("url").distinct(), "url", "left_anti").withColumn("digest", digest).filter(F.length("digest") >= least)
    named = open_pages.withColumn("__id", F.substring(F.sha1("url"), 1, 8))
    kept = ["host", F.col(ord_col).alias("__ord"), "prefecture", "municipality", "url", "digest"]
    once = named.groupBy("__id").agg(F.min(F.struct(*kept)).alias("p")).select(F.col("__id").alias("page_id"), "p.*")
    rank = F.row_number().over(Window.partitionBy("host").orderBy("__ord", "page_id"))
    capped = staged(once.withColumn("__r", rank).filter(F.col("__r") <= per_host), "residue", left)
    first_hosts = capped.groupBy("host").agg(F.count("*").alias("__n")).orderBy("host").limit(left)
    # At most `limit` rows.
    before = first_hosts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("host").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    return capped.join(before, "host").filter(F.col("__before") + F.col("__r") <= left).select("page_id", "host", "prefecture", "municipality", "url", "digest")


def rows_without_reading(verdicts: DataFrame) -> DataFrame:
    """Kept rows (id, verdict, reading) whose reading is still to be asked for."""
    return verdicts.filter((F.trim("verdict") == "keep") & (F.trim(F.coalesce("reading", F.lit(""))) == ""))


def fill_readings(verdicts: DataFrame, readings: DataFrame, ord_col: str) -> DataFrame:
    """verdicts with the readings of kept rows that had none. readings: (id, raw); the last valid one of an id counts.

    A reading is valid if it is hiragana once spaces and punctuation are gone; others are left out.
    """
    bare = F.regexp_replace("raw", r"(?U)[\s　・「」『』（）()〜～!！?？、。]", "")
    good = readings.select("id", bare.alias("__r"), F.col(ord_col).alias("__o")).filter(F.col("__r").rlike("^[ぁ-ゖー]+$"))
    last = good.groupBy("id").agg(F.max_by("__r", "__o").alias("__r"))
    empty = (F.trim("verdict") == "keep") & (F.trim(F.coalesce("reading", F.lit(""))) == "")
    return verdicts.join(last, "id", "left").withColumn("reading", F.when(empty, F.coalesce("__r", F.lit(""))).otherwise(F.coalesce("reading", F.lit("")))).drop("__r")


def seed_rows(registry: DataFrame) -> DataFrame:
    """Candidate rows from a registry of designations: its kana stands in brackets behind the name, where readings are looked for."""
    kana = F.when(F.col("kana") != "", F.concat("name", F.lit("（"), "kana", F.lit("）"))).otherwise(F.col("name"))
    dated = F.when(F.col("date_note") != "", F.concat(F.lit(" "), "date_note")).otherwise("")
    return registry.select(
        "prefecture", "municipality", "name", F.col("name").alias("name_raw"), F.lit("tobunken").alias("origin"), F.concat(F.lit("tobunken:"), "level", F.lit(":"), "tobunken_id").alias("reason"),
        F.col("date_note").alias("date_text"), F.regexp_extract("date_note", SEED_VENUE, 1).alias("venue"), "source_url", F.lit(SEED_TITLE).alias("page_title"),
        F.substring(F.concat(kana, F.lit(" "), "designation", dated), 1, 300).alias("context"),
    )


def replace_seeds(candidates: DataFrame, seeds: DataFrame, prefecture: Column, origin: str = "tobunken") -> DataFrame:
    """candidates without the prefecture's earlier seeds, and with its new ones."""
    mine = (F.col("origin") == origin) & prefecture
    return candidates.filter(~F.coalesce(mine, F.lit(False))).unionByName(seeds.filter(prefecture), allowMissingColumns=True)


def site_targets(sites: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Municipalities (prefecture, municipality, official_url, tourism_url) with an address, less those that are done."""
    some = (F.coalesce("official_url", F.lit("")) != "") | (F.coalesce("tourism_url", F.lit("")) != "")
    out = sites.filter(some).select("prefecture", "municipality", F.lit("").alias("district"), "official_url", "tourism_url", F.lit("").alias("scope"))
    return _left(out, done)


def prefecture_targets(sites: DataFrame, done: DataFrame | None = None, wide: str = R.PREFECTURE_WIDE) -> DataFrame:
    """A prefecture's education board before its main site; both as seeds of one crawl over the whole prefecture."""
    board = F.coalesce("education_url", F.lit("")) != ""
    out = sites.filter(board | (F.coalesce("official_url", F.lit("")) != "")).select(
        "prefecture", F.lit(wide).alias("municipality"), F.lit("").alias("district"), F.when(board, F.col("education_url")).otherwise(F.col("official_url")).alias("official_url"),
        F.when(board, F.coalesce("official_url", F.lit(""))).otherwise("").alias("tourism_url"), F.lit("").alias("scope"),
    )
    return _left(out, done)


def ward_targets(sites: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Wards with a scope: crawled below it, as events of their city."""
    out = sites.filter(F.coalesce("scope", F.lit("")) != "").select("prefecture", "municipality", F.col("ward").alias("district"), "official_url", F.lit("").alias("tourism_url"), "scope")
    return _left(out, done)


def _left(targets: DataFrame, done: DataFrame | None) -> DataFrame:
    """Targets whose (prefecture, district or municipality) no written page has."""
    if done is None:
        return targets
    unit = F.when(F.coalesce("district", F.lit("")) != "", F.col("district")).otherwise(F.col("municipality"))
    have = done.select("prefecture", unit.alias("__unit")).distinct()
    return targets.withColumn("__unit", unit).join(have, ["prefecture", "__unit"], "left_anti").drop("__unit")


def longest_first(terms: Column) -> Column:
    """An array of terms by falling length, equal ones by the alphabet."""
    keyed = F.transform(terms, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))
    return F.transform(F.array_sort(keyed), lambda s: s["t"])


def listed_place(column: str, listed: list[str]) -> Column:
    """The column's place in a fixed list; what isn't listed comes last."""
    place = reduce(lambda c, item: c.when(F.col(column) == item[1], item[0]), enumerate(listed), F.when(F.lit(False), 0))
    return F.coalesce(place, F.lit(len(listed)))


def in_listed_order(df: DataFrame, column: str, listed: list[str], *then: str) -> DataFrame:
    """df sorted by the column's place in a fixed list, then by other columns."""
    return df.orderBy(listed_place(column, listed), *then)


def profile(df: DataFrame, column: str, most: int = 8) -> DataFrame:
    """(value, n): the column's most frequent values, equal counts by value."""
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counted.orderBy(F.col("n").desc(), "value").limit(most)
