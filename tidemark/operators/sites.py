"""Finding sites of municipalities and their tourist boards in stored pages and by naming rules; nothing is assumed."""

from __future__ import annotations

import html
import re
import urllib.parse
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.operators import resolve
from tidemark.operators.registry import candidate_sites, first_verified, names_place, spellings

# What links to tourist boards look like ----------------------------------------------------------
TOURISM_LABEL = "観光協会|観光物産|観光コンベンション|観光局|観光振興|観光情報|観光サイト"
TOURISM_HOST = r"(?i)kanko|kankou|tourism|-tpa\.|tpa\.|kankokyokai"
NOT_A_SITE = r"(?i)(^|\.)(facebook|instagram|twitter|x|youtube|youtu\.be|tiktok|line|google|goo\.gl|maps\.google|pinterest|note|ameblo|jimdo|wixsite)\."
TOURISM_SECTION = "観光|見どころ|楽しむ|遊ぶ|魅力|イベント"
LINK_SECTION = "市町村|市区町村|市町|各市|リンク|一覧|ホームページ"
TOURISM_STEMS = ("{m}-kankou", "{m}-kanko", "{m}kanko", "{m}kankou", "kanko-{m}", "kankou-{m}")
TOURISM_ENDS = ("jp", "or.jp", "com", "org", "net", "gr.jp")


def outward_links(page: str, own_host: str) -> list[tuple[str, str]]:
    """(label with alt and title texts, address) of links to other hosts, social media left out."""
    found = []
    for href, inner in re.findall(r'<a[^>]+href="(https?://[^"]+)"[^>]*>(.*?)</a>', page, re.S):
        host = urllib.parse.urlsplit(href).netloc
        if host and host != own_host and not re.search(NOT_A_SITE, host):
            words = [html.unescape(re.sub(r"<[^>]+>", "", inner)).strip(), *map(html.unescape, re.findall(r'(?:alt|title)="([^"]*)"', inner))]
            found.append((" ".join(words).strip(), href))
    return found


def _root(url: str) -> str:
    parts = urllib.parse.urlsplit(url)
    return f"{parts.scheme}://{parts.netloc}/"


def tourism_site(page: str, own_host: str, romaji: str = "") -> str:
    """The tourist board that a page links to: by label at once, else by the first telling host; '' without one."""
    links = [(label, url, urllib.parse.urlsplit(url).netloc) for label, url in outward_links(page, own_host)]
    links = [x for x in links if not x[2].endswith(".lg.jp")]
    named = [url for label, url, _ in links if re.search(TOURISM_LABEL, label)]
    hosted = [url for label, url, host in links if re.search(TOURISM_HOST, host) and ((romaji and romaji in host.lower()) or "観光" in label)]
    return next((_root(url) for url in [*named, *hosted]), "")


def section_pages(page: str, base: str, section: str, most: int) -> list[str]:
    """Addresses on the page's own host whose label belongs to a section, each once, the first `most`."""
    host, found = urllib.parse.urlsplit(base).netloc, {}
    for href, inner in re.findall(r'<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>', page, re.S):
        label = html.unescape(re.sub(r"<[^>]+>", "", inner)).strip()
        if len(found) >= most or not re.search(section, label):
            continue
        try:
            url = urllib.parse.urldefrag(urllib.parse.urljoin(base, html.unescape(href)))[0]
        except ValueError:
            continue
        if urllib.parse.urlsplit(url).netloc == host:
            found.setdefault(url, label)
    return list(found)


def find_tourism(pages: dict[str, str], url: str, romaji: str = "", most: int = 3) -> str:
    """From a site's first page, else from up to three of its sections about visiting. pages: stored text by address."""
    host = urllib.parse.urlsplit(url).netloc
    first = pages.get(url, "")
    tries = [first, *(pages[p] for p in section_pages(first, url, TOURISM_SECTION, most) if p in pages)]
    return next((found for page in tries if (found := tourism_site(page, host, romaji))), "")


def tourism_candidates(romaji: str) -> list[str]:
    """Addresses by naming custom, likeliest first; to be looked up and verified."""
    hosts: Iterable[str] = (f"{www}{stem.format(m=m)}.{end}" for m in spellings(romaji) for stem in TOURISM_STEMS for end in TOURISM_ENDS for www in ("www.", ""))
    return [f"{scheme}://{h}/" for h in dict.fromkeys(hosts) for scheme in ("https", "http")] if romaji else []


def names_tourism(text: Column, municipality: Column) -> Column:
    """Whether a page is about visiting the municipality: its whole name (not as part of a market's) and 観光."""
    plain = F.regexp_replace(text, "<[^>]+>", " ")
    markets = F.replace(plain, F.concat(municipality, F.lit("場")), F.lit(" "))
    return F.contains(markets, municipality) & F.contains(plain, F.lit("観光"))


def link_index(pages: dict[str, str], url: str, most: int = 6) -> list[tuple[str, str]]:
    """(label, address) of a prefecture's outward links: on its first page and on up to six of its link lists."""
    host, first = urllib.parse.urlsplit(url).netloc, pages.get(url, "")
    lists = [p for p in section_pages(first, url, LINK_SECTION, most + 1) if p != url][:most]
    return [link for page in [first, *(pages[p] for p in lists if p in pages)] for link in outward_links(page, host)]


def linked_candidates(municipalities: DataFrame, links: DataFrame) -> DataFrame:
    """(municipality, url, rank): links (prefecture, rank, label, url) whose label has the municipality's name, or its stem of two characters or more.

    A stem lies in its name, so it alone decides where it is long enough. Labels and names meet by their rarest n-grams.
    """
    stem = F.regexp_replace("municipality", R.MUNICIPAL_SUFFIX, "")
    forms = municipalities.select("prefecture", "municipality", F.when(F.length(stem) >= 2, stem).otherwise(F.col("municipality")).alias("form"))
    named = resolve.containing(links, ["prefecture", "rank", "url"], "label", forms, "form", ["prefecture"])
    root = F.concat(F.try_parse_url("url", F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url("url", F.lit("AUTHORITY")), F.lit("/"))
    return named.select("prefecture", "municipality", root.alias("url"), "rank")


def resolve_sites(municipalities: DataFrame, links: DataFrame, stored: DataFrame) -> DataFrame:
    """(prefecture, municipality, url, resolved): the first candidate whose stored page names the municipality.

    Candidates by naming rule come first, links of the prefecture's lists after them. stored: (url, text).
    """

    @F.pandas_udf("array<string>")
    def guesses(romaji: pd.Series, kind: pd.Series, pref: pd.Series) -> pd.Series:
        return pd.Series([candidate_sites(r or "", k or "", p or "") for r, k, p in zip(romaji, kind, pref, strict=True)], dtype=object)

    by_rule = municipalities.select("prefecture", "municipality", F.posexplode(guesses("muni_romaji", "type", "pref_romaji")).alias("rank", "url"))
    by_link = linked_candidates(municipalities.select("prefecture", "municipality"), links).withColumn("rank", F.col("rank") + 1_000_000)
    tries = by_rule.select("prefecture", "municipality", "url", F.col("rank").cast("long").alias("rank")).unionByName(by_link.select("prefecture", "municipality", "url", F.col("rank").cast("long").alias("rank")))
    seen = tries.join(stored, "url", "left").withColumn("ok", F.coalesce(names_place(F.col("text"), F.col("municipality")), F.lit(False)))
    return first_verified(seen, ["prefecture", "municipality"], "url", "rank", F.col("ok"))


def names_ward(text: Column, city: Column, ward: Column) -> Column:
    """Whether a page names the ward behind its city, with up to two signs between them, or the ward's office."""
    plain = F.regexp_replace(text, "<[^>]+>", " ")
    both = F.concat(F.lit(r"(?U)\Q"), city, F.lit(r"\E[\s／/・:：|｜-]{0,2}\Q"), ward, F.lit(r"\E"))
    return F.rlike(plain, both) | F.contains(plain, F.concat(ward, F.lit("役所")))


# Where prefectures and their boards of education have their sites, and wards their lists -------------
PREFECTURE_HOSTS = ("www.pref.{}.jp", "www.pref.{}.lg.jp", "pref.{}.jp", "www.metro.{}.lg.jp")
EDUCATION_HOSTS = ("kyoiku.pref.{}.jp", "www.edu.pref.{}.jp", "www.pref.{}.ed.jp", "edu.pref.{}.jp", "www.kyoiku.metro.{}.lg.jp")
WARD_ENDS = ("役所", "ホームページ")
WARD_INDEX = "区役所|各区|区の(?:ホームページ|情報)|区のページ"


def resolve_prefectures(prefectures: DataFrame, stored: DataFrame) -> DataFrame:
    """(prefecture, official_url, education_url, resolved): of each kind the first address by naming rule whose stored page names the prefecture.

    prefectures: (prefecture, romaji); stored: (url, text). resolved tells of the official site.
    """

    def tries(kind: str, hosts: tuple[str, ...]) -> Column:
        urls = [F.concat(F.lit("https://" + h.split("{}")[0]), F.col("romaji"), F.lit(h.split("{}")[1] + "/")) for h in hosts]
        return F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("rank"), u.alias("url")) for i, u in enumerate(urls)])

    every = F.concat(tries("official", PREFECTURE_HOSTS), tries("education", EDUCATION_HOSTS))
    candidates = prefectures.filter(F.coalesce("romaji", F.lit("")) != "").select("prefecture", F.inline(every))
    seen = candidates.join(stored, "url", "left").withColumn("ok", F.coalesce(names_place(F.col("text"), F.col("prefecture")), F.lit(False)))
    best = first_verified(seen, ["prefecture", "kind"], "url", "rank", F.col("ok"))
    of = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("url"))), F.lit(""))
    found = best.groupBy("prefecture").agg(of("official").alias("official_url"), of("education").alias("education_url"))
    out = prefectures.select("prefecture").distinct().join(found, "prefecture", "left").fillna("", ["official_url", "education_url"])
    return out.withColumn("resolved", F.when(F.col("official_url") != "", "yes").otherwise("no"))


def scope(url: Column) -> Column:
    """The directory of a page as a column; see registry.scope_of."""
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    return F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("AUTHORITY")), F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "[^/]*$", "")).otherwise("/"))


def _depth(url: Column) -> Column:
    """Directories of a page's scope."""
    return F.length(F.regexp_replace(F.rtrim(F.try_parse_url(scope(url), F.lit("PATH")), F.lit("/")), "[^/]", ""))


def city_links(cities: DataFrame, links: DataFrame, index_label: str = WARD_INDEX, most: int = 3) -> DataFrame:
    """(prefecture, city, ord, label, url) of a city's first page, then of the first `most` pages that it links to by an index's label.

    cities: (prefecture, city, top); links: (page, ord, label, url) of stored pages.
    """
    first = cities.join(links, F.col("top") == F.col("page")).select("prefecture", "city", F.col("ord").cast("long").alias("ord"), "label", "url")
    rank = F.row_number().over(Window.partitionBy("prefecture", "city").orderBy("ord"))
    lists = first.filter(F.col("label").rlike(index_label)).withColumn("k", rank).filter(F.col("k") <= most).select("prefecture", "city", "k", F.col("url").alias("list"))
    second = lists.join(links, F.col("list") == F.col("page")).select("prefecture", "city", (F.col("k") * 1_000_000_000 + F.col("ord")).cast("long").alias("ord"), "label", "url")
    return first.unionByName(second)


def ward_candidates(wards: DataFrame, cities: DataFrame, links: DataFrame) -> DataFrame:
    """(code, url, rank): a ward's links by label on its city's host, those with its romanisation first, then the shallow ones; and two guesses.

    wards: (code, prefecture, city, ward, romaji); cities: (prefecture, city, top); links: city_links. Guesses come first
    only where the best link lies three directories deep. A label offers the ward names that it can stand for to an equality
    join, so a city's links never meet all of its wards.
    """
    place = ["prefecture", "city"]
    bare = lambda c: F.when(F.startswith(c, F.col("city")), F.substring(c, F.length("city") + 1, F.length(c))).otherwise(c)
    label = bare(F.col("label"))
    head = F.regexp_replace(label, "(?s)[（(].*$", "")
    names = F.array_distinct(F.array(head, *[F.regexp_replace(head, f"{end}$", "") for end in WARD_ENDS]))
    inner = F.transform(F.regexp_extract_all(label, F.lit("[（(]([^）)]*)[）)]"), F.lit(1)), bare)
    offers = links.join(cities, place).filter(F.try_parse_url("url", F.lit("AUTHORITY")) == F.try_parse_url("top", F.lit("AUTHORITY")))
    offers = offers.select(*place, "ord", "url", inner.alias("inner"), F.explode(names).alias("ward"))
    by_label = wards.join(offers, [*place, "ward"]).filter(F.forall("inner", lambda x: (x == F.col("ward")) | (x == F.concat("ward", F.lit("役所")))))
    known = (F.col("romaji") != "") & F.contains("url", F.col("romaji"))
    linked = by_label.select("code", "url", F.struct((~known).alias("a"), _depth(F.col("url")).alias("b"), F.col("ord").alias("c")).alias("order"))
    linked = linked.groupBy("code", "url").agg(F.min("order").alias("order"))
    best = linked.groupBy("code").agg(F.min_by(_depth(F.col("url")), "order").alias("best"))
    base = F.concat(F.try_parse_url("top", F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url("top", F.lit("AUTHORITY")), F.lit("/"), "romaji")
    guessed = wards.join(cities, place).filter((F.coalesce("top", F.lit("")) != "") & (F.coalesce("romaji", F.lit("")) != "")).select("code", F.posexplode(F.array(F.concat(base, F.lit("/")), F.concat(base, F.lit("ku/")))).alias("pos", "url"))
    guessed = guessed.join(best, "code", "left").select("code", "url", F.struct(F.when(F.col("best") >= 3, 0).otherwise(2).alias("group"), F.lit(False).alias("a"), F.lit(0).alias("b"), F.col("pos").cast("long").alias("c")).alias("rank"))
    ranked = linked.select("code", "url", F.struct(F.lit(1).alias("group"), "order.a", "order.b", "order.c").alias("rank"))
    return guessed.unionByName(ranked).groupBy("code", "url").agg(F.min("rank").alias("rank"))


def resolve_wards(wards: DataFrame, cities: DataFrame, links: DataFrame, stored: DataFrame) -> DataFrame:
    """(code, prefecture, city, ward, official_url, scope, resolved): each ward's first candidate whose stored page names it.

    A page whose scope is that of the city's first page is none: nothing would tell the ward from its city. Inputs as in
    ward_candidates; stored: (url, text).
    """
    tries = ward_candidates(wards, cities, links).join(wards.join(cities, ["prefecture", "city"], "left"), "code").join(stored, "url", "left")
    ok = F.coalesce(names_ward(F.col("text"), F.col("city"), F.col("ward")) & (scope(F.col("url")) != scope(F.col("top"))), F.lit(False))
    found = first_verified(tries.withColumn("ok", ok), ["code"], "url", "rank", F.col("ok"))
    out = wards.join(found, "code", "left").fillna({"url": "", "resolved": "no"})
    return out.select("code", "prefecture", "city", "ward", F.col("url").alias("official_url"), F.when(F.col("url") != "", scope(F.col("url"))).otherwise("").alias("scope"), "resolved")
