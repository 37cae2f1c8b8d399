"""Municipality registry: codes to rows, spelling variants, candidate sites and their choice, wards, feeds, guards."""

from __future__ import annotations

import ast
import html
import re
import urllib.parse
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator
from itertools import product
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.kana import romanize, widen_katakana
from tidemark.functions.pages import text_of

# Kinds of municipality ---------------------------------------------------------------------------
KINDS = "市区町村"
KANA_SUFFIXES = ("シ", "ク", "チョウ", "マチ", "ムラ", "ソン")
DOMAIN_LABEL = {"市": "city", "区": "city", "町": "town", "村": "vill"}
DOMAIN_SUFFIX = {"町": ("machi", "cho"), "村": ("mura", "son"), "市": ("shi",)}


def bare_kana(kana: str) -> str:
    """Without the first suffix reading that it ends in and doesn't consist of."""
    return next((kana.removesuffix(s) for s in KANA_SUFFIXES if kana.endswith(s) and kana != s), kana)


def bare_name(name: str) -> str:
    return name[:-1] if len(name) > 1 and name[-1] in KINDS else name


def municipality_row(cells: list[str]) -> tuple[str, ...] | None:
    """(code, prefecture, municipality, type, their kana, their romanisation) of a code table's row; null for a prefecture's own row."""
    code, pref, name, pref_half, name_half = ([*cells] + [""] * 5)[:5]
    pref, name = (re.sub("[ァ-ヶー]+$", "", x) for x in (pref, name))
    if not (code and pref and name):
        return None
    pref_kana, kana = widen_katakana(pref_half), widen_katakana(name_half)
    pref_romaji = romanize(re.sub("(?:ケン|フ|ト)$", "", bare_kana(pref_kana))) or ""
    return code, pref, name, name[-1] if name[-1] in KINDS else "?", pref_kana, kana, pref_romaji, romanize(bare_kana(kana)) or ""


MUNICIPALITY = "code string, prefecture string, municipality string, type string, pref_kana string, muni_kana string, pref_romaji string, muni_romaji string"


def municipalities(sheet: DataFrame) -> DataFrame:
    """The registry from a code table's cells (`tables.workbook`), its header row left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in MUNICIPALITY.split(", ")]
        for frame in frames:
            yield pd.DataFrame([r for c in frame["cells"] if (r := municipality_row(list(c)))], columns=names)

    return sheet.filter("ordinal > 0").select("cells").mapInPandas(run, MUNICIPALITY)


def wards(sheet: DataFrame) -> DataFrame:
    """(code, prefecture, city, ward) of a city table: a row belongs to the first city above it whose name begins it.

    A ward offers what its name has up to each 市 to an equality join with the prefecture's cities, and takes the earliest above it.
    """
    cells = sheet.filter("ordinal > 0").select("ordinal", *[F.coalesce(F.try_element_at("cells", F.lit(i + 1)), F.lit("")).alias(n) for i, n in enumerate(("code", "pref", "name"))])
    rows = cells.select("ordinal", "code", *[F.regexp_replace(c, "[ァ-ヶー]+$", "").alias(c) for c in ("pref", "name")]).filter("code <> '' and name <> ''")
    city = rows.filter(F.col("name").endswith("市")).select(F.col("pref"), F.col("ordinal").alias("__o"), F.col("name").alias("city"))
    below = rows.filter(~F.col("name").endswith("市"))
    offers = below.withColumn("__i", F.explode(F.sequence(F.lit(1), F.length("name")))).withColumn("city", F.substring("name", F.lit(1), F.col("__i"))).filter(F.col("city").endswith("市"))
    hits = offers.join(city, ["pref", "city"]).filter(F.col("__o") < F.col("ordinal"))
    one = hits.groupBy("ordinal", "code", "pref", "name").agg(F.min_by("city", "__o").alias("city"))
    return one.select("code", F.col("pref").alias("prefecture"), "city", F.substring(F.col("name"), F.length("city") + 1, F.length("name")).alias("ward"))


def spellings(romaji: str) -> list[str]:
    """Spellings that the kana leave open, most literal first: contracted glides, n for m, single for double vowels."""
    forms = [romaji, re.sub("(sh|ch|j)y", r"\1", re.sub("i(?=y[auo])", "", romaji))]
    forms += [re.sub("m(?=[bmp])", "n", f) for f in dict.fromkeys(forms)]
    forms += [re.sub(r"([aiueo])\1", r"\1", f) for f in dict.fromkeys(forms)]
    return [f for f in dict.fromkeys(forms) if f]


def candidate_sites(romaji: str, kind: str, pref: str) -> list[str]:
    """Addresses that a municipality's site may have, likeliest first, all of https before http; to be verified, never assumed."""
    label = DOMAIN_LABEL.get(kind)
    if not romaji or not label:
        return []
    names = []
    for form in spellings(romaji):
        for name in (form, *(form + s for s in DOMAIN_SUFFIX.get(kind, ()))):
            names += [name, f"{pref}-{name}"] if pref else [name]
    hosts = []
    for name in names:
        ends = [f"{name}.lg.jp", f"{name}.{pref}.jp"] if pref else [f"{name}.lg.jp"]
        hosts += [f"{www}{label}.{end}" for www, end in product(("www.", ""), ends)]
        hosts += [f"{www}{label}.{name}.jp" for www in ("www.", "")] if pref else []
    return list(dict.fromkeys(f"{scheme}://{h}/" for scheme in ("https", "http") for h in hosts))


def names_place(text: Column, municipality: Column) -> Column:
    """Whether a fetched page's text names the municipality or its stem: a site counts only then."""
    stem = F.regexp_replace(municipality, f"[{KINDS}]$", "")
    plain = F.regexp_replace(text, "<[^>]+>", " ")
    return F.contains(plain, municipality) | ((stem != "") & F.contains(plain, stem))


def first_verified(candidates: DataFrame, key: list[str], url: str, rank: str, verified: Column) -> DataFrame:
    """(key, url, resolved): each key's verified candidate of least rank; blank and 'no' without one."""
    best = candidates.groupBy(*key).agg(F.min_by(F.when(verified, F.col(url)), F.when(verified, F.col(rank))).alias(url))
    return best.select(*key, F.coalesce(url, F.lit("")).alias(url), F.when(F.col(url).isNotNull(), "yes").otherwise("no").alias("resolved"))


def is_ward_label(label: str, city: str, ward: str) -> bool:
    """A link label that names just the ward: with its city before it, its office or site after it, or those in brackets."""
    label = label.removeprefix(city)
    head, *_ = re.split("[（(]", label, maxsplit=1)
    inner = [x.removeprefix(city) for x in re.findall("[（(]([^）)]*)[）)]", label)]
    return head in (ward, f"{ward}役所", f"{ward}ホームページ") and all(x in (ward, f"{ward}役所") for x in inner)


def scope_of(url: str) -> str:
    """The directory of a page, below which a crawl stays."""
    p = urllib.parse.urlsplit(url)
    return f"{p.scheme}://{p.netloc}{p.path[: p.path.rfind('/') + 1] or '/'}"


def is_feed(text: str) -> bool:
    """By the root element: an XML declaration alone says nothing, pages have it too."""
    head = text.lstrip()[:600]
    return not re.search(r"<\s*(!DOCTYPE\s+html|html)\b", head, re.I) and bool(re.search(r"<\s*(urlset|sitemapindex|rss|feed)\b", head, re.I))


def feed_links(text: str, base: str) -> list[str]:
    """Addresses in a feed or sitemap; none if it isn't well-formed."""
    try:
        elements: Iterable[ET.Element] = ET.fromstring(text.strip()).iter()
    except ET.ParseError:
        return []
    found = []
    for e in elements:
        tag, value = e.tag.rsplit("}", 1)[-1].lower(), (e.text or "").strip()
        if tag in ("loc", "link") and (value or e.get("href")):
            try:
                found.append(urllib.parse.urljoin(base, value or e.get("href", "")))
            except ValueError:
                continue
        elif tag == "guid" and value.startswith("http"):
            found.append(value)
    return found


def page_feeds(page: str, base: str) -> list[str]:
    """Feeds that a page announces, then links whose path or query looks like one; each once."""
    declared = re.findall(r'<link[^>]+type="application/(?:rss|atom)\+xml"[^>]*href="([^"]+)"', page, re.I)
    linked = [h for h in re.findall(r'<a\b[^>]*href="([^"#]+)"', page, re.I) if re.search("rss|atom|feed", urllib.parse.urlsplit(h).path + urllib.parse.urlsplit(h).query, re.I)]
    return list(dict.fromkeys(urllib.parse.urljoin(base, html.unescape(h)) for h in [*declared, *linked]))


def result_links(page: str, base: str, want: str, skip: str, most: int = 8) -> list[tuple[str, str]]:
    """(label, url) of a site search: same host, short labels that are wanted and not skipped, each address once."""
    host, found = urllib.parse.urlsplit(base).netloc, {}
    for href, inner in re.findall(r'<a\b[^>]*href="([^"#]+)[^"]*"[^>]*>(.*?)</a>', page, re.S | re.I):
        url, label = urllib.parse.urljoin(base, html.unescape(href)), text_of(inner)
        if urllib.parse.urlsplit(url).netloc == host and 0 < len(label) <= 60 and re.search(want, label) and not re.search(skip, label):
            found.setdefault(url, label)
    return [(label, url) for url, label in list(found.items())[:most]]


def leaks(folder: str | Path, forbidden: tuple[str, ...], allowed: frozenset[str]) -> list[tuple[str, int, str]]:
    """(file, line, text) of string literals, docstrings aside, that mention known answers outside the allowed files."""
    found = []
    for path in sorted(Path(folder).glob("*.py")):
        if path.name in allowed:
            continue
        tree = ast.parse(path.read_text(encoding="utf-8"))
        documented = (ast.Module, ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)
        docs = {id(n.body[0].value) for n in ast.walk(tree) if isinstance(n, documented) and n.body and isinstance(n.body[0], ast.Expr)}
        for n in ast.walk(tree):
            if isinstance(n, ast.Constant) and isinstance(n.value, str) and id(n) not in docs and any(w in n.value for w in forbidden):
                found.append((path.name, n.lineno, n.value))
    return found
