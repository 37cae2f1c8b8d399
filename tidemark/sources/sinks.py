"""Writers: scrubbed TSV, partition-scoped overwrite, gated JSON, numbered batches, reports and pages."""

from __future__ import annotations

import html
import os
import re
import urllib.parse
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import publish
from tidemark.session import delete, scratch


def scrubbed(df: DataFrame, line_ends: bool = True) -> DataFrame:
    """Every column as a string without tabs (and line ends); arrays joined by |; nulls empty."""
    pattern = r"[\t\r\n]+" if line_ends else r"\t"
    out = []
    for name, kind in df.dtypes:
        c = F.array_join(name, "|") if kind.startswith("array") else F.col(name).cast("string")
        out.append(F.coalesce(F.regexp_replace(c, pattern, " "), F.lit("")).alias(name))
    return df.select(*out)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw TSV with a header; Spark's committer makes the folder whole or leaves the old one out of sight."""
    scrubbed(df).write.mode(mode).option("sep", "\t").option("header", True).option("quote", "\u0000").option("emptyValue", "").option("lineSep", "\n").csv(path)


def write_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replaces only the partitions that df has rows for; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


class ConflictError(RuntimeError):
    """Another writer has replaced the table since this one read it; nothing was changed."""


#: Versions of a table that stay when a newer one is committed.
KEPT_VERSIONS = 3


def _versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Number and entry of every committed version."""
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_log")
    store = log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(log):
        return {}
    names = [str(s.getPath().getName()) for s in store.listStatus(log)]
    return {int(n): n for n in names if n.isdigit()}


def _entry(spark: SparkSession, path: str, number: int) -> str:
    return spark.read.text(f"{path}/_log/{number:020d}").first()["value"]


def table_version(spark: SparkSession, path: str) -> int:
    """The number of the table's newest version; 0 before the first."""
    return max(_versions(spark, path), default=0)


def _claim(spark: SparkSession, path: str, number: int, folder: str) -> bool:
    """Makes the log's entry of a version if nobody has: one exclusive create, which only one of several writers gets."""
    name = f"{path}/_log/{number:020d}"
    where = spark._jvm.org.apache.hadoop.fs.Path(name)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(where.getParent())
    scheme, _, local = str(store.makeQualified(where).toString()).partition(":")
    if scheme == "file":  # Hadoop's local file system looks first and creates then
        try:
            with open(os.open("/" + local.lstrip("/"), os.O_CREAT | os.O_EXCL | os.O_WRONLY), "w") as f:
                f.write(folder)
            return True
        except FileExistsError:
            return False
    try:
        out = store.create(where, False)
    except Exception as e:  # noqa: BLE001 - the JVM's exception tells by its text only
        if "AlreadyExists" in str(e) or store.exists(where):
            return False
        raise
    out.write(bytearray(folder.encode()))
    out.close()
    return True


def replace_table(df: DataFrame, path: str, base: int | None = None, keep: int = KEPT_VERSIONS) -> int:
    """Writes df as the table's next version and commits it if `base` is still the newest; gives the new number.

    base: the version that df was made from (without it the newest at this call). The data is written beside the other
    versions first; the commit is the exclusive creation of the log's entry base + 1, a compare-and-set: of two writers
    from one version one gets it, the other's files are deleted and ConflictError is raised. A write that fails is deleted
    too. Readers follow the log, so they see one whole version or another.

    After a commit the newest `keep` versions stay and older ones expire: entry first, then data. A reader of a version
    that expires meanwhile fails and has to read again.
    """
    spark = df.sparkSession
    base = table_version(spark, path) if base is None else base
    folder = f"v-{base + 1}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(f"{path}/{folder}")
        if table_version(spark, path) != base or not _claim(spark, path, base + 1, folder):
            raise ConflictError(f"version {base} is not the newest any more")
    except BaseException:
        delete(spark, f"{path}/{folder}")
        raise
    for number in sorted(_versions(spark, path))[:-keep]:
        old = _entry(spark, path, number)
        delete(spark, f"{path}/_log/{number:020d}")
        delete(spark, f"{path}/{old}")
    return base + 1


def read_current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table's newest version, or one that has not expired."""
    number = table_version(spark, path) if version is None else version
    return spark.read.parquet(f"{path}/{_entry(spark, path, number)}")


def pending(units: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Units that an earlier, interrupted run has not written."""
    return units.join(done.select(*keys).distinct(), keys, "left_anti")


def publish_json(df: DataFrame, path: str, id_col: str, required: list[str], non_empty: list[str], dry_run: bool = False) -> None:
    """Writes JSON lines if every rule holds (publish.checked) and dry_run is off. df is computed once, whatever comes of it."""
    with scratch(df.sparkSession, "-"):
        rows = publish.checked(df, id_col, required, non_empty)
        if not dry_run:
            rows.write.mode("overwrite").json(path)


def write_batches(df: DataFrame, path: str, batch: str = "batch_no") -> None:
    scrubbed(df).withColumn(batch, F.col(batch).cast("int")).write.mode("overwrite").partitionBy(batch).option("sep", "\t").option("header", True).csv(path)


def search_link(prefecture: str, municipality: str, name: str, base: str = "https://www.google.com/search?q=") -> str:
    """A search for the record, its reading in brackets left out."""
    return base + urllib.parse.quote_plus(" ".join((prefecture, municipality, re.sub(r"[（(][ぁ-ゖー\s]+[）)]", "", name).strip())))


def search_address(prefecture: Column, municipality: Column, name: Column, base: str = "https://www.google.com/search?q=") -> Column:
    """search_link as a column."""
    return F.concat(F.lit(base), F.url_encode(F.concat_ws(" ", prefecture, municipality, F.trim(F.regexp_replace(name, r"(?U)[（(][ぁ-ゖー\s]+[）)]", "")))))


def index_rows(records: DataFrame, urls: str = "source_urls") -> DataFrame:
    """What the index page shows, in its order: each record's first address and how many more, with the counts of its headings."""
    listed = records.select("prefecture", "municipality", "name", F.coalesce(F.try_element_at(urls, F.lit(1)), F.lit("")).alias("url"), F.greatest(F.size(urls) - 1, F.lit(0)).cast("long").alias("others"))
    counts = publish.nested_counts(listed, ["prefecture", "municipality"])
    of_prefecture = counts.filter("depth = 1").select("prefecture", F.col("n").alias("n_prefecture"))
    of_municipality = counts.filter("depth = 2").select("prefecture", "municipality", F.col("n").alias("n_municipality"))
    joined = listed.join(F.broadcast(of_prefecture), "prefecture").join(of_municipality, ["prefecture", "municipality"])
    return joined.orderBy("prefecture", "municipality", "name")


def render_index(rows: list[dict], title: str) -> str:
    """The page of records by prefecture and municipality, from index_rows in their order."""
    label = html.escape(title)
    parts, last = [f"<!doctype html><meta charset='utf-8'><title>{label}</title><h1>{label} ({len(rows)})</h1>"], (None, None)
    for r in rows:
        here = r["prefecture"], r["municipality"]
        if here[0] != last[0]:
            parts.append(f"<h2>{html.escape(here[0])} ({r['n_prefecture']})</h2>")
        if here != last:
            parts.append(f"<h3>{html.escape(here[1])} ({r['n_municipality']})</h3>")
        more = f" +{r['others']}" if r.get("others") else ""
        link = r.get("url") or search_link(*here, r["name"])
        parts.append(f"<p><a href='{html.escape(link)}'>{html.escape(r['name'])}</a>{more}</p>")
        last = here
    return "\n".join(parts)


def access_report(totals: dict[str, int], hosts: list[dict], days: list[dict], kinds: tuple[str, ...]) -> str:
    """The ledger's report in Markdown: totals, a row for each day, a row for each host; tables come counted and sorted."""

    def table(head: list[str], rows: list[list]) -> str:
        return "\n".join("| " + " | ".join(map(str, r)) + " |" for r in [head, ["---"] * len(head), *rows])

    by_day = table(["day", *kinds], [[r["day"] or "", *(r.get(k) or 0 for k in kinds)] for r in days])
    by_host = table(["host", "first", "last", *kinds, "bytes"], [[r["host"], r["first"], r["last"], *(r.get(k) or 0 for k in kinds), r["bytes"]] for r in hosts])
    lines = [f"- {k}: {v:,}" for k, v in totals.items()]
    return "\n\n".join(["# Access log", "\n".join(lines), "## By day", by_day, "## By host", by_host]) + "\n"


def _inline(text: str) -> str:
    text = html.escape(text, quote=False)
    text = re.sub(r"`([^`]+)`", r"<code>\1</code>", text)
    text = re.sub(r"\*\*([^*]+)\*\*", r"<strong>\1</strong>", text)
    return re.sub(r"\[([^\]]+)\]\(([^)\s]+)\)", r'<a href="\2">\1</a>', text)


def markdown(source: str) -> str:
    """Headings to level four, lists, tables and paragraphs with code, bold and links."""
    out, listing, rows = [], False, []

    def close() -> None:
        nonlocal listing, rows
        if listing:
            out.append("</ul>")
        if rows:
            body = "".join("<tr>" + "".join(f"<{'th' if i == 0 else 'td'}>{_inline(c)}</{'th' if i == 0 else 'td'}>" for c in r) + "</tr>" for i, r in enumerate(rows))
            out.append(f"<table>{body}</table>")
        listing, rows = False, []

    for line in source.splitlines():
        if m := re.match(r"(#{1,4})\s+(.*)", line):
            close()
            out.append(f"<h{len(m[1])}>{_inline(m[2])}</h{len(m[1])}>")
        elif m := re.match(r"\s*[-*]\s+(.*)", line):
            if not listing:
                close()
                out.append("<ul>")
                listing = True
            out.append(f"<li>{_inline(m[1])}</li>")
        elif line.startswith("|"):
            if listing:
                close()
            cells = [c.strip() for c in line.strip().strip("|").split("|")]
            if not all(re.fullmatch(":?-+:?", c) for c in cells):
                rows.append(cells)
        else:
            close()
            if line.strip():
                out.append(f"<p>{_inline(line.strip())}</p>")
    close()
    return "\n".join(out)
