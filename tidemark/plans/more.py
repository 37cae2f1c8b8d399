"""Sources, sinks, joins and write-side operators bound to the driver's tables, and their DuckDB SQL side by side."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import keys as K
from tidemark.functions import pages as H
from tidemark.functions import predicates as P
from tidemark.functions import rules as R
from tidemark.operators import apply, coverage, crawl, intake, ledger, publish, records, registry, resolve, sites
from tidemark.plans.queries import EVENT_KINDS, ledger_events, table
from tidemark.sources import etiquette, pagestore, sinks, tables
from tidemark.session import ship, staging_path

ORACLES: dict[str, str] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LETTER = "CASE {0} WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' WHEN 2 THEN 'gamma' WHEN 3 THEN 'delta' ELSE 'epsilon' END"


def oracle(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


@oracle("SELECT c_custkey::VARCHAR AS k, c_name || chr(9) || '\"' || c_mktsegment AS v FROM customer")
def quoted_tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "quoted-tsv")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.concat("c_name", F.lit('\t"'), "c_mktsegment").alias("v"))
    rows.write.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return tables.quoted_tsv(spark, path, tables.strings("k", "v"))


@oracle("SELECT c_custkey::VARCHAR AS k, '\"' || c_name AS v, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || '|' || c_name ELSE '' END AS l FROM customer")
def raw_tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "raw-tsv")
    many = F.when(F.col("c_custkey") % 2 == 0, F.array("c_mktsegment", "c_name"))
    sinks.write_tsv(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit('"'), "c_name").alias("v"), many.alias("l")), path)
    return tables.raw_tsv(spark, path, tables.strings("k", "v", "l"))


@oracle("SELECT lpad(o_orderkey::VARCHAR, 6, '0') AS id, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS n FROM orders WHERE o_orderkey % 4 <> 1")
def ragged_tsv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, k = staging_path(spark, "ragged"), F.col("o_orderkey")
    ident = F.lpad(k.cast("string"), 6, "0")
    line = F.when(k % 4 == 1, F.concat(F.lit("# "), ident)).when(k % 3 == 0, F.concat(F.lit("﻿"), ident)).otherwise(F.concat(ident, F.lit("\tkeep")))
    table(spark, sf_dir, "orders").select(F.explode(F.array(line, F.lit(" "))).alias("value")).write.text(path)
    rows = tables.ragged_tsv(spark, path)
    return rows.select(F.element_at("cells", 1).alias("id"), F.size("cells").alias("n"))


@oracle("SELECT n_name AS id, 'r' || n_regionkey::VARCHAR AS prefecture, n_nationkey::VARCHAR || '|x' AS aliases FROM nation")
def published_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "document")
    record = F.struct(F.col("n_name").alias("id"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("prefecture"), F.array(F.col("n_nationkey").cast("string"), F.lit("x")).alias("aliases"))
    whole = table(spark, sf_dir, "nation").agg(F.collect_list(record).alias("festivals")).select(F.to_json(F.struct(F.lit("1").alias("schema_version"), "festivals")).alias("value"))
    whole.coalesce(1).write.text(path)
    return tables.records(spark, path).select("id", "prefecture", F.array_join("aliases", "|").alias("aliases"))


def _workbook(names: pd.Series) -> list[bytes]:
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = []
    for name in names:
        book = io.BytesIO()
        with zipfile.ZipFile(book, "w") as z:
            z.writestr("xl/sharedStrings.xml", f"<sst {space}><si><t>{name}</t></si><si><t>コード</t></si></sst>")
            z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {space}><sheetData><row><c t="s"><v>1</v></c></row><row><c t="s"><v>0</v></c><c><v>7</v></c></row></sheetData></worksheet>')
        out.append(book.getvalue())
    return out


@oracle("SELECT s_name AS file, unnest([0, 1]) AS ordinal, unnest(['コード', s_name || '|7']) AS cells FROM supplier")
def workbook_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)

    @F.pandas_udf("binary")
    def book(names: pd.Series) -> pd.Series:
        return pd.Series(_workbook(names))

    files = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("path"), book("s_name").alias("content"))
    return tables.rows_of_bytes(files, tables.sheet_cells).select("file", "ordinal", F.array_join("cells", "|").alias("cells"))


@oracle("SELECT s_name AS file, unnest([0, 1]) AS ordinal, unnest(['名称|所在' || chr(10) || '地', '撞舞|' || s_name]) AS cells FROM supplier")
def cp932_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)

    @F.pandas_udf("binary")
    def encoded(text: pd.Series) -> pd.Series:
        return text.map(lambda t: t.encode("cp932"))

    text = F.concat(F.lit('名称,"所在\n地"\n撞舞,'), "s_name", F.lit("\n"))
    files = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("path"), encoded(text).alias("content"))
    return tables.rows_of_bytes(files, tables.cp932_cells).select("file", "ordinal", F.array_join("cells", "|").alias("cells"))


@oracle("SELECT s_nationkey::VARCHAR AS file, s_name AS name, s_suppkey::VARCHAR AS key, 5 AS width FROM supplier")
def html_list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    row = F.concat(F.lit('<tr data-id="m'), F.col("s_suppkey").cast("string"), F.lit('"><td>'), "s_name", F.lit("</td><td><b>"), F.col("s_suppkey").cast("string"), F.lit("</b></td></tr><tr><td>no</td></tr>"))
    files = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("path")).agg(F.encode(F.array_join(F.collect_list(row), ""), "UTF-8").alias("content"))
    rows = tables.rows_of_bytes(files, lambda b: tables.list_cells(b.decode("utf-8")))
    return rows.select("file", F.element_at("cells", 1).alias("name"), F.element_at("cells", 2).alias("key"), F.size("cells").alias("width"))


@oracle("SELECT 'http://h/detail/' || (s_suppkey % 50)::VARCHAR AS url, arg_max(s_name, s_suppkey) AS name, max(s_suppkey) AS total FROM supplier GROUP BY 1")
def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    link = F.concat(F.lit('<a href="/detail/'), (F.col("s_suppkey") % 50).cast("string"), F.lit('">'), "s_name", F.lit("</a><a href='/detail/0'> </a>"), F.col("s_suppkey").cast("string"), F.lit("件中"))
    pages = table(spark, sf_dir, "supplier").select("s_suppkey", link.alias("html"))
    return tables.search_hits(pages, "s_suppkey", "html", "http://h")


@oracle("SELECT page_id % 3 <> 0 AS found, count(*) AS n FROM pages GROUP BY 1")
def stored_page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    key = F.concat(F.lit("http://h/"), F.col("page_id").cast("string"))
    listed = p.select("page_id", F.concat(key, F.lit("#part")).alias("fetch_url"))
    return intake.hits_and_misses(intake.fetch_stored(listed, p.filter("page_id % 3 <> 0").select(key.alias("url"), "html")))


@oracle("SELECT strftime(ts, '%Y-%m-%d') AS ts, event_type AS kind, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'u' || user_id::VARCHAR END AS url, '' AS status FROM events")
def ledger_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "ledger")
    e = table(spark, sf_dir, "events")
    line = F.concat_ws("\t", F.date_format("ts", "yyyy-MM-dd"), "event_type", F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))))
    e.select(line.alias("value")).unionByName(spark.createDataFrame([("ts\tkind\turl",), ("",)], "value string")).write.text(path)
    return tables.ledger(spark, path).select("ts", "kind", "url", "status")


@oracle("SELECT s_suppkey, s_nationkey, CASE WHEN s_nationkey < 5 THEN 'new' ELSE s_name END AS s_name FROM supplier")
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "partitions")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    sinks.write_partitions(s, path, ["s_nationkey"])
    sinks.write_partitions(s.filter("s_nationkey < 5").withColumn("s_name", F.lit("new")), path, ["s_nationkey"])
    return spark.read.schema(s.schema).parquet(path).select("s_suppkey", "s_nationkey", "s_name")


def _store(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Pages in a store of their own, some as plain text, every second with a designation, some of those in code page 932; and their hosts."""
    pagestore.register(spark)
    root = staging_path(spark, "store")

    @F.pandas_udf("binary")
    def cp932(text: pd.Series) -> pd.Series:
        return text.map(lambda t: t.encode("cp932"))

    ident = F.col("page_id").cast("string")
    listed = F.concat(F.lit("<table><tr><td>県指定</td><td>無形民俗文化財</td><td>獅子舞第"), ident, F.lit("組</td></tr></table>"))
    html = F.concat(F.regexp_replace("html", r"[^\x00-\x7F]", ""), F.when(F.col("page_id") % 2 == 0, listed).otherwise(""))
    pages = table(spark, sf_dir, "pages").select(
        F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), F.concat("url", F.lit("?p="), ident).alias("url"), F.when(F.col("page_id") % 5 == 0, "text/plain").otherwise("text/html").alias("content_type"), F.lit(200).alias("status"),
        F.when(F.col("page_id") % 6 == 0, cp932(html)).otherwise(F.encode(html, "UTF-8")).alias("content"),
    )
    pages.write.format("stored_pages").mode("append").save(root)
    return root, pages.select("host").distinct()


@oracle("""WITH p AS (SELECT *, '<table><tr><td>県指定</td><td>無形民俗文化財</td><td>獅子舞第' || page_id || '組</td></tr></table>' AS t FROM pages)
SELECT split_part(url, '/', 3) AS host, url || '?p=' || page_id AS url,
  length(regexp_replace(html, '[^\\x00-\\x7F]', '', 'g')) + CASE WHEN page_id % 2 = 1 THEN 0 WHEN page_id % 6 = 0 THEN length(t) + length(regexp_replace(t, '[\\x00-\\x7F]', '', 'g')) ELSE strlen(t) END AS length
FROM p WHERE page_id % 5 <> 0 AND split_part(url, '/', 3) NOT LIKE 'm.%'""")
def stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, hosts = _store(spark, sf_dir)
    return pagestore.cached_pages(spark, root, hosts.filter(~F.startswith("host", F.lit("m."))), tasks=16).select("host", "url", "length")


@oracle("""SELECT split_part(url, '/', 3) AS host, url || '?p=' || page_id AS url, '県指定' AS designation, '無形民俗文化財' AS kind, '獅子舞第' || page_id || '組' AS name FROM pages WHERE page_id % 2 = 0 AND page_id % 5 <> 0""")
def designations_of_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every strategy that finds a page's designation finds the same one; the first counts."""
    rows = pagestore.stored_designations(spark, *_store(spark, sf_dir), tasks=16)
    return H.first_designations(rows, ["host", "url"], ["ord"]).select("host", "url", "designation", "kind", "name")


@oracle("""WITH s AS (SELECT *, 'n' || s_nationkey AS url FROM supplier), b AS (SELECT n_name, sha1('b/' || n_nationkey) || '.body' AS file FROM nation)
SELECT sha1('l/' || url) || '.body' AS file, 'html_list' AS kind, s_name || '|' || s_suppkey || '|||' AS cells FROM s
UNION ALL SELECT file, 'workbook', unnest(['コード', n_name || '|7']) FROM b UNION ALL SELECT sha1('c/' || s_suppkey) || '.body', 'cp932', unnest(['名称|所在' || chr(10) || '地', '撞舞|' || s_name]) FROM s""")
def cells_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks, lists and code page 932 tables as files of a store, each read back by its format."""
    pagestore.register(spark)
    root = staging_path(spark, "cells")

    @F.pandas_udf("binary")
    def book(names: pd.Series) -> pd.Series:
        return pd.Series(_workbook(names))

    @F.pandas_udf("binary")
    def cp932(text: pd.Series) -> pd.Series:
        return text.map(lambda t: t.encode("cp932"))

    s, text = table(spark, sf_dir, "supplier"), lambda c: F.col(c).cast("string")
    row = F.concat(F.lit('<tr data-id="m'), text("s_suppkey"), F.lit('"><td>'), "s_name", F.lit("</td><td><b>"), text("s_suppkey"), F.lit("</b></td></tr><tr><td>no</td></tr>"))
    lists = s.groupBy("s_nationkey").agg(F.encode(F.array_join(F.array_sort(F.collect_list(row)), ""), "UTF-8").alias("content")).select(F.lit("html_list").alias("host"), F.concat(F.lit("l/n"), text("s_nationkey")).alias("url"), "content")
    books = table(spark, sf_dir, "nation").select(F.lit("workbook").alias("host"), F.concat(F.lit("b/"), text("n_nationkey")).alias("url"), book("n_name").alias("content"))
    tables_ = s.select(F.lit("cp932").alias("host"), F.concat(F.lit("c/"), text("s_suppkey")).alias("url"), cp932(F.concat(F.lit('名称,"所在\n地"\n撞舞,'), "s_name", F.lit("\n"))).alias("content"))
    files = lists.unionByName(books).unionByName(tables_).withColumns({"content_type": F.lit("x"), "status": F.lit(200)})
    # Dealt out by their number: each is two files to write, however few bytes the table has that they come from.
    files = files.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "host", "url")
    files.write.format("stored_pages").mode("append").save(root)
    read = lambda kind: spark.read.format("cell_files").options(kind=kind, ending=".body").load(f"{root}/{kind}").select("file", F.lit(kind).alias("kind"), F.array_join("cells", "|").alias("cells"))
    return read("html_list").unionByName(read("workbook")).unionByName(read("cp932"))


@oracle("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def pending_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"))
    return sinks.pending(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), done, ["n_nationkey"])


@oracle("SELECT c_custkey, c_name FROM customer")
def gated_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with a rule broken is refused, one without is written and read back."""
    path = staging_path(spark, "published")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    try:
        sinks.publish_json(c.withColumn("c_name", F.lit("")), path, "c_custkey", ["c_name"], [])
    except publish.PublishError:
        sinks.publish_json(c, path, "c_custkey", ["c_name"], [])
    return spark.read.schema("c_custkey long, c_name string").json(path)


@oracle("SELECT c_custkey, c_name || '+' AS c_name FROM customer WHERE c_custkey % 2 = 0")
def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "versions")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    sinks.replace_table(c, path)
    sinks.replace_table(c.filter("c_custkey % 2 = 0").withColumn("c_name", F.concat("c_name", F.lit("+"))), path)
    return sinks.read_current(spark, path)


@oracle("SELECT batch_no, count(*) AS n FROM (SELECT (floor((row_number() OVER (ORDER BY c_custkey) - 1) / 120) + 1)::INT AS batch_no FROM customer) GROUP BY 1")
def batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "batches")
    sinks.write_batches(records.batches(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"], 120), path)
    return spark.read.option("sep", "\t").option("header", True).csv(path).groupBy("batch_no").agg(F.count("*").alias("n"))


@oracle("""SELECT c_mktsegment AS prefecture, c_nationkey::VARCHAR AS municipality, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'u' || c_custkey::VARCHAR END AS url,
  CASE WHEN c_custkey % 3 = 1 THEN 1 ELSE 0 END::BIGINT AS others, count(*) OVER (PARTITION BY c_mktsegment) AS n_prefecture, count(*) OVER (PARTITION BY c_mktsegment, c_nationkey) AS n_municipality FROM customer""")
def index_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    first = F.concat(F.lit("u"), k.cast("string"))
    urls = F.when(k % 3 == 0, F.array().cast("array<string>")).when(k % 3 == 1, F.array(first, F.lit("v"))).otherwise(F.array(first))
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("prefecture"), F.col("c_nationkey").cast("string").alias("municipality"), F.col("c_name").alias("name"), urls.alias("source_urls"))
    return sinks.index_rows(rows).select("prefecture", "municipality", "name", "url", "others", "n_prefecture", "n_municipality")


@oracle("""WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS k FROM events)
SELECT '| ' || day || ' | ' || count(*) FILTER (k = 'view')::VARCHAR || ' | ' || count(*) FILTER (k = 'click')::VARCHAR || ' |' AS line FROM e GROUP BY day
UNION ALL SELECT unnest(['# Access log', '- rows: ' || format('{:,}', (SELECT count(*) FROM events)), '## By day', '| day | view | click |', '| --- | --- | --- |', '## By host', '| host | first | last | view | click | bytes |', '| --- | --- | --- | --- | --- | --- |'])""")
def access_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's lines; its day table is one row a day."""
    days = [r.asDict() for r in ledger.by_day(ledger_events(spark, sf_dir), "day", "kind", EVENT_KINDS).orderBy("day").collect()]
    report = sinks.access_report({"rows": table(spark, sf_dir, "events").count()}, [], days, ("view", "click"))
    return spark.createDataFrame([(line,) for line in report.splitlines() if line], "line string")


@oracle("""WITH t AS (SELECT s_nationkey AS k, arg_min(s_name, s_suppkey) AS f, arg_max(s_name, s_suppkey) AS l FROM supplier WHERE s_suppkey % 7 <> 0 GROUP BY 1)
SELECT c_custkey, f AS first_seen, l AS last_seen FROM customer LEFT JOIN t ON k = c_nationkey""")
def first_and_last_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    s = table(spark, sf_dir, "supplier").filter("s_suppkey % 7 <> 0").select(F.col("s_nationkey").alias("k"), "s_name", "s_suppkey")
    first = resolve.lookup(c, s, ["k"], "s_suppkey").select("k", "c_custkey", F.col("s_name").alias("first_seen"))
    return resolve.lookup(first, s, ["k"], "s_suppkey", last=True).select("c_custkey", "first_seen", F.col("s_name").alias("last_seen"))


_PLACES = """src AS (
  SELECT p_brand AS pref, replace(p_name, ' ', '') AS k, CASE WHEN p_size % 5 = 0 THEN '(県全域)' ELSE 'm' || (p_size % 3)::VARCHAR END AS m, 0 AS s, p_partkey AS o FROM part WHERE p_partkey % 4 = 0
  UNION ALL SELECT p_brand, replace(p_name, ' ', ''), 'n' || (p_size % 2)::VARCHAR, 1, p_partkey FROM part WHERE p_partkey % 4 = 1
), desig AS (SELECT pref, k, arg_min(m, (s, o)) FILTER (m <> '(県全域)') AS m, bool_or(m = '(県全域)') AS spread FROM src GROUP BY 1, 2)"""


@oracle(f"""WITH {_PLACES} SELECT p_partkey, coalesce(d.m, CASE WHEN NOT coalesce(spread, false) THEN CASE WHEN contains(p_name || ' ' || p_type, 'anvil') THEN 'anvil市' WHEN contains(p_name || ' ' || p_type, 'old') THEN 'old町' END END) AS guess,
  CASE WHEN d.m IS NOT NULL THEN 'designation' WHEN NOT coalesce(spread, false) AND (contains(p_name || ' ' || p_type, 'anvil') OR contains(p_name || ' ' || p_type, 'old')) THEN 'name' END AS guess_by
FROM part LEFT JOIN desig d ON d.pref = p_brand AND d.k = replace(p_name, ' ', '')""")
def place_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    base = part.select(F.col("p_brand").alias("prefecture"), F.col("p_name").alias("name"), F.col("p_partkey").alias("ord"), "p_size")
    one = base.filter("ord % 4 = 0").withColumn("municipality", F.when(F.col("p_size") % 5 == 0, R.PREFECTURE_WIDE).otherwise(F.concat(F.lit("m"), (F.col("p_size") % 3).cast("string"))))
    two = base.filter("ord % 4 = 1").withColumn("municipality", F.concat(F.lit("n"), (F.col("p_size") % 2).cast("string")))
    listed = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(m).alias("municipality")) for i, m in ((1, "x市"), (2, "anvil市"), (3, "old町"))])
    municipalities = part.select(F.col("p_brand").alias("prefecture")).distinct().select("*", F.inline(listed))
    rows = part.select("p_partkey", F.col("p_brand").alias("prefecture"), F.col("p_name").alias("name"), F.col("p_type").alias("venue"))
    return apply.guessed_places(rows, apply.designated_places([one, two]), municipalities, texts=("name", "venue")).select("p_partkey", "guess", "guess_by")


@oracle("SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING' INTERSECT SELECT s_suppkey FROM supplier")
def id_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"))
    return publish.id_clashes(kept, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")), "id")


_ANSWERS = """a AS (SELECT o_orderkey AS k, o_custkey % 400 AS page, CASE o_orderkey % 7 WHEN 0 THEN 'NONE' WHEN 1 THEN '不明' ELSE '県指定' END AS d, CASE WHEN o_orderkey % 5 = 0 THEN '工芸技術' ELSE '無形民俗文化財' END AS kind,
  CASE WHEN o_orderkey % 11 = 0 THEN '本文へ' ELSE '綱火' || ['一','二','三','四'][o_orderkey % 4 + 1] END AS name FROM orders),
j AS (SELECT *, CASE WHEN k % 13 = 0 THEN 'shape' WHEN page % 10 = 9 THEN 'unknown_id' WHEN d = 'NONE' THEN 'none' WHEN d = '不明' THEN 'designation' WHEN kind = '工芸技術' THEN 'kind' WHEN name = '本文へ' THEN 'name' END AS reason FROM a)"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    page = (F.col("o_custkey") % 400).cast("string")
    level = F.when(k % 7 == 0, "NONE").when(k % 7 == 1, "不明").otherwise("県指定")
    name = F.when(k % 11 == 0, "本文へ").otherwise(F.concat(F.lit("※綱火"), F.element_at(F.array(*[F.lit(x) for x in "一二三四"]), (k % 4 + 1).cast("int"))))
    cells = F.slice(F.array(page, level, F.when(k % 5 == 0, "工芸技術").otherwise("無形民俗文化財"), name), 1, F.when(k % 13 == 0, 3).otherwise(4))
    numbers = spark.range(400).filter("id % 10 <> 9")
    pages = numbers.select(F.col("id").cast("string").alias("page_id"), (F.col("id") % 3).cast("string").alias("prefecture"), (F.col("id") % 20).cast("string").alias("municipality"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"))
    return intake.judged_designations(table(spark, sf_dir, "orders").select("o_orderkey", cells.alias("cells")), pages)


@oracle(f"WITH {_ANSWERS} SELECT coalesce(reason, 'accepted') AS reject_reason, count(*) AS n FROM j GROUP BY 1")
def judged_designation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.reject_counts(_judged(spark, sf_dir))


@oracle(f"""WITH {_ANSWERS}, f AS (SELECT (page % 3)::VARCHAR AS prefecture, name, kind, arg_min('u' || page::VARCHAR, k) AS url FROM j WHERE reason IS NULL GROUP BY 1, 2, 3)
SELECT * FROM f WHERE NOT (prefecture = '0' AND name = '綱火一') AND NOT (prefecture = '1' AND name = '綱火二')""")
def new_designations(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = spark.createDataFrame([("0", "綱火一", "無形民俗文化財"), ("2", "綱火四", "民俗芸能")], "prefecture string, name string, kind string")
    mechanical = spark.createDataFrame([("1", "綱火二")], "prefecture string, name string")
    return intake.new_designations(_judged(spark, sf_dir), existing, mechanical, "o_orderkey").select("prefecture", "name", "kind", "url")


@oracle("""SELECT p_brand AS prefecture, p_name AS name, 'page' AS origin, p_type AS context FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT p_brand, p_name, 'tobunken', p_type FROM part WHERE p_partkey % 3 = 0 AND p_brand <> 'Brand#1'
UNION ALL SELECT p_brand, p_name, 'tobunken', p_name || CASE WHEN p_size % 2 = 0 THEN '（かな）' ELSE '' END || ' 県指定' || CASE WHEN p_size % 3 = 0 THEN ' 毎年八坂神社で公開' ELSE '' END FROM part WHERE p_brand = 'Brand#1'""")
def seeded_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    old = part.select(F.col("p_brand").alias("prefecture"), F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 3 == 0, "tobunken").otherwise("page").alias("origin"), F.col("p_type").alias("context"))
    listed = part.select(
        F.col("p_brand").alias("prefecture"), F.lit("").alias("municipality"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 2 == 0, "かな").otherwise("").alias("kana"), F.lit("県指定").alias("designation"),
        F.when(F.col("p_size") % 3 == 0, "毎年八坂神社で公開").otherwise("").alias("date_note"), F.lit("県").alias("level"), F.col("p_partkey").cast("string").alias("tobunken_id"), F.lit("u").alias("source_url"),
    )
    return intake.replace_seeds(old, intake.seed_rows(listed), F.col("prefecture") == "Brand#1").select("prefecture", "name", "origin", "context")


@oracle("SELECT n_nationkey::VARCHAR || unnest(['a', 'b']) AS code, n_name AS prefecture, unnest(['大阪市', '堺市']) AS city, unnest(['北区', '北区']) AS ward FROM nation")
def ward_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey").cast("string")
    lines = F.array(*[F.struct(F.lit(i).alias("o"), F.concat(k, F.lit(c)).alias("code"), F.lit(n).alias("name")) for i, (c, n) in enumerate((("x", "大阪市"), ("a", "大阪市北区"), ("y", "堺市"), ("b", "堺市北区"), ("c", "神戸市北区")))])
    sheet = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.explode(lines).alias("l"))
    return registry.wards(sheet.select((F.col("n_nationkey") * 10 + F.col("l.o") + 1).alias("ordinal"), F.array("l.code", "n_name", "l.name").alias("cells")))


@oracle("""WITH v AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'drop' ELSE 'keep' END AS verdict, CASE WHEN o_orderkey % 5 = 0 THEN 'つなび' ELSE '' END AS reading FROM orders)
SELECT id, verdict, CASE WHEN verdict = 'keep' AND reading = '' THEN CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'おどり' WHEN 2 THEN 'まつり' ELSE '' END ELSE reading END AS reading FROM v JOIN orders ON o_orderkey = id""")
def filled_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    v = table(spark, sf_dir, "orders").select(k.alias("id"), F.when(k % 3 == 0, "drop").otherwise("keep").alias("verdict"), F.when(k % 5 == 0, "つなび").alias("reading"))
    said = F.when(k % 4 == 0, F.array(F.lit("漢字"), F.lit("abc"))).when(k % 4 == 1, F.array(F.lit("まい"), F.lit("お どり"))).when(k % 4 == 2, F.array(F.lit("ま・つり"), F.lit("祭"))).otherwise(F.array(F.lit("カナ")))
    readings = table(spark, sf_dir, "orders").select(k.alias("id"), F.posexplode(said).alias("ord", "raw"))
    return intake.fill_readings(v, readings, "ord").select("id", "verdict", "reading")


@oracle("""WITH g AS (SELECT p_brand AS s, p_name AS k FROM part WHERE p_size < 20), o AS (SELECT p_brand AS s, p_name AS k, p_size, p_partkey AS o FROM part WHERE p_type = 'PROMO' AND p_size > 10 AND p_brand <> 'Brand#1'),
per AS (SELECT s, count(*) FILTER ((s, k) IN (SELECT (s, k) FROM o)) AS hits, count(*) AS total FROM g GROUP BY s)
SELECT 'scope' AS part, s AS name, hits, total FROM per UNION ALL SELECT 'zero_hit', s, hits, total FROM per WHERE hits = 0 UNION ALL SELECT 'unreached', s, hits, total FROM per WHERE s NOT IN (SELECT s FROM o)
UNION ALL SELECT 'new', NULL, count(*), count(*) FROM o WHERE (s, k) NOT IN (SELECT (s, k) FROM g) UNION ALL SELECT 'no_url', NULL, count(*), count(*) FROM o WHERE p_size % 7 = 0 UNION ALL SELECT 'pending', NULL, count(*), count(*) FROM o WHERE p_size % 2 = 0""")
def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("s"), F.col("p_name").alias("k"), "p_size", "p_type", F.col("p_partkey").alias("ord"))
    out = part.filter("p_type = 'PROMO' and p_size > 10 and s <> 'Brand#1'").select(
        "s", "k", F.array().cast("array<string>").alias("aliases"), "ord", F.when(F.col("p_size") % 7 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("u"))).alias("urls"), F.when(F.col("p_size") % 2 == 0, "PENDING").otherwise("x").alias("slug")
    )
    return coverage.evaluation(coverage.match_gold(part.filter("p_size < 20").select("s", "k"), out, "s", "k", "aliases", "ord"), out, "s", "k", "urls", "slug")


@oracle("SELECT p_brand AS prefecture, p_name AS name, p_type AS kind, min(p_partkey) AS ord FROM part GROUP BY 1, 2, 3")
def first_designations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("prefecture"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("p_partkey").alias("ord"))
    return H.first_designations(rows, ["prefecture"], ["ord"]).select("prefecture", "name", "kind", "ord")


@oracle("SELECT source AS value, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, value LIMIT 8")
def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.profile(table(spark, sf_dir, "documents"), "source")


@oracle("""WITH p AS (SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS site, page_id, (page_id % 5)::INT AS pr FROM pages),
s AS (SELECT site, min(page_id) AS seed FROM p GROUP BY 1), r AS (SELECT p.site, page_id, row_number() OVER (PARTITION BY p.site ORDER BY pr, page_id) + 1 AS seq FROM p JOIN s USING (site) WHERE page_id <> seed)
SELECT site, 1 AS seq, 'http://' || site || '/' || seed::VARCHAR AS fetch_url, 'seed' AS kind, 0 AS depth FROM s UNION ALL SELECT site, seq, 'http://' || site || '/' || page_id::VARCHAR, 'index', 1 FROM r WHERE seq <= 40""")
def crawl_of_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every host's first page links to all its others: visits follow priority, then order, up to the budget."""
    ship(spark)
    p = table(spark, sf_dir, "pages").select(F.try_parse_url("url", F.lit("AUTHORITY")).alias("site"), "page_id")
    address = F.concat(F.lit("http://"), "site", F.lit("/"), F.col("page_id").cast("string"))
    first = p.groupBy("site").agg(F.min("page_id").alias("seed_id"))
    both = p.join(first, "site")
    pages = both.select("site", address.alias("url"), F.lit("").alias("final_url"), F.lit(False).alias("feed"), (F.col("page_id") == F.col("seed_id")).alias("seed"), F.lit("").alias("scope"))
    seed = F.concat(F.lit("http://"), "site", F.lit("/"), F.col("seed_id").cast("string"))
    edges = both.filter("page_id <> seed_id").select("site", seed.alias("url"), address.alias("to"), F.col("page_id").alias("ord"), (F.col("page_id") % 5).cast("int").alias("priority"), F.lit(None).cast("int").alias("rank"), F.lit(False).alias("feed_link"))
    return crawl.discover_sites(pages, edges, "site").select("site", F.col("seq").cast("long").alias("seq"), "fetch_url", "kind", "depth")


@oracle("""SELECT 'site' AS kind, s_nationkey::VARCHAR AS prefecture, s_name AS municipality, '' AS district, CASE WHEN s_suppkey % 2 = 0 THEN 'u' ELSE '' END AS official_url FROM supplier WHERE (s_suppkey % 2 = 0 OR s_suppkey % 3 = 0) AND s_suppkey % 5 <> 0
UNION ALL SELECT 'prefecture', s_nationkey::VARCHAR, '(県全域)', '', CASE WHEN s_suppkey % 3 = 0 THEN 'e' ELSE 'u' END FROM supplier WHERE s_suppkey % 2 = 0 OR s_suppkey % 3 = 0 UNION ALL SELECT 'ward', s_nationkey::VARCHAR, 'city', s_name, 'u' FROM supplier WHERE s_suppkey % 4 = 0""")
def crawl_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("prefecture"), F.col("s_name").alias("municipality"), k.alias("k"), F.when(k % 2 == 0, "u").otherwise("").alias("official_url"), F.when(k % 3 == 0, "t").otherwise("").alias("tourism_url"),
        F.when(k % 3 == 0, "e").otherwise("").alias("education_url"),
    )
    done = s.filter("k % 5 = 0").select("prefecture", "municipality", F.lit("").alias("district"))
    wards = s.select("prefecture", F.lit("city").alias("municipality"), F.col("municipality").alias("ward"), F.lit("u").alias("official_url"), F.when(F.col("k") % 4 == 0, "/w/").otherwise("").alias("scope"))
    parts = {"site": intake.site_targets(s, done), "prefecture": intake.prefecture_targets(s), "ward": intake.ward_targets(wards)}
    rows = [df.select(F.lit(kind).alias("kind"), "prefecture", "municipality", "district", "official_url") for kind, df in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@oracle("""SELECT n_regionkey::VARCHAR AS prefecture, n_name AS municipality, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE 'http://h' || n_nationkey::VARCHAR || '/' END AS url, CASE WHEN n_nationkey % 3 = 0 THEN 'no' ELSE 'yes' END AS resolved FROM nation""")
def resolved_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation is linked twice from its region's list; only one page in some pairs, or none, names it."""
    ship(spark)
    n = table(spark, sf_dir, "nation")
    pref, key = F.col("n_regionkey").cast("string"), F.col("n_nationkey").cast("string")
    municipalities = n.select(pref.alias("prefecture"), F.col("n_name").alias("municipality"), F.lit("").alias("muni_romaji"), F.lit("").alias("type"), F.lit("").alias("pref_romaji"))
    label = F.concat(F.lit("link to "), "n_name", F.lit("!"))
    links = n.select(pref.alias("prefecture"), F.col("n_nationkey").alias("rank"), label.alias("label"), F.concat(F.lit("http://x"), key, F.lit("/a")).alias("url")).unionByName(n.select(pref, F.col("n_nationkey") + 100, label, F.concat(F.lit("http://h"), key, F.lit("/b"))).toDF("prefecture", "rank", "label", "url"))
    stored = n.filter("n_nationkey % 3 <> 0").select(F.concat(F.lit("http://h"), key, F.lit("/")).alias("url"), F.concat(F.lit("<p>site of "), "n_name", F.lit("</p>")).alias("text")).unionByName(n.select(F.concat(F.lit("http://x"), key, F.lit("/")).alias("url"), F.lit("nothing").alias("text")))
    return sites.resolve_sites(municipalities, links, stored)


@oracle("""WITH old AS (SELECT c_custkey AS id, c_nationkey AS n, c_custkey % 2 = 0 AS made FROM customer WHERE c_custkey % 3 <> 0)
SELECT id, n, made FROM old WHERE NOT (n < 5 AND made) UNION ALL SELECT c_custkey, c_nationkey, true FROM customer WHERE c_custkey % 3 = 0 AND c_nationkey < 5""")
def merged_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("n"), (F.col("c_custkey") % 2 == 0).alias("made"))
    new = c.filter("id % 3 = 0 and n < 5").withColumn("made", F.lit(True))
    return publish.upsert(c.filter("id % 3 <> 0"), new, "id", F.col("n") < 5, F.col("made"), replace=True)


#: Customers as published records and as judged rows of the prefecture 3: existing where the key is no multiple of 3, judged where it is one of 2.
_MERGE = """WITH c AS (SELECT c_custkey AS k, c_nationkey % 4 AS p, 'm' || (c_custkey % 5)::VARCHAR AS m, 'c-' || (c_custkey - c_custkey % 2)::VARCHAR AS slug, 'n' || (c_custkey % 400)::VARCHAR AS nm, c_mktsegment AS seg FROM customer),
e AS (SELECT 'c-' || k::VARCHAR AS id, p, m, nm, k % 4 <> 1 AS made FROM c WHERE k % 3 <> 0),
j AS (SELECT CASE WHEN k % 14 = 0 THEN NULL ELSE slug END AS id, p, m, nm, k FROM c WHERE k % 2 = 0 AND p = 3 AND seg <> 'MACHINERY' AND k % 10 <> 0),
f AS (SELECT e.*, {guard} AS guards, {goes} AS goes FROM e),
t AS (SELECT j.*, EXISTS (SELECT 1 FROM f WHERE f.guards AND f.p = j.p AND f.m = j.m AND f.nm = j.nm) AS taken FROM j),
b AS (SELECT t.*, CASE WHEN t.id IS NULL THEN 'withheld' WHEN f.guards OR taken THEN 'blocked' ELSE 'added' END AS action, CASE WHEN t.id IS NULL THEN 'pending' WHEN f.guards THEN 'id' WHEN taken THEN 'name' ELSE 'new' END AS rule FROM t LEFT JOIN f USING (id)),
o AS (SELECT f.*, CASE WHEN goes AND b.action = 'added' THEN 'replaced' WHEN goes THEN 'removed' ELSE 'kept' END AS action,
  CASE WHEN goes AND b.action = 'added' THEN 'same_id' WHEN goes THEN 'pipeline' WHEN f.p <> 3 THEN 'other_prefecture' WHEN NOT made THEN 'curated' ELSE 'existing' END AS rule FROM f LEFT JOIN b USING (id))
"""
_ADDING = _MERGE.format(guard="true", goes="false")
_REPLACING = _MERGE.format(guard="e.p = 3 AND NOT made", goes="e.p = 3 AND made")
_COUNTS = "SELECT action, rule, count(*) AS n FROM (SELECT action, rule FROM b UNION ALL SELECT action, rule FROM o) GROUP BY ALL"


def _merge_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    text = lambda c: c.cast("string")
    c = table(spark, sf_dir, "customer").select(
        k, text(F.col("c_nationkey") % 4).alias("prefecture"), F.concat(F.lit("m"), text(k % 5)).alias("municipality"), F.concat(F.lit("n"), text(k % 400)).alias("name"), "c_mktsegment",
        F.array(F.lit("alias")).alias("aliases"), F.lit("").alias("venue"), F.lit("").alias("usual_schedule"), F.lit("").alias("date_note"), F.array("c_mktsegment").alias("categories"), F.array(F.lit("u")).alias("source_urls"), F.lit("").alias("s4_reason"),
    )
    old = publish.build_records(c.filter(k % 3 != 0).withColumn("slug", F.concat(F.lit("c-"), text(k))).withColumn("aliases", F.array().cast("array<string>")), "2026-01-01")
    old = old.withColumn("notes", F.when(F.regexp_extract("id", "[0-9]+", 0).cast("long") % 4 != 1, F.col("notes")).otherwise("by hand"))
    judged = c.filter(k % 2 == 0).withColumn("slug", F.when(k % 14 == 0, "PENDING").otherwise(F.concat(F.lit("c-"), text(k)))).withColumns({
        "s4_verdict": F.when(F.col("c_mktsegment") == "MACHINERY", "drop").otherwise("keep"), "s4_alias_of": F.when(k % 10 == 0, "c-1").otherwise(""),
    })
    return old, judged


@oracle(_ADDING + _COUNTS)
def merge_by_adding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.action_counts(publish.merge(*_merge_inputs(spark, sf_dir), "3", "2026-02-01", replace=False)[1])


@oracle(_REPLACING + _COUNTS)
def merge_by_replacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.action_counts(publish.merge(*_merge_inputs(spark, sf_dir), "3", "2026-02-01", replace=True)[1])


@oracle(_REPLACING + """, r AS (SELECT id, p, m, nm, '2026-01-01' AS accessed, made AS pipeline FROM o WHERE action = 'kept' UNION ALL SELECT id, p, m, nm, '2026-02-01', true FROM b WHERE action = 'added')
SELECT id, p::VARCHAR AS prefecture, m AS municipality, nm AS name, 'u' AS url, accessed, 'name_mentioned' AS supports, pipeline FROM r""")
def table_after_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands in the published table, its nested sources opened."""
    rows, _ = publish.merge(*_merge_inputs(spark, sf_dir), "3", "2026-02-01", replace=True)
    source = F.get("sources", F.lit(0))
    return rows.select("id", "prefecture", "municipality", "name", source["url"].alias("url"), source["accessed"].alias("accessed"), F.array_join(source["supports"], ",").alias("supports"), publish.made_here().alias("pipeline"))


@oracle("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 AND p_name LIKE 'old %' THEN substr(p_name, 5) ELSE p_name END AS name, CASE WHEN p_size % 2 = 0 AND p_name LIKE 'old %' THEN p_type || '|' || p_name ELSE p_type END AS aliases FROM part""")
def renamed_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"), F.array("p_type").alias("aliases"), (F.col("p_size") % 2 == 0).alias("made"))
    return publish.rename(rows, "name", F.regexp_replace("name", "^old ", ""), "aliases", F.col("made")).select("p_partkey", "name", F.array_join("aliases", "|").alias("aliases"))


@oracle("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_type END AS district FROM part")
def filled_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") % 3 != 0, F.col("p_type")).otherwise("").alias("district"))
    return publish.fill_blank(rows, "district", F.col("p_brand")).select("p_partkey", "district")


@oracle("SELECT p_partkey, array_to_string(list_transform(list_sort(list_transform(string_split(p_name, ' '), lambda t: {'n': -length(t), 't': t})), lambda s: s.t), '|') AS terms FROM part")
def terms_longest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(intake.longest_first(F.split("p_name", " ")), "|").alias("terms"))


@oracle("SELECT c_custkey, row_number() OVER (ORDER BY CASE c_mktsegment WHEN 'MACHINERY' THEN 0 WHEN 'BUILDING' THEN 1 ELSE 2 END, c_custkey) AS place FROM customer")
def fixed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments in a fixed order, the others behind them, then by key."""
    c = table(spark, sf_dir, "customer").select("c_custkey", intake.listed_place("c_mktsegment", ["MACHINERY", "BUILDING"]).alias("p"))
    return records.numbered(c, ["p", "c_custkey"]).select("c_custkey", F.col("__n").cast("long").alias("place"))


@oracle("""WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 4 = 0 THEN 'cache' WHEN event_id % 5 = 0 THEN 'denied' END AS free FROM events), t AS (SELECT *, sum(CASE WHEN free IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS turn FROM e)
SELECT event_id, CASE WHEN free IS NOT NULL THEN free WHEN turn > 6 THEN 'capped' ELSE 'fetch' END AS action, CASE WHEN free IS NULL AND turn <= 6 THEN (turn - 1) * 1.5 END::DOUBLE AS start_second FROM t""")
def fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", (F.col("event_id") % 4 == 0).alias("cached"), (F.col("event_id") % 5 != 0).alias("allowed"))
    return etiquette.fetch_plan(e, "user_id", "event_id", "cached", "allowed", 1.5, 6).select("event_id", "action", F.col("start_second").cast("double").alias("start_second"))


EXTRACT_PAGE = (
    "<title>日立市の催し</title><table><tr><th>名称</th><th>所在地</th></tr><tr><td>日立さくらまつり</td><td>日立市</td></tr><tr><td>撞舞祭</td><td>龍ケ崎市</td></tr></table>"
    "<h2>日立さくらまつり</h2><p>綱火大祭は毎年8月に神峰公園で開催</p><a href='/x'>綱火大祭</a><li>ごみの申請</li>"
)


@oracle("""SELECT page_id, unnest(['table', 'table', 'anchor']) AS origin, unnest(['日立さくらまつり', '撞舞祭', '綱火大祭']) AS name, unnest(['日立市', '龍ケ崎市', '水戸市']) AS municipality, 'festival_word' AS reason,
  unnest(['', '', '毎年8月']) AS date_text, unnest(['', '', '綱火大祭は毎年8月に神峰公園']) AS venue FROM pages WHERE page_id % 2 = 0""")
def extracted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.when(F.col("page_id") % 2 == 0, EXTRACT_PAGE).otherwise("<title>ごみ</title>").alias("page"), F.lit("水戸市").alias("municipality"))
    return H.extract_pages(pages, "page_id", "page", "url", "municipality", ["日立市", "龍ケ崎市"]).select("page_id", "origin", "name", "municipality", "reason", "date_text", "venue")


@oracle("""WITH r AS (SELECT lpad(row_number() OVER (ORDER BY p_partkey)::VARCHAR, 7, '0') AS id, p_partkey, p_brand, CASE WHEN p_size % 10 = 0 THEN '(県全域)' ELSE p_brand || '市' END AS m0, p_name AS name, p_size,
  ['u' || p_partkey::VARCHAR, 'v'][1:p_size % 2 + 1] AS urls FROM part),
v AS (SELECT *, CASE WHEN p_size % 4 = 3 THEN 'drop' ELSE 'keep' END AS verdict, CASE WHEN m0 = '(県全域)' AND p_size % 20 = 0 THEN 'x市' ELSE m0 END AS m FROM r),
k AS (SELECT *, CASE WHEN verdict = 'keep' THEN replace(name, ' ', '') END AS mk FROM v),
h AS (SELECT *, first_value(id) OVER w AS head, count(*) OVER (PARTITION BY m, mk) AS n FROM k WHERE mk IS NOT NULL WINDOW w AS (PARTITION BY m, mk ORDER BY len(urls) DESC, id)),
a AS (SELECT id, CASE WHEN n > 1 AND head <> id THEN head ELSE '' END AS alias FROM h),
c AS (SELECT v.*, coalesce(a.alias, '') AS alias FROM v LEFT JOIN a USING (id)),
s AS (SELECT *, CASE WHEN verdict <> 'keep' OR alias <> '' THEN '' WHEN m IN ('x市', '(県全域)') THEN 'PENDING' ELSE 'p-m-x' || substr(sha1('p/m/' || replace(name, ' ', '')), 1, 8) END AS slug FROM c),
o AS (SELECT slug, min(id) AS owner FROM s WHERE slug LIKE 'p-%' GROUP BY 1)
SELECT id, m AS municipality, name, verdict AS s4_verdict, CASE WHEN owner IS NOT NULL AND owner <> id THEN owner ELSE alias END AS s4_alias_of, CASE WHEN owner IS NOT NULL AND owner <> id THEN '' ELSE s.slug END AS slug FROM s LEFT JOIN o USING (slug)""")
def applied_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The apply chain over parts: places, merges by name, ids; the names are Latin, so cleaning leaves them."""
    part = records.numbered(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size"), ["p_partkey"], width=7).drop("__n")
    size = F.col("p_size")
    rows = part.select(
        "id", F.lit("pref").alias("prefecture"), F.when(size % 10 == 0, R.PREFECTURE_WIDE).otherwise(F.concat("p_brand", F.lit("市"))).alias("municipality"), F.col("p_name").alias("name"), F.lit("").alias("venue"), F.lit("").alias("date_note"),
        F.array().cast("array<string>").alias("aliases"), F.slice(F.array(F.concat(F.lit("u"), F.col("p_partkey").cast("string")), F.lit("v")), 1, size % 2 + 1).alias("source_urls"), F.lit(1).cast("long").alias("source_count"), F.lit("PENDING").alias("slug"),
    )
    verdicts = part.select("id", F.when(size % 4 == 3, "drop").otherwise("keep").alias("verdict"), F.lit("folk").alias("reason"), F.lit("").alias("alias_of"), F.when(size % 20 == 0, "x市").otherwise("").alias("municipality"), F.lit("").alias("reading"))
    nowhere = spark.createDataFrame([("pref", "(県全域)", "nothing", 1)], "prefecture string, municipality string, name string, ord long")
    brands = table(spark, sf_dir, "part").select(F.lit("pref").alias("prefecture"), F.concat("p_brand", F.lit("市")).alias("municipality"), F.lit("p").alias("pref_romaji"), F.lit("m").alias("muni_romaji")).distinct()
    stems = spark.createDataFrame([("pref", "zzz市", 1)], "prefecture string, municipality string, ord int")
    out = apply.apply_verdicts(rows, verdicts, apply.designated_places([nowhere]), stems, brands)
    return out.select("id", "municipality", "name", "s4_verdict", "s4_alias_of", "slug")


@oracle("""WITH r AS (SELECT lpad(row_number() OVER (ORDER BY p_partkey)::VARCHAR, 7, '0') AS id, 'p' || (p_partkey % 2)::VARCHAR AS p, p_brand || '市' AS m, 'm' || split_part(p_brand, '#', 2) AS mr, p_name AS name, p_size, ['u' || p_partkey::VARCHAR, 'v'][1:p_size % 2 + 1] AS urls FROM part),
v AS (SELECT *, CASE WHEN p_size % 7 = 1 THEN 'unsure' WHEN p_size % 4 = 3 THEN 'drop' ELSE 'keep' END AS verdict FROM r),
k AS (SELECT *, replace(name, ' ', '') AS mk FROM v WHERE verdict = 'keep'),
h AS (SELECT *, first_value(id) OVER w AS head, count(*) OVER (PARTITION BY p, m, mk) AS n FROM k WINDOW w AS (PARTITION BY p, m, mk ORDER BY len(urls) DESC, id)),
g AS (SELECT head, count(DISTINCT u) AS source_count FROM (SELECT head, unnest(urls) AS u FROM h WHERE n > 1) GROUP BY head)
SELECT v.id, v.p AS prefecture, v.m AS municipality, v.verdict AS s4_verdict, CASE WHEN n > 1 AND h.head <> v.id THEN h.head ELSE '' END AS s4_alias_of, coalesce(source_count, 1) AS source_count,
  CASE WHEN v.verdict <> 'keep' OR (n > 1 AND h.head <> v.id) THEN '' ELSE v.p || '-' || v.mr || '-x' || substr(sha1(v.p || '/' || v.mr || '/' || v.name_key), 1, 8) END AS slug
FROM (SELECT *, replace(name, ' ', '') AS name_key FROM v) v LEFT JOIN h USING (id) LEFT JOIN g ON g.head = v.id""")
def verdicts_of_two_prefectures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The apply chain where two prefectures have municipalities of the same names, and some answers name themselves as an alias."""
    part = records.numbered(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size"), ["p_partkey"], width=7).drop("__n")
    size = F.col("p_size")
    rows = part.select(
        "id", F.concat(F.lit("p"), (F.col("p_partkey") % 2).cast("string")).alias("prefecture"), F.concat("p_brand", F.lit("市")).alias("municipality"), F.col("p_name").alias("name"), F.lit("").alias("venue"), F.lit("").alias("date_note"),
        F.array().cast("array<string>").alias("aliases"), F.slice(F.array(F.concat(F.lit("u"), F.col("p_partkey").cast("string")), F.lit("v")), 1, size % 2 + 1).alias("source_urls"), F.lit(1).cast("long").alias("source_count"), F.lit("PENDING").alias("slug"),
    )
    verdicts = part.select("id", F.when(size % 4 == 3, "drop").otherwise("keep").alias("verdict"), F.lit("folk").alias("reason"), F.when(size % 7 == 1, F.col("id")).otherwise("").alias("alias_of"), F.lit("").alias("municipality"), F.lit("").alias("reading"))
    nowhere = spark.createDataFrame([("p0", "(県全域)", "nothing", 1)], "prefecture string, municipality string, name string, ord long")
    romaji = rows.select("prefecture", "municipality", F.col("prefecture").alias("pref_romaji"), F.concat(F.lit("m"), F.regexp_extract("municipality", "#([0-9]+)", 1)).alias("muni_romaji")).distinct()
    stems = spark.createDataFrame([("p0", "zzz市", 1)], "prefecture string, municipality string, ord int")
    out = apply.apply_verdicts(rows, verdicts, apply.designated_places([nowhere]), stems, romaji, index=rows.select("id", "prefecture", "municipality", "name"))
    return out.select("id", "prefecture", "municipality", "s4_verdict", "s4_alias_of", "source_count", "slug")


@oracle("""WITH p AS (SELECT page_id, url, split_part(url, '/', 3) AS host, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \\t\\r\\n]+', ' ', 'g'), ' ') AS digest, html FROM pages),
o AS (SELECT *, substr(sha1(url), 1, 8) AS pid FROM p WHERE contains(html, 'th') AND host NOT LIKE 'm.%' AND len(regexp_extract_all(html, '<li')) < 6 AND length(digest) >= 120),
f AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY pid ORDER BY host, page_id) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS k FROM f), c AS (SELECT *, row_number() OVER (ORDER BY host, k) AS n FROM r WHERE k <= 2)
SELECT pid AS page_id, host, 'm-' || host AS municipality, url, length(digest) AS n_chars FROM c WHERE n <= 25""")
def judge_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without list items enough: two of a host, 25 in all, in the order of hosts. Hosts with an m. in front are unknown."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"))
    hosts = pages.filter(~F.startswith("host", F.lit("m."))).select("host", F.lit("p").alias("prefecture"), F.concat(F.lit("m-"), "host").alias("municipality")).distinct()
    listed = pages.filter(F.regexp_count("html", F.lit("<li")) >= 6).select("url")
    digest = F.trim(F.regexp_replace(F.regexp_replace("html", "<[^>]+>", " "), "[ \t\r\n]+", " "))
    out = intake.residue(pages, hosts, listed, F.contains("html", F.lit("th")), digest, "page_id", per_host=2, limit=25)
    return out.select("page_id", "host", "municipality", "url", F.length("digest").cast("long").alias("n_chars"))


@oracle("""WITH RECURSIVE roots AS (SELECT r_regionkey AS p, 'Category:root ' || r_regionkey || ' ' || t AS category, t AS ord FROM region, range(2) x(t)),
edges AS (
  SELECT 'Category:root ' || n_regionkey || ' ' || t AS parent, 'Category:' || n_name AS child, (CASE WHEN t = 0 THEN n_nationkey ELSE 99 - n_nationkey END)::BIGINT AS ord FROM nation, range(2) x(t) WHERE (n_nationkey + t) % 3 > 0
  UNION ALL SELECT DISTINCT 'Category:' || n_name, 'Category:' || c_mktsegment, length(c_mktsegment) FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 = 0
), walk AS (
  SELECT p, category, 0 AS depth, lpad(ord::VARCHAR, 9, '0') AS path FROM roots
  UNION ALL SELECT p, child, depth + 1, path || '/' || lpad(e.ord::VARCHAR, 9, '0') FROM walk JOIN edges e ON parent = category WHERE depth < 2 AND child NOT LIKE '%BUILDING'
), visits AS (SELECT p, category, min(path) AS path FROM walk GROUP BY ALL),
members AS (SELECT 'Category:' || n_name AS category, c_name AS title, c_custkey AS ord FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'Category:' || c_mktsegment, 'Seg ' || (c_custkey % 50) || ' x', c_custkey FROM customer),
found AS (SELECT p, title, arg_min(category, path || '#' || lpad(ord::VARCHAR, 12, '0')) AS category FROM visits JOIN members USING (category) GROUP BY ALL)
SELECT p::VARCHAR AS prefecture, title AS name, replace(category, 'Category:', '') AS category, 'https://ja.wikipedia.org/wiki/' || replace(replace(title, ' ', '_'), '#', '%23') AS url FROM found""")
def gazetteer_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two roots a region, nations below them, segments below those; customers are the articles. A nation under both roots is walked under the first."""
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    named = lambda c: F.concat(F.lit("Category:"), c)
    of_root = lambda r: F.concat(F.lit("Category:root "), r.cast("string"), F.lit(" "), F.col("t").cast("string"))
    twice = F.explode(F.array(F.lit(0), F.lit(1))).alias("t")
    roots = table(spark, sf_dir, "region").select("r_regionkey", twice).select(F.col("r_regionkey").cast("string").alias("prefecture"), of_root(F.col("r_regionkey")).alias("category"), F.col("t").cast("long").alias("ord"))
    upper = nation.select("*", twice).filter((F.col("n_nationkey") + F.col("t")) % 3 > 0).select(of_root(F.col("n_regionkey")).alias("parent"), named(F.col("n_name")).alias("child"), F.when(F.col("t") == 0, F.col("n_nationkey")).otherwise(99 - F.col("n_nationkey")).cast("long").alias("ord"))
    both = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    lower = both.filter("c_custkey % 3 = 0").select(named(F.col("n_name")).alias("parent"), named(F.col("c_mktsegment")).alias("child"), F.length("c_mktsegment").cast("long").alias("ord")).distinct()
    members = both.select(named(F.col("n_name")).alias("category"), F.col("c_name").alias("title"), F.col("c_custkey").cast("long").alias("ord"))
    members = members.unionByName(customer.select(named(F.col("c_mktsegment")).alias("category"), F.concat(F.lit("Seg "), (F.col("c_custkey") % 50).cast("string"), F.lit(" x")).alias("title"), F.col("c_custkey").cast("long").alias("ord")))
    return crawl.gazetteer(members, upper.unionByName(lower), roots, follow="^(?!.*BUILDING)")


def _ledger_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts after three runs over a growing folder of the ledger's lines, the last of which finds nothing new."""
    log, state = staging_path(spark, "ledger-log"), staging_path(spark, "ledger-counts")
    e = table(spark, sf_dir, "events")
    url = F.concat(F.lit("http://U"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_id").cast("string"))
    line = F.concat_ws("\t", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "event_type", url, F.lit("200"), F.when(F.col("event_id") % 4 != 0, F.col("event_id").cast("string")).otherwise("-"))
    for batch in (1, 2):
        e.filter(F.col("event_id") % 5 > 1 if batch == 1 else F.col("event_id") % 5 <= 1).select(line.alias("value")).write.text(f"{log}/batch-{batch:05d}")
        ledger.update_counts(spark, log, state)
    return ledger.update_counts(spark, log, state)


_LEDGER_LINES = "WITH l AS (SELECT 'u' || user_id AS host, strftime(ts, '%Y-%m-%d') AS day, event_type AS kind, CASE WHEN event_id % 4 <> 0 THEN event_id ELSE 0 END AS bytes FROM events) "


@oracle(_LEDGER_LINES + "SELECT host, min(day) AS first, max(day) AS last, count(*) FILTER (kind = 'view') AS n_view, count(*) FILTER (kind = 'click') AS n_click, count(*) FILTER (kind NOT IN ('view', 'click')) AS n_error, sum(bytes)::BIGINT AS bytes FROM l GROUP BY host")
def ledger_hosts_in_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ledger.hosts_of_counts(_ledger_runs(spark, sf_dir), ("view", "click", "error"), "error")
    return out.select("host", "first", "last", *[F.col(k).alias(f"n_{k}") for k in ("view", "click", "error")], "bytes")


@oracle(_LEDGER_LINES + "SELECT day, count(*) FILTER (kind = 'view') AS n_view, count(*) FILTER (kind = 'click') AS n_click, count(*) FILTER (kind NOT IN ('view', 'click')) AS n_other FROM l GROUP BY day")
def ledger_days_in_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ledger.days_of_counts(_ledger_runs(spark, sf_dir), ("view", "click"))
    return out.select("day", *[F.col(k).alias(f"n_{k}") for k in ("view", "click", "other")])


@oracle("""WITH r AS (SELECT p_brand AS prefecture, p_name || '、' || p_type AS name, p_type AS category, CASE WHEN p_size % 9 = 0 THEN '有形文化財' ELSE '' END AS sub, 0 AS reg, p_partkey AS ord FROM part WHERE p_size % 2 = 0
  UNION ALL SELECT p_brand, p_name, CASE WHEN p_size % 4 = 1 THEN '' ELSE 'kind' END, '', 1, p_partkey FROM part WHERE p_size % 2 = 1 UNION ALL SELECT n_name, 'old ' || n_name || '祭', 'n', '', 2, n_nationkey FROM nation),
t AS (SELECT prefecture, name, category, reg, ord, generate_subscripts(w, 1) AS pos, unnest(w) AS term FROM (SELECT *, regexp_split_to_array(name, '[、 ]') AS w FROM r WHERE NOT regexp_matches(sub, '有形文化財')))
SELECT prefecture, term, CASE WHEN regexp_matches(term, 'gear|rod|祭') THEN 'yes' ELSE 'no' END AS covered, count(*) AS source_count, coalesce(string_agg(DISTINCT nullif(category, ''), '|' ORDER BY nullif(category, '')), '') AS categories,
  arg_min(name, reg * 100000000000 + ord * 100 + pos) AS example
FROM t WHERE length(term) >= 2 AND term NOT IN ('old', 'new') AND term NOT LIKE '%anvil%' AND term NOT LIKE '%PRO%' GROUP BY prefecture, term""")
def vocabulary_of_registries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three registries in a row; rows of a tangible kind give no terms, blank kinds no category."""
    part = table(spark, sf_dir, "part")
    brand, size = F.col("p_brand").alias("prefecture"), F.col("p_size")
    national = part.filter(size % 2 == 0).select(brand, F.concat_ws("、", "p_name", "p_type").alias("name"), F.col("p_type").alias("category"), F.when(size % 9 == 0, "有形文化財").otherwise("").alias("subcategory"), F.col("p_partkey").alias("ord"))
    local = part.filter(size % 2 == 1).select(brand, F.col("p_name").alias("name"), F.when(size % 4 == 1, "").otherwise("kind").alias("kind"), F.col("p_partkey").alias("ord"))
    judged = table(spark, sf_dir, "nation").select(F.col("n_name").alias("prefecture"), F.concat(F.lit("old "), "n_name", F.lit("祭")).alias("name"), F.lit("n").alias("kind"), F.col("n_nationkey").alias("ord"))
    places = spark.createDataFrame([("anvil",), ("PRO",), ("a",)], "place string")
    out = coverage.regional_vocabulary(national, [local, judged], places, P.terms_of(F.col("name"), "[、 ]", ["old", "new"]), F.col("term").rlike("gear|rod|祭"), skip="有形文化財")
    return out.select("prefecture", "term", "covered", "source_count", F.array_join("categories", "|").alias("categories"), "example")


@oracle("""SELECT n_name AS prefecture, CASE WHEN n_nationkey % 4 = 0 THEN '' WHEN n_nationkey % 4 = 1 THEN 'https://pref.n' || n_nationkey || '.jp/' ELSE 'https://www.pref.n' || n_nationkey || '.jp/' END AS official_url,
  CASE WHEN n_nationkey % 3 = 0 THEN 'https://edu.pref.n' || n_nationkey || '.jp/' ELSE '' END AS education_url, CASE WHEN n_nationkey % 4 = 0 THEN 'no' ELSE 'yes' END AS resolved FROM nation""")
def resolved_prefectures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as prefectures: some sites name another one, some aren't stored."""
    k = F.col("n_nationkey")
    romaji = F.concat(F.lit("n"), k.cast("string"))
    n = table(spark, sf_dir, "nation").select("n_name", k, romaji.alias("romaji"))
    url = lambda head, tail: F.concat(F.lit("https://" + head), "romaji", F.lit(tail))
    page = lambda u, good: n.select(u.alias("url"), F.when(good, F.concat(F.lit("<b>"), "n_name", F.lit("</b>"))).otherwise("elsewhere").alias("text"))
    stored = page(url("www.pref.", ".jp/"), k % 4 > 1).unionByName(page(url("pref.", ".jp/"), k % 4 > 0)).unionByName(page(url("edu.pref.", ".jp/"), k % 3 == 0))
    return sites.resolve_prefectures(n.select(F.col("n_name").alias("prefecture"), "romaji"), stored)


@oracle("""SELECT s_suppkey::VARCHAR AS code, s_name AS ward, CASE WHEN s_suppkey % 6 = 0 THEN 'http://c' || s_nationkey || '/w' || s_suppkey || '/index.html' WHEN s_suppkey % 5 = 0 THEN 'http://c' || s_nationkey || '/r' || s_suppkey || 'ku/' ELSE '' END AS official_url,
  CASE WHEN s_suppkey % 6 = 0 THEN 'http://c' || s_nationkey || '/w' || s_suppkey || '/' WHEN s_suppkey % 5 = 0 THEN 'http://c' || s_nationkey || '/r' || s_suppkey || 'ku/' ELSE '' END AS scope, CASE WHEN s_suppkey % 6 = 0 OR s_suppkey % 5 = 0 THEN 'yes' ELSE 'no' END AS resolved FROM supplier""")
def resolved_wards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as wards of their nation: linked from its first page, from an index page, or guessed; some pages name no ward."""
    k = F.col("s_suppkey")
    text = lambda c: F.col(c).cast("string")
    top = F.concat(F.lit("http://c"), text("s_nationkey"), F.lit("/"))
    s = table(spark, sf_dir, "supplier").select(k, "s_name", "s_nationkey", top.alias("top"))
    wards = s.select(text("s_suppkey").alias("code"), F.lit("p").alias("prefecture"), F.concat(F.lit("C"), text("s_nationkey")).alias("city"), F.col("s_name").alias("ward"), F.concat(F.lit("r"), text("s_suppkey")).alias("romaji"))
    cities = s.select(F.lit("p").alias("prefecture"), F.concat(F.lit("C"), text("s_nationkey")).alias("city"), "top").distinct()
    page, deep = F.concat("top", F.lit("w"), text("s_suppkey"), F.lit("/index.html")), F.concat("top", F.lit("list"))
    linked = s.filter(k % 3 == 0).select(F.when(k % 2 == 0, deep).otherwise(F.col("top")).alias("page"), k.alias("ord"), F.concat("s_name", F.when(k % 4 == 0, "役所").otherwise("")).alias("label"), page.alias("url"))
    index = cities.select(F.col("top").alias("page"), F.lit(0).alias("ord"), F.lit("各区").alias("label"), F.concat("top", F.lit("list")).alias("url"))
    stored = s.filter(k % 6 == 0).select(page.alias("url"), F.concat(F.lit("C"), text("s_nationkey"), F.lit("・ "), "s_name").alias("text"))
    stored = stored.unionByName(s.filter(k % 5 == 0).select(F.concat("top", F.lit("r"), text("s_suppkey"), F.lit("ku/")).alias("url"), F.concat("s_name", F.lit("役所")).alias("text"))).unionByName(s.select(page.alias("url"), F.lit("nothing").alias("text")).filter(k % 6 == 3))
    out = sites.resolve_wards(wards, cities, sites.city_links(cities, linked.unionByName(index)), stored)
    return out.select("code", "ward", "official_url", "scope", "resolved")


@oracle("""WITH n AS (SELECT n_name, n_nationkey FROM nation WHERE n_regionkey < 2) SELECT 'r' || r_regionkey::VARCHAR AS node, 0::BIGINT AS depth FROM region WHERE r_regionkey < 2 UNION ALL SELECT n_name, 1 FROM n
UNION ALL SELECT DISTINCT s_name, 2 FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n WHERE n_nationkey % 2 = 0)""")
def filtered_category_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only nations of even number are walked into."""
    n = table(spark, sf_dir, "nation")
    even = [r[0] for r in n.filter("n_nationkey % 2 = 0").select("n_name").collect()]  # 25 rows at most
    edges = n.select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent"), F.col("n_name").alias("child")).unionByName(table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("parent"), F.col("s_name").alias("child")))
    roots = table(spark, sf_dir, "region").filter("r_regionkey < 2").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node"))
    return crawl.expand(edges, roots, "parent", "child", 2, "^(" + "|".join(even) + ")$").select("node", F.col("depth").cast("long").alias("depth"))


@oracle("""SELECT o_orderkey AS ordinal, o_orderkey::VARCHAR || '/' AS code, CASE o_orderkey % 3 WHEN 0 THEN '茨城県' WHEN 1 THEN '東京都' ELSE '北海道' END AS prefecture, CASE o_orderkey % 3 WHEN 0 THEN '境町' WHEN 1 THEN '千代田区' ELSE '札幌市' END AS municipality,
  CASE o_orderkey % 3 WHEN 0 THEN '町' WHEN 1 THEN '区' ELSE '市' END AS type, CASE o_orderkey % 3 WHEN 0 THEN 'ibaraki' WHEN 1 THEN 'tokyo' ELSE 'hokkaido' END AS pref_romaji, CASE o_orderkey % 3 WHEN 0 THEN 'sakai' WHEN 1 THEN 'chiyoda' ELSE 'sapporo' END AS muni_romaji FROM orders""")
def municipality_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    lists = [("茨城県", "境町", "ｲﾊﾞﾗｷｹﾝ", "ｻｶｲﾏﾁ"), ("東京都", "千代田区", "ﾄｳｷｮｳﾄ", "ﾁﾖﾀﾞｸ"), ("北海道", "札幌市", "ﾎｯｶｲﾄﾞｳ", "ｻｯﾎﾟﾛｼ")]
    chosen = F.element_at(F.array(*[F.array(*[F.lit(x) for x in row]) for row in lists]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    sheet = table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("ordinal"), F.concat(F.array(F.concat(F.col("o_orderkey").cast("string"), F.lit("/"))), chosen).alias("cells"))
    out = registry.municipalities(sheet)
    return out.select(F.split("code", "/")[0].cast("long").alias("ordinal"), "code", "prefecture", "municipality", "type", "pref_romaji", "muni_romaji")


@oracle("SELECT ordinal, s_name, c_name FROM (SELECT row_number() OVER (ORDER BY s_suppkey) AS ordinal, s_name FROM supplier) JOIN (SELECT row_number() OVER (ORDER BY s_suppkey) AS ordinal, s_name || '?' AS c_name FROM supplier) USING (ordinal)")
def checked_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    other = s.select(F.col("s_suppkey").alias("k"), F.concat("s_name", F.lit("?")).alias("c_name"))
    return resolve.zip_checked(s, other, "s_suppkey", "k", F.startswith("c_name", F.col("s_name"))).select(F.col("ordinal").cast("long").alias("ordinal"), "s_name", "c_name")


@oracle("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS k, 'x' || substr(sha1('a/b/' || o_orderkey::VARCHAR), 1, 8) AS hashed FROM orders")
def hash_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("k"), K.hash_slug(F.lit("a"), F.lit("b"), F.col("o_orderkey").cast("string")).alias("hashed"))
