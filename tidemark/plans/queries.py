"""The engine's operators bound to the driver's tables. Every query reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import keys as K
from tidemark.functions import pages as H
from tidemark.functions import predicates as P
from tidemark.operators import coverage, crawl, ledger, publish, records, resolve
from tidemark.session import ship

#: Latin rule packs of the driver's tables.
PART_CATEGORIES = (("hardware", "bolt|rod|plate|ring"), ("machine", "gear|widget|gizmo"), ("forge", "anvil"), ("budget", "ECONOMY|PROMO"), ("warm", "^hot|red"))
LINK_SKIP, LINK_EVENT, LINK_FESTIVAL = "(?i)login|contact|/la$", "(?i)tion|ment", "(?i)^the|^and"
EVENT_KINDS = ("view", "click", "purchase", "error")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = H.candidate_strings(table(spark, sf_dir, "pages"), "page_id", "html", decode=False)
    rows = rows.filter(F.length("text").between(2, 30))
    return H.first_seen(rows, ["page_id", "text"], ["rank", "ord"]).select("page_id", "origin", "text", F.col("ord").cast("long").alias("ord"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = H.links(table(spark, sf_dir, "pages"), "page_id", "html")
    path = F.regexp_extract("href", "^([^?#]*)", 1)
    return rows.select("page_id", F.col("ord").cast("long").alias("ord"), "href", "label", P.link_priority(F.col("label"), path, LINK_SKIP, LINK_FESTIVAL, LINK_EVENT).cast("long").alias("priority"))


def dedup_key_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "documents").select(F.col("text").alias("name")).unionByName(table(spark, sf_dir, "part").select(F.col("p_name").alias("name")))
    keyed = names.select(K.dedup_key(F.col("name")).alias("k"), "name")
    return keyed.groupBy(F.md5("k").alias("k")).agg(F.count("*").alias("n_rows"), F.countDistinct("name").alias("n_names"))


def merge_prefix_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    family = lambda t, c: table(spark, sf_dir, t).select(F.lit(t).alias("family"), F.col(c).alias("k"))
    rows = family("part", "p_brand").unionByName(family("documents", "source")).unionByName(family("nation", "n_name"))
    return records.prefix_targets(rows, ["family"], "k")


def representative_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    out = records.representative(part, ["p_brand"], "p_name", "p_partkey", F.col("p_name").startswith("old"))
    return out.select("p_brand", "p_name", "n_names")


def normalize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("grp"), F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("name"), F.col("p_partkey").alias("ord"), "p_brand", "p_type",
        F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand")).alias("venue"), F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_type")).alias("date_text"),
    )
    out = records.normalize_groups(part, ["grp"], "name", "ord", F.col("name").endswith("7"), "p_brand", "venue", "date_text", "p_type", "p_brand", "p_type", cap=8, most_context=60)
    return out.select("grp", "name", *[F.array_join(c, "|").alias(c) for c in ("aliases", "source_urls", "origins", "reasons")], "venue", "date_text", "source_count", "context")


def date_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, d, y = (f("o_orderdate").cast("string") for f in (F.month, F.dayofmonth, F.year))
    kind = F.col("o_orderkey") % 6
    text = (
        F.when(kind == 0, F.concat(y, F.lit("年"), m, F.lit("月"), d, F.lit("日"))).when(kind == 1, F.concat(F.lit("毎年"), m, F.lit("月第2日曜日")))
        .when(kind == 2, F.concat(m, F.lit("月"), d, F.lit("日"))).when(kind == 3, F.lit("毎年行われる")).when(kind == 4, F.lit(" ")).otherwise(F.col("o_orderpriority"))
    )
    got = P.classify_date(text)
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("date_text"), got["schedule"].alias("schedule"), got["note"].alias("note"))


def category_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = P.categories(F.col("p_name"), F.col("p_type"), F.col("p_brand"), PART_CATEGORIES)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(tags, "|").alias("categories"))


def stable_hash_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    ident = K.stable_id(F.lower("c_mktsegment"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")), F.col("c_name"), F.when(F.col("c_custkey") % 4 == 0, F.col("c_name")))
    return c.select("c_custkey", ident.alias("id"))


def id_collision_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", K.slug(F.concat_ws(" ", "p_brand", "p_name")).alias("slug"))
    return records.own_ids(part, "slug", "p_partkey").select("p_partkey", "slug", "owner", "keeps_slug")


def unique_containment_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = table(spark, sf_dir, "documents").select(F.col("lang").alias("name")).union(table(spark, sf_dir, "region").select(F.lower("r_name")))
    names = names.union(spark.createDataFrame([(n,) for n in ("thesh", "quele", "keit", "ción", "tionnt")], "name string"))
    return resolve.contained_names(docs, ["doc_id"], "text", names, "name", "(all)").select("doc_id", "n_names", "assigned")


def names_by_rarest_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many names as documents and more: each text's first eight characters and its last six, looked up in the texts of its language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), "text")
    names = docs.select("lang", F.substring("text", 1, 8).alias("name")).union(docs.select("lang", F.expr("right(text, 6)")))
    return resolve.contained_names(docs, ["doc_id"], "text", names, "name", "(all)", ["lang"]).select("doc_id", "n_names", "assigned")


def place_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.lit("x").alias("scope"), F.concat(F.when(F.col("s_suppkey") % 3 == 0, "nation-").when(F.col("s_suppkey") % 3 == 1, "NATION_").otherwise("LAND_"), F.col("s_nationkey").cast("string")).alias("place"))
    known = table(spark, sf_dir, "nation").select(F.lit("x").alias("scope"), F.col("n_name").alias("place"))
    variants = [F.col("place"), F.upper(F.replace("place", F.lit("-"), F.lit("_"))), F.upper("place")]
    return resolve.canonical_place(s, known, "scope", "place", variants, "(all)").select("s_suppkey", "place", "resolved")


def merge_guard_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.array(F.substring("c_name", -2, 2), F.substring("c_name", -3, 3)).alias("keys"))
    existing = c.filter("segment <> 'BUILDING'").drop("segment")
    new = c.filter("segment in ('BUILDING', 'MACHINERY')").drop("segment")
    return resolve.guard(new, existing, "id", ["nation"], "keys").select("id", "nation", "guard")


def judgment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    verdicts = o.filter("o_orderstatus <> 'P'").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 11 == 0, "changed").otherwise(F.col("o_orderpriority")))
    index = o.filter("o_orderpriority <> '5-LOW'")
    return resolve.judgment_status(index, verdicts, "o_orderkey", ["o_orderpriority", "o_orderstatus"])


def alias_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    alias = F.when(k % 10 == 1, k - 1).when(k % 10 == 2, k).when(k % 10 == 3, k + 1).when(k % 10 == 4, k - 1).when(k % 10 == 5, k + 10_000_000).when(k % 10 == 6, k + 1)
    rows = o.select(k, alias.alias("alias"), F.when(k % 3 == 0, "(all)").otherwise(F.col("o_orderstatus")).alias("place"), F.when(k % 10 == 7, "drop").otherwise("keep").alias("verdict"))
    return resolve.alias_problems(rows, "o_orderkey", "alias", "place", "verdict", "(all)")


def verdict_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ragged judge answers, made from orders: cells missing, shifted or empty."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    cells = F.filter(
        F.array(
            F.when(k % 13 == 0, "id").otherwise(F.lpad(k.cast("string"), 5, "0")), F.when(k % 3 == 0, "KEEP").when(k % 3 == 1, "drop").otherwise("unsure"), F.element_at(F.split("o_orderpriority", "-"), 2),
            F.when(k % 4 == 0, F.lpad((k % 1000).cast("string"), 5, "0")).when(k % 4 == 1, ""), F.when(k % 5 == 0, "日立市"), F.when(k % 6 == 0, "つなび"),
        ),
        lambda c: c.isNotNull(),
    )
    got = P.parse_verdict(cells)
    return o.select("o_orderkey", *[got[c].alias(c) for c in ("id", "verdict", "reason", "alias_of", "municipality", "reading")])


def cleaned_name_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.concat_ws(" ", "p_name", "p_type").alias("name"), F.slice(F.array("p_brand", "p_type", F.concat_ws("-", "p_brand", "p_type")), 1, F.col("p_size") % 3 + 1).alias("urls"))
    out = records.merge_same_names(part, ["p_name"], "p_partkey", "name", "urls")
    return out.select("p_name", "canonical", "name", F.array_join("aliases", "|").alias("aliases"), "source_count", F.array_join("source_urls", "|").alias("source_urls"), "members")


def published_dedupe_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    rows = p.select(
        F.concat(F.lit("a-"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("x"), F.lpad(F.hex("p_partkey"), 8, "0"))).otherwise(F.concat(F.lit("p"), F.col("p_partkey").cast("string")))).alias("raw_id"),
        "p_name", F.col("p_brand").alias("brand"), F.col("p_partkey").alias("ord"), F.array(F.col("p_type")).alias("aliases"), F.slice(F.array("p_brand", "p_type"), 1, F.col("p_size") % 3).alias("sources"),
        F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_type")).alias("venue"), F.when(F.col("p_size") % 5 == 0, F.col("p_retailprice")).alias("price"), (F.col("p_partkey") % 97 == 0).alias("curated"),
    ).withColumn("id", F.lower("raw_id"))
    out = publish.merge_groups(rows.withColumn("name", F.concat_ws(" ", "p_name", F.col("ord").cast("string"))), ["p_name", "brand"], "id", "name", "ord", "aliases", "sources", ["venue", "price"], "curated")
    return out.select("p_name", "brand", "id", "name", F.array_join(F.array_sort("aliases"), "|").alias("aliases"), F.array_join("sources", "|").alias("sources"), "venue", "price", "merged")


def consumer_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id", "right")
    rows = d.select(F.col("n_chars").alias("id"), "lang", F.when(F.col("n_chars") > 2000, "").otherwise(F.col("source")).alias("source"), "quality", F.when(F.col("toxic") == 1, F.array(F.lit("t"))).otherwise(F.array().cast("array<string>")).alias("marks"))
    return publish.violations(rows, "id", ["lang", "source", "quality"], ["marks"])


def known_set_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.md5("text")
    d = table(spark, sf_dir, "documents").select("lang", key.alias("k"), "doc_id")
    labels = table(spark, sf_dir, "labels")
    return coverage.novelty(d.select("lang", "k"), "lang", "k", d.join(labels.filter("quality = 1"), "doc_id", "left_semi"), d.join(labels.filter("toxic = 1"), "doc_id", "left_semi"))


def golden_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = table(spark, sf_dir, "part").select(F.col("p_brand").alias("scope"), F.col("p_name").alias("k"), F.when(F.col("p_size") < 10, "core").otherwise("notable").alias("tier"))
    output = table(spark, sf_dir, "part").filter("p_type in ('ECONOMY', 'PROMO')").select(F.col("p_brand").alias("scope"), F.col("p_name").alias("k"), F.array(F.reverse("p_name")).alias("aliases"), F.col("p_partkey").alias("ord"))
    return coverage.recall(coverage.match_gold(gold, output, "scope", "k", "aliases", "ord"), "tier")


def loose_match_4gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    left = part.filter("p_size > 20").select("p_type", F.element_at(F.split("p_name", " "), 1).alias("t"))
    right = part.filter("p_retailprice > 950 and p_size < 12").select("p_type", F.element_at(F.split("p_name", " "), 2).alias("t"))
    return resolve.loose_matches(left.unionByName(left.select("p_type", F.substring("t", 2, 2).alias("t"))), right, ["p_type"], "t", 3)


def vocab_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    terms = P.terms_of(F.concat_ws("、", "p_name", "p_type"), "[、 ]", ["old", "new"])
    out = coverage.vocabulary(part, "p_brand", terms, "p_type", "p_name", "p_partkey", F.col("term").rlike("gear|rod"))
    out = coverage.without_places(out, "term", spark.createDataFrame([("anvil",), ("dge",), ("PRO",)], "place string"), "place")
    return out.select("p_brand", "term", "covered", "source_count", F.array_join("categories", "|").alias("categories"), "example")


def coverage_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    rich = table(spark, sf_dir, "supplier").filter("s_acctbal > 9500").select(F.col("s_nationkey").alias("n_nationkey"))
    poor = table(spark, sf_dir, "supplier").filter("s_acctbal < -500").select(F.col("s_nationkey").alias("n_nationkey"))
    return coverage.uncovered(n, ["n_nationkey"], [rich, poor], F.col("n_regionkey") != 2).select("n_nationkey", "n_name")


def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return resolve.zip_rows(s, c, "s_suppkey", "c_custkey").select(F.col("ordinal").cast("long").alias("ordinal"), "s_name", "c_name")


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("host"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_type").alias("kind"), F.get_json_object("props", "$.k").alias("bytes"))


def ledger_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.by_host(ledger_events(spark, sf_dir), "host", "day", "kind", "bytes", EVENT_KINDS, "error")


def ledger_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.by_day(ledger_events(spark, sf_dir), "day", "kind", EVENT_KINDS)


def ledger_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = ledger.by_host(ledger_events(spark, sf_dir), "host", "day", "kind", "bytes", ("fetch_", *EVENT_KINDS), "error").withColumn("fetch", F.col("view"))
    groups = table(spark, sf_dir, "customer").filter("c_acctbal > 3000").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("host"), F.col("c_mktsegment").alias("segment"))
    return ledger.by_group(hosts, groups, "host", "segment")


def ledger_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter("event_type = 'error'")
    url = F.concat_ws("/", F.lit("https://h"), F.col("user_id").cast("string"), F.col("event_id").cast("string"))
    log = e.filter("value > 20").select(F.lit("fail").alias("kind"), url.alias("url"))
    failures = e.select(F.date_format("ts", "yyyy-MM-dd").alias("date"), url.alias("url"), F.concat(F.lit("HTTP "), (F.col("event_id") % 200 + 400).cast("string")).alias("reason"))
    return ledger.backfill(log, failures)


def url_scope_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.lit("p").alias("pref"))
    hosts = pages.select("pref", F.lower(F.try_parse_url("url", F.lit("AUTHORITY"))).alias("host")).distinct()
    wards = F.array(*[F.struct(F.lit(w).alias("ward"), F.lit(p).alias("path")) for w, p in (("north", "/en/"), ("south", "/fr/"), ("east", "/en/7"), ("west", "/de/"))])
    return resolve.scoped_url(pages, hosts.select("*", F.inline(wards)), "url", ["pref"], "ward", "path").select("page_id", "n_scopes", "ward")


def host_first_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", K.host(F.col("url")).alias("host"), F.substring(F.sha1("url"), 1, 8).alias("page_hash"))


def judge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    return records.batches(o, ["o_orderpriority", "o_custkey", "o_orderkey"], 120).select("o_orderkey", "id", "batch_no")


def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("n", F.length("text").cast("long"))
    out = records.carry_forward(c, ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("turn")), "last_user_turn")
    return out.select("conv_id", "turn", F.coalesce("last_user_turn", F.lit(-1)).cast("long").alias("last_user_turn"))


def nested_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", "source")
    return publish.nested_counts(d, ["lang", "source"])


def filter_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published page's filter: equality, equality, normalised substring; counts of what stays visible."""
    d = table(spark, sf_dir, "documents").select("lang", "source", F.regexp_replace(F.lower("text"), r"\s+", "").alias("t"))
    shown = d.filter((F.col("lang") == "en") & F.contains("t", F.lit("thenea")))
    return shown.groupBy("lang", "source").agg(F.count("*").alias("visible"))


def registry_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("category"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return a.unionByName(b, allowMissingColumns=True).groupBy("nation", "category").agg(F.count("*").alias("n"), F.min("name").alias("first_name"))


def category_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("child"))
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("parent"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("child"))
    roots = table(spark, sf_dir, "region").filter("r_regionkey < 3").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node"))
    return crawl.expand(n.unionByName(s), roots, "parent", "child", 2).select("node", F.col("depth").cast("long").alias("depth"))


def crawl_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each host's pages link to each other by their numbers' last digits; one seed a host."""
    ship(spark)
    p = table(spark, sf_dir, "pages").select(K.host(F.col("url")).alias("site"), "url", "page_id")
    first = p.groupBy("site").agg(F.min("page_id").alias("seed_id"))
    pages = p.join(first, "site").select("site", "url", (F.col("page_id") == F.col("seed_id")).alias("seed"))
    offers = p.select("site", "url", F.explode(F.sequence(F.col("page_id") + 1, F.col("page_id") + 60)).alias("page_id"))
    edges = offers.join(p.withColumnRenamed("url", "to"), ["site", "page_id"]).select("site", "url", "to", (F.col("page_id") % 5).cast("int").alias("priority"))
    return crawl.replay(pages, edges, "site")


def page_text_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles decoded, composed and keyed: the functions that Spark has no built-in for."""
    ship(spark)
    title = H.unescape(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    return table(spark, sf_dir, "pages").select("page_id", K.norm_key(title).alias("norm_key"), K.filter_key(title).alias("filter_key"))


def page_absolute_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    pages = table(spark, sf_dir, "pages")
    return H.links(pages, "page_id", "html").join(pages.select("page_id", "url"), "page_id").select("page_id", "ord", H.url_join(F.col("url"), F.col("href")).alias("target"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tidemark.plans import goldens, more

    own = {f.__name__: f for f in (
        page_candidates, page_links, dedup_key_groups, merge_prefix_variants, representative_name, normalize_records, date_classification, category_tags, stable_hash_ids,
        id_collision_resolution, unique_containment_assign, names_by_rarest_gram, place_resolution, merge_guard_antijoin, judgment_status, alias_validation, verdict_cells, cleaned_name_merge,
        published_dedupe_fill, consumer_checks, known_set_novelty, golden_recall, loose_match_4gram, vocab_terms, coverage_gap, positional_zip, ledger_by_host, ledger_by_day,
        ledger_by_group, ledger_backfill, url_scope_district, host_first_source, judge_batches, carry_forward, nested_counts, filter_view, registry_union, category_tree,
        crawl_order, page_text_norm, page_absolute_links,
    )}
    return own | goldens.queries() | more.QUERIES
