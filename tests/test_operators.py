import random

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import coverage, crawl, ledger, publish, records, registry, resolve, sites
from tidemark.sources import pagestore, sinks, tables
from tidemark.streaming import ledger as stream


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_prefix_variants_against_the_rule(spark):
    import random

    rnd = random.Random(4)
    keys = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9))) for _ in range(250)})
    got = dict((r["k"], r["target"]) for r in records.prefix_targets(spark.createDataFrame([("s", k) for k in keys], "s string, k string"), ["s"], "k").collect())
    for k in keys:
        bases = [b for b in keys if b != k and len(b) >= 4 and k.startswith(b)]
        assert got[k] == (min(bases, key=len) if bases else k)


def test_alias_cycles_and_chains(spark):
    df = spark.createDataFrame([(1, 2, "p", "keep"), (2, 3, "p", "keep"), (3, 1, "p", "keep"), (4, 5, "p", "keep"), (5, None, "p", "keep"), (6, 4, "q", "keep"), (7, 9, "p", "keep")], "id long, alias long, place string, verdict string")
    got = {r["id"]: r["problem"] for r in resolve.alias_problems(df, "id", "alias", "place", "verdict", "(all)").collect()}
    assert got == {1: "cycle", 2: "cycle", 3: "cycle", 4: None, 6: "other_place", 7: "unknown"}


def test_unique_containment(spark):
    df = spark.createDataFrame([(1, "日立市で"), (2, "日立市と土浦市"), (3, "日立で"), (4, ""), (5, None)], "i int, t string")
    names = spark.createDataFrame([("日立市",), ("土浦市",), ("",), (None,), ("日立市",)], "n string")
    got = {r["i"]: (r["n_names"], r["assigned"]) for r in resolve.contained_names(df, ["i"], "t", names, "n", "(all)").collect()}
    assert got == {1: (1, "日立市"), 2: (2, "(all)"), 3: (0, "日立市"), 4: (0, "(all)"), 5: (0, "(all)")}
    assert {r["assigned"] for r in resolve.contained_names(df, ["i"], "t", names.limit(0), "n", "(all)").collect()} == {"(all)"}


@pytest.mark.parametrize("seed", [1, 2])
def test_containment_against_every_pair(spark, seed):
    rnd = random.Random(seed)
    word = lambda k: "".join(rnd.choice("ab日𠮷c") for _ in range(k))
    names = {rnd.choice("xy"): None for _ in range(2)}
    names = [(s, word(rnd.choice([1, 2, 3, 3, 4, 5, 7]))) for s in names for _ in range(60)]
    texts = [(i, rnd.choice("xyz"), "d" * rnd.randint(0, 3) + word(rnd.randint(0, 12))) for i in range(150)]
    df = spark.createDataFrame(texts, "i int, s string, t string")
    got = resolve.contained_names(df, ["i"], "t", spark.createDataFrame(names, "s string, n string"), "n", "-", ["s"]).collect()
    for i, s, t in texts:
        listed = sorted({n for at, n in names if at == s})
        whole, bare = [n for n in listed if n in t], [n for n in listed if len(n) > 2 and n[:-1] in t]
        want = whole[0] if len(whole) == 1 else bare[0] if len(bare) == 1 else "-"
        assert [(r["n_names"], r["assigned"]) for r in got if r["i"] == i] == [(len(whole), want)]


def test_containment_multiplies_nothing(spark):
    """A name that stands in a third of all texts, and texts that hold many names: pairs are those that contain each other."""
    names = spark.range(20_000).selectExpr("concat('n', lpad(cast(id as string), 6, '0'), 'x') AS n")
    df = spark.range(3_000).selectExpr("id", "concat(case when id % 3 = 0 then 'n000007x ' else '' end, 'n', lpad(cast(id * 5 as string), 6, '0'), 'x') AS t")
    got = resolve.contained_names(df, ["id"], "t", names, "n", "-").groupBy("n_names").count().collect()
    assert {r["n_names"]: r["count"] for r in got} == {1: 2_000, 2: 1_000}


@pytest.mark.parametrize("most", [2_000_000, 40])
def test_containment_counts_where_texts_lie(spark, monkeypatch, most):
    """A text with most of a long list of names: none of its substrings travels, also where the names come in parts."""
    monkeypatch.setattr(resolve, "PART_FORMS", most)
    texts = [(i, "x" if i % 2 else None, "".join(chr(97 + (i * j) % 7) for j in range(60)) + "𠮷") for i in range(40)] + [(7, "x", "".join(chr(97 + (7 * j) % 7) for j in range(60)) + "𠮷")]
    names = [(s, t[k : k + n]) for _, s, t in texts for k in range(0, 50, 9) for n in (4, 9, 20)] + [("x", "a𠮷"), ("x", "f𠮷b"), ("y", "abc")]
    df, listed = spark.createDataFrame(texts, "i int, s string, t string"), spark.createDataFrame(names, "s string, n string")
    out = resolve.contained_names(df, ["i"], "t", listed.filter("length(n) <= 9"), "n", "-", ["s"])
    assert "Generate" not in out._jdf.queryExecution().toString()
    for found, longest in ((out, 9), (resolve.contained_names(df, ["i"], "t", listed, "n", "-", ["s"]), 99)):
        want = []
        for i, s, t in texts:
            own = sorted({n for at, n in names if at == s and s is not None and len(n) <= longest})
            whole, bare = [n for n in own if n in t], [n for n in own if len(n) > 2 and n[:-1] in t]
            want.append((i, len(whole), whole[0] if len(whole) == 1 else bare[0] if len(bare) == 1 else "-"))
        assert rows(found.select("i", "n_names", "assigned")) == sorted(want, key=repr)


def test_numbered_is_a_rank(spark):
    df = spark.createDataFrame([(i * 7919 % 1000, i) for i in range(1000)], "k int, i int")
    got = [(r["k"], int(r["id"])) for r in records.numbered(df, ["k"]).collect()]
    assert sorted(got) == [(k, k + 1) for k in range(1000)]


def test_publish_gate_and_merge(spark, tmp_path):
    df = spark.createDataFrame([("a-xdeadbeef", "祭", [], ["u1", "u2"], 1, None, False, "k"), ("a-matsuri", "祭り", ["別名"], ["u2"], 2, "v", False, "k"), ("b", "祭", [], [], 3, "", True, "c"), ("c", "祭", [], [], 4, "", False, "c")], "id string, name string, aliases array<string>, sources array<string>, ord int, venue string, curated boolean, k string")
    got = publish.merge_groups(df, ["k"], "id", "name", "ord", "aliases", "sources", ["venue"], "curated").collect()
    assert len(got) == 1 and got[0]["id"] == "a-matsuri" and got[0]["sources"] == ["u2", "u1"] and got[0]["aliases"] == ["別名", "祭"] and got[0]["venue"] == "v"
    with pytest.raises(publish.PublishError):
        sinks.publish_json(df, str(tmp_path / "out"), "id", ["venue"], [])
    assert not (tmp_path / "out").exists()
    sinks.publish_json(df, str(tmp_path / "out"), "id", ["name"], [])
    assert spark.read.json(str(tmp_path / "out")).count() == 4


def test_upsert_rename_prune(spark):
    old = spark.createDataFrame([("a", "祭", "p", True), ("b", "祭", "p", False)], "id string, name string, pref string, made boolean")
    new = spark.createDataFrame([("a", "新", "p", True)], old.schema)
    out = publish.upsert(old, new, "id", F.col("pref") == "p", F.col("made"), replace=True)
    assert rows(out.select("id", "name")) == [("a", "新"), ("b", "祭")]
    with pytest.raises(publish.PublishError):
        publish.upsert(old, new, "id", F.col("pref") == "p", F.col("made"), replace=False)
    named = publish.rename(old.withColumn("aliases", F.array().cast("array<string>")), "name", F.lit("大祭"), "aliases", F.col("made"))
    assert rows(named.select("id", "name", "aliases")) == [("a", "大祭", ["祭"]), ("b", "祭", [])]
    assert publish.prune(spark.createDataFrame([("例大祭",), ("日立祭",), (None,)], "name string"), "name").count() == 2


def test_loose_match_against_brute_force(spark):
    import random

    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 7)))
    left, right = {word() for _ in range(60)}, {word() for _ in range(12)}
    frame = lambda s: spark.createDataFrame([("x", w) for w in s], "s string, t string")
    got = {r["t"] for r in resolve.loose_matches(frame(left), frame(right), ["s"], "t").collect()}
    shared = lambda a, b: a in b or b in a or any(a[i : i + 4] in b for i in range(len(a) - 3))
    assert got == {a for a in left if any(shared(a, b) for b in right)}


def test_crawl_order_and_tree(spark):
    pages = spark.createDataFrame([("s", "/", True), ("s", "/a", False), ("s", "/b", False), ("s", "/c", False)], "site string, url string, seed boolean")
    edges = spark.createDataFrame([("s", "/", "/a", 5), ("s", "/", "/b", 0), ("s", "/b", "/c", 1), ("s", "/b", "/gone", 0)], "site string, url string, to string, priority int")
    assert [r["url"] for r in crawl.replay(pages, edges, "site").orderBy("seq").collect()] == ["/", "/b", "/c", "/a"]
    assert crawl.replay(pages, edges, "site", budget=2).count() == 2
    tree = spark.createDataFrame([("r", "x"), ("x", "y"), ("y", "z"), ("y", "r")], "p string, c string")
    assert rows(crawl.expand(tree, spark.createDataFrame([("r",)], "n string"), "p", "c")) == [("r", 0), ("x", 1), ("y", 2)]


def test_ledger_keeps_malformed_rows(spark, tmp_path):
    (tmp_path / "access.tsv").write_text("ts\tkind\turl\tstatus\tbytes\tfinal_url\tnote\n2026-01-01T00:00:00\tfetch\thttp://H/a\t200\t12\n2026-01-02T00:00:00\tfail\thttp://h/b\t\tx\nailed>\n")
    log = tables.ledger(spark, str(tmp_path / "access.tsv")).withColumn("host", F.lit("h")).withColumn("day", F.substring("ts", 1, 10))
    assert log.count() == 3
    got = ledger.by_host(log, "host", "day", "kind", "bytes").first()
    assert (got["fetch"], got["fail"], got["bytes"]) == (1, 2, 12)
    fails = spark.createDataFrame([("2026-01-02", "http://h/b", "HTTP 404"), ("2026-01-03", "http://h/c", "HTTP 500")], "date string, url string, reason string")
    assert [(r["url"], r["status"]) for r in ledger.backfill(log, fails).collect()] == [("http://h/c", "500")]


def test_tsv_dialects(spark, tmp_path):
    (tmp_path / "q.tsv").write_text('a\tb\n"x\ty"\t1\n"l1\nl2"\t2\n')
    assert rows(tables.quoted_tsv(spark, str(tmp_path / "q.tsv"), tables.strings("a", "b"))) == [("l1\nl2", "2"), ("x\ty", "1")]
    (tmp_path / "r.tsv").write_text('a\tb\n"x\t1\n\nonly\n')
    assert rows(tables.raw_tsv(spark, str(tmp_path / "r.tsv"), tables.strings("a", "b"))) == [('"x', "1"), ("only", None)]
    (tmp_path / "v.tsv").write_text("﻿00001\tkeep\n# note\n\n00002\tdrop\tfolk\n")
    assert [r["cells"] for r in tables.ragged_tsv(spark, str(tmp_path / "v.tsv")).collect()] == [["00001", "keep"], ["00002", "drop", "folk"]]
    df = spark.createDataFrame([("a\tb\nc", ["x", "y"], None)], "s string, l array<string>, n string")
    sinks.write_tsv(df, str(tmp_path / "out"))
    assert rows(tables.raw_tsv(spark, str(tmp_path / "out"), tables.strings("s", "l", "n"))) == [("a b c", "x|y", "")]


def test_binary_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('名称,"所在\n地"\n撞舞,?\n'.encode("cp932"))
    assert [r["cells"] for r in tables.cp932_csv(spark, str(tmp_path / "a.csv")).orderBy("ordinal").collect()] == [["名称", "所在\n地"], ["撞舞", "?"]]
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>コード</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c t="s"><v>0</v></c><c><v>7</v></c></row></sheetData></worksheet>')
    (tmp_path / "a.xlsx").write_bytes(book.getvalue())
    assert tables.workbook(spark, str(tmp_path / "a.xlsx")).first()["cells"] == ["コード", "7"]
    (tmp_path / "l.html").write_text('<tr data-id="m1"><td>a</td><td>b&amp;c</td></tr><tr><td>no</td></tr>')
    assert tables.html_list(spark, str(tmp_path / "l.html")).first()["cells"] == ["a", "b&c", "", "", ""]
    assert tables.search_results('<a href="/detail/1">祭</a><a href="/detail/1"></a>1,234件中', "http://h") == ({"http://h/detail/1": "祭"}, 1234)


def test_published_json_and_cache(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"schema_version": "1", "festivals": [{"id": "a", "name": "祭", "sources": [{"url": "u"}], "location": {"latitude": 1.5}}]}')
    got = tables.records(spark, str(tmp_path / "f.json")).first()
    assert got["id"] == "a" and got["sources"][0]["url"] == "u" and got["location"]["latitude"] == 1.5


def test_page_store(spark, tmp_path):
    root = str(tmp_path / "store")
    pagestore.register(spark)
    pages = [("h", "http://h/x", "text/html; charset=sjis", 200, "祭".encode("cp932")), ("h", "http://h/y", "application/pdf", 200, b"%PDF"), ("h", "http://h/big", "text/html", 200, b"z" * 700_000), ("g", "http://g/1", "text/html", 404, b"")]
    df = spark.createDataFrame(pages, "host string, url string, content_type string, status int, content binary")
    for _ in range(2):  # a second write replaces
        df.repartition(3).write.format("stored_pages").mode("append").save(root)
    every = spark.read.format("stored_pages").option("tasks", 3).load(root)
    assert rows(every.select("host", "url", "content_type", "status", "content")) == sorted(pages, key=repr) and not list((tmp_path / "store").rglob("*.tmp"))
    hosts = spark.createDataFrame([("h", "p")], "host string, pref string")
    got = pagestore.cached_pages(spark, root, hosts, tasks=2)
    assert [(r["pref"], r["decoded_text"]) for r in tables.decode_pages(got, "content", "content_type").collect()] == [("p", "祭")]
    with pytest.raises(Exception, match="needs a host"):
        df.withColumn("host", F.lit(None).cast("string")).write.format("stored_pages").mode("append").save(root)


def test_filters_keep_files_closed(spark, tmp_path):
    """Files of other hosts, and of bodies that are too long, hold what no reader could read."""
    root = str(tmp_path / "store")
    pagestore.register(spark)
    spark.createDataFrame([("h", "http://h/x", "text/html", 200, b"ok"), ("h", "http://h/long", "text/html", 200, b"n" * 99), ("g", "http://g/1", "text/html", 200, b"")], "host string, url string, content_type string, status int, content binary").write.format("stored_pages").mode("append").save(root)
    for meta in [*(tmp_path / "store" / "g").glob("*.meta.json"), *[p.with_suffix("").with_suffix(".meta.json") for p in (tmp_path / "store" / "h").glob("*.body") if p.stat().st_size == 99]]:
        meta.write_text("{broken")
    every = spark.read.format("stored_pages").load(root)
    with pytest.raises(Exception, match="JSONDecodeError"):
        every.count()
    for only in (F.col("host") == "h", F.col("host").isin("h", "zzz")):
        assert [r["url"] for r in every.filter(only & (F.col("length") <= 50)).collect()] == ["http://h/x"]
    assert every.filter("host = 'nobody'").count() == 0


def test_cells_of_files(spark, tmp_path):
    pagestore.register(spark)
    (tmp_path / "a.csv").write_bytes('名称,"所在\n地"\n撞舞,x\n'.encode("cp932"))
    (tmp_path / "b.csv").write_bytes("火祭,y\n".encode("cp932"))
    (tmp_path / "_hidden").write_bytes(b"no")
    read = spark.read.format("cell_files").option("kind", "cp932").load(str(tmp_path))
    assert [tuple(r) for r in read.orderBy("file", "ordinal").collect()] == [("a.csv", 0, ["名称", "所在\n地"]), ("a.csv", 1, ["撞舞", "x"]), ("b.csv", 0, ["火祭", "y"])]
    assert [r["cells"] for r in read.filter("file = 'b.csv'").collect()] == [["火祭", "y"]]
    assert spark.read.format("cell_files").option("kind", "cp932").load(str(tmp_path / "a.csv")).count() == 2
    with pytest.raises(Exception, match="kind must be one of"):
        spark.read.format("cell_files").option("kind", "pdf").load(str(tmp_path)).count()


def test_cell_files_share_tasks(spark, tmp_path, monkeypatch):
    pagestore.register(spark)
    for i in range(300):
        (tmp_path / f"{i:03d}.csv").write_bytes(f"a{i}\nb{i},c\n".encode("cp932"))
    read = spark.read.format("cell_files").option("kind", "cp932").load(str(tmp_path))
    assert read.rdd.getNumPartitions() == 1
    assert rows(read) == rows(spark.createDataFrame([r for i in range(300) for r in ((f"{i:03d}.csv", 0, [f"a{i}"]), (f"{i:03d}.csv", 1, [f"b{i}", "c"]))], read.schema))
    reader = pagestore.CellReader(str(tmp_path), "cp932")
    for sizes, most in (((10, 1_000), 2), ((1 << 20, 7), 7)):
        monkeypatch.setattr(pagestore, "TASK_BYTES", sizes[0])
        monkeypatch.setattr(pagestore, "TASK_FILES", sizes[1])
        pieces = [p.names for p in reader.partitions()]
        assert [n for p in pieces for n in p] == [f"{i:03d}.csv" for i in range(300)] and max(map(len, pieces)) <= most


def test_two_writers_of_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    df = lambda n: spark.range(n).withColumn("x", F.lit("v"))
    assert sinks.table_version(spark, path) == 0 and sinks.replace_table(df(1), path) == 1
    base = sinks.table_version(spark, path)
    assert sinks.replace_table(df(2), path, base) == 2
    with pytest.raises(sinks.ConflictError):
        sinks.replace_table(df(3), path, base)
    assert sinks.read_current(spark, path).count() == 2 and len(list((tmp_path / "t").glob("v-*"))) == 2
    # Both looked before either claimed: the exclusive create decides.
    assert sinks._claim(spark, path, 3, "v-3-a") and not sinks._claim(spark, path, 3, "v-3-b")
    (tmp_path / "t" / "_log" / f"{3:020d}").unlink()
    for n in range(3, 7):
        assert sinks.replace_table(df(n), path, keep=2) == n
    assert sorted(p.name.split("-")[1] for p in (tmp_path / "t").glob("v-*")) == ["5", "6"] and sinks.read_current(spark, path, 5).count() == 5
    with pytest.raises(Exception, match="boom"):
        sinks.replace_table(df(3).withColumn("y", F.raise_error(F.lit("boom"))), path)
    assert sinks.table_version(spark, path) == 6 and len(list((tmp_path / "t").glob("v-*"))) == 2


def test_a_gate_computes_its_input_once(spark, tmp_path):
    """A value drawn anew in every run would pass the gate with one draw and be written with another."""
    df = spark.range(200).select(F.col("id"), F.expr("reflect('java.util.UUID', 'randomUUID')").alias("u"), F.lit("x").alias("name"))
    made = publish.checked(df, "id", ["name"])
    assert rows(made) == rows(made)
    with pytest.raises(publish.PublishError, match="blank:name: 200 rows; repeated:k: 1 rows"):
        publish.checked(df.withColumn("name", F.lit("")).withColumn("k", F.lit(1)), "k", ["name"])
    assert publish.checked(df.limit(0), "id", ["name"]).count() == 0
    sinks.publish_json(df, str(tmp_path / "out"), "id", ["name"], [])
    assert spark.read.json(str(tmp_path / "out")).select("u").distinct().count() == 200


def test_partition_overwrite_and_resume(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitions(spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int"), path, ["p"])
    sinks.write_partitions(spark.createDataFrame([("a", 3)], "p string, v int"), path, ["p"])
    out = spark.read.parquet(path)
    assert rows(out.select("p", "v")) == [("a", 3), ("b", 2)]
    assert rows(sinks.pending(spark.createDataFrame([("a",), ("c",)], "p string"), out, ["p"])) == [("c",)]


def test_rendering():
    page = sinks.render_index([{"prefecture": "茨城県", "municipality": "日立市", "name": "祭（まつり）", "url": "", "others": 2, "n_prefecture": 1, "n_municipality": 1}], "索引")
    assert "茨城県 (1)" in page and "+2" in page and "%E7%A5%AD" in page and "%E3%81%BE" not in page
    assert sinks.markdown("# T\n- a **b**\n\n|x|y|\n|-|-|\n|1|`2`|\n") == "<h1>T</h1>\n<ul>\n<li>a <strong>b</strong></li>\n</ul>\n<table><tr><th>x</th><th>y</th></tr><tr><td>1</td><td><code>2</code></td></tr></table>"


def test_streaming_matches_batch(spark, sf_dir, tmp_path):
    import shutil

    src = tmp_path / "events"
    src.mkdir()
    shutil.copy(f"{sf_dir}/events.parquet", src / "a.parquet")
    schema = spark.read.parquet(str(src)).schema
    query = stream.daily_counts(stream.read_events(spark, str(src), schema), "ts", "event_type").writeStream.outputMode("complete").format("memory").queryName("daily").start()
    query.processAllAvailable()
    query.stop()
    want = spark.read.parquet(str(src)).groupBy("event_type").count()
    assert rows(spark.table("daily").groupBy("event_type").agg(F.sum("n"))) == rows(want)


def test_novelty_ignores_row_order_and_empty_tables(spark):
    df = spark.createDataFrame([("p", "a"), ("p", "b"), ("p", "a"), ("q", "c")], "s string, k string")
    known = spark.createDataFrame([("p", "a")], df.schema)
    one = rows(coverage.novelty(df, "s", "k", known, known.limit(0)))
    assert one == rows(coverage.novelty(df.repartition(3), "s", "k", known, known.limit(0)))
    assert ("p", 2, 1, 0, 1, 50, 0) in one
    assert records.prefix_targets(df.limit(0), ["s"], "k").count() == 0


def test_a_later_run_reads_new_files_only(spark, tmp_path):
    """The first batch's file is spoilt once it was counted: a run that opened it would count its lines."""
    log, state = tmp_path / "log", str(tmp_path / "state")
    line = lambda day, kind, host, size: f"2026-01-{day:02d}T00:00:00\t{kind}\thttp://{host}/x\t200\t{size}\n"
    (log / "d1").mkdir(parents=True)
    (log / "d1" / "1.tsv").write_text("ts\tkind\turl\n" + line(1, "fetch", "A.jp", 10) + line(1, "ailed>", "b.jp", "x"))
    first = ledger.update_counts(spark, str(log), state)
    assert first.agg(F.sum("n")).first()[0] == 2
    (log / "d1" / "1.tsv").write_text(line(9, "fetch", "spoilt.jp", 10) * 50)
    (log / "d2").mkdir()
    (log / "d2" / "1.tsv").write_text(line(2, "fetch", "a.jp", 5) + line(2, "robots", "b.jp", 1) + "\n")
    counts = ledger.update_counts(spark, str(log), state)
    assert rows(ledger.hosts_of_counts(counts).select("host", "first", "last", "fetch", "robots", "fail", "bytes")) == [("a.jp", "2026-01-01", "2026-01-02", 2, 0, 0, 15), ("b.jp", "2026-01-01", "2026-01-02", 0, 1, 1, 1)]
    assert rows(ledger.days_of_counts(counts).select("day", "fetch", "robots", "other")) == [("2026-01-01", 1, 0, 1), ("2026-01-02", 1, 1, 0)]
    scanned = spark.read.option("recursiveFileLookup", "true").text(str(log)).filter(F.col("_metadata.file_path") > counts.agg(F.max("through")).first()[0])
    assert scanned.count() == 0


def test_wards_and_links_in_a_hot_prefecture(spark):
    """Every prefecture's own cities and labels; one prefecture has most of the rows."""
    sheet = [(1, ["c", "p", "n"])]
    for pref in ("A県", "B県"):
        sheet += [(len(sheet) + i + 1, [f"{pref}{i}", pref, name]) for i, name in enumerate(["四日市市", "四日市市場町", "四日市市北区", "市原市", "市原市北区", "大津市南区"])]
    df = spark.createDataFrame(sheet, "ordinal int, cells array<string>")
    got = [(r["prefecture"], r["city"], r["ward"]) for r in registry.wards(df).orderBy("code").collect()]
    assert got == [(p, c, w) for p in ("A県", "B県") for c, w in (("四日市市", "場町"), ("四日市市", "北区"), ("市原市", "北区"))]
    towns = spark.createDataFrame([("A県", "日立市"), ("A県", "津市"), ("B県", "日立市")], "prefecture string, municipality string")
    links = spark.createDataFrame([("A県", i, label, f"http://h{i}/x") for i, label in enumerate(["日立の市役所", "津の海", "津市公式", "日立市 津市", "other"] * 20)], "prefecture string, rank int, label string, url string")
    found = sites.linked_candidates(towns, links)
    assert {(r["prefecture"], r["municipality"], r["n"]) for r in found.groupBy("prefecture", "municipality").agg(F.count("*").alias("n")).collect()} == {("A県", "日立市", 40), ("A県", "津市", 40)}
