"""Operators whose rules are more than a query shows: the apply chain, full crawls, harvests, site finders, etiquette."""

import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

from tidemark.operators import apply, crawl, intake, publish, registry, resolve, sites
from tidemark.session import scratch, shared_root, staged
from tidemark.sources import etiquette, tables


def test_apply_chain(spark):
    rows = spark.createDataFrame(
        [
            ("00001", "茨城県", "(県全域)", "日立市の火祭", "", "", [], ["u1"], 1, "PENDING"), ("00002", "茨城県", "日立市", "亀城太鼓保存会", "", "", ["別"], ["u1", "u2"], 2, "PENDING"),
            ("00003", "茨城県", "日立市", "亀城太鼓", "", "", [], ["u3"], 1, "PENDING"), ("00004", "茨城県", "日立市", "市指定無形民俗文化財 撞舞", "", "", [], ["u4"], 1, "PENDING"),
            ("00005", "茨城県", "(県全域)", "綱火", "", "", [], ["u5"], 1, "PENDING"), ("00006", "茨城県", "日立市", "例祭", "", "", [], ["u6"], 1, "ibaraki-hitachi-reisai"), ("00007", "茨城県", "未知町", "謡", "", "", [], ["u7"], 1, "PENDING"),
            ("00008", "茨城県", "(県全域)", "広域の日立祭", "", "", [], ["u8"], 1, "PENDING"),
        ],
        "id string, prefecture string, municipality string, name string, venue string, date_note string, aliases array<string>, source_urls array<string>, source_count long, slug string",
    )
    verdicts = spark.createDataFrame(
        [
            ("00001", "keep", "folk", "", "", ""), ("00002", "keep", "organization", "", "", "きじょうだいこほぞんかい"), ("00003", "keep", "folk", "", "", ""), ("00004", "keep", "folk", "", "", "ししていむけいみんぞくぶんかざいつくまい"),
            ("00005", "keep", "folk", "", "", "つなび"), ("00006", "drop", "generic", "", "", ""), ("00007", "keep", "folk", "", "", ""), ("00008", "keep", "folk", "", "", ""),
        ],
        "id string, verdict string, reason string, alias_of string, municipality string, reading string",
    )
    registry_rows = spark.createDataFrame([("茨城県", "つくばみらい市", "綱火", 1), ("茨城県", "他市", "綱火", 2), ("茨城県", "(県全域)", "広域の日立祭", 3)], "prefecture string, municipality string, name string, ord long")
    towns = spark.createDataFrame([("茨城県", "日立市", 1), ("茨城県", "つくばみらい市", 2)], "prefecture string, municipality string, ord int")
    romaji = spark.createDataFrame([("茨城県", "日立市", "ibaraki", "hitachi"), ("茨城県", "つくばみらい市", "ibaraki", "tsukubamirai")], "prefecture string, municipality string, pref_romaji string, muni_romaji string")
    got = {r["id"]: r for r in apply.apply_verdicts(rows, verdicts, apply.designated_places([registry_rows]), towns, romaji).collect()}
    assert got["00001"]["municipality"] == "日立市" and got["00005"]["municipality"] == "つくばみらい市" and got["00008"]["municipality"] == "(県全域)"
    assert got["00002"]["name"] == "亀城太鼓" and got["00002"]["aliases"] == ["別", "亀城太鼓保存会"] and got["00002"]["slug"] == "ibaraki-hitachi-kijodaiko"
    assert got["00003"]["s4_alias_of"] == "00002" and got["00003"]["slug"] == "" and got["00002"]["source_urls"] == ["u1", "u2", "u3"] and got["00002"]["source_count"] == 3
    assert got["00004"]["name"] == "撞舞" and got["00004"]["slug"] == "ibaraki-hitachi-tsukumai"
    assert got["00005"]["slug"] == "ibaraki-tsukubamirai-tsunabi" and got["00006"]["slug"] == "" and got["00007"]["slug"] == "PENDING"


ROW = "id string, prefecture string, municipality string, name string, venue string, date_note string, aliases array<string>, source_urls array<string>, source_count long, slug string"
VERDICT = "id string, verdict string, reason string, alias_of string, municipality string, reading string"


def two_fuchus(spark):
    """One municipality name in two prefectures, with one festival name each."""
    rows = spark.createDataFrame(
        [("1", "東京都", "府中市", "例祭", "", "", [], ["t1"], 1, "PENDING"), ("2", "広島県", "府中市", "例祭", "", "", [], ["h1", "h2"], 2, "PENDING"), ("3", "広島県", "府中市", "例祭り", "", "", [], ["h3"], 1, "PENDING"), ("4", "広島県", "(県全域)", "神楽", "", "", [], ["h4"], 1, "PENDING")], ROW
    )
    registry_rows = spark.createDataFrame([("広島県", "府中市", "神楽", 1)], "prefecture string, municipality string, name string, ord long")
    towns = spark.createDataFrame([("東京都", "府中市", 1), ("広島県", "府中市", 1)], "prefecture string, municipality string, ord int")
    romaji = spark.createDataFrame([("東京都", "府中市", "tokyo", "fuchu"), ("広島県", "府中市", "hiroshima", "fuchu")], "prefecture string, municipality string, pref_romaji string, muni_romaji string")
    return rows, apply.designated_places([registry_rows]), towns, romaji


def test_one_municipality_name_in_two_prefectures(spark):
    rows, known, towns, romaji = two_fuchus(spark)
    verdicts = spark.createDataFrame([(str(i), "keep", "folk", "", "", "") for i in range(1, 5)], VERDICT)
    got = {r["id"]: r for r in apply.apply_verdicts(rows, verdicts, known, towns, romaji).collect()}
    assert got["1"]["slug"].startswith("tokyo-fuchu-x") and got["1"]["source_urls"] == ["t1"] and got["1"]["s4_alias_of"] == ""
    assert got["2"]["slug"].startswith("hiroshima-fuchu-x") and got["2"]["source_urls"] == ["h1", "h2", "h3"] and got["3"]["s4_alias_of"] == "2"
    assert got["4"]["municipality"] == "府中市" and got["4"]["slug"].startswith("hiroshima-fuchu-x")


def test_drift_and_strange_answers_stop_the_chain(spark):
    rows, known, towns, romaji = two_fuchus(spark)
    verdicts = spark.createDataFrame([(str(i), "keep", "folk", "", "", "") for i in range(1, 5)], VERDICT)
    shown = rows.select("id", "municipality", "name")
    apply.apply_verdicts(rows, verdicts, known, towns, romaji, index=shown)
    for index in (shown.withColumn("name", F.when(F.col("id") == "2", "別の祭").otherwise(F.col("name"))), shown.union(spark.createDataFrame([("9", "x", "y")], shown.schema))):
        with pytest.raises(apply.DriftError, match="1 rows differ from the index: [29]"):
            apply.apply_verdicts(rows, verdicts, known, towns, romaji, index=index)
    more = verdicts.union(spark.createDataFrame([("77", "keep", "", "", "", "")], VERDICT))
    with pytest.raises(apply.JudgmentError, match="77"):
        apply.apply_verdicts(rows, more, known, towns, romaji)


def test_problems_of_verdicts(spark):
    rows, known, towns, romaji = two_fuchus(spark)
    verdicts = spark.createDataFrame([("1", "keep", "", "2", "", ""), ("2", "maybe", "", "", "", "かな漢"), ("3", "keep", "", "3", "", ""), ("4", "keep", "", "2", "", "かぐら"), ("8", "keep", "", "", "", "")], VERDICT)
    got = sorted(map(tuple, apply.verdict_problems(rows, verdicts).collect()))
    assert got == [("1", "other_place"), ("2", "reading"), ("2", "verdict"), ("3", "self"), ("4", "not_kept"), ("8", "extra")]
    with pytest.raises(apply.JudgmentError):
        apply.apply_verdicts(rows, verdicts.filter("id < '5'"), known, towns, romaji, strict=True)
    loose = {r["id"]: (r["s4_verdict"], r["s4_alias_of"], r["slug"] != "") for r in apply.apply_verdicts(rows, verdicts.filter("id < '5'"), known, towns, romaji).collect()}
    assert loose == {"1": ("unsure", "", False), "2": ("unsure", "", False), "3": ("unsure", "", False), "4": ("unsure", "", False)}


def brute_gazetteer(members, edges, roots, follow):
    out = {}
    for pref in sorted({p for p, _, _ in roots}):
        seen = set()

        def walk(category, depth):
            if depth > 2 or category in seen:
                return
            seen.add(category)
            for _, title, _ in sorted((m for m in members if m[0] == category), key=lambda m: m[2]):
                if not title.startswith("Template:"):
                    out.setdefault((pref, title), category)  # noqa: B023
            for _, child, _ in sorted((e for e in edges if e[0] == category), key=lambda e: e[2]) if depth < 2 else ():
                if follow in child:
                    walk(child, depth + 1)

        for _, category, _ in sorted((r for r in roots if r[0] == pref), key=lambda r: r[2]):
            walk(category, 0)
    return sorted((p, t, c.removeprefix("Category:")) for (p, t), c in out.items())


@pytest.mark.parametrize("seed", range(4))
def test_gazetteer_against_a_walk(spark, seed):
    rnd = random.Random(seed)
    names = [f"Category:{'祭' if i % 4 else 'x'}{i}" for i in range(12)]
    edges = [(a, b, i) for i, (a, b) in enumerate((rnd.choice(names), rnd.choice(names)) for _ in range(40))]
    roots = [(p, n, i) for p in ("A", "B") for i, n in enumerate(rnd.sample(names, 3))]
    members = [(rnd.choice(names), rnd.choice(["Template:祭", "a b", "c/d*~", "祭 り"]) + str(rnd.randrange(25)), i) for i in range(150)]
    got = crawl.gazetteer(spark.createDataFrame(members, "category string, title string, ord int"), spark.createDataFrame(edges, "parent string, child string, ord int"), spark.createDataFrame(roots, "prefecture string, category string, ord int"))
    rows = got.collect()
    assert sorted((r["prefecture"], r["name"], r["category"]) for r in rows) == brute_gazetteer(members, edges, roots, "祭")
    assert all(r["url"] == "https://ja.wikipedia.org/wiki/" + urllib.parse.quote(r["name"].replace(" ", "_")) for r in rows)


def test_residue_goes_on_after_a_stop(spark):
    rnd = random.Random(3)
    pages = [(f"h{rnd.randrange(30):02d}", f"u{i % 180}", i, rnd.choice(["祭", "-"]) + "d" * rnd.choice([1, 200])) for i in range(400)]
    df = spark.createDataFrame(pages, "host string, url string, ord int, text string")
    hosts = spark.createDataFrame([(f"h{i:02d}", "P", f"m{i}") for i in range(27)], "host string, prefecture string, municipality string")
    some = spark.createDataFrame([(f"u{i}",) for i in range(0, 180, 7)], "url string")

    def run(limit, **more):
        out = intake.residue(df, hosts, some, F.col("text").startswith("祭"), F.col("text"), per_host=2, limit=limit, **more)
        return sorted((r["host"], r["url"]) for r in out.collect())

    first = {}
    for host, url, at, text in sorted(pages):
        if text[0] == "祭" and len(text) >= 120 and host < "h27" and int(url[1:]) % 7:
            first.setdefault(url, (host, at))
    by_host = {}
    for url, (host, at) in sorted(first.items(), key=lambda x: (x[1][0], x[1][1])):
        by_host.setdefault(host, []).append(url)
    want = [(h, u) for h in sorted(by_host) for u in by_host[h][:2]]
    for limit in (0, 1, 7, 8, 1000):
        assert run(limit) == sorted(want[:limit])
    stopped = run(8)
    done = spark.createDataFrame([(h,) for h in {h for h, _ in stopped}], "host string")
    assert all(h not in {x for x, _ in stopped} for h, _ in run(20, done=done, have=8)) and len(run(20, done=done, have=8)) == min(12, len([1 for h, _ in want if h not in {x for x, _ in stopped}]))


def test_merge_actions(spark):
    judged = "slug string, name string, aliases array<string>, prefecture string, municipality string, venue string, usual_schedule string, date_note string, categories array<string>, source_urls array<string>, s4_reason string, s4_verdict string, s4_alias_of string"
    row = lambda slug, name, pref="県", verdict="keep", alias="", muni="町", urls=("u",), reason="": (slug, name, ["別", name, ""], pref, muni, "", "", "", [], list(urls), reason, verdict, alias)
    old = publish.build_records(spark.createDataFrame([row("a-b-matsuri", "祭"), row("a-b-x12345678", "神楽"), row("a-b-hand", "手作り"), row("o-p-q", "他県祭", "他県")], judged), "2026-01-01")
    old = old.withColumn("notes", F.when(F.col("id") == "a-b-hand", "").otherwise(F.col("notes")))
    new = spark.createDataFrame(
        [row("a-b-matsuri", "祭", urls=("v", "w")), row("PENDING", "未定"), row("PENDING", "未定2"), row("a-b-new", "手作り"), row("a-b-hand", "別物"), row("a-b-c", "獅子舞", reason="organization"), row("a-b-drop", "x", verdict="drop"), row("a-b-al", "y", alias="1"), row("z", "z", "他県")], judged
    )
    table, actions = publish.merge(old, new, "県", "2026-02-02", replace=True)
    got = sorted((r["action"], r["rule"], r["id"]) for r in actions.collect())
    assert got == [
        ("added", "new", "a-b-c"), ("added", "new", "a-b-matsuri"), ("blocked", "id", "a-b-hand"), ("blocked", "name", "a-b-new"), ("kept", "curated", "a-b-hand"), ("kept", "other_prefecture", "o-p-q"),
        ("removed", "pipeline", "a-b-x12345678"), ("replaced", "same_id", "a-b-matsuri"), ("withheld", "pending", "PENDING"), ("withheld", "pending", "PENDING"),
    ]
    after = {r["id"]: r for r in table.collect()}
    assert set(after) == {"a-b-c", "a-b-matsuri", "a-b-hand", "o-p-q"} and table.schema == tables.RECORDS
    made = after["a-b-matsuri"]
    assert [s["url"] for s in made["sources"]] == ["v", "w"] and made["sources"][0]["supports"] == ["name_mentioned"] and made["aliases"] == ["別"] and made["categories"] == ["unclassified"] and made["venue"] is None
    assert made["scale"]["other"] == [] and made["scale"]["floats"] is None and made["event_dates"] == [] and made["cultural_property"] is None
    assert publish.SOCIETY_NOTE in after["a-b-c"]["notes"] and publish.HASH_NOTE not in after["a-b-c"]["notes"]
    with pytest.raises(publish.PublishError, match="replace or to add"):
        publish.merge(old, new, "県", "2026-02-02")
    table, actions = publish.merge(old, new, "県", "2026-02-02", replace=False)
    assert {r["id"] for r in table.collect()} == {"a-b-matsuri", "a-b-x12345678", "a-b-hand", "o-p-q", "a-b-c"}
    for bad in (row("o-p-q", "衝突"), row("a-b-q", "無源", urls=())):
        with pytest.raises(publish.PublishError):
            publish.merge(old, new.union(spark.createDataFrame([bad], judged)), "県", "2026-02-02", replace=True)


def test_full_crawl():
    stored = {
        "http://a/": crawl.Stored("http://b/home", links=[("http://b/x", 5, None), ("http://b/fest", 0, None), ("http://c/out", 0, None), ("http://b/f.pdf", 0, None)], feeds=["http://a/rss"]),
        "http://a/rss": crawl.Stored(feed=True, links=[(f"http://a/item{i}", 1, None) for i in range(300)]),
        "http://b/fest": crawl.Stored(links=[("http://b/deep", 5, 0)]), "http://b/x": crawl.Stored(), "http://a/item0": crawl.Stored(), "http://a/item299": crawl.Stored(), "http://b/deep": crawl.Stored(links=[("http://b/deeper", 5, -1)]), "http://b/deeper": crawl.Stored(),
    }
    got = crawl.discover(stored, ["http://a/"], budget=3)
    assert [(u, k) for _, u, _, k, _ in got] == [("http://b/home", "seed"), ("http://a/rss", "feed"), ("http://b/fest", "index")]
    assert "http://c/out" not in [x[2] for x in crawl.discover(stored, ["http://a/"])]
    every = [x[2] for x in crawl.discover(stored, ["http://a/"], budget=400)]
    assert "http://a/item0" in every and "http://a/item299" not in every
    with_lens = crawl.discover(stored, ["http://a/"], budget=3, cultural=2)
    assert with_lens[:3] == got and [x[3] for x in with_lens[3:]] == ["cultural", "cultural"] and [x[2] for x in with_lens[3:]] == ["http://b/deep", "http://b/deeper"]
    scoped = {"http://a/w/": crawl.Stored(links=[("http://a/w/1", 5, None), ("http://a/c1/w/2", 5, None), ("http://a/z", 5, None)]), "http://a/w/1": crawl.Stored(), "http://a/c1/w/2": crawl.Stored(), "http://a/z": crawl.Stored()}
    assert [x[2] for x in crawl.discover(scoped, ["http://a/w/"], scope="http://a/w/")] == ["http://a/w/", "http://a/w/1", "http://a/c1/w/2"]


def test_a_full_queue_drops_its_worst():
    queue = crawl.Frontier(2)
    for i, priority in enumerate((5, 1, 3)):
        queue.push(f"u{i}", 0, "index", priority)
    assert [queue.pop()[1] for _ in range(2)] == ["u1", "u2"]


def test_harvest_pages_through_a_form():
    tokens, asked = iter(["t1", "t2"]), []

    def post(fields):
        asked.append((fields["token"], fields["page"]))
        if fields == {"token": "t1", "page": "2"}:
            return 403, ""
        return 200, fields["page"]

    rows = {"1": {"a": "1"}, "2": {"b": "2"}, "3": {"a": "again"}}
    assert etiquette.harvest(post, lambda: next(tokens), lambda page: rows[page]) == {"a": "1", "b": "2"}
    assert asked == [("t1", "1"), ("t1", "2"), ("t2", "2"), ("t2", "3")]
    cache, calls = {"u": b"old"}, []
    fetch = lambda url: calls.append(url) or b"new"
    assert dict(etiquette.stored_once(fetch, cache, ["u", "v"])) == {"u": b"old", "v": b"new"} and calls == ["v"]
    assert dict(etiquette.stored_once(fetch, cache, ["u"], force=True)) == {"u": b"new"}
    assert etiquette.session_token('<input type="hidden" name="csrf_token" value="x9">') == "x9" and etiquette.session_token("") == ""


def test_connections_are_verified():
    import ssl

    context = etiquette.tls_context()
    assert context.verify_mode == ssl.CERT_REQUIRED and context.check_hostname


def test_tourist_boards_and_link_lists():
    pages = {
        "http://t/": '<a href="/kanko">観光</a><a href="/x">ごみ</a><a href="/list">市町村一覧</a>', "http://t/kanko": '<a href="https://board.example/x">市観光協会</a>',
        "http://t/list": '<a href="https://www.city.koga.lg.jp/">古河市</a>',
    }
    assert sites.find_tourism(pages, "http://t/") == "https://board.example/" and sites.find_tourism(pages, "http://none/") == ""
    assert sites.link_index(pages, "http://t/") == [("古河市", "https://www.city.koga.lg.jp/")]
    assert sites.tourism_candidates("koga")[:3] == ["https://www.koga-kankou.jp/", "http://www.koga-kankou.jp/", "https://koga-kankou.jp/"] and sites.tourism_candidates("") == []
    assert registry.scope_of("http://h/w/index.html") == "http://h/w/"


def test_lists_that_do_not_run_side_by_side(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "i int, a string")
    with pytest.raises(resolve.ZipError):
        resolve.zip_checked(a, a.limit(1).toDF("j", "b"), "i", "j", F.col("a") == F.col("b"))
    with pytest.raises(resolve.ZipError):
        resolve.zip_checked(a, spark.createDataFrame([(1, "x"), (2, "z")], "j int, b string"), "i", "j", F.col("a") == F.col("b"))


def test_cycles_behind_long_chains(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, 1001), (1001, 1002), (1002, 1000), (2000, 1000)]
    got = {r["v"] for r in resolve.cycles(spark.createDataFrame(edges, "v long, to long"), "v", "to").collect()}
    assert got == {1000, 1001, 1002, 2000}
    assert resolve.cycles(spark.createDataFrame([], "v long, to long"), "v", "to").count() == 0


def test_unanswered_pages_and_readings_to_ask(spark):
    pages = spark.createDataFrame([("a", "p", "m", "u"), ("b", "p", "m", "v")], "page_id string, prefecture string, municipality string, url string")
    judged = intake.judged_designations(spark.createDataFrame([(["a", "NONE", "NONE", "NONE"],), (["b"],)], "cells array<string>"), pages)
    assert [r["page_id"] for r in intake.unanswered(pages, judged).collect()] == ["b"]
    verdicts = spark.createDataFrame([("1", "keep", None), ("2", "keep", "つなび"), ("3", "drop", "")], "id string, verdict string, reading string")
    assert [r["id"] for r in intake.rows_without_reading(verdicts).collect()] == ["1"]
    order = spark.createDataFrame([("b",), ("a",), ("z",)], "v string")
    assert [r["v"] for r in intake.in_listed_order(order, "v", ["a", "b"]).collect()] == ["a", "b", "z"]


def test_scratch_tables_go(spark):
    with scratch(spark, "kept"):
        out = staged(staged(spark.range(5), "passing").filter("id > 1"), "kept-result")
    assert out.count() == 3
    listing = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/tidemark")
    names = [f.getPath().getName() for f in listing.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(listing)]
    assert any(n.startswith("kept-result") for n in names) and not any(n.startswith("passing") for n in names)


def test_ward_candidates_against_a_loop(spark):
    rnd = random.Random(6)
    tops = {"大阪市": "http://osaka.jp/top/", "堺市": "http://sakai.jp/"}
    wards = [("a", "P", "大阪市", "北区", "kita"), ("b", "P", "大阪市", "中央区", "chuo"), ("c", "P", "堺市", "北区", "kita"), ("d", "P", "堺市", "堺区", "")]
    shapes = ("{w}", "{c}{w}", "{w}役所", "{w}ホームページ", "{w}（{w}役所）", "{w}（北神区役所）", "{w}(x)", "{w}案内")
    links = [(c, i, rnd.choice(shapes).format(w=rnd.choice(["北区", "中央区", "堺区"]), c=c), rnd.choice(["http://osaka.jp", "http://sakai.jp", "http://x.jp"]) + rnd.choice(["/kita/", "/a/b/c/p.html", "/a/chuo/", "/q.html", "/a/b/"])) for c in tops for i in range(60)]
    for keep in (120, 8, 3, 0):
        some = rnd.sample(links, keep)
        got = {}
        frame = lambda rows, schema: spark.createDataFrame(rows, schema)
        out = sites.ward_candidates(
            frame(wards, "code string, prefecture string, city string, ward string, romaji string"), frame([("P", c, t) for c, t in tops.items()], "prefecture string, city string, top string"),
            frame([("P", c, i, label, u) for c, i, label, u in some], "prefecture string, city string, ord long, label string, url string"),
        )
        for r in out.orderBy("rank").collect():
            got.setdefault(r["code"], []).append(r["url"])
        for code, _, city, ward, romaji in wards:
            top = tops[city]
            depth = lambda u: registry.scope_of(u).split("/", 3)[3].strip("/").count("/") + bool(registry.scope_of(u).split("/", 3)[3].strip("/"))
            mine = [u for c, _, label, u in sorted(some, key=lambda x: x[1]) if c == city and registry.is_ward_label(label, city, ward) and u.split("/")[2] == top.split("/")[2]]
            mine.sort(key=lambda u: (not (romaji and romaji in u), depth(u)))
            base = "/".join(top.split("/")[:3])
            guesses = [f"{base}/{romaji}/", f"{base}/{romaji}ku/"] if romaji else []
            want = guesses + mine if mine and depth(mine[0]) >= 3 else mine + guesses
            assert got.get(code, []) == list(dict.fromkeys(want)), (code, keep)
