import pytest
from pyspark.sql import functions as F

from tidemark.operators import registry as R


def test_municipality_rows(spark):
    sheet = spark.createDataFrame([(0, ["団体コード"]), (1, ["082023", "茨城県", "日立市", "ｲﾊﾞﾗｷｹﾝ", "ﾋﾀﾁｼ"]), (2, ["080004", "茨城県", "", "ｲﾊﾞﾗｷｹﾝ"]), (3, ["402311", "福岡県フクオカケン", "那珂川市ナカガワシ", "ﾌｸｵｶｹﾝ", "ﾅｶｶﾞﾜｼ"])], "ordinal int, cells array<string>")
    got = {r["municipality"]: r for r in R.municipalities(sheet).collect()}
    assert set(got) == {"日立市", "那珂川市"}
    assert (got["日立市"]["type"], got["日立市"]["pref_romaji"], got["日立市"]["muni_romaji"]) == ("市", "ibaraki", "hitachi")
    assert got["那珂川市"]["prefecture"] == "福岡県" and got["那珂川市"]["muni_romaji"] == "nakagawa"


def test_wards(spark):
    sheet = spark.createDataFrame([(i, c) for i, c in enumerate([["h"], ["1", "大阪府", "大阪市"], ["2", "大阪府", "大阪市北区"], ["3", "大阪府", "堺市北区"], ["4", "大阪府", "堺市"], ["5", "大阪府", "堺市北区"], ["", "", ""]])], "ordinal int, cells array<string>")
    assert sorted(map(tuple, R.wards(sheet).collect())) == [("2", "大阪府", "大阪市", "北区"), ("5", "大阪府", "堺市", "北区")]


def test_spellings_and_sites():
    assert R.spellings("hiroo") == ["hiroo", "hiro"] and R.spellings("riyuuou")[:2] == ["riyuuou", "ryuuou"] and "shinbu" in R.spellings("shimbu")
    sites = R.candidate_sites("kasama", "市", "ibaraki")
    assert sites[0] == "https://www.city.kasama.lg.jp/" and "https://www.city.ibaraki-kasama.lg.jp/" in sites and "https://www.city.kasama.ibaraki.jp/" in sites
    assert len(sites) == len(set(sites)) and sites.index("http://www.city.kasama.lg.jp/") == len(sites) // 2
    assert R.candidate_sites("", "市", "x") == [] and R.candidate_sites("a", "?", "x") == []


@pytest.mark.parametrize("label,good", [("北区", True), ("大阪市北区", True), ("北区役所", True), ("北区（北区役所）", True), ("北区（北神区役所）", False), ("都北区", False)])
def test_ward_labels(label, good):
    assert R.is_ward_label(label, "大阪市", "北区") is good


def test_feeds_and_links():
    assert R.is_feed("<?xml version='1.0'?><rss></rss>") and not R.is_feed("<?xml version='1.0'?><!DOCTYPE html><html><feed>")
    assert R.feed_links("<rss><item><link>/a</link><guid>http://h/g</guid></item></rss>", "http://h/") == ["http://h/a", "http://h/g"] and R.feed_links("<rss", "http://h/") == []
    assert R.page_feeds('<link type="application/rss+xml" href="/r.xml"><a href="/feed/">f</a><a href="/x">x</a>', "http://h/") == ["http://h/r.xml", "http://h/feed/"]
    assert R.result_links('<a href="/1">祭の一覧</a><a href="/1">祭</a><a href="http://o/2">祭</a><a href="/3">入札と祭</a>', "http://h/", "祭", "入札") == [("祭の一覧", "http://h/1")]
    assert R.scope_of("http://h/kita/index.html?x=1") == "http://h/kita/" and R.scope_of("http://h") == "http://h/"


def test_first_verified(spark):
    df = spark.createDataFrame([("a", "u2", 2, "<p>日立市</p>"), ("a", "u1", 1, "nothing"), ("a", "u3", 3, "日立 "), ("b", "v", 1, "")], "k string, url string, rank int, body string")
    got = R.first_verified(df, ["k"], "url", "rank", R.names_place(F.col("body"), F.lit("日立市")))
    assert sorted(map(tuple, got.collect())) == [("a", "u2", "yes"), ("b", "", "no")]


def test_leaks(tmp_path):
    (tmp_path / "a.py").write_text('"""gold.tsv"""\nx = "read gold.tsv"\ny = "fine"  # gold.tsv\n')
    (tmp_path / "ok.py").write_text('x = "gold.tsv"\n')
    assert R.leaks(tmp_path, ("gold.tsv",), frozenset({"ok.py"})) == [("a.py", 2, "read gold.tsv")]
