"""Text functions over whole tables: each order carries one of a list of inputs, and the SQL says what comes out.

The expected values are written down from the functions' specification, not computed by them. Every query reads all
orders; the input of an order is the one whose number is its key modulo their count.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote_plus

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clean, kana
from tidemark.functions import keys as K
from tidemark.functions import pages as H
from tidemark.functions import predicates as P
from tidemark.functions import rules as R
from tidemark.operators import apply, publish, registry, sites
from tidemark.sources import etiquette, sinks, tables
from tidemark.session import ship


@dataclass(frozen=True)
class Golden:
    """inputs and outputs: column names; rows: input values, then expected ones; made: the output columns."""

    inputs: str
    outputs: str
    rows: tuple[tuple, ...]
    made: Callable[..., dict[str, Column]]

    def query(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        names = self.inputs.split()
        listed = F.array(*[F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, row, strict=False)]) for row in self.rows])
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
        given = orders.withColumn("given", F.element_at(listed, (F.pmod("o_orderkey", F.lit(len(self.rows))) + 1).cast("int"))).select("o_orderkey", "given.*")
        return given.select("o_orderkey", *[c.alias(n) for n, c in self.made(*[F.col(n) for n in names]).items()])

    def sql(self) -> str:
        def text(v) -> str:
            return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

        outputs, skip = self.outputs.split(), len(self.inputs.split())
        values = ", ".join(f"({i}, {', '.join(map(text, row[skip:]))})" for i, row in enumerate(self.rows))
        return f"SELECT o_orderkey, {', '.join(outputs)} FROM orders JOIN (VALUES {values}) g(i, {', '.join(outputs)}) ON o_orderkey % {len(self.rows)} = g.i"


def _joined(f: Callable[[str], list], sign: str = "|") -> Callable[[Column], Column]:
    return clean.arrow(lambda x: sign.join(map(str, f(x))))


TABLE_PAGE = "<table><tr><th>名称</th><th>所在地</th></tr><tr><td>撞舞</td><td>龍ケ崎市上町</td></tr><tr><td>綱火</td><td>不明</td></tr></table><p>後</p>"
LIST_PAGE = "<title>県指定文化財一覧</title><table><tr><td>指定区分</td><td>名称</td></tr><tr><td>史跡</td><td>一里塚</td></tr><tr><td>無形民俗文化財</td><td>昭和33年</td><td>富田のささら</td></tr></table>"
PART_PAGE = "<h3>民俗文化財の部</h3><table><tr><td>1</td><td>上山川諏訪神社太々神楽</td><td>県</td></tr></table>"
ROW_PAGE = "<table><tr><td>市指定</td><td>無形民俗文化財</td><td>※浅川のささら</td><td>日立市</td></tr></table>"
FLAT_PAGE = "県 指定無形民俗文化財「綱火」が、撞舞（県指定無形民俗文化財）と。県指定無形民俗文化財に指定されており"
FEED = '<?xml version="1.0"?><rss><channel><item><link>/a</link><guid>http://h/b</guid></item></channel></rss>'
FEED_PAGE = '<html><head><link rel="alternate" type="application/rss+xml" href="/rss.xml"></head><a href="/atom/new">x</a><a href="/rss.xml">y</a></html>'
HITS_PAGE = '<a href="/1#x">綱火の公開</a><a href="http://else/2">綱火</a><a href="/3">お知らせ</a><a href="/4">綱火の募集</a><a href="/1">again 綱火</a>'
TOURISM = '<a href="https://www.facebook.com/x">観光協会</a><a href="https://city.lg.jp/">観光協会</a><a href="https://kanko-koga.jp/a">ナビ</a><a href="https://board.example/x"><img alt="古河市観光協会"></a>'
DIGEST_PAGE = "<html><head><title>文化財</title></head><body><nav>x</nav><h2>指定</h2><table><caption>一覧</caption><tr><td>綱火</td><td></td><td>県</td></tr></table></body></html>"

GOLDENS: dict[str, Golden] = {
    "text_fragments": Golden("fragment", "raw label cell", (
        ("<b>A</b>&amp;B", " A &B", "A&B", "A &B"), ("x<br>  y　z", "x   y　z", "x  y　z", "x y z"), ("　<i>祭</i> ", "　 祭  ", "祭", "祭"), ("&lt;祭&gt;", "<祭>", "<祭>", "<祭>"),
    ), lambda f: {"raw": H.raw_text(f), "label": H.label_text(f), "cell": H.cell_text(f)}),
    "page_titles": Golden("page", "title", (("<title> 日立市<br>の祭 &amp; 行事 </title><title>x</title>", "日立市の祭 & 行事"), ("<TITLE lang='ja'>a\nb</TITLE>", "a\nb"), ("<p>x</p>", "")), lambda p: {"title": H.page_title(p)}),
    "name_unwrapped": Golden("name", "bare", (("「綱火」", "綱火"), ("『「祭」』", "祭"), ("（綱火", "（綱火"), ("綱火）", "綱火）"), ("「a」と「b」", "a」と「b"), ("祭", "祭")), lambda n: {"bare": clean.unwrap(n)}),
    "candidate_names": Golden("raw", "name", (
        ("桜まつりを開催します！", "桜まつり"), ("第3回 日立さくらまつり｜観光サイト", "日立さくらまつり"), ("「常陸大津の御船祭」", "常陸大津の御船祭"), ("令和8年度　土浦全国花火競技大会のお知らせ", "土浦全国花火競技大会"),
        ("8月3日（土）水戸黄門まつり", "水戸黄門まつり"), ("綱火（フォトギャラリー）", "綱火"), ("8月17日更新 鉾田うまかっぺフェスタ", "鉾田うまかっぺフェスタ"), ("ひたち秋祭り「郷土芸能", "ひたち秋祭り"), ("潮来祇園祭禮 [PDF形式：120KB]", "潮来祇園祭禮"),
    ), lambda r: {"name": clean.candidate_name(r)}),
    "designation_names": Golden("raw", "name", (
        ("※浅川のささら", "浅川のささら"), ("1 舘獅子", "舘獅子"), ("（国選択） 真家みたまおどり", "真家みたまおどり"), ("綱火 所在地 つくばみらい市", "綱火"), ("県指定 無形民俗文化財 富田のささら", "富田のささら"), ("撞舞", "撞舞"),
    ), lambda r: {"name": H.designation_name(r)}),
    "display_names": Golden("name society municipality", "shown", (
        ("ユネスコ無形文化遺産・国指定重要無形民俗文化財「日立風流物」", "n", "", "日立風流物"), ("県指定 富田のささら 所在地 石岡市国府5", "n", "", "富田のささら"), ("4.塚崎の獅子舞", "n", "", "塚崎の獅子舞"),
        ("三和祇園ばやし（無形民俗文化財）", "n", "", "三和祇園ばやし"), ("新しい投稿 鉾田にぎわい祭り", "n", "", "鉾田にぎわい祭り"), ("亀城太鼓保存会", "y", "", "亀城太鼓"), ("の蛇池神社万灯流し大祭", "n", "", "蛇池神社万灯流し大祭"),
        ("のぶなが総踊り", "n", "", "のぶなが総踊り"), ("甲府市／正ノ木祭", "n", "甲府市", "正ノ木祭"), ("岩村秋まつり「神輿渡御行列", "n", "", "岩村秋まつり 神輿渡御行列"), ("祭", "n", "", "祭"),
    ), lambda n, s, m: {"shown": clean.display_name(n, s == "y", m)}),
    "merge_keys": Golden("name municipality", "k", (
        ("2025いばらきまつり", "水戸市", "いばらき祭"), ("いばらきまつり", "水戸市", "いばらき祭"), ("日立さくらまつり", "日立市", "さくら祭"), ("さくらまつり", "日立市", "さくら祭"),
        ("素鵞熊野神社（潮来祇園祭禮）", "潮来市", "祇園祭禮"), ("○潮来祇園祭禮", "潮来市", "祇園祭禮"), ("第3回土浦花火大会", "土浦市", "花火大会"),
    ), lambda n, m: {"k": K.merge_key(n, m)}),
    "strong_keys": Golden("name", "k", (
        ("羽根尾の獅子舞", "羽根尾獅子舞"), ("羽根尾獅子舞", "羽根尾獅子舞"), ("【県指定】綱火", "綱火"), ("神幸祭（初日）", "神幸祭初日"), ("還幸祭（最終日）", "還幸祭最終日"), ("亀城太鼓保存会", "亀城太鼓"), ("令和8年度 綱火（無形民俗文化財）", "綱火"),
    ), lambda n: {"k": K.strong_key(n)}),
    "comparison_keys": Golden("name", "known shown", (
        ("第３８回　ＡＢＣまつり", "abc祭", "第38回abcまつり"), ("令和8年度 土浦花火大会", "土浦花火大会", "令和8年度土浦花火大会"), ("日立・さくら祭り", "日立さくら祭", "日立・さくら祭り"), ("Ａ　ｂ C", "abc", "abc"),
    ), lambda n: {"known": K.norm_key(n), "shown": K.filter_key(n)}),
    "kana_forms": Golden("text", "hiragana wide only_kana", (
        ("ホコタ", "ほこた", "ホコタ", True), ("ラーメン", "らーめん", "ラーメン", True), ("ﾎｯｶｲﾄﾞｳ", "ﾎｯｶｲﾄﾞｳ", "ホッカイドウ", False), ("ｻｯﾎﾟﾛｼ", "ｻｯﾎﾟﾛｼ", "サッポロシ", False), ("鉾田シ", "鉾田し", "鉾田シ", False), ("ヴァ・ヶ", "ゔぁ・ゖ", "ヴァ・ヶ", True),
    ), lambda t: {"hiragana": K.hiragana(t), "wide": kana.widen_udf(t), "only_kana": K.is_kana(t)}),
    "romanised": Golden("reading", "romaji", (
        ("ひたちおおた", "hitachiota"), ("りゅうがさき", "ryugasaki"), ("れいたいさい", "reitaisai"), ("しんぶ", "shimbu"), ("にっこう", "nikko"), ("まっちゃ", "matcha"), ("ホコタ", "hokota"), ("しょうぶ", "shobu"), ("ラーメン", "ramen"), ("鉾田", None), ("", None), ("abc", None),
    ), lambda r: {"romaji": kana.romanize_udf(r)}),
    "stated_readings": Golden("name context", "reading", (
        ("潮(うしお)祭", "", None), ("撞舞（つくまい）", "", "つくまい"), ("からかさ万灯（フォトギャラリー）", "", None), ("ささら", "", "ささら"), ("撞舞", "龍ケ崎の撞舞（つくまい）です", "つくまい"), ("撞舞", "撞舞です（つくまい）", None),
    ), lambda n, c: {"reading": kana.stated_reading(n, c)}),
    "event_readings": Golden("reading name", "bare", (
        ("ししていむけいぶんかざいねぎしのうたい", "市指定無形文化財 根岸の謡", "ねぎしのうたい"), ("けんしていむけいみんぞくぶんかざいつなび", "県指定無形民俗文化財 綱火", "つなび"), ("ししまい", "獅子舞", "ししまい"),
    ), lambda r, n: {"bare": apply.event_reading(r, n)}),
    "listed_names": Golden("listed official", "name reading", (
        ("小中野囃子(こなかのばやし)", "小中野囃子", "小中野囃子", "こなかのばやし"), ("六斎念仏（鹿野）(ろくさいねんぶつ（しかの）)", "六斎念仏（鹿野）", "六斎念仏（鹿野）", "ろくさいねんぶつしかの"), ("撞舞（つくまい）", "撞?", "撞舞", "つくまい"), ("綱火", "撞舞", None, None), ("綱 火", "綱火", "綱火", ""),
    ), lambda a, b: {"name": clean.split_listed_udf(a, b)["name"], "reading": clean.split_listed_udf(a, b)["reading"]}),
    "municipality_names": Golden("name kana_text", "bare bare_kana", (
        ("鉾田市", "ホコタシ", "鉾田", "ホコタ"), ("境町", "サカイマチ", "境", "サカイ"), ("東海村", "トウカイムラ", "東海", "トウカイ"), ("北海道", "ホッカイドウ", "北海道", "ホッカイドウ"), ("市", "シ", "市", "シ"),
    ), lambda n, k: {"bare": clean.arrow(registry.bare_name)(n), "bare_kana": clean.arrow(registry.bare_kana)(k)}),
    "romaji_spellings": Golden("romaji", "forms", (("shimbu", "shimbu|shinbu"), ("ootaki", "ootaki|otaki"), ("koga", "koga"), ("jiyo", "jiyo|jo")), lambda r: {"forms": _joined(registry.spellings)(r)}),
    "designation_levels": Golden("text", "level", (
        ("国指定", "国指定"), ("重要無形民俗文化財", "国指定"), ("記録選択", "国選択"), ("県指定無形", "都道府県指定"), ("市指定", "市区町村指定"), ("未指定", "未指定"), ("", "不明"),
    ), lambda t: {"level": P.level_of(t)}),
    "page_digests": Golden("page", "digest", (
        (DIGEST_PAGE, "TITLE: 文化財\nH: 指定\n| 綱火 | 県 |\nH: 一覧"), ("<title>t</title><p>市の無形民俗文化財です</p>", "TITLE: t\n本文抜粋: t 市の無形民俗文化財です"), ("<p>x</p>", ""), ("<table><tr><td> </td></tr></table>", ""),
    ), lambda p: {"digest": clean.page_digest_udf(p)}),
    "feeds": Golden("page", "is_feed announced listed", (
        (FEED, "True", "", "http://h/a|http://h/b"), (FEED_PAGE, "False", "http://h/rss.xml|http://h/atom/new", ""), ("<?xml version='1.0'?><!DOCTYPE html><html></html>", "False", "", ""), ("<urlset><url><loc>http://h/1</loc></url></urlset>", "True", "", "http://h/1"),
    ), lambda p: {"is_feed": clean.arrow(lambda x: str(registry.is_feed(x)))(p), "announced": _joined(lambda x: registry.page_feeds(x, "http://h/"))(p), "listed": _joined(lambda x: registry.feed_links(x, "http://h/") if registry.is_feed(x) else [])(p)}),
    "absolute_addresses": Golden("base href", "url", (
        ("http://h:8080/d/e", "/a?x=1", "http://h:8080/a?x=1"), ("http://h/d/", "../b#f", "http://h/b"), ("http://h/", "//＃Jump01", ""), ("http://h/x", "", "http://h/x"), ("http://h/", "http://[", ""),
    ), lambda b, h: {"url": H.url_join(b, h)}),
    "search_addresses": Golden("prefecture municipality name", "url", tuple(
        (p, m, n, "https://www.google.com/search?q=" + quote_plus(f"{p} {m} {bare}")) for p, m, n, bare in (("茨城県", "日立市", "祭（まつり）", "祭"), ("茨城県", "潮来市", "祇園 祭禮", "祇園 祭禮"), ("北海道", "札幌市", "YOSAKOI(よさこい) 祭", "YOSAKOI 祭"))
    ), lambda p, m, n: {"url": sinks.search_address(p, m, n)}),
    "festival_reasons": Golden("name", "reason", (
        ("日立さくらまつり", "festival_word"), ("例大祭", None), ("さくら展", "seasonal"), ("朝市", "market"), ("桜の申請", None), ("パーントゥ", "regional_vocab"), ("Spring Festival", None), ("日立市", None), ("観光・イベント", None), ("A・B・C・祭", None), ("祭", None),
    ), lambda n: {"reason": P.festival_reason(n, F.lit("日立市"), F.array(F.lit("パーントゥ")))}),
    "page_dates": Golden("text", "date_text", (
        ("毎年7月第4土曜日に開催。2026年8月1日更新", "毎年7月"), ("8月15日と16日", "8月15日"), ("春季例祭", "春季"), ("2026年9月4日、第3日曜日", "第3日曜日"), ("", ""),
    ), lambda t: {"date_text": P.best_date(F.transform(F.regexp_extract_all(t, F.lit(H.DATE_ON_PAGE), F.lit(0)), K.squeeze_space))}),
    "page_venues": Golden("text name", "venue", (("日立市の神峰公園で開催", "さくらまつり", "日立市の神峰公園"), ("八坂神社例大祭は八坂神社で", "八坂神社例大祭", "八坂神社例大祭は八坂神社"), ("鹿島神宮、神峰公園", "鹿島神宮例祭", "神峰公園"), ("会場未定", "祭", "")), lambda t, n: {"venue": P.first_venue(t, n)}),
    "name_contexts": Golden("flat name", "context", (("前" * 200 + "綱火" + "後" * 200, "綱火", "前" * 160 + "綱火" + "後" * 160), ("綱火と撞舞", "撞舞", "綱火と撞舞"), ("綱火", "撞舞", "")), lambda f, n: {"context": clean.snippet(f, n)}),
    "placed_table_rows": Golden("page", "found left_over", (
        (TABLE_PAGE, "撞舞/龍ケ崎市/撞舞 龍ケ崎市上町", False), ("<table><tr><th>名称</th><th>所在地</th></tr><tr><td>祭</td><td>日立市</td></tr></table>", "", True), ("<p>撞舞</p>", "", True),
    ), lambda p: {"found": _joined(lambda x: ["/".join(r) for r in H.placed_rows(x, ["龍ケ崎市", "日立市"])[0]])(p), "left_over": F.contains(clean.arrow(lambda x: H.placed_rows(x, ["龍ケ崎市", "日立市"])[1])(p), F.lit("<table")) | ~F.contains(p, F.lit("<table"))}),
    "places_of_cells": Golden("place", "municipality", (("日立市", "日立市"), ("龍ケ崎市上町", "龍ケ崎市"), ("日立・十王", "日立市"), ("日立", "日立市"), ("-", ""), ("日立川", ""), ("", "")), lambda p: {"municipality": clean.arrow(lambda x: H.place_in(x, ["龍ケ崎市", "日立市"]))(p)}),
    "cultural_ranks": Golden("label path", "rank", (("指定文化財一覧", "/x", -1), ("一覧", "/bunkazai/", -1), ("無形民俗", "/x", 0), ("教育委員会", "/x", 4), ("ごみ", "/x", None)), lambda l, p: {"rank": P.cultural_rank(l, p, "文化財|民俗|bunkazai", "一覧|list", "教育委員会|歴史").cast("int")}),
    "page_designations": Golden("page", "found", (
        (ROW_PAGE, "市指定/無形民俗文化財/浅川のささら|市指定/無形民俗文化財/浅川のささら"), (LIST_PAGE, "県指定/無形民俗文化財/富田のささら"), (PART_PAGE, "県指定/民俗文化財/上山川諏訪神社太々神楽"), (FLAT_PAGE, "県指定/無形民俗文化財/綱火|県指定/無形民俗文化財/撞舞"), ("<p>祭</p>", ""),
    ), lambda p: {"found": _joined(lambda x: ["/".join(r) for r in H.designations(x)])(p)}),
    "telling_pages": Golden("text", "utf8 cp932", (("市の民俗芸能", True, True), ("無形の文化", True, True), ("ごみの日", False, False)), lambda t: {
        "utf8": H.telling_bytes(F.encode(t, "UTF-8")), "cp932": H.telling_bytes(F.unhex(clean.arrow(lambda x: x.encode("cp932").hex())(t)))}),
    "valid_readings": Golden("text", "reading", (("つく まい", "つくまい"), ("つく・まい。", "つくまい"), ("ツク", None), ("撞", None), ("らーめん", "らーめん")), lambda t: {"reading": P.valid_reading(t)}),
    "verified_pages": Golden("page municipality city ward", "place ward_ok tourism", (
        ("<p>日立市の観光</p>", "日立市", "大阪市", "北区", True, False, True), ("<p>日立の祭</p>", "日立市", "大阪市", "北区", True, False, False), ("大阪市／北区", "中央市", "大阪市", "北区", False, True, False), ("北区役所の観光 中央市場", "中央市", "大阪市", "北区", True, True, False),
    ), lambda p, m, c, w: {"place": registry.names_place(p, m), "ward_ok": sites.names_ward(p, c, w), "tourism": sites.names_tourism(p, m)}),
    "candidate_addresses": Golden("romaji", "first_three", (("koga", "https://www.city.koga.lg.jp/|https://www.city.koga.ibaraki.jp/|https://city.koga.lg.jp/"), ("", "")), lambda r: {"first_three": _joined(lambda x: registry.candidate_sites(x, "市", "ibaraki")[:3])(r)}),
    "ward_labels": Golden("label", "fits", (("北区", "True"), ("大阪市北区", "True"), ("北区役所", "True"), ("北区（北区役所）", "True"), ("北区（北神区役所）", "False"), ("北区民", "False")), lambda l: {"fits": clean.arrow(lambda x: str(registry.is_ward_label(x, "大阪市", "北区")))(l)}),
    "search_result_links": Golden("page", "found", ((HITS_PAGE, "綱火の公開 http://h/1"), ("<p>x</p>", "")), lambda p: {"found": _joined(lambda x: [" ".join(r) for r in registry.result_links(x, "http://h/s", "綱火", "募集")])(p)}),
    "tourism_links": Golden("page", "board", ((TOURISM, "https://board.example/"), (TOURISM.rpartition("<a")[0], "https://kanko-koga.jp/"), ("<p>x</p>", "")), lambda p: {"board": clean.arrow(lambda x: sites.tourism_site(x, "www.city.koga.lg.jp", "koga"))(p)}),
    "list_links": Golden("page", "found", (('<a href="https://www.city.koga.lg.jp/x">古河市</a><a href="https://x.com/a">X</a><a href="/own">自</a>', "古河市 https://www.city.koga.lg.jp/x"), ("", "")), lambda p: {"found": _joined(lambda x: [" ".join(r) for r in sites.outward_links(x, "pref.example")])(p)}),
    "robots_rules": Golden("robots url", "allowed", (("User-agent: *\nDisallow: /x/", "http://h/x/1", "False"), ("User-agent: *\nDisallow: /x/", "http://h/y", "True"), ("User-agent: tidemark\nDisallow: /", "http://h/y", "False"), ("", "http://h/", "True")), lambda r, u: {
        "allowed": clean.arrow(lambda x: str(etiquette.may_fetch(*x.split("\t"))))(F.concat_ws("\t", r, u))}),
    "search_result_pages": Golden("page", "found total", (
        ('<a href="/detail/1">祭</a><a href="/detail/1">大祭</a><a href="/detail/2"></a>1,234件中', "http://h/detail/1=大祭", "1234"), ("<a href='/x'>y</a>", "", "0"),
    ), lambda p: {"found": _joined(lambda x: [f"{u}={n}" for u, n in tables.search_results(x, "http://h")[0].items()])(p), "total": clean.arrow(lambda x: str(tables.search_results(x, "http://h")[1]))(p)}),
    "decoded_bodies": Golden("text charset header", "decoded encoding", (
        ("祭", "cp932", "text/html; charset=Shift_JIS", "祭", "cp932"), ("祭り", "euc_jp", "text/html; charset=euc-jp", "祭り", "euc-jp"), ("祭り", "utf-8", "", "祭り", "utf-8"), ("祭りの日", "cp932", "", "祭りの日", "cp932"),
    ), lambda t, c, h: {n: clean.arrow(lambda x, i=i: tables.decode_page(bytes.fromhex(x.split("\t")[0]), x.split("\t")[1])[i])(F.concat_ws("\t", clean.arrow(lambda x: x.split("\t")[0].encode(x.split("\t")[1]).hex())(F.concat_ws("\t", t, c)), h)) for i, n in enumerate(("decoded", "encoding"))}),
    "markdown_pages": Golden("source", "page", (
        ("# T\n- a **b**\n\n|x|y|\n|-|-|\n|1|`2`|\n", "<h1>T</h1>\n<ul>\n<li>a <strong>b</strong></li>\n</ul>\n<table><tr><th>x</th><th>y</th></tr><tr><td>1</td><td><code>2</code></td></tr></table>"), ("a [b](http://c)", '<p>a <a href="http://c">b</a></p>'),
    ), lambda s: {"page": clean.arrow(sinks.markdown)(s)}),
    "names_that_are_none": Golden("name", "kept", (("例大祭", False), ("日立祭", True), ("綱火のチラシ", False), ("公開を行います", False), ("撞舞", True)), lambda n: {"kept": ~n.rlike(R.NOT_A_NAME)}),
}


def pruned_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that pruning leaves."""
    rows = GOLDENS["names_that_are_none"]
    listed = F.array(*[F.lit(r[0]) for r in rows.rows])
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.element_at(listed, (F.pmod("o_orderkey", F.lit(len(rows.rows))) + 1).cast("int")).alias("name"))
    return publish.prune(orders, "name")


PRUNED_SQL = "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN '日立祭' ELSE '撞舞' END AS name FROM orders WHERE o_orderkey % 5 IN (1, 4)"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: g.query for name, g in GOLDENS.items()} | {"pruned_names": pruned_names}


def oracles() -> dict[str, str]:
    return {name: g.sql() for name, g in GOLDENS.items()} | {"pruned_names": PRUNED_SQL}
