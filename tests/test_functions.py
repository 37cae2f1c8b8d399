import html
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import clean, kana, keys, predicates, rulepack
from tidemark.functions import pages as H
from tidemark.sources import tables


@pytest.mark.parametrize("reading,romaji", [
    ("ほこた", "hokota"), ("もりや", "moriya"), ("こが", "koga"), ("ひたちおおた", "hitachiota"), ("ひたちおおみや", "hitachiomiya"), ("りゅうがさき", "ryugasaki"),
    ("つくばみらい", "tsukubamirai"), ("ひたちなか", "hitachinaka"), ("かすみがうら", "kasumigaura"), ("つちうら", "tsuchiura"), ("まつり", "matsuri"), ("ぎおん", "gion"),
    ("ばやし", "bayashi"), ("ささら", "sasara"), ("れいたいさい", "reitaisai"), ("はなび", "hanabi"), ("ぼんおどり", "bonodori"), ("しんぶ", "shimbu"), ("にっこう", "nikko"),
    ("ホコタ", "hokota"), ("さっぽろ", "sapporo"), ("ちよだ", "chiyoda"), ("しょうぶ", "shobu"), ("まっちゃ", "matcha"), ("鉾田", None), ("", None), ("abc", None), (None, None),
])
def test_romanize(reading, romaji):
    assert kana.romanize(reading) == romaji


@pytest.mark.parametrize("half,full", [("ﾎｯｶｲﾄﾞｳ", "ホッカイドウ"), ("ｻｯﾎﾟﾛｼ", "サッポロシ"), ("ｵｵﾀﾞﾃｼ", "オオダテシ"), ("ﾘｭｳｶﾞｻｷｼ", "リュウガサキシ")])
def test_widen(half, full):
    assert kana.widen_katakana(half) == full


READINGS = [
    ("潮(うしお)祭", "", None), ("撞舞（つくまい）", "", "つくまい"), ("からかさ万灯（フォトギャラリー）", "", None), ("ささら", "", "ささら"), ("撞舞", "龍ケ崎の撞舞（つくまい）です", "つくまい"), ("撞舞", "撞舞です", None),
    ("撞舞", None, None), (None, "x", None), ("撞舞（つく　まい）", "", "つく　まい"), ("（つくまい）", "（つなび）", "つくまい"), ("あ い", "", "あい"), ("撞舞", "綱火、撞舞\u3000（ つく まい ）", "つくまい"), ("撞舞", "撞舞" + " " * 39 + "（つくまい）", None),
]


def test_readings(spark):
    df = spark.createDataFrame([(i, n, c) for i, (n, c, _) in enumerate(READINGS)], "i int, n string, c string")
    got = df.orderBy("i").select(kana.stated_reading(F.col("n"), F.col("c"))).collect()
    assert [r[0] for r in got] == [r for *_, r in READINGS]


SHOWN = [
    ("ユネスコ無形文化遺産・国指定重要無形民俗文化財「日立風流物」", "日立風流物", False), ("県指定 富田のささら 所在地 石岡市国府5", "富田のささら", False), ("4.塚崎の獅子舞", "塚崎の獅子舞", False),
    ("三和祇園ばやし（無形民俗文化財）", "三和祇園ばやし", False), ("新しい投稿 鉾田にぎわい祭り", "鉾田にぎわい祭り", False), ("亀城太鼓保存会", "亀城太鼓", True), ("の蛇池神社万灯流し大祭", "蛇池神社万灯流し大祭", False), ("のぶなが総踊り", "のぶなが総踊り", False),
]


def test_display_names(spark):
    df = spark.createDataFrame([(i, r, s) for i, (r, _, s) in enumerate(SHOWN)], "i int, r string, s boolean")
    out = df.orderBy("i").select(clean.display_name(F.col("r"), F.col("s"), F.lit(None).cast("string")))
    assert [r[0] for r in out.collect()] == [x for _, x, _ in SHOWN] == [clean.display_text(r, s) for r, _, s in SHOWN]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


CANDIDATES = [
    ("桜まつりを開催します！", "桜まつり"), ("第3回 日立さくらまつり｜観光サイト", "日立さくらまつり"), ("「常陸大津の御船祭」", "常陸大津の御船祭"), ("令和8年度　土浦全国花火競技大会のお知らせ", "土浦全国花火競技大会"),
    ("8月3日（土）水戸黄門まつり", "水戸黄門まつり"), ("綱火（フォトギャラリー）", "綱火"), ("8月17日更新 鉾田うまかっぺフェスタ", "鉾田うまかっぺフェスタ"), ("ひたち秋祭り「郷土芸能", "ひたち秋祭り"), ("潮来祇園祭禮 [PDF形式：120KB]", "潮来祇園祭禮"),
]


def test_candidate_names(spark):
    assert column(spark, [r for r, _ in CANDIDATES], clean.candidate_name) == [n for _, n in CANDIDATES] == [clean.CANDIDATE.text(r) for r, _ in CANDIDATES]


PIECES = (
    "祭 まつり 花火 大会 が 行われる の 開催 します 開催されます 終了 第3回 第十回 令和8年度 平成３０年 2026年 20 8月17日更新 8月3日 （土） 10:00～ NEW! Q. （春） \" 「 」 『 』 【 】 ( ) （ ） [ ] ［ ］ | ｜ : ： - ― ~ ～ 、 ・ / ／ # ＠ ※ ★ 🎆 🎆🎇 "
    "① 12 1. １２ ｖol Vol.3 vol. PDF 120KB [PDF形式：120KB] 指定 文化財 県指定 所在地 国府 市 町 日立市 日立 保存会 会 のお知らせ について ！ ? 。 $1 \\ a b \u00a0 \u3000 \x1c \x1f \n \t \u2003"
).split(" ") + [" ", "  ", "\u3000", "\n"]


def test_packs_agree_with_their_python_form(spark):
    """The compiled Column and the string form, on texts put together from what the rules look for."""
    rnd = random.Random(11)
    values = ["", " ", "「」", "a"] + ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 9))) for _ in range(1500)]
    assert column(spark, values, clean.candidate_name) == [clean.CANDIDATE.text(v) for v in values]
    assert column(spark, values, H.designation_name) == [H.DESIGNATION_NAME.text(v) for v in values]
    for place, society in (("日立市", True), ("", False), ("祭(", True)):
        got = column(spark, values, lambda c: clean.display_name(c, F.lit(society), F.lit(place)))  # noqa: B023
        assert got == [clean.display_text(v, society, place) for v in values]
    assert column(spark, [None], clean.candidate_name) == column(spark, [None], lambda c: clean.display_name(c, F.lit(True), F.lit(""))) == [None]


@pytest.mark.parametrize("pattern,text", [(r"[^\s[&&]+$", "a[&&\x1c b\n"), (r"[]a]\Z", "]a"), (r"^\s+|\S$", "\x1f\u3000x"), (r"(?i)[^]k]\d", "K٣]1x٣"), (r"a.b", "a\rb a\nb")])
def test_java_patterns(spark, pattern, text):
    step = rulepack.Sub(pattern, "$<")
    assert column(spark, [text], step.column) == [step.text(text)]
    with pytest.raises(ValueError):
        rulepack.java(r"[\S]")


def test_page_digest():
    page = "<html><head><title>文化財</title></head><body><nav>x</nav><h2>指定</h2><table><caption>一覧</caption><tr><td>綱火</td><td></td><td>県</td></tr></table></body></html>"
    assert clean.page_digest(page) == "TITLE: 文化財\nH: 指定\n| 綱火 | 県 |\nH: 一覧"
    assert clean.page_digest("<title>t</title><p>市の無形民俗文化財です</p>") == "TITLE: t\n本文抜粋: t 市の無形民俗文化財です"
    assert clean.page_digest("") == ""


def column(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(f(F.col("v"))).collect()]


def test_keys(spark):
    d = column(spark, ["東金砂神社田楽舞（ひがしかなさじんじゃでんがくまい）", "東金砂神社田楽舞", "延方相撲（鹿嶋吉田神社祭礼）", "延方相撲", "羽根尾の獅子舞", "羽根尾獅子舞", "第3回　さくらマツリ２", None], keys.dedup_key)
    assert d[0] == d[1] and d[2] != d[3] and d[4] != d[5] and d[6] == "さくら祭２" and d[7] is None
    s = column(spark, ["羽根尾の獅子舞", "羽根尾獅子舞", "神幸祭（初日）", "還幸祭（最終日）"], keys.strong_key)
    assert s[0] == s[1] and s[2] != s[3]
    m = column(spark, ["2025いばらきまつり", "2026いばらきまつり", "いばらきまつり", "さくらまつり", "日立さくらまつり", "素鵞熊野神社（潮来祇園祭禮）", "○潮来祇園祭禮"], lambda c: keys.merge_key(c, F.lit("日立市")))
    assert m[0] == m[1] == m[2] and m[3] == m[4] and m[5] == m[6]
    n = column(spark, ["第３８回　ＡＢＣまつり", "abc祭"], keys.norm_key)
    assert n[0] == n[1]


def test_dedup_key_is_idempotent(spark):
    names = ["第3回 八坂神社例大祭（れいたいさい）", "8月3日（土）花火大会", "令和8（2026）年度 夏まつり", "Rock Fes R8", "  ", "マツリ・まつり・祭り"]
    once = column(spark, names, keys.dedup_key)
    assert column(spark, once, keys.dedup_key) == once


def test_dates(spark):
    rows = column(spark, ["11月7日", "2026年9月4日", "令和8年8月28日", "毎年7月下旬", "毎年行われる祭", "", "そのうち"], predicates.classify_date)
    assert [(r["schedule"], r["note"]) for r in rows] == [
        (None, "特定年の日程か例年の規則かは未確認: 11月7日"), (None, "情報源に特定年の日付として記載: 2026年9月4日"), (None, "情報源に特定年の日付として記載: 令和8年8月28日"),
        ("毎年7月下旬", ""), (None, "例年の語はあるが日付が特定できない: 毎年行われる祭"), (None, ""), (None, "日付表記を判別できず: そのうち"),
    ]


def test_reasons(spark):
    got = column(spark, ["日立さくらまつり", "例大祭", "さくら展", "朝市", "桜の申請", "パーントゥ", "Spring Festival", "日立市"], lambda c: predicates.festival_reason(c, F.lit("日立市"), F.array(F.lit("パーントゥ"))))
    assert got == ["festival_word", None, "seasonal", "market", None, "regional_vocab", None, None]


@pytest.mark.parametrize("cells,want", [
    (["00003", "keep", "folk", "00023", "日立市"], ("keep", "folk", "00023", "日立市", "")), (["00004", "KEEP", "organization", "", "土浦市"], ("keep", "organization", "", "土浦市", "")),
    (["00007", "keep", "folk", "つなび"], ("keep", "folk", "", "", "つなび")), (["id", "verdict", "reason"], None), (["12", "keep", "folk"], None), ([], None),
])
def test_verdicts(spark, cells, want):
    got = spark.createDataFrame([(cells,)], "c array<string>").select(predicates.parse_verdict(F.col("c")).alias("v")).first()["v"]
    assert (got and tuple(got)[1:]) == want


def test_terms_and_levels(spark):
    assert column(spark, ["宮古島のパーントゥ", "小浜島の芸能", "塩屋湾のウンガミ（うんがみ）"], lambda c: F.array_join(predicates.terms_of(c, "[、，,・／/]"), "|")) == ["パーントゥ", "", "ウンガミ"]
    assert column(spark, ["国指定", "県指定", "市指定", "記録選択", "未指定", "?"], predicates.level_of) == ["国指定", "都道府県指定", "市区町村指定", "国選択", "未指定", "不明"]
    assert column(spark, ["つく まい", "ツク", "撞"], predicates.valid_reading) == ["つくまい", None, None]


def test_tables_of_places():
    page = "<table><tr><th>名称</th><th>所在地</th></tr><tr><td>撞舞</td><td>龍ケ崎市上町</td></tr><tr><td>綱火</td><td>不明</td></tr></table><p>後</p>"
    found, rest = H.placed_rows(page, ["龍ケ崎市", "日立市"])
    assert found == [("撞舞", "龍ケ崎市", "撞舞 龍ケ崎市上町")] and "撞舞" not in rest and "後" in rest
    assert H.place_in("日立・十王", ["日立市"]) == "日立市" and H.place_in("-", ["日立市"]) == ""


def test_designations():
    page = "<h2>市指定 無形民俗文化財</h2><table><tr><td>市指定</td><td>富田のささら</td></tr></table>。県指定無形民俗文化財「綱火」"
    assert H.designations(page) == [("市指定", "無形民俗文化財", "富田のささら"), ("県指定", "無形民俗文化財", "綱火")]
    listed = "<title>県指定文化財一覧</title><table><tr><td>指定区分</td><td>名称</td></tr><tr><td>史跡</td><td>石岡の一里塚</td></tr><tr><td>無形民俗文化財</td><td>昭和33年</td><td>富田のささら</td></tr></table>"
    assert H.designations(listed) == [("県指定", "無形民俗文化財", "富田のささら")]
    part = "<h3>民俗文化財の部</h3><table><tr><td>1</td><td>上山川諏訪神社太々神楽</td><td>県</td></tr></table><p>綱火（県 指定無形民俗文化財）</p>県指定無形民俗文化財に指定されており"
    assert H.designations(part) == [("県指定", "民俗文化財", "上山川諏訪神社太々神楽"), ("県指定", "無形民俗文化財", "綱火")]


def test_links_and_urls(spark):
    page = '<a href="/a?x=1">A <b>b</b></a><a href="mailto:x">m</a><a href="#top">t</a><a class="k" href="//＃Jump01">j</a>'
    rows = H.links(spark.createDataFrame([(1, page)], "id int, html string"), "id", "html")
    got = rows.select("label", H.url_join(F.lit("http://h:8080/d/e"), F.col("href"))).collect()
    assert [tuple(r) for r in got][0] == ("A b", "http://h:8080/a?x=1") and len(got) == 2
    assert column(spark, ["http://H:80/x", "", None], keys.host) == ["h:80", "", ""]


@pytest.mark.parametrize("body,header,name", [("祭".encode("cp932"), "text/html; charset=Shift_JIS", "cp932"), ("祭り".encode("euc_jp"), "text/html; charset=euc-jp", "euc-jp"), (b'<meta charset="utf-8">' + "祭".encode(), "", "utf-8"), ("祭り".encode(), "", "utf-8")])
def test_decode(body, header, name):
    text, used = tables.decode_page(body, header)
    assert "祭" in text and used == name


def test_unwrap_as_a_column(spark):
    rnd = random.Random(4)
    values = ["".join(rnd.choice("「」()（）あ ") for _ in range(rnd.randint(0, 9))) for _ in range(400)] + ["「（「" * 3 + "」）」" * 3, "「（「 祭 」）」"]
    assert column(spark, values, clean.unwrap) == [rulepack.Unwrap(clean.PAIRS).text(v) for v in values]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="「」()（）あ祭", max_size=12))
def test_unwrap_never_drops_a_lone_bracket(name):
    out = rulepack.Unwrap(clean.PAIRS).text(name)
    assert sum(map(name.count, "「（(")) - sum(map(out.count, "「（(")) == sum(map(name.count, "」）)")) - sum(map(out.count, "」）)"))


def test_split_listed():
    assert clean.split_listed("撞舞（つくまい）", "撞?") == ("撞舞", "つくまい") and clean.split_listed("綱火", "撞舞") is None


PATTERNS = (
    ("title", r"<title[^>]*>(.*?)</title>"), *((f"h{n}", rf"<h{n}[^>]*>(.*?)</h{n}>") for n in (1, 2, 3, 4)), ("anchor", r"<a\b[^>]*>(.*?)</a>"), ("table", r"<t[dh]\b[^>]*>(.*?)</t[dh]>"),
    ("feed_item", r"<(?:item|entry)\b.*?<title[^>]*>(.*?)</title>"), ("list_item", r"<li\b[^>]*>(.*?)</li>"),
)
LINK = r"""<a\b[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
MARKUP = (
    "<title> </title> <TITLE\tx> <h1> </h1> <h2\ta='1'> </h2> <a> <a\thref='x'> <a\tname=q\thref=\"y\nz\"\t> </a> </A> <article> <td> </td> <th> </th> <tdx> <li> </li> <LI> <item> </item> <entry\tx> <items> t u\t&amp;\tv < >\t "
    "<b> </b> <a\ttitle='<h1>'> <h1 <li\tclass=\"<li>\"> </li\t> <a\thref\t=\t'k'\t <titles>"
).split(" ")


def test_page_tokens_against_patterns():
    """Well-formed or not: what one pass over the tags reads is what a pattern for each kind of element finds."""
    rnd = random.Random(2)
    squeeze = lambda x: " ".join(x.split())
    bare = lambda x: squeeze(html.unescape(re.sub("<[^>]+>", " ", x)))
    for _ in range(8000):
        page = "".join(rnd.choice(MARKUP) for _ in range(rnd.randint(1, 14)))
        want = []
        for rank, (origin, pattern) in enumerate(PATTERNS):
            found = re.findall(pattern, page, re.I | re.S)
            found = found[:1] if origin == "title" else [x for x in found if len(x) < 200 and "<li" not in x] if origin == "list_item" else found
            want += [(rank, i, origin, bare(x)) for i, x in enumerate(found)]
        tokens = H.PageTokens(page)
        assert [c for c in tokens.candidates(True) if c[2] != "quoted"] == want
        assert list(tokens.links()) == [(i, href.strip(), squeeze(re.sub("<[^>]+>", " ", label))) for i, (href, label) in enumerate(re.findall(LINK, page, re.I | re.S))]
