"""Rule packs: the fixed values that results depend on. Patterns are for Java's regular expressions (Column code)
or Python's (names ending in _PY); callers pass other packs for other languages."""

from __future__ import annotations

import re

# Name keys ---------------------------------------------------------------------------------------
NUMERALS = "0-9０-９一二三四五六七八九十百"
KEY_READING = r"(?U)[（(]\s*[ぁ-ゖァ-ヺー\s]+\s*[)）]"
KEY_LEAD_DATE = (
    r"(?U)^(?:[0-9０-９]{1,2}月(?:[0-9０-９]{1,2}日)?(?:[（(][^）)]*[）)])?"
    r"|[0-9０-９]{1,2}[/／.][0-9０-９]{1,2}|[0-9０-９]{1,2}日(?:[（(][^）)]*[）)])?)\s*"
)
KEY_ROUND = rf"(?U)第\s*[{NUMERALS}]+\s*回\s*"
KEY_YEAR = r"(?U)(?:令和|平成|R|H)\s*[0-9０-９]+(?:[（(]20\d\d[）)])?\s*年?度?|20\d\d\s*年?度?"
KEY_DROP = r"(?U)[\s　・,、。!！?？'\"()（）「」【】〜～~]"
KEY_SAME = (("祭り", "祭"), ("まつり", "祭"))
MERGE_LEAD = r"(?U)^[○●■□◆◇▲△★☆※\-–—\s]+"
MERGE_WRAP = r"^[^（(]{0,12}[（(]([^）)]{4,})[）)]$"
MERGE_YEAR = r"(?U)^(?:令和|平成)?\s*[0-9０-９]{1,4}\s*(?:年度?)?"
STRONG_DECOR = (
    r"(?U)(?:令和|平成|R|H)\s?\d+年?度?|20\d\d年?度?"
    r"|第\s?[0-9０-９一二三四五六七八九十百]+回"
    r"|^[0-9０-９]{1,2}月(?:[0-9０-９]{1,2}日)?(?:[（(][^）)]*[）)])?"
    r"|^[0-9０-９]{1,2}/[0-9０-９]{1,2}"
    r"|【[^】]*(?:指定|登録|選択|文化財)[^】]*】"
    r"|[（(][^）)]*(?:指定|登録|選択|文化財)[^）)]*[）)]"
    r"|(?:保存会|愛好会|同好会|連合会|振興会)$"
)
NOVELTY_LEAD = r"(?U)第\s*[0-9０-９一二三四五六七八九十百]+\s*回|令和\s*[0-9０-９]+\s*年度?|平成\s*[0-9０-９]+\s*年度?|[0-9０-９]{4}\s*年度?"
NOVELTY_DROP = r"(?U)[\s　・･。、,，.．\-‐-―–—~〜～!！?？'\"“”’]"
NOVELTY_TAIL = r"(まつり|マツリ|祭り|祭)$"
MUNICIPAL_SUFFIX = "[市町村区]$"

# Dates -------------------------------------------------------------------------------------------
RECURRING = r"(?U)毎年|例年|第\s*[0-9０-９一二三四五六七八九]|旧暦|上旬|中旬|下旬|春季|夏季|秋季|冬季|[月火水木金土日]曜"
RECURRING_DATE = r"(?U)[月火水木金土日]曜|\d{1,2}\s*月|上旬|中旬|下旬|旧暦|[春夏秋冬]季"
SPECIFIC_YEAR = r"(?U)令和\s*\d+\s*年|平成\s*\d+\s*年|\d{4}\s*年"
BARE_DATE = r"(?U)\d{1,2}\s*月(\s*\d{1,2}\s*日)?"
NOTE_YEAR = "情報源に特定年の日付として記載: "
NOTE_NO_DATE = "例年の語はあるが日付が特定できない: "
NOTE_BARE = "特定年の日程か例年の規則かは未確認: "
NOTE_OTHER = "日付表記を判別できず: "
DATE_HINT = r"(?U)毎年|例年|第\s*[0-9０-９一二三四五六七八九]|旧暦|上旬|中旬|下旬|[月火水木金土日]曜"

# Categories, in order ----------------------------------------------------------------------------
CATEGORIES = (
    ("shrine_festival", "神社|神宮|八幡宮|八幡|稲荷|大社|天満宮|東照宮|祇園|例大祭|祭礼"),
    ("temple_festival", "寺|観音|大師|不動尊|地蔵|薬師|開帳|法要|縁日"),
    ("fireworks", "花火"),
    ("bon_odori", "盆踊"),
    ("lion_dance", "獅子舞|ささら獅子"),
    ("traditional_performing_art", "ささら|田楽|神楽|風流|囃子|ばやし|太鼓|万灯|巫女舞|奉納相撲|人形"),
    ("dashi", "山車|曳山|屋台|鉾"),
    ("mikoshi", "神輿|みこし"),
    ("ichi_fair", "達磨市|だるま市|骨董市|植木市|朝市|大市"),
    ("citizen_festival", "市民祭|市民まつり|ふるさとまつり|フェスティバル|フェスタ|産業祭|商工祭"),
    (
        "seasonal_flower_nature",
        "桜|さくら|梅|藤|つつじ|ぼたん|牡丹|菖蒲|あやめ|紫陽花|あじさい|朝顔|ほおずき|風鈴|七夕|紅葉|もみじ|雪|氷|雛|ひなまつり|鯉のぼり|"
        "菊|萩|蓮|ホタル|ほたる|コスモス|ひまわり|チューリップ|ゆり|ラベンダー",
    ),
    ("fire_festival", "火祭|柴燈|どんど焼|どんと祭|松明"),
    ("dance", "踊り|おどり|よさこい|阿波踊"),
)

# What a candidate name must and must not hold ----------------------------------------------------
FESTIVAL = (
    "祭|まつり|マツリ|大祭|例大祭|祭礼|縁日|花火大会|盆踊り|盆踊|囃子|ばやし|獅子舞|ささら|田楽|神楽|風流|万灯|燈籠|灯籠|"
    "山車|神輿|みこし|曳山|屋台|山鉾|鉾曳|奉納|渡御|行列|パレード|どんど焼き|どんと祭|裸祭|火渡|柴燈|梯子乗|太鼓|踊り|おどり|"
    "フェスティバル|フェスタ|カーニバル|大道芸|人形浄瑠璃|綱火|盆綱|わらじ|流鏑馬|献灯|燈明|"
    "鯉のぼり|こいのぼり|鯉幟|流し雛|ひなまつり|雛まつり|ひな祭|七夕|たなばた|どんど|とんど|大凧|凧揚げ|凧あげ|キャンドルナイト|"
    "かかしコンテスト|竹あかり|送り火|迎え火|精霊流し|精霊送り|灯籠流し|虫送り"
)
SEASONAL = (
    "桜|さくら|梅|うめ|桃|藤|つつじ|ツツジ|ぼたん|牡丹|菖蒲|あやめ|紫陽花|あじさい|朝顔|ほおずき|風鈴|七夕|紅葉|もみじ|雪|氷|"
    "ひなまつり|雛|こいのぼり|鯉のぼり|菊|萩|蓮|ホタル|ほたる|いちょう|コスモス|ひまわり|チューリップ|ゆり|ラベンダー"
)
SEASONAL_EVENT = "祭|まつり|展|会|ウィーク"
MARKET = "朝市|大市|達磨市|だるま市|骨董市|植木市|六斎市|楽市"
EXCLUDED = (
    "申請|届出|手続|募集要項|入札|契約|採用|職員|議会|条例|例規|予防接種|健診|検診|相談会|説明会|講座|教室|セミナー|研修|"
    "ごみ|廃棄物|下水|上水|工事|通行止|休館|閉館|開館時間|休業|納税|課税|保険料|年金|補助金|給付金|助成|証明書|マイナンバー|"
    "避難|防災訓練|不審者|注意報|警報|感染症|ワクチン|結果|中止のお知らせ$|アンケート|パブリックコメント|議事録|要綱|規則|計画書|報告書|answers?|検索結果"
)
NOT_A_NAME = (
    r"[。、！？]|\.(?:pdf|PDF|xlsx?|docx?|jpe?g|png)\b|チラシ|ちらし|ポスター|申込書|"
    r"(?:です|ます|ました|います|ください|しています|について|に関する)$|"
    r"を[ぁ-ん一-龥々]{1,6}(?:る|う|く|す|つ|ぬ|ぶ|む|ます|した|する|なく)$|"
    r"お問い合わせ|ご案内|詳しくは|こちら|ホームページ|公式サイト|募集|選挙|委員会|協議会|審議会|懇談会|推進|計画|方針|"
    r"公民館 |センター で|▼|祝祭日|祭日|祝日|休祭日|葬祭|冠婚|公募|作品募集|掲載|更新$|開会式|閉会式|表彰式|"
    r"^(?:お|御)?(?:祭り|まつり|祭|祭典|祭礼|例祭|例大祭|大祭|夏祭り|秋祭り|春祭り|花火大会|花火|イベント|フェスティバル|フェスタ|前夜祭|正月行事|"
    r"年中行事|伝統行事|郷土芸能|民俗芸能|文化祭|市民祭|区民祭|夏まつり|秋まつり|春まつり|納涼祭|収穫祭|感謝祭|産業祭|祭り・祭礼|祭礼行事)$|"
    r"(?:に伝わる|に行われる|が行われる|で行われる|に開催される|が開催される)"
)
NAV_LABEL = (
    r"^(?:観光|イベント|祭り?|まつり|催し|行事|文化|スポーツ|グルメ|自然|歴史|見どころ|最新|一覧|トップ|ホーム|情報)"
    r"(?:[・／/｜|,、]\s*(?:観光|イベント|祭り?|まつり|催し|行事|文化|スポーツ|グルメ|自然|歴史|見どころ|最新|一覧|トップ|ホーム|情報))+$"
)
ENUMERATED = "^(?:[^・]+・){3,}"
OFFICE_WORDS = "部門|日程$|年報|統計|市場"
JAPANESE = "[一-龥ぁ-んァ-ヶ]"
SITE_WORDS = "(?:外部|公式|ウェブ|Web|WEB|特設|申込|観光|関連)サイト|サイトマップ|サイトポリシー"
VENUE = (
    "[一-龥ぁ-んァ-ヶA-Za-z0-9ヶケヵノ]{2,12}(?:神社|神宮|八幡宮|稲荷|大社|天満宮|東照宮|寺|院|大師|観音|不動尊|公園|広場|会館|文化センター|"
    "市民会館|商店街|海岸|河川敷|球場|駅前|通り|城址|城跡|旧跡)"
)

# Designations ------------------------------------------------------------------------------------
DESIGNATION = r"(?:国|県|都|道|府|市|町|村|市町村)\s*指定"
KIND = "(?:重要)?無形民俗文化財|無形民俗|民俗芸能"
NAME_CHARS = r"[^\s「」『』（）()\[\]。、,，:：|｜/／\t]{2,30}"
PREFECTURE_WIDE = "(県全域)"

# Links -------------------------------------------------------------------------------------------
LINK_SKIP_SCHEMES = ("javascript:", "mailto:", "tel:", "#")
EVENT_LABEL = "観光|イベント|催し|行事|年間|カレンダー|歳時|季節"

# Vocabulary --------------------------------------------------------------------------------------
STOPWORDS = (
    "芸能 習俗 行事 年中行事 風俗 慣習 民俗 技術 儀礼 用具 製作 製作技術 工程 資料 文書 記録 伝承 文化 生産 生業 信仰 衣食住 人生 儀礼用具 "
    "生活 民具 collection その他 分類 名称 所在地 都道府県 行事の芸能 芸能の習俗 習俗の芸能"
).split()
SKIP_SUBCATEGORY = "生産|生業|衣食住|人生|交通|運搬|交易"
PLACE_SUFFIX = "(都|道|府|県|市|区|町|村|郡)$"

# Verdict files -----------------------------------------------------------------------------------
VERDICT_ID = r"^[0-9]{4,6}$"
VERDICT_WORD = "(?i)^(keep|drop|unsure)$"
VERDICT_READING = r"(?U)^[ぁ-んゔー・\s]+$"
VERDICT_PLACE = r"(?U)[^\s]+[市町村区]$"

# Wrapping brackets -------------------------------------------------------------------------------
BRACKETS = dict(zip("「『【《〈（([［{｛", "」』】》〉）)]］}｝", strict=True))


def compiled(pattern: str) -> re.Pattern[str]:
    """A Column pattern for Python code (Python's classes are Unicode already)."""
    return re.compile(pattern.replace("(?U)", ""))
