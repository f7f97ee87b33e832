"""Fixed values of the domain: variant characters, aliases, club names, keywords and patterns.

They are facts that results depend on, so they are stated as they are. Every operator that uses a
table takes it as a parameter with these as default.
"""

# Old and variant characters with the current ones.
VARIANTS = {
    "澤": "沢", "邊": "辺", "邉": "辺", "髙": "高", "齋": "斎", "齊": "斉", "國": "国", "學": "学", "濱": "浜", "廣": "広", "德": "徳", "瀨": "瀬",
    "圓": "円", "萬": "万", "惠": "恵", "槇": "槙", "﨑": "崎", "嶋": "島", "眞": "真", "會": "会", "櫻": "桜", "澁": "渋", "彅": "薙",
}
# More of them, for matching people only.
MORE_VARIANTS = {
    "濵": "浜", "嵜": "崎", "冨": "富", "桒": "桑", "栁": "柳", "檜": "桧", "禮": "礼", "來": "来", "曾": "曽", "藝": "芸", "亞": "亜", "應": "応",
    "榮": "栄", "壽": "寿", "兒": "児", "內": "内", "步": "歩", "每": "毎", "瀧": "滝", "龍": "竜", "嶌": "島", "峯": "峰", "祿": "禄",
    "當": "当", "寬": "寛", "樂": "楽", "淸": "清", "靑": "青", "鄕": "郷", "曻": "昇", "禎": "禎", "賴": "頼", "莊": "荘", "將": "将", "獻": "献",
}
# Short school names with the full ones.
SCHOOL_ALIASES = {
    "慶大": "慶應義塾大", "関大": "関西大", "大商大": "大阪商業大", "北九州市大": "北九州市立大", "日体大": "日本体育大", "東日本国際大": "東日本国際大", "近大": "近畿大",
    "中大": "中央大", "法大": "法政大", "明大": "明治大", "立大": "立教大", "専大": "専修大", "駒大": "駒澤大", "東洋大": "東洋大", "亜大": "亜細亜大", "国学院大": "国学院大",
}
# Club spellings with their keys.
CLUB_KEYS = {
    "巨人": "giants", "読売": "giants", "読売ジャイアンツ": "giants", "読売巨人軍": "giants", "阪神": "tigers", "阪神タイガース": "tigers", "中日": "dragons", "中日ドラゴンズ": "dragons",
    "広島": "carp", "広島東洋カープ": "carp", "DeNA": "baystars", "横浜DeNA": "baystars", "横浜ＤｅＮＡ": "baystars", "横浜DeNAベイスターズ": "baystars", "横浜ＤｅＮＡベイスターズ": "baystars",
    "ヤクルト": "swallows", "東京ヤクルトスワローズ": "swallows", "西武": "lions", "埼玉西武ライオンズ": "lions", "日本ハム": "fighters", "日ハム": "fighters", "北海道日本ハムファイターズ": "fighters",
    "ロッテ": "marines", "千葉ロッテマリーンズ": "marines", "ソフトバンク": "hawks", "ソフトB": "hawks", "福岡ソフトバンク": "hawks", "福岡ソフトバンクホークス": "hawks",
    "オリックス": "buffaloes", "オリックス・バファローズ": "buffaloes", "オリックスバファローズ": "buffaloes", "楽天": "eagles", "東北楽天": "eagles", "東北楽天ゴールデンイーグルス": "eagles",
}
# Club names in the order in which a sentence is searched for them.
CLUB_NAMES = ("巨人", "阪神", "中日", "広島", "DeNA", "横浜DeNA", "ヤクルト", "西武", "日本ハム", "ロッテ", "ソフトバンク", "オリックス", "楽天")
#: The invented clubs of the test tables, by the same two tables.
TEST_CLUBS = {"ヘロンズ": "herons", "カイツ": "kites", "アンカーズ": "anchors", "コメッツ": "comets", "ランタンズ": "lanterns", "バジャーズ": "badgers", "スパローズ": "sparrows", "オッターズ": "otters", "ボルダーズ": "boulders", "タイズ": "tides", "フォックス": "foxes", "クレインズ": "cranes"}
SOURCE_PRIORITIES = {"スポニチ": 1, "スポーツ報知": 1, "日刊スポーツ": 1, "サンスポ": 1, "中日スポーツ": 1, "Yahoo!スポーツナビ": 10, "その他": 5}
#: Priorities of the outlets of the test tables: originals first, the aggregator last.
TEST_PRIORITIES = {"日刊ダイヤモンド": 1, "スポーツ汐報": 1, "東雲スポーツ": 1, "週刊ドラフト便": 1, "球春通信": 1, "まとめポータル": 10}
KANJI_NUMBERS = {"一": 1, "二": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9, "十": 10, "十一": 11, "十二": 12}
POSITIONS = {
    "投手": ("投手", "ピッチャー", "P"), "捕手": ("捕手", "キャッチャー", "C"), "内野手": ("内野手", "一塁手", "二塁手", "三塁手", "遊撃手", "ファースト", "セカンド", "サード", "ショート", "IF"),
    "外野手": ("外野手", "左翼手", "中堅手", "右翼手", "レフト", "センター", "ライト", "OF"),
}
# Keywords and patterns that mark a text.
MEETING_WORDS = ("スカウト会議", "編成会議", "ドラフト会議へ向け", "リストアップ", "上位候補", "1位候補", "指名候補", "候補選手を確認", "球団幹部")
MEETING_EVENTS = ("スカウト会議", "編成会議", "合同スカウト会議", "スカウト部長会議")
NEGATIVE = (
    "コメントはなかった|コメントはない|コメントなし|発言はなかった|発言はない|視察の記述はない|視察の記述はなかった|視察はなかった|視察はない|スカウトの具体的なコメントはなかった|具体的なコメントはなかった|"
    "7回制|７回制|7イニング制|７イニング制|意見交換会|検討会議|野球事業|取締役|新球団名|独立リーグ"
)
COUNT = "[0-9０-９]+|[一二三四五六七八九十十一十二]+"
ATTENTION = (
    "視察|集結|熱視線|スカウト陣|スカウトが訪れ|スカウト.*詰めかけ|スカウト会議|編成会議|合同スカウト会議|スカウト部長会議|スカウト.*見守|スカウト.*持参|バックネット裏.*スカウト|"
    "見守[^。\\n]{0,40}スカウト|ネット裏[^。\\n]{0,40}スカウト|スカウト[^。\\n]{0,40}ネット裏|[0-9０-９]+球団|[一二三四五六七八九十十一十二]+球団|全球団|12球団|十二球団|日米[0-9０-９]+球団|"
    "MLBスカウト|メジャースカウト|メジャー.*スカウト|米球団"
)
OFF_TOPIC = "セカンドキャリア|戦力外|引退後|進路調査|ジュニアトーナメント|特別企画|メンバー表|本塁打数"
GATHERING = "スカウト|球団|NPB|ＮＰＢ|日米|米球団"
SCOUTING = "スカウト|視察|熱視線|ドラフト|候補|プロ注目|オファー|獲得調査|リストアップ|訪れ|見守|持参|バックネット|態勢"
MAJORS = "MLB|ＭＬＢ|メジャー|大リーグ|日米"
LEAGUE = "NPB|ＮＰＢ|プロ野球|球団|スカウト|視察"
PERSONS = (f"({COUNT})人(?:の)?スカウト", f"スカウト(?:陣)?({COUNT})人", f"({COUNT})人(?:態勢|で視察|が視察|が集結|が見守)")
CANDIDATE = "プロ注目|今秋(?:の)?ドラフト|ドラフト候補|ドラフト上位候補|上位候補|1位候補|１位候補|指名候補|リストアップ|スカウト視察|最速(?:15[0-9]|１[５-９][０-９])キロ|最速(?:15[0-9]|１[５-９][０-９])km"
_TITLE = r"[\w一-龥ァ-ンー・／兼]"
_OFFICE = f"編成(?:{_TITLE}{{0,16}})?(?:本部長|副本部長|部長|副部長|担当|ディレクター|部|グループ)"
ROLE = f"スカウト{_TITLE}*|アマスカウト{_TITLE}*|{_OFFICE}|球団本部{_TITLE}*|統括{_TITLE}*|育成Gマネージャー|スカウトGマネージャー|スカウトGディレクター|アマスカウトGディレクター|(?:GM|ＧＭ)(?!業)|CBO|ＣＢＯ|ゼネラルマネジャー|球団関係者|MLBスカウト|メジャースカウト"
AFFILIATED = "チーフ|チーフ補佐|投手チーフ|グループ長|ディレクター|スーパーバイザー|アドバイザー|顧問|参与|主任|補佐|デスク|本部長|副本部長|部長|副部長|マネージャー"
SAYING = "評価|絶賛|太鼓判|コメント|話した|語った|評した|称賛|注目|マーク"
BULLET = rf"[▽▼►▶◇]\s*[^。\n]{{0,14}}?(?:スカウト(?![をのが、。\s]){_TITLE}*|アマスカウト{_TITLE}*|{_OFFICE}|(?:GM|ＧＭ)(?!業)|CBO|ＣＢＯ)"
DITTO = ("〃", "同", "々", "\"", "”", "")
