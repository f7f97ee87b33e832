from dugoutline.functions import dates as D
from dugoutline.functions import text as T
from pyspark.sql import functions as F


def values(spark, f, *texts, schema="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {schema}")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_names_and_schools(spark):
    assert values(spark, T.player_key, "百合澤 一郎選手", "ＡＢ　太郎", "  ", None, "髙橋") == ["百合沢一郎", "ab太郎", None, None, "高橋"]
    assert values(spark, T.name_key, "龍﨑 一", None) == ["竜崎一", ""]
    assert values(spark, T.kana_key, "アカネ オ", "あかね・お", "ｱｶﾈ", None, "漢字") == ["あかねお", "あかねお", "あかね", "", ""]
    assert values(spark, T.school_key, "国學院大學", "空木高等学校", "空木 高校", "駒大", "慶大", "") == ["国学院大", "空木高", "空木高", "駒沢大", "慶應義塾大", None]


def test_clubs(spark):
    clubs = {"鳥": "bird", "鳥ズ": "birds", "空の鳥ズ": "sky"}
    assert values(spark, lambda x: T.club_key(x, clubs), "鳥ズ", " 鳥 ", "今日の空の鳥ズ戦", "なし", None) == ["birds", "bird", "sky", None, None]
    assert values(spark, lambda x: T.club_name(x, clubs, ("鳥", "鳥ズ", "空の鳥ズ")), "sky", "other", " ", "else", None) == ["空の鳥ズ", None, None, "else", None]


def test_comments(spark):
    assert values(spark, T.comment_text, "「 良い　 打者。」", "『\"a\"』", None, "」") == ["良い 打者。", "a", "", ""]
    assert values(spark, T.loose_comment_key, "「A-B、 良い!」", None) == ["ab良い", ""]
    assert values(spark, T.clean_text, " a\n b　c ", None) == ["a b c", ""]


def test_codes(spark):
    assert values(spark, T.number_of, "１２", "十二", "七", "十三", " 4 ", None) == [12, 12, 7, None, 4, None]
    assert values(spark, T.to_int, "3.7", "-4", " 5 ", "x", None) == [None, -4, 5, None, None]
    assert values(spark, T.positions_of, ["ピッチャー", "左翼手", "P"], ["", "代走"], None, schema="array<string>") == [["投手", "外野手"], ["代走"], []]
    assert values(spark, T.bats_of, "両打", "右", "l", "?", None) == ["S", "R", "L", None, None]
    assert values(spark, T.category_of, "高校野球", "社会人", "独立", "", "hs") == ["高校", "社会人", "独立リーグ", None, "hs"]
    assert values(spark, T.rank_label, 90, 30, 85, None, schema="int") == ["S", "F", "—", "—"]
    assert values(spark, T.plain_excerpt, "[a](http://x) **b**\n# c", "##", None) == ["a b c", None, None]



def test_topic_keys(spark):
    df = spark.createDataFrame([("player_watch", "k", "2025-01-01", None), ("player_watch", None, "2025-01-01", None), ("scout_meeting", None, "2025-01-01", "t"), ("game_report", None, "2025-01-01", "b"), ("ranking", None, None, None)], "kind string, player string, date string, team string")
    key = T.topic_key(F.col("kind"), year=F.lit(2026), player=F.col("player"), date=F.col("date"), team=F.col("team"), team_b=F.lit("a"), category=F.lit("hs"), theme=F.lit("x"))
    assert [r[0] for r in df.select(key).collect()] == ["player_watch:2026:k:2025-01-01", None, "scout_meeting:t:2025-01-01:2026", "game_report:2025-01-01:a:b", "ranking:2026:hs:x"]


def test_dates(spark):
    texts = ["2025-07-12T06:00:01-05:00", "[ 2025年7月12日 6:05 ]", "2025年7月12日(土) 06:00", "2025-07-12", "2025/7/2", "7/12/2025", "25/12/2025", "2025-07-12T01:02:03.5", "July 12, 2025", "", None]
    assert values(spark, D.timestamp_text, *texts) == ["2025-07-12T06:00:01+09:00", "2025-07-12T06:05:00+09:00", "2025-07-12T00:00:00+09:00", "2025-07-12T00:00:00+09:00", "2025-07-02T00:00:00+09:00", "2025-07-12T00:00:00+09:00", "2025-12-25T00:00:00+09:00", "2025-07-12T01:02:03+09:00", None, None, None]
    assert values(spark, D.date_with_time, texts[1]) == ["2025-07-12 06:05"] and values(spark, D.date_only, texts[1]) == ["2025-07-12"]


def test_draft_years(spark):
    rows = [(2027, "2025", "2年", "高校", ""), (None, "2025-01-01", "2年", "高校", ""), (0, "2025", "1年", "大学", ""), (None, "2025", "高卒2年", "社会人", ""), (None, "2025", None, "高校", "来年のドラフト候補"), (None, "2025", None, None, "今秋ドラフトの目玉"), (None, None, "3年", "高校", ""), (None, "2025", "5年", "高校", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, y int, p string, s string, c string, t string")
    got = [r[0] for r in df.orderBy("i").select(D.draft_year(F.col("y"), F.col("p"), F.col("s"), F.col("c"), F.col("t"))).collect()]
    assert got == [2027, 2026, 2028, 2026, 2026, 2025, None, 2025]


def test_small_forms(spark):
    assert values(spark, T.name_variations, "山田 一", "山田", None) == [["山田 一", "山田一"], ["山 田", "山田"], [""]]
    assert values(spark, T.federation_label, "空木野球連盟", "連盟", "", None) == ["空木", "連盟", "—", "—"]
    assert values(spark, T.checked_keys, "- [x] a <!--k:k1-->\n- [ ] b <!--k:k2-->\n- [X] c <!--k:k3-->", None) == [["k1", "k3"], []]
    assert values(spark, lambda x: T.known_club(x, ("lions",), {"seibu": "lions"}), " Seibu", "other", None) == ["lions", None, None]
    assert values(spark, lambda x: T.article_url(x, "https://n.example/"), "https://n.example/articles/1", "https://n.example/x", None) == [True, False, False]
    assert values(spark, lambda x: T.placeholder_title(F.lit("player_watch"), x, F.lit(3), F.lit(0), F.lit("t")), "甲", "", None) == ["甲にスカウト視察集中（3球団0人）", "t", "t"]
