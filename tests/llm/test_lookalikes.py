import pytest
from dugoutline.llm import lookalikes as K


@pytest.mark.parametrize(
    ("text", "plain"),
    [
        ("ＭＬＢの１球", "MLBの1球"), ("ｶｰﾌﾞ", "カーブ"), ("ガ", "ガ"), ("OРS", "OPS"), ("見​﻿逃し", "見逃し"), ("変化\U000e0101球", "変化球"), ("力ーブと", "カーブと"), ("プ口でも", "プロでも"),
        ("ス卜レ一ト", "ストレート"), ("へッド", "ヘッド"), ("カ―ブ", "カーブ"), ("a b　c", "a b c"), ("⼒負け", "力負け"), ("年年", "年年"), ("リリ－ス", "リリース"), ("スライダ一は", "スライダーは"), ("開幕力ード", "開幕カード"),
    ],
)
def test_plain_form(text, plain):
    assert K.plain(text) == plain
    assert K.skeleton(text) == K.skeleton(plain)


@pytest.mark.parametrize("text", ["コントロール力も高い", "ストレート一本で", "スイング二つで", "フェンスへ運ぶ", "口コミ", "人口ピラミッド", "入力ミス", "國學院の澤村", "B+ 148km - (良い)\t。", "山﨑", "佐々木", ""])
def test_plain_text_stays(text):
    assert K.plain(text) == text


def test_rows_and_groups(spark):
    rows = [("1", "ＡＢ", 1), ("2", "AB", 2), ("2", "AB", 2), ("3", None, 3), ("4", "", 4), ("5", "А​B", 5)]
    df = spark.createDataFrame(rows, "id string, text string, plain int")
    assert {(r.record_id, r.plain) for r in K.lookalike_rows(df, "id", "text").collect()} == {("1", "AB"), ("5", "AB")}
    groups = {r.plain: (r.spellings, r.records) for r in K.skeleton_groups(df, "text").collect()}
    assert groups == {"AB": (3, 4), "": (1, 1)}
    assert K.lookalike_rows(df.limit(0), "id", "text").count() == 0


def test_long_text(spark):
    df = spark.createDataFrame([("1", "あ" * 300_000 + "ｱ")], "id string, text string")
    assert len(K.lookalike_rows(df, "id", "text").first().plain) == 300_001
