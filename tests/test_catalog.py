import pytest
from dugoutline.plans import catalog as C

ARTICLE = "id string, source string, category string, url string, title string, body string, published_at string, raw string, created_at string"


@pytest.fixture
def write(spark, tmp_path):
    def one(name, rows, schema):
        df = spark.createDataFrame(rows, schema)
        for c in ("created_at", "published_at"):
            if c in df.columns and (c, name) != ("published_at", "crawled_articles"):
                df = df.withColumn(c, df[c].cast("timestamp"))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return one


def test_articles_without_title_or_body_survive(spark, write):
    body = "遊撃手が三安打で勝利に導いた。" * 5
    original, told = "日刊ダイヤモンド", C.AGGREGATOR
    rows = [("a", original, "一打", body), ("b", told, None, "別の長い本文です。" * 9), ("c", told, "見出しだけ", None), ("d", told, "一打", body), ("e", original, None, "投手の話題。" * 9), ("f", told, None, "投手の話題。" * 9)]
    d = write("crawled_articles", [(i, s, None, f"u{i}", t, b, None, None, None) for i, s, t, b in rows], ARTICLE)
    assert C.near_duplicate_articles(spark, d).count() == 4
    assert sorted(r.title or "" for r in C.aggregator_anti_similar(spark, d).collect()) == ["", "見出しだけ"]


def test_timeline_full_keeps_the_latest_published_original(spark, write):
    told = C.AGGREGATOR
    write("crawled_articles", [(i, s, None, f"u{i}", "同じ 見出し", "本文", p, None, None) for i, s, p in (("a", "x", "2025-01-01T09:00:00+09:00"), ("b", "x", "2025年3月1日 09:00"), ("c", told, "2025-05-01T00:00:00Z"))], ARTICLE)
    candidate = "id string, crawled_article_id string, player_id string, name string, latest_source_url string, latest_confidence double, created_at string"
    write("player_candidates", [(f"c{i}", i, "p", "名", f"u{i}", 0.5, f"2025-0{k}-01 00:00:00") for k, i in enumerate("abc", 1)], candidate)
    comment = "id string, player_id string, player_candidate_id string, source_url string, team_name string, scout_name string, comment string, published_at string, created_at string"
    write("scout_comments", [("s", "p", None, "ua", "t", "n", "評", "2025-01-02 03:04:05", None), ("t", "p", None, "ub", "t", "n", "評価", None, None)], comment)
    d = write("players", [("p", "名", "高校", None)], "id string, name string, category string, created_at string")
    items = C.timeline_full(spark, d).collect()
    assert [(r.crawled_article_id, r.published_at) for r in items if r.item_type == "player_article"] == [("b", "2025-03-01T00:00:00Z")]
    assert sorted(r.published_at for r in items if r.item_type == "scout_comment") == ["2025-01-02T03:04:05Z", "2025-03-01T00:00:00Z"]
