from datetime import datetime

from dugoutline.sources import pages, store
from dugoutline.streaming import ingest

HTML = """<html><head><title>空木高の左腕が好投（写真あり） | 例スポーツ</title><meta property="article:published_time" content="2025-07-12T06:00:00+09:00"></head>
<body><nav><p>メニューの長い長い長い文字列です</p></nav><h2>提出者（要件を満たさない）</h2><a href="/kiji/1">一</a><a href="/kiji/1">一</a><a href="/kiji/">だめ</a><a href="https://other.example/x">外</a>
<p>""" + "本文の段落です。" * 12 + """</p><p>短い</p><p>""" + "二つ目の段落。" * 6 + """</p>
<table><tr><th>氏名</th><th>学校</th></tr><tr><td>空木 一</td><td>空木高</td></tr><tr><th>関東</th></tr><tr><td>水面 二</td><td>〃</td></tr></table><table><tr><th>x</th></tr><tr><td>1</td></tr></table></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([("https://e.example/p", HTML), ("https://e.example/q", None)], "url string, html string")
    got = {r.url[-1]: r for r in pages.page_fields(df).collect()}
    assert got["p"].title == "空木高の左腕が好投" and got["p"].date == "2025-07-12T06:00:00+09:00"
    assert got["p"].body.split("\n")[0].startswith("提出者") and "メニュー" not in got["p"].body and "短い" not in got["p"].body
    assert got["q"].title == "" and got["q"].body is None
    links = pages.page_links(df, "https://e.example", prefix="https://e.example", contains="/kiji/", not_ending="/").collect()
    assert [(r.url[-1], r.link, r.pos) for r in links] == [("p", "https://e.example/kiji/1", 0)]
    rows = pages.roster_rows(df).collect()
    assert [(r.table_id, r.section, r.pos, r.cells) for r in rows] == [(0, "提出者（要件を満たさない）", 0, ["空木 一", "空木高"]), (0, "提出者（要件を満たさない）", 1, ["水面 二", "〃"])]


def test_answers(spark):
    text = "```csv\n選手名,所属,人,球団,コメント,日付,URL\n甲, 空木高, 乙, 港, 良い, 悪い, 2025, u\n不明,a,b,c,d,e,f\n短い,a\n```"
    df = spark.createDataFrame([("k", text), ("n", None)], "key string, answer string")
    got = pages.answers(df, "key", "answer", ["name", "team", "scout", "club", "comment", "day", "url"]).collect()
    assert [(r.name, r.comment, r.day) for r in got] == [("甲", "良い,悪い", "2025")]
    assert pages.answer_json("前置き ```json\n[{\"a\": 1}, 2]\n``` 後") == [{"a": 1}] and pages.answer_json("{bad") == [] and pages.answer_json(None) == []


def test_store_and_stream(spark, tmp_path):
    schema = "url string, n int, at timestamp"
    rows = lambda *x: spark.createDataFrame([(u, n, datetime(2025, 1, 1)) for u, n in x], schema)
    target, source, mark = f"{tmp_path}/t", f"{tmp_path}/s", f"{tmp_path}/c"
    assert store.append_new(spark, target, rows(("a", 1), ("a", 2)), ["url"]) == 1
    assert store.append_new(spark, target, rows(("a", 1), ("b", 2)), ["url"]) == 1
    rows(("b", 9), ("c", 3)).write.parquet(source)
    for _ in range(2):
        ingest.run_once(ingest.new_files(spark, source, schema), mark, ingest.merge_into(spark, target, ["url"]))
        assert sorted(r.url for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]
    rows(("d", 4)).write.mode("append").parquet(source)
    ingest.run_once(ingest.new_files(spark, source, schema), mark, ingest.merge_into(spark, target, ["url"]))
    assert spark.read.parquet(target).count() == 4
    store.upsert(spark, f"{tmp_path}/u", rows(("a", 1)), ["url"], ["n"])
    store.upsert(spark, f"{tmp_path}/u", rows(("a", 5), ("z", 6)), ["url"], ["n"])
    assert sorted((r.url, r.n) for r in spark.read.parquet(f"{tmp_path}/u").collect()) == [("a", 1), ("z", 6)]
    seen = []
    counts = ingest.windowed_counts(ingest.new_files(spark, source, schema), "at", "url", "1 day", "1 hour")
    counts.writeStream.outputMode("complete").foreachBatch(lambda b, _: seen.extend(b.collect())).option("checkpointLocation", f"{mark}2").trigger(availableNow=True).start().awaitTermination()
    assert {(r.url, r.n) for r in seen} == {("b", 1), ("c", 1), ("d", 1)}


def test_validation(spark):
    df = spark.createDataFrame([("pending", 0.5, 1), ("odd", 2.0, 1), (None, None, None)], "status string, latest_confidence double, source_count int")
    good, rejected = store.validated(df, store.candidate_rules())
    assert good.count() == 2 and rejected.first().broken_rules == ["status", "confidence"]
    assert store.without(df, df.where("status = 'odd'"), "status").count() == 2
