import random
from datetime import date

import pytest
from dugoutline.functions import dates as D
from dugoutline.functions import text as T
from dugoutline.functions import values as V
from dugoutline.operators import dedup, entity, links, promote, roster, signals, topics
from dugoutline.sources import pages, store
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F


def test_incoming_articles_against_stored_ones(spark):
    r = random.Random(8)
    texts = ["".join(r.choice("あいうえおかきくけこさしすせそ") for _ in range(80)) for _ in range(6)]
    rows = [(i, f"題名その{k}がここにある", texts[k] + "追記" * (i % 3), s) for i, (k, s) in enumerate([(0, "x"), (1, "まとめポータル"), (2, "日刊ダイヤモンド"), (0, "日刊ダイヤモンド"), (1, "日刊ダイヤモンド"), (2, "まとめポータル"), (3, "x"), (4, None)])]
    df = spark.createDataFrame(rows + [(8, None, None, "x")], "seq bigint, title string, body string, source string")
    stored, new = df.where("seq < 3"), df.where("seq >= 3")
    prio = lambda s: V.TEST_PRIORITIES.get(s, 5)
    want = {}
    for n in new.collect():
        hit = next((o for o in sorted(stored.collect()) if dedup.ratio(n.title, o.title) > 0.8 and dedup.ratio(n.body, o.body) > 0.8), None)
        want[n.seq] = ("new", None) if hit is None else ("update" if prio(n.source) < prio(hit.source) else "drop", hit.seq)
    got = {x.seq: (x.action, x.stored_seq) for x in dedup.against_stored(new, stored, 0.8, V.TEST_PRIORITIES).collect()}
    assert got == want and {a for a, _ in want.values()} == {"new", "update", "drop"}


@pytest.mark.parametrize("t", [0.6, 0.7, 0.8])
def test_similar_pairs_against_brute_force(spark, t):
    r = random.Random(9)
    base = ["".join(r.choice("あいうえおかきくけこ今日明日試合選手投手打者") for _ in range(n)) for n in (1, 2, 4, 6, 9, 14, 22, 40)]
    edit = lambda x: "".join(c for c in x if r.random() > 0.1) + r.choice(("", "追", "追記"))
    rows = [(i, edit(b), edit("本文" * 8 + b * 2)) for i, b in enumerate(base * 7)] + [(90, "", ""), (91, None, None)]
    df = spark.createDataFrame(rows, "seq bigint, title string, body string")
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] > b[0] and dedup.ratio(a[1], b[1]) > t and dedup.ratio(a[2], b[2]) > t}
    assert {tuple(x) for x in dedup.similar_pairs(df, df, t).collect()} == want and len(want) > 30


def test_suggestions_against_brute_force(spark):
    r = random.Random(10)
    name = lambda: "".join(r.choice("茜尾鶴") for _ in range(r.choice((1, 2, 3, 4, 5, 7))))
    schools = ("空木高", "空木", "雲雀大", "雲雀", "", "水面")
    people = [(f"p{i:02}", name(), "", r.choice(schools), r.choice(("高校", "大学", None)), 2025) for i in range(60)]
    entries = [(i, name(), "", r.choice(schools), r.choice(("高校", "大学", None)), 2025) for i in range(40)]
    s = "name_key string, kana_key string, school_key string, category string, year int"
    got = sorted(tuple(x) for x in entity.suggestions(spark.createDataFrame(entries, f"entry_id bigint, {s}"), spark.createDataFrame(people, f"id string, {s}")).select("entry_id", "player_id", "similarity", "same_school", "rank").collect())
    want = []
    for e in entries:
        found = []
        for p in people:
            same = bool(e[3] and p[3] and (e[3] in p[3] or p[3] in e[3]))
            x = dedup.ratio(e[1], p[1])
            if (same or e[4] == p[4]) and x >= (0.6 if same else 0.85):
                found.append((e[0], p[0], round(x, 2), same))
        want += [(*f, k) for k, f in enumerate(sorted(found, key=lambda f: (not f[3], -f[2], f[1]))[:3], 1)]
    assert got == sorted(want) and len(want) > 20


def test_places_of_a_pattern(spark):
    texts = ["スカウト部長がスカウトを見た", "なし", "", None, "GMとＧＭ業"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(signals.starts_of(F.col("t"), "スカウト[部長]*|(?:GM|ＧＭ)(?!業)")).collect()] == [[1, 8], [], [], [], [1]]


def test_known_staff(spark):
    df = spark.createDataFrame([("1", "", "菱森 迅悟チーフは「球が走る」と評価した。"), ("2", "", "菱森 迅悟の兄は笑顔だった。"), ("3", "", "俵倉チーフは評価した。"), ("4", None, None)], "id string, title string, body string")
    got = {r.id: r.gate_scout_comment for r in signals.annotated(df, ("菱森迅悟",)).collect()}
    assert got == {"1": True, "2": False, "3": False, "4": False}


def test_stores_are_not_overwritten_when_they_cannot_be_read(spark, tmp_path):
    path = tmp_path / "store"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"not parquet")
    new = spark.createDataFrame([("a", 1)], "url string, n int")
    for write in (lambda: store.upsert(spark, str(path), new, ["url"], []), lambda: store.append_new(spark, str(path), new, ["url"])):
        with pytest.raises(Exception):  # noqa: B017, PT011
            write()
    assert (path / "part-0.parquet").read_bytes() == b"not parquet"
    with pytest.raises(AnalysisException):
        spark.read.parquet(str(tmp_path / "nowhere"))
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "url string, n int")
    assert store.append_counted(spark, str(tmp_path / "new"), rows, ["url"]) == {"appended": 2, "stored": 0, "repeated": 1}
    assert store.append_counted(spark, str(tmp_path / "new"), rows, ["url"]) == {"appended": 0, "stored": 2, "repeated": 1}
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "new")).collect())) == [("a", 1), ("b", 3)]


def test_full_timestamps(spark):
    texts = ["2025-01-02T03:04:05+09:00", "2025年1月2日 03:04", "Thu, 02 Jan 2025 03:04:05 +0900", "令和7年1月2日", "2025-01-02 03:04", "いつか", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.x for r in df.select("i", D.full_timestamp_text(F.col("t")).alias("x")).collect()}
    assert [got[i] for i in range(8)] == ["2025-01-02T03:04:05+09:00", "2025-01-02T03:04:00+09:00", "2025-01-02T03:04:05+09:00", "2025-01-02T00:00:00+09:00", "2025-01-02T03:04:00+09:00", "いつか", "", None]


def test_topics_near_and_merged(spark):
    d = date
    t = spark.createDataFrame([(f"t{i:02}", "k", "p", "draft", i, [d(2025, 1, i % 28 + 1)]) for i in range(30)] + [("x", "k", "p", "published", 99, [d(2025, 1, 1)]), ("y", "k", None, "draft", 99, [])], "topic_id string, topic_type string, player string, status string, created_at int, event_days array<date>")
    s = spark.createDataFrame([("a", "k", "p", d(2025, 1, 20)), ("b", "k", "p", None), ("c", "k", "p", d(2025, 1, 7)), ("d", "other", "p", None), ("e", "k", None, None)], "signal_id string, topic_type string, player string, day date")
    # the newest 20 are t10 to t29; t10's neighbours before it are out of reach
    assert {r.signal_id: r.topic_id for r in topics.nearest_topics(s, t).collect()} == {"a": "t22", "b": "t29"}
    old = spark.createDataFrame([("k", ["u1"]), ("m", ["u9"])], "topic string, urls array<string>")
    new = spark.createDataFrame([("k", "u2", 2), ("k", "u1", 1), ("k", None, 3), ("n", "u5", 1)], "topic string, url string, seq int")
    once = topics.merged_urls(old, new)
    assert {r.topic: r.urls for r in once.collect()} == {"k": ["u1", "u2"], "m": ["u9"], "n": ["u5"]} == {r.topic: r.urls for r in topics.merged_urls(once, new).collect()}


def test_checklist_and_pages(spark):
    records = spark.createDataFrame([("高校", "k1", "乙", True), ("高校", "k2", "甲", False)], "category string, key string, label string, fresh boolean")
    before = spark.createDataFrame([("- [X] 甲 <!--k:k2-->\n- [ ] 乙 <!--k:k1-->",), (None,)], "markdown string")
    got = roster.checklist(records, before, "category").first()
    assert got.markdown == "- [ ] 🆕 乙 <!--k:k1-->\n- [x] 甲 <!--k:k2-->" and got.ticked == 1
    feeds = spark.createDataFrame([("f", "<rss><channel><item><title>A &amp; B</title><link>https://x/1</link><pubDate>d</pubDate></item><item><title>n</title></item><item><link>https://x/skip</link></item></channel></rss>"), ("bad", "<rss"), ("none", None)], "url string, xml string")
    assert [tuple(r) for r in pages.feed_items(feeds, exclude="skip").collect()] == [("f", 0, "https://x/1", "A & B", "d")]


def test_name_found_within_a_longer_one(spark):
    players = spark.createDataFrame([("2", "鶴関 俊哉", "つるせき"), ("1", "大鶴関俊哉郎", None)], "id string, name string, name_kana string")
    names = spark.createDataFrame([("鶴関俊哉",), ("鶴関　俊哉郎",), ("大",), ("居ない",), (None,)], "name string")
    got = {r.name: r.player_id for r in links.name_lookup_anywhere(names.where("name is not null"), players).collect()}
    assert got == {"鶴関俊哉": "2", "鶴関　俊哉郎": "1", "大": "1", "居ない": None}


def test_committed_payloads(spark):
    payload = lambda name, **more: '{"player": {"name": "%s", "category": "高校"}, "stats": [{"season": "fall", "games": "3", "junk": "x"}, {"season": "winter", "games": "1"}, null], "achievements": [{"result": "優勝"}]}' % name  # noqa: E731, UP031
    rows = [("c1", "approved", None, payload("新 人")), ("c2", "approved", None, payload("既存選手")), ("c3", "promoted", None, payload("済")), ("c4", "approved", "p", payload("済")), ("c5", "approved", None, "{}"), ("c6", "approved", None, "junk"), ("c7", "approved", None, None)]
    got = promote.committed(spark.createDataFrame(rows, "candidate_id string, status string, player_id string, payload string"), spark.createDataFrame([("p9", "既存", 2025)], "player_id string, name string, draft_year int"))
    assert [r.player_id for r in got["players"].collect()] == ["c1"]
    assert [(r.pos, r.period, r.name, r.value) for r in got["stats"].orderBy("name").collect()] == [(0, "high_school", "games", "3"), (0, "high_school", "season", "fall")]
    assert [(r.name, r.value) for r in got["achievements"].collect()] == [("result", "優勝")]
    assert {tuple(r) for r in got["links"].collect()} == {("c1", "c1"), ("c2", "p9")}


def test_position_text(spark):
    texts = ["投手・外野手", "内野手投手", "捕手兼投手", "内野手", "投手", "DH", " ", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.position_list(F.col("t"))).collect()]
    assert got == [["投手", "外野手"], ["投手", "内野手"], ["投手", "捕手"], ["内野手"], ["投手"], ["DH"], None, None]
