import random
from datetime import date, datetime

import pytest
from dugoutline.functions import text as T
from dugoutline.functions import values as V
from dugoutline.operators import dedup, entity, graph, links, roster, signals, topics
from dugoutline.operators import timeline as tl
from pyspark.sql import functions as F

CASES = {
    "scout quoted by name": ("空木高の左腕が好投。港の球団の担当スカウトは「球の伸びが良い」と評価した。ネット裏には5球団のスカウトが並んだ。", True, True, True),
    "executive quoted": ("12球団24人のスカウトが視察し、CBOの山田氏は「体の強さがある」と話した。", True, True, True),
    "manager only": ("空木高の監督は「よく投げた」と話した。選手は笑顔だった。", False, False, False),
    "commentator, no visit": ("解説者は「楽しみな投手」と語った。スカウトの視察はなかった。", False, False, False),
    "attention without comment": ("12球団のスカウトが集結した。スカウトの具体的なコメントはなかった。", False, True, True),
    "meeting": ("港の球団がスカウト会議を開いた。上位候補を絞った。", False, True, True),
    "career talk": ("全球団の選手へセカンドキャリアの説明会があった。", False, False, False),
    "innings veto": ("7回制の導入について編成部長が「評価は早い」と話した。", False, False, False),
    "former role": ("元スカウト部長の男性は「良い投手」と語った。", False, False, False),
    "listed quote": ("▽港 スカウト部長 球に力がある", True, False, True),
}


@pytest.mark.parametrize("name", CASES)
def test_gates(spark, name):
    text, comment, attention, player = CASES[name]
    got = signals.annotated(spark.createDataFrame([("1", "", text)], "id string, title string, body string")).first()
    assert (got.gate_scout_comment, got.gate_attention, got.gate_player_candidate) == (comment, attention, player)


def test_attention_rows(spark):
    df = spark.createDataFrame([("1", "ヘロンズが会議", "次回スカウト会議は10月。12球団のスカウト30人が視察した。晴れ。"), ("2", "カイツが視察", ""), ("3", None, None)], "id string, title string, body string")
    got = [(r.id, r.pos, r.team_count, r.person_count, r.team_keys, r.score) for r in signals.attention_rows(df, V.TEST_CLUBS, tuple(V.TEST_CLUBS)).orderBy("id", "pos").collect()]
    assert got == [("1", 0, 0, 0, ["herons"], 2), ("1", 1, 12, 30, [], 6), ("2", 0, 0, 0, ["kites"], 2)]


@pytest.mark.parametrize(("teams", "persons", "keys", "majors", "comment", "score"), [(12, 24, 0, False, False, 6), (12, 10, 0, True, True, 7), (8, 0, 0, False, False, 4), (5, 0, 0, False, False, 3), (2, 0, 0, False, False, 2), (0, 0, 1, False, False, 2), (0, 1, 0, False, False, 1), (1, 0, 0, False, False, 0)])
def test_attention_score(spark, teams, persons, keys, majors, comment, score):
    k = F.array(*[F.lit("x")] * keys) if keys else F.array().cast("array<string>")
    assert spark.range(1).select(signals.attention_score(F.lit(teams), F.lit(persons), k, F.lit(majors), F.lit(comment))).first()[0] == score


def test_components_against_union_find(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {x.node: x.component for x in graph.components(df, "a", "b").collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert graph.components(df.limit(0), "a", "b").count() == 0


def test_similarity_dedup_against_global_replay(spark):
    r = random.Random(6)
    rows = []
    for i in range(40):
        base = f"story {r.randrange(8)} "
        body = base * 12 + "".join(r.choice("abcdef ") for _ in range(r.choice((2, 40))))
        rows.append((i, base + "title", body, r.choice(("日刊ダイヤモンド", "まとめポータル", "else")), "k"))
    rows += [(100, "", "", "x", "k"), (101, None, None, "x", "k"), (102, "", "long", "x", "k")]
    df = spark.createDataFrame(rows, "seq bigint, title string, body string, source string, k string")
    similar = {(a[0], b[0]) for a in rows for b in rows if a[0] > b[0] and dedup.ratio(a[1], b[1]) > 0.8 and dedup.ratio(a[2], b[2]) > 0.8}
    prio = lambda s: V.TEST_PRIORITIES.get(s, 5)
    want = sorted(dedup.replay([(x[0], prio(x[3])) for x in rows], similar))
    got = sorted((x.seq, x.slot) for x in dedup.similarity_dedup(df, 0.8, V.TEST_PRIORITIES).collect())
    assert got == want and len(want) < len(rows)


def test_hash_priority_and_url(spark):
    long = "本文" * 40
    rows = [(1, "u", "長い題名がここにあります", long, "まとめポータル"), (2, "v", "長い題名がここにあります", long, "日刊ダイヤモンド"), (3, "v", "短い", "短い", "x"), (4, "", "短い", "短い", "x"), (5, None, None, None, None)]
    df = spark.createDataFrame(rows, "seq bigint, url string, title string, body string, source string")
    assert sorted((r.seq, r.slot) for r in dedup.hash_priority(df, F.col("seq"), V.TEST_PRIORITIES).collect()) == [(2, 1), (3, 3), (4, 4), (5, 5)]
    assert sorted(r.seq for r in dedup.url_first(df, F.struct("seq")).collect()) == [1, 2]


def test_match_cascade(spark):
    s = "name_key string, kana_key string, school_key string, category string, year int"
    players = spark.createDataFrame([("p1", "山田", "やまだ", "空木高", "高校", 2025), ("p2", "山田", "やまだ", "雲雀大", "大学", 2025), ("p3", "山田", "やまだ", "水面高", "高校", 2025), ("p4", "森", "もり", "空木高", "高校", 2026), ("p5", "別字", "はやし", "空木高", "高校", None)], f"id string, {s}")
    entries = spark.createDataFrame([(1, "山田", "", "空木", "高校", 2025), (2, "山田", "", "未知高", "高校", 2025), (3, "林", "はやし", "空木高", "高校", 2025), (4, "谷", "たに", "空木高", "高校", 2025), (5, "森", "", "遠い高", "大学", 2025), (6, "", "", "", None, None), (7, "山田", "", "", "大学", None)], f"entry_id bigint, {s}")
    got = {r.entry_id: (r.status, r.player_id, r.matched_by, r.warnings) for r in entity.match_cascade(entries, players).collect()}
    assert got[1] == ("matched", "p1", "name+school", "") and got[2][0] == "ambiguous" and got[3] == ("matched", "p5", "kana", "")
    assert got[4][0] == "unmatched" and got[5] == ("matched", "p4", "name", "school,category,year") and got[6][0] == "unmatched" and got[7] == ("matched", "p2", "name", "")
    near = spark.createDataFrame([(9, "山中", "", "空木高", "高校", 2025), (8, "山田太", "", "遠い", "社会人", 2025)], f"entry_id bigint, {s}")
    assert [(r.entry_id, r.player_id) for r in entity.suggestions(near, players).collect()] == []
    near = spark.createDataFrame([(9, "山田一", "", "空木高", "高校", 2025)], f"entry_id bigint, {s}")
    assert [(r.player_id, r.similarity, r.same_school) for r in entity.suggestions(near, players).collect()] == [("p1", 0.8, True)]


def test_sequential_topics_against_global_replay(spark):
    r = random.Random(7)
    rows = []
    for i in range(150):
        player = r.choice([None, "a", "b", "c"])
        name = r.choice([None, "na", "nb"]) if player is None else f"n{player}"
        day = r.choice([None, *[date(2025, 1, d) for d in range(1, 20)]])
        kind = r.choice(["player_watch", "scout_meeting"])
        rows.append((i, kind, f"{kind}:{r.choice([player, name, 'x'])}:{day}", player, name, f"u{r.randrange(60)}", day, r.randrange(50)))
    df = spark.createDataFrame(rows, "signal_id bigint, topic_type string, topic_key string, player_id string, player_name string, url string, day date, created_at bigint")
    days = {}
    for x in rows:
        if x[6]:
            days.setdefault(x[5], set()).add(x[6])
    ordered = sorted(rows, key=lambda x: (x[7], x[0]))
    want = dict(topics.replay([(*x[:6], x[6], days.get(x[5], set())) for x in ordered]))
    got = {x.signal_id: x.topic for x in topics.sequential_topics(df).collect()}
    assert got == want and len(set(want.values())) > 5


def test_forward_fill_of_long_tables(spark):
    marks = ["A", "〃", "", "B", "同", None, "C"] + ["〃"] * 30 + ["D"]
    want, last = [], None
    for m in marks:
        last = m if m not in V.DITTO and m is not None else last
        want.append(last)
    df = spark.createDataFrame([(t, i, m) for t in (1, 2) for i, m in enumerate(marks)] + [(3, 0, "〃")], "table_id int, pos int, affiliation string")
    got = roster.forward_filled(df, "affiliation", runs=4).orderBy("table_id", "pos").collect()
    assert [r.affiliation for r in got] == [*want, *want, None]


def test_visits_absorbed(spark):
    at = datetime(2025, 1, 1)
    rows = [("1", "a", "t", "2025-01-01", 1, at), ("2", "a", "t", "2025-01-01", 0, at), ("3", "a", "t", None, 0, at), ("4", "a", "", None, 0, at), ("5", "a", "", "2025-01-01", 0, at), ("6", "b", "t", None, 0, None), ("7", "b", "t", None, 0, at)]
    df = spark.createDataFrame(rows, "id string, ref string, team string, event_date string, aggregator int, created_at timestamp")
    assert sorted(r.id for r in dedup.absorbed_visits(df).collect()) == ["2", "4", "5", "7"]


def test_links(spark):
    items = spark.createDataFrame([("u", "p", "all"), ("u", "p", "a"), ("v", "p", "b"), ("u", "p", "all")], "url string, player string, team string")
    teams = spark.createDataFrame([("a",), ("b",), ("c",)], "team string")
    assert sorted(tuple(r) for r in links.all_team_expansion(items, teams).collect()) == [("u", "p", "a"), ("u", "p", "b"), ("u", "p", "c"), ("v", "p", "b")]
    old = spark.createDataFrame([("u", "old", 1), ("w", "keep", 2)], "url string, title string, created int")
    new = spark.createDataFrame([("u", "new", 9), ("x", "x", 8)], "url string, title string, created int")
    once = links.merged_by_key(old, new, ["url"], ["created"])
    assert sorted(tuple(r) for r in once.collect()) == [("u", "new", 1), ("w", "keep", 2), ("x", "x", 8)]
    assert sorted(map(tuple, links.merged_by_key(once, new, ["url"], ["created"]).collect())) == sorted(map(tuple, once.collect()))


def test_news_once_strict(spark):
    rows = [(None, "c1", "a1", "u1", "Title", None, "x", None, None, None, 0.5, None, None), (None, "c2", "a2", "u2", "title ", None, "agg", None, None, None, 0.5, None, None)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {tl.TYPES.get(c, 'string')}" for c in tl.COLUMNS))
    assert [r.player_candidate_id for r in tl.news_once(df, "agg").collect()] == ["c1"]
    assert tl.news_once(df, "agg", strict=True).count() == 2
    assert T.SPACE.startswith("[")
