import random

import numpy as np
import pytest
from dugoutline.llm import linkage, people
from dugoutline.llm.names import edits, parse_name, same_team, team_key
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SCHEMA = "id string, name string, name_kana string, team string, team_name string, draft_year int, category string, birth_date date, height_cm int, weight_kg int, fastball_max int, throws string, bats string, positions array<string>, player_id string, unit string, person string, full string"


def candidate(i, name, kana=None, team="杏川国際高", height=None, year=2025):
    return (i, name, kana, team, None, year, "高校", None, height, None, None, None, None, None, None, "u", "p", "f")


ROWS = [
    candidate("a1", "茜尾 俊哉", "あかねお しゅんや", height=176), candidate("a2", "俊哉 茜尾", "アカネオ シュンヤ", "杏川國際高"), candidate("a3", "Akaneo, S.", None, "杏川国際高等学校", 176), candidate("a4", "アカネオシュンヤ"),
    candidate("a5", "茜尾俊哉選手", None, "県立杏川国際高校"), candidate("a6", "茜尾 俊"), candidate("a1", "茜尾 俊哉", "あかねお しゅんや", height=176),
    candidate("b1", "茜尾 広真", "あかねお ひろま", height=181), candidate("b2", "茜尾 広真", None, "杏川国際"), candidate("c1", "茜尾 俊哉", "あかねお しゅんや", "雁岩至誠大"),
    candidate("n1", None), candidate("n2", ""), candidate("n3", "笹江 春斗", None, None), candidate("n4", "笹江 春斗", None, None),
]


def test_parts_of_names():
    assert parse_name("滝川 弦輔 (3年)", None)["full"] == "滝川弦輔"
    assert parse_name("Takusei KUWAMURA", None)["reading"] == parse_name("くわむら たくせい", None)["reading"] == "くわむらたくせい"
    assert parse_name("弦原ともちゃん", None)["nick"] == "とも"
    assert team_key("県立 杏川國際高等学校") == team_key("杏川国際高") == "杏川国際"
    assert same_team("笹海光", "笹海光陽") and not same_team("杏川国際", "茜洲国際")
    assert edits("岩櫂南", "櫂岩南") == 1 and edits("abc", "xyz", 2) == 3


def test_pairs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {tuple(r) for r in people.person_pairs(df).collect()}
    a = [f"a{i}" for i in range(1, 7)]
    want = {(x, y) for x in a for y in a if x < y} | {("b1", "b2")}
    assert want <= got
    assert not [p for p in got if p[0][0] != p[1][0]]
    assert people.person_pairs(df.limit(0)).count() == 0


def merged_by_brute_force(pairs, least):
    score = {}
    for a, b, s in pairs:
        score[frozenset((a, b))] = score.get(frozenset((a, b)), 0.0) + s
    clusters = [[x] for x in sorted({x for a, b, _ in pairs for x in (a, b)})]
    while True:
        means = [(-sum(score.get(frozenset((x, y)), 0.0) for x in p for y in q) / (len(p) * len(q)), min(p), min(q), p, q) for i, p in enumerate(clusters) for q in clusters[i + 1 :]]
        best = min(means, key=lambda m: m[:3], default=None)
        if best is None or -best[0] < least - 1e-12:
            return {x: min(c) for c in clusters for x in c}
        clusters = sorted([c for c in clusters if c not in best[3:]] + [sorted(best[3] + best[4])])


def test_average_linkage_of_few():
    pairs = [("a", "b", 0.9), ("b", "c", 0.8), ("a", "c", -1.0), ("c", "d", 0.7), ("e", "f", 0.4)]
    assert people.average_linkage(pairs, 0.45) == {"a": "a", "b": "a", "c": "c", "d": "c", "e": "e", "f": "f"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcdefgh"), st.sampled_from("abcdefgh"), st.sampled_from([-1.0, 0.25, 0.5, 0.75, 1.0, 1.25])).filter(lambda p: p[0] < p[1]), max_size=16, unique_by=lambda p: p[:2]))
def test_average_linkage_against_brute_force(pairs):
    assert people.average_linkage(pairs, 0.3) == merged_by_brute_force(pairs, 0.3)


def test_cosine_pairs_against_brute_force(spark):
    r = random.Random(7)
    rows = [(f"u{i}", "".join(r.choice("茜尾俊哉広真鶴関") for _ in range(r.choice((2, 3, 4, 5)))), r.choice(("", "あかねお", "つるせき", "あかせき")), r.choice(("kanji", "kana")), r.choice(("杏川国際", "杏川", "杏川国祭", "雁岩", "", "国際"))) for i in range(60)]
    units = people.with_vectors(spark.createDataFrame(rows, "unit string, full string, reading string, kind string, team string")).cache()
    vectors = {u.uid: (u.team, [{x.gram: x.w for x in u.vector or [] if x.view == v} for v in (0, 1)]) for u in units.collect()}
    bag = lambda s, t: len({*s} & {*t}) / (len({*s}) * len({*t})) ** 0.5
    dot = lambda x, y: sum(w * y.get(g, 0.0) for g, w in x.items())
    want = {}
    for a, (ta, va) in vectors.items():
        for b, (tb, vb) in vectors.items():
            if a < b and same_team(ta, tb) and (c := bag(ta, tb) * max(dot(x, y) for x, y in zip(va, vb, strict=True))) >= 0.2:
                want[a, b] = round(c, 9)
    got = {(x.a, x.b): round(x.cosine, 9) for x in people.cosine_pairs(units, 0.2).collect()}
    assert got == want and len(want) > 20
    assert all(abs(sum(w * w for w in v.values()) - 1) < 1e-9 for _, views in vectors.values() for v in views if v)


def test_roster_matches(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    entries = spark.createDataFrame(
        [(1, "茜尾　俊哉", "あかねお しゅんや", "杏川国際高等学校", 2025, "高校"), (2, "茜尾俊哉", None, "杏川国際高", None, None), (3, "茜尾 俊哉", None, "鳴崎誠和高", 2025, "高校"), (4, None, None, "杏川国際高", 2025, "高校"), (5, "茜尾 広真", None, None, 2025, None), (6, "茜尾 広真", None, "杏川国際高", 2026, "高校")],
        "entry_id bigint, name string, name_kana string, school string, season int, category string",
    )
    got = linkage.matches(entries, df)
    pairs = {(r.candidate_id, r.entry_id) for r in got.collect()}
    assert pairs == {(f"a{i}", e) for i in range(1, 7) for e in (1, 2)} | {("b1", 6), ("b2", 6)}
    assert all(0 <= r.confidence <= 1 for r in got.collect())
    assert linkage.matches(entries.limit(0), df).count() == 0 and linkage.matches(entries, df.limit(0)).count() == 0


def test_close_codes_are_exact(spark):
    r = random.Random(3)
    flipped = lambda v, bits: (lambda w: w - (1 << 64) if w >> 63 else w)((v % (1 << 64)) ^ sum(1 << b for b in bits))
    base = [r.getrandbits(64) - (1 << 63) for _ in range(40)]
    other = [flipped(v, r.sample(range(64), k % 7)) for k, v in enumerate(base)]
    schema = "uid bigint, team string, views array<struct<view: int, code: bigint>>"
    left = spark.createDataFrame([(i, "t", [(0, v)]) for i, v in enumerate(base)], schema)
    right = spark.createDataFrame([(i, "u", [(0, v)]) for i, v in enumerate(other)] + [(900, "u", [(1, base[0])]), (901, "far", [(0, base[0])])], schema)
    teams = spark.createDataFrame([("t", "u", 0.9)], "team string, near string, cosine double")
    got = {tuple(x) for x in linkage.close_codes(left, right, teams).collect()}
    assert got == {(a, b) for a, v in enumerate(base) for b, w in enumerate(other) if ((v ^ w) % (1 << 64)).bit_count() <= linkage.RADIUS}
    assert (3, 3) in got and (4, 4) not in got


def test_weighted_dice(spark):
    bits = linkage.encoded
    fields = "year string, category string, name bigint, said bigint, place bigint"
    cases = [(("2025", "hs", bits("茜尾俊哉"), bits("あか"), bits("杏川")), 1.0), (("2026", "hs", bits("茜尾俊哉"), bits("あか"), bits("杏川")), 0.96), ((None, None, bits("茜尾俊哉"), 0, bits("杏川")), 1.0), (("2025", "univ", bits("茜尾俊哉"), 0, bits("杏川")), 1 - 0.07 / 0.75), ((None, None, 0, 0, 0), 0.0)]
    a = spark.createDataFrame([cases[0][0]], fields).select(*[F.col(c).alias(f"a_{c}") for c in ("year", "category", "name", "said", "place")])
    b = spark.createDataFrame([(*c, i) for i, (c, _) in enumerate(cases)], fields + ", i int").select("i", *[F.col(c).alias(f"b_{c}") for c in ("year", "category", "name", "said", "place")])
    got = {r.i: r.s for r in a.join(b).select("i", linkage.weighted_dice().alias("s")).collect()}
    assert [round(got[i], 6) for i in range(len(cases))] == [round(s, 6) for _, s in cases]


def test_confidence_rises_and_holds_on_other_pairs():
    rng = np.random.default_rng(5)
    same = rng.random(6000) < 0.6
    dice = np.clip(np.where(same, 1 - rng.exponential(0.06, 6000), rng.normal(0.55, 0.1, 6000)), 0, 1)
    at = np.minimum(99, (dice * 100).astype(int))
    for table in (linkage.confidence_table(np.bincount(at, minlength=100).astype(float)), linkage.fitted_table(dice[:3000], same[:3000], 100)):
        assert table == sorted(table) and table[30] < 0.05 and table[-1] > 0.95
        said = np.array(table)[at]
        for part in (said < 0.2, said >= 0.8):
            part[:3000] = False
            assert abs(said[part].mean() - same[part].mean()) < 0.05


@pytest.mark.parametrize("n", [1, 3])
def test_confidence_rises(n):
    table = linkage.confidence_table(np.array([5, 9, 9, 3, 1, 0, 0, 2, 9, 30]) * n)
    assert table == sorted(table) and table[0] < 0.5 < table[-1]


def test_readings_of_kanji(spark):
    rows = [(["梓川", "宗志"], "あずさかわ", "むねし"), (["梓森", "翔志"], "あずさもり", "しょし"), (["桂川", "創志"], "かつらかわ", "そし")]
    df = spark.createDataFrame(rows, "parts array<string>, surname_reading string, given_reading string")
    got = {(r.char, r.place): r.said for r in people.kanji_readings(df).collect()}
    assert got[("梓", 1)] == "あずさ" and got[("川", 2)] == "かわ" and got[("志", 2)] == "し"
    assert df.select(F.size("parts")).first()[0] == 2
