import random
from collections import Counter

from dugoutline.llm import formatting_copies as C
from hypothesis import given, settings
from hypothesis import strategies as st

COLUMNS = "id string, player_id string, player_candidate_id string, player_name string, comment string, n int, key string, copies string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], COLUMNS)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=6), max_size=60))
def test_trie_counts_like_a_counter(keys):
    trie = C.Trie()
    for i, k in enumerate(keys):
        trie.add(k, 1, f"{i:03}")
    assert {k: n for k, n, _ in trie.items()} == Counter(keys)
    assert {k: f for k, _, f in trie.items()} == {k: f"{keys.index(k):03}" for k in keys}


def test_canonical_forms(spark):
    same = [
        ["直球:5、Tool:A、MAX:148km", "MAX:148km | 直球:5 | Tool:A ", "TOOL=A\n直球=5\nMAX=148km", "直球・5 / tool・a / MAX・148km。", "Tool A、MAX 148km、直球 5"],
        ["「回転数は6.5秒、良い。」", "回転数は6.5秒 良い", "回転 \n数は6.5秒. 良い"],
    ]
    other = ["Tool:B+、肩:3", "Tool:B、肩:3", "Tool:B-、肩:3", "Tool:3、肩:B+", "65秒", "6.5秒"]
    texts = [t for g in same for t in g] + other
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, comment string")
    key = {r.i: r.k for r in C.with_canonical(df, out="k").collect()}
    assert len({key[i] for i in range(5)}) == 1 and len({key[i] for i in range(5, 8)}) == 1
    assert len({key[i] for i in range(8, len(texts))}) == len(other)


def test_full_width_separators_make_a_list(spark):
    texts = ["直球:5、肩:3、MAX:148km", "肩：3；直球＝5，MAX：148km", "直球：5／肩:3｜MAX＝148km", "直球：3／肩：5／MAX：148km"]
    key = {r.i: r.k for r in C.with_canonical(spark.createDataFrame(list(enumerate(texts)), "i int, comment string"), out="k").collect()}
    assert key[0] == key[1] == key[2] != key[3]


def test_pairs(spark):
    rows = [("a", "p", None, "x", "良い。"), ("b", "p", "c", "y", "「良い」"), ("c", None, "p", None, "良い"), ("d", None, None, None, "良い"), ("e", "q", None, None, None), ("f", "q", None, None, "…"), ("g", "q", None, None, "!"), ("b", "p", "c", "y", "「良い」"), ("h", None, " ", "x", "良い"), ("i", None, None, "x", "良い")]
    assert {tuple(r) for r in C.formatting_pairs(frame(spark, rows)).collect()} == {("a", "b"), ("h", "i")}
    assert C.formatting_pairs(frame(spark, []).limit(0)).count() == 0


def test_buckets_split_until_they_fit(spark):
    rng = random.Random(1)
    texts = [f"{'あ' * 5}{rng.randint(0, 30)}" for _ in range(3000)] + ["同じ"] * 2000
    rows = [(f"{i:05}", "p", None, None, t) for i, t in enumerate(texts)]
    got = C.distinct_comments(frame(spark, rows), fits=20, flush=7)
    assert sorted(r.copies for r in got.collect()) == sorted(Counter(texts).values())
