from collections import defaultdict

import pandas as pd
import pytest
from dugoutline.llm import packing as P

PATH = P.vocabulary()


def test_containers(spark):
    docs = [(i, f"本文{i} " + "word " * (i % 90), ["a", "b", None][i % 3], 1) for i in range(300)]
    docs += [(1000 + i, "同じ 文章", "a", 1) for i in range(20)] + [(2000, "long text " * 900, "c", 1), (2001, None, "c", 1), (2002, "", "c", 1), (3, docs[3][1], "a", 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, tokens int")
    got = P.containers(df, PATH, capacity=256, per_source=4, shard_bins=8).collect()
    size = {(d, t): P.count_tokens(PATH, t) for d, t, *_ in docs if t}
    bins, pieces = defaultdict(int), defaultdict(list)
    held = defaultdict(list)
    for r in got:
        bins[r.container_id] += r.tokens
        pieces[r.doc_id].append((r.piece, r.first_token, r.tokens))
        held[r.container_id].append(r.doc_id)
    assert max(bins.values()) <= 256
    for (d, t), n in size.items():
        own = sorted(pieces[d])
        if d == 3:
            assert [x[2] for x in own] == [n, n]
        elif n <= 256:
            assert own == [(0, 0, n)]
        else:
            assert [x[1] for x in own] == list(range(0, n, 256)) and sum(x[2] for x in own) == n
    assert all(sum(d >= 1000 and d < 1100 for d in ids) <= 1 for ids in held.values())
    assert 2001 not in pieces and 2002 not in pieces
    assert P.containers(df.limit(0), PATH).count() == 0


def test_tightest_compatible_bin():
    bins = P.Bins(10, 1)
    assert [bins.put(6, 0, 0), bins.put(5, 0, 0), bins.put(4, 1, 0), bins.put(4, 1, 0), bins.put(1, 0, 0)] == [0, 1, 0, 1, 1]


def test_fill_on_real_sizes():
    rows = pd.DataFrame({"tokens": [(i * 37) % 900 + 20 for i in range(2000)], "digest": range(2000), "source": ["s"] * 2000, "row": range(2000), "piece": 0})
    out = P.pack_rows(rows, 4096, 10**3)
    assert rows["tokens"].sum() / (out["bin"].nunique() * 4096) > 0.98


@pytest.mark.parametrize("text", ["行の本文です。\n" * 3000, "it's  a   line \n\n\t 12 34" * 700, " " * 5000 + "あ" * 3000, "x" * 4000])
@pytest.mark.parametrize("step", [1, 7, 1000])
def test_long_text_is_counted_in_steps(text, step):
    assert P.count_tokens(PATH, text, step=step) == P.count_tokens(PATH, text, step=10**9)


def test_tails_of_copies_lie_apart(spark):
    docs = [(i, "long text " * 300, None) for i in range(12)] + [(100 + i, f"short {i}", "a") for i in range(5)]
    got = P.containers(spark.createDataFrame(docs, "doc_id bigint, text string, source string"), PATH, capacity=256).where("doc_id < 100").collect()
    tails = [(r.container_id, r.piece) for r in got]
    assert max(p for _, p in tails) > 0 and len(set(tails)) == len(tails)
