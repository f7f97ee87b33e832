import random

import pandas as pd
import pytest
from dugoutline.operators import dedup
from dugoutline.plans import pipeline


def _features(rows):
    got = pd.DataFrame([dedup.article_features(t, b) for _, t, b in rows], columns=["lt", "lb", "kind", "bits", "counts"])
    return got.assign(seq=[s for s, _, _ in rows])


def _edited(r, x, share):
    return "".join(r.choice(("", c + c, "Q", "球")) if r.random() < share else c for c in x)


def _articles():
    r = random.Random(11)
    words = ["".join(r.choice("aeiounrstlmhd") for _ in range(r.randint(2, 8))) for _ in range(60)]
    kana = "あいうえおかきくけこのはがをにで投手打者試合選手球団高校九回二塁"
    base = [" ".join(r.choice(words) for _ in range(90)) + f" {k}." for k in range(5)] + ["".join(r.choice(kana) for _ in range(n)) for n in (3, 60, 150, 320)] + ["", "a" * 700 + "Zq"]
    return [(i, f"Notebook: arm strength {i % 3}", _edited(r, base[i % len(base)], r.choice((0, 0.02, 0.08, 0.15)))) for i in range(88)]


@pytest.mark.parametrize("t", [0.5, 0.7, 0.8])
def test_features_leave_out_no_similar_pair(t):
    rows = _articles()
    x = _features(rows)
    met = {(int(rows[i][0]), int(rows[j][0])) for p, q in dedup._met(x, x, t) for i, j in zip(p, q, strict=True)}
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] > b[0] and dedup.ratio(a[1], b[1]) > t and dedup.ratio(a[2], b[2]) > t}
    assert len(want) > 30 and want <= met and all(a > b for a, b in met)


def test_articles_of_one_title_are_told_apart_by_their_bodies():
    r = random.Random(12)
    body = lambda: "".join(chr(r.randint(0x4E00, 0x5800)) for _ in range(300))
    rows = [(i, "見出しはどれも同じ", body()) for i in range(200)]
    rows += [(200 + i, t, b + "追記") for i, t, b in rows[:5]]
    x = _features(rows)
    assert {(int(i), int(j)) for p, q in dedup._met(x, x, 0.8) for i, j in zip(p, q, strict=True)} == {(200 + i, i) for i in range(5)}


def test_bags_reach_as_bag_ratio():
    rows = [b for _, _, b in _articles()]
    i, j = zip(*[(i, j) for i in range(len(rows)) for j in range(len(rows))], strict=True)
    got = dedup.bags_reach(rows, pd.Series(i).to_numpy(), pd.Series(j).to_numpy(), 0.7)
    assert got.tolist() == [dedup.bag_ratio(rows[a], rows[b]) > 0.7 for a, b in zip(i, j, strict=True)]


def test_more_articles_than_a_block_holds(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 20)
    rows = _articles()
    df = spark.createDataFrame(rows, "seq bigint, title string, body string")
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] > b[0] and dedup.ratio(a[1], b[1]) > 0.7 and dedup.ratio(a[2], b[2]) > 0.7}
    assert {tuple(x) for x in dedup.similar_pairs(df, df, 0.7).collect()} == want
    later, earlier = df.where("seq % 2 = 0"), df.where("seq % 2 = 1")
    assert {tuple(x) for x in dedup.similar_pairs(later, earlier, 0.7).collect()} == {(a, b) for a, b in want if a % 2 == 0 and b % 2 == 1}


def test_texts_meet_once_per_pair_of_blocks(spark):
    rows = [(i, "見出しはどれも同じ", "本文もどれも同じである。" * 9) for i in range(60)]
    df = spark.createDataFrame(rows, "seq bigint, title string, body string")
    plan = dedup.similar_pairs(df.where("seq >= 30"), df.where("seq < 30"), 0.8)
    assert plan.count() == 900 and "text_a" not in (told := plan._jdf.queryExecution().optimizedPlan().toString()) and "a_body" not in told


def test_ratios_reach_as_ratio():
    rows = [b for _, _, b in _articles()] + [t for _, t, _ in _articles()[:3]]
    i, j = (pd.Series(x).to_numpy() for x in zip(*[(i, j) for i in range(len(rows)) for j in range(0, len(rows), 3)], strict=True))
    for t in (0.3, 0.7, 0.8):
        assert dedup.ratios_reach(rows, i, j, t).tolist() == [dedup.ratio(rows[a], rows[b]) > t for a, b in zip(i, j, strict=True)]


def test_exact_check_of_unlike_articles_of_one_title_ends_early(monkeypatch):
    r, found = random.Random(13), []

    class Counted(dedup.SequenceMatcher):
        def find_longest_match(self, *at):
            found.append(at)
            return super().find_longest_match(*at)

    words = ["".join(r.choice("aeiounrstlmhd") for _ in range(r.randint(2, 8))) for _ in range(60)]
    body = lambda: ". ".join(" ".join(r.choice(words) for _ in range(12)).capitalize() for _ in range(15))
    bodies = [body() for _ in range(12)]
    i, j = (pd.Series(x).to_numpy() for x in zip(*[(i, j) for i in range(12) for j in range(i)], strict=True))
    monkeypatch.setattr(dedup, "SequenceMatcher", Counted)
    assert not dedup.texts_reach(["Notebook: range at a park"] * 12, bodies, i, j, 0.8).any() and len(found) < 8 * len(i)


def test_texts_by_id_in_blocks_of_either_script(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 20)
    rows = [(i, t, b if i % 4 else b + b[:20] + "投手と打者の話。" * (i % 9)) for i, t, b in _articles()] + [(88, None, None), (89, None, "")]
    texts = spark.createDataFrame([(f"k{i}", t, b) for i, t, b in rows], "id string, title string, body string")
    numbers = spark.createDataFrame([(i, f"k{i}") for i, _, _ in rows], "seq bigint, id string")
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] > b[0] and dedup.ratio(a[1], b[1]) > 0.7 and dedup.ratio(a[2], b[2]) > 0.7}
    assert sorted(tuple(x) for x in dedup.similar_pairs(numbers, numbers, 0.7, texts).collect()) == sorted(want)
    later, earlier = numbers.where("seq % 2 = 0"), numbers.where("seq % 2 = 1")
    assert sorted(tuple(x) for x in dedup.similar_pairs(later, earlier, 0.7, texts).collect()) == sorted((a, b) for a, b in want if a % 2 == 0 and b % 2 == 1)


def test_bodies_are_not_moved_to_be_numbered(spark, monkeypatch, tmp_path):
    rows = [(str(i), "s", t, b, None) for i, t, b in _articles()]
    spark.createDataFrame(rows, "id string, source string, title string, body string, created_at timestamp").write.parquet(str(tmp_path / "crawled_articles.parquet"))
    seen, held = [], dedup.similar_pairs
    monkeypatch.setattr(dedup, "similar_pairs", lambda a, b, *rest: seen.extend([*a.columns, *b.columns]) or held(a, b, *rest))
    assert pipeline.incoming_vs_stored(spark, str(tmp_path)).count() == 44 and "seq" in seen and "body" not in seen
