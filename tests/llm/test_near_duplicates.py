import random
import unicodedata

import numpy as np
from dugoutline.llm import near_duplicates as N


def text(seed, n=40):
    r = random.Random(seed)
    return "。".join("".join(chr(0x4E00 + r.randrange(3000)) for _ in range(30)) for _ in range(n))


def test_pairs_against_brute_force(spark):
    rows = []
    for k in range(8):
        base = text(k)
        parts = base.split("。")
        rows += [(f"{k}a", base), (f"{k}b", "。".join(parts[20:] + parts[:20])), (f"{k}c", base.replace(parts[3], "編集部の注 "))]
        rows += [(f"{k}d", "。".join(parts[:20]) + text(100 + k, 30))]
    rows += [("n", None), ("e", ""), ("p", "。。"), ("s1", "短い"), ("s2", "短い。"), ("0a", text(0))]
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "id string, body string, text int, digest string, uid string")
    got = {tuple(r) for r in N.near_duplicate_pairs(df).collect()}
    known = {i: N.letters(t) for i, t in rows if N.letters(t)}
    want = {(a, b) for a in known for b in known if a < b and N.carried(known[a], known[b]) >= 0.66}
    assert got == want and ("0a", "0b") in got and ("0a", "0d") not in got and ("s1", "s2") in got


def test_links_and_empty(spark):
    df = spark.createDataFrame([("a", text(1)), ("b", text(1)), ("c", text(1).replace("。", "、") + "追記")], "id string, body string")
    got = {r.class_id: (r.rows, r.links) for r in N.story_links(df).collect()}
    assert got == {"a": (2, 1), "c": (1, 1)}
    assert N.near_duplicate_pairs(df.limit(0)).count() == 0


def test_one_bit_segments_are_met(spark):
    sig = N.signature(N.letters(text(5)), 4)
    other = [s ^ (1 << k) for s, k in zip(sig, (0, 5, 31, 31), strict=True)]
    far = [s ^ 0b11 for s in sig]
    df = spark.createDataFrame([(1, sig), (2, other), (3, far)], "uid bigint, signature array<bigint>")
    assert {tuple(r) for r in N.close_signatures(df).collect()} == {(1, 2)} | ({(2, 3)} if any((a ^ b).bit_count() < 2 for a, b in zip(other, far, strict=True)) else set())


def test_replaced_and_inserted_blocks_are_found(spark):
    rows, want = [], set()
    for k in range(30):
        base, new = N.letters(text(k, 20)), N.letters(text(1000 + k, 20))
        at = [(40, 50), (250, 60), (480, 70)] if k % 2 else [(300, 0)]
        other = base
        for i, n in at:
            other = other[:i] + (new[i : i + n] if n else new[:260]) + other[i + n :]
        rows += [(f"{k:02}a", base), (f"{k:02}b", other)]
        assert 0.66 <= N.carried(base, other) < 0.75
        want.add((f"{k:02}a", f"{k:02}b"))
    got = {tuple(r) for r in N.near_duplicate_pairs(spark.createDataFrame(rows, "id string, body string")).collect()}
    assert got == want


def test_shingles_are_counted_over_all_texts(spark):
    bodies = [text(k, 4) for k in range(5)]
    bodies += [bodies[0] + "追記", bodies[1][:70]]
    df = spark.createDataFrame([(t,) for t in bodies], "text string").repartition(3)
    want = np.zeros(1 << N.RARITY_BITS, dtype=np.int64)
    for t in bodies:
        for bucket in {int(h) >> (64 - N.RARITY_BITS) for h in N.shingles(N.letters(t), N.RUN)}:
            want[bucket] += 1
    assert (N.shingle_counts(df) == want).all() and set(want) >= {0, 1, 2}


def test_letters_are_the_alphanumeric_ones():
    assert N.letters("Ａ_b-9 ²ｱ゛ー。①٣́") == "".join(filter(str.isalnum, unicodedata.normalize("NFKC", "Ａ_b-9 ²ｱ゛ー。①٣́").lower()))
