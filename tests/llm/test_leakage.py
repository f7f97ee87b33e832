import random

from dugoutline.llm import leakage as L


def sentence(r):
    return "".join(chr(0x3042 + r.randrange(60)) if r.random() < 0.5 else chr(0x4E00 + r.randrange(4000)) for _ in range(60))


def test_leaks(spark):
    r = random.Random(2)
    items = {i: [sentence(r) for _ in range(6)] for i in range(30)}
    filler = lambda n: "。".join(sentence(r) for _ in range(n))
    docs, want = [], set()
    for i in range(20):
        docs.append((i, filler(5) + "。" + "。".join(items[i][:4]) + "。" + filler(3)))
        want.add((i, i))
    docs.append((50, filler(3) + items[3][0] + filler(3)))
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in "。\n ".join(items[4]).upper())
    docs += [(51, wide), (52, None), (53, ""), (54, "あ"), (0, docs[0][1]), (55, filler(2000) + "。".join(s[:20] + "訂" + s[21:] for s in items[5]))]
    want |= {(51, 4), (55, 5)}
    documents = spark.createDataFrame([(a, b, 1, 0.5) for a, b in docs], "doc_id bigint, text string, item_id int, coverage double")
    evals = spark.createDataFrame([(i, "。".join(s), "ja") for i, s in items.items()] + [(90, None, "ja"), (91, "", "ja"), (92, "短", "ja")], "item_id int, passage string, lang string")
    assert {(x.doc_id, x.item_id) for x in L.leaked_items(documents, evals).collect()} == want
    assert {(x.doc_id, x.item_id) for x in L.leaked_items(documents, evals, block_chars=3000).collect()} == want
    assert L.leaked_items(documents.limit(0), evals).count() == 0
    assert L.leaked_items(documents, evals.limit(0)).count() == 0


def test_weights_do_not_depend_on_blocks(spark):
    r = random.Random(4)
    items = [(i, "。".join(sentence(r) if r.random() < 0.6 else "同じ一文がどの項目にも入っている長めの例文である" for _ in range(4))) for i in range(12)]
    terms = L.item_terms(spark.createDataFrame(items, "item_id int, passage string")).toPandas()
    df = terms.groupby("term").item_id.nunique()
    whole = L.Index(items, 0.45)
    weight = {(int(whole.terms[t]), whole.ids[whole.post_item[j]]): whole.post_w[j] for t in range(len(whole.terms)) for j in range(whole.post_at[t], whole.post_at[t + 1])}
    every = len(items), terms.tf.sum() / len(items), df.to_dict()
    for part in (items[:5], items[5:]):
        own = L.Index(part, 0.45, every)
        for t in range(len(own.terms)):
            for j in range(own.post_at[t], own.post_at[t + 1]):
                assert abs(own.post_w[j] - weight[int(own.terms[t]), own.ids[own.post_item[j]]]) < 1e-9
