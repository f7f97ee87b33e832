import random

from dugoutline.llm import quality as Q
from hypothesis import given, settings
from hypothesis import strategies as st


def test_statistics_do_not_depend_on_chunks(spark):
    r = random.Random(3)
    alphabet = "ああはが漢字、。\n\n  abcXYZ12|\t-*<b>longlonglonglonglonglonglonglong"
    texts = ["".join(r.choice(alphabet) for _ in range(n)) for n in (0, 1, 5, 99, 100, 101, 700, 2000)] + ["\n" * 250, "x" * 333, None]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, source string, chars int")
    whole = {x.doc_id: x.asDict() for x in Q.text_statistics(df).collect()}
    cut = {x.doc_id: x.asDict() for x in Q.text_statistics(df, chunk=70, run=3).collect()}
    for i in whole:
        for c in Q.COUNTS:
            assert whole[i][c] == cut[i][c], (i, c)


def test_blocks_are_compressed_wherever_chunks_are_cut(monkeypatch):
    monkeypatch.setattr(Q, "BLOCK", 50)
    text = "".join(random.Random(4).choice("abあい ") for _ in range(333))
    for chunk in (1, 7, 50, 64, 400):
        assert sum(Q.squeezed_size(text, at, min(len(text), at + chunk)) for at in range(0, len(text), chunk)) == Q.squeezed_size(text, 0, len(text))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="あは。漢a1 \n-", max_size=40), min_size=1, max_size=6))
def test_counts_against_plain_python(texts):
    got = Q.chunk_counts([""] * len(texts), texts, [""] * len(texts))
    for i, t in enumerate(texts):
        assert got["chars"][i] == len(t)
        assert got["particles"][i] == sum(c in Q.PARTICLES for c in t)
        assert got["digits"][i] == t.count("1")
        assert got["words"][i] == len([w for w in "".join(c if c == "a" else " " for c in t).split()])


def test_kinds(spark):
    prose = ["監督は試合後に、選手の動きがよくなったと語った。次の試合では先発を任せる方針だという。" * 3, "The coach said the pitcher was better than before. He will start the next game on Sunday, and they expect a lot." * 3]
    junk = ["| 名 | 打 |\n|---|---|\n| 甲 | 12 |\n" * 5, "- 投手\n- 捕手\n- 外野手\n" * 6]
    docs = [(i, (prose if i % 2 else junk)[i // 2 % 2] + str(i)) for i in range(40)]
    df = spark.createDataFrame(docs + [(100, None), (101, "")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, "prose" if i % 2 else "table", "x") for i in range(30)] + [(1, "prose", "y"), (2, None, "y")], "doc_id bigint, label string, annotator string")
    got = {r.doc_id: r.is_prose for r in Q.text_kinds(df, labels).collect()}
    assert all(got[i] == bool(i % 2) for i in range(40)) and len(got) == 42
    without = {r.doc_id: r.is_prose for r in Q.text_kinds(df, labels.limit(0)).collect()}
    assert sum(without[i] == bool(i % 2) for i in range(40)) >= 30
    assert Q.text_kinds(df.limit(0), labels).count() == 0


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/doc_labels.parquet")
    held = labels.where("pmod(hash(doc_id), 2) = 0").select("doc_id", "label").distinct()
    got = Q.text_kinds(docs.join(labels.select("doc_id").distinct(), "doc_id"), labels.where("pmod(hash(doc_id), 2) = 1")).join(held, "doc_id")
    right = got.where("is_prose = (label = 'prose')").count()
    assert right / got.count() > 0.98
