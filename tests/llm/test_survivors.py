from datetime import datetime

from dugoutline.llm import survivors as S

SCHEMA = "id string, player_id string, name string, team string, status string, source_count int, created_at timestamp, name_kana string, category string, school_year string, positions array<string>, throws string, bats string, height_cm int, weight_kg int, birth_date date, fastball_max int, description string, field string, value string, vote int"


def row(id_, player=None, name="A", team="T", status="pending", n=1, at=datetime(2024, 1, 1), kana=None, positions=None, throws=None, height=None):
    return (id_, player, name, team, status, n, at, kana, None, None, positions, throws, None, height, None, None, None, None, "f", "v", 1)


def test_merge_order_and_fill(spark):
    rows = [
        row("c", status="approved", kana=" ", positions=[]), row("b", status="approved", n=None, kana="かな", positions=["投手"]), row("a", status="approved", n=1, at=None, kana="別"), row("z", player="p", status="rejected", height=None),
        row("y", status="promoted", height=180, throws=""), row("q", name="B"), row("r", team=None), row("s", team=None), row("t", name=None), row("u", name=None),
    ]
    got = {tuple(r) for r in S.merged_fields(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("z", "id", "z"), ("z", "height_cm", "y"), ("z", "name_kana", "a"), ("z", "positions", "b")}


def test_ties_go_to_the_least_id_and_empty_table(spark):
    rows = [row("b"), row("a"), row("a")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in S.merged_fields(df).collect()} == {("a", "id", "a")}
    assert S.merged_fields(df.limit(0)).count() == 0


def test_votes_add_up(spark):
    rows = [row("a", status="promoted", kana="あ"), row("b", status="approved", kana="い"), row("c", status="approved", kana="い ")]
    best = S.survivors(spark.createDataFrame(rows, SCHEMA)).first()
    assert best.copies == 3 and best.name_kana.value == "い" and best.name_kana.from_id == "b"
