"""A researched candidate turned into a registered player and its child rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugoutline.functions import text as T

# Categories with the codes that players have.
CATEGORY_CODES = {"高校": "high_school", "大学": "university", "社会人": "company", "独立リーグ": "independent", "独立": "independent"}
SEASONS = ("spring", "summer", "fall")


def player_columns(c: DataFrame) -> list[Column]:
    """Columns of a player made of a candidate; rank starts at 0."""
    category = T.category_of(F.col("category"))
    return [
        F.col("id").alias("candidate_id"), F.col("name"), F.col("name_kana"), F.coalesce("team", "team_name").alias("team"), F.coalesce(T.looked_up(CATEGORY_CODES, category), category).alias("category"),
        F.col("draft_year"), F.lit(0).alias("rank_code"), T.positions_of(F.col("positions")).alias("positions"), T.throws_of(F.col("throws")).alias("throw_hand"), T.bats_of(F.col("bats")).alias("bat_hand"),
        F.col("height_cm"), F.col("weight_kg"), F.col("fastball_max"),
    ]


def promotions(candidates: DataFrame, players: DataFrame) -> dict[str, DataFrame]:
    """What promoting the approved, unlinked candidates writes: new players, links to existing ones.

    A candidate is linked to the least player of one name key whose draft year is equal or unknown on a side.
    """
    ready = candidates.where("status = 'approved' and player_id is null")
    c = ready.select("*", T.name_key(F.col("name")).alias("_k")).where("_k <> ''")
    p = players.select(F.col("id").alias("_pid"), T.name_key(F.col("name")).alias("_pk"), F.col("draft_year").alias("_py"))
    known = c.join(p, (F.col("_k") == F.col("_pk")) & (F.col("draft_year").isNull() | F.col("_py").isNull() | (F.col("draft_year") == F.col("_py"))))
    links = known.groupBy(F.col("id").alias("candidate_id")).agg(F.min("_pid").alias("player_id"))
    fresh = c.join(links.select(F.col("candidate_id").alias("id")), "id", "left_anti")
    return {"links": links, "players": fresh.select(*player_columns(fresh))}


def stats_rows(long: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Season lines (ref, season, name, value) of allowed, non-null statistics and valid seasons."""
    return long.where(F.col("season").isin(*SEASONS) & F.col("name").isin(*allowed) & F.col("value").isNotNull())


def merged_by_priority(values: DataFrame, order: dict[str, int]) -> DataFrame:
    """(ref, field, value, source): the value of the best source of each field; unknown sources come last."""
    rank = F.struct(F.coalesce(T.looked_up(order, F.col("source")), F.lit(1000)).alias("r"), F.col("source").alias("s"), F.col("value").alias("v"))
    return values.where("value is not null").groupBy("ref", "field").agg(F.min_by("value", rank).alias("value"), F.min_by("source", rank).alias("source"))


#: Steps of a candidate's research that may follow each other.
STEPS = {"none": ("queued",), "queued": ("researching", "failed"), "researching": ("ready", "failed"), "ready": ("committed", "failed"), "failed": ("queued",), "committed": ()}


def stepped(current: DataFrame, wanted: DataFrame, steps: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(id, status, accepted): the wanted status where it may follow the current one, else the current one."""
    allowed = [F.concat(F.lit(a), F.lit(">"), F.lit(b)) for a, bs in (steps or STEPS).items() for b in bs]
    both = current.join(wanted.select("id", F.col("status").alias("_w")), "id", "left")
    move = F.concat("status", F.lit(">"), "_w")
    ok = F.coalesce(move.isin(*allowed), F.lit(False))
    return both.select("id", F.when(ok, F.col("_w")).otherwise(F.col("status")).alias("status"), ok.alias("accepted"))


PAYLOAD = "struct<player: map<string, string>, stats: array<map<string, string>>, achievements: array<map<string, string>>>"
# Fields of a season line and of an honour that are stored.
STATS_FIELDS = (
    "year", "season", "tournament", "games", "innings", "era", "strikeouts", "strikeouts_per_9", "whip", "hits_allowed", "batting_avg_against", "earned_runs", "walks", "hit_by_pitch",
    "walks_plus_hit_by_pitch", "at_bats", "hits", "doubles", "triples", "home_runs", "rbis", "steals", "sacrifice_flies", "batter_strikeouts", "avg", "obp", "slg", "ops",
)
ACHIEVEMENT_FIELDS = ("type", "year", "tournament_name", "result")


def committed(payloads: DataFrame, known: DataFrame) -> dict[str, DataFrame]:
    """What committing researched candidates writes: ``players``, ``stats``, ``achievements`` and ``links``.

    ``payloads``: candidate_id, status, player_id, payload (JSON). Candidates that are promoted or have a player, and those
    whose payload is no JSON or has no player, are left out. One with the name key of a ``known`` player (player_id,
    name, draft_year), whose year is equal or unknown on a side, is only linked to the least of them; a new player
    has the candidate's id.
    """
    ready = payloads.where("player_id is null and status <> 'promoted'").select("candidate_id", F.from_json("payload", PAYLOAD).alias("_p")).where("size(_p.player) > 0")
    own = ready.select("candidate_id", "_p", T.name_key(F.col("_p.player")["name"]).alias("_k"), F.col("_p.player")["draft_year"].try_cast("int").alias("_y"))
    there = known.select(F.col("player_id").alias("_pid"), T.name_key(F.col("name")).alias("_pk"), F.col("draft_year").alias("_py")).where("_pk <> ''")
    met = own.join(there, (F.col("_k") == F.col("_pk")) & (F.col("_y").isNull() | F.col("_py").isNull() | (F.col("_y") == F.col("_py"))))
    linked = met.groupBy("candidate_id").agg(F.min("_pid").alias("player_id"))
    fresh = own.join(linked.select("candidate_id"), "candidate_id", "left_anti")
    entries = lambda c: F.array_sort(F.map_entries(F.map_filter(c, lambda k, v: v.isNotNull())))

    def lines(part: str, fields: tuple[str, ...], keep=None) -> DataFrame:
        rows = fresh.select(F.col("candidate_id").alias("player_id"), F.col("_p.player")["category"].alias("_c"), F.posexplode(f"_p.{part}").alias("pos", "_m"))
        rows = rows if keep is None else rows.where(keep)
        return rows.select("player_id", "pos", "_c", F.inline(entries(F.map_filter("_m", lambda k, v: k.isin(*fields)))).alias("name", "value"))

    stats = lines("stats", STATS_FIELDS, F.col("_m")["season"].isin(*SEASONS)).withColumn("period", F.coalesce(T.looked_up(CATEGORY_CODES, F.col("_c")), F.col("_c"))).drop("_c")
    players = fresh.select(F.col("candidate_id").alias("player_id"), F.col("_p.player")["name"].alias("name"), F.col("_y").alias("draft_year"), F.lit(0).alias("rank_code"))
    links = linked.unionByName(fresh.select("candidate_id", F.col("candidate_id").alias("player_id")))
    return {"players": players, "stats": stats, "achievements": lines("achievements", ACHIEVEMENT_FIELDS).drop("_c"), "links": links}
