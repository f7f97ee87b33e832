"""Evidence linked to people and rolled up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugoutline.functions import text as T
from dugoutline.operators.dedup import first_by


def not_stored(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not stored; null key parts count as ''."""
    key = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    return new.select("*", *key).join(stored.select(*key).distinct(), names, "left_anti").drop(*names)


def merged_by_key(stored: DataFrame, new: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Upsert: new rows replace stored ones of the same key but keep their values of ``keep``."""
    old = stored.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep])
    fresh = new.join(old, keys, "left").select(*[F.coalesce(F.col(f"_old_{c}"), F.col(c)).alias(c) if c in keep else F.col(c) for c in new.columns])
    return stored.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)


def by_article_priority(signals: DataFrame, sources: DataFrame) -> DataFrame:
    """Signals with the person of their URL: of ``sources`` (url, player_id, candidate_id, created_at, id) the
    registered players come first, then the oldest row."""
    order = F.struct(F.col("player_id").isNull(), F.col("created_at").isNull(), F.col("created_at"), F.col("id"))
    best = sources.where("url is not null").groupBy("url").agg(F.min_by(F.struct("player_id", "candidate_id"), order).alias("_p"))
    return signals.join(best, "url", "left").select(*signals.columns, F.col("_p.player_id").alias("player_id"), F.col("_p.candidate_id").alias("candidate_id"))


def comment_candidates(comments: DataFrame, sources: DataFrame) -> DataFrame:
    """Unlinked comments with the least candidate whose source has their URL and whose name key is theirs."""
    loose = comments.where("player_id is null").select("id", F.col("source_url").alias("url"), T.name_key(F.col("player_name")).alias("key")).where("key <> ''")
    known = sources.select("url", T.name_key(F.col("name")).alias("key"), "candidate_id").where("key <> ''")
    return loose.join(known, ["url", "key"]).groupBy("id").agg(F.min("candidate_id").alias("candidate_id"))


def source_rollup(sources: DataFrame) -> DataFrame:
    """(candidate_id, source_count, latest_url, latest_confidence) of each candidate's sources."""
    newest = F.struct(F.col("created_at"), F.col("id"))
    return sources.groupBy("candidate_id").agg(F.count("*").alias("source_count"), F.max_by("url", newest).alias("latest_url"), F.max_by("confidence", newest).alias("latest_confidence"))


def promoted_links(children: DataFrame, promotions: DataFrame) -> DataFrame:
    """Children of promoted candidates with the player where they had none."""
    p = promotions.select(F.col("candidate_id").alias("_c"), F.col("player_id").alias("_new"))
    return children.join(p, F.col("player_candidate_id") == F.col("_c"), "left").select(*[F.coalesce("player_id", "_new").alias("player_id") if c == "player_id" else F.col(c) for c in children.columns])


def all_team_expansion(items: DataFrame, teams: DataFrame) -> DataFrame:
    """Items (url, player, team) with team 'all' expanded to every team not named for the player in the article.

    ``teams`` (team) is the short fixed list of clubs; it is multiplied as an array, not joined.
    """
    named = items.where("team <> 'all'")
    clubs = teams.agg(F.array_sort(F.collect_set("team")).alias("_t"))
    spread = items.where("team = 'all'").select("url", "player").distinct().join(F.broadcast(clubs)).select("url", "player", F.explode("_t").alias("team"))
    return named.select("url", "player", "team").distinct().unionByName(spread.join(named, ["url", "player", "team"], "left_anti"))


def derived_visits(comments: DataFrame, visits: DataFrame) -> DataFrame:
    """Undated visits told by comments: the first comment of each (url, player, team) not among ``visits``."""
    told = comments.where("team is not null and team <> ''")
    fresh = told.join(visits.select("url", "player", "team").distinct(), ["url", "player", "team"], "left_anti")
    return first_by(fresh, ["url", "player", "team"], F.struct("seq"))


def name_lookup(names: DataFrame, players: DataFrame) -> DataFrame:
    """(name, player_id) by the name without spaces, else by the reading; ties to the least id."""
    bare = lambda c: F.nullif(F.regexp_replace(c, T.SPACE, ""), F.lit(""))
    asked = names.select("name").distinct().withColumn("_k", bare(F.col("name")))
    known = players.select(F.col("id"), bare(F.col("name")).alias("_k"), F.lit(1).alias("_p")).unionByName(players.select(F.col("id"), bare(F.col("name_kana")).alias("_k"), F.lit(2).alias("_p"))).where("_k is not null")
    best = known.groupBy("_k").agg(F.min_by("id", F.struct("_p", "id")).alias("player_id"))
    return asked.join(best, "_k", "left").select("name", "player_id")


def representative_per_pair(comments: DataFrame, ref: Column, team: Column) -> DataFrame:
    """(ref, team, id): the comment with a URL, then the latest one, of each person and club."""
    rows = comments.select(ref.alias("ref"), team.alias("team"), "id", "source_url", "published_at").where("ref is not null and team is not null")
    rank = F.struct(F.coalesce(F.col("source_url"), F.lit("")) != "", F.coalesce(F.col("published_at"), F.lit("")), F.col("id"))
    return rows.groupBy("ref", "team").agg(F.max_by("id", rank).alias("id"))


def event_dates(items: DataFrame, visits: DataFrame) -> DataFrame:
    """Items (id, url, player, published) with ``event_date``: the first dated visit of their URL and player, else
    the day they were published."""
    known = visits.where("event_date is not null").groupBy("url", "player").agg(F.min_by("event_date", F.struct("seq")).alias("_visit"))
    return items.join(known, ["url", "player"], "left").select(*items.columns, F.coalesce("_visit", "published").alias("event_date"))


def missing_pairs(wanted: DataFrame, stored: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct pairs not stored yet."""
    return wanted.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct().join(stored.select(a, b).distinct(), [a, b], "left_anti")


def declared(players: DataFrame, matched: DataFrame) -> DataFrame:
    """Players with ``declared`` set for those matched (player_id)."""
    hit = matched.select(F.col("player_id").alias("id"), F.lit(True).alias("_hit")).where("id is not null").distinct()
    return players.join(hit, "id", "left").withColumn("declared", F.coalesce("_hit", "declared", F.lit(False))).drop("_hit")


def backfilled(children: DataFrame, sources: DataFrame) -> DataFrame:
    """Unlinked children with the least candidate of their URL."""
    best = sources.where("url is not null").groupBy("url").agg(F.min("candidate_id").alias("_c"))
    free = F.col("player_id").isNull() & F.col("player_candidate_id").isNull()
    return children.join(best, children["source_url"] == best["url"], "left").select(*[F.when(free, F.col("_c")).otherwise(F.col(c)).alias(c) if c == "player_candidate_id" else children[c] for c in children.columns])


def name_lookup_anywhere(names: DataFrame, players: DataFrame) -> DataFrame:
    """``name_lookup``, and for the names it doesn't find the least player whose name or reading holds the name.

    What a player's name holds are its parts, so the search is a join on equal parts, in lower case.
    """
    found = name_lookup(names, players)
    lower = lambda c: F.lower(F.col(c))
    parts = lambda c: F.flatten(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.transform(F.sequence(F.lit(1), F.length(c) - i + 1), lambda n: F.substring(c, i, n))))
    said = players.select("id", F.explode(F.array(lower("name"), lower("name_kana"))).alias("said")).where("said <> ''")
    held = said.select("id", F.explode(F.array_distinct(parts(F.col("said")))).alias("_part")).groupBy("_part").agg(F.min("id").alias("_id"))
    bare = F.lower(F.regexp_replace("name", T.SPACE, ""))
    asked = found.where("player_id is null").select("name", F.nullif(bare, F.lit("")).alias("_part")).join(held, "_part", "left")
    return found.where("player_id is not null").unionByName(asked.select("name", F.col("_id").alias("player_id")))


def insert_report(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """(told, repeated, stored, inserted): what becomes of rows inserted one by one under a unique key."""
    key = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    counted = new.select(*key).groupBy(*names).agg(F.count("*").alias("n")).join(stored.select(*key).distinct().withColumn("_s", F.lit(1)), names, "left")
    return counted.agg(F.sum("n").alias("told"), F.sum(F.col("n") - 1).alias("repeated"), F.count("_s").alias("stored"), F.count_if(F.col("_s").isNull()).alias("inserted"))


def since_mark(rows: DataFrame, marks: DataFrame, at: str, now: str, hours: int = 30) -> DataFrame:
    """Rows made after the last mark; where there is no mark, in the last ``hours`` before ``now``."""
    mark = marks.agg(F.coalesce(F.max(at), F.lit(now).cast("timestamp") - F.expr(f"interval {hours} hours")).alias("_mark"))
    return rows.join(F.broadcast(mark), F.col(at) > F.col("_mark")).drop("_mark")
