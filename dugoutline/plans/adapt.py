"""The test tables as the tables the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugoutline.functions import text as T
from dugoutline.session import table


def articles(spark, d) -> DataFrame:
    return table(spark, d, "crawled_articles")


def comments(spark, d) -> DataFrame:
    return table(spark, d, "scout_comments")


def candidates(spark, d) -> DataFrame:
    return table(spark, d, "player_candidates")


def people(spark, d) -> DataFrame:
    """Registered people with their match keys."""
    p = table(spark, d, "players")
    return p.select("*", T.name_key(F.col("name")).alias("name_key"), T.kana_key(F.col("name_kana")).alias("kana_key"), T.school_match_key(F.col("team")).alias("school_key"), F.col("draft_year").alias("year"))


def entries(spark, d) -> DataFrame:
    """Roster entries with their match keys."""
    e = table(spark, d, "roster_entries")
    return e.select("*", T.name_key(F.col("name")).alias("name_key"), T.kana_key(F.col("name_kana")).alias("kana_key"), T.school_match_key(F.col("school")).alias("school_key"), F.col("season").alias("year"))


def visits(spark, d) -> DataFrame:
    """Visits as comments tell them: (id, ref, team, event_date, aggregator, created_at)."""
    c = comments(spark, d)
    ref = F.coalesce("player_id", F.concat(F.lit("c:"), "player_candidate_id"), F.concat(F.lit("n:"), "player_name"))
    return c.select("id", ref.alias("ref"), F.coalesce("team_name", F.lit("")).alias("team"), F.substring("published_at", 1, 10).alias("event_date"), F.coalesce(F.col("source_url").contains("matome.example"), F.lit(False)).cast("int").alias("aggregator"), "created_at").where("ref is not null")


def evidence(spark, d) -> DataFrame:
    """Sources of candidates: (id, candidate_id, player_id, name, article_id, url, confidence, created_at)."""
    c = candidates(spark, d)
    return c.select("id", F.col("id").alias("candidate_id"), "player_id", "name", F.col("crawled_article_id").alias("article_id"), F.col("latest_source_url").alias("url"), F.col("latest_confidence").alias("confidence"), "created_at")


def day_signals(spark, d) -> DataFrame:
    """events as signals: (signal_id, topic_type, player_id, day, ts)."""
    e = table(spark, d, "events")
    return e.select(F.col("event_id").alias("signal_id"), F.col("event_type").alias("topic_type"), F.col("user_id").cast("string").alias("player"), F.to_date("ts").alias("day"), "ts")


def staff(spark, d) -> tuple[str, ...]:
    """Names of the scouts without spaces; the table is a short fixed list that doesn't grow."""
    names = table(spark, d, "scouts").select(F.regexp_replace("scout_name", T.SPACE, "").alias("n")).where("n <> ''").distinct().orderBy("n")
    return tuple(r["n"] for r in names.collect())
