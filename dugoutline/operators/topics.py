"""Signals gathered into topics, with a summary and an importance score."""

from __future__ import annotations

from collections import defaultdict, deque
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugoutline.functions import text as T
from dugoutline.functions import values as V
from dugoutline.operators.graph import components

NEAR_DAYS = 3
NEWEST = 20


def topic_type(text: Column, player: Column) -> Column:
    """A meeting that is reported, else a linked player, else a word of meetings, else other."""
    return F.when(T.contains_any(text, V.MEETING_EVENTS), "scout_meeting").when(F.coalesce(player, F.lit("")) != "", "player_watch").when(T.contains_any(text, V.MEETING_WORDS), "scout_meeting").otherwise("other")


def keyed_signals(signals: DataFrame) -> DataFrame:
    """Signals (id, title, evidence, player_key, team, year, day) with topic_type and topic_key; a type whose key
    lacks a part becomes 'other'."""
    text = F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("evidence", F.lit("")))
    out = signals.withColumn("_type", topic_type(text, F.col("player_key")))
    key = T.topic_key(F.col("_type"), year=F.col("year"), player=F.col("player_key"), date=F.col("day"), team=F.col("team"))
    key = F.when(F.col("_type") != "other", key)
    other = F.concat(F.lit("other:"), T.title_hash(F.col("title"), F.col("evidence")))
    return out.withColumn("_key", key).select(*signals.columns, F.when(F.col("_key").isNull(), "other").otherwise(F.col("_type")).alias("topic_type"), F.coalesce("_key", other).alias("topic_key"))


def near_topics(signals: DataFrame, topics: DataFrame, days: int = NEAR_DAYS) -> DataFrame:
    """(signal_id, topic_id): the newest topic of the type and player with an event within ``days`` of the signal.

    ``signals``: signal_id, topic_type, player, day; ``topics``: topic_id, topic_type, player, event_day, created_at.
    """
    s, t = signals.alias("s"), topics.alias("t")
    met = s.join(t, (F.col("s.topic_type") == F.col("t.topic_type")) & (F.col("s.player") == F.col("t.player")) & (F.abs(F.datediff("s.day", "t.event_day")) <= days))
    return met.groupBy("signal_id").agg(F.max_by("topic_id", F.struct("created_at", "topic_id")).alias("topic_id"))


def nearest_topics(signals: DataFrame, topics: DataFrame, days: int = NEAR_DAYS, newest: int = NEWEST) -> DataFrame:
    """(signal_id, topic_id): of the ``newest`` open topics of the signal's type and player the newest with an event within
    ``days``; of a signal without a day the newest.

    ``signals``: signal_id, topic_type, player, day; ``topics``: topic_id, topic_type, player, status, created_at, event_days.
    """
    rank = F.row_number().over(Window.partitionBy("topic_type", "player").orderBy(F.desc("created_at"), F.desc("topic_id")))
    open_ = topics.where("status in ('draft', 'reviewed') and player is not null").withColumn("_rank", rank).where(F.col("_rank") <= newest)
    met = signals.join(open_, ["topic_type", "player"]).where(F.col("day").isNull() | F.exists("event_days", lambda e: F.abs(F.datediff(F.col("day"), e)) <= days))
    return met.groupBy("signal_id").agg(F.min_by("topic_id", "_rank").alias("topic_id"))


def summarised(members: DataFrame, visits: DataFrame) -> DataFrame:
    """One row per topic of its signals (topic, url, title, source, day, evidence, team_count, person_count, team_keys, has_mlb,
    score, meeting, seq) and visits (topic, team): largest counts, clubs of both, events once by day and text,
    sources with the title first seen, importance.
    """
    first = F.min_by(F.struct("title", "source"), "seq")
    sources = members.where("url is not null").groupBy("topic", "url").agg(first.alias("_m")).select("topic", F.struct("url", "_m.title", "_m.source").alias("_s")).groupBy("topic").agg(F.array_sort(F.collect_list("_s")).alias("sources"))
    told = members.where("evidence <> ''").select("topic", F.struct(F.coalesce(F.col("day").cast("string"), F.lit("")).alias("date"), F.col("evidence").alias("summary")).alias("_e")).distinct().groupBy("topic").agg(F.array_sort(F.collect_list("_e")).alias("events"))
    clubs = members.select("topic", F.explode("team_keys").alias("k")).unionByName(visits.where("team <> ''").select("topic", F.col("team").alias("k"))).groupBy("topic").agg(F.array_sort(F.collect_set("k")).alias("teams"))
    base = members.groupBy("topic").agg(F.max("team_count").alias("team_count"), F.max("person_count").alias("person_count"), F.bool_or("has_mlb").alias("has_mlb"), F.max("score").alias("_score"), F.bool_or("meeting").alias("_meeting"))
    every = base.join(sources, "topic", "left").join(told, "topic", "left").join(clubs, "topic", "left")
    return every.withColumn("importance", importance(F.col("_score"), F.greatest(F.size("sources"), F.lit(0)), F.col("_meeting"))).drop("_score", "_meeting")


def merged_urls(topics: DataFrame, new: DataFrame) -> DataFrame:
    """Topics (topic, urls) with the urls of new signals (topic, url, seq) behind theirs, each once; a url that is there
    changes nothing, so a batch that is run again does not either."""
    more = new.where("url is not null").groupBy("topic", "url").agg(F.min("seq").alias("seq")).groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("seq", "url"))).alias("_new"))
    none = F.array().cast("array<string>")
    return topics.join(more, "topic", "full_outer").select("topic", F.array_distinct(F.concat(F.coalesce("urls", none), F.coalesce(F.transform("_new", lambda x: x["url"]), none))).alias("urls"))


def importance(score: Column, sources: Column, meeting: Column) -> Column:
    return score + F.greatest(F.lit(0), F.least(sources - 1, F.lit(3))) + F.when(meeting, 2).otherwise(0)


def summaries(members: DataFrame) -> DataFrame:
    """One row per topic_key of members (topic_key, url, team_count, person_count, team, has_mlb, score, day, meeting)."""
    return members.groupBy("topic_key").agg(
        F.max("team_count").alias("team_count"), F.max("person_count").alias("person_count"), F.bool_or("has_mlb").alias("has_mlb"),
        F.array_join(F.array_sort(F.collect_set("team")), ",").alias("teams"), F.array_join(F.array_sort(F.collect_set(F.col("day").cast("string"))), ",").alias("days"),
        F.countDistinct("url").alias("sources"), importance(F.max("score"), F.countDistinct("url").cast("int"), F.bool_or("meeting")).alias("importance"),
    )


def replay(rows: list[tuple], days: int = NEAR_DAYS, newest: int = NEWEST) -> list[tuple]:
    """(signal_id, topic) of signals (signal_id, type, key, player_id, name, url, days of the url) taken in order.

    A signal joins the topic of its key, else the newest of the last ``newest`` of its type and player with an
    event near its day (without a day the newest), else opens one. A topic's events are the days of all its urls.
    """
    of: dict[tuple, deque] = defaultdict(lambda: deque(maxlen=newest))
    by_key: dict[str, dict] = {}
    out = []
    for sid, kind, key, player, name, url, day, url_days in rows:
        topic = by_key.get(key)
        if topic is None and (player or name):
            same = list(reversed(of[kind, player, None] if player else of[kind, None, name]))[:newest]
            if day is None:
                topic = same[0] if same else None
            else:
                topic = next((t for t in same if any(abs((d - day).days) <= days for d in t["days"])), None)
        if topic is None:
            topic = {"id": sid, "type": kind, "player": player, "name": name, "urls": set(), "days": set()}
            of[kind, player, None].append(topic)
            of[kind, None, name].append(topic)
            by_key.setdefault(key, topic)
        if url not in topic["urls"]:
            topic["urls"].add(url)
            topic["days"] |= set(url_days)
        out.append((sid, topic["id"]))
    return out


def sequential_topics(signals: DataFrame) -> DataFrame:
    """(signal_id, topic): topics assigned one signal after the other, by creation.

    ``signals``: signal_id, topic_type, topic_key, player_id, player_name, url, day, created_at. Signals that may
    influence each other share a token (key, type and player, type and name); each component of tokens is
    replayed on its own. A url's events are the days of all signals with it.
    """
    keyed = signals.withColumn("_tokens", F.array_compact(F.array(F.concat(F.lit("k:"), "topic_key"), F.concat(F.lit("p:"), "topic_type", F.lit(":"), "player_id"), F.concat(F.lit("n:"), "topic_type", F.lit(":"), "player_name"))))
    edges = keyed.select(F.col("_tokens")[0].alias("a"), F.explode("_tokens").alias("b"))
    parts = components(edges, "a", "b")
    days = signals.groupBy("url").agg(F.array_sort(F.collect_set("day")).alias("url_days"))
    rows = keyed.withColumn("_a", F.col("_tokens")[0]).join(parts, F.col("_a") == F.col("node"), "left").join(days, "url", "left").withColumn("_part", F.coalesce("component", "_a"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["created_at", "signal_id"], kind="stable")
        as_day = lambda d: None if d is None or d != d else d if isinstance(d, date) else pd.Timestamp(d).date()
        rows = [(r.signal_id, r.topic_type, r.topic_key, r.player_id, r.player_name, r.url, as_day(r.day), [as_day(d) for d in r.url_days]) for r in part.itertuples()]
        return pd.DataFrame(replay(rows), columns=["signal_id", "topic"])

    kind = dict(signals.dtypes)["signal_id"]
    return rows.select("_part", "signal_id", "topic_type", "topic_key", "player_id", "player_name", "url", "day", "url_days", "created_at").groupBy("_part").applyInPandas(run, f"signal_id {kind}, topic {kind}")
