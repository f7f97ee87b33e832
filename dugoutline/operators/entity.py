"""Roster entries matched to registered people by a cascade of keys, and suggestions for the unmatched."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugoutline.functions import text as T
from dugoutline.operators.dedup import ratio


def compatible(a: Column, b: Column) -> Column:
    """Equal schools, or one's key within the other's; False where either is blank."""
    return F.coalesce((a != "") & (b != "") & (a.contains(b) | b.contains(a)), F.lit(False))


def match_cascade(entries: DataFrame, players: DataFrame) -> DataFrame:
    """(entry_id, status, player_id, matched_by, warnings) of each entry.

    ``entries``: entry_id, name_key, kana_key, school_key, category, year; ``players`` the same with id. Those of
    one name, else of one reading, are narrowed by school, category and year, a step counting only if it leaves
    any; one left is a match, more are ambiguous.
    """
    e = entries.select("entry_id", "name_key", "kana_key", *[F.col(c).alias(f"e_{c}") for c in ("school_key", "category", "year")])
    p = players.select(F.col("id").alias("player_id"), F.col("name_key").alias("p_name"), F.col("kana_key").alias("p_kana"), *[F.col(c).alias(f"p_{c}") for c in ("school_key", "category", "year")])
    by_name = e.where("name_key <> ''").join(p, F.col("name_key") == F.col("p_name")).withColumn("how", F.lit("name"))
    rest = e.join(by_name.select("entry_id").distinct(), "entry_id", "left_anti").where("kana_key <> ''")
    by_kana = rest.join(p, F.col("kana_key") == F.col("p_kana")).withColumn("how", F.lit("kana"))
    found = by_name.unionByName(by_kana)
    w = Window.partitionBy("entry_id")
    same_school = compatible(F.col("e_school_key"), F.col("p_school_key"))
    found = found.withColumn("ok", same_school).withColumns({"n": F.count("*").over(w), "any": F.max("ok").over(w)})
    found = found.where((F.col("n") == 1) | ~F.col("any") | F.col("ok")).withColumn("matched_by", F.when((F.col("n") > 1) & F.col("any"), F.concat("how", F.lit("+school"))).otherwise(F.col("how")))
    for field in ("category", "year"):
        same = F.coalesce(F.col(f"e_{field}") == F.col(f"p_{field}"), F.lit(False))
        found = found.withColumn("ok", same).withColumns({"n": F.count("*").over(w), "any": F.max("ok").over(w)}).where((F.col("n") == 1) | ~F.col("any") | F.col("ok"))
    found = found.withColumn("n", F.count("*").over(w))
    school_differs = (F.col("e_school_key") != "") & (F.col("p_school_key") != "") & ~same_school
    warn = F.array_compact(F.array(F.when(school_differs, "school"), F.when(F.col("e_category") != F.col("p_category"), "category"), F.when(F.col("e_year") != F.col("p_year"), "year")))
    one = found.groupBy("entry_id").agg(F.max("n").alias("n"), F.min("player_id").alias("player_id"), F.min("matched_by").alias("matched_by"), F.first(F.array_join(warn, ",")).alias("warnings"))
    out = e.select("entry_id").join(one, "entry_id", "left")
    single = F.col("n") == 1
    return out.select("entry_id", F.when(F.col("n").isNull(), "unmatched").when(single, "matched").otherwise("ambiguous").alias("status"), F.when(single, F.col("player_id")).alias("player_id"), F.when(single, F.col("matched_by")).alias("matched_by"), F.when(single, F.col("warnings")).alias("warnings"))


def compatible_schools(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b): school keys of either side one of which is a part of the other."""
    parts = lambda c: F.flatten(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.transform(F.sequence(F.lit(1), F.length(c) - i + 1), lambda n: F.substring(F.col(c), i, n))))
    a, b = left.where("school <> ''").select(F.col("school").alias("a")).distinct(), right.where("school <> ''").select(F.col("school").alias("b")).distinct()
    within = a.select("a", F.explode(F.array_distinct(parts("a"))).alias("part")).join(b, F.col("part") == F.col("b")).select("a", "b")
    around = b.select("b", F.explode(F.array_distinct(parts("b"))).alias("part")).join(a, F.col("part") == F.col("a")).select("a", "b")
    return within.unionByName(around).distinct()


def suggestions(entries: DataFrame, players: DataFrame, limit: int = 3) -> DataFrame:
    """(entry_id, player_id, similarity, same_school, rank): registered people whose name is close, of a
    compatible school or the same category, best first.

    Compatible schools are found first, among the distinct ones: the key of one is a part of the other's, so it is
    equal to one of its parts. People at such schools meet there if they share a letter; a name of the same category only
    needs a ratio of 0.85, which two names without a common pair of letters can't have. ``limit`` is the report's length.
    """
    e = entries.where("name_key <> ''").select("entry_id", F.col("name_key").alias("e_name"), F.col("school_key").alias("e_school"), F.col("category").alias("e_category"))
    p = players.where("name_key <> ''").select(F.col("id").alias("player_id"), F.col("name_key").alias("p_name"), F.col("school_key").alias("p_school"), F.col("category").alias("p_category"))
    schools = compatible_schools(e.select(F.col("e_school").alias("school")), p.select(F.col("p_school").alias("school")))
    letters = lambda c: F.explode(F.array_distinct(F.split(c, "")))
    pairs = lambda c: F.explode(F.array_distinct(F.when(F.length(c) > 1, F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2)))).otherwise(F.array(F.col(c)))))
    near_by = e.join(schools.withColumnRenamed("a", "e_school"), "e_school").select("entry_id", F.col("b").alias("school"), letters("e_name").alias("c")).join(p.select("player_id", F.col("p_school").alias("school"), letters("p_name").alias("c")), ["school", "c"]).select("entry_id", "player_id").distinct().withColumn("same_school", F.lit(True))
    kind = lambda c: F.coalesce(c, F.lit(""))
    alike = e.select("entry_id", kind("e_category").alias("k"), pairs("e_name").alias("c")).join(p.select("player_id", kind("p_category").alias("k"), pairs("p_name").alias("c")), ["k", "c"]).select("entry_id", "player_id").distinct()
    met = near_by.unionByName(alike.withColumn("same_school", F.lit(False))).groupBy("entry_id", "player_id").agg(F.max("same_school").alias("same_school"))
    near = met.join(e.select("entry_id", "e_name"), "entry_id").join(p.select("player_id", "p_name"), "player_id").withColumn("bound", F.when(F.col("same_school"), 0.6).otherwise(0.85))
    near = near.where(F.least(F.length("e_name"), F.length("p_name")) * 2 >= F.col("bound") * (F.length("e_name") + F.length("p_name")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            r = pd.Series([ratio(a, b) for a, b in zip(x["e_name"], x["p_name"], strict=True)], index=x.index, dtype=float)
            keep = r >= x["bound"]
            got = x[keep]
            yield pd.DataFrame({"entry_id": list(got["entry_id"]), "player_id": pd.Series(list(got["player_id"]), dtype=object), "similarity": list(r[keep].round(2)), "same_school": list(got["same_school"])})

    kind = dict(entries.dtypes)["entry_id"]
    scored = near.mapInPandas(run, f"entry_id {kind}, player_id string, similarity double, same_school boolean")
    order = Window.partitionBy("entry_id").orderBy(F.desc("same_school"), F.desc("similarity"), "player_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
