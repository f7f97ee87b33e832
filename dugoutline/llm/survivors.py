"""Best record of each group of duplicates, field by field.

Fields are unpivoted to long rows and their votes gathered per normalised value; the value with the best
vote wins (``min_by`` / ``max_by``) and the winners are pivoted back to one row per group. All steps are
aggregates that combine before the shuffle, so a group of any size is never held in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("promoted", "approved", "pending", "rejected")
FIELDS = ("name_kana", "category", "school_year", "positions", "throws", "bats", "height_cm", "weight_kg", "birth_date", "fastball_max", "description")


@dataclass(frozen=True)
class Votes:
    """Trust of a status, more for more sources, times decay of age; ``merge_order`` ranks rows strictly instead of
    adding votes."""

    merge_order: bool = False
    trust: dict[str, float] = field(default_factory=lambda: {"promoted": 4.0, "approved": 3.0, "pending": 1.5, "rejected": 0.5})
    half_life_days: float = 180.0
    #: Ages count from this day; it scales all votes alike, so any day after the last row will do.
    as_of: str = "2050-01-01"


def merge_order() -> Column:
    """Order of a group's rows: player_id, status, source_count, age, id."""
    status = F.coalesce(F.array_position(F.array(*map(F.lit, STATUSES)), F.col("status")), F.lit(0)).cast("int")
    return F.struct(
        F.when(F.trim("player_id") != "", 0).otherwise(1).alias("unlinked"),
        F.when(status > 0, status).otherwise(len(STATUSES) + 1).alias("status"),
        (-F.coalesce(F.col("source_count"), F.lit(0))).alias("sources"),
        F.col("created_at").isNull().alias("undated"),
        F.col("created_at").alias("created_at"),
        F.col("id").alias("id"),
    )


def _text(df: DataFrame, name: str) -> Column:
    """A field as text; null where it is null, blank or an empty list."""
    if dict(df.dtypes)[name].startswith("array"):
        items = F.filter(F.col(name), lambda x: x.isNotNull() & (F.trim(x.cast("string")) != ""))
        return F.when(F.size(items) > 0, F.to_json(items))
    text = F.col(name).cast("string")
    return F.when(F.regexp_replace(text, r"[\s　]+", "") != "", text)


def survivors(df: DataFrame, keys: tuple[str, ...] = ("name", "team"), fields: tuple[str, ...] = FIELDS, votes: Votes = Votes()) -> DataFrame:
    """One row per group of two or more: keys, keep_id, copies and for each field (value, from_id, vote).

    Groups need non-null keys. Ties go to the row first in the merge order. A field that no row fills is
    null. Repeated ids count as rows. Columns beside those named are not read.
    """
    known = df.where(" and ".join(f"`{k}` is not null" for k in keys))
    age = F.greatest(F.lit(0), F.datediff(F.lit(votes.as_of).cast("date"), F.to_date("created_at")))
    trust = F.coalesce(F.create_map(*[F.lit(x) for kv in votes.trust.items() for x in kv])[F.col("status")], F.lit(1.0)) * (1 + F.log1p(F.greatest(F.lit(0), F.coalesce("source_count", F.lit(0)))))
    weight = trust * F.pow(F.lit(0.5), F.coalesce(age, F.lit(36500)) / F.lit(votes.half_life_days))
    rows = known.select(*keys, merge_order().alias("_order"), weight.alias("_weight"), F.array(F.struct(F.lit("").alias("field"), F.lit("").alias("value")), *[F.struct(F.lit(f).alias("field"), _text(df, f).alias("value")) for f in fields]).alias("_fields"))
    long = rows.select(*keys, "_order", "_weight", F.inline("_fields")).where("value is not null")
    normal = F.lower(F.regexp_replace("value", r"[\s　]+", ""))
    ballots = long.groupBy(*keys, "field", normal.alias("_normal")).agg(F.count("*").alias("_n"), F.sum("_weight").alias("_vote"), F.min("_order").alias("_best"), F.min_by("value", "_order").alias("value"))
    won = F.struct(F.col("value"), F.col("_best.id").alias("from_id"), F.col("_vote").alias("vote"))
    best = F.min_by(won, "_best") if votes.merge_order else F.max_by(won, F.struct("_vote", "_n"))
    winners = ballots.groupBy(*keys, "field").agg(best.alias("won"), F.sum("_n").alias("copies"))
    pick = lambda f, c: F.max(F.when(F.col("field") == f, c))
    wide = winners.groupBy(*keys).agg(pick("", F.col("won.from_id")).alias("keep_id"), pick("", F.col("copies")).alias("copies"), *[pick(f, F.col("won")).alias(f) for f in fields])
    return wide.where("copies > 1")


def merged_fields(df: DataFrame) -> DataFrame:
    """(keep_id, field_name, from_id): the kept row of each group and the rows that fill its empty fields."""
    merged = survivors(df, votes=Votes(merge_order=True))
    cells = F.array(F.struct(F.lit("id").alias("field_name"), F.col("keep_id").alias("from_id")), *[F.struct(F.lit(f).alias("field_name"), F.col(f"{f}.from_id").alias("from_id")) for f in FIELDS])
    return merged.select("keep_id", F.inline(cells)).where("from_id is not null and (field_name = 'id' or from_id <> keep_id)")
