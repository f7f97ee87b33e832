"""The timeline of people: evidence of several kinds in one stream, news told twice once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = ("player_id", "player_candidate_id", "crawled_article_id", "source_url", "title", "published_at", "source", "category", "item_type", "body", "confidence", "score", "created_at")
TYPES = {"confidence": "double", "score": "int", "created_at": "timestamp"}


def branch(df: DataFrame, item_type: str, **columns) -> DataFrame:
    """A branch of the union; columns not given are typed nulls."""
    given = columns | {"item_type": F.lit(item_type)}
    return df.select(*[(given[c] if c in given else F.lit(None)).cast(TYPES.get(c, "string")).alias(c) for c in COLUMNS])


def news_once(items: DataFrame, aggregator: str, strict: bool = False) -> DataFrame:
    """News items once per person and title: originals before the aggregator, then the latest, then the first made.

    Items without a registered player share one partition unless ``strict`` adds the candidate.
    """
    title = F.nullif(F.lower(F.regexp_replace(F.coalesce("title", F.lit("")), r"[\s　]", "")), F.lit(""))
    order = F.struct(
        F.coalesce(F.col("source").startswith(aggregator), F.lit(False)).cast("int").alias("a"), F.col("published_at").isNull().alias("b"),
        (-F.unix_micros(F.coalesce(F.try_to_timestamp("published_at"), F.lit("1970-01-01").cast("timestamp")))).alias("c"),
        F.col("created_at").isNull().alias("d"), F.col("created_at").alias("e"), F.col("source_url").alias("f"), F.col("player_candidate_id").alias("g"),
    )
    keys = [F.col("player_id").alias("_p"), F.coalesce(title, F.col("source_url"), F.col("crawled_article_id")).alias("_t"), *([F.col("player_candidate_id").alias("_c")] if strict else [])]
    return items.groupBy(*keys).agg(F.min_by(F.struct(*COLUMNS), order).alias("_row")).select("_row.*")
