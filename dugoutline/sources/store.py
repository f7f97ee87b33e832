"""Tables read and written: parquet, CSV sheets and JSON payloads, with validation of rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dugoutline.operators.dedup import first_by
from dugoutline.operators.links import merged_by_key, not_stored


def sheet(spark: SparkSession, path: str) -> DataFrame:
    """A CSV sheet with a header, all text."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def payload(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files that hold one object each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def first_available(primary: DataFrame, other: DataFrame) -> DataFrame:
    """``primary``, or ``other`` where it is empty."""
    return other if primary.isEmpty() else primary


def validated(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): rows that pass all rules, and the rest with the names of those they break. Null passes."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]))
    checked = df.withColumn("_broken", broken)
    return checked.where(F.size("_broken") == 0).drop("_broken"), checked.where(F.size("_broken") > 0).withColumnRenamed("_broken", "broken_rules")


CANDIDATE_RULES = {
    "status": "status in ('promoted', 'approved', 'pending', 'rejected')",
    "confidence": "latest_confidence between 0 and 1",
    "source_count": "source_count >= 0",
}


def candidate_rules() -> dict[str, Column]:
    return {name: F.expr(rule) for name, rule in CANDIDATE_RULES.items()}


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at a path, None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: list[str], keep: list[str]) -> None:
    """New rows merged into a parquet table by key, written beside the old one first. Only a table that doesn't exist
    counts as empty; one that can't be read is an error, and stays as it is."""
    stored = stored_table(spark, path)
    stored = new.limit(0) if stored is None else stored
    merged = merged_by_key(stored, new, keys, keep)
    merged.write.mode("overwrite").parquet(f"{path}.new")
    spark.read.parquet(f"{path}.new").write.mode("overwrite").parquet(path)


def append_new(spark: SparkSession, path: str, new: DataFrame, keys: list[str], order: Column | None = None) -> int:
    """Number of the rows that ``append_counted`` appends."""
    return append_counted(spark, path, new, keys, order)["appended"]


def append_counted(spark: SparkSession, path: str, new: DataFrame, keys: list[str], order: Column | None = None) -> dict[str, int]:
    """Rows of ``new`` whose key is neither stored nor repeated, appended: (appended, stored, repeated) rows.

    Of rows of one key the first in ``order`` is taken, by default that of the least values.
    """
    once = first_by(new, keys, F.to_json(F.struct(*new.columns)) if order is None else order)
    stored = stored_table(spark, path)
    fresh = (once if stored is None else not_stored(once, stored, keys)).persist()
    n, distinct, told = fresh.count(), once.count(), new.count()
    fresh.write.mode("append").parquet(path)
    fresh.unpersist()
    return {"appended": n, "stored": distinct - n, "repeated": told - distinct}


def planned_upsert(stored: DataFrame, new: DataFrame, keys: list[str], keep: list[str], required: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, int]]:
    """What an upsert would store, and how many rows it would insert, update and leave out: a dry run.

    Rows without a key or a required value are left out; of repeated keys the last in the order of all values counts.
    """
    blank = F.lit(False)
    for c in (*keys, *required):
        blank = blank | (F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "")
    good = new.where(~blank)
    whole = F.struct(*new.columns)
    once = good.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(whole, F.to_json(whole)).alias("_row")).select("_row.*")
    known = once.join(stored.select(*keys).distinct(), keys, "left_semi").count()
    return merged_by_key(stored, once, keys, keep), {"insert": once.count() - known, "update": known, "left_out": new.count() - good.count()}


def without(df: DataFrame, losers: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the losers."""
    return df.join(losers.select(key).distinct(), key, "left_anti")
