"""Rosters: ditto marks, states carried over, counts and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugoutline.functions import text as T
from dugoutline.functions import values as V
from dugoutline.functions.dates import received_date


def forward_filled(entries: DataFrame, field: str, table: str = "table_id", order: str = "pos", runs: int = 1000) -> DataFrame:
    """``entries`` with the ditto marks of ``field`` replaced by the value above; a table may be of any length.

    Tables are cut into runs of ``runs`` positions: within a run the last value is carried by a window, and what
    a run begins with comes from the last value of the runs before it.
    """
    mark = F.trim(F.coalesce(F.col(field), F.lit(""))).isin(*V.DITTO)
    cut = entries.withColumns({"_v": F.when(~mark, F.col(field)), "_run": F.floor(F.col(order) / runs)})
    inside = Window.partitionBy(table, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    own = cut.withColumn("_own", F.last("_v", ignorenulls=True).over(inside))
    ends = cut.where("_v is not null").groupBy(table, "_run").agg(F.max_by("_v", order).alias("_end"))
    all_runs = cut.select(table, "_run").distinct().join(ends, [table, "_run"], "left")
    before = Window.partitionBy(table).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    carried = all_runs.select(table, "_run", F.last("_end", ignorenulls=True).over(before).alias("_before"))
    return own.join(carried, [table, "_run"]).withColumn(field, F.coalesce("_own", "_before")).select(*entries.columns)


def state_changes(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """(key, change): 'new' keys of the current state, 'resolved' ones of the previous, 'kept' of both."""
    a, b = previous.select(key).distinct().withColumn("_p", F.lit(1)), current.select(key).distinct().withColumn("_c", F.lit(1))
    return a.join(b, key, "full_outer").select(key, F.when(F.col("_p").isNull(), "new").when(F.col("_c").isNull(), "resolved").otherwise("kept").alias("change"))


def carried_over(previous: DataFrame, current: DataFrame, key: str, first_seen: Column) -> DataFrame:
    """Current entries with the time they were first seen, kept from the previous state."""
    old = previous.select(key, F.col("first_seen_at").alias("_old"))
    return current.join(old, key, "left").withColumn("first_seen_at", F.coalesce("_old", first_seen)).drop("_old")


def markdown_table(rows: DataFrame, header: list[str], columns: list[str], order: list[Column], by: str) -> DataFrame:
    """(by, markdown): a table of each group's rows in order."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]), F.lit(" |"))
    head = f"| {' | '.join(header)} |\n|{'---|' * len(header)}\n"
    lines = F.array_sort(F.collect_list(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], line.alias("line"))))
    return rows.groupBy(by).agg(F.concat(F.lit(head), F.array_join(F.transform(lines, lambda x: x["line"]), "\n")).alias("markdown"))


def checklist(records: DataFrame, previous: DataFrame, by: str) -> DataFrame:
    """(by, markdown, ticked): a checklist of each group's records (by, key, label, fresh) in the order of their labels.

    A line is ticked if its key is ticked in any of the ``previous`` checklists (markdown); new records are marked. A group
    is written into one text, so it should be one that people read.
    """
    ticks = previous.select(F.explode(T.checked_keys(F.col("markdown"))).alias("key")).distinct().withColumn("_t", F.lit(True))
    known = records.join(ticks, "key", "left").withColumn("_t", F.coalesce("_t", F.lit(False)))
    line = F.concat(F.lit("- ["), F.when(F.col("_t"), "x").otherwise(" "), F.lit("] "), F.when(F.col("fresh"), "🆕 ").otherwise(""), F.col("label"), F.lit(" <!--k:"), F.col("key"), F.lit("-->"))
    lines = F.array_sort(F.collect_list(F.struct("label", "key", line.alias("line"))))
    return known.groupBy(by).agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("markdown"), F.count_if("_t").alias("ticked"))


def newest_first(received: Column) -> list[Column]:
    """Order of a roster: the latest month and day first, those without a date last."""
    r = received_date(received)
    return [-r["month"], -r["day"]]
