"""Date notations of the crawler brought to one form, on the wall clock, and years told by context.

``wall_clock`` reads the notations listed; ``full_timestamp_text`` has the rest read by ``timestamps``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from dugoutline.functions.text import category_of, strip, to_int
from dugoutline.functions.timestamps import OFFSET, UNREADABLE, tidy, to_epoch

# Notations in the order they are tried, the groups of their year, month, day, hour, minute and second (0 for
# none), and whether what they say is kept as written or must be a date that exists.
NOTATIONS = (
    (r"^(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2}):(\d{2})[+-]\d{2}:\d{2}", (1, 2, 3, 4, 5, 6), True),
    (r"^(\d{4})年(\d{1,2})月(\d{1,2})日(?:\s+(\d{1,2})[:時](\d{1,2})[分]?)?", (1, 2, 3, 4, 5, 0), True),
    (r"^(\d{4})-(\d{2})-(\d{2})$", (1, 2, 3, 0, 0, 0), True),
    (r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})$", (1, 2, 3, 0, 0, 0), False),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", (3, 1, 2, 0, 0, 0), False),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", (3, 2, 1, 0, 0, 0), False),
    (r"^(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2}):(\d{2})(?:\.\d{1,6})?$", (1, 2, 3, 4, 5, 6), False),
)


def bare_date(text: Column) -> Column:
    """A date text without outer space and brackets."""
    return strip(F.regexp_replace(strip(text), r"^\[|\]$", ""))


def wall_clock(text: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of a date text, the offset of an ISO text dropped; null where no notation is read.

    A time after a weekday is not part of the notation, so it gives midnight.
    """
    t = bare_date(text)

    def read(pattern: str, groups: tuple[int, ...], kept: bool) -> Column:
        two = lambda i: F.lpad(F.coalesce(F.nullif(F.regexp_extract(t, pattern, i), F.lit("")), F.lit("0")), 2, "0") if i else F.lit("00")
        y, *rest = groups
        parts = F.concat(F.regexp_extract(t, pattern, y), *[F.concat(F.lit(mark), two(i)) for mark, i in zip("-- ::", rest, strict=True)])
        return F.when(t.rlike(pattern), parts if kept else F.when(F.try_to_timestamp(parts).isNotNull(), parts))

    return F.coalesce(*[read(*n) for n in NOTATIONS])


def full_timestamp_text(text: Column) -> Column:
    """``timestamp_text``, of what it doesn't read the clock that the mixed notations tell, else the text itself."""

    @F.pandas_udf("string")
    def rest(x: pd.Series) -> pd.Series:
        # as in UTC, so that the clock stays as it is written; an offset is dropped
        at = to_epoch([None if t is None else OFFSET.sub("", tidy(t)) for t in x], [None] * len(x), [None] * len(x), "UTC")
        clock = np.datetime_as_string(np.where(at == UNREADABLE, 0, at).astype("datetime64[s]"))
        return pd.Series([None if a == UNREADABLE else f"{c}+09:00" for a, c in zip(at, clock, strict=True)], dtype=object)

    told = timestamp_text(text)
    return F.coalesce(told, F.when(told.isNull() & text.isNotNull(), rest(text)), text)


def timestamp_text(text: Column) -> Column:
    return F.concat(F.replace(wall_clock(text), F.lit(" "), F.lit("T")), F.lit("+09:00"))


def date_with_time(text: Column) -> Column:
    return F.substring(wall_clock(text), 1, 16)


def date_only(text: Column) -> Column:
    return F.substring(wall_clock(text), 1, 10)


def event_date(text: Column) -> Column:
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def received_date(text: Column) -> Column:
    """(month, day) of 'M月D日', zeros where it says neither."""
    p = r"(\d{1,2})月(\d{1,2})日"
    num = lambda i: F.coalesce(F.regexp_extract(text, p, i).try_cast("int"), F.lit(0))
    return F.struct(num(1).alias("month"), num(2).alias("day"))


def draft_year(year: Column, published: Column, school_year: Column, category: Column, context: Column) -> Column:
    """Draft year given, else told by grade and year of publication, else by a phrase of the context."""
    pub = F.nullif(F.regexp_extract(published, r"(20\d{2})", 1), F.lit("")).try_cast("int")
    grade = F.coalesce(F.nullif(F.regexp_extract(school_year, r"(\d+)\s*年", 1), F.lit("")).try_cast("int"), to_int(school_year))
    c, said = category_of(category), F.coalesce(school_year, F.lit(""))
    corporate = F.when(said.contains("高卒"), 3).when(said.contains("大卒"), 2).when(grade.isin(2, 3), grade)
    target = F.when(grade > 0, F.when(c == "高校", 3).when(c == "大学", 4).when(c == "社会人", corporate))
    told = F.when(context.rlike("来年(?:の)?ドラフト"), pub + 1).when(context.rlike("今秋ドラフト|今年(?:の)?ドラフト|今ドラフト"), pub)
    return F.coalesce(F.nullif(year, F.lit(0)), F.when(target.isNotNull(), pub + F.greatest(target - grade, F.lit(0))), told)
