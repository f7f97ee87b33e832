"""Mixed timestamp notations to one UTC instant.

A text is reduced to a shape mask (digits and letter runs by class), each distinct mask is given its
parser once per worker, and all texts of a mask are converted together with numpy: civil fields to
seconds, then seconds to UTC through zone transition tables. The tables are built per zone from the
installed time zone database, whose version is part of the cache key.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import re
import unicodedata
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from pathlib import Path
from zoneinfo import TZPATH, ZoneInfo

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOME_ZONE = "Asia/Tokyo"
UNREADABLE = np.iinfo(np.int64).min
DAY = 86_400

# English month names and the zone abbreviations that mean one offset (in minutes).
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
LONG_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "jst": 540, "kst": 540, "hkt": 480, "sgt": 480, "aest": 600, "aedt": 660, "acst": 570, "acdt": 630,
    "awst": 480, "nzst": 720, "nzdt": 780, "est": -300, "edt": -240, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
    "akst": -540, "akdt": -480, "hst": -600, "wet": 0, "bst": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180,
}
#: First year of each era, less one.
ERAS = {"令和": 2018, "平成": 1988, "昭和": 1925, "r": 2018, "h": 1988, "s": 1925}

_ZONE = r"(?:\s*\(?(?P<zone>(?:UTC|GMT)?[+\-]\d{1,2}(?::?\d{2})?|[A-Za-z]+(?:/[A-Za-z0-9_+\-]+){1,2}|[A-Za-z]{1,5})\)?)?"
_CLOCK = r"(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,]\d+)?)?"
_AMPM = r"(?:\s*(?P<ap>[AaPp]\.?[Mm]\.?)(?![A-Za-z]))?"
_JP_CLOCK = r"(?P<ap>午前|午後)?\s*(?:(?P<h>\d{1,2})(?::(?P<mi>\d{2})(?::(?P<s>\d{2}))?|時(?:(?P<mi2>\d{1,2})分(?:(?P<s2>\d{1,2})秒)?)?))"
_DAY_JP = r"(?:\s*[((][^()()]{1,3}[))])?"
#: Notations in the order they are tried for a mask, in letters of either case; the first whose pattern fits gives the parser.
NOTATIONS = tuple(
    re.compile(p, re.I)
    for p in (
        r"(?P<epoch>-?\d{9,10}|-?\d{12,13}|-?\d{15,16})(?:\.\d+)?",
        r"(?P<y>\d{4})(?P<mo>\d{2})(?P<d>\d{2})(?:[T ]?(?P<h>\d{2})(?P<mi>\d{2})(?P<s>\d{2})?(?:\.\d+)?" + _ZONE + ")?",
        r"(?P<y>\d{4})-(?P<mo>\d{1,2})-(?P<d>\d{1,2})(?:(?:T|\s+)" + _CLOCK + _AMPM + _ZONE + ")?",
        r"(?P<y>\d{4})[/.](?P<mo>\d{1,2})[/.](?P<d>\d{1,2})" + _DAY_JP + r"(?:(?:T|\s+)" + _CLOCK + _AMPM + _ZONE + ")?",
        r"(?P<mo>\d{1,2})/(?P<d>\d{1,2})/(?P<y>\d{4})(?:,?\s+" + _CLOCK + _AMPM + _ZONE + ")?",
        r"(?P<y>\d{4})年\s*(?P<mo>\d{1,2})月\s*(?P<d>\d{1,2})日" + _DAY_JP + r"(?:\s*" + _JP_CLOCK + _ZONE + ")?",
        r"(?P<era>令和|平成|昭和|[RHS])\s*(?P<ey>\d{1,2}|元)年\s*(?P<mo>\d{1,2})月\s*(?P<d>\d{1,2})日" + _DAY_JP + r"(?:\s*" + _JP_CLOCK + _ZONE + ")?",
        r"(?:(?P<wd>[A-Za-z]+)\.?,?\s+)?(?P<d>\d{1,2})[\s\-](?P<mon>[A-Za-z]+)\.?,?[\s\-](?P<y>\d{4})(?:,?\s+" + _CLOCK + _AMPM + _ZONE + ")?",
        r"(?P<wd>[A-Za-z]+)\s+(?P<mon>[A-Za-z]+)\s+(?P<d>\d{1,2})\s+" + _CLOCK + r"(?:\s+(?P<zone>[A-Za-z]{1,5}|[+\-]\d{2}(?::?\d{2})?))?\s+(?P<y>\d{4})",
        r"(?:(?P<wd>[A-Za-z]+)\.?,?\s+)?(?P<mon>[A-Za-z]+)\.?\s+(?P<d>\d{1,2})(?:st|nd|rd|th)?,?\s+(?P<y>\d{4})(?:,?(?:\s+at)?\s+" + _CLOCK + _AMPM + _ZONE + ")?",
    )
)
#: Zone or offset after a clock.
OFFSET = re.compile(r"(?<=\d)\s*\(?(?:(?:UTC|GMT)?[+\-]\d{1,2}(?::?\d{2})?|Z|[A-Z]{2,5}|[A-Za-z]+/[A-Za-z0-9_+\-/]+)\)?$")
_DIGIT, _WORD = re.compile(r"\d"), re.compile(r"[A-Za-z]+")
_MINUS = str.maketrans(dict.fromkeys("−‐‑–", "-"))
_BRACKETS = re.compile(r"^\[\s*(.*?)\s*\]$", re.S)
_LABEL = re.compile(r"^[^\d\sA-Za-z::]{1,8}\s*:\s*(?=\d|令|平|昭)")


def tidy(text: str) -> str:
    """``text`` in compatibility form without outer space, brackets and a leading label."""
    text = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text)).strip().translate(_MINUS)
    if m := _BRACKETS.match(text):
        text = m[1]
    return _LABEL.sub("", text)


def mask(text: str) -> str:
    """Shape of a tidied text: each digit 9, each run of letters by its kind, all else verbatim."""
    def kind(m: re.Match) -> str:
        word = m[0].lower()
        if word in WEEKDAYS:
            return "w"
        if word in MONTHS or word in LONG_MONTHS or word == "sept":
            return "m"
        return word if word in ("t", "am", "pm", "at", "utc", "gmt", "r", "h", "s") else "a" * min(len(word), 6)

    return _WORD.sub(kind, _DIGIT.sub("9", text))


_PARSERS: dict[str, re.Pattern] = {}


def parser_of(shape: str, sample: str) -> re.Pattern | None:
    """The parser of a mask if it fits the sample, else the first notation that does, which is then the mask's; what no
    notation fits says nothing of other texts of the mask."""
    known = _PARSERS.get(shape)
    if known is not None and known.fullmatch(sample):
        return known
    found = next((p for p in NOTATIONS if p.fullmatch(sample)), None)
    if found is not None:
        if len(_PARSERS) > 100_000:
            _PARSERS.clear()
        _PARSERS[shape] = found
    return found


@lru_cache(maxsize=1)
def database_version() -> str:
    """Version of the time zone database in use: of the package, else of the files the zones are read from."""
    try:
        return importlib.metadata.version("tzdata")
    except importlib.metadata.PackageNotFoundError:
        pass
    for folder in map(Path, TZPATH):
        for name in ("+VERSION", "tzdata.zi"):
            if (folder / name).is_file():
                return (folder / name).read_text(errors="replace").splitlines()[0].removeprefix("# version").strip()
    parts = [p for p in (Path(f) / HOME_ZONE for f in TZPATH) if p.is_file()]
    return hashlib.sha1(parts[0].read_bytes()).hexdigest() if parts else "unknown"


class Zone:
    """Transition table of one zone: UTC seconds at which its offset changes, and the offsets."""

    def __init__(self, key: str, first: int = 1900, last: int = 2100):
        zone = ZoneInfo(key)
        offset = lambda t: int((datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=t)).astimezone(zone).utcoffset().total_seconds())
        start, end = (int(datetime(y, 1, 2, tzinfo=timezone.utc).timestamp()) for y in (first, last))
        at, offsets, t, o = [], [offset(start)], start, offset(start)
        while t < end:
            n = t + 7 * DAY
            if (p := offset(n)) != o:
                low, high = t, n
                while high - low > 1:
                    middle = (low + high) // 2
                    low, high = (middle, high) if offset(middle) == o else (low, middle)
                at.append(high)
                offsets.append(p)
            t, o = n, p
        self.at, self.offsets = np.array(at, dtype=np.int64), np.array(offsets, dtype=np.int64)

    def offset(self, utc: np.ndarray) -> np.ndarray:
        return self.offsets[np.searchsorted(self.at, utc, side="right")]

    def to_utc(self, local: np.ndarray, meant: np.ndarray) -> np.ndarray:
        """UTC seconds of clock readings. Of two equal readings the one at offset ``meant`` counts, else the
        first; a reading that the clocks skipped is taken with the offset before the change."""
        before, after = self.offset(local - DAY - self.offset(local)), self.offset(local + DAY - self.offset(local))
        first, second = local - before, local - after
        ok1, ok2 = self.offset(first) == before, self.offset(second) == after
        return np.where(ok1 & ok2, np.where((meant == after) & (after != before), second, first), np.where(ok2 & ~ok1, second, first))


@lru_cache(maxsize=1000)
def zone_table(key: str, version: str) -> Zone | None:
    """The table of a zone, None for a name the database lacks."""
    try:
        return Zone(key)
    except (KeyError, ValueError, OSError):
        return None


def _offset_minutes(text: str | None) -> float:
    """Minutes of '+09:00', 'UTC-0700', 'JST'; NaN where it says nothing readable."""
    if text is None or text != text:
        return np.nan
    t = text.strip().lower()
    if t in ABBREVIATIONS:
        return ABBREVIATIONS[t]
    if m := re.fullmatch(r"(?:utc|gmt)?([+\-])(\d{1,2})(?::?(\d{2}))?", t.translate(_MINUS)):
        minutes = int(m[2]) * 60 + int(m[3] or 0)
        return (-1 if m[1] == "-" else 1) * minutes if minutes <= 18 * 60 else np.nan
    return np.nan


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970 and whether the date exists."""
    ok = (y >= 1900) & (y <= 2099) & (m >= 1) & (m <= 12) & (d >= 1)
    ym = np.where(ok, (y - 1970) * 12 + m - 1, 0).astype("datetime64[M]")
    first = ym.astype("datetime64[D]").astype(np.int64)
    length = (ym + 1).astype("datetime64[D]").astype(np.int64) - first
    return first + d - 1, ok & (d <= length)


def _parsed(groups: dict[str, list[int]], texts: list[str | None]) -> Iterator[tuple[list[int], pd.DataFrame]]:
    """Rows and the fields of their notation, for all texts that one fits; mostly once a mask."""
    for shape, rows in groups.items():
        k = 0
        while k < len(rows):
            pattern = parser_of(shape, texts[rows[k]])
            if pattern is None:
                k += 1
                continue
            rows, k = rows[k:], 0
            f = pd.Series([texts[i] for i in rows]).str.extract(pattern.pattern.join(("^", "$")), flags=re.I)
            fits = f.notna().any(axis=1).to_numpy()
            yield [i for i, ok in zip(rows, fits, strict=True) if ok], f[fits].reset_index(drop=True)
            rows = [i for i, ok in zip(rows, fits, strict=True) if not ok]


def to_epoch(texts: list[str | None], zones: list[str | None], offsets: list[str | None], home: str = HOME_ZONE) -> np.ndarray:
    """UTC seconds of each text, UNREADABLE where it tells no time."""
    out = np.full(len(texts), UNREADABLE, dtype=np.int64)
    groups: dict[str, list[int]] = {}
    tidied = [None if t is None or t != t else tidy(t) for t in texts]
    for i, t in enumerate(tidied):
        if t:
            groups.setdefault(mask(t), []).append(i)
    version = database_version()
    for rows, f in _parsed(groups, tidied):
        at = np.array(rows)
        number = lambda c, default=0: pd.to_numeric(f[c], errors="coerce").fillna(default).to_numpy().astype(np.int64) if c in f else np.full(len(f), default, dtype=np.int64)
        if "epoch" in f:
            n = number("epoch")
            out[at] = n // np.select([np.abs(n) >= 10**14, np.abs(n) >= 10**11], [10**6, 10**3], 1)
            continue
        if "era" in f:
            year = f["era"].map(lambda x: ERAS.get(x if x in ERAS else str(x).lower(), 0)).to_numpy().astype(np.int64) + f["ey"].replace("元", "1").astype(int).to_numpy()
        else:
            year = number("y")
        ok = np.ones(len(f), dtype=bool)
        if "mon" in f:
            name = f["mon"].str.lower()
            month = name.map(lambda x: (MONTHS.index(x[:3]) + 1) if x[:3] in MONTHS and (x in MONTHS or x in LONG_MONTHS or x == "sept") else 0).to_numpy().astype(np.int64)
        else:
            month = number("mo")
        if "wd" in f:
            ok &= f["wd"].map(lambda x: x is None or x != x or x.lower() in WEEKDAYS).to_numpy().astype(bool)
        days, exists = _days(year, month, number("d"))
        hour = number("h")
        minute = np.where(f["mi"].isna() & f["mi2"].notna(), number("mi2"), number("mi")) if "mi2" in f else number("mi")
        second = np.where(f["s"].isna() & f["s2"].notna(), number("s2"), number("s")) if "s2" in f else number("s")
        if "ap" in f:
            half = f["ap"].fillna("").str.lower().str.replace(".", "")
            pm, am = half.isin(["pm", "午後"]).to_numpy(), half.isin(["am", "午前"]).to_numpy()
            hour = np.where(pm & (hour < 12), hour + 12, np.where(am & (hour == 12), 0, hour))
        ok &= exists & (hour < 48) & (minute < 60) & (second < 61)
        local = days * DAY + hour * 3600 + minute * 60 + second
        own = f["zone"] if "zone" in f else pd.Series([None] * len(f), dtype=object)
        fixed = own.map(_offset_minutes, na_action=None).to_numpy().astype(float)
        named = np.array([z if isinstance(z, str) and np.isnan(m) else None for z, m in zip(own, fixed, strict=True)], dtype=object)
        result = np.where(np.isnan(fixed), UNREADABLE, local - np.nan_to_num(fixed).astype(np.int64) * 60)
        need = np.isnan(fixed) & ok
        where: dict[str, list[int]] = {}
        for k in np.flatnonzero(need):
            where.setdefault(named[k] or zones[rows[k]] or home, []).append(k)
        for key, ks in where.items():
            table = zone_table(key.strip(), version)
            if table is None:
                # an unknown zone written with the clock makes it unreadable; an unknown stored zone is as none
                ks = [k for k in ks if named[k] is None]
                table = zone_table(home, version)
                if not ks:
                    continue
            k = np.array(ks)
            meant = np.nan_to_num(np.array([_offset_minutes(offsets[rows[i]]) for i in ks], dtype=float), nan=1e6).astype(np.int64) * 60
            result[k] = table.to_utc(local[k], meant)
        out[at] = np.where(ok, result, UNREADABLE)
    return out


def first_readable(sources: list[list[str | None]], zones: list[str | None], offsets: list[str | None], home: str = HOME_ZONE) -> np.ndarray:
    """Epoch of the first source of each row that can be read."""
    out = np.full(len(zones), UNREADABLE, dtype=np.int64)
    for texts in sources:
        rest = np.flatnonzero(out == UNREADABLE)
        if len(rest):
            out[rest] = to_epoch([texts[i] for i in rest], [zones[i] for i in rest], [offsets[i] for i in rest], home)
    return out


def utc_instant(sources: list[Column], zone: Column, offset: Column, home: str = HOME_ZONE) -> Column:
    """UTC timestamp of the first readable source; null where none is.

    Nulls, blanks and placeholders are unreadable; fractions are dropped; clocks to 47:59 run into the
    next day; a date without clock is 00:00; an own offset or zone beats ``zone``, which beats ``home``.
    """
    return F.timestamp_seconds(_converted(sources, zone, offset, home, "long"))


def utc_text(sources: list[Column], zone: Column, offset: Column, home: str = HOME_ZONE) -> Column:
    """``utc_instant`` as yyyy-MM-ddTHH:mm:ssZ, whatever the session's zone."""
    return _converted(sources, zone, offset, home, "string")


def _converted(sources: list[Column], zone: Column, offset: Column, home: str, kind: str) -> Column:
    n = len(sources)

    @F.pandas_udf(kind)
    def convert(x: pd.DataFrame) -> pd.Series:
        lists = [[v if isinstance(v, str) else None for v in x[f"c{i}"]] for i in range(n + 2)]
        got = first_readable(lists[:n], lists[n], lists[n + 1], home)
        unread = got == UNREADABLE
        if kind == "long":
            return pd.Series(got, dtype="Int64").mask(unread)
        text = np.datetime_as_string(np.where(unread, 0, got).astype("datetime64[s]"))
        return pd.Series([None if u else f"{t}Z" for t, u in zip(text, unread, strict=True)], dtype=object)

    # a filter on the result must not run the conversion a second time
    return convert.asNondeterministic()(F.struct(*[c.cast("string").alias(f"c{i}") for i, c in enumerate([*sources, zone, offset])]))


def article_instants(articles: DataFrame, home: str = HOME_ZONE) -> DataFrame:
    """(article_id, published_utc) of every article whose time can be read, ISO text in UTC.

    The date in ``raw`` comes before ``published_at``; ``raw`` that is no JSON object counts as absent.
    Duplicate ids give a row each; an empty table gives none. Other columns are not read.
    """
    said = articles.select(
        "id", "published_at",
        F.get_json_object("raw", "$.date").alias("_date"), F.get_json_object("raw", "$.tz").alias("_tz"), F.get_json_object("raw", "$.utc_offset").alias("_offset"),
    )
    at = utc_text([F.col("_date"), F.col("published_at")], F.col("_tz"), F.col("_offset"), home)
    return said.select(F.col("id").alias("article_id"), at.alias("published_utc")).where("published_utc is not null")
