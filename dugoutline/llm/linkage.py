"""Records of two sources that describe one person, matched without a common key.

The q-grams of each attribute of a record are encoded as a fixed bit vector. Records of the two sources at near
spellings of a team meet if a vector of a view (written name, reading, family name, family name's reading) is within
a Hamming radius, which is found exactly: vectors are cut into one chunk more than the radius has bits, so one of
them is equal, and the distance is checked. A pair's score is the weighted Dice coefficient of its fields, worked out
on the vectors; the best score of an entry and a person is turned into a confidence, which decides. It is calibrated
by a logistic regression on a bounded sample of pairs labelled by an exact check of name, reading and team. The check
also follows on the pairs chosen, and a match extends to all rows of the candidate's person.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugoutline.llm import people
from dugoutline.llm.quality import fit_logistic
from dugoutline.llm.people import DETAILS, FIELDS, near_teams, pair_score
from dugoutline.session import checkpointed, shuffled

CHUNKS, BITS, HASHES = 4, 16, 2
RADIUS = CHUNKS - 1
VIEWS = ("written", "spoken", "family", "family_spoken")
FIELD_WEIGHTS = {"name": 0.45, "reading": 0.25, "team": 0.15, "year": 0.08, "category": 0.07}


def grams(text: str) -> set[str]:
    return {*text, *(text[i : i + 2] for i in range(len(text) - 1))}


def encoded(text: str) -> int:
    """64-bit vector of a text's q-grams, ``HASHES`` bits each, as a signed number."""
    v = 0
    for g in grams(text):
        for k in range(HASHES):
            v |= 1 << (zlib.crc32(f"{k}{g}".encode("utf-8", "surrogatepass")) % (CHUNKS * BITS))
    return v - (1 << 64) if v >> 63 else v


def views_of(full: str, parts: list[str], reading: str, surname_said: str, kind: str) -> list[tuple[int, int]]:
    """(view, vector) of the views a record has; a name of two parts may be reversed, so both may be the family's."""
    out = []
    if kind == "kanji":
        out += [(0, encoded(full)), (2, encoded((parts[0] if parts and len(parts[0]) <= 3 else full[:2])[:2]))]
        if len(parts) == 2:
            out.append((2, encoded(parts[1][:2])))
    if reading:
        out.append((1, encoded(reading)))
    if said := surname_said or (parts[0] if kind != "kanji" and parts else ""):
        out.append((3, encoded(said)))
    return out


_BITS = "name bigint, said bigint, place bigint, views array<struct<view: int, code: bigint>>"


def with_bits(units: DataFrame) -> DataFrame:
    """(unit, uid, team, year, category, name, said, place, views): vectors of the fields (0 for none) and of the views."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for u, uid, team, year, category, full, parts, reading, said, kind in b.itertuples(index=False, name=None):
                views = [{"view": v, "code": c} for v, c in views_of(full, list(parts), reading or "", said or "", kind)]
                out.append((u, uid, team, year, category, encoded(full) if kind == "kanji" else 0, encoded(reading or ""), encoded(team or ""), views))
            yield pd.DataFrame(out, columns=["unit", "uid", "team", "year", "category", "name", "said", "place", "views"]).astype({"year": object, "category": object})

    return units.select("unit", "uid", "team", "year", "category", "full", "parts", "reading", "surname_said", "kind").mapInPandas(run, f"unit string, uid bigint, team string, year string, category string, {_BITS}")


def close_codes(left: DataFrame, right: DataFrame, teams: DataFrame) -> DataFrame:
    """(a, b): uids of every pair at near teams (team, near) with codes of one view at most RADIUS bits apart."""
    chunk = lambda i: F.shiftrightunsigned("code", i * BITS).bitwiseAND(F.lit((1 << BITS) - 1))
    keys = F.explode(F.array(*[F.xxhash64("near", "view", F.lit(i), chunk(i)) for i in range(CHUNKS)]))
    probe = left.join(teams.select("team", "near"), "team").select("uid", "near", F.inline("views")).select(F.col("uid").alias("a"), F.col("code").alias("code_a"), keys.alias("key"))
    index = right.select("uid", F.col("team").alias("near"), F.inline("views")).select(F.col("uid").alias("b"), F.col("code").alias("code_b"), keys.alias("key"))
    return shuffled(probe).join(shuffled(index), "key").where(F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= RADIUS).select("a", "b").distinct()


def dice(a: Column, b: Column) -> Column:
    """Dice coefficient of two vectors; null where either is empty."""
    return F.when((a != 0) & (b != 0), 2 * F.bit_count(a.bitwiseAND(b)) / (F.bit_count(a) + F.bit_count(b)))


def weighted_dice(x: str = "a", y: str = "b") -> Column:
    """Weighted mean of the fields that both records have: Dice of name, reading and team, equality of category, and
    for the year 1, half for the next one, else 0."""
    c = lambda s, f: F.col(f"{s}_{f}")
    apart = F.abs(c(x, "year").cast("int") - c(y, "year").cast("int"))
    fields = {"name": dice(c(x, "name"), c(y, "name")), "reading": dice(c(x, "said"), c(y, "said")), "team": dice(c(x, "place"), c(y, "place")), "year": F.when(apart.isNotNull(), F.greatest(F.lit(0.0), 1 - apart / 2)), "category": (c(x, "category") == c(y, "category")).cast("double")}
    got = reduce(lambda p, q: p + q, [F.coalesce(v, F.lit(0.0)) * FIELD_WEIGHTS[f] for f, v in fields.items()])
    known = reduce(lambda p, q: p + q, [F.when(v.isNotNull(), FIELD_WEIGHTS[f]).otherwise(0.0) for f, v in fields.items()])
    return F.when(known > 0, got / known).otherwise(0.0)


def mixture(histogram: np.ndarray, steps: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Densities of two parts of scores in [0, 1] per bin, each with its share: scores of different persons lie about a
    mean (normal), those of one person fall off from 1 (exponential)."""
    x = (np.arange(len(histogram)) + 0.5) / len(histogram)
    n = histogram / max(1, histogram.sum())
    share, mean, dev, fall = 0.5, 0.5, 0.15, 0.05
    for _ in range(steps):
        apart = (1 - share) * np.exp(-0.5 * ((x - mean) / dev) ** 2) / (dev * np.sqrt(2 * np.pi)) + 1e-12
        one = share * np.exp(-(1 - x) / fall) / (fall * -np.expm1(-1 / fall)) + 1e-12
        r = one / (apart + one)
        w1, w0 = (n * r).sum() + 1e-9, (n * (1 - r)).sum() + 1e-9
        share, mean, fall = w1 / (w0 + w1), (n * (1 - r) * x).sum() / w0, min(0.5, (n * r * (1 - x)).sum() / w1 + 0.005)
        dev = np.sqrt((n * (1 - r) * (x - mean) ** 2).sum() / w0) + 0.02
    return apart, one


def confidence_table(histogram: np.ndarray) -> list[float]:
    """Chance that a score of each bin is of one person, never falling with the score."""
    apart, one = mixture(histogram)
    return [float(v) for v in np.maximum.accumulate(one / (apart + one))]


def fitted_table(dice: np.ndarray, same: np.ndarray, bins: int) -> list[float]:
    """Chance per score bin that the check finds one person, by a logistic regression on labelled scores."""
    mean, scale, w = fit_logistic(dice[:, None], same.astype(float), penalty=0.01)
    x = (np.arange(bins) + 0.5) / bins
    return [float(v) for v in 1 / (1 + np.exp(-np.clip(w[0] + w[1] * np.clip((x - mean[0]) / scale[0], -8, 8), -30, 30)))]


def roster_rows(entries: DataFrame) -> DataFrame:
    """roster_entries as rows for ``people.parsed``."""
    blank = [F.lit(None).cast("string").alias(d) for d in DETAILS]
    return entries.select(F.col("entry_id").cast("string").alias("id"), "name", F.col("name_kana").alias("kana"), F.col("school").alias("team"), *blank).where("id is not null and name is not null")


def checked(near: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, check) of pairs (uids): the score of the exact check of name, reading, team and details."""
    side = lambda df, s: df.select(*[(F.array_join(f, " ") if f == "parts" else F.col(f)).alias(f"{s}_{f}") for f in ("uid", *FIELDS)])
    both = near.join(side(left, "a"), F.col("a") == F.col("a_uid")).join(side(right, "b"), F.col("b") == F.col("b_uid"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = len(FIELDS)
        for batch in batches:
            out = []
            for a, b, *v in batch.itertuples(index=False, name=None):
                x, y = dict(zip(FIELDS, v[:n], strict=True)), dict(zip(FIELDS, v[n:], strict=True))
                x["parts"], y["parts"] = (x["parts"] or "").split(), (y["parts"] or "").split()
                out.append((a, b, pair_score(x, y)))
            yield pd.DataFrame(out, columns=["a", "b", "check"])

    return both.select("a", "b", *[f"{s}_{f}" for s in "ab" for f in FIELDS]).mapInPandas(run, "a bigint, b bigint, check double")


def _kind_of(category) -> object:
    """One vocabulary for the category of a record."""
    c = F.lower(F.trim(category))
    return F.when(c.contains("高") | (c == "hs"), "hs").when(c.contains("大") | c.startswith("univ"), "univ").when(c.contains("社会人") | (c == "corporate"), "corporate").when(c.contains("独立") | c.startswith("independent"), "independent")


def scored_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, dice) of the pairs of two sources (``with_bits``) that are close in a view."""
    near = close_codes(left, right, checkpointed(near_teams(left, right)))
    side = lambda df, s: df.select(*[F.col(c).alias(f"{s}_{c}") for c in ("uid", "year", "category", "name", "said", "place")])
    both = near.join(side(left, "a"), F.col("a") == F.col("a_uid")).join(side(right, "b"), F.col("b") == F.col("b_uid"))
    return both.select("a", "b", weighted_dice().alias("dice"))


def _with_years(rows: DataFrame, units: DataFrame, about: DataFrame) -> DataFrame:
    """Units with the year and category that most of their rows have; ``about``: id, year, category."""
    known = rows.select("id", "unit").join(about, "id").groupBy("unit").agg(F.mode("year", True).alias("year"), F.mode("category", True).alias("category"))
    return units.join(known, "unit", "left")


def confidences(best: DataFrame, left: DataFrame, right: DataFrame, bins: int, sample: int) -> list[float]:
    """Chance of one person per score bin of ``best`` (a, b, dice, bin)."""
    some = checkpointed(best.select("a", "b", "dice").orderBy(F.xxhash64("a", "b"), "a", "b").limit(sample))
    told = some.join(checked(some.select("a", "b"), left, right), ["a", "b"]).select("dice", (F.col("check") > 0).alias("same")).toPandas()
    if told["same"].nunique() == 2:
        return fitted_table(told["dice"].to_numpy(), told["same"].to_numpy(), bins)
    counts = {r["bin"]: r["n"] for r in best.groupBy("bin").agg(F.count("*").alias("n")).collect()}
    return confidence_table(np.array([counts.get(i, 0) for i in range(bins)], dtype=float))


def matches(entries: DataFrame, candidates: DataFrame, least: float = 0.5, bins: int = 100, sample: int = 20_000) -> DataFrame:
    """(candidate_id, entry_id, confidence): rows of the two sources meant for one person.

    An entry is matched to the persons whose best spelling gives a confidence of ``least`` or more, unless the check
    excludes it. The confidence of a score is fitted to at most ``sample`` pairs, chosen by hash, that the check has
    labelled; where it gives them one label only, to the histogram of all scores. Rows without name or id, and entries without a school, match nothing; repeated rows give one row
    each pair; an empty side gives none. Other columns are not read.
    """
    rows = checkpointed(people.parsed(people.candidate_rows(candidates)))
    units, persons = people.person_units(rows)
    right_units = checkpointed(_with_years(rows, units.drop("vector"), candidates.select("id", F.col("draft_year").cast("string").alias("year"), _kind_of(F.col("category")).alias("category"))).join(persons, "unit"))
    listed = checkpointed(people.parsed(roster_rows(entries)))
    left_units = people.units_of(listed).withColumn("uid", F.monotonically_increasing_id())
    left_units = checkpointed(_with_years(listed, left_units, entries.select(F.col("entry_id").cast("string").alias("id"), F.col("season").cast("string").alias("year"), _kind_of(F.col("category")).alias("category"))))
    scores = scored_pairs(checkpointed(with_bits(left_units)), checkpointed(with_bits(right_units)))
    best = scores.join(right_units.select(F.col("uid").alias("b"), "person"), "b").groupBy("a", "person").agg(F.max_by(F.struct("b", "dice"), F.struct("dice", "b")).alias("_b"))
    best = checkpointed(best.select("a", "person", "_b.b", "_b.dice", F.least(F.lit(bins - 1), F.floor(F.col("_b.dice") * bins)).cast("int").alias("bin")))
    table = confidences(best, left_units, right_units, bins, sample)
    chosen = best.withColumn("confidence", F.get(F.array(*map(F.lit, table)), F.col("bin"))).where(F.col("confidence") >= least)
    kept = chosen.join(checked(chosen.select("a", "b"), left_units, right_units), ["a", "b"]).where("check > 0")
    found = kept.join(left_units.select(F.col("uid").alias("a"), F.col("unit").alias("_u")), "a").join(listed.select(F.col("id").alias("entry_id"), F.col("unit").alias("_u")), "_u")
    found = found.join(persons, "person").join(rows.select(F.col("id").alias("candidate_id"), "unit"), "unit")
    kind = dict(entries.dtypes)["entry_id"]
    return found.groupBy("candidate_id", F.col("entry_id").cast(kind).alias("entry_id")).agg(F.max("confidence").alias("confidence"))
