"""Spellings of one person's name linked and grouped.

Each distinct spelling at a team is a unit. Its name grams (written form, and reading where one is known) give two
idf-weighted vectors, and the characters of its team another; a unit's vector is their tensor product, so the cosine
of two units is that of the names times that of the teams. Pairs that reach the threshold are found exactly by a
join on the grams at near spellings of a team, checked on name, reading, team and personal details, and grouped
by average linkage in each component.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dugoutline.operators.graph import components
from dugoutline.llm.names import edits, parse_name, reading_of, same_team, short_vowels, team_key
from dugoutline.session import checkpointed, shuffled

DETAILS = ("birth_date", "height_cm", "weight_kg", "fastball_max", "throws", "bats", "positions", "player_id")
#: What an equal detail adds to a pair's score.
WEIGHT = {"birth_date": 0.4, "height_cm": 0.2, "weight_kg": 0.2, "fastball_max": 0.2, "player_id": 0.4, "throws": 0.0, "bats": 0.03, "positions": 0.03}
_UNIT = "unit string, id string, full string, parts array<string>, reading string, own_reading boolean, surname_reading string, given_reading string, initial string, nick string, kind string, team string"


def parsed(rows: DataFrame) -> DataFrame:
    """(id, name, kana, team, details) brought to parts; rows without a name have none. Details are text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, name, kana, team, *details in b[["id", "name", "kana", "team", *DETAILS]].itertuples(index=False):
                n, t = parse_name(name, kana), team_key(team)
                if not n["full"]:
                    continue
                weak = n["initial"] or n["nick"] or (n["kind"] == "kanji" and len(n["full"]) < 3)
                unit = "\u0001".join([" ".join(n["parts"]), n["initial"], n["nick"], n["kind"], t, *([n["reading"], *(str(d) for d in details)] if weak else [])])
                spoken = [short_vowels(x) for x in reading_of(kana).split()]
                two = len(spoken) == 2 and len(n["parts"]) == 2 and n["kind"] == "kanji"
                out.append((unit, i, n["full"], n["parts"], n["reading"], bool(n["reading"]), spoken[0] if two else None, spoken[1] if two else None, n["initial"], n["nick"], n["kind"], t, *details))
            yield pd.DataFrame(out, columns=["unit", "id", "full", "parts", "reading", "own_reading", "surname_reading", "given_reading", "initial", "nick", "kind", "team", *DETAILS])

    return rows.mapInPandas(run, _UNIT + "".join(f", {d} string" for d in DETAILS)).withColumn("unit", F.sha2("unit", 256))


def candidate_rows(candidates: DataFrame) -> DataFrame:
    """player_candidates as rows for ``parsed``."""
    team = F.coalesce(F.when(F.trim("team") != "", F.col("team")), F.col("team_name"))
    text = {d: F.col(d).cast("string") for d in DETAILS} | {"positions": F.to_json(F.array_sort("positions"))}
    return candidates.select("id", "name", F.col("name_kana").alias("kana"), team.alias("team"), *[c.alias(d) for d, c in text.items()]).where("id is not null and name is not null")


def units_of(rows: DataFrame) -> DataFrame:
    """One row per spelling at a team, with the details and the longest reading any of its rows has, else a learned one.

    A surname's or given name's reading is learned as the one most often written in the same parts.
    """
    details = [F.max(d).alias(d) for d in DETAILS]
    first = [F.first(c, ignorenulls=True).alias(c) for c in ("full", "parts", "initial", "nick", "kind", "team")]
    longest = F.max_by("reading", F.length("reading")).alias("reading")
    units = rows.groupBy("unit").agg(*first, longest, *details, F.count("*").alias("rows"))

    def learned(part: str, at: int) -> DataFrame:
        said = rows.where(f"{part} is not null").groupBy(F.get("parts", F.lit(at)).alias("_k"), part).agg(F.count("*").alias("_n"))
        return said.groupBy("_k").agg(F.max_by(part, F.struct("_n", part)).alias(f"_{part}"))

    short = (F.size("parts") == 1) & (F.length("full") == 4)
    sur = F.when(short, F.substring("full", 1, 2)).otherwise(F.get("parts", F.lit(0)))
    given = F.when(short, F.substring("full", 3, 2)).when(F.size("parts") > 1, F.get("parts", F.lit(1)))
    letters = kanji_readings(rows)
    u = units.withColumn("_s", sur).withColumn("_g", given)
    for part, at, key in (("surname_reading", 0, "_s"), ("given_reading", 1, "_g")):
        u = u.join(learned(part, at).withColumnRenamed("_k", key), key, "left")
        for place in (1, 2):
            one = letters.where(F.col("place") == place).select(F.col("char").alias(f"_c{place}"), F.col("said").alias(f"_r{place}"))
            u = u.withColumn(f"_c{place}", F.when(F.length(key) == 2, F.substring(F.col(key), place, 1))).join(F.broadcast(one), f"_c{place}", "left")
        u = u.withColumn(f"_{part}", F.coalesce(f"_{part}", F.concat("_r1", "_r2"))).drop("_c1", "_c2", "_r1", "_r2")
    own = F.col("reading") != ""
    guess = F.when(F.col("_g").isNull() & (F.length("nick") > 0), F.concat("_surname_reading", "nick")).when(F.col("_g").isNull(), F.col("_surname_reading")).otherwise(F.concat("_surname_reading", "_given_reading"))
    return u.withColumn("own_reading", own).withColumn("reading", F.when(own, F.col("reading")).otherwise(F.coalesce(guess, F.lit("")))).withColumn("surname_said", F.coalesce("_surname_reading", F.lit(""))).drop("_s", "_g", "_surname_reading", "_given_reading")


def kanji_readings(rows: DataFrame) -> DataFrame:
    """(char, place, said): the likely reading of a kanji that is first or second of two.

    Of the heads (tails) of the readings of all parts with it, the longest that nearly as many distinct parts
    have as have the commonest one. The table has at most two rows per kanji there is, so it may be broadcast.
    """
    said = rows.select(F.explode(F.array(F.struct(F.get("parts", F.lit(0)).alias("part"), F.col("surname_reading").alias("r")), F.struct(F.get("parts", F.lit(1)).alias("part"), F.col("given_reading").alias("r")))).alias("x")).select("x.part", "x.r")
    two = said.where("length(part) = 2 and length(r) between 2 and 8").distinct()
    cut = two.select("part", "r", F.explode(F.sequence(F.lit(1), F.length("r") - 1)).alias("k"))
    ends = cut.select(F.explode(F.array(
        F.struct(F.substring("part", 1, 1).alias("char"), F.lit(1).alias("place"), F.expr("left(r, k)").alias("said"), F.col("part")),
        F.struct(F.substring("part", 2, 1).alias("char"), F.lit(2).alias("place"), F.expr("right(r, k)").alias("said"), F.col("part")),
    )).alias("x")).select("x.*").distinct()
    n = ends.groupBy("char", "place", "said").agg(F.count("*").alias("n"))
    best = n.withColumn("top", F.max("n").over(Window.partitionBy("char", "place"))).where("n >= 0.75 * top")
    return best.groupBy("char", "place").agg(F.max_by("said", F.struct(F.length("said"), F.col("n"), F.col("said"))).alias("said"))


def _grams(text, n: int):
    size = F.length(text)
    return F.array_distinct(F.when(size > n, F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).when(size > 0, F.array(text)).otherwise(F.array().cast("array<string>")))


def with_vectors(units: DataFrame) -> DataFrame:
    """``units`` with ``uid`` and ``vector``: the idf-weighted grams of the written name and of the reading, each view of
    length 1."""
    written = F.when(F.col("kind") == "kanji", F.col("full")).otherwise(F.lit(""))
    total = F.lit(float(units.count()))
    of_view = lambda v, text: F.transform(_grams(text, 2), lambda g: F.struct(F.lit(v).alias("view"), g.alias("gram")))
    long = units.select("unit", F.inline(F.concat(of_view(0, written), of_view(1, F.col("reading")))))
    known = long.groupBy("view", "gram").agg(F.log1p(total / F.count("*")).alias("idf"))
    vectors = shuffled(long).join(known, ["view", "gram"]).groupBy("unit").agg(F.collect_list(F.struct("view", "gram", "idf")).alias("_v"))
    norm = lambda v: F.sqrt(F.aggregate(F.filter("_v", lambda x: x["view"] == v), F.lit(0.0), lambda s, x: s + x["idf"] * x["idf"]))
    lengths = vectors.withColumns({"_n0": norm(0), "_n1": norm(1)})
    vector = F.transform("_v", lambda x: F.struct(x["view"].alias("view"), x["gram"].alias("gram"), (x["idf"] / F.when(x["view"] == 0, F.col("_n0")).otherwise(F.col("_n1"))).alias("w")))
    return units.join(lengths.select("unit", vector.alias("vector")), "unit", "left").withColumn("uid", F.monotonically_increasing_id())


def near_teams(own: DataFrame, other: DataFrame) -> DataFrame:
    """(team, near, cosine): the spellings of ``other`` that may mean a team of ``own``, with the cosine of their characters.

    Spellings one edit apart share one of their forms without one character, and one that begins with another has it
    among its heads, so the join is one of equal keys. Each column ``team``; blanks match nothing.
    """
    forms = lambda t: F.array_distinct(F.concat(F.array(t), F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))))
    heads = lambda t: F.when(F.length(t) > 2, F.transform(F.sequence(F.lit(2), F.length(t) - 1), lambda i: F.substring(t, F.lit(1), i))).otherwise(F.array().cast("array<string>"))
    mark = lambda kind, xs: F.transform(xs, lambda x: F.concat(F.lit(kind), x))
    t = F.col("team")

    def keyed(df: DataFrame, head: str, whole: str) -> DataFrame:
        return df.where("team <> ''").select("team").distinct().select("team", F.explode(F.concat(mark("e", forms(t)), mark(head, heads(t)), mark(whole, F.array(t)))).alias("key"))

    met = shuffled(keyed(own, "a", "b")).join(keyed(other, "b", "a").withColumnRenamed("team", "near"), "key").select("team", "near").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            kept = [(x, y, len({*x} & {*y}) / (len({*x}) * len({*y})) ** 0.5) for x, y in zip(b["team"], b["near"], strict=True) if same_team(x, y) > 0]
            yield pd.DataFrame(kept, columns=["team", "near", "cosine"])

    return met.mapInPandas(run, "team string, near string, cosine double")


def cosine_pairs(units: DataFrame, threshold: float) -> DataFrame:
    """(a, b, cosine): uids of units, a < b, whose cosine reaches the threshold in either view.

    A unit's vector is the product of its name's and its team's, so the cosine is that of the names times that of the
    teams, and only units at near spellings of a team need to meet. They do so on equal name grams at a team; all
    shared grams of a pair meet, so the sum is the cosine.
    """
    teams = checkpointed(near_teams(units, units))
    token = F.xxhash64("near", "view", "gram")
    each = units.where("team <> ''").select("uid", "team", F.inline("vector"))
    a = each.join(teams, "team").select(token.alias("token"), F.col("view").alias("view"), F.col("uid").alias("a"), (F.col("w") * F.col("cosine")).alias("wa"))
    b = each.withColumnRenamed("team", "near").select(token.alias("token"), F.col("uid").alias("b"), F.col("w").alias("wb"))
    met = shuffled(a).join(shuffled(b), "token").where("a < b")
    near = met.groupBy("a", "b", "view").agg(F.sum(F.col("wa") * F.col("wb")).alias("cosine")).where(F.col("cosine") >= threshold - 1e-9)
    return near.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))


def _prefix(a: str, b: str, least: int = 1) -> bool:
    return min(len(a), len(b)) >= least and (a.startswith(b) or b.startswith(a))


def name_score(a: dict, b: dict) -> float:
    """How well two names at one team agree, 0 for different names and -1 for readings that exclude each other."""
    fa, fb, ra, rb = a["full"], b["full"], a["reading"], b["reading"]
    weak_a, weak_b = bool(a["initial"] or a["nick"]), bool(b["initial"] or b["nick"])
    both_written = a["kind"] == b["kind"] == "kanji"
    said = bool(ra and rb)
    surely = said and a["own_reading"] and b["own_reading"]
    apart = edits(ra, rb, 3) if said else 4
    close = said and (ra == rb or (min(len(ra), len(rb)) >= 4 and (_prefix(ra, rb, 4) or apart <= (1 if len(ra) < 6 else 2))))
    if both_written and not weak_a and not weak_b:
        if fa == fb:
            return 1.0
        pa, pb = list(a["parts"]), list(b["parts"])
        if len(pa) == 2 and (pa[1] + pa[0] == fb) or len(pb) == 2 and (pb[1] + pb[0] == fa):
            return 0.95
        if surely and not close:
            return -1.0
        if _prefix(fa, fb, 2):
            # one lacks the end of the given name or all of it
            short = min(len(fa), len(fb))
            return 0.9 if surely and close else 0.75 if short >= 3 else 0.55
        d = edits(fa, fb, 2)
        if min(len(fa), len(fb)) >= 3 and d == 1:
            if len(fa) == len(fb) and sorted(fa) == sorted(fb):
                return 0.8
            if len(fa) != len(fb):
                return 0.8
            if said:
                return 0.85 if ra == rb else 0.35 if not surely else 0.5
            return 0.45
        if said and ra == rb:
            return 0.8 if surely else 0.5
        if d == 2 and len(fa) >= 4 and len(fb) >= 4 and sorted(fa) == sorted(fb):
            return 0.6
        return 0.0
    # one of them is kana, romanised, an initial or a nickname
    if (weak_a or weak_b) and both_written:
        x, y = (a, b) if weak_a else (b, a)
        sx, fy = x["full"], y["full"]
        surname = list(y["parts"])[0] if y["parts"] else fy
        if weak_a and weak_b:
            if fa != fb or (a["initial"] and b["initial"] and a["initial"] != b["initial"]) or (a["nick"] and b["nick"] and not _prefix(a["nick"], b["nick"])):
                return 0.0
            return 0.9 if surely and close else 0.5
        if not (fy.startswith(sx) or surname == sx or edits(sx, surname, 1) <= (1 if len(sx) > 2 else 0) or (len(y["parts"]) == 2 and list(y["parts"])[1] == sx)):
            return 0.0
        if surely:
            return 0.9 if close else -1.0 if not _prefix(ra, rb, 3) else 0.5
        return _given_fits(x, y)
    if not said:
        return 0.0
    if weak_a or weak_b:
        x, y = (a, b) if weak_a else (b, a)
        rx, ry = x["reading"], y["reading"]
        if x["own_reading"] and len(rx) > 5 and close:
            return 0.9
        head = x["surname_said"] if x["kind"] == "kanji" else x["full"]
        if head and (ry.startswith(head) or edits(ry[: len(head)], head, 1) == 1):
            return _given_fits(x, y | {"surname_said": ry[: len(head)]})
        return 0.0
    if ra == rb:
        return 0.95
    pa, pb = list(a["parts"]), list(b["parts"])
    for own, parts, other in ((a, pa, rb), (b, pb, ra)):
        if own["kind"] != "kanji" and len(parts) == 2 and (d := edits(parts[1] + parts[0], other, 2)) <= (2 if len(other) >= 7 else 0):
            return 0.9 if d == 0 else 0.7
    if apart == 1 or (apart == 2 and min(len(ra), len(rb)) >= 6) or (apart == 3 and min(len(ra), len(rb)) >= 9):
        return 0.8 if apart == 1 else 0.65
    if _prefix(ra, rb, 4):
        return 0.7
    return 0.0


_SOUND = {"あ": "a", "い": "i", "う": "u", "え": "e", "お": "o", "か": "k", "き": "k", "く": "k", "け": "k", "こ": "k", "さ": "s", "し": "s", "す": "s", "せ": "s", "そ": "s", "た": "t", "ち": "ct", "つ": "t", "て": "t", "と": "t", "な": "n", "に": "n", "ぬ": "n", "ね": "n", "の": "n", "は": "h", "ひ": "h", "ふ": "fh", "へ": "h", "ほ": "h", "ま": "m", "み": "m", "む": "m", "め": "m", "も": "m", "や": "y", "ゆ": "y", "よ": "y", "ら": "r", "り": "r", "る": "r", "れ": "r", "ろ": "r", "わ": "w", "が": "g", "ぎ": "g", "ぐ": "g", "げ": "g", "ご": "g", "ざ": "z", "じ": "jz", "ず": "z", "ぜ": "z", "ぞ": "z", "だ": "d", "で": "d", "ど": "d", "ば": "b", "び": "b", "ぶ": "b", "べ": "b", "ぼ": "b", "ぱ": "p", "ぴ": "p"}


def _given_fits(x: dict, y: dict) -> float:
    """Whether an initial or nickname fits the given name of ``y``; 0.4 where its reading is unknown."""
    head, r = y["surname_said"] or x["surname_said"], y["reading"]
    if not r or not head or not r.startswith(head) or len(r) <= len(head):
        return 0.4
    given = r[len(head) :]
    if x["initial"]:
        return 0.65 if x["initial"] in _SOUND.get(given[0], "") else 0.0
    if x["nick"]:
        return 0.85 if given == x["nick"] else 0.7 if given.startswith(x["nick"][:2]) or x["nick"].startswith(given) else 0.0
    return 0.5


def pair_score(a: dict, b: dict) -> float:
    """Score of two units: below 0 where details or readings exclude one person."""
    team = same_team(a["team"], b["team"])
    if team == 0.0:
        return 0.0
    n = name_score(a, b)
    agree, clash = 0.0, False
    for d in DETAILS:
        x, y = a[d], b[d]
        if x and y and x == x and y == y:
            if x == y:
                agree += WEIGHT[d]
            else:
                clash = True
    if clash and n < 1.0:
        return -1.0
    if clash and team < 1.0:
        return -1.0
    if n <= 0:
        return n
    return n + min(0.4, agree) - (1.0 - team) * 0.5


def average_linkage(pairs: list[tuple[str, str, float]], least: float) -> dict[str, str]:
    """Clusters of the nodes of scored pairs: the two with the best mean score are joined while it reaches ``least``.

    The mean is over all pairs of a node of one and a node of the other; those that have no score count 0. Ties go to
    the least names.
    """
    members: dict[str, list[str]] = {}
    sums: dict[str, dict[str, float]] = {}
    for a, b, s in pairs:
        for x in (a, b):
            members.setdefault(x, [x])
            sums.setdefault(x, {})
        sums[a][b] = sums[b][a] = sums[a].get(b, 0.0) + s
    mean = lambda a, b: sums[a][b] / (len(members[a]) * len(members[b]))
    heap = [(-t, min(a, b), max(a, b)) for a, near in sums.items() for b, t in near.items() if a < b and t >= least]
    heapq.heapify(heap)
    while heap:
        s, a, b = heapq.heappop(heap)
        if a not in members or b not in members or b not in sums[a] or abs(mean(a, b) + s) > 1e-12:
            continue
        members[a] += members.pop(b)
        gone = sums.pop(b)
        del sums[a][b]
        for c, t in gone.items():
            if c != a:
                del sums[c][b]
                sums[a][c] = sums[c][a] = sums[a].get(c, 0.0) + t
        for c in sums[a]:
            if (m := mean(a, c)) >= least:
                heapq.heappush(heap, (-m, min(a, c), max(a, c)))
    return {x: min(own) for own in members.values() for x in own}


FIELDS = ("full", "parts", "reading", "own_reading", "surname_said", "initial", "nick", "kind", "team", *DETAILS)


def scored(near: DataFrame, units: DataFrame) -> DataFrame:
    """(a, b, score), a and b units, of candidate pairs (a, b as uids)."""
    side = lambda df, s: df.select(*[(F.array_join(c, " ") if c == "parts" else F.col(c)).alias(f"{s}_{c}") for c in ("uid", "unit", *FIELDS)])
    both = near.join(side(units, "a"), F.col("a") == F.col("a_uid")).join(side(units, "b"), F.col("b") == F.col("b_uid"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = len(FIELDS)
        for batch in batches:
            out = []
            for a, b, *v in batch.itertuples(index=False, name=None):
                x, y = dict(zip(FIELDS, v[:n], strict=True)), dict(zip(FIELDS, v[n:], strict=True))
                x["parts"], y["parts"] = (x["parts"] or "").split(), (y["parts"] or "").split()
                out.append((a, b, pair_score(x, y)))
            yield pd.DataFrame(out, columns=["a", "b", "score"])

    return both.select("a_unit", "b_unit", *[f"{s}_{f}" for s in "ab" for f in FIELDS]).mapInPandas(run, "a string, b string, score double")


def scored_pairs(units: DataFrame, threshold: float) -> DataFrame:
    """(a, b, score) of the unit pairs whose cosine reaches ``threshold``."""
    return scored(cosine_pairs(units, threshold), units)


def person_units(rows: DataFrame, threshold: float = 0.2, link: float = 0.55, mean: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """(unit rows with vectors, unit -> person). ``rows`` come from ``parsed``."""
    units = checkpointed(with_vectors(checkpointed(units_of(rows))))
    pairs = checkpointed(scored_pairs(units, threshold))
    parts = components(pairs.where(F.col("score") >= link), "a", "b")
    inside = pairs.join(parts.select(F.col("node").alias("a"), "component"), "a").join(parts.select(F.col("node").alias("b"), F.col("component").alias("_c")), "b").where("component = _c")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, now = [], None
        for batch in batches:
            done = []
            for c, *pair in batch.itertuples(index=False, name=None):
                if c != now:
                    done += average_linkage(part, mean).items()
                    part, now = [], c
                part.append(tuple(pair))
            if done:
                yield pd.DataFrame(done, columns=["unit", "person"])
        if part:
            yield pd.DataFrame(list(average_linkage(part, mean).items()), columns=["unit", "person"])

    # components come sorted, so one at a time is held; small ones need no frame of their own
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = inside.select("component", "a", "b", "score").repartition(tasks, "component").sortWithinPartitions("component", "a", "b").mapInPandas(run, "unit string, person string")
    people = units.select("unit").join(grouped, "unit", "left").select("unit", F.coalesce("person", "unit").alias("person"))
    return units, people


def people_of(candidates: DataFrame, **limits: float) -> DataFrame:
    """(id, person): the rows meant for one person share ``person``.

    Rows without a name or an id are left out; rows without a team meet none but equal spellings without a
    team; repeated ids give repeated rows. Columns beside those of player_candidates are not read.
    """
    rows = checkpointed(parsed(candidate_rows(candidates)))
    _, people = person_units(rows, **limits)
    return rows.select("id", "unit").join(people, "unit").select("id", "person")


def person_pairs(candidates: DataFrame, **limits: float) -> DataFrame:
    """(id_a, id_b): every pair of rows of one person, id_a < id_b."""
    own = checkpointed(people_of(candidates, **limits).distinct())
    return own.withColumnRenamed("id", "id_a").join(own.withColumnRenamed("id", "id_b"), "person").where("id_a < id_b").select("id_a", "id_b")
