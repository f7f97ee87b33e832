"""Records that share most of their text, found without comparing all pairs.

A body's letters and digits give a signature of one-bit minhashes over five-letter shingles. It is cut into
segments few enough that, of two signatures at most ``2 * segments - 1`` bits apart, one segment differs by at
most one bit: each segment is indexed once for every bit left out, equal entries meet in an equality join, and
the pairs are verified on the texts. Equal bodies are one class before that, so copies are indexed once.

Texts whose parts were replaced or moved have signatures further apart than that. They meet in their runs: every
window of 40 letters has a fingerprint, the rarest of its 24-letter shingles, so that equal windows have equal ones
and neighbours mostly share theirs. The most frequent that stand for a tenth of a text's windows aren't indexed;
pairs that have those of 15 % of the windows of either text in common are verified too. So every pair with a quarter
of either's windows in common is met for certain.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugoutline.session import checkpointed, shuffled

SHINGLE = 5
SEGMENT_BITS = 32
#: Shingle, shingles in a window, least share (in 1/10000) of the windows that two texts have in common in the index,
#: and share of a text's windows, those with the most frequent fingerprints, that is not indexed.
RUN, WINDOW, COMMON, FREQUENT = 24, 17, 1500, 1000
#: Texts below this are also indexed by each of their 8-letter shingles.
SHORT = 200
RARITY_BITS, SLICES = 20, 256
_BASE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = re.compile(r"[\W_]+")


def letters(text: str | None) -> str:
    """Letters and digits, width and case folded."""
    return _OTHER.sub("", unicodedata.normalize("NFKC", text or "").lower())


def shingles(text: str, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` letters, in their order."""
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    m = max(0, len(a) - n + 1)
    h = np.zeros(m, dtype=np.uint64)
    for i in range(n):
        h *= _BASE
        h += a[i : i + m].astype(np.uint64)
    for shift, factor in ((29, 0xBF58476D1CE4E5B9), (32, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def signature(text: str, segments: int) -> list[int]:
    """One bit for each of ``32 * segments`` minhashes (one permutation, empty cells filled from the next)."""
    size = segments * SEGMENT_BITS
    h = np.unique(shingles(text, min(SHINGLE, max(1, len(text)))))
    cell = ((h >> np.uint64(40)) % np.uint64(size)).astype(np.int64)
    order = np.lexsort((h, cell))
    cell, h = cell[order], h[order]
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    at, least = cell[first], h[first]
    value = least[np.searchsorted(at, np.arange(size)) % len(at)]
    bits = ((value >> np.uint64(3)) & np.uint64(1)).astype(np.uint64).reshape(segments, SEGMENT_BITS)
    return [int(x) for x in (bits << np.arange(SEGMENT_BITS, dtype=np.uint64)).sum(axis=1)]


def carried(a: str, b: str) -> float:
    """Share of letters that lie in runs found in the other text, of the text where it is less.

    A run has 8 letters, or 16 where both texts are mostly ASCII, whose words are longer, and in a short text at most
    a quarter of it. What is over two thirds of either text is at least half as long as the longer.
    """
    if a == b:
        return 1.0
    n = 16 if 2 * sum(map(str.isascii, a)) > len(a) and 2 * sum(map(str.isascii, b)) > len(b) else 8
    n = min(n, max(2, min(len(a), len(b)) // 4))
    x, y = shingles(a, n), shingles(b, n)
    if not len(x) or not len(y):
        return 0.0
    if min(len(a), len(b)) < 0.5 * max(len(a), len(b)):
        return 0.0

    def share(own: np.ndarray, other: np.ndarray, size: int) -> float:
        hit = np.isin(own, other).astype(np.int32)
        edge = np.zeros(size + 1, dtype=np.int32)
        edge[: len(hit)] += hit
        edge[n : n + len(hit)] -= hit
        return float(np.count_nonzero(np.cumsum(edge[:-1]) > 0)) / size

    return min(share(x, y, len(a)), share(y, x, len(b)))


def classes_of(df: DataFrame, id_col: str, text_col: str, segments: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with letters (id, digest), their distinct texts (digest, uid, id, signature), and all texts (id, text, mark).

    ``uid`` is a number that is written with the rows, so it stays the same when a task is run again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            body = [letters(t) for t in b["text"]]
            keep = [i for i, t in enumerate(body) if t]
            digests = [hashlib.sha256(body[i].encode("utf-8", "surrogatepass")).digest()[:20] for i in keep]
            yield pd.DataFrame({"id": pd.Series([b["id"].iloc[i] for i in keep], dtype=object), "mark": [int(b["mark"].iloc[i]) for i in keep], "digest": digests, "signature": [signature(body[i], segments) for i in keep]})

    source = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark")).where("id is not null and text is not null and trim(text) <> ''")
    rows = checkpointed(source.mapInPandas(run, "id string, mark bigint, digest binary, signature array<bigint>").withColumn("uid", F.monotonically_increasing_id()))
    first = rows.groupBy("digest").agg(F.min_by(F.struct("uid", "id", "mark", "signature"), "uid").alias("f"))
    return rows.select("id", "digest"), first.select("digest", "f.*"), source


def _verified(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            share = np.array([carried(letters(x), letters(y)) for x, y in zip(b["text_a"], b["text_b"], strict=True)], dtype=float)
            keep = share >= threshold
            yield pd.DataFrame({"a": b["a"][keep], "b": b["b"][keep], "share": share[keep]})

    return run


def close_signatures(bodies: DataFrame) -> DataFrame:
    """(a, b): uids of the texts that have a segment at most one bit apart, a < b.

    An index entry is two numbers: the segment without one bit, and the uid with that bit. Of equal segments only
    the entry without the first bit counts, of others the one without the differing bit, so a pair is met once a
    segment.
    """
    w, seg = F.col("w"), F.col("seg")
    bit = F.expr("shiftright(bits, w) & 1")
    indexed = (
        bodies.select("uid", F.posexplode("signature").alias("seg", "bits"))
        .select("uid", "seg", "bits", F.explode(F.sequence(F.lit(0), F.lit(SEGMENT_BITS - 1))).alias("w"))
        .select((F.col("bits") - bit * F.expr("shiftleft(1L, w)") + (seg * SEGMENT_BITS + w) * F.lit(1 << SEGMENT_BITS)).alias("key"), (F.col("uid") * 2 + bit).alias("code"))
    )
    a, b = indexed.withColumnRenamed("code", "ca"), indexed.withColumnRenamed("code", "cb")
    ua, ub = F.expr("shiftright(ca, 1)"), F.expr("shiftright(cb, 1)")
    first_bit = F.expr(f"pmod(shiftright(key, {SEGMENT_BITS}), {SEGMENT_BITS})") == 0
    met = shuffled(a).join(shuffled(b), "key").where((ua < ub) & ((F.col("ca").bitwiseXOR(F.col("cb")).bitwiseAND(F.lit(1)) == 1) | first_bit))
    return met.select(ua.alias("a"), ub.alias("b")).distinct()


def fingerprints(text: str, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the windows of a text's letters, and the share of its windows that each stands for, in 1/10000 rounded up."""
    keys, shares = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int32)]
    for n, w in ((RUN, WINDOW), *([(8, 1)] if len(text) < SHORT else [])):
        h = shingles(text, n)
        if len(h) < w:
            continue
        order = (seen[(h >> np.uint64(64 - RARITY_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24))
        key, count = np.unique(np.lib.stride_tricks.sliding_window_view(order, w).min(axis=1), return_counts=True)
        windows = len(h) - w + 1
        kept = np.cumsum(count[::-1])[::-1] * 10_000 > FREQUENT * windows  # keys are in the order of rarity
        keys.append(key[kept].astype(np.int64))
        shares.append(-(-count[kept] * 10_000 // windows).astype(np.int32))
    return np.concatenate(keys), np.concatenate(shares)


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """How many of the texts have a shingle of each hash bucket, over all of them.

    A task counts its texts in one array and gives it in slices, which are summed slice by slice; the driver gets the
    sums as one array of fixed size.
    """
    cut = np.int32((1 << 23) - 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(1 << RARITY_BITS, dtype=np.int32)
        for b in batches:
            for text in b["text"]:
                seen[np.unique(shingles(letters(text), RUN) >> np.uint64(64 - RARITY_BITS)).astype(np.int64)] += 1
        yield pd.DataFrame({"slice": range(SLICES), "n": [x.tobytes() for x in seen.reshape(SLICES, -1)]})

    def total(part: pd.DataFrame) -> pd.DataFrame:
        n = np.zeros((1 << RARITY_BITS) // SLICES, dtype=np.int64)
        for x in part["n"]:
            n += np.frombuffer(x, dtype=np.int32)
        return pd.DataFrame({"slice": part["slice"].iloc[:1], "n": [np.minimum(n, cut).astype(np.int32).tobytes()]})

    schema = "slice int, n binary"
    seen = np.zeros((SLICES, (1 << RARITY_BITS) // SLICES), dtype=np.int32)
    for r in texts.select("text").mapInPandas(run, schema).groupBy("slice").applyInPandas(total, schema).collect():
        seen[r["slice"]] = np.frombuffer(r["n"], dtype=np.int32)
    return seen.reshape(-1)


def common_runs(bodies: DataFrame, source: DataFrame) -> DataFrame:
    """(a, b): uids of the texts that have fingerprints of enough of their windows in common, a < b."""
    seen = bodies.sparkSession.sparkContext.broadcast(shingle_counts(source))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.iloc[at : at + 500]
                own = [fingerprints(letters(t), seen.value) for t in part["text"]]
                yield pd.DataFrame({"key": np.concatenate([k for k, _ in own]), "uid": np.repeat(part["uid"].to_numpy(), [len(k) for k, _ in own]), "part": np.concatenate([n for _, n in own])})

    texts = bodies.select("uid", "id", "mark").join(source, ["id", "mark"]).dropDuplicates(["uid"]).select("uid", "text")
    indexed = checkpointed(texts.mapInPandas(run, "key bigint, uid bigint, part int"))
    a, b = (indexed.select("key", F.col("uid").alias(x), F.col("part").alias(f"part_{x}")) for x in "ab")
    met = shuffled(a).join(shuffled(b), "key").where("a < b").groupBy("a", "b").agg(F.sum("part_a").alias("of_a"), F.sum("part_b").alias("of_b"))
    return met.where((F.col("of_a") >= COMMON) & (F.col("of_b") >= COMMON)).select("a", "b")


def class_pairs(bodies: DataFrame, source: DataFrame, threshold: float) -> DataFrame:
    """Pairs of distinct texts (a, b as digests, share) that agree."""
    close = checkpointed(close_signatures(bodies).unionByName(common_runs(bodies, source)).distinct())
    known = bodies.select("uid", "id", "mark", "digest")
    wanted = close.select(F.explode(F.array("a", "b")).alias("uid")).distinct().join(known, "uid")
    texts = wanted.join(source, ["id", "mark"]).dropDuplicates(["uid"])
    side = lambda x: texts.select(F.col("uid").alias(x), F.col("text").alias(f"text_{x}"), F.col("digest").alias(f"digest_{x}"))
    both = close.join(side("a"), "a").join(side("b"), "b").select(F.col("digest_a").alias("a"), F.col("digest_b").alias("b"), "text_a", "text_b")
    return both.mapInPandas(_verified(threshold), "a binary, b binary, share double")


def near_duplicate_pairs(df: DataFrame, id_col: str = "id", text_col: str = "body", threshold: float = 0.66, segments: int = 10) -> DataFrame:
    """(id_a, id_b): every pair of rows whose texts share ``threshold`` of their letters in runs, id_a < id_b.

    Equal texts are pairs too. Null and blank texts and texts without letters or digits match nothing; an id that
    is repeated counts once; an empty table gives no pair. Other columns are not read.
    """
    rows, bodies, source = classes_of(df, id_col, text_col, segments)
    members = rows.distinct()
    pairs = class_pairs(bodies, source, threshold)
    a, b = members.select(F.col("id").alias("x"), F.col("digest").alias("a")), members.select(F.col("id").alias("y"), F.col("digest").alias("b"))
    across = pairs.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    within = a.join(b, F.col("a") == F.col("b")).where("x < y").select(F.col("x").alias("id_a"), F.col("y").alias("id_b"))
    return across.unionByName(within).distinct()


def story_links(df: DataFrame, id_col: str = "id", text_col: str = "body", threshold: float = 0.66, segments: int = 10) -> DataFrame:
    """(class_id, rows, links): one row per distinct text with its copies and its number of near-duplicate texts."""
    rows, bodies, source = classes_of(df, id_col, text_col, segments)
    pairs = class_pairs(bodies, source, threshold)
    links = pairs.select(F.explode(F.array("a", "b")).alias("digest")).groupBy("digest").agg(F.count("*").alias("links"))
    return rows.groupBy("digest").agg(F.countDistinct("id").alias("rows"), F.min("id").alias("class_id")).join(links, "digest", "left").select("class_id", "rows", F.coalesce("links", F.lit(0)).alias("links"))
