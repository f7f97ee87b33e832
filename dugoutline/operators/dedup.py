"""Duplicate removal, survivor election and similarity between articles.

Groups are reduced with aggregates that combine before the shuffle (``min_by``) rather than windows where one
row of a group is wanted, so hot keys aren't gathered in one task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugoutline.functions import text as T
from dugoutline.operators.graph import components
from dugoutline.session import checkpointed


def first_by(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row of each key that is first in ``order`` (a struct); keys may be null."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(whole, order).alias("_row")).select("_row.*")


def url_first(articles: DataFrame, order: Column) -> DataFrame:
    """First article of each URL; rows with a blank URL are dropped."""
    return first_by(articles.where(F.col("url").isNotNull() & (F.col("url") != "")), ["url"], order)


def hash_priority(articles: DataFrame, seq: Column, priorities: dict[str, int] | None = None) -> DataFrame:
    """Of articles with equal title and body the one of the best source, else the first, with ``slot``: the
    place of the first of them. Articles with a short title or body pass unchanged."""
    numbered = articles.withColumns({"_seq": seq, "_prio": T.source_priority(F.col("source"), priorities)})
    long_enough = (F.length("title") > 10) & (F.length("body") > 50)
    hashed = numbered.where(long_enough).withColumn("_hash", T.content_md5(F.col("title"), F.col("body")))
    whole = F.struct(*[F.col(c) for c in articles.columns])
    kept = hashed.groupBy("_hash").agg(F.min_by(whole, F.struct("_prio", "_seq")).alias("_row"), F.min("_seq").alias("slot")).select("_row.*", "slot")
    return kept.unionByName(numbered.where(~F.coalesce(long_enough, F.lit(False))).select(*articles.columns, F.col("_seq").alias("slot")))


def ratio(a: str | None, b: str | None) -> float:
    """Sequence ratio of two texts in this order, with the popularity heuristic for long ones."""
    return SequenceMatcher(None, a or "", b or "").ratio()


def bag_ratio(a: str | None, b: str | None) -> float:
    """What the ratio of two texts can't exceed: that of their bags of characters."""
    x, y = Counter(a or ""), Counter(b or "")
    n = len(a or "") + len(b or "")
    return 2 * sum((x & y).values()) / n if n else 1.0


#: Rows in a block of articles at most, steps of a body's length (a power of 1 + 1 / STEPS), and bytes of a body's counts:
#: of runs of three or of letters, and of the letters beside the runs.
BLOCK, STEPS, COUNTS, LETTERS, RARE = 60_000, 16, 1024, 384, 128
_PRIMES = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _grams(points: np.ndarray, q: int) -> np.ndarray:
    """Hashes of the runs of ``q`` letters, of 32 bits."""
    h = np.zeros(max(0, len(points) - q + 1), dtype=np.uint64)
    for i in range(q):
        h *= _PRIMES[0]
        h += points[i : i + len(h)]
    h ^= h >> np.uint64(29)
    h *= _PRIMES[1]
    return h >> np.uint64(32)


def _counted(h: np.ndarray, size: int) -> np.ndarray:
    return np.minimum(np.bincount(h.astype(np.int64) % size, minlength=size), 255).astype(np.uint8)


def article_features(title: str, body: str) -> tuple[int, int, int, bytes, bytes]:
    """Lengths of the title and the body, the kind of the body (1: mostly ASCII, 0: not, 2: without counts), the title's
    bits and the body's counts.

    A title sets one of 256 bits for each of its letters numbered by occurrence. The counts of a body are those of its
    letters, kana by themselves and others by hash; of a body mostly in ASCII those of its runs of three, then those
    of the letters that ``SequenceMatcher`` begins a block at, then those of all letters.
    """
    points = [np.frombuffer(x.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) for x in (title, body)]
    letters = np.sort(points[0])
    nth = np.arange(len(letters)) - np.searchsorted(letters, letters)
    bits = np.zeros(256, dtype=np.uint8)
    bits[((_grams(letters, 1) + nth.astype(np.uint64) * _PRIMES[2]) * _PRIMES[1] >> np.uint64(56)).astype(np.int64)] = 1
    own, single = points[1], _grams(points[1], 1)
    if 2 * np.count_nonzero(own < 128) > len(own):
        kinds, at, n = np.unique(own, return_inverse=True, return_counts=True)
        rare = single[n[at] <= len(own) // 100 + 1] if len(own) >= 200 else single
        begins, kind = _counted(rare, RARE), 1
        counts = np.concatenate([_counted(_grams(own, 3), COUNTS), begins, _counted(single, RARE)])
        kind = 1 if begins.max() < 255 else 2  # counts cut off there would say less than there are
    else:
        kana = (own >= 0x3040) & (own < 0x3100)
        counts, kind = _counted(np.where(kana, own - np.uint64(0x3040), single % np.uint64(LETTERS - 192) + np.uint64(192)), LETTERS), 0
    return len(title), len(body), kind, np.packbits(bits).tobytes(), zlib.compress(counts.tobytes(), 1)


def _featured(df: DataFrame, t: float) -> DataFrame:
    """(id, lt, lb, kind, zone, bits, counts) of articles (id, title, body); null counts as ''.

    Of a body mostly in ASCII ``counts`` is the text itself, title and body, which is smaller than its counts. ``zone`` is 2
    where so many letters are ASCII that a body of zone 0 can't have enough letters in common with it, else 1.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            got = []
            for title, body in zip(x["title"], x["body"], strict=True):
                title, body = title or "", body or ""
                lt, lb, kind, bits, counts = article_features(title, body)
                share = len(body.encode("ascii", "ignore")) / max(1, lb)
                counts = zlib.compress((title + body).encode("utf-8", "surrogatepass"), 6) if kind else counts
                got.append((lt, lb, kind, 0 if share < t / 2 - 1e-6 else 2 if share > 1 - t / 2 + 1e-6 else 1, bits, counts))
            yield pd.DataFrame(got, columns=["lt", "lb", "kind", "zone", "bits", "counts"]).assign(id=x["id"].to_numpy())

    kind = dict(df.dtypes)["id"]
    return df.select("id", "title", "body").mapInPandas(run, f"lt int, lb int, kind int, zone int, bits binary, counts binary, id {kind}")


def _told(x: pd.DataFrame) -> tuple[pd.DataFrame, list[str], list[str]]:
    """``x`` with the counts of those articles whose text it has, and titles and bodies ('' where it hasn't)."""
    title, body, counts = [""] * len(x), [""] * len(x), x["counts"].tolist()
    for k in np.flatnonzero(x["kind"].to_numpy() > 0):
        text, lt = zlib.decompress(counts[k]).decode("utf-8", "surrogatepass"), x["lt"].iloc[k]
        title[k], body[k] = text[:lt], text[lt:]
        counts[k] = article_features(title[k], body[k])[4]
    return x.assign(counts=counts), title, body


def _blocks(df: DataFrame) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """``df`` (seq, lb, zone) with ``block``, and of each block its zone and the lengths of its bodies as a range. A block
    has bodies of one zone and of similar lengths, BLOCK of them at most; equal lengths are spread over blocks if they
    are more."""
    step = F.floor(F.log(F.col("lb") + 1) / F.log(F.lit(1 + 1 / STEPS)))
    stepped = df.withColumn("_step", step)
    counted = stepped.groupBy("zone", "_step").agg(F.count("*").alias("n"), F.min("lb").alias("lo"), F.max("lb").alias("hi"))
    sizes = sorted((r["zone"], r["_step"], r["n"], r["lo"], r["hi"]) for r in counted.collect())
    ranges, plan, of = [], [], None
    for zone, at, n, lo, hi in sizes:
        if zone != of:
            most = min(BLOCK, max(1_000, sum(x[2] for x in sizes if x[0] == zone) // 6))
            of, held = zone, most
        parts = -(-n // most)
        if parts > 1 or held + n > most:
            ranges += [(zone, lo, hi)] * parts
            held = n if parts == 1 else most
        else:
            ranges[-1] = (zone, ranges[-1][1], hi)
            held += n
        plan.append((zone, at, len(ranges) - parts, parts))
    places = df.sparkSession.createDataFrame(plan, "zone int, _step bigint, _first int, _parts int")
    block = (F.col("_first") + F.pmod(F.xxhash64("seq"), F.col("_parts"))).cast("int")
    return stepped.join(F.broadcast(places), ["zone", "_step"]).withColumn("block", block).drop("zone", "_step", "_first", "_parts"), ranges


def _met(a: pd.DataFrame, b: pd.DataFrame, t: float, either: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``a`` and ``b`` (features) of the later and the earlier articles that can be similar; with ``either``
    also those of an earlier one in ``a`` and a later one in ``b``."""
    b = b.sort_values("lb")
    shape = lambda x: (x["seq"].to_numpy(), x["lt"].to_numpy(), x["lb"].to_numpy(), x["kind"].to_numpy(), np.frombuffer(b"".join(x["bits"]), dtype=np.uint64).reshape(len(x), 4))
    (sa, ta, la, ka, wa), (sb, tb, lb, kb, wb) = shape(a), shape(b)
    fa, fb = np.bitwise_xor.reduce(wa, axis=1), np.bitwise_xor.reduce(wb, axis=1)

    def counts(x: pd.DataFrame) -> np.ndarray:
        got = np.zeros((len(x), COUNTS + 2 * RARE if (x["kind"] > 0).any() else LETTERS), dtype=np.uint8)
        for i, c in enumerate(x["counts"]):
            c = zlib.decompress(c)
            got[i, : len(c)] = np.frombuffer(c, dtype=np.uint8)
        return got

    ca, cb = counts(a), counts(b)
    low = np.searchsorted(lb, la * (t / (2 - t)) - 1e-6, "left")
    high = np.searchsorted(lb, la * ((2 - t) / t) + 1e-6, "right")
    apart, slack = ((1 - t) * tb).astype(np.float32), 1e-4
    own_apart = ((1 - t) * ta + slack).astype(np.float32)
    for i in range(len(a)):
        own = slice(low[i], high[i])
        at = np.flatnonzero(np.bitwise_count(fb[own] ^ fa[i]) < apart[own] + own_apart[i]) + low[i]
        at = at if either else at[sb[at] < sa[i]]
        at = at[np.bitwise_count(wb[at] ^ wa[i]).sum(axis=1) < (1 - t) * (tb[at] + ta[i]) + slack]
        for k in range(0, len(at), 4096):
            part = at[k : k + 4096]
            limit = (1 - t) * (lb[part] + la[i]) + slack
            like = kb[part] == ka[i]
            keep = ~like | (ka[i] == 2)
            part_like = part[like]
            if ka[i] < 2 and len(part_like):
                limit = limit[like]
                if ka[i] == 1:
                    # the second text is the earlier one
                    begins, letters = (slice(COUNTS, COUNTS + RARE), slice(COUNTS + RARE, COUNTS + 2 * RARE))
                    begun = np.minimum(cb[part_like, begins], ca[i, letters]).sum(axis=1, dtype=np.int64)
                    if either:
                        begun = np.where(sb[part_like] < sa[i], begun, np.minimum(cb[part_like, letters], ca[i, begins]).sum(axis=1, dtype=np.int64))
                    limit = limit + 4 * (np.minimum(begun, limit) + 1)
                size = COUNTS if ka[i] else LETTERS
                x, y = cb[part_like, :size], ca[i, :size]
                keep[like] = (np.maximum(x, y) - np.minimum(x, y)).sum(axis=1, dtype=np.int64) < limit
            if keep.any():
                yield np.full(np.count_nonzero(keep), i), b.index.to_numpy()[part[keep]]


def bags_reach(texts: list[str], i: np.ndarray, j: np.ndarray, t: float) -> np.ndarray:
    """Whether ``bag_ratio`` of the texts at ``i`` and ``j`` is over ``t``; pairs of one ``i`` are best side by side."""
    bag, dense, reach = {}, np.zeros(0x110000, dtype=np.int32), np.zeros(len(i), dtype=bool)

    def of(k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in bag:
            kinds, n = np.unique(np.frombuffer(texts[k].encode("utf-32-le", "surrogatepass"), dtype=np.uint32), return_counts=True)
            bag[k] = kinds, n.astype(np.int32)
        return bag[k]

    starts = np.flatnonzero(np.diff(i, prepend=-1))
    for lo, hi in zip(starts, [*starts[1:], len(i)][: len(starts)], strict=True):
        kinds, n = of(i[lo])
        dense[kinds] = n
        for at in range(lo, hi, 1024):
            others = j[at : min(hi, at + 1024)]
            got = [of(k) for k in others]
            common = np.minimum(dense[np.concatenate([c for c, _ in got])], np.concatenate([m for _, m in got]))
            shared = np.bincount(np.repeat(np.arange(len(got)), [len(c) for c, _ in got]), common, len(got))
            size = np.array([len(texts[k]) for k in others]) + len(texts[i[lo]])
            reach[at : at + len(got)] = np.where(size > 0, 2 * shared / np.maximum(size, 1), 1.0) > t
        dense[kinds] = 0
    return reach


def ratios_reach(texts: list[str], i: np.ndarray, j: np.ndarray, t: float) -> np.ndarray:
    """Whether ``ratio`` of the texts at ``i`` and ``j`` is over ``t``.

    The blocks that ``SequenceMatcher`` finds are found in another order, the widest stretch first, and no more of them
    than it takes to tell: what is left open can add the shorter side of each stretch at most.
    """
    reach, last, matcher = np.zeros(len(i), dtype=bool), -1, SequenceMatcher(None)
    for k in np.argsort(j, kind="stable"):
        if j[k] != last:  # the second text is indexed once for all it is held against
            matcher.set_seq2(texts[j[k]])
            last = j[k]
        matcher.set_seq1(texts[i[k]])
        na, nb = len(texts[i[k]]), len(texts[last])
        size, matched, left = na + nb, 0, min(na, nb)
        stretches = [(-left, 0, na, 0, nb)] if left else []
        while stretches and 2.0 * (matched + left) / size > t >= 2.0 * matched / size:
            wide, alo, ahi, blo, bhi = heappop(stretches)
            x, y, n = matcher.find_longest_match(alo, ahi, blo, bhi)
            left += wide
            matched += n
            for rest in ((alo, x, blo, y), (x + n, ahi, y + n, bhi)) if n else ():
                if shorter := min(rest[1] - rest[0], rest[3] - rest[2]):
                    heappush(stretches, (-shorter, *rest))
                    left += shorter
        reach[k] = (2.0 * matched / size if size else 1.0) > t
    return reach


def texts_reach(title: list[str], body: list[str], i: np.ndarray, j: np.ndarray, t: float) -> np.ndarray:
    """Whether the titles and the bodies at ``i`` and ``j`` both have a ratio over ``t``; equal texts are held once."""
    left = np.arange(len(i))
    for texts, test in ((body, bags_reach), (title, bags_reach), (title, ratios_reach), (body, ratios_reach)):
        kinds: dict[str, int] = {}
        used, at = np.unique(np.concatenate([i[left], j[left]]), return_inverse=True)
        kind = np.array([kinds.setdefault(texts[k], len(kinds)) for k in used], dtype=np.int64)[at]
        pairs, back = np.unique(kind[: len(left)] * max(1, len(kinds)) + kind[len(left) :], return_inverse=True)
        left = left[test(list(kinds), pairs // max(1, len(kinds)), pairs % max(1, len(kinds)), t)[back]]
    return np.isin(np.arange(len(i)), left)


_packed = lambda x: zlib.compress(np.diff(x, prepend=0).astype(np.int64).tobytes(), 1)
_unpacked = lambda x: np.cumsum(np.frombuffer(zlib.decompress(x), dtype=np.int64))


def similar_pairs(later: DataFrame, earlier: DataFrame, t: float, texts: DataFrame | None = None) -> DataFrame:
    """(seq_a, seq_b) of a later and an earlier article whose titles and bodies both have a ratio above ``t``.

    Articles: seq, title, body; or seq and id, with ``texts`` (id, title, body), which then aren't moved to be numbered.

    No pair is lost: blocks of articles with bodies of similar lengths meet, and in arrays of their features those are
    left out that can't reach ``t``; the rest are held against the exact ratio. With n letters in both texts, fewer
    than (1 - t) n are in no common block, so counts of letters differ by less. Blocks are no more than those letters
    and one, nor than the letters a block begins at (``SequenceMatcher`` passes over the frequent ones of the second
    text) and the one at the start; each breaks two runs of three, so counts of these differ by less than
    (1 - t) n and four times the blocks. A text's bits and counts are fixed in size, whatever falls together
    there makes two texts more alike, never less. Two bodies of which one has less than t / 2 of its letters in ASCII and
    the other less than t / 2 of its letters not in ASCII have too few in common, so their blocks don't meet.

    Articles mostly in ASCII meet with their texts and are held where they meet. The letters of the others are in one
    place per pair of blocks, not once per pair, and only where they have met one.
    """
    same, numbers = later is earlier, None
    if texts is not None:
        sides = [x.select("id", "seq", F.lit(k).alias("side")) for k, x in enumerate([later] if same else [later, earlier])]
        numbers = sides[0].unionByName(sides[-1]) if not same else sides[0]
        featured = checkpointed(_featured(texts, t).join(numbers, "id").drop("id"))
        of = [featured.where(F.col("side") == k).drop("side") for k in range(1 if same else 2)]
    else:
        of = [checkpointed(_featured(x.withColumnRenamed("seq", "id"), t).withColumnRenamed("id", "seq")) for x in ([later] if same else [later, earlier])]
        texts = (later if same else later.select("seq", "title", "body").unionByName(earlier.select("seq", "title", "body"))).withColumnRenamed("seq", "id")
    (a, in_a), (b, in_b) = (_blocks(x) for x in (of[0], of[-1]))
    fits = lambda p, q: abs(p[0] - q[0]) < 2 and p[2] >= q[1] * (t / (2 - t)) - 1e-6 and p[1] <= q[2] * ((2 - t) / t) + 1e-6
    cells = [(i, j) for i, p in enumerate(in_a) for j, q in enumerate(in_b) if (not same or i <= j) and fits(p, q)]
    tasks = min(2_000, max(1, 4 * len(cells)))
    cells = later.sparkSession.createDataFrame([(c, i, j, same and i == j) for c, (i, j) in enumerate(cells)], "cell int, i int, j int, alone boolean")
    place = lambda rows, c, cells: rows.join(F.broadcast(cells.select("cell", "alone", F.col(c).alias("block"))), "block").drop("block")
    left, right = place(a, "i", cells), place(b, "j", cells.where("not alone"))  # a block that meets itself is there once
    right = right.toDF(*[f"b_{c}" for c in right.columns])

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        cell, alone = (int(x["cell"].iloc[0]), bool(x["alone"].iloc[0])) if len(x) else (0, False)
        x, title, body = _told(x.reset_index(drop=True))
        if alone:
            y, at = x, 0
        else:
            y, more, bodies = _told(y.rename(columns=lambda c: c[2:]).reset_index(drop=True))
            at, title, body = len(x), title + more, body + bodies
        got = [*_met(x, y, t, same and not alone)] if len(x) and len(y) else []
        i, j = (np.concatenate([np.zeros(0, dtype=np.int64), *[g[k] for g in got]]) for k in (0, 1))
        j = j + at
        seq, kind = (np.concatenate([x[c].to_numpy(), y[c].to_numpy()[: len(y) if at else 0]]) for c in ("seq", "kind"))
        turn = seq[i] < seq[j]
        i, j = np.where(turn, j, i), np.where(turn, i, j)
        here = (kind[i] > 0) & (kind[j] > 0)
        i, j, rest_i, rest_j = i[here], j[here], i[~here], j[~here]
        keep = texts_reach(title, body, i, j, t)
        told = [(cell, held, _packed(p), _packed(q)) for held, p, q in ((True, seq[i[keep]], seq[j[keep]]), (False, seq[rest_i], seq[rest_j])) if len(p)]
        return pd.DataFrame(told, columns=["cell", "held", "a", "b"])

    apart = lambda rows, c: rows.repartition(tasks, c).groupBy(c)  # noqa: E731  no two pairs of blocks in one task for being small
    met = checkpointed(apart(left, "cell").cogroup(apart(right, "b_cell")).applyInPandas(meet, "cell int, held boolean, a binary, b binary"))

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for p, q in zip(x["a"], x["b"], strict=True):
                yield pd.DataFrame({"seq_a": _unpacked(p), "seq_b": _unpacked(q)})

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for at, p, q in zip(x["cell"], x["a"], x["b"], strict=True):
                for side, seqs in enumerate((_unpacked(p), _unpacked(q))):
                    yield pd.DataFrame({"seq": np.unique(seqs)}).assign(at=at, side=0 if same else side)

    def hold(told: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        a, b = (np.concatenate([np.zeros(0, dtype=np.int64), *map(_unpacked, told[c])]) for c in ("a", "b"))
        seqs, first = np.unique(held["seq"].to_numpy(), return_index=True)
        title, body = ([x or "" for x in held[c].iloc[first]] for c in ("title", "body"))
        keep = texts_reach(title, body, np.searchsorted(seqs, a), np.searchsorted(seqs, b), t) if len(a) else np.zeros(0, dtype=bool)
        return pd.DataFrame({"seq_a": a[keep], "seq_b": b[keep]})

    rest = met.where("not held").drop("held")
    wanted = rest.mapInPandas(places, "seq bigint, at int, side int")
    wanted = wanted.join(numbers, ["seq", "side"]) if numbers else wanted.withColumn("id", F.col("seq"))
    wanted = wanted.groupBy("id").agg(F.collect_set(F.struct("at", "seq")).alias("_at"))
    letters = texts.select("id", "title", "body").join(wanted, "id").select("title", "body", F.explode("_at").alias("_at")).select("_at.at", "_at.seq", "title", "body")
    held = apart(rest, "cell").cogroup(apart(letters, "at")).applyInPandas(hold, "seq_a bigint, seq_b bigint")
    return met.where("held").mapInPandas(pairs, "seq_a bigint, seq_b bigint").unionByName(held)


def replay(rows: list[tuple[int, int]], similar: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """(seq, slot) of the survivors when (seq, priority) rows pass one by one, each compared with the survivors
    in slot order and put in the place of a similar one of worse priority."""
    kept: list[list[int]] = []
    for seq, prio in sorted(rows):
        for k in kept:
            if (max(seq, k[0]), min(seq, k[0])) in similar:
                if prio < k[1]:
                    k[0], k[1] = seq, prio
                break
        else:
            kept.append([seq, prio, seq])
    return [(k[0], k[2]) for k in kept]


def similarity_dedup(articles: DataFrame, t: float = 0.8, priorities: dict[str, int] | None = None, texts: DataFrame | None = None) -> DataFrame:
    """(seq, slot) of the articles that survive: greedy in order within each component of similar pairs.

    ``articles``: seq, title, body, source, or seq, id, source with ``texts`` (id, title, body). Articles without a
    similar one survive.
    """
    pairs = checkpointed(similar_pairs(articles, articles, t, texts))
    parts = components(pairs, "seq_a", "seq_b")
    prio = articles.select("seq", T.source_priority(F.col("source"), priorities).alias("prio"))
    left = pairs.join(parts.select(F.col("node").alias("seq_a"), "component"), "seq_a").join(prio.select(F.col("seq").alias("seq_a"), F.col("prio").alias("prio_a")), "seq_a")
    left = left.join(prio.select(F.col("seq").alias("seq_b"), F.col("prio").alias("prio_b")), "seq_b")

    def run(parts: pd.DataFrame) -> pd.DataFrame:
        got = []
        for _, part in parts.groupby("component"):
            rows = {*zip(part["seq_a"], part["prio_a"], strict=True), *zip(part["seq_b"], part["prio_b"], strict=True)}
            got += replay([(int(s), int(p)) for s, p in rows], {(int(a), int(b)) for a, b in zip(part["seq_a"], part["seq_b"], strict=True)})
        return pd.DataFrame(got, columns=["seq", "slot"])

    kept = left.groupBy(F.pmod(F.xxhash64("component"), F.lit(4096)).alias("_p")).applyInPandas(run, "seq bigint, slot bigint")
    alone = articles.select("seq").join(parts.select(F.col("node").alias("seq")), "seq", "left_anti")
    return kept.unionByName(alone.select("seq", F.col("seq").alias("slot")))


def visit_ref(player: Column, candidate: Column, name: Column) -> Column:
    """Reference of a person in a visit: player, else candidate, else the key of the name."""
    return F.coalesce(player, F.concat(F.lit("c:"), candidate), F.concat(F.lit("n:"), T.player_key(name)))


def comment_ref(player: Column, candidate: Column, team: Column) -> Column:
    """Whose comments a new one is compared with: the player's, else the candidate's, else those of the club."""
    return F.coalesce(player, F.concat(F.lit("c:"), candidate), F.concat(F.lit("t:"), team))


def named_ref(player: Column, candidate: Column, name: Column) -> Column:
    """Whose comments are repaired together: the player's, else the candidate's, else those of the name as typed."""
    return F.coalesce(player, F.concat(F.lit("c:"), candidate), F.concat(F.lit("n:"), name))


def against_stored(incoming: DataFrame, stored: DataFrame, t: float = 0.8, priorities: dict[str, int] | None = None, texts: DataFrame | None = None) -> DataFrame:
    """(seq, action, stored_seq) of each incoming article: 'new', 'update' of the first stored article it is similar to if
    its source has the better priority, else 'drop'.

    Both: seq, title, body, source, or seq, id, source with ``texts`` (id, title, body); the stored ones are numbered
    before the incoming ones, in their order.
    """
    first = similar_pairs(incoming, stored, t, texts).groupBy("seq_a").agg(F.min("seq_b").alias("stored_seq"))
    prio = lambda df, x: df.select(F.col("seq").alias(x), T.source_priority(F.col("source"), priorities).alias(f"{x}_prio"))
    told = prio(incoming, "seq").join(first.withColumnRenamed("seq_a", "seq"), "seq", "left").join(prio(stored, "stored_seq"), "stored_seq", "left")
    action = F.when(F.col("stored_seq").isNull(), "new").when(F.col("seq_prio") < F.col("stored_seq_prio"), "update").otherwise("drop")
    return told.select("seq", action.alias("action"), "stored_seq")


def absorbed_visits(visits: DataFrame) -> DataFrame:
    """Visits (id, ref, team, event_date, aggregator, created_at) one per ref, team and date; an undated one goes
    if its ref and team, which must be named, have a dated one."""
    order = F.struct(F.col("event_date").isNull(), F.col("aggregator"), F.col("created_at").isNull(), F.col("created_at"), F.col("id"))
    kept = first_by(visits, ["ref", "team", "event_date"], order)
    dated = kept.where("event_date is not null and team <> ''").select("ref", "team").distinct()
    return kept.where("event_date is not null").unionByName(kept.where("event_date is null").join(dated, ["ref", "team"], "left_anti").select(kept.columns))


def comment_survivors(comments: DataFrame, ref: Column, aggregator: Column) -> DataFrame:
    """Of comments of one person with one loose key: the one with a scout's name, from an original, the oldest."""
    keyed = comments.withColumns({"_ref": ref, "_loose": T.loose_comment_key(F.col("comment"))}).where("_loose <> ''")
    named = F.coalesce(T.strip(F.col("scout_name")), F.lit("")) == ""
    order = F.struct(named, aggregator, F.col("created_at").isNull(), F.col("created_at"), F.col("id"))
    return keyed.groupBy("_ref", "_loose").agg(F.min_by("id", order).alias("id"), F.count("*").alias("copies")).select("id", "copies")


def survivor_rows(df: DataFrame, keys: list[str], order: Column, fields: list[str]) -> DataFrame:
    """Row of each group that is first in ``order``, its null fields filled from the first row with a value."""
    own = F.struct(*[F.col(c) for c in df.columns])
    fill = [F.min_by(F.when(F.col(f).isNotNull(), F.col(f)), F.when(F.col(f).isNotNull(), order)).alias(f"_f_{f}") for f in fields]
    got = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(own, order).alias("_row"), F.count("*").alias("members"), *fill)
    return got.select(*[F.coalesce(F.col(f"_row.{c}"), F.col(f"_f_{c}")).alias(c) if c in fields else F.col(f"_row.{c}").alias(c) for c in df.columns], "members")


def merged_candidates(df: DataFrame) -> dict[str, DataFrame]:
    """Candidates of one name and school merged: ``kept`` rows with ``members``, ``moved`` ids (id, survivor, player_id).

    The row kept is the one with a player, of the best status, with most sources, the oldest; its empty fields are
    filled from the other rows in the order of their ids, and where it has no player the year is the latest of all.
    ``moved`` says for each other row where its children go and whose player they get, if the row kept has one.
    """
    fields = ("player_id", "name_kana", "category", "positions", "throws", "bats", "height_cm", "weight_kg", "birth_date", "fastball_max", "description", "team", "team_name", "draft_year", "school_year")
    some = lambda c: F.col(c).isNotNull() & ((F.size(c) > 0) if dict(df.dtypes)[c].startswith("array") else (F.col(c).cast("string") != ""))
    name, school = F.coalesce(T.player_key(F.col("name")), F.lit("")), F.coalesce(T.school_key(F.coalesce(F.nullif("team", F.lit("")), F.col("team_name"))), F.lit(""))
    status = F.coalesce(T.looked_up({"promoted": 3, "pending": 2, "rejected": 1}, F.col("status")), F.lit(0))
    order = F.struct((~some("player_id")).alias("a"), (-status).alias("b"), (-F.coalesce("source_count", F.lit(0))).alias("c"), F.col("created_at").alias("d"), F.col("id").alias("e"))
    keyed = df.withColumns({"_name": name, "_school": school})
    fill = [F.min_by(F.when(some(f), F.col(f)), F.when(some(f), F.col("id"))).alias(f"_f_{f}") for f in fields]
    groups = keyed.groupBy("_name", "_school").agg(F.min_by(F.struct(*df.columns), order).alias("_row"), F.count("*").alias("members"), F.max(F.nullif("draft_year", F.lit(0))).alias("_year"), *fill)
    own = lambda f: F.when((F.size(f"_row.{f}") > 0) if dict(df.dtypes)[f].startswith("array") else (F.col(f"_row.{f}").cast("string") != ""), F.col(f"_row.{f}"))
    filled = {f: F.coalesce(own(f), F.col(f"_f_{f}"), F.col(f"_row.{f}")) for f in fields}
    filled["draft_year"] = F.when(own("player_id").isNull(), F.coalesce("_year", filled["draft_year"])).otherwise(filled["draft_year"])
    kept = groups.select(*[filled[c].alias(c) if c in filled else F.col(f"_row.{c}").alias(c) for c in df.columns], "members")
    moved = keyed.select("id", "_name", "_school").join(groups.where("members > 1").select("_name", "_school", F.col("_row.id").alias("survivor"), own("player_id").alias("player_id")), ["_name", "_school"]).where("id <> survivor")
    return {"kept": kept, "moved": moved.select("id", "survivor", "player_id")}


def newest(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key; ``order`` must break ties."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")
