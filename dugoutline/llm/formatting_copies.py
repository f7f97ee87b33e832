"""Records equal but for formatting, collapsed and counted.

Canonical bytes are partitioned by radix: buckets of a prefix that are too large are split by further
bytes, level by level, until each fits a task; in each bucket a path-compressed trie counts the copies
in its terminal nodes. Exact copies are collapsed by the same tries before the shuffle, so a hot record
crosses it at most once per input partition and flush.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugoutline.session import checkpointed, shuffled

#: Signs that rate (B+, B-) stay; a point inside a number stays; all other signs and space go.
_SIGN_KEPT = r"(?<=[\p{L}\p{N}])[+\-](?![\p{L}\p{N}])"
_ENTRY_ENDS = r"[、,;/|。，；／｜\n]+|(?<![0-9])\.|\.(?![0-9])"
_ENTRY = r"^\s*[^\s:=：＝・、]{1,20}?\s*[:=：＝・\s]\s*[\p{L}\p{N}]{1,12}[+\-]?\s*$"
_QUOTES = "[「」『』【】\"'“”‘’<>()\\[\\]]"


def _squeezed(text: Column) -> Column:
    marked = F.regexp_replace(F.regexp_replace(text, _SIGN_KEPT, "\u0001$0"), r"(?<=[0-9])\.(?=[0-9])", "\u0002")
    bare = F.regexp_replace(marked, "(?<!\u0001)[^\\p{L}\\p{N}\\p{M}%\u0001\u0002]", "")
    return F.translate(bare, "\u0002\u0001", ".")


def with_canonical(df: DataFrame, comment: str = "comment", out: str = "canonical") -> DataFrame:
    """``df`` with the canonical comment: lower case letters, digits and rating signs; the entries of a rating list
    in sorted order. Null stays null; a text without letters or digits gives an empty string.

    The steps are columns of their own, so that each is computed once.
    """
    low, entries, is_list = F.col("_low"), F.col("_entries"), F.col("_is_list")
    tidy = F.transform(entries, lambda e: F.concat_ws("=", *[_squeezed(F.regexp_extract(e, r"^\s*([^\s:=：＝・、]{1,20}?)\s*[:=：＝・\s]\s*(\S+)\s*$", k)) for k in (1, 2)]))
    steps = df.withColumn("_low", F.lower(comment)).withColumn("_entries", F.filter(F.split(F.regexp_replace(low, _QUOTES, ""), _ENTRY_ENDS), lambda e: F.trim(e) != ""))
    steps = steps.withColumn("_is_list", (F.size(entries) >= 2) & F.forall(entries, lambda e: e.rlike(_ENTRY)))
    text = F.when(is_list, F.concat(F.lit("\u0003"), F.array_join(F.array_sort(tidy), ";"))).otherwise(_squeezed(low))
    return steps.withColumn(out, text).drop("_low", "_entries", "_is_list")


class Trie:
    """Path-compressed trie over bytes; terminal nodes hold (count, least id)."""

    __slots__ = ("root", "terminals")

    def __init__(self) -> None:
        self.root: dict = {}
        self.terminals = 0

    def add(self, key: bytes, count: int, first: str) -> None:
        children, at = self.root, 0
        while True:
            head = key[at : at + 1]
            node = children.get(head)
            if node is None:
                children[head] = [key[at:], {}, count, first]
                self.terminals += 1
                return
            label = node[0]
            if key.startswith(label, at):
                at += len(label)
                if at == len(key):
                    self.terminals += node[2] == 0
                    node[2] += count
                    node[3] = first if node[3] is None or first < node[3] else node[3]
                    return
                children = node[1]
                continue
            rest = key[at:]
            n = next((i for i, (a, b) in enumerate(zip(label, rest, strict=False)) if a != b), min(len(label), len(rest)))
            children[head] = [label[:n], {label[n : n + 1]: [label[n:], node[1], node[2], node[3]]}, 0, None]
            children, at = children[head][1], at + n
            if at == len(key):
                children = None
                node = self._find(key)
                node[2], node[3] = count, first
                self.terminals += 1
                return

    def _find(self, key: bytes) -> list:
        children, at = self.root, 0
        while True:
            node = children[key[at : at + 1]]
            at += len(node[0])
            if at == len(key):
                return node
            children = node[1]

    def items(self) -> Iterator[tuple[bytes, int, str]]:
        stack = [(b"", self.root)]
        while stack:
            prefix, children = stack.pop()
            for label, below, count, first in children.values():
                if count:
                    yield prefix + label, count, first
                if below:
                    stack.append((prefix + label, below))


def _emit(*tries: Trie) -> pd.DataFrame:
    rows = [r for t in tries for r in t.items()]
    # plain objects: Arrow-backed strings may come in several pieces, which the writer doesn't take
    return pd.DataFrame({c: pd.Series([r[i] for r in rows], dtype=object) for i, c in enumerate(("key", "n", "first_id"))})


def _combine(flush: int):
    """Counts a partition's keys; empties the trie whenever it holds ``flush`` keys."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = Trie()
        for b in batches:
            for key, n, first in zip(b["key"], b["n"], b["first_id"], strict=True):
                trie.add(bytes(key), int(n), first)
                if trie.terminals >= flush:
                    yield _emit(trie)
                    trie = Trie()
        yield _emit(trie)

    return run


def _count_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One trie per bucket; rows come sorted by bucket, so only the tries of a batch's buckets are held."""
    trie, now = Trie(), None
    for b in batches:
        done = []
        for bucket, key, n, first in zip(b["bucket"], b["key"], b["n"], b["first_id"], strict=True):
            if bucket != now:
                done.append(trie)
                trie, now = Trie(), bucket
            trie.add(bytes(key), int(n), first)
        yield _emit(*done)
    yield _emit(trie)


#: Prefixes to split that are broadcast at most; more are joined by sorting.
SPLIT_AT_ONCE = 100_000


def radix_buckets(keys: DataFrame, fits: int, step: int = 2) -> DataFrame:
    """``keys`` (binary column ``key``) with ``bucket``: a prefix whose rows fit.

    Each level splits the buckets still too large by further bytes, twice as many as the level before, so keys that
    are alike for long take few levels. A bucket whose keys all end in its prefix can't be split and is final:
    copies were collapsed before, so what is left of one key is at most a row for each partial trie.
    """
    depth, out = step, keys.withColumn("bucket", F.expr(f"substring(key, 1, {step})"))
    while True:
        level = out.where(F.length("bucket") == depth).groupBy("bucket").agg(F.count("*").alias("_n"), F.max(F.length("key")).alias("_l"))
        large = checkpointed(level.where((F.col("_n") > fits) & (F.col("_l") > depth)).select("bucket", F.lit(True).alias("_large")))
        n = large.count()
        if not n:
            return out
        depth += step
        step *= 2
        split = F.broadcast(large) if n <= SPLIT_AT_ONCE else shuffled(large)
        out = out.join(split, "bucket", "left").withColumn("bucket", F.when(F.col("_large"), F.expr(f"substring(key, 1, {depth})")).otherwise(F.col("bucket"))).drop("_large")


def collapse(keys: DataFrame, fits: int = 200_000, flush: int = 50_000) -> DataFrame:
    """One row per distinct key of ``keys`` (id string, key binary): (key, copies, first_id).

    Rows with a null or empty key are left out. ``fits`` bounds a bucket's rows, ``flush`` the keys held while
    collapsing a partition. Repeated rows count as copies; an empty table gives no row.
    """
    schema = "key binary, n bigint, first_id string"
    rows = keys.where("key is not null and id is not null and length(key) > 0").select("key", F.lit(1).cast("bigint").alias("n"), F.col("id").alias("first_id"))
    partial = checkpointed(rows.mapInPandas(_combine(flush), schema))
    bucketed = radix_buckets(partial, fits)
    counted = bucketed.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_count_buckets, schema)
    return counted.withColumnRenamed("n", "copies")


def player_of() -> Column:
    """Reference of a comment's player; the kind of reference is part of it."""
    some = lambda c: F.when(F.trim(c) != "", F.col(c))
    return F.coalesce(F.concat(F.lit("p:"), some("player_id")), F.concat(F.lit("c:"), some("player_candidate_id")), F.concat(F.lit("n:"), some("player_name")))


def comment_keys(comments: DataFrame) -> DataFrame:
    """(id, key): player and canonical comment as bytes; rows without a player, or without letters in the comment,
    are left out."""
    own = comments.select(F.col("id").cast("string").alias("id"), player_of().alias("player"), "comment").where("player is not null and comment is not null")
    text = with_canonical(own).where("canonical <> ''")
    return checkpointed(text.select("id", F.encode(F.concat_ws("\u0000", "player", "canonical"), "UTF-8").alias("key")))


def distinct_comments(comments: DataFrame, **limits: int) -> DataFrame:
    """One record per evaluation of a player: (first_id, copies)."""
    return collapse(comment_keys(comments), **limits).select("first_id", "copies")


def formatting_pairs(comments: DataFrame, **limits: int) -> DataFrame:
    """Every pair (id_a < id_b) of one player's comments that differ in formatting only, exact copies included.

    The records that have copies come from ``collapse``; their rows are found again by digest.
    """
    keys = comment_keys(comments)
    classes = collapse(keys, **limits).where("copies > 1").select(F.sha2("key", 256).alias("digest"))
    members = keys.select("id", F.sha2("key", 256).alias("digest")).join(classes, "digest", "left_semi")
    a, b = members.withColumnRenamed("id", "id_a"), members.withColumnRenamed("id", "id_b")
    return a.join(b, "digest").where("id_a < id_b").select("id_a", "id_b").distinct()
