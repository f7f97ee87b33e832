"""Texts combined into containers of a fixed number of tokens.

Texts are measured once; one longer than a container is cut at container size. Pieces are spread over shards
by hash and packed best-fit, longest first, in each shard: bins are kept in order of what is left in them,
each with bitmaps of the duplicate clusters it holds and of the sources it holds often enough, and the search
for a piece goes on from the tightest bin to the next until one is compatible. Containers that stay open too
far are unpacked and packed again in fewer shards.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugoutline.session import checkpointed

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
_ENCODERS: dict[str, object] = {}


def vocabulary(name: str = VOCABULARY) -> str:
    """Place of a public rank file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str):
    """Tokenizer of a rank file, once per worker. Special tokens are ordinary text to it."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def count_tokens(path: str, text: str, step: int = 200_000) -> int:
    """Tokens of a text. A very long one is measured in steps that end where a word of the tokenizer's pattern does,
    over which no merge goes, so the count is that of the whole text."""
    own = encoder(path)
    if len(text) <= step:
        return len(own.encode_ordinary(text))
    import public_tokenizers

    total = at = 0
    for word in regex.finditer(public_tokenizers.PATTERN, text):
        if word.end() - at >= step or word.end() == len(text):
            total += len(own.encode_ordinary(text[at : word.end()]))
            at = word.end()
    return total


def measured(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, source, digest, copy, tokens) of each row; texts that are null or empty have no tokens and are left out."""
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "digest": b["digest"], "row": b["row"], "tokens": [count_tokens(path, t) for t in b["text"]]})

    rows = documents.where("length(text) > 0").select("doc_id", "source", F.xxhash64(F.lower(F.regexp_replace("text", r"\s+", ""))).alias("digest"), F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInPandas(run, f"doc_id {kind}, source string, digest bigint, row bigint, tokens bigint")


class Bins:
    """Open bins by what is left in them, with bitmaps of their clusters and full sources."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []  # (left, bin)
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []
        self.left: list[int] = []

    def put(self, size: int, cluster: int, source: int) -> int:
        """Bin of a piece: the tightest that holds no copy of it and not too much of its source."""
        k = bisect_left(self.order, (size, -1))
        while k < len(self.order):
            left, b = self.order[k]
            if not (self.clusters[b] & cluster) and not (self.sources[b][-1] & source):
                del self.order[k]
                break
            k += 1
        else:
            b, left = len(self.left), self.capacity
            self.clusters.append(0)
            self.sources.append([0] * self.per_source)
            self.left.append(left)
        self.clusters[b] |= cluster
        levels = self.sources[b]
        for level in range(self.per_source):
            if not levels[level] & source:
                levels[level] |= source
                break
        self.left[b] = left - size
        if left > size:
            insort(self.order, (left - size, b))
        return b


def pack_rows(rows: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """``rows`` (tokens, digest, source) with ``bin``, packed longest first."""
    rows = rows.sort_values(["tokens", "row", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    # a full piece has a container to itself, so what may lie beside a copy is whole texts and tails
    copies = rows["digest"].map(rows.loc[rows["tokens"] < capacity, "digest"].value_counts())
    bit = {d: 1 << i for i, d in enumerate(rows["digest"][copies > 1].unique())}
    names = {s: 1 << i for i, s in enumerate(rows["source"].dropna().unique())}
    bins = Bins(capacity, per_source)
    rows["bin"] = [bins.put(int(n), bit.get(d, 0), names.get(s, 0)) for n, d, s in zip(rows["tokens"], rows["digest"], rows["source"], strict=True)]
    return rows


def containers(documents: DataFrame, path: str, capacity: int = 4096, per_source: int = 12, shard_bins: int = 1000, full: float = 0.99) -> DataFrame:
    """(container_id, doc_id, piece, first_token, tokens): every text in containers of ``capacity`` tokens.

    Only a text longer than a container is cut. No container holds two copies of a text, nor more than
    ``per_source`` pieces of one source (null sources aside). Repeated rows are packed each. A container's
    tokens never exceed its capacity; an empty table gives no row. ``path`` names the tokenizer's rank file.
    """
    sizes = checkpointed(measured(documents, path))
    whole = F.col("tokens") > capacity
    cut = F.transform(F.sequence(F.lit(0), ((F.col("tokens") - 1) / capacity).cast("int")), lambda i: F.struct(i.alias("piece"), (i * capacity).cast("bigint").alias("first_token"), F.least(F.lit(capacity).cast("bigint"), F.col("tokens") - i * capacity).alias("size")))
    pieces = sizes.where("tokens > 0").select("doc_id", "source", "digest", "row", F.explode(F.when(whole, cut).otherwise(F.array(F.struct(F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("first_token"), F.col("tokens").alias("size"))))).alias("p"))
    pieces = pieces.select("doc_id", "source", "digest", "row", "p.piece", "p.first_token", F.col("p.size").alias("tokens"))
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    fields = f"doc_id {dict(documents.dtypes)['doc_id']}, source string, digest bigint, row bigint, piece int, first_token bigint, tokens bigint"
    out = f"{fields}, shard bigint, bin bigint"

    def pack(shards: int, salt: int):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            return pack_rows(rows, capacity, per_source).assign(shard=int(key[0]))[["doc_id", "source", "digest", "row", "piece", "first_token", "tokens", "shard", "bin"]]

        def of(df: DataFrame) -> DataFrame:
            return df.withColumn("_shard", F.pmod(F.xxhash64("row", "piece", F.lit(salt)), F.lit(shards))).groupBy("_shard").applyInPandas(run, out)

        return of

    shards = max(1, -(-total // (capacity * shard_bins)))
    first = checkpointed(pack(shards, 1)(pieces))
    filled = first.groupBy("shard", "bin").agg(F.sum("tokens").alias("_used"))
    opened = filled.where(F.col("_used") < full * capacity).select("shard", "bin")
    done = first.join(opened, ["shard", "bin"], "left_anti").withColumn("level", F.lit(0))
    again = first.join(opened, ["shard", "bin"], "left_semi").drop("shard", "bin")
    second = pack(max(1, -(-shards // 4)), 2)(again).withColumn("level", F.lit(1))
    return done.unionByName(second).select(F.concat_ws("-", "level", "shard", "bin").alias("container_id"), "doc_id", "piece", "first_token", "tokens")
