"""Evaluation passages that occur in training text.

The test items form a BM25 inverted index over character six-grams of letters and digits. Every training
passage is a query: block-max upper bounds drop the passages and blocks of items that can't reach the
threshold, the rest are scored exactly (WAND, vectorised over a batch), and each document and item above it
is verified sentence by sentence. The index of a block of items is broadcast; its size is bounded by
``block_chars``, and larger item sets are searched block by block.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugoutline.session import checkpointed

GRAM = 6
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 21
_ENDS = re.compile(r"[。！？!?]|\.(?=\s|$)|\n")
_LETTERS: np.ndarray | None = None


def letters_table() -> np.ndarray:
    """Whether each code point is a letter or digit."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalnum() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTERS


def folded(text: str) -> str:
    return (text if text.isascii() else unicodedata.normalize("NFKC", text)).lower()


def codes(text: str) -> np.ndarray:
    """Code points of the letters and digits of ``text``, width and case folded."""
    a = np.frombuffer(folded(text).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return a[letters_table()[a]]


def gram_hashes(a: np.ndarray) -> np.ndarray:
    n = max(0, len(a) - GRAM + 1)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(GRAM):
        h *= _BASE
        h += a[i : i + n].astype(np.uint64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Index:
    """Inverted index of test items: BM25 weights per term and item, and their maxima per block of items.

    ``every`` tells of all items, where these are some of them: their number, their mean number of terms, and in how many
    of them each term of these is; so weights don't depend on how the items are cut into blocks.
    """

    def __init__(self, items: list[tuple[int, str]], share: float, every: tuple[int, float, dict[int, int]] | None = None, k1: float = 1.2, b: float = 0.75, block: int = 32):
        self.ids = [i for i, _ in items]
        self.share, self.block = share, block
        sentences, hashes, owners, places = [], [], [], []
        for k, (_, text) in enumerate(items):
            at, own = 0, []
            for part in self._units(text):
                h = gram_hashes(part)
                own.append((at, len(h), len(part)))
                hashes.append(h)
                owners.append(np.full(len(h), k))
                places.append(np.arange(at, at + len(h)))
                at += len(part)
            sentences.append(own)
        self.sentences = sentences
        h = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        owner = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
        place = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
        order = np.lexsort((place, owner, h))
        h, owner, place = h[order], owner[order], place[order]
        self.terms, start = np.unique(h, return_index=True)
        # occurrences of a term: places[at[t]:at[t+1]] in items owner[...]
        self.occ_at, self.occ_item, self.occ_place = np.append(start, len(h)), owner, place
        term = np.repeat(np.arange(len(self.terms)), np.diff(self.occ_at))
        pairs, tf = np.unique(term * max(1, len(items)) + owner, return_counts=True)
        t, i = pairs // max(1, len(items)), pairs % max(1, len(items))
        length = np.bincount(owner, minlength=len(items)).astype(float)
        number, mean = (len(items), length.mean() if len(length) else 1.0) if every is None else every[:2]
        df = np.bincount(t, minlength=len(self.terms)) if every is None else np.array([every[2][x] for x in self.terms.astype(np.int64).tolist()], dtype=np.int64)
        idf = np.log1p((number - df + 0.5) / (df + 0.5))
        w = idf[t] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length[i] / max(1.0, mean)))
        self.post_at, self.post_item, self.post_w = np.append(np.searchsorted(t, np.arange(len(self.terms))), len(t)), i, w
        blocks, first = np.unique(t * (len(items) // block + 1) + i // block, return_index=True)
        self.block_at = np.append(np.searchsorted(blocks // (len(items) // block + 1), np.arange(len(self.terms))), len(blocks))
        self.block_id, self.block_max = blocks % (len(items) // block + 1), np.maximum.reduceat(w, first) if len(first) else w
        self.term_max = np.maximum.reduceat(w, self.post_at[:-1]) if len(t) else w
        self.bloom = np.zeros(1 << _BITS, dtype=bool)
        self.bloom[self.terms >> np.uint64(64 - _BITS)] = True
        # least score of a passage with a carried sentence: the share of the weakest sentence
        weight = dict(zip(pairs.tolist(), w.tolist(), strict=True))
        of = dict(zip(self.terms.tolist(), range(len(self.terms)), strict=True))
        self.least = np.full(len(items), np.inf)
        for k, (_, text) in enumerate(items):
            for part in self._units(text):
                own = sorted(weight[of[x] * max(1, len(items)) + k] for x in set(gram_hashes(part).tolist()))
                if own:
                    # edits may spare the lightest terms only
                    self.least[k] = min(self.least[k], sum(own[: int(len(own) * share)]))

    @staticmethod
    def _units(text: str) -> list[np.ndarray]:
        """Sentences of an item; short ones join the next, long ones are cut."""
        units, open_ = [], np.zeros(0, dtype=np.uint32)
        for s in _ENDS.split(text):
            open_ = np.concatenate([open_, codes(s)])
            while len(open_) > 400:
                units.append(open_[:200])
                open_ = open_[200:]
            if len(open_) >= 24:
                units.append(open_)
                open_ = open_[:0]
        if len(open_):
            if units:
                units[-1] = np.concatenate([units[-1], open_])
            else:
                units.append(open_)
        return units


def _expand(at: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each term its run at[t]:at[t+1]: (index of the term in ``terms``, position in the run)."""
    n = at[terms + 1] - at[terms]
    which = np.repeat(np.arange(len(terms)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[terms], n)


def _carried(index: Index, item: int, p: np.ndarray, q: np.ndarray) -> float:
    """Share of an item's letters in sentences of which ``share`` lies close together in the document."""
    got = total = 0.0
    for start, n, letters in index.sentences[item]:
        total += letters
        inside = (q >= start) & (q < start + n)
        if n == 0 or np.count_nonzero(inside) < index.share * n:
            continue
        at, place = p[inside], q[inside]
        order = np.argsort(at, kind="stable")
        at, place = at[order], place[order]
        ends = np.searchsorted(at, at + int(letters * 1.35) + 1)
        sizes, best = ends - np.arange(len(at)), 0
        for k in np.argsort(-sizes, kind="stable"):
            if sizes[k] <= best:
                break
            best = max(best, len(np.unique(place[k : ends[k]])))
        if best >= index.share * n:
            got += letters * best / n
    return got / total if total else 0.0


def search(index: Index, ids: list, texts: list[str | None], coverage: float, passage: int, batch_chars: int = 2_000_000) -> list[tuple]:
    """(id, item, coverage) of all texts that carry an item."""
    found, k = [], 0
    while k < len(texts):
        part, size, first = [], 0, k
        while k < len(texts) and (not part or size + len(texts[k] or "") <= batch_chars):
            part.append(codes(texts[k]) if texts[k] else np.zeros(0, dtype=np.uint32))
            size += len(texts[k] or "")
            k += 1
        lengths = np.array([len(x) for x in part])
        starts = np.cumsum(lengths) - lengths
        a = np.concatenate(part)
        h = gram_hashes(a)
        at = np.flatnonzero(index.bloom[h >> np.uint64(64 - _BITS)])
        if not len(at):
            continue
        term = np.minimum(np.searchsorted(index.terms, h[at]), len(index.terms) - 1)
        doc = np.searchsorted(starts, at, side="right") - 1
        real = (index.terms[term] == h[at]) & (at + GRAM <= starts[doc] + lengths[doc])
        at, term, doc = at[real], term[real], doc[real]
        if not len(at):
            continue
        # passages of two halves; a hit counts in the passage that starts at its half and in the one before
        half = (at - starts[doc]) // (passage // 2)
        wide = int(half.max()) + 2
        cell = np.concatenate([doc * wide + half + 1, doc * wide + half])
        t2 = np.concatenate([term, term])
        once = np.unique(cell * np.int64(len(index.terms)) + t2)
        cell, t2 = once // len(index.terms), once % len(index.terms)
        cells, inverse = np.unique(cell, return_inverse=True)
        least = index.least.min()
        hopeful = (np.bincount(inverse, weights=index.term_max[t2]) >= least)[inverse]
        cell, t2 = cell[hopeful], t2[hopeful]
        if not len(cell):
            continue
        which, j = _expand(index.block_at, t2)
        nb = len(index.ids) // index.block + 1
        key, inverse = np.unique(cell[which] * nb + index.block_id[j], return_inverse=True)
        open_blocks = key[np.bincount(inverse, weights=index.block_max[j]) >= least]
        which, j = _expand(index.post_at, t2)
        blocks = cell[which] * nb + index.post_item[j] // index.block
        keep = np.isin(blocks, open_blocks)
        which, j = which[keep], j[keep]
        key, inverse = np.unique(cell[which] * len(index.ids) + index.post_item[j], return_inverse=True)
        score = np.bincount(inverse, weights=index.post_w[j])
        good = score >= index.least[key % len(index.ids)] - 1e-9
        pairs = np.unique((key[good] // len(index.ids) // wide) * len(index.ids) + key[good] % len(index.ids))
        if not len(pairs):
            continue
        wanted = np.zeros(len(part), dtype=bool)
        wanted[pairs // len(index.ids)] = True
        mine = wanted[doc]
        p0, t0, d0 = at[mine], term[mine], doc[mine]
        which, j = _expand(index.occ_at, t0)
        own = d0[which] * len(index.ids) + index.occ_item[j]
        keep = np.isin(own, pairs)
        own, p, q = own[keep], p0[which[keep]], index.occ_place[j[keep]]
        order = np.argsort(own, kind="stable")
        own, p, q = own[order], p[order], q[order]
        for x, lo, hi in zip(pairs, np.searchsorted(own, pairs), np.searchsorted(own, pairs, side="right"), strict=True):
            d, i = int(x) // len(index.ids), int(x) % len(index.ids)
            if (share := _carried(index, i, p[lo:hi], q[lo:hi])) >= coverage:
                found.append((ids[first + d], index.ids[i], share))
    return found


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, passage, term, tf): terms of each item and passage (as a digest)."""
    kind = dict(items.dtypes)["item_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, digest, text in zip(b["item_id"], b["digest"], b["passage"], strict=True):
                term, tf = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *map(gram_hashes, Index._units(text))]), return_counts=True)
                yield pd.DataFrame({"item_id": i, "passage": digest, "term": term.astype(np.int64), "tf": tf})

    return items.select("item_id", F.xxhash64("passage").alias("digest"), "passage").mapInPandas(run, f"item_id {kind}, passage bigint, term bigint, tf bigint")


def leaked_items(documents: DataFrame, items: DataFrame, coverage: float = 0.42, share: float = 0.45, passage: int = 1024, block_chars: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, coverage): documents that carry about half or more of an item.

    A sentence is carried if ``share`` of its six-grams lie close together; an item, if carried sentences make
    up ``coverage`` of its letters. Null and blank texts, and items without a sentence of six letters, match
    nothing; repeated rows give one row each pair. ``passage`` is twice the longest unit of an item or more.
    Other columns are not read.
    """
    spark = documents.sparkSession
    items = items.select("item_id", "passage").where("passage is not null").distinct()
    total = items.agg(F.sum(F.length("passage"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    texts = documents.select("doc_id", "text").where("text is not null and length(text) >= 6")
    kinds = dict(documents.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    found = spark.createDataFrame([], f"doc_id {kinds[0]}, item_id {kinds[1]}, coverage double")
    in_block = lambda df, k: df.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
    terms = checkpointed(item_terms(items)) if blocks > 1 else None
    if terms is not None:
        counted = checkpointed(terms.groupBy("term").agg(F.countDistinct("item_id", "passage").cast("int").alias("df")))
        number, size = items.agg(F.count("*")).first()[0], terms.agg(F.sum("tf")).first()[0] or 0
    for k in range(blocks):
        own = [(r[0], r[1]) for r in in_block(items, k).orderBy("item_id").collect()]
        every = None
        if terms is not None:
            # as many as a block has terms
            here = counted.join(in_block(terms, k).select("term").distinct(), "term").toPandas()
            every = number, size / max(1, number), dict(zip(here["term"].tolist(), here["df"].tolist(), strict=True))
        shared = spark.sparkContext.broadcast(Index(own, share, every))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = shared.value
            for b in batches:
                if len(index.terms):
                    yield pd.DataFrame(search(index, list(b["doc_id"]), list(b["text"]), coverage, passage), columns=["doc_id", "item_id", "coverage"])

        found = found.unionByName(texts.mapInPandas(run, found.schema)) if k else texts.mapInPandas(run, found.schema)
    return found.groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"))
