"""Per-document text statistics and the kind of text they tell.

Documents are cut into chunks; each chunk gives counts that add up and the state of its open first and last
line. Chunks are merged in two levels (runs of chunks, then documents), lines cut by a chunk edge being put
together from their states; ratios, rules and the trained score follow from the merged counts. Counting is
vectorised over a batch of chunks. A chunk comes with some context on either side, so that words and runs
at its edges are seen whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugoutline.session import checkpointed

CONTEXT = 64
#: Texts are compressed in blocks of so many characters, counted from their start, wherever chunks are cut.
BLOCK = 100_000
# Common English words of at most six letters; Japanese particles; signs.
COMMON = "the a an of to in and for that on with at from by as was is it his her he she they but who has had after when which this than be not or its their one said before were are have them him you we i if so no up out into about".split()
PARTICLES = "はがをにでとへもや"
LAST = "ただるいすくうむぶつぬ"
BULLETS = "-*・◆●■#+•○◎▶▪>※"
ENDS = "。．.!?！？」』)）”\""
COUNTS = ("chars", "seen", "japanese", "hiragana", "katakana", "particles", "latin", "digits", "odd", "tabs", "pipes", "signs", "stops", "commas", "ends", "words", "letters_in_words", "common", "long_run", "squeezed", "lines", "bullet_lines", "number_lines", "end_lines", "verb_lines", "end_chars", "verb_chars")
_LINE = ("lines", "bullet_lines", "number_lines", "end_lines", "verb_lines", "end_chars", "verb_chars")

_T: np.ndarray | None = None
J, H, K, P, A, D, O, S, N, B, E, V = (1 << i for i in range(12))


def classes() -> np.ndarray:
    """Class bits of each code point."""
    global _T
    if _T is None:
        t = np.zeros(0x110000, dtype=np.uint16)
        t[:] = O
        for lo, hi, bits in ((0x3041, 0x3096, J | H), (0x30A1, 0x30FF, J | K), (0x3400, 0x4DBF, J), (0x4E00, 0x9FFF, J), (0x3005, 0x3007, J), (0x41, 0x5A, A), (0x61, 0x7A, A), (0xFF21, 0xFF3A, A), (0xFF41, 0xFF5A, A), (0x30, 0x39, D), (0xFF10, 0xFF19, D)):
            t[lo : hi + 1] = bits
        for c in "、。「」『』・（）,.'\"!?…:;-()%！？％：；’‘“”—–〜~&/":
            t[ord(c)] &= ~np.uint16(O)
        for c in "\t\r\n 　 \x0b\x0c  ":
            t[ord(c)] = S
        t[ord("\n")] |= N
        for c, bit in ((PARTICLES, P), (BULLETS, B), (ENDS, E), (LAST, V)):
            for x in c:
                t[ord(x)] |= bit
        _T = t
    return _T


def _word_codes(lower: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    code = length.astype(np.int64)
    for i in range(6):
        here = np.minimum(start + i, len(lower) - 1)
        code = code * 32 + np.where(i < length, lower[here].astype(np.int64) & 31, 0)
    return code


_COMMON = np.sort(np.array([_word_codes(np.frombuffer(w.encode("utf-32-le"), dtype=np.uint32), np.array([0]), np.array([len(w)]))[0] for w in COMMON if len(w) <= 6]))


def squeezed_size(text: str, at: int, end: int) -> int:
    """Compressed bytes of the blocks of ``text`` that begin in [at, end)."""
    return sum(len(zlib.compress(text[b : b + BLOCK].encode("utf-8", "surrogatepass"), 1)) for b in range(-(-at // BLOCK) * BLOCK, end, BLOCK))


def chunk_counts(before: list[str], cores: list[str], after: list[str]) -> pd.DataFrame:
    """Counts of each chunk and the states of its open lines; ``squeezed`` is counted on the whole text."""
    k = len(cores)
    nb, nc, na = (np.array([len(x) for x in part], dtype=np.int64) for part in (before, cores, after))
    whole = "\u0000".join(x for three in zip(before, cores, after, strict=True) for x in ("".join(three),)) + "\u0000"
    a = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    t = classes()[a]
    size = nb + nc + na + 1
    first = np.cumsum(size) - size
    lo, hi = first + nb, first + nb + nc
    core = np.zeros(len(a) + 1, dtype=np.int8)
    np.add.at(core, lo, 1)
    np.add.at(core, hi, -1)
    core = np.cumsum(core[:-1]).astype(bool)

    def total(flags: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(flags & core, dtype=np.int64)])
        return c[hi] - c[lo]

    chunk_of = lambda at: np.searchsorted(first, at, side="right") - 1
    out = {"chars": nc, "seen": total((t & S) == 0)}
    for name, bit in (("japanese", J), ("hiragana", H), ("katakana", K), ("particles", P), ("latin", A), ("digits", D), ("odd", O)):
        out[name] = total((t & bit) != 0)
    is_ = lambda text: np.isin(a, np.array([ord(c) for c in text], dtype=np.uint32))
    out |= {"tabs": total(a == 9), "pipes": total(is_("|｜")), "signs": total(is_("<>={}[]_\\^`$@+")), "stops": total(is_("。．！？")), "commas": total(is_("、，"))}
    space_next = np.append((t[1:] & S) != 0, True) | np.append(a[1:] == 0, True)
    out["ends"] = total(is_(".!?,") & space_next)
    letter = (t & A) != 0
    run = letter | ((t & D) != 0) | is_("+/=_")
    change = np.diff(np.concatenate([[0], letter.astype(np.int8), [0]]))
    w0, w1 = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    mine = core[w0] if len(w0) else np.zeros(0, dtype=bool)
    w0, w1 = w0[mine], w1[mine]
    lower = a | np.uint32(32)
    code = _word_codes(lower, w0, np.minimum(w1 - w0, 31))
    known = _COMMON[np.minimum(np.searchsorted(_COMMON, code), len(_COMMON) - 1)] == code
    at = chunk_of(w0)
    out["words"] = np.bincount(at, minlength=k)
    out["letters_in_words"] = out["latin"]
    out["common"] = np.bincount(at, weights=known & (w1 - w0 <= 6), minlength=k).astype(np.int64)
    change = np.diff(np.concatenate([[0], run.astype(np.int8), [0]]))
    r0, r1 = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    long_ = r1 - r0 >= 28
    flag = np.zeros(len(a) + 1, dtype=np.int8)
    flag[r0[long_]] = 1
    flag[r1[long_]] -= 1
    out["long_run"] = total(np.cumsum(flag[:-1]).astype(bool))
    # lines: a new one after each newline and at each chunk
    seen = np.flatnonzero(((t & S) == 0) & core)
    brk = np.concatenate([[0], np.cumsum(((t & N) != 0) & core)])
    line = brk[seen] + chunk_of(seen)
    starts = np.flatnonzero(np.diff(line, prepend=-1)) if len(line) else np.zeros(0, dtype=np.int64)
    stops = np.append(starts[1:], len(line)) if len(line) else starts
    length = stops - starts
    head, tail = t[seen[starts]] if len(starts) else np.zeros(0, np.uint16), t[seen[stops - 1]] if len(stops) else np.zeros(0, np.uint16)
    key = line[starts] if len(starts) else line
    ck = chunk_of(seen[starts]) if len(starts) else line
    n_brk = brk[hi] - brk[lo]
    first_line, last_line = brk[lo] + np.arange(k), brk[hi] + np.arange(k)
    inner = (key != first_line[ck]) & (key != last_line[ck]) if len(key) else np.zeros(0, dtype=bool)
    kinds = {"lines": np.ones(len(key)), "bullet_lines": (head & B) != 0, "number_lines": (head & D) != 0, "end_lines": (tail & E) != 0, "verb_lines": (tail & V) != 0, "end_chars": ((tail & E) != 0) * length, "verb_chars": ((tail & V) != 0) * length}
    for name, w in kinds.items():
        out[name] = np.bincount(ck[inner], weights=np.asarray(w)[inner], minlength=k).astype(np.int64) if len(key) else np.zeros(k, dtype=np.int64)

    def state(of: np.ndarray, prefix: str) -> None:
        hit = np.flatnonzero(key == of[ck]) if len(key) else np.zeros(0, dtype=np.int64)
        n, f, e = (np.zeros(k, dtype=np.int64) for _ in range(3))
        n[ck[hit]], f[ck[hit]], e[ck[hit]] = length[hit], head[hit], tail[hit]
        out.update({f"{prefix}_n": n, f"{prefix}_first": f, f"{prefix}_last": e})

    state(first_line, "head")
    state(last_line, "tail")
    out["broken"] = n_brk > 0
    return pd.DataFrame(out)


_STATE = "struct<n: bigint, f: bigint, e: bigint>"


def _closed(sums: Column, s: Column) -> Column:
    """Line counts with an open line ended."""
    bit = lambda c, b: (c.bitwiseAND(F.lit(b)) != 0).cast("bigint")
    one = (s["n"] > 0).cast("bigint")
    add = {"lines": one, "bullet_lines": bit(s["f"], B), "number_lines": bit(s["f"], D), "end_lines": bit(s["e"], E), "verb_lines": bit(s["e"], V), "end_chars": bit(s["e"], E) * s["n"], "verb_chars": bit(s["e"], V) * s["n"]}
    return F.struct(*[(sums[c] + add[c]).alias(c) for c in _LINE])


def _joined(x: Column, y: Column) -> Column:
    return F.struct((x["n"] + y["n"]).alias("n"), F.when(x["n"] > 0, x["f"]).otherwise(y["f"]).alias("f"), F.when(y["n"] > 0, y["e"]).otherwise(x["e"]).alias("e"))


def _merge(x: Column, y: Column) -> Column:
    """Two neighbouring runs of chunks: (sums, broken, head, tail)."""
    middle = _joined(x["tail"], y["head"])
    plus = F.struct(*[(x["sums"][c] + y["sums"][c]).alias(c) for c in _LINE])
    both = x["broken"] & y["broken"]
    whole = _joined(x["head"], y["head"])
    return F.struct(
        F.when(both, _closed(plus, middle)).otherwise(plus).alias("sums"),
        (x["broken"] | y["broken"]).alias("broken"),
        F.when(x["broken"], x["head"]).otherwise(whole).alias("head"),
        F.when(y["broken"], y["tail"]).when(x["broken"], middle).otherwise(whole).alias("tail"),
    )


def _merged(partials: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Partials of each key merged in the order of their chunks."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col("open").alias("open"))))
    sums = [F.sum(c).alias(c) for c in COUNTS if c not in _LINE]
    got = partials.groupBy(*keys).agg(*sums, F.min(order).alias("_at"), parts.alias("_parts"))
    folded = F.aggregate(F.slice("_parts", 2, F.greatest(F.size("_parts") - 1, F.lit(0))), F.col("_parts")[0]["open"], lambda acc, p: _merge(acc, p["open"]))
    return got.withColumn("open", F.when(F.size("_parts") == 1, F.col("_parts")[0]["open"]).otherwise(folded)).drop("_parts").withColumnRenamed("_at", order)


def text_statistics(documents: DataFrame, chunk: int = 100_000, run: int = 64) -> DataFrame:
    """One row per doc_id with its counts (``COUNTS``).

    A null text counts as empty; an empty one gives zero counts. Equal rows are one document; of rows that repeat
    a doc_id with other text, the text of the least digest counts. Other columns are not read.
    """
    texts = documents.select("doc_id", F.xxhash64("text").alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    kind = dict(documents.dtypes)["doc_id"]
    own = ("head_n", "head_first", "head_last", "tail_n", "tail_first", "tail_last")
    names = ["doc_id", "digest", "no", *COUNTS, *own, "broken"]
    schema = f"doc_id {kind}, digest bigint, no int, " + ", ".join(f"{c} bigint" for c in (*COUNTS, *own)) + ", broken boolean"

    def counts(part: list[tuple]) -> pd.DataFrame:
        ids, digests, numbers, squeezed, before, cores, after = map(list, zip(*part, strict=True))
        got = chunk_counts(before, cores, after)
        return got.assign(doc_id=pd.Series(ids, dtype=object), digest=digests, no=numbers, squeezed=squeezed)[names]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, size = [], 0
        for b in batches:
            for doc, digest, text in zip(b["doc_id"], b["digest"], b["text"], strict=True):
                for no in range(max(1, -(-len(text) // chunk))):
                    at = no * chunk
                    core = text[at : at + chunk]
                    part.append((doc, digest, no, squeezed_size(text, at, at + max(1, len(core))), text[max(0, at - CONTEXT) : at], core, text[at + chunk : at + chunk + CONTEXT]))
                    size += len(core) + 2 * CONTEXT
                    if size >= 1_000_000:
                        yield counts(part)
                        part, size = [], 0
        if part:
            yield counts(part)

    counted = texts.mapInPandas(count, schema)
    st = lambda p: F.struct(F.col(f"{p}_n").alias("n"), F.col(f"{p}_first").alias("f"), F.col(f"{p}_last").alias("e"))
    opened = counted.withColumn("open", F.struct(F.struct(*_LINE).alias("sums"), "broken", st("head").alias("head"), st("tail").alias("tail")))
    partials = opened.select("doc_id", "digest", (F.col("no") / run).cast("int").alias("run"), "no", "open", *[c for c in COUNTS if c not in _LINE]).dropDuplicates(["doc_id", "digest", "no"])
    level = _merged(partials, ["doc_id", "digest", "run"], "no").drop("no")
    merged = _merged(level, ["doc_id", "digest"], "run")
    head = F.when(F.col("open.broken"), _closed(F.col("open.sums"), F.col("open.head"))).otherwise(F.col("open.sums"))
    done = merged.withColumn("_h", head).withColumn("_l", _closed(F.col("_h"), F.col("open.tail")))
    counts_ = F.struct(*[F.col(f"_l.{c}").alias(c) if c in _LINE else F.col(c) for c in COUNTS])
    return done.groupBy("doc_id").agg(F.min_by(counts_, "digest").alias("_c")).select("doc_id", "_c.*")


def ratios(stats: DataFrame) -> DataFrame:
    """Statistics with the derived ratios and the outcomes of plain rules."""
    c = F.col
    per = lambda x, y: (c(x) if isinstance(x, str) else x) / F.greatest(F.lit(1), c(y) if isinstance(y, str) else y)
    out = stats.withColumns({
        "mean_word": per("letters_in_words", "words"), "odd_share": per("odd", "seen"), "digit_share": per("digits", "seen"), "latin_share": per("latin", "seen"), "japanese_share": per("japanese", "seen"),
        "hiragana_share": per("hiragana", "japanese"), "katakana_share": per("katakana", "japanese"), "particle_share": per("particles", "japanese"),
        "common_share": F.when(c("latin") > c("japanese"), per("common", "words")).otherwise(0.0), "mark_share": 40 * per(c("stops") + c("commas") * 0.5 + c("ends"), "seen"), "stop_share": 40 * per(c("stops") + c("ends"), "seen"),
        "cell_share": per(c("tabs") + c("pipes"), "seen"), "sign_share": per("signs", "seen"), "run_share": per("long_run", "seen"), "squeeze": per("squeezed", "chars"), "line_length": F.log1p(per("seen", "lines")),
        "bullet_share": per(c("bullet_lines") + c("number_lines"), "lines"), "end_line_share": per("end_lines", "lines"), "end_share": per("end_chars", "seen"), "sentence_share": per(c("end_chars") + c("verb_chars"), "seen"), "size": F.log1p("seen"),
    })
    return out.withColumns({
        "rule_few_letters": (c("odd_share") + c("digit_share") > 0.25), "rule_no_sentences": c("stop_share") < 0.15, "rule_repeats": (c("squeeze") < 0.12) & (c("chars") > 200),
        "rule_code": c("run_share") + c("sign_share") > 0.15, "rule_cells": c("cell_share") > 0.02, "rule_bullets": c("bullet_share") > 0.5,
    })


FEATURES = ("mean_word", "odd_share", "digit_share", "latin_share", "japanese_share", "hiragana_share", "katakana_share", "particle_share", "common_share", "mark_share", "stop_share", "cell_share", "sign_share", "run_share", "squeeze", "line_length", "bullet_share", "end_line_share", "end_share", "sentence_share", "size")
RULES = ("rule_few_letters", "rule_no_sentences", "rule_repeats", "rule_code", "rule_cells", "rule_bullets")


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps: mean, scale and weights of standardised features."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.c_[np.ones(len(x)), np.clip((x - mean) / scale, -8, 8)]
    w = np.zeros(z.shape[1])
    ridge = np.r_[1e-6, np.full(z.shape[1] - 1, penalty)]
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def _inputs() -> list[Column]:
    return [F.col(f).cast("double") for f in FEATURES] + [F.col(r).cast("double") for r in RULES]


def text_kinds(documents: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    """Statistics, ratios, rule outcomes, ``score`` and ``is_prose`` of every document.

    The score is a logistic regression on the ratios, their squares and the rules, fitted to at most ``sample``
    labelled rows, chosen by hash of their id. Without labels of both kinds two failed rules decide.
    """
    known = checkpointed(ratios(text_statistics(documents)))
    marked = labels.where("label is not null").select("doc_id", (F.col("label") != "prose").cast("int").alias("_y"), F.xxhash64("doc_id").alias("_h"))
    # the sample is taken before the join, so what is broadcast and collected is at most ``sample`` rows
    chosen = checkpointed(marked.orderBy("_h", "_y").limit(sample))
    rows = known.join(F.broadcast(chosen), "doc_id").select(F.array(*_inputs()).alias("x"), "_y", "_h").orderBy("_h", "_y").toPandas()
    failed = sum((F.col(r).cast("int") for r in RULES), F.lit(0))
    if rows["_y"].nunique() < 2:
        score = F.when(failed >= 2, 0.9).otherwise(0.1)
    else:
        x = np.array(rows["x"].tolist(), dtype=float)
        x = np.c_[x, x[:, : len(FEATURES)] ** 2]
        mean, scale, w = fit_logistic(x, rows["_y"].to_numpy())
        raw = [*_inputs(), *[F.col(f) * F.col(f) for f in FEATURES]]
        terms = [F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (c - float(m)) / float(s))) * float(v) for c, m, s, v in zip(raw, mean, scale, w[1:], strict=True)]
        score = 1 / (1 + F.exp(-(sum(terms, F.lit(float(w[0]))))))
    return known.withColumn("score", score).withColumn("is_prose", F.col("score") <= 0.5)
