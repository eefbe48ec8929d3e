"""Spelling variant grouping by blocked Gram matrices of letter counts.

Words are maximal runs of letters; two words are near if one inserted, deleted or replaced letter turns one into the
other.  One edit leaves the first or the second half of the shorter word as it is, so words are blocked by the length
``m`` of the shorter word and by its first ``m // 2`` or last ``m - m // 2`` letters; a block holds the adjacent lengths
``m`` and ``m + 1``.  Inside a block NumPy multiplies the matrix of letter counts by its transpose: the Gram matrix gives
all squared distances ``|x|^2 + |y|^2 - 2 x.y``.  One edit moves the counts by at most two, so pairs at most two apart are
kept and their letters compared.  Each pair is met once: in a second-half block only if its first halves differ.

Blocks of more than ``TILE`` words are dealt into tiles by the hash of the word and every pair of tiles is a task of its
own, so no task holds a hot block.  A tile returns one row per word (number of near words, best near word), never pairs.

Defined cases: null texts have no words; a null ``doc_id`` counts as an empty one; repeated rows count again; an empty
table has no words; words of any length are compared whole; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticespark.llm.common import staged

LEAST_LETTERS, LEAST_N, FORM_RATIO, DELETE_EVERY = 7, 2, 10, 31
TILE = 2_048
PACK = 768  # small neighbouring blocks share one product of about so many rows
_ROWS = 512  # rows of a Gram matrix made at once
_DIMS = 32  # a to z, and the accented letters folded into the rest: folding only makes distances smaller
_VERIFY = 1 << 22  # letters compared at once
_FLUSH = 300_000  # words counted by a task before they are sent on

_RUN = re.compile(rb"[a-z\xc0-\xff]+")
_FOLD = np.array([i - 97 if 97 <= i < 123 else 26 + i % (_DIMS - 26) for i in range(256)])


def edited(run: bytes, seed: int) -> bytes:
    """The Latin-1 run with one letter deleted if ``DELETE_EVERY`` divides the crc32 of its document's id and itself."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % DELETE_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of all words with at least ``LEAST_LETTERS`` letters, summed per task before they are shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[bytes] = Counter()

        def out() -> pd.DataFrame:
            made = pd.DataFrame({"word": [w.decode("latin-1") for w in found], "n": list(found.values())})
            found.clear()
            return made

        for b in batches:
            for doc_id, text in zip(b["_id"], b["_text"]):
                seed = zlib.crc32(doc_id.encode() + b":")
                # Letters beyond U+00FF become '?', which is no letter; bytes.lower() changes A-Z alone.
                for run, n in Counter(_RUN.findall(text.encode("latin-1", "replace").lower())).items():
                    if len(run) >= LEAST_LETTERS and len(word := edited(run, seed)) >= LEAST_LETTERS:
                        found[word] += n
                if len(found) >= _FLUSH:
                    yield out()
        if found:
            yield out()

    rows = docs.where(F.col("text").isNotNull()).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("text").alias("_text"))
    counts = rows.mapInPandas(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_N)


def _blocks(words: DataFrame) -> DataFrame:
    """``word, n, m, half, i, j``: each word in its four blocks; hot blocks in every pair of tiles that needs it."""
    size = F.length("word")

    def block(m: Column, side: int) -> Column:
        k = F.floor(m / 2).cast("int")
        part = F.substring("word", F.lit(1), k) if side == 0 else F.substring("word", size - (m - k) + 1, m - k)
        return F.struct(m.cast("int").alias("m"), F.concat(F.lit("PS"[side]), part).alias("half"))

    keys = F.array(*(block(m, side) for m in (size, size - 1) for side in (0, 1)))
    rows = words.withColumn("block", F.explode(keys)).select("word", "n", "block.m", "block.half")
    sizes = rows.groupBy("m", "half").agg(F.count(F.lit(1)).alias("_size"))
    tiles = sizes.where(F.col("_size") > 1).select("m", "half", F.ceil(F.col("_size") / TILE).cast("int").alias("_tiles"))
    rows = rows.join(tiles, ["m", "half"])  # words that are alone in a block leave
    own = F.pmod(F.xxhash64("word"), F.col("_tiles")).cast("int")
    every = F.transform(F.sequence(F.lit(0), F.col("_tiles") - 1), lambda t: F.struct(F.least(t, own).alias("i"), F.greatest(t, own).alias("j")))
    return rows.withColumn("t", F.explode(every)).select("word", "n", "m", "half", "t.i", "t.j", own.alias("own"))


def _letters(words: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), width)


def _counts(letters: np.ndarray) -> np.ndarray:
    """The matrix of letter counts: one row a word, one column a (folded) letter."""
    flat = _FOLD[letters] + _DIMS * np.arange(len(letters))[:, None]
    return np.bincount(flat.ravel(), minlength=_DIMS * len(letters)).reshape(-1, _DIMS).astype(np.float32)


def _close(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows at squared distance two or less, from Gram products of ``_ROWS`` rows at a time."""
    xx, yy = 0.5 * (x * x).sum(1) - 0.5, 0.5 * (y * y).sum(1) - 0.5
    left, right = [], []
    for at in range(0, len(x), _ROWS):
        i, j = np.nonzero(x[at:at + _ROWS] @ y.T >= xx[at:at + _ROWS, None] + yy)
        left.append(i + at)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` (m letters) and ``b`` (m or m + 1 letters) differ by exactly one edit."""
    m = a.shape[1]
    if b.shape[1] == m:
        return (a != b).sum(1) == 1
    first = np.logical_and.accumulate(a == b[:, :m], axis=1).sum(1)
    last = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return first + last >= m


def _pairs(short: np.ndarray, other: np.ndarray, same: bool, keys: tuple[np.ndarray, np.ndarray], tiles: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray]):
    """Verified pairs of one product: equal block, the tiles of this task, first halves that differ in second-half blocks."""
    left, right = _close(_counts(short), _counts(other))
    fit = keys[0][left] == keys[1][right]
    if same:
        fit &= left < right
    fit &= tiles[0][left, 0] + tiles[1][right, 0] == tiles[0][left, 1]
    left, right = left[fit], right[fit]
    k, m = short.shape[1] // 2, short.shape[1]
    out = []
    for at in range(0, len(left), step := max(1, _VERIFY // (m + 1))):
        i, j = left[at:at + step], right[at:at + step]
        a, b = short[i], other[j]
        good = _one_edit(a, b) & (~second[0][i] | (a[:, :k] != b[:, :k]).any(1))
        out.append((i[good], j[good]))
    return np.concatenate([i for i, _ in out]) if out else left, np.concatenate([j for _, j in out]) if out else right


def _near_rows(blocks: DataFrame) -> DataFrame:
    """``word, n_near, best`` of each tile; rows of a block and pair of tiles follow each other."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        """Whole blocks of one ``m``: the Gram products of the shorter words with themselves and with the longer ones."""
        m = int(rows["m"].iat[0])
        word = [w.encode("latin-1") for w in rows["word"]]
        n = rows["n"].to_numpy()
        key = rows["key"].to_numpy()
        # Two words meet in the task of their two tiles only: own tiles add up to i + j (a pair i < j takes one of each).
        tile = np.column_stack([rows["own"].to_numpy(), (rows["i"] + rows["j"]).to_numpy()])
        second = rows["half"].str.startswith("S").to_numpy()
        size = np.fromiter(map(len, word), np.int64, len(word))
        short, long_ = np.flatnonzero(size == m), np.flatnonzero(size == m + 1)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if len(short):
            x = _letters([word[k] for k in short], m)
            for others, same in ((short, True), (long_, False)):
                if len(others):
                    y = x if same else _letters([word[k] for k in others], m + 1)
                    i, j = _pairs(x, y, same, (key[short], key[others]), (tile[short], tile[others]), (second[short], second[others]))
                    a.append(short[i])
                    b.append(others[j])
        one, two = np.concatenate([*a, *b]), np.concatenate([*b, *a])
        names = rows["word"].to_numpy()
        order = np.lexsort((np.array(word)[two], -n[two], one))  # Latin-1 bytes sort as code points do
        one, two = one[order], two[order]
        at = np.flatnonzero(np.r_[True, one[1:] != one[:-1]]) if len(one) else one
        return pd.DataFrame({"word": names[one[at]], "n_near": np.diff(np.r_[at, len(one)]), "near_n": n[two[at]], "near": names[two[at]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        number, last = 0, None  # number of the block, its key

        def done() -> Iterator[pd.DataFrame]:
            if held:
                rows = pd.concat(held, ignore_index=True)
                held.clear()
                if len(rows) > 1:
                    yield solve(rows)

        for b in batches:
            cols = [b[c].to_numpy() for c in ("m", "half", "i", "j")]
            new = np.ones(len(b), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
            new[:1] = last != tuple(c[0] for c in cols) if len(b) else new[:1]
            b = b.assign(key=number + np.cumsum(new))
            starts = np.flatnonzero(new)
            at, size = 0, sum(map(len, held))
            for s in starts:
                # A new block starts here: solve what is held if it is enough or of another length.
                before = cols[0][s - 1] if s else (held[-1]["m"].iat[-1] if held else None)
                if size + s - at >= PACK or (before is not None and before != cols[0][s]):
                    held.append(b.iloc[at:s])
                    yield from done()
                    at, size = s, 0
            held.append(b.iloc[at:])
            if len(b):
                number, last = int(b["key"].iat[-1]), tuple(c[-1] for c in cols)
        yield from done()

    ordered = blocks.repartition(F.col("m"), F.col("half"), F.col("i"), F.col("j")).sortWithinPartitions("m", "half", "i", "j")
    return ordered.mapInPandas(run, "word string, n_near long, near_n long, near string")


def _with_roots(words: DataFrame) -> DataFrame:
    """Follow forms to the last word.  A form occurs ten times as often, so chains are short; each round doubles the hops."""
    up = staged(words.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "forms")
    while True:
        nxt = up.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        joined = staged(up.join(nxt, "root", "left").select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved")), "roots")
        up = joined.select("word", "root")
        if joined.where("_moved").isEmpty():
            break
    return words.join(up, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the documents."""
    words = staged(word_counts(docs), "words")
    near = _near_rows(_blocks(words))
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("near")))
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.minus_n") >= FORM_RATIO * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best.minus_n")).alias("form_n"))
    return _with_roots(staged(found, "variants")).select("word", "form", "root", "n", "n_near", "form_n")
