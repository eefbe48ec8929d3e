"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

A text's tokens are runs of word characters and runs of symbols; every token, every pair of neighbouring tokens, and
both once more as shapes (upper case, other word, symbol; for a pair also whether it repeats one token) are hashed into
``2**BITS`` features.  A feature's value is log(1 + count), scaled so that the
text's vector has length 1.  Scoring is the sparse dot product of that vector with the weights, over the whole text.

Training takes a bounded sample of the labelled rows (``max_train`` documents, one row each, chosen by the hash of their id), so that the
cost of the sequential updates does not grow with the corpus: their sparse vectors are made in parallel and meet in one
task, which runs FTRL-proximal over them.  The model has at most ``2**BITS`` weights whatever the input.

Defined cases: null counts as the empty text, whose score is that of the bias; without labelled rows every score is 0.5; null labels and labels of unknown ids are ignored; several labels of one id count as their mean,
1 from a half on; of rows that repeat an id one is learnt from (see ``labelled``); documents with a null ``doc_id`` are scored and never learnt from; repeated rows are each scored;
other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticespark.llm.common import held_out, staged

BITS = 18
MAX_TRAIN = 16_000
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.05, 0.01
EPOCHS, UPDATES = 4, 12_000  # passes over the sample: at least so many, and until so many updates were made
KEEP = 0.7
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_MEMO = 60_000  # token hashes remembered by a task


class Features:
    """Text -> (sorted feature numbers, values).  One instance a task: it remembers hashes of up to ``_MEMO`` tokens."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def _hash(self, token: str) -> int:
        if len(self.memo) >= _MEMO:
            self.memo.clear()
        shape = 1 if token.isupper() and len(token) > 1 else 2 if token[0].isalpha() else 3
        h = self.memo[token] = zlib.crc32(token.encode("utf-8", "surrogatepass")) << 2 | shape
        return h

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        tokens = _TOKEN.findall(text or "")
        if not tokens:
            return np.empty(0, np.int64), np.empty(0)
        known = self.memo.get
        h = np.array([known(t) or self._hash(t) for t in tokens], np.uint64)
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xD6E8FEB86659FD93)
        ones = h * np.uint64(0xD6E8FEB86659FD93)
        shape = h & np.uint64(3)
        same = np.uint64(16) * (h[:-1] == h[1:]) + np.uint64(4) * shape[:-1] + shape[1:] + np.uint64(32)
        shapes = np.concatenate([shape, same]) * np.uint64(0xA24BAED4963EE407)
        index, count = np.unique(np.concatenate([ones, pairs, shapes]) >> np.uint64(64 - BITS), return_counts=True)
        value = np.log1p(count)
        return index.astype(np.int64), value / np.sqrt((value * value).sum())


def _vectors(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for b in batches:
            made = [features(t) for t in b["text"]]
            yield pd.DataFrame({"turn": b["turn"], "doc_id": b["doc_id"], "y": b["y"], "index": [i.astype(np.int32) for i, _ in made], "value": [v.astype(np.float32) for _, v in made]})

    return rows.mapInPandas(run, "turn long, doc_id long, y double, index array<int>, value array<float>")


def ftrl(index: list[np.ndarray], value: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """FTRL-proximal over the rows in order; the last weight is the bias."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(i) -> np.ndarray:
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= L1, 0.0, w)

    for _ in range(max(EPOCHS, -(-UPDATES // max(1, len(y))))):
        for i, x, t in zip(index, value, y):
            i, x = np.append(i, 1 << BITS), np.append(x, 1.0)
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(x @ w, -35, 35))) - t) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(np.arange((1 << BITS) + 1))


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, max_train: int) -> DataFrame:
    """``doc_id, text, y, turn`` of at most ``max_train`` rows: ids that are not held out, smallest hashes first.

    Of rows that repeat an id the text with the smallest hash (ties: the smallest text) is learnt from, so repeated
    rows do not enlarge the sample; they are reduced by a partial aggregate before the shuffle.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id"), modulus, remainder))
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(label) >= 0.5).cast("double").alias("y"))
    turn = F.xxhash64(F.lit(11), "doc_id")
    sample = staged(marks.withColumn("turn", turn).orderBy("turn", "doc_id").limit(max_train), "sample")  # narrow rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(F.broadcast(sample), "doc_id")  # at most max_train ids
    found = found.groupBy("doc_id", "y", "turn").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return found.select("doc_id", F.col("t.text").alias("text"), "y", "turn")


def train(sample: DataFrame) -> np.ndarray | None:
    """The weights, or None without a labelled row."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["turn", "doc_id"])  # one row per id: a total order
        w = ftrl(list(rows["index"]), list(rows["value"]), rows["y"].to_numpy())
        at = np.flatnonzero(w)
        return pd.DataFrame({"feature": at, "weight": w[at]})

    rows = _vectors(sample).groupBy().applyInPandas(fit, "feature long, weight double").toPandas()  # at most 2**BITS + 1
    if rows.empty:
        return None
    w = np.zeros((1 << BITS) + 1)
    w[rows["feature"].to_numpy()] = rows["weight"].to_numpy()
    return w


def scored(docs: DataFrame, weights: np.ndarray | None, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` and ``score``; the text itself is returned only if it is one of them."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2**BITS + 1 numbers

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, w = Features(), shared.value
        for texts in batches:
            if w is None:
                yield pd.Series(np.full(len(texts), 0.5))
                continue
            out = np.empty(len(texts))
            for k, t in enumerate(texts):
                i, x = features(t)
                out[k] = x @ w[i] + w[-1]
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return docs.select(*columns, score(F.col("text")).alias("score"))


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; ids with crc32 mod 4 = 2 are never learnt from."""
    weights = train(labelled(docs, labels, "quality", 4, 2, max_train))
    out = scored(docs, weights, ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))
