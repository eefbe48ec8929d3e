"""Language ID by mixture inference over hashed character trigrams.

Training counts the trigrams of every document that may be learnt from, per language, in 2**BITS hashed buckets: each
task sums its counts before they are shuffled, so the result is one number per language and bucket whatever the input.

A document is a mixture: its trigrams are drawn from languages l with proportions p(l).  Expectation-maximisation
estimates p; languages then enter in order of their proportion, each refit by EM, as long as the log-likelihood grows
by more than the penalty ``PENALTY * log(trigrams) / 2`` a language plus ``GAIN`` a trigram, which a related language's
stray trigrams do not reach.  The prediction is the language with the largest proportion, the score that proportion.

At most ``MAX_LANGS`` languages are learnt, those of the most labelled rows (ties: first in code point order), so the
table that is broadcast is at most 2**BITS * MAX_LANGS numbers of four bytes, 64 MB, however many tags ``lang`` holds.

Defined cases: a null text and a text without a letter are ``und`` with score 0, and so is every text if nothing could be
learnt; a language beyond ``MAX_LANGS`` is never predicted; texts with null ``lang`` and documents with a null ``doc_id`` are predicted and never learnt from; ties go to the
language first in code point order; repeated rows are each predicted and each counted; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticespark.llm.common import held_out, staged

BITS = 15
PENALTY, GAIN, ROUNDS = 2.0, 0.05, 10
MAX_LANGS = 512
_BLOCK = 1 << 20  # characters hashed at a time
_HELD_LANGS = 32  # languages counted at a time by a task


def _letters() -> np.ndarray:
    """For each code point itself if it is a letter, else a space."""
    table = np.full(0x110000, 32, np.uint32)
    at = [i for i in range(0x110000) if chr(i).isalpha()]
    table[at] = at
    return table


class Trigrams:
    """Text -> counts of its trigram buckets; None if it has no letter.  A trigram's middle character is a letter."""

    def __init__(self):
        self.letters = _letters()

    def __call__(self, text: str | None) -> np.ndarray | None:
        out = None
        low = (text or "").lower()
        for lo in range(0, len(low), _BLOCK):
            part = " " * (lo == 0) + low[max(0, lo - 2) : lo + _BLOCK] + " " * (lo + _BLOCK >= len(low))
            c = self.letters[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
            h = (c[:-2] * np.uint64(0x9E3779B97F4A7C15) + c[1:-1]) * np.uint64(0xD6E8FEB86659FD93) + c[2:]
            h = (h * np.uint64(0xA24BAED4963EE407))[c[1:-1] != 32] >> np.uint64(64 - BITS)
            if len(h):
                n = np.bincount(h.astype(np.int64), minlength=1 << BITS)
                out = n if out is None else out + n
        return out


def learn(docs: DataFrame, max_langs: int = MAX_LANGS) -> tuple[list[str], np.ndarray]:
    """Languages in code point order and their trigram probabilities, smoothed by half a count; from all rows of ``docs``.

    With more than ``max_langs`` tags, from the rows of the most frequent ones.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trigrams, held = Trigrams(), {}

        def out() -> Iterator[pd.DataFrame]:
            for lang, n in held.items():
                at = np.flatnonzero(n)
                yield pd.DataFrame({"lang": pd.Series([lang] * len(at), dtype=object), "bucket": at.astype(np.int32), "n": n[at]})
            held.clear()

        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                if (n := trigrams(text)) is not None:
                    if lang not in held and len(held) >= _HELD_LANGS:
                        yield from out()
                    held[lang] = held[lang] + n if lang in held else n
        yield from out()

    tags = docs.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    common = tags.orderBy(F.desc("rows"), "lang").limit(max_langs).select("lang")
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text").join(F.broadcast(common), "lang", "left_semi")
    counts = known.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = staged(counts, "trigrams")  # one number per language and bucket
    langs = sorted(r.lang for r in rows.select("lang").distinct().collect())
    table = np.full((len(langs), 1 << BITS), 0.5, np.float32)
    for i, lang in enumerate(langs):  # a language's numbers at a time
        of = rows.where(F.col("lang") == lang).select("bucket", "n").toPandas()
        row = np.full(1 << BITS, 0.5)
        row[of["bucket"].to_numpy()] += of["n"].to_numpy()
        table[i] = row / row.sum()
    return langs, table


def _em(p: np.ndarray, n: np.ndarray, share: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of counts ``n`` under the mixture of the rows of ``p``."""
    total = n.sum()
    for _ in range(rounds):
        part = share[:, None] * p
        share = (part * (n / part.sum(0))).sum(1) / total
    return share, float(n @ np.log(share @ p))


def infer(table: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(languages, proportions) of the selected set for the bucket counts of one text."""
    at = np.flatnonzero(counts)
    n = counts[at].astype(float)
    p = table[:, at].astype(float)
    share, _ = _em(p, n, np.full(len(p), 1 / len(p)))
    order = np.argsort(-share, kind="stable")
    single = np.log(p) @ n
    chosen, fit, best = order[:1], np.ones(1), single[order[0]]
    if (alone := int(np.argmax(single))) != order[0]:
        chosen, best = np.array([alone]), single[alone]
        order = np.concatenate([[alone], order[order != alone]])
    for k in range(2, len(order) + 1):
        more, value = _em(p[order[:k]], n, np.append(fit * 0.8, 0.2))
        if value - best <= PENALTY * np.log(n.sum() + 1) / 2 + GAIN * n.sum():
            break
        chosen, fit, best = order[:k], more, value
    return chosen, fit


def identify(docs: DataFrame, max_langs: int = MAX_LANGS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, langs`` of every row; ids with crc32 mod 4 = 2 are never learnt from."""
    out_of = held_out(F.col("doc_id"), 4, 2)
    langs, table = learn(docs.where(F.col("doc_id").isNotNull() & ~out_of), max_langs)
    shared = docs.sparkSession.sparkContext.broadcast((langs, table))  # 2**BITS numbers a language, MAX_LANGS languages

    @F.pandas_udf("lang_pred string, score double, langs array<struct<lang:string,share:double>>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        (langs, table), trigrams = shared.value, Trigrams()
        for texts in batches:
            out = []
            for text in texts:
                counts = trigrams(text) if langs else None
                if counts is None:
                    out.append(("und", 0.0, []))
                    continue
                chosen, share = infer(table, counts)
                top = min(range(len(chosen)), key=lambda i: (-share[i], chosen[i]))
                out.append((langs[chosen[top]], float(min(1.0, share[top])), [(langs[c], float(s)) for c, s in zip(chosen, share)]))
            yield pd.DataFrame({"lang_pred": pd.Series([x[0] for x in out], dtype=object), "score": [x[1] for x in out], "langs": pd.Series([x[2] for x in out], dtype=object)})

    both = docs.select("doc_id", predict(F.col("text")).alias("_p"))
    return both.select("doc_id", out_of.alias("held_out"), "_p.lang_pred", "_p.score", "_p.langs")
