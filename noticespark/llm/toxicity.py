"""Toxicity by a weighted finite-state pattern grammar over clauses.

A text is cut into clauses at sentence marks and line ends.  A lexicon maps a clause's words to marks: insult or threat
(both with a weight), target (second and third persons), negation, reporting verb, other.  Five transducers, each a
table ``(state, symbol) -> (state, symbol)``, rewrite the marks:

* insult and threat turn their marks into the patterns *bare* and *threat*;
* target has a state per word for which a target still counts; within that reach it turns *bare* into *targeted* and
  *threat* into *aimed threat*;
* negation and report turn, within their reach, every pattern into *negated* and *reported*.

``compose`` builds their product over the reachable states.  A target may stand before or after what it aims at, so
the grammar is a pair of deterministic machines: ``BACK`` (insult, threat, target) reads the clause from its end and
``FORE`` (target, negation, report) reads what ``BACK`` wrote from the start.  The arcs that write a pattern carry its
weight.  Clauses without an insult or a threat have no such arc and are not run.

A document's numbers are, for each pattern, log(1 + sum of the entries' weights over its clauses), and the same of its
heaviest clause.  A logistic regression weighs them under ``GENERATORS``: its weights are sums of increments >= 0, so
that aimed >= bare >= negated, reported, loose threats >= 0 whatever the sample holds, with a ridge towards ``FIXED``,
so that patterns which the sample lacks keep a weight.

The insult entries are words and word beginnings (five letters or more, ending in ``*``) with the lower bound of their
log-odds (one standard error off), learnt from the labelled rows together with a fixed list.  Only a bounded sample of
the labelled rows is learnt from (``MAX_TRAIN`` documents, one row each) and at most ``ENTRIES`` entries are kept.

Defined cases: null counts as the empty text, which matches nothing and has the lowest score; without labelled rows the
fixed lists and ``FIXED`` are used; null labels and unknown ids are ignored; of rows that repeat an id one is learnt
from (see ``quality_classifier.labelled``); a document with a null ``doc_id`` is scored and never learnt from; repeated
rows are each scored; words of the target, negation and report lists are never entries; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticespark.llm.common import held_out, staged
from noticespark.llm.quality_classifier import labelled

MAX_TRAIN, ENTRIES, LEAST_TOXIC, LEAST_ODDS = 16_000, 2_000, 4, 2.5
TOXIC = 0.7
# Fixed words of the transducers (English, German, French, Spanish).
INSULTS = "idiot moron stupid worthless pathetic trash scum loser disgusting clown imbecile bastard".split()
THREATS = "kill hurt destroy beat murder burn shoot töten verletzen umbringen tuer blesser frapper matar herir golpear".split()
TARGETS = "you your yours he she they them him her du dich dein ihr euch sie tu toi vous votre ils tú te usted ustedes ellos".split()
NEGATIONS = "not never no none nicht kein keine nie ne pas jamais aucun nunca jamás ninguno".split()
REPORTS = "said says told called quoted claims alleged sagte sagt behauptet dit disait affirme dijo dice afirma".split()
PATTERNS = ("bare", "targeted", "negated", "reported", "threat", "aimed threat")
MARKS = ("other", "target", "negation", "report", "insult", "threat word")
SYMBOLS = MARKS + PATTERNS
REACH = 5  # words over which a negation, a report or a target still counts
LISTED = 4.0  # weight of the entries of the fixed lists

Machine = dict[tuple[object, str], tuple[object, str]]  # (state, symbol read) -> (state, symbol written)


def rewriter(pairs: dict[str, str]) -> Machine:
    """One state; the symbols of ``pairs`` are rewritten, all others pass."""
    return {(0, s): (0, pairs.get(s, s)) for s in SYMBOLS}


def window(opener: str, pairs: dict[str, str]) -> Machine:
    """After ``opener`` the symbols of ``pairs`` are rewritten for ``REACH`` words; a state is the number of words left."""
    return {(left, s): (REACH if s == opener else max(0, left - 1), pairs.get(s, s) if left else s) for left in range(REACH + 1) for s in SYMBOLS}


def compose(first: Machine, second: Machine) -> Machine:
    """The machine that writes what ``second`` makes of what ``first`` writes: product of the states reached from (0, 0)."""
    out, todo, known = {}, [(0, 0)], {(0, 0)}
    while todo:
        p, q = todo.pop()
        for s in SYMBOLS:
            p_next, between = first[p, s]
            q_next, written = second[q, between]
            out[(p, q), s] = (p_next, q_next), written
            if (p_next, q_next) not in known:
                known.add((p_next, q_next))
                todo.append((p_next, q_next))
    names = {(0, 0): 0}
    for state in sorted(known - {(0, 0)}, key=str):
        names[state] = len(names)
    return {(names[p], s): (names[q], t) for (p, s), (q, t) in out.items()}


INSULT, THREAT = rewriter({"insult": "bare"}), rewriter({"threat word": "threat"})
TARGET = window("target", {"bare": "targeted", "threat": "aimed threat"})
NEGATION = window("negation", dict.fromkeys(PATTERNS, "negated"))
REPORT = window("report", dict.fromkeys(PATTERNS, "reported"))
BACK = compose(compose(INSULT, THREAT), TARGET)
FORE = compose(compose(TARGET, NEGATION), REPORT)


def _table(machine: Machine) -> list[list[tuple[int, int]]]:
    """``table[state][symbol]`` = (state, symbol), by numbers."""
    states = 1 + max(p for p, _ in machine)
    return [[(machine[p, s][0], SYMBOLS.index(machine[p, s][1])) for s in SYMBOLS] for p in range(states)]


_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[^.!?;:\n]+")
_LEAST_STEM, _MOST_STEM = 5, 10
_MEMO = 60_000
RIDGE = 2.0


def _stems(word: str) -> list[str]:
    return [word[:k] + "*" for k in range(_LEAST_STEM, min(_MOST_STEM, len(word) - 1) + 1)]


def terms(text: str | None) -> set[str]:
    words = set(_WORD.findall((text or "").lower()))
    return words.union(*map(_stems, words)) if words else set()


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Entries with their log-odds; document counts are summed per map task before they are shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()

        def out() -> pd.DataFrame:
            keys = [*({*toxic} | {*clean})]
            made = pd.DataFrame({"term": pd.Series(keys, dtype=object), "toxic": [toxic[k] for k in keys], "clean": [clean[k] for k in keys]})
            toxic.clear()
            clean.clear()
            return made

        for b in batches:
            for text, y in zip(b["text"], b["y"]):
                (toxic if y else clean).update(terms(text))
                if len(toxic) + len(clean) > 500_000:
                    yield out()
        yield out()

    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = n.get(1.0, 0), n.get(0.0, 0)
    lexicon = {w: LISTED for w in INSULTS}
    if not n_toxic or not n_clean:
        return lexicon
    counts = sample.select("text", "y").mapInPandas(count, "term string, toxic long, clean long")
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.1) / n_toxic) - F.log((F.col("clean") + 0.5) / n_clean)
    odds = odds - F.sqrt(1 / F.col("toxic") + 1 / (F.col("clean") + 0.5))
    best = counts.where(F.col("toxic") >= LEAST_TOXIC).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    for r in best.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "term").limit(ENTRIES).collect():
        lexicon[r["term"]] = min(8.0, r["odds"])
    return lexicon


class Grammar:
    """The lexicon and the tables of the two machines.  ``features`` reads a whole text."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {t: w for t, w in lexicon.items() if not t.endswith("*")}
        self.stems = {t[:-1]: w for t, w in lexicon.items() if t.endswith("*")}
        lists = ((THREATS, "threat word"), (TARGETS, "target"), (NEGATIONS, "negation"), (REPORTS, "report"))
        self.mark = {w: SYMBOLS.index(mark) for words, mark in lists for w in words}
        self.back, self.fore = _table(BACK), _table(FORE)
        self.memo: dict[str, float] = {}

    def weight(self, word: str) -> float:
        """The heaviest insult or threat entry that accepts the word; remembered for up to ``_MEMO`` words."""
        if (known := self.memo.get(word)) is not None:
            return known
        kind = SYMBOLS[self.mark.get(word, 0)]
        best = LISTED if kind == "threat word" else 0.0
        if kind in ("other", "threat word"):
            best = max(best, self.words.get(word, 0.0))
            for k in range(_LEAST_STEM, min(_MOST_STEM, len(word) - 1) + 1):
                best = max(best, self.stems.get(word[:k], 0.0))
        if len(self.memo) >= _MEMO:
            self.memo.clear()
        self.memo[word] = best
        return best

    def clause(self, words: list[str], weights: list[float]) -> np.ndarray:
        """Weights of the clause's entries per pattern: ``BACK`` from the end, then ``FORE`` from the start."""
        insult, first = SYMBOLS.index("insult"), len(MARKS)
        marks = [self.mark.get(word, insult if w else 0) for word, w in zip(words, weights)]
        state, out = 0, np.zeros(len(PATTERNS))
        for at in range(len(marks) - 1, -1, -1):
            state, marks[at] = self.back[state][marks[at]]
        state = 0
        for mark, w in zip(marks, weights):
            state, written = self.fore[state][mark]
            if written >= first:
                out[written - first] += w
        return out

    def features(self, text: str | None) -> np.ndarray:
        """One number per pattern and that of the heaviest clause."""
        total, heaviest = np.zeros(len(PATTERNS)), 0.0
        for m in _CLAUSE.finditer((text or "").lower()):
            words = _WORD.findall(m[0])
            weights = [*map(self.weight, words)]
            if any(weights):
                found = self.clause(words, weights)
                total += found
                heaviest = max(heaviest, float(found @ IN_CLAUSE))
        return np.log1p(np.append(total, heaviest))


#: Shares with which the patterns count for the heaviest clause; same order as PATTERNS.
IN_CLAUSE = np.array([1.0, 1.5, 0.25, 0.25, 0.25, 1.5])
#: Increments of the weights (rows) over PATTERNS and the heaviest clause (columns): any mention, neither negated nor
#: reported nor a loose threat, aimed, heaviest clause.
GENERATORS = np.array(
    [
        [1, 1, 1, 1, 1, 1, 0],
        [1, 1, 0, 0, 0, 1, 0],
        [0, 1, 0, 0, 0, 1, 0],
        [0, 0, 0, 0, 0, 0, 1],
    ],
    float,
)
#: Bias and increments where nothing can be learnt; the ridge draws towards them.
FIXED = np.array([-4.0, 0.3, 1.2, 0.8, 1.0])


def learn_weights(sample: DataFrame, grammar: Grammar) -> np.ndarray:
    """Bias and increments from the features of the bounded sample (``MAX_TRAIN`` rows of eight numbers)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "x": [grammar.features(t) for t in b["text"]]})

    rows = sample.select("text", "y").mapInPandas(run, "y double, x array<double>").toPandas()
    if rows.empty or rows["y"].nunique() < 2:
        return FIXED
    x = np.column_stack([np.ones(len(rows)), np.stack(rows["x"]) @ GENERATORS.T])
    return fit(x, rows["y"].to_numpy())


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 3_000) -> np.ndarray:
    """Bias and increments >= 0 by projected gradient steps with momentum; ridge towards ``FIXED``."""
    ridge = np.array([0.01] + [RIDGE] * (x.shape[1] - 1))
    rate = 1 / (np.linalg.norm(x, 2) ** 2 / 4 + RIDGE)
    w = ahead = FIXED
    for k in range(rounds):
        slope = x.T @ (1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30))) - y) + ridge * (ahead - FIXED)
        new = ahead - rate * slope
        new[1:] = np.maximum(new[1:], 0)
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; ids with crc32 mod 3 = 1 are never learnt from."""
    sample = staged(labelled(docs, labels, "toxic", 3, 1, max_train), "toxic_sample")
    grammar = Grammar(learn_lexicon(sample.where(F.col("turn") % 2 == 0)))
    # Entries come from one half and the weights from the other, so that chance entries are not overrated.
    weights = learn_weights(sample.where(F.col("turn") % 2 != 0), grammar)
    grammar = Grammar(learn_lexicon(sample))
    shared = docs.sparkSession.sparkContext.broadcast((grammar, weights))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grammar, w = shared.value
        for texts in batches:
            x = np.array([grammar.features(t) for t in texts]).reshape(-1, len(PATTERNS) + 1)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ (w[1:] @ GENERATORS) + w[0], -35, 35))))

    out = docs.select("doc_id", score(F.col("text")).alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
