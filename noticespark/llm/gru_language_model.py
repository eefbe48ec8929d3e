"""Language-model scoring with a gated recurrent network and a class-factored softmax.

Tokens are the words of the text with A-Z lowered, then one end.  The network reads them in windows of ``WINDOW`` tokens
and carries its state from window to window, so the score is the log-likelihood of the whole document.  The output is
factored: the class of the next token first, then the token within its class.  The ``WORDS`` most frequent training words
and the end have network outputs, in classes of ``MEMBERS`` words of like frequency.  All other words fall into ``TAILS``
classes by their last bytes; within those, a word has the probability (c + 1) / (N + V + 1) of its class's training counts,
so every text has a probability.

Training is truncated backpropagation in numpy over every training document, in ``ROUNDS`` rounds (a document's round is
the hash of its id).  In a round each task starts from the same weights and makes AdaGrad steps from ``LANES`` windows at
a time: every window of each document (``EVERY`` is 1), with the state that the window before it leaves (truncated
carrying: scoring carries the state through the whole document).  The tasks' weights are averaged, weighted by their tokens, in
two levels of groups.  Before the first round the outputs have the logarithms of the training counts as biases.  Scores
follow the partitions of the input: the same files and settings give the same weights.

Counts cover all training tokens and grow with the corpus: they are summed per task, shuffled by word and stay on Spark.
At most ``HEAD`` frequent words (chosen by a histogram of counts) are broadcast with their counts; occurrences of all
others are joined to the counts by word, after being summed per document.  A word that is not broadcast has at most about
one in ``HEAD`` of all tokens, so no join key is hot.  Words of more than ``KEY`` bytes are represented by a digest.

Defined cases: a null text is empty and has the end alone; a null ``doc_id`` is scored, not held out and never learnt
from; without training documents every count is zero and the network is untrained; repeated rows are each scored (and each
learnt from); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property
from itertools import islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticespark.llm.common import held_out, staged

HEAD, KEY = 65_536, 32
CLASSES, MEMBERS, TAILS = 32, 32, 32
WORDS = CLASSES * MEMBERS - 1
END = WORDS  # the end takes the last place of the last class
SYMBOLS = WORDS + 1 + TAILS
EMBED, HIDDEN, WINDOW, LANES = 16, 16, 32, 512
ROUNDS, EVERY, RATE, CLIP = 3, 1, 0.1, 1.0
_FLUSH, _BLOCK, _FAN, _ROWS = 300_000, 16_384, 32, 2_048

Weights = dict[str, np.ndarray]


# ------------------------------------------------------------------ tokens and counts

def _bytes(text: str | bytes | None) -> bytes:
    return text if isinstance(text, bytes) else (text or "").encode("utf-8", "replace")


def _key(word: bytes) -> bytes:
    return word if len(word) <= KEY else b"\xff" + hashlib.blake2b(word, digest_size=16).digest()


def tokens(text: str | bytes | None) -> list[bytes]:
    """Words of the text as keys: the bytes themselves, or a byte that no text has and a digest."""
    found = _bytes(text).lower().split()  # bytes: A-Z alone are lowered, ASCII spaces alone split
    if found and max(map(len, found)) > KEY:
        found = [*map(_key, found)]
    return found


def tail_of(key: bytes) -> int:
    return zlib.crc32(key[-3:]) % TAILS


def _learning(docs: DataFrame) -> DataFrame:
    train = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 7, 2)
    return docs.select("doc_id", "text", train.alias("train"))


def count_words(rows: DataFrame) -> DataFrame:
    """``key, n_train, n_held`` of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, held = Counter(), Counter()  # few documents are held out: their words are counted twice

        def out() -> Iterator[pa.RecordBatch]:
            if both:
                n, n_held = np.fromiter(both.values(), np.int64, len(both)), np.fromiter(map(held.get, both, repeat(0)), np.int64, len(both))
                yield pa.RecordBatch.from_arrays([pa.array([*both], pa.binary()), pa.array(n - n_held), pa.array(n_held)], ["key", "n_train", "n_held"])
            both.clear()
            held.clear()

        for b in batches:
            for text, learn in zip(b.column("text").to_pylist(), b.column("train").to_pylist()):
                found = tokens(text)
                both.update(found)
                if not learn:
                    held.update(found)
                if len(both) > _FLUSH:
                    yield from out()
        yield from out()

    found = rows.select(F.col("text").cast("binary").alias("text"), "train").mapInArrow(run, "key binary, n_train long, n_held long")
    return found.groupBy("key").agg(F.sum("n_train").alias("n_train"), F.sum("n_held").alias("n_held"))


_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz     ")
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of the first bytes of eight
_SHORT, _SLOTS, _PIECE = 15, 19, 1 << 16
_AFTER = np.array([(1 << 8 * min(max(n - 8, 0), 7)) - 1 for n in range(_SHORT + 2)], np.uint64)
_SIZE = np.arange(_SHORT + 2, dtype=np.uint64) << np.uint64(56)
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _packed(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word as two numbers, its first 8 bytes, then its next 7 and its length (16 if larger), and its slot among 2 ** ``_SLOTS``."""
    eight = np.ndarray((len(data) + 9,), "<u8", data + bytes(16), 0, (1,))  # the eight bytes from each place on
    size = np.minimum(ends - starts, _SHORT + 1)
    low = eight[starts]
    low &= _FIRST[np.minimum(size, 8)]
    high = eight[np.minimum(starts + 8, len(data))]
    high &= _AFTER[size]
    high |= _SIZE[size]
    mixed = high * _MIX[0]
    mixed ^= low
    mixed *= _MIX[1]
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MIX[1]
    mixed >>= np.uint64(64 - _SLOTS)
    return low, high, mixed.view(np.int64)


class Lookup:
    """Numbers of short words, for all words of a text at once: each slot has the first of its words of at most ``_SHORT`` bytes.

    Words are compared by all their bytes and their length; a word that is not found here may still be in the index.
    """

    def __init__(self, index: dict[bytes, int]):
        short = [(k, i) for k, i in index.items() if len(k) <= _SHORT]
        ends = np.cumsum([len(k) for k, _ in short], dtype=np.int64)
        starts = np.r_[np.int64(0), ends][:len(short)]
        low, high, slot = _packed(b"".join(k for k, _ in short), starts, ends)
        at, first = np.unique(slot, return_index=True)
        self.table = np.full(1 << _SLOTS, len(short), np.int32)  # a free slot leads to a word of no length, which no text has
        self.table[at] = first
        self.low, self.high = np.append(low, np.uint64(0)), np.append(high, np.uint64(0))
        self.number = np.array([i for _, i in short] + [-1], np.int32)

    def find(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word, -1 if its slot has another or none."""
        low, high, slot = _packed(data, starts, ends)
        at = self.table[slot]
        found = self.number[at]
        low ^= self.low[at]
        high ^= self.high[at]
        low |= high
        found[low != 0] = -1
        return found


def _pieces(data: bytes) -> Iterator[bytes]:
    """A lowered text with single-byte spaces in pieces that end between words."""
    first = 0
    while first < len(data):
        last = data.find(b" ", first + _PIECE)
        last = len(data) if last < 0 else last
        yield data[first:last]
        first = last


class Vocabulary:
    """The broadcast part of the counts: at most ``HEAD`` words; the first ``WORDS`` of them have network outputs."""

    def __init__(self, counts: DataFrame, n_docs: int):
        both = F.col("n_train") + F.col("n_held")
        band = F.floor(F.log2(both.cast("double")) * 16).cast("int")
        bands = sorted(counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)  # 16 a power of two
        least, total = 1 << 20, 0
        for r in bands:
            total += r["n"]
            if total > HEAD:
                break
            least = r["band"]
        head = counts.where(band >= least).toPandas()  # at most HEAD keys of at most KEY + 1 bytes
        rows = sorted(zip(head["n_train"], map(bytes, head["key"])), key=lambda r: (-r[0], r[1]))
        self.index = {k: i for i, (_, k) in enumerate(rows)}
        self.lookup  # made here, so that it is broadcast
        self.n = np.array([n for n, _ in rows], np.int64)
        own = rows[:WORDS]
        tail = F.crc32(F.substring("key", -3, 3)) % TAILS
        per_tail = counts.where("n_train > 0").groupBy(tail.alias("tail")).agg(F.sum("n_train").alias("n"), F.count(F.lit(1)).alias("v")).collect()
        n, v = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
        for r in per_tail:
            n[r["tail"]], v[r["tail"]] = r["n"], r["v"]
        self.n_end = n_docs
        self.n_tokens = int(n.sum()) + n_docs
        self.n_words = int(v.sum()) + (n_docs > 0)
        for k, key in own:
            if k:
                n[tail_of(key)] -= k
                v[tail_of(key)] -= 1
        self.tail_n, self.tail_log = n, np.log10(n + v + 1.0)
        self.log = np.log10(self.n + 1.0)
        own_output = [n > 0 and i < WORDS for i, (n, _) in enumerate(rows)]
        self.symbol = np.array([i if own else WORDS + 1 + tail_of(k) for i, (own, (_, k)) in enumerate(zip(own_output, rows))] or [0], np.int32)

    @cached_property
    def lookup(self) -> Lookup:
        return Lookup(self.index)

    def biases(self) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms of the shares of the words in their classes and of all classes, by training counts."""
        n = np.full(WORDS + 1, 1e-6)
        own = self.n[:WORDS]
        n[:len(own)] = np.maximum(own, 1e-6)
        n[END] = max(self.n_end, 1e-6)
        of_class = np.r_[n.reshape(CLASSES, MEMBERS).sum(1), np.maximum(self.tail_n, 0.5)]
        return np.log(n / np.repeat(of_class[:CLASSES], MEMBERS)), np.log(of_class / of_class.sum())

    def read(self, text: str | None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Symbols of the tokens (the end last), numbers of the head words, the keys of the other words."""
        return next(self.reads([text]))

    def reads(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
        """``read`` of each text; short texts are looked up together."""
        some, size = [], 0
        for text in texts:
            data = _bytes(text).translate(_PLAIN)
            if some and size + len(data) > _PIECE:
                yield from self._together(some)
                some, size = [], 0
            some.append(data)
            size += len(data)
        if some:
            yield from self._together(some)

    def _together(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
        numbers, places, rare, base = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [], 0
        for piece in _pieces(b" ".join(texts)):
            gap = np.ones(len(piece) + 2, bool)
            np.equal(np.frombuffer(piece, np.uint8), 32, out=gap[1:-1])
            borders = np.flatnonzero(gap[1:] != gap[:-1])
            starts, ends = borders[::2], borders[1::2]
            at = self.lookup.find(piece, starts, ends)
            left = np.flatnonzero(at < 0)
            keys = [piece[start:end] for start, end in zip(starts[left].tolist(), ends[left].tolist())]
            if keys and max(map(len, keys)) > KEY:
                keys = [*map(_key, keys)]
            at[left] = again = [*map(self.index.get, keys, repeat(-1))]
            rare += [k for k, i in zip(keys, again) if i < 0]
            numbers.append(at)
            places.append(starts + base)
            base += len(piece)
        at = np.concatenate(numbers)
        symbols = self.symbol[np.maximum(at, 0)]
        others = np.flatnonzero(at < 0)
        symbols[others] = [tail_of(t) for t in rare]
        symbols[others] += WORDS + 1
        # Where each text ends, among all words and among those that are not in the head.
        cuts = np.searchsorted(np.concatenate(places), np.cumsum([len(t) + 1 for t in texts]))
        first = first_rare = 0
        for last, last_rare in zip(cuts.tolist(), np.searchsorted(others, cuts).tolist()):
            own = at[first:last]
            yield np.append(symbols[first:last], np.int32(END)), own[own >= 0], rare[first_rare:last_rare]
            first, first_rare = last, last_rare

    def stretches(self, text: str | None) -> Iterator[np.ndarray]:
        """Symbols of every window of the text with the window before it and the token before both.

        A stretch whose window is the first of the text has no window before it: it begins with the end of the text before.
        """
        return self.all_stretches([text])

    def all_stretches(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        for own, *_ in self.reads(texts):
            symbols = np.append(np.int32(END), own)
            for first in range(0, len(symbols) - 1, EVERY * WINDOW):
                yield symbols[max(0, first - WINDOW):first + WINDOW + 1]


# ------------------------------------------------------------------ the network

def initial(vocabulary: Vocabulary) -> Weights:
    rng = np.random.default_rng(13)

    def normal(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.1).astype(np.float32)

    of_word, of_class = vocabulary.biases()
    return {
        "embed": normal(SYMBOLS, EMBED) * 3, "input": normal(EMBED, 3 * HIDDEN) * 3, "gate": np.zeros(3 * HIDDEN, np.float32), "carry": normal(HIDDEN, 3 * HIDDEN) * 2,
        "class": np.zeros((HIDDEN, CLASSES + TAILS), np.float32), "class_bias": of_class.astype(np.float32),
        "word": np.zeros((CLASSES, HIDDEN, MEMBERS), np.float32), "word_bias": of_word.reshape(CLASSES, MEMBERS).astype(np.float32),
    }


def _logistic(a: np.ndarray, scale: float) -> None:
    """1 / (1 + exp(scale a)) in place; where the exponential is too large it is zero."""
    a *= scale
    np.exp(a, out=a)
    a += 1
    np.reciprocal(a, out=a)


@np.errstate(over="ignore")
def recur(w: Weights, ids: np.ndarray, h: np.ndarray, keep: bool = False):
    """States (steps + 1, hidden, lanes) from state ``h`` (hidden, lanes) on; with ``keep`` also what the way back needs."""
    steps, lanes = ids.shape
    read = (w["embed"] @ w["input"] + w["gate"]).T.copy()  # what each symbol adds to the gates
    carry = w["carry"].T.copy()
    states = np.empty((steps + 1, HIDDEN, lanes), read.dtype)
    states[0] = h
    ids = ids.astype(np.intp)
    # All steps write to the same memory unless they are kept: fresh pages for every step took longer than the arithmetic.
    gates, sums = (np.empty((steps if keep else 1, 3 * HIDDEN, lanes), read.dtype) for _ in range(2))
    kept = []
    for t in range(steps):
        h, x, u = states[t], gates[t if keep else 0], sums[t if keep else 0]
        np.matmul(carry, h, out=u)
        read.take(ids[t], axis=1, out=x, mode="clip")  # symbols are below SYMBOLS
        s, n = x[:2 * HIDDEN], x[2 * HIDDEN:]
        s += u[:2 * HIDDEN]
        _logistic(s, -1)
        z, r = s[:HIDDEN], s[HIDDEN:]
        out = states[t + 1]
        np.multiply(r, u[2 * HIDDEN:], out=out)
        n += out
        _logistic(n, -2)  # the hyperbolic tangent of n is 2 logistic(2 n) - 1
        n *= 2
        n -= 1
        np.subtract(h, n, out=out)
        out *= z
        out += n
        if keep:
            kept.append((z, r, n, u[2 * HIDDEN:]))
    return states, kept


def rows_of(states: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """States after the valid tokens, one row each."""
    return states[1:].transpose(0, 2, 1)[valid]


def _soft(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, at: np.ndarray, rows: np.ndarray, soft: bool, room: np.ndarray):
    """Log-probability of entry ``at`` of each row's softmax; with ``soft`` the probabilities as well (in ``room``)."""
    a = np.matmul(h, weights, out=room[:len(h) * weights.shape[1]].reshape(len(h), -1))
    a += bias
    out = a[rows, at]
    with np.errstate(over="ignore"):
        e = np.exp(a, out=a)
    total = e @ np.ones(a.shape[1], e.dtype)
    if not np.isfinite(total).all() or not total.all():  # too large or small for exponentials: take the largest off first
        a = (h @ weights).astype(np.float64) + bias
        a -= a.max(1, keepdims=True)
        out, e = a[rows, at], np.exp(a)
        total = e.sum(1)
    if soft:
        e *= (1 / total)[:, None]
    return out - np.log(total), e.astype(room.dtype, copy=False)


def outputs(w: Weights, h: np.ndarray, target: np.ndarray, grads: Weights | None = None):
    """Log-probability (natural) of each target after state ``h``; with ``grads`` also the gradient of the loss by ``h``."""
    learn = grads is not None
    of_class = np.where(target <= END, target // MEMBERS, target - (WORDS + 1) + CLASSES).astype(np.int16)
    order = np.argsort(of_class, kind="stable")  # rows of a class follow each other
    h, of_class, member = h.take(order, axis=0), of_class[order], target[order] % MEMBERS
    room = np.empty(min(len(target), _ROWS) * (CLASSES + TAILS), h.dtype)
    ones = np.ones(len(target), h.dtype)
    rows = np.arange(len(target))
    found, back = np.empty(len(target), h.dtype), None
    if learn:
        back = np.empty_like(h)
        grads["class"], grads["class_bias"] = np.zeros_like(w["class"]), np.zeros_like(w["class_bias"])
        grads["word"], grads["word_bias"] = {}, {}

    def add(first: int, last: int, weights: np.ndarray, bias: np.ndarray, at: np.ndarray, fresh: bool):
        """Adds (or sets, if ``fresh``) what one softmax gives rows ``first`` to ``last``; gradients by weights and bias."""
        some, spot = h[first:last], rows[:last - first]
        more, soft = _soft(some, weights, bias, at, spot, learn, room)
        found[first:last] = more if fresh else found[first:last] + more
        if not learn:
            return None
        soft[spot, at] -= 1
        if fresh:
            np.matmul(soft, weights.T, out=back[first:last])
        else:
            back[first:last] += soft @ weights.T
        return some.T @ soft, ones[:last - first] @ soft

    for first in range(0, len(target), _ROWS):  # blocks that stay in the cache
        last = min(len(target), first + _ROWS)
        got = add(first, last, w["class"], w["class_bias"], of_class[first:last], True)
        if learn:
            grads["class"] += got[0]
            grads["class_bias"] += got[1]
    ends = np.searchsorted(of_class, np.arange(CLASSES + 1, dtype=np.int16)).tolist()
    for c, (start, end) in enumerate(zip(ends, ends[1:])):
        for first in range(start, end, _ROWS):
            last = min(end, first + _ROWS)
            got = add(first, last, w["word"][c], w["word_bias"][c], member[first:last], False)
            if learn:
                grads["word"][c] = grads["word"][c] + got[0] if c in grads["word"] else got[0]
                grads["word_bias"][c] = grads["word_bias"][c] + got[1] if c in grads["word_bias"] else got[1]
    out = np.empty_like(found)
    out[order] = found
    if learn:
        unsorted = np.empty_like(back)
        unsorted[order] = back
        back = unsorted
    return out, back


class Trainer:
    """AdaGrad steps on single windows (truncated backpropagation)."""

    def __init__(self, weights: Weights):
        self.w = {k: v.copy() for k, v in weights.items()}
        self.seen = {k: np.full(v.shape, 0.1, np.float32) for k, v in weights.items()}

    def _update(self, name: str, at, grad: np.ndarray) -> None:
        seen = self.seen[name]
        seen[at] += grad * grad
        self.w[name][at] -= RATE * grad / np.sqrt(seen[at])

    def window(self, ids: np.ndarray, target: np.ndarray, valid: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        w, (steps, lanes) = self.w, ids.shape
        states, kept = recur(w, ids, h, keep=True)
        grads: Weights = {}
        out, back = outputs(w, rows_of(states, valid), target[valid], grads)
        d_out = np.zeros((steps, lanes, HIDDEN), np.float32)
        d_out[valid] = back
        dx = np.empty((3 * HIDDEN, steps, lanes), np.float32)
        d_carry = np.zeros_like(w["carry"])
        dh = np.zeros((HIDDEN, lanes), np.float32)
        du = np.empty((3 * HIDDEN, lanes), np.float32)
        for t in range(steps - 1, -1, -1):
            z, r, n, u = kept[t]
            dh += d_out[t].T
            rest = 1 - z
            np.multiply(dh, rest, out=du[2 * HIDDEN:])
            du[2 * HIDDEN:] *= 1 - n * n
            np.subtract(states[t], n, out=du[:HIDDEN])
            du[:HIDDEN] *= dh
            du[:HIDDEN] *= z
            du[:HIDDEN] *= rest
            np.multiply(du[2 * HIDDEN:], u, out=du[HIDDEN:2 * HIDDEN])
            du[HIDDEN:2 * HIDDEN] *= r
            du[HIDDEN:2 * HIDDEN] *= 1 - r
            dx[:, t] = du
            du[2 * HIDDEN:] *= r
            d_carry += states[t] @ du.T
            dh *= z
            dh += w["carry"] @ du
        scale = 1.0 / max(1, int(valid.sum()))
        flat = dx.reshape(3 * HIDDEN, -1)
        symbols = ids.ravel()
        order = np.argsort(symbols.astype(np.int16), kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(symbols[order]) != 0])
        d_embed = np.add.reduceat((w["input"] @ flat).T.copy().take(order, axis=0), starts)
        d_input = w["embed"].take(symbols, axis=0).T @ flat.T
        lift = math.sqrt(1 / scale)  # rows that few tokens touch have small mean gradients
        for c, g in grads["word"].items():
            self._update("word", c, np.clip(g * scale * lift, -CLIP, CLIP))
            self._update("word_bias", c, np.clip(grads["word_bias"][c] * scale * lift, -CLIP, CLIP))
        for name, at, g in (("class", slice(None), grads["class"]), ("class_bias", slice(None), grads["class_bias"]), ("carry", slice(None), d_carry),
                            ("input", slice(None), d_input), ("gate", slice(None), flat.sum(1)), ("embed", symbols[order][starts], d_embed)):
            self._update(name, at, np.clip(g * scale * lift, -CLIP, CLIP))
        return states[-1], float(out.sum())

    def step(self, stretches: list[np.ndarray]) -> int:
        """Learn from the last window of each stretch, after the state has run through the window before it."""
        size = np.array([len(x) - 1 for x in stretches])
        lead = np.where(size > WINDOW, WINDOW, 0)   # a text's first window has none before it
        before = np.full((WINDOW, len(stretches)), END, np.int32)
        both = np.full((WINDOW + 1, len(stretches)), END, np.int32)
        for k, (x, n) in enumerate(zip(stretches, lead)):
            before[:n, k] = x[:n]
            both[:len(x) - n, k] = x[n:]
        state = recur(self.w, before, np.zeros((HIDDEN, len(stretches)), np.float32))[0][-1]
        state[:, lead == 0] = 0
        valid = np.arange(WINDOW)[:, None] < size - lead
        self.window(both[:-1], both[1:], valid, state)
        return int(valid.sum())


def windows(docs: Iterator[tuple], done: Callable) -> Iterator[tuple]:
    """Deal documents ``(name, symbols)`` to lanes and yield ``ids, target, valid, state, lanes`` window by window.

    The consumer sends back the state after the window and the log-probabilities (steps, lanes); ``done(name, sum)``
    is called for a finished document.  A lane takes the next document when its own is finished, from a zero state.
    """
    names, seqs, pos, sums = [], [], [], np.zeros(0)
    state = np.zeros((HIDDEN, 0), np.float32)
    docs = iter(docs)
    more = True
    while True:
        while more and len(names) < LANES:
            new = next(docs, None)
            if new is None:
                more = False
                break
            names.append(new[0])
            seqs.append(np.r_[np.int32(END), new[1]])  # the end of the text before is read first
            pos.append(0)
        if not names:
            return
        fresh = len(names) - state.shape[1]
        if fresh:
            state = np.concatenate([state, np.zeros((HIDDEN, fresh), np.float32)], axis=1)
            sums = np.r_[sums, np.zeros(fresh)]
        left = np.array([len(s) - 1 - p for s, p in zip(seqs, pos)])
        # Few documents that are left read on until the shortest ends, in no more memory than a window of all lanes.
        width = max(WINDOW, min(int(left.min()), WINDOW * LANES // len(names)))
        size = np.minimum(left, width)
        steps = int(size.max())
        both = np.full((len(names), steps + 1), END, np.int32)
        for k, (s, p, n) in enumerate(zip(seqs, pos, size)):
            both[k, :n + 1] = s[p:p + n + 1]
            pos[k] = p + int(n)
        valid = (np.arange(steps)[:, None] < size)
        state, gained = yield both[:, :-1].T, both[:, 1:].T, valid, state
        sums += gained
        stay = left > width
        if not stay.all():
            for k in np.flatnonzero(~stay):
                done(names[k], sums[k])
            keep = np.flatnonzero(stay)
            names, seqs, pos = [names[k] for k in keep], [seqs[k] for k in keep], [pos[k] for k in keep]
            state, sums = state[:, keep], sums[keep]


# ------------------------------------------------------------------ training on Spark

def _flat(w: Weights) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def _shaped(flat: np.ndarray, like: Weights) -> Weights:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def train(rows: DataFrame, vocabulary: Vocabulary) -> Weights:
    """Weights after all rounds; each round's weights are an average of at most ``_BLOCK`` numbers a row."""
    spark = rows.sparkSession
    weights = initial(vocabulary)
    schema = "block int, fan int, weight double, value array<double>"
    shared_words = spark.sparkContext.broadcast(vocabulary)  # at most HEAD words
    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast(weights)  # a fixed number of weights

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            vocabulary, trainer, trained = shared_words.value, Trainer(shared.value), 0
            found = (x for b in batches for x in vocabulary.all_stretches(b["text"]))
            while some := [*islice(found, LANES)]:
                trained += trainer.step(some)
            if trained:
                flat = _flat(trainer.w).astype(np.float64) * trained
                parts = range(0, len(flat), _BLOCK)
                fan = TaskContext.get().partitionId() % _FAN
                yield pd.DataFrame({"block": range(len(parts)), "fan": fan, "weight": float(trained), "value": [flat[p:p + _BLOCK] for p in parts]})

        def add(group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"block": group["block"].iloc[:1], "fan": 0, "weight": group["weight"].sum(), "value": [np.sum(np.stack(group["value"]), axis=0)]})

        some = rows.where(F.col("train") & (F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(ROUNDS)) == number)).select("text")
        sums = some.mapInPandas(run, schema).groupBy("block", "fan").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema)
        parts = sums.toPandas().sort_values("block")  # as many numbers as the network has weights
        if len(parts):
            weights = _shaped(np.concatenate([np.asarray(v) / n for v, n in zip(parts["value"], parts["weight"])]), weights)
        shared.unpersist()
    return weights


# ------------------------------------------------------------------ scoring on Spark

_PARTS = "row long, doc_id long, n_tokens long, n_known long, base double, score double, rare array<binary>, times array<int>"


def _parts(rows: DataFrame, vocabulary: Vocabulary, weights: Weights) -> DataFrame:
    """Per document what the broadcast words give, and its other words with their number."""
    shared = rows.sparkSession.sparkContext.broadcast((vocabulary, weights))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, w = shared.value
        out: list[tuple] = []
        first = TaskContext.get().partitionId() << 33
        end = (math.log10(vocabulary.n_end + 1.0), int(vocabulary.n_end > 0))

        def docs() -> Iterator[tuple]:
            number = first
            for b in batches:
                for doc_id, (symbols, head, rare) in zip(b["doc_id"], vocabulary.reads(b["text"])):
                    tails = symbols[symbols > END] - (END + 1)
                    log = vocabulary.log[head]
                    score = log[vocabulary.symbol[head] > END].sum() - vocabulary.tail_log[tails].sum()
                    known = int((vocabulary.n[head] > 0).sum()) + end[1]
                    times = Counter(rare)
                    yield (number, doc_id, len(symbols), known, log.sum() + end[0], score, [*times], [*times.values()]), symbols
                    number += 1

        def done(name: tuple, total: float) -> None:
            out.append((*name[:5], name[5] + total, *name[6:]))

        def frame() -> pd.DataFrame:
            made = pd.DataFrame(out, columns=[c.strip().split(" ")[0] for c in _PARTS.split(", ")])
            made["doc_id"] = made["doc_id"].astype("Int64")
            out.clear()
            return made

        feed = windows(docs(), done)
        made = next(feed, None)
        while made is not None:
            ids, target, valid, state = made
            states = recur(w, ids, state)[0]
            gained = np.zeros(ids.shape)
            gained[valid] = outputs(w, rows_of(states, valid), target[valid])[0]
            try:
                made = feed.send((states[-1], gained.sum(0) / math.log(10)))
            except StopIteration:
                made = None
            if len(out) >= 1_000:
                yield frame()
        if out:
            yield frame()

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, _PARTS)


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    rows = _learning(docs)
    counts = staged(count_words(rows), "word_counts")
    vocabulary = Vocabulary(counts, rows.where("train").count())
    weights = train(rows, vocabulary)
    parts = staged(_parts(rows, vocabulary, weights), "scored_parts")
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("key"), F.col("r.times").alias("times"))
    known = counts.where("n_train > 0").select("key", "n_train")
    more = rare.join(known, "key").groupBy("row").agg(F.sum("times").alias("_known"), F.sum(F.col("times") * F.log10(F.col("n_train") + 1.0)).alias("_log"))
    log = F.coalesce("_log", F.lit(0.0))
    base = F.col("base") + log - F.col("n_tokens") * F.log10(F.lit(vocabulary.n_tokens + vocabulary.n_words + 1.0))
    return parts.join(more, "row", "left").select(
        "doc_id", held_out(F.col("doc_id"), 7, 2).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.n_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + log).alias("score"))
