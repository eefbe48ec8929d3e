"""op13: long documents at the end of a task take few calls, softmax rows are read in blocks, results stay as they are."""

import numpy as np
import pytest
from noticespark.llm import gru_language_model as LM


def _weights(rng):
    shapes = {"embed": (LM.SYMBOLS, LM.EMBED), "input": (LM.EMBED, 3 * LM.HIDDEN), "gate": (3 * LM.HIDDEN,), "carry": (LM.HIDDEN, 3 * LM.HIDDEN),
              "class": (LM.HIDDEN, LM.CLASSES + LM.TAILS), "class_bias": (LM.CLASSES + LM.TAILS,), "word": (LM.CLASSES, LM.HIDDEN, LM.MEMBERS), "word_bias": (LM.CLASSES, LM.MEMBERS)}
    return {k: (rng.standard_normal(s) * 0.3).astype(np.float32) for k, s in shapes.items()}


def _scored(w, docs):
    sums, calls, most = {}, 0, 0
    feed = LM.windows(iter(docs), sums.__setitem__)
    made = next(feed, None)
    while made is not None:
        ids, target, valid, state = made
        calls, most = calls + 1, max(most, ids.size)
        states = LM.recur(w, ids, state)[0]
        gained = np.zeros(ids.shape)
        gained[valid] = LM.outputs(w, LM.rows_of(states, valid), target[valid])[0]
        try:
            made = feed.send((states[-1], gained.sum(0)))
        except StopIteration:
            made = None
    return sums, calls, most


def test_language_model_reads_long_documents_in_few_calls():
    rng = np.random.default_rng(5)
    w = _weights(rng)
    docs = [(i, np.r_[rng.integers(0, LM.SYMBOLS, n), LM.END].astype(np.int32)) for i, n in enumerate((0, 5, 31, 32, 700, 9_000, 20_000))]
    sums, calls, most = _scored(w, docs)
    assert calls <= 12 and most <= LM.WINDOW * LM.LANES   # 626 calls in windows of 32 tokens
    for name, symbols in docs:
        ids = np.r_[np.int32(LM.END), symbols[:-1]][:, None]
        states = LM.recur(w, ids, np.zeros((LM.HIDDEN, 1), np.float32))[0]
        alone = sum(float(LM.outputs(w, states[t + 1].T, symbols[t:t + 1])[0][0]) for t in range(min(len(symbols), 800)))
        if len(symbols) <= 800:
            assert sums[name] == pytest.approx(alone, rel=1e-4)
    assert set(sums) == {n for n, _ in docs}


def test_language_model_blocks_of_rows(monkeypatch):
    """Blocks of any size give the same log-probabilities and gradients."""
    rng = np.random.default_rng(6)
    w, h, target = _weights(rng), rng.standard_normal((700, LM.HIDDEN)).astype(np.float32), rng.integers(0, LM.SYMBOLS, 700)
    found = []
    for rows in (1 << 20, 64, 7):
        monkeypatch.setattr(LM, "_ROWS", rows)
        grads = {}
        found.append((*LM.outputs(w, h, target, grads), grads))
    for out, back, grads in found[1:]:
        assert np.allclose(out, found[0][0], atol=1e-4) and np.allclose(back, found[0][1], atol=1e-4)
        for name in ("class", "class_bias"):
            assert np.allclose(grads[name], found[0][2][name], atol=1e-3)
        for name in ("word", "word_bias"):
            assert all(np.allclose(grads[name][c], found[0][2][name][c], atol=1e-3) for c in found[0][2][name])


def test_language_model_looks_up_the_words_of_many_texts_at_once():
    known = ["end", "of", "a", "a\x00", "fifteenletters1", "sixteenletters12", "é" * 8, "w" * 40, *(f"word{i}" for i in range(3_000))]
    keys = [LM.tokens(w)[0] for w in known]
    vocabulary = LM.Vocabulary.__new__(LM.Vocabulary)
    vocabulary.index = {k: i for i, k in enumerate(keys)}
    vocabulary.lookup, vocabulary.symbol = LM.Lookup(vocabulary.index), np.arange(len(keys), dtype=np.int32) % LM.END
    texts = ["", None, " ", "The END\tof\n a\x00 A", "W" * 40 + " \x0b" + "v" * 40, "É" * 8 + " é" + " of a", "of " * 60_000 + "WORD2999",
             " ".join(known), "x" * 200_000 + " a", "", " ".join(f"word{i} other{i}" for i in range(3_000))]
    read = [*vocabulary.reads(texts)]
    assert len(read) == len(texts)
    for text, (symbols, head, rare) in zip(texts, read):
        found = LM.tokens(text)
        at = [vocabulary.index.get(k, -1) for k in found]
        assert rare == [k for k, i in zip(found, at) if i < 0] and head.tolist() == [i for i in at if i >= 0]
        assert symbols.tolist() == [i % LM.END if i >= 0 else LM.WORDS + 1 + LM.tail_of(k) for k, i in zip(found, at)] + [LM.END]
