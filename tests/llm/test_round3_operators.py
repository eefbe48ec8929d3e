"""Spelling variants, conversation repair and language-model scoring against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from noticespark.llm import conversation_repair as CR
from noticespark.llm import gru_language_model as LM
from noticespark.llm import queries as Q
from noticespark.llm import spelling_variants as SV

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ spelling variants

def plain_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def plain_variants(rows):
    words = plain_words(rows)
    gaps = defaultdict(set)   # a word with one letter taken out or blanked: near words share one
    for w in words:
        for i in range(len(w)):
            gaps["-", w[:i] + w[i + 1:]].add(w)
            gaps["*", w[:i] + "*" + w[i + 1:]].add(w)
        gaps["-", w].add(w)
    near = defaultdict(set)
    for (kind, key), group in gaps.items():
        for a, b in itertools.permutations(group, 2):
            if kind == "*" or key in (a, b):
                near[a].add(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]]))
    return out


def test_spelling_variants_equal_all_pairs(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    expected = plain_variants(rows)
    assert {tuple(r) for r in Q.op11_spelling_variants(spark, SF).collect()} == expected
    assert any(r[1] for r in expected)
    monkeypatch.setattr(SV, "TILE", 7)  # hot blocks: many tiles of a few words
    monkeypatch.setattr(SV, "PACK", 5)
    assert {tuple(r) for r in Q.op11_spelling_variants(spark, SF).collect()} == expected


def test_spelling_variants_edge_cases(spark):
    schema = "doc_id long, text string, word string, n int"
    base = "Strasse straße " * 30 + "STRASSEN " * 2 + "stras×e strassé " * 3
    rows = [(1, base), (1, base), (None, "Strasse strasse \U0001f600strassx strassx"), (2, None), (3, ""), (4, "x" * 70_000 + " " + "x" * 70_000),
            (5, "y" + "x" * 69_999 + " y" + "x" * 69_999), (6, "İstrasse Kstrasse"), (7, "abcdefg bcdefgh abcdefg bcdefgh abcdefgh abcdefgh")]
    docs = spark.createDataFrame([(*r, "clash", 0) for r in rows], schema)
    assert {tuple(r) for r in SV.variants(docs).collect()} == plain_variants(rows)
    assert SV.variants(docs.limit(0)).collect() == []


# ------------------------------------------------------------------ conversation repair

def plain_report(rows, damage=True):
    """Every conversation by a search over all edit strings, as a plain dynamic programme over (row, last initial)."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else -1
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        convs[conv] += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    out = set()
    for conv, rows_ in convs.items():
        rows_.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in rows_:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
            seen.add((role, text))
        turns = [t for t, _, _ in rows_ if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows_, rows_[1:]))
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}
        ways = {"": (0, "", ())}

        def better(ways, key, new):
            if key not in ways or new < ways[key]:
                ways[key] = new

        def inserts(ways):
            for _ in range(4):
                for last, (cost, audit, turns_) in list(ways.items()):
                    for c in allowed[last]:
                        if c != "s":
                            better(ways, c, (cost + 2, audit + "I", (*turns_, (CR.ROLES[c], ""))))

        for (_, role, text), fault in zip(rows_, faults):
            inserts(ways)
            new = {}
            for last, (cost, audit, turns_) in ways.items():
                better(new, last, (cost + 3, audit + "D", turns_))
                if fault in ("b", "d"):
                    continue
                cost += fault == "t"
                for c in allowed[last]:
                    if role[:1] == c:
                        better(new, c, (cost, audit + "K", (*turns_, (role, text))))
                    if c != "s":
                        better(new, c, (cost + 2, audit + "R", (*turns_, (CR.ROLES[c], text))))
            ways = new
        inserts(ways)
        cost, audit, turns_ = min(ways[k] for k in ("", "a") if k in ways)
        hashed = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns_).encode()).hexdigest()
        out.add((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashed))
    return out


def test_conversation_repair_equals_plain_programme(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in Q.op12_conversation_repair(spark, SF).collect()} == plain_report(rows)


def _random_rows(seed, convs, longest):
    rnd = random.Random(seed)
    rows = []
    for conv in [*range(convs), None]:
        for _ in range(rnd.randint(0, longest)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rnd.choice(["", " \n", None, "Yes.", "No", "Why? \t", "x" * 300 + "!" + " " * 400, "énd…", str(rnd.random())])
            rows.append((conv, rnd.choice([None, *range(longest), *range(longest)]), role, text))
    return rows


def test_conversation_repair_edge_cases(spark):
    schema = "conv_id long, turn long, role string, text string, cost string, audit int"
    for seed in range(2):
        rows = _random_rows(seed, 60, 12)
        df = spark.createDataFrame([(*r, "clash", 1) for r in rows], schema)
        assert {tuple(r) for r in CR.report(df).collect()} == plain_report(rows)
        assert {tuple(r) for r in CR.report(df, damage=False).collect()} == plain_report(rows, damage=False)
    assert CR.report(df.limit(0)).collect() == []


def test_conversation_spread_over_parts(spark):
    """One conversation holds almost all rows: range parts cut it, the joined stretches equal the plain programme."""
    rows = [(1, t, *r) for t, (_, _, *r) in enumerate(_random_rows(5, 200, 12))] + _random_rows(6, 3, 8)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    narrow = CR._narrow(CR.damaged(df))
    assert CR._stretches(narrow).where("conv_id = 1").select("part").distinct().count() > 2
    assert {tuple(r) for r in CR.report(df).collect()} == plain_report(rows)


def test_repaired_turns_fit_the_grammar(spark):
    rows = _random_rows(9, 40, 10)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    audits = {r["conv_id"]: r for r in CR.report(df, damage=False).collect()}
    turns = defaultdict(list)
    for r in CR.repaired(df).orderBy("position").collect():
        turns[r["conv_id"]].append(r)
    for conv, r in audits.items():
        assert "".join(t["edit"] for t in turns[conv]) == r["audit"]
        kept = [t for t in turns[conv] if t["edit"] != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(t["role"][0] for t in kept))
        assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in kept).encode()).hexdigest() == r["repaired_sha256"]


# ------------------------------------------------------------------ language model

def plain_words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update(["", *plain_words_of(text)])  # "" stands for the end
    return counts


def plain_base(rows, counts, text):
    n, v = sum(counts.values()), len(counts)
    return sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in [*plain_words_of(text), ""])


def plain_score(w, vocabulary, counts, text):
    """The network one token at a time in double precision, the softmax over all classes and words written out."""
    w = {k: v.astype(float) for k, v in w.items()}
    hidden, total, h, before = LM.HIDDEN, 0.0, np.zeros(LM.HIDDEN), LM.END
    in_tail = Counter(), Counter()
    for t, n in counts.items():
        key = LM.tokens(t)[0] if t else None
        if t and not (key in vocabulary.index and vocabulary.symbol[vocabulary.index[key]] < LM.END):
            in_tail[0][LM.tail_of(key)] += n
            in_tail[1][LM.tail_of(key)] += 1
    for t in [*plain_words_of(text), ""]:
        x, u = w["embed"][before] @ w["input"] + w["gate"], h @ w["carry"]
        z, r = (1 / (1 + np.exp(-(x + u)[k * hidden:(k + 1) * hidden])) for k in (0, 1))
        n = np.tanh(x[2 * hidden:] + r * u[2 * hidden:])
        h = n + z * (h - n)
        a = h @ w["class"] + w["class_bias"]
        a -= a.max()
        p = np.exp(a) / np.exp(a).sum()
        key = LM.tokens(t)[0] if t else None
        at = LM.END if not t else vocabulary.index.get(key, -1)
        symbol = LM.END if not t else int(vocabulary.symbol[at]) if at >= 0 else LM.WORDS + 1 + LM.tail_of(key)
        if symbol <= LM.END:
            c = symbol // LM.MEMBERS
            b = h @ w["word"][c] + w["word_bias"][c]
            b -= b.max()
            total += math.log10(p[c]) + math.log10((np.exp(b) / np.exp(b).sum())[symbol % LM.MEMBERS])
        else:
            tail = symbol - LM.WORDS - 1
            total += math.log10(p[LM.CLASSES + tail]) + math.log10((counts[t] + 1) / (in_tail[0][tail] + in_tail[1][tail] + 1))
        before = symbol
    return total


def check_scores(spark, docs, rows, monkeypatch):
    made = {}
    train = LM.train
    monkeypatch.setattr(LM, "train", lambda r, v: made.setdefault("w", train(made.setdefault("rows", r), made.setdefault("v", v))))
    found = LM.score(docs).collect()
    counts = plain_counts(rows)
    expected = defaultdict(list)
    for doc_id, text in rows:
        words = [*plain_words_of(text), ""]
        expected[doc_id].append((len(words), sum(counts[t] > 0 for t in words), plain_base(rows, counts, text), plain_score(made["w"], made["v"], counts, text)))
    assert len(found) == len(rows)
    for r in found:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2
        assert (r["held_out"], r["train_tokens"]) == (held, sum(counts.values()))
        assert any((r["n_tokens"], r["n_known"]) == e[:2] and math.isclose(r["base_score"], e[2], rel_tol=1e-9, abs_tol=1e-9)
                   and math.isclose(r["score"], e[3], rel_tol=1e-4, abs_tol=1e-3) for e in expected[r["doc_id"]])
    return found


def test_language_model_equals_plain_network(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(LM, "HEAD", 6_000)  # some words are joined, some broadcast
    found = check_scores(spark, docs, [tuple(r) for r in docs.select("doc_id", "text").collect()], monkeypatch)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_edge_cases(spark, monkeypatch):
    rows = [(1, None), (2, ""), (2, "Ärger ÄRGER a A\tb\x0bc \u00a0 d"), (2, "Ärger ÄRGER a A\tb\x0bc \u00a0 d"), (None, "a b c unseen"), (9, "x" * 5_000 + " a " * 3_000),
            (10, "y" * 70 + " " + "y" * 71), (14, "b b"), (3, "b \U0001f600"), (4, "b b b c")]
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, row int, key string")
    check_scores(spark, docs, rows, monkeypatch)
    monkeypatch.setattr(LM, "HEAD", 0)
    monkeypatch.undo()
    assert LM.score(docs.limit(0)).collect() == []
    untrained = LM.score(docs.where("doc_id is null")).collect()
    assert [(r["train_tokens"], r["n_known"], r["n_tokens"]) for r in untrained] == [(0, 0, 5)]
    assert untrained[0]["base_score"] == 0.0


def test_language_model_gradient(monkeypatch):
    """Truncated backpropagation against finite differences, in double precision."""
    rng = np.random.default_rng(3)
    w = {"embed": (LM.SYMBOLS, LM.EMBED), "input": (LM.EMBED, 3 * LM.HIDDEN), "gate": (3 * LM.HIDDEN,), "carry": (LM.HIDDEN, 3 * LM.HIDDEN), "class": (LM.HIDDEN, LM.CLASSES + LM.TAILS),
         "class_bias": (LM.CLASSES + LM.TAILS,), "word": (LM.CLASSES, LM.HIDDEN, LM.MEMBERS), "word_bias": (LM.CLASSES, LM.MEMBERS)}
    w = {k: (rng.standard_normal(s) * 0.5).astype(np.float32) for k, s in w.items()}
    ids, target = rng.integers(0, LM.SYMBOLS, (5, 3)), rng.integers(0, LM.SYMBOLS, (5, 3))
    valid = np.array([[1, 1, 1]] * 3 + [[1, 0, 1]] * 2, bool)
    h = rng.standard_normal((LM.HIDDEN, 3)).astype(np.float32)
    grads = {}
    monkeypatch.setattr(LM, "CLIP", 1e9)
    monkeypatch.setattr(LM.Trainer, "_update", lambda self, name, at, g: grads.setdefault(name, []).append((at, g / math.sqrt(1 / valid.sum()))))
    LM.Trainer(w).window(ids, target, valid, h)

    def loss(w):
        return -LM.outputs(w, LM.rows_of(LM.recur(w, ids, h)[0], valid), target[valid])[0].sum()

    for name, parts in grads.items():
        whole = np.zeros_like(w[name])
        for at, g in parts:
            whole[at] += g
        step = (rng.standard_normal(w[name].shape) * 1e-2).astype(np.float32)
        up, down = loss({**w, name: w[name] + step}), loss({**w, name: w[name] - step})
        assert (up - down) / 2 == pytest.approx(float((whole * step).sum()), rel=0.05, abs=2e-3), name


def test_language_model_stretches(monkeypatch):
    """Every chosen window with the window before it; a text's end is learnt where its window is chosen."""
    voc = LM.Vocabulary.__new__(LM.Vocabulary)
    voc.index = {str(i).encode(): i for i in range(1_000)}
    voc.symbol = np.arange(1_000, dtype=np.int32)
    for n in (0, 1, 31, 32, 33, 64, 191, 192, 193, 900):
        whole = [LM.END, *range(n), LM.END]
        found = [x.tolist() for x in voc.stretches(" ".join(map(str, range(n))))]
        first = 0 if n < LM.EVERY * LM.WINDOW else LM.zlib.crc32(b"0" + str(n - 1).encode()) % LM.EVERY
        chosen = range(first, n // LM.WINDOW + 1, LM.EVERY)
        assert found == [whole[max(0, k - 1) * LM.WINDOW:(k + 1) * LM.WINDOW + 1] for k in chosen]


def test_language_model_learns_from_every_token():
    """Each token of a text, its end included, is the target of one learnt window."""
    voc = LM.Vocabulary.__new__(LM.Vocabulary)
    voc.index = {str(i).encode(): i for i in range(1_000)}
    voc.symbol = np.arange(1_000, dtype=np.int32)
    for n in (0, 31, 32, 255, 256, 300, 900):
        learnt = [t for x in voc.stretches(" ".join(map(str, range(n)))) for t in x[LM.WINDOW + 1 if len(x) - 1 > LM.WINDOW else 1:].tolist()]
        assert learnt == [*range(n), LM.END]
