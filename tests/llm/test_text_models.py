"""Classifier, toxicity, language and tokenizer operators: held-out accuracy, brute force and edge cases."""

import random

import numpy as np
import pytest

from noticespark.llm import language_id, quality_classifier, sentencepiece_codec, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def edge_docs(spark):
    rows = [(None, "some text"), (5, None), (6, ""), (6, ""), (7, " \n"), (8, "word " * 60_000), (9, "漢字 😀")]
    return spark.createDataFrame([(i, t, "en", "s", 1.0, 1) for i, t in rows], "doc_id long, text string, lang string, source string, score double, turn int")


def accuracy(out, labels, column):
    both = out.join(labels, "doc_id").where(f"held_out and {column} is not null").select("predicted", column).collect()
    return np.mean([r.predicted == r[column] for r in both]), len(both)


def test_quality_on_held_out_rows(spark, tables):
    docs, labels = tables
    out = quality_classifier.classify(docs, labels)
    share, n = accuracy(out, labels, "quality")
    assert n > 50 and share >= 0.93
    assert out.count() == docs.count() and out.where("score < 0 or score > 1 or score is null").count() == 0


def test_quality_edges(spark, tables):
    docs = edge_docs(spark)
    out = quality_classifier.classify(docs, tables[1])
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == 7
    none = quality_classifier.classify(docs, tables[1].limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {0}
    assert quality_classifier.classify(docs.limit(0), tables[1]).count() == 0


def test_scores_do_not_depend_on_other_columns(spark, tables):
    docs, labels = tables
    a = {r.doc_id: r.score for r in quality_classifier.classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality_classifier.classify(docs.drop("lang", "source"), labels).collect()}
    assert a == pytest.approx(b)


def test_ftrl_learns_a_separable_set():
    index, value = [np.array([1]), np.array([2])] * 200, [np.ones(1)] * 400
    w = quality_classifier.ftrl(index, value, np.array([1.0, 0.0] * 200))
    assert w[1] + w[-1] > 2 and w[2] + w[-1] < -2


def test_toxicity_on_held_out_rows(spark, tables):
    docs, labels = tables
    out = toxicity.classify(docs, labels)
    share, n = accuracy(out, labels, "toxic")
    assert n > 50 and share >= 0.95
    clean = out.join(labels, "doc_id").where("toxic = 0").agg({"predicted": "avg"}).first()[0]
    assert clean <= 0.01


def test_toxicity_grammar_reads_clauses():
    grammar = toxicity.Grammar({"idiot": 4.0, "blath*": 3.0})
    at = lambda text, name: toxicity.PATTERNS.index(name) is not None and grammar.features(text)[toxicity.PATTERNS.index(name)]
    assert at("what an idiot", "bare") > 0 and at("what an idiot", "targeted") == 0
    assert at("you are an idiot", "targeted") > 0 and at("you are an idiot", "bare") == 0
    assert at("an idiot like you", "targeted") > 0 and at("an idiot like you", "bare") == pytest.approx(0)
    assert at("you are not an idiot", "negated") > 0 and at("you are not an idiot", "targeted") == 0
    assert at("the report said idiot", "reported") > 0
    assert at("I will kill you", "aimed threat") > 0 and at("you, I kill", "aimed threat") > 0  # a target may follow
    assert at("not here. you idiot", "targeted") > 0  # the negation is in another clause
    assert at("blathering blather", "bare") > 0 and at("idiotic", "bare") == 0
    assert at("they kill time", "aimed threat") > 0 and at("kill time", "threat") > 0 and at("I will not kill you", "negated") > 0
    assert not grammar.features("nothing to see").any() and not grammar.features(None).any()


def plain_patterns(marks, weights):
    """The grammar's rules read at each word on its own, without states."""
    out = dict.fromkeys(toxicity.PATTERNS, 0.0)
    near = lambda at, mark, ahead: any(m == mark for m in marks[max(0, at - toxicity.REACH) : at + 1 + ahead])
    for at, (mark, w) in enumerate(zip(marks, weights)):
        if mark not in ("insult", "threat word"):
            continue
        aimed = near(at, "target", toxicity.REACH)
        name = ("targeted" if aimed else "bare") if mark == "insult" else "aimed threat" if aimed else "threat"
        out["reported" if near(at, "report", 0) else "negated" if near(at, "negation", 0) else name] += w
    return [out[p] for p in toxicity.PATTERNS]


def test_toxicity_machines_equal_plain_rules():
    rnd, word = random.Random(5), {"other": "x", "target": "you", "negation": "not", "report": "said", "insult": "idiot", "threat word": "kill"}
    grammar = toxicity.Grammar({"idiot": 3.0})
    for _ in range(3000):
        marks = rnd.choices(toxicity.MARKS, weights=[12, 1, 1, 1, 2, 2], k=rnd.randint(1, 30))
        words = [word[m] for m in marks]
        weights = [*map(grammar.weight, words)]
        assert grammar.clause(words, weights).tolist() == plain_patterns(marks, weights)


def test_toxicity_weights_keep_the_patterns_order():
    rnd = np.random.default_rng(2)
    for _ in range(5):  # whatever the sample says
        x = np.column_stack([np.ones(80), np.abs(rnd.normal(size=(80, 7))) @ toxicity.GENERATORS.T])
        bare, targeted, negated, reported, threat, aimed, heaviest = toxicity.fit(x, rnd.integers(0, 2, 80).astype(float))[1:] @ toxicity.GENERATORS
        assert targeted >= bare >= negated >= 0 and bare >= reported >= 0 and aimed >= threat >= 0 and heaviest >= 0


def test_toxicity_ranks_sentences(spark, tables):
    texts = ["you are such an idiot", "I will kill you", "what an idiot", "you are not an idiot", "the report said idiot", "a fine day", None]
    docs, labels = tables
    more = spark.createDataFrame([(-k - 1, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.classify(docs.select("doc_id", "text").unionByName(more), labels).where("doc_id < 0").collect()}
    aimed, threat, bare, negated, reported, clean, null = (got[-k - 1] for k in range(7))
    assert aimed >= 0.7 and threat >= 0.7 and aimed > bare > max(negated, reported) > clean == null


def test_training_rows_are_bounded_by_ids_that_repeat(spark):
    docs = spark.range(500).selectExpr("case when id < 400 then 3 else id end as doc_id", "concat('text ', id) as text")
    labels = spark.range(500).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    got = quality_classifier.labelled(docs, labels, "quality", 4, 2, 100).collect()
    ids = [r.doc_id for r in got]
    assert len(ids) == len(set(ids)) <= 100
    again = quality_classifier.labelled(docs.repartition(7), labels, "quality", 4, 2, 100).collect()
    assert {r.doc_id: r.text for r in got} == {r.doc_id: r.text for r in again}


def plain_quality(sample, texts, epochs):
    """FTRL over dicts of weights, one feature at a time; the same hashes by Python integers."""
    import math
    import re
    import zlib
    from collections import Counter

    top = 2**64 - 1

    def vector(text):
        tokens = re.findall(r"\w+|[^\w\s]+", text or "")
        shape = [1 if t.isupper() and len(t) > 1 else 2 if t[0].isalpha() else 3 for t in tokens]
        h = [zlib.crc32(t.encode()) << 2 | s for t, s in zip(tokens, shape)]
        keys = [x * 0xD6E8FEB86659FD93 for x in h] + [s * 0xA24BAED4963EE407 for s in shape]
        for i in range(len(h) - 1):
            keys.append(((h[i] * 0x9E3779B97F4A7C15 + h[i + 1]) & top) * 0xD6E8FEB86659FD93)
            keys.append((16 * (h[i] == h[i + 1]) + 4 * shape[i] + shape[i + 1] + 32) * 0xA24BAED4963EE407)
        value = {k: math.log1p(n) for k, n in Counter((k & top) >> (64 - quality_classifier.BITS) for k in keys).items()}
        size = math.sqrt(sum(v * v for v in value.values())) or 1.0
        return {**{k: v / size for k, v in value.items()}, "bias": 1.0}

    z, n = Counter(), Counter()

    def weight(k):
        return 0.0 if abs(z[k]) <= quality_classifier.L1 else -(z[k] - math.copysign(quality_classifier.L1, z[k])) / ((quality_classifier.BETA + math.sqrt(n[k])) / quality_classifier.ALPHA + quality_classifier.L2)

    def chance(x):
        return 1 / (1 + math.exp(-sum(v * weight(k) for k, v in x.items())))

    rows = [(vector(r.text), r.y) for r in sorted(sample, key=lambda r: (r.turn, r.doc_id))]
    for _ in range(epochs):
        for x, y in rows:
            p, w = chance(x), {k: weight(k) for k in x}
            for k, v in x.items():
                g = (p - y) * v
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / quality_classifier.ALPHA * w[k]
                n[k] += g * g
    return [chance(vector(t)) for t in texts]


def test_quality_equals_plain_ftrl(spark, tables):
    docs, labels = tables[0].where("doc_id < 150").selectExpr("doc_id", "substr(text, 1, 120) as text"), tables[1]
    sample = quality_classifier.labelled(docs, labels, "quality", 4, 2, 60)
    got = {r.doc_id: r.score for r in quality_classifier.classify(docs, labels, 60).collect()}
    rows, learnt = docs.collect(), sample.collect()
    plain = plain_quality(learnt, [r.text for r in rows], -(-quality_classifier.UPDATES // len(learnt)))
    assert [got[r.doc_id] for r in rows] == pytest.approx(plain, abs=1e-3)  # the sample's values are single precision


def test_toxicity_edges(spark, tables):
    docs = edge_docs(spark)
    assert toxicity.classify(docs, tables[1]).count() == 7
    fixed = toxicity.classify(spark.createDataFrame([(1, "you idiot"), (2, "fine")], "doc_id long, text string"), tables[1].limit(0))
    assert {r.doc_id: r.predicted for r in fixed.collect()} == {1: 1, 2: 0}
    assert toxicity.classify(docs.limit(0), tables[1]).count() == 0


def test_language_on_held_out_rows(spark, tables):
    docs, _ = tables
    out = language_id.identify(docs)
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 150 and np.mean([r.lang_pred == r.lang for r in rows]) >= 0.98
    assert out.where("score < 0 or score > 1").count() == 0


def test_language_mixture_and_edges(spark, tables):
    docs, _ = tables
    by_lang = {x: docs.where(f"lang = '{x}' and crc32(cast(cast(doc_id as string) as binary)) % 4 = 2").select("text").first().text for x in ("en", "de")}
    extra = [(100_001, by_lang["en"][:1500] + " " + by_lang["de"][:1500], None), (100_002, None, "en"), (100_003, "123 !!", "en"), (None, by_lang["de"], None)]
    more = spark.createDataFrame(extra, "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").unionByName(more)
    got = {r.doc_id: r for r in language_id.identify(both).where("doc_id > 100000 or doc_id is null").collect()}
    assert {x.lang for x in got[100_001].langs} == {"en", "de"}
    assert (got[100_002].lang_pred, got[100_003].lang_pred, got[None].lang_pred) == ("und", "und", "de")
    nothing = language_id.identify(more.where("doc_id > 100001")).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and language_id.identify(more.limit(0)).count() == 0


def test_languages_beyond_the_bound_are_not_learnt(spark):
    rows = [(i, "der hund und die katze", "de") for i in range(40)] + [(100 + i, "the dog and the cat", "en") for i in range(40)]
    rows += [(200 + i, "junk words of one tag", f"x{i:03d}") for i in range(300)]  # a row each: ties go by code point
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, table = language_id.learn(docs, 4)
    assert langs == ["de", "en", "x000", "x001"] and table.shape == (4, 1 << language_id.BITS)
    assert table.sum(1) == pytest.approx(np.ones(4), abs=1e-3)
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, 2).collect()}
    assert got[0] == "de" and got[100] == "en" and set(got.values()) == {"de", "en"}


def plain_viterbi(pieces, text):
    score = {p: (s, i) for i, (p, s, k) in enumerate(pieces) if k == "normal"}
    byte = {p: i for i, (p, _, k) in enumerate(pieces) if k == "byte"}
    unknown = min(s for s, _ in score.values()) - 10
    n = len(text)
    best, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
    for i in range(n):
        for j in range(i + 1, min(n, i + 16) + 1):
            s = score.get(text[i:j])
            s = s if s or j > i + 1 else (unknown, -1)
            if s and best[i] + s[0] > best[j]:
                best[j], back[j] = best[i] + s[0], (i, s[1])
    out = []
    while n:
        i, piece = back[n]
        out += [piece] if piece >= 0 else [byte[f"<0x{b:02X}>"] for b in reversed(text[i].encode())]
        n = i
    return out[::-1]


def test_codec_equals_brute_force_and_round_trips(spark, tables):
    pieces = sentencepiece_codec.vocabulary()
    codec = sentencepiece_codec.Codec(pieces)
    rnd = random.Random(1)
    texts = [r.text[:800] for r in tables[0].limit(40).collect()] + ["", "a", "  two  spaces ", "漢字\t😀é\n\n", "line\r\nline", "x" * 300]
    texts += ["".join(rnd.choices("ab ▁é漢\n", k=30)) for _ in range(50)]
    for t in texts:
        ids = codec.encode(t)
        assert codec.decode(ids) == t
        if t and "▁" not in t:
            assert ids.tolist() == plain_viterbi(pieces, ("▁" + t).replace(" ", "▁"))


def test_codec_over_rows(spark):
    docs = edge_docs(spark)
    out = sentencepiece_codec.encoded(docs, ["doc_id", "score"])
    rows = {(r.doc_id, r.n_tokens): r for r in out.collect()}
    assert rows[(5, 0)].token_ids is None and rows[(6, 0)].token_ids == [] and all(r.round_trip in (True, None) for r in rows.values())
    back = {r.doc_id: r.text for r in sentencepiece_codec.decoded(out, ["doc_id"]).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}
    assert sentencepiece_codec.encoded(docs.limit(0), ["doc_id"]).count() == 0
