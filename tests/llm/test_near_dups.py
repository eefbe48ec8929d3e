"""SimHash, embedding and substring operators against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from noticespark.llm import document_fingerprints, embedding_near_dup, simhash_near_dedup, substring_dedup
from noticespark.llm.common import connected_components, global_index

DOCS = "doc_id long, text string, _id string, fp string, rank string"


def components(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def plain_simhash(text, shingle):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    ones = [sum(xxhash.xxh64_intdigest(p.encode(), 42) >> k & 1 for p in parts) for k in range(64)]
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(parts))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choices("abcdefgé", k=rnd.randint(2, 9))) for _ in range(400)]
    base = [" ".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 2, 3, 60, 400]))) for _ in range(60)]
    out = [*base, None, "", "  \n ", "Ünï\x0bcode\x0ctext HERE"]
    for t in base[:40]:
        w = t.split()
        for _ in range(3):
            v = list(w)
            if len(v) > 50:
                v[rnd.randrange(len(v))] = "changed"
            out.append(" ".join(v).upper() if rnd.random() < 0.2 else " ".join(v))
    return [(i * 3 + 1, t, "x", "y", "z") for i, t in enumerate(out)] + [(1, out[0], "x", "y", "z"), (None, out[4], None, None, None), (None, "alone in the null ids", None, None, None)]


def test_simhash_components_equal_brute_force(spark, texts):
    docs = spark.createDataFrame(texts, DOCS)
    got = simhash_near_dedup.near_dedup(docs, 3, 2).collect()
    fps = [plain_simhash(r[1], 3) for r in texts]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    root = components(len(fps), pairs)
    smallest = {}
    for r, x in zip(root, texts):
        if x[0] is not None:
            smallest[r] = min(smallest.get(r, x[0]), x[0])
    want = sorted((str(x[0]), format(f, "016x"), str(smallest.get(r))) for x, f, r in zip(texts, fps, root))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash_near_dedup.one_of_each(docs, 3, 2)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(root))
    assert kept.where("doc_id is not null").select("doc_id").distinct().count() == len(smallest)


def test_gray_index_finds_all_within_radius():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 700, dtype=np.uint64)
    near = base[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    items = np.sort(np.unique(np.concatenate([base, near])))
    index = simhash_near_dedup.GrayIndex(items, np.full(len(items), ~np.uint64(0)))
    got = {(int(q), int(i)) for a, b in index.search(items, 2, block=100) for q, i in zip(a, b)}
    want = {(q, int(i)) for q in range(len(items)) for i in np.flatnonzero(np.bitwise_count(items ^ items[q]) <= 2)}
    assert got == want


def test_simhash_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash_near_dedup.near_dedup(empty).count() == 0
    assert simhash_near_dedup.one_of_each(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    rnd = random.Random(2)
    ids = rnd.sample(range(10_000), 300)
    edges = [(ids[i], ids[i + 1]) for i in range(99)] + [(ids[100], x) for x in ids[101:200]] + [(ids[250], ids[251]), (ids[251], ids[250]), (ids[7], ids[7])]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[x] for x in ids[:100]} == {min(ids[:100])}
    assert {got[x] for x in ids[100:200]} == {min(ids[100:200])}
    assert got[ids[250]] == got[ids[251]] == min(ids[250], ids[251])


def test_global_index_counts_in_order(spark):
    rows = [(x,) for x in random.Random(3).sample(range(100_000), 2_000)]
    got = global_index(spark.createDataFrame(rows, "v long"), [F.desc("v")], rows_per_part=100).collect()
    assert [r.v for r in sorted(got, key=lambda r: r.idx)] == sorted((r[0] for r in rows), reverse=True)
    assert sorted(r.idx for r in got) == list(range(2_000))


# --- document fingerprints ---


def plain_votes(text):
    w, votes, total = words((text or "").lower()), np.zeros(64, int), 0
    for i, a in enumerate(w):
        h, size = xxhash.xxh64_intdigest(a.encode(), 42), len(a)
        if i + 1 < len(w):
            h, size = xxhash.xxh64_intdigest(w[i + 1].encode(), h), size + 1 + len(w[i + 1])
        votes += min(32, size) * np.array([h >> k & 1 for k in range(64)])
        total += min(32, size)
    return sum(1 << k for k in range(64) if 2 * votes[k] > total)


def test_fingerprint_report_equals_brute_force(spark, texts):
    import hashlib

    rows = [r for r in texts if r[0] is not None] + [(300, "a document that is asked for", "", "", ""), (500, None, "", "", "")]
    docs = spark.createDataFrame(rows, DOCS)
    got = document_fingerprints.fingerprint_report(docs).collect()
    distinct = sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: -r[0])
    want = {}
    for i, (doc_id, t) in enumerate(distinct):
        nxt = distinct[(i + 1) % len(distinct)][1]
        k = len(t) // 3
        e = t[: len(t) - k] + nxt[:k]
        want[doc_id] = (len(t), hashlib.sha256(e.encode()).hexdigest(), format(plain_votes(t), "016x"), format(plain_votes(e), "016x"), format(plain_votes(nxt), "016x"))
    assert len(got) == len(rows)
    fps = [plain_votes(r[1]) for r in rows]
    for r in got:
        size, sha, fp, edited, nxt = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (size, sha, fp, edited)
        likeness = lambda x: max(0.0, np.cos(np.pi * (int(fp, 16) ^ int(x, 16)).bit_count() / 64))
        assert r.near_edited == pytest.approx(likeness(edited)) and r.near_next == pytest.approx(likeness(nxt))
        near = sum((int(fp, 16) ^ f).bit_count() <= 3 for f in fps) - 1
        assert r.n_near == (near if r.doc_id % 100 == 0 else None)


def test_fingerprints_of_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "one two", "", "", ""), (7, "three four five", "", "", "")], DOCS)
    got = {r.doc_id: r for r in document_fingerprints.fingerprint_report(docs).collect()}
    assert got[None].n_chars == 7 and got[7].fingerprint == format(plain_votes("three four five"), "016x")
    assert document_fingerprints.fingerprint_report(docs.limit(0)).count() == 0


def test_block_search_finds_all_within_radius(spark):
    rnd = random.Random(9)
    fps = [rnd.getrandbits(64) for _ in range(200)]
    fps += [f ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for f in fps[:150]]
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    all_ = spark.createDataFrame(signed, "fp long")
    got = {(r.query_fp, r.fp) for r in document_fingerprints.block_search(all_, all_.limit(100), 3).collect()}
    asked = {r.fp for r in all_.limit(100).collect()}
    want = {(q, f[0]) for q in asked for f in set(signed) if ((q ^ f[0]) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want


# --- embeddings ---


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16))
    near = [b + rng.normal(size=16) * s for b in base[:20] for s in (0.05, 0.1, 0.15, 0.2)]
    v = np.concatenate([base, near, base[:5], base[5:8] * 3]).astype(np.float32)
    rows = [(i * 2, v[i].tolist(), i % 2, "x") for i in range(len(v))]
    rows += [(9001, None, 0, "x"), (9002, [0.0] * 16, 0, "x"), (9003, [float("nan")] * 16, 1, "x"), (9004, v[0].tolist(), None, "x"), (9005, [None] * 16, 1, "x")]
    rows += [(9006, [], 1, "x"), (None, v[0].tolist(), 0, "x"), (9007, [float("inf")] * 16, 1, "x"), (9008, [1.0, 2.0], 1, "x"), (9009, [2.0, 4.0], 1, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_near_dup.near_duplicates(table, 0.93).collect()}
    fine = [r for r in rows if r[0] is not None and r[0] < 9000 or r[0] in (9008, 9009)]
    unit = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) for r in fine]
    pairs = [(i, j) for i in range(len(fine)) for j in range(i) if fine[i][2] == fine[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93]
    root = components(len(fine), pairs)
    for i, r in enumerate(fine):
        first = fine[root[i]][0]
        assert got[r[0]] == (sum(i in p for p in pairs), first, first == r[0])
    for x in (9001, 9002, 9003, 9004, 9005, 9006, 9007):
        assert got[x] == (0, x, True)
    assert len(got) == len(rows)
    assert embedding_near_dup.near_duplicates(table.limit(0)).count() == 0


def test_embedding_blocks_of_one_dense_group(spark, monkeypatch):
    """A group larger than a block is searched over all its blocks; counts stay exact."""
    monkeypatch.setattr(embedding_near_dup, "BLOCK_ROWS", 40)
    monkeypatch.setattr(embedding_near_dup, "CLUSTER_ROWS", 60)
    rng = np.random.default_rng(8)
    centre = rng.normal(size=24)
    v = np.concatenate([centre + rng.normal(size=(150, 24)) * 0.2, rng.normal(size=(100, 24))]).astype(np.float32)
    table = spark.createDataFrame([(i, v[i].tolist(), 1) for i in range(len(v))], "vec_id long, embedding array<float>, label int")
    got = embedding_near_dup.near_duplicates(table, 0.93).orderBy("vec_id").collect()
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.93).sum(1) - 1
    found = np.array([r.n_links for r in got])
    assert (found <= links).all() and found.sum() >= 0.97 * links.sum()


def test_embedding_links_come_from_the_search_alone(spark, monkeypatch):
    """Without the search there are no links and the audit says so; with it each pair counts once over all blocks."""
    rng = np.random.default_rng(6)
    v = np.concatenate([x + rng.normal(size=(30, 16)) * 0.03 for x in rng.normal(size=(8, 16))])
    reps = spark.createDataFrame([("1", 16, i, 1 + i % 2, x.tolist()) for i, x in enumerate(v)], "label string, dims int, rep long, copies long, embedding array<float>")
    monkeypatch.setattr(embedding_near_dup, "BLOCK_ROWS", 50)
    monkeypatch.setattr(embedding_near_dup, "QUERY_ROWS", 20)

    def counts(found):
        return found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))

    found = embedding_near_dup._found(reps, v[::60], 0.93, 3)
    unit = v.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    true = near @ (1 + np.arange(len(v)) % 2)
    got = {r.rep: r.n for r in counts(found).collect()}
    assert all(got.get(i, 0) <= true[i] for i in range(len(v))) and sum(got.values()) >= 0.97 * true.sum()
    assert embedding_near_dup._audit(reps, counts(found), 0.93) >= 0.97
    links = found.where("b is not null").collect()
    assert links and all(near[r.a, r.b] for r in links)

    monkeypatch.setattr(embedding_near_dup, "search", lambda *_: (np.empty(0, np.int64), np.empty(0, np.int64)))
    found = embedding_near_dup._found(reps, v[::60], 0.93, 3)
    assert found.isEmpty() and embedding_near_dup._audit(reps, counts(found), 0.93) == 0


def test_embedding_audit_is_not_hidden_by_a_dense_group(spark):
    rng = np.random.default_rng(3)
    pairs = rng.normal(size=(100, 32))
    v = np.concatenate([rng.normal(size=32) + rng.normal(size=(100, 32)) * 0.05, pairs, pairs + rng.normal(size=(100, 32)) * 0.02])
    reps = spark.createDataFrame([("1", 32, i, 1, x.tolist()) for i, x in enumerate(v)], "label string, dims int, rep long, copies long, embedding array<float>")
    counts = spark.createDataFrame([(i, 99) for i in range(100)], "rep long, n long")  # no pair was found
    assert embedding_near_dup._audit(reps, counts, 0.93) == pytest.approx(1 / 3)


# --- substring dedup ---


def test_chunks_resist_insertions():
    rnd = random.Random(6)
    text = " ".join("".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(3_000)).encode()

    def pieces(data):
        ends = substring_dedup.cuts(data)
        assert ends[-1] == len(data) and ends == sorted(set(ends))
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    whole, shifted = pieces(text), pieces(text[:5_000] + b"some words put in " + text[5_000:])
    assert len(set(whole) & set(shifted)) >= len(whole) - 8
    assert max(map(len, pieces(b"x" * 5_000))) <= substring_dedup.MAX_BYTES
    assert b"".join(pieces("é".encode() * 3_000)).decode() == "é" * 3_000 and all(p.decode() for p in pieces("é".encode() * 3_000))
    assert substring_dedup.cuts(b"") == []
    assert pieces(b"a b " * 700_000)[0]  # longer than a block


def test_repeated_passages_are_cut_from_later_documents(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choices("abcdefghijklm", k=rnd.randint(3, 9)))
    own = lambda n: " ".join(word() for _ in range(n))
    passage, short = own(60), own(8)
    rows = [(1, f"{own(80)} {passage} {own(50)}"), (2, f"{own(30)} {passage} {own(90)}"), (3, own(200)), (4, f"{short} {own(100)}"), (5, f"{short} {own(90)}")]
    rows += [(6, None), (7, ""), (None, passage), (8, passage), (8, passage)]
    docs = spark.createDataFrame([(i, t, "s", 0) for i, t in rows], "doc_id long, text string, spans string, _id int")
    spans = substring_dedup.repeated_spans(docs)
    got = {r.doc_id: r for r in spans.collect()}
    assert set(got) == {2, 8} and got[2].sources == [1] and got[2].removed_words >= 40
    out = substring_dedup.remove_spans(docs, spans)
    assert out.columns == docs.columns and out.count() == len(rows)
    text = {r.doc_id: r.text for r in out.collect()}
    by_id = dict(rows)
    assert all(text[i] == by_id[i] for i in (1, 3, 4, 5, 6, 7, None))
    assert len(words(text[2])) <= 120 + 20 and " ".join(passage.split()[20:40]) not in text[2]
    assert substring_dedup.repeated_spans(docs.limit(0)).count() == 0


@pytest.mark.parametrize("share", [1, substring_dedup.HOT_SHARE, 10**12])  # no digest is hot, the production share, all are
def test_spans_equal_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", share)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text.encode()) for r in docs.collect())
    first = {}
    chunked = []
    for doc_id, data in rows:
        start, mine = 0, []
        for end in substring_dedup.cuts(data):
            mine.append((start, end, first.setdefault(data[start:end], (doc_id, start)) != (doc_id, start)))
            start = end
        chunked.append((doc_id, data, mine))
    want = {}
    for doc_id, data, mine in chunked:
        spans, run = [], None
        for start, end, again in [*mine, (None, None, False)]:
            if again:
                run = (run[0] if run else start, end)
            elif run:
                spans += [run] if len(data[run[0] : run[1]].split()) >= substring_dedup.MIN_WORDS else []
                run = None
        if spans:
            want[doc_id] = spans
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in substring_dedup.repeated_spans(docs).collect()}
    assert got == want


def wordless(kind, n, rnd):
    if kind == "han":
        return "".join(chr(rnd.randint(0x4E00, 0x9FA5)) for _ in range(n))
    if kind == "base64":
        return "".join(rnd.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=n))
    return {"nbsp": "\u00a0", "wide": "\u3000"}[kind].join("".join(rnd.choices("abcdefghijklm", k=5)) for _ in range(n // 6))


@pytest.mark.parametrize("kind", ["han", "base64", "nbsp", "wide"])
def test_texts_without_spaces_fall_back_into_step(spark, kind):
    rnd = random.Random(11)
    passage = wordless(kind, 900, rnd)
    rows = [(1, wordless(kind, 700, rnd) + passage + wordless(kind, 500, rnd)), (2, wordless(kind, 401, rnd) + passage + wordless(kind, 300, rnd))]
    rows += [(3, passage), (4, "x" + passage), (5, wordless(kind, 900, rnd))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = substring_dedup.repeated_spans(docs)
    text = {r.doc_id: r.text for r in substring_dedup.remove_spans(docs, spans).collect()}
    assert text[1] == rows[0][1] and text[5] == rows[4][1]
    for doc_id in (2, 3, 4):
        assert passage[200:700] not in text[doc_id] and len(text[doc_id]) <= len(rows[doc_id - 1][1]) - 700


def test_wordless_cuts_do_not_depend_on_blocks():
    rnd = random.Random(12)
    data = wordless("base64", 1_100_000, rnd).encode()
    ends, later = substring_dedup.cuts(data), substring_dedup.cuts(data[100_000:])
    assert len(set(ends) & {x + 100_000 for x in later}) >= 0.99 * len(later)
    assert all(p.decode() for p in [data[a:b] for a, b in zip([0, *ends], ends)])
    han = wordless("han", 2_000, rnd).encode()
    ends = substring_dedup.cuts(han)
    assert all(han[a:b].decode() for a, b in zip([0, *ends], ends))


def test_texts_of_one_id_are_cut_at_their_own_spans(spark):
    rnd = random.Random(13)
    own = lambda n, letters: " ".join("".join(rnd.choices(letters, k=rnd.randint(3, 9))) for _ in range(n))
    passage, other = own(60, "abcdefgh"), own(60, "ijklmnop")
    apart = own(200, "éèüößñ")
    rows = [(1, f"{own(40, 'abcdefgh')} {passage} {own(40, 'abcdefgh')} {other}"), (2, f"{own(37, 'qrstuv')} {passage} {own(80, 'qrstuv')}")]
    rows += [(2, apart), (2, f"{own(90, 'wxyz')} {other} {own(20, 'wxyz')}"), (2, "short")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int")
    spans = substring_dedup.repeated_spans(docs)
    text = {r.n: r.text for r in substring_dedup.remove_spans(docs, spans).collect()}
    assert len(text) == 5 and [text[n] for n in (0, 2, 4)] == [rows[n][1] for n in (0, 2, 4)]
    for n, cut, before, after in ((1, passage, 37, 80), (3, other, 90, 20)):
        kept, whole = words(text[n]), words(rows[n][1])
        assert kept[:before] == whole[:before] and kept[-after:] == whole[-after:] and len(kept) <= before + after + 20
        assert " ".join(words(cut)[20:40]) not in text[n]
