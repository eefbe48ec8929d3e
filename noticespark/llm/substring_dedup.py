"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 16 bytes decides where a text is cut: before a word, or at any code point border
that lies ``WORDLESS`` bytes or more after the last word start (scripts without spaces, other separators than ASCII ones,
base64, long URLs); only after a least size, and by force at a largest size, which is left to runs of one byte or
blank.  Cuts depend on nearby bytes alone, so after an insertion the chunks fall back into step.  Chunks are compared by a 64-bit digest; of equal chunks the one in the document with the smallest ``doc_id``
stays (inside one document the first one).  Consecutive repeated chunks form a span, and a span of at least
``min_words`` words is removed.  A passage of 51 words has at most about one cut-off chunk at either end, so 20 words
of whole chunks are required; a chance collision of one digest never makes a span.  Long tokens count as one word for
every ``WORD_POINTS`` code points, or ``WIDE_POINTS`` code points of three or more bytes (see ``word_count``).

Chunks are staged once as narrow rows.  Equal chunks are aggregated before they are shuffled, so a passage that a third
of all documents share is one row per map task.  A digest that more than one in ``HOT_SHARE`` of all chunks carry is hot;
there are fewer than ``HOT_SHARE`` of them, so they are broadcast and their chunks are marked where they lie, while the
other digests are joined by shuffle.  Texts themselves never pass through a shuffle keyed by content.

Defined cases: null and empty texts have no chunk; rows with a null ``doc_id`` are returned whole and unmarked; rows
that share a ``doc_id`` are parts of one document: they are not compared with each other, and each gets the spans found
in its own text, which ``text_hash`` tells apart; an empty table gives an empty result; other columns pass through ``remove_spans`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticespark.llm.common import masked, staged

MIN_BYTES, MAX_BYTES, MASK = 16, 512, 3  # after the least size one word start in four is a cut
MIN_WORDS = 20
WORDLESS = 32  # from here on after a word start, one code point border in eight is a cut
WORD_POINTS, WIDE_POINTS = 12, 3
HOT_SHARE = 10_000  # a digest of more than one chunk in this many is hot: fewer than this many digests can be
#: The gear table: one fixed random 16-bit number for each byte value.
GEAR = np.random.Generator(np.random.PCG64(2024)).integers(0, 1 << 16, 256, dtype=np.uint16)
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; the last one is its length."""
    raw = np.frombuffer(data, np.uint8)
    ends: list[int] = []
    start = 0
    for lo in range(0, len(raw), 1 << 20):  # blocks bound the memory; 64 earlier bytes carry hash and word starts over the border
        first = max(0, lo - 64)
        part = raw[first : lo + (1 << 20) + 1]
        h = GEAR[part]
        for step in (1, 2, 4, 8):  # sum of GEAR[byte] << age over the last 16 bytes
            h[step:] = h[step:] + (h[:-step] << step)
        space = _SPACE[part]
        word = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        found = [word[(h[word - 1] >> 13) & MASK == 0]]
        borders = np.concatenate([[0], word, [len(part)]])
        for i in np.flatnonzero(np.diff(borders) > WORDLESS).tolist():
            a, b = int(borders[i]) + WORDLESS, int(borders[i + 1])
            inside = (h[a - 1 : b - 1] >> 13 == 0) & (part[a:b] & 0xC0 != 0x80) & ~space[a:b] & ~space[a - 1 : b - 1]
            found.append(np.flatnonzero(inside) + a)
        at = np.sort(np.concatenate(found)) + first
        for cut in at[(at > lo) | (lo == 0)].tolist():
            while cut - start > MAX_BYTES:
                start = _forced(raw, start)
                ends.append(start)
            if cut - start >= MIN_BYTES:
                ends.append(cut)
                start = cut
    while len(raw) - start > MAX_BYTES:
        start = _forced(raw, start)
        ends.append(start)
    return ends + [len(raw)] * (start < len(raw))


def _forced(raw: np.ndarray, start: int) -> int:
    at = start + MAX_BYTES
    while at > start + MAX_BYTES - 4 and raw[at] & 0xC0 == 0x80:  # not inside a code point
        at -= 1
    return at


def word_count(piece: bytes) -> int:
    """Words between ASCII spaces; a token without them counts by its code points."""
    n = 0
    for token in piece.split():
        n += 1
        if len(token) >= 2 * WIDE_POINTS:
            points = len(token) if token.isascii() else sum(x & 0xC0 != 0x80 for x in token)
            wide = 0 if token.isascii() else sum(x >= 0xE0 for x in token)
            n += max(1, points // WORD_POINTS, wide // WIDE_POINTS) - 1
    return n


def chunks(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, digest, start, size, words, again)``: a row for each chunk; ``again`` marks a repeat inside its row's text.

    ``start`` and ``size`` count bytes of the UTF-8 text, whose hash is ``text_hash``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, texts, digests, starts, sizes, words, again = [], [], [], [], [], [], []
            for doc_id, text_hash, text in zip(b["doc_id"].tolist(), b["text_hash"].tolist(), b["text"]):
                data = text.encode("utf-8", "surrogatepass")
                seen: set[int] = set()
                start = 0
                for end in cuts(data):
                    piece = data[start:end]
                    d = xxhash.xxh3_64_intdigest(piece)
                    ids.append(doc_id)
                    texts.append(text_hash)
                    digests.append(d)
                    starts.append(start)
                    sizes.append(end - start)
                    words.append(word_count(piece))
                    again.append(d in seen)
                    seen.add(d)
                    start = end
                if len(ids) > 200_000:
                    yield frame(ids, texts, digests, starts, sizes, words, again)
                    ids, texts, digests, starts, sizes, words, again = [], [], [], [], [], [], []
            yield frame(ids, texts, digests, starts, sizes, words, again)

    def frame(ids, texts, digests, starts, sizes, words, again) -> pd.DataFrame:
        return pd.DataFrame({
            "doc_id": np.array(ids, np.int64), "text_hash": np.array(texts, np.int64), "digest": np.array(digests, np.uint64).view(np.int64), "start": np.array(starts, np.int64),
            "size": np.array(sizes, np.int32), "words": np.array(words, np.int32), "again": np.array(again, bool),
        })

    used = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return used.mapInPandas(run, "doc_id long, text_hash long, digest long, start long, size int, words int, again boolean")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, text_hash, spans, sources, removed_words)`` of the texts that lose a part, one row for each text of a ``doc_id``.

    ``spans``: array of (start, end) in bytes; ``sources``: ids of documents that keep the first copies of the chunks.
    """
    all_chunks = staged(chunks(docs), "chunks")
    first = all_chunks.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.max("again").alias("any"), F.count(F.lit(1)).alias("n"))
    first = staged(first.where("first_id < last_id or any").select("digest", "first_id", "n"), "digests")
    total = all_chunks.count()  # read from the files' footers
    is_hot = F.col("n") * HOT_SHARE > total
    hot, cold = (first.where(c).select("digest", "first_id") for c in (is_hot, ~is_hot))
    marked = all_chunks.join(F.broadcast(hot), "digest").unionByName(all_chunks.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(cold, "digest"))
    marked = marked.where("doc_id > first_id or again")
    per_doc = marked.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "size", "words", "first_id")).alias("found"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, text_hash, found in zip(b["doc_id"].tolist(), b["text_hash"].tolist(), b["found"]):
                spans, sources, removed = [], set(), 0
                run_: list = []
                for x in [*sorted({(f["start"], f["size"], f["words"], f["first_id"]) for f in found}), None]:
                    if run_ and (x is None or x[0] != run_[-1][0] + run_[-1][1]):
                        if (n := sum(r[2] for r in run_)) >= min_words:
                            spans.append((run_[0][0], run_[-1][0] + run_[-1][1]))
                            sources |= {r[3] for r in run_}
                            removed += n
                        run_ = []
                    if x is not None:
                        run_.append(x)
                if spans:
                    out.append((doc_id, text_hash, spans, sorted(sources), removed))
            yield pd.DataFrame(out, columns=["doc_id", "text_hash", "spans", "sources", "removed_words"])

    return per_doc.mapInPandas(run, "doc_id long, text_hash long, spans array<struct<start:long,end:long>>, sources array<long>, removed_words long")


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for t, cut in zip(text, spans):
        if t is not None and cut is not None:
            data, kept, at = t.encode("utf-8", "surrogatepass"), [], 0
            for s in cut:
                kept.append(data[at : s["start"]])
                at = s["end"]
            t = b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")
        out.append(t)
    return pd.Series(out, dtype=object)


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans cut out of ``text``; the other columns are unchanged."""
    rows, at = masked(docs)
    found = spans.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans").alias("_spans"))
    text = F.col(at["text"])
    joined = rows.join(found, (F.col(at["doc_id"]) == F.col("_id")) & (F.xxhash64(text) == F.col("_hash")), "left")
    cut = F.when(F.col("_spans").isNotNull(), _without(text, F.col("_spans"))).otherwise(text)
    return joined.select(*[(cut if name == "text" else F.col(c)).alias(name) for name, c in at.items()])
