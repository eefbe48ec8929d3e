"""SentencePiece encoding and decoding by a single-pass Viterbi over an Aho-Corasick automaton.

The automaton holds the normal pieces of a vocabulary file (its path is a parameter).  Reading a text once, every state
follows its output links to all pieces that end here, longest first, and relaxes the best score of this position; a
character that is no piece costs the least score less ten and becomes its UTF-8 bytes.  The result is the segmentation
with the largest sum of scores; of equal ones the piece that starts first at each position wins.

No piece goes from another character on to a word mark, and none holds a character outside the vocabulary's alphabet,
so the optimum of a text is the sequence of the optima of the segments between such places.  Segments (about words) are
remembered by a task, up to ``_MEMO`` of them; a vocabulary without that property is read as one segment a text.

Decoding joins pieces and bytes and is exact: ``decode(encode(text)) == text`` for every text.  A literal U+2581, the
mark for a space, is encoded as its bytes.

Defined cases: a null text has null ids and 0 tokens; an empty text has no ids; repeated rows are each encoded; an empty
table gives an empty result; a null ``doc_id`` passes through; columns to keep are named by the caller.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_MEMO, _MEMO_LONGEST = 100_000, 48


def vocabulary(path: str | None = None) -> list[tuple[str, float, str]]:
    """(piece, score, kind) in the order of ids; kind is normal, byte or other.  Read on the driver with the public library."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
    kind = lambda i: "byte" if sp.is_byte(i) else "other" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "normal"
    return [(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())]


class Codec:
    def __init__(self, pieces: list[tuple[str, float, str]]):
        normal = [(p, s, i) for i, (p, s, k) in enumerate(pieces) if k == "normal"]
        self.automaton = ahocorasick.Automaton()
        for p, s, i in normal:
            self.automaton.add_word(p, (len(p), s, i))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s, _ in normal) - UNKNOWN_PENALTY
        self.byte = {int(p[1:-1], 16): i for i, (p, _, k) in enumerate(pieces) if k == "byte"}
        self.bytes_of = [bytes([int(p[1:-1], 16)]) if k == "byte" else p.replace(MARK, " ").encode() if k == "normal" else b"" for p, _, k in pieces]
        self.single = {p for p, _, _ in normal if len(p) == 1}
        alphabet = re.escape("".join(sorted({c for p, _, _ in normal for c in p} - {MARK})))
        whole = any(MARK in p.lstrip(MARK) for p, _, _ in normal)
        self.segments = re.compile(f"[{alphabet}{MARK}]+|." if whole else f"{MARK}*[{alphabet}]+|{MARK}+|.", re.DOTALL)
        self.memo: dict[str, bytes] = {}

    def viterbi(self, segment: str) -> bytes:
        """Ids of the best segmentation, as packed 32-bit numbers."""
        n = len(segment)
        best, back = [0.0] + [-np.inf] * n, [(0, -1)] * (n + 1)
        if self.single.issuperset(segment):
            for end, (size, score, piece) in self.automaton.iter(segment):
                if (value := best[end + 1 - size] + score) > best[end + 1]:
                    best[end + 1], back[end + 1] = value, (size, piece)
        else:
            at: list[list] = [[] for _ in range(n)]
            for end, found in self.automaton.iter(segment):
                at[end].append(found)
            for end in range(n):
                for size, score, piece in at[end] + ([] if segment[end] in self.single else [(1, self.unknown, -1)]):
                    if (value := best[end + 1 - size] + score) > best[end + 1]:
                        best[end + 1], back[end + 1] = value, (size, piece)
        ids: list[int] = []
        while n:
            size, piece = back[n]
            ids += [piece] if piece >= 0 else [self.byte[b] for b in reversed(segment[n - 1].encode("utf-8", "surrogatepass"))]
            n -= size
        return array("i", reversed(ids)).tobytes()

    def __getitem__(self, segment: str) -> bytes:
        if (known := self.memo.get(segment)) is None:
            known = self.viterbi(segment)
            if len(segment) <= _MEMO_LONGEST:
                if len(self.memo) >= _MEMO:
                    self.memo.clear()
                self.memo[segment] = known
        return known

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        marks = array("i", [self.byte[b] for b in MARK.encode()]).tobytes()
        parts = text.split(MARK)
        parts[0] = " " + parts[0]
        packed = marks.join(b"".join(map(self.__getitem__, self.segments.findall(p.replace(" ", MARK)))) for p in parts)
        return np.frombuffer(packed, np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))[1:].decode("utf-8", "replace")


def encoded(docs: DataFrame, columns: list[str], path: str | None = None) -> DataFrame:
    """``columns``, ``n_tokens``, ``token_ids`` and ``round_trip`` (the ids decode to the text) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))  # fixed by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                ids, same = [], []
                for t in b.column(b.num_columns - 1).to_pylist():
                    ids.append(None if t is None else codec.encode(t))
                    same.append(None if t is None else codec.decode(ids[-1]) == t)
                sizes = np.array([0 if x is None else len(x) for x in ids], np.int64)
                values = np.concatenate([x for x in ids if x is not None] or [np.empty(0, np.int32)])
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()), mask=pa.array([x is None for x in ids]))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sizes), lists, pa.array(same, pa.bool_())], names=[*b.schema.names[:-1], "n_tokens", "token_ids", "round_trip"])

    rows = docs.select(*columns, F.col("text").alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kept}, n_tokens long, token_ids array<int>, round_trip boolean")


def decoded(tokens: DataFrame, columns: list[str], path: str | None = None) -> DataFrame:
    """``columns`` and the ``text`` of ``token_ids``; null ids have a null text."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for b in batches:
            texts = [None if x is None else codec.decode(np.array(x, np.int32)) for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], names=[*b.schema.names[:-1], "text"])

    rows = tokens.select(*columns, "token_ids")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kept}, text string")
