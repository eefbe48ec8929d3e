"""Conversation structure repair: a generalised LR parse of a conversation's roles with weighted edits.

Grammar of the role initials:  C -> (empty) | P | s P,  P -> P u a | u a.  Its LR table (``SHIFT``, ``REDUCE``, ``GOTO``,
``ACCEPT``) drives a graph-structured stack: a node is an LR state with a link to the node below it.  Before every row
and at the end any number of turns may be inserted; a row is kept, given another role or deleted.  Each edit shifts a
terminal (or none) and reduces; nodes with equal tops are merged by their minimum of (cost, audit), which loses nothing,
because tops that are equal have equal futures here and an audit never is a proper prefix of another of equal cost.

Edits: keep 0, rerole 2, insert 2, delete 3; an undeleted truncated row 1 more; blank and repeated rows must go.

On Spark: only narrow rows (order, initial, faults, a digest of the text) are sorted.  They are range-partitioned by
conversation and turn, so a conversation of any size is spread over parts; each part parses its stretch of a
conversation once from every stack top it may be entered with, and the few stretches of a conversation are then joined
from first to last.  The texts meet the audit in one pass that streams a conversation's rows in order and holds one.

Defined cases: nulls in ``conv_id`` and ``turn`` count as one space in the damage key, in ``role`` and ``text`` as one
space altogether; rows are ordered by turn, nulls first, then by role and by the text's MD5; repeated rows are duplicates
(the first stays); a null ``conv_id`` is one conversation; conversations without rows after damage have zeros, an empty
audit and the hash of the empty text; an empty table has no conversations; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticespark.llm.common import staged

# The LR table of the role grammar.  States: 0 start, 1 s, 2 u, 3 ua, 4 sP, 5 P, 6 Pu, 7 Pua.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (4, "u"): 6, (5, "u"): 6, (6, "a"): 7}
REDUCE = {3: 2, 7: 3}  # state -> letters that the rule P -> u a, P -> P u a takes off the stack
GOTO = {0: 5, 1: 4}
ACCEPT = (0, 4, 5)
#: The stacks that a stretch may be entered with, one for each top between rows.
ENTRIES = ((0,), (0, 1), (0, 2), (0, 1, 4), (0, 5), (0, 5, 6))
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}

BLANK, SEEN, TRUNCATED = 1, 2, 3

Node = tuple[int, str, int, "Node | None"]  # cost, audit, LR state, the node below


def shifted(node: Node, terminal: str, cost: int, audit: str) -> Node | None:
    """The node after an edit that shifts ``terminal`` and makes all reductions; None if the table has no such shift."""
    state = SHIFT.get((node[2], terminal))
    if state is None:
        return None
    top: Node = (cost, audit, state, node)
    while top[2] in REDUCE:
        below = top
        for _ in range(REDUCE[top[2]]):
            below = below[3]
        top = (cost, audit, GOTO[below[2]], below)
    return top


def _merge(tops: dict[int, Node], node: Node | None) -> bool:
    if node is None:
        return False
    old = tops.get(node[2])
    if old is None or node[:2] < old[:2]:
        tops[node[2]] = node
        return True
    return False


def with_inserts(tops: dict[int, Node]) -> dict[int, Node]:
    """All tops that inserted turns lead to: repeated until nothing gets better."""
    tops = dict(tops)
    todo = list(tops.values())
    while todo:
        node = todo.pop()
        if tops[node[2]] is not node:
            continue
        for terminal in ROLES:
            new = shifted(node, terminal, node[0] + INSERT, node[1] + "I")
            if _merge(tops, new):
                todo.append(new)
    return tops


def after_row(tops: dict[int, Node], initial: str, fault: int, copies: int) -> dict[int, Node]:
    """Tops after one row and its copies (which are duplicates and go)."""
    out: dict[int, Node] = {}
    more = DELETE * (copies - 1)
    tail = "D" * (copies - 1)
    for node in with_inserts(tops).values():
        cost, audit, state, below = node
        _merge(out, (cost + DELETE + more, audit + "D" + tail, state, below))
        if fault in (BLANK, SEEN):
            continue
        cost += CUT * (fault == TRUNCATED) + more
        _merge(out, shifted(node, initial, cost + KEEP, audit + "K" + tail))
        for terminal in ROLES:
            _merge(out, shifted(node, terminal, cost + REROLE, audit + "R" + tail))
    return out


def entered(entry: int) -> dict[int, Node]:
    """The stack of ``ENTRIES[entry]``, at no cost."""
    node = reduce(lambda below, state: (0, "", state, below), ENTRIES[entry], None)
    return {node[2]: node}


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage of the contract; a row that is repeated appears twice."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_d"))
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_d") == 4, "user").otherwise(F.col("role"))
    times = F.sequence(F.lit(1), F.when(F.col("_d") == 3, 2).otherwise(1))
    return rows.where("_d <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


def _digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def _narrow(rows: DataFrame) -> DataFrame:
    """One narrow row per different row: ``conv_id, turn, role, digest, initial, fault, copies``."""
    blank = ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    # The last character that is no space, found from the end of the text.
    last = F.substring(F.regexp_replace(F.substring("text", -256, 256), "[\\x20\\x09-\\x0D]+$", ""), -1, 1)
    last = F.when(last != "", last).otherwise(F.substring(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), -1, 1))
    fault = F.when(blank, BLANK).when(~last.rlike("^[.!?]$"), TRUNCATED).otherwise(0)
    few = rows.select("conv_id", "turn", "role", _digest(F.col("text")).alias("digest"), fault.alias("fault"))
    few = few.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.count(F.lit(1)).alias("copies"))
    # The first turn of a role and text; null turns come first.
    first = few.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("_first"))
    first = first.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_g"), "_first")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_g"))
    seen = ~F.col("turn").eqNullSafe(F.col("_first.turn"))
    fault = F.when((F.col("fault") != BLANK) & seen, SEEN).otherwise(F.col("fault"))
    return few.join(first, same).select("conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), fault.cast("int").alias("fault"), "copies")


_ORDER = ["conv_id", "turn", "role", "digest"]
_STRETCH = "conv_id long, part int, turn long, role string, digest string, first string, last string, illegal long, entry int, leave int, cost long, audit string"


def _rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b[c].astype(object).where(b[c].notna(), None) for c in b.columns))


def _stretches(narrow: DataFrame) -> DataFrame:
    """Each part's stretch of each conversation: cost and audit for every way in (``entry``) and out (``leave``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        conv, head, tops, last, illegal, number = None, None, [], "", 0, 0

        def close() -> None:
            for entry, ends in enumerate(tops):
                for leave, node in ends.items():
                    out.append((conv, *head, last, illegal, entry, leave, node[0], node[1]))

        for conv_id, turn, role, digest, initial, fault, copies, part in _rows_of(batches):
            if head is None or conv_id != conv:
                if head is not None:
                    close()
                number += 1
                # Only the first conversation of a part can have begun in an earlier part.
                conv, head, last, illegal = conv_id, (part, turn, role, digest, initial), None, 0
                tops = [entered(e) for e in range(len(ENTRIES) if number == 1 else 1)]
            illegal += (copies - 1) * (initial + initial not in ("su", "ua", "au"))
            if last is not None:
                illegal += last + initial not in ("su", "ua", "au")
            last = initial
            tops = [after_row(t, initial, fault, copies) for t in tops]
            if len(out) > 5_000:
                yield _frame(out, _STRETCH)
                out = []
        if head is not None:
            close()
        yield _frame(out, _STRETCH)

    n = max(8, min(4096, narrow.count() // 50_000))
    order = [F.col(_ORDER[0]).asc_nulls_first(), F.col(_ORDER[1]).asc_nulls_first(), *_ORDER[2:]]
    parts = narrow.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    return parts.mapInPandas(run, _STRETCH)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    made = pd.DataFrame(rows, columns=names, dtype=object)
    for c in schema.split(","):
        name, kind = c.strip().split(" ")
        if kind in ("long", "int"):
            made[name] = made[name].astype("Int64" if kind == "long" else "Int32")
    return made


_JOINED = "conv_id long, turn long, role string, digest string, illegal long, cost long, audit string, whole string"


def _joined(stretches: DataFrame) -> DataFrame:
    """The cheapest way through all stretches of a conversation: a row per stretch with its audit.

    The first stretch of a conversation has its ``illegal`` and ``cost`` summed, and the ``whole`` audit."""

    def solve(conv, rows: list[tuple]) -> list[tuple]:
        parts: dict[int, list[tuple]] = {}
        for r in rows:
            parts.setdefault(r[1], []).append(r)
        ways = {0: (0, "", [])}  # top -> cost, audit, the audit of each stretch
        illegal, before = 0, None
        for part in sorted(parts):
            ways_on: dict[int, tuple] = {}
            for r in parts[part]:
                top = ENTRIES[r[8]][-1]
                if top in ways:
                    cost, audit, steps = ways[top]
                    new = (cost + r[10], audit + r[11], [*steps, r[11]])
                    if r[9] not in ways_on or new[:2] < ways_on[r[9]][:2]:
                        ways_on[r[9]] = new
            ways = ways_on
            one = parts[part][0]
            illegal += one[7] + (before is not None and before + one[5] not in ("su", "ua", "au"))
            before = one[6]
        # The end: insertions after the last row lead to a top that accepts.
        best = None
        for top, (cost, audit, steps) in ways.items():
            for end in with_inserts(entered([e[-1] for e in ENTRIES].index(top))).values():
                new = (cost + end[0], audit + end[1], steps[:-1] + [steps[-1] + end[1]])
                if end[2] in ACCEPT and (best is None or new[:2] < best[:2]):
                    best = new
        out = []
        for k, part in enumerate(sorted(parts)):
            _, _, turn, role, digest = parts[part][0][:5]
            out.append((conv, turn, role, digest, illegal if k == 0 else 0, best[0] if k == 0 else 0, best[2][k], best[1] if k == 0 else None))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        out: list[tuple] = []
        for r in _rows_of(batches):
            if held and held[0][0] != r[0]:
                out += solve(held[0][0], held)
                held = []
                if len(out) > 5_000:
                    yield _frame(out, _JOINED)
                    out = []
            held.append(r)
        if held:
            out += solve(held[0][0], held)
        yield _frame(out, _JOINED)

    return stretches.repartition("conv_id").sortWithinPartitions("conv_id").mapInPandas(run, _JOINED)


_TURNS = "conv_id long, position long, edit string, role string, text string"


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """``conv_id, position, edit, role, text`` of each edit, in order; a deleted row has its own role and text."""
    conv, started, audit, at, upto, position = None, False, "", 0, 0, 0
    before = ""

    def inserted() -> Iterator[tuple]:
        nonlocal at, before, position
        while at < upto and audit[at] == "I":
            before = "a" if before == "u" else "u"
            position += 1
            at += 1
            yield conv, position, "I", ROLES[before], ""

    for conv_id, turn, role, digest, text, letters in _rows_of(batches):
        if not started or conv_id != conv or letters is not None:
            if started:
                yield from inserted()
            if not started or conv_id != conv:
                conv, position, before, started = conv_id, 0, "", True
        if letters is not None:
            audit, at, upto = letters, 0, len(letters)
            continue
        yield from inserted()
        edit = audit[at]
        at += 1
        position += 1
        if edit == "R":
            before = "a" if before == "u" else "u"
            role = ROLES[before]
        elif edit == "K":
            before = role[:1]
        yield conv, position, edit, role, text
    if started:
        yield from inserted()


def _ordered(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows with their texts behind the audit of their stretch, a conversation's rows in order in one part."""
    texts = rows.select(*_ORDER[:3], _digest(F.col("text")).alias("digest"), "text", F.lit(None).cast("string").alias("audit"))
    audits = joined.select(*_ORDER, F.lit(None).cast("string").alias("text"), "audit")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("audit").isNull()]
    return audits.unionAll(texts).repartition("conv_id").sortWithinPartitions(*order)


def _turns(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """The repaired turns (deleted rows as well, with edit D)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for r in _edited(batches):
            out.append(r)
            if len(out) >= 2_000:
                yield _frame(out, _TURNS)
                out = []
        yield _frame(out, _TURNS)

    return _ordered(rows, joined).mapInPandas(run, _TURNS)


def _hashes(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: the hash reads one turn after another."""
    schema = "conv_id long, repaired_sha256 string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        conv, made, empty = None, None, True
        for conv_id, _, edit, role, text in _edited(batches):
            if made is None or conv_id != conv:
                if made is not None:
                    out.append((conv, made.hexdigest()))
                conv, made, empty = conv_id, hashlib.sha256(), True
            if edit != "D":
                made.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                empty = False
            if len(out) >= 10_000:
                yield _frame(out, schema)
                out = []
        if made is not None:
            out.append((conv, made.hexdigest()))
        yield _frame(out, schema)

    return _ordered(rows, joined).mapInPandas(run, schema)


def _parsed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    narrow = staged(_narrow(rows), "turns")
    return narrow, staged(_joined(_stretches(narrow)), "audits")


def _plain(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")


def repaired(rows: DataFrame) -> DataFrame:
    """The edit of every row and the inserted turns: ``conv_id, position, edit, role, text``; rows with edit D are gone."""
    rows = _plain(rows).select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    return _turns(rows, _parsed(rows)[1])


def report(rows: DataFrame, damage: bool = True) -> DataFrame:
    """A row per original ``conv_id``: gaps and faults of its rows (after damage), cost and audit of the repair, its hash."""
    rows = _plain(rows)
    ids = rows.select("conv_id").distinct()
    rows = damaged(rows) if damage else rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    narrow, joined = _parsed(rows)
    by_turn = narrow.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("fault") == BLANK, F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == SEEN, F.col("copies")).when(F.col("fault") == BLANK, 0).otherwise(F.col("copies") - 1)).alias("duplicate"),
        F.sum((F.col("fault") == TRUNCATED).cast("long")).alias("truncated"))
    counts = by_turn.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    ways = joined.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.max("whole").alias("audit"))
    parts = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}

    # A null conv_id is a conversation as well, so the parts are united and grouped, not joined.
    def column(name: str, default, have: DataFrame) -> Column:
        kind = "string" if isinstance(default, str) else "long"
        return (F.col(name) if name in have.columns else F.lit(None)).cast(kind).alias(name)

    tables = [ids, counts, ways, _hashes(rows, joined)]
    union = reduce(DataFrame.unionAll, [t.select("conv_id", *(column(n, d, t) for n, d in parts.items())) for t in tables])
    out = union.groupBy("conv_id").agg(*(F.max(n).alias(n) for n in parts))
    return out.select("conv_id", *(F.coalesce(F.col(n), F.lit(d)).alias(n) for n, d in parts.items()))
