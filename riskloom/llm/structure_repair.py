"""Structure repair of conversations: the cheapest edits, found over persistent audit nodes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import partitions, small_batches, table, written

#: where the roles so far may stand: nothing yet, after the system row, after a user's, after an assistant's
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: the state after a kept row of some role initial, and after an inserted row or one of changed role
KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
EDITED = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1
#: faults of a row: it has to go, or costs one where it stays
SOUND, MUST_GO, CUT = range(3)
LEGAL = {"su", "ua", "au"}
#: rows of a conversation that are solved together
BLOCK_ROWS = 4096
MODULUS, BASE = (1 << 61) - 1, 0x1D3B5A7F9E2C4681

_ORDER = ["conv_id", "turn", "role", "digest"]
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
SEGMENT = ("conv_id long, part int, block long, blank long, duplicate long, truncated long, illegal long, first_initial string, "
           "last_initial string, low_turn long, high_turn long, turns long, "
           "audits array<struct<from: int, to: int, cost: long, audit: string>>")
AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPAIRED = "conv_id long, position long, role string, text string, edit string"


class AuditNodes:
    """Audits as paths from node 0; audits with a common beginning share its nodes.

    A node holds its edit, its depth, the rolling hash of the edits up to it, and its ancestors 1, 2, 4, ... steps up.
    """

    def __init__(self) -> None:
        self.edit, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, parent: int, edit: str) -> int:
        node, ancestors = len(self.edit), [parent]
        while len(self.up[ancestors[-1]]) >= len(ancestors):
            ancestors.append(self.up[ancestors[-1]][len(ancestors) - 1])
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * BASE + ord(edit)) % MODULUS)
        self.up.append(ancestors)
        return node

    def lift(self, node: int, depth: int) -> int:
        """The ancestor of a node at a depth."""
        steps = self.depth[node] - depth
        while steps:
            j = steps.bit_length() - 1
            node, steps = self.up[node][j], steps - (1 << j)
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth spell the same edits; equal hashes are verified edit by edit."""
        if a == b:
            return True
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the edits of ``a`` come before those of ``b`` as text, by their longest common beginning."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lift(a, depth), self.lift(b, depth)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        for j in range(len(self.up[x]) - 1, -1, -1):
            if j < len(self.up[x]) and not self.same(self.up[x][j], self.up[y][j]):
                x, y = self.up[x][j], self.up[y][j]
        return self.edit[x] < self.edit[y]

    def text(self, node: int) -> str:
        edits = []
        while node:
            edits.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(edits))


def best_audits(rows: list[tuple[str, int]], start: int) -> dict[int, tuple[int, str]]:
    """By final state the least cost and, of all audits with it, the first as text, for rows (role initial, fault).

    An audit leads from one state through given rows to one state only, so of two audits that tie neither begins
    with the other, and the one that comes first stays first whatever follows.
    """
    nodes = AuditNodes()

    def offer(into: dict, state: int, cost: int, parent: int, edit: str) -> bool:
        known = into.get(state)
        if known is not None and known[0] < cost:
            return False
        node = nodes.add(parent, edit)
        if known is not None and known[0] == cost and not nodes.less(node, known[1]):
            return False
        into[state] = (cost, node)
        return True

    def insert(into: dict) -> dict:
        changed = True
        while changed:
            changed = False
            for state, (cost, node) in list(into.items()):
                changed |= offer(into, EDITED[state], cost + INSERT_COST, node, "I")
        return into

    best = insert({start: (0, 0)})
    for initial, fault in rows:
        after: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in best.items():
            offer(after, state, cost + DELETE_COST, node, "D")
            if fault != MUST_GO:
                stays = cost + (TRUNCATED_COST if fault == CUT else 0)
                if (kept := KEPT.get((state, initial))) is not None:
                    offer(after, kept, stays, node, "K")
                offer(after, EDITED[state], stays + REROLE_COST, node, "R")
        best = insert(after)
    return {state: (cost, nodes.text(node)) for state, (cost, node) in best.items()}


class _Block:
    """Rows of one conversation that lie together, and what they count."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, int]] = []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, role: str, blank: bool, seen: bool, cut: bool) -> None:
        initial, legal = role[:1], not self.rows or self.rows[-1][0] + role[:1] in LEGAL
        kind = "blank" if blank else "duplicate" if seen else "truncated" if cut else None
        if kind:
            self.counts[kind] += 1
        self.counts["illegal"] += not legal
        self.rows.append((initial, CUT if kind == "truncated" else MUST_GO if kind else SOUND))
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def segment(self, conv, part: int, block: int, whole: bool) -> dict:
        starts = [NOTHING] if whole else range(4)
        audits = [{"from": s, "to": e, "cost": c, "audit": a} for s in starts for e, (c, a) in best_audits(self.rows, s).items()]
        return {"conv_id": conv, "part": part, "block": block, **self.counts, "first_initial": self.rows[0][0],
                "last_initial": self.rows[-1][0], "low_turn": self.low, "high_turn": self.high, "turns": self.turns, "audits": audits}


_TEXT, _LONG = pa.string(), pa.int64()
_SEGMENT = pa.schema([
    ("conv_id", _LONG), ("part", pa.int32()), ("block", _LONG), *((c, _LONG) for c in _COUNTS), ("first_initial", _TEXT),
    ("last_initial", _TEXT), ("low_turn", _LONG), ("high_turn", _LONG), ("turns", _LONG),
    ("audits", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", _LONG), ("audit", _TEXT)])))])
_AUDIT = pa.schema([("conv_id", _LONG), ("gaps", _LONG), *((c, _LONG) for c in _COUNTS), ("cost", _LONG), ("audit", _TEXT)])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered rows to solved blocks. The first and the last conversation of a task may go on in another task, and a
    long one in the next block; these are solved from every state that the rows before may leave."""
    part, conv, first, number, block, out = TaskContext.get().partitionId(), None, True, 0, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if block is None or row["conv_id"] != conv:
                if block is not None:
                    out.append(block.segment(conv, part, number, not first and number == 0))
                    first = False
                conv, number, block = row["conv_id"], 0, _Block()
            for copy in range(row["copies"]):
                if len(block.rows) == BLOCK_ROWS:
                    out.append(block.segment(conv, part, number, False))
                    number, block = number + 1, _Block()
                block.add(row["turn"], row["role"], row["blank"], row["seen"] or copy > 0, row["cut"])
        yield pa.RecordBatch.from_pylist(out, _SEGMENT)
        out = []
    if block is not None:
        yield pa.RecordBatch.from_pylist([block.segment(conv, part, number, False)], _SEGMENT)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a conversation, one after the other, to its cheapest audit."""
    done = None

    def finished() -> dict:
        cost, audit = min(done["best"][s] for s in (NOTHING, ASSISTANT) if s in done["best"])
        gaps = done["high"] - done["low"] + 1 - done["turns"] if done["low"] is not None else 0
        return {"conv_id": done["conv_id"], "gaps": gaps, **{c: done[c] for c in _COUNTS}, "cost": cost, "audit": audit}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if done is None or done["conv_id"] != row["conv_id"]:
                if done is not None:
                    out.append(finished())
                done = {"conv_id": row["conv_id"], "best": {NOTHING: (0, "")}, "low": None, "high": None, "turns": 0,
                        "last": None, **dict.fromkeys(_COUNTS, 0)}
            after: dict[int, tuple[int, str]] = {}
            for step in row["audits"]:
                if step["from"] in done["best"]:
                    cost, audit = done["best"][step["from"]]
                    offered = cost + step["cost"], audit + step["audit"]
                    after[step["to"]] = min(after.get(step["to"], offered), offered)
            done["best"] = after
            for c in _COUNTS:
                done[c] += row[c]
            done["illegal"] += done["last"] is not None and done["last"] + row["first_initial"] not in LEGAL
            done["last"] = row["last_initial"]
            if row["low_turn"] is not None:
                done["turns"] += row["turns"] - (row["low_turn"] == done["high"])
                done["low"], done["high"] = row["low_turn"] if done["low"] is None else done["low"], row["high_turn"]
        yield pa.RecordBatch.from_pylist(out, _AUDIT)
    if done is not None:
        yield pa.RecordBatch.from_pylist([finished()], _AUDIT)


def _text_rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    named = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        text(role_col).alias("role"), text(text_col).alias("text"))
    return named.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _marked(rows: DataFrame) -> DataFrame:
    """Different rows of a conversation without their texts: copies, blank, cut (no end mark), seen (in an earlier turn)."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    different = rows.groupBy(*_ORDER).agg(F.count(F.lit(1)).alias("copies"), F.first(blank).alias("blank"), F.first(cut).alias("cut"))
    different = written(different, "turns")
    placed = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = different.groupBy("conv_id", "role", "digest").agg(F.min(placed).alias("first"), F.count(F.lit(1)).alias("places"))
    again = written(again.where("places > 1").select(*(F.col(c).alias(f"of_{c}") for c in ("conv_id", "role", "digest")), "first"),
                    "repeated-turns")
    same = F.col("conv_id").eqNullSafe(F.col("of_conv_id")) & (F.col("role") == F.col("of_role")) & (F.col("digest") == F.col("of_digest"))
    seen = F.coalesce(F.col("first") < placed, F.lit(False))
    return different.join(again, same, "left").select(*_ORDER, "copies", "blank", "cut", seen.alias("seen"))


def _audits(text_rows: DataFrame) -> DataFrame:
    spark = text_rows.sparkSession
    rows = written(_marked(text_rows), "marked-turns")
    ordered = rows.repartitionByRange(partitions(spark), *_ORDER).sortWithinPartitions(*_ORDER)
    segments = ordered.select("conv_id", "turn", "role", "copies", "blank", "cut", "seen").mapInArrow(_segments, SEGMENT)
    lined = segments.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "part", "block")
    return lined.mapInArrow(_composed, AUDIT)


def conversation_audits(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                        text_col: str = "text") -> DataFrame:
    """The cheapest structure repair of every conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    Rows of a conversation are taken by turn (nulls first; then by role and the digest of the text). A row is blank,
    or a duplicate of an earlier row's role and text, or truncated (its last character that isn't blank ends no sentence);
    gaps counts turns that are missing between the first and the last, illegal the neighbours whose roles may not follow each other. The
    audit's letters are Keep (0), Rerole to user or assistant (2), Delete (3; what blank rows and duplicates need) and
    Insert of an empty user's or assistant's row (2); a truncated row that stays costs 1. What is left begins with a
    system row or not and goes on user, assistant, user, ... assistant, or is empty. Of audits with the least cost the first in
    ASCII order is taken.

    Only digests, marks and roles are shuffled. Rows are dealt out by ranges of (conversation, turn), so a conversation of
    any size is cut, each piece is solved from all four states, and pieces are put together; copies are counted first.

    Null roles and texts count as one blank; a null conv_id is a conversation; null turns are no gaps; repeated
    rows are duplicates; an empty table gives no rows. Other columns are not read.
    """
    small_batches(rows.sparkSession)
    return _audits(_text_rows(rows, conv_col, turn_col, role_col, text_col))


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows that audits leave: (conversation, None) at each begin, then (conversation, role, text, edit)."""
    conv, state, edits = None, NOTHING, iter("")

    def inserted():
        nonlocal state
        for edit in edits:
            if edit != "I":
                return edit
            state = EDITED[state]
            yield conv, ROLE[state], "", edit

    opened = False
    for batch in batches:
        for row in batch.to_pylist():
            if row["audit"] is not None:
                if opened:
                    yield from inserted()
                conv, state, edits, opened = row["conv_id"], NOTHING, iter(row["audit"]), True
                yield conv, None, row, None
                continue
            edit = yield from inserted()
            if edit == "K":
                state = KEPT[state, row["role"][:1]]
                yield conv, row["role"], row["text"], edit
            elif edit == "R":
                state = EDITED[state]
                yield conv, ROLE[state], row["text"], edit
    if opened:
        yield from inserted()


_DIGESTS = pa.schema([*_AUDIT, ("repaired_sha256", _TEXT)])
_REPAIRED = pa.schema([("conv_id", _LONG), ("position", _LONG), ("role", _TEXT), ("text", _TEXT), ("edit", _TEXT)])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, head, sha, empty = [], None, None, True
    for _, role, content, _ in _edits(batches):
        if role is None:
            if head:
                out.append({**head, "repaired_sha256": sha.hexdigest()})
            head, sha, empty = {c: content[c] for c in _AUDIT.names}, hashlib.sha256(), True
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist(out, _DIGESTS)
                out = []
        else:
            sha.update(f"{'' if empty else chr(10)}{role}:{content}".encode())
            empty = False
    if head:
        out.append({**head, "repaired_sha256": sha.hexdigest()})
    yield pa.RecordBatch.from_pylist(out, _DIGESTS)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, position, size = [], 0, 0
    for conv, role, text, edit in _edits(batches):
        if role is None:
            position = 0
            continue
        out.append({"conv_id": conv, "position": position, "role": role, "text": text, "edit": edit})
        position, size = position + 1, size + len(text)
        if len(out) == 1000 or size > 1 << 22:
            yield pa.RecordBatch.from_pylist(out, _REPAIRED)
            out, size = [], 0
    yield pa.RecordBatch.from_pylist(out, _REPAIRED)


def _audits_before_rows(text_rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation in one task: its audit, then its rows in order. They are read as a stream, never held together."""
    spark = text_rows.sparkSession
    head = audits.select("conv_id", *(F.lit(None).cast(t).alias(c) for c, t in (
        ("turn", "long"), ("role", "string"), ("text", "string"), ("digest", "binary"))), *audits.columns[1:])
    body = text_rows.select("*", *(F.lit(None).cast(t).alias(c) for c, t in audits.dtypes[1:]))
    both = head.unionByName(body).withColumn("is_row", F.col("audit").isNull())
    both = both.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "is_row", *_ORDER[1:])
    return both.drop("is_row", "digest", "turn")


def audit_digests(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``conversation_audits`` with repaired_sha256, of the lines "role:text" that the audit leaves. A digest needs its
    rows one after the other, so a conversation's texts pass through one task, as a stream."""
    small_batches(rows.sparkSession)
    text_rows = _text_rows(rows, conv_col, turn_col, role_col, text_col)
    return _audits_before_rows(text_rows, written(_audits(text_rows), "audits")).mapInArrow(_digests, f"{AUDIT}, repaired_sha256 string")


def repaired_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                           text_col: str = "text") -> DataFrame:
    """The conversations after ``conversation_audits``: conv_id, position (from 0), role, text, edit (K, R or I)."""
    small_batches(rows.sparkSession)
    text_rows = _text_rows(rows, conv_col, turn_col, role_col, text_col)
    return _audits_before_rows(text_rows, written(_audits(text_rows), "audits")).mapInArrow(_repaired, REPAIRED)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults by the checksum of "conv_id:turn": a row of twenty is dropped, emptied,
    loses its end marks, comes twice, or becomes a user's."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault"))
    rows = rows.where("fault != 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def op13_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    found = audit_digests(damaged(conversations)).withColumnRenamed("conv_id", "of_conv_id")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("of_conv_id")), "left")
    return joined.select("conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *_COUNTS, "cost")),
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
