"""Structure repair of conversations against a plain search over whole audits."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from riskloom.llm import structure_repair
from riskloom.llm.structure_repair import (AuditNodes, audit_digests, best_audits, conversation_audits, op13_structure_repair,
                                           repaired_conversations)

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLES = {"u": "user", "a": "assistant"}


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest())


def faults_by_hand(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def audit_by_hand(initials, faults):
    """Least (cost, audit) of all edits, from every place and state to the end."""
    @functools.cache
    def best(i, state, inserts):
        found = [(0, "")] if i == len(initials) and state in ("", "a") else []
        if inserts < 3:
            cost, audit = best(i, NEXT[state], inserts + 1)
            found.append((cost + 2, "I" + audit))
        if i < len(initials):
            cost, audit = best(i + 1, state, 0)
            found.append((cost + 3, "D" + audit))
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                if initials[i] == NEXT[state] or (initials[i] == "s" and state == ""):
                    cost, audit = best(i + 1, initials[i], 0)
                    found.append((cost + extra, "K" + audit))
                cost, audit = best(i + 1, NEXT[state], 0)
                found.append((cost + 2 + extra, "R" + audit))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def repair_by_hand(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest, repaired rows) of rows after damage."""
    rows = sorted(rows, key=order)
    faults, initials = faults_by_hand(rows), [r[1][:1] for r in rows]
    cost, audit = audit_by_hand(initials, faults)
    state, out, at = "", [], iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(at)[1:]
        if edit == "D":
            continue
        state = role[:1] if edit == "K" else NEXT[state]
        out.append((role if edit == "K" else ROLES[state], text, edit))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0][0] for r in out))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), out


def damage_by_hand(conv, turn, role, text):
    role, text = (" " if v is None else v for v in (role, text))
    fault = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
    row = (turn, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)
    return [row] * (0 if fault == 0 else 2 if fault == 3 else 1)


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def by_conversation(rows):
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(tuple(row))
    return groups


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    folder, want = f"/root/testdata/{sf}", {}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        want.setdefault(r.conv_id, []).extend(damage_by_hand(*r))
    want = {c: repair_by_hand(rows)[0] for c, rows in want.items()}
    got = {r.conv_id: tuple(r[c] for c in [*COLUMNS, "repaired_sha256"]) for r in op13_structure_repair(spark, folder).collect()}
    assert got == want


def random_rows(rng, size):
    return [(rng.choice([None, *range(12)]), rng.choice(["system", "user", "assistant", "assistant", "user", "tool", "", "s"]),
             rng.choice(["Yes.", "No!", "cut", "", " \t", "x. ", "end?\n", f"text {rng.randrange(9)}."])) for _ in range(size)]


def test_random_conversations(spark):
    rng = random.Random(11)
    groups = {c: random_rows(rng, rng.randrange(1, 14)) for c in [None, *range(400)]}
    rows = spark.createDataFrame([(c, *r) for c, group in groups.items() for r in group], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r[c] for c in [*COLUMNS, "repaired_sha256"]) for r in audit_digests(rows).collect()}
    assert got == {c: repair_by_hand(group)[0] for c, group in groups.items()}
    audits = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in conversation_audits(rows).collect()}
    assert audits == {c: v[:-1] for c, v in got.items()}
    left = {}
    for r in sorted(repaired_conversations(rows).collect(), key=lambda r: (r.conv_id is not None, r.conv_id, r.position)):
        left.setdefault(r.conv_id, []).append((r.role, r.text, r.edit))
    assert left == {c: v for c, group in groups.items() if (v := repair_by_hand(group)[1])}


def test_conversation_over_many_tasks(spark):
    """One conversation with most rows: cut over range partitions and blocks, and put together again."""
    rng = random.Random(3)
    groups = {7: [(t, rng.choice(["user", "assistant"]), f"t{rng.randrange(3000)}{rng.choice('. ')}") for t in range(9000)],
              8: random_rows(rng, 10), 6: random_rows(rng, 10)}
    rows = spark.createDataFrame([(c, *r) for c, group in groups.items() for r in group], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r[c] for c in [*COLUMNS, "repaired_sha256"]) for r in audit_digests(rows).collect()}
    for conv in (6, 8):
        assert got[conv] == repair_by_hand(groups[conv])[0]
    ordered = sorted(groups[7], key=order)
    faults = faults_by_hand(ordered)
    kinds = [structure_repair.MUST_GO if f in ("blank", "duplicate") else structure_repair.CUT if f else structure_repair.SOUND for f in faults]
    best = best_audits([(r[1][:1], k) for r, k in zip(ordered, kinds)], structure_repair.NOTHING)
    assert got[7][5:7] == min(best[s] for s in (structure_repair.NOTHING, structure_repair.ASSISTANT))
    assert got[7][:4] == (0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")))


def test_short_blocks(spark, monkeypatch):
    """Blocks of three rows in one task, without Spark: the same audits."""
    monkeypatch.setattr(structure_repair, "BLOCK_ROWS", 3)
    monkeypatch.setattr(structure_repair.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 0})())
    import pyarrow as pa
    rng = random.Random(5)
    for size in range(1, 30):
        rows = sorted(random_rows(rng, size), key=order)
        faults, seen, marked = faults_by_hand(rows), set(), []
        for (turn, role, text), fault in zip(rows, faults):
            solid = text.strip(" \t\n\x0b\x0c\r")
            marked.append({"conv_id": 1, "turn": turn, "role": role, "copies": 1, "blank": not solid, "cut": solid[-1:] not in (".", "!", "?"),
                           "seen": (role, text) in seen})
            seen.add((role, text))
        kinds = [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("copies", pa.int64()),
                 ("blank", pa.bool_()), ("cut", pa.bool_()), ("seen", pa.bool_())]
        segments = structure_repair._segments(iter([pa.RecordBatch.from_pylist(marked, pa.schema(kinds))]))
        (found,) = [r for b in structure_repair._composed(segments) for r in b.to_pylist()]
        assert tuple(found[c] for c in COLUMNS) == repair_by_hand(rows)[0][:-1]


def test_audit_nodes_compare_as_text(monkeypatch):
    rng = random.Random(2)
    for modulus in (structure_repair.MODULUS, 3):  # with a modulus of 3 most hashes collide, and are verified
        monkeypatch.setattr(structure_repair, "MODULUS", modulus)
        nodes = AuditNodes()
        for _ in range(300):
            nodes.add(rng.randrange(len(nodes.edit)) if rng.random() < .5 else len(nodes.edit) - 1, rng.choice("DIKR"))
        texts = [nodes.text(i) for i in range(len(nodes.edit))]
        for _ in range(5000):
            a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
            assert nodes.less(a, b) == (texts[a] < texts[b])


def test_odd_tables(spark):
    kinds = "conv_id long, turn long, role string, text string, digest int, copies int, audit string, seen int, text_sha int"
    odd = spark.createDataFrame([
        (None, None, None, None, 1, 1, "x", 1, 1), (None, 3, "user", "Hello.", 1, 1, "x", 1, 1), (1, 2, "user", "long " * 50_000 + ".", 1, 1, "x", 1, 1),
        (1, 2, "user", "long " * 50_000 + ".", 1, 1, "x", 1, 1), (1, None, "assistant", "É 漢字 😀!", 1, 1, "x", 1, 1), (2, 5, "", "", 1, 1, "x", 1, 1),
        (-3, -2, "system", "Be kind.", 1, 1, "x", 1, 1), (-3, 2, "user", "Hi.", 1, 1, None, 1, 1)], kinds)
    got = {r.conv_id: tuple(r[c] for c in [*COLUMNS, "repaired_sha256"]) for r in audit_digests(odd).collect()}
    want = by_conversation([(r.conv_id, r.turn, " " if r.role is None else r.role, " " if r.text is None else r.text) for r in odd.collect()])
    assert got == {c: repair_by_hand(rows)[0] for c, rows in want.items()}
    for made in (conversation_audits, audit_digests, repaired_conversations):
        assert made(odd.where("false")).collect() == []
