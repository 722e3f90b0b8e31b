"""Conversations repaired piece by piece against a plain search over whole conversations."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = {}
    for c, t, r, x in rows:
        own = out.setdefault(c, [])
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            own += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    for own in out.values():
        own.sort(key=lambda z: (z[0] is not None, z[0] or 0, z[1], hashlib.md5(z[2].encode()).hexdigest()))
    return out


def plain(rows):
    """Counts, cost, audit and hash by a search that holds the whole cheapest, least audit of every suffix and state."""
    faults, seen = [], set()
    for _, r, x in rows:
        y = x.strip(SPACES)
        faults.append("b" if not y else "d" if (r, x) in seen else "t" if y[-1] not in ".!?" else "")
        seen.add((r, x))
    best = [[None] * 4 for _ in range(len(rows) + 1)]
    for i in range(len(rows), -1, -1):
        for q in range(4):
            found = [(0, "", [])] if i == len(rows) and q in (0, 3) else []
            if i < len(rows):
                _, r, x = rows[i]
                extra = 3 if faults[i] == "t" else 0
                ways = [(4, "D", [], q)]
                if faults[i] not in ("b", "d"):
                    ways += [(3 + extra, "R", [f"{ROLE[q]}:{x}"], NEXT[q])]
                    ways += [(extra, "K", [f"{r}:{x}"], KEEP[q, r[:1]])] if (q, r[:1]) in KEEP else []
                found = [(k + b[0], a + b[1], o + b[2]) for k, a, o, p in ways if (b := best[i + 1][p])]
            best[i][q] = min(found, key=lambda z: z[:2]) if found else None
        for _ in range(3):
            for q in range(4):
                if b := best[i][NEXT[q]]:
                    way = (3 + b[0], "I" + b[1], [f"{ROLE[q]}:", *b[2]])
                    if best[i][q] is None or way[:2] < best[i][q][:2]:
                        best[i][q] = way
    cost, audit, out = best[0][0]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def conversations():
    rnd, rows = random.Random(5), []
    for c in [*range(60), None]:
        for i in range(400 if c == 7 else rnd.choice([1, 2, 5, 8, 40, 3])):
            rows.append((c, rnd.choice([None, i, i, i, i + rnd.randint(0, 3)]),
                         rnd.choice(["user", "assistant", "system", "tool", None, "u", "", "assistant", "user"]),
                         rnd.choice(["Hi.", "Hi", "  ", None, "Why?", f"x!{i}", f"word{i}", "ok. "])))
    rows += [(100, i, "tool", f"t{i}.") for i in range(300)]  # never converges
    rows += [(101, i % 3, "user", "same.") for i in range(200)]
    rows += [(102, i, ("user", "assistant")[i % 2], f"z{i}.") for i in range(300)]
    return rows


@pytest.mark.parametrize("piece_rows,passes", [(4096, 4), (7, 4), (3, 0), (20, 1), (1, 30)])
def test_pieces_give_what_whole_conversations_give(spark, piece_rows, passes):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r[0]: tuple(r[1:]) for r in repair.repair_conversations(df, True, piece_rows, passes).collect()}
    assert got == {c: plain(own) for c, own in damaged(rows).items()}


def test_whole_table(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    got = {r[0]: tuple(r[1:]) for r in repair.repair_conversations(table, damage=True).collect()}
    assert got == {c: plain(own) for c, own in damaged([tuple(r) for r in table.collect()]).items()}


def test_vectors_converge_and_stop_early():
    codes = bytes([1, 2] * 50)
    near, far = repair.END, (0, 3, 0, 3)
    begin = repair.backward(codes, near)[0]
    assert repair.fix_up(codes, near, begin, far) == repair.backward(codes, far)[0] == begin


def test_rows_are_the_repaired_conversation(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "No end"), (1, 2, "user", ""), (1, 3, "user", "Yes?")]
    pieces = repair.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("piece").collect()
    found = [(r["role"], r["text"]) for p in pieces for r in p["rows"]]
    assert "".join(p["audit"] for p in pieces) == plain([r[1:] for r in rows])[6]
    assert [r[:1] for r, _ in found] == ["u", "a"] * (len(found) // 2)


def test_awkward_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair_conversations(empty, damage=True).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    alone = spark.createDataFrame([(dropped, 0, "user", "Gone.")], SCHEMA)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert [tuple(r) for r in repair.repair_conversations(alone, damage=True).collect()] == [(dropped, *nothing)]
    nulls = spark.createDataFrame([(None, None, None, None)] * 3 + [(2, 1, "user", "x" * 5_000_000 + ".")] * 2, SCHEMA)
    clashing = nulls.withColumns({"piece": F.lit("p"), "a.b": F.lit(1), "kind": F.lit(0), "rows": F.lit(0)})
    got = {r[0]: tuple(r[1:]) for r in repair.repair_conversations(clashing).collect()}
    rows = {None: [(None, " ", " ")] * 3, 2: [(1, "user", "x" * 5_000_000 + ".")] * 2}
    assert got == {c: plain(own) for c, own in rows.items()}
