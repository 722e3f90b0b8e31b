"""Repair of conversations by cheapest edits: parallel Viterbi by rank convergence (Maleki et al., 2014).

Roles must read ``(s?(ua)+)?``. The cost from each of four states to the end of a conversation is a vector that every
row changes by a (min, +) product; after few rows vectors from different ends differ by a constant only. Rows are sorted
and cut into pieces wherever they lie; a piece starts from a speculative vector, and fix-up passes run it again from the
vector of the piece behind it, up to the row where both differ by a constant, until no piece has another vector to
start from. The stitched vectors then drive the trace of the least audit, piece by piece.

Only conversations on the edge of a partition, or longer than a piece, go through that; all others are one piece and
are settled where they were sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark.llm.shared import keep

#: Costs of edits, and of a truncated row that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows and bytes of text that a piece has at most (a longer row is a piece of its own).
PIECE_ROWS, PIECE_BYTES = 4096, 4 << 20
#: Fix-up passes; pieces whose vectors still do not converge are chained by the products of their rows.
PASSES = 4
SPACES = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]

# States: nothing yet, after a system row, after a user row, after an assistant row. By state the state after the row
# that must come, and by state and initial the state after a row that is kept.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_KEEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
_INITIALS = {"s": 0, "u": 1, "a": 2}
_OTHER, _CUT, BLANK, DUPLICATE = 3, 4, 8, 9  # codes: initial, plus 4 if truncated; or a row to be deleted
_FAR = 1 << 40
END: Vector = (0, 6, 3, 0)

LONG, LONGS = pa.int64(), pa.list_(pa.int64())
PIECES = pa.schema({
    "conv_id": LONG, "piece": LONG, "whole": pa.bool_(), "codes": pa.binary(), "digests": pa.binary(),
    "rows": pa.list_(pa.struct({"role": pa.string(), "text": pa.string()})), "audit": pa.string(), "cost": LONG,
    "illegal": LONG, "first": pa.string(), "last": pa.string(), "low": LONG, "high": LONG, "turns": LONG,
    "first_turn": LONG, "last_turn": LONG})
FOLDED = pa.schema({
    "conv_id": LONG, "gaps": LONG, "blank": LONG, "duplicate": LONG, "truncated": LONG, "illegal": LONG, "cost": LONG,
    "audit": pa.string(), "repaired_sha256": pa.string()})


def _closed(v: Iterable[int]) -> Vector:
    """The same with insertions."""
    a, b, c, d = v
    c, d = min(c, INSERT + d), min(d, INSERT + c)
    return min(a, INSERT + c), min(b, INSERT + c), c, d


@lru_cache(maxsize=None)
def _before(after: Vector, code: int) -> Vector:
    """Costs from each state before a row of ``code``, given those after it (their least is 0)."""
    if code >= BLANK:
        return tuple(DELETE + x for x in after)
    extra = TRUNCATED if code & _CUT else 0
    return _closed(
        min(DELETE + after[q], REROLE + extra + after[_NEXT[q]],
            extra + after[_KEEP[q, code & 3]] if (q, code & 3) in _KEEP else _FAR) for q in range(4))


@lru_cache(maxsize=None)
def _step(after: Vector, code: int) -> tuple[Vector, int]:
    """:func:`_before` less its least cost, and that cost. Few vectors exist, so this is a table."""
    v = _before(after, code)
    least = min(v)
    return tuple(min(x - least, _FAR) for x in v), least


def backward(codes: bytes, end: Vector) -> list[Vector]:
    """The vector after each row, from that before the first row to ``end``; each up to a constant."""
    out = [end]
    for code in reversed(codes):
        out.append(_step(out[-1], code)[0])
    out.reverse()
    return out


def fix_up(codes: bytes, old_end: Vector, old_begin: Vector, end: Vector) -> Vector:
    """The vector before the first row from another ``end``: the run stops where both differ by a constant."""
    for code in reversed(codes):
        if old_end == end:
            return old_begin
        old_end, end = _step(old_end, code)[0], _step(end, code)[0]
    return end


@lru_cache(maxsize=None)
def _moves(after: Vector, code: int, state: int) -> tuple[str, int]:
    """The least letters of the cheapest edits at a row from ``state``, and the state behind it."""
    letters, costs = "", _before(after, code)
    while True:
        if DELETE + after[state] == costs[state]:
            return letters + "D", state
        if INSERT + costs[_NEXT[state]] == costs[state]:
            letters, state = letters + "I", _NEXT[state]
            continue
        extra = TRUNCATED if code & _CUT else 0
        kept = _KEEP.get((state, code & 3))
        if kept is not None and extra + after[kept] == costs[state]:
            return letters + "K", kept
        return letters + "R", _NEXT[state]


def _tail(state: int) -> tuple[str, int]:
    """Insertions that end a conversation."""
    letters = {0: "", 1: "II", 2: "I", 3: ""}[state]
    return letters, 3 if letters else state


def exits(codes: bytes, end: Vector) -> list[int]:
    """The state behind a piece for each state before it."""
    vectors, out = backward(codes, end), [0, 1, 2, 3]
    for i, code in enumerate(codes):
        out = [_moves(vectors[i + 1], code, q)[1] for q in out]
    return out


def trace(codes: bytes, rows: list[tuple[str, str]], end: Vector, state: int, last: bool) -> tuple[str, list[tuple], int]:
    """(audit, repaired rows, cost) of a piece entered in ``state``."""
    vectors, audit, out, cost = backward(codes, end), [], [], 0
    for i, code in enumerate(codes):
        letters, behind = _moves(vectors[i + 1], code, state)
        audit.append(letters)
        for letter in letters:
            if letter == "D":
                cost += DELETE
                continue
            if letter == "I":
                out.append((_ROLE[state], ""))
                cost += INSERT
            else:
                role, text = rows[i]
                out.append((role if letter == "K" else _ROLE[state], text))
                cost += (REROLE if letter == "R" else 0) + (TRUNCATED if code & _CUT else 0)
            state = _KEEP[state, code & 3] if letter == "K" else _NEXT[state]
    if last:
        for letter in _tail(state)[0]:
            audit.append(letter)
            out.append((_ROLE[state], ""))
            cost += INSERT
            state = _NEXT[state]
    return "".join(audit), out, cost


def row_code(role: str, text: str) -> int:
    """Code of a row that is no duplicate."""
    text = text.rstrip(SPACES)
    if not text:
        return BLANK
    return _INITIALS.get(role[:1], _OTHER) + (0 if text[-1] in ".!?" else _CUT)


def row_digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


class _Piece:
    """Rows of one conversation in order, as far as they are read."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.cut = conv_id, False
        self.clear()

    def clear(self) -> None:
        self.codes, self.rows, self.seen, self.size = bytearray(), [], set(), 0
        self.illegal, self.turns, self.first_turn, self.last_turn = 0, 0, None, None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if self.rows and self.rows[-1][0][:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        code = row_code(role, text)
        if code != BLANK:
            code = DUPLICATE if (role, text) in self.seen else code
            self.seen.add((role, text))
        self.codes.append(code)
        self.rows.append((role, text))
        self.size += len(text)
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def row(self, piece: int, whole: bool) -> dict:
        """This piece as a row of :data:`PIECES`: repaired if it is ``whole``, else as it was read."""
        codes, rows = bytes(self.codes), self.rows
        first, last = (rows[0][0][:1], rows[-1][0][:1]) if rows else (None, None)
        audit, cost, digests = None, None, None
        if whole:
            audit, rows, cost = trace(codes, rows, END, 0, True)
        else:  # rows that are no first of their kind have a digest of zeros
            digests = b"".join(row_digest(*r) if c < BLANK else bytes(16) for c, r in zip(codes, rows))
        return {
            "conv_id": self.conv_id, "piece": piece, "whole": whole, "codes": codes, "digests": digests,
            "rows": [{"role": r, "text": t} for r, t in rows], "audit": audit, "cost": cost, "illegal": self.illegal,
            "first": first, "last": last, "low": self.first_turn, "high": self.last_turn, "turns": self.turns,
            "first_turn": self.first_turn, "last_turn": self.last_turn}


def _batches(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches bounded in rows and text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("codes") or b"") + sum(len(r["text"]) for r in row.get("rows") or ())
        if len(held) >= 2000 or size >= PIECE_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _cut(batches: Iterator[pa.RecordBatch], most: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """Pieces of a sorted partition. Its first and last conversation may go on in others and are never whole."""
    base = TaskContext.get().partitionId() << 40

    def pieces() -> Iterator[dict]:
        here, number, first = None, base, True
        for batch in batches:
            for conv_id, turn, role, text, times in zip(*(c.to_pylist() for c in batch.columns)):
                if here is None or here.conv_id != conv_id:
                    if here is not None:
                        yield here.row(number, not (first or here.cut))
                        number, first = number + 1, False
                    here = _Piece(conv_id)
                for _ in range(times):
                    if here.rows and (len(here.rows) >= most or here.size + len(text) > PIECE_BYTES):
                        yield here.row(number, False)
                        number, here.cut = number + 1, True
                        here.clear()
                    here.add(turn, role, text)
        if here is not None:
            yield here.row(number, False)

    return _batches(pieces(), PIECES)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times): rows dropped (0 times), emptied, without end marks, doubled or made user rows.

    The crc32 of ``conv_id:turn`` decides; a null counts as one space there, in a role and in a text.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.col("text")
    return _plain(conversations).withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("times"))


def _plain(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(1).alias("times"))


def _duplicates(pieces: DataFrame) -> DataFrame:
    """(conv_id, piece, places): rows that an earlier piece of the conversation holds as well."""
    slots = F.sequence(F.lit(0), F.length("codes") - 1)
    each = pieces.where(F.length("codes") > 0).select(
        "conv_id", "piece", F.posexplode(F.transform(slots, lambda i: F.substring("digests", i * 16 + 1, F.lit(16)))).alias("at", "digest"))
    each = each.where(F.col("digest") != F.lit(bytes(16)))
    firsts = each.groupBy("conv_id", "digest").agg(F.min("piece").alias("home"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("other"), "digest", "home")
    return (
        each.join(firsts, F.col("conv_id").eqNullSafe(F.col("other")) & (each["digest"] == firsts["digest"])).where("piece <> home")
        .groupBy("piece").agg(F.collect_list("at").alias("places")))


def _mapped(df: DataFrame, function: Callable[..., dict], schema: pa.Schema) -> DataFrame:
    """Each row through ``function`` with its columns as arguments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((function(**r) for batch in batches for r in batch.to_pylist()), schema)

    return df.mapInArrow(run, from_arrow_schema(schema))


def _chained(df: DataFrame, start: Callable[[], object], function: Callable[..., tuple[dict, object]], schema: pa.Schema,
             descending: bool = False) -> DataFrame:
    """Each conversation's rows, one per piece, in order through ``function``, which hands a state on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            here, state = object(), None
            for batch in batches:
                for row in batch.to_pylist():
                    if row["conv_id"] != here:
                        here, state = row["conv_id"], start()
                    found, state = function(state, **row)
                    yield found

        return _batches(rows(), schema)

    order = F.col("piece").desc() if descending else F.col("piece")
    return df.repartition("conv_id").sortWithinPartitions("conv_id", order).mapInArrow(run, from_arrow_schema(schema))


def _speculate(piece: int, conv_id: int | None, codes: bytes) -> dict:
    live = any(c < BLANK for c in codes)
    return {"conv_id": conv_id, "piece": piece, "used": list(END), "begin": list(backward(codes, END)[0]) if live else None}


def _again(piece: int, codes: bytes, used: list[int], begin: list[int], wanted: list[int]) -> dict:
    return {"piece": piece, "used2": wanted, "begin2": list(fix_up(codes, tuple(used), tuple(begin), tuple(wanted)))}


def _matrix(conv_id: int | None, piece: int, codes: bytes) -> dict:
    """Costs through a piece from each state to each state."""
    columns = []
    for q in range(4):
        v, total = tuple(0 if p == q else _FAR for p in range(4)), 0
        for code in reversed(codes):
            v, cost = _step(v, code)
            total += cost
        columns.append([min(x + total, _FAR) for x in v])
    return {"conv_id": conv_id, "piece": piece, "costs": [columns[q][p] for p in range(4) for q in range(4)]}


def _through(state: Vector, conv_id: int | None, piece: int, costs: list[int]) -> tuple[dict, Vector]:
    v = [min(costs[4 * p + q] + state[q] for q in range(4)) for p in range(4)]
    return {"piece": piece, "wanted": list(state)}, tuple(x - min(v) for x in v)


def settled(codes: DataFrame, passes: int = PASSES) -> DataFrame:
    """(piece, wanted): the vector at the end of every piece, up to a constant, of (conv_id, piece, codes).

    A pass reruns the pieces whose successor begins with another vector than they were started from. Pieces of rows to
    be deleted change no vector and hand on what they get. Should vectors not converge within ``passes``, as over long
    stretches of rows of no known role, pieces become (min, +) products of 16 numbers that are multiplied up in order.
    """
    state = keep(_mapped(codes.select("piece", "conv_id", "codes"), _speculate,
                         pa.schema({"conv_id": LONG, "piece": LONG, "used": LONGS, "begin": LONGS})), "vectors")
    behind = Window.partitionBy("conv_id").orderBy(F.col("piece").desc()).rowsBetween(Window.unboundedPreceding, -1)
    end = F.array(*[F.lit(x).cast("long") for x in END])
    for done in range(passes + 1):
        wanted = state.withColumn("wanted", F.coalesce(F.last("begin", ignorenulls=True).over(behind), end))
        stale = wanted.where(F.col("begin").isNotNull() & (F.col("wanted") != F.col("used")))
        if stale.isEmpty():
            return wanted.select("piece", "wanted")
        if done == passes:
            break
        again = _mapped(stale.select("piece", "used", "begin", "wanted").join(codes.select("piece", "codes"), "piece").select(
            "piece", "codes", "used", "begin", "wanted"), _again, pa.schema({"piece": LONG, "used2": LONGS, "begin2": LONGS}))
        state = keep(state.join(again, "piece", "left").select(
            "conv_id", "piece", F.coalesce("used2", "used").alias("used"), F.coalesce("begin2", "begin").alias("begin")), "vectors")
    products = _mapped(codes.select("conv_id", "piece", "codes"), _matrix, pa.schema({"conv_id": LONG, "piece": LONG, "costs": LONGS}))
    return _chained(products, lambda: END, _through, pa.schema({"piece": LONG, "wanted": LONGS}), descending=True)


def _exits(conv_id: int | None, piece: int, codes: bytes, wanted: list[int]) -> dict:
    return {"conv_id": conv_id, "piece": piece, "wanted": wanted, "exits": exits(codes, tuple(wanted))}


def _entered(state: int, conv_id: int | None, piece: int, wanted: list[int], exits: list[int]) -> tuple[dict, int]:
    return {"piece": piece, "wanted": wanted, "entry": state}, exits[state]


def _marked(codes: bytes, places: list[int] | None) -> bytes:
    out = bytearray(codes)
    for i in places or ():
        out[i] = DUPLICATE
    return bytes(out)


def _stitched(pieces: DataFrame, passes: int) -> DataFrame:
    """Pieces that were not whole, repaired."""
    places = _duplicates(pieces.select("conv_id", "piece", "codes", "digests"))
    codes = keep(_mapped(
        pieces.select("conv_id", "piece", "codes").join(places, "piece", "left").select("conv_id", "piece", "codes", "places"),
        lambda conv_id, piece, codes, places: {"conv_id": conv_id, "piece": piece, "codes": _marked(codes, places)},
        pa.schema({"conv_id": LONG, "piece": LONG, "codes": pa.binary()})), "codes")
    ends = _mapped(codes.join(settled(codes, passes), "piece").select("conv_id", "piece", "codes", "wanted"), _exits,
                   pa.schema({"conv_id": LONG, "piece": LONG, "wanted": LONGS, "exits": LONGS}))
    entries = _chained(ends, lambda: 0, _entered, pa.schema({"piece": LONG, "wanted": LONGS, "entry": LONG}))
    last = pieces.groupBy("conv_id").agg(F.max("piece").alias("piece")).select("piece", F.lit(True).alias("is_last"))
    ready = (
        pieces.drop("codes", "digests", "audit", "cost").join(codes.select("piece", "codes"), "piece")
        .join(entries, "piece").join(last, "piece", "left"))

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for r in batch.to_pylist():
                    found = [(x["role"], x["text"]) for x in r["rows"]]
                    r["audit"], found, r["cost"] = trace(
                        r["codes"], found, tuple(r.pop("wanted")), r.pop("entry"), bool(r.pop("is_last")))
                    yield r | {"rows": [{"role": a, "text": b} for a, b in found], "digests": None}
        return _batches(rows(), PIECES)

    return ready.mapInArrow(repaired, from_arrow_schema(PIECES))


def repair(
    conversations: DataFrame, damage: bool = False, piece_rows: int = PIECE_ROWS, passes: int = PASSES,
) -> DataFrame:
    """Pieces of repaired conversations: ``rows`` are the (role, text) of a piece in order, ``audit`` its edits.

    Rows come by turn, nulls first, then role and the hash of the text. A null role or text is one space, a null
    conv_id a conversation of its own. Blank and repeated rows are deleted, all other edits are the cheapest; of
    equally cheap ones the audit that comes first. Repeated rows are duplicates of the first. A conversation without
    rows (all dropped by ``damage``) has one or more pieces without rows; an empty table gives none. Clashing further
    columns are not read.
    """
    rows = damaged(conversations) if damage else _plain(conversations)
    order = ["conv_id", "turn", "role", F.md5(F.col("text").cast("binary")), F.col("tie")]
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = keep(placed.select("conv_id", "turn", "role", "text", "times").mapInArrow(
        partial(_cut, most=piece_rows), from_arrow_schema(PIECES)), "pieces")
    return cut.where("whole").unionByName(_stitched(cut.where("not whole"), passes))


class _Fold:
    """What a conversation's pieces add up to."""

    def __init__(self) -> None:
        self.sums = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.low = self.high = self.last = self.last_turn = None
        self.audit, self.hash, self.empty = [], hashlib.sha256(), True

    def add(self, row: dict) -> None:
        codes = row["codes"]
        self.sums["blank"] += codes.count(BLANK)
        self.sums["duplicate"] += codes.count(DUPLICATE)
        self.sums["truncated"] += sum(codes.count(c) for c in range(_CUT, BLANK))
        self.sums["illegal"] += row["illegal"]
        self.sums["cost"] += row["cost"]
        if self.last is not None and row["first"] is not None and self.last + row["first"] not in ("su", "ua", "au"):
            self.sums["illegal"] += 1
        self.last = row["last"] if row["last"] is not None else self.last
        if row["turns"]:
            self.sums["turns"] += row["turns"] - (row["first_turn"] == self.last_turn)
            self.low = row["low"] if self.low is None else self.low
            self.high = self.last_turn = row["high"]
        self.audit.append(row["audit"])
        for turn in row["rows"]:
            if not self.empty:
                self.hash.update(b"\n")
            self.hash.update(f"{turn['role']}:{turn['text']}".encode())
            self.empty = False

    def row(self, conv_id: int | None) -> dict:
        gaps = self.high - self.low + 1 - self.sums["turns"] if self.low is not None else 0
        sums = [self.sums[n] for n in ("blank", "duplicate", "truncated", "illegal", "cost")]
        return dict(zip(FOLDED.names, [conv_id, gaps, *sums, "".join(self.audit), self.hash.hexdigest()]))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        here, fold = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if fold is None or row["conv_id"] != here:
                    if fold is not None:
                        yield fold.row(here)
                    here, fold = row["conv_id"], _Fold()
                fold.add(row)
        if fold is not None:
            yield fold.row(here)

    return _batches(rows(), FOLDED)


def digest(pieces: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair`: counts, cost, audit and the hash of its ``role:text`` lines.

    Pieces of a conversation are read in order, one at a time; what is held of it is its audit and the hash so far.
    """
    parts = pieces.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return pieces.where("whole").mapInArrow(_fold, from_arrow_schema(FOLDED)).unionByName(parts.mapInArrow(_fold, from_arrow_schema(FOLDED)))


def repair_conversations(
    conversations: DataFrame, damage: bool = False, piece_rows: int = PIECE_ROWS, passes: int = PASSES,
) -> DataFrame:
    """:func:`digest` of :func:`repair`."""
    return digest(repair(conversations, damage, piece_rows, passes))
