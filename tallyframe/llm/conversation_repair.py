"""Conversation repair: the cheapest edits that make the roles of a conversation take turns, by dynamic programming over runs.

A row's symbol is its role's initial (s, u, a or another) and its fault. Wanted is ``(s?(ua)+)?``, an automaton of four states; a row may be
kept, dropped or given another role, and rows without text may be put in, each at a cost. The cost of going from state to state over one
row is a 4 x 4 matrix in (min, +), and equal consecutive symbols are one run: the vector of costs to the end goes back over a run by the
binary powers of its symbol's matrix, which are kept. The choices are unrolled forwards, in each state the first letter in order that the
costs allow, so that of equally cheap audits the smallest comes out; a long run is halved by the same powers until its pieces are short.

Copies of a row are counted, not listed, before anything is grouped. A conversation's symbols (a byte for each row) are held by one task, as
its audit is one cell; its texts only pass by, in order, on their way into the digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import picked, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# Symbols are 3 * role + fault.
ROLES, OTHER = {"s": 0, "u": 1, "a": 2}, 3
FINE, CUT, BAD = 0, 1, 2
# States: 0 nothing yet, 1 after s, 2 after u, 3 after a; the conversation may end in 0 and 3.
ENDS, SHORT = (0, 3), 64
NEXT = (2, 2, 3, 2)  # by the role that a state waits for: u, u, a, u
WAITS = ("user", "user", "assistant", "user")


def kept_to(state: int, role: int) -> int | None:
    """The state after a row of this role, if the state allows it."""
    if role == 0:
        return 1 if state == 0 else None
    return NEXT[state] if role == (2 if state == 2 else 1) else None


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product in (min, +) of two matrices, or of a matrix and a vector."""
    return (a[:, :, None] + b[None]).min(axis=1) if b.ndim == 2 else (a + b).min(axis=1)


def inserted() -> np.ndarray:
    """Costs from state to state by rows put in alone."""
    step = np.full((4, 4), np.inf)
    step[range(4), range(4)] = 0
    for state in range(4):
        step[state, NEXT[state]] = min(step[state, NEXT[state]], INSERT)
    return times(times(step, step), step)


POWERS: dict[tuple[int, int], np.ndarray] = {}


def power(symbol: int, j: int) -> np.ndarray:
    """Costs over ``2 ** j`` rows of a symbol, rows put in before each included; kept once known."""
    if (symbol, j) not in POWERS:
        POWERS[symbol, j] = times(power(symbol, j - 1), power(symbol, j - 1)) if j else one_row(symbol)
    return POWERS[symbol, j]


def one_row(symbol: int) -> np.ndarray:
    role, fault = divmod(symbol, 3)
    row, more = np.full((4, 4), np.inf), TRUNCATED * (fault == CUT)
    for state in range(4):
        row[state, state] = DELETE
        if fault != BAD:
            row[state, NEXT[state]] = min(row[state, NEXT[state]], REROLE + more)
            if (to := kept_to(state, role)) is not None:
                row[state, to] = min(row[state, to], KEEP + more)
    return times(inserted(), row)


def over(symbol: int, count: int, costs: np.ndarray) -> np.ndarray:
    """The costs before a run, from those after it."""
    for j in range(count.bit_length()):
        if count >> j & 1:
            costs = times(power(symbol, j), costs)
    return costs


def after_each(symbol: int, count: int, costs: np.ndarray) -> Iterator[np.ndarray]:
    """The costs after the first row of a run, after the second and so on: the run is halved until its pieces are short."""
    if count > SHORT:
        half = count // 2
        yield from after_each(symbol, half, over(symbol, count - half, costs))
        yield from after_each(symbol, count - half, costs)
    else:
        found = [costs]
        for _ in range(count - 1):
            found.append(times(power(symbol, 0), found[-1]))
        yield from reversed(found)


def repaired(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Cost and audit for the runs (symbol, rows) of a conversation."""
    end = inserted()[:, ENDS].min(axis=1)
    behind = [end]
    for symbol, count in reversed(runs):
        behind.append(over(symbol, count, behind[-1]))
    behind.reverse()
    state, audit = 0, []
    before = behind[0]
    for (symbol, count), ahead in zip(runs, behind[1:]):
        role, fault = divmod(symbol, 3)
        more = TRUNCATED * (fault == CUT)
        for after in after_each(symbol, count, ahead):
            while True:
                left = before[state]
                if DELETE + after[state] == left:
                    audit.append("D")
                    break
                if INSERT + before[NEXT[state]] == left:
                    audit.append("I")
                    state = NEXT[state]
                    continue
                to = kept_to(state, role)
                if to is not None and KEEP + more + after[to] == left:
                    audit.append("K")
                    state = to
                else:
                    audit.append("R")
                    state = NEXT[state]
                break
            before = after
    while state not in ENDS:
        audit.append("I")
        state = NEXT[state]
    return int(behind[0][0]), "".join(audit)


CONV, TURN = "conv_id", "turn"
PLACE = ["no_conv", "conv_id", "has_turn", "turn", "role", "digest"]


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies): rows as the rule leaves them, equal ones counted. A row that is dropped stays with no copies, so that its
    conversation does."""
    rows = picked(conversations, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    spoken = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (CONV, TURN)]
    rule = rows.select(CONV, TURN, F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(F.concat(spoken[0], F.lit(":"), spoken[1])) % 20).alias("rule"))
    role = F.when(F.col("rule") == 0, "").when(F.col("rule") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("rule").isin(0, 1), "").when(F.col("rule") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("rule") == 0, 0).when(F.col("rule") == 3, 2).otherwise(1).cast("long")
    return rule.select(CONV, TURN, role.alias("role"), text.alias("text"), copies.alias("copies")).groupBy(CONV, TURN, "role", "text").agg(F.sum("copies").alias("copies"))


def judged(rows: DataFrame) -> DataFrame:
    """The rows with their place, their digest, and their faults apart from being a duplicate: ``blank``, ``cut``. Written."""
    said = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return written(rows.select(F.col(CONV).isNull().alias("no_conv"), CONV, F.col(TURN).isNotNull().alias("has_turn"), TURN, "role", digest.alias("digest"), "text", "copies",
                               blank.alias("blank"), (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("cut")), "conversation-rows")


def with_first(rows: DataFrame) -> DataFrame:
    """``first``: whether no equal row (conversation, role and text) has an earlier turn."""
    earliest = rows.where("copies > 0").groupBy("no_conv", CONV, "digest").agg(F.min(F.struct("has_turn", TURN)).alias("earliest"))
    there = rows.drop("text").alias("r").join(earliest.alias("e"), (F.col("r.no_conv") == F.col("e.no_conv")) & F.col("r.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("r.digest") == F.col("e.digest")), "left")
    return there.select(*[f"r.{c}" for c in (*PLACE, "copies", "blank", "cut")], F.col("earliest").eqNullSafe(F.struct("has_turn", TURN)).alias("first"))


class Conversation:
    """What one conversation amounts to, row by row in order: counts, and its symbols as runs."""

    def __init__(self, conv_id):
        self.conv_id, self.runs, self.last = conv_id, [], None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.low, self.high, self.turn = 0, None, None, None

    def add(self, symbol: int, count: int) -> None:
        if count:
            if self.runs and self.runs[-1][0] == symbol:
                self.runs[-1] = symbol, self.runs[-1][1] + count
            else:
                self.runs.append((symbol, count))

    def row(self, turn, role: str, copies: int, blank: bool, cut: bool, first: bool) -> None:
        if not copies:
            return
        if turn is not None and turn != self.turn:
            self.turns, self.turn, self.high = self.turns + 1, turn, turn
            self.low = turn if self.low is None else self.low
        initial = role[:1]
        self.illegal += copies - 1 + (self.last is not None and self.last + initial not in ("su", "ua", "au"))
        self.last = initial
        kind = 3 * ROLES.get(initial, OTHER)
        if blank:
            self.blank += copies
            self.add(kind + BAD, copies)
            return
        if first:
            self.truncated += cut
            self.add(kind + (CUT if cut else FINE), 1)
        self.duplicate += copies - first
        self.add(kind + BAD, copies - first)

    def answer(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *repaired(self.runs))


def in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows of a conversation in one partition, in order."""
    return rows.repartition("no_conv", CONV).sortWithinPartitions(*columns)


def repairs(rows: DataFrame) -> DataFrame:
    """conv_id and what ``Conversation.answer`` gives, one row for each conversation."""
    kind = rows.schema[CONV].dataType.simpleString()
    names = [CONV, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, kind = None, [], None

        def emitted():
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:7]], pa.array(columns[7], pa.string())], names=names)

        for batch in batches:
            kind = batch.schema.field(CONV).type
            for conv_id, *row in zip(*[batch.column(c).to_pylist() for c in (CONV, TURN, "role", "copies", "blank", "cut", "first")]):
                if now is None or now.conv_id != conv_id:
                    if now:
                        out.append(now.answer())
                    now = Conversation(conv_id)
                now.row(*row)
            if len(out) > 1000:
                yield emitted()
                out.clear()
        if now:
            out.append(now.answer())
            yield emitted()

    return written(in_order(rows, *PLACE).mapInArrow(run, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"), "repairs")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): each conversation's audit comes first, then its rows pass by."""
    kind = rows.schema[CONV].dataType.simpleString()
    texts = rows.where("copies > 0").select(F.lit(1).alias("part"), *PLACE, "text", "copies")
    turn = rows.schema[TURN].dataType
    audits = found.select(F.lit(0).alias("part"), F.col(CONV).isNull().alias("no_conv"), CONV, F.lit(False).alias("has_turn"), F.lit(None).cast(turn).alias(TURN), F.lit("").alias("role"),
                          F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))

    class Writer:
        """The digest of a repaired conversation, its state and its place in the audit."""

        def __init__(self, conv_id, audit: str):
            self.conv_id, self.audit, self.at, self.state, self.sha, self.empty = conv_id, audit, 0, 0, hashlib.sha256(), True

        def line(self, role: str, text: str) -> None:
            self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False

        def put_in(self) -> None:
            while self.audit[self.at:self.at + 1] == "I":
                self.line(WAITS[self.state], "")
                self.state, self.at = NEXT[self.state], self.at + 1

        def row(self, role: str, text: str, copies: int) -> None:
            for _ in range(copies):
                self.put_in()
                if (done := self.audit[self.at]) == "K":
                    self.line(role, text)
                    self.state = kept_to(self.state, ROLES[role[:1]])
                elif done == "R":
                    self.line(WAITS[self.state], text)
                    self.state = NEXT[self.state]
                self.at += 1

        def answer(self) -> tuple:
            self.put_in()
            return self.conv_id, self.sha.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, kind = None, [], None

        def emitted():
            ids, hashes = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(hashes, pa.string())], names=[CONV, "repaired_sha256"])

        for batch in batches:
            kind = batch.schema.field(CONV).type
            for part, conv_id, role, text, copies in zip(*[batch.column(c).to_pylist() for c in ("part", CONV, "role", "text", "copies")]):
                if part:
                    now.row(role, text, copies)
                    continue
                if now:
                    out.append(now.answer())
                now = Writer(conv_id, text)
            if len(out) > 1000:
                yield emitted()
                out.clear()
        if now:
            out.append(now.answer())
            yield emitted()

    both = audits.unionByName(texts)
    return in_order(both, "no_conv", CONV, "part", *PLACE[2:]).mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def conversation_repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Every conversation after the damage rule, its faults, and its cheapest repair.

    Result, one row per conv_id: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. A null role or text is one space, as are null
    identifiers and turns in the rule's key; rows with a null conv_id are one conversation; rows of one turn are in order of role, then of the
    text's digest; an empty role has no initial and is never kept; repeated rows are duplicates; a conversation of which no row is left has
    zeros, an empty audit and the digest of an empty string; an empty table gives an empty result; other columns are ignored.
    """
    rows = judged(damaged(conversations, conv_col, turn_col, role_col, text_col))
    found = repairs(with_first(rows))
    hashes = digests(rows, found)
    return found.alias("f").join(hashes.alias("h"), F.col("f.conv_id").eqNullSafe(F.col("h.conv_id"))).select("f.*", "h.repaired_sha256")
