"""Repair of conversation structure by depth-first branch-and-bound (operator 12).

A conversation is sound if its roles' initials read ``(s?(ua)+)?``. Edits: Keep (0), Rerole
to user or assistant (2), Delete (3, required for blank and duplicate rows), Insert an empty
user or assistant row (2); a truncated row that stays adds 1. The repair with the least cost
is taken, of those the one whose edits' initials are least in ASCII.

1. Rows become codes (role initial, fault); equal rows of one turn are counted first. Only a
   text's SHA-256 travels in this part. Duplicates are told from the least turn of each
   (conversation, role, text), which is looked up only where there are several.
2. Codes are sorted by range over (conversation, turn, role, text digest), so a conversation
   with a large share of all rows is dealt to many tasks. A task cuts it into blocks of BLOCK
   rows; a conversation that lies in one block is solved at once, of others each block for
   every pair of states before and after it.
3. The search of a block: depth first over (rows taken, state) on an explicit stack, branches
   in ASCII order. Suffix lower bounds add up the rows' least costs and 2 for each of a set of
   disjoint neighbours that cannot both stay as they are. A greedy repair is the first
   incumbent cost; a node's dominance entry is the least cost that has reached it, and a
   prefix that does not beat it, or whose bound passes the incumbent, is cut. As prefixes come
   in ASCII order, the first leaf of the least cost has the least audit.
4. Blocks of one conversation are put together by the same rule: per state the least
   (cost, audit) goes on. Equal costs have no audit that is the beginning of another.
5. ``repaired_rows`` streams the texts beside the audit, sorted, one conversation after
   another; no conversation is held as a whole.

Defined cases: a null role or text is one space; null turns come first; rows of one turn go by
role, then by the text's SHA-256; a null conv_id is a conversation of its own; roles of other
initials cannot be kept; repeated rows are duplicates; further columns are not read; an empty
table gives no rows. An audit is one value and so has fewer than 2^31 edits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import small_batches, stage

#: Rows that one search covers.
BLOCK = 64
SPACE = " \t\n\x0b\x0c\r"
#: States: nothing emitted, after system, after user, after assistant. Any row, inserted or given a role, leads to FOLLOWS.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)
#: States that a kept row of a role may follow, and where it leads.
KEEPS = {"s": ((START,), SYSTEM), "u": ((START, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1


def _bounds(codes: str, accept: bool) -> tuple[list[int], list[int]]:
    """Least cost of the rows from each on, and the first row from each on that need not go."""
    n = len(codes)
    stays = [n] * (n + 1)
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        c = codes[i]
        if c == "D":
            stays[i], least[i] = stays[i + 1], DELETE + least[i + 1]
            continue
        stays[i] = i
        own = _row(c)
        least[i] = own + least[i + 1]
        j = stays[i + 1]
        if j < n:
            if _clash(c, codes[j]):
                between = DELETE * (j - i - 1)
                least[i] = max(least[i], own + REROLE + between + _row(codes[j]) + least[j + 1])
        elif accept and c.lower() in "su":
            least[i] = max(least[i], own + INSERT + least[i + 1])
    return least, stays


def _row(code: str) -> int:
    """Least cost of a row that may stay."""
    if code.lower() in KEEPS:
        return TRUNCATED if code.isupper() else 0
    return min(DELETE, REROLE + (TRUNCATED if code.isupper() else 0))


def _clash(one: str, other: str) -> bool:
    """Whether two neighbours cannot both be kept without a row between them."""
    one, other = one.lower(), other.lower()
    if one not in KEEPS or other not in KEEPS:
        return False
    return KEEPS[one][1] not in KEEPS[other][0]


def _greedy(codes: str, state: int, goal: tuple[int, ...]) -> int | None:
    """Cost of a repair that takes each row's cheapest edit in turn; None if it misses the goal."""
    cost = 0
    for i, c in enumerate(codes):
        low, extra = c.lower(), TRUNCATED if c.isupper() else 0
        if c == "D":
            cost += DELETE
        elif low in KEEPS and state in KEEPS[low][0]:
            cost, state = cost + extra, KEEPS[low][1]
        elif low in KEEPS and FOLLOWS[state] in KEEPS[low][0] and INSERT < DELETE:
            cost, state = cost + INSERT + extra, KEEPS[low][1]
        elif extra:
            cost += DELETE
        else:
            cost, state = cost + REROLE, FOLLOWS[state]
    for _ in range(3):
        if state in goal:
            return cost
        cost, state = cost + INSERT, FOLLOWS[state]
    return None


@lru_cache(maxsize=1 << 16)
def search(codes: str, state: int = START, goal: tuple[int, ...] = (START, ASSISTANT)) -> tuple[int, str] | None:
    """Least (cost, audit) from ``state`` over all rows to a state of ``goal``; None if there is none.

    A code is the role's initial (x: any other) in lower case, in upper case if truncated, or D if the row must go.
    """
    n = len(codes)
    least, stays = _bounds(codes, goal == (START, ASSISTANT))
    early = max(goal) < USER                                              # a goal before the first user: all others go
    limit = _greedy(codes, state, goal)
    if limit is None:
        limit = DELETE * n + 3 * INSERT                                   # all deleted, then inserts
    best: tuple[int, str] | None = None
    dominance: dict[int, int] = {}
    edits: list[str] = []
    stack: list[tuple[int, int, int, int, str]] = [(0, state, 0, 0, "")]
    while stack:
        i, at, cost, depth, edit = stack.pop()
        del edits[max(depth - 1, 0):]
        if depth:
            edits.append(edit)
        j = stays[i]
        bound = least[i]
        if early:
            if at > goal[0]:
                continue
            bound = DELETE * (n - i - (at < goal[0]))
        elif j < n and codes[j].lower() in KEEPS and at not in KEEPS[codes[j].lower()][0]:
            bound = max(bound, DELETE * (j - i) + REROLE + _row(codes[j]) + least[j + 1])
        if cost + bound > limit or (best is not None and cost + bound >= best[0]):
            continue
        node = i << 2 | at
        if dominance.get(node, cost + 1) <= cost:
            continue
        dominance[node] = cost
        if i == n and at in goal:
            best, limit = (cost, "".join(edits)), cost
        depth += 1
        if i < n:                                                         # pushed in reverse: D, I, K, R come off the stack
            c = codes[i]
            if c != "D":
                extra = TRUNCATED if c.isupper() else 0
                stack.append((i + 1, FOLLOWS[at], cost + REROLE + extra, depth, "R"))
                low = c.lower()
                if low in KEEPS and at in KEEPS[low][0]:
                    stack.append((i + 1, KEEPS[low][1], cost + extra, depth, "K"))
        stack.append((i, FOLLOWS[at], cost + INSERT, depth, "I"))
        if i < n:
            stack.append((i + 1, at, cost + DELETE, depth, "D"))
    return best


def _codes(conversations: DataFrame) -> DataFrame:
    """Rows by place: conv_id, turn, initial, code (D: blank), whether blank or truncated, how many equal ones."""
    rows = _rows(conversations)
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    equal = (rows.select("conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), (last == "").alias("blank"),
                         (~last.isin(".", "!", "?")).alias("truncated"))
             .groupBy("conv_id", "turn", "role", "digest", "initial", "blank", "truncated").agg(F.count("*").alias("n")))
    equal = stage(equal, "conversation-codes")
    turn = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    several = (equal.where("not blank").groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("earliest"), F.count("*").alias("turns"))
               .where("turns > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "earliest"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    again = F.coalesce(turn > F.col("earliest"), F.lit(False))
    return equal.join(several, same, "left").select("conv_id", "turn", "role", "digest", "initial", "blank", "truncated", "n", again.alias("again"))


def _rows(conversations: DataFrame) -> DataFrame:
    space = F.lit(" ")
    text = F.coalesce(F.col("text").cast("string"), space)
    return conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
                                text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


def _solve_block(codes: str, whole: bool) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of a block; of a whole conversation only the accepted one (both states -1)."""
    if whole:
        return [(-1, -1, *search(codes))]
    found = ((a, b, search(codes, a, (b,))) for a in range(4) for b in range(4))
    return [(a, b, *best) for a, b, best in found if best is not None]


class _Conversation:
    """Counts and codes of one conversation's rows within a task, in order."""

    def __init__(self, conv_id, edge: bool):
        self.conv_id, self.edge, self.done, self.blocks = conv_id, edge, 0, []
        self._clear()

    def _clear(self) -> None:
        self.codes: list[str] = []
        self.held = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first_turn = self.last_turn = None
        self.first_initial = self.last_initial = None

    def add(self, turn, initial: str, blank: bool, truncated: bool, again: bool, n: int) -> None:
        code = initial if initial in KEEPS else "x"
        if truncated:
            code = code.upper()
        while n:
            take = min(n, BLOCK - self.held)
            if turn is not None:
                if self.last_turn != turn:
                    self.turns += 1
                self.low = turn if self.low is None else self.low
                self.high = turn
            if self.last_initial is None:
                self.first_initial, self.first_turn = initial, turn
            elif self.last_initial + initial not in ("su", "ua", "au"):
                self.illegal += 1
            if initial + initial not in ("su", "ua", "au"):
                self.illegal += take - 1
            self.last_turn, self.last_initial = turn, initial
            if blank:
                self.blank += take
                self.codes.append("D" * take)
            else:
                one = 0 if again else 1
                self.duplicate += take - one
                self.truncated += one and truncated
                self.codes.append((code if one else "") + "D" * (take - one))
                again = True
            self.held += take
            n -= take
            if self.held == BLOCK:
                self.close(False)

    def close(self, last: bool) -> None:
        if not self.held and not (last and not self.done):
            return
        whole = last and not self.edge and not self.done
        self.blocks.append((self.conv_id, whole, self.done, self.held, self.low, self.high, self.turns, self.first_turn, self.last_turn,
                            self.first_initial, self.last_initial, self.blank, self.duplicate, int(self.truncated), self.illegal,
                            [dict(zip(("before", "after", "cost", "audit"), s)) for s in _solve_block("".join(self.codes), whole)]))
        self.done += 1
        self._clear()


_NAMES = ["conv_id", "whole", "block", "rows", "low", "high", "turns", "first_turn", "last_turn", "first_initial", "last_initial",
          "blank", "duplicate", "truncated", "illegal", "solutions"]
_SOLUTION = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])


def _blocks(codes: DataFrame) -> DataFrame:
    kind = codes.schema["conv_id"].dataType.simpleString()
    longs = ", ".join(f"{c} bigint" for c in _NAMES[2:9])
    schema = (f"conv_id {kind}, whole boolean, {longs}, first_initial string, last_initial string, blank bigint, duplicate bigint, truncated bigint, "
              "illegal bigint, solutions array<struct<before:int,after:int,cost:bigint,audit:string>>, part int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        own: _Conversation | None = None
        ready: list[tuple] = []
        conv_type = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            types = [conv_type, pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string(), *[pa.int64()] * 4, pa.list_(_SOLUTION)]
            return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types)), pa.array([part] * len(rows), pa.int32())], [*_NAMES, "part"])

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or own.conv_id != conv_id:
                    if own is not None:
                        own.close(True)
                        ready += own.blocks
                    own = _Conversation(conv_id, own is None)             # the first of a task may have begun in another
                own.add(*row)
                if len(own.blocks) + len(ready) >= 1024:
                    ready += own.blocks
                    own.blocks = []
                    yield batch_of(ready)
                    ready = []
        if own is not None:
            own.edge = True                                               # the last may go on in another
            own.close(True)
            ready += own.blocks
        if ready:
            yield batch_of(ready)

    keys = ["conv_id", "turn", "role", "digest"]
    ordered = codes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(ordered.select("conv_id", "turn", "initial", "blank", "truncated", "again", "n").mapInArrow(run, schema), "conversation-blocks")


def _joined(blocks: pd.DataFrame) -> pd.DataFrame:
    """One conversation from its blocks in order: per state the least (cost, audit) so far goes on."""
    reach: dict[int, tuple[int, str]] = {START: (0, "")}
    illegal = turns = 0
    last_turn = last_initial = low = high = None
    blocks = blocks.sort_values(["part", "block"])
    for b in blocks.itertuples():
        low = b.low if low is None else low
        high = b.high if b.high is not None else high
        ahead: dict[int, tuple[int, str]] = {}
        for s in b.solutions:
            if s["before"] in reach:
                cost, audit = reach[s["before"]]
                cost += s["cost"]
                if s["after"] not in ahead or cost <= ahead[s["after"]][0]:
                    new = (cost, audit + s["audit"])
                    ahead[s["after"]] = min(ahead.get(s["after"], new), new)
        reach = ahead
        illegal += b.illegal + (last_initial is not None and last_initial + b.first_initial not in ("su", "ua", "au"))
        turns += b.turns - (last_turn is not None and last_turn == b.first_turn)
        last_turn, last_initial = b.last_turn, b.last_initial
    cost, audit = min(reach[s] for s in (START, ASSISTANT) if s in reach)
    return pd.DataFrame({"conv_id": [blocks["conv_id"].iloc[0]], "low": [low], "high": [high], "turns": [turns],
                         "blank": [blocks["blank"].sum()], "duplicate": [blocks["duplicate"].sum()], "truncated": [blocks["truncated"].sum()],
                         "illegal": [illegal], "cost": [cost], "audit": [audit]})


def repair(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    small_batches(conversations.sparkSession, 4096)
    blocks = _blocks(_codes(conversations))
    kind = conversations.schema["conv_id"].dataType.simpleString()
    whole = blocks.where("whole").withColumn("s", F.col("solutions")[0]).select(
        "conv_id", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "s.cost", "s.audit")
    texts = [F.col(c).cast("string").alias(c) for c in ("low", "high", "first_turn", "last_turn")]   # pandas has no null integers
    parts = blocks.where("not whole").select("conv_id", "part", "block", *texts, *_NAMES[6:7], *_NAMES[9:])
    cut = parts.groupBy("conv_id").applyInPandas(
        _joined, f"conv_id {kind}, low string, high string, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")
    return whole.union(cut.withColumn("low", F.col("low").cast("bigint")).withColumn("high", F.col("high").cast("bigint"))).select("conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("bigint").alias("gaps"),
                                   "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repaired_rows(conversations: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, edit, role, text; each conversation in one partition, in order.

    A role that was kept stays as it was written.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    head = report.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"),
                         F.lit(b"").alias("digest"))
    rows = _rows(conversations).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "digest")
    ordered = head.union(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    names = {USER: "user", ASSISTANT: "assistant"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, START, 0
        for batch in batches:
            out: list[tuple] = []

            def inserts(conv_id) -> None:
                nonlocal at, state, place
                while at < len(audit) and audit[at] == "I":
                    state = FOLLOWS[state]
                    out.append((conv_id, place, "I", names[state], ""))
                    at, place = at + 1, place + 1

            for conv_id, header, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if header == 0:
                    audit, at, state, place = text, 0, START, 0
                    inserts(conv_id)
                    continue
                edit = audit[at]
                at += 1
                if edit != "D":
                    if edit == "K":
                        state = KEEPS[role[0]][1]
                    else:
                        state = FOLLOWS[state]
                        role = names[state]
                    out.append((conv_id, place, edit, role, text))
                    place += 1
                inserts(conv_id)
            columns = list(zip(*out)) if out else [[]] * 5
            types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", "place", "edit", "role", "text"])

    return ordered.select("conv_id", "kind", "role", "text").mapInArrow(run, f"conv_id {kind}, place bigint, edit string, role string, text string")
