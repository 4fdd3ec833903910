"""Conversation structure repair by a checkpointed least-cost alignment.

A conversation is repaired with the cheapest edits that give the roles ``system? (user assistant)+``, or nothing. The
search is a dynamic program over four states (what the next role may be). Its backward cost vectors are stored only at
checkpoints between blocks of rows; block sizes grow along a conversation, so a conversation of n rows has about sqrt(n)
blocks of at most about sqrt(n) rows. Walking forward, the vectors inside a block are computed again from the
checkpoint at its end.

Spark's part: rows are dealt by ranges of (conversation, turn), so a conversation that holds a third of all rows is cut
over many tasks. Each task makes blocks, with the least cost between any two states for each. The backward chain over
checkpoints moves four by four numbers a block. Then all blocks are walked apart, from every state they may be entered
in; the last pass only picks walks and hashes the repaired text, in order, without gathering it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugelake.llm.common import keep

START, SYSTEM, USER, ASSISTANT = range(4)  # nothing yet; last role system, user, assistant
STATES = range(4)
FAR = 1 << 60
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPOKEN = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}  # whose turn it is
AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
FIRST_ROWS, MORE_ROWS = 64, 16  # rows of the first block, and by how many each further one grows
BLOCK_BYTES = 4 << 20  # a block also ends beyond so many bytes of text
CLEAN, TRUNC, BAD = range(3)  # faults as the program sees them; blanks and duplicates are BAD


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations(conv_id, turn, role, text)`` after the damage that crc32("conv_id:turn") % 20 picks, with
    ``n`` (copies). Nulls in ids, roles and texts count as one blank. A dropped row stays as a marker, n = 0, without
    turn, role and text, so that its conversation stays known."""
    known = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    pick = F.crc32(F.concat(known["conv_id"], F.lit(":"), known["turn"]).cast("binary")) % 20
    stays = pick != 0
    text = (F.when(pick == 1, "").when(pick == 2, F.regexp_replace(known["text"], "[.!?]", "")).otherwise(known["text"]))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.when(stays, F.col("turn").cast("long")).alias("turn"),
        F.when(stays, F.when(pick == 4, "user").otherwise(known["role"])).alias("role"), F.when(stays, text).alias("text"),
        F.when(~stays, 0).when(pick == 3, 2).otherwise(1).cast("long").alias("n"))


def ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text) with their number ``n`` and ``first`` (no such role and text earlier in
    the conversation), dealt by ranges and sorted by conversation and turn, nulls first, then role and text.

    Equal rows of one turn become one row, by a grouping that combines before the shuffle; the join is on the whole row,
    so no key of it repeats.
    """
    distinct = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    known = distinct.withColumn("d", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    firsts = (known.where("n > 0").groupBy("conv_id", "role", "d").agg(F.min(at).alias("at"))
              .select(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("d").alias("f_d"),
                      F.col("at.turn").alias("f_turn"), F.lit(True).alias("first")))
    same = (F.col("conv_id").eqNullSafe(F.col("f_conv")) & F.col("turn").eqNullSafe(F.col("f_turn"))
            & F.col("role").eqNullSafe(F.col("f_role")) & (F.col("d") == F.col("f_d")))
    return (known.join(firsts, same, "left")
            .select("conv_id", "turn", "role", "text", "n", F.coalesce("first", F.lit(False)).alias("first"))
            .repartitionByRange("conv_id", "turn", "role", "text")
            .sortWithinPartitions("conv_id", "turn", "role", "text"))


def step(role: str, fault: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of one row in a state, in ASCII order: initial, cost, state after."""
    out = [("D", DELETE, state)]
    if fault != BAD:
        more = TRUNCATED if fault == TRUNC else 0
        own = role[:1]
        if own == "s" and state == START:
            out.append(("K", KEEP + more, SYSTEM))
        elif own and own == SPOKEN[state][0]:
            out.append(("K", KEEP + more, AFTER[state]))
        out.append(("R", REROLE + more, AFTER[state]))
    return out


def settled(cost: list[int]) -> list[int]:
    """Costs with insertions before whatever comes: an insertion leads to the state AFTER; three rounds reach all."""
    cost = list(cost)
    for _ in range(3):
        for s in STATES:
            cost[s] = min(cost[s], cost[AFTER[s]] + INSERT)
    return cost


def back(role: str, fault: int, extra: int, after: list[int]) -> list[int]:
    """Costs before a row from the costs after it; ``extra`` copies more are deleted."""
    return settled([min(c + after[t] for _, c, t in step(role, fault, s)) + DELETE * extra for s in STATES])


def fault_of(text: str, first: bool) -> tuple[int, str]:
    stripped = text.strip(" \t\n\x0b\x0c\r")
    if not stripped:
        return BAD, "blank"
    if not first:
        return BAD, "duplicate"
    return (CLEAN, "") if stripped[-1] in ".!?" else (TRUNC, "truncated")


def reach(rows: list[tuple[str, int, int]]) -> list[list[int]]:
    """Least cost through a block from each state at its start to each state at its end, without insertions there."""
    columns = []
    for end in STATES:
        cost = [0 if s == end else FAR for s in STATES]
        for role, fault, extra in reversed(rows):
            cost = back(role, fault, extra, cost)
        columns.append(cost)
    return [[columns[t][s] for t in STATES] for s in STATES]


def walk(rows: list[tuple[str, int, int]], after: list[int], state: int, last: bool) -> tuple[int, str]:
    """The ASCII-least tight edits of a block from ``state``, ``after`` being the (settled) costs at its end; the last
    block ends where nothing is left to pay. State reached and the edits, each row's followed by its deleted copies."""
    costs = [after]
    for role, fault, extra in reversed(rows):
        costs.append(back(role, fault, extra, costs[-1]))
    costs.reverse()
    out = []
    for i in range(len(rows) + 1):
        while True:
            here, moves = costs[i][state], []
            if i < len(rows):
                role, fault, extra = rows[i]
                moves = [(e, t) for e, c, t in step(role, fault, state) if c + DELETE * extra + costs[i + 1][t] == here]
            elif not (last and here):
                break
            inserted = costs[i][AFTER[state]] + INSERT == here
            if moves and (moves[0][0] < "I" or not inserted):
                out.append(moves[0][0] + "D" * extra)
                state = moves[0][1]
                break
            out.append("I")
            state = AFTER[state]
    return state, "".join(out)


def program(role: list[str], n: list[int], fault: list[int]) -> list[tuple[str, int, int]]:
    """A block's rows for the program: repeated rows of a turn beyond the first are deleted after it."""
    return [(r, f, k - 1) for r, k, f in zip(role, n, fault)]


BLOCK = ("conv_id long, part int, no int, turns array<long>, role array<string>, text array<string>, n array<long>, "
         "fault array<int>, blank long, duplicate long, truncated long, illegal long, cost array<long>")
ARROW = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("no", pa.int32()), ("turns", pa.list_(pa.int64())),
                   ("role", pa.list_(pa.string())), ("text", pa.list_(pa.string())), ("n", pa.list_(pa.int64())),
                   ("fault", pa.list_(pa.int32())), ("blank", pa.int64()), ("duplicate", pa.int64()),
                   ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.list_(pa.int64()))])


def illegal(roles: list[str], n: list[int]) -> int:
    """Adjacent initials that are not su, ua or au, copies of a row adjacent to each other."""
    own = [r[:1] for r in roles]
    return sum(k - 1 for k in n) + sum(a + b not in ("su", "ua", "au") for a, b in zip(own, own[1:]))


def block_of(conv, part: int, no: int, rows: list[tuple]) -> dict:
    """One block: (turn, role, text, n, first) of each row. ``turns``: first, last and number of distinct ones."""
    faults, counts = [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, _, text, n, first in rows:
        fault, name = fault_of(text, first)
        faults.append(fault)
        if name == "blank":
            counts["blank"] += n
        else:
            counts["duplicate"] += n - first
            counts["truncated"] += name == "truncated"
    turns = [r[0] for r in rows if r[0] is not None]
    held = [turns[0], turns[-1], len(set(turns))] if turns else []
    role, n = [r[1] for r in rows], [r[3] for r in rows]
    cost = reach(program(role, n, faults))
    return {"conv_id": conv, "part": part, "no": no, "turns": held, "role": role, "text": [r[2] for r in rows], "n": n,
            "fault": faults, **counts, "illegal": illegal(role, n), "cost": [c for row in cost for c in row]}


def blocks(rows: DataFrame) -> DataFrame:
    """Blocks of the rows of :func:`ordered`. (part, no) orders the blocks of a conversation: ``part`` is the range the
    block lies in, ``no`` counts inside it. Markers of dropped rows make an empty block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size, no, most, out, told_bytes, started, here = None, [], 0, 0, FIRST_ROWS, [], 0, False, 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "first", "part")]
            for conv, turn, role, text, n, first, part in zip(*columns):
                if started and (conv != key or len(held) >= most or size >= BLOCK_BYTES):
                    out.append(block_of(key, part, no, held))
                    told_bytes += size
                    held, size = [], 0
                    no, most = (no + 1, most + MORE_ROWS) if conv == key else (0, FIRST_ROWS)
                    if len(out) >= 256 or told_bytes >= BLOCK_BYTES:
                        yield pa.RecordBatch.from_pylist(out, ARROW)
                        out, told_bytes = [], 0
                key, started, here = conv, True, part
                if n:
                    held.append((turn, role, text, n, first))
                    size += len(text)
        if started:
            out.append(block_of(key, here, no, held))
            yield pa.RecordBatch.from_pylist(out, ARROW)

    return rows.withColumn("part", F.spark_partition_id()).mapInArrow(run, BLOCK)


def with_checkpoints(cut: DataFrame) -> DataFrame:
    """Blocks with ``after`` (the checkpoint: settled costs at the block's end), ``before`` (least cost from START at its
    beginning) and ``last``. Only the blocks' cost tables are chained."""
    fields = "conv_id long, part int, no int, after array<long>, before long, last boolean"
    arrow = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("no", pa.int32()), ("after", pa.list_(pa.int64())),
                       ("before", pa.int64()), ("last", pa.bool_())])
    end = settled([0, FAR, FAR, 0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, started, after = None, False, end
        for batch in batches:
            out = []
            for conv, part, no, cost in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "no", "cost"))):
                last = not started or conv != key
                if last:
                    key, started, after = conv, True, end
                ahead = after
                after = settled([min(cost[4 * s + t] + after[t] for t in STATES) for s in STATES])
                out.append((conv, part, no, ahead, after[START], last))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    chained = (cut.select("conv_id", "part", "no", "cost").repartition("conv_id")
               .sortWithinPartitions("conv_id", F.desc("part"), F.desc("no")).mapInArrow(run, fields))
    chained = chained.select(F.col("conv_id").alias("c_conv"), F.col("part").alias("c_part"), F.col("no").alias("c_no"), "after", "before", "last")
    same = (F.col("conv_id").eqNullSafe(F.col("c_conv")) & (F.col("part") == F.col("c_part")) & (F.col("no") == F.col("c_no")))
    return cut.drop("cost").join(chained, same).drop("c_conv", "c_part", "c_no")


def walked(checked: DataFrame) -> DataFrame:
    """Blocks with the walk from each of the four states: state reached and edits."""
    schema = pa.schema([("exits", pa.list_(pa.int32())), ("edits", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exits, edits = [], []
            for role, n, fault, after, last in zip(*(batch.column(c).to_pylist() for c in ("role", "n", "fault", "after", "last"))):
                rows = program(role, n, fault)
                own = [walk(rows, after, s, last) for s in STATES]
                exits.append([s for s, _ in own])
                edits.append([e for _, e in own])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(exits, schema.field(0).type), pa.array(edits, schema.field(1).type)],
                                             names=[*batch.schema.names, "exits", "edits"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in checked.schema)
    return checked.mapInArrow(run, fields + ", exits array<int>, edits array<string>")


def spoken(state: int, edits: str, role: list[str], text: list[str], n: list[int]) -> Iterator[tuple[str, str]]:
    """Repaired (role, text) of a block walked from ``state``."""
    i, copies = 0, 0
    for e in edits:
        if e == "I":
            yield SPOKEN[state], ""
            state = AFTER[state]
            continue
        if copies:
            copies -= 1
            continue
        if e == "K":
            yield role[i], text[i]
            state = SYSTEM if role[i][:1] == "s" else AFTER[state]
        elif e == "R":
            yield SPOKEN[state], text[i]
            state = AFTER[state]
        copies = n[i] - 1
        i += 1


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


class Told:
    """What is known of a conversation so far: counts, edits, the digest of the repaired text; never its texts."""

    def __init__(self, conv):
        self.conv, self.state, self.started = conv, START, False
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.initial = None
        self.turns, self.cost, self.audit, self.digest = 0, None, [], hashlib.sha256()

    def add(self, block: dict) -> None:
        self.cost = block["before"] if self.cost is None else self.cost
        for c in self.counts:
            self.counts[c] += block[c]
        if block["turns"]:
            low, high, distinct = block["turns"]
            self.turns += distinct - (self.high == low)
            self.low, self.high = low if self.low is None else self.low, high
        if block["role"]:
            own = block["role"][0][:1]
            self.counts["illegal"] += self.initial is not None and self.initial + own not in ("su", "ua", "au")
            self.initial = block["role"][-1][:1]
        edits = block["edits"][self.state]
        for role, text in spoken(self.state, edits, block["role"], block["text"], block["n"]):
            self.digest.update(f"{chr(10) if self.started else ''}{role}:{text}".encode())
            self.started = True
        self.audit.append(edits)
        self.state = block["exits"][self.state]

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts.values(), self.cost, "".join(self.audit), self.digest.hexdigest())


def told(blocks_walked: DataFrame) -> DataFrame:
    """One row a conversation: its blocks are streamed in order, one at a time."""
    arrow = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                       ("audit", pa.string()), ("repaired_sha256", pa.string())])
    held = ["conv_id", "turns", "role", "text", "n", "blank", "duplicate", "truncated", "illegal", "before", "exits", "edits"]

    def rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for block in (b for at in range(0, batch.num_rows, 32) for b in batch.slice(at, 32).to_pylist()):
                if now is None or now.conv != block["conv_id"]:
                    if now is not None:
                        done.append(now.row())
                    now = Told(block["conv_id"])
                now.add(block)
                if len(done) >= 1024:
                    yield rows(done)
                    done = []
        if now is not None:
            done.append(now.row())
        if done:
            yield rows(done)

    return (blocks_walked.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no").select(held).mapInArrow(run, RESULT))


def searched(rows: DataFrame) -> DataFrame:
    """Blocks of conversations with their checkpoints and walks, written aside: what :func:`report` and :func:`turns` read.

    ``rows`` are ``conv_id, turn, role, text`` and, where given, ``n`` copies (0: a marker that only names its
    conversation). Nulls in roles and texts count as one blank; rows without a conv_id are one conversation, without a
    turn come first. Rows of one turn are ordered by role and text, and equal rows of one turn are copies. Very long
    texts make blocks of one row. Other columns are ignored, and no rows give no result.
    """
    n = F.col("n").cast("long") if "n" in rows.columns else F.lit(1).cast("long")
    named = F.when(n > 0, F.coalesce("role", F.lit(" "))).alias("role"), F.when(n > 0, F.coalesce("text", F.lit(" "))).alias("text")
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *named, n.alias("n"))
    return keep(walked(with_checkpoints(keep(blocks(ordered(plain)), "conversation-blocks"))), "conversation-walks")


def report(search: DataFrame) -> DataFrame:
    """One row a conversation: faults, least cost, edits and the digest of the repaired text. The blocks of one
    conversation pass one task in order, one at a time, since a digest and a string of edits are sequential."""
    return told(search)


def turns(search: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``part``, ``no`` and ``place`` (the order), ``role``, ``text``. The states
    that blocks are entered in are chained over the exits alone; the texts stay dealt by block."""
    arrow = pa.schema([("e_conv", pa.int64()), ("e_part", pa.int32()), ("e_no", pa.int32()), ("state", pa.int32())])
    spoken_rows = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("no", pa.int32()), ("place", pa.int32()),
                             ("role", pa.string()), ("text", pa.string())])

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, started, state = None, False, START
        for batch in batches:
            out = []
            for conv, part, no, exits in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "no", "exits"))):
                if not started or conv != key:
                    key, started, state = conv, True, START
                out.append((conv, part, no, state))
                state = exits[state]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    def told_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in (b for at in range(0, batch.num_rows, 32) for b in batch.slice(at, 32).to_pylist()):
                said = list(spoken(b["state"], b["edits"][b["state"]], b["role"], b["text"], b["n"]))
                if said:
                    yield pa.RecordBatch.from_pylist([{"conv_id": b["conv_id"], "part": b["part"], "no": b["no"], "place": i, "role": r, "text": t}
                                                      for i, (r, t) in enumerate(said)], spoken_rows)

    chain = (search.select("conv_id", "part", "no", "exits").repartition("conv_id")
             .sortWithinPartitions("conv_id", "part", "no").mapInArrow(entered, "e_conv long, e_part int, e_no int, state int"))
    same = F.col("conv_id").eqNullSafe(F.col("e_conv")) & (F.col("part") == F.col("e_part")) & (F.col("no") == F.col("e_no"))
    return (search.join(chain, same).select("conv_id", "part", "no", "role", "text", "n", "edits", "state")
            .mapInArrow(told_turns, "conv_id long, part int, no int, place int, role string, text string"))
