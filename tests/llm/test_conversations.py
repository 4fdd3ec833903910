import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gaugelake.llm import conversations as C
from gaugelake.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"


def after_damage(rows):
    """Rows (conv, turn, role, text) by conversation, in order, by the plain reading of the contract."""
    out = {}
    for conv, turn, role, text in rows:
        name = [" " if v is None else str(v) for v in (conv, turn)]
        pick = zlib.crc32(":".join(name).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        own = out.setdefault(conv, [])
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(pick, text)
        own += {0: 0, 3: 2}.get(pick, 1) * [(turn, "user" if pick == 4 else role, text)]
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, own in out.items()}


def shortest(rows, faults):
    """Least (cost, edits, repaired lines) over all edit sequences, by exhaustive search with memory, not by states ahead."""
    best = {}

    def legal(initials):
        rest = initials[1:] if initials[:1] == "s" else initials
        return initials == "" or (rest != "" and rest == "ua" * (len(rest) // 2))

    def prefix(initials):
        rest = initials[1:] if initials[:1] == "s" else initials
        return ("ua" * len(rest)).startswith(rest)
    limit = [2 * len(rows)]
    frontier = [(0, "", (), 0, "")]  # cost, edits, lines, rows used, initials
    while frontier:
        following = []
        for cost, edits, lines, i, initials in frontier:
            if i == len(rows) and legal(initials):
                best[(cost, edits)] = lines
                limit[0] = min(limit[0], cost)
            moves = []
            if i < len(rows):
                role, text = rows[i][1:]
                moves.append((2, "D", None, 1))
                if faults[i] not in ("blank", "duplicate"):
                    more = 5 if faults[i] == "truncated" else 0
                    moves.append((more, "K", (role, text), 1))
                    moves += [(1 + more, "R", (r, text), 1) for r in ("user", "assistant")]
            moves += [(5, "I", (r, ""), 0) for r in ("user", "assistant")]
            for c, e, line, used in moves:
                word = initials + (line[0][:1] if line else "")
                if cost + c <= limit[0] and (line is None or (line[0] and prefix(word))):
                    following.append((cost + c, edits + e, lines + ((line,) if line else ()), i + used, word))
        kept = {}
        for item in following:  # of equal place and word only the least can be part of the answer
            tail = (item[3], item[4][:1] == "s", item[4][-1:], len(item[1]) - item[3])
            if tail not in kept or item[:2] < kept[tail][:2]:
                kept[tail] = item
        frontier = list(kept.values())
    cost, edits = min(best)
    return cost, edits, best[(cost, edits)]


def by_hand(rows):
    out = {}
    for conv, own in after_damage(rows).items():
        seen, faults = set(), []
        for _, role, text in own:
            fault = "blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else (
                None if text.strip(SPACE)[-1] in ".!?" else "truncated")
            seen.add((role, text))
            faults.append(fault)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, edits, lines = shortest(own, faults)
        text = "\n".join(f"{r}:{t}" for r, t in lines)
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def talk(rng, conv, n):
    roles = ["user", "assistant"] * n
    for turn in range(n):
        role = rng.choice(["system", "tool", "", None, "User", "user"]) if rng.random() < 0.25 else roles[turn]
        text = rng.choice(["Yes.", "No!", "why", "", " \n", None, "a longer answer? ", f"number {rng.randrange(6)}.", "Ünï."])
        yield conv, None if rng.random() < 0.05 else turn + (rng.random() < 0.2), role, text


def frame(spark, rows):
    """Columns that clash with the names used inside, besides."""
    return spark.createDataFrame([(*r, 5, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, no int, state string").drop("n")


def corpus():
    rng = random.Random(5)
    rows = [row for conv in range(60) for row in talk(rng, conv, rng.randrange(1, 9))]
    rows += [r for r in rows if r[0] in (3, 7)]  # repeated rows
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (-5, None, "user", "x" * 5000 + ".")]
    gone = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return rows + [(gone, 0, "user", "Dropped.")]


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_query_against_all_edit_sequences(spark, tmp_path):
    rows = corpus()
    frame(spark, rows).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    result = QUERIES["op11_checkpointed_repair"](spark, str(tmp_path))
    assert result.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = by_hand(rows)
    assert got(result) == want
    assert ("", hashlib.sha256(b"").hexdigest()) in {(r[6], r[7]) for r in want.values()}


def test_many_checkpoints_and_tasks(spark, monkeypatch, tmp_path):
    """Blocks of two rows and a conversation cut over several ranges give what one block gives."""
    rng = random.Random(11)
    rows = [*talk(rng, 1, 12), *talk(rng, 2, 8), *talk(rng, 2, 5), *talk(rng, 3, 3)]
    rows = [(c, t * 10 if t else t, r, x) for c, t, r, x in rows]
    monkeypatch.setattr(C, "FIRST_ROWS", 1)
    monkeypatch.setattr(C, "MORE_ROWS", 1)
    monkeypatch.setattr(C, "blocks", with_ranges(C.blocks, 5))
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(QUERIES["op11_checkpointed_repair"](spark, str(tmp_path))) == by_hand(rows)


def with_ranges(plain, parts):
    def run(rows):
        dealt = rows.repartitionByRange(parts, "conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
        return plain(dealt)
    return run


def test_long_conversation_in_pieces(spark):
    """Sqrt(n) blocks: the walk over pieces equals one walk over all rows, and the turns are legal."""
    rng = random.Random(3)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", "Well.", ""]) if rng.random() < 0.5 else f"{i}.")
            for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    search = C.searched(df)
    assert 15 < search.count() < 60
    row = C.report(search).first()
    seen, faults = set(), []
    for _, _, role, text in rows:
        faults.append(C.BAD if not text or (role, text) in seen else C.CLEAN if text[-1] in ".!?" else C.TRUNC)
        seen.add((role, text))
    program = [(r[2], f, 0) for r, f in zip(rows, faults)]
    assert row.audit == C.walk(program, C.settled([0, C.FAR, C.FAR, 0]), C.START, True)[1]
    said = [(r.role, r.text) for r in C.turns(search).orderBy("conv_id", "part", "no", "place").collect()]
    assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest() == row.repaired_sha256
    initials = "".join(r[:1] for r, _ in said).removeprefix("s")
    assert initials == "ua" * (len(initials) // 2)


def test_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op11_checkpointed_repair"](spark, str(tmp_path)).collect() == []
    assert C.turns(C.searched(frame(spark, []))).collect() == []


@pytest.mark.parametrize("text", [" ", "\t\n", "", "a.", "a. ", "a", "!\x0b"])
def test_faults(text):
    bare = text.strip(SPACE)
    assert C.fault_of(text, True)[1] == ("blank" if not bare else "" if bare[-1] in ".!?" else "truncated")


def test_crc_of_rows_without_ids(spark):
    rows = [(None, None, "user", "A.")]
    assert C.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).select(
        F.col("n")).first()[0] == {0: 0, 3: 2}.get(zlib.crc32(b" : ") % 20, 1)
