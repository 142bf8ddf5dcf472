import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from toxloom.llm import conversation_repair as R
from toxloom.llm import queries

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(rows):
    """Plain search over (row, state): the least cost, then the least letters, with the repaired lines."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, letters, lines
        moves = []
        for r, name in (("u", "user"), ("a", "assistant")):
            if (state, r) in step:
                moves.append((2, "I", 0, r, (f"{name}:",)))
        if i < len(rows):
            role, text, fault = rows[i]
            moves.append((3, "D", 1, None, ()))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                moves.append((extra, "K", 1, role[:1], (f"{role}:{text}",)))
                moves += [(2 + extra, "R", 1, r, (f"{n}:{text}",)) for r, n in (("u", "user"), ("a", "assistant"))]
        for c, letter, used, r, more in moves:
            if r is None or (state, r) in step:
                heapq.heappush(heap, (cost + c, letters + letter, i + used, state if r is None else step[state, r], lines + more))


def expected(rows):
    """The contract's columns, conversation by conversation."""
    out = []
    for conv in {r[0] for r in rows}:
        own = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            code = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            own += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in own:
            bare = SPACE.sub("", text)
            marked.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None))
            seen.add((role, text))
        turns = [t for t, *_ in own if t is not None]
        cost, letters, lines = cheapest(marked)
        count = lambda f: sum(x[2] == f for x in marked)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kinds", ["user", "user assistant", "user assistant system", "assistant system x ''", "user assistant system tool"])
def test_survivors_find_the_cheapest_and_first_letters(kinds):
    rng = random.Random(kinds)
    for size in [*range(9)] * 25:
        rows = [(rng.choice(kinds.split()).strip("'"), f"t{i}", rng.choice([None, None, "truncated", "blank", "duplicate"])) for i in range(size)]
        s, found = R.Survivors(), []
        for role, _, fault in rows:
            found += s.add(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        found += s.finish()
        want = cheapest(rows)
        assert "".join(R.CODES[c][0] for c, _ in found) == want[1], rows
        assert sum(R.COST[R.CODES[c][0]] + R.CODES[c][2] for c, _ in found) == want[0]


def test_resolved_edits_leave_the_tree():
    s, given = R.Survivors(), 0
    for i in range(20_000):
        given += sum(1 for _ in s.add("us"[i % 7 == 6] if i % 2 == 0 else "a", i % 50 == 0, i % 3 == 0))
    assert given > 19_000 and s.tree.size() < 200 and len(s.tree.up) < 2_000
    s = R.Survivors()
    for _ in range(20_000):  # only the end decides: nothing is resolved, but work stays linear and freed places are used again
        list(s.add("u", False, False))
    assert len(s.finish()) >= 19_999 and len(s.tree.up) < 90_000
    s = R.Survivors()
    given = [code for _ in range(20_000) for code, _ in s.add("a", True, False)]  # a run of rows that go
    assert "".join(R.CODES[c][0] for c in given + [c for c, _ in s.finish()]) == "D" * 20_000


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(5)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"])
            rows.append((conv, turn if rng.random() < 0.9 else None, role, rng.choice(["So.", "Yes!", "no end", "", " \t", None, f"Line {turn}?", "É. "])))
    rows += rows[:7]                                                     # repeated rows
    rows += [(70, 3, "user", "x" * 300_000 + ".")]                       # a very long text
    rows += [(71, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(9000)]  # more than one batch
    return rows


def test_query_against_a_plain_search(spark, rows, talks, tmp_path):
    spark.createDataFrame([(*r, "x", 1) for r in talks], SCHEMA + ", fault string, row int").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.QUERIES["op13_conversation_repair"](spark, str(tmp_path))
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert rows(got.select(*names)) == expected(talks)


def test_empty_table_and_conversations_without_rows(spark, rows, tmp_path):
    gone = [(c, t, "user", "So.") for c in range(200) for t in [0] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    spark.createDataFrame(gone, SCHEMA).write.parquet(f"{tmp_path}/a/conversations.parquet")
    got = queries.QUERIES["op13_conversation_repair"](spark, f"{tmp_path}/a")
    assert gone and rows(got) == sorted(((c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in gone), key=repr)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert queries.QUERIES["op13_conversation_repair"](spark, f"{tmp_path}/b").count() == 0


def test_edits_leave_a_legal_conversation(spark, talks):
    marked = R.faults(spark.createDataFrame(talks, SCHEMA))
    left = R.repair(marked).where(F.col("edit") != "D").groupBy("conv").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "step", "role"))), lambda x: F.substring(x["role"], 1, 1)), "").alias("roles")
    )
    assert left.count() > 40 and left.where(~F.col("roles").rlike("^(s?(ua)+)?$")).count() == 0
