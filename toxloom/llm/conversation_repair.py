"""Repair of conversation structure by a survivor-coalescence Viterbi search.

A conversation is legal when its role initials read `(s?(ua)+)?`. Each row is kept, given another role or deleted, and empty turns
are inserted, at the least cost; of equally cheap repairs the one whose edit letters come first wins.

The search keeps one survivor per state of that pattern. Survivors are leaves of a tree of back pointers with reference
counts: an edit is given out as soon as all survivors descend from it, and branches without survivors are freed. So a task holds
the unresolved edits (some forty bytes each), never a conversation. Equally cheap survivors are compared by their complete
unresolved letters: `Survivors` keeps the order of those texts, which extends letter by letter.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, ROLE, DELETE, INSERT = 0, 2, 3, 2   # what an edit costs
TRUNCATED = 1                             # for a truncated row that stays
SPACES = " \t\n\x0b\x0c\r"
LEGAL_PAIRS = ["su", "ua", "au"]
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {"u": "user", "a": "assistant"}
OUT = 4096                                # rows of an Arrow batch that is given out


class Tree:
    """Back pointers with reference counts. `root` is the last edit given out; all survivors descend from it.

    `sums` holds the sum of a node's children: with one child left it is that child.
    """

    def __init__(self) -> None:
        self.up, self.row, self.sums = array("q", [-1]), array("q", [0]), array("q", [0])
        self.kids, self.pins, self.code = array("b", [0]), array("b", [1]), array("b", [0])
        self.free: list[int] = []
        self.root = 0

    def add(self, up: int, code: int, row: int) -> int:
        if self.free:
            node = self.free.pop()
            self.up[node], self.row[node], self.sums[node], self.kids[node], self.pins[node], self.code[node] = up, row, 0, 0, 0, code
        else:
            node = len(self.up)
            for column, value in ((self.up, up), (self.row, row), (self.sums, 0), (self.kids, 0), (self.pins, 0), (self.code, code)):
                column.append(value)
        self.kids[up] += 1
        self.sums[up] += node
        return node

    def unpin(self, node: int) -> None:
        """A survivor leaves; branches that carry none are freed."""
        self.pins[node] -= 1
        while not self.kids[node] and not self.pins[node] and node != self.root:
            up = self.up[node]
            self.kids[up] -= 1
            self.sums[up] -= node
            self.free.append(node)
            node = up

    def resolved(self) -> Iterator[tuple[int, int]]:
        """(code, row) of the edits that all survivors share by now."""
        while self.kids[self.root] == 1 and not self.pins[self.root]:
            old, self.root = self.root, self.sums[self.root]
            self.free.append(old)
            yield self.code[self.root], self.row[self.root]

    def path(self, node: int) -> list[tuple[int, int]]:
        """The unresolved edits that lead to a survivor."""
        out = []
        while node != self.root:
            out.append((self.code[node], self.row[node]))
            node = self.up[node]
        return out[::-1]

    def size(self) -> int:
        return len(self.up) - len(self.free)


# An edit's code: its letter, the role it sets, and whether a truncated row stays.
CODES = [(letter, role, extra) for letter, role in (("D", ""), ("K", ""), ("R", "u"), ("R", "a"), ("I", "u"), ("I", "a")) for extra in (0, 1)]
CODE = {c: n for n, c in enumerate(CODES)}
COST = {"D": DELETE, "K": KEEP, "R": ROLE, "I": INSERT}


class Survivors:
    """The cheapest edits into each state after some rows.

    A survivor is (cost, rank, inserts, node). Its letters end with the edit of the last row and some inserts. Before those inserts
    no survivor's letters begin another's, as each has one letter per row that is no insert and ends with such a letter. So `rank`, the order of
    the letters up to there, together with the next letters decides between two of them for good.
    """

    def __init__(self) -> None:
        self.tree = Tree()
        self.rows = 0
        self.now: dict[int, tuple[int, int, int, int]] = {}
        self._settle({START: (0, 0, self.tree.root)}, [self.tree.root])

    def add(self, initial: str, doomed: bool, truncated: bool) -> Iterator[tuple[int, int]]:
        """One more row. Yields the edits resolved by it."""
        self.rows += 1
        extra = TRUNCATED if truncated else 0
        best: dict[int, tuple] = {}

        def offer(state: int, cost: int, rank: int, letters: str, up: int, code: int) -> None:
            mine = (cost, rank, letters, up, code)
            if state not in best or mine < best[state]:
                best[state] = mine

        for state, (cost, rank, inserts, node) in self.now.items():
            lead = "I" * inserts
            offer(state, cost + DELETE, rank, lead + "D", node, CODE["D", "", 0])
            if doomed:
                continue
            if (state, initial) in NEXT:
                offer(NEXT[state, initial], cost + KEEP + extra, rank, lead + "K", node, CODE["K", "", extra])
            for role in ROLES:
                if (state, role) in NEXT:
                    offer(NEXT[state, role], cost + ROLE + extra, rank, lead + "R", node, CODE["R", role, extra])
        order = sorted(best, key=lambda s: best[s][1:3])
        made = {s: (best[s][0], order.index(s), self.tree.add(best[s][3], best[s][4], self.rows)) for s in order}
        self._settle(made, [node for *_, node in self.now.values()])
        return self.tree.resolved()

    def _settle(self, made: dict[int, tuple[int, int, int]], old: Sequence[int]) -> None:
        """Inserts after the row, then survivors that can't win any more leave."""
        now = {s: (cost, rank, 0, node) for s, (cost, rank, node) in made.items()}
        tree, row = self.tree, self.rows + 1
        held = [node for *_, node in made.values()]
        for node in held:
            tree.pins[node] += 1  # while inserts are weighed

        def insert(state: int, role: str, into: int) -> None:
            cost, rank, inserts, node = now[state]
            now[into] = (cost + INSERT, rank, inserts + 1, tree.add(node, CODE["I", role, 0], row))

        froms = [s for s in (START, SYSTEM, ASSISTANT) if s in now]
        if froms:
            least = min(froms, key=lambda s: now[s][:2])
            if USER not in now or (now[least][0] + INSERT, now[least][1]) < now[USER][:2]:
                insert(least, "u", USER)
        if ASSISTANT not in now or (now[USER][0] + INSERT, now[USER][1]) < now[ASSISTANT][:2]:
            insert(USER, "a", ASSISTANT)
        # Whatever follows START or SYSTEM may follow ASSISTANT too, but for a first system row, which can be deleted there.
        if START in now and now[START][0] > now[ASSISTANT][0] + DELETE:
            del now[START]
        if SYSTEM in now and now[SYSTEM][0] > now[ASSISTANT][0]:
            del now[SYSTEM]
        for *_, node in now.values():
            tree.pins[node] += 1
        for node in (*held, *old):
            tree.unpin(node)
        self.now = now

    def finish(self) -> list[tuple[int, int]]:
        """The edits not given out yet. Nothing, and a legal conversation, are the ends allowed."""
        ends = [self.now[s] for s in (START, ASSISTANT) if s in self.now]
        return self.tree.path(min(ends)[3])


def faults(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Each row with its place in its conversation (`row`, from 1), its first fault, and whether it may not follow the row before.

    Rows go by turn, nulls first, then by role and text; null roles and texts are one space. Faults: `blank`, `duplicate` (role and text
    were there before), `truncated` (does not end in `.`, `!` or `?`). One shuffle, by conversation.
    """
    r = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    one = Window.partitionBy("conv").orderBy(*order)
    pair = F.concat(F.substring(F.lag("role").over(one), 1, 1), F.substring("role", 1, 1))
    r = r.select("*", F.sha2(F.col("text").cast("binary"), 256).alias("_sha")).select(
        "*", F.row_number().over(one).cast("bigint").alias("row"), F.coalesce(~pair.isin(LEGAL_PAIRS), F.lit(False)).alias("illegal"),
    )
    again = F.row_number().over(Window.partitionBy("conv", "role", "_sha").orderBy("row"))
    ended = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(ended == "", "blank").when(F.col("_n") > 1, "duplicate").when(~F.substring(ended, -1, 1).isin(".", "!", "?"), "truncated")
    return r.withColumn("_n", again).select("conv", "row", "turn", "role", "text", fault.alias("fault"), "illegal")


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == OUT:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for lo in range(0, batch.num_rows, OUT):
            yield from zip(*(c.to_pylist() for c in batch.slice(lo, OUT).columns))


def _key_type(df: DataFrame) -> tuple[str, Callable[[], pa.DataType]]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = df.schema["conv"].dataType
    return kind.simpleString(), lambda: to_arrow_type(kind)


def edits(marked: DataFrame) -> DataFrame:
    """The cheapest edits of rows marked by `faults`: `conv`, `row`, `step`, `edit` (K, R, D or I), `set_role` and `cost`.

    Steps number the edits of a conversation in order. An inserted turn carries the number of the row it stands before. Rows stream
    through a task in order, without their texts.
    """
    name, kind = _key_type(marked)
    narrow = marked.select("conv", "row", F.substring("role", 1, 1).alias("initial"), F.coalesce("fault", F.lit("")).alias("fault"))

    def search(rows: Iterator[tuple]) -> Iterator[tuple]:
        conv, survivors, step = None, None, 0

        def told(found) -> Iterator[tuple]:
            nonlocal step
            for code, row in found:
                letter, role, extra = CODES[code]
                step += 1
                yield conv, row, step, letter, ROLES.get(role), COST[letter] + extra

        for own, _, initial, fault in rows:
            if survivors is None or own != conv:
                if survivors is not None:
                    yield from told(survivors.finish())
                conv, survivors, step = own, Survivors(), 0
            yield from told(survivors.add(initial, fault in ("blank", "duplicate"), fault == "truncated"))
        if survivors is not None:
            yield from told(survivors.finish())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", kind()), ("row", pa.int64()), ("step", pa.int64()), ("edit", pa.string()), ("set_role", pa.string()), ("cost", pa.int64())])
        yield from _batches(search(_rows(batches)), schema)

    ordered = narrow.repartition("conv").sortWithinPartitions("conv", "row")
    return ordered.mapInArrow(run, f"conv {name}, row bigint, step bigint, edit string, set_role string, cost bigint")


def repair(marked: DataFrame) -> DataFrame:
    """The edits of rows marked by `faults`, in order, with what they leave: `conv`, `row`, `step`, `edit`, `cost`, `role`, `text`, and the row's
    own `turn`, `fault` and `illegal`.

    Deleted rows (`D`) keep their role and have no text; inserted ones (`I`) have an empty text and null for what belongs to a row. Repeated
    rows are duplicates, an empty table has no edits, and a conversation of any length streams through its task: what is held are
    edits not yet resolved. `marked` is read twice, so give it staged. Rows are partitioned and sorted by conversation.
    """
    own = marked.select(
        "conv", "row", F.lit(0).cast("bigint").alias("step"), F.lit(None).cast("string").alias("edit"), F.lit(None).cast("string").alias("set_role"),
        F.lit(None).cast("bigint").alias("cost"),
        F.struct("turn", "role", F.when(F.coalesce("fault", F.lit("")).isin("blank", "duplicate"), F.lit(None)).otherwise(F.col("text")).alias("text"), "fault", "illegal").alias("own"),
    )
    found = edits(marked).withColumn("own", F.lit(None).cast(own.schema["own"].dataType))
    both = own.unionByName(found).repartition("conv")
    w = Window.partitionBy("conv", "row").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inserted, deleted = F.col("edit") == "I", F.col("edit") == "D"
    given = both.withColumn("own", F.first("own").over(w)).where("step > 0")
    of_row: Callable[[str], Column] = lambda c: F.when(~inserted, F.col(f"own.{c}")).alias(c)
    return given.select(
        "conv", "row", "step", "edit", "cost", F.coalesce("set_role", "own.role").alias("role"),
        F.when(inserted, F.lit("")).when(~deleted, F.col("own.text")).alias("text"), of_row("turn"), of_row("fault"), of_row("illegal"),
    ).sortWithinPartitions("conv", "row", "step")


def digest(repaired: DataFrame) -> DataFrame:
    """One row per conversation of `repair`: gaps in its turns, faults, cost, edit letters, and a hash of its repaired lines.

    Reads the rows in the order in which `repair` leaves them, one at a time.
    """
    name, kind = _key_type(repaired)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        current: Any = None
        begun = False
        for conv, edit, cost, role, text, turn, fault, illegal in rows:
            if not begun or conv != current:
                if begun:
                    yield told()
                begun, current = True, conv
                n = dict.fromkeys(names, 0)
                turns, first, last, letters, lines, sha = 0, None, None, bytearray(), 0, hashlib.sha256()

                def told() -> tuple:
                    gaps = last - first + 1 - turns if turns else 0
                    return current, gaps, *(n[x] for x in names[1:]), letters.decode(), sha.hexdigest()

            letters += edit.encode()
            n["cost"] += cost
            if edit != "I":
                if fault:
                    n[fault] += 1
                n["illegal"] += bool(illegal)
                if turn is not None and turn != last:
                    turns, first, last = turns + 1, turn if first is None else first, turn
            if edit != "D":
                sha.update((("\n" if lines else "") + f"{role}:{text}").encode())
                lines += 1
        if begun:
            yield told()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", kind()), *((x, pa.int64()) for x in names), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        yield from _batches(fold(_rows(batches)), schema)

    narrow = repaired.select("conv", "edit", "cost", "role", "text", "turn", "fault", "illegal")
    return narrow.mapInArrow(run, f"conv {name}, {', '.join(f'{x} bigint' for x in names)}, audit string, repaired_sha256 string")


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A fixed fifth of the rows broken by the checksum of conversation and turn: dropped, emptied, cut at its ends of sentences, repeated, or
    given to the user. Nulls read as one space; the ids themselves stay."""
    space: Callable[[str], Column] = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    body = F.when(code == 1, "").when(code == 2, F.translate(space(text), ".!?", "")).otherwise(space(text))
    return rows.where(code != 0).select(
        F.col(conv), F.col(turn), F.when(code == 4, "user").otherwise(space(role)).alias(role), body.alias(text),
        F.explode(F.sequence(F.lit(1), F.when(code == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")
