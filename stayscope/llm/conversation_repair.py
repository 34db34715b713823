"""Structure of conversations: faults, and the cheapest edits that mend it.

A conversation is well formed if its role initials read `(s?(ua)+)?`. A dynamic
programme over rows and four states finds the cheapest edits; among these the
ASCII-least string of initials is read off walking forward. Backward cost
vectors are stored at checkpoints only, and those between two checkpoints are
worked out again while walking.

Conversations are dealt by ranges of their rows, so a large one lies in many
tasks, in blocks whose lengths grow by one step each: about the square root of
its rows both in number and in length. A block's costs from state to state are
a small matrix. The matrices of a conversation, not its rows, meet in one task:
backward for the cost vector behind each block, forward for the state before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stayscope.llm.batches import bound_batches
from stayscope.llm.components import kept
from stayscope.session import shared_folder

#: Rows by which each block of a conversation may be longer than the one before, and bytes of its texts.
BLOCK_ROWS = 512
BLOCK_BYTES = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"

#: Costs of the edits; a truncated row that stays costs one more.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: States: nothing yet, after system, after user, after assistant. The state after a role, if it may follow.
AFTER_ROLE = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: The state after an inserted or given role: user, or assistant after a user.
AFTER_OTHER = (2, 2, 3, 2)
OTHER = ("user", "user", "assistant", "user")
NEVER = 1 << 50
#: Least costs behind the last row.
END = (0, 2 * INSERT, INSERT, 0)
LEGAL = frozenset(("su", "ua", "au"))

Vector = tuple[int, int, int, int]


@lru_cache(maxsize=100_000)
def step(initial: str, fault: str, after: Vector) -> tuple[Vector, int]:
    """Least costs before a row, from those behind it: relative to the least of them, and this least."""
    own = []
    for state in range(4):
        costs = [DELETE + after[state]]
        if fault not in "bd":
            extra = TRUNCATED if fault == "t" else 0
            costs.append(REROLE + extra + after[AFTER_OTHER[state]])
            then = AFTER_ROLE.get(initial, (None,) * 4)[state]
            if then is not None:
                costs.append(extra + after[then])
        own.append(min(costs))
    once = [AFTER_OTHER[s] for s in range(4)]
    before = [min(own[s], INSERT + own[once[s]], 2 * INSERT + own[once[once[s]]]) for s in range(4)]
    least = min(before)
    return tuple(x - least if x < NEVER else NEVER for x in before), least


@lru_cache(maxsize=100_000)
def walk(initial: str, fault: str, state: int, after: Vector) -> tuple[str, int]:
    """The ASCII-least tight edits before and of a row, and the state behind it."""
    before, least = step(initial, fault, after)
    extra = TRUNCATED if fault == "t" else 0
    letters = ""
    while True:
        cost = before[state] + least
        if cost == DELETE + after[state]:
            return letters + "D", state
        other = AFTER_OTHER[state]
        if cost == INSERT + before[other] + least:
            letters, state = letters + "I", other
            continue
        then = AFTER_ROLE.get(initial, (None,) * 4)[state]
        if then is not None and cost == extra + after[then]:
            return letters + "K", then
        return letters + "R", other


def edits(initials: str, faults: str, state: int, after: Vector) -> tuple[list[str], int]:
    """The edits at each row of a block, and the state behind it.

    Cost vectors are stored at every square root of the rows; those of a
    stretch are worked out again when the walk gets there.
    """
    n = len(initials)
    gap = isqrt(n) + 1
    begins = range(0, n, gap)
    checkpoint, vector = {}, after
    for begin in reversed(begins):
        checkpoint[begin] = vector
        for i in range(min(begin + gap, n) - 1, begin - 1, -1):
            vector = step(initials[i], faults[i], vector)[0]
    out = []
    for begin in begins:
        end = min(begin + gap, n)
        behind = [checkpoint[begin]]
        for i in range(end - 1, begin, -1):
            behind.append(step(initials[i], faults[i], behind[-1])[0])
        for i in range(begin, end):
            letters, state = walk(initials[i], faults[i], state, behind.pop())
            out.append(letters)
    return out, state


def last_edits(state: int) -> str:
    """Insertions behind the last row."""
    return "I" * (END[state] // INSERT)


def costs_between(initials: str, faults: str) -> list[int]:
    """Least costs from each state before a block to each state behind it: 4 x 4, by the state behind."""
    out = []
    for to in range(4):
        vector, total = tuple(0 if s == to else NEVER for s in range(4)), 0
        for initial, fault in zip(reversed(initials), reversed(faults)):
            vector, least = step(initial, fault, vector)
            total += least
        out.extend(x + total if x < NEVER else NEVER for x in vector)
    return out


def _name(row: Column) -> Column:
    return F.coalesce(row.cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows hurt by the hash of their name, for a test of the repair: conv_id, turn, role, text, gone.

    crc32(`conv_id:turn`) % 20 is the fate: 0 gone, 1 empty text, 2 without
    `[.!?]`, 3 twice, 4 role user. Nulls are one space. A row that is gone
    stays as the mark that its conversation exists.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        _name(F.col("role")).alias("role"), _name(F.col("text")).alias("text"),
    )
    fate = F.crc32(F.concat(_name(F.col("conv_id")), F.lit(":"), _name(F.col("turn"))).cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.withColumn("fate", fate).select(
        "conv_id", "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("fate") == 0).alias("gone"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


BLOCKS = (
    "conv_id bigint, part int, block int, whole boolean, initials string, faults string, turns bigint, "
    "low bigint, high bigint, roles array<string>, texts array<string>"
)
_BLOCKS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int32()), ("whole", pa.bool_()), ("initials", pa.string()),
    ("faults", pa.string()), ("turns", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
])


class _Packer:
    """Rows in their order, as blocks of one conversation each."""

    def __init__(self, part: int):
        self.part, self.number, self.out, self.held = part, 0, [], 0
        self.conv: object = self
        self.first = True

    def begin(self, conv: int | None, last: bool = False) -> None:
        """A conversation begins, or the rows end; what lies between two others in this task is whole."""
        if self.conv is not self:
            self.flush(whole=not self.first and not self.nth and not last)
            self.first = False
        self.conv, self.nth = conv, 0
        self.clear()

    def clear(self) -> None:
        self.initials, self.faults, self.roles, self.texts, self.size = [], [], [], [], 0
        self.turns, self.low, self.high = 0, None, None

    def add(self, turn: int | None, role: str, text: str, initial: str, fault: str) -> None:
        if len(self.initials) >= BLOCK_ROWS * (self.nth + 1) or (self.size and self.size + len(text) > BLOCK_BYTES):
            self.flush(whole=False)
            self.nth += 1
            self.clear()
        stays = fault not in "bd"
        self.initials.append(initial)
        self.faults.append(fault)
        self.roles.append(role if stays else None)
        self.texts.append(text if stays else None)
        self.size += len(text) + len(role) if stays else 0
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def flush(self, whole: bool) -> None:
        self.out.append((self.conv, self.part, self.number, whole, "".join(self.initials), "".join(self.faults),
                         self.turns, self.low, self.high, self.roles, self.texts))
        self.number += 1
        self.held += self.size + 200

    def taken(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(column, kind.type) for column, kind in zip(zip(*self.out), _BLOCKS)], schema=_BLOCKS)
        self.out, self.held = [], 0
        return batch


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer, repeated = None, False
    for batch in batches:
        names = ("conv_id", "part", "turn", "role", "text", "initial", "fault", "gone", "repeats")
        for conv, part, turn, role, text, initial, fault, gone, repeats in zip(*(batch.column(c).to_pylist() for c in names)):
            packer = packer or _Packer(part)
            if packer.conv is packer or conv != packer.conv:
                packer.begin(conv)
            if repeats:
                repeated = True
            elif not gone:
                packer.add(turn, role, text, initial, "d" if repeated else fault)
                repeated = False
            if packer.held > BLOCK_BYTES:
                yield packer.taken()
    if packer:
        packer.begin(None, last=True)
        yield packer.taken()


def blocks(rows: DataFrame, folder: str) -> DataFrame:
    """The rows (conv_id, turn, role, text, gone) in order and cut into blocks, written below `folder`.

    Rows go by turn (nulls first), rows of one turn by a hash of role and text.
    Which rows repeat an earlier one is worked out without texts; each such row
    gets a mark that is sorted directly before it, so texts are shuffled once.
    """
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    last = F.substring("body", -1, 1)
    dealt = kept(rows.withColumn("body", body).select(
        "conv_id", "turn", "role", "text", "gone",
        F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o").alias("initial"),
        F.when(F.col("body") == "", "b").when(last.isin(".", "!", "?"), ".").otherwise("t").alias("fault"),
        F.sha2(F.concat(F.char_length("role"), F.lit(":"), "role", "text"), 256).alias("key"),
        F.monotonically_increasing_id().alias("place"),
    ), f"{folder}/dealt")
    light = dealt.filter("not gone and fault <> 'b'").select("conv_id", "key", "turn", "place")
    first = light.groupBy("conv_id", "key").agg(F.min(F.struct("turn", "place")).alias("first"), F.count("*").alias("n"))
    first = first.filter("n > 1").select(F.col("conv_id").alias("conv_"), F.col("key").alias("key_"), F.col("first.place").alias("place_"))
    marks = light.join(first, F.expr("conv_id <=> conv_ and key = key_ and place <> place_")).select(
        "conv_id", "turn", "key", "place", F.lit(True).alias("repeats"))
    marked = dealt.withColumn("repeats", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    order = ["conv_id", "turn", "key", "place"]
    ranged = marked.repartitionByRange(*order).sortWithinPartitions(*order, F.col("repeats").desc())
    ranged = ranged.withColumn("part", F.spark_partition_id()).drop("key", "place")
    return kept(ranged.mapInArrow(_packed, BLOCKS), f"{folder}/blocks")


def _by_row(function: Callable, names: list[str], fields: list[tuple[str, pa.DataType]]) -> Callable:
    """A function of batches from one of rows that gives a row each."""
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [function(*row) for row in zip(*(batch.column(c).to_pylist() for c in names))]
            columns = list(zip(*out)) if out else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


_PLACE = [("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int32())]
_NUMBERS = pa.list_(pa.int64())


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the last block of a conversation to the first: the cost vector behind each."""
    now, vector = _behind, END

    def one(conv, part, block, costs):
        nonlocal now, vector
        last = now is _behind or conv != now
        if last:
            now, vector = conv, END
        behind = vector
        before = [min(costs[4 * t + s] + behind[t] for t in range(4)) for s in range(4)]
        least = min(before)
        vector = [min(x - least, NEVER) for x in before]
        return conv, part, block, behind, last

    names = ["conv_id", "part", "block", "costs"]
    return _by_row(one, names, [*_PLACE, ("behind", _NUMBERS), ("last", pa.bool_())])(batches)


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the first block of a conversation to the last: the state before each."""
    now, state = _entered, 0

    def one(conv, part, block, behind, last, exits):
        nonlocal now, state
        if now is _entered or conv != now:
            now, state = conv, 0
        entry, state = state, exits[state]
        return part, block, behind, last, entry

    names = ["conv_id", "part", "block", "behind", "last", "exits"]
    return _by_row(one, names, [*_PLACE[1:], ("behind", _NUMBERS), ("last", pa.bool_()), ("entry", pa.int64())])(batches)


SOLVED = (
    "conv_id bigint, part int, block int, initials string, faults string, turns bigint, low bigint, high bigint, "
    "audit string, repaired array<struct<role: string, text: string>>"
)
_LINES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _repaired(audit: list[str], tail: str, state: int, roles: list[str], texts: list[str]) -> list[dict[str, str]]:
    out = []

    def say(role: str, text: str) -> None:
        nonlocal state
        out.append({"role": role, "text": text})
        state = AFTER_ROLE[role[0]][state]

    for letters, role, text in [*zip(audit, roles, texts), (tail, None, None)]:
        for letter in letters:
            if letter == "I":
                say(OTHER[state], "")
            elif letter == "K":
                say(role, text)
            elif letter == "R":
                say(OTHER[state], text)
    return out


def _solve(conv, part, block, initials, faults, turns, low, high, roles, texts, behind, last, entry):
    audit, state = edits(initials, faults, entry, tuple(behind))
    tail = last_edits(state) if last else ""
    lines = _repaired(audit, tail, entry, roles, texts)
    return conv, part, block, initials, faults, turns, low, high, "".join(audit) + tail, lines


def _solved(found: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """The repaired blocks: those that are a whole conversation, and the others."""
    names = ["conv_id", "part", "block", "initials", "faults", "turns", "low", "high", "roles", "texts", "behind", "last", "entry"]
    solve = _by_row(_solve, names, [
        *_PLACE, ("initials", pa.string()), ("faults", pa.string()), ("turns", pa.int64()), ("low", pa.int64()),
        ("high", pa.int64()), ("audit", pa.string()), ("repaired", _LINES),
    ])
    end = F.array(*(F.lit(x).cast("bigint") for x in END))
    whole = found.filter("whole").withColumns({"behind": end, "last": F.lit(True), "entry": F.lit(0).cast("bigint")})
    codes = found.filter("not whole").select("conv_id", "part", "block", "initials", "faults")
    matrices = codes.mapInArrow(
        _by_row(lambda c, p, b, i, f: (c, p, b, costs_between(i, f)), codes.columns, [*_PLACE, ("costs", _NUMBERS)]),
        "conv_id bigint, part int, block int, costs array<bigint>",
    )
    behind = matrices.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("block")).mapInArrow(
        _behind, "conv_id bigint, part int, block int, behind array<bigint>, last boolean")
    behind = kept(behind, f"{folder}/behind")
    exits = codes.join(behind.drop("conv_id"), ["part", "block"]).mapInArrow(
        _by_row(
            lambda c, p, b, i, f, v, last: (c, p, b, v, last, [edits(i, f, s, tuple(v))[1] for s in range(4)]),
            ["conv_id", "part", "block", "initials", "faults", "behind", "last"],
            [*_PLACE, ("behind", _NUMBERS), ("last", pa.bool_()), ("exits", _NUMBERS)],
        ),
        "conv_id bigint, part int, block int, behind array<bigint>, last boolean, exits array<bigint>",
    )
    entered = exits.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").mapInArrow(
        _entered, "part int, block int, behind array<bigint>, last boolean, entry bigint")
    parts = found.filter("not whole").join(kept(entered, f"{folder}/entered"), ["part", "block"])
    return tuple(x.select(names).mapInArrow(solve, SOLVED) for x in (whole, parts))


def _prepared(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    bound_batches(rows.sparkSession)
    folder = shared_folder(rows.sparkSession)
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    named = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        _name(F.col("role")).alias("role"), _name(F.col("text")).alias("text"), gone.alias("gone"),
    )
    return _solved(blocks(named, folder), folder)


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, part, block, audit and repaired (role, text) of every block of every conversation.

    A conversation's blocks in order of part and block hold its repaired rows.
    Rows have conv_id, turn, role and text, and perhaps gone (true: the row
    only says that its conversation exists). Null role or text is one space,
    null ids are one conversation; other columns are left behind.

    A row's first fault counts: blank text (b), role and text of an earlier row
    (d), a last character that is none of `.!?` (t). Edits are Keep, Rerole to
    user or assistant, Delete (the only one for b and d) and Insert of an empty
    user or assistant row.
    """
    whole, parts = _prepared(rows)
    return whole.unionByName(parts).select("conv_id", "part", "block", "audit", "repaired")


class _Sum:
    """What is known of a conversation after some of its blocks."""

    def __init__(self, conv: int | None):
        self.conv, self.faults, self.illegal, self.turns, self.cost = conv, {"b": 0, "d": 0, "t": 0}, 0, 0, 0
        self.low = self.high = None
        self.said, self.audit, self.digest, self.lines = "", [], hashlib.sha256(), 0

    def add(self, initials, faults, turns, low, high, audit, repaired) -> None:
        for fault in self.faults:
            self.faults[fault] += faults.count(fault)
        said = self.said + initials
        self.illegal += sum(a + b not in LEGAL for a, b in zip(said, said[1:]))
        self.said = said[-1:]
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low = low if self.low is None else self.low
            self.high = high
        self.audit.append(audit)
        stays = iter(fault for fault, letter in zip(faults, audit.replace("I", "")) if letter != "D")
        self.cost += DELETE * audit.count("D") + INSERT * audit.count("I") + REROLE * audit.count("R")
        self.cost += TRUNCATED * sum(fault == "t" for fault in stays)
        for line in repaired:
            self.digest.update((("\n" if self.lines else "") + line["role"] + ":" + line["text"]).encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])
    now, out = None, []

    def taken() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    names = ("initials", "faults", "turns", "low", "high", "audit", "repaired")
    for batch in batches:
        for conv, *block in zip(batch.column("conv_id").to_pylist(), *(batch.column(c).to_pylist() for c in names)):
            if now is None or conv != now.conv:
                if now is not None:
                    out.append(now.row())
                now = _Sum(conv)
            now.add(*block)
        yield taken()
        out = []
    if now is not None:
        out.append(now.row())
    yield taken()


def summaries(rows: DataFrame) -> DataFrame:
    """One row per conversation: faults, gaps in the turns, cost, audit and the digest of the repaired rows.

    gaps: missing numbers between least and greatest turn; illegal: neighbours
    whose role initials are none of su, ua, au; repaired_sha256: of the lines
    `role:text` joined by line feeds. A conversation without rows has zeros,
    an empty audit and the digest of nothing. Rows are those of `repair`.

    A conversation in one block is summed where it is repaired. The digest of a
    larger one needs its rows in order: they stream through one task, which
    holds a block and the audit.
    """
    whole, parts = _prepared(rows)
    schema = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
              "audit string, repaired_sha256 string")
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return whole.mapInArrow(_summed, schema).unionByName(ordered.mapInArrow(_summed, schema))
