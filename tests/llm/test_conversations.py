import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from checks.compare import oracle_connection
from stayscope.llm import conversation_repair as C
from stayscope.llm.queries import ORACLES, op13_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def order(row):
    turn, role, text = row
    return turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def hurt(conv, rows):
    """Rows (turn, role, text) of a conversation after damage."""
    out = []
    for turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate:
            row = (turn, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
            out += [row, row] if fate == 3 else [row]
    return sorted(out, key=order)


def brute(conv, rows):
    """Every audit of every suffix, the cheapest and ASCII-least kept."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not body else "d" if (role, text) in seen else "." if body[-1] in ".!?" else "t")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, said, fresh):
        """(cost, audit, lines) from row i on; `said` is the last initial, `fresh` the insertions still allowed."""
        found = []

        def then(letter, cost, role, text, j, left):
            start = role[:1]
            if (start == "s" and said == "") or (start == "u" and said in ("", "s", "a")) or (start == "a" and said == "u"):
                c, a, lines = best(j, start, left)
                found.append((c + cost, letter + a, ((role, text),) + lines))

        if i == len(rows) and said in ("", "a"):
            found.append((0, "", ()))
        if fresh:
            for role in ("user", "assistant"):
                then("I", 2, role, "", i, fresh - 1)
        if i < len(rows):
            _, role, text = rows[i]
            c, a, lines = best(i + 1, said, 3)
            found.append((c + 3, "D" + a, lines))
            if faults[i] not in "bd":
                more = faults[i] == "t"
                then("K", more, role, text, i + 1, 3)
                for other in ("user", "assistant"):
                    then("R", 2 + more, other, text, i + 1, 3)
        return min(found) if found else (10**9, "", ())

    cost, audit, lines = best(0, "", 3)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(rows, rows[1:])]
    body = "\n".join(f"{r}:{t}" for r, t in lines)
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"),
            faults.count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(body.encode()).hexdigest())


def random_rows(rng, conversations, longest):
    rows = []
    for conv in range(conversations):
        for _ in range(rng.randrange(1, longest)):
            rows.append((conv, rng.choice([None, *range(-2, 12)]), rng.choice(["system", "user", "assistant", "user", "bot", "", None]),
                         rng.choice(["Yes.", "No!", "cut", " \t\n", None, "end? \x0b", "a.b", "ü.", "x\x1c"])))
    return rows


def summed(spark, rows, parts=3):
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts) if rows else spark.createDataFrame([], SCHEMA)
    return sorted((tuple(r[c] for c in COLUMNS) for r in C.summaries(C.damaged(table)).collect()), key=str)


def wanted(rows):
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(tuple(row))
    return sorted((brute(conv, hurt(conv, rs)) for conv, rs in groups.items()), key=str)


@pytest.mark.parametrize("size", [1, 2, 512])
def test_random_conversations_against_brute_force(spark, monkeypatch, size):
    rows = random_rows(random.Random(size), 60, 14)
    rows += rows[:40] + [(None, 1, "user", "Hi."), (None, None, None, None), (-5, 3, "assistant", "Alone")]
    want = wanted(rows)
    if size == 512:
        assert summed(spark, rows) == want
    # In blocks of few rows: what the tasks do, run here, as workers do not see the changed sizes.
    for conv in {r[0] for r in rows}:
        own = hurt(conv, [tuple(r[1:]) for r in rows if r[0] == conv])
        seen, initials, faults = set(), "", ""
        for _, role, text in own:
            body = text.rstrip(C.BLANKS)
            initials += role[:1] if role[:1] in ("s", "u", "a") else "o"
            faults += "b" if not body else "d" if (role, text) in seen else "." if body[-1] in ".!?" else "t"
            seen.add((role, text))
        cuts = [(initials[i:i + size], faults[i:i + size]) for i in range(0, len(own), size)] or [("", "")]
        vector, behind = C.END, []
        for block in reversed(cuts):
            behind.append(vector)
            costs = C.costs_between(*block)
            vector = tuple(min(costs[4 * t + s] + vector[t] for t in range(4)) for s in range(4))
        audit, state = "", 0
        for block in cuts:
            letters, state = C.edits(*block, state, behind.pop())
            audit += "".join(letters)
        row = next(w for w in want if w[0] == conv)
        assert (vector[0], audit + C.last_edits(state)) == (row[6], row[7])


def test_one_conversation_over_many_tasks(spark):
    rng = random.Random(4)
    rows = [(1, i // 2, rng.choice(["user", "assistant", "system", "x"]), rng.choice([f"row {i}.", "same.", "cut", ""]))
            for i in range(6000)]
    rows += [(2, 7, "user", "copy.")] * 3000 + [(3, None, "user", "One."), (3, None, "assistant", "Two!")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in C.summaries(table).collect()}
        parts = C.repair(table)
        counted = {r.conv_id: r["count"] for r in parts.groupBy("conv_id").count().collect()}
        lines = parts.filter("conv_id = 1").orderBy("part", "block").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert counted[1] > 4 and counted[2] > 1
    own = sorted([tuple(r[1:]) for r in rows if r[0] == 1], key=order)
    with_recursion = _iterative(own)
    assert found[1][6:8] == with_recursion
    assert "".join(r.audit for r in lines) == with_recursion[1]
    said = "".join(x.role[0] for r in lines for x in r.repaired)
    assert re.fullmatch("(s?(ua)+)?", said)
    body = "\n".join(f"{x.role}:{x.text}" for r in lines for x in r.repaired)
    assert found[1][8] == hashlib.sha256(body.encode()).hexdigest()
    assert found[2][:7] == (2, 0, 0, 2999, 0, 2999, 2999 * 3 + 2) and found[2][7] == "K" + "D" * 2999 + "I"
    assert found[3][6] in (0, 4)


def _iterative(rows):
    """Cost and audit of many rows by a table of strings from the end."""
    seen, faults = set(), []
    for _, role, text in rows:
        faults.append("b" if not text else "d" if (role, text) in seen else "." if text[-1] == "." else "t")
        seen.add((role, text))
    order_of = {"": "su", "s": "u", "u": "a", "a": "u"}
    now = {"": (0, ""), "s": (4, "II"), "u": (2, "I"), "a": (0, "")}
    for (_, role, _), fault in zip(reversed(rows), reversed(faults)):
        own = {}
        for said, follow in order_of.items():
            found = [(now[said][0] + 3, "D" + now[said][1])]
            if fault not in "bd":
                more = fault == "t"
                if role[:1] and role[:1] in follow:
                    found.append((now[role[:1]][0] + more, "K" + now[role[:1]][1]))
                found += [(now[x][0] + 2 + more, "R" + now[x][1]) for x in follow if x != "s"]
            own[said] = min(found)
        for _ in range(2):
            own = {said: min([own[said]] + [(own[x][0] + 2, "I" + own[x][1]) for x in follow if x != "s"])
                   for said, follow in order_of.items()}
        now = own
    return now[""]


def test_empty_table_and_extra_columns(spark):
    assert summed(spark, []) == []
    rows = random_rows(random.Random(9), 12, 6)
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("place", "key", "part", "block", "fate", "copy", "body")})
    assert sorted((tuple(r[c] for c in COLUMNS) for r in C.summaries(C.damaged(odd)).collect()), key=str) == wanted(rows)


def test_long_texts(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"{i} " + "long text " * 80_000 + ".") for i in range(6)]
    found = C.repair(spark.createDataFrame(rows, SCHEMA))
    assert found.count() > 1
    lines = [x for r in found.orderBy("part", "block").collect() for x in r.repaired]
    assert [(x.role, x.text) for x in lines] == [(r[2], r[3]) for r in rows]


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    want = oracle_connection(folder).sql(ORACLES["op13_conversations"]).select(", ".join(COLUMNS)).fetchall()
    rows = op13_conversations(spark, folder).select(*COLUMNS).collect()
    assert sorted(map(tuple, rows)) == sorted(want) and len(want) > 10
