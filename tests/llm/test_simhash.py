import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from stayscope.llm import simhash_bktree
from stayscope.llm.components import components
from stayscope.session import shared_folder

SCHEMA = "doc_id bigint, text string, fp string"


def brute_print(text, shingle=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), seed=42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_components(prints, radius):
    out = {i: i for i in prints}
    ids = sorted(prints)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if out[b] > out[a] and (prints[a] ^ prints[b]).bit_count() <= radius:
                    out[b], changed = out[a], True
    return out


def test_spark_hash_is_the_named_one(spark):
    row = spark.sql("select xxhash64('the same text') as h").first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest(b"the same text", seed=42)


@pytest.mark.parametrize("frontier", [2_000_000, 20])
def test_matches_brute_force(spark, monkeypatch, frontier):
    monkeypatch.setattr(simhash_bktree, "FRONTIER", frontier)
    random.seed(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        base = [random.choice(words) for _ in range(120)]
        rows.append((3 * i + 7, " ".join(base), None))
        for k in range(1, 3):
            base[random.randrange(120)] = "Other"
            rows.append((3 * i + 7 + k * 1000, "\t ".join(base).upper(), "x"))
    rows += [(1, None, "n"), (2, "", "e"), (3, " \n", "b"), (4, "one", ""), (5, "One two", ""), (5, "One two", ""),
             (None, "w1 w2", ""), (6, rows[0][1], "copy")]
    out = simhash_bktree.digests(simhash_bktree.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    prints = {i: brute_print(t) for i, t, _ in rows if i is not None}
    want = brute_components(prints, 2)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(rows)
    for doc_id, digits, component in got:
        if doc_id is None:
            assert component is None and int(digits, 16) == brute_print("w1 w2")
        else:
            assert (digits, component) == (f"{prints[doc_id]:016x}", want[doc_id])
    assert len(set(want.values())) < len(want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 255)), max_size=60, unique=True), st.integers(0, 3))
def test_forest_finds_every_link(members, radius):
    members = sorted(members)
    group = np.array([g for g, _ in members], dtype=np.int64)
    group = np.unique(group, return_inverse=True)[1] if len(group) else group
    prints = np.array([p for _, p in members], dtype=np.uint64)
    forest = simhash_bktree.BKForest(prints, group)
    got = {(int(a), int(b)) for x, y in forest.links(radius) for a, b in zip(x, y)}
    want = {(a, b) for a in range(len(members)) for b in range(len(members)) if a != b and group[a] == group[b]
            and (members[a][1] ^ members[b][1]).bit_count() <= radius}
    assert got == want


def test_shards_leave_no_close_pair_out():
    random.seed(1)
    for radius in (0, 1, 2, 3):
        masks = simhash_bktree.shard_masks(radius)
        for _ in range(200):
            a = random.getrandbits(64)
            b = a
            for bit in random.sample(range(64), radius):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, 200 + i) for i in range(50)] + [(300, 249), (301, 300)]
    links = spark.createDataFrame(chain + star + [(5, 5)], "a bigint, b bigint")
    got = {r.node: r.component for r in components(links, shared_folder(spark)).collect()}
    assert got == {**{i: 100 for i in range(101, 141)}, **{200 + i: 7 for i in range(50)}, 300: 7, 301: 7}


def test_empty_table(spark):
    assert simhash_bktree.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
