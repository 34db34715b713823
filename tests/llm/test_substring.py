import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from stayscope.llm import substring_dedup

SCHEMA = "doc_id bigint, text string, marks string, label string"


def brute(rows, length):
    words = {k: (r[0], (r[1] or "").encode().split()) for k, r in enumerate(rows)}
    least = {}
    for doc, w in words.values():
        if doc is not None:
            for p in range(len(w) - length + 1):
                key = tuple(w[p:p + length])
                least[key] = min(least.get(key, doc), doc)
    out = []
    for doc, w in words.values():
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if doc is not None and least[tuple(w[p:p + length])] < doc:
                gone[p:p + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, length, prefix):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = substring_dedup.remove_repeats(docs, length=length, prefix=prefix)
    return sorted(map(tuple, substring_dedup.digests(found).collect()), key=str), found


def texts(seed, n, vocabulary, passages):
    random.seed(seed)
    words = [f"w{i}é" for i in range(vocabulary)]
    shared = [[random.choice(words) for _ in range(random.randint(5, 40))] for _ in range(passages)]
    rows = []
    for i in range(n):
        out = []
        for _ in range(random.randint(0, 6)):
            out += random.choice(shared) if random.random() < 0.6 else [random.choice(words) for _ in range(12)]
        rows.append((random.randint(0, 10 * n), random.choice([" ", "\n", " \t"]).join(out), "", None))
    return rows


EDGES = [
    (900, None, None, None), (901, "", None, None), (902, " \n\t ", None, None), (903, "alone", None, None),
    (904, "again " * 500, None, None), (905, "again " * 300 + "end", None, None), (906, "a b " * 200, None, None),
    (907, "b a " * 200, None, None), (None, "again " * 500, None, None), (None, None, None, None),
    (908, "x\x0by\x0cz\r\nv\x1fu t " * 30, None, None), (909, "x y z v\x1fu t " * 30, None, None),
    (904, "again " * 500, None, None), (910, " ".join(f"long{i}" for i in range(30000)), None, None),
    (911, " ".join(f"long{i}" for i in range(100, 30000)), None, None),
]


@pytest.mark.parametrize("group, tree_words", [(256, 300_000), (2, 40), (0, 1)])
def test_matches_brute_force(spark, monkeypatch, group, tree_words):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    monkeypatch.setattr(substring_dedup, "TREE_WORDS", tree_words)
    rows = texts(group, 120, 30, 12) + EDGES
    got, found = run(spark, rows, 12, 3)
    assert got == brute(rows, 12)
    for r in found.collect():
        words = r.text.encode().split()
        gone = {i for s in r.spans for i in range(s.begin, s.end)}
        assert len(gone) == r.n_removed
        assert r.kept_text.encode() == b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_production_settings(spark):
    passage = " ".join(f"p{i}" for i in range(80))
    rows = [(i, f"before{i} one{i} {passage} after{i} two{i}", None, None) for i in range(600)]
    rows += [(1000 + i, " ".join(passage.split()[:49]) + f" other{i}", None, None) for i in range(5)]
    got, _ = run(spark, rows + EDGES, 50, 8)
    assert got == brute(rows + EDGES, 50)
    assert sum(r[2] == 80 for r in got) == 599


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.lists(st.integers(0, 2), max_size=25)), max_size=8), st.integers(1, 9))
def test_suffix_nodes(segments, length):
    bounds = np.concatenate(([0], np.cumsum([len(w) for _, w in segments]))).astype(np.int64)
    words = np.array([x for _, w in segments for x in w], dtype=np.uint64)
    docs = np.array([d for d, _ in segments], dtype=np.int64)
    got = substring_dedup.repeated_suffixes(words, bounds, docs, length)
    least = {}
    for doc, w in segments:
        for p in range(len(w) - length + 1):
            key = tuple(w[p:p + length])
            least[key] = min(least.get(key, doc), doc)
    want = [p + length <= len(w) and least[tuple(w[p:p + length])] < doc for doc, w in segments for p in range(len(w))]
    assert got.tolist() == want


def test_empty_table(spark):
    assert run(spark, [], 50, 8)[0] == []


@pytest.mark.parametrize("words", [1_000_000, 3000])
def test_long_periodic_texts(spark, monkeypatch, words):
    """One repeated line makes a single segment of a whole text; a group is bounded by its words, not only its segments."""
    monkeypatch.setattr(substring_dedup, "GROUP_WORDS", words)
    line = " ".join(f"p{i}" for i in range(40))
    rows = [(100 - i, f"own{i} " + f"{line} " * (3 + 2 * i) + f"end{i % 5}", None, None) for i in range(24)]
    assert run(spark, rows, 50, 8)[0] == brute(rows, 50)
