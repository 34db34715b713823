import random

import pytest
from hypothesis import given, settings, strategies as st

from stayscope.llm import decontaminate
from stayscope.llm.decontaminate import Items, distance_in, plain

DOCS = "doc_id bigint, text string, item_id string, hits string"


def brute(pattern, text):
    """Least edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", min_size=1, max_size=80), st.text("abc ", max_size=90))
def test_bit_parallel_distance(pattern, text):
    want = brute(pattern, text)
    found = distance_in(pattern, text, len(pattern))
    assert found[0] == want
    assert want == 0 or distance_in(pattern, text, want - 1) is None
    assert brute(pattern, text[:found[1]]) == want


def edited(text, edits):
    for _ in range(edits):
        i = random.randrange(len(text))
        text = random.choice([text[:i] + text[i + 1:], text[:i] + random.choice("abcdefgh ") + text[i + random.randint(0, 1):]])
    return text


def test_every_item_within_its_budget_is_found():
    random.seed(4)
    texts = {i: "".join(random.choice("abcdefgh ") for _ in range(random.randint(20, 150))) for i in range(40)}
    items = Items({i: plain(t) for i, t in texts.items()})
    for _ in range(150):
        i = random.randrange(40)
        text = plain("xyz " * random.randint(0, 9) + edited(texts[i], random.randint(0, 12)) + " zyx" * random.randint(0, 9))
        want = {k: brute(p, text) for k, p in items.texts.items() if len(p) >= decontaminate.LEAST_CHARS}
        want = {k: d for k, d in want.items() if d <= items.budget[k]}
        got = {k: d for k, d, _, _ in items.find(text) if len(items.texts[k]) >= decontaminate.LEAST_CHARS}
        assert got == want


ITEM = "The quick brown fox jumps over the lazy dog near the river bank at noon."


@pytest.mark.parametrize("block_bytes", [512 << 10, 10])
def test_documents(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    items = spark.createDataFrame(
        [(1, ITEM, "x"), (2, "Completely different words stand in this second item here.", None), (3, None, None),
         (4, "", None), (None, "no id for this item at all, so it is left out", None), (5, "short one", None),
         (1, ITEM, "x"), (6, ITEM, "same text")], "item_id bigint, text string, doc_id string")
    rows = [
        (10, f"Before.\n{ITEM.upper()} After", None, None), (10, f"Before.\n{ITEM.upper()} After", None, None),
        (11, "the quick brown fox jumped over the lazy dog near the river bank at noon", "", ""),
        (12, "the quick brown fox went home", None, None), (13, None, None, None), (14, "", None, None),
        (None, f"x {ITEM}", None, None), (15, "Short  one!", None, None), (16, "a short one inside", None, None), (18, "a short onerous day", None, None),
        (17, "filler words " * 30000 + ITEM + " completely different words stand in this secnd item here", None, None),
    ]
    found = decontaminate.contamination(spark.createDataFrame(rows, DOCS), items)
    out = decontaminate.digests(found).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: (r.contaminated, r.n_items, r.item_ids) for r in out}
    clean = (False, 0, [])
    assert got == {10: (True, 2, [1, 6]), 11: (True, 2, [1, 6]), 12: clean, 13: clean, 14: clean, None: (True, 2, [1, 6]),
                   15: (True, 1, [5]), 16: clean, 18: clean, 17: (True, 3, [1, 2, 6])}
    assert {r.doc_id: r.n_weak for r in out if r.n_weak} == {16: 1}
    weak = next(r for r in found.collect() if r.doc_id == 16).hits
    assert [(h.item_id, h.distance, h.begin, h.end, h.weak) for h in weak] == [(5, 0, 2, 11, True)]
    hit = next(r for r in found.collect() if r.doc_id == 10).hits[0]
    assert (hit.item_id, hit.distance, rows[0][1][hit.begin:hit.end]) == (1, 0, ITEM.upper()[:-1])


@given(st.text("ab ", min_size=1, max_size=8), st.text("ab ", max_size=40))
def test_short_items_stand_at_word_bounds(item, text):
    item, text = plain(item), plain(text)
    found = Items({1: item}).find(text)
    assert bool(found) == bool(item and f" {item} " in f" {text} ")


def test_short_items_of_scripts_without_spaces():
    assert Items({1: "水の沸点は何度か"}).find("問い水の沸点は何度か答え") == [(1, 0, 2, 10)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, ITEM, None, None)], DOCS)
    items = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert [r.contaminated for r in decontaminate.digests(decontaminate.contamination(docs, items.limit(0))).collect()] == [False]


def test_planted_passages_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    texts = [plain(r.text) for r in items.collect()]
    want = {r.doc_id for r in docs.collect() if any(t in plain(r.text) for t in texts)}
    got = {r.doc_id for r in decontaminate.digests(decontaminate.contamination(docs, items)).collect() if r.contaminated}
    assert want and want == got
