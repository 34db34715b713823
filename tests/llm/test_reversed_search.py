import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stayscope.llm import reversed_search
from stayscope.llm.queries import ORACLES, op11_reversed_search
from checks.compare import oracle_connection

FOLDER = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """item row, rank, doc_id, score by counting everything in the plainest way."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    full = [(i, c, sum(c.values())) for i, c in counted if c]
    big_n, big_l = len(full), sum(n for _, _, n in full)
    out = []
    for item_id, text in items:
        scored = []
        for doc, c, n in full:
            m = 100 - 90 + (90 * n * big_n) // big_l
            score = 0
            for t in set(terms(text)):
                df = sum(t in x for _, x, _ in full)
                w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) if c[t] else 0
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item_id, r, None if no else d, -s) for r, (s, no, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k=10, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    rows = reversed_search.search(d, i, k, **more).collect()
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in rows), key=str)


DOCS = [
    (5, "Alpha beta gamma, alpha!"), (3, "alpha beta gamma alpha"), (9, "ALPHA"), (4, "été Été ÉTÉ x-y_z 12a"), (1, None),
    (2, ""), (6, " .,; "), (7, "zeta " * 5000 + "alpha"), (3, "alpha beta gamma alpha"), (None, "alpha beta gamma alpha"),
    (8, "\u0085alpha beta"), (-1, "gamma"),
]
ITEMS = [(1, "alpha beta alpha"), (2, "Été z"), (3, None), (4, " ,"), (5, "nowhere"), (1, "alpha beta alpha"), (1, "gamma"), (None, "y 12A")]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_small_rows_against_brute_force(spark, k):
    want = brute(DOCS, list(dict.fromkeys(ITEMS)), k)
    assert found(spark, DOCS, ITEMS, k) == want
    assert any(r[2] is None for r in want) or k < 10


def test_blocks_of_items_and_parts_of_texts_change_nothing(spark, monkeypatch):
    want = found(spark, DOCS, ITEMS)
    monkeypatch.setattr(reversed_search, "BLOCK_BYTES", 8)
    assert found(spark, DOCS, ITEMS) == want
    monkeypatch.setattr(reversed_search, "PART_BYTES", 7)
    assert [t for part in reversed_search.terms("One two  three_four fünf") for t in part] == [
        b"one", b"two", b"three", b"four", "fünf".encode()]
    monkeypatch.setattr(reversed_search, "CELLS", 3)
    index = reversed_search.ItemIndex.of([[0, 1], [1], [1, 2]], reversed_search.np.array([2, 3, 1]), 9, 30)
    doc, term = reversed_search.np.array([0, 0, 1, 1]), reversed_search.np.array([0, 1, 1, 2])
    n, tf = reversed_search.np.array([4, 3]), reversed_search.np.array([1, 2, 1, 2])
    small = index.scores(doc, n, term, tf)
    monkeypatch.setattr(reversed_search, "CELLS", 1 << 20)
    assert (small == index.scores(doc, n, term, tf)).all() and (small > 0).sum() == 6


def test_many_copies_tie_by_id_across_tasks(spark):
    docs = [(i, "same words here") for i in range(400, 0, -1)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    i = spark.createDataFrame([(1, "words"), (2, "same here")], "item_id bigint, text string")
    more = d.unionByName(spark.createDataFrame([(1000 + i, f"other{i}") for i in range(900)], d.schema))
    rows = reversed_search.search(more, i, 10).collect()
    assert sorted((r.item_id, r.rank, r.doc_id) for r in rows) == [(q, j, j) for q in (1, 2) for j in range(1, 11)]


def test_empty_tables_and_clashing_columns(spark):
    assert found(spark, [], ITEMS) == [] and found(spark, DOCS, []) == []
    assert found(spark, [(1, None), (2, "--")], ITEMS) == []
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    odd = docs.withColumnsRenamed({"doc_id": "id", "text": "body"}).withColumns(
        {"item": F.lit(1), "score": F.lit("x"), "rank": F.lit(0), "n": F.lit(None), "doc_id": F.lit(7), "text": F.lit("alpha")})
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    rows = reversed_search.search(odd, items, 10, "id", "body").collect()
    assert sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in rows), key=str) == brute(DOCS, list(dict.fromkeys(ITEMS)), 10)


def test_query_against_sql(spark):
    rows = sorted(tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in op11_reversed_search(spark, FOLDER).collect())
    want = oracle_connection(FOLDER).sql(ORACLES["op11_reversed_search"]).select("item_id, rank, doc_id, score").fetchall()
    assert rows == sorted(want) and len(rows) > 100
