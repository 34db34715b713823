import math
import random
from collections import Counter, defaultdict
from functools import cache

import pytest
from pyspark.sql import functions as F

from stayscope.llm import kneser_ney
from stayscope.llm.queries import op10_kneser_ney

SCHEMA = "doc_id bigint, text string, lang string, score string, trusted string"


def units(text):
    raw = ("\x02" * 3 + text + "\x03").encode("utf-16-le")
    return [raw[i:i + 2] for i in range(0, len(raw), 2)]


def ngrams(text):
    u = units(text)
    return [tuple(u[i:i + 4]) for i in range(len(u) - 3)]


def brute(rows, trusted):
    """Log probability and n-grams of each text under the model of the trusted ones."""
    p = brute_model(rows, trusted)
    return [(sum(math.log(p(g)) for g in ngrams(t or "")), len(ngrams(t or ""))) for _, t, *_ in rows]


def brute_model(rows, trusted):
    """The probability of an n-gram of the table under the model of the trusted texts."""
    counts = {4: Counter(g for i, t, *_ in rows if i in trusted for g in ngrams(t or ""))}
    asked = {4: {g for _, t, *_ in rows for g in ngrams(t or "")}}
    for m in (3, 2, 1):
        counts[m] = Counter(g[1:] for g in counts[m + 1])
        asked[m] = {g[1:] for g in asked[m + 1]}

    def discount(m):
        n = Counter(counts[m].values())
        if not all(n[i] for i in (1, 2, 3, 4)):
            return kneser_ney.USUAL_DISCOUNTS
        y = n[1] / (n[1] + 2 * n[2])
        return [min(i, max(0, i - (i + 1) * y * n[i + 1] / n[i])) for i in (1, 2, 3)]

    taken = {m: (lambda c, d=discount(m): d[min(c, 3) - 1]) for m in counts}
    totals, spread = defaultdict(float), defaultdict(float)
    for m, table in counts.items():
        for g, c in table.items():
            totals[m, g[:-1]] += c
            spread[m, g[:-1]] += taken[m](c)

    @cache
    def p(g):
        m = len(g)
        if not m:
            return 1 / len(asked[1])
        below, total = p(g[1:]), totals.get((m, g[:-1]))
        if total is None:
            return below
        c = counts[m].get(g, 0)
        own = max(c - taken[m](c), 0) if c else 0
        return (own + spread[m, g[:-1]] * below) / total

    return p


def table():
    random.seed(8)
    syllables = ["ba", "lo", "mi", "té", "ru", "ka😀"]
    words = lambda n: " ".join("".join(random.choices(syllables, weights=[6, 5, 4, 3, 2, 1], k=3)) for _ in range(n))
    rows = [(i, words(random.randint(1, 30)), random.choice(["aa", "bb"]), "x", None) for i in range(60)]
    rows += [(100 + i, "#$%& !!@@ " * 5 + words(2), "aa", None, None) for i in range(5)]
    rows += [(200, None, "aa", None, None), (201, "", "bb", None, None), (202, words(9), None, None, None),
             (203, words(9), "cc", None, None), (None, words(9), "aa", None, None), rows[3], (204, "z", "aa", None, None),
             (205, words(4000), "bb", None, None)]
    return rows


@pytest.mark.parametrize("table_bytes, tallied", [(1 << 20, 1_000_000), (40 * kneser_ney.ENTRY_BYTES, 50), (0, 50)])
def test_scores_are_the_models(spark, monkeypatch, table_bytes, tallied):
    monkeypatch.setattr(kneser_ney, "TALLIED", tallied)
    rows, trusted = table(), set(range(0, 50))
    ids = spark.createDataFrame([(i,) for i in trusted] + [(None,), (3,), (999,)], "id bigint")
    out = kneser_ney.judge(spark.createDataFrame(rows, SCHEMA).repartition(3), ids, quantile=0.9, table_bytes=table_bytes)
    got = {(r.doc_id, r.lang, round(r.perplexity or 0, 4)): r for r in out.collect()}
    logs = brute(rows, trusted)
    average = {}
    for lang in ("aa", "bb", None):
        own = [x for r, x in zip(rows, logs) if r[0] in trusted and (lang is None or r[2] == lang)]
        average[lang] = sum(t for t, _ in own) / sum(n for _, n in own)
    scores = defaultdict(list)
    for (doc_id, text, lang, *_), (total, n) in zip(rows, logs):
        if not text:
            r = got[doc_id, lang, 0]
            assert r.perplexity is None and r.score is None and r.keep is False
            continue
        perplexity = math.exp(-total / n)
        r = got[doc_id, lang, round(perplexity, 4)]
        mean = average.get(lang, average[None])
        assert math.isclose(r.perplexity, perplexity, rel_tol=1e-5)
        assert math.isclose(r.score, math.exp(-(total + 50 * mean) / (n + 50)), rel_tol=1e-5)
        assert r.keep == (r.score <= r.threshold)
        if doc_id in trusted:
            scores[lang].append(r.score)
            scores[None].append(r.score)
    for r in got.values():
        own = sorted(scores.get(r.lang, scores[None]))
        assert math.isclose(r.threshold, own[math.ceil(0.9 * len(own)) - 1], rel_tol=1e-9)
    assert out.count() == len(rows)
    assert not any(r.keep for r in got.values() if r.doc_id in range(100, 105))


def test_without_trusted_documents_all_with_content_are_kept(spark):
    docs = spark.createDataFrame([(1, "words", "aa", None, None), (2, "", None, None, None)], SCHEMA)
    out = {r.doc_id: r for r in kneser_ney.judge(docs, spark.createDataFrame([], "doc_id bigint")).collect()}
    assert (out[1].keep, out[2].keep, out[1].threshold) == (True, False, None)
    assert math.isclose(out[1].perplexity, len(set(units("words")[3:])), rel_tol=1e-6)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert kneser_ney.judge(docs, spark.createDataFrame([(1,)], "doc_id bigint")).count() == 0


def test_ids_joined_by_a_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"words {i}", "aa", None, None) for i in range(20)], SCHEMA)
    ids = spark.createDataFrame([(i,) for i in range(9)], "doc_id bigint")
    want = sorted(map(tuple, kneser_ney.judge(docs, ids).collect()))
    monkeypatch.setattr(kneser_ney, "BROADCAST_IDS", 0)
    assert sorted(map(tuple, kneser_ney.judge(docs, ids).collect())) == want


def test_labelled_documents_of_the_test_table(spark):
    folder = "/root/testdata/sf0.1"
    judged = op10_kneser_ney(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    share = {(r.quality, r.toxic): r.kept for r in judged.groupBy("quality", "toxic").agg(
        F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert share[1, 0] > 0.99 and share[0, 0] < 0.1 and share[0, 1] < 0.1
