import base64
import hashlib
import math

import public_tokenizers
import tiktoken
import xxhash

import corpus_pipeline
from stayscope.llm import decontaminate
from tests.llm.test_decontaminate import brute as edit_distance
from tests.llm.test_kneser_ney import brute_model, ngrams
from tests.llm.test_simhash import brute_components, brute_print
from tests.llm.test_substring import brute as without_repeats

FOLDER = "/root/testdata/sf0.001"


BLANK = {c.encode("utf-16-le") for c in "\t\n\x0b\x0c\r \xa0\u3000"}


def word_lists(grams):
    """The n-grams of a text by word: a word ends behind a blank, or after 24 units."""
    out = []
    for i, g in enumerate(grams):
        if not i or grams[i - 1][-1] in BLANK or len(out[-1]) == 24:
            out.append([])
        out[-1].append(g)
    return out


def brute_quality(rows, trusted):
    """Rows kept, and rows too near a threshold to tell, by held-out thresholds for the mean and the worst word."""
    models = [brute_model(rows, trusted)]
    fold = {i: 1 + xxhash.xxh64_intdigest((t or "").encode(), seed=42) % 4 for i, t, _ in rows}
    models += [brute_model(rows, {i for i in trusted if fold[i] != f}) for f in (1, 2, 3, 4)]

    def figures(text, p):
        words = word_lists(ngrams(text))
        logs = [sum(math.log(p(g)) for g in w) for w in words]
        return sum(logs), sum(map(len, words)), max(-x / (len(w) + 2) for x, w in zip(logs, words))

    kept, unclear = set(), set()
    for lang in {g for _, _, g in rows}:
        own = {i: figures(t, models[0]) for i, t, g in rows if g == lang and t}
        held = [figures(t, models[fold[i]]) for i, t, g in rows if g == lang and t and i in trusted]
        if lang is None or not held:
            kept |= set(own)
            continue
        average = sum(t for t, _, _ in held) / sum(n for _, n, _ in held)
        limits = []
        for value in (lambda t, n, w: math.exp(-(t + 50 * average) / (n + 50)), lambda t, n, w: math.exp(w)):
            cut = sorted(value(*h) for h in held)[math.ceil(0.995 * len(held)) - 1]
            limits.append((value, cut))
        for i, f in own.items():
            shares = [value(*f) / cut for value, cut in limits]
            kept |= {i} if max(shares) <= 1 else set()
            unclear |= {i} if abs(max(shares) - 1) < 1e-5 else set()
    return kept, unclear


def test_every_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    items = [decontaminate.plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns, results = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        results[name] = before, {r.doc_id: r for r in docs.collect()}
        assert name == "byte_bpe" or docs.columns == columns
        assert docs.count() == len(results[name][1])

    before, after = results["quality"]
    rows = [(r.doc_id, r.text, r.lang) for r in before.values()]
    trusted = {r.doc_id for r in labels if r.quality == 1 and r.toxic == 0}
    kept, unclear = brute_quality(rows, trusted)
    # Scores are sums of single-precision numbers: a tie with the threshold may fall on either side.
    assert kept ^ set(after) <= unclear and len(unclear) < 3 and 0 < len(after) < len(before)

    before, after = results["near_dedup"]
    groups = brute_components({i: brute_print(r.text) for i, r in before.items()}, 2)
    assert set(after) == set(groups.values()) and len(after) < len(before)

    before, after = results["substring_dedup"]
    want = {r[0]: r for r in without_repeats([(i, r.text) for i, r in before.items()], 50)}
    assert any(r[2] for r in want.values())
    assert set(after) == {i for i, r in want.items() if r[2] < r[1] or not r[1]}
    for i, r in after.items():
        words = b" ".join(r.text.encode().split())
        assert hashlib.sha256(words).hexdigest() == want[i][3]
        if want[i][2]:
            assert r.n_chars == len(r.text) and words == r.text.encode()
        else:
            assert r == before[i]

    before, after = results["decontaminate"]
    clean = set()
    for i, r in before.items():
        text = decontaminate.plain(r.text)
        found = any(x in text for x in items)
        if not found and len(text) < 1500:
            found = any(edit_distance(x, text) <= len(x) // decontaminate.EDIT_SHARE for x in items)
        if not found:
            clean.add(i)
    assert set(after) == clean and len(after) < len(before)

    before, after = results["byte_bpe"]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(after) == set(before)
    for i, r in before.items():
        ids = library.encode_ordinary(r.text)
        assert (after[i].n_tokens, after[i].ids_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_odd_rows_pass_all_stages(spark, tmp_path):
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [
        (1, passage + " first one here", "en", "s", 1), (2, "second " + passage, None, None, None),
        (2, "second " + passage, None, None, None), (3, passage, "en", "s", 3), (4, None, "en", "s", None),
        (5, "", None, "s", 0), (None, "without id", "en", None, 10), (None, "without id", "en", None, 10),
        (6, "long words " * 20000, "xx", "s", 5),
    ]
    (spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet"))
    (spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").limit(0)
     .write.parquet(f"{tmp_path}/labels.parquet"))
    (spark.createDataFrame([(1, "nothing of this stands anywhere at all")], "item_id bigint, text string")
     .write.parquet(f"{tmp_path}/benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [
        (False, 1), (False, 2), (False, 6), (True, 0), (True, 0)]


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_of_one_id_with_different_texts_are_two(spark):
    long = [" ".join(f"{name}{i}" for i in range(60)) for name in "abc"]
    rows = [(1, long[2]), (7, long[0]), (7, long[1]), (7, long[1]), (8, long[1].upper()), (9, long[0]), (9, long[2])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    out = sorted((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, None).collect())
    assert out == sorted([(1, long[2]), (7, long[0]), (7, long[1])])
