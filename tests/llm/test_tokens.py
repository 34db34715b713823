import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from stayscope.llm import token_counts, token_store
from stayscope.session import shared_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, n_tokens string"
ROWS = [
    (5, "Plain words, twice: plain words.", None),
    (5, "Plain words, twice: plain words.", "repeated"),
    (3, None, "null"),
    (4, "", "empty"),
    (None, "without an id", ""),
    (1, "in<|endoftext|>side <|endoftext|>", "special strings"),
    (2, " ".join(f"w{i % 700}ord" for i in range(30000)), "long"),
    (9, "z" * 3000, "one long piece"),
    (7, "naïve 中文 😀\n\n  it's", "marks"),
]


@pytest.fixture(scope="module")
def ids_of():
    library = Tokenizer.from_file(PATH)
    return lambda text: library.encode(text or "", add_special_tokens=False).ids


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.mark.parametrize("table_bytes", [1 << 20, 24 * token_counts.ENTRY_BYTES, 0])
def test_counts_are_the_librarys(spark, docs, ids_of, table_bytes):
    out = token_counts.token_counts(docs, PATH, limit=8, table_bytes=table_bytes)
    want = [(i, len((t or "").encode()), len(ids_of(t)), len(ids_of(t)) > 8) for i, t, _ in ROWS]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)


def test_tally_in_small_lots(spark, docs, ids_of, monkeypatch):
    monkeypatch.setattr(token_counts, "TALLIED", 5)
    out = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, PATH).collect()}
    assert out == {i: len(ids_of(t)) for i, t, _ in ROWS}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert token_counts.token_counts(docs, PATH).count() == 0
    folder = shared_folder(spark)
    token_store.write_store(docs, PATH, folder)
    assert token_store.digests(token_store.read_store(spark, folder)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**32 - 1)), max_size=2000))
def test_pack_round_trip_and_random_access(ids):
    ids = np.array(ids, dtype=np.uint32)
    levels = token_store.pack(ids)
    assert token_store.unpack(levels).tolist() == ids.tolist()
    if len(ids):
        places = np.array([random.randrange(len(ids)) for _ in range(50)])
        assert token_store.look_up(levels, places).tolist() == ids[places].tolist()


def test_store_round_trip(spark, docs, ids_of, monkeypatch):
    monkeypatch.setattr(token_store, "SEGMENT_TOKENS", 50)
    folder = shared_folder(spark)
    token_store.write_store(docs, PATH, folder)
    got = sorted(map(tuple, token_store.digests(token_store.read_store(spark, folder)).collect()), key=lambda r: r[1])
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    start, stream = 0, []
    for (doc_id, text, _), row in zip(rows, got, strict=True):
        ids = [*ids_of(text), 0]
        assert row == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        stream += ids
    asked = [0, 1, len(stream) - 1, len(stream), -1, 17, 17, None, *range(100, 130)]
    places = spark.createDataFrame([(x,) for x in asked], "place bigint")
    found = {r.place: r.token_id for r in token_store.tokens_at(spark, folder, places).collect()}
    assert found == {x: stream[x] for x in asked if x is not None and 0 <= x < len(stream)}


def test_whole_small_table(spark, ids_of):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: ids_of(r.text) for r in docs.collect()}
    counts = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, PATH).collect()}
    assert counts == {i: len(ids) for i, ids in want.items()}
    folder = shared_folder(spark)
    token_store.write_store(docs, PATH, folder)
    stored = {r.doc_id: r.ids for r in token_store.read_store(spark, folder).collect()}
    assert stored == {i: [*ids, 0] for i, ids in want.items()}


def test_digests_are_read_by_one_worker_a_task(spark, tmp_path):
    """The digests of what is read, without a second Python step beside the reading one."""
    docs = spark.createDataFrame([(3, "a b c"), (1, None), (2, "größe " * 50), (None, "x")], "doc_id bigint, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_store.write_store(docs.repartition(3), path, str(tmp_path / "ids"))
    found = token_store.read_digests(spark, str(tmp_path / "ids"))
    wanted = token_store.digests(token_store.read_store(spark, str(tmp_path / "ids")))
    assert sorted(found.collect(), key=str) == sorted(wanted.collect(), key=str) and found.count() == 4
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
