import base64
import hashlib

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st

import pyarrow as pa

from stayscope.llm import bpe
from stayscope.llm.pretokens import PATTERN, cut

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_the_public_one():
    assert PATTERN == public_tokenizers.PATTERN


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="'strevldm  \n\t\r\x1c\x85 ​a中é1²٣!?😀ǅ", max_size=30), min_size=1, max_size=5))
def test_cut_gives_the_patterns_matches(texts):
    pieces = cut(pa.array(texts))
    spans = [pieces.raw[a:b].tobytes().decode() for a, b in zip(pieces.starts, pieces.ends)]
    for i, text in enumerate(texts):
        assert spans[pieces.first[i]:pieces.first[i + 1]] == regex.findall(PATTERN, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=6))
def test_encode_column_is_the_librarys(library, texts):
    with open(RANKS, "rb") as f:
        ranks = bpe.ranks_of(f.read())
    ids, bounds = bpe.KnownPieces().encode_column(pa.array(texts), ranks.encode)
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode_ordinary(text)


def test_forgetting_known_pieces_changes_nothing(library):
    with open(RANKS, "rb") as f:
        ranks = bpe.ranks_of(f.read())
    known = bpe.KnownPieces(3)
    for text in ("thrice upon lichkeit", "lichkeit upon a xyzzy", "thrice xyzzy"):
        ids, _ = known.encode_column(pa.array([text]), ranks.encode)
        assert ids.tolist() == library.encode_ordinary(text)


ROWS = [
    (1, "It's a plain text.\n\nWith two  blocks", "x"),
    (1, "It's a plain text.\n\nWith two  blocks", "x"),
    (2, None, "y"),
    (3, "", None),
    (None, "no id", "z"),
    (4, "a" * 5000 + " " + "ab" * 400, "long piece"),
    (5, " ".join(f"word{i}" for i in range(40000)), "long text"),
]


def test_documents_round_trip(spark, library):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, ids string")
    out = bpe.digests(bpe.decode(bpe.encode(docs, RANKS), RANKS)).collect()
    key = lambda row: (row[0] is None, row[0] or 0)
    assert len(out) == len(ROWS)
    for got, (doc_id, text, _) in zip(sorted(out, key=key), sorted(ROWS, key=key)):
        ids = library.encode_ordinary(text or "")
        assert tuple(got) == (
            doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        )


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.digests(bpe.decode(bpe.encode(docs, RANKS), RANKS)).count() == 0


def test_unknown_id_raises(spark):
    rows = spark.createDataFrame([(1, [99_999_999])], "doc_id bigint, ids array<int>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(rows, RANKS).collect()
