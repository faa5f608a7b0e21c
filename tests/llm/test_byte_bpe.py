"""Ids against the tiktoken library, and the parts by themselves."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlake.llm import byte_bpe, pieces
from orderlake.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", " ", "  a", "a  b", "\n", "a\n\nb", "a \n b", "it's  don't\t x", "a\0b c", "ab\x1cc d", "x\x85y z w", "end ", "end\n", "\n lead"]
ODD += ["日本語 テスト 123 45", "word\r\nnext", "  \n  ", "😀 😀😀", "x" * 3000, "ab" * 2000 + " q", "<|endoftext|> 'S 'll", "é ̈"]


@pytest.fixture(scope="module")
def own():
    _, tokens, perfect = byte_bpe.pack_vocabulary(PATH)
    return byte_bpe.ByteBpe(tokens, perfect, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(own, texts):
    ids, lengths = own.encode(texts)
    out, at = [], 0
    for n in lengths.tolist():
        out.append(ids[at : at + n].tolist())
        at += n
    return out


def test_odd_texts(own, library):
    assert ids_of(own, ODD) == [library.encode_ordinary(t) for t in ODD]


def test_a_small_table_gives_the_same(own, library):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["the", "of", "naïve", "Zug", "ción", "x1"]) + str(rng.randrange(50)) for _ in range(80)) for _ in range(30)]
    own.table.max_pieces = 10
    try:
        for _ in range(3):
            assert ids_of(own, texts) == [library.encode_ordinary(t) for t in texts]
    finally:
        own.table.max_pieces = 400_000


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é中1.'s\n \t \x1f\0"), max_size=40), min_size=1, max_size=4))
def test_any_spacing(own, library, texts):
    assert ids_of(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_perfect_hash_is_minimal():
    keys = [f"key{i}".encode() for i in range(2000)]
    perfect = byte_bpe.PerfectHash.of(keys)
    assert sorted(perfect.slots) == list(range(2000))
    assert [perfect.get(k) for k in keys] == list(range(2000))
    assert 0 <= perfect.get(b"another") < 2000
    one = byte_bpe.PerfectHash.of([b"a"])
    assert one.get(b"a") == one.get(b"b") == 0


def test_groups_hold_all_texts():
    texts = ["a" * n for n in (0, 5, 30, 1, 1, 50)]
    assert [t for g in pieces.grouped(texts, 20) for t in g] == texts


def test_frames(spark, library):
    rows = [(1, "one two", 7, "x"), (2, None, 8, "y"), (2, None, 8, "y"), (None, "", 9, "z")] + [(10 + i, t, 0, "") for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lengths int, decoded string")
    coded = byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "text", "lengths", "decoded", "ids"]
    got = byte_bpe.decode(coded, PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_query_against_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op6_byte_bpe"](spark, sf).collect()}
    assert got == want
