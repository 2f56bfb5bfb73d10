"""Ids against the tiktoken library, and exact round trips."""

import base64
import random

import public_tokenizers
import pytest

from haulmark.llm import byte_bpe

tiktoken = pytest.importorskip("tiktoken")
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def equal(library, texts):
    ids, at = byte_bpe.codec(PATH).encode(texts)
    back = byte_bpe.codec(PATH).decode(ids, at)
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode_ordinary(text), repr(text)
        assert back[i] == text.encode()


def test_random_signs(library):
    rng = random.Random(4)
    signs = "ab'strevlmdSREVE' \t\n\r   1٣½!?.-’ ́\x1c\x85漢字🙂ñ_"
    equal(library, ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)])


def test_edges(library):
    equal(library, ["", "'s", "'", "a'", "'r", "'ll'", " 's", "\n's", "\n", "  ", " a  b ", "", "x'll's 'RE"])


def test_long_pieces(library):
    equal(library, ["ab" * 3000, "x" * 2000 + "y" * 1000, "é" * 1500, "!?" * 2000, " " * 1000 + "\n", "12" * 999])


def test_every_letter_block(library):
    points = [i for i in range(0, 0x30000, 7) if not 0xD800 <= i < 0xE000]
    equal(library, [f"a{chr(i)}1{chr(i)}!{chr(i)}  {chr(i)} {chr(i)}" for i in points])


def test_cache_that_overflows(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 20)
    equal(library, [f"word{i} other{i % 7}" for i in range(300)])


def test_frames(spark):
    rows = [(1, "it's  one", 5), (2, None, 6), (3, "", 7), (4, "é" * 3000, 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, decoded int")
    coded = byte_bpe.decode(byte_bpe.encode(docs, PATH), PATH, decoded="back")
    got = {r.doc_id: r for r in coded.collect()}
    assert {i: bytes(r.back).decode() for i, r in got.items()} == {i: t or "" for i, t, _ in rows}
    assert got[1].decoded == 5 and got[2].token_ids == []
    assert byte_bpe.encode(docs.limit(0), PATH).count() == 0


def test_one_pass_with_check(spark, library):
    rows = [(1, "it's  one", 5), (1, "it's  one", 5), (2, None, 6), (3, "", 7), (4, "é" * 3000, 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    got = byte_bpe.encode_checked(docs, PATH).collect()
    assert sorted((r.doc_id, r.token_ids) for r in got) == sorted((i, library.encode_ordinary(t or "")) for i, t, _ in rows)
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in got)
    assert byte_bpe.encode_checked(docs.limit(0), PATH).count() == 0
