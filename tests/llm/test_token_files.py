"""Files against the tokenizers library."""

import zlib

import numpy as np
import pytest

from haulmark.llm import queries, token_files

tokenizers = pytest.importorskip("tokenizers")
ROWS = [
    (9, "Hello  World it's 42!"), (3, None), (4, ""), (1, "é é Straße ΣΑΣ\n\nx"), (7, "a\x1cb c\td   e"),
    (8, "word " * 3000), (5, "Hello"), (6, "<|endoftext|> ok"),
]


def reference(rows):
    lib = tokenizers.Tokenizer.from_file(queries.WORD_TOKENIZER)
    lib.encode_special_tokens = True
    out, start = [], 0
    for i, text in sorted(rows):
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_equals_library(spark, tmp_path, parts):
    docs = spark.createDataFrame([(i, t, 1) for i, t in ROWS], "doc_id bigint, text string, part int")
    folder = f"file://{tmp_path}/tokens"
    manifest = token_files.write(docs, folder, queries.WORD_TOKENIZER, parts=parts)
    got = sorted(map(tuple, token_files.read(spark, folder).collect()))
    assert got == reference(ROWS)
    rows = sorted(manifest.collect(), key=lambda r: r.part)
    assert [r.base for r in rows] == list(np.cumsum([0, *[r.ids for r in rows]])[:-1])
    assert {r.width for r in rows} == {2}


def test_repeated_and_null_ids(spark, tmp_path):
    docs = spark.createDataFrame([(2, "b"), (2, "a"), (None, "c"), (2, "b")], "doc_id bigint, text string")
    token_files.write(docs, str(tmp_path / "t"), queries.WORD_TOKENIZER, parts=2)
    got = token_files.read(spark, str(tmp_path / "t"), with_ids=False).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 2, 2, 2]
    assert [r.start for r in got] == [0, 2, 4, 6]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_files.write(docs, str(tmp_path / "t"), queries.WORD_TOKENIZER, parts=2).count() == 0
    assert token_files.read(spark, str(tmp_path / "t")).count() == 0


def test_words_cache_that_overflows(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", 10)
    words = token_files.Words(queries.WORD_TOKENIZER)
    lib = tokenizers.Tokenizer.from_file(queries.WORD_TOKENIZER)
    texts = [f"alpha{i} beta gamma{i % 3}" for i in range(60)]
    for at in range(0, 60, 4):
        ids, counts = words.encode(texts[at : at + 4], None)
        assert ids.tolist() == [x for t in texts[at : at + 4] for x in lib.encode(t, add_special_tokens=False).ids]


def test_words_equal_the_library_through_cache_turns(monkeypatch):
    """Signs, digits, contractions, case and letters beyond Latin, with a cache that turns all the time."""
    monkeypatch.setattr(token_files, "CACHE", 40)
    words = token_files.Words(queries.WORD_TOKENIZER)
    assert words.by_words
    signs = ["", "%%%", "***", ".", ",", "^", "'s", "'LL", "'", "42", "a1b2", "\u0130", "\u0307", "ß", "É", "ñ", "Σ", "ſ", "K", "\u00aa", "²"]
    texts = [" ".join(f"{a}{stem}{b}" for b in signs) for stem in ("word", "Été", "ÑANDÚ", "x'y", "дом", "e\u0301") for a in signs]
    lib = tokenizers.Tokenizer.from_file(queries.WORD_TOKENIZER)
    for start in range(0, len(texts), 7):
        flat, counts = words.encode(texts[start : start + 7], None)
        cuts = np.split(flat, np.cumsum(counts)[:-1])
        for text, ids in zip(texts[start : start + 7], cuts, strict=True):
            assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids


def test_another_tokenizer_encodes_whole_texts(tmp_path):
    lib = tokenizers.Tokenizer.from_file(queries.WORD_TOKENIZER)
    lib.normalizer = tokenizers.normalizers.NFC()
    lib.save(str(tmp_path / "cased.json"))
    words = token_files.Words(str(tmp_path / "cased.json"))
    assert not words.by_words
    flat, counts = words.encode(["Hello World", ""], 2)
    assert flat.tolist() == [*lib.encode("Hello World", add_special_tokens=False).ids, 2, 2] and counts.sum() == len(flat)
