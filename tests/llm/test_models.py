"""Language and toxicity on held-out rows of the generated tables, and on small edge cases."""

import math
import os
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmark.llm import language, toxicity
from haulmark.llm.blocks import held_out, table

SF = "/root/testdata/sf0.01"
generated = pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables")


@pytest.fixture(scope="module")
def languages(spark):
    return language.fit(table(spark, SF, "documents"), ~held_out())


@generated
def test_held_out_languages(spark, languages):
    docs = table(spark, SF, "documents").filter(held_out())
    got = language.identify(docs, languages).select("lang", "lang_pred", "lang_score", "lang_rejected").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert sum(r.lang_rejected for r in got) <= 0.01 * len(got)
    assert all(0 <= r.lang_score <= 1 for r in got)


@generated
def test_odd_texts(spark, languages):
    rows = [(1, None, 1), (2, "", 1), (3, "123 !?", 1), (4, "the", 1), (5, "the and of with " * 30_000, 1), (6, "русский язык это не то", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang_pred int")
    got = {r.doc_id: r for r in language.identify(docs, languages).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert all(got[i].lang_score == 0 and got[i].lang_rejected for i in (1, 2, 3))
    assert got[5].lang_pred == "en" and not got[5].lang_rejected
    assert got[6].lang_score < got[5].lang_score
    assert language.identify(docs.limit(0), languages).count() == 0


@generated
def test_score_does_not_depend_on_neighbours(spark, languages):
    texts = ["the and of", "le la et que", "", "der die und"]
    together = languages.predict(texts)[1]
    assert [languages.predict([t])[1][0] for t in texts] == pytest.approx(together)


@generated
def test_rejected_rows_go_and_null_labels_are_filled(spark, languages):
    docs = spark.createDataFrame([(1, "the and of with that", None, "s"), (2, "12", "en", "s"), (3, None, None, "s")], "doc_id bigint, text string, lang string, source string")
    got = language.keep_identified(docs, languages).collect()
    assert [tuple(r) for r in got] == [(1, "the and of with that", "en", "s")]


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    model = language.fit(docs, F.lit(True))
    assert {r.lang_pred for r in language.identify(docs, model).collect()} == {"und"}


def small(spark):
    clean = [(i, f"word{i} some clean text about things number{i}", 0) for i in range(60)]
    # A term must stand after different words: the same sentence again and again makes none.
    toxic = [(100 + i, f"word{i} some text about things clean{i} idiot number{i}", 1) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in clean + toxic], "doc_id bigint, text string")
    return docs, spark.createDataFrame([(i, 0, y) for i, _, y in clean + toxic], "doc_id bigint, quality int, toxic int")


def test_lexicon_and_folding(spark):
    docs, labels = small(spark)
    model = toxicity.fit(docs, labels, F.lit(True))
    assert " idiot " in model.terms
    texts = ["an IDIOT here", "an 1d10t here", "an іdіоt here", "ｉｄｉｏｔ", "an idi​ot", "some clean text", "idiotic10", "", "word " * 20_000 + "idiot"]
    score = model.score(texts)
    assert (score[:5] > 0.5).all()
    assert (score[5:8] < 0.5).all()
    rows = spark.createDataFrame([(1, None, 1), (2, "idiot", 1)], "doc_id bigint, text string, toxic_score int")
    got = {r.doc_id: r.toxic_score for r in toxicity.score(rows, model).collect()}
    assert got[1] < 0.5 < got[2]
    assert toxicity.score(rows.limit(0), model).count() == 0


def test_exception_phrases(spark):
    docs, labels = small(spark)
    more = spark.createDataFrame([(200 + i, f"things number{i} idiot savant") for i in range(4)], "doc_id bigint, text string")
    clean = spark.createDataFrame([(200 + i, 0, 0) for i in range(4)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs.union(more), labels.union(clean), F.lit(True), odds=1.0)
    assert model.score(["idiot savant"])[0] < 0.5 < model.score(["idiot number"])[0]


def test_labels_of_one_kind_or_none(spark):
    docs, labels = small(spark)
    assert toxicity.fit(docs, labels.filter("toxic = 0"), F.lit(True)).score(["idiot"])[0] < 0.5
    assert toxicity.fit(docs, labels.limit(0), F.lit(True)).score(["idiot"])[0] < 0.5


@generated
@pytest.mark.parametrize("folder,least", [(SF, 0.5), (SF.replace("0.01", "0.1"), 0.7)])
def test_held_out_toxicity(spark, folder, least):
    """The smallest tables hold a few dozen toxic rows to learn from; about a fifth of the labels 1 mark documents without any toxic word."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels, ~held_out())
    got = toxicity.score(docs.filter(held_out()), model).join(labels, "doc_id").select("toxic", "toxic_score").collect()
    assert sum(r.toxic == 0 and r.toxic_score >= 0.5 for r in got) <= 0.01 * sum(r.toxic == 0 for r in got)
    assert sum(r.toxic == 1 and r.toxic_score >= 0.5 for r in got) >= least * sum(r.toxic == 1 for r in got)


def plain_language(model, text):
    """The prediction one subword at a time."""
    letter = lambda c: unicodedata.category(c)[0] in "LM"
    symbols, before = [0], False
    for c in text.lower():
        if letter(c) or before:
            symbols.append(ord(c) if letter(c) else 0)
        before = letter(c)
    symbols.append(0)
    found = []
    for size in language.SIZES:
        for start in range(len(symbols) - 1):
            gram = symbols[start : start + size]
            if len(gram) < size or (size == 2 and not any(gram)) or not all(gram[1:-1]):
                continue
            code = size * 0x165667B1
            for x, factor in zip(gram, language.FACTORS, strict=False):
                code += x * int(factor)
            code &= 0xFFFFFFFF
            found.append((((code ^ code >> 15) * 0x2C1B3C6D) & 0xFFFFFFFF) >> (32 - language.BITS))
    if not any(letter(c) for c in text):
        return language.NONE, 0.0
    a, b = model.scale
    raw = np.mean([model.logits[i].astype(float) for i in found], axis=0) + model.bias
    z = np.exp(raw * math.exp(a + b * math.log(len(found))))
    p = z / z.sum()
    return model.names[int(p.argmax())], float(p.max())


@generated
def test_predictions_equal_a_plain_loop(spark, languages):
    texts = [r.text or "" for r in table(spark, SF, "documents").filter(held_out()).select("text").limit(60).collect()]
    texts = [t[:1500] for t in texts] + ["", "a", "a.", ".a", "1 2", "été-là", "x\ny", "das ist", "  the  ", "É" * 9]
    names, score, _ = languages.predict(texts)
    want = [plain_language(languages, t) for t in texts]
    assert names == [n for n, _ in want]
    # The model adds in single precision.
    assert score.tolist() == pytest.approx([s for _, s in want], abs=2e-3)


def test_a_wrong_label_that_was_copied_makes_no_term(spark):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(200):
        text = list(rng.choice(words, 30))
        if i % 5 == 0:
            text[3:3] = ["moron"]
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    wrong = list(rng.choice([f"q{chr(97 + i)}x" for i in range(26)], 40))
    for i in range(40):
        rows.append((1000 + i, " ".join([*wrong, "end", "of", "copy", str(i)])))
        labels.append((1000 + i, 1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), F.lit(True))
    assert any("moron" in t for t in model.terms) and not any(t.strip().startswith("q") for t in model.terms)


def test_chance_is_the_binomial_tail():
    assert toxicity.chance_of(0, 5, 0.3) == pytest.approx(1.0)
    assert toxicity.chance_of(2, 1, 0.5) == pytest.approx(0.5)
    assert toxicity.chance_of(3, 0, 0.1) == pytest.approx(1e-3)
