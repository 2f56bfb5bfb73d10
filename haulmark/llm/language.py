"""Language of a text: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

Letters stay, everything else is one word border. Every run of two to four characters inside a word (borders included) is a
subword; its hash picks a row of an embedding table. The mean of the rows of a text goes through a linear softmax. Table and
softmax are trained together by stochastic gradient descent in numpy on windows of a bounded sample of labelled rows:
about ``per_language`` documents for each label, three windows of at most ``window`` characters each, taken anywhere in the text.

A quarter of the sample is not trained on. On it the logits get a scale that grows with the number of subwords, so that the
score is the probability of being right for short and long texts alike, and the rejection threshold is set: the score below
which ``reject`` of its rightly predicted windows lie, at most one half.

Prediction folds table and softmax into one row of logits per bucket, so a text costs a gather and a sum a character. It is a
map over whole texts: nothing is shuffled. Null text and text without letters are ``und`` with score 0 and rejected. A language
that only unlabelled rows have cannot be predicted; with no labelled row at all everything is ``und``. Of equal scores the first
label in alphabetical order is predicted. Repeated rows get the same prediction each. ``identify`` replaces columns that have
the names of its own; ``keep_identified`` changes no column but null labels. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.session import small_side

from .blocks import SMALL_SLICE, add_columns, categories, code_points, fresh, job, slices, texts_of

BITS = 16
DIM = 16
SIZES = (2, 3, 4)
NONE = "und"
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all subwords, text by text; per text the number of subwords and whether it has a letter."""
    points = code_points("\n" + "\n".join(t.lower().replace("\n", " ") for t in texts) + "\n")
    kinds = categories()[points]
    letter = (kinds == ord("L")) | (kinds == ord("M"))
    new_text = points == 10
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept |= new_text
    symbols = np.where(letter, points, 0)[kept]
    owner = (np.cumsum(new_text, dtype=np.int32) - 1)[kept]
    has_letter = np.zeros(len(texts) + 1, dtype=bool)
    has_letter[owner[symbols != 0]] = True
    buckets, owners = [], []
    for size in SIZES:
        n = len(symbols) - size + 1
        if n <= 0:
            continue
        code = np.full(n, size * 0x165667B1 & 0xFFFFFFFF, dtype=np.uint32)
        whole = np.ones(n, dtype=bool)
        for i in range(size):
            code += symbols[i : i + n] * FACTORS[i]
            if 0 < i < size - 1:
                whole &= symbols[i : i + n] != 0
        if size == 2:
            whole = (symbols[:-1] != 0) | (symbols[1:] != 0)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        buckets.append((code >> np.uint32(32 - BITS))[whole])
        owners.append(owner[:n][whole])
    if not buckets:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64), has_letter[: len(texts)]
    bucket, own = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    counts = np.bincount(own, minlength=len(texts) + 1)[: len(texts)]
    return bucket[order][: counts.sum()], counts, has_letter[: len(texts)]


def _sums(table: np.ndarray, bucket: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(counts), table.shape[1]))
    full = np.flatnonzero(counts)
    if full.size:
        starts = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(table[bucket], starts, axis=0)
    return out


@dataclass(frozen=True)
class LanguageModel:
    names: tuple[str, ...]
    logits: np.ndarray
    bias: np.ndarray
    scale: tuple[float, float]
    threshold: float

    def raw(self, bucket: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _sums(self.logits, bucket, counts) / np.maximum(counts, 1)[:, None] + self.bias

    def probabilities(self, raw: np.ndarray, counts: np.ndarray) -> np.ndarray:
        a, b = self.scale
        z = raw * np.exp(a + b * np.log(np.maximum(counts, 1)))[:, None]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        bucket, counts, has_letter = subwords(texts)
        if not self.names:
            return [NONE] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        p = self.probabilities(self.raw(bucket, counts), counts)
        best = p.argmax(axis=1)
        score = np.where(has_letter, p[np.arange(len(texts)), best], 0.0)
        names = [self.names[i] if ok else NONE for i, ok in zip(best, has_letter, strict=True)]
        return names, score, ~has_letter | (score < self.threshold)


def _windows(texts: list[str], langs: list[str], window: int, seed: int) -> tuple[list[str], list[str]]:
    """Three windows of each text, of 20 characters up to ``window``, anywhere in it; a short text as it is."""
    rng = np.random.default_rng(seed)
    out, labels = [], []
    for text, lang in zip(texts, langs, strict=True):
        for size in np.exp(rng.uniform(np.log(20), np.log(window), 3)).astype(int):
            start = int(rng.integers(0, max(1, len(text) - size + 1)))
            out.append(text[start : start + size])
            labels.append(lang)
    return out, labels


def sample(docs: DataFrame, learn: Column, *, lang: str, text: str, doc_id: str, per_language: int, window: int) -> pd.DataFrame:
    """Windows of about ``per_language`` rows of each label, picked by a hash of the id; three windows a row."""
    known = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    mixed = F.xxhash64(F.col(doc_id), F.lit("language sample"))
    # Counts and ids first, so that texts are read only for the rows that are picked.
    stages = job(docs.sparkSession, "language")
    ids = known.select(F.col(doc_id).alias("_id"), F.col(lang).alias("_lang"), (F.pmod(mixed, F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("_u"))
    counts = stages.keep("counts", ids.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")))
    ids = ids.join(small_side(counts), "_lang").filter(F.col("_u") * F.col("_n") < per_language)
    ids = small_side(stages.keep("ids", ids.select("_id", F.col("_lang").alias("lang")).distinct()))
    rows = known.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).join(ids, ["_id", "lang"])

    def cut(batches):
        for batch in slices(batches, "text"):
            texts, langs = texts_of(batch, "text"), batch.column(batch.schema.get_field_index("lang")).to_pylist()
            seeds = batch.column(batch.schema.get_field_index("_id")).to_pylist()
            for t, lang, seed in zip(texts, langs, seeds, strict=True):
                w, names = _windows([t], [lang], window, abs(seed or 0))
                yield pa.RecordBatch.from_pydict({"id": pa.array([seed] * len(w), pa.int64()), "text": w, "lang": names}, schema=pa.schema([("id", pa.int64()), ("text", pa.string()), ("lang", pa.string())]))

    return rows.mapInArrow(cut, "id bigint, text string, lang string").toPandas().sort_values(["id", "lang", "text"])


def train(windows: pd.DataFrame, *, epochs: int = 6, rate: float = 0.5, batch: int = 32, reject: float = 0.0005, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent on three quarters of the windows, calibration on the last quarter."""
    names = tuple(sorted(windows["lang"].unique()))
    if not names:
        return LanguageModel((), np.zeros((1 << BITS, 0), np.float32), np.zeros(0), (0.0, 0.0), 0.0)
    label = windows["lang"].map({n: i for i, n in enumerate(names)}).to_numpy()
    bucket, counts, has_letter = subwords(windows["text"].tolist())
    starts = np.cumsum(counts) - counts
    side = (windows["id"].fillna(0).to_numpy().astype(np.int64) * 2654435761 >> 7) % 4 == 0
    fit, check = np.flatnonzero(~side & has_letter), np.flatnonzero(side & has_letter)
    if not fit.size:
        fit = check
    rng = np.random.default_rng(seed)
    table = np.zeros((1 << BITS, DIM))
    weight = rng.normal(0, 1 / np.sqrt(DIM), (DIM, len(names)))
    bias = np.zeros(len(names))
    steps = epochs * -(-len(fit) // batch)
    done = 0
    for _ in range(epochs):
        order = rng.permutation(fit)
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            n = counts[pick]
            ids = np.concatenate([bucket[s : s + c] for s, c in zip(starts[pick], n, strict=True)])
            mean = _sums(table, ids, n) / n[:, None]
            z = mean @ weight + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            grad = z / z.sum(axis=1, keepdims=True)
            grad[np.arange(len(pick)), label[pick]] -= 1
            step = rate * (1 - done / steps)
            back = grad @ weight.T / n[:, None]
            weight -= step / len(pick) * (mean.T @ grad)
            bias -= step / len(pick) * grad.sum(axis=0)
            np.add.at(table, ids, -step * np.repeat(back, n, axis=0))
            done += 1
    model = LanguageModel(names, (table @ weight).astype(np.float32), bias, (0.0, 0.0), 0.0)
    check = check if check.size else fit
    ids = np.concatenate([bucket[starts[i] : starts[i] + counts[i]] for i in check]) if check.size else bucket[:0]
    raw, n, y = model.raw(ids, counts[check]), counts[check], label[check]

    def loss(scale: tuple[float, float]) -> float:
        p = LanguageModel(names, model.logits, bias, scale, 0.0).probabilities(raw, n)
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    grid = [(a, b) for a in np.linspace(-1, 3, 21) for b in np.linspace(0, 0.8, 9)]
    scale = min(grid, key=loss)
    p = LanguageModel(names, model.logits, bias, scale, 0.0).probabilities(raw, n)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y])
    threshold = min(0.5, float(right[int(reject * len(right))])) if right.size else 0.0
    return LanguageModel(names, model.logits, bias, scale, threshold)


def fit(docs: DataFrame, learn: Column, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 600, window: int = 400) -> LanguageModel:
    return train(sample(docs, learn, lang=lang, text=text, doc_id=doc_id, per_language=per_language, window=window))


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and lang_pred, lang_score, lang_rejected."""

    def run(texts: list[str]):
        names, score, rejected = model.predict(texts)
        return pa.array(names, pa.string()), pa.array(score), pa.array(rejected)

    return add_columns(docs, text, "lang_pred string, lang_score double, lang_rejected boolean", run, SMALL_SLICE)


def keep_identified(docs: DataFrame, model: LanguageModel, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with their own columns; a null label becomes the predicted one.

    Texts go to Python once and do not come back: it names the rows that are rejected or have no label, by id and text hash,
    and the rows themselves are filtered and labelled by a join with these few.
    """
    own_id, own_key, own_lang, own_bad = fresh(docs.columns, "_id", "_key", "_lang", "_bad")
    asked = docs.select(F.col(doc_id).alias(own_id), F.xxhash64(F.col(text)).alias(own_key), F.col(lang).isNull().alias(own_lang), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, "text", SMALL_SLICE):
            names, _, rejected = model.predict(texts_of(batch, "text"))
            said = rejected | batch.column(2).to_numpy(zero_copy_only=False)
            out = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(out, names=[own_id, own_key, own_lang, own_bad]).filter(pa.array(said))

    stages = job(docs.sparkSession, "identified")
    said = asked.mapInArrow(run, f"`{own_id}` {kind}, `{own_key}` bigint, `{own_lang}` string, `{own_bad}` boolean")
    said = small_side(stages.keep("said", said.dropDuplicates([own_id, own_key])))
    joined = docs.join(said, docs[doc_id].eqNullSafe(said[own_id]) & (F.xxhash64(docs[text]) == said[own_key]), "left")
    label = F.coalesce(docs[lang], said[own_lang].cast(docs.schema[lang].dataType)).alias(lang)
    return joined.filter(~F.coalesce(said[own_bad], F.lit(False))).select(*[label if c == lang else docs[c] for c in docs.columns])
