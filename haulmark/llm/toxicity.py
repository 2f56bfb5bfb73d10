"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length, with exception phrases.

Folding lowers the case, maps look-alike letters of other scripts and wide forms to their Latin letters, drops invisible marks
and reads digits and signs inside a word as the letters they stand for (``1d10t``, ``m0r0n``). Accents stay: they tell words
of different languages apart. Everything else is a word border.

Terms are learned from labelled documents. Candidates are whole words and word beginnings of 4 to 10 letters; for each the
documents of either label that hold it are counted on Spark, from a sample of at most about ``per_label`` documents a label.
A term is kept when ``support`` toxic documents, and one in ``per_term`` of them, hold it and its smoothed log odds reach
``odds``, when fewer than ``by_chance`` terms with such counts are to be expected among all candidates if labels were dealt at
random (of millions of rare candidates some are in five toxic documents and few others), and when as many different words stand before it, so that copies of one passage do not make a term; of beginnings that
stand for the same words only the longest is kept. Its weight is its log odds. Of copies and near copies in the sample (equal
least hash of their five-word shingles) one document of each label counts, so a wrong label that was copied stays one.

Exceptions are phrases of a matched word with the word before or after it that clean documents hold and toxic ones do not: a
match inside such a phrase does not count.

The score is a logistic function of the summed weights, of that sum divided by the number of words, and of whether anything
matched at all, fitted by gradient descent on the same sample. Prediction is a map over whole texts: nothing is shuffled.
Null and empty texts have no match and the score of no match. Repeated rows get the same score each; a column of the name of the
new one is replaced; an empty table gives an empty result. Without labels of both kinds the lexicon is empty and every
score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import exp, lgamma
from math import log as math_log

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.session import small_side

from .blocks import SMALL_SLICE, add_columns, job, slices, texts_of
from .near import shingles

#: Digits and signs that stand for letters inside a word.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "€": "e"}
#: Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(
    zip("абвеёзікмнорсԁтуԛхһјѕԝѵαβεικνορτυχω", "abbeeзikmhopcdtyqxhjswvabeiknoptuxw", strict=True)
)
MIN_PREFIX, MAX_PREFIX = 4, 10


@lru_cache(maxsize=1)
def _folds() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for i in range(0xFF01, 0xFF5F):
        table[i] = unicodedata.normalize("NFKC", chr(i)).lower()
    for i in [0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD]:
        table[i] = None
    table.update({ord(k): v for k, v in LOOKALIKES.items()})
    return table


def fold(text: str) -> str:
    """Words of folded letters with one space around each."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).translate(_folds())
    words = []
    for raw in text.split():
        if raw.isalpha():
            words.append(raw)
            continue
        # Signs at the ends are punctuation unless letters are on their outer side; inside a word they are letters.
        core = raw.strip(".,;:!?\"'()[]{}<>|*#%&+-_=~`/\\^")
        if any(c.isalpha() for c in core) and any(c in SIGNS for c in core):
            core = "".join(SIGNS.get(c, c) for c in core)
        words.append("".join(c if c.isalpha() else " " for c in core))
    return " " + " ".join(" ".join(words).split()) + " "


def candidates(folded: str) -> set[str]:
    """Whole words (`` word ``) and word beginnings (`` beg``) of a folded text."""
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        for n in range(MIN_PREFIX, min(len(word), MAX_PREFIX) + 1):
            out.add(f" {word[:n]}")
    return out


@dataclass(frozen=True)
class ToxicityModel:
    terms: dict[str, float]
    exceptions: frozenset[str]
    #: Intercept and coefficients of sum, sum per word and any match.
    weights: tuple[float, float, float, float]

    @property
    def automaton(self):
        return _automaton(tuple(sorted(self.terms.items())))

    def features(self, folded: str) -> tuple[float, float, float]:
        n = folded.count(" ") - 1
        total = 0.0
        for start, stop, weight in matches(self.automaton, folded):
            if self.exceptions and self.exceptions.intersection(phrases(folded, start, stop)):
                continue
            total += weight
        return total, total / max(n, 1), float(total > 0)

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.features(fold(t)) for t in texts]).reshape(-1, 3)
        a, *b = self.weights
        return 1 / (1 + np.exp(-np.clip(a + np.log1p(x) @ np.array(b), -30, 30)))


@lru_cache(maxsize=2)
def _automaton(terms: tuple[tuple[str, float], ...]):
    found = ahocorasick.Automaton()
    for term, weight in terms:
        found.add_word(term, (len(term), weight))
    found.make_automaton()
    return found


def matches(automaton, folded: str) -> Iterator[tuple[int, int, float]]:
    """Start and end of each matched word and the largest weight of its terms."""
    best: dict[int, float] = {}
    if len(automaton):
        for last, (size, weight) in automaton.iter(folded):
            start = last - size + 2
            best[start] = max(weight, best.get(start, 0.0))
    for start, weight in best.items():
        yield start, folded.index(" ", start), weight


def phrases(folded: str, start: int, stop: int) -> tuple[str, str]:
    """The matched word with the word before it and with the word after it."""
    before = folded.rfind(" ", 0, start - 1)
    after = folded.find(" ", stop + 1)
    return folded[max(before, 0) + 1 : stop], folded[start : after if after > 0 else len(folded)]


def choose(counts: dict[str, tuple[int, int]], toxic: int, clean: int, *, support: int, odds: float) -> dict[str, float]:
    """Terms and weights from (toxic documents, clean documents) of the candidates."""
    def weight(t: int, c: int) -> float:
        return float(np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1)))

    strong = {k: weight(t, c) for k, (t, c) in counts.items() if t >= support}
    strong = {k: w for k, w in strong.items() if w >= odds}
    longer: dict[str, int] = {}
    for k in strong:
        for n in range(1, len(k)):
            longer[k[:n]] = max(longer.get(k[:n], 0), counts[k][0])
    # Closed: no longer candidate is in about as many toxic documents.
    closed = {k: w for k, w in strong.items() if longer.get(k, 0) < 0.9 * counts[k][0]}
    kept: dict[str, float] = {}
    for k in sorted(closed, key=len):
        # A word is covered by its beginning where that is kept and about as telling.
        shorter = [kept[k[:n]] for n in range(2, len(k)) if k[:n] in kept]
        if not shorter or max(shorter) < closed[k] - 1.0:
            kept[k] = closed[k]
    return kept


def chance_of(toxic: int, clean: int, share: float) -> float:
    """Probability of at least ``toxic`` toxic documents among as many as hold the term, each toxic with probability ``share``."""
    n = toxic + clean
    if share <= 0 or share >= 1:
        return float(share > 0)
    log = [lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * math_log(share) + (n - i) * math_log(1 - share) for i in range(toxic, n + 1)]
    return min(1.0, sum(map(exp, log)))


def sketch_of(texts: list[str]) -> np.ndarray:
    """The least hash of the runs of five words of each text: equal for most pairs of near copies, and for no others."""
    owner, code, _ = shingles(texts)
    out = np.zeros(len(texts), dtype=np.uint64)
    # Hashes come in order, so the first of a text is its least.
    found, first = np.unique(owner, return_index=True)
    out[found] = code[first]
    return out


def _logistic(x: np.ndarray, y: np.ndarray, *, steps: int = 3000, rate: float = 0.3, decay: float = 1e-4) -> tuple[float, float, float, float]:
    """Weighted so that both labels count the same; coefficients stay non-negative."""
    x = np.log1p(x)
    share = y.mean()
    each = np.where(y == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) / len(y)
    a, b = 0.0, np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a + x @ b, -30, 30)))
        g = (p - y) * each
        a -= rate * g.sum()
        b = np.maximum(b - rate * (x.T @ g + decay * b), 0.0)
    return (float(a), *map(float, b))


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    per_label: int = 4000, support: int = 5, per_term: int = 100, odds: float = 4.0, by_chance: float = 0.01,
) -> ToxicityModel:
    """``learn`` is a condition on the id column; labels of one id that disagree are not used."""
    spark = docs.sparkSession
    stages = job(spark, "toxicity")
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(label).alias("y"), F.max(label).alias("_y"))
    known = known.filter((F.col("y") == F.col("_y")) & F.col("doc_id").isNotNull() & learn).select("doc_id", F.col("y").cast("int").alias("y"))
    known = stages.keep("labels", known)
    totals = dict(known.groupBy("y").count().collect())
    if len(totals) < 2:
        return ToxicityModel({}, frozenset(), (30.0 if totals.get(1) else -30.0, 0.0, 0.0, 0.0))
    share = F.pmod(F.xxhash64("doc_id", F.lit("toxicity sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.when(F.col("y") == 1, per_label / totals[1]).otherwise(per_label / totals[0])
    picked = small_side(stages.keep("picked", known.filter(share < rate)))
    sample = docs.filter(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(picked, "doc_id")

    def folded(batches):
        for batch in slices(batches, "text", SMALL_SLICE):
            texts = [fold(t) for t in texts_of(batch, "text")]
            sketches = pa.array(sketch_of(texts).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts), batch.column(2), sketches], names=["doc_id", "folded", "y", "sketch"])

    sample = stages.keep("folded", sample.mapInArrow(folded, "doc_id bigint, folded string, y int, sketch bigint"))
    # One document of a group of copies teaches; the sizes of the labels are those of what is left.
    sample = stages.keep("distinct", sample.groupBy("sketch", "y").agg(F.min_by("folded", F.struct("doc_id", "folded")).alias("folded")))

    def count(batches):
        # Counts of one task, then summed on Spark.
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[y].update(candidates(text))
        words = list(seen[1])
        if words:
            yield pa.RecordBatch.from_pydict({"term": words, "toxic": [seen[1][w] for w in words], "clean": [0] * len(words)})
        words = list(seen[0])
        if words:
            yield pa.RecordBatch.from_pydict({"term": words, "toxic": [0] * len(words), "clean": [seen[0][w] for w in words]})

    sums = sample.select("folded", "y").mapInArrow(count, "term string, toxic bigint, clean bigint")
    sums = stages.keep("sums", sums.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    sizes = dict(sample.groupBy("y").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    support = max(support, toxic // per_term)
    # Only strong candidates leave Spark; there are at most as many as toxic sample documents have words.
    strong = sums.filter(
        (F.col("toxic") >= support) & (F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1)) >= odds)
    )
    counts = {r.term: (r.toxic, r.clean) for r in strong.collect()}
    tried = sums.count()
    counts = {k: v for k, v in counts.items() if tried * chance_of(*v, toxic / max(1, toxic + clean)) < by_chance}
    found_in = _automaton(tuple((k, 1.0) for k in sorted(counts)))

    def neighbours(batches):
        for batch in batches:
            pairs = set()
            for text in batch.column(0).to_pylist():
                for last, (size, _) in found_in.iter(text) if len(found_in) else ():
                    start = last - size + 1
                    pairs.add((text[start : last + 1], text[text.rfind(" ", 0, start) + 1 : start]))
            rows = list(pairs)
            yield pa.RecordBatch.from_pydict({"term": pa.array([t for t, _ in rows], pa.string()), "before": pa.array([b for _, b in rows], pa.string())})

    varied = sample.filter("y = 1").select("folded").mapInArrow(neighbours, "term string, before string").distinct()
    varied = {r.term for r in varied.groupBy("term").count().filter(F.col("count") >= support).collect()}
    terms = choose({k: v for k, v in counts.items() if k in varied}, toxic, clean, support=support, odds=odds)
    bare = ToxicityModel(terms, frozenset(), (0.0, 0.0, 0.0, 0.0))

    def contexts(batches):
        for batch in batches:
            found: dict[str, list[int]] = {}
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for p in {p for a, b, _ in matches(bare.automaton, text) for p in phrases(text, a, b)}:
                    found.setdefault(p, [0, 0])[y] += 1
            rows = list(found.items())
            yield pa.RecordBatch.from_pydict({"phrase": pa.array([k for k, _ in rows], pa.string()), "clean": pa.array([v[0] for _, v in rows], pa.int64()), "toxic": pa.array([v[1] for _, v in rows], pa.int64())})

    seen = sample.select("folded", "y").mapInArrow(contexts, "phrase string, clean bigint, toxic bigint")
    seen = seen.groupBy("phrase").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    exceptions = frozenset(r.phrase for r in seen.filter("clean >= 2 and toxic = 0").collect())
    model = ToxicityModel(terms, exceptions, (0.0, 0.0, 0.0, 0.0))

    def measured(batches):
        for batch in batches:
            x = np.array([model.features(t) for t in batch.column(0).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(1), *[pa.array(x[:, i]) for i in range(3)]], names=["y", "a", "b", "c"])

    rows = sample.select("folded", "y").mapInArrow(measured, "y int, a double, b double, c double").toPandas()
    rows = rows.sort_values(["y", "a", "b"])
    return ToxicityModel(terms, exceptions, _logistic(rows[["a", "b", "c"]].to_numpy(), rows["y"].to_numpy()))


def score(docs: DataFrame, model: ToxicityModel, *, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and toxic_score."""
    return add_columns(docs, text, "toxic_score double", lambda texts: [pa.array(model.score(texts))])
