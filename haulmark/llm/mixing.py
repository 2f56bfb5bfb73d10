"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Each document falls into a cell (source, language, topic). The topic is the first of an ordered list of cues found in the
text. The mass of a cell is its number of tokens, counted as runs of characters that are not white space. Raking multiplies
the cell masses, margin by margin, until the token shares of sources, languages and topics are the target shares. The factor
of a cell divided by the largest factor is the probability with which its documents stay, so that no probability exceeds
one and the expected shares of what stays are the targets.

Factors fall with the mass, so the rarest name would decide how much of everything else stays. ``least`` bounds that: where
fewer of the tokens would stay, the scale is lowered until that share does, and cells whose factor exceeds it stay whole. Their
names then have less than their target (nothing is repeated); the shares among all other cells stay as raked. The registered
query, its SQL and the pipeline keep at least half.

Target shares are given, or are the observed shares raised to a power below one and scaled to a sum of one (a flatter mix).
A margin lists its names; everything else, null included, is ``other``. So the number of cells is at most the product of the
lengths of the lists, whatever the input holds: 21 x 5 x 5 for the registered query. Only these sums come to the driver.

A document stays when a number in [0, 1) from the md5 of its id is below its probability: the same on every run and machine.
Null text has no tokens and the last topic; a cell of documents without tokens keeps them. Rows that repeat an id share their
number. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import fresh, job


OTHER = "other"
MARGINS = ("source", "lang", "topic")
TOKEN = r"[^\x09-\x0D\x20]+"
SWEEPS = 20
MOST_SWEEPS = 2000


@dataclass(frozen=True)
class Mixture:
    """Names of each margin, the power applied to observed shares, and shares given outright (names not given: none)."""

    sources: Sequence[str]
    langs: Sequence[str]
    topics: Sequence[tuple[str, str]]
    powers: Mapping[str, float]
    shares: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    sweeps: int = SWEEPS
    salt: str = "mixture"
    #: Share of the tokens that stays at least; 0 for no bound.
    least: float = 0.0
    #: Sweeps go on, up to ``MOST_SWEEPS``, until no name is off its target by a larger share of it; 0 for ``sweeps`` as given.
    tolerance: float = 0.0


def _named(column: Column, names: Sequence[str]) -> Column:
    return F.when(column.isin(list(names)), column).otherwise(F.lit(OTHER))


def cells_of(docs: DataFrame, mixture: Mixture, *, source: str = "source", lang: str = "lang", text: str = "text") -> dict[str, Column]:
    """Expressions of the cell and the tokens of a row."""
    topic = F.lit(OTHER)
    for name, cue in reversed(mixture.topics):
        topic = F.when(F.coalesce(F.col(text), F.lit("")).rlike(cue), F.lit(name)).otherwise(topic)
    return {
        "source": _named(F.col(source), mixture.sources),
        "lang": _named(F.col(lang), mixture.langs),
        "topic": topic,
        "tokens": F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN)), F.lit(0)).cast("bigint"),
    }


def targets(mass: np.ndarray, codes: np.ndarray, names: Sequence[str], power: float, shares: Mapping[str, float] | None) -> np.ndarray:
    """Target mass of each name; the total stays. A name without mass gets none."""
    seen = np.bincount(codes, mass, len(names))
    wanted = np.array([shares.get(n, 0.0) for n in names]) if shares else seen**power
    wanted = np.where(seen > 0, wanted, 0.0)
    return mass.sum() * wanted / wanted.sum() if wanted.sum() else seen


def scale_of(factor: np.ndarray, mass: np.ndarray, least: float) -> float:
    """The largest factor, or the lower scale at which the share ``least`` of the mass stays when no cell stays more than whole."""
    order = np.argsort(-factor, kind="stable")
    factor, mass = factor[order], mass[order]
    top = float(factor[0])
    if top <= 0 or (factor * mass).sum() / top >= least * mass.sum():
        return top
    # The first cells stay whole, the others in proportion to their factors.
    whole = np.cumsum(mass) - mass
    rest = np.cumsum((factor * mass)[::-1])[::-1]
    lacking = least * mass.sum() - whole
    scale = np.divide(rest, lacking, out=np.full_like(rest, np.inf), where=lacking > 0)
    return float(scale[np.flatnonzero(scale >= factor)[0]])


def rake(cells: list[tuple[str, str, str, int]], mixture: Mixture) -> dict[tuple[str, str, str], float]:
    """Probability of each cell."""
    if not cells:
        return {}
    mass = np.array([c[3] for c in cells], dtype=float)
    margins = []
    for i, name in enumerate(MARGINS):
        names = sorted({c[i] for c in cells})
        codes = np.array([names.index(c[i]) for c in cells])
        margins.append((codes, targets(mass, codes, names, mixture.powers.get(name, 1.0), mixture.shares.get(name))))
    weight = mass.copy()
    for sweep in range(max(mixture.sweeps, MOST_SWEEPS if mixture.tolerance else 0)):
        if mixture.tolerance and sweep >= mixture.sweeps:
            gaps = [(np.abs(np.bincount(codes, weight, len(wanted)) - wanted), wanted) for codes, wanted in margins]
            off = max(np.divide(gap, wanted, out=np.zeros_like(gap), where=wanted > 0).max() for gap, wanted in gaps)
            if off <= mixture.tolerance:
                break
        for codes, wanted in margins:
            have = np.bincount(codes, weight, len(wanted))
            weight *= np.divide(wanted, have, out=np.ones_like(have), where=have > 0)[codes]
    factor = np.divide(weight, mass, out=np.zeros_like(mass), where=mass > 0)
    top = scale_of(factor, mass, mixture.least)
    p = np.where(mass > 0, np.minimum(factor / top, 1.0) if top > 0 else 1.0, 1.0)
    return {c[:3]: float(x) for c, x in zip(cells, p, strict=True)}


def draw(doc_id: Column, salt: str) -> Column:
    """A number in [0, 1) that only the id and the salt decide."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":" + salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix(docs: DataFrame, mixture: Mixture, *, doc_id: str = "doc_id", **columns: str) -> DataFrame:
    """One row per document: doc_id, text_key, source, lang, topic, tokens, probability, kept."""
    spark = docs.sparkSession
    text = columns.get("text", "text")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"),
        *[c.alias(n) for n, c in cells_of(docs, mixture, **columns).items()],
    )
    rows = job(spark, "mixture").keep("cells", rows)
    sums = rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")).orderBy(*MARGINS)
    chance = rake([tuple(r) for r in sums.collect()], mixture)
    known = spark.createDataFrame([(*k, v) for k, v in chance.items()], "source string, lang string, topic string, probability double")
    # At most as many rows as there are cells.
    return rows.join(F.broadcast(known), list(MARGINS)).select(
        "doc_id", "text_key", *MARGINS, "tokens", F.round("probability", 6).alias("probability"),
        (draw(F.col("doc_id"), mixture.salt) < F.col("probability")).alias("kept"),
    )


def rake_sql(mixture: Mixture) -> str:
    """The same in DuckDB: one window for each margin of each sweep."""
    quoted = {"source": mixture.sources, "lang": mixture.langs}
    named = {
        n: f"case when {n} in ({', '.join(repr(x) for x in names)}) then {n} else '{OTHER}' end" for n, names in quoted.items()
    }
    cues = " ".join(f"when regexp_matches(coalesce(text, ''), '{cue}') then '{name}'" for name, cue in mixture.topics)
    parts = [f"""docs as (
  select doc_id, {named['source']} as source, {named['lang']} as lang, case {cues} else '{OTHER}' end as topic,
    coalesce(len(regexp_extract_all(text, '{TOKEN}')), 0) as tokens
  from documents)""", """c as (
  select source, lang, topic, sum(tokens)::double as mass from docs group by all)"""]
    for n in MARGINS:
        parts.append(f"""t_{n} as (
  select {n}, sum(sum(mass)) over () * pow(sum(mass), {mixture.powers.get(n, 1.0)}) / sum(pow(sum(mass), {mixture.powers.get(n, 1.0)})) over () as want_{n}
  from c group by {n} having sum(mass) > 0)""")
    parts.append("""s0 as (
  select c.*, want_source, want_lang, want_topic, mass as w
  from c left join t_source using (source) left join t_lang using (lang) left join t_topic using (topic))""")
    last = "s0"
    for i in range(mixture.sweeps):
        for n in MARGINS:
            step = f"s{i}_{n}"
            parts.append(f"""{step} as (
  select * replace (w * coalesce(want_{n} / nullif(sum(w) over (partition by {n}), 0), 1) as w) from {last})""")
            last = step
    least = float(mixture.least)
    parts.append(f"""f as (
  select source, lang, topic, mass, case when mass > 0 then w / mass else 0 end as factor from {last})""")
    parts.append(f"""o as (
  select *, row_number() over by_factor as rn, max(factor) over () as top, sum(factor * mass) over () / nullif(max(factor) over (), 0) as stays,
    {least} * sum(mass) over () as wanted, {least} * sum(mass) over () - (sum(mass) over by_factor - mass) as lacking,
    sum(factor * mass) over (order by factor desc, source, lang, topic rows between current row and unbounded following) as rest
  from f window by_factor as (order by factor desc, source, lang, topic rows between unbounded preceding and current row))""")
    parts.append("""g as (
  select case when max(top) <= 0 or max(stays) >= max(wanted) then max(top)
    else arg_min(case when lacking > 0 then rest / lacking else 'infinity'::double end, rn) filter (lacking <= 0 or rest / lacking >= factor) end as scale from o)""")
    parts.append("""p as (
  select source, lang, topic, case when mass > 0 and scale > 0 then least(factor / scale, 1) else 1 end as chance from f, g)""")
    return f"""with {', '.join(parts)}
select doc_id, source, lang, topic, tokens, round(chance, 6) as probability,
  ('0x' || md5(coalesce(doc_id::varchar, '') || ':{mixture.salt}')[1:8])::bigint / 4294967296.0 < chance as kept
from docs join p using (source, lang, topic)"""


def mixed(docs: DataFrame, mixture: Mixture, *, doc_id: str = "doc_id", **columns: str) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    own = cells_of(docs, mixture, **columns)
    spark = docs.sparkSession
    sums = docs.select(*[c.alias(n) for n, c in own.items()]).groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    chance = rake(sorted(tuple(r) for r in sums.collect()), mixture)
    cell = F.concat_ws("\x1f", *[own[n] for n in MARGINS])
    own_cell, own_chance = fresh(docs.columns, "_cell", "_chance")
    known = spark.createDataFrame([("\x1f".join(k), v) for k, v in chance.items()], f"`{own_cell}` string, `{own_chance}` double")
    rows = docs.withColumn(own_cell, cell).join(F.broadcast(known), own_cell)
    return rows.filter(draw(F.col(doc_id), mixture.salt) < F.col(own_chance)).select(*[F.col(f"`{c}`") for c in docs.columns])
