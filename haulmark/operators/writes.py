"""Keyed append, insert-or-ignore, upsert and promotion. Results are returned; sinks write them.

Keys are compared as text with blanks for NULL, as rows at rest have them. Stored keys are made
distinct before the join, so the right side holds each key once and a hot key on the left is
split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from .keyed import pick_per_key

# The default key of an observation row.
OBSERVATION_KEY = ["date", "series", "hs_code", "unit", "country"]
RECORD_KEY = ["date", "importer_ko", "product_name"]
PRICE_KEY = ["year", "rank", "product_name"]


class Upserted(NamedTuple):
    rows: DataFrame
    counts: DataFrame


def text_key(column: str, code_columns: Sequence[str] = ("hs_code",)) -> Column:
    if column in code_columns:
        return names.norm_code(F.col(column))
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select("*", *[text_key(k).alias(f"_k{i}") for i, k in enumerate(keys)])


def _key_names(keys: Sequence[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(keys))]


def append_new(new: DataFrame, stored: DataFrame, *, keys: Sequence[str], scope: Column | None = None) -> DataFrame:
    """Rows of ``new`` whose key is not stored. Repeats inside ``new`` all survive.

    ``scope`` restricts the stored side (for example to one series) and prunes its partitions.
    """
    if scope is not None:
        stored = stored.filter(scope)
    k = _key_names(keys)
    known = _keyed(stored.select(*keys), keys).select(*k).distinct()
    return _keyed(new, keys).join(known, k, "left_anti").select(*new.columns)


def append_counts(new: DataFrame, appended: DataFrame) -> DataFrame:
    """One row: offered, appended and skipped."""
    offered, kept = new.agg(F.count(F.lit(1)).alias("n")), appended.agg(F.count(F.lit(1)).alias("n"))
    return offered.select(
        F.col("n").alias("offered"), kept.scalar().alias("appended"), (F.col("n") - kept.scalar()).alias("skipped")
    )


def insert_or_ignore(batch: DataFrame, stored: DataFrame, *, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First arrival per key, within the batch and against what is stored."""
    fresh = append_new(batch, stored, keys=keys)
    return pick_per_key(fresh, list(keys), order)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    *,
    keys: Sequence[str],
    update: Sequence[str],
    order: Sequence[Column],
    on_insert: Mapping[str, Column] | None = None,
) -> Upserted:
    """Insert or update by unique key. The last of several updates to a key, by ``order``, counts.

    ``update`` columns take the new value on a match, every other column keeps the stored one; an
    inserted row takes ``on_insert`` for columns the update does not carry.
    """
    joined = merged(target, pick_per_key(updates, list(keys), order, last=True), keys=keys, update=update, on_insert=on_insert)
    counts = joined.groupBy(F.col("_action").alias("action")).agg(F.count(F.lit(1)).alias("n"))
    return Upserted(joined.drop("_action"), counts)


def merged(
    target: DataFrame, updates: DataFrame, *, keys: Sequence[str], update: Sequence[str], on_insert: Mapping[str, Column] | None = None
) -> DataFrame:
    """``target`` with one update per key merged in, and ``_action``: inserted, updated or kept."""
    on_insert = on_insert or {}
    new = updates.select(
        *[F.col(k) for k in keys],
        *[F.col(c).alias(f"_new_{c}") for c in updates.columns if c not in keys],
        F.lit(True).alias("_is_new"),
    )
    old = target.withColumn("_is_old", F.lit(True))
    joined = old.join(new, list(keys), "full_outer")
    touched, known = F.col("_is_new").isNotNull(), F.col("_is_old").isNotNull()
    cols: list[Column] = []
    for c in target.columns:
        if c in keys:
            cols.append(F.col(c))
            continue
        carried = c in updates.columns
        inserted = F.col(f"_new_{c}") if carried else on_insert.get(c, F.lit(None))
        updated = F.col(f"_new_{c}") if carried and c in update else F.col(c)
        cols.append(F.when(known & touched, updated).when(known, F.col(c)).otherwise(inserted).alias(c))
    action = F.when(known & touched, "updated").when(touched, "inserted").otherwise("kept")
    return joined.select(*cols, action.alias("_action"))


def promotion_conflicts(batch: DataFrame, target: DataFrame, *, key: str, target_id: str) -> DataFrame:
    """Rows of ``batch`` that are already promoted, with a message naming the existing row."""
    return batch.select(key).join(target.select(key, target_id), key, "inner").select(
        key,
        target_id,
        F.format_string(f"{key} %s is already promoted, see row %s", F.col(key).cast("string"), F.col(target_id).cast("string")).alias("message"),
    )


def promote_strict(batch: DataFrame, target: DataFrame, *, key: str, target_id: str) -> DataFrame:
    """Insert-only promotion; raises when any row is already promoted."""
    conflict = promotion_conflicts(batch, target, key=key, target_id=target_id).limit(1).collect()
    if conflict:
        raise ValueError(conflict[0]["message"])
    return batch


def pending(raw: DataFrame, canonical: DataFrame, *, raw_id: str, ref: str) -> DataFrame:
    """Raw rows that no canonical row refers to."""
    refs = canonical.select(F.col(ref).alias(raw_id)).filter(F.col(raw_id).isNotNull()).distinct()
    return raw.join(refs, raw_id, "left_anti").select(*raw.columns)


def first_pending(queue: DataFrame, *, order: str, n: int | None) -> DataFrame:
    """The queue, or its first ``n`` rows by ``order``."""
    return queue if n is None else queue.orderBy(order).limit(n)


def raw_copy(df: DataFrame, columns: Sequence[str], stamp: Column) -> DataFrame:
    """Projection for the raw layer with an ingest stamp."""
    return df.select(*columns, stamp.alias("ingested_at"))


def judged_rows(judged: DataFrame, *, ref: str, relevant: str, fields: Sequence[str], now: Column) -> DataFrame:
    """Judgement and classification in one row; classification stays NULL unless relevant."""
    yes = F.coalesce(F.col(relevant), F.lit(False))
    return judged.select(
        ref,
        yes.alias("relevant"),
        now.alias("relevance_judged_at"),
        *[F.when(yes, F.col(f)).alias(f) for f in fields],
        F.when(yes, now).alias("classified_at"),
    )


def stuck_rows(canonical: DataFrame, *, relevant: str = "relevant", classified: str = "classified_at") -> DataFrame:
    """Relevant rows that never got a classification."""
    return canonical.filter(F.col(relevant) & F.col(classified).isNull())


def repair_stuck(
    canonical: DataFrame, answers: DataFrame, *, ref: str, fields: Sequence[str], now: Column, order: Sequence[Column]
) -> DataFrame:
    """Fills only stuck rows from ``answers``, from the first by ``order`` of each; every other row is unchanged."""
    new = pick_per_key(answers, [ref], order).select(ref, *[F.col(f).alias(f"_new_{f}") for f in fields], F.lit(True).alias("_answered"))
    joined = canonical.join(new, ref, "left")
    stuck = F.col("relevant") & F.col("classified_at").isNull() & F.col("_answered").isNotNull()
    cols = []
    for c in canonical.columns:
        if c in fields:
            cols.append(F.when(stuck, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        elif c == "classified_at":
            cols.append(F.when(stuck, now).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return joined.select(*cols)


def seed_if_empty(target: DataFrame, build: Callable[[], DataFrame]) -> DataFrame | None:
    """The seed rows when the target is empty, else None."""
    return build() if target.isEmpty() else None


def constraint_violations(df: DataFrame, *, unique: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*unique).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
