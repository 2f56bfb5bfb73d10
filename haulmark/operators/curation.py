"""Reviewer tables: push new rows, pull flags back, approve weekly briefs."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, names
from .keyed import pick_per_key
from .writes import Upserted, upsert


class Pulled(NamedTuple):
    rows: DataFrame
    counts: DataFrame


def push_rows(
    candidates: DataFrame, curation: DataFrame, *, key: str, blanks: Sequence[str] = (), numeric: bool = False
) -> DataFrame:
    """Candidates not yet on the curation table, with empty reviewer columns.

    With ``numeric`` keys are compared as the pull does, so ``12.0`` is 12.
    """
    read = numeric_key if numeric else lambda c: names.blank_to_null(c.cast("string"))
    known = curation.select(read(F.col(key)).alias("_known")).filter("_known is not null").distinct()
    fresh = candidates.withColumn("_known", read(F.col(key))).join(known, "_known", "left_anti")
    return fresh.select(*candidates.columns, *[F.lit("").alias(b) for b in blanks])


def numeric_key(c: Column) -> Column:
    """Key of a curation cell; ``12.0`` and ``12`` are the same, text is NULL."""
    return F.trim(c.cast("string")).try_cast("double").try_cast("bigint")


def _joined(canonical: DataFrame, curation: DataFrame, key: str, order: Sequence[Column], columns: Sequence[str]):
    rows = curation.withColumn("_key", numeric_key(F.col(key)))
    picked = (
        rows.filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_c"), F.count(F.lit(1)).alias("_n"))
    )
    return rows, picked


def pull_flags(
    canonical: DataFrame, curation: DataFrame, *, key: str, flags: Sequence[str], order: Sequence[Column]
) -> Pulled:
    """Applies reviewer flags; the last curation row of a key decides.

    Counts: rows applied, rows without a canonical row, rows with a blank or unreadable key.
    """
    rows, picked = _joined(canonical, curation, key, order, flags)
    joined = canonical.join(picked, F.col(key) == F.col("_key"), "left")
    out = joined.select(
        *[
            F.when(F.col("_c").isNotNull(), names.truthy(F.col(f"_c.{c}"))).otherwise(F.col(c)).alias(c)
            if c in flags
            else F.col(c)
            for c in canonical.columns
        ]
    )
    known = canonical.select(F.col(key).alias("_key"), F.lit(True).alias("_known")).distinct()
    outcome = (
        F.when(F.col("_key").isNull(), "skipped_blank_key").when(F.col("_known"), "applied").otherwise("skipped_no_match")
    )
    counts = rows.join(known, "_key", "left").groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return Pulled(out, counts)


def pull_documents(
    docs: DataFrame,
    files: DataFrame,
    curation: DataFrame,
    *,
    file_key: str,
    file_id: str,
    ref: str,
    title: str,
    fields: Sequence[str],
    now: Column,
    by: Column,
    order: Sequence[Column],
) -> Upserted:
    """Titled curation rows of known files are inserted, or update their document.

    The last row of a file by ``order`` counts. The first curation stamp and its author are kept on update.
    """
    filled = curation.filter(names.blank_to_null(F.col(title)).isNotNull() & names.blank_to_null(F.col(file_key)).isNotNull())
    known = files.select(F.trim(F.col(file_key)).alias(file_key), F.col(file_id).alias(ref))
    updates = filled.withColumn(file_key, F.trim(F.col(file_key))).join(known, file_key, "inner")
    cells = [F.trim(F.col(title)).alias(title), *[names.blank_to_null(F.col(f)).alias(f) for f in fields]]
    return upsert(
        docs,
        updates.select(ref, *cells, F.struct(*order).alias("_seq")),
        keys=[ref],
        update=[title, *fields],
        order=[F.col("_seq")],
        on_insert={"curated_at": now, "curated_by": by},
    )


def rehydrate(
    drafts: DataFrame, curation: DataFrame, *, week: str, text: str, status: str, now: Column, order: Sequence[Column]
) -> DataFrame:
    """Draft rows restored from the curation table for weeks not stored yet; the first row of a week by ``order`` wins."""
    rows = curation.select(
        names.cell_text(F.col(week)).alias(week),
        names.cell_text(F.col(text)).alias(text),
        names.first_filled(F.col(status), default="ok").alias(status),
        F.struct(*order).alias("_seq"),
    ).filter((F.col(week) != "") & (F.col(text) != ""))
    first = pick_per_key(rows, [week], [F.col("_seq")]).drop("_seq")
    return first.join(drafts.select(week).distinct(), week, "left_anti").withColumn("generated_at", now)


def sync_approvals(
    briefs: DataFrame,
    drafts: DataFrame,
    curation: DataFrame,
    *,
    order: Sequence[Column],
    week: str = "week",
    draft_id: str = "draft_id",
) -> Upserted:
    """Approvals by week. An approved row without a stamp takes its week as the stamp."""
    approved = names.truthy(F.col("approved"))
    rows = curation.select(
        names.cell_text(F.col(week)).alias(week),
        approved.alias("approved"),
        F.coalesce(names.blank_to_null(F.col("approved_at")), F.when(approved, names.blank_to_null(F.col(week)))).alias(
            "approved_at"
        ),
        names.blank_to_null(F.col("published_text")).alias("published_text"),
        names.blank_to_null(F.col("notes")).alias("notes"),
        F.struct(*order).alias("_seq"),
    ).filter(F.col(week) != "")
    updates = rows.join(drafts.select(week, F.col(draft_id)), week, "inner").drop(week)
    fields = ["approved", "approved_at", "published_text", "notes"]
    return upsert(briefs, updates, keys=[draft_id], update=fields, order=[F.col("_seq")])


def latest_approved(
    briefs: DataFrame, drafts: DataFrame, *, as_of: Column, draft_id: str = "draft_id", week: str = "week", max_age: int = 14
) -> DataFrame:
    """The newest approved brief: published text, else draft text, with its age."""
    joined = briefs.filter("approved").join(drafts, draft_id, "inner")
    top = joined.agg(
        F.max_by(F.struct(week, "draft_text", "published_text", "approved_at", "fact_check_status"), F.struct(week, draft_id)).alias("_b")
    ).filter(F.col("_b").isNotNull()).select("_b.*")
    stamp = names.first_filled(F.col("approved_at"), F.col(week), default="")
    age = F.datediff(as_of, dates.iso_prefix(stamp))
    return top.select(
        week,
        names.first_filled(F.col("published_text"), F.col("draft_text"), default="—").alias("text"),
        stamp.alias("approved_at"),
        names.cell_text(F.col("fact_check_status")).alias("fact_check_status"),
        age.alias("age_days"),
        F.coalesce(age > max_age, F.lit(False)).alias("is_stale"),
    )
