"""Mapping tables: build, seed by majority, resolve with an exceptions output, fill blanks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..session import small_side
from .keyed import pick_per_key


FLAG = "struct<field: string, raw_value: string, match_key: string, reason: string>"


class Resolved(NamedTuple):
    rows: DataFrame
    exceptions: DataFrame


class Gate(NamedTuple):
    """One field to resolve: ``source`` text, ``target`` column, mapping frame (None switches it off)."""

    source: str
    target: str
    mapping: DataFrame | None
    mapping_name: str


def build_mapping(
    df: DataFrame,
    *,
    source: str,
    canonical: str,
    order: Sequence[Column],
    match_key: str | None = None,
) -> DataFrame:
    """``(match_key, canonical)``: the stored key, else the key of the source name.

    On equal keys the later row by ``order`` wins.
    """
    stored = names.blank_to_null(F.col(match_key)) if match_key else F.lit(None).cast("string")
    keyed = df.select(
        F.coalesce(stored, names.entity_key(F.col(source))).alias("match_key"),
        F.col(canonical).alias("canonical"),
        F.struct(*order).alias("_seq"),
    ).filter(F.col("match_key") != "")
    return pick_per_key(keyed, ["match_key"], [F.col("_seq")], last=True).select("match_key", "canonical")


def seed_mapping(
    df: DataFrame,
    *,
    pairs: Sequence[tuple[str, str]],
    order: Sequence[Column],
) -> DataFrame:
    """Majority vote per key over one or more (local, canonical) column pairs.

    The most frequent non-blank canonical name wins, the earliest seen on a tie; keys without any
    are left out. The representative source is the first spelling seen. Both steps combine before
    the shuffle, so one dominant key costs no more than any other.
    """
    options = F.array(
        *[
            F.struct(
                names.cell_text(F.col(local)).alias("local"),
                names.cell_text(F.col(name)).alias("name"),
                F.lit(i).alias("pair"),
            )
            for i, (local, name) in enumerate(pairs)
        ]
    )
    votes = (
        df.select(F.struct(*order).alias("_seq"), F.explode(options).alias("o"))
        .select(
            names.entity_key(F.col("o.local")).alias("match_key"),
            F.col("o.local").alias("local"),
            F.col("o.name").alias("name"),
            F.struct("_seq", "o.pair").alias("_seq"),
        )
        .filter(F.col("match_key") != "")
    )
    counted = votes.groupBy("match_key", "name").agg(
        F.count(F.lit(1)).alias("n"), F.min("_seq").alias("_first"), F.min_by("local", "_seq").alias("local")
    )
    named = F.col("name") != ""
    won = counted.groupBy("match_key").agg(
        F.min_by("local", "_first").alias("source_name"),
        F.min_by("name", F.when(named, F.struct(-F.col("n"), F.col("_first")))).alias("canonical"),
    )
    return won.filter(F.col("canonical").isNotNull())


def resolve_flagged(df: DataFrame, gates: Sequence[Gate], *, flags_as: str = "_flags") -> DataFrame:
    """``df`` with blank targets filled from the mappings, and an array ``flags_as`` of what stays unresolved in a row.

    A filled target is never touched, a blank source raises no exception, and a mapped key with a
    blank name counts as unresolved with its own reason.
    """
    out = df
    flags: list[Column] = []
    for i, gate in enumerate(gates):
        if gate.mapping is None:
            continue
        key, name, hit = f"_key{i}", f"_name{i}", f"_hit{i}"
        mapping = gate.mapping.select(
            F.col("match_key").alias(key), names.blank_to_null(F.col("canonical")).alias(name), F.lit(True).alias(hit)
        )
        needed = names.blank_to_null(F.col(gate.target)).isNull() & names.blank_to_null(F.col(gate.source)).isNotNull()
        out = out.withColumn(key, F.when(needed, F.nullif(names.entity_key(F.col(gate.source)), F.lit(""))))
        out = out.withColumn(f"_needed{i}", needed)
        out = out.join(small_side(mapping), key, "left")
        flags.append(
            F.when(
                F.col(f"_needed{i}") & F.col(name).isNull(),
                F.struct(
                    F.lit(gate.target).alias("field"),
                    F.trim(F.col(gate.source)).alias("raw_value"),
                    F.coalesce(F.col(key), F.lit("")).alias("match_key"),
                    F.when(F.col(hit), F.lit(f"blank_mapping in {gate.mapping_name}"))
                    .otherwise(F.lit(f"no {gate.mapping_name} match"))
                    .alias("reason"),
                ),
            )
        )
        out = out.withColumn(gate.target, F.coalesce(names.blank_to_null(F.col(gate.target)), F.col(name)))
    if not flags:
        return out.withColumn(flags_as, F.array().cast(f"array<{FLAG}>"))
    return out.select(*df.columns, F.array_compact(F.array(*flags)).alias(flags_as))


def unresolved(
    flagged: DataFrame, *, row_ref: str, table_name: str, flagged_at: Column | None = None, flags: str = "_flags"
) -> DataFrame:
    """One row per flag of ``resolve_flagged``."""
    stamp = flagged_at if flagged_at is not None else F.lit(None).cast("string")
    return flagged.select(F.col(row_ref).cast("string").alias("row_ref"), F.explode(flags).alias("e")).select(
        F.lit(table_name).alias("source_table"), "row_ref", "e.*", stamp.alias("flagged_at")
    )


def resolve_terms(
    df: DataFrame, gates: Sequence[Gate], *, row_ref: str, table_name: str, flagged_at: Column | None = None
) -> Resolved:
    """Fills blank targets from the mappings; what stays unresolved is the second output."""
    out = resolve_flagged(df, gates)
    return Resolved(out.select(*df.columns), unresolved(out, row_ref=row_ref, table_name=table_name, flagged_at=flagged_at))


def fill_blank(
    target: DataFrame, values: DataFrame, *, keys: Sequence[str], columns: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Only blank cells take the resolved value, the first by ``order`` of a key; nothing is overwritten."""
    renamed = pick_per_key(values, list(keys), order).select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(renamed, list(keys), "left")
    return joined.select(
        *[
            F.coalesce(names.blank_to_null(F.col(c)), F.col(f"_new_{c}")).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def missing_flags(columns: Mapping[str, str]) -> Column:
    """``; ``-joined list of the labels whose column is blank."""
    return F.concat_ws(
        "; ", *[F.when(names.blank_to_null(F.col(c)).isNull(), F.lit(f"{label} missing")) for c, label in columns.items()]
    )
