"""Wide statistics files (three header rows) as long observation rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, measures, names
from ..session import kept, small_side
from .lines import cell_at, first_lines, split_cells

# Product rules (substring of the description -> code, ten-digit code, form), in order.
PRODUCT_RULES = [
    ("other than frozen or dried", ("0507.90", "0507901190", "other")),
    ("frozen", ("0507.90", "0507901110", "frozen")),
    ("dried", ("0507.90", "0507901190", "dried")),
    ("excluding powder", ("0507.90", "0507901190", "other")),
    ("powder", ("0507.90", "0507901190", "other")),
]
# Labels of the commodity codes.
CODE_LABELS = {
    "0507.90": "Horns, antlers, hooves, nails, claws and beaks — other",
    "0510.00": "Ambergris, castoreum, civet and musk; cantharides — other",
}
# Destination names as published and as stored.
DESTINATIONS = {
    "Korea, Republic of": "Korea",
    "China, People's Republic of": "China",
    "Hong Kong (Special Administrative Region)": "Hong Kong",
    "Taiwan": "Taiwan",
}
# Metric names of the third header row.
METRICS = {"quantity": "quantity", "free on board": "fob"}
HEADER_LINES = 4
PROVISIONAL_MONTHS = 3


def classify(description: Column, rules: Sequence[tuple[str, tuple[str, str, str]]], part: int) -> Column:
    return names.first_rule(description, [((sub,), out[part]) for sub, out in rules], "other" if part == 2 else None)


def header_columns(lines: DataFrame, *, rules, destinations: Mapping[str, str]) -> DataFrame:
    """One row per file and data column: destination and description filled forward, metric, codes."""
    head = first_lines(lines, HEADER_LINES).select(
        "file", "pos", "line_no", F.posexplode(split_cells(F.regexp_replace("text", "^\ufeff", ""))).alias("at", "cell")
    )
    line = lambda n: F.max(F.when(F.col("line_no") == n, F.trim("cell")))
    columns = head.groupBy("file", "at").agg(
        line(2).alias("d"), line(3).alias("p"), line(4).alias("m"), F.max("pos").alias("header_pos")
    )
    # Column 0 is the period. A file has a few dozen columns, so its window is short.
    w = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    forward = lambda c: F.coalesce(F.last(F.nullif(F.col(c), F.lit("")), ignorenulls=True).over(w), F.lit(""))
    filled = columns.filter((F.col("at") > 0) & F.col("m").isNotNull()).select(
        "file", "at", "header_pos", forward("d").alias("d"), forward("p").alias("p"), "m"
    )
    return filled.select(
        "file",
        "at",
        "header_pos",
        names.mapped(F.col("d"), destinations).alias("destination"),
        classify(F.col("p"), rules, 0).alias("hs_code"),
        classify(F.col("p"), rules, 1).alias("hs_code_10digit"),
        classify(F.col("p"), rules, 2).alias("product_type"),
        F.element_at(names.literal_map(METRICS), F.lower("m")).alias("metric"),
    )


def column_slots(
    lines: DataFrame,
    *,
    rules: Sequence[tuple[str, tuple[str, str, str]]] = PRODUCT_RULES,
    destinations: Mapping[str, str] = DESTINATIONS,
    codes: Sequence[str] = tuple(CODE_LABELS),
) -> DataFrame:
    """Per file: the header's last position and its (quantity, value) column pairs.

    A pair is a quantity column followed by a value column of the same destination whose
    description is a known product.
    """
    columns = header_columns(lines, rules=rules, destinations=destinations)
    w = Window.partitionBy("file").orderBy("at")
    follows = lambda c: F.lead(c).over(w)
    paired = columns.select(
        "*", follows("metric").alias("_m"), follows("destination").alias("_d"), follows("at").alias("value_at")
    )
    is_slot = (
        (F.col("metric") == "quantity")
        & (F.col("_m") == "fob")
        & (F.col("_d") == F.col("destination"))
        & F.col("hs_code").isin(list(codes))
    )
    slot = F.struct("destination", "hs_code", "hs_code_10digit", "product_type", "at", "value_at")
    return paired.groupBy("file").agg(
        F.max("header_pos").alias("header_pos"), F.collect_list(F.when(is_slot, slot)).alias("slots")
    )


def wide_to_long(
    lines: DataFrame,
    *,
    series: str,
    value_unit: str,
    weight_unit: str = "KG",
    labels: Mapping[str, str] = CODE_LABELS,
    heads: DataFrame | None = None,
    **header,
) -> DataFrame:
    """Long rows of every file: per month and column pair one weight and one value row, zeros kept.

    Lines with a blank first cell are skipped; the first other line that is not a month ends the
    file. The last three distinct months in file order are provisional. ``heads`` has the first
    lines of the files where they can be read apart.

    The first cells of the lines are aggregated to one row per file and month, which tells where a
    file ends and which months are provisional; the rows then come from one pass over the lines.
    """
    # One row per file; stored, so that the broadcast decision rests on its real size.
    per_file = kept(column_slots(lines if heads is None else heads, **header), "headers")
    stripped = lines.withColumn("first", F.trim(cell_at(split_cells(F.regexp_extract("text", r'^("(?:[^"]|"")*"|[^,]*)', 1)), 0)))
    dated = stripped.withColumn("date", dates.compact_period(F.when(F.col("first").contains("M"), F.col("first"))))
    seen = dated.join(small_side(per_file.select("file", "header_pos")), "file").filter(
        (F.col("pos") > F.col("header_pos")) & (F.col("first") != "")
    ).groupBy("file", "date").agg(F.min("pos").alias("pos"))
    bounds = kept(per_file.join(_marks(kept(seen, "months")), "file"), "bounds")
    rows = dated.filter(F.col("date").isNotNull()).join(small_side(bounds), "file").filter(
        (F.col("pos") > F.col("header_pos")) & (F.col("stop_pos").isNull() | (F.col("pos") < F.col("stop_pos")))
    )
    split = rows.select(
        "file",
        "date",
        F.array_contains("provisional", F.col("date")).alias("provisional"),
        split_cells(F.col("text")).alias("c"),
        "slots",
    )
    # A second step, so that a line is split once and not once per column pair.
    slots = split.select("file", "date", "provisional", "c", F.explode("slots").alias("s"))
    amount = lambda at: measures.parse_number(cell_at(F.col("c"), F.col(f"s.{at}")))
    note = F.concat(F.lit("source: "), F.col("file"), F.lit(" | provisional: "), F.initcap(F.col("provisional").cast("string")))
    long = slots.select(
        "date",
        F.lit(series).alias("series"),
        F.col("s.hs_code").alias("hs_code"),
        names.mapped(F.col("s.hs_code"), labels).alias("hs_label"),
        F.col("s.destination").alias("country"),
        note.alias("notes"),
        F.col("s.hs_code_10digit").alias("hs_code_10digit"),
        F.col("s.product_type").alias("product_type"),
        amount("at").alias("_q"),
        amount("value_at").alias("_v"),
    )
    return two_units(long, {weight_unit: "_q", value_unit: "_v"})


def _marks(seen: DataFrame) -> DataFrame:
    """Per file, from the first position of each month (NULL: no month): where it ends and its last
    three distinct months before that.
    """
    stop = F.min(F.when(F.col("date").isNull(), F.col("pos")))
    months = F.array_sort(F.collect_list(F.when(F.col("date").isNotNull(), F.struct("pos", "date"))))
    per_file = seen.groupBy("file").agg(stop.alias("stop_pos"), months.alias("months"))
    inside = F.filter("months", lambda m: F.col("stop_pos").isNull() | (m["pos"] < F.col("stop_pos")))
    return per_file.select(
        "file", "stop_pos", F.transform(F.slice(F.reverse(inside), 1, PROVISIONAL_MONTHS), lambda m: m["date"]).alias("provisional")
    )


def two_units(df: DataFrame, units: Mapping[str, str], *, value: str = "value", unit: str = "unit") -> DataFrame:
    """One row per (unit, measure column) instead of one wide row."""
    keep = [c for c in df.columns if c not in units.values()]
    pairs = [x for u, c in units.items() for x in (F.lit(u), F.col(c))]
    return df.select(*keep, F.stack(F.lit(len(units)), *pairs).alias(unit, value))
