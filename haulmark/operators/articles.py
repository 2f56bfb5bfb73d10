"""Article records: display rule, duplicate assignment, succession and consolidation."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, text, urls
from ..session import Stages
from .keyed import pick_per_key
from .similarity import MATCH_RATIO, WINDOW_DAYS, similar_pairs

# Fixed value: pointer text that means "judged, no duplicate".
JUDGED_NONE = "none"


class Changed(NamedTuple):
    rows: DataFrame
    events: DataFrame


class Consolidated(NamedTuple):
    raw: DataFrame
    canonical: DataFrame
    counts: DataFrame


def display_rule(
    relevant: str = "relevant", pointer: str = "duplicate_of", override: str = "manual_override", hidden: str = "hidden"
) -> Column:
    """Relevant, not a duplicate unless overridden, and not hidden."""
    return (
        F.coalesce(F.col(relevant), F.lit(False))
        & (F.col(pointer).isNull() | F.coalesce(F.col(override), F.lit(False)))
        & ~F.coalesce(F.col(hidden), F.lit(False))
    )


def visible(canonical: DataFrame, raw: DataFrame, *, ref: str = "raw_ref", raw_id: str = "id") -> DataFrame:
    """Displayed articles joined to their raw rows."""
    return canonical.filter(display_rule()).join(raw.withColumnRenamed(raw_id, ref), ref, "inner")


def publishable(df: DataFrame, *, flag: str, day: str, cutoff: Column) -> DataFrame:
    """Flagged rows whose date text is not before the cutoff text."""
    return df.filter(names.truthy(F.col(flag)) & (F.col(day) >= cutoff))


def not_visible(expected: DataFrame, canonical: DataFrame, *, ref: str = "raw_ref") -> DataFrame:
    """Rows that should be displayed and are not: empty after a sound migration."""
    return expected.join(canonical.filter(display_rule()).select(ref), ref, "left_anti")


# --- duplicate assignment -------------------------------------------------------------------------


def _components(edges: DataFrame, stages: Stages) -> DataFrame:
    """``(id, root)`` per node: parents shrink to the smallest id of their component.

    Every step hooks a node and its parent to the smallest grandparent next door and shortens the
    path, so chains close in a logarithmic number of steps.
    """
    both = stages.keep("both", edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))).distinct())
    state = stages.keep(
        "parent", both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.first("u")).alias("parent"))
    )
    while True:
        up = state.select(F.col("id").alias("parent"), F.col("parent").alias("grand"))
        known = state.join(up, "parent")
        near = (
            both.join(known.select(F.col("id").alias("v"), "grand"), "v").groupBy("u").agg(F.min("grand").alias("best"))
        )
        hooked = known.join(near.withColumnRenamed("u", "id"), "id")
        offers = hooked.select(
            F.explode(
                F.array(
                    F.struct("id", F.least("best", "grand", "parent").alias("parent")),
                    F.struct(F.col("parent").alias("id"), F.col("best").alias("parent")),
                )
            ).alias("o")
        ).select("o.*")
        step = stages.keep("next", offers.groupBy("id").agg(F.min("parent").alias("parent")))
        moved = step.join(state.withColumnRenamed("parent", "old"), "id").filter("parent <> old").limit(1).count()
        state = stages.keep("parent", step)
        if not moved:
            return state.select("id", F.col("parent").alias("root"))


def _walk(window: int):
    """The sequential rule along rows (root, day_no, node, cand) in that order; ``cand`` -1 where a node has no neighbour.

    What is kept while it walks are the canonical items of one component in the last ``window`` days.
    """

    def run(batches):
        root = node = day = None
        taken = False
        live: dict[int, int] = {}
        for batch in batches:
            nodes, verdicts = [], []

            def close() -> None:
                nodes.append(node)
                verdicts.append(not taken)
                if not taken:
                    live[node] = day

            for r, d, n, c in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if n != node or r != root:
                    if node is not None:
                        close()
                    if r != root:
                        live = {}
                    elif d != day:
                        live = {k: v for k, v in live.items() if v >= d - window}
                    root, node, day, taken = r, n, d, False
                taken = taken or c in live
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(verdicts, pa.bool_())], names=["node", "canonical"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([not taken])], names=["node", "canonical"])

    return run


def _decide(nodes: DataFrame, edges: DataFrame, stages: Stages, window: int) -> DataFrame:
    """``(node, canonical)`` for every node; ``edges`` lead from a node to its earlier neighbours.

    An item is canonical when no earlier neighbour is. Nodes without an earlier neighbour are
    canonical, and what they reach is a duplicate: that settles the bulk of a crowded story at once.
    What is left is split into connected components, and each is walked once in order of (day, id).
    A component is streamed through its task; only its canonical items of the last days are held.
    """
    edges = stages.keep("edges", edges.select("node", "cand"))
    nodes = stages.keep("open", nodes.select("node", "day_no"))
    free = nodes.join(edges.select("node").distinct(), "node", "left_anti").select("node")
    lost = edges.join(free.withColumnRenamed("node", "cand"), "cand", "left_semi").select("node").distinct()
    first = stages.keep("first", free.withColumn("canonical", F.lit(True)).union(lost.withColumn("canonical", F.lit(False))))
    nodes = stages.keep("open", nodes.join(first, "node", "left_anti"))
    if nodes.isEmpty():
        return first
    dups = first.filter(~F.col("canonical")).select("node")
    edges = edges.join(dups, "node", "left_anti").join(dups.withColumnRenamed("node", "cand"), "cand", "left_anti")
    edges = stages.keep("edges", edges.select("node", "cand"))
    roots = _components(edges.select(F.col("node").alias("u"), F.col("cand").alias("v")), stages).withColumnRenamed("id", "node")
    rows = nodes.join(roots, "node", "left").join(edges, "node", "left").select(
        F.coalesce("root", "node").alias("root"), "day_no", "node", F.coalesce("cand", F.lit(-1)).alias("cand")
    )
    rows = rows.repartition("root").sortWithinPartitions("root", "day_no", "node")
    walked = rows.mapInArrow(_walk(window), "node bigint, canonical boolean")
    return stages.keep("decided", first.unionByName(walked))


def assign_canonical(
    items: DataFrame,
    *,
    ref: str = "raw_ref",
    day: str = "day",
    title: str = "title",
    judged: str = "judged",
    pointer: str = "duplicate_of",
    threshold: float = MATCH_RATIO,
    window: int = WINDOW_DAYS,
    force: bool = False,
    pairs: DataFrame | None = None,
    tile_rows: int | None = None,
) -> DataFrame:
    """Duplicate pointers in the order (day, id), as if items were judged one after the other.

    An unjudged item points to the first canonical item of its window that matches: items settled
    earlier first, then those that became canonical in this pass. Without a match it becomes
    canonical itself. Duplicates are never a target. Rows without a day or title keep their state;
    ``force`` judges everything again. Overrides do not change a verdict, only the display.

    ``pairs`` replaces the built-in ratio by an outside judge: accepted ``(new, candidate)`` ids.
    Items of equal title and day always share their verdict, so they are judged as one node; an
    outside judge has to treat them alike.
    """
    stages = Stages(items.sparkSession, "assign")
    base = items.select(
        F.col(ref).cast("bigint").alias("ref"),
        F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).alias("day_no"),
        F.trim(F.col(title)).alias("title"),
        F.coalesce(F.col(judged), F.lit(False)).alias("judged"),
        F.col(pointer).cast("bigint").alias("pointer"),
    )
    usable = F.col("day_no").isNotNull() & (F.coalesce(F.col("title"), F.lit("")) != "")
    is_new = usable & (F.lit(force) | ~F.col("judged"))
    is_settled = usable & ~F.lit(force) & F.col("judged") & F.col("pointer").isNull()
    labelled = base.withColumn("settled", F.when(is_new, False).when(is_settled, True))
    nodes = stages.keep(
        "nodes",
        labelled.filter(F.col("settled").isNotNull()).groupBy("title", "day_no", "settled").agg(F.min("ref").alias("node")),
    )
    new = nodes.filter(~F.col("settled"))
    if pairs is None:
        found = similar_pairs(new, nodes, threshold=threshold, window=window, tile_rows=tile_rows)
    else:
        facts = nodes.select(F.col("node").alias("cand"), F.col("day_no").alias("cand_day"), "settled")
        found = (
            pairs.toDF("node", "cand")
            .join(new.select("node", "day_no"), "node")
            .join(facts, "cand")
            .filter(F.abs(F.col("day_no") - F.col("cand_day")) <= window)
            .filter(F.col("settled") | (F.struct("cand_day", "cand") < F.struct("day_no", "node")))
        )
    found = stages.keep("pairs", found.select("node", "cand", "cand_day", "settled"))
    # A match among the settled items is final and comes first in the candidate order.
    old_hits = stages.keep(
        "old_hits",
        found.filter("settled").groupBy("node").agg(F.min_by("cand", F.struct("cand_day", "cand")).alias("pointer")),
    )
    open_nodes = new.join(old_hits, "node", "left_anti")
    inner = found.filter(~F.col("settled")).join(old_hits, "node", "left_anti")
    inner = stages.keep("inner", inner.join(old_hits.select(F.col("node").alias("cand")), "cand", "left_anti"))
    decided = _decide(open_nodes, inner, stages, window)
    canon = decided.filter("canonical").select("node")
    new_hits = (
        inner.join(canon.withColumnRenamed("node", "cand"), "cand", "left_semi")
        .groupBy("node")
        .agg(F.min_by("cand", F.struct("cand_day", "cand")).alias("pointer"))
    )
    hits = old_hits.unionByName(new_hits).withColumnRenamed("pointer", "target")
    verdict = stages.keep("verdict", new.select("node", "title", "day_no").join(hits, "node", "left"))
    stages.release("pairs", "inner", "nodes")
    rows = labelled.withColumn("_new", F.coalesce(~F.col("settled"), F.lit(False)))
    joined = rows.join(verdict.withColumn("_new", F.lit(True)), ["title", "day_no", "_new"], "left")
    target = F.coalesce(F.col("target"), F.when(F.col("ref") != F.col("node"), F.col("node")))
    out = joined.select(
        F.col("ref").alias(ref),
        F.when(F.col("_new"), target).otherwise(F.col("pointer")).alias(pointer),
        (F.col("judged") | F.col("_new")).alias(judged),
        F.col("_new").alias("judged_now"),
    )
    return out


# --- succession -----------------------------------------------------------------------------------


def succession(
    df: DataFrame,
    *,
    ref: str = "raw_ref",
    pointer: str = "duplicate_of",
    override: str = "manual_override",
    hidden: str = "hidden",
    day: str = "published_date",
    title: str = "title",
    relevant: str = "relevant",
) -> Changed:
    """When a canonical item is hidden, its earliest visible mate takes its place.

    Overridden mates are left alone, hidden ones are repointed but not promoted. The old canonical
    and the other mates point to the successor. A pointer to a missing item is left as it is. The
    second output lists the promotions; a second run has none.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    live = df.filter(flag(relevant))
    gone = live.filter(flag(hidden)).select(F.col(ref).alias("_old"), F.col(title).alias("_old_title"))
    mates = live.filter(F.col(pointer).isNotNull() & ~flag(override) & ~flag(hidden))
    heirs = mates.groupBy(F.col(pointer).alias("_old")).agg(
        F.min_by(F.struct(F.col(ref).alias("ref"), F.col(title).alias("title")), F.struct(F.coalesce(F.col(day).cast("string"), F.lit("")), F.col(ref))).alias("_heir")
    )
    events = heirs.join(gone, "_old").select(
        F.col("_old").alias("old_ref"),
        F.col("_old_title").alias("old_title"),
        F.col("_heir.ref").alias("new_ref"),
        F.col("_heir.title").alias("new_title"),
    )
    moves = events.select("old_ref", "new_ref")
    by_pointer = moves.select(F.col("old_ref").alias(pointer), F.col("new_ref").alias("_follow"))
    by_self = moves.select(F.col("old_ref").alias(ref), F.col("new_ref").alias("_yield"))
    joined = df.join(by_pointer, pointer, "left").join(by_self, ref, "left")
    follows = F.col("_follow").isNotNull() & ~flag(override) & flag(relevant)
    promoted = follows & (F.col("_follow") == F.col(ref))
    new_pointer = (
        F.when(promoted, F.lit(None))
        .when(F.col("_yield").isNotNull(), F.col("_yield"))
        .when(follows, F.col("_follow"))
        .otherwise(F.col(pointer))
    )
    rows = joined.select(*[new_pointer.alias(c) if c == pointer else F.col(c) for c in df.columns])
    return Changed(rows, events)


# --- consolidation of physical copies -------------------------------------------------------------


def malformed_ids(df: DataFrame, *, key: str = "article_id") -> DataFrame:
    return df.filter(~text.is_hash_id(F.col(key)))


def consolidate(legacy: DataFrame, *, order: str = "row_no", now: Column, check: bool = True) -> Consolidated:
    """One raw row per id and one canonical row per id that has a processed copy.

    ``legacy`` has the columns of the old article table, in which ``title`` holds the link, ``url``
    the headline and ``content_hash`` the description. Any malformed id stops the job before
    anything is produced. All choices among copies are aggregates with map-side combine, so an id
    with very many copies is no special case.
    """
    if check:
        bad = malformed_ids(legacy).select("article_id").limit(5).collect()
        if bad:
            raise ValueError(f"malformed article ids, nothing written: {[r[0] for r in bad]}")
    cell = {c: names.cell_text(F.col(c)) for c in legacy.columns if c != order}
    rows = legacy.select(F.col(order).alias("_seq"), *[c.alias(n) for n, c in cell.items()])
    first = pick_per_key(
        rows.select("article_id", "_seq", "title", "url", "content_hash", "published_date", "source", "crawled_at"),
        ["article_id"],
        [F.col("_seq")],
    )
    raw = first.select(
        F.col("article_id").alias("content_hash"),
        F.col("title").alias("url"),
        F.col("url").alias("title_ko"),
        F.col("content_hash").alias("description"),
        "published_date",
        F.col("source").alias("source_name"),
        urls.host(F.col("title")).alias("source_domain"),
        F.coalesce(F.nullif(F.col("crawled_at"), F.lit("")), now).alias("collected_at"),
    )
    processed = F.col("ai_processed_at") != ""
    shown = F.upper("include_on_site") == "TRUE"
    tracked = F.col("duplicate_of_article_id") != ""
    judgement = F.struct("category", "english_title", "english_summary", "ai_processed_at")
    words = F.when(processed, F.struct("category", "english_summary"))
    groups = rows.groupBy("article_id").agg(
        F.bool_or(shown).alias("any_shown"),
        F.bool_or(F.upper("manual_override") == "TRUE").alias("override"),
        F.min_by(judgement, F.when(shown, F.col("_seq"))).alias("shown_row"),
        F.max_by(judgement, F.when(processed, F.struct("ai_processed_at", -F.col("_seq")))).alias("latest_row"),
        F.min_by("ai_processed_at", F.when(processed, F.col("_seq"))).alias("first_processed"),
        F.min_by(
            F.struct("duplicate_of_article_id", "dedup_judged_at", "crawled_at"), F.when(tracked, F.col("_seq"))
        ).alias("track"),
        F.min(words).alias("_lo"),
        F.max(words).alias("_hi"),
    ).filter(F.col("first_processed").isNotNull())
    mate = F.coalesce(F.col("track.duplicate_of_article_id") != JUDGED_NONE, F.lit(False))
    known = raw.select(F.col("content_hash").alias("_target"))
    joined = groups.withColumn("_target", F.when(mate, F.col("track.duplicate_of_article_id"))).join(
        known.withColumn("_found", F.lit(True)), "_target", "left"
    )
    relevant = F.col("any_shown") | F.col("_target").isNotNull()
    source = F.coalesce(F.col("shown_row"), F.col("latest_row"))
    pick = lambda f: F.when(relevant, F.nullif(source[f], F.lit("")))
    stamped = F.nullif(F.col("track.dedup_judged_at"), F.lit(""))
    canonical = joined.select(
        F.col("article_id").alias("raw_ref"),
        relevant.alias("relevant"),
        F.coalesce(pick("ai_processed_at"), F.col("first_processed")).alias("relevance_judged_at"),
        pick("category").alias("category"),
        pick("english_title").alias("english_title"),
        pick("english_summary").alias("english_summary"),
        pick("ai_processed_at").alias("classified_at"),
        F.when(F.col("_found"), F.col("_target")).alias("duplicate_of"),
        F.when(
            F.col("track").isNotNull(), F.coalesce(stamped, F.nullif(F.col("track.crawled_at"), F.lit("")), now)
        ).alias("dedup_judged_at"),
        F.col("override").alias("manual_override"),
        F.lit(False).alias("hidden"),
    )
    counts = joined.agg(
        F.count(F.lit(1)).alias("canonical_rows"),
        F.count_if(F.col("_lo") != F.col("_hi")).alias("inconsistent_text"),
        F.count_if(F.col("_target").isNotNull() & F.col("_found").isNull()).alias("dangling_pointers"),
        F.count_if(F.col("track").isNotNull() & stamped.isNull()).alias("stamps_filled"),
    )
    return Consolidated(raw, canonical, counts)
