"""Near duplicates among vectors: an inverted multi-index of half codebooks, traversed cell by cell, then verified.

The two halves of the unit vectors have codebooks of their own; a vector lies in the cell (i, j) of its nearest codewords, so
``codewords`` squared cells cost two short codebooks. A vector visits cells by the multi-sequence order: the codewords of either
half are sorted by distance, and the next cell is the cheapest one of the frontier of sums. It stops once the cost exceeds that
of its own cell by ``margin``.

Target recall. For vectors of the sample, partners at exactly the threshold cosine are drawn in random directions, and the
margin is the ``recall`` quantile of the cost at which the partner's cell is reached. Links above the threshold are nearer, so
this is the hardest case; the links of the given tables have 0.97 and more.

Work. Copies (equal label and components) are one node with a count. Of two nodes the one in the lower cell looks for the
other, so each pair is met once. The cells of a label are cut into buckets of about ``ROWS`` nodes in cell order, a crowded
bucket into members and visitors of ``ROWS`` each, and a task holds one block of members and one of visitors: memory is bounded,
whatever a label or cell holds. Cosines are computed cell by cell for the visitors of the cell alone. A task returns a row for
each linked node, its count of links and one edge of a spanning forest, never the pairs. In a crowded cell the comparisons stay
quadratic in the distinct vectors, rows moved are not: n / ROWS times the vector.

A vector that is null or zero, holds null or non-finite components, or has no label links with nothing. Shorter vectors count
as padded with zeros. Rows that repeat a vec_id are vectors each. A row without vec_id takes part and does not name its
component, unless all of it lack one. No other column is read. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.session import small_side

from .blocks import job
from .near import components
from .vectors import matrix, pieces, takes_part

SAMPLE = 20_000
CALIBRATION = 4_000
CELL_ROWS = 8
MOST_WORDS = 256
LLOYD = 8
ROWS = 8192
CHUNK = 512


@dataclass(frozen=True)
class Index:
    first: np.ndarray
    second: np.ndarray
    margin: float

    @property
    def words(self) -> int:
        return max(len(self.first), len(self.second))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; a power of two brings them into range first, which is exact."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    vectors = np.ldexp(vectors, -exponent[:, None])
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _halves(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = (vectors.shape[1] + 1) // 2
    return vectors[:, :middle], vectors[:, middle:]


def _costs(half: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances to the codewords."""
    cost = (half * half).sum(axis=1)[:, None] + (words * words).sum(axis=1)[None, :] - 2 * half @ words.T
    return np.maximum(cost, 0.0)


def _codebook(half: np.ndarray, count: int) -> np.ndarray:
    """Lloyd's rounds from rows spread over the sample; words in order of their first principal direction, so that near words get near numbers."""
    half = np.unique(half, axis=0)
    words = half[np.linspace(0, len(half) - 1, min(count, len(half))).astype(int)].copy()
    for _ in range(LLOYD):
        nearest = _costs(half, words).argmin(axis=1)
        order = np.argsort(nearest, kind="stable")
        used, start = np.unique(nearest[order], return_index=True)
        if half.shape[1]:
            words[used] = np.add.reduceat(half[order], start, axis=0) / np.bincount(nearest)[used][:, None]
    if len(words) > 1 and half.shape[1]:
        centred = words - words.mean(axis=0)
        words = words[np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable")]
    return words


def cells_of(vectors: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own cell, and the costs of both halves above that of the own cell."""
    a, b = (_costs(h, w) for h, w in zip(_halves(vectors), (index.first, index.second), strict=True))
    i, j = a.argmin(axis=1), b.argmin(axis=1)
    rows = np.arange(len(vectors))
    return i * len(index.second) + j, a - a[rows, i][:, None], b - b[rows, j][:, None]


def fit(sample: np.ndarray, count: int, threshold: float, recall: float) -> Index:
    """Codebooks and margin from unit vectors; partners at the threshold are drawn with a fixed seed."""
    index = Index(*(_codebook(h, count) for h in _halves(sample)), margin=0.0)
    some = np.repeat(sample[np.linspace(0, len(sample) - 1, min(CALIBRATION, len(sample))).astype(int)], max(1, CALIBRATION // len(sample)), axis=0)
    aside = np.random.default_rng(13).normal(size=some.shape)
    aside -= (aside * some).sum(axis=1)[:, None] * some
    length = np.sqrt((aside * aside).sum(axis=1))[:, None]
    partner = threshold * some + np.sqrt(1 - threshold**2) * np.divide(aside, length, out=np.zeros_like(aside), where=length > 1e-9)
    (mine, a, b), (other, c, d) = cells_of(some, index), cells_of(partner, index)
    rows, n = np.arange(len(some)), len(index.second)
    forth, back = a[rows, other // n] + b[rows, other % n], c[rows, mine // n] + d[rows, mine % n]
    # The node in the lower cell is the one that looks.
    excess = np.where(mine <= other, forth, back)
    return Index(index.first, index.second, float(np.quantile(excess, recall, method="higher")) * (1 + 1e-9) + 1e-12)


def visits(a: np.ndarray, b: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of all cells within ``margin``, each row's in order of cost: the multi-sequence traversal of all rows at once."""
    order_a, order_b = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
    a, b = np.take_along_axis(a, order_a, axis=1), np.take_along_axis(b, order_b, axis=1)
    b = np.concatenate([b, np.full((len(b), 1), np.inf)], axis=1)
    words = order_b.shape[1]
    going = np.arange(len(a))
    # One frontier entry for each word of the first half: the next word of the second.
    step = np.zeros(a.shape, dtype=np.int64)
    frontier = a + b[:, :1]
    rows, cells = [], []
    while len(going):
        best = frontier.argmin(axis=1)
        here = np.arange(len(going))
        inside = frontier[here, best] <= margin
        if not inside.all():
            going, frontier, step, best = going[inside], frontier[inside], step[inside], best[inside]
            here = np.arange(len(going))
        at = step[here, best]
        rows.append(going)
        cells.append(order_a[going, best] * words + order_b[going, at])
        step[here, best] = at + 1
        frontier[here, best] = a[going, best] + b[going, at + 1]
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rows, cells = np.concatenate(rows), np.concatenate(cells)
    order = np.argsort(rows, kind="stable")
    return rows[order], cells[order]


def _joined(hits: np.ndarray, left: np.ndarray, right: np.ndarray, label: np.ndarray) -> None:
    """Gives the nodes ``left`` x ``right`` that ``hits`` connects the smallest label among them."""
    lines, columns = np.flatnonzero(hits.any(axis=1)), np.flatnonzero(hits.any(axis=0))
    if not len(lines):
        return
    hits, left, right = hits[np.ix_(lines, columns)], left[lines], right[columns]
    top = len(label)
    while True:
        x = np.minimum(label[left], np.where(hits, label[right][None, :], top).min(axis=1))
        y = np.minimum(label[right], np.where(hits, x[:, None], top).min(axis=0))
        if (x == label[left]).all() and (y == label[right]).all():
            return
        # Labels that meet are one from now on, wherever they are.
        before = np.concatenate([label[left], label[right]])
        after = np.concatenate([x, y])
        merged = np.arange(top)
        np.minimum.at(merged, before, after)
        label[:] = merged[label]


def tile_links(member: dict, visitor: dict, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, node of its forest, links) of the linked nodes of a tile.

    Both sides have ``row``, ``n``, ``cell`` and ``vector``; visitors have ``who`` and ``visit``, the cells that they visit.
    """
    ids, where = np.unique(np.concatenate([member["row"], visitor["row"]]), return_inverse=True)
    m_at, v_at = where[: len(member["row"])], where[len(member["row"]) :]
    links, label = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
    by_cell = np.argsort(member["cell"], kind="stable")
    cells, first = np.unique(member["cell"][by_cell], return_index=True)
    last = np.append(first[1:], len(by_cell))
    by_visit = np.argsort(visitor["visit"], kind="stable")
    low, high = (np.searchsorted(visitor["visit"][by_visit], cells, side) for side in ("left", "right"))
    for k, cell in enumerate(cells):
        inside = by_cell[first[k] : last[k]]
        asking = visitor["who"][by_visit[low[k] : high[k]]]
        for start in range(0, len(asking), CHUNK):
            some = asking[start : start + CHUNK]
            hits = visitor["vector"][some] @ member["vector"][inside].T >= threshold
            # Inside a cell the smaller node asks.
            hits &= (visitor["cell"][some] < cell)[:, None] | (visitor["row"][some][:, None] < member["row"][inside][None, :])
            if hits.any():
                links[v_at[some]] += hits @ member["n"][inside]
                links[m_at[inside]] += visitor["n"][some] @ hits
                _joined(hits, v_at[some], m_at[inside], label)
    found = np.flatnonzero(links)
    return ids[found], ids[label[found]], links[found]


def _tiles(tiles: DataFrame, width: int, threshold: float) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy().astype(bool)
        row, n, cell = (table[c].to_numpy() for c in ("row", "n", "cell"))
        vector = unit(matrix(table["vec"], width, np.float64))
        asked = table.filter(pa.array(asks))["visits"]
        sizes = asked.combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        out = tile_links(
            {"row": row[~asks], "n": n[~asks], "cell": cell[~asks], "vector": vector[~asks]},
            {"row": row[asks], "n": n[asks], "cell": cell[asks], "vector": vector[asks],
             "who": np.repeat(np.arange(len(sizes)), sizes), "visit": asked.combine_chunks().flatten().to_numpy(zero_copy_only=False)},
            threshold,
        )
        return pa.table(dict(zip(("a", "b", "links"), map(pa.array, out), strict=True)))

    return tiles.groupBy("label", "bucket", "part", "block").applyInArrow(run, "a bigint, b bigint, links bigint")


def near_vectors(
    vectors: DataFrame, *, threshold: float = 0.93, recall: float = 0.99, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    rows_per_block: int = ROWS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    stages = job(spark, "vector-links")
    value = F.col(vector)
    usable = takes_part(value) & F.exists(value, lambda x: x != 0) & F.col(label).isNotNull()
    rows = stages.keep("rows", vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.when(usable, value).alias("vec"),
        F.when(usable, F.xxhash64(value)).alias("h1"), F.when(usable, F.xxhash64(F.lit(7), value)).alias("h2"),
    ).withColumn("row", F.monotonically_increasing_id()))
    same = ["label", "h1", "h2"]
    nodes = stages.keep("nodes", rows.filter("h1 is not null").groupBy(*same).agg(
        F.min("row").alias("row"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"), F.first("vec").alias("vec")
    ))
    sizes = stages.keep("sizes", nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n_label"), F.max(F.size("vec")).alias("width")))
    total, crowd, width = sizes.agg(F.sum("n_label"), F.max("n_label"), F.max("width")).first()
    alone = rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not total:
        return alone

    # A bounded sample fits the codebooks; limit() only guards the driver against an unlucky draw.
    rate = F.pmod(F.xxhash64("h2", "h1"), F.lit(1 << 40)) < F.lit(int(min(1.0, SAMPLE / total) * (1 << 40)))
    sample = nodes.filter(rate).select("row", "vec").limit(2 * SAMPLE).toArrow().sort_by("row")
    if not sample.num_rows:
        sample = nodes.select("row", "vec").limit(SAMPLE).toArrow().sort_by("row")
    count = int(min(MOST_WORDS, max(1, np.ceil(np.sqrt(crowd / cell_rows)))))
    index = fit(unit(matrix(sample["vec"], width, np.float64)), count, threshold, recall)
    n_cells = len(index.first) * len(index.second)
    type_of = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}

    def coded(batches):
        for batch in pieces(batches):
            cell, a, b = cells_of(unit(matrix(batch.column(2), width, np.float64)), index)
            who, seen = visits(a, b, index.margin)
            later = seen >= cell[who]
            who, seen = who[later], seen[later]
            ends = np.searchsorted(who, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.ListArray.from_arrays(pa.array(ends), pa.array(seen))], names=[*batch.schema.names, "cell", "visits"]
            )

    cells = nodes.select("label", "row", "vec", "n").mapInArrow(
        coded, f"label {type_of['label']}, row bigint, vec {type_of['vec']}, n bigint, cell bigint, visits array<bigint>"
    )
    buckets = F.ceil(F.col("n_label") / F.lit(float(rows_per_block)))

    def bucket(cell: Column) -> Column:
        return F.floor(cell * F.col("n_buckets") / F.lit(n_cells)).cast("bigint")

    many = small_side(sizes.select("label", buckets.alias("n_buckets")))
    cells = stages.keep("cells", cells.join(many, "label").select(
        "label", "row", "vec", "n", "cell", "visits", bucket(F.col("cell")).alias("bucket"),
        F.array_distinct(F.transform("visits", bucket)).alias("to"),
    ))
    own = cells.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n_in"))
    out = cells.select("label", F.explode("to").alias("bucket")).groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n_out"))
    block = float(rows_per_block)
    # A bucket without members has nothing to visit.
    plan = stages.keep("plan", own.join(out, ["label", "bucket"]).select(
        "label", "bucket", F.ceil(F.col("n_in") / block).cast("int").alias("parts"), F.ceil(F.col("n_out") / block).cast("int").alias("blocks")
    ))
    plan = small_side(plan)

    def place(count: str, salt: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "row"), F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    keep = ("label", "bucket", "row", "n", "cell", "vec")
    members = cells.join(plan, ["label", "bucket"]).select(
        *keep, F.lit(False).alias("asks"), F.array().cast("array<bigint>").alias("visits"), place("parts", 1).alias("part"), each("blocks").alias("block")
    )
    asking = cells.drop("bucket").withColumn("bucket", F.explode("to")).join(plan, ["label", "bucket"]).select(
        *keep, F.lit(True).alias("asks"), "visits", each("parts").alias("part"), place("blocks", 2).alias("block")
    )
    found = stages.keep("found", _tiles(members.unionByName(asking), width, threshold))
    stages.release("cells")
    links = stages.keep("links", found.groupBy(F.col("a").alias("row")).agg(F.sum("links").alias("links")))
    linked = components(found.select("a", "b"), stages).select(F.col("node").alias("row"), "root")
    # Nodes without a link and without a copy are what is left: rows alone.
    classed = nodes.drop("vec").join(links, "row", "left").join(linked, "row", "left").filter("links > 0 or n > 1").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "first_id", F.coalesce("root", "row").alias("root")
    )
    classed = stages.keep("classed", classed)
    names = stages.keep("names", classed.groupBy("root").agg(F.min("first_id").alias("component_id")))
    classed = small_side(stages.keep("named", classed.join(small_side(names), "root").select(*same, "n_links", "component_id")))
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.drop("vec").join(classed, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
