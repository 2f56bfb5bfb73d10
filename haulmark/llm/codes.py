"""Vector code compression by product codebooks, encoded with Orchard's search.

Vectors of whole components, floor(scale x), are cut into ``parts`` equal parts, and each part position has a codebook of
``entries`` entries. For every entry the others are listed by their distance to it. To encode a part, the search stands on an
entry, walks down its list, and jumps to the list of the first entry that is nearer (or as near with a lower index); entries
seen before are skipped by their mark. It stops where the next listed entry is more than twice as far from the present one as
the part is: by the triangle inequality no later entry can be nearer or as near. So codes are exact. The search starts at the
entry whose first component is nearest.

Codebooks start as the parts of the ``entries`` smallest vec_ids and move ``rounds`` times to the floors of the means of their
parts. A pass over the stored vectors returns the sums of each entry; the driver holds the codebooks alone.

A vector that is null or holds a null or non-finite component is not in the result. Shorter vectors count as padded with zeros
to the longest one, and all to a multiple of ``parts``. Rows that repeat a vec_id count each, in order of their vectors where
the first entries are picked; a row without vec_id comes last there. A component whose distances could leave 64 bits is held
at that bound; totals beyond are the largest long. Rows without label are one label. No other column is read. An empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.session import small_side

from .blocks import job
from .vectors import LONG_MAX, as_long, group_sums, largest, matrix, pieces, takes_part, whole


@dataclass(frozen=True)
class Books:
    """Codebooks of all part positions; an entry has the number position * entries + index."""

    values: np.ndarray  # (positions * entries, width of a part)
    lists: np.ndarray  # other entries of the same position by distance; the last column is no entry
    gaps: np.ndarray  # squared distances along the lists; the last column is beyond any
    sorted_first: np.ndarray  # first components of each position, ascending
    by_first: np.ndarray  # entries in that order
    entries: int


def books(values: np.ndarray) -> Books:
    """``values`` has the shape (positions, entries, width of a part)."""
    positions, entries, width = values.shape
    offset = (np.arange(positions) * entries)[:, None]
    lists = np.zeros((positions, entries, entries), dtype=np.int64)
    gaps = np.full((positions, entries, entries), LONG_MAX, dtype=np.int64)
    for p in range(positions):
        between = ((values[p][:, None, :] - values[p][None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(between, LONG_MAX)
        order = np.argsort(between, axis=1, kind="stable")
        lists[p], gaps[p] = order + offset[p], np.take_along_axis(between, order, axis=1)
    by_first = np.argsort(values[:, :, 0], axis=1, kind="stable")
    return Books(
        values.reshape(-1, width), lists.reshape(-1, entries), gaps.reshape(-1, entries),
        np.take_along_axis(values[:, :, 0], by_first, axis=1), by_first + offset, entries,
    )


def starts(parts: np.ndarray, book: Books) -> np.ndarray:
    """Entry to start from, for parts of the shape (vectors, positions, width)."""
    out = np.empty(parts.shape[:2], dtype=np.int64)
    for p in range(parts.shape[1]):
        firsts, x = book.sorted_first[p], parts[:, p, 0]
        right = np.minimum(np.searchsorted(firsts, x), book.entries - 1)
        left = np.maximum(right - 1, 0)
        out[:, p] = book.by_first[p][np.where(np.abs(firsts[left] - x) <= np.abs(firsts[right] - x), left, right)]
    return out


def search(parts: np.ndarray, start: np.ndarray, book: Books) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each part, the lowest of equals, its squared distance, and how many distances were computed."""
    parts, best = parts.reshape(-1, parts.shape[-1]), start.ravel().copy()
    distance = ((parts - book.values[best]) ** 2).sum(axis=1)
    marked = np.zeros((len(parts), book.entries), dtype=bool)
    marked[np.arange(len(parts)), best % book.entries] = True
    place = np.zeros(len(parts), dtype=np.int64)
    going, computed = np.arange(len(parts)), len(parts)
    while len(going):
        here, at = best[going], place[going]
        near = book.gaps[here, at] <= 4 * distance[going]
        going, here, at = going[near], here[near], at[near]
        place[going] = at + 1
        entry = book.lists[here, at]
        fresh = ~marked[going, entry % book.entries]
        look, entry = going[fresh], entry[fresh]
        marked[look, entry % book.entries] = True
        found = ((parts[look] - book.values[entry]) ** 2).sum(axis=1)
        computed += len(look)
        improved = (found < distance[look]) | ((found == distance[look]) & (entry < best[look]))
        look = look[improved]
        best[look], distance[look], place[look] = entry[improved], found[improved], 0
    return best, distance, computed


def compress(
    vectors: DataFrame, *, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part")
    spark = vectors.sparkSession
    stages = job(spark, "codes")
    good = vectors.filter(takes_part(F.col(vector)))
    longest = good.agg(F.max(F.size(vector))).first()[0] or 0
    size = max(1, -(-longest // parts))
    width = size * parts
    rows = stages.keep("rows", good.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), whole(F.col(vector), scale, largest(width, 4)).alias("vec")
    ))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    if not first:
        label_free = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
        return spark.createDataFrame([], label_free)
    values = np.array([r["vec"] + [0] * (width - len(r["vec"])) for r in first], dtype=np.int64)
    values = np.ascontiguousarray(values.reshape(len(first), parts, size).transpose(1, 0, 2))

    def coded(batch: pa.RecordBatch, at: int, book: Books) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cut = matrix(batch.column(at), width, np.int64).reshape(-1, parts, size)
        best, distance, _ = search(cut, starts(cut, book), book)
        return cut.reshape(-1, size), best, distance

    for _ in range(rounds):
        book = books(values)

        def read(batch: pa.RecordBatch, book: Books = book) -> tuple[np.ndarray, np.ndarray]:
            cut, best, _ = coded(batch, 0, book)
            return best, cut

        values = values.copy()
        for entry, (n, total) in group_sums(rows.select("vec"), parts * len(first), size, read).items():
            values[entry // len(first), entry % len(first)] = [x // n for x in total]
    book = books(values)

    def run(batches):
        for batch in pieces(batches):
            _, best, distance = coded(batch, 2, book)
            code = (best % book.entries).astype(np.uint8).reshape(-1, parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(distance.reshape(-1, parts).sum(axis=1))],
                names=["vec_id", "label", "code", "error"],
            )

    kind = rows.schema["label"].dataType.simpleString()
    found = stages.keep("codes", rows.mapInArrow(run, f"vec_id bigint, label {kind}, code string, error bigint"))
    totals = found.groupBy(F.col("label").alias("_label")).agg(as_long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    totals = small_side(stages.keep("totals", totals))
    digest = sha256(",".join(map(str, values.ravel().tolist())).encode()).hexdigest()
    return found.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def compress_sql(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """The same in DuckDB's SQL, with all distances, for vectors of one length and vec_ids that do not repeat."""
    steps = [
        f"v as (select vec_id, label, [floor({scale} * x::double) for x in embedding] as vec from embeddings where embedding is not null "
        "and len([x for x in embedding if x is null or not isfinite(x)]) = 0)",
        f"q as materialized (select vec_id, label, part, vec[part * len(vec) // {parts} + 1 : (part + 1) * len(vec) // {parts}] as cut "
        f"from v, range({parts}) r(part))",
        f"n as (select vec_id, row_number() over (order by vec_id) - 1 as entry from v order by vec_id limit {entries})",
        "c0 as materialized (select part, entry, cut from q join n using (vec_id))",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"a{r} as materialized (select vec_id, label, part, cut, arg_min(entry, (d, entry)) as entry, min(d)::bigint as d from (select q.*, c.entry, "
            "list_inner_product(q.cut, q.cut) + list_inner_product(c.cut, c.cut) - 2 * list_inner_product(q.cut, c.cut) as d "
            f"from q join c{r} c on q.part = c.part) q group by all)"
        )
        if r < rounds:
            steps += [
                f"p{r} as (select part, entry, generate_subscripts(cut, 1) as place, unnest(cut)::hugeint as x from a{r})",
                f"s{r} as (select part, entry, place, sum(x)::hugeint as s, count(*) as n from p{r} group by all)",
                f"m{r} as (select part, entry, list(((s - ((s % n) + n) % n) // n)::double order by place) as cut from s{r} group by all)",
                f"c{r + 1} as materialized (select c.part, c.entry, coalesce(m.cut, c.cut) as cut from c{r} c left join m{r} m using (part, entry))",
            ]
    return (
        f"with {', '.join(steps)}, "
        f"e as (select vec_id, label, string_agg(printf('%02x', entry), '' order by part) as code, sum(d)::bigint as error from a{rounds} group by all) "
        "select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, "
        f"(select sha256(string_agg(array_to_string([x::bigint for x in cut], ','), ',' order by part, entry)) from c{rounds}) as codebooks_sha256 from e"
    )
