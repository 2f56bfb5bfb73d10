"""Near copies by ProbMinHash over word shingles, banding and exact verification.

A document is the set of its runs of five words (lower case, split at white space; a text of fewer words is one shingle).
Registers drawn from the set find candidates. A candidate pair is a link when the Jaccard similarity of the two shingle sets,
counted exactly, is 0.8 or more. Every shingle weighs the same, however often it is repeated, so that the registers estimate
the similarity that decides: weights by count would hide a copy with a repeated passage from the bands and the bounds. Classes are the connected
components of the links. Documents without a word have no links.

* **Signatures.** Every shingle is a Poisson process whose rate is its weight. Its arrivals fall on random registers; a register
  keeps the shingle that arrives first. Registers of two documents agree with the probability Jaccard similarity, which for
  equal weights is the Jaccard similarity. All shingles
  of a slice of documents take their first arrival together, then those whose next arrival can still come before the latest
  register take the second, and so on: most stop after one.
* **Copies** in shingles are one node, found by a 128-bit digest of the weighted set, so a copied text never multiplies.
* **Bands.** 32 bands of 5 registers: a link at exactly 0.8 is missed with probability 3e-6.
* **Candidates** of a bucket are not all its pairs. First every member meets one leader, the member that shares the most
  buckets with others: among copies of one text that is the text. The links found make components. Only buckets whose members
  are then in different components are looked at again, in tiles of bounded size: two members of different components are a
  candidate pair unless a bound excludes them, and only candidate pairs leave a task. Pairs of one component need no
  comparison: their link changes nothing.
* **Bounds.** The sizes of the sets must allow 0.8. One bit of each register differs on at most 40 of the 160 registers, where a
  link is expected to differ on 16 (more than 40 for one link in 1e8). In tiles also a bitmap of the set, of 2 to 4 bits a
  shingle: each bit that only one of two sets has is a shingle the other lacks, which bounds their similarity for certain.
* **Verification** reads the shingles of the documents in candidate pairs only, computed again from their texts.
* **Components** by choosing the smallest neighbour, following the choices to their roots, and contracting.

What rounds exchange is written to the shared folder, so a lost executor costs the tasks it ran. Hot buckets and hot leaders
meet their rows in joins of two plain exchanges, which adaptive execution splits; nothing is collected by key.

Null text counts as empty. Rows that repeat an id are kept apart by their content. A null id takes part; the class id is the
smallest non-null id of the class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.session import Stages, small_side

from .blocks import GOLD, SMALL_SLICE, code_points, job, mix, slices, texts_of

WORDS = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 5
#: Rows of a bucket in one side of a tile.
TILE = 512
#: Most registers of a candidate pair whose bits differ.
DIFFERING = 40
_SPACES = np.array(
    [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    dtype=np.uint32,
)
_BASE = np.uint64(0x100000001B3)
BITS = ("b0", "b1", "b2")
MAP_SALT = np.uint64(0x2545F4914F6CDD1D)
_PLACES = mix(np.arange(1, 64, dtype=np.uint64) * GOLD) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order of (text, hash): owner, hash, count."""
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    points = code_points("\n" + "\n".join(t.lower().replace("\n", " ") for t in texts) + "\n")
    if not texts:
        return none
    space = np.isin(points, _SPACES) if points.max() > 127 else (points <= 32) & np.isin(points, _SPACES)
    begin = np.flatnonzero(~space[1:] & space[:-1]) + 1
    if not begin.size:
        return none
    end = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    owner = np.cumsum(points == 10)[begin] - 1
    inside = ~space
    within = np.arange(len(points))[inside] - np.repeat(begin, end - begin)
    power = _powers(int(within.max()) + 1)
    starts = np.cumsum(end - begin) - (end - begin)
    word = mix(np.add.reduceat((points[inside].astype(np.uint64) + np.uint64(1)) * power[within], starts))
    per_text = np.bincount(owner, minlength=len(texts))
    # A text of fewer words is one shingle: a window that stops at the end of the text, taken at its first word only.
    first = np.cumsum(per_text) - per_text
    place = np.arange(len(word)) - first[owner]
    sums = np.zeros(len(word), dtype=np.uint64)
    for i in range(words):
        ok = place + i < per_text[owner]
        at = np.flatnonzero(ok)
        sums[at] += word[at + i] * _PLACES[i]
    whole = (place + words <= per_text[owner]) | ((place == 0) & (per_text[owner] < words))
    code, own = mix(sums[whole]), owner[whole]
    order = np.lexsort((code, own))
    code, own = code[order], own[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (own[1:] != own[:-1])
    at = np.flatnonzero(new)
    return own[at], code[at], np.diff(np.append(at, len(code)))


def signatures(owner: np.ndarray, code: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """(texts, registers) of the shingle that arrives first on each register; 0 where a text has no shingle."""
    best = np.full(texts * registers, np.inf)
    found = np.zeros(texts * registers, dtype=np.uint64)
    arrival = np.zeros(len(code))
    turn = 0
    while len(code):
        draw = mix(code + np.uint64((turn * 0x9E3779B97F4A7C15 + 0x1234567) & 0xFFFFFFFFFFFFFFFF))
        # The upper 53 bits time the arrival, a second mix picks its register.
        arrival = arrival - np.log1p(-((draw >> np.uint64(11)) * 2.0**-53)) / weight
        cell = owner * registers + (mix(draw ^ GOLD) % np.uint64(registers)).astype(np.int64)
        early = np.flatnonzero(arrival < best[cell])
        np.minimum.at(best, cell[early], arrival[early])
        won = early[arrival[early] == best[cell[early]]]
        found[cell[won]] = code[won]
        still = np.flatnonzero(arrival < best.reshape(texts, registers).max(axis=1)[owner])
        owner, code, weight, arrival = owner[still], code[still], weight[still], arrival[still]
        turn += 1
    return found.reshape(texts, registers)


def register_bits(sig: np.ndarray) -> np.ndarray:
    """One bit of each register. The register's number takes part: a shingle that wins several registers has a bit of its own on each."""
    place = np.arange(sig.shape[1], dtype=np.uint64) * GOLD
    return (mix(sig ^ place[None, :]) & np.uint64(1)).astype(np.uint8)


def _digests(owner: np.ndarray, code: np.ndarray, count: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over the weighted set of each text; 0 for a text without shingles."""
    halves = []
    for salt in (np.uint64(0x51ED2701), np.uint64(0xA0761D6478BD642F)):
        part = mix(mix(code ^ salt) + count.astype(np.uint64) * GOLD)
        total = np.zeros(texts, dtype=np.uint64)
        np.add.at(total, owner, part)
        halves.append(total.view(np.int64))
    return halves[0], halves[1]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of distinct hashes."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / max(1, len(a) + len(b) - common)


def _profile_rows(docs: DataFrame, text: str, key: list[str]) -> DataFrame:
    """key, d1, d2, n_shingles, one bit of each register, the band keys and the bitmap of each row."""
    keep = docs.select(*key, F.col(text).alias("_text"))

    def run(batches):
        for batch in slices(batches, "_text", SMALL_SLICE):
            texts = texts_of(batch, "_text")
            owner, code, count = shingles(texts)
            d1, d2 = _digests(owner, code, count, len(texts))
            sig = signatures(owner, code, np.ones(len(code)), len(texts), BANDS * ROWS).reshape(len(texts), BANDS, ROWS)
            band = np.arange(BANDS, dtype=np.uint64)[None, :] * GOLD
            for i in range(ROWS):
                band = mix(band ^ sig[:, :, i]) + _PLACES[i]
            bands = pa.FixedSizeListArray.from_arrays(pa.array(band.view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))
            bits = np.zeros((len(texts), 192), dtype=np.uint8)
            bits[:, : BANDS * ROWS] = register_bits(sig.reshape(len(texts), -1))
            bits = np.packbits(bits, axis=1).view(np.int64)
            n = np.bincount(owner, minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(key))], *[pa.array(x) for x in (d1, d2, n, *np.ascontiguousarray(bits.T))], bands, pa.array(bitmaps(owner, code, n), pa.binary())],
                names=[*key, "d1", "d2", "n_shingles", *BITS, "bands", "bitmap"],
            )

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep.schema.fields[:-1])
    return keep.mapInArrow(run, f"{types}, d1 bigint, d2 bigint, n_shingles bigint, b0 bigint, b1 bigint, b2 bigint, bands array<bigint>, bitmap binary")


def _shingle_rows(docs: DataFrame) -> DataFrame:
    """(node, hashes) of rows (node, _text): the distinct shingles as bytes."""

    def run(batches):
        for batch in slices(batches, "_text", SMALL_SLICE):
            texts = texts_of(batch, "_text")
            owner, code, _ = shingles(texts)
            cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
            sets = [code[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "hashes"])

    return docs.select("node", "_text").mapInArrow(run, "node bigint, hashes binary")


def _links(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Roots (ra, rb) of the pairs (a, ra, b, rb) that reach the threshold.

    ``b`` brings its own set first; the set of the leader ``a``, which may be in many pairs, is looked up last.
    """
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b")
    both = both.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a")

    def run(batches):
        for batch in batches:
            ra, rb, ha, hb = (batch.column(i) for i in range(4))
            ok = [
                similarity(np.frombuffer(ha[i].as_buffer(), np.uint64), np.frombuffer(hb[i].as_buffer(), np.uint64)) >= threshold
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([ra, rb], names=["ra", "rb"]).filter(pa.array(ok, pa.bool_()))

    return both.select("ra", "rb", "ha", "hb").mapInArrow(run, "ra bigint, rb bigint")


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the smallest node of its component."""
    edges = stages.keep("open", edges.select("a", "b").filter("a <> b"))
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stages.keep("up", both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
        while True:
            hop = up.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            up = stages.keep("up", up.join(small_side(hop), "root", "left").select(
                "node", F.coalesce("_next", "root").alias("root"), (F.col("_next") < F.col("root")).alias("_moved")
            ))
            moved = not up.filter("_moved").isEmpty()
            up = up.drop("_moved")
            if not moved:
                break
        ends = [small_side(up.select(F.col("node").alias(n), F.col("root").alias(f"_{n}"))) for n in ("a", "b")]
        left = edges.join(ends[0], "a").join(ends[1], "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        edges = stages.keep("open", left.filter("a <> b").distinct())
        if labels is None:
            labels = up
        else:
            hop = small_side(up.select(F.col("node").alias("root"), F.col("root").alias("_next")))
            labels = labels.join(hop, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
        labels = stages.keep("labels", labels)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def _leader_pairs(members: DataFrame, threshold: float, stages: Stages) -> DataFrame:
    """Candidate pairs (a, ra, b, rb) of the leader of each bucket and its other members (bucket, node, size, b0, b1, b2)."""
    sizes = stages.keep("sizes", members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")))
    own = ("node", "size", *BITS)
    meets = stages.keep("meets", members.join(sizes, "bucket").groupBy("node").agg(F.sum("_n").alias("_meets")))
    order = F.struct("_meets", -F.col("node"))
    lead = members.join(meets, "node").groupBy("bucket").agg(F.max_by(F.struct(*own), order).alias("_l"))
    lead = stages.keep("leaders", lead.select("bucket", *[F.col(f"_l.{c}").alias(f"_{c}") for c in own]))
    differing = sum(F.bit_count(F.col(b).bitwiseXOR(F.col(f"_{b}"))) for b in BITS)
    pairs = members.join(lead, "bucket").filter(
        (F.col("node") != F.col("_node"))
        & (F.least("size", "_size") >= threshold * F.greatest("size", "_size"))
        & (differing <= DIFFERING)
    )
    # The smaller node comes first, so that a pair found in several bands is one pair.
    pairs = pairs.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()
    return pairs.select("a", F.col("a").alias("ra"), "b", F.col("b").alias("rb"))


def level(size: np.ndarray) -> np.ndarray:
    """The bitmap of a set of ``size`` has 2 ** level bits."""
    return np.ceil(np.log2(np.maximum(64, 2 * size))).astype(np.int64)


def bitmaps(owner: np.ndarray, code: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """One bitmap for each text; bit i of the hash of a shingle picks its place, so halves fold into the next smaller one."""
    bits = np.int64(1) << level(sizes)
    start = np.cumsum(bits) - bits
    flags = np.zeros(int(bits.sum()), dtype=np.uint8)
    flags[start[owner] + (mix(code ^ MAP_SALT) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)] = 1
    packed = np.packbits(flags, bitorder="little")
    return [packed[a : a + n].tobytes() for a, n in zip((start // 8).tolist(), (bits // 8).tolist(), strict=True)]


def most_similar(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Upper bound of the Jaccard similarity from rows of bitmaps and the sizes of their sets."""
    common = np.minimum(na - np.bitwise_count(a & ~b).sum(axis=1), nb - np.bitwise_count(b & ~a).sum(axis=1))
    return common / (na + nb - common)


def tile_pairs(chunk, root, size, bits, maps: list[bytes], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the candidate pairs of one tile. A tile of two chunks has the pairs across them, of one chunk its own."""
    across = chunk[0] != chunk[-1] or bool((chunk != chunk[0]).any())
    i, j = np.triu_indices(len(root), 1)
    ok = root[i] != root[j]
    if across:
        ok &= chunk[i] != chunk[j]
    i, j = i[ok], j[ok]
    ok = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])
    i, j = i[ok], j[ok]
    differing = np.zeros(len(i), dtype=np.int64)
    for word in bits:
        # Unsigned: of a negative number the count is that of its absolute value.
        differing += np.bitwise_count((word[i] ^ word[j]).view(np.uint64))
    ok = differing <= DIFFERING
    i, j = i[ok], j[ok]
    deep = level(size)
    low = np.minimum(deep[i], deep[j])
    good = np.zeros(len(i), dtype=bool)
    for at in np.unique(low):
        mine = np.flatnonzero(low == at)
        rows = np.unique(np.concatenate([i[mine], j[mine]]))
        width = 1 << (int(at) - 6)
        stack = np.zeros((len(rows), width), dtype=np.uint64)
        for k, row in enumerate(rows):
            # Sets whose sizes allow a link are at most one level apart.
            halves = np.frombuffer(maps[row], dtype=np.uint64).reshape(-1, width)
            stack[k] = np.bitwise_or.reduce(halves, axis=0)
        for part in np.array_split(mine, 1 + len(mine) * width // 500_000):
            x, y = i[part], j[part]
            bound = most_similar(stack[np.searchsorted(rows, x)], stack[np.searchsorted(rows, y)], size[x], size[y])
            good[part] = bound >= threshold
    return i[good], j[good]


def _tiled_pairs(members: DataFrame, maps: DataFrame, threshold: float, stages: Stages) -> DataFrame:
    """Candidate pairs (a, ra, b, rb) among all members of a bucket in different components."""
    spark = members.sparkSession
    sizes = stages.keep("sizes", members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(TILE))).cast("int").alias("_chunks")))
    rows = members.join(maps, "node").join(sizes, "bucket").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("_chunks")).cast("int"))
    tile = F.explode(F.transform(F.sequence(F.lit(0), F.col("_chunks") - 1), lambda k: F.struct(F.least("chunk", k), F.greatest("chunk", k))))
    rows = rows.withColumn("tile", tile).select(
        "bucket", F.col("tile.col1").alias("i"), F.col("tile.col2").alias("j"), "chunk", "node", "root", "size", *BITS, "bitmap"
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = rows.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def pairs_of(table: pa.Table) -> list[pa.RecordBatch]:
        names = ("chunk", "node", "root", "size", *BITS)
        chunk, node, root, size, *bits = (table[n].to_numpy() for n in names)
        maps_of = table["bitmap"]
        keys = [table[n].to_numpy() for n in ("bucket", "i", "j")]
        new = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
        xs, ys = [], []
        for a, b in zip(new, np.append(new[1:], len(node)), strict=True):
            if b - a > 1 and (root[a:b] != root[a]).any():
                x, y = tile_pairs(chunk[a:b], root[a:b], size[a:b], [w[a:b] for w in bits], maps_of[a:b].to_pylist(), threshold)
                xs.append(x + a)
                ys.append(y + a)
        if not xs:
            return []
        x, y = np.concatenate(xs), np.concatenate(ys)
        swap = node[x] > node[y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        _, once = np.unique(np.stack([node[x], node[y]], axis=1), axis=0, return_index=True)
        x, y = x[once], y[once]
        return [pa.RecordBatch.from_arrays([pa.array(v) for v in (node[x], root[x], node[y], root[y])], names=["a", "ra", "b", "rb"])]

    def run(batches):
        # A batch is cut at its last tile, whose rows wait for the next batch.
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = [held[n][-1].as_py() for n in ("bucket", "i", "j")]
            same = pc.and_(pc.equal(held["bucket"], last[0]), pc.and_(pc.equal(held["i"], last[1]), pc.equal(held["j"], last[2])))
            cut = pc.index(same, True).as_py()
            if cut:
                yield from pairs_of(held.slice(0, cut).combine_chunks())
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from pairs_of(held.combine_chunks())

    return rows.mapInArrow(run, "a bigint, ra bigint, b bigint, rb bigint").distinct()


def near_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept, n_shingles, text_key.

    ``kept`` is true for one row of each class, that of the smallest id.
    """
    spark = docs.sparkSession
    stages = job(spark, "near")
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("_t"))
    rows = _profile_rows(source, "_t", ["doc_id", "text_key"]).withColumn("row", F.monotonically_increasing_id())
    rows = stages.keep("profiles", rows)
    # A row without words is a node of its own; rows of one weighted set are one node.
    alone = F.when(F.col("n_shingles") == 0, F.col("row"))
    slot = [F.col("d1"), F.col("d2"), alone.alias("alone")]
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    nodes = rows.groupBy(*slot).agg(
        F.min_by(F.struct("row", "doc_id", "text_key", "n_shingles", *BITS, "bands"), order).alias("first"),
        F.count(F.lit(1)).alias("n_copies"),
    )
    nodes = stages.keep("nodes", nodes.select(
        "d1", "d2", "alone", "n_copies", F.col("first.row").alias("node"), "first.doc_id", "first.text_key",
        F.col("first.n_shingles").alias("size"), *[F.col(f"first.{b}").alias(b) for b in BITS], "first.bands",
    ))
    spread = nodes.filter("size > 0").select("node", "size", *BITS, F.explode("bands").alias("bucket"))
    full = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("bucket")
    members = spread.join(stages.keep("full", full), "bucket").withColumn("root", F.col("node"))
    members = stages.keep("members", members)
    moves: list[DataFrame] = []

    def confirm(pairs: DataFrame, name: str) -> bool:
        """Verifies the pairs and merges the components that they link."""
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        # The texts of these nodes are read again, by id and text hash.
        ids = nodes.select("node", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).join(wanted, "node", "left_semi")
        ids = small_side(stages.keep("wanted", ids))
        again = source.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
        sets = stages.keep("sets", _shingle_rows(again.select("node", F.col("_t").alias("_text"))).dropDuplicates(["node"]))
        links = stages.keep("links", _links(pairs, sets, threshold).distinct())
        stages.release("sets")
        if links.isEmpty():
            return False
        move = components(links.select(F.col("ra").alias("a"), F.col("rb").alias("b")), stages)
        move = stages.keep(name, move.select(F.col("node").alias("root"), F.col("root").alias("_next")))
        moves.append(small_side(move))
        return True

    pairs = stages.keep("pairs", _leader_pairs(members, threshold, stages))
    if not pairs.isEmpty():
        if confirm(pairs, "moves"):
            members = members.join(moves[-1], "root", "left").withColumn("root", F.coalesce("_next", "root")).drop("_next")
            members = stages.keep("members", members)
    split = members.groupBy("bucket").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).filter("_a <> _b")
    members = stages.keep("members", members.join(stages.keep("split", split.select("bucket")), "bucket"))
    maps = rows.select(F.col("row").alias("node"), "bitmap").join(members.select("node").distinct(), "node", "left_semi")
    pairs = stages.keep("pairs", _tiled_pairs(members, stages.keep("maps", maps), threshold, stages))
    stages.release("maps")
    if not pairs.isEmpty():
        confirm(pairs, "more")
    classed = nodes.drop("bands", *BITS).withColumn("root", F.col("node"))
    for move in moves:
        classed = classed.join(move, "root", "left").withColumn("root", F.coalesce("_next", "root")).drop("_next")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    classes = classed.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.sum("n_copies").alias("class_size"), F.min_by("node", order).alias("_keeper")
    )
    classed = stages.keep("classed", classed.join(stages.keep("classes", classes), "root").select(
        F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), F.col("alone").alias("_alone"), "class_id", "class_size", "_keeper"
    ))
    same = (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")) & alone.eqNullSafe(F.col("_alone"))
    return rows.drop("bands", "bitmap", *BITS).join(classed, same).select(
        "doc_id", "class_id", "class_size", (F.col("row") == F.col("_keeper")).alias("kept"), "n_shingles", "text_key"
    )
