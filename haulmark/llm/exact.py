"""Exact copies by content-defined chunk recipes, in DataFrame functions only.

A text is normalised, cut where its own content says so (a sentence mark after at least 256 characters), and each chunk
gets a fingerprint. Chunks are deduplicated once to verified identifiers: rows of one fingerprint are compared by content,
and where one fingerprint stands for several contents each content has its own rank. A document is then the ordered list
of its (fingerprint, rank) pairs, its recipe. Recipes are equal exactly when the texts are, so the documents are grouped by
recipe: eight bytes a chunk move, not the text again.

Every row and whole text is read twice: for the chunks, which move once and are not stored, and for recipe and digest,
which are written to the shared folder. Only where a fingerprint is shared are the chunks written with them. Chunks are
counted before the shuffle, so a chunk that is in a third of all documents moves once a task. The keeper of a group is an
aggregate; the rows get it by a join of two plain exchanges, which adaptive execution splits for a group of any size.

Null text counts as empty; empty texts form a group. Of rows that repeat id and text exactly one is kept. A null id loses
every tie. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.session import small_side

from .blocks import job

WHITE = r"[\x20\x09-\x0D]+"
#: 256 to 2048 characters, up to the first sentence mark; what is left at the end, or has no mark, as it comes.
CHUNK = r"(?s).{256,2048}?(?<=[.!?;:|。！？।])|.{1,2048}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def _fingerprint(chunk: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(chunk), 64 - bits) if bits < 64 else F.xxhash64(chunk)


def shared_fingerprints(chunks: DataFrame) -> DataFrame:
    """Fingerprints that stand for more than one content. The chunks move once; their counts follow without them."""
    contents = chunks.groupBy("fp", "chunk").agg(F.count(F.lit(1)).alias("_n"))
    return contents.groupBy("fp").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("fp")


def chunk_ranks(chunks: DataFrame, shared: DataFrame) -> DataFrame:
    """(fp, chunk, rank) of the contents under a shared fingerprint; a rank is the number of smaller contents."""
    more = chunks.join(small_side(shared), "fp", "left_semi").distinct()
    lower = more.select(F.col("fp").alias("_fp"), F.col("chunk").alias("_c"))
    pairs = more.join(lower, (F.col("fp") == F.col("_fp")) & (F.col("_c") < F.col("chunk")), "left")
    return pairs.groupBy("fp", "chunk").agg(F.count("_c").cast("int").alias("rank"))


def copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chunks, text_key.

    ``bits`` is the width of the chunk fingerprints; small values make them collide, for tests.
    """
    stages = job(docs.sparkSession, "copies")
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.length(whole).alias("n_points"),
        F.xxhash64(F.col(text)).alias("text_key"),
        normalised(F.col(text)).alias("flat"),
    ).select(
        "doc_id", "n_points", "text_key", F.sha2("flat", 256).alias("text_sha256"),
        F.regexp_extract_all("flat", F.lit(CHUNK), F.lit(0)).alias("chunks"),
    )
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "*",
        F.transform("chunks", lambda c: _fingerprint(c, bits)).alias("fps"),
    )
    chunks = rows.select(F.explode("chunks").alias("chunk")).select(_fingerprint(F.col("chunk"), bits).alias("fp"), "chunk")
    shared = stages.keep("shared", shared_fingerprints(chunks))
    clash = not shared.isEmpty()
    rows = stages.keep("recipes", rows if clash else rows.drop("chunks"))
    recipes = rows.drop("chunks").withColumn("ranks", F.array().cast("array<int>"))
    if clash:
        ranked = stages.keep("ranks", chunk_ranks(chunks, shared))
        places = rows.select("row", F.posexplode(F.arrays_zip("fps", "chunks"))).select("row", "pos", "col.fps", "col.chunks")
        known = places.join(ranked, (F.col("fps") == F.col("fp")) & (F.col("chunks") == F.col("chunk")))
        known = known.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("pos", "rank"))).alias("_r"))
        at = F.transform("fps", lambda _, i: F.coalesce(F.element_at(F.col("_r"), i), F.lit(0)))
        recipes = recipes.join(known, "row", "left").withColumn(
            "ranks", F.when(F.col("_r").isNotNull(), at).otherwise(F.col("ranks"))
        ).drop("_r")
    first = F.max(F.struct("n_points", -F.col("doc_id"), -F.col("row")))
    groups = recipes.groupBy("fps", "ranks").agg(
        F.count(F.lit(1)).alias("group_size"), first.alias("_f"), F.max_by("doc_id", F.struct("n_points", -F.col("doc_id"), -F.col("row"))).alias("keep_id")
    )
    # The second key makes both sides plain exchanges, so that a hot recipe can be split.
    mine = recipes.withColumn("_key", F.xxhash64("fps", "ranks"))
    theirs = groups.select(
        F.xxhash64("fps", "ranks").alias("_g"), F.col("fps").alias("_fps"), F.col("ranks").alias("_ranks"),
        "group_size", "keep_id", (-F.col("_f").getField("col3")).alias("_row"),
    )
    same = (F.col("_key") == F.col("_g")) & (F.col("fps") == F.col("_fps")) & (F.col("ranks") == F.col("_ranks"))
    return mine.join(theirs, same).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("_row")).alias("kept"), "text_sha256",
        F.size("fps").alias("n_chunks"), "text_key",
    )
