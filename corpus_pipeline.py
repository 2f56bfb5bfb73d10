"""From raw documents to token ids: language, exact copies, near copies, mixture, tokens.

``STAGES`` names the stages in order. Each takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs. A stage works on all rows that its predecessor kept, and its decisions take effect; all
but the last return the columns of ``docs``. When a stage begins, the result of the one before is written, so the
intermediate tables of that one are deleted.

Null text counts as empty and goes with the first stage, as does any text without letters. A null doc_id takes part; where a
class picks one row, a row with an id comes before it. Rows repeated as a whole become one row, rows that repeat an id with
other texts are documents each; ties go to the smaller id. Other columns, whatever their names, pass through unchanged, except
that the last stage replaces token_ids, n_tokens and round_trip where they exist. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm import byte_bpe, exact, language, mixing, near
from haulmark.llm.blocks import filter_rows, job, release
from haulmark.llm.queries import BYTE_RANKS, MIXTURE
from haulmark.session import Stages

#: The registered mixture, but a rare name does not cost more than half of the tokens.
STAGE_MIXTURE = replace(MIXTURE, least=0.5, tolerance=1e-6)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go; a missing label is filled in. The model learns from the labelled rows."""
    release()
    return language.keep_identified(docs, language.fit(docs, F.lit(True)))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal texts the longest row stays."""
    release()
    return filter_rows(docs, exact.copies(docs).select("doc_id", "text_key", "kept"), job(spark, "exact-stage"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the row of the smallest id stays."""
    release()
    return filter_rows(docs, near.near_copies(docs).select("doc_id", "text_key", "kept"), job(spark, "near-stage"))


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that token shares follow the target mixture; at least half of the tokens are expected to stay."""
    release()
    return mixing.mixed(docs, STAGE_MIXTURE)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token_ids, n_tokens, and whether decoding the ids gives the text again."""
    release()
    return byte_bpe.encode_checked(docs, BYTE_RANKS)


STAGES = [
    ("language identification", language_stage),
    ("exact copies", exact_stage),
    ("near copies", near_stage),
    ("mixture", mixture_stage),
    ("byte-level BPE", token_stage),
]

#: The decisions on languages and near copies have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = Stages(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = stages.keep(f"stage{i}", stage(spark, docs, sf_dir))
        stages.release(f"stage{i - 1}")
    release()
    return docs
