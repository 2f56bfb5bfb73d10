"""Text cleaning, hashing and response parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entities decoded, in this order.
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]

HASH_ID = r"^[0-9a-f]{16}$"


def clean_html(c: Column) -> Column:
    """Tags removed, the five entities decoded, ends trimmed of white space."""
    out = F.regexp_replace(F.coalesce(c, F.lit("")), r"<[^>]+>", "")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.regexp_replace(out, r"^\s+|\s+$", "")


def content_hash(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the joined parts."""
    return F.substring(F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), 256), 1, 16)


def is_hash_id(c: Column) -> Column:
    return F.coalesce(F.trim(c).rlike(HASH_ID), F.lit(False))


def parse_judgement(response: Column, categories: Sequence[str], default: str) -> Column:
    """Struct from a judge's JSON answer, tolerant of a code fence.

    An unknown category becomes ``default``. An unreadable answer gives the safe default with
    ``error`` set.
    """
    fenced = F.regexp_replace(F.regexp_replace(F.trim(response), r"^`+|`+$", ""), r"(?is)^\s*json", "")
    body = F.trim(F.when(F.trim(response).startswith("```"), fenced).otherwise(response))
    parsed = F.from_json(body, "category string, english_title string, english_summary string, include_on_site string")
    broken = parsed.isNull() | F.coalesce(F.get_json_object(body, "$").isNull(), F.lit(True))
    category = F.trim(F.coalesce(parsed["category"], F.lit(default)))
    return F.struct(
        F.when(~broken & category.isin(list(categories)), category).otherwise(F.lit(default)).alias("category"),
        F.trim(F.coalesce(parsed["english_title"], F.lit(""))).alias("english_title"),
        F.trim(F.coalesce(parsed["english_summary"], F.lit(""))).alias("english_summary"),
        (~broken & F.coalesce(F.lower(F.trim(parsed["include_on_site"])).isin("true", "yes", "1"), F.lit(False))).alias(
            "relevant"
        ),
        broken.alias("error"),
    )
