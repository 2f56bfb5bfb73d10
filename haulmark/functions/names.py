"""Codes, keys, flags and display names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal-entity markers removed from a company name before matching.
LEGAL_MARKERS = [
    "주식회사", "(주)", "㈜", "유한회사", "(유)", "(사)",
    "LTD.", "LTD", "CO.", "CO", "LIMITED", "INC.", "INC",
]

# Commodity codes that a spreadsheet turns into numbers.
CODE_FROM_NUMBER = {507.9: "0507.90", 510.0: "0510.00"}

TRUE_WORDS = ["TRUE", "1", "YES"]


def blank_to_null(c: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def cell_text(c: Column) -> Column:
    """Trimmed text, empty for NULL."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def first_filled(*cols: Column, default: str | None = None) -> Column:
    """First non-blank value, else ``default``."""
    filled = [blank_to_null(c) for c in cols]
    return F.coalesce(*filled, F.lit(default)) if default is not None else F.coalesce(*filled)


def truthy(c: Column) -> Column:
    """TRUE / 1 / YES in any case; NULL counts as false."""
    return F.coalesce(F.upper(F.trim(c.cast("string"))).isin(TRUE_WORDS), F.lit(False))


def entity_key(c: Column, markers: Sequence[str] = LEGAL_MARKERS, token_only: bool = False) -> Column:
    """Matching key of an entity name: upper case, no legal markers, word characters only.

    ``token_only`` removes a marker only where it stands alone, so COSTCO keeps its letters.
    """
    key = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    for marker in (m.upper() for m in markers):
        if token_only:
            escaped = "".join("\\" + ch if ch in "().+*?[]{}^$|\\" else ch for ch in marker)
            key = F.regexp_replace(key, rf"(?U)(?<!\w){escaped}(?!\w)", "")
        else:
            key = F.replace(key, F.lit(marker), F.lit(""))
    return F.regexp_replace(key, r"(?U)[^\w가-힣]", "")


def norm_code(c: Column) -> Column:
    """Commodity code as text; a numeric rendering maps back to its dotted code."""
    s = c.cast("string")
    number = s.try_cast("double")
    out = s
    for value, code in CODE_FROM_NUMBER.items():
        out = F.when(s.rlike(r"^\d+(\.\d+)?$") & ~s.startswith("0") & (number == value), code).otherwise(out)
    return F.coalesce(out, F.lit(""))


def dotted_code(c: Column) -> Column:
    """Ten-digit code to its dotted six-digit heading; short codes stay as they are."""
    raw = F.regexp_replace(F.trim(c), r"[. ]", "")
    return F.when(F.length(raw) >= 6, F.concat(F.substring(raw, 1, 4), F.lit("."), F.substring(raw, 5, 2))).otherwise(raw)


def code_prefix(c: Column, length: int = 3) -> Column:
    """Dots dropped, leading zeros stripped, first ``length`` characters."""
    return F.substring(F.ltrim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\.", ""), F.lit("0")), 1, length)


def literal_map(pairs: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def mapped(c: Column, pairs: Mapping[str, str], default: str | None = None) -> Column:
    """Value looked up in a short fixed map; unknown values stay, or become ``default``."""
    key = F.trim(c)
    hit = F.element_at(literal_map(pairs), key) if pairs else F.lit(None).cast("string")
    return F.coalesce(hit, F.lit(default) if default is not None else key)


def bucket(c: Column, names: Sequence[str], other: str = "Other") -> Column:
    """Named values stay, everything else (and NULL) falls into ``other``."""
    return F.when(c.isin(list(names)), c).otherwise(F.lit(other))


def first_rule(text: Column, rules: Sequence[tuple[Sequence[str], str]], default: str | None = None) -> Column:
    """Ordered rules: the first one with any keyword inside the lower-cased text decides."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit(default).cast("string")
    for words, value in reversed(list(rules)):
        hit = reduce(lambda a, b: a | b, [low.contains(w.lower()) for w in words])
        out = F.when(hit, F.lit(value)).otherwise(out)
    return out


def packed(fields: Mapping[str, Column], sep: str = ", ") -> Column:
    """``label=value`` list of the non-blank fields."""
    parts = [
        F.when(blank_to_null(c).isNotNull(), F.concat(F.lit(f"{label}="), F.trim(c.cast("string"))))
        for label, c in fields.items()
    ]
    return F.concat_ws(sep, *parts)


def unpacked(c: Column, sep: str = ", ") -> Column:
    """Map of a ``label=value`` list."""
    return F.str_to_map(c, F.lit(sep), F.lit("="))
