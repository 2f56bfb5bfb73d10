"""Personal data: Aho-Corasick anchors, local parsers that expand them, checks that decide.

One automaton finds the anchors of a whole text: at-signs, plus signs before a digit, a digit and a dot before a digit, digits
in rows, address schemes and account cues. A parser of the anchor's kind expands it to its boundaries in plain steps, from
the end of the last find of that kind on, and a check keeps or drops it.

Base kinds have the boundaries of these patterns, leftmost and without overlap inside a kind, and are not tried again when
the check fails:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, parts at most 255
* card ``[0-9]([\\x20-]?[0-9])+``, 16 to 19 digits, Luhn
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]``, 8 to 15 digits

Added by anchors: url (``http://``, ``https://``, ``ftp://``, ``mailto:``, ``www.``, to the last character that is not closing
punctuation), iban (two letters, two digits, 11 to 30 more, remainder 1 modulo 97; groups of four may be parted by spaces) and
account (6 to 20 digits, single spaces or hyphens inside, within 20 characters after an account cue) and secret: keys that name
themselves by a prefix (``AKIA``, ``ghp_``, ``sk_live_`` and others, at a word's start, with as many signs as such keys have),
private key blocks, and values that are assigned to a name such as ``password``, ``token`` or ``api_key`` by ``=`` or ``:``, in
quotes or bare, of eight signs or more with a digit among them. Added spans never replace base ones; they may overlap.

A map over whole texts: nothing is shuffled. Null text counts as empty and has no spans. Positions are code points, ends
exclusive. Of spans of a kind that could start at one anchor the first counts. Repeated rows are searched each; other columns
pass through, and those that have the name of a new one are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import add_columns, slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account", "secret")
DIGITS = frozenset("0123456789")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
LOCAL = LABEL | frozenset("._%+")
DIALLED = DIGITS | frozenset(" ().-")
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "www.")
CUES = ("iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta", "a/c")
SECRET_CUES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key", "access_key", "private_key", "credential")
#: Prefixes of published key formats and the signs that follow at least.
KEY_PREFIXES = {
    "AKIA": 16, "ASIA": 16, "AIza": 30, "ghp_": 30, "gho_": 30, "ghs_": 30, "github_pat_": 30, "glpat-": 20, "sk_live_": 16,
    "sk_test_": 16, "rk_live_": 16, "xoxb-": 10, "xoxp-": 10, "eyJ": 30,
}
BLOCK_BEGIN, BLOCK_END = "-----BEGIN ", "PRIVATE KEY-----"
KEY_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-.+/=")
CLOSING = frozenset(".,;:!?\"')]}>")


@lru_cache(maxsize=1)
def anchors():
    found = ahocorasick.Automaton()
    words: dict[str, list[str]] = {"@": ["email"]}
    for a in DIGITS:
        words.setdefault(f"+{a}", []).append("phone")
        words.setdefault(f"{a}.", []).append("ip")
        for b in DIGITS:
            words.setdefault(f"{a}{b}", []).append("card")
            words.setdefault(f"{a} {b}", []).append("card")
            words.setdefault(f"{a}-{b}", []).append("card")
    for scheme in SCHEMES:
        for form in {scheme, scheme.upper(), scheme.capitalize()}:
            words.setdefault(form, []).append("url")
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            words.setdefault(form, []).append("iban" if cue == "iban" else "account")
    for cue in SECRET_CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            words.setdefault(form, []).append("secret")
    for prefix in KEY_PREFIXES:
        words.setdefault(prefix, []).append("key")
    words.setdefault(BLOCK_BEGIN, []).append("block")
    for word, kinds in words.items():
        found.add_word(word, (len(word), tuple(kinds)))
    found.make_automaton()
    return found


def _run(text: str, at: int, allowed: frozenset[str]) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email(text: str, at: int, free: int) -> tuple[int, int] | None:
    """Around the at-sign ``at``; nothing before ``free`` is used."""
    start = at
    while start > free and text[start - 1] in LOCAL:
        start -= 1
    end = _run(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == ".":
        stop = _run(text, end + 1, LABEL)
        if stop == end + 1:
            break
        end, labels = stop, labels + 1
    return (start, end) if labels else None


def address(text: str, at: int, free: int) -> tuple[int, int] | None:
    """Four runs of digits joined by dots, from the run that ends before the dot at ``at + 1``."""
    start = at
    while start > free and text[start - 1] in DIGITS:
        start -= 1
    end = at + 1
    for _ in range(3):
        if end >= len(text) or text[end] != ".":
            return None
        stop = _run(text, end + 1, DIGITS)
        if stop == end + 1:
            return None
        end = stop
    return start, end


def small_parts(found: str) -> bool:
    parts = [p.lstrip("0") for p in found.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def row_of_digits(text: str, at: int, free: int) -> tuple[int, int]:
    """Digits with at most one space or hyphen between two of them, from the digit ``at``."""
    end, n = at + 1, len(text)
    while end < n:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    return at, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def dialled(text: str, at: int, free: int) -> tuple[int, int] | None:
    """From the plus sign ``at`` to the last digit of the signs that a number may hold, two at least after the first."""
    end = _run(text, at + 2, DIALLED)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return (at, end) if end > at + 3 and text[end - 1] in DIGITS else None


def web(text: str, at: int, scheme: int) -> tuple[int, int] | None:
    end = at + scheme
    while end < len(text) and not text[end].isspace() and text[end] not in "<>\"|":
        end += 1
    while end > at + scheme and text[end - 1] in CLOSING:
        end -= 1
    return (at, end) if end > at + scheme else None


def iban(text: str, at: int) -> tuple[int, int] | None:
    """The first account number in international form that starts within 20 characters from ``at``."""
    for start in range(at, min(at + 21, len(text) - 14)):
        head = text[start : start + 4]
        if not (head.isascii() and head[:2].isalpha() and head[:2].isupper() and head[2:].isdigit()):
            continue
        if start and text[start - 1].isalnum():
            continue
        end, kept = start, []
        while end < len(text) and len(kept) < 34:
            ch = text[end]
            if ch.isascii() and ch.isalnum():
                kept.append(ch.upper())
            elif not (ch == " " and len(kept) % 4 == 0):
                break
            end += 1
            if len(kept) >= 15:
                moved = "".join(kept[4:] + kept[:4])
                ends = end == len(text) or not text[end].isalnum()
                if ends and ch != " " and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1:
                    return start, end
    return None


def account(text: str, at: int) -> tuple[int, int] | None:
    """The first row of 6 to 20 digits that starts within 20 characters from ``at``."""
    for start in range(at, min(at + 21, len(text))):
        if text[start] in DIGITS:
            _, end = row_of_digits(text, start, 0)
            n = sum(c in DIGITS for c in text[start:end])
            return (start, end) if 6 <= n <= 20 else None
    return None


def _key_signs(text: str, at: int) -> int:
    """End of the signs a key may have from ``at`` on; a full stop or equals sign that ends a sentence is not one."""
    end = _run(text, at, KEY_SIGNS)
    while end > at and text[end - 1] in ".-":
        end -= 1
    return end


def self_named(text: str, at: int, prefix: str) -> tuple[int, int] | None:
    """A key that starts with ``prefix`` at ``at``, at the start of a word."""
    if at and (text[at - 1].isalnum() or text[at - 1] == "_"):
        return None
    end = _key_signs(text, at)
    return (at, end) if end - at - len(prefix) >= KEY_PREFIXES[prefix] else None


def assigned(text: str, at: int) -> tuple[int, int] | None:
    """The value that ``=`` or ``:`` assigns to the name that ends at ``at``."""
    n = len(text)
    at = _run(text, at, frozenset("\"'"))
    at = _run(text, at, frozenset(" \t"))
    if at >= n or text[at] not in "=:":
        return None
    at = _run(text, at + 1, frozenset(" \t>"))
    quote = text[at] if at < n and text[at] in "\"'`" else ""
    start = at + len(quote)
    end = _key_signs(text, start)
    if quote:
        close = text.find(quote, start, start + 200)
        end = close if close >= 0 and not any(c.isspace() for c in text[start:close]) else end
    return (start, end) if end - start >= 8 and any(c in DIGITS for c in text[start:end]) else None


def key_block(text: str, at: int) -> tuple[int, int] | None:
    """From the begin line at ``at`` to the end line of a private key."""
    head = text.find(BLOCK_END, at, at + 60)
    stop = text.find(BLOCK_END, head + len(BLOCK_END)) if head >= 0 else -1
    return (at, stop + len(BLOCK_END)) if stop >= 0 else None


def spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind in order of their start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys(KINDS, 0)

    def keep(kind: str, span: tuple[int, int] | None, good) -> None:
        if span is not None:
            free[kind] = span[1]
            if good(text[span[0] : span[1]]):
                found[kind].append(span)

    for last, (size, kinds) in anchors().iter(text):
        start = last - size + 1
        for kind in kinds:
            if kind == "card" and start >= free["card"]:
                keep(kind, row_of_digits(text, start, 0), lambda s: 16 <= len(d := s.replace(" ", "").replace("-", "")) <= 19 and luhn(d))
            elif kind == "ip" and start >= free["ip"]:
                keep(kind, address(text, start, free["ip"]), small_parts)
            elif kind == "email" and start >= free["email"]:
                keep(kind, email(text, start, free["email"]), lambda s: True)
            elif kind == "phone" and start >= free["phone"]:
                keep(kind, dialled(text, start, 0), lambda s: 8 <= sum(c in DIGITS for c in s) <= 15)
            elif kind == "url" and start >= free["url"]:
                keep(kind, web(text, start, size), lambda s: True)
            elif kind == "iban" and last >= free["iban"]:
                keep(kind, iban(text, last + 1), lambda s: True)
            elif kind == "account" and last >= free["account"]:
                keep(kind, account(text, last + 1), lambda s: True)
            elif kind == "secret" and start >= free["secret"]:
                keep("secret", assigned(text, last + 1), lambda s: True)
            elif kind == "key" and start >= free["secret"]:
                keep("secret", self_named(text, start, text[start : last + 1]), lambda s: True)
            elif kind == "block" and start >= free["secret"]:
                keep("secret", key_block(text, start), lambda s: True)
    return found


def _listed(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def find(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """All columns of ``docs``; the number of each base kind, the digest of the base spans, all spans as text, and the numbers
    of secrets and of all spans.
    """

    def run(texts: list[str]):
        found = [spans(t) for t in texts]
        counts = [pa.array([len(f[k]) for f in found], pa.int64()) for k in BASE]
        digests = [hashlib.sha256(_listed(f, BASE).encode()).hexdigest() for f in found]
        more = [pa.array([len(f["secret"]) for f in found], pa.int64()), pa.array([sum(map(len, f.values())) for f in found], pa.int64())]
        return [*counts, pa.array(digests, pa.string()), pa.array([_listed(f, KINDS) for f in found], pa.string()), *more]

    names = "".join(f"n_{k} bigint, " for k in BASE)
    return add_columns(docs, text, f"{names}base_sha256 string, spans string, n_secret bigint, n_spans bigint", run)


def masked(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans are one, named by the first kind listed."""

    def hide(value: str | None) -> str | None:
        if value is None:
            return None
        order = sorted((a, b, KINDS.index(k)) for k, at in spans(value).items() for a, b in at)
        out, done = [], 0
        groups: list[list[int]] = []
        for a, b, k in order:
            if groups and a < groups[-1][1]:
                groups[-1] = [groups[-1][0], max(b, groups[-1][1]), min(k, groups[-1][2])]
            else:
                groups.append([a, b, k])
        for a, b, k in groups:
            out += [value[done:a], f"<{KINDS[k]}>"]
            done = b
        return "".join([*out, value[done:]])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            at = batch.schema.get_field_index(text)
            hidden = pa.array([hide(t) for t in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, text, hidden)

    return docs.mapInArrow(run, docs.schema)
