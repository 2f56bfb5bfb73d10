"""Byte-level BPE: pre-tokenisation by scans of transition functions, cached pair merging, decoding.

The split pattern of the rank files (contractions, runs of letters, of digits, of other signs, each with one space before
them, and white space that leaves its last character to what follows) is a small automaton over code-point classes. Which
token a character belongs to depends on all characters before it, but transition functions compose associatively: the
functions of the characters generate a finite monoid, whose multiplication table is built once. A slice of texts is laid out
as rows; every row composes its functions column by column, one scan composes the rows, and a second pass over the columns
yields the state, and so the token starts, at every character. There is no regular expression and no loop over characters.

The slices between starts are looked up in a bounded cache; a slice that is not there is merged by rank, lowest first and
leftmost of equals. The rank file's path is a parameter; every worker process reads it once. Decoding gathers the bytes of
all ids of a slice at once; the offsets of the texts, kept from encoding, cut them apart.

It is a map over whole texts: nothing is shuffled. Null text counts as empty and has no ids. Repeated rows are coded each; other
columns pass through, and those that have the name of a new one are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import SMALL_SLICE, add_columns, categories, code_points

LETTER, DIGIT, SIGN, SHORT, LONG, WHITE, SPACE, BREAK, END = range(9)
START, IN_LETTERS, IN_DIGITS, IN_SIGNS, AFTER_SPACE, IN_WHITE, AFTER_BREAK, ONE_MORE, TWO_MORE, CLOSED = range(10)
COLUMNS = 32
CACHE = 80_000
#: Pieces longer than this are merged with a heap.
HEAP_FROM = 64
WHITE_POINTS = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _step(kind: int, state: int) -> tuple[int, bool]:
    """Next state, and whether a token starts at this character.

    SHORT and LONG are apostrophes before a one- or two-letter contraction ending, WHITE is white space before white space or
    the end, SPACE and BREAK are the last white space before anything else: a space goes with what follows, a break does not.
    """
    if kind == LETTER:
        if state == ONE_MORE:
            return CLOSED, False
        if state == TWO_MORE:
            return ONE_MORE, False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_SPACE)
    if kind == DIGIT:
        return IN_DIGITS, state not in (IN_DIGITS, AFTER_SPACE)
    if kind in (SIGN, SHORT, LONG):
        if state in (IN_SIGNS, AFTER_SPACE):
            return IN_SIGNS, False
        return {SIGN: IN_SIGNS, SHORT: ONE_MORE, LONG: TWO_MORE}[kind], True
    if kind == WHITE:
        return IN_WHITE, state != IN_WHITE
    return {SPACE: AFTER_SPACE, BREAK: AFTER_BREAK, END: START}[kind], True


@lru_cache(maxsize=1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(after, product, image, step): function then character, function then function, image of START, state and start bit."""
    kinds, states = range(9), range(10)
    moves = [tuple(_step(k, s)[0] for s in states) for k in kinds]
    known = {tuple(states): 0}
    queue = [tuple(states)]
    after = []
    for f in queue:
        row = []
        for move in moves:
            g = tuple(move[s] for s in f)
            if g not in known:
                known[g] = len(queue)
                queue.append(g)
            row.append(known[g])
        after.append(row)
    product = [[known[tuple(g[s] for s in f)] for g in queue] for f in queue]
    step = [[_step(k, s)[0] | (128 if _step(k, s)[1] else 0) for k in kinds] for s in states]
    return (
        np.array(after, np.uint16), np.array(product, np.uint16), np.array([f[START] for f in queue], np.uint8), np.array(step, np.uint8)
    )


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    first = categories()
    table = np.full(0x110000, SIGN, dtype=np.uint8)
    table[first == ord("L")] = LETTER
    table[first == ord("N")] = DIGIT
    table[WHITE_POINTS] = WHITE
    return table


def kinds_of(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of every code point; ``ends`` are the positions of the marks between texts."""
    kinds = _kinds()[points]
    kinds[ends] = END
    n = len(kinds)
    white = kinds == WHITE
    last = np.zeros(n, dtype=bool)
    last[:-1] = white[:-1] & ~white[1:] & (kinds[1:] != END)
    kinds[last] = np.where(points[last] == 32, SPACE, BREAK)
    at = np.flatnonzero((points == 39) & (kinds == SIGN))
    at = at[at + 1 < n]
    one = points[at + 1]
    two = points[np.minimum(at + 2, n - 1)]
    # The mark after a text is no letter, so an ending never reaches into the next text.
    inside_one, inside_two = kinds[at + 1] == LETTER, kinds[np.minimum(at + 2, n - 1)] == LETTER
    kinds[at[inside_one & np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    kinds[at[inside_one & inside_two & pair]] = LONG
    return kinds


def token_starts(kinds: np.ndarray) -> np.ndarray:
    """Positions at which a token starts."""
    after, product, image, step = monoid()
    n = len(kinds)
    rows = -(-n // COLUMNS)
    padded = np.full(rows * COLUMNS, END, dtype=np.uint8)
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(rows, COLUMNS).T)
    done = np.zeros(rows, dtype=np.uint16)
    for column in columns:
        done = after[done, column]
    # Inclusive scan over the rows by doubling: done[i] becomes the product of rows 0 to i.
    gap = 1
    while gap < rows:
        ahead = done.copy()
        ahead[gap:] = product[done[:-gap], done[gap:]]
        done = ahead
        gap *= 2
    state = np.empty(rows, dtype=np.uint8)
    state[0] = START
    state[1:] = image[done[:-1]]
    marks = np.empty((COLUMNS, rows), dtype=bool)
    for i, column in enumerate(columns):
        out = step[state, column]
        marks[i] = out > 127
        state = out & 127
    return np.flatnonzero(np.ascontiguousarray(marks.T).ravel()[:n])


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one piece: pairs of neighbours merge by rank, lowest first, leftmost of equals."""
    if piece in ranks:
        return (ranks[piece],)
    none = len(ranks) + 1
    get = ranks.get
    parts = [piece[i : i + 1] for i in range(len(piece))]
    if len(parts) > HEAP_FROM:
        return _merge_long(parts, ranks)
    pairs = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i] += parts.pop(i + 1)
        pairs.pop(i)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return tuple(ranks[p] for p in parts)


def _merge_long(parts: list[bytes | None], ranks: dict[bytes, int]) -> tuple[int, ...]:
    n = len(parts)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap: list[tuple[int, int, bytes]] = []

    def push(i: int) -> None:
        if 0 <= i and right[i] < n:
            whole = parts[i] + parts[right[i]]
            if whole in ranks:
                heapq.heappush(heap, (ranks[whole], i, whole))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, whole = heapq.heappop(heap)
        j = right[i] if parts[i] is not None else n
        if j >= n or parts[i] + parts[j] != whole:
            continue
        parts[i], parts[j] = whole, None
        right[i] = right[j]
        if right[i] < n:
            left[right[i]] = i
        push(left[i])
        push(i)
    return tuple(ranks[p] for p in parts if p is not None)


class Codec:
    """Vocabulary, cache of pieces and byte table of one rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        entries = [b""] * size
        for entry, rank in self.ranks.items():
            entries[rank] = entry
        self.size = np.array([len(e) for e in entries], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(entries), dtype=np.uint8)
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def _ids(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            ids = merge(piece.encode(), self.ranks)
        if len(self.young) >= CACHE:
            self.old, self.young = self.young, {}
        self.young[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and where the ids of each text begin (one more entry: the end)."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes + 1) - 1
        joined = "\n".join(texts) + "\n"
        starts = token_starts(kinds_of(code_points(joined), ends))
        stops = np.append(starts[1:], len(joined))
        real = ~np.isin(starts, ends)
        starts, stops = starts[real], stops[real]
        get, find = self.young.get, self._ids
        out = []
        for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
            piece = joined[a:b]
            ids = get(piece)
            if ids is None:
                ids = find(piece)
                get = self.young.get
            out.append(ids)
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        total = np.concatenate([[0], np.cumsum(lengths)])
        offsets = total[np.searchsorted(starts, np.concatenate([[0], ends]))]
        return np.fromiter(chain.from_iterable(out), np.int32, int(total[-1])), offsets

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        size = self.size[ids]
        place = np.cumsum(size) - size
        index = np.repeat(self.start[ids] - place, size) + np.arange(int(size.sum()))
        data = self.bytes[index].tobytes()
        ends = np.concatenate([place, [len(data)]])[offsets]
        return [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str, *, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """All columns of ``docs`` and the token ids."""

    def run(texts: list[str]):
        flat, offsets = codec(path).encode(texts)
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))]

    return add_columns(docs, text, f"`{ids}` array<int>", run)


def decode(docs: DataFrame, path: str, *, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """All columns of ``docs`` and the bytes that the ids stand for; null ids stand for none."""
    schema = docs.drop(decoded).schema.fields

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            data = []
            for at in range(0, batch.num_rows, 256):
                part = column.slice(at, 256)
                flat = part.flatten().to_numpy(zero_copy_only=False)
                sizes = [0 if x is None else x for x in part.value_lengths().to_pylist()]
                data += codec(path).decode(flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, decoded])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return docs.drop(decoded).mapInArrow(run, f"{names}, `{decoded}` binary")


def encode_checked(docs: DataFrame, path: str, *, text: str = "text", ids: str = "token_ids", n_ids: str = "n_tokens", same: str = "round_trip") -> DataFrame:
    """All columns of ``docs``, the token ids, their number, and whether decoding them gives the text again; one pass through Python."""

    def run(texts: list[str]):
        flat, offsets = codec(path).encode(texts)
        back = codec(path).decode(flat, offsets)
        return [
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)), pa.array(np.diff(offsets)),
            pa.array([b == t.encode() for b, t in zip(back, texts, strict=True)], pa.bool_()),
        ]

    return add_columns(docs, text, f"`{ids}` array<int>, `{n_ids}` bigint, `{same}` boolean", run, SMALL_SLICE)
