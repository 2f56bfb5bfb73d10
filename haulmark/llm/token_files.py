"""Token ids in flat binary files with 64-bit document offsets, made to be memory-mapped.

A dataset is a folder on a file system that all machines mount:

* ``ids-<part>.bin``: the ids of a part's documents one after the other, little-endian unsigned integers, 16 bits where the
  vocabulary fits and 32 otherwise;
* ``offsets-<part>.bin``: for each document of the part where its ids begin in the whole dataset, little-endian unsigned 64
  bits, and one entry more for the end;
* ``manifest``: a Parquet table, one row a part: part, base (ids in all earlier parts), documents, ids, width, file names.

Documents are dealt into parts by ranges of doc_id and sorted inside, so the parts in order are the documents in ascending
order. A part is encoded while it is written and knows only its own counts; the bases are prefix sums over one number a part.
Offsets are written once the bases are known. Files have names of their own for each attempt of a task and the manifest names
those of the attempt that succeeded, so a lost executor or a second attempt leaves at most files that nothing refers to.

The tokenizer's library sees every distinct piece of a word once a cache. Its normaliser and splitter never look across a space
or line end, so a text may be cut there and the ids of its words joined; a word of Latin letters is cut further by the splitter's
own pattern, so that ``word``, ``Word,`` and ``word***`` share the call for ``word``. Both cuts hold for a normaliser and splitter
of this kind only, which is read from the file; with any other the library encodes whole texts. Special strings in a text are
ordinary text.

There are as many parts as shuffle partitions, and more where a part would pass ``PART_BYTES`` of the planned input.

Null text counts as empty: the document has the end id only. Rows that repeat a doc_id are all written, ordered by their text
hash; a null doc_id comes first. An empty table gives a manifest without rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
import zlib
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from haulmark.session import planned_bytes

from .blocks import slices, texts_of

CACHE = 500_000
END_ID = 2
PART_BYTES = 512 << 20
#: A sign that the tokenizer keeps as one id.
MARK = "^"
# Normaliser and splitter for which words and their pieces may be encoded apart.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPLITTER = [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: From here on a letter may change its class in lower case or combine with its neighbour.
NOT_LATIN = "\u0130"
#: Codes of the end of a document and of a gap between words.
END, GAP = 0, 1


def _latin_splitter() -> re.Pattern:
    """The splitter's pattern on lower-case text below ``NOT_LATIN``, with a space as a piece of its own."""
    of = {"L": "", "N": ""}
    for c in map(chr, range(ord(NOT_LATIN))):
        kind = unicodedata.category(c)[0]
        if kind in of:
            of[kind] += re.escape(c)
    letter, digit, space = of["L"], of["N"], r"\t-\r \x85\xa0"
    return re.compile(rf" |'(?:s|t|re|ve|m|ll|d)|[{letter}]+|[{digit}]|[^{space}{letter}{digit}]+")


class Words:
    """Ids of words by the tokenizers library, behind a bounded cache of two generations.

    A word has a code; its ids are a piece of one flat array. When the cache is full it becomes the past one, from which words
    in use move over without another call.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        file = json.loads(self.tokenizer.to_str())
        steps = [(file[k] or {}).get(n) for k, n in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        self.by_words = steps == [NORMALIZERS, SPLITTER] and file["model"]["type"] == "BPE"
        self.pieces = _latin_splitter().findall
        suffix = file["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[number] = bool(suffix) and token.endswith(suffix)
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[str, int] = {" ": GAP}
        self.flat = np.zeros(0, np.uint32)
        self.start = np.zeros(2, np.int64)
        self.size = np.zeros(2, np.int64)
        self.old = ({}, self.flat, self.start, self.size)

    def _turn(self) -> None:
        """The present cache becomes the past one."""
        old = (self.codes, self.flat, self.start, self.size)
        self._clear()
        self.old = old

    def _add(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.flat)
        self.codes.update(zip(words, range(len(self.size), len(self.size) + len(words)), strict=True))
        self.flat = np.concatenate([self.flat, ids])
        self.start = np.concatenate([self.start, first + np.cumsum(counts) - counts])
        self.size = np.concatenate([self.size, counts])

    @staticmethod
    def _gather(codes: np.ndarray, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the codes one after the other, the number of each, and where each begins."""
        sizes = size[codes]
        place = np.cumsum(sizes) - sizes
        index = np.repeat(start[codes] - place, sizes) + np.arange(int(sizes.sum()))
        return (flat[index] if len(flat) else np.zeros(len(index), np.uint32)), sizes, place

    def _remember(self, words: list[str]) -> list[str]:
        """Moves words of the past cache into the present one; the others are returned."""
        codes, *arrays = self.old
        known = [w for w in words if w in codes]
        if known:
            ids, sizes, _ = self._gather(np.array([codes[w] for w in known], np.int64), *arrays)
            self._add(known, ids, sizes)
            words = [w for w in words if w not in codes]
        return words

    def _call(self, words: list[str]) -> None:
        """One call of the library for many words, with a mark of one id between them; words with the mark go alone."""
        marked = [w for w in words if MARK in w]
        for word, coded in zip(marked, self.tokenizer.encode_batch(marked, add_special_tokens=False), strict=True):
            self._add([word], np.array(coded.ids, np.uint32), np.array([len(coded.ids)], np.int64))
        words = [w for w in words if MARK not in w] if marked else words
        if not words:
            return
        (mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        ids = np.array(self.tokenizer.encode(f" {MARK} ".join(words), add_special_tokens=False).ids, np.uint32)
        cuts = np.flatnonzero(ids == mark)
        self._add(words, ids[ids != mark], np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1)

    def _call_pieces(self, pieces: list[str]) -> None:
        """One call for many pieces that are one word each to the tokenizer: the last id of a word says so."""
        if pieces:
            (coded,) = self.tokenizer.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)
            ids = np.array(coded.ids, np.uint32)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(pieces):
                self._add(pieces, ids, np.diff(np.concatenate([[-1], last])))
            else:
                self._call(pieces)

    def _learn(self, words: list[str]) -> None:
        """Adds words: of Latin letters by the pieces that the splitter makes of them, others by a call for the word."""
        words = self._remember(words)
        latin = [w for w in words if w.isascii() or max(w) < NOT_LATIN]
        if len(latin) < len(words):
            self._call([w for w in words if not (w.isascii() or max(w) < NOT_LATIN)])
        if not latin:
            return
        pieces = self.pieces(" ".join(latin).lower())
        codes = np.fromiter(map(self.codes.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(codes < 0).tolist()
        self._call_pieces(self._remember(list(dict.fromkeys([pieces[i] for i in missing]))))
        codes[missing] = [self.codes[pieces[i]] for i in missing]
        ids, sizes, _ = self._gather(codes, self.flat, self.start, self.size)
        gaps = np.flatnonzero(codes == GAP)
        before = np.concatenate([[0], np.cumsum(sizes)])
        counts = np.diff(np.concatenate([[0], before[gaps], [before[-1]]]))
        # A piece of the same batch may be one of the words.
        new = np.fromiter((w not in self.codes for w in latin), bool, len(latin))
        self._add([w for w, n in zip(latin, new.tolist(), strict=True) if n], ids[np.repeat(new, counts)], counts[new])

    def _whole(self, texts: list[str], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        coded = [c.ids + [end] * (end is not None) for c in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        counts = np.array([len(c) for c in coded], np.int64)
        return np.fromiter((i for c in coded for i in c), np.uint32, int(counts.sum())), counts

    def encode(self, texts: list[str], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by ``end``, and the number of each text."""
        if not self.by_words:
            return self._whole(texts, end)
        words = " ".join(texts).replace("\n", " ").split(" ")
        per_text = np.array([t.count(" ") + t.count("\n") + 1 for t in texts], np.int64)
        codes = np.fromiter(map(self.codes.get, words, repeat(-1)), np.int64, len(words))
        if (codes < 0).any():
            if len(self.codes) > CACHE:
                self._turn()
                codes[:] = -1
            missing = np.flatnonzero(codes < 0).tolist()
            lacking = [words[i] for i in missing]
            self._learn(list(dict.fromkeys(lacking)))
            codes[missing] = [self.codes[w] for w in lacking]
        last = np.cumsum(per_text)
        codes = np.insert(codes, last, END)
        size = self.size.copy()
        size[END] = end is not None
        flat, sizes, place = self._gather(codes, self.flat, self.start, size)
        ends = last + np.arange(len(texts))
        if end is not None:
            flat[place[ends]] = end
        return flat, np.diff(np.concatenate([[0], place[ends] + sizes[ends]]))


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


def _open(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder; Hadoop also writes file:/path for a local one."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder else (pyarrow.fs.LocalFileSystem(), folder)


def id_width(path: str) -> int:
    """Bytes of an id: two where the largest id of the vocabulary fits."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def write(docs: DataFrame, folder: str, path: str, *, end: int = END_ID, parts: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the dataset and returns its manifest."""
    spark = docs.sparkSession
    width = id_width(path)
    kind = f"<u{width}"
    parts = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-planned_bytes(docs.select(doc_id, text)) // PART_BYTES))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("_hash"), F.col(text).alias("_text"))
    rows = rows.repartitionByRange(parts, "doc_id", "_hash").sortWithinPartitions("doc_id", "_hash")

    def run(batches):
        from pyspark import TaskContext

        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        files, root = _open(folder)
        files.create_dir(root, recursive=True)
        ids_file, rows_file = f"ids-{part:06d}-{name}.bin", f"rows-{part:06d}-{name}.bin"
        documents = total = 0
        with files.open_output_stream(f"{root}/{ids_file}") as ids_out, files.open_output_stream(f"{root}/{rows_file}") as rows_out:
            for batch in slices(batches, "_text"):
                flat, counts = words_of(path).encode(texts_of(batch, "_text"), end)
                ids_out.write(flat.astype(kind).tobytes())
                ids = batch.column(0)
                # A document's id, whether it is null, and its number of ids.
                table = np.stack([ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), counts], axis=1)
                rows_out.write(table.astype("<i8").tobytes())
                documents += batch.num_rows
                total += int(counts.sum())
        if documents:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "documents": [documents], "ids": [total], "ids_file": [ids_file], "rows_file": [rows_file]})
        else:
            files.delete_file(f"{root}/{ids_file}")
            files.delete_file(f"{root}/{rows_file}")

    schema = "part int, documents bigint, ids bigint, ids_file string, rows_file string"
    rows.mapInArrow(run, schema).write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    # One row a part: the prefix sum is over the number of parts, not of documents.
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = counts.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))).withColumn("width", F.lit(width))

    def offsets(batches):
        files, root = _open(folder)
        for batch in batches:
            names = []
            for row in batch.to_pylist():
                with files.open_input_stream(f"{root}/{row['rows_file']}") as f:
                    sizes = np.frombuffer(f.read(), "<i8").reshape(-1, 3)[:, 2]
                names.append(f"offsets-{row['part']:06d}-{uuid.uuid4().hex}.bin")
                with files.open_output_stream(f"{root}/{names[-1]}") as f:
                    f.write((row["base"] + np.concatenate([[0], np.cumsum(sizes)])).astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string())], names=[*batch.schema.names, "offsets_file"])

    parts_of = max(1, counts.count())
    based = based.repartition(parts_of, "part")
    based.mapInArrow(offsets, f"{schema}, base bigint, width int, offsets_file string").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _mapped(files: pyarrow.fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """The file as an array: mapped where the file system is a mounted one."""
    if files.get_file_info(path).size == 0:
        return np.zeros(0, kind)
    if isinstance(files, pyarrow.fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r")
    with files.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def read(spark: SparkSession, folder: str, *, with_ids: bool = True, per_batch: int = 512) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (array) of every document, from the files alone."""
    manifest = spark.read.parquet(f"{folder}/manifest")

    def run(batches):
        files, root = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                ids = _mapped(files, f"{root}/{row['ids_file']}", f"<u{row['width']}")
                offsets = _mapped(files, f"{root}/{row['offsets_file']}", "<u8").astype(np.int64)
                known = _mapped(files, f"{root}/{row['rows_file']}", "<i8").reshape(-1, 3)
                for at in range(0, row["documents"], per_batch):
                    stop = min(at + per_batch, row["documents"])
                    cut = offsets[at : stop + 1] - row["base"]
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                    columns = [
                        pa.array(known[at:stop, 0], mask=known[at:stop, 1] != 0),
                        pa.array(offsets[at:stop]),
                        pa.array(np.diff(cut)),
                        pa.array(crc, pa.int64()),
                    ]
                    if with_ids:
                        flat = pa.array(ids[cut[0] : cut[-1]].astype(np.int32))
                        columns.append(pa.ListArray.from_arrays(pa.array(cut - cut[0], pa.int32()), flat))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 5 if with_ids else 4]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return manifest.repartition(max(1, manifest.count()), "part").mapInArrow(run, schema)
