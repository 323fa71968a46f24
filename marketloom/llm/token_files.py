"""Token ids as flat files of unsigned integers with 64-bit document offsets, to be memory-mapped.

A corpus lies under a path as parts, each holding a range of documents in ascending doc_id order:

- <part>.ids: all ids one after the other, little-endian, 16 bits each where the vocabulary allows it, else 32;
- <part>.offsets: for each document, and once more at the end, the number of ids of the whole corpus before it (uint64);
- <part>.docs: doc_ids (int64); the first n_null of a part have none;
- index: a Parquet table with a row for each part: its files, its first document and its first id.

Texts are encoded where they are read and only ids are shuffled. Parts count their ids, prefix sums over the parts' counts give
each part's base, and then the offsets are written. A task writes under names of its own, and only what the index names
counts, so a task that is lost or run twice does no harm. Paths may be any that pyarrow's file systems open.
"""

from __future__ import annotations

import os
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from itertools import compress
from operator import not_
from string import ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved, scratch_dir
from .textops import buffers, pieces

#: Bytes of text to a part, and the most parts; a document counts ROW bytes besides its text.
PART_BYTES, MOST_PARTS, ROW = 32 << 20, 50_000, 64
#: Sampled keys to a part. They only balance the parts.
SAMPLES = 20
#: Words whose ids one task remembers, words that are encoded in one call, and in one where those can't be told apart.
WORDS, TOGETHER, FEW = 500_000, 4096, 64
#: Bytes of ids that one batch hands on.
FLUSH = 8 << 20
#: ASCII marks at a word's end that are split off it; neither those of contractions nor those of special tokens.
MARKS = ".,;:!?()[]{}\"%&$*+-/=@#^_~"
LAST = pa.array([m.encode() for m in MARKS], pa.large_binary())

PARTS_SQL = "part long, ids string, docs string, n_docs long, n_null long, n_tokens long, lengths binary"
INDEX_SQL = "part long, ids string, docs string, offsets string, n_docs long, n_null long, n_tokens long, first_doc long, first_token long, width int"


class Encoder:
    """Encodes texts word by word, each distinct word once by the tokenizer.

    For tokenizers whose pre-tokens never cross ASCII white space and which drop it. Marks behind a letter or digit are
    pre-tokens of their own. Words of letters only are one pre-token each, whose last id is one that ends words, so many
    are encoded in one call and told apart by these ids; where the count doesn't agree, fewer are, then each alone. Where the
    tokenizer lower-cases, words of ASCII are told apart in lower case only; others are left as they are, as a letter may be
    composed with its mark in one case alone, and so are words that might become an added token.
    """

    def __init__(self, file: str, end: int | None) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.end = Tokenizer.from_file(file), end
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.dtype = np.dtype("<u2" if max(len(self.closes) - 1, end or 0) < 1 << 16 else "<u4")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        normal = self.tokenizer.normalizer
        self.lowers = len(self.added) <= 64 and normal is not None and normal.normalize_str(ascii_uppercase) == ascii_uppercase.lower()
        self.ids: dict[str, bytes] = {}

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def _encoded(self, texts: list[str]) -> Iterator[list[int]]:
        return (e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))

    def _learn(self, words: list[str]) -> None:
        """Ids of words and marks that are not known yet."""
        letters = list(map(str.isalpha, map(str.lower, words))) if self.closes.any() else [False] * len(words)
        plain, rest = list(compress(words, letters)), list(compress(words, map(not_, letters)))
        runs = [plain[s : s + TOGETHER] for s in range(0, len(plain), TOGETHER)]
        for some in runs:  # grows
            ids = np.array(next(self._encoded([" ".join(some)])), self.dtype)
            last = np.flatnonzero(self.closes[ids]) + 1
            if len(last) == len(some) and last[-1] == len(ids):
                flat, cut = ids.tobytes(), [0, *(last * ids.itemsize).tolist()]
                self.ids.update(zip(some, map(flat.__getitem__, map(slice, cut[:-1], cut[1:])), strict=True))
            elif len(some) > FEW:
                runs += [some[s : s + FEW] for s in range(0, len(some), FEW)]
            else:
                rest += some
        self.ids.update(zip(rest, map(self._bytes, self._encoded(rest)), strict=True))

    def _of_words(self, words: pa.Array) -> pa.Array:
        """The ids of each word, as binary."""
        if self.lowers:
            lower, same = pc.ascii_lower(words), pc.string_is_ascii(words)
            for token in self.added:
                same = pc.and_not(same, pc.match_substring(lower, token))
            words = pc.if_else(same, lower, words)
        cores = words.to_numpy(zero_copy_only=False).tolist()
        marks: dict[int, str] = {}
        for k in np.flatnonzero(pc.is_in(pc.binary_slice(words.cast(pa.large_binary()), -1), LAST)).tolist():
            word = cores[k]
            cores[k] = core = _without_marks(word)
            marks[k] = word[len(core) :]
        own = {*cores, *marks.values()}
        new = own.difference(self.ids)
        if len(self.ids) + len(new) > WORDS:
            self.ids.clear()
            new = own
        self._learn(list(new))
        out = list(map(self.ids.__getitem__, cores))
        for k, mark in marks.items():
            out[k] += self.ids[mark]
        return pa.array(out, pa.large_binary())

    def documents(self, column: pa.Array) -> Iterator[tuple[int, bytes]]:
        """(row, ids) of whole texts with the end id behind each; null counts as empty. A long text comes in pieces."""
        data, offsets = buffers(column)
        held, row = [], 0
        for first, own, at in pieces(data, offsets):
            texts = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(own))
            words = pc.ascii_split_whitespace(texts)
            coded = words.values.dictionary_encode()
            made = self._of_words(coded.dictionary).take(coded.indices)
            _, ends, ids = made.buffers()
            cut = np.frombuffer(ends, np.int64)[made.offset + words.offsets.to_numpy()].tolist()
            for k in range(len(texts)):
                if first + k != row:
                    yield row, self._closed(held)
                    held, row = [], first + k
                held.append(ids[cut[k] : cut[k + 1]].to_pybytes() if cut[k] < cut[k + 1] else b"")
        if held:
            yield row, self._closed(held)

    def _closed(self, held: list[bytes]) -> bytes:
        return b"".join(held) + (b"" if self.end is None else self._bytes([self.end]))


def _without_marks(word: str) -> str:
    """A word without the marks behind its last letter or digit, where that one also ends in a letter or digit in lower case."""
    core = word.rstrip(MARKS)
    return core if len(core) == len(word) or core[-1:].lower()[-1:].isalnum() else word


_encoders: dict[tuple[str, int | None], Encoder] = {}


def _encoder(file: str, end: int | None) -> Encoder:
    """The encoder of this process; a worker keeps it from task to task."""
    if (file, end) not in _encoders:
        _encoders[file, end] = Encoder(file, end)
    return _encoders[file, end]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def _create(path: str):
    where, name = _opened(path)
    where.create_dir(name.rpartition("/")[0], recursive=True)
    return where.open_output_stream(name)


def mapped(path: str, dtype: str) -> np.ndarray:
    """A file's numbers: memory-mapped where the file system is a mounted one, else read."""
    where, name = _opened(path)
    if not where.get_file_info(name).size:
        return np.zeros(0, dtype)
    if isinstance(where, fs.LocalFileSystem):
        return np.memmap(name, dtype, "r")
    with where.open_input_file(name) as f:
        return np.frombuffer(f.read(), dtype)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and what orders rows of one doc_id: a hash of the text, then the row's place in the table."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row"))


def _splitters(rows: DataFrame) -> list[tuple]:
    """Keys that part rows into ranges of about PART_BYTES, from at most some SAMPLES * MOST_PARTS sampled ones."""
    size = F.octet_length("text") + ROW
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    parts = min(MOST_PARTS, -(-total // PART_BYTES))
    if parts < 2:
        return []
    some = rows.select("doc_id", "hash", "row", size.alias("size")).sample(fraction=min(1.0, SAMPLES * parts / n), seed=1).toArrow().to_pydict()
    keys = sorted(zip(*(map(_first_if_none, some["doc_id"]), some["hash"], some["row"], some["size"]), strict=True))
    before = np.cumsum([k[-1] for k in keys])
    at = np.searchsorted(before, before[-1] * np.arange(1, parts) / parts) if len(keys) else []
    return sorted({keys[i][:3] for i in at})


def _first_if_none(doc_id: int | None) -> tuple:
    return (0, 0) if doc_id is None else (1, doc_id)


def encoded(docs: DataFrame, file: str, end: int | None, splitters: list[tuple] = ()) -> DataFrame:
    """part, doc_id, hash, row and ids (binary) of docs with a row number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file, end)
        for batch in batches:
            key = [batch.column(c).to_pylist() for c in ("doc_id", "hash", "row")]
            parts = pa.array([bisect_right(splitters, (_first_if_none(d), h, r)) for d, h, r in zip(*key, strict=True)], pa.int64())
            made, size, begin = [], 0, 0
            for row, ids in encoder.documents(batch.column("text")):
                made.append(ids)
                size += len(ids)
                if size > FLUSH or row == batch.num_rows - 1:
                    own = [c.slice(begin, len(made)) for c in (parts, *(batch.column(c) for c in ("doc_id", "hash", "row")))]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(made, pa.binary())], names=["part", "doc_id", "hash", "row", "ids"])
                    made, size, begin = [], 0, row + 1

    return docs.mapInArrow(run, "part long, doc_id long, hash long, row long, ids binary")


class _Part:
    """The files of a part while they are written."""

    def __init__(self, path: str, number: int, width: int) -> None:
        name = f"{path}/{number:06d}-{uuid.uuid4().hex}"
        self.number, self.names, self.width = number, (f"{name}.ids", f"{name}.docs"), width
        self.ids, self.docs = map(_create, self.names)
        self.n = self.null = self.tokens = 0
        self.lengths: list[bytes] = []

    def add(self, rows: pa.RecordBatch) -> None:
        column = rows.column("ids").cast(pa.large_binary())
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        if data is not None:
            self.ids.write(memoryview(data)[offsets[0] : offsets[-1]])
        docs = rows.column("doc_id")
        self.docs.write(docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        self.lengths.append((np.diff(offsets) // self.width).astype("<u4").tobytes())
        self.n, self.null, self.tokens = self.n + len(docs), self.null + docs.null_count, self.tokens + int(offsets[-1] - offsets[0]) // self.width

    def closed(self) -> pa.RecordBatch:
        self.ids.close()
        self.docs.close()
        row = [self.number, *self.names, self.n, self.null, self.tokens, b"".join(self.lengths)]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["part", "ids", "docs", "n_docs", "n_null", "n_tokens", "lengths"])


def _written(path: str, width: int):
    """Writes rows that come sorted as parts; a row for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            number = batch.column("part").to_numpy()
            cut = np.append(np.flatnonzero(np.append(True, number[1:] != number[:-1])), len(number)) if len(number) else [0]
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                if part is None or part.number != number[s]:
                    if part:
                        yield part.closed()
                    part = _Part(path, int(number[s]), width)
                part.add(batch.slice(s, e - s))
        if part:
            yield part.closed()

    return run


def _offsets(path: str):
    """Writes the offsets of parts whose first id is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = []
            for ids, base, lengths in zip(*(batch.column(c).to_pylist() for c in ("ids", "first_token", "lengths")), strict=True):
                names.append(f"{path}/{ids.rpartition('/')[2].removesuffix('.ids')}-{uuid.uuid4().hex}.offsets")
                with _create(names[-1]) as f:
                    f.write(np.append(base, base + np.cumsum(np.frombuffer(lengths, "<u4"), dtype=np.uint64)).astype("<u8").tobytes())
            columns = {"offsets": pa.array(names, pa.string())} | {c: batch.column(c) for c in batch.schema.names if c != "lengths"}
            order = [c.split()[0] for c in INDEX_SQL.split(", ")]
            yield pa.RecordBatch.from_arrays([columns[c] for c in order], names=order)

    return run


def write(docs: DataFrame, file: str, end: int | None = None, path: str | None = None) -> str:
    """Encodes docs (doc_id, text) with the tokenizer in file, end behind each document, and writes them under path, a new
    place in the shared folder if there is none. Returns the path.

    Null text counts as empty: a document of the end id alone. Rows without doc_id come first; rows of one doc_id are
    documents of their own, ordered by a hash of their text and then by their place in the table. Repeated texts are
    encoded and written each time. An empty table gives an empty index. Columns besides doc_id and text aren't read.
    """
    spark = docs.sparkSession
    path = path or f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    rows = _keyed(docs)
    splitters = _splitters(rows)
    parts, width = len(splitters) + 1, Encoder(file, end).dtype.itemsize
    order = ["part", F.col("doc_id").asc_nulls_first(), "hash", "row"]
    dealt = encoded(rows, file, end, splitters).repartitionById(parts, F.col("part").cast("int")).sortWithinPartitions(*order)
    made = saved(dealt.select("part", "doc_id", "ids").mapInArrow(_written(path, width), PARTS_SQL), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    base = made.select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(d) for c, d in (("n_docs", "first_doc"), ("n_tokens", "first_token"))])
    placed = made.join(base, "part").withColumn("width", F.lit(width)).repartitionById(parts, F.col("part").cast("int"))
    placed.mapInArrow(_offsets(path), INDEX_SQL).write.parquet(f"{path}/index")
    return path


def index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SQL).parquet(f"{path}/index")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in batch.to_pylist():
            ids, offsets, docs = mapped(part["ids"], f"<u{part['width']}"), mapped(part["offsets"], "<u8"), mapped(part["docs"], "<i8")
            at = (offsets - np.uint64(part["first_token"])).astype(np.int64)
            s = 0
            while s < part["n_docs"]:
                e = max(s + 1, int(np.searchsorted(at, at[s] + FLUSH // 4, "right")) - 1)
                wide = ids[at[s] : at[e]].astype("<u4").tobytes()
                own = [wide[4 * (i - at[s]) : 4 * (j - at[s])] for i, j in zip(at[s:e].tolist(), at[s + 1 : e + 1].tolist(), strict=True)]
                null = np.arange(s, e) < part["n_null"]
                yield pa.RecordBatch.from_arrays([pa.array(docs[s:e], mask=null), pa.array(offsets[s:e].astype(np.int64)), pa.array(own, pa.binary())], names=["doc_id", "start", "ids"])
                s = e


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (binary, little-endian, 32 bits each), read from the files; a
    part is a task's."""
    parts = index(spark, path)
    n = max(1, parts.agg(F.max("part")).first()[0] or 0) + 1
    return parts.repartitionById(n, F.col("part").cast("int")).mapInArrow(_documents, "doc_id long, start long, ids binary")


def span(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """The ids from start to stop of the whole corpus, from the parts that hold them, as a training loop reads a window."""
    held = index(spark, path).filter((F.col("first_token") < stop) & (F.col("first_token") + F.col("n_tokens") > start)).orderBy("part")
    found = [mapped(p.ids, f"<u{p.width}")[max(0, start - p.first_token) : stop - p.first_token] for p in held.collect()]
    return np.concatenate(found).astype(np.uint32) if found else np.zeros(0, np.uint32)
