"""Vector code compression: four one-byte codes a vector, exact in integers.

A vector's scaled entries are cut into parts, and each part is replaced by the nearest entry of its position's codebook.
Parts and entries are zero-padded to a power of two and put through the integer Walsh-Hadamard transform, which multiplies
squared distances by that power. Squared differences of coefficients are summed in order of sequency, and an entry whose
partial sum exceeds the distance of one already summed in full is dropped at once: no sum of squares ever falls.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, saved
from .vectors import LARGEST, SCALE, blocks, kept, scaled

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Coefficients that all entries are compared on before any is dropped.
FIRST = 2


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of rows, zero-padded to a power of two, coefficients by sequency (sign changes)."""
    width = 1 << max(0, rows.shape[1] - 1).bit_length()
    out = np.zeros((len(rows), width), rows.dtype)
    out[:, : rows.shape[1]] = rows
    half = 1
    while half < width:
        pairs = out.reshape(len(out), -1, 2, half)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2).reshape(len(out), width)
        half *= 2
    return out[:, _sequency(width)]


def _sequency(width: int) -> np.ndarray:
    """The natural numbers of the Walsh functions by rising sequency: the bits of a Gray code, read backwards."""
    bits = width.bit_length() - 1
    gray = np.arange(width) ^ (np.arange(width) >> 1)
    return np.array([int(f"{g:0{bits}b}"[::-1], 2) if bits else 0 for g in gray])


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of parts, the nearest row of entries (of equally near ones the first) and its squared distance.

    Both are transformed already; the distance is that of the untransformed rows, whatever their padding.
    """
    n, width = parts.shape
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = min(FIRST, width)
    sums = np.zeros((n, len(entries)), parts.dtype)
    for k in range(first):
        apart = parts[:, k, None] - entries[None, :, k]
        sums += apart * apart
    guess = sums.argmin(1)
    apart = parts - entries[guess]
    bound = (apart * apart).sum(1)
    row, entry = np.nonzero(sums <= bound[:, None])
    total, k = sums[row, entry], first
    while k < width:
        to = min(width, 2 * k)
        apart = parts[row, k:to] - entries[entry, k:to]
        total = total + (apart * apart).sum(1)
        stay = np.flatnonzero((total <= bound[row]).astype(bool))
        row, entry, total, k = row[stay], entry[stay], total[stay], to
    begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    least = np.minimum.reduceat(total, begin)
    hit = np.flatnonzero((total == least[row]).astype(bool))  # rows stand in order, and their entries too
    hit = hit[np.append(True, row[hit][1:] != row[hit][:-1])]
    return entry[hit], least // width


@dataclass(frozen=True)
class Codebooks:
    """books[p] holds the entries of part p as integers (entries, width)."""

    dims: int
    books: tuple[np.ndarray, ...]

    @property
    def width(self) -> int:
        return self.books[0].shape[1]

    def cut(self, x: np.ndarray) -> list[np.ndarray]:
        """The parts of scaled vectors; where the dimension is no multiple of the number of parts, zeros follow."""
        full = np.zeros((len(x), self.width * len(self.books)), np.int64)
        full[:, : x.shape[1]] = x
        return [full[:, p * self.width : (p + 1) * self.width] for p in range(len(self.books))]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows, parts) and squared distances (rows, parts) of scaled vectors."""
        coefficients = 1 << max(0, self.width - 1).bit_length()
        codes, errors = [], []
        for part, book in zip(self.cut(x), self.books, strict=True):
            most = max(int(np.abs(part).max(initial=0)), int(np.abs(book).max(initial=0)))
            kind = np.int64 if 4 * coefficients**3 * most**2 < 1 << 63 else object  # beyond 64 bits Python's integers count
            code, error = nearest(transform(part.astype(kind)), transform(book.astype(kind)))
            codes.append(code)
            errors.append(error.astype(np.int64))
        return np.stack(codes, 1), np.stack(errors, 1)

    def digest(self) -> str:
        """SHA-256 of all entries' integers by part, entry and place, comma-joined."""
        return hashlib.sha256(",".join(str(v) for book in self.books for v in book.ravel().tolist()).encode()).hexdigest()

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """What codes stand for, in scaled integers."""
        return np.concatenate([book[codes[:, p]] for p, book in enumerate(self.books)], 1)[:, : self.dims]


def _moved(rows: DataFrame, vector: str, books: Codebooks) -> Codebooks:
    """One round: each entry becomes the floor of its parts' mean, place by place; an entry without parts stays.

    A task hands on one row for each entry it has parts of, and the sums of all tasks' rows are as many as all entries.
    """
    width = books.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b), width), np.int64) for b in books.books]
        counts = [np.zeros(len(b), np.int64) for b in books.books]
        for _, x in blocks(batches, vector, books.dims):
            codes, _ = books.assign(x)
            for p, part in enumerate(books.cut(x)):
                np.add.at(sums[p], codes[:, p], part)
                counts[p] += np.bincount(codes[:, p], minlength=len(counts[p]))
        for p, count in enumerate(counts):
            used = np.flatnonzero(count)
            if len(used):
                columns = [np.full(len(used), p), used, count[used], *sums[p][used].T]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    names = ["part", "entry", "n", *[f"s{i}" for i in range(width)]]
    each = rows.select(vector).mapInArrow(run, ", ".join(f"{c} long" for c in names))
    new = [book.copy() for book in books.books]
    for r in each.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in names[2:]]).collect():
        new[r.part][r.entry] = [r[f"s{i}"] // r.n for i in range(width)]
    return Codebooks(books.dims, tuple(new))


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vector: str = "embedding") -> tuple[DataFrame, Codebooks | None]:
    """The rows that take part (see vectors.kept) and codebooks fitted to all of them; None without any row.

    The first entries are the parts of the rows with the smallest vec_ids, null last, rows of one id by their entries. With
    fewer rows there are fewer entries.
    """
    rows, dims = kept(rows, vector)
    if not dims:
        return rows, None
    first = rows.select("vec_id", vector).orderBy(F.col("vec_id").asc_nulls_last(), vector).limit(entries)
    start = scaled(first.toArrow().column(vector), dims)
    books = Codebooks(dims, (np.zeros((0, -(-dims // parts)), np.int64),) * parts)
    books = Codebooks(dims, tuple(books.cut(start)))
    for _ in range(rounds):
        books = _moved(rows, vector, books)
    return rows, books


def encode(rows: DataFrame, books: Codebooks, vector: str = "embedding", keep: tuple[str, ...] = ()) -> DataFrame:
    """vec_id, columns to keep, code (two hex digits a part) and error (squared distances summed over parts)."""
    columns = ["vec_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in blocks(batches, vector, books.dims):
            codes, errors = books.assign(x)
            text = codes.astype(np.uint8).tobytes().hex()
            step = 2 * codes.shape[1]
            made = [pa.array([text[i : i + step] for i in range(0, len(text), step)]), pa.array(errors.sum(1))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *made], names=[*columns, "code", "error"])

    kinds = dict(rows.dtypes)
    return rows.select(*dict.fromkeys([*columns, vector])).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", code string, error long")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """codes with the vector that a code stands for, in the scale of the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = np.frombuffer(bytes.fromhex("".join(batch.column("code").to_pylist())), np.uint8).reshape(-1, len(books.books))
            flat = pa.array((books.vectors(numbers) / SCALE).ravel())
            ends = pa.array(np.arange(len(numbers) + 1, dtype=np.int32) * books.dims)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, flat)], names=[*batch.schema.names, "decoded"])

    schema = ", ".join(f"`{c}` {kind}" for c, kind in codes.dtypes)
    return codes.mapInArrow(run, f"{schema}, decoded array<double>")


def compressed(rows: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: a row for each row that takes part.

    Rows whose vector is null, holds a null or non-finite entry, one of magnitude LARGEST, or has another dimension than
    most do not take part. Rows that repeat a vec_id, or have none, are rows of their own, and rows with equal vectors have
    equal codes. label_error sums error over equal labels, null labels together. An empty table gives no rows; other columns
    aren't read.
    """
    spark = rows.sparkSession
    rows, books = train(rows.select("vec_id", label, vector), vector=vector)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    own = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))
    codes = saved(encode(rows, books, vector, (label,)).select(F.col("vec_id").cast("long").alias("vec_id"), "code", "error", own.alias("own")), "vector-codes")
    groups = saved(codes.groupBy("own").agg(F.count("*").alias("rows"), F.sum("error").alias("label_error")), "vector-labels")
    return join_groups(codes, groups, "own", "rows").select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
