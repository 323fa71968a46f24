"""Repeated passages: those that also occur in an earlier document are found at anchors and cut out.

This departs from sorting all suffixes by their bytes; the README says why. Suffixes are taken at minimizers: of the GRAM-byte strings in a window of LENGTH bytes, the one with the smallest hash
(the leftmost of equals) is the window's anchor. Equal windows have equal anchors, so sorting only the suffixes that
begin at anchors (about one in fourteen) finds every repeated window. The windows of one anchor that lie side by side
are its cell. Suffixes are range-partitioned by their leading bytes with sampled splitters; a partition is sorted
locally by several keys (fingerprint of the leading GRAM bytes, hash of the cell, document) and neighbours are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, sieve
from .textops import ODD, PIECE, U, buffers, groups, mix, prefix_hash, span_hash

LENGTH, GRAM = 50, 24
#: Text whose cells one map task holds and compares before it hands them on.
FLUSH = 12 << 20
#: Anchors for a range; with it ranges keep their size, and their number grows with the corpus.
PER_RANGE = 1_000_000
PARTS = [("range", pa.int32()), ("kind", pa.int32()), *[(c, pa.binary()) for c in ("docs", "counts", "at", "size", "print", "cell")]]
PARTS_SCHEMA = pa.schema(PARTS)
PARTS_SQL = "range int, kind int, docs binary, counts binary, at binary, size binary, print binary, cell binary"
CELLS, SPANS = 0, 1


def cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the rows of a text column: row, first window, number of windows, order key, fingerprint and hash of each cell.

    A cell's bytes are those from its first window on, number + LENGTH - 1 of them. The order key is five leading bytes of
    the suffix at the anchor and, after them, its fingerprint.
    """
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint32, np.uint64))
    prefix = prefix_hash(data)
    i = np.arange(n - GRAM + 1)
    gram = span_hash(prefix, i, i + GRAM)
    value, place = (gram >> U(32)).astype(np.uint32), i.astype(np.int32)
    width, span = 1, LENGTH - GRAM + 1
    while width < span:
        h = min(width, span - width)
        first = value[:-h] <= value[h:]
        value, place = np.where(first, value[:-h], value[h:]), np.where(first, place[:-h], place[h:])
        width += h
    ends = np.repeat(offsets[1:], np.diff(offsets))
    s = np.flatnonzero(np.arange(n - LENGTH + 1) + LENGTH <= ends[: n - LENGTH + 1])
    if not len(s):
        return cells(data[:0], offsets[:1])
    anchor = place[s]
    cut = np.concatenate(([0], np.flatnonzero((np.diff(anchor) != 0) | (np.diff(s) != 1)) + 1))
    at, number = s[cut], np.diff(np.append(cut, len(s)))
    a = anchor[cut].astype(np.int64)
    lead = np.zeros(len(a), np.uint64)
    for k in range(5):
        lead = (lead << U(8)) | data[a + k].astype(np.uint64)
    mark = gram[a]
    order = (lead << U(24)) | (mark >> U(40))
    row = np.searchsorted(offsets, at, "right") - 1
    return row, at - offsets[row], number, order, (mark & U(0xFFFFFFFF)).astype(np.uint32), span_hash(prefix, at, at + number + LENGTH - 1)


def _all_cells(column: pa.Array) -> Iterator[tuple[int, int, tuple[np.ndarray, ...]]]:
    """(row, bytes, cells) of pieces of a text column; a long text is cut into pieces whose windows don't repeat."""
    data, offsets = buffers(column)
    for i, j in groups(offsets):
        own = data[offsets[i] : offsets[j]]
        if len(own) <= 2 * PIECE:
            yield i, len(own), cells(own, offsets[i : j + 1] - offsets[i])
            continue
        for s in range(0, len(own), PIECE):
            piece = own[s : s + PIECE + LENGTH - 1]
            found = cells(piece, np.array([0, len(piece)]))
            yield i, len(piece), (found[0], found[1] + s, *found[2:])


def _heads(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where rows of another text begin; rows must be sorted by text."""
    return np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])) if len(doc) else np.zeros(0, bool)


def _merged(doc: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of bytes, those that touch or overlap in a text made one."""
    if not len(doc):
        return doc, key, start, end
    order = np.lexsort((start, key, doc))
    doc, key, start, end = doc[order], key[order], start[order], end[order]
    new = _heads(doc, key)
    base = np.cumsum(new).astype(np.int64) << 33  # texts lie one behind the other, so one running maximum does
    reach = np.maximum.accumulate(end + base)
    head = np.flatnonzero(np.append(True, (start + base)[1:] > reach[:-1]))
    return doc[head], key[head], start[head], reach[np.append(head[1:], len(doc)) - 1] - base[head]


def _packed(number: int, kind: int, doc: np.ndarray, key: np.ndarray, at: np.ndarray, size: np.ndarray, mark: np.ndarray, cell: np.ndarray) -> tuple:
    """One row of PARTS; rows must be sorted by text."""
    head = np.flatnonzero(_heads(doc, key))
    counts = np.diff(np.append(head, len(doc))).astype(np.int32)
    return (number, kind, np.stack((doc[head], key[head]), 1).astype(np.int64).tobytes(), counts.tobytes(), at.astype(np.int32).tobytes(), size.astype(np.int32 if kind == SPANS else np.uint8).tobytes(), mark.tobytes(), cell.tobytes())


def _unpacked(row: dict) -> tuple[np.ndarray, ...]:
    doc, key = np.repeat(np.frombuffer(row["docs"], np.int64).reshape(-1, 2), np.frombuffer(row["counts"], np.int32), 0).T
    size = np.frombuffer(row["size"], np.int32 if row["kind"] == SPANS else np.uint8)
    return doc, key, np.frombuffer(row["at"], np.int32).astype(np.int64), size.astype(np.int64), np.frombuffer(row["print"], np.uint32), np.frombuffer(row["cell"], np.uint64)


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), PARTS, strict=True)], schema=PARTS_SCHEMA)


def _by_doc(doc: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray, ranges: int, kind: int = SPANS, mark: np.ndarray | None = None) -> Iterator[tuple]:
    """PARTS rows for ranges of document hashes. Spans carry their ends in size."""
    to = (mix(doc.astype(np.uint64) ^ ODD[60]) % U(ranges)).astype(np.int64)
    order = np.lexsort((start, key, doc, to))
    to, doc, key, start, end = to[order], doc[order], key[order], start[order], end[order]
    mark = np.zeros(0, np.uint32) if mark is None else mark[order]
    cut = np.append(np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, np.int64), len(to))
    for s, e in zip(cut[:-1], cut[1:], strict=True):
        yield _packed(int(to[s]), kind, doc[s:e], key[s:e], start[s:e], end[s:e], mark[s:e], np.zeros(0, np.uint64))


def _find_cells(splitters: np.ndarray, ranges: int):
    """Map side: cells go to the range of their order key. Of equal cells in a flush only those of the smallest document
    go; the others repeat it, and only their spans are handed on (to any range, by document)."""

    def flushed(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        doc, key, at, number, lead, mark, cell = (np.concatenate(c) for c in zip(*held, strict=True))
        if not len(doc):
            return
        order = np.lexsort((doc, cell))
        new = np.append(True, cell[order][1:] != cell[order][:-1])
        lowest = np.empty(len(doc), np.int64)
        lowest[order] = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        again = doc > lowest
        spans = _merged(doc[again], key[again], at[again], at[again] + number[again] + LENGTH - 1)
        out = list(_by_doc(*spans, ranges))
        keep = np.flatnonzero(~again)
        to = np.searchsorted(splitters, lead[keep], "right")
        keep = keep[np.lexsort((at[keep], key[keep], doc[keep], to))]
        to = np.sort(to)
        cut = np.append(np.flatnonzero(np.append(True, to[1:] != to[:-1])), len(to))
        for s, e in zip(cut[:-1], cut[1:], strict=True):
            k = keep[s:e]
            out.append(_packed(int(to[s]), CELLS, doc[k], key[k], at[k], number[k], mark[k], cell[k]))
        for s in range(0, len(out), 64):
            yield _parts(out[s : s + 64])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "key"))
            for i, n, (row, *rest) in _all_cells(batch.column("text")):
                held.append((ids[i + row], keys[i + row], *rest))
                size += n
                if size > FLUSH:
                    yield from flushed(held)
                    held, size = [], 0
        if held:
            yield from flushed(held)

    return run


def _each_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """The rows of one range after the other; rows come sorted by range."""
    number, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["range"] != number and rows:
                yield number, rows
                rows = []
            number = row["range"]
            rows.append(row)
    if rows:
        yield number, rows


def _compare_cells(ranges: int):
    """Reduce side: sorts a range's suffixes; a cell that a smaller document has is a span, and where suffixes agree in
    GRAM bytes but not in their cells, the first document of each cell is left for a closer look."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _each_range(batches):
            passed = [r for r in rows if r["kind"] == SPANS]
            out = [tuple(r[c] for c, _ in PARTS) for r in passed]
            if own := [_unpacked(r) for r in rows if r["kind"] == CELLS]:
                doc, key, at, number, mark, cell = (np.concatenate(c) for c in zip(*own, strict=True))
                order = np.lexsort((doc, cell, mark))
                doc, key, at, number, mark, cell = doc[order], key[order], at[order], number[order], mark[order], cell[order]
                first_mark = np.append(True, mark[1:] != mark[:-1])
                first_cell = first_mark | np.append(True, cell[1:] != cell[:-1])
                head = np.flatnonzero(first_cell)
                again = doc > doc[head][np.cumsum(first_cell) - 1]
                out += _by_doc(*_merged(doc[again], key[again], at[again], at[again] + number[again] + LENGTH - 1), ranges)
                group = np.cumsum(first_mark) - 1
                various = np.bincount(group, first_cell) > 1
                begin = np.flatnonzero(first_mark)
                various &= np.minimum.reduceat(doc, begin) < np.maximum.reduceat(doc, begin)
                near = various[group] & ~again
                out += _by_doc(doc[near], key[near], at[near], number[near], ranges, CELLS, mark[near])
            for s in range(0, len(out), 64):
                yield _parts(out[s : s + 64])

    return run


def _close_windows(ranges: int):
    """Texts with the cells to be looked at: their bytes go to the range of their fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            doc, key, at, number, mark, raw = (np.concatenate(c) for c in zip(*held, strict=True))
            length = number + LENGTH - 1
            begin = np.cumsum(length) - length
            to = (mark % np.uint32(ranges)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cut = np.append(np.flatnonzero(np.append(True, to[order][1:] != to[order][:-1])), len(to))
            out = []
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                k = order[s:e]
                total = length[k]
                index = np.repeat(begin[k] - (np.cumsum(total) - total), total) + np.arange(total.sum())
                part = _packed(int(to[k[0]]), CELLS, doc[k], key[k], at[k], number[k], mark[k], np.zeros(0, np.uint64))
                out.append((*part[:-1], raw[index].tobytes()))
            for s in range(0, len(out), 64):
                yield _parts(out[s : s + 64])

        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            docs, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "key"))
            ats, sizes, marks = batch.column("at").to_pylist(), batch.column("size").to_pylist(), batch.column("print").to_pylist()
            for i in range(batch.num_rows):
                at, number, mark = np.frombuffer(ats[i], np.int32).astype(np.int64), np.frombuffer(sizes[i], np.uint8).astype(np.int64), np.frombuffer(marks[i], np.uint32)
                length = number + LENGTH - 1
                index = np.repeat(at - (np.cumsum(length) - length), length) + np.arange(length.sum()) + offsets[i]
                held.append((np.full(len(at), docs[i]), np.full(len(at), keys[i]), at, number, mark, data[index]))
                size += int(length.sum())
                if size > FLUSH:
                    yield from flushed()
                    held, size = [], 0
        if held:
            yield from flushed()

    return run


def _compare_windows(ranges: int):
    """All windows of the cells of a range, sorted by hash and document; bytes are compared with the first of a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _each_range(batches):
            parts = [(*(_unpacked(r | {"cell": b""})[:4]), np.frombuffer(r["cell"], np.uint8)) for r in rows]
            doc, key, at, number, raw = (np.concatenate(c) for c in zip(*parts, strict=True))
            length = number + LENGTH - 1
            begin = np.cumsum(length) - length
            step = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
            where = np.repeat(begin, number) + step
            doc, key, at = np.repeat(doc, number), np.repeat(key, number), np.repeat(at, number) + step
            hashes = np.concatenate([span_hash(prefix_hash(raw[s : s + PIECE + LENGTH]), w - s, w - s + LENGTH) for s in range(0, len(raw), PIECE) for w in [where[(where >= s) & (where < s + PIECE)]]])
            order = np.lexsort((doc, hashes))
            new = np.append(True, hashes[order][1:] != hashes[order][:-1])
            head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
            held = np.flatnonzero(doc[order] > doc[head])
            found, first = order[held], head[held]
            same = np.ones(len(found), bool)
            for s in range(0, len(found), 100_000):
                f, h = where[found[s : s + 100_000]], where[first[s : s + 100_000]]
                same[s : s + 100_000] = (raw[f[:, None] + np.arange(LENGTH)] == raw[h[:, None] + np.arange(LENGTH)]).all(1)
            for k in np.flatnonzero(~same):  # equal hashes of different bytes: compare with the whole run
                run_of = order[hashes[order] == hashes[found[k]]]
                mine = raw[where[found[k]] : where[found[k]] + LENGTH].tobytes()
                same[k] = any(doc[o] < doc[found[k]] and raw[where[o] : where[o] + LENGTH].tobytes() == mine for o in run_of)
            found = found[same]
            out = list(_by_doc(*_merged(doc[found], key[found], at[found], at[found] + LENGTH), ranges))
            for s in range(0, len(out), 64):
                yield _parts(out[s : s + 64])

    return run


def _docs_of(batches: Iterator[pa.RecordBatch], kind: int) -> Iterator[pa.RecordBatch]:
    """One row per text of a range: doc_id, key, at, size, print."""
    names = ["doc_id", "key", "at", "size", "print"]
    for _, rows in _each_range(batches):
        doc, key, at, size, mark, _ = (np.concatenate(c) for c in zip(*map(_unpacked, rows), strict=True))
        if kind == SPANS:
            doc, key, at, size = _merged(doc, key, at, size)
        else:
            order = np.lexsort((at, key, doc))
            doc, key, at, size, mark = doc[order], key[order], at[order], size[order], mark[order]
        head = np.append(np.flatnonzero(_heads(doc, key)), len(doc))
        at, size = at.astype(np.int32), size.astype(np.int32 if kind == SPANS else np.uint8)
        for s in range(0, len(head) - 1, 4096):
            cut = list(zip(head[s : s + 4096], head[s + 1 : s + 4097], strict=False))
            cut = [c for c in cut if c[0] < c[1]]
            columns = [pa.array(x[[c[0] for c in cut]]) for x in (doc, key)] + [pa.array([x[i:j].tobytes() for i, j in cut], pa.binary()) for x in (at, size, mark)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _collected(parts: DataFrame, kind: int, ranges: int) -> DataFrame:
    dealt = parts.filter(F.col("kind") == kind).repartition(ranges, "range").sortWithinPartitions("range")
    return dealt.mapInArrow(lambda b: _docs_of(b, kind), "doc_id long, key long, at binary, size binary, print binary")


def _splitters(docs: DataFrame, total: int) -> np.ndarray:
    """Order keys that cut the anchors into ranges of about PER_RANGE, from documents all over the corpus: those whose
    hashed ids fall in a share that gives about 50,000 keys, whatever its size. They only balance."""
    ranges = max(2, total // (14 * PER_RANGE) + 1)
    every = max(1, total // (11 << 20))
    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, found in _all_cells(batch.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(found[3][::16].view(np.int64))], names=["key"])

    keys = np.sort(np.array([r[0] for r in some.mapInArrow(run, "key long").collect()], np.int64).view(np.uint64))
    return keys[np.linspace(0, len(keys) - 1, ranges + 1).astype(int)[1:-1]] if len(keys) else keys


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, key and the spans [at, size) of bytes (int32, packed) of docs (doc_id, key, text) that an earlier document has.

    key tells texts of one doc_id apart; such texts are not earlier than each other."""
    docs = docs.filter("doc_id is not null")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    splitters = _splitters(docs, total)
    ranges = len(splitters) + 1
    found = docs.mapInArrow(_find_cells(splitters, ranges), PARTS_SQL)
    dealt = found.repartition(ranges, "range").sortWithinPartitions("range")
    first = saved(dealt.mapInArrow(_compare_cells(ranges), PARTS_SQL), "repeats-cells")
    near = saved(_collected(first, CELLS, ranges), "repeats-near")
    texts = sieve(docs, F.col("doc_id"), near, "doc_id").join(near, ["doc_id", "key"]).select("doc_id", "key", "text", "at", "size", "print")
    dealt = texts.mapInArrow(_close_windows(ranges), PARTS_SQL).repartition(ranges, "range").sortWithinPartitions("range")
    second = saved(dealt.mapInArrow(_compare_windows(ranges), PARTS_SQL), "repeats-windows")
    return _collected(first.unionByName(second), SPANS, ranges)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of docs.

    A byte goes if a string of LENGTH bytes that covers it also starts in a document with a smaller doc_id, judged on the
    texts as given. Matches never cross documents. Null text counts as empty; texts under LENGTH bytes lose nothing; a row
    without doc_id takes no part and keeps all; rows repeated with one doc_id and text give equal rows. Rows with one doc_id
    and different texts are judged each by its own text, and not against each other, as neither id is smaller (a 64-bit hash
    of the text tells them apart). An empty table gives no rows; columns besides doc_id and text aren't read.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    spans = saved(repeated_spans(docs), "repeats-spans")
    texts = sieve(docs, F.col("doc_id"), spans, "doc_id").join(spans, ["doc_id", "key"]).select("doc_id", "key", "text", "at", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            removed, number, digests = [], [], []
            for i, (at, end) in enumerate(zip(batch.column("at").to_pylist(), batch.column("size").to_pylist(), strict=True)):
                own, at, end = data[offsets[i] : offsets[i + 1]], np.frombuffer(at, np.int32), np.frombuffer(end, np.int32)
                kept, last = hashlib.sha256(), 0
                for s, e in zip(at.tolist(), end.tolist(), strict=True):
                    kept.update(own[last:s].tobytes())
                    last = e
                kept.update(own[last:].tobytes())
                removed.append(int((end - at).sum()))
                number.append(len(at))
                digests.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(removed, pa.int64()), pa.array(number, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "key", "n_removed", "n_spans", "kept"],
            )

    cut = texts.mapInArrow(run, "doc_id long, key long, n_removed long, n_spans long, kept string").dropDuplicates(["doc_id", "key"])
    whole = docs.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    return whole.join(cut, ["doc_id", "key"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept", "whole").alias("kept_sha256"),
    )
