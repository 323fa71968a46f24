"""Benchmark decontamination: a BM25 index of test items, every passage a query by block-max WAND, overlap verified."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .textops import PLAIN, buffers, shingles, words

#: Bytes of item texts in one index, so that what is broadcast has a bound (one longer item is an index of its own); more
#: items are searched index by index, all with the statistics of all items.
INDEX_BYTES = 8 << 20
#: Items whose largest impacts are kept together, and blocks that are bounded together before they are bounded one by one.
BLOCK, SUPER = 4, 16
#: Pairs of passage and block that are bounded at once.
BOUNDED = 1 << 21
K1, B = 1.2, 0.75
#: Words of a shingle in the overlap check, and the share of shingles of question and answer that must be there.
SHINGLE, OVERLAP = 5, 0.8
#: Share of an item's own BM25 score that a passage must reach.
THRESHOLD = 0.6
HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def question_answer(text: str) -> tuple[str, str]:
    """The last line, or else the last sentence, or else the last third of the words is the answer."""
    head, _, tail = text.rstrip().rpartition("\n")
    if head.strip() and tail.strip():
        return head, tail
    if m := re.match(r"(?s)(.*[.!?])\s+(\S.*)", text.rstrip()):
        return m[1], m[2]
    own = text.split()
    cut = len(own) - max(1, len(own) // 3)
    return " ".join(own[:cut]), " ".join(own[cut:])


def _hashes(texts: list[str]) -> list[np.ndarray]:
    data, offsets = buffers(pa.array(texts, pa.string()))
    out: list[np.ndarray] = []
    for i, j, hashes, at in words(PLAIN[data], offsets):
        out += [hashes[at[k] : at[k + 1]] for k in range(j - i)]
    return out + [np.zeros(0, np.uint64)] * (len(texts) - len(out))


@dataclass(frozen=True)
class Statistics:
    """What BM25 needs of all items: their number, mean number of words, and the items that hold each term."""

    n_items: int
    mean_words: float
    items_with: Mapping[int, int]

    @classmethod
    def of(cls, texts: list[str]) -> Statistics:
        own = [h for h in _hashes(texts) if len(h)]
        lengths = [len(h) for h in own]
        held = Counter(t for h in own for t in np.unique(h).tolist())
        return cls(len(own), sum(lengths) / max(1, len(own)), held)


def stride_of(n_words: int) -> int:
    """The stride of passages for an item: the power of two that its words fit in, 64 at least. It depends on no other item."""
    return max(64, 1 << max(0, n_words - 1).bit_length())


@dataclass
class Tops:
    """The largest impact of each term in each block that holds it, term after term: term t has places first[t] to
    first[t + 1] of block and top."""

    first: np.ndarray
    block: np.ndarray
    top: np.ndarray

    @classmethod
    def of(cls, postings: list[tuple[np.ndarray, np.ndarray]], width: int) -> Tops:
        first, blocks, tops = [0], [], []
        for items, impacts in postings:
            own, begin = np.unique(items // width, return_index=True)
            blocks.append(own.astype(np.int32))
            tops.append(np.nextafter(np.maximum.reduceat(impacts, begin).astype(np.float32), np.float32(2)))
            first.append(first[-1] + len(own))
        empty = [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
        return cls(np.array(first), np.concatenate(blocks or empty[0]), np.concatenate(tops or empty[1]))

    def of_term(self, t: int) -> dict[int, float]:
        at = slice(self.first[t], self.first[t + 1])
        return dict(zip(self.block[at].tolist(), self.top[at].tolist(), strict=True))

    def hopeful(self, passage: np.ndarray, term: np.ndarray, n_blocks: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block) whose terms' largest impacts reach the threshold in sum. passage must be sorted."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        count = self.first[term + 1] - self.first[term]
        through = np.cumsum(count)
        s = 0
        while s < len(term):
            e = int(np.searchsorted(through, (through[s - 1] if s else 0) + BOUNDED, "right"))
            e = int(np.searchsorted(passage, passage[min(max(e, s + 1), len(term)) - 1], "right"))  # no passage is cut
            n, low = count[s:e], passage[s]
            at = np.repeat(self.first[term[s:e]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            key, span = (np.repeat(passage[s:e], n) - low) * n_blocks + self.block[at], (passage[e - 1] - low + 1) * n_blocks
            if span <= 4 * BOUNDED:
                held = np.flatnonzero(np.bincount(key, self.top[at], span) >= threshold - 1e-4)
            else:
                key, place = np.unique(key, return_inverse=True)
                held = key[np.bincount(place, self.top[at], len(key)) >= threshold - 1e-4]
            found.append((held // n_blocks + low, held % n_blocks))
            s = e
        return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (passage[:0], passage[:0])


@dataclass
class Index:
    """Postings of items of one stride in the order of their own scores, with each block's largest impact.

    An impact is a term's BM25 weight in an item over the item's own score, so the score of a passage (its distinct
    terms) lies between 0 and 1 and one threshold fits all items.
    """

    ids: np.ndarray
    terms: np.ndarray
    postings: list[tuple[np.ndarray, np.ndarray]]
    blocks: Tops
    supers: Tops
    stride: int
    #: Shingles of question and answer, and the words of a shingle: SHINGLE, or all words of a shorter part.
    parts: list[list[np.ndarray]]
    sizes: list[list[int]]

    @classmethod
    def by_stride(cls, items: list[tuple[int, str]], every: Statistics) -> list[Index]:
        """An index for the items of each stride."""
        of: dict[int, list[tuple[int, str]]] = {}
        for item, h in zip(items, _hashes([t for _, t in items]), strict=True):
            of.setdefault(stride_of(len(h)), []).append(item)
        return [cls.build(some, every) for _, some in sorted(of.items())]

    @classmethod
    def build(cls, items: list[tuple[int, str]], every: Statistics | None = None) -> Index:
        """The index of some items with the statistics of all; without any, of these. Its stride is that of the longest."""
        every = Statistics.of([t for _, t in items]) if every is None else every
        own = _hashes([t for _, t in items])
        keep = [k for k in range(len(items)) if len(own[k])]
        items, own = [items[k] for k in keep], [own[k] for k in keep]
        counted = [np.unique(h, return_counts=True) for h in own]
        weights = []
        for (terms, tf), h in zip(counted, own, strict=True):
            held = np.array([every.items_with[t] for t in terms.tolist()])
            idf = np.log(1 + (every.n_items - held + 0.5) / (held + 0.5))
            weights.append(idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(h) / every.mean_words)))
        order = sorted(range(len(items)), key=lambda k: (weights[k].sum(), items[k][0]))
        items, own, counted, weights = ([x[k] for k in order] for x in (items, own, counted, weights))
        vocabulary = np.unique(np.concatenate([c[0] for c in counted] or [np.zeros(0, np.uint64)]))
        lists: list[list[tuple[int, float]]] = [[] for _ in vocabulary]
        for k, ((terms, _), w) in enumerate(zip(counted, weights, strict=True)):
            for t, x in zip(np.searchsorted(vocabulary, terms).tolist(), (w / w.sum()).tolist(), strict=True):
                lists[t].append((k, x))
        postings = [(np.array([k for k, _ in p], np.int32), np.array([x for _, x in p])) for p in lists]
        halves = [_hashes(list(question_answer(t))) for _, t in items]
        sizes = [[min(SHINGLE, max(1, len(h))) for h in pair] for pair in halves]
        parts = [[np.unique(shingles(h, n)) for h, n in zip(pair, size, strict=True)] for pair, size in zip(halves, sizes, strict=True)]
        ids = np.array([i for i, _ in items], np.int64)
        return cls(ids, vocabulary, postings, Tops.of(postings, BLOCK), Tops.of(postings, BLOCK * SUPER), stride_of(max(map(len, own), default=0)), parts, sizes)

    def hopeful(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block) that may hold items over the threshold, bounded by super-blocks first."""
        n_blocks = -(-len(self.ids) // BLOCK)
        n_supers = -(-n_blocks // SUPER)
        some, supers = self.supers.hopeful(passage, term, n_supers, threshold)
        count = int(passage[-1]) + 1 if len(passage) else 0
        hope = np.zeros((count, n_supers), bool)
        hope[some, supers] = True
        left = hope.any(1)[passage]
        passage, block = self.blocks.hopeful(passage[left], term[left], n_blocks, threshold)
        inside = hope[passage, block // SUPER]
        return passage[inside], block[inside]

    def wand(self, terms: np.ndarray, blocks: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Items (by place) that score the threshold or more for a set of terms, in the blocks that are left.

        Cursors stand at each term's next item. The pivot is the first item that the terms up to it can lift over the
        threshold by their largest impacts; if its block's largest impacts can't, all cursors go on to the next block.
        """
        ends = len(self.ids)
        open_block = np.zeros(ends // BLOCK + 1, bool)
        open_block[blocks] = True
        lists = []
        for t in terms.tolist():
            items, impacts = self.postings[t]
            inside = open_block[items // BLOCK]
            if inside.any():
                lists.append([0, items[inside].tolist(), impacts[inside].tolist(), float(impacts[inside].max()), self.blocks.of_term(t)])
        out = []
        at = lambda x: x[1][x[0]] if x[0] < len(x[1]) else ends
        while True:
            lists = sorted((x for x in lists if x[0] < len(x[1])), key=at)
            bound, pivot = 0.0, -1
            for k, x in enumerate(lists):
                bound += x[3]
                if bound >= threshold - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                return out
            item = at(lists[pivot])
            here = [x for x in lists if at(x) <= item]
            block = item // BLOCK
            if sum(x[4].get(block, 0.0) for x in here) < threshold - 1e-9:
                onward = min([(block + 1) * BLOCK, *(at(x) for x in lists if at(x) > item)])
                for x in here:
                    while x[0] < len(x[1]) and at(x) < onward:
                        x[0] += 1
                continue
            if at(lists[0]) < item:
                for x in here:
                    while x[0] < len(x[1]) and at(x) < item:
                        x[0] += 1
                continue
            score = math.fsum(x[2][x[0]] for x in here)
            if score >= threshold - 1e-9:
                out.append((item, score))
            for x in here:
                x[0] += 1


def _search(index: Index, hashes: np.ndarray, at: np.ndarray, threshold: float) -> Iterator[tuple[int, int, float, float, float]]:
    """(row, item place, score, overlaps) of verified hits in the word hashes of some rows.

    A passage is two strides long, and an item no longer than its index's stride, so every stretch of an item's length lies in one.
    """
    stride = index.stride
    place = np.searchsorted(index.terms, hashes)
    place[place == len(index.terms)] = 0
    hit = np.flatnonzero(index.terms[place] == hashes) if len(index.terms) else np.zeros(0, np.int64)
    if not len(hit):
        return
    row = np.searchsorted(at, hit, "right") - 1
    first = np.concatenate(([0], np.cumsum(np.diff(at) // stride + 1)))  # number of each row's first passage
    passage = first[row] + (hit - at[row]) // stride
    earlier = (hit - at[row]) >= stride
    pair = np.unique(np.concatenate((passage, passage[earlier] - 1)) * len(index.terms) + np.concatenate((place[hit], place[hit][earlier])))
    passage, term = np.divmod(pair, len(index.terms))
    begin = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    number = np.cumsum(np.append(True, passage[1:] != passage[:-1])) - 1
    alive: dict[int, list[int]] = {}
    for p, block in zip(*(x.tolist() for x in index.hopeful(number, term, threshold)), strict=True):
        alive.setdefault(p, []).append(block)
    last = np.append(begin[1:], len(passage))
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for p, blocks in alive.items():
        found = index.wand(term[begin[p] : last[p]], np.array(blocks), threshold)
        if not found:
            continue
        nth = int(passage[begin[p]])
        r = int(np.searchsorted(first, nth, "right") - 1)
        start = at[r] + (nth - first[r]) * stride
        own = hashes[start : min(start + 2 * stride, at[r + 1])]
        sets: dict[int, np.ndarray] = {}
        for item, score in found:
            shares = []
            for part, whole in zip(index.parts[item], index.sizes[item], strict=True):
                if whole not in sets:
                    sets[whole] = np.unique(shingles(own, whole)) if len(own) >= whole else own[:0]
                shares.append(float(np.isin(part, sets[whole]).mean()) if len(part) else 1.0)
            if min(shares) >= OVERLAP:
                best[r, item] = max(best.get((r, item), (0.0, 0.0, 0.0)), (score, *shares))
    for (r, item), values in best.items():
        yield r, item, *values


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, term, n_words): a row per item with words (term null), and one per distinct word of each."""
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        blocks = batch.column("block").to_pylist()
        rows: list[tuple] = []
        for i, j, hashes, at in words(PLAIN[data], offsets):
            for k in range(j - i):
                if len(own := hashes[at[k] : at[k + 1]]):
                    rows.append((blocks[i + k], None, len(own)))
                    rows += [(blocks[i + k], t, None) for t in np.unique(own).view(np.int64).tolist()]
        columns = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["block", "term", "n_words"])


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: each document and each item that it holds.

    Words are runs of letters and digits, A-Z in lower case. Every passage of every text is a query; items that reach
    `threshold` of their own BM25 score are kept if OVERLAP of the shingles of their question and of their answer are in
    the passage. Null and empty texts hold nothing, and null or empty items are in none; items of equal text are found
    together; repeated documents give equal rows; a null doc_id stays null. Empty tables give no rows; columns besides
    the ids and texts are not read.

    Passages are as long as an item's own stride asks for, so whether an item is found depends on its text and the text
    searched; other items change its scores by BM25's statistics only, which all items share.

    The benchmark is a bounded side: indexes of INDEX_BYTES of item texts are built on the driver and broadcast, one for
    each stride, and the documents are read once for them. Scores, passages and hits are the same however items are dealt.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null and item_id is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // INDEX_BYTES))
    items = saved(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")), "benchmark-items")
    terms = saved(items.mapInArrow(_terms_of, "block int, term long, n_words long"), "benchmark-terms")
    texts = terms.filter("term is null").agg(F.count("*"), F.avg("n_words")).first()
    held = terms.filter("term is not null").groupBy("block", "term").agg(F.count("*").alias("n"))
    held = saved(held.withColumn("n", F.expr("sum(n) over (partition by term)")), "benchmark-held")
    out = []
    for k in range(blocks):
        some = [tuple(r) for r in items.filter(F.col("block") == k).select("item_id", "text").collect()]
        own = held.filter(F.col("block") == k).select("term", "n").toPandas()
        items_with = dict(zip(own.term.to_numpy(np.int64).view(np.uint64).tolist(), own.n.tolist(), strict=True))
        indexes = spark.sparkContext.broadcast(Index.by_stride(some, Statistics(texts[0], texts[1] or 0.0, items_with)))

        def run(batches: Iterator[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = buffers(batch.column("text"))
                ids = batch.column("doc_id").to_pylist()
                rows = []
                for i, _, hashes, at in words(PLAIN[data], offsets):
                    for index in indexes.value:
                        rows += [(ids[i + r], int(index.ids[item]), *values) for r, item, *values in _search(index, hashes, at, threshold)]
                names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
                types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        out.append(docs.mapInArrow(run, HITS))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found
