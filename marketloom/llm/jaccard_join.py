"""N-gram Jaccard join: parity sketches, a pigeonhole join of their segments per size band, exact verification.

Only what connects documents is searched. Documents that share a segment are compared with one of them, the group's
centre. The rest of a small group is compared pair by pair across components. A large group is centred anew: two of its
members differ in as many tokens as their differences from the centre do, so they are joined by leading tokens of those
differences, which leaves much smaller groups. No pair that could connect two components is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_groups, saved, scratch, sieve
from .graph import components
from .textops import LOWER, ODD, U, buffers, mix, shingles, words

#: Members of a group around a centre that are compared pair by pair; larger groups are centred anew.
SMALL = 8
#: Members of a key of such differences that are compared pair by pair, members of a group that tell which differences are
#: common in it, and pairs of a centre in one task.
LARGE = 64
#: Times that groups are centred anew. What is still large then is compared pair by pair too, and so it is as soon as that
#: takes no more than PAIRS comparisons of sketches for each distinct set of the whole input.
ROUNDS, PAIRS = 6, 16
SKETCH = "doc_id long, n_shingles long, fingerprint binary, sketch array<long>, keys array<long>"


class Bands:
    """Overlapping bands of set sizes: two sets that can be similar enough share a band.

    Band j holds sizes from g**j to g**(j+1)/t, with g = t**-2. Its sketches have p segments. Two sets of n and m tokens
    that link differ in at most k = a*(n+m) tokens, a = (1-t)/(1+t), hence in at most k segments.
    """

    def __init__(self, percent: int):
        self.t = percent / 100
        self.a = (1 - self.t) / (1 + self.t)
        self.log_g = -2 * math.log(self.t)
        self._of: dict[int, tuple[float, int, int]] = {}

    def _band(self, j: int) -> tuple[float, int, int]:
        if j not in self._of:
            top = math.exp((j + 1) * self.log_g) / self.t * (1 + 1e-9)
            weak = 0 if top < 40 else 1
            k = int(self.a * 2 * top + 1e-6)
            self._of[j] = top, weak, math.ceil((k + 1) * (1.15 if weak else 1.1)) + 2
        return self._of[j]

    def of(self, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(band, segments, weak, k) of the bands of a set of n tokens; k bounds what it and a partner there differ in.

        A segment of `weak` tokens or fewer says little and isn't used if k + 1 others are left.
        """
        top_band = int(math.floor(math.log(n) / self.log_g + 1e-9))
        for j in (top_band, top_band - 1):
            if j < 0:
                continue
            top, weak, p = self._band(j)
            if n <= top and (k := int(self.a * (n + min(n / self.t, top)) + 1e-6)):
                yield j, p, weak, k


def _segment_keys(u: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys of a sorted set of token hashes. Each token flips one bit of its segment; what is kept of a segment is the
    XOR of its set bits' hashes, so segments with the same odd bits have the same key.

    Segments are taken in order until k + 1 are strong. Of those at most k differ in a partner, which takes as many of its
    own, so both take one that is equal. A set with fewer strong ones takes all segments, empty ones too.
    """
    out = []
    for j, p, weak, k in bands.of(len(u)):
        segment = ((u >> U(32)) * U(p)) >> U(32)
        at = np.concatenate(([0], np.flatnonzero(np.diff(segment)) + 1))
        number, word = segment[at], np.bitwise_xor.reduceat(mix(u ^ ODD[50]), at)
        strong = np.diff(np.append(at, len(u))) > weak
        if (found := np.flatnonzero(strong)).size > k:
            number, word = number[found[: k + 1]], word[found[: k + 1]]
        else:
            full = np.zeros(p, np.uint64)
            full[number] = word
            number, word = np.arange(p, dtype=np.uint64), full
        out.append(mix(word + mix(number * ODD[51] + ODD[52:53] * U(j))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _fingerprint(u: np.ndarray) -> bytes:
    return np.array([mix(u ^ ODD[53]).sum(dtype=np.uint64), mix(u ^ ODD[54]).sum(dtype=np.uint64)], np.uint64).tobytes()


def _sketches(n: int, percent: int):
    bands = Bands(percent)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fingerprint", pa.binary()), ("sketch", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # copies in this task need no keys of their own
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            ids = batch.column("doc_id")
            known = ids.is_valid().to_pylist()  # rows without id are no partners
            for i, j, hashes, at in words(LOWER[data], offsets):
                sizes, prints, bits, keys = [], [], [], []
                for k in range(j - i):
                    u = np.unique(shingles(hashes[at[k] : at[k + 1]], n))
                    sizes.append(len(u))
                    if not len(u):
                        prints.append(None), bits.append(None), keys.append(None)
                        continue
                    name = _fingerprint(u)
                    prints.append(name)
                    odd = (np.bincount((u & U(255)).astype(np.intp), minlength=256) & 1).astype(np.uint8)
                    bits.append(np.packbits(odd).view(np.int64))
                    keys.append(None if name in seen or not known[i + k] else _segment_keys(u, bands).view(np.int64))
                    if known[i + k]:
                        seen.add(name)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), _lists(bits), _lists(keys)], schema=schema
                )

    return run


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    ends = np.cumsum([0] + [0 if r is None else len(r) for r in rows])
    values = [r for r in rows if r is not None and len(r)]
    mask = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)), mask=mask)


def _may_link(percent: int, x: str, y: str) -> Column:
    """What sizes and the sketches' Hamming distance leave possible: the distance bounds the symmetric difference from below."""
    distance = f"aggregate(zip_with({x}_sketch, {y}_sketch, (p, q) -> bit_count(p ^ q)), 0, (s, v) -> s + v)"
    return F.expr(
        f"100 * least({x}_n, {y}_n) >= {percent} * greatest({x}_n, {y}_n) and {100 + percent} * {distance} <= {100 - percent} * ({x}_n + {y}_n)"
    )


def _set_pairs(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[np.ndarray, np.ndarray] | None]]]:
    """Slices of rows and, for each row, the shingle sets of its two texts; None if a text isn't that of its class (a
    doc_id may stand before several texts)."""

    def sets(texts: pa.Array, names: pa.Array) -> Iterator[np.ndarray | None]:
        data, offsets = buffers(texts)
        names = names.to_pylist()
        for i, j, hashes, at in words(LOWER[data], offsets):
            for k in range(j - i):
                u = np.unique(shingles(hashes[at[k] : at[k + 1]], n))
                yield u if _fingerprint(u) == names[i + k] else None

    for batch in batches:
        for s in range(0, batch.num_rows, 512):
            part = batch.slice(s, 512)
            a = part.column("a").to_numpy(zero_copy_only=False)
            new = np.append(True, a[1:] != a[:-1])  # pairs of one centre lie together
            first = pa.array(np.flatnonzero(new))
            own = list(sets(part.column("a_text").take(first), part.column("a_print").take(first)))
            two = zip(np.cumsum(new) - 1, sets(part.column("b_text"), part.column("b_print")), strict=True)
            yield part, [None if own[k] is None or y is None else (own[k], y) for k, y in two]


def _with_texts(pairs: DataFrame, texts: DataFrame, of_a: DataFrame | None = None) -> DataFrame:
    """pairs (a, b, parts) with both texts and fingerprints, and what of_a has for a. A class a that stands in many pairs is
    salted: its pairs are dealt over `parts` tasks."""
    side = lambda s: texts.select(F.col("c").alias(s), F.col("fingerprint").alias(f"{s}_print"), F.col("text").alias(f"{s}_text"))
    left = side("a") if of_a is None else side("a").join(of_a, "a", "left")
    salts = pairs.groupBy("a").agg(F.max("parts").alias("parts"))
    salted = left.join(salts, "a").withColumn("salt", F.explode(F.expr("sequence(0L, parts - 1)"))).drop("parts")
    return pairs.join(side("b"), "b").withColumn("salt", F.expr("pmod(xxhash64(b), parts)")).join(salted, ["a", "salt"]).drop("salt")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose shingle sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, both in _set_pairs(batches, n):
            held = [
                two is not None and 100 * (same := len(np.intersect1d(*two, assume_unique=True))) >= percent * (len(two[0]) + len(two[1]) - same)
                for two in both
            ]
            kept = part.select(["a", "b"]).filter(pa.array(held, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns, names=["a", "b"])

    return _with_texts(pairs, texts).mapInArrow(run, "a long, b long").distinct()


def _prefix(x: np.ndarray, p: np.ndarray, common: np.ndarray, counts: np.ndarray, percent: int) -> tuple[bool, int, np.ndarray]:
    """(near, short, tokens): whether x links with its centre p, and leading tokens of D = x ^ p, rare ones first.

    Let x and z in p's group link and x, say, not be near; l is the size of D, a as in Bands. D_x and D_z differ in what
    x and z differ in, at most a(|x| + |z|), so they share at least o = (l_x + l_z - a(|x| + |z|)) / 2 tokens and the first
    one lies among the l - o + 1 leading tokens of each. A z that isn't near has l_z > a(|z| + |p|), which makes that at
    most `short` for x, near or not. For an x that isn't near and a near z it is at most k + 1, as l_z >= l_x - k.
    """
    d = np.setxor1d(x, p, assume_unique=True)
    n, m, low, high = len(x), len(p), 100 - percent, 100 + percent
    near = high * len(d) <= low * (n + m)
    k = low * (n + 100 * n // percent) // high
    short = min(-(-(high * len(d) + low * (n - m)) // (2 * high)), k + 1)
    rank = np.zeros(len(d), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, d), len(common) - 1)
        rank = np.where(common[at] == d, counts[at], 0)
    order = np.lexsort((d, np.isin(d, p, assume_unique=True), rank))
    return near, short, d[order[: short if near else max(short, k + 1)]]


def _token_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    tokens, counts = np.unique(np.concatenate(pdf.tokens.to_list()), return_counts=True)
    tokens, counts = tokens.view(np.uint64)[counts > 1], counts[counts > 1]
    order = np.argsort(tokens)
    return pd.DataFrame({"a": [pdf.a.iloc[0]], "common": [tokens[order].view(np.int64)], "counts": [counts[order]]})


def _centred(members: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(key, x, component, kind) for members (a: centre, b: member, size, parts, component) of large groups: keys of leading
    tokens of their differences from the centre. kind: 0 near, 1 short prefix, 2 the rest of the long one.

    About LARGE members of a group that has more tell which differences are common there; that decides only the order of
    tokens.
    """
    some = members.filter(F.expr(f"size > {LARGE} and pmod(xxhash64(a, b), size) < {LARGE}"))

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, both in _set_pairs(batches, n):
            found = [np.zeros(0, np.int64) if two is None else np.setxor1d(*two, assume_unique=True).view(np.int64) for two in both]
            yield pa.RecordBatch.from_arrays([part.column("a"), _lists(found)], names=["a", "tokens"])

    sampled = _with_texts(some.select("a", "b", "parts"), texts).mapInArrow(differences, "a long, tokens array<long>")
    common = saved(sampled.groupBy("a").applyInPandas(_token_counts, "a long, common array<long>, counts array<long>"), "jaccard-common")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, both in _set_pairs(batches, n):
            out, kinds = [], []
            common, counts = part.column("common"), part.column("counts")
            for k, (two, centre) in enumerate(zip(both, part.column("a").to_pylist(), strict=True)):
                if two is None:
                    out.append(np.zeros(0, np.int64)), kinds.append(np.zeros(0, np.int64))
                    continue
                often, times = (np.array(c[k].values if c[k].is_valid else [], np.int64) for c in (common, counts))
                near, short, tokens = _prefix(two[1], two[0], often.view(U), times, percent)
                out.append(mix(tokens + mix(np.full(1, centre, np.int64).view(U) ^ ODD[55])).view(np.int64))
                kinds.append(np.where(near, 0, np.where(np.arange(len(tokens)) < short, 1, 2)))
            yield pa.RecordBatch.from_arrays([part.column("b"), part.column("component"), _lists(out), _lists(kinds)], names=["x", "component", "keys", "kinds"])

    made = _with_texts(members.select("a", "b", "parts", "component"), texts, common)
    made = made.mapInArrow(keys, "x long, component long, keys array<long>, kinds array<long>")
    made = made.select("x", "component", F.explode(F.arrays_zip("keys", "kinds")).alias("k"))
    return made.select(F.col("k.keys").alias("key"), "x", "component", F.col("k.kinds").alias("kind"))


def _centres(rows: DataFrame) -> DataFrame:
    """(a, b, size, parts): members b of groups and their centre a, for rows (key, x). The centre of a key's rows is the
    one whose keys have most rows in all, so that groups that overlap have one centre and that lies in their midst."""
    sizes = saved(rows.groupBy("key").agg(F.count("*").alias("size"), F.min("x").alias("low"), F.max("x").alias("high")).filter("low < high").select("key", "size"), "jaccard-sizes")
    rows = saved(join_groups(rows, sizes, "key", "size"), "jaccard-rows")
    weight = rows.groupBy("x").agg(F.sum("size").alias("weight"))
    weighed = rows.join(weight, "x")
    top = weighed.groupBy("key").agg(F.expr("max(struct(weight, -x as x))").alias("top"), F.first("size").alias("size"))
    top = saved(top.select("key", (-F.col("top.x")).alias("a"), "size"), "jaccard-centres")
    members = join_groups(rows.select("key", "x"), top, "key", "size").select("a", F.col("x").alias("b")).filter("a <> b")
    members = saved(members.distinct(), "jaccard-members")
    sizes = saved(members.groupBy("a").agg(F.count("*").alias("size")), "jaccard-sizes")
    return saved(join_groups(members, sizes, "a", "size").withColumn("parts", F.expr(f"(size + {LARGE - 1}) div {LARGE}")), "jaccard-members")


def _connected(rows: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """rows with the component of their class in `column`; a class without links is one of its own."""
    return rows.join(found.withColumnRenamed("node", column), column, "left").withColumn("component", F.coalesce("component", column))


def _repeated(rows: DataFrame, condition: str) -> DataFrame:
    """rows with the number of rows that their key has, of keys that meet the condition."""
    sizes = saved(rows.groupBy("key").agg(F.count("*").alias("rows"), F.expr(condition).alias("__held")).filter("__held").drop("__held"), "jaccard-sizes")
    return saved(join_groups(rows, sizes, "key", "rows"), "jaccard-tokens")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of docs.

    Words are split by ASCII white space after A-Z became lower case; a document's set is its distinct n-word shingles,
    or the whole sequence if it has fewer words. Documents link when 100 * intersection >= percent * union;
    component_id is the smallest doc_id that links lead to. Null and empty texts have n_shingles 0 and link with nothing.
    Equal sets are one class; a row without doc_id gets its class's component, but classes of such rows alone link with
    nothing. Rows that share a doc_id are judged each by its own text. An empty table gives no rows; columns besides
    doc_id and text aren't read.

    A set is known by 128 bits of hashes of its shingles, a shingle by 64.
    """
    with scratch(docs.sparkSession) as kept:
        out = saved(_near_duplicates(docs, n, percent), "jaccard-result")
        kept.append(out)
    return out


def _near_duplicates(docs: DataFrame, n: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = saved(docs.mapInArrow(_sketches(n, percent), SKETCH), "jaccard-sketches")
    named = rows.filter("fingerprint is not null")
    classes = named.groupBy("fingerprint").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("members"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = saved(classes.withColumn("c", F.monotonically_increasing_id()), "jaccard-classes")

    with scratch(spark) as kept:
        keyed = rows.filter("doc_id is not null and size(keys) > 0")
        single = keyed.select("doc_id", F.explode("keys").alias("key"))
        often = single.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("key")
        shared = saved(sieve(single, F.col("key"), saved(often, "jaccard-keys"), "key"), "jaccard-shared")
        node = keyed.select("doc_id", "fingerprint").join(classes, "fingerprint").select("doc_id", F.col("c").alias("x"))
        members = _centres(saved(shared.join(node, "doc_id").select("key", "x").distinct(), "jaccard-rows"))
        kept.append(members)

    known = members.select(F.explode(F.array("a", "b")).alias("c")).distinct().join(classes, "c")
    known = saved(known.select("c", F.col("first").alias("doc_id"), "fingerprint", "n", "sketch"), "jaccard-nodes")
    texts = sieve(docs, F.col("doc_id"), known, "doc_id").join(known.select("c", "doc_id", "fingerprint"), "doc_id")
    texts = saved(texts.withColumn("hash", F.xxhash64("text")).dropDuplicates(["doc_id", "c", "hash"]).select("c", "fingerprint", "text"), "jaccard-texts")

    def likely(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) of classes those that sizes and sketches let link."""
        for s in "ab":
            pairs = pairs.join(known.select(F.col("c").alias(s), F.col("n").alias(f"{s}_n"), F.col("sketch").alias(f"{s}_sketch")), s)
        return pairs.filter(_may_link(percent, "a", "b")).drop("a_n", "a_sketch", "b_n", "b_sketch")

    def across(groups: DataFrame, key: str, condition: str) -> DataFrame:
        """Pairs of classes of different components in groups (key, x, component, ...) that may link."""
        own = groups.join(known.select(F.col("c").alias("x"), "n", "sketch"), "x")
        a, b = (own.select(key, *[F.col(c).alias(f"{s}_{c}") for c in own.columns if c != key]) for s in "ab")
        pairs = a.join(b, key).filter("a_component < b_component").filter(condition).filter(_may_link(percent, "a", "b"))
        return pairs.select(F.least("a_x", "b_x").alias("a"), F.greatest("a_x", "b_x").alias("b")).distinct()

    total, links = classes.count(), spark.createDataFrame([], "a long, b long")
    for turn in range(ROUNDS):
        with scratch(spark) as kept:  # of a turn, links, components and the next members stay
            stars = _verified(saved(likely(members.select("a", "b", "parts")), "jaccard-stars"), texts, n, percent)
            links = links.unionByName(saved(stars, "jaccard-links"))
            found = saved(components(links), "jaccard-found")
            links = found.select(F.col("component").alias("a"), F.col("node").alias("b"))  # connects what links did
            placed = saved(_connected(members, found, "b"), "jaccard-placed")
            several = placed.groupBy("a").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("rows")).filter("low < high")
            apart = saved(join_groups(placed, saved(several.select("a", "rows"), "jaccard-sizes"), "a", "rows"), "jaccard-apart")
            more, large = across(apart.filter(f"size <= {SMALL}").select("a", F.col("b").alias("x"), "component"), "a", "true"), apart.filter(f"size > {SMALL}")
            many = None
            if not large.isEmpty():
                several = "min(if(kind = 1, component, null)) < max(if(kind = 1, component, null)) or min(kind) = 0 and max(kind) > 0 and min(component) < max(component)"
                tokens = _repeated(saved(_centred(large, texts, n, percent), "jaccard-tokens"), several)
                left = tokens.filter(f"rows > {LARGE}").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
                last = turn == ROUNDS - 1 or left <= PAIRS * total  # pairs in proportion to the input
                few = tokens if last else tokens.filter(f"rows <= {LARGE}")
                more = more.unionByName(across(few.drop("rows"), "key", "a_kind * b_kind < 2 and a_kind + b_kind > 0")).distinct()
                many = None if last else tokens.filter(f"rows > {LARGE}").select("key", "x")
            more = saved(more.withColumn("parts", F.lit(1).cast("long")), "jaccard-pairs")
            new = saved(_verified(more, texts, n, percent), "jaccard-links")
            links = links.unionByName(new)
            kept += [found, new]
            if many is None or many.isEmpty():
                break
            members = _centres(many)
            kept.append(members)
    if not new.isEmpty():
        with scratch(spark) as kept:
            found = saved(components(links), "jaccard-found")
            kept.append(found)

    of_class = saved(_connected(classes.select("c", "fingerprint", "first", "members"), found, "c"), "jaccard-components")
    lowest = of_class.groupBy("component").agg(F.min("first").alias("component_id"), F.count("*").alias("size"))
    of_class = saved(join_groups(of_class, saved(lowest, "jaccard-components"), "component", "size"), "jaccard-components")
    known = join_groups(named.select("doc_id", "n_shingles", "fingerprint"), of_class.select("fingerprint", "members", "component_id"), "fingerprint", "members")
    empty = rows.filter("fingerprint is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return known.select("doc_id", "n_shingles", "component_id").unionByName(empty)
