"""Toxicity: a bidirectional gated recurrent network with attention pooling over characters and words, in numpy."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffles_deleted
from .textops import ODD, PLAIN, U, buffers, groups, mix, pieces, prefix_hash, span_hash, word_spans

#: Words of a window and the step from one to the next.
WINDOW, STEP = 32, 24
HIDDEN, EMBEDDED, TABLE_SIZE = 8, 6, 4096
#: Labelled documents of each class that are read, whole, for term odds, and again as many for the network. Scoring has no
#: such bound.
PER_CLASS = 1200
CUT = 0.7
#: Log odds below which a term is left out.
LEAST = 0.7
F32 = np.float32


def held_out(doc_id: Column) -> Column:
    return _part(doc_id) == 1


def _part(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3


def _gram_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 4- to 6-byte strings of words, their edges marked, and the word of each."""
    length = ends - starts
    edged = np.full(int(length.sum()) + 2 * len(length), 0x01, np.uint8)
    begin = np.cumsum(length + 2) - (length + 2)
    index = np.repeat(starts - (np.cumsum(length) - length), length) + np.arange(length.sum())
    where = np.repeat(begin + 1 - (np.cumsum(length) - length), length) + np.arange(length.sum())
    edged[where] = data[index]
    edged[begin + length + 1] = 0x02
    prefix = prefix_hash(edged)
    hashes, owner = [], []
    for n in (4, 5, 6):
        count = np.maximum(length + 2 - n + 1, 0)
        word = np.repeat(np.arange(len(length)), count)
        at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        hashes.append(span_hash(prefix, at, at + n))
        owner.append(word)
    return np.concatenate(hashes), np.concatenate(owner)


@dataclass
class Odds:
    """Log odds of terms by the documents of either class that hold them, shrunk towards 0; sorted by hash. Terms that
    say little (LEAST) are left out. filled: which leading 20 bits of a hash any term has."""

    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0, F32))
    filled: np.ndarray = field(default_factory=lambda: np.zeros(1 << 20, bool))

    @classmethod
    def of(cls, seen: list[np.ndarray], labels: np.ndarray) -> Odds:
        if not seen:
            return cls()
        terms, place = np.unique(np.concatenate(seen), return_inverse=True)
        label = np.repeat(labels, [len(s) for s in seen])
        a, b = np.bincount(place, label == 1, len(terms)), np.bincount(place, label == 0, len(terms))
        n, m = max(1, (labels == 1).sum()), max(1, (labels == 0).sum())
        share = (a + b) / (n + m)
        value = np.log((a + 4 * share + 0.1) / (n + 4)) - np.log((b + 4 * share + 0.1) / (m + 4))
        keep = ((a + b) > 1) & (np.abs(value) >= LEAST)
        filled = np.zeros(1 << 20, bool)
        filled[terms[keep] >> U(44)] = True
        return cls(terms[keep], np.clip(value[keep], -6, 6).astype(F32), filled)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), F32)
        some = np.flatnonzero(self.filled[hashes >> U(44)])
        if len(some):
            at = np.minimum(np.searchsorted(self.terms, hashes[some]), len(self.terms) - 1)
            out[some] = np.where(self.terms[at] == hashes[some], self.values[at], F32(0))
        return out


def _distinct_words(data: np.ndarray, offsets: np.ndarray):
    """starts and ends of the distinct words, the distinct word of each word, and where each row's words begin."""
    starts, ends = word_spans(data, offsets)
    hashes = span_hash(prefix_hash(data), starts, ends)
    own, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    return own, starts[first], ends[first], which, np.searchsorted(starts, offsets)


@dataclass
class Inputs:
    """What the network sees of a word: odds of the word and of its character strings, and four places in a table that is
    learned (the word, its first three and first four bytes, its last three)."""

    word: Odds
    chars: Odds

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(starts)
        if not n:
            return np.zeros((0, 4), F32), np.zeros((0, 4), np.int64)
        grams, owner = _gram_spans(data, starts, ends)
        value = self.chars(grams)
        top = np.zeros(n, F32)
        np.maximum.at(top, owner, value)
        total = np.bincount(owner, value, n) / np.maximum(np.bincount(owner, minlength=n), 1)
        fixed = np.stack([self.word(hashes), top, total.astype(F32), np.minimum(ends - starts, 20).astype(F32) / 20], 1)
        prefix = prefix_hash(data)
        places = [hashes, *(span_hash(prefix, starts, np.minimum(starts + k, ends)) for k in (3, 4)), span_hash(prefix, np.maximum(ends - 3, starts), ends) ^ ODD[30]]
        return fixed, np.stack([(mix(p) % U(TABLE_SIZE)).astype(np.int64) for p in places], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(1) / (F32(1) + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters and both directions of the recurrent network. Gates: update, reset, candidate."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        d, h = 4 + EMBEDDED, HIDDEN
        make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(F32)
        self.p = {"E": (rng.standard_normal((TABLE_SIZE, EMBEDDED)) * 0.1).astype(F32)}
        for k in "fb":
            self.p |= {f"W{k}": make(d, 3 * h), f"U{k}": make(h, 3 * h), f"c{k}": np.zeros(3 * h, F32)}
        self.p |= {"v": make(2 * h), "w": make(2 * h), "o": np.zeros(1, F32)}

    def inputs(self, fixed: np.ndarray, places: np.ndarray) -> np.ndarray:
        return np.concatenate([fixed, self.p["E"][places].mean(1)], 1)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Both directions' gate inputs of words."""
        return np.concatenate([x @ self.p["Wf"] + self.p["cf"], x @ self.p["Wb"] + self.p["cb"]], 1)

    def states(self, table: np.ndarray, index: np.ndarray, mask: np.ndarray | None, keep: bool = False):
        """Hidden states (steps, windows, both directions); index: the row of table at each place of each window."""
        n, steps = index.shape
        h = HIDDEN
        out = np.empty((steps, n, 2 * h), F32)
        saved = []
        for k, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            part = np.ascontiguousarray(table[:, : 3 * h] if k == "f" else table[:, 3 * h :])
            s = np.zeros((n, h), F32)
            for t in order:
                gx, gh = part[index[:, t]], s @ self.p[f"U{k}"]
                zr = _sigmoid(gx[:, : 2 * h] + gh[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(gx[:, 2 * h :] + r * gh[:, 2 * h :])
                new = c + z * (s - c)
                if mask is not None:
                    new = np.where(mask[:, t : t + 1], new, s)
                if keep:
                    saved.append((k, t, s, z, r, c, gh[:, 2 * h :]))
                s = new
                out[t, :, (0 if k == "f" else h) : (h if k == "f" else 2 * h)] = s
        return out, saved

    def pooled(self, states: np.ndarray, mask: np.ndarray | None):
        e = states @ self.p["v"]
        if mask is not None:
            e = np.where(mask.T, e, F32(-1e9))
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        return a, (a[:, :, None] * states).sum(0)

    def logits(self, table: np.ndarray, index: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
        return self.pooled(self.states(table, index, mask)[0], mask)[1] @ self.p["w"] + self.p["o"][0]

    def gradients(self, fixed: np.ndarray, places: np.ndarray, index: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """Of the weighted log loss, by back-propagation through time."""
        p, h = self.p, HIDDEN
        x = self.inputs(fixed, places)
        table = self.projected(x)
        states, saved = self.states(table, index, mask, True)
        a, c = self.pooled(states, mask)
        d = ((_sigmoid(c @ p["w"] + p["o"][0]) - y) * weight).astype(F32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["w"], g["o"] = c.T @ d, np.array([d.sum()], F32)
        dc = d[:, None] * p["w"]
        da = (states * dc).sum(2)
        de = a * (da - (a * da).sum(0))
        g["v"] = (de[:, :, None] * states).sum((0, 1))
        ds = a[:, :, None] * dc + de[:, :, None] * p["v"]
        dtable = np.zeros_like(table)
        carried = {"f": np.zeros((len(y), h), F32), "b": np.zeros((len(y), h), F32)}
        for k, t, s, z, r, n, ghn in reversed(saved):
            at = slice(0, h) if k == "f" else slice(h, 2 * h)
            dh = ds[t, :, at] + carried[k]
            m = mask[:, t : t + 1]
            live = np.where(m, dh, F32(0))
            dn = live * (1 - z) * (1 - n * n)
            dz = live * (s - n) * z * (1 - z)
            dr = dn * ghn * r * (1 - r)
            dgh = np.concatenate([dz, dr, dn * r], 1)
            g[f"U{k}"] += s.T @ dgh
            np.add.at(dtable[:, : 3 * h] if k == "f" else dtable[:, 3 * h :], index[:, t], np.concatenate([dz, dr, dn], 1))
            carried[k] = live * z + dgh @ p[f"U{k}"].T + np.where(m, F32(0), dh)
        dx = np.zeros_like(x)
        for k, part in (("f", dtable[:, : 3 * h]), ("b", dtable[:, 3 * h :])):
            g[f"W{k}"], g[f"c{k}"] = x.T @ part, part.sum(0)
            dx += part @ p[f"W{k}"].T
        np.add.at(g["E"], places, np.repeat(dx[:, None, 4:] / 4, 4, 1))
        return g

    def train(self, fixed, places, index, mask, y, epochs: int = 12, batch: int = 128, rate: float = 0.01, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for s in range(0, len(y), batch):
                i = order[s : s + batch]
                used, local = np.unique(index[i], return_inverse=True)
                g = self.gradients(fixed[used], places[used], local.reshape(index[i].shape), mask[i], y[i], weight[i] / len(i))
                step += 1
                for k, v in self.p.items():
                    d = g[k] + F32(1e-4) * v
                    m1[k] = 0.9 * m1[k] + 0.1 * d
                    m2[k] = 0.999 * m2[k] + 0.001 * d * d
                    v -= (rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)).astype(F32)


def _read(data: np.ndarray, offsets: np.ndarray, inputs: Inputs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """fixed and places of the distinct words of rows, the distinct word of each word, and where each row's words begin.

    Arrays of bytes are held piece by piece, so long texts cost four bytes a word and their distinct words.
    """
    own, fixed, places, which = [np.zeros(0, np.uint64)], [np.zeros((0, 4), F32)], [np.zeros((0, 4), np.int64)], [np.zeros(0, np.int32)]
    length, base = np.zeros(len(offsets) - 1, np.int64), 0
    for i, piece, edges in pieces(data, offsets):
        hashes, starts, ends, place, at = _distinct_words(piece, edges)
        f, p = inputs(piece, starts, ends, hashes)
        own.append(hashes), fixed.append(f), places.append(p), which.append((place + base).astype(np.int32))
        length[i : i + len(at) - 1] += np.diff(at)
        base += len(hashes)
    _, first, again = np.unique(np.concatenate(own), return_index=True, return_inverse=True)
    which = again.astype(np.int32)[np.concatenate(which)]
    return np.concatenate(fixed)[first], np.concatenate(places)[first], which, np.concatenate(([0], np.cumsum(length)))


def _windows(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and row of the windows of each row, STEP apart, the last one at its end."""
    n = np.diff(at)
    count = np.where(n == 0, 0, np.maximum(1, -(-(n - WINDOW) // STEP) + 1))
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.minimum(k * STEP, np.maximum(n[row] - WINDOW, 0)) + at[:-1][row], row


def _words_of(which: np.ndarray, at: np.ndarray, start: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """index (windows, WINDOW) into distinct words, and mask."""
    place = start[:, None] + np.arange(WINDOW)
    return which[np.minimum(place, len(which) - 1)], place < at[1:][row][:, None]


@dataclass
class Model:
    """A trained scorer: inputs, network and the curve from a document's largest window logit to a probability."""

    inputs: Inputs
    network: Network
    curve: tuple[float, float, float]
    empty: float

    def window_logits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fixed, places, which, at = _read(data, offsets, self.inputs)
        start, row = _windows(at)
        table = self.network.projected(self.network.inputs(fixed, places))
        out = np.zeros(len(row), F32)
        whole = start + WINDOW <= at[1:][row]
        for part, m in ((np.flatnonzero(whole), False), (np.flatnonzero(~whole), True)):
            for s in range(0, len(part), 4096):
                i = part[s : s + 4096]
                index, mask = _words_of(which, at, start[i], row[i])
                out[i] = self.network.logits(table, index, mask if m else None)
        return out, row

    def tops(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The largest window logit of each text and its number of windows; windows go on across pieces of long texts."""
        data, offsets = buffers(column)
        top, count = np.full(len(offsets) - 1, -np.inf), np.zeros(len(offsets) - 1, np.int64)
        for i, j in groups(offsets):
            logit, row = self.window_logits(PLAIN[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i])
            np.maximum.at(top, i + row, logit)
            count += np.bincount(i + row, minlength=len(count))
        return top, count

    def scores(self, column: pa.Array) -> np.ndarray:
        top, count = self.tops(column)
        a, b, c = self.curve
        known = count > 0
        score = np.full(len(top), self.empty)
        score[known] = 1 / (1 + np.exp(-np.clip(a * top[known] + b * np.log(count[known]) + c, -500, 500)))
        return score


def _fitted_curve(top: np.ndarray, count: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Penalised logistic regression by damped Newton steps on centred inputs."""
    size = np.log(np.maximum(count, 1))
    middle, width, mean = top.mean(), max(top.std(), 1e-6), size.mean()
    x = np.stack([(top - middle) / width, size - mean, np.ones(len(top))], 1)
    penalty = np.array([0.05, 1.0, 0.05])
    loss = lambda w: (np.logaddexp(0, x @ w) - y * (x @ w)).sum() + 0.5 * (penalty * w * w).sum()
    w = np.zeros(3)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.diag(penalty), x.T @ (q - y) + penalty * w)
        part = 1.0
        while part > 1e-6 and loss(w - part * step) > loss(w):
            part /= 2
        w = w - part * step
    return float(w[0] / width), float(w[1]), float(w[2] - w[0] * middle / width - w[1] * mean)


def fit(examples: list[tuple[str, int, int]]) -> Model:
    """examples: text, label, part. Part 0 gives term odds; part 2 trains the network (two thirds) and the curve.

    Labels are of documents, the network scores windows: of a toxic document the likeliest windows train as toxic,
    chosen by term odds first and by the network itself after that; of the others a likely one and any other one.
    """
    rng = np.random.default_rng(3)
    own = [e for e in examples if e[2] == 0] or examples
    data, offsets = buffers(pa.array([t for t, _, _ in own], pa.string()))
    labels = np.array([y for _, y, _ in own])
    held: list[list[np.ndarray]] = [[] for _ in own]
    strings: list[list[np.ndarray]] = [[] for _ in own]
    for i, piece, edges in pieces(PLAIN[data], offsets):
        hashes, starts, ends, which, at = _distinct_words(piece, edges)
        grams, owner = _gram_spans(piece, starts, ends)
        order = np.argsort(owner, kind="stable")
        grams, count = grams[order], np.bincount(owner, minlength=len(starts))
        begin = np.cumsum(count) - count
        for k in range(len(edges) - 1):
            words = np.unique(which[at[k] : at[k + 1]])
            held[i + k].append(hashes[words])
            strings[i + k].append(np.unique(np.concatenate([grams[begin[w] : begin[w] + count[w]] for w in words] or [grams[:0]])))
    once = lambda rows: [np.unique(np.concatenate(r)) for r in rows]
    inputs = Inputs(Odds.of(once(held), labels), Odds.of(once(strings), labels))
    empty = float(labels.mean()) if len(labels) else 0.0
    if len({e[1] for e in examples}) < 2:
        share = sum(e[1] for e in examples) / max(1, len(examples))
        return Model(inputs, Network(), (0.0, 0.0, 1000.0 * (share - 0.5)), share)

    rest = [e for e in examples if e[2] != 0] or examples
    order = rng.permutation(len(rest))
    train, check = [rest[k] for k in order[: -(-2 * len(rest) // 3)]], [rest[k] for k in order[-(-2 * len(rest) // 3) :]] or rest
    data, offsets = buffers(pa.array([t for t, _, _ in train], pa.string()))
    fixed, places, which, at = _read(PLAIN[data], offsets, inputs)
    start, row = _windows(at)
    ranges = [slice(s, s + 4096) for s in range(0, len(row), 4096)]
    windows = lambda i: _words_of(which, at, start[i], row[i])
    network = Network()
    if len(row):
        y = np.array([e[1] for e in train])[row]
        odds = np.maximum(fixed[:, 0], fixed[:, 1])
        rank = np.concatenate([np.where(mask, odds[index], -9).max(1) for index, mask in map(windows, ranges)])
        for turn in range(3):
            if turn:
                table = network.projected(network.inputs(fixed, places))
                rank = np.concatenate([network.logits(table, *windows(i)) for i in ranges])
            best = np.lexsort((-rank, row))
            nth = np.arange(len(row)) - np.searchsorted(row[best], row[best])
            random = rng.random(len(row)) < 0.15
            chosen = best[(nth == 0) | ((y[best] == 0) & ((nth == 1) | random))]
            network.train(fixed, places, *windows(chosen), y[chosen].astype(F32), epochs=10 if turn == 0 else 6, seed=turn)
    model = Model(inputs, network, (1.0, 0.0, 0.0), empty)
    top, count = model.tops(pa.array([t for t, _, _ in check], pa.string()))
    known = count > 0
    if known.any():
        model.curve = _fitted_curve(top[known], count[known], np.array([e[1] for e in check])[known])
    return model


def examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most PER_CLASS labelled documents of either class for either part, by hash order, with their whole texts; none that are held out."""
    mine = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter("toxic in (0, 1) and doc_id is not null")
    mine = mine.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))  # labels that differ: toxic
    mine = mine.withColumn("part", _part(F.col("doc_id")).cast("int")).filter("part <> 1")
    chosen = None
    for toxic in (0, 1):
        for part in (0, 2):
            some = mine.filter(f"toxic = {toxic} and part = {part}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS)
            chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # at most 4 * PER_CLASS ids are broadcast
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("toxic").cast("int"), "part")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted: one row per row of docs, from all overlapping windows of the whole text.

    A document scores as its likeliest window does, allowing for how many it has. Null and empty texts get the share of
    toxic labels in training. predicted is 1 from CUT on. An empty table gives no rows; columns besides doc_id and text
    aren't read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = held.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= CUT).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits in one task on the sample of examples(), whose size has a bound; only the model comes to the driver.

    Of a document's labels that differ the toxic one counts. Labels of one class alone
    teach nothing: then all texts score that class, and 0 without any labels.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted((r for pdf in batches for r in pdf.itertuples(index=False)), key=lambda r: (r.doc_id, r.text))
        yield pd.DataFrame({"model": [pickle.dumps(fit([(r.text, int(r.toxic), int(r.part)) for r in rows]))]})

    with shuffles_deleted(docs.sparkSession):
        made = examples(docs, labels).repartition(1).mapInPandas(run, "model binary").first()
    return pickle.loads(made[0]) if made else fit([])
