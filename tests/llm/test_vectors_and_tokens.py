"""Whitening, vector codes and token files against brute force, with awkward rows."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketloom.llm import queries, token_files, vector_codes, whitening
from marketloom.llm.vectors import kept

DIR = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
#: Extra columns have names that the operators use inside.
SCHEMA = "vec_id long, embedding array<double>, label int, n string, component string, code string, own string, i string"
INF, NAN = float("inf"), float("nan")


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, k, "n", "c", "x", "o", "i") for i, v, k in rows], SCHEMA)


def awkward(dims=6, n=40, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(c) for c in rng.normal(size=dims)], int(rng.integers(0, 3))) for i in rng.permutation(n)]
    rows[3] = (rows[2][0], rows[3][1], None)  # one id, two vectors
    rows.append(rows[5])
    bad = [None, [], [1.0] * (dims - 1) + [None], [NAN] * dims, [1.0] * (dims - 1) + [-INF], [1.0] * (dims + 1), [1e30] * dims]
    return rows + [(1000 + i, v, 1) for i, v in enumerate(bad)] + [(None, rows[0][1], None)], len(rows) + 1


def ints(rows, dims):
    good = [r for r in rows if r[1] is not None and len(r[1]) == dims and all(c is not None and abs(c) < 1 << 17 for c in r[1])]
    return good, np.array([[int(np.floor(1024 * c)) for c in r[1]] for r in good], np.int64).reshape(-1, dims)


def whitened(rows, dims, got):
    """got: one row for each vector and component, compared with an eigendecomposition of the covariance."""
    good, x = ints(rows, dims)
    x = x + 100_000
    n, sums = len(x), x.sum(0)
    apart = (n * x - sums) / n
    values, right = np.linalg.eigh(apart.T @ apart / n)
    values, right = values[::-1], right[:, ::-1]
    k = min(8, dims)
    want = apart @ right[:, :k] / np.sqrt(values[:k])
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
        assert r.n == n and abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9 and r.identity_error < 1e-10
    assert len(got) == n * k
    deviation = [sum(int(v) ** 2 for v in row) for row in n * x.astype(object) - sums]
    for c in range(k):
        mine = np.array([by[r[0], d][c + 1][0] for r, d in zip(good, deviation, strict=True)])
        assert min(np.abs(mine - s * want[:, c]).max() for s in (1, -1)) < 1e-8, c


def test_whitening_against_an_eigendecomposition(spark):
    got = queries.op11_whitening(spark, DIR).collect()
    whitened([tuple(r) for r in spark.read.parquet(f"{DIR}/embeddings.parquet").collect()], 64, got)
    for dims in (3, 11):
        rows, n = awkward(dims)
        got = whitening.whiten(vectors(spark, rows).repartition(3)).collect()
        assert len(got) == n * min(8, dims)
        whitened(rows, dims, got)


def test_whitening_without_spread(spark):
    assert whitening.whiten(vectors(spark, [(1, None, 1)])).count() == 0 and whitening.whiten(vectors(spark, [])).count() == 0
    same = whitening.whiten(vectors(spark, [(i, [1.0, 2.0], 1) for i in range(3)])).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(3, 0, None, 0.0, 0.0)} and len(same) == 6
    rng = np.random.default_rng(1)
    flat = rng.integers(-9, 9, (50, 3)) @ np.array([[1, 0, 2, 1, 0], [0, 1, 1, 0, 0], [1, 1, 0, 3, 0]])  # rank three of five
    got = whitening.whiten(vectors(spark, [(i, [float(c) for c in v], 1) for i, v in enumerate(flat)])).collect()
    assert {r.component for r in got if r.whitened is None} == {4, 5} and max(r.identity_error for r in got) < 1e-9


def test_whitening_of_ill_conditioned_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(rng.normal(size=(300, 5)) * [60000, 500, 3, 1, 0.01])]
    good, x = ints(rows, 5)
    apart = x - x.mean(0)
    _, model = whitening.fit(vectors(spark, rows))
    assert np.allclose(model.values, np.linalg.svd(apart)[1] ** 2 / len(x), rtol=1e-9, atol=1e-9) and model.passes >= 2


def test_deviation_is_exact_beyond_64_bits():
    model = whitening.Whitening(1 << 31, (5, -7), np.eye(2), np.ones(2), 2.0, 1, 1 << 60)
    got = model.from_mean(np.array([[1 << 26, -3]]))
    assert got.tolist() == [[((1 << 26) + 100_000) * (1 << 31) - 5, (100_000 - 3) * (1 << 31) + 7]]


def brute_codes(good, x, parts=4, entries=256, rounds=4):
    order = sorted(range(len(good)), key=lambda i: (good[i][0] is None, good[i][0] or 0, good[i][1]))[:entries]
    width = -(-x.shape[1] // parts)
    x = np.pad(x, ((0, 0), (0, width * parts - x.shape[1])))
    cut = [x[:, p * width : (p + 1) * width] for p in range(parts)]
    books = [c[order].copy() for c in cut]

    def assign():
        d = [((c[:, None] - b[None]) ** 2).sum(2) for c, b in zip(cut, books, strict=True)]
        return [v.argmin(1) for v in d], sum(v.min(1) for v in d)

    for _ in range(rounds):
        codes, _ = assign()
        for c, b, k in zip(cut, books, codes, strict=True):
            for e in np.unique(k):
                b[e] = c[k == e].sum(0) // (k == e).sum()
    codes, errors = assign()
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    return ["".join(f"{int(c[i]):02x}" for c in codes) for i in range(len(x))], errors.tolist(), digest


@pytest.mark.parametrize("dims", [1, 6, 8])
def test_codes_against_plain_distances(spark, dims):
    rows, n = awkward(dims, 400)
    good, x = ints(rows, dims)
    codes, errors, digest = brute_codes(good, x)
    labels = {}
    for r, e in zip(good, errors, strict=True):
        labels[r[2]] = labels.get(r[2], 0) + e
    want = sorted(((r[0], c, e, labels[r[2]], digest) for r, c, e in zip(good, codes, errors, strict=True)), key=str)
    got = vector_codes.compressed(vectors(spark, rows).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == want and len(want) == n
    assert vector_codes.compressed(vectors(spark, [])).count() == 0


def test_nearest_drops_entries_without_losing_any():
    rng = np.random.default_rng(7)
    for width in (1, 2, 5, 16, 33):
        for scale in (2, 1000, 1 << 40):  # many ties, usual ones, beyond 64 bits
            kind = object if scale > 1 << 30 else np.int64
            a, b = (rng.integers(-scale, scale + 1, (m, width)).astype(kind) for m in (90, 40))
            b[7] = b[3]
            d = ((a[:, None] - b[None]) ** 2).sum(2)
            code, error = vector_codes.nearest(vector_codes.transform(a), vector_codes.transform(b))
            assert code.tolist() == [list(r).index(min(r)) for r in d.tolist()] and error.tolist() == [min(r) for r in d.tolist()]


def test_coefficients_stand_by_sign_changes():
    for width in (2, 8, 16):
        waves = vector_codes.transform(np.eye(width, dtype=np.int64)).T
        assert [int((np.diff(np.sign(w)) != 0).sum()) for w in waves] == list(range(width))


def test_codes_come_back_as_their_entries(spark):
    rows, books = vector_codes.train(vectors(spark, awkward(8, 60)[0]))
    back = vector_codes.decode(vector_codes.encode(rows, books, keep=("embedding",)), books).collect()
    for r in back:
        apart = np.floor(np.array(r.embedding) * 1024) - np.array(r.decoded) * 1024
        assert int((apart**2).sum()) == r.error
    assert kept(vectors(spark, []))[1] == 0


TEXTS = [
    "", None, " \t\n", "plain words, twice: plain words", "don't l'été we'll 'so' it''s", "a.b.c ... !?. x!!", "12,345.67 m2 2x", "é é e ́x İstanbul ΑΣ ς straße ﬁ",
    "<|endoftext|> x<|startoftext|>y <|endoftext|>. <|", "tab\tnew\r\nline\x0b\x0c\x1c\x1f\x85\xa0 　end", "日本語 漢字。 ไทย 👍🏽👨‍👩‍👧 ½ ² ③", "x" * 3000, "&&& %%% word$$$ (word) \"word\"", "\x00 nul ﻿ bom ‍", "UPPER Mixed-case under_score e-mail@x.example",
]


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    import pyarrow as pa

    tokenizer = Tokenizer.from_file(WORDS)
    rng = random.Random(1)
    chars = "ab.,'é ́!<|>9İΣ\n-"
    texts = TEXTS + ["".join(rng.choice(chars) for _ in range(60)) for _ in range(300)]
    monkeypatch.setattr(token_files, "WORDS", 40)
    encoder = token_files.Encoder(WORDS, 2)
    for size in (1, 7, len(texts)):
        for s in range(0, len(texts), size):
            for i, ids in encoder.documents(pa.array(texts[s : s + size])):
                assert np.frombuffer(ids, "<u2").tolist() == whole(tokenizer, texts[s + i]), texts[s + i]


def test_words_that_differ_in_case_or_marks_are_encoded_once():
    import pyarrow as pa

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.calls, self.read = tokenizer, 0, 0

        def __getattr__(self, name):
            def call(texts, *args, **more):
                self.calls, self.read = self.calls + 1, self.read + sum(map(len, [texts] if isinstance(texts, str) else texts))
                return getattr(self.tokenizer, name)(texts, *args, **more)

            return call

    tokenizer = Tokenizer.from_file(WORDS)
    words = ["".join(p) for p in itertools.product(["an", "the", "tion", "ing"], repeat=5)]
    texts = [" ".join(words), " ".join(f"{w.upper()}," for w in words), " ".join(f"({w.title()}!" for w in words[:50])]
    texts += ["<|ENDOFTEXT|> X<|endoftext|>Y, <|EndOfText|>. <|endoftext|>", "J\u030c j\u030c H\u0331A T\u0308, ΑΣ. İX", *texts]
    encoder = token_files.Encoder(WORDS, 2)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    for i, ids in encoder.documents(pa.array(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == whole(tokenizer, texts[i]), texts[i]
    assert counted.read < 1.2 * len(texts[0]) and counted.calls <= 4


def test_files_against_whole_texts(spark, monkeypatch):
    tokenizer = Tokenizer.from_file(WORDS)
    long = " ".join(f"word{i % 977}, of" for i in range(400_000))  # over two pieces
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(99, long), (None, "lost words"), (None, None), (-5, "first")] + [(7, "often here")] * 300 + [(7, "another text of id seven")]
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame([(*r, "p", "i", "s") for r in rows], "doc_id long, text string, part string, ids string, start string").repartition(5)
    monkeypatch.setattr(token_files, "PART_BYTES", 4000)
    path = token_files.write(docs, WORDS, 2)
    got = sorted(((r.start, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in token_files.read_documents(spark, path).collect()), key=lambda r: r[0])
    assert sorted(((d, ids) for _, d, ids in got), key=str) == sorted(((d, whole(tokenizer, t)) for d, t in rows), key=str)
    ids = [d for _, d, _ in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert [s for s, _, _ in got] == np.append(0, np.cumsum([len(i) for _, _, i in got]))[:-1].tolist()
    assert token_files.index(spark, path).count() > 4
    every = np.concatenate([i for _, _, i in got])
    for s, e in ((0, 10), (1000, 40_000), (len(every) - 3, len(every) + 9), (5, 5)):
        assert token_files.span(spark, path, s, e).tolist() == every[s:e].tolist()
    assert token_files.read_documents(spark, token_files.write(docs.filter("false"), WORDS, 2)).count() == 0


def test_token_query(spark):
    tokenizer, start = Tokenizer.from_file(WORDS), 0
    got = {r.doc_id: r for r in queries.op13_token_files(spark, DIR).collect()}
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect())
    for doc_id, text in docs:
        ids = whole(tokenizer, text)
        assert tuple(got[doc_id]) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(docs)
