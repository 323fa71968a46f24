"""The pipeline against brute force, with null and repeated ids."""

import hashlib
import json
import random
import time
import zlib
from collections import Counter, defaultdict

import pyarrow as pa

import corpus_pipeline
from marketloom.llm import common, graph, jaccard_join, mixing, textops, toxicity
from marketloom.llm.common import CLEANUP, saved
from marketloom.llm.jaccard_join import near_duplicates
from marketloom.llm.queries import MIX

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BAD = ["idiot", "moron", "trash"]


def tables(spark, path):
    """Rows with null, unique and repeated ids, each kind with clean, toxic, copied and contaminated texts."""
    rng = random.Random(12)
    say = lambda n: " ".join(f"wo{rng.randrange(900)}rd" for _ in range(n))

    def toxic(n):
        words = say(n).split()
        for _ in range(6):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        return " ".join(words)

    item = f"{say(14)}.\n{say(8)}."
    texts = [(i, toxic(60) if i % 3 == 0 else say(60)) for i in range(300)]
    copied = [say(80) for _ in range(8)]
    texts += [(400, copied[0]), (None, copied[0]), (399, copied[0] + " end"), (None, copied[1]), (None, copied[1]), (500, copied[2]), (500, copied[2]), (500, say(50))]
    texts += [(501, say(50 + i)) for i in range(5)] + [(502, toxic(50)), (502, say(50)), (502, f"{say(30)} {item} {say(30)}"), (502, say(45))]
    texts += [(None, say(40 + i)) for i in range(12)] + [(None, toxic(50)), (None, f"{say(20)} {item} {say(20)}"), (503, copied[3]), (504, copied[3]), (503, copied[3]), (None, None), (505, "")]
    number = lambda t: zlib.crc32((t or "").encode())
    docs = [(i, t, ["en", "de"][number(t) % 2], f"src{number(t) // 2 % 6}" if number(t) % 11 else None, len(t or "")) for i, t in texts]
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i % 3 == 0)) for i in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs, item


def without_copies(docs):
    sets, group = [], list(range(len(docs)))
    for d in docs:
        w = (d[1] or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    for i in range(len(docs)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if same and 100 * same >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for d, g in zip(docs, group, strict=True):
        if g not in best or (d[0] is None, d[0] or 0) < (best[g][0] is None, best[g][0] or 0):
            best[g] = d
    return list(best.values())


def mixed(spark, docs):
    """Times that each row is read: whole epochs, then the start of one more in the order of md5."""
    leaves = defaultdict(list)
    for d in docs:
        source = d[3] or ""
        domain = f"d{int(source[3:]) % 4}" if source else "d0"
        leaves[domain, d[2] or "", source].append((d, len((d[1] or "").split())))
    have = [(*k, sum(n for _, n in v)) for k, v in leaves.items()]
    budget = {tuple(r[c] for c in mixing.LEAF): (r.have, r.budget) for r in mixing.budgets(spark.createDataFrame(have, "domain string, lang string, source string, have long"), MIX).collect()}
    out = Counter()
    for leaf, rows in leaves.items():
        whole, rest = divmod(budget[leaf][1], budget[leaf][0])
        key = lambda x: (hashlib.md5(f"{MIX.seed}:{whole}:{'null' if x[0][0] is None else x[0][0]}".encode()).hexdigest(), x[1])  # noqa: E731, B023
        for d, _ in rows:
            out[d] += whole
        for d, n in sorted(rows, key=key):
            if n > rest:
                break
            rest -= n
            out[d] += rest >= 0 and budget[leaf][1] % budget[leaf][0] > 0
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    path = str(tmp_path)
    docs, item = tables(spark, path)
    read = lambda name: spark.read.parquet(f"{path}/{name}.parquet")
    scores = toxicity.train(read("documents"), read("labels")).scores(pa.array([d[1] for d in docs], pa.string()))
    kept = [d for d, s in zip(docs, scores, strict=True) if s < toxicity.CUT]
    assert {d[0] for d in docs if d not in kept} >= {502, None}
    kept = without_copies(kept)
    kept = [d for d in kept if item not in (d[1] or "")]
    ids = Counter(d[0] for d in kept)
    assert (ids[399], ids[400], ids[500], ids[501], ids[502], ids[503], ids[504]) == (1, 0, 2, 5, 2, 1, 0) and ids[None] >= 13

    at = read("documents")
    for name, stage in corpus_pipeline.STAGES[:3]:
        at = saved(stage(spark, at, path), "test-stage")
    key = lambda d: json.dumps(d)
    assert sorted(key(tuple(r)) for r in at.collect()) == sorted(map(key, kept))

    want = Counter()
    for d, n in mixed(spark, kept).items():
        want[d[0], zlib.crc32((d[1] or "").encode())] += n
    made = corpus_pipeline.run(spark, path).collect()
    assert Counter((r.doc_id, r.text_crc32) for r in made) == +want
    assert max(n for (i, _), n in want.items() if i is None) > 0 and max(want.values()) > 1
    for shard in {r.shard for r in made}:
        own = sorted(r.slot for r in made if r.shard == shard)
        assert own == list(range(len(own)))


def test_a_job_of_many_queries_leaves_no_shuffle_files(spark):
    """All that near_duplicates runs is done when it returns, so its shuffles must not wait for the driver's garbage."""
    blocks = lambda: {b for b in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}
    setting, before = spark.conf.get(CLEANUP, None), blocks()
    docs = spark.createDataFrame([(i, f"one two three four five six seven eight nine {i // 2}") for i in range(40)], "doc_id long, text string")
    assert near_duplicates(docs).count() == 40
    assert spark.conf.get(CLEANUP, None) == setting
    until = time.time() + 20
    while (left := len(blocks() - before)) > 8 and time.time() < until:
        time.sleep(0.2)
    assert left <= 8, left  # those of the count here


def test_training_leaves_no_shuffle_files(spark):
    blocks = lambda: {b for b in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}
    before = blocks()
    docs = spark.createDataFrame([(i, f"text {BAD[i % 3] if i % 2 else 'fine'} {i}") for i in range(60)], "doc_id long, text string")
    toxicity.train(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    until = time.time() + 20
    while (left := blocks() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_the_join_deletes_tables_that_nothing_reads_any_more(spark, monkeypatch):
    """Each has as many files as there are partitions, whatever its rows, so they must not pile up until the end."""
    before, most = list(common._written), []

    def watched(*args):
        out = saved(*args)
        most.append(len(set(common._written) - set(before)))
        return out

    monkeypatch.setattr(jaccard_join, "saved", watched)
    monkeypatch.setattr(graph, "saved", watched)
    chain = lambda k: " ".join(f"w{i}" for i in range(k, k + 60))
    docs = spark.createDataFrame([(i, chain(i)) for i in range(30)] + [(100 + i, chain(500 + 200 * (i // 2))) for i in range(20)], "doc_id long, text string")
    made = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert made == {i: 0 for i in range(30)} | {100 + i: 100 + i // 2 * 2 for i in range(20)}
    assert len(most) > 20 and max(most) <= 18, (len(most), max(most))


def test_components_stop_at_stars(spark, monkeypatch):
    """The chain takes steps, the stars none; a step's edges are gone when the next ones are there."""
    names = []
    monkeypatch.setattr(graph, "saved", lambda df, name: names.append(df := saved(df, name)) or df)
    stars = spark.createDataFrame([(1, 2), (1, 3), (4, 9), (7, 7)], "a long, b long")
    assert {r.node: r.component for r in graph.components(stars).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 9: 4}
    assert len(names) == 1
    chain = spark.createDataFrame([(i + 1, i) for i in range(40)], "a long, b long")
    assert {r.node: r.component for r in graph.components(chain).collect()} == dict.fromkeys(range(41), 0)
    assert len(names) > 2 and sum(df._scratch in common._written for df in names) == 2
    assert {*graph.components(stars.limit(0)).collect()} == set()


def test_the_driver_plans_few_joins_for_a_mixture(spark):
    """Joins of small tables become broadcasts, which the driver builds and holds."""
    docs = spark.createDataFrame([(i, "some words " * (i % 7), "en", f"src{i % 5}", 0) for i in range(60)], SCHEMA)
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    leaves = spark.createDataFrame([("d0", "en", "src0", 9)], "domain string, lang string, source string, have long")
    assert (joins(mixing.mixture(docs, MIX)), joins(mixing.budgets(leaves, MIX))) == (2, 2)


def test_few_texts_need_no_large_tables(monkeypatch):
    """The driver hashes the benchmark's items."""
    monkeypatch.setattr(textops, "_powers", {})
    up, down = textops.powers(100)
    assert up.nbytes + down.nbytes <= 2 << 20
    more, _ = textops.powers(textops.SHORT + 1)
    assert len(more) > textops.PIECE and (more[: len(up)] == up).all() and set((up * down).tolist()) == {1}
