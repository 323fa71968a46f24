"""Corpus operators against brute force, round trips and awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketloom.llm import chat, decontaminate, exact_dedup, jaccard_join, mixing, pii, repeats, secrets, sharding, toxicity
from marketloom.llm.graph import components

SCHEMA = "doc_id long, text string, lang string, source string, h string, size string, key string"
DIR = "/root/testdata/sf0.001"


def frame(spark, texts, start=0):
    """documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(start + i, t, "en", f"src{i % 5}", "h", "s", "k") for i, t in enumerate(texts)], SCHEMA)


def awkward(spark):
    word = random.Random(1)
    long = " ".join(word.choice(["alpha", "beta", "gamma", "delta"]) + str(word.randrange(9999)) for _ in range(30_000))
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "x"), (4, long), (5, long), (5, long), (6, "é" * 300), (None, "lost and found again"), (7, None), (8, "a" * 400), (9, "a" * 400)]
    return spark.createDataFrame([(i, t, None, None, "h", "s", "k") for i, t in rows], SCHEMA)


OPERATORS = {
    "exact": exact_dedup.exact_duplicates,
    "jaccard": lambda d: jaccard_join.near_duplicates(d, 4, 85),
    "mixing": lambda d: mixing.mixture(d, mixing.Mix(share=1000, epochs=2)),
    "pii": lambda d: pii.pseudonymise(d, "key1"),
    "secrets": secrets.scan,
    "sharding": lambda d: sharding.shard(d, 3),
    "repeats": repeats.without_repeats,
    "decontaminate": lambda d: decontaminate.contaminated(d, d.sparkSession.createDataFrame([(1, "one two three"), (2, None), (3, "")], "item_id long, text string")),
    "toxicity": lambda d: toxicity.score(d, toxicity.fit([("you idiot " * 9, 1, 0), ("fine day " * 9, 0, 0), ("you idiot", 1, 2), ("fine day", 0, 2)])),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_and_empty_tables(spark, name):
    docs = awkward(spark)
    n = OPERATORS[name](docs).count()
    assert name in ("decontaminate", "mixing") or n == docs.count()
    assert OPERATORS[name](docs.filter("false")).count() == 0


def test_exact_compares_bytes_where_hashes_collide(spark):
    texts = ["a", "b", "a", "c", "b", None, "", "a"]
    weak = lambda c: F.encode(F.lit("same"), "UTF-8")
    for hash_of in (exact_dedup.content_hash, weak):
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(frame(spark, texts), "largest", hash_of).collect()}
        assert got == {0: (7, 3, False), 2: (7, 3, False), 7: (7, 3, True), 1: (4, 2, False), 4: (4, 2, True), 3: (3, 1, True), 5: (6, 2, False), 6: (6, 2, True)}


def _mutated(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def test_jaccard_against_brute_force(spark):
    rng = random.Random(4)
    texts = []
    for size in (3, 5, 8, 14, 25, 60, 150, 400):
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        texts += [" ".join(_mutated(rng, base, rng.randrange(0, 1 + size // 20))) for _ in range(12)]
    for n, percent in ((4, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame(spark, texts), n, percent).collect()}
        assert got == _linked(texts, n, percent)


def _linked(texts, n, percent):
    """Number of shingles and component of each text, by comparing all pairs."""
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)})
    low = list(range(len(texts)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                a, b = root(i), root(j)
                low[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in range(len(texts))}


def test_jaccard_in_large_groups_around_the_threshold(spark, monkeypatch):
    """Groups of near copies just above and just below the threshold, and groups inside a group; centred anew repeatedly."""
    monkeypatch.setattr(jaccard_join, "LARGE", 12)
    monkeypatch.setattr(jaccard_join, "SMALL", 5)
    monkeypatch.setattr(jaccard_join, "PAIRS", 0)
    rng = random.Random(14)
    base = [f"w{rng.randrange(900)}" for _ in range(160)]
    texts = [" ".join(_mutated(rng, base, rng.randrange(0, 12))) for _ in range(300)]
    for _ in range(6):
        inner = _mutated(rng, base, 14)
        texts += [" ".join(_mutated(rng, inner, rng.randrange(0, 5))) for _ in range(25)]
    texts += [" ".join(w for w in base if rng.random() > 0.03) for _ in range(60)]
    rng.shuffle(texts)
    want = _linked(texts, 5, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame(spark, texts), 5, 80).collect()}
    assert got == want and 20 < len({c for _, c in want.values()}) < 400


def test_jaccard_prefixes_meet_where_sets_link():
    """For sets that link and are not both near their centre, a token stands in the prefixes that are compared."""
    rng = np.random.default_rng(8)
    pool = rng.integers(1, 1 << 62, 4000).astype(np.uint64)
    met = 0
    for trial in range(4000):
        percent = int(rng.choice([80, 85]))
        p = np.unique(rng.choice(pool[:200], int(rng.integers(20, 150))))
        x = np.unique(np.concatenate([p[rng.random(len(p)) > rng.choice([0.05, 0.2])], rng.choice(pool, int(rng.integers(0, 40)))]))
        z = np.unique(np.concatenate([x[rng.random(len(x)) > 0.07], rng.choice(pool, int(rng.integers(0, 9)))]))
        common, counts = np.unique(rng.choice(pool[:300], 100), return_counts=True)
        if not len(x) or not len(z) or 100 * len(np.intersect1d(x, z)) < percent * len(np.union1d(x, z)) or np.array_equal(x, z) or np.array_equal(x, p) or np.array_equal(z, p):
            continue
        (nx, sx, tx), (nz, sz, tz) = (jaccard_join._prefix(u, p, common, counts, percent) for u in (x, z))
        if nx and nz:
            continue
        short = lambda t, s: set(t[:s].tolist())
        assert (short(tx, sx) if nx or not nz else set(tx.tolist())) & (short(tz, sz) if nz or not nx else set(tz.tolist()))
        met += 1
    assert met > 300


def test_jaccard_links_a_class_whose_first_row_has_no_id(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text, "en", "s", "h", "s", "k"), (7, text, "en", "s", "h", "s", "k"), (3, text + " more", "en", "s", "h", "s", "k")]
    got = {(r.doc_id, r.component_id) for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA).coalesce(1), 5, 80).collect()}
    assert got == {(None, 3), (7, 3), (3, 3)}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, i) for i in range(101, 140)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 140), 100)}


def test_repeats_against_brute_force(spark):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ijk") for _ in range(n))
    shared = [text(60), text(49), text(50), text(200), "z" * 120]
    texts = [text(80) + rng.choice(shared) + text(30) + rng.choice(shared) + "é" + text(40) for _ in range(40)] + ["short", "", None] + shared
    seen, want = {}, {}
    raw = [(t or "").encode() for t in texts]
    for i, b in enumerate(raw):
        for s in range(len(b) - 49):
            seen.setdefault(b[s : s + 50], i)
    for i, b in enumerate(raw):
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if seen[b[s : s + 50]] < i:
                gone[s : s + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        want[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.without_repeats(frame(spark, texts).repartition(3)).collect()}
    assert got == want


def test_wand_finds_what_full_scores_find():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(5, 40)))) for i in range(90)]
    index = decontaminate.Index.build(items)
    every = np.arange(-(-len(items) // decontaminate.BLOCK))
    for _ in range(60):
        terms = np.unique(rng.integers(0, len(index.terms), 60))
        scores = Counter()
        for t in terms:
            for k, x in zip(*index.postings[t], strict=True):
                scores[int(k)] += x
        for threshold in (0.1, 0.3, 0.5):
            assert {k for k, _ in index.wand(terms, every, threshold)} == {k for k, s in scores.items() if s >= threshold - 1e-9}


def test_decontamination_finds_planted_items(spark):
    rng = random.Random(6)
    words = [f"term{i}" for i in range(2000)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, f"{say(rng.randrange(12, 40))}.\n{say(8)}.") for i in range(30)]
    texts = [say(700) for _ in range(20)] + [f"{say(rng.randrange(300))} {items[i][1].upper()} {say(rng.randrange(300))}" for i in range(30)]
    texts += [f"{say(100)} {items[i][1].split(chr(10))[0]} {say(100)}" for i in range(5)]  # the question without its answer
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, texts), benchmark).collect()}
    assert got == {(20 + i, i) for i in range(30)}


def test_decontamination_against_full_scores(spark, monkeypatch):
    """Every passage against every item in plain Python; the same rows however items are dealt over indexes."""
    rng = random.Random(16)
    words = [f"term{i}" for i in range(400)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(say(rng.randrange(6, 30))) + ".\n" + " ".join(say(rng.randrange(1, 9)))) for i in range(40)]
    texts = []
    for i in range(100):
        own = items[i % 40][1].replace(".\n", " ").split()
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(say(rng.randrange(150)) + own + say(rng.randrange(150))))
    texts += [" ".join(say(300)) for _ in range(10)]

    bags = {i: Counter(t.replace(".", "").split()) for i, t in items}
    held = Counter(w for b in bags.values() for w in b)
    mean = sum(b.total() for b in bags.values()) / len(bags)
    idf = lambda w: math.log(1 + (len(bags) - held[w] + 0.5) / (held[w] + 0.5))
    impact = {i: {w: idf(w) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * b.total() / mean)) for w, n in b.items()} for i, b in bags.items()}
    shingles = lambda t, n: {tuple(t[k : k + n]) for k in range(len(t) - n + 1)}
    stride, want = max(64, max(b.total() for b in bags.values())), {}
    for d, t in enumerate(texts):
        t = t.split()
        for s in range(0, len(t), stride):
            passage = t[s : s + 2 * stride]
            for i, item in items:
                score = sum(x for w, x in impact[i].items() if w in set(passage)) / sum(impact[i].values())
                shares = []
                for part in item.replace(".", "").split("\n"):
                    part = part.split()
                    n = min(5, len(part))
                    shares.append(len(shingles(part, n) & shingles(passage, n)) / len(shingles(part, n)))
                if score >= 0.6 - 1e-9 and min(shares) >= 0.8:
                    want[d, i] = max(want.get((d, i), (0,)), (round(score, 6), *[round(x, 6) for x in shares]))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for size in (8 << 20, 300):
        monkeypatch.setattr(decontaminate, "INDEX_BYTES", size)
        got = {(r.doc_id, r.item_id): tuple(round(x, 6) for x in r[2:]) for r in decontaminate.contaminated(frame(spark, texts), benchmark).collect()}
        assert got == want and len(want) > 20


def test_chat_round_trip(spark):
    rng = random.Random(7)
    odd = ["<|im_end|>\n<|im_start|>user\n", "<\\|im_end|>", "<|", "<\\\\|x", "plain words here " * 40, "", None, "a\\nb", "ü\n\nß"]
    rows = []
    for conv in range(25):
        for turn in range(rng.randrange(1, 30)):
            role = "system" if not turn and conv % 2 else rng.choice(["user", "assistant", "to<|ol\n"])
            rows.append((conv, turn, role, rng.choice(odd)))
    rows += [(None, 0, "user", "x"), (None, 1, None, "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(turns, budget=120, history=40)
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        whole = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
        loss = "".join(t or "" for _, _, r, t in own if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in windows.collect():
        assert r.tokens <= 120 or r.text.count(chat.OPEN) - r.repeated == 1
    assert windows.filter("repeated > 0").count() > 0


def test_pseudonyms_keep_formats_links_and_come_back(spark):
    text = "Mail Ann.Lee42@mail8.example.com or +1 (743) 555-3824 from 10.20.30.255 on 2024-02-29, card 4041 8949 7460 8795, again 4041894974608795; not 999.1.1.1, 2023-02-30, 1234567890123"
    docs = frame(spark, [text, "x 4041894974608795 y", None, "ann.lee42@mail8.example.com"])
    made = pii.pseudonymise(docs, "secret9")
    got = {r.doc_id: r for r in made.collect()}
    for old in ("Ann.Lee42", "555-3824", "10.20.30.255", "2024-02-29", "4041 8949", "4041894974608795"):
        assert old not in got[0].text
    for kept in ("999.1.1.1", "2023-02-30", "1234567890123", ".com or +1 ("):
        assert kept in got[0].text
    card = got[1].text.split()[1]
    assert card in got[0].text and got[0].n_card == 2 and got[2].text is None
    value = [int(c) for c in card[::-1]]
    assert (sum(value[::2]) + sum(2 * v - 9 * (v > 4) for v in value[1::2])) % 10 == 0
    back = {r.doc_id: r.text for r in pii.pseudonymise(made, "secret9", back=True).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}


def test_phones_of_all_area_codes(spark):
    phones = ["+1 (017) 555-7713", "+1 (199) 055-0001", "+1 (743) 155-3824", "(000) 000-0000", "+1 (743) 555-3824", "999-999-9999", "100.200.3000"]
    docs = frame(spark, [f"call {p} now" for p in phones])
    made = pii.pseudonymise(docs, "secret9")
    got = {r.doc_id: r for r in made.collect()}
    for i, old in enumerate(phones):
        new = got[i].text[5:-4]
        assert got[i].n_phone == 1 and new != old and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", old)
        for part in (-10, -7):
            assert (re.sub(r"\D", "", new)[part] >= "2") == (re.sub(r"\D", "", old)[part] >= "2")
    assert {r.doc_id: r.text for r in pii.pseudonymise(made, "secret9", back=True).collect()} == {r.doc_id: r.text for r in docs.collect()}


def test_secret_spans_against_re(spark):
    texts = ["token: abcdefgh password=x1 PASSWORD = 'hunter22'", "secret: token: abcdefgh", "é AKIA" + "A1" * 9 + " AKIA12", "ab" * 12 + " " + "0f" * 30 + "g", None, "api_key=\"sk/+=._-1\" apikey:123456 é"]
    got = {r.doc_id: {(s.kind, s.start, s.end) for s in r.spans} for r in secrets.scan(frame(spark, texts)).collect()}
    plain = {"assign": re.compile(r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}
    for i, t in enumerate(texts):
        want = set()
        for kind, p in plain.items():
            for m in p.finditer(t or ""):
                if (len(m[2]) if kind == "assign" else len(m[0])) >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                    want.add((kind, m.start(), m.end()))
        assert got[i] == want
    assert secrets.trigram_query("[0-9a-f]{24,}") is None and secrets.trigrams(secrets.trigram_query("AKIA[A-Z0-9]+")) == {"aki", "kia"}


def test_sharding_laws(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    placed = sharding.shard(docs, 8, str(tmp_path)).toPandas()
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in placed.itertuples()} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in texts.items()}
    for _, own in placed.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    sizes = placed.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= placed["size"].max()
    assert placed.groupby("virtual_slot").shard.nunique().max() == 1 and set(placed.map_version) == {0}
    old = {r.virtual_slot: r.shard for r in sharding.load_map(spark, str(tmp_path), 0).collect()}
    assert {r.virtual_slot: r.shard for r in placed.itertuples()}.items() <= old.items()

    # one more shard: the stored map is edited, few slots move
    again = sharding.shard(docs, 9, str(tmp_path)).toPandas()
    new = {r.virtual_slot: r.shard for r in sharding.load_map(spark, str(tmp_path), 1).collect()}
    load = placed.groupby("virtual_slot")["size"].sum().to_dict()
    moved = [s for s in new if new[s] != old[s]]
    after = again.groupby("shard")["size"].sum()
    assert set(again.map_version) == {1} and {new[s] for s in moved} >= {8} and len(moved) < 0.3 * len(load) and after.max() <= 1.3 * after.sum() / 9
    with pytest.raises(Exception, match="exists"):
        sharding.store_map(spark, new, str(tmp_path), 1)


def test_sharding_spreads_rows_that_repeat(spark):
    rows = [(None, None, "en", "s", "h", "s", "k")] * 3000 + [(7, "x" * 50, "en", "s", "h", "s", "k")] * 500 + [(i, "y" * (i % 90), "en", "s", "h", "s", "k") for i in range(2000)]
    placed = sharding.shard(spark.createDataFrame(rows, SCHEMA), 4).toPandas()
    sizes = placed.groupby("shard")["size"].sum()
    assert len(placed) == len(rows) and sizes.max() - sizes.min() <= 200
    for _, own in placed.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))


def test_chat_keeps_history_by_tokens_alone(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", "w") for k in range(400)] + [(1, 400, "user", "long " * 400), (1, 401, "assistant", "w")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    repeated = [r.repeated for r in chat.format_windows(turns, budget=2000, history=1000).collect()]
    assert max(repeated) == 200  # five tokens a turn


def test_more_trigrams_than_a_long_has_bits(spark):
    rules = [secrets.Rule(f"r{i}", f"key{i:02d}zq[a-z]+", 1) for i in range(30)]
    texts = [f"x key{i:02d}zqabc y" for i in range(30)] + ["key05zq", "zzz"]
    got = {r.doc_id: [s.kind for s in r.spans] for r in secrets.scan(frame(spark, texts), rules).collect()}
    assert got == {**{i: [f"r{i}"] for i in range(30)}, 30: [], 31: []}


def test_toxicity_labels_that_differ_or_are_absent(spark):
    docs = spark.createDataFrame([(i, f"word{i} here") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i in range(30) for y in (0, 1)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    assert {r.toxic for r in toxicity.examples(docs, labels).collect()} == {1}
    model = toxicity.train(docs, labels.filter("false"))
    assert model.scores(pa.array(["any text", "", None])).max() < 1e-9


def test_toxicity_scores_every_window(spark):
    """The largest logit of the windows, one step after the other in plain numpy."""
    rng = random.Random(3)
    doc = lambda bad: " ".join(rng.choice(["idiot", "moron"]) if bad and rng.random() < 0.1 else f"wo{rng.randrange(300)}rd" for _ in range(90))
    model = toxicity.fit([(doc(i % 2), i % 2, 2 * (i // 2 % 2)) for i in range(200)])
    net, p = model.network, model.network.p
    sig = lambda x: 1 / (1 + np.exp(-x))
    for text in [doc(1), doc(0), "short one", " ".join(doc(0) for _ in range(3))]:
        words = text.split()
        logits = []
        for s in sorted({min(k, max(0, len(words) - 32)) for k in range(0, max(1, len(words) - 32 + 24), 24)}):
            own = words[s : s + 32]
            data = np.frombuffer(" ".join(own).encode(), np.uint8)
            starts, ends = toxicity.word_spans(data, np.array([0, len(data)]))
            x = net.inputs(*model.inputs(data, starts, ends, toxicity.span_hash(toxicity.prefix_hash(data), starts, ends)))
            states = np.zeros((len(own), 16))
            for k, side, order in (("f", 0, range(len(own))), ("b", 8, range(len(own) - 1, -1, -1))):
                h = np.zeros(8)
                for t in order:
                    gx, gh = x[t] @ p[f"W{k}"] + p[f"c{k}"], h @ p[f"U{k}"]
                    z, r = sig(gx[:8] + gh[:8]), sig(gx[8:16] + gh[8:16])
                    h = (1 - z) * np.tanh(gx[16:] + r * gh[16:]) + z * h
                    states[t, side : side + 8] = h
            a = np.exp(states @ p["v"])
            logits.append((a / a.sum()) @ states @ p["w"] + p["o"][0])
        top, count = model.tops(pa.array([text]))
        assert count[0] == len(logits) and abs(top[0] - max(logits)) < 1e-3


def test_budgets_go_to_siblings_before_ancestors(spark):
    rows = [("a", "en", "s1", 10), ("a", "en", "s2", 1000), ("a", "de", "s3", 1000), ("b", "en", "s4", 100), ("b", "en", "s5", 5)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, have long")
    got = {r.source: r.budget for r in mixing.budgets(leaves, mixing.Mix(share=200, epochs=1)).collect()}
    assert got["s1"] == 10 and got["s4"] == 100 and got["s5"] == 5
    assert got["s1"] + got["s2"] == pytest.approx(got["s3"], abs=2) and sum(got.values()) == pytest.approx(423, abs=4)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    fixed, places = rng.standard_normal((9, 4)), rng.integers(0, toxicity.TABLE_SIZE, (9, 4))
    index, mask = rng.integers(0, 9, (3, 6)), np.array([[1] * 6, [1] * 4 + [0] * 2, [1] + [0] * 5], bool)
    y, w = np.array([1.0, 0.0, 1.0]), np.array([0.2, 0.5, 0.3])

    def loss():
        z = net.logits(net.projected(net.inputs(fixed, places)), index, mask).astype(np.float64)
        return (w * (np.logaddexp(0, z) - y * z)).sum()

    g = net.gradients(fixed, places, index, mask, y, w)
    for k, at in (("Wf", (1, 2)), ("Ub", (0, 20)), ("v", (3,)), ("w", (9,)), ("cb", (17,)), ("E", (places[0, 0], 1))):
        old, e = net.p[k][at], 1e-2
        net.p[k][at] = old + e
        up = loss()
        net.p[k][at] = old - e
        down = loss()
        net.p[k][at] = old
        assert abs((up - down) / (2 * e) - g[k][at]) < 2e-3 + 0.05 * abs(g[k][at]), k


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(9)
    plain, bad = [f"wo{i}rd" for i in range(500)], ["idiot", "moron", "trash"]

    def doc(toxic):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 200))]
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        return " ".join(words)

    model = toxicity.fit([(doc(i % 3 == 0), int(i % 3 == 0), 2 * (i % 2)) for i in range(900)])
    y = np.array([i % 2 for i in range(200)])
    s = model.scores(pa.array([doc(v) for v in y]))
    assert ((s >= 0.7) == (y == 1)).mean() > 0.95 and 0 <= model.scores(pa.array([None, ""])).max() <= 1


def test_toxicity_reads_whole_texts(spark):
    late = "fine day " * 4000 + "you idiot " * 9
    rows = [(i, late if i % 2 else "fine day " * 4000) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, toxic int")
    read = toxicity.examples(docs, labels).collect()
    assert read and all(r.text == rows[r.doc_id][1] for r in read)
    model = toxicity.train(docs, labels)
    s = model.scores(pa.array([late, "fine day " * 4000]))
    assert s[0] >= 0.7 > s[1]

    # over 4 MB: the same windows as in one pass
    text = " ".join(f"w{i % 9973}" for i in range(900_000)) + " you idiot" * 9
    n = len(text.split())
    top, count = model.tops(pa.array([text]))
    assert len(text) > 4 << 20 and count[0] == -(-(n - toxicity.WINDOW) // toxicity.STEP) + 1


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    """Texts that share a doc_id are not earlier than each other; each loses what an earlier id has."""
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcdefgh ijk") for _ in range(n))
    a, b, c = text(170), text(90), text(120)
    rows = [(1, a), (2, a), (2, "tiny text"), (2, b + a[:81]), (2, b + a[:81]), (3, c + b), (3, b + c), (None, a)]
    docs = spark.createDataFrame([(i, t, None, None, "h", "s", "k") for i, t in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in repeats.without_repeats(docs).collect()), key=str)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(1, 170, 0, 0, digest(a)), (2, 170, 170, 1, digest("")), (2, 9, 0, 0, digest("tiny text")), (2, 171, 81, 1, digest(b)), (2, 171, 81, 1, digest(b)), (3, 210, 90, 1, digest(c)), (3, 210, 90, 1, digest(c)), (None, 170, 0, 0, digest(a))]
    assert got == sorted(want, key=str)


def test_many_secrets_in_one_text(spark):
    """Places of matches are added up in proportion to their number."""
    import time

    word = lambda i: hashlib.md5(str(i).encode()).hexdigest()
    text = " ".join(word(i) if i % 3 else f"token: {word(i)[:9]}é" for i in range(32_000))
    began = time.time()
    got = secrets.scan(frame(spark, [text])).first().spans
    assert time.time() - began < 60
    hexes = [(m.start(), m.end()) for m in re.finditer(r"[0-9a-f]{24,}", text)]
    assigned = [(m.start(), m.end()) for m in re.finditer(r"token: [A-Za-z0-9+/_.=-]+", text)]
    assert [(s.start, s.end) for s in got if s.kind == "hex"] == hexes and [(s.start, s.end) for s in got if s.kind == "assign"] == assigned


def test_an_item_is_found_whatever_other_items_are_there(spark):
    """Passages depend on an item's own length: a question 400 words before its answer is no hit, with a long item beside it or not."""
    rng = random.Random(18)
    words = [f"term{i}" for i in range(3000)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, f"{say(20)}.\n{say(8)}.") for i in range(5)]
    long = (99, f"{say(600)}.\n{say(30)}.")
    texts = [f"{items[0][1].split(chr(10))[0]} {say(400)} {items[0][1].split(chr(10))[1]}", f"{say(50)} {items[1][1]} {say(50)}", f"{say(300)} {long[1]} {say(700)}"]
    hits = lambda own: {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, texts), spark.createDataFrame(own, "item_id long, text string")).collect()}
    assert hits(items) == {(1, 1)} and hits([*items, long]) == {(1, 1), (2, 99)}
    assert [decontaminate.stride_of(n) for n in (0, 1, 64, 65, 630)] == [64, 64, 64, 128, 1024]
