"""Near-duplicates, suffix dedup, quality and sharding against brute force, and their edge cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.llm import bwt, components, minhash, quality, sharding, suffixes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [(5, "A b c d e f"), (6, "a B c\td e  f"), (7, "a b"), (8, "A\nB"), (9, None), (10, ""), (11, " \n"), (None, "a b c d e f"), (12, "é" * 70), (12, "é" * 70)]


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    words = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 7))) for _ in range(400)]
    docs = [[r.choice(words) for _ in range(r.randint(1, 120))] for _ in range(120)]
    passage = [r.choice(words) for _ in range(30)]
    for i in range(20):
        docs[i] = docs[i][:10] + passage + docs[i][10:]
    for i in range(40, 90):
        base = list(docs[r.choice([30, 31, 32, i - 1])])
        for _ in range(r.randint(0, 4)):
            base[r.randrange(len(base))] = r.choice(words)
        docs[i] = base
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit(1), "n": F.lit("x"), "block": F.lit(2), "size": F.lit(0), "kept": F.lit(0)})


def clusters(rows):
    sets = {}
    for d, t in rows:
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_near_duplicates(spark, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(spark, corpus)).collect()}
    assert got == clusters(corpus)


def test_near_duplicate_edges(spark):
    rows = minhash.near_duplicates(frame(spark, EDGES)).collect()
    assert len(rows) == len(EDGES)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert got[6] == (2, 5, False) and got[8] == (1, 7, False) and got[9] == got[9][:1] + (9, True) and got[11] == (0, 11, True) and got[None] == (2, None, True)
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def test_one_doc_id_with_different_texts(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(5, a), (5, b), (7, a + " more"), (8, b + " less"), (3, b + " last"), (9, None), (5, a)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(spark, rows)).collect())
    assert got == [(3, 37, 3), (5, 36, 3), (5, 36, 5), (5, 36, 5), (7, 37, 5), (8, 37, 3), (9, 0, 9)]


def test_near_duplicates_of_very_long_texts(spark):
    r = random.Random(2)
    words = [f"w{r.randrange(10**6)}" for _ in range(60_000)]
    near = words[:30_000] + ["other"] + words[30_000:]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, "x" * 1_000_000), (4, "x" * 1_000_000 + " y"), (5, " ".join(words[:30_000]))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {1: (59_996, 1), 2: (59_997, 1), 3: (1, 3), 4: (1, 4), 5: (29_996, 5)}


def test_close_signatures_always_share_a_key():
    r = np.random.default_rng(1)
    width = minhash.POSITIONS // minhash.CHUNKS
    for _ in range(200):
        a = r.integers(0, 1 << 16, minhash.POSITIONS)
        b = a.copy()
        b[r.choice(minhash.POSITIONS, minhash.DISTANCE, replace=False)] ^= 1
        assert ((a != b).reshape(-1, width).sum(axis=1) <= minhash.ERRORS).any()


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(0, x) for x in range(300, 340)] + [(x, x + 1) for x in range(400, 460)] + [(7, 7)]
    root = {x: x for e in edges for x in e}
    for _ in range(70):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    rows = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {x.id: x.root for x in rows}
    assert len(rows) == len(got) and all(got.get(x, x) == y for x, y in root.items())
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def removed(rows, size=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - size + 1):
            if d is not None:
                first[b[k : k + size]] = min(d, first.get(b[k : k + size], d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - size + 1):
            if d is not None and first[b[k : k + size]] < d:
                gone[k : k + size] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((-1 if d is None else d, len(b), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()), kept))
    return sorted(out)


def test_suffixes(spark, corpus):
    rows = corpus + EDGES[:3] + [(200, "é" * 20 + corpus[3][1]), (201, "a" * 500), (199, "a" * 60), (None, corpus[3][1]), (202, corpus[3][1]), (202, corpus[3][1] + "z" * 90), (203, None), (204, "x" * 49)]
    got = suffixes.remove_repeats(frame(spark, rows)).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, sum(s.e - s.s for s in r.removed), len(r.removed), bytes(r.kept)) for r in got) == removed(rows)
    assert suffixes.remove_repeats(frame(spark, [])).count() == 0


def test_suffixes_of_copies_shuffle_no_text(spark, corpus):
    rows = [(i + 1000 * k, t) for k in range(3) for i, t in corpus] + [(None, corpus[4][1]), (4, corpus[4][1]), (1004, corpus[4][1]), (5000, corpus[4][1][20:] + "y"), (5001, "s" * 49), (5002, "s" * 49)]
    random.Random(3).shuffle(rows)
    out = suffixes.remove_repeats(frame(spark, rows).withColumn("at", F.timestamp_seconds(F.col("doc_id"))))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = out.collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, sum(s.e - s.s for s in r.removed), len(r.removed), bytes(r.kept)) for r in got) == removed(rows)
    assert all(r.n == "x" and (r.at is None) == (r.doc_id is None) for r in got)


def test_halves_of_two_characters_make_no_third():
    raw = "aéxxжb€c".encode()
    cut = raw.index(b"\xa9"), raw.index(b"\xb6")  # from inside é to inside ж
    assert suffixes.whole_characters(raw[: cut[0]] + raw[cut[1] :], [cut]) == "ab€c"
    euro = raw.index("€".encode())
    assert suffixes.whole_characters(raw[:euro] + raw[euro + 1 :], [(euro, euro + 1)]) == "aéxxжbc"
    assert suffixes.whole_characters(raw, []) == raw.decode() and suffixes.whole_characters(b"", [(0, 9)]) == ""


def test_kept_texts(spark):
    shared = "é" * 30
    rows = [(1, "a" + shared), (2, "b" + shared + "ж"), (3, shared[1:] + "€"), (4, None)]
    got = {r.doc_id: (r.kept_text, bytes(r.kept)) for r in suffixes.remove_repeats(frame(spark, rows), with_text=True).collect()}
    assert got == {1: ("a" + shared, ("a" + shared).encode()), 2: ("bж", "bж".encode()), 3: ("€", "€".encode()), 4: ("", b"")}


def test_suffixes_of_crowded_minimizers(spark, corpus):
    r = random.Random(7)
    passage = "All rights reserved by whoever wrote this line, here and elsewhere."
    rows = [(i, f"{r.random()}{t[:80]} {passage}{r.choice(['', passage, passage[20:]])} {r.random()}{t[80:200]}") for i, t in corpus] + [(500 + i, t[50:]) for i, t in corpus[:60]]
    assert len(rows) > 3 * suffixes.CROWD
    got = suffixes.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_bytes, sum(s.e - s.s for s in r.removed), len(r.removed), bytes(r.kept)) for r in got) == removed(rows)


def test_suffixes_of_very_long_texts(spark):
    r = random.Random(8)
    long = "".join(r.choice("abcdefghij ") for _ in range(300_000))
    rows = [(1, long), (2, "x" + long[1000:200_000] + "y"), (3, "z" * 200_000), (4, "z" * 120)]
    got = suffixes.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_bytes, sum(s.e - s.s for s in r.removed), len(r.removed), bytes(r.kept)) for r in got) == removed(rows)


@pytest.mark.parametrize("piece", [1 << 18, 64, 7, 1])
def test_bwt(monkeypatch, tmp_path, piece):
    monkeypatch.setattr(bwt, "PIECE", piece)
    r = random.Random(piece)
    for _ in range(40):
        texts = [bytes(r.choice(b"abc") for _ in range(r.randint(0, 14))) for _ in range(r.randint(1, 12))]
        lengths = np.array([len(t) for t in texts])
        got = bwt.build(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths), lengths, f"file://{tmp_path}")
        assert not list(tmp_path.iterdir())
        suffix = sorted(([1000 + c for c in t[k:]] + [i], i, k) for i, t in enumerate(texts) for k in range(len(t) + 1))
        assert got[0].tolist() == [texts[i][k - 1] if k else bwt.START for _, i, k in suffix]
        common = [0]
        for (x, _, _), (y, _, _) in zip(suffix, suffix[1:], strict=False):
            common.append(next(n for n, (p, q) in enumerate(zip(x, y, strict=False)) if p != q or p < 1000))
        assert got[1].tolist() == common


def statistics(text):
    words = WORDS.findall(text or "")
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words))


def test_quality(spark, corpus):
    rows = corpus + EDGES + [(300, "a b c d e f " * 9), (301, "x\ny\nx\n\n \nx\n" + corpus[0][1] + " #$%"), (302, corpus[1][1] + " one two three four five six " * 2)]
    rows += [(400 + i, " ".join(["$$$###"] * 2 + [f"w{i}{k}$$$" for k in range(60)])) for i in range(3)]
    docs = frame(spark, rows).withColumns({"lang": F.when(F.col("doc_id") != 8, "en"), "source": F.lit("s")})
    got = quality.quality(docs).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    key = lambda x: (-1 if x[0] is None else x[0], x[1])
    assert sorted(((r.doc_id, tuple(r[f] for f in fields)) for r in got), key=key) == sorted(((d, statistics(t)) for d, t in rows), key=key)
    kept = {r.doc_id: r.kept for r in got if not r.base_failed}
    assert not any(kept[400 + i] for i in range(3)) and all(kept.get(i, True) for i in range(120))
    assert quality.quality(docs.limit(0)).count() == 0


def test_quality_of_very_long_texts(spark):
    r = random.Random(4)
    words = [f"w{r.randrange(50_000)}" for _ in range(120_000)]
    rows = [(1, " ".join(words)), (2, "x" * 1_000_000), (3, " ".join(words[:20_000]) + "\n" + " ".join(words[:3_000]))]
    docs = frame(spark, rows).withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {x.doc_id: tuple(x[f] for f in fields) for x in quality.quality(docs).collect()} == {d: statistics(t) for d, t in rows}


def test_robust_distances(spark):
    """Distances follow from the moments of the core by the formula, and the steps end where the core stays as it is."""
    r = np.random.default_rng(2)
    words = lambda n: " ".join(f"w{k}" for k in r.integers(0, 5000, n))
    rows = [(i, words(int(r.lognormal(5, 0.5)) + 20) + " #" * int(r.integers(0, 3))) for i in range(400)]
    docs = frame(spark, rows).withColumns({"lang": F.when(F.col("doc_id") % 3 > 0, "en"), "source": F.lit("s")})
    few, many = ({x.doc_id: x.distance for x in quality.quality(docs, steps=n).collect()} for n in (12, 40))
    assert few == many
    stats = quality._features(quality.text_statistics(docs)).where("not base_failed")
    core = stats.select("lang", "source", *quality.FEATURES)
    moments, _ = quality._moments(core, ("lang", "source"), 50.0)
    got = {x.doc_id: x.d for x in quality._distance(stats, moments, ("lang", "source"), "d").collect()}
    table = stats.select("doc_id", "lang", *quality.FEATURES).toPandas()
    x = table[list(quality.FEATURES)].to_numpy(float)
    for group in (table["lang"] == "en", table["lang"] != "en"):
        n, g = len(x), x[group.to_numpy()]
        weight = 50 / n
        total = len(g) + 50
        mean = (g.sum(0) + weight * x.sum(0)) / total
        cov = ((g.T @ g + weight * x.T @ x) / total - np.outer(mean, mean)) / quality.SCALE**2
        low = np.zeros((5, 5))
        for j in range(5):
            low[j, j] = np.sqrt(max(cov[j, j] - low[j, :j] @ low[j, :j], quality.FLOORS[j] ** 2))
            for i in range(j + 1, 5):
                low[i, j] = (cov[i, j] - low[i, :j] @ low[j, :j]) / low[j, j]
        want = (np.linalg.solve(low, ((g - mean) / quality.SCALE).T) ** 2).sum(0)
        assert np.allclose([got[d] for d in table["doc_id"][group]], want, rtol=1e-6, atol=1e-6)


def test_one_sided_junk_is_rejected_and_clean_text_stays(spark):
    r = random.Random(5)
    words = ["".join(r.choice("aeinorst") for _ in range(r.choice((2, 3, 4, 5, 6, 7, 9)))) for _ in range(500)]
    prose = lambda sep=" ": sep.join(r.choice(words) for _ in range(int(r.lognormvariate(5, 0.6)) + 30))
    rows = [(i, prose() + ("." if i % 9 else " #1")) for i in range(1000)] + [(2000 + i, prose(" | ")) for i in range(30)]
    docs = frame(spark, rows).withColumns({"lang": F.lit("en"), "source": F.when(F.col("doc_id") % 2 == 0, "s")})
    got = [x for x in quality.quality(docs).collect() if not x.base_failed]
    junk, clean = ([x.kept for x in got if (x.doc_id >= 2000) == side] for side in (True, False))
    assert len(junk) > 20 and not any(junk)
    assert len(clean) > 900 and sum(clean) > 0.99 * len(clean)


def test_shards(spark, corpus):
    rows = corpus * 5 + EDGES + [(1 << 62, "far"), (-5, "neg")] + [(77, "same key")] * 300
    got = sharding.shard_documents(frame(spark, rows), shards=4).collect()
    assert len(got) == len(rows)
    total = defaultdict(int)
    slots = defaultdict(list)
    for r in got:
        assert r["size"] == len((r.text or "").encode()) + 8
        total[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(total.values()) - min(total.values()) < 0.1 * sum(total.values()) / 4 + 2 * max(r["size"] for r in got)
    assert sharding.shard_documents(frame(spark, [])).count() == 0


def test_shards_of_very_long_texts(spark):
    rows = [(i, "é" * 300_000 if i == 5 else "x" * i) for i in range(200)]
    got = sharding.shard_documents(frame(spark, rows), shards=4).collect()
    assert sorted((r.doc_id, r["size"]) for r in got) == [(i, len(t.encode()) + 8) for i, t in rows]
    assert [r["size"] for r in got if r.doc_id == 5] == [600_008]


def test_cells_are_refined_to_what_one_task_can_number(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LEAF_BYTES", 2000)
    monkeypatch.setattr(sharding, "LEAF_BITS", 20)
    keys = spark.createDataFrame([(i, 100) for i in range(4000)], "key long, size long")
    trie, heavy = sharding._refine(keys, 12, 400_000, 2, 0.002)
    assert max(x[2] for x in trie.leaves) <= 2000 and not heavy
    assert sharding._refine(keys.withColumn("key", keys["key"] % 16), 12, 400_000, 2, 0.002)[1]


def test_one_heavy_key_is_parted(spark):
    got = sharding.shard_documents(frame(spark, [(1, "x" * 92)] * 4000), shards=4).groupBy("shard").count().collect()
    assert sorted(r.shard for r in got) == [0, 1, 2, 3] and max(r["count"] for r in got) < 1200


