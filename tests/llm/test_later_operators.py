"""Nearest neighbours, point-in-time features and the manifest against brute force; words that collide easily; texts of very many matches."""

import hashlib
import random
import re
import zlib
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pandas as pd
import pytest

from matchloom.llm import features, manifest, minhash, nearest, pii, queries, secrets


def test_words_that_polynomials_confuse(spark):
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [x for n in (1024, 2048, 4096) for x in (word[:n], word[:n].translate(str.maketrans("ab", "ba")))]
    docs = spark.createDataFrame([*enumerate(texts), (6, texts[3].upper())], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 3}


def test_many_matches_in_one_text(spark):
    numbers = " ".join(f"+49 30 {1000000 + k}" for k in range(20_000))
    row = pii.find_pii(spark.createDataFrame([(1, numbers)], "doc_id long, text string")).first()
    assert row.n_phone == 20_000 and row.spans.startswith("phone:0:14,phone:15:29")
    hexes = " ".join(f"{k:032x}" for k in range(20_000)) + " \x01 password=" + "x" * 9
    row = secrets.find_secrets(spark.createDataFrame([(1, hexes)], "doc_id long, text string")).first()
    assert [(s.s, s.e) for s in row.base if s.kind == "hex"] == [m.span() for m in re.finditer("[0-9a-f]{24,}", hexes)]
    assert row.n_hex == 20_000 and row.n_assign == 1


def _hash(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _climb(nodes):
    """The root of a list of digests and, for each, its levels as (run, place)."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, o in enumerate(own):
            paths[k].append((nodes[o // 8 * 8 : o // 8 * 8 + 8], o % 8))
        own, nodes = [o // 8 for o in own], [_hash(nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
    return nodes[0], paths


@pytest.mark.parametrize("high", [4, 1])
def test_manifest(spark, high):
    sizes = {None: 1, "": 9, "a": 700, "b": 8, "é": 65, "B": 64, **{f"x{k}": 1 for k in range(9)}}
    rows = [(lang, k // 2 if lang == "b" else k or None, _hash([lang or "-", str(k)]), k) for lang, n in sizes.items() for k in range(n)]
    random.Random(1).shuffle(rows)
    leaves = spark.createDataFrame(rows, "lang string, doc_id long, leaf string, path int")  # a column named as an added one
    given = leaves.withColumnRenamed("path", "i")
    got = manifest.manifest(given, "lang", ["doc_id"], high).withColumn("folded", manifest.fold(manifest.F.col("leaf"), manifest.F.col("path"))).withColumn("beside", manifest.siblings(manifest.F.col("path"))).collect()
    order = sorted(sizes, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted((r for r in rows if r[0] == x), key=lambda r: (r[1] is not None, r[1] or 0, r[2])) for x in order}
    trees = {x: _climb([r[2] for r in own[x]]) for x in order}
    root, over = _climb([trees[x][0] for x in order])
    found = {(r.lang, r.i): r for r in got}
    assert len(got) == len(rows) == len(found)
    for at, x in enumerate(order):
        for r, path in zip(own[x], trees[x][1], strict=True):
            row = found[x, r[3]]
            assert (row.leaf, row.subroot, row.root, row.folded) == (r[2], trees[x][0], root, root)
            assert row.beside == "".join(h for run, o in path + over[at] for k, h in enumerate(run) if k != o)
    assert manifest.manifest(given.limit(0), "lang", ["doc_id"]).count() == 0


def test_manifest_query_sees_tampering(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in manifest.op13_merkle_manifest(spark, sf).collect():
        text = docs[r.doc_id].text or ""
        touched = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and re.search("[A-Z]", text)
        assert r.verified == (not touched)


def _clusters(n, width, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, width))
    return centres[rng.integers(0, 12, n)] + 0.6 * rng.standard_normal((n, width))


def test_scan_keeps_what_is_near():
    x = nearest._unit(_clusters(3000, 64))
    turned = x @ nearest.rotation(64)
    queries_, limit = turned[:40], np.full(40, 0.5)
    a, b, looked = nearest.scan(queries_, turned, limit)
    distance = 2 - 2 * x[:40] @ x.T
    near = set(zip(*np.nonzero(distance <= 0.5), strict=True))
    found = set(zip(a.tolist(), b.tolist(), strict=True))
    assert found <= set(zip(*np.nonzero(distance <= 0.5 + 1e-5), strict=True)) and len(near & found) >= 0.99 * len(near)
    assert looked < 0.6 * 40 * 3000 * 64  # most candidates are abandoned early


def test_nearest_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CANDIDATES", 64)  # many blocks and chunks
    monkeypatch.setattr(nearest, "QUERIES", 4)
    x = _clusters(1500, 24)
    x[700:1200] = x[700]  # a third of the rows
    rows = [(k, v) for k, v in enumerate(x.tolist())]
    odd = [(5000, None), (5050, []), (5100, [0.0] * 24), (5150, [float("nan")] + [1.0] * 23), (5200, [None] + [1.0] * 23), (5250, [1.0, 2.0]), (5300, [2.0, 4.0]), (5350, [float("inf")] * 24), (None, x[0].tolist()), (3, x[3].tolist())]
    df = spark.createDataFrame(rows + odd, "id long, v array<double>").repartition(7)
    got = {}
    for r in nearest.nearest(df, df.where("id % 50 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
    assert [x[1] for x in got[5250]] == [5300] and abs(got[5250][0][2] - 1) < 1e-12  # fewer candidates than 5
    assert set(got) == {k for k in range(0, 1500, 50)} | {5250, 5300}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hit = 0
    for q in range(0, 1500, 50):
        score = np.round(unit @ unit[q], 12)
        score[q] = -9
        best = np.lexsort((np.arange(1500), -score))[:5].tolist()
        mine = sorted(got[q])
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5] and all(abs(m[2] - unit[q] @ unit[m[1]]) < 1e-12 for m in mine)
        hit += len(set(best) & {m[1] for m in mine})
    assert hit >= 0.95 * 150
    assert nearest.nearest(df.limit(0), df.limit(0), 5).count() == 0


def test_nearest_finds_nine_of_ten(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("embedding IS NOT NULL")
    x, ids = np.array([r.embedding for r in df.collect()], dtype=float), np.array([r.vec_id for r in df.collect()])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    found = {(r.query_id, r.vec_id) for r in nearest.op11_dimension_scan(spark, "/root/testdata/sf0.1").collect()}
    asked = np.nonzero(ids % 50 == 0)[0]
    hit = 0
    for q in asked:
        score = unit @ unit[q]
        score[q] = -9
        hit += sum((ids[q], ids[k]) in found for k in np.argsort(-score)[:5])
    assert hit >= 0.9 * 5 * len(asked)


def _shop(spark, hot, seed=7):
    """Clicks, sales and lines of a month with a client and a sale of a third of the rows, nulls, repeats and late rows."""
    rng, start = random.Random(seed), datetime(2024, 1, 1)
    when = lambda: rng.choice([None, *[start + timedelta(seconds=rng.randrange(30 * 86400), microseconds=rng.choice([0, 250000]))] * 15])
    client = lambda: rng.choice([1] * hot + [2, 3, 4, 5, None])
    late = lambda t: t and t + timedelta(seconds=rng.choice([-50, 0, 60, 90000, 400000]))
    sales = [(k, client(), rng.choice([None, 0.0, 12.345, 99.999]), t := when(), rng.choice([None, late(t), late(t)])) for k in range(300)]
    clicks = [(k // 2, t := when(), late(t), client(), rng.choice(["view", "purchase", None]), rng.choice([None, -3.5, 7.25]), "{}") for k in range(600)]
    lines = [(rng.choice([7] * hot + [rng.randrange(320), None]), rng.choice([1, 2, 3, None]), rng.choice([None, 1.005, 20.0]), t and t + timedelta(days=rng.randrange(5))) for t in (when() for _ in range(900))]
    return (
        spark.createDataFrame(clicks + clicks[:90], "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string"),
        spark.createDataFrame(sales, "sale_id long, client_id long, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz"),
        spark.createDataFrame(lines + lines[:50], "sale_id long, item_id long, amount double, shipped_at timestamp_ntz"),
    )


@pytest.mark.parametrize("capacity", [16_384, 40, 1])
def test_features_against_sql(spark, monkeypatch, capacity):
    monkeypatch.setattr(features.dominance, "__defaults__", (*features.dominance.__defaults__[:-1], capacity))
    if capacity == 1:
        monkeypatch.setattr(features, "RUN", 2)  # many levels of blocks
    shop = _shop(spark, 3)
    got = features.sale_features(*shop).toPandas()
    duck = duckdb.connect()
    for name, df in zip(("clicks", "sales", "sale_lines"), shop, strict=True):
        duck.register(f"{name}_rows", df.toArrow())
        duck.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_rows")
    want = duck.execute(queries.FEATURES).fetchdf()
    columns = sorted(got.columns)
    value = lambda x: -1 if pd.isna(x) else int(x)
    rows = lambda df: sorted(tuple(map(value, r)) for r in df[columns].astype(object).itertuples(index=False))
    assert sorted(want.columns) == columns and len(want) > 400
    assert rows(got) == rows(want)


def test_features_of_nothing(spark):
    clicks, sales, lines = _shop(spark, 1)
    assert features.sale_features(clicks, sales.limit(0), lines).count() == 0
    alone = features.sale_features(clicks.limit(0), sales, lines.limit(0))
    assert alone.agg({"n_clicks": "sum", "n_lines": "sum"}).first()[:] == (0, 0)
