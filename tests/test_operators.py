import pytest
from pyspark.sql import functions as F

from matchloom.config import Adjudication, Thresholds
from matchloom.functions.clients import HashedNgrams, OfflineModel
from matchloom.operators import adjudicate, language, pairs, profile, quality, rowmatch, select
from matchloom.schemas import ROW_MATCHES
from matchloom.sources import tables
from matchloom.streaming.arrivals import BATCH_ROWS, match_arrivals


@pytest.fixture(scope="module")
def data(spark):
    master = spark.createDataFrame([("a", "x", "1"), ("b", "x", "2"), (None, "x", "3")], "k string, constant string, n string")
    other = spark.createDataFrame([("a", None), ("c", None)], "q string, nothing string")
    return {"Master": master, "Other": other, "Empty": spark.createDataFrame([], "e string")}


def test_profile(spark, data):
    counts = profile.value_counts(data)
    stats = {(r.dataset, r.column_name): r for r in profile.column_stats(counts, profile.catalog(spark, data)).collect()}
    assert stats["Master", "constant"].entropy == 0 and stats["Master", "k"].entropy == 1 and stats["Master", "k"].fill_rate == pytest.approx(2 / 3)
    assert stats["Other", "nothing"].entropy is None and stats["Other", "nothing"].avg_length is None and stats["Empty", "e"].fill_rate is None
    kinds = {(r.dataset, r.column_name): r.data_type for r in profile.detect_types(counts).collect()}
    assert kinds["Master", "n"] == "numerical" and kinds["Master", "k"] == "text" and kinds["Other", "nothing"] == "unknown"
    examples = {(r.dataset, r.column_name): r.example_values for r in profile.metadata(data).collect()}
    assert examples["Master", "k"] == ["a", "b"] and examples["Empty", "e"] == []
    assert profile.sample_rows(data["Master"], 2).collect() == profile.sample_rows(data["Master"], 2).collect()


def test_pairs(spark, data):
    every = pairs.column_pairs(profile.catalog(spark, data))
    assert every.count() == 3 * 6
    shares = {(r.master_column, r.enrichment_dataset, r.enrichment_column): r for r in pairs.overlap(profile.value_counts(data), "Master", every).collect()}
    assert shares["k", "Other", "q"].overlap_jaccard == pytest.approx(1 / 3) and shares["k", "Other", "nothing"].overlap_master == 0
    assert shares["k", "Master", "k"].overlap_jaccard == 1


def test_digests_of_values(spark):
    texts = ["", "a", "fifteen bytes.!", "sixteen bytes..!", "sixteen bytes..?", "é" * 8, "é" * 7, "x" * 5000, "y" * 5000, None, None, "a"]
    some = {"Master": spark.createDataFrame([(t, "one") for t in texts], "k string, c string"), "Other": spark.createDataFrame([(t,) for t in texts[2:8]] + [("other" * 9,)], "q string"), "Empty": spark.createDataFrame([], "e string")}
    columns, (whole, short) = profile.catalog(spark, some), (profile.value_counts(some, digests=d) for d in (False, True))
    assert max(len(r.value) for r in short.where("value IS NOT NULL").collect()) == 16 and short.count() == whole.count()
    for f in (lambda c: profile.column_stats(c, columns), lambda c: pairs.overlap(c), lambda c: pairs.overlap(c, "Master", pairs.column_pairs(columns))):
        assert sorted(map(str, f(whole).collect())) == sorted(map(str, f(short).collect()))


def test_no_cross_product_of_values(data):
    plan = pairs.overlap(profile.value_counts(data))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_same_name_option(spark):
    row = ("Master", "A", "id", "id", "text", "text", 0.0, 1.0, 1.0, 1.0, 0.0)
    f = spark.createDataFrame([row], "master_dataset string, enrichment_dataset string, master_column string, enrichment_column string, master_data_type string, enrichment_data_type string, avg_length_diff double, master_fill_rate double, enrichment_fill_rate double, description_similarity double, entropy_gap double")
    assert select.filter_pairs(f).count() == 0 and select.filter_pairs(f, Thresholds(allow_same_name=True)).count() == 1


def test_column_map(spark):
    m = spark.createDataFrame([("name", "A", "org", "name", 1.0, 80.0, 10.0), ("city", "A", "town", "city", 1.0, 10.0, 10.0)], "master_column string, enrichment_dataset string, enrichment_column string, enrichment_candidates string, weighted_score double, percent_master_in_enrichment double, percent_enrichment_in_master double")
    assert select.column_map(m) == {"A": [("town", "city", False), ("org", "name", True)]}


def test_row_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    rows = rowmatch.row_index(df, "i", ["v"]).collect()
    assert sorted(r.i for r in rows) == list(range(1, 1001)) and all(r.i == r.v + 1 for r in rows)


def test_row_index_with_few_keys(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    out = rowmatch.row_index(df, "i", ["k"])
    rows = out.collect()
    assert sorted(r.i for r in rows) == list(range(1, 20_001)) and all((r.i <= 10_000) == (r.k == 0) for r in rows)
    largest = max(r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
    assert largest < 9_000  # two keys fill four partitions


MAPPING = [("zone", "zone", True), ("town", "city", True), ("org", "name", False)]


@pytest.fixture(scope="module")
def sides(spark):
    e = spark.createDataFrame([(1, "z", "Rome ", "ACME, corp"), (2, None, "Rome", "acme"), (3, "z", "Oslo", "acme corp"), (4, "z", None, "---"), (5, "z", None, None)], "enrichment_row_index long, zone string, town string, org string")
    m = spark.createDataFrame([(1, "z", "rome", "Acme Corp"), (2, "Z", "rome", "acme"), (3, "z", None, "Other")], "master_row_index long, zone string, city string, name string")
    return e, m


def test_fuzzy(sides):
    rows = rowmatch.match_fuzzy(*sides, MAPPING, "A").orderBy("enrichment_row_index").collect()
    assert [(r.enrichment_row_index, r.master_row_index, r.similarity) for r in rows] == [(1, 1, [100.0])]
    assert rows[0].enrichment_evidence == "zone: z; city: Rome ; name: ACME, corp"


def test_fuzzy_without_scored_columns(sides):
    out = rowmatch.match_fuzzy(*sides, MAPPING[:2], "A")
    assert out.schema == ROW_MATCHES and out.count() == 0


def test_embedded(sides):
    rows = rowmatch.match_embedded(*sides, MAPPING, "A", HashedNgrams(64), top_n=1).collect()
    best = {r.enrichment_row_index: r.master_row_index for r in rows}
    assert best[1] == 1 and 4 not in best and 5 not in best  # nothing is left of "---"; null has no vector


def test_cross_join_is_guarded(sides):
    with pytest.raises(ValueError):
        rowmatch.match_fuzzy(*sides, MAPPING[2:], "A", max_cross_pairs=3)
    assert rowmatch.match_fuzzy(*sides, MAPPING[2:], "A").count() > 0


def test_language(spark):
    df = spark.createDataFrame([("größe",), ("size",), (None,)], "x string")
    out = language.translate_column(df, "x", OfflineModel({"größe": "size"}))
    assert [r.x for r in out.orderBy("x").collect()] == [None, "size", "size"]
    assert [r[0] for r in df.select(language.is_english(F.col("x"), lambda t: 0.9)).collect()] == [True, True, True]
    assert [r[0] for r in df.select(language.is_english(F.col("x"), lambda t: 1 / 0)).collect()] == [False, True, True]
    assert [r[0] for r in df.select(language.is_english(F.col("x"), None)).collect()] == [False, True, True]


def test_detector(spark):
    english = ["Café opened", "naïve approach to trading", "The résumé was sent to the company", "“quoted” text — with dashes", "5 €"]
    others = ["größe", "Zürich", "Müller & Söhne GmbH", "société anonyme", "Señor Perez", "köttbullar", "Łódź", "日本語", "Les éditions du soleil"]
    df = spark.createDataFrame([(x,) for x in english + others], "x string")
    assert [r[0] for r in df.select(language.is_english(F.col("x"))).collect()] == [True] * len(english) + [False] * len(others)


def test_functions_by_name(spark):
    names = language.register_functions(spark, "own_")
    assert "own_is_english" in names
    df = spark.createDataFrame([("größe", "acme corp"), (None, "acme"), ("size", None)], "x string, y string")
    assert [r[0] for r in df.select(language.call_by_name("own_is_english", "x")).collect()] == [False, True, True]
    assert [r[0] for r in df.selectExpr("own_token_set_ratio('acme', y)").collect()] == [100.0, 100.0, None]
    assert [r[0] for r in df.select(language.call_by_name("upper", "x")).collect()] == ["GRÖSSE", None, "SIZE"]


def chosen(spark, enrichment, master):
    top = spark.createDataFrame([("e", "c", x) for x in enrichment] + [("m", "k", x) for x in master], "dataset string, column_name string, value string")
    hits = language.transform_hits(top, [("c", "k")])["c", "k"]
    return OfflineModel().choose_transform(enrichment, master, hits), hits


def test_transforms(spark):
    assert chosen(spark, ["ACME", "Bolt"], ["acme", "bolt"])[0] == "lower"
    assert chosen(spark, ["https://www.Acme.com/x"], ["acme.com"])[0] == "domain"
    assert chosen(spark, ["a"], ["a"])[0] == "identity"
    name, hits = chosen(spark, ["a12-34", "5\u0665"], ["1234", "5"])  # digits are ASCII digits, in the choice as in the column
    assert name == "digits" and hits["digits"] == 2 and hits["no_punctuation"] == 1 and hits["identity"] == 0
    df = spark.createDataFrame([("12-34",), (None,)], "x string")
    assert [r[0] for r in language.transform_column(df, "x", "zero_padded_9").select("x__TRANSFORMED").collect()] == ["000001234", None]


@pytest.fixture(scope="module")
def matches(spark):
    rows = [(1, 1, "Master", "A", "n: a", "n: a", [1.0], 0.95), (2, 1, "Master", "A", "n: b", "n: zz", [0.2], 0.2), (3, 2, "Master", "A", "n: c", "n: c", [0.9], None)]
    return spark.createDataFrame(rows, ROW_MATCHES)


def test_adjudication(matches):
    client = OfflineModel()
    verdicts = lambda s: {r.enrichment_row_index: (r.final_llm_decision, r.final_llm_justification) for r in adjudicate.adjudicate(matches, client, s).collect()}
    assert [v[0] for _, v in sorted(verdicts(Adjudication(ask_top_n=0)).items())] == ["Yes", "No", "No"]
    some = verdicts(Adjudication(ask_top_n=1))
    assert some[2] == ("No", adjudicate.TOO_LOW) and some[1][0] == "Yes" and some[3][0] == "Yes"
    every = verdicts(Adjudication(ask_top_n=3))
    assert every[2][1].startswith("evidence")
    both = adjudicate.as_object(adjudicate.by_threshold(matches)).orderBy("enrichment_row_index").first()
    assert both.final_llm.decision == "Yes" and both.final_llm_json == '{"decision":"Yes","justification":"LLM not called; backup threshold used"}'
    assert {r.final_llm_decision: r.n for r in adjudicate.tally(adjudicate.by_threshold(matches)).collect()} == {"Yes": 1, "No": 2}


def test_positive(spark):
    assert [r.x for r in quality.not_positive(spark.createDataFrame([(1,), (0,), (None,)], "x int"), "x").collect()] == [0]


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Name, City\n"Acme, Inc", Rome \nBolt\n')
    df = tables.read_csv(spark, f"file://{tmp_path}/a.csv")
    assert [tuple(r) for r in df.collect()] == [("Acme, Inc", "Rome"), ("Bolt", None)]
    from matchloom.schemas import schema

    loaded = tables.load_into(df, schema("CITY string, name string, more long"))
    assert loaded.columns == ["CITY", "name", "more"] and loaded.first().more is None
    tables.reset_database(spark, "box")
    tables.save(loaded, "box.one")
    assert tables.clone_table(spark, "box.one", "box.two", rows=False).count() == 0
    tables.ensure_table(spark, "box.three", ROW_MATCHES)
    assert sorted(tables.drop_tables(spark, "box")) == ["one", "three", "two"]
    with pytest.raises(ValueError):
        tables.load_datasets(spark, {"A": "box.one"})
    loaded.write.parquet(f"{tmp_path}/own")
    cached = tables.load_datasets(spark, {"Master": f"{tmp_path}/own"}, cache=True)
    assert cached["Master"].is_cached and cached["Master"].count() == 2
    tables.release_datasets(cached)
    assert not cached["Master"].is_cached
    assert tables.namespace(" raw ", "x") == "raw" and tables.namespace(None, "x") == "x"


def test_local_frames_and_sessions(spark):
    import pandas as pd

    from matchloom.schemas import schema

    kinds = schema("name string, n long")
    assert [tuple(r) for r in tables.from_local(spark, pd.DataFrame({"N": [1, 2], "name": ["a", None]}), kinds).collect()] == [("a", 1), (None, 2)]
    assert tables.from_local(spark, [("a", 1)], kinds).first().n == 1
    assert tables.session("again", ["raw_box"]) is spark and spark.catalog.databaseExists("raw_box")
    spark.sql("DROP DATABASE raw_box")
    assert tables.staging_views({"My data; x": spark.range(2)}) == ["raw_my_data_x"] and spark.table("raw_my_data_x").count() == 2


def test_intermediate_tables_are_deleted(spark):
    from pathlib import Path

    from matchloom.sources import intermediate

    folder = Path(intermediate.shared_folder(spark).removeprefix("file://"), "matchloom")
    with intermediate.scratch():
        with intermediate.scratch():
            gone = intermediate.materialize(spark.range(3), "inner")
            kept = intermediate.materialize(gone.groupBy("id").count(), "outer", outlive=True)
            assert gone.count() == 3 and list(folder.glob("inner-*"))
        assert not list(folder.glob("inner-*")) and kept.count() == 3
    assert not list(folder.glob("outer-*")) and spark.conf.get(intermediate.CLEAN_UP) == "false"


def test_pair_counts(sides):
    e, m = rowmatch._sides(*sides, MAPPING)
    assert [tuple(r) for r in rowmatch.pair_counts(e, m, [0]).collect()] == [("z", 4, 2, 8)]
    with pytest.raises(ValueError, match="'z'"):
        rowmatch.match_fuzzy(*sides, MAPPING, "A", max_pairs=7)
    assert rowmatch.match_fuzzy(*sides, MAPPING, "A", max_pairs=8).count() == 1


def test_second_filters_are_a_key(spark):
    import itertools

    values = [None, "a", " A", "b"]
    rows = list(itertools.product(["x", "y", None], values, values))
    e = spark.createDataFrame([(i, list(v)) for i, v in enumerate(rows)], "enrichment_row_index long, e array<string>")
    m = spark.createDataFrame([(i, list(v)) for i, v in enumerate(rows)], "master_row_index long, m array<string>")
    same = lambda p, q: p is None or q is None or p.strip().lower() == q.strip().lower()
    want = sorted((i, j) for i, v in enumerate(rows) for j, w in enumerate(rows) if v[0] == w[0] is not None and same(v[1], w[1]) and same(v[2], w[2]))
    got = sorted((r.enrichment_row_index, r.master_row_index) for r in rowmatch.block_pairs(e, m, [0, 1, 2]).collect())
    assert got == want


def test_nearest_rows_against_brute_force(spark, monkeypatch):
    import numpy as np

    r = np.random.default_rng(3)
    monkeypatch.setattr(rowmatch, "BLOCK", 16)
    rows = lambda n: [(i, [str(i % 3), None if i % 4 == 0 else f" {'ab'[i % 2]} "], None if i % 11 == 0 else r.integers(-3, 4, 4).astype(float).tolist(), None if i % 5 else r.integers(0, 3, 2).astype(float).tolist()) for i in range(n)]
    left, right = rows(90), rows(70)
    e = spark.createDataFrame(left, "enrichment_row_index long, e array<string>, e_v0 array<float>, e_v1 array<float>")
    m = spark.createDataFrame(right, "master_row_index long, m array<string>, m_v0 array<float>, m_v1 array<float>")
    got = {}
    for x in rowmatch.nearest_rows(e, m, [0, 1], 2, 2).collect():
        got.setdefault(x.enrichment_row_index, set()).add(x.master_row_index)
    for i, k, *v in left:
        best = []
        for j, l, *w in right:
            if k[0] == l[0] and (k[1] is None or l[1] is None or k[1] == l[1]):
                scores = [np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) for a, b in zip(v, w, strict=True) if a and b and any(a) and any(b)]
                if scores:
                    best.append((-round(float(np.mean(scores)), 9), j))
        assert got.get(i, set()) == {j for _, j in sorted(best)[:2]}


def test_arrivals(spark, sides, tmp_path):
    e, m = sides
    e.drop("enrichment_row_index").write.parquet(f"{tmp_path}/in")
    got = []
    stream = spark.readStream.schema(e.drop("enrichment_row_index").schema).parquet(f"{tmp_path}/in")
    match_arrivals(stream, m.drop("master_row_index"), MAPPING, "A", lambda df, n: got.extend(df.collect()), f"{tmp_path}/checkpoint").awaitTermination()
    assert [r.enrichment_evidence for r in got] == ["zone: z; city: Rome ; name: ACME, corp"]
    first = {r.enrichment_row_index for r in got}
    e.drop("enrichment_row_index").write.mode("append").parquet(f"{tmp_path}/in")
    match_arrivals(stream, m.drop("master_row_index"), MAPPING, "A", lambda df, n: got.extend(df.collect()), f"{tmp_path}/checkpoint").awaitTermination()
    assert len(got) == 2 and len({r.enrichment_row_index for r in got}) == 2 and max(first) < BATCH_ROWS < got[1].enrichment_row_index


