"""Runs that go on, and tables that are overwritten whole or not at all."""

import pytest
from pyspark.sql import functions as F

from matchloom.config import Config, ModelSettings, Thresholds
from matchloom.functions.clients import OfflineModel
from matchloom.operators import adjudicate
from matchloom.plans import pipeline
from matchloom.sources.steps import Steps, fingerprint
from matchloom.sources.tables import save


def test_fingerprint(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")
    assert fingerprint(df) == fingerprint(df.repartition(3).orderBy(F.desc("k")))
    different = [df.dropDuplicates(), df.where("k = 2"), df.withColumnRenamed("v", "w"), df.withColumn("k", F.col("k").cast("long")), df.fillna("a"), df.limit(0)]
    assert len({fingerprint(x) for x in [df, *different]}) == len(different) + 1


def test_steps(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, `a b` string")
    steps = Steps(spark, f"file://{tmp_path}/kept")
    key = steps.key("one", fingerprint(df))
    assert steps.table("one", key, lambda: df).collect() == df.collect()
    again = Steps(spark, str(tmp_path / "kept"))  # with or without a scheme
    assert again.table("one", key, lambda: 1 / 0).collect() == df.collect() and again.kept == ["one"] and not again.made
    broken = df.select(F.raise_error(F.lit("lost")).cast("int").alias("k"))
    with pytest.raises(Exception, match="lost"):
        again.table("two", again.key("two"), lambda: broken)
    assert [e["step"] for e in again.entries().values()] == ["one"]  # no entry for half a table
    assert again.sweep() in (0, 1) and again.table("one", key, lambda: 1 / 0).count() == 1
    again.forget()
    assert again.entries() == {} and again.table("one", key, lambda: df).count() == 1 and again.made == ["one"]


@pytest.fixture
def tables(spark):
    names = [f"{a} {b}" for a in ("Alder", "Birch", "Cedar", "Douglas") for b in ("Works", "Mills", "Foods")]
    master = spark.createDataFrame([(n, c) for n, c in zip(names, ["Oslo", "Lima", "Rome"] * 4, strict=True)], "name string, city string")
    return {"Master": master, "Other": master.select(F.upper("name").alias("company_name"), F.col("city").alias("town"))}


def test_a_stopped_run_goes_on(spark, tables, tmp_path, monkeypatch):
    config = Config(thresholds=Thresholds(min_description_similarity=0.0), store=f"file://{tmp_path}/store")
    model = OfflineModel()
    with monkeypatch.context() as m:
        m.setattr(adjudicate, "judge", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.resolve(tables, config, model)
    early = {"value-counts", "metadata", "pair-features", "classified-pairs", "column-matches", "master-values", "prepared Other", "row-matches"}
    folder = f"{config.store}/steps"
    assert {e["step"] for e in Steps(spark, folder).entries().values()} == early
    steps = Steps(spark, folder)
    with monkeypatch.context() as m:  # nothing of the steps before is worked out again
        for name in ("align_columns", "prepare_values", "match_rows"):
            m.setattr(pipeline, name, lambda *_, **__: 1 / 0)
        judged = pipeline.resolve(tables, config, model, steps=steps)
    assert steps.made == ["judged-matches"] and set(steps.kept) == {"column-matches", "row-matches"}
    plain = pipeline.resolve(tables, Config(thresholds=config.thresholds), model)
    assert sorted(map(tuple, judged.drop("similarity").collect())) == sorted(map(tuple, plain.drop("similarity").collect())) and judged.count()
    # other settings start where they matter, other rows at the start
    stricter = Config(thresholds=Thresholds(min_description_similarity=0.0, fuzzy_similarity=90), store=config.store)
    steps = Steps(spark, folder)
    pipeline.resolve(tables, stricter, model, steps=steps)
    assert steps.made == ["row-matches", "judged-matches"]
    fewer = {**tables, "Other": tables["Other"].where("town != 'Rome'")}
    steps = Steps(spark, folder)
    pipeline.resolve(fewer, config, model, steps=steps)
    assert "value-counts" in steps.made and "judged-matches" in steps.made and "row-matches" not in steps.kept
    steps = Steps(spark, folder)
    kept = {}
    pipeline.resolve(tables, config, model, keep=kept.__setitem__, steps=steps)
    assert not steps.made and {"metadata", "pair_features", "classified_pairs", "judged_matches"} <= set(kept)
    assert pipeline._told(OfflineModel()) != pipeline._told(OfflineModel({"a": "b"})) and ModelSettings() == ModelSettings()


def test_overwriting(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS whole")
    table = "`whole`.`kept rows`".replace(" ", "_")
    save(spark.range(3), table)
    with pytest.raises(Exception, match="lost"):
        save(spark.range(2).select(F.raise_error(F.lit("lost")).cast("long").alias("id")), table)
    assert spark.table(table).count() == 3  # as it was
    counts = {}
    assert save(spark.table(table).select((F.col("id") + 1).alias("id"), F.lit("x").alias("more")), table, counts=counts).agg(F.sum("id")).first()[0] == 6 and counts == {table: 3}
    spark.sql("ALTER TABLE whole.kept_rows RENAME TO whole.kept_rows__last")  # a switch that stopped half-way
    assert save(spark.range(1), table).count() == 1
    assert [t.name for t in spark.catalog.listTables("whole") if not t.isTemporary] == ["kept_rows"]
    spark.sql("DROP DATABASE whole CASCADE")
