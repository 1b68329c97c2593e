"""The fitted detector of languages: held-out accuracy, persistence, edges."""

from pyspark.sql import functions as F

from matchloom.operators import detector, language
from matchloom.sources.tables import save


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet".replace("sf0.001", "sf0.01")).select("doc_id", "text", "lang")
    share = detector.sample_share(docs, "lang")
    assert share == 0.5 and detector.sample_share(docs, "lang", 10) < 0.011
    fitted = save(detector.fit_languages(docs, "text", "lang", "doc_id", share), "fitted_languages")
    found = detector.load_languages(fitted)
    assert found == detector.load_languages(spark.table("fitted_languages")) and len(found.labels) == 4
    rest = docs.where(~detector.drawn(F.col("doc_id"), share)).withColumn("told", detector.language_of(F.col("text"), found))
    tally = {r.lang: (r.n, r.good) for r in rest.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("told") == F.col("lang")).alias("good")).collect()}
    assert 400 < sum(n for n, _ in tally.values()) < 600 and all(good >= 0.95 * n for n, good in tally.values()), tally
    # as the detector of the English test, on texts that aren't plain ASCII
    odd = docs.where("text RLIKE '[^ -~\\\\s]'").select("lang", language.is_english(F.col("text"), found).alias("english"))
    assert odd.where("lang != 'en'").agg(F.avg(F.col("english").cast("int"))).first()[0] < 0.05
    spark.sql("DROP TABLE fitted_languages")


def test_edges(spark):
    rows = [(1, "der die das und", "de"), (2, "the of and to", "en"), (3, None, "de"), (4, "x", None), (5, "", "en"), (6, "12 34", "en")]
    df = spark.createDataFrame(rows, "k int, t string, l string")
    found = detector.load_languages(detector.fit_languages(df, "t", "l", "k", 1.0))
    assert found.labels == ("de", "en") and found.best("und das") == "de" and found.best("the and") == "en"
    assert found.best(None) is None and found.best("") is None and found.best("12") is None and found("12") == 1.0
    assert found("the and of") > 0.8 > found("die und der")
    told = df.select(detector.language_of(F.col("t"), found).alias("x")).collect()
    assert [r.x for r in told][:3] == ["de", "en", None] and told[4].x is None and told[5].x is None
    nothing = detector.load_languages(detector.fit_languages(df.limit(0), "t", "l", "k", 1.0))
    assert nothing.labels == () and nothing.best("a") is None and nothing("a") == 0.0
    # whole words of a language, counted with their frequency
    n = {(r.label, r.three): r.n for r in detector.fit_languages(df.union(df), "t", "l", "k", 1.0).collect()}
    assert n["de", " de"] == 2 and n["en", "the"] == 2 and n["de", "er "] == 2
