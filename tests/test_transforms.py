"""Transforms found from examples."""

import pytest
from pyspark.sql import functions as F

from matchloom.config import Config
from matchloom.functions.clients import OfflineModel
from matchloom.operators import transforms
from matchloom.plans import pipeline


def found(spark, enrichment, master, depth=2, keep=1):
    top = spark.createDataFrame([("e", "c", x) for x in enrichment] + [("m", "k", x) for x in master], "dataset string, column_name string, value string")
    known = top.where("dataset = 'm'").select("column_name", "value")
    return [(list(r.program), r.n_found, r.n_values) for r in transforms.find_transforms(top, known, [("c", "k")], depth, keep).orderBy("rank").collect()]


@pytest.mark.parametrize(
    ("enrichment", "master", "program"),
    [
        (["a", "b"], ["a", "b"], []),
        (["ACME ", "Bolt"], ["acme", "bolt"], ["lower"]),
        (["Smith, John", "Doe, Jane"], ["JOHN", "JANE"], ["upper", "second_by_comma"]),
        (["x@Acme.com", "y@Bolt.org"], ["acme", "bolt"], ["first_by_dot", "last_by_at", "lower"]),
        (["no 7", "no 12"], ["K-0007", "K-0012", "K-1013"], ["digits", "pad:4", "prefix:K-"]),
        (["12 (old)", "13"], ["00012", "00013"], ["no_brackets", "pad:5"]),
    ],
)
def test_programs(spark, enrichment, master, program):
    best = found(spark, enrichment, master, depth=3)[0]
    made = spark.createDataFrame([(x,) for x in enrichment], "x string").select(transforms.run(best[0], F.col("x")).alias("x")).collect()
    assert all(r.x in master for r in made) and best[1] == len(set(enrichment))
    assert len(best[0]) == len(program)  # the simplest; of equal ones the first in the catalogue's order
    again = spark.createDataFrame([(x,) for x in enrichment], "x string").select(transforms.run(program, F.col("x")).alias("x")).collect()
    assert made == again


def test_edges(spark):
    assert found(spark, [], ["a"]) == [] and found(spark, ["a"], []) == [] and found(spark, [None, ""], ["b", None]) == []
    assert found(spark, ["a", None], ["a", None])[0] == ([], 1, 1)
    assert found(spark, ["q"], ["zz"]) == []
    # programs that make all values the same one lose against those that tell them apart
    assert found(spark, ["0-1", "0-2"], ["0", "1", "2"])[0] == (["second_by_dash"], 2, 2)
    df = spark.createDataFrame([(None, 1), ("Az-7", 2)], "`a b` string, n int")
    assert [r[-1] for r in transforms.transform_by(df, "a b", ["digits", "pad:3", "prefix:P"]).orderBy("n").collect()] == [None, "P007"]
    with pytest.raises(ValueError, match="no step"):
        transforms.run(["eval"], F.lit("x"))


def test_prepared_values(spark):
    """The pipeline takes the composed transform where no entry of the catalogue does as well."""
    data = {"Master": spark.createDataFrame([(f"No {k:04d}",) for k in range(20)], "code string"), "other": spark.createDataFrame([(f"item {k}/b",) for k in range(20)], "ref string")}
    out = pipeline.prepare_values(data, {"other": [("ref", "code", False)]}, Config(), OfflineModel())["other"]
    assert sorted(r["ref__TRANSFORMED"] for r in out.collect()) == [f"No {k:04d}" for k in range(20)]
    plain = pipeline.prepare_values(data, {"other": [("ref", "code", False)]}, Config(transform_depth=0), OfflineModel())["other"]
    assert sorted(r["ref__TRANSFORMED"] for r in plain.collect()) == sorted(f"item {k}/b" for k in range(20))
