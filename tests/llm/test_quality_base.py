"""The fixed statistics of texts need no fit."""

import __spark_entry__ as entry


def test_base_reads_documents_only(spark, sf):
    found = entry.queries()["quality_base"](spark, sf)
    assert all("documents.parquet" in f for f in found.inputFiles()) and found.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
