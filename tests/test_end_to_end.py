"""Twenty true matches among sixty rows: ten copied, ten changed; renamed and unrelated columns."""

import json
import random
import uuid
from collections import Counter

import pytest

from matchloom.config import Config, ModelSettings, Thresholds
from matchloom.functions.clients import HashedNgrams, OfflineModel
from matchloom.operators import rowmatch
from matchloom.plans import pipeline

MASTER = "account_id string, name string, city string, country string, duns string, industry string"


def _rows():
    r = random.Random(42)
    word = lambda: "".join(r.choice("bcdfghjklmnpqrstvwxz") + r.choice("aeiouy") for _ in range(5)).capitalize()
    row = lambda i: (f"A{i:04d}", f"{word()} {word()}", r.choice(["Rome", "Oslo", "Lima", "Zürich"]) if i % 10 else None, r.choice(["Italy", "Norway", "Peru"]), f"{r.randrange(10**9):09d}" if i % 10 != 5 else None, r.choice(["Energy", "Retail", "Mining"]))
    master = [row(i) for i in range(60)]
    same = [(m[0].replace("A", "B"), *m[1:]) for m in master[:10]]
    same += [(m[0].replace("A", "B"), " ".join(reversed(m[1].upper().split())) + ",", *m[2:]) for m in master[10:20]]
    same += [row(i + 1000) for i in range(40)]
    return master, same


@pytest.fixture(scope="module")
def tables(spark):
    master, same = _rows()
    renamed = "id string, company_name string, hq_city string, country_name string, duns_no string, sector string"
    return {
        "Master": spark.createDataFrame(master, MASTER),
        "Similar": spark.createDataFrame(same, renamed),
        "Unrelated": spark.createDataFrame([(f"S{i}", f"{i}.5", f"2024-01-{i % 28 + 1:02d}") for i in range(60)], "sku string, price string, sold_on string"),
    }


def _truth(tables):
    return {f"B{i:04d}" for i in range(20)}


def test_alignment(tables):
    config = Config(thresholds=Thresholds(min_description_similarity=0.0))
    found = {(r.enrichment_dataset, r.enrichment_column, r.master_column) for r in pipeline.align_columns(tables, config).collect()}
    assert {("Similar", "company_name", "name"), ("Similar", "hq_city", "city")} <= found
    assert not [x for x in found if x[0] == "Unrelated"]


@pytest.mark.parametrize("embedder", [None, HashedNgrams(256)])
def test_rows(tables, embedder):
    mapping = {"Similar": [("country_name", "country", True), ("hq_city", "city", True), ("company_name", "name", False)]}
    matches = pipeline.match_rows(tables, mapping, embedder=embedder)
    ids = rowmatch.row_index(tables["Similar"], "enrichment_row_index").select("enrichment_row_index", "id")
    masters = rowmatch.row_index(tables["Master"], "master_row_index").select("master_row_index", "account_id")
    limit = 75 if embedder is None else 0.9
    good = matches.where(f"avg_similarity >= {limit}").join(ids, "enrichment_row_index").join(masters, "master_row_index").collect()
    pairs = {(r.id, r.account_id) for r in good}
    right = {(b, b.replace("B", "A")) for b in _truth(tables)}
    assert len(pairs & right) >= (20 if embedder is None else 10) and len(pairs - right) <= 1


def test_resolve(tables):
    config = Config(thresholds=Thresholds(min_description_similarity=0.0))
    judged = pipeline.resolve(tables, config, OfflineModel({"Zürich": "Zurich"}))
    assert judged.where("final_llm_decision = 'Yes'").count() >= 1
    best = rowmatch.by_similarity(judged).first()  # ids are mapped too, and differ in a letter
    assert best.avg_similarity > 90 and best.final_llm_decision == "Yes"


def answering(folder):
    """A model behind a function: it notes each prompt and its settings, and wraps its replies as models do."""
    rules = OfflineModel()

    def complete(prompt, settings):
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            json.dump([prompt, settings.model, settings.max_tokens], f)
        head, _, rest = prompt.partition("\n")
        if head.startswith("Describe"):
            return "```json\n" + json.dumps({c: f"the {c} of a company" for c in json.loads(rest)}) + "\n```"
        if head.startswith("Do these two columns"):
            sides = json.loads(rest)
            good = rules.judge_columns([{f"{s}_column": sides[s]["column"] for s in sides} | {"overlap_jaccard": 0.0}])[0][0]
            return f'Sure: {{"decision": "{good.lower()}", "justification": "names"}}'
        if head.startswith("Translate"):
            return rest.replace("Zürich", "Zurich")
        if head.startswith("Do these two records"):
            a, b = (x[3:] for x in rest.split("\n", 1))
            return rules.judge_rows([(a, b)])[0][0] + "\nby evidence"
        return "`lower`" if head.startswith("Which transform") else 1 / 0

    return complete


def test_a_model_is_asked_once(spark, tables, tmp_path):
    config = Config(thresholds=Thresholds(min_description_similarity=0.0), models=ModelSettings(model="house", max_tokens=77))
    out = pipeline.resolve_to_tables(tables, "resolved", config, complete=answering(tmp_path))
    assert set(out) == {"metadata", "pair_features", "classified_pairs", "column_matches", "row_matches", "judged_matches", "confirmed_matches"}
    assert out["metadata"].where("description LIKE 'the % of a company'").count() == sum(len(t.columns) for t in tables.values())
    for _ in range(2):  # reading asks nothing
        assert out["judged_matches"].where("final_llm_decision = 'Yes'").count() == out["confirmed_matches"].count() >= 1
    asked = [json.loads(f.read_text()) for f in tmp_path.iterdir()]
    assert {(m, n) for _, m, n in asked} == {("house", 77)}
    heads = Counter(p.split("\n")[0].split(" ")[0] for p, _, _ in asked)
    assert heads["Describe"] == 3 and heads["Translate"] >= 1 and heads["Which"] >= 1
    repeated = {p: n for p, n in Counter(p for p, _, _ in asked if not p.startswith("Do these two records")).items() if n > 1}
    assert not repeated  # equal pairs of evidence in different batches may be asked again
    assert len([p for p, _, _ in asked if p.startswith("Do these two records")]) <= out["row_matches"].count()
    spark.sql("DROP DATABASE resolved CASCADE")
