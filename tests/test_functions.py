import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchloom.config import ModelSettings
from matchloom.functions import similarity as sim
from matchloom.functions import text
from matchloom.functions.clients import UNDESCRIBED, HashedNgrams, OfflineModel, PromptModel, parse_decision, parse_judgement, parse_object, strip_fence

GOLDEN = [
    ("COMPANY_NAME", "NAME", 50.0, 50.0, 50.0),
    ("CITY", "HEADQUARTERS_CITY", 38.0952, 38.0952, 38.0952),
    ("acme corp", "corp acme", 44.4444, 100.0, 100.0),
    ("acme corp", "acme corporation ltd", 62.069, 62.069, 62.069),
    ("acme", "acme corp", 61.5385, 61.5385, 100.0),
    ("skanska usa", "turner usa", 47.619, 47.619, 47.619),
    ("", "acme", 0.0, 0.0, 0.0),
    ("", "", 100.0, 100.0, 0.0),
]


@pytest.mark.parametrize("a, b, plain, sort, set_", GOLDEN)
def test_golden_ratios(a, b, plain, sort, set_):
    assert [round(f(a, b), 4) for f in (sim.ratio, sim.token_sort_ratio, sim.token_set_ratio)] == [plain, sort, set_]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@given(st.text("abc é", max_size=30), st.text("abc é", max_size=30))
def test_ratio_properties(a, b):
    assert sim.lcs_length(a, b) == _lcs(a, b)
    for f in (sim.ratio, sim.token_sort_ratio, sim.token_set_ratio):
        assert f(a, b) == f(b, a) and 0 <= f(a, b) <= 100
    if set(a.split()) and set(a.split()) <= set(b.split()):
        assert sim.token_set_ratio(a, b) == 100


def test_udfs_and_cosine(spark):
    df = spark.createDataFrame([("acme", "acme corp", [1.0, 0.0], [1.0, 1.0]), (None, "x", [0.0, 0.0], [1.0, 1.0]), ("y", None, None, [1.0])], "a string, b string, u array<float>, v array<float>")
    rows = df.select(sim.fuzzy_token_set_ratio("a", "b").alias("s"), sim.cosine(F.col("u"), F.col("v")).alias("c"), sim.cosine(F.col("u"), F.col("v"), 0.0).alias("d")).collect()
    assert [r.s for r in rows] == [100.0, None, None]
    assert rows[0].c == pytest.approx(0.5**0.5) and [r.c for r in rows[1:]] == [None, None] and [r.d for r in rows[1:]] == [0.0, 0.0]


def test_token_set_bounds_hold(spark):
    r = random.Random(4)
    words = ["a", "ab", "acme", "corp", "corporation", "of", "x9", "zz"]
    text_ = lambda: " ".join(r.choice(words) for _ in range(r.randint(0, 5)))
    rows = [(text_(), text_()) for _ in range(400)] + [(None, "a"), ("a", None), ("", ""), ("a", "")]
    x = sim.token_set_bounds(sim.token_set(F.col("a")), sim.token_set(F.col("b")))
    settled = 0
    for row in spark.createDataFrame(rows, "a string, b string").select("a", "b", x.alias("x")).collect():
        if row.a is None or row.b is None:
            assert row.x is None
            continue
        score = sim.token_set_ratio(row.a, row.b)
        assert row.x.least <= score <= row.x.most
        settled += row.x.least >= row.x.most
    assert settled > 100


def test_normalize_and_evidence(spark):
    df = spark.createDataFrame([("  Crème,  Brûlée! ",), (None,), ("---",)], "x string")
    assert [r[0] for r in df.select(text.normalize(F.col("x"))).collect()] == ["crme brle", "", ""]
    assert df.select(text.normalize(F.col("x"), unicode_words=True)).first()[0] == "crème brûlée"
    assert [r[0] for r in df.select(text.evidence([("name", F.col("x"))])).collect()][1] == "name: nan"
    assert text.safe_name("9 lives; x") == "c_9_lives_x" and text.quote("a`b") == "`a``b`"


def test_contradiction(spark):
    df = spark.createDataFrame([("A ", "a"), (None, "a"), ("a", "b")], "e string, m string")
    assert [r[0] for r in df.select(text.contradicts_not(F.col("e"), F.col("m"))).collect()] == [True, True, False]


def test_typed_texts(spark):
    df = spark.createDataFrame([("1d",), ("1.5e3",), ("2024",), ("2024-01-02",), ("2024-13-02",)], "x string")
    rows = df.select(text.numeric_text(F.col("x")).alias("n"), text.timestamp_text(F.col("x")).isNotNull().alias("t")).collect()
    assert [r.n for r in rows] == [None, 1500.0, 2024.0, None, None] and [r.t for r in rows] == [False, False, False, True, False]


def test_prompts():
    calls = []

    def complete(prompt, settings):
        calls.append((prompt, settings.temperature))
        if len(calls) == 1:
            raise OSError("busy")
        return '{"decision": "Yes", "justification": "same"}' if "decision" in prompt else "no_punctuation, I think" if "Which" in prompt else "hello" if "Translate" in prompt else '{"a": "first"}'

    model = PromptModel(complete, ModelSettings(temperature=0.5), wait=0.0)
    assert model.judge_rows([("x", "y")]) == [("Yes", "same")] and len(calls) == 2 and calls[1][1] == 0.5
    assert model.judge_columns([{"master_column": "a", "enrichment_column": "b"}]) == [("Yes", "same")]
    assert model.translate(["hola"]) == ["hello"]
    assert model.choose_transform(["A."], ["A"], {"identity": 0, "no_punctuation": 1}) == "no_punctuation" and model.choose_transform([], [], {"lower": 0}) == "identity"
    columns = [{"dataset": "d", "column_name": c, "data_type": "numerical", "example_values": ["1", "2.5"]} for c in "ab"]
    assert model.describe(columns) == ["first", UNDESCRIBED] and "[1, 2.5]" in calls[-1][0]
    with pytest.raises(OSError):
        PromptModel(lambda p, s: (_ for _ in ()).throw(OSError()), retries=1, wait=0.0).translate(["x"])


def test_clients():
    assert parse_decision('"Yes"\nsame') == ("Yes", "same") and parse_decision("perhaps")[0] == "No"
    assert strip_fence("```json\n{}\n```") == "{}"
    assert parse_object('Here: {"a": 1} done') == {"a": 1} and parse_object("[1]") == {} == parse_object("nothing")
    assert parse_judgement('```json\n{"decision": "maybe", "justification": "close"}\n```') == ("Maybe", "close")
    assert parse_judgement("No\nfar") == ("No", "far")
    assert [text.json_safe(x, "numerical") for x in ("1", "1.50", "1e3", "x", None)] == [1, 1.5, 1000.0, "x", None] and text.json_safe("1", "text") == "1"
    assert OfflineModel({"hola": "hello"}).translate(["hola", "x"]) == ["hello", "x"]
    vectors = HashedNgrams(32).embed(["acme", ""])
    assert vectors[1] is None and sum(x * x for x in vectors[0]) == pytest.approx(1)
