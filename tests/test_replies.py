"""Replies and vectors that survive failures and are shared by runs."""

import os
import sys
import threading
import time
from dataclasses import dataclass, replace

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from matchloom.config import Config, ModelSettings
from matchloom.functions.clients import HashedNgrams, PromptModel
from matchloom.operators import adjudicate, language, replies
from matchloom.plans.pipeline import resolve
from matchloom.schemas import ROW_MATCHES

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors don't have the tests


@dataclass(frozen=True)
class Asked:
    """Writes down each call in a folder; fails on a marked prompt as long as ``broken`` is there."""

    folder: str
    broken: str = ""

    def __call__(self, prompt, settings):
        if self.broken and os.path.exists(self.broken) and "fail" in prompt:
            raise OSError("no answer")
        with open(f"{self.folder}/calls-{os.getpid()}-{threading.get_ident()}", "a") as f:
            f.write(repr(prompt) + "\n")
        last = prompt.rpartition("\n")[2]
        return '{"decision": "Yes", "justification": "same"}' if "JSON" in prompt else last.upper()


def calls(folder):
    return sorted(line for name in os.listdir(folder) if name.startswith("calls") for line in open(f"{folder}/{name}"))


@pytest.fixture
def model(tmp_path):
    (tmp_path / "calls").mkdir()
    return PromptModel(Asked(str(tmp_path / "calls"), str(tmp_path / "broken")), retries=0, wait=0.0, store=f"file://{tmp_path}/store", threads=4, in_flight=8)


def test_a_failed_run_is_not_asked_again(spark, tmp_path, model):
    model = replace(model, in_flight=4)  # one task: none that the failure of another stops
    prompts = spark.createDataFrame([(f"prompt {k % 200}",) for k in range(400)] + [("fail here",), (None,)], "prompt string").repartition(5)
    (tmp_path / "broken").touch()
    with pytest.raises(Exception, match="no answer"):
        replies.ask_all(prompts, model)
    done = calls(tmp_path / "calls")
    assert 0 < len(done) and len(set(done)) == len(done) and replies.read_store(spark, model.store).count() == len(done)
    os.remove(tmp_path / "broken")
    found = {r.key: r.reply for r in replies.ask_all(prompts, model).collect()}
    done = calls(tmp_path / "calls")
    assert len(found) == 201 and len(done) == len(set(done)) == 201 and "PROMPT 7" in found.values()
    assert replies.compact(spark, model.store) == 201 and len(replies._listed(model.store)) <= 16
    assert len(replies.ask_all(prompts, model).collect()) == 201 and len(calls(tmp_path / "calls")) == 201
    other = PromptModel(model.complete, ModelSettings(temperature=0.7), store=model.store)  # other settings are other prompts
    assert replies.ask_all(prompts.where("prompt = 'prompt 1'"), other).count() == 1 and len(calls(tmp_path / "calls")) == 202


def test_a_try_again_reads_what_the_first_appended(spark, tmp_path, model):
    part = f"replies-run-{3:06d}-"
    replies._append(model.store, f"{part}a.parquet", [("k", "p", "r")])
    assert replies._appended(model.store, part) == {"k": "r"} and replies._appended(model.store, "replies-run-000004-") == {}


def test_calls_at_once(tmp_path):
    slow = PromptModel(lambda p, s: time.sleep(0.2) or p, threads=8)
    began = time.time()
    assert slow.ask_each([str(k) for k in range(16)]) == [str(k) for k in range(16)] and time.time() - began < 1.6


def test_operators_ask_once(spark, tmp_path, model):
    words = spark.createDataFrame([("größe",), ("größe",), ("straße",), ("plain",), (None,)], "x string")
    never = lambda t: 0.0
    for _ in range(2):
        assert sorted(r.x or "" for r in language.translate_column(words, "x", model, never).collect()) == ["", "GRÖSSE", "GRÖSSE", "STRASSE", "plain"]
    assert len(calls(tmp_path / "calls")) == 2
    rows = spark.createDataFrame([("M", "E", 1, 1, "a", "b", 1.0, [1.0]), ("M", "E", 2, 2, "a", "b", 1.0, [1.0])], "master_dataset string, enrichment_dataset string, enrichment_row_index long, master_row_index long, enrichment_evidence string, master_evidence string, avg_similarity double, similarity array<double>")
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ROW_MATCHES.fields])
    assert [r.final_llm_decision for r in adjudicate.judge(rows, model).collect()] == ["Yes", "Yes"]
    assert len(calls(tmp_path / "calls")) == 3


@dataclass(frozen=True)
class Counted:
    inner: HashedNgrams
    folder: str

    def embed(self, texts):
        with open(f"{self.folder}/calls-{os.getpid()}", "a") as f:
            f.writelines(f"{t}\n" for t in texts)
        return self.inner.embed(texts)


def test_vectors_last(spark, tmp_path):
    embedder, store = Counted(HashedNgrams(8), str(tmp_path)), f"file://{tmp_path}/vectors"
    values = lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    first = {r.norm: r.emb for r in language.embedding_lookup(values("a", "b", "b", None), embedder, store).collect()}
    again = {r.norm: r.emb for r in language.embedding_lookup(values("b", "c", "a"), embedder, store).collect()}
    assert set(again) == {"a", "b", "c"} and again["a"] == first["a"] and calls(tmp_path) == ["a\n", "b\n", "c\n"]
    wider = Counted(HashedNgrams(16), str(tmp_path))  # another model finds none of these
    assert len(language.embedding_lookup(values("a"), wider, store).first().emb) == 16 and len(calls(tmp_path)) == 4


def test_a_second_run_asks_nothing(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    master = spark.createDataFrame([(f"Company {k}", f"c{k % 3}") for k in range(30)], "name string, city string")
    other = spark.createDataFrame([(f"company {k}", f"c{k % 3}") for k in range(0, 30, 2)], "name string, city string")
    config = Config(store=f"file://{tmp_path}/kept")
    found = []
    for _ in range(2):
        rows = resolve({"Master": master, "Other": other}, config, complete=Asked(str(tmp_path / "calls")))
        found.append((rows.count(), len([c for c in calls(tmp_path / "calls") if "Describe" not in c and "transform" not in c])))
    assert found[0] == found[1]
