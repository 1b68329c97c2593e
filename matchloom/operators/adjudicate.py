"""Yes, No or Maybe for each candidate row pair: by threshold, by a model for the best of each group, or by a model for all."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.config import Adjudication
from matchloom.functions.clients import LanguageModel, PromptModel, parse_judgement
from matchloom.operators.replies import through_store

#: The reasons given where no model was asked.
BY_THRESHOLD = "LLM not called; backup threshold used"
TOO_LOW = "LLM not called; similarity too low"


def by_threshold(matches: DataFrame, threshold: float = 0.9) -> DataFrame:
    decision = F.when(F.col("avg_similarity") >= threshold, "Yes").otherwise("No")
    return matches.withColumns({"final_llm_decision": decision, "final_llm_justification": F.lit(BY_THRESHOLD)})


def route(matches: DataFrame, settings: Adjudication, top_n: int, ties: Sequence[str] = ("enrichment_dataset", "enrichment_row_index", "master_row_index")) -> DataFrame:
    """Adds route: threshold, llm or low."""
    if settings.ask_top_n <= 0:
        return matches.withColumn("route", F.lit("threshold"))
    if settings.ask_top_n >= top_n:
        return matches.withColumn("route", F.lit("llm"))
    order = W.partitionBy(settings.group).orderBy(F.desc_nulls_last("avg_similarity"), *[F.asc(c) for c in ties])
    return matches.withColumn("route", F.when(F.row_number().over(order) <= settings.ask_top_n, "llm").otherwise("low"))


def judge(matches: DataFrame, client: LanguageModel) -> DataFrame:
    """The model's decision and reason from both evidences; batches on the executors, equal pairs of a batch asked once, of all rows and runs if the client has a store."""
    names = ["final_llm_decision", "final_llm_justification"]
    if isinstance(client, PromptModel) and client.store:
        both = lambda rows: [(r["enrichment_evidence"] or "", r["master_evidence"] or "") for r in rows]
        return through_store(matches, client, lambda rows: client.row_prompts(both(rows)), lambda rows, replies: [parse_judgement(r) for r in replies], names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                pairs = list(zip(batch["enrichment_evidence"].fillna(""), batch["master_evidence"].fillna(""), strict=True))
                different = list(dict.fromkeys(pairs))
                known = dict(zip(different, client.judge_rows(different), strict=True))
                yield batch.assign(final_llm_decision=[known[p][0] for p in pairs], final_llm_justification=[known[p][1] for p in pairs])

    more = [T.StructField(c, T.StringType()) for c in names]
    return matches.mapInPandas(run, T.StructType([*matches.schema.fields, *more]))


def adjudicate(matches: DataFrame, client: LanguageModel, settings: Adjudication | None = None, top_n: int = 3) -> DataFrame:
    """All matches with decision and reason. One plan, written once by the caller: nothing is read while it is overwritten."""
    settings = settings or Adjudication()
    if settings.ask_top_n <= 0:
        return by_threshold(matches, settings.backup_threshold)
    if settings.ask_top_n >= top_n:
        return judge(matches, client)
    routed = route(matches, settings, top_n)
    low = routed.where("route = 'low'").drop("route").withColumns({"final_llm_decision": F.lit("No"), "final_llm_justification": F.lit(TOO_LOW)})
    return judge(routed.where("route = 'llm'").drop("route"), client).unionByName(low)


def as_object(judged: DataFrame) -> DataFrame:
    """Decision and justification as one object, ``final_llm``, and its JSON text, ``final_llm_json``, in place of the two columns."""
    both = F.struct(F.col("final_llm_decision").alias("decision"), F.col("final_llm_justification").alias("justification"))
    return judged.withColumns({"final_llm": both, "final_llm_json": F.to_json(both)}).drop("final_llm_decision", "final_llm_justification")


def tally(judged: DataFrame) -> DataFrame:
    return judged.groupBy("final_llm_decision").agg(F.count(F.lit(1)).alias("n"))
