"""Schemas of the tables between the steps."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
    "array<double>": T.ArrayType(T.DoubleType()),
    "array<float>": T.ArrayType(T.FloatType()),
}


def schema(text: str) -> T.StructType:
    """A schema from ``name kind, ...``; needs no session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (x.split() for x in text.split(", "))])


METADATA = schema("dataset string, column_name string, data_type string, example_values array<string>, description string")
PAIR_FEATURES = schema(
    "master_dataset string, enrichment_dataset string, master_column string, enrichment_column string, master_description string, enrichment_description string, "
    "master_data_type string, enrichment_data_type string, master_example_values array<string>, enrichment_example_values array<string>, status string, type_mismatch boolean, "
    "master_fill_rate double, enrichment_fill_rate double, fuzzy_ratio double, fuzzy_token_sort_ratio double, fuzzy_token_set_ratio double, description_similarity double, "
    "overlap_master double, overlap_enrichment double, overlap_jaccard double, avg_length_diff double, master_entropy double, enrichment_entropy double, entropy_gap double"
)
CLASSIFIED_PAIRS = T.StructType([*PAIR_FEATURES.fields, *schema("decision string, justification string").fields])
COLUMN_MATCHES = schema(
    "master_column string, enrichment_dataset string, enrichment_column string, enrichment_candidates string, weighted_score double, percent_master_in_enrichment double, percent_enrichment_in_master double"
)
ROW_MATCHES = schema(
    "enrichment_row_index long, master_row_index long, master_dataset string, enrichment_dataset string, enrichment_evidence string, master_evidence string, similarity array<double>, avg_similarity double"
)
JUDGED_MATCHES = T.StructType([*ROW_MATCHES.fields, *schema("final_llm_decision string, final_llm_justification string").fields])
EMBEDDING_LOOKUP = schema("norm string, emb array<float>")
