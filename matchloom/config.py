"""Settings of a matching run."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Thresholds:
    max_avg_length_diff: float = 12
    min_fill_rate: float = 0.25
    min_description_similarity: float = 0.3
    high_similarity_override: float = 0.8
    max_entropy_gap: float = 2
    overlap_percent: float = 75
    fuzzy_similarity: float = 75
    embedding_top_n: int = 3
    #: Keep pairs of columns with one name in different datasets.
    allow_same_name: bool = False


@dataclass(frozen=True)
class Weights:
    """Of the features in the weighted score; each enters with its sign as given."""

    fuzzy_ratio: float = 25
    overlap_jaccard: float = 100
    avg_length_diff: float = 50
    entropy_gap: float = 10
    master_fill_rate: float = 100
    enrichment_fill_rate: float = 100


@dataclass(frozen=True)
class ModelSettings:
    """Hyper-parameters that clients of language models and embedders get."""

    model: str = "offline"
    temperature: float = 0.0
    top_p: float = 1.0
    max_tokens: int = 1000
    embedding_width: int = 1024


@dataclass(frozen=True)
class Adjudication:
    """ask_top_n <= 0: no model, ``backup_threshold`` decides; below the matcher's top n: only so many rows for each group are asked; else all."""

    ask_top_n: int = 3
    backup_threshold: float = 0.9
    group: str = "master_row_index"


@dataclass(frozen=True)
class Config:
    thresholds: Thresholds = field(default_factory=Thresholds)
    weights: Weights = field(default_factory=Weights)
    models: ModelSettings = field(default_factory=ModelSettings)
    adjudication: Adjudication = field(default_factory=Adjudication)
    num_examples: int = 10
    #: Rows of each dataset whose values show its types and examples; None: all.
    typing_sample: int | None = 1000
    transform_examples: int = 50
    #: Steps of a composed transform, beside those that the master's values ask for; 0: transforms come from the catalogue alone.
    transform_depth: int = 2
    master: str = "Master"
    #: A folder, shared by runs, of what models have said and embedders have made: ``replies`` and ``vectors`` in it. None: nothing is kept.
    store: str | None = None
    #: Score the transformed values instead of the original ones.
    use_transformed: bool = False
    #: Cross joins of more row pairs than this are refused (fuzzy matches without a filter column need none), and so are blocks that together give more.
    max_cross_pairs: int = 50_000_000
    max_pairs: int = 10**12
