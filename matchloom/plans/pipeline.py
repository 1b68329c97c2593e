"""Column alignment, value preparation, row matching and adjudication, end to end."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import is_dataclass, replace

from pyspark.sql import DataFrame

from matchloom.config import Config, ModelSettings
from matchloom.functions.clients import Embedder, HashedNgrams, LanguageModel, PromptModel, connect
from matchloom.functions.english import probability
from matchloom.functions.text import quote
from matchloom.operators import adjudicate, language, pairs, profile, rowmatch, select, transforms
from matchloom.schemas import CLASSIFIED_PAIRS, COLUMN_MATCHES, JUDGED_MATCHES, METADATA, PAIR_FEATURES, ROW_MATCHES
from matchloom.sources.intermediate import materialize, scratch
from matchloom.sources.steps import Steps
from matchloom.sources.tables import load_into, namespace, save, with_decision


def _told(x: object) -> str:
    """What stands for a client, an embedder or a detector in keys: the values of a dataclass, else a name. Settings of models are in the keys besides."""
    if isinstance(x, PromptModel):
        return f"asks {_told(x.complete)}"
    if is_dataclass(x):
        return repr(x)
    kind = x if hasattr(x, "__qualname__") else type(x)
    return f"{kind.__module__}.{kind.__qualname__}"


def _inputs(datasets: Mapping[str, DataFrame], steps: Steps) -> dict[str, str]:
    return {name: steps.input(df) for name, df in datasets.items()}


def align_columns(datasets: Mapping[str, DataFrame], config: Config | None = None, client: LanguageModel | None = None, embedder: Embedder | None = None, keep: Callable[[str, DataFrame], None] | None = None, steps: Steps | None = None, inputs: Mapping[str, str] | None = None) -> DataFrame:
    """The column map of the master and the other datasets. What a model says is written before it is used, so that it is asked once.

    ``keep`` gets the tables between the steps by name: metadata, pair_features and classified_pairs. Steps that ``steps`` has aren't made
    again; ``inputs`` are the fingerprints of the datasets where they are known.
    """
    config = config or Config()
    client, embedder = client or connect(config.models), embedder or HashedNgrams(config.models.embedding_width)
    steps = steps or Steps(next(iter(datasets.values())).sparkSession)
    inputs = inputs or _inputs(datasets, steps)
    key = steps.key("columns", sorted(inputs.items()), config.num_examples, config.typing_sample, config.models, _told(client), _told(embedder), config.master)
    short = bool(config.typing_sample)  # types and examples of a sample: no other step asks for the texts
    counts = steps.table("value-counts", steps.key("value-counts", sorted(inputs.items()), short), lambda: profile.value_counts(datasets, short))
    described = steps.table("metadata", steps.key("metadata", key), lambda: language.describe_columns(profile.metadata(datasets, config.num_examples, config.typing_sample, counts), client))

    def featured() -> DataFrame:
        vectors = language.on_distinct(described, "description", lambda v: language.embed_values(v, embedder)).withColumnRenamed("result", "vector")
        return pairs.pair_features(datasets, vectors, config.master, counts)

    features = steps.table("pair-features", steps.key("pair-features", key), featured)
    judged = steps.table("classified-pairs", _classified_key(steps, key, config), lambda: language.judge_column_pairs(select.filter_pairs(features, config.thresholds), client))
    for name, df, schema in (("metadata", described, METADATA), ("pair_features", features, PAIR_FEATURES), ("classified_pairs", judged, CLASSIFIED_PAIRS)):
        if keep:
            keep(name, load_into(df, schema))
    return select.column_matches(judged, pairs.overlap(counts, config.master), config.weights, config.master)


def _classified_key(steps: Steps, key: str, config: Config) -> str:
    """Of the thresholds only those of column pairs count."""
    return steps.key("classified-pairs", key, replace(config.thresholds, overlap_percent=0, fuzzy_similarity=0, embedding_top_n=0))


def prepare_values(datasets: Mapping[str, DataFrame], mapping: Mapping[str, list[tuple[str, str, bool]]], config: Config, client: LanguageModel, detector: Callable[[str], float] | None = probability, steps: Steps | None = None, inputs: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Translates the mapped columns and adds the transformed ones; the client chooses the transform of a column by both sides' frequent values,
    from the catalogue and the best program that ``find_transforms`` composes (none with a ``transform_depth`` of 0).

    A dataset is written when its columns are translated, and again with the transformed ones: nothing later asks the model again. The
    master's values are counted once for all.
    """
    out = dict(datasets)
    steps = steps or Steps(datasets[config.master].sparkSession)
    inputs = inputs or _inputs(datasets, steps)
    masters = sorted({p[1] for pairs_ in mapping.values() for p in pairs_})
    if not masters:
        return out
    every = steps.table("master-values", steps.key("master-values", inputs[config.master], masters), lambda: profile.value_counts({"m": datasets[config.master].select(*[quote(c) for c in masters])}))

    def prepared(name: str, pairs_: list[tuple[str, str, bool]]) -> DataFrame:
        df = datasets[name]
        for column in dict.fromkeys(p[0] for p in pairs_):
            df = language.translate_column(df, column, client, detector)
        df = materialize(df, "translated")
        own = profile.value_counts({"e": df.select(*[quote(c) for c in dict.fromkeys(p[0] for p in pairs_)])})
        seen = materialize(profile.top_values(own.unionByName(every), config.transform_examples), "frequent-values")
        wanted = [(e, m) for e, m, _ in pairs_]
        hits, programs = language.transform_hits(seen, wanted), {}
        if config.transform_depth:
            for r in transforms.find_transforms(seen, every, wanted, config.transform_depth).collect():  # one for each mapped pair
                programs[r.e_column, transforms.label(r.program)] = r.program
                hits[r.e_column, r.m_column][transforms.label(r.program)] = r.n_found
        top: dict[tuple[str, str], list[str]] = {}
        for r in seen.orderBy("rank").collect():  # at most 50 values for each mapped column
            top.setdefault((r.dataset, r.column_name), []).append(r.value)
        for (column, master_column), n in hits.items():
            chosen = client.choose_transform(top.get(("e", column), []), top.get(("m", master_column), []), n)
            program = programs.get((column, chosen)) if chosen not in language.TRANSFORMS else None
            df = transforms.transform_by(df, column, program) if program else language.transform_column(df, column, chosen)
        return df

    for name, pairs_ in mapping.items():
        key = steps.key("prepared", inputs[name], inputs[config.master], pairs_, config.transform_examples, config.transform_depth, config.models, _told(client), _told(detector))
        out[name] = steps.table(f"prepared {name}", key, lambda name=name, pairs_=pairs_: prepared(name, pairs_))
    return out


def match_rows(datasets: Mapping[str, DataFrame], mapping: Mapping[str, list[tuple[str, str, bool]]], config: Config | None = None, embedder: Embedder | None = None) -> DataFrame:
    """Candidate row pairs of all datasets: fuzzy, or by embeddings if an embedder is given."""
    config = config or Config()
    master = rowmatch.row_index(datasets[config.master], "master_row_index")
    parts = []
    for name, pairs_ in mapping.items():
        rows = rowmatch.row_index(datasets[name], "enrichment_row_index", [c for c in datasets[name].columns if not c.endswith("__TRANSFORMED")])
        if config.use_transformed:
            pairs_ = [(f"{e}__TRANSFORMED" if f"{e}__TRANSFORMED" in rows.columns else e, m, f) for e, m, f in pairs_]
        if embedder is None:
            parts.append(rowmatch.match_fuzzy(rows, master, pairs_, name, config.thresholds.fuzzy_similarity, config.master, config.max_cross_pairs, config.max_pairs, index=True))
        else:
            parts.append(rowmatch.match_embedded(rows, master, pairs_, name, embedder, config.thresholds.embedding_top_n, config.master, config.max_cross_pairs, config.store and f"{config.store}/vectors"))
    return rowmatch.union_matches(parts, datasets[config.master].sparkSession)


def resolve(datasets: Mapping[str, DataFrame], config: Config | None = None, client: LanguageModel | None = None, embedder: Embedder | None = None, detector: Callable[[str], float] | None = probability, complete: Callable[[str, ModelSettings], str] | None = None, keep: Callable[[str, DataFrame], None] | None = None, steps: Steps | None = None) -> DataFrame:
    """Everything: judged row pairs of all datasets against the master, as a written table.

    ``complete`` plugs in a language model: it gets each prompt with the settings of ``config.models``. Every value, column and pair is asked
    once, however often the result is read. ``keep`` gets the tables between the steps by name. With ``config.store``, or ``steps`` of a
    folder, a run goes on where one with equal datasets and settings stopped, and one with other settings starts at the first step that
    they touch. Functions of models are known by their names: a model that changes under its name asks for another ``config.models``.
    """
    config = config or Config()
    client = client or connect(config.models, complete, store=config.store and f"{config.store}/replies")
    steps = steps or Steps(datasets[config.master].sparkSession, config.store and f"{config.store}/steps")
    inputs = _inputs(datasets, steps)
    told = (sorted(inputs.items()), config.num_examples, config.typing_sample, config.models, _told(client), config.master)
    columns = steps.key("column-matches", _classified_key(steps, steps.key("run", *told), config), config.weights)
    align = lambda: align_columns(datasets, config, client, keep=keep, steps=steps, inputs=inputs)
    aligned = align() if keep else None  # its tables are wanted, whether they are new or not
    found = steps.table("column-matches", columns, lambda: aligned or align())
    mapping = select.column_map(found, config.thresholds.overlap_percent)
    rows = steps.key("row-matches", columns, mapping, config.transform_examples, config.transform_depth, _told(detector), config.use_transformed, config.max_cross_pairs, config.max_pairs, embedder and _told(embedder), config.thresholds.fuzzy_similarity, config.thresholds.embedding_top_n)
    matches = steps.table("row-matches", rows, lambda: match_rows(prepare_values(datasets, mapping, config, client, detector, steps, inputs), mapping, config, embedder))

    def judged_rows() -> DataFrame:
        return adjudicate.judge(matches, client) if embedder is None else adjudicate.adjudicate(matches, client, config.adjudication, config.thresholds.embedding_top_n)

    judged = steps.table("judged-matches", steps.key("judged-matches", rows, config.adjudication), judged_rows)
    for name, df, schema in (("column_matches", found, COLUMN_MATCHES), ("row_matches", matches, ROW_MATCHES), ("judged_matches", judged, JUDGED_MATCHES)):
        if keep:
            keep(name, load_into(df, schema))
    return judged


def resolve_to_tables(datasets: Mapping[str, DataFrame], database: str | None = None, config: Config | None = None, counts: dict[str, int] | None = None, **options) -> dict[str, DataFrame]:
    """``resolve`` with a table for each step, in ``database`` or the current one, overwritten, and one of the pairs that are judged Yes.

    What is written in between is deleted at the end. ``counts`` gets the rows of each table, observed while it is written. Options are those of ``resolve``.
    """
    spark = next(iter(datasets.values())).sparkSession
    home = namespace(database, spark.catalog.currentDatabase())
    out: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> None:
        written: dict[str, int] = {}
        out[name] = save(df, f"{quote(home)}.{quote(name)}", counts=written)
        if counts is not None:
            counts[name] = next(iter(written.values()))

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(home)}")
    with scratch():
        resolve(datasets, config, keep=keep, **options)
        keep("confirmed_matches", with_decision(out["judged_matches"]))
    return out
