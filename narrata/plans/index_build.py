"""Index build: filter, sample, chunk, embed, store. Each stage hands on a written table.

A written table cuts the lineage: a lost executor costs the work since the last stage, and the
Python splitter and encoder are not run again by a later stage.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.operators import clean, sample
from narrata.operators.chunk import chunk_table, make_splitter
from narrata.operators.embed import Encoder, embed_table, hashing_encoder
from narrata.operators.profile import profile
from narrata.params import JobParams, require_columns
from narrata.session import local_table, scratch_path
from narrata.sources.store import METADATA_NAMES, VectorTable, project_metadata, records
from narrata.sources.writers import Counted, write_both, write_embeddings, written


@dataclass
class IndexBuild:
    """Paths of the written tables, stage counts, sampling reports, and the profile if asked for."""

    paths: dict[str, str] = field(default_factory=dict)
    counts: DataFrame | None = None
    sampling_report: DataFrame | None = None
    sampling_stats: DataFrame | None = None
    profile: dict[str, DataFrame | None] | None = None
    final: DataFrame | None = None


def _count(df: DataFrame, step: int, stage: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).select(
        F.lit(step).alias("step"), F.lit(stage).alias("stage"), "rows"
    )


def preprocess(
    df: DataFrame,
    params: JobParams,
    folder: str,
    with_sample: bool = True,
    save_filtered: bool = True,
    save_sample: bool = True,
    save_csv: bool = True,
    with_profile: bool = False,
) -> IndexBuild:
    """Filter by product and text, save, draw the stratified sample, save.

    The raw table is read once: the job that writes the filtered rows counts what it reads. Without
    ``save_filtered`` they go to a scratch folder, as all later steps start from them. The products
    are checked by that count too, so when none occurs the error comes after an empty table was written.
    """
    require_columns(df, [params.key_col, params.product_col, params.text_col])
    spark, built = df.sparkSession, IndexBuild()
    counted = Counted(df, *clean.funnel_counts(params.products, params.product_col, params.text_col))
    products = clean.filter_by_products(counted.rows, params.products, params.product_col, must_exist=False)
    filtered = clean.remove_empty_narratives(products, params.text_col)
    if save_filtered:
        built.paths.update(write_both(filtered, folder, "filtered", csv=save_csv, parquet=True))
        filtered = spark.read.schema(filtered.schema).parquet(built.paths["parquet"])
    else:
        filtered = written(filtered, scratch_path(spark, "filtered"))
    loaded, listed, with_text = counted.counts().values()
    clean.require_products(listed > 0, params.products, params.product_col)
    stages = local_table(
        spark,
        {"step": [1, 2, 3], "stage": ["loaded", "product_filter", "narrative_filter"], "rows": [loaded, listed, with_text]},
        "step int, stage string, rows long",
    )
    if with_profile:
        built.profile = profile(filtered, params.product_col, params.text_col)
    built.final = filtered
    if with_sample:
        drawn = sample.stratified_sample(
            filtered, params.sample_size, params.stratify_col, params.key_col, params.seed,
            params.min_per_stratum,
        )
        if save_sample:
            built.paths["sample"] = f"{folder}/stratified_sample.parquet"
            drawn = written(drawn, built.paths["sample"])
        stages = stages.unionByName(_count(drawn, 4, "sample"))
        strata = params.stratify_col
        built.sampling_report = sample.sampling_report(filtered, drawn, strata)
        built.sampling_stats = sample.sampling_stats(filtered, drawn, strata, params.sample_size)
        built.final = drawn
    built.counts = stages
    return built


def build_index(
    df: DataFrame,
    params: JobParams,
    folder: str,
    encoder: Callable[[], Encoder] | None = None,
    table: VectorTable | None = None,
    metadata_names: dict[str, str] | None = None,
    with_embedding: bool = True,
    with_store: bool = True,
    save_embeddings: bool = False,
    **preprocessing,
) -> IndexBuild:
    """The whole job. Stages can be left out; the counts cover the stages that ran."""
    built = preprocess(df, params, folder, **preprocessing)
    spark = df.sparkSession
    splitter = make_splitter(params.splitter, params.chunk_size, params.chunk_overlap)
    metadata = [c for c in params.metadata if c in built.final.columns]
    chunks = chunk_table(built.final, params.text_col, params.key_col, splitter, metadata)
    built.paths["chunks"] = f"{folder}/chunks.parquet"
    chunks = written(chunks, built.paths["chunks"])
    stages = [built.counts, _count(chunks, 5, "chunks")]
    if with_embedding:
        factory = encoder or hashing_encoder(params.embedding_dim)
        vectors = embed_table(chunks, "chunk_text", factory, params.normalize)
        if save_embeddings or with_store:
            # The store reads its load more than once, so it starts from written vectors.
            path = f"{folder}/embeddings.parquet" if save_embeddings else scratch_path(spark, "vectors")
            write_embeddings(vectors, path)
            vectors = spark.read.schema(vectors.schema).parquet(path)
        if save_embeddings:
            built.paths["embeddings"] = path
        if with_store:
            stored_names = METADATA_NAMES if metadata_names is None else metadata_names
            names = {k: v for k, v in stored_names.items() if k in metadata}
            table = table or VectorTable(spark, f"{folder}/vectors.parquet")
            table.add(records(project_metadata(vectors, names)))
            built.paths["vectors"] = table.path
            stages.append(_count(table.read(), 6, "vectors"))
    built.counts = reduce(DataFrame.unionByName, stages)
    return built
