"""The shape of physical plans: what reaches the scan, and what must not be there."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks.registry import CHECKS
from conftest import physical_plan
from narrata.operators import chunk, clean, embed, nearest, profile, sample, validate
from narrata.params import JobParams
from narrata.session import pinned_if_small, scratch_path

DATA = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin"]
WRITERS = ["index_build", "ingest", "incremental", "store", "reset", "roundtrip", "copy", "answer_batch"]


@pytest.mark.parametrize("name", [n for n in CHECKS if not any(w in n for w in WRITERS)])
def test_no_cross_join(spark, name):
    plan = physical_plan(CHECKS[name][0](spark, DATA))
    assert not [f for f in FORBIDDEN if f in plan]


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_product_filter_and_pruning_reach_the_scan(spark):
    kept = clean.filter_by_products(documents(spark), ["en"], "lang").select("doc_id")
    plan = physical_plan(kept)
    assert "PushedFilters: [In(lang, [en])" in plan or "EqualTo(lang,en)" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_statistics_read_one_column(spark):
    plan = physical_plan(profile.length_stats(documents(spark), "text"))
    assert plan.count("ReadSchema: struct<text:string>") == plan.count("ReadSchema") == 1
    assert "Python" not in plan


def test_python_runs_once(spark):
    splitter = chunk.recursive_splitter()
    frames = [
        chunk.chunk_table(documents(spark), "text", "doc_id", splitter, ["lang"]),
        chunk.chunk_stats(documents(spark), "text", splitter),
        chunk.chunk_length_histogram(documents(spark), "text", splitter).select("bin", "n"),
        embed.embed_table(documents(spark), "text").select("doc_id", "embedding"),
        CHECKS["hash_embed"][0](spark, DATA),
    ]
    counts = [physical_plan(f).count("ArrowEvalPython") for f in frames]
    assert counts[:2] + counts[3:] == [1, 1, 1, 1], counts


def test_search_runs_once_per_answer_batch(spark):
    plan = physical_plan(CHECKS["evaluation_markdown"][0](spark, DATA).filter("part = 2"))
    assert plan.count("MapInArrow") == 1


def test_funnel_reads_two_columns_once(spark):
    plan = physical_plan(clean.filter_funnel(documents(spark), ["en"], "lang", "text"))
    assert plan.count("ReadSchema") == 1 and "struct<text:string,lang:string>" in plan


def test_duplicate_count_moves_hashes(spark):
    plan = physical_plan(validate.duplicate_rows(documents(spark).drop("doc_id")))
    assert "sha2(" in plan and "hashpartitioning(_groupingexpression" in plan


def test_sample_joins_its_cuts_by_broadcast_without_a_hint(spark):
    drawn = sample.stratified_sample(documents(spark), 50, "lang", "doc_id")
    plan = physical_plan(drawn)
    assert "BroadcastHashJoin" in plan and "LocalTableScan" in plan


def test_search_scans_ids_and_vectors_only(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").withColumn("text", F.lit("t"))
    asked = table.limit(3).select(
        F.col("vec_id").alias("question_id"), F.col("embedding").alias("question_embedding")
    )
    plan = physical_plan(nearest.nearest(table, asked, id_col="vec_id"))
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in plan
    assert "WindowGroupLimit" in plan


def test_repeated_counts_share_one_shuffle(spark):
    """The total is a scalar subquery over the same grouped counts; the shuffle is run once."""
    df = profile.category_distribution(documents(spark), "lang")
    df.collect()
    assert "ReusedExchange" in physical_plan(df)


def test_control_tables_stay_distributed_beyond_the_bound(spark):
    df = spark.range(100)
    assert "LocalTableScan" in physical_plan(pinned_if_small(df, 100))
    assert pinned_if_small(df, 99) is df


def test_scratch_folder_follows_the_session():
    """The setting is fixed when a session starts, so stand-ins are asked here."""

    def session(folder, master):
        conf = SimpleNamespace(get=lambda key, default=None: folder)
        return SimpleNamespace(
            conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf)
        )

    shared = scratch_path(session("hdfs://shared/", "yarn"), "x")
    assert shared.startswith("hdfs://shared/narrata-x-")
    assert scratch_path(session(None, "local[8]"), "x").endswith("/x")
    with pytest.raises(ValueError):
        scratch_path(session(None, "spark://host:7077"), "x")


def test_parameters_from_the_environment(monkeypatch):
    for name, text in {"CHUNK_SIZE": "300", "STRATIFY_COLUMN": "Issue", "NORMALIZE_EMBEDDINGS": "False"}.items():
        monkeypatch.setenv(name, text)
    params = JobParams.from_environment(chunk_overlap=0)
    assert (params.chunk_size, params.chunk_overlap, params.stratify_col) == (300, 0, "Issue")
    assert params.normalize is False and params.sample_size == 12_500


def test_parameters_are_checked():
    for bad in (
        {"sample_size": 0}, {"seed": -1}, {"min_per_stratum": 0}, {"chunk_size": 0},
        {"chunk_overlap": 500}, {"splitter": "x"}, {"top_k": 0},
    ):
        with pytest.raises(ValueError):
            JobParams(**bad)
