"""Composed jobs on the raw table, with its own column names."""

import pytest
from pyspark.sql import functions as F

from narrata.operators import clean, validate
from narrata.operators.embed import hashing_encoder
from narrata.params import CHUNK_METADATA, EXPECTED_COLUMNS, JobParams
from narrata.plans.answer_batch import answer_batch
from narrata.plans.index_build import build_index, preprocess
from narrata.plans.ingest import ask_once, ingest_embeddings
from narrata.sources.readers import keep_columns, raw_schema, read_csv
from narrata.sources.store import VectorTable
from narrata.sources.writers import write_csv

TEXT = "Consumer complaint narrative"
PARAMS = JobParams(sample_size=40, chunk_size=60, chunk_overlap=10, embedding_dim=384, top_k=3)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """120 raw complaints, through a CSV file; a third have no text, one product is not wanted."""
    products = F.array(*[F.lit(p) for p in [*PARAMS.products, "Mortgage"]])
    number = F.col("id").cast("int")
    values = {
        "Complaint ID": F.lpad(F.col("id").cast("string"), 7, "0"),
        "Product": products[number % 5],
        "Issue": F.when(number % 4 > 0, F.concat(F.lit("issue "), (number % 4).cast("string"))),
        "Company": F.lit("Bank, Ltd"),
        "Date received": F.lit("2024-03-05"),
        "ZIP code": F.lit("00501"),
        TEXT: F.when(
            number % 3 > 0,
            F.concat(F.lit("My card was charged twice.\nThe bank said case "), number.cast("string"),
                     F.lit(" is closed. I want the fee back, please.")),
        ),
    }
    df = spark.range(120).select(
        *[values.get(c, F.lit(None).cast("string")).alias(c) for c in EXPECTED_COLUMNS]
    )
    path = write_csv(df, str(tmp_path_factory.mktemp("raw") / "complaints.csv"))
    return read_csv(spark, path, raw_schema())


def counts(built):
    return {r.stage: r["rows"] for r in built.counts.collect()}


def test_index_build_and_answers(spark, raw, tmp_path):
    built = build_index(keep_columns(raw), PARAMS, str(tmp_path), with_profile=True)
    got = counts(built)
    assert (got["loaded"], got["product_filter"], got["narrative_filter"], got["sample"]) == (120, 96, 64, 40)
    assert got["chunks"] == got["vectors"] > 40
    assert set(built.paths) == {"csv", "parquet", "sample", "chunks", "vectors"}
    assert built.profile["length_counts"].first().total_rows == 64
    assert built.sampling_report.count() == 4
    assert (built.sampling_stats.first().original_size, built.sampling_stats.first().sample_size) == (64, 40)
    table = VectorTable(spark, built.paths["vectors"])
    stored = table.read()
    assert {"product", "issue", "company", "state", "date_received", "complaint_id"} <= set(stored.columns)
    row = stored.filter("chunk_index = 0").first()
    assert row.complaint_id == row.original_index and len(row.complaint_id) == 7
    asked = spark.createDataFrame([(1, "My card was charged twice."), (2, "I want the fee back, please.")], "question_id int, question string")
    answers = answer_batch(stored, asked, PARAMS).orderBy("question_id").collect()
    assert "charged twice" in answers[0].sources[0].text and "fee back" in answers[1].sources[0].text
    assert answers[0].sources[0].company == "Bank, Ltd"
    hits = ask_once(table, "the fee back, please.", hashing_encoder(384)).collect()
    assert len(hits) == 3 and "fee back" in min(hits, key=lambda r: r["rank"]).chunk_text


def test_stages_can_be_left_out(raw, tmp_path):
    params = JobParams(sample_size=40, splitter="window", chunk_size=60, chunk_overlap=10)
    built = build_index(
        raw, params, str(tmp_path), with_embedding=False, with_sample=False, save_filtered=False
    )
    assert set(built.paths) == {"chunks"}
    assert set(counts(built)) == {"loaded", "product_filter", "narrative_filter", "chunks"}
    unsaved = preprocess(raw, PARAMS, str(tmp_path / "b"), save_filtered=False, save_sample=False)
    assert unsaved.paths == {} and unsaved.final.count() == 40


def test_raw_table_is_read_once(spark, raw, tmp_path):
    """Each raw row passes a counting expression; without a written stage it would do so more than once."""
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    built = build_index(raw.mapInArrow(passing, raw.schema), PARAMS, str(tmp_path / "a"), with_profile=True)
    built.profile["length_stats"].collect()
    assert counts(built)["loaded"] == 120 and seen.value == 120
    seen = spark.sparkContext.accumulator(0)
    unsaved = preprocess(raw.mapInArrow(passing, raw.schema), PARAMS, str(tmp_path / "b"), save_filtered=False, save_sample=False)
    assert counts(unsaved)["narrative_filter"] == 64 and unsaved.final.count() == 40 and seen.value == 120


def test_counts_of_empty_and_unlisted_rows(raw, tmp_path):
    strangers = JobParams(products=["nothing"])
    with pytest.raises(ValueError, match="none of the products"):
        preprocess(raw, strangers, str(tmp_path / "a"))
    with pytest.raises(ValueError, match="none of the products"):
        preprocess(raw.limit(0), PARAMS, str(tmp_path / "b"))
    unwanted = raw.withColumn(TEXT, F.lit(" "))
    built = preprocess(unwanted, PARAMS, str(tmp_path / "c"), with_sample=False)
    assert [r["rows"] for r in built.counts.orderBy("step").collect()] == [120, 96, 0]


def test_ingest(spark, raw, tmp_path):
    built = build_index(raw, PARAMS, str(tmp_path / "a"), with_store=False, save_embeddings=True)
    table = VectorTable(spark, str(tmp_path / "v"))
    sources = [str(tmp_path / "missing.parquet"), built.paths["embeddings"]]
    first = ingest_embeddings(spark, sources, table).first()
    again = ingest_embeddings(spark, sources, table).first()
    total = first.rows_added
    assert tuple(first) == (0, total, total) and tuple(again) == (total, 0, total)
    assert tuple(ingest_embeddings(spark, sources, table, reset=True).first()) == (0, total, total)
    assert "date_received" in table.read().columns and "chunk_length" in table.read().columns
    with pytest.raises(ValueError):
        ingest_embeddings(spark, [built.paths["chunks"]], table)


def test_operators_with_raw_names(raw):
    assert validate.missing_columns(raw) == []
    report = {r.column_name: r.non_null for r in validate.expected_column_report(raw).collect()}
    assert report["Complaint ID"] == 120 and report[TEXT] == 80 and report["Tags"] == 0
    assert {r.column_name for r in validate.low_cardinality(raw, [TEXT, "Date received"]).collect()} >= {"Product", "Tags"}
    once = clean.remove_duplicates(raw, ["Product", "ZIP code"], key="Complaint ID")
    assert once.count() == 5 and once.columns == raw.columns
    done = clean.add_derived_features(clean.standardize_dates(clean.clean_narratives(raw, TEXT)), TEXT)
    assert dict(done.dtypes)["Date received"] == "timestamp_ntz"
    assert done.filter("has_narrative").count() == 80
    assert clean.filter_by_conditions(raw, {"Consumer disputed?": "Yes", "ZIP code": "00501"}, keep=False).count() == 0
    assert clean.handle_missing(raw, "drop", [TEXT, "Issue"]).count() < 120
    assert set(CHUNK_METADATA) <= set(raw.columns)
