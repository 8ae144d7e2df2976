import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import physical_plan
from narrata.operators import embed
from narrata.sources import readers, store, writers
from narrata.streaming.incremental import append_new_files

ROWS = [("a", "text a", [1.0, 2.0], "p"), ("b", "text b", [3.0, 4.0], None), ("a", "other a", [5.0, 6.0], "q")]
SCHEMA = "chunk_id string, chunk_text string, embedding array<double>, product string"


@pytest.fixture
def rows(spark):
    return store.records(spark.createDataFrame(ROWS, SCHEMA))


def test_add_is_repeat_safe(spark, rows, tmp_path):
    table = store.VectorTable(spark, str(tmp_path / "v"))
    assert not table.exists() and table.count() == 0
    assert table.info().first().document_count == 0
    assert table.add(rows) == 2
    assert table.add(rows) == 0
    assert table.add(rows.withColumn("chunk_id", F.concat("chunk_id", F.lit("2")))) == 2
    assert {r.chunk_id for r in table.read().collect()} == {"a", "b", "a2", "b2"}
    assert table.read().schema["embedding"].dataType.simpleString() == "array<float>"
    assert {r.chunk_id for r in table.get_by_ids(["a", "b2", "zz"]).collect()} == {"a", "b2"}
    many = [f"n{i}" for i in range(2000)] + ["b"]
    assert [r.chunk_id for r in table.get_by_ids(many).collect()] == ["b"]


def test_first_of_equal_ids_does_not_depend_on_order(rows):
    first = {tuple(r)[:2] for r in store.first_per_id(rows).collect()}
    again = {tuple(r)[:2] for r in store.first_per_id(rows.orderBy(F.desc("chunk_text"))).collect()}
    assert first == again == {("a", "other a"), ("b", "text b")}


def test_reset_and_delete(spark, rows, tmp_path):
    path = str(tmp_path / "v")
    table = store.VectorTable(spark, path)
    table.add(rows)
    table.reset()
    assert table.exists() and table.count() == 0 and table.add(rows) == 2
    table.delete()
    assert not table.exists()
    table.add(rows)
    assert not store.VectorTable(spark, path, reset=True).exists()


def test_partitioned_table(spark, rows, tmp_path):
    table = store.VectorTable(spark, str(tmp_path / "v"))
    assert table.add(rows, partition_by=["product"]) == 2
    assert table.add(rows, partition_by=["product"]) == 0


def test_metadata(spark):
    df = spark.createDataFrame([(1, "P", None, 7)], "id int, Product string, Issue string, `Complaint ID` long")
    row = store.project_metadata(df).first().asDict()
    assert row == {"id": 1, "product": "P", "issue": "", "company": "", "state": "",
                   "date_received": "", "complaint_id": "7"}
    kept = store.project_metadata(df, {"Issue": "issue"}, None).first()
    assert kept.issue is None and kept.Product == "P"
    odd = spark.sql("SELECT 'a' chunk_id, 't' chunk_text, array(1.0D) embedding, date'2024-01-02' day, true ok, 2.5D x")
    assert dict(store.records(odd).dtypes) == {
        "chunk_id": "string", "chunk_text": "string", "embedding": "array<float>",
        "day": "string", "ok": "boolean", "x": "double",
    }
    with pytest.raises(ValueError):
        store.records(df)


def test_incremental_append(spark, rows, tmp_path):
    source, table = str(tmp_path / "in"), store.VectorTable(spark, str(tmp_path / "v"))

    def load():
        return append_new_files(spark, source, rows.schema, table, str(tmp_path / "c"), files_per_batch=1)

    rows.write.parquet(source)
    assert load() == 2 and load() == 0
    rows.withColumn("chunk_id", F.concat("chunk_id", F.lit("x"))).unionByName(rows).write.mode("append").parquet(source)
    assert load() == 2 and load() == 0
    assert table.count() == 4


def test_hash_encoder(spark):
    encode = embed.hashing_encoder(16)()
    matrix = encode(pa.array(["b a a", "A  b\ta", "", " "]))
    assert (matrix[0] == matrix[1]).all() and matrix[0].sum() == 3 and matrix[2:].sum() == 0
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "c c c c")], "id int, chunk_text string")
    got = [np.array(r.embedding) for r in embed.embed_table(df, factory=embed.hashing_encoder(16)).orderBy("id").collect()]
    assert np.linalg.norm(got[0]) == pytest.approx(1) and not got[1].any() and got[2].max() == 1.0
    raw = embed.embed_table(df, factory=embed.hashing_encoder(16), normalize=False).orderBy("id").collect()
    assert max(raw[2].embedding) == 4.0


def test_own_encoder_is_built_once_per_task(spark):
    def factory():
        calls = iter(range(1, 100))
        mark = next(calls)
        return lambda texts: np.array([[mark, len(t)] for t in texts.to_pylist()], dtype=float)

    df = spark.createDataFrame([("abc",), ("z",)], "chunk_text string")
    got = embed.embed_table(df, factory=factory, normalize=False).collect()
    assert sorted(r.embedding for r in got) == [[1.0, 1.0], [1.0, 3.0]]


CSV = (
    'Complaint ID,Product,ZIP code,Consumer complaint narrative\n'
    '007,Credit card,01234,"two\nlines, and a ""quote"""\n'
    '008,NA,,""\n'
    '009,"  spaced ",N/A,None\n'
)


def test_csv_scan(spark, tmp_path):
    path = str(tmp_path / "raw.csv")
    with open(path, "w") as f:
        f.write(CSV)
    for df in (readers.read_csv(spark, path, readers.raw_schema()), readers.read_source(spark, path)):
        assert dict(df.dtypes) == {c: "string" for c in CSV.split("\n")[0].split(",")}
        rows = [tuple(r) for r in df.orderBy("Complaint ID").collect()]
        assert rows == [
            ("007", "Credit card", "01234", 'two\nlines, and a "quote"'),
            ("008", None, None, None),
            ("009", "  spaced ", None, None),
        ]
    raw = readers.read_csv(spark, path, null_tokens=False)
    assert raw.filter("`Complaint ID` = '008'").first()["Product"] == "NA"
    with pytest.warns(UserWarning):
        assert readers.keep_columns(raw).columns == [
            "Product", "Consumer complaint narrative", "ZIP code", "Complaint ID",
        ]


def test_sources_and_sinks(spark, rows, tmp_path):
    folder = str(tmp_path)
    flat = rows.drop("embedding")
    paths = writers.write_both(flat, folder, "filtered")
    assert set(paths) == {"csv", "parquet"}
    back = readers.first_readable(spark, [f"{folder}/no.parquet", f"{folder}/no.csv", paths["csv"]])
    key = ["chunk_id", "chunk_text"]
    assert back.orderBy(*key).collect() == flat.orderBy(*key).collect()
    assert set(writers.write_both(flat, folder, "one", csv=False)) == {"parquet"}
    with pytest.raises(ValueError):
        writers.write_both(flat, folder, "none", csv=False, parquet=False)
    with pytest.raises(FileNotFoundError):
        readers.first_readable(spark, [f"{folder}/no.parquet"])
    copied = writers.parquet_copy(spark, paths["csv"], f"{folder}/copy.parquet")
    assert copied.count() == 3
    kept = readers.reuse(copied)
    assert kept.is_cached and not readers.release(kept).is_cached
    tables = readers.LoadedTables(spark)
    first = tables.load([paths["parquet"]], sample=2, key="chunk_text")
    assert tables.load([paths["parquet"]], sample=2, key="chunk_text") is first
    assert first.count() == 2 and tables.load([paths["parquet"]]).count() == 3
    tables.clear()
    assert not first.is_cached
    with pytest.raises(ValueError):
        tables.load([paths["parquet"]], sample=2)
    writers.write_embeddings(rows, f"{folder}/e.parquet")
    assert spark.read.parquet(f"{folder}/e.parquet").count() == 3
    with pytest.raises(ValueError):
        writers.write_embeddings(flat, f"{folder}/e2.parquet")


def test_repeated_and_stored_ids(spark, rows, tmp_path):
    table = store.VectorTable(spark, str(tmp_path / "v"))
    table.add(rows)
    more = rows.unionByName(rows.withColumn("chunk_id", F.concat("chunk_id", F.lit("2"))))
    expected = [("a2", "other a"), ("b2", "text b")]
    assert sorted(tuple(r)[:2] for r in store.new_rows(more, table.read()).collect()) == expected
    empty = sorted(tuple(r)[:2] for r in store.new_rows(more, None).collect())
    assert empty == sorted([*expected, ("a", "other a"), ("b", "text b")])
    assert store.new_rows(rows.filter("false"), table.read()).collect() == []


def test_null_ids_are_refused(spark, rows, tmp_path):
    table = store.VectorTable(spark, str(tmp_path / "v"))
    with pytest.raises(Exception, match="no id"):
        table.add(rows.withColumn("chunk_id", F.nullif("chunk_id", F.lit("b"))))
    assert not table.exists()


def test_columns_of_all_loads_are_kept(spark, rows, tmp_path):
    table = store.VectorTable(spark, str(tmp_path / "v"))
    table.add(rows)
    table.add(rows.withColumn("chunk_id", F.concat("chunk_id", F.lit("2"))).withColumnRenamed("product", "state"))
    kept = {r.chunk_id: (r.product, r.state) for r in table.read().collect()}
    assert kept == {"a": ("q", None), "b": (None, None), "a2": (None, "q"), "b2": (None, None)}
    with pytest.raises(ValueError, match="product"):
        table.add(rows.withColumn("chunk_id", F.lit("z")).withColumn("product", F.lit(1)))


def test_settled_rows_are_not_shuffled(spark, rows, tmp_path):
    """The ids of a small load are sent to its rows; texts stay where they are."""
    table = store.VectorTable(spark, str(tmp_path / "v"))
    many = spark.range(3000).selectExpr("CAST(id AS STRING) chunk_id", "'t' chunk_text", "array(1.0F) embedding")
    assert table.add(many) == 3000 and table.add(many) == 0
    added = store.new_rows(many, table.read())
    assert added.collect() == []
    plan = physical_plan(added)
    shuffled = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "chunk_text" in line]
    assert not shuffled


def test_bucketed_append_reads_touched_buckets(spark, tmp_path):
    """An append of a few ids reads the folders of these ids, and of them the ids only."""
    path = str(tmp_path / "v")
    load = lambda low, high: spark.range(low, high).selectExpr("CAST(id AS STRING) chunk_id", "concat('t', id) chunk_text", "array(1.0F) embedding")
    table = store.VectorTable(spark, path, buckets=32)
    assert table.add(load(0, 3000)) == 3000 and table.add(load(0, 3000)) == 0
    few = load(2999, 3003)
    part = store.touched_buckets(table._files(), few, 32)
    plan = physical_plan(part.select("chunk_id"))
    assert "PartitionFilters: [" in plan and "ReadSchema: struct<chunk_id:string>" in plan
    folders = lambda df: {r.f.split("id_bucket=")[1].split("/")[0] for r in df.selectExpr("input_file_name() f").distinct().collect()}
    assert len(folders(part)) <= 4 < len(folders(table._files())) == 32
    assert table.add(few.unionByName(load(3001, 3003).selectExpr("chunk_id", "concat('z', chunk_id) chunk_text", "embedding"))) == 3
    assert store.VectorTable(spark, path, buckets=32).add(load(2990, 3003)) == 0
    assert table.count() == 3003 and table.read().columns == ["chunk_id", "chunk_text", "embedding"]
    assert {r.chunk_text for r in table.get_by_ids(["3000", "3001", "3002"]).collect()} == {"t3000", "t3001", "t3002"}
    table.reset()
    assert table.count() == 0 and table.add(load(0, 5)) == 5
    with pytest.raises(Exception, match="no id"):
        table.add(load(0, 2).withColumn("chunk_id", F.nullif("chunk_id", F.lit("1"))))


def test_large_id_sets_join_without_broadcast(spark, rows, tmp_path):
    """The same rows where Spark may not broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = store.VectorTable(spark, str(tmp_path / "v"))
        assert table.add(rows) == 2 and table.add(rows) == 0
        more = rows.unionByName(rows.withColumn("chunk_id", F.concat("chunk_id", F.lit("2"))))
        assert sorted(tuple(r)[:2] for r in store.new_rows(more, table.read()).collect()) == [("a2", "other a"), ("b2", "text b")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_malformed_csv_rows_are_kept_apart(spark, tmp_path):
    lines = ["id,name,n", '1,"a, b",2', "2,short", "3,x,4,long", 'y,not a number,5', '4,"never closed,6', "5,,", '6,"say ""hi""",7', ""]
    (tmp_path / "f.csv").write_text("\n".join(lines))
    schema = "id long, name string, n int"
    kind = spark.createDataFrame([], schema).schema
    good, bad = readers.split_csv(spark, str(tmp_path / "f.csv"), kind, str(tmp_path / "out"))
    assert sorted(map(tuple, good.collect())) == [(1, "a, b", 2), (5, None, None), (6, 'say "hi"', 7)]
    assert sorted(r.record for r in bad.collect()) == sorted(["2,short", "3,x,4,long", "y,not a number,5", '4,"never closed,6'])
    assert good.count() == 3 and bad.count() == 4 and all(r.file.endswith("f.csv") for r in bad.collect())
    (tmp_path / "e.csv").write_text("id,name,n\n")
    good, bad = readers.split_csv(spark, str(tmp_path / "e.csv"), kind, str(tmp_path / "none"))
    assert good.count() == bad.count() == 0
    with pytest.raises(ValueError, match="_record"):
        readers.split_csv(spark, str(tmp_path / "e.csv"), spark.createDataFrame([], "_record string").schema, str(tmp_path / "x"))
