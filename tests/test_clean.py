import pytest
from pyspark.sql import functions as F

from conftest import physical_plan
from narrata.operators import clean, validate

DUPS = [
    (1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, None, None), (5, None, None), (6, "b", None), (7, "c", "z"),
]


@pytest.fixture
def dups(spark):
    return spark.createDataFrame(DUPS, "id int, a string, b string")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_duplicates_by_subset(dups):
    assert ids(clean.remove_duplicates(dups, ["a"], "first", "id")) == [1, 4, 6, 7]
    assert ids(clean.remove_duplicates(dups, ["a"], "last", "id")) == [3, 5, 6, 7]
    assert ids(clean.remove_duplicates(dups, ["a", "b"], False, "id")) == [3, 6, 7]


def test_duplicates_of_whole_rows(dups):
    rows = dups.drop("id")
    assert clean.remove_duplicates(rows).count() == 5
    assert clean.remove_duplicates(rows, keep=False).count() == 3
    with pytest.raises(ValueError):
        clean.remove_duplicates(rows, ["a"])
    with pytest.raises(ValueError):
        clean.remove_duplicates(dups, ["a"], "some", "id")


def test_duplicate_count_agrees_with_grouping(spark, dups):
    assert validate.duplicate_rows(dups.drop("id")).first()[0] == 2
    tricky = spark.createDataFrame(
        [("1:a", "b"), ("1", ":ab"), ("-", None), (None, "-"), ("", None), (None, ""), ("", None)],
        "a string, b string",
    )
    assert validate.duplicate_rows(tricky).first()[0] == 1
    nested = spark.createDataFrame([([1, 2],), ([1, 2],), ([12],)], "v array<int>")
    assert validate.duplicate_rows(nested).first()[0] == 1
    assert validate.duplicate_rows(dups.filter("id < 0")).first()[0] == 0


def test_duplicates_join_is_on_the_key(dups):
    """The hot value never becomes a join or window key."""
    plan = physical_plan(clean.remove_duplicates(dups, ["a"], "first", "id"))
    assert "Window" not in plan and "CartesianProduct" not in plan


def test_missing_values(dups):
    assert ids(clean.handle_missing(dups, "drop", ["a", "b"])) == [1, 2, 3, 6, 7]
    filled = clean.handle_missing(dups, "fill", ["b", "nowhere"], "?")
    assert [r.b for r in filled.orderBy("id").collect()] == ["x", "x", "y", "?", "?", "?", "z"]
    assert clean.handle_missing(dups, "keep") is dups
    for bad in ({"strategy": "fill"}, {"strategy": "guess"}):
        with pytest.raises(ValueError):
            clean.handle_missing(dups, **bad)


def test_product_filter(dups):
    assert ids(clean.filter_by_products(dups, ["a", "zz"], "a")) == [1, 2, 3]
    with pytest.raises(ValueError):
        clean.filter_by_products(dups, ["zz"], "a")
    with pytest.raises(ValueError):
        clean.filter_by_products(dups, ["a"], "nowhere")
    assert [r.value for r in clean.absent_values(dups, ["a", "zz"], "a").collect()] == ["zz"]


def test_conditions(dups):
    assert ids(clean.filter_by_conditions(dups, {"a": ["a", "b"], "b": "x", "zz": 1})) == [1, 2]
    assert ids(clean.filter_by_conditions(dups, {"a": "a"}, keep=False)) == [4, 5, 6, 7]
    assert ids(clean.filter_by_conditions(dups, {"zz": 1})) == [1, 2, 3, 4, 5, 6, 7]


def test_funnel_and_empty_narratives(spark):
    rows = [(1, "a", "text"), (2, "a", " "), (3, "b", "nan"), (4, None, "text"), (5, "c", "text")]
    df = spark.createDataFrame(rows, "id int, p string, t string")
    funnel = clean.filter_funnel(df, ["a", "b"], "p", "t").first()
    assert tuple(funnel) == (5, 3, 1, 2, 2, 4, 20.0)
    assert ids(clean.remove_empty_narratives(df, "t")) == [1, 4, 5]
    assert clean.filter_funnel(df.filter("id < 0"), ["a"], "p", "t").first()["retention_rate"] == 0.0


def test_dates_are_detected_by_name(spark):
    df = spark.createDataFrame([("2024-01-02", "2024-01-02", "x")], "`Date received` string, other string, update string")
    out = clean.standardize_dates(df)
    assert dict(out.dtypes) == {"Date received": "timestamp_ntz", "other": "string", "update": "timestamp_ntz"}
    assert {r.column_name: r.valid_dates for r in clean.valid_dates(out).collect()} == {
        "Date received": 1, "update": 0,
    }


def test_columns_that_are_absent(spark, dups):
    with pytest.warns(UserWarning):
        assert clean.select_columns(dups, ["a", "nowhere"]).columns == ["a"]
    with pytest.warns(UserWarning):
        assert clean.clean_narratives(dups, "nowhere") is dups
    assert validate.missing_columns(dups, ["a", "q", "b", "r"]) == ["q", "r"]


def test_low_cardinality_exact_and_sketched(spark):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("key"), (F.col("id") % 3).cast("string").alias("few"),
        F.when(F.col("id") < 400, F.col("id").cast("string")).alias("some"),
    )
    for approximate in (False, True):
        found = validate.low_cardinality(df, approximate=approximate).collect()
        assert {r.column_name for r in found} == {"few", "some"}
    exact = {r.column_name: r.distinct_values for r in validate.low_cardinality(df).collect()}
    assert exact == {"few": 3, "some": 400}


def test_summary_parts(dups):
    parts = validate.summary(dups)
    assert parts["shape"].first()["row_count"] == 7
    assert {r.column_name: r.null_count for r in parts["null_counts"].collect()} == {"id": 0, "a": 2, "b": 3}
    assert parts["column_types"].count() == 3
    assert not validate.shape(dups.filter("id < 0")).first()["is_valid"]
    assert tuple(validate.shape_change(dups, dups.filter("id < 3").drop("b")).first()) == (7, 3, 2, 2, 5, 1)


def test_cleaning_counts_while_writing(spark, tmp_path):
    rows = [(1, "See http://a.org now", "x"), (2, None, "y"), (3, "  ", "z"), (4, "!!!", None), (5, "plain", "plain")]
    df = spark.createDataFrame(rows, "id int, text string, _cleaned_by string")
    table, counts = clean.write_cleaned(df, "text", str(tmp_path / "a"))
    assert counts == {"before": 4, "after": 2, "empty_after": 3, "emptied": 2}
    assert table.columns == df.columns
    assert {r.id: r.text for r in table.collect()} == {1: "see now", 2: None, 3: None, 4: None, 5: "plain"}
    for number, empty in enumerate((df.limit(0), df.filter("id < 0"), spark.createDataFrame([], df.schema))):
        table, counts = clean.write_cleaned(empty, "text", str(tmp_path / f"empty{number}"))
        assert table.count() == 0 and set(counts.values()) == {0}
    with pytest.raises(ValueError):
        clean.write_cleaned(df, "absent", str(tmp_path / "b"))
