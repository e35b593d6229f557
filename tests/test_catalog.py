"""U6/K11 projects, S12/A6 checks, S10 views, CSV datasets (fixture F11), ids."""

from pyspark.sql import functions as F

from quire.operators import catalog as cat
from quire.operators.ids import sequential_ids
from quire.session import scratch_path
from quire.sources.files import read_dataset_csv, write_dataset_csv


def test_projects_get_or_create(spark):
    existing = spark.createDataFrame([("News", 4)], "name string, id long")
    names = spark.createDataFrame([("News",), ("Health A-Z",), ("Health A-Z",)], "name string")
    got = sorted((r.name, r.id, r.created, r.resource_type, tuple(r.filters))
                 for r in cat.projects_get_or_create(existing, names, type_filter=cat.EXAMPLE_TYPE_FILTER).collect())
    assert got == [("Health A-Z", 5, True, "SequenceLabelingProject", ("T047", "T048", "T184")),
                   ("News", 4, False, "SequenceLabelingProject", ("T047", "T048", "T184"))]


def test_views_exists_empty(spark):
    df = spark.createDataFrame([(1,)], "x long")
    cat.register(spark, {"quire_t": df})
    assert cat.exists(spark, "quire_t") and not cat.exists(spark, "quire_missing")
    assert spark.sql("SELECT count(*) AS n FROM quire_t").first().n == 1
    assert cat.all_empty([df.where("x > 5"), df.limit(0)]) and not cat.all_empty([df])


def test_sequential_ids_dense_and_ordered(spark):
    df = spark.range(1000).select(F.format_string("n%04d", (F.col("id") * 7919) % 1000).alias("k"))
    got = sorted((r.k, r.id) for r in sequential_ids(df, ["k"], start=10, partitions=7).collect())
    assert [i for _, i in got] == list(range(10, 1010))


def test_csv_round_trip(spark):
    rows = [("a", 'text, with "quotes"\nand a newline', "x"), ("b", "  padded  ", "y"), ("c", "", "z")]
    df = spark.createDataFrame(rows, "name string, text string, ignored string")
    path = scratch_path(spark, "csvtest")
    write_dataset_csv(df, path)
    back = read_dataset_csv(spark, path)
    assert back.columns == ["name", "text"]
    got = {r.name: r.text for r in back.collect()}
    assert got["a"] == rows[0][1] and got["b"] == rows[1][1]
