import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from telemetra import schemas
from telemetra.plans import inputs, sql_jobs
from telemetra.sources import jdbc, tables
from telemetra.workspace import new_dir
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"


def types(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_derived_frames_have_the_declared_schemas(spark):
    assert types(inputs.gps_points(spark, SF_DIR).schema) == types(schemas.GPS_POINT)
    assert types(inputs.log_records(spark, SF_DIR).schema) == types(schemas.LOG_RECORD)
    assert types(inputs.route_records(spark, SF_DIR).schema) == types(schemas.ROUTE_RECORD)


def test_jdbc_conditions_are_pushed_down_as_typed_filters(spark):
    url, login = sql_jobs._database(spark)
    data = [(i, f"n\\'{i}?") for i in range(40)]
    jdbc.write_batch(spark.createDataFrame(data, "ID long, NAME string"), url, "PUSHED", login, mode="overwrite", column_types="NAME VARCHAR(40)")
    read = jdbc.read_table(spark, url, "PUSHED", login, partition_column="ID", partitions=4)
    assert read.rdd.getNumPartitions() == 4 and read.count() == 40
    found = read.where((F.col("NAME") == "n\\'7?") & (F.col("ID") < 30))
    assert "PushedFilters: [*IsNotNull(NAME), *IsNotNull(ID), *EqualTo(NAME" in found._jdf.queryExecution().toString()
    assert rows(found) == [(7, "n\\'7?")]
    empty = spark.createDataFrame([], "ID long, NAME string")
    jdbc.write_batch(empty, url, "EMPTIED", login, mode="overwrite")
    assert jdbc.read_table(spark, url, "EMPTIED", login, partition_column="ID").count() == 0


def test_students_with_good_scores(spark):
    info, scores = new_dir(spark, "info"), new_dir(spark, "scores")
    spark.createDataFrame([("ann\t20",), ("bob\t21",), ("cid\t22",)], "value string").write.text(info)
    spark.createDataFrame([("ann\t80",), ("bob\t79",), ("dan\t99",)], "value string").write.text(scores)
    tables.load_text_table(spark, "student_infos", "name string, age int", info, new_dir(spark, "t"))
    tables.load_text_table(spark, "student_scores", "name string, score int", scores, new_dir(spark, "t"))
    good = spark.sql("SELECT i.name, i.age, s.score FROM student_infos i JOIN student_scores s ON i.name = s.name WHERE s.score >= 80")
    saved = tables.save_table(good, "good_student_infos", new_dir(spark, "t"))
    assert rows(saved) == [("ann", 20, 80)]
    tables.save_table(spark.createDataFrame([("eve", 1, 2)], saved.schema), "good_student_infos", new_dir(spark, "t"))
    assert rows(tables.table_rows(spark, "good_student_infos", ["name"], 100)) == [("eve", 1, 2)]


def test_record_lines_are_in_key_order(spark):
    records = tables.numbered_records(spark, "records")
    assert records.count() == 99
    assert [r.line for r in tables.record_lines(records, below=4).collect()] == [
        "Key: 1, Value: val_1", "Key: 2, Value: val_2", "Key: 3, Value: val_3"
    ]


def test_headerless_csv_reads_as_text(spark):
    path = new_dir(spark, "csv")
    spark.createDataFrame([("a,1",), ("b,",)], "value string").write.text(path)
    assert rows(tables.read_csv(spark, path)) == [("a", "1"), ("b", None)]


def stored_rows(spark, url, login, name):
    return rows(jdbc.read_table(spark, url, name, login))


def test_updates_and_deletes_equal_sql_and_are_not_repeated(spark):
    url, login = sql_jobs._database(spark)
    data = [(i, i % 3, float(i)) for i in range(30)]
    jdbc.write_batch(spark.createDataFrame(data, "ID long, KIND int, AMOUNT double"), url, "CHANGED", login, mode="overwrite")
    new = spark.createDataFrame([(i, -1.0) for i in range(5)] + [(99, 7.0), (None, 8.0)], "id long, amount double")
    assert jdbc.update_rows(new, url, "CHANGED", login, ["id"], "first") == 5
    gone = spark.createDataFrame([(2, 6), (2, 8), (2, 8), (1, 6)], "kind int, id long")
    assert jdbc.delete_rows(gone, url, "CHANGED", login, "second") == 1
    expected = sorted((i, k, -1.0 if i < 5 else a) for i, k, a in data if i != 8)
    assert stored_rows(spark, url, login, "CHANGED") == sorted(expected, key=repr)
    # The same jobs again, as after a lost answer, and a job that failed between its steps.
    other = spark.createDataFrame([(1, 55.0)], "id long, amount double")
    assert jdbc.update_rows(other, url, "CHANGED", login, ["id"], "first") is None
    twice = spark.createDataFrame([(1, 55.0), (1, 56.0)], "id long, amount double")
    with pytest.raises(Py4JJavaError):
        jdbc.update_rows(twice, url, "CHANGED", login, ["id"], "third")
    assert stored_rows(spark, url, login, "CHANGED") == sorted(expected, key=repr)
    assert jdbc.update_rows(other, url, "CHANGED", login, ["id"], "third") == 1
    with pytest.raises(ValueError, match="letters"):
        jdbc.update_rows(other, url, "CHANGED", login, ["id"], "a; DROP TABLE CHANGED")


def test_skewed_keys_give_even_splits(spark):
    url, login = sql_jobs._database(spark)
    data = [(i,) for i in range(900)] + [(10**9 + i * 10**6,) for i in range(100)] + [(None,)] * 3
    jdbc.write_batch(spark.createDataFrame(data, "ID long"), url, "SKEWED", login, mode="overwrite")
    read = jdbc.read_table(spark, url, "SKEWED", login, partition_column="ID", partitions=8)
    sizes = [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 1003 and max(sizes) <= 2 * min(sizes)
