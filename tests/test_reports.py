"""Report texts and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import reports
from corpusmill.sources import sinks


def test_write_once(spark, tmp_path) -> None:
    path = str(tmp_path / "t")
    assert sinks.write_once(spark.range(3), path)
    assert not sinks.write_once(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3
    (tmp_path / "t.done").rename(tmp_path / "moved")
    assert sinks.write_once(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_replace_parts_and_append(spark, tmp_path) -> None:
    path = str(tmp_path / "p")
    sinks.replace_parts(spark.range(6).withColumn("k", F.col("id") % 2), path, "k")
    sinks.replace_parts(spark.range(10, 11).withColumn("k", F.lit(1)), path, "k")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 4, 10]
    for _ in range(2):
        sinks.append_json(spark.range(2), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 4


def test_texts(spark) -> None:
    at = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert at(reports.table_cells(F.lit("| a | b"), 3)) == ["a", "b", ""]
    assert at(reports.is_table_rule(F.lit("|---|:-:|"))) and not at(reports.is_table_rule(F.lit("---")))
    assert at(reports.shell_quoted(F.lit("a b'c"))) == "'a b'\"'\"'c'"
    assert at(reports.flag(F.lit("perhaps"))) is None
    assert at(reports.number_list(F.lit("3, 1,3,x"))) == [3, 1]


def test_decorators(spark) -> None:
    files = spark.createDataFrame([("a", "@x.jit(fast=True)\n@jit\ndef f(): pass\n"), ("b", None), ("c", "def (")], "path string, text string")
    assert {(r.path, r.line) for r in reports.decorators_without(files, "jit", "fast").collect()} == {("a", 2), ("c", -1)}
