"""Streaming jobs run over the files of a table, and the packed token files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import corpus
from corpusmill.plans.corpus import TOK
from corpusmill.plans.history import S
from corpusmill.plans.registry import query
from corpusmill.sources import packed
from corpusmill.sources.tables import scratch_path, table
from corpusmill.streaming import jobs


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    """The table as a stream of its files."""
    return spark.readStream.schema(table(spark, d, name).schema).option("recursiveFileLookup", True).parquet(f"{d}/{name}.parq*")


def _collected(rows: DataFrame, label: str, mode: str) -> DataFrame:
    """The rows that a stream gave until it had read all, kept as Parquet; of a stream that restates rows the last statement."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)

    def put(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("append").parquet(f"{path}/rows")

    rows.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows")


@query(f"with {S}, c as (select *, lag(step) over (partition by port order by ord) as b, row_number() over (partition by port order by ord) as k from s) select port, ord, step from c where k = 1 or step is distinct from b")
def stream_history_changed(spark: SparkSession, d: str) -> DataFrame:
    rows = _stream(spark, d, "events").selectExpr("user_id as port", "event_id as ord", "event_id div 400 as step")
    path = scratch_path(spark, "stream-history")
    jobs.changed_sink(rows, f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.schema("port long, ord long, step long").parquet(f"{path}/out/rows").select("port", "ord", "step")


@query("select lang, count(*) as n, sum(length(text))::bigint as n_chars from documents group by lang")
def stream_totals(spark: SparkSession, d: str) -> DataFrame:
    rows = _collected(jobs.totals_stream(_stream(spark, d, "documents"), "lang"), "stream-totals", "update")
    return rows.groupBy("lang").agg(F.max_by("n", "_batch").alias("n"), F.max_by("n_chars", "_batch").alias("n_chars"))


@query("with o as (select (row_number() over (order by doc_id) - 1) // 300 as shard from documents) select shard, count(*) as n from o group by 1")
def stream_shards(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "stream-shards")
    rows = _stream(spark, d, "documents").select("doc_id", "text")
    jobs.shard_sink(rows, f"{path}/out", f"{path}/state", 300, "doc_id").awaitTermination()
    return spark.read.parquet(f"{path}/out/rows").groupBy(F.col("shard").cast("long").alias("shard")).agg(F.count("*").alias("n"))


@query("""select 'run' || user_id as run, max_by(case when event_id % 151 = 0 then 'nan' else 'running' end, (event_id % 151 = 0)::int) as status, count(*)::int as iteration from events group by 1""")
def stream_status(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").selectExpr("concat('run', user_id) as run", "row_number() over (partition by user_id order by event_id) as line_no", "event_id")
    text = F.expr("concat(' iteration ', line_no, '/ 99 | grad norm: ', if(event_id % 151 = 0, 'nan', '1.0'))")
    path = scratch_path(spark, "stream-log")
    rows.select("run", "line_no", text.alias("value")).write.parquet(path)
    lines = spark.readStream.schema("run string, line_no int, value string").parquet(path)
    out = _collected(jobs.status_stream(lines, None), "stream-status", "update")
    return out.groupBy("run").agg(F.max_by("status", "_batch").alias("status"), F.max_by("iteration", "_batch").alias("iteration"))


@query(f"with {TOK} select len(tokens)::bigint as size, count(*) as n, sum(list_sum(tokens))::bigint as id_sum from t group by 1")
def packed_round_trip(spark: SparkSession, d: str) -> DataFrame:
    packed.register(spark)
    path = scratch_path(spark, "packed")
    corpus.tokenized(table(spark, d, "documents")).select("tokens").write.format("packed_tokens").mode("append").save(path)
    rows = spark.read.format("packed_tokens").load(path)
    total = F.aggregate("tokens", F.lit(0).cast("long"), lambda s, v: s + v)
    return rows.groupBy(F.size("tokens").cast("long").alias("size")).agg(F.count("*").alias("n"), F.sum(total).alias("id_sum"))


@query(f"with {TOK} select len(tokens)::bigint as size, count(*) as n, sum(list_sum(tokens))::bigint as id_sum from t group by 1")
def packed_one_pair(spark: SparkSession, d: str) -> DataFrame:
    # The pairs of all tasks, joined to one.
    packed.register(spark)
    path, out = scratch_path(spark, "packed"), scratch_path(spark, "packed-joined")
    corpus.tokenized(table(spark, d, "documents")).select("tokens").write.format("packed_tokens").mode("append").save(path)
    os.makedirs(out.removeprefix("file://"))
    packed.join(spark, path, f"{out}/all")
    rows = spark.read.format("packed_tokens").load(out)
    total = F.aggregate("tokens", F.lit(0).cast("long"), lambda s, v: s + v)
    return rows.groupBy(F.size("tokens").cast("long").alias("size")).agg(F.count("*").alias("n"), F.sum(total).alias("id_sum"))


@query("select lang, count(*) as n, sum(length(text))::bigint as n_chars from documents where text is not null group by lang")
def stream_json_tail(spark: SparkSession, d: str) -> DataFrame:
    # JSON lines files in a folder, with blank lines and lines without a text among them, read until nothing more comes.
    path = scratch_path(spark, "stream-json")
    docs = table(spark, d, "documents").select(F.to_json(F.struct("text", "lang")).alias("value"))
    docs.unionByName(docs.limit(3).select(F.explode(F.array(F.lit(""), F.lit('{"lang": "en"}'))).alias("value"))).write.text(f"{path}/in")
    rows = jobs.text_stream(spark, f"{path}/in", "text string, lang string", idle=0.5)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    jobs.run_until_idle(rows.writeStream.foreachBatch(put).option("checkpointLocation", f"{path}/state").trigger(processingTime="200 milliseconds").start(), 1.5)
    return spark.read.schema("text string, lang string").parquet(f"{path}/rows").groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))
