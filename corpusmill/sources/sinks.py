"""Sinks that add to what is there."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def append_csv(rows: DataFrame, path: str) -> None:
    """Every file has its header, so the folder reads back as one table."""
    rows.write.mode("append").option("header", True).csv(path)


def write_once(rows: DataFrame, path: str) -> bool:
    """Writes Parquet unless a finished table is there; tells whether it wrote.  The marker is a table beside it, ``path.done``,
    with the number of rows; a table without a marker is replaced."""
    spark = rows.sparkSession
    try:
        spark.read.schema("n long").parquet(f"{path}.done").first()
        return False
    except AnalysisException:
        rows.write.mode("overwrite").parquet(path)
        spark.read.parquet(path).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}.done")
        return True


#: Rows of a row group of a shard.
GROUP_ROWS = 1024


def _sums(rows: DataFrame, n: str, total: str) -> DataFrame:
    """part, shard, the number of rows and the sum of the hashes of all their columns."""
    data = [c for c in rows.columns if c not in ("part", "shard")]
    return rows.groupBy("part", F.col("shard").cast("long").alias("shard")).agg(F.count("*").alias(n), F.sum(F.xxhash64(*data).cast("decimal(20,0)")).alias(total))


def check_shards(placed: DataFrame, path: str) -> DataFrame:
    """Reads every column of every row of the shards under ``path`` and compares counts and hashes with ``placed``; returns part,
    shard and m, the rows, of each.

    Shards that cannot be read, or hold other rows, are deleted, and then it is an error that names the first of them.
    """
    spark = placed.sparkSession
    data = [c for c in placed.columns if c not in ("part", "shard")]
    schema = placed.select(*data, "part", F.col("shard").cast("long").alias("shard")).schema
    # A file that cannot be read counts as one without rows.
    read = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(path)
    got = _sums(read, "m", "own").withColumnsRenamed({"part": "p", "shard": "s"})
    both = _sums(placed, "n", "want").join(got, (F.col("part") == F.col("p")) & (F.col("shard") == F.col("s")), "full_outer")
    broken = both.filter("n is distinct from m or want is distinct from own").select(F.coalesce("part", "p").alias("part"), F.coalesce("shard", "s").alias("shard"))
    first = None
    for row in broken.toLocalIterator():
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part={row.part}/shard={row.shard}")  # type: ignore[union-attr]
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        first = first or folder.toString()
    if first:
        raise ValueError(f"{first}: the shard does not read back as it was written, and was deleted")
    return got.select(F.col("p").alias("part"), F.col("s").alias("shard"), "m")


def write_shards(placed: DataFrame, path: str) -> DataFrame:
    """Writes rows that have ``part`` and ``shard`` as one Parquet file for each shard, in row groups of ``GROUP_ROWS``, reads them
    back (``check_shards``), and then writes the completion table ``path.done``, which it returns: n_shards, n_train, n_val, total.

    Without a whole read-back there is an error and no completion table.  ``placed`` is worked out twice and has to give the same rows.
    """
    spark = placed.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = placed.repartition(n, "part", "shard").sortWithinPartitions("part", "shard")
    rows.write.mode("overwrite").option("parquet.block.row.count.limit", GROUP_ROWS).partitionBy("part", "shard").parquet(path)
    train = F.col("part") == "train"
    done = check_shards(placed, path).agg(F.count(F.when(train, 1)).alias("n_shards"), F.sum(F.when(train, F.col("m")).otherwise(0)).alias("n_train"), F.sum(F.when(~train, F.col("m")).otherwise(0)).alias("n_val"), F.sum("m").alias("total"))
    done.coalesce(1).write.mode("overwrite").json(f"{path}.done")
    return spark.read.schema("n_shards long, n_train long, n_val long, total long").json(f"{path}.done")


def publish_one(folders: DataFrame, path: str, part: str, schema: str) -> None:
    """Publishes the one dataset that ``folders`` (folder) names over ``path``, part by part; more or fewer than one is an error."""
    found = folders.select("folder").distinct().limit(2).collect()
    if len(found) != 1:
        raise ValueError("exactly one dataset must be there to publish")
    replace_parts(folders.sparkSession.read.schema(schema).parquet(found[0].folder), path, part)


def replace_parts(rows: DataFrame, path: str, part: str) -> None:
    """Replaces the parts that ``rows`` has and leaves the others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
