"""Corpus preparation: tokens, packed index, shards, splits, chunks and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.ordinals import ordinals, prefix_sums
from corpusmill.sources.tables import scratch_path

VOCAB = 131072
ITEM_BYTES = 4


def words(text: Column) -> Column:
    """Words between blanks."""
    return F.filter(F.split(text, "[ \t\n\r]+"), lambda w: w != "")


def tokens(text: Column) -> Column:
    """Stand-in tokenizer: words numbered by a hash (the real tokenizer of a corpus is external)."""
    return F.transform(words(text), lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % VOCAB)


def with_words(docs: DataFrame) -> DataFrame:
    """The documents that have a word: one look at the text, before any work on its words."""
    return docs.filter(F.col("text").rlike("[^ \t\n\r]"))


def tokenized(docs: DataFrame) -> DataFrame:
    """doc_id and tokens of every document that has tokens; null and empty lists go."""
    return with_words(docs).select("doc_id", tokens(F.col("text")).alias("tokens"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id and size, the number of tokens, of every document that has any; no token is numbered for it."""
    return with_words(docs).select("doc_id", F.size(words(F.col("text"))).alias("size"))


def packed_index(sizes: DataFrame) -> DataFrame:
    """doc_id, ord, size and byte pointer of each list (doc_id, size) in the flat token file.

    The sizes are stored, for both the totals and the rows are made from them; the texts are read once.
    """
    path = scratch_path(sizes.sparkSession, "token-sizes")
    sizes.write.parquet(path)
    rows = sizes.sparkSession.read.schema(sizes.schema).parquet(path)
    return prefix_sums(rows, "doc_id", {"ord": F.lit(1).cast("long"), "pointer": F.col("size").cast("long") * ITEM_BYTES})


def document_index(lists: DataFrame) -> DataFrame:
    """doc_idx 0 .. n: the begin of each document and the closing sentinel."""
    begins = ordinals(lists.select("doc_id"), "doc_id", "doc_idx").select("doc_idx")
    return begins.unionByName(lists.agg(F.count("*").alias("doc_idx")))


def shard_plan(docs: DataFrame, rows_per_file: int, val_fraction: float = 0.01) -> DataFrame:
    """doc_id, shard and part: files of ``rows_per_file`` in doc_id order.

    The validation part is cut from the end of the last, unfilled file only: max(1, int(total * val_fraction)) rows if that
    file has more, else none.
    """
    rows = ordinals(docs.select("doc_id"), "doc_id")
    total = docs.agg(F.count("*").alias("total"))
    rows = rows.join(F.broadcast(total))
    tail = F.col("total") % rows_per_file
    val = F.greatest(F.lit(1), F.floor(F.col("total") * F.lit(val_fraction)))
    is_val = (tail > val) & (F.col("ord") >= F.col("total") - val)
    shard = F.expr(f"ord div {rows_per_file}").alias("shard")
    return rows.select("doc_id", shard, F.when(is_val, "val").otherwise("train").alias("part"))


def shard_sentinel(plan: DataFrame) -> DataFrame:
    """Counts for the completion marker: n_shards (files of the training part), n_train, n_val."""
    train = F.col("part") == "train"
    return plan.agg(
        F.countDistinct(F.when(train, F.col("shard"))).alias("n_shards"),
        F.count(F.when(train, 1)).alias("n_train"), F.count(F.when(~train, 1)).alias("n_val"),
    )


def split_rule(shards: DataFrame, name: str, val_shard: str, strict: bool = False) -> DataFrame:
    """shard, in_train, in_val: the named shard is validation if it is there, else the last one; a lone shard serves both
    (``strict``: it is validation only)."""
    names = shards.select(F.col(name).alias("shard")).distinct()
    facts = names.agg(F.max("shard").alias("last"), F.count("*").alias("n"), F.max((F.col("shard") == val_shard).cast("int")).alias("named"))
    rows = names.join(F.broadcast(facts))
    is_val = F.col("shard") == F.when(F.col("named") == 1, F.lit(val_shard)).otherwise(F.col("last"))
    lone = (F.col("n") == 1) & F.lit(not strict)
    return rows.select("shard", (~is_val | lone).alias("in_train"), is_val.alias("in_val"))


def totals(token_lists: DataFrame) -> DataFrame:
    """Documents, tokens, least and greatest id, and whether all ids are in the vocabulary."""
    each = token_lists.select(F.size("tokens").alias("n"), F.array_min("tokens").alias("low"), F.array_max("tokens").alias("high"))
    return each.agg(
        F.count("*").alias("n_docs"), F.sum("n").alias("n_tokens"), F.min("low").alias("min_id"), F.max("high").alias("max_id"),
        (F.max("high") < VOCAB).alias("in_vocab"),
    )


def shard_totals(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents and tokens of each shard, and running totals up to it, of lists (doc_id, size)."""
    each = sizes.join(plan, "doc_id").groupBy("shard").agg(F.count("*").alias("n_docs"), F.sum("size").alias("n_tokens"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)  # one row per shard
    return each.withColumns({"docs_upto": F.sum("n_docs").over(upto), "tokens_upto": F.sum("n_tokens").over(upto)})


def chunks(token_lists: DataFrame, budget: int) -> DataFrame:
    """doc_id, chunk, n_tokens, first_id: lists cut to at most ``budget`` tokens."""
    starts = F.explode(F.sequence(F.lit(0), F.expr(f"(size(tokens) - 1) div {budget}").cast("int")))
    rows = token_lists.select("doc_id", "tokens", starts.alias("chunk"))
    part = F.slice("tokens", F.col("chunk") * budget + 1, budget)
    return rows.select("doc_id", "chunk", F.size(part).alias("n_tokens"), part[0].alias("first_id"))


def hash_share(key: Column, parts: int = 100) -> Column:
    """A number below ``parts`` from the key's hash, the same in every run."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % parts


def ratio_split(docs: DataFrame, ratios: dict[str, int]) -> DataFrame:
    """doc_id and part, by hash ranges of the given percentages."""
    share, upto, part = hash_share(F.col("doc_id")), 0, F.lit(None).cast("string")
    for name, ratio in reversed(ratios.items()):
        part = F.when(share < sum(r for n, r in ratios.items() if list(ratios).index(n) <= list(ratios).index(name)), name).otherwise(part)
    return docs.select("doc_id", part.alias("part"))


def blend(docs: DataFrame, weights: dict[str, float], name: str = "lang") -> DataFrame:
    """Rows, weight and the weight's share of each part of a weighted union; parts without a weight count 1."""
    weight = F.lit(1.0)
    for k, w in weights.items():
        weight = F.when(F.col(name) == k, w).otherwise(weight)
    rows = docs.groupBy(name).agg(F.count("*").alias("n_docs")).withColumn("weight", weight)
    whole = Window.partitionBy()
    return rows.withColumn("share", F.round(F.col("weight") / F.sum("weight").over(whole), 6))


def shuffled(plan: DataFrame, seed: int) -> DataFrame:
    """doc_id, shard, place: a seeded order inside each training shard; validation keeps its order."""
    key = F.when(F.col("part") == "train", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id"))))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy(key, "doc_id"))
    return plan.select("doc_id", "shard", "part", place.alias("place"))


def violations(token_lists: DataFrame, vocab: int, longest: int) -> DataFrame:
    """doc_id and problem of lists that a training run would refuse."""
    problem = F.array_compact(F.array(
        F.when(F.array_max("tokens") >= vocab, "id beyond vocabulary"), F.when(F.array_min("tokens") < 0, "negative id"),
        F.when(F.size("tokens") > longest, "longer than the budget"),
    ))
    return token_lists.select("doc_id", F.explode(problem).alias("problem"))


def first_sample(docs: DataFrame, n: int = 64) -> DataFrame:
    """The first n ids of the first document with tokens, as text; only that document is tokenized."""
    first = tokenized(with_words(docs).orderBy("doc_id").limit(1))
    return first.select("doc_id", F.array_join(F.slice("tokens", 1, n).cast("array<string>"), " ").alias("sample"))


def with_extension(rows: DataFrame, path: str, extensions: tuple[str, ...]) -> DataFrame:
    """Number of paths by whether they end in one of the extensions."""
    ends = F.lit(False)
    for e in extensions:
        ends |= F.lower(F.col(path)).endswith(e)
    return rows.groupBy(F.coalesce(ends, F.lit(False)).alias("matches")).agg(F.count("*").alias("n"))


def known_inputs(batches: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Only the columns ``keys`` of the batches (those that are there), null where all of them are: as ``inputs``, beside the id."""
    here = [k for k in keys if k in batches.columns]
    some = F.coalesce(*[F.col(k).isNotNull() for k in here]) if len(here) == 1 else F.greatest(*[F.col(k).isNotNull() for k in here])
    return batches.select("doc_id", F.when(some, F.struct(*here)).alias("inputs"))


def length_errors(batches: DataFrame, tokens: str, keys: tuple[str, ...]) -> DataFrame:
    """doc_id, name, size, expected of every side channel (an array column) whose length is not that of the tokens; absent
    channels (null) are fine."""
    each = [F.struct(F.lit(k).alias("name"), F.size(k).alias("size")) for k in keys if k in batches.columns]
    rows = batches.select("doc_id", F.size(tokens).alias("expected"), F.explode(F.array(*each)).alias("c"))
    return rows.filter((F.col("c.size") >= 0) & (F.col("c.size") != F.col("expected"))).select("doc_id", "c.name", "c.size", "expected")
