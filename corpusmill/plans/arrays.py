"""Sequence and array operators over ``documents``, ``embeddings``, ``lineitem`` and ``part``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import arrays
from corpusmill.functions.scalars import coerced, is_setting, typed
from corpusmill.operators import corpus, sequence
from corpusmill.plans.corpus import TOK
from corpusmill.plans.registry import query
from corpusmill.sources.tables import table

ORDERS, HEADS, TARGET = [2, 3], 2, 500_000


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return corpus.tokenized(table(spark, d, "documents"))


def _ngram_sql() -> str:
    sizes, parts, offset = arrays.table_sizes(len(ORDERS) * HEADS, TARGET), [], 0
    for t, size in enumerate(sizes):
        value = f"t0 * {arrays.multiplier(t, 0)}"
        for back in range(1, ORDERS[t // HEADS]):
            value = f"xor({value}, t{back} * {arrays.multiplier(t, back)})"
        parts.append(f"xor({value}, {arrays.bias(t)}) % {size} + {offset}")
        offset += size
    return ", ".join(f"sum({p})::bigint as s{i}, max({p}) as m{i}" for i, p in enumerate(parts))


@query(f"""with {TOK}, x as (select doc_id, unnest(range(1, len(tokens) + 1)) as i, tokens from t),
p as (select doc_id, tokens[i] as t0, case when i > 1 then tokens[i - 1] else 0 end as t1, case when i > 2 then tokens[i - 2] else 0 end as t2 from x) select doc_id, {_ngram_sql()} from p group by doc_id""")
def arrays_ngram_ids(spark: SparkSession, d: str) -> DataFrame:
    ids = arrays.ngram_ids(F.col("tokens"), ORDERS, HEADS, TARGET)
    rows = _tokens(spark, d).select("doc_id", *[c.alias(f"a{i}") for i, c in enumerate(ids)])
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, v: s + v)
    return rows.select("doc_id", *[c for i in range(len(ids)) for c in (total(f"a{i}").alias(f"s{i}"), F.array_max(f"a{i}").alias(f"m{i}"))])


@query(f"""with {TOK}, x as (select doc_id, unnest(tokens) as t from t) select doc_id, sum(greatest(0, least(t % 11 - 1, 8)))::bigint as structure, sum(greatest(0, least(t % 40, 31)) + 9)::bigint as depth, count(*) as n from x group by doc_id""")
def arrays_component_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = _tokens(spark, d)
    parts = {"structure": (F.transform("tokens", lambda t: t % 11 - 1), 9), "depth": (F.transform("tokens", lambda t: t % 40), 32)}
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, v: s + v)
    return rows.select("doc_id", *[total(c).alias(n) for n, c in arrays.component_ids(parts).items()], F.size("tokens").cast("long").alias("n"))


@query(f"""with {TOK}, x as (select doc_id, unnest(tokens) as token, unnest(range(0, len(tokens))) as pos from t), y as (select doc_id, pos,
  coalesce(lead(token, 1) over w, 0) as t1, coalesce(lead(token, 2) over w, -1) as g1, coalesce(lead(token, 2) over w, 0) as t2, coalesce(lead(token, 3) over w, -1) as g2 from x window w as (partition by doc_id order by pos)),
z as (select doc_id, pos, 1 as depth, t1 as token, g1 as target from y union all select doc_id, pos, 2, t2, g2 from y)
select doc_id, depth, count(*) as n, sum(token)::bigint as tokens, sum(target)::bigint as targets, sum((pos + 1) * (token + 2 * target))::bigint as placed from z group by 1, 2""")
def arrays_shifted(spark: SparkSession, d: str) -> DataFrame:
    rows = sequence.shifted(_tokens(spark, d), 2)
    placed = F.sum((F.col("pos") + 1) * (F.col("token") + 2 * F.col("target"))).alias("placed")
    return rows.groupBy("doc_id", "depth").agg(F.count("*").alias("n"), F.sum("token").alias("tokens"), F.sum("target").alias("targets"), placed)


S = "s as (select vec_id as row, unnest(range(64))::int as pos, round(unnest(embedding)::double, 6) as score from embeddings)"


def _scores(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("row"), F.posexplode("embedding").alias("pos", "score"))
    return rows.withColumn("score", F.round(F.col("score").cast("double"), 6))


@query(f"with {S} select * from (select *, row_number() over (partition by row order by score desc, pos)::int as rank from s) where rank <= 8")
def arrays_top_k(spark: SparkSession, d: str) -> DataFrame:
    return sequence.top_k(_scores(spark, d), 8)


@query(f"""with {S}, b as (select *, row % 20 as low, 64 - row % 7 as high from s)
select row, pos, score, rank from (select *, row_number() over (partition by row order by score desc, pos)::int as rank from b where pos >= low and pos < high) where rank <= 8""")
def arrays_top_k_in_bounds(spark: SparkSession, d: str) -> DataFrame:
    bounds = table(spark, d, "embeddings").selectExpr("vec_id as row", "vec_id % 20 as start", "64 - vec_id % 7 as end")
    return sequence.selected_top_k(_scores(spark, d), 8, bounds)


def _lists(spark: SparkSession, d: str, by: str) -> DataFrame:
    best = sequence.top_k(_scores(spark, d).withColumn("score", F.expr(by)), 8)
    return best.groupBy("row").agg(F.collect_list("pos").alias("idx"))


OVER = f"""{S}, a as (select row, pos from (select *, row_number() over (partition by row order by score desc, pos) as k from s) where k <= 8), b as (select row, pos from (select *, row_number() over (partition by row order by round(score, 1) desc, pos) as k from s) where k <= 8),
o as (select a.row, count(b.pos)::int as common from a left join b using (row, pos) group by a.row)"""


@query(f"with {OVER} select row, common, 8 as k from o")
def arrays_overlap(spark: SparkSession, d: str) -> DataFrame:
    return sequence.overlap(_lists(spark, d, "score"), _lists(spark, d, "round(score, 1)"), 8).drop("same_shape")


@query(f"with {OVER} select round(100.0 * sum(common) / (8 * count(*)), 6) as pct from o")
def arrays_mean_overlap(spark: SparkSession, d: str) -> DataFrame:
    return sequence.mean_overlap(sequence.overlap(_lists(spark, d, "score"), _lists(spark, d, "round(score, 1)"), 8))


@query("""with p as (select l_orderkey % 300 as query, l_partkey % 350 - 5 as idx from lineitem), m as (select *, case when idx < 0 or idx >= 300 then -1 else idx end as pos from p) select query, idx, pos, pos >= 0 and pos <= query as visible from m""")
def arrays_masks(spark: SparkSession, d: str) -> DataFrame:
    return sequence.masked_positions(table(spark, d, "lineitem").selectExpr("l_orderkey % 300 as query", "l_partkey % 350 - 5 as idx"), 300)


PAIRS = """e as (select vec_id, vec_id // 16 as b, vec_id % 16 as pos, list_transform(embedding, lambda c: c::double) as x from embeddings),
s as (select q.b, q.pos as row, k.pos as pos, list_sum(list_transform(list_zip(q.x, k.x), lambda p: p[1] * p[2])) as score, k.x as v from e q join e k on q.b = k.b and k.pos <= q.pos),
m as (select *, max(score) over (partition by b, row) as top from s),
w as (select *, exp(score - top) / sum(exp(score - top)) over (partition by b, row) as weight, top + ln(sum(exp(score - top)) over (partition by b, row)) as lse from m)"""


def _weights(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    queries = e.selectExpr("vec_id div 16 as b", "vec_id % 16 as pos", "embedding as q")
    keys = e.selectExpr("vec_id div 16 as k_b", "vec_id % 16 as k_pos", "embedding as k")
    return sequence.softmax(sequence.causal_scores(queries, keys, "b"), ["b", "row"])


@query(f"with {PAIRS} select b, row, count(*) as n, round(max(weight), 6) as top, round(max(lse), 6) as lse from w group by 1, 2")
def arrays_softmax(spark: SparkSession, d: str) -> DataFrame:
    return _weights(spark, d).groupBy("b", "row").agg(F.count("*").alias("n"), F.round(F.max("weight"), 6).alias("top"), F.round(F.max("lse"), 6).alias("lse"))


@query(f"with {PAIRS}, each as (select b, row, weight, unnest(v) as v, unnest(range(len(v)))::int as dim from w) select b, row, dim, round(sum(weight * v), 6) + 0.0 as out from each group by 1, 2, 3")
def arrays_attended(spark: SparkSession, d: str) -> DataFrame:
    values = table(spark, d, "embeddings").select(F.col("vec_id").alias("pos"), F.posexplode("embedding").alias("dim", "value")).withColumn("value", F.col("value").cast("double"))
    out = sequence.attended(_weights(spark, d).withColumn("pos", F.col("b") * 16 + F.col("pos")), values, ["b", "row", "dim"])
    return out.withColumn("out", F.col("out") + 0.0)


@query("""with s as (select vec_id as row, unnest(embedding)::double as p, unnest(list_reverse(embedding))::double as q from embeddings),
m as (select *, max(p) over (partition by row) as tp, max(q) over (partition by row) as tq from s), w as (select row, exp(p - tp) / sum(exp(p - tp)) over (partition by row) as p, exp(q - tq) / sum(exp(q - tq)) over (partition by row) as q from m)
select row, round(sum(p * (ln(p + 1e-10) - ln(q + 1e-10))), 6) as kl from w group by row""")
def arrays_divergence(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "embeddings").select(F.col("vec_id").alias("row"), F.explode(F.arrays_zip(F.col("embedding").alias("p"), F.reverse("embedding").alias("q"))).alias("z"))
    return sequence.divergence(pairs.select("row", F.col("z.p").cast("double").alias("p_score"), F.col("z.q").cast("double").alias("q_score")), ["row"])


@query("""with m as (select l_linenumber % 3 as depth, sum(l_discount * (l_returnflag <> 'R')::int) / greatest(sum((l_returnflag <> 'R')::int), 1) as mean from lineitem group by 1) select round(sum(pow(0.8, depth) * mean) / sum(pow(0.8, depth)), 6) as loss from m""")
def arrays_weighted_loss(spark: SparkSession, d: str) -> DataFrame:
    return sequence.weighted_loss(table(spark, d, "lineitem").selectExpr("l_linenumber % 3 as depth", "l_discount as loss", "cast(l_returnflag <> 'R' as int) as mask"), 0.8)


X = "x as (select vec_id as id, unnest(range(64))::bigint as pos, round(unnest(embedding)::double, 4) as x from embeddings)"


def _values(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.posexplode("embedding").alias("pos", "x"))
    return rows.select("id", F.col("pos").cast("long").alias("pos"), F.round(F.col("x").cast("double"), 4).alias("x"))


@query(f"with {X} select id, pos // 16 as block, max(abs(x)) as absmax from x group by 1, 2")
def arrays_block_maxima(spark: SparkSession, d: str) -> DataFrame:
    return sequence.blocks(_values(spark, d), 16)


@query(f"""with {X}, m as (select *, max(abs(x)) over (partition by id, pos // 16) as a from x), q as (select *, case when a = 0 then 0 else greatest(-127, least(127, round(x * 127 / a))) end::int as q from m)
select id, sum(abs(q))::bigint as q_sum, round(max(abs(q * a / 127 - x)), 6) as worst from q group by id""")
def arrays_quantised(spark: SparkSession, d: str) -> DataFrame:
    rows = sequence.quantised_blocks(_values(spark, d), 16)
    return rows.groupBy("id").agg(F.sum(F.abs("q")).alias("q_sum"), F.round(F.max(F.abs(F.col("back") - F.col("x"))), 6).alias("worst"))


@query(f"""with recursive {X}, m as (select *, max(abs(x)) over (partition by id) as a from x),
walk as (select id, 0::bigint as pos, 0.0::double as m from m where pos = 0
  union all select s.id, s.pos + 1, case when s.a = 0 then 0.0 else greatest(-127, least(127, round((0.9 * w.m + 0.09999999999999998::double * s.x) * 127 / s.a))) * s.a / 127 end from walk w join m s on s.id = w.id and s.pos = w.pos)
select id, round(max_by(m, pos), 6) + 0.0 as m from walk group by id""")
def arrays_momentum(spark: SparkSession, d: str) -> DataFrame:
    return sequence.momentum(_values(spark, d).selectExpr("id", "pos as step", "x as g"), 0.9).withColumn("m", F.col("m") + 0.0)


# Every part is a segment of a block, but each thirteenth has none (length 0), and two segments are in the way.
SEG = "g as (select p_partkey % 5 as grp, (p_partkey - 1) * 16 as start, case when p_partkey % 13 = 0 then 0 else 16 end as len from part union all select 9, 32, 16 union all select 9, 40, 7)"


def _segments(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr("p_partkey % 5 as grp", "(p_partkey - 1) * 16 as start", "if(p_partkey % 13 = 0, 0L, 16L) as len")
    return rows.unionByName(spark.createDataFrame([(9, 32, 16), (9, 40, 7)], "grp long, start long, len long"))


@query(f"""with {SEG}, ok as (select * from g where start % 16 = 0 and len % 16 = 0), c as (select grp, start // 16 as block from ok where len > 0)
select 'alignment' as problem, count(*) as n from g where start % 16 <> 0 or len % 16 <> 0 union all select 'overlap', count(*) from (select block from c group by block having count(distinct grp) > 1)
union all select 'coverage', count(*) from (select p_partkey - 1 as block from part except select block from c)""")
def arrays_segment_errors(spark: SparkSession, d: str) -> DataFrame:
    return sequence.segment_errors(_segments(spark, d), 16, table(spark, d, "part").count())


@query(f"""with {X}, y as (select id * 64 + pos as pos, x from x), {SEG}, c as (select grp, start // 16 as block from g where start % 16 = 0 and len % 16 = 0 and len > 0)
select grp, round(1 / sqrt(greatest(sum(x * x), 1e-14)), 9) as scale from y join c on pos // 16 = block group by grp""")
def arrays_group_norms(spark: SparkSession, d: str) -> DataFrame:
    cover = sequence.segment_blocks(_segments(spark, d).filter("start % 16 = 0 and len % 16 = 0"), 16)
    return sequence.group_norms(_values(spark, d).selectExpr("id * 64 + pos as pos", "x"), cover, 16)


@query("""with l as (select p_partkey // 50 as part, p_partkey as rank, p_size % 7 = 0 as is_full from part), f as (select *, last_value(case when is_full then rank end ignore nulls) over (partition by part order by rank) as s from l)
select part, rank, coalesce(s, rank) as source, s is null as promoted from f""")
def arrays_nearest_before(spark: SparkSession, d: str) -> DataFrame:
    return sequence.nearest_before(table(spark, d, "part").selectExpr("p_partkey div 50 as part", "p_partkey as rank", "p_size % 7 = 0 as is_full"))


@query("""with r as (select o_custkey as grp, row_number() over (partition by o_custkey order by o_orderkey) as pos, row_number() over (partition by o_custkey order by o_totalprice) as value from orders) select grp, bool_and(pos = value) as identity from r group by grp""")
def arrays_identity(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").selectExpr("o_custkey as grp", "row_number() over (partition by o_custkey order by o_orderkey) as pos", "row_number() over (partition by o_custkey order by o_totalprice) as value")
    return sequence.is_identity(rows)


@query(f"with {X} select id, pos // 8 as head, round(sum(x), 6) as x from x group by 1, 2")
def arrays_unbroadcast(spark: SparkSession, d: str) -> DataFrame:
    return sequence.unbroadcast(_values(spark, d).withColumnRenamed("pos", "head"), 8)


@query("select p_partkey as key, p_partkey - 1 as row, round(list_sum(list_transform(embedding, lambda c: c::double)), 6) as x from part left join embeddings on vec_id = p_partkey - 1")
def arrays_lookup(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "part").selectExpr("p_partkey as key", "p_partkey - 1 as row")
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("row"), F.col("embedding").alias("v"))
    return sequence.looked_up(ids, vectors).select("key", "row", F.round(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double")), 6).alias("x"))


@query(f"with {X} select id, pos, round(sum(x) over (partition by id order by pos), 6) + 0.0 as angle from x")
def arrays_running_angles(spark: SparkSession, d: str) -> DataFrame:
    return sequence.running_angles(_values(spark, d)).select("id", "pos", (F.round("angle", 6) + 0.0).alias("angle"))


@query(f"""with {X}, g as (select id, pos, abs(x) as dt, 1 / (1 + exp(-x)) as gate from x), n as (select *, lead(dt, 1, 0.0) over (partition by id order by pos) as dn, lead(gate, 1, 0.5) over (partition by id order by pos) as gn from g)
select id, pos, round(dn * (1 - gn) + dt * gate, 6) as scale from n""")
def arrays_trapezoid(spark: SparkSession, d: str) -> DataFrame:
    return sequence.trapezoid(_values(spark, d).selectExpr("id", "pos", "abs(x) as dt", "x as trap"))


@query("""with v as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings), m as (select vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x)) / 64 + 1e-5) as r from v)
select vec_id, round(e[1] / r, 6) as normed, round(e[1] * cos(0.5) - e[2] * sin(0.5), 6) as turned, round(exp(-exp(0.25) * ln(1 + exp(e[3] + 0.5))), 6) as decayed, round(list_sum(list_transform(range(1, 65), lambda i: e[i] * e[65 - i])), 6) as crossed from m""")
def arrays_vector_functions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    e = F.col("e")
    return rows.select(
        "vec_id", F.round(arrays.rms_normed(e)[0], 6).alias("normed"), F.round(arrays.rotated(e, F.lit(0.5))[0], 6).alias("turned"),
        F.round(arrays.decay(e[2], F.lit(0.25), F.lit(0.5)), 6).alias("decayed"), F.round(arrays.dot(e, F.reverse(e)), 6).alias("crossed"),
    )


@query("""with b as (select p_partkey, p_partkey % 256 as b, p_size % 10 + 120 as e from part), v as (select *, (b >> 3) & 15 as x, b & 7 as f from b)
select p_partkey, case when x = 15 and f = 7 then null when p_partkey % 10 = 0 then 0.0 else (case when b >= 128 then -1.0 else 1.0 end) * (case when x = 0 then f / 8.0 * pow(2.0, -6) else (1 + f / 8.0) * pow(2.0, x - 7) end) * pow(2.0, e - 127) end::double as value from v""")
def arrays_scaled_floats(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr("p_partkey", "cast(p_partkey % 256 as int) as b", "if(p_partkey % 10 = 0, 0, p_size % 10 + 120) as e")
    value = arrays.scaled_e4m3(F.col("b"), F.col("e"))
    number = ~F.col("b").isin(127, 255)
    return rows.select("p_partkey", F.when(number, value).alias("value"))


PATTERNS = "p as (select p_partkey, ['AEME', 'aemd', 'AE|ME|AEMDGR', 'MMMR'][p_partkey % 4 + 1] as p from part)"
LAYERS = f"""{PATTERNS}, u as (select p_partkey, upper(p) as p, replace(upper(p), '|', '') as f from p), l as (select p_partkey, case when p like '%|%' then case when length(f) = 12 then f end else array_to_string(list_transform(range(12), lambda i: p[(i % length(p) + 1)::int]), '') end as s from u)"""


@query(f"""with {LAYERS} select p_partkey, translate(s, 'AD', '*G') || '/*-' as layers, translate(s, 'ARD', '*MG') as lite, case when s is not null then array_to_string(list_filter(range(1, 13), lambda i: s[i::int] = 'A'), ',') end as attention,
  s[1:4] || '|' || s[5:8] || '|' || s[9:12] as piped from l""")
def arrays_layer_patterns(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr("p_partkey", "array('AEME', 'aemd', 'AE|ME|AEMDGR', 'MMMR')[p_partkey % 4] as p")
    symbols = F.col("s")
    rows = rows.select("p_partkey", arrays.layers(F.col("p"), 12).alias("s"))
    return rows.select(
        "p_partkey", arrays.mapped_layers(symbols, 1).alias("layers"), arrays.lite_layers(symbols).alias("lite"),
        F.array_join(arrays.places_of(symbols, ("A",)).cast("array<string>"), ",").alias("attention"), arrays.piped(F.array_join(symbols, ""), 3).alias("piped"),
    )


@query(f"with {LAYERS}, x as (select unnest(string_split(s, '')) as symbol from l where s is not null) select symbol, count(*) as n from x where symbol <> '' group by 1")
def arrays_layer_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr("array('AEME', 'aemd', 'AE|ME|AEMDGR', 'MMMR')[p_partkey % 4] as p")
    return rows.select(F.explode(arrays.layers(F.col("p"), 12)).alias("symbol")).filter("symbol <> ''").groupBy("symbol").agg(F.count("*").alias("n"))


@query("select p_partkey, case p_partkey % 3 when 0 then 'int' when 1 then 'float' else 'error' end as kind, p_partkey % 30 < 4 or p_partkey % 30 >= 28 as is_edge from part where p_partkey % 7 <> 2")
def arrays_coerced(spark: SparkSession, d: str) -> DataFrame:
    text = F.expr("array(cast(p_size as string), concat(p_size, '.5'), p_type)[p_partkey % 3]")
    rows = table(spark, d, "part").withColumn("key", F.expr("if(p_partkey % 7 = 2, '_token', 'rate')")).filter(is_setting(F.col("key")))
    return rows.select("p_partkey", coerced(text).alias("kind"), arrays.is_edge_layer(F.col("p_partkey") % 30, 30, 4, 2).alias("is_edge"))


@query("""select p_partkey, case p_partkey % 3 when 0 then 'int' when 1 then 'float' else 'error' end as kind, case when p_partkey % 3 = 0 then p_size::bigint end as whole,
  case when p_partkey % 3 = 1 then p_size + 0.5::double end as real from part where p_partkey % 7 <> 2""")
def arrays_typed(spark: SparkSession, d: str) -> DataFrame:
    text = F.expr("array(cast(p_size as string), concat(p_size, '.5'), p_type)[p_partkey % 3]")
    rows = table(spark, d, "part").withColumn("key", F.expr("if(p_partkey % 7 = 2, '_token', 'rate')")).filter(is_setting(F.col("key")))
    return rows.select("p_partkey", typed(text).alias("v")).select("p_partkey", "v.*")


@query("select p_partkey, p_size || ',' || p_size || ',' || p_partkey || ',' || p_partkey as heads from part")
def arrays_repeated_heads(spark: SparkSession, d: str) -> DataFrame:
    heads = arrays.repeated_heads(F.array(F.col("p_size").cast("long"), F.col("p_partkey")), 2)
    return table(spark, d, "part").select("p_partkey", F.array_join(heads.cast("array<string>"), ",").alias("heads"))


RECURRENCE = f"""{X}, walk as (select id, pos, (1 - (0.5 + x / 4)) * tanh(x) as h from x where pos = 0
  union all select s.id, s.pos, (0.5 + s.x / 4) * w.h + (1 - (0.5 + s.x / 4)) * tanh(w.h * 0.3 + s.x) from walk w join x s on s.id = w.id and s.pos = w.pos + 1)"""


def _gated(spark: SparkSession, d: str) -> DataFrame:
    return _values(spark, d).selectExpr("id", "pos", "x", "0.5D + x / 4 as f", "0.3D as w")


@query(f"with recursive {RECURRENCE} select id, pos, round(h, 6) + 0.0 as h from walk")
def arrays_recurrence(spark: SparkSession, d: str) -> DataFrame:
    return sequence.recurrence(_gated(spark, d)).select("id", "pos", (F.round("h", 6) + 0.0).alias("h"))


@query(f"with recursive {RECURRENCE} select id, pos // 16 as chunk, round(max_by(h, pos), 6) + 0.0 as h from walk group by 1, 2")
def arrays_chunked_recurrence(spark: SparkSession, d: str) -> DataFrame:
    return sequence.chunked_recurrence(_gated(spark, d), 16).select("id", "chunk", (F.round("h", 6) + 0.0).alias("h"))


@query("""with e as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings)
select vec_id, round(least(-exp(0.25) - ln(1 + exp(0.5 * sqrt(list_sum(list_transform(e, lambda x: x * x))) + 0.25)), -0.01), 6) as decay, round(list_sum(list_transform(range(1, 9), lambda i: e[i])) * e[1], 6) as outer_sum,
  round(greatest(list_sum(list_transform(range(1, 9), lambda i: e[i] * e[i + 16])), 0) * e[1] + greatest(list_sum(list_transform(range(1, 9), lambda i: e[i + 8] * e[i + 16])), 0) * e[2], 6) + 0.0 as heads from e""")
def arrays_head_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    e, part = F.col("e"), lambda a, n=8: F.slice("e", a, n)
    products = arrays.outer(part(1, 1), part(1))
    return rows.select(
        "vec_id", F.round(arrays.modulated_decay(e, F.lit(0.25), F.lit(0.5), F.lit(0.25)), 6).alias("decay"),
        F.round(F.aggregate(products[0], F.lit(0.0), lambda s, v: s + v), 6).alias("outer_sum"),
        (F.round(arrays.head_scores(F.array(part(1), part(9)), part(17), part(1, 2)), 6) + 0.0).alias("heads"),
    )


@query("""with r as (select p_partkey, p_partkey % 3 = 0 as gone, p_size % 9 as a, p_partkey % 40 as b from part)
select p_partkey, case when not gone then greatest(0, least(a, 5)) end as structure, greatest(0, least(b, 31)) + 6 as dep_level, round((case when gone then 0 else greatest(0, least(a, 5)) / 10.0 end + (greatest(0, least(b, 31)) + 6) / 10.0) / 2, 6)::double as total from r""")
def arrays_component_sum(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 != 0, F.array((F.col("p_size") % 9).cast("long"))).alias("a"), F.array(F.col("p_partkey") % 40).alias("b"))
    names = arrays.parsed_components("core")
    rows = rows.withColumns(arrays.component_ids(dict(zip(names, ((F.col("a"), 6), (F.col("b"), 32)), strict=True))))
    vectors = [F.transform(F.coalesce(n, F.array(F.lit(0).cast("long"))), lambda i: i / 10.0) for n in names]
    total = arrays.component_sum(vectors, [F.col(n).isNotNull() for n in names])
    return rows.select("p_partkey", *[F.col(n)[0].alias(n) for n in names], F.round(total[0], 6).alias("total"))


@query("""with v as (select p_partkey, [p_size * 20.0::double, -p_partkey % 7 * 3.0::double, p_retailprice] as x from part), c as (select p_partkey, list_transform(x, lambda v: greatest(-448.0::double, least(448.0::double, v))) as x from v),
s as (select p_partkey, x, list_max(list_transform(x, lambda v: abs(v))) / 448.0::double as a from c), n as (select p_partkey, x, case when a > 0 then a else 1.0::double end as a from s),
q as (select p_partkey, a, unnest(x) / a as y from n), g as (select *, case when y = 0 then 1.0::double else pow(2.0::double, greatest(floor(log2(abs(y))), -6) - 3) end as step from q)
select p_partkey, round(max(a), 9) as scale, round(sum(greatest(-448.0::double, least(448.0::double, round_even(y / step, 0) * step))), 6) as total from g group by p_partkey""")
def arrays_packed_floats(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.expr("array(p_size * 20.0D, -p_partkey % 7 * 3.0D, p_retailprice)").alias("x"))
    values, scale = arrays.e4m3_packed(F.col("x"), clamp=True)
    return rows.select("p_partkey", F.round(scale, 9).alias("scale"), F.round(F.aggregate(values, F.lit(0.0), lambda s, v: s + v), 6).alias("total"))


HEAD_SQL = """h as (select vec_id // 16 as b, vec_id % 16 as head, unnest(range(32)) as pos, unnest(embedding[1:32])::double as p from embeddings),
q as (select b, pos, avg(q) as q from (select vec_id // 16 as b, unnest(range(32)) as pos, unnest(embedding[33:64])::double as q from embeddings) group by 1, 2),
hp as (select *, exp(p - max(p) over (partition by b, head)) as e from h), hm as (select *, e / sum(e) over (partition by b, head) as w from hp), mean as (select b, pos, avg(w) as p from hm group by 1, 2),
qp as (select *, exp(q - max(q) over (partition by b)) as e from q), qm as (select *, e / sum(e) over (partition by b) as w from qp), kl as (select b, sum(mean.p * (ln(mean.p + 1e-10) - ln(qm.w + 1e-10))) as kl from mean join qm using (b, pos) group by b)"""


def _head_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    part = lambda start, out: F.posexplode(F.transform(F.slice("embedding", start, 32), lambda c: c.cast("double"))).alias("pos", out)
    b = F.expr("vec_id div 16").alias("b")
    q = rows.select(b, part(33, "q")).groupBy("b", "pos").agg(F.avg("q").alias("q_score"))
    return rows.select(b, (F.col("vec_id") % 16).alias("head"), part(1, "p_score")).join(q, ["b", "pos"])


@query(f"with {HEAD_SQL} select round(avg(kl) * 0.01, 6) as loss from kl")
def arrays_divergence_loss(spark: SparkSession, d: str) -> DataFrame:
    return sequence.divergence_loss(_head_rows(spark, d), ["b"], "head", 0.01)


@query(f"with {X}, m as (select id, max(x) as top from x group by id) select id, round(top, 6) as top, round(sum(exp(x - top)), 6) as denominator from x join m using (id) group by 1, 2")
def arrays_split_softmax(spark: SparkSession, d: str) -> DataFrame:
    out = sequence.split_softmax(_values(spark, d).withColumnRenamed("x", "score"), ["id"], 24)
    return out.select("id", F.round("top", 6).alias("top"), F.round("denominator", 6).alias("denominator"))


@query(f"""with {OVER}, n as (select row, count(*) as whole, case when row = 0 then least(count(*), 7) else count(*) end as short from a group by row)
select case when bool_or(whole <> short) then 'nan'::double else (select round(100.0 * sum(common) / (8 * count(*)), 6) from o) end as pct from n""")
def arrays_overlap_of_other_shape(spark: SparkSession, d: str) -> DataFrame:
    short = _lists(spark, d, "score").withColumn("idx", F.expr("if(row = 0, slice(idx, 1, 7), idx)"))
    return sequence.mean_overlap(sequence.overlap(short, _lists(spark, d, "score"), 8))


@query("""select doc_id, case when doc_id % 3 <> 0 or doc_id % 4 <> 0 then 1 end as there, case when doc_id % 3 <> 0 then n_chars % 5 end as structure, case when doc_id % 4 <> 0 then n_chars % 7 end as level from documents""")
def arrays_known_inputs(spark: SparkSession, d: str) -> DataFrame:
    batches = table(spark, d, "documents").selectExpr("doc_id", "if(doc_id % 3 <> 0, array(n_chars % 5), null) as structure_ids", "if(doc_id % 4 <> 0, array(n_chars % 7), null) as dep_levels", "lang as other")
    out = corpus.known_inputs(batches, arrays.SIDE_CHANNELS)
    return out.select("doc_id", F.when(F.col("inputs").isNotNull(), 1).alias("there"), F.col("inputs.structure_ids")[0].alias("structure"), F.col("inputs.dep_levels")[0].alias("level"))


@query(f"""with {TOK} select doc_id, 'structure_ids' as name, len(tokens)::int + 1 as size, len(tokens)::int as expected from t where doc_id % 10 = 3
union all select doc_id, 'dep_levels', len(tokens)::int - 1, len(tokens)::int from t where doc_id % 15 = 4""")
def arrays_length_errors(spark: SparkSession, d: str) -> DataFrame:
    rows = _tokens(spark, d).withColumns({
        "structure_ids": F.expr("if(doc_id % 10 = 3, concat(tokens, array(0L)), tokens)"), "dep_levels": F.expr("if(doc_id % 15 = 4, slice(tokens, 2, size(tokens)), if(doc_id % 15 = 5, null, tokens))"),
    })
    return corpus.length_errors(rows, "tokens", arrays.SIDE_CHANNELS)


@query("""select event_id as id, '{"k": ' || (props::json ->> 'k') || '}' as object from events""")
def arrays_first_objects(spark: SparkSession, d: str) -> DataFrame:
    return sequence.first_objects(table(spark, d, "events").select(F.col("event_id").alias("id"), F.concat(F.lit("log {x: } { "), "props", F.lit(" end")).alias("value")))
