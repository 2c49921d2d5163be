"""Corpus preparation over ``documents`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import corpus, seeded
from corpusmill.plans.registry import query
from corpusmill.sources import sinks
from corpusmill.sources.tables import scratch_path, table

ROWS_PER_FILE, BUDGET = 300, 256
TOK = """tok as (select doc_id, list_transform(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda w: w <> ''),
  lambda w: ('0x' || substr(md5(w), 1, 8))::bigint % 131072) as tokens from documents),
t as (select * from tok where len(tokens) > 0)"""
PLAN = f"""o as (select doc_id, row_number() over (order by doc_id) - 1 as ord, count(*) over () as total from documents),
plan as (select doc_id, (ord // {ROWS_PER_FILE})::bigint as shard,
  case when total % {ROWS_PER_FILE} > greatest(1, floor(total * 0.01)) and ord >= total - greatest(1, floor(total * 0.01)) then 'val' else 'train' end as part from o)"""

# The words of a Mersenne Twister seeded with 42 (states a, b, c as its seeding makes them; blocks of 227 words, which hang on no word of
# the same block), the draws below i + 1 from them (a word's top bits, those too great thrown away), and the swaps of each shard.
TWISTER = f"""a(k, v) as (select 0, 19650218::bigint union all select k + 1, (1812433253 * xor(v, v >> 30) + k + 1) & 4294967295 from a where k < 623),
b(k, v, one) as (select 0, v, 0::bigint from a where k = 0 union all
  select b.k + 1, (xor(case when b.k < 623 then a.v else b.one end, xor(b.v, b.v >> 30) * 1664525) + 42) & 4294967295,
    case when b.k = 0 then (xor(a.v, xor(b.v, b.v >> 30) * 1664525) + 42) & 4294967295 else b.one end
  from b join a on a.k = (b.k + 1) % 624 where b.k < 624),
c(k, v) as (select 1, v from b where k = 624 union all
  select c.k + 1, (xor(b.v, xor(c.v, c.v >> 30) * 1566083941) - case when c.k < 623 then c.k + 1 else 1 end) & 4294967295 from c join b on b.k = c.k + 1 where c.k < 624),
blocks(n, s, fresh) as (select 0, [2147483648::bigint] || (select list(v order by k % 624) from c where k > 1), []::bigint[] union all
  select n + 1, s[228:624] || new, new from (select n, s, list_transform(range(1, 228), lambda i: xor(xor(s[i + 397], ((s[i] & 2147483648) | (s[i + 1] & 2147483647)) >> 1),
    (s[i + 1] & 1) * 2567483615)) as new from blocks) where n * 227 < (select 2 * count(*) + 1000 from documents)),
raw as (select n * 227 + unnest(range(0, 227)) - 227 as t, unnest(fresh) as y from blocks where n > 0),
raw1 as (select t, xor(y, y >> 11) as y from raw), raw2 as (select t, xor(y, (y << 7) & 2636928640) as y from raw1),
raw3 as (select t, xor(y, (y << 15) & 4022730752) as y from raw2), words as materialized (select t, xor(y, y >> 18) as y from raw3),
files as materialized (select row_number() over (order by shard) as q, shard, count(*) as n, list(doc_id order by doc_id) as ids from plan where part = 'train' group by shard having count(*) > 1),
draws(t, q, i, drawn_q, drawn_i, j, passed) as (select 0::bigint, 1::bigint, n - 1, 0::bigint, 0::bigint, 0::bigint, false from files where q = 1 union all
  select t + 1, case when ok and i = 1 then q + 1 else q end, case when not ok then i when i > 1 then i - 1 else (select n - 1 from files f where f.q = x.q + 1) end, q, i, j, ok
  from (select d.t, d.q, d.i, w.y >> (32 - length(bin(d.i + 1))) as j, w.y >> (32 - length(bin(d.i + 1))) <= d.i as ok from draws d join words w on w.t = d.t where d.i is not null) x),
swaps as materialized (select drawn_q as q, drawn_i as i, j from draws where passed),
orders(q, i, l) as (select q, n, ids from files union all
  select o.q, s.i, list_transform(o.l, lambda v, k: case when k = s.i + 1 then o.l[s.j + 1] when k = s.j + 1 then o.l[s.i + 1] else v end)
  from orders o join swaps s on s.q = o.q and s.i = o.i - 1),
done as (select f.shard, unnest(l) as doc_id, unnest(range(1, len(l) + 1)) as place from orders join files f using (q) where orders.i = 1)"""


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return corpus.tokenized(table(spark, d, "documents"))


def _plan(spark: SparkSession, d: str) -> DataFrame:
    return corpus.shard_plan(table(spark, d, "documents"), ROWS_PER_FILE)


@query(f"""with {TOK} select doc_id, row_number() over (order by doc_id) - 1 as ord, len(tokens)::int as size,
  (coalesce(sum(len(tokens)) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) * 4)::bigint as pointer from t""")
def corpus_packed_index(spark: SparkSession, d: str) -> DataFrame:
    return corpus.packed_index(corpus.sized(table(spark, d, "documents")))


@query(f"with {TOK} select row_number() over () - 1 as doc_idx from t union all select count(*) from t")
def corpus_document_index(spark: SparkSession, d: str) -> DataFrame:
    return corpus.document_index(corpus.with_words(table(spark, d, "documents")))


@query(f"""with {TOK} select count(*) as n_docs, sum(len(tokens))::bigint as n_tokens, min(list_min(tokens)) as min_id,
  max(list_max(tokens)) as max_id, max(list_max(tokens)) < 131072 as in_vocab from t""")
def corpus_totals(spark: SparkSession, d: str) -> DataFrame:
    return corpus.totals(_tokens(spark, d))


@query(f"with {PLAN} select * from plan")
def corpus_shard_plan(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d)


@query(f"""with {PLAN} select count(distinct case when part = 'train' then shard end) as n_shards, count(case when part = 'train' then 1 end) as n_train,
  count(case when part = 'val' then 1 end) as n_val from plan""")
def corpus_shard_sentinel(spark: SparkSession, d: str) -> DataFrame:
    return corpus.shard_sentinel(_plan(spark, d))


@query("""with n as (select distinct source as shard from documents) select shard, shard <> (select max(shard) from n) or (select count(*) from n) = 1 as in_train,
  shard = (select max(shard) from n) as in_val from n""")
def corpus_split_rule(spark: SparkSession, d: str) -> DataFrame:
    return corpus.split_rule(table(spark, d, "documents"), "source", "val_shard")


@query("select distinct source as shard, source <> 'src7' as in_train, source = 'src7' as in_val from documents")
def corpus_split_named(spark: SparkSession, d: str) -> DataFrame:
    return corpus.split_rule(table(spark, d, "documents"), "source", "src7")


@query(f"""with {TOK}, {PLAN}, e as (select shard, count(*) as n_docs, sum(len(tokens))::bigint as n_tokens from t join plan using (doc_id) group by shard)
select *, (sum(n_docs) over (order by shard))::bigint as docs_upto, (sum(n_tokens) over (order by shard))::bigint as tokens_upto from e""")
def corpus_shard_totals(spark: SparkSession, d: str) -> DataFrame:
    return corpus.shard_totals(corpus.sized(table(spark, d, "documents")), _plan(spark, d))


@query(f"""with {TOK}, c as (select doc_id, tokens, unnest(range(0, (len(tokens) - 1) // {BUDGET} + 1))::int as chunk from t)
select doc_id, chunk, len(tokens[chunk * {BUDGET} + 1 : chunk * {BUDGET} + {BUDGET}])::int as n_tokens, tokens[chunk * {BUDGET} + 1] as first_id from c""")
def corpus_chunks(spark: SparkSession, d: str) -> DataFrame:
    return corpus.chunks(_tokens(spark, d), BUDGET)


@query("""with s as (select doc_id, ('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint % 100 as h from documents)
select doc_id, case when h < 98 then 'train' when h < 99 then 'val' else 'test' end as part from s""")
def corpus_ratio_split(spark: SparkSession, d: str) -> DataFrame:
    return corpus.ratio_split(table(spark, d, "documents"), {"train": 98, "val": 1, "test": 1})


@query("""with b as (select lang, count(*) as n_docs, case when lang = 'en' then 2.0 when lang = 'de' then 0.5 else 1.0 end::double as weight from documents group by lang)
select *, round(weight / sum(weight) over (), 6) as share from b""")
def corpus_blend(spark: SparkSession, d: str) -> DataFrame:
    return corpus.blend(table(spark, d, "documents"), {"en": 2.0, "de": 0.5})


@query(f"""with {PLAN} select doc_id, shard, part, row_number() over (partition by shard, part
  order by case when part = 'train' then md5('42|' || doc_id) end nulls first, doc_id)::int as place from plan""")
def corpus_shuffle(spark: SparkSession, d: str) -> DataFrame:
    return corpus.shuffled(_plan(spark, d), 42)


@query(f"""with recursive {PLAN}, {TWISTER} select doc_id, shard, 'train' as part, place::int as place from done
union all select doc_id, shard, part, row_number() over (partition by shard, part order by doc_id)::int from plan where not (part = 'train' and shard in (select shard from files))""")
def corpus_seeded_shuffle(spark: SparkSession, d: str) -> DataFrame:
    return seeded.shuffled(_plan(spark, d), 42)


@query(f"""with {TOK} select doc_id, unnest(list_filter([case when list_max(tokens) >= 131000 then 'id beyond vocabulary' end, case when list_min(tokens) < 0 then 'negative id' end,
  case when len(tokens) > 2000 then 'longer than the budget' end], lambda x: x is not null)) as problem from t""")
def corpus_violations(spark: SparkSession, d: str) -> DataFrame:
    return corpus.violations(_tokens(spark, d), 131000, 2000)


@query(f"with {TOK} select doc_id, array_to_string(tokens[1:64], ' ') as sample from t order by doc_id limit 1")
def corpus_first_sample(spark: SparkSession, d: str) -> DataFrame:
    return corpus.first_sample(table(spark, d, "documents"))


@query("""select coalesce(lower(url) like '%.html' or lower(url) like '%.htm' or lower(url) like '%5' or lower(url) like '%/', false) as matches, count(*) as n from pages group by 1""")
def corpus_extensions(spark: SparkSession, d: str) -> DataFrame:
    return corpus.with_extension(table(spark, d, "pages"), "url", (".html", ".htm", "5", "/"))


@query("""select 'documents' as kind, doc_id as id, length(text)::int as n_chars from documents where text is not null and length(trim(text)) > 0
union all select 'pages', page_id, length(html)::int from pages where html is not null and length(trim(html)) > 0""")
def corpus_text_union(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.lit("documents").alias("kind"), F.col("doc_id").alias("id"), F.col("text"))
    pages = table(spark, d, "pages").select(F.lit("pages").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    both = docs.unionByName(pages).filter(F.length(F.trim("text")) > 0)
    return both.select("kind", "id", F.length("text").alias("n_chars"))


@query(f"""with {PLAN} select count(distinct case when part = 'train' then shard end) as n_shards, count(case when part = 'train' then 1 end) as n_train,
  count(case when part = 'val' then 1 end) as n_val, count(*) as total from plan""")
def corpus_written_shards(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "text").join(_plan(spark, d), "doc_id")
    return sinks.write_shards(rows, scratch_path(spark, "shards"))
