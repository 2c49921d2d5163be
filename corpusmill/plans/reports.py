"""Reports over ``part``, ``customer`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.scalars import iso_utc
from corpusmill.operators import markdown_tables, reports
from corpusmill.plans.registry import query
from corpusmill.sources import sinks
from corpusmill.sources.tables import scratch_path, table

# Texts of orders with a table of their items: rows short of a cell and with one too many, glyphs, numbers, long words, a repeated name.
SHEETS = """items as (select l_orderkey as id, l_linenumber as k, p_name || ' — ' || p_type as what, '#' || p_partkey as num,
  'https://shop/' || lower(p_type) || '/' || l_suppkey || '/' || p_partkey || '/' || l_returnflag as link from lineitem join part on p_partkey = l_partkey),
cells as (select id, row_number() over (partition by id order by k, what, num, link) as r, k::varchar as c1, what as c2, num as c3, case when k % 3 = 0 then '' else link end as c4 from items)"""
# Single characters to take or to give, in the order in which they go, in place of the loops.
ALLOTTED = """folded as (select id, r, c1, replace(c2, '—', '--') as c2, case when length(c3) >= 4 then '#' || c3 else c3 end as c3, c4 from cells),
every as (select id, 1 as col, c1 as c from folded union all select id, 2, c2 from folded union all select id, 3, c3 from folded union all select id, 4, c4 from folded),
facts as (select id, col, max(length(c)) as body, max(list_max(list_transform(string_split(c, ' '), lambda w: length(w)))) as word from every group by 1, 2),
names as (select * from (values (1, 'line', 4, 4), (2, 'item', 4, 4), (3, 'item', 6, 6), (4, 'where', 5, 5)) v(col, name, size, longest)),
shaped as (select id, col, greatest(size, body) as nat, greatest(longest, least(16, word)) as least from facts join names using (col)),
spread as (select *, round_even(47 * nat / sum(nat) over (partition by id), 0)::int as share from shaped),
firsts as (select *, greatest(least, least(47, share)) as first from spread),
rooms as (select *, sum(first) over (partition by id) - 47 as over from firsts),
takes as (select id, col, row_number() over (partition by id order by level desc, col) as place, over from (select id, col, over, unnest(range(1, first - least + 1)) as level from rooms where over > 0)),
gives as (select id, col, row_number() over (partition by id order by phase, nat desc, col) as place, over from (
  select id, col, over, 0 as phase, nat, unnest(range(0, greatest(0, nat - first))) from rooms where over < 0
  union all select id, col, over, 1, nat, unnest(range(0, greatest(0, 47 - greatest(first, nat)))) from rooms where over < 0)),
moved as (select id, col, -count(*) as n from takes where place <= over group by 1, 2 union all select id, col, count(*) from gives where place <= -over group by 1, 2),
widths as (select id, col, nat, least, (first + coalesce(n, 0))::int as width from rooms left join moved using (id, col))"""
# The fold comes first in a cell, then the breaks of long words, then the lines.
SET = """laid as (select id, r, col, c, width from (select id, r, 1 as col, c1 as c from folded union all select id, r, 2, c2 from folded union all select id, r, 3, c3 from folded
    union all select id, r, 4, c4 from folded union all select id, 0, col, name from names, (select distinct id from folded)) join widths using (id, col)),
split as (select id, r, col, width, regexp_extract_all(trim(regexp_replace(regexp_replace(c, '([^ ]{' || width || '})', '\\1 ', 'g'), ' +', ' ', 'g')),
    '(.{1,' || width || '})(?: |$)', 1) as parts from laid),
tall as (select id, r, max(greatest(1, len(parts))) as height from split group by 1, 2),
parted as (select id, r, unnest(range(0, height)) as part from tall),
printed as (select id, r, part, '| ' || string_agg(rpad(coalesce(parts[part + 1], ''), width, ' '), ' | ' order by col) || ' |' as line from parted join split using (id, r) group by 1, 2, 3),
ruled as (select id, '|' || string_agg(repeat('-', width + 2), '|' order by col) || '|' as line from widths group by id)"""


def _sheets(spark: SparkSession, d: str) -> DataFrame:
    """id, text: each order with its items as a table, rows in the order of their line numbers and cells."""
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").join(part, F.col("l_partkey") == F.col("p_partkey"))
    link = F.concat_ws("/", F.lit("https://shop"), F.lower("p_type"), "l_suppkey", "p_partkey", "l_returnflag")
    last = F.when(F.col("l_linenumber") % 3 == 0, F.lit("|")).when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("|"), link, F.lit("| beyond |"))).otherwise(F.concat(F.lit("| "), link, F.lit(" |")))
    what, number = F.concat("p_name", F.lit(" — "), "p_type"), F.concat(F.lit("#"), "p_partkey")
    row = F.concat(F.lit("| "), "l_linenumber", F.lit(" | "), what, F.lit(" |"), number, last)
    rows = items.groupBy(F.col("l_orderkey").alias("id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", what.alias("what"), number.alias("number"), link.alias("link"), row.alias("row")))).alias("rows"))
    head = F.concat(F.lit("Order "), "id", F.lit("\n| line | item | item | where |\n|:---|---|---|---:|\n"))
    return rows.select("id", F.concat(head, F.array_join("rows.row", "\n"), F.lit("\nEnd | of order\n")).alias("text"))


@query(f"""with {SHEETS}, {ALLOTTED} select id, 1 as head, string_agg(nat, ';' order by col) as naturals, string_agg(least, ';' order by col) as mins,
  string_agg(width, ';' order by col) as widths from widths group by id""")
def report_table_widths(spark: SparkSession, d: str) -> DataFrame:
    shares = markdown_tables.allotted(markdown_tables.column_widths(markdown_tables.tables(_sheets(spark, d))), 60)
    return shares.select("id", "head", *[F.array_join(F.col(c).cast("array<string>"), ";").alias(c) for c in ("naturals", "mins", "widths")])


@query(f"""with {SHEETS}, {ALLOTTED}, {SET}, body as (select id, r, part, line from printed union all select id, 0, 1, line from ruled)
select id, 'Order ' || id || chr(10) || string_agg(line, chr(10) order by r, part) || chr(10) || 'End | of order' || chr(10) as text from body group by id""")
def report_reflowed(spark: SparkSession, d: str) -> DataFrame:
    return markdown_tables.reflowed(_sheets(spark, d), 60)


@query("""select rpad(case when length(p_name) <= 10 then p_name else substr(p_name, 1, 7) || '...' end, 10, ' ') || lpad(printf('%.3f', p_size::double), 14, ' ') || lpad(case when p_size % 5 = 0 then '-' else printf('%.3f', p_partkey::double) end, 14, ' ') as line from part""")
def report_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr("p_name", "p_size", "if(p_size % 5 = 0, null, p_partkey) as k")
    return reports.aligned(rows, "p_name", ["p_size", "k"], 10)


@query("""select p_partkey, p_partkey % 4 = 0 as is_rule, case p_partkey % 4 when 0 then '---;:--:;' when 1 then p_type || ';;' when 2 then p_type || ';' || p_brand || ';' || p_size else 'a;b;c' end as cells from part""")
def report_table_rows(spark: SparkSession, d: str) -> DataFrame:
    line = F.expr("case p_partkey % 4 when 0 then '| --- | :--: |' when 1 then concat('| ', p_type, ' |') when 2 then concat(p_type, '|', p_brand, ' | ', p_size) else '|a|b|c|d|' end")
    rows = table(spark, d, "part").select("p_partkey", line.alias("line"))
    return rows.select("p_partkey", reports.is_table_rule(F.col("line")).alias("is_rule"), F.array_join(reports.table_cells(F.col("line"), 3), ";").alias("cells"))


@query("""select 'user' || c_nationkey as owner, c_custkey as pid, (c_custkey % 100 + 0.5)::double as cpu, 1.5::double as mem, 'python train.py --port ' || c_custkey as command from customer where c_custkey % 3 = 0""")
def report_processes(spark: SparkSession, d: str) -> DataFrame:
    what = F.expr("if(c_custkey % 3 = 0, concat('python train.py --port ', c_custkey), 'bash')")
    line = F.format_string("user%d  %d  %d.5  1.5  100  200 ?  Sl  10:00  0:01 %s", "c_nationkey", "c_custkey", F.col("c_custkey") % 100, what)
    return reports.processes(table(spark, d, "customer").select(line.alias("value")), r"train\.py")


@query("""select p_partkey, case p_partkey % 4 when 0 then true when 1 then false when 2 then false end as flag, case when p_partkey % 2 = 0 then replace(p_brand, '#', '') else '''' || replace(p_brand, '#', '') || ' it''"''"''s' || '''' end as quoted,
  case when p_size = 7 then '7' else p_size || ';7' end as numbers, case when p_size % 10 = 0 then 1.0 else (p_size % 10) / 448.0::double end::double as scale, 'a-b "c" ' || p_size as plain from part""")
def report_settings(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part")
    brand = F.regexp_replace("p_brand", "#", "")
    quoted = reports.shell_quoted(F.when(F.col("p_partkey") % 2 == 0, brand).otherwise(F.concat(brand, F.lit(" it's"))))
    return rows.select(
        "p_partkey", reports.flag(F.expr("array(' True', 'off', '', 'maybe')[p_partkey % 4]")).alias("flag"), quoted.alias("quoted"),
        F.array_join(reports.number_list(F.concat(F.col("p_size"), F.lit(", 7, x,"), F.col("p_size"))).cast("array<string>"), ";").alias("numbers"),
        reports.pack_scale((F.col("p_size") % 10).cast("double")).alias("scale"), reports.plain_text(F.concat(F.lit("a–b “c” é"), "p_size")).alias("plain"),
    )


@query("select 'f' || o_orderkey as path, 2 as line from orders where o_orderkey % 3 = 1 union all select 'f' || o_orderkey, -1 from orders where o_orderkey % 3 = 2")
def report_decorators(spark: SparkSession, d: str) -> DataFrame:
    text = F.expr("array('@a.jit(fast=True)\\ndef f(): pass', 'x = 1\\n@jit\\ndef f(): pass', 'def (')[o_orderkey % 3]")
    files = table(spark, d, "orders").select(F.concat(F.lit("f"), "o_orderkey").alias("path"), text.alias("text"))
    return reports.decorators_without(files, "jit", "fast")


@query("select o_orderstatus as status, 2 * count(*) as n from orders group by 1")
def report_appended(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "appended")
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    for _ in range(2):
        sinks.append_csv(rows, path)
    return spark.read.option("header", True).csv(path).groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query("select o_orderstatus as status, 2 * count(*) as n, 2 * sum(o_orderkey)::bigint as keys from orders group by 1")
def report_appended_json(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "appended-json")
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    for _ in range(2):
        sinks.append_json(rows, path)
    back = spark.read.schema(rows.schema).json(path)
    return back.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("select true as first, false as again, count(*) as n from customer")
def report_written_once(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "once")
    rows = table(spark, d, "customer").select("c_custkey")
    wrote = [sinks.write_once(rows, path) for _ in range(2)]
    return spark.read.parquet(path).agg(F.lit(wrote[0]).alias("first"), F.lit(wrote[1]).alias("again"), F.count("*").alias("n"))


@query("select p_brand as brand, case when p_brand = (select min(p_brand) from part) then count(*) + 1000 else count(*) end as n from part group by 1")
def report_published(spark: SparkSession, d: str) -> DataFrame:
    made, out = scratch_path(spark, "made"), scratch_path(spark, "published")
    counts = table(spark, d, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("n"))
    counts.select("n", "brand").write.partitionBy("brand").parquet(out)
    least = counts.agg(F.min("brand").alias("brand")).join(counts, "brand")
    least.select((F.col("n") + 1000).alias("n"), "brand").write.parquet(made)
    sinks.publish_one(spark.createDataFrame([(made,)], "folder string"), out, "brand", "n long, brand string")
    return spark.read.schema("n long, brand string").parquet(out)


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') as at from orders")
def report_stamps(spark: SparkSession, d: str) -> DataFrame:
    zone = F.to_utc_timestamp(F.col("o_orderdate").cast("timestamp"), "UTC")
    return table(spark, d, "orders").select("o_orderkey", iso_utc(zone).alias("at"))
