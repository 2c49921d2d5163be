"""Markdown tables in texts, set anew within a row width: found, cut to cells, measured, given widths and wrapped.

A table is a head line and a rule below it, then the row lines that follow without a break.  A row line begins and ends with a
bar; a rule needs three dashes a column, two columns at least, and outer bars only if it likes.  A text is one row as given: its
lines, and the cells of each of its tables, are arrays in its own row, so nothing is shuffled but the pieces of a text that is put together.

Defined cases: null texts have no lines and stay null; a table without body rows has one empty row; rows are filled with empty cells or cut to the
head's columns; a repeated head name counts two characters more and its number (it is kept apart by a mark of no width); an empty
head name is one blank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Glyphs and their plain forms, the rule's pattern, the pattern of a reference number whose sign is doubled, and the
# length of a word in a body cell above which it may be broken.
PLAIN = {
    "✓": "v", "✔": "v", "✗": "x", "✘": "x", "→": "->", "←": "<-", "↑": "^", "↓": "v", "⇒": "=>", "⇐": "<=", "—": "--", "–": "-", "−": "-",
    "•": "*", "·": ".", "…": "...", "“": '"', "”": '"', "‘": "'", "’": "'", "«": '"', "»": '"', "×": "x", "÷": "/", "≈": "~=", "≠": "!=",
    "≤": "<=", "≥": ">=", "±": "+/-", "©": "(c)", "®": "(R)", "™": "(TM)", "\u00a0": " ", "\u200b": "",
}
RULE = r"^\s*\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?\s*$"
NUMBER_SIGN = r"(?<!#)#(\d{3,})"
LONG_WORD = 16
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
#: Keeps apart the names of columns that are called the same.
MARK = "\u200b"


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_row(line: Column) -> Column:
    return _stripped(line).rlike(r"^\|.*\|$")


def is_rule(line: Column) -> Column:
    return line.rlike(RULE)


def folded(text: Column) -> Column:
    """Glyphs by plain characters, and the sign of numbers of three digits or more doubled."""
    single = {k: v for k, v in PLAIN.items() if len(v) == 1}
    text = F.translate(text, "".join(single), "".join(single.values()))
    for glyph, plain in PLAIN.items():
        if glyph not in single:
            text = F.replace(text, F.lit(glyph), F.lit(plain))
    return F.regexp_replace(text, NUMBER_SIGN, "##$1")


def cells(line: Column) -> Column:
    """The folded cells of a row line."""
    inner = F.regexp_replace(_stripped(line), r"^\||\|$", "")
    plain = lambda c: F.when(c.rlike(r"[^\x00-\x7f]|#[0-9]{3}"), folded(c)).otherwise(c)
    return F.transform(F.transform(F.split(inner, r"\|", -1), _stripped), plain)


def longest_word(text: Column) -> Column:
    return F.array_max(F.transform(F.split(text, " ", -1), lambda w: F.length(w)))


def broken(text: Column, width: Column) -> Column:
    """The text with a blank after every ``width`` characters of a longer word."""
    return F.regexp_replace(text, F.concat(F.lit("([^ ]{"), width.cast("string"), F.lit("})(?=[^ ])")), F.lit("$1 "))


def pieces(texts: DataFrame) -> DataFrame:
    """id, at (the place of its first line, from 0), is_table, lines of each table of ``texts`` (id, text) and of each run of other lines;
    ``lines`` is null for a null text.  Other columns stay.

    Each line is a letter by what it can be: both row and rule, row, rule, other.  Tables are found from the first line on.
    """
    whole = F.regexp_replace("text", f"(?:{LINE_END})\\z", "")
    rows = texts.withColumn("_lines", F.split(whole, LINE_END, -1))
    kind = lambda x: F.when(is_row(x), F.when(is_rule(x), "h").otherwise("r")).otherwise(F.when(is_rule(x), "u").otherwise("x"))
    marked = F.regexp_replace(F.array_join(F.transform("_lines", kind), ""), "([hr][hu][hr]*)", "<$1>")
    rows = rows.withColumn("_sizes", F.transform(F.split(marked, "[<>]", -1), lambda s: F.length(s)))
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<at:int,size:int>>").alias("all"))
    step = lambda s, n: F.struct((s["end"] + n).alias("end"), F.concat(s["all"], F.array(F.struct(s["end"].alias("at"), n.alias("size")))).alias("all"))
    each = rows.select("*", F.posexplode_outer(F.aggregate("_sizes", start, step, lambda s: s["all"])).alias("_n", "_p")).filter("_p is null or _p.size > 0")
    own = F.slice("_lines", F.col("_p.at") + 1, F.col("_p.size"))
    return each.select(*texts.columns, F.col("_p.at").alias("at"), (F.col("_n") % 2 == 1).alias("is_table"), own.alias("lines")).drop("text")


def table_cells(tables: DataFrame) -> DataFrame:
    """``tables`` (lines) with ``cells``: those of the head line and of the row lines, filled or cut to the head's columns."""
    own = tables.withColumn("_own", F.transform(F.filter("lines", lambda x, i: i != 1), cells))
    n = F.size(F.col("_own")[0])
    return own.withColumn("cells", F.transform("_own", lambda c: F.slice(F.concat(c, F.array_repeat(F.lit(""), n)), 1, n))).drop("_own", "lines")


def column_widths(tables: DataFrame) -> DataFrame:
    """``tables`` with naturals, mins: for each column of ``table_cells`` the greatest cell, and the least width: the longest word of
    the head, and of the body up to LONG_WORD."""
    head = F.col("cells")[0]

    def named(cell: Column, i: Column) -> Column:
        # How often the name stands in the head before: each repetition is told apart by a mark and its number.
        earlier = F.size(F.filter(F.slice(head, 1, i), lambda c: c == cell))
        name = F.when(cell == "", " ").otherwise(cell)
        return F.when(earlier > 0, F.concat(name, F.lit(MARK), earlier.cast("string"))).otherwise(name)

    rows = tables.withColumns({"_names": F.transform(head, named), "_body": F.slice("cells", 2, F.size("cells"))})
    most = lambda i, what: F.coalesce(F.array_max(F.transform("_body", lambda r: what(F.get(r, i)))), F.lit(0))
    natural = F.transform("_names", lambda c, i: F.greatest(F.lit(1), F.length(c), most(i, F.length)))
    least = F.transform("_names", lambda c, i: F.greatest(F.lit(1), longest_word(c), F.least(F.lit(LONG_WORD), most(i, longest_word))))
    return rows.withColumns({"naturals": natural, "mins": least}).drop("_names", "_body")


def _units(n: Column, key) -> Column:
    """All units of ``key(i)`` (an array of structs for column i, from 0), sorted."""
    return F.array_sort(F.flatten(F.transform(F.sequence(F.lit(0), n - 1), key)))


def _steps(count: Column, make) -> Column:
    return F.transform(F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")), make)


def allotted(widths: DataFrame, max_row: int, max_col: int | None = None) -> DataFrame:
    """``widths`` (naturals, mins) with ``widths``: the columns' shares of a row of ``max_row`` characters, borders and a blank on both sides of a cell
    taken off, in proportion to the natural widths, within the least width and ``max_col``.

    Characters beyond the row are taken one by one from the column with the most above its least width, the first of equals;
    those to spare go to the widest column below its natural width, then to the widest below its limit.  All single characters that
    could be taken or given are listed in that order, at most a row for each column, and as many of the first as needed count.
    """
    n = F.size("naturals")
    at = lambda name, i: F.get(F.col(name), i)
    budget = F.greatest(n, F.lit(max_row) - (3 * n + 1))
    rows = widths.withColumns({"budget": budget, "total": F.aggregate("naturals", F.lit(0), lambda a, x: a + x)})
    limit = lambda i: F.col("budget") if max_col is None else F.greatest(at("mins", i), F.lit(max_col))
    share = lambda i: F.bround(F.col("budget") * at("naturals", i) / F.col("total")).cast("int")
    first = lambda i: F.greatest(at("mins", i), F.least(limit(i), share(i)))
    rows = rows.withColumn("first", F.transform(F.sequence(F.lit(0), n - 1), first))
    over = (F.aggregate("first", F.lit(0), lambda a, x: a + x) - F.col("budget")).alias("over")
    rows = rows.withColumn("over", over)
    takes = _units(n, lambda i: _steps(at("first", i) - at("mins", i), lambda s: F.struct((-s).alias("first"), i.alias("i"))))
    to_natural = lambda i: F.greatest(F.lit(0), at("naturals", i) - at("first", i))
    to_limit = lambda i: F.greatest(F.lit(0), limit(i) - F.greatest(at("first", i), at("naturals", i)))
    gives = _units(n, lambda i: F.concat(
        _steps(F.least(to_natural(i), F.col("budget")), lambda s: F.struct(F.lit(0).alias("phase"), (-at("naturals", i)).alias("size"), i.alias("i"))), _steps(to_limit(i), lambda s: F.struct(F.lit(1).alias("phase"), (-at("naturals", i)).alias("size"), i.alias("i")))
    ))
    none = F.array().cast("array<int>")
    taken = F.when(F.col("over") > 0, F.transform(F.slice(takes, 1, F.greatest(F.col("over"), F.lit(0))), lambda u: u["i"])).otherwise(none)
    given = F.when(F.col("over") < 0, F.transform(F.slice(gives, 1, F.greatest(-F.col("over"), F.lit(0))), lambda u: u["i"])).otherwise(none)
    rows = rows.withColumns({"taken": taken, "given": given})
    count = lambda name, i: F.size(F.filter(F.col(name), lambda k: k == i))
    changed = F.transform(F.col("first"), lambda w, i: w - count("taken", i) + count("given", i))
    rows = rows.withColumn("widths", F.when(F.size("taken") + F.size("given") > 0, changed).otherwise(F.col("first")))
    return rows.drop("budget", "total", "first", "over", "taken", "given")


def wrapped(text: Column, width: Column) -> Column:
    """The lines of a cell: words filled in up to ``width``, longer ones broken; no line for an empty cell."""
    one = F.trim(F.regexp_replace(text, " +", " "))
    even = F.trim(F.regexp_replace(broken(text, width), " +", " "))
    many = F.regexp_extract_all(even, F.concat(F.lit("(.{1,"), width.cast("string"), F.lit("})(?: |$)")), F.lit(1))
    return F.when(F.length(text) > width, many).when(one == "", F.array().cast("array<string>")).otherwise(F.array(one))


def set_tables(tables: DataFrame) -> DataFrame:
    """``tables`` (cells, widths) with ``piece``: the table set in its widths, with a blank on both sides of a cell; a row takes as many
    lines as its longest cell, a table without a body has one empty row."""
    wide = lambda i: F.get("widths", i)
    rows = tables.withColumn("_parts", F.transform("cells", lambda r: F.transform(r, lambda c, i: wrapped(c, wide(i)))))
    bars = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    def line(row: Column, part: Column) -> Column:
        return bars(F.transform(row, lambda p, i: F.rpad(F.coalesce(F.get(p, part), F.lit("")), wide(i), F.lit(" "))))

    def printed(row: Column) -> Column:
        height = F.greatest(F.lit(1), F.array_max(F.transform(row, lambda p: F.size(p))))
        return F.array_join(F.transform(F.sequence(F.lit(0), height - 1), lambda part: line(row, part)), "\n")

    rows = rows.withColumn("_set", F.transform("_parts", printed))
    rule = F.concat(F.lit("|"), F.array_join(F.transform("widths", lambda w: F.repeat(F.lit("-"), w + 2)), "|"), F.lit("|"))
    empty = bars(F.transform("widths", lambda w: F.repeat(F.lit(" "), w)))
    body = F.when(F.size("_set") > 1, F.slice("_set", 2, F.size("_set"))).otherwise(F.array(empty))
    return rows.withColumn("piece", F.array_join(F.concat(F.array(F.col("_set")[0], rule), body), "\n")).drop("_parts", "_set")


def tables(texts: DataFrame) -> DataFrame:
    """id, head (the place of the head line), cells of each table of ``texts``."""
    return table_cells(pieces(texts).filter("is_table")).withColumnRenamed("at", "head").drop("is_table")


def reflowed(texts: DataFrame, max_row: int = 80, max_col: int | None = None) -> DataFrame:
    """id, text of ``texts`` (id, text; ids are unique), their tables set anew; other lines stay.  A null text stays null, an end of
    line at the end stays as one newline."""
    end = F.when(F.col("text").endswith("\n"), "\n").otherwise("")
    # Lines outside of tables go the same way as a table without columns would, so that texts are read once.
    every = pieces(texts.select("id", "text", end.alias("_end")))
    plain = F.when(~F.col("is_table"), F.array_join("lines", "\n"))
    every = every.select("id", "_end", "at", plain.alias("_plain"), F.when(F.col("is_table"), F.col("lines")).alias("lines"))
    done = set_tables(allotted(column_widths(table_cells(every)), max_row, max_col))
    joined = done.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("_plain", "piece").alias("piece")))).alias("l"), F.max("_end").alias("_end"))
    text = F.concat(F.array_join("l.piece", "\n"), "_end")
    return joined.select("id", F.when(F.col("l")[0]["at"].isNotNull(), text).alias("text"))
