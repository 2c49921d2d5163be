"""Reports and small text tables: aligned lines, markdown tables, process lists, settings and source checks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.scalars import short

# Texts that mean yes and no, and typographic characters with their plain forms.
YES, NO = ("1", "true", "yes", "on"), ("0", "false", "no", "off", "")
TYPOGRAPHIC, PLAIN = "–—‘’“” ", "--''\"\" "
PROCESS = r"^(\S+)\s+(\d+)\s+([\d.]+)\s+([\d.]+)\s+\S+\s+\S+\s+\S+\s+\S+\s+\S+\s+(\S+)\s+(.*)$"
FP8_MAX = 448.0


def aligned(rows: DataFrame, name: str, figures: list[str], width: int = 40) -> DataFrame:
    """line: the name cut and padded to ``width``, then each figure with three decimals, right-aligned; a dash for null."""
    cells = [F.lpad(F.coalesce(F.format_string("%.3f", F.col(f).cast("double")), F.lit("-")), 14, " ") for f in figures]
    cells = [F.when(F.col(f).isNull(), F.lpad(F.lit("-"), 14, " ")).otherwise(c) for f, c in zip(figures, cells, strict=True)]
    return rows.select(F.concat(F.rpad(short(F.col(name), width), width, " "), *cells).alias("line"))


def is_table_rule(line: Column) -> Column:
    """Whether a line is the rule below a markdown table's head."""
    return F.trim(line).rlike(r"^\|?\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|?$") & F.contains(line, F.lit("|"))


def table_cells(line: Column, width: int) -> Column:
    """The cells of a markdown row, trimmed, padded with empty ones or cut to ``width``."""
    inner = F.regexp_replace(F.trim(line), r"^\||\|$", "")
    cells = F.transform(F.split(inner, r"\|"), lambda c: F.trim(c))
    return F.slice(F.concat(cells, F.array_repeat(F.lit(""), width)), 1, width)


def plain_text(text: Column) -> Column:
    """Typographic dashes, quotes and blanks by plain ones; other characters beyond ASCII go."""
    return F.regexp_replace(F.translate(text, TYPOGRAPHIC, PLAIN), r"[^\x00-\x7F]", "")


def processes(lines: DataFrame, pattern: str) -> DataFrame:
    """owner, pid, cpu, mem, command of the lines of a process list whose command matches."""
    group = lambda i: F.regexp_extract("value", PROCESS, i)
    rows = lines.filter(F.col("value").rlike(PROCESS)).select(
        group(1).alias("owner"), group(2).try_cast("long").alias("pid"), group(3).try_cast("double").alias("cpu"), group(4).try_cast("double").alias("mem"), group(6).alias("command")
    )
    return rows.filter(F.col("command").rlike(pattern))


def flag(text: Column) -> Column:
    """A setting as boolean; null for any other text."""
    low = F.lower(F.trim(text))
    return F.when(low.isin(*YES), True).when(low.isin(*NO), False)


def number_list(text: Column) -> Column:
    """The numbers of a comma list, each once, in order of first place; other parts are dropped."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p).try_cast("int"))
    return F.array_distinct(F.array_compact(parts))


def shell_quoted(text: Column) -> Column:
    """The text as one shell word."""
    quoted = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("'\"'\"'")), F.lit("'"))
    return F.when(text.rlike(r"^[A-Za-z0-9_@%+=:,./-]+$"), text).otherwise(quoted)


def pack_scale(absmax: Column) -> Column:
    """The scale that maps the greatest magnitude to the greatest 8-bit float; 1 where it is 0."""
    return F.when(absmax == 0, 1.0).otherwise(absmax / FP8_MAX)


def _calls_without(name: str, keyword: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ast

        def found(path: str, text: str | None) -> list[tuple]:
            try:
                tree = ast.parse(text or "")
            except SyntaxError:
                return [(path, -1)]
            out = []
            for node in ast.walk(tree):
                for mark in getattr(node, "decorator_list", ()):
                    call = mark if isinstance(mark, ast.Call) else ast.Call(mark, [], [])
                    own = call.func.attr if isinstance(call.func, ast.Attribute) else getattr(call.func, "id", "")
                    if own == name and keyword not in [k.arg for k in call.keywords]:
                        out.append((path, mark.lineno))
            return out

        for frame in batches:
            rows = [r for path, text in zip(frame["path"], frame["text"], strict=True) for r in found(path, text)]
            yield pd.DataFrame(rows, columns=["path", "line"])

    return run


def decorators_without(files: DataFrame, name: str, keyword: str) -> DataFrame:
    """path, line of every decorator ``name`` that does not set ``keyword``, in files (path, text) of Python source; line -1 for
    text that is no Python.  It needs Python's own parser, hence no built-in functions."""
    return files.select("path", "text").mapInPandas(_calls_without(name, keyword), "path string, line int")
