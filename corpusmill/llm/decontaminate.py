"""Benchmark decontamination by template windows.

Native operator: DataFrame functions only.

Numbers, names (capitalised words inside a sentence) and units (after a number) become typed placeholders.  Every run of
``WINDOW`` template tokens of a document is hash-joined with those of the benchmark items; of an item with fewer tokens
the whole template is its window.  A window with fewer than ``LITERALS`` literal tokens says nothing as a template: it is matched
by its own values, so a row of numbers, or the item ``42``, is found only where it stands.  Matches are taken by diagonal (document less item position).  A diagonal agrees when
at least half of its slots, as many as they are, have the document value most frequent for their item value, or equal
tokens.  A (document, item) pair is a hit when its agreeing diagonals hold at least ``MIN_PERCENT`` of the item's
distinct windows, or one of them a run of ``RUN`` tokens, however long the item.  ``kind`` is ``verbatim`` (on the
diagonal with most windows all slot values are equal, or there are no slots) or ``reparameterised``.

Defined cases: null texts are empty and never match; an item without tokens never matches, one of a word or two matches
each document that holds it; null ids are kept as ids; each text of an item_id is an item of its own, of which the best is
reported; repeated rows (same doc_id and text) give their hits once; texts of any length are searched whole; empty tables
give an empty result; other columns are ignored by ``hits`` and kept by ``clean``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import small, stored, unused

WINDOW = 8
MIN_PERCENT = 50
RUN = 13
#: Tokens of a window that must be no placeholders for it to be compared as a template; others are compared as they stand.
LITERALS = 3
# Units of measure that can follow a number.
UNITS = (
    "km m cm mm mi mile miles ft feet foot inch inches yard yards kg g mg lb lbs pound pounds ounce ounces ton tons l ml liter liters litre litres "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years dollar dollars euro euros cent cents usd eur "
    "percent degree degrees mph kmh"
)
_NAME, _UNIT = "\x01", "\x02"


def marked(text: Column) -> Column:
    """Lower-case text with a mark before each name and unit, and digits apart from letters."""
    s = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x01\x02]", " ")
    s = F.regexp_replace(s, r"(?<=[\p{Ll},;] )(\p{Lu}\p{Ll}+)", _NAME + "$1")
    s = F.regexp_replace(F.lower(s), r"(?<=\p{N})(?=\p{L})", " ")
    return F.regexp_replace(s, rf"(?<=\p{{N}} )({'|'.join(UNITS.split())})(?![\p{{L}}\p{{N}}])", _UNIT + "$1")


def _tokens(s: Column) -> Column:
    return F.filter(F.split(s, r"[^\p{L}\p{N}\x01\x02]+"), lambda t: t != "")


def template(mark: Column) -> Column:
    """The template tokens of a marked text; position by position those of ``_tokens(mark)``."""
    s = F.regexp_replace(mark, r"(?<=[\x01\x02])[\p{L}\p{N}]+", "")
    return _tokens(F.regexp_replace(s, r"\p{N}+", "0"))


def _within(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value worked out once."""
    return F.transform(F.array(value), use)[0]


def windows(mark: Column, sizes: tuple[int, ...] = (WINDOW,)) -> Column:
    """(pos, window): a hash of each run of template tokens of a marked text, of each of the ``sizes``; with fewer than ``LITERALS``
    that are no placeholders and hold none, of the tokens themselves.  Most texts have no such run and are spared the count."""
    blank = lambda t: F.contains(t, F.lit("0")) | F.startswith(t, F.lit(_NAME)) | F.startswith(t, F.lit(_UNIT))
    code = lambda t, raw: F.struct(F.xxhash64(t).alias("t"), F.xxhash64(raw).alias("raw"), F.when(blank(t), 0).otherwise(1).alias("literal"))
    each = lambda c, n, hashed: F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: F.struct(i.alias("pos"), hashed([c[i + k] for k in range(n)]).alias("window")))

    def told(own: list[Column]) -> Column:
        strong = sum((x["literal"] for x in own[1:]), own[0]["literal"]) >= LITERALS
        return F.when(strong, F.xxhash64(*[x["t"] for x in own])).otherwise(F.xxhash64(*[x["raw"] for x in own]))

    def of(t: Column, codes: Column, blanks: Column, n: int) -> Column:
        few = n - LITERALS  # this many blanks after a blank, within n tokens, leave too little
        weak = F.lit(True) if few < 0 else F.when(F.size(blanks) > few, F.exists(F.sequence(F.lit(few), F.size(blanks) - 1), lambda k: blanks[k] - blanks[k - few] < n)).otherwise(False)
        counted = _within(F.zip_with(t, _tokens(mark), code), lambda c: each(c, n, told))
        return F.when(F.size(t) >= n, F.when(weak, counted).otherwise(each(codes, n, lambda own: F.xxhash64(*own))))

    def cut(t: Column) -> Column:
        blanks, codes = F.array_compact(F.transform(t, lambda x, i: F.when(blank(x), i))), F.transform(t, lambda x: F.xxhash64(x))
        runs = lambda c, z: of(t, c, z, sizes[0]) if len(sizes) == 1 else F.flatten(F.array_compact(F.array(*[of(t, c, z, n) for n in sizes])))
        return _within(codes, lambda c: _within(blanks, lambda z: runs(c, z)))

    return _within(template(mark), cut)


def _long_run(pos: Column) -> Column:
    """Whether sorted window positions hold a run that covers RUN tokens."""
    more = RUN - WINDOW
    return F.when(F.size(pos) > more, F.exists(F.sequence(F.lit(more), F.size(pos) - 1), lambda i: pos[i] - pos[i - more] == more)).otherwise(False)


def _agreeing(slots: Column) -> Column:
    """Of slots (a in the item, b in the document) how many have the most frequent b of their a, or b = a."""
    values = F.array_distinct(F.transform(slots, lambda s: s["a"]))

    def most(a: Column) -> Column:
        own = F.transform(F.filter(slots, lambda s: s["a"] == a), lambda s: s["b"])
        return F.array_max(F.transform(F.array_distinct(own), lambda b: F.size(F.filter(own, lambda x: (x == b) | (x == a)))))

    return F.aggregate(F.transform(values, most), F.lit(0), lambda n, m: n + m)


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, n_windows, item_windows, n_slots, kind of every hit."""
    # An item's first word is a name where the item stands inside a sentence, so each such item has a second reading.
    readings = lambda m: F.when(F.col("text").rlike(r"^\p{Lu}\p{Ll}"), F.array(m, F.concat(F.lit(_NAME), m))).otherwise(F.array(m))
    item = benchmark.select("item_id", F.explode(readings(marked(F.col("text")))).alias("mark")).distinct().withColumn("item_key", F.xxhash64("mark"))
    item = item.withColumn("tokens", template(F.col("mark"))).filter(F.size("tokens") > 0)
    short = sorted(r[0] for r in item.select(F.size("tokens")).filter(F.size("tokens") < WINDOW).distinct().collect())
    own = F.coalesce(windows(F.col("mark")), *[F.when(F.size("tokens") == n, windows(F.col("mark"), (n,))) for n in short])
    item = stored(item.withColumn("own", F.transform(own, lambda w: w["window"])).drop("tokens"), "decontaminate-items")
    item_windows = item.select(
        "item_id", "item_key", F.size(F.array_distinct("own")).alias("item_windows"), F.posexplode("own").alias("item_pos", "item_window")
    )
    doc_rows = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.explode(windows(marked(F.col("text")), (WINDOW, *short))).alias("w")
    ).select("doc_id", "text_hash", F.col("w.pos").alias("doc_pos"), F.col("w.window").alias("window"))
    # One row per document, item and diagonal, so a document repeated a million times stays a million small groups.
    item_windows = stored(item_windows, "decontaminate-windows")
    seen = doc_rows.join(small(item_windows), F.col("window") == F.col("item_window"))
    pair = ["doc_id", "text_hash", "item_id"]
    whole = [*pair, "item_key", "item_windows"]
    n_windows = F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n_windows")
    enough = (100 * F.col("n_windows") >= MIN_PERCENT * F.col("item_windows")) | F.col("long")
    lines = (
        seen.groupBy(*whole, (F.col("doc_pos") - F.col("item_pos")).alias("shift"))
        .agg(F.collect_set("item_window").alias("found"), F.sort_array(F.collect_set("item_pos")).alias("pos"))
        .groupBy(*whole)
        .agg(n_windows, F.max(_long_run(F.col("pos"))).alias("long"), F.collect_list(F.struct("shift", "pos")).alias("lines"))
        .filter(enough)
    )
    lines = stored(lines.select(*whole, "lines"), "decontaminate-lines")
    # Slots along every diagonal, for the documents with hits only.
    near = stored(lines.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("t")).distinct(), "decontaminate-near")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(
        small(near), F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("t")), "left_semi"
    )
    texts = texts.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("t"), _tokens(marked(F.col("text"))).alias("doc_tokens")).distinct()
    both = lines.join(texts, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("t")))
    raw = item.select(F.col("item_id").alias("j"), F.col("item_key").alias("k"), _tokens(F.col("mark")).alias("item_tokens"), "own")
    both = both.join(small(stored(raw, "decontaminate-raw")), F.col("item_id").eqNullSafe(F.col("j")) & (F.col("item_key") == F.col("k")))
    aligned = F.expr(
        f"""transform(lines, d -> struct(d.shift as shift, d.pos as pos, transform(d.pos, p -> own[p]) as found,
            transform(array_distinct(flatten(transform(d.pos, p -> sequence(p, p + least({WINDOW}, size(item_tokens)) - 1)))),
                p -> struct(item_tokens[p] as a, doc_tokens[p + d.shift] as b)) as slots))"""
    )
    each = both.select(*whole, F.explode(aligned).alias("d")).select(*whole, "d.*")
    each = each.withColumn("slots", F.filter("slots", lambda s: s["a"].rlike(r"^[\x01\x02\p{N}]")))
    equal = F.forall("slots", lambda s: s["a"] == s["b"])
    rank = F.struct(F.size("pos").alias("n"), equal.alias("equal"), (-F.col("shift")).alias("back"), F.size(F.array_distinct("slots")).alias("n_slots"))
    return (
        each.filter(2 * _agreeing(F.col("slots")) >= F.size("slots"))
        .groupBy(*whole).agg(n_windows, F.max(_long_run(F.col("pos"))).alias("long"), F.max(rank).alias("best"))
        .filter(enough)
        .select(*pair, "n_windows", "item_windows", "best.n_slots", F.when(F.col("best.equal"), "verbatim").otherwise("reparameterised").alias("kind"))
        # An item_id that stands for several texts reports its best.
        .groupBy(*pair).agg(F.max_by(F.struct("n_windows", "item_windows", "n_slots", "kind"), F.struct("n_windows", "kind")).alias("m"))
        .select(*pair, "m.*")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit."""
    i, t = unused(docs, "i"), unused(docs, "t")
    found = stored(hits(docs, benchmark).select(F.col("doc_id").alias(i), F.col("text_hash").alias(t)).distinct(), "decontaminate-hits")
    return docs.join(small(found), F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(t)), "left_anti")
