"""Array functions of token sequences and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Table sizes of the hashed n-gram tables, and the layer symbols' counterparts.
TABLE_PRIMES = (499801, 499819, 499853, 499879, 499883, 499897, 499903, 499927, 499943, 499957, 499969, 499973, 499979, 500009, 500029, 500041)
NEM_TO_MEGATRON = {"A": "*", "M": "M", "D": "G", "E": "E"}


def table_sizes(count: int, target: int) -> list[int]:
    """``count`` table sizes: the fixed primes within half of the target if there are enough, else target, target + 1, ..."""
    near = [p for p in TABLE_PRIMES if 2 * abs(p - target) < target]
    return near[:count] if len(near) >= count else list(range(target, target + count))


def multiplier(table: int, place: int) -> int:
    """An odd multiplier below 2**31 for a place of a table's n-gram (constants of this library)."""
    return (table * 1_000_003 + place * 7_919_317 + 12_345_677) % (1 << 31) | 1


def bias(table: int) -> int:
    return (table * 2_654_435 + 987_654_321) % (1 << 31)


def ngram_ids(tokens: Column, orders: list[int], heads: int, target: int) -> list[Column]:
    """One array per table: for each position the row of its n-gram in the joined tables; before the text stand zeros.

    A table's hash is the exclusive or of multiplier * token over the n-gram's places and a bias, modulo the table's size.
    """
    sizes = table_sizes(len(orders) * heads, target)
    return [_table_ids(tokens, table, orders[table // heads], size, sum(sizes[:table])) for table, size in enumerate(sizes)]


def _table_ids(tokens: Column, table: int, order: int, size: int, offset: int) -> Column:
    value = F.transform(tokens, lambda t: (t * multiplier(table, 0)).bitwiseXOR(F.lit(bias(table))))
    for back in range(1, order):
        before = F.slice(F.concat(F.array_repeat(F.lit(0).cast("long"), back), tokens), F.lit(1), F.size(tokens))
        value = F.zip_with(value, before, lambda v, b: v.bitwiseXOR(b * multiplier(table, back)))  # noqa: B023
    return F.transform(value, lambda v: v % size + offset)


def ahead(tokens: Column, depth: int, fill: int) -> Column:
    """At each place the token ``depth`` places on, ``fill`` beyond the end."""
    rest = F.slice(tokens, F.lit(depth + 1), F.greatest(F.size(tokens) - depth, F.lit(0)))
    return F.concat(rest, F.array_repeat(F.lit(fill).cast("long"), F.least(F.size(tokens), F.lit(depth))))


# The side channels of a token batch, those that make its core, and the names of the embedding's components.
SIDE_CHANNELS = ("structure_ids", "dep_levels", "ast_depth_ids", "sibling_index_ids", "node_type_ids")
COMPONENTS = ("structure", "dep_level", "ast_depth", "sibling_index", "ast_node_type")
CORE_COMPONENTS = ("structure", "dep_level")


def parsed_components(spec: str) -> tuple[str, ...]:
    """``all``, ``core`` or a comma list of component names, in the components' own order; ValueError for an unknown one."""
    if spec in ("all", "core"):
        return COMPONENTS if spec == "all" else CORE_COMPONENTS
    wanted = {part.strip() for part in spec.split(",")} - {""}
    if unknown := wanted.difference(COMPONENTS):
        raise ValueError(f"no such components: {', '.join(sorted(unknown))}")
    return tuple(c for c in COMPONENTS if c in wanted)


def component_ids(components: dict[str, tuple[Column | None, int]]) -> dict[str, Column]:
    """Per component an array of rows in the joined tables: ids clamped to the component's size; a missing component (None, or a
    null array) has no ids, and counts with weight 0 in ``component_sum``."""
    out, offset = {}, 0
    for name, (ids, size) in components.items():
        out[name] = F.lit(None).cast("array<long>") if ids is None else _clamped(ids, size, offset)
        offset += size
    return out


def component_sum(vectors: list[Column], present: list[Column]) -> Column:
    """Sum of the components' vectors, each weighted by one over the number of components, and by 0 where it is not present."""
    scale = 1.0 / max(len(vectors), 1)
    weighted = [F.transform(v, lambda x: x * F.when(p, scale).otherwise(0.0)) for v, p in zip(vectors, present, strict=True)]  # noqa: B023
    return scaled_sum(weighted, 1.0)


def _clamped(ids: Column, size: int, offset: int) -> Column:
    return F.transform(ids, lambda v: F.greatest(F.lit(0), F.least(v, F.lit(size - 1))) + offset)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def scaled_sum(vectors: list[Column], scale: float) -> Column:
    """Elementwise sum of vectors times a scale."""
    out = F.transform(vectors[0], lambda v: v * scale)
    for x in vectors[1:]:
        out = F.zip_with(out, x, lambda a, b: a + b * scale)
    return out


def rms_normed(x: Column, weight: float = 1.0, bias_: float = 0.0, eps: float = 1e-5) -> Column:
    mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")) / F.size(x)
    return F.transform(x, lambda v: v.cast("double") / F.sqrt(mean + eps) * weight + bias_)


def rotated(x: Column, angle: Column) -> Column:
    """Neighbouring pairs of x turned by the angle times their number from 1."""
    cos, sin = (lambda k: F.cos(angle * (k + 1))), (lambda k: F.sin(angle * (k + 1)))

    def turn(v: Column, i: Column) -> Column:
        k = F.floor(i / 2)
        other = F.get(x, F.when(i % 2 == 0, i + 1).otherwise(i - 1)).cast("double")
        return F.when(i % 2 == 0, v * cos(k) - other * sin(k)).otherwise(other * sin(k) + v * cos(k))

    return F.transform(x, turn)


def l2_norm(x: Column) -> Column:
    return F.sqrt(dot(x, x))


def modulated_decay(x: Column, a_log: Column, scale: Column, bias_: Column, ceiling: float = -0.01) -> Column:
    """-exp(a_log) - softplus(scale * |x| + bias), at most ``ceiling``: the decay rate modulated by the vector's length."""
    return F.least(-F.exp(a_log) - softplus(scale * l2_norm(x) + bias_), F.lit(ceiling))


def outer(a: Column, b: Column) -> Column:
    """All products of an element of a with one of b, as rows."""
    return F.transform(a, lambda x: F.transform(b, lambda y: x.cast("double") * y.cast("double")))


def head_scores(heads: Column, key: Column, weights: Column, relu: bool = True) -> Column:
    """Sum over the heads of weight * dot(head, key), negative dots taken as 0 if ``relu``."""
    dots = F.transform(heads, lambda h: dot(h, key))
    kept = F.transform(dots, lambda v: F.greatest(v, F.lit(0.0))) if relu else dots
    return dot(kept, weights)


def softplus(x: Column) -> Column:
    return F.when(x > 20, x).otherwise(F.log1p(F.exp(x)))


def decay(x: Column, a_log: Column, dt_bias: Column) -> Column:
    """exp(-exp(a_log) * softplus(x + dt_bias))."""
    return F.exp(-F.exp(a_log) * softplus(x + dt_bias))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def repeated_heads(x: Column, times: int) -> Column:
    return F.flatten(F.transform(x, lambda v: F.array_repeat(v, times)))


def quantised(x: Column, absmax: Column) -> Column:
    """Signed 8-bit value of x: nearest, halves away from zero, within 127; 0 where absmax is 0."""
    return F.when(absmax == 0, 0).otherwise(F.greatest(F.lit(-127), F.least(F.lit(127), F.round(x * 127 / F.nullif(absmax, F.lit(0.0)))))).cast("int")


def dequantised(q: Column, absmax: Column) -> Column:
    return q * absmax / 127


def e4m3(byte: Column) -> Column:
    """Value of an 8-bit float of 4 exponent and 3 fraction bits (no infinity; 127 and 255 are no number)."""
    sign, exponent, fraction = F.when(byte >= 128, -1.0).otherwise(1.0), F.shiftright(byte, 3).bitwiseAND(F.lit(15)), byte.bitwiseAND(F.lit(7))
    value = F.when(exponent == 0, fraction / 8 * F.pow(F.lit(2.0), F.lit(-6))).otherwise((1 + fraction / 8) * F.pow(F.lit(2.0), exponent - 7))
    return F.when((exponent == 15) & (fraction == 7), float("nan")).otherwise(sign * value)


#: Greatest 8-bit float of this kind.
E4M3_MAX = 448.0


def e4m3_rounded(x: Column) -> Column:
    """The nearest value that an 8-bit float holds, halves to even, beyond the greatest the greatest."""
    exponent = F.greatest(F.floor(F.log2(F.nullif(F.abs(x), F.lit(0.0)))), F.lit(-6))
    step = F.pow(F.lit(2.0), exponent - 3)
    near = F.rint(x / step) * step
    return F.coalesce(F.when(F.abs(near) > E4M3_MAX, F.signum(x) * E4M3_MAX).otherwise(near), F.lit(0.0))


def e4m3_packed(x: Column, clamp: bool = False) -> tuple[Column, Column]:
    """(values as 8-bit floats hold them, scale): the array over the scale that maps its greatest magnitude to the greatest
    float, 1 where all are 0; ``clamp`` first cuts what lies beyond the greatest float."""
    cut = F.transform(x, lambda v: F.greatest(F.lit(-E4M3_MAX), F.least(F.lit(E4M3_MAX), v))) if clamp else x
    absmax = F.array_max(F.transform(cut, lambda v: F.abs(v)))
    scale = F.when(absmax > 0, absmax / E4M3_MAX).otherwise(1.0)
    return F.transform(cut, lambda v: e4m3_rounded(v / scale)), scale


def is_edge_layer(index: Column, layers_: int, first: int, last: int) -> Column:
    """Whether a layer is one of the first or of the last ones."""
    return (index < first) | (index >= layers_ - last)


def scaled_e4m3(byte: Column, exponent: Column) -> Column:
    """The value times 2 ** (exponent - 127); an exponent byte of 0 gives 0."""
    return F.when(exponent == 0, 0.0).otherwise(e4m3(byte) * F.pow(F.lit(2.0), exponent - 127))


def layers(pattern: Column, depth: int) -> Column:
    """The pattern's symbols for ``depth`` layers: repeated, or, with pipes, the joined segments (null if their length differs)."""
    upper = F.upper(pattern)
    flat = F.replace(upper, F.lit("|"), F.lit(""))
    tiled = F.transform(F.sequence(F.lit(0), F.lit(depth - 1)), lambda i: F.substr(upper, i % F.length(upper) + 1, F.lit(1)))
    return F.when(~F.contains(upper, F.lit("|")), tiled).when(F.length(flat) == depth, F.split(flat, ""))


def mapped_layers(symbols: Column, mtp: int = 0) -> Column:
    """Symbols as a layer string; those without a rule stay.  Each extra prediction depth adds /*-."""
    out = F.array_join(F.transform(symbols, lambda s: F.coalesce(_rule(s), s)), "")
    return F.concat(out, F.lit("/*-" * mtp))


def _rule(s: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in NEM_TO_MEGATRON.items():
        out = F.when(s == k, v).otherwise(out)
    return out


def lite_layers(symbols: Column) -> Column:
    """The smaller mapping: attention *, M and R as M, D and G as G."""
    return F.array_join(F.transform(symbols, lambda s: F.when(s == "A", "*").when(s.isin("M", "R"), "M").when(s.isin("D", "G"), "G").otherwise(s)), "")


def places_of(symbols: Column, wanted: tuple[str, ...]) -> Column:
    """Numbers from 1 of the layers with one of the symbols."""
    numbered = F.transform(symbols, lambda s, i: F.when(s.isin(*wanted), i + 1))
    return F.array_compact(numbered)


def piped(layer_string: Column, chunks: int) -> Column:
    """The string cut into equal chunks joined by pipes; null if they cannot be equal."""
    each = F.floor(F.length(layer_string) / chunks).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.lit(chunks - 1)), lambda i: F.substr(layer_string, i * each + 1, each))
    return F.when(F.length(layer_string) % chunks == 0, F.array_join(parts, "|"))
