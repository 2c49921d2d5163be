"""Scalar functions of run logs and profiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number format of the logs, and byte units.
NUMBER = r"[-+]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][-+]?\d+)?"
GIB, MIB, DECIMAL_MB = 1 << 30, 1 << 20, 1_000_000


def extract(value: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null where there is none."""
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


def number(text: Column) -> Column:
    """A double, thousands commas allowed; null where it is none."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("double")


def whole(text: Column) -> Column:
    """A long, thousands commas allowed; null where it is none."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("long")


def percent(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), "%+$", "").try_cast("double")


def to_ms(value: Column, unit: Column) -> Column:
    """A duration in ms; ns, us and s are converted, any other unit counts as ms."""
    return F.when(unit == "ns", value / 1e6).when(unit == "us", value / 1000.0).when(unit == "s", value * 1000.0).otherwise(value)


def duration_ms(text: Column) -> Column:
    """ms of a text such as 12.5us; null for any other form."""
    pattern = rf"^({NUMBER})\s*(ns|us|ms|s)$"
    value = extract(F.trim(text), pattern).try_cast("double")
    return F.when(value.isNotNull(), to_ms(value, extract(F.trim(text), pattern, 2)))


def gib_to_bytes(gib: Column) -> Column:
    return F.bround(gib * GIB).cast("long")


def finite(value: Column, digits: int) -> Column:
    """Rounded half-even; null unless finite."""
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(~F.isnan(value) & ~infinite, F.bround(value, digits))


def delta(new: Column, base: Column) -> Column:
    return F.bround(new - base, 6)


def delta_percent(new: Column, base: Column) -> Column:
    """Change in percent of the base; null where the base is 0."""
    return F.bround(F.try_divide(new - base, base) * 100, 3)


def readable_bytes(n: Column) -> Column:
    """TB or GB from a tenth on, else MB; a dash for null."""
    tera, giga, mega = n / 1e12, n / 1e9, n / 1e6
    text = F.when(tera >= 0.1, F.format_string("%.3f TB", tera)).when(giga >= 0.1, F.format_string("%.3f GB", giga))
    return F.coalesce(F.when(n.isNotNull(), text.otherwise(F.format_string("%.3f MB", mega))), F.lit("-"))


def short(text: Column, width: int = 88) -> Column:
    return F.when(F.length(text) <= width, text).otherwise(F.concat(F.substring(text, 1, width - 3), F.lit("...")))


def label_path(text: Column) -> Column:
    """struct(label, path) of LABEL=PATH; null if a part is missing."""
    parts = F.split(text, "=", 2)
    label, path = F.trim(parts[0]), F.trim(F.get(parts, F.lit(1)))
    return F.when((F.length(label) > 0) & (F.length(path) > 0), F.struct(label.alias("label"), path.alias("path")))


def is_setting(key: Column) -> Column:
    """Whether a form's key names a setting: keys with a leading underscore do not."""
    return ~key.startswith("_")


def readable_share(share: Column) -> Column:
    """A share in percent with one decimal; a dash for null and 0."""
    return F.when(F.coalesce(share, F.lit(0.0)) != 0, F.concat(F.format_string("%.1f", share * 100), F.lit("%"))).otherwise("-")


def iso_utc(at: Column | None = None) -> Column:
    """A time (now if none) as ISO text in UTC."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp() if at is None else at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def typed(text: Column) -> Column:
    """A form value as (kind, whole, real): int with ``whole``, float with ``real``, or error with neither."""
    whole, real = text.try_cast("long"), text.try_cast("double")
    kind = F.when(whole.isNotNull(), "int").when(real.isNotNull(), "float").otherwise("error")
    return F.struct(kind.alias("kind"), whole.alias("whole"), F.when(whole.isNull(), real).alias("real"))


def coerced(text: Column) -> Column:
    """Kind of a form value: int, float or error."""
    return typed(text)["kind"]


def used_percent(used: Column, total: Column) -> Column:
    return F.round(used / F.greatest(total, F.lit(1)) * 100, 1)


def readable_eta(seconds: Column) -> Column:
    hours, minutes = F.floor(seconds / 3600), F.floor(seconds % 3600 / 60)
    return F.format_string("%dh %02dm", hours.cast("long"), minutes.cast("long"))
