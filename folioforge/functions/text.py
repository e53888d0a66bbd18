"""Column functions for text, codes, values and ids. All stay in the JVM except compose_unicode."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unit spellings (lower case) and the unit each stands for.
UNIT_ALIASES = {
    "in": "in", "inch": "in", "inches": "in", '"': "in", "ft": "ft", "foot": "ft", "feet": "ft", "'": "ft",
    "mm": "mm", "millimeter": "mm", "millimeters": "mm", "millimetre": "mm", "cm": "cm", "centimeter": "cm", "centimeters": "cm",
    "m": "m", "meter": "m", "meters": "m", "metre": "m",
    "lb": "lb", "lbs": "lb", "pound": "lb", "pounds": "lb", "oz": "oz", "ounce": "oz", "ounces": "oz",
    "kg": "kg", "kilogram": "kg", "kilograms": "kg", "g": "g", "gram": "g", "grams": "g",
    "psi": "psi", "bar": "bar", "kpa": "kPa", "mpa": "MPa", "pa": "Pa", "pascal": "Pa", "pascals": "Pa",
    "°c": "°C", "c": "°C", "celsius": "°C", "deg c": "°C", "°f": "°F", "f": "°F", "fahrenheit": "°F", "deg f": "°F",
    "v": "V", "volt": "V", "volts": "V", "a": "A", "amp": "A", "amps": "A", "ampere": "A",
    "w": "W", "watt": "W", "watts": "W", "kw": "kW", "kilowatt": "kW", "mw": "MW", "megawatt": "MW",
    "hz": "Hz", "hertz": "Hz", "khz": "kHz", "mhz": "MHz", "ohm": "Ω", "ohms": "Ω",
    "°": "°", "deg": "°", "degree": "°", "degrees": "°", "tpi": "TPI", "pitch": "pitch", "%": "%", "percent": "%",
}

# Forms of a measurement, in the order in which they are tried.
MEASUREMENTS = (
    r"^(\d+/\d+)\s*([a-zA-Z\"'°]+)\s*$",
    r"^\s*([+-]?\d{1,3}(?:[,\s]\d{3})*(?:\.\d+)?|\d+(?:\.\d+)?)\s*([^\d\s][^\n]*?)\s*$",
    r"^((?:\d+/\d+|\d+(?:\.\d+)?))\s*([a-zA-Z\"'°]+)$",
)

# Texts read as null in records and in model replies.
NULL_WORDS = ("null", "none", "n/a", "")
REPLY_NULL_WORDS = ("null", "none", "")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """body(value) with value computed once, where it is used many times or inside a lambda."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def strip(c: str | Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def label(c: str | Column) -> Column:
    return F.coalesce(F.lower(strip(c)), F.lit(""))


def plain_lines(c: str | Column) -> Column:
    """Line ends as \\n, no white space at the ends; null becomes ''."""
    return F.coalesce(strip(F.regexp_replace(col(c), "\r\n?", "\n")), F.lit(""))


@F.pandas_udf(T.StringType())
def compose_unicode(s: pd.Series) -> pd.Series:
    """Canonical composition (NFC), for which there is no built-in."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFC", x))


def clean(c: str | Column, compose: bool = False) -> Column:
    """Typographic quotes and dashes to plain ones, no registration marks, single blanks; null becomes ''."""
    text = F.translate(col(c), "’‘“”–—®™", "''\"\"--")
    if compose:
        text = compose_unicode(text)
    return F.coalesce(strip(F.regexp_replace(text, r"(?U)\s+", " ")), F.lit(""))


def title_case(c: str | Column) -> Column:
    """A capital after every character that is no letter, as in O'Neil and Part-No."""
    return F.array_join(F.transform(F.regexp_extract_all(col(c), F.lit(r"(?U)(\p{L}+|[^\p{L}]+)"), F.lit(1)), F.initcap), "")


def null_word(c: str | Column, words: tuple[str, ...] = NULL_WORDS) -> Column:
    return F.when(~F.lower(col(c)).isin(*words), F.when(strip(c) != "", strip(c)))


def number(c: str | Column) -> Column:
    """A decimal without group signs, or a fraction; null if it is neither or its denominator is 0."""

    def read(text: Column) -> Column:
        low = F.regexp_extract(text, r"^\d+/(\d+)$", 1).try_cast("double")
        high = F.regexp_extract(text, r"^(\d+)/\d+$", 1).try_cast("double")
        return F.when(text.rlike(r"^[+-]?\d+(\.\d+)?$"), text.try_cast("double")).when(text.contains("/"), F.when(low != 0, high / low))

    return let(F.regexp_replace(col(c), "[, ]", ""), read)


def unit_alias(c: str | Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in UNIT_ALIASES.items() for x in pair])
    return F.try_element_at(pairs, F.regexp_replace(F.lower(strip(c)), r"\.+$", ""))


def value_unit(c: str | Column) -> Column:
    """struct<value double, unit string, raw string> of a measurement in text, else null: a fraction with a unit, a whole
    text of number and unit, or a number run together with its unit, in this order."""
    def way(raw: Column, pattern: str) -> Column:
        amount = number(F.regexp_extract(raw, pattern, 1))
        stated = lambda unit: let(amount, lambda v: F.when(v.isNotNull(), F.struct(v.alias("value"), unit.alias("unit"), raw.alias("raw"))))
        return let(unit_alias(F.regexp_extract(raw, pattern, 2)), lambda unit: F.when(unit.isNotNull(), stated(unit)))

    # texts without a digit are no measurements; most texts end here
    return F.when(col(c).rlike(r"\d"), let(strip(c), lambda raw: F.coalesce(*[way(raw, p) for p in MEASUREMENTS])))


def stable_id(prefix: str, *parts: str | Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(F.concat_ws("\x1f", *[col(p).cast("string") for p in parts]), 256), 1, 16))


def json_list_id(prefix: str, *parts: str | Column) -> Column:
    """prefix_ and 12 hex digits over a JSON list with ', ' between its members."""
    quoted = [F.concat(F.lit('"'), F.replace(F.replace(col(p), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')) for p in parts]
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(F.concat(F.lit("["), F.concat_ws(", ", *quoted), F.lit("]"))), 1, 12))


def ellipsis(c: str | Column, limit: int) -> Column:
    return F.when(F.length(col(c)) > limit, F.concat(F.regexp_replace(F.substring(col(c), 1, limit), r"(?U)\s+$", ""), F.lit("…"))).otherwise(col(c))


def breadcrumb(path: str | Column) -> Column:
    return F.array_join(col(path), " > ")


def split_breadcrumb(c: str | Column) -> Column:
    return F.filter(F.transform(F.split(col(c), " > "), strip), lambda x: x != "")


def heading_key(c: str | Column) -> Column:
    """Sorted words of a heading, lower case, without a plural s."""
    words = F.regexp_extract_all(F.lower(col(c)), F.lit(r"(?U)(\w+)"), F.lit(1))
    return F.array_sort(F.transform(words, lambda w: F.regexp_replace(w, "s+$", "")))


def within_heading(name: str | Column, heading: str | Column) -> Column:
    return (F.size(heading_key(name)) > 0) & (F.size(F.array_except(heading_key(name), heading_key(heading))) == 0)


def holds_identifier(text: str | Column, code: str | Column) -> Column:
    """Whether text holds the code as a whole word, whatever signs the code has."""
    return F.rlike(col(text), F.concat(F.lit(r"(?<!\w)\Q"), F.replace(col(code), F.lit(r"\E"), F.lit("")), F.lit(r"\E(?!\w)")))


def odd_share(c: str | Column) -> Column:
    """Share of characters outside printable Latin and common Han."""
    kept = F.length(F.regexp_replace(col(c), r"[^\x20-\x7E -ɏ一-鿿]", ""))
    return (F.length(col(c)) - kept) / F.greatest(F.length(col(c)), F.lit(1))


def dense_codes(c: str | Column) -> Column:
    return F.regexp_count(col(c), F.lit(r"\d{4,5}[A-Z]\d{2,4}"))


def chunk_page(c: str | Column) -> Column:
    """Page number in a chunk id stem__pN__cM; 1 where there is none."""
    return F.coalesce(F.regexp_extract(col(c), r"__p(\d+)(?:__|$)", 1).try_cast("int"), F.lit(1))


def prompt_size(c: str | Column) -> Column:
    """struct<chars, tokens>, at four characters a token."""
    return F.struct(F.length(col(c)).alias("chars"), F.ceil(F.length(col(c)) / 4).alias("tokens"))
