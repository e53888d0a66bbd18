"""What an attribute record states: which attribute its key means and which typed value it gives.

Keys, values and units come in many notations and units stand in any of the three columns, so the reading is a
small parser. It runs as an Arrow-batched Pandas UDF with bounded memo tables; all grouping and joining stays in the JVM.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions.units import spelling_table, unit_of

#: Most rows attribute_defs may have to be taken to the driver; it is a register, not data.
MAX_DEFS = 10_000
#: Largest and smallest whole number an integer column holds.
BIGINT_MAX, BIGINT_MIN = (1 << 63) - 1, -(1 << 63)
#: Exponents beyond this many digits are out of the range of a double whatever stands before them.
EXPONENT_DIGITS = 6
#: Keys a worker remembers, and the longest of them.
KEYS_HELD, KEY_LENGTH = 200_000, 256

# Texts that stand for a missing value.
PLACEHOLDERS = frozenset(
    ["", "-", "--", "---", "–", "—", "―", "−", "?", "??", "???", ".", "..", "...", "*", "/", "\\", "_", "$", "n/a", "na", "n.a", "n.a.", "#n/a", "not available", "not applicable", "tbd", "t.b.d", "t.b.d.", "tba", "tbc", "null", "none", "nil", "nan", "unknown", "undefined", "see note", "see notes", "see drawing", "see page", "see text", "see table", "see catalog", "see certificate", "varies", "various", "call", "call for price", "on request", "pending", "missing", "empty", "xxx"]
)

# Plain answers.
YES = frozenset(["yes", "y", "true", "t", "1", "✓", "✔", "☑", "✅", "ja", "oui", "si", "sí"])
NO = frozenset(["no", "n", "false", "f", "0", "✗", "✘", "✕", "×", "❌", "☒", "nein", "non"])

# Words that may stand beside a bare number without changing what it states.
QUALIFIERS = frozenset(
    ["approx", "approximately", "about", "ca", "circa", "around", "up", "to", "max", "min", "maximum", "minimum", "nominal", "nom", "rated", "measured", "typ", "typical", "at", "most", "least", "over", "under", "avg", "average", "roughly"]
)

_GLYPHS = str.maketrans("асекорхуіѕјԁѵԛԝЕТОРАНКХСВМабІοανιρυτκΑΒΕΗΙΚΜΝΟΡΤΥΧ", "acekopxyisjdvqwETOPAHKXCBMa6IoaviputkABEHIKMNOPTYX")
_SPACES = re.compile(r"[\s_]+")
_MARKS = " \t:*;=.#†‡"
_IN_KEY = (
    re.compile(r"^(.*?)\s*[(\[{]\s*([^()\[\]{}]+?)\s*[)\]}]$"),
    re.compile(r"^(.*?)\s*,\s*(\S.*)$"),
    re.compile(r"^(.*?)\s+in\s+(\S.*)$", re.I),
    re.compile(r"^(.*?)\s*/\s*(\S.*)$"),
)
_SUPERSCRIPTS = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺", "0123456789-+")
_RAISED = re.compile(r"(?<=10)[⁻⁺]?[⁰¹²³⁴⁵⁶⁷⁸⁹]+")
_FRACTIONS = re.compile(r"(\d?)([¼½¾⅐-⅞])")
_BLANKS = "  -   　"
_GAP = re.compile(f"(?<=\\d)[ '’{_BLANKS}](?=\\d{{3}}(?!\\d))")
_NUMBER = re.compile(
    r"(?:(?P<sign>[+\-−–])\s*)?(?:"
    r"(?P<whole>\d+)(?:\s+|\s*-\s*)(?P<n1>\d+)\s*/\s*(?P<d1>\d+)"
    r"|(?P<n2>\d+)\s*/\s*(?P<d2>\d+)"
    r"|(?P<dec>(?:\d{1,3}(?:[ '’]\d{3})+(?:[.,]\d+)?|\d[\d.,]*\d|\d|[.,]\d+))"
    r"(?:\s*(?:[x×*·]\s*10\s*(?:\^|\*\*)?\s*(?P<exp>[+\-−]?\d+)|[eE](?P<exp2>[+\-]?\d+)))?"
    r")"
)


def clean_key(key: str) -> str:
    text = unicodedata.normalize("NFKC", key).translate(_GLYPHS)
    return _SPACES.sub(" ", text).strip(_MARKS).casefold()


def near(a: str, b: str, limit: int) -> bool:
    """Restricted edit distance (a swap of neighbours counts once) of at most limit."""
    if abs(len(a) - len(b)) > limit:
        return False
    prev2: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, prev2[j - 2] + 1)
            row.append(best)
        if min(row) > limit:
            return False
        prev2, prev = prev, row
    return prev[-1] <= limit


# Letter groups that scans take for one another.
LOOKALIKES = (("rn", "m"), ("cl", "d"), ("ii", "u"), ("vv", "w"), ("nn", "m"), ("1", "l"), ("i", "l"), ("|", "l"), ("0", "o"), ("5", "s"), ("@", "a"), ("q", "g"), ("8", "b"))


def without_joints(name: str) -> str:
    return name.replace(" ", "").replace(".", "")


def cuts(name: str) -> list[str]:
    """The name and all its forms with one letter left out; names one edit apart share one of them."""
    return [name, *(name[:i] + name[i + 1 :] for i in range(len(name)))]


def look(name: str) -> str:
    """What the name looks like: lookalike letters become one."""
    for seen, real in LOOKALIKES:
        name = name.replace(seen, real)
    return name


@dataclass
class Definitions:
    """attribute_defs in memory: name -> (quantity, common unit, value type) and all its known spellings."""

    rows: list[tuple]
    kinds: dict[str, tuple] = field(default_factory=dict)
    names: dict[str, str] = field(default_factory=dict)
    keys: dict = field(default_factory=dict)
    dense: dict = field(default_factory=dict)
    looks: dict = field(default_factory=dict)
    cut_once: dict = field(default_factory=dict)
    longest: int = 0

    def __post_init__(self):
        for attr, quantity, unit, kind, known in self.rows:
            if attr is None:
                continue
            self.kinds[attr] = (quantity, unit, kind or "text")
            for name in [attr, *(known or [])]:
                if name and (c := clean_key(name)):
                    self.names.setdefault(c, attr)
                    self.longest = max(self.longest, len(c))
        for name, attr in self.names.items():
            self.dense.setdefault(without_joints(name), set()).add(attr)
            if len(name) > 3:
                self.looks.setdefault(look(name), set()).add(attr)
                for piece in cuts(name):
                    self.cut_once.setdefault(piece, set()).add(name)

    def exact_or_near(self, name: str) -> str | None:
        """The attribute of a cleaned name; names of five letters or more may be damaged in one place.

        A damaged name must be near to names of one attribute only."""
        if name in self.names:
            return self.names[name]
        same = self.dense.get(without_joints(name), ())
        if len(same) == 1:
            return next(iter(same))
        # lookalikes shorten a name to its half at most, so a longer one is near to none
        if len(name) < 4 or len(name) > 2 * self.longest + 1:
            return None
        close = set().union(*(self.cut_once.get(piece, ()) for piece in cuts(name)))
        hits = {self.names[k] for k in close if near(name, k, 1)} | self.looks.get(look(name), set())
        return hits.pop() if len(hits) == 1 else None

    def meaning(self, key: str | None) -> tuple[str | None, str | None]:
        """(attribute, unit written in the key) or (None, None)."""
        if key is None:
            return None, None
        if key in self.keys:
            return self.keys[key]
        found = self._meaning(key)
        if len(self.keys) < KEYS_HELD and len(key) <= KEY_LENGTH:
            self.keys[key] = found
        return found

    def _meaning(self, key: str) -> tuple[str | None, str | None]:
        attr = self.exact_or_near(clean_key(key))
        if attr:
            return attr, None
        text = re.sub(r"[\s_]+", " ", key).strip(" \t:*;=#†‡")
        for pattern in _IN_KEY:
            if m := pattern.match(text):
                attr = self.exact_or_near(clean_key(m[1]))
                if attr:
                    quantity = self.kinds[attr][0]
                    unit = unit_of(quantity, m[2]) if quantity else None
                    if unit or quantity is None:
                        return attr, unit
        return None, None


def plain_number(text: str) -> float | None:
    """A decimal in any common notation: 1,234.5 and 1.234,5 and 1 234,5; a lone comma before exactly three digits groups thousands, any other lone comma is the decimal mark."""
    text = re.sub(r"[ '’]", "", text)
    if text[-1] in ".,":
        text = text[:-1]
    dots, commas = text.count("."), text.count(",")
    if dots and commas:
        mark = max(text.rfind("."), text.rfind(","))
        whole, part = text[:mark], text[mark + 1 :]
        group = "," if text[mark] == "." else "."
        if text[mark] in whole or not re.fullmatch(rf"\d{{1,3}}(?:\{group}\d{{3}})+", whole):
            return None
        text = whole.replace(group, "") + "." + part
    elif commas:
        if re.fullmatch(r"[1-9]\d{0,2}(?:,\d{3})+", text):
            text = text.replace(",", "")
        elif commas == 1:
            text = text.replace(",", ".")
        else:
            return None
    elif dots > 1:
        if not re.fullmatch(r"[1-9]\d{0,2}(?:\.\d{3})+", text):
            return None
        text = text.replace(".", "")
    try:
        return finite(float(text))
    except ValueError:
        return None


def finite(value: float | None) -> float | None:
    return value if value is not None and math.isfinite(value) else None


def ratio(above: str, below: str) -> float | None:
    """A fraction of two digit strings of any length; none if a part or the result is beyond a double."""
    a, b = float(above), float(below)
    return finite(a / b) if b and math.isfinite(a) and math.isfinite(b) else None


def raised(value: float, power: str) -> float | None:
    """value times ten to the power; zero stays zero, and what is too large for a double is no number."""
    power = power.replace("−", "-")
    sign, digits = ("-" if power.startswith("-") else ""), power.lstrip("+-").lstrip("0") or "0"
    if value == 0 or len(digits) > EXPONENT_DIGITS:
        return 0.0 if value == 0 or sign else None
    n = int(sign + digits)
    if abs(n) < 300:
        return finite(value * 10.0**n)
    digits, _, own = f"{value:.17e}".partition("e")
    return finite(float(f"{digits}e{int(own) + n}"))


def number_of(m: re.Match) -> float | None:
    """The number of a match, of any length; none if it is beyond the range of a double."""
    if m["whole"]:
        part, whole = ratio(m["n1"], m["d1"]), float(m["whole"])
        value = finite(whole + part) if part is not None else None
    elif m["n2"]:
        value = ratio(m["n2"], m["d2"])
    else:
        value = plain_number(m["dec"])
        if value is not None and (e := m["exp"] or m["exp2"]):
            value = raised(value, e)
    if value is None:
        return None
    return -value if m["sign"] in ("-", "−") else value


_SIMPLE = re.compile(r"^[ \t+~]*(\d+(?:\.\d+)?)\s*([^\d\s.,/^(±+\-][^\d,(]*[23]?)?\s*$", re.A)


@lru_cache(maxsize=4096)
def _unit_pattern(quantity: str) -> re.Pattern:
    """Spellings of the quantity's units with free dots, hyphens and blanks between their letters, the longest first."""
    joint = r"[\s.·⋅∙*\-‐]*"
    alts = []
    for s in sorted(spelling_table(quantity), key=len, reverse=True):
        body = joint.join(re.escape(ch) for ch in s)
        alts.append(body + (r"(?![a-zåäöß])" if s[-1].isalpha() else ""))
    return re.compile(r"\s*(" + "|".join(alts) + r")\.?", re.I)


def tidy_value(value: str) -> str:
    text = _RAISED.sub(lambda m: "^" + m[0].translate(_SUPERSCRIPTS), value)
    text = _FRACTIONS.sub(lambda m: m[1] + " " * bool(m[1]) + unicodedata.normalize("NFKC", m[2]).replace("⁄", "/"), text)
    text = text.replace("º", "°").replace("²", "2").replace("³", "3")
    text = unicodedata.normalize("NFKC", text).replace("⁄", "/").replace("μ", "u").replace("µ", "u")
    text = text.replace("“", '"').replace("”", '"').replace("‘", "'").replace("’", "'")
    return re.sub(r"\s+", " ", text).strip()


def measured(value: str | None, unit: str | None, key_unit: str | None, quantity: str) -> tuple[float, str] | None:
    """The amount a record states: the first number followed by a unit of the quantity, else the only number of a value
    without other words, in the unit of the unit column or of the key."""
    if value is None:
        return None
    if (m := _SIMPLE.match(value)) and (n := finite(float(m[1]))) is not None:
        if not m[2]:
            found = unit_of(quantity, unit) or key_unit
            return (n, found) if found else None
        if found := unit_of(quantity, m[2]):
            return n, found
    text = tidy_value(value)
    if text.casefold() in PLACEHOLDERS:
        return None
    pattern = _unit_pattern(quantity)
    first, numbers = None, 0
    covered = text
    for m in _NUMBER.finditer(text):
        before = text[m.start() - 1] if m.start() else " "
        if before.isalpha() and before not in "x×~≤≥<>":
            continue
        numbers += 1
        v = number_of(m)
        if v is not None:
            u = pattern.match(text, m.end())
            if u:
                return v, unit_of(quantity, u[1])
            if first is None:
                first, covered = v, text[: m.start()] + " " + text[m.end() :]
    if first is None:
        return None
    rest = re.findall(r"[^\W\d_]+", covered)
    if numbers > 1 or any(w.casefold() not in QUALIFIERS for w in rest) or re.search(r"[\"'°%/$€£¥]", covered):
        return None
    found = unit_of(quantity, unit) or key_unit
    return (first, found) if found else None


# Currency signs and codes that may stand before or after a price.
CURRENCIES = ("$", "€", "£", "¥", "元", "円", "USD", "EUR", "GBP", "CNY", "RMB", "JPY", "CHF", "US$")
_PRICE = re.compile(
    r"(?:(?:" + "|".join(map(re.escape, sorted(CURRENCIES, key=len, reverse=True))) + r")\s*)?"
    r"(?P<n>\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d{1,3}(?:\.\d{3})+(?:,\d+)?|\d{1,3}(?:[ ']\d{3})+(?:[.,]\d{1,2})?|\d+(?:[.,]\d+)?)"
    r"(?:\s*(?:" + "|".join(map(re.escape, sorted(CURRENCIES, key=len, reverse=True))) + r"))?",
    re.I,
)


def price_of(value: str) -> float | None:
    """One well-formed price, with one currency mark at most on either side; anything else is none."""
    text = tidy_value(value)
    m = _PRICE.fullmatch(text)
    if not m:
        return None
    n = m["n"]
    if re.fullmatch(r"\d+\.\d+", n):
        return finite(float(n))
    return plain_number(n)


def whole_number(value: str) -> int | None:
    """A whole number of any length up to the range of bigint; a larger one fits no integer column and is none."""
    text = tidy_value(value)
    m = re.fullmatch(r"([+]?(?:\d{1,3}(?:[, ']\d{3})+|\d+))(?:\.0+)?(?:\s*(?:ports?|pcs?\.?|pieces?|pc|ea\.?|each|units?|x|st\.?|off|per pack|/ ?pack|packs?|holes?|outlets?|ways?))?", text, re.I)
    if not m:
        return None
    digits = re.sub(r"[, '+]", "", m[1]).lstrip("0") or "0"
    n = int(digits) if len(digits) <= len(str(BIGINT_MAX)) else BIGINT_MAX + 1
    return n if n <= BIGINT_MAX else None


def yes_no(value: str) -> bool | None:
    text = tidy_value(value).casefold().rstrip(".")
    return True if text in YES else False if text in NO else None


def read_record(defs: Definitions, key, value, unit):
    """(attr_name, number, unit, text, flag, whole): number in unit where the attribute is measured; attr_name is null if
    the key means none. Whole numbers travel as such, so none is rounded."""
    attr, key_unit = defs.meaning(key)
    if attr is None:
        return None, None, None, None, None, None
    quantity, common, kind = defs.kinds[attr]
    if kind == "number" and quantity and common:
        got = measured(value, unit, key_unit, quantity)
        return (attr, *got, None, None, None) if got else (attr, None, None, None, None, None)
    if value is None or tidy_value(value).casefold() in PLACEHOLDERS:
        # a plain "1", "0", "x" or "-" is decided by the kind; placeholders are none of any kind
        return attr, None, None, None, None, None
    if kind == "number":
        return attr, price_of(value), None, None, None, None
    if kind == "integer":
        return attr, None, None, None, None, whole_number(value)
    if kind == "boolean":
        return attr, None, None, None, yes_no(value), None
    return attr, None, None, tidy_value(value), None, None


READING = T.StructType(
    [
        T.StructField("attr_name", T.StringType()),
        T.StructField("number", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("flag", T.BooleanType()),
        T.StructField("whole", T.LongType()),
    ]
)


def definitions(defs_df: DataFrame) -> Definitions:
    """Reads the attribute register; refuses one of more than MAX_DEFS rows."""
    rows = defs_df.select("attr_name", "quantity", "common_unit", "value_type", "known_names").limit(MAX_DEFS + 1).collect()
    if len(rows) > MAX_DEFS:
        raise ValueError(f"attribute_defs has more than {MAX_DEFS} rows")
    return Definitions([tuple(r) for r in sorted(rows, key=lambda r: r[0] or "")])


def reading(defs: Definitions, key: Column, value: Column, unit: Column) -> Column:
    """Column of READING structs."""
    shared = Definitions(defs.rows)

    @F.pandas_udf(READING)
    def read(k: pd.Series, v: pd.Series, u: pd.Series) -> pd.DataFrame:
        memo: dict = {}
        out = []
        for triple in zip(k, v, u):
            got = memo.get(triple)
            if got is None:
                got = memo[triple] = read_record(shared, *triple)
            out.append(got)
        columns = list(zip(*out)) or [()] * len(READING.names)
        frame = pd.DataFrame({name: pd.Series(c, dtype=object) for name, c in zip(READING.names, columns)})
        # whole numbers never pass through a double
        return frame.astype({"number": "float64", "whole": "Int64"})

    return read(key, value, unit)
