"""Units of measure: spellings, a graph of affine conversions, and their shortest compositions."""

from __future__ import annotations

import math
import unicodedata
from collections import deque
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Quantity -> unit -> its spellings.
SPELLINGS: dict[str, dict[str, tuple[str, ...]]] = {
    "length": {
        "mm": ("mm", "millimeter", "millimeters", "millimetre", "millimetres"),
        "cm": ("cm", "centimeter", "centimeters", "centimetre", "centimetres"),
        "m": ("m", "meter", "meters", "metre", "metres"),
        "um": ("um", "micron", "microns", "micrometer", "micrometers", "micrometre", "micrometres"),
        "nm": ("nm", "nanometer", "nanometers", "nanometre", "nanometres"),
        "km": ("km", "kilometer", "kilometers", "kilometre", "kilometres"),
        "in": ("in", "inch", "inches", '"', "''", "′′", "”"),
        "ft": ("ft", "foot", "feet", "'", "′", "’"),
        "yd": ("yd", "yard", "yards"),
        "mil": ("mil", "mils", "thou"),
    },
    "mass": {
        "kg": ("kg", "kgs", "kilogram", "kilograms", "kilo", "kilos"),
        "g": ("g", "gr", "gm", "gram", "grams", "gramme", "grammes"),
        "mg": ("mg", "milligram", "milligrams"),
        "t": ("t", "tonne", "tonnes", "metric ton", "metric tons"),
        "lb": ("lb", "lbs", "lbm", "pound", "pounds"),
        "oz": ("oz", "ounce", "ounces"),
    },
    "pressure": {
        "kPa": ("kpa", "kilopascal", "kilopascals"),
        "MPa": ("mpa", "megapascal", "megapascals"),
        "Pa": ("pa", "pascal", "pascals"),
        "hPa": ("hpa", "hectopascal", "hectopascals"),
        "bar": ("bar", "bars"),
        "mbar": ("mbar", "mbars", "millibar", "millibars"),
        "psi": ("psi", "lbf/in2", "lb/in2", "pound per square inch", "pounds per square inch"),
        "atm": ("atm", "atmosphere", "atmospheres"),
        "torr": ("torr", "mmhg"),
    },
    "temperature": {
        "°C": ("°c", "c", "degc", "degreec", "degreesc", "celsius", "degcelsius", "degreecelsius", "degreescelsius", "centigrade"),
        "°F": ("°f", "f", "degf", "degreef", "degreesf", "fahrenheit", "degfahrenheit", "degreefahrenheit", "degreesfahrenheit"),
        "K": ("k", "kelvin", "kelvins", "°k", "degk"),
    },
    "voltage": {
        "V": ("v", "volt", "volts", "vdc", "vac"),
        "mV": ("mv", "millivolt", "millivolts"),
        "kV": ("kv", "kilovolt", "kilovolts"),
        "uV": ("uv", "microvolt", "microvolts"),
    },
    "flow": {
        "L/min": ("l/min", "lpm", "litre per minute", "litres per minute", "liter per minute", "liters per minute"),
        "mL/min": ("ml/min", "cc/min", "ccm", "cm3/min", "millilitre per minute", "millilitres per minute", "milliliter per minute", "milliliters per minute"),
        "m3/h": ("m3/h", "m^3/h", "m3/hr", "cbm/h", "cubic metre per hour", "cubic metres per hour", "cubic meter per hour", "cubic meters per hour"),
        "gal/min": ("gal/min", "usgal/min", "gpm", "usgpm", "gallon per minute", "gallons per minute", "us gallons per minute"),
        "L/h": ("l/h", "l/hr", "lph", "litre per hour", "litres per hour", "liter per hour", "liters per hour"),
        "L/s": ("l/s", "litre per second", "litres per second", "liter per second", "liters per second"),
    },
    "angle": {
        "°": ("°", "deg", "degs", "degree", "degrees"),
        "rad": ("rad", "rads", "radian", "radians"),
        "mrad": ("mrad", "mrads", "milliradian", "milliradians"),
        "arcmin": ("arcmin", "arcmins", "arcminute", "arcminutes", "minute of arc", "minutes of arc", "′", "'"),
        "arcsec": ("arcsec", "arcsecs", "arcsecond", "arcseconds", "second of arc", "seconds of arc", "′′", '"'),
        "turn": ("turn", "turns", "rev", "revolution", "revolutions"),
    },
    "torque": {
        "N·m": ("nm", "newtonmetre", "newtonmetres", "newtonmeter", "newtonmeters"),
        "N·cm": ("ncm", "newtoncentimetre", "newtoncentimetres", "newtoncentimeter", "newtoncentimeters"),
        "mN·m": ("mnm", "millinewtonmetre", "millinewtonmetres", "millinewtonmeter", "millinewtonmeters"),
        "kN·m": ("knm", "kilonewtonmetre", "kilonewtonmetres", "kilonewtonmeter", "kilonewtonmeters"),
        "in·lbf": ("inlb", "inlbs", "inlbf", "lbin", "lbsin", "lbfin", "inchpound", "inchpounds", "poundinch", "poundinches", "poundforceinch"),
        "ft·lbf": ("ftlb", "ftlbs", "ftlbf", "lbft", "lbsft", "lbfft", "footpound", "footpounds", "poundfoot", "poundfeet", "poundforcefoot"),
        "ozf·in": ("ozin", "inoz", "ozfin", "ounceinch", "ounceinches", "inchounce", "inchounces"),
        "kgf·cm": ("kgfcm", "kgcm"),
        "kgf·m": ("kgfm", "kgm"),
    },
}
SPELLINGS["wavelength"] = {u: SPELLINGS["length"][u] for u in ("nm", "um", "mm")} | {
    "Å": ("å", "angstrom", "angstroms", "ångström", "ångströms", "ångstrom"),
    "pm": ("pm", "picometer", "picometers", "picometre", "picometres"),
}

# One edge (from, to, scale, offset) says to = scale * from + offset.
EDGES: dict[str, tuple[tuple[str, str, float, float], ...]] = {
    "length": (("cm", "mm", 10.0, 0.0), ("m", "cm", 100.0, 0.0), ("km", "m", 1000.0, 0.0), ("um", "mm", 0.001, 0.0), ("nm", "um", 0.001, 0.0), ("in", "mm", 25.4, 0.0), ("ft", "in", 12.0, 0.0), ("yd", "ft", 3.0, 0.0), ("mil", "in", 0.001, 0.0), ("m", "mm", 1000.0, 0.0), ("in", "cm", 2.54, 0.0)),
    "mass": (("g", "kg", 0.001, 0.0), ("mg", "g", 0.001, 0.0), ("t", "kg", 1000.0, 0.0), ("lb", "kg", 0.45359237, 0.0), ("oz", "lb", 0.0625, 0.0), ("oz", "g", 28.349523125, 0.0)),
    "pressure": (("Pa", "kPa", 0.001, 0.0), ("hPa", "Pa", 100.0, 0.0), ("MPa", "kPa", 1000.0, 0.0), ("bar", "kPa", 100.0, 0.0), ("mbar", "bar", 0.001, 0.0), ("psi", "kPa", 6.894757293168361, 0.0), ("atm", "kPa", 101.325, 0.0), ("torr", "atm", 1 / 760, 0.0), ("mbar", "hPa", 1.0, 0.0)),
    "temperature": (("°F", "°C", 5 / 9, -160 / 9), ("K", "°C", 1.0, -273.15)),
    "voltage": (("mV", "V", 0.001, 0.0), ("kV", "V", 1000.0, 0.0), ("uV", "mV", 0.001, 0.0)),
    "flow": (("mL/min", "L/min", 0.001, 0.0), ("m3/h", "L/min", 1000 / 60, 0.0), ("gal/min", "L/min", 3.785411784, 0.0), ("L/h", "L/min", 1 / 60, 0.0), ("L/s", "L/min", 60.0, 0.0), ("m3/h", "L/h", 1000.0, 0.0)),
    "angle": (("rad", "°", 180 / math.pi, 0.0), ("mrad", "rad", 0.001, 0.0), ("arcmin", "°", 1 / 60, 0.0), ("arcsec", "arcmin", 1 / 60, 0.0), ("turn", "°", 360.0, 0.0)),
    "torque": (("N·cm", "N·m", 0.01, 0.0), ("mN·m", "N·m", 0.001, 0.0), ("kN·m", "N·m", 1000.0, 0.0), ("ft·lbf", "N·m", 1.3558179483314004, 0.0), ("in·lbf", "ft·lbf", 1 / 12, 0.0), ("ozf·in", "in·lbf", 0.0625, 0.0), ("kgf·cm", "kgf·m", 0.01, 0.0), ("kgf·m", "N·m", 9.80665, 0.0)),
    "wavelength": (("um", "nm", 1000.0, 0.0), ("mm", "um", 1000.0, 0.0), ("Å", "nm", 0.1, 0.0), ("pm", "nm", 0.001, 0.0)),
}

_SIGNS = str.maketrans({"º": "°", "˚": "°", "μ": "u", "µ": "u", "²": "2", "³": "3", "⁄": "/", "×": "x", "“": '"', "‘": "'", "`": "'", "´": "'"})


@lru_cache(maxsize=65536)
def fold_unit(text: str) -> str:
    """One form for all spellings of a unit: case, width, dots, hyphens and blanks do not matter."""
    text = unicodedata.normalize("NFKC", text.translate(_SIGNS)).translate(_SIGNS).casefold()
    return "".join(ch for ch in text if not (ch.isspace() or ch in ".·⋅∙*-‐‑–"))


@lru_cache(maxsize=None)
def spelling_table(quantity: str) -> dict[str, str]:
    return {fold_unit(s): unit for unit, names in SPELLINGS.get(quantity, {}).items() for s in names}


def unit_of(quantity: str, text: str | None) -> str | None:
    return spelling_table(quantity).get(fold_unit(text)) if text else None


def compose(edges, target: str) -> dict[str, tuple[float, float, int]]:
    """Shortest compositions to target by breadth-first search: unit -> (scale, offset, edges used)."""
    near: dict[str, list[tuple[str, float, float]]] = {}
    for a, b, scale, offset in edges:
        # walking from target outwards: the value in the nearer unit as a function of the farther one
        near.setdefault(b, []).append((a, scale, offset))
        near.setdefault(a, []).append((b, 1 / scale, -offset / scale))
    found = {target: (1.0, 0.0, 0)}
    queue = deque([target])
    while queue:
        at = queue.popleft()
        scale, offset, hops = found[at]
        for other, s, o in near.get(at, ()):
            if other not in found:
                found[other] = (scale * s, scale * o + offset, hops + 1)
                queue.append(other)
    return found


def inconsistent_cycles(edges, tolerance: float = 1e-9) -> list[tuple[str, str, float]]:
    """Edges that contradict the composition over the rest of their cycle, with the relative error."""
    bad = []
    for start in {e[1] for e in edges}:
        found = compose(edges, start)
        for a, b, scale, offset in edges:
            if a in found and b in found:
                sb, ob, _ = found[b]
                sa, oa, _ = found[a]
                error = max(abs(sb * scale - sa) / max(abs(sa), 1e-300), abs(sb * offset + ob - oa) / max(abs(oa), 1.0))
                if error > tolerance:
                    bad.append((a, b, error))
    return bad


def common_unit(quantity: str, text: str) -> str | None:
    return unit_of(quantity, text)


@lru_cache(maxsize=None)
def registered_conversions() -> tuple[tuple[str, str, str, float, float, int], ...]:
    """conversion_rows of the register above, composed and checked once."""
    return tuple(conversion_rows())


def conversion_rows(edges_by_quantity=None) -> list[tuple[str, str, str, float, float, int]]:
    """(quantity, source unit, target unit, scale, offset, hops) for all pairs; raises on contradicting cycles."""
    rows = []
    for quantity, edges in (edges_by_quantity or EDGES).items():
        if bad := inconsistent_cycles(edges):
            raise ValueError(f"conversions of {quantity} contradict each other: {bad}")
        for target in sorted({u for e in edges for u in e[:2]}):
            for source, (scale, offset, hops) in sorted(compose(edges, target).items()):
                rows.append((quantity, source, target, scale, offset, hops))
    return rows


CONVERSION_SCHEMA = T.StructType(
    [
        T.StructField("quantity", T.StringType(), False),
        T.StructField("source_unit", T.StringType(), False),
        T.StructField("target_unit", T.StringType(), False),
        T.StructField("scale", T.DoubleType(), False),
        T.StructField("offset", T.DoubleType(), False),
        T.StructField("hops", T.IntegerType(), False),
    ]
)


def conversion_table(spark: SparkSession) -> DataFrame:
    """The compositions as a table; its size is that of the unit register above, whatever the data."""
    return spark.createDataFrame(registered_conversions(), CONVERSION_SCHEMA).coalesce(1)
