import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.functions import units as U
from folioforge.functions.records import Definitions, price_of, read_record, whole_number
from folioforge.operators import unitjoin, widetable

DEFS = [
    ("length", "length", "mm", "number", ["length", "overall length"]),
    ("outer_diameter", "length", "mm", "number", ["outer diameter", "od", "o.d."]),
    ("max_temperature", "temperature", "°C", "number", ["max temperature"]),
    ("wavelength", "wavelength", "nm", "number", ["wavelength"]),
    ("max_torque", "torque", "N·m", "number", ["max torque"]),
    ("list_price", None, None, "number", ["price"]),
    ("pack_qty", None, None, "integer", ["pack quantity"]),
    ("rohs", None, None, "boolean", ["rohs"]),
    ("finish", None, None, "text", ["finish"]),
]
D = Definitions(DEFS)
DEF_SCHEMA = "attr_name string, quantity string, common_unit string, value_type string, known_names array<string>"
SCHEMA = "attr_id long, doc_stem string, entity string, key string, value string, unit string, extracted_at timestamp_ntz, ingested_at timestamp_ntz, r string"


@pytest.mark.parametrize(
    "key, value, unit, want",
    [
        ("Length", "2.9", "centimetre", ("length", 2.9, "cm")),
        ("  overall_length:", "~68 mm", None, ("length", 68.0, "mm")),
        ("LENGTH (in.)", "3 3/8", None, ("length", 3.375, "in")),
        ("Lenqth", "1-5/16″", None, ("length", 1.3125, "in")),
        ("O.D., m", ".171", None, ("outer_diameter", 0.171, "m")),
        ("Od", "17,343micron", None, ("outer_diameter", 17343.0, "um")),
        ("length", "8 690", "µm", ("length", 8690.0, "um")),
        ("length", "rated 0.32 \", measured", None, ("length", 0.32, "in")),
        ("length", "19 mm (see note 3)", None, ("length", 19.0, "mm")),
        ("Wavelength", "4.68 × 10^4", "Å", ("wavelength", 46800.0, "Å")),
        ("Wavelength", "570 NM", None, ("wavelength", 570.0, "nm")),
        ("Max Torque in lbf·ft", "1,3", None, ("max_torque", 1.3, "ft·lbf")),
        ("max temperature", "-40 º C", None, ("max_temperature", -40.0, "°C")),
        ("length", "12", None, ("length", None, None)),
        ("length", "see page 12", "mm", ("length", None, None)),
        ("length", "—", "mm", ("length", None, None)),
        ("Thread Length", "12", "mm", (None, None, None)),
        (None, "12", "mm", (None, None, None)),
        ("length", None, "mm", ("length", None, None)),
    ],
)
def test_measured_records(key, value, unit, want):
    got = read_record(D, key, value, unit)
    assert got[0] == want[0] and got[2] == want[2] and (got[1] == pytest.approx(want[1]) if want[1] is not None else got[1] is None)


def test_other_types():
    assert [price_of(x) for x in ("$ 1,234.56", "1.234,56 EUR", "223,59", "7,31.08", "1.234,5,6", "call", "-3")] == [1234.56, 1234.56, 223.59, None, None, None, None]
    assert [whole_number(x) for x in (" 10 ", "288 pcs", "1,200", "2.5", "several")] == [10, 288, 1200, None, None]
    assert read_record(D, "ROHS*", "✓", None)[4] is True and read_record(D, "rohs", "N", None)[4] is False and read_record(D, "rohs", "partially", None)[4] is None
    assert read_record(D, "Finnish", " Nickel  Plate ", None)[3] == "Nickel Plate" and read_record(D, "finish", "TBD", None)[3] is None


def test_unit_graph():
    assert U.compose(U.EDGES["temperature"], "°C")["°F"][:2] == pytest.approx((5 / 9, -160 / 9))
    assert all(not U.inconsistent_cycles(e) for e in U.EDGES.values())
    assert U.inconsistent_cycles((("in", "mm", 25.4, 0.0), ("ft", "in", 12.0, 0.0), ("ft", "mm", 300.0, 0.0)))
    with pytest.raises(ValueError):
        U.conversion_rows({"length": (("in", "mm", 25.4, 0.0), ("in", "mm", 25.0, 0.0))})
    assert all(U.unit_of(q, s) == u for q, units in U.SPELLINGS.items() for u, names in units.items() for s in names)


def t(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def rows(*records):
    return [(i, d, e, k, v, u, t(at), t(at + 40), "clash") for i, (d, e, k, v, u, at) in enumerate(records, 1)]


def test_wide_table_takes_the_latest_version(spark):
    data = rows(("d", " X ", "Length", "1 cm", None, 0), ("d", "X", "length", "20", "mm", 5), ("d", "X", "length", "n/a", "mm", 9), ("d", "X", "rohs", "yes", None, 1), ("d", "X", "page", "7", None, 1), ("d", None, "length", "3", "mm", 1), ("d", " \t", "length", "3", "mm", 1), (None, "Y", "pack quantity", "12 pcs", None, 2), ("d", "Z", "finish", "-", None, 2))
    defs = spark.createDataFrame(DEFS, DEF_SCHEMA)
    out = {r["entity"]: r for r in widetable.wide_table(spark, spark.createDataFrame(data + data[:2], SCHEMA), defs).collect()}
    assert set(out) == {"X", "Y"}
    assert out["X"]["length"] == 20.0 and out["X"]["rohs"] is True and out["X"]["finish"] is None and out["Y"]["pack_qty"] == 12
    assert widetable.wide_table(spark, spark.createDataFrame([], SCHEMA), defs).count() == 0
    assert widetable.wide_table(spark, spark.createDataFrame(data, SCHEMA), spark.createDataFrame([], DEF_SCHEMA)).count() == 0


def test_agreeing_pairs_against_brute_force(spark):
    import random

    rng = random.Random(2)
    amounts = [(i, "d", rng.choice(["hot", "hot", "e1", None]), "length", rng.choice(["mm", "in", "cm"]), rng.choice([1, -1, 1, 1]) * rng.choice([0.0, 10.0, 10.04, 10.06, 9.95, 100.0, 100.4])) for i in range(80)]
    frame = spark.createDataFrame([(*a[:5], a[5]) for a in amounts + amounts[:9]], "attr_id long, doc_stem string, entity string, attr_name string, unit string, amount double")
    got = {tuple(r) for r in unitjoin.agreeing_pairs(frame, ["doc_stem", "entity", "attr_name"]).collect()}
    want = {(a[0], b[0]) for a in amounts for b in amounts if a[0] < b[0] and a[2] is not None and a[2] == b[2] and a[4] != b[4] and abs(a[5] - b[5]) <= 0.005 * (1 + 1e-9) * max(abs(a[5]), abs(b[5]))}
    assert got == want


HUGE = ["9" * 5000, "9" * 400 + " mm", "1/" + "9" * 400, "9" * 310 + "/7 mm", "1e400 mm", "3 x 10^999999999 mm", "0e99999999 mm", "1e-999 mm", "9" * 300 + "." + "9" * 300 + " km", "1.7e308 km", "Infinity mm", "NaN", "1" * 200_000, "(" * 50_000, "7 " * 50_000]


def test_no_record_stops_the_queries(spark):
    t = dt.datetime(2024, 1, 1)
    keys = ["length", "price", "pack quantity", "finish", "rohs", "wavelength in " + "x" * 100_000, "l" * 300_000, "length (" * 20_000]
    data = [(n * 100 + k, "d", f"e{n}", key, value, "mm", t, t, None) for n, value in enumerate(HUGE) for k, key in enumerate(keys)]
    frame, defs = spark.createDataFrame(data, SCHEMA), spark.createDataFrame(DEFS, DEF_SCHEMA)
    rows = {r["entity"]: r for r in widetable.wide_table(spark, frame, defs).collect()}
    assert rows["e0"]["length"] is None and rows["e0"]["pack_qty"] is None and rows["e6"]["length"] == 0.0 and rows["e7"]["length"] == 0.0
    assert rows["e9"]["length"] is None and rows["e10"]["length"] is None and rows["e14"]["finish"].startswith("7 7 ")
    amounts = unitjoin.measured_attributes(spark, frame, defs)
    assert all(math.isfinite(r["amount"]) for r in amounts.collect())
    odd = spark.createDataFrame([(1, "g", "mm", float("inf")), (2, "g", "cm", float("inf")), (3, "g", "m", float("nan")), (4, "g", "m", None), (5, "g", "m", 5e-324), (6, "g", "cm", 5e-324), (7, "g", "m", 1.7e308), (8, "g", "km", 1.7e308)], "attr_id long, g string, unit string, amount double")
    assert {tuple(r) for r in unitjoin.agreeing_pairs(odd, ["g"]).collect()} == {(5, 6), (7, 8)}


@pytest.mark.parametrize("text, want", [("9007199254740993", 2**53 + 1), ("9,223,372,036,854,775,807", 2**63 - 1), ("9223372036854775808", None), ("9" * 5000, None), ("0" * 40 + "12 pcs", 12), ("250.000", 250)])
def test_whole_numbers_are_exact_up_to_bigint(text, want):
    assert whole_number(text) == want and read_record(D, "pack quantity", text, None)[5] == want


@given(st.text(alphabet="0123456789.,/-+eEx^ ×10mmincNaN½", max_size=400), st.sampled_from(["length", "price", "pack quantity", "wavelength"]))
@settings(max_examples=300, deadline=None)
def test_any_text_gives_a_finite_number_or_none(value, key):
    got = read_record(D, key, value, "mm")
    assert got[1] is None or math.isfinite(got[1])
    assert got[5] is None or -(2**63) <= got[5] < 2**63


def test_whole_numbers_keep_all_digits_in_the_table(spark):
    t = dt.datetime(2024, 1, 1)
    data = [(1, "d", "a", "pack quantity", "9007199254740993", None, t, t, None), (2, "d", "b", "pack quantity", None, None, t, t, None)]
    out = widetable.wide_table(spark, spark.createDataFrame(data, SCHEMA), spark.createDataFrame(DEFS, DEF_SCHEMA)).collect()
    assert [(r["entity"], r["pack_qty"]) for r in out] == [("a", 2**53 + 1)]


def test_store_takes_late_and_repeated_batches(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, n)
    row = lambda i, value, said, came: (i, "d", "e", "length", value, "mm", day(said), day(came), None)
    batches = [[row(1, "5", 3, 3)], [row(2, "7", 5, 6)], [row(3, "6", 4, 9)], [row(2, "7", 5, 6)], []]
    store = widetable.CellStore(spark, str(tmp_path / "cells"), D)
    assert store.wide().count() == 0 and store.compact() is None
    seen = []
    for n, batch in enumerate(batches):
        store.apply(spark.createDataFrame(batch, SCHEMA))
        if n == 2:
            store.compact()
            assert len(store.runs()) == 1
        seen.append([r["length"] for r in store.wide().collect()])
    assert seen == [[5.0], [7.0], [7.0], [7.0], [7.0]]
    # a compaction that ended before it deleted its runs
    store.write(widetable.compact(store.read(store.runs()), D, widetable.ENTITY))
    assert [r["length"] for r in store.wide().collect()] == [7.0]
    whole = widetable.wide_table(spark, spark.createDataFrame([r for b in batches for r in b], SCHEMA), spark.createDataFrame(DEFS, DEF_SCHEMA))
    assert [r.asDict() for r in whole.collect()] == [r.asDict() for r in store.wide().collect()]


def test_repeated_values_of_one_unit_meet_no_one(spark):
    rows = [(n, "g", "mm", 10.0) for n in range(3000)] + [(5000, "g", "cm", 10.04), (5001, "g", "cm", 10.2), (5002, "h", "cm", 10.0)]
    pairs = unitjoin.agreeing_pairs(spark.createDataFrame(rows, "attr_id long, g string, unit string, amount double"), ["g"])
    assert pairs.count() == 3000 and {r[1] for r in pairs.collect()} == {5000}
