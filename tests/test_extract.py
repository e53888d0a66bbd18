import pytest
from pyspark.errors import PySparkException

from folioforge.operators import extract as X
from folioforge.operators import outline as O
from folioforge.operators import quality as Q

ROWS = "doc_stem string, id string, method string, row_no int, headers array<string>, cells array<string>, section_path array<string>, extra int"


def read(spark, *rows):
    return X.read_rows(spark.createDataFrame([("d", i, "html", n, h, c, p, 0) for i, n, h, c, p in rows], ROWS))


def test_rows_are_read_explicitly_inline_or_not(spark):
    path = ["Valves", "Model No. VX-9"]
    got = read(
        spark,
        ("a", 0, ["Part No.", "Description", "Bore", "USD", "Price"], ["AB12", "Ball valve", "3 mm", "$1,204.50", "call"], path),
        ("a", 1, ["Part No.", "Model", "x"], ["AB13", "M7", ""], path),
        ("b", 0, ["x", "Description"], ["1456N251 3.85", "Elbow"], path),
        ("b", 1, ["x", "y"], ["1456N252", "€ 9.00"], []),
        ("c", 0, ["x", "y"], ["words", None], path),
    ).cache()
    assert {(r["id"], r["row_no"]): r["way"] for r in got.collect()} == {("a", 0): "explicit", ("a", 1): "explicit", ("b", 0): "inline", ("b", 1): "inline", ("c", 0): "unresolved"}
    products = {r["sku"]: r for r in X.row_products(got).collect()}
    assert {k: (r["name"], r["model"], r["category"]) for k, r in products.items()} == {
        "AB12": ("Ball valve", "VX-9", "Valves > Model No. VX-9"), "AB13": ("AB13", "M7", "Valves > Model No. VX-9"), "1456N251": ("Elbow", "VX-9", "Valves > Model No. VX-9"), "1456N252": ("Catalog item", None, None),
    }
    assert {(r["entity"], r["key"], r["value"], r["unit"]) for r in X.row_attributes(got).collect()} == {
        ("AB12", "Bore", "3 mm", None), ("AB12", "Price", "1204.50", "USD"), ("AB12", "Price", "call", None), ("1456N251", "Price", "3.85", None), ("1456N252", "Price", "9.00", "EUR"),
    }
    records = spark.createDataFrame([("d", "k", "a", 0), ("d", "k", "c", 0), ("d", "k2", "z", None)], "doc_stem string, chunk_id string, id string, row_no int")
    left = {(r["id"]): [tuple(a) for a in r["product_anchors"] or []] for r in X.hybrid_requests(records, got).collect()}
    assert left == {"c": [("AB12", "Ball valve")], "z": []}


def test_results_need_their_requests(spark):
    results = spark.createDataFrame([("a", 1), ("b", 2)], "chunk_id string, n int")
    requests = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "chunk_id string, context string")
    assert {(r["chunk_id"], r["request"]["context"]) for r in X.with_requests(results, requests).collect()} == {("a", "x"), ("b", "y")}
    with pytest.raises(PySparkException, match="no request for b"):
        X.with_requests(results, requests.where("chunk_id <> 'b'")).collect()
    chunks = spark.createDataFrame([("d", "k", "a", "t"), ("d", "k", "b", " u "), ("d", "k", "c", "")], "doc_stem string, chunk_id string, id string, text string")
    parsed = spark.createDataFrame([("d", "a", "html", 0, ["h"], ["v"])], "doc_stem string, id string, method string, row_no int, headers array<string>, cells array<string>")
    assert {(r["id"], r["method"], r["cells"][0]) for r in X.with_tables(chunks, parsed).collect()} == {("a", "html", "v"), ("b", "raw", "u")}


def test_native_pairs_and_supplement(spark):
    text = "1456N251 ..... $3.85 1456N252 none 1456N253 1 2 3.00 1456N254 ... " + "x" * 130 + " 9.00 1456N255 . . € 1,007.20"
    pages = spark.createDataFrame([("d", 1, text), ("d", 2, "1456N255 .. 5.00"), ("d", 3, None), ("e", 1, "AB12/X\nAB13 \n$ \n1,204.50\nx\nQQ12\n$\n3.00")], "doc_stem string, page int, text string")
    pairs = X.native_pairs(pages).cache()
    assert {(r["page"], r["sku"], r["price"], r["currency"]) for r in pairs.collect()} == {(1, "1456N251", "3.85", "USD"), (1, "1456N255", "1,007.20", "EUR"), (2, "1456N255", "5.00", None)}
    assert {(r["sku"], r["price"]) for r in X.stacked_pairs(pages).collect()} == {("AB12/X", "1,204.50"), ("AB13", "1,204.50"), ("QQ12", "3.00")}
    products = spark.createDataFrame([("d", " 1456N251 "), ("d", None)], "doc_stem string, sku string")
    evidence = spark.createDataFrame([("d", 1, 1, [], []), ("d", 1, 2, ["A"], []), ("d", 1, 3, ["B"], ["1456N255"])], "doc_stem string, page int, pos int, section_path array<string>, codes array<string>")
    assert [(r["sku"], r["page"], r["section_path"], r["grp"]) for r in X.supplement(pairs, products, evidence).collect()] == [("1456N255", 1, ["B"], 1)]
    failed = spark.createDataFrame([("d", "a", ["1456N251", "x"]), ("d", "b", ["$ 3.00", ""]), ("d", "c", ["1456N251", "1999N111"]), ("d", "e", None), ("d", "f", ["words"])], "doc_stem string, chunk_id string, cells array<string>")
    assert {(r["chunk_id"], r["code"]) for r in X.fragment_notes(failed, pairs).collect()} == {("a", "TABLE_FRAGMENT_RECOVERED_FROM_SOURCE"), ("b", "ORPHANED_PRICE_FRAGMENT")}


def test_items_need_support(spark):
    schema = "product_id long, doc_stem string, chunk_id string, name string, model string, sku string, section_path array<string>"
    p = spark.createDataFrame(
        [(1, "d", "c__part1", "The Ball Valves", None, None, ["Ball Valve Overview"]), (2, "d", "c", "Elbow", None, " ", ["Pipes"]), (3, "d", "c", "Nipple", None, None, None), (4, "d", "c", "Elbow", None, "E1", []), (5, "d", "c", "X", "AB1", "AB1", []), (6, "d", "c", "Y", "AB2", "AB2", []), (7, "d", "c", None, None, None, [])],
        schema,
    )
    rows = spark.createDataFrame([("d", "c", ["Description", "Price"], ["NIPPLE", "$ 3"]), ("d", "c", ["Model"], [" AB2 "])], "doc_stem string, chunk_id string, headers array<string>, cells array<string>")
    issues = Q.unsupported_items(p, rows).cache()
    assert {(r["record_id"], r["rule"]) for r in issues.collect()} == {(1, "HEADING_AS_PRODUCT"), (2, "UNSUPPORTED_SELLABLE_ITEM"), (7, "UNSUPPORTED_SELLABLE_ITEM")}
    texts = spark.createDataFrame([("d", "c", "Ask for model no. AB9, or AB1.")], "doc_stem string, chunk_id string, text string")
    models = Q.unconfirmed_models(p, rows, texts)
    assert {r["record_id"] for r in models.collect()} == {5}
    assert {r["product_id"]: r["model"] for r in Q.without_models(p, models).collect()} == {1: None, 2: None, 3: None, 4: None, 5: None, 6: "AB2", 7: None}
    a = spark.createDataFrame([(1, "d", "c__part1", "The Ball Valves"), (2, "d", "c", "Elbow"), (3, "d", "c", "other")], "attr_id long, doc_stem string, chunk_id string, entity string")
    kept, rest = Q.without_unsupported(p, a, issues)
    assert {r["product_id"] for r in kept.collect()} == {3, 4, 5, 6} and {r["attr_id"] for r in rest.collect()} == {2, 3}
    assert {(r["name"], r["rule"]) for r in Q.ignored_notes(p, issues).collect()} == {("The Ball Valves", "HEADING_FAMILY_IGNORED"), ("Elbow", "UNSUPPORTED_ITEM_IGNORED"), (None, "UNSUPPORTED_ITEM_IGNORED")}


def test_catalog_structure(spark):
    nodes = spark.createDataFrame([("d", "c", 1, "C", None), ("d", "s", 1, "S", None), ("d", "m", 2, "M", None), ("d", "i", 3, "I", None), ("d", "p", 4, "P", float("nan")), ("d", "i", 3, "I", -1.0), ("d", None, 3, "x", None)], "doc_stem string, identifier string, level int, title string, amount double")
    edges = spark.createDataFrame([("d", "c", "s"), ("d", "s", "m"), ("d", "m", "i"), ("d", "i", "m"), ("d", "gone", "p")], "doc_stem string, parent string, child string")
    assert sorted((r["record_id"] or "") for r in Q.structure_issues(nodes, edges).collect()) == ["", "i", "i", "m", "p", "p"]


def test_chunks_of_a_hierarchy(spark):
    from folioforge.operators import hierarchy as H

    rows = [("d", "r", 1, 0, "heading", "Top", None), ("d", "t", 1, 1, "table", "x", "r"), ("d", "c", 1, 2, "product_card", "x", "r"), ("d", "s", 1, 3, "specification", "x", "c"), ("d", "f", 1, 4, "figure", "x", "c"), ("d", "h", 1, 5, "heading", "Sub", "r"), ("d", "p", 1, 6, "paragraph", "x", "h"), ("d", "u", 2, 0, "table", "x", None), ("d", "v", 2, 1, "paragraph", "x", None)]
    blocks = spark.createDataFrame([(*r, None) for r in rows], "doc_stem string, id string, page int, block_order int, type string, text string, parent_id string, children_ids array<string>")
    out = {r["id"]: (r["chunk_no"], r["section_path"]) for r in O.hierarchy_chunks(blocks, H.hierarchy(blocks)).collect()}
    assert out == {"r": (1, ["Top"]), "t": (1, ["Top"]), "c": (1, ["Top"]), "s": (1, ["Top"]), "h": (2, ["Top", "Sub"]), "p": (2, ["Top", "Sub"]), "u": (3, ["(unlabelled)"])}
