import pytest

from folioforge.operators import catalog, graph, normalize, quality

P = "product_id long, run_id long, doc_stem string, chunk_id string, name string, model string, sku string, category string, description string, variant_group string, extra int"
A = "attr_id long, run_id long, doc_stem string, chunk_id string, entity string, key string, value string, unit string, location string"


def products(spark, *rows):
    full = [(n, 1, "d", f"d__p{n}__c001__part1", name, model, sku, cat, desc, group, 0) for n, (name, model, sku, cat, desc, group) in enumerate(rows, 1)]
    return spark.createDataFrame(full, P)


SOME = (("Ball  Valve", None, " S1 ", "Valves > Ball", "a", "g2"), ("Other", "M1", "S1", None, "a b", "g1"), ("Ball Valve", None, "S2", "Pipes", None, "g1"), ("Free", "M2", None, None, "x", None), ("Free", "M2", "", "C", "y", None), (None, None, None, None, None, None))


def test_merge_keeps_the_first_value_and_folds_descriptions(spark):
    out = {(r["kind"], r["ident"]): r for r in normalize.merge_products(products(spark, *SOME)).collect()}
    s1, free = out["sku", "S1"], out["name", "Free\x1fM2"]
    assert (s1["name"], s1["model"], s1["category"], s1["description"], s1["chunks"]) == ("Ball Valve", "M1", "Valves > Ball", "a b", 2)
    assert free["description"] == "x\n\ny" and free["category"] == "C" and len(out) == 3


def test_components_link_groups_by_codes(spark):
    rows = [("n", None, f"s{i}", None, None, f"g{i}") for i in range(6)] + [("n", None, f"s{i}", None, None, f"g{i + 1}") for i in range(5) if i != 2] + [("n", None, "s9", None, None, None)]
    out = {r["variant_group"]: r["root"] for r in normalize.variant_components(products(spark, *rows)).collect()}
    assert out == {"g0": "g0", "g1": "g0", "g2": "g0", "g3": "g3", "g4": "g3", "g5": "g3"}
    assert normalize.variant_components(products(spark)).count() == 0


def test_owner_by_code_before_unique_name(spark):
    attrs = spark.createDataFrame([(1, 1, "d", "c", "S1", "k", "v", None, None), (2, 1, "d", "c", "ball valve", "k", "v", None, None), (3, 1, "d", "c", "other", "k", "v", None, None), (4, 1, "d", "c", None, "k", "v", None, None), (5, 1, "d", "c", "gone", "k", "v", None, None)], A)
    out = {r["attr_id"]: r["owner_ident"] for r in normalize.resolve_owner(attrs, products(spark, *SOME)).collect()}
    assert out == {1: "S1", 2: None, 3: "S1", 4: None, 5: None}


def test_attribute_conflicts_are_marked(spark):
    attrs = spark.createDataFrame([(1, 1, "d", "c", "S", "wall thickness", "5 mm", "in", None), (2, 1, "d", "c", "S", "thread size", "5 mm", None, None), (3, 1, "d", "c", "S", "bore", "3/8 in", "Inch", None)], A)
    out = {r["attr_id"]: (r["key_norm"], r["value_norm"], r["unit_norm"], r["conflict"]) for r in normalize.normalized_attributes(attrs).collect()}
    assert out == {1: ("Wall Thickness", "5.0", "in", True), 2: ("Thread Size", "5 mm", None, False), 3: ("Bore", "0.375", "in", False)}


def test_tree_and_back(spark):
    items = catalog.catalog_items(products(spark, *SOME))
    assert {(r["depth"], r["path"]): r["items"] for r in catalog.category_nodes(items).collect()}[1, "d > Valves"] == 1
    assert catalog.flatten_tree(catalog.catalog_tree(items)).count() == items.count()


def test_read_access(spark):
    c = catalog.Catalog(products(spark, *SOME), spark.createDataFrame([], A))
    assert c.search("d", " BALL ").count() == 2 and c.search("d", "").count() == 6 and c.health()["catalogs"] == 1
    with pytest.raises(LookupError):
        c.catalog("none")


def test_graph_is_the_same_twice(spark):
    p = products(spark, *SOME)
    a = spark.createDataFrame([(1, 1, "d", "c", "S1", "k", "v", None, None)], A)
    runs = spark.createDataFrame([("d", "d__p1__c001__part1"), ("d", "d__p1__c001__part1")], "doc_stem string, chunk_id string")
    nodes = graph.nodes(p, a, runs)
    assert nodes.count() == nodes.select("id").distinct().count() and {r["label"] for r in nodes.collect()} == {"Document", "Section", "Product", "Category", "Attribute"}
    edges = graph.edges(p, a, runs, graph.product_relations(p)).collect()
    assert {r["rel"] for r in edges} == {"HAS_SECTION", "CONTAINS", "BELONGS_TO", "HAS_ATTRIBUTE", "IS_VARIANT_OF"} and all(r["src"] != r["dst"] for r in edges)


def test_rules(spark):
    p = products(spark, ("A", None, "s1", "c1", None, None), ("B", "316 Stainless Steel", "S1", "c2", None, None), ("\u0001\u0002", "m", None, None, None, None), ("B", "316 Stainless Steel", "s2", "c3", None, None), (" ", None, "s2", None, None, None))
    found = {(r["rule"], r["record_id"]) for r in quality.product_issues(p).unionByName(quality.duplicate_codes(p)).collect()}
    assert {("SHORT_NAME", 1), ("MATERIAL_IS_NOT_MODEL", 2), ("GARBAGE_TEXT", 3), ("MISSING_SKU", 3), ("DUPLICATE_SKU", 2), ("DUPLICATE_SKU", 5), ("SCHEMA_ERROR", 5)} <= found
    assert [(r["rule"], r["choices"]) for r in quality.code_conflicts(p).collect()] == [("MULTIPLE_MODEL_CATEGORIES", 2)]
    a = spark.createDataFrame([(1, 1, "d", "d__p1__c001__part1", "a", "k", "v", None, None), (2, 1, "d", "d__p9__c001__part1", "B", "k", "v", None, None), (3, 1, "d", "c", None, "k", "x" * 501, None, None)], A)
    assert {r["record_id"] for r in quality.orphaned_attributes(a, p).collect()} == {1, 3}
    assert {r["record_id"] for r in quality.orphaned_attributes(a, p, "chunk").collect()} == {2, 3}
    assert {r["record_id"] for r in quality.ambiguous_owners(a, p).collect()} == {2}


def test_upsert_and_sample(spark):
    a = spark.createDataFrame([("k1", "old"), ("k2", None)], "k string, v string")
    b = spark.createDataFrame([("k2", "new"), ("k3", "n3")], "k string, v string")
    assert {(r["k"], r["v"], r["origin"]) for r in normalize.upsert(b, a, ["k"], ["v"]).collect()} == {("k1", "old", "kept"), ("k2", "new", "merged"), ("k3", "n3", "added")}
    df = spark.createDataFrame([("g", f"x{i}") for i in range(50)] + [("h", "y")], "g string, k string")
    first = {tuple(r) for r in normalize.seeded_sample(df, "g", "k", 3, 1).collect()}
    assert len(first) == 4 and first == {tuple(r) for r in normalize.seeded_sample(df.repartition(7), "g", "k", 3, 1).collect()}
