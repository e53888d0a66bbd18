import random

from pyspark.sql import functions as F

from folioforge.operators import layout as L
from folioforge.operators import outline as O

BLOCK = "doc_stem string, id string, page int, type string, source_type string, text string, bbox array<double>, block_order int, heading_level int, extra string"


def block(doc, id_, page, kind, source, text, bbox, order, level=None):
    return (doc, id_, page, kind, source, text, bbox, order, level, "x")


def types(spark, rows):
    return [r["t"] for r in spark.createDataFrame(rows, "i int, s string, x string").orderBy("i").select(L.semantic_type("s", "x").alias("t")).collect()]


def test_types_by_label_then_text(spark):
    rows = [(1, " Paragraph_Title ", "x"), (2, "table", None), (3, "image", ""), (4, "text", "# Head"), (5, "text", "Bore: 5 mm\nLength: 3 mm"), (6, "text", "mount A-100\n5 mm x 3 mm\n$ 5.00"), (7, "header", "run"), (8, None, None), (9, "vision_footnote", "x")]
    assert types(spark, rows) == ["heading", "table", "figure", "heading", "specification", "product_card", "paragraph", "paragraph", "specification"]


def test_heading_levels(spark):
    rows = [(1, "text", "### a"), (2, "paragraph_title", "2.1.3 Valves"), (3, "paragraph_title", "Features"), (4, "doc_title", "Long"), (5, "paragraph_title", "Valves"), (6, "text", "a b c"), (7, "text", "one two three four five six seven"), (8, "text", None), (9, "text", "1.1.1.1.1.1.1.1 Deep")]
    out = spark.createDataFrame(rows, "i int, s string, x string").orderBy("i").select(L.heading_level("s", "x").alias("l")).collect()
    assert [r["l"] for r in out] == [3, 3, 3, 1, 2, 2, 3, 3, 6]


def test_boxes(spark):
    rows = [([1.0, 2.0, 3.0, 4.0],), ([5.0, 1.0, 9.0, 2.0, 8.0, 7.0, 4.0, 6.0],), ([1.0],), (None,)]
    out = [r["b"] for r in spark.createDataFrame(rows, "b array<double>").select(L.box("b").alias("b")).collect()]
    assert out == [[1, 2, 3, 4], [4, 1, 9, 7], None, None]


def test_scores_by_tiers(spark):
    blocks = spark.createDataFrame([("d", "a", 1, [10.0, 10.0, 50.0, 50.0]), ("d", "b", 1, [100.0, 100.0, 150.0, 150.0]), ("d", "c", 1, [300.0, 300.0, 350.0, 350.0]), ("d", "n", 1, None)], "doc_stem string, id string, page int, bbox array<double>")
    boxes = spark.createDataFrame([("d", 1, 0, 0.9, [12.0, 12.0, 48.0, 48.0]), ("d", 1, 1, 0.5, [10.4, 9.6, 50.0, 50.2]), ("d", 1, 2, 0.7, [102.9, 97.1, 152.9, 147.2]), ("d", 2, 0, 0.1, [300.0, 300.0, 350.0, 350.0])], "doc_stem string, page int, rank int, score double, box array<double>")
    out = {r["id"]: r["confidence"] for r in L.join_scores(blocks, boxes).collect()}
    assert out == {"a": 0.5, "b": 0.7, "c": None, "n": None}


def test_section_paths_against_a_stack(spark):
    rng, rows, want = random.Random(4), [], {}
    for d in ("x", "y"):
        stack = []
        for n in range(80):
            level = rng.choice([1, 1, 2, 2, 3, 4, 5, 9])
            head = rng.random() < 0.5
            id_ = f"b{n:03d}"
            rows.append(block(d, id_, n // 7, "heading" if head else "paragraph", "text", "t", None, n % 7, level))
            if head:
                level = min(level, 6)
                stack = [s for s in stack if s[0] < level] + [(level, id_)]
            want[d, id_] = [s[1] for s in stack]
    rng.shuffle(rows)
    out = O.section_paths(spark.createDataFrame(rows, BLOCK)).collect()
    assert {(r["doc_stem"], r["id"]): r["path"] for r in out} == want


def test_container_dies_after_a_far_block_and_at_the_page_end(spark):
    card = [0.0, 0.0, 100.0, 50.0]
    rows = [block("d", "c", 1, "product_card", "text", "t", card, 0), block("d", "near", 1, "paragraph", "text", "t", [0.0, 60.0, 90.0, 80.0], 1), block("d", "far", 1, "paragraph", "text", "t", [0.0, 900.0, 90.0, 920.0], 2), block("d", "late", 1, "paragraph", "text", "t", [0.0, 70.0, 90.0, 90.0], 3), block("d", "next", 2, "paragraph", "text", "t", [0.0, 60.0, 90.0, 80.0], 0), block("d", "h", 1, "heading", "text", "t", [0.0, 60.0, 90.0, 80.0], 4)]
    out = {r["id"]: r["container"] for r in O.attach_to_containers(spark.createDataFrame(rows, BLOCK)).collect()}
    assert out == {"c": None, "near": "c", "far": None, "late": None, "next": None, "h": None}


def test_chunks_begin_at_new_headings_only(spark):
    texts = [("paragraph", "x"), ("heading", "A"), ("paragraph", "x"), ("heading", "a "), ("heading", "B"), ("paragraph", None), ("heading", "A")]
    rows = [block("d", f"b{n}", n // 2, k, "text", t, None, n % 2) for n, (k, t) in enumerate(texts)] + [block("d", "f", 0, "paragraph", "footer", "x", None, 9)]
    out = {r["id"]: r["chunk_no"] for r in O.chunks(spark.createDataFrame(rows, BLOCK)).collect()}
    assert [out[f"b{n}"] for n in range(7)] == [0, 1, 1, 1, 2, 2, 3] and "f" not in out


def test_page_roles(spark):
    rows = [
        block("d", "a", 1, "heading", "doc_title", "Catalog 2024", None, 0), block("d", "b", 2, "heading", "doc_title", "Index", None, 0), block("d", "c", 2, "paragraph", "text", "Valves ..... 12\nPipes ..... 14", None, 1),
        block("d", "e", 3, "heading", "doc_title", "Valves", None, 0), block("d", "f", 4, "product_card", "text", "x", None, 0), block("d", "g", 5, "paragraph", "text", "words", None, 0), block("d", "h", 6, "heading", "text", "Contents", None, 0), block("d", "i", 6, "specification", "text", "a: b", None, 1),
    ]
    out = {r["page"]: r["role"] for r in O.page_roles(spark.createDataFrame(rows, BLOCK)).collect()}
    assert out == {1: "cover", 2: "index", 3: "section_divider", 4: "product", 5: "uncertain", 6: "mixed"}
    entry = spark.createDataFrame([("Valves ..... 12\nno\nPipes    14",)], "x string").select(O.index_entries(F.col("x")).alias("e")).first()["e"]
    assert [(e["title"], e["printed_page"]) for e in entry] == [("Valves", 12), ("Pipes", 14)]


def test_dynamic_levels(spark):
    wide, narrow = [0.0, 0.0, 100.0, 10.0], [0.0, 60.0, 50.0, 70.0]
    rows = [block("d", "a", 1, "heading", "paragraph_title", "Ball Valves", wide, 0, 2), block("d", "b", 1, "heading", "paragraph_title", "Valves", narrow, 1, 2), block("d", "c", 1, "heading", "paragraph_title", "Features", None, 2, 2), block("d", "e", 1, "heading", "paragraph_title", "Features", None, 3, 2), block("d", "z", 1, "paragraph", "text", "x" * 600, None, 4), block("d", "f", 2, "paragraph", "text", "x", None, 0), block("d", "g", 2, "heading", "paragraph_title", "Pipes", wide, 1, 2)]
    b = spark.createDataFrame(rows, BLOCK)
    out = {r["id"]: r for r in O.dynamic_sections(b).collect()}
    assert [out[k]["level"] for k in "abceg"] == [2, 3, 4, 4, 2]
    assert out["f"]["section_path"] == ["Ball Valves", "Valves", "Features"] and out["e"]["chunk_no"] == out["c"]["chunk_no"] == out["f"]["chunk_no"]


def test_markdown_lines_and_images(spark):
    text = "# A\nx\ny\n\nz\n| a | b |\n| 1 | 2 |\n- i\n- j"
    out = spark.createDataFrame([(text,)], "x string").select(L.markdown_blocks("x").alias("m")).first()["m"]
    assert [(b["kind"], b["text"]) for b in out] == [("heading", "# A"), ("paragraph", "x\ny"), ("paragraph", "z"), ("table", "| a | b |\n| 1 | 2 |"), ("list", "- i"), ("list", "- j")]
    row = spark.createDataFrame([(["a", " ", "c"], [1, 2], [0.5])], "t array<string>, b array<int>, s array<double>").select(L.zipped_lines("t", "b", "s").alias("z")).first()["z"]
    assert [(r["text"], r["box"], r["score"]) for r in row] == [("a", 1, 0.5), ("c", None, None)]
