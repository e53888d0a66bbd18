from folioforge.plans import table_queries as Q

BLOCK = "doc_stem string, id string, page int, type string, source_type string, text string, bbox array<double>, block_order int, heading_level int, chunk_id string"


def test_codes_of_the_rows_of_table_blocks(spark, tmp_path):
    texts = {
        "own": "<table><tr><th>Part No.</th><th>Stock No.</th><th>x</th></tr><tr><td>M1</td><td>S1</td><td>S1/A</td></tr></table>",
        "new": "<table><tr><th>Item #</th><th>$</th><th>p</th><th>q</th></tr><tr><td>NEW</td><td>AB12</td><td>$ 5</td><td>z</td></tr></table>",
        "spill": "<table><tr><th>SKU</th><th></th></tr><tr><td>AB12</td><td>AB13</td></tr></table>",
        "down": "| Size | Order Code |\n|---|---|\n| 4 | Q7 |\n| 5 | see |",
        "raw": "AB12 stands in prose",
    }
    rows = [("d", k, 1, "table", "table", v, None, n, None, None) for n, (k, v) in enumerate(texts.items())]
    spark.createDataFrame(rows + rows[:1] + [("d", "p", 1, "paragraph", "text", texts["down"], None, 9, None, None)], BLOCK).write.parquet(f"{tmp_path}/semantic_blocks.parquet")
    got = {(r["id"], r["row_no"]): (r["codes"], r["spilled"]) for r in Q.queries()["q53_table_row_codes"](spark, str(tmp_path)).collect()}
    assert got == {("own", 0): ("S1,S1/A", ""), ("new", 0): ("AB12", ""), ("spill", 0): ("AB12", "AB13"), ("down", 0): ("Q7", ""), ("down", 1): ("", ""), ("raw", 0): ("", "")}


def test_records_of_all_replies(spark, tmp_path):
    raw = [
        """```json
{"products": [{"name": " A ", "sku": "null"}, {"name": ""}, {"name": "B", "sku": "S"}], "attributes": [{"entity": "A", "key": "k", "value": "1", "unit": "none"}, {"entity": "A", "key": "k"}], "relations": [{"subject": "A", "predicate": "likes", "object": "B"}, {"subject": "A", "predicate": "is_variant_of", "object": "B"}]}
```""",
        "{'products': [{'name': 'C'},]}", '{"products": 3, "attributes": 2}', '{"products": [{"name": "D"', None,
    ]
    rows = [(n, "d", f"c{n}", 1, v, "x", 0.5, None) for n, v in enumerate(raw)]
    schema = "run_id bigint, doc_stem string, chunk_id string, attempt int, raw_response string, backend_used string, latency_s double, parse_error string"
    spark.createDataFrame(rows + rows[:2], schema).write.parquet(f"{tmp_path}/extraction_runs.parquet")
    got = lambda n, *c: sorted(tuple(r[k] for k in ("run_id", "place", *c)) for r in Q.queries()[n](spark, str(tmp_path)).collect())
    assert got("q54_reply_products", "name", "sku") == [(0, 0, "A", None), (0, 2, "B", "S"), (1, 0, "C", None)]
    assert got("q55_reply_attributes", "entity", "key", "value", "unit") == [(0, 0, "A", "k", "1", None)]
    assert got("q56_reply_relations", "subject", "predicate", "object") == [(0, 0, "A", "HAS_ATTRIBUTE", "B"), (0, 1, "A", "IS_VARIANT_OF", "B")]
