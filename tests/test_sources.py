import json

import pytest
from pyspark.sql import functions as F

from folioforge.sources import ocr_json, sinks
from folioforge.streaming import ingest


def test_document_shapes(spark, tmp_path):
    docs = {
        "a_1_res.json": {"page_index": 2, "parsing_res_list": [{"block_label": "Text ", "block_content": "x\r\ny", "block_bbox": [1, 2, 3, 4]}]},
        "b.json": {"layoutParsingResults": [{"page_index": 0, "prunedResult": {"boxes": [{"block_label": "table", "block_bbox": [1, 2, 3, 4], "confidence": 0.5, "block_order": 7}]}}, {"page": 9, "blocks": [{"bbox": [1, 1, 5, 1, 5, 5, 1, 5], "text": "t", "scores": [0.2, 0.4]}, {"text": "no box"}]}]},
        "c.json": [{"boxes": []}, {"boxes": [{"bbox": [0, 0, 1, 1], "markdown": {"text": "m"}}]}],
    }
    (tmp_path / "sub").mkdir()
    for name, doc in docs.items():
        (tmp_path / "sub" / name).write_text(json.dumps(doc))
    (tmp_path / "bad.json").write_text("{")
    raw = ocr_json.read_documents(spark, str(tmp_path))
    assert raw.count() == 4 and {r["root_type"] for r in ocr_json.inspect(raw).collect()} == {"object", "array", "invalid"}
    pages = ocr_json.page_records(raw)
    assert sorted((r["doc_stem"], r["page"]) for r in pages.collect()) == [("a", 3), ("b", 1), ("b", 9), ("c", 1), ("c", 2)]
    blocks = {(r["doc_stem"], r["page"]): r for r in ocr_json.page_candidates(pages).collect()}
    assert blocks["a", 3]["text"] == "x\ny" and blocks["a", 3]["label"] == "text" and blocks["b", 1]["block_order"] == 7 and blocks["b", 1]["confidence"] == 0.5
    assert blocks["b", 9]["bbox"] == [1, 1, 5, 5] and abs(blocks["b", 9]["confidence"] - 0.3) < 1e-9 and blocks["c", 2]["text"] == "m"
    assert ocr_json.find_files(spark, str(tmp_path)).count() == 4 and ocr_json.content_hashes(spark, str(tmp_path), "*.json").count() == 4
    want = spark.createDataFrame([("b.json",), ("z.json",)], "name string")
    assert [r["name"] for r in ocr_json.missing_files(spark, want, str(tmp_path)).collect()] == ["z.json"]


def test_publish_keeps_the_previous_result(spark, tmp_path):
    at = str(tmp_path / "out")
    df = spark.createDataFrame([("d", 1)], "doc_stem string, v int")
    sinks.publish(df, at)
    sinks.publish(df.selectExpr("doc_stem", "v + 1 as v"), at)
    assert spark.read.parquet(at).first()["v"] == 2 and spark.read.parquet(f"{at}.previous").first()["v"] == 1
    sinks.write_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 1


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    sample = spark.read.parquet("/root/testdata/sf0.001/ocr_pages.parquet")
    sample.limit(5).write.parquet(str(tmp_path / "in" / "one"))
    stream = ingest.page_stream(spark, str(tmp_path / "in" / "*"), sample.schema)
    first = ingest.run_available(ingest.typed_blocks(stream).drop("bbox"), str(tmp_path / "out"), str(tmp_path / "ck"))
    n = spark.read.parquet(str(tmp_path / "out")).count()
    assert n == ingest.typed_blocks(spark.read.parquet(str(tmp_path / "in" / "one"))).count() and ingest.progress(first)
    sample.limit(3).write.parquet(str(tmp_path / "in" / "two"))
    stream = ingest.page_stream(spark, str(tmp_path / "in" / "*"), sample.schema)
    ingest.run_available(ingest.typed_blocks(stream).drop("bbox"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() > n
    assert ingest.page_counts(sample).count() > 0


def test_blocks_are_found_anywhere_in_a_page(spark, tmp_path):
    deep = {"bbox": {"left_top": [1, 2], "right_bottom": [3, 4]}, "type": "Text", "text": "inner"}
    for _ in range(300):
        deep = {"x": [deep]}
    doc = {"page": 3, "sections": [{"cells": [{"box": [0, 0, 2, 2], "label": "table"}, {"box": [], "label": "none"}, {"label": "no box"}]}, deep, {"bbox": [1, 1, 5, 1, 5, 5, 1, 5], "content": "poly", "inner": {"coordinate": {"bbox": [5, 6, 7, 8]}, "name": "nested"}}]}
    (tmp_path / "w.json").write_text(json.dumps(doc))
    pages = ocr_json.page_records(ocr_json.read_documents(spark, str(tmp_path)))
    out = ocr_json.walked_candidates(pages).orderBy("block_order").collect()
    assert [(r["page"], r["text"], r["bbox"]) for r in out] == [(3, "table", [0, 0, 2, 2]), (3, "inner", [1, 2, 3, 4]), (3, "poly", [1, 1, 5, 5]), (3, "nested", [5, 6, 7, 8])]
    assert out[0]["source_ref"] == "$.sections[0].cells[0]" and out[0]["label"] == "table"


def test_missing_files_stop_the_run(spark, tmp_path):
    (tmp_path / "a.pdf").write_text("x")
    ocr_json.require_files(spark, spark.createDataFrame([("a.pdf",)], "name string"), str(tmp_path))
    with pytest.raises(FileNotFoundError, match="b.pdf, c.pdf"):
        ocr_json.require_files(spark, spark.createDataFrame([("a.pdf",), ("c.pdf",), ("b.pdf",)], "name string"), str(tmp_path))


def test_a_failed_run_leaves_the_result_and_its_state(spark, tmp_path):
    at = str(tmp_path / "out")
    df = spark.createDataFrame([("d", 1)], "doc_stem string, v int")
    sinks.publish(df, at)
    with pytest.raises(Exception, match="no such"):
        sinks.publish(df.select("doc_stem", F.raise_error(F.lit("no such value")).cast("int").alias("v")), at)
    assert spark.read.parquet(at).first()["v"] == 1
    assert sorted(r["state"] for r in sinks.last_status(spark, at).collect()) == ["complete", "failed"]
    assert not [p for p in tmp_path.iterdir() if "staged" in p.name or "aside" in p.name]


def test_saved_extractions_are_reused_where_chunks_are_the_same(spark):
    schema = "doc_stem string, chunk_id string, place int"
    saved = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "1", 1), ("b", "2", 2), ("c", "1", 1)], schema).withColumn("reply", F.lit("x"))
    asked = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("a", "2", 2), ("b", "2", 1), ("b", "1", 2), ("c", "1", 1), ("c", "2", 2)], schema)
    assert {r["doc_stem"] for r in sinks.reusable(saved, asked).collect()} == {"a"}


def test_recognition_results_belong_to_their_pages(spark):
    pages = spark.createDataFrame([("d", n, f"img{n}") for n in range(7)], "doc_stem string, page int, payload string").repartition(2)
    out = ingest.recognized(pages, lambda xs: [x.upper() for x in xs], "string", batch=2)
    assert {(r["page"], r["result"]) for r in out.collect()} == {(n, f"IMG{n}") for n in range(7)}
    with pytest.raises(Exception, match="1 results for 2 pages"):
        ingest.recognized(pages, lambda xs: xs[:1], "string", batch=2).collect()


def test_published_catalogs_are_loaded(spark, tmp_path):
    from folioforge.operators.catalog import Catalog

    (tmp_path / "products").mkdir()
    (tmp_path / "attributes").mkdir()
    (tmp_path / "products" / "a.json").write_text('{"product_id": 1, "doc_stem": "d", "name": "Valve", "sku": "V1", "other": 5}\n{broken\n')
    (tmp_path / "attributes" / "a.json").write_text('{"attr_id": 1, "doc_stem": "d", "entity": "V1", "key": "Bore", "value": "3"}\n')
    store = Catalog.load(spark, str(tmp_path))
    assert store.health() == {"status": "ok", "catalogs": 1} and store.search("d", "valve").count() == 1
