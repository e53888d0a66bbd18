from folioforge.operators import evidence as E
from folioforge.operators import replies as R
from folioforge.operators import tables as T


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("r")).first()["r"]


def test_spans_headers_and_distinct_rows():
    html = '<table><tr><th rowspan=2>Item #</th><th colspan="2">Size</th></tr><tr><th>mm</th><th>mm</th></tr><tr><td rowspan="2">A1</td><td>5</td><td>6</td></tr><tr><td>5</td><td>6</td></tr><tr><td>B</td><td>7<br>8</td></tr></table>'
    rows = T.html_rows(html)
    assert rows[0] == (["Item #", "Size / mm", "Size / mm [3]"], ["A1", "5", "6"]) and rows[1][1] == ["B", "7 8", ""] and len(rows) == 2


def test_headers_at_the_bottom_and_beside():
    html = "<table><tr><td>A1</td><td>5.00</td></tr><tr><td>Item #</td><td>Price Each</td></tr><tr><td></td><td>1-4</td></tr></table>"
    assert T.html_rows(html) == [(["Item #", "Price Each"], ["A1", "5.00"]), (["Item #", "Price Each"], ["", "1-4"])]
    html = "<table><tr><td>A1</td><td>5.00</td></tr><tr><td>Item #</td><td>Price</td></tr><tr><td></td><td>Price 1-4</td></tr></table>"
    assert T.html_rows(html) == [(["Item #", "Price / Price 1-4"], ["A1", "5.00"])]
    assert T.html_rows("<table></table>") == [] and T.html_rows(None) == [] and T.html_rows("<table><tr><td colspan='x'>a") == [(["col_0"], ["a"])]


def test_markdown(spark):
    text = "before\n| a | b |\n|---|:-:|\n| 1 |\n|  | |\n| 2 | 3 | 4 |\nafter\n| c |"
    rows = one(spark, text, T.markdown_rows("x"))
    assert [(r["headers"], r["cells"]) for r in rows] == [(["a", "b"], ["1", ""]), (["a", "b"], ["2", "3"])]
    assert all(one(spark, v, T.markdown_rows("x")) is None for v in ("| a |", "no", "", None, "| a |\n|---|"))


def test_cascade(spark):
    rows = [("d", "h", "<TABLE><tr><td>1</td></tr></TABLE>"), ("d", "m", "| a |\n| 1 |"), ("d", "r", " plain "), ("d", "b", "  "), ("d", "n", None), ("d", "e", "<table></table>")]
    out = {r["id"]: (r["method"], r["cells"]) for r in T.table_rows(spark.createDataFrame(rows, "doc_stem string, id string, text string")).collect()}
    assert out == {"h": ("html", ["1"]), "m": ("markdown", ["1"]), "r": ("raw", ["plain"]), "e": ("raw", ["<table></table>"])}


def codes(spark, headers, cells, f=T.row_codes):
    return spark.createDataFrame([(headers, cells)], "h array<string>, c array<string>").select(f("h", "c").alias("r")).first()["r"]


def test_row_codes(spark):
    assert codes(spark, ["Part No.", "Stock No.", "x"], ["M1", "S1", "S1/A"]) == ["S1", "S1/A"]
    assert codes(spark, ["SKU", "x"], ["See", "y"]) == [] and codes(spark, ["SKU", "x"], ["Item #", "y"]) == []
    assert codes(spark, ["Item #", "$", "p", "q"], ["NEW", "AB12", "$ 5", "z"]) == ["AB12"]
    assert codes(spark, ["SKU", "col_1", "col_2"], ["AB12", "AB13", "CD14"], T.spilled_codes) == ["AB13"]
    model = spark.createDataFrame([(["A", "Model No. X-1"],)], "p array<string>").select(T.heading_model("p").alias("r")).first()["r"]
    assert model == "X-1"


def test_inline_pairs(spark):
    got = lambda h, c: [tuple(r) for r in codes(spark, h, c, T.inline_pairs)]
    assert got(["a", "b"], ["1456N251 $3.85 1456N252 none 1456N253 12.50", "x"]) == [("1456N251", "3.85", "USD"), ("1456N253", "12.50", None)]
    assert got(["a", "b", "c"], ["1456N251", "€ 1,003.85", "1456N252"]) == [("1456N251", "1,003.85", "EUR")]
    assert got(["a", "b"], ["1456N251", "each 3.85"]) == [] and got(["a", "b"], ["X1456N251 3.85", None]) == []
    # another column's code is the maker's where there is a code column
    assert got(["SKU", "Mfr"], ["1456N251 3.85", "1456N299 4.85"]) == [("1456N251", "3.85", None)]


def test_codes_by_content(spark):
    rows = [("d", "t", "markdown", n, ["dox87201j", "214 mm", "$ 334.81"], c) for n, c in enumerate([["cuv85123e", "122.1 mm", "$ 85.71"], ["xen64094m", "M8", "-"], ["see page", "1", "€ 1,000.00"]])]
    rows += [("d", "named", "html", 0, ["SKU", "x"], ["AB12", "cuv85123e"]), ("d", "raw", "raw", 0, ["raw_text"], ["cuv85123e"])]
    frame = spark.createDataFrame(rows, "doc_stem string, id string, method string, row_no int, headers array<string>, cells array<string>")
    assert {tuple(r)[1:] for r in T.table_codes(frame).collect()} == {("t", -1, "dox87201j"), ("t", 0, "cuv85123e"), ("t", 1, "xen64094m"), ("named", 0, "AB12")}
    assert {tuple(r)[1:] for r in T.content_prices(frame).collect()} == {("t", 0, "cuv85123e", "85.71", "USD")}
    assert T.table_codes(frame.where("false")).count() == 0


def test_windows_and_pieces(spark):
    w = one(spark, "a" * 6000, E.windows("x"))
    assert [(r["offset"], len(r["text"])) for r in w] == [(0, 3000), (2800, 3000), (5600, 400)]
    assert [(r["offset"], r["text"]) for r in one(spark, "", E.windows("x"))] == [(0, "")]
    assert one(spark, "aa\nbb\ncccccccc\nd", E.dense_pieces("x", 6)) == ["aa\nbb\n", "cccccccc\n", "d"]


def test_pack(spark):
    rows = [("d", "c", 1, n, f"b{n:02d}", 0, s, dense) for n, (s, dense) in enumerate([(3000, False), (3000, False), (10, False), (20, True), (5, False)] + [(1, False)] * 9)] + [("d", "e", 1, 0, "z", 0, 1, False)]
    out = E.pack(spark.createDataFrame(rows, "doc_stem string, chunk_id string, page int, block_order int, id string, part int, size int, dense boolean")).collect()
    assert [r["pack"] for r in sorted(out, key=lambda r: (r["chunk_id"], r["id"]))] == [1, 1, 2, 3, 4, 4, 4, 4, 4, 4, 4, 4, 5, 5, 1]


def test_fragments_of_long_rows(spark):
    row = spark.createDataFrame([(["a", "b", "c"], ["x" * 50, "y" * 40, "z" * 10])], "h array<string>, c array<string>").select(E.fragments("h", "c", max_chars=80, size=60, step=50).alias("f")).first()["f"]
    assert [[(c["column"], c["offset"]) for c in part] for part in row][0] == [("a", 0)] and {c["column"] for part in row for c in part} == {"a", "b", "c"}


def test_replies(spark):
    raw = ['<think>{x}</think>```json\n{"products": [{"name": " A ", "sku": "null"}, {"name": ""}], "attributes": [{"entity": "A", "key": "k", "value": "1"}], "relations": [{"subject": "A", "predicate": "likes", "object": "B"}]}```', "{'products': [],}", "nothing", '{"products": [', None, '{"products": 3}']
    df = spark.createDataFrame([("d", "c", n, r, "x") for n, r in enumerate(raw)], "doc_stem string, chunk_id string, run_id int, raw_response string, extra string")
    assert [r["s"] for r in df.orderBy("run_id").select(R.reply_state("raw_response").alias("s")).collect()] == ["parsed", "repaired", "no_object", "no_object", "no_object", "parsed"]
    out = R.reply_records(df)
    assert [(r["name"], r["sku"]) for r in out["products"].collect()] == [("A", None)]
    assert out["attributes"].count() == 1 and out["relations"].first()["predicate"] == "HAS_ATTRIBUTE"


def test_backend_and_retries(spark):
    reqs = spark.createDataFrame([("r1", "d", "c", "good"), ("r2", "d", "c", "bad")], "request_id string, doc_stem string, chunk_id string, context string")
    def shaky(contexts):
        return contexts.map(lambda c: "{}" if c == "good" else "?")
    out = R.run_with_retries(reqs, shaky, retries=2).collect()
    assert sorted((r["request_id"], r["attempt"]) for r in out) == [("r1", 1), ("r2", 1), ("r2", 2), ("r2", 3)]
    assert R.run_backend(reqs).count() == 2
