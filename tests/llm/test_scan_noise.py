import random

from folioforge.llm import scan_noise as S

SCHEMA = "source_table string, doc_stem string, id string, page int, label string, text string, extra int"
WORDS = "tighten the mounting plate before each bearing moves along some inspection window where reflections need special instruments minutes and housing".split()


def corpus(rng, docs=6, blocks=40):
    rows = []
    for d in range(docs):
        for n in range(blocks):
            text = " ".join(rng.choice(WORDS) for _ in range(20)).capitalize() + "."
            lines = [text[i : i + 40] for i in range(0, 0, 40)] or [text]
            rows.append(["t", f"d{d}", f"b{n}", n // 8 + 1, "text", "\n".join(lines), 0])
        rows.append(["t", f"d{d}", "head", 1, "header", f"Acme Selection Guide vol{d}x", 0])
        rows.append(["t", f"d{d}", "num", 1, "number", "– 1 –", 0])
    return rows


def items(spark, rows):
    got, *_ = S.scan_findings(spark.createDataFrame([tuple(r) for r in rows], SCHEMA))
    return {(r["doc_stem"], r["id"], r["noise"]) for r in got.collect()}


def test_each_kind_and_no_false_ones(spark):
    rows = corpus(random.Random(1))
    rows += [
        ["t", "d0", "x1", 4, "text", "Tighten the mount-\ning plate before each bearing moves.", 0],
        ["t", "d0", "x2", 4, "text", "Tighten the inspecfion window and the housinq.", 0],
        ["t", "d0", "x3", 4, "text", "Tighten the mounting plate before\nACME Se1ection Guide vol0x   4\neach bearing moves.", 0],
        ["t", "d0", "x4", 4, "text", "Tighten the mounting plate before\n\n4\n\neach bearing moves.", 0],
        ["t", "d0", "ok1", 4, "text", "Sizes from 2-\n14 mm and codes FYR1199643S and insp3ct10n_99.", 0],
        ["t", "d0", "ok2", 4, "text", "Page 95 lists the mounting plate, pre-\nand post-mounted.", 0],
        ["t", "d0", "ok3", 4, "text", "12\n4\n17", 0],
        ["t", "d0", "ok4", 4, "text", "| housinq |\n| 4 |\n| x |", 0],
        ["t", "d0", "ok5", 4, "paragraph_title", "Special Mounting", 0],
        ["t", "d0", "ok6", 4, "text", "x" * 20_000, 0],
    ]
    found = {x for x in items(spark, rows) if x[1].startswith(("x", "ok"))}
    assert found == {("d0", "x1", "broken_word"), ("d0", "x2", "misread"), ("d0", "x3", "running_line"), ("d0", "x3", "page_number"), ("d0", "x4", "page_number")}


def test_repaired_text(spark):
    rows = corpus(random.Random(2)) + [["t", "d0", "x", 4, "text", "Tighten the mount-\n\nAcme Selection Guide vol0x   4\n\ning plate before each\nbearlng moves along the inspecfion window.", 0]]
    out = {(r["doc_stem"], r["id"]): r["repaired"] for r in S.repair_blocks(spark.createDataFrame([tuple(r) for r in rows], SCHEMA)).collect()}
    assert out["d0", "x"] == "Tighten the mounting plate before each bearing moves along the inspection window."
    assert out["d0", "head"] == "" and out["d0", "num"] == ""


def test_running_lines_of_any_form(spark):
    heads = ["Industrial Fittings 2024", "industrial fittings catalog", "Acme Industrial Co.", "工业阀门产品目录", "A very long head line of a catalog that goes on and on over more than ninety letters and more than ten words", "Katalog"]
    rows = corpus(random.Random(5))
    rows += [["t", f"h{k}", f"head{p}", p, "header", head, 0] for k, head in enumerate(heads) for p in (1, 2, 3)]
    rows += [["t", f"h{k}", f"in{p}", p, "text", f"Tighten the mounting plate before\n{head}\neach bearing moves.", 0] for k, head in enumerate(heads) for p in (4, 5)]
    rows += [["t", "h9", f"alone{p}", p, "text", "Precision Works Handbook", 0] for p in (1, 2, 3)] + [["t", "h9", f"title{p}", p, "paragraph_title", "Special Mounting Plates", 0] for p in (1, 2, 3)]
    found = {x[:2] for x in items(spark, rows) if x[2] == "running_line"}
    want = {(f"h{k}", f"{w}{p}") for k in range(len(heads)) for w, ps in (("head", (1, 2, 3)), ("in", (4, 5))) for p in ps} | {("h9", f"alone{p}") for p in (1, 2, 3)}
    assert {x for x in found if x[0].startswith("h")} == want


def test_page_numbers_by_their_place(spark):
    rows = corpus(random.Random(6))
    for p in (3, 12, 47, 110, 205, 12345):
        rows += [["t", "a", f"en{p}", p, "text", f"Page {p} of 34000", 0], ["t", "b", f"zh{p}", p, "text", f"第 {p} 页", 0], ["t", "c", f"big{p}", p, "number", str(p), 0]]
        rows += [["t", "d", f"in{p}", p, "text", f"Tighten the mounting plate before\n~ {p} ~ Catalog\neach bearing moves.", 0]]
        rows += [["t", "e", f"no{p}{q}", p, "text", f"Travel {q} mm", 0] for q in (3, 12, 47, 110)]
    found = {x[:2] for x in items(spark, rows) if x[2] == "page_number"}
    assert {x for x in found if x[0] in "abcde"} == {(d, f"{n}{p}") for d, n in (("a", "en"), ("b", "zh"), ("c", "big"), ("d", "in")) for p in (3, 12, 47, 110, 205, 12345)}


def test_tables_beside_text(spark):
    text = "Tighten the inspecfion window.\n" + "Tighten the mounting plate before each bearing moves.\n" * 120 + "<table><tr><td>housinq</td></tr>\n<tr><td>4</td></tr></table>\nTighten the housinq."
    assert S.prose(text).count("\n") == text.count("\n") and "<" not in S.prose(text) and S.prose(text).endswith("Tighten the housinq.")
    assert S.prose("a\n| x | y |\n| 1 | 2 |\nb") == "a\n\n\nb" and S.prose("<td>x</td>") == "" and S.prose("a | b") == "a | b"
    rows = corpus(random.Random(7)) + [["t", "d0", "x", 4, "text", text, 0]]
    out = {(r["doc_stem"], r["id"]): r["repaired"] for r in S.repair_blocks(spark.createDataFrame([tuple(r) for r in rows], SCHEMA)).collect()}["d0", "x"]
    assert out.startswith("Tighten the inspection window. Tighten") and "<td>housinq</td></tr>\n<tr><td>4</td>" in out and out.endswith("Tighten the housing.")


def test_hyphens_and_repairs_by_line(spark):
    rows = corpus(random.Random(8)) + [["t", "d0", f"k{n}", 2, "text", w, 0] for n, w in enumerate(["The post and the mounted plate.", "The remount and the mounting plate.", "re and mount"] * 3)]
    rows += [["t", "d0", "x", 4, "text", "The post-\nmounted plate moves along the re-\nmount. Tighten the insp-\necfion window.", 0]]
    out = {(r["doc_stem"], r["id"]): r["repaired"] for r in S.repair_blocks(spark.createDataFrame([tuple(r) for r in rows], SCHEMA)).collect()}
    assert out["d0", "x"] == "The post-mounted plate moves along the remount. Tighten the inspection window."
    fix = [(0, "hal1", "hall"), (2, "hal1", "hail")]
    assert S.rebuild("A hal1 with wide open doors\nand\na hal1 of stones came down.", 1, None, [], fix, []) == "A hall with wide open doors and a hail of stones came down."


def test_context_chooses_by_exact_counts(spark):
    words = spark.createDataFrame([("hall", 50, 0), ("hail", 60, 0), ("ha1l", 1, 0)], "word string, n long, joined_n long")
    pairs = spark.createDataFrame([("long", "hall", 7), ("hail", "storm", 9)], "before string, after string, n long")
    suspects = spark.createDataFrame([("t", "d", "b", 0, "ha1l", "long", "way", None, None), ("t", "d", "b", 1, "ha1l", None, "storm", None, None), ("t", "d", "b", 2, "ha1l", None, None, None, None)], "source_table string, doc_stem string, id string, line int, token string, before string, after string, fold string, whole string")
    running = spark.createDataFrame([], "key string")
    got = {r["line"]: r["real"] for r in S.best_repairs(suspects, S.repair_table(words), pairs, words, running).collect()}
    assert got == {0: "hall", 1: "hail", 2: "hail"}


def test_filters_never_miss(spark):
    keys = [f"key {i} ü" for i in range(2000)]
    both = S.sieves_of(full=spark.createDataFrame([(k,) for k in keys], "k string"), none=spark.createDataFrame([], "k string"))
    sieve = both["full"]
    assert all(k in sieve for k in keys) and sum(f"other {i}" in sieve for i in range(2000)) < 60
    assert "x" not in both["none"] and both["none"].empty and not sieve.empty


def test_costs_and_index():
    assert S.scan_cost("machined", "machiried") == S.CONFUSION_COST and S.scan_cost("door", "cloor") == S.CONFUSION_COST
    assert S.scan_cost("plate", "plates") > S.MAX_COST and S.scan_cost("bearing", "hearinq") == 2 * S.CONFUSION_COST
    assert set(S.deletions("mount")) & set(S.deletions("rnount"))


def test_empty_table(spark):
    assert items(spark, []) == set()


def test_candidates_by_index_equal_brute_force(spark):
    rng = random.Random(3)
    words = {w: 500 for w in set(WORDS) if len(w) > 3}
    for w in list(words):
        for real, seen in S.CONFUSIONS:
            if real in w and rng.random() < 0.5:
                words.setdefault(w.replace(real, seen, 1), 1)
    got = {(r["seen"], r["real"]) for r in S.repair_table(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    want = {(a, b) for a, n in words.items() for b, m in words.items() if a != b and b.isalpha() and m >= 3 and m >= (S.RATIO if a.isalpha() else S.RATIO_ODD) * n and S.scan_cost(b, a) <= S.MAX_COST}
    assert got <= want and len(got) >= 0.98 * len(want)
    assert set(S.deletions("summing")) & set(S.deletions("surnrning")) and set(S.deletions("window")) & set(S.deletions("vvinclovv"))
