import json
import random
import re

import pytest

from folioforge.operators import evidence as E
from folioforge.operators import tables as T

SCHEMA = "doc_stem string, chunk_id string, page int, block_order int, id string, type string, text string"


def brute(blocks):
    """Contexts of the chunks, by lists: records in order of types, long rows in fragments, then greedy packs."""
    size = lambda x: len(json.dumps(x, ensure_ascii=False))
    out = {}
    for key in sorted({b[:2] for b in blocks}):
        records, before = [], None
        for kind, bucket in (("specification", "specifications"), ("product_card", "product_cards"), ("paragraph", "paragraphs"), ("table", "tables")):
            for _, _, page, order, id_, _, text in sorted({b for b in blocks if b[:2] == key and b[5] == kind}, key=lambda b: (b[2], b[3], b[4])):
                base = {"block_id": id_, "page": page, "kind": bucket}
                if kind == "table":
                    if "<table" in text:
                        rows = [dict(zip(k, c)) for k, c in T.html_rows(text)]
                        headers = [] if all(re.fullmatch(r"col_\d+", k) for k in rows[0]) else list(rows[0])
                    else:
                        lines = [[v.strip() for v in x.strip().strip("|").split("|")] for x in text.split("\n") if "|" in x and "--" not in x]
                        headers, rows = (lines[0], [dict(zip(lines[0], x)) for x in lines[1:]]) if lines else ([], [])
                    if rows:
                        if before and not headers and page == before[0] + 1:
                            base |= {"possible_continuation_of": before[1], "previous_headers": before[2]}
                        before = (page, id_, headers)
                        records += [base | {"headers": headers, "row": r} for r in rows]
                        continue
                if len(re.findall(r"\d{4,5}[A-Z]\d{2,4}", text)) >= 20 and "\n" in text:
                    piece, at = "", 0
                    for line in text.splitlines(keepends=True):
                        if piece and len(piece) + len(line) > 700:
                            records.append(base | {"text": piece, "offset": at, "dense_text": True})
                            piece, at = "", at + len(piece)
                        piece += line
                    records.append(base | {"text": piece, "offset": at, "dense_text": True})
                else:
                    records += [base | {"text": text[s : s + 3000], "offset": s} for s in range(0, max(1, len(text)), 2800)]
        packs = []
        for r in (x for r in records for x in ([r] if size(r) <= 6000 else E.row_fragments(r))):
            g = packs[-1] if packs else None
            if not g or sum(map(size, g)) + size(r) > 6000 or len(g) >= 8 or "dense_text" in r or any("dense_text" in x for x in g):
                packs.append([])
            packs[-1].append(r)
        for n, g in enumerate(packs, 1):
            out[f"{key[1]}__part{n}"] = {"continuation": n, "parts": len(packs), "evidence": g}
    return out


def made(spark, rows):
    return {r["request_id"]: json.loads(r["context"]) for r in E.requests(E.packed_evidence(E.evidence_records(spark.createDataFrame(rows, SCHEMA)))).collect()}


def test_requests_hold_all_types(spark):
    rng, rows = random.Random(3), []
    dense = "\n".join(f"{1000 + n}A{100 + n} item {'x' * 60}" for n in range(40))
    for n in range(120):
        kind = rng.choice(["specification", "product_card", "paragraph", "table", "table"])
        cells = [[rng.choice(["a b", "9", '"q"', "字"]) for _ in range(3)] for _ in range(rng.randint(1, 12))]
        text = rng.choice(["short", "", "w. " * rng.randint(1, 3000), dense])
        if kind == "table":
            text = rng.choice(["plain", "| a | b | c |\n|--|--|--|\n" + "\n".join(f"| {' | '.join(x)} |" for x in cells), f"<table>{''.join('<tr>' + ''.join(f'<td>{v}{i}</td>' for v in x) + '</tr>' for i, x in enumerate(cells))}</table>", f"<table><tr><td>{'k' * 3100}</td><td>{'m' * 2900}</td><td>z</td></tr></table>"])
        rows.append(("d", f"c{rng.randint(1, 8)}", rng.randint(1, 3), n, f"b{n:03d}", kind, text))
    extra = [("d", "c9", 1, 0, "h", "heading", "no"), ("d", None, 1, 1, "n", "table", "| a |\n| 1 |"), ("d", "c9", 1, 2, "t", "table", None)]
    want = brute(rows)
    assert made(spark, rows + rows[:20] + extra) == want
    assert {r["kind"] for x in want.values() for r in x["evidence"]} == set(E.BUCKETS) and any("cell_offsets" in r for x in want.values() for r in x["evidence"]) and any("possible_continuation_of" in r for x in want.values() for r in x["evidence"])


def test_nothing_beside_a_table_is_lost(spark):
    text = "Torque in Nm\n| a | a |\n|--|--|\n| 1 | 2 | 3 |\nsee page 4"
    html = "<p>Before</p><table><tr><td>1</td></tr></table><table><tr><td>2</td></tr></table>"
    (one,) = made(spark, [("d", "c", 1, 0, "m", "table", text), ("d", "c", 1, 1, "x", "table", html), ("d", "c", None, 0, "u", "unknown", "loose")]).values()
    assert [x.get("row") or x["text"] for x in one["evidence"]] == ["loose", "Torque in Nm\n", {"a": "1", "a [2]": "2", "col_2": "3"}, "see page 4", "<p>Before</p>", {"col_0": "1"}, "<table><tr><td>2</td></tr></table>"]
    assert all(text[x["offset"] :].startswith(x["text"]) for x in one["evidence"] if x["block_id"] == "m" and "text" in x)


def test_long_rows_are_whole():
    row = {"a": "x" * 7000, "b": "code", "c": "y" * 2000, "d": "\x01" * 3000, "e": ""}
    for headers in (["a", "b"], ["h" * 7000]):
        parts = E.row_fragments({"block_id": "b", "page": 1, "kind": "tables", "headers": headers, "row": row})
        assert all(len(json.dumps(x, ensure_ascii=False)) <= 6000 for x in parts)
        for c, v in row.items():
            got = [None] * len(v)
            for x in parts:
                if c in x["row"]:
                    s = x["cell_offsets"][c]
                    got[s : s + len(x["row"][c])] = x["row"][c]
            assert "".join(got) == v and any(c in x["row"] for x in parts)
    with pytest.raises(ValueError):
        E.row_fragments({"block_id": "b", "row": {"k" * 7000: "v"}})
    long_line = "\n".join(["1000A100 " * 30, "z" * 9000])
    pieces = E.text_pieces({"block_id": "b"}, long_line)
    assert all(len(json.dumps(x)) <= 6000 and long_line[x["offset"] :].startswith(x["text"]) for x in pieces) and max(x["offset"] + len(x["text"]) for x in pieces) == len(long_line)
