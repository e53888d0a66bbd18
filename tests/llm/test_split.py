import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import split as S


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .\n。é‍", max_size=900), st.integers(20, 90), st.integers(0, 9))
def test_pieces_cover_the_text(text, limit, overlap):
    spans = S.bisect(text, limit, overlap)
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(e - s <= limit for s, e in spans)
    assert all(b[0] == max(0, a[1] - overlap) and b[1] > a[1] for a, b in zip(spans, spans[1:]))
    assert (len(spans) == 1) == (len(text) <= limit)


def test_strongest_boundary_near_the_middle():
    text = "a" * 40 + ". " + "b" * 10 + "\n\n" + "c" * 45
    (_, first), _ = S.bisect(text, 70, 0)
    assert text[:first].endswith("\n\n")
    assert S.bisect("x" * 100, 60, 10) and S.bisect("", 60, 10) == [(0, 0)]
    with pytest.raises(ValueError):
        S.bisect("x", 10, 5)


def test_long_texts_stay_whole():
    rng = random.Random(1)
    text = "".join(rng.choice(["word ", "sentence. ", "\n\n", "字。"]) for _ in range(60_000))
    spans = S.bisect(text)
    assert text == "".join(text[s if i == 0 else s + S.OVERLAP : e] for i, (s, e) in enumerate(spans)) and max(e - s for s, e in spans) <= S.LIMIT


def test_blocks(spark):
    schema = "doc_stem string, id string, chunk_id string, page int, block_order int, text string, piece string"
    rows = [("d", "a", "c1", 1, 0, "x. " * 1500, "clash"), ("d", "b", "c1", 1, 1, "y " * 2000, None), ("d", "n", None, None, None, "z" * 3001, None), ("d", "s", "c1", 1, 2, "z" * 3000, None), ("d", "e", "c1", 1, 3, None, None)]
    out = S.oversized_pieces(spark.createDataFrame(rows + rows[:1], schema)).collect()
    assert {r["id"] for r in out} == {"a", "b", "n"} and sorted(r["part_id"] for r in out if r["id"] in "ab") == ["c1__part1", "c1__part2", "c1__part3", "c1__part4"]
    assert all(r["part_id"] is None and r["pieces"] == 2 for r in out if r["id"] == "n")
    assert S.oversized_pieces(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("length", [5480, 5590, 5599, 5600])
def test_boundaries_count_when_two_pieces_just_fit(length):
    at = length // 2 - 600
    text = "a" * (at - 2) + "\n\n" + "word " * ((length - at) // 5)
    text += "b" * (length - len(text))
    spans = S.bisect(text)
    assert spans[0] == (0, at) and len(spans) == 3 and all(e - s <= S.LIMIT for s, e in spans)
    # without any boundary there is no piece more
    assert len(S.bisect("x" * length)) == 2
