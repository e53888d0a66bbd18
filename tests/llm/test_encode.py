import random

import pytest
import tiktoken

from folioforge.llm import encode as E


@pytest.fixture(scope="module")
def v():
    return E.Vocabulary(E.vocabulary_path())


@pytest.fixture(scope="module")
def reference(v):
    return tiktoken.Encoding("own", pat_str=E.PATTERN, mergeable_ranks=v.ranks, special_tokens={})


PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "é", "日本", "1", "22", "'s", "!", "...", "<|endoftext|>", "　", "ß", "🔩", "'ll", "\t", "xx", "สวัสดี"]


def test_any_chunking_gives_the_same_ids(v, reference, monkeypatch):
    monkeypatch.setattr(E, "WINDOW", 64)
    monkeypatch.setattr(E, "MEMO_LENGTH", 8)
    monkeypatch.setattr(E, "SETTLE", 16)
    rng = random.Random(4)
    for _ in range(600):
        text = "".join(rng.choice(PARTS) * rng.choice([1, 1, 1, 2, 40]) for _ in range(rng.randint(0, 40)))
        chunks, at = [], 0
        while at < len(text):
            n = rng.randint(1, 30)
            chunks.append(text[at : at + n])
            at += n
        ids = list(E.encode_stream(v, chunks))
        assert ids == reference.encode_ordinary(text) and "".join(E.decode_stream(v, ids)) == text


def test_memory_stays_bounded_in_a_long_word(v, reference):
    rng, most = random.Random(5), 0
    text = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    prefixes, ids = E.Prefixes(v), []
    for i in range(0, len(text), 500):
        ids += prefixes.feed(text[i : i + 500].encode())
        most = max(most, len(prefixes.back))
    assert ids + prefixes.close() == reference.encode_ordinary(text) and most < 20 * v.lookahead


def test_defined_results(v):
    assert E.encode(v, None) == [] and E.encode(v, "") == [] and E.encode(v, " ") == [220]
    assert 50256 not in E.encode(v, "<|endoftext|>")
    assert "".join(E.decode_stream(v, E.encode(v, "é")[:1])) in ("é", "�")


def test_documents(spark, reference, tmp_path):
    rows = [(1, "a <|endoftext|> b", "clash"), (2, None, None), (3, "", None), (4, " \n", None), (5, "a <|endoftext|> b", None), (6, "x" * 40_000, None)]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r["doc_id"]: r["ids"] for r in E.document_ids(spark, str(tmp_path)).collect()}
    assert out == {i: reference.encode_ordinary(t) if t else [] for i, t, _ in rows}
    assert all(r["exact"] for r in E.document_round_trip(spark, str(tmp_path)).collect())
