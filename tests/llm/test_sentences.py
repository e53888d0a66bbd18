import random

import pytest

from folioforge.llm import sentences as S

CASES = [
    ("One. Two!  Three?", ["One.", "Two!", "Three?"]),
    ("Clearance is 2.76 mm, i.e. less than the groove allows. Ratings follow the U.S. and E.U. editions.", ["Clearance is 2.76 mm, i.e. less than the groove allows.", "Ratings follow the U.S. and E.U. editions."]),
    ("“Is it clean?” is the first question. Part D.64.X fits.", ["“Is it clean?” is the first question.", "Part D.64.X fits."]),
    ("A running line\nthat goes on. Next\none.", ["A running line\nthat goes on.", "Next\none."]),
    ("Head\n\n1. First item\n2. Second item\n\nBore: 5 mm\nMass: 3 kg", ["Head", "1. First item", "2. Second item", "Bore: 5 mm", "Mass: 3 kg"]),
    ("切勿打开！内有导轨。请锁紧", ["切勿打开！", "内有导轨。", "请锁紧"]),
    ("दबाव में न खोलें! साफ़ करें। ठीक", ["दबाव में न खोलें!", "साफ़ करें।", "ठीक"]),
    ("(See this.) Then go.", ["(See this.)", "Then go."]),
]


@pytest.fixture(scope="module")
def model():
    items = [f"{a} {b}{c}" for a in ("Ratings follow the U.S. and E.U. editions of", "Clearance is 2 mm, i.e. less than", "“Is it clean?” is the question on", "Orders close at 4 p.m. on", "Part D.6.X fits") for b in ("table", "the groove", "weekdays", "every plate") for c in (".", "!", "?")]
    items += [f"{a}{b}" for a in ("ห้ามเปิดวาล์ว", "โปรดทำความสะอาดข้อต่อ", "ช่องว่างต้องไม่เกิน 5 มม. เมื่อประกอบ") for b in ("ขณะมีแรงดัน", "ก่อนติดตั้ง", "แล้ว")]
    return S.Model().train(S.strung(items))


@pytest.mark.parametrize("text, want", CASES)
def test_units(model, text, want):
    assert [text[a:b] for a, b in S.unit_spans(model, text)] == want


def test_blank_ended_scripts(model):
    text = "ห้ามเปิดวาล์วขณะมีแรงดัน โปรดทำความสะอาดข้อต่อก่อนติดตั้ง ช่องว่างต้องไม่เกิน 7 มม. เมื่อประกอบแล้ว"
    assert [text[a:b] for a, b in S.unit_spans(model, text)] == ["ห้ามเปิดวาล์วขณะมีแรงดัน", "โปรดทำความสะอาดข้อต่อก่อนติดตั้ง", "ช่องว่างต้องไม่เกิน 7 มม. เมื่อประกอบแล้ว"]


def test_no_units_and_long_texts(model):
    assert all(S.unit_spans(model, t) == [] for t in (None, "", " \n\t　"))
    assert len(S.unit_spans(model, "It goes on. " * 20_000)) == 20_000


def test_units_cover_all_but_white_space(model):
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["Word ", "a.", " ", "\n", "\n\n", "1. ", "“", "”", "。", "Key: 5\n", "- ", "ก ", "\r\n", "! ", "(", ")"]) for _ in range(rng.randint(0, 40)))
        spans = S.unit_spans(model, text)
        assert all(a < b for a, b in spans) and all(p[1] <= q[0] for p, q in zip(spans, spans[1:]))
        left = "".join(text[b:a] for (_, b), (a, _) in zip([(0, 0), *spans], [*spans, (len(text), 0)]))
        assert not left.strip(S._TRIM)


def test_viterbi_equals_the_best_of_all_taggings():
    rng = random.Random(6)
    m = S.Model({}, {S.Model.step(a, b, g): rng.uniform(-2, 2) for a in (0, 1) for b in (0, 1) for g in range(0, 40, 6)})
    for _ in range(50):
        spots = [(p, i) for i, p in enumerate(sorted(rng.sample(range(60), 7)))]
        values = [rng.uniform(-2, 2) for _ in spots]
        def total(tags):
            s = sum(v for v, t in zip(values, tags) if t)
            return s + sum(m.steps.get(m.step(tags[k - 1], tags[k], spots[k][0] - spots[k - 1][0]), 0.0) for k in range(1, 7))
        best = max(([(n >> k) & 1 for k in range(7)] for n in range(128)), key=total)
        assert total(m.viterbi(spots, lambda d: values[d])) == pytest.approx(total(best))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = sorted(r[0] for r in S.list_items(docs).collect())
    random.Random(9).shuffle(items)
    cut = len(items) * 4 // 5
    m, wrong, all_ = S.Model().train(S.strung(items[:cut])), 0, 0
    for spots, gold in S.strung(items[cut:]):
        wrong += sum(a != b for a, b in zip(m.viterbi(spots), gold))
        all_ += len(gold)
    assert all_ > 100 and wrong <= 0.02 * all_


def test_documents(spark):
    schema = "doc_id long, text string, unit string"
    rows = [(1, "One. Two.", "clash"), (2, None, None), (3, " ", None), (4, "One. Two.", None)]
    out = S.split_documents(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["doc_id"], r["end_pos"]) for r in out) == [(1, 4), (1, 9), (4, 4), (4, 9)]
    assert S.split_documents(spark.createDataFrame([], schema)).count() == 0


def test_training_does_not_depend_on_the_order_of_items():
    items = [f"{a} {b}." for a in ("Ratings follow the U.S. editions of", "Clearance is 2 mm, i.e. less than", "Orders close at 4 p.m. on") for b in ("table", "the groove", "weekdays")]
    mixed = items[::-1] + items[:3]
    one, other = S.Model().train(S.strung(items)), S.Model().train(S.strung(mixed))
    assert one.weights == other.weights and one.steps == other.steps
