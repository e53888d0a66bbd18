"""Sentence units across languages and scripts.

Lines and blank lines give the units of headings, lists and specifications. In running text every place that could end a
sentence is tagged boundary or inside by a linear-chain model (features of the place, weights of neighbouring tags) with
Viterbi decoding. The model is trained here, on list items of the same documents: each item is one unit, so items strung
together are labelled text, in which abbreviations, decimals and quotations stand inside. In scripts that end sentences
without punctuation the places are the blanks, learnt from the letters around them, on items stripped of punctuation.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.runtime import cut, table

#: Bound of the training sample: list items with the smallest hashes, of punctuated and of unpunctuated scripts each.
TRAINING_ITEMS = 12_000
#: Items shorter or longer than that are no training items (they are split like any other text).
ITEM_LENGTH = (8, 400)
#: Times the items are strung together anew, and passes over all that: many different neighbours make the outcome stable.
ARRANGEMENTS, EPOCHS = 8, 1
SEED = 11
#: Learning rate of the weights of neighbouring tags; small, so that the length of sentences seen decides ties only.
STEP_RATE = 0.1
MEMO = 300_000

# Signs that end sentences, signs that open and close quotations and brackets.
ENDS = ".!?…。！？．｡।॥؟۔‼⁇⁈⁉"
PAIRS = {"“": "”", "«": "»", "„": "“”", "「": "」", "『": "』", "（": "）", "(": ")", "[": "]", "【": "】", "《": "》", "‹": "›", "‚": "‘’", "‘": "’", '"': '"', "»": "«"}
CLOSERS = "”»」』）)]】》›\"’“"
#: Scripts that mark sentence ends by blanks only: Thai, Lao, Khmer, Burmese, Tibetan.
BLANK_ENDED = "฀-໿ༀ-࿿က-႟ក-៿"

SPACE = "\\s​﻿"
_BREAK = re.compile(rf"(?:\r\n|\r|\n| |\x85|\x0b)[{SPACE}]*?(?:\r\n|\r|\n| |\x85|\x0b)[{SPACE}]*| [{SPACE}]*|\x0c[{SPACE}]*")
_LINE = re.compile(r"\r\n|\r|\n| |\x85|\x0b")
_BULLET = re.compile(rf"[{SPACE}]*([-*•‣▪◦●○■□·–—►→✓]|\(?(\d{{1,3}})[.)．、]|\(?([a-zA-Z])[)]|[①-⑳])[{SPACE}]+(?=\S)")
_LISTED = re.compile(rf"(?:^|[\n\r\x85\x0b\x0c\u2028\u2029]){_BULLET.pattern}")
_SPEC = re.compile(rf"[{SPACE}]*[^\W\d_][^:：\n]{{0,38}}[:：][{SPACE}]*(?=\S)[^:：。！？]{{1,60}}$")
_VALUE = re.compile(rf"[{SPACE}]*(?:[≤≥<>~±+\-−]?[{SPACE}]*[\d.,]*\d|\S+(?:[{SPACE}]+\S+){{0,3}}$)")
_PLACE = re.compile(rf"([{re.escape(ENDS)}]+)((?:[{SPACE}]*[{re.escape(CLOSERS)}])*)")
_BLANK = re.compile(rf"(?<=[{BLANK_ENDED}\d.)\]”\"])[{SPACE}]+(?=[{BLANK_ENDED}\dA-Za-z(\[“\"])")
_HAS_BLANK_ENDED = re.compile(f"[{BLANK_ENDED}]")
_THIN = frozenset("\u200b\ufeff")
_OPENER = re.compile("[" + re.escape("".join(PAIRS)) + "]")
_GAP = re.compile(f"[{SPACE}]*")
_WORD = re.compile(r"\S+$")
_CAMEL = re.compile(r"[^\W\d_A-Z]{1,3}[A-Z]")
_NEXT = re.compile(r"[^\W\d_]+|\d+|\S")


def char_class(ch: str) -> str:
    if not ch:
        return "E"
    if ch.isdigit():
        return "D"
    if ch.isupper() or ch in "¡¿":
        return "U"
    if ch.islower():
        return "L"
    if ch in PAIRS and ch not in "’":
        return "O"
    code = ord(ch)
    if 0x3040 <= code <= 0x30FF:
        return "K"
    if 0x3400 <= code <= 0x9FFF or 0xF900 <= code <= 0xFAFF:
        return "H"
    return "A" if ch.isalpha() else "P"


def quote_spans(text: str) -> list[tuple[int, int]]:
    """Offsets of quotations and brackets that are closed again."""
    stack, spans = [], []
    for i, ch in enumerate(text):
        if stack and ch in PAIRS[stack[-1][1]]:
            spans.append((stack.pop()[0], i))
        elif ch in ")]）】」』»”" and stack and any(ch in PAIRS[c] for _, c in stack):
            while ch not in PAIRS[stack[-1][1]]:
                stack.pop()
            spans.append((stack.pop()[0], i))
        elif ch in PAIRS and not (ch in "’‘" and i and text[i - 1].isalnum()) and not (ch == "»" and not stack):
            if ch in "‘‚" and (i + 1 < len(text) and text[i + 1].isspace()):
                continue
            stack.append((i, ch))
    return spans


def places(text: str, skip: int = 0) -> list[tuple[int, tuple]]:
    """(end offset, description) of each place in a run of text that could end a sentence; skip: offset to begin at.

    The description holds sign, closers, depth of quotation, gap, class of what follows, the word before, what follows."""
    blank_ended = not text.isascii() and bool(_HAS_BLANK_ENDED.search(text))
    found = _PLACE.finditer(text, skip)
    first = next(found, None)
    if first is None and not blank_ended:
        return []
    spans = quote_spans(text) if _OPENER.search(text) else ()
    opened, closed = ([a for a, _ in spans], [b for _, b in spans]) if spans else ((), ())
    if len(spans) > 1:
        opened.sort()
        closed.sort()
    shuts, length = frozenset(closed), len(text)
    out = []
    for m in chain((first,), found) if first is not None else ():
        start, inner = m.span(1)
        end = inner
        if m.end() != inner:
            # closers must close something that is open here, else they open the next quotation
            for i in range(inner, m.end()):
                if text[i] in CLOSERS:
                    if i in shuts:
                        end = i + 1
                    else:
                        break
        on = end
        if on < length and (text[on].isspace() or text[on] in _THIN):
            on = _GAP.match(text, end).end()
        if on == length:
            continue
        gap, n, signs = on - end, text[on], m[1]
        before = text[start - 1] if start else ""
        if not gap and end == m.end() and signs == "." and not (before.islower() and (n.isupper() or n in PAIRS)):
            continue
        depth = max(0, bisect_left(opened, start) - bisect_left(closed, end)) if spans else 0
        w = "" if not start or before.isspace() else text[max(0, start - 24) : start].split()[-1]
        x = _NEXT.match(text, on)
        sep = "0" if not gap else "1" if gap == 1 and n != "\n" and text[end] == " " else "n" if _LINE.search(text, end, on) else "1" if gap == 1 else "2"
        kind = "U" if n.islower() and _CAMEL.match(text, on) else char_class(n)
        out.append((end, (signs[-1] if len(signs) == 1 else signs[:3], text[inner:end].replace(" ", ""), depth, sep, kind, w.casefold()[-14:], (x[0] if x else "").casefold()[:8], before)))
    if blank_ended:
        for m in _BLANK.finditer(text, skip):
            around = text[max(0, m.start() - 6) : m.start()] + text[m.end() : m.end() + 6]
            if not _HAS_BLANK_ENDED.search(around) or not text[skip : m.start()].strip("0123456789. "):
                continue
            depth = max(0, bisect_left(opened, m.start()) - bisect_left(closed, m.end()))
            out.append((m.start(), (" ", "", depth, "n" if _LINE.search(m[0]) else "1", char_class(text[m.end()]), text[max(0, m.start() - 5) : m.start()], text[m.end() : m.end() + 5], text[m.start() - 1])))
        best: dict[int, tuple] = {}
        for end, d in out:
            # an ending sign and the blank behind it are one place
            best.setdefault(end, d)
        out = sorted(best.items())
    return out


def features(d: tuple) -> list[str]:
    sign, closers, depth, sep, n, w, x, before = d
    q = "q" if depth else "o"
    if sign == " ":
        out = [f"b|{q}", f"bl|{w[-1:]}", f"br|{x[:1]}", f"bn|{n}|{char_class(before)}"]
        out += [f"bL{k}|{w[-k:]}" for k in (2, 3, 4, 5)] + [f"bR{k}|{x[:k]}" for k in (2, 3, 4, 5)]
        return out + [f"bx|{w[-2:]}|{x[:2]}", f"by|{w[-3:]}|{x[:3]}"]
    kind = f"{len(w)}" if len(w) < 4 else "4"
    shape = "d" if w[-1:].isdigit() else "p" if "." in w else "a"
    out = [
        f"s|{sign}|{q}", f"c|{sign}|{closers}|{n}", f"n|{sign}|{n}|{q}", f"g|{sign}|{sep}|{n}", f"w|{sign}|{w}", f"wn|{w}|{n}", f"x|{sign}|{closers}|{x}",
        f"k|{sign}|{kind}|{n}", f"h|{sign}|{shape}|{n}", f"cx|{closers}|{x[:2]}|{q}", f"cq|{closers}|{q}", f"wx|{w}|{x}",
    ]
    if n in "KH":
        out += [f"z|{sign}|{closers}|{x[:1]}", f"zb|{before}|{sign}|{x[:1]}"]
    return out


# Weights before training, so that little data still gives sensible units.
PRIOR = {
    **{f"s|{s}|o": 1.5 for s in "。！？．｡।॥؟۔!?"}, "s|.|o": 0.5, "s|…|o": -0.5, "s|...|o": -0.5, "s|……|o": -1.5, **{f"s|{s}|q": -4.0 for s in ENDS}, "b|o": -1.0, "b|q": -3.0,
    "n|.|U|o": 1.5, "n|.|L|o": -4.0, "n|!|L|o": -3.0, "n|?|L|o": -3.0, "n|.|P|o": -2.0, "n|!|P|o": -1.0, "n|?|P|o": -1.0, "n|.|D|o": -0.5, "n|.|O|o": 1.0, "n|…|L|o": -2.0, "n|...|L|o": -2.0,
    "k|.|1|U": -2.0, "k|.|1|D": -2.0, "h|.|p|U": -1.0, "h|.|d|L": -2.0, "h|.|d|U": -0.5, "cq|」|o": 2.5, "c|。|”|H": 2.0, "c|！|”|H": 2.0,
}


class Model:
    """Linear chain over the places of a run of text; tags: 1 boundary, 0 inside."""

    def __init__(self, weights: dict[str, float] | None = None, steps: dict | None = None):
        self.weights = dict(PRIOR if weights is None else weights)
        self.steps = dict(steps or {})
        self.memo: dict[tuple, float] = {}

    def score(self, d: tuple) -> float:
        got = self.memo.get(d)
        if got is None:
            got = sum(self.weights.get(f, 0.0) for f in features(d))
            if len(self.memo) < MEMO:
                self.memo[d] = got
        return got

    @staticmethod
    def step(tag: int, nxt: int, gap: int) -> tuple:
        return tag, nxt, min(gap // 6, 5)

    def viterbi(self, spots: list[tuple[int, tuple]], score=None) -> list[int]:
        if not spots:
            return []
        score = score or self.score
        off, on = 0.0, score(spots[0][1])
        if len(spots) == 1:
            return [int(on > off)]
        back = []
        get = self.steps.get
        rows = [[get((t, n, k), 0.0) for t in (0, 1) for n in (0, 1)] for k in range(6)]
        last = spots[0][0]
        for at, d in spots[1:]:
            s00, s01, s10, s11 = rows[min((at - last) // 6, 5)]
            s, last = score(d), at
            a0, a1, b0, b1 = off + s00, on + s10, off + s01, on + s11
            back.append((a1 > a0, b1 > b0))
            off, on = a1 if a1 > a0 else a0, (b1 if b1 > b0 else b0) + s
        tags = [int(on > off)]
        for row in reversed(back):
            tags.append(int(row[tags[-1]]))
        return tags[::-1]

    def train(self, sequences: list[tuple[list, list[int]]], epochs: int = EPOCHS, seed: int = SEED) -> Model:
        """Averaged structured perceptron."""
        sums: dict = defaultdict(float)
        step_sums: dict = defaultdict(float)
        clock, rng = 1, random.Random(seed)
        cache = [[features(d) for _, d in spots] for spots, _ in sequences]
        order = list(range(len(sequences)))
        for _ in range(epochs):
            rng.shuffle(order)
            for at in order:
                spots, gold = sequences[at]
                values = {id(d): sum(self.weights.get(f, 0.0) for f in fs) for (_, d), fs in zip(spots, cache[at])}
                tags = self.viterbi(spots, lambda d: values[id(d)])
                if tags != gold:
                    for k, (t, g) in enumerate(zip(tags, gold)):
                        if t != g:
                            for f in cache[at][k]:
                                self.weights[f] = self.weights.get(f, 0.0) + (g - t)
                                sums[f] += clock * (g - t)
                    for k in range(1, len(gold)):
                        gap = spots[k][0] - spots[k - 1][0]
                        for pair, by in (((gold[k - 1], gold[k]), STEP_RATE), ((tags[k - 1], tags[k]), -STEP_RATE)):
                            key = self.step(*pair, gap)
                            self.steps[key] = self.steps.get(key, 0.0) + by
                            step_sums[key] += clock * by
                clock += 1
        weights = {f: v - sums[f] / clock for f, v in self.weights.items()}
        return Model({f: v for f, v in weights.items() if abs(v) > 1e-6}, {k: v - step_sums[k] / clock for k, v in self.steps.items()})


def strung(items: list[str], seed: int = SEED) -> list[tuple[list, list[int]]]:
    """Labelled sequences: items of one script strung together, their ends the only boundaries. The order of the items does
    not matter: they are strung in the order of their hashes."""
    rng, groups = random.Random(seed), defaultdict(list)
    for item in sorted(set(items), key=lambda x: (zlib.crc32(x.encode()), x)):
        blank_ended = bool(_HAS_BLANK_ENDED.search(item))
        if blank_ended:
            item = item.rstrip(ENDS + " ")
        elif not re.search(rf"[{re.escape(ENDS)}][{SPACE}{re.escape(CLOSERS)}]*$", item):
            continue  # a heading; nothing follows it in running text
        first = char_class(item[:1])
        groups["blank" if blank_ended else "solid" if first in "KH" or re.search("[぀-ヿ一-鿿]", item) else "spaced"].append(item)
    out = []
    for kind, members in sorted(groups.items()):
        for _ in range(ARRANGEMENTS):
            rng.shuffle(members)
            for at in range(0, len(members), 5):
                text, ends = "", set()
                for item in members[at : at + 5]:
                    # lines of running text are wrapped anywhere
                    item = "".join("\n" if ch == " " and rng.random() < 0.12 else ch for ch in item)
                    if text:
                        if kind == "solid":
                            text += rng.choice(["", "", "", " ", "\n"])
                        elif kind == "blank":
                            text += rng.choice([" ", " ", " ", "  ", "\n"])
                        else:
                            text += rng.choice([" "] * 8 + ["  ", "\n", " \t", "\xa0", ""])
                    text += item
                    ends.add(len(text))
                spots = places(text)
                if spots:
                    out.append((spots, [int(end in ends) for end, _ in spots]))
    return out


class Lines:
    """The runs of text of a document, as (start, end, offset behind a list marker)."""

    def __init__(self, text: str):
        self.runs: list[tuple[int, int, int]] = []
        self.items: list[int] = []
        at = 0
        for m in _BREAK.finditer(text):
            self.block(text, at, m.start())
            at = m.end()
        self.block(text, at, len(text))

    def block(self, text: str, start: int, end: int) -> None:
        lines, at = [], start
        if _LINE.search(text, start, end) is None:
            if text[start:end].strip(" \t\xa0​﻿　"):
                m = _BULLET.match(text, start, end)
                if m:
                    self.items.append(len(self.runs))
                self.runs.append((start, end, m.end() if m else start))
            return
        for m in _LINE.finditer(text, start, end):
            lines.append((at, m.start()))
            at = m.end()
        lines.append((at, end))
        lines = [(a, b) for a, b in lines if text[a:b].strip(" \t\xa0​﻿　")]
        last, listed, opened = None, False, None
        specs = [self.spec(text[a:b]) for a, b in lines]
        for k, (a, b) in enumerate(lines):
            m = _BULLET.match(text, a, b)
            number = int(m[2]) if m and m[2] else None
            item = bool(m) and (k == 0 or listed or number in (None, 1)) and (number is None or last is None or number == last + 1 or k == 0)
            if item and k and not listed and number is None and m[1] in "–—-" and not self.ended(text, lines[k - 1]):
                item = False  # a dash in running text
            spec = specs[k] and (len(lines) == 1 or (k and specs[k - 1]) or (k + 1 < len(lines) and specs[k + 1]))
            if item or spec or opened is None or (k and specs[k - 1] and opened[3]):
                if opened is not None:
                    self.runs.append(opened[:3])
                opened = (a, b, m.end() if item else a, spec)
                if item:
                    self.items.append(len(self.runs))
                    listed, last = True, number if number is not None else last
            else:
                opened = (opened[0], b, opened[2], opened[3])
        if opened is not None:
            self.runs.append(opened[:3])

    @staticmethod
    def ended(text: str, line: tuple[int, int]) -> bool:
        return text[line[0] : line[1]].rstrip()[-1:] in ENDS + ":" + CLOSERS

    @staticmethod
    def spec(line: str) -> bool:
        if (":" not in line and "：" not in line) or not _SPEC.match(line):
            return False
        value = re.split("[:：]", line, maxsplit=1)[1]
        return bool(_VALUE.match(value)) and not re.search(rf"[{re.escape(ENDS)}][{re.escape(CLOSERS)}]*[{SPACE}]*$", re.sub(r"\b\w{1,4}\.\s*$", "", line))


_TRIM = " \t\r\n\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0               　​﻿"


def unit_spans(model: Model, text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each unit in order; none for null, empty and blank texts."""
    out: list[tuple[int, int]] = []
    if not text:
        return out
    for start, end, skip in Lines(text).runs:
        run = text[start:end]
        spots = places(run, skip - start)
        cuts = [e for (e, _), tag in zip(spots, model.viterbi(spots)) if tag] + [len(run)]
        at = 0
        for c in cuts:
            piece = run[at:c]
            left = len(piece.lstrip(_TRIM))
            if left:
                # what is left behind the white space begins and ends the unit
                out.append((start + c - left, start + at + len(piece.rstrip(_TRIM))))
            at = c
    return out


def list_items(documents: DataFrame) -> DataFrame:
    """(item): distinct list items of the documents, without their markers."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            found = set()
            for text in frame["text"]:
                if text and _LISTED.search(text):
                    lines = Lines(text)
                    for k in lines.items:
                        a, b, skip = lines.runs[k]
                        item = " ".join(text[skip:b].split())
                        if ITEM_LENGTH[0] <= len(item) <= ITEM_LENGTH[1]:
                            found.add(item)
            if found:
                yield pd.DataFrame({"item": sorted(found)})

    return documents.where("text is not null").select("text").mapInPandas(find, "item string").distinct()


def trained_model(documents: DataFrame) -> Model:
    """Fits the model to a sample of TRAINING_ITEMS items of each kind of script, the same for the same documents."""
    items = cut(list_items(documents), "items").withColumn("blank_ended", F.col("item").rlike(f"[{BLANK_ENDED}]")).withColumn("h", F.xxhash64("item"))
    # two bounded samples in one pass: punctuated items, and items of scripts without sentence punctuation
    sample = items.where("not blank_ended").orderBy("h", "item").limit(TRAINING_ITEMS).unionByName(items.where("blank_ended").orderBy("h", "item").limit(TRAINING_ITEMS))
    return Model().train(strung([r[0] for r in sample.select("item", "h").orderBy("h", "item").select("item").collect()]))


UNIT = "doc_id bigint, unit int, start_pos bigint, end_pos bigint, text string"


def split_documents(documents: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per sentence unit: doc_id, unit (from 1), start_pos, end_pos, text; offsets count code points.

    Null, empty and blank texts, and documents without doc_id, have no units. Texts of any length are split whole; repeated documents are split alike.
    The splitting itself shuffles nothing."""
    model = trained_model(documents)
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.steps))
    held: dict = {}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.setdefault("model", Model(*shared.value))
        for batch in batches:
            texts, docs = batch.column("text").to_pylist(), batch.column("doc_id").to_numpy(zero_copy_only=False)
            spans = [unit_spans(m, text) for text in texts]
            sizes = np.fromiter(map(len, spans), dtype=np.int64, count=len(spans))
            if not sizes.sum():
                continue
            places = np.array([x for own in spans for x in own], dtype=np.int64)
            first = np.repeat(np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
            columns = [np.repeat(docs, sizes), np.arange(1, len(places) + 1) - first, places[:, 0], places[:, 1]]
            out = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())]
            out.append(pa.array([t[a:b] for t, own in zip(texts, spans) for a, b in own], pa.string()) if with_text else pa.nulls(len(places), pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "unit", "start_pos", "end_pos", "text"])

    return documents.select("doc_id", "text").where("text is not null and doc_id is not null").mapInArrow(find, UNIT)


def sentence_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "end_pos")


def sentence_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(table(spark, sf_dir, "documents"))
