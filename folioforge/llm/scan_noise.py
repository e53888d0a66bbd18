"""Noise in text from scanned pages, found and repaired.

Misread words: corpus word counts give a lexicon; a symmetric-delete index over it proposes candidates for rare words, a
weighted edit distance with confusion pairs keeps those that a scan would take for another, and counts of the word pairs
around competing candidates choose between several. Running lines and printed page numbers are learnt from the corpus:
lines labelled head or foot, lines that stand alone or interrupt sentences again and again, and lines in which one number
goes with the page. Counts cover all blocks. What workers hold of the corpus has a fixed size (the most frequent words,
filters of learnt lines and of competing words) and only saves rows: every decision is made by a join.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.operators.references import HASHES, MAX_FILTER_BITS, filter_bits, words_of
from folioforge.runtime import cut, release, table

#: Known words a worker holds; they cover nearly all tokens, and the others are looked up by a join.
KNOWN_WORDS = 100_000
#: A word is taken for a misread other word if that one is so many times as frequent (less if it holds a sign no word has).
RATIO, RATIO_ODD = 8, 2
#: Occurrences a word must have to be a correction.
MIN_COUNT = 3
#: Entries a worker counts before it passes them on.
COUNTED = 400_000
MAX_COST = 1.0
#: A line is a page number's if its number went with the page on so many different pages, and in this share of all places.
PAGES_SEEN, PAGE_SHARE = 4, 0.8
#: Pages of one document on which an unlabelled line must stand alone to be a running line.
PAGES_ALONE = 3

# What is printed, and what a scan may take it for.
CONFUSIONS = (
    ("e", "c"), ("c", "e"), ("a", "@"), ("n", "ri"), ("s", "5"), ("t", "f"), ("f", "t"), ("l", "1"), ("o", "0"), ("d", "cl"), ("cl", "d"), ("l", "|"),
    ("u", "ii"), ("m", "rn"), ("rn", "m"), ("g", "q"), ("q", "g"), ("g", "9"), ("h", "b"), ("b", "h"), ("w", "vv"), ("i", "1"), ("i", "l"), ("l", "i"), ("i", "|"), ("i", "!"),
    ("l", "!"), ("b", "6"), ("b", "8"), ("z", "2"), ("h", "li"), ("n", "u"), ("u", "n"), ("a", "o"), ("o", "c"), ("y", "v"), ("s", "$"), ("li", "h"), ("m", "nn"), ("k", "lc"), ("a", "4"), ("e", "3"),
)
CONFUSION_COST = 0.4

# Labels of blocks that are titles of the content.
TITLES = ("paragraph_title", "doc_title", "title", "heading", "table", "image", "figure_title", "content")

# Labels of blocks that are furniture of the page.
FURNITURE = ("header", "footer")

HYPHENS = "-­‐‑¬⁃"
_HYPHENS = frozenset(HYPHENS)
_LINES = re.compile(r"\r\n|\r|\n")
_BROKEN = re.compile(rf"([^\W\d_])[{HYPHENS}][ \t\xa0]*$")
_GLUE = re.compile(rf"(?<=[^\W\d_])[{HYPHENS}][ \t\xa0]*(?:\r\n|\r|\n)\s*(?=[^\W\d_])")
_CUT = re.compile(rf"[^\W\d_][{HYPHENS}][ \t\xa0]*[\r\n]")
_JOINERS = re.compile(r"(?:and|or|to|und|oder|bis|et|ou|y|o)\b", re.I)
_NUMERAL = r"(?:\d{1,9}|(?=[mdclxvi])m{0,4}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3}))"
_STYLED = re.compile(rf"(?:p\.?|pp\.|pg\.?|page|seite|s\.|pág\.?|página)\s*{_NUMERAL}|\[\s*{_NUMERAL}\s*\]|\(\s*{_NUMERAL}\s*\)|[–—-]\s*{_NUMERAL}\s*[–—-]|{_NUMERAL}\s*(?:/|of|von|de)\s*\d{{1,9}}|[|·•]\s*{_NUMERAL}|{_NUMERAL}\s*[|·•]", re.I)
_BARE = re.compile(_NUMERAL, re.I)
_BEFORE = re.compile(rf"({_NUMERAL}|[–—-]\s*{_NUMERAL}\s*[–—-]|\[{_NUMERAL}\])\s+[|·•]?\s*(?=\S)", re.I)
_AFTER = re.compile(rf"(?<=\S)\s*(?:\s|[|·•])\s*({_NUMERAL}|(?:p\.|page)\s*{_NUMERAL}|[–—-]\s*{_NUMERAL}\s*[–—-]|\[{_NUMERAL}\])$", re.I)
_TOKEN = re.compile(r"[\w@|!$]{3,}")
_END = re.compile(r"[.!?:;,。！？؟।…]['\"”’»)\]]*$")
_INNER = re.compile(rf"(?<=[^\W\d_][^\W\d_])[.!?;:,]\s|[{HYPHENS}]\s*$")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
_NUMBER = re.compile(r"(?<![\w.,])\d+(?![.,]?\w)", re.A)
_HTML = re.compile(r"<t(able|d)\b", re.I)
_LINE_END = re.compile(r"[\r\n]|$")
_HTML_END = re.compile(r"</table\s*>", re.I)
_UNSPACED = re.compile("[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")


def numeral(text: str) -> int | None:
    digits = re.search(r"\d+", text)
    if digits:
        return int(digits[0])
    letters = re.findall(r"(?<![a-z])[ivxlcdm]+(?![a-z])", text.casefold())
    if not letters:
        return None
    values = [_ROMAN[ch] for ch in letters[-1]]
    return sum(-v if v < max(values[i + 1 :], default=0) else v for i, v in enumerate(values))


_FOLD = {code: " " for code in range(0x3100) if not chr(code).isalnum()} | str.maketrans({"1": "l", "|": "l", "!": "l", "i": "l", "0": "o", "5": "s", "@": "a", "c": "e", "f": "t", "q": "g", "b": "h", "8": "h", "6": "h", "$": "s"})


def fold_line(line: str) -> str:
    """One form for all prints and misreadings of a running line: case, blanks, bars and lookalike signs do not matter."""
    text = line.strip(" \t\xa0|·•").casefold().replace("rn", "m").replace("ii", "u").replace("vv", "w").replace("ri", "n").replace("cl", "d")
    return " ".join(text.translate(_FOLD).split())


def lines_of(text: str) -> list[str]:
    return _LINES.split(text) if "\r" in text else text.split("\n")


def slots(line: str, page: int | None, own_only: bool = False) -> Iterator[tuple[str, bool]]:
    """For each number in a line: the folded line with the number left open, and whether the number is the page's."""
    for m in _NUMBER.finditer(line):
        own = len(m[0]) < 10 and int(m[0]) == page
        if own or not own_only:
            yield f"{fold_line(line[: m.start()])}#{fold_line(line[m.end() :])}", own


def whole(page) -> int | None:
    return None if page is None or page != page else int(page)


def prose(text: str) -> str:
    """The text with the lines of its tables blanked, wherever they stand; line numbers stay."""
    if "|" not in text and "<" not in text:
        return text
    if text.count("|") >= 4 and text.lstrip().startswith("|"):
        return ""
    m = _HTML.search(text)
    if m is None:
        if "|" not in text or "\n" not in text:
            return text
        return "".join(x if x.count("|") < 2 or not x.lstrip().startswith("|") else "\n" for x in text.splitlines(keepends=True))
    if m[1].casefold() == "d":  # cells without a table
        return ""
    out, at = [], 0
    while m is not None:
        start = max(text.rfind("\n", 0, m.start()), text.rfind("\r", 0, m.start())) + 1
        end = _HTML_END.search(text, m.end())
        stop = len(text) if end is None else _LINE_END.search(text, end.end()).start()
        out += [text[at:start], "\n" * len(_LINES.findall(text[start:stop]))]
        at, m = stop, None if end is None else _HTML.search(text, stop)
    return "".join([*out, text[at:]])


def glued(text: str) -> str:
    """The text with words cut at line ends joined."""
    return _GLUE.sub("", text) if "\n" in text or "\r" in text else text


def page_number(line: str, page: int | None, label: str | None, inside: bool) -> bool:
    """A styled number counts wherever it stands alone; a bare one if it is the page's, or the block is furniture."""
    text = line.strip()
    if not text or text[0] not in _NUMBER_STARTS or len(text) > 48 and len("".join(text.split())) > 48:
        return False
    if _STYLED.fullmatch(text):
        return True
    if _BARE.fullmatch(text):
        return numeral(text) == page or (not inside and label in ("number", *FURNITURE))
    return False


_NUMBER_STARTS = frozenset("0123456789[(–—-|·•pPsSivxlcdmIVXLCDM")
_LETTERS = re.compile(r"[^\W\d_]{3}[^\n]*[^\W\d_]{3}")
_EDGES, _ROMANS = frozenset("0123456789[]–—-"), frozenset("ivxlcdmIVXLCDM")
_MAY_EDGE = _EDGES | _ROMANS
_ROMAN_FIRST, _ROMAN_LAST = re.compile(r"[ivxlcdm]+\s", re.I), re.compile(r"[\s|·•][ivxlcdm]+$", re.I)


def split_number(line: str, page: int | None) -> tuple[str, bool]:
    """The line without a page number at either end, and whether there was one."""
    text = line.strip()
    first, last = text[0], text[-1]
    if (first in _EDGES or first in _ROMANS and _ROMAN_FIRST.match(text)) and (m := _BEFORE.match(text)) and numeral(m[1]) == page:
        return text[m.end() :], True
    if (last in _EDGES or last in _ROMANS and _ROMAN_LAST.search(text, max(0, len(text) - 20))) and (m := _AFTER.search(text, max(0, len(text) - 48))) and numeral(m[1]) == page:
        return text[: m.start()], True
    return line, False


def may_run(line: str, alone: bool) -> bool:
    """Whether an unlabelled line could be a running line: no sentence, begun in no small letter, of two words or more (four
    signs in scripts without blanks); in a text, half of its words begun with capitals."""
    text = line.strip(" \t\xa0|·•")
    if len(text) < 4 or text[0].islower() or not text[0].isalnum() or _END.search(text, max(0, len(text) - 8)):
        return False
    words = text.split()
    if len(words) == 1:
        return alone and bool(_UNSPACED.search(text))
    if not alone and 2 * sum(w[0].isupper() for w in words) < len(words):
        return False
    return not _INNER.search(text) and 2 * sum(w[0].isalpha() for w in words) > len(words)


class Block:
    """The lines of a block's prose with what each could be: '' (blank), 'num', 'run' (a candidate) or 'text'."""

    def __init__(self, text: str, page: int | None, label: str | None):
        self.lines = lines_of(text)
        full = [i for i, x in enumerate(self.lines) if x.strip()]
        self.whole = len(full) == 1
        labelled = self.whole and label in FURNITURE
        inside = bool(_LETTERS.search(text))
        self.kind, self.rests, self.numbered = [], {}, set()
        for i, x in enumerate(self.lines):
            if not x.strip():
                self.kind.append("")
                continue
            if (self.whole or inside) and page_number(x, page, label, not self.whole):
                self.kind.append("num")
                continue
            rest, number = split_number(x, page)
            if labelled or may_run(rest, self.whole):
                self.kind.append("run")
                self.rests[i] = rest
                if number:
                    self.numbered.add(i)
            else:
                self.kind.append("text")

    def fold(self, i: int) -> str | None:
        return fold_line(self.rests[i]) if i in self.rests else None

    def neighbour(self, i: int, step: int) -> str | None:
        i += step
        while 0 <= i < len(self.lines):
            if self.kind[i] in ("text", "run"):
                return self.lines[i].strip()
            i += step
        return None

    def interrupts(self, i: int) -> bool:
        """A candidate in title case between the halves of a sentence."""
        before, after = self.neighbour(i, -1), self.neighbour(i, 1)
        return bool(before and after and after[0].islower() and not _END.search(before, max(0, len(before) - 8)))

    def breaks(self) -> list[tuple[int, int]]:
        """(line, line on which it goes on) for each word cut at a line end."""
        out = []
        for i, x in enumerate(self.lines):
            if self.kind[i] not in ("text", "run") or x.rstrip(" \t\xa0")[-1:] not in _HYPHENS or not _BROKEN.search(x):
                continue
            j = i + 1
            while j < len(self.lines):
                below = self.lines[j].lstrip()
                if self.kind[j] in ("text", "run") and below and below[0].islower():
                    if not _JOINERS.match(below):
                        out.append((i, j))
                    break
                if self.kind[j] == "text":
                    break
                j += 1
        return out


COUNT_ROW = "kind string, source_table string, doc_stem string, id string, page int, line int, key string, n bigint, label_votes int, breaks_in int, numbered boolean"
COLUMNS = ["kind", "source_table", "doc_stem", "id", "page", "line", "key", "n", "label_votes", "breaks_in", "numbered"]


def survey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First pass: counts of words, and of those joined over line ends (kind joined); lines that could be running lines
    (kind alone where they are a whole block, else line); lines with the page's number; page numbers and broken words of every block."""
    words: Counter = Counter()
    joined: Counter = Counter()

    def flush():
        rows = [("word", w, n) for w, n in words.items() if likely(w)] + [("joined", w, n) for w, n in joined.items()]
        words.clear()
        joined.clear()
        return framed(rows, ["kind", "key", "n"], COLUMNS)

    before, found_here, tokens, halves = None, [], [], []
    for frame in batches:
        found = []
        for source, doc, id_, page, label, text in zip(frame["source_table"], frame["doc_stem"], frame["id"], frame["page"], frame["label"], frame["text"]):
            me = (plain_ends(text), whole(page), label)
            if me != before:  # both tables mostly hold the same block, one behind the other
                before, (found_here, tokens, halves) = me, surveyed(*me)
            words.update(tokens)
            if halves:
                joined.update(halves)
            found += [(kind, source, doc, id_, me[1], *rest) for kind, *rest in found_here]
        if found:
            yield framed(found, COLUMNS, COLUMNS)
        if len(words) > COUNTED:
            yield flush()
    yield flush()


def plain_ends(text: str) -> str:
    return text.replace("\r\n", "\n").replace("\r", "\n") if "\r" in text else text


def surveyed(text: str, page: int | None, label: str | None) -> tuple[list[tuple], list[str], list[str]]:
    """(rows without place, tokens, words joined over line ends) of one block."""
    text = prose(text)
    if "\n" not in text:
        if not text or text.isspace():
            return [], [], []
        return single_line(page, label, text), _TOKEN.findall(text.casefold()), []
    b, found = Block(text, page, label), []
    mine = "" if page is None else str(page)
    for i, k in enumerate(b.kind):
        if k == "num":
            found.append(("num", i, None, 1, 0, 0, True))
        elif k == "run":
            found.append(("alone" if b.whole else "line", i, b.fold(i), 1, int(b.whole and label in FURNITURE), -int(label in TITLES) if b.whole else int(b.interrupts(i)), i in b.numbered))
        if k in ("run", "text") and mine and mine in b.lines[i]:
            found += numbered_line(page, i, b.lines[i])
    halves = []
    if not b.whole:
        found += [("broken", i, None, 1, 0, 0, False) for i, _ in b.breaks()]
        if _CUT.search(text):
            halves = [(x + y).casefold() for x, y in _HALVES.findall(text)]
    return found, _TOKEN.findall(glued(text).casefold()), halves


_INTEGERS = frozenset(["page", "line", "n", "label_votes", "breaks_in"])


def framed(rows: list[tuple], given: list[str], columns: list[str]) -> pd.DataFrame:
    """Rows as a frame of the columns; those not given are null."""
    held = dict(zip(given, zip(*rows))) if rows else {}
    nulls = (None,) * len(rows)
    return pd.DataFrame({c: pd.array(held.get(c, nulls), dtype="Int64") if c in _INTEGERS else pd.Series(held.get(c, nulls), dtype=object) for c in columns})


_HALVES = re.compile(rf"([\w@|!$]*[^\W\d_])[{HYPHENS}][ \t\xa0]*(?:\r\n|\r|\n)\s*([^\W\d_][\w@|!$]*)")


def single_line(page: int | None, label: str | None, text: str) -> list[tuple]:
    """What a block of one line could be: a page number, or a candidate for a running line."""
    if page_number(text, page, label, False):
        return [("num", 0, None, 1, 0, 0, True)]
    rest, number = split_number(text, page)
    out = numbered_line(page, 0, text) if page is not None and str(page) in text else []
    if label in FURNITURE or may_run(rest, True):
        out.append(("alone", 0, fold_line(rest), 1, int(label in FURNITURE), -int(label in TITLES), number))
    return out


def numbered_line(page: int, i: int, line: str) -> list[tuple]:
    """Rows for the page's number in a line that is no sentence."""
    return [] if sentence(line) else [("slot", i, key, 1, 0, 0, True) for key, _ in slots(line, page, True)]


def sentence(line: str) -> bool:
    return bool(_END.search(line.rstrip(), max(0, len(line) - 12)) or _INNER.search(line))


def blocks_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each block with text once: source_table, doc_stem, id, page, label, text."""
    semantic = table(spark, sf_dir, "semantic_blocks").select(F.lit("semantic_blocks").alias("source_table"), "doc_stem", "id", "page", F.col("source_type").alias("label"), "text")
    pages = table(spark, sf_dir, "ocr_pages").select("doc_stem", (F.col("page_index") + 1).alias("page"), F.posexplode("parsing_res_list").alias("n", "b"))
    scanned = pages.select(F.lit("ocr_pages").alias("source_table"), "doc_stem", F.format_string("p%d_b%03d", "page", "n").alias("id"), "page", F.col("b.block_label").alias("label"), F.col("b.block_content").alias("text"))
    both = semantic.unionByName(scanned).where("doc_stem is not null and id is not null and trim(text) <> ''")
    # the two records of a block come to lie one behind the other, by the one shuffle that repeated deliveries need anyway
    once = both.repartition("doc_stem", "id").dropDuplicates(["source_table", "doc_stem", "id"])
    return once.sortWithinPartitions("doc_stem", "id", "source_table")


# ---------------------------------------------------------------- misread words


# Letter groups that print like one letter, and signs that print alike.
GROUPS = (("rn", "m"), ("nn", "m"), ("cl", "d"), ("ii", "u"), ("vv", "w"), ("ri", "n"), ("li", "h"), ("lc", "k"))
ALIKE = ("eco0a@43", "nu", "s5$", "tf", "l1|i!", "gq9", "hb68", "z2", "yv")
_ALIKE = str.maketrans({ch: group[0] for group in ALIKE for ch in group})


def grouped(word: str) -> str:
    for seen, real in GROUPS:
        word = word.replace(seen, real)
    return word


def deletions(word: str, prefix: int = 7) -> list[str]:
    """Keys of the symmetric-delete index: the prefix of the word, groups that print like one letter taken for it, with up
    to two letters left out (one of short words, whose keys would be everybody's). A key of its own holds the whole word
    with signs that print alike taken for one, so any number of such changes is found."""
    one = grouped(word)
    level = out = {one[:prefix]}
    for _ in range(1 if len(one) < 5 else 2):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w)) if len(w) > 1}
        out = out | level
    return sorted(out | {"=" + grouped(word.translate(_ALIKE)), "~" + one.translate(_ALIKE)})


def scan_cost(real: str, seen: str, limit: float = MAX_COST) -> float:
    """Weighted edit distance of a printed word and what was read; beyond confusion pairs an edit costs more than limit."""
    if abs(len(real) - len(seen)) > 2:
        return limit + 1
    rows = [[limit + 1.0] * (len(seen) + 1) for _ in range(len(real) + 1)]
    rows[0][0] = 0.0
    for i in range(len(real) + 1):
        for j in range(len(seen) + 1):
            at = rows[i][j]
            if at > limit:
                continue
            if i < len(real) and j < len(seen) and real[i] == seen[j]:
                rows[i + 1][j + 1] = min(rows[i + 1][j + 1], at)
            for a, b in CONFUSIONS:
                if real.startswith(a, i) and seen.startswith(b, j):
                    rows[i + len(a)][j + len(b)] = min(rows[i + len(a)][j + len(b)], at + CONFUSION_COST)
    return rows[-1][-1]


@F.pandas_udf(T.ArrayType(T.StringType()))
def deletion_keys(words: pd.Series) -> pd.Series:
    return words.map(deletions)


@F.pandas_udf(T.DoubleType())
def cost_of(real: pd.Series, seen: pd.Series) -> pd.Series:
    return pd.Series([scan_cost(a, b) for a, b in zip(real, seen)], dtype="float64")


def repair_table(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(seen, real, cost, real_n): rare words and the frequent words they were misread from; words: (word, n)."""
    odd = F.col("word").rlike("[^\\p{L}]")
    real = words.where(~odd & (F.length("word") >= 3) & (F.col("n") >= min_count)).select(F.col("word").alias("real"), F.col("n").alias("real_n"), F.explode(deletion_keys("word")).alias("k"))
    seen = words.where(F.length("word") >= 3).select(F.col("word").alias("seen"), F.col("n").alias("seen_n"), F.explode(deletion_keys("word")).alias("k"))
    ratio = F.when(F.col("seen").rlike("[^\\p{L}]"), F.lit(RATIO_ODD)).otherwise(F.lit(RATIO))
    return (
        seen.join(real, "k")
        .where((F.col("seen") != F.col("real")) & (F.col("real_n") >= ratio * F.col("seen_n")) & (F.abs(F.length("seen") - F.length("real")) <= 2))
        .select("seen", "real", "real_n")
        .distinct()
        .withColumn("cost", cost_of("real", "seen"))
        .where(F.col("cost") <= MAX_COST)
    )


def likely(token: str) -> bool:
    """Whether a token could be a misread word: letters, but for three signs at most."""
    return token.isalpha() or (not token.isdigit() and sum(map(str.isalpha, token)) >= max(2, len(token) - 3))


class Sieve:
    """A Bloom filter of texts of at most MAX_FILTER_BITS: what it does not know is not among them."""

    def __init__(self, words: np.ndarray):
        self.bits, self.bytes, self.empty = len(words) * 64, words.astype("<u8").tobytes(), not words.any()

    def __contains__(self, key: str) -> bool:
        h = xxhash.xxh64_intdigest(key.encode(), 42)
        low, high, held, bits = h & 0xFFFFFFFF, h >> 32 | 1, self.bytes, self.bits
        for i in range(HASHES):
            spot = (low + high * i) % bits
            if not held[spot >> 3] >> (spot & 7) & 1:
                return False
        return True


def sieves_of(**keys: DataFrame) -> dict[str, Sieve]:
    """The filters of the first columns of several tables, built together."""
    parts = [df.select(F.lit(name).alias("of"), F.xxhash64(F.col(df.columns[0])).alias("h")) for name, df in keys.items()]
    hashes = parts[0]
    for part in parts[1:]:
        hashes = hashes.unionByName(part)
    hashes = hashes.distinct()
    bits = dict.fromkeys(keys, filter_bits(1)) | {r["of"]: min(filter_bits(r["count"]), MAX_FILTER_BITS) for r in hashes.groupBy("of").count().collect()}
    size = F.create_map(*[F.lit(x) for pair in bits.items() for x in pair])
    words = words_of(hashes.withColumn("_bits", size[F.col("of")].cast("bigint")), F.col("_bits"), "of").toPandas()
    out = {}
    for name, n in bits.items():
        mine, filled = words[words["of"] == name], np.zeros(n // 64, dtype=np.uint64)
        filled[mine["word"].to_numpy(dtype=np.int64)] = mine["mask"].to_numpy(dtype=np.int64).view(np.uint64)
        out[name] = Sieve(filled)
    return out


SUSPECT = "kind string, source_table string, doc_stem string, id string, line int, token string, before string, after string, fold string, whole string, n bigint, numbered boolean"
SUSPECTED = ["kind", "source_table", "doc_stem", "id", "line", "token", "before", "after", "fold", "whole", "n", "numbered"]


def suspects_of(known: frozenset, competing: Sieve, running: Sieve, paged: Sieve, heads: Sieve):
    """known: words not to look at; competing: words that share a misread form with others; running, paged: learnt lines;
    heads: what these begin with."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Second pass: tokens that are no known words, with their neighbours (kind token; whole is the joined word where
        the token is a half); pairs with a competing word (pair); lines that may be learnt running lines (line) or hold a
        number where learnt lines hold the page's (slot)."""
        fine, pairs, judged, rivals, begins = set(known), Counter(), set(), set(), {}

        def examined(text: str, page: int | None, label: str | None) -> tuple[list[tuple], list[tuple[str, str]]]:
            """(rows without block, pairs) of one block."""
            out: list[tuple] = []
            text = prose(text)
            if not text:
                return out, []
            tokens_ = _TOKEN.findall(glued(text).casefold())
            if not judged.issuperset(tokens_):
                if len(judged) > COUNTED:
                    judged.clear()
                fresh = set(tokens_) - judged
                judged.update(fresh)
                rivals.update(t for t in fresh if t in competing)
            beside = [] if rivals.isdisjoint(tokens_) else [p for p in zip(tokens_, tokens_[1:]) if p[0] in rivals or p[1] in rivals]
            lines = lines_of(text)
            for i, x in enumerate(lines):
                line = x.strip()
                if not line:
                    continue
                # most lines begin as none of the learnt ones do, and are not folded
                start = line.split(None, 1)[0]
                met = begins.get(start)
                if met is None:
                    if len(begins) > COUNTED:
                        begins.clear()
                    head = fold_line(start).partition(" ")[0]
                    met = begins[start] = not head or head in heads or start[0].isdecimal()
                edged = line[0] in _MAY_EDGE or line[-1] in _MAY_EDGE
                if len(lines) > 1 and (met or edged):
                    rest, number = split_number(x, page) if edged else (x, False)
                    if (met or number) and (key := fold_line(rest)) in running:
                        out.append(("line", i, key, None, None, None, None, None, number))
                if met and not paged.empty and _NUMBER.search(x) and not sentence(x):
                    out += [("slot", i, key, None, None, None, None, None, own) for key, own in slots(x, page) if key in paged]
            odd = not fine.issuperset(tokens_)
            if odd:
                strange = [t for t in tokens_ if t not in fine]
                if len(fine) < 4 * COUNTED:
                    fine.update(t for t in strange if not likely(t))
                odd = any(map(likely, strange))
            # a word cut by furniture between its halves is joined below only
            if not odd and not _CUT.search(text):
                return out, beside
            b = Block(text, page, label)
            joined = {j: i for i, j in b.breaks()}
            tokens: list[tuple[str, int, str | None]] = []
            for i, k in enumerate(b.kind):
                if k not in ("text", "run"):
                    continue
                line = _TOKEN.findall(b.lines[i].casefold())
                if i in joined:
                    head = _HEAD.findall(b.lines[joined[i]].casefold())
                    tail = _TAIL.match(b.lines[i].casefold())
                    if head and tail:
                        one = head[0] + tail[1]
                        if line and line[0] == tail[1]:
                            line = line[1:]
                        mine = [n for n, (t, at, _) in enumerate(tokens) if at == joined[i] and t == head[0]]
                        if mine:
                            del tokens[mine[-1]]
                        tokens += [(one, joined[i], None), (head[0], joined[i], one), (tail[1], joined[i], one)]
                tokens += [(t, i, None) for t in line]
            for n, (t, i, of) in enumerate(tokens):
                if t not in known and len(t) >= 3:
                    for form in {t, t.strip("|!$")}:
                        if len(form) >= 3 and likely(form):
                            out.append(("token", i, form, tokens[n - 1][0] if n else None, tokens[n + 1][0] if n + 1 < len(tokens) else None, b.fold(i), of, None, None))
            return out, beside

        before, rows, beside = None, [], []
        for frame in batches:
            out = []
            for source, doc, id_, page, label, text in zip(frame["source_table"], frame["doc_stem"], frame["id"], frame["page"], frame["label"], frame["text"]):
                me = (plain_ends(text), whole(page), label)
                if me != before:
                    before, (rows, beside) = me, examined(*me)
                pairs.update(beside)
                out += [(kind, source, doc, id_, *rest) for kind, *rest in rows]
            if out:
                yield framed(out, SUSPECTED, SUSPECTED)
            if len(pairs) > COUNTED:
                yield counted(pairs)
                pairs.clear()
        yield counted(pairs)

    def counted(pairs: Counter) -> pd.DataFrame:
        return framed([("pair", a, b, n) for (a, b), n in pairs.items()], ["kind", "before", "after", "n"], SUSPECTED)

    return find


_HEAD = re.compile(rf"([\w@|!$]+)[{HYPHENS}]\s*$")
_TAIL = re.compile(r"\s*([\w@|!$]+)")


def running_lines(lines: DataFrame) -> DataFrame:
    """Folded running lines of the corpus: lines labelled head or foot at least as often as they are titles, or lines in
    title case that interrupted sentences at least twice and at least as often as they stood elsewhere in a text."""
    votes = lines.groupBy("key").agg(
        F.sum("label_votes").alias("labelled"),
        F.sum((F.col("breaks_in") == 1).cast("int")).alias("interrupting"),
        F.sum((F.col("breaks_in") == -1).cast("int")).alias("titles"),
        F.sum(((F.col("breaks_in") == 0) & (F.col("label_votes") == 0)).cast("int")).alias("flowing"),
        F.sum(((F.col("breaks_in") == 0) & (F.col("kind") == "line")).cast("int")).alias("flowing_inside"),
    )
    labelled = (F.col("labelled") >= 1) & (F.col("labelled") >= F.col("titles"))
    inside = (F.col("interrupting") >= 2) & (F.col("interrupting") >= F.col("flowing")) & (F.col("interrupting") > F.col("titles"))
    # a line that stands alone on page after page of a document, and nowhere as a title or in a text
    often = lines.where("kind = 'alone' and breaks_in = 0").groupBy("key", "doc_stem").agg(F.count_distinct("page").alias("pages")).where(F.col("pages") >= PAGES_ALONE)
    repeated = votes.where("titles = 0 and flowing_inside = 0").join(often, "key", "left_semi").select("key")
    sure = votes.where(labelled | inside).select("key").unionByName(repeated).distinct()
    # a catalog's lines differ from those of its sister volumes in the last word: a line that is never a title is one too
    # if it stood alone or interrupted, and all its words but the last begin several known lines
    stem = F.regexp_replace("key", " [^ ]+$", "")
    stems = sure.groupBy(stem.alias("stem")).count().where("count >= 2 and stem like '% %'").select("stem")
    alone = lines.where("breaks_in = 1 or (breaks_in = 0 and kind = 'alone')").select("key").distinct()
    sisters = votes.where("titles = 0").join(alone, "key", "left_semi").withColumn("stem", stem).join(stems, "stem", "left_semi").select("key")
    return sure.unionByName(sisters).distinct()


def context_counts(several: DataFrame, pairs: DataFrame) -> DataFrame:
    """For tokens with several candidates: (before, after, real, context), how often the candidate stood beside them."""
    asked = several.select("before", "after", "real").distinct()
    left = pairs.select("before", F.col("after").alias("real"), F.col("n").alias("_l"))
    right = pairs.select(F.col("before").alias("real"), "after", F.col("n").alias("_r"))
    both = asked.join(left, ["before", "real"], "left").join(right, ["real", "after"], "left")
    return both.select("before", "after", "real", (F.coalesce("_l", F.lit(0)) + F.coalesce("_r", F.lit(0))).alias("context"))


def paged_lines(first: DataFrame) -> DataFrame:
    """Keys of lines whose number was the page's on several different pages: candidates for forms of page numbers."""
    return first.where("kind = 'slot'").groupBy("key").agg(F.count_distinct("page").alias("pages")).where(F.col("pages") >= PAGES_SEEN).select("key")


def best_repairs(suspects: DataFrame, repairs: DataFrame, pairs: DataFrame, words: DataFrame, running: DataFrame) -> DataFrame:
    """(block, line, token, real): of several candidates the cheapest, then the one seen most often beside the token's
    neighbours, then the most frequent. Halves of a joined word count only if that is no word."""
    place = ["source_table", "doc_stem", "id", "line", "token"]
    met = suspects.join(repairs.withColumnRenamed("seen", "token"), "token").join(running.withColumnRenamed("key", "fold"), "fold", "left_anti")
    frequent = words.where(F.col("n") >= MIN_COUNT).select(F.col("word").alias("whole"))
    met = met.where("whole is null").unionByName(met.where("whole is not null").join(frequent, "whole", "left_anti").select(met.columns))
    met = cut(met.select(*place, "before", "after", "real", "cost", "real_n"), "candidates")
    several = met.join(met.groupBy(*place).agg(F.count_distinct("real").alias("c")).where("c > 1").drop("c"), place, "left_semi")
    counts = context_counts(several, pairs).select(F.col("before").alias("_b"), F.col("after").alias("_a"), F.col("real").alias("_real"), "context")
    # neighbours can be missing at either end of a block
    beside = F.col("before").eqNullSafe(F.col("_b")) & F.col("after").eqNullSafe(F.col("_a")) & (F.col("real") == F.col("_real"))
    scored = met.join(counts, beside, "left").withColumn("context", F.coalesce("context", F.lit(0)))
    first = F.min(F.struct("cost", (-F.col("context")).alias("c"), (-F.col("real_n")).alias("m"), "real"))
    return scored.groupBy(*place).agg(first.alias("b")).select(*place, F.col("b.real").alias("real"))


def scan_findings(blocks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(items, repairs, words, blocks) behind both queries.

    items: source_table, doc_stem, id, line, noise; repairs: source_table, doc_stem, id, line, token, real; words: word, n,
    joined_n (of these, over line ends)."""
    spark = blocks.sparkSession
    blocks = cut(blocks, "blocks")
    first = cut(blocks.mapInPandas(survey, COUNT_ROW), "survey", by="kind")
    count = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")))
    words = cut(first.where("kind in ('word', 'joined')").groupBy(F.col("key").alias("word")).agg(count("word").alias("n"), F.coalesce(count("joined"), F.lit(0)).alias("joined_n")).where("n is not null"), "words")
    repairs = cut(repair_table(words), "repairs")
    top = words.join(repairs.select(F.col("seen").alias("word")).distinct(), "word", "left_anti").orderBy(F.desc("n"), "word").limit(KNOWN_WORDS)
    rivals = repairs.groupBy("seen").agg(F.count(F.lit(1)).alias("c")).where("c > 1").join(repairs, "seen").select("real")
    lines = first.where("kind in ('line', 'alone')")
    running = cut(running_lines(lines), "running")
    paged = cut(paged_lines(first), "paged")
    heads = running.select(F.substring_index("key", " ", 1).alias("k")).unionByName(paged.select(F.substring_index(F.substring_index("key", "#", 1), " ", 1).alias("k")))
    sieves = sieves_of(rivals=rivals, running=running, paged=paged, heads=heads)
    held = spark.sparkContext.broadcast((frozenset(r[0] for r in top.select("word").collect()), *sieves.values()))

    def find(batches):
        yield from suspects_of(*held.value)(batches)

    second = cut(blocks.mapInPandas(find, SUSPECT), "suspects", by="kind")
    block = ["source_table", "doc_stem", "id", "line"]
    pairs = second.where("kind = 'pair'").groupBy("before", "after").agg(F.sum("n").alias("n"))
    misread = cut(best_repairs(second.where("kind = 'token'"), repairs, pairs, words, running), "misread")
    seen = lines.select(*block, "key", "numbered").unionByName(second.where("kind = 'line'").select(*block, F.col("token").alias("key"), "numbered"))
    confirmed = cut(seen.join(running, "key").groupBy(*block).agg(F.max("numbered").alias("numbered")), "confirmed")
    met = second.where("kind = 'slot'").select(*block, F.col("token").alias("key"), F.col("numbered").alias("own")).join(paged, "key")
    sure = met.groupBy("key").agg(F.avg(F.col("own").cast("double")).alias("share")).where(F.col("share") >= PAGE_SHARE).select("key")
    learnt = met.where("own").join(sure, "key", "left_semi").join(confirmed, block, "left_anti").select(*block).distinct()
    items = (
        first.where("kind = 'broken'").select(*block, F.lit("broken_word").alias("noise"))
        .unionByName(misread.select(*block, F.lit("misread").alias("noise")))
        .unionByName(confirmed.select(*block, F.lit("running_line").alias("noise")))
        .unionByName(first.where("kind = 'num'").select(*block, F.lit("page_number").alias("noise")))
        .unionByName(confirmed.where("numbered").select(*block, F.lit("page_number").alias("noise")))
        .unionByName(learnt.select(*block, F.lit("page_number").alias("noise")))
    )
    return items, misread, words, blocks


def noisy_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_table, doc_stem, id, noise), each kind of a block once."""
    items, _, _, blocks = scan_findings(blocks_of(spark, sf_dir))
    release(blocks)  # the copy of all texts; what is left to do reads findings only
    return items.select("source_table", "doc_stem", "id", "noise").distinct()


def rebuild(text: str, page, label, drop: list[int], fixes: list[tuple[int, str, str]], compounds: list[int]) -> str:
    """The text without dropped lines, broken words joined, misread words replaced, lines of a paragraph joined.

    fixes: (line, what stands there, what was printed); compounds: lines whose cut word keeps its hyphen. Lines of tables
    stay as they are."""
    plain = prose(text)
    if not plain.strip():
        return text
    b, whole_lines = Block(plain, whole(page), label), lines_of(text)
    gone, kept = set(drop), set(compounds)
    goes_on = dict(b.breaks())
    of_line: dict[int, dict[str, str]] = {}
    for i, seen, real in fixes:
        of_line.setdefault(i, {})[seen] = real
    keep = [i for i in range(len(b.lines)) if i not in gone]
    parts, flowing = [], any(len(b.lines[i].split()) >= 5 for i in keep)
    moved: dict[int, int] = {}  # line -> letters of its first word that went to the line above
    for n, i in enumerate(keep):
        line = b.lines[i].strip()
        if not line and whole_lines[i].strip():  # a table's
            parts.append(("" if not parts or parts[-1].endswith("\n") else "\n") + whole_lines[i] + "\n")
            continue
        if not line:
            follows = next((j for j in keep[n + 1 :] if whole_lines[j].strip()), None)
            before = next((j for j in reversed(keep[:n]) if whole_lines[j].strip()), None)
            torn = gone and before is not None and follows is not None and any(before < g < follows for g in gone)
            if not torn:
                parts.append("\n\n")
            continue
        line = line[moved.get(i, 0) :]
        if i in goes_on:
            tail = _TAIL.match(b.lines[goes_on[i]])
            word = tail[1] if tail else ""
            moved[goes_on[i]] = len(word)
            # blanks stand behind the word that came up, if anything does
            line, space = line[:-1].rstrip(HYPHENS) + ("-" if i in kept else "") + word, ""
            rest = b.lines[goes_on[i]].strip()[len(word) :]
            space = "" if rest and not rest[0].isspace() else " " if flowing else "\n"
        else:
            space = " " if flowing else "\n"
        for seen, real in of_line.get(i, {}).items():
            line = re.sub(rf"(?<![\w@|]){re.escape(seen)}(?![\w@|])", lambda m: real.capitalize() if m[0][:1].isupper() else real, line, flags=re.I)
        if i in moved and (not line.strip() or line[0].isspace()):
            line = line.lstrip()
            if not line:
                continue
        parts.append(line + space)
    return re.sub(r"[ \t]*\n\n[\s]*", "\n\n", "".join(parts)).strip()


HALVES = "source_table string, doc_stem string, id string, line int, head string, tail string"


def halves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The halves of each word cut at a line end."""
    for frame in batches:
        out = []
        for source, doc, id_, page, label, text in zip(frame["source_table"], frame["doc_stem"], frame["id"], frame["page"], frame["label"], frame["text"]):
            text = prose(text)
            if _CUT.search(text):
                b = Block(text, whole(page), label)
                for i, j in b.breaks():
                    head, tail = _HEAD.findall(b.lines[i].casefold()), _TAIL.match(b.lines[j].casefold())
                    if head and tail:
                        out.append((source, doc, id_, i, head[0], tail[1]))
        if out:
            yield pd.DataFrame(out, columns=["source_table", "doc_stem", "id", "line", "head", "tail"])


def compound_lines(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """Lines whose cut word is a hyphenated compound: its halves are words by themselves, and nowhere does it stand whole."""
    cuts = blocks.mapInPandas(halves, HALVES)
    stands = words.where("n > joined_n").select("word")
    asked = cuts.select("head", "tail").distinct()
    compound = (
        asked.join(stands.withColumnRenamed("word", "head"), "head", "left_semi")
        .join(stands.withColumnRenamed("word", "tail"), "tail", "left_semi")
        .withColumn("word", F.concat("head", "tail"))
        .join(stands, "word", "left_anti")
        .select("head", "tail")
    )
    return cuts.join(compound, ["head", "tail"], "left_semi").select("source_table", "doc_stem", "id", "line")


def repair_blocks(blocks: DataFrame) -> DataFrame:
    """Every block once as continuous text: source_table, doc_stem, id, text, repaired, changed.

    Tables stay as they are, also beside running text; a block that is all furniture comes out empty; null and blank texts
    are left out. Each line has its own corrections. Texts of any length are handled whole."""
    items, misread, words, blocks = scan_findings(blocks)
    key = ["source_table", "doc_stem", "id"]
    lines = items.where("noise in ('running_line', 'page_number')").groupBy(*key).agg(F.collect_set("line").alias("drop"))
    fixes = misread.groupBy(*key).agg(F.collect_set(F.struct("line", "token", "real")).alias("fixes"))
    compounds = compound_lines(blocks, words).groupBy(*key).agg(F.collect_set("line").alias("compounds"))

    @F.pandas_udf("string")
    def repaired(text: pd.Series, page: pd.Series, label: pd.Series, drop: pd.Series, at: pd.Series, seen: pd.Series, real: pd.Series, keep: pd.Series) -> pd.Series:
        return pd.Series([rebuild(t, p, lab, d, list(zip(a, s, r)), k) for t, p, lab, d, a, s, r, k in zip(text, page, label, drop, at, seen, real, keep)], dtype=object)

    ints, texts = F.array().cast("array<int>"), F.array().cast("array<string>")
    whole_ = blocks.join(lines, key, "left").join(fixes, key, "left").join(compounds, key, "left")
    done = whole_.withColumn("repaired", repaired("text", "page", "label", F.coalesce("drop", ints), F.coalesce("fixes.line", ints), F.coalesce("fixes.token", texts), F.coalesce("fixes.real", texts), F.coalesce("compounds", ints)))
    return done.select(*key, "text", "repaired", (F.col("text") != F.col("repaired")).alias("changed"))


def repaired_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_blocks(blocks_of(spark, sf_dir))
