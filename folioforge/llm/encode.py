"""Encoding of a corpus with a public byte-level BPE vocabulary, as a streaming transducer.

Text goes through in windows. A pre-token is closed once the pattern cannot extend it; one of the vocabulary is its own
token, every other one, of any length, is encoded byte by byte: the encoding of a prefix ends in exactly one token that is
compatible with the one before it, so each position needs one back pointer. Which positions can still be continued follows
from the merges: those from which the text so far begins a token that merges can make, never farther back than the longest
of these. Where all their paths agree, tokens are stable and are given out; memory stays constant. A bounded memo keeps
the ids of short pre-tokens.
"""

from __future__ import annotations

import base64
import codecs
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.runtime import table

#: Default vocabulary; another file of the same format can be named instead. Files are read where they lie.
VOCABULARY = "byte_bpe_50k.tiktoken"
WINDOW = 1 << 14
#: Entries of the memo, and the longest pre-tokens it holds; longer ones are encoded each time.
MEMO, MEMO_LENGTH = 400_000, 256
#: Bytes of a pre-token after which its stable tokens are given out.
SETTLE = 512

# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str = VOCABULARY) -> str:
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words = {v: k for k, v in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.pattern = regex.compile(PATTERN)
        self.memo: dict[str, tuple[int, ...]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.made: dict[int, bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Merges the pair of lowest rank, the leftmost first, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def reachable(self, token: int) -> bool:
        """Whether merges make the token of its bytes; others stand for whole pre-tokens only."""
        known = self.made.get(token)
        if known is None:
            known = self.made[token] = self.merge(self.words[token]) == [token]
        return known

    def compatible(self, a: int, b: int) -> bool:
        key = (a, b)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= MEMO:
                self.fits.clear()
            known = self.fits[key] = self.merge(self.words[a] + self.words[b]) == [a, b]
        return known

    @cached_property
    def lookahead(self) -> int:
        """Bytes behind a position after which no merge can change what lies before it: one less than the longest token that
        merges make. Read from the merge list when the first long pre-token comes."""
        sizes = sorted(self.ranks, key=len, reverse=True)
        return max(1, next((len(w) for w in sizes if self.reachable(self.ranks[w])), 1) - 1)

    @cached_property
    def beginnings(self) -> frozenset[bytes]:
        """Proper beginnings of the tokens."""
        return frozenset(w[:n] for w in self.ranks for n in range(1, len(w)))

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        ids = self.memo.get(word)
        if ids is None:
            data = word.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                ids = (whole,)
            else:
                prefixes = Prefixes(self)
                ids = (*prefixes.feed(data), *prefixes.close())
            if len(self.memo) < MEMO and len(word) <= MEMO_LENGTH:
                self.memo[word] = ids
        return ids


class Prefixes:
    """Incremental encoding of one pre-token; feed() gives the tokens that became stable."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.tail = b""  # the last bytes, as many as the longest token has
        self.base = 0  # position of the first entry of back
        self.back: list[tuple[int, int]] = [(-1, -1)]  # position -> (token that ends there, position before it)
        self.end = 0
        self.given = 0  # position up to which tokens were given out

    def feed(self, data: bytes) -> Iterator[int]:
        v = self.v
        for n in range(len(data)):
            self.tail = (self.tail + data[n : n + 1])[-v.longest :]
            self.end += 1
            found = None
            for length in range(min(len(self.tail), self.end - self.base), 0, -1):
                token = v.ranks.get(self.tail[-length:])
                if token is None:
                    continue
                before = self.end - length
                previous = self.back[before - self.base][0]
                if v.reachable(token) if previous == -1 else previous != -2 and v.compatible(previous, token):
                    found = (token, before)
                    break
            self.back.append(found if found is not None else (-2, self.end))
            if self.end - self.given >= SETTLE and self.end % v.longest == 0:
                yield from self.settle()

    def settle(self) -> Iterator[int]:
        """Gives out what all positions that can still be continued agree on."""
        v, end = self.v, self.end
        first = max(self.base, end - v.lookahead)
        live = {p for p in range(first, end) if self.back[p - self.base][0] != -2 and self.tail[p - end :] in v.beginnings} | ({end} if self.back[-1][0] != -2 else set())
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(self.back[last - self.base][1])
        shared = live.pop()
        if shared > self.given:
            yield from self.path(shared)
            keep = self.back[shared - self.base :]
            self.back, self.base = keep, shared
            self.given = shared

    def path(self, end: int) -> list[int]:
        out = []
        while end > self.given:
            token, end = self.back[end - self.base]
            out.append(token)
        return out[::-1]

    def close(self) -> list[int]:
        return self.path(self.end)


def encode_stream(v: Vocabulary, chunks: Iterable[str]) -> Iterator[int]:
    """Token ids of a text given in chunks of any size; equal to encoding the whole text at once."""
    held, source, more = "", iter(chunks), True
    while more or held:
        while more and len(held) < WINDOW:
            piece = next(source, None)
            if piece is None:
                more = False
            else:
                held += piece
        at = 0
        while at < len(held):
            m = v.pattern.match(held, at)
            # a match is closed if the text goes on behind it, past the pattern's lookahead
            if more and m.end() > len(held) - 4:
                break
            yield from v.word_ids(m[0])
            at = m.end()
        if at == 0 and more:
            # one open pre-token fills the window: stream what is certain of it and go on with its kind of characters
            held, tokens = open_run(v, held, source)
            yield from tokens
            continue
        held = held[at:]


def open_run(v: Vocabulary, held: str, source: Iterator[str]) -> tuple[str, Iterator[int]]:
    """Streams a pre-token longer than the window; gives the text behind it and its tokens."""
    first = held[1] if held[0] == " " and not held[1].isspace() else held[0]
    kind = regex.compile(r"\p{L}+" if regex.match(r"\p{L}", first) else r"\p{N}+" if regex.match(r"\p{N}", first) else r"\s+" if first.isspace() else r"[^\s\p{L}\p{N}]+")
    prefixes, out = Prefixes(v), []
    m = kind.match(held, 1 if held[0] == " " and not first.isspace() else 0)
    while m is not None and m.end() == len(held):
        piece = next(source, None)
        if piece is None:
            out += prefixes.feed(held.encode())
            out += prefixes.close()
            return "", iter(out)
        # the last blank of a run belongs to the next word if one follows
        out += prefixes.feed(held[:-1].encode())
        held = held[-1] + piece
        m = kind.match(held)
    end = m.end() if m else 0
    if first.isspace() and end > 1:
        end -= 1
    elif first.isspace() and end == 1:
        end = 0
    out += prefixes.feed(held[:end].encode())
    out += prefixes.close()
    return held[end:], iter(out)


def encode(v: Vocabulary, text: str | None) -> list[int]:
    """Ids of a text; an empty list for an empty or null one."""
    if not text:
        return []
    if len(text) <= WINDOW:
        memo, out = v.memo, []
        for word in v.pattern.findall(text):
            ids = memo.get(word)
            out += v.word_ids(word) if ids is None else ids
        return out
    return list(encode_stream(v, (text[i : i + WINDOW] for i in range(0, len(text), WINDOW))))


def decode_stream(v: Vocabulary, ids: Iterable[int]) -> Iterator[str]:
    """Text of ids as far as its characters are complete; a character torn at the end comes out as U+FFFD."""
    state = codecs.getincrementaldecoder("utf-8")("replace")
    for i in ids:
        if text := state.decode(v.words[i]):
            yield text
    if text := state.decode(b"", True):
        yield text


@lru_cache(maxsize=4)
def loaded(path: str) -> Vocabulary:
    return Vocabulary(path)


def ids_column(text: Column, vocabulary: str = VOCABULARY) -> Column:
    path = vocabulary_path(vocabulary)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pd.Series) -> pd.Series:
        v = loaded(path)
        return pd.Series([encode(v, t) for t in texts], dtype=object)

    return ids(text)


def token_count_column(text: Column, vocabulary: str = VOCABULARY) -> Column:
    path = vocabulary_path(vocabulary)

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        v = loaded(path)
        return pd.Series([len(encode(v, t)) for t in texts], dtype="int64")

    return count(text)


def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document; no special tokens, an empty list for empty and null texts. No shuffle."""
    return table(spark, sf_dir, "documents").select("doc_id", ids_column(F.col("text")).alias("ids"))


def document_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_ids, exact): whether the decoded ids are the text again; a null text counts as an empty one."""
    path = vocabulary_path()

    @F.pandas_udf(T.StringType())
    def decoded(ids: pd.Series) -> pd.Series:
        v = loaded(path)
        return pd.Series(["".join(decode_stream(v, x)) for x in ids], dtype=object)

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", ids_column(F.col("text")).alias("ids"))
    return docs.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), (decoded("ids") == F.coalesce("text", F.lit(""))).alias("exact"))
