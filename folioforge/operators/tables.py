"""Tables in block texts to rows, and codes in rows. Keys and cells stay parallel arrays, because some rules go by position."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import col, let, plain_lines

MAX_COLSPAN, MAX_ROWSPAN = 100, 1000

# Column headers that name article codes, those of the distributor, other printed headers, and non-codes.
CODE_HEADER = r"(?:metric\s+|imperial\s+)?(?:item\s*(?:#|number|no\.?)\s*\*?|sku|part\s*(?:number|no\.?|#)|article\s*(?:number|no\.?|#)|stock\s*(?:number|no\.?|#)|order\s*codes?|catalog(?:ue)?\s*(?:number|no\.?|#))"
DISTRIBUTOR_HEADER = r"(?:stock\s*(?:number|no\.?|#)|order\s*codes?)"
PRINTED_HEADER = r"(?:metric\s+|imperial\s+)?(?:item\s*#|sku|part\s*(?:number|no\.?|#)|article\s*(?:number|no\.?|#)|(?:mfg\.?|mfr\.?)\s*part\s*(?:number|no\.?|#)|model|description|details|price(?:\s+each)?|dimensions|weight\*?|material|length|width|height|size)"
BAND_HEADER = r"(?:\d+(?:-\d+)?\+?\s+)?(?:list\s+)?price(?:\s+each)?(?:\s+\d+(?:-\d+)?\+?)?"
CURRENCY_HEADERS = ("$", "€", "£", "¥", "￥", "RMB", "CNY", "USD", "EUR", "GBP", "JPY", "INR")
NO_CODES = ("n/a", "none", "na", "new", "see", "call", "contact", "each")
CODE = r"[A-Za-z0-9][A-Za-z0-9./_ -]*"
# Codes that slip into other columns, the mark of a new row, headings that name a model, codes and prices run
# together in a cell, headers of descriptions, models and prices, and the currencies of headers and prefixes.
DISPLACED_CODE = r"^[A-Z]{2,6}\d{2,6}(?:/[A-Z0-9]{1,4})?$"
BADGE, BADGE_SIGNS, BADGE_CELLS = "NEW", ("$", "€", "£"), 4
HEADING_MODEL = r"(?i)^model\s*(?:(?:number|no\.?|#)\s*)?[:=]?\s+([A-Za-z0-9][A-Za-z0-9./_-]*)$"
INLINE_CODE = r"\d{4,5}[A-Z]\d{2,5}"
INLINE_PRICE = r"^\s*([$€£])?\s*(\d+(?:,\d{3})*\.\d{2})\s*$"
NAME_HEADERS, MODEL_HEADERS = ("description", "product name"), ("model",)
PRICE_HEADERS = {"usd": "USD", "eur": "EUR", "€": "EUR", "gbp": "GBP", "£": "GBP", "rmb": "CNY", "cny": "CNY", "jpy": "JPY", "inr": "INR", "aud": "AUD", "$": None, "¥": None, "price": None, "list price": None}
PRICE_PREFIX = r"(?i)^(USD|EUR|GBP|JPY|CNY|INR|AUD)\b"
SIGN_CURRENCIES = {"$": "USD", "€": "EUR", "£": "GBP"}
#: Cells that look like article codes, and the share of a column's cells that must, in tables that name no code column.
CELL_PRICE = r"^([$€£])\s*((?:\d{1,3}(?:,\d{3})+|\d+)\.\d{2})$"
CONTENT_CODE, CONTENT_SHARE = r"^[A-Za-z]{2,6}[0-9]{3,}[A-Za-z0-9]*$", 0.6


def markdown_rows(text: str | Column) -> Column:
    """array<struct<headers, cells>> of the first pipe table of a text: rows are padded or cut to the headers, separator
    lines and empty rows are left out; null without a header and a row."""
    lines = F.filter(F.split(plain_lines(text), "\n"), lambda x: F.trim(x) != "")
    no_table = F.lit(None).cast("array<struct<headers:array<string>,cells:array<string>>>")

    def block(lines: Column) -> Column:
        piped = F.transform(lines, lambda x: x.contains("|"))
        return let(F.array_position(piped, True).cast("int"), lambda first: F.when(first > 0, let(F.slice(lines, F.greatest(first, F.lit(1)), F.size(lines) + 1), upto_plain)))

    def upto_plain(rest: Column) -> Column:
        stop = F.array_position(F.transform(rest, lambda x: x.contains("|")), False).cast("int")
        return let(stop, lambda at: F.when(at == 0, rest).otherwise(F.slice(rest, F.lit(1), F.greatest(at - 1, F.lit(0)))))

    def split_cells(found: Column) -> Column:
        data = F.filter(found, lambda x: ~x.rlike(r"^\s*\|?[\s\-:]+(\|[\s\-:]+)*\|?\s*$"))
        return F.transform(data, lambda x: F.transform(F.split(F.regexp_replace(F.regexp_replace(F.trim(x), r"^\|", ""), r"\|$", ""), r"\|"), lambda v: F.trim(v)))

    def rows(cells: Column) -> Column:
        return let(F.try_element_at(cells, F.lit(1)), lambda headers: F.filter(F.transform(F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1))), lambda c: F.struct(headers.alias("headers"), F.transform(headers, lambda _, i: F.coalesce(F.get(c, i), F.lit(""))).alias("cells"))), lambda r: F.exists(r["cells"], lambda v: v != "")))

    found = let(let(lines, block), lambda b: F.when(F.size(b) >= 2, let(split_cells(b), rows)).otherwise(no_table))
    return F.when(col(text).contains("|"), let(found, lambda r: F.when(F.size(r) > 0, r)))


class _Grid(HTMLParser):
    """Rows of the first table; nested tables count as cell text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.done, self.rows, self.row, self.cell = 0, False, [], None, None

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if tag == "table":
            self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self.close_row()
            self.row = []
        elif self.depth == 1 and tag in ("td", "th"):
            self.close_cell()
            if self.row is None:
                self.row = []
            self.cell = [tag, dict(attrs), []]
        elif tag == "br" and self.cell:
            self.cell[2].append(" ")

    def handle_endtag(self, tag):
        if self.done:
            return
        if tag == "table" and self.depth:
            self.depth -= 1
            if not self.depth:
                self.close_row()
                self.done = True
        elif self.depth == 1 and tag == "tr":
            self.close_row()
        elif self.depth == 1 and tag in ("td", "th"):
            self.close_cell()

    def handle_data(self, data):
        if self.cell is not None and not self.done:
            self.cell[2].append(data)

    def close_cell(self):
        if self.cell is not None:
            self.row.append((self.cell[0], self.cell[1], " ".join(" ".join(self.cell[2]).split())))
            self.cell = None

    def close_row(self):
        self.close_cell()
        if self.row:
            self.rows.append(self.row)
        self.row = None


def _span(value, most: int) -> int:
    try:
        return max(1, min(most, int(value)))
    except (TypeError, ValueError):
        return 1


def html_grid(text: str) -> tuple[list[dict[int, str]], int]:
    """The table with its spans filled in, as column -> text per row, and the number of leading header rows."""
    parser = _Grid()
    parser.feed(text)
    parser.close()
    parser.close_row()
    grid, open_, heads = [], {}, 0
    for cells in parser.rows:
        row = {}
        for at in list(open_):
            value, left = open_[at]
            row[at] = value
            open_[at] = (value, left - 1)
            if left == 1:
                del open_[at]
        at = 0
        for _, attrs, value in cells:
            while at in row:
                at += 1
            wide, high = _span(attrs.get("colspan"), MAX_COLSPAN), _span(attrs.get("rowspan"), MAX_ROWSPAN)
            for k in range(at, at + wide):
                row[k] = value
                if high > 1:
                    open_[k] = (value, high - 1)
            at += wide
        if heads == len(grid) and all(tag == "th" for tag, _, _ in cells):
            heads += 1
        grid.append(row)
    return grid, heads


_is_code = re.compile(CODE_HEADER, re.I).fullmatch
_is_printed = re.compile(PRINTED_HEADER, re.I).fullmatch
_is_band = re.compile(BAND_HEADER, re.I).fullmatch
_is_count = re.compile(r"\d+(?:-\d+)?\+?").fullmatch


def names_column(value: str) -> bool:
    v = value.strip()
    return bool(_is_code(v) or _is_printed(v) or _is_band(v) or v.upper() in CURRENCY_HEADERS)


def header_rows(grid: list[dict[int, str]], heads: int) -> list[int]:
    """Indices of the header rows: leading all-header rows, else the row with most column names, wherever it stands, and
    label rows beside it. Rows that tie must be equal."""
    if heads:
        return list(range(heads))
    named = [sum(map(names_column, row.values())) for row in grid]
    able = [i for i, row in enumerate(grid) if named[i] >= 2 and (i == 0 or any(_is_code(v.strip()) for v in row.values()))]
    best = [i for i in able if named[i] == max(named[k] for k in able)]
    if not best or any(grid[i] != grid[best[0]] for i in best):
        return []
    found = set(best)
    for i in (best[0] - 1, best[0] + 1):
        values = [v for v in grid[i].values() if v] if 0 <= i < len(grid) else []
        if any(map(names_column, values)) and all(names_column(v) or _is_count(v) for v in values):
            found.add(i)
    return sorted(found)


def html_table(text: str | None) -> tuple[bool, list[str], list[list[str]]]:
    """Whether the first HTML table prints headers, its column names (col_0, col_1 ... without) and its distinct rows."""
    if not text or "<table" not in text.lower():
        return False, [], []
    grid, heads = html_grid(text)
    if not grid:
        return False, [], []
    top = header_rows(grid, heads)
    width = max(max(row, default=-1) for row in grid) + 1
    keys: list[str] = []
    for k in range(width):
        parts = list(dict.fromkeys(grid[i].get(k, "") for i in top if grid[i].get(k)))
        name = " / ".join(parts) or f"col_{k}"
        keys.append(f"{name} [{k + 1}]" if name in keys else name)
    rows = [tuple(row.get(k, "") for k in range(width)) for i, row in enumerate(grid) if i not in top and any(row.values())]
    return bool(top), keys, [list(r) for r in dict.fromkeys(rows)]


def html_rows(text: str | None) -> list[tuple[list[str], list[str]]]:
    """(headers, cells) of the distinct rows of the first HTML table; headers are col_0, col_1 ... where none are printed."""
    _, keys, rows = html_table(text)
    return [(keys, r) for r in rows]


def html_outside(text: str) -> tuple[int, int]:
    """Where the first HTML table of a text begins and ends."""
    depth = 0
    first = re.search(r"(?i)<table\b", text)
    for m in re.finditer(r"(?i)<(/?)table\b[^>]*>?", text):
        depth += -1 if m[1] else 1
        if m[1] and depth == 0:
            return first.start(), m.end()
    return (first.start() if first else 0), len(text)


_is_rule = re.compile(r"\s*\|?[\s\-:]+(\|[\s\-:]+)*\|?\s*").fullmatch


def markdown_table(text: str) -> tuple[list[str], list[list[str]], int, int]:
    """Headers, rows and place in the text of its first pipe table. Rows are padded to the headers; a row with more cells
    keeps them, so it can be longer than the headers."""
    found, at = [], 0
    for line in text.splitlines(keepends=True):
        if "|" in line:
            found.append((at, at + len(line), line.splitlines()[0]))
        elif found and line.strip():
            break
        at += len(line)
    data = [x.strip().removeprefix("|").removesuffix("|") for _, _, x in found if not _is_rule(x)]
    cells = [[v.strip() for v in x.split("|")] for x in data]
    rows = [c + [""] * (len(cells[0]) - len(c)) for c in cells[1:] if any(c)]
    return (cells[0], rows, found[0][0], found[-1][1]) if rows else ([], [], 0, 0)


TABLE_ROW = "doc_stem string, id string, method string, row_no int, headers array<string>, cells array<string>"


def table_rows(blocks: DataFrame) -> DataFrame:
    """Rows of the tables in block texts: HTML first, then Markdown, else the text as one row under 'raw_text'.

    The guard on '<table' keeps other texts away from Python. Blank texts give no rows."""
    html = F.lower(F.col("text")).contains("<table")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for doc, id_, text in zip(frame["doc_stem"], frame["id"], frame["text"]):
                rows = html_rows(text)
                out += [(doc, id_, "html", n, keys, cells) for n, (keys, cells) in enumerate(rows)] or [(doc, id_, "raw", 0, ["raw_text"], [text.strip()])]
            yield pd.DataFrame(out, columns=["doc_stem", "id", "method", "row_no", "headers", "cells"])

    base = blocks.where("trim(text) <> ''").select("doc_stem", "id", "text")
    by_html = base.where(html).mapInPandas(parse, TABLE_ROW)
    other = base.where(~html).withColumn("_m", markdown_rows("text"))
    raw = F.array(F.struct(F.array(F.lit("raw_text")).alias("headers"), F.array(F.trim("text")).alias("cells")))
    method = F.when(F.col("_m").isNotNull(), "markdown").otherwise("raw")
    by_text = other.select("doc_stem", "id", method.alias("method"), F.posexplode(F.coalesce("_m", raw)).alias("row_no", "r")).select("doc_stem", "id", "method", "row_no", "r.headers", "r.cells")
    return by_html.unionByName(by_text)


# ---------------------------------------------------------------- codes in rows


def _pairs(headers: Column, cells: Column) -> Column:
    return F.zip_with(headers, cells, lambda k, v: F.struct(k.alias("k"), v.alias("v")))


def realigned(headers: str | Column, cells: str | Column) -> Column:
    """array<struct<k, v>> of a row; a leading NEW badge that shifted all cells by one is taken out."""
    k, v = col(headers), col(cells)
    at = lambda a, i: F.trim(F.coalesce(F.get(a, F.lit(i)), F.lit("")))
    shifted = (
        (F.size(k) >= BADGE_CELLS) & at(k, 0).rlike(f"(?i)^{CODE_HEADER}$") & (F.upper(at(v, 0)) == BADGE) & at(k, 1).isin(*BADGE_SIGNS)
        & at(v, 1).rlike(DISPLACED_CODE) & at(v, 2).startswith(at(k, 1))
    )
    less = F.greatest(F.size(k) - 1, F.lit(0))
    return F.when(shifted, _pairs(F.slice(k, F.lit(1), less), F.slice(v, F.lit(2), less))).otherwise(_pairs(k, v))


def code_cells(row: Column) -> Column:
    """Values of the code columns of a row; a distributor's column goes before a maker's."""
    own = F.filter(row, lambda c: F.trim(c["k"]).rlike(f"(?i)^{DISTRIBUTOR_HEADER}$"))
    any_ = F.filter(row, lambda c: F.trim(c["k"]).rlike(f"(?i)^{CODE_HEADER}$"))
    return F.transform(F.when(F.size(own) > 0, own).otherwise(any_), lambda c: c["v"])


def row_codes(headers: str | Column, cells: str | Column) -> Column:
    """Codes of a row in order: those of its code columns, then slash variants of them that stand in other cells."""
    row = realigned(headers, cells)
    plain = F.filter(code_cells(row), lambda v: v.rlike(f"^{CODE}$") & ~F.trim(v).rlike(f"(?i)^{CODE_HEADER}$") & ~F.lower(F.trim(v)).isin(*NO_CODES))
    codes = F.array_distinct(F.transform(plain, lambda x: F.trim(x)))
    variants = F.filter(F.transform(row, lambda c: c["v"]), lambda v: F.exists(codes, lambda c: v.startswith(F.concat(c, F.lit("/"))) & F.substr(v, F.length(c) + 2).rlike("^[A-Za-z0-9]{1,4}$")))
    return F.array_union(codes, variants)


def spilled_codes(headers: str | Column, cells: str | Column) -> Column:
    """Codes displaced into anonymous columns that share the letters of a code of the row."""
    codes = row_codes(headers, cells)
    letters = F.filter(F.transform(codes, lambda c: F.regexp_extract(c, "^[A-Z]+", 0)), lambda p: p != "")
    loose = F.filter(_pairs(col(headers), col(cells)), lambda c: c["k"].rlike(r"^col_\d+$") & F.trim(c["v"]).rlike(DISPLACED_CODE))
    values = F.filter(F.transform(loose, lambda c: F.trim(c["v"])), lambda v: F.array_contains(letters, F.regexp_extract(v, "^[A-Z]+", 0)))
    return F.array_except(F.array_distinct(values), codes)


def heading_model(path: str | Column) -> Column:
    """The code of the innermost heading of the form 'Model No. X'."""
    hits = F.filter(F.transform(F.reverse(col(path)), lambda h: F.regexp_extract(F.trim(h), HEADING_MODEL, 1)), lambda m: m != "")
    return F.get(hits, F.lit(0))


def inline_pairs(headers: str | Column, cells: str | Column, code: str = INLINE_CODE) -> Column:
    """array<struct<code, amount, currency>>: codes run together with their prices in a cell, or followed by a cell that
    holds nothing but the price. In rows with code columns only those are searched. Other places prove nothing."""
    row = realigned(headers, cells)
    own = F.filter(row, lambda c: F.trim(c["k"]).rlike(f"(?i)^{CODE_HEADER}$"))
    values = F.transform(F.when(F.size(own) > 0, own).otherwise(row), lambda c: F.coalesce(c["v"], F.lit("")))
    head = rf"(?<![A-Za-z0-9])(?={code}(?![A-Za-z0-9]))"

    def of_cell(value: Column, after: Column) -> Column:
        pieces = F.split(value, head)
        found = F.transform(pieces, lambda p, i: F.struct(F.regexp_extract(p, f"^({code})", 1).alias("code"), F.trim(F.regexp_replace(p, f"^{code}", "")).alias("rest"), (i + 1 == F.size(pieces)).alias("last")))
        priced = F.transform(found, lambda x: F.struct(x["code"].alias("code"), F.when((x["rest"] == "") & x["last"], after).otherwise(x["rest"]).alias("price")))
        return F.filter(priced, lambda x: (x["code"] != "") & x["price"].rlike(INLINE_PRICE))

    pairs = F.flatten(F.transform(values, lambda v, i: of_cell(v, F.trim(F.coalesce(F.get(values, i + 1), F.lit(""))))))
    signs = F.create_map(*[F.lit(x) for pair in SIGN_CURRENCIES.items() for x in pair])
    return F.array_distinct(F.transform(pairs, lambda x: F.struct(x["code"].alias("code"), F.regexp_extract(x["price"], INLINE_PRICE, 2).alias("amount"), F.try_element_at(signs, F.regexp_extract(x["price"], INLINE_PRICE, 1)).alias("currency"))))


def content_codes(rows: DataFrame) -> DataFrame:
    """(doc_stem, id, row_no, code) of tables that name no code column: cells of the columns most of whose cells look like
    codes. A table without printed headers may begin with such a row; its headers are then row -1. Columns are counted by
    an aggregation, so a table of any length is spread over tasks."""
    named = F.exists("headers", lambda h: F.trim(h).rlike(f"(?i)^{CODE_HEADER}$"))
    plain = rows.where(~named & (F.col("method") != "raw"))
    cells = plain.select("doc_stem", "id", "row_no", F.posexplode("cells").alias("_at", "_v"))
    heads = plain.groupBy("doc_stem", "id").agg(F.min("headers").alias("_h")).select("doc_stem", "id", F.lit(-1).alias("row_no"), F.posexplode("_h").alias("_at", "_v"))
    codes = cells.unionByName(heads).withColumn("_v", F.trim("_v")).withColumn("_like", F.col("_v").rlike(CONTENT_CODE))
    columns = codes.where("row_no >= 0").groupBy("doc_stem", "id", "_at").agg(F.avg(F.col("_like").cast("double")).alias("_share")).where(F.col("_share") >= CONTENT_SHARE).drop("_share")
    return codes.where("_like").join(columns, ["doc_stem", "id", "_at"], "left_semi").select("doc_stem", "id", "row_no", F.col("_v").alias("code"))


def named_codes(rows: DataFrame) -> DataFrame:
    """(doc_stem, id, row_no, code) of code columns, with variants and displaced codes."""
    codes = F.array_union(row_codes("headers", "cells"), spilled_codes("headers", "cells"))
    return rows.select("doc_stem", "id", "row_no", F.explode(codes).alias("code"))


def table_codes(rows: DataFrame) -> DataFrame:
    """(doc_stem, id, row_no, code): the codes of all table rows, by the names of columns or else by what stands in them."""
    return named_codes(rows).unionByName(content_codes(rows)).distinct()


def content_prices(rows: DataFrame) -> DataFrame:
    """(doc_stem, id, row_no, code, amount, currency): the price of each coded row that holds just one cell with a price."""
    signs = F.create_map(*[F.lit(x) for pair in SIGN_CURRENCIES.items() for x in pair])
    prices = F.filter(F.transform("cells", lambda v: F.trim(v)), lambda v: v.rlike(CELL_PRICE))
    one = rows.select("doc_stem", "id", "row_no", prices.alias("_p")).where(F.size("_p") == 1).withColumn("_p", F.col("_p")[0])
    priced = one.select("doc_stem", "id", "row_no", F.replace(F.regexp_extract("_p", CELL_PRICE, 2), F.lit(","), F.lit("")).alias("amount"), F.try_element_at(signs, F.regexp_extract("_p", CELL_PRICE, 1)).alias("currency"))
    return table_codes(rows).join(priced, ["doc_stem", "id", "row_no"])
