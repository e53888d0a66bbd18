"""Evidence records and requests for extraction."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.text import col, dense_codes
from folioforge.operators.prefix import neighbour, running
from folioforge.operators.tables import html_outside, html_table, markdown_table

WINDOW, STEP, DENSE = 3000, 2800, 700
MAX_CHARS, MAX_RECORDS = 6000, 8


def windows(text: str | Column, size: int = WINDOW, step: int = STEP) -> Column:
    """array<struct<offset, text>>: windows that overlap by size - step; an empty text is one empty window."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(col(text)) - 1, F.lit(0)), F.lit(step))
    return F.transform(starts, lambda s: F.struct(s.alias("offset"), F.substr(col(text), s + 1, F.lit(size)).alias("text")))


def dense_pieces(text: str | Column, size: int = DENSE) -> Column:
    """array<string>: whole lines gathered up to size; a longer line is a piece of its own. Null stays null."""

    @F.pandas_udf("array<string>")
    def gather(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else gathered(t, size) for t in texts], dtype=object)

    return gather(col(text))


def gathered(text: str, size: int = DENSE) -> list[str]:
    out: list[str] = []
    held, length = [], 0
    for line in re.findall(r"[^\n]*\n|[^\n]+$", text):
        if held and length + len(line) > size:
            out.append("".join(held))
            held, length = [], 0
        held.append(line)
        length += len(line)
    return [*out, "".join(held)] if held else out


def is_dense(text: str | Column) -> Column:
    return (dense_codes(text) >= 20) & col(text).contains("\n")


def text_records(blocks: DataFrame) -> DataFrame:
    """(doc_stem, chunk_id, page, block_order, id, part, text) of the texts: dense ones by lines, others by windows."""
    plain = F.transform(windows("text"), lambda w: w["text"])
    return blocks.where("text is not null").select("doc_stem", "chunk_id", "page", "block_order", "id", F.posexplode(F.coalesce(dense_pieces(F.when(is_dense("text"), F.col("text"))), plain)).alias("part", "text"))


def budgeted(blocks: DataFrame, budget: int) -> DataFrame:
    """Adds kept: how many characters of each paragraph fit into its chunk's budget, in reading order; those that do not
    begin within it are left out."""
    before = running(blocks.withColumn("_len", F.length("text").cast("long")), ["doc_stem", "chunk_id"], "page", ["block_order", "id"], {"_upto": F.col("_len")}, "sum")
    start = F.col("_upto") - F.col("_len")
    return before.where(start < budget).withColumn("kept", F.least(F.col("_len"), F.lit(budget) - start)).drop("_len", "_upto")


def continued_tables(tables: DataFrame) -> DataFrame:
    """Adds continues: the id of the table before in the chunk, if that has headers, this has none and begins on the next page."""
    me = F.struct("id", "page", F.col("headed"))
    out = neighbour(tables, ["doc_stem", "chunk_id"], "page", ["block_order", "id"], me, "_prev")
    hint = F.col("_prev.headed") & ~F.col("headed") & (F.col("page") == F.col("_prev.page") + 1)
    return out.withColumn("continues", F.when(hint, F.col("_prev.id"))).drop("_prev")


PACKED = "doc_stem string, chunk_id string, id string, part int, size int, pack int"


def pack(records: DataFrame, max_chars: int = MAX_CHARS, max_records: int = MAX_RECORDS) -> DataFrame:
    """Adds pack, from 1 in each chunk: records in order go into a pack until it would exceed its size or number; dense
    records stand alone.

    records: doc_stem, chunk_id, page, block_order, id, part, size, dense. Where a pack ends depends on all before it in
    its chunk, so a chunk is walked in one task, as a stream of sizes with constant memory; no texts are moved.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, no, count, chars, lone = None, 0, 0, 0, False
        for f in batches:
            packs = []
            for doc, chunk, size, dense in zip(f["doc_stem"], f["chunk_id"], f["size"], f["dense"]):
                if (doc, chunk) != key:
                    key, no, count, chars, lone = (doc, chunk), 1, 0, 0, False
                elif count and (chars + size > max_chars or count >= max_records or dense or lone):
                    no, count, chars, lone = no + 1, 0, 0, False
                count, chars, lone = count + 1, chars + size, lone or bool(dense)
                packs.append(no)
            yield f[["doc_stem", "chunk_id", "id", "part", "size"]].assign(pack=packs)

    order = ["doc_stem", "chunk_id", "page", "block_order", "id", "part"]
    return records.select(*order, "size", "dense").repartition("doc_stem", "chunk_id").sortWithinPartitions(*order).mapInPandas(walk, PACKED)


BUCKETS = ("specifications", "product_cards", "paragraphs", "tables")
RECORD = "doc_stem string, chunk_id string, bucket int, page int, block_order int, id string, version string, part int, kind int, record string"
TEXT, DENSE_TEXT, ROW = range(3)
_code = re.compile(r"\d{4,5}[A-Z]\d{2,4}")
_tag = re.compile(r"<[^>]*>")


def _json(x: dict) -> str:
    return json.dumps(x, ensure_ascii=False)


def _cut(make: Callable[[str, int], dict], value: str, whole: bool, max_chars: int) -> list[dict]:
    """Records of a value that hold it all, none longer than max_chars as JSON: windows of 3,000 characters, shorter ones
    only where escapes make those too long. whole: a value within the window is not cut."""
    size = WINDOW
    while size > WINDOW - STEP:
        starts = [0] if whole and len(value) <= size else range(0, max(1, len(value)), size - (WINDOW - STEP))
        made = [make(value[s : s + size], s) for s in starts]
        if all(len(_json(x)) <= max_chars for x in made):
            return made
        size //= 2
    return []


def text_pieces(base: dict, text: str, start: int = 0, max_chars: int = MAX_CHARS) -> list[dict]:
    """Records of a text: whole lines up to DENSE characters where it is dense in codes, windows otherwise."""
    dense = len(_code.findall(text)) >= 20 and "\n" in text
    pieces, at, pending = [], start, ""
    for line in text.splitlines(keepends=True) if dense else ():
        if pending and len(pending) + len(line) > DENSE:
            pieces.append((pending, at))
            at, pending = at + len(pending), ""
        pending += line
    mark = {"dense_text": True} if dense else {}
    out = []
    for piece, at in pieces + [(pending, at)] if dense else [(text, start)]:
        make = lambda v, s, at=at: {**base, "text": v, "offset": at + s, **mark}
        # a dense piece is whole lines and stays one record if it fits
        made = [make(piece, 0)] if dense and len(_json(make(piece, 0))) <= max_chars else _cut(make, piece, False, max_chars)
        if not made:
            raise ValueError(f"oversized evidence record: {base['block_id']}")
        out += made
    return out


def named_row(keys: list[str], cells: list[str]) -> dict[str, str]:
    """Cells by column; cells beyond the names are col_k, and a repeated name gets its place, so that no cell is lost."""
    row = {}
    for k, cell in enumerate(cells):
        name = keys[k] if k < len(keys) else f"col_{k}"
        while name in row:
            name += f" [{k + 1}]"
        row[name] = cell
    return row


def block_evidence(block: str, page: int | None, bucket: int, text: str) -> list[tuple[int, dict]]:
    """(kind, record) of a block: of a table its rows, with what stands beside the table as text; otherwise its text."""
    base = {"block_id": block, "page": page, "kind": BUCKETS[bucket]}
    texts = lambda start, end: [(DENSE_TEXT if "dense_text" in x else TEXT, x) for x in text_pieces(base, text[start:end], start)]
    if bucket == 3:
        printed, keys, rows = html_table(text)
        if rows:
            headers, (start, end) = keys if printed else [], html_outside(text)
        else:
            keys, rows, start, end = markdown_table(text)
            headers = keys
        if rows:
            beside = lambda a, b: texts(a, b) if _tag.sub(" ", text[a:b]).strip() else []
            return beside(0, start) + [(ROW, {**base, "headers": headers, "row": named_row(keys, r)}) for r in rows] + beside(end, len(text))
    return texts(0, len(text))


def row_fragments(record: dict, max_chars: int = MAX_CHARS) -> list[dict]:
    """A row too long for one record, as records of neighbouring columns: long cells go by windows, and a last short cell
    before a cut is repeated after it. Lists of headers that leave no room are left out; the rows name their columns."""
    full = {k: v for k, v in record.items() if k != "row"}
    for base in (full, {k: v for k, v in full.items() if k not in ("headers", "previous_headers")}):
        pieces = []
        for c, v in record["row"].items():
            made = _cut(lambda x, s, c=c, v=v: {**base, "row": {c: x}, "cell_offsets": {c: s}, "cell_lengths": {c: len(v)}}, v, True, max_chars)
            if not made:
                break
            pieces += made
        else:
            break
    else:
        raise ValueError(f"oversized table cell: {record['block_id']}")
    inner = ("row", "cell_offsets", "cell_lengths")
    out, pending = [], pieces[0]
    for x in pieces[1:]:
        joined = {**pending, **{k: {**pending[k], **x[k]} for k in inner}}
        if next(iter(x["cell_offsets"].values())) == 0 and not set(x["row"]) & set(pending["row"]) and len(_json(joined)) <= max_chars:
            pending = joined
            continue
        out.append(pending)
        last = list(pending["row"])[-1]
        # a window of the same cell is led in by its own overlap
        repeat = last not in x["row"] and len(pending["row"][last]) < 500
        led = {**x, **{k: {last: pending[k][last], **x[k]} for k in inner}} if repeat else x
        pending = led if len(_json(led)) <= max_chars else x
    return out + [pending]


def evidence_records(blocks: DataFrame) -> DataFrame:
    """Records (JSON) of the specifications, product cards, paragraphs and table rows of every chunk; a type that is not
    known is a paragraph. Headings and figures, null texts and blocks without a chunk give none."""
    kind = F.coalesce("type", F.lit("paragraph"))
    bucket = F.when(kind == "specification", 0).when(kind == "product_card", 1).when(kind == "table", 3).otherwise(2)
    names = [x.split()[0] for x in RECORD.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = lambda rows: pd.DataFrame(rows, columns=names).astype({"page": "Int64", "block_order": "Int64"})
        for f in batches:
            rows = []
            for doc, chunk, b, page, order, id_, text in zip(f["doc_stem"], f["chunk_id"], f["bucket"], f["page"], f["block_order"], f["id"], f["text"]):
                page, order = (None if pd.isna(x) else int(x) for x in (page, order))
                version = hashlib.blake2b(text.encode(), digest_size=8).hexdigest()
                rows += [(doc, chunk, b, page, order, id_, version, n, k, _json(x)) for n, (k, x) in enumerate(block_evidence(id_, page, b, text))]
                if len(rows) >= 5000:
                    yield frame(rows)
                    rows = []
            if rows:
                yield frame(rows)

    wanted = blocks.where("chunk_id is not null and text is not null").where(~kind.isin("heading", "figure"))
    return wanted.select("doc_stem", "chunk_id", bucket.alias("bucket"), "page", "block_order", "id", "text").mapInPandas(parse, RECORD)


PACKED_EVIDENCE = "doc_stem string, chunk_id string, pack int, records int, chars long, evidence string"


def packed_evidence(records: DataFrame, max_chars: int = MAX_CHARS, max_records: int = MAX_RECORDS) -> DataFrame:
    """Packs of each chunk's records, by bucket and in reading order, with their evidence as a JSON list; sizes are those of
    the records as JSON, and a dense record stands alone.

    A table without headers that begins on the page after the table before it in the chunk names that table and its
    headers; rows too long are cut into fragments. Repeated deliveries of a block count once. A chunk is walked in one
    task, which holds one pack."""
    names = [x.split()[0] for x in PACKED_EVIDENCE.split(", ")]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = seen = table = before = hint = None
        no, group, chars, lone = 1, [], 0, False

        def close():
            return (*key, no, len(group), chars, "[" + ", ".join(group) + "]")

        for f in batches:
            done = []
            for doc, chunk, b, page, id_, version, part, kind, record in zip(f["doc_stem"], f["chunk_id"], f["bucket"], f["page"], f["id"], f["version"], f["part"], f["kind"], f["record"]):
                if (doc, chunk) != key:
                    if group:
                        done.append(close())
                    key, seen, table, before, hint = (doc, chunk), None, None, None, None
                    no, group, chars, lone = 1, [], 0, False
                page = None if pd.isna(page) else int(page)
                if (me := (b, page, id_, version, part)) == seen:
                    continue
                seen = me
                if kind == ROW:
                    if table != (id_, version):
                        headers = json.loads(record)["headers"]
                        follows = before and not headers and before[0] is not None and page == before[0] + 1
                        hint = {"possible_continuation_of": before[1], "previous_headers": before[2]} if follows else None
                        table, before = (id_, version), (page, id_, headers)
                    if hint:
                        x = json.loads(record)
                        record = _json({**{k: x.pop(k) for k in ("block_id", "page", "kind")}, **hint, **x})
                for piece in [record] if len(record) <= max_chars else map(_json, row_fragments(json.loads(record), max_chars)):
                    if group and (chars + len(piece) > max_chars or len(group) >= max_records or kind == DENSE_TEXT or lone):
                        done.append(close())
                        no, group, chars = no + 1, [], 0
                    group, chars, lone = group + [piece], chars + len(piece), kind == DENSE_TEXT
            if done:
                yield pd.DataFrame(done, columns=names)
        if group:
            yield pd.DataFrame([close()], columns=names)

    order = ["doc_stem", "chunk_id", "bucket", "page", "block_order", "id", "version", "part"]
    return records.repartition("doc_stem", "chunk_id").sortWithinPartitions(*order).mapInPandas(walk, PACKED_EVIDENCE)


def requests(packs: DataFrame) -> DataFrame:
    """One request per pack of packed_evidence: request_id, doc_stem, chunk_id, continuation, parts, records, context (JSON)."""
    made = packs.withColumn("parts", F.max("pack").over(Window.partitionBy("doc_stem", "chunk_id")))
    context = F.format_string('{"continuation": %d, "parts": %d, "evidence": %s}', "pack", "parts", "evidence")
    return made.select(F.concat("chunk_id", F.lit("__part"), F.col("pack").cast("string")).alias("request_id"), "doc_stem", "chunk_id", F.col("pack").alias("continuation"), "parts", "records", context.alias("context"))


def trimmed_rows(rows: str | Column, n: int = 20) -> Column:
    """struct<rows, truncated>: the first n rows of a table and how many were left out."""
    return F.struct(F.slice(col(rows), 1, n).alias("rows"), F.greatest(F.size(col(rows)) - n, F.lit(0)).alias("truncated"))


def fragments(headers: str | Column, cells: str | Column, max_chars: int = MAX_CHARS, size: int = WINDOW, step: int = STEP) -> Column:
    """array<array<struct<column, offset, length, text>>> of a row too long for one record: long cells go by windows,
    neighbouring columns together while they fit, and the last short cell before a cut is repeated after it."""

    @F.pandas_udf("array<array<struct<column:string,offset:int,length:int,text:string>>>")
    def parts(keys: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([column_groups(k, v, max_chars, size, step) for k, v in zip(keys, values)], dtype=object)

    return parts(col(headers), col(cells))


def column_groups(keys: list[str], values: list[str], max_chars: int, size: int, step: int) -> list[list[dict]]:
    """The windows of a row's cells in groups that fit, in one pass."""
    weight = lambda x: len(x["text"]) + len(x["column"]) + 6
    groups: list[list[dict]] = []
    held, names = 0, set()
    for key, value in zip(keys, values):
        for at in range(0, max(1, len(value)), step):
            x = {"column": key, "offset": at, "length": len(value), "text": value[at : at + size]}
            if groups and at == 0 and key not in names and held + weight(x) <= max_chars:
                groups[-1].append(x)
            else:
                last = groups[-1][-1] if groups else None
                again = last is not None and len(last["text"]) < 500 and len(last["text"]) + len(x["text"]) + 100 <= max_chars and last["column"] != key
                groups.append([last, x] if again else [x])
                held, names = weight(last) if again else 0, {last["column"]} if again else set()
            held += weight(x)
            names.add(key)
    return groups
