"""Queries of the table, evidence and reply operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators import evidence, extract, outline, replies, tables
from folioforge.plans.common import BLOCKS, blocks, once, sql_lines
from folioforge.plans.record_queries import P, R, products, runs
from folioforge.runtime import cut, table


def q_windows(spark, sf_dir):
    d = once(spark, sf_dir, "documents", "doc_id", "text").where("text is not null")
    return d.select("doc_id", F.explode(evidence.windows("text")).alias("w")).select("doc_id", F.col("w.offset").cast("bigint").alias("offset"), F.length("w.text").cast("bigint").alias("chars"), F.md5("w.text").alias("digest"))


def _texts(spark, sf_dir):
    return blocks(spark, sf_dir).where("chunk_id is not null and text is not null and type = 'paragraph'")


def q_budget(spark, sf_dir):
    return evidence.budgeted(_texts(spark, sf_dir), 1500).select("doc_stem", "id", "kept")


def _records(spark, sf_dir):
    r = evidence.text_records(_texts(spark, sf_dir))
    return r.withColumn("size", F.length("text")).withColumn("dense", evidence.is_dense("text"))


def q_pack(spark, sf_dir):
    """Packs of each chunk with their records and sizes."""
    return evidence.pack(_records(spark, sf_dir)).groupBy("doc_stem", "chunk_id", "pack").agg(F.count(F.lit(1)).alias("records"), F.sum("size").alias("chars"))


def q_requests(spark, sf_dir):
    """Requests with the evidence of all block types; q31_greedy_pack packs paragraphs by length, as its SQL states."""
    packs = evidence.packed_evidence(evidence.evidence_records(table(spark, sf_dir, "semantic_blocks")))
    return evidence.requests(packs).select("request_id", "doc_stem", "continuation", "parts", tx.prompt_size("context")["tokens"].alias("tokens"))


def _tables(spark, sf_dir):
    b = blocks(spark, sf_dir, "page", "type", "text", "block_order", "chunk_id")
    return b.where("text is not null and (type = 'table' or trim(text) like '|%')")


def rows_of_tables(spark, sf_dir):
    """Rows of all tables, parsed once for the several steps that read them."""
    return cut(tables.table_rows(_tables(spark, sf_dir)), "rows")


def q_continuation(spark, sf_dir):
    t = _tables(spark, sf_dir).where("chunk_id is not null").withColumn("headed", F.col("text").rlike(r"^\s*\|\s*[A-Z]"))
    return evidence.continued_tables(t).select("doc_stem", "id", "continues")


def q_markdown(spark, sf_dir):
    m = _tables(spark, sf_dir).select("doc_stem", "id", F.posexplode(tables.markdown_rows("text")).alias("row_no", "r"))
    return m.select("doc_stem", "id", F.col("row_no").cast("bigint").alias("row_no"), F.array_join("r.headers", "|").alias("headers"), F.array_join("r.cells", "|").alias("cells"))


def q_html(spark, sf_dir):
    rows = tables.table_rows(_tables(spark, sf_dir).where("lower(text) like '%<table%'"))
    return rows.select("doc_stem", "id", "method", F.col("row_no").cast("bigint").alias("row_no"), F.array_join("headers", "|").alias("headers"), F.array_join("cells", "|").alias("cells"))


def q_table_methods(spark, sf_dir):
    """Rows by the way they were read, over all blocks of type table."""
    return tables.table_rows(blocks(spark, sf_dir).where("type = 'table'")).groupBy("method").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_stem", "id").alias("tables"))


def q_row_codes(spark, sf_dir):
    """Codes of the rows of all tables; row -1 is a first row that a table without headers shows as headers."""
    return tables.table_codes(rows_of_tables(spark, sf_dir)).select("doc_stem", "id", F.col("row_no").cast("bigint").alias("row_no"), "code")


def q_table_row_codes(spark, sf_dir):
    """Codes of code columns, and displaced ones, of the rows of all table blocks."""
    rows = tables.table_rows(blocks(spark, sf_dir, "type", "text").where("type = 'table'"))
    return rows.select("doc_stem", "id", "method", F.col("row_no").cast("bigint").alias("row_no"), F.array_join(tables.row_codes("headers", "cells"), ",").alias("codes"), F.array_join(tables.spilled_codes("headers", "cells"), ",").alias("spilled"))


def q_row_prices(spark, sf_dir):
    return tables.content_prices(rows_of_tables(spark, sf_dir)).select("doc_stem", "id", F.col("row_no").cast("bigint").alias("row_no"), "code", "amount", "currency")


def _read(spark, sf_dir):
    paths = outline.dynamic_sections(blocks(spark, sf_dir)).select("doc_stem", "id", "section_path")
    rows = rows_of_tables(spark, sf_dir).join(paths, ["doc_stem", "id"], "left").withColumn("section_path", F.coalesce("section_path", F.array().cast("array<string>")))
    return extract.read_rows(cut(rows, "rows"))


def q_table_products(spark, sf_dir):
    """Products read from table rows without a model, with the section they stand in."""
    return extract.row_products(_read(spark, sf_dir)).select("doc_stem", "id", F.col("row_no").cast("bigint").alias("row_no"), "sku", "name", "way")


def q_table_attributes(spark, sf_dir):
    return extract.row_attributes(_read(spark, sf_dir)).select("doc_stem", "id", F.col("row_no").cast("bigint").alias("row_no"), "entity", "key", "value", "unit")


def q_hybrid_rows(spark, sf_dir):
    """Evidence left for a model, by chunk, with the number of products already read from it."""
    read = _read(spark, sf_dir)
    chunks = _tables(spark, sf_dir).select("doc_stem", "id", "chunk_id").where("chunk_id is not null")
    records = chunks.join(read.select("doc_stem", "id", "row_no"), ["doc_stem", "id"])
    left = extract.hybrid_requests(records, read)
    return left.groupBy("doc_stem", "chunk_id").agg(F.count(F.lit(1)).alias("records"), F.max(F.coalesce(F.size("product_anchors"), F.lit(0))).cast("bigint").alias("anchors"))


def q_replies(spark, sf_dir):
    r = runs(spark, sf_dir)
    return r.select("run_id", replies.reply_state("raw_response").alias("state"), replies.reply_count("raw_response", "products").alias("products"), replies.reply_count("raw_response", "attributes").alias("attributes"))


def _reply_records(member):
    """Records of one kind in the replies of all runs; a reply that only counts its members has none."""
    return lambda spark, sf_dir: replies.reply_records(runs(spark, sf_dir))[member]


def queries():
    return {
        "q29_evidence_windows": q_windows, "q30_paragraph_budget": q_budget, "q31_greedy_pack": q_pack, "q32_table_continuation": q_continuation, "q33_markdown_table": q_markdown,
        "q34_row_codes": q_row_codes, "q35_row_prices": q_row_prices, "q42_response_parse": q_replies, "q45_html_table_rows": q_html, "q51_requests": q_requests, "q52_table_methods": q_table_methods,
        "q53_table_row_codes": q_table_row_codes, "q60_table_products": q_table_products, "q61_table_attributes": q_table_attributes, "q62_hybrid_rows": q_hybrid_rows,
        "q54_reply_products": _reply_records("products"), "q55_reply_attributes": _reply_records("attributes"), "q56_reply_relations": _reply_records("relations"),
    }


_TABLES = "tb as (select * from blocks where text is not null and (type = 'table' or trim(text) like '|%'))"
_TEXTS = "tx as (select * from blocks where chunk_id is not null and text is not null and type = 'paragraph')"
_CELLS = r"list_transform(string_split(regexp_replace(regexp_replace(trim({0}), '^\|', ''), '\|$', ''), '|'), lambda x: trim(x))"
_REC = f"""rec as (select doc_stem, chunk_id, page, block_order, id, unnest(generate_series(0, greatest(length(text) - 1, 0), 2800)) s, text from tx),
  num as (select doc_stem, chunk_id, least(3000, length(text) - s) size, row_number() over (partition by doc_stem, chunk_id order by page, block_order, id, s) n from rec),
  walk as (select doc_stem, chunk_id, n, size, 1 pack, 1 cnt, size as chars from num where n = 1
    union all select w.doc_stem, w.chunk_id, x.n, x.size, case when w.chars + x.size > 6000 or w.cnt >= 8 then w.pack + 1 else w.pack end, case when w.chars + x.size > 6000 or w.cnt >= 8 then 1 else w.cnt + 1 end, case when w.chars + x.size > 6000 or w.cnt >= 8 then x.size else w.chars + x.size end
    from walk w join num x on x.doc_stem = w.doc_stem and x.chunk_id = w.chunk_id and x.n = w.n + 1)"""


_PIPED = " or trim(text) like '|%'"
_MARKDOWN = rf"""l as (select doc_stem, id, lower(text) like '%<table%' html, list_filter(string_split({sql_lines('text')}, chr(10)), lambda x: trim(x) <> '') ls from tb),
  f as (select *, list_position(list_transform(ls, lambda x: contains(x, '|')), true) a from l where list_contains(list_transform(ls, lambda x: contains(x, '|')), true)),
  g as (select *, ls[a:] rest from f), k as (select *, coalesce(nullif(list_position(list_transform(rest, lambda x: contains(x, '|')), false), 0), len(rest) + 1) z from g),
  b as (select doc_stem, id, html, rest[:z - 1] bl from k where z > 2),
  c as (select doc_stem, id, html, list_transform(list_filter(bl, lambda x: not regexp_matches(x, '^\s*\|?[\s\-:]+(\|[\s\-:]+)*\|?\s*$')), lambda y: {_CELLS.format('y')}) cs from b),
  r as (select doc_stem, id, html, cs[1] hd, unnest(cs[2:]) r, generate_subscripts(cs[2:], 1) n from c),
  t as (select doc_stem, id, html, n, hd, list_transform(hd, lambda h, i: coalesce(r[i], '')) cells from r),
  md as (select *, row_number() over (partition by doc_stem, id order by n) - 1 row_no from t where len(list_filter(cells, lambda x: x <> '')) > 0)"""
_HTML = r"""h1 as (select doc_stem, id, list_transform(regexp_extract_all(regexp_extract(text, '(?s)<table.*?</table>'), '(?s)<tr>(.*?)</tr>', 1), lambda r: array_to_string(list_transform(regexp_extract_all(r, '(?s)<td>(.*?)</td>', 1), lambda c: trim(c)), '|')) rs from tb where lower(text) like '%<table%'),
  h2 as (select doc_stem, id, unnest(rs) cs, generate_subscripts(rs, 1) n from h1 where len(rs) > 0), h3 as (select doc_stem, id, cs, min(n) n from h2 group by 1, 2, 3),
  ht as (select doc_stem, id, row_number() over (partition by doc_stem, id order by n) - 1 row_no, list_transform(generate_series(0, len(cs) - len(replace(cs, '|', ''))), lambda i: 'col_' || i) hd, string_split(cs, '|') cells from h3)"""
#: Tables of the data print no code column, so their codes are those of columns that hold codes.
TABLE_CODES = f"""{BLOCKS}, {_TABLES}, {_MARKDOWN}, {_HTML}, tr as (select doc_stem, id, row_no, hd, cells from md where not html union all select doc_stem, id, row_no, hd, cells from ht),
  ce as (select doc_stem, id, row_no, unnest(range(1, len(cells) + 1)) p, trim(unnest(cells)) v from tr union all select doc_stem, id, -1, unnest(range(1, len(hd) + 1)), trim(unnest(hd)) from (select distinct doc_stem, id, hd from tr)),
  co as (select doc_stem, id, p from ce where row_no >= 0 group by 1, 2, 3 having avg(regexp_matches(v, '{tables.CONTENT_CODE}')::int) >= {tables.CONTENT_SHARE}),
  codes as (select distinct ce.doc_stem, ce.id, row_no, v code from ce join co on co.doc_stem = ce.doc_stem and co.id = ce.id and co.p = ce.p where regexp_matches(v, '{tables.CONTENT_CODE}'))"""
_PRICE = tables.CELL_PRICE


def oracle_sql():
    return {
        "q29_evidence_windows": "with d as (select distinct doc_id, text from documents where text is not null), w as (select doc_id, text, unnest(generate_series(0, greatest(length(text) - 1, 0), 2800)) s from d) select doc_id, s::bigint as \"offset\", length(substr(text, s + 1, 3000)) chars, md5(substr(text, s + 1, 3000)) digest from w",
        "q30_paragraph_budget": f"with {BLOCKS}, {_TEXTS}, c as (select *, sum(length(text)) over (partition by doc_stem, chunk_id order by coalesce(page, 0), block_order, id rows unbounded preceding) u from tx) select doc_stem, id, least(length(text), 1500 - (u - length(text)))::bigint kept from c where u - length(text) < 1500",
        "q31_greedy_pack": f"with recursive {BLOCKS}, {_TEXTS}, {_REC} select doc_stem, chunk_id, pack, count(*) records, sum(size)::bigint chars from walk group by 1, 2, 3",
        "q32_table_continuation": rf"""with {BLOCKS}, {_TABLES}, h as (select *, regexp_matches(text, '^\s*\|\s*[A-Z]') headed from tb where chunk_id is not null),
  l as (select *, lag(id) over w pid, lag(page) over w pp, lag(headed) over w ph from h window w as (partition by doc_stem, chunk_id order by coalesce(page, 0), block_order, id))
  select doc_stem, id, case when ph and not headed and page = pp + 1 then pid end as "continues" from l""",
        "q33_markdown_table": f"with {BLOCKS}, {_TABLES}, {_MARKDOWN} select doc_stem, id, row_no, array_to_string(hd, '|') headers, array_to_string(cells, '|') cells from md",
        "q34_row_codes": f"with {TABLE_CODES} select doc_stem, id, row_no, code from codes",
        "q35_row_prices": f"with {TABLE_CODES}, pr as (select doc_stem, id, row_no, list_filter(list_transform(cells, lambda v: trim(v)), lambda v: regexp_matches(v, '{_PRICE}')) ps from tr) select c.doc_stem, c.id, c.row_no, code, replace(regexp_extract(ps[1], '{_PRICE}', 2), ',', '') amount, map {{'$': 'USD', '€': 'EUR', '£': 'GBP'}}[regexp_extract(ps[1], '{_PRICE}', 1)] currency from codes c join pr p on p.doc_stem = c.doc_stem and p.id = c.id and p.row_no = c.row_no where len(ps) = 1",
        "q52_table_methods": f"with {BLOCKS}, {_TABLES.replace(_PIPED, '')}, {_MARKDOWN}, {_HTML}, u as (select doc_stem, id, 'markdown' as \"method\" from md where not html union all select doc_stem, id, 'html' from ht union all select doc_stem, id, 'raw' from tb where trim(text) <> '' and (doc_stem, id) not in (select (doc_stem, id) from md where not html) and (doc_stem, id) not in (select (doc_stem, id) from ht)) select \"method\", count(*) as \"rows\", count(distinct (doc_stem, id)) tables from u group by 1",
        "q53_table_row_codes": f"with {BLOCKS}, {_TABLES.replace(_PIPED, '')}, {_MARKDOWN}, {_HTML}, u as (select doc_stem, id, 'markdown' as \"method\", row_no from md where not html union all select doc_stem, id, 'html', row_no from ht union all select doc_stem, id, 'raw', 0 from tb where trim(text) <> '' and (doc_stem, id) not in (select (doc_stem, id) from md where not html) and (doc_stem, id) not in (select (doc_stem, id) from ht)) select *, '' codes, '' spilled from u",
        "q60_table_products": f"with {TABLE_CODES} select doc_stem, id, row_no, code sku, code \"name\", 'explicit' way from codes where row_no >= 0",
        "q61_table_attributes": f"""with {TABLE_CODES}, own as (select doc_stem, id, row_no, list(code) cs from codes where row_no >= 0 group by 1, 2, 3), x as (select t.*, o.cs, unnest(range(1, len(cells) + 1)) i from tr t join own o on o.doc_stem = t.doc_stem and o.id = t.id and o.row_no = t.row_no)
  select doc_stem, id, row_no, unnest(cs) entity, hd[i] "key", cells[i] "value", null::varchar unit from x where cells[i] <> '' and not list_contains(cs, trim(cells[i])) and lower(trim(hd[i])) not in ('description', 'product name', 'model', 'usd', 'eur', '€', 'gbp', '£', 'rmb', 'cny', 'jpy', 'inr', 'aud', '$', '¥', 'price', 'list price')""",
        "q62_hybrid_rows": f"""with {TABLE_CODES}, ch as (select distinct doc_stem, id, chunk_id from tb where chunk_id is not null), a as (select doc_stem, id, row_no from tr union all select doc_stem, id, 0 from tb where trim(text) <> '' and (doc_stem, id) not in (select (doc_stem, id) from tr)),
  n as (select ch.doc_stem, ch.chunk_id, count(distinct code) anchors from codes c join ch on ch.doc_stem = c.doc_stem and ch.id = c.id where row_no >= 0 group by 1, 2)
  select ch.doc_stem, ch.chunk_id, count(*) records, coalesce(max(n.anchors), 0) anchors from a join ch on ch.doc_stem = a.doc_stem and ch.id = a.id left join n on n.doc_stem = ch.doc_stem and n.chunk_id = ch.chunk_id
  where not exists (select 1 from codes c where c.doc_stem = a.doc_stem and c.id = a.id and c.row_no = a.row_no) group by 1, 2""",
        "q42_response_parse": rf"""with {R}, j as (select run_id, nullif(regexp_extract(regexp_replace(regexp_replace(raw_response, '(?s)<think>.*?</think>', '', 'g'), '```(?:json)?\s*', '', 'g'), '(?s)\{{.*\}}'), '') js from r),
  k as (select run_id, js, replace(regexp_replace(js, ',\s*([}}\]])', '\1', 'g'), chr(39), '"') fixed from j),
  m as (select run_id, case when js is null then 'no_object' when json_valid(js) then 'parsed' when json_valid(fixed) then 'repaired' else 'broken' end state, case when json_valid(js) then js when json_valid(fixed) then fixed end good from k)
  select run_id, state, coalesce(try_cast(json_extract_string(good, '$.products') as bigint), json_array_length(good, '$.products')::bigint) products, coalesce(try_cast(json_extract_string(good, '$.attributes') as bigint), json_array_length(good, '$.attributes')::bigint) attributes from m""",
        "q45_html_table_rows": f"with {BLOCKS}, {_TABLES}, {_HTML} select doc_stem, id, 'html' as \"method\", row_no, array_to_string(hd, '|') headers, array_to_string(cells, '|') cells from ht",
    }
