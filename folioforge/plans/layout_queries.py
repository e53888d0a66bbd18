"""Queries from recognized pages to typed blocks, sections and chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.functions.text import plain_lines
from folioforge.operators import layout, outline
from folioforge.operators import hierarchy
from folioforge.plans.problems import WALK
from folioforge.plans.common import BLOCKS, PAGES, blocks, outlined, pages, rounded, sql_lines, sql_strip
from folioforge.runtime import table


def q_page_blocks(spark, sf_dir):
    b = layout.page_blocks(pages(spark, sf_dir))
    return b.select("doc_stem", "id", "page", F.col("pos").cast("bigint").alias("pos"), "label", F.length("text").cast("bigint").alias("chars"), F.array_join(F.col("bbox").cast("array<bigint>").cast("array<string>"), ",").alias("corners"))


def q_block_type(spark, sf_dir):
    b = blocks(spark, sf_dir)
    return b.select("doc_stem", "id", layout.semantic_type("source_type", "text").alias("semantic_type"), layout.card_score(plain_lines("text")).cast("bigint").alias("card_score"))


def q_heading_level(spark, sf_dir):
    b = blocks(spark, sf_dir).where("type = 'heading'")
    return b.select("doc_stem", "id", layout.heading_level("source_type", "text").cast("bigint").alias("level"), layout.block_name("text", "type", "block_order").alias("name"))


def q_reading_order(spark, sf_dir):
    return layout.reading_order(blocks(spark, sf_dir, "page", "bbox", "block_order")).select("doc_stem", "id", F.col("place").cast("bigint").alias("place"))


def q_section_path(spark, sf_dir):
    return outline.section_paths(outlined(spark, sf_dir)).select("doc_stem", "id", F.array_join("path", " > ").alias("path"))


def q_container(spark, sf_dir):
    return outline.attach_to_containers(blocks(spark, sf_dir, "page", "type", "bbox", "block_order")).select("doc_stem", "id", "container")


def q_chunks(spark, sf_dir):
    return outline.chunks(outlined(spark, sf_dir)).select("doc_stem", "id", "chunk_no")


def q_chunk_summary(spark, sf_dir):
    """Blocks of each chunk by type, empty chunks left out."""
    b = outline.chunks(outlined(spark, sf_dir))
    kinds = ("heading", "table", "figure", "product_card", "specification", "paragraph")
    return b.groupBy("doc_stem", "chunk_no").agg(*[F.count(F.when(F.col("type") == k, 1)).alias(k) for k in kinds], F.min("page").alias("page")).where(" + ".join(kinds[1:]) + " > 0")


def q_score_join(spark, sf_dir):
    p = pages(spark, sf_dir)
    return layout.join_scores(layout.page_blocks(p), layout.page_boxes(p)).select("doc_stem", "id", "confidence")


def q_page_role(spark, sf_dir):
    return outline.page_roles(blocks(spark, sf_dir))


def q_index_entries(spark, sf_dir):
    b = blocks(spark, sf_dir).select("doc_stem", "id", F.posexplode(outline.index_entries(plain_lines("text"))).alias("pos", "e"))
    return b.select("doc_stem", "id", F.col("pos").cast("bigint").alias("pos"), "e.title", F.col("e.printed_page").cast("bigint").alias("printed_page"))


def q_markdown_blocks(spark, sf_dir):
    """Markdown of each page (its headings, tables and texts) back into blocks, counted by kind."""
    b = blocks(spark, sf_dir).select("doc_stem", "id", F.explode(layout.markdown_blocks("text")).alias("m"))
    return b.groupBy("doc_stem", "id", F.col("m.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("m.text")).alias("chars"))


def q_box_geometry(spark, sf_dir):
    """Width, height, centre and gap to the block above on the page."""
    b = layout.reading_order(blocks(spark, sf_dir, "page", "bbox", "block_order")).where("bbox is not null").select("doc_stem", "id", "page", "place", layout.box("bbox").alias("bbox"))
    from pyspark.sql import Window

    above = F.lag("bbox").over(Window.partitionBy("doc_stem", "page").orderBy("place"))
    out = b.withColumn("_above", above).select(
        "doc_stem", "id", F.greatest(F.lit(0.0), F.col("bbox")[2] - F.col("bbox")[0]).alias("width"), F.greatest(F.lit(0.0), F.col("bbox")[3] - F.col("bbox")[1]).alias("height"),
        ((F.col("bbox")[0] + F.col("bbox")[2]) / 2).alias("centre"), (F.col("bbox")[1] - F.col("_above")[3]).alias("gap"), F.when(F.col("_above").isNotNull(), outline.overlap("_above", "bbox")).alias("overlap"),
    )
    return rounded(out, "width", "height", "centre", "gap", "overlap")


def q_dynamic(spark, sf_dir):
    return outline.dynamic_sections(blocks(spark, sf_dir)).select("doc_stem", "id", "level", F.array_join("section_path", " > ").alias("section_path"), "chunk_no")


def q_extraction_roles(spark, sf_dir):
    """What each block is read for, and whether it gives content."""
    b = outline.with_roles(blocks(spark, sf_dir, "page", "type", "source_type", "text"))
    return b.select("doc_stem", "id", "page_role", "extraction_role")


def q_hierarchy_chunks(spark, sf_dir):
    raw = table(spark, sf_dir, "semantic_blocks")
    tree = hierarchy.hierarchy(raw.select("doc_stem", "id", "page", "block_order", "parent_id", "children_ids"))
    return outline.hierarchy_chunks(raw.select("doc_stem", "id", "page", "block_order", "type", F.when(F.col("type") == "heading", F.col("text")).alias("text")), tree).select("doc_stem", "id", F.col("chunk_no").cast("bigint").alias("chunk_no"), F.array_join("section_path", " > ").alias("section_path"))


def q_typed_stream(spark, sf_dir):
    """Blocks of the pages that hold a heading, by type and level, as the stream types them."""
    from folioforge.streaming.ingest import typed_blocks

    return typed_blocks(pages(spark, sf_dir)).groupBy("type", "level").agg(F.count(F.lit(1)).alias("n"))


def queries():
    return {
        "q56_dynamic_sections": q_dynamic, "q57_typed_blocks": q_typed_stream, "q58_extraction_roles": q_extraction_roles, "q59_hierarchy_chunks": q_hierarchy_chunks,
        "q07_page_blocks": q_page_blocks, "q08_block_type": q_block_type, "q09_heading_level": q_heading_level, "q10_reading_order": q_reading_order,
        "q11_section_path": q_section_path, "q12_container_attach": q_container, "q13_chunk_segment": q_chunks, "q14_score_join": q_score_join,
        "q43_index_entries": q_index_entries, "q44_page_role": q_page_role, "q46_chunk_summary": q_chunk_summary, "q47_markdown_blocks": q_markdown_blocks, "q48_box_geometry": q_box_geometry,
    }


def _in(names):
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


_T = "t"
_TYPED = f"typed as (select *, coalesce(lower({sql_strip('source_type')}), '') l, {sql_lines('text')} t from blocks)"
_KV = f"len(regexp_extract_all(t, '{layout.KEY_VALUE}'))"
_LS = "list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
_SPEC = f"({_KV} >= 2 or (len({_LS}) >= 3 and len(list_filter({_LS}, lambda x: contains(x, ':'))) >= 2))"


def _words(pattern: str) -> str:
    """The pattern with word ends that letters of all scripts continue."""
    head, _, tail = pattern.rpartition(r"\b")
    return head.replace(r"\b", r"(?:^|[^\pL\pN_])") + r"(?:[^\pL\pN_]|$)" + tail


_SCORE = f"(regexp_matches(t, '{layout.PRICE}')::int + regexp_matches(t, '{_words(layout.DIMENSION)}')::int + regexp_matches(t, '{_words(layout.MODEL_TOKEN)}')::int + (len(t) - len(replace(t, chr(10), '')) >= 2)::int + {_SPEC}::int)"
_LEVEL = f"""case when t like '#%' then length(regexp_extract(t, '^#+'))
  when regexp_matches(t, '^(\\d+(?:\\.\\d+)*)\\.?\\s+[A-Za-z]') then least(6, 1 + length(regexp_replace(regexp_extract(t, '^(\\d+(?:\\.\\d+)*)\\.?\\s+[A-Za-z]', 1), '[^.]', '', 'g')))
  when l = 'paragraph_title' and lower(t) in {_in(layout.DETAIL_TITLES)} then 3
  when l in {_in(layout.TOP_LEVEL)} then 1 when l in {_in(layout.SECOND_LEVEL)} then 2
  when t <> '' and len(string_split_regex(t, '\\s+')) <= 6 and length(t) <= 60 then 2 else 3 end"""
_KIND = f"""case when l in {_in(layout.HEADINGS)} then 'heading' when l in {_in(layout.TABLES)} then 'table' when l in {_in(layout.FIGURES)} then 'figure' when l in {_in(layout.PRODUCTS)} then 'product_card'
  when l in {_in(layout.SPECIFICATIONS)} then 'specification' when t like '#%' then 'heading' when t <> '' and {_SCORE} >= 3 then 'product_card' when {_SPEC} then 'specification' else 'paragraph' end"""
_PLACE = "printf('%06d.%06d.', coalesce(page, 0), coalesce(block_order, 0)) || id"
_SECTIONS = ",\n".join(f"max(case when type = 'heading' and lv = {n} then {_PLACE} end) over w h{n}" for n in range(1, 7))
_OPEN = ", ".join(
    f"case when h{n} is not null" + (f" and (greatest({', '.join(f'h{k}' for k in range(1, n))}) is null or h{n} > greatest({', '.join(f'h{k}' for k in range(1, n))}))" if n > 1 else "") + f" then substr(h{n}, 15) end" for n in range(1, 7)
)
_GAP = "(bbox[2] - cbox[4])"
_H = "greatest(0, {0}[4] - {0}[2])"
_REACH = f"greatest(60, {_H.format('cbox')} * 1.8, {_H.format('bbox')} * 1.2)"
_OVER = "coalesce(greatest(0, least({0}[3], {1}[3]) - greatest({0}[1], {1}[1])) / least(greatest(1, {0}[3] - {0}[1]), greatest(1, {1}[3] - {1}[1])), 0)"
_CHROME = _in(layout.CHROME)
_ENTRY = r"(?m)^([^\n]+?)[ \t]*(?:\.{2,}|[ \t]{3,})[ \t]*(\d+)[ \t]*$"
_CHUNKED = f"""content as (select *, case when type = 'heading' then lower(trim(text)) end h from blocks where coalesce(source_type, '') not in {_CHROME}),
  named as (select *, last_value(h ignore nulls) over (partition by doc_stem order by coalesce(page, 0), block_order, id rows between unbounded preceding and 1 preceding) b from content),
  chunked as (select *, (sum((h is not null and (b is null or b <> h))::int) over (partition by doc_stem order by coalesce(page, 0), block_order, id rows unbounded preceding))::bigint chunk_no from named)"""


_ROLES = rf"""x as (select *, coalesce(text, '') t, trim(coalesce(text, '')) s, type = 'heading' hd from blocks),
  p as (select doc_stem, page, bool_or(hd and regexp_matches(s, '(?i)^((table of )?contents|index)$')) it,
    coalesce(bool_or(type in ('product_card', 'specification') or regexp_matches(t, '(?i)\b(SKU|article number|part (?:no|number))\b|[$€£]\s*\d') or (hd and regexp_matches(s, '^[A-Za-z]{{1,8}}[-/]?\d+[\w/.-]*$'))), false) e,
    bool_or(type = 'table') tb, bool_or(hd) hs, count(*) n, sum(length(t)) c, sum(len(regexp_extract_all(t, '(?m)^(.+?)\s*(?:\.{{2,}}|\s{{3,}})\s*(\d+)\s*$'))) en,
    bool_and(coalesce(type in ('heading', 'figure') or source_type in {_CHROME}, false)) bare, bool_or(regexp_matches(t, '(?i)catalog(?:ue)?|edition')) ti from x group by 1, 2),
  r as (select *, case when it and en >= 2 and not e then 'index' when e and it then 'mixed' when e then 'product' when not tb and c + n - 1 < 500 and hs and n <= 5 and page = 1 and ti then 'cover'
    when not tb and c + n - 1 < 500 and hs and n <= 5 and bare then 'section_divider' else 'uncertain' end role from p)"""
_READ = rf"""read_for as (select x.doc_stem, x.id, r.role page_role, case when x.source_type in {_CHROME} then 'page_chrome' when hd and regexp_matches(s, '(?i)^((table of )?contents|index|chapters|sections)$') then 'navigation'
    when coalesce(r.it, false) and regexp_matches(s, '^.+?\s*\.{{2,}}\s*\d+$') then 'index_entry' else 'content' end extraction_role from x join r on r.doc_stem = x.doc_stem and r.page = x.page)"""


def oracle_sql():
    kinds = ("heading", "table", "figure", "product_card", "specification", "paragraph")
    return {
        "q07_page_blocks": f"with {PAGES}, x as (select doc_stem, page_index + 1 page, unnest(parsing_res_list) b, generate_subscripts(parsing_res_list, 1) - 1 pos from pages) select doc_stem, printf('p%d_b%03d', page, pos) id, page, pos, b.block_label as label, length(b.block_content) chars, array_to_string(b.block_bbox, ',') corners from x",
        "q08_block_type": f"""with {BLOCKS}, {_TYPED} select doc_stem, id, {_SCORE} card_score,
  {_KIND} semantic_type from typed""",
        "q57_typed_blocks": f"""with {PAGES}, blocks as (select b.block_label source_type, b.block_content text from (select unnest(parsing_res_list) b from pages)), {_TYPED}, k as (select l, t, {_KIND} as "type" from typed)
  select "type", case when "type" = 'heading' then {_LEVEL} end as "level", count(*) n from k group by 1, 2""",
        "q09_heading_level": f"with {BLOCKS}, {_TYPED} select doc_stem, id, {_LEVEL} as level, coalesce(nullif(trim(regexp_replace(string_split(t, chr(10))[1], '^#+', '')), ''), type || '-' || block_order) as name from typed where type = 'heading'",
        "q10_reading_order": f"with {BLOCKS} select doc_stem, id, row_number() over (partition by doc_stem, page order by block_order nulls first, coalesce(bbox[2], 1e9), coalesce(bbox[1], 1e9), id) place from blocks",
        "q11_section_path": f"""with {BLOCKS}, {_TYPED}, lev as (select *, least(case when heading_level > 0 then heading_level else {_LEVEL} end, 6) lv from typed),
  s as (select doc_stem, id, {_SECTIONS} from lev window w as (partition by doc_stem order by coalesce(page, 0), block_order, id rows unbounded preceding))
  select doc_stem, id, array_to_string(list_filter([{_OPEN}], lambda x: x is not null), ' > ') path from s""",
        "q12_container_attach": f"""with {BLOCKS},
  a as (select *, last_value(case when type = 'product_card' then id end ignore nulls) over w cid, last_value(case when type = 'product_card' then {{'b': bbox}} end ignore nulls) over w cb from blocks
    window w as (partition by doc_stem, page order by block_order, id rows unbounded preceding)),
  b as (select *, cb.b cbox from a),
  c as (select *, type not in ('heading', 'product_card') plain, coalesce(type not in ('heading', 'product_card') and cid is not null and {_GAP} >= -5 and {_GAP} <= {_REACH} and ({_OVER.format('cbox', 'bbox')} >= 0.2 or (type in ('specification', 'paragraph', 'table') and {_GAP} <= {_REACH} * 0.8)), false) fits from b),
  d as (select *, coalesce(max((coalesce(plain and not fits and {_GAP} > 250, false))::int) over (partition by doc_stem, page, cid order by block_order, id rows between unbounded preceding and 1 preceding), 0) dead from c)
  select doc_stem, id, case when fits and dead = 0 then cid end container from d""",
        "q13_chunk_segment": f"with {BLOCKS}, {_CHUNKED} select doc_stem, id, chunk_no from chunked",
        "q46_chunk_summary": f"with {BLOCKS}, {_CHUNKED}, s as (select doc_stem, chunk_no, {', '.join(f'count(*) filter (type = {k!r}) as {chr(34)}{k}{chr(34)}' for k in kinds)}, min(page) page from chunked group by 1, 2) select * from s where " + " + ".join(f'"{k}"' for k in kinds[1:]) + " > 0",
        "q14_score_join": f"""with {PAGES},
  b as (select doc_stem, page_index + 1 page, printf('p%d_b%03d', page_index + 1, pos) id, b.block_bbox bb from (select doc_stem, page_index, unnest(parsing_res_list) b, generate_subscripts(parsing_res_list, 1) - 1 pos from pages)),
  x as (select doc_stem, page_index + 1 page, rank, x.score score, x.coordinate c from (select doc_stem, page_index, unnest(layout_det_res.boxes) x, generate_subscripts(layout_det_res.boxes, 1) - 1 rank from pages)),
  j as (select b.doc_stem, b.id, rank, score, case
    when round_even(bb[1], 0) = round_even(c[1], 0) and round_even(bb[2], 0) = round_even(c[2], 0) and round_even(bb[3], 0) = round_even(c[3], 0) and round_even(bb[4], 0) = round_even(c[4], 0) then 0
    when round_even(bb[1] / 5.0, 0) = round_even(c[1] / 5.0, 0) and round_even(bb[2] / 5.0, 0) = round_even(c[2] / 5.0, 0) and round_even(bb[3] / 5.0, 0) = round_even(c[3] / 5.0, 0) and round_even(bb[4] / 5.0, 0) = round_even(c[4] / 5.0, 0) then 1
    when abs(bb[1] - c[1]) <= 3 and abs(bb[2] - c[2]) <= 3 and abs(bb[3] - c[3]) <= 3 and abs(bb[4] - c[4]) <= 3 then 2 end tier
    from b join x on b.doc_stem = x.doc_stem and b.page = x.page and abs(bb[1] - c[1]) <= 6 and abs(bb[2] - c[2]) <= 6),
  p as (select doc_stem, id, score, row_number() over (partition by doc_stem, id order by tier, rank) n from j where tier is not null)
  select b.doc_stem, b.id, p.score confidence from b left join p on b.doc_stem = p.doc_stem and b.id = p.id and p.n = 1""",
        "q43_index_entries": f"with {BLOCKS}, x as (select doc_stem, id, {sql_lines('text')} t from blocks), y as (select doc_stem, id, unnest(regexp_extract_all(t, '{_ENTRY}', 1)) a, unnest(regexp_extract_all(t, '{_ENTRY}', 2)) b, generate_subscripts(regexp_extract_all(t, '{_ENTRY}', 1), 1) - 1 pos from x) select doc_stem, id, pos, trim(a) title, try_cast(b as int) printed_page from y",
        "q44_page_role": f"with {BLOCKS}, {_ROLES} select doc_stem, page, role, case when role = 'uncertain' then 'low' else 'high' end confidence, en::bigint entries from r",
        "q58_extraction_roles": f"with {BLOCKS}, {_ROLES}, {_READ} select doc_stem, id, page_role, extraction_role from read_for",
        "q56_dynamic_sections": rf"""with recursive {BLOCKS}, {_ROLES}, {_READ},
  kept as (select k.*, row_number() over (partition by doc_stem order by coalesce(page, 0), coalesce(block_order, 0), id) g from (select b.*, page_role from blocks b join read_for using (doc_stem, id) where page_role not in ('cover', 'index') and extraction_role = 'content') k),
  h as (select doc_stem, id, g, page, source_type l, coalesce(text, '') t, {sql_strip("lower(coalesce(text, ''))")} k, coalesce(heading_level, 2) given, bbox, row_number() over (partition by doc_stem order by g) n,
    list_transform(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN]+'), lambda w: w not in {_in(outline.SMALL_WORDS)}), lambda w: case when w like '___%ves' then w[:-4] || 'f' when w like '___%ies' then w[:-4] || 'y' when w like '_%_sses' then w[:-3] when w like '_%_xes' then w[:-3] when w like '_%_ches' then w[:-3] when w like '_%_shes' then w[:-3] when w like '%ss' then w when w like '_%_s' then w[:-2] else w end) st from kept where type = 'heading'),
  walk as (select doc_stem, 0::bigint n, 0 lv, true begins, []::struct(l int, t varchar, k varchar)[] op, 0::bigint mn from h group by 1
    union all select doc_stem, n, lv, begins, case when begins then list_append(list_filter(op, lambda o: o.l < lv), {{'l': lv, 't': t, 'k': k}}) else op end, case when begins and lv <= 2 and has then n else mn end from (
      select x.doc_stem, x.n, x.t, x.k, w.op, w.mn, x.bbox is not null has, coalesce(w.op[-1].t <> x.t, true) begins, case when w.op[-1].t = x.t then w.op[-1].l
        when x.l is distinct from 'paragraph_title' then x.given
        when x.k in {_in(outline.DETAIL_TITLES)} then case when len(w.op) = 0 or w.op[-1].k in {_in(outline.DETAIL_TITLES)} then 3 else greatest(3, w.op[-1].l + 1) end
        when regexp_matches(x.t, '^\d+(?:\.\d+)*\.?\s+') then x.given
        when len(w.op) > 0 and x.k <> w.op[-1].k and contains(w.op[-1].k, x.k) then w.op[-1].l + 1
        when m.page = x.page and list_has_any(m.st, x.st) and x.bbox[2] > m.bbox[2] + 30 and x.bbox[3] - x.bbox[1] < 0.7 * (m.bbox[3] - m.bbox[1]) then 3 else 2 end lv
      from walk w join h x on x.doc_stem = w.doc_stem and x.n = w.n + 1 left join h m on m.doc_stem = w.doc_stem and m.n = w.mn)),
  hs as (select h.*, w.lv, w.begins, list_transform(w.op, lambda o: o.t) path from walk w join h on h.doc_stem = w.doc_stem and h.n = w.n),
  pt as (select k.doc_stem, k.id, k.g, k.page_role, hs.lv, max(case when hs.begins then k.g end) over v sec, max(hs.g) over v hg from kept k left join hs on hs.doc_stem = k.doc_stem and hs.id = k.id window v as (partition by k.doc_stem order by k.g)),
  pl as (select *, row_number() over (partition by doc_stem, sec order by g) = 1 fst from pt where page_role <> 'section_divider')
  select pl.doc_stem, pl.id, pl.lv "level", coalesce(array_to_string(hs.path, ' > '), '') section_path, (sum(fst::int) over (partition by pl.doc_stem order by pl.g))::int chunk_no from pl left join hs on hs.doc_stem = pl.doc_stem and hs.g = pl.hg""",
        "q59_hierarchy_chunks": WALK + """, k as (select doc_stem, id, max(type) ty, max(case when type = 'heading' then trim(text) end) tx, min(page) pg, min(block_order) bo from semantic_blocks group by 1, 2),
  step as (select w.doc_stem, w.id, i, w.path[i] t from (select *, unnest(generate_series(1, len(path))) i from walk) w),
  named as (select s.doc_stem, s.id, list(printf('%09d.%09d.', coalesce(k.pg, 0), coalesce(k.bo, 0)) || s.t order by i) so, list(k.tx order by i) filter (k.ty = 'heading') titles from step s join k on k.doc_stem = s.doc_stem and k.id = s.t group by 1, 2),
  a as (select w.doc_stem, w.id, w.path[-2] parent, w.path[-3] grand, k.ty, u.ty above, g.ty top, n.so, n.titles from walk w join k on k.doc_stem = w.doc_stem and k.id = w.id join named n on n.doc_stem = w.doc_stem and n.id = w.id
    left join k u on u.doc_stem = w.doc_stem and u.id = w.path[-2] left join k g on g.doc_stem = w.doc_stem and g.id = w.path[-3]),
  o as (select *, case when ty = 'heading' then id when above = 'heading' then parent when above = 'product_card' and top = 'heading' and ty in ('specification', 'table', 'paragraph') then grand when parent is null and ty in ('table', 'specification', 'product_card') then id end own from a),
  c as (select doc_stem, id, row_number() over (partition by doc_stem order by so) chunk_no, case when ty = 'heading' then coalesce(array_to_string(titles, ' > '), '') else '(unlabelled)' end section_path from o where own = id)
  select o.doc_stem, o.id, c.chunk_no, c.section_path from o join c on c.doc_stem = o.doc_stem and c.id = o.own""",
        "q47_markdown_blocks": rf"""with {BLOCKS}, x as (select doc_stem, id, string_split({sql_lines('text')}, chr(10)) ls from blocks), y as (select doc_stem, id, unnest(ls) line, generate_subscripts(ls, 1) n from x),
  k as (select doc_stem, id, n, trim(line) t, case when trim(line) = '' then 'blank' when regexp_matches(line, '^\s*#') then 'heading' when regexp_matches(line, '^\s*\|') then 'table' when regexp_matches(line, '^\s*([-*+]|\d+\.)\s') then 'list' else 'paragraph' end kind from y),
  g as (select *, coalesce(lag(kind) over w = kind and kind in ('table', 'paragraph'), false) joined from k window w as (partition by doc_stem, id order by n)),
  s as (select *, sum((not joined)::int) over (partition by doc_stem, id order by n) part from g), p as (select doc_stem, id, kind, part, string_agg(t, chr(10) order by n) t from s where kind <> 'blank' group by 1, 2, 3, 4)
  select doc_stem, id, kind, count(*) n, sum(length(t))::bigint chars from p group by 1, 2, 3""",
        "q48_box_geometry": f"""with {BLOCKS}, o as (select *, row_number() over (partition by doc_stem, page order by block_order nulls first, coalesce(bbox[2], 1e9), coalesce(bbox[1], 1e9), id) place from blocks),
  a as (select *, lag({{'b': bbox}}) over (partition by doc_stem, page order by place) ab from o where bbox is not null)
  select doc_stem, id, round(greatest(0, bbox[3] - bbox[1]), 6) width, round(greatest(0, bbox[4] - bbox[2]), 6) height, round((bbox[1] + bbox[3]) / 2, 6) centre, round(bbox[2] - ab.b[4], 6) gap, case when ab is not null then round({_OVER.format('ab.b', 'bbox')}, 6) end overlap from a""",
    }
