"""Queries of the quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators import extract, graph, normalize, quality, tables
from folioforge.plans.common import BLOCKS, blocks, once, sql_strip
from folioforge.plans.record_queries import A, I, P, attributes, clean, filled, products
from folioforge.runtime import cut
from folioforge.plans.table_queries import TABLE_CODES, rows_of_tables


def _issues(spark, sf_dir):
    # seven rules read them: they are made distinct once
    p, a = cut(products(spark, sf_dir), "products"), cut(attributes(spark, sf_dir), "attributes")
    return (
        quality.product_issues(p).unionByName(quality.attribute_issues(a)).unionByName(quality.duplicate_codes(p)).unionByName(quality.orphaned_attributes(a, p))
        .unionByName(quality.orphaned_attributes(a, p, "chunk")).unionByName(quality.ambiguous_owners(a, p)).unionByName(quality.relation_issues(graph.product_relations(p)))
    )


def q_report(spark, sf_dir):
    return quality.report(_issues(spark, sf_dir))


def q_missing_codes(spark, sf_dir):
    return quality.missing_codes(tables.table_codes(rows_of_tables(spark, sf_dir)), products(spark, sf_dir))


def q_orphans(spark, sf_dir):
    p, a = products(spark, sf_dir), attributes(spark, sf_dir)
    return quality.orphaned_attributes(a, p).unionByName(quality.orphaned_attributes(a, p, "chunk"))


def q_upsert(spark, sf_dir):
    """Codes of table rows merged into the products of their document."""
    chunks = blocks(spark, sf_dir, "chunk_id").select("doc_stem", "id", F.regexp_replace("chunk_id", "__part[0-9]+$", "").alias("chunk_id"))
    found = tables.table_codes(rows_of_tables(spark, sf_dir)).join(chunks, ["doc_stem", "id"])
    found = found.groupBy("doc_stem", F.upper("code").alias("sku")).agg(F.min("chunk_id").alias("chunk_id"))
    have = products(spark, sf_dir).where("trim(sku) <> ''").groupBy("doc_stem", F.upper(tx.strip("sku")).alias("sku")).agg(F.min("chunk_id").alias("chunk_id"))
    return normalize.upsert(found, have, ["doc_stem", "sku"], ["chunk_id"])


def q_conflicts(spark, sf_dir):
    return quality.code_conflicts(products(spark, sf_dir))


def q_garbage(spark, sf_dir):
    d = once(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", F.round(tx.odd_share("text"), 9).alias("odd_share"))


def q_unsupported(spark, sf_dir):
    return quality.unsupported_codes(products(spark, sf_dir), blocks(spark, sf_dir))


def q_issue_summary(spark, sf_dir):
    """Reported issues by severity, code and month."""
    i = once(spark, sf_dir, "review_issues")
    return i.groupBy("severity", F.coalesce(F.trim("code"), F.lit("")).alias("code"), F.date_format("raised_at", "yyyy-MM").alias("period")).agg(F.count(F.lit(1)).alias("issues"), F.count_distinct("doc_stem").alias("documents"))


def _with_paths(spark, sf_dir):
    """Products with the section path of the run they come from."""
    paths = once(spark, sf_dir, "extraction_runs", "run_id", "section_path").groupBy("run_id").agg(F.min("section_path").alias("section_path"))
    return products(spark, sf_dir).join(paths, "run_id", "left")


def q_unsupported_items(spark, sf_dir):
    """Products that are headings or name no concrete item, with the models that nothing but the code states."""
    p = _with_paths(spark, sf_dir)
    rows = tables.table_rows(blocks(spark, sf_dir, "type", "text").where("type = 'table'")).join(blocks(spark, sf_dir, "chunk_id"), ["doc_stem", "id"])
    texts = blocks(spark, sf_dir, "chunk_id", "text")
    return quality.unsupported_items(p, rows).unionByName(quality.unconfirmed_models(p, rows, texts))


def q_kept_items(spark, sf_dir):
    """What is left, and what goes, when headings and unsupported items are taken out, by document."""
    p, a = _with_paths(spark, sf_dir), attributes(spark, sf_dir)
    rows = tables.table_rows(blocks(spark, sf_dir, "type", "text").where("type = 'table'")).join(blocks(spark, sf_dir, "chunk_id"), ["doc_stem", "id"])
    kept, rest = quality.without_unsupported(p, a, quality.unsupported_items(p, rows))
    return kept.groupBy("doc_stem").agg(F.count(F.lit(1)).alias("products")).join(rest.groupBy("doc_stem").agg(F.count(F.lit(1)).alias("attributes")), "doc_stem", "full").na.fill(0, ["products", "attributes"])


def q_native_supplement(spark, sf_dir):
    """Codes with prices in the texts of pages that no product of their document has, by page and section."""
    b = blocks(spark, sf_dir, "page", "text", "chunk_id").where("text is not null")
    pairs = extract.native_pairs(b.select("doc_stem", "page", "text"), code="[A-Za-z]{2,6}[0-9]{3,}[A-Za-z]?")
    evidence = b.where("chunk_id is not null").groupBy("doc_stem", "page", "chunk_id").agg(F.min("id").alias("pos")).select("doc_stem", "page", "pos", F.array("chunk_id").alias("section_path"), F.array().cast("array<string>").alias("codes"))
    found = extract.supplement(pairs, products(spark, sf_dir), evidence)
    return found.select("doc_stem", "page", F.array_join("section_path", " > ").alias("section_path"), "sku", "price", "currency", "grp")


def q_provenance(spark, sf_dir):
    return quality.provenance(products(spark, sf_dir), blocks(spark, sf_dir)).select("product_id", *[F.col(c).cast("bigint").alias(c) for c in ("first_page", "last_page", "blocks")])


def queries():
    return {
        "q21_missing_codes": q_missing_codes, "q22_orphan_attributes": q_orphans, "q23_reconcile_upsert": q_upsert, "q26_quality_report": q_report, "q27_model_conflicts": q_conflicts,
        "q25_native_supplement": q_native_supplement, "q63_unsupported_items": q_unsupported_items, "q64_kept_items": q_kept_items,
        "q28_garbage_ratio": q_garbage, "q53_unsupported_codes": q_unsupported, "q54_issue_summary": q_issue_summary, "q55_provenance": q_provenance,
    }


_ODD = r"'[^\x20-\x7E\x{{a0}}-\x{{24f}}\x{{4e00}}-\x{{9fff}}]'"


def _share(c):
    return f"(length({c}) - length(regexp_replace({c}, {_ODD.format()}, '', 'g')))::double / greatest(length({c}), 1)"


def _blank(c):
    return f"coalesce({sql_strip(c)}, '') = ''"


_KNOWN = "known as (select distinct doc_stem, unnest([name, sku]) e from p), near as (select distinct doc_stem, chunk_id, unnest([lower(name), lower(sku)]) e from p)"
_DOC = "select 'ORPHANED_ATTRIBUTE' as \"rule\", 'error' severity, doc_stem, attr_id record_id from a where not exists (select 1 from known k where k.doc_stem = a.doc_stem and k.e = a.entity)"
_CHUNK = f"select 'ORPHANED_ATTRIBUTE_IN_CHUNK', 'warning', doc_stem, attr_id from a where not exists (select 1 from near k where k.doc_stem = a.doc_stem and k.chunk_id = a.chunk_id and k.e = lower({sql_strip('a.entity')}))"
_FOUND = TABLE_CODES + ", found as (select c.doc_stem, upper(code) code, k.chunk_id from codes c join blocks k on k.doc_stem = c.doc_stem and k.id = c.id)"


_TERMS = r"list_filter(list_transform(regexp_extract_all(lower({0}), '[\pL\pN_]+'), lambda w: case when length(w) > 3 then rtrim(w, 's') else w end), lambda w: w not in ('the', 'of', 'for', 'and', 'page', 'section', 'overview'))"
#: No table of the data names items with prices, so no row makes an item concrete.
_ITEMS = f"""{P}, sp as (select run_id, min(section_path) path from extraction_runs group by 1), pp as (select p.*, coalesce(path, []) path, {_TERMS.format('p.name')} terms from p left join sp using (run_id)),
  bare as (select *, len(terms) > 0 and len(list_filter(path, lambda h: list_has_all({_TERMS.format('h')}, terms))) > 0 hd from pp where {_blank('sku')} and {_blank('model')}),
  bad as (select case when hd then 'HEADING_AS_PRODUCT' else 'UNSUPPORTED_SELLABLE_ITEM' end as "rule", 'error' severity, doc_stem, product_id record_id from bare)"""


def oracle_sql():
    return {
        "q21_missing_codes": f"with {P}, {_FOUND} select distinct doc_stem, code from found f where not exists (select 1 from p where p.doc_stem = f.doc_stem and upper({sql_strip('p.sku')}) = f.code)",
        "q22_orphan_attributes": f"with {P}, {A}, {_KNOWN} {_DOC} union all {_CHUNK}",
        "q23_reconcile_upsert": f"""with {P}, {_FOUND}, bb as (select doc_stem, code sku, min(regexp_replace(chunk_id, '__part[0-9]+$', '')) chunk_id from found group by 1, 2),
  h as (select doc_stem, upper({sql_strip('sku')}) sku, min(chunk_id) chunk_id from p where trim(sku) <> '' group by 1, 2)
  select coalesce(h.doc_stem, bb.doc_stem) doc_stem, coalesce(h.sku, bb.sku) sku, coalesce(h.chunk_id, bb.chunk_id) chunk_id, case when h.sku is null then 'added' when bb.sku is null then 'kept' else 'merged' end origin from h full join bb on h.doc_stem = bb.doc_stem and h.sku = bb.sku""",
        "q26_quality_report": f"""with {P}, {A}, {I}, {_KNOWN}, dup as (select product_id, doc_stem, min(product_id) over (partition by doc_stem, upper({sql_strip('sku')})) f from p where not ({_blank('sku')})),
  own as (select doc_stem, unnest([name, {filled('sku')}]) e, kind || chr(31) || ident k from i), many as (select doc_stem, e from own where e is not null group by 1, 2 having count(distinct k) > 1),
  hd as (select doc_stem, variant_group, min(ident) obj from i where kind = 'sku' and variant_group is not null group by 1, 2),
  rel as (select i.doc_stem, i.ident s, hd.obj o, product_id from i join hd on i.doc_stem = hd.doc_stem and i.variant_group = hd.variant_group where kind = 'sku' and ident <> obj),
  u as (select 'SCHEMA_ERROR' as "rule", 'error' severity, doc_stem, product_id record_id from p where {_blank('name')}
  union all select 'SHORT_NAME', 'warning', doc_stem, product_id from p where not ({_blank('name')}) and length({sql_strip('name')}) < 2
  union all select 'GARBAGE_TEXT', 'warning', doc_stem, product_id from p where {_share('name')} > 0.15
  union all select 'MISSING_SKU', 'info', doc_stem, product_id from p where {_blank('sku')}
  union all select 'MATERIAL_IS_NOT_MODEL', 'info', doc_stem, product_id from p where regexp_matches({sql_strip('model')}, '{quality.MATERIAL}')
  union all select 'SCHEMA_ERROR', 'error', doc_stem, attr_id from a where {_blank('entity')} or {_blank('key')} or {_blank('value')}
  union all select 'GARBAGE_TEXT', 'warning', doc_stem, attr_id from a where {_share('value')} > 0.15
  union all select 'VALUE_TOO_LONG', 'warning', doc_stem, attr_id from a where length(value) > 500
  union all select 'DUPLICATE_SKU', 'warning', doc_stem, product_id from dup where product_id <> f
  union all {_DOC} union all {_CHUNK}
  union all select 'AMBIGUOUS_ATTRIBUTE_OWNER', 'error', doc_stem, attr_id from a where exists (select 1 from many m where m.doc_stem = a.doc_stem and m.e = a.entity)
  union all select 'SCHEMA_ERROR', 'error', doc_stem, product_id from rel where lower(s) = lower(o))
  select "rule", severity, count(*) n, count(distinct doc_stem) documents from u group by 1, 2""",
        "q27_model_conflicts": f"""with {P} select 'CONFLICTING_SKU_MODEL' as "rule", 'error' severity, doc_stem, {sql_strip('sku')} subject, count(distinct {sql_strip('model')}) choices from p where not ({_blank('sku')}) and not ({_blank('model')}) group by 3, 4 having count(distinct {sql_strip('model')}) > 1
  union all select 'MULTIPLE_MODEL_CATEGORIES', 'warning', doc_stem, {sql_strip('model')}, count(distinct {sql_strip('category')}) from p where not ({_blank('model')}) and not ({_blank('category')}) group by 3, 4 having count(distinct {sql_strip('category')}) > 1""",
        "q63_unsupported_items": f"with {_ITEMS}, {BLOCKS} select * from bad union all select 'SKU_IS_NOT_A_CONFIRMED_MODEL', 'info', doc_stem, product_id from p where not ({_blank('sku')}) and {sql_strip('model')} = {sql_strip('sku')} and not exists (select 1 from blocks b where b.doc_stem = p.doc_stem and b.chunk_id = regexp_replace(p.chunk_id, '__part[0-9]+$', '') and regexp_matches(b.text, '(?i)model\\s*(?:number|no\\.?|#)?\\s*[:=]?\\s*' || regexp_escape({sql_strip('p.model')}) || '(?:[^\\pL\\pN_]|$)'))",
        "q64_kept_items": f"""with {_ITEMS}, {A}, gone as (select distinct p.doc_stem, p.chunk_id, p.name from bad join p on p.product_id = bad.record_id), kp as (select * from p where product_id not in (select record_id from bad)),
  ka as (select a.* from a where not exists (select 1 from gone g where g.doc_stem = a.doc_stem and g.chunk_id = a.chunk_id and g.name = a.entity) or exists (select 1 from kp where kp.doc_stem = a.doc_stem and kp.chunk_id = a.chunk_id and (kp.name = a.entity or kp.sku = a.entity))),
  x as (select doc_stem, count(*) n from kp group by 1), y as (select doc_stem, count(*) n from ka group by 1) select coalesce(x.doc_stem, y.doc_stem) doc_stem, coalesce(x.n, 0) products, coalesce(y.n, 0) "attributes" from x full join y on x.doc_stem = y.doc_stem""",
        "q53_unsupported_codes": f"""with {BLOCKS}, {P}, w as (select distinct doc_stem, chunk_id, regexp_replace(unnest(regexp_extract_all(upper(text), '[\\pL\\pN\\pM_/.-]+')), '[/.-]+$', '') t from blocks where text is not null and chunk_id is not null),
  k as (select * from w where length(t) > 1 and regexp_matches(t, '^[A-Z0-9]') and regexp_matches(t, '^[A-Z./-]*[0-9]'))
  select 'UNSUPPORTED_IDENTIFIER' as "rule", 'error' severity, doc_stem, product_id record_id from p where not ({_blank('sku')}) and not exists (select 1 from k where k.doc_stem = p.doc_stem and k.chunk_id = regexp_replace(p.chunk_id, '__part[0-9]+$', '') and k.t = upper({sql_strip('p.sku')}))""",
        "q28_garbage_ratio": f"with d as (select distinct doc_id, text from documents) select doc_id, round({_share('text')}, 9) odd_share from d",
        "q54_issue_summary": "with i as (select distinct * exclude (ingested_at) from review_issues) select severity, coalesce(trim(code), '') code, strftime(raised_at, '%Y-%m') period, count(*) issues, count(distinct doc_stem) documents from i group by 1, 2, 3",
        "q55_provenance": f"with {BLOCKS}, {P}, c as (select doc_stem, chunk_id, min(page) f, max(page) l, count(*) n from blocks where chunk_id is not null group by 1, 2) select product_id, f::bigint first_page, l::bigint last_page, n as blocks from p left join c on c.doc_stem = p.doc_stem and c.chunk_id = regexp_replace(p.chunk_id, '__part[0-9]+$', '')",
    }
