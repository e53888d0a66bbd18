"""Queries of the record, catalog and graph operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators import catalog, graph, normalize, replies
from folioforge.plans.common import once, sql_strip


def products(spark, sf_dir):
    return once(spark, sf_dir, "retry_products", "product_id", "run_id", "doc_stem", "chunk_id", "name", "model", "sku", "category", "description", "variant_group")


def attributes(spark, sf_dir):
    return once(spark, sf_dir, "retry_attributes", "attr_id", "run_id", "doc_stem", "chunk_id", "entity", "key", "value", "unit", "location")


def runs(spark, sf_dir):
    return once(spark, sf_dir, "extraction_runs", "run_id", "doc_stem", "chunk_id", "attempt", "raw_response", "backend_used", "latency_s", "parse_error")


def q_evaluation(spark, sf_dir):
    return catalog.evaluate(products(spark, sf_dir), attributes(spark, sf_dir))


def q_rollup(spark, sf_dir):
    """Totals over all documents and per document, by one rollup over identities that were folded first."""
    once_ = normalize.identified(products(spark, sf_dir)).groupBy("doc_stem", "kind", "ident").agg(F.count(F.lit(1)).alias("records"))
    return once_.rollup("doc_stem").agg(F.sum("records").alias("records"), F.count(F.lit(1)).alias("items"), F.count_if(F.col("kind") == "sku").alias("codes")).withColumn("doc_stem", F.coalesce("doc_stem", F.lit("(all)")))


def q_value_unit(spark, sf_dir):
    a = once(spark, sf_dir, "retry_attributes", "attr_id", "value")
    # a generator evaluates the reading once, a filter on its result would evaluate it again
    found = F.filter(F.array(tx.value_unit("value")), lambda m: m["unit"].isNotNull())
    return a.select("attr_id", F.explode(found).alias("m")).select("attr_id", F.round("m.value", 9).alias("number"), F.col("m.unit").alias("canonical"))


def q_clean(spark, sf_dir):
    p = products(spark, sf_dir)
    return p.select("product_id", tx.clean("name").alias("name"), tx.clean("category").alias("category"), tx.label("model").alias("model"), tx.plain_lines("description").alias("description"))


def q_ids(spark, sf_dir):
    p = products(spark, sf_dir)
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return p.select("product_id", tx.stable_id("SI", "doc_stem", blank("sku"), blank("name")).alias("item_id"), tx.json_list_id("prod", "doc_stem", blank("name"), blank("sku")).alias("node_id"))


def q_merge(spark, sf_dir):
    return normalize.merge_products(products(spark, sf_dir)).drop("variant_group")


def q_attributes(spark, sf_dir):
    a = normalize.normalized_attributes(attributes(spark, sf_dir))
    keys = ["doc_stem", "entity", "key_norm", "value_norm", "unit_norm", "location", "chunk_id"]
    kept = normalize.first_of_each(a.select(*keys, "attr_id", "conflict"), keys, "attr_id")
    return kept.select("attr_id", "key_norm", "unit_norm", "conflict")


def q_relations(spark, sf_dir):
    p = products(spark, sf_dir)
    stated = p.where("category is not null").select("doc_stem", tx.clean("name").alias("subject"), F.lit("BELONGS_TO_CATEGORY").alias("predicate"), tx.clean("category").alias("object"), "product_id")
    both = stated.unionByName(graph.product_relations(p))
    return normalize.first_of_each(both, ["doc_stem", "subject", "predicate", "object"], "product_id")


def q_variants(spark, sf_dir):
    return normalize.variant_components(products(spark, sf_dir))


def q_alias(spark, sf_dir):
    aliases = normalize.unique_alias(products(spark, sf_dir)).withColumnRenamed("alias", "entity")
    return attributes(spark, sf_dir).join(aliases, ["doc_stem", "entity"], "left").select("attr_id", "owner")


def q_item_attributes(spark, sf_dir):
    rows = normalize.item_attributes(products(spark, sf_dir), attributes(spark, sf_dir))
    return normalize.property_lists(rows.where("key is not null and value is not null"), ["doc_stem", "ident"]).withColumn("values", F.array_join("values", " | "))


def q_owner(spark, sf_dir):
    return normalize.resolve_owner(attributes(spark, sf_dir), products(spark, sf_dir)).select("attr_id", "owner_ident")


def q_tree(spark, sf_dir):
    return catalog.category_nodes(catalog.catalog_items(products(spark, sf_dir))).withColumn("depth", F.col("depth").cast("bigint"))


def q_tree_counts(spark, sf_dir):
    flat = catalog.flatten_tree(catalog.catalog_tree(catalog.catalog_items(products(spark, sf_dir))))
    return flat.groupBy("doc_stem").agg(F.count_distinct("category").alias("categories"), F.count_distinct("model_key").alias("models"), F.count(F.lit(1)).alias("items"))


def _graph(spark, sf_dir):
    return products(spark, sf_dir), attributes(spark, sf_dir), once(spark, sf_dir, "extraction_runs", "doc_stem", "chunk_id")


def q_nodes(spark, sf_dir):
    return graph.nodes(*_graph(spark, sf_dir))


def q_edges(spark, sf_dir):
    p, a, r = _graph(spark, sf_dir)
    return graph.edges(p, a, r, graph.product_relations(p))


def q_search(spark, sf_dir):
    return catalog.search(products(spark, sf_dir), " Bearing ").select("product_id", "doc_stem", "name")


def q_sample(spark, sf_dir):
    items = once(spark, sf_dir, "retry_products", "doc_stem").withColumn("vendor", F.substring_index("doc_stem", "_", 1))
    return normalize.seeded_sample(items, "vendor", "doc_stem", 3, 42)


def q_run_summary(spark, sf_dir):
    """Runs per backend: attempts, failures and latency, null latencies left out."""
    r = runs(spark, sf_dir)
    return r.groupBy("backend_used").agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("parse_error").isNotNull()).alias("failed"), F.count_if(F.col("attempt") > 1).alias("retried"),
        F.round(F.sum("latency_s"), 6).alias("latency_sum"), F.round(F.avg("latency_s"), 6).alias("latency_avg"),
    )


def q_run_totals(spark, sf_dir):
    """What the replies of each backend hold, with failures and latency."""
    r = once(spark, sf_dir, "extraction_runs", "run_id", "raw_response", "backend_used", "parse_error", "latency_s")
    counts = [replies.reply_count("raw_response", k).alias(k) for k in ("products", "attributes", "relations")]
    return r.select("backend_used", "parse_error", "latency_s", *counts).groupBy("backend_used").agg(
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("products", "attributes", "relations")], F.count_if(F.col("parse_error").isNotNull()).alias("errors"), F.round(F.sum("latency_s"), 6).alias("latency"),
    )


def q_product_sources(spark, sf_dir):
    p = once(spark, sf_dir, "retry_products", "product_id", "doc_stem", "chunk_id", "name", "model", "sku", "category", "source_evidence")
    return normalize.product_sources(p).select("doc_stem", "kind", "ident", "source", "value", F.col("rank").cast("bigint").alias("rank"))


def q_retry(spark, sf_dir):
    """Chunks to extract again: those whose last attempt failed."""
    r = runs(spark, sf_dir)
    last = r.groupBy("doc_stem", "chunk_id").agg(F.max(F.struct("attempt", "run_id", "parse_error")).alias("l"), F.max("attempt").alias("attempts"))
    return last.where("l.parse_error is not null").select("doc_stem", "chunk_id", F.col("attempts").cast("bigint").alias("attempts"))


def queries():
    return {
        "q01_catalog_evaluation": q_evaluation, "q02_corpus_rollup": q_rollup, "q04_value_unit": q_value_unit, "q05_text_clean": q_clean, "q06_stable_ids": q_ids,
        "q15_product_merge": q_merge, "q16_attribute_dedup": q_attributes, "q17_relation_dedup": q_relations, "q18_variant_components": q_variants,
        "q19_alias_resolution": q_alias, "q20_item_attribute_join": q_item_attributes, "q24_priority_lookup": q_owner, "q36_category_tree": q_tree, "q37_tree_flatten_counts": q_tree_counts,
        "q38_graph_nodes": q_nodes, "q39_graph_edges": q_edges, "q40_search": q_search, "q41_seeded_sample": q_sample, "q49_run_summary": q_run_summary, "q65_product_sources": q_product_sources, "q66_run_totals": q_run_totals, "q50_retry_candidates": q_retry,
    }


P = "p as (select distinct product_id, run_id, doc_stem, chunk_id, name, model, sku, category, description, variant_group from retry_products)"
A = "a as (select distinct attr_id, run_id, doc_stem, chunk_id, entity, key, value, unit, location from retry_attributes)"
R = "r as (select distinct run_id, doc_stem, chunk_id, attempt, raw_response, backend_used, latency_s, parse_error from extraction_runs)"


def clean(c):
    plain = f"translate({c}, '’‘“”–—®™', chr(39) || chr(39) || '\"\"--')"
    return "coalesce(" + sql_strip(rf"regexp_replace({plain}, '[\s\pZ]+', ' ', 'g')") + ", '')"


def filled(c):
    return f"nullif({sql_strip(c)}, '')"


I = f"i as (select *, case when {filled('sku')} is not null then 'sku' else 'name' end kind, coalesce({filled('sku')}, {clean('name')} || chr(31) || coalesce({sql_strip('model')}, '')) ident from p)"  # noqa: E741
ALIAS_MAP = "map {" + ", ".join("'" + k.replace("'", "''") + "': '" + v + "'" for k, v in tx.UNIT_ALIASES.items()) + "}"
_NUM = "case when regexp_matches({0}, '^\\d+/\\d+$') then case when split_part({0}, '/', 2)::double <> 0 then split_part({0}, '/', 1)::double / split_part({0}, '/', 2)::double end when regexp_matches({0}, '^[+-]?\\d+(\\.\\d+)?$') then try_cast({0} as double) end"
_WAYS = (
    r"""^(\d+/\d+)\s*([a-zA-Z"''°]+)\s*$""",
    r"""^\s*([+-]?\d{1,3}(?:[,\s]\d{3})*(?:\.\d+)?|\d+(?:\.\d+)?)\s*([^\d\s][^\n]*?)\s*$""",
    r"""^((?:\d+/\d+|\d+(?:\.\d+)?))\s*([a-zA-Z"''°]+)$""",
)


def _measure(raw: str) -> tuple[str, str]:
    values, units = [], []
    for w in _WAYS:
        n = _NUM.format(f"regexp_replace(regexp_extract({raw}, '{w}', 1), '[, ]', '', 'g')")
        u = f"({ALIAS_MAP})[regexp_replace(lower({sql_strip(f'regexp_extract({raw}, {chr(39)}{w}{chr(39)}, 2)')}), '\\.+$', '')]"
        values.append(f"case when {u} is not null then {n} end")
        units.append(f"case when ({n}) is not null then {u} end")
    return f"coalesce({', '.join(values)})", f"coalesce({', '.join(units)})"


_V, _U = _measure(sql_strip("value"))
_JSON = "'{0}_' || substr(sha1('[' || {1} || ']'), 1, 12)"


def jid(prefix, *parts):
    q = " || ', ' || ".join("'\"' || replace(replace(" + p + ", '\\', '\\\\'), '\"', '\\\"') || '\"'" for p in parts)
    return _JSON.format(prefix, q)


def sid(prefix, *parts):
    return f"'{prefix}-' || substr(sha256(" + " || chr(31) || ".join(parts) + "), 1, 16)"


CAT = f"""{P}, {I},
k as (select *, coalesce('model' || chr(31) || {filled('model')}, 'row' || chr(31) || {filled('variant_group')}, 'code' || chr(31) || {filled('sku')}, 'name' || chr(31) || {filled('name')}) mk,
  list_filter(list_transform(string_split(case when {filled('category')} is not null then category else '{catalog.UNCLASSIFIED}' end, ' > '), lambda x: {sql_strip('x')}), lambda x: x <> '') path from i),
home as (select doc_stem, mk, arg_min(path, product_id) path from k where mk is not null group by 1, 2),
items as (select k.doc_stem, k.mk, k.ident item, any_value(home.path) path from k join home using (doc_stem, mk) group by 1, 2, 3)"""

MERGED = f"""{P}, {I},
m as (select doc_stem, kind, ident, arg_min({clean('name')}, product_id) as name, arg_min({filled('model')}, product_id) filter ({filled('model')} is not null) model,
  arg_min(nullif({clean('category')}, ''), product_id) filter (nullif({clean('category')}, '') is not null) category, arg_min(chunk_id, product_id) filter (chunk_id is not null) first_chunk,
  count(distinct chunk_id) chunks, count(distinct case when category is not null then {clean('category')} end) categories from i where ident <> chr(31) group by 1, 2, 3)"""

NODES = f"""{MERGED}, {A}, {R},
prod as (select *, {jid('prod', 'doc_stem', 'name', "case when kind = 'sku' then ident else '' end")} id from m),
attr as (select distinct {jid('attr', *[f"coalesce({c}, '')" for c in ('doc_stem', 'entity', 'key', 'value', 'unit', 'location', 'chunk_id')])} id, key as name, doc_stem, entity from a)"""

OWNERS = f"""codes as (select distinct doc_stem, ident from i where kind = 'sku'),
names as (select doc_stem, lower({clean('name')}) low, min(ident) ident from i where {clean('name')} <> '' group by 1, 2 having count(distinct ident) = 1)"""


_MEMBER = "coalesce(try_cast(json_extract_string(good, '$.{0}') as bigint), json_array_length(good, '$.{0}')::bigint)"
_TOTALS = rf"""with r as (select distinct run_id, raw_response, backend_used, parse_error, latency_s from extraction_runs),
  j as (select *, nullif(regexp_extract(regexp_replace(regexp_replace(raw_response, '(?s)<think>.*?</think>', '', 'g'), '```(?:json)?\s*', '', 'g'), '(?s)\{{.*\}}'), '') js from r),
  k as (select *, replace(regexp_replace(js, ',\s*([}}\]])', '\1', 'g'), chr(39), '"') fixed from j), m as (select *, case when json_valid(js) then js when json_valid(fixed) then fixed end good from k)
  select backend_used, coalesce(sum({_MEMBER.format('products')}), 0)::bigint products, coalesce(sum({_MEMBER.format('attributes')}), 0)::bigint "attributes", coalesce(sum({_MEMBER.format('relations')}), 0)::bigint relations,
    count(parse_error) errors, round(sum(latency_s), 6) latency from m group by 1"""


def oracle_sql():
    return {
        "q01_catalog_evaluation": f"""with {P}, {A}, {I}, x as (select doc_stem, count(distinct kind || chr(31) || ident) items, count(distinct case when kind = 'sku' then ident end) article_numbers, count(distinct model) models, count(distinct category) categories, count(distinct chunk_id) chunks from i group by 1),
  y as (select doc_stem, count(*) attributes, count(distinct key) keys from a group by 1)
  select coalesce(x.doc_stem, y.doc_stem) doc_stem, coalesce(items, 0) items, coalesce(article_numbers, 0) article_numbers, coalesce(models, 0) models, coalesce(categories, 0) categories, coalesce(chunks, 0) chunks, coalesce(attributes, 0) attributes, coalesce(keys, 0) keys from x full join y on x.doc_stem = y.doc_stem""",
        "q02_corpus_rollup": f"with {P}, {I}, o as (select doc_stem, kind, ident, count(*) records from i group by 1, 2, 3) select coalesce(doc_stem, '(all)') doc_stem, sum(records)::bigint records, count(*) items, count(*) filter (kind = 'sku') codes from o group by rollup (doc_stem)",
        "q04_value_unit": f"with {A}, x as (select attr_id, {_V} number, {_U} canonical from a) select attr_id, round(number, 9) number, canonical from x where canonical is not null",
        "q16_attribute_dedup": f"""with {A}, x as (select *, array_to_string(list_transform(regexp_extract_all({clean('key')}, '(\\pL+|[^\\pL]+)'), lambda w: upper(w[1]) || lower(w[2:])), '') key_norm, {clean('value')} cv, nullif({clean('unit')}, '') cu from a),
  y as (select *, coalesce({ALIAS_MAP}[regexp_replace(lower(cu), '\\.+$', '')], lower(cu)) given, case when lower(key_norm) not in ('sku', 'model', 'part number', 'article number', 'description', 'thread size') then {_measure(sql_strip('cv'))[1]} end mu, {_measure(sql_strip('cv'))[0]} num from x),
  z as (select *, coalesce(given, mu) unit_norm, case when mu is not null then num::varchar else cv end value_norm, coalesce(given <> mu, false) conflict from y)
  select arg_min(attr_id, attr_id) attr_id, key_norm, unit_norm, arg_min(conflict, attr_id) conflict from z group by doc_stem, entity, key_norm, value_norm, unit_norm, location, chunk_id""",
        "q41_seeded_sample": "with d as (select distinct doc_stem, split_part(doc_stem, '_', 1) vendor from retry_products), n as (select *, row_number() over (partition by vendor order by md5('42' || chr(31) || doc_stem), doc_stem) n from d) select doc_stem, vendor from n where n <= 3",
        "q65_product_sources": f"""with p as (select distinct product_id, doc_stem, chunk_id, name, model, sku, category, source_evidence from retry_products), {I}, s as (
  select doc_stem, kind, ident, 'chunk' source, product_id, 0 pos, chunk_id as "value" from i where chunk_id is not null union all select doc_stem, kind, ident, 'category', product_id, 0, {clean('category')} from i where {clean('category')} <> ''
  union all select doc_stem, kind, ident, 'evidence', product_id, generate_subscripts(source_evidence, 1) - 1, concat_ws(':', unnest(source_evidence).page, unnest(source_evidence).block_id) from i),
  f as (select doc_stem, kind, ident, source, "value", min(printf('%018d.%09d', product_id, pos)) f from s where ident <> chr(31) group by 1, 2, 3, 4, 5)
  select doc_stem, kind, ident, source, "value", row_number() over (partition by doc_stem, kind, ident, source order by f, "value") "rank" from f""",
        "q66_run_totals": _TOTALS,
        "q05_text_clean": f"with {P} select product_id, {clean('name')} as name, {clean('category')} category, coalesce(lower({sql_strip('model')}), '') model, coalesce({sql_strip(chr(39).join(['regexp_replace(description, ', chr(92) + 'r' + chr(92) + 'n?', ', chr(10), ', 'g', ')']))}, '') description from p",
        "q06_stable_ids": f"with {P} select product_id, {sid('SI', 'doc_stem', 'coalesce(sku, ' + chr(39) * 2 + ')', 'coalesce(name, ' + chr(39) * 2 + ')')} item_id, {jid('prod', 'doc_stem', 'coalesce(name, ' + chr(39) * 2 + ')', 'coalesce(sku, ' + chr(39) * 2 + ')')} node_id from p",
        "q15_product_merge": f"""with {MERGED}, d as (select doc_stem, kind, ident, description, min(product_id) pos from i where description is not null group by 1, 2, 3, 4),
  e as (select doc_stem, kind, ident, list_reduce(list(description order by pos, description), lambda a, b: case when contains(b, a) then b when contains(a, b) then a else a || chr(10) || chr(10) || b end) description from d group by 1, 2, 3)
  select m.*, e.description from m left join e using (doc_stem, kind, ident)""",
        "q17_relation_dedup": f"""with {P}, {I}, h as (select doc_stem, variant_group, min(ident) object from i where kind = 'sku' and variant_group is not null group by 1, 2),
  rel as (select doc_stem, {clean('name')} subject, 'BELONGS_TO_CATEGORY' predicate, {clean('category')} object, product_id from p where category is not null
    union all select i.doc_stem, ident, 'IS_VARIANT_OF', h.object, product_id from i join h on i.doc_stem = h.doc_stem and i.variant_group = h.variant_group where kind = 'sku' and ident <> h.object)
  select doc_stem, subject, predicate, object, min(product_id) product_id from rel group by 1, 2, 3, 4""",
        "q18_variant_components": f"""with recursive {P}, e as (select distinct doc_stem, variant_group g, {sql_strip('sku')} s from p where variant_group is not null and trim(sku) <> ''),
  reach as (select doc_stem, g, g h from e union select r.doc_stem, r.g, b.g from reach r join e a on a.doc_stem = r.doc_stem and a.g = r.h join e b on b.doc_stem = a.doc_stem and b.s = a.s)
  select doc_stem, g variant_group, min(h) root from reach group by 1, 2""",
        "q19_alias_resolution": f"""with {P}, {A}, {I}, c as (select doc_stem, kind, ident, arg_min({clean('name')}, product_id) owner from i group by 1, 2, 3),
  al as (select i.doc_stem, unnest([name, {filled('sku')}]) alias, owner from i join c using (doc_stem, kind, ident)),
  u as (select doc_stem, alias, min(owner) owner from al where alias <> '' group by 1, 2 having count(distinct owner) = 1)
  select attr_id, u.owner from a left join u on a.doc_stem = u.doc_stem and a.entity = u.alias""",
        "q20_item_attribute_join": f"""with {P}, {A}, {I}, t as (select doc_stem, kind, ident, arg_min({clean('name')}, product_id) as name from i group by 1, 2, 3),
  j as (select distinct t.doc_stem, t.ident, a.attr_id, a.key, a.value from t join a on a.doc_stem = t.doc_stem and ((t.kind = 'sku' and {sql_strip('a.entity')} = t.ident) or {sql_strip('a.entity')} = t.name)),
  o as (select doc_stem, ident, key, value, min(attr_id) pos from j where key is not null and value is not null group by 1, 2, 3, 4)
  select doc_stem, ident, key, array_to_string(list(value order by pos, value), ' | ') as values from o group by 1, 2, 3""",
        "q24_priority_lookup": f"""with {P}, {A}, {I}, {OWNERS}
  select attr_id, coalesce(codes.ident, names.ident) owner_ident from a left join codes on codes.doc_stem = a.doc_stem and codes.ident = {sql_strip('a.entity')} left join names on names.doc_stem = a.doc_stem and names.low = lower({clean('a.entity')})""",
        "q36_category_tree": f"""with {CAT}, f as (select doc_stem, list_prepend(doc_stem, path) fp, unnest(generate_series(0, len(path))) depth from items),
  n as (select doc_stem, depth, fp[1:depth + 1] pp, count(*) items from f group by 1, 2, 3)
  select doc_stem, depth::bigint depth, array_to_string(pp, ' > ') path, pp[-1] title, 'PC-' || substr(sha256(array_to_string(pp, chr(31))), 1, 16) identifier, items from n""",
        "q37_tree_flatten_counts": f"with {CAT} select doc_stem, count(distinct path) categories, count(distinct mk) models, count(*) items from items group by 1",
        "q38_graph_nodes": f"""with {NODES}, u as (
  select {jid('doc', 'doc_stem')} id, 'Document' as label, doc_stem as name from r union all select {jid('sec', 'doc_stem', 'chunk_id')}, 'Section', chunk_id from r union all select id, 'Product', name from prod
  union all select {jid('cat', 'category')}, 'Category', category from m where category is not null union all select id, 'Attribute', name from attr)
  select id, label, min(name) as name from u group by 1, 2""",
        "q39_graph_edges": f"""with {NODES}, {OWNERS}, sec as (select distinct {jid('sec', 'doc_stem', 'chunk_id')} id, {jid('doc', 'doc_stem')} doc from r), ids as (select doc_stem, ident, min(id) pid from prod group by 1, 2),
  h as (select doc_stem, variant_group, min(ident) object from i where kind = 'sku' and variant_group is not null group by 1, 2)
  select distinct * from (select doc src, id dst, 'HAS_SECTION' rel from sec
  union all select s.id, prod.id, 'CONTAINS' from prod join sec s on s.id = {jid('sec', 'prod.doc_stem', 'prod.first_chunk')}
  union all select id, {jid('cat', 'category')}, 'BELONGS_TO' from prod where category is not null
  union all select ids.pid, attr.id, 'HAS_ATTRIBUTE' from attr left join codes on codes.doc_stem = attr.doc_stem and codes.ident = {sql_strip('attr.entity')} left join names on names.doc_stem = attr.doc_stem and names.low = lower({clean('attr.entity')})
    join ids on ids.doc_stem = attr.doc_stem and ids.ident = coalesce(codes.ident, names.ident)
  union all select x.pid, y.pid, 'IS_VARIANT_OF' from i join h on i.doc_stem = h.doc_stem and i.variant_group = h.variant_group join ids x on x.doc_stem = i.doc_stem and x.ident = i.ident join ids y on y.doc_stem = i.doc_stem and y.ident = h.object where i.kind = 'sku' and i.ident <> h.object and x.pid <> y.pid)""",
        "q40_search": f"with {P} select product_id, doc_stem, name from p where contains(lower(concat_ws(' ', sku, name, description, model, category)), 'bearing')",
        "q49_run_summary": f"with {R} select backend_used, count(*) runs, count(*) filter (parse_error is not null) failed, count(*) filter (attempt > 1) retried, round(sum(latency_s), 6) latency_sum, round(avg(latency_s), 6) latency_avg from r group by 1",
        "q50_retry_candidates": f"with {R}, l as (select doc_stem, chunk_id, row_number() over (partition by doc_stem, chunk_id order by attempt desc, run_id desc) n, parse_error, max(attempt) over (partition by doc_stem, chunk_id) attempts from r) select doc_stem, chunk_id, attempts::bigint attempts from l where n = 1 and parse_error is not null",
    }
