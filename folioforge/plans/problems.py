"""Queries of the general data operators, and their SQL."""

from __future__ import annotations

from folioforge.operators import hierarchy, references, unitjoin, widetable


def queries():
    return {
        "p1_found": references.orphan_records,
        "p1_by_month": references.orphan_counts,
        "p1_proofs": references.orphan_proofs,
        "p4_found": hierarchy.block_cycles,
        "p4_hierarchy": hierarchy.block_hierarchy,
        "p4_paths": hierarchy.block_paths,
        "p4_descendants": hierarchy.block_descendants,
        "p5_found": widetable.filled_cells,
        "p5_wide": widetable.attribute_wide,
        "p6_found": unitjoin.equal_amounts,
        "p6_amounts": unitjoin.common_amounts,
    }


_TRIM = "trim({}, ' ' || chr(9))"

ORPHANS = f"""
with refs as (
  select 'retry_attributes' source_table, extracted_at t, attr_id record_id, 'product' target, doc_stem scope, {_TRIM.format('entity')} k from retry_attributes
  union all select 'retry_products', extracted_at, product_id, 'item', '', {_TRIM.format('sku')} from retry_products
  union all select 'review_issues', raised_at, issue_id, 'code', '', {_TRIM.format('code')} from review_issues),
parents as (
  select 'product' target, doc_stem scope, case when coalesce({_TRIM.format('sku')}, '') <> '' then {_TRIM.format('sku')} else name end k, extracted_at b, retracted_at e from retry_products
  union all select 'item', '', sku, created_at, deleted_at from catalog_items
  union all select 'code', '', code, created_at, deleted_at from issue_codes),
found as (
  select distinct source_table, strftime(t, '%Y-%m') period, record_id from refs r
  where k <> '' and t is not null and not exists (
    select 1 from parents p where p.target = r.target and p.scope = r.scope and p.k = r.k and p.b <= r.t and (p.e is null or p.e > r.t)))
"""

_CYCLIC = """
nodes as (select distinct doc_stem, id from semantic_blocks where doc_stem is not null and id is not null),
raw as (
  select doc_stem, id child, parent_id parent, 1 own from semantic_blocks where parent_id is not null
  union select doc_stem, unnest(children_ids), id, 0 from semantic_blocks),
links as (
  select r.doc_stem, r.child, r.parent, max(own) own from raw r
  join nodes a on a.doc_stem = r.doc_stem and a.id = r.child join nodes b on b.doc_stem = r.doc_stem and b.id = r.parent group by 1, 2, 3),
reach as (
  select doc_stem, child id, parent up from links
  union select r.doc_stem, r.id, l.parent from reach r join links l on l.doc_stem = r.doc_stem and l.child = r.up),
cyclic as (
  select a.doc_stem, a.id, min(b.up) cycle_id
  from reach a
  join reach b on b.doc_stem = a.doc_stem and b.id = a.id
  join reach c on c.doc_stem = a.doc_stem and c.id = b.up and c.up = a.id
  where a.up = a.id
  group by a.doc_stem, a.id)"""

WALK = f"""with recursive {_CYCLIC},
best as (select *, row_number() over (partition by doc_stem, child order by own desc, parent) n from links),
tree as (select n.doc_stem, n.id, b.parent from nodes n
  left join best b on b.doc_stem = n.doc_stem and b.child = n.id and b.n = 1 and not exists (select 1 from cyclic c where c.doc_stem = n.doc_stem and c.id = n.id)),
walk as (select doc_stem, id, [id] path from tree where parent is null
  union all select t.doc_stem, t.id, list_append(w.path, t.id) from tree t join walk w on w.doc_stem = t.doc_stem and w.id = t.parent),
below as (select doc_stem, path[i] id, id descendant, len(path) - i distance from (select *, unnest(generate_series(1, len(path) - 1)) i from walk))"""


def oracle_sql():
    return {
        "p1_found": ORPHANS + "select source_table, period, record_id from found",
        "p1_by_month": ORPHANS + "select source_table, period, count(*) orphans from found group by 1, 2",
        "p4_found": f"with recursive {_CYCLIC} select doc_stem, id, cycle_id from cyclic",
        "p4_paths": WALK + """ select w.doc_stem, w.id, w.path[-2] parent, w.path[1] root, len(w.path) - 1 as depth, array_to_string(w.path, ' > ') path,
  coalesce(b.n, 0)::bigint descendants, c.cycle_id from walk w
  left join (select doc_stem, id, count(*) n from below group by 1, 2) b on b.doc_stem = w.doc_stem and b.id = w.id
  left join cyclic c on c.doc_stem = w.doc_stem and c.id = w.id""",
        "p4_descendants": WALK + " select doc_stem, id, descendant, distance::int distance from below",
    }
