"""Queries of the general data problems over the domain tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions.keys import canonical, trimmed
from loomwright.operators import hierarchy, nested, references, snapshots
from loomwright.operators.skew import bounded, lookup
from loomwright.session import cut, table

#: Least move of a disposition that counts.
DISPOSITION_STEP = 0.005


def drop_entries(drops):
    """Entries ``source chance%`` of a printed list as (source, chance to three decimals) texts."""
    entry = F.split(F.coalesce(drops, F.lit("")), ";")
    source = lambda e: F.regexp_extract(e, r"^\s*(.*?)\s+[0-9.]+\s*%\s*$", 1)
    chance = lambda e: F.round(F.regexp_extract(e, r"([0-9.]+)\s*%\s*$", 1).try_cast("decimal(20,8)"), 3)
    read = F.transform(entry, lambda e: F.concat_ws(" ", F.nullif(source(e), F.lit("")), chance(e).cast("string")))
    return F.filter(read, lambda e: e != "")


def state_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row a build and item: the one delivered last, by row_id if delivered at one time."""
    rows = table(spark, d, "state_items").select(
        "build", F.lower(trimmed("item")).alias("item"), "disposition", "drops", "delivered_at", "row_id"
    )
    return snapshots.latest(rows.filter(F.col("item") != ""), ["build", "item"], ["delivered_at", "row_id"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    rows = state_rows(spark, d)
    moved = snapshots.diff(rows, "build", "item", numbers={"disposition": DISPOSITION_STEP}, sets={"drops": drop_entries(F.col("drops"))})
    return moved.select("build", F.col("key").alias("item"), "change")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return p1_found(spark, d).groupBy("build", "change").agg(F.count("*").alias("n"))


P1_SQL = """
with rows as (
  select build, lower(trim(item, ' ' || chr(9))) as item, arg_max(struct_pack(d := disposition, s := drops), struct_pack(a := delivered_at, b := row_id)) as v
  from state_items where trim(item, ' ' || chr(9)) <> '' group by 1, 2),
builds as (select build, lag(build) over (order by build) as prev from (select distinct build from rows)),
parts as (
  select build, item, v.d as d, list_sort(list_distinct(list_transform(list_filter(str_split(coalesce(v.s, ''), ';'), lambda e: trim(e) <> ''),
      lambda e: trim(regexp_extract(e, '^(.*)\\s[0-9.]+\\s*%\\s*$', 1)) || ' ' || cast(round(cast(regexp_extract(e, '([0-9.]+)\\s*%\\s*$', 1) as decimal(20,8)), 3) as decimal(20,3))))) as s
  from rows),
newer as (select b.build, p.item, p.d, p.s from parts p join builds b on b.build = p.build where b.prev is not null),
older as (select b.build, p.item, p.d, p.s from parts p join builds b on b.prev = p.build),
flags as (select build, item, n.here is null as gone, o.here is null as fresh, n.d as nd, o.d as od, n.s as ns, o.s as os
  from (select *, true as here from newer) n full join (select *, true as here from older) o using (build, item))
select build, item, 'added' as change from flags where fresh
union all select build, item, 'removed' from flags where gone
union all select build, item, 'disposition' from flags where not gone and not fresh and round(abs(nd - od), 6) >= 0.005
union all select build, item, 'drops' from flags where not gone and not fresh and ns <> os
"""


def reference_tables(spark: SparkSession, d: str):
    """The parent tables and the tables that refer to them."""
    items, market = table(spark, d, "de_items"), table(spark, d, "market")
    unresolved = table(spark, d, "unresolved").filter(F.col("source") == "wfm")
    return (
        [references.Parents("de_items", items, "unique_name", "exported_at", "removed_at"), references.Parents("market", market, "slug", "fetched_at", "delisted_at")],
        [
            references.Children("item_costs", "de_items", table(spark, d, "item_costs"), "leaf", "row_id", "built_at"),
            references.Children("item_icons", "de_items", table(spark, d, "item_icons"), "unique_name", "row_id", "packed_at"),
            references.Children("unresolved", "market", unresolved, "key", "row_id", "seen_at"),
        ],
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return references.orphans(*reference_tables(spark, d)).select("ref_table", "ref_month", "row_id")


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_report(references.orphans(*reference_tables(spark, d)))


_KEY = "nullif(replace(lower(trim({}, ' ' || chr(9))), '-', '_'), '')"
_P2 = f"""
with parents as (
  select 'de_items' as parent, {_KEY.format('unique_name')} as key, min(exported_at) as since, max(removed_at) as until from de_items group by 1, 2
  union all select 'market', {_KEY.format('slug')}, min(fetched_at), max(delisted_at) from market group by 1, 2),
refs as (
  select 'item_costs' as ref_table, 'de_items' as parent, {_KEY.format('leaf')} as key, row_id, built_at as at from item_costs
  union all select 'item_icons', 'de_items', {_KEY.format('unique_name')}, row_id, packed_at from item_icons
  union all select 'unresolved', 'market', {_KEY.format('key')}, row_id, seen_at from unresolved where source = 'wfm'),
found as (
  select r.ref_table, strftime(r.at, '%Y-%m') as ref_month, r.row_id, r.key
  from refs r left join parents p on p.parent = r.parent and p.key = r.key
  where r.key is not null and (p.key is null or r.at < p.since or r.at >= p.until))
"""
P2_SQL = _P2 + "select ref_table, ref_month, row_id from found"
P2_REPORT_SQL = _P2 + "select ref_table, ref_month, count(*) as orphan_rows, count(distinct key) as orphan_keys from found group by 1, 2"


def _types(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Rows of items and, without those that are also items, prototypes, by canonical key."""
    items = table(spark, d, "de_items").select(canonical("unique_name").alias("node"), F.col("unique_name").alias("label"), canonical("parent").alias("parent"), "exported_at", "row_id").filter(F.col("node").isNotNull())
    facts = table(spark, d, "facts").select(canonical("path").alias("node"), canonical("parent").alias("parent"), F.col("path").alias("label")).filter(F.col("node").isNotNull()).dropDuplicates(["node"])
    both = items.select("node").join(bounded(facts.select("node")), "node", "left_semi").distinct()
    return items, facts.join(both, "node", "left_anti")


def type_links(spark: SparkSession, d: str) -> DataFrame:
    """``(node, parent, label)`` of items and prototypes by canonical key; of several rows of an item the one exported last."""
    items, facts = _types(spark, d)
    return snapshots.latest(items, ["node"], ["exported_at", "row_id"]).select("node", "parent", "label").unionByName(facts)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Keys are told by 128 bits and spellings by a number, so texts are moved only for the result."""
    items, facts = _types(spark, d)
    facts = cut(facts.withColumn("at", F.monotonically_increasing_id() * 2 + 1))
    short = lambda c: F.unhex(F.md5(c)).alias(c)
    links = snapshots.latest(items.select(short("node"), short("parent"), "exported_at", (F.col("row_id") * 2).alias("label")), ["node"], ["exported_at", "label"])
    found = hierarchy.roots(links.select("node", "parent", "label").unionByName(facts.select(short("node"), short("parent"), F.col("at").alias("label"))))
    spelled = items.select((F.col("row_id") * 2).alias("at"), "label").unionByName(facts.select("at", "label"))
    heads = found.filter("depth = 0").select(F.col("label").alias("at")).join(spelled, "at").select(F.col("at").alias("root_label"), F.col("label").alias("root"))
    rooted = lookup(found, heads, "root_label", found.filter("root_label is not null").groupBy("root_label").agg(F.count("*").alias("n")))
    named = rooted.withColumnRenamed("label", "at").join(spelled.withColumnRenamed("label", "node"), "at")
    return named.select("node", F.coalesce("root", F.lit(hierarchy.CYCLE)).alias("root"), "depth")


def p4_paths(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.hierarchy(type_links(spark, d)).select(F.col("label").alias("node"), "depth", "path", "below", "in_cycle")


def p4_descendants(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.descendants(hierarchy.hierarchy(type_links(spark, d)))


_P4 = f"""
with recursive items as (
  select {_KEY.format('unique_name')} as node, arg_max(struct_pack(p := {_KEY.format('parent')}, s := unique_name), struct_pack(a := exported_at, b := row_id)) as v
  from de_items where {_KEY.format('unique_name')} is not null group by 1),
links as (select node, v.p as parent, v.s as spelled from items
  union all select {_KEY.format('path')}, {_KEY.format('parent')}, path from facts where {_KEY.format('path')} not in (select node from items)),
tree as (
  select node, node as root, cast(0 as bigint) as depth, node as path from links where parent is null or parent not in (select node from links)
  union all select l.node, t.root, t.depth + 1, t.path || ' > ' || l.node from links l join tree t on l.parent = t.node)
"""

_P4_FOUND_SQL = _P4 + """select l.spelled as node, coalesce(r.spelled, 'cycle') as root, coalesce(t.depth, -1) as depth
from links l left join tree t using (node) left join links r on r.node = t.root"""

_P4_DESCENDANTS_SQL = _P4 + """select s[i] as node, node as descendant, depth - i + 1 as distance
from (select node, depth, str_split(path, ' > ') as s, unnest(range(1, depth + 1)) as i from tree)"""


def p6_rows(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten(table(spark, d, "raw_records"), "raw_id", "body")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    rows = p6_rows(spark, d).filter(F.col("val").isNotNull())
    kind = F.when(F.col("type") == "icon", "icon").when((F.col("type") == "name") & (F.col("child_key") == "ru"), "ru_name").when(F.col("type") == "ingredient", "ingredient")
    key = F.when(F.col("type") == "icon", F.col("child_key")).when(F.col("type") == "ingredient", F.col("position")).otherwise("")
    return rows.select("raw_id", kind.alias("child"), key.alias("child_key"), "val").filter(F.col("child").isNotNull())


def p6_variants(spark: SparkSession, d: str) -> DataFrame:
    return p6_rows(spark, d).groupBy("type", "variant").agg(F.count("*").alias("n"))


QUERIES = {
    "p1_found": p1_found, "p1_report": p1_report, "p2_found": p2_found, "p2_report": p2_report,
    "p4_found": p4_found, "p4_paths": p4_paths, "p4_descendants": p4_descendants, "p6_found": p6_found, "p6_variants": p6_variants,
}
SQL = {
    "p1_found": P1_SQL,
    "p1_report": f"with q as ({P1_SQL}) select build, change, count(*) as n from q group by 1, 2",
    "p2_found": P2_SQL,
    "p2_report": P2_REPORT_SQL,
    "p4_found": _P4_FOUND_SQL,
    "p4_descendants": _P4_DESCENDANTS_SQL,
}
