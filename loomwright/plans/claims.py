"""Claims, rules and name resolution over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions import text
from loomwright.operators import consensus, project, resolve, rules
from loomwright.plans.registry import Registry, Tables

R = Registry()
query = R.query


def status_claims(t: Tables) -> DataFrame:
    """What the order, its lines and the lines' majority say of an order's status."""
    lines = t("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus") == "F").alias("f"), F.count_if(F.col("l_linestatus") == "O").alias("o"))
    joined = t("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    rule = F.when(F.col("f") == F.col("n"), "F").when(F.col("o") == F.col("n"), "O").when(F.col("n") > 0, "P")
    major = F.when(F.col("n") > 0, F.when(F.col("f") >= F.col("o"), "F").otherwise("O"))
    return consensus.claims_of(joined, "o_orderkey", "status", {"de": F.col("o_orderstatus"), "rule": rule, "wfm": major})


def priorities(t: Tables) -> DataFrame:
    return t("region").limit(1).select(F.inline(F.array(*[F.struct(F.lit("status").alias("prop"), F.lit(s).alias("source"), F.lit(i).alias("rank")) for i, s in enumerate(("rule", "de"))])))


_CLAIMS = """
with lines as (select l_orderkey, count(*) as n, count(*) filter (l_linestatus = 'F') as f, count(*) filter (l_linestatus = 'O') as o from lineitem group by 1),
joined as (select o_orderkey, o_orderstatus, n, f, o from orders left join lines on l_orderkey = o_orderkey),
claims as (
  select cast(o_orderkey as varchar) as entity, 'status' as prop, 'de' as source, o_orderstatus as value, 0 as ord from joined
  union all select cast(o_orderkey as varchar), 'status', 'rule', case when f = n then 'F' when o = n then 'O' else 'P' end, 1 from joined where n > 0
  union all select cast(o_orderkey as varchar), 'status', 'wfm', case when f >= o then 'F' else 'O' end, 2 from joined where n > 0),
resolved as (
  select entity, prop, arg_min(value, case source when 'rule' then 0 when 'de' then 1 else 100 + ord end) as value,
    arg_min(source, case source when 'rule' then 0 when 'de' then 1 else 100 + ord end) as winner, string_agg(source, ',' order by ord) as sources,
    case when count(distinct value) > 1 then 'conflict' when count(*) > 1 then 'confirmed' else 'single' end as status
  from claims group by 1, 2)
"""


@query(_CLAIMS + "select * from resolved")
def consensus_resolve(t: Tables) -> DataFrame:
    return consensus.resolve(status_claims(t), priorities(t))


@query(_CLAIMS + """select entity, prop, r.value as chosen, string_agg(source || '=' || c.value, ' ' order by ord) as detail
from claims c join resolved r using (entity, prop) where status = 'conflict' group by 1, 2, 3""")
def conflict_claims(t: Tables) -> DataFrame:
    return consensus.conflict_claims(status_claims(t), consensus.resolve(status_claims(t), priorities(t)))


@query(_CLAIMS + """, tagged as (select r.*, o_orderpriority as kind from resolved r join orders on cast(o_orderkey as varchar) = entity where status <> 'confirmed' or o_orderpriority <> '5-LOW')
select kind, prop, count(*) as n from tagged group by 1, 2 having count(*) filter (status = 'confirmed') = 0""")
def never_confirmed(t: Tables) -> DataFrame:
    resolved = consensus.resolve(status_claims(t), priorities(t))
    kinds = t("orders").select(F.col("o_orderkey").cast("string").alias("entity"), F.col("o_orderpriority").alias("kind"))
    return consensus.tally_never_confirmed(resolved.join(kinds, "entity").filter("status <> 'confirmed' or kind <> '5-LOW'"), "kind")


@query("""select o_orderkey, prop, value from (
select o_orderkey, 'status' as prop, o_orderstatus as value from orders union all select o_orderkey, 'priority', o_orderpriority from orders) where value is not null""")
def provenance_long(t: Tables) -> DataFrame:
    return project.long_provenance(t("orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")), "o_orderkey", ["status", "priority"])


@query("select c_nationkey, min(c_mktsegment) as c_mktsegment from customer where c_acctbal > 9900 group by 1 having count(distinct c_mktsegment) = 1")
def single_currency(t: Tables) -> DataFrame:
    return consensus.only_value(t("customer").filter("c_acctbal > 9900"), "c_nationkey", "c_mktsegment")


@query("select l_partkey, min(l_returnflag) as l_returnflag from lineitem where l_quantity > 48 group by 1 having count(distinct l_returnflag) = 1")
def unanimous_group(t: Tables) -> DataFrame:
    return consensus.only_value(t("lineitem").filter("l_quantity > 48"), "l_partkey", "l_returnflag")


@query("""with v as (select l_orderkey, l_returnflag, count(*) as votes from lineitem group by 1, 2)
select l_orderkey, l_returnflag, votes from v qualify row_number() over (partition by l_orderkey order by votes desc, l_returnflag desc) = 1""")
def majority_vote(t: Tables) -> DataFrame:
    return consensus.majority(t("lineitem"), "l_orderkey", "l_returnflag")


@query("""with p as (select distinct p_name, p_type from part where p_size < 6)
select p_name, case when count(*) > 1 then 'ambiguous' when min(p_type) = p_name then 'verbatim' else 'map' end as kind, count(*) as n, min(p_type) as first from p group by 1""")
def ambiguous_values(t: Tables) -> DataFrame:
    return consensus.ambiguity(t("part").filter("p_size < 6"), "p_name", "p_type")


@query("""with m as (select o_orderkey, o_orderstatus as observed from orders where o_orderkey % 3 <> 0),
l as (select l_orderkey, l_linestatus, count(*) as v from lineitem group by 1, 2),
w as (select l_orderkey, l_linestatus as witness from l qualify row_number() over (partition by l_orderkey order by v desc, l_linestatus desc) = 1)
select coalesce(o_orderkey, l_orderkey) as o_orderkey, case when observed is null then 'fillable' when witness is null then 'single' when observed = witness then 'agreed' when observed = 'P' then 'accepted' else 'disagree' end as verdict
from m full join w on l_orderkey = o_orderkey""")
def label_witness(t: Tables) -> DataFrame:
    """Labels with gaps against the observed majority: agreed, accepted, disagree, fillable, single."""
    labels = t("orders").filter("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_orderstatus").alias("observed"))
    witness = consensus.majority(t("lineitem"), "l_orderkey", "l_linestatus").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("witness"))
    verdict = F.when(F.col("observed").isNull(), "fillable").when(F.col("witness").isNull(), "single").when(F.col("observed") == F.col("witness"), "agreed").when(F.col("observed") == "P", "accepted").otherwise("disagree")
    return labels.join(witness, "o_orderkey", "full").select("o_orderkey", verdict.alias("verdict"))


@query("""with a as (select p_partkey, p_name as x, case p_partkey % 4 when 0 then upper(p_name) when 1 then p_name || ' (' || p_type || ')' when 2 then null else p_name || ' new' end as y from part)
select p_partkey, case when y is null then x when lower(x) = lower(y) then x when p_partkey % 4 = 1 then y else x end as name,
case when y is null then 'single' when lower(x) = lower(y) or p_partkey % 4 = 1 then 'confirmed' else 'conflict' end as status from a""")
def item_merge(t: Tables) -> DataFrame:
    """Two spellings of each name: case apart, with a parenthetical, missing, reworded."""
    k = F.col("p_partkey") % 4
    rows = t("part").withColumn("other", F.when(k == 0, F.upper("p_name")).when(k == 1, F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))).when(k == 3, F.concat("p_name", F.lit(" new"))))
    name, status = consensus.reconcile(F.col("p_name"), F.col("other"))
    return rows.select("p_partkey", name.alias("name"), status.alias("status"))


@query("""with d as (select p_partkey, 'LATE' as p_type, 2 as ord from part where p_partkey % 10 = 0 union all select p_partkey, 'EARLY', 1 from part where p_partkey % 5 = 0)
select p.p_partkey, p.p_name, coalesce(x.p_type, p.p_type) as p_type from part p left join (select p_partkey, arg_max(p_type, ord) as p_type from d group by 1) x using (p_partkey)""")
def decision_overlay(t: Tables) -> DataFrame:
    part = t("part").select("p_partkey", "p_name", "p_type")
    made = part.filter("p_partkey % 10 = 0").select("p_partkey", F.lit("LATE").alias("p_type"), F.lit(2).alias("ord"))
    made = made.unionByName(part.filter("p_partkey % 5 = 0").select("p_partkey", F.lit("EARLY").alias("p_type"), F.lit(1).alias("ord")))
    return consensus.overlay(part, made, "p_partkey", ["p_type"])


RULES = [
    rules.Rule("cheap red", {"p_name:starts": ["red "], "p_type": ["ECONOMY", "SMALL"]}),
    rules.Rule("never", {"p_name": ["no such name"]}),
    rules.Rule("ringed", {"p_name:word": ["ring", "gear"]}),
    rules.Rule("branded", {"p_brand": ["Brand#1", "Brand#2", "Brand#3"]}),
    rules.Rule("rest", {"p_type:contains": ["E", "A"]}, fallback=True),
]
_RULED = """with d as (select p_partkey, case when p_name like 'red %' and p_type in ('ECONOMY', 'SMALL') then 0 when p_name = 'no such name' then 1
when list_has_any(str_split(p_name, ' '), ['ring', 'gear']) then 2 when p_brand in ('Brand#1', 'Brand#2', 'Brand#3') then 3 when p_type like '%E%' or p_type like '%A%' then 4 end as rule from part)
"""


@query(_RULED + "select p_partkey, rule, case rule when 0 then 'cheap red' when 1 then 'never' when 2 then 'ringed' when 3 then 'branded' when 4 then 'rest' else 'unknown' end as result from d")
def classify_first_match(t: Tables) -> DataFrame:
    return rules.decide(t("part"), RULES).select("p_partkey", "rule", "result")


@query(_RULED + "select * from (values (0, 'cheap red'), (1, 'never'), (2, 'ringed'), (3, 'branded')) v(rule, result) where rule not in (select rule from d where rule is not null)")
def dead_rules(t: Tables) -> DataFrame:
    return rules.dead(rules.decide(t("part"), RULES), RULES)


@query("""with x as (select name_n, p_partkey, p_name, p_size from part join (select p_name as n, count(*) as name_n from part where p_size <= 2 group by 1) u on u.n = p_name)
select p_partkey, case when p_size > 45 then 'large' when p_partkey in (select p_partkey from x) and p_size > 40 then 'twin' end as reason
from part where case when p_size > 45 then 'large' when p_partkey in (select p_partkey from x) and p_size > 40 then 'twin' end is not null and p_brand <> 'Brand#9'""")
def scope_policy(t: Tables) -> DataFrame:
    """First excluding rule with its reason; one brand is let through, a large one with a small namesake is a twin."""
    part = t("part")
    marked = part.join(part.filter("p_size <= 2").select("p_name").distinct().withColumn("twin", F.lit(True)), "p_name", "left").withColumn("twin", F.coalesce(F.col("twin").cast("string"), F.lit("")))
    marked = marked.withColumn("size", F.when(F.col("p_size") > 45, "huge").when(F.col("p_size") > 40, "big").otherwise("fine"))
    decided = rules.decide(marked, [rules.Rule("large", {"size": ["huge"]}), rules.Rule("twin", {"size": ["big"], "twin": ["true"]})], default="")
    return decided.filter("result <> '' and p_brand <> 'Brand#9'").select("p_partkey", F.col("result").alias("reason"))


@query("""select p_partkey, case when p_name like '%anvil%' then null when p_size > 40 then p_size when p_type = 'PROMO' then 40 else 30 end as cap from part""")
def mastery_cap(t: Tables) -> DataFrame:
    """Excluded rows have no cap; else the source's own, else the first of their kind, else the default."""
    decided = rules.decide(t("part"), [rules.Rule("out", {"p_name:contains": ["anvil"]}), rules.Rule("40", {"p_type": ["PROMO"]})], default="30")
    cap = F.when(F.col("result") == "out", None).otherwise(F.coalesce(F.when(F.col("p_size") > 40, F.col("p_size")), F.col("result").try_cast("int")))
    return decided.select("p_partkey", cap.alias("cap"))


# names


@query("select p_name, min(p_partkey) as p_partkey, count(*) > 1 as ambiguous from part where p_size < 4 group by 1")
def name_index(t: Tables) -> DataFrame:
    return resolve.name_index(t("part").filter("p_size < 4"), "p_name", "p_partkey")


@query("""with printed as (select p_partkey as row_id, case p_partkey % 4 when 0 then '1,500X ' || p_name when 1 then p_name || ' x 20' when 2 then '10 x ' || p_name else p_name end as printed, p_name, case p_partkey % 4 when 0 then 1500 when 1 then 20 when 2 then 10 end as quantity from part),
idx as (select p_name, min(p_partkey) as target from part where p_size < 20 group by 1), hand as (select p_name, 900000 as target from part where p_name = 'red bolt' group by 1)
select row_id, quantity, coalesce(h.target, i.target) as target, case when h.target is not null then 'curated' when i.target is not null then 'name' end as how from printed left join hand h using (p_name) left join idx i using (p_name)""")
def resolve_printed(t: Tables) -> DataFrame:
    """Printed names with quantities, by hand first, then by the name index."""
    k = F.col("p_partkey") % 4
    printed = t("part").select(F.col("p_partkey").alias("row_id"), F.when(k == 0, F.concat(F.lit("1,500X "), "p_name")).when(k == 1, F.concat("p_name", F.lit(" x 20"))).when(k == 2, F.concat(F.lit("10 x "), "p_name")).otherwise(F.col("p_name")).alias("printed"))
    read = printed.select("row_id", text.quantity(F.col("printed")).alias("quantity"), text.normal(text.without_quantity(F.col("printed"))).alias("name"))
    index = resolve.name_index(t("part").filter("p_size < 20"), "p_name", "p_partkey").select(F.col("p_name").alias("key"), F.col("p_partkey").alias("target"))
    hand = t("part").filter("p_name = 'red bolt'").select(F.col("p_name").alias("key"), F.lit(900000).cast("bigint").alias("target")).distinct()
    found = resolve.cascade(read.select("row_id", "name"), "row_id", [("curated", F.col("name"), hand), ("name", F.col("name"), index)])
    return read.select("row_id", "quantity").join(found, "row_id")


@query("""select p_name, count(*) as row_count, arg_min(p_brand, p_partkey) as p_brand from part where p_name not in (select p_name from part where p_size = 1) group by 1""")
def orphan_names(t: Tables) -> DataFrame:
    part = t("part")
    return resolve.orphan_names(part.join(part.filter("p_size = 1").select("p_name").distinct(), "p_name", "left_anti"), "p_name", "p_brand", "p_partkey")


@query("""with s as (select distinct replace(p_name, ' ', '_') || '_' || lower(replace(p_brand, '#', '_')) as slug from part),
b as (select distinct replace(p_name, ' ', '_') as base from part where p_size < 10 union select distinct str_split(p_name, ' ')[1] from part where p_size > 40)
select slug, arg_max(base, length(base)) as base from s join b on slug = base or starts_with(slug, base || '_') group by 1""")
def longest_prefix_owner(t: Tables) -> DataFrame:
    slugs = t("part").select(F.concat(text.slug(F.col("p_name")), F.lit("_"), text.slug(F.col("p_brand"))).alias("slug"))
    bases = t("part").filter("p_size < 10").select(text.slug(F.col("p_name")).alias("base")).union(t("part").filter("p_size > 40").select(F.split("p_name", " ")[0]))
    return resolve.longest_prefix(slugs, "slug", bases, "base")


@query("""with used as (select l_partkey, count(distinct l_suppkey) as n, min(l_suppkey) as owner from lineitem group by 1)
select distinct p_partkey, owner from (select l_partkey as p_partkey, owner from used where n = 1
union all select p_partkey, cast(p_size as bigint) from part where p_type = 'PROMO' and p_size < 3)""")
def set_members(t: Tables) -> DataFrame:
    """Parts that one supplier alone delivers, or that are tagged and so belong to the set of their size."""
    alone = consensus.only_value(t("lineitem"), "l_partkey", "l_suppkey").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("owner"))
    tagged = t("part").filter("p_type = 'PROMO' and p_size < 3").select("p_partkey", F.col("p_size").cast("bigint").alias("owner"))
    return resolve.any_of([alone, tagged])


@query("""with a as (select distinct l_suppkey as s, l_partkey as i from lineitem where l_quantity > 30), b as (select distinct s_nationkey as n, l_partkey as i from lineitem join supplier on s_suppkey = l_suppkey where l_quantity <= 20 and l_discount < 0.03),
p as (select s, n, count(*) as shared from a join b using (i) group by 1, 2 having count(*) >= 3),
best as (select * from p qualify row_number() over (partition by s order by shared desc, n) = 1)
select s as l_suppkey, n as s_nationkey, shared from best join (select s, count(*) as na from a group by 1) using (s) join (select n, count(*) as nb from b group by 1) using (n) where shared >= 0.2 * least(na, nb)""")
def best_overlap(t: Tables) -> DataFrame:
    lines = t("lineitem").join(t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    return resolve.best_overlap(lines.filter("l_quantity > 30"), lines.filter("l_quantity <= 20 and l_discount < 0.03"), "l_partkey", "l_suppkey", "s_nationkey", 3, 0.2)


@query("""with s as (select s_suppkey, 'label ' || cast(cast(floor(s_acctbal) as bigint) % 40 as varchar) as label from supplier), g as (select label, min(s_suppkey) as into_, count(*) as n from s group by 1 having count(*) > 1)
select s_suppkey, into_ as "into" from s join g using (label)""")
def same_label_merge(t: Tables) -> DataFrame:
    rows = t("supplier").withColumn("label", F.concat(F.lit("label "), (F.floor("s_acctbal") % 40).cast("string")))
    return resolve.same_label(rows, "s_suppkey", "label")


@query("""with n as (select distinct p_type as folder, replace(p_name, ' ', '') as name from part union select distinct p_type, str_split(p_name, ' ')[1] from part where p_size > 25)
select a.folder, a.name, arg_min(b.name, length(b.name)) as under from n a join n b on a.folder = b.folder and starts_with(a.name, b.name) and a.name <> b.name group by 1, 2""")
def sibling_prefix(t: Tables) -> DataFrame:
    names = t("part").select(F.col("p_type").alias("folder"), F.replace(F.col("p_name"), F.lit(" "), F.lit("")).alias("name"))
    names = names.union(t("part").filter("p_size > 25").select("p_type", F.split("p_name", " ")[0]))
    return resolve.shortest_sibling(names, "folder", "name")


@query("""with u as (select p_name, count(*) as n, min(p_partkey) as k from part where p_size = 7 group by 1)
select o.p_partkey as row_id, coalesce(a.p_partkey, u.k) as target, case when a.p_partkey is not null then 'reference' when u.k is not null then 'name' end as how
from part o left join part a on a.p_partkey = o.p_partkey + 1 and a.p_size < 10 left join u on u.p_name = o.p_name and u.n = 1""")
def link_cascade(t: Tables) -> DataFrame:
    """By reference if it is in the catalog, else by a name only one item has."""
    part = t("part")
    by_ref = part.filter("p_size < 10").select(F.col("p_partkey").alias("key"), F.col("p_partkey").alias("target"))
    by_name = resolve.unique_index(part.filter("p_size = 7"), "p_name", "p_partkey").select(F.col("p_name").alias("key"), F.col("p_partkey").alias("target"))
    return resolve.cascade(part.select(F.col("p_partkey").alias("row_id"), "p_partkey", "p_name"), "row_id", [("reference", F.col("p_partkey") + 1, by_ref), ("name", F.col("p_name"), by_name)])


@query("""with g as (select p_name, count(*) filter (p_size < 3) as good, min(p_partkey) as a, max(p_partkey) as b, min(case when p_size < 3 then p_partkey end) as ga, max(case when p_size < 3 then p_partkey end) as gb from part group by 1)
select p_name, coalesce(ga, a) as p_partkey from g where coalesce(ga, a) = coalesce(gb, b)""")
def unique_name_index(t: Tables) -> DataFrame:
    return resolve.unique_index(t("part"), "p_name", "p_partkey", F.col("p_size") < 3)


_PATHS = "select p_partkey, '/P/' || p_type || '/' || replace(p_name, ' ', '') || cast(p_partkey // 5 as varchar) as base, p_partkey % 5 as g, '/P/' || p_type || '/' || replace(p_name, ' ', '') || cast(p_partkey // 5 as varchar) || case p_partkey % 5 when 1 then 'Bronze' when 2 then 'Silver' when 3 then 'Gold' when 4 then 'Radiant' else '' end as path from part"


def paths(t: Tables) -> DataFrame:
    g = F.col("p_partkey") % 5
    base = F.concat(F.lit("/P/"), "p_type", F.lit("/"), F.replace(F.col("p_name"), F.lit(" "), F.lit("")), F.floor(F.col("p_partkey") / 5).cast("string"))
    return t("part").select("p_partkey", F.concat(base, F.when(g == 1, "Bronze").when(g == 2, "Silver").when(g == 3, "Gold").when(g == 4, "Radiant").otherwise("")).alias("path"))


@query(f"with p as ({_PATHS}) select p_partkey, base, case g when 1 then 'Bronze' when 2 then 'Silver' when 3 then 'Gold' when 4 then 'Radiant' else 'Intact' end as grade from p")
def relic_base(t: Tables) -> DataFrame:
    base, of = text.base_and_grade(F.col("path"), ("Intact", "Bronze", "Silver", "Gold", "Radiant"))
    return paths(t).select("p_partkey", base.alias("base"), of.alias("grade"))


@query("""with x as (select p_type as base, p_size % 5 as grade, p_name as path, p_partkey as ord from part), l as (select base, grade, arg_max(path, ord) as path from x group by 1, 2)
select a.base, a.path, b.path as next from l a join l b on a.base = b.base and b.grade = a.grade + 1""")
def refine_chain(t: Tables) -> DataFrame:
    return resolve.chain(t("part").select(F.col("p_type").alias("base"), (F.col("p_size") % 5).alias("grade"), F.col("p_name").alias("path"), F.col("p_partkey").alias("ord")), "base", "grade", "path", "ord")


@query("""select p_name || p_brand as name, max(case when p_size > 25 then p_partkey end) as marked_key, max(case when p_size <= 25 then p_partkey end) as plain_key from part group by 1 having count(*) = 2 and count(*) filter (p_size > 25) = 1""")
def pair_link(t: Tables) -> DataFrame:
    return resolve.pair_link(t("part").withColumn("name", F.concat("p_name", "p_brand")), "name", "p_partkey", F.col("p_size") > 25)


@query("""with d as (select p_partkey, trim(replace(' ' || p_name || ' ', ' old ', ' ')) as bare, p_brand from part where p_name like 'old %' and p_size < 20),
n as (select str_split(p_name, ' ')[2] as bare, p_brand, min(p_partkey) as plain, count(*) as c from part where p_name like 'new %' and p_size < 20 group by 1, 2)
select p_partkey, plain from d join n using (bare, p_brand) where c = 1 and (bare, p_brand) in (select bare, p_brand from d group by 1, 2 having count(*) = 1)""")
def derived_key_link(t: Tables) -> DataFrame:
    """A name less one word and the same brand, where both sides are alone."""
    part = t("part").filter("p_size < 20")
    bare = lambda word: F.array_join(F.filter(F.split("p_name", " "), lambda w: w != word), " ")
    old = resolve.ranked_unique(part.filter(F.col("p_name").startswith("old ")).select("p_partkey", bare("old").alias("bare"), "p_brand"), ["bare", "p_brand"])
    new = resolve.ranked_unique(part.filter(F.col("p_name").startswith("new ")).select(F.col("p_partkey").alias("plain"), bare("new").alias("bare"), "p_brand"), ["bare", "p_brand"])
    return old.join(new, ["bare", "p_brand"]).select("p_partkey", "plain")


@query("""with f as (select s_nationkey, min(case when s_acctbal > 5000 then s_name end) as v from supplier group by 1)
select s_suppkey, coalesce(case when s_acctbal > 5000 then s_name end, v) as slug from supplier join f using (s_nationkey)""")
def fill_down(t: Tables) -> DataFrame:
    rows = t("supplier").withColumn("slug", F.when(F.col("s_acctbal") > 5000, F.col("s_name")))
    return resolve.fill_down(rows, ["s_nationkey"], "slug").select("s_suppkey", "slug")


@query("""select s_nationkey as nationkey, s_name as name from supplier where s_acctbal > 8000
union all select c_nationkey, c_name from customer where c_acctbal > 9900 and c_nationkey not in (select s_nationkey from supplier where s_acctbal > 8000)""")
def fill_missing(t: Tables) -> DataFrame:
    first = t("supplier").filter("s_acctbal > 8000").select(F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name"))
    second = t("customer").filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("nationkey"), F.col("c_name").alias("name"))
    return resolve.supplement(first, second, ["nationkey"])


@query("select distinct l_partkey as src, l_suppkey as dst from lineitem where l_partkey in (select p_partkey from part where p_size < 10) and l_suppkey in (select s_suppkey from supplier where s_acctbal > 0)")
def both_endpoints(t: Tables) -> DataFrame:
    edges = t("lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")).distinct()
    kept, _ = resolve.attach(edges.withColumnRenamed("src", "p_partkey"), t("part").filter("p_size < 10"), "p_partkey")
    kept, _ = resolve.attach(kept.withColumnRenamed("dst", "s_suppkey"), t("supplier").filter("s_acctbal > 0"), "s_suppkey")
    return kept.select(F.col("p_partkey").alias("src"), F.col("s_suppkey").alias("dst"))


@query("""with k as (select distinct l_orderkey as src, l_partkey as dst from lineitem where l_quantity > 45), n as (select o_orderkey as id from orders where o_orderstatus <> 'P' union select p_partkey from part where p_size > 40)
select src, dst, src not in (select id from n) as no_source, dst not in (select id from n) as no_target from k where src not in (select id from n) or dst not in (select id from n)""")
def dangling_edges(t: Tables) -> DataFrame:
    nodes = t("orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id")).union(t("part").filter("p_size > 40").select("p_partkey"))
    return resolve.both_ends(t("lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst")).distinct(), nodes, "id")[1]


@query("""select c_custkey, n_name as area from customer join nation on n_nationkey = c_nationkey where n_regionkey = 1
union select c_custkey, n_name from customer join nation on n_nationkey = c_nationkey where c_mktsegment = 'BUILDING' and n_nationkey < 5
union select o_custkey, 'urgent' from orders where o_orderpriority = '1-URGENT' and o_totalprice > 400000""")
def area_membership(t: Tables) -> DataFrame:
    """In an area by region, by segment and nation, or by an order: three equal joins, no OR."""
    homes = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    urgent = t("orders").filter("o_orderpriority = '1-URGENT' and o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"), F.lit("urgent").alias("area"))
    return resolve.any_of([homes.filter("n_regionkey = 1").select("c_custkey", F.col("n_name").alias("area")), homes.filter("c_mktsegment = 'BUILDING' and n_nationkey < 5").select("c_custkey", F.col("n_name").alias("area")), urgent])


@query("""select l_orderkey from lineitem group by 1 having bool_or(l_returnflag = 'A') and bool_or(l_returnflag = 'N') and bool_or(l_returnflag = 'R')""")
def all_present(t: Tables) -> DataFrame:
    return t("lineitem").groupBy("l_orderkey").agg(*[F.bool_or(F.col("l_returnflag") == f).alias(f) for f in "ANR"]).filter("A and N and R").select("l_orderkey")


QUERIES, SQL = R.queries, R.sql
