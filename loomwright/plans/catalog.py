"""Graphs, chances, checks, states and searches over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions import text
from loomwright.operators import chance, graph, project, quality, resolve, search, state
from loomwright.plans.registry import Registry, Tables
from loomwright.sources import manifests, tables

R = Registry()
query = R.query

# a recipe graph: part k takes 2k+1 and 2k+2 while they are in range

_NEEDS = """needs as (select p_partkey as item, 2 * p_partkey + 1 as part, 1 + p_partkey % 3 as qty from part where 2 * p_partkey + 1 <= (select max(p_partkey) from part)
union all select p_partkey, 2 * p_partkey + 2, 1 + p_partkey % 2 from part where 2 * p_partkey + 2 <= (select max(p_partkey) from part))"""


def needs(t: Tables) -> DataFrame:
    last = t("part").agg(F.max("p_partkey")).scalar()
    k = F.col("p_partkey")
    parts = F.inline(F.array(F.struct((2 * k + 1).alias("part"), (1 + k % 3).alias("qty")), F.struct((2 * k + 2).alias("part"), (1 + k % 2).alias("qty"))))
    return t("part").select(k.alias("item"), parts).filter(F.col("part") <= last)


def recipe_edges(t: Tables) -> DataFrame:
    """Typed edges: recipes require, some parts drop, some are sold."""
    part = t("part")
    dropped = part.filter("p_size < 5").select(F.lit(0).cast("bigint").alias("src"), F.col("p_partkey").alias("dst"), F.lit("drops").alias("rel"))
    sold = part.filter("p_size > 48").select(F.lit(1).cast("bigint").alias("src"), F.col("p_partkey").alias("dst"), F.lit("sells").alias("rel"))
    required = needs(t).select(F.col("item").alias("src"), F.col("part").alias("dst"), F.lit("requires").alias("rel"))
    return dropped.unionByName(sold).unionByName(required)


@query(f"""with recursive {_NEEDS}, stop as (select p_partkey as item from part where p_size < 5),
walk as (select item as root, part as item, qty from needs union all
  select w.root, n.part, w.qty * n.qty from walk w join needs n on n.item = w.item where w.item not in (select item from stop))
select root, item as leaf, cast(sum(qty) as bigint) as qty from walk where item in (select item from stop) or item not in (select item from needs) group by 1, 2""")
def cost_rollup(t: Tables) -> DataFrame:
    return graph.rollup(needs(t), t("part").filter("p_size < 5").select(F.col("p_partkey").alias("item")))


@query(f"""with recursive {_NEEDS}, links as (select item as src, part as dst from needs union select p_partkey, (p_partkey - 1) // 2 from part where p_partkey % 50 = 49),
reach as (select src as root, dst as node from links where src in (select p_partkey from part where p_partkey % 50 = 49) or dst in (select p_partkey from part where p_partkey % 50 = 49) or src in (select (p_partkey - 1) // 2 from part where p_partkey % 50 = 49)
  union select r.root, l.dst from reach r join links l on l.src = r.node where r.root <> r.node)
select distinct root as item from reach where root = node""")
def recipe_cycles(t: Tables) -> DataFrame:
    back = t("part").filter("p_partkey % 50 = 49").select(F.col("p_partkey").alias("src"), F.floor((F.col("p_partkey") - 1) / 2).cast("bigint").alias("dst"))
    return graph.needing_themselves(needs(t).select(F.col("item").alias("src"), F.col("part").alias("dst")).unionByName(back))


@query("select p_partkey as id from part where p_size < 5 or p_size > 48")
def obtainable(t: Tables) -> DataFrame:
    return graph.having(t("part").select(F.col("p_partkey").alias("id")), recipe_edges(t), ["drops", "sells"]).select("id")


@query(f"with {_NEEDS} select distinct item from needs where item not in (select p_partkey from part where p_size > 48) and part in (select p_partkey from part where p_size < 5)")
def dead_recipes(t: Tables) -> DataFrame:
    """Recipes nobody hands over of which a part is farmed."""
    edges = recipe_edges(t)
    handed = edges.filter("rel = 'sells'").select(F.col("dst").alias("item")).distinct()
    farmed = edges.filter("rel = 'drops'").select(F.col("dst").alias("part")).distinct()
    return needs(t).join(handed, "item", "left_anti").join(farmed, "part", "left_semi").select("item").distinct()


@query("""with recursive rec as (select p_partkey as ord, p_partkey as part, (p_partkey * 7 + 3) % (select count(*) from part) as result from part),
s as (select p_partkey as item, cast(-1 as bigint) as made from part where p_size = 1),
g as (select item, made from s union select r.result, r.ord from g join rec r on r.part = g.item and r.ord > g.made)
select distinct item from g""")
def void_economy(t: Tables) -> DataFrame:
    """What one ordered pass over recipes adds to the seeds."""
    total = t("part").agg(F.count("*")).scalar()
    recipes = t("part").select(F.col("p_partkey").alias("ord"), F.col("p_partkey").alias("part"), ((F.col("p_partkey") * 7 + 3) % total).alias("result"))
    return graph.ordered_pass(t("part").filter("p_size = 1").select(F.col("p_partkey").alias("item")), recipes)


@query("""with e as (select s_suppkey as src, 'in nation' as rel, 1000000 + s_nationkey as dst from supplier union all select 1000000 + n_nationkey, 'in region', 2000000 + n_regionkey from nation),
l as (select s_suppkey as id, s_name as label from supplier union all select 1000000 + n_nationkey, n_name from nation union all select 2000000 + r_regionkey, r_name from region)
select src as id, 'out' as way, rel, dst as other, label from e left join l on l.id = dst union all select dst, 'in', rel, src, label from e left join l on l.id = src""")
def neighbourhood(t: Tables) -> DataFrame:
    nation, region = (F.lit(n).cast("bigint") for n in (1_000_000, 2_000_000))
    edges = t("supplier").select(F.col("s_suppkey").alias("src"), F.lit("in nation").alias("rel"), (nation + F.col("s_nationkey")).alias("dst")).unionByName(
        t("nation").select((nation + F.col("n_nationkey")).alias("src"), F.lit("in region").alias("rel"), (region + F.col("n_regionkey")).alias("dst"))
    )
    labels = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label")).union(t("nation").select(nation + F.col("n_nationkey"), "n_name")).union(t("region").select(region + F.col("r_regionkey"), "r_name"))
    return graph.neighbourhood(edges, labels)


@query("select l_partkey as item, l_returnflag as bucket, count(*) as n from lineitem group by 1, 2")
def source_breakdown(t: Tables) -> DataFrame:
    return graph.breakdown(t("lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), "l_returnflag"), F.col("l_returnflag"))


@query("""with recursive ty as (select p_partkey as node, case when p_partkey > 0 then (p_partkey - 1) // 2 end as parent, case when p_size < 10 then p_brand end as brand from part),
w as (select node, node as at_, parent as up, brand, 0 as depth from ty union all select w.node, t.node, t.parent, t.brand, w.depth + 1 from w join ty t on t.node = w.up where w.brand is null)
select t.node, w.brand, w.depth from ty t left join w on w.node = t.node and w.brand is not null""")
def inherited_field(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return graph.inherited(t("part").select(k.alias("node"), F.when(k > 0, F.floor((k - 1) / 2).cast("bigint")).alias("parent"), F.when(F.col("p_size") < 10, F.col("p_brand")).alias("brand")), "brand")


@query("""with seeds as (select p_partkey as id, p_size > 10 as flag from part where p_partkey % 3 = 0), parts as (select distinct l_suppkey as id, l_partkey as of_ from lineitem where l_quantity > 48),
s1 as (select 100000000 + p.id as id, bool_and(flag) as flag from parts p join seeds s on s.id = p.of_ group by 1),
s2 as (select 200000000 + s_nationkey as id, bool_and(flag) as flag from supplier join s1 on s1.id = 100000000 + s_suppkey group by 1)
select id, flag, 0 as step from seeds union all select id, flag, 1 from s1 union all select id, flag, 2 from s2""")
def vault_cascade(t: Tables) -> DataFrame:
    """A flag of every third part, carried to suppliers and on to nations: true if true of all."""
    seeds = t("part").filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("id"), (F.col("p_size") > 10).alias("flag"))
    suppliers = t("lineitem").filter("l_quantity > 48").select((F.lit(100_000_000) + F.col("l_suppkey")).alias("id"), F.col("l_partkey").alias("of")).distinct()
    nations = t("supplier").select((F.lit(200_000_000) + F.col("s_nationkey")).cast("bigint").alias("id"), (F.lit(100_000_000) + F.col("s_suppkey")).alias("of"))
    return graph.cascade_flag(seeds, [suppliers, nations])


@query(f"""with {_NEEDS} select part as item, count(*) as used_by, min(item) as first_use, sum(qty) as qty from needs group by 1""")
def needed_for(t: Tables) -> DataFrame:
    return needs(t).groupBy(F.col("part").alias("item")).agg(F.count("*").alias("used_by"), F.min("item").alias("first_use"), F.sum("qty").alias("qty")).select("item", "used_by", "first_use", "qty")


@query("""with r as (select c_custkey as id, c_nationkey as dir, cast(floor(c_acctbal / 500) as bigint) as icon, case when c_acctbal > 5000 and c_custkey % 3 = 0 then c_mktsegment end as v from customer), l as (select dir, icon, min(v) as v from r where v is not null group by 1, 2)
select r.id, l.v from r join l using (dir, icon) where r.v is null""")
def twin_grants(t: Tables) -> DataFrame:
    """Rows of one directory and icon lend their value to those without one."""
    rows = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("dir"), F.floor(F.col("c_acctbal") / 500).alias("icon"), F.when((F.col("c_acctbal") > 5000) & (F.col("c_custkey") % 3 == 0), F.col("c_mktsegment")).alias("v"))
    return graph.twins(rows, ["dir", "icon"], "id", "v")


# chances


def drops(t: Tables) -> DataFrame:
    """Parts as drops of suppliers: a line's share of what the supplier delivers."""
    lines = t("lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))
    total = lines.groupBy("l_suppkey").agg(F.sum("q").alias("total"))
    return lines.join(total, "l_suppkey").select(F.col("l_suppkey").alias("place"), F.col("l_partkey").alias("item"), (F.col("q") / F.col("total")).alias("chance"))


_DROPS = """lines as (select l_suppkey as place, l_partkey as item, sum(l_quantity) as q from lineitem group by 1, 2), drops as (select place, item, q / sum(q) over (partition by place) as chance from lines)"""


@query(f"with {_DROPS} select item, place, round(chance, 9) as chance, row_number() over (partition by item order by round(chance, 9) desc, place) as pos from drops qualify pos <= 3")
def drop_sources_ranked(t: Tables) -> DataFrame:
    ranked = search.capped(drops(t).withColumn("chance", F.round("chance", 9)), "item", [F.desc("chance"), F.asc("place")], 3)
    return ranked.select("item", "place", "chance", "pos")


@query(f"with {_DROPS} select place, item, cast(ceil(round(1 / chance, 6)) as bigint) as tries, case when chance >= 0.01 then 'common' when chance >= 0.002 then 'uncommon' else 'rare' end as rarity from drops")
def expected_kills(t: Tables) -> DataFrame:
    c = chance.per_roll(F.lit(None).cast("double"), F.col("chance"))
    return drops(t).select("place", "item", F.ceil(F.round(1 / c, 6)).alias("tries"), chance.rarity_ladder(c, {"common": 0.01, "uncommon": 0.002}, "rare").alias("rarity"))


_REWARDS = "rewards as (select l_orderkey, l_partkey, l_linenumber, case when l_discount > 0.07 then 'RARE' when l_discount > 0.03 then 'Uncommon' else 'common' end as rarity from lineitem)"


def rewards(t: Tables) -> DataFrame:
    rarity = F.when(F.col("l_discount") > 0.07, "RARE").when(F.col("l_discount") > 0.03, "Uncommon").otherwise("common")
    rows = t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", rarity.alias("rarity"))
    return chance.share_split(rows, "l_orderkey", "rarity", {"COMMON": 0.76, "UNCOMMON": 0.22, "RARE": 0.02})


_CHANCE = f"{_REWARDS}, chances as (select *, case upper(rarity) when 'COMMON' then 0.76 when 'UNCOMMON' then 0.22 else 0.02 end / count(*) over (partition by l_orderkey, upper(rarity)) as chance from rewards)"


@query(f"with {_CHANCE} select l_orderkey, l_partkey, l_linenumber, round(chance, 9) as chance from chances")
def reward_chance(t: Tables) -> DataFrame:
    return rewards(t).select("l_orderkey", "l_partkey", "l_linenumber", F.round("chance", 9).alias("chance"))


@query(f"with {_CHANCE} select l_orderkey, round(sum(chance), 6) as total from chances group by 1 having abs(sum(chance) - 1) > 0.005")
def chances_sum(t: Tables) -> DataFrame:
    return chance.sum_to_one(rewards(t), "l_orderkey", "chance").select("l_orderkey", F.round("total", 6).alias("total"))


@query("""with t as (select p_brand, p_type, sum(p_size) as total from part group by 1, 2), n as (select p_brand, count(*) as n from t group by 1)
select p_brand, p_name, round(sum(p_size / total / n), 4) as chance, min(p_size) as tier from part join t using (p_brand, p_type) join n using (p_brand) where p_name not like 'old %' group by 1, 2""")
def roster_shares(t: Tables) -> DataFrame:
    rows = t("part").withColumn("shown", F.when(~F.col("p_name").startswith("old "), F.col("p_name")))
    return chance.roster_shares(rows, "p_brand", "p_type", "shown", "p_size", "p_size").select("p_brand", F.col("shown").alias("p_name"), "chance", "tier")


@query("""with r as (select n_regionkey % 3 as pool, n_nationkey % 5 as entry, 1 + n_nationkey % 5 as w from nation group by 1, 2, 3), o as (select pool, entry, w / sum(w) over (partition by pool) / 2 as odds from r),
f as (select pool, string_agg(entry || ':' || w, '|' order by entry) as f from r group by 1) select pool, entry, round(odds, 9) as odds from o where pool in (select min(pool) from f group by f)""")
def pool_odds(t: Tables) -> DataFrame:
    rows = t("nation").select((F.col("n_regionkey") % 3).alias("pool"), (F.col("n_nationkey") % 5).alias("entry"), (1 + F.col("n_nationkey") % 5).alias("w")).distinct().withColumn("size", F.lit(2))
    return chance.pool_odds(rows, "pool", "entry", "w", "size").withColumn("odds", F.round("odds", 9))


# checks


@query("""with m as (select event_type, median(value) as m, count(*) as n from events group by 1), b as (select event_type, greatest(1.0, 3 * 1.4826 * median(abs(value - m))) as band from events join m using (event_type) group by 1)
select event_type, event_id, value, round(m, 6) as median, round(band, 6) as band from events join m using (event_type) join b using (event_type) where n >= 8 and abs(value - m) > band""")
def mad_outliers(t: Tables) -> DataFrame:
    return quality.outliers(t("events"), "event_type", "event_id", "value").withColumns({"median": F.round("median", 6), "band": F.round("band", 6)})


@query("""with c as (select l_orderkey, max(l_returnflag) as flag, cast(count(*) as double) as n from lineitem group by 1), m as (select flag, median(n) as m from c group by 1),
b as (select flag, greatest(1.0, 3 * 1.4826 * median(abs(n - m))) as band from c join m using (flag) group by 1) select flag, l_orderkey, n, m as median, round(band, 6) as band from c join m using (flag) join b using (flag) where abs(n - m) > band""")
def ingredient_outliers(t: Tables) -> DataFrame:
    counts = t("lineitem").groupBy("l_orderkey").agg(F.max("l_returnflag").alias("flag"), F.count("*").cast("double").alias("n"))
    return quality.outliers(counts, "flag", "l_orderkey", "n").withColumn("band", F.round("band", 6))


def windows(t: Tables) -> tuple[DataFrame, DataFrame]:
    lines = t("lineitem").select(F.col("l_suppkey").alias("place"), F.col("l_partkey").alias("item"), "l_quantity", "l_shipdate")
    return lines.filter("l_shipdate < timestamp_ntz'1998-01-01'"), lines.filter("l_shipdate >= timestamp_ntz'1998-01-01' and place % 4 <> 0")


_WINDOWS = """ours as (select l_suppkey as place, l_partkey as item, l_quantity from lineitem where l_shipdate < timestamp '1998-01-01'),
theirs as (select l_suppkey as place, l_partkey as item, l_quantity from lineitem where l_shipdate >= timestamp '1998-01-01' and l_suppkey % 4 <> 0)"""


@query(f"""with {_WINDOWS} select distinct place, item from theirs where place in (select place from ours) and (place, item) not in (select place, item from ours)""")
def witness_missing_ours(t: Tables) -> DataFrame:
    return quality.unwitnessed(*windows(t), "place", "item").filter("side = 'theirs'").select("place", "item")


@query(f"""with {_WINDOWS} select distinct place, item from ours where place in (select place from theirs) and (place, item) not in (select place, item from theirs)""")
def witness_missing_theirs(t: Tables) -> DataFrame:
    return quality.unwitnessed(*windows(t), "place", "item").filter("side = 'ours'").select("place", "item")


@query(f"""with {_WINDOWS}, a as (select place, item, sum(l_quantity) as ours from ours group by 1, 2), b as (select place, item, sum(l_quantity) as theirs from theirs group by 1, 2) select place, item, ours, theirs from a join b using (place, item) where abs(ours - theirs) > 5""")
def chance_differs(t: Tables) -> DataFrame:
    return quality.compare_sums(*windows(t), ["place", "item"], "l_quantity", 5.0)


@query("""with a as (select distinct p_brand as g, p_type as m from part where p_size < 6), b as (select distinct p_brand as g, p_type as m from part where p_size > 44),
j as (select coalesce(a.g, b.g) as g, coalesce(a.m, b.m) as m, a.g is not null as ina, b.g is not null as inb from a full join b on a.g = b.g and a.m = b.m)
select g as p_brand, coalesce(string_agg(m, ',' order by m) filter (not ina), '') as missing, coalesce(string_agg(m, ',' order by m) filter (not inb), '') as extra from j group by 1 having bool_or(ina) and bool_or(inb) and not bool_and(ina and inb)""")
def set_composition(t: Tables) -> DataFrame:
    return quality.composition(t("part").filter("p_size < 6"), t("part").filter("p_size > 44"), "p_brand", "p_type")


@query("""with e as (select n_nationkey, 'NATION_' || cast(n_nationkey as varchar) as n_name, n_nationkey % 5 as n_regionkey from nation where n_nationkey < 12 union all select 99, 'NOWHERE', 1)
select n_nationkey, prop, expected, actual from (select e.n_nationkey, 'n_name' as prop, e.n_name as expected, a.n_name as actual from e left join nation a using (n_nationkey)
union all select e.n_nationkey, 'n_regionkey', cast(e.n_regionkey as varchar), cast(a.n_regionkey as varchar) from e left join nation a using (n_nationkey)) where expected is distinct from actual""")
def anchors_broken(t: Tables) -> DataFrame:
    expected = t("nation").filter("n_nationkey < 12").select("n_nationkey", F.concat(F.lit("NATION_"), F.col("n_nationkey").cast("string")).alias("n_name"), (F.col("n_nationkey") % 5).alias("n_regionkey"))
    expected = expected.union(t("region").limit(1).select(F.lit(99), F.lit("NOWHERE"), F.lit(1)))
    return quality.anchors(expected, t("nation"), "n_nationkey", ["n_name", "n_regionkey"])


def findings(t: Tables) -> DataFrame:
    """Findings of three checks, gathered in order."""
    part = t("part")
    first = quality.finding(part.filter("p_size = 50"), "invariant", "size-limit", F.col("p_partkey"), F.col("p_size"))
    second = quality.finding(part.join(t("lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct(), "p_partkey", "left_anti"), "coverage", "never-delivered", F.col("p_partkey"), F.col("p_name"))
    third = quality.finding(part.filter("p_retailprice > 1000 and p_size < 3"), "cross", "price-differs", F.col("p_partkey"), F.col("p_brand"))
    return quality.gather([first, second, third])


_FINDINGS = """findings as (select 'invariant' as layer, 'size-limit' as rule, cast(p_partkey as varchar) as entity, cast(p_size as varchar) as detail, 0 as check_ord from part where p_size = 50
union all select 'coverage', 'never-delivered', cast(p_partkey as varchar), p_name, 1 from part where p_partkey not in (select l_partkey from lineitem)
union all select 'cross', 'price-differs', cast(p_partkey as varchar), p_brand, 2 from part where p_retailprice > 1000 and p_size < 3),
scoped as (select * from findings where layer in ('invariant', 'silence') or entity not in (select cast(p_partkey as varchar) from part where p_type = 'PROMO'))"""


@query(f"with {_FINDINGS} select layer, rule, count(*) as n from scoped group by 1, 2")
def findings_report(t: Tables) -> DataFrame:
    return quality.report(quality.in_scope(findings(t), t("part").filter("p_type = 'PROMO'").select(F.col("p_partkey").cast("string").alias("entity"))))


@query(f"with {_FINDINGS} select rule, entity, not (rule = 'size-limit' and entity in (select cast(p_partkey as varchar) from part where p_brand = 'Brand#7')) as is_open from findings")
def accepted_partition(t: Tables) -> DataFrame:
    accepted = t("part").filter("p_brand = 'Brand#7'").select(F.lit("size-limit").alias("rule"), F.col("p_partkey").cast("string").alias("entity"))
    return quality.accept(findings(t), accepted).select("rule", "entity", "is_open")


@query(f"with {_FINDINGS}, n as (select *, row_number() over (partition by rule order by entity, detail) as pos, greatest(0, count(*) over (partition by rule) - 40) as more from findings) select rule, entity, pos, more from n where pos <= 40")
def changes_report(t: Tables) -> DataFrame:
    return quality.listed(findings(t)).select("rule", "entity", "pos", "more")


# states


def halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    cut = F.lit("1998-07-01").cast("timestamp_ntz")
    of = lambda rows: rows.groupBy("o_custkey").agg(F.round(F.avg("o_totalprice"), 2).alias("v"))
    return of(t("orders").filter(F.col("o_orderdate") < cut)), of(t("orders").filter(F.col("o_orderdate") >= cut))


_HALVES = """a as (select o_custkey, avg(o_totalprice) as v from orders where o_orderdate < timestamp '1998-07-01' group by 1), b as (select o_custkey, avg(o_totalprice) as v from orders where o_orderdate >= timestamp '1998-07-01' group by 1)"""


@query(f"with {_HALVES} select o_custkey, 'added' as change from b where o_custkey not in (select o_custkey from a) union all select o_custkey, 'removed' from a where o_custkey not in (select o_custkey from b)")
def snapshot_diff(t: Tables) -> DataFrame:
    return state.added_removed(*halves(t), "o_custkey")


@query(f"with {_HALVES} select o_custkey from a join b using (o_custkey) where abs(round(a.v, 2) - round(b.v, 2)) >= 50000")
def moved_sources(t: Tables) -> DataFrame:
    return state.moved(*halves(t), "o_custkey", "v", 50000.0).select("o_custkey")


@query("""select c_custkey, case when c_custkey % 11 = 0 then '3.0.0' when c_custkey % 7 = 0 then '2.0.0' when c_custkey % 5 = 0 or c_custkey % 3 = 0 then '2.5.0' when c_custkey % 2 = 0 then '2.4.9' else '2.4.8' end as version from customer""")
def next_version(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    version = F.when(k % 7 != 0, "2.4.8")
    hit = lambda n: F.when(k % n == 0, 1).otherwise(0)
    return t("customer").select("c_custkey", state.next_version(version, F.when(k % 11 == 0, 3).otherwise(2), hit(5), hit(3), hit(2)).alias("version"))


@query("""with cur as (select distinct event_type || ':' || user_id as key from events where ts >= timestamp '2024-01-20'), prev as (select event_type || ':' || user_id as key, min(epoch_us(ts) // 1000) as since from events where ts < timestamp '2024-01-20' group by 1)
select key, coalesce(since, 1705708800000) as since from cur left join prev using (key)""")
def first_seen_carry(t: Tables) -> DataFrame:
    keyed = t("events").withColumn("key", F.concat_ws(":", "event_type", F.col("user_id").cast("string")))
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    previous = keyed.filter(F.col("ts") < cut).groupBy("key").agg(F.min(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)).alias("since"))
    return state.first_seen(keyed.filter(F.col("ts") >= cut), previous, "key", 1705708800000)


@query("select event_type, user_id, 1706600000000 - max(epoch_us(ts) // 1000) > 7 * 86400000 as settled from events group by 1, 2")
def settled_open(t: Tables) -> DataFrame:
    last = t("events").groupBy("event_type", "user_id").agg(F.max(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)).alias("since"))
    return last.select("event_type", "user_id", state.settled(F.col("since"), 1706600000000).alias("settled"))


@query("""with s as (select o_custkey, year(o_orderdate) as season from orders) select o_custkey, max(season) as season, max(season) = (select max(season) from s) as is_current from s group by 1""")
def current_season(t: Tables) -> DataFrame:
    seasons = t("orders").select("o_custkey", F.year("o_orderdate").cast("bigint").alias("season"))
    last = seasons.agg(F.max("season")).scalar()
    return seasons.groupBy("o_custkey").agg(F.max("season").alias("season")).withColumn("is_current", F.col("season") == last)


# searches and pages


@query("""select p_partkey, p_name from part where p_type = 'PROMO' and p_size > 10 and contains(p_name, 'ring') order by p_name, p_partkey limit 20 offset 20""")
def catalog_page(t: Tables) -> DataFrame:
    rows = t("part").filter((F.col("p_type") == "PROMO") & (F.col("p_size") > 10) & search.contains_text(" Ring ", "p_name"))
    return search.page(rows, [F.asc("p_name"), F.asc("p_partkey")], 20, 20).select("p_partkey", "p_name")


@query("""select facet, n from (select 'large' as facet, count(*) filter (p_size > 25) as n from part where p_type = 'ECONOMY' union all select 'cheap', count(*) filter (p_retailprice < 1000) from part where p_type = 'ECONOMY' union all select 'red', count(*) filter (p_name like 'red%') from part where p_type = 'ECONOMY')""")
def facet_counts(t: Tables) -> DataFrame:
    return search.facets(t("part"), {"large": F.col("p_size") > 25, "cheap": F.col("p_retailprice") < 1000, "red": F.col("p_name").startswith("red")}, F.col("p_type") == "ECONOMY")


@query("""select p_brand, count(*) filter (p_type = 'ECONOMY') as "ECONOMY", count(*) filter (p_type = 'PROMO') as "PROMO", count(*) filter (p_type = 'LARGE') as "LARGE" from part group by 1""")
def coverage_pivot(t: Tables) -> DataFrame:
    return search.pivot_counts(t("part"), "p_brand", "p_type", ["ECONOMY", "PROMO", "LARGE"])


@query("select o_orderpriority, count(*) filter (o_orderstatus = 'F') as done, count(*) filter (o_totalprice > 250000) as dear, count(*) filter (o_orderstatus = 'O' and o_totalprice < 100000) as cheap_open from orders group by 1")
def conditional_tally(t: Tables) -> DataFrame:
    return t("orders").groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_totalprice") > 250000).alias("dear"), F.count_if((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") < 100000)).alias("cheap_open")
    )


@query("""with r as (select l_suppkey, l_orderkey, l_linenumber, l_extendedprice, row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber) as pos, greatest(0, count(*) over (partition by l_suppkey) - 8) as overflow from lineitem)
select l_suppkey, l_orderkey, l_linenumber, pos, overflow from r where pos <= 8""")
def neighbour_cap(t: Tables) -> DataFrame:
    return search.capped(t("lineitem"), "l_suppkey", [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")], 8).select("l_suppkey", "l_orderkey", "l_linenumber", "pos", "overflow")


@query("""with w as (select p_partkey, unnest(str_split(lower(p_name), ' ')) as token, 'name' as field from part union all select p_partkey, unnest(str_split(trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g')), ' ')), 'brand' from part)
select token, p_partkey, field, count(*) as times from w where token <> '' group by 1, 2, 3""")
def search_index(t: Tables) -> DataFrame:
    return search.inverted_index(t("part"), "p_partkey", {"name": "p_name", "brand": "p_brand"})


@query("""select p_partkey, 2 as words, 2 as times from part where p_name = 'red ring'""")
def search_hits(t: Tables) -> DataFrame:
    return search.index_hits(search.inverted_index(t("part"), "p_partkey", {"name": "p_name"}), "p_partkey", "Ring red")


_Q = "q as (select * from (values ('red rnig'), ('larg gizmo'), ('old  Anvill'), ('bolt'), ('zzz')) v(q)), n as (select distinct p_name as name from part)"


def misspelt(t: Tables) -> DataFrame:
    return t("region").limit(1).select(F.explode(F.array(*[F.lit(x) for x in ("red rnig", "larg gizmo", "old  Anvill", "bolt", "zzz")])).alias("q"))


_FOLD = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
_CANDIDATES = f"""{_Q}, qf as (select q, {_FOLD.format('q')} as f from q), nf as (select name, {_FOLD.format('name')} as f from n),
byword as (select distinct q, name from (select q, unnest(str_split(f, ' ')) as w from qf) a join (select name, unnest(str_split(f, ' ')) as w from nf) b using (w)),
cand as (select q, name from byword union all select q, name from qf join nf on qf.f[1] = nf.f[1] where q not in (select q from byword))"""


@query(f"with {_CANDIDATES} select q, name from cand")
def fuzzy_candidates(t: Tables) -> DataFrame:
    return search.candidates(misspelt(t), t("part").select(F.col("p_name").alias("name")), "q", "name")


@query(f"""with {_CANDIDATES}, s as (select q, name, cast(round(100 * greatest(jaro_winkler_similarity({_FOLD.format('q')}, {_FOLD.format('name')}),
 len(list_intersect(list_distinct(str_split({_FOLD.format('q')}, ' ')), list_distinct(str_split({_FOLD.format('name')}, ' ')))) / greatest(len(list_distinct(str_split({_FOLD.format('q')}, ' '))), len(list_distinct(str_split({_FOLD.format('name')}, ' ')))))) as bigint) as score from cand)
select q, name, score, row_number() over (partition by q order by score desc, strlen(name), name) as pos from s where score > 65 qualify pos <= 5""")
def fuzzy_score(t: Tables) -> DataFrame:
    return search.top_hits(misspelt(t), t("part").select(F.col("p_name").alias("name")), "q", "name", 65, 5)


# tables and readers


@query("""select l_orderkey, l_partkey, min(l_linenumber) as l_linenumber from lineitem group by 1, 2""")
def edge_projection(t: Tables) -> DataFrame:
    edges = t("lineitem").select("l_orderkey", "l_partkey", F.lit("has").alias("rel"), F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_linenumber").alias("edge_ord"))
    return project.edge_table(edges, "has", ["l_orderkey", "l_partkey"]).select("l_orderkey", "l_partkey", F.col("edge_ord").alias("l_linenumber"))


@query("select l_suppkey, l_partkey, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def strict_keys(t: Tables) -> DataFrame:
    return project.reconciled(t("lineitem"), ["l_suppkey", "l_partkey"])


@query("select p_brand, row_number() over (order by p_brand) - 1 as ordinal from (select distinct p_brand from part)")
def dimension_ordinals(t: Tables) -> DataFrame:
    return project.dimension(t("part"), "p_brand")


@query("select l_partkey, l_returnflag, l_discount, min(l_orderkey) as l_orderkey from lineitem group by 1, 2, 3")
def row_dedup(t: Tables) -> DataFrame:
    return project.distinct_rows(t("lineitem").select("l_partkey", "l_returnflag", "l_discount", "l_orderkey"), ["l_partkey", "l_returnflag", "l_discount"], "l_orderkey")


@query("select o_custkey, o_orderkey, coalesce(sum(length(o_orderpriority)) over (partition by o_custkey order by o_orderkey rows between unbounded preceding and 1 preceding), 0) as \"offset\" from orders")
def byte_offsets(t: Tables) -> DataFrame:
    return project.offsets(t("orders").withColumn("size", F.octet_length("o_orderpriority")), "o_custkey", "o_orderkey", "size").select("o_custkey", "o_orderkey", "offset")


@query("""select l_orderkey, l_partkey as item, cast(sum(case when l_quantity > 25 then l_quantity else 1 end) as bigint) as qty from lineitem group by 1, 2""")
def sum_repeated(t: Tables) -> DataFrame:
    count = F.when(F.col("l_quantity") > 25, F.col("l_quantity")).otherwise(0).cast("bigint")
    nested = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_partkey").alias("item"), count.alias("count"))).alias("parts"))
    return manifests.summed_parts(nested, "l_orderkey", "parts", "item", "count").select("l_orderkey", "item", "qty")


@query("""select p_partkey, name, value from (select p_partkey, 'impact' as name, p_size % 3 as value from part union all select p_partkey, 'puncture', p_size % 2 from part union all select p_partkey, 'slash', p_size % 5 from part) where value <> 0""")
def zip_nonzero(t: Tables) -> DataFrame:
    return manifests.zipped_nonzero(t("part").withColumn("v", F.array(F.col("p_size") % 3, F.col("p_size") % 2, F.col("p_size") % 5)), "p_partkey", "v", ["impact", "puncture", "slash"])


@query("select l_orderkey, arg_max(l_partkey, cast(l_linenumber as bigint) * 1000000000 + l_partkey) as last_part from lineitem group by 1")
def last_element(t: Tables) -> DataFrame:
    ranks = t("lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("ranks"))
    return ranks.select("l_orderkey", manifests.last_element(F.col("ranks")).alias("last_part"))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def json_projection(t: Tables) -> DataFrame:
    return t("events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("""with e as (select user_id, event_id, event_type, event_type = 'signup' as h, sum(cast(event_type = 'signup' as int)) over (partition by user_id order by event_id rows unbounded preceding) as b from events),
f as (select *, max(case when h then 'signup ' || event_id end) over (partition by user_id, b) as under from e) select event_id, under from f""")
def carry_forward_rows(t: Tables) -> DataFrame:
    header = F.col("event_type") == "signup"
    return tables.carried(t("events"), "user_id", "event_id", header, F.concat(F.lit("signup "), F.col("event_id").cast("string"))).select("event_id", "under")


@query("""with h as (select p_partkey, p_partkey % 3 as k, p_type, p_brand, p_name from part)
select p_partkey, case when k < 2 then k = 0 end as event, case when k < 2 then p_brand end as place, case when k < 2 then p_name end as node, case when k < 2 then p_type end as label, case when k < 2 then k = 0 end as extra from h""")
def heading_parse(t: Tables) -> DataFrame:
    k = F.col("p_partkey") % 3
    printed = F.when(k == 0, F.concat(F.lit("Event: "), "p_brand", F.lit("/"), "p_name", F.lit(" ("), "p_type", F.lit(") Extra"))).when(k == 1, F.concat("p_brand", F.lit("/"), "p_name", F.lit(" ("), "p_type", F.lit(")"))).otherwise(F.col("p_name"))
    return t("part").select("p_partkey", *[c.alias(n) for n, c in text.heading(printed).items()])


@query("""select p_partkey, regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '_', 'g') as slug, lower(p_type) as dashed, upper(p_name[1]) || substr(str_split(p_name, ' ')[1], 2) || ' ' || upper(str_split(p_name, ' ')[2][1]) || substr(str_split(p_name, ' ')[2], 2) as title,
p_type[1] || lower(substr(p_type, 2)) as unshout, strftime(timestamp '2024-01-01' + to_days(cast(p_partkey % 900 as integer)), '%Y.%m.%d') as day from part""")
def text_scalars(t: Tables) -> DataFrame:
    ms = F.lit(1704067200000) + (F.col("p_partkey") % 900) * 86_400_000
    return t("part").select("p_partkey", text.slug(F.concat_ws(" ", "p_name", "p_brand")).alias("slug"), text.dashed(F.col("p_type")).alias("dashed"), text.titled(F.col("p_name")).alias("title"), text.unshout(F.col("p_type")).alias("unshout"), text.civil_day(ms).alias("day"))


@query("""with x as (select p_partkey, case when p_size > 30 then p_brand end as a, case when p_size > 20 then p_type end as b, p_name as c from part)
select p_partkey, coalesce(a, b, c) as price, case when a is not null then 'items' when b is not null then 'standing' else 'platinum' end as how from x""")
def price_cascade(t: Tables) -> DataFrame:
    a, b = F.when(F.col("p_size") > 30, F.col("p_brand")), F.when(F.col("p_size") > 20, F.col("p_type"))
    return t("part").select("p_partkey", F.coalesce(a, b, "p_name").alias("price"), F.when(a.isNotNull(), "items").when(b.isNotNull(), "standing").otherwise("platinum").alias("how"))


@query("""with o as (select l_orderkey, string_agg(l_returnflag || l_linestatus, ',' order by l_returnflag || l_linestatus) as ours from lineitem where l_quantity > 25 group by 1),
w as (select l_orderkey, string_agg(l_returnflag || l_linestatus, ',' order by l_returnflag || l_linestatus) as theirs from lineitem where l_discount > 0.02 group by 1)
select l_orderkey, ours, theirs, ours = theirs as agreed from o join w using (l_orderkey)""")
def slot_list_witness(t: Tables) -> DataFrame:
    listed = lambda rows, name: rows.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list(F.concat("l_returnflag", "l_linestatus"))), ",").alias(name))
    both = listed(t("lineitem").filter("l_quantity > 25"), "ours").join(listed(t("lineitem").filter("l_discount > 0.02"), "theirs"), "l_orderkey")
    return both.withColumn("agreed", F.col("ours") == F.col("theirs"))


@query("""select p_name, min(p_brand) as p_brand from part where p_size >= 30 and p_name not in (select p_name from part where p_size < 2) group by 1""")
def derived_names(t: Tables) -> DataFrame:
    """Names only the second source has, with the first brand that has them."""
    part = t("part")
    return resolve.supplement(part.filter("p_size < 2").select("p_name", "p_brand"), part.filter("p_size >= 30").groupBy("p_name").agg(F.min("p_brand").alias("p_brand")), ["p_name"]).join(
        part.filter("p_size < 2").select("p_name").distinct(), "p_name", "left_anti"
    )


@query("""with x as (select distinct d.row_id, d.item, r.ref_id from drops d join ref_names r on r.kind = 'item' and r.name = d.item), g as (select ref_id, count(*) as n from x group by 1)
select name, n from g join ref_names using (ref_id)""")
def drop_link(t: Tables) -> DataFrame:
    """Drop lines tied to the canonical items they name exactly, counted."""
    names = t("ref_names").filter("kind = 'item'").select(F.col("name").alias("item"), "ref_id")
    return resolve.lookup_small(t("drops").select("row_id", "item"), names, "item").filter("ref_id is not null").groupBy(F.col("item").alias("name")).agg(F.count("*").alias("n"))


QUERIES, SQL = R.queries, R.sql
