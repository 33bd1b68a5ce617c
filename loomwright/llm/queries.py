"""Queries of the problems of training text and learned matching, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions.keys import canonical
from loomwright.llm import leakage, matching, names, packing, sentences, survivors
from loomwright.session import table


def typed_names(spark: SparkSession, d: str) -> DataFrame:
    """``(src_table, field, row_id, kind, value)`` of all columns of typed names."""
    sources = [
        ("drops", "item", "item", None), ("drops", "place", "place", None), ("relic_rows", "reward", "item", None),
        ("unresolved", "name", "item", F.coalesce(F.col("source") != "wfm", F.lit(True))),
    ]
    union = None
    for name, field, kind, only in sources:
        rows = table(spark, d, name)
        rows = (rows if only is None else rows.filter(only)).select(F.lit(name).alias("src_table"), F.lit(field).alias("field"), "row_id", F.lit(kind).alias("kind"), F.col(field).alias("value"))
        union = rows if union is None else union.unionByName(rows)
    return union


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    # a place may leave out where it is and what is done there; a part of an item is another item
    return names.resolve(typed_names(spark, d), table(spark, d, "ref_names"), {"item": True, "place": False}).select("src_table", "field", "row_id", "ref_id")


def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that mean no entry, by how many rows have them."""
    found = names.resolve(typed_names(spark, d), table(spark, d, "ref_names"), {"item": True, "place": False})
    return found.filter("ref_id = 0").groupBy("src_table", "field", "value").agg(F.count("*").alias("n"))


def p5_matches(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with their confidence."""
    return matching.match(table(spark, d, "market"), table(spark, d, "de_items"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_matches(spark, d).select("market_id", "unique_name")


def market_judged(spark: SparkSession, d: str):
    """What the feeds say of ducats and vaulted, judged. Null, zero and negative ducats say nothing."""
    said = survivors.claims(
        table(spark, d, "market"), canonical("slug"), "feed", "fetched_at", "market_id",
        {"ducats": F.when(F.col("ducats") > 0, F.col("ducats")), "vaulted": F.col("vaulted")},
    )
    trust = table(spark, d, "source_trust").select(F.col("feed").alias("source"), "prop", F.col("trust_rank").alias("rank"))
    return survivors.judge(said, trust.groupBy("source", "prop").agg(F.min("rank").alias("rank")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survive(market_judged(spark, d)[0]).select(F.col("grp").alias("slug"), "prop", "val", "conflict")


def p7_truths(spark: SparkSession, d: str) -> DataFrame:
    return survivors.truths(market_judged(spark, d)[0]).select(F.col("grp").alias("slug"), "prop", "val", F.round("likely", 6).alias("likely"))


def p7_sources(spark: SparkSession, d: str) -> DataFrame:
    return market_judged(spark, d)[1].select(F.col("source").alias("feed"), "prop", F.round("sensitivity", 6).alias("sensitivity"), F.round("specificity", 6).alias("specificity"))


def p7_totals(spark: SparkSession, d: str) -> DataFrame:
    """Groups and conflicts by field."""
    return survivors.survive(market_judged(spark, d)[0]).groupBy("prop").agg(F.count("*").alias("n_groups"), F.sum("conflict").alias("conflicts"))


P7_SQL = """
with rows as (select nullif(replace(lower(trim(slug, ' ' || chr(9))), '-', '_'), '') as slug, feed, fetched_at, market_id, ducats, vaulted from market),
many as (select slug from rows where slug is not null group by 1 having count(*) >= 2),
said as (
  select slug, 'ducats' as prop, cast(ducats as varchar) as val, feed, fetched_at, market_id from rows where ducats > 0
  union all select slug, 'vaulted', cast(vaulted as varchar), feed, fetched_at, market_id from rows where vaulted is not null),
ranked as (
  select s.*, row_number() over (partition by s.slug, s.prop order by coalesce(t.trust_rank, 1000000), s.fetched_at desc, s.market_id) as pos
  from said s join many using (slug) left join source_trust t on t.feed = s.feed and t.prop = s.prop)
select slug, prop, max(val) filter (where pos = 1) as val, cast(count(distinct val) > 1 as bigint) as conflict from ranked group by 1, 2
"""


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(packing.sizes(table(spark, d, "documents")))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and unused share by bucket."""
    used = p8_packed(spark, d).groupBy("container").agg(F.max("bucket").alias("bucket"), F.sum("n_tokens").alias("used"), F.count("*").alias("n"))
    return used.groupBy("bucket").agg(
        F.count("*").alias("containers"), F.sum("n").alias("pieces"), F.sum("used").alias("tokens"), F.round(1 - F.sum("used") / (F.count("*") * packing.CAPACITY), 6).alias("unused")
    )


def p8_whole(spark: SparkSession, d: str) -> DataFrame:
    """One row: texts put in, containers over capacity, texts cut without need, and texts whose pieces don't add up."""
    sized = packing.sizes(table(spark, d, "documents"))
    packed = packing.pack(sized)
    over = packed.groupBy("container").agg(F.sum("n_tokens").alias("n")).agg(F.count_if(F.col("n") > packing.CAPACITY).alias("over"))
    texts = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("piece").alias("piece")).join(sized, "doc_id")
    told = texts.agg(F.count("*").alias("texts"), F.count_if((F.col("piece") > 0) & (F.col("n") <= packing.CAPACITY)).alias("cut"), F.count_if(F.col("n") != F.col("n_tokens")).alias("wrong"))
    return told.withColumn("one", F.lit(1)).join(over.withColumn("one", F.lit(1)), "one").drop("one")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Test items that leaked, with the number of documents."""
    return p9_found(spark, d).groupBy("item_id").agg(F.count("*").alias("n_docs"))


def p9_whole(spark: SparkSession, d: str) -> DataFrame:
    """Of the leaks those whose document holds all letters and digits of the item in a row: SQL can find these by itself."""
    plain = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    found = p9_found(spark, d)
    documents = table(spark, d, "documents").select("doc_id", plain("text").alias("document"))
    items = table(spark, d, "eval_items").select("item_id", plain("text").alias("item"))
    return found.join(items, "item_id").join(documents, "doc_id").filter(F.col("document").contains(F.col("item"))).select("doc_id", "item_id")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.split(table(spark, d, "documents"), lang=F.col("lang"))


def p10_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of every document with the longest in characters."""
    return p10_found(spark, d).groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.max(F.col("end_char") - F.col("start_char")).alias("longest"))


def p10_cover(spark: SparkSession, d: str) -> DataFrame:
    """Letters and digits of every document that stand in its sentences, which must be all it has, once each."""
    spans = p10_found(spark, d).join(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    letters = F.length(F.regexp_replace(F.substring(F.col("text"), F.col("start_char").cast("int") + 1, (F.col("end_char") - F.col("start_char")).cast("int")), r"[^\p{L}\p{N}]", ""))
    return spans.groupBy("doc_id").agg(F.sum(letters).cast("bigint").alias("n_letters"))


QUERIES = {
    "p3_found": p3_found, "p3_unmatched": p3_unmatched, "p5_found": p5_found, "p5_matches": p5_matches,
    "p7_found": p7_found, "p7_truths": p7_truths, "p7_sources": p7_sources, "p7_totals": p7_totals, "p8_packed": p8_packed, "p8_fill": p8_fill, "p8_whole": p8_whole,
    "p9_found": p9_found, "p9_items": p9_items, "p9_whole": p9_whole, "p10_found": p10_found, "p10_lengths": p10_lengths, "p10_cover": p10_cover,
}
SQL = {
    "p7_found": P7_SQL,
    "p8_whole": """select count(*) as texts, cast(0 as bigint) as over, cast(0 as bigint) as cut, cast(0 as bigint) as wrong from documents where text <> ''""",
    "p9_whole": """with d as (select doc_id, regexp_replace(lower(text), '[^\\p{L}\\p{N}]', '', 'g') as t from documents),
i as (select item_id, regexp_replace(lower(text), '[^\\p{L}\\p{N}]', '', 'g') as t from eval_items)
select doc_id, item_id from d join i on contains(d.t, i.t) where i.t <> ''""",
    "p10_cover": """select doc_id, length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) as n_letters from documents where trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''""",
    "p7_totals": f"with q as ({P7_SQL}) select prop, count(*) as n_groups, sum(conflict) as conflicts from q group by 1",
}
