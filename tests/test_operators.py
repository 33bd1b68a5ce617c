"""The operators on the small cases that define them."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwright.functions import text
from loomwright.operators import chance, consensus, graph, project, quality, resolve, rules, search, skew, state


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def one(spark, column, *values):
    names = [f"c{i}" for i in range(len(values))]
    return spark.createDataFrame([values], T.StructType([T.StructField(n, T.StringType()) for n in names])).select(column(*[F.col(n) for n in names])).first()[0]


def test_consensus_truth_table(spark):
    said = [
        ("1", "p", "de", "a", 0), ("2", "p", "de", "a", 0), ("2", "p", "wfm", "a", 1), ("3", "p", "wfm", "b", 0), ("3", "p", "de", "a", 1), ("4", "p", "wfm", "a", 0), ("4", "p", "curated", "a", 1),
        ("5", "p", "de", "a", 0), ("5", "p", "de", "b", 1), ("6", "p", "de", None, 0),
    ]
    claims = spark.createDataFrame(said, "entity string, prop string, source string, value string, ord int")
    priority = spark.createDataFrame([("p", "curated", 0), ("p", "de", 1)], "prop string, source string, rank int")
    got = {r["entity"]: tuple(r)[2:] for r in consensus.resolve(claims, priority).collect()}
    assert got == {
        "1": ("a", "de", "de", "single"), "2": ("a", "de", "de,wfm", "confirmed"), "3": ("a", "de", "wfm,de", "conflict"), "4": ("a", "curated", "wfm,curated", "confirmed"), "5": ("a", "de", "de", "conflict"),
    }
    assert rows(consensus.conflict_claims(claims, consensus.resolve(claims, priority)).filter("entity = '3'")) == [("3", "p", "a", "wfm=b de=a")]
    assert consensus.resolve(claims.limit(0), priority).count() == 0


def test_reconcile_names(spark):
    frame = spark.createDataFrame([("Lex", "LEX"), ("Lex", "Lex (Old)"), ("Lex", "Rex"), (None, "Lex"), ("Lex", None), ("Lex", "Lex Two"), ("Lex (Old)", "Lex"), ("Lex prime", "LEX Prime (Kept)")], "a string, b string")
    name, status = consensus.reconcile(F.col("a"), F.col("b"))
    assert [tuple(r) for r in frame.select(name, status).collect()] == [("Lex", "confirmed"), ("Lex (Old)", "confirmed"), ("Lex", "conflict"), ("Lex", "single"), ("Lex", "single"), ("Lex", "conflict"), ("Lex (Old)", "conflict"), ("LEX Prime (Kept)", "confirmed")]


def test_first_rule_wins_and_dead_rules(spark):
    listed = [rules.Rule("x", {"a": ["1", "2"], "b:starts": ["q"]}), rules.Rule("y", {"a": ["1"]}), rules.Rule("shadowed", {"a": ["1"], "b": ["z"]}), rules.Rule("z", {}, fallback=True)]
    frame = spark.createDataFrame([("1", "qq"), ("1", "z"), ("2", "z"), (None, None)], "a string, b string")
    assert [r["result"] for r in rules.decide(frame, listed).collect()] == ["x", "y", "z", "z"]
    assert rows(rules.dead(rules.decide(frame, listed), listed)) == [(2, "shadowed")]
    assert rules.provisional(listed) == ["z"] and rules.decide(frame, []).first()["result"] == "unknown"


def test_resolution(spark):
    names = spark.createDataFrame([("/A/S", "sunder"), ("/B/S", "sunder"), ("/C", "lone"), ("/D", None)], "path string, name string")
    assert rows(resolve.name_index(names, "name", "path")) == [("lone", "/C", False), ("sunder", "/A/S", True)]
    assert rows(resolve.unique_index(names, "name", "path")) == [("lone", "/C")]
    assert rows(resolve.unique_index(names, "name", "path", F.col("path").startswith("/B"))) == [("lone", "/C"), ("sunder", "/B/S")]
    slugs, bases = spark.createDataFrame([("mag_prime_set",), ("magnus_barrel",), ("other",)], "s string"), spark.createDataFrame([("mag",), ("mag_prime",), (None,)], "b string")
    assert rows(resolve.longest_prefix(slugs, "s", bases, "b")) == [("mag_prime_set", "mag_prime")]
    a = spark.createDataFrame([("c", i) for i in range(4)] + [("d", 9)], "k string, i int")
    b = spark.createDataFrame([("v", i) for i in range(4)] + [("u", i) for i in range(4)] + [("w", 9)], "o string, i int")
    assert rows(resolve.best_overlap(a, b, "i", "k", "o", 3, 0.9)) == [("c", "u", 4)]
    pairs = spark.createDataFrame([("n", 1, True), ("n", 2, False), ("m", 3, True), ("m", 4, True), ("l", 5, True), ("l", 6, False), ("l", 7, False)], "name string, k int, adult boolean")
    assert rows(resolve.pair_link(pairs, "name", "k", F.col("adult"))) == [("n", 1, 2)]
    grades = spark.createDataFrame([("r", 0, "a", 1), ("r", 1, "b", 1), ("r", 1, "b2", 2), ("r", 3, "d", 1)], "base string, g int, path string, o int")
    assert rows(resolve.chain(grades, "base", "g", "path", "o")) == [("r", "a", "b2")]
    folders = spark.createDataFrame([("f", "ab"), ("f", "abc"), ("f", "abcd"), ("g", "abcd")], "folder string, name string")
    assert rows(resolve.shortest_sibling(folders, "folder", "name")) == [("f", "abc", "ab"), ("f", "abcd", "ab")]
    ends = spark.createDataFrame([("c", "x"), ("x", "c"), ("c", "c")], "src string, dst string").withColumn("_other", F.lit(1))
    assert resolve.both_ends(ends, spark.createDataFrame([("c",)], "id string"), "id")[1].count() == 2


def test_cost_rollup(spark):
    needs = spark.createDataFrame([("frame", "chassis", 1), ("frame", "cell", 3), ("chassis", "cell", 2), ("chassis", "plate", 5), ("a", "b", 2), ("b", "leaf", 3), ("cell", "spores", 7)], "item string, part string, qty bigint")
    stop = spark.createDataFrame([("cell",)], "item string")
    got = {tuple(r)[:2]: r["qty"] for r in graph.rollup(needs, stop).collect()}
    assert got[("frame", "cell")] == 5 and got[("frame", "plate")] == 5 and got[("a", "leaf")] == 6 and got[("cell", "spores")] == 7 and ("frame", "spores") not in got
    with pytest.raises(ValueError):
        graph.rollup(spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "item string, part string, qty bigint"), levels=5)


def test_circles_lines_and_odds(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "leaf"), ("x", "y"), ("y", "z"), ("s", "s"), ("a", "s")], "src string, dst string")
    assert rows(graph.needing_themselves(links)) == [("a",), ("b",), ("s",)]
    types = spark.createDataFrame([("r", None, "v"), ("m", "r", None), ("l", "m", None), ("o", "gone", None)], "node string, parent string, f string")
    assert rows(graph.inherited(types, "f")) == [("l", "v", 2), ("m", "v", 1), ("o", None, None), ("r", "v", 0)]
    trees = spark.createDataFrame([("t", "u", 0.72), ("t", "w", 0.28), ("u", "p", 0.25), ("u", "q", 0.75)], "node string, child string, chance double")
    got = {r["leaf"]: (round(r["chance"], 4), r["tier"]) for r in graph.nested_odds(trees).collect()}
    assert got == {"p": (0.18, 0.72), "q": (0.54, 0.72), "w": (0.28, 0.28)}
    recipes = spark.createDataFrame([(1, "c", "d"), (2, "a", "c"), (3, "c", "e")], "ord bigint, part string, result string")
    assert rows(graph.ordered_pass(spark.createDataFrame([("a",)], "item string"), recipes)) == [("a",), ("c",), ("e",)]
    seeds = spark.createDataFrame([("r1", True), ("r2", False)], "id string, flag boolean")
    parts = spark.createDataFrame([("p", "r1"), ("q", "r1"), ("q", "r2"), ("r1", "r2")], "id string, of string")
    assert {r["id"]: r["flag"] for r in graph.cascade_flag(seeds, [parts]).collect()} == {"r1": True, "r2": False, "p": True, "q": False}


def test_chances(spark):
    slots = spark.createDataFrame([("r", "common", i) for i in range(3)] + [("r", "UNCOMMON", 3), ("r", "uncommon", 4), ("r", "rare", 5), ("r", "odd", 6)], "relic string, rarity string, i int")
    split = chance.share_split(slots, "relic", "rarity", {"COMMON": 0.76, "UNCOMMON": 0.22, "RARE": 0.02})
    got = {r["i"]: r["chance"] for r in split.collect()}
    assert math.isclose(got[0], 0.76 / 3) and math.isclose(got[3], 0.11) and got[6] is None
    assert chance.sum_to_one(split, "relic", "chance").count() == 0
    spawns = spark.createDataFrame([("p", "s", "Lancer", 1.0, 0), ("p", "s", None, 0.3, 1)], "place string, roster string, name string, w double, tier int")
    assert rows(chance.roster_shares(spawns, "place", "roster", "name", "w", "tier")) == [("p", "Lancer", 0.7692, 0)]
    tries = spark.createDataFrame([(0.3,), (0.0,), (None,)], "c double").select(chance.expected_tries(F.col("c"))).collect()
    assert [r[0] for r in tries] == [4, None, None]


def test_outliers(spark):
    data = [("g", f"e{i}", 6.0) for i in range(10)] + [("g", "odd", 20.0), ("few", "a", 1.0), ("few", "b", 90.0), ("g", "none", None)] + [("h", f"e{i}", 4.0) for i in range(10)] + [("h", "near", 5.0)]
    assert [r["entity"] for r in quality.outliers(spark.createDataFrame(data, "grp string, entity string, value double"), "grp", "entity", "value").collect()] == ["odd"]


def test_findings(spark):
    f = spark.createDataFrame([("invariant", "a", "x", "d"), ("cross", "b", "x", "d"), ("cross", "b", "y", "d"), ("silence", "c", "x", "d")], "layer string, rule string, entity string, detail string")
    out = spark.createDataFrame([("x",)], "entity string")
    assert rows(quality.in_scope(f, out).select("rule", "entity")) == [("a", "x"), ("b", "y"), ("c", "x")]
    assert [r["is_open"] for r in quality.accept(f, spark.createDataFrame([("b", "y")], "rule string, entity string")).orderBy("rule", "entity").collect()] == [True, True, False, True]
    assert quality.blocked(f) and not quality.blocked(f.filter("layer <> 'invariant'"))
    assert [r["more"] for r in quality.listed(f.filter("rule = 'b'"), 1).collect()] == [1]


def test_state(spark):
    now, seen = spark.createDataFrame([("old",), ("new",)], "k string"), spark.createDataFrame([("old", 1000), ("gone", 5)], "k string, since bigint")
    assert rows(state.first_seen(now, seen, "k", 9000)) == [("new", 9000), ("old", 1000)]
    days = spark.createDataFrame([(0,), (86_400_000 * 3,), (None,)], "s bigint").select(state.settled(F.col("s"), 7 * 86_400_000 + 1)).collect()
    assert [r[0] for r in days] == [True, False, True]
    versions = spark.createDataFrame([("1.2.3", 1, 1, 1), ("1.2.3", 0, 1, 1), ("1.2.3", 0, 0, 1), ("1.2.3", 0, 0, 0), (None, 0, 0, 0)], "v string, r int, a int, c int")
    assert [r[0] for r in versions.select(state.next_version(F.col("v"), F.lit(1), F.col("r"), F.col("a"), F.col("c"))).collect()] == ["1.3.0", "1.3.0", "1.2.4", "1.2.3", "1.0.0"]
    assert [r[0] for r in versions.select(state.next_version(F.col("v"), F.lit(2), F.col("r"), F.col("a"), F.col("c"))).distinct().collect()] == ["2.0.0"]


def test_similarity_and_search(spark):
    pairs = [("Quick Thinking", "quick  thinking"), ("clashing forest", "clashing forest stance"), ("Orokin Cell", "Quick Thinking"), ("dwayne", "duane"), ("", "a")]
    got = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").select(search.similarity(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 100 and got[1] >= 66 and got[2] < 65 and got[3] == 84
    frame = spark.range(45).withColumn("name", F.concat(F.lit("n"), "id"))
    assert [r["id"] for r in search.page(frame, [F.asc("id")], 40, 20).collect()] == [40, 41, 42, 43, 44]
    assert search.page(frame, [F.asc("id")], 99, 20).first()["id"] == 0 and search.page(frame, [F.asc("id")], 0, 0).count() == 45
    index = search.inverted_index(spark.createDataFrame([(1, "Ёж Two"), (2, None)], "id int, t string"), "id", {"t": "t"})
    assert rows(index.select("token", "id")) == [("two", 1), ("еж", 1)] and search.index_hits(index, "id", "two ЁЖ".lower()).count() == 1


def test_text(spark):
    for printed, n, name in [("100X Oxium", 100, "Oxium"), ("1,500X Ferrite", 1500, "Ferrite"), ("10 x Ki'Teer Fireworks", 10, "Ki'Teer Fireworks"), ("Cipher x 100", 100, "Cipher"), ("2,000 Credits Cache", None, "2,000 Credits Cache"), ("3 Day Booster", None, "3 Day Booster")]:
        assert one(spark, text.quantity, printed) == n and one(spark, text.without_quantity, printed) == name
    assert one(spark, text.without_stack, "Adramal Alloy X20 Blueprint") == "Adramal Alloy Blueprint" and one(spark, text.without_stack, "Vapor X 10 Blueprint") == "Vapor Blueprint" and one(spark, text.without_stack, "Lith X1") == "Lith X1"
    assert one(spark, text.percent, "Uncommon (12.50%)") == 0.125 and one(spark, text.label_of_rate, "Uncommon (12.50%)") == "Uncommon" and one(spark, text.percent, "none") is None
    for phrase, is_name in [("Sister of Parvos", True), ("Crit / 100 Damage", False), ("One Two Three Four Five", False), ("The end of", True), ("the End", False), ("Look Here!", False), ("Walk there Now", False), ("", False)]:
        assert one(spark, text.is_name, phrase) == is_name, phrase
    told = lambda printed: tuple(one(spark, lambda c, k=k: text.heading(c)[k], printed) for k in ("place", "node", "label", "event", "extra"))
    assert told("Mars/Gradivus (Sabotage)") == ("Mars", "Gradivus", "Sabotage", False, False) and told("Event: Void/Ani (Caches) Extra") == ("Void", "Ani", "Caches", True, True)
    assert told("Tactical: Mars/Ani (Caches)")[:2] == ("Tactical: Mars", "Ani") and told("No Place Here") == (None,) * 5
    assert one(spark, lambda c: F.concat_ws("|", *text.grade(c)), "Lith Q3 Relic (Radiant)") == "Lith Q3 Relic|radiant" and one(spark, lambda c: text.grade(c)[1], "Lith Q3 (Old)") is None
    assert one(spark, lambda c: F.concat_ws("|", *text.split_levels(c)), "Corrupted One (Level 0 - 50)") == "Corrupted One|0|50" and one(spark, lambda c: text.split_levels(c)[0], "One (Level x)") == "One (Level x)"
    assert [one(spark, text.is_amount, x) for x in ("100 Endo", "1,500 Credits Cache", "Ducats", "Return: 5", "Oxium", "Two Endo")] == [True, True, True, True, False, False]
    assert [one(spark, text.is_service, x) for x in ("3 Day Booster", "Rubedo Resource Bundle ", "Booster")] == [True, True, False]
    assert one(spark, text.is_tiered, "/A/Expert/B") and not one(spark, text.is_tiered, "/A/Experts/B") and one(spark, text.names_enemies, "modByAvatar")
    assert [one(spark, text.place_kind, x) for x in ("keyRewards", "missionRewards", "cetusRewards", "modByDrop")] == ["key", "node", "bounty", "node"]
    assert one(spark, lambda c: text.grouped(c.cast("bigint")), "1234567") == "1\u202f234\u202f567"
    assert one(spark, lambda c: text.civil_day(c.cast("bigint")), "1787173743000") == "2026.08.19" and one(spark, lambda c: text.civil_day(c.cast("bigint")), "0") == "1970.01.01"
    assert one(spark, text.common_prefix, "abcd", "abxd") == "ab" and one(spark, text.words_missing, "a b c", "b") == "a c" and one(spark, text.url_encoded, "a b/c") == "a%20b/c"
    assert one(spark, lambda c: F.concat_ws("-", *text.level_range(c)), "Level 5 - 15 Cetus") == "5-15" and one(spark, text.fuzzy_fold, " A--b ") == "a b"
    assert one(spark, text.clean_json, '{"a":\x01 1}') == '{"a":  1}' and one(spark, lambda c: text.filetime_ms(c.cast("bigint")), "116444736000000000") == 0


def test_projection(spark):
    edges = spark.createDataFrame([(2, "a", "x", "r"), (1, "a", "x", "r"), (3, "b", "x", "q")], "edge_ord int, src string, dst string, rel string")
    assert rows(project.edge_table(edges, "r", ["src", "dst"]).select("src", "edge_ord")) == [("a", 1)]
    files = spark.createDataFrame([("g", "b", "1\r\n2"), ("g", "a", "x"), ("h", "a", "x"), ("h", "b", "1\n2")], "grp string, name string, body string")
    assert len({r["print"] for r in project.fingerprint(files, "grp", "name", "body").collect()}) == 1
    blobs = project.put_new(files, spark.createDataFrame([], "blob string"), "body")
    assert blobs.count() == 3 and project.put_new(files, blobs, "body").count() == 0


def test_lookup_with_hot_and_null_keys(spark):
    left = spark.range(1000).select(F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("key"), "id")
    right = spark.createDataFrame([("hot", 1), ("3", 2)], "key string, v int")
    counts = left.filter("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    joined = skew.lookup(left, right, "key", counts, share=10)
    assert joined.count() == 1000 and joined.filter("v = 1").count() == 500 and joined.filter("v = 2").count() == 1
    assert skew.lookup(left, right, "key", counts, "inner", share=10).count() == 501


def test_streaming_first_seen(spark, tmp_path):
    from loomwright.streaming.first_seen import first_seen

    t0 = dt.datetime(2025, 1, 1)
    spark.createDataFrame([("a", t0), ("a", t0 + dt.timedelta(hours=1)), ("b", t0)], "k string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, ts timestamp").parquet(str(tmp_path / "in"))
    query = first_seen(stream, ["k"], "ts").writeStream.format("memory").queryName("first_seen_test").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r["k"] for r in spark.table("first_seen_test").collect()) == ["a", "b"]
