"""The general data problems on small inputs: nulls, repeats, ties, empty tables and clashing names."""

import datetime as dt
import json

from pyspark.sql import functions as F

from loomwright.functions.keys import canonical
from loomwright.operators import hierarchy, nested, references, snapshots

T0 = dt.datetime(2025, 1, 1)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_canonical_keys(spark):
    got = spark.createDataFrame([(" \tA-b ",), ("",), (None,), ("  ",)], "k string").select(canonical("k")).collect()
    assert [r[0] for r in got] == ["a_b", None, None, None]


def snapshot(spark, data):
    return spark.createDataFrame(data, "b bigint, k string, d double, v string, s array<string>, step int, sign int")


def test_diff_reports_added_removed_and_changed(spark):
    data = [
        (1, "a", 1.0, "x", ["p", "q"], 0, 0), (1, "b", 1.0, "x", None, 0, 0), (1, "c", None, None, [], 0, 0),
        (3, "a", 1.006, "x", ["q", "p", "p"], 0, 0), (3, "c", 2.0, "y", None, 0, 0), (3, "d", None, None, None, 0, 0), (3, None, None, None, None, 0, 0),
        (4, "a", 1.007, "x", ["q"], 0, 0), (4, "c", 2.0, None, [], 0, 0), (4, "d", None, None, [], 0, 0),
    ]
    got = rows(snapshots.diff(snapshot(spark, data), "b", "k", {"d": 0.005}, ["v"], {"s": F.col("s")}))
    assert got == [(3, "a", "d"), (3, "b", "removed"), (3, "c", "v"), (3, "d", "added"), (4, "a", "s"), (4, "c", "v")]


def test_diff_of_nothing_or_one_build(spark):
    empty = snapshot(spark, [])
    assert rows(snapshots.diff(empty, "b", "k", {"d": 0.1})) == []
    assert rows(snapshots.diff(snapshot(spark, [(1, "a", 1.0, "x", None, 0, 0)]), "b", "k", {"d": 0.1})) == []


def test_latest_keeps_one_row_of_ties(spark):
    frame = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (2, 1, None)], "k int, at int, v string")
    assert rows(snapshots.latest(frame, ["k"], ["at", "v"])) == [(1, 5, "y"), (2, 1, None)]


def test_orphans_by_key_and_time(spark):
    parents = spark.createDataFrame([("A-x", T0, None), ("a_X ", T0 + dt.timedelta(5), None), ("b", T0, T0 + dt.timedelta(9)), (None, T0, None)], "k string, since timestamp_ntz, until timestamp_ntz")
    late = T0 + dt.timedelta(40)
    children = spark.createDataFrame(
        [(1, "a_x", late), (2, "B", T0 + dt.timedelta(9)), (3, "b", T0), (4, "zz", late), (5, None, late), (6, "", late), (7, "a-x", T0 - dt.timedelta(1)), (8, "zz", None)],
        "row_id bigint, ref string, at timestamp_ntz",
    ).withColumn("key", F.lit("clash"))
    found = references.orphans([references.Parents("p", parents, "k", "since", "until")], [references.Children("c", "p", children, "ref", "row_id", "at")])
    assert rows(found.select("row_id", "ref_month")) == [(2, "2025-01"), (4, "2025-02"), (7, "2024-12"), (8, None)]
    assert rows(references.orphan_report(found).select("ref_month", "orphan_rows", "orphan_keys").filter("ref_month is not null"))[0] == ("2024-12", 1, 1)


def test_orphans_with_one_hot_key(spark):
    parents = spark.createDataFrame([("h", T0, None)], "k string, since timestamp_ntz, until timestamp_ntz")
    children = spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, "h").otherwise(F.concat(F.lit("x"), F.col("id") % 7)).alias("ref"), F.lit(T0).cast("timestamp_ntz").alias("at"))
    found = references.orphans([references.Parents("p", parents, "k", "since", "until")], [references.Children("c", "p", children, "ref", "id", "at")])
    assert found.count() == 1500


LINKS = [("a", None), ("b", "a"), ("c", "b"), ("d", "a"), ("e", "gone"), ("x", "y"), ("y", "z"), ("z", "x"), ("t", "x"), ("u", "t"), ("s", "s"), ("aa", "s")]


def brute(links):
    up, out = dict(links), {}
    for n in up:
        seen, at = [], n
        while at in up and at not in seen:
            seen.append(at)
            at = up[at]
        out[n] = ("cycle", -1) if at in seen else (seen[-1], len(seen) - 1)
    return out


def test_hierarchy_against_brute_force(spark):
    frame = spark.createDataFrame(LINKS, "node string, parent string")
    want = brute(LINKS)
    for size in (100, 2):  # walked whole, and resolved by joins
        got = {r["node"]: r for r in hierarchy.hierarchy(frame, component_nodes=size).collect()}
        assert {n: (r["root"], r["depth"]) for n, r in got.items()} == want
        assert {n for n, r in got.items() if r["in_cycle"]} == {"x", "y", "z", "s"}
        assert got["c"]["path"] == "a > b > c" and got["a"]["below"] == 3
    assert sum(r["back_edge"] is not None for r in hierarchy.hierarchy(frame).collect()) == 2


def test_hierarchy_of_a_long_chain_and_of_nothing(spark):
    links = [(f"n{i:04}", f"n{i - 1:04}" if i else None) for i in range(1500)]
    got = {r["node"]: r["depth"] for r in hierarchy.hierarchy(spark.createDataFrame(links, "node string, parent string")).collect()}
    assert got == {f"n{i:04}": i for i in range(1500)}
    assert hierarchy.hierarchy(spark.createDataFrame([], "node string, parent string")).count() == 0


def test_descendants(spark):
    walked = hierarchy.hierarchy(spark.createDataFrame(LINKS, "node string, parent string"))
    assert rows(hierarchy.descendants(walked).filter("node = 'a'")) == [("a", "b", 1), ("a", "c", 2), ("a", "d", 1)]


def test_nested_shapes(spark):
    bodies = [
        {"slug": "s", "icons": {"en": "e.png", "ru": None}, "ru_name": "имя"},
        {"data": {"item": {"slug": "s", "icons": [{"lang": "de", "path": "d.png"}, {"lang": "en", "path": ""}], "names": [{"lang": "ru", "name": "ы"}]}}},
        {"slug": "s", "i18n": {"ru": {"name": "я", "icon": "r.png"}, "en": {"name": "x"}}},
        {"ingredients": {"item": "/a", "recipe": {"ingredients": [{"ItemType": "/b"}, {"ItemType": "/c", "recipe": {"ingredients": {"item": "/d"}}}]}}},
        {"recipes": [{"ingredients": json.dumps([{"item": "/q", "count": "3"}])}]},
        {"payload": {"recipe": {"ingredients": []}}},
    ]
    data = [(i, json.dumps(b)) for i, b in enumerate(bodies)] + [(90, None), (91, "<html>"), (92, "[]"), (93, '{"slug": "cut'), (94, "7"), (95, "")]
    found = nested.flatten(spark.createDataFrame(data, "raw_id bigint, body string"), "raw_id", "body")
    got = rows(found.filter("val is not null and type in ('icon', 'name', 'ingredient')").select("raw_id", "type", F.coalesce("child_key", "position"), "val"))
    assert got == sorted(
        [(0, "icon", "en", "e.png"), (0, "name", "ru", "имя"), (1, "icon", "de", "d.png"), (1, "name", "ru", "ы"), (2, "icon", "ru", "r.png"), (2, "name", "en", "x"), (2, "name", "ru", "я"),
         (3, "ingredient", "0", "/a"), (3, "ingredient", "0.0", "/b"), (3, "ingredient", "0.1", "/c"), (3, "ingredient", "0.1.0", "/d"), (4, "ingredient", "0", "/q")], key=str,
    )
    links = found.filter("raw_id = 3").select("node", "above", "type").collect()
    assert all(r["above"] is None or r["above"] < r["node"] for r in links)
    assert rows(nested.subtype(found, "ingredient").filter("raw_id = 4").select("item", "amount")) == [("/q", "3")]


def test_bodies_that_cannot_be_read_are_told_of(spark):
    data = [(1, "<html>"), (2, None), (3, " "), (4, "[" * 100_000 + "]" * 100_000), (5, '{"slug": "s"}')]
    found = nested.flatten(spark.createDataFrame(data, "raw_id bigint, body string"), "raw_id", "body")
    assert rows(found.select("raw_id", "type")) == [(1, "unread"), (4, "unread"), (5, "listing")]


def test_keys_that_hold_the_separator_and_walks_of_several_parts(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "TOGETHER", 3)
    links = [("a > b", None), ("c", "a > b"), ("d > e > f", "c")] + [(f"n{i}", f"n{i - 1}" if i % 4 else None) for i in range(40)]
    frame = spark.createDataFrame(links, "node string, parent string")
    want = {("a > b", "c", 1), ("a > b", "d > e > f", 2), ("c", "d > e > f", 1)}
    for most in (200_000, 2):
        walked = hierarchy.hierarchy(frame, most)
        assert {tuple(r) for r in hierarchy.descendants(walked).collect() if not r["node"].startswith("n")} == want
        assert {r["node"]: r["below"] for r in walked.collect()} == {"a > b": 2, "c": 1, "d > e > f": 0, **{f"n{i}": 3 - i % 4 for i in range(40)}}


def test_hierarchy_is_the_same_in_all_columns_whatever_the_size_of_components(spark):
    # a circle whose least node isn't the least of its component, below which trees hang, and siblings of several sizes
    links = [*LINKS, ("a1", "z"), ("a0", "a1"), ("ab", "b"), ("m", "n"), ("n", "m"), ("l", None), *[(f"l{i}", "l") for i in range(9)], *[(f"l{i}k", f"l{i}") for i in range(0, 9, 2)], ("l4kk", "l4k")]
    frame = spark.createDataFrame([(n, p, n.upper()) for n, p in links], "node string, parent string, label string")
    walked, joined = (rows(hierarchy.hierarchy(frame, size)) for size in (100, 0))
    assert walked == joined and len(walked) == len(links)
    assert not [r for r in joined if None in r[6:9]]
    assert rows(hierarchy.roots(frame)) == sorted(((n.upper(), None if depth < 0 else root.upper(), depth) for n, (root, depth) in brute(links).items()), key=str)


def test_found_types_need_no_walk_and_keep_their_spelling(spark, tmp_path, monkeypatch):
    from loomwright.plans import core_problems

    day = lambda n: T0 + dt.timedelta(n)
    items = [
        (1, "/A/X-y", None, day(0)), (2, "/a/x_Y ", "/P/Root", day(1)), (3, "/A/Z", "/a/X_Y", day(0)), (4, "/A/Q", "/A/R", day(0)), (5, "/A/R", "/a/q", day(0)),
        (6, "/A/U", "/A/R", day(0)), (7, "/P/Both", "/A/Z", day(0)), (8, "/A/D", "/gone", day(0)), (9, " ", None, day(0)),
    ]
    spark.createDataFrame(items, "row_id bigint, unique_name string, parent string, exported_at timestamp_ntz").write.parquet(str(tmp_path / "de_items.parquet"))
    spark.createDataFrame([("/P/Root", ""), ("/p/both", None), ("/P/Sub", "/p/root")], "path string, parent string").write.parquet(str(tmp_path / "facts.parquet"))
    monkeypatch.setattr(hierarchy, "hierarchy", None)
    assert rows(core_problems.p4_found(spark, str(tmp_path))) == sorted(
        [("/a/x_Y ", "/P/Root", 1), ("/A/Z", "/P/Root", 2), ("/A/Q", "cycle", -1), ("/A/R", "cycle", -1), ("/A/U", "cycle", -1), ("/P/Both", "/P/Root", 3), ("/A/D", "/A/D", 0),
         ("/P/Root", "/P/Root", 0), ("/P/Sub", "/P/Root", 1)], key=str,
    )
