"""Readers on the shapes they must take and those they must refuse."""

import json

import pytest
from pyspark.sql import functions as F

from loomwright.sources import literals, manifests, policies, tables


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_manifest_objects(spark):
    body = json.dumps({"ExportA": [{"uniqueName": "/a", "name": "A", "n": 2.7}, {"uniqueName": "", "name": "B"}, 7], "ExportB": [{"uniqueName": "/c"}], "x": 1})
    bodies = spark.createDataFrame([("m", body.replace('"A"', '"A\\u0041\x01"')), ("bad", "{"), ("none", None)], "manifest string, body string")
    found = manifests.project(manifests.objects(bodies), {"unique_name": "uniqueName"}, {"name": ("name", "string"), "n": ("n", "bigint"), "category": ("cat", "string")}, {"category": F.col("manifest")})
    assert rows(found.select("array_name", "unique_name", "category")) == [("ExportA", "/a", "m"), ("ExportB", "/c", "m")]


def test_manifest_lists(spark):
    frame = spark.createDataFrame([("b", [("x", 2), ("y", 0), ("x", 3), (None, 1)])], "k string, parts array<struct<item:string,count:bigint>>")
    assert rows(manifests.summed_parts(frame, "k", "parts", "item", "count").select("item", "qty", "pos")) == [("x", 5, 0), ("y", 1, 1)]
    assert rows(manifests.zipped_nonzero(spark.createDataFrame([(1, [0.0, 2.0, 3.0])], "k int, v array<double>"), "k", "v", ["a", "b"])) == [(1, "b", 2.0)]
    lines = spark.createDataFrame([("ExportX_en.json!h1",), ("Other.json!h2",), ("broken",)], "value string")
    assert rows(manifests.index_lines(lines)) == [("ExportX", "en", "h1"), ("Other", None, "h2")]


def test_lua():
    assert literals.lua_table('local x = {}\nreturn { a = 5 * 80, ["b c"] = {1, -2, math.huge}, -- note\n d = "q\\"x", e = {k = true, 7}, f = nil }') == {
        "a": 400.0, "b c": [1.0, -2.0, float("inf")], "d": 'q"x', "e": {"items": [7.0], "fields": {"k": True}}, "f": None,
    }
    assert literals.lua_table("local t = {}\nt = {1}\nt = {2}", "t") == [1.0]
    for bad in ("return function() end", "return {f()}", "x = 1", "return {1", "return {1/0}"):
        with pytest.raises(literals.LiteralError):
            literals.lua_table(bad)


def test_notation():
    assert literals.notation_block("a=1\nb={\nc=2\n{x=1,y=2}\n}\nl=\n{\nq\nw\n}") == {"a": "1", "b": {"c": "2", "items": [{"x": "1", "y": "2"}]}, "l": {"items": ["q", "w"]}}
    for bad in ("}", "a={"):
        with pytest.raises(literals.LiteralError):
            literals.notation_block(bad)


def test_parsed_keeps_errors(spark):
    frame = spark.createDataFrame([(1, "return {a=1}"), (2, "return {f()}"), (3, None)], "id int, t string")
    got = literals.parsed(frame, "t", "lua").select("id", F.try_variant_get("value", "$.a", "double").alias("a"), F.col("error").isNotNull().alias("bad"))
    assert rows(got) == [(1, 1.0, False), (2, None, True), (3, None, True)]


HTML = """<h3 id="missions">M</h3><table><tr><th colspan=2>Mercury/Apollo (Rescue)</th></tr><tr><th>Rotation A</th></tr><tr><td>Endo</td><td>Common (50.00%)</td></tr>
<tr><th>Rotation B</th></tr><tr><th>Stage 2</th></tr><tr><td>Cell</td><td>Rare (5%)</td></tr><tr><th>Venus/E (Spy)</th></tr><tr><td class="pad"></td><td>Gem</td><td>Rare (1%)</td></tr><tr><th>Empty/None</th></tr></table>
<h3 id="byitem">I</h3><table><tr><th>Cell</th></tr><tr><td>Grineer</td><td>Rare (3.00%)</td></tr></table><h3 id="relics">R</h3><table><tr><th>Axi A1 (Intact)</th></tr><tr><td>Barrel</td><td>Uncommon (11%)</td></tr></table>"""


def test_drop_tables(spark):
    found = tables.cells(spark.createDataFrame([("d", HTML), ("e", None)], "doc string, html string"), "doc", "html")
    got = rows(tables.drop_rows(found, by_enemy=("byitem",)).select("section", "item", "place", "rotation", "stage", "rarity", "chance"))
    assert got == [
        ("byitem", "Cell", "Grineer", None, None, "Rare", 0.03), ("missions", "Cell", "Mercury/Apollo (Rescue)", "B", "Stage 2", "Rare", 0.05), ("missions", "Endo", "Mercury/Apollo (Rescue)", "A", None, "Common", 0.5),
        ("missions", "Gem", "Venus/E (Spy)", None, None, "Rare", 0.01), ("relics", "Barrel", "Axi A1 (Intact)", None, None, "Uncommon", 0.11),
    ]
    assert rows(tables.relic_rows(found).filter("relic like 'Axi%'").select("relic", "refinement", "reward")) == [("Axi A1", "intact", "Barrel")]
    assert ("d", "missions", "Empty/None") in rows(tables.unread(found)[0])


def test_policies(spark, tmp_path):
    path = tmp_path / "p.toml"
    path.write_text('[[rule]]\nkind = "a"\nname = ["x", "y"]\n[[rule]]\nkind = "b"\nfallback = true\n')
    assert rows(policies.read_toml(spark, str(path), "rule", "kind string, name array<string>, fallback boolean")) == [("a", ["x", "y"], None), ("b", None, True)]
    assert policies.read_toml(spark, str(tmp_path / "none.toml"), "rule", "kind string").count() == 0
    made = policies.rules_of([{"kind": "a", "name": ["x"]}, {"kind": "b", "fallback": True}], "kind", ["a", "b"])
    assert made[0].when == {"name": ["x"]} and made[1].fallback
    with pytest.raises(ValueError):
        policies.rules_of([{"kind": "q"}], "kind", ["a"])
