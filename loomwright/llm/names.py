"""Mapping free-entered values to a canonical list.

Only distinct values are worked on. Each is read into tokens; every distinct token is joined to the
vocabulary of the list by edit distance, over segments that an equal part must share, or as an
abbreviation; the repaired tokens then rank the complete entries by soft TF-IDF. An entry is meant
only if it explains every token and none of its own distinguishing tokens is missing.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwright.operators.skew import bounded, fits, lookup
from loomwright.session import cut

#: A token that is in more than this share of a kind's entries, and in more than so many, tells classes of entries apart, not entries.
CLASS_SHARE, CLASS_ENTRIES = 0.02, 3
#: Edits by which a token may differ, by its least length.
EDITS = {4: 1, 6: 2}
#: The place of a value run together, which is none of its tokens'.
WHOLE = -1
#: Least soft TF-IDF of the entry that is meant.
LEAST = 0.55

# Look-alikes of Latin letters, and what they look like.
ALIKE = str.maketrans("АВЕЅІЈКМНОРСТУХаеорсухіјѕӏкмтвнԛԝһΑΒΕΖΗΙΚΜΝΟΡΤΥΧορνα", "ABESIJKMHOPCTYXaeopcyxijslkmtbhqwhABEZHIKMNOPTYXopva")
# Signs typed for letters within a word.
SIGNS = str.maketrans("0134578@$!", "oieastbasi")
# Latin to Cyrillic, longest first.
CYRILLIC = (
    ("shch", "щ"), ("zh", "ж"), ("sh", "ш"), ("ch", "ч"), ("th", "т"), ("qu", "кв"), ("ae", "аэ"), ("ei", "ей"), ("x", "кс"), ("j", "дж"), ("w", "в"),
    ("a", "а"), ("b", "б"), ("c", "к"), ("d", "д"), ("e", "е"), ("f", "ф"), ("g", "г"), ("h", "х"), ("i", "и"), ("k", "к"), ("l", "л"), ("m", "м"), ("n", "н"),
    ("o", "о"), ("p", "п"), ("q", "к"), ("r", "р"), ("s", "с"), ("t", "т"), ("u", "у"), ("v", "в"), ("y", "ы"), ("z", "з"),
)
# Other words for words of the list.
ALIASES = {
    "bp": "blueprint", "dig": "excavation", "spying": "spy", "espionage": "spy", "вознесенный": "ascendant", "чертеж": "blueprint", "кожух": "casing", "излучатель": "emitter",
    "обвязка": "harness", "ствол": "barrel", "канал": "conduit", "приемник": "receiver",
}
# Words that name nothing.
NOISE = frozenset("the a an new old x lv lvl unranked ranked tradable untradable sealed rank".split())

_BRACKETS = re.compile(r"\((?:\s*(?:old|new|un\w*|\w*tradable|sealed|lv\.?\s*\d+|\d+)\s*)\)|\[[^\]]*\]", re.I)
_COUNT = re.compile(r"^(?:x\d+|\d+x|\d[\d,.]*)$", re.I)
_CAMEL = re.compile(r"(?<=[a-z]{2})(?=[A-Z][a-z])|(?<=[а-я]{2})(?=[А-Я][а-я])")
_SPLIT = re.compile(r"[\W_]+")


def cyrillic(token: str) -> str:
    """How a Latin name is written in Cyrillic letters."""
    for a, b in CYRILLIC:
        token = token.replace(a, b)
    return token


def read(value: str, aliases: dict[str, str] = ALIASES) -> list[str]:
    """The tokens of a value, in small letters, without counts and words that name nothing, ``aliases`` for other words."""
    value = unicodedata.normalize("NFKC", value)
    value = "".join(c for c in value if unicodedata.category(c) != "Cf")
    value = _BRACKETS.sub(" ", value)
    out = []
    for word in re.split(r"[\s_/,;:\"<>«»“”„()\[\]|*•~+?=#&'’-]+", value):
        if not word or _COUNT.match(word):
            continue
        letters = [c for c in word if c.isalpha()]
        if not letters:
            continue
        if any("a" <= c.lower() <= "z" for c in letters):
            word = word.translate(ALIKE)
        word = "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c) or c == "̆")
        word = unicodedata.normalize("NFC", word)
        inner = word.rstrip("!.")
        if any(c.isascii() and c.isalpha() for c in inner):
            inner = inner.translate(SIGNS)
        for part in _CAMEL.sub(" ", inner).split():
            for token in _SPLIT.split(part):
                token = token.lower()
                if token and token not in NOISE:
                    out.append(aliases.get(token, token))
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def _tokens(values: pd.Series) -> pd.Series:
    return values.map(read)


@F.pandas_udf(T.StringType())
def _cyrillic(tokens: pd.Series) -> pd.Series:
    return tokens.map(cyrillic)


def vocabulary(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``entries(kind, ref_id, name)``: ``(kind, ref_id, token, common, idf)`` and ``(kind, form, token, common, recurs)``.

    A form is a spelling that stands for a token: its own, its Cyrillic one, and for the first two
    tokens of an entry both run together, which stand for the pair as ``one+two``.
    """
    words = entries.select("kind", "ref_id", _tokens("name").alias("tokens"))
    single = words.select("kind", "ref_id", F.explode(F.array_distinct("tokens")).alias("token"))
    total = entries.groupBy("kind").agg(F.count("*").alias("total"))
    frequency = single.groupBy("kind", "token").agg(F.count("*").alias("df")).join(total, "kind")
    known = frequency.select("kind", "token", (F.col("df") > F.greatest(F.lit(CLASS_ENTRIES), CLASS_SHARE * F.col("total"))).alias("common"), (F.col("df") > 1).alias("recurs"), F.log(1 + F.col("total") / F.col("df")).alias("idf"))
    held = single.join(known.drop("recurs"), ["kind", "token"])
    pairs = words.filter(F.size("tokens") >= 2).select("kind", F.concat(F.col("tokens")[0], F.col("tokens")[1]).alias("form"), F.concat_ws("+", F.col("tokens")[0], F.col("tokens")[1]).alias("token")).distinct()
    forms = (
        known.select("kind", F.col("token").alias("form"), "token", "common", "recurs")
        .unionByName(known.select("kind", _cyrillic("token").alias("form"), "token", "common", "recurs"))
        .unionByName(pairs.withColumns({"common": F.lit(False), "recurs": F.lit(False)}))
    )
    return held, forms


def _edits(length: Column) -> Column:
    """Edits allowed for a length."""
    limit = F.lit(0)
    for least, edits in sorted(EDITS.items()):
        limit = F.when(length >= least, edits).otherwise(limit)
    return limit


_PARTS = max(EDITS.values()) + 1


def _segments(form: Column) -> Column:
    """A form cut into one more part than edits are allowed: (part, its number, its place), of which one stays whole."""
    size = F.floor(F.length(form) / _PARTS)
    part = lambda i: F.struct(
        F.lit(i).alias("i"), (size * i).cast("int").alias("at"),
        F.substr(form, (size * i + 1).cast("int"), F.when(F.lit(i == _PARTS - 1), F.length(form) - size * i).otherwise(size).cast("int")).alias("part"),
    )
    return F.array(*[part(i) for i in range(_PARTS)])


def repair(tokens: DataFrame, forms: DataFrame, hint) -> DataFrame:
    """``(kind, token, word, common, alike)``: the words of the list that each distinct token may stand for.

    ``alike`` is 1 for the word itself, else 1 less the share of edits, or 0.8 for an abbreviation: the
    beginning of a word that recurs, or of a class word some letters in order from the first. The edit join meets on a part of the form that
    occurs in the token at most as many places off as edits are allowed, so it finds every pair in reach.
    ``hint`` marks what is derived from the list for broadcast, or not.
    """
    exact = tokens.join(forms, (tokens.kind == forms.kind) & (tokens.token == forms.form)).select(tokens.kind, tokens.token, forms.token.alias("word"), "common", F.lit(1.0).alias("alike"))
    rest = tokens.join(exact.select("kind", "token").distinct(), ["kind", "token"], "left_anti")
    most = max(EDITS.values())
    cut_forms = forms.filter(F.length("form") >= min(EDITS)).select("kind", "form", F.col("token").alias("word"), "common", F.inline(_segments(F.col("form")))).filter(F.length("part") > 0)
    # a token longer than any form with a part of that width, and all edits, meets none
    lengths = cut_forms.groupBy("kind", F.length("part").alias("width")).agg((F.max(F.length("form")) + most).alias("longest"))
    # the places of the token that may hold a part of each width that occurs
    pieces = (
        rest.filter(F.length("token") >= min(EDITS) - 1)
        .join(hint(lengths), "kind")
        .filter((F.col("width") <= F.length("token")) & (F.length("token") <= F.col("longest")))
        .select("kind", "token", "width", F.explode(F.sequence(F.lit(0), F.length("token") - F.col("width"))).alias("place"))
        .select("kind", "token", "place", F.expr("substr(token, place + 1, width)").alias("part"))
    )
    near = (
        pieces.join(hint(cut_forms), ["kind", "part"])
        .filter((F.abs(F.col("place") - F.col("at")) <= most) & (F.abs(F.length("token") - F.length("form")) <= most))
        .select("kind", "token", "form", "word", "common")
        .distinct()
        .withColumn("edits", F.levenshtein("token", "form", most))
        .filter((F.col("edits") >= 0) & (F.col("edits") <= _edits(F.least(F.length("token"), F.length("form")))))
        .select("kind", "token", "word", "common", (1 - F.col("edits") / F.greatest(F.length("token"), F.length("form"))).alias("alike"))
    )
    classes = forms.filter("recurs").select("kind", F.col("form").alias("class"), F.col("token").alias("word"), "common", F.substring("form", 1, 1).alias("initial"))
    in_order = F.col("common") & F.expr("class rlike concat('^', array_join(split(token, ''), '.*'))")
    begun = (F.length("token") >= 3) & F.col("class").startswith(F.col("token"))
    short = (
        rest.filter(F.length("token").between(2, 9)).withColumn("initial", F.substring("token", 1, 1))
        .join(hint(classes), ["kind", "initial"])
        .filter((F.length("token") < F.length("class")) & (in_order | begun))
        .select("kind", "token", "word", "common", F.lit(0.8).alias("alike"))
    )
    return exact.unionByName(near).unionByName(short).groupBy("kind", "token", "word", "common").agg(F.max("alike").alias("alike"))


def canonical(values: DataFrame, entries: DataFrame, strict: dict[str, bool]) -> DataFrame:
    """``(kind, value, ref_id, score)`` of every distinct value: the entry it means, or ``ref_id`` 0.

    ``values(kind, value)`` are distinct and not null; ``entries(kind, ref_id, name)`` is the list.
    Every token of a value must stand for a token of the entry, and every distinguishing token of the
    entry must be stood for; where ``strict[kind]`` the class tokens too, so that another part or
    edition of a thing is not it. Among entries left the highest soft TF-IDF is meant, of equal ones
    that with fewer class tokens unsaid, then the lowest ref_id. A blank value means nothing.
    """
    # what is derived from the list is as large as the list, so one count tells whether all of it may be broadcast
    hint = F.broadcast if fits(entries) else (lambda frame: frame)
    held, forms = (cut(x) for x in vocabulary(entries))
    read_values = cut(values.select("kind", "value", F.xxhash64("kind", "value").alias("sid"), _tokens("value").alias("tokens")))
    tokens = read_values.select("sid", "kind", F.posexplode("tokens").alias("pos", "token"))
    # the whole value run together, for words that were split; it stands at no place
    whole = read_values.filter(F.size("tokens") >= 2).select("sid", "kind", F.lit(WHOLE).alias("pos"), F.array_join("tokens", "").alias("token"))
    repaired = cut(repair(tokens.select("kind", "token").unionByName(whole.select("kind", "token")).distinct(), forms, hint))
    said = (
        tokens.unionByName(whole).join(repaired, ["kind", "token"])
        .filter((F.col("pos") != WHOLE) | F.col("word").contains("+"))
        .select("sid", "kind", "pos", F.explode(F.split("word", "\\+")).alias("word"), "common", "alike")
    )
    # a value's words are as many as it has tokens times what each may stand for
    said = cut(said.groupBy("sid", "kind").agg(F.collect_set(F.struct("pos", "word", "alike", "common")).alias("said")))
    entry = held.select("kind", "ref_id", F.col("token").alias("word"), F.col("common").alias("class"), "idf")
    # of each distinguishing token of an entry the best that stands for it
    rare = said.select("sid", "kind", F.inline("said")).filter(~F.col("common")).groupBy("sid", "kind", "word").agg(F.max("alike").alias("alike"))
    found = (
        rare.join(hint(entry.filter(~F.col("class")).drop("class")), ["kind", "word"])
        .groupBy("sid", "kind", "ref_id").agg(F.count("*").alias("rare_found"), F.sum(F.col("alike") * F.col("idf") * F.col("idf")).alias("rare_score"))
    )
    needs = entry.groupBy("kind", "ref_id").agg(
        F.collect_list(F.when(~F.col("class"), F.col("word"))).alias("rare"), F.collect_list(F.when(F.col("class"), F.struct("word", "idf"))).alias("classes"),
        F.sum(F.col("idf") * F.col("idf")).alias("norm"),
    )
    # class tokens are looked at only for entries that have all their distinguishing ones, so no class is multiplied out
    full = found.join(hint(needs), ["kind", "ref_id"]).filter(F.col("rare_found") == F.size("rare")).join(said.drop("kind"), "sid").join(read_values.select("sid", F.size("tokens").alias("size")), "sid")
    best_of = lambda word: F.array_max(F.transform(F.filter("said", lambda x: x["word"] == word), lambda x: x["alike"]))
    own = F.concat("rare", F.transform("classes", lambda c: c["word"]))
    explained = F.size(F.array_distinct(F.transform(F.filter("said", lambda x: (x["pos"] != WHOLE) & F.array_contains(own, x["word"])), lambda x: x["pos"])))
    class_score = F.aggregate("classes", F.lit(0.0), lambda total, c: total + F.coalesce(best_of(c["word"]), F.lit(0.0)) * c["idf"] * c["idf"])
    missing = F.size(F.filter("classes", lambda c: best_of(c["word"]).isNull()))
    exact_kinds = [k for k, v in strict.items() if v]
    ranked = (
        full.withColumn("missing", missing)
        .filter((explained == F.col("size")) | F.exists("said", lambda x: x["pos"] == WHOLE))
        .filter(~F.col("kind").isin(exact_kinds) | (F.col("missing") == 0))
        .withColumn("score", (F.col("rare_score") + class_score) / F.col("norm"))
    )
    best = ranked.groupBy("sid").agg(F.max_by(F.struct("ref_id", "score"), F.struct("score", (-F.col("missing")).alias("unsaid"), (-F.col("ref_id")).alias("low"))).alias("best"))
    return read_values.join(best, "sid", "left").select(
        "kind", "value", F.when(F.col("best.score") >= LEAST, F.col("best.ref_id")).otherwise(F.lit(0)).cast("bigint").alias("ref_id"), F.col("best.score").alias("score")
    )


def resolve(rows: DataFrame, entries: DataFrame, strict: dict[str, bool]) -> DataFrame:
    """``rows(kind, value, ...)`` that are not byte for byte a name of their kind, with ``ref_id``.

    Null values are left out; repeated rows keep their own; columns of ``rows`` named ref_id or slot
    are replaced. A value with many rows is worked on once
    and its answer is brought back to them, by broadcast if it is hot.
    """
    rows, entries = rows.drop("ref_id", "slot"), entries.select("kind", "ref_id", "name").filter(F.col("name").isNotNull())
    names = entries.select("kind", F.col("name").alias("value"))
    open_rows = rows.filter(F.col("value").isNotNull()).join(bounded(names), ["kind", "value"], "left_anti").withColumn("slot", F.xxhash64("kind", "value"))
    counts = cut(open_rows.groupBy("slot", "kind", "value").agg(F.count("*").alias("n")))
    answers = cut(canonical(counts.select("kind", "value"), entries, strict).select(F.xxhash64("kind", "value").alias("slot"), "ref_id"))
    return lookup(open_rows, answers, "slot", counts.select("slot", "n"), "inner").drop("slot")
