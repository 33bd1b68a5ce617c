"""Text functions, Column to Column; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal(c: Column) -> Column:
    """Small letters, runs of blanks as one."""
    return F.lower(F.regexp_replace(F.trim(c), r"\s+", " "))


def search_fold(c: Column) -> Column:
    """As the index folds: small letters, ё as е."""
    return F.translate(F.lower(c), "ё", "е")


def fuzzy_fold(c: Column) -> Column:
    """Letters and digits in small letters, anything between as one blank."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


_NUMBER = r"[0-9][0-9,]*"


def quantity(c: Column) -> Column:
    """The number of ``Name x 100``, ``100X Name`` or ``10 x Name``, null without one."""
    found = lambda pattern: F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    raw = F.coalesce(found(rf"(?i)^.+\sx\s?({_NUMBER})$"), found(rf"(?i)^({_NUMBER})\s?x\s+.+$"))
    return F.regexp_replace(raw, ",", "").try_cast("bigint")


def without_quantity(c: Column) -> Column:
    """The name without its quantity."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, rf"(?i)\sx\s?{_NUMBER}$", ""), rf"(?i)^{_NUMBER}\s?x\s+", ""))


def without_stack(c: Column) -> Column:
    """The name without the first stack size in its middle: ``Name X20 Blueprint``, ``Name X 10 Blueprint``."""
    return F.regexp_replace(c, r"^(.*?\S)\s[xX]\s?[0-9]+(\s+\S.*)$", "$1$2")


# The grades a relic is printed with.
GRADES = ("Intact", "Exceptional", "Flawless", "Radiant")


def grade(c: Column, grades: tuple[str, ...] = GRADES) -> tuple[Column, Column]:
    """``Name (Grade)`` as name and small-lettered grade; another parenthetical belongs to the name and the grade is null."""
    pattern = r"(?s)^(.*) \((" + "|".join(grades) + r")\)$"
    graded = c.rlike(pattern)
    return F.when(graded, F.regexp_extract(c, pattern, 1)).otherwise(c), F.when(graded, F.lower(F.regexp_extract(c, pattern, 2)))


def base_and_grade(path: Column, grades: tuple[str, ...], folder: str = "") -> tuple[Column, Column]:
    """A path without the grade it ends in, and the grade; one without any has the first. Paths outside ``folder`` have neither."""
    base, of = path, F.lit(grades[0])
    for g in grades:
        base = F.when(path.endswith(g), F.regexp_replace(path, g + "$", "")).otherwise(base)
        of = F.when(path.endswith(g), g).otherwise(of)
    inside = path.contains(folder)
    return F.when(inside, base), F.when(inside, of)


_HEADING = r"^(Event:)?\s*([^/]*?)\s*/(.*)\(([^()]*)\)\s*(Extra)?$"


def heading(c: Column) -> dict[str, Column]:
    """``Event: Place/Node (Label) Extra`` by part, with flags of an event and of an extra table; all null for a text of another shape."""
    part = lambda i: F.trim(F.regexp_extract(c, _HEADING, i))
    shaped = lambda value: F.when(c.rlike(_HEADING), value)
    return {"place": shaped(part(2)), "node": shaped(part(3)), "label": shaped(part(4)), "event": shaped(part(1) != ""), "extra": shaped(part(5) != "")}


def level_range(c: Column) -> tuple[Column, Column]:
    """``Level 5 - 15 ...`` as low and high; null where it can't be read."""
    low, high = (F.nullif(F.regexp_extract(c, r"(?i)levels?\s+([0-9]+)\s*-\s*([0-9]+)", i), F.lit("")).try_cast("bigint") for i in (1, 2))
    return low, high


def split_levels(c: Column) -> tuple[Column, Column, Column]:
    """``Name (Level 0 - 50)`` as name, low and high; a text of another shape is all name."""
    pattern = r"^(.*)\(Level\s*([0-9]+)\s*-\s*([0-9]+)\s*\)\s*$"
    shaped = c.rlike(pattern)
    number = lambda i: F.when(shaped, F.regexp_extract(c, pattern, i).try_cast("bigint"))
    return F.when(shaped, F.rtrim(F.regexp_extract(c, pattern, 1))).otherwise(c), number(2), number(3)


def slug(c: Column) -> Column:
    """Small letters and digits joined by underscores."""
    return F.btrim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "_"), F.lit("_"))


def dashed(c: Column) -> Column:
    """CamelCase as small words joined by dashes."""
    return F.lower(F.regexp_replace(c, r"(?<=[a-z0-9])(?=[A-Z])", "-"))


def titled(c: Column) -> Column:
    """Every word with a capital, its tail as it is."""
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), " ")


def unshout(c: Column) -> Column:
    """A text all in capitals with a capital a word; others as they are."""
    return F.when((c == F.upper(c)) & (c != F.lower(c)), F.initcap(F.lower(c))).otherwise(c)


def percent(c: Column) -> Column:
    """The first percentage in a text as a fraction."""
    return F.nullif(F.regexp_extract(c, r"([0-9]+(?:\.[0-9]+)?)\s*%", 1), F.lit("")).try_cast("double") / 100


def label_of_rate(c: Column) -> Column:
    """``Label (12.5%)`` without its rate."""
    return F.trim(F.regexp_replace(c, r"\s*\([^()]*%\)\s*$", ""))


def civil_day(ms: Column) -> Column:
    """The day of epoch milliseconds as ``yyyy.MM.dd``, in UTC."""
    return F.date_format(F.timestamp_seconds(F.floor(ms / 1000)).cast("timestamp_ntz"), "yyyy.MM.dd")


def filetime_ms(ticks: Column) -> Column:
    """Epoch milliseconds of a count of 100 ns since 1601."""
    return F.floor((ticks - F.lit(116444736000000000)) / 10000).cast("bigint")


def grouped(n: Column) -> Column:
    """A whole number with its digits in groups of three, parted by narrow blanks that don't break."""
    return F.replace(F.format_number(n, 0), F.lit(","), F.lit("\u202f"))


def common_prefix(a: Column, b: Column) -> Column:
    """The letters two texts begin with alike."""
    same = F.transform(F.sequence(F.lit(1), F.greatest(F.least(F.length(a), F.length(b)), F.lit(1))), lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i))
    return F.substring(a, F.lit(1), F.size(F.filter(same, lambda x: x)))


def words_missing(a: Column, b: Column) -> Column:
    """Words of ``a`` that ``b`` lacks, in order."""
    return F.array_join(F.array_except(F.split(a, r"\s+"), F.split(b, r"\s+")), " ")


def url_encoded(c: Column) -> Column:
    """Percent-encoded, blanks as %20, slashes kept."""
    return F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


#: Letters and words of a name at most, letters of a word that may begin small, and what no name holds or ends in.
NAME_LENGTH, NAME_WORDS, JOINER = 48, 4, 3
NOT_IN_NAMES, NOT_LAST = r"[|<>\\/\n]", r"[.!?:,]$"


def is_name(c: Column) -> Column:
    """Whether a phrase reads as a name: few words, each beginning with no small letter unless it is a short joiner, the first in any case."""
    words = F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")
    begun = lambda w: ~w.rlike(r"^(?!\p{Lu})\p{L}")
    fits = (F.length(c) <= NAME_LENGTH) & (F.size(words) <= NAME_WORDS) & ~c.rlike(NOT_IN_NAMES) & ~c.rlike(NOT_LAST)
    return (F.size(words) > 0) & fits & begun(F.get(words, F.lit(0))) & F.forall(words, lambda w: begun(w) | (F.length(w) <= JOINER))


# Rewards that are used up at once, and those printed as an amount.
SERVICES = (" Booster", " Resource Bundle")
AMOUNTS, AMOUNT_WORDS = ("Region Resource", "Ducats"), ("Endo", "Credits")
# Folders of alternate copies.
TIERS = ("/Beginner/", "/Intermediate/", "/Expert/")


def is_service(c: Column) -> Column:
    """Whether a printed reward is used up at once and so is no item."""
    return F.trim(c).rlike("(?:" + "|".join(SERVICES) + ")$")


def is_amount(c: Column) -> Column:
    """Whether a printed reward is an amount of something and so is no item: ``100 Endo``, ``1,500 Credits Cache``, ``Return: ...``."""
    text = F.trim(c)
    return text.isin(*AMOUNTS) | text.startswith("Return:") | text.rlike(r"^[+-]?[0-9][0-9,]* (?:(?:" + "|".join(AMOUNT_WORDS) + r")|.*Cache)$")


def is_tiered(path: Column) -> Column:
    """Whether a path is in a folder of alternate copies."""
    return path.rlike("|".join(TIERS))


def names_enemies(section: Column) -> Column:
    """Whether a section's tables are of enemies and not of places."""
    return section.rlike("(?:ByAvatar|ByDrop)$")


def place_kind(section: Column) -> Column:
    """What a section's tables are of: ``key``, ``sortie``, ``transient``, ``bounty`` or ``node``."""
    own = [F.when(section == f"{kind}Rewards", kind) for kind in ("key", "sortie", "transient")]
    return F.coalesce(*own, F.when(section.endswith("Rewards") & (section != "missionRewards"), "bounty"), F.lit("node"))


def clean_json(c: Column) -> Column:
    """Control bytes as blanks, so a text can be read as JSON."""
    return F.regexp_replace(c, r"[\x00-\x1F]", " ")
