"""Surrogates for personal data, by column functions only.

Detected entities get keyed replacements of the same type and format: digits for digits in the same
punctuation, mail addresses with the same shape and top domain, names of the same gender, script and case.  One
entity has one surrogate wherever it stands.  Numbers and addresses pass through a keyed permutation of their own format (Feistel
rounds that shift each half's characters within their class by a stream keyed with the other half), so different entities
stay different however full their space is.  Names are drawn and, where two meet, drawn again from a larger space.  A check over
the corpus finds surrogates that are entities that occur and takes another permutation for them, off all others.

Card numbers keep whether their check digit is right, account numbers the remainder of theirs, telephone numbers after a plus
their country code.  Names of scripts without syllables below stay as they are.  The key is part of the plan: where event
logs are kept, set ``spark.sql.redaction.string.regex`` to cover it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import columns_apart, row_keys, stored

#: Permutations tried for a surrogate that is an entity that occurs, before the first one is kept.
OTHER_PERMUTATIONS = 4
ROUNDS = 4

MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}(?![A-Za-z0-9-])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
ADDRESS = rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
PHONE = (
    r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,5}\)[ .-]?[0-9]{2,4}[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4})?(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z+-])(?:\+[0-9]{1,3}[ .-])?[0-9]{3,5}[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z]|-[0-9])"
    r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]\([0-9]{1,5}\))?(?:[ .-][0-9]{2,8}){2,4}(?![0-9A-Za-z]|-[0-9])"
    r"|(?<![0-9A-Za-z+])\+[0-9]{8,15}(?![0-9A-Za-z])"
)
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"

# Titles that tell the gender of the name after them.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "Госпожа", "Κυρία")

# Syllables and endings that surrogate names are built from, by script and gender.
SYLLABLES = {
    "latin": ("ba", "ce", "di", "fo", "ga", "he", "ki", "lo", "ma", "ne", "po", "ri", "sa", "te", "vi", "wo"),
    "cyrillic": ("ба", "ве", "ди", "фо", "га", "же", "ки", "ло", "ма", "не", "по", "ри", "са", "те", "зи", "шо"),
    "greek": ("βα", "γε", "δι", "φο", "ζα", "θε", "κι", "λο", "μα", "νε", "πο", "ρι", "σα", "τε", "ξι", "χο"),
}
ENDINGS = {
    "latin": {"m": "ron", "f": "lina", "s": "mer"}, "cyrillic": {"m": "рон", "f": "лина", "s": "мер"}, "greek": {"m": "ρων", "f": "λινα", "s": "μερ"},
}

WORD = r"\p{Lu}[\p{L}'’-]{1,30}"
NAME = rf"(?<![\p{{L}}])(?:{'|'.join(MALE + FEMALE)})\.? {WORD}(?: {WORD})?"
#: All kinds in order of precedence at one place.
ENTITY = "|".join((MAIL, rf"(?=[0-9+(])(?:{ADDRESS}|{SOCIAL}|{CARD}|{PHONE})", IBAN, NAME))

DIGITS = ("address", "social", "card", "phone")


def kind_of(raw: Column) -> Column:
    """Type of a match; names are told by their title."""
    whole = lambda p: raw.rlike(rf"^(?:{p})$")
    return (
        F.when(raw.contains("@"), "mail").when(whole(ADDRESS), "address").when(whole(SOCIAL), "social").when(whole(CARD), "card")
        .when(whole(PHONE), "phone").when(whole(IBAN), "iban").otherwise("name"))


def bytes_of(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """128 keyed bytes, as 256 hexadecimal digits."""
    return F.concat(*[F.sha2(F.concat_ws("\0", F.lit(f"{key}{i}"), kind, norm, attempt), 256) for i in range(4)])


def byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, (2 * F.pmod(i, F.lit(128)) + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def letters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def shifted(text: Column, stream: Column) -> Column:
    """``text`` with each ASCII digit and letter moved on within its class by the stream, all else kept: one to one."""
    def one(c: Column, i: Column) -> Column:
        b = byte(stream, i)
        on = lambda first, n: F.char(F.ascii(F.lit(first)) + F.pmod(F.ascii(c) - F.ascii(F.lit(first)) + b, F.lit(n)))
        return F.when(c.rlike("[0-9]"), on("0", 10)).when(c.rlike("[a-z]"), on("a", 26)).when(c.rlike("[A-Z]"), on("A", 26)).otherwise(c)

    return F.array_join(F.transform(letters(text), one), "")


def permuted(table: DataFrame, name: str, key: str, tweak: Column) -> DataFrame:
    """``table`` with the text ``name`` replaced by its image under a keyed permutation of its format.

    Each round is a column of its own, so that a stream is computed once a text and not once a character.
    """
    half = F.floor(F.length(name) / 2).cast("int")
    table = table.withColumns({"_left": F.substring(name, F.lit(1), half), "_right": F.substring(name, half + 1, F.length(name))})
    for turn in range(ROUNDS):
        mine, other = ("_right", "_left") if turn % 2 == 0 else ("_left", "_right")
        # the lengths of both halves keep formats apart
        table = table.withColumn("_stream", bytes_of(f"{key}{turn}", tweak, F.col(other), F.length(mine)))
        table = table.withColumn(mine, shifted(F.col(mine), F.col("_stream")))
    return table.withColumn(name, F.concat("_left", "_right")).drop("_left", "_right", "_stream")


def moved_octets(table: DataFrame, key: str, tweak: Column) -> DataFrame:
    """``table`` with ``_octets``: the numbers of an address, each half moved on by a stream keyed with the other."""
    octets = [F.get(F.split("norm", r"\."), F.lit(i)).try_cast("int") for i in range(4)]
    table = table.withColumns({f"_o{i}": F.when(F.col("kind") == "address", o) for i, o in enumerate(octets)})
    for turn in range(ROUNDS):
        mine, other = ((2, 3), (0, 1)) if turn % 2 == 0 else ((0, 1), (2, 3))
        table = table.withColumn("_stream", bytes_of(f"{key}{turn}", F.lit("address"), F.concat_ws(".", tweak, *[f"_o{i}" for i in other]), F.lit(0)))
        table = table.withColumns({f"_o{i}": F.pmod(F.col(f"_o{i}") + byte(F.col("_stream"), F.lit(k)), F.lit(256)) for k, i in enumerate(mine)})
    names = [f"_o{i}" for i in range(4)]
    return table.withColumn("_octets", F.concat_ws(".", *names)).drop("_stream", *names)


def luhn(digits: Column) -> Column:
    """Sum of a card number's digits but the last, as its check digit needs it, modulo 10."""
    n = F.length(digits)
    each = F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), lambda c, i: F.when(
        F.pmod(n - i, F.lit(2)) == 0, F.pmod(c.cast("int") * 2, F.lit(10)) + F.floor(c.cast("int") / 5).cast("int")).otherwise(c.cast("int")))
    return F.pmod(F.aggregate(F.slice(each, 1, n - 1), F.lit(0), lambda a, x: a + x), F.lit(10))


def mod97(text: Column) -> Column:
    """Remainder of an account number as its standard reads it, letters as 10 to 35; digits and capitals only."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(letters(text), F.lit(0), lambda a, c: F.pmod(a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c), F.lit(97)))


def name_of(kind: Column, stream: Column, attempt: Column) -> Column:
    """A name of the script and gender in ``kind``, e.g. ``latin:f``; later attempts are longer."""
    built = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        table = F.array(*[F.lit(s) for s in syllables])
        at = F.transform(F.sequence(F.lit(0), 2 + attempt), lambda i: F.pmod(byte(stream, i), F.lit(len(SYLLABLES["latin"]))))
        start = F.aggregate(at, F.lit(""), _appended(table))
        for gender, ending in ENDINGS[script].items():
            built = F.when(kind == f"{script}:{gender}", F.concat(start, F.lit(ending))).otherwise(built)
    return built


def _appended(table: Column) -> Callable[[Column, Column], Column]:
    return lambda told, i: F.concat(told, F.get(table, i))


def with_core(table: DataFrame, key: str, tweak: int) -> DataFrame:
    """``table`` (kind, norm) of all kinds but names with ``core``, the image of each entity under one permutation."""
    kind, norm = F.col("kind"), F.col("norm")
    is_mail, is_card, is_iban = kind == "mail", kind == "card", kind == "iban"
    at = F.instr(norm, "@")
    domain = F.when(is_mail, F.substring(norm, at + 1, F.length(norm)))
    # what stays in front: the country of an account or telephone number, the first digit of a card
    country = F.when(norm.rlike(r"^\+[17]"), 2).when(norm.startswith("+"), 3).otherwise(0)
    keep = F.when(is_card, 1).when(is_iban, 4).when(kind == "phone", country).otherwise(0)
    last = F.when(is_card, 1).otherwise(0)
    body = F.when(is_mail, F.substring(norm, F.lit(1), at - 1)).otherwise(
        F.substring(norm, keep + 1, F.length(norm) - keep - last))
    table = table.withColumns({"_body": body, "_labels": F.regexp_extract(domain, r"^(.*)\.", 1), "_top": F.regexp_extract(domain, r"(\.[^.]*)$", 1), "_keep": keep})
    table = permuted(table, "_body", key, F.concat_ws(":", kind, F.lit(tweak)))
    table = moved_octets(table, key, F.lit(tweak))
    # the domain has one image whatever stands before it
    table = permuted(table, "_labels", key, F.lit("domain"))
    front = F.substring(norm, F.lit(1), F.col("_keep"))
    open_card = F.concat(front, F.col("_body"), F.lit("0"))
    check = F.pmod(F.substring(norm, -1, 1).cast("int") + luhn(norm) - luhn(open_card), F.lit(10)).cast("string")
    # check digits that leave the remainder as it was
    moved = lambda text: F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, F.lit(1), F.lit(2)))
    wanted = mod97(F.concat(moved(norm), F.substring(norm, F.lit(3), F.lit(2))))
    bare = mod97(F.concat(moved(F.concat(front, F.col("_body"))), F.lit("00")))
    digits = F.lpad(F.pmod(wanted - bare, F.lit(97)).cast("string"), 2, "0")
    core = (
        F.when(is_mail, F.concat("_body", F.lit("@"), "_labels", "_top")).when(kind == "address", F.col("_octets"))
        .when(is_card, F.concat(front, "_body", check)).when(is_iban, F.concat(F.substring(norm, F.lit(1), F.lit(2)), digits, "_body"))
        .otherwise(F.concat(front, "_body")))
    return table.withColumn("core", core).drop("_body", "_labels", "_top", "_keep", "_octets")


def entities(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __hash, pos, part, kind, raw, norm) of every entity in document order; a name has a row for each word.

    Rows equal in every column are found once.  ``norm`` is what makes two mentions one entity: lower case, bare digits.
    """
    keys = row_keys(docs, id_col)
    found = docs.select(keys["__id"].alias("__id"), keys["__hash"].alias("__hash"), F.regexp_extract_all(F.col(text_col), F.lit(ENTITY), F.lit(0)).alias("found"))
    each = found.where(F.size("found") > 0).select("__id", "__hash", F.posexplode("found").alias("pos", "match"))
    each = each.withColumn("kind", kind_of(F.col("match")))
    words = F.when(F.col("kind") == "name", F.split("match", " ")).otherwise(F.array("match"))
    each = each.withColumn("words", words).withColumn("title", F.regexp_replace(F.get("words", F.lit(0)), r"\.$", ""))
    each = each.select("__id", "__hash", "pos", "kind", "title", F.size("words").alias("n"), F.posexplode("words").alias("part", "raw"))
    script = F.when(F.col("raw").rlike(r"\p{IsCyrillic}"), "cyrillic").when(F.col("raw").rlike(r"\p{IsGreek}"), "greek").when(F.col("raw").rlike(r"\p{IsLatin}"), "latin")
    gender = F.when(F.col("title").isin(*FEMALE), "f").otherwise("m")
    role = F.when((F.col("part") == 1) & (F.col("n") == 3), F.concat(script, F.lit(":"), gender)).otherwise(F.concat(script, F.lit(":s")))
    is_name = F.col("kind") == "name"
    kind = F.when(is_name & ((F.col("part") == 0) | script.isNull()), "title").when(is_name, role).otherwise(F.col("kind"))
    bare = F.regexp_replace("raw", "[^0-9A-Z]", "")
    bare = F.when((F.col("kind") == "phone") & F.col("raw").startswith("+"), F.concat(F.lit("+"), bare)).otherwise(bare)
    norm = F.when(F.col("kind").isin("social", "card", "phone", "iban"), bare).otherwise(F.lower("raw"))
    return each.select("__id", "__hash", "pos", "part", kind.alias("kind"), "raw", norm.alias("norm")).distinct()


def drawn_names(table: DataFrame, key: str) -> DataFrame:
    """(kind, norm, core) of names: drawn by the key, again from longer names where two meet or one occurs."""
    real = table.select("kind", F.col("norm").alias("core"))
    draw = lambda t: t.withColumn("_stream", bytes_of(key, F.col("kind"), F.col("norm"), F.col("attempt"))).withColumn(
        "core", name_of(F.col("kind"), F.col("_stream"), F.col("attempt"))).drop("_stream")
    table = stored(draw(table.withColumn("attempt", F.lit(0))), "names")
    while True:  # each attempt has 16 times as many names
        first = table.groupBy("kind", "core").agg(F.min(F.struct("attempt", "norm")).alias("first"), F.count("*").alias("n")).where("n > 1")
        lost = table.join(first, ["kind", "core"]).where(F.struct("attempt", "norm") > F.col("first")).select("kind", "norm")
        taken = table.join(real, ["kind", "core"], "left_semi").select("kind", "norm")
        again = stored(lost.union(taken).distinct(), "again")
        if again.isEmpty():
            return table.select("kind", "norm", "core")
        moved = draw(table.join(again, ["kind", "norm"], "left_semi").select("kind", "norm", (F.col("attempt") + 1).alias("attempt")))
        table = stored(table.join(again, ["kind", "norm"], "left_anti").unionByName(moved), "names")


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """(kind, norm, core) of every distinct entity: no two of a type share a core.

    None is an entity that occurs, but where ``OTHER_PERMUTATIONS`` all lead to one: then the first image stays, which no
    other entity has.
    """
    table = found.where("kind <> 'title'").select("kind", "norm").distinct()
    named = F.col("kind").contains(":")
    names = drawn_names(table.where(named), key)
    table = stored(table.where(~named), "numbers")
    base = stored(with_core(table, key, 0), "surrogates")
    # an address may be written in ways that differ in zeros only; they share an image
    real = table.select("kind", F.col("norm").alias("core"))
    left = stored(base.join(real, ["kind", "core"], "left_semi").select("kind", "norm"), "left")
    other: DataFrame | None = None
    for tweak in range(1, OTHER_PERMUTATIONS + 1):
        if left.isEmpty():
            break
        held = base.select("kind", "core").union(real)
        held = held if other is None else held.union(other.select("kind", "core"))
        # stored, as a join would push its conditions down through all rounds; two that meet wait for the next permutation, but one of them
        free = stored(with_core(left, key, tweak), "candidates").join(held, ["kind", "core"], "left_anti")
        settled = free.groupBy("kind", "core").agg(F.min("norm").alias("norm")).select("kind", "norm", "core")
        other = stored(settled if other is None else other.unionByName(settled), "other")
        left = stored(left.join(other, ["kind", "norm"], "left_anti"), "left")
    if other is not None:
        base = base.join(other, ["kind", "norm"], "left_anti").unionByName(other)
    return names.unionByName(base)


def shaped(raw: Column, kind: Column, core_: Column) -> Column:
    """``core_`` in the punctuation and case of the mention ``raw``."""
    given = letters(F.regexp_replace(core_, r"^\+", ""))
    filled = F.aggregate(
        letters(raw), F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, c: F.when(c.rlike("[0-9A-Z]"), F.struct(F.concat(a["out"], F.get(given, a["at"])).alias("out"), (a["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["at"].alias("at"))))["out"]
    cased = F.array_join(F.zip_with(letters(raw), given, lambda r, c: F.when(r.rlike("[A-Z]"), F.upper(c)).otherwise(c)), "")
    name = F.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(core_)).otherwise(F.initcap(core_))
    return (
        F.when(kind == "title", raw).when(kind == "mail", cased).when(kind == "address", core_).when(kind.contains(":"), name).otherwise(filled))


@columns_apart
def with_surrogates(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every entity in the text replaced, and ``n_entities``.

    A NULL text stays NULL, an empty one empty.  Mentions of one entity agree in all documents and reruns under one
    ``key``; without the key a surrogate does not tell its entity.  Rows that repeat are all kept.
    """
    found = stored(entities(docs, id_col, text_col), "entities")
    told = found.join(surrogates(found, key), ["kind", "norm"], "left").select(
        "__id", "__hash", "pos", "part", shaped(F.col("raw"), F.col("kind"), F.col("core")).alias("said"))
    parts = told.groupBy("__id", "__hash").agg(F.array_sort(F.collect_list(F.struct("pos", "part", "said"))).alias("__parts"))
    joined = docs.withColumns(row_keys(docs, id_col)).join(parts, ["__id", "__hash"], "left")
    joined = joined.withColumn("__gaps", F.when(F.col("__parts").isNotNull(), F.split(F.col(text_col), ENTITY, -1)))
    gap = lambda e: F.when(e["part"] == 0, F.get("__gaps", e["pos"])).otherwise(F.lit(" "))
    text = F.concat(F.array_join(F.transform("__parts", lambda e: F.concat(gap(e), e["said"])), ""), F.element_at("__gaps", -1))
    count = F.coalesce(F.size(F.filter("__parts", lambda e: e["part"] == 0)), F.lit(0))
    names = [c for c in docs.columns if c != "n_entities"]
    return joined.withColumn("n_entities", count).withColumn(text_col, F.when(F.col("__parts").isNull(), F.col(text_col)).otherwise(text)).select(
        *names, "n_entities")
