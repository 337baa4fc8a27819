"""Surrogates for personal data, on DataFrame functions alone.

Entities are found by pattern, and each distinct one gets a surrogate from a
keyed digest of (kind, normal form). A surrogate is of the same kind and form:
digits stay digits between the same separators, a card number that satisfies
its check digit gets one that does, an address part stays in its range, a mail
address keeps its top-level domain, names keep their script, gender and case.

One entity has one surrogate in the whole corpus, however it is written, and a
person's name also where it stands without its title in the same text. A table
of all distinct entities is checked: a surrogate that another entity has, or
that is itself an entity of the corpus, is drawn again with the next attempt
until all are distinct.

Defined results: NULL texts stay NULL, empty ones empty, and texts without
entities are returned as they are; repeated rows are changed alike; an empty
table gives no rows. All other columns pass through; names used on the way
start with ``_pii_``, and ``pii_count`` is added (a column of that name is
replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import cut_lineage

# Titles by gender, and the patterns of the kinds.
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Herrn", "Señor", "Sr", "Don", "Monsieur", "Господин", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Doña", "Madame", "Mme", "Mlle", "Госпожа", "Κυρία"],
}
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63})+"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)"
CARD = r"(?<![\p{L}\d-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7})(?![\p{L}\d])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = (
    r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)"
)
_ALL_TITLES = "|".join(t for titles in TITLES.values() for t in titles)
NAME = rf"(?<=(?<!\p{{L}})(?:{_ALL_TITLES})\.?[ ])\p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+){{0,2}}"
ENTITY = "|".join(f"(?:{p})" for p in (EMAIL, IP, PHONE, CARD, SSN, NAME))


def holds_entity(text: Column) -> Column:
    """Whether ``ENTITY`` occurs; kinds whose telling characters are missing
    are not searched for."""
    numbers = "|".join(f"(?:{p})" for p in (IP, PHONE, CARD, SSN))
    titled = F.lit(False)
    for title in sorted(t for titles in TITLES.values() for t in titles):
        titled |= text.contains(title)
    return (
        (text.contains("@") & text.rlike(EMAIL)) | (text.rlike("[0-9]") & text.rlike(numbers)) | (titled & text.rlike(NAME))
    )


def _title_before(gender: str) -> str:
    return rf"(?:^|[^\p{{L}}])(?:{'|'.join(TITLES[gender])})\.? $"


def kind_of(mention: Column) -> Column:
    """The kind of a mention found by ``ENTITY``; they exclude one another."""
    return (
        F.when(mention.contains("@"), F.lit("email"))
        .when(mention.rlike(r"^\p{L}"), F.lit("name"))
        .when(mention.rlike(rf"^{IP}$"), F.lit("ip"))
        .when(mention.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.lit("ssn"))
        .when(mention.rlike(r"^[+(]|^\d{3}[.-]\d{3}[.-]"), F.lit("phone"))
        .otherwise(F.lit("card"))
    )


def normal_form(kind: Column, mention: Column) -> Column:
    """What all ways of writing one entity have in common."""
    return (
        F.when(kind.isin("card", "phone", "ssn"), F.regexp_replace(mention, r"\D", ""))
        .otherwise(F.lower(mention))
    )


def _digest(key: str, *parts: Column) -> Column:
    """128 hex digits that only the holder of the key can compute."""
    base = F.concat_ws("|", F.lit(key), *parts)
    return F.concat(F.sha2(base.cast("binary"), 256), F.sha2(F.concat(base, F.lit("|2")).cast("binary"), 256))


def _draw(digest: Column, place: Column, n: int) -> Column:
    """A number below ``n`` for a place, from 4 of the digest's hex digits."""
    drawn = F.conv(F.substr(digest, ((place % 32) * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")
    return F.pmod(drawn + F.floor(place / 32).cast("int") * 7919, F.lit(n)).cast("int")


def _letter(digest: Column, place: Column, first: str, n: int) -> Column:
    alphabet = F.lit("".join(chr(ord(first) + k) for k in range(n)))
    return F.substr(alphabet, _draw(digest, place, n) + 1, F.lit(1))


# Script, first letter and number of letters that are drawn from.
LETTERS = [
    ("IsCyrillic", "а", 32), ("IsGreek", "α", 17), ("IsHan", "一", 2000), ("IsHangul", "가", 2000), ("IsHiragana", "か", 62),
    ("IsKatakana", "カ", 62), ("IsArabic", "ب", 20), ("IsHebrew", "א", 27), ("IsThai", "ก", 46), ("IsDevanagari", "क", 37),
    ("IsArmenian", "ա", 38), ("IsGeorgian", "ა", 33),
]


def _like(text: Column, digest: Column) -> Column:
    """Digits, letters and their scripts as in ``text``, drawn from the digest."""
    def drawn(c: Column, k: Column) -> Column:
        out = F.when(c.rlike(r"^[0-9]$"), _draw(digest, k, 10).cast("string")).when(c.rlike("^[A-Za-z]$"), _letter(digest, k, "a", 26))
        for script, first, n in LETTERS:
            out = out.when(c.rlike(rf"^\p{{{script}}}$"), _letter(digest, k, first, n))
        return out.when(c.rlike(r"^\p{L}$"), _letter(digest, k, "a", 26)).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), drawn), "")


def _luhn(digits: Column) -> Column:
    """Sum of the check-digit rule, over digits whose last is the check digit."""
    chars = F.split(F.reverse(digits), "")
    return F.aggregate(F.transform(chars, lambda c, k: (
        F.when(k % 2 == 0, c.cast("int")).otherwise(
            F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
    )), F.lit(0), lambda a, b: a + b)


def _lead(norm: Column, attempt: Column, digest: Column) -> Column:
    """The first digit stays; after ten attempts it may be any."""
    return F.when(attempt >= 10, F.left(_like(norm, digest), F.lit(1))).otherwise(F.left(norm, F.lit(1)))


def _card(norm: Column, attempt: Column, digest: Column) -> Column:
    """A valid number gets a valid one."""
    body = F.concat(_lead(norm, attempt, digest), F.substr(_like(norm, digest), F.lit(2), F.length(norm) - 2))
    check = F.pmod(10 - _luhn(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")
    last = F.substr(_like(norm, digest), F.length(norm), F.lit(1))
    return F.concat(body, F.when(_luhn(norm) % 10 == 0, check).otherwise(last))


def _ip(norm: Column, attempt: Column, digest: Column) -> Column:
    """Each part keeps its number of digits and its range; after ten attempts
    it may be any part."""
    return F.array_join(F.transform(F.split(norm, r"\."), lambda part, k: (
        F.when(attempt >= 10, _draw(digest, k, 256))
        .when(F.length(part) == 1, _draw(digest, k, 10))
        .when(F.length(part) == 2, _draw(digest, k, 90) + 10)
        .otherwise(_draw(digest, k, 155) + 100)
    ).cast("string")), ".")


def _email(norm: Column, attempt: Column, digest: Column, key: str) -> Column:
    """The domain is drawn from the domain alone; its last label stays. The
    local part gets one more letter every ten attempts."""
    local, domain = F.split_part(norm, F.lit("@"), F.lit(1)), F.split_part(norm, F.lit("@"), F.lit(2))
    local = F.concat(local, F.repeat(F.lit("x"), F.floor(attempt / 10).cast("int")))
    top = F.regexp_extract(domain, r"\.[^.]+$", 0)
    host = F.substr(domain, F.lit(1), F.length(domain) - F.length(top))
    return F.concat(_like(local, digest), F.lit("@"), _like(host, _digest(key, F.lit("domain"), host)), top)


# Fixed values: (script, consonants, vowels, endings by gender).
SCRIPTS = [
    (r"^\p{IsCyrillic}", "бвгдклмнпрст", "аеиоу", {"m": ["ов", "ин", "ор"], "f": ["ова", "ина", "ия"]}),
    (r"^\p{IsGreek}", "βγδκλμνπρστφ", "αεηιο", {"m": ["ος", "ης", "ας"], "f": ["α", "η", "ια"]}),
    (r"", "bdfgklmnprst", "aeiou", {"m": ["o", "us", "ert"], "f": ["a", "ina", "elle"]}),
]


def _name(norm: Column, gender: Column, attempt: Column, digest: Column) -> Column:
    """Syllables of the name's script and an ending of its gender; three
    syllables are 216,000 stems, and later attempts have more."""
    def made(consonants: str, vowels: str, endings: dict[str, list[str]]) -> Column:
        syllables = F.transform(F.sequence(F.lit(0), 2 + F.floor(attempt / 5).cast("int")), lambda k: F.concat(
            F.substr(F.lit(consonants), _draw(digest, 2 * k, len(consonants)) + 1, F.lit(1)),
            F.substr(F.lit(vowels), _draw(digest, 2 * k + 1, len(vowels)) + 1, F.lit(1)),
        ))
        ending = F.when(gender == "f", F.get(F.lit(endings["f"]), _draw(digest, F.lit(30), 3))).otherwise(
            F.get(F.lit(endings["m"]), _draw(digest, F.lit(30), 3)))
        return F.concat(F.array_join(syllables, ""), ending)

    out = made(*SCRIPTS[-1][1:])
    for pattern, *script in reversed(SCRIPTS[:-1]):
        out = F.when(norm.rlike(pattern), made(*script)).otherwise(out)
    return out


def surrogate(kind: Column, norm: Column, gender: Column, attempt: Column, key: str) -> Column:
    """The surrogate's normal form."""
    digest = _digest(key, kind, norm, attempt.cast("string"))
    phone = F.concat(_lead(norm, attempt, digest), F.substr(_like(norm, digest), F.lit(2), F.length(norm)))
    return (
        F.when(kind == "email", _email(norm, attempt, digest, key)).when(kind == "ip", _ip(norm, attempt, digest))
        .when(kind == "card", _card(norm, attempt, digest)).when(kind == "name", _name(norm, gender, attempt, digest))
        .when(kind == "phone", phone).otherwise(_like(norm, digest))
    )


def in_form(kind: Column, mention: Column, norm: Column) -> Column:
    """A surrogate's normal form written the way the mention is."""
    digits = F.aggregate(
        F.split(mention, ""), F.struct(F.lit("").alias("text"), F.lit(1).alias("at")),
        lambda acc, c: F.struct(
            F.concat(acc["text"], F.when(c.rlike(r"^\d$"), F.substr(norm, acc["at"], F.lit(1))).otherwise(c)).alias("text"),
            (acc["at"] + F.when(c.rlike(r"^\d$"), 1).otherwise(0)).alias("at"),
        ),
        lambda acc: acc["text"],
    )
    cased = (
        F.when((F.upper(mention) == mention) & (F.length(mention) > 1) & mention.rlike(r"\p{L}"), F.upper(norm))
        .when(kind == "name", F.concat(F.upper(F.left(norm, F.lit(1))), F.substr(norm, F.lit(2), F.length(norm))))
        .otherwise(norm)
    )
    return F.when(kind.isin("card", "phone", "ssn"), digits).otherwise(cased)


def _units(mention: Column) -> Column:
    """The entities of a mention: each word of a name, else the whole."""
    return F.when(kind_of(mention) == "name", F.split(mention, " ")).otherwise(F.array(mention))


def _mentions(text: Column) -> Column:
    """(kind, norm, gender, word) of all entities of a text; ``word`` only for names."""
    found, between = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), F.split(text, ENTITY, -1)

    def entities(mention: Column, k: Column) -> Column:
        before = F.get(between, k)
        kind = kind_of(mention)
        gender = F.when(kind == "name", F.when(before.rlike(_title_before("f")), F.lit("f")).otherwise(F.lit("m")))
        return F.transform(_units(mention), lambda unit: F.struct(
            kind.alias("kind"), normal_form(kind, unit).alias("norm"), gender.alias("gender"),
            F.when(kind == "name", unit).alias("word"),
        ))

    return F.array_distinct(F.flatten(F.transform(found, entities)))


# Draws of one entity before the search for distinct surrogates ends.
MOST_ATTEMPTS = 60


def surrogates(mentions: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) of every distinct entity; surrogates differ
    from each other and from all entities of their kind.

    Of entities that drew the same, the one with the smallest normal form
    keeps it; the others, and those that drew an entity, draw again. Where the
    entities fill so much of a form that ``MOST_ATTEMPTS`` draws do not tell
    them apart, there is hardly a surrogate left: that is an error.
    """
    entities = cut_lineage(mentions.groupBy("kind", "norm").agg(F.max("gender").alias("gender")), "entities")
    drawn = lambda df: df.withColumn("surrogate", surrogate(*map(F.col, ("kind", "norm", "gender", "attempt")), key))
    current = cut_lineage(drawn(entities.withColumn("attempt", F.lit(0))), "surrogates")
    for _ in range(MOST_ATTEMPTS):
        keeper = current.groupBy("kind", "surrogate").agg(F.min("norm").alias("keeper"))
        taken = entities.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("taken"))
        checked = cut_lineage(
            current.join(keeper, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left")
            .withColumn("again", F.col("taken").isNotNull() | (F.col("norm") != F.col("keeper")))
            .select("kind", "norm", "gender", "attempt", "surrogate", "again"),
            "surrogates",
        )
        good = checked.where("not again").drop("again")
        again = checked.where("again").drop("again", "surrogate").withColumn("attempt", F.col("attempt") + 1)
        if again.isEmpty():
            return good.select("kind", "norm", "surrogate")
        current = cut_lineage(good.unionByName(drawn(again)), "surrogates")
    crowded = sorted(r["kind"] for r in again.select("kind").distinct().collect())
    raise ValueError(f"no distinct surrogates are left for some entities of kind {', '.join(crowded)}")


def _written(mention: Column, known: Column) -> Column:
    kind = kind_of(mention)
    return F.array_join(F.transform(_units(mention), lambda unit: in_form(
        kind, unit, F.element_at(known, F.concat_ws(":", kind, normal_form(kind, unit)))
    )), " ")


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text`` and the number of replaced
    mentions, ``pii_count``.

    Only texts with entities are shuffled, by their hash, to meet the row with
    their own surrogates; all others are passed through.
    """
    names = [c for c in docs.columns if c != "pii_count"]
    base = docs.select(*[F.col(f"`{c}`") for c in names])
    holds = F.coalesce(holds_entity(F.col("text")), F.lit(False))
    clean = base.where(~holds).withColumn("pii_count", F.lit(0).cast("long"))
    mentions = cut_lineage(
        docs.select(F.col("text").alias("_pii_text")).where(holds_entity(F.col("_pii_text")))
        .select(F.xxhash64("_pii_text").alias("_pii_hash"), F.explode(_mentions(F.col("_pii_text"))).alias("m"))
        .select("_pii_hash", "m.*").distinct(),
        "mentions",
    )
    of_text = (
        mentions.join(surrogates(mentions, key), ["kind", "norm"]).groupBy("_pii_hash").agg(
            F.map_from_entries(F.collect_set(F.struct(F.concat_ws(":", "kind", "norm"), "surrogate"))).alias("_pii_map"),
            F.array_sort(F.array_union(F.collect_set("word"), F.collect_set(F.upper("word")))).alias("_pii_names"),
        )
    )
    # The names a text introduces with a title, wherever they stand in it.
    bare = F.concat(F.lit(ENTITY + r"|(?<!\p{L})(?:"), F.array_join("_pii_names", "|"), F.lit(r")(?!\p{L})"))
    changed = (
        base.where(holds).withColumn("_pii_hash", F.xxhash64("text")).join(of_text, "_pii_hash")
        .withColumn("_pii_pattern", F.when(F.size("_pii_names") > 0, bare).otherwise(F.lit(ENTITY)))
        .withColumns({
            "_pii_found": F.regexp_extract_all(F.col("text"), F.col("_pii_pattern"), F.lit(0)),
            "_pii_between": F.split(F.col("text"), F.col("_pii_pattern"), -1),
        })
        .withColumn("_pii_new", F.transform("_pii_found", lambda m: _written(m, F.col("_pii_map"))))
        .withColumns({
            "text": F.array_join(F.flatten(F.transform(
                "_pii_between", lambda p, k: F.array(p, F.coalesce(F.get(F.col("_pii_new"), k), F.lit(""))))), ""),
            "pii_count": F.size("_pii_found").cast("long"),
        })
    )
    return clean.unionByName(changed.select(*[F.col(f"`{c}`") for c in names], "pii_count"))
