"""Personal data replaced by surrogates.

Entities are found by one pattern with an alternative per type. Each distinct entity of the whole table
gets one surrogate, made from a keyed SHA-512 of its type and normal form, so the same entity has the same
surrogate in every document and no table of secrets is needed to find it again. A surrogate keeps what the
text around it relies on: the type, the layout of digits, letters and signs, upper and lower case, check
digits of card numbers, the network part that says what an entity is, and for names the gender that the
title or given name shows and the script. A family name is an entity of its own, so "Mr Smith" stays kin to
"John Smith"; given names are told apart within a family.

Surrogates are checked against each other and against all entities found: an entity whose surrogate is
taken, or is someone's real datum, is keyed anew, until all are distinct; from some attempt on surrogates
grow longer, so that a small class of them is never used up. Everything is a DataFrame
expression. Texts without entities pass by; of the others only the entities are joined, by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import documents, stored

#: Replace it by your own secret; without it nobody can compute the surrogates.
KEY = "tidewheel"
#: From this attempt on a surrogate gets one more character per attempt. Addresses cannot grow: there are
#: 3.7 billion of them.
GROWS = 4
#: What stands for the signs of a secret: none that ends it.
SIGNS = "!#$%&*+-./:=?@_~"

GIVEN = {
    "latin": {
        "m": ["James", "Robert", "John", "Michael", "David", "William", "Thomas", "Daniel", "Paul", "Mark", "Peter", "Jan", "Luis", "Carlos", "Miguel", "Pierre", "Jean", "Hans", "Karl", "Stefan", "Marco", "Ahmed"],
        "f": ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Anna", "Emma", "Laura", "Julia", "Maria", "Carmen", "Lucia", "Marie", "Claire", "Sophie", "Petra", "Ingrid", "Elena", "Fatima"],
    },
    "cyrillic": {
        "m": ["Иван", "Пётр", "Сергей", "Андрей", "Дмитрий", "Алексей", "Николай", "Михаил"],
        "f": ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна", "Ирина", "Светлана"],
    },
}
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "г-н"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "г-жа"],
    "n": ["Dr", "Prof"],
}
SYLLABLES = {
    "latin": ["bar", "del", "fen", "gar", "hol", "kin", "lan", "mar", "nor", "pel", "ros", "sal", "tor", "vin", "wel", "zan"],
    "cyrillic": ["бар", "вер", "гор", "дан", "зор", "кор", "лав", "мир", "нов", "пол", "рад", "сол", "тал", "фед", "чер", "яр"],
}

_WORD = r"\p{Lu}[\p{L}'-]*\p{L}"
_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_GIVEN = "|".join(n for by in GIVEN.values() for names in by.values() for n in names)
#: Type and pattern, in order of precedence. None has a group that captures.
PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]++@[\w-]++(?:\.[\w-]++)++",
    "secret": r"(?i:\b(?:password|passwd|pwd|secret|token|api_?key)\b)(?: ?[=:] ?\"?[^\s\";,]{6,}\"?)",
    "access_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "hex_key": r"(?<![0-9A-Za-z])(?=[a-f]*\d)[0-9a-f]{32,64}(?![0-9A-Za-z])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]?\d{4}(?!\d)|(?<![\d+])\+\d{8,15}(?!\d)|(?<![\d+])0\d(?:[ .]\d\d){4}(?!\d)|(?<![\d+])0\d{2,4}[-/]\d{6,9}(?!\d)",
    "name": rf"(?=[A-ZА-Яг])(?<!\p{{L}})(?:(?:{_TITLE})\.? {_WORD}(?: {_WORD})?|(?:{_GIVEN}) {_WORD})",
}
# An entity begins where no ASCII letter or digit stands before: one quick test for most places of a text.
PATTERN = "(?<![0-9A-Za-z])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"


def _may_have(text: Column) -> Column:
    """A quick test that every text with an entity passes: a sign that all types but two need, or these."""
    return (
        F.regexp_like(text, F.lit("[0-9@=:]"))
        | text.contains("AKIA")
        | text.contains("ASIA")
        | F.regexp_like(text, F.lit(PATTERNS["name"]))
    )


def _type(value: Column) -> Column:
    """The type whose pattern is the whole value."""
    kind = None
    for name, pattern in PATTERNS.items():
        whole = F.regexp_like(value, F.lit(f"^(?:{pattern})$"))
        kind = F.when(whole, name) if kind is None else kind.when(whole, name)
    return kind.otherwise("name")


def _normal(kind: Column, value: Column) -> Column:
    """What two mentions of one entity share: digits for numbers, no title for names, no case for mail."""
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("card", "phone", "ssn"), F.regexp_replace(value, r"\D", ""))
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .when(kind == "secret", F.regexp_replace(value, r"(?i)^\w+ ?[=:] ?\"?|\"$", ""))
        .when(kind == "name", F.regexp_replace(value, rf"^(?:{_TITLE})\.? ", ""))
        .otherwise(value)
    )


def _gender(value: Column) -> Column:
    out = F.when(F.lit(False), "n")
    for g, titles in TITLES.items():
        out = out.when(F.regexp_like(value, F.lit(rf"^(?:{'|'.join(titles)})\.? ")) & F.lit(g != "n"), g)
    for g in ("m", "f"):
        names = "|".join(n for by in GIVEN.values() for n in by[g])
        out = out.when(F.regexp_like(value, F.lit(rf"(?:^| )(?:{names})(?: |$)")), g)
    return out.otherwise("n")


def _byte(digest: Column, place: Column) -> Column:
    """A number from 0 to 255 for a place of a value, from a hex digest of 64 bytes."""
    return F.conv(F.substring(digest, F.pmod(place, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _alike(value: Column, digest: Column, letters: str = "abcdefghijklmnopqrstuvwxyz", *, whole: bool = False) -> Column:
    """The value with each digit, lower and upper case letter replaced by another of its kind; the whole
    value with letters and digits of other scripts and signs, too."""

    def swapped(c: Column, i: Column) -> Column:
        b = _byte(digest, i)
        pick = lambda s: F.substring(F.lit(s), F.pmod(b, F.lit(len(s))) + 1, F.lit(1))
        cased = F.when(F.regexp_like(c, F.lit("[0-9]")), pick("0123456789")).when(F.regexp_like(c, F.lit(r"\p{Ll}")), pick(letters)).when(F.regexp_like(c, F.lit(r"\p{Lu}")), pick(letters.upper()))
        if not whole:
            return cased.otherwise(c)
        return cased.when(F.regexp_like(c, F.lit(r"\p{N}")), pick("0123456789")).when(F.regexp_like(c, F.lit(r"\p{L}")), pick(letters)).when(c != "", pick(SIGNS)).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), swapped), "")


def _luhn(digits: Column) -> Column:
    """The digits with the last one set so that the number passes the Luhn check."""
    head = F.substring(digits, F.lit(1), F.length(digits) - 1)
    doubled = F.transform(
        F.split(F.reverse(head), ""),
        lambda c, i: F.when(i % 2 == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return F.concat(head, F.pmod(-total, F.lit(10)).cast("string"))


def _checked(country: Column, account: Column) -> Column:
    """An account number with the two check digits that its country's banks would give it (modulo 97)."""
    digits = F.split(F.concat(account, country, F.lit("00")), "")
    value = lambda c: F.when(F.regexp_like(c, F.lit("[0-9]")), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(digits, F.lit(0), lambda a, c: F.when(c == "", a).otherwise(F.pmod(a * F.when(value(c) > 9, 100).otherwise(10) + value(c), F.lit(97))))
    return F.concat(country, F.lpad((F.lit(98) - rest).cast("string"), 2, "0"), account)


def _made(kind: Column, normal: Column, gender: Column, key: str, attempt: Column) -> Column:
    """The surrogate of a normal form."""
    digest = lambda *more: F.sha2(F.concat_ws("\x1f", F.lit(key), kind, *more, attempt.cast("string")), 512)
    own = digest(normal)
    at = F.instr(normal, "@")
    local, domain = F.substring(normal, F.lit(1), at - 1), F.substring(normal, at + 1, F.length(normal))
    # one host is one surrogate host, whoever's mailbox it is; the last two parts are a reserved domain
    host = F.concat(_alike(F.substring_index(domain, ".", 1), F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("host"), domain), 512)), F.lit(".example.org"))
    octet = lambda k, low, n: (F.lit(low) + F.pmod(_byte(own, F.lit(2 * k)) * 256 + _byte(own, F.lit(2 * k + 1)), F.lit(n))).cast("string")
    ip = F.concat_ws(".", octet(0, 1, 223), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254))
    by_script = {}
    for script, syllables in SYLLABLES.items():
        pick = lambda words, k: F.element_at(F.array(*map(F.lit, words)), _byte(own, F.lit(k)) % len(words) + 1)  # noqa: B023, E731
        by = GIVEN[script]
        more = [F.when(attempt >= k, pick(syllables, 2 + k)).otherwise("") for k in range(GROWS, GROWS + 8)]
        given = F.when(gender == "m", pick(by["m"], 0)).when(gender == "f", pick(by["f"], 0)).otherwise(pick(by["m"] + by["f"], 0))
        # a family with more given names than there are gets second ones
        second = F.when(attempt > 1, F.initcap(F.concat(F.lit(" "), pick(syllables, 6), pick(syllables, 7), *more))).otherwise("")
        scoped = F.concat(given, second, F.lit(" "), F.substring_index(normal, " ", -1))
        family = F.initcap(F.concat(*[pick(syllables, k) for k in (1, 2, 3)], F.when(attempt > 0, pick(syllables, 4)).otherwise(""), F.when(attempt > 1, pick(syllables, 5)).otherwise(""), *more))
        by_script[script] = F.when(kind == "given", scoped).otherwise(family)
    name = F.when(F.regexp_like(normal, F.lit(r"\p{IsCyrillic}")), by_script["cyrillic"]).otherwise(by_script["latin"])
    grown = F.greatest(attempt - (GROWS - 1), F.lit(0))
    longer = F.concat(normal, F.repeat(F.lit("0"), grown))
    number = _alike(longer, own)
    country = F.greatest(F.length(normal) - 10, F.lit(0))  # a country code stays
    hexes = F.regexp_like(normal, F.lit("^[0-9a-f]+$"))
    return (
        F.when(kind == "email", F.concat(_alike(F.concat(local, F.repeat(F.lit("x"), grown)), own), F.lit("@"), host))
        .when(kind == "ip", ip)
        .when(kind == "card", _luhn(F.concat(F.substring(normal, 1, 1), F.substring(number, F.lit(2), F.length(number)))))
        .when(kind == "phone", F.concat(F.substring(normal, F.lit(1), country), F.substring(number, country + 1, F.length(number))))
        .when(kind == "access_key", F.concat(F.substring(normal, 1, 4), F.substring(number, F.lit(5), F.length(number))))
        .when(kind == "iban", _checked(F.substring(normal, 1, 2), F.substring(number, F.lit(5), F.length(number))))
        .when((kind == "hex_key") | ((kind == "secret") & hexes), _alike(longer, own, "abcdef"))
        .when(kind == "secret", _alike(F.concat(normal, F.repeat(F.lit("x"), grown)), own, whole=True))
        .when(kind.isin("given", "family"), name)
        .otherwise(number)
    )


def _shown(kind: Column, value: Column, normal: Column, surrogate: Column) -> Column:
    """The surrogate in the layout of one mention."""

    def digit(c: Column, i: Column) -> Column:
        nth = F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), r"[^0-9A-Z]", ""))
        return F.when(F.regexp_like(c, F.lit("[0-9A-Z]")), F.substring(surrogate, nth, F.lit(1))).otherwise(c)

    laid = F.concat(F.array_join(F.transform(F.split(value, ""), digit), ""), F.substring(surrogate, F.length(normal) + 1, F.length(surrogate)))
    title = F.regexp_extract(value, rf"^(?:{_TITLE})\.? ", 0)
    lead = F.regexp_extract(value, r"(?i)^\w+ ?[=:] ?\"?", 0)
    return (
        F.when(kind.isin("card", "phone", "ssn", "iban"), laid)
        .when((kind == "email") & (value == F.upper(value)), F.upper(surrogate))
        .when(kind == "name", F.concat(title, surrogate))
        .when(kind == "secret", F.concat(lead, surrogate, F.regexp_extract(value, r"\"$", 0)))
        .otherwise(surrogate)
    )


def surrogates(mentions: DataFrame, key: str = KEY) -> DataFrame:
    """value, kind and shown for every distinct mention (value): what to put in its place."""
    typed = mentions.select("value").distinct().withColumn("kind", _type(F.col("value")))
    typed = typed.withColumn("normal", _normal(F.col("kind"), F.col("value"))).withColumn("gender", _gender(F.col("value")))
    typed = stored(typed, "mentions")
    # mentions of one person with and without a title are one entity, of the gender that any of them shows; the
    # family is an entity of its own, and the given name one within the family
    names, others = typed.where("kind = 'name'"), typed.where("kind <> 'name'")
    families = names.select(F.lit("family").alias("kind"), _family().alias("normal"), F.lit("n").alias("gender"))
    givens = names.where(F.instr("normal", " ") > 0).select(F.lit("given").alias("kind"), "normal", "gender")
    entities = others.select("kind", "normal", "gender").unionByName(families).unionByName(givens)
    entities = entities.groupBy("kind", "normal").agg(F.min("gender").alias("gender"))
    open_ = stored(entities.withColumn("attempt", F.lit(0)), "entities")
    real = open_.select("kind", F.col("normal").alias("surrogate")).withColumn("real", F.lit(True))
    done = None
    while True:
        tried = open_.withColumn("surrogate", _made(F.col("kind"), F.col("normal"), F.col("gender"), key, F.col("attempt")))
        # those settled before come first, then the smallest entity
        claims = tried.withColumn("settled", F.lit(False))
        if done is not None:
            claims = claims.unionByName(done.withColumn("settled", F.lit(True)))
        first = claims.groupBy("kind", "surrogate").agg(F.min(F.struct(~F.col("settled"), "normal")).alias("winner"))
        judged = tried.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        free = (F.col("winner.normal") == F.col("normal")) & F.col("real").isNull()
        judged = stored(judged.select("kind", "normal", "gender", "attempt", "surrogate", free.alias("free")), "judged")
        won = judged.where("free").drop("free")
        done = won if done is None else done.unionByName(won)
        open_ = judged.where("not free").select("kind", "normal", "gender", (F.col("attempt") + 1).alias("attempt"))
        if open_.isEmpty():
            break
    done = done.select("kind", "normal", "surrogate")
    plain = others.join(done, ["kind", "normal"])
    kin = done.where("kind = 'family'").select(F.col("normal").alias("family"), F.col("surrogate").alias("new_family"))
    first = done.where("kind = 'given'").select("normal", F.col("surrogate").alias("scoped"))
    parts = names.withColumn("family", _family()).join(kin, "family").join(first, "normal", "left")
    given = F.substring(F.col("scoped"), F.lit(1), F.length("scoped") - F.length("family") - 1)
    whole = parts.select("kind", "normal", "value", "gender", F.concat_ws(" ", given, "new_family").alias("surrogate"))
    named = plain.unionByName(whole)
    return named.select("value", "kind", _shown(F.col("kind"), F.col("value"), F.col("normal"), F.col("surrogate")).alias("shown"))


def _family() -> Column:
    return F.substring_index("normal", " ", -1)


def replace(docs: DataFrame, *, key: str = KEY, count: str = "n_entities") -> DataFrame:
    """``docs`` with its texts' entities replaced, and how many there were as ``count``.

    ``docs`` needs text; all its columns are kept, a column named ``count`` is replaced. Null and empty
    texts stay as they are with no entities; rows are not told apart by any key, so null ids and repeated
    rows are replaced like others. An empty table gives no rows.
    """
    kept = docs.drop(count)
    plain = kept.columns
    own = "__mentions"
    found = F.coalesce(_may_have(F.col("text")) & F.regexp_like("text", F.lit(PATTERN)), F.lit(False))
    tagged = kept.where(found).withColumn(own, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    some = stored(tagged, "with-entities")
    none = kept.where(~found).select(*plain, F.lit(0).cast("long").alias(count))
    lists = some.select(own).distinct()
    table = stored(surrogates(some.select(F.explode(own).alias("value")), key), "surrogates")
    each = lists.select(own, F.posexplode(own).alias("place", "value")).join(table.select("value", "shown"), "value")
    shown = each.groupBy(own).agg(F.sort_array(F.collect_list(F.struct("place", "shown"))).alias("__shown"))
    both = some.join(shown, own)
    gaps = F.split("text", PATTERN, -1)
    parts = F.zip_with(gaps, F.col("__shown.shown"), lambda g, s: F.concat(g, F.coalesce(s, F.lit(""))))
    replaced = both.withColumn("text", F.array_join(parts, "")).select(*plain, F.size(own).cast("long").alias(count))
    return none.unionByName(replaced)


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace(documents(spark, sf_dir)).select("doc_id", "text", "n_entities")
