"""PII: detected entities are replaced by keyed surrogates of their own kind.

E-mail addresses, IPv4 addresses, card numbers, phone numbers, secrets given as ``password=...`` or ``token = "..."`` and names after a form
of address are found by one pattern, so matches never overlap. A surrogate keeps the form: each letter becomes a
letter of the same script and case, each digit a digit; a card number passes the Luhn test if the original does; an
address stays a valid one; a given name is drawn from names of the gender that the form of address tells. All is
derived from a SHA-256 of key, kind, entity and attempt.

The distinct entities of the whole table get their surrogates in one place: those that collide with each other or
with a real entity are derived again with the next attempt until none does, so different entities stay different (names
too: each surname has a surrogate of its own, and so has each person) and an entity has one surrogate wherever it
occurs. Where a short form has no free value left, a surrogate is a letter longer. Texts meet their surrogates by the list of their matches: equal lists
share one row, and a list is as long as its text has matches. Texts without a match are not moved at all.

Defined cases: a null text stays null; a text without matches stays as it is; repeated rows are replaced alike;
other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swapbook.llm.store import kept

#: Kinds and patterns, in the order in which they are tried at a place.
PATTERNS = {
    # an address begins where no other character of it stands before, so a long run is looked through once
    "email": r"(?<![A-Za-z0-9])(?<![A-Za-z0-9][._%+-])(?<![A-Za-z0-9][._%+-]{2})(?<![A-Za-z0-9][._%+-]{3})[A-Za-z0-9][A-Za-z0-9._%+-]*+"
    r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?i:password|passwd|pwd|secret|api_key|token)[\"']?[ \t]{0,3}=[ \t]{0,3}[\"']?[A-Za-z0-9_/+-]{6,}",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)",
    "card": r"(?<![\d-])(?:\d{4}[ -]?){3}\d{4}(?![\d-]*\d)",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}(?!\d)",
    "name": r"(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Señor|Señora|Господин|Госпожа|Κύριος|Κυρία)\.? (?:\p{Lu}\p{Ll}+[ -])?\p{Lu}\p{Ll}+",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A cheap look for texts that can hold an entity at all.
HINT = r"[@=]|\d{2}|\.\d|(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Señora?|Господин|Госпожа|Κύριος|Κυρία)\.? "
FEMALE = "^(?:Mrs|Ms|Miss|Frau|Madame|Señora|Госпожа|Κυρία)\\b"
ALPHABETS = (
    "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àâäáãåçèéêëìíîïñòóôöõùúûüý",
    "ÀÂÄÁÃÅÇÈÉÊËÌÍÎÏÑÒÓÔÖÕÙÚÛÜÝ", "абвгдежзийклмнопрстуфхцчшщыэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω",
    "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
)
GIVEN = {
    ("latin", "f"): ("Anna", "Clara", "Elena", "Irene", "Julia", "Laura", "Maria", "Nora", "Paula", "Sofia"),
    ("latin", "m"): ("Adam", "Bruno", "David", "Emil", "Felix", "Hugo", "Leon", "Martin", "Oscar", "Paul"),
    ("cyrillic", "f"): ("Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Юлия"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Денис", "Иван", "Максим", "Олег", "Павел"),
    ("greek", "f"): ("Άννα", "Ελένη", "Ειρήνη", "Μαρία", "Νίκη", "Σοφία"),
    ("greek", "m"): ("Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος", "Σπύρος"),
}


def matches(text: Column) -> Column:
    """All entities of a text, left to right; none for most texts after a look at a simple pattern."""
    found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    return F.when(F.rlike(text, F.lit(HINT)), found).otherwise(F.array().cast("array<string>"))


def kind_of(entity: Column) -> Column:
    kind = F.lit("name")
    for name, pattern in reversed(list(PATTERNS.items())[:-1]):
        kind = F.when(F.rlike(entity, F.lit(f"^(?:{pattern})$")), name).otherwise(kind)
    return kind


def _pick(seed: Column, place: Column, size: Column | int) -> Column:
    return F.pmod(F.xxhash64(seed, place), F.lit(size) if isinstance(size, int) else size).cast("int")


def scrambled(value: Column, seed: Column, fixed: int | Column = 0) -> Column:
    """``value`` with letters and digits replaced by others of their alphabet, from place ``fixed`` on."""

    def other(ch: Column, i: Column) -> Column:
        out = ch
        for alphabet in reversed(ALPHABETS):
            new = F.substring(F.lit(alphabet), _pick(seed, i, len(alphabet)) + 1, F.lit(1))
            out = F.when(F.instr(F.lit(alphabet), ch) > 0, new).otherwise(out)
        return F.when(i < fixed, ch).otherwise(out)

    return F.array_join(F.transform(F.split(value, ""), other), "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn test of a string of digits whose last one is at an odd place from the right."""

    def add(total: Column, x: Column) -> Column:
        return total + x

    def weigh(d: Column, i: Column) -> Column:
        n = d.cast("int")
        double = (F.length(digits) - 1 - i) % 2 == 1
        return F.when(double, n * 2 - F.when(n > 4, 9).otherwise(0)).otherwise(n)

    return F.aggregate(F.transform(F.split(digits, ""), weigh), F.lit(0), add)


def widened(kind: Column, entity: Column, attempt: Column) -> Column:
    """``entity``, a letter longer after every ``ROUNDS`` attempts: short forms have few values, and all may be taken.

    Card numbers and IP addresses stay: their length is fixed and leaves room for more than a billion of them.
    """
    greek, cyrillic = F.rlike(entity, F.lit("\\p{IsGreek}")), F.rlike(entity, F.lit("\\p{IsCyrillic}"))
    letter = F.when(greek, "α").when(cyrillic, "а").otherwise("a")
    more = F.repeat(letter, F.floor(attempt / ROUNDS).cast("int"))
    digits = F.repeat(F.lit("0"), F.floor(attempt / ROUNDS).cast("int"))
    return (
        F.when(kind == "email", F.concat(F.regexp_replace(more, ".", "a"), entity))
        .when(kind == "phone", F.concat(entity, digits))
        .when(kind.isin("secret", "name"), F.concat(entity, more))
        .otherwise(entity)
    )


def _seed(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string")), 256)


def _name(entity: Column, surname: Column, attempt: Column, key: str) -> Column:
    """Form of address kept, the surname by its surrogate, a given name from the names of its gender.

    Later attempts draw other given names, and after ``ROUNDS`` of them a given name like any other word.
    """
    title = F.regexp_extract(entity, "^\\S+", 0)
    rest = F.split(F.substring(entity, F.length(title) + 2, F.length(entity)), " ")
    gender = F.when(F.rlike(title, F.lit(FEMALE)), "f").otherwise("m")
    script = F.when(F.rlike(entity, F.lit("\\p{IsCyrillic}")), "cyrillic").when(F.rlike(entity, F.lit("\\p{IsGreek}")), "greek").otherwise("latin")
    word = F.get(rest, F.lit(0))
    first = F.concat(F.lit(key), word)
    drawn = F.when(attempt == 0, first).otherwise(F.concat_ws("\x1f", first, attempt.cast("string")))
    given = scrambled(widened(F.lit("name"), word, attempt), _seed(key, F.lit("given"), entity, attempt))
    for (s, g), names in GIVEN.items():
        own = F.get(F.array(*[F.lit(n) for n in names]), _pick(drawn, F.lit(-1), len(names)))
        given = F.when((attempt < ROUNDS) & (script == s) & (gender == g), own).otherwise(given)
    return F.concat_ws(" ", title, F.when(F.size(rest) > 1, given), surname)


def surrogate(kind: Column, entity: Column, attempt: Column, key: str) -> Column:
    """A candidate of the form of ``entity``; of kind name it is one of a surname."""
    seed = _seed(key, kind, entity, attempt)
    entity = widened(kind, entity, attempt)
    at = F.length(F.regexp_extract(entity, "\\.[A-Za-z]+$", 0))
    email = F.concat(
        scrambled(F.substring(entity, F.lit(1), F.length(entity) - at), seed), F.substring(entity, F.length(entity) - at + 1, at)
    )
    octets = F.transform(F.split(entity, "\\."), lambda o, i: (_pick(seed, i, 254) + 1).cast("string"))
    mixed = scrambled(entity, seed, 1)
    digits, old = F.regexp_replace(mixed, "\\D", ""), F.regexp_replace(entity, "\\D", "")
    body = F.substring(mixed, F.lit(1), F.length(mixed) - 1)
    sum_without_last = luhn_sum(F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), F.lit("0")))
    check = ((10 - sum_without_last % 10) % 10).cast("string")
    card = F.when(luhn_sum(old) % 10 == 0, F.concat(body, check)).otherwise(mixed)
    country = F.length(F.regexp_extract(entity, "^\\+\\d{1,3}(?=[ .(-])", 0))
    phone = scrambled(entity, seed, F.greatest(country, F.lit(2)))
    secret = scrambled(entity, seed, F.length(F.regexp_extract(entity, "^[^=]*=[ \\t]*[\"']?", 0)))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.array_join(octets, "."))
        .when(kind == "card", card)
        .when(kind == "phone", phone)
        .when(kind == "secret", secret)
        .otherwise(scrambled(entity, seed))
    )


def _apart(items: DataFrame, candidate: Callable[[Column], Column]) -> DataFrame:
    """``items`` (kind, entity and more) with ``surrogate``: no surrogate twice in a kind, none that is an entity of it.

    ``candidate`` tells the surrogate of an attempt; items whose candidate is taken come again with the next one.
    """
    everyone = kept(items)
    settled = None
    waiting = everyone.withColumn("attempt", F.lit(0))
    while True:
        tried = kept(waiting.withColumn("surrogate", candidate(F.col("attempt"))))
        taken = everyone.select("kind", F.col("entity").alias("surrogate")).withColumn("_owner", F.lit(True))
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "surrogate").withColumn("_owner", F.lit(True)))
        first = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("entity")) == 1
        judged = tried.withColumn("_first", first).join(taken.distinct(), ["kind", "surrogate"], "left")
        judged = kept(judged.withColumn("_good", F.col("_first") & F.col("_owner").isNull()))
        good = judged.filter("_good").select(*items.columns, "surrogate")
        settled = good if settled is None else settled.unionByName(good)
        waiting = judged.filter("not _good").select(*items.columns, (F.col("attempt") + 1).alias("attempt"))
        if waiting.isEmpty():
            return settled


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate) for distinct entities: no surrogate twice in a kind, none that is an entity of it.

    Surnames get theirs first, each one its own, so that a surname is the same everywhere and two are never mixed up.
    Mentions then differ by their given names, which are drawn again where two persons of one surname would meet.
    """
    kind, entity = F.col("kind"), F.col("entity")
    entities = kept(entities)
    others = _apart(entities.filter(kind != "name"), lambda attempt: surrogate(kind, entity, attempt, key))
    names = entities.filter(kind == "name").withColumn("_surname", F.regexp_extract(entity, "\\S+$", 0))
    surnames = names.select("kind", F.col("_surname").alias("entity")).distinct()
    known = _apart(surnames, lambda attempt: surrogate(kind, entity, attempt, key))
    named = names.join(known.select(F.col("entity").alias("_surname"), F.col("surrogate").alias("_new")), "_surname")
    persons = _apart(named, lambda attempt: _name(entity, F.col("_new"), attempt, key))
    return others.unionByName(persons.select("kind", "entity", "surrogate"))


#: Attempts of a form as it is, before it becomes a letter longer.
ROUNDS = 4


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in its text, and ``n_entities``."""
    own = docs.select(F.struct(*docs.columns).alias("_doc")).withColumn("_found", matches(F.col(f"_doc.{text}")))
    lists = kept(own.filter(F.size("_found") > 0).select("_found").distinct())
    each = lists.select("_found", F.posexplode("_found").alias("_at", "entity"))
    entities = each.select("entity").distinct().withColumn("kind", kind_of(F.col("entity")))
    known = surrogates(entities, key)
    new = each.join(known, "entity").groupBy("_found").agg(F.sort_array(F.collect_list(F.struct("_at", "surrogate"))).alias("_new"))
    new = new.select("_found", F.col("_new.surrogate").alias("_new"))

    def columns(body: Column, n: Column) -> list[Column]:
        return [body.alias(text) if c == text else F.col(f"_doc.{c}").alias(c) for c in docs.columns] + [n.cast("long").alias("n_entities")]

    met = own.filter(F.size("_found") > 0).join(new, "_found")
    met = met.withColumn("_gaps", F.split(F.col(f"_doc.{text}"), ENTITY, -1))
    pieces = F.transform("_gaps", lambda g, i: F.concat(g, F.coalesce(F.get("_new", i), F.lit(""))))
    changed = met.select(*columns(F.array_join(pieces, ""), F.size("_found")))
    same = own.filter(F.coalesce(F.size("_found"), F.lit(0)) <= 0).select(*columns(F.col(f"_doc.{text}"), F.lit(0)))
    return changed.unionByName(same)
