"""Personal data replaced by keyed surrogates, with DataFrame functions only."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import free_name, whole_text
from signalloom.operators.staging import staged

#: Titles that name a gender, and such as don't.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία")
EITHER = ("Dr", "Prof")

_TITLES = "|".join(sorted(MALE + FEMALE + EITHER, key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: A word of a name, or an initial.
_NAME_WORD = r"\p{Lu}(?:[\p{L}'’\-]++|\.|(?![\p{L}\p{N}]))"
_SECRET = r"(?i:token|api[_-]?key|secret|password|passwd)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_/+\-]{16,}"
#: Java patterns by type, tried in this order at each place.
PATTERNS = {
    "secret": rf"(?<![\p{{L}}\p{{N}}_]){_SECRET}|(?<![\p{{L}}\p{{N}}_])(?:AKIA|ghp_|sk-)[A-Za-z0-9]{{16,}}",
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)*?\.\p{L}{2,}+",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.\d)",
    "card": r"(?<![\p{L}\p{N}.\-])\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}(?![\p{L}\p{N}])",
    "phone": (
        r"(?<![\p{L}\p{N}.+])\+\d{1,3}(?:[ .\-]?(?:\(\d{1,4}\)|\d{2,4})){2,5}(?!\d)"
        r"|(?<![\p{L}\p{N}.\-])(?:\(\d{3}\) ?|\d{3}[.\-])\d{3}[.\-]\d{4}(?![\p{L}\p{N}])"
    ),
    "ssn": r"(?<![\p{L}\p{N}.\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:(?:{_TITLES})\.? )++{_NAME_WORD}(?: {_NAME_WORD})*+",
}
#: All of them start where no word goes on; said once in front, that spares most places the other attempts.
PATTERN = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(PATTERNS.values())})"

# Letters that surrogates are made of, by script.
VOWELS, CONSONANTS = "aeiou", "bcdfghjklmnpqrstvwxyz"
CYRILLIC_VOWELS, CYRILLIC_CONSONANTS = "аеиоу", "бвгдзклмнпрстфх"
GREEK_VOWELS, GREEK_CONSONANTS = "αεηιο", "βγδζκλμνπρστφχ"
HEX = "0123456789abcdef"
#: Initials, by script; each stands for another of its row.
INITIALS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØŒŠÙÚÛÜÝŽ", "АБВГДЕЁЖЗИЙКЛМНОПРСТУФХЦЧШЩЫЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")
STREAM_BYTES = 128
#: What stands between the words of a name, and stays.
NAME_BREAK = "[ \\-]"
#: Rounds of draws of the same length; after as many more, surrogates get one more letter, digit or syllable.
SAME_LENGTH = 3


def _stream(key: str, *parts: Column) -> Column:
    """256 hexadecimal digits that depend on key and parts alone."""
    seed = F.concat_ws("|", F.lit(key), *parts)
    return F.concat(*[F.sha2(F.concat(seed, F.lit(f"|{i}")), 256) for i in range(4)])


def _byte(stream: Column, i: Column) -> Column:
    """Byte i (from 0; past the end it starts again) of the stream."""
    return F.conv(F.substr(stream, (i % STREAM_BYTES) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, byte: Column) -> Column:
    return F.substr(F.lit(letters), byte % len(letters) + 1, F.lit(1))


def _mapped(text: Column, each) -> Column:
    """``each(character, index)`` for every character, joined."""
    places = F.filter(F.sequence(F.lit(0), F.length(text)), lambda i: i < F.length(text))
    return F.array_join(F.transform(places, lambda i: each(F.substr(text, i + 1, F.lit(1)), i)), "")


def _alike(stream: Column):
    """Digit for digit, vowel for vowel, consonant for consonant of the same script; the rest stays."""

    def each(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        return (
            F.when(c.rlike("[0-9]"), (b % 10).cast("string"))
            .when(c.rlike(f"[{VOWELS}]"), _pick(VOWELS, b))
            .when(c.rlike("[а-яё]"), F.when(c.rlike(f"[{CYRILLIC_VOWELS}]"), _pick(CYRILLIC_VOWELS, b)).otherwise(_pick(CYRILLIC_CONSONANTS, b)))
            .when(c.rlike("[α-ωάέήίόύώ]"), F.when(c.rlike(f"[{GREEK_VOWELS}]"), _pick(GREEK_VOWELS, b)).otherwise(_pick(GREEK_CONSONANTS, b)))
            .when(c.rlike(r"\p{L}"), _pick(CONSONANTS, b))
            .otherwise(c)
        )

    return each


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def luhn_sum(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.filter(F.sequence(F.lit(0), n), lambda i: i < n), F.lit(0), add)


def has_candidate(text: Column) -> Column:
    """Whether a pattern matches. Texts without any sign that each match holds are told apart by cheap searches."""
    signs = ["=", ":", "AKIA", "ghp_", "sk-", *(f"{t}{end}" for t in MALE + FEMALE + EITHER for end in (". ", " "))]
    sign = reduce(lambda c, x: c | text.contains(x), signs, text.rlike("[0-9@]"))
    return sign & text.rlike(PATTERN)


def typed(forms: DataFrame) -> DataFrame:
    """(form, type, lead, body, norm, parts) of entities as they stand in texts; lead is a part that stays.

    Numbers that look like cards but fail the check digit are no entities and drop out. ``norm`` is what two
    forms of one entity have in common. ``parts`` are what gets surrogates of its own: a name's words, each with the
    gender the titles tell, null for initials; of any other entity ``norm``.
    """
    kind = reduce(
        lambda c, t: c.when(F.col("form").rlike(f"^(?:{PATTERNS[t]})$"), F.lit(t)), list(PATTERNS)[1:], F.when(F.col("form").rlike(f"^(?:{PATTERNS['secret']})$"), F.lit("secret"))
    )
    lead = F.when(F.col("type") == "secret", F.regexp_extract("form", r"^((?:(?i:token|api[_-]?key|secret|password|passwd)\s*[=:]\s*[\"']?)|AKIA|ghp_|sk-)", 1)).when(
        F.col("type") == "name", F.regexp_extract("form", rf"^((?:(?:{_TITLES})\.? )++)", 1)
    ).otherwise("")
    gender = (
        F.when(F.col("lead").rlike(rf"(?:^| )(?:{'|'.join(MALE)})[. ]"), "m")
        .when(F.col("lead").rlike(rf"(?:^| )(?:{'|'.join(FEMALE)})[. ]"), "f")
        .otherwise("n")
    )
    return (
        forms.withColumn("type", kind)
        .where("type is not null")
        .withColumn("lead", lead)
        .withColumn("body", F.substr("form", F.length("lead") + 1))
        .withColumn(
            "norm",
            F.when(F.col("type").isin("phone", "card", "ssn"), _digits(F.col("body")))
            .when(F.col("type") == "name", F.concat_ws(":", gender, F.lower("body")))
            .otherwise(F.lower("body")),
        )
        .withColumn(
            "parts",
            F.when(
                F.col("type") == "name",
                F.transform(F.split(F.lower("body"), NAME_BREAK), lambda w: F.when(F.length(F.rtrim(w, F.lit("."))) > 1, F.concat_ws(":", gender, w))),
            ).otherwise(F.array("norm")),
        )
        .where((F.col("type") != "card") | (luhn_sum(F.col("norm")) % 10 == 0))
    )


def _drawn(key: str) -> Column:
    """The surrogate of (type, norm) at this attempt, in the normal form of its type.

    Later attempts draw longer ones, so that few possible surrogates of the entity's own length, or none but the entity
    itself, don't clash for ever. Addresses, card and social security numbers keep their length.
    """
    norm = F.col("norm")
    stream = F.col("stream")
    more = F.floor(F.col("attempt") / SAME_LENGTH).cast("int")

    def grown(each) -> Column:
        places = F.filter(F.sequence(F.lit(0), more), lambda i: i < more)
        return F.array_join(F.transform(places, lambda i: each(F.lit(STREAM_BYTES - 1) - i * 2 % STREAM_BYTES)), "")

    alike = _mapped(norm, _alike(stream))
    hexadecimal = F.concat(_mapped(norm, lambda c, i: _pick(HEX, _byte(stream, i))), grown(lambda i: _pick(HEX, _byte(stream, i))))
    tld = F.regexp_extract(norm, r"(\.\p{L}+)$", 1)
    email = F.concat(grown(lambda i: _pick(CONSONANTS, _byte(stream, i))), _mapped(F.substr(norm, F.lit(1), F.length(norm) - F.length(tld)), _alike(stream)), tld)
    octets = F.array_join(F.array(*[(_byte(stream, F.lit(i)) % 254 + 1).cast("string") for i in range(4)]), ".")
    private = F.concat(F.lit("10."), F.substring_index(octets, ".", -3))
    card = F.concat(F.substr(norm, F.lit(1), F.lit(1)), F.substr(alike, F.lit(2), F.length(norm) - 2))
    check = ((10 - luhn_sum(F.concat(card, F.lit("0"))) % 10) % 10).cast("string")
    # Words of names: one syllable pattern per script, and an ending that tells the gender where the script's names do.
    gender, own = F.substr(norm, F.lit(1), F.lit(1)), F.substr(norm, F.lit(3))
    byte = lambda i: _byte(stream, F.lit(i))
    made = lambda c, v, f, m: F.concat(
        _pick(c, byte(0)), _pick(v, byte(1)), _pick(c, byte(2)), _pick(v, byte(3)), _pick(c, byte(4)),
        grown(lambda i: F.concat(_pick(v, _byte(stream, i)), _pick(c, _byte(stream, i - 1)))), F.when(gender == "f", f).when(gender == "m", m).otherwise("")
    )
    word = (
        F.when(own.rlike("[а-яё]"), made(CYRILLIC_CONSONANTS, CYRILLIC_VOWELS, "ова", "ов"))
        .when(own.rlike("[α-ω]"), made(GREEK_CONSONANTS, GREEK_VOWELS, "ου", "ος"))
        .otherwise(made(CONSONANTS, VOWELS, "a", "o"))
    )
    name = F.concat(gender, F.lit(":"), word)
    kind = F.col("type")
    # The first digits of a number say where it belongs: the country, or nothing.
    country = F.greatest(F.lit(0), F.least(F.lit(2), F.length(norm) - 7))
    phone = F.concat(F.substr(norm, F.lit(1), country), F.substr(alike, country + 1), grown(lambda i: (_byte(stream, i) % 10).cast("string")))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.when(norm.rlike(r"^10\."), private).otherwise(octets))
        .when(kind == "card", F.concat(card, check))
        .when(kind == "phone", phone)
        .when((kind == "secret") & norm.rlike("^[0-9a-f]+$"), hexadecimal)
        .when(kind == "name", name)
        .when(kind == "secret", F.concat(alike, grown(lambda i: _pick(CONSONANTS, _byte(stream, i)))))
        .otherwise(alike)
    )


def surrogates(forms: DataFrame, key: str) -> DataFrame:
    """(type, norm, surrogate): one surrogate per entity, no two alike, and none that is itself an entity here.

    Of names each word is an entity, so that a surname has one surrogate with a first name, an initial or neither, and
    one that differs in its ending only under a title of another gender (unless one of them had to be drawn again).
    Surrogates depend on the key and the entity alone but for collisions: of entities that draw the same one, the
    smallest keeps it and the others draw again, as do those that hit an entity of the corpus, until none is left.
    """
    drawn = lambda df: df.withColumn("stream", _stream(key, F.col("type"), F.when(F.col("type") == "name", F.substr("norm", F.lit(3))).otherwise(F.col("norm")), F.col("attempt").cast("string"))).withColumn("surrogate", _drawn(key)).drop("stream")
    every = staged(forms.select("type", F.explode("parts").alias("norm")).where("norm is not null").distinct(), "entities")
    done = staged(drawn(every.withColumn("attempt", F.lit(0))), "drawn")
    while True:
        first = done.groupBy("type", "surrogate").agg(F.min("norm").alias("holder"), F.count(F.lit(1)).alias("n"))
        taken = first.join(every.select("type", F.col("norm").alias("surrogate"), F.lit(True).alias("real")), ["type", "surrogate"], "left").where("n > 1 or real")
        clashes = done.join(taken, ["type", "surrogate"]).where("real or norm <> holder").select("type", "norm")
        clashes = staged(clashes, "clashes")
        if clashes.isEmpty():
            return done.select("type", "norm", "surrogate")
        again = drawn(done.join(clashes, ["type", "norm"], "left_semi").select("type", "norm", (F.col("attempt") + 1).alias("attempt")))
        done = staged(done.join(clashes, ["type", "norm"], "left_anti").unionByName(again), "drawn")


def _rendered(key: str) -> Column:
    """The surrogates ``drawn`` for a form's parts in the shape of the form: its separators, capitals and title."""
    body, drawn = F.col("body"), F.col("drawn")[0]
    filled = _mapped(
        body,
        lambda c, i: F.when(
            c.rlike("[0-9]"), F.substr(drawn, F.length(_digits(F.substr(body, F.lit(1), i + 1))), F.lit(1))
        ).otherwise(c),
    )
    cased = _mapped(drawn, lambda c, i: F.when(F.substr(body, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c))
    longer = F.substr(drawn, F.length(_digits(body)) + 1)
    turn = int.from_bytes(hashlib.sha256(f"{key}|initials".encode()).digest()[:4], "big")
    turned = lambda row: row[1 + turn % (len(row) - 1) :] + row[: 1 + turn % (len(row) - 1)]
    initial = lambda w: F.translate(w, "".join(INITIALS), "".join(map(turned, INITIALS)))

    def word(w: Column, new: Column) -> Column:
        bare = F.substr(new, F.lit(3))
        return F.when(new.isNull(), initial(w)).when(w == F.upper(w), F.upper(bare)).otherwise(F.initcap(bare))

    words = F.zip_with(F.split(body, NAME_BREAK), F.col("drawn"), word)
    breaks = F.concat(F.regexp_extract_all(body, F.lit(f"({NAME_BREAK})")), F.array(F.lit("")))
    name = F.array_join(F.zip_with(words, breaks, lambda a, b: F.concat(a, b)), "")
    kind = F.col("type")
    return F.concat(
        "lead",
        F.when(kind.isin("phone", "card", "ssn"), F.concat(filled, longer)).when(kind == "ip", drawn).when(kind == "name", name).otherwise(cased),
    )


def pseudonymised(documents: DataFrame, key: str) -> DataFrame:
    """``documents`` with entities in ``text`` replaced, and ``n_replaced`` added.

    Secrets, e-mail and IPv4 addresses, card numbers (valid check digit), phone and social security numbers, and
    names after a title get surrogates of their type, in their format; an entity gets the same one wherever
    it stands. Only texts with a candidate are shuffled. Null texts stay null, all rows and other columns stay as
    they are; texts without an entity stay byte for byte.
    """
    text = whole_text()
    # A column of this name that is already there is replaced, as withColumn does.
    rest = documents.drop("n_replaced")
    found = rest.where(has_candidate(text))
    clean = rest.where(~has_candidate(text)).withColumn("n_replaced", F.lit(0))
    hash_of = F.sha2(text, 256)
    entities = staged(
        found.select(hash_of.alias("text_hash"), F.posexplode(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).alias("pos", "form")).distinct(),
        "found",
    )
    forms = staged(typed(entities.select("form").distinct()), "forms")
    parts = forms.select("form", "type", "lead", "body", F.posexplode("parts").alias("place", "norm"))
    # Only forms of names have several parts, as many as the name has words.
    drawn = (
        parts.join(surrogates(forms, key), ["type", "norm"], "left")
        .groupBy("form", "type", "lead", "body")
        .agg(F.array_sort(F.collect_list(F.struct("place", "surrogate"))).getField("surrogate").alias("drawn"))
    )
    mapping = staged(drawn.select("form", _rendered(key).alias("by")), "mapping")
    own, by = free_name(rest, "text_hash"), free_name(rest, "replaced_by")
    replaced = (
        entities.join(mapping, "form", "left")
        .groupBy(F.col("text_hash").alias(own))
        .agg(
            F.array_sort(F.collect_list(F.struct("pos", F.coalesce("by", "form").alias("by")))).alias(by),
            F.count("by").cast("int").alias("n_replaced"),
        )
    )
    pieces = F.split(text, PATTERN, -1)
    joined = F.array_join(
        F.zip_with(pieces, F.concat(F.col(by)["by"], F.array(F.lit(""))), lambda a, b: F.concat(a, b)), ""
    )
    names = rest.columns
    changed = (
        found.withColumn(own, hash_of)
        .join(replaced, own)
        .withColumn("text", F.when(F.col("n_replaced") > 0, joined).otherwise(F.col("text")))
        .select(*names, "n_replaced")
    )
    return changed.unionByName(clean)
