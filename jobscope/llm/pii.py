"""Surrogates for personal data: keyed, type-consistent, distinct, and the same wherever an entity recurs.

One pattern finds emails, secrets after a keyword in any case, IPv4 addresses, card and account numbers
(whole or in their printed groups), phone numbers and titled names. Each entity is replaced character by character from a keyed digest: digits
by digits, letters by letters of the same case and script, punctuation and layout kept. What makes the
type is kept too: an email's top-level domain, a phone's country code, an IBAN's country, octets
below 256, and a card's check digit is valid exactly if it was. Names are made of syllables in their own
script, given names and Cyrillic family names with the gender of the title; a family name gets the same
surrogate with or without the given name. Numbers are drawn without their layout and then laid out as each
was written: one card, account or phone number printed with and without groups is one entity. Names are found after a
title only ("John Miller lives here" stays); emails are entities by their exact characters.

The distinct entities of the corpus form a table; surrogates that equal another's or any
real value are drawn again with the next attempt number until none does, so different entities stay
different; the space to draw from grows with the attempts, so it is never used up. Only entity keys and surrogates meet in joins; texts move only for rows with entities.

Defined results: null and empty texts stay as they are with 0 entities; repeated rows change alike; ids
may be null; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import discard, fresh, written

# Patterns, alphabets and syllables.
SECRET_HEAD = r"(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key|key)[\"']?\s{0,2}[=:]\s{0,2}[\"']?"
MALE = r"(?:Mr|Sir|Herr|Señor|Sr|Monsieur|Господин)"
FEMALE = r"(?:Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|Госпожа)"
# Letters and digits after country and check digits of an IBAN; printed in fours, these end where the country's number does.
IBAN_LENGTHS = {
    11: "NO", 12: "BE", 14: "DK|FI|FK|FO|GL|NL|SD", 15: "MK|SI", 16: "AT|BA|EE|KZ|LT|LU|MN|XK", 17: "CH|CR|HR|LI|LV",
    18: "BG|BH|DE|GB|GE|IE|ME|RS|VA", 19: "AE|GI|IL|IQ|OM|SO|TL", 20: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 21: "LY|PT|ST", 22: "IS|TR",
    23: "BI|DJ|FR|GR|IT|MC|MR|SM", 24: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 25: "BR|EG|PS|QA|UA", 26: "JO|KW|MU|YE", 27: "MT|SC",
    28: "LC", 29: "RU",
}
IBAN_IN_FOURS = "|".join(rf"(?:{c})\d{{2}}(?: [A-Z0-9]{{4}}){{{n // 4}}}" + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBAN_LENGTHS.items())
KINDS = {
    "email": r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "secret": SECRET_HEAD + r"[A-Za-z0-9_\-+/]{16,}",
    "iban": rf"(?<![A-Za-z0-9])(?:[A-Z]{{2}}\d{{2}}[A-Z0-9]{{11,30}}|{IBAN_IN_FOURS}"
            r"|[A-Z]{2}\d{2} [A-Z0-9]{4}(?: \d{4}){2,6}(?: \d{1,3})?)(?![A-Za-z0-9])",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3}|\d{4}[ \-]\d{6}[ \-]\d{5})(?!\d)",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "phone": r"\+\d{1,3}[ \-.]?(?:\(\d{1,4}\)[ \-.]?)?\d{2,4}(?:[ \-.]?\d{2,4}){1,3}(?!\d)|(?<!\d)(?:\(\d{3}\) ?|\d{3}[\-.])\d{3}[\-.]\d{4}(?!\d)",
    "name": rf"(?<!\p{{L}})(?:{MALE}|{FEMALE})\.? \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?",
}
# One character decides which kinds can start at a place, so most places cost one test each; an
# email starts only where its run of characters does (or the match before ended), not at each of them.
STARTS = {
    "email": r"(?=[A-Za-z0-9._%+\-])(?:(?<![A-Za-z0-9._%+\-])|\G)(?=[A-Za-z0-9._%+\-]++@)", "secret": "(?=[tspakTSPAK])", "iban": r"(?=[A-Z]{2}\d)",
    "card": r"(?=\d{4})", "ip": r"(?=\d)", "ssn": r"(?=\d{3}-)", "phone": r"(?=[+(\d])", "name": r"(?=[MSHFГ])",
}
PATTERNS = {k: f"(?:{STARTS[k]}(?:{p}))" for k, p in KINDS.items()}
ENTITY = "|".join(PATTERNS.values())
# Calling codes: two of one digit, the two-digit ones, and three digits for all others.
CALLING_CODE = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
LAID_OUT = ("card", "iban", "phone", "ssn")  # kinds whose layout is no part of the entity
LAYOUT = r"[ .()\-]"
GROW = 4  # attempts before a surrogate may leave the size of its value, and between further steps
ALPHABETS = (  # characters, and what replaces them
    ("[0-9]", "0123456789"), ("[a-zß-öø-ÿ]", "abcdefghijklmnopqrstuvwxyz"), ("[A-ZÀ-ÖØ-Þ]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("[а-яё]", "абвгдежзиклмнопрстуфхцчшэюя"), ("[А-ЯЁ]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    ("[α-ωά-ώ]", "αβγδεζηθικλμνξοπρστυφχψω"), ("[Α-Ω]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
)
HEADS = {"latin": "B C D F G H J K L M N P R S T V".split(), "cyrillic": "Б В Г Д Ж З К Л М Н П Р С Т Ф Х".split()}
BODIES = {"latin": "an el or im us ar en il ov un".split(), "cyrillic": "ан ел ор им ус ар ен ил ов ун".split()}
GIVEN = {"latin": ("bert dan rick ton mund".split(), "lina rita nelle sia dora".split()),
         "cyrillic": ("слав мир дан рий тин".split(), "лина рита нелла сия дора".split())}
FAMILY = {"latin": ("berg mann son well ford".split(),) * 2, "cyrillic": ("ов ин ский енко ев".split(), "ова ина ская енко ева".split())}


def _stream(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """Keyed hex digits, at least two for each character of ``value``."""
    message = F.concat_ws("\x1f", kind, value, attempt.cast("string"))
    inner = F.sha2(F.concat(F.lit(key + "\x1e"), message), 256)
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.length(value) / 64).cast("int")), lambda j: F.sha2(
        F.concat_ws("\x1f", F.lit(key), inner, j.cast("string")), 512)), "")


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(options, x: Column) -> Column:
    return F.get(F.array(*map(F.lit, options)), x % len(options))


def _letters(value: Column, stream: Column, keep: Column) -> Column:
    """``value`` with every character after the first ``keep`` ones replaced within its alphabet."""
    def one(c: Column, i: Column) -> Column:
        out = F.when(i < keep, c)
        for pattern, letters in ALPHABETS:
            out = out.when(c.rlike(pattern), F.substr(F.lit(letters), _byte(stream, i) % len(letters) + 1, F.lit(1)))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string's digits."""
    d = F.transform(F.split(F.reverse(F.regexp_replace(digits, "[^0-9]", "")), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(F.get(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int"))))
    return F.aggregate(d, F.lit(0), lambda s, x: s + x) % 10


def _octets(value: Column, stream: Column, step: Column) -> Column:
    def one(o: Column, i: Column) -> Column:
        x = _byte(stream, i * 2) * 256 + _byte(stream, i * 2 + 1)
        n = F.length(o) + step
        return F.when(step > 2, x % 256).when(n == 1, x % 9 + 1).when(n == 2, x % 90 + 10).otherwise(x % 156 + 100).cast("string")

    return F.array_join(F.transform(F.split(value, r"\."), one), ".")


def _name(kind: Column, value: Column, stream: Column, step: Column) -> Column:
    def build(script: str) -> Column:
        more = F.when(step > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(step, F.lit(1))), lambda j: F.concat(
            F.lower(_pick(HEADS[script], _byte(stream, j * 2 + 3))), _pick(BODIES[script], _byte(stream, j * 2 + 4)))), "")).otherwise("")
        ends = F.when(F.startswith(kind, F.lit("given")), F.when(F.endswith(kind, F.lit("_f")), _pick(GIVEN[script][1], _byte(stream, F.lit(4))))
                      .otherwise(_pick(GIVEN[script][0], _byte(stream, F.lit(4)))))
        ends = ends.otherwise(F.when(F.endswith(kind, F.lit("_f")), _pick(FAMILY[script][1], _byte(stream, F.lit(4))))
                              .otherwise(_pick(FAMILY[script][0], _byte(stream, F.lit(4)))))
        return F.concat(_pick(HEADS[script], _byte(stream, F.lit(0))), _pick(BODIES[script], _byte(stream, F.lit(1))),
                        F.lower(_pick(HEADS[script], _byte(stream, F.lit(2)))), _pick(BODIES[script], _byte(stream, F.lit(3))), more, ends)

    return F.when(value.rlike(r"\p{IsCyrillic}"), build("cyrillic")).otherwise(build("latin"))


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The replacement of an entity at an attempt.

    Every ``GROW`` attempts the space grows: names by a syllable, octets by a digit up to all of 0 to 255, emails
    and secrets by a letter, phone and social security numbers by a digit. Cards and IBANs have 10**12 and more.
    """
    stream = _stream(key, kind, value, attempt)
    step = F.least(F.floor(attempt / GROW).cast("int"), F.lit(25))
    hexes = F.sha2(F.concat(stream, F.lit("+")), 256)

    def more(letters: str) -> Column:
        return F.when(step > 0, F.substr(F.translate(hexes, "0123456789abcdef", letters), F.lit(1), step)).otherwise("")
    card = _letters(value, stream, F.lit(0))
    last = F.regexp_replace(card, "[0-9]$", "0")
    check = F.pmod(F.lit(10) - _luhn(last), F.lit(10))
    odd = F.pmod(check + 1 + _byte(stream, F.length(value) - 1) % 9, F.lit(10))
    fixed = F.concat(F.substr(last, F.lit(1), F.length(last) - 1), F.when(_luhn(value) == 0, check).otherwise(odd).cast("string"))
    tld = F.concat(F.lit("."), F.substring_index(value, ".", -1))
    mail = _letters(F.substr(value, F.lit(1), F.length(value) - F.length(tld)), stream, F.lit(0))
    email = F.when(step == 0, F.concat(mail, tld)).otherwise(F.concat(
        F.substring_index(mail, "@", 1), more("bcdfghjklmnpqrst"), F.lit("@"), F.substring_index(mail, "@", -1), tld))
    return (F.when(kind == "email", email).when(kind == "card", fixed).when(kind == "ip", _octets(value, stream, step))
            .when((kind == "secret") & value.rlike("^[0-9a-f]+$"), F.concat(F.substr(stream, F.lit(7), F.length(value)), more("0123456789abcdef")))
            .when((kind == "secret") & value.rlike("^[0-9A-F]+$"),
                  F.concat(F.upper(F.substr(stream, F.lit(7), F.length(value))), more("0123456789ABCDEF")))
            .when(kind == "secret", F.concat(_letters(value, stream, F.lit(0)), more("bcdfghjklmnpqrst")))
            .when(kind == "iban", _letters(value, stream, F.lit(2)))
            .when(kind == "phone", F.concat(_letters(value, stream, F.length(F.regexp_extract(value, CALLING_CODE, 0))), more("0123456789012345")))
            .when(kind == "ssn", F.concat(_letters(value, stream, F.lit(0)), more("0123456789012345")))
            .when(kind.rlike("^(given|family)"), _name(kind, value, stream, step))
            .otherwise(_letters(value, stream, F.lit(0))))


def _bare(kind: Column, value: Column) -> Column:
    """The entity itself: a number without its layout."""
    return F.when(kind.isin(*LAID_OUT), F.regexp_replace(value, LAYOUT, "")).otherwise(value)


def _laid_out(kind: Column, value: Column, bare: Column) -> Column:
    """The surrogate ``bare`` in the layout of ``value``; what it has grown by stands at the end."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("n"))
    return F.when(~kind.isin(*LAID_OUT), bare).otherwise(F.aggregate(F.split(value, ""), start, lambda a, c: F.when(
        c.rlike(LAYOUT), F.struct(F.concat(a["done"], c).alias("done"), a["n"].alias("n"))).otherwise(
        F.struct(F.concat(a["done"], F.substr(bare, a["n"] + 1, F.lit(1))).alias("done"), (a["n"] + 1).alias("n"))),
        lambda a: F.concat(a["done"], F.substr(bare, a["n"] + 1))))


def _part(kind: Column | str, value: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), value.alias("value"))


def _parts(m: Column) -> Column:
    """A match as literal and entity parts."""
    def is_(kind: str) -> Column:
        return m.rlike(f"^(?:{KINDS[kind]})$")

    head = F.regexp_extract(m, f"^{SECRET_HEAD}", 0)
    title = F.regexp_extract(m, rf"^(?:{MALE}|{FEMALE})\.? ", 0)
    sex = F.when(title.rlike(f"^{FEMALE}"), F.lit("f")).otherwise(F.lit("m"))
    rest = F.split(F.substr(m, F.length(title) + 1), " ")
    family = _part(F.concat(F.lit("family_"), F.when(F.get(rest, F.size(rest) - 1).rlike(r"\p{IsCyrillic}"), sex).otherwise("any")),
                   F.get(rest, F.size(rest) - 1))
    named = F.when(F.size(rest) == 2, F.array(_part("", title), _part(F.concat(F.lit("given_"), sex), F.get(rest, F.lit(0))),
                                              _part("", F.lit(" ")), family)).otherwise(F.array(_part("", title), family))
    out = F.when(m.contains("@") & is_("email"), F.array(_part("email", m)))
    out = out.when(head != "", F.array(_part("", head), _part("secret", F.substr(m, F.length(head) + 1)))).when(title != "", named)
    for kind in ("iban", "card", "ip", "ssn"):
        out = out.when(is_(kind), F.array(_part(kind, m)))
    return out.otherwise(F.array(_part("phone", m)))


def _has_entity(t: Column) -> Column:
    """Whether ``ENTITY`` is found in a text: kind by kind, each behind a cheap test that it implies."""
    def any_of(words: list[str], t: Column = t) -> Column:
        return reduce(or_, (F.contains(t, F.lit(w)) for w in words))

    numbers = "(?=[+(\\d])(?:" + "|".join(PATTERNS[k] for k in ("card", "ip", "ssn", "phone")) + ")"
    titles = [w for p in (MALE, FEMALE) for w in p[len("(?:"):-1].split("|")]
    return F.coalesce((any_of(["@"]) & t.rlike(PATTERNS["email"]))
                      | (any_of(["token", "secret", "passw", "key"], F.lower(t)) & t.rlike(PATTERNS["secret"]))
                      | t.rlike(numbers) | t.rlike(PATTERNS["iban"])
                      | (any_of(titles) & t.rlike(PATTERNS["name"])), F.lit(False))


def _distinct_surrogates(entities: DataFrame, key: str, rounds: int) -> DataFrame:
    """(kind, value, surrogate) with no surrogate given twice or equal to a real value of its type."""
    def drawn(rows: DataFrame) -> DataFrame:
        return written(rows.select("kind", "value", "attempt", surrogate(key, F.col("kind"), F.col("value"), F.col("attempt")).alias("surrogate")),
                       "surrogates")

    rows = drawn(entities.select("kind", "value", F.lit(0).alias("attempt")))
    real = rows.select(F.col("value").alias("surrogate"), F.lit(True).alias("real")).distinct()
    for _ in range(rounds):
        first = rows.groupBy("surrogate").agg(F.min(F.struct("kind", "value")).alias("owner"), F.count("*").alias("n"))
        clash = rows.join(first, "surrogate").join(real, "surrogate", "left").where(
            F.col("real").isNotNull() | ((F.col("n") > 1) & (F.col("owner") != F.struct("kind", "value"))))
        clash = written(clash.select("kind", "value", (F.col("attempt") + 1).alias("attempt")), "clashes")
        if clash.isEmpty():
            return rows.select("kind", "value", "surrogate")
        rows = written(rows.join(clash.select("kind", "value"), ["kind", "value"], "left_anti").unionByName(drawn(clash)), "surrogates")
    raise RuntimeError(f"surrogates still collide after {rounds} rounds")


def replace_entities(docs: DataFrame, key: str, text: str = "text", count: str = "n_entities", rounds: int = 50) -> DataFrame:
    """``docs`` with surrogates in ``text`` and the number of replaced entities."""
    tid, seq, new, count = (fresh(docs, c) for c in ("pii_row", "pii_parts", "pii_surrogates", count))
    t = F.col(text)
    hit = _has_entity(t)
    clean = docs.where(~hit).withColumn(count, F.lit(0).cast("long"))
    gaps, found = F.split(t, ENTITY, -1), F.regexp_extract_all(t, F.lit(ENTITY), F.lit(0))
    parts = F.flatten(F.zip_with(gaps, found, lambda g, m: F.concat(
        F.array(_part("", g)), F.when(m.isNotNull(), _parts(m)).otherwise(F.array().cast("array<struct<kind:string,value:string>>")))))
    # the parts hold the text, so the long search runs once and the text itself need not be written
    dirty = written(docs.where(hit).select(*(c for c in docs.columns if c != text), F.xxhash64(t).alias(tid), parts.alias(seq)), "parts")
    places = dirty.select(F.col(tid).alias("tid"), F.posexplode(F.filter(seq, lambda p: p["kind"] != "")).alias("at", "p")).select(
        "tid", "at", "p.kind", "p.value")
    places = written(places.groupBy("tid", "at").agg(F.first("kind").alias("kind"), F.first("value").alias("as_written")).withColumn(
        "value", _bare(F.col("kind"), F.col("as_written"))), "entities")
    given = _distinct_surrogates(places.select("kind", "value").distinct(), key, rounds)
    made = _laid_out(F.col("kind"), F.col("as_written"), F.col("surrogate")).alias("surrogate")
    new_of = places.join(given, ["kind", "value"]).select("tid", "at", made).groupBy("tid").agg(
        F.array_sort(F.collect_list(F.struct("at", "surrogate"))).alias("s"))
    rows = dirty.join(new_of.select(F.col("tid").alias(tid), F.col("s.surrogate").alias(new)), tid)
    # literals with the surrogates between them: every entity part is met in order
    numbered = F.filter(F.transform(F.col(seq), lambda p, i: F.when(p["kind"] != "", i)), lambda i: i.isNotNull())
    slot = F.arrays_zip(numbered.alias("i"), F.col(new).alias("s"))
    merged = F.array_sort(F.concat(
        F.transform(slot, lambda x: F.struct(x["i"].alias("i"), x["s"].alias("v"))),
        F.filter(F.transform(F.col(seq), lambda p, i: F.when(p["kind"] == "", F.struct(i.alias("i"), p["value"].alias("v")))),
                 lambda x: x.isNotNull())))
    out = F.array_join(F.transform(merged, lambda x: x["v"]), "")
    rows = rows.select(*((out if c == text else F.col(c)).alias(c) for c in docs.columns), F.size(new).cast("long").alias(count))
    return clean.unionByName(rows)
