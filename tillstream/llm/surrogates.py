"""Personal data in texts replaced by keyed surrogates of the same type and format.

1. One pattern finds entities; the branch that matches gives the type. A name needs a form of address
   in front and is taken apart into given names and a family name.
2. Entities are reduced to what makes two mentions the same (case and separators aside). Each distinct
   one gets a surrogate from a keyed hash: digits become digits, letters become letters of the same
   script and case, separators stay; addresses stay addresses, card numbers keep a valid check digit,
   given names keep the gender that the form of address tells.
3. Surrogates that equal another entity's surrogate, or any entity that was found, are drawn again
   until none does. Names get a syllable more every second draw and mail addresses a letter more every
   fourth, so that there are enough for any number of entities. So different entities stay different, and one entity has the same surrogate in
   all texts.
4. The mentions are put back in the layout of the original.

Everything here is DataFrame functions; texts without entities pass through unchanged.

Defined results: null texts stay null, empty ones empty; repeated rows get the same text; names in a
script without a table get letters of the Latin one; a type of fixed format, made of digits or letters one
for one, raises where its possible values are used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.session import stage

# Forms of address by the gender they tell, in the languages covered.
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "госпожа", "Κυρία"]
MALE = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "господин", "Κύριος"]
NEUTRAL = ["Dr", "Prof"]
# Syllables for names by script, and endings by script and gender.
SYLLABLES = {
    "latin": ["ba", "den", "fi", "gor", "hal", "jo", "kem", "li", "mar", "nor", "pel", "ra", "sol", "tam", "ver", "wi"],
    "cyrillic": ["ба", "вер", "гор", "да", "жи", "зен", "ко", "лим", "мар", "нов", "пе", "ри", "сол", "та", "фе", "ял"],
    "greek": ["βα", "γορ", "δε", "ζη", "θεο", "κα", "λι", "μαρ", "νι", "πε", "ρα", "σο", "τι", "φαν", "χρυ", "ψι"],
}
ENDINGS = {
    "latin": {"female": "a", "male": "o", "neutral": "en", "family": "sen"},
    "cyrillic": {"female": "а", "male": "ий", "neutral": "ян", "family": "енко"},
    "greek": {"female": "α", "male": "ος", "neutral": "ι", "family": "ίδη"},
}
_RANGES = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}
_LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя",
            "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_BYTE = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_PART = r"\p{Lu}[\p{L}'’-]+"
#: Type and pattern of each kind of entity, in the order in which they are tried at a place.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)*\.?(?<=\.\p{L}{2,24})",
    "secret": r"(?<![\p{L}\p{N}])(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"'][^\"'\s]{6,}[\"']",
    "hex": r"(?<![\p{L}\p{N}])(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{32,}(?![\p{L}\p{N}])",
    "mac": r"(?<![\p{L}\p{N}:])(?:[0-9a-fA-F]{2}[:-]){5}[0-9a-fA-F]{2}(?![\p{L}\p{N}])",
    "ipv6": r"(?<![\p{L}\p{N}:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\p{L}\p{N}:])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ipv4": rf"(?<![\d.])(?:{_BYTE}\.){{3}}{_BYTE}(?!\d|\.\d)",
    "phone": r"(?<![\p{L}\p{N}])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
             r"|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "number": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(FEMALE + MALE + NEUTRAL)})\.?[  ]{_PART}(?:[  ]{_PART}){{0,2}}",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
_SECRET_HEAD = r"^[^=:]*[=:]\s*[\"']"
_TITLE = rf"^(?:{'|'.join(FEMALE + MALE + NEUTRAL)})\.?[  ]"
MOST_DRAWS = 64


def _kind(mention: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS.items()):
        kind = F.when(mention.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def _gender(mention: Column) -> Column:
    return (F.when(mention.rlike(rf"^(?:{'|'.join(FEMALE)})\.?[  ]"), "female")
            .when(mention.rlike(rf"^(?:{'|'.join(MALE)})\.?[  ]"), "male").otherwise("neutral"))


def _script(text: Column) -> Column:
    kind = F.lit("latin")
    for name, letters in _RANGES.items():
        kind = F.when(text.rlike(letters), name).otherwise(kind)
    return kind


def _stream(key: str, *what: Column) -> Column:
    """64 hexadecimal digits that only the key's owner can foretell."""
    inner = F.sha2(F.concat_ws("\x1f", F.lit(key), *what), 256)
    return F.sha2(F.concat(F.lit(key), inner), 256)


def _number(stream: Column, place: Column | int, digits: int = 4) -> Column:
    """A number from `digits` hexadecimal digits of the stream, from a place counted from 0."""
    start = F.lit(place) if isinstance(place, int) else place
    return F.conv(F.substring(stream, start + 1, F.lit(digits)), 16, 10).cast("int")


def _letter(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))


def _characters(value: Column, key: str, kind: Column, draw: Column) -> Column:
    """Each digit and letter of a value replaced by one of its sort; a block of 16 shares one hash."""
    size = F.char_length(value)

    def block(b):
        stream = _stream(key, kind, draw.cast("string"), value, b.cast("string"))

        def one(i):
            c = F.substring(value, b * 16 + i + 1, F.lit(1))
            n = _number(stream, i * 4)
            found = F.when(c.rlike(r"\p{L}"), _letter(_LETTERS["latin"], n)).otherwise(c)
            for name, letters in _RANGES.items():
                found = F.when(c.rlike(letters), _letter(_LETTERS[name], n)).otherwise(found)
            found = F.when(kind.isin("hex", "mac", "ipv6") & c.rlike("[a-f]"), _letter("abcdef", n)).otherwise(found)
            found = F.when(c == F.lower(c), found).otherwise(F.upper(found))
            return F.when(c.rlike("[0-9]"), _letter("0123456789", n)).otherwise(found)

        return F.array_join(F.transform(F.sequence(F.lit(0), F.least(F.lit(15), size - b * 16 - 1)), one), "")

    blocks = F.sequence(F.lit(0), F.greatest(F.floor((size - 1) / 16).cast("int"), F.lit(0)))
    return F.when(size > 0, F.array_join(F.transform(blocks, block), "")).otherwise(value)


def _address(value: Column, stream: Column) -> Column:
    """Four numbers from 1 to 254."""
    return F.concat_ws(".", *[(_number(stream, 8 * i) % 254 + 1).cast("string") for i in range(4)])


def _luhn_sum(digits: Column, doubled_from_end: int) -> Column:
    """The check sum of a number whose every second digit, from that place on, counts doubled."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        (i + doubled_from_end) % 2 == 1,
        F.when(d.cast("int") >= 5, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)).otherwise(d.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d)


def _checked(value: Column, drawn: Column) -> Column:
    """`drawn` with the last digit set so that it passes the card check where `value` does."""
    body = F.substring(drawn, F.lit(1), F.char_length(drawn) - 1)
    digit = (10 - _luhn_sum(body, 1) % 10) % 10
    return F.when(_luhn_sum(value, 0) % 10 == 0, F.concat(body, digit.cast("string"))).otherwise(drawn)


def _name(kind: Column, script: Column, stream: Column, draw: Column) -> Column:
    """Three syllables of the script, one more every second draw, and the ending of the gender."""
    syllables = F.sequence(F.lit(0), (2 + F.floor(draw / 2)).cast("int"))

    def made(name: str) -> Column:
        table = F.array(*map(F.lit, SYLLABLES[name]))
        role = F.substring_index(kind, ":", -1)
        ending = F.lit("")
        for gender, text in ENDINGS[name].items():
            ending = F.when(role == gender, text).otherwise(ending)
        # One digit of the stream for each syllable; 64 draws need 34.
        drawn = F.transform(syllables, lambda i: F.element_at(
            table, _number(stream, F.when(i < 3, i * 8 + 3).otherwise(i + 21), 1) + 1))
        return F.concat(F.array_join(drawn, ""), ending)

    return F.when(script == "cyrillic", made("cyrillic")).when(script == "greek", made("greek")).otherwise(made("latin"))


def _drawn(key: str) -> Column:
    """The surrogate of (kind, value) at a draw, in the reduced form of its kind."""
    kind, value, draw = F.col("kind"), F.col("value"), F.col("draw")
    stream = _stream(key, kind, draw.cast("string"), value)
    plain = _characters(value, key, kind, draw)
    top = F.substring_index(value, ".", -1)
    more = F.array_join(F.transform(
        F.slice(F.sequence(F.lit(0), F.lit(MOST_DRAWS // 4)), F.lit(1), F.floor(draw / 4).cast("int")),
        lambda i: _letter(_LETTERS["latin"], _number(stream, i * 4))), "")
    return (
        F.when(kind == "ipv4", _address(value, stream))
        # The last label of a mail address, the country of an account and of a phone stay.
        .when(kind == "email", F.concat(more, F.substring(plain, F.lit(1), F.char_length(value) - F.char_length(top)), top))
        .when(kind == "iban", F.concat(F.substring(value, 1, 2), F.substring(plain, F.lit(3), F.char_length(value))))
        .when(kind == "number", _checked(value, plain))
        .when(kind.startswith("name:"), _name(kind, _script(value), stream, draw))
        .otherwise(plain)
    )


def _parts(mention: Column, kind: Column) -> Column:
    """The values that a mention is made of, as (kind, value): one, or one for each part of a name."""
    bare = F.regexp_replace(mention, r"[ ().\-]", "")
    inner = F.regexp_replace(F.regexp_replace(mention, _SECRET_HEAD, ""), r"[\"']$", "")
    is_hex = (kind == "secret") & inner.rlike("^[0-9a-fA-F]+$")
    value = (
        F.when(is_hex, F.lower(inner)).when(kind == "secret", inner)
        .when(kind.isin("email", "hex", "mac", "ipv6"), F.lower(mention))
        .when(kind.isin("number", "ssn", "iban", "phone"), bare).otherwise(mention)
    )
    names = F.split(F.regexp_replace(mention, _TITLE, ""), "[  ]")
    each = F.transform(names, lambda n, i: F.struct(
        F.concat(F.lit("name:"), F.when(i == F.size(names) - 1, "family").otherwise(_gender(mention))).alias("kind"),
        F.lower(n).alias("value")))
    one = F.struct(F.when(is_hex, "hex").otherwise(kind).alias("kind"), value.alias("value"))
    return F.when(kind == "name", each).otherwise(F.array(one))


def _laid_out(mention: Column, kind: Column, made: Column) -> Column:
    """Surrogates in the layout of the mention: its separators, its case, its country code."""
    first = F.get(made, 0)
    # A mail address that was drawn often is longer than its mention.
    longer = F.when(kind == "email", F.greatest(F.char_length(first) - F.char_length(mention), F.lit(0))).otherwise(0)
    head = F.substring(first, F.lit(1), longer)
    head = F.when(mention == F.lower(mention), head).when(mention == F.upper(mention), F.upper(head)).otherwise(head)
    first = F.when(longer > 0, F.substring(first, longer + 1, F.char_length(mention))).otherwise(first)

    def spread(pattern: str) -> Column:
        """The characters of the surrogate at the places of the mention that match."""
        def step(state, c):
            here = c.rlike(pattern)
            put = F.substring(first, state["at"] + 1, F.lit(1))
            put = F.when(c == F.lower(c), F.lower(put)).otherwise(F.upper(put))
            return F.struct((state["at"] + here.cast("int")).alias("at"),
                            F.concat(state["out"], F.when(here, put).otherwise(c)).alias("out"))

        return F.aggregate(F.split(mention, ""), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)["out"]

    title = F.regexp_extract(mention, _TITLE, 0)
    names = F.split(F.regexp_replace(mention, _TITLE, ""), "[  ]")
    cased = F.transform(names, lambda n, i: F.when(n == F.upper(n), F.upper(F.get(made, i))).otherwise(F.initcap(F.get(made, i))))
    code = F.regexp_extract(mention, r"^\+\d{1,3}(?=[ .(-])", 0)
    separated = spread(r"[\p{L}\p{N}+]")
    body = F.regexp_replace(mention, _SECRET_HEAD, "")
    secret = F.when((body == F.upper(body)) & body.rlike("^[0-9A-F]+.$"), F.upper(first)).otherwise(first)
    return (
        F.when(kind == "name", F.concat(title, F.array_join(cased, " ")))
        .when(kind == "secret", F.concat(F.regexp_extract(mention, _SECRET_HEAD, 0), secret, F.substring(mention, -1, 1)))
        .when(kind == "ipv4", first)
        .when(kind == "email", F.concat(head, spread(r".")))
        .when(kind == "phone", F.concat(code, F.substring(separated, F.char_length(code) + 1, F.char_length(mention))))
        .when(kind.isin("hex", "mac", "ipv6"), spread(r"."))
        .otherwise(separated)
    )


def surrogates(values: DataFrame, key: str) -> DataFrame:
    """`values` (distinct kind, value) with `surrogate`, distinct within a kind and equal to no value of it.

    Rounds: whoever collides, but for the least value of those that collide with each other, draws
    again. Who is settled stays so.
    """
    settled = stage(values.withColumn("draw", F.lit(0)).withColumn("surrogate", _drawn(key)), "draws")
    family = F.when(F.col("kind").startswith("name:"), "name").otherwise(F.col("kind"))
    real = settled.select(family.alias("family"), F.col("value").alias("surrogate")).distinct()
    for draw in range(1, MOST_DRAWS):
        # An earlier draw has the right of way, then the lesser kind and value.
        rank = F.struct(F.col("draw"), F.col("kind"), F.col("value"))
        held = settled.withColumn("family", family)
        owners = held.groupBy("family", "surrogate").agg(F.min(rank).alias("owner"))
        again = held.join(owners, ["family", "surrogate"]).where(rank != F.col("owner")).select("kind", "value").union(
            held.join(real, ["family", "surrogate"], "left_semi").select("kind", "value")).distinct()
        again = stage(again, "collisions")
        if again.isEmpty():
            return settled.select("kind", "value", "surrogate")
        redrawn = again.withColumn("draw", F.lit(draw)).withColumn("surrogate", _drawn(key))
        settled = stage(settled.join(again, ["kind", "value"], "left_anti").unionByName(redrawn), "draws")
    raise ValueError(f"collisions remain after {MOST_DRAWS} draws: too few possible values for a type")


def pseudonymised(docs: DataFrame, key: str, text: str = "text", doc_id: str = "doc_id",
                  count: str | None = "n_replaced") -> DataFrame:
    """`docs` with `text` rewritten, and a column `count` with the number of mentions in it (None: no such column).

    A column of `docs` that has this name is replaced; an empty table gives an empty one.
    """
    place = [F.coalesce(doc_id, F.lit(0)).alias("__row"), F.xxhash64(text).alias("__hash")]
    mentions = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    found = stage(
        docs.select(*place, F.explode(F.array_distinct(mentions)).alias("mention")).distinct()
        .withColumn("kind", _kind(F.col("mention"))).where("kind IS NOT NULL")
        .withColumn("parts", _parts(F.col("mention"), F.col("kind"))),
        "mentions")
    mention_parts = found.select("mention", "kind", "parts").distinct()
    values = mention_parts.select(F.explode("parts").alias("p")).select("p.kind", "p.value").distinct()
    made = surrogates(values, key).withColumnsRenamed({"kind": "part_kind", "value": "part_value"})
    each = mention_parts.select("mention", "kind", F.posexplode("parts").alias("at", "p"))
    laid = each.join(made, (F.col("p.kind") == F.col("part_kind")) & (F.col("p.value") == F.col("part_value"))) \
        .groupBy("mention", "kind").agg(F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("s")) \
        .select("mention", _laid_out(F.col("mention"), F.col("kind"), F.col("s.surrogate")).alias("put"))
    # A map per document; it holds no more than the document itself.
    maps = found.select("__row", "__hash", "mention").join(stage(laid, "laid-out"), "mention").groupBy("__row", "__hash").agg(
        F.map_from_entries(F.collect_list(F.struct("mention", "put"))).alias("__map"))
    joined = docs.withColumn("__row", place[0]).withColumn("__hash", place[1]).join(maps, ["__row", "__hash"], "left")
    between = F.split(text, PATTERN)
    parts = F.arrays_zip(between.alias("before"), mentions.alias("mention"))
    filled = F.transform(parts, lambda p: F.concat(p["before"], F.coalesce(
        F.try_element_at(F.col("__map"), p["mention"]), p["mention"], F.lit(""))))
    has = F.col("__map").isNotNull()
    return joined.select(
        *[F.when(has, F.array_join(filled, "")).otherwise(F.col(c)).alias(c) if c.lower() == text.lower() else F.col(c)
          for c in docs.columns if count is None or c.lower() != count.lower()],
        *([] if count is None else [F.when(has, F.size(mentions)).otherwise(0).cast("long").alias(count)]))
