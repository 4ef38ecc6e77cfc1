"""Personal data gives way to surrogates of the same type and format, with DataFrame and SQL functions only.

Found are mail addresses, secrets after words like token or password, access keys and long hex strings, IBANs, IP addresses,
card and social security numbers, phone numbers, and names after a title. A surrogate follows from a keyed hash of the entity:

- numbers keep their separators, length and country code, cards their first digit and, if it was right, a right check digit;
- secrets, IBANs and the local part of addresses keep the class of every character, addresses get a reserved domain;
- given names keep the gender of the titles they stand after in the corpus, and names their script; titles and particles stay;
- initials of the Latin alphabet are shifted by the key.

A name after a title has up to four parts, with hyphens, apostrophes, initials and particles (`Mr. Jean-Luc O'Neil`, `Frau A. von
Weber`); the last one is the surname. Its given names and surname are replaced wherever else they stand as whole words in the
same document. Equal entities have equal surrogates in all documents, also where one is written in two ways (separators, a country code, the
case of an address, a surname with and without given name). Different entities of a kind have different surrogates, none of
which is itself an entity of the corpus: colliding candidates are drawn again, the smallest entity keeping its draw. Where the
draws of a short format are used up, the surrogate is made longer, and an IP address takes the long form. The distinct entities are one table, checked by grouping and anti-joins; nothing is gathered per document but its own entities.

Only documents with entities are shuffled. Null and empty texts and documents without entities stay as they are; further
columns are kept. n_chars, where there is one, follows the text. Repeated rows get the same text.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KEY = "a key of one's own"
ATTEMPTS = 64
# Draws after which also formats of fixed length are widened.
FIXED = 8

_TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Госпожа"], "m": ["Mr", "Herr", "Monsieur", "Señor", "Господин"]}
_ANY = ["Dr", "Prof"]
# Between the parts of a name, left as they are.
_PARTICLES = "van von der den de del di da du la le ter bin".split()
_GIVEN = {
    "f latin": ["Anna", "Clara", "Elena", "Ida", "Julia", "Laura", "Maria", "Nina", "Olivia", "Sofia", "Thea", "Vera"],
    "m latin": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Leon", "Martin", "Oscar", "Paul", "Simon"],
    "a latin": ["Alex", "Andrea", "Charlie", "Dominique", "Jamie", "Kim", "Lou", "Morgan", "Robin", "Sam", "Sascha", "Toni"],
    "f cyrillic": ["Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья"],
    "m cyrillic": ["Андрей", "Борис", "Виктор", "Иван", "Олег", "Павел", "Роман", "Сергей"],
    "a cyrillic": ["Валя", "Женя", "Саша", "Слава"],
    "f greek": ["Άννα", "Ελένη", "Ιωάννα", "Μαρία", "Σοφία", "Χριστίνα"],
    "m greek": ["Ανδρέας", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"],
    "a greek": ["Άλεξ", "Ντένη", "Πάτι"],
}
_SYLLABLES = {
    "latin": "ba den el fer gar hol in kor lan mer nor os pel ran sten tor ul ver win zen".split(),
    "cyrillic": "ба вер гор дан зар ков лен мир нов ран сол тур".split(),
    "greek": "βα γορ δαν ζαρ κον λεν μιρ νορ ραν σολ τορ".split(),
}
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}[\p{L}\p{M}]+(?:-[\p{L}\p{M}]+|['\x{2019}]\p{Lu}[\p{L}\p{M}]+)*"
_NAME = rf"(?:\p{{Lu}}['\x{{2019}}]{_NAME}|{_NAME})"
_PART = rf"(?:{_NAME}|\p{{Lu}}\.)"
_BETWEEN = rf"[ \x{{A0}}](?:(?:{'|'.join(_PARTICLES)})[ \x{{A0}}]){{0,2}}"
_PATTERNS = [
    r"(?<![\w.+%-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.?(?<=\.[A-Za-z]{2,24})",
    r"(?<=(?i:token|secret|api_key|apikey|password|passwd|pwd)[\x22']?\s{0,3}[=:]\s{0,3}[\x22']?)(?=[+/_.-]*+[A-Za-z0-9])[A-Za-z0-9+/_.-]{8,}",
    r"(?<!\w)(?:AKIA[0-9A-Z]{16}|sk-[A-Za-z0-9]{20,}|gh[pousr]_[A-Za-z0-9]{20,}|(?=[a-f]*\d)[0-9a-f]{32,128})(?!\w)",
    r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])",
    rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    r"(?<![\w.])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7})(?!\w)",
    r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    r"(?<![\w+.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?!\w)",
    r"(?<![\w+.])\+\d{8,15}(?!\w)",
    rf"(?<!\w)(?:{'|'.join([*_TITLES['f'], *_TITLES['m'], *_ANY])})\.?(?:{_BETWEEN}{_PART}){{0,3}}{_BETWEEN}{_NAME}",
]
ENTITY = "|".join(f"(?:{p})" for p in _PATTERNS)


def _holds(text: Column) -> Column:
    """Whether a text has an entity. What every pattern needs is looked for first, since that is far cheaper."""
    needed = text.rlike("[0-9@=:_]")
    for part in ["sk-", "AKIA", *_TITLES["f"], *_TITLES["m"], *_ANY]:
        needed = needed | text.contains(part)
    return F.coalesce(needed & text.rlike(ENTITY), F.lit(False))


def _kind(raw: Column) -> Column:
    titles = "|".join([*_TITLES["f"], *_TITLES["m"], *_ANY])
    return (
        F.when(raw.contains("@"), "mail")
        .when(raw.rlike(rf"^(?:{titles})\.?[ \x{{A0}}]"), "name")
        .when(raw.rlike(r"^(?:[0-9A-Fa-f]{1,4}:){7}"), "ip6")
        .when(raw.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip")
        .when(raw.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(raw.rlike(r"^[A-Z]{2}\d{2}[ A-Z0-9]{11,}$"), "iban")
        .when(raw.rlike(r"^\d{13,19}$|^\d{4}[ -]\d{4}[ -]\d{4}[ -]"), "card")
        .when(raw.rlike(r"^[+(\d][\d ().+-]*$") & raw.rlike(r"(?:\d\D*){7}"), "phone")
        .otherwise("secret")
    )


def _words() -> str:
    """The words of a raw name after its title."""
    return "filter(split(substring(regexp_replace(raw, '^[^ \\u00A0]+', ''), 2), '[ \\u00A0]'), w -> w <> '')"


def _parts() -> Column:
    """kind, norm and gender of what a raw entity names: one part, or the given names and the surname."""
    words = _words()
    script = "CASE WHEN raw rlike '\\\\p{IsCyrillic}' THEN 'cyrillic' WHEN raw rlike '\\\\p{IsGreek}' THEN 'greek' ELSE 'latin' END"
    title = "regexp_replace(split(raw, '[ \\u00A0]')[0], '[.]', '')"
    women, men = (", ".join(f"'{t}'" for t in _TITLES[g]) for g in ("f", "m"))
    gender = f"CASE WHEN {title} IN ({women}) THEN 'f' WHEN {title} IN ({men}) THEN 'm' ELSE 'a' END"
    kept = ", ".join(f"'{p}'" for p in _PARTICLES)
    no_gender = "cast(NULL AS string) AS gender"
    return F.expr(
        f"""CASE kind
        WHEN 'name' THEN transform({words}, (w, i) -> struct(
            CASE WHEN w rlike '^.[.]$' THEN 'initial' WHEN w IN ({kept}) THEN 'particle'
                WHEN i < size({words}) - 1 THEN concat('given ', {script}) ELSE concat('surname ', {script}) END AS kind,
            if(w rlike '^.[.]$', w, lower(w)) AS norm, {gender} AS gender))
        WHEN 'phone' THEN array(struct(kind AS kind, regexp_replace(regexp_replace(raw, '^[+][0-9]{{1,3}}(?=[ (.-])', ''),
            '[^0-9]', '') AS norm, {no_gender}))
        WHEN 'mail' THEN array(struct(kind AS kind, lower(raw) AS norm, {no_gender}))
        WHEN 'ip6' THEN array(struct(kind AS kind, lower(raw) AS norm, {no_gender}))
        WHEN 'iban' THEN array(struct(kind AS kind, replace(raw, ' ', '') AS norm, {no_gender}))
        WHEN 'card' THEN array(struct(kind AS kind, regexp_replace(raw, '[^0-9]', '') AS norm, {no_gender}))
        WHEN 'ssn' THEN array(struct(kind AS kind, regexp_replace(raw, '[^0-9]', '') AS norm, {no_gender}))
        ELSE array(struct(kind AS kind, raw AS norm, {no_gender})) END"""
    )


def _entities(raws: DataFrame) -> DataFrame:
    """kind, norm and drawn, the kind with the gender that the titles before a given name agree on; distinct by kind and norm."""
    parts = raws.select(F.explode("parts").alias("p")).select("p.*").where("kind NOT IN ('initial', 'particle')")
    told = parts.groupBy("kind", "norm").agg(
        F.max(F.col("gender") == "f").alias("f"), F.max(F.col("gender") == "m").alias("m")
    )
    gender = F.when(F.col("f") & ~F.col("m"), "f").when(F.col("m") & ~F.col("f"), "m").otherwise("a")
    drawn = F.when(F.col("kind").startswith("given "), F.concat(F.lit("given "), gender, F.substring("kind", 6, 99)))
    return told.select("kind", "norm", F.coalesce(drawn, F.col("kind")).alias("drawn"))


def _luhn(digits: str) -> str:
    """The check sum of a string of digits, its last one included."""
    each = f"cast(substring({digits}, length({digits}) - i, 1) AS int) * (1 + i % 2)"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (s, i) -> s + {each} - if({each} > 9, 9, 0)) % 10"


def _candidate(key: str, attempt: int) -> Column:
    """The surrogate that the attempt's hash of kind and norm gives."""
    safe = key.replace("\\", "\\\\").replace("'", "\\'")
    stream = (
        f"array_join(transform(sequence(0, (length(norm) + {attempt}) div 32 + 1), j -> "
        f"sha2(concat_ws('|', '{safe}', kind, norm, '{attempt}', j), 256)), '')"
    )
    byte = "cast(conv(substring({h}, 2 * ({i}) - 1, 2), 16, 10) AS int)".format
    letter = "substring('abcdefghijklmnopqrstuvwxyz', {b} % 26 + 1, 1)".format

    def shape(text: str) -> str:
        b, c = byte(h="h", i="i"), f"substring({text}, i, 1)"
        return (
            f"array_join(transform(sequence(1, length({text})), i -> CASE WHEN {c} rlike '[0-9]' THEN cast({b} % 10 AS string) "
            f"WHEN {c} rlike '[a-z]' THEN {letter(b=b)} WHEN {c} rlike '[A-Z]' THEN upper({letter(b=b)}) ELSE {c} END), '')"
        )

    def pick(values: list[str], i: int) -> str:
        listed = ", ".join(f"'{v}'" for v in values)
        return f"array({listed})[{byte(h='h', i=i)} % {len(values)}]"

    b = [byte(h="h", i=i) for i in range(1, 9)]
    # So do, after some more, formats of fixed length.
    wide = attempt if attempt >= FIXED else 0
    size = f"(length(norm) + {wide})"
    digits = f"array_join(transform(sequence(1, {size}), i -> {byte(h='h', i='i')} % 10), '')"
    b_i = byte(h="h", i="i")
    # Where a dialled number has no 0 or 1, as at the start of an area code, neither has its surrogate.
    dial = f"array_join(transform(sequence(1, {size}), i -> if(substring(norm, i, 1) >= '2', 2 + {b_i} % 8, {b_i} % 10)), '')"
    hexes = "array_join(transform(sequence(1, length(norm)), i -> if(substring(norm, i, 1) = ':', ':', substring(h, i, 1))), '')"
    # From the third draw on, short spaces are widened.
    longer = f"substring(translate(h, 'abcdef', '024689'), 20, {attempt})" if attempt > 1 else "''"
    more = max(0, attempt - 1)
    given = "CASE kind " + " ".join(f"WHEN 'given {k}' THEN {pick(v, 1)}" for k, v in _GIVEN.items()) + " END"
    script = {s: [pick(v, 2 + i) for i in range(3 + more)] for s, v in _SYLLABLES.items()}
    name = {s: f"initcap(concat({', '.join(p)}))" for s, p in script.items()}
    extra = {s: f"concat({', '.join(p[:more])})" if more else "''" for s, p in script.items()}
    card = f"concat(substring(norm, 1, 1), substring({digits}, 2))"
    card = f"CASE WHEN {_luhn('norm')} = 0 THEN concat(substring({card}, 1, {size} - 1), check_digit) ELSE {card} END"
    rest = f"concat(substring(concat(substring(norm, 1, 1), substring({digits}, 2)), 1, {size} - 1), '0')"
    card = card.replace("check_digit", f"cast((10 - {_luhn('(' + rest + ')')}) % 10 AS string)")
    ip, ip6 = f"concat_ws('.', 1 + {b[0]} % 223, {b[1]}, {b[2]}, 1 + {b[3]} % 254)", hexes
    if wide:
        ip = ip6 = f"concat_ws(':', {', '.join(f'substring(h, {4 * i + 1}, 4)' for i in range(8))})"
    end = f"substring(translate(h, 'abcdef', '024689'), 20, {wide})" if wide else "''"
    body = f"""CASE
        WHEN kind = 'mail' THEN concat({shape("split(norm, '@')[0]")}, {longer}, '@mail', {b[7]} % 10, '.example.',
            array('com', 'net', 'org')[{b[6]} % 3])
        WHEN kind = 'ip' THEN {ip}
        WHEN kind = 'ip6' THEN {ip6}
        WHEN kind = 'card' THEN {card}
        WHEN kind = 'ssn' THEN {digits}
        WHEN kind = 'phone' THEN {dial}
        WHEN kind = 'iban' THEN concat(substring(norm, 1, 2), substring({shape("norm")}, 3), {end})
        WHEN kind = 'secret' AND norm rlike '^[0-9a-f]+$' THEN concat({hexes}, {longer})
        WHEN kind = 'secret' THEN concat({shape("norm")}, {longer})
        WHEN kind LIKE 'given % latin' THEN concat({given}, {extra["latin"]})
        WHEN kind LIKE 'given % greek' THEN concat({given}, {extra["greek"]})
        WHEN kind LIKE 'given %' THEN concat({given}, {extra["cyrillic"]})
        WHEN kind = 'surname latin' THEN {name["latin"]}
        WHEN kind = 'surname greek' THEN {name["greek"]}
        ELSE {name["cyrillic"]} END"""
    # The stream is bound to h once.
    return F.expr(f"transform(array({stream}), h -> {body})[0]")


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """kind, norm and surrogate. entities: distinct kind and norm."""
    entities = stored(entities, "entities")
    # No name is drawn that is a name of the corpus, given or not.
    place = F.when(F.col("kind").rlike("^(given|surname) "), "name").otherwise(F.col("kind")).alias("place")
    real = stored(entities.select(place, F.lower("norm").alias("shown")).distinct(), "real")
    left, done = entities, None
    for attempt in range(ATTEMPTS):
        drawn = left.withColumn("surrogate", _candidate(key, attempt))
        drawn = drawn.withColumn("shown", F.lower("surrogate"))
        free = drawn.withColumn("place", place).join(real, ["place", "shown"], "left_anti").drop("place")
        if done is not None:
            free = free.join(done.select("kind", F.lower("surrogate").alias("shown")), ["kind", "shown"], "left_anti")
        won = free.groupBy("kind", "shown").agg(F.min(F.struct("norm", "surrogate")).alias("w"))
        won = won.select("kind", "w.norm", "w.surrogate")
        done = stored(won if done is None else done.unionByName(won), "surrogates")
        left = stored(entities.join(done, ["kind", "norm"], "left_anti"), "left")
        if left.isEmpty():
            return done
    raise ValueError("the corpus has more entities of a kind than there are surrogates")


def _overlay(raw: str, digits: str, skip: str) -> str:
    """raw with its digits, or letters and digits, replaced in turn, beyond the first `skip` characters; more digits follow."""
    plain = f"regexp_replace(substring({raw}, 1, i), '[^0-9A-Za-z]', '')"
    place = f"length({plain}) - length(regexp_replace(substring({raw}, 1, {skip}), '[^0-9A-Za-z]', ''))"
    rest = f"substring({digits}, length(regexp_replace(substring({raw}, {skip} + 1), '[^0-9A-Za-z]', '')) + 1)"
    return (
        f"concat(array_join(transform(sequence(1, length({raw})), i -> if(i > {skip} AND substring({raw}, i, 1) rlike '[0-9A-Za-z]', "
        f"substring({digits}, {place}, 1), substring({raw}, i, 1))), ''), {rest})"
    )


def _shifted(key: str) -> str:
    """An initial of the Latin alphabet moved on by a number that the key gives."""
    move = 1 + int(hashlib.sha256(f"{key}|initial".encode()).hexdigest(), 16) % 25
    return f"if(norm rlike '^[A-Z]', concat(chr(65 + (ascii(norm) - 65 + {move}) % 26), '.'), norm)"


def _replacements(raws: DataFrame, known: DataFrame, key: str = KEY) -> DataFrame:
    """raw, its replacement, and for names the words that stand for them, each with its surrogate. raws: distinct raw with kind
    and parts."""
    parts = raws.select("raw", "kind", F.posexplode("parts").alias("at", "part"))
    parts = parts.select("raw", F.col("kind").alias("type"), "at", "part.kind", "part.norm")
    fixed = F.expr(f"CASE kind WHEN 'initial' THEN {_shifted(key)} WHEN 'particle' THEN norm END")
    parts = parts.join(known, ["kind", "norm"], "left").withColumn("surrogate", F.coalesce("surrogate", fixed))
    whole = parts.groupBy("raw", "type").agg(F.array_sort(F.collect_list(F.struct("at", "surrogate"))).alias("s"))
    code = "if(raw rlike '^[+][0-9]{1,3}[ (.-]', length(regexp_extract(raw, '^[+][0-9]{1,3}', 0)), 0)"
    text = F.expr(
        f"""CASE
        WHEN type = 'name' THEN concat_ws(' ', regexp_extract(raw, '^[^ \\u00A0]+', 0),
            array_join(transform(s, x -> x.surrogate), ' '))
        WHEN type = 'phone' THEN {_overlay("raw", "s[0].surrogate", code)}
        WHEN type IN ('card', 'ssn', 'iban') THEN {_overlay("raw", "s[0].surrogate", "0")}
        ELSE s[0].surrogate END"""
    )
    # Words of one sign, initials and particles stand for nobody.
    words = F.expr(
        f"""if(type = 'name', filter(zip_with({_words()}, s, (w, x) -> struct(w AS word, x.surrogate AS surrogate)),
            p -> length(p.word) > 2 AND p.word <> p.surrogate AND p.word rlike '^[\\\\p{{Lu}}]'),
            cast(array() AS array<struct<word: string, surrogate: string>>))"""
    )
    return whole.select("raw", text.alias("replacement"), words.alias("words"))


def anonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """docs with surrogates in their texts, and n_entities, the number replaced. key: whoever has it can repeat the draw."""
    text = F.col("text").cast("string")
    docs = docs.drop("n_entities").withColumn("text", text)
    found = docs.where(_holds(F.col("text")))
    plain = docs.where(~_holds(F.col("text"))).withColumn("n_entities", F.lit(0).cast("long"))
    found = stored(
        found.withColumn("__found", F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0))).withColumn(
            "__key", F.sha1(F.col("text").cast("binary"))
        ),
        "found",
    )
    texts = found.select("__key", "__found").groupBy("__key").agg(F.first("__found").alias("__found"))
    at = stored(texts.select("__key", F.posexplode("__found").alias("at", "raw")), "occurrences")
    raws = at.select("raw").distinct().withColumn("kind", _kind(F.col("raw"))).withColumn("parts", _parts())
    raws = stored(raws, "raws")
    entities = stored(_entities(raws), "drawn")
    drawn = surrogates(entities.select(F.col("drawn").alias("kind"), "norm"), key)
    known = entities.join(drawn.withColumnRenamed("kind", "drawn"), ["drawn", "norm"]).drop("drawn")
    swaps = at.join(_replacements(raws, known, key), "raw").groupBy("__key")
    swaps = swaps.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "replacement"))), lambda x: x["replacement"]).alias("__new"),
        F.array_distinct(F.flatten(F.collect_list("words"))).alias("__words"),
    )
    # A name found after a title goes wherever else it stands in the document.
    gap = (
        "aggregate(__words, g, (t, w) -> regexp_replace(t, concat('(?<![\\\\p{L}\\\\p{M}])', w.word, "
        "'(?![\\\\p{L}\\\\p{M}])'), w.surrogate))"
    )
    new = f"zip_with(split(text, __pattern, -1), __new, (g, r) -> concat({gap}, coalesce(r, '')))"
    changed = found.join(swaps, "__key").withColumn("__pattern", F.lit(ENTITY))
    changed = changed.withColumn("text", F.array_join(F.expr(new), "")).drop("__pattern")
    changed = changed.withColumn("n_entities", F.size("__found").cast("long"))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return plain.unionByName(changed.select(*plain.columns))
