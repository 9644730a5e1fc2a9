"""Surrogate generation for personal data: keyed, type-consistent, distinct, coreferent.

DataFrame and SQL functions only.

Detected: e-mail addresses, IP addresses, payment card numbers, telephone numbers, social
security numbers, IBANs, secrets (long hexadecimal strings, cloud access keys, values after
``token =`` and the like) and person names after a title. A match is cut into *parts* (the local
part and the domain of an address, given and family name); a part has a type and a normal form
(lower case, letters and digits only where the layout carries no meaning), and every part with the
same type and normal form gets the same surrogate, in all documents (coreference): a person's family
name stays the same with and without the given name.

Surrogates come from a keyed hash of type and normal form. They keep the layout: digits become
digits, letters letters of the same script and case, separators stay, hexadecimal stays
hexadecimal, a card number that passes the Luhn check gets a surrogate that passes, an IBAN with right
check digits gets right check digits, address octets stay octets, country codes and top-level domains stay, names are drawn from lists by script
and gender (from the title).

Collision check: surrogates of one type must differ from each other and from every value of that
type seen in the corpus; of a colliding set the smallest value keeps its surrogate, the others
draw again, until none collide. So distinct values stay distinct, and no surrogate is a real value.
From the second draw on names get initials. After ``DRAWS`` draws local parts, domain labels and secrets
leave their length by a hashed suffix that grows with every draw; telephone and social security numbers
get the free numbers of their length by rank, and a suffix only when none is left.

Scale: texts without any digit, ``@``, title or mark of a secret are passed through in the scan. Only the texts with
entities are shuffled, once, to meet their surrogates. The table of distinct values is an
aggregate with partial sums; a value in a third of all documents is one row of it.

Cases: null texts stay null and empty texts empty; rows repeated in id and text get the same result
each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlscore.operators.ranking import group_positions

# Detection patterns, in order of precedence.
TITLES_F = r"Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|г-жа|Госпожа|Κυρία|κα"
TITLES_M = r"Mr|Sir|Herr|Monsieur|Señor|Sr|г-н|Господин|Κύριος|κ"
TITLES_N = r"Dr|Prof"
TITLE = rf"(?:{TITLES_F}|{TITLES_M}|{TITLES_N})"
NAME_WORD = r"\p{Lu}[\p{L}\p{M}'’]+"
PATTERNS = {
    "EMAIL": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "SECRET": r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{32,}+|AKIA[0-9A-Z]{16})(?![0-9A-Za-z])"
              r"|(?<=(?i:token|secret|password|passwd|api_key|apikey)\s{0,2}[=:]\s{0,2}[\"']?)[0-9A-Za-z_\-/+.]{6,}+",
    "IP": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "PHONE": r"\+1[^\p{L}\p{N}\n]{0,6}\d{3}[^\p{L}\p{N}\n]{0,6}\d{3}[^\p{L}\p{N}\n]{0,6}\d{4}(?!\d)"
             r"|\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)"
             r"|(?<![\d-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\d-])|(?<![\d.-])555-\d{4}(?![\d-])",
    "SSN": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "IBAN": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "CARD": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    "NAME": rf"(?<![\p{{L}}\p{{N}}]){TITLE}\.?[ \t]+{NAME_WORD}(?:[ -]{NAME_WORD}){{0,2}}",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Title, given and family name; the bare name counts as a name in the rest of its text.
FULL_NAME = rf"(?<![\p{{L}}\p{{N}}]){TITLE}\.?[ \t]+{NAME_WORD}(?:[ -]{NAME_WORD}){{1,2}}"
HAS_TITLE = rf"(?<![\p{{L}}\p{{N}}]){TITLE}\.?[ \t]"
#: A text without a match of this cheap pattern has no entity.
HINT = rf"[0-9@]|(?<![\p{{L}}\p{{N}}]){TITLE}\.?[ \t]|(?i:token|secret|password|passwd|api_key|apikey)\s{{0,2}}[=:]|AKIA|[a-fA-F]{{32}}"

# Names by script and gender; surrogates only, chosen by hash.
NAMES = {
    "latin_F": "Anna Clara Diana Elena Flora Greta Hanna Irene Julia Klara Laura Maria Nora Olga Paula Rosa Sara Tina Vera Wilma",
    "latin_M": "Adam Bruno Carl David Erik Felix Georg Hugo Ivan Jonas Karl Lukas Martin Niklas Oscar Peter Robert Simon Thomas Victor",
    "latin_N": "Alex Andrea Chris Dominique Jordan Kim Lee Maxime Noel Pat Robin Sam Sascha Taylor Toni",
    "cyrillic_F": "Анна Вера Галина Дарья Елена Жанна Ирина Лидия Мария Нина Ольга Полина Софья Татьяна Юлия",
    "cyrillic_M": "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Сергей",
    "cyrillic_N": "Саша Женя Валя Слава Шура",
    "greek_F": "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Σοφία Χριστίνα",
    "greek_M": "Αντώνης Βασίλης Γιώργος Δημήτρης Ηλίας Θανάσης Ιωάννης Κώστας Μιχάλης Νίκος Πέτρος Σπύρος",
    "greek_N": "Άρης Φοίβος Δάφνη Ορέστης",
    "latin_family": "Abel Baker Castro Duval Ebert Fischer Garcia Hansen Ibsen Jansen Keller Lambert Moreau Navarro Olsen Petit Quint Romero "
                    "Santos Torres Ulrich Vogel Weber Ximenes Young Zeller",
    "cyrillic_family": "Беленко Вольных Гриценко Долгих Жук Зайченко Коваль Лисенко Мороз Новик Остапенко Руденко Седых Ткач Шевчук",
    "greek_family": "Αλεξίου Βλάχου Γεωργίου Δήμου Ζώη Ιωάννου Κόκκινου Λάμπρου Μακρή Νικολάου Παππά Ρήγα Σταύρου Χρήστου",
}

#: Draws at the length of the value; types that then get a suffix, with the class of its characters.
DRAWS = 8
SUFFIX = {"EMAIL": "x", "DOMAIN": "x", "SECRET": "x", "HEX": "a"}
#: Types of fixed length; they get a suffix after twice as many draws. Of these, the ones whose free codes are dealt by rank.
NUMBERS = ("PHONE", "SSN", "CARD", "CARD_LUHN", "IBAN")
RANKED = ("PHONE", "SSN")

_PART = "array<struct<lead:string,type:string,norm:string,surface:string>>"


def _part(lead: Column, kind, norm: Column, surface: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(lead.alias("lead"), kind.alias("type"), norm.alias("norm"), surface.alias("surface"))


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def parts(entity: Column) -> Column:
    """Cut one match into its parts."""
    alnum = F.lower(F.regexp_replace(entity, r"[^\p{L}\p{N}]+", ""))
    none = F.lit("")
    local, domain = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    title = F.regexp_extract(entity, rf"^{TITLE}\.?[ \t]+", 0)
    bare = F.regexp_replace(title, r"[.\s]+", "")
    gender = F.when(bare.rlike(f"^(?:{TITLES_F})$"), "F").when(bare.rlike(f"^(?:{TITLES_M})$"), "M").otherwise("N")
    name = F.regexp_replace(entity, rf"^{TITLE}\.?[ \t]+", "")
    family = F.regexp_extract(name, r"[^ -]+$", 0)
    given = F.regexp_extract(name, r"^(.*)[ -][^ -]+$", 1)
    gap = F.substring(F.regexp_extract(name, r"[ -][^ -]+$", 0), 1, 1)
    family_part = _part(F.when(given == "", title).otherwise(gap), F.concat(_script(family), F.lit("_family")), F.lower(family), family)
    given_part = _part(title, F.concat(_script(given), F.lit("_"), gender), F.lower(given), given)
    country = F.regexp_extract(entity, r"^(\+\d{1,3}?)(?=[^\d])", 1)
    return (F.when(entity.rlike("@"), F.array(_part(none, "EMAIL", F.lower(local), local), _part(F.lit("@"), "DOMAIN", F.lower(domain), domain)))
            .when(entity.rlike(f"^{TITLE}\\.?[ \\t]"), F.when(given == "", F.array(family_part)).otherwise(F.array(given_part, family_part)))
            .when(entity.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), F.array(_part(none, "IP", entity, entity)))
            .when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.array(_part(none, "SSN", alnum, entity)))
            .when(entity.rlike(r"^\+|^\(|^\d{3}[.-]\d{3}[.-]\d{4}$|^\d{3}-\d{4}$"),
                  F.array(_part(country, "PHONE", F.regexp_replace(F.substr(entity, F.length(country) + 1), r"\D+", ""), F.substr(entity, F.length(country) + 1))))
            .when(entity.rlike(r"^[\d -]{13,}$"), F.array(_part(none, F.when(luhn(alnum), "CARD_LUHN").otherwise("CARD"), alnum, entity)))
            .when(entity.rlike(r"^[A-Z]{2}\d{2}[ A-Z0-9]*$") & ~entity.rlike(r"^AKIA|^[0-9A-F]{32,}$"),
                  F.array(_part(F.substring(entity, 1, 2), F.when(mod97(F.concat(F.substr(alnum, F.lit(5)), F.substr(alnum, F.lit(1), F.lit(4)))) == 1,
                                                                  F.concat(F.lit("IBAN_"), F.substring(entity, 1, 2))).otherwise("IBAN"),
                                F.substr(alnum, F.lit(3)), F.substr(entity, F.lit(3)))))
            .otherwise(F.array(_part(none, F.when(entity.rlike(r"^[0-9a-fA-F]+$"), "HEX").otherwise("SECRET"), F.lower(entity), entity))))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    return luhn_sum(digits) % 10 == 0


def luhn_sum(digits: Column) -> Column:
    d = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.lit(2) * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(F.filter(d, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x)


def mod97(text: Column) -> Column:
    """Remainder of digits and lower-case letters (a = 10 ... z = 35) read as one number."""
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 87) % 97))


def is_number(kind: Column) -> Column:
    return kind.isin(*NUMBERS) | kind.startswith("IBAN_")


def _fill(shape: Column, stream: Column, hexadecimal: Column) -> Column:
    """Replace the letters and digits of ``shape`` by those of the hash stream, class by class."""
    digits = F.translate(stream, "abcdef", "052749")
    hexes = F.translate(stream, "0123456789", "abcdefcabe")
    latin = F.translate(stream, "0123456789abcdef", "bcdfghjkmnpqrstv")
    cyrillic = F.translate(stream, "0123456789abcdef", "бвгдежзиклмнопрс")
    greek = F.translate(stream, "0123456789abcdef", "βγδεζηθικλμνξοπρ")

    def one(c, i):
        at = i % 128 + 1
        return (F.when(c.rlike(r"[0-9]"), F.substr(digits, at, F.lit(1)))
                .when(hexadecimal, F.substr(hexes, at, F.lit(1)))
                .when(c.rlike(r"\p{IsCyrillic}"), F.substr(cyrillic, at, F.lit(1)))
                .when(c.rlike(r"\p{IsGreek}"), F.substr(greek, at, F.lit(1)))
                .when(c.rlike(r"\p{L}"), F.substr(latin, at, F.lit(1))).otherwise(c))
    return F.array_join(F.transform(F.split(shape, ""), one), "")


def _pick(words: str, stream: Column) -> Column:
    n = len(words.split())
    return F.element_at(F.split(F.lit(words), " "), (F.conv(F.substring(stream, 1, 8), 16, 10).cast("long") % n + 1).cast("int"))


def draw(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """Surrogate of a normal form at the given attempt (0, 1, ...): a normal form of the same type."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string"))
    stream = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\x1f+")), 256))

    def octet(k):
        return (F.conv(F.substring(stream, 4 * k + 1, 4), 16, 10).cast("int") % 254 + 1).cast("string")
    top = F.when(kind == "DOMAIN", F.concat(F.lit("."), F.substring_index(norm, ".", -1))).otherwise("")
    suffix = F.when(is_number(kind), F.repeat(F.lit("0"), F.greatest(attempt - 2 * DRAWS, F.lit(0))))
    for name, char in SUFFIX.items():
        suffix = suffix.when(kind == name, F.repeat(F.lit(char), F.greatest(attempt - DRAWS, F.lit(0))))
    shape = F.concat(F.substr(norm, F.lit(1), F.length(norm) - F.length(top)), suffix.otherwise(""))
    filled = _fill(shape, stream, kind == "HEX")
    body = F.substr(filled, F.lit(1), F.length(filled) - 1)
    check = ((F.lit(10) - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    country = F.lower(F.substr(kind, F.lit(6)))
    iban_check = F.lpad((F.lit(98) - mod97(F.concat(F.substr(filled, F.lit(3)), country, F.lit("00")))).cast("string"), 2, "0")
    out = (F.when(kind == "IP", F.concat_ws(".", *[octet(k) for k in range(4)]))
           .when(kind == "DOMAIN", F.concat(filled, top))
           .when(kind == "CARD_LUHN", F.concat(body, check))
           .when(kind.startswith("IBAN_"), F.concat(iban_check, F.substr(filled, F.lit(3)))))
    more = F.when(attempt > 0, F.concat(F.lit(" "), F.upper(F.substr(F.translate(stream, "0123456789", "ghijklmnop"), F.lit(11), F.floor((attempt + 1) / 2).cast("int"))))).otherwise("")
    for name, words in NAMES.items():  # after a collision a name gets initials
        out = out.when(kind == name, F.lower(F.concat(_pick(words, stream), more)))
    return out.otherwise(filled)


def _by_rank(open_: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """``type, surrogate, norm``: the free numbers of each length, in a keyed order, dealt to the open values of that length.

    Only lengths of which half of the numbers are taken: there the numbers are at most twice the values.
    """
    left = open_.where(F.col("type").isin(*RANKED) & F.col("norm").rlike("^[0-9]{1,9}$")).withColumn("_len", F.length("norm"))
    full = (taken.where(F.col("type").isin(*RANKED) & F.col("surrogate").rlike("^[0-9]{1,9}$")).groupBy("type", F.length("surrogate").alias("_len"))
            .agg(F.count(F.lit(1)).alias("_n")).where(2 * F.col("_n") >= F.pow(F.lit(10.0), F.col("_len"))).select("type", "_len"))
    spaces = sorted(map(tuple, left.select("type", "_len").distinct().join(full, ["type", "_len"]).collect()))  # at most nine lengths a type
    out = open_.select("type", F.col("norm").alias("surrogate"), "norm").where("false")

    def placed(rows: DataFrame, kind: str, value: str) -> DataFrame:
        order = F.md5(F.concat_ws("\x1f", F.lit(key), F.lit(kind), F.col(value)).cast("binary"))
        return group_positions(rows.withColumn("type", F.lit(kind)).withColumn("_order", order), ["type"], ["_order", value], "_nth")
    for kind, n in spaces:
        codes = open_.sparkSession.range(10 ** n).select(F.lpad(F.col("id").cast("string"), n, "0").alias("surrogate"))
        free = codes.join(taken.where(F.col("type") == kind).select("surrogate"), "surrogate", "left_anti")
        need = left.where((F.col("type") == kind) & (F.col("_len") == n)).select("norm")
        dealt = placed(need, kind, "norm").select("type", "norm", "_nth").join(placed(free, kind, "surrogate").select("surrogate", "_nth"), "_nth")
        out = out.unionByName(dealt.select("type", "surrogate", "norm"))
    return out


def assign(values: DataFrame, key: str, most_rounds: int = 100) -> DataFrame:
    """``type, norm, surrogate`` for the distinct ``type, norm`` rows: distinct and unlike any real value.

    All types but IP leave a full space of their length, so an error needs a corpus with about half of all IP addresses.
    """
    open_ = values.select("type", "norm").distinct().withColumn("_try", F.lit(0)).checkpoint()
    real = open_.select("type", F.col("norm").alias("surrogate"))
    done = None
    for attempt in range(most_rounds):
        taken = real if done is None else real.unionByName(done.select("type", "surrogate"))
        drawn = open_.withColumn("surrogate", draw(F.col("type"), F.col("norm"), F.col("_try"), key))
        free = drawn.join(taken, ["type", "surrogate"], "left_anti")
        won = free.groupBy("type", "surrogate").agg(F.min("norm").alias("norm"))
        if attempt == DRAWS:  # what is dealt by rank is not drawn as well
            ranked = _by_rank(open_, taken, key).checkpoint()
            won = ranked.unionByName(won.join(ranked.select("type", "norm"), ["type", "norm"], "left_anti")
                                     .join(ranked.select("type", "surrogate"), ["type", "surrogate"], "left_anti").select(*ranked.columns))
        won = won.checkpoint()
        done = won if done is None else done.unionByName(won)
        open_ = (open_.join(won.select("type", "norm"), ["type", "norm"], "left_anti")
                 .withColumn("_try", F.lit(attempt + 1)).checkpoint())
        if open_.limit(1).count() == 0:
            return done.select("type", "norm", "surrogate")
    raise ValueError(f"some IP addresses have no free surrogate after {most_rounds} draws")


def dress(surface: Column, kind: Column, surrogate: Column) -> Column:
    """Put a surrogate into the layout and case of the part it replaces; a suffix stands at the end, before a top-level domain."""
    loose = is_number(kind)  # the normal form has no separators
    size = F.length(F.when(loose, F.regexp_replace(surface, r"[^\p{L}\p{N}]+", "")).otherwise(F.lower(surface)))
    extra = F.greatest(F.length(surrogate) - size, F.lit(0))
    top = F.when(kind == "DOMAIN", F.length(F.substring_index(surface, ".", -1)) + 1).otherwise(0)
    at = size - top
    short = F.when(extra > 0, F.concat(F.substr(surrogate, F.lit(1), at), F.substr(surrogate, at + extra + 1))).otherwise(surrogate)
    suffix = F.substr(surrogate, at + 1, extra)
    suffix = F.when((surface == F.upper(surface)) & (surface != F.lower(surface)), F.upper(suffix)).otherwise(suffix)
    chars = F.split(surface, "")
    upto = F.transform(chars, lambda c, i: F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda x: x.rlike(r"[\p{L}\p{N}]"))))
    cased = F.transform(F.arrays_zip(chars.alias("c"), upto.alias("i")), lambda z, k: F.when(
        z["c"].rlike(r"[\p{L}\p{N}]"), F.substr(short, F.when(loose, z["i"]).otherwise(k + 1), F.lit(1))).otherwise(z["c"]))
    upper = F.transform(F.arrays_zip(chars.alias("c"), cased.alias("s")),
                        lambda z: F.when(z["c"].rlike(r"\p{Lu}"), F.upper(z["s"])).otherwise(z["s"]))
    name = F.when(surface == F.upper(surface), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    plain = F.array_join(upper, "")
    longer = F.concat(F.substr(plain, F.lit(1), F.length(surface) - top), suffix, F.substr(plain, F.length(surface) - top + 1))
    return (F.when(kind == "IP", surrogate).when(kind.rlike("_(?:F|M|N|family)$"), name)
            .when(extra > 0, longer).otherwise(plain))


def full_names(text: Column) -> Column:
    """Full names after a title, with the title, that a text holds."""
    names = F.array_distinct(F.regexp_extract_all(text, F.lit(FULL_NAME), F.lit(0)))
    return F.when(text.rlike(HAS_TITLE), names).otherwise(F.array().cast("array<string>"))


def bare_name(name: Column) -> Column:
    return F.regexp_replace(name, rf"^{TITLE}\.?[ \t]+", "")


def entity_pattern(text: Column) -> Column:
    """The pattern of all entities of a text: the fixed one, and its own full names without a title (longer ones first)."""
    names = F.transform(F.array_sort(F.transform(full_names(text), lambda n: F.struct((-F.length(n)).alias("k"), bare_name(n).alias("b")))), lambda x: x["b"])
    own = F.array_join(F.transform(names, lambda b: F.concat(F.lit("\\Q"), b, F.lit("\\E"))), "|")
    return F.when(own == "", F.lit(PATTERN)).otherwise(
        F.concat(F.lit(PATTERN + r"|(?<![\p{L}\p{N}])(?:"), own, F.lit(r")(?![\p{L}\p{N}])")))


def titled(found: Column, text: Column) -> Column:
    """The matches as (entity, bare): a bare name stands for its titled form, which tells its parts and gender."""
    of = lambda e: F.get(F.filter(full_names(text), lambda n: bare_name(n) == e), 0)
    return F.transform(found, lambda e: F.struct(F.coalesce(of(e), e).alias("entity"), of(e).isNotNull().alias("bare")))


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id, text`` (with surrogates), ``n_entities`` and ``surrogates`` (array of type, surrogate)."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    matches = F.regexp_extract_all("text", entity_pattern(F.col("text")), F.lit(0))
    found = F.when(F.col("text").rlike(HINT), matches).otherwise(F.array().cast("array<string>"))
    none = F.coalesce(F.size(found) <= 0, F.lit(True))
    plain = base.where(none).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"),
                                    F.array().cast("array<struct<type:string,surrogate:string>>").alias("surrogates"))
    # the texts with entities, a row for each different (id, text), and how often it occurs
    sig = F.xxhash64("text")
    some = base.where(~none).withColumn("sig", sig)
    one = some.select("doc_id", "sig", F.posexplode(titled(found, F.col("text"))).alias("pos", "e")).distinct()
    pieces = one.select("doc_id", "sig", "pos", "e.bare", F.posexplode(parts(F.col("e.entity"))).alias("nth", "part"))
    lead = F.when(F.col("bare") & (F.col("nth") == 0), F.lit("")).otherwise(F.col("part.lead"))
    pieces = pieces.select("doc_id", "sig", "pos", "nth", lead.alias("lead"), "part.type", "part.norm", "part.surface").checkpoint()
    table = assign(pieces, key)
    dressed = (pieces.join(table, ["type", "norm"])
               .withColumn("dressed", F.concat("lead", dress(F.col("surface"), F.col("type"), F.col("surrogate")))))
    entity = (dressed.groupBy("doc_id", "sig", "pos")
              .agg(F.sort_array(F.collect_list(F.struct("nth", "dressed", "type"))).alias("_p"))  # at most two parts
              .select("doc_id", "sig", "pos", F.array_join(F.transform("_p", lambda p: p["dressed"]), "").alias("surrogate"),
                      F.element_at("_p", 1)["type"].alias("type")))
    # all entities of one text: bounded by the text
    per_text = (entity.groupBy("doc_id", "sig").agg(F.sort_array(F.collect_list(F.struct("pos", "type", "surrogate"))).alias("_e"))
                .select(F.col("doc_id").alias("_d"), F.col("sig").alias("_s"), "_e"))
    between = F.split("text", entity_pattern(F.col("text")), F.lit(-1))
    woven = F.concat(F.array_join(F.transform("_e", lambda e, i: F.concat(F.get("_between", i), e["surrogate"])), ""),
                     F.element_at("_between", -1))
    joined = (some.join(per_text, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("sig") == F.col("_s")))
              .withColumn("_between", between)
              .select("doc_id", woven.alias("text"), F.size("_e").cast("long").alias("n_entities"),
                      F.transform("_e", lambda e: F.struct(e["type"].alias("type"), e["surrogate"].alias("surrogate"))).alias("surrogates")))
    return plain.unionByName(joined)
