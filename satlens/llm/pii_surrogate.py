"""Surrogates for personal data, in DataFrame functions only.

Entities are e-mail addresses, phone numbers, IPv4 addresses, card numbers (with
a valid check digit), secrets (long hexadecimal strings), given names and the
surnames after a given name or a form of address, with all their mentions in
that text.  Phone numbers have 3-3-4 digits, or 7 to 15 after a + or from a trunk
0 on (then with separators); cards have 13 to 19 digits.  Each distinct entity, in a
canonical form that its spellings share, gets one surrogate drawn from a keyed
digest: of the same type, and of the same shape - digits for digits, letters of
the same script and case for letters, given names of the same gender and
script (from a pool of compounds once the listed names are used up), card numbers with a valid check digit, valid addresses.  A surrogate
that two entities share, or that is itself an entity of the corpus, is drawn
anew until none is left, so that different entities stay different; equal
entities stay equal across all documents.  From the fifth draw on, surnames, local
parts and phone numbers get longer, so that draws end though all forms of a length occur.

Entities are counted per distinct text and joined by value; a text is rebuilt
from the gaps between its entities.  Texts without entities are passed on as
they are, without a shuffle.  Null texts stay null, blank ones unchanged;
repeated rows and null ids are kept (rows are matched by text, not by id); all
other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlens.llm.common import let, materialize

# Given names by gender and script, and forms of address.
GIVEN = {
    ("female", "latin"): ["Alice", "Anna", "Barbara", "Carmen", "Charlotte", "Elizabeth", "Emily", "Hannah", "Heidi", "Ingrid",
                          "Isabella", "Jennifer", "Jessica", "Karen", "Laura", "Linda", "Margaret", "Maria", "Mary", "Patricia",
                          "Rebecca", "Sarah", "Sophie", "Susan"],
    ("male", "latin"): ["Alexander", "Andrew", "Antonio", "Carlos", "Charles", "Daniel", "David", "Edward", "Felix", "George",
                        "James", "John", "Joseph", "Juan", "Lukas", "Michael", "Paul", "Peter", "Pierre", "Richard",
                        "Robert", "Stefan", "Thomas", "William"],
    ("female", "cyrillic"): ["Анна", "Екатерина", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Светлана", "Татьяна", "Юлия"],
    ("male", "cyrillic"): ["Александр", "Алексей", "Андрей", "Владимир", "Дмитрий", "Иван", "Михаил", "Николай", "Павел", "Сергей"],
}
# Surrogates beyond the given names, also by gender and script: stems and endings, none of them a name that is looked for.
STEMS = {"latin": "Al Ber Cor Del Ev Fer Gil Hel Is Jor Kar Lor Mar Nor Or Per Ros Sel Tor Val Wil Ad Em Ol".split(),
         "cyrillic": "Ал Бор Вер Гал Дар Ев Зар Ил Кир Лид Мар Нат Ол Рад Сав Тим Фед Яр Эл Свет".split()}
ENDINGS = {("female", "latin"): "ina ella ette inda ora essa ilia ona isa iana etta ika alia ena anna ira".split(),
           ("male", "latin"): "ard olf win mund ric us ian ando old mar ton vin ger wig helm fried".split(),
           ("female", "cyrillic"): "ина ана ита елла ида ея ива ислава ена ора иса иля".split(),
           ("male", "cyrillic"): "ислав имир ослав ан ей омир ий ен ур ил ентий он".split()}
POOL = {(g, s): [a + b for a in STEMS[s] for b in ends if not any(a + b in n for n in GIVEN.values())] for (g, s), ends in ENDINGS.items()}
ADDRESS = ["Mr", "Mrs", "Ms", "Dr", "Herr", "Frau", "Señor", "Señora", "Monsieur", "Madame"]

_NAMES = "|".join(n for names in GIVEN.values() for n in names)
#: type -> pattern; the first that matches a value wins.  Repeated groups are bounded (a domain has 127 labels at most), as
#: Java walks them by recursion; only single characters repeat without bound.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){0,125}\.\p{L}{2,}",
    "ipv4": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}])(?:\d{4}(?<gap>[ -])\d{4}\k<gap>\d{4}\k<gap>\d{4}(?:\k<gap>\d{3})?|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{13,19})(?![\p{L}\p{N}])",
    # three, three and four digits; 7 to 15 after a +; 7 to 15 from a trunk 0 on, with separators, but no dates and hours
    "phone": (r"(?<![\p{L}\p{N}])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\p{L}\p{N}])"
              r"|\+(?:[ ./()-]{0,2}\d){7,15}(?![\p{L}\p{N}])"
              r"|(?<!\d[./-])(?!\d\d(?<sep>[./-])\d\d\k<sep>(?:\d{4}|\d\d)(?!\d|\k<sep>\d))(?!\d\d\.\d\d ?- ?\d\d\.\d\d(?![./-]?\d))"
              r"(?=\(?\d{2,6}[ ./()-])\(?0{1,2}[1-9](?:[ ./()-]{0,2}\d){5,13}(?![\p{L}\p{N}]))"),
    "given": rf"(?=[A-ZА-Я])(?<!\p{{L}})(?:{_NAMES})(?!\p{{L}})",
    "surname": rf"(?=\p{{Lu}})(?<=(?<!\p{{L}})(?:{_NAMES}|{'|'.join(ADDRESS)})\.? )\p{{Lu}}\p{{Ll}}+(?:-\p{{Lu}}\p{{Ll}}+)?(?!\p{{L}})",
}
#: All of them, in order.  Behind a letter or digit only two types can begin, so that places inside words fail at once.
ANY = (r"(?=[\p{L}\p{N}._%+(-])(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"
       rf"|(?=[0-9A-ZА-Я])(?:(?:{PATTERNS['ipv4']})|(?:{PATTERNS['given']}))")
_CARD = r"^\d{13,19}$|^\d{4}([ -])\d{4}\1\d{4}\1\d{4}(\1\d{3})?$|^\d{4}[ -]\d{6}[ -]\d{4,5}$"
#: Country codes of E.164 have one to three digits; they and a trunk 0 with the digit after it stay as they are.
_KEPT = r"^(?:\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})|0{1,2}[1-9])"

SURNAME = r"^\p{Lu}\p{Ll}+(-\p{Lu}\p{Ll}+)?$"
#: One of these is in every text with an entity: a @, the start of an address, seven digits with at most two signs between
#: neighbours, a long hexadecimal run, a name or form of address; names are only tried where a word begins with a capital.
NEEDED = [r"@", r"[0-9]\.[0-9]{1,3}\.", r"[0-9](?:[ ./()-]{0,2}[0-9]){6}", r"[0-9a-f]{32}|[0-9A-F]{32}",
          rf"(?=[A-ZА-Я])(?<!\p{{L}})(?:{_NAMES}|{'|'.join(ADDRESS)})(?!\p{{L}})"]

LATIN_LOWER = "abcdefghijklmnopqrstuvwxyz"
CYRILLIC_LOWER = "абвгдежзиклмнопрстуфхцшэюя"


def card_number(value: Column) -> Column:
    """The digits of a card; three digits after four groups of four may be no part of it."""
    digits = F.regexp_replace(value, r"\D", "")
    return (F.when(value.rlike(r"\d{4}([ -]\d{4}){3}[ -]") & ~F.call_function("luhn_check", digits), F.substring(digits, 1, 16))
            .otherwise(digits))


def kind(value: Column) -> Column:
    """The type of a matched value, null for a match that is no entity (a bad check digit, an octet over 255)."""
    octets = F.split(value, r"\.")
    return (F.when(value.rlike("@"), "email")
            .when(value.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), F.when(F.forall(octets, lambda o: o.cast("int") <= 255), "ipv4"))
            .when(value.rlike(_CARD), F.when(F.call_function("luhn_check", card_number(value)), "card"))
            .when(value.rlike(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$"), "secret")
            .when(value.rlike(r"^[+(\d]"), "phone")
            .when(value.isin([n for names in GIVEN.values() for n in names]), "given")
            .otherwise("surname"))


def canonical(type_: Column, value: Column) -> Column:
    """What the spellings of an entity share."""
    return (F.when(type_.isin("email", "secret", "given", "surname"), F.lower(value))
            .when(type_ == "ipv4", F.array_join(F.transform(F.split(value, r"\."), lambda o: o.cast("int").cast("string")), "."))
            .when(type_ == "card", card_number(value))
            .otherwise(F.concat(F.when(value.startswith("+"), "+").otherwise(""), F.regexp_replace(value, r"\D", ""))))


def shaped(text: Column, digest: Column, hexadecimal: Column) -> Column:
    """Every digit, letter of a script and case by another of its kind, drawn from the digest."""
    def pick(alphabet: str, d: Column, i: Column) -> Column:
        return F.substring(F.lit(alphabet), (F.pmod(F.xxhash64(d, i), F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))

    def one(c: Column, i: Column, d: Column) -> Column:
        return (F.when(hexadecimal & c.rlike("[0-9a-f]"), pick("0123456789abcdef", d, i))
                .when(c.rlike("[0-9]"), pick("0123456789", d, i))
                .when(c.rlike("[а-яё]"), pick(CYRILLIC_LOWER, d, i))
                .when(c.rlike(r"\p{Ll}"), pick(LATIN_LOWER, d, i))
                .otherwise(c))
    # the digest of a form is worked out once, not once a character
    return let(digest, lambda d: F.array_join(F.transform(F.split(text, ""), lambda c, i: one(c, i, d)), ""))


def check_digit(body: Column) -> Column:
    """The digit that makes body + digit pass the Luhn check."""
    doubled = F.transform(F.reverse(F.split(body, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2).otherwise(c.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return F.pmod(-total, F.lit(10)).cast("string")


def drawn(type_: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical form, in canonical form itself."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), type_, canon, attempt.cast("string")), 256)

    def one_of(names: list[str]) -> Column:
        return F.element_at(F.lit([n.lower() for n in names]), (F.pmod(F.xxhash64(digest), F.lit(len(names))) + 1).cast("int"))

    # where the corpus has the listed names itself, none of them is free: then one of the pool
    given = F.coalesce(*[F.when(canon.isin([n.lower() for n in names]), F.when(attempt < 4, one_of(names)).otherwise(one_of(POOL[k])))
                         for k, names in GIVEN.items()])
    more = F.floor(attempt / 4).cast("int")  # short forms may all be taken: later draws are longer
    body = F.concat(F.substring(canon, 1, 1), shaped(F.substring(canon, F.lit(2), F.length(canon) - 2), digest, F.lit(False)))
    code = F.regexp_extract(canon, _KEPT, 0)
    # should all addresses occur, octets beyond 255 are free
    octet = lambda i: F.when(attempt < 50, F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(254)) + 1).otherwise(
        F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(744)) + 256).cast("string")
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    top = F.substring_index(domain, ".", -1)
    host = F.regexp_replace(domain, r"\.[^.]*$", "")
    return (F.when(type_ == "email", F.concat(shaped(F.concat(local, F.repeat(F.lit("a"), more)), digest, F.lit(False)), F.lit("@"),
                                              shaped(host, F.sha2(F.concat_ws("|", F.lit(key), host), 256), F.lit(False)), F.lit("."), top))
            .when(type_ == "ipv4", F.concat_ws(".", *(octet(i) for i in range(4))))
            .when(type_ == "card", F.concat(body, check_digit(body)))
            .when(type_ == "phone", F.concat(code, shaped(F.concat(F.substring(canon, F.length(code) + 1, F.length(canon)),
                                                                            F.repeat(F.lit("0"), more)), digest, F.lit(False))))
            .when(type_ == "secret", shaped(canon, digest, F.lit(True)))
            .when(type_ == "given", given)
            .otherwise(shaped(F.concat(canon, F.repeat(F.right(canon, F.lit(1)), more)), digest, F.lit(False))))


def spelled(type_: Column, value: Column, core: Column) -> Column:
    """The surrogate in the spelling of ``value``: its separators, capitals and country code."""
    def digits(c: Column) -> Column:  # the i-th digit of the value becomes the i-th of the surrogate
        pieces = F.split(value, "")
        place = F.transform(pieces, lambda x, i: F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), r"\D", "")))
        named = F.array_join(F.zip_with(pieces, place, lambda x, p: F.when(x.rlike("[0-9]") & (p <= F.length(c)), F.substring(c, p, F.lit(1))).otherwise(x)), "")
        return F.concat(named, F.when(type_ == "phone", F.substring(c, F.length(F.regexp_replace(value, r"\D", "")) + 1, F.length(c))).otherwise(""))

    capitals = F.initcap(F.regexp_replace(core, "-", " "))
    return (F.when(type_.isin("phone", "card"), let(F.regexp_replace(core, r"\+", ""), digits))
            .when((type_ == "secret") & value.rlike("[A-F]"), F.upper(core))
            .when((type_ == "email") & (value == F.upper(value)), F.upper(core))
            .when(type_.isin("given", "surname"), F.when(value.contains("-"), F.regexp_replace(capitals, " ", "-")).otherwise(capitals))
            .otherwise(core))


def surrogates(entities: DataFrame, key: str, most_rounds: int = 100) -> DataFrame:
    """(type, canon, core) with different cores for different entities of a type, none of them an entity itself.

    entities: distinct (type, canon).  Of several entities with one core the
    smallest keeps it; the others, and all whose core is an entity, draw again.
    """
    entities = materialize(entities, "entities")
    real = entities.select(F.col("type").alias("rt"), F.col("canon").alias("rc"))
    settled, open_ = [], entities.withColumn("attempt", F.lit(0))
    for _ in range(most_rounds):
        tried = materialize(open_.withColumn("core", drawn(F.col("type"), F.col("canon"), F.col("attempt"), key)), "drawn")
        taken = reduce(DataFrame.unionByName, [s.select("type", "core") for s in settled], real.toDF("type", "core"))
        free = tried.join(taken.select(F.col("type").alias("tt"), F.col("core").alias("tc")),
                          (F.col("type") == F.col("tt")) & (F.col("core") == F.col("tc")), "left_anti")
        keeper = free.groupBy("type", "core").agg(F.min("canon").alias("canon"))
        won = materialize(keeper.select("type", "canon", "core"), "settled")
        settled.append(won)
        lost = tried.drop("core").join(won.select(F.col("type").alias("wt"), F.col("canon").alias("wc")),
                                       (F.col("type") == F.col("wt")) & (F.col("canon") == F.col("wc")), "left_anti")
        if lost.isEmpty():
            return reduce(DataFrame.unionByName, settled)
        open_ = lost.withColumn("attempt", F.col("attempt") + 1)
    raise ValueError(f"entities without a free surrogate after {most_rounds} draws")


def replace_pii(docs: DataFrame, key: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every entity of ``text_col`` replaced; all columns and rows are kept."""
    text = F.col(text_col)
    has = F.coalesce(reduce(Column.__or__, [text.rlike(p) for p in NEEDED]), F.lit(False))
    found = docs.where(has).select(text.alias("_text")).withColumn("_found", F.regexp_extract_all("_text", F.lit(ANY), F.lit(0)))
    surnames = F.array_distinct(F.filter("_found", lambda v: v.rlike(SURNAME) & ~v.isin([n for names in GIVEN.values() for n in names])))
    # surnames have letters and hyphens only; where the text has them alone they are the same entities
    found = found.withColumn("_more", F.when(F.size(surnames) > 0, F.concat(F.lit(ANY + r"|(?<![\p{L}-])(?:"), F.array_join(surnames, "|"),
                                                                            F.lit(r")(?![\p{L}]|-\p{L})"))))
    found = found.withColumn("_found", F.when(F.col("_more").isNull(), F.col("_found"))
                             .otherwise(F.regexp_extract_all("_text", F.col("_more"), F.lit(0))))
    # the outer form: a filter on the size of _found would be pushed below it, and scan each text once for every mention
    each = (found.select(F.sha2("_text", 256).alias("sha"), "_more", F.posexplode_outer("_found").alias("pos", "value"))
            .where("value is not null")
            .withColumn("type", kind(F.col("value"))).withColumn("canon", canonical(F.col("type"), F.col("value")))
            .dropDuplicates(["sha", "pos"]))
    each = materialize(each, "found")
    table = surrogates(each.where("type is not null").select("type", "canon").distinct(), key)
    new = each.join(table.select(F.col("type").alias("st"), F.col("canon").alias("sc"), "core"),
                    (F.col("type") == F.col("st")) & (F.col("canon") == F.col("sc")), "left")
    new = new.withColumn("new", F.when(F.col("core").isNull(), F.col("value"))
                         .otherwise(spelled(F.col("type"), F.col("value"), F.col("core"))))
    per_text = (new.groupBy(F.col("sha").alias("_sha")).agg(F.sort_array(F.collect_list(F.struct("pos", "new"))).alias("_new"),
                                                           F.count("core").alias("_n"), F.max("_more").alias("_more")).where("_n > 0"))
    gaps = F.when(F.col("_more").isNull(), F.split(text, ANY)).otherwise(F.split(text, F.col("_more")))
    rebuilt = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(F.col("_new"), i)["new"], F.lit("")))), "")
    touched = docs.where(has).withColumn("_key", F.sha2(text, 256)).join(per_text, F.col("_key") == F.col("_sha"), "left")
    # every column may hold clashing names but ours, which begin with _
    columns = [F.when(F.col("_sha").isNotNull(), rebuilt).otherwise(text).alias(text_col) if c == text_col else F.col(c) for c in docs.columns]
    return touched.select(*columns).unionByName(docs.where(~has))
