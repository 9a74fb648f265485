"""Personal data replaced by keyed surrogates of the same type and form, with built-in functions only.

Entities are found by one pattern. Each is reduced to a canonical value (a
telephone number to its digits, an address to lower case), so that different
spellings of one thing get one surrogate, in all texts. A keyed digest makes the
surrogate: letters become letters of the same script (of scripts not listed here: Latin
ones), digits digits; first names
come from lists by gender and script, surnames by script; card numbers that
pass their checksum still do.

A surrogate must not equal a value that occurs in the texts, nor another
surrogate of its kind. Values whose candidate fails that check draw again, until
none is left; so different values stay different.

What counts as an entity: e-mail addresses below an ASCII domain; hexadecimal
secrets of 32 to 128 digits; account numbers (IBAN); social security numbers
ddd-dd-dddd; card numbers of 13 to 19 digits; IPv4 addresses; telephone numbers
with a plus, and without it those of ten digits as (ddd) ddd-dddd or
ddd-ddd-dddd (also after a 1; then and with +1 the same number), those with the
prefix 00, and those whose area code starts with 0, of nine digits or more.
Without a plus there has to be a blank, dot, hyphen, slash or bracket: an
undivided run of digits is no telephone number, nor is one of seven digits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm.common import kept

# Forms of address and what they say about gender.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "г-н", "господин", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Signora", "г-жа", "госпожа", "Κυρία"],
    "x": ["Dr", "Prof"],
}
_TITLE = "|".join(t for g in ("f", "m", "x") for t in sorted(TITLES[g], key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# Telephone numbers without a plus: of ten digits, behind the prefix 00, and with an area code that starts with 0.
_ALONE = r"(?<![\p{L}\p{N}+])(?<!\d[.-])"
_TEN = rf"(?:(?:{_ALONE}1[ .-]?|(?<!\d))\(\d{{3}}\)[ .-]?|{_ALONE}(?:1[ .-])?[2-9]\d{{2}}[ .-])\d{{3}}[ .-]?\d{{4}}"
_PREFIX = rf"{_ALONE}00[ .-]?[1-9]\d{{0,2}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?(?:\d{{1,4}}[ .-]){{1,4}}\d{{2,8}}"
_TRUNK = (
    r"(?<!\d[ .-])(?<!\d)(?!\d{2}[./-]\d{2}[./-]\d{4})(?=(?:[ ./()-]{0,2}\d){9})(?:"
    rf"{_ALONE}0[1-9](?:[ .-]\d{{2}}){{4}}(?![ .-]\d)"
    rf"|(?:\(0\d{{1,4}}\)[ ./-]?|{_ALONE}0\d{{1,4}}(?: ?[/-] ?|[ .]))(?:\d{{5,8}}(?:-\d{{1,4}})?|\d{{3,4}}(?:[ .-]\d{{2,4}}){{1,3}})"
    rf"|(?:\(0\d{{2,4}}\)[ ./-]?|{_ALONE}0\d{{2,4}}(?: ?[/-] ?|[ .]))\d{{2}}(?:[ .-]\d{{2,4}}){{2,4}})"
)
# Kinds in the order in which they are tried, and their patterns.
PATTERNS = {
    "email": r"[\p{L}\p{N}][\p{L}\p{M}\p{N}._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "local": rf"(?:{_TEN}|{_PREFIX}|{_TRUNK})(?![\p{{L}}\p{{N}}]|[.-]\d)",
    "card": r"(?<![\p{L}\p{N}])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}])",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.\d)",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? \p{{Lu}}[\p{{L}}'’-]+(?: \p{{Lu}}[\p{{L}}'’-]+)?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# No entity without one of these; far cheaper than the patterns.
HINT = rf"[0-9@]|{_TITLE}"

# Attempts after which forms grow, and after which the search for surrogates is given up.
CROWDED, MOST_ATTEMPTS = 4, 80

# Names by script and gender.
FIRST = {
    ("latin", "f"): ["Anna", "Clara", "Elena", "Emma", "Ida", "Julia", "Laura", "Lena", "Maria", "Nora", "Olga", "Paula", "Rosa", "Sara", "Vera", "Zoe"],
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Marc", "Oscar", "Paul", "Simon", "Tom", "Victor"],
    ("cyrillic", "f"): ["Анна", "Вера", "Елена", "Инна", "Лидия", "Мария", "Нина", "Ольга"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Иван", "Лев", "Максим", "Олег", "Павел"],
    ("greek", "f"): ["Άννα", "Ελένη", "Μαρία", "Σοφία"],
    ("greek", "m"): ["Γιάννης", "Κώστας", "Νίκος", "Πέτρος"],
}
LAST = {
    "latin": ["Abel", "Berger", "Costa", "Duval", "Ebert", "Ferrer", "Graf", "Holm", "Iversen", "Jansen", "Kern", "Lopez", "Moreau", "Novak",
              "Orban", "Petit", "Quint", "Roth", "Silva", "Torres", "Ulmer", "Vidal", "Weber", "Young"],
    "cyrillic": ["Бойко", "Бондаренко", "Гончаренко", "Коваленко", "Лысенко", "Мороз", "Павленко", "Ткаченко", "Шевченко"],
    "greek": ["Αγγέλου", "Βλάχος", "Δήμου", "Παππάς"],
}
ALPHABETS = [
    ("0123456789", "0", "9"),
    ("abcdefghijklmnopqrstuvwxyz", "a", "z"),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A", "Z"),
    ("абвгдежзиклмнопрстуфхцчшэюя", "а", "я"),
    ("αβγδεζηθικλμνξοπρστυφχψω", "α", "ω"),
]
# Every other letter, mark and number, by the first pattern that holds.
OTHERS = [
    (r"\p{N}", "0123456789"),
    (r"\p{IsCyrillic}", "абвгдежзиклмнопрстуфхцчшэюя"),
    (r"\p{IsGreek}", "αβγδεζηθικλμνξοπρστυφχψω"),
    (r"\p{IsArabic}", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"),
    (r"\p{IsHebrew}", "אבגדהוזחטיכלמנסעפצקרשת"),
    (r"\p{IsHan}", "一七三上下中主之九也了事二于五人今他但作你來個們先入全八公六分前力十千又口古可右同名"),
    (r"\p{IsHiragana}", "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわ"),
    (r"\p{IsKatakana}", "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ"),
    (r"\p{IsHangul}", "가나다라마바사아자차카타파하고노도로모보소오조초코토포호구누두루무부수우주추쿠투푸후"),
    (r"[\p{L}\p{M}]", "abcdefghijklmnopqrstuvwxyz"),
]


def _all(column: Column, pattern: str) -> Column:
    return F.regexp_extract_all(column, F.lit(pattern), F.lit(0))


def kind_of(entity: Column) -> Column:
    kinds = F.lit("name")
    for kind, pattern in reversed(list(PATTERNS.items())):
        kinds = F.when(entity.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(kinds)
    return kinds


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _gender(entity: Column) -> Column:
    said = {g: "^(?:" + "|".join(names) + r")\.? " for g, names in TITLES.items()}
    return F.when(entity.rlike(said["f"]), "f").when(entity.rlike(said["m"]), "m").otherwise("x")


def _name_words(entity: Column) -> Column:
    """The words of a name without its title."""
    return F.split(F.regexp_replace(entity, rf"^(?:{_TITLE})\.? ", ""), " ")


def _with_country(digits: Column) -> Column:
    """The digits of a number without a plus as they are with it: ten are those behind +1, 00 is the plus."""
    ten = (F.length(digits) == 10) & ~digits.startswith("0")
    return F.when(ten, F.concat(F.lit("1"), digits)).otherwise(F.regexp_replace(digits, "^00", ""))


def units(entity: Column) -> Column:
    """The values of an entity that get a surrogate each: array of (kind, value). A name has one for each of its words."""
    kind = kind_of(entity)
    value = (
        F.when(kind == "local", _with_country(F.regexp_replace(entity, "[^0-9]", "")))
        .when(kind.isin("phone", "ssn", "card"), F.regexp_replace(entity, "[^0-9]", ""))
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
        .otherwise(F.lower(entity))
    )
    words = _name_words(entity)
    named = F.transform(
        words,
        lambda w, i: F.struct(
            F.concat(
                F.when((i == 0) & (F.size(words) > 1), F.concat(F.lit("first_"), _gender(entity), F.lit("_"))).otherwise(F.lit("last_")),
                _script(w),
            ).alias("kind"),
            F.lower(w).alias("value"),
        ),
    )
    return F.when(kind == "name", named).otherwise(F.array(F.struct(F.when(kind == "local", "phone").otherwise(kind).alias("kind"), value.alias("value"))))


def _byte(stream: Column, i: Column) -> Column:
    """Byte i of a stream of hexadecimal digits, from its start again at the end."""
    return F.conv(F.substring(stream, F.pmod(i * 2, F.length(stream)) + 1, F.lit(2)), 16, 10).cast("int")


def _same_form(value: Column, stream: Column) -> Column:
    """Every letter and digit replaced by one of its alphabet that the stream picks; all else stays."""

    def drawn(c: Column, number: Column) -> Column:
        letter = c
        for pattern, letters in reversed(OTHERS):
            letter = F.when(c.rlike(pattern), F.substring(F.lit(letters), F.pmod(number, F.lit(len(letters))) + 1, F.lit(1))).otherwise(letter)
        for letters, low, high in ALPHABETS:
            size = F.when(c.between("a", "f") & value.rlike("^[0-9a-f]{32,}$"), 6).otherwise(len(letters))
            letter = F.when(c.between(low, high), F.substring(F.lit(letters), F.pmod(number, size) + 1, F.lit(1))).otherwise(letter)
        return letter

    def pick(c: Column, i: Column) -> Column:
        # Two bytes for a letter, so that the alphabet's letters are about equally likely; bound, as the number is used often.
        number = _byte(stream, 2 * i) * 256 + _byte(stream, 2 * i + 1)
        return F.get(F.transform(F.array(number), lambda n: drawn(c, n)), F.lit(0))

    return F.array_join(F.transform(F.split(value, ""), pick), "")


def _luhn(digits: Column) -> Column:
    """Checksum of a digit string: 0 for a valid card number."""
    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2 % 10) + F.floor(c.cast("int") * 2 / 10).cast("int")),
    )
    return F.aggregate(places, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10


def _pick_name(names: list[str], stream: Column, attempt: int) -> Column:
    """A name, or on later attempts several joined by hyphens, so that there is always room."""
    table = F.array(*[F.lit(n) for n in names])
    parts = [
        F.element_at(table, (F.pmod(_byte(stream, F.lit(4 * k)) * 256 + _byte(stream, F.lit(4 * k + 1)), F.lit(len(names))) + 1).cast("int"))
        for k in range(1 + attempt)
    ]
    return F.lower(F.concat_ws("-", *parts))


def candidate(kind: Column, value: Column, key: str, attempt: int) -> Column:
    """The surrogate that the key draws for a value at an attempt, in canonical form."""
    seed = F.concat_ws("\u0001", F.lit(key), kind, value, F.lit(str(attempt)))
    stream = F.concat(*[F.sha2(F.concat_ws("\u0001", seed, F.lit(str(k))), 512) for k in range(4)])
    # After some attempts in vain the form may be full, and gets one more place.
    more = attempt // CROWDED
    longer = F.when(kind.isin("phone", "ssn", "card", "iban"), F.lit("0" * more)).otherwise(F.lit("a" * more))
    form = _same_form(F.concat(value, longer), stream)
    phone = F.concat(F.substring(value, 1, 1), F.substr(form, F.lit(2)))
    # The last digit of a valid card number is set so that the checksum comes out as 0 again.
    body = F.substr(form, F.lit(1), F.length(form) - 1)
    valid = F.concat(body, F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))
    card = F.when(_luhn(value) == 0, valid).otherwise(form)
    octets = [F.pmod(_byte(stream, F.lit(2 * k)), F.lit(223)) + 1 if k == 0 else _byte(stream, F.lit(2 * k)) for k in range(4)]
    address = F.concat_ws(".", *[o.cast("string") for o in octets])
    iban = F.concat(F.substring(value, 1, 2), F.substr(form, F.lit(3)))
    # The domain gets a digest of its own, so that people of one domain stay together, below a reserved ending.
    domain = F.substring_index(value, "@", -1)
    domain_stream = F.concat(*[F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit("domain"), domain, F.lit(str(k))), 512) for k in range(4)])
    host = F.substring_index(domain, ".", 1)
    email = F.concat(
        _same_form(F.concat(F.substring_index(value, "@", 1), longer), stream), F.lit("@"), _same_form(host, domain_stream), F.lit(".example")
    )
    drawn = (
        F.when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "ip", address)
        .when(kind == "iban", iban)
        .when(kind == "email", email)
        .otherwise(form)
    )
    for (script, gender), names in FIRST.items():
        drawn = F.when(kind == f"first_{gender}_{script}", _pick_name(names, stream, attempt)).otherwise(drawn)
    for script, names in LAST.items():
        both = FIRST[(script, "f")] + FIRST[(script, "m")]
        drawn = F.when(kind == f"last_{script}", _pick_name(names, stream, attempt)).when(
            kind == f"first_x_{script}", _pick_name(both, stream, attempt)
        ).otherwise(drawn)
    return drawn


def assign(values: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for each distinct (kind, value), one to one within a kind.

    A candidate is refused if it occurs as a value of its kind, has been given
    away at an earlier attempt, or is wanted by several values; of these the
    least gets it. Whoever is refused draws again. Names are joined to longer ones
    at later attempts, and after every CROWDED of them other forms grow by a digit
    or letter, so there is room for all. Only addresses of the net, of which there are
    some 3.7 billion, have a fixed form. MOST_ATTEMPTS without an end stop the job
    with the kinds that are left.
    """
    pending = kept(values.select("kind", "value").distinct())
    everything, given, attempt = pending, [], 0
    while True:
        drawn = pending.withColumn("surrogate", candidate(F.col("kind"), F.col("value"), key, attempt))
        best = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        taken = everything.select("kind", F.col("value").alias("surrogate"))
        for earlier in given:
            taken = taken.unionByName(earlier.select("kind", "surrogate"))
        won = kept(best.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "value", "surrogate"))
        given.append(won)
        pending = kept(pending.join(won, ["kind", "value"], "left_anti"))
        if pending.isEmpty():
            return reduce(DataFrame.unionByName, given)
        attempt += 1
        if attempt == MOST_ATTEMPTS:
            left = {r["kind"]: r["count"] for r in pending.groupBy("kind").count().collect()}
            raise RuntimeError(f"no surrogates left, values by kind: {left}")


def _spelled(word: Column, surrogate: Column) -> Column:
    """A surrogate word in the case of the original one."""
    capital = F.concat(F.upper(F.substring(surrogate, 1, 1)), F.substr(surrogate, F.lit(2)))
    hyphens = F.array_join(F.transform(F.split(capital, "-"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), "-")
    return F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(surrogate)).otherwise(hyphens)


def _written(entity: Column, lookup: Column) -> Column:
    """The entity with its surrogates, in its own form. `lookup` maps kind and value to the surrogate."""
    parts = units(entity)
    found = F.transform(parts, lambda u: F.element_at(lookup, F.concat_ws("\u0001", u["kind"], u["value"])))
    kind = kind_of(entity)
    # The n-th digit (for account numbers also letter) of the original makes room for the n-th of the surrogate.
    keep = F.when(kind == "iban", F.lit("[^0-9A-Z]")).otherwise(F.lit("[^0-9]"))
    # The surrogate of a number without a plus has a country code more, or no 00 before it; a 00 stays.
    shift = F.when(kind == "local", F.length(parts[0]["value"]) - F.length(F.regexp_replace(entity, "[^0-9]", ""))).otherwise(0)

    def place(i: Column) -> Column:
        return F.length(F.regexp_replace(F.substring(entity, F.lit(1), i + 1), keep, F.lit(""))) + shift

    behind = F.substr(found[0], F.length(parts[0]["value"]) + 1)  # what a longer surrogate has beyond the original's digits
    filled = F.array_join(
        F.transform(
            F.split(entity, ""),
            lambda c, i: F.when(
                (F.regexp_replace(c, keep, F.lit("")) != "") & (place(i) > 0), F.substring(found[0], place(i), F.lit(1))
            ).otherwise(c),
        ),
        "",
    )
    words = _name_words(entity)
    title = F.substr(entity, F.lit(1), F.length(entity) - F.length(F.array_join(words, " ")))
    name = F.concat(title, F.array_join(F.transform(words, lambda w, i: _spelled(w, F.get(found, i))), " "))
    whole = F.when((entity == F.upper(entity)) & (entity != F.lower(entity)), F.upper(found[0])).otherwise(found[0])
    return F.when(kind.isin("phone", "local", "ssn", "card", "iban"), F.concat(filled, behind)).when(kind == "name", name).otherwise(whole)


def replace_personal_data(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """`docs` with every entity of its texts replaced; all columns stay, `count_col` adds the number of entities.

    NULL, empty and entity-free texts stay as they are. Repeated rows are kept and
    changed alike. The same key gives the same surrogates for the same set of
    values. Other columns are carried along, whatever their names. An empty table
    gives an empty result.
    """
    if not key:
        raise ValueError("a key is needed")
    names = docs.columns
    wrapped = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    text = F.col("row").getField(text_col)
    entities = F.when(text.rlike(HINT), _all(text, ANY))
    has = F.coalesce(F.size(entities) > 0, F.lit(False))
    clean = wrapped.where(~has).select("row", text.alias("_text"), F.lit(0).cast("long").alias("_count"))
    held = kept(wrapped.where(has).withColumn("_key", F.monotonically_increasing_id()))

    occurring = held.select("_key", F.explode(F.array_distinct(_all(text, ANY))).alias("entity"))
    occurring = kept(occurring.select("_key", F.explode(units(F.col("entity"))).alias("u")).select("_key", "u.kind", "u.value").distinct())
    given = kept(assign(occurring, key))
    named = occurring.join(given, ["kind", "value"])
    lookups = named.groupBy("_key").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\u0001", "kind", "value"), "surrogate"))).alias("_lookup")
    )
    joined = held.join(lookups, "_key")
    parts = joined.select("row", "_lookup", F.split(text, ANY, -1).alias("_parts"), _all(text, ANY).alias("_found"))
    changed_text = F.array_join(
        F.transform(
            "_parts",
            lambda p, i: F.concat(p, F.coalesce(F.when(i < F.size("_found"), _written(F.get("_found", i), F.col("_lookup"))), F.lit(""))),
        ),
        "",
    )
    changed = parts.select("row", changed_text.alias("_text"), F.size("_found").cast("long").alias("_count"))
    # The row is taken apart last, so its names cannot clash with those used here.
    columns = [F.col("_text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in names]
    counts = [F.col("_count").alias(count_col)] if count_col else []
    return clean.unionByName(changed).select(*columns, *counts)
