"""Personal data replaced by keyed surrogates; DataFrame functions only.

Entities are found by patterns, checked (card numbers and IBANs by their check
digits) and reduced to a canonical form, so that spellings of one entity stay one. Each
entity of the corpus gets a keyed hash; digits and letters of its text are
replaced by ones drawn from it, place by place, so length, case, separators,
script and kind stay. Names keep their title and get a name of the same gender
and script; cards and IBANs get right check digits. A surrogate that equals a real entity or another's surrogate is
drawn again, until all differ: equal entities stay equal and different ones
different, across all documents.

Only found entities move between tasks; a frequent one is combined before the
shuffle. Texts are joined once, to their own replacements.

Defined results: a null text stays null, one without entities stays as it is.
Rows with equal id and text get equal results; rows without an id are replaced
too. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperweave.llm.common import fresh, need, quoted
from paperweave.workspace import stage

KEY = "surrogates"

# Titles that go before names, with the gender that they tell.
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Господин", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Госпожа", "Κυρία"],
}
# Given names by gender and script, family names by script.
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Louis Marco Noel Oscar Paul",
    ("f", "latin"): "Anna Berta Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula",
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Игорь Кирилл Максим Никита Олег Павел Роман",
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Инна Лидия Мария Нина Ольга Софья Юлия",
    ("m", "greek"): "Αλέξης Γιώργος Δημήτρης Ηλίας Κώστας Μάριος Νίκος Πέτρος",
    ("f", "greek"): "Άννα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Σοφία",
}
FAMILY = {
    "latin": "Abel Baker Cole Dorn Ellis Frank Grant Hall Iversen Jansen Keller Lang Moreno Novak Olsen Peters",
    "cyrillic": "Белый Волк Громыко Дубко Жук Ивченко Коваль Лысенко Мороз Остапенко Петренко Руденко",
    "greek": "Αγγέλου Βλάχου Γεωργίου Δήμου Ιωάννου Κώστα Μάρκου Νικολάου",
}
_ANY_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "ipv6": r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{4}:)(?=[A-Fa-f]{0,3}[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
            r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36})(?![0-9A-Za-z])",
    # After the bank's, a spaced group needs a digit: words in capitals may follow.
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}(?: ?(?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}){2,6}"
            r"(?: ?(?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9])(?:\+[1-9][0-9]{0,2}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}"
             r"|(?<=\+[1-9][0-9]{0,2}[ .-]?)[0-9]{2,4}(?:[ .-][0-9]{2,4}){2,4})(?![0-9])"
             # With a country code, any grouping of 8 to 15 digits, but no decimal or row of single digits.
             r"|(?<![\p{L}0-9])(?!\+[0-9]+\.[0-9]+(?:[^0-9.-]|$)|\+[0-9]+ [0-9] [0-9](?![0-9]))"
             r"\+[1-9](?:[ .-]?[0-9]){7,14}(?![0-9])"
             # Without one, three, three and four digits with one kind of mark between.
             r"|(?<![0-9.+-])[2-9][0-9]{2}(?:-[0-9]{3}-|\.[0-9]{3}\.)[0-9]{4}(?![0-9]|[.-][0-9])",
    "card": r"(?<![0-9.+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "name": rf"(?<!\p{{L}})(?:{_ANY_TITLE})\.? \p{{Lu}}[\p{{L}}'’-]+(?: \p{{Lu}}[\p{{L}}'’-]+)?",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
HINT = rf"[0-9@]|(?:{_ANY_TITLE})\.? "
LOWER = "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it occurs there."""
    return F.transform(F.array(value), use)[0]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _sum_luhn(digits: Column, doubled: int) -> Column:
    """Sum of the digits; from the right, every second one doubled, beginning with number ``doubled``."""
    def value(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(i % 2 == doubled, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(c.cast("int"))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, b: a + b)


def _iban_rest(country: Column, check: Column, account: Column) -> Column:
    """Remainder by 97 of an IBAN's account, country and check digits, letters as numbers from 10 on; 1 if all is right."""
    def add(rest: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), rest * 10 + c.cast("int")).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.split(F.regexp_replace(F.concat(account, country, check), " ", ""), ""), F.lit(0), add)


def _is_iban(entity: Column) -> Column:
    return _iban_rest(F.substr(entity, F.lit(1), F.lit(2)), F.substr(entity, F.lit(3), F.lit(2)), F.substr(entity, F.lit(5))) == 1


def _drawn_iban(entity: Column, h: Column) -> Column:
    """New account, the same country, right check digits."""
    def checked(new: Column) -> Column:
        country, account = F.substr(new, F.lit(1), F.lit(2)), F.substr(new, F.lit(5))
        check = F.lpad((F.lit(98) - _iban_rest(country, F.lit("00"), account)).cast("string"), 2, "0")
        return F.concat(country, check, account)

    return _let(_drawn(entity, h, keep=2), checked)


def kind_of(entity: Column) -> Column:
    """The entity's kind; null for what only looks like a card or an IBAN."""
    out = F.when(entity.contains("@"), "email")
    for kind in ("ip", "ipv6", "secret", "iban", "ssn", "phone"):
        found = F.when(_is_iban(entity), kind) if kind == "iban" else kind
        out = out.when(entity.rlike(f"^(?:{PATTERNS[kind]})$"), found)
    out = out.when(entity.rlike(r"^[0-9 -]+$"), F.when(_sum_luhn(_digits(entity), 1) % 10 == 0, "card"))
    return out.otherwise("name")


def _gender(entity: Column) -> Column:
    return F.when(entity.rlike(f"^(?:{'|'.join(TITLES['f'])})\\.? "), "f").otherwise("m")


def _without_title(entity: Column) -> Column:
    return F.regexp_replace(entity, rf"^(?:{_ANY_TITLE})\.? ", "")


def canonical(kind: Column, entity: Column) -> Column:
    """One spelling per entity."""
    return (F.when(kind.isin("phone", "card", "ssn"), _digits(entity))
            .when(kind.isin("email", "ipv6"), F.lower(entity))
            .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
            .when(kind == "name", F.concat(_gender(entity), F.lit(":"), F.lower(_without_title(entity))))
            .otherwise(entity))


def _number(h: Column, i: Column) -> Column:
    """The i-th number below 65536 of a hash of 128 hexadecimal digits."""
    return F.conv(F.substr(h, (i * 3) % 125 + 1, F.lit(4)), 16, 10).cast("int")


def _pick(letters: str, h: Column, i: Column) -> Column:
    return F.substr(F.lit(letters), _number(h, i) % len(letters) + 1, F.lit(1))


def _drawn(entity: Column, h: Column, keep: int = 0, letters: str = LOWER) -> Column:
    """The entity with new digits and letters, all but the first ``keep`` of them; one draw per letter or digit."""
    def put(state: Column, c: Column) -> Column:
        i = state["i"]
        new = (F.when(~c.rlike(r"[\p{L}0-9]") | (i < keep), c)
               .when(c.rlike("[0-9]"), _pick("0123456789", h, i))
               .when(c.rlike("[A-Z]"), F.upper(_pick(letters, h, i)))
               .when(c.rlike(r"\p{IsCyrillic}"), _pick("абвгдежзиклмнопрстуфхцчшщэюя", h, i))
               .when(c.rlike(r"\p{IsGreek}"), _pick("αβγδεζηθικλμνξοπρστυφχψω", h, i))
               .otherwise(_pick(letters, h, i)))
        return F.struct(F.concat(state["s"], new).alias("s"),
                        (i + c.rlike(r"[\p{L}0-9]").cast("int")).alias("i"))

    first = F.struct(F.lit("").alias("s"), F.lit(0).alias("i"))
    return F.aggregate(F.split(entity, ""), first, put)["s"]


def _listed(names: dict, key: Column, h: Column, i: int) -> Column:
    out = F.lit(None).cast("string")
    for k, words in names.items():
        items = words.split()
        item = F.element_at(F.array(*[F.lit(w) for w in items]), _number(h, F.lit(i)) % len(items) + 1)
        out = F.when(key == (k if isinstance(k, str) else "".join(k)), item).otherwise(out)
    return out


def surrogate(kind: Column, entity: Column, h: Column, attempt: Column) -> Column:
    """A text like the entity, drawn from its hash. Canonical forms give canonical forms."""
    first_digit = _drawn(entity, h, keep=1)
    # The last digit of a card makes its check digit right.
    body = F.regexp_replace(first_digit, "[0-9]$", "")
    card = F.concat(body, ((F.lit(10) - _sum_luhn(_digits(body), 0) % 10) % 10).cast("string"))
    octets = F.array_join(F.transform(F.split(entity, r"\."), lambda _, i: (
        _number(h, i * 5) % 254 + 1).cast("string")), ".")
    # A few addresses are so short that new letters alone may not tell them apart.
    local = F.substring_index(entity, "@", 1)
    domain = F.regexp_replace(F.substring_index(entity, "@", -1), r"\.[A-Za-z0-9-]+$", "")
    top = F.regexp_extract(entity, r"\.[A-Za-z0-9-]+$", 0)
    extra = F.when(attempt > 2, attempt.cast("string")).otherwise("")
    email = F.concat(_drawn(F.concat(local, F.lit("@"), domain), h), extra, top)

    title = F.regexp_extract(entity, rf"^(?:(?:{_ANY_TITLE})\.? |[mf]:)", 0)
    name = F.substr(entity, F.char_length(title) + 1)
    gender = F.when(entity.rlike("^[mf]:"), F.substring(entity, 1, 1)).otherwise(_gender(entity))
    script = F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    initials = F.when(attempt > 0, F.concat(F.lit(" "), F.upper(_drawn(
        F.repeat(F.lit("a"), F.least(attempt, F.lit(20))), F.reverse(h))), F.lit("."))).otherwise("")
    family = F.when(name.contains(" "), F.concat(F.lit(" "), _listed(FAMILY, script, h, 2))).otherwise("")
    full = F.concat(_listed(GIVEN, F.concat(gender, script), h, 1), initials, family)
    named = F.concat(title, F.when(entity.rlike("^[mf]:"), F.lower(full)).otherwise(full))

    hexed = F.when(entity.rlike("^[0-9A-Fa-f]+$"), _drawn(entity, h, letters="abcdef")).otherwise(_drawn(entity, h, keep=4))
    return (F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "secret", hexed)
            .when(kind == "ipv6", _drawn(entity, h, letters="abcdef")).when(kind == "iban", _drawn_iban(entity, h)).when(kind == "ssn", _drawn(entity, h))
            .when(kind == "phone", first_digit).when(kind == "card", card).when(kind == "name", named))


def _hash(kind: Column, entity: Column, attempt: Column, key: str) -> Column:
    seed = F.concat_ws("|", F.lit(key), kind, entity, attempt.cast("string"))
    return F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("|")), 256))


def entities(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, pos, kind, entity, canonical) of every entity; ``pos`` counts all pattern matches of the text from 0."""
    need(docs, id_column, text)
    rows = docs.select(quoted(id_column).cast("string").alias("id"), quoted(text).alias("text")).filter(F.col("text").rlike(HINT))
    found = rows.select("id", F.xxhash64("text").alias("row"), F.posexplode(
        F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias("pos", "entity"))
    return found.withColumn("kind", kind_of(F.col("entity"))).filter("kind is not null").withColumn(
        "canonical", canonical(F.col("kind"), F.col("entity")))


def assign(found: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, canonical, attempt, taken): a different surrogate, no real entity, for every entity."""
    real = stage(found.select("kind", "canonical").distinct(), "entities")
    rounds, waiting = [], real.withColumn("attempt", F.lit(0))
    while True:
        h = _hash(F.col("kind"), F.col("canonical"), F.col("attempt"), key)
        drawn = waiting.withColumn("h", h).withColumn(
            "taken", surrogate(F.col("kind"), F.col("canonical"), F.col("h"), F.col("attempt"))).drop("h")
        used = real.select("kind", F.col("canonical").alias("taken"), F.lit(True).alias("used"), F.lit(None).cast("string").alias("owner"))
        for earlier in rounds:
            used = used.unionAll(earlier.select("kind", "taken", F.lit(True), F.lit(None).cast("string")))
        claims = used.unionAll(drawn.select("kind", "taken", F.lit(False), "canonical")).groupBy("kind", "taken").agg(
            F.max("used").alias("used"), F.min("owner").alias("owner"))
        judged = stage(drawn.join(claims, ["kind", "taken"]).select(
            "kind", "canonical", "attempt", "taken", (~F.col("used") & (F.col("owner") == F.col("canonical"))).alias("good")),
            "surrogates")
        rounds.append(judged.filter("good").drop("good"))
        waiting = judged.filter("not good").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        if waiting.isEmpty():
            break
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out


def replace_entities(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", key: str = KEY, count: str | None = None,
) -> DataFrame:
    """``docs`` with surrogates in ``text``; ``count`` names a column for how many each row got."""
    found = stage(entities(docs, id_column, text), "found-entities")
    known = assign(found, key).select("kind", "canonical", "attempt")
    placed = found.join(known, ["kind", "canonical"]).groupBy("id", "row").agg(
        F.map_from_entries(F.collect_set(F.struct("pos", "attempt"))).alias("attempts"))
    a, b, c = fresh(docs, "_id", "_row", "_attempts")
    placed = placed.select(F.col("id").alias(a), F.col("row").alias(b), F.col("attempts").alias(c))
    t = quoted(text)
    # No broadcast: what a corpus has of entities has no bound.
    joined = docs.join(placed.hint("merge"), quoted(id_column).cast("string").eqNullSafe(F.col(a)) & (F.xxhash64(t) == F.col(b)), "left")

    def replaced(entity: Column, i: Column) -> Column:
        attempt = F.element_at(F.col(c), i)
        new = _let(kind_of(entity), lambda kind: _let(
            _hash(kind, canonical(kind, entity), attempt, key), lambda h: surrogate(kind, entity, h, attempt)))
        return F.when(attempt.isNull(), entity).otherwise(new)

    between = F.split(t, PATTERN, -1)
    new = F.transform(F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0)), replaced)
    rebuilt = F.array_join(F.zip_with(between, new, lambda x, y: F.concat(x, F.coalesce(y, F.lit("")))), "")
    changed = F.when(F.col(c).isNull(), t).otherwise(rebuilt)
    n = [F.coalesce(F.size(c), F.lit(0)).cast("bigint").alias(count)] if count else []
    return joined.select(*[changed.alias(x) if x == text else quoted(x) for x in docs.columns], *n)
