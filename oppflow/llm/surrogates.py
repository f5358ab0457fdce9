"""Keyed surrogates for personal data, in DataFrame functions only.

One pattern finds the mentions of every text: e-mail addresses, phone, card and social security
numbers, IBANs, IP addresses, secrets by form or after their key, and names after a title or a known first name.  Every mention is one
or more entities in canonical form (lower case, or digits only), so spellings of one entity meet.  The distinct entities
of the corpus get a surrogate from a keyed SHA-512 of type and canonical form: same type, format, script and gender,
never routable or issued where such ranges exist.

Collision check: of entities that draw the same surrogate the alphabetically first keeps it, and no
surrogate may be an entity of the corpus; the others draw again.  So different entities stay different, and an entity has
one surrogate in all documents.  The key decides all; without it surrogates cannot be traced.

Coreference: where a document names a person, the bare surname gets the same surrogate in the rest of that document.  Such
bare surnames are not counted as mentions.  Function words are no surnames; names of streets, days and institutions, and
version numbers, are no personal data and stay.

Null texts stay null, texts without mentions stay as they are.  Repeated rows are treated alike.  All columns
are kept; a column ``n_chars`` is brought up to date.  An empty table gives an empty result.  Very long texts are treated
whole, in their row.
"""
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oppflow.session import cut

# ---- fixed values: titles and common first names by gender, letters by script, syllables of made-up surnames
TITLES = {"m": "Mr Herr Monsieur Señor Sr Господин Κύριος Κύριε", "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Госпожа Κυρία", "u": "Dr Prof Dra"}
FIRST_NAMES = {
    ("latin", "m"): "James John Robert Michael David Thomas Daniel Paul Peter Martin Lukas Pierre Carlos Miguel Hans Klaus"
    " William George Charles Richard Joseph Andrew Stephen Stefan Wolfgang Jürgen Jean François Juan José Luis Marco Giovanni Ahmed Mohammed Omar Arjun Rahul Wei Hiroshi Kenji",
    ("latin", "f"): "Mary Anna Linda Susan Karen Laura Emma Julia Sophie Marie Elena Carmen Claire Petra Ingrid Monika"
    " Elizabeth Sarah Jennifer Patricia Barbara Margaret Alice Ursula Sabine Nathalie Isabelle Ana Lucía Sofia Giulia Fatima Aisha Priya Anjali Yuki Keiko",
    ("cyrillic", "m"): "Иван Пётр Сергей Андрей Дмитрий Алексей Николай Михаил Павел Юрий Олег Игорь Борис Виктор Антон Роман",
    ("cyrillic", "f"): "Анна Мария Елена Ольга Татьяна Наталья Ирина Светлана Юлия Дарья Вера Нина Лидия Галина Софья Тамара",
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παναγιώτης Βασίλης Χρήστος Θανάσης Μιχάλης Σπύρος Στέλιος",
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Βασιλική Σοφία Αγγελική Γεωργία Δήμητρα Ιωάννα Χριστίνα Παρασκευή Αναστασία",
}
SYLLABLES = {
    "latin": "bar bel bor dal den dor fal fen gar hal hen jor kal kel lan len lor mar mel mor nal nor pal ren ros sal sel tan tor val ven wes",
    "greek": "βαλ βερ γαλ γερ δαν δορ ζαλ θαλ καλ κελ κορ λαν λεν λορ μαρ μελ μον ναρ νελ παλ περ ραν ροδ σαλ σελ ταν τορ φαλ φεν χαλ χερ ψαλ",
    "cyrillic": "бар бел бор вал вел гор дан дор зар кал кел кор лан лен лор мар мел мор нал нор пал рен рос сал сел сор тан тел тор фал хан чер",
}
# what follows or precedes a name that names a street, a day or an institution; capitalised words that are no surnames
NAMED_AFTER = "Day Street St Road Rd Avenue Ave Boulevard Drive Lane Square Park Bridge Airport University College School Hospital Prize Straße Strasse Platz Allee Weg"
NAMED_BEFORE = "Rue Place Calle Avenida Plaza Via Улица Проспект"
NO_SURNAMES = (
    "The This That These Those He She It We They You His Her Our In On At Of And But Or If As Is Was Are Has To By For From With Not Der Die Das Den Dem "
    "Ein Eine Und Oder Ist War Im Am Er Sie Es Wir Ich Le La Les Un Une Et Ou Il Elle Est Dans El Los Las Una En Es De Del Du Des")
LETTERS = {"cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
# ----

_TITLE = "(?:" + "|".join(" ".join(TITLES.values()).split()) + r")\.?"
_KNOWN = "(?:" + "|".join(" ".join(FIRST_NAMES.values()).split()) + ")"
# an apostrophe or hyphen inside, but not before a genitive s or the end
_NAME = r"\p{Lu}(?:'\p{Lu})?\p{Ll}(?:\p{L}|['’\-](?!s?(?!\p{L}))){0,30}"
_NO_PLACE = rf"(?!(?: {_NAME}){{0,3}} (?:{'|'.join(NAMED_AFTER.split())})(?!\p{{L}}))"
_PLACE_BEFORE = rf"(?<!(?:{'|'.join(NAMED_BEFORE.split())}) )"
_SEP = r"(?: ?\(|\)[ .\-/]?|[ .\-/])?"  # between the digits of a phone number
_HEX = "[0-9a-fA-F]{1,4}"
_BARE_SECRET = (
    r"[0-9a-fA-F]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64}|xox[abeoprs]-[A-Za-z0-9\-]{10,250}|AIza[0-9A-Za-z_\-]{35}"
    r"|eyJ[A-Za-z0-9_\-]{5,4000}\.[A-Za-z0-9_\-]{5,4000}\.[A-Za-z0-9_\-]{5,2000}")
# what stands before a value that is a secret; unquoted values need a character that is no letter
_SECRET_KEY = r"(?i:password|passwd|passphrase|pwd|secret|token|(?:api|access|secret|private)[_\-]?key)[\"']?[ ]{0,2}[=:][ ]{0,2}"
_SECRET_VALUE = r"(?:\"[^\"\s]{4,128}\"|'[^'\s]{4,128}'|(?=[^\s\"'<>,;&()]{0,127}[0-9!@#$%^*+?])[^\s\"'<>,;&()]{6,128})"
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+\-]++@(?:[\p{L}\p{N}\-]{1,63}\.){1,8}\p{L}{2,24}",
    "secret": rf"(?<![\p{{L}}\p{{N}}])(?:{_BARE_SECRET})(?![\p{{L}}\p{{N}}])",
    "keyed": rf"(?<![\p{{L}}\p{{N}}]){_SECRET_KEY}{_SECRET_VALUE}",
    "iban": r"(?<![\p{L}\p{N}])(?=[A-Z]{2}(?:[A-Z ]{0,7}\d){10})[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}])(?:\+?\d{1,3}[ .\-]?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]\d{3,4}|\+\d{8,15}"
             # a plus and 7 to 15 digits in any groups, but no decimal; 00 and a country code
             rf"|\+(?!\d{{1,15}}[.]\d{{1,15}}(?![.\d]))\d(?:{_SEP}\d){{6,14}}|00[1-9]\d{{0,2}}[ .\-/](?:{_SEP}\d){{5,12}}"
             r"|\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4}|[2-9]\d{2} \d{3} \d{4}"
             # national numbers after a 0: 7 to 15 digits
             r"|(?<!\d[.,])(?=(?:\D{0,2}\d){7})(?!(?:[ \-/()]{0,2}\d){16})(?:\(0\d{0,5}\)[ \-/]?\d{2,9}|0[1-9]\d{1,4}[ /\-]\d{3,9})(?:[ \-]\d{2,5}){0,4}"
             r"|(?<!\d[.,])0[1-9](?:[ .\-]\d\d){4})(?!\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}|\d{4}[ \-]\d{6}[ \-]\d{4,5})(?!\d)",
    "ip": r"(?<![\d.])(?=\d{1,3}\.\d)(?<!(?i:[^\p{L}]v|version|release|build)[ :.]{0,2})\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)",
    # eight groups, or fewer with :: and a digit
    "ip6": rf"(?<![\p{{L}}\p{{N}}:])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[a-fA-F:]{{0,39}}\d)(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|(?=[a-fA-F:]{{0,39}}\d)(?:{_HEX}:){{2,7}}:)(?![\p{{L}}\p{{N}}:])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?=(?:{_TITLE}|{_KNOWN}) ){_PLACE_BEFORE}(?:(?:{_TITLE} ){{1,3}}(?!{_TITLE}(?!\p{{L}})){_NAME}(?: {_NAME}){{0,2}}|{_KNOWN} {_NAME})(?![\p{{L}}\p{{N}}]){_NO_PLACE}",
}
# The patterns in their order, each group behind what all of its members begin with: few positions of a text try more than that.
# An address begins where its run of characters does, or where the mention before it ended.
_HEAD = r"[\p{L}\p{N}._%+\-]"
MENTION = (
    rf"(?:(?<!{_HEAD})|\G){PATTERNS['email']}"
    rf"|(?=[\p{{L}}\p{{N}}+(])(?<![\p{{L}}\p{{N}}])(?:(?=[0-9a-fA-FgsxAe]){PATTERNS['secret']}|(?=[pstaPSTA]){PATTERNS['keyed']}|{PATTERNS['iban']}"
    rf"|(?=[+(\d]){PATTERNS['phone']})"
    rf"|(?=\d)(?:{PATTERNS['ssn']}|{PATTERNS['card']}|{PATTERNS['ip']})"
    rf"|(?=[0-9a-fA-F]{{1,4}}:){PATTERNS['ip6']}|(?=\p{{Lu}}){PATTERNS['name']}")
FOUND_TYPES = list(PATTERNS)
MOST_ROUNDS = 100


def kind_of(mention: Column) -> Column:
    """The type of a mention: the first pattern that covers it."""
    out = F.lit(None).cast("string")
    for kind in reversed(FOUND_TYPES):
        out = F.when(mention.rlike(rf"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def script_of(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def gender_of(token: Column) -> Column:
    bare = F.regexp_replace(token, r"\.$", "")
    out = F.lit("u")
    for gender in ("m", "f"):
        words = TITLES[gender].split() + [n for (_, g), names in FIRST_NAMES.items() if g == gender for n in names.split()]
        out = F.when(bare.isin(words), gender).otherwise(out)
    return out


def name_parts(mention: Column) -> Column:
    """Parts of a name: titles as they are, then first names by gender, last a surname."""
    tokens = F.split(mention, " ")
    titled = mention.rlike(rf"^{_TITLE} ")
    gender = gender_of(F.get(tokens, F.lit(0)))

    def part(token: Column, i: Column) -> Column:
        first = F.concat(F.lit("first_"), F.when(gender != "u", gender).otherwise(gender_of(token)), F.lit("_"), script_of(token))
        last = F.concat(F.lit("last_"), script_of(token))
        title = (i == 0) | F.regexp_replace(token, r"\.$", "").isin(" ".join(TITLES.values()).split())
        kind = F.when(titled & title, "as_is").when(i == F.size(tokens) - 1, last).otherwise(first)
        return F.struct(i.alias("pos"), kind.alias("type"), F.lower(token).alias("canon"), F.lit("").alias("before"), token.alias("raw"), F.lit("").alias("after"))
    return F.transform(tokens, part)


def full_ip6(address: Column) -> Column:
    """All eight groups, without leading zeros."""
    halves = F.split(F.lower(address), "::")
    left, right = (F.filter(F.split(F.coalesce(F.get(halves, F.lit(i)), F.lit("")), ":"), lambda x: x != "") for i in (0, 1))
    zeros = F.array_repeat(F.lit("0"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
    return F.array_join(F.transform(F.concat(left, zeros, right), lambda x: F.regexp_replace(x, "^0+(?=.)", "")), ":")


def parts_of(mention: Column) -> Column:
    """Entities in a mention: array of (pos, type, canon, before, raw, after); what is around the entity stays."""
    found = kind_of(mention)
    keyed = found == "keyed"
    before = F.when(keyed, F.regexp_extract(mention, rf"^({_SECRET_KEY}[\"']?)", 1)).otherwise("")
    after = F.when(keyed, F.regexp_extract(mention, r"([\"']?)$", 1)).otherwise("")
    mention = F.substring(mention, F.length(before) + 1, F.length(mention) - F.length(before) - F.length(after))
    kind = F.when(keyed & mention.rlike(f"^(?:{_BARE_SECRET})$"), "secret").otherwise(found)
    country = F.regexp_extract(mention, r"^\+(\d{1,3})[ .(/\-]", 1)
    digits = only_digits(mention)
    canon = (
        F.when(kind == "phone", F.concat_ws("|", country, F.substring(digits, F.length(country) + 1, F.length(digits))))
        .when(kind.isin("card", "ssn"), digits).when(kind.isin("ip", "keyed"), mention).when(kind == "ip6", full_ip6(mention))
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit(""))).otherwise(F.lower(mention)))
    alone = F.array(F.struct(F.lit(0).alias("pos"), kind.alias("type"), canon.alias("canon"), before.alias("before"), mention.alias("raw"), after.alias("after")))
    return F.when(kind == "name", name_parts(mention)).otherwise(alone)


# ---------------------------------------------------------------- surrogates
def byte_at(seed: Column, i: Column) -> Column:
    """The i-th of the 64 bytes (from 0, around) of a hex digest."""
    return F.conv(F.substring(seed, 2 * (i % 64) + 1, F.lit(2)), 16, 10).cast("int")


def drawn(seed: Column, i: Column, pool: str) -> Column:
    """A character of ``pool`` chosen by byte i of the seed."""
    return F.substring(F.lit(pool), byte_at(seed, i) % len(pool) + 1, F.lit(1))


def shaped(text: Column, seed: Column, latin: str) -> Column:
    """Every letter and digit replaced by another of its script and kind."""
    chars = F.split(text, "")

    def other(c: Column, i: Column) -> Column:
        out = F.when(c.rlike("[0-9]"), drawn(seed, i, "0123456789"))
        for script, pool in LETTERS.items():
            out = out.when(c.rlike(rf"\p{{Is{script.capitalize()}}}"), drawn(seed, i, pool))
        return out.when(c.rlike(r"\p{L}"), drawn(seed, i, latin)).otherwise(c)
    return F.array_join(F.transform(chars, other), "")


def digit_run(seed: Column, n: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: drawn(seed, i, "0123456789")), "")


def luhn(digits: Column) -> Column:
    """``digits`` with their check digit."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 0, twice).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.concat(digits, ((10 - total % 10) % 10).cast("string"))


def picked(pools: dict[str, str], key: Column, seed: Column, n: Column, joint: str) -> Column:
    """``n`` words of the pool named by ``key``, chosen by bytes of the seed."""
    out = F.lit(None).cast("string")
    for name, words in pools.items():
        out = F.when(key == name, F.array_join(F.transform(F.sequence(F.lit(1), n), word_of(words.split(), seed)), joint)).otherwise(out)
    return out


def word_of(words: list[str], seed: Column):
    listed = F.array(*[F.lit(w) for w in words])
    return lambda i: F.get(listed, byte_at(seed, i) % len(words))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """Canonical form of the surrogate."""
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"), F.lit(key)), 512)
    local, tail = F.split_part(canon, F.lit("@"), F.lit(1)), F.substring(seed, 101, 4)
    address = F.concat(shaped(local, seed, "abcdefghijklmnopqrstuvwxyz"), F.lit("@mail"), tail, F.lit(".example."), F.get(
        F.array(*[F.lit(x) for x in ("com", "net", "org")]), byte_at(seed, F.lit(60)) % 3))
    country, digits = F.split_part(canon, F.lit("|"), F.lit(1)), F.split_part(canon, F.lit("|"), F.lit(2))
    trunk = F.regexp_extract(digits, "^0{0,2}", 0)  # a trunk or exit prefix stays
    run = F.length(digits) - F.length(trunk)
    number = F.concat(trunk, drawn(seed, F.lit(63), "23456789"), F.substring(digit_run(seed, run), F.lit(2), run))
    groups = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.regexp_replace(F.substring(seed, 4 * i + 1, F.lit(4)), "^0+(?=.)", ""))
    octets = F.concat_ws(".", (F.lit(240) + byte_at(seed, F.lit(0)) % 16).cast("string"), *[byte_at(seed, F.lit(i)).cast("string") for i in (1, 2, 3)])
    firsts = {f"first_{g}_{s}": FIRST_NAMES[s, g] for s, g in FIRST_NAMES} | {f"first_u_{s}": FIRST_NAMES[s, "m"] + " " + FIRST_NAMES[s, "f"] for s in SYLLABLES}
    lasts = {f"last_{s}": SYLLABLES[s] for s in SYLLABLES}
    return (
        F.when(kind == "email", address)
        .when(kind == "phone", F.concat_ws("|", country, number))
        .when(kind == "card", luhn(digit_run(seed, F.length(canon) - 1)))
        .when(kind == "ssn", F.concat(F.lit("9"), digit_run(seed, F.length(canon) - 1)))  # numbers from 900 are never issued
        .when(kind == "ip", octets)  # 240/4 is reserved
        .when(kind == "ip6", F.concat(F.lit("2001:db8:"), F.array_join(groups, ":")))  # the documentation range
        .when(kind == "iban", F.concat(F.substring(canon, 1, 2), F.lit("00"), shaped(
            F.substring(canon, F.lit(5), F.length(canon)), seed, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")))  # check digits 00 are never valid
        .when(kind == "keyed", F.substring(seed, 1, 20))
        .when(kind == "secret", shaped(canon, seed, "abcdef"))
        .when(kind.startswith("first_"), F.lower(picked(firsts, kind, seed, attempt + 1, "-")))
        .when(kind.startswith("last_"), picked(lasts, kind, seed, attempt + 3, ""))
    )


def assigned(entities: DataFrame, key: str) -> DataFrame:
    """(type, canon, other): a surrogate for each of the distinct entities, different within a type."""
    taken = entities.select("type", F.col("canon").alias("other"))
    todo, done = entities.withColumn("attempt", F.lit(0)), None
    for _ in range(MOST_ROUNDS):
        drawn_now = cut(todo.withColumn("other", surrogate(F.col("type"), F.col("canon"), F.col("attempt"), key)))
        first = W.partitionBy("type", "other").orderBy("canon")
        good = drawn_now.withColumn("n", F.row_number().over(first)).where("n = 1").join(taken, ["type", "other"], "left_anti")
        good = cut(good.select("type", "canon", "other"))
        done = good if done is None else done.unionByName(good)
        taken = taken.unionByName(good.select("type", "other"))
        todo = cut(drawn_now.join(good, ["type", "canon"], "left_anti").select("type", "canon", (F.col("attempt") + 1).alias("attempt")))
        if todo.isEmpty():
            return done
    raise ValueError("more entities than surrogates of their format")


def rendered(raw: Column, kind: Column, other: Column) -> Column:
    """The surrogate in the spelling of the mention."""
    plain = F.regexp_replace(other, "[^0-9A-Z]", "")  # for formats of digits, or of digits and capitals
    written = F.aggregate(
        F.split(raw, ""), F.struct(F.lit("").alias("t"), F.lit(1).alias("k")),
        lambda acc, c: F.struct(
            F.concat(acc["t"], F.when(c.rlike("[0-9A-Z]"), F.substring(plain, acc["k"], F.lit(1))).otherwise(c)).alias("t"),
            (acc["k"] + c.rlike("[0-9A-Z]").cast("int")).alias("k")))["t"]
    upper = (raw == F.upper(raw)) & (raw != F.lower(raw))
    cased = F.when(upper, F.upper(other)).when(F.substring(raw, 1, 1) != F.lower(F.substring(raw, 1, 1)), F.concat(
        F.upper(F.substring(other, 1, 1)), F.substring(other, F.lit(2), F.length(other)))).otherwise(other)
    named = F.array_join(F.transform(F.split(other, "-"), lambda w: F.initcap(w)), "-")
    return F.when(kind == "as_is", raw).when(kind == "keyed", other).when(kind.isin("phone", "card", "ssn", "iban"), written).when(kind.rlike("^(first|last)_"), named).otherwise(cased)


def mention_table(mentions: DataFrame, key: str) -> DataFrame:
    """(mention, instead, surname) of the distinct mentions; ``surname`` is that of a name, as it was and as it is now."""
    pieces = cut(mentions.select("mention").distinct().select("mention", F.explode(parts_of(F.col("mention"))).alias("p")).select("mention", "p.*"))
    entities = cut(pieces.where("type <> 'as_is'").select("type", "canon").distinct())
    others = cut(assigned(entities, key))
    now = rendered(F.col("raw"), F.col("type"), F.col("other"))
    joined = pieces.join(others, ["type", "canon"], "left").select(
        "mention", F.struct("pos", F.concat("before", now, "after").alias("t")).alias("p"),
        F.when(F.col("type").startswith("last_") & ~F.col("raw").isin(NO_SURNAMES.split()), F.struct(
            (-F.length("raw")).alias("size"), F.col("raw").alias("was"), now.alias("now"))).alias("last"))
    parts = F.transform(F.sort_array(F.collect_list("p")), lambda x: x["t"])
    return joined.groupBy("mention").agg(F.array_join(parts, " ").alias("instead"), F.max("last").alias("surname"))


def interleaved(between: Column, instead: Column) -> Column:
    """The text of n + 1 parts with n others between them."""
    return F.array_join(F.flatten(F.zip_with(between, F.concat(instead, F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")


def with_surnames(part: Column, surnames: Column) -> Column:
    """``part`` with the surnames of its document replaced; longer ones count first."""
    was, now = F.transform(surnames, lambda x: x["was"]), F.transform(surnames, lambda x: x["now"])
    bare = F.concat(F.lit(r"(?=\p{Lu})(?<![\p{L}\p{N}])(?:"), F.array_join(was, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    instead = F.transform(F.regexp_extract_all(part, bare, F.lit(0)), lambda x: F.get(now, (F.array_position(was, x) - 1).cast("int")))
    return interleaved(F.split(part, bare, -1), instead)


def pseudonymised(docs: DataFrame, key: str, doc_key: str = "doc_id", text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``; ``count`` names an extra column with the number of mentions."""
    body = docs[text].cast("string")
    own = F.xxhash64(body)
    found = cut(docs.select(docs[doc_key].alias("k"), own.alias("h"), F.posexplode(F.regexp_extract_all(body, F.lit(MENTION), F.lit(0))).alias("pos", "mention")))
    table = cut(mention_table(found, key))
    lists = found.join(table, "mention").groupBy("k", "h").agg(F.collect_set(F.struct("pos", "instead", "surname")).alias("m"))
    surnames = F.sort_array(F.array_distinct(F.filter(F.transform("m", lambda x: x["surname"]), lambda x: x.isNotNull())))
    lists = lists.select(
        F.col("k").alias("_pii_k"), F.col("h").alias("_pii_h"), F.transform(F.sort_array("m"), lambda x: x["instead"]).alias("_pii_m"),
        surnames.alias("_pii_s"))
    joined = docs.withColumn("_pii_own", own).join(lists, F.col("_pii_own").eqNullSafe(F.col("_pii_h")) & docs[doc_key].eqNullSafe(F.col("_pii_k")), "left")
    between = F.split(body, MENTION, -1)
    settled = F.transform(between, lambda part: with_surnames(part, F.col("_pii_s")))
    joined = joined.withColumn(
        "_pii_text", F.when(F.col("_pii_m").isNull(), body).when(F.size("_pii_s") == 0, interleaved(between, F.col("_pii_m")))
        .otherwise(interleaved(settled, F.col("_pii_m"))))
    out = []
    for c in docs.columns:
        if c == text:
            out.append(F.col("_pii_text").alias(text))
        elif c == "n_chars":
            out.append(F.when(F.col("_pii_m").isNotNull(), F.length("_pii_text")).otherwise(docs[c]).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(docs[c])
    if count:
        out.append(F.coalesce(F.size("_pii_m"), F.lit(0)).cast("long").alias(count))
    return joined.select(*out)
