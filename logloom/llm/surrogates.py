"""PII: detected entities get keyed, type-consistent surrogates.

One pattern finds mail addresses, secrets, card numbers, account numbers, network addresses, phone
numbers and titled names. A surrogate depends on a secret key, the entity's type and its canonical
form alone, so every mention of one entity gets the same surrogate in all documents. It keeps what
readers and parsers rely on: digits stay digits and letters letters in the mention's own format
and case; a card number keeps its check digit valid if it was; address bytes stay in range; equal
mail domains stay equal. Names are entities word by word, by script: the titles of all mentions of
a given name tell its gender, and in a document that names a person with a title, the words of that
name are replaced wherever else they stand.

Surrogates are checked over the whole corpus: one that equals another entity's surrogate, or any
entity found, is drawn again with the next attempt number until all are distinct. From the eighth
attempt on it grows, so the draws end even where a format has fewer values than entities. Columns,
joins and windows only; documents without entities do not move.

Defined cases: NULL stays NULL and has no entity. Mentions overlap never: the leftmost wins, then
the order of `PATTERNS`. A given name with titles of both genders, or of none, has neither's form.
Bare words of a name are replaced if capitalised, and are not listed as entities. Repeated rows and
ids are treated alike. An empty table gives an empty result. Other columns are kept by `replaced`; if
one is called `entities`, the list's name gets underscores until it is free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.once import let, once
from logloom.llm.common import packed, same_row, stored
from logloom.operators.lookup import lookup_join

#: Titles that tell a gender, and titles that do not.
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа", "Κυρία")
NEUTRAL = ("Dr", "Prof")
_TITLE = "(?:" + "|".join((*MALE, *FEMALE, *NEUTRAL)) + ")\\.?"

PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}|(?:AKIA|ASIA)[0-9A-Z]{16}|sk-[A-Za-z0-9]{20,64}"
              r"|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![0-9.+-])[0-9]{4}(?:([ -]?)[0-9]{4})(?:\1[0-9]{4})\1[0-9]{1,7}(?![0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}"
          r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"
             r"(?![0-9])|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[-.][0-9]{4}(?![0-9])"
             r"|(?<![0-9A-Za-z-])[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}(?![0-9-])",
    "name": r"(?<!\p{L})" + _TITLE + r"(?: \p{Lu}[\p{Ll}\p{M}]+(?:-\p{Lu}[\p{Ll}\p{M}]+)?){1,3}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these has no entity; it keeps the pattern off most texts.
HINT = ("[0-9]{3}|@|[0-9]\\.[0-9]|[+][0-9]|[A-Z]{2}[0-9]{2}|[0-9a-f]{32}|AKIA|ASIA|sk-|gh[pousr]_"
        "|(?<!\\p{L})" + _TITLE + " \\p{Lu}")

#: Given names and syllables of invented surnames, by script and gender.
GIVEN = {
    ("latin", "f"): "Ada Berta Clara Dora Emma Flora Greta Hanna Ida Julia Karla Lena Mara Nora Olga Paula",
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Max Noah Otto Paul",
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Ольга София",
    ("cyrillic", "m"): "Антон Борис Виктор Денис Иван Максим Олег Павел",
    ("greek", "f"): "Αννα Ελενη Ζωη Ιρις Μαρια Νικη Σοφια Χλοη",
    ("greek", "m"): "Αρης Γιωργος Δημος Ηλιας Κωστας Νικος Πετρος Στελιος",
}
SYLLABLES = {
    "latin": "ba be bo da de do ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va",
    "cyrillic": "ба бе бо да де до ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то ва",
    "greek": "βα βε βο δα δε δο κα κε κο λα λε λο μα με μο να νε νο ρα ρε ρο σα σε σο τα τε το φα",
}


def kind_of(mention: Column) -> Column:
    """The first type whose pattern matches the whole mention."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return out


def script_of(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(
        word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def one_of(titles: tuple, mention: Column) -> Column:
    return mention.rlike("^(?:" + "|".join(titles) + r")\.? ")


def parts_of(kind: Column, mention: Column) -> Column:
    """(what, canonical, form) of the entities in a mention: one for each word of a name, two for an
    address.

    `what` is the type with all that a surrogate must keep, such as the script. `form` is what this
    mention tells of a name's word: a surname, or a given name's gender.
    """
    digits = F.regexp_replace(mention, "[^0-9]", "")
    plain = F.regexp_replace(mention, "[ -]", "")
    gender = F.when(one_of(FEMALE, mention), "f").when(one_of(MALE, mention), "m").otherwise("n")
    words = F.split(F.regexp_replace(mention, "^" + _TITLE + " ", ""), " ")

    def part(what: Column, canonical: Column, form: Column | None = None) -> Column:
        return F.struct(what.alias("what"), canonical.alias("canonical"),
                        (F.lit("") if form is None else form).alias("form"))

    def word(x: Column, i: Column) -> Column:
        form = F.when(i < F.size(words) - 1, gender).otherwise("")
        return part(F.concat(F.lit("name_"), script_of(x)), F.lower(x), form)

    def single(what: Column, canonical: Column) -> Column:
        return F.array(part(what, canonical))

    address = F.lower(mention)
    return (
        F.when(kind == "name", F.transform(words, word))
        .when(kind == "email", F.array(
            part(F.lit("email"), address), part(F.lit("domain"), F.substring_index(address, "@", -1))))
        .when(kind == "secret", single(F.lit("secret"), mention))
        .when(kind == "iban", single(F.lit("iban"), plain))
        .when(kind == "ip", single(F.lit("ip"), mention))
        .otherwise(single(kind, digits))
    )


def stream(key: str, attempt: Column) -> Column:
    """128 hexadecimal digits that depend on key, type, canonical form and attempt."""
    seed = F.concat_ws("\x1f", F.lit(key), F.col("what"), F.col("canonical"),
                       attempt.cast("string"))
    return F.sha2(seed, 512)


def drawn(hexes: Column, i: Column, size: int) -> Column:
    """A number below `size` from the stream, for place i (places far apart come round again)."""
    start = F.pmod(i * 3, F.lit(126)) + 1
    return F.pmod(F.conv(F.substring(hexes, start, F.lit(3)), 16, 10).cast("int") + i, F.lit(size))


def letters_for(text: Column, hexes: Column) -> Column:
    """Digits for digits, small and capital letters for their like; all else stays."""
    small, capital = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def pick(alphabet: str, i: Column) -> Column:
        return F.substring(F.lit(alphabet), drawn(hexes, i, len(alphabet)) + 1, F.lit(1))

    return F.array_join(F.transform(F.split(text, ""), lambda c, i: (
        F.when(c.rlike("[0-9]"), drawn(hexes, i, 10).cast("string"))
        .when(c.rlike("[a-z]"), pick(small, i))
        .when(c.rlike("[A-Z]"), pick(capital, i)).otherwise(c))), "")


def hex_for(text: Column, hexes: Column) -> Column:
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: F.substring(
        hexes, F.pmod(i, F.lit(128)) + 1, F.lit(1))), "")


def luhn(digits: Column) -> Column:
    """Sum of a card number's check rule: a valid number's is divisible by ten."""
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(
        c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1),
        lambda x: F.when(x > 9, x - 9).otherwise(x))), F.lit(0), lambda a, x: a + x)


#: Attempts before surrogates grow, by one sign or syllable for every other attempt.
FIXED_ATTEMPTS = 8
#: Endings of made given names by script and gender.
ENDINGS = {("latin", "f"): "na", ("latin", "m"): "n", ("cyrillic", "f"): "на", ("cyrillic", "m"): "н",
           ("greek", "f"): "να", ("greek", "m"): "νος"}


def surrogate(key: str, attempt: Column) -> Column:
    """Surrogate of the canonical form, for a row with `what`, `canonical` and `form`."""
    what, own, form = F.col("what"), F.col("canonical"), F.col("form")
    grown = F.greatest(F.lit(0), F.ceil((attempt - FIXED_ATTEMPTS + 1) / 2)).cast("int")

    def build(hexes: Column) -> Column:
        local, domain = F.substring_index(own, "@", 1), F.substring_index(own, "@", -1)
        label, rest = F.substring_index(own, ".", 1), F.regexp_replace(own, r"^[^.]*", "")
        more = letters_for(F.repeat(F.lit("0"), grown), F.reverse(hexes))
        swapped = letters_for(own, hexes)
        head = F.substring(swapped, F.lit(1), F.length(own) - 1)
        check = F.pmod(10 - luhn(F.concat(head, F.lit("0"))) % 10, F.lit(10)).cast("string")
        card = F.when(luhn(own) % 10 == 0, F.concat(head, check)).otherwise(swapped)
        octets = F.array_join(F.transform(F.split(own, r"\."), lambda c, i: (
            drawn(hexes, i, 254) + 1).cast("string")), ".")
        country = F.when(F.length(own) > 10, F.substring(own, 1, 1)).otherwise("")
        phone = F.concat(country, F.substring(swapped, F.length(country) + 1, F.length(own)))
        out = (
            # the domain is an entity of its own: `written` puts its surrogate here
            F.when(what == "email", F.concat(letters_for(local, hexes), more, F.lit("@"), domain))
            .when(what == "domain", F.concat(letters_for(label, hexes), more, rest))
            .when((what == "secret") & own.rlike("^[0-9a-f]+$"), F.concat(hex_for(own, hexes), more))
            .when(what == "secret", F.concat(
                F.regexp_extract(own, "^(AKIA|ASIA|sk-|gh[pousr]_)", 1),
                letters_for(F.regexp_replace(own, "^(AKIA|ASIA|sk-|gh[pousr]_)", ""), hexes), more))
            .when(what == "iban", F.concat(F.substring(own, 1, 2), letters_for(
                F.substring(own, F.lit(3), F.length(own)), hexes), more))
            .when(what == "ip", F.concat(octets, more)).when(what == "card", F.concat(card, more))
            .when(what == "phone", F.concat(phone, more)).when(what == "ssn", F.concat(swapped, more)))
        for script, syllables in SYLLABLES.items():
            pool = F.array(*(F.lit(s) for s in syllables.split()))
            size = len(syllables.split())
            made = F.array_join(F.transform(
                F.sequence(F.lit(7), F.lit(9) + grown), lambda k: F.get(pool, drawn(hexes, k, size))), "")
            surname = F.concat(made, F.get(pool, drawn(hexes, F.lit(29), size)))
            named = F.when(form == "", surname).otherwise(made)
            for gender in "fm":
                names = GIVEN[script, gender].lower().split()
                given = F.get(F.array(*(F.lit(n) for n in names)), drawn(hexes, F.lit(3), len(names)))
                # lists are short: from the third attempt on, syllables make the name
                given = F.when(attempt < 2, given).otherwise(F.concat(made, F.lit(ENDINGS[script, gender])))
                named = F.when(form == gender, given).otherwise(named)
            out = F.when(what == f"name_{script}", named).otherwise(out)
        return out

    return let(stream(key, attempt), build)


def family() -> Column:
    """Surrogates must be distinct within a type; given names and surnames are apart."""
    return F.regexp_replace("what", "_.*", "")


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """`what, canonical, surrogate` with distinct surrogates that are no entity of the corpus.

    `entities` has `what`, `canonical` and the `form` that each mention tells; an entity gets one.
    """
    told = {g: F.max((F.col("form") == g).cast("int")) == 1 for g in "fmn"}
    form = F.when(told["f"] & told["m"], "n").when(told["f"], "f").when(told["m"], "m").when(
        told["n"], "n").otherwise("")
    rows = entities.groupBy("what", "canonical").agg(form.alias("form"))
    rows = stored(rows.withColumns(
        {"attempt": F.lit(0), "surrogate": surrogate(key, F.lit(0))}), "surrogates")
    names = stored(rows.select(family().alias("of"), F.col("canonical").alias("taken")).distinct(),
                   "entities")
    while True:
        first = Window.partitionBy(family(), "surrogate").orderBy("attempt", "what", "canonical")
        checked = rows.withColumn("nr", F.row_number().over(first))
        checked = checked.join(names, (family() == F.col("of"))
                               & (F.col("surrogate") == F.col("taken")), "left")
        checked = checked.withColumn(
            "again", (F.col("nr") > 1) | F.col("taken").isNotNull()).drop("nr", "of", "taken")
        checked = stored(checked, "checked")
        if checked.filter("again").isEmpty():
            return checked.select("what", "canonical", "surrogate")
        attempt = F.col("attempt") + F.col("again").cast("int")
        rows = stored(checked.select("what", "canonical", "form", attempt.alias("attempt"), F.when(
            F.col("again"), surrogate(key, attempt)).otherwise(F.col("surrogate")
                                                              ).alias("surrogate")), "surrogates")


def in_case(mention: Column, word: Column) -> Column:
    """`word` in capitals, title case or as it is, like the mention."""
    return F.when(mention == F.upper(mention), F.upper(word)).when(
        F.substring(mention, 1, 1) == F.upper(F.substring(mention, 1, 1)),
        F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, F.lit(2), F.length(word)))
    ).otherwise(word)


def in_format(mention: Column, signs: Column) -> Column:
    """The mention with its letters and digits replaced, one by one, by those of `signs`; what is
    left of a grown surrogate follows."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))
    return F.aggregate(F.split(mention, ""), start, lambda s, c: F.when(
        c.rlike("[0-9A-Za-z]"), F.struct(
            F.concat(s["out"], F.substring(signs, s["next"], F.lit(1))).alias("out"),
            (s["next"] + 1).alias("next"))
    ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["next"].alias("next"))),
        lambda s: F.concat(s["out"], F.substring(signs, s["next"], F.length(signs))))


def written(kind: Column, mention: Column, surrogates: Column) -> Column:
    """The mention with its surrogates in its own format and case."""
    title = F.regexp_extract(mention, "^(" + _TITLE + ") ", 1)
    words = F.split(F.regexp_replace(mention, "^" + _TITLE + " ", ""), " ")
    name = F.concat_ws(" ", title, F.array_join(F.zip_with(words, surrogates, in_case), " "))
    only = F.get(surrogates, F.lit(0))
    address = F.concat(F.substring_index(only, "@", 1), F.lit("@"), F.get(surrogates, F.lit(1)))
    return (F.when(kind == "name", name)
            .when(kind == "email", F.when(mention == F.upper(mention), F.upper(address)).otherwise(address))
            .when(kind.isin("ip", "secret"), only)
            .otherwise(in_format(mention, only)))


#: A capitalised word, else a run without capitals, else one sign.
_WORDS = (r"(?<![\p{L}\p{M}])\p{Lu}[\p{Ll}\p{M}]+(?:-\p{Lu}[\p{Ll}\p{M}]+)?(?![\p{L}\p{M}])"
          r"|[^\p{Lu}]+|\p{Lu}")


def bare_names(piece: Column, names: Column) -> Column:
    """`piece` with the capitalised words that are keys of the map `names` replaced."""
    return F.array_join(F.transform(F.regexp_extract_all(piece, F.lit(_WORDS), F.lit(0)), lambda w: F.coalesce(
        in_case(w, F.element_at(names, F.lower(w))), w)), "")


def replaced(docs: DataFrame, key: str) -> DataFrame:
    """`docs` with surrogates in `text`; `entities` lists (kind, surrogate) as they occur."""
    name = "entities"
    while name in docs.columns:
        name += "_"
    nothing = F.array().cast("array<struct<kind:string,surrogate:string>>")
    every = packed(docs)
    text = F.col("_row.text")
    hinted = F.coalesce(text.rlike(HINT), F.lit(False))
    found = once(every.filter(hinted), _mentions=F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    rows = found.filter(F.size("_mentions") > 0)
    listed = rows.select("_own_id", "_own_text", F.posexplode("_mentions").alias("at", "mention"))
    listed = once(listed.dropDuplicates(["_own_id", "_own_text", "at"]),
                  kind=kind_of(F.col("mention")))
    own = ["_own_id", "_own_text", "at", "mention", "kind"]
    listed = listed.select(*own, F.posexplode(parts_of(F.col("kind"), F.col("mention"))).alias(
        "nr", "part"))
    listed = stored(listed.select(*own, "nr", "part.what", "part.canonical", "part.form"), "mentions")
    known = distinct_surrogates(listed.select("what", "canonical", "form"), key)
    told = lookup_join(listed.drop("form"), known, ["what", "canonical"], "inner", spread="_own_text",
                       settled=True)
    done = told.groupBy(*own).agg(
        F.sort_array(F.collect_list(F.struct("nr", "surrogate", "canonical"))).alias("all"))
    parts = F.transform("all", lambda x: x["surrogate"])
    done = once(done, out=written(F.col("kind"), F.col("mention"), parts), names=F.when(
        F.col("kind") == "name", F.transform("all", lambda x: F.struct(x["canonical"], x["surrogate"]))))
    done = done.groupBy(F.col("_own_id").alias("_id"), F.col("_own_text").alias("_text")).agg(
        F.sort_array(F.collect_list(F.struct("at", "kind", F.col("out").alias("surrogate")))
                     ).alias("_all"),
        F.array_distinct(F.flatten(F.collect_list("names"))).alias("_names"))
    named = F.size("_names") > 0

    def joined(names: Column) -> Column:
        return F.array_join(F.transform(F.split(text, ANY, -1), lambda p, i: F.concat(
            F.when(named, bare_names(p, names)).otherwise(p),
            F.coalesce(F.get(F.col("_all"), i)["surrogate"], F.lit("")))), "")

    changed = once(rows.join(done, same_row()), _new=let(F.map_from_entries("_names"), joined)).select(
        *((F.col("_new") if c == "text" else F.col("_row").getField(c)).alias(c)
          for c in docs.columns),
        F.transform("_all", lambda x: F.struct(x["kind"], x["surrogate"])).alias(name))
    bare = every.filter(~hinted).select("_row").unionByName(
        found.filter(F.size("_mentions") == 0).select("_row"))
    return bare.select("_row.*", nothing.alias(name)).unionByName(changed)
