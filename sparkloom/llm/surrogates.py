"""PII: surrogate generation with DataFrame functions alone.

Entities are found with one regular expression: e-mail addresses, phone
numbers, payment cards, IPv4 addresses, social security numbers, access keys,
secrets behind a keyword, and names behind a form of address.  Each gets a
replacement drawn from a keyed hash of its type and canonical form:

* phone numbers are national, or international in any grouping; a card ends with
  its grouping, so a number behind it doesn't belong to it;
* type-consistent and of the same format: separators, letter case, country
  code, card issuer digit and Luhn validity, hexadecimal digits stay as they are;
* a name is all its parts behind the form of address (inner capitals, apostrophes,
  hyphens, initials, particles between them); the last part is the surname;
* given names keep gender (from the form of address) and script, surnames the script;
* coreference: equal canonical forms have equal surrogates in the whole corpus,
  whatever the separators or case of a mention, and "Ms. Jane Smith" and
  "Ms. Smith" share the surname's surrogate; so do a bare "Smith" or "Jane" in
  the text that has them behind a form of address;
* distinctness: surrogates are checked against each other and against the
  entities that occur; a clash is drawn anew for all but the smallest form, until
  none is left.

Scale.  Only texts with entities (a narrow test) meet the surrogate table:
(text hash, mention) pairs are made distinct before the join, so copies and
entities that occur everywhere cost a row per task.  A mention is taken apart and
replaced once for the whole corpus, from staged columns, and a map of mentions per text
hash goes back to its documents.  Other texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import free_name, staged

DEFAULT_KEY = "change-me"

# Forms of address by gender, and the name stock by script and gender.
MALE = (
    "Mr", "MR", "Mister", "Sir", "Lord", "Herrn?", "HERR", "[Ss]eñor", "[Ss]r", "[Dd]on", "[Mm]onsieur", r"(?<!\.)MM?(?=\.)", "[Гг]осподин", "[Гг]-н",
)
FEMALE = (
    "Mrs", "MRS", "Ms", r"MS(?=\.)", "Miss", "Madam", "Lady", "Frau", "FRAU", "Fräulein", "[Ss]eñora", "[Ss]eñorita", "[Ss]ra", "[Ss]rta", "[Dd]oña",
    "[Dd]octora", "Dra", "[Pp]rofesora", "[Mm]adame", "[Mm]ademoiselle", "Mme", "Mlle", "[Гг]оспожа", "[Гг]-жа",
)
LEARNED = ("Dr", "DR", "[Dd]octor", "Doktor", "[Dd]octeur", "Prof", "PROF", "Professor", "[Pp]rofesor", "[Pp]rofesseur")
NEUTRAL = ("Mx", "Rev", "Reverend", *LEARNED)
GIVEN = {
    ("latin", "m"): "Adam Boris Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Max Noel Oscar Paul Ralf Simon Theo Victor".split(),
    ("latin", "n"): "Alex Andrea Charlie Chris Dominique Eike Jona Kai Kim Luca Noa Robin Sam Sascha Toni".split(),
    ("latin", "f"): "Alma Berta Clara Diana Elena Flora Greta Hanna Ines Julia Karin Laura Maria Nora Olivia Paula Rosa Sofia Tina Vera".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев".split(),
    ("cyrillic", "n"): "Валя Женя Паша Саша Слава Шура".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Зоя Инна Кира Лидия Мария".split(),
}
SYLLABLES = {
    "latin": "ba ben dor fal gar hol ker lan mar nev ost pel ran sol tam ulf var wen yor zan".split(),
    "cyrillic": "ба вен гор дал жен зар кол лан мар нев ост пел ран сол там".split(),
}

SECRET = r"\b(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Possessive repeats neither recurse nor end inside a word.
L, GAP = r"[\p{L}\p{M}]", r"[ \xA0]{1,2}"
#: Letters with apostrophes and hyphens between them, but no English possessive.
INNER = rf"(?:{L}|['’](?![sS](?!{L}))(?={L})|[-‐](?={L}))"
#: A part of a name or an initial.
PART = rf"(?<!{L})(?:[dl]['’])?\p{{Lu}}{INNER}*+"
WORD = rf"(?!(?:Jr|Sr|II|III|IV)(?!{L}))(?:[dl]['’])?\p{{Lu}}{INNER}++"
BEFORE = (
    rf"(?:(?:van|von|vom|de|del|della|di|da|dos|du|ten|ter|bin|ibn|af|av){GAP}(?:(?:der|den|dem|het|la|las|los|le){GAP})?)?+"
    rf"(?:\p{{Lu}}\.(?:[ \xA0-]|(?=\p{{Lu}}))|\p{{Lu}}{GAP}(?=\p{{Lu}}))*+"
)
NAME = rf"{BEFORE}{WORD}(?:{GAP}{BEFORE}{WORD})*+"
AFTER = r"(?:\.[ \xA0]{0,2}|[ \xA0]{1,2})"
ADDRESS = (
    rf"(?<!{L})(?=[DFHLMPRSdmpsГг])(?:{'|'.join(MALE + FEMALE + NEUTRAL)}){AFTER}"
    rf"(?:(?:{'|'.join(LEARNED)}){AFTER}|(?:med|phil|jur|ing|habil|rer|nat)\. ?){{0,9}}"
)
PERSON = rf"{ADDRESS}{NAME}"
#: Country codes by length; a number's country code stays, the rest is exchanged.
COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[1-9]\d{2})"
DIGIT = r"(?:\) ?| ?\(| / ?|[ ./-])?\d"  # with the separator before it
TRUNK = r"(?: ?\(0\))?"
#: Countries whose numbers have one length end there; the others' have 7 to 15 digits, grouped as they may be.
INTERNATIONAL = (
    rf"(?<![\w.+])(?:\+ ?|00 ?)(?:1(?:{DIGIT}){{10}}|7(?:{DIGIT}){{10}}|3[34]{TRUNK}(?:{DIGIT}){{9}}|44{TRUNK}(?:{DIGIT}){{10}}"
    rf"|[1-9]\d{TRUNK}(?:{DIGIT}){{5,13}})(?!\w)"
)
AREA = r"(?<![\w.+])(?:\+?\d{1,3}[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)"
#: Words before an unseparated number that say it's something else.
NO_PHONE = (
    r"(?<!\b(?i:order|invoice|item|article|ref|reference|ticket|case|account|customer|serial|isbn|id|no|nr|num|number|bestellung|bestellnummer|rechnung|kundennummer"
    r"|commande|facture|pedido|factura|cuenta|referencia)[ .:#]{0,3})(?<![#№] ?)"
)
#: Without a country code: a trunk 0 and pairs or an area code behind it; Spanish groups; unseparated, 10 digits with a
#: North American area code (11 with a leading 1) or 9 with a Spanish one, unless the word before says otherwise.
NATIONAL = (
    r"(?<![\w.+-])(?:0[1-9](?:[ .-]\d{2}){4}|\(0[1-9]\d{1,4}\) ?\d{3,8}|0[1-9]\d{1,4}(?: ?[/-] ?| )\d{4,8}|[6-9]\d{2}(?:[ -]\d{3}){2}|[6-9]\d{2}(?:[ -]\d{2}){3}"
    rf"|0[1-9]\d{{7,10}}|(?=\d{{9}}){NO_PHONE}(?:1?[2-9][0-8]\d{{8}}|[67]\d{{8}}|[89][1-8]\d{{7}}))(?!\w)(?!\.\d)"
)
#: A card ends with the grouping it began with; three digits more may belong to it (see ``_card``).
CARD = r"(?<![\w.])(?:\d{16,19}|\d{4}(?: \d{4}){3}(?: \d{3})?|\d{4}(?:-\d{4}){3}(?:-\d{3})?|3\d{3}[ -]\d{6}[ -]\d{4,5})(?!\w)"
ODD_CARD = r"(?<![\w.])(?:\d{13,15}|\d(?:[ -]?\d){12,18})(?!\w)"
PATTERN = "|".join([
    SECRET + r"[^\s\"']{6,}",
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"\bAKIA[0-9A-Z]{16}\b",
    rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w)(?!\.\d)",
    r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    CARD,
    INTERNATIONAL,
    AREA,
    NATIONAL,
    ODD_CARD,
    PERSON,
])
#: Every entity holds one of these; a text without any is left alone at once.
HINT = rf"[@0-9]|(?i:passw|pwd|secret|token|api)|AKIA|{ADDRESS}\p{{L}}"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def entity_type(m: Column) -> Column:
    return (
        F.when(m.rlike("^" + SECRET), "secret").when(m.rlike("^" + PERSON), "person").when(m.contains("@"), "email")
        .when(m.rlike("^AKIA"), "access_key").when(m.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "ip").when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(m.rlike(rf"^(?:{CARD})$"), "card").when(m.rlike(rf"^(?:{INTERNATIONAL}|{AREA}|{NATIONAL})$"), "phone").otherwise("card")
    )


def _national(m: Column) -> Column:
    """The digits of a phone number without country code and trunk 0."""
    abroad = F.regexp_replace(_digits(F.regexp_replace(m, r"\(0\)", "")), "^00", "")
    home = F.regexp_replace(_digits(m), r"^(?:0|1(?=\d{10}$))", "")
    return (
        F.when(m.rlike(rf"^{AREA}$"), F.substring(_digits(m), -10, 10)).when(m.rlike(r"^(?:\+|00)"), F.regexp_replace(abroad, f"^{COUNTRY}", "")).otherwise(home)
    )


def _card(m: Column) -> Column:
    """The card in a mention: of four groups of four and three digits more, all if only that has a Luhn sum of 0, else the groups of four."""
    valid = lambda n: _luhn(F.substring(_digits(m), 1, n)) % 10 == 0
    return F.when(m.rlike(r"^\d{4}(?:[ -]\d{4}){3}[ -]\d{3}$") & (valid(16) | ~valid(19)), F.substring(m, 1, 19)).otherwise(m)


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def described(mentions: DataFrame) -> DataFrame:
    """``mentions(mention)`` with what the later steps need, once a mention: kind; the form of address, the parts of the name and
    what is around them; the card in it; units, an array of (kind, canonical form), one for each part of a name."""
    m, kind = F.col("mention"), F.col("kind")
    person = kind == "person"
    title = F.when(person, F.regexp_extract(m, rf"^({ADDRESS}){NAME}$", 1))
    df = mentions.withColumn("kind", entity_type(m))
    df = staged(df.withColumn("title", title).withColumn("card", F.when(kind == "card", _card(m))), "mentions")
    name = F.when(person, F.substr(m, F.length("title") + 1))
    df = df.withColumn("parts", F.regexp_extract_all(name, F.lit(PART), 0)).withColumn("around", F.split(name, PART, -1))
    of_gender = lambda forms: F.col("title").rlike(rf"(?<!{L})(?:{'|'.join(forms)})(?!{L})")
    df = staged(df.withColumn("gender", F.when(of_gender(FEMALE), "f").when(of_gender(MALE), "m").otherwise("n")), "mentions")
    form = (
        F.when(kind == "secret", F.regexp_replace(m, "^" + SECRET, "")).when(kind == "email", F.lower(m))
        .when(kind == "phone", _national(m)).when(kind == "card", _digits(F.col("card"))).when(kind == "ssn", _digits(m)).otherwise(m)
    )
    unit = lambda k, f: F.struct(k.alias("kind"), f.alias("form"))
    given = F.transform(F.slice("parts", 1, F.greatest(F.size("parts") - 1, F.lit(0))), lambda p: unit(F.concat(F.lit("given_"), F.col("gender"), F.lit("_"), _script(p)), F.lower(p)))
    surname = F.transform(F.slice("parts", -1, 1), lambda p: unit(F.concat(F.lit("surname_"), _script(p)), F.lower(p)))
    return staged(df.withColumn("units", F.when(person, F.concat(given, surname)).otherwise(F.array(unit(kind, form)))), "mentions")


def _byte(stream: Column, i: Column) -> Column:
    """The i-th (from 0) byte of a stream of hexadecimal digits, read round and round."""
    return F.conv(F.substr(stream, F.pmod(i, F.lit(96)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _one_of(chars: str, b: Column) -> Column:
    return F.substr(F.lit(chars), F.pmod(b, F.lit(len(chars))) + 1, F.lit(1))


def _shaped(form: Column, stream: Column, hexadecimal: Column | None = None) -> Column:
    """``form`` with every ASCII letter and digit exchanged for one of its class."""
    def char(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        plain = (
            F.when(c.rlike("[0-9]"), _one_of("0123456789", b)).when(c.rlike("[a-z]"), _one_of("abcdefghijklmnopqrstuvwxyz", b))
            .when(c.rlike("[A-Z]"), _one_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ", b)).otherwise(c)
        )
        return plain if hexadecimal is None else F.when(hexadecimal, _one_of("0123456789abcdef", b)).otherwise(plain)

    return F.array_join(F.transform(F.split(form, ""), char), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits, its last digit counted once."""
    def add(total: Column, i: Column) -> Column:
        d = F.substr(F.reverse(digits), i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def _stock(words: list[str], last: Column, stream: Column) -> Column:
    """An array of the words that the bytes 0 to ``last`` of the stream choose."""
    stock = F.array(*map(F.lit, words))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.element_at(stock, F.pmod(_byte(stream, i), F.lit(len(words))) + 1))


def drawn(entities: DataFrame, key: str) -> DataFrame:
    """``entities(kind, form, attempt)`` with the surrogate of that attempt."""
    seed = F.concat_ws("\x1f", F.lit(key), "kind", "form", F.col("attempt").cast("string"))
    stream = F.concat(*(F.sha2(F.concat(seed, F.lit(f"\x1f{i}")), 256) for i in range(3)))
    df = entities.withColumn("stream", stream)
    form, s = F.col("form"), F.col("stream")
    kind = F.col("kind")
    named, attempt = F.lit(None).cast("string"), F.col("attempt")  # a further attempt has one part more: the stock can't run out
    for (script, gender), stock in GIVEN.items():
        named = F.when(kind == f"given_{gender}_{script}", F.array_join(_stock(stock, attempt, s), "-")).otherwise(named)
    for script, syllables in SYLLABLES.items():
        named = F.when(kind == f"surname_{script}", F.initcap(F.array_join(_stock(syllables, attempt + 3, s), ""))).otherwise(named)
    digits = _shaped(form, s)
    lead = lambda at: _one_of("23456789", _byte(s, F.lit(at)))
    body = F.concat(F.substring(form, 1, 1), F.substr(digits, F.lit(2), F.length(form) - 2))
    check = F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.pmod(_byte(s, i), F.lit(254)) + 1).cast("string")), ".")
    at = F.instr(form, "@")
    local = F.substr(form, F.lit(1), at - 1)
    core = (
        F.when(kind == "email", F.concat(_shaped(local, s), F.lit("@"), F.substr(s, F.lit(150), F.lit(8)), F.lit(".example.org")))
        .when(kind == "secret", _shaped(form, s, form.rlike("^[0-9a-f]+$")))
        .when(kind == "access_key", F.concat(F.lit("AKIA"), F.substr(digits, F.lit(5), F.lit(16))))
        .when(kind == "ip", ip)
        .when(kind == "ssn", F.concat(lead(0), F.substr(digits, F.lit(2), F.lit(8))))
        .when(kind == "phone", F.concat(lead(0), F.substr(digits, F.lit(2), F.lit(2)), F.when(F.length(form) == 10, lead(3)).otherwise(F.substr(digits, F.lit(4), F.lit(1))), F.substr(digits, F.lit(5), F.length(form))))
        .when(kind == "card", F.when(_luhn(form) % 10 == 0, F.concat(body, check)).otherwise(F.concat(F.substring(form, 1, 1), F.substr(digits, F.lit(2), F.length(form)))))
        .otherwise(named)
    )
    return df.withColumn("surrogate", core).drop("stream")


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, form, surrogate) for distinct ``entities(kind, form)``: no two surrogates of a kind are equal, none is a real form."""
    now = staged(drawn(entities.withColumn("attempt", F.lit(0)), key), "surrogates")
    real = entities.select("kind", F.col("form").alias("surrogate"), F.lit(True).alias("real"))
    while True:
        # a clash is counted per surrogate, so a popular one is a row of partial counts
        first = now.groupBy("kind", F.lower("surrogate").alias("low")).agg(F.min("form").alias("winner"), F.count("*").alias("n")).where("n > 1")
        marked = (
            now.withColumn("low", F.lower("surrogate")).join(first, ["kind", "low"], "left")
            .join(real.withColumnRenamed("surrogate", "low").withColumn("low", F.lower("low")).distinct(), ["kind", "low"], "left")
            .withColumn("again", F.coalesce("real", F.lit(False)) | F.coalesce(F.col("winner") != F.col("form"), F.lit(False)))
        )
        marked = staged(marked.select("kind", "form", "attempt", "surrogate", "again"), "surrogates")
        if marked.where("again").isEmpty():
            return marked.select("kind", "form", "surrogate")
        redrawn = drawn(marked.where("again").select("kind", "form", (F.col("attempt") + 1).alias("attempt")), key)
        now = staged(marked.where("not again").select("kind", "form", "attempt", "surrogate").unionByName(redrawn), "surrogates")


def _filled(mention: Column, core: Column) -> Column:
    """``mention`` with its last digits exchanged for those of ``core``."""
    skip = F.length(_digits(mention)) - F.length(core)

    def char(c: Column, i: Column) -> Column:
        before = F.length(_digits(F.substr(mention, F.lit(1), i))) - skip
        return F.when(c.rlike("[0-9]") & (before >= 0), F.substr(core, before + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(mention, ""), char), "")


def _as_written(part: Column, core: Column) -> Column:
    """``core`` as a part of a name is written: an initial, in capitals, or plain."""
    return (
        F.when(F.length(part) == 1, F.upper(F.substring(core, 1, 1))).when((part == F.upper(part)) & (part != F.lower(part)), F.upper(core)).otherwise(core)
    )


def _woven(gaps: Column, words: Column) -> Column:
    """The text of n + 1 gaps with n words between them."""
    return F.array_join(F.zip_with(gaps, F.concat(words, F.array(F.lit(""))), lambda g, w: F.concat(g, w)), "")


def rendered(mentions: DataFrame, table: DataFrame) -> DataFrame:
    """(mention, new, names) of ``described`` mentions: the text that replaces each, and for names (kind|form, surrogate) of the parts."""
    one = mentions.select("mention", F.posexplode("units").alias("at", "u")).select("mention", "at", "u.kind", "u.form")
    core = one.join(table, ["kind", "form"]).groupBy("mention").agg(F.sort_array(F.collect_list(F.struct("at", F.concat_ws("|", "kind", "form").alias("unit"), "surrogate"))).alias("cores"))
    df = mentions.join(core, "mention")
    m, kind, last = F.col("mention"), F.col("kind"), F.element_at("cores", -1)["surrogate"]
    name = F.concat("title", _woven(F.col("around"), F.zip_with("parts", "cores", lambda p, c: _as_written(p, c["surrogate"]))))
    new = (
        F.when(kind == "person", name)
        .when(kind == "secret", F.concat(F.regexp_extract(m, "^" + SECRET, 0), last))
        .when(kind.isin("phone", "ssn"), _filled(m, last))
        .when(kind == "card", F.concat(_filled(F.col("card"), last), F.substr(m, F.length("card") + 1)))
        .when((kind == "email") & (m == F.upper(m)), F.upper(last))
        .otherwise(last)
    )
    names = F.when(kind == "person", F.transform("cores", lambda c: F.struct(c["unit"].alias("unit"), c["surrogate"].alias("surrogate"))))
    return staged(df.select("mention", new.alias("new"), names.alias("names")), "rendered")


def bare_names(found: Column) -> Column:
    """A pattern of the names in ``found`` where they stand alone, the longest first; null if there is none."""
    forms = F.filter(F.transform(F.map_keys(found), lambda k: F.substring_index(k, "|", -1)), lambda f: F.length(f) > 1)
    longest = F.transform(F.sort_array(F.transform(F.array_distinct(forms), lambda f: F.struct(F.length(f), f.alias("f"))), asc=False), lambda x: x["f"])
    pattern = F.concat(F.lit(rf"(?<!{L})(?=\p{{Lu}}|[dl]['’])(?iu:"), F.array_join(longest, "|"), F.lit(rf")(?!{L})"))
    return F.when(F.size(forms) > 0, pattern)


def _without_bare(gap: Column, pattern: Column, found: Column) -> Column:
    """``gap`` with the names that ``pattern`` finds replaced."""
    kinds = [f"surname_{s}" for s in SYLLABLES] + [f"given_{g}_{s}" for s, g in GIVEN]
    look = lambda w: F.coalesce(*(F.try_element_at(found, F.concat(F.lit(f"{k}|"), F.lower(w))) for k in kinds), w)
    words = F.transform(F.regexp_extract_all(gap, pattern, 0), lambda w: _as_written(w, look(w)))
    return F.when(pattern.isNull(), gap).otherwise(_woven(F.split(gap, pattern, -1), words))


def with_surrogates(docs: DataFrame, text_col: str = "text", *, key: str = DEFAULT_KEY, count_col: str | None = None) -> DataFrame:
    """``docs`` with every entity in ``text_col`` replaced; with ``count_col``, that column counts the mentions, bare names included.

    All rows and the other columns stay; null and empty texts are as they
    were (count 0); equal texts have equal results.
    """
    cols = docs.columns
    mentions, gaps, code, found, new, bare = (free_name(docs, n) for n in ("mentions", "gaps", "text_hash", "found", "new", "bare"))
    text = F.col(f"`{text_col}`")
    hit = F.coalesce(text.rlike(HINT) & text.rlike(PATTERN), F.lit(False))
    clean = docs.where(~hit)
    dirty = docs.where(hit).withColumn(mentions, F.regexp_extract_all(text, F.lit(PATTERN), 0)).withColumn(code, F.xxhash64(text))
    pairs = staged(dirty.select(F.col(code).alias("code"), F.explode(mentions).alias("mention")).distinct(), "pairs")
    every = described(pairs.select("mention").distinct())
    table = surrogate_table(every.select(F.explode("units").alias("u")).select("u.kind", "u.form").distinct(), key)
    of_text = pairs.join(rendered(every, table), "mention").groupBy("code").agg(
        F.map_from_entries(F.collect_list(F.struct("mention", "new"))).alias("new"),
        F.map_from_entries(F.array_distinct(F.flatten(F.collect_list("names")))).alias("found"),
    )
    other = free_name(docs, "code")
    maps = of_text.select(F.col("code").alias(other), F.col("new").alias(new), F.col("found").alias(found), bare_names(F.col("found")).alias(bare))
    maps = staged(maps, "replacements")
    joined = dirty.join(maps, dirty[code] == maps[other]).withColumn(gaps, F.split(text, PATTERN, -1))
    words = F.transform(mentions, lambda m: F.element_at(F.col(new), m))
    whole = _woven(F.transform(gaps, lambda g: _without_bare(g, F.col(bare), F.col(found))), words)
    alone = F.aggregate(gaps, F.lit(0), lambda n, g: n + F.size(F.regexp_extract_all(g, F.col(bare), 0)))
    n_mentions = F.size(mentions) + F.when(F.col(bare).isNull(), 0).otherwise(alone)
    counted = [n_mentions.cast("long").alias(count_col)] if count_col else []
    replaced = joined.select(*(whole.alias(c) if c == text_col else F.col(f"`{c}`") for c in cols), *counted)
    return clean.select("*", *([F.lit(0).cast("long").alias(count_col)] if count_col else [])).unionAll(replaced)
