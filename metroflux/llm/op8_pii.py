"""Personal data replaced by surrogates, in DataFrame functions only.

Entities are found by one pattern.  Every distinct entity of the corpus gets one
surrogate, so mentions of the same entity stay the same across all documents
(coreference).  Surrogates come from a keyed hash and keep type and format:
digits stay digits, letters stay letters of the same case and script, hexadecimal
stays hexadecimal, separators, country codes, card brands and the validity of a
card's check digit are kept, name tokens end by the gender of their title.  Two
entities never share a surrogate and no surrogate is an entity that occurs: losers
of a collision are hashed again with the next attempt number until none is left.

Only rows with an entity are written and joined; the others pass through.  A
mention's join key may be hot, its other side is unique, and AQE splits it.

Kinds: email, ip (4 and 6), card, ssn, phone, iban, secret, birth date, address, name.  A phone
is known by its last ten digits, a card by its digits, an email by its lower case, a birth
date by its day, a name token by its lower case.  A number is a card only if its check
digit holds and it begins with 2 to 6; other long numbers stay.  National phone numbers
are those with a leading 0 and separators.  A secret is what follows a word for one, up to
the closing quote or else to white space, a Bearer token, a PEM private key's body, or a
string in a known key format; of any length.  A birth date or a passport number is found by the
words before it, an address by its house number and word for a street (English, German).

A name is found by its titles and takes every capitalised token and initial that
follows, of any length; apostrophes belong to a token (a genitive 's does not),
particles (von, de la) between tokens stay.  The tokens of a document's names are
replaced wherever else they stand in it as whole words in the same spelling, also
without a title.  A name that never stands with a title in its document is not found: there
is no list of names.

Letters become letters of the same script, from the scripts of ``SCRIPTS``; of others, Latin
ones.  Where a kind's surrogates are few, they grow: names and initials, secrets, mails and
addresses get more characters with each attempt after the second, so rounds end.

Defined results: NULL text stays NULL; rows without an entity keep their text;
repeated rows are treated each; all other columns are unchanged, whatever their names;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import stage

#: The secret of the keyed hash; a parameter of every function, to be set per corpus.
KEY = "surrogates-1"

#: Entity patterns in order of precedence (Java regular expressions).
EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}](?:[\p{L}\p{N}\-]{0,62}\.){1,126}\p{L}{2,24}"
WORDS_OF_SECRETS = "token|secret|api[_-]?key|access[_-]?key|password|passwd|pwd"
AFTER_WORD = rf"""(?i:{WORDS_OF_SECRETS})["']?\s{{0,3}}[:=]\s{{0,3}}["']?"""
PASSPORT = r"\b(?i:passport(?: (?:no|number|nr)\.?)?)\s{0,3}[:#=]?\s{0,3}(?=[A-Z]{0,3}\d{5,8}\b)"
BEARER = r"\b(?:Bearer|bearer|BEARER)\s{1,3}(?=[A-Za-z0-9._~+/=\-]{16,})"
PEM = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
BEFORE_SECRET = rf"(?:{PEM}|{BEARER}|{PASSPORT}|{AFTER_WORD})"
#: To the closing quote; else to white space, without closing punctuation.
VALUE = r"""(?:(?<=")[^"\r\n]{6,}+(?=")|(?<=')[^'\r\n]{6,}+(?=')|[^\s"'<>]{8,}(?<![.,;:)\]}!?]))"""
SECRET = (rf"{PEM}[A-Za-z0-9+/=\s]{{16,}}+|{BEARER}[A-Za-z0-9._~+/=\-]{{16,}}(?<![.\-])|{PASSPORT}[A-Z]{{0,3}}\d{{5,8}}|{AFTER_WORD}{VALUE}"
          r"|\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9\-]{20,}|xox[abp]-[A-Za-z0-9\-]{10,})"
          r"|\b(?=[0-9]*+[a-f])[0-9a-f]{32,}+\b")
IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\d|\.\d)"
GROUP = r"[0-9A-Fa-f]{1,4}"
IP6 = (rf"(?<![\p{{L}}\p{{N}}:.])(?:(?:{GROUP}:){{7}}{GROUP}|(?=[0-9A-Fa-f:]*\d)(?:{GROUP}:){{1,6}}(?::{GROUP}){{1,6}})(?![\p{{L}}\p{{N}}:])")
WORDS_OF_BIRTH = r"date of birth|birth ?date|dob|d\.o\.b\.?|born(?: on)?|geboren(?: am)?|née? le|nacid[oa] el"
BEFORE_BIRTH = rf"\b(?i:{WORDS_OF_BIRTH})\s{{0,3}}[:=]?\s{{0,3}}"
BIRTH = rf"{BEFORE_BIRTH}(?:\d{{4}}[-/.]\d{{1,2}}[-/.]\d{{1,2}}|\d{{1,2}}[-/.]\d{{1,2}}[-/.]\d{{4}})(?!\d)"
STREETS = "Street|St|Road|Rd|Avenue|Ave|Lane|Drive|Boulevard|Blvd|Court|Square|Terrace"
ADDRESS = (rf"(?<![\p{{L}}\p{{N}}])\d{{1,5}}[A-Za-z]?,? (?:\p{{Lu}}[\p{{L}}'’-]+ ){{0,2}}\p{{Lu}}[\p{{L}}'’-]+(?= (?:{STREETS})\b)"
           r"|(?<![\p{L}\p{N}])\p{Lu}\p{Ll}+(?=(?:straße|strasse|allee|gasse) \d)")
CARD = r"(?<![\d.+])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = (r"(?<![\d.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
         r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}|0\d{2,4}[ -]\d{3,4}[ -]?\d{3,4})(?!\d)")
MALE, FEMALE, EITHER = r"Mr\.?|Herrn?|Monsieur|Señor|Sr\.", r"Mrs\.?|Ms\.?|Frau|Madame|Mme|Señora|Sra\.", r"Dr\.|Prof\."
TITLES = rf"(?:{MALE}|{FEMALE}|{EITHER})\s"
TITLE = rf"\b(?:{TITLES}){{1,5}}+"
TOKEN = r"\p{Lu}(?=['’\-]?\p{L})(?:[\p{L}\p{M}]|['’](?![sS](?!\p{L}))(?=\p{L})|-(?=\p{L}))*+"
INITIAL = r"(?:\p{Lu}\.-?)++(?= ?\p{Lu})|\p{Lu}(?= \p{Lu}['’\-]?\p{L})"
PARTICLE = r"(?:(?:[Vv][ao]n|[Dd]e|del|della|da|di|dos|du)(?: (?:der|den|dem|la|las|los|le|zu|und zu))? |[dl]['’])"
PART = rf"{PARTICLE}?(?:{INITIAL}|{TOKEN})"
NAME = rf"{TITLE}{PART}(?:(?: |(?<=\.))(?!{TITLES}){PART})*+"
#: One part of what follows the titles in a NAME: the text before, and the token or initials.
PIECE = rf"((?:^| |(?<=\.)){PARTICLE}?)((?:\p{{Lu}}\.-?)++|\p{{Lu}}(?:[\p{{L}}\p{{M}}]|['’\-](?=\p{{L}}))*+)"
PATTERN = "|".join(f"(?:{p})" for p in (EMAIL, SECRET, BIRTH, IBAN, IP, IP6, CARD, SSN, PHONE, ADDRESS, NAME))
#: A text without a match of this has no entity; it spares most texts the whole pattern.
HINT = rf"[0-9@=:]|{PEM}|{BEARER}|{TITLE}"

ONSETS = ["b", "d", "f", "g", "k", "l", "m", "n", "p", "r", "s", "t", "v", "w", "h", "j"]
VOWELS = ["a", "e", "i", "o"]
#: Script -> first letter and number of letters in a row, for lower case (or where there is none) and upper case.
SCRIPTS = {"Cyrillic": ((0x430, 32), (0x410, 32)), "Greek": ((0x3B1, 17), (0x391, 17)), "Armenian": ((0x561, 38), (0x531, 38)),
           "Han": ((0x4E00, 2000), None), "Hangul": ((0xAC00, 11172), None), "Hiragana": ((0x3042, 80), None),
           "Katakana": ((0x30A2, 80), None), "Arabic": ((0x627, 19), None), "Hebrew": ((0x5D0, 27), None),
           "Devanagari": ((0x915, 37), None), "Thai": ((0xE01, 46), None), "Georgian": ((0x10D0, 33), None)}


#: The kind of matches that are no entity after all; they stay.
NONE = "none"


def kind_of(mention: Column) -> Column:
    """The entity's type."""
    digits = F.regexp_replace(mention, r"[^0-9]", "")
    return (F.when(mention.rlike(rf"^(?:{PEM}|{BEARER.partition('(?=')[0]}|{PASSPORT.partition('(?=')[0]}\w|{AFTER_WORD})"), "secret")
            .when(mention.rlike(rf"^{BEFORE_BIRTH}\d"), "birth").when(mention.rlike(rf"^{TITLE}"), "name")
            .when(mention.contains("@"), "email")
            .when(mention.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$|^[0-9A-Fa-f]{{1,4}}:[0-9A-Fa-f:]+$"), "ip")
            .when(mention.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(mention.rlike(r"^\d[\d -]*$") & (F.length(digits) >= 13),
                  F.when(mention.rlike("^[2-6]") & (check_sum(digits) == 0), "card").otherwise(NONE))
            .when(mention.rlike(r"^\d{1,5}[A-Za-z]?,? \p{Lu}|^\p{Lu}\p{Ll}+$"), "address")
            .when(mention.rlike(r"^[+(\d][\d ().+-]*$"), "phone")
            .when(mention.rlike(r"^[A-Z]{2}\d{2}[ A-Z0-9]{11,}$"), "iban").otherwise("secret"))


def values_of(kind: Column, match: Column) -> Column:
    """What is replaced in a match, each with the text before it: a secret's value, a name's tokens, else the whole."""
    piece = lambda before, value: F.struct(before.alias("before"), value.alias("mention"))
    before = F.regexp_extract(match, rf"^(?:{BEFORE_SECRET}|{BEFORE_BIRTH}(?=\d)|{TITLE})", 0)
    rest = F.substr(match, F.length(before) + 1)
    words = F.zip_with(F.regexp_extract_all(rest, F.lit(PIECE), 1), F.regexp_extract_all(rest, F.lit(PIECE), 2), piece)
    # The titles stand before the first of the name's parts.
    words = F.transform(words, lambda w, i: piece(F.when(i == 0, F.concat(before, w["before"])).otherwise(w["before"]), w["mention"]))
    return F.when(kind == "name", words).when(kind.isin("secret", "birth"), F.array(piece(before, rest))).otherwise(F.array(piece(F.lit(""), match)))


def names_in(matches: Column) -> Column:
    """The name tokens of a document's matches, initials left out; of two with one beginning the longer comes first."""
    titled = F.filter(matches, lambda m: m.rlike(rf"^{TITLE}"))
    tokens = F.transform(titled, lambda m: F.regexp_extract_all(F.regexp_replace(m, rf"^{TITLE}", ""), F.lit(PIECE), 2))
    return F.sort_array(F.array_distinct(F.filter(F.flatten(tokens), lambda t: t.rlike(r"^..+$") & ~t.contains("."))), asc=False)


def pattern_with(names: Column) -> Column:
    """PATTERN, and the names as whole words; names are letters, apostrophes and hyphens, so nothing is quoted."""
    return F.concat(F.lit(PATTERN + r"|(?<![\p{L}\p{M}\p{N}])(?=\p{Lu})(?:"), F.array_join(names, "|"), F.lit(r")(?![\p{L}\p{M}\p{N}])"))


def identity(kind: Column, mention: Column) -> Column:
    """What two mentions of one entity have in common."""
    digits = F.regexp_replace(mention, r"[^0-9]", "")
    return (F.when(kind.isin("email", "name"), F.lower(mention))
            .when(kind == "phone", F.substring(digits, -10, 10))
            .when(kind.isin("card", "ssn"), digits)
            .when(kind == "iban", F.regexp_replace(mention, " ", ""))
            .when(kind == "ip", F.lower(mention))
            .when(kind == "birth", written_day(mention)).otherwise(mention))


def written_day(date: Column) -> Column:
    """A date as year-month-day with leading zeros; it is written year first or day first."""
    part = F.regexp_extract_all(date, F.lit(r"\d+"), 0)
    first, middle, last = (F.get(part, k) for k in range(3))
    two = lambda c: F.lpad(c, 2, "0")
    return F.when(F.length(first) == 4, F.concat_ws("-", first, two(middle), two(last))).otherwise(F.concat_ws("-", last, two(middle), two(first)))


def day_like(mention: Column, day: Column) -> Column:
    """A year-month-day in the order and with the separator of a mention."""
    part, sep = F.split(day, "-"), F.regexp_extract(mention, r"[-/.]", 0)
    year, month, date = (F.get(part, k) for k in range(3))
    return F.when(mention.rlike(r"^\d{4}"), F.concat(year, sep, month, sep, date)).otherwise(F.concat(date, sep, month, sep, year))


def keyed(kind: Column, entity: Column, attempt: int, key: str) -> Column:
    """An array of numbers below 65536, at least 16 and one for each character of the entity and of its growth."""
    stream = F.array_join(F.transform(
        F.sequence(F.lit(0), F.floor((F.length(entity) + attempt) / 16).cast("int")),
        lambda i: F.sha2(F.concat_ws("\u0001", F.lit(key), kind, F.lit(str(attempt)), i.cast("string"), entity), 256)), "")
    return F.transform(F.regexp_extract_all(stream, F.lit("[0-9a-f]{4}"), 0), lambda h: F.conv(h, 16, 10).cast("int"))


def reshaped(text: Column, numbers: Column) -> Column:
    """Each letter and digit replaced by another of its case and script; hexadecimal strings stay hexadecimal."""
    among = lambda n, first, many: F.chr(F.lit(first) + n % many)
    wide = lambda n, first, many: F.decode(F.unhex(F.lpad(F.hex(F.lit(first) + n % many), 4, "0")), "UTF-16BE")

    def one(c: Column, n: Column) -> Column:
        out = (F.when(c.between("0", "9"), among(n, 48, 10)).when(c.between("a", "z"), among(n, 97, 26))
               .when(c.between("A", "Z"), among(n, 65, 26)))
        for script, (lower, upper) in SCRIPTS.items():
            mine = c.rlike(rf"^\p{{Is{script}}}$") & c.rlike(r"^\p{L}$")
            if upper:
                out = out.when(mine & c.rlike(r"^\p{Lu}$"), wide(n, *upper))
            out = out.when(mine, wide(n, *lower))
        return out.when(c.rlike(r"^\p{Lu}$"), among(n, 65, 26)).when(c.rlike(r"^\p{L}$"), among(n, 97, 26)).otherwise(c)

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    enough = F.slice(numbers, 1, F.size(chars))
    digit = lambda n: F.lower(F.hex(n % 16))
    return F.array_join(F.when(text.rlike(r"^(?=.*[a-f])[0-9a-f]{16,}$"), F.transform(enough, digit))
                        .when(text.rlike("^[0-9a-f]{1,4}:[0-9a-f:]+$"), F.zip_with(chars, enough, lambda c, n: F.when(c == ":", c).otherwise(digit(n))))
                        .otherwise(F.zip_with(chars, enough, one)), "")


def among_letters(number: Column) -> Column:
    return F.chr(F.lit(97) + number % 26)


def check_sum(digits: Column) -> Column:
    """The Luhn sum modulo 10 (0: valid)."""
    from_end = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))

    def worth(c: Column, i: Column) -> Column:
        d = c.try_cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(from_end, worth), F.lit(0), lambda a, d: a + d) % 10


def with_surrogate(entities: DataFrame, attempt: int, key: str) -> DataFrame:
    """Adds each entity's replacement at one attempt."""
    kind, entity, gender, plain = (F.col(c) for c in ("kind", "entity", "gender", "plain"))
    at = lambda i: F.element_at("numbers", i)
    # An address keeps its top-level domain, a card its first digit and whether its check digit holds.
    # Short ones grow after two attempts, so that there is always a free surrogate.
    grown = (at(5) % 9000 + 1000).cast("string") if attempt > 1 else F.lit("")
    tail = F.regexp_extract(entity, r"\.\p{L}{2,24}$", 0)
    email = F.concat(F.substr(plain, F.lit(1), F.length(entity) - F.length(tail)), tail)
    ip = F.when(entity.contains(":"), plain).otherwise(F.concat_ws(".", *[(at(i) % 254 + 1).cast("string") for i in (1, 2, 3, 4)]))
    body = F.concat(F.substring(entity, 1, 1), F.substr(plain, F.lit(2), F.length(entity) - 2))
    card = F.concat("body", F.when(F.col("sound"), F.col("check")).otherwise(F.pmod(F.col("check") + 1 + at(3) % 9, F.lit(10))).cast("string"))
    syllable = lambda i: F.concat(F.element_at(F.array(*map(F.lit, ONSETS)), at(i) % 16 + 1),
                                  F.element_at(F.array(*map(F.lit, VOWELS)), at(i + 1) % 4 + 1))
    # Latin names are built from syllables, one more with each attempt; other scripts keep their letters.
    latin = F.concat(*[syllable(2 * i + 1) for i in range(3 + min(attempt, 4))],
                     F.when(gender == "f", "na").when(gender == "m", "ron").otherwise("l"))
    # Initials grow by one more with each attempt after the second.
    more = F.concat(F.lit(""), *[F.concat(among_letters(at(6 + i)), F.lit(".")) for i in range(min(max(attempt - 1, 0), 8))])
    # Names in other scripts and addresses grow by letters like their last one.
    longer = F.when(kind.isin("name", "address"), F.concat(entity, F.repeat(F.right(entity, F.lit(1)), F.lit(max(attempt - 1, 0))))).otherwise(entity)
    birth = F.concat_ws("-", (at(1) % 400 + 1800).cast("string"), F.lpad((at(2) % 12 + 1).cast("string"), 2, "0"),
                        F.lpad((at(3) % 28 + 1).cast("string"), 2, "0"))
    return (entities.withColumn("numbers", keyed(kind, entity, attempt, key))
            .withColumn("plain", reshaped(longer, F.col("numbers")))
            .withColumn("body", F.when(kind == "card", body))
            .withColumn("check", F.when(kind == "card", F.pmod(F.lit(10) - check_sum(F.concat("body", F.lit("0"))), F.lit(10))))
            .withColumn("sound", F.when(kind == "card", check_sum(entity) == 0))
            .withColumn("surrogate", F.when(kind == "email", F.concat(grown, email)).when(kind == "ip", ip).when(kind == "card", card)
                        .when(kind == "birth", birth)
                        .when((kind == "name") & entity.rlike(r"^[\p{IsLatin}\p{M}'’-]+$"), latin)
                        .when((kind == "name") & entity.contains("."), F.concat(plain, more))
                        .when(kind == "iban", F.concat(F.substring(entity, 1, 2), F.substr(plain, F.lit(3), F.length(entity))))
                        .when(kind == "secret", F.concat(plain, grown)).otherwise(plain))
            .drop("numbers", "plain", "body", "check", "sound"))


def rendered(kind: Column, mention: Column, replacement: Column) -> Column:
    """The replacement in the format of one mention: digits fill its digits from the right, names its capitals."""
    count = F.length(F.regexp_replace(mention, r"[^0-9]", ""))
    skip = count - F.length(replacement)  # a country code before the last ten digits stays

    def fill(state: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        k = state["k"]
        return F.struct(F.concat(state["out"], F.when(digit & (k >= skip), F.substr(replacement, k - skip + 1, F.lit(1))).otherwise(c)).alias("out"),
                        F.when(digit, k + 1).otherwise(k).alias("k"))

    filled = F.aggregate(F.split(mention, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("k")), fill)["out"]
    return (F.when(kind.isin("phone", "card", "ssn"), filled).when(kind == "birth", day_like(mention, replacement))
            .when(kind == "name", F.when((mention == F.upper(mention)) & (F.length(mention) > 1), F.upper(replacement)).otherwise(F.initcap(replacement)))
            .otherwise(replacement))


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, entity, surrogate) of distinct entities (kind, entity, gender), without collisions.

    Each round gives the still open entities a surrogate; of those that share one, the least entity keeps it,
    and one that is taken, or is itself an entity, is hashed again.  Rounds are written.
    """
    real = entities.select("kind", F.col("entity").alias("surrogate"))
    left, done, attempt = entities, None, 0
    while True:
        tried = stage(with_surrogate(left, attempt, key), "surrogates-tried")
        fit = (tried.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
               .join(real, ["kind", "surrogate"], "left_anti"))
        if done is not None:
            fit = fit.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        fit = stage(fit.select("kind", "entity", "surrogate"), "surrogates-fit")
        done = fit if done is None else done.unionByName(fit)
        left = stage(tried.drop("surrogate").join(fit, ["kind", "entity"], "left_anti"), "surrogates-left")
        if left.isEmpty():
            return done
        attempt += 1


def mentions(found: DataFrame) -> DataFrame:
    """(row, at, part, kind, entity, before, mention, gender) of everything to replace in ``found`` (row, matches, names)."""
    return (found.select("row", "names", F.posexplode("matches").alias("at", "match"))
            .withColumn("kind", F.when(F.array_contains("names", F.col("match")), "name").otherwise(kind_of(F.col("match"))))
            .withColumn("gender", F.when(F.col("match").rlike(rf"^(?:{MALE})\s"), "m").when(F.col("match").rlike(rf"^(?:{FEMALE})\s"), "f"))
            .select("row", "at", "kind", F.when(F.col("kind") == "name", F.col("gender")).alias("gender"),
                    F.posexplode(values_of(F.col("kind"), F.col("match"))).alias("part", "value"))
            .select("row", "at", "part", "kind", "gender", "value.before", "value.mention",
                    identity(F.col("kind"), F.col("value.mention")).alias("entity")))


def replace(docs: DataFrame, text_col: str = "text", key: str = KEY, length_col: str | None = None) -> DataFrame:
    """``docs`` with every entity of the text column replaced; all columns and their order are kept.

    ``length_col`` names a column of text lengths, which follows the change.
    """
    cols, text = docs.columns, docs[text_col]
    held = docs.select(F.struct(*[docs[c] for c in cols]).alias("held"), text.cast("string").alias("text"))
    hint = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    matches = F.regexp_extract_all("text", F.lit(PATTERN), 0)
    none = F.coalesce(F.size(F.when(hint, matches)) <= 0, F.lit(True))
    found = stage(held.where(hint).withColumn("matches", matches).where(F.size("matches") > 0)
                  .withColumn("names", names_in(F.col("matches"))).withColumn("named", F.size("names") > 0)
                  .withColumn("pattern", F.when(F.col("named"), pattern_with(F.col("names"))))
                  .withColumn("matches", F.when(F.col("named"), F.regexp_extract_all("text", F.col("pattern"), F.lit(0))).otherwise(F.col("matches")))
                  .withColumn("parts", F.when(F.col("named"), F.split("text", F.col("pattern"), -1)).otherwise(F.split("text", PATTERN, -1)))
                  .drop("text", "named", "pattern")
                  .withColumn("row", F.monotonically_increasing_id()), "surrogates-found")
    seen = stage(mentions(found), "surrogates-mentions")
    entities = (seen.where(F.col("kind") != NONE).groupBy("kind", "entity").agg(F.min("gender").alias("low"), F.max("gender").alias("high"))
                .select("kind", "entity", F.when(F.col("low") == F.col("high"), F.col("low")).alias("gender")))
    known = surrogates(stage(entities, "surrogates-entities"), key)
    filled = (seen.join(known, ["kind", "entity"], "left")
              .select("row", "at", "part", F.concat("before", F.when(F.col("kind") == NONE, F.col("mention")).otherwise(
                  rendered(F.col("kind"), F.col("mention"), F.col("surrogate")))).alias("new"))
              .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "part", "new"))).alias("new")))
    # The text between matches stands before the first part of each.
    pieces = F.transform("new", lambda m: F.concat(F.when(m["part"] == 0, F.element_at("parts", m["at"] + 1)).otherwise(F.lit("")), m["new"]))
    renewed = found.join(filled, "row").withColumn("text", F.concat(F.array_join(pieces, ""), F.element_at("parts", -1)))
    change = (F.length("text") - F.length(F.col(f"held.`{text_col}`").cast("string"))).cast("long")

    def renewed_column(c: str) -> Column:
        if c == text_col:
            return F.col("text").alias(c)
        old = F.col(f"held.`{c}`")
        return ((old + change).cast(docs.schema[c].dataType) if c == length_col else old).alias(c)

    out = [renewed_column(c) for c in cols]
    return renewed.select(*out).unionByName(held.where(none).select("held.*"))


def report(docs: DataFrame) -> DataFrame:
    """Query op8: every document's text after replacement."""
    return replace(docs.select("doc_id", "text")).select("doc_id", "text")
