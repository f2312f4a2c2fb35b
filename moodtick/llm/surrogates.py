"""Private data replaced by keyed surrogates.

Detected entities (addresses of mail, IPv4 and IPv6 addresses, numbers of cards, phones
and people, IBANs, and persons by title or given name) are replaced by values of the same
type and format that depend on a key (HMAC) and on what the entity refers to, not on how
it is written: two spellings of one number, one surname in two persons, one mail domain,
keep referring to one thing. Given names go to given names of the same gender and
script, letters to letters of the same script and case, digits to digits, a valid
card number to a valid one. Of a person, every capitalised word that is no title, given
name or particle is a surname with a surrogate of its own.

Persons are found by ``Names``, which a user passes for the languages of a corpus; what
has neither a title nor a given name of the lists in front, or is written in small
letters, is not found.

The collision check draws again, for whatever entity whose surrogate another one has or
that is itself an entity of the corpus, until all differ. So that it ends, surnames and
mailboxes get a syllable or character more with each retry, numbers and IBANs a digit
or character more with each after the first SAME_LENGTH; IPv4 addresses can't grow, of
them a corpus may have about half of the 3.7 billion. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, clean_name, regex_any

# Given names by script and gender, titles, particles of surnames, letters by
# script and case, syllables of made-up surnames by script.
GIVEN = {
    ("latin", "female"): (
        "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Margaret Sandra Ashley Emily Michelle Amanda Melissa "
        "Deborah Stephanie Rebecca Laura Anna Anne Charlotte Susanna Katharina Brigitte Ursula Monika Petra Sabine Gabriela Valentina Françoise "
        "Isabelle Nathalie Camille Guadalupe Carmen Josefa Lucía María"
    ).split(),
    ("latin", "male"): (
        "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Mark Steven Andrew Kenneth George "
        "Timothy Edward Jonathan Frederick Vincent Wolfgang Friedrich Hans Peter Klaus Jürgen Stefan Sebastian François Pierre Philippe Nicolas "
        "Guillermo Alejandro José Antonio Francisco Carlos Javier Miguel"
    ).split(),
    ("cyrillic", "female"): ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна", "Ирина", "Светлана", "Екатерина", "Людмила"],
    ("cyrillic", "male"): ["Иван", "Дмитрий", "Сергей", "Андрей", "Михаил", "Николай", "Александр", "Владимир", "Алексей", "Павел"],
    ("greek", "female"): ["Μαρία", "Ελένη", "Αικατερίνη", "Βασιλική", "Σοφία", "Αγγελική"],
    ("greek", "male"): ["Γεώργιος", "Ιωάννης", "Κωνσταντίνος", "Δημήτριος", "Νικόλαος", "Παναγιώτης"],
}
TITLES = [
    "Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Professor", "Herr", "Frau", "Señor", "Señora", "Monsieur", "Madame", "Mme", "Mlle", "Господин", "Госпожа", "Κύριος", "Κυρία",
]
PARTICLES = ["von", "van", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "la", "le", "ter", "ten", "zu", "zur", "af", "av", "bin", "ibn", "al", "el", "y"]


class Names:
    """What persons are found by: given names by (script, gender), titles and particles."""

    def __init__(self, given: dict[tuple[str, str], list[str]] | None = None, titles: list[str] | None = None, particles: list[str] | None = None):
        self.given, self.titles, self.particles = given or GIVEN, titles or TITLES, particles or PARTICLES
        names = [n for own in self.given.values() for n in own]
        word, part = r"\p{Lu}[\p{L}'’-]+", rf"(?:(?:{regex_any(self.particles)}) ){{0,3}}"
        rest = rf"(?: (?:\p{{Lu}}\.|{part}{word}))"
        titles_, names_ = (regex_any({*own, *(n.upper() for n in own)}) for own in (self.titles, names))
        # a person ends with a word: initials may stand before it; most words have no capital and end the test there
        person = rf"(?=\p{{Lu}})(?:(?:{titles_})\.? (?:\p{{Lu}}\. )?{part}{word}{rest}{{0,2}}+|(?:{names_}){rest}{{0,2}} {part}{word})"
        self.entity = rf"(?<![\p{{L}}\p{{N}}])(?:{MAIL}|{IP6}|{IP}|{NUMBER}|{IBAN}|{person})"

    def role(self, word: Column) -> Column:
        """title, particle, initial, given or surname."""
        bare = F.regexp_replace(word, r"\.$", "")
        given = sorted({n.lower() for own in self.given.values() for n in own})
        return (
            F.when(F.lower(bare).isin(*{t.lower() for t in self.titles}), "title").when(word.isin(*self.particles), "particle")
            .when(word.rlike(r"^\p{Lu}\.$"), "initial").when(F.lower(word).isin(*given), "given").otherwise("surname")
        )

    def turned(self, key: str) -> Column:
        """lower-cased given name -> another one of its gender and script, going round by a step of the key."""
        import hashlib

        to: dict[str, str] = {}
        for (script, gender), names in self.given.items():
            step = 1 + int(hashlib.sha256(f"{key}{_SEP}{script}{_SEP}{gender}".encode()).hexdigest(), 16) % max(1, len(names) - 1)
            to |= {n.lower(): names[(i + step) % len(names)].lower() for i, n in enumerate(names)}
        return F.map_from_arrays(F.array(*map(F.lit, to)), F.array(*map(F.lit, to.values())))


LETTERS = {
    "0-9": "0123456789",
    "a-z": "abcdefghijklmnopqrstuvwxyz",
    "A-Z": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "à-öø-ÿ": "àâäçèéêëîïñôöùûü",
    "À-ÖØ-Þ": "ÀÂÄÇÈÉÊËÎÏÑÔÖÙÛÜ",
    "а-я": "абвгдежзийклмнопрстуфхцчшщыэюя",
    "А-Я": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ",
    "α-ω": "αβγδεζηθικλμνξοπρστυφχψω",
    "Α-Ω": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
}
#: Alphabets of the letters and digits that have no span above.
OTHERS = {
    r"\p{IsCyrillic}&&\p{Lu}": LETTERS["А-Я"],
    r"\p{IsCyrillic}": LETTERS["а-я"],
    r"\p{IsGreek}&&\p{Lu}": LETTERS["Α-Ω"],
    r"\p{IsGreek}": LETTERS["α-ω"],
    r"\p{IsHan}": "安北成东方光国海和江金京兰林龙美明宁平青泉山石书水天文西新星阳远云中",
    r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほ",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホ",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하고노도로모보소오조초",
    r"\p{IsArabic}&&\p{L}": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
    r"\p{IsThai}&&\p{L}": "กขคงจฉชซญดตถทนบปผพมยรลวสหอ",
    r"\p{IsDevanagari}&&\p{L}": "कखगघचछजझटडतथदनपबमयरलवशसह",
    r"\p{Lu}": LETTERS["A-Z"],
    r"\p{L}": LETTERS["a-z"],
    r"\p{N}": LETTERS["0-9"],
}
#: Retries in which numbers and IBANs keep their length.
SAME_LENGTH = 8
SYLLABLES = {
    "latin": ["bar", "cor", "dan", "fel", "gar", "hol", "jor", "kel", "lam", "mor", "nar", "pel", "ros", "sal", "tor", "van"],
    "cyrillic": ["бар", "вол", "гор", "дан", "жар", "зор", "кол", "лам", "мор", "нов", "пол", "рос", "сал", "тор", "фед", "чер"],
    "greek": ["βαρ", "γορ", "δαν", "ζερ", "θελ", "καλ", "λαμ", "μορ", "ναρ", "παλ", "ροσ", "σαλ", "τορ", "φελ", "χαρ", "ψελ"],
}

MAIL = r"[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
IP = rf"(?<!\d\.)(?:{OCTET}\.){{3}}{OCTET}(?![\p{{L}}\p{{N}}]|\.\d)"
_HEX = "[0-9A-Fa-f]{1,4}"
# eight groups, or two and more before a double colon
IP6 = rf"(?<!:)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{2,6}}:(?:{_HEX}(?::{_HEX}){{0,4}})?)(?![\p{{L}}\p{{N}}:])"
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
NUMBER = (
    r"(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5}|\d{3}-\d{2}-\d{4}"
    r"|\+\d(?:[ .()-]{0,2}\d){7,13}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"
    r"|(?=0(?: ?\d){8,11}(?![ ]?\d))0\d{1,4}(?: \d{2,8}){1,4})(?![\p{L}\p{N}])"
)

_SEP = "\x1f"


def kind(e: Column) -> Column:
    return (
        F.when(F.contains(e, F.lit("@")), "mail")
        .when(e.rlike(rf"^{IP}$"), "ip")
        .when(e.rlike(r"^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*$"), "ip6")
        .when(e.rlike(r"^[+(]?\d[\d .()-]*$"), "number")
        .when(e.rlike(r"^[A-Z]{2}\d"), "iban")
        .otherwise("person")
    )


def core(e: Column) -> Column:
    """What an entity that is no person refers to: its letters and digits without case and separators."""
    return F.when(kind(e).isin("number", "iban"), F.regexp_replace(e, r"[^\p{L}\p{N}]", "")).otherwise(F.lower(e))


def named(e: Column, names: Names) -> Column:
    """The (kind, core) of an entity; of a person, those of its surnames."""
    surnames = F.filter(F.split(e, " "), lambda w: names.role(w) == "surname")
    return F.when(
        kind(e) == "person", F.transform(surnames, lambda w: F.struct(F.lit("person").alias("kind"), F.lower(w).alias("core")))
    ).otherwise(F.array(F.struct(kind(e).alias("kind"), core(e).alias("core"))))


def _stream(key: str, what: Column, ref: Column, attempt: Column) -> Column:
    """HMAC-SHA512 of the three, 128 hex digits."""
    import hashlib

    own = key.encode()
    own = (hashlib.sha512(own).digest() if len(own) > 128 else own).ljust(128, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in own)) for pad in (0x36, 0x5C))
    said = F.concat_ws(_SEP, what, ref, attempt.cast("string")).cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, said), 512))), 512)


def _streams(key: str, what: Column, ref: Column, attempt: Column) -> tuple[Column, Column]:
    """The stream of an entity, and that of the domain of a mail address (one for all its mailboxes)."""
    domain = F.when(what == "mail", F.substring_index(ref, "@", -1)).otherwise("")
    return _stream(key, what, ref, attempt), _stream(key, F.lit("domain"), domain, F.lit(0))


def _number(hex_digits: Column, i: Column, n: int) -> Column:
    """The i-th (from 0, going round) number below n of a stream."""
    return F.conv(F.substr(hex_digits, F.pmod(i, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int") % n


def _characters(e: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(e)), lambda i: F.substr(e, i, F.lit(1)))


def _like(e: Column, stream: Column) -> Column:
    """A letter or digit of the same script and case (of a script without an alphabet here, a
    Latin one) for each; other characters stay."""

    def one(c, i):
        out = c
        for span, letters in reversed((LETTERS | OTHERS).items()):  # the first is tested first
            out = F.when(c.rlike(f"^[{span}]$"), F.substr(F.lit(letters), _number(stream, i, len(letters)) + 1, F.lit(1))).otherwise(out)
        return out

    return F.when(F.length(e) > 0, F.array_join(F.transform(_characters(e), one), "")).otherwise(e)


def _hex_like(e: Column, stream: Column) -> Column:
    """A hexadecimal digit for each, the first of a group not zero; colons stay."""

    def one(c, i):
        first = (i == 0) | (F.substr(e, i, F.lit(1)) == ":")
        digit = F.when(first, 1 + _number(stream, i, 15)).otherwise(_number(stream, i, 16))
        return F.when(c == ":", c).otherwise(F.lower(F.hex(digit.cast("long"))))

    return F.array_join(F.transform(_characters(e), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn formula, the last digit undoubled."""
    n = F.length(digits)

    def value(i):
        d = F.substr(digits, i, F.lit(1)).cast("int")
        double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, double).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0), lambda a, x: a + x)


def _digits(ref: Column, stream: Column, more: Column) -> Column:
    """Digits for the digits of a number, and ``more`` digits; the first stays nonzero, valid card numbers stay valid."""
    n = F.length(ref) + more
    new = F.array_join(
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.when((i == 0) & ~ref.startswith("0"), _number(stream, i, 9) + 1).otherwise(_number(stream, i, 10)).cast("string"),
        ),
        "",
    )
    body = F.substr(new, F.lit(1), n - 1)
    check = F.pmod(F.lit(10) - _luhn(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")
    return F.when((F.length(ref) >= 13) & (_luhn(ref) % 10 == 0), F.concat(body, check)).otherwise(new)


def _written_like(e: Column, new: Column) -> Column:
    """The characters of ``new`` in the places that letters and digits have in ``e``, what is left of them after it."""
    upto = lambda i: F.length(F.regexp_replace(F.substr(e, F.lit(1), i), r"[^\p{L}\p{N}]", ""))
    written = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(e)),
            lambda i: F.when(F.substr(e, i, F.lit(1)).rlike(r"[\p{L}\p{N}]"), F.substr(new, upto(i), F.lit(1))).otherwise(F.substr(e, i, F.lit(1))),
        ),
        "",
    )
    return F.concat(written, F.substr(new, upto(F.length(e)) + 1))


def _surname(ref: Column, stream: Column, attempt: Column) -> Column:
    """Four syllables, and one more for each retry."""

    def made(script):
        own = F.array(*map(F.lit, SYLLABLES[script]))
        syllable = lambda i: F.element_at(own, _number(stream, i, len(SYLLABLES[script])) + 1)
        return F.array_join(F.transform(F.sequence(F.lit(0), attempt + 3), syllable), "")

    return F.when(ref.rlike(r"\p{IsCyrillic}"), made("cyrillic")).when(ref.rlike(r"\p{IsGreek}"), made("greek")).otherwise(made("latin"))


def new_core(what: Column, ref: Column, stream: Column, domain_stream: Column, attempt: Column) -> Column:
    """The surrogate of ``core``."""
    more = F.greatest(attempt - SAME_LENGTH, F.lit(0))
    local, domain = F.substring_index(ref, "@", 1), F.substring_index(ref, "@", -1)
    labels = F.regexp_replace(domain, r"\.[^.]*$", "")
    local = F.concat(local, F.repeat(F.left(local, F.lit(1)), attempt))  # starts with a letter or digit
    mail = (_like(local, stream), F.lit("@"), _like(labels, domain_stream), F.lit("."), F.substring_index(domain, ".", -1))
    ip = (_number(stream, F.lit(0), 223) + 1, *(_number(stream, F.lit(i), 256) for i in (1, 2, 3)))
    return (
        F.when(what == "mail", F.concat(*mail))
        .when(what == "ip", F.concat_ws(".", *ip))
        .when(what == "ip6", _hex_like(ref, stream))
        .when(what == "number", _digits(ref, stream, more))
        .when(what == "iban", F.concat(F.left(ref, F.lit(2)), _like(F.concat(F.substr(ref, F.lit(3)), F.repeat(F.right(ref, F.lit(1)), more)), stream)))
        .otherwise(_surname(ref, stream, attempt))
    )


def _in_case_of(new: Column, old: Column) -> Column:
    return F.when(F.upper(old) == old, F.upper(new)).otherwise(F.concat(F.upper(F.substr(new, F.lit(1), F.lit(1))), F.substr(new, F.lit(2))))


def _person(e: Column, key: str, attempt, names: Names) -> Column:
    """A person word by word: given names go round, surnames are made up, the rest stays."""
    words = F.transform(F.split(e, " "), lambda w: F.struct(w.alias("w"), names.role(w).alias("role"), F.lower(w).alias("core")))
    words = F.transform(words, lambda x: F.struct(*(x[k].alias(k) for k in ("w", "role", "core")), attempt(F.lit("person"), x["core"]).alias("attempt")))
    words = F.transform(words, lambda x: F.struct(*(x[k].alias(k) for k in ("w", "role", "core", "attempt")), _stream(key, F.lit("person"), x["core"], x["attempt"]).alias("own")))
    turned = names.turned(key)

    def one(x):
        return (
            F.when(x["role"] == "given", _in_case_of(F.element_at(turned, x["core"]), x["w"]))
            .when(x["role"] == "surname", _in_case_of(_surname(x["core"], x["own"], x["attempt"]), x["w"]))
            .otherwise(x["w"])
        )

    return F.array_join(F.transform(words, one), " ")


def _surrogate(e: Column, what: Column, new: Column) -> Column:
    """The replacement of an entity that is no person, as written."""
    return (
        F.when(what.isin("number", "iban"), _written_like(e, new))
        .when(what.isin("mail", "ip6") & (F.upper(e) == e), F.upper(new))
        .otherwise(new)
    )


def surrogates(found: Column, key: str, attempt, names: Names) -> Column:
    """The replacements of an array of entities. Step by step, so that each part is made once for each."""
    own = F.transform(found, lambda e: F.struct(e.alias("e"), kind(e).alias("kind"), core(e).alias("core")))
    numbered = F.transform(own, lambda x: F.struct(*(x[k].alias(k) for k in ("e", "kind", "core")), attempt(x["kind"], x["core"]).alias("attempt")))

    def drawn(x):
        own, domain = _streams(key, x["kind"], x["core"], x["attempt"])
        return F.struct(*(x[k].alias(k) for k in ("e", "kind", "core", "attempt")), own.alias("own"), domain.alias("domain"))

    new = F.transform(
        F.transform(numbered, drawn),
        lambda x: F.struct(x["e"].alias("e"), x["kind"].alias("kind"), F.when(x["kind"] != "person", new_core(x["kind"], x["core"], x["own"], x["domain"], x["attempt"])).alias("new")),
    )
    return F.transform(new, lambda x: F.when(x["kind"] == "person", _person(x["e"], key, attempt, names)).otherwise(_surrogate(x["e"], x["kind"], x["new"])))


def entities(docs: DataFrame, text: str = "text", names: Names | None = None) -> DataFrame:
    """Distinct (kind, core) of the corpus; a hot entity costs one partial row per task."""
    names = names or Names()
    own = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(names.entity), 0), lambda e: named(e, names)))
    found = docs.where(F.col(text).rlike(names.entity)).select(F.explode(F.array_distinct(own)).alias("e"))
    return found.select("e.*").distinct()


def retries(found: DataFrame, key: str) -> DataFrame:
    """The collision check: (kind, core, attempt) of the entities whose surrogate is not
    that of attempt 0, so that no two entities of a kind share a surrogate and none is an
    entity of the corpus. A joint of the surrogates drawn so far with those of the
    corpus, as often as anything collides."""
    found = checkpoint(found)

    def draw(df):
        own, domain = _streams(key, F.col("kind"), F.col("core"), F.col("attempt"))
        new = new_core(F.col("kind"), F.col("core"), F.col("own"), F.col("domain"), F.col("attempt"))
        return df.withColumns({"own": own, "domain": domain}).withColumn("new", new).drop("own", "domain")

    drawn = checkpoint(draw(found.withColumn("attempt", F.lit(0))))
    real = found.select("kind", F.col("core").alias("new"))
    while True:
        # of those with one surrogate, the smallest (attempt, core) keeps it
        first = drawn.groupBy("kind", "new").agg(F.min(F.struct("attempt", "core")).alias("first"), F.count("*").alias("n"))
        shared = first.where("n > 1").select("kind", "new", F.col("first.core").alias("holder"))
        hit = drawn.join(shared, ["kind", "new"]).where("core <> holder").select("kind", "core")
        hit = hit.union(drawn.join(real, ["kind", "new"], "left_semi").select("kind", "core")).distinct()
        hit = checkpoint(hit)
        if hit.isEmpty():
            return drawn.where("attempt > 0").select("kind", "core", "attempt")
        again = hit.withColumn("hit", F.lit(1))
        drawn = checkpoint(draw(drawn.join(again, ["kind", "core"], "left").select("kind", "core", (F.col("attempt") + F.coalesce("hit", F.lit(0))).alias("attempt"))))


def replaced(docs: DataFrame, key: str, text: str = "text", count: str | None = None, names: Names | None = None) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced, and on request their number in
    column ``count``.

    Null texts stay null (count 0), texts without an entity stay as they are. Equal
    entities get equal surrogates in all rows, repeated rows included; an empty table
    gives none. Texts are shuffled only if the collision check had to draw again."""
    names = names or Names()
    again = retries(entities(docs, text, names), key)
    pattern = names.entity
    e, fixes, row = clean_name(docs, "entities"), clean_name(docs, "fixes"), clean_name(docs, "row_hash")
    found = F.when(F.col(text).rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), 0))
    out = docs.withColumn(e, F.coalesce(found, F.array().cast("array<string>")))
    attempt = lambda what, ref: F.lit(0)
    if not again.isEmpty():
        said = lambda what, ref: F.concat(what, F.lit(_SEP), ref)
        out = out.withColumn(row, F.xxhash64(text))
        own = F.flatten(F.transform(e, lambda x: named(x, names)))
        mentions = out.where(F.size(e) > 0).select(row, F.explode(F.array_distinct(F.transform(own, lambda x: said(x["kind"], x["core"])))).alias("name"))
        table = again.select(said(F.col("kind"), F.col("core")).alias("name"), "attempt")
        pairs = mentions.join(table, "name").groupBy(row).agg(F.collect_set(F.struct("name", "attempt")).alias("s"))
        out = out.join(pairs.select(row, F.map_from_entries("s").alias(fixes)), row, "left")
        attempt = lambda what, ref: F.coalesce(F.element_at(F.col(fixes), said(what, ref)), F.lit(0))
    new = F.concat(surrogates(F.col(e), key, attempt, names), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(F.split(text, pattern, -1), new, lambda a, b: F.concat(a, b)), "")
    out = out.withColumn(text, F.when(F.size(e) > 0, joined).otherwise(F.col(text)))
    if count:
        out = out.withColumn(count, F.size(e).cast("long"))
    return out.select(*docs.columns, *([count] if count else []))
