import hashlib
import hmac
import random
import re

from pyspark.sql import functions as F

from moodtick.llm import surrogates as S

TEXTS = [
    (1, "Write to by.44@mail7.example.com or BY.44@MAIL7.EXAMPLE.COM; card 4111 1111 1111 1111, 4111111111111111."),
    (2, "Elizabeth Warren met Mr. Warren; Анна Каренина; tel +49 30 1234567, 555-123-4567, 123-45-6789, ip 240.56.125.154"),
    (3, None),
    (4, ""),
    (5, "clean 1.2.3, 2024-01-01, 12345, 999.1.1.1, a@b, Erin the dog, v4.10.2.1.7"),
    (6, "réré.12@mail7.example.com&&& 4785380592391139$$$ DE89 3704 0044 0532 0130 00"),
    (6, "réré.12@mail7.example.com&&& 4785380592391139$$$ DE89 3704 0044 0532 0130 00"),
    (None, "FREDERICK WARREN, Elizabeth Warren and Patricia Smith-Jones"),
]


def frame(spark, rows=TEXTS):
    return spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, entities int, FIXES string")


def luhn(x):
    digits = [int(c) for c in re.sub(r"\D", "", x)][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_types_formats_coreference(spark):
    df = frame(spark)
    out = S.replaced(df, "key", count="n")
    assert out.columns == [*df.columns, "n"]
    rows = out.collect()
    text = {r.doc_id: r.text for r in rows}
    assert text[3] is None and text[4] == "" and text[5] == TEXTS[4][1]
    low, high, spaced, plain = re.search(r"to (\S+) or (\S+); card ([\d ]+), (\d+)\.", text[1]).groups()
    assert low.upper() == high and re.fullmatch(r"[a-z]{2}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", low)
    assert spaced.replace(" ", "") == plain and luhn(plain) and plain != "4111111111111111" and re.fullmatch(r"(\d{4} ){3}\d{4}", spaced)
    first, surname, again = re.match(r"(\w+) (\w+) met Mr\. (\w+);", text[2]).groups()
    assert first in S.GIVEN["latin", "female"] and first != "Elizabeth" and surname == again != "Warren"
    russian = re.search(r"([А-Я]\w+) ([А-Я]\w+);", text[2])
    assert russian[1] in S.GIVEN["cyrillic", "female"] and russian[2] != "Каренина"
    assert re.search(r"tel \+\d\d \d\d \d{7}, \d{3}-\d{3}-\d{4}, \d{3}-\d\d-\d{4}, ip (\d+\.){3}\d+$", text[2])
    shouted = re.match(r"([A-Z]+) ([A-Z]+), (\w+) (\w+) and (\w+) (\w+-\w+|\w+)$", text[None])
    assert shouted[2] == surname.upper() and shouted[3] == first and shouted[4] == surname
    assert shouted[1] != "FREDERICK" and shouted[1].capitalize() in S.GIVEN["latin", "male"]
    assert len({r.text for r in rows if r.doc_id == 6}) == 1
    assert text[6].split("@")[1].split("&")[0] == low.split("@")[1]  # one domain stays one domain
    for _, t in TEXTS:
        for e in re.findall(S.MAIL.replace(r"\p{L}", "A-Za-zé").replace(r"\p{N}", "0-9").replace("*+", "*").replace("++", "+") + r"|\d{16}", t or ""):
            assert all(e not in (x or "") for x in text.values())
    other = {r.doc_id: r.text for r in S.replaced(df, "another").collect()}
    assert other[1] != text[1] and other[5] == text[5]
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in p and "Arrow" not in p


def test_colliding_surrogates_are_drawn_again(spark, monkeypatch):
    """The first draws see four values only: most collide, and some hit a real address."""
    draw = S._stream

    def poor(key, what, ref, attempt):
        few = F.substr(F.sha2(F.concat_ws("|", F.lit(key), what, ref).cast("binary"), 256), F.lit(1), F.lit(1))
        return F.when(attempt < 1, draw(key, what, F.translate(few, "0123456789abcdef", "aaaabbbbccccdddd"), attempt)).otherwise(draw(key, what, ref, attempt))

    monkeypatch.setattr(S, "_stream", poor)
    rows = [(i, f"from 10.1.{i}.7 and u{i}@site.org, 10.1.{i}.7 again") for i in range(60)]
    new = [r.text for r in S.replaced(frame(spark, rows), "k").orderBy("doc_id").collect()]
    ips = [re.findall(r"(?:\d+\.){3}\d+", t) for t in new]
    assert all(a == b for a, b in ips) and len({a for a, _ in ips}) == 60
    assert not {a for a, _ in ips} & {f"10.1.{i}.7" for i in range(60)}
    assert S.retries(S.entities(frame(spark, rows)), "k").count() > 50


def test_no_rows(spark):
    assert S.replaced(frame(spark).limit(0), "k").count() == 0


def test_more_surnames_than_first_surrogates(spark, monkeypatch):
    """Two syllables make 16 surnames of four; the others need longer ones."""
    monkeypatch.setattr(S, "SYLLABLES", {k: v[:2] for k, v in S.SYLLABLES.items()})
    named = lambda i: "Q" + "".join("abcdefgh"[int(d)] for d in f"{i:03o}")
    again = S.retries(S.entities(frame(spark, [(i, f"Mr. {named(i)} left") for i in range(120)])), "k")
    assert again.count() >= 120 - 16
    new = S.replaced(frame(spark, [(i, f"Mr. {named(i)} left") for i in range(120)]), "k").collect()
    assert len({r.text for r in new}) == 120 and all(re.fullmatch(r"Mr\. [A-Z]((?<=B)ar|(?<=C)or)(bar|cor)+ left", r.text) for r in new)


def test_crowded_numbers_and_mailboxes(spark):
    """More one-letter mailboxes than letters on the surrogates of one-letter domains."""
    addresses = [f"{a}@{d}.com" for a in "abcdefghijklmnopqrstuvwxyz" for d in "pqr"]
    new = [r.text for r in S.replaced(frame(spark, list(enumerate(addresses))), "k").collect()]
    assert len(set(new)) == len(addresses) and not set(new) & set(addresses)
    later = spark.createDataFrame([("number", "4111111111111111", 12), ("iban", "DE89370400440532013000", 12), ("number", "123456789", 3)], "what string, ref string, attempt int")
    own, domain = S._streams("k", F.col("what"), F.col("ref"), F.col("attempt"))
    card, iban, plain = (r[0] for r in later.withColumns({"o": own, "d": domain}).select(S.new_core(F.col("what"), F.col("ref"), F.col("o"), F.col("d"), F.col("attempt"))).collect())
    assert re.fullmatch(r"\d{20}", card) and luhn(card) and re.fullmatch(r"DE\d{24}", iban) and re.fullmatch(r"\d{9}", plain)
    spaced = spark.range(1).select(S._written_like(F.lit("4111 1111-1"), F.lit("123456789012"))).first()[0]
    assert spaced == "1234 5678-9012"


def test_letters_of_all_scripts(spark):
    sources = ["李明@邮件.com", "سلام@بريد.com", "שלום@דואר.com", "김철수@메일.com", "สมชาย@ไทย.com", "ёжик@почта.com", "άλφα@ταχ.com", "さくら@メール.com", "ǆăş@żółw.com", "١٢@ⴰⴱ.com"]
    parts = [p for m in sources for p in m.removesuffix(".com").split("@")]
    like = spark.createDataFrame([(p,) for p in parts], "p string").select("p", S._like(F.col("p"), F.sha2(F.col("p").cast("binary"), 512)).alias("new")).collect()
    assert all(r.p != r.new and len(r.p) == len(r.new) for r in like)
    new = [r.text for r in S.replaced(frame(spark, list(enumerate(sources))), "k").orderBy("doc_id").collect()]
    assert len(set(new)) == len(sources)
    assert all(a != b for m, n in zip(sources, new) for a, b in zip(m.removesuffix(".com").split("@"), n.removesuffix(".com").split("@")))
    assert re.fullmatch("[\u4e00-\u9fff]{2}@[\u4e00-\u9fff]{2}\\.com", new[0])


# ---------------------------------------------------------------- the same rules in plain Python


def plain_stream(what, ref, attempt=0, key="k"):
    return hmac.new(key.encode(), f"{what}\x1f{ref}\x1f{attempt}".encode(), hashlib.sha512).hexdigest()


def plain_number(s, i, n):
    at = i % 32 * 4
    return int(s[at : at + 4], 16) % n


def plain_surname(word, attempt=0):
    s = plain_stream("person", word.lower(), attempt)
    new = "".join(S.SYLLABLES["latin"][plain_number(s, i, 16)] for i in range(4 + attempt))
    return new.upper() if word.isupper() else new.capitalize()


def plain_given(word):
    for (script, gender), names in S.GIVEN.items():
        if word in names:
            step = 1 + int(hashlib.sha256(f"k\x1f{script}\x1f{gender}".encode()).hexdigest(), 16) % (len(names) - 1)
            return names[(names.index(word) + step) % len(names)]
    raise KeyError(word)


def plain_digits(written):
    ref = re.sub(r"\D", "", written)
    s = plain_stream("number", ref)
    new = [plain_number(s, 0, 9) + 1 if ref[0] != "0" else plain_number(s, 0, 10), *(plain_number(s, i, 10) for i in range(1, len(ref)))]
    if len(ref) >= 13 and luhn(ref):
        new[-1] = next(d for d in range(10) if luhn("".join(map(str, [*new[:-1], d]))))
    left = iter(map(str, new))
    return "".join(next(left) if c.isdigit() else c for c in written)


def plain_ip(ip):
    s = plain_stream("ip", ip)
    return ".".join(map(str, [plain_number(s, 0, 223) + 1, *(plain_number(s, i, 256) for i in (1, 2, 3))]))


def plain_ip6(ip):
    s = plain_stream("ip6", ip.lower())
    hexa = lambda i, c: c if c == ":" else "0123456789abcdef"[plain_number(s, i, 16) if i and ip[i - 1] != ":" else 1 + plain_number(s, i, 15)]
    return "".join(hexa(i, c) for i, c in enumerate(ip))


def test_texts_against_the_rules_in_plain_python(spark):
    rng = random.Random(8)
    female, male = S.GIVEN["latin", "female"], S.GIVEN["latin", "male"]
    surname = lambda: "".join(rng.choice("bcdfgklmnprstvw") + rng.choice("aeiou") for _ in range(5)).capitalize()
    rows, want, names = [], [], []
    for i in range(150):
        a, b, c = surname(), surname(), surname()
        given, second = rng.choice(female), rng.choice(male)
        card = "".join(rng.choice("0123456789") for _ in range(15))
        card = "4" + card[:14]
        card += next(str(d) for d in range(10) if luhn(card + str(d)))
        ip = ".".join(str(rng.randint(1, 254)) for _ in range(4))
        ip6 = ":".join(f"{rng.randint(1, 65535):x}" for _ in range(8))
        phone = rng.choice(["030 {:07d}", "06 12 34 56 {:02d}", "+49 30 {:07d}", "555-123-{:04d}"]).format(rng.randint(10, 99))
        rows.append((i, f"{given} {a} and Dr. {b}, {second} von {c}; {second.upper()} {a.upper()} {card} {ip} {ip6} tel {phone}."))
        names.append((a, b, c))
        want.append(lambda p, given=given, second=second, a=a, b=b, c=c, card=card, ip=ip, ip6=ip6, phone=phone: f"{plain_given(given)} {p(a)} and Dr. {p(b)}, {plain_given(second)} von {p(c)}; {plain_given(second).upper()} {p(a).upper()} "
                    f"{plain_digits(card)} {plain_ip(ip)} {plain_ip6(ip6)} tel {plain_digits(phone)}.")
    again = S.retries(S.entities(frame(spark, rows)), "k").collect()
    assert all(r.kind == "person" for r in again) and len(again) < 10
    attempt = {r.core: r.attempt for r in again}
    made = [x.lower() for own in names for x in own]
    new = [plain_surname(x, attempt.get(x, 0)) for x in set(made)]
    assert len(set(new)) == len(new) and not {x.lower() for x in new} & set(made)
    expect = [w(lambda x: plain_surname(x, attempt.get(x.lower(), 0))) for w in want]
    assert [r.text for r in S.replaced(frame(spark, rows), "k").orderBy("doc_id").collect()] == expect


def test_persons_are_found_whole(spark):
    """Common names, titles, capitals, middle names, initials, particles, two surnames."""
    cases = {
        "John Smith met Anna Jones": "(\\w+) (\\w+) met (\\w+) (\\w+)",
        "Dr. Smith and PROF. SMITH": "Dr\\. (\\w+) and PROF\\. ([A-Z]+)",
        "Wolfgang von Goethe": "(\\w+) von (\\w+)",
        "FREDERICK WARREN": "([A-Z]+) ([A-Z]+)",
        "Elizabeth Anne Warren": "(\\w+) (\\w+) (\\w+)",
        "John F. Kennedy": "(\\w+) F\\. (\\w+)",
        "José García Márquez": "(\\w+) (\\w+) (\\w+)",
    }
    got = {r.doc_id: r.text for r in S.replaced(frame(spark, list(enumerate(cases))), "k").collect()}
    for i, (text, shape) in enumerate(cases.items()):
        new = re.fullmatch(shape, got[i])
        assert new and not {w.lower() for w in new.groups()} & {w.lower() for w in re.findall(r"\w{3,}", text)}, (text, got[i])
    smiths = {re.fullmatch("\\w+ (\\w+) met.*", got[0])[1].lower(), *(x.lower() for x in re.fullmatch(list(cases.values())[1], got[1]).groups())}
    assert len(smiths) == 1  # one surname, however it is written
    own = S.Names(given={("latin", "female"): ["Tuuli", "Aino"]}, titles=["Rouva"], particles=["af"])
    text = "Tuuli Virtanen, rouva, Rouva af Korhonen; John Smith"
    new = S.replaced(frame(spark, [(1, text)]), "k", names=own).first().text
    assert re.fullmatch(r"Aino (?!Virtanen)\w+, rouva, Rouva af (?!Korhonen)\w+; John Smith", new)


def test_addresses_and_national_numbers(spark):
    found = ["2001:db8:85a3:1:2:8a2e:370:7334", "fe80:1::8a2e", "030 1234567", "06 12 34 56 78"]
    kept = ["12:30:45", "a::b", "std::vector", "0 12 34", "01.02.2024", "3:4::5x"]
    got = [r.text for r in S.replaced(frame(spark, list(enumerate(f"at {x} now" for x in found + kept))), "k").orderBy("doc_id").collect()]
    for x, new in zip(found, got):
        assert x not in new and re.sub(r"[0-9a-f]", "0", x) == re.sub(r"[0-9a-f]", "0", new[3:-4])
    assert got[len(found) :] == [f"at {x} now" for x in kept]
