import random
import re

import pytest

from moodtick.llm import decontaminate as D


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(doc, items, window=10):
    ws, hit, found = words(doc), set(), set()
    for item, text in items:
        iw = words(text)
        k = min(window, len(iw))
        for a in range(len(iw) - k + 1 if iw else 0):
            for i in range(len(ws) - k + 1):
                if ws[i : i + k] == iw[a : a + k]:
                    hit |= set(range(i, i + k))
                    found.add(item)
    return len(ws), len(hit), sorted(found)


def corpus(seed, n=60):
    """Few words, so that windows overlap, repeat and nearly match."""
    rng = random.Random(seed)
    vocabulary = ["The", "of", "ea", "Été", "x1", "in", "re-do"]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    items = [(str(i), text(rng.choice([3, 9, 10, 11, 25]))) for i in range(8)]
    docs = []
    for i in range(n):
        t = text(rng.randint(0, 40))
        if i % 2:
            t += rng.choice([" ", "\n", "... "]) + rng.choice(items)[1].upper() + ", " + text(5)
        docs.append((i, t))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_automaton_against_windows(seed):
    docs, items = corpus(seed, 200)
    auto = D.Automaton([(i, D.words(t.encode())) for i, t in items], 10)
    for _, t in docs:
        spans, found, _ = auto.match(D.words(t.encode()))
        n, hit, want = plain(t, items)
        assert (sum(spans[1::2]) - sum(spans[::2]), sorted(found)) == (hit, want)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")


@pytest.mark.parametrize("limit", [200_000, 40])
def test_matches_with_one_and_several_automata(spark, monkeypatch, limit):
    monkeypatch.setattr(D, "MAX_WORDS", limit)
    docs, items = corpus(4)
    items = [*items, ("7", None), ("8", " ,. "), ("9", "")]
    own, bench = frames(spark, [*docs, (None, None), (1, ""), (1, "")], items)
    for r in D.matches(own, bench).collect():
        assert (r.n_words, r.n_hit, r["items"]) == plain(r.text, [x for x in items if x[1]])
    for r in D.decontaminated(own, bench, max_coverage=1.0).collect():
        assert plain(r.text, [x for x in items if x[1]])[1] == 0


def test_several_automata_answer_as_one(spark, monkeypatch):
    docs, own = corpus(5)
    made = {k: [f"{k}{i}" for i in range(12)] for k in "abcd"}
    items = [*own[:4], *((k, " ".join(ws)) for k, ws in made.items())]
    rest = [f"r{i}" for i in range(90)]
    # 60 % of it by four items; passages of one item around those of another
    docs.append((900, " ".join(sum(made.values(), rest[:32]))))
    around = [made[a][:7] + made[b] + made[a][7:] for a in made for b in made if a != b]
    docs += [(901 + i, " ".join([*ws, *rest])) for i, ws in enumerate(around)]
    docs, bench = frames(spark, docs, items)
    answers = []
    for limit in (200_000, 24):
        monkeypatch.setattr(D, "MAX_WORDS", limit)
        kept = {r.doc_id: r.text for r in D.decontaminated(docs, bench, max_coverage=0.5).collect()}
        assert 900 not in kept and not any(plain(t, items)[1] for t in kept.values())
        assert all(kept[901 + i].strip() == " ".join(rest) for i in range(len(around)))
        found = sorted((r.doc_id, r.n_words, r.n_hit, r.longest, r.spans, r["items"]) for r in D.matches(docs, bench).collect())
        answers.append((kept, found))
    assert answers[0] == answers[1]


def test_removal_keeps_the_rest(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    clean = "a clean text of some length that no item has, twelve words or more in all"
    docs = [(1, f"Before, {passage.upper()}! After it " + "and so on " * 10), (2, passage), (3, clean), (4, "one two three four five six seven eight nine, but not ten")]
    own, bench = frames(spark, docs, [("b", passage)])
    out = {r.doc_id: r.text for r in D.decontaminated(own.selectExpr("*", "1 AS n_words"), bench).collect()}
    assert out == {1: "Before, ! After it " + "and so on " * 10, 3: clean, 4: docs[3][1]}


def test_edge_cases(spark, edge, no_rows):
    none = spark.createDataFrame([], "item_id string, text string")
    assert [r.n_hit for r in D.matches(edge, none).collect()] == [0] * edge.count()
    assert D.decontaminated(edge, none).count() == edge.count()
    bench = spark.createDataFrame([(None, "word " * 10)], "item_id long, text string")
    hit = {r.doc_id: (r.n_hit, r["items"]) for r in D.matches(edge, bench).collect()}
    assert hit[5] == (30_000, [""]) and hit[2] == (0, [])
    assert D.matches(no_rows, bench).count() == 0
