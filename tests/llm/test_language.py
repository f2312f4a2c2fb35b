import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodtick.llm import language as L
from moodtick.llm.common import read

TEXTS = {
    "en": "the house and the garden of that man with this other thing they have seen ",
    "de": "das haus und der garten von dem mann mit dieser anderen sache die sie gesehen haben ",
    "fr": "la maison et le jardin de cet homme avec cette autre chose qu'ils ont vue déjà ",
}
#: Made-up syllables of eight scripts, two languages in three of them.
SCRIPTS = {
    "ru": "до ма сад что эт от ко ры они ви де ли",
    "uk": "бу ді нок і сад що це ї той я кий во ни ба чи ли",
    "el": "το σπί τι και ο κή πος που εί δαν με αυ τό",
    "ar": "ال بيت وال حد يقة التي رأ وها مع هذا",
    "hi": "घर और बगीचा जो उन्होंने देखा के साथ यह",
    "th": "บ้าน และ สวน ที่ พวก เขา เห็น กับ สิ่ง นี้",
    "zh": "房子 和 花园 的 人 看见 了 这个 东西 他们",
    "ja": "いえ と にわ を みた ひと が この もの に 家 庭",
    "ko": "집 과 정원 을 본 사람 이 것 들 에",
    "en": TEXTS["en"],
    "de": TEXTS["de"],
}


def some(lang, rng, n=30, texts=TEXTS):
    return " ".join(rng.choice(texts[lang].split()) for _ in range(n))


def plain_phrases(train, codes):
    """Longest-match parsing by substring search, over the whole text."""
    hay, part, count, i = "".join(map(chr, train)), "".join(map(chr, codes)), 0, 0
    while i < len(part):
        k = 1
        while i + k < len(part) and part[i : i + k + 1] in hay:
            k += 1
        count, i = count + 1, i + k
    return count


@pytest.mark.parametrize("segment", [512, 16, 3, 1])
def test_parsing_against_substring_search(monkeypatch, segment):
    """Phrases go on over the cut of a segment; among the texts are long copies of the training text."""
    monkeypatch.setattr(L, "SEGMENT", segment)
    rng = random.Random(1)
    train = {k: some(k, rng, 60) for k in TEXTS}
    model = L.Model.of({k: [t] for k, t in train.items()})
    texts = [some(rng.choice(list(TEXTS)), rng, rng.randint(1, 30)) + "ж1!? 房" for _ in range(30)]
    texts += [train["de"][5:250], "x" + train["fr"] + train["fr"], "房子" * 30, "a"]
    coded = [L.points(t) for t in texts]
    for t, row in zip(coded, model.phrases(coded)):
        assert row.tolist() == [plain_phrases(L.points(" " + train[x.name]), t) for x in model.languages]


def test_packed_automaton_is_the_automaton():
    rng = random.Random(4)
    codes = [rng.randrange(5) for _ in range(300)]
    following = L.automaton(codes)
    base, owner, target = L.packed(following, 7)
    for s, row in enumerate(following):
        assert {c: int(target[base[s] + c]) for c in range(7) if owner[base[s] + c] == s} == row


def test_predictions(spark, edge, no_rows):
    rng = random.Random(2)
    rows = [(i, some(k, rng, 40), k) for i in range(40) for k in TEXTS] + [(900, "x", None), (901, None, "en"), (902, "12 !", "en"), (None, "abc", "de")]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(labelled)
    held = spark.createDataFrame([(i, some(k, rng, 12), k) for i in range(50) for k in TEXTS], "doc_id long, text string, lang string")
    out = L.identified(held, model).collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97 and all(0 <= r.score <= 1 for r in out)
    odd = {str(r.doc_id) + str(r.fp): r for r in L.identified(edge, model).collect()}
    assert odd["2None"].lang_pred == odd["30"].lang_pred == odd["41"].lang_pred == "und"
    assert odd["67"].lang_pred in TEXTS
    assert L.identified(no_rows, model).count() == 0
    clash = L.identified(edge.withColumn("score", F.lit(1)).withColumn("Lang_pred", F.lit("x")), model)
    assert clash.columns[-2:] == ["_lang_pred", "_score"] and clash.select("score", "_score").count() == 9
    empty = L.train(labelled.limit(0))
    assert {r.lang_pred for r in L.identified(held, empty).collect()} == {"und"}


def test_every_language_of_many_scripts(spark):
    """Eleven languages of eight scripts; letters of the others are phrases of their own."""
    rng = random.Random(3)
    rows = [(i, some(k, rng, 25, SCRIPTS), k) for i in range(30) for k in SCRIPTS]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [x.name for x in model.languages] == sorted(SCRIPTS)
    wrong = [k for k in SCRIPTS for _ in range(30) if model.predict([some(k, rng, 10, SCRIPTS)])[0] != [k]]
    assert len(wrong) <= 3


def test_more_languages_than_any_limit(spark):
    """Every label is learned: 90 languages, each with words of its own."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{i:02d}": [letters[i % 26] + letters[(i // 26 + j) % 26] + letters[(i * j) % 26] for j in range(1, 6)] for i in range(90)}
    rows = [(i, " ".join(w * 20), k) for i, (k, w) in enumerate(words.items())]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))
    assert len(model.languages) == 90
    assert np.mean([model.predict([" ".join(w)])[0] == [k] for k, w in words.items()]) > 0.9


def test_long_text_of_many_segments():
    model = L.Model.of({k: [t] for k, t in TEXTS.items()})
    assert model.predict([TEXTS["de"] * 2000, "", None, "123 !"])[0] == ["de", "und", "und", "und"]


def test_held_out_accuracy_on_documents(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    model = L.train(docs.where(~L.held_out()))
    out = L.identified(docs.where(L.held_out()).select("doc_id", "lang", "text"), model)
    own = out.where("lang IS NOT NULL AND lang_pred <> 'und'")
    assert own.where("lang = lang_pred").count() >= 0.97 * own.count() > 100
