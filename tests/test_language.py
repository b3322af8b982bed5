"""The language model against plain Python."""

import collections
import math
import random
import re

import pytest

from pagelens.operators import language

TEXTS = [("the cat sat on the mat and the dog ran", "en"), ("this is the house that the man built", "en"), ("der Hund und die Katze sind im Haus", "de"),
         ("das ist ein großes Haus mit vielen Türen", "de"), ("le chat et le chien sont dans la maison", "fr"), ("", "fr"), (None, "fr"), ("nobody knows", None)]


def grams(text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    return [f"  {w}  "[i:i + 3] for w in words for i in range(len(w) + 2)]


def best(text, texts):
    docs = collections.Counter(lang for _, lang in texts if lang)
    counts = {lang: collections.Counter(g for t, other in texts if other == lang for g in grams(t)) for lang in docs}
    known = set().union(*counts.values())
    all_grams = grams(text)
    used = [g for g in all_grams if g in known]
    if text is None or not used or 2 * len(used) < len(all_grams):
        return None
    scores = {lang: math.log(docs[lang] + 1) - math.log(sum(docs.values()) + len(docs))
              + sum(math.log(counts[lang][g] + 1) - math.log(sum(counts[lang].values()) + len(known)) for g in used) for lang in sorted(docs)}
    return max(scores, key=scores.get)


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark.createDataFrame(TEXTS, "text string, lang string"))


CASES = [None, "", "123 !?", "the house", "die Katze", "le chien", "Haus", "xyzzy qqq", "Сегодня в городе открыли мост", "今日は良い天気です",
         "Сегодня the", "the the the the Сегодня", "THE CAT", "a", "the\nhouse"]


def test_languages(spark, model):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(100, "the house"), (101, None)]
    found = {r.i: r.language for r in language.with_language(spark.createDataFrame(rows, "i int, snippet string"), model).collect()}
    assert found == {i: best(t, TEXTS) for i, t in rows}
    assert found[8] is None and found[9] is None and found[3] == "en"


def test_random_texts(spark):
    r = random.Random(4)
    words = {lang: ["".join(r.choices(letters, k=r.randint(1, 6))) for _ in range(30)] for lang, letters in (("x", "abcd"), ("y", "cdef"), ("z", "aef"))}
    texts = [(" ".join(r.choices(words[lang], k=r.randint(0, 15))), lang) for lang in "xyz" for _ in range(12)]
    trained = language.train(spark.createDataFrame(texts, "text string, lang string"))
    rows = [(i, " ".join(r.choices(words["x"] + words["y"] + words["z"] + ["qqqq"], k=r.randint(0, 9)))) for i in range(80)]
    found = {row.i: row.language for row in language.with_language(spark.createDataFrame(rows, "i int, snippet string"), trained).collect()}
    assert found == {i: best(t, texts) for i, t in rows}


def test_model_is_read_back_and_empty_tables(spark, model):
    again = language.LanguageModel(spark, model.folder)
    empty = spark.createDataFrame([], "i int, snippet string")
    assert language.with_language(empty, again).collect() == []
    nothing = language.train(spark.createDataFrame([], "text string, lang string"))
    found = language.with_language(spark.createDataFrame([(1, "the house")], "i int, snippet string"), nothing).first()
    assert found.language is None


def test_rows_keep_their_columns(spark, model):
    rows = spark.createDataFrame([("the house", "n", 1), ("the house", "m", 2)], "snippet string, word string, known int")
    assert sorted(map(tuple, language.with_language(rows, model).collect())) == [("the house", "m", 2, "en"), ("the house", "n", 1, "en")]
