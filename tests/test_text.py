import random
import re

import pytest
from pyspark.sql import functions as F

from tidewire import fixed_values as fixed
from tidewire.functions import lexicon as lexicon_module
from tidewire.functions import polarity, text
from tidewire.functions.lexicon import Lexicon, contains_any


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [row.x for row in rows.select("i", expression("t").alias("x")).orderBy("i").collect()]


def test_sentiment_goldens(spark):
    texts = ["أنا سعيد اليوم", "الوضع صعب", "سعيد لكن قلق", "يوم عادي", "", None, "ما في أمل"]
    assert column(spark, texts, lambda t: polarity.lexicon_sentiment(
        t, ("سعيد", "أمل"), ("قلق", "صعب"))) == [
        "positive", "negative", "neutral", "neutral", "neutral", "neutral", "positive"]


def test_sentiment_is_symmetric(spark):
    texts = ["a", "b", "ab", "", None, "xay", "B A"]
    one = column(spark, texts, lambda t: polarity.lexicon_sentiment(t, ("a",), ("b",)))
    other = column(spark, texts, lambda t: polarity.lexicon_sentiment(t, ("b",), ("a",)))
    swapped = {"positive": "negative", "negative": "positive", "neutral": "neutral"}
    assert [swapped[x] for x in one] == other


TOPICS = (Lexicon("Work", ("job", "hr")), Lexicon("Anxiety", ("panic",)),
          Lexicon("Economy", ("price",)))


def test_topic_goldens(spark):
    texts = ["HR called", "panic about my job", "Panic!", "three prices", "price up", "hello", "",
             None]
    assert column(spark, texts, lambda t: polarity.topic_priority(t, TOPICS)) == [
        "Work", "Work", "Anxiety", "Work", "Economy", "General", "General", "General"]


def test_whole_words(spark):
    topics = (*TOPICS[:2], Lexicon("Economy", ("prices",)))
    texts = ["three prices", "hr.", "_hr_", "hr1", "قلق hr،", "the HR"]
    assert column(spark, texts, lambda t: polarity.topic_priority(t, topics, match="word")) == [
        "Economy", "Work", "General", "General", "Work", "Work"]


def test_default_topics_and_categories(spark):
    texts = ["بدي وظيفة", "عندي Overthinking", "سعر الذهب", "صباح الخير", "HR"]
    assert column(spark, texts, polarity.topic_priority) == [
        "Unemployment", "Anxiety", "Economy", "General", "Unemployment"]
    assert column(spark, ["غلاء", "طبيب", "ناس", "مدير", "x", None],
                  polarity.message_category) == ["اقتصادية", "صحية", "اجتماعية", "عمل", "عامة",
                                                 "عامة"]


def test_category_minds_case(spark):
    category = (Lexicon("c", ("Abc",)),)
    assert column(spark, ["xAbcx", "abc"],
                  lambda t: polarity.message_category(t, category, "d")) == ["c", "d"]


def test_long_lexicon_equals_short_ones(spark):
    words = [f"w{i}q" for i in range(250)]
    texts = ["xW249Qy", "w7q", "w250q", None, ""]
    assert column(spark, texts, lambda t: contains_any(t, words)) == [
        True, True, False, False, False]
    assert column(spark, texts, lambda t: contains_any(t, words, case_sensitive=True)) == [
        False, True, False, False, False]


def _keywords(draw, n):
    letters = "abcdéßعمل😀 .*"
    return list(dict.fromkeys("".join(draw.choices(letters, k=draw.randint(1, 6)))
                              for _ in range(n)))


@pytest.mark.parametrize("match", ["substring", "word"])
@pytest.mark.parametrize("case_sensitive", [False, True])
def test_index_of_random_keywords_equals_brute_force(spark, match, case_sensitive):
    draw = random.Random(f"{match}{case_sensitive}")
    words = [word for word in _keywords(draw, 400) if match == "substring" or word.strip(" .*")]
    lexicons = [Lexicon(f"l{at}", words[at::7]) for at in range(7)]
    texts = ["".join(draw.choices("abcdéßعمل😀 .*ABÉ\n", k=draw.randint(0, 9)))
             for _ in range(300)]

    def first(value):
        body = value if case_sensitive else value.lower()
        for lexicon in lexicons:
            for word in lexicon.keywords:
                pattern = re.escape(word)
                if match == "word":
                    pattern = rf"(?<!\w){pattern}(?!\w)"
                if re.search(pattern, body):
                    return lexicon.label
        return "none"

    found = column(spark, texts, lambda t: lexicon_module.first_label(
        t, lexicons, "none", match=match, case_sensitive=case_sensitive))
    assert found == [first(value) for value in texts]
    assert len(set(found)) > 3


def test_index_equals_the_chain_and_keeps_the_plan_small(spark):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(3, 7))) for _ in range(5000)]
    texts = ["".join(draw.choices("abcdefghij ", k=n)) for n in (0, 1, 2, 5, 20, 40, 80, 3000)] * 3
    texts = [value.upper() if at % 2 else value for at, value in enumerate(texts)] + [None]

    def tree(count):
        df = spark.createDataFrame([("a",)], "t string").select(polarity.lexicon_sentiment(
            "t", words[:count], words[2500:2500 + count]).alias("x"))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return len(re.findall(r"(?i)(?<!array_)contains\(", plan))

    assert tree(300) == tree(2500) == 1
    looked_up = column(spark, texts, lambda t: polarity.lexicon_sentiment(
        t, words[:2500], words[2500:]))

    def brute(value):
        body = (value or "").lower()
        glad, sad = (any(word in body for word in half) for half in (words[:2500], words[2500:]))
        return "positive" if glad and not sad else "negative" if sad and not glad else "neutral"

    assert looked_up == [brute(value) for value in texts]


def test_a_label_lowers_its_text_once(spark):
    df = spark.createDataFrame([("a", "b")], "text string, id string").withColumns({
        "sentiment": polarity.lexicon_sentiment("text")})
    plan = df.filter(F.col("sentiment") == "negative").select("id")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1
    topics = df.select(polarity.topic_priority("text").alias("topic"))
    assert topics._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1


def test_empty_keyword_is_refused():
    with pytest.raises(ValueError):
        Lexicon("x", ("a", ""))


def test_lexicon_without_words_never_matches(spark):
    assert column(spark, ["a", None], lambda t: contains_any(t, [])) == [False, False]


def test_rating_goldens(spark):
    labels = ["5 stars", "4", "15", "1 star", "2 stars", "3 stars", "positive", "", None]
    assert column(spark, labels, polarity.rating_polarity) == [
        *["positive"] * 3, *["negative"] * 2, *["neutral"] * 4]


def test_keyword_goldens(spark):
    texts = ["قلقاً #عمل_جديد 123 ٤٥ HR, don't", "the cat, the dog & the cat", "a b cc", None,
             "one two six ten red sky", "  \n tab\tsep\n"]
    assert column(spark, texts, lambda t: text.keywords(t, ("the",))) == [
        ["قلقا", "عمل_جديد", "don"], ["cat", "dog"], [], [],
        ["one", "two", "six", "ten", "red"], ["tab", "sep"]]


def test_keywords_without_stopwords(spark):
    assert column(spark, ["the cat"], lambda t: text.keywords(t, ())) == [["the", "cat"]]


def plain_normal(value):
    """What the wanted result is, in the terms of Python's own regular expressions."""
    if not value:
        return ""
    return re.sub(r"\d+", "", re.sub(r"[^\w\s]", " ", value)).strip()


def random_texts(n, seed=5):
    pick = random.Random(seed)
    letters = "abزyعمل ٤٥12 _-#!.\t\n  ًّé½²漢İ'\x1c"
    return ["".join(pick.choice(letters) for _ in range(pick.randrange(40))) for _ in range(n)]


def test_normalize_equals_python(spark):
    texts = random_texts(1500)
    assert column(spark, texts, text.normalize_text) == [plain_normal(t) for t in texts]


def test_keywords_equal_python(spark):
    texts = random_texts(1000, 6)
    wanted = []
    for value in texts:
        words = [w for w in plain_normal(value).split()
                 if w not in fixed.STOPWORDS and len(w) > 2]
        wanted.append(list(dict.fromkeys(words))[:5])
    assert column(spark, texts, text.keywords) == wanted


def test_topics_equal_python(spark):
    texts = [t + w for t, w in zip(random_texts(600, 7), ["HR", "شغل", "panic", "سعر", "", "قل"]
                                   * 100)]

    def plain(value):
        lowered = value.lower()
        for label, words in (("Unemployment", fixed.UNEMPLOYMENT_WORDS),
                             ("Anxiety", fixed.ANXIETY_WORDS), ("Economy", fixed.ECONOMY_WORDS)):
            if any(word in lowered for word in words):
                return label
        return "General"

    assert column(spark, texts, polarity.topic_priority) == [plain(t) for t in texts]


def test_tokens(spark):
    texts = ["don't #x_1 قلقا!", "", None]
    assert column(spark, texts, text.tokens) == [["don", "t", "x_1", "قلقا"], [], []]
    assert column(spark, texts, text.clean_tokens) == [["dont", "x_1", "قلقا"], [], []]


def test_trimming_a_long_run_is_linear(spark):
    value = "a" + "!" * 200_000 + "b"
    assert len(column(spark, [value], text.normalize_text)[0]) == 200_002


def test_text_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("x",)], "t string").select(
        polarity.lexicon_sentiment("t"), polarity.topic_priority("t"), text.keywords("t"),
        F.size(text.tokens("t")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
