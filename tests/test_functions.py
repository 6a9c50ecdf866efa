"""Column functions on hand-checked values."""

import math
import re
import string
import unicodedata

import pytest
from pyspark.sql import functions as F

from tastelens.functions import lexicon as L
from tastelens.functions import scalar as S
from tastelens.functions import text as X


def apply(spark, values, fn, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", fn(F.col("v"))).collect())]


def test_normalize_text(spark):
    given = ["“Great” – it’s…\tok 😀 ＆ ｆｕｌｌ", "a\u001cb　c", "  x � y ", "", None]
    assert apply(spark, given, X.normalize_text) == [
        '"Great" - it\'s... ok & full', "a b c", "x y", "", None,
    ]


def test_normalize_text_like_python(spark):
    samples = [
        "Ｃafé ﬁne ½ “q” —  …  ", "éclair", "一二三 好吃", " thin hair space",
        "plain text stays", "ŀ ſ ŉ", "🍜🍣 ramen", "a\x85b\x0bc\x0cd",
    ]

    def rule(s):
        s = unicodedata.normalize("NFKC", s)
        for a, b in zip("‘’“”–—＆", "''\"\"--&"):
            s = s.replace(a, b)
        s = s.replace("…", "...").replace("�", " ")
        s = re.sub("[\U0001F300-\U0001FAFF]", " ", s)
        return re.sub(r"\s+", " ", s).strip()

    assert apply(spark, samples, X.normalize_text) == [rule(s) for s in samples]


def test_combine_title_text(spark):
    pairs = [("", "x"), ("x", ""), ("Good", "good"), ("Good", "good food"), ("Nice", "good"),
             ("", ""), (" a ", " b ")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r[1] for r in sorted(df.select("i", X.combine_title_text(F.col("a"), F.col("b"))).collect())]
    assert got == ["x", "x", "good", "good food", "Nice good", "", "a b"]


def test_ascii_ratio_and_script(spark):
    assert apply(spark, ["", "abcé", "abc", "😀a"], X.ascii_ratio) == [0.0, 0.75, 1.0, 0.5]
    assert apply(spark, ["好吃", "cafe", ""], X.has_script) == [True, False, False]


def test_entity_id(spark):
    given = ["/Restaurant_Review-g294217-d123-Reviews", None, "nolink", "-d99999999999999999999-"]
    assert apply(spark, given, S.entity_id) == [123, None, None, None]


def test_tokenize(spark):
    assert apply(spark, ["I don't like it's-a 'x' THE rock'n'roll"], X.tokenize) == [
        ["i", "don't", "like", "it's", "a", "x", "the", "rock'n", "roll"]
    ]


def test_words_and_pairs(spark):
    words = lambda c: X.words_and_pairs(F.split(c, " "))
    assert apply(spark, ["a b c", "a"], words) == [["a", "b", "c", "a b", "b c"], ["a"]]


def test_rating_class(spark):
    ratings = [0.0, 1.0, 2.0, 2.5, 3.0, 4.0, 5.0, 6.0, None]
    code = lambda c: S.class_code(S.rating_class(c))
    assert apply(spark, ratings, code, "double") == [0, 0, 0, 1, 1, 2, 2, -1, -1]
    assert apply(spark, [5.0, 4.0, None], S.five_star, "double") == [1, 0, 0]


def test_numbers(spark):
    assert apply(spark, ["3", "x", None, "NaN", "1e2"], S.to_number) == [3.0, 0.0, 0.0, 0.0, 100.0]
    assert apply(spark, [1 / 128, 3 / 128, -1e-9], lambda c: S.half_even(c, 6), "double") == [
        0.007812, 0.023438, 0.0,
    ]
    assert apply(spark, [0.0, 2.0], lambda c: S.safe_div(F.lit(1), c), "double") == [0.0, 0.5]
    assert apply(spark, [True, False, None], S.boolean_label, "boolean") == ["True", "False", "nan"]


def test_dates(spark):
    day = lambda c: F.date_format(S.parse_date(c), "yyyy-MM-dd")
    assert apply(spark, ["2024-01-31", "2024-02-30", "bad", "2024-01-31 x"], day) == [
        "2024-01-31", None, None, None,
    ]


def test_first_present(spark):
    df = spark.createDataFrame([(0, 5), (3, 5), (None, 7)], "a int, b int")
    got = [r[0] for r in df.select(S.first_present(F.col("a"), F.col("b"))).collect()]
    assert got == [5, 3, 7]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("not very good but terrible", (0, 2, 1, 2, -1.0, "negative")),
        ("not a b c good", (1, 0, 0, 1, 1.0, "positive")),
        ("not mixed", (1, 1, 1, 2, 0.0, "neutral")),
        ("hello", (0, 0, 0, 0, 0.0, "neutral")),
        ("", (0, 0, 0, 0, 0.0, "neutral")),
        ("good not", (1, 0, 0, 1, 1.0, "positive")),
    ],
)
def test_lexicon_sentiment(spark, text, expected):
    score = lambda c: L.lexicon_sentiment(
        X.tokenize(c), ["good", "mixed"], ["terrible", "mixed"], ["not"]
    )
    assert tuple(apply(spark, [text], score)[0]) == expected


def test_swapped_lists_negate_the_score(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    up, down = ["the", "is"], ["was", "of"]

    def score(a, b):
        return L.lexicon_sentiment(X.tokenize(F.col("text")), a, b, ["and"])["lexicon_sentiment_score"]

    total = docs.select((score(up, down) + score(down, up)).alias("s")).filter("s <> 0").count()
    assert total == 0


def test_emotions(spark):
    emotions = {"joy": ["yay", "both"], "anger": ["both", "grr"], "trust": ["yay"]}
    profile = lambda c: L.emotion_profile(X.tokenize(c), emotions)
    tie, none, twice = apply(spark, ["both", "so what", "grr grr yay word"], profile)
    assert (tie.happy_count, tie.anger_count, tie.dominant_emotion) == (1, 1, "happy")
    assert (none.dominant_emotion, none.happy_ratio) == ("none", 0.0)
    assert (twice.dominant_emotion, twice.anger_ratio, twice.nrc_trust_count) == ("anger", 0.5, 1)


# --- valence against a plain-Python statement of the rules --------------------------------------

TABLE = {"good": 1.9, "great": 3.1, "bad": -2.5, "the": 1.5, "was": -2.0, "is": 0.5, "from": -1.0}
NEGATIONS = ["not", "never", "without", "no", "of"]
BOOST, DAMP = ["very", "that", "are"], ["slightly", "barely"]


def brute_valence(text):
    words = []
    for word in re.split(r"\s+", text):
        bare = word.strip(string.punctuation)
        if word:
            words.append(word if len(bare) <= 2 else bare)
    low = [w.lower() for w in words]
    loud = [w.isupper() for w in words]
    differs = any(loud) and not all(loud)
    push = {w: 0.293 for w in BOOST} | {w: -0.293 for w in DAMP}

    def negated(w):
        return w in NEGATIONS or w.endswith("n't")

    scores = []
    for i, w in enumerate(low):
        if w not in TABLE or w in push:
            scores.append(0.0)
            continue
        v = TABLE[w]
        if loud[i] and differs:
            v += 0.733 if v > 0 else -0.733
        for back in (1, 2, 3):
            if i < back or low[i - back] in TABLE:
                continue
            previous = low[i - back]
            s = 0.0
            if previous in push:
                s = push[previous] * (-1 if v < 0 else 1)
                if loud[i - back] and differs:
                    s += 0.733 if v > 0 else -0.733
            v += s * (1.0, 0.95, 0.9)[back - 1]
            between = low[i - back + 1:i]
            if previous == "never" and any(b in ("so", "this") for b in between):
                v *= 1.25
            elif previous == "without" and "doubt" in between:
                pass
            elif negated(previous):
                v *= -0.74
        if i >= 1 and low[i - 1] == "least" and not (i >= 2 and low[i - 2] in ("at", "very")):
            v *= -0.74
        scores.append(v)
    if "but" in low:
        at = low.index("but")
        scores = [s * 0.5 if i < at else s * 1.5 if i > at else s for i, s in enumerate(scores)]
    if not scores:
        return (0.0, 0.0, 0.0, 0.0)
    marks = min(text.count("!"), 4) * 0.292
    asks = text.count("?")
    marks += 0.0 if asks <= 1 else 0.96 if asks > 3 else asks * 0.18
    total = sum(scores)
    raised = total + marks if total > 0 else total - marks if total < 0 else total
    up = sum(s + 1 for s in scores if s > 0)
    down = sum(1 - s for s in scores if s < 0)
    flat = sum(1 for s in scores if s == 0)
    up, down = up + (marks if up > down else 0), down + (marks if down > up else 0)
    whole = up + down + flat
    return (raised / math.sqrt(raised * raised + 15), down / whole, flat / whole, up / whole)


SENTENCES = [
    "The food was good!", "the food is NOT good", "very GOOD but slightly bad???", "never so good",
    "without a doubt good", "without doubt great", "isn't great at all!!!!!!", "least good",
    "at least good", "not very good", "barely great, not bad", "", "   ", "GREAT GOOD", ":) good",
    "no problem here", "bad bad bad but good", "That was THAT good", "never this bad", "a-b (good)",
]


def test_valence_rules(spark, folder):
    docs = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    texts = SENTENCES + docs
    profile = lambda c: L.valence_profile(c, TABLE, NEGATIONS, BOOST, DAMP)
    for text, row in zip(texts, apply(spark, texts, profile)):
        expected = brute_valence(text)
        got = (row.vader_compound, row.vader_neg, row.vader_neu, row.vader_pos)
        for a, b, unit in zip(got, expected, (1e-4, 1e-3, 1e-3, 1e-3)):
            assert abs(a - b) <= unit * 0.51, (text[:80], got, expected)


def test_numbers_that_only_a_cast_would_read(spark):
    from tastelens.functions.scalar import safe_div, to_number

    rows = [("12d", 0.0), ("12f", 0.0), ("0x1p3", 0.0), (" 1.5 ", 1.5), ("-2e3", -2000.0), (None, 0.0)]
    df = spark.createDataFrame(rows, "a string, wanted double")
    assert all(r[0] == r[1] for r in df.select(to_number(F.col("a")), "wanted").collect())
    pair = spark.createDataFrame([(1.0, float("nan")), (float("inf"), 1.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in pair.select(safe_div(F.col("a"), F.col("b"))).collect()] == [0.0] * 4


def test_a_thousand_valences(spark):
    from tastelens.functions import lexicon as L

    table = {f"w{i}": i / 250 + 0.004 for i in range(1_000)}
    df = spark.createDataFrame([(["w3", "no", "w999"],)], "t array<string>")
    total = df.select(L.valence_sum(F.col("t"), table)).first()[0]
    assert abs(total - (table["w3"] + table["w999"])) < 1e-9
