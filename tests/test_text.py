import random
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from kanaat.functions import labels, text
from kanaat.functions.fixed_values import CATEGORIES, PROMPT

HARD = list("aZİıIğşçöü019½٣_-.,!?%&<>'\" \t\n\r\v\f\x1c\x1d\x1e\x1f\x85\xa0      　​́éñßΣσς漢字🙂")


def column_of(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def strings(n=3000, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(HARD) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def plain_clean(value):
    if not isinstance(value, str):
        return ""
    value = re.sub(r"\d+", "", value.lower())
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", value)).strip()


@pytest.mark.parametrize(
    "given, expected",
    [
        ("İSTANBUL Iğdır 12 çok GÜZEL!!", "istanbul iğdır çok güzel"),
        ("a b c\x1cd\x85e  f", "a b c d e f"),
        ("x_y 3½ ٣ é ñ", "x_y ½ e ñ"),
        ("ürün 10/10 -- İade", "ürün iade"),
        ("", ""),
        (None, ""),
        ("tab\tnew\nline ", "tab new line"),
    ],
)
def test_clean_examples(spark, given, expected):
    assert column_of(spark, [given], text.clean_text(F.col("x"))) == [expected]


def test_clean_equals_plain_rule_and_is_idempotent(spark):
    values = [s for s in strings() if "Σ" not in s]
    cleaned = column_of(spark, values, text.clean_text(F.col("x")))
    assert cleaned == [plain_clean(v) for v in values]
    assert column_of(spark, cleaned, text.clean_text(F.col("x"))) == cleaned


def test_words(spark):
    values = [*strings(), "a b c d", "a b c d e", "a b c d e", None]
    counts = column_of(spark, values, text.word_count(F.col("x")))
    assert counts == [None if v is None else len(v.split()) for v in values]
    kept = column_of(spark, values, text.has_words(F.col("x")))
    assert kept == [v is not None and len(v.split()) >= 5 for v in values]


def test_blank_strip_collapse(spark):
    values = strings()
    assert column_of(spark, values, text.not_blank(F.col("x"))) == [v.strip() != "" for v in values]
    assert column_of(spark, values, text.strip_space(F.col("x"))) == [v.strip() for v in values]
    assert column_of(spark, values, text.collapse_spaces(F.col("x"))) == [re.sub(r"\s+", " ", v).strip() for v in values]


def test_shorten_and_flatten(spark):
    values = ["x" * 299, "x" * 300, "x" * 301, "a\nb\r\nc"]
    got = column_of(spark, values, text.flatten_lines(text.shorten(F.col("x"), 300)))
    assert got == ["x" * 299, "x" * 300, "x" * 300 + "...", "a b c"]


def test_safe_name(spark):
    values = ["İade / İptal / Değişim", "Ödeme (Seçenekler)"]
    assert column_of(spark, values, text.safe_name(F.col("x"))) == ["İade___İptal___Değişim", "Ödeme__Seçenekler_"]


def test_tokens_and_pairs(spark):
    values = strings()
    words = column_of(spark, values, text.tokens(F.col("x")))
    assert words == [re.findall(r"\b\w\w+\b", v.lower()) if "Σ" not in v else w for v, w in zip(values, words)]
    got = column_of(spark, ["bir iki üç dört"], text.unigrams_and_bigrams(text.without(text.tokens(F.col("x")), ["iki"])))
    assert got == [["bir", "üç", "dört", "bir üç", "üç dört"]]
    assert column_of(spark, ["", "tek"], text.unigrams_and_bigrams(text.tokens(F.col("x")))) == [[], ["tek"]]


def test_labels(spark):
    values = ["1", " Evet ", "TRUE", "pozitif", "0", "hayır", "1.0", ""]
    assert column_of(spark, values, labels.normalise_label(F.col("x"))) == [1, 1, 1, 1, 0, 0, 0, 0]


def test_answers(spark):
    assert column_of(spark, ["1", "Evet.", "0", "hayır", "10", ""], labels.parse_answer(F.col("x"))) == [1, 1, 0, 0, 1, 0]


def test_prompt(spark):
    name, description = CATEGORIES[0]
    got = column_of(spark, ["güzel {uygulama}"], labels.render_prompt(F.col("x"), F.lit(name), F.lit(description)))
    expected = PROMPT.replace("{category}", name).replace("{description}", description).replace("{comment}", "güzel {uygulama}")
    assert got == [expected]


def test_sentiment(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (None, None)], "a double, b double")
    p = F.when(F.col("a").isNotNull(), labels.softmax(F.array("a", "b")))
    got = rows.select(labels.sentiment_of_probabilities(p[0], p[1]), labels.polarity(p[0], p[1])).collect()
    assert [r[0] for r in got] == ["Negatif", "Pozitif", "Nötr"]
    assert got[0][1] == 0.0 and got[1][1] > 0 and got[2][1] == 0.0


def test_clock_and_percent(spark):
    rows = spark.createDataFrame([(10.0, 5, 100), (0.0, 0, 10), (100.0, 200, 100)], "e double, c int, t int")
    got = rows.select(labels.clock(labels.seconds_left(F.col("e"), F.col("c"), F.col("t"))), labels.percent_of(F.col("c"), F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("0:03:10", 5.0), ("0:00:00", 0.0), ("0:00:00", 200.0)]


@pytest.mark.parametrize("base", ["https://a.com/migros", "https://a.com/x/y?page=2", "https://a.com", "http://m.b.org/en/25#top"])
@pytest.mark.parametrize("href", ["/migros/1", "https://c.com/z", "//d.com/q", "?page=3", "#t", "rel", "rel/two?x=1", "mailto:a@b.c",
                                  "../up", "../../up?a=../b", "./here", "a/../b", "..", ".", "/r/./s/../t", "a.b/..c"])
def test_absolute_link(spark, base, href):
    rows = spark.createDataFrame([(base, href)], "b string, h string")
    assert rows.select(text.absolute_link(F.col("b"), F.col("h"))).first()[0] == urljoin(base, href)


def test_url_parts(spark):
    urls = ["https://x.com/migros--123?p=2", "https://x.com/a/b"]
    assert column_of(spark, urls, text.topic_name(F.col("x"))) == ["migros", "b"]
    assert column_of(spark, urls, text.page_url(text.url_without_query(F.col("x")), "p", F.lit(3))) == [
        "https://x.com/migros--123?p=3", "https://x.com/a/b?p=3",
    ]
