"""Expressions on hand-made rows."""

import datetime
import html

from pyspark.sql import functions as F

from newsloom.functions import dates, features, text as tx, urls
from newsloom.functions.page_text import with_page_text
from newsloom.operators.language import detect_language, train_profiles


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_white_space_is_python_white_space(spark):
    raw = "a b\x1cc\x85d \t\n e f　g"
    assert one(spark, tx.collapse_whitespace(F.col("t")), t=f" {raw} ") == " ".join(raw.split())
    assert one(spark, tx.word_count(F.col("t")), t=raw) == len(raw.split())
    assert one(spark, tx.word_count(F.col("t")), t="") == 0


def test_tags_go_before_entities(spark):
    escaped = "<p>x</p>&lt;b&gt;y"
    assert one(spark, tx.strip_tags(F.col("t")), t=escaped) == "x &lt;b&gt;y"
    assert one(spark, tx.decode_entities(tx.strip_tags(F.col("t"))), t=escaped) == "x <b>y"
    assert one(spark, tx.strip_tags(F.col("t")), t=None) == ""


def test_entities_like_the_standard_library(spark):
    raw = "&amp;lt; &eacute;&#233;&#xe9; &nbsp;&copy &notit; &unknown; &#0;"
    assert one(spark, tx.decode_entities(F.col("t")), t=raw) == html.unescape(raw)


def test_normalise_empty_is_null(spark):
    assert one(spark, tx.normalise(F.col("t")), t=" &nbsp; \t") is None
    assert one(spark, tx.normalise(F.col("t")), t=None) is None


def test_choose_text(spark):
    pick = tx.choose_text(F.col("a"), F.col("b"))
    assert one(spark, pick, a="a" * 200, b="b" * 900) == "a" * 200
    assert one(spark, pick, a="a" * 199, b="b" * 200) == "b" * 200
    assert one(spark, pick, a="aa", b="bb") == "aa"
    assert one(spark, pick, a=None, b=None) == ""


def test_urls(spark):
    assert one(spark, urls.host(F.col("u")), u="https://www.FT.com:80/x?y") == "ft.com"
    assert one(spark, urls.host(F.col("u")), u="not a url") == ""
    assert one(spark, urls.in_domains(F.col("u")), u="http://edition.wired.com/a") is True
    assert one(spark, urls.in_domains(F.col("u")), u="http://hardwired.com/a") is False
    assert one(spark, urls.without_query(F.col("u")), u="http://a/b?c=1?d") == "http://a/b"


def test_dates(spark):
    utc = datetime.timezone.utc

    def read(text):
        seconds = one(spark, F.unix_seconds(dates.parse_date(F.col("t"))), t=text)
        return seconds and datetime.datetime.fromtimestamp(seconds, utc).isoformat()

    assert read("Tue, 02 Jan 2024 10:00:00 GMT") == "2024-01-02T10:00:00+00:00"
    assert read("2 Jan 2024 10:00:00 EST") == "2024-01-02T15:00:00+00:00"
    assert read("Tue, 02 Jan 2024 10:00 +0530") == "2024-01-02T04:30:00+00:00"
    assert read("2024-01-02T10:00:00+01:00") == "2024-01-02T09:00:00+00:00"
    assert read("yesterday") is None


def test_embedding_texts(spark):
    text = one(spark, features.content_text(F.col("t")), t="  " + "x" * 2000)
    assert text == ("content: " + "x" * 1024)[:1024]
    assert one(spark, features.content_text(F.col("t")), t="   ") is None
    general = features.general_text(F.col("t"), F.col("s"), F.col("c"), F.col("k"))
    assert one(spark, general, t=" T ", s="", c="body", k="News") == "title: T category: News content: body"


def test_feature_sets(spark):
    def size(text):
        return one(spark, F.size(features.feature_set(F.col("t"))), t=text)

    assert size("one two three four") == 2
    assert size("One") == 1
    assert size("a b c a b c") == 3
    assert one(spark, features.feature_set(F.col("t")), t="?!") is None


def test_dense_vectors_have_length_one(spark):
    rows = spark.createDataFrame([("a b a",), ("",), (None,)], "t string")
    got = [r.v for r in features.with_dense_vector(rows, "t", "v").collect()]
    assert abs(sum(x * x for x in got[0]) - 1) < 1e-12 and len(got[0]) == 384
    assert got[1] is None and got[2] is None


LONG = "This paragraph is certainly longer than forty characters, number "


def page(spark, body):
    return with_page_text(spark.createDataFrame([(body,)], "h string"), "h", "x").first()["x"]


def test_page_text_takes_the_richest_container(spark):
    got = page(spark, f"""<body><div><p>{LONG}0</p></div>
        <article><div><p>{LONG}1</p></div><p class="x">{LONG}2 &amp; <b>bold</b></p><p>short</p></article>
        <nav><p>{LONG}3</p><p>{LONG}3</p><p>{LONG}3</p></nav><p>{LONG}4</p></body>""")
    assert got == f"{LONG}1\n\n{LONG}2 & bold"


def test_page_text_ties_and_fallback(spark):
    assert page(spark, f"<div><p>{LONG}1</p></div><section><p>{LONG}2</p></section>") == LONG + "1"
    assert page(spark, f"<p>{LONG}1<p>{LONG}2<!-- <p>{LONG}3</p> -->") == f"{LONG}1\n\n{LONG}2"
    assert page(spark, f"<div></div><script>'</p>'</script><p>{LONG}1</p></div>") == LONG + "1"
    assert page(spark, "<p>short</p>") == ""


def test_language_rules(spark):
    train = spark.createDataFrame(
        [("the cat and the dog went to the other house and then they were there", "en"),
         ("le chat et le chien sont dans la maison et les autres aussi avec nous", "fr")], "text string, lang string")
    texts = spark.createDataFrame(
        [(1, "les chats et les chiens sont avec nous dans la maison des autres"), (2, "le chat"), (3, None),
         (4, "1" * 60)], "id int, text string")
    got = {r.id: r.language for r in detect_language(texts, train_profiles(train), "id", "text").collect()}
    assert got == {1: "fr", 2: "en", 3: "en", 4: "en"}
