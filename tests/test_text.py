import pytest
from pyspark.sql import functions as F

from qanat.functions import text as T


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "t string").select(build(F.col("t")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("الشَّرِكَةُ المُسَاهِمَة", "الشركه المساهمه"),
        ("إجراء", "اجراء"),
        ("أحكام", "احكام"),
        ("آخر", "اخر"),
        ("على", "علي"),
        ("مسؤول", "مسوول"),
        ("مسئول", "مسيول"),
        ("  كلمة   أخرى  ", "كلمه اخري"),
        ("", ""),
        (None, ""),
    ],
)
def test_normalize(spark, given, wanted):
    assert one(spark, given, T.normalize_arabic) == wanted


@pytest.mark.parametrize("n, sizes", [(0, []), (100, [100]), (512, [512]), (513, [512, 51]), (704, [512, 242]), (974, [512, 512]), (975, [512, 512, 51]), (1100, [512, 512, 176]), (1600, [512, 512, 512, 214])])
def test_chunks(spark, n, sizes):
    got = one(spark, " ".join(f"w{i}" for i in range(n)), lambda c: T.chunk_windows(T.words(c)))
    assert [len(x) for x in got] == sizes
    if len(got) > 1:
        assert got[1][0] == got[0][-50]


def test_words_split_at_no_break_space(spark):
    assert one(spark, "a\u00a0b", T.words) == ["a", "b"]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("المادة الرابعة", [4]),
        ("المادة الرابعة عشرة", [14]),
        ("بالمادة الثالثة والعشرون", [23]),
        ("المادة الأولى: التعريفات", []),
        ("المادة الأولى: نص المادة الثانية عشرة.", [12]),
        ("للمادة الرابعة عشرة", [14]),
        ("نص بلا إحالة", []),
        ("", []),
        (None, []),
        ("المادة الثانية عشرة:", []),
        ("المادة الأولى بعد المائة", [101]),
        ("المادة الحادية عشرة", [11]),
        ("المادة الرابعة والعشرون بعد المائتين", [224]),
    ],
)
def test_citations(spark, given, wanted):
    assert [c["article_number"] for c in one(spark, given, T.citations)] == wanted


def test_split_and_corruption(spark):
    pieces = one(spark, "مقدمة المادة (1) نص المادة (2) آخر", T.split_articles)
    assert [p["number"] for p in pieces] == [0, 1, 2]
    assert [p["number"] for p in one(spark, "بلا عنوان", T.split_articles)] == [1]
    found = one(spark, "كلممممة abcة \x01", T.corruption)
    assert (found["repeated_letters"], found["glued_latin"], found["controls"]) == (1, 1, 1)


def test_citations_behind_any_blank(spark):
    assert [c["article_number"] for c in one(spark, "وفقا للمادة الرابعة عشرة من النظام", T.citations)] == [14]
    assert one(spark, "المادة الثالثة : نص", T.citations) == []


def test_snippets(spark):
    text = "a" * 40 + "كلممممة" + "b" * 40
    assert one(spark, text, lambda c: T.snippets(c, T.REPEATED)) == ["a" * 13 + "كلممممة" + "b" * 14]
    assert one(spark, None, lambda c: T.snippets(c, T.REPEATED)) == []
