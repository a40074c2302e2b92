import pytest

from qanat.functions.visual import visual_key
from qanat.llm.lookalikes import consistent_form, consistent_texts, lookalike_classes, lookalike_pairs, resolved

SAME = [
    ("على", "علی"),
    ("كتاب يد", "کتاب ید"),
    ("\u0623مر \u0625لى م\u0624من", "\u0627\u0654مر \u0627\u0655لى م\u0648\u0654من"),
    ("VAT", "ＶＡＴ"),
    ("VAT", "VАТ"),
    ("IBAN رقم", "ΙΒΑΝ رقم"),
    ("لا", "ﻻ"),
    ("a b", "a\u00a0b"),
    ("a b", "a\u202fb"),
    ("a b", "a\u3000b"),
    ("كلمة", "كل\u200bمة"),
    ("المادة (5)", "المادة （５）"),
    ("IV A", "Ⅳ 𝐀"),
    ("o A", "օ Ꭺ"),
    ("TAX", "ꓔꓮꓫ"),
    ("صا\u200cحب", "صاحب"),
]
OTHER = [("امر", "أمر"), ("نص", "نصّ"), ("5", "٥"), ("٥", "۵"), ("على", "علي"), ("a\nb", "a b"), ("a  b", "a b"), ("می\u200cکند", "میکند")]


@pytest.mark.parametrize("a, b", SAME)
def test_same_looks(a, b):
    assert consistent_form(a) == consistent_form(b)
    assert visual_key(a) == visual_key(b)


@pytest.mark.parametrize("a, b", OTHER)
def test_other_looks(a, b):
    assert consistent_form(a) != consistent_form(b)
    assert visual_key(a) != visual_key(b)


def test_scripts_of_tokens():
    assert resolved("VАТ") == {"LATIN", "CHEROKEE", "LISU"}  # two letters are Cyrillic, V has no Cyrillic double
    assert resolved("ΙΒΑΝ") >= {"LATIN", "GREEK"} and "CYRILLIC" not in resolved("ΙΒΑΝ")
    assert consistent_form("слово АТ слово") == "слово АТ слово"  # all neighbours are Cyrillic
    assert consistent_form("word АТ word") == "word AT word"
    assert consistent_form("") == ""
    assert consistent_form("این کتاب گچ پژ می\u200cکند") == "این کتاب گچ پژ می\u200cکند"  # Persian keeps its letters


def test_idempotent():
    for a, b in SAME + OTHER:
        for x in (a, b):
            assert consistent_form(consistent_form(x)) == consistent_form(x)


def test_pairs(spark):
    rows = [("1", "d", "على VAT"), ("2", "d", "علی VAT"), ("2", "d", "علی VAT"), ("3", "d", "على VAT"), ("4", "d", "علي VAT"), ("5", "e", "علی VAT"), ("6", "d", ""), ("7", "d", None), (None, "d", "علی VAT"), ("8", None, "علی VAT")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "id string, document_id string, text_ar string, form string")
    assert {tuple(r) for r in lookalike_pairs(frame).collect()} == {("1", "2"), ("2", "3")}
    assert lookalike_pairs(frame.limit(0)).count() == 0
    classes = lookalike_classes(frame).collect()
    assert sorted(r["article_id"] for r in classes) == ["1", "2", "3"] and len({r["class_id"] for r in classes}) == 1 and len({r["spelling_id"] for r in classes}) == 2


def test_every_row_comes_out(spark):
    frame = spark.createDataFrame([("1", "ＡＢ", 1), ("1", "ＡＢ", 1), ("2", None, 2), ("3", "", 3), ("4", "x" * 300_000, 4)], "id string, text string, extra int")
    assert sorted((r["id"], r["extra"], None if r["form"] is None else r["form"][:2]) for r in consistent_texts(frame).collect()) == [("1", 1, "AB"), ("1", 1, "AB"), ("2", 2, None), ("3", 3, ""), ("4", 4, "xx")]
