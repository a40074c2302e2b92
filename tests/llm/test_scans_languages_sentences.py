import itertools
import random

import numpy as np
import pytest

from qanat.llm import languages as L
from qanat.llm import scans as S
from qanat.llm import sentences as X

BODY = ["the registry shall archive the licence file without delay.", "a member of the council may inspect the annual report each quarter.", "the employer must publish the wage ledger before the deadline."]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def test_trie_finds_all_words_within_the_distance():
    rng = random.Random(1)
    vocabulary = {"".join(rng.choice("abcd") for _ in range(rng.randint(1, 7))): 1 for _ in range(400)}
    trie = S.Trie(vocabulary)
    for _ in range(60):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 7)))
        for distance in (0, 1, 2):
            assert {w for w, _ in trie.within(word, distance)} == {w for w in vocabulary if levenshtein(word, w) <= distance}


@pytest.mark.parametrize("line, page", [("- 21 -", True), ("(48)", True), ("[37]", True), ("Page 39 of 123", True), ("صفحة ٥٠", True), ("75/107", True), ("23", True), ("3.", False), ("3)", False), ("67 سنوات.", False), ("15 % x", False), ("", False)])
def test_page_lines(line, page):
    assert S.is_page_line(line) == page


def records(spark, misa, articles, documents):
    return (
        spark.createDataFrame(misa, "rec_id long, text string, source_doc string"),
        spark.createDataFrame(articles, "id string, document_id string, text_ar string, text string"),
        spark.createDataFrame(documents, "id string, source_id string, title_ar string, title_en string"),
    )


def noisy():
    """Records of clean sentences, and some with one kind of noise each."""
    rng = random.Random(2)
    clean = [(i, " ".join(rng.choice(BODY) for _ in range(6)), None) for i in range(60)]
    dirty = [
        (100, "Rules of Zorin\nthe registry shall archive the\nlicence file without delay.\nRULES OF  ZORIN\na member of the council may inspect.", None),
        (101, "the registry shall archive the\n- 7 -\nlicence file without delay.", None),
        (102, "the registry shall arch-\nive the licence file without delay.", None),
        (103, "the registry sha|l archive the licence file without delay.", None),
        (104, "the registry shall archive the\nlicence file without delay.\n\n1. a member of the council may inspect.\n2. the employer", None),
        (105, None, None),
        (106, "", None),
    ]
    return clean + dirty


def test_noise_and_repair(spark):
    articles = [("a1", "d", "نظام زورين\nنص اول هنا في\nالملف.", "x"), ("a1", "d", "نظام زورين\nنص اول هنا في\nالملف.", "x"), ("a2", "d", "نص اول هنا في\nالملف.", "x"), ("a3", None, None, "x")]
    tables = records(spark, noisy(), articles, [("d", "s", "نظام زورين", None)])
    got = sorted(tuple(r) for r in S.scan_noise(*tables).collect())
    assert got == [("articles", "a1", "running_header"), ("misa", "100", "running_header"), ("misa", "101", "page_number"), ("misa", "102", "broken_word"), ("misa", "103", "wrong_char")]
    texts = {(r["record_table"], r["record_id"]): r["text"] for r in S.repaired(*tables).collect()}
    whole = "the registry shall archive the licence file without delay."
    assert [texts["misa", str(i)] for i in (101, 102, 103)] == [whole] * 3
    assert texts["misa", "104"].startswith(whole + "\n\n1. ")


def test_frequent_misreadings_are_found_and_corrected(spark):
    misa = [(i, "deadline " * 1100 + f"ledger inside entry{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}", None) for i in range(70)]
    misa += [(100, "beadline " * 1100, None), (101, "the lebger is here", None), (102, "all insibe of it", None), (103, "clean deadline ledger", None)]
    tables = records(spark, misa, [], [])
    got = sorted(tuple(r) for r in S.scan_noise(*tables).collect())
    assert got == [("misa", str(i), "wrong_char") for i in (100, 101, 102)]
    texts = {r["record_id"]: r["text"] for r in S.repaired(*tables).collect()}
    assert set(texts["100"].split()) == {"deadline"} and texts["101"] == "the ledger is here"


def test_noise_of_empty_tables(spark):
    assert S.scan_noise(*records(spark, [], [], [])).count() == 0


@pytest.mark.parametrize(
    "label, wanted",
    [("ar", "ar"), ("ARA ", "ar"), ("ar-SA", "ar"), ("en, Arabic", "ar en"), ("fas/ur;EN", "en fa ur"), ("unknown", ""), ("", ""), (None, ""), ("und", ""), ("en_GB", "en"), ("French", "fr"), ("de", "de"), ("ar,unknown", "ar")],
)
def test_labels(label, wanted):
    assert L.labelled_languages(label) == frozenset(wanted.split())


TEXTS = {
    "en": "the council shall publish the report. every member may request a copy of the file without delay. the fee is due each year.",
    "fr": "le conseil doit publier le rapport. chaque membre peut demander une copie du dossier sans retard. la taxe est due chaque année.",
    "ar": "على المجلس أن ينشر التقرير. يجوز لكل عضو طلب نسخة من الملف دون تأخير. الرسم مستحق كل سنة.",
    "ur": "کونسل رپورٹ شائع کرے گی۔ ہر رکن بغیر تاخیر فائل کی نقل طلب کر سکتا ہے۔ فیس ہر سال واجب ہے۔",
    "fa": "شورا باید گزارش را منتشر کند. هر عضو می\u200cتواند رونوشت پرونده را بدون تأخیر بخواهد. هزینه هر سال پرداخت می\u200cشود.",
}


def test_languages_of_records(spark):
    documents = spark.createDataFrame([(t * 3 + " " * n, lang, 1) for lang, t in TEXTS.items() for n in range(3)] + [(None, "en", 1), ("x", None, 1)], "text string, lang string, confidence int")
    rows = [
        (1, "ar", TEXTS["ar"]), (2, "en", TEXTS["fr"]), (3, "fr", TEXTS["fr"] + " " + TEXTS["ur"]), (4, None, TEXTS["fa"]), (5, "en", "the member (طلب نسخة) may request a copy of the file."),
        (6, "en", None), (7, "en", ""), (8, "ar", "تقرير المجلس\n" + TEXTS["en"] + "\nتقرير المجلس\n" + TEXTS["en"]),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "rec_id long, language string, text string, true_language string")
    got = {(r["rec_id"], r["true_language"]) for r in L.record_languages(frame, documents).where("NOT labelled").collect()}
    assert got == {(2, "fr"), (3, "fr"), (3, "ur"), (4, "fa"), (8, "en")}
    parts = [r["language"] for r in L.language_segments(frame.where("rec_id = 3"), documents).orderBy("segment_index").collect()]
    assert parts == ["fr", "ur"]
    assert L.record_languages(frame.limit(0), documents).count() == 0


def test_held_out_accuracy():
    model = L.fit({k: [v] for k, v in TEXTS.items()})
    held = {"en": "a member may publish every report of the council.", "fr": "chaque conseil doit demander une copie.", "ar": "يجوز لكل مجلس أن ينشر نسخة.", "ur": "ہر کونسل فائل شائع کر سکتا ہے۔", "fa": "هر شورا باید پرونده را منتشر کند."}
    assert {k: set(L.text_languages(v, model)) for k, v in held.items()} == {k: {k} for k in held}
    assert model.score("councillor").argmax() == model.languages.index("en")  # an unseen word, by its n-grams


def test_other_scripts_and_other_labels(spark):
    model = L.fit({k: [v] for k, v in TEXTS.items()})
    assert L.text_languages("τὸ συμβούλιο ἐκδίδει τὴν ἔκθεσιν αὐτοῦ.", model) == {}
    assert [(s.language, s.confidence) for s in L.segments("τὸ συμβούλιο ἐκδίδει τὴν ἔκθεσιν αὐτοῦ.", model)] == [(L.OTHER, 0.0)]
    german = "der Rat muss den Bericht jedes Jahr im Amt vorlegen. die Gebühr ist sofort fällig."
    rows = [(t * 3 + f" {n}", lang, 1) for lang, t in TEXTS.items() for n in range(3)] + [(german + f" {n}", label, 1) for n, label in enumerate(["de", "DEU", "German"])]
    documents = spark.createDataFrame(rows, "text string, lang string, confidence int")
    records = spark.createDataFrame([(1, "en", "der Rat muss den Bericht im Amt vorlegen.")], "rec_id long, language string, text string")
    assert [(r["true_language"], r["labelled"]) for r in L.record_languages(records, documents).collect()] == [("de", False)]


def test_paths_are_the_best():
    rng = np.random.default_rng(7)
    for _ in range(300):
        n, k = rng.integers(1, 7), 3
        score, price = rng.normal(0, rng.choice([0.3, 3]), (n, k)), rng.choice([0.6, 1.4, 2.0], n).tolist()
        value = lambda p: sum(score[i, x] for i, x in enumerate(p)) - sum(price[i] for i in range(n - 1) if p[i] != p[i + 1])
        assert abs(value(L.best_path(score, price)) - max(value(p) for p in itertools.product(range(k), repeat=int(n)))) < 1e-9


def test_no_label_is_gathered_in_one_task(spark):
    documents = spark.createDataFrame([(f"the council shall publish report {i}. it is due.", "en") for i in range(9000)], "text string, lang string")
    model = L.trained_model(documents)
    assert model.languages == ("en", L.OTHER) and "council" in model.words


def units(text, model=None):
    ends = X.unit_ends(text, model or X.Model())
    assert ends == sorted(set(ends))
    return [text[a:b].strip() for a, b in zip([0, *ends], ends)]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("One is here. Two is here! Is three?", 3),
        ('He said: "One. Two." Then he left.', 2),
        ("The rate is 3.5 per cent. Next one.", 2),
        ("第一句。第二句：“引用。还有。”第四句？", 3),
        ("第一句！“引用。还有。”第四句？", 3),  # the opening mark behind an end belongs to the next unit
        ("Il dit : « Un. Deux. » Puis il part.", 2),
        ("He said: ”One. Two.“ Then he left.", 2),
        ("پہلا جملہ۔ دوسرا جملہ؟", 2),
        ("ประโยคแรก ประโยคที่สอง", 2),
        ("Title of it\n\n1. First item;\n2. Second item.", 3),
        ("a; b … c. D", 2),
        ("", 0),
        (" \n \n", 0),
    ],
)
def test_units(text, wanted):
    assert len(units(text)) == wanted


def test_wrapped_lines_are_no_ends():
    text = "This sentence is wrapped by hand behind its words and\ngoes on in a second line of about the same size, then\nends. Another one follows here."
    assert len(units(text)) == 2


def test_abbreviations_are_learned(spark):
    rng = random.Random(4)
    make = lambda: " ".join(f"The {rng.choice(['clerk', 'agent'])} read Art. {rng.randint(1, 99)} of the {rng.choice(['law', 'code'])}." for _ in range(4))
    rows = [(i, "\n\n".join(make() for _ in range(2))) for i in range(120)] + [(900, None), (901, "")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "id long, text string, sentence_end int")
    got = X.sentence_units(frame)
    assert got.count() == 120 * 8
    assert {r["sentence"][-1] for r in got.collect()} == {"."} and not any(r["sentence"].endswith("Art.") for r in got.collect())
    assert X.sentence_units(frame.limit(0)).count() == 0


def test_a_long_line_elsewhere_does_not_change_wrapped_paragraphs():
    wrapped = "This sentence is wrapped by hand behind its words and\ngoes on in a second line of about the same size, then\nends in a third line that is filled as well to here."
    assert len(units(wrapped)) == 1
    assert len(units(wrapped + "\n\n" + "one long line of words that no wrap has cut " * 5)) == 2
    assert len(units("first entry of a list that is not wrapped\nsecond entry\n" + "third entry that goes on and on " * 6)) == 3


def test_words_are_read_whole():
    long_ = "donaudampfschifffahrtsgesellschaftskapitänsmützen"
    model = X.Model()
    assert X.token_before(f"of {long_}.", 0, 3 + len(long_)) == long_
    assert X._after(f" {long_} x", 0, 60) == long_
    model = counted([f"see {long_}. B of it {i}." for i in range(30)] + [f"it ends here {i}.\n\nso does this one." for i in range(200)])
    assert model.abbreviates(long_) and not model.abbreviates("one")


def counted(texts):
    import pyarrow as pa

    parts = [b for b in X._counted(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))]
    table = pa.Table.from_batches(parts).sort_by("key")
    return X.Model(table["key"].to_numpy(), np.array([table[c].to_numpy() for c in ("inside", "ending", "plain", "opening")]), 0.5)


@pytest.mark.parametrize("text, wanted", [("Առաջին նախադասություն։ Երկրորդ։", 2), ("የመጀመሪያ ዓረፍተ ነገር።ሁለተኛ።", 2), ("ប្រយោគទីមួយ។ប្រយោគទីពីរ។", 2), ("ပထမစာကြောင်း။ဒုတိယ။", 2)])
def test_units_of_other_scripts(text, wanted):
    assert len(units(text)) == wanted


def test_texts_without_blanks_take_time_in_proportion():
    import time

    began = time.perf_counter()
    assert len(units("文" * 40 + "。", None)) == 1 and len(units(("文" * 40 + "。") * 20_000)) == 20_000
    assert time.perf_counter() - began < 20


def test_short_words_and_rare_compounds(spark):
    assert S.corrections("cot", 1, S.Trie({"cat": 100})) == [("cat", 100, "o>a")]
    words = [f"self{chr(97 + i // 26)}{chr(97 + i % 26)}-made" for i in range(40)]
    misa = [(i, " ".join([words[i % 40]] * 6) + " by hand.", None) for i in range(40)] + [(99, "this is selfab-\nmade by hand.", None), (98, "this is sel-\nfab by hand.", None)]
    got = {tuple(r) for r in S.scan_noise(*records(spark, misa, [], [])).collect()}
    assert got == {("misa", "98", "broken_word")}
    assert S.is_page_line("-" * 30 + " 12 " + "-" * 30)
