"""Text operators as Column expressions: they run inside whole-stage code and need no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space of the tokenizer and of trimming (it has U+FEFF and no U+0085).
WS = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
# Marks that normalisation drops, letters it folds, and what it folds them into.
DROPPED_MARKS = r"[\x{64B}-\x{65F}\x{670}]"
FOLDED, FOLDED_TO = "إأآىؤئة", "ااايويه"
# Arabic ordinals of citations, and the hundreds.
ORDINAL_UNITS = {"الأولى": 1, "الاولى": 1, "الحادية": 1, "الثانية": 2, "الثالثة": 3, "الرابعة": 4, "الخامسة": 5, "السادسة": 6, "السابعة": 7, "الثامنة": 8, "التاسعة": 9, "العاشرة": 10}
ORDINAL_TENS = {"العشرون": 20, "الثلاثون": 30, "الأربعون": 40, "الخمسون": 50, "الستون": 60, "السبعون": 70, "الثمانون": 80, "التسعون": 90}
TEEN = "عشرة"
HUNDREDS = {"المائة": 100, "المائتين": 200}
# Phrases of web pages that are no legal text.
WEB_PHRASES = ("government website registered", "privacy policy", "cookies", "skip to content")

CHUNK_WORDS, CHUNK_OVERLAP = 512, 50
CITATION = rf"(?:ال|لل)ماد[ةه]{WS}+({'|'.join(ORDINAL_UNITS)})(?:{WS}+({TEEN}))?(?:{WS}+و({'|'.join(ORDINAL_TENS)}))?(?:{WS}+بعد{WS}+({'|'.join(HUNDREDS)}))?({WS}{{0,2}}[:：])?"
ARABIC = r"[\x{600}-\x{6FF}]"
# Fixed value: a header of an article in running text.
ARTICLE_HEADER = rf"الماد[ةه]{WS}*\({WS}*(\d+){WS}*\)"


def squeeze(c: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, f"{WS}+", " "), "^ +| +$", "")


def normalize_arabic(c: Column) -> Column:
    """Without vowel marks, with letter variants folded and white space squeezed; null becomes ''."""
    return squeeze(F.translate(F.regexp_replace(F.coalesce(c, F.lit("")), DROPPED_MARKS, ""), FOLDED, FOLDED_TO))


def words(c: Column) -> Column:
    """The words of a text; null and '' have none."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), f"{WS}+"), lambda w: w != "")


def chunk_windows(tokens: Column, size: int = CHUNK_WORDS, overlap: int = CHUNK_OVERLAP) -> Column:
    """Windows of `size` words, each beginning `overlap` words before the last one's end; no words, no window."""
    n = F.size(tokens)
    count = F.when(n == 0, 0).when(n <= size, 1).otherwise(F.ceil((n - overlap) / (size - overlap))).cast("int")
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(tokens, i * (size - overlap) + 1, size))).otherwise(F.array().cast("array<array<string>>"))


def is_arabic(text: Column, language: Column | None = None) -> Column:
    """By label or by script."""
    by_script = F.coalesce(text.rlike(ARABIC), F.lit(False))
    return by_script if language is None else by_script | F.coalesce(language == "ar", F.lit(False))


def _number(table: dict[str, int], word: Column) -> Column:
    held = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.when(word != "", F.coalesce(F.try_element_at(held, word), F.lit(0))).otherwise(F.lit(0))


def citations(text: Column) -> Column:
    """array<struct<article_number: int, matched_text: string>> of the ordinals cited; headings (a colon follows) are none."""
    hits = F.filter(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CITATION), F.lit(0)), lambda m: ~m.rlike("[:：]$"))
    part = lambda m, i: F.regexp_extract(m, CITATION, i)

    def value(m: Column) -> Column:
        teen = F.when((part(m, 2) != "") & (part(m, 3) == ""), 10).otherwise(0)
        return (_number(ORDINAL_UNITS, part(m, 1)) + teen + _number(ORDINAL_TENS, part(m, 3)) + _number(HUNDREDS, part(m, 4))).cast("int")

    return F.transform(hits, lambda m: F.struct(value(m).alias("article_number"), m.alias("matched_text")))


def first_words(c: Column, n: int = 15) -> Column:
    return F.array_join(F.slice(words(c), 1, n), " ")


def has_web_phrase(c: Column) -> Column:
    out = F.lit(False)
    for phrase in WEB_PHRASES:
        out = out | F.lower(c).contains(phrase)
    return F.coalesce(out, F.lit(False))


def content_type(url: Column) -> Column:
    return F.when(url.endswith(".pdf"), "application/pdf").otherwise("text/html")


def split_articles(text: Column) -> Column:
    """array<struct<number: int, body: string>> of a text with headers like "المادة (5)"; text before the first has number 0, none gives number 1."""
    pieces = F.split(text, f"(?={ARTICLE_HEADER})")
    numbered = F.transform(pieces, lambda p: F.struct(F.coalesce(F.regexp_extract(p, f"^{ARTICLE_HEADER}", 1).try_cast("int"), F.lit(0)).alias("number"), squeeze(p).alias("body")))
    kept = F.filter(numbered, lambda s: (s["number"] > 0) | (s["body"] != ""))
    return F.when(text.rlike(ARTICLE_HEADER), kept).otherwise(F.array(F.struct(F.lit(1).alias("number"), squeeze(text).alias("body"))))


def snippets(c: Column, pattern: str, n: int = 5, around: int = 15) -> Column:
    """The first n matches of a pattern, each with up to `around` characters on either side."""
    return F.slice(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"(?s).{{0,{around}}}(?:{pattern}).{{0,{around}}}"), F.lit(0)), 1, n)


#: What extraction damages: a letter repeated where no word has it, scripts that run into each other, characters that are no text.
REPEATED, CONTROLS = r"([\x{600}-\x{6FF}])\1\1+", r"[\p{Cc}&&[^\t\n\r\x{80}-\x{9F}]]"
_GLUED = r"^[A-Za-z]+[\x{600}-\x{6FF}]|[\x{600}-\x{6FF}][A-Za-z]+($|[\x{600}-\x{6FF}])"


def corruption(c: Column) -> Column:
    """struct of counts: letters three times in a row, words in which Latin letters are glued to Arabic ones, control characters."""
    count = lambda rx: F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(rx), F.lit(0)))
    return F.struct(count(REPEATED).alias("repeated_letters"), F.size(F.filter(words(c), lambda w: w.rlike(_GLUED))).alias("glued_latin"), count(CONTROLS).alias("controls"))


def search_terms(c: Column) -> Column:
    """Words in small letters as the text index holds them: runs of letters and digits, each once."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def iso_time(c: Column) -> Column:
    """The time of an ISO text, or now where it is null or no time."""
    return F.coalesce(F.try_to_timestamp(c), F.current_timestamp())
