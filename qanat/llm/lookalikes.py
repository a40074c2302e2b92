"""One consistent form for texts that look the same.

Every letter run is resolved by script sets: a letter that has doubles in other scripts may belong to all of their scripts, so the sets of a run's
letters are intersected. One script left: the run is spelled in it, which repairs mixed-script words. Several left (a whole-script confusable):
the script that most unambiguous runs of the text have wins. None left: the letters are brought to their first script. All decisions rest on what
is visible, so texts that look the same come to the same form. Width and presentation forms, blanks, invisible characters and composition are
normalised first.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qanat.functions.visual import ARMENIAN, CHEROKEE, COPTIC, CYRILLIC, GREEK, LISU, is_plain, unfold
from qanat.session import cut_lineage

DOUBLES = {"GREEK": GREEK, "CYRILLIC": CYRILLIC, "ARMENIAN": ARMENIAN, "CHEROKEE": CHEROKEE, "LISU": LISU, "COPTIC": COPTIC}
SCRIPTS = ("LATIN", *DOUBLES)
# Arabic-script letters that only one group of orthographies has, whatever their neighbours. The second group is Persian, the third Urdu.
ONLY_ARABIC, ONLY_PERSIAN, ONLY_URDU = "ةأإ", "پچژگ", "ٹڈڑںے"

_CLASSES: dict[str, dict[str, str]] = {}
for _script, (_letters, _latin) in DOUBLES.items():
    for _own, _to in zip(_letters, _latin):
        _CLASSES.setdefault(_to, {"LATIN": _to})[_script] = _own
_CLASS_OF = {letter: latin for latin, members in _CLASSES.items() for letter in members.values()}
_OTHERS = "Ͱ-ϿЀ-ԯԱ-ևᎠ-ᏽἀ-῿Ⲁ-⳿ꓐ-ꓽ"
_LETTER = f"[A-Za-zªºÀ-ÖØ-öø-ʯḀ-ỿ{_OTHERS}]"
_RUN = re.compile(f"{_LETTER}+(?:[̀-ͯ]*{_LETTER})*")
_FOREIGN = re.compile(f"[{_OTHERS}]")
_ARABIC = "ؠ-يٮٯٱ-ۓۺ-ۿ"
_NEXT = f"(?=[ؐ-ًؚ-ٰٟۖ-ۜ۟-ۤۧۨ-ۭ]*[{_ARABIC}])"
_LAST = _NEXT.replace("(?=", "(?!")
_FINAL_ARABIC, _FINAL_PERSIAN = re.compile("[يك]" + _LAST), re.compile("ک" + _LAST)
# One shape, two letters: (pattern, Arabic letter, Persian letter, Urdu letter).
_SHAPES = [
    (re.compile("[يی]" + _NEXT), "ي", "ی", "ی"),
    (re.compile("[ىی]" + _LAST), "ى", "ی", "ی"),
    (re.compile("[كک]" + _NEXT), "ك", "ک", "ک"),
    (re.compile("[هہ]" + _NEXT), "ه", "ه", "ہ"),
    (re.compile("[هہە]" + _LAST), "ه", "ه", "ہ"),
    (re.compile("[هھ]" + _NEXT), "ه", "ه", "ھ"),
]
_DOUBLES = frozenset("یکہھە")


@lru_cache(maxsize=4096)
def script_set(letter: str) -> frozenset[str]:
    """The scripts (of SCRIPTS) in which the letter's shape occurs; empty for letters of others."""
    if (known := _CLASS_OF.get(letter)) is not None:
        return frozenset(_CLASSES[known])
    return frozenset(s for s in SCRIPTS if unicodedata.name(letter, "").startswith(s))


def resolved(run: str) -> frozenset[str]:
    """Scripts in which the whole run can be spelled."""
    sets = [script_set(c) for c in run if not unicodedata.combining(c)]
    return frozenset.intersection(*sets) if sets else frozenset()


def _spell(run: str, script: str) -> str:
    return "".join(_CLASSES[_CLASS_OF[c]].get(script, c) if c in _CLASS_OF else c for c in run)


def _resolved_runs(text: str) -> str:
    runs = [(m.span(), resolved(m.group())) for m in _RUN.finditer(text)]
    evidence = Counter(next(iter(scripts)) for _, scripts in runs if len(scripts) == 1)
    out, at = [], 0
    for (start, end), scripts in runs:
        choice = max(scripts or SCRIPTS[:1], key=lambda s: (evidence[s], -SCRIPTS.index(s)))
        out += [text[at:start], _spell(text[start:end], choice)]
        at = end
    return "".join([*out, text[at:]])


def _orthography(text: str) -> int:
    """0 Arabic, 1 Persian, 2 Urdu, by letters and shapes that only one of them has."""
    arabic = sum(map(text.count, ONLY_ARABIC)) + len(_FINAL_ARABIC.findall(text))
    urdu = sum(map(text.count, ONLY_URDU))
    persian = sum(map(text.count, ONLY_PERSIAN)) + len(_FINAL_PERSIAN.findall(text))
    return 0 if arabic >= persian + urdu else 2 if 4 * urdu > persian else 1


def consistent_form(text: str) -> str:
    """The one spelling of all texts that look like this one; '' for ''. Plain Arabic, Latin and digits are not touched."""
    if is_plain(text):
        return text
    text = unfold(text)
    if _FOREIGN.search(text):
        text = _resolved_runs(text)
    if not _DOUBLES.isdisjoint(text):
        of = _orthography(text)
        for pattern, *letters in _SHAPES:
            text = pattern.sub(letters[of], text)
    return text


def _forms(with_text: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *kept, texts = batch.columns
        form = [None if t is None else consistent_form(t) for t in texts.to_pylist()]
        last = form if with_text else [None if t is None else hashlib.md5(t.encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest() for t in form]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(last, pa.string())], names=[*batch.schema.names[:-1], "form"])


def consistent_texts(texts: DataFrame, with_text: bool = True) -> DataFrame:
    """The column `text` of the frame in its consistent form (or, without text, that form's digest) as `form`; other columns stay.

    Null stays null and '' stays ''. Every row comes out once, repeated rows too. The columns must not be called form.
    """
    kept = [c for c in texts.columns if c != "text"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*kept).schema)
    return texts.select(*kept, "text").mapInArrow(lambda batches: _forms(with_text, batches), f"{fields}, form string")


def _members(articles: DataFrame) -> DataFrame:
    """document_id, form, raw, id of articles whose document holds more than one spelling of what they look like; each id and spelling once."""
    usable = F.col("id").isNotNull() & F.col("document_id").isNotNull() & (F.col("text_ar") != "")
    texts = articles.where(usable).select("id", "document_id", F.unhex(F.md5(F.encode("text_ar", "UTF-8"))).alias("raw"), F.col("text_ar").alias("text"))
    looks = cut_lineage(consistent_texts(texts, with_text=False).withColumn("form", F.unhex("form")))
    kinds = looks.groupBy("document_id", "form", "raw").agg(F.lit(1).alias("one")).groupBy("document_id", "form").agg(F.count("*").alias("spellings")).where("spellings > 1")
    return cut_lineage(looks.join(kinds, ["document_id", "form"], "left_semi").groupBy("id", "document_id").agg(F.min(F.struct("form", "raw")).alias("k")).select("id", "document_id", "k.form", "k.raw"))


def lookalike_pairs(articles: DataFrame) -> DataFrame:
    """Pairs of articles of one document whose text_ar differ but look the same: article_id_a < article_id_b.

    Rows with a null id, document or text and empty texts take no part; rows of one id count once. Equal texts are no pairs and are folded
    together before look-alikes are compared, so many copies of one text cost one row. The pairs themselves are all given; lookalike_classes gives
    the same in a row for each article.
    """
    members = _members(articles)
    a, b = (members.select("document_id", "form", F.col("raw").alias(f"raw_{s}"), F.col("id").alias(f"article_id_{s}")) for s in "ab")
    return a.join(b, ["document_id", "form"]).where("article_id_a < article_id_b AND raw_a != raw_b").select("article_id_a", "article_id_b")


def lookalike_classes(articles: DataFrame) -> DataFrame:
    """article_id, document_id, class_id, spelling_id of every article that looks like another text of its document: two rows of one class with
    different spellings are a pair. As many rows as articles, however large the classes are."""
    return _members(articles).select(F.col("id").alias("article_id"), "document_id", F.lower(F.hex("form")).alias("class_id"), F.lower(F.hex("raw")).alias("spelling_id"))
