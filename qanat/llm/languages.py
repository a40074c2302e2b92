"""Languages of documents and of the segments of mixed documents.

Words come first: a known word scores its log frequency in each language; an unseen word falls back to its character n-grams, from long to short.
The most likely sequence of languages over a text's words, with a price on each change, gives its segments; a language is in the text if a whole
sentence of the body is in it. The word and n-gram frequencies are fitted on at most SAMPLE_TEXTS labelled texts of each language that has LEAST_TEXTS.
Stretches whose characters none of these languages has come out as OTHER, with confidence 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qanat.functions.visual import visual_key
from qanat.llm.scans import furniture, join_words

OTHER = "und"
SAMPLE_TEXTS, LEAST_TEXTS, LONGEST_GRAM, BACKOFF, CHANGE, SENTENCE_WORDS, BORROWED = 1500, 3, 4, 1.5, 7.0, 4, 50

# Names and codes of languages as labels write them.
NAMES = {
    "ar": ("ar", "ara", "arabic", "arb"),
    "en": ("en", "eng", "english"),
    "fr": ("fr", "fra", "fre", "french"),
    "ur": ("ur", "urd", "urdu"),
    "fa": ("fa", "fas", "per", "persian", "farsi", "pes"),
    "zh": ("zh", "zho", "chi", "chinese", "cmn"),
    "hi": ("hi", "hin", "hindi"),
    "th": ("th", "tha", "thai"),
    "de": ("de", "deu", "ger", "german"),
    "es": ("es", "spa", "spanish"),
    "tr": ("tr", "tur", "turkish"),
    "ru": ("ru", "rus", "russian"),
}
# Labels that name no language.
NO_LANGUAGE = ("", "unknown", "und", "mul", "zxx", "none", "null", "n/a", "na", "other", "mixed", "?", "-", "and")

_CODES = {name: code for code, names in NAMES.items() for name in names}
_SEPARATOR = re.compile(r"[\s,;/|+&،؛]+")
_TOKEN = re.compile(r"[^\W\d_]+(?:[’'\u200c][^\W\d_]+)*[ً-ْ]*")
_END = re.compile("[.!?؟۔।。…][\"'»”“’)\\]]*$")
_PLACED_WORD = re.compile(r"\S+")
_MARKS = re.compile("[ً-ْٰـ]")


def labelled_languages(label: str | None) -> frozenset[str]:
    """The languages a label means, whatever its case, regions, code length, names, order and separators; other languages stay as written."""
    out = set()
    for part in _SEPARATOR.split((label or "").strip().lower()):
        part = part.strip(".()[]\"'")
        if part in NO_LANGUAGE:
            continue
        bare = re.split("[-_]", part)[0]
        out.add(_CODES.get(part) or _CODES.get(bare) or bare)
    return frozenset(out - set(NO_LANGUAGE))


@dataclass
class LanguageModel:
    """Log frequencies: words[w] and grams[n][g] hold one number per language; the last one is OTHER's, which unknown characters alone favour."""

    languages: tuple[str, ...] = (OTHER,)
    words: dict[str, np.ndarray] = field(default_factory=dict)
    grams: list[dict[str, np.ndarray]] = field(default_factory=lambda: [{} for _ in range(LONGEST_GRAM + 1)])
    floor: float = -16.0
    _kept: dict[str, np.ndarray] = field(default_factory=dict)
    _tokens: dict[str, tuple[list[str], bool]] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_kept": {}, "_tokens": {}}

    def score(self, word: str) -> np.ndarray:
        """The word's score in each language; unseen words back off to the longest n-grams that are known."""
        known = self._kept.get(word)
        if known is None:
            if len(self._kept) > 200_000:
                self._kept.clear()
            own = self.words[word] if word in self.words else self._backed_off(word)
            known = self._kept[word] = np.append(own, self.floor + 1)
        return known

    def parts(self, token: str) -> tuple[list[str], bool]:
        """The words of a token, and whether a sentence may end behind it."""
        known = self._tokens.get(token)
        if known is None:
            if len(self._tokens) > 200_000:
                self._tokens.clear()
            known = self._tokens[token] = plain_words(token), bool(_END.search(token))
        return known

    def _backed_off(self, word: str) -> np.ndarray:
        padded = f"^{word}$"
        for n in range(min(LONGEST_GRAM, len(padded)), 0, -1):
            found = [g for i in range(len(padded) - n + 1) if (g := self.grams[n].get(padded[i : i + n])) is not None]
            if 2 * len(found) >= len(padded) - n + 1:
                return np.maximum(self.floor, np.mean(found, axis=0) - BACKOFF * (LONGEST_GRAM + 1 - n))
        return np.full(len(self.languages) - 1, self.floor)


def plain_words(text: str) -> list[str]:
    """Words in small letters by their looks, without vowel marks."""
    return [_MARKS.sub("", w) for w in _TOKEN.findall(visual_key(text).lower())]


def _log_frequencies(counts: list[Counter], smoothing: float) -> tuple[dict[str, np.ndarray], np.ndarray]:
    total = np.array([sum(c.values()) for c in counts], float)
    every = set().union(*counts)
    norm = np.log(total + smoothing * (len(every) + 1))
    return {w: np.log(np.array([c[w] for c in counts], float) + smoothing) - norm for w in every}, math.log(smoothing) - norm


def fit(texts: dict[str, list[str]]) -> LanguageModel:
    """The model of labelled texts. A text's words count for its label; words that another label has BORROWED times as often do not."""
    languages = tuple(sorted(texts))
    counts = [Counter(w for t in texts[language] for w in plain_words(t)) for language in languages]
    totals = [max(1, sum(c.values())) for c in counts]
    for word in set().union(*counts):
        most = max(c[word] / n for c, n in zip(counts, totals))
        for c, n in zip(counts, totals):
            if 0 < c[word] / n < most / BORROWED:
                del c[word]
    model = LanguageModel((*languages, OTHER))
    if not any(counts):
        return model
    model.words, floor = _log_frequencies(counts, 0.05)
    for n in range(1, LONGEST_GRAM + 1):
        grams = [Counter() for _ in languages]
        for own, count in zip(grams, counts):
            for word, times in count.items():
                padded = f"^{word}$"
                for i in range(len(padded) - n + 1):
                    own[padded[i : i + n]] += min(times, 20)
        model.grams[n] = _log_frequencies(grams, 0.05)[0]
    model.floor = float(floor.min()) - 2
    return model


def trained_model(documents: DataFrame) -> LanguageModel:
    """The model of about SAMPLE_TEXTS texts for each language, those of the smallest hashes. documents: text, lang.

    A label counts as the one language it means. How many texts each label has decides which share of the hashes is read, so no label's texts
    are sorted or gathered, however many they are.
    """
    labelled = documents.where(F.col("lang").isNotNull() & (F.col("text") != "")).select("lang", "text")
    of, sizes = {}, Counter()
    for row in labelled.groupBy("lang").count().collect():  # one row a label as written
        meant = labelled_languages(row["lang"])
        if len(meant) == 1:
            of[row["lang"]] = next(iter(meant))
            sizes[of[row["lang"]]] += row["count"]
    shares = {label: int(min(1.0, 1.1 * SAMPLE_TEXTS / sizes[language]) * 2**52) for label, language in of.items() if sizes[language] >= LEAST_TEXTS}
    if not shares:
        return LanguageModel()
    bound = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))[F.col("lang")]
    key = F.shiftrightunsigned(F.xxhash64("text"), 12)
    some = labelled.where(key <= bound).select("lang", "text", key.alias("key")).collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(some, key=lambda r: (r["key"], r["text"])):
        held = texts.setdefault(of[r["lang"]], [])
        if len(held) < SAMPLE_TEXTS:
            held.append(r["text"])
    return fit(texts)


@dataclass
class Segment:
    """A stretch of one language: place in the body, words, whether it holds whole sentences, confidence (0 to 1)."""

    language: str
    start: int
    end: int
    words: int
    whole: bool
    confidence: float


def body(text: str) -> str:
    """The text without page furniture and cut words."""
    lines = text.replace("\r\n", "\n").split("\n")
    found = furniture(lines, None, None)
    return join_words("\n".join(line for i, line in enumerate(lines) if i not in found), frozenset())[0]


def best_path(score: np.ndarray, price: list[float]) -> list[int]:
    """The language of each word on the path of the highest score; a change behind word i costs price[i].

    Where no stretch of words gains the least price of a change over the best single language, that language is the path.
    """
    best = int(score.sum(0).argmax())
    rest = score.copy()
    rest[:, best] = -np.inf
    gain = np.cumsum(np.append(0.0, rest.max(1) - score[:, best]))
    if (gain - np.minimum.accumulate(gain)).max() < min(price):
        return [best] * len(score)
    total, back = score[0].copy(), np.zeros(score.shape, np.int8)
    stay = np.arange(score.shape[1])
    for i in range(1, len(score)):
        top = int(total.argmax())
        moved = total[top] - price[i - 1]
        back[i] = np.where(total >= moved, stay, top)
        total = np.maximum(total, moved) + score[i]
    path = [int(total.argmax())]
    for i in range(len(score) - 1, 0, -1):
        path.append(int(back[i, path[-1]]))
    return path[::-1]


def segments(text: str, model: LanguageModel) -> list[Segment]:
    """Segments of a body in their order. Text without letters has none.

    The best path pays CHANGE for every change of language, less at a sentence's end or a line's.
    """
    words, places, ends = [], [], []
    for m in _PLACED_WORD.finditer(text):
        own, closing = model.parts(m.group())
        gap = text[m.end() : m.end() + 2]
        for i, w in enumerate(own):
            words.append(w)
            places.append((m.start(), m.end()))
            ends.append(2 if i + 1 == len(own) and closing else 1 if i + 1 == len(own) and "\n" in gap else 0)
        if not own and closing and ends:
            ends[-1] = 2
    if not words:
        return []
    score = np.array([model.score(w) for w in words])
    path = best_path(score, [CHANGE * (0.3 if e == 2 else 0.7 if e == 1 else 1.0) for e in ends])
    out, first = [], 0
    for i in range(1, len(words) + 1):
        if i < len(words) and path[i] == path[first]:
            continue
        own = score[first:i].sum(0)
        own = own - own.max()
        language = model.languages[path[first]]
        sure = float(np.exp(own[path[first]]) / np.exp(own).sum()) if language != OTHER else 0.0
        # A sentence is whole when it closes within the segment and enough of its words are in it.
        run, whole = 0, False
        for j in range(first, i):
            run += 1
            if ends[j] == 2:
                whole |= run >= SENTENCE_WORDS
                run = 0
        out.append(Segment(language, places[first][0], places[i - 1][1], i - first, whole, sure))
        first = i
    return out


def text_languages(text: str, model: LanguageModel) -> dict[str, float]:
    """Languages with a whole sentence in the text, each with the confidence of its longest segment."""
    out: dict[str, tuple[int, float]] = {}
    for s in segments(body(text), model):
        if s.whole and s.language != OTHER and s.words > out.get(s.language, (0, 0.0))[0]:
            out[s.language] = (s.words, s.confidence)
    return {language: sure for language, (_, sure) in out.items()}


def record_languages(records: DataFrame, documents: DataFrame) -> DataFrame:
    """rec_id, true_language, confidence, labelled (whether the label names exactly the text's languages): a row for each language of a text.

    records: rec_id, language, text, each row by itself. Null and blank texts have no languages, so no rows; null labels name none.
    """
    model = records.sparkSession.sparkContext.broadcast(trained_model(documents))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            rows = []
            for rec_id, label, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = text_languages(text, own) if text else {}
                right = labelled_languages(label) == found.keys()
                rows += [(rec_id, language, sure, right) for language, sure in found.items()]
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.float64(), pa.bool_()))], ["rec_id", "true_language", "confidence", "labelled"])

    return records.select(F.col("rec_id").cast("long").alias("rec_id"), "language", "text").mapInArrow(look, "rec_id long, true_language string, confidence double, labelled boolean")


def language_segments(records: DataFrame, documents: DataFrame) -> DataFrame:
    """rec_id, segment_index, language, segment, whole_sentence, confidence: every stretch of every record's body."""
    model = records.sparkSession.sparkContext.broadcast(trained_model(documents))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            rows = []
            for rec_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                bare = body(text or "")
                rows += [(rec_id, i, s.language, bare[s.start : s.end], s.whole, s.confidence) for i, s in enumerate(segments(bare, own), 1)]
            columns = list(zip(*rows)) if rows else [()] * 6
            types = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["rec_id", "segment_index", "language", "segment", "whole_sentence", "confidence"])

    schema = "rec_id long, segment_index int, language string, segment string, whole_sentence boolean, confidence double"
    return records.select(F.col("rec_id").cast("long").alias("rec_id"), "text").mapInArrow(look, schema)
