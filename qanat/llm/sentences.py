"""Sentence units of texts in any script.

Candidate boundaries (closing marks, blanks of Thai, line ends) are classified by a maximum-entropy model over the neighbouring tokens, case,
length, digits and script. It is trained on reliable boundaries: marks before an empty line end a sentence; a dot behind a word that hardly ever
ends a paragraph, though it often has the dot, does not. How often each word ends or begins paragraphs is counted exactly over all texts; only the fit
of the weights uses a bounded sample (SAMPLE_TEXTS). Quotations are never cut inside, list markers belong to their items, empty lines always end a
unit, and a single line break ends one unless the line is merely wrapped.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qanat.functions.visual import BLANKS, LINE_ENDS
from qanat.session import cut_lineage

SAMPLE_TEXTS, WIDEST_WRAP, MOST_WORDS = 4000, 120, 1 << 24
RARE, DECISIVE = 0.01, -8.0

# Quotation marks and what closes them.
QUOTES = {'"': '"', "«": "»", "“": "”", "”": "“", "„": "“", "「": "」", "『": "』", "‹": "›", "《": "》"}
_CLOSERS = "\"»”“」』›》’)]）】"
_B = re.escape(BLANKS)
_LINE_END = re.compile(f"\r\n|[{LINE_ENDS}]")
_PARAGRAPH_END = re.compile(f"(?:\r\n|[{LINE_ENDS}])(?:(?![{LINE_ENDS}])[{_B}])*(?:\r\n|[{LINE_ENDS}])[{_B}]*")
_WORD = re.compile(f"[^{_B}]+")
# Marks that end sentences without a blank behind them: ideographic, Urdu, Devanagari, Armenian, Ethiopic, Khmer, Myanmar, Tibetan, Mongolian.
_FREE_MARKS = "。！？｡۔।॥։።፧፨។៕။།༎᠃"
#: Marks that need a blank behind them, and marks that do not.
_CANDIDATE = re.compile(f"[.!?؟{_FREE_MARKS}]+")
_FREE = re.compile(f"[{_FREE_MARKS}]")
_NEXT = re.compile(f"[{_B}]*([^{_B}.!?؟{_FREE_MARKS}]+|[^{_B}])")
_MARKER = re.compile(f"(?:[-–—•*▪◦‣]|[(（]?(?:[0-9٠-٩۰-۹०-९๐-๙]{{1,3}}|[a-zA-Z]|[ivxIVX]{{1,4}}|[ء-ي]|[ก-ฮ]|[一二三四五六七八九十]{{1,3}})(?:[.)）、]|-(?=[{_B}])))[{_B}]*")
_OPENING = "\"«“”„「『‹《([（¿¡'‘"
_THAI_BLANK = re.compile(f"[{_B}]+")
_THAI, _CJK = re.compile("[ก-๛ກ-ໝ]"), re.compile("[぀-ヿ㐀-鿿가-힣]")
_CLAUSE_LINE = ";؛；:："
FEATURES = 19


_QUOTE_CHARACTER = re.compile("[" + re.escape("".join(QUOTES)) + "]")


def _spans(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """(opening, closing) places of quotations; an opening mark without its closing one in the range opens nothing."""
    spans, at = [], start
    while m := _QUOTE_CHARACTER.search(text, at, end):
        close = text.find(QUOTES[m.group()], m.end(), end)
        if close >= 0:
            spans.append((m.start(), close))
        at = close + 1 if close >= 0 else m.end()
    return spans


def blocks(text: str) -> list[list[tuple[int, int]]]:
    """Lines (start, end without outer blanks) between empty lines."""
    out: list[list[tuple[int, int]]] = [[]]
    at = 0
    for m in [*_LINE_END.finditer(text), None]:
        end = m.start() if m else len(text)
        line = text[at:end]
        bare = line.strip(BLANKS)
        if bare:
            first = at + line.index(bare[0])
            out[-1].append((first, first + len(bare)))
        elif out[-1]:
            out.append([])
        at = m.end() if m else end
    return [b for b in out if b]


def token_before(text: str, start: int, mark: int) -> str:
    """The word that ends at the mark, without opening punctuation."""
    first = mark
    while first > start and text[first - 1] not in BLANKS:
        first -= 1
    return text[first:mark].lstrip(_OPENING).lower()


def _shape(token: str) -> str:
    """Numbers count as one word."""
    return "9" if token and all(c.isdigit() or c in ".,/:-%٫٬" for c in token) else token


def word_key(token: str) -> int:
    """A 64-bit key of a word in small letters."""
    return int.from_bytes(hashlib.blake2b(_shape(token).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(maxsize=8192)
def _script(c: str) -> str:
    return unicodedata.name(c, "").partition(" ")[0] if c.isalpha() else ""


@dataclass
class Model:
    """Counts of words by sorted key (with a dot inside paragraphs, with one at their ends, without one, at the beginning of paragraphs) and the
    weights of the features. Words that are not held count 0."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros((4, 0), np.int64))
    rate: float = 2 * 0.01
    weights: np.ndarray = field(default_factory=lambda: np.array([2.0, 1.0, -1.0, -1.0, 0.0, -2.0, 0.0, -1.0, 0.5, -0.5, 0.0, 0.0, 2.0, 3.0, 0.5, 3.0, 0.0, 0.0, 0.0]))
    mask: int = -1

    def __post_init__(self) -> None:
        inside, ending, plain, opening = self.counts
        evidence = ending * np.log(self.rate / RARE) + inside * np.log((1 - self.rate) / (1 - RARE))
        self.evidence = np.clip(evidence, -24, 12)
        self.dotted = (ending + inside + 1) / (ending + inside + plain + 2)
        self.opens = np.log((opening + 0.5) / (ending + inside + plain + 25))
        self._words: dict[str, tuple[float, float, float]] = {}
        self._ends: dict[tuple, bool] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_words": {}, "_ends": {}}

    def word(self, token: str) -> tuple[float, float, float]:
        """Evidence that the word ends sentences, share of its occurrences with a dot, log share of those that begin paragraphs."""
        known = self._words.get(token)
        if known is None:
            if len(self._words) > 200_000:
                self._words.clear()
            key = word_key(token) & self.mask
            at = int(np.searchsorted(self.keys, key))
            held = at < len(self.keys) and self.keys[at] == key
            known = (float(self.evidence[at]), float(self.dotted[at]), float(self.opens[at])) if held else (0.0, 0.5, float(np.log(0.5 / 25)))
            self._words[token] = known
        return known

    def abbreviates(self, token: str) -> bool:
        """Whether the word surely does not end sentences, though it often has a dot."""
        evidence, dotted, _ = self.word(token)
        return evidence < DECISIVE and dotted > 0.8

    def features(self, token: str, mark: str, after: str) -> list[float]:
        dot = mark[0] == "."
        evidence, dotted, _ = self.word(token) if dot else (0.0, 0.5, 0.0)
        bare = after.lstrip(_OPENING)
        first = bare[:1]
        same = dot and bool(token) and bool(first) and _script(token[-1]) == _script(first) != ""
        return [
            1.0,
            evidence / 4,
            dotted - 0.5,
            float(dot and len(token) <= 2 and not token.isdigit()),
            float(dot and 3 <= len(token) <= 4 and not token.isdigit()),
            float(dot and "." in token[:-1] and not _shape(token) == "9"),
            float(dot and _shape(token) == "9"),
            float(first.islower()),
            float(first.isupper()),
            float(first.isdigit()),
            float(bare != after),
            float(dot),
            float(mark[0] in "!?؟"),
            float(bool(_FREE.search(mark))),
            float(mark[-1] in _CLOSERS),
            float(mark == " "),
            float(same),
            float(dot and bool(token) and _script(token[-1]) == "ARABIC"),
            (self.word(bare.rstrip(_CLOSERS + ",;:،؛").lower())[2] + 4) / 4 if dot and bare else 0.0,
        ]

    def ends(self, token: str, mark: str, after: str) -> bool:
        key = (token, mark, after) if mark[0] == "." else (None, mark, after[:2])
        known = self._ends.get(key)
        if known is None:
            if len(self._ends) > 300_000:
                self._ends.clear()
            known = self._ends[key] = float(np.dot(self.weights, self.features(token, mark, after))) >= 0
        return known


def wrap_widths(text: str, own: list[list[tuple[int, int]]]) -> list[float]:
    """For each block, how long a line is that a wrap has filled, whether the wrap breaks before or behind its margin; 0 without lines to tell.

    A block with a line over WIDEST_WRAP is not wrapped: all its breaks are meant. The other blocks share one width, whatever such blocks hold.
    """
    long_ = [max(e - s for s, e in b) > WIDEST_WRAP for b in own]
    wrapped = [b for b, x in zip(own, long_) if not x]
    longest = max((e - s for b in wrapped for s, e in b), default=0)
    open_ = sorted(e - s for b in wrapped for s, e in b[:-1] if not _CANDIDATE.search(text, max(s, e - 4), e))
    width = max(open_[len(open_) // 2] if open_ else 0, 0.85 * longest)
    return [float("inf") if x else width for x in long_]


def _after(text: str, at: int, end: int) -> str:
    """The next word, up to a mark that ends sentences."""
    m = _NEXT.match(text, at, end)
    return m.group(1) if m else ""


def _closed(text: str, stop: int, end: int, openings: set[int], closings: set[int]) -> int:
    """Behind the quotation marks and brackets that close right behind a mark, or, as in French, behind a blank."""
    while stop < end:
        if text[stop] in _CLOSERS and stop not in openings:
            stop += 1
        elif stop + 1 < end and text[stop] in BLANKS and stop + 1 in closings:
            stop += 2
        else:
            break
    return stop


def _glued(text: str, mark: int, stop: int) -> bool:
    """Whether a sentence begins right behind the mark: a capital letter after a word in small letters."""
    return text[stop].isupper() and text[max(0, mark - 2) : mark].islower() and text[max(0, mark - 2) : mark].isalpha()


def unit_ends(text: str, model: Model, training: list | None = None) -> list[int]:
    """Places behind the last characters of the units, in order.

    '' and blank texts have none. With `training`, reliable candidates are put there as (features, is a boundary).
    """
    out: list[int] = []
    own = blocks(text)
    widths = wrap_widths(text, own)
    thai = _THAI.search(text) is not None
    for n, block in enumerate(own):
        first, last = block[0][0], block[-1][1]
        quotes = _spans(text, first, last)
        openings, closings = {a for a, _ in quotes}, {b for _, b in quotes}
        q = 0
        fresh = True  # whether a unit begins with this line
        for i, (start, end) in enumerate(block):
            at = start
            if fresh and (m := _MARKER.match(text, start, end)) and (m.end() < end or i + 1 < len(block)) and (text[m.end() - 1] in BLANKS or m.end() == end):
                at = m.end()
            begin = at
            places = [(m.start(), stop, text[m.start() : stop]) for m in _CANDIDATE.finditer(text, at, end) for stop in [_closed(text, m.end(), end, openings, closings)]]
            if thai and _THAI.search(text, start, end):
                places = sorted([*places, *((m.start(), m.start(), " ") for m in _THAI_BLANK.finditer(text, at, end) if _THAI.search(text, begin, m.start()))])
            done = False
            for mark, stop, sign in places:
                if sign != " " and stop < end and text[stop] not in BLANKS and not _FREE.search(sign) and not _glued(text, mark, stop):
                    continue
                while q < len(quotes) and quotes[q][1] < stop and quotes[q][1] < mark:
                    q += 1
                if q < len(quotes) and quotes[q][0] < mark and quotes[q][1] >= stop:
                    continue
                if sign == " " and not _THAI.search(text, out[-1] if out and out[-1] > begin else begin, mark):
                    continue
                final = stop == end and i + 1 == len(block)
                if final and training is None:
                    out.append(stop)
                    done = True
                    break
                token = token_before(text, first, mark) if sign[0] == "." else ""
                following = _after(text, stop, last) or (_after(text, own[n + 1][0][0], own[n + 1][-1][1]) if n + 1 < len(own) else "")
                if training is not None:
                    if final and following:
                        training.append((model.features(token, sign, following), 1))
                    elif sign == " " and _THAI.match(following):
                        training.append((model.features(token, sign, following), 1))
                    elif not final and sign[0] == "." and model.abbreviates(token):
                        training.append((model.features(token, sign, following), 0))
                if final or model.ends(token, sign, following):
                    out.append(stop)
                    done = stop == end
            if not done:
                if i + 1 == len(block):
                    out.append(end)
                elif _breaks(text, (start, end), block[i + 1], widths[n], quotes):
                    out.append(end)
                    done = True
            fresh = done
    return list(dict.fromkeys(out))


def _breaks(text: str, line: tuple[int, int], after: tuple[int, int], width: float, quotes: list[tuple[int, int]]) -> bool:
    """Whether the break behind a line that has no closing mark ends the unit: it does where a filled line would have held the next word too."""
    if any(a < line[1] <= b for a, b in quotes):
        return False
    if text[line[1] - 1] in _CLAUSE_LINE and _MARKER.match(text, *after):
        return True
    word = _WORD.match(text, *after)
    size = 1 if _CJK.match(text, after[0]) else len(word.group()) + 1 if word else 0
    return line[1] - line[0] + size < width


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t for t in batch.column(batch.num_columns - 1).to_pylist() if t]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, inside, ending, plain, opening of the words of some texts."""
    words: Counter = Counter()
    lasts: Counter = Counter()
    firsts: Counter = Counter()

    def give() -> pa.RecordBatch:
        own: dict[str, list[int]] = {}
        for kind, seen in enumerate((words, lasts, firsts)):
            for word, n in seen.items():
                bare = word.lstrip(_OPENING).rstrip(_CLOSERS + ",;:،؛")
                token = bare.rstrip(".").lower()
                if not token:
                    continue
                count = own.get(token) or own.setdefault(token, [0, 0, 0, 0])
                if kind == 0:
                    count[0 if bare[-1] == "." else 2] += n
                elif kind == 2:
                    count[3] += n
                elif bare[-1] == ".":
                    count[0] -= n
                    count[1] += n
        keys: dict[int, list[int]] = {}
        for token, count in own.items():  # numbers share a key
            held = keys.setdefault(word_key(token), [0, 0, 0, 0])
            for i, n in enumerate(count):
                held[i] += n
        columns = np.array(list(keys.values()), np.int64).reshape(-1, 4).T
        return pa.RecordBatch.from_arrays([pa.array(list(keys), pa.int64()), *map(pa.array, columns)], ["key", "inside", "ending", "plain", "opening"])

    for batch in batches:
        for text in _texts(batch):
            words.update(text.split())
            for paragraph in _PARAGRAPH_END.split(text):
                last = paragraph.rsplit(None, 1)[-1:]
                if last:
                    lasts[last[0]] += 1
                    firsts[paragraph.split(None, 1)[0]] += 1
        if len(words) > 500_000:
            yield give()
            for seen in (words, lasts, firsts):
                seen.clear()
    yield give()


def word_counts(texts: DataFrame) -> Model:
    """A model with the words of all texts counted.

    What reaches the driver are the words that have a dot or begin a paragraph at least twice, 40 bytes each; were they more than MOST_WORDS, words
    would share keys so that they are no more than that.
    """
    names = ("inside", "ending", "plain", "opening")
    counted = cut_lineage(texts.mapInArrow(_counted, "key long, inside long, ending long, plain long, opening long").groupBy("key").agg(*(F.sum(c).alias(c) for c in names)))
    some = counted.where("inside + ending > 1 OR opening > 1")
    total = counted.agg(F.sum("inside").alias("inside"), F.sum("ending").alias("ending"), F.count_if(F.expr("inside + ending > 1 OR opening > 1")).alias("n")).first()
    mask = -1 if total["n"] <= MOST_WORDS else MOST_WORDS - 1
    if mask > 0:
        some = some.groupBy((F.col("key").bitwiseAND(mask)).alias("key")).agg(*(F.sum(c).alias(c) for c in names))
    held = some.toArrow()
    keys = held["key"].to_numpy()
    order = np.argsort(keys)
    ends, dots = total["ending"] or 0, (total["ending"] or 0) + (total["inside"] or 0)
    counts = np.maximum(np.array([held[c].to_numpy()[order] for c in names], np.int64).reshape(4, -1), 0)
    return Model(keys[order], counts, min(0.9, max(2 * RARE, (ends + 1) / (dots + 5))), mask=mask)


def fit(model: Model, texts: list[str], rounds: int = 25, ridge: float = 0.5) -> Model:
    """The model with weights fitted to the reliable boundaries of some texts; without boundaries of both kinds the given weights stay."""
    rows: list[tuple[list[float], int]] = []
    for text in texts:
        unit_ends(text, model, rows)
    x, y = np.array([r[0] for r in rows]).reshape(-1, FEATURES), np.array([r[1] for r in rows], float)
    if len(set(y.tolist())) < 2:
        return model
    balance = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    prior = model.weights
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (balance * (y - p)) - ridge * (w - prior)
        hessian = (x * (balance * p * (1 - p))[:, None]).T @ x + ridge * np.eye(FEATURES)
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return Model(model.keys, model.counts, model.rate, w, model.mask)


def trained_model(texts: DataFrame) -> Model:
    """Counts over all texts (one column), weights from at most SAMPLE_TEXTS of them, chosen by their hash."""
    model = word_counts(texts)
    keyed = texts.withColumn("key", F.xxhash64(texts.columns[-1]))
    some = keyed.where("key IS NOT NULL").orderBy("key").limit(SAMPLE_TEXTS).drop("key").collect()
    return fit(model, [r[-1] for r in some if r[-1]])


def sentence_units(documents: DataFrame, with_text: bool = True) -> DataFrame:
    """Every unit of every text: doc_id, sentence_index (from 1), sentence_end, and sentence with its text where wanted.

    documents: id (long), text. Null, '' and blank texts have no units. Repeated rows give their units again.
    """
    spark = documents.sparkSession
    model = spark.sparkContext.broadcast(trained_model(documents.select("text")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            ids, index, ends, units = [], [], [], []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                before = 0
                for i, end in enumerate(unit_ends(text, own) if text else (), 1):
                    ids.append(id_)
                    index.append(i)
                    ends.append(end)
                    if with_text:
                        units.append(text[before:end].strip(BLANKS))
                    before = end
            arrays = [pa.array(ids, pa.int64()), pa.array(index, pa.int32()), pa.array(ends, pa.int64())]
            names = ["doc_id", "sentence_index", "sentence_end"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(units, pa.string())] if with_text else arrays, [*names, "sentence"] if with_text else names)

    schema = "doc_id long, sentence_index int, sentence_end long" + ", sentence string" * with_text
    return documents.select(F.col("id").cast("long").alias("id"), "text").mapInArrow(cut, schema)

