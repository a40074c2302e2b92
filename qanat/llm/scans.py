"""Repairing text extracted from scanned pages.

Page furniture (running headers, page numbers) is taken out, words cut by a mark at a line end are joined, misread characters are corrected, and
lines are reflowed into paragraphs. For misread characters every rare word is intersected, as a bit-parallel Levenshtein automaton, with a trie of
the corpus' vocabulary, which finds all words within the distance; candidates are ranked by frequency and by the words around. Counts cover all
texts, each different text once. Look-alike letters are no noise: words are compared by what they look like.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qanat.functions.visual import visual_key
from qanat.session import cut_lineage

KNOWN, RATIO, SUPPORT, SHARD, PAIRS, HEADING_BUCKETS = 5, 30, 3, 100_000, 1 << 22, 1 << 18
BROKEN_WORD, RUNNING_HEADER, PAGE_NUMBER, WRONG_CHAR = "broken_word", "running_header", "page_number", "wrong_char"

# Marks that cut a word at a line end.
CUT_MARKS = "-‐‑\u00ad¬ـ⁃"
# Two letters that one misread letter turns into, and the letter.
SPLIT_LETTERS = (("li", "h"), ("rn", "m"), ("cl", "d"), ("vv", "w"), ("ii", "u"), ("nn", "m"), ("lc", "k"), ("ni", "m"))
# Words for a page and for "of" in page numbers.
PAGE_WORDS = ("page", "pages", "p.", "pp.", "pg.", "صفحة", "صفحه", "ص.", "ص", "صفحہ")
OF_WORDS = ("of", "من", "از", "sur", "/", "de")

# Letters that writers use one for the other; another of the group is another spelling, not a misreading.
SPELLINGS = ("اأإآ", "هة", "يىئ", "وؤ")

_NUMBER = "[0-9٠-٩۰-۹]{1,4}"
_PAGE = f"(?:(?:{'|'.join(map(re.escape, sorted(PAGE_WORDS, key=len, reverse=True)))})\\s*)"
_OF = f"(?:\\s*(?:{'|'.join(map(re.escape, OF_WORDS))})\\s*{_NUMBER})"
_PAGE_LINE = re.compile(f"[\\s\\-–—_~=*\\[(|.]*(?:{_PAGE}?{_NUMBER}{_OF}?)[\\s\\-–—_~=*\\])|]*$", re.I)
_PAGE_TAIL = re.compile(f"(?:[\\s|\\-–—·•]+(?:{_PAGE}{_NUMBER}{_OF}?|{_NUMBER}{_OF}|{_NUMBER})[\\s\\-–—|\\])]*$|^[\\s\\[(\\-–—]*(?:{_PAGE}?{_NUMBER}{_OF}?)[\\s|\\-–—·•\\])]+)", re.I)
_LIST_NUMBER = re.compile(f"{_NUMBER}[.)-]$")
_ITEM = re.compile(f"\\s*[(\\[]?(?:{_NUMBER}|[a-z])[.)\\]-]\\s")
_END_MARK = re.compile("[.!?؟۔؛;،,:：।。…][\"'»”“’)\\]]*\\s*$")
_CUT = re.compile(f"([^\\W\\d_]+)[{re.escape(CUT_MARKS)}][ \\t]*\\n[ \\t]*([^\\W\\d_]+)")
_EDGE = "".join(chr(c) for c in range(33, 0x3000) if unicodedata.category(chr(c))[0] in "PS" and chr(c) != "|")
_VOWEL_MARKS = re.compile("[\u064b-\u0652\u0670\u0640]+")
_GAPS = re.compile(r"[\d\W_]+")
_HAS_CUT = re.compile(f"[{re.escape(CUT_MARKS)}][ \\t]*\n")
_ORDINAL = re.compile("[0-9]+(?:st|nd|rd|th|er|e|ère|ème|re)$")


def line_key(line: str) -> str:
    """A line without case, digits, marks and kinds of blanks."""
    return _GAPS.sub(" ", _VOWEL_MARKS.sub("", visual_key(line)).casefold()).strip()


def is_page_line(line: str) -> bool:
    """Whether the line holds a page's number alone, bare or in brackets or dashes; a list number ("3." or "3)") does not."""
    line = line.strip()
    return line != "" and _PAGE_LINE.match(line) is not None and not _LIST_NUMBER.match(line)


def may_head(line: str) -> bool:
    """Whether a line has the form of a heading: words, short, without a closing mark, no list item."""
    return 5 < len(line) < 100 and not _END_MARK.search(line, max(0, len(line) - 8)) and ":" not in line and "%" not in line and not _ITEM.match(line)


class Headings:
    """How often each pair of words (by bucket) begins or ends repeated headings, and how often it is body text."""

    def __init__(self, heads: np.ndarray, body: np.ndarray) -> None:
        self.heads, self.body = heads, body

    def known(self, key: str) -> bool:
        """Whether a line that occurs once reads like the headings that repeat elsewhere."""
        pairs = heading_pairs(key)
        return 2 * sum(self.heads[p] >= SUPPORT and 4 * self.heads[p] > self.body[p] for p in pairs) >= max(1, len(pairs))


def heading_pairs(key: str) -> list[int]:
    words = key.split()
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:])}
    return [zlib.crc32(p.encode()) % HEADING_BUCKETS for p in pairs]


def heading_keys(lines: list[str]) -> dict[int, str]:
    """Keys of the lines that have the form of a heading, by line number; one word alone is none."""
    return {i: key for i, line in enumerate(lines) if may_head(line) for key in [line_key(line)] if " " in key}


def repeated_keys(keys: dict[int, str]) -> set[str]:
    """Keys that come at least twice in a text, with other lines between."""
    places: dict[str, list[int]] = {}
    for i, key in keys.items():
        places.setdefault(key, []).append(i)
    return {k for k, at in places.items() if at[-1] - at[0] > 1}


def furniture(lines: list[str], titles: list[str] | None, headings: Headings | None) -> dict[int, set[str]]:
    """Kinds of page furniture by line number. titles: keys of the work's titles."""
    found: dict[int, set[str]] = {i: {PAGE_NUMBER} for i, line in enumerate(lines) if is_page_line(line)}
    if len(lines) < 2:
        return found
    keys = {i: key for i, key in heading_keys(lines).items() if i not in found}
    again = repeated_keys(keys)
    for i, key in keys.items():
        titled = any(t in key and len(key) - len(t) < 40 for t in titles or ())
        if titled or key in again or (headings is not None and headings.known(key)):
            found[i] = {RUNNING_HEADER} | ({PAGE_NUMBER} if _PAGE_TAIL.search(lines[i].strip()) else set())
    return found


def join_words(text: str, hyphenated: frozenset[str]) -> tuple[str, bool]:
    """The text with cut words joined, and whether there were any. Words of the language that are spelled with a hyphen keep it."""
    broken = False

    def join(m: re.Match) -> str:
        nonlocal broken
        a, b = m.groups()
        if f"{a}-{b}".lower() in hyphenated or (m.group()[len(a)] == "ـ" and a == "ه"):
            return f"{a}-{b}"
        broken = True
        return a + b + "\n"

    return (_CUT.sub(join, text), broken) if _HAS_CUT.search(text) else (text, False)


def body_of(text: str, titles: list[str] | None, headings: Headings | None, hyphenated: frozenset[str]) -> tuple[str, set[str]]:
    """The text without furniture and with its words whole, and the kinds of noise that were in it."""
    text = text.replace("\r\n", "\n")
    lines = text.split("\n")
    found = furniture(lines, titles, headings)
    kinds = set().union(*found.values()) if found else set()
    # Where furniture parts a paragraph, the empty lines around it belong to the page.
    kept: list[str] = []
    for i, line in enumerate(lines):
        if i in found:
            continue
        near = i + 1 in found or i - 1 in found
        if not line.strip() and near and kept and not _END_MARK.search(kept[-1]):
            continue
        kept.append(line)
    joined, broken = join_words("\n".join(kept), hyphenated)
    return joined, kinds | ({BROKEN_WORD} if broken else set())


_bare: dict[str, str] = {}


def bare(word: str) -> str:
    """A word without vowel marks and outer punctuation; a bar may stand for a letter, but not alone."""
    known = _bare.get(word)
    if known is None:
        if len(_bare) > 300_000:
            _bare.clear()
        known = _VOWEL_MARKS.sub("", word).strip(_EDGE)
        known = _bare[word] = "" if known == "|" else known
    return known


def tokens(text: str) -> list[str]:
    """Words as they are looked up: by looks, in small letters, without vowel marks and outer punctuation."""
    return [t for w in visual_key(text).lower().split() if (t := bare(w))]


@lru_cache(maxsize=8192)
def _script(c: str) -> str:
    return unicodedata.name(c, "").partition(" ")[0] if c.isalpha() else "DIGIT" if c.isdigit() else "BAR" if c == "|" else ""


def odd_places(word: str) -> list[int]:
    """Places of characters that cannot belong to a word of that script: digits, bars, single letters of another script, rare Latin letters."""
    scripts = [_script(c) for c in word]
    letters = Counter(s for s in scripts if s not in ("DIGIT", "BAR", ""))
    if not letters or sum(letters.values()) < 2 or _ORDINAL.match(word):
        return []
    main = letters.most_common(1)[0][0]
    odd = [i for i, (c, s) in enumerate(zip(word, scripts)) if s in ("DIGIT", "BAR") or (s and s != main)]
    return odd if len(odd) * 2 < len(word) and all(b - a > 1 for a, b in zip(odd, odd[1:])) else []


class Trie:
    """A vocabulary as nested dictionaries; a word's count stands under the empty key."""

    def __init__(self, words: dict[str, int]) -> None:
        self.root: dict = {}
        for word, n in words.items():
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = n

    def within(self, word: str, distance: int) -> list[tuple[str, int]]:
        """All words within the Levenshtein distance, with their counts: the word's automaton and the trie walked together.

        The automaton's states are bits: bit i of the e-th number says that i characters are matched with at most e errors.
        """
        mask: dict[str, int] = {}
        for i, c in enumerate(word):
            mask[c] = mask.get(c, 0) | 1 << i
        last, full = 1 << len(word), (2 << len(word)) - 1
        start = tuple((2 << e) - 1 & full for e in range(distance + 1))
        found, todo = [], [(self.root, "", start)]
        while todo:
            node, prefix, states = todo.pop()
            for c, child in node.items():
                if c == "":
                    if states[-1] & last:
                        found.append((prefix, child))
                    continue
                hit = mask.get(c, 0)
                now = [(states[0] & hit) << 1]
                for e in range(1, distance + 1):
                    now.append(((states[e] & hit) << 1 | states[e - 1] | states[e - 1] << 1 | now[e - 1] << 1) & full)
                if now[-1]:
                    todo.append((child, prefix + c, tuple(now)))
        return found


def corrections(word: str, n: int, trie: Trie) -> list[tuple[str, int, str]]:
    """(word, count, confusion) of what a rare word may be a misreading of; confusion names the characters, or is odd."""
    odd = odd_places(word)
    if odd:
        near = trie.within(word, min(2, len(odd)))
        keep = [i for i in range(len(word)) if i not in odd]
        return [(c, m, "odd") for c, m in near if len(c) == len(word) and all(c[i] == word[i] for i in keep) and m > n]
    if len(word) < 3 or not word.replace("'", "").isalpha():
        return []
    out = []
    for c, m in trie.within(word, 1):
        if len(c) == len(word) and m >= RATIO * n and c != word:
            i = next(i for i in range(len(word)) if c[i] != word[i])
            if not any(word[i] in g and c[i] in g for g in SPELLINGS):
                out.append((c, m, f"{word[i]}>{c[i]}"))
    for two, one in SPLIT_LETTERS:
        at = word.find(two)
        while at >= 0:
            for c, m in trie.within(word[:at] + one + word[at + len(two) :], 0):
                if m >= RATIO * n:
                    out.append((c, m, f"{two}>{one}"))
            at = word.find(two, at + 1)
    return out


# ---------------------------------------------------------------------------------------------------------------------------------- Spark


def scanned_records(misa: DataFrame, articles: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, texts): record_table, record_id, hash of every record; and hash, text, titles of every different text.

    Records without an id or text are left out; rows delivered twice count once. titles are the titles of the work in any of its versions.
    """
    usable = lambda id_, text: F.col(id_).isNotNull() & (F.col(text) != "")
    code = lambda c: F.unhex(F.md5(F.encode(c, "UTF-8")))
    a = articles.where(usable("id", "text_ar")).select(F.lit("articles").alias("record_table"), F.col("id").alias("record_id"), "document_id", F.col("text_ar").alias("text"), code("text_ar").alias("hash"))
    m = misa.where(usable("rec_id", "text")).select(F.lit("misa").alias("record_table"), F.col("rec_id").cast("string").alias("record_id"), F.lit(None).cast("string").alias("document_id"), "text", code("text").alias("hash"))
    every = a.unionByName(m)
    texts = every.groupBy("hash").agg(F.min("document_id").alias("document_id"), F.first("text").alias("text"))
    titles = documents.select("source_id", F.explode(F.array("title_ar", "title_en")).alias("title")).where("title IS NOT NULL AND source_id IS NOT NULL").groupBy("source_id").agg(F.collect_set("title").alias("titles"))
    of = documents.where("id IS NOT NULL").groupBy(F.col("id").alias("document_id")).agg(F.min("source_id").alias("source_id")).join(titles, "source_id").select("document_id", "titles")
    titled = texts.join(of, "document_id", "left").select("hash", "text", "titles")
    return every.select("record_table", "record_id", "hash").distinct(), cut_lineage(titled)


def word_table(texts: DataFrame) -> DataFrame:
    """word, n of all texts; hyphenated words inside lines too. Each task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def give() -> pa.RecordBatch:
            own: Counter = Counter()
            for word, n in seen.items():
                own[bare(word)] += n
            del own[""]
            return pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch["text"].to_pylist():
                seen.update(visual_key(join_words(text, frozenset())[0]).lower().split())
            if len(seen) > 500_000:
                yield give()
                seen.clear()
        yield give()

    return texts.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def heading_table(texts: DataFrame) -> Headings:
    """Pairs of words in headings that repeat within a text, and in all other lines. Bounded by HEADING_BUCKETS."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, HEADING_BUCKETS), np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                lines = text.split("\n")
                keys = heading_keys(lines) if len(lines) > 1 else {}
                again = repeated_keys(keys)
                for key in again:
                    seen[0, heading_pairs(key)] += 1
                for key in keys.values():
                    if key not in again:
                        seen[1, heading_pairs(key)] += 1
        kind, at = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(kind * HEADING_BUCKETS + at), pa.array(seen[kind, at])], ["at", "n"])

    found = texts.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(2 * HEADING_BUCKETS, np.int64)
    seen[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return Headings(*seen.reshape(2, HEADING_BUCKETS))


def misread_words(words: DataFrame) -> DataFrame:
    """word, choices (array of word and n) of words that hold a misread character; without choices where only the form shows it.

    A plain letter counts as misread when the other word is RATIO times as frequent and at least SUPPORT words show the same confusion. The
    vocabulary (words of KNOWN occurrences or more) is walked in shards of SHARD words, so a task's trie is bounded however large it is.
    """
    spark = words.sparkSession
    known = words.where((F.col("n") >= KNOWN) & (F.length("word") > 2) & ~F.col("word").rlike(r"[0-9|]"))
    shards = max(1, -(-known.count() // SHARD))
    rare = words.where(F.length("word").between(3, 40) & F.col("word").rlike(r"\p{L}.*\p{L}"))
    parts = []
    for shard in range(shards):
        held = known.where(F.pmod(F.xxhash64("word"), F.lit(shards)) == shard).toPandas()
        shared = spark.sparkContext.broadcast(dict(zip(held["word"], held["n"].tolist())))
        most = int(held["n"].max()) if len(held) else 0

        def search(batches: Iterator[pa.RecordBatch], shared=shared, most=most) -> Iterator[pa.RecordBatch]:
            trie = None
            for batch in batches:
                trie = trie or Trie({w: n for w, n in shared.value.items() if not odd_places(w)})
                rows = []
                for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist()):
                    odd = odd_places(word)
                    if not odd and n * RATIO > most:
                        continue
                    rows += [(word, c, m, how) for c, m, how in corrections(word, n, trie)]
                    if odd and len(word) > 3 and all(0 < i < len(word) - 1 for i in odd):
                        rows.append((word, None, 0, "odd"))
                columns = list(zip(*rows)) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.string()))], ["word", "choice", "m", "how"])

        parts.append(rare.mapInArrow(search, "word string, choice string, m long, how string"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = cut_lineage(found)
    supported = found.where("how != 'odd'").groupBy("how").agg(F.countDistinct("word").alias("words")).where(F.col("words") >= SUPPORT).select("how")
    sure = found.where("how = 'odd'").unionByName(found.join(supported, "how", "left_semi").select(found.columns))
    return sure.groupBy("word").agg(F.filter(F.array_sort(F.collect_set(F.struct((-F.col("m")).alias("negative"), F.col("choice").alias("word")))), lambda c: c["word"].isNotNull()).alias("choices"))


def _hyphenated(texts: DataFrame, words: DataFrame) -> frozenset[str]:
    """Words that are spelled with a hyphen inside lines, KNOWN times or more, and that some text cuts at a line end: only those are asked for."""
    cut = rf"(\p{{L}}+)[{re.escape(CUT_MARKS)}][ \t]*\n[ \t]*(\p{{L}}+)"
    cuts = texts.select(F.explode(F.regexp_extract_all("text", F.lit(cut), F.lit(0))).alias("c")).select(F.lower(F.regexp_replace("c", cut, "$1-$2")).alias("word")).distinct()
    found = words.where((F.col("n") >= KNOWN) & F.col("word").rlike(r"^\p{L}+-\p{L}+$")).join(cuts, "word", "left_semi")
    return frozenset(r["word"] for r in found.select("word").collect())


def examined(texts: DataFrame, words: DataFrame, misread: DataFrame) -> DataFrame:
    """hash, kinds (of furniture and broken words), suspects (all its words but frequent ones that are not misread) of each text."""
    spark = texts.sparkSession
    common = words.where(F.col("n") >= 1000).join(misread, "word", "left_anti").orderBy(F.desc("n"), "word").limit(SHARD)
    shared = spark.sparkContext.broadcast((heading_table(texts), _hyphenated(texts, words), frozenset(r["word"] for r in common.select("word").collect() if not odd_places(r["word"]))))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        headings, hyphenated, common = shared.value
        for batch in batches:
            kinds, suspects = [], []
            for text, titles in zip(batch["text"].to_pylist(), batch["titles"].to_pylist()):
                body, found = body_of(text, [line_key(t) for t in titles or ()], headings, hyphenated)
                kinds.append(sorted(found))
                raw = set(visual_key(body).lower().split())
                suspects.append([w for w in set(map(bare, raw)) - common if len(w) > 2])
            yield pa.RecordBatch.from_arrays([batch["hash"], pa.array(kinds, pa.list_(pa.string())), pa.array(suspects, pa.list_(pa.string()))], ["hash", "kinds", "suspects"])

    return texts.mapInArrow(look, "hash binary, kinds array<string>, suspects array<string>")


def scan_noise(misa: DataFrame, articles: DataFrame, documents: DataFrame) -> DataFrame:
    """record_table, record_id, noise_kind of the noise in misa.text and articles.text_ar, one row per record and kind.

    Empty tables give no rows; records without text have no noise.
    """
    records, texts = scanned_records(misa, articles, documents)
    words = cut_lineage(word_table(texts))
    misread = misread_words(words)
    seen = cut_lineage(examined(texts, words, misread))
    wrong = seen.select("hash", F.explode("suspects").alias("word")).join(misread, "word", "left_semi").select("hash", F.lit(WRONG_CHAR).alias("noise_kind")).distinct()
    kinds = seen.select("hash", F.explode("kinds").alias("noise_kind")).unionByName(wrong)
    return records.join(kinds, "hash").select("record_table", "record_id", "noise_kind")


def reflow(text: str) -> str:
    """Lines of a paragraph joined; empty lines, and breaks behind short lines that end with a mark, part paragraphs."""
    out = []
    for paragraph in re.split(r"\n[ \t]*\n", text):
        lines = [line.strip() for line in paragraph.split("\n") if line.strip()]
        width = max(map(len, lines), default=0)
        flow = ""
        for i, line in enumerate(lines):
            flow += line
            if i + 1 < len(lines):
                flow += "\n" if _END_MARK.search(line) and len(line) < 0.7 * width else " "
        if flow:
            out.append(flow)
    return "\n\n".join(out)


def repaired(misa: DataFrame, articles: DataFrame, documents: DataFrame) -> DataFrame:
    """record_table, record_id, text: every record as continuous paragraphs, furniture gone, words whole, misread characters corrected.

    Among several words that a misreading may stand for, the one that most often follows the word before and precedes the word behind is taken,
    then the most frequent one. A misreading without a known word stays.
    """
    spark = misa.sparkSession
    records, texts = scanned_records(misa, articles, documents)
    words = cut_lineage(word_table(texts))
    misread = misread_words(words)
    seen = examined(texts, words, misread)
    fixes = seen.select("hash", F.explode("suspects").alias("word")).join(misread.where(F.size("choices") > 0), "word").groupBy("hash").agg(F.collect_list(F.struct("word", F.col("choices.word").alias("choices"))).alias("fixes"))
    shared = spark.sparkContext.broadcast((heading_table(texts), _hyphenated(texts, words), word_pairs(texts)))

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        headings, hyphenated, pairs = shared.value
        for batch in batches:
            out = []
            for text, titles, fixes in zip(*(batch[c].to_pylist() for c in ("text", "titles", "fixes"))):
                body = body_of(text, [line_key(t) for t in titles or ()], headings, hyphenated)[0]
                out.append(reflow(correct(body, {f["word"]: f["choices"] for f in fixes or ()}, pairs)))
            yield pa.RecordBatch.from_arrays([batch["hash"], pa.array(out, pa.string())], ["hash", "text"])

    mended = texts.join(fixes, "hash", "left").mapInArrow(mend, "hash binary, text string")
    return records.join(mended, "hash").select("record_table", "record_id", "text")


def pair_bucket(a: str, b: str) -> int:
    return zlib.crc32(f"{a} {b}".encode("utf-8", "surrogatepass")) % PAIRS


def word_pairs(texts: DataFrame) -> np.ndarray:
    """How often two words stand side by side, by bucket, in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(PAIRS, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                own = tokens(text)
                np.add.at(seen, [pair_bucket(a, b) for a, b in zip(own, own[1:])], 1) if len(own) > 1 else None
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["at", "n"])

    found = texts.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(PAIRS, np.int64)
    seen[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return seen


def correct(text: str, fixes: dict[str, list[str]], pairs: np.ndarray) -> str:
    """The text with its misread words replaced; choices come most frequent first."""
    if not fixes:
        return text
    parts = re.split(r"(\s+)", text)
    plain = [(tokens(p) or [""])[0] for p in parts]
    for i, token in enumerate(plain):
        if token in fixes:
            before, after = plain[i - 2] if i > 1 else "", plain[i + 2] if i + 2 < len(plain) else ""
            choice = max(fixes[token], key=lambda c: int(pairs[pair_bucket(before, c)]) + int(pairs[pair_bucket(c, after)]))
            word = parts[i].strip(_EDGE)
            if word[:1].isupper():
                choice = choice.upper() if word.isupper() and len(word) > 1 else choice[:1].upper() + choice[1:]
            parts[i] = parts[i].replace(word, choice)
    return "".join(parts)

