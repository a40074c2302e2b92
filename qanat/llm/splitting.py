"""Cutting oversized texts into pieces at natural boundaries.

A token is a longest run of characters that are not blanks. Dynamic programming over the token positions picks the cuts: it minimises the sum of
cut penalties (paragraph, line or sentence, clause, word) and of squared deviations from even sizes, subject to the limit and to an overlap of
exactly the given number of tokens between consecutive pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qanat.functions.visual import BLANKS

LIMIT, OVERLAP = 512, 50
PARAGRAPH, SENTENCE, CLAUSE, WORD = 0.0, 0.4, 1.2, 4.0
UNEVEN = 6.0

_TOKEN = re.compile(f"[^{re.escape(BLANKS)}]+")
_SENTENCE_END = re.compile("[.!?؟。！？۔।॥…][\"'»”’)\\]」』]*$")
_CLAUSE_END = re.compile("[,;:،؛、，；：][\"'»”’)\\]]*$")


def cut_penalties(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """The penalty of a cut behind each token; the last one's is 0."""
    out = np.full(len(spans), WORD)
    for i, ((a, b), (after, _)) in enumerate(zip(spans, spans[1:])):
        gap, token = text[b:after], text[max(a, b - 4) : b]
        if gap.count("\n") > 1 or "\u2029" in gap:
            out[i] = PARAGRAPH
        elif _SENTENCE_END.search(token):
            out[i] = SENTENCE / 2 if "\n" in gap else SENTENCE
        elif _CLAUSE_END.search(token):
            out[i] = CLAUSE
        elif "\n" in gap:
            out[i] = (CLAUSE + WORD) / 2
    out[-1:] = 0
    return out


def cut_ends(penalties: np.ndarray, limit: int = LIMIT, overlap: int = OVERLAP) -> list[int]:
    """Token positions where pieces end, the last one the number of tokens. Each next piece starts `overlap` tokens before such an end."""
    n = len(penalties)
    if n <= limit:
        return [n] if n else []
    fewest = -(-(n - overlap) // (limit - overlap))
    ideal = (n + overlap * (fewest - 1)) / fewest
    best, came = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
    uneven = UNEVEN * ((np.arange(limit + 1) - ideal) / ideal) ** 2
    for end in range(overlap + 1, n + 1):
        if end <= limit:
            best[end], came[end] = uneven[end], 0
        first = max(overlap + 1, end - (limit - overlap))
        if first < end:
            cost = best[first:end] + uneven[end - np.arange(first, end) + overlap]
            at = int(np.argmin(cost))
            if cost[at] < best[end]:
                best[end], came[end] = cost[at], first + at
        best[end] += penalties[end - 1]
    ends = [n]
    while came[ends[-1]]:
        ends.append(int(came[ends[-1]]))
    return ends[::-1]


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, str]]:
    """(first token, number of tokens, text) of each piece; one piece for a text within the limit, none for a text without tokens."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below limit")
    spans = [m.span() for m in _TOKEN.finditer(text)]
    out, start = [], 0
    for end in cut_ends(cut_penalties(text, spans), limit, overlap):
        out.append((start, end - start, text[spans[start][0] : spans[end - 1][1]]))
        start = end - overlap
    return out


def _split(limit: int, overlap: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(table, id_, i, len(pieces), *piece, hashlib.md5(text.encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest()) for table, id_, text in zip(*(c.to_pylist() for c in batch.columns)) for pieces in [split_text(text, limit, overlap)] for i, piece in enumerate(pieces, 1)]
        columns = list(zip(*rows)) if rows else [()] * 8
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()))],
            ["record_table", "record_id", "piece_index", "pieces", "first_token", "n_tokens", "piece_text", "delivery"],
        )


def oversized_pieces(records: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The pieces of every record over the limit; records within it give no rows.

    records: record_table, record_id, text; delivery names the text a piece is of. Null and blank texts have no tokens. Repeated rows give repeated pieces; a single token is never cut,
    whatever its length. Texts too short to hold limit + 1 tokens never leave the JVM.
    """
    longer = records.where(F.length("text") > 2 * limit).select("record_table", "record_id", "text")
    schema = "record_table string, record_id string, piece_index int, pieces int, first_token int, n_tokens int, piece_text string, delivery string"
    return longer.mapInArrow(lambda batches: _split(limit, overlap, batches), schema).where("pieces > 1")


def corpus_records(articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """Articles (text_ar, or text_en where it is null or empty) and stored chunks as record_table, record_id, text."""
    text = F.coalesce(F.when(F.col("text_ar") != "", F.col("text_ar")), F.col("text_en"))
    own = articles.select(F.lit("articles").alias("record_table"), F.col("id").alias("record_id"), text.alias("text"))
    return own.unionByName(chunks.select(F.lit("article_chunks").alias("record_table"), F.col("id").alias("record_id"), F.col("chunk_text").alias("text")))
