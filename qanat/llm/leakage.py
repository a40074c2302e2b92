"""Evaluation texts that leaked into a corpus, found by latent semantic retrieval.

Passages (windows of 2 * RUN words, RUN apart, so every run of RUN words lies whole in one) of corpus and evaluation items are weighted by TF-IDF.
A distributed randomised SVD of the corpus' and items' passages over the items' vocabulary gives a latent space; the vocabulary is bounded by the
items, while document frequencies come from all passages of the corpus and words outside the vocabulary count in a passage's length. Corpus
passages are searched against the items' passages by cosine. The threshold is the cosine that REACHED of all item runs beside all windows of RUN
corpus words have at least. As some have less, it does not decide on literal leaks: every run of every text is looked up among the items' runs too,
and a pair that has one is a candidate whatever its cosine. Each candidate is then checked: longest common run of words with the item, and, for
paraphrases, the longest common subsequence and the answer: the heaviest words of the item's passage (names, numbers) must occur in the text's.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qanat.functions.visual import visual_key
from qanat.session import cut_lineage

RUN, RANK, OVERSAMPLE, BUCKETS, CORPUS_WEIGHT = 13, 128, 16, 1 << 20, 0.1
REACHED, LENGTHS, LOWS = 0.99, 4096, 128  # share of item runs beside corpus words that the threshold lets through, steps in which the words are counted
FILLERS = 400  # texts whose words stand around the planted texts of measured_recall
PARAPHRASE, HEAVY, ANSWERED = 0.33, 0.7, 0.7
TOGETHER, CHUNK = 100_000, 1 << 16  # words of texts worked on together, word vectors added up together
_MARKS = dict.fromkeys([*range(0x610, 0x61B), *range(0x64B, 0x660), 0x670, *range(0x6D6, 0x6DD), *range(0x6DF, 0x6E5), 0x6E7, 0x6E8, *range(0x6EA, 0x6EE), *range(0x5B0, 0x5BE), 0x5BF, 0x5C1, 0x5C2, 0x640])


class _Punctuation(dict):
    """Deletes every character that is neither letter, digit nor mark; filled as characters come up."""

    def __missing__(self, c: int):
        self[c] = c if unicodedata.category(chr(c))[0] in "LNM" or chr(c).isspace() else None
        return self[c]


_PUNCTUATION = _Punctuation()


def words(text: str) -> list[str]:
    """Words as they are compared: without case, punctuation, vowel marks and look-alike differences; tokens of punctuation alone are no words."""
    return [w for token in visual_key(text).split() if (w := _word(token))]


def _word(token: str) -> str:
    return token.translate(_MARKS).translate(_PUNCTUATION).lower()


_codes: dict[str, int] = {}


def _code(token: str) -> int:
    """The word's 64-bit code, 0 for a token that is no word; each token is worked out once a worker."""
    known = _codes.get(token)
    if known is None:
        if len(_codes) > 500_000:
            _codes.clear()
        word = _word(token)
        known = _codes[token] = xxhash.xxh64_intdigest(word) if word else 0
    return known


def word_codes(text: str) -> np.ndarray:
    """64-bit codes of the words."""
    return np.array([c for token in visual_key(text).split() if (c := _code(token))], np.uint64).view(np.int64)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = [word_codes(t or "").tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], ["id", "codes"])


def coded_texts(rows: DataFrame) -> DataFrame:
    """rows (id long, text) as (id, codes: the words' codes one after another as bytes)."""
    return rows.select(F.col("id").cast("long").alias("id"), "text").mapInArrow(_coded, "id long, codes binary")


def _bucket(codes: np.ndarray) -> np.ndarray:
    return (codes.view(np.uint64) % np.uint64(BUCKETS)).astype(np.int64)


def together(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, codes of some texts) of a batch with a column `codes`: texts of about TOGETHER words at a time."""
    codes = [np.frombuffer(x, np.int64) for x in batch["codes"].to_pylist()]
    first, size = 0, 0
    for i, x in enumerate(codes):
        size += len(x)
        if size >= TOGETHER or i + 1 == len(codes):
            yield first, codes[first : i + 1]
            first, size = i + 1, 0


def document_frequencies(coded: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """In how many blocks of RUN words each word of the vocabulary, and each bucket of words, occurs over the whole corpus, and the number of blocks."""
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, blocks, space = np.zeros(size + BUCKETS, np.int64), 0, Space(vocabulary, np.zeros(0), np.zeros(0), np.zeros((0, 0)))
        for batch in batches:
            for _, texts in together(batch):
                lengths = np.array([len(t) for t in texts])
                per_text = -(-lengths // RUN)
                codes = np.concatenate(texts)
                within = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                block = np.repeat(np.cumsum(per_text) - per_text, lengths) + within // RUN
                row = space.rows(codes)
                known = np.flatnonzero(row < size)
                seen[:size] += np.bincount(np.unique(block[known] * size + row[known]) % max(1, size), minlength=size)[:size]
                seen[size:] += np.bincount(np.unique(block * BUCKETS + _bucket(codes)) % BUCKETS, minlength=BUCKETS)
                blocks += int(per_text.sum())
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1]), pa.array([*seen[at].tolist(), blocks])], ["at", "blocks"])

    found = coded.select("codes").mapInArrow(count, "at long, blocks long").groupBy("at").agg(F.sum("blocks").alias("blocks")).toPandas()
    out = np.zeros(size + BUCKETS, np.int64)
    own = found[found["at"] >= 0]
    out[own["at"].to_numpy()] = own["blocks"].to_numpy()
    return out[:size], out[size:], int(found.loc[found["at"] < 0, "blocks"].sum())


@dataclass
class Space:
    """The latent space: vocabulary (sorted codes), weights of its words and of all others by bucket, a basis row for each word of the vocabulary."""

    vocabulary: np.ndarray
    weights: np.ndarray
    others: np.ndarray
    basis: np.ndarray

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """The vocabulary row of each word; their number for words outside."""
        if not len(self.vocabulary):
            return np.zeros(len(codes), np.int64)
        at = np.searchsorted(self.vocabulary, codes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == codes, at, len(self.vocabulary))


class Blocks:
    """Some texts in blocks of RUN words, and their passages: two blocks that follow each other, or a text's only one."""

    def __init__(self, texts: list[np.ndarray], space: Space) -> None:
        lengths = np.array([len(t) for t in texts], np.int64)
        per_text = -(-lengths // RUN)
        codes = np.concatenate([np.zeros(0, np.int64), *texts])
        first = np.cumsum(lengths) - lengths
        self.text = np.repeat(np.arange(len(texts)), per_text)
        self.first = RUN * (np.arange(len(self.text)) - np.repeat(np.cumsum(per_text) - per_text, per_text))
        row = space.rows(codes)
        weight = space.others[_bucket(codes)]
        known = np.flatnonzero(row < len(space.vocabulary))
        self.row = row[known]
        weight[known] = self.weight = space.weights[self.row]
        begin = first[self.text] + self.first
        self.square = np.add.reduceat(weight.astype(np.float64) ** 2, begin) if len(codes) else np.zeros(0)
        self.block = np.searchsorted(begin, known, side="right") - 1
        follows = np.r_[self.text[1:] == self.text[:-1], False] if len(self.text) else np.zeros(0, bool)
        self.at = np.flatnonzero(follows | (per_text[self.text] == 1))
        self.both = follows[self.at]
        self.length = np.sqrt(self.square[self.at] + np.where(self.both, self.square[np.minimum(self.at + 1, len(self.square) - 1)], 0)) if len(codes) else np.zeros(0)

    def joined(self, values: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Values of blocks added up for the passages `which`."""
        at, both = self.at[which], self.both[which]
        out = values[at]
        out[both] += values[at[both] + 1]
        return out

    def able(self, least: float, size: int) -> np.ndarray:
        """Passages that may have a cosine of at least `least`: a projection onto the basis is no longer than the vocabulary's part of a block."""
        key = self.block * size + self.row
        order = np.argsort(key)
        edge = np.flatnonzero(np.r_[True, np.diff(key[order]) > 0]) if len(key) else order
        sums = np.add.reduceat(self.weight[order].astype(np.float64), edge) if len(key) else np.zeros(0)
        norm = np.sqrt(np.bincount(self.block[order[edge]], sums**2, minlength=len(self.text)))
        return np.flatnonzero(self.joined(norm, np.arange(len(self.at))) >= least * self.length - 1e-6)

    def vectors(self, space: Space, wanted: np.ndarray | None = None) -> np.ndarray:
        """The latent vectors of the blocks; of those `wanted` (a mask) only where given, others are 0."""
        out = np.zeros((len(self.text), space.basis.shape[1]), np.float32)
        at = np.arange(len(self.row)) if wanted is None else np.flatnonzero(wanted[self.block])
        for start in range(0, len(at), CHUNK):
            own = at[start : start + CHUNK]
            block = self.block[own]
            edge = np.flatnonzero(np.r_[True, np.diff(block) > 0])
            out[block[edge]] += np.add.reduceat(space.basis[self.row[own]] * self.weight[own, None], edge, axis=0)
        return out


def passages(texts: list[np.ndarray], space: Space, least: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, first word, latent vector, full TF-IDF length) of the passages of some texts that may have a cosine of at least `least`."""
    own = Blocks(texts, space)
    which, wanted = np.arange(len(own.at)), None
    if least > 0:
        which = own.able(least, len(space.vocabulary))
        wanted = np.zeros(len(own.text) + 1, bool)
        wanted[own.at[which]] = True
        wanted[own.at[which][own.both[which]] + 1] = True
    return own.text[own.at[which]], own.first[own.at[which]], own.joined(own.vectors(space, wanted), which), own.length[which]


def add_product(texts: list[np.ndarray], space: Space, total: np.ndarray) -> int:
    """Adds A^T A B to total, for the texts' passages' TF-IDF matrix A (rows of length 1) over the vocabulary and the basis B; gives the number of rows."""
    own = Blocks(texts, space)
    every = np.arange(len(own.at))
    scaled = own.joined(own.vectors(space), every) / np.maximum(own.length[:, None], 1e-9).astype(np.float32) ** 2
    of_block = np.zeros((len(own.text), scaled.shape[1]), np.float32)
    of_block[own.at] = scaled
    of_block[own.at[own.both] + 1] += scaled[own.both]
    order = np.argsort(own.row, kind="stable")
    for start in range(0, len(order), CHUNK):
        at = order[start : start + CHUNK]
        edge = np.flatnonzero(np.r_[True, np.diff(own.row[at]) > 0])
        total[own.row[at][edge]] += np.add.reduceat(of_block[own.block[at]] * own.weight[at, None], edge, axis=0)
    return len(every)


def _gram(coded: DataFrame, space: Space) -> np.ndarray:
    """A^T A B of the corpus, with A's rows spread over the cluster.

    Each task adds up its own passages; the sums are folded by blocks of the vocabulary in two rounds.
    """
    size, width = space.basis.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros((size, width), np.float64), 0
        for batch in batches:
            for _, texts in together(batch):
                add_product(texts, space, total)
                part = part or next((int(t[0] % 64) for t in texts if len(t)), 0)
        for block, start in enumerate(range(0, size, 256)):
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([part]), pa.array([total[start : min(size, start + 256)].tobytes()], pa.binary())], ["block", "part", "sums"])

    def fold(keys: list[str]):
        def folded(group: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(x, np.float64) for x in group["sums"])
            return pd.DataFrame({"block": group["block"].iloc[:1], "part": group["part"].iloc[:1], "sums": [total.tobytes()]})

        return lambda df: df.groupBy(*keys).applyInPandas(folded, "block long, part long, sums binary")

    found = fold(["block"])(fold(["block", "part"])(coded.select("codes").mapInArrow(add, "block long, part long, sums binary")))
    sums = {r["block"]: np.frombuffer(r["sums"], np.float64) for r in found.collect()}
    return np.concatenate([sums[b] for b in sorted(sums)]).reshape(size, width) if sums else np.zeros((size, width))


def fit_space(coded: DataFrame, items: list[np.ndarray], rank: int = RANK, seed: int = 5) -> Space:
    """Randomised SVD: a random basis of the vocabulary, two products with A^T A over all passages of the corpus and the items, and a rotation."""
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.int64), *items]))
    own, others, blocks = document_frequencies(coded, vocabulary)
    weigh = lambda frequency: (np.log((1 + blocks) / (1 + frequency)) ** 2 + 1e-3).astype(np.float32)  # noqa: E731  # squared: what tells items apart is rare
    rng, width = np.random.default_rng(seed), min(rank + OVERSAMPLE, max(1, len(vocabulary)))
    space = Space(vocabulary, weigh(own), weigh(others), rng.standard_normal((len(vocabulary), width)).astype(np.float32))

    def product() -> np.ndarray:
        """The corpus' passages together weigh CORPUS_WEIGHT of what the items' do, however many they are: the space is to tell items apart."""
        total = np.zeros(space.basis.shape)
        n = add_product(items, space, total)
        return _gram(coded, space) * (CORPUS_WEIGHT * n / max(1, blocks)) + total

    if len(vocabulary):
        basis, _ = np.linalg.qr(product())
        space.basis = basis.astype(np.float32)
        values, rotation = np.linalg.eigh(basis.T @ product())
        space.basis = (basis @ rotation[:, np.argsort(-values)[:rank]]).astype(np.float32)
    return space


def lowest(space: Space, targets: np.ndarray) -> np.ndarray:
    """The least that each word of the vocabulary adds to the product of a passage's latent vector with any target, 0 at most."""
    parts = [(space.basis[at : at + 256] * space.weights[at : at + 256, None]) @ targets.T for at in range(0, len(space.vocabulary), 256)]
    return np.concatenate([np.zeros(0), *(p.min(axis=1, initial=0) for p in parts)])


def windows(texts: list[np.ndarray], space: Space, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF length and sum of `low` of all windows of RUN words of some texts; a shorter text is one window."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.concatenate([np.zeros(0, np.int64), *texts])
    row, weight, least = space.rows(codes), space.others[_bucket(codes)].astype(np.float64), np.zeros(len(codes))
    known = np.flatnonzero(row < len(space.vocabulary))
    weight[known], least[known] = space.weights[row[known]], low[row[known]]
    end, start = np.repeat(np.cumsum(sizes), sizes), np.arange(len(codes))
    start = np.flatnonzero((start + RUN <= end) | (start == end - np.repeat(sizes, sizes)))
    end = np.minimum(start + RUN, end[start])
    squares, sums = (np.concatenate([np.zeros(1), np.cumsum(x)]) for x in (weight**2, least))
    return np.sqrt(np.maximum(squares[end] - squares[start], 0)), np.minimum(sums[end] - sums[start], 0)


@dataclass
class Beside:
    """How many windows of the whole corpus have which TF-IDF length and sum of `lowest`, in steps: lengths counted up and sums down."""

    longest: float
    least: float
    counts: np.ndarray

    @classmethod
    def of(cls, coded: DataFrame, space: Space, targets: np.ndarray) -> Beside:
        low = lowest(space, targets)
        longest, least = RUN**0.5 * float(max(space.others.max(), space.weights.max(initial=0))), min(RUN * float(low.min(initial=0)), -1e-9)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = np.zeros((LENGTHS + 1) * (LOWS + 1), np.int64)
            for batch in batches:
                for _, texts in together(batch):
                    length, own = windows(texts, space, low)
                    steps = np.minimum(np.ceil(length / longest * LENGTHS), LENGTHS), np.minimum(np.ceil(np.sqrt(own / least) * LOWS), LOWS)
                    seen += np.bincount((steps[1] * (LENGTHS + 1) + steps[0]).astype(np.int64), minlength=len(seen))
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["at", "windows"])

        found = coded.select("codes").mapInArrow(count, "at long, windows long").groupBy("at").agg(F.sum("windows").alias("windows")).toPandas()
        counts = np.zeros((LOWS + 1) * (LENGTHS + 1), np.int64)
        counts[found["at"].to_numpy(np.int64)] = found["windows"].to_numpy(np.int64)
        return cls(longest, least, counts.reshape(LOWS + 1, LENGTHS + 1))

    def share(self, near: np.ndarray, square: np.ndarray, cosine: float) -> float:
        """The share of all pairs of a run (product with its target, square of its length) and a window that have at least this cosine for certain."""
        total = 0
        for step in np.flatnonzero(self.counts.any(axis=1)):
            room = (np.maximum(near + (step / LOWS) ** 2 * self.least, 0) / cosine) ** 2 - square
            length = np.minimum(np.sqrt(room[room >= 0]) / self.longest * LENGTHS, LENGTHS).astype(np.int64)
            total += int(np.cumsum(self.counts[step])[length].sum())
        return total / (len(near) * int(self.counts.sum()))


def calibrated_threshold(space: Space, items: list[np.ndarray], beside: Beside) -> float:
    """The cosine with a passage of their item that REACHED of all runs of RUN item words, each put beside every window of RUN corpus words, have at
    least. The square of a passage's length and its product with a target are sums over run and window, so the pairs need not be formed: a window
    counts with its length and with the least that it can add to the product with any target, a run with the target nearest to it."""
    item_of, _, latent, _ = passages(items, space)
    targets = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    near, square = [], []
    for i, item in enumerate(items):
        if len(item) >= RUN:
            _, _, vectors, length = passages(list(np.lib.stride_tricks.sliding_window_view(item, RUN)), space)
            near.append((vectors @ targets[item_of == i].T).max(axis=1).astype(np.float64))
            square.append(length.astype(np.float64) ** 2)
    if not near:
        return 1.0
    if not beside.counts.any():  # no corpus: the runs alone
        beside.counts[0, 0] = 1
    near, square, reached, beyond = np.concatenate(near), np.concatenate(square), 0.0, 1.0
    for _ in range(16):
        middle = (reached + beyond) / 2
        reached, beyond = (middle, beyond) if beside.share(near, square, middle) >= REACHED else (reached, middle)
    return reached


def run_keys(codes: np.ndarray, run: int = RUN) -> np.ndarray:
    """A key for each run of `run` consecutive words."""
    if len(codes) < run:
        return np.zeros(0, np.uint64)
    wide, key = codes.view(np.uint64), np.zeros(len(codes) - run + 1, np.uint64)
    for i in range(run):
        key = key * np.uint64(0x9E3779B97F4A7C15) + wide[i : len(codes) - run + 1 + i]
    return key


class Runs:
    """The runs of all items: sorted keys, the item of each, and which leading bits occur among them."""

    def __init__(self, items: list[np.ndarray]) -> None:
        keys = [np.unique(run_keys(x)) for x in items]
        every = np.concatenate([np.zeros(0, np.uint64), *keys])
        order = np.argsort(every, kind="stable")
        self.keys, self.items, self.number = every[order], np.repeat(np.arange(len(items)), [len(k) for k in keys])[order], len(items)
        self.leading = np.zeros(1 << 20, bool)
        self.leading[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def met(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number * number of items + item, first word, last word) of all pairs with a common run: where the first run begins, the last ends."""
        ends = np.cumsum([len(t) for t in texts])
        keys = run_keys(np.concatenate([np.zeros(0, np.int64), *texts]))
        at = np.flatnonzero(self.leading[(keys >> np.uint64(44)).astype(np.int64)])
        text = np.searchsorted(ends, at, side="right")
        inside = at + RUN <= ends[text]
        at, text = at[inside], text[inside]
        low, high = np.searchsorted(self.keys, keys[at]), np.searchsorted(self.keys, keys[at], side="right")
        n = high - low
        own = self.items[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
        pair, place = np.repeat(text, n) * self.number + own, np.repeat(at, n)
        order = np.lexsort((place, pair))
        pair, place = pair[order], place[order]
        first = np.flatnonzero(np.r_[True, np.diff(pair) > 0]) if len(pair) else order
        last = np.append(first[1:], len(pair))[: len(first)] - 1
        offset = (ends - [len(t) for t in texts])[pair[first] // self.number] if len(pair) else place
        return pair[first], place[first] - offset, place[last] - offset + RUN


def longest_run(a: np.ndarray, b: np.ndarray) -> int:
    """Words of the longest run that both have."""
    best, previous = 0, np.zeros(len(b) + 1, np.int64)
    for x in a:
        now = np.zeros(len(b) + 1, np.int64)
        at = np.flatnonzero(b == x)
        now[at + 1] = previous[at] + 1
        best, previous = max(best, int(now.max(initial=0))), now
    return best


def longest_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Words of the longest common subsequence, by bit-parallel rows."""
    where: dict[int, int] = {}
    for i, x in enumerate(b.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full, row = (1 << len(b)) - 1, (1 << len(b)) - 1
    for x in a.tolist():
        met = row & where.get(x, 0)
        row = (row + met | row - met) & full
    return len(b) - row.bit_count()


def answered(passage: np.ndarray, item: np.ndarray, space: Space) -> float:
    """The share of the item passage's heavy words (at least HEAVY of the heaviest: what it states or asks for) that the text's passage has."""
    row = space.rows(np.unique(item))
    weight = space.weights[row]
    return float(np.isin(space.vocabulary[row[weight >= HEAVY * weight.max()]], passage).mean()) if len(row) else 0.0


_LEAK = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("run", pa.int32()), ("shared", pa.int32()), ("cosine", pa.float64()), ("answered", pa.float64()), ("retrieved", pa.bool_())])


def leaks(documents: DataFrame, items: DataFrame, paraphrases: bool = True) -> DataFrame:
    """Documents that hold passages of items: doc_id, item_id, run (words of the longest common run), shared (words of the longest common
    subsequence of the item and a passage with RUN words on either side), cosine, answered (share of the item passage's heaviest words in the text's), retrieved (whether the
    cosine search brought the pair). The passage is the one that shares most among the nearest one and all of cosine >= PARAPHRASE.

    documents: id, text; items: id, text, a bounded set. All pairs with a common run of RUN words come out whatever their cosine, each once, and
    of the candidates above the threshold the paraphrases (run < RUN, cosine >= PARAPHRASE, shared >= RUN, answered >= ANSWERED), which can be left
    out. Null and blank texts hold nothing; items of fewer than RUN words cannot leak literally.
    """
    spark = documents.sparkSession
    held = coded_texts(items.where("text IS NOT NULL").dropDuplicates(["id"])).orderBy("id").toPandas()
    ids, own = held["id"].to_numpy(np.int64), [np.frombuffer(x, np.int64) for x in held["codes"]]
    coded = cut_lineage(coded_texts(documents.where("id IS NOT NULL AND text IS NOT NULL")))
    space = fit_space(coded, own)
    item_of, item_first, latent, _ = passages(own, space)
    targets = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    threshold = min(PARAPHRASE, calibrated_threshold(space, own, Beside.of(coded, space, targets)))
    shared = spark.sparkContext.broadcast((space, ids, own, item_of, item_first, targets, Runs(own)))

    def nearest(text: np.ndarray, item: int) -> tuple[float, int, int]:
        """Cosine, first word and item passage of a text's passage nearest to the item."""
        space, _, _, item_of, _, targets, _ = shared.value
        _, first, vectors, full = passages([text], space)
        mine = np.flatnonzero(item_of == item)
        near = (vectors / np.maximum(full[:, None], 1e-9).astype(np.float32)) @ targets[mine].T
        at = np.unravel_index(near.argmax(), near.shape)
        return float(near[at]), int(first[at[0]]), int(mine[at[1]])

    def checked(text: np.ndarray, item: int, near: list[tuple[float, int, int]], run: tuple[int, int] | None, retrieved: bool) -> tuple | None:
        space, _, own, _, item_first, _, _ = shared.value
        best: tuple = (-1,)
        for cosine, first, passage in near:
            part, asked = text[max(0, first - RUN) : first + 3 * RUN], own[item][item_first[passage] : item_first[passage] + 2 * RUN]
            answer = answered(part, asked, space)
            if run or answer >= ANSWERED:
                common = longest_subsequence(part, own[item])
                if run or common >= RUN:
                    best = max(best, (common, answer, cosine, -first))
        if best[0] < 0:
            return None
        common, answer, cosine, first = best
        return longest_run(own[item], text[slice(*run)] if run else text[max(0, -first - RUN) : 3 * RUN - first]), common, cosine, answer, retrieved

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, ids, own, item_of, _, targets, runs = shared.value
        for batch in batches:
            names = batch["id"].to_numpy()
            for start, texts in together(batch):
                pair, first, last = runs.met(texts)
                literal = dict(zip(pair.tolist(), zip(first.tolist(), last.tolist())))
                owner, first, vectors, full = passages(texts, space, threshold)
                longest = np.flatnonzero(np.linalg.norm(vectors, axis=1) >= threshold * full - 1e-6)  # |Px| / |x| bounds every cosine
                owner, first, vectors, full = owner[longest], first[longest], vectors[longest], full[longest]
                near: dict[int, list[tuple[float, int, int]]] = {}
                for block in range(0, len(owner), 4096):
                    at = slice(block, block + 4096)
                    cosine = (vectors[at] / np.maximum(full[at, None], 1e-9).astype(np.float32)) @ targets.T
                    p, t = np.nonzero(cosine >= threshold)
                    found = owner[at][p] * len(own) + item_of[t]
                    kept = np.isin(found, pair) | (paraphrases & (cosine[p, t] >= PARAPHRASE))
                    for k, c, w, x in zip(found[kept].tolist(), cosine[p, t][kept].tolist(), first[at][p][kept].tolist(), t[kept].tolist()):
                        near.setdefault(k, []).append((c, w, x))
                out = []
                for k in sorted(literal.keys() | near.keys()):
                    d, i = divmod(k, len(own))
                    some = sorted(near.get(k, ()), reverse=True) or [nearest(texts[d], i)]
                    row = checked(texts[d], i, [x for n, x in enumerate(some) if n == 0 or x[0] >= PARAPHRASE], literal.get(k), k in near)
                    if row:
                        out.append((int(names[start + d]), int(ids[i]), *row))
                columns = list(zip(*out)) if out else [()] * len(_LEAK)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LEAK)], schema=_LEAK)

    found = coded.mapInArrow(search, "doc_id long, item_id long, run int, shared int, cosine double, answered double, retrieved boolean")
    best = Window.partitionBy("doc_id", "item_id").orderBy(F.desc("run"), F.desc("shared"))
    return found.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank")


def literal_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id of documents with at least RUN consecutive words of an item."""
    return leaks(documents, items, paraphrases=False).where(F.col("run") >= RUN).select("doc_id", "item_id")


PLANTED_ID = -(10**15)


def planted_texts(items: list[tuple[int, str]], fillers: list[str], seed: int = 9) -> list[tuple[int, str, str, int]]:
    """(id, text, kind, item_id): for every item a text with RUN of its words, and one with a reworded passage of 2 * RUN words, among corpus words.

    A rewording keeps rare words: every third word that several items have is replaced by a corpus word, and one is put in after every tenth word.
    """
    rng, out = np.random.default_rng(seed), []
    own = [(i, w) for i, t in items if len(w := words(t)) >= 2 * RUN]
    spread: dict[str, int] = {}
    for _, w in own:
        for x in set(w):
            spread[x] = spread.get(x, 0) + 1
    pool = [w for t in fillers for w in words(t)] or ["filler"]
    for n, (i, w) in enumerate(own):
        for kind, size in (("literal", RUN), ("reworded", 2 * RUN)):
            at = int(rng.integers(len(w) - size + 1))
            part, common = [], 0
            for place, x in enumerate(w[at : at + size]):
                common += spread[x] > 5
                part.append(pool[int(rng.integers(len(pool)))] if kind == "reworded" and spread[x] > 5 and common % 3 == 0 else x)
                if kind == "reworded" and place % 10 == 9:
                    part.append(pool[int(rng.integers(len(pool)))])
            begin = int(rng.integers(len(pool)))
            around = pool[begin : begin + 60]
            out.append((PLANTED_ID - len(out), " ".join([*around[:30], *part, *around[30:]]), kind, i))
    return out


def measured_recall(documents: DataFrame, items: DataFrame) -> DataFrame:
    """kind, planted, retrieved, found: of the texts planted for every item (see planted_texts) among all documents, how many the cosine search
    brings to the check and how many come out."""
    spark = documents.sparkSession
    held = [(r["id"], r["text"]) for r in items.where("id IS NOT NULL AND text IS NOT NULL").dropDuplicates(["id"]).orderBy("id").collect()]
    fillers = [r["text"] for r in documents.where("text IS NOT NULL").orderBy(F.xxhash64(F.col("id"), F.lit(1)), "id").limit(FILLERS).select("text").collect()]
    planted = spark.createDataFrame(planted_texts(held, fillers), "doc_id long, text string, kind string, item_id long")
    every = documents.select("id", "text").unionByName(planted.select(F.col("doc_id").alias("id"), "text"))
    found = leaks(every, items).where(F.col("doc_id") <= PLANTED_ID).select("doc_id", "item_id", "retrieved")
    return planted.join(found, ["doc_id", "item_id"], "left").groupBy("kind").agg(F.count("*").alias("planted"), F.count_if("retrieved").alias("retrieved"), F.count("retrieved").alias("found"))
