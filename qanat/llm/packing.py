"""Filling containers of a fixed number of tokens.

Documents are sized by a public tokenizer and dealt to random groups of about GROUP_ITEMS by a hash of id and place, so that repeated ids spread.
Each group is packed on its own by first-fit decreasing: a tournament tree over the bins' free space finds the first bin that an item fits into in
logarithmic time. A group leaves at most one bin badly filled, so the unused share falls with the group's size, not with the number of groups.
"""

from __future__ import annotations

import base64
import math
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, GROUP_ITEMS = 4096, 10_000
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The published splitting pattern of the byte-level tokenizers.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The byte-level tokenizer whose ranks the file holds, once a worker."""
    import tiktoken

    with open(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(texts: list[str | None], path: str = TOKENIZER) -> list[int]:
    """Tokens of each text; 0 for null and ''."""
    encode = tokenizer(path).encode_ordinary
    return [len(encode(t)) if t else 0 for t in texts]


class Tournament:
    """Free space of bins 0, 1, ...: a complete binary tree in which each node has the largest of its subtree; new bins are empty."""

    def __init__(self, capacity: int, bins: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Puts an item into the first bin that has room for it and gives the bin's number."""
        free, node = self.free, 1
        if free[1] < size:
            raise ValueError("no bin has room")
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        found = node - self.leaves
        free[node] -= size
        while node > 1:
            node //= 2
            left, right = free[2 * node], free[2 * node + 1]
            free[node] = left if left > right else right
        return found


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item; no item may be larger than a bin. Equal sizes go in the order given."""
    tree, out = Tournament(capacity, max(1, len(sizes))), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = tree.place(sizes[i])
    return out


def parts(size: int, capacity: int) -> list[int]:
    """The item itself, or, where it is larger than a container, full parts and what is left."""
    return [capacity] * (size // capacity) + [size % capacity] * (size % capacity > 0 or size == 0)


def _sizes(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch["item_id"], batch["grp"], pa.array(count_tokens(batch["text"].to_pylist(), path), pa.int64())], ["item_id", "grp", "n_tokens"])


def _pack(capacity: int, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["item_id", "n_tokens"], kind="stable")  # the same result whatever order the rows come in
    rows = [(id_, g, i, i * capacity, size) for id_, g, n in group.itertuples(index=False) for i, size in enumerate(parts(int(n), capacity))]
    out = pd.DataFrame(rows, columns=["item_id", "grp", "part_index", "first_token", "n_tokens"])
    out["bin"] = first_fit_decreasing(out["n_tokens"].tolist(), capacity)
    return out.assign(container_id=out["grp"].astype(str) + "-" + out["bin"].astype(str))[["item_id", "part_index", "first_token", "n_tokens", "container_id"]]


def pack(items: DataFrame, id_column: str, text_column: str, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, path: str = TOKENIZER) -> DataFrame:
    """Every item in a container: item_id, part_index, first_token, n_tokens, container_id.

    An item is one part (part_index 0) unless it is larger than a container; then it is cut into full parts and a rest. Null and empty texts are
    items of 0 tokens. Each row is an item, repeated rows too. No rows, no containers. The sum of n_tokens in a container is capacity at most.
    """
    if os.path.exists(path):
        items.sparkSession.sparkContext.addFile(path)  # workers elsewhere get it from here
    groups = max(1, math.ceil(items.count() / group_items))
    grouped = items.select(F.col(id_column).cast("long").alias("item_id"), F.pmod(F.xxhash64(F.col(id_column), F.monotonically_increasing_id()), F.lit(groups)).cast("int").alias("grp"), F.col(text_column).alias("text"))
    sized = grouped.mapInArrow(lambda batches: _sizes(path, batches), "item_id long, grp int, n_tokens long")
    schema = "item_id long, part_index int, first_token long, n_tokens long, container_id string"
    return sized.select("item_id", "grp", "n_tokens").groupBy("grp").applyInPandas(lambda group: _pack(capacity, group), schema)
