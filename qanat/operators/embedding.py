"""Embedding texts in batches by a provider that is handed in."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BATCH, RETRIES, WAIT_S = 90, 5, 5.0
Provider = Callable[[list[str]], list[list[float]]]


class Throttled(Exception):
    """A provider's word for too many calls."""


def hashed_provider(size: int = 64) -> Provider:
    """Vectors made from a text's hash: the same text has the same vector, wherever it stands in a batch."""

    def embed(texts: list[str]) -> list[list[float]]:
        return [np.random.default_rng(int.from_bytes(hashlib.sha256(t.encode()).digest()[:8])).standard_normal(size).tolist() for t in texts]

    return embed


def call(provider: Provider, texts: list[str], retries: int = RETRIES, wait_s: float = WAIT_S) -> list[list[float]]:
    """One call, tried again after 1, 2, ... times wait_s while the provider is throttled."""
    for attempt in range(1, retries + 2):
        try:
            vectors = provider(texts)
        except Throttled:
            if attempt > retries:
                raise
            time.sleep(wait_s * attempt)
            continue
        if len(vectors) != len(texts):
            raise ValueError("the provider must give a vector for each text")
        return vectors
    raise AssertionError


def embedded(rows: DataFrame, provider: Provider, batch: int = BATCH, wait_s: float = WAIT_S) -> DataFrame:
    """rows (id, text) as (id, vector); null and empty texts have a null vector and cost no call."""

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids, texts = part["id"].to_pylist(), part["text"].to_pylist()
            asked = [i for i, t in enumerate(texts) if t]
            vectors: list[list[float] | None] = [None] * len(texts)
            for start in range(0, len(asked), batch):
                own = asked[start : start + batch]
                for i, vector in zip(own, call(provider, [texts[i] for i in own], wait_s=wait_s)):
                    vectors[i] = vector
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(vectors, pa.list_(pa.float32()))], ["id", "vector"])

    return rows.selectExpr("cast(id AS string) AS id", "text").mapInArrow(embed, "id string, vector array<float>")
