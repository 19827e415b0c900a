"""Text embeddings: taken from a table or computed once per distinct text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

Encoder = Callable[[list[str]], np.ndarray]
EMBEDDING_SCHEMA = "title string, embedding array<float>"

_loaded: dict[str, Encoder] = {}


def encode(texts: DataFrame, load: Callable[[], Encoder], name: str, batch: int = 64) -> DataFrame:
    """(title, embedding) of a one-column frame of distinct texts, unit length.

    ``load`` makes the encoder; it runs once per Python worker and is kept
    under ``name`` for later tasks of that worker.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _loaded.get(name) or _loaded.setdefault(name, load())
        for frame in frames:
            titles = frame.iloc[:, 0].tolist()
            for start in range(0, len(titles), batch):
                part = titles[start:start + batch]
                vectors = np.asarray(encoder(part), dtype="float32")
                norms = np.linalg.norm(vectors, axis=1, keepdims=True)
                vectors = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)
                yield pd.DataFrame({"title": part, "embedding": list(vectors)})

    return texts.mapInPandas(run, EMBEDDING_SCHEMA)
