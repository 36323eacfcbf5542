"""Batch model hooks.

A user model runs inside ``mapInPandas``: it is built once per task (not
per row), receives Arrow batches of texts and returns one output per row.
A failing batch item yields the error text and the job goes on, like the
reference's per-row guard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

# Fixed value: output written for a row whose generation failed.
GENERATION_FAILED = "[Error: Generation Failed]"


def generate(df: DataFrame, key: str, text: str, make_model: Callable[[], Callable[[list[str]], list[str]]],
             out: str = "generated") -> DataFrame:
    """M6: ``(key, out)`` from a user batch generator ``make_model()(texts)``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for b in batches:
            texts = b[text].fillna("").str.strip().tolist()
            try:
                res = list(model(texts))
            except Exception:  # noqa: BLE001 - fall back to per row
                res = []
                for t in texts:
                    try:
                        res.append(model([t])[0])
                    except Exception:  # noqa: BLE001
                        res.append(GENERATION_FAILED)
            yield pd.DataFrame({key: b[key], out: res})
    schema = f"{key} {dict(df.dtypes)[key]}, {out} string"
    return df.select(key, text).mapInPandas(run, schema)


def encode(df: DataFrame, key: str, text: str, make_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
           out: str = "embedding") -> DataFrame:
    """``(key, out array<float>)`` from a user batch encoder."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = make_encoder()
        for b in batches:
            vecs = np.asarray(enc(b[text].fillna("").tolist()), dtype=np.float32)
            yield pd.DataFrame({key: b[key], out: list(vecs)})
    schema = f"{key} {dict(df.dtypes)[key]}, {out} array<float>"
    return df.select(key, text).mapInPandas(run, schema)


def lead_sentence_model() -> Callable[[list[str]], list[str]]:
    """Stand-in generator: the first sentence of each text."""
    import re

    def model(texts: list[str]) -> list[str]:
        return [re.split(r"(?<=[.?!])\s+", t, maxsplit=1)[0] if t else "" for t in texts]
    return model


def hashing_encoder(dim: int = 64) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """Stand-in encoder: L2-normalised hashed bag of words of width ``dim``."""
    def make():
        import re
        import zlib

        def enc(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for i, t in enumerate(texts):
                for w in re.findall(r"\w+", t.lower()):
                    out[i, zlib.crc32(w.encode()) % dim] += 1.0
            n = np.linalg.norm(out, axis=1, keepdims=True)
            return np.divide(out, n, out=np.zeros_like(out), where=n > 0)
        return enc
    return make
