"""Functions that a deployment may swap: embedders, encoders and generators.

A plug-in is a function of lists; it becomes a Column function that loads it once in each worker.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column

from spanloom.functions.unicode import hashed_vector
from spanloom.functions.vectorized import vectorized

Embedder = Callable[[list[str]], list[list[float]]]
Generator = Callable[[list[str]], list[str]]


def hashing(texts: list[str]) -> list[list[float]]:
    """The built-in embedder, without a model."""
    return [hashed_vector(t) for t in texts]


def onnx_encoder(path: str, tokenize: Callable[[list[str]], dict]) -> Embedder:
    """A local ONNX model with mean pooling; needs onnxruntime and a model file."""
    loaded = {}

    def encode(texts: list[str]) -> list[list[float]]:
        import numpy as np
        import onnxruntime

        if path not in loaded:
            loaded[path] = onnxruntime.InferenceSession(path)
        model = loaded[path]
        given = tokenize(texts)
        out, mask = model.run(None, given)[0], given["attention_mask"][..., None]
        pooled = (out * mask).sum(axis=1) / np.maximum(mask.sum(axis=1), 1)
        return (pooled / np.maximum(np.linalg.norm(pooled, axis=1, keepdims=True), 1e-12)).tolist()

    return encode


def first_sentence(prompts: list[str]) -> list[str]:
    """The stub generator: the first sentence of the evidence, tagged."""
    import re

    return [f"{re.match(r'[^.!?]*[.!?]?', p.strip())[0]} [E1]" for p in prompts]


def embed_with(embedder: Embedder, text: Column) -> Column:
    """Vectors of an embedder; null texts are empty."""

    def run(s: pd.Series) -> pd.Series:
        return pd.Series(embedder(s.fillna("").tolist()), index=s.index, dtype=object)

    return vectorized("array<double>")(run)(text)


def generate_with(generator: Generator, prompt: Column) -> Column:
    """Answers of a generator."""

    def run(s: pd.Series) -> pd.Series:
        return pd.Series(generator(s.fillna("").tolist()), index=s.index)

    return vectorized("string")(run)(prompt)
