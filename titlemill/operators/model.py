"""Applying caller-supplied batch models on executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F, types as T

from titlemill.functions.text import has_items, let, nz
from titlemill.functions.vectors import item_embedding_text

ChatModel = Callable[[list[list[dict]]], list[str]]
EmbeddingModel = Callable[[list[str]], list[list[float]]]

BATCH_SIZE = 100
DIMENSION = 1536


def _ask(model: ChatModel, conversations: list[list[dict]]) -> list[tuple[str | None, str | None]]:
    """(reply, error) per conversation. A batch that fails is retried one by one, so that one bad
    conversation does not fail its neighbours."""
    try:
        replies = list(model(conversations))
        if len(replies) != len(conversations):
            raise ValueError(f"{len(replies)} replies for {len(conversations)} conversations")
        return [(reply, None) for reply in replies]
    except Exception as error:
        if len(conversations) == 1:
            return [(None, str(error) or type(error).__name__)]
        return [_ask(model, [c])[0] for c in conversations]


def structure(
    rows: DataFrame, key: str, messages: Column, model: ChatModel, batch_size: int = BATCH_SIZE
) -> DataFrame:
    """key, reply, error: one model call per batch of conversations, errors kept per row.

    The number of partitions of `rows` sets how many calls run at once. Materialise the result
    before using it twice.
    """
    key_type = rows.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, key_type),
            T.StructField("reply", T.StringType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start : start + batch_size]
                talks = [
                    [{"role": m["role"], "content": m["content"]} for m in talk]
                    for talk in part["messages"]
                ]
                answers = _ask(model, talks)
                yield pd.DataFrame(
                    {
                        key: part[key].to_numpy(),
                        "reply": [a[0] for a in answers],
                        "error": [a[1] for a in answers],
                    }
                )

    return rows.select(key, messages.alias("messages")).mapInPandas(run, schema)


def embed(
    model: EmbeddingModel, batch_size: int = BATCH_SIZE, dimension: int = DIMENSION
) -> Callable[[Column], Column]:
    """A column function text -> struct(embedding, error), calling `model` once per batch.

    Texts and vectors stay beside their ids, so order cannot slip. A batch that fails, or that
    returns the wrong number of vectors, is retried text by text; a vector of the wrong dimension
    is an error of its row.
    """

    def vectors(texts: list[str]) -> list[tuple[list[float], str]]:
        try:
            found = [list(v) for v in model(texts)]
            if len(found) != len(texts):
                raise ValueError(f"{len(found)} vectors for {len(texts)} texts")
        except Exception as error:
            if len(texts) == 1:
                return [([], str(error) or type(error).__name__)]
            return [vectors([text])[0] for text in texts]
        return [
            (v, "") if len(v) == dimension else ([], f"dimension {len(v)}, not {dimension}")
            for v in found
        ]

    def make_predict():
        def predict(texts: np.ndarray) -> list[dict]:
            return [
                {"embedding": np.asarray(vector, dtype=np.float32), "error": error}
                for vector, error in vectors([str(t) for t in texts])
            ]

        return predict

    result = T.StructType(
        [
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            T.StructField("error", T.StringType()),
        ]
    )
    predict_column = predict_batch_udf(make_predict, return_type=result, batch_size=batch_size)

    def apply(text: Column) -> Column:
        # Predictions cannot be NULL: an empty vector and an empty error stand for it.
        return let(
            predict_column(text),
            lambda p: F.struct(
                F.when(has_items(p["embedding"]), p["embedding"]).alias("embedding"),
                nz(p["error"]).alias("error"),
            ),
        )

    return apply


def embed_items(
    items: DataFrame,
    model: EmbeddingModel,
    batch_size: int = BATCH_SIZE,
    dimension: int = DIMENSION,
) -> DataFrame:
    """id, embedding, error for fetched items (`fetch_for_embedding`)."""
    vector = embed(model, batch_size, dimension)
    return (
        items.select("id", item_embedding_text().alias("text"))
        .select("id", vector(F.col("text")).alias("vector"))
        .select("id", "vector.embedding", "vector.error")
    )
