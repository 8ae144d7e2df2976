"""Text to vectors.

An encoder factory builds an encoder once per task; the encoder turns an Arrow array of texts into
a matrix. The default encoder hashes words and needs no model. A model-backed factory has the same
form and is passed as an argument.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.params import require_columns

Encoder = Callable[[pa.Array], np.ndarray]


def hashing_encoder(dim: int = 384) -> Callable[[], Encoder]:
    """Factory of an encoder that counts lower-cased words at the position MD5 gives them.

    The position is the number in the first eight hex digits of the MD5, modulo ``dim``. Each
    distinct word of a batch is hashed once.
    """

    def build() -> Encoder:
        def encode(texts: pa.Array) -> np.ndarray:
            words = pc.utf8_split_whitespace(pc.utf8_lower(texts))
            rows = np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy())
            coded = words.flatten().dictionary_encode()
            places = np.array(
                [
                    int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim if w else -1
                    for w in coded.dictionary.to_pylist()
                ],
                dtype=np.int64,
            )
            at = places[coded.indices.to_numpy()] if len(coded) else places
            real = at >= 0
            cells = np.bincount(rows[real] * dim + at[real], minlength=len(texts) * dim)
            return cells.reshape(len(texts), dim).astype(np.float64)

        return encode

    return build


def embed(
    text: Column, factory: Callable[[], Encoder] | None = None, normalize: bool = True
) -> Column:
    """Vector of a text, of length one unless it is all zero. Null counts as empty text."""
    factory = factory or hashing_encoder()

    @F.arrow_udf("array<float>")
    def to_vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = factory()
        for batch in batches:
            matrix = np.asarray(encode(batch), dtype=np.float64)
            if normalize:
                norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
                matrix = matrix / np.where(norms > 0, norms, 1.0)
            width = matrix.shape[1] if matrix.ndim == 2 else 0
            bounds = pa.array(np.arange(len(batch) + 1) * width, pa.int32())
            values = pa.array(matrix.astype(np.float32).ravel())
            yield pa.ListArray.from_arrays(bounds, values)

    return to_vectors(F.coalesce(text, F.lit("")))


def embed_table(
    df: DataFrame,
    text_col: str = "chunk_text",
    factory: Callable[[], Encoder] | None = None,
    normalize: bool = True,
    embedding_col: str = "embedding",
) -> DataFrame:
    """Add the vector of a text column."""
    require_columns(df, [text_col])
    return df.withColumn(embedding_col, embed(F.col(f"`{text_col}`"), factory, normalize))


def embedding_info(df: DataFrame, embedding_col: str = "embedding") -> DataFrame:
    """Number of vectors per dimension. A sound table has one row."""
    require_columns(df, [embedding_col])
    return df.groupBy(F.size(embedding_col).alias("dimension")).agg(F.count("*").alias("count"))
