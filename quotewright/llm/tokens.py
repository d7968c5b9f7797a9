"""BPE encoding and decoding of whole texts as columns, by speculate and verify (``bpe``).

Each batch of rows is encoded on its own, so a task's memory is bounded by a batch and
nothing is shuffled.  A null text has no ids and decodes to the empty text; so does a null
list of ids.  Rows, ties and other columns stay as they are; an empty table stays empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm import bpe
from quotewright.llm.common import shipped


def ids_column(text: Column, vocabulary: str) -> Column:
    """The token ids of a text, array<int>."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        lengths, flat = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)]
        for first, ids in bpe.load(vocabulary).encode(texts):
            lengths.append(np.diff(first))
            flat.append(ids)
        offsets = np.cumsum(np.concatenate(lengths))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(flat)))

    return encode(text)


def text_column(ids: Column, vocabulary: str) -> Column:
    """The text of token ids; ids outside the vocabulary have none."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        codec = bpe.load(vocabulary)
        lists = lists.cast(pa.list_(pa.int32()))
        lengths = lists.value_lengths().fill_null(0).to_numpy()
        flat = lists.flatten().fill_null(-1).to_numpy()
        flat = np.where((flat < 0) | (flat >= codec.blank), codec.blank, flat)
        first = np.concatenate([[0], np.cumsum(lengths)])
        return pa.array(codec.decode(first, flat), pa.binary()).cast(pa.string())

    return decode(ids)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of a text column."""
    shipped(docs.sparkSession)
    return docs.withColumn(ids, ids_column(docs[text], vocabulary))


def decode(docs: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of a column of token ids."""
    shipped(docs.sparkSession)
    return docs.withColumn(text, text_column(docs[ids], vocabulary))
