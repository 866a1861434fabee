"""Sizes of texts in tokens of a public tokenizer. Tokenizers are read from a folder that is a parameter; none is trained."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder and file of the vocabulary: ranks of byte pairs, as tiktoken reads them.
FOLDER, VOCABULARY = os.environ.get("FEEDMILL_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_multi_50k.tiktoken"
#: What words a text is cut into before byte pairs are merged: a fixed value of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(4)
def encoding(folder: str = FOLDER, vocabulary: str = VOCABULARY) -> tiktoken.Encoding:
    with open(os.path.join(folder, vocabulary), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> list[int]:
    return encoding(folder, vocabulary).encode_ordinary(text)


def counts(texts: pa.Array, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Tokens of each text; null and empty texts have none."""
    e = encoding(folder, vocabulary)
    return np.array([len(e.encode_ordinary(t)) if t else 0 for t in texts.to_pylist()], np.int64)


def sized(df: DataFrame, item: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """(item, kept columns, n_tokens): whole texts are counted, none is carried further."""
    rows = df.select(F.col(item).cast("long").alias("_item"), *keep, F.col(text).alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = counts(batch.column("_text"), folder, vocabulary)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_item", *keep)), pa.array(n)], names=["_item", *keep, "n_tokens"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    return rows.mapInArrow(count, fields + ", n_tokens long").withColumnRenamed("_item", item)
