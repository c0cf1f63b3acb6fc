"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Code points of a piece that is encoded at once, and rows and bytes of text of a batch that goes back to Spark.
PIECE, ROWS, BYTES = 100_000, 512, 4_000_000
#: One space between two characters that are none: every token ends before it, and the next starts with it.
SAFE = regex.compile(r"(?<=\S) (?=\S)")


@lru_cache(4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Cuts a long text at safe boundaries only; a stretch without any stays whole."""
    start = 0
    while len(text) - start > size:
        m = SAFE.search(text, start + size)
        if not m:
            break
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


def encode(text: str, enc: tiktoken.Encoding) -> np.ndarray:
    return np.concatenate([np.array(enc.encode_ordinary(p), np.int32) for p in pieces(text)])


def bpe(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Adds ``ids`` (array of int) and ``decoded`` (the bytes that these ids stand for).

    Null counts as empty text, which has no ids. No special tokens. Any other columns pass through; columns that
    already bear the new names are replaced. ``path`` is the rank file on every machine.
    """
    kept = [c for c in df.columns if c.lower() not in (ids_col.lower(), decoded_col.lower())]
    df = df.select(*[f"`{c}`" for c in kept])
    schema = T.StructType([*df.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False)), T.StructField(decoded_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                ids, raw, size, start = [], [], 0, at
                while at < batch.num_rows and at - start < ROWS and size < BYTES:
                    text = batch.column(batch.schema.get_field_index(text_col))[at].as_py() or ""
                    ids.append(encode(text, enc))
                    raw.append(enc.decode_bytes(ids[-1].tolist()))
                    size += len(raw[-1])
                    at += 1
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*batch.slice(start, at - start).columns, column, pa.array(raw, pa.binary())], names=[*kept, ids_col, decoded_col])

    return df.mapInArrow(run, schema)
