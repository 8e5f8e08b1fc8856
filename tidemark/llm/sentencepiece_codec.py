"""SentencePiece encoding and decoding of a whole column by the merge-type prefix table.

A null text is an empty one and has no ids. Texts are encoded one by one, so ties and
repeated rows need no rule; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 256  # texts handled at once
_encoders: dict = {}  # a Python worker serves many tasks


def _encoder(path: str):
    from tidemark.llm.prefix_table import Encoder

    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded (text of these ids) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, decoded = [], []
                for text in part.column(1).to_pylist():
                    found = encoder.encode(text or "")
                    ids.append(np.array(found, np.int32))
                    decoded.append(encoder.decode(found))
                ends = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """Counts and digests of ids and decoded texts."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
