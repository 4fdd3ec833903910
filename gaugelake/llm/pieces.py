"""Sentencepiece encoding by a table of distinct marked words, and decoding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm import vocab
from gaugelake.llm.common import per_slice

ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def id_lists(encoded: list[bytes]) -> pa.ListArray:
    data = np.frombuffer(b"".join(encoded), "<i4")
    offsets = np.cumsum([0, *(len(e) // 4 for e in encoded)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(data))


def encode(docs: DataFrame, file: str) -> DataFrame:
    """``doc_id``, ``ids`` and the library's decoding of those ids, per document.

    Per slice of documents, the distinct marked words not yet in the worker's table are segmented once by the
    library; the ids of a document are those of its words joined by position. A null or empty text has no ids
    and decodes to an empty text. Repeated rows give repeated rows; other columns are ignored.
    """
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        table = vocab.chunk_ids(file)
        encoded = table.encode([t or "" for t in part.column("text").to_pylist()])
        decoded = [table.model.decode(np.frombuffer(e, "<i4").tolist()) if e else "" for e in encoded]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), id_lists(encoded), pa.array(decoded, pa.string())],
                                          schema=ENCODED)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(per_slice(run), "doc_id long, ids array<int>, decoded string"))
