"""Texts packed in compressed chunks of bounded size, as rows of a table in the shared folder.

A chunk is the unit in which an operator hands facts about its words to other tasks and
gets answers back: words are addressed by chunk and place, and no text is shuffled twice
uncompressed.  The table is written once, so chunks stay the same when a task is repeated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .textcore import Texts
from .workspace import bounded_batches, give_back

CHUNK = 4 << 20
COLUMNS = "chunk long, ids binary, sizes binary, texts binary, bytes long"
SCHEMA = pa.schema([("chunk", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("texts", pa.binary()), ("bytes", pa.int64())])


def pack(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """Rows (id, text) as chunks of whole texts of about ``size`` bytes (a longer text stands alone)."""

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        parts: list[bytes] = []
        sizes: list[np.ndarray] = []
        held = 0

        def chunk():
            own = np.array([(d is None, d or 0) for d in ids], dtype=np.int64)
            body = b"".join(parts)
            row = [task << 32 | number, own.tobytes(), np.concatenate(sizes).tobytes(), pa.compress(body, "zstd", asbytes=True), len(body)]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, SCHEMA.types, strict=True)], schema=SCHEMA)

        for batch in batches:
            for at, block in Texts.of(batch.column(1)).blocks(max(1, size // 4)):
                if ids and held + len(block.data) > size:
                    yield chunk()
                    ids, parts, sizes, held, number = [], [], [], 0, number + 1
                ids += batch.column(0).slice(at, len(block)).to_pylist()
                parts.append(block.data.tobytes())
                sizes.append(np.diff(block.offsets))
                held += len(block.data)
        if ids:
            yield chunk()
        give_back()

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, COLUMNS)


def unpack(row: dict) -> Texts:
    n = row["bytes"]
    data = np.frombuffer(pa.decompress(row["texts"], decompressed_size=n, codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    return Texts(data, np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], np.int64))]).astype(np.int64))


def ids_of(row: dict) -> pa.Array:
    null, ids = np.frombuffer(row["ids"], np.int64).reshape(-1, 2).T
    return pa.array(ids, pa.int64(), mask=null.astype(bool))
