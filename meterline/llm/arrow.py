"""Small helpers for tasks that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches that hold about ``max_bytes`` of text, with the texts as UTF-8 bytes (null: empty).

    A single longer text is a block of its own, so memory follows the longest
    text and not the number of rows in a batch.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        start, size, held = 0, 0, []
        for i in range(batch.num_rows):
            value = texts[i].as_py() or b""
            if held and size + len(value) > max_bytes:
                yield batch.slice(start, i - start), held
                start, size, held = i, 0, []
            held.append(value)
            size += len(value)
        if held:
            yield batch.slice(start), held


def record_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch with the columns in the order of the schema."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
