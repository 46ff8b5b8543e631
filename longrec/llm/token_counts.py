"""Token counts of whole texts: batches balanced by bytes, lengths only leave the encoder.

Every text is cut at boundaries that no token crosses into pieces of bounded size; pieces
of several rows are gathered until a batch holds about ``BATCH_BYTES`` of UTF-8, so neither a long text nor
a run of short ones makes a batch large or small.  Of a batch only the runs between safe places that the
worker does not remember go to the encoder, in one call.

Defined results: a null text counts as empty and has 0 bytes and 0 tokens; rows with the same id
are counted each on its own; a null id stays null; a long text without a safe boundary is one piece; an empty table gives an empty result; other
columns are ignored; an id column named like one of the result gets underscores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longrec.llm import tokens
from longrec.llm.common import apart_from, ship, text_or_empty

#: Bytes of UTF-8 in one batch, and characters in one piece of a long text.
BATCH_BYTES = 1 << 18
PIECE_CHARS = 1 << 16


def _counts(texts: Iterator[str | None], path: str, n_rows: int) -> np.ndarray:
    lengths = tokens.run_lengths(path)
    counts = np.zeros(n_rows, np.int64)
    pieces, rows, size = [], [], 0

    def encode() -> None:
        np.add.at(counts, rows, lengths.count(pieces))

    for row, text in enumerate(texts):
        for piece in tokens.split_safely(text, PIECE_CHARS) if text else ():
            pieces.append(piece)
            rows.append(row)
            size += len(piece.encode())
            if size >= BATCH_BYTES:
                encode()
                pieces, rows, size = [], [], 0
    if pieces:
        encode()
    return counts


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512
) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of each row.

    ``path`` is a ``tokenizers`` file of a byte-level tokenizer without normalizer, readable under the
    same name on every executor.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            text = batch.column("text")
            counts = _counts((t.as_py() for t in text), path, len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pc.binary_length(text).cast(pa.int64()), pa.array(counts), pa.array(counts > limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    counted = rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumnRenamed("id", apart_from(id_col, counted.columns[1:]))
