"""Rows of an embedding table as blocks: one row holds the ids and the integer entries of some thousand vectors.

Blocks are written once to the shared folder; what comes after moves them whole, and numpy works on them in the tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.staging import staged
from lakeops.llm.words import releasing

BLOCK_ROWS = 4096
BLOCK_SCHEMA = "size long, dim int, ids array<long>, labels array<long>, marks array<boolean>, code string, entries binary"


def is_finite_vector(vector: Column) -> Column:
    """Not null, and no entry is null, NaN or infinite."""
    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    return F.coalesce(vector.isNotNull() & ~F.exists(vector, bad), F.lit(False))


def packed(x: np.ndarray) -> tuple[str, bytes]:
    """(numpy type, bytes) of integers in the narrowest type that holds them."""
    code = next((c for c in ("<i2", "<i4") if not x.size or (x.min() >= np.iinfo(c).min and x.max() <= np.iinfo(c).max)), "<i8")
    return code, np.ascontiguousarray(x.astype(code)).tobytes()


def widened(x: np.ndarray, width: int) -> np.ndarray:
    """With zeros for the entries that are missing."""
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def matrix(code: str, entries, size: int, dim: int, width: int) -> np.ndarray:
    """The integers of a block as size x width, in their narrow type."""
    return widened(np.frombuffer(entries, code).reshape(size, dim), width)


def blocks(rows: DataFrame, integers: Callable[[np.ndarray], np.ndarray], name: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of ``rows`` (id long, vector array<double>, label long, mark boolean), with a number: written and read again.

    integers: exact integer entries of a float64 array; an entry beyond a long raises OverflowError.  Vectors shorter than the
    longest of their block are filled up with zeros (before ``integers``), and so are shorter blocks where they are read.
    """
    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                vectors = part.column("vector")
                sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
                dim = int(sizes.max())
                x = np.zeros((len(part), dim))
                x[np.arange(dim) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
                whole = integers(x)
                if whole.size and np.abs(whole).max() >= 2.0**63:
                    raise OverflowError("an entry of a vector does not fit a long")
                code, entries = packed(whole.astype(np.int64))
                column = lambda c, kind: pa.array([part.column(c).to_pylist()], pa.list_(kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(part)], pa.int64()), pa.array([dim], pa.int32()), column("id", pa.int64()), column("label", pa.int64()),
                     column("mark", pa.bool_()), pa.array([code]), pa.array([entries], pa.binary())],
                    names=["size", "dim", "ids", "labels", "marks", "code", "entries"])

    out = rows.select("id", "vector", "label", "mark").mapInArrow(releasing(pack), BLOCK_SCHEMA)
    place = F.monotonically_increasing_id()
    number = F.shiftleft(F.shiftright(place, 33), 24) + place.bitwiseAND(F.lit((1 << 33) - 1))  # 2**24 blocks a file part
    return staged(out.withColumn("block", number), name)
