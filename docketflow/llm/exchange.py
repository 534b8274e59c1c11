"""All-to-all counting of 64-bit keys in packed form.

Groups of rows send the sorted distinct keys of their texts, cut into key ranges and
delta-coded (4 to 6 bytes a key instead of a row of 32), to one tally per range; each
tally answers every sender with one small value per key, in the order it was sent.
A key that occurs a million times costs one entry per sending group, so no tally
depends on how often a key repeats.  Both sides grow in proportion to the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BLOBS = "grp int, bucket int, n long, keys binary, extra binary"
REPLIES = "grp int, bucket int, body binary"
BLOBS_ARROW = pa.schema([("grp", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("extra", pa.binary())])
REPLIES_ARROW = pa.schema([("grp", pa.int32()), ("bucket", pa.int32()), ("body", pa.binary())])
#: Bytes of text in one sending group, and keys in one tally: both bound a task's memory.
GROUP_BYTES = 6 << 20
TALLY_KEYS = 1_500_000


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as the first one and the differences, each in as few bytes as the largest needs."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=keys[:1])
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return keys[:1].tobytes() + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(body: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    width = (len(body) - 8) // n
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(body, np.uint8, n * width, 8).reshape(n, width)
    steps = wide.view("<u8").ravel()
    steps[0] = np.frombuffer(body, np.uint64, 1)[0]
    return np.cumsum(steps, dtype=np.uint64)


def squeeze(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def spread(body: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(body), kind)


def ranges(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where each of the ``buckets`` equal key ranges starts among sorted keys of ``bits`` bits."""
    edges = np.array([(b << bits) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


def send(grp: int, keys: np.ndarray, extra: np.ndarray, buckets: int, bits: int) -> pa.Table:
    """Blobs of one group's sorted distinct keys."""
    cut = ranges(keys, buckets, bits)
    at = [b for b in range(buckets) if cut[b] < cut[b + 1]]
    return pa.table(
        [
            pa.array([grp] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array([int(cut[b + 1] - cut[b]) for b in at], pa.int64()),
            pa.array([pack(keys[cut[b] : cut[b + 1]]) for b in at], pa.binary()), pa.array([squeeze(extra[cut[b] : cut[b + 1]]) for b in at], pa.binary()),
        ],
        schema=BLOBS_ARROW,
    )


def tally(blobs: DataFrame, merge: Callable[[np.ndarray, np.ndarray], np.ndarray], extra_kind: str) -> DataFrame:
    """Applies ``merge(keys, extra) -> one value per entry`` to all entries of each key range; replies as REPLIES."""

    def one(table: pa.Table) -> pa.Table:
        n = table["n"].to_pylist()
        keys = np.concatenate([unpack(k.as_py(), m) for k, m in zip(table["keys"], n, strict=True)])
        extra = np.concatenate([spread(e.as_py(), extra_kind) for e in table["extra"]])
        out, cut = merge(keys, extra), np.cumsum([0, *n])
        bodies = [squeeze(out[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.table([table["grp"], table["bucket"], pa.array(bodies, pa.binary())], schema=REPLIES_ARROW)

    return blobs.groupBy("bucket").applyInArrow(one, REPLIES)


def answers(replies: pa.Table, kind) -> np.ndarray:
    """The values for one group's keys in the order of the sorted keys."""
    if not replies.num_rows:
        return np.zeros(0, kind)
    rows = sorted(zip(replies["bucket"].to_pylist(), replies["body"], strict=True), key=lambda r: r[0])
    return np.concatenate([spread(b.as_py(), kind) for _, b in rows])


def sizes(docs: DataFrame, text: str) -> tuple[int, int]:
    """Sending groups and tallies for a table of texts, from its total bytes (one scan, two numbers)."""
    total = docs.select(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return max(1, -(-total // GROUP_BYTES)), max(1, -(-total // (6 * TALLY_KEYS)))


def shape(df: DataFrame, columns: list[str], more: str = "") -> T.StructType:
    """Schema of some columns of ``df`` as they are, all nullable, and of further columns given as DDL."""

    def free(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, free(f.dataType), True) for f in kind])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(free(kind.elementType), True)
        if isinstance(kind, T.MapType):
            return T.MapType(free(kind.keyType), free(kind.valueType), True)
        return kind

    return T.StructType([T.StructField(c, free(df.schema[c].dataType), True) for c in columns] + (T.StructType.fromDDL(more).fields if more else []))


def arrow(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(shape(df, [column])[0].dataType)


def same_rows(column, kind):
    """An Arrow column (or chunked column) with the nullability that the result's schema declares."""
    if column.type == kind:
        return column
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks else pa.array([], column.type)
    if pa.types.is_struct(kind):
        fields = [same_rows(c, f.type) for c, f in zip(column.flatten(), kind, strict=True)]
        return pa.StructArray.from_arrays(fields, fields=list(kind), mask=column.is_null()) if len(kind) else column
    return column.cast(kind)


def row_key(i, more):
    """Hash of a row's id and of something about its text, so that null or repeated ids don't meet in one group."""
    return F.xxhash64(i.cast("string"), more)


def grouped(docs: DataFrame, id_col: str, text_col: str, groups: int, more=None) -> DataFrame:
    """Columns grp, id, text and carried (the other columns), dealt evenly over ``groups`` by ``row_key``."""
    key = row_key(F.col(id_col), F.octet_length(F.col(text_col)) if more is None else more)
    return docs.select(
        F.pmod(key, F.lit(groups)).cast("int").alias("grp"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)] or [F.lit(None).alias("none")]).alias("carried"),
    ).repartition(max(-(-groups // 2), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "grp")
