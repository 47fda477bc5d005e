"""Joins with a side that is usually small."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    MapType,
    NumericType,
    StringType,
    StructType,
)

BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 32


def _bytes(c: Column, kind: DataType) -> Column | int:
    if isinstance(kind, (StringType, BinaryType)):
        return F.octet_length(c)
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, NumericType):
        return F.size(c) * 8
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, ArrayType):
        return _bytes(F.flatten(c), kind.elementType)
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.octet_length(F.to_json(F.struct(c)))
    return 16


def _width(df: DataFrame) -> Column:
    size = F.lit(_ROW_BYTES)
    for field in df.schema.fields:
        part = _bytes(F.col(f"`{field.name}`"), field.dataType)
        size = size + (F.coalesce(part, F.lit(0)) if isinstance(part, Column) else F.lit(part))
    return size


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as counted from the data itself, by one aggregate."""
    return df.agg(total_width(df)).first()[0]


def total_width(df: DataFrame) -> Column:
    """The same as an aggregate column."""
    return F.coalesce(F.sum(_width(df).cast("bigint")), F.lit(0))


_scope: ContextVar[list[DataFrame] | None] = ContextVar("kept", default=None)


def kept(df: DataFrame) -> DataFrame:
    """Keep a derived lookup for its second use. Lost blocks are recomputed from its plan."""
    held = _scope.get()
    if held is not None:
        held.append(df)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def release_after() -> Iterator[None]:
    """Drop what the operators kept inside the block when it ends; write the results inside."""
    held: list[DataFrame] = []
    token = _scope.set(held)
    try:
        yield
    finally:
        _scope.reset(token)
        for df in held:
            df.unpersist()


def join_lookup(
    big: DataFrame,
    lookup: DataFrame,
    on: str | list[str] | Column,
    how: str = "inner",
    limit_bytes: int = BROADCAST_BYTES,
    size: int | None = None,
) -> DataFrame:
    """Join ``big`` to a lookup, broadcast only where its measured size is below the limit.

    Beyond the limit this is a shuffle join with ``big`` on the left, where adaptive execution
    can split the partitions of a hot key for inner, left, semi and anti joins. ``size`` is the
    measured size where the caller has it.
    """
    if (measured_bytes(lookup) if size is None else size) <= limit_bytes:
        lookup = F.broadcast(lookup)
    return big.join(lookup, on, how)
