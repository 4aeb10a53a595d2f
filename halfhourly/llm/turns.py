"""Turns of conversations in order, and digests of long ordered groups."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def in_order(turn: Column, role: Column, text: Column) -> list[Column]:
    """What orders the turns of a conversation: turn (nulls first), then role and text.

    Ranges are cut by these, and bounds of ranges pass through the driver, so of role and
    text only the beginnings stand here, followed by a hash; rows that agree in all are equal.
    """
    return [turn.asc_nulls_first(), F.substring(role, 1, 32).asc_nulls_first(),
            F.substring(text, 1, 64).asc_nulls_first(), F.xxhash64(role, text)]


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def as_strings(values: list[bytes | None]) -> pa.Array:
    """Stored bytes as a string column, unchanged even where they are no UTF-8."""
    return pa.array(values, pa.binary()).cast(pa.string(), safe=False)


def stream_digests(pieces: DataFrame, key: str, order: list[str], piece: str, sep: str) -> DataFrame:
    """SHA-256 of each key's pieces in order, joined by ``sep``: ``key``, ``sha256``.

    The digest of a sequence is sequential, so the pieces of a key pass through one task; they
    are hashed as they come and none is held. Callers join small pieces into large ones first.
    """
    rows = (pieces.select(F.col(key).alias("k0"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                          F.col(piece).cast("string").alias("text"))
            .repartition(partitions(pieces), "k0").sortWithinPartitions("k0", *[f"o{i}" for i in range(len(order))])
            .select("k0", "text"))
    between = sep.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, kind = None, None, None
        for batch in batches:
            kind, keys, digests = batch.schema.field(0).type, [], []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if digest is None or k != current:
                    if digest is not None:
                        keys.append(current)
                        digests.append(digest.hexdigest())
                    current, digest = k, hashlib.sha256()
                else:
                    digest.update(between)
                digest.update(text or b"")
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(digests)], names=["k0", "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([digest.hexdigest()])],
                                             names=["k0", "sha256"])

    kind = rows.schema["k0"].dataType.simpleString()
    return rows.mapInArrow(run, f"k0 {kind}, sha256 string").select(F.col("k0").alias(key), "sha256")
