"""Helpers shared by the text operators: row keys, byte views of Arrow texts, components, tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.session import scratch_path, settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text that a Python worker handles at a time; one longer text is a slice of its own.
SLICE_BYTES = 1_000_000


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, rid, kb[, rest]): the two columns an operator needs and a key of the row.

    Columns named in ``carry`` go along as one struct ``rest``; all others are left behind, whatever their names.

    ``rid`` is a hash of id and text and ``kb`` one of the text alone, so rows with a NULL or
    repeated id stay apart unless they are the same in both columns, and then they get the same
    answer. NULL texts count as empty.
    """
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    rest = [F.struct(*[df[c] for c in carry]).alias("rest")] if carry else []
    return df.select(df[id_col].alias("id"), text.alias("text"), row_key(df, id_col, text_col).alias("rid"),
                     F.xxhash64(text).alias("kb"), *rest)


def row_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The ``rid`` of :func:`texts`."""
    return F.xxhash64(df[id_col], F.coalesce(df[text_col].cast("string"), F.lit("")))


def stow(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared folder and go on from the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the column's UTF-8 bytes and the offsets of its texts in them, uncopied."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        array = batch.column(at)
        if not pa.types.is_string(array.type):
            array = array.cast(pa.string())
        if batch.num_rows == 0:
            continue
        _, starts, data = array.buffers()
        offsets = np.frombuffer(starts, np.int32)[array.offset:array.offset + len(array) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        low = 0
        while low < len(array):
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
            part = offsets[low:high + 1]
            yield batch.slice(low, high - low), raw[part[0]:part[-1]], part - part[0]
            low = high


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of arrays, lists or Arrow arrays in the order of the schema."""
    made = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(made, schema=schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    """The Arrow type of a Spark type."""
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one, so that their order is random."""
    x = values ^ (values >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links a-b: each node that isn't its tree's least node, with that least node."""
    if not len(a):
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        high = np.maximum(label[u], label[v])
        open_ = low != high
        if not open_.any():
            break
        np.minimum.at(label, high[open_], low[open_])
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``links(a, b)``: the least node it is joined with.

    Alternates two star contractions: hang all larger neighbours below the least one, then all smaller
    ones, until nothing changes. Each round is two aggregations and two joins on the node, which
    adaptive execution splits where a hub is hot; edges never grow in number. Every round is settled in
    reliable storage, so a lost executor costs one round at most. NULL ends and loops are ignored.
    """
    edges = settle(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = _state(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        joined = hung.join(least, "u")
        edges = settle(joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = _state(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
