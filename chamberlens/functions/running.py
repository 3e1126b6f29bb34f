"""Running sums over an order, without a task that holds all rows.

Rows are dealt out by ranges of the order and stored sorted; every partition tells its
sums in one small row, from which the driver derives what each partition starts from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from chamberlens.session import stored

FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)


def running_sums(df: DataFrame, sums: dict[str, Column], order: list[Column], by: str | None = None) -> DataFrame:
    """``df`` with a new column per entry of ``sums``: the entry summed over the rows up to
    and with this one in ``order``, within equal values of the column ``by`` if given.

    Whole numbers are summed as longs, others as doubles; null counts as zero. Rows equal
    in ``by`` and ``order`` follow each other in some, but one, order. Null in ``by`` is a
    value like others. Rows are stored once, when called; a group of any size, even of
    equal rows, spreads over partitions. The driver holds one row per partition.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kinds = df.select(*[c.alias(n) for n, c in sums.items()]).schema
    kind = {f.name: "double" if isinstance(f.dataType, FRACTIONAL) else "bigint" for f in kinds}
    given = {n: F.coalesce(c.cast(kind[n]), F.lit(0).cast(kind[n])) for n, c in sums.items()}
    group, place = _free(df, "_group"), _free(df, "_place")
    keyed = df.withColumns({group: F.col(by) if by else F.lit(0), **given, place: F.monotonically_increasing_id()})
    keys = [F.asc_nulls_first(group), *order, F.asc(place)]
    dealt = stored(keyed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop(place))
    part = F.spark_partition_id().alias(_free(df, "_part"))
    grouped = dealt.schema[group].dataType.simpleString()
    totals = ", ".join(f"`{n}` {kind[n]}" for n in sums)
    slim = dealt.select(part, F.col(group), *[F.col(n) for n in sums])
    summaries = slim.mapInArrow(_summarised, f"part int, first {grouped}, last {grouped}, {totals}").collect()
    starts = spark.sparkContext.broadcast(_starts(summaries, len(sums)))
    ready = dealt.select(part, group, *sums, *[c for c in df.columns if c not in sums])
    kept = T.StructType([ready.schema[c] for c in ready.columns[2:]])
    return ready.mapInArrow(_running(starts, len(sums)), kept).select(*[c for c in df.columns if c not in sums], *sums)


def _free(df: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def _codes(groups: pa.Array) -> np.ndarray:
    """Numbers that differ where neighbouring groups do."""
    encoded = groups.dictionary_encode("encode")
    encoded = encoded.combine_chunks() if isinstance(encoded, pa.ChunkedArray) else encoded
    return encoded.indices.to_numpy(zero_copy_only=False)


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the partition, its first and last group, and the sums of the last one."""
    part = first = last = None
    totals: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = _codes(batch.column(1))
        if part is None:
            part, first = batch.column(0)[0].as_py(), batch.column(1)[0]
        here = np.flatnonzero(codes != codes[-1])
        tail = here[-1] + 1 if len(here) else 0
        if tail or batch.column(1)[0] != last:
            totals = []
        last = batch.column(1)[batch.num_rows - 1]
        found = [c.to_numpy(zero_copy_only=False)[tail:].sum().item() for c in batch.columns[2:]]
        totals = [a + b for a, b in zip(totals, found)] if totals else found
    if part is not None:
        arrays = [pa.array([part], pa.int32()), pa.array([first.as_py()], first.type), pa.array([last.as_py()], last.type)]
        sums = [pa.array([t], c.type) for t, c in zip(totals, batch.columns[2:])]
        yield pa.RecordBatch.from_arrays([*arrays, *sums], names=["part", "first", "last", *batch.schema.names[2:]])


def _starts(summaries: list, n: int) -> dict[int, tuple]:
    """What the first group of each partition has summed up before it."""
    starts, group, carried = {}, None, (0,) * n
    for number, row in enumerate(sorted(summaries)):
        part, first, last, *sums = row
        begun = carried if number and first == group else (0,) * n
        starts[part] = begun
        carried = tuple(a + b for a, b in zip(begun, sums)) if first == last else tuple(sums)
        group = last
    return starts


def _running(starts, n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, carried = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(1)
            if carried is None:
                carried, group = starts.value[batch.column(0)[0].as_py()], groups[0]
            codes = _codes(groups)
            change = np.flatnonzero(codes[1:] != codes[:-1]) + 1
            sizes = np.diff(np.concatenate(([0], change, [len(codes)])))
            held = [c if groups[0] == group else 0 for c in carried]
            arrays, ends = [], []
            for column, start in zip(batch.columns[2 : 2 + n], held):
                running = np.cumsum(column.to_numpy(zero_copy_only=False))
                before = np.concatenate(([-start], running[change - 1]))
                running = running - np.repeat(before, sizes).astype(running.dtype)
                arrays.append(pa.array(running, column.type))
                ends.append(running[-1].item())
            carried, group = ends, groups[len(groups) - 1]
            yield pa.RecordBatch.from_arrays([*arrays, *batch.columns[2 + n :]], names=batch.schema.names[2:])

    return work
