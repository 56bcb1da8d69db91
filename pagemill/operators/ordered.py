"""Ordered carry without one task per document.

A window over a whole document would put a document that holds a third of all rows into one task. Rows are therefore
scanned in blocks of pages; what one block hands to the next is a single row per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of results handed back at once.
BATCH = 2000
#: Pages per block.
PAGES = 32


def carry_last(rows: DataFrame, value: Column, name: str, doc: str = "doc_id", page: str = "page", order: tuple[str, ...] = ("idx",), inclusive: bool = False) -> DataFrame:
    """Adds ``name``: the last non-null ``value`` of the same document in front of the row (with ``inclusive``, or of the row)."""
    block = F.floor(F.col(page) / PAGES)
    rows = rows.withColumns({"_block": block, "_value": value})
    seq = Window.partitionBy(doc, "_block").orderBy(page, *order)
    frame = seq.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    rows = rows.withColumn("_inside", F.last("_value", True).over(frame))
    ends = rows.groupBy(doc, "_block").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(page, *order))).alias("_end"))
    over = Window.partitionBy(doc).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_before", F.last("_end", True).over(over)).drop("_end")
    return rows.join(ends, [doc, "_block"]).withColumn(name, F.coalesce("_inside", "_before")).drop("_block", "_value", "_inside", "_before")


def fold_groups(rows: DataFrame, keys: list[str], order: list[str], fold: Callable[[list[dict]], Iterable[tuple]] | Callable[[Iterator[dict]], Iterable[tuple]], schema: str | StructType, stream: bool = False) -> DataFrame:
    """``fold`` over the rows of each group in order; its tuples are the result's rows.

    Groups are sorted inside the partitions of one shuffle and streamed through Arrow batches, so that many small groups cost no
    call each. Only one group is held at a time; with ``stream`` not even that, as the fold gets the group's rows one by one. The key columns and the
    others reach the fold as plain values.
    """
    names = rows.columns
    target = rows.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)

        def records() -> Iterator[dict]:
            for batch in batches:
                yield from (dict(zip(names, values)) for values in zip(*(c.to_pylist() for c in batch.columns)))

        def packed(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)

        out: list[tuple] = []
        for _, group in groupby(records(), key=lambda r: tuple(r[k] for k in keys)):
            for row in fold(group if stream else list(group)):
                out.append(row)
                if len(out) >= BATCH:
                    yield packed(out)
                    out = []
        if out:
            yield packed(out)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, target)
