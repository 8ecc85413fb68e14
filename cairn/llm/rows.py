"""A number for each row of a table whose ids may be null or repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import runtime
from cairn.llm.scratch import Scratch

#: Name of the number's column.
ROW = "_cairn_row"


def with_row_numbers(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the column ``ROW``, unique and never null.

    Where ids are so themselves, it is the id, and nothing moves.  Else rows are
    numbered in the order of their ids, null ids last, and written once, so that
    numbers stay what they are; neither null ids nor the rows of one id are kept
    together.  An empty table stays empty.
    """
    ids = docs.groupBy(F.col(id_col).alias("id")).count()
    if ids.where("id IS NULL OR count > 1").isEmpty():
        return docs.withColumn(ROW, F.col(id_col).cast("long"))
    turn = f"{ROW}_turn"
    order = [F.col(id_col).asc_nulls_last(), F.col(turn)]
    sorted_rows = (
        docs.withColumn(turn, F.monotonically_increasing_id())
        .repartitionByRange(runtime.partitions_for(docs.sparkSession), *order).sortWithinPartitions(*order)
    )
    return scratch.cut(sorted_rows.withColumn(ROW, F.monotonically_increasing_id()).drop(turn), "rows")
