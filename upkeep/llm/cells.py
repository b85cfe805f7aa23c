"""A stated set of queries against all rows, block by block: each pair of a block of rows and a block of queries meets in one task."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_count(rows: int, most: int, tasks: int, least: int) -> int:
    """Blocks of at most about `most` rows; more, while they keep `least` rows, so that all tasks have work."""
    return max(-(-rows // most), min(-(-rows // least), 2 * tasks), 1)


def dealt(row: Column, blocks: int | Column) -> Column:
    """The block of a row by the hash of its number."""
    return F.pmod(F.xxhash64(row, F.lit("block")), F.lit(blocks) if isinstance(blocks, int) else blocks).cast("int")


def in_cells(rows: DataFrame, queries: DataFrame, query_blocks: int, row_blocks: DataFrame, f: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """f(rows, queries) for each cell. rows have `block`; queries have `part` of `query_blocks`; row_blocks lists the blocks.

    Rows are sent once for each block of queries, queries once for each block of rows, and both sizes are bounded by who made the blocks.
    """
    each = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    places = row_blocks.select(F.col("block").alias("to"), each.alias("part"))
    right = queries.join(places, "part")
    return rows.withColumn("of", each).groupBy("block", "of").cogroup(right.groupBy("to", "part")).applyInArrow(f, schema)


def numbered(df: DataFrame) -> DataFrame:
    """`df` with `row`, a number of its own for each row: write the result before using it twice."""
    return df.withColumn("row", F.monotonically_increasing_id())
