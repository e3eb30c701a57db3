"""Global order numbering without a single-partition window.

``row_number() over (order by k)`` moves every row to one task. Instead:

1. range-partition on the order key and sort inside each partition;
2. ``monotonically_increasing_id`` then encodes (partition, position);
3. count rows per partition - one row per partition, a proven small table;
4. running offsets over that small table, broadcast back;
5. global number = offset of the partition + position inside it.

The numbered table is checkpointed into ``spark.checkpoint.dir`` first, so the
count and the numbering see the same partitions and an executor loss does not
recompute a different range split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.session import checkpoint_root

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | row index


def global_row_number(df: DataFrame, order_cols: list[str], out_col: str = "row_no",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 0-based position of each row in the total order ``order_cols``.

    ``order_cols`` must make the order total (add a unique tiebreaker).
    """
    checkpoint_root(df.sparkSession)  # make sure a checkpoint dir is set
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), _POS_BITS)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the running sum is over a tiny table
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
         - F.col("_n")).alias("_offset"))
    local = F.col("_mid") - F.shiftleft(part, _POS_BITS)
    return (ranged.join(F.broadcast(offsets), part == F.col("_part"))
            .withColumn(out_col, F.col("_offset") + local)
            .drop("_mid", "_part", "_offset"))
