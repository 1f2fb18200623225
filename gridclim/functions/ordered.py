"""Order-dependent values over long sequences without one global window.

Rows are cut into buckets of consecutive order numbers. Windows run inside a
bucket; only one summary row per bucket is ordered globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialise

BUCKET_ROWS = 1_000_000


def _bucketed(df: DataFrame, order: str, rows: int) -> DataFrame:
    return df.withColumn("_bucket", F.floor(F.col(order) / F.lit(rows)))


def _before() -> Window:
    return (
        Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )


def previous(df: DataFrame, order: str, value: str, name: str, rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds the value of the row before in ``order``."""
    df = _bucketed(df, order, rows)
    ends = df.groupBy("_bucket").agg(F.max_by(value, order).alias("_end"))
    carried = ends.select("_bucket", F.last("_end").over(_before()).alias("_carried"))
    inside = Window.partitionBy("_bucket").orderBy(order)
    return (
        df.join(carried, "_bucket")
        .withColumn(
            name,
            F.when(F.row_number().over(inside) == 1, F.col("_carried")).otherwise(
                F.lag(value).over(inside)
            ),
        )
        .drop("_bucket", "_carried")
    )


def running_max(
    df: DataFrame,
    order: str,
    values: dict[str, tuple[Column, bool]],
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Adds, per name, the largest non-null value of the rows up to each row.

    ``values`` maps a name to a column and whether the row itself counts. All names
    share one pass.
    """
    df = _bucketed(df, order, rows).withColumns({f"_v_{n}": v for n, (v, _) in values.items()})
    tops = df.groupBy("_bucket").agg(*[F.max(f"_v_{n}").alias(f"_top_{n}") for n in values])
    carried = tops.select(
        "_bucket", *[F.max(f"_top_{n}").over(_before()).alias(f"_carried_{n}") for n in values]
    )
    inside = Window.partitionBy("_bucket").orderBy(order)

    def upto(name: str, own: bool) -> Column:
        frame = inside.rowsBetween(Window.unboundedPreceding, 0 if own else -1)
        return F.greatest(F.max(f"_v_{name}").over(frame), F.col(f"_carried_{name}"))

    helpers = [f"_{kind}_{n}" for n in values for kind in ("v", "carried")]
    return (
        df.join(carried, "_bucket")
        .withColumns({n: upto(n, own) for n, (_, own) in values.items()})
        .drop("_bucket", *helpers)
    )


def rank_within(df: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """Adds the 0-based rank of ``order`` in its group, and ``<name>_of``, the group size.

    Rows are range-partitioned by group and order, so a large group spreads over many
    tasks. Each task ranks its own rows; what lies ahead comes from one count per
    task and group. The partitioned rows are written once, so that both steps see the
    same task numbers.
    """
    parts = materialise(
        df.repartitionByRange(group, order).withColumn("_part", F.spark_partition_id())
    )
    sizes = parts.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    in_group = Window.partitionBy(group)
    before = in_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select(
        group,
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"),
        F.sum("_n").over(in_group).alias(f"{name}_of"),
    )
    inside = Window.partitionBy(group, "_part").orderBy(order)
    return (
        parts.withColumn("_row", F.row_number().over(inside) - 1)
        .join(ahead, [group, "_part"])
        .withColumn(name, F.col("_row") + F.col("_ahead"))
        .drop("_part", "_row", "_ahead")
    )
