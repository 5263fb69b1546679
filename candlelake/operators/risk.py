"""Covariance and correlation of the aligned returns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SYMBOLS_PER_BLOCK = 200


def return_vectors(returns: DataFrame) -> DataFrame:
    """One row per symbol with its mean-centred returns in date order.

    A vector has at most ``lookback`` entries because the panel is cut to that
    many dates, and all vectors share the same dates.
    """
    ordered = F.transform(
        F.sort_array(F.collect_list(F.struct("date", "ret"))), lambda p: p["ret"]
    )
    rows = returns.groupBy("symbol", "ord").agg(
        ordered.alias("rets"), F.avg("ret").alias("mean_return")
    )
    centred = rows.withColumn("dev", F.transform("rets", lambda r: r - F.col("mean_return")))
    squares = F.aggregate("dev", F.lit(0.0), lambda acc, d: acc + d * d)
    return centred.select(
        "symbol",
        "ord",
        "mean_return",
        "dev",
        F.size("dev").alias("n"),
        (squares / F.nullif(F.size("dev") - 1, F.lit(0))).alias("variance"),
    )


def upper_matrix(returns: DataFrame, symbols_per_block: int = SYMBOLS_PER_BLOCK) -> DataFrame:
    """Covariance and correlation of the symbol pairs ``ord_x <= ord_y``.

    Each output row is formed from two vectors, so the join emits exactly the
    matrix cells and not one row per cell and date. The cells are grouped into
    blocks: a symbol is sent once to each block row and column it belongs to,
    and the join is an equi-join on the block. The number of blocks grows with
    the number of symbols, so a join key always stands for at most
    ``symbols_per_block`` symbols on either side.
    """
    last_ord = returns.agg(F.max("ord")).scalar()
    blocks = F.floor(last_ord / symbols_per_block).cast("int") + 1
    vectors = (
        return_vectors(returns)
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod("ord", F.col("blocks")))
    )

    def side(name: str) -> DataFrame:
        return vectors.select(
            *[F.col(c).alias(f"{c}_{name}") for c in ("symbol", "ord", "mean_return", "dev", "variance")],
            "n",
            "blocks",
            F.col("block").alias(f"block_{name}"),
        )

    left = side("x").withColumn("block_y", F.explode(F.sequence("block_x", F.col("blocks") - 1)))
    right = side("y").drop("n", "blocks").withColumn(
        "block_x", F.explode(F.sequence(F.lit(0), "block_y"))
    )
    cells = left.join(right, ["block_x", "block_y"]).where(
        (F.col("block_x") < F.col("block_y")) | (F.col("ord_x") <= F.col("ord_y"))
    )
    product = F.aggregate(
        F.zip_with("dev_x", "dev_y", lambda a, b: a * b), F.lit(0.0), lambda acc, p: acc + p
    )
    too_short = F.raise_error(F.lit("covariance needs at least two returns")).cast("double")
    covariance = F.when(F.col("n") > 1, product / (F.col("n") - 1)).otherwise(too_short)
    spread = F.sqrt("variance_x") * F.sqrt("variance_y")
    correlation = (
        F.when(F.col("ord_x") == F.col("ord_y"), 1.0)
        .when((F.col("variance_x") > 0) & (F.col("variance_y") > 0), F.col("covariance") / spread)
        .otherwise(0.0)
    )
    wide = cells.withColumn("covariance", covariance).withColumn("correlation", correlation)
    # cells of two different blocks may come with ord_x > ord_y; put the lower first
    swap = F.col("ord_x") > F.col("ord_y")
    ordered = [
        F.when(swap, F.col(f"{c}_{b}")).otherwise(F.col(f"{c}_{a}")).alias(f"{c}_{a}")
        for c in ("symbol", "ord", "mean_return")
        for a, b in (("x", "y"), ("y", "x"))
    ]
    return wide.select(*ordered, "covariance", "correlation")


# dates whose products are summed in one row: wide enough to save rows, narrow enough for compiled code
DATES_PER_BLOCK = 32


def _date_blocks(returns: DataFrame) -> DataFrame:
    """``symbol, ord, at, d0, d1, ...``: a row per symbol and block of dates, with mean-centred returns by the date's place in its block.

    The calendar of common dates has at most ``lookback`` rows, so it is numbered in one task.
    """
    calendar = returns.select("date").distinct().withColumn("place", F.row_number().over(W.orderBy("date")) - 1)
    means = returns.groupBy("ord").agg(F.avg("ret").alias("mean_return"))
    centred = returns.join(calendar, "date").join(means, "ord").select(
        "symbol",
        "ord",
        F.floor(F.col("place") / DATES_PER_BLOCK).cast("int").alias("at"),
        (F.col("place") % DATES_PER_BLOCK).alias("slot"),
        (F.col("ret") - F.col("mean_return")).alias("dev"),
    )
    slots = [F.sum(F.when(F.col("slot") == k, F.col("dev")).otherwise(0.0)).alias(f"d{k}") for k in range(DATES_PER_BLOCK)]
    return centred.groupBy("symbol", "ord", "at").agg(*slots)


def gram_matrix(returns: DataFrame, symbols_per_block: int = SYMBOLS_PER_BLOCK) -> DataFrame:
    """As ``upper_matrix``, for many symbols: a blocked product of the returns with themselves.

    A cell is the sum of one number per block of dates, and that number is one compiled expression over plain columns. The join is by block of
    dates and by blocks of symbols, so a key stands for at most ``symbols_per_block`` rows on either side; partial sums are combined before
    they are shuffled.
    """
    last_ord = returns.agg(F.max("ord")).scalar()
    blocks = F.floor(last_ord / symbols_per_block).cast("int") + 1
    rows = _date_blocks(returns).withColumn("blocks", blocks).withColumn("block", F.pmod("ord", F.col("blocks")))
    days = [f"d{k}" for k in range(DATES_PER_BLOCK)]

    def side(name: str) -> DataFrame:
        named = [F.col(c).alias(f"{c}_{name}") for c in ("ord", *days)]
        return rows.select("at", "blocks", F.col("block").alias(f"block_{name}"), *named)

    left = side("x").withColumn("block_y", F.explode(F.sequence("block_x", F.col("blocks") - 1))).drop("blocks")
    right = side("y").drop("blocks").withColumn("block_x", F.explode(F.sequence(F.lit(0), "block_y")))
    cells = left.join(right, ["at", "block_x", "block_y"]).where((F.col("block_x") < F.col("block_y")) | (F.col("ord_x") <= F.col("ord_y")))
    part = reduce(Column.__add__, (F.col(f"{d}_x") * F.col(f"{d}_y") for d in days))
    # cells of two different blocks may come with ord_x > ord_y
    sums = cells.groupBy(F.least("ord_x", "ord_y").alias("ord_x"), F.greatest("ord_x", "ord_y").alias("ord_y")).agg(F.sum(part).alias("product"))
    stats = returns.groupBy("symbol", "ord").agg(F.avg("ret").alias("mean_return"), F.count("ret").alias("n"), F.var_samp("ret").alias("variance"))

    def of(name: str) -> DataFrame:
        return stats.select(*(F.col(c).alias(f"{c}_{name}") for c in stats.columns))

    too_short = F.raise_error(F.lit("covariance needs at least two returns")).cast("double")
    both = sums.join(of("x"), "ord_x").join(of("y"), "ord_y")
    covariance = F.when(F.col("n_x") > 1, F.col("product") / (F.col("n_x") - 1)).otherwise(too_short)
    spread = F.sqrt("variance_x") * F.sqrt("variance_y")
    correlation = (
        F.when(F.col("ord_x") == F.col("ord_y"), 1.0)
        .when((F.col("variance_x") > 0) & (F.col("variance_y") > 0), F.col("covariance") / spread)
        .otherwise(0.0)
    )
    names = [f"{c}_{side_}" for c in ("symbol", "ord", "mean_return") for side_ in ("x", "y")]
    return both.withColumn("covariance", covariance).withColumn("correlation", correlation).select(*names, "covariance", "correlation")


def full_matrix(upper: DataFrame) -> DataFrame:
    """All ordered pairs: every cell of the upper half and, off the diagonal, its mirror image."""
    def cell(a: str, b: str) -> Column:
        return F.struct(
            *[
                F.col(f"{c}_{side}").alias(f"{c}_{name}")
                for c in ("symbol", "ord", "mean_return")
                for name, side in (("x", a), ("y", b))
            ]
        )

    mirrored = F.when(F.col("ord_x") < F.col("ord_y"), cell("y", "x"))
    both = F.array_compact(F.array(cell("x", "y"), mirrored))
    return upper.select(F.inline(both), "covariance", "correlation")
