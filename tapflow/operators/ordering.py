"""Order-dependent operators: first of a group, neighbour rows, n-th row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_path


# A card's trips in a total order: copies of a leg share time and transaction.
TRIP_ORDER = ["board_ts", "txn_id", "op_date", "alight_ts", "board_stop", "alight_stop"]


def dedup(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by an explicit order.

    ``row_number() = 1`` lets Spark keep one row per key and task before the
    shuffle, so a key with many copies costs no more than any other. That sorts
    all rows of a task, so they are dealt evenly first: a small file can hold
    millions of rows, which one task reads.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    dealt = df.hint("rebalance", *[F.col(c) for c in dict.fromkeys([*keys, *order])])
    return dealt.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _listed(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def nth_row(df: DataFrame, key: str | list[str], order: list[str], n: int) -> DataFrame:
    """The n-th row of each key (1 is the first)."""
    w = Window.partitionBy(*_listed(key)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == n).drop("_rn")


def nth_trip(df: DataFrame, n: int, key: str | list[str] = "card_id") -> DataFrame:
    """The n-th trip in the order of all columns of TRIP_ORDER that there are: copies of a boarding can't trade places."""
    return nth_row(df, key, [c for c in TRIP_ORDER if c in df.columns], n)


def cards_with(
    df: DataFrame, k: int, key: str | list[str] = "card_id", order: tuple[str, ...] = ("board_ts", "txn_id")
) -> DataFrame:
    """All rows of the keys that have exactly ``k`` rows, numbered in ``trip_no``.

    Only the first ``k + 1`` rows of a key leave a map task, enough to tell
    ``k`` from more.
    """
    w = Window.partitionBy(*_listed(key)).orderBy(*order)
    head = df.withColumn("trip_no", F.row_number().over(w)).where(F.col("trip_no") <= k + 1)
    full = Window.partitionBy(*_listed(key))
    return head.withColumn("_n", F.count(F.lit(1)).over(full)).where(F.col("_n") == k).drop("_n")


def dealt_in_order(df: DataFrame, key: str, order: list[str], parts: int | None = None) -> DataFrame:
    """``df`` stored in ranges of (``key``, ``order``), with the number of each row's range in ``_part``.

    Ranges are cut by sampled bounds, so a key with a third of all rows, NULL among them, or one with a busy second
    is spread like any other rows.
    """
    columns = [F.col(c) for c in [key, *order]]
    dealt = df.repartitionByRange(*([parts] if parts else []), *columns)
    path = scratch_path(df.sparkSession, "in-order")
    dealt.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_neighbour(
    df: DataFrame, key: str, order: list[str], carried: dict[str, str], step: int, parts: int | None = None
) -> DataFrame:
    """Columns of the next (``step=1``) or previous (``step=-1``) row of a key.

    ``carried`` maps a new column to the column it is taken from. The input is read once and stored in ranges of
    (``key``, ``order``); each range of a key is ordered on its own, and one boundary row brings in the first (or
    last) row of the key's neighbouring range, so no task sees the whole key and the result equals the plain
    window. NULL is a key like any other.
    """
    if step not in (1, -1):
        raise ValueError("step is 1 or -1")
    names = df.columns
    dealt = dealt_in_order(df, key, order, parts)
    edge, move = (F.min, F.lead) if step == 1 else (F.max, F.lag)
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_v{i}") for i, c in enumerate(carried.values())])
    # One row per key and range: a key has as many as ranges that it reaches into.
    edges = (
        dealt.groupBy(key, "_part")
        .agg(edge(packed).alias("_edge"))
        .withColumn("_edge", move("_edge").over(Window.partitionBy(key).orderBy("_part")))
        .where(F.col("_edge").isNotNull())
    )
    values = {f"_v{i}": F.col(c) for i, c in enumerate(carried.values())}
    boundary = edges.select(
        key, "_part", F.lit(step).alias("_at"), *[F.col(f"_edge._v{i}").alias(f"_v{i}") for i in range(len(carried))]
    )
    w = Window.partitionBy(key, "_part").orderBy("_at", *order)
    moved = dealt.withColumns({**values, "_at": F.lit(0)}).unionByName(boundary, allowMissingColumns=True).withColumns(
        {name: move(f"_v{i}").over(w) for i, name in enumerate(carried)}
    )
    return moved.where(F.col("_at") == 0).select(*names, *carried)


def with_next_trip(trips: DataFrame, extra: list[str] = (), parts: int | None = None) -> DataFrame:
    """Boarding attributes of the card's next trip (``next_*``)."""
    carried = {f"next_{c}": c for c in ["board_stop", "board_ts", "board_region", "board_mode", *extra]}
    return with_neighbour(trips, "card_id", TRIP_ORDER, carried, 1, parts)


def with_prev_trip(trips: DataFrame, parts: int | None = None) -> DataFrame:
    """Alighting attributes of the card's previous trip (``prev_*``)."""
    carried = {f"prev_{c}": c for c in ["alight_stop", "alight_ts", "alight_region", "alight_mode"]}
    return with_neighbour(trips, "card_id", TRIP_ORDER, carried, -1, parts)


def head(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def sample_cards(taps: DataFrame, n: int, seed: int, key: str = "card_id") -> DataFrame:
    """All taps of ``n`` random cards; the draw is a seeded hash order, so it
    repeats exactly."""
    draw = F.md5(F.concat(F.col(key), F.lit(f":{seed}")))
    cards = taps.where(F.col(key).isNotNull()).select(key).distinct().orderBy(draw, key).limit(n)
    return taps.join(cards, key, "left_semi")


def drawn(keys: list[str], fraction: float, seed: int) -> Column:
    """Whether a seeded hash of a row's keys falls below ``fraction``: the same rows in every run and layout."""
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") < int(fraction * 2**32)


def sample_rows(df: DataFrame, fraction: float, seed: int, keys: list[str]) -> DataFrame:
    """About ``fraction`` of the rows, drawn by their keys."""
    return df.where(drawn(keys, fraction, seed))
