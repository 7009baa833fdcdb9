"""Profiles, audits and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.numbers import half_even, joined_key, normal_cdf
from ..functions.times import hour_stamp
from ..schema import Contract
from ..session import scratch_path
from .ordering import sample_rows
from .quantiles import exact_quantiles


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column_name, nulls, total, null_pct), one pass."""
    cols = cols or df.columns
    one = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count(c).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col("_total") - F.col(c)).alias("nulls")) for c in cols])
    pct = F.when(F.col("total") > 0, half_even(F.col("nulls") / F.col("total") * 100.0, 2))
    return one.select(F.inline(rows), F.col("_total").alias("total")).withColumn("null_pct", pct)


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def column_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Counts, distinct values, NULLs, blanks, most and least frequent value,
    and for numbers mean, deviation, extremes and quartiles.

    Everything about frequencies comes from one count of (column, value)
    pairs, combined before the shuffle, so a value that fills a third of a
    column is one row per task. Frequency ties go to the lowest text.
    """
    cols = cols or df.columns
    kinds = {f.name: f.dataType for f in df.schema}
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]
    )
    counts = df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    most = F.when(known, F.struct((-F.col("n")).alias("o"), F.col("value")))
    least = F.when(known, F.struct(F.col("n").alias("o"), F.col("value")))
    text = counts.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("total_count"),
        F.count("value").alias("unique_count"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_count"),
        F.coalesce(F.sum(F.when(F.col("value") == "", F.col("n"))), F.lit(0)).alias("blank_count"),
        F.min(most).alias("_most"),
        F.min(least).alias("_least"),
    )
    text = text.select(
        "column_name",
        "total_count",
        "unique_count",
        "null_count",
        "blank_count",
        F.col("_most.value").alias("top_value"),
        (-F.col("_most.o")).alias("top_count"),
        F.col("_least.value").alias("rare_value"),
        F.col("_least.o").alias("rare_count"),
    )
    types = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(kinds[c].simpleString()))])
    text = text.withColumn("data_type", types[F.col("column_name")])
    numbers = [c for c in cols if _is_number(kinds[c])]
    if not numbers:
        empty = {k: F.lit(None).cast("double") for k in ("mean", "std", "min", "q1", "median", "q3", "max")}
        return text.withColumns(empty)
    described = describe_numeric(df, numbers).select(
        "column_name",
        F.round("mean", 3).alias("mean"),
        F.round("std", 3).alias("std"),
        "min",
        "q1",
        "median",
        "q3",
        "max",
    )
    # One row per column on both sides.
    return text.join(F.broadcast(described), "column_name", "left")


def null_rate_by(df: DataFrame, group: str, col: str) -> DataFrame:
    """Share of NULLs per group, highest first."""
    return (
        df.groupBy(group)
        .agg(F.avg(F.col(col).isNull().cast("double")).alias("ratio"), F.count(F.lit(1)).alias("count"))
        .where(F.col("ratio") > 0)
        .orderBy(F.col("ratio").desc(), group)
    )


def freq_of_freq(df: DataFrame, key: str | list[str]) -> DataFrame:
    """How many keys have how many rows."""
    keys = [key] if isinstance(key, str) else key
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    return per_key.groupBy("times").agg(F.count(F.lit(1)).alias("keys"))


def weighted_mean_times(frequencies: DataFrame) -> DataFrame:
    return frequencies.agg((F.sum(F.col("times") * F.col("keys")) / F.sum("keys")).alias("mean_times"))


def hourly(df: DataFrame, ts: str, users: str, distance: str, time: str) -> DataFrame:
    return df.groupBy(hour_stamp(F.col(ts)).alias("hour")).agg(
        F.sum(users).alias("users"), F.avg(distance).alias("distance_avg"), F.avg(time).alias("time_avg")
    )


def resample_counts(df: DataFrame, ts: str, width: str = "30 minutes") -> DataFrame:
    """Rows per time bin from the first to the last used bin, empty bins as 0."""
    counts = df.where(F.col(ts).isNotNull()).groupBy(F.window(ts, width).start.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    span = counts.agg(F.min("bin").alias("lo"), F.max("bin").alias("hi"))
    bins = span.select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {width}"))).alias("bin"))
    return bins.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


# Distance bins (left-closed) and their labels.
DISTANCE_EDGES = [0, 100, 200, 300, 400, 500, 600, 700, 800, 900, 1000, 2000, 5000, 1000000]
DISTANCE_LABELS = [
    "0~100",
    "100~200",
    "200~300",
    "300~400",
    "400~500",
    "500~600",
    "600~700",
    "700~800",
    "800~900",
    "900~1000",
    "1000~2000",
    "2000~5000",
    "5000~",
]


def bin_of(value: Column, edges: list[float] = DISTANCE_EDGES, labels: list[str] = DISTANCE_LABELS) -> Column:
    """Label of the left-closed bin; NULL outside all bins."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one label per bin")
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        test = (value >= low) & (value < high)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out


def bin_counts(
    df: DataFrame, col: str, edges: list[float] = DISTANCE_EDGES, labels: list[str] = DISTANCE_LABELS
) -> DataFrame:
    """Rows per bin, empty bins as 0; out-of-range and NULL under no label."""
    binned = df.groupBy(bin_of(F.col(col), edges, labels).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # As many rows as there are labels.
    all_bins = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in labels])).alias("bin"))
    filled = all_bins.join(F.broadcast(binned.where(F.col("bin").isNotNull())), "bin", "left").select(
        "bin", F.coalesce("n", F.lit(0)).alias("n")
    )
    return filled.unionByName(binned.where(F.col("bin").isNull()))


def day_span(df: DataFrame, keys: list[str]) -> DataFrame:
    """First alighting and last boarding."""
    return df.groupBy(*keys).agg(F.min("alight_ts").alias("first_alight"), F.max("board_ts").alias("last_board"))


def hour_crosstab(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hour of first alighting by hour of last boarding, 0-filled."""
    spans = day_span(df, keys).select(F.hour("first_alight").alias("arrival_hour"), F.hour("last_board").alias("h"))
    cells = [F.count(F.when(F.col("h") == h, 1)).alias(f"h{h:02d}") for h in range(24)]
    return spans.groupBy("arrival_hour").agg(*cells)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of those keys; NULL parts are equal to each other."""
    twice = duplicate_keys(df, keys).select(*[F.col(k).alias(f"_d_{k}") for k in keys], "copies")
    cond = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"_d_{k}"))
        cond = test if cond is None else cond & test
    return df.join(twice, cond).select(*df.columns, "copies")


def with_pk(df: DataFrame, cols: list[str], sep: str = "_", name: str = "pk") -> DataFrame:
    return df.withColumn(name, joined_key([F.col(c) for c in cols], sep))


def length_profile(df: DataFrame, col: str) -> DataFrame:
    """Rows per text length."""
    return df.groupBy(F.length(F.col(col)).alias("len")).agg(F.count(F.lit(1)).alias("n"))


def length_range(df: DataFrame, col: str) -> DataFrame:
    size = F.length(F.col(col))
    return df.agg(F.min(size).alias("min_len"), F.max(size).alias("max_len"))


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, deviation, five-number summary and 1.5 IQR fences."""
    one = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(f"_{i}")
            for i, c in enumerate(cols)
        ]
    )
    basics = one.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(cols))])))
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
    quartiles = (
        exact_quantiles(df, cols, [0.25, 0.5, 0.75])
        .groupBy(F.col("measure").alias("column_name"))
        .agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    )
    iqr = F.col("q3") - F.col("q1")
    # One row per column on both sides.
    return (
        basics.join(F.broadcast(quartiles), "column_name", "left")
        .withColumn("fence_low", F.col("q1") - iqr * 1.5)
        .withColumn("fence_high", F.col("q3") + iqr * 1.5)
    )


def empirical_steps(values: DataFrame, parts: int | None = None) -> DataFrame:
    """(v, before, upto): for each distinct value, how many rows are smaller and how many are not larger.

    Values are counted, dealt by ranges and numbered in each range; what stands before a range is added from a row per
    range. No task sees more than a range.
    """
    counted = values.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    path = scratch_path(values.sparkSession, "steps")
    dealt = counted.repartitionByRange(*([parts] if parts else []), "v").withColumn("_part", F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = values.sparkSession.read.parquet(path)
    # One row per range.
    starts = dealt.groupBy("_part").agg(F.sum("c").alias("_n"))
    starts = starts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))
    within = F.sum("c").over(Window.partitionBy("_part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return dealt.withColumn("_upto", within).join(F.broadcast(starts), "_part").select(
        "v", (F.col("_start") + F.col("_upto") - F.col("c")).alias("before"), (F.col("_start") + F.col("_upto")).alias("upto")
    )


def kolmogorov_p(t: Column) -> Column:
    """Chance of a Kolmogorov statistic of at least ``t`` in a large sample, by its alternating series."""
    terms = [(2.0 if k % 2 else -2.0) * F.exp(F.lit(-2.0 * k * k) * t * t) for k in range(1, 41)]
    # Below 0.3 the chance differs from one by less than 10 ** -5.
    return F.when(t < 0.3, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), sum(terms[1:], terms[0]))))


def ks_normal(df: DataFrame, col: str, fraction: float = 1.0, seed: int = 42, keys: list[str] = (), parts: int | None = None) -> DataFrame:
    """Kolmogorov-Smirnov test of a sample against the normal fitted to it, with the large-sample p-value.

    A ``fraction`` below one is drawn by a seeded hash of ``keys``: the same rows in every run and layout. Unknown values
    don't count. A sample that has no spread gives an error.
    """
    known = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    sample = known if fraction >= 1.0 else sample_rows(known, fraction, seed, list(keys))
    steps = empirical_steps(sample.select(F.col(col).cast("double").alias("v")), parts)
    path = scratch_path(df.sparkSession, "empirical")
    steps.write.parquet(path)
    steps = df.sparkSession.read.parquet(path)
    times = F.col("upto") - F.col("before")
    n, mean = steps.agg(F.sum(times), F.sum(F.col("v") * times) / F.sum(times)).first()
    off = steps.agg(F.sum((F.col("v") - F.lit(mean)) * (F.col("v") - F.lit(mean)) * times)).first()[0] if n else None
    if not n or n < 2 or not off:
        raise ValueError(f"{col}: too few distinct values to fit a normal")
    std = (off / (n - 1)) ** 0.5
    share = normal_cdf((F.col("v") - F.lit(mean)) / F.lit(std))
    found = steps.agg(F.max(F.greatest(F.col("upto") / F.lit(n) - share, share - F.col("before") / F.lit(n))).alias("statistic"))
    p = kolmogorov_p(F.col("statistic") * F.lit(float(n) ** 0.5))
    return found.select(
        F.lit(col).alias("column_name"),
        F.lit(n).cast("bigint").alias("n"),
        F.lit(mean).alias("mean"),
        F.lit(std).alias("std"),
        "statistic",
        p.alias("p_value"),
    ).withColumn("is_normal", F.col("p_value") > 0.05)


def funnel(stages: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows and distinct keys of each stage, in the given order, with the
    share of the first stage."""
    out = None
    for i, (name, df) in enumerate(stages.items()):
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("keys")).select(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), "rows", "keys"
        )
        out = one if out is None else out.unionByName(one)
    # One row per stage, so a window over all of them is small.
    first = F.first("rows").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    pct = F.when(first > 0, half_even(F.col("rows") / first * 100.0, 2))
    return out.withColumn("pct_of_first", pct)


def key_diff(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """Distinct keys on each side and how many exist only there."""
    left = a.where(F.col(a_key).isNotNull()).select(F.col(a_key).alias("k"), F.lit(1).alias("in_a"), F.lit(0).alias("in_b"))
    right = b.where(F.col(b_key).isNotNull()).select(F.col(b_key).alias("k"), F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    sides = left.unionByName(right).groupBy("k").agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return sides.agg(
        F.sum("in_a").alias("a_keys"),
        F.sum("in_b").alias("b_keys"),
        F.count(F.when(F.col("in_b") == 0, 1)).alias("only_a"),
        F.count(F.when(F.col("in_a") == 0, 1)).alias("only_b"),
    )


def rows_without(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """Rows of ``a`` whose key does not exist in ``b``."""
    known = b.select(F.col(b_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    return a.where(F.col(a_key).isNotNull()).join(known, F.col(a_key) == F.col("_k"), "left_anti")


def validate_target(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, column_name, violations) for every rule of a load contract."""
    tests: list[tuple[str, str, Column]] = []
    tests += [("not_null", c, F.col(c).isNull()) for c in contract.required]
    tests += [("length", c, F.length(F.col(c)) > size) for c, size in contract.lengths.items()]
    for c, (precision, scale) in contract.numerics.items():
        limit = float(10 ** (precision - scale))
        tests.append(("numeric", c, F.abs(F.round(F.col(c).cast("double"), scale)) >= limit))
    one = df.agg(*[F.count(F.when(test, 1)).alias(f"_{i}") for i, (_, _, test) in enumerate(tests)])
    rows = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column_name"), F.col(f"_{i}").alias("violations"))
            for i, (rule, c, _) in enumerate(tests)
        ]
    )
    found = one.select(F.inline(rows))
    if contract.key:
        twice = duplicate_keys(df, list(contract.key)).agg(F.count(F.lit(1)).alias("violations"))
        found = found.unionByName(
            twice.select(F.lit("unique_key").alias("rule"), F.lit(",".join(contract.key)).alias("column_name"), "violations")
        )
    return found


def to_target_types(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast measures to the target's NUMERIC types."""
    return df.withColumns(
        {c: F.col(c).cast(T.DecimalType(p, s)) for c, (p, s) in contract.numerics.items()}
    )
