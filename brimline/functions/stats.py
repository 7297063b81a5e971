"""Statistical expressions that Spark has no built-in for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brimline.session import scratch_path, settled

# Coefficients of algorithm AS 241 (PPND16, Wichura 1988) for the normal
# quantile, highest power first.
CENTRAL_NUM = [
    2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4,
    4.5921953931549871457e4, 1.3731693765509461125e4, 1.9715909503065514427e3,
    1.3314166789178437745e2, 3.3871328727963666080e0,
]
CENTRAL_DEN = [
    5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4,
    2.1213794301586595867e4, 5.3941960214247511077e3, 6.8718700749205790830e2,
    4.2313330701600911252e1, 1.0,
]
MIDDLE_NUM = [
    7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
    1.27045825245236838258e0, 3.64784832476320460504e0, 5.76949722146069140550e0,
    4.63033784615654529590e0, 1.42343711074968357734e0,
]
MIDDLE_DEN = [
    1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
    1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e0,
    2.05319162663775882187e0, 1.0,
]
TAIL_NUM = [
    2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
    2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e0,
    5.46378491116411436990e0, 6.65790464350110377720e0,
]
TAIL_DEN = [
    2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
    7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
    5.99832206555887937690e-1, 1.0,
]


def _poly(coefficients: list[float], x: Column) -> Column:
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + F.lit(c)
    return total


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function, as a JVM-side expression."""
    q = p - 0.5
    r = F.lit(0.180625) - q * q
    central = q * _poly(CENTRAL_NUM, r) / _poly(CENTRAL_DEN, r)
    s = F.sqrt(-F.log(F.least(p, 1.0 - p)))
    near, far = s - 1.6, s - 5.0
    tail = F.when(s <= 5.0, _poly(MIDDLE_NUM, near) / _poly(MIDDLE_DEN, near)).otherwise(
        _poly(TAIL_NUM, far) / _poly(TAIL_DEN, far)
    )
    outer = F.when(q < 0, -tail).otherwise(tail)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, central).otherwise(outer))


def grouped_quantiles(
    df: DataFrame, keys: list[str], value: str, quantiles: list[float], names: list[str],
    accuracy: int = 10_000,
) -> DataFrame:
    """Empirical quantiles (an observed value, rank ``ceil(q * n)``) per group, exact at any size.

    A mergeable sketch of bounded size comes first: each task reduces its own rows, and a
    group that holds a third of the data costs no more memory than any other. It is exact for
    groups of up to ``accuracy / 4`` rows. In larger ones it may be off by ``n / accuracy`` ranks
    (and one), so the values four such steps below and above are sketched as well; a second pass
    counts what lies below and ranks only the values in between. The sketches, one row per
    group, are written to the shared folder, and without large groups there is no second pass.
    """
    spark = df.sparkSession
    qs = [float(q) for q in quantiles]
    step = 4.0 / accuracy
    exact_rows = accuracy // 4
    around = [max(q - step, 0.0) for q in qs] + [min(q + step, 1.0) for q in qs]
    sketch = F.percentile_approx(value, [*qs, *around], accuracy)
    found = df.groupBy(*keys).agg(sketch.alias("_q"), F.count(value).alias("n_obs"))
    path = scratch_path(spark, "sketches")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    picked = [F.col("_q")[i].alias(n) for i, n in enumerate(names)]
    if found.filter(F.col("n_obs") > exact_rows).isEmpty():
        return found.select(*keys, *picked, "n_obs")
    small = found.filter(F.col("n_obs") <= exact_rows).select(*keys, *picked, "n_obs")
    k = len(qs)
    low = lambda i: F.lit(None).cast("double") if qs[i] - step <= 0 else F.col("_q")[k + i]
    high = lambda i: F.lit(None).cast("double") if qs[i] + step >= 1 else F.col("_q")[2 * k + i]
    marks = F.array(*[
        F.struct(F.lit(i).alias("i"), low(i).alias("low"), high(i).alias("high"), F.ceil(F.lit(q) * F.col("n_obs")).alias("rank"))
        for i, q in enumerate(qs)
    ])
    large = found.filter(F.col("n_obs") > exact_rows).select(*keys, marks.alias("_marks"))
    rows = df.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull()).join(large, keys)
    rows = rows.select(*keys, "_v", F.explode("_marks").alias("_m"))
    rows = rows.filter(F.col("_m.high").isNull() | (F.col("_v") <= F.col("_m.high")))
    # all that lies below counts as one value, so it is summed before the shuffle
    below = F.col("_v") < F.col("_m.low")
    counts = rows.groupBy(*keys, "_m", F.when(F.coalesce(below, F.lit(False)), None).otherwise(F.col("_v")).alias("_v"))
    counts = counts.agg(F.count(F.lit(1)).alias("_c"))
    order = Window.partitionBy(*keys, "_m.i").orderBy(F.col("_v").asc_nulls_first())
    counts = counts.withColumn("_upto", F.sum("_c").over(order))
    # the sketch promises that the rank lies past all below; a miss must not pass for a value
    missed = F.raise_error(F.lit("a sketch missed its bound: raise the accuracy")).cast("bigint")
    upto = F.when(F.col("_v").isNull() & (F.col("_upto") >= F.col("_m.rank")), missed).otherwise(F.col("_upto"))
    counts = counts.withColumn("_upto", upto)
    exact = counts.filter((F.col("_upto") >= F.col("_m.rank")) & F.col("_v").isNotNull())
    exact = exact.groupBy(*keys).agg(*[F.min(F.when(F.col("_m.i") == i, F.col("_v"))).alias(n) for i, n in enumerate(names)])
    exact = exact.join(found.select(*keys, "n_obs"), keys).select(*keys, *names, "n_obs")
    return small.unionByName(exact)


def global_rank(df: DataFrame, value: str, rank: str = "rank", buckets: int | None = None) -> DataFrame:
    """Ascending rank 1..n of every value over the whole frame, ties in any order, plus
    ``n``. NULLs are left out; only the value comes back.

    Equal values are counted first (one row per distinct value and task), so ties cannot
    overload a task. The distinct values are then dealt in order, one range per task, and
    written with it; a range adds up its own counts, and the totals of the ranges before it
    (one row each) say where it starts. No value is compared with any bound but by the sort.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    ranges = values.repartitionByRange(buckets, value).withColumn("_b", F.spark_partition_id())
    placed = settled(ranges, "value-ranges")
    sizes = placed.groupBy("_b").agg(F.sum("_c").alias("_s"))
    every = Window.orderBy("_b")  # over at most `buckets` rows
    starts = sizes.select(
        "_b",
        F.coalesce(F.sum("_s").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.sum("_s").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"),
    )
    inside = Window.partitionBy("_b").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.withColumn("_up_to", F.sum("_c").over(inside)).join(F.broadcast(starts), "_b")
    first = F.col("_start") + F.col("_up_to") - F.col("_c") + 1
    last = F.col("_start") + F.col("_up_to")
    # Copies of one value are written out in blocks, so no array grows with the ties.
    block = 10_000
    return (
        ranked.withColumns({"_first": first, "_last": last})
        .withColumn("_from", F.explode(F.sequence("_first", "_last", F.lit(block).cast("bigint"))))
        .withColumn(rank, F.explode(F.sequence("_from", F.least(F.col("_from") + F.lit(block - 1), F.col("_last")))))
        .select(value, rank, "n")
    )
