"""What the columns of a frame hold, by the role they play."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile(df: DataFrame, groups: dict[str, list[str]], by: Sequence[str] = ()) -> DataFrame:
    """``role, column, n_known, n_missing, mean, lowest, highest`` of every listed column.

    One aggregation for all columns, each worked out once though it may play several roles;
    its rows turn into one per role and column afterwards. NaN counts as missing. Columns that
    are not numbers have counts only. ``by`` splits the figures, by columns such as ``split``.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    columns = list(dict.fromkeys(c for names in groups.values() for c in names))
    if not columns:
        raise ValueError("no column to profile")

    def figures(c: str):
        value = F.col(f"`{c}`")
        number = isinstance(fields[c], (T.NumericType, T.BooleanType))
        if isinstance(fields[c], (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        of = value.cast("double") if number else F.lit(None).cast("double")
        return F.struct(
            F.count(value).alias("n_known"), (F.count(F.lit(1)) - F.count(value)).alias("n_missing"),
            F.avg(of).alias("mean"), F.min(of).alias("lowest"), F.max(of).alias("highest"),
        )

    out = df.groupBy(*by).agg(*[figures(c).alias(f"_f{i}") for i, c in enumerate(columns)])
    rows = [
        F.struct(F.lit(role).alias("role"), F.lit(c).alias("column"), F.col(f"_f{columns.index(c)}").alias("f"))
        for role, names in groups.items() for c in names
    ]
    out = out.select(*by, F.explode(F.array(*rows)).alias("_r"))
    return out.select(*by, "_r.role", "_r.column", "_r.f.*")
