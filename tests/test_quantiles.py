import math
import random

from brimline.functions.stats import grouped_quantiles


def test_quantiles_are_exact_ranks_at_any_size(spark):
    r = random.Random(4)
    data = {
        "small": [r.gauss(0, 1) for _ in range(9_999)], "mid": [float(r.randint(0, 50)) for _ in range(20_000)],
        "large": [r.gauss(0, 1) for _ in range(400_000)], "one": [1.0],
        **{f"n{n}": [r.random() for _ in range(n)] for n in (99, 2_499, 2_500, 2_501, 5_000, 10_001)}, "ties": [3.0] * 30_000,
    }
    rows = [(k, v) for k, vs in data.items() for v in vs] + [("large", None), ("none", None)]
    import pandas as pd

    df = spark.createDataFrame(pd.DataFrame(rows, columns=["g", "v"]).sample(frac=1, random_state=1)).selectExpr("g", "nullif(v, 'NaN') as v")
    qs = [0.0001, 0.1, 0.25, 0.5, 0.9, 0.9999]
    got = {x.g: x for x in grouped_quantiles(df, ["g"], "v", qs, [f"q{i}" for i in range(len(qs))]).collect()}
    for k, vs in data.items():
        vs = sorted(vs)
        assert [got[k][f"q{i}"] for i in range(len(qs))] == [vs[max(1, math.ceil(q * len(vs))) - 1] for q in qs], k
        assert got[k].n_obs == len(vs)
