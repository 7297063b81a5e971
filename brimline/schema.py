"""Names, types and column groups of the gauge panel.

Column-group membership is always "every listed column that exists", resolved from
``df.columns`` at plan time; no job runs for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values: names that input and output files must carry -------------------
SITE = "site_id"
TIME = "timestamp"
TARGET = "muc_thuong_luu"

RAW_TO_PANEL = {
    "ten_ho": "site_id",
    "muc_nuoc_thuong_luu": "muc_thuong_luu",
    "muc_nuoc_dang_binh_thuong": "muc_dang_binh_thuong",
    "muc_nuoc_chet": "muc_chet",
    "luu_luong_den_ho": "luu_luong_den",
    "tong_luong_xa": "tong_luong_xa",
    "tong_luong_xa_qua_dap_tran": "xa_tran",
    "tong_luong_xa_qua_nha_may": "xa_nha_may",
    "so_cua_xa_sau": "so_cua_xa_sau",
    "so_cua_xa_mat": "so_cua_xa_mat",
}
RAW_COLUMNS = [
    "ten_ho", "timestamp", "muc_nuoc_thuong_luu", "muc_nuoc_dang_binh_thuong",
    "muc_nuoc_chet", "luu_luong_den_ho", "tong_luong_xa", "tong_luong_xa_qua_dap_tran",
    "tong_luong_xa_qua_nha_may", "so_cua_xa_sau", "so_cua_xa_mat",
]
FLOAT_COLUMNS = [
    "muc_thuong_luu", "muc_dang_binh_thuong", "muc_chet", "luu_luong_den",
    "tong_luong_xa", "xa_tran", "xa_nha_may",
]
GATE_COLUMNS = ["so_cua_xa_sau", "so_cua_xa_mat"]
PANEL_COLUMNS = [TIME, SITE, *FLOAT_COLUMNS, *GATE_COLUMNS]
OPTIONAL_COVARIATES = ["rain_forecast_mm", "planned_release_m3s"]

OBSERVED = [
    "muc_thuong_luu", "luu_luong_den", "tong_luong_xa", "xa_tran", "xa_nha_may",
    "so_cua_xa_sau", "so_cua_xa_mat", "was_imputed",
]
KNOWN_FUTURE = [
    "rain_forecast_mm", "planned_release_m3s", "hour_sin", "hour_cos", "dow_sin",
    "dow_cos", "doy_sin", "doy_cos", "is_weekend",
]
STATIC_REAL = ["muc_dang_binh_thuong", "muc_chet"]

TIMEZONE = "Asia/Bangkok"
FREQUENCY = "1H"
ENCODER_STEPS = 168
DECODER_STEPS = 336
QUANTILES = [0.1, 0.5, 0.9]
LAGS = [1, 3, 6, 24, 48, 168]
ROLL_WINDOWS = [3, 12, 24, 168]
ROLL_STATS = ["mean", "std"]
TRAIN_RATIO = 0.7
VAL_RATIO = 0.15
# --- end of fixed values ---------------------------------------------------------

# Columns that a regular panel carries besides the data (see operators/grid.py).
POSITION = "time_idx"
LENGTH = "series_len"

RAW_RECORD = T.StructType(
    [T.StructField(c, T.StringType()) for c in RAW_COLUMNS[:2]]
    + [T.StructField(c, T.DoubleType()) for c in RAW_COLUMNS[2:9]]
    + [T.StructField(c, T.IntegerType()) for c in RAW_COLUMNS[9:]]
)
PANEL = T.StructType(
    [T.StructField(TIME, T.TimestampType()), T.StructField(SITE, T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in FLOAT_COLUMNS]
    + [T.StructField(c, T.LongType()) for c in GATE_COLUMNS]
)


def present(df: DataFrame, names: list[str]) -> list[str]:
    """The listed columns that exist in ``df``, in list order."""
    return [c for c in names if c in df.columns]


def require(df: DataFrame, *names: str) -> None:
    """Plan-time check that columns exist."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")


def scaler_groups(df: DataFrame) -> dict[str, list[str]]:
    """Column groups that are standardised, empty groups left out."""
    groups = {"obs": OBSERVED, "static": STATIC_REAL, "known": KNOWN_FUTURE}
    found = {name: present(df, cols) for name, cols in groups.items()}
    return {name: cols for name, cols in found.items() if cols}


def column_groups(df: DataFrame, target: str = TARGET) -> dict[str, list[str]]:
    """Roles of the columns of a feature frame.

    ``unknown`` is everything not known ahead: the target, the observed columns and the
    lag and rolling columns found by prefix; sorted and distinct.
    """
    derived = [c for c in df.columns if c.startswith((f"{target}_lag_", f"{target}_rolling_"))]
    return {
        "static_categoricals": present(df, [SITE]),
        "static_reals": present(df, STATIC_REAL),
        "known": present(df, KNOWN_FUTURE),
        "unknown": sorted({target, *present(df, OBSERVED), *derived}),
        "derived": derived,
    }


def feature_manifest(
    df: DataFrame,
    enc_len: int = ENCODER_STEPS,
    dec_len: int = DECODER_STEPS,
    frequency: str = FREQUENCY,
    timezone: str = TIMEZONE,
    quantiles: list[float] = QUANTILES,
) -> dict:
    """Description of a prepared panel; lists only columns that are present."""
    return {
        "enc_len": enc_len,
        "dec_len": dec_len,
        "frequency": frequency,
        "timezone": timezone,
        "quantiles": list(quantiles),
        "features": {
            "continuous_obs": present(df, OBSERVED),
            "known_future": present(df, KNOWN_FUTURE),
            "static_real": present(df, STATIC_REAL),
        },
    }
