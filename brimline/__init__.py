"""Tables of time series on Spark, from raw files to scored forecasts."""
