"""Spark-native analytics for labelled 3-D volumes and the graphs behind them."""

__version__ = "0.1.0"
