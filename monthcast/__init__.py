"""monthcast: monthly market-signal features, labels and forecasts on Spark."""

__version__ = "0.1.0"
