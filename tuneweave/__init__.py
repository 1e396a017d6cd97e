"""tuneweave: preparation, packing, evaluation and run analytics for instruction tuning, on Spark."""

__version__ = "0.1.0"
