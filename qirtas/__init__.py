"""A Spark-first engine for building, linking and checking text corpora held as a property graph."""

__version__ = "0.1.0"
