"""lumenset: dataset curation over one wide manifest DataFrame, on Spark."""

__version__ = "0.1.0"
