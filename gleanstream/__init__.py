"""Web-listing pipeline on Spark: extract, encode, log, decode, store, publish."""

__version__ = "0.1.0"
