"""Data-quality operators for wide tables, written as ordinary Spark DataFrame plans."""
