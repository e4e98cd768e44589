"""Column-to-column helpers; all of them are native Spark expressions."""

from tenorlake.functions import dates, encode, numeric, text

__all__ = ["dates", "encode", "numeric", "text"]
