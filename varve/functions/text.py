"""String expressions of the link parser and the word hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the djb2 hash, kept to 32 bits.
DJB2_START = 5381
DJB2_FACTOR = 33
DJB2_MODULUS = 4294967296

# Fixed values of the link format: the one namespace kept, and its separator.
KEPT_NAMESPACE = "category:"
NAMESPACE_MARK = ":"


def djb2(key: Column) -> Column:
    """32-bit djb2 over the code points of ``key``."""
    letters = F.filter(F.split(key, ""), lambda letter: letter != "")
    return F.aggregate(
        letters,
        F.lit(DJB2_START).cast("bigint"),
        lambda h, letter: (h * DJB2_FACTOR + F.ascii(letter)) % DJB2_MODULUS,
    )


def in_kept_namespace(name: Column) -> Column:
    """True when there is no namespace mark, or the text starts with the kept namespace."""
    return ~F.contains(name, F.lit(NAMESPACE_MARK)) | F.startswith(name, F.lit(KEPT_NAMESPACE))
