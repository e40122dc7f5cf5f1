"""Link lines to edges."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.functions.text import in_kept_namespace

TAB = "\t"


def parse_links(
    lines: DataFrame, namespace: Literal["line", "field"] = "line", comment: str | None = None
) -> DataFrame:
    """Lower-cased ``src<TAB>dst`` lines as edges; only the first tab separates.

    ``namespace="line"`` tests the whole line for foreign namespaces, ``"field"``
    tests each end. Lines without a tab are dropped, as are lines that start with
    ``comment`` when it is given.
    """
    raw = F.col("value")
    line = F.lower(raw)
    src = F.substring_index(line, TAB, 1)
    dst = F.substr(line, F.locate(TAB, line) + 1)
    kept = F.contains(raw, F.lit(TAB))
    if comment is not None:
        kept &= ~F.startswith(raw, F.lit(comment))
    if namespace == "line":
        kept &= in_kept_namespace(line)
    else:
        kept &= in_kept_namespace(src) & in_kept_namespace(dst)
    return lines.where(kept).select(src.alias("src"), dst.alias("dst"))
