"""Header cleaning."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame


def clean_name(name: str) -> str:
    """Trim, turn the replacement character into ``n``, and keep only ``[0-9A-Za-z_]``.

    Every run of other characters, and every run of underscores, becomes one underscore;
    none is left at either end.
    """
    text = name.strip().replace("�", "n")
    return re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_")


def clean_headers(df: DataFrame) -> DataFrame:
    """Rename all columns in one projection; two headers with one clean form are an error."""
    names = [clean_name(c) for c in df.columns]
    clashes = sorted(n for n, times in Counter(n.lower() for n in names).items() if times > 1)
    if clashes:
        raise ValueError(f"headers that become equal after cleaning: {clashes}")
    return df.toDF(*names)
