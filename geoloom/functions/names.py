"""Column names of raw sources as snake_case."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

#: Two coordinate pairs of one source that would collide once normalised.
PAIRED_COORDINATES = {"_latitude": "alternate_latitude", "_longitude": "alternate_longitude"}


def snake_case(name: str) -> str:
    """Lower case, runs of other characters than a-z and 0-9 as one underscore.

    Compatibility forms are decomposed first, so an accent becomes a separator of its own.
    """
    plain = unicodedata.normalize("NFKD", name.replace("﻿", "").replace("\xa0", " ")).lower()
    out = re.sub("[^a-z0-9]+", "_", plain).strip("_")
    if not out:
        return "unnamed_column"
    return f"column_{out}" if out[0].isdigit() else out


def snake_names(names: Iterable[str], overrides: Mapping[str, str] | None = None) -> list[str]:
    """Names in order; overrides replace a raw name first, later duplicates get _2, _3, ..."""
    taken: set[str] = set()
    out = []
    for raw in names:
        base = snake_case((overrides or {}).get(raw, raw))
        name, n = base, 1
        while name in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        out.append(name)
    return out


def with_snake_names(df: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    return df.toDF(*snake_names(df.columns, overrides))
