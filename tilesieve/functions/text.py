"""String expressions on shard addresses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def basename(col: Column) -> Column:
    """Text after the last ``/`` of the string form."""
    return F.substring_index(col.cast("string"), "/", -1)


def after_images(col: Column) -> Column:
    """Text after ``images/``, which has to occur exactly once."""
    pieces = F.split(col, "images/")
    wrong = F.concat(F.lit("expected 'images/' exactly once in "), col)
    return F.when(F.size(pieces) == 2, pieces[1]).when(col.isNotNull(), F.raise_error(wrong).cast("string"))


def joined_path(folder: str, name: Column) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), name)
