"""Expressions on decoded bands: one flat, row-major integer array per band.

They are evaluated element by element, which is right for thumbnails and samples.  For native
tiles ``operators.tiles.measure_tiles`` takes the same measures from the blobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ..config import BAND_ORDER, CHANNEL_MEAN, CHANNEL_STD


def band_columns(indices: Sequence[int] = (3, 2, 1)) -> list[str]:
    """Names of the bands at the given positions of the shard's band order."""
    return [BAND_ORDER[i] for i in indices]


def _count(band: Column, hit) -> Column:
    return F.aggregate(band, F.lit(0).cast("bigint"), lambda acc, x: acc + F.when(hit(x), 1).otherwise(0))


def nodata_fraction(red: Column, green: Column, blue: Column) -> Column:
    """Share of pixels in which all three bands are zero."""
    either = F.zip_with(F.zip_with(red, green, lambda r, g: r.bitwiseOR(g)), blue, lambda x, b: x.bitwiseOR(b))
    return _count(either, lambda x: x == 0).cast("double") / F.size(red)


def zero_value_pct(red: Column, green: Column, blue: Column) -> Column:
    """100 x share of single band values that are zero."""
    zeros = sum((_count(b, lambda x: x == 0) for b in (green, blue)), _count(red, lambda x: x == 0))
    total = F.size(red) + F.size(green) + F.size(blue)
    return F.lit(100.0) * zeros / total


def scale_clamp(band: Column) -> Column:
    """x / 10000 clamped to [0, 1]."""
    return F.transform(
        band, lambda x: F.least(F.greatest(x.cast("double") / 10000.0, F.lit(0.0)), F.lit(1.0))
    )


def channel_normalize(band: Column, channel: int) -> Column:
    """(x - mean) / std of the model's training channel 0, 1 or 2."""
    mean, std = CHANNEL_MEAN[channel], CHANNEL_STD[channel]
    return F.transform(band, lambda x: (x - F.lit(mean)) / F.lit(std))


def is_black_tile(red: Column, green: Column, blue: Column) -> Column:
    """True where the maximum of every band is zero."""
    return (F.array_max(red) == 0) & (F.array_max(green) == 0) & (F.array_max(blue) == 0)


def display_rgb(band: Column) -> Column:
    """clip(x / 3000, 0, 1) x 255, truncated to an integer in 0..255."""
    return F.transform(
        band,
        lambda x: F.floor(
            F.least(F.greatest(x.cast("double") / 3000.0, F.lit(0.0)), F.lit(1.0)) * 255.0
        ).cast("int"),
    )


def tile_outcome(found: Column, bands: Sequence[Column], threshold: float = 0.45) -> Column:
    """read_error / null_band / nodata / kept, tested in that order."""
    missing_band = F.lit(False)
    for band in bands:
        missing_band = missing_band | band.isNull()
    return (
        F.when(~found, F.lit("read_error"))
        .when(missing_band, F.lit("null_band"))
        .when(nodata_fraction(*bands) * 100.0 > F.lit(threshold * 100.0), F.lit("nodata"))
        .otherwise(F.lit("kept"))
    )
