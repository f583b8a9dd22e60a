"""From raw bands to embeddings, as one job over the tiles.

The order of the stages matters: null bands and the no-data share are tested before a tile is
resized and before the model sees it, and an Arrow stage is a border that filters do not cross.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..config import CHANNEL_MEAN, CHANNEL_STD
from ..functions.bands import nodata_fraction, zero_value_pct
from .blocks import matrix
from .models import Factory, vectors_of

RGB = ("B04", "B03", "B02")


def _band_bytes(df: DataFrame, name: str) -> Column:
    """The blob of a band, which may be stored as binary or as a struct with a ``bytes`` field."""
    return F.col(name)["bytes"] if isinstance(df.schema[name].dataType, T.StructType) else F.col(name)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _decoded(blobs: pa.Array) -> pa.Array:
    return pa.array(
        [None if b is None else np.frombuffer(b, dtype="<u2").astype(np.int32) for b in blobs.to_pylist()],
        pa.list_(pa.int32()),
    )


def decode_raw_band(df: DataFrame, bands: Sequence[str] = RGB) -> DataFrame:
    """Little-endian uint16 blobs as flat integer arrays; a null blob stays null."""
    return df.withColumns({b: _decoded(_band_bytes(df, b)) for b in bands})


def null_band_policy(df: DataFrame, mode: str = "drop", bands: Sequence[str] = RGB, pixels: int | None = None) -> DataFrame:
    """``drop`` rejects a tile with a null band; ``zeros`` replaces the band by ``pixels`` zeros."""
    if mode == "drop":
        return df.dropna(subset=list(bands))
    if mode != "zeros" or pixels is None:
        raise ValueError("mode must be 'drop', or 'zeros' with a number of pixels")
    return df.withColumns({b: F.coalesce(F.col(b), F.array_repeat(F.lit(0), pixels)) for b in bands})


def filter_nodata(df: DataFrame, threshold: float = 0.45, bands: Sequence[str] = RGB) -> DataFrame:
    """Tiles whose no-data share does not exceed the threshold; equality is kept."""
    share = nodata_fraction(*[F.col(b) for b in bands])
    return df.filter(share * 100.0 <= F.lit(threshold * 100.0))


def filter_zero_range(df: DataFrame, low: float, high: float, col: str = "zero_pct") -> DataFrame:
    """Rows strictly between the bounds."""
    return df.filter((F.col(col) > low) & (F.col(col) < high))


def with_zero_pct(df: DataFrame, bands: Sequence[str] = RGB) -> DataFrame:
    return df.withColumn("zero_pct", zero_value_pct(*[F.col(b) for b in bands]))


def cubic_weights(source: int, target: int) -> np.ndarray:
    """(target, source) weights of bicubic resampling with half-pixel centres and clamped borders.

    The kernel is the cubic convolution of Keys with a = -0.75; without antialiasing four source
    samples contribute to every target sample.
    """
    a = -0.75
    centre = (np.arange(target) + 0.5) * source / target - 0.5
    base = np.floor(centre).astype(int)
    weights = np.zeros((target, source))
    for tap in range(-1, 3):
        x = np.abs(centre - (base + tap))
        near = (a + 2) * x**3 - (a + 3) * x**2 + 1
        far = a * x**3 - 5 * a * x**2 + 8 * a * x - 4 * a
        value = np.where(x <= 1, near, np.where(x < 2, far, 0.0))
        np.add.at(weights, (np.arange(target), np.clip(base + tap, 0, source - 1)), value)
    return weights


def resizer(height: int, width: int, size: int) -> Callable[[np.ndarray], np.ndarray]:
    """A function from (bands, height, width) to (bands, size, size): two matrix products."""
    down, across = cubic_weights(height, size), cubic_weights(width, size).T
    return lambda image: down @ image @ across


def resize_bicubic(df: DataFrame, height: int, width: int, size: int, bands: Sequence[str] = RGB, key: str = "row_id") -> DataFrame:
    """(key, *bands): scaled double arrays resampled to size x size; a null band stays null."""
    names = [key, *bands]

    def run(batches):
        resize = resizer(height, width, size)
        for batch in batches:
            columns = [batch.column(0)]
            for c in batch.columns[1:]:
                there = c.drop_null()
                small = resize(matrix(there).reshape(len(there), height, width)).reshape(-1)
                ends = np.concatenate([[0], np.cumsum(c.is_valid().to_numpy(zero_copy_only=False))]) * size * size
                offsets = pa.array(ends.astype(np.int32), mask=np.append(c.is_null().to_numpy(zero_copy_only=False), False))
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(small)))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join([f"`{key}` {df.schema[key].dataType.simpleString()}", *[f"`{b}` array<double>" for b in bands]])
    return df.select(*names).mapInArrow(run, schema)


def prepare_tiles(
    tiles: DataFrame,
    height: int,
    width: int,
    size: int = 224,
    threshold: float = 0.45,
    bands: Sequence[str] = RGB,
    kind: str = "float",
) -> DataFrame:
    """(row_id, status, nodata, pixels) of raw tiles; pixels, of type ``kind``, only for tiles that are kept.

    One Arrow pass decodes, tests, scales, clamps, resizes and normalises, so that a native tile
    crosses into Python once and comes back as a size x size image.
    """
    mean = np.asarray(CHANNEL_MEAN).reshape(3, 1, 1)
    std = np.asarray(CHANNEL_STD).reshape(3, 1, 1)
    if kind not in ("float", "double"):
        raise ValueError(f"pixels must be 'float' or 'double', not {kind!r}")
    number = np.float32 if kind == "float" else np.float64

    def one(blobs, resize) -> tuple[str, float | None, np.ndarray | None]:
        if any(b is None for b in blobs):
            return "null_band", None, None
        if any(len(b) != 2 * height * width for b in blobs):
            return "read_error", None, None
        raw = np.stack([np.frombuffer(b, dtype="<u2").reshape(height, width) for b in blobs])
        share = float((raw == 0).all(axis=0).mean())
        if share * 100.0 > threshold * 100.0:
            return "nodata", share, None
        image = resize(np.clip(raw / 10000.0, 0.0, 1.0))
        return "kept", share, ((image - mean) / std).astype(number).ravel()

    def run(batches):
        resize = resizer(height, width, size)
        for batch in batches:
            if batch.num_rows:
                made = [one([c[i].as_py() for c in batch.columns[1:]], resize) for i in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([m[0] for m in made], pa.string()),
                        pa.array([m[1] for m in made], pa.float64()),
                        pa.array([m[2] for m in made], pa.list_(pa.from_numpy_dtype(number))),
                    ],
                    names=["row_id", "status", "nodata", "pixels"],
                )

    source = tiles.select("row_id", *[_band_bytes(tiles, b).alias(b) for b in bands])
    return source.mapInArrow(run, f"row_id bigint, status string, nodata double, pixels array<{kind}>")


def blank_pixels(size: int, kind: str = "float") -> Column:
    """The image of an unreadable tile under the ``zeros`` policy: zeros, then normalised."""
    parts = [F.array_repeat(F.lit(-m / s).cast(kind), size * size) for m, s in zip(CHANNEL_MEAN, CHANNEL_STD)]
    return F.concat(*parts)


def embed_tiles(prepared: DataFrame, factory: Factory, size: int = 224, batch_size: int = 64) -> DataFrame:
    """(row_id, embedding): batched inference over the tiles that have pixels."""

    def make():
        model = factory()
        return lambda images: vectors_of(model(images))

    predict = predict_batch_udf(
        make,
        return_type=T.ArrayType(T.FloatType()),
        batch_size=batch_size,
        input_tensor_shapes=[[3, size, size]],
    )
    return prepared.select("row_id", predict(F.col("pixels")).alias("embedding"))


def tile_status(manifest: DataFrame, outcome: DataFrame) -> DataFrame:
    """(row_id, status) for every manifest row; rows without an outcome could not be read."""
    return manifest.select("row_id").join(outcome.select("row_id", "status"), "row_id", "left").select(
        "row_id", F.coalesce("status", F.lit("read_error")).alias("status")
    )


def status_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n_tiles"))


def measure_tiles(tiles: DataFrame, bands: Sequence[str] = RGB, null_bands: str = "skip") -> DataFrame:
    """(row_id, status, nodata, zero_pct, is_black, n_pixels, sums, squares) of raw tiles, in one pass.

    ``sums`` and ``squares`` hold, per band, the sum of the values scaled by 10000 and of their
    squares.  A tile with a null band is left out, or its band counts as empty (``zeros``).  Status is
    ``kept``, or ``read_error`` with null measures where the bands don't hold equally many whole samples.
    """
    if null_bands not in ("skip", "zeros"):
        raise ValueError(f"null_bands must be 'skip' or 'zeros', not {null_bands!r}")
    names = ["row_id", "status", "nodata", "zero_pct", "is_black", "n_pixels", "sums", "squares"]

    def one(blobs) -> tuple | None:
        length = max((len(b) for b in blobs if b is not None), default=0)
        if any(b is None for b in blobs):
            if null_bands == "skip" or not length:
                return None
            blobs = [bytes(length) if b is None else b for b in blobs]
        if not length or length % 2 or any(len(b) != length for b in blobs):
            return "read_error", *[None] * 6
        raw = np.stack([np.frombuffer(b, dtype="<u2") for b in blobs])
        scaled = raw / 10000.0
        zero = raw == 0
        return (
            "kept",
            float(zero.all(axis=0).mean()),
            100.0 * float(zero.mean()),
            bool(zero.all()),
            raw.shape[1],
            scaled.sum(axis=1),
            np.einsum("ij,ij->i", scaled, scaled),
        )

    def run(batches):
        for batch in batches:
            made = [one([c[i].as_py() for c in batch.columns[1:]]) for i in range(batch.num_rows)]
            kept = [i for i, m in enumerate(made) if m is not None]
            if kept:
                columns = list(zip(*(made[i] for i in kept)))
                kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(kept)), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=names
                )

    source = tiles.select("row_id", *[_band_bytes(tiles, b).alias(b) for b in bands])
    return source.mapInArrow(
        run,
        "row_id bigint, status string, nodata double, zero_pct double, is_black boolean, n_pixels bigint, sums array<double>, squares array<double>",
    )


def band_stats_of_measures(measures: DataFrame, bands: Sequence[str] = RGB) -> DataFrame:
    """band_stats from the measures of raw tiles that could be read."""
    totals = measures.filter(F.col("status") == "kept").agg(
        F.count(F.lit(1)).alias("n_tiles"),
        *[F.sum(F.col("sums")[i]).alias(f"_s_{b}") for i, b in enumerate(bands)],
        *[F.sum(F.col("squares")[i]).alias(f"_q_{b}") for i, b in enumerate(bands)],
        *[F.sum("n_pixels").alias(f"_n_{b}") for b in bands],
    )
    return _stats_of_totals(totals, bands)


def band_stats(tiles: DataFrame, bands: Sequence[str] = RGB) -> DataFrame:
    """(band, n_tiles, mean, std) over all pixels of tiles without a null band.

    Values are scaled by 10000 and not clamped; the deviation is that of the population.
    """
    sums = []
    for b in bands:
        scaled = lambda x: x.cast("double") / 10000.0
        sums += [
            F.sum(F.aggregate(b, F.lit(0.0), lambda a, x: a + scaled(x))).alias(f"_s_{b}"),
            F.sum(F.aggregate(b, F.lit(0.0), lambda a, x: a + scaled(x) * scaled(x))).alias(f"_q_{b}"),
            F.sum(F.size(b)).alias(f"_n_{b}"),
        ]
    return _stats_of_totals(tiles.dropna(subset=list(bands)).agg(F.count(F.lit(1)).alias("n_tiles"), *sums), bands)


def _stats_of_totals(totals: DataFrame, bands: Sequence[str]) -> DataFrame:
    lines = F.array(
        *[
            F.struct(
                F.lit(b).alias("band"),
                (F.col(f"_s_{b}") / F.col(f"_n_{b}")).alias("mean"),
                (F.col(f"_q_{b}") / F.col(f"_n_{b}")).alias("square"),
            )
            for b in bands
        ]
    )
    rows = totals.select("n_tiles", F.explode(lines).alias("r"))
    spread = F.sqrt(F.greatest(F.col("r.square") - F.col("r.mean") * F.col("r.mean"), F.lit(0.0)))
    return rows.select("r.band", "n_tiles", "r.mean", spread.alias("std"))
