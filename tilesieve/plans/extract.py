"""Step 1: from metadata and shards to stored embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import RunConfig
from ..functions.bands import band_columns
from ..operators.models import model_factory
from ..operators.sampling import sample_fraction
from ..operators.tiles import blank_pixels, embed_tiles, prepare_tiles, tile_status
from ..session import written
from ..sources.manifest import load_or_build_manifest, read_if_present
from ..sources.tiles import read_tiles
from ..sources.vectors import read_embeddings, write_embeddings


def prepare_wanted(spark: SparkSession, manifest: DataFrame, cfg: RunConfig) -> DataFrame:
    """(row_id, status, nodata, pixels) of every manifest tile that could be read, written.

    An image is some 2 % of its tile; with it stored, the status costs no second reading of tiles
    and a lost executor costs no preparing anew.
    """
    e = cfg.extraction
    if e.on_error not in ("fail", "drop", "zeros"):
        raise ValueError(f"on_error must be 'fail', 'drop' or 'zeros', not {e.on_error!r}")
    bands = band_columns(e.band_indices)
    tiles = read_tiles(spark, cfg.data.images_dir, manifest, bands, tolerant=e.on_error != "fail")
    return written(prepare_tiles(tiles, e.tile_height, e.tile_width, e.crop_size, e.nodata_threshold, bands, e.pixels), "prepared")


def embed_prepared(manifest: DataFrame, prepared: DataFrame, cfg: RunConfig) -> DataFrame:
    """(row_id, embedding) of the kept tiles; with ``zeros`` also of those that could not be read."""
    e = cfg.extraction
    usable = prepared.filter(F.col("status") == "kept").select("row_id", "pixels")
    if e.on_error == "zeros":
        unread = tile_status(manifest, prepared).filter(F.col("status") == "read_error").select("row_id")
        usable = usable.unionByName(unread.withColumn("pixels", blank_pixels(e.crop_size, e.pixels)))
    return embed_tiles(usable, model_factory(e.model), e.crop_size, e.batch_size)


def prepare_and_embed_tiles(spark: SparkSession, manifest: DataFrame, cfg: RunConfig) -> DataFrame:
    """(row_id, embedding) of every manifest tile that passes the band and no-data tests."""
    return embed_prepared(manifest, prepare_wanted(spark, manifest, cfg), cfg)


# Numbers of the commits that are no slices: the tables are being put together, and they are whole.
_PUBLISHING, _WHOLE = -2, -1
_COMMITS = "slice int, settings string"


def _settings(cfg: RunConfig) -> str:
    """What the result of step 1 depends on, and how it is sliced."""
    return repr((cfg.data.metadata_path, cfg.data.images_dir, cfg.extraction))


def _committed(spark: SparkSession, cfg: RunConfig) -> set[int]:
    """The slices of this run that are whole; a run with other settings is not continued."""
    stored = read_if_present(spark, cfg.data.table("commits"))
    rows = [] if stored is None else stored.collect()
    if any(row["settings"] != _settings(cfg) for row in rows):
        raise ValueError(f"{cfg.data.output_dir} holds an extraction with other settings")
    return {row["slice"] for row in rows}


def _commit(spark: SparkSession, cfg: RunConfig, number: int) -> None:
    """One more row of the commit table; it is there as a whole or not at all."""
    spark.createDataFrame([(number, _settings(cfg))], _COMMITS).coalesce(1).write.mode("append").parquet(cfg.data.table("commits"))


def _part(cfg: RunConfig, table: str, number: int) -> str:
    return cfg.data.table(f"slices/{table}-{number:06d}")


def sliced(manifest: DataFrame, slices: int) -> list[DataFrame]:
    """The manifest in ranges of ``row_id`` of equal width, so a slice reads few shards whole instead of all in part."""
    low, high = manifest.agg(F.min("row_id"), F.max("row_id")).first()
    if slices == 1 or low is None:
        return [manifest]
    edges = [low + (high + 1 - low) * i // slices for i in range(slices + 1)]
    return [manifest.filter((F.col("row_id") >= a) & (F.col("row_id") < b)) for a, b in zip(edges, edges[1:])]


def _extract_slice(spark: SparkSession, manifest: DataFrame, cfg: RunConfig, number: int) -> None:
    """Outcome and vectors of one slice; what a stopped run left of it is overwritten."""
    prepared = prepare_wanted(spark, manifest, cfg)
    tile_status(manifest, prepared).write.mode("overwrite").parquet(_part(cfg, "tile_status", number))
    write_embeddings(embed_prepared(manifest, prepared, cfg), _part(cfg, "embeddings", number), mode="overwrite")


def extract_features(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Build or reuse the manifest, embed its tiles, store the vectors and the outcome of every tile.

    Tiles are extracted in ``slices`` parts.  A part counts once the commit table names it, after its
    tables are written; started again in the same folder with the same settings, a run extracts the
    others only.  The tables ``tile_status`` and ``embeddings`` are written when all parts are whole.
    """
    if cfg.extraction.slices < 1:
        raise ValueError(f"slices must be at least 1, not {cfg.extraction.slices}")
    done = _committed(spark, cfg)
    embeddings = cfg.data.table("embeddings")
    if _WHOLE in done:
        return read_embeddings(spark, embeddings)
    manifest = load_or_build_manifest(
        spark, cfg.data.table("manifest"), cfg.data.metadata_path, cfg.data.images_dir
    )
    e = cfg.extraction
    wanted = sample_fraction(manifest, e.sample_fraction, "row_id", e.seed)
    parts = sliced(wanted if e.slices == 1 or wanted is manifest else written(wanted, "wanted"), e.slices)
    for number, part in enumerate(parts):
        if number not in done:
            _extract_slice(spark, part, cfg, number)
            _commit(spark, cfg, number)
    # A table of another run is not overwritten, one that this run began to write is.
    mode = "overwrite" if _PUBLISHING in done else "errorifexists"
    if _PUBLISHING not in done:
        for name in ("tile_status", "embeddings"):
            if read_if_present(spark, cfg.data.table(name)) is not None:
                raise FileExistsError(f"{cfg.data.table(name)} is there already")
        _commit(spark, cfg, _PUBLISHING)
    numbers = range(len(parts))
    spark.read.parquet(*[_part(cfg, "tile_status", n) for n in numbers]).write.mode(mode).parquet(cfg.data.table("tile_status"))
    write_embeddings(read_embeddings(spark, *[_part(cfg, "embeddings", n) for n in numbers]), embeddings, mode=mode)
    _commit(spark, cfg, _WHOLE)
    return read_embeddings(spark, embeddings)
