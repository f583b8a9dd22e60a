"""Tile shards: Parquet files, or folders of such files, below one directory.

A shard is named by the first path component below the directory, with or without ``shard=`` in
front.  A tile is addressed by its row number inside the shard: the position in the file of a
one-file shard, or the column ``tile_row`` of the shards this package writes, which may consist
of several files.  Footers tell where a row group lies and how many rows and bytes it has.  Only the row
groups and columns that are asked for are opened: the addresses are dealt to tasks by row group, and a
task streams each of its groups once and keeps the named rows.  Image bytes are never shuffled; a task
writes the rows that it has read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import basename
from ..operators.ranking import rank_within
from ..session import written

# Compressed bytes of the row groups that one reading task is dealt, and of decoded rows that it holds at a time.
READ_BYTES = 256 * 1024 * 1024
HELD_BYTES = 64 * 1024 * 1024
# Rows of a written file: native tiles are some 27 MB each.
ROWS_PER_FILE = 128


def _shard(images_dir: str):
    folder = urlparse(images_dir).path.rstrip("/")
    first = F.regexp_extract(F.col("_metadata.file_path"), rf"\Q{folder}\E/+([^/]+)", 1)
    return F.regexp_replace(first, "^shard=", "")


def _scan(spark: SparkSession, images_dir: str, columns: Sequence[str] | None, kind: str, tolerant: bool) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", str(tolerant).lower())
    if columns is None:
        found = reader.option("mergeSchema", "true").parquet(images_dir).schema
        clash = [f.name for f in found if f.name.lower() in ("shard", "row_in_file")]
        if clash:
            raise ValueError(f"shards must not have columns named {', '.join(clash)}")
        fields = [f for f in found if f.name != "tile_row"]
    else:
        fields = [T.StructField(c, T.DataType.fromDDL(kind)) for c in columns]
    return reader.schema(T.StructType([*fields, T.StructField("tile_row", T.LongType())])).parquet(images_dir)


def open_shards(
    spark: SparkSession,
    images_dir: str,
    columns: Sequence[str] | None = (),
    kind: str = "binary",
    tolerant: bool = False,
) -> DataFrame:
    """(shard, row_in_file, *columns) with columns of type ``kind``; without columns no band is read.

    ``columns=None`` takes all columns of the shards with the types that their footers tell.
    ``tolerant`` passes over files that cannot be read; compare the result with the manifest then.
    """
    row = F.coalesce(F.col("tile_row"), F.col("_metadata.row_index"))
    scan = _scan(spark, images_dir, columns, kind, tolerant)
    held = [c for c in scan.columns if c != "tile_row"]
    return scan.select(_shard(images_dir).alias("shard"), row.alias("row_in_file"), *[F.col(f"`{c}`") for c in held])


def _opened(path: str):
    """A Parquet file named as Spark names it."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    where, name = pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return pq.ParquetFile(name, filesystem=where)


_GROUPS = "shard string, row_group int, first_row bigint, n_rows bigint, path string, part int, at bigint, n_bytes bigint"


def row_groups(spark: SparkSession, images_dir: str, manifest: DataFrame | None = None, tolerant: bool = False) -> DataFrame:
    """(shard, row_group, first_row, n_rows, path, part, at, n_bytes) from the footers of the shards that the manifest names, or of all.

    ``part`` is the row group of the file at ``path``, ``at`` the place of its first row in it, ``n_bytes``
    its compressed size.  In shards with ``tile_row`` every row counts as a group of its own, numbered
    by it.  Footers that cannot be read stop the job or, where ``tolerant``, are passed over.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(images_dir)
    files = listed.select(_shard(images_dir).alias("shard"), F.col("_metadata.file_path").alias("path"))
    if manifest is not None:
        files = files.join(manifest.select(basename(F.col("parquet_file")).alias("shard")).distinct(), "shard", "left_semi")
    # A fixed number of tasks: a path is a few bytes, opening the file is the work.
    files = files.repartition(spark.sparkContext.defaultParallelism, "path")

    def groups(path):
        with _opened(path) as file:
            about = [file.metadata.row_group(i) for i in range(file.metadata.num_row_groups)]
            sizes = np.array([g.num_rows for g in about], np.int64)
            n_bytes = np.array([sum(g.column(c).total_compressed_size for c in range(g.num_columns)) for g in about], np.int64)
            part, starts = np.arange(len(sizes)), np.cumsum(sizes) - sizes
            if "tile_row" not in file.schema_arrow.names:
                return part, starts, sizes, part, np.zeros(len(sizes), np.int64), n_bytes
            rows = file.read(columns=["tile_row"]).column(0).to_numpy()
            own = np.repeat(part, sizes)
            return rows, rows, np.ones(len(rows), np.int64), own, np.arange(len(rows)) - starts[own], n_bytes[own]

    def run(batches):
        for batch in batches:
            for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    number, first, size, part, at, n_bytes = groups(path)
                except (OSError, pa.ArrowException) as error:
                    if tolerant:
                        continue
                    raise OSError(f"cannot read the footer of {path}") from error
                names = [pa.array([v] * len(number), pa.string()) for v in (shard, path)]
                columns = [names[0], pa.array(number, pa.int32()), pa.array(first, pa.int64()), pa.array(size), names[1], pa.array(part, pa.int32()), pa.array(at), pa.array(n_bytes)]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "row_group", "first_row", "n_rows", "path", "part", "at", "n_bytes"])

    return files.mapInArrow(run, _GROUPS)


def row_group_starts(spark: SparkSession, images_dir: str) -> DataFrame:
    """(shard, row_group, first_row) from the footers, one small task per share of the files."""
    return row_groups(spark, images_dir).select("shard", "row_group", "first_row")


def addresses(manifest: DataFrame, starts: DataFrame) -> DataFrame:
    """(row_id, shard, row_in_file) of a manifest; row_in_file is null where the shards have no such row."""
    keys = manifest.select("row_id", basename(F.col("parquet_file")).alias("shard"), "row_group", "row_in_rg")
    row = F.col("first_row") + F.col("row_in_rg")
    if "n_rows" in starts.columns:
        row = F.when(F.col("row_in_rg") < F.col("n_rows"), row)
    return keys.join(starts, ["shard", "row_group"], "left").select("row_id", "shard", row.alias("row_in_file"))


def located(spark: SparkSession, images_dir: str, manifest: DataFrame, groups: DataFrame | None, tolerant: bool) -> DataFrame:
    """(row_id, shard, row_in_file, path, part, place, n_bytes) of the manifest's rows that exist, written."""
    held = groups if groups is not None and "path" in groups.columns else row_groups(spark, images_dir, manifest, tolerant)
    keys = manifest.select("row_id", basename(F.col("parquet_file")).alias("shard"), "row_group", "row_in_rg")
    found = keys.join(held, ["shard", "row_group"]).filter(F.col("row_in_rg") < F.col("n_rows"))
    row, place = F.col("first_row") + F.col("row_in_rg"), F.col("at") + F.col("row_in_rg")
    return written(found.select("row_id", "shard", row.alias("row_in_file"), "path", "part", place.alias("place"), "n_bytes"), "located")


def read_rows(places: DataFrame, keep: Sequence[str], fields: Sequence[T.StructField], max_bytes: int = READ_BYTES, tolerant: bool = False) -> DataFrame:
    """(*keep, *fields) of the rows that ``places`` (path, part, place, n_bytes, *keep) names.

    Row groups are dealt to tasks of about ``max_bytes``; of each only the columns ``fields`` are opened,
    once, in pieces of ``HELD_BYTES``.  A field that a file lacks is null.  A row named twice comes twice.
    Where ``tolerant``, row groups that cannot be read are passed over.
    """
    spark = places.sparkSession
    groups, total = places.groupBy("path", "part").agg(F.max("n_bytes").alias("b")).agg(F.count(F.lit(1)), F.sum("b")).first()
    cores = spark.sparkContext.defaultParallelism
    n_tasks = max(1, min(groups, max(cores, -(-(total or 0) // max(1, max_bytes)))))
    dealt = places.repartitionByRange(n_tasks, "path", "part").sortWithinPartitions("path", "part", "place")
    kept = T.StructType([places.schema[c] for c in keep])
    result = T.StructType([*kept.fields, *fields])
    kinds = to_arrow_schema(T.StructType(list(fields)))
    names = [f.name for f in fields]

    def pieces(file, part):
        """(first place, rows) of a row group, a bounded number of rows at a time."""
        there = [c for c in names if c in file.schema_arrow.names]
        group = file.metadata.row_group(part)
        roots = [group.column(c).path_in_schema for c in range(group.num_columns)]
        size = sum(group.column(c).total_uncompressed_size for c, r in enumerate(roots) if any(r == n or r.startswith(n + ".") for n in there))
        rows = max(1, min(4096, HELD_BYTES * group.num_rows // max(1, size)))
        if not there:
            yield 0, pa.RecordBatch.from_arrays([pa.nulls(group.num_rows)], names=["_none"])
            return
        first = 0
        for batch in file.iter_batches(batch_size=rows, row_groups=[part], columns=there):
            yield first, batch
            first += batch.num_rows

    def typed(batch, name):
        column = batch.column(batch.schema.get_field_index(name)) if name in batch.schema.names else pa.nulls(batch.num_rows)
        return column.cast(kinds.field(name).type)

    def read(path, part, place, rest):
        try:
            with _opened(path) as file:
                for first, batch in pieces(file, part):
                    a, b = np.searchsorted(place, [first, first + batch.num_rows])
                    if b > a:
                        at = pa.array(place[a:b] - first)
                        own = [typed(batch, n).take(at) for n in names]
                        yield pa.RecordBatch.from_arrays([*rest.slice(a, b - a).columns, *own], names=[*keep, *names])
        except (OSError, pa.ArrowException) as error:
            if not tolerant:
                raise OSError(f"cannot read row group {part} of {path}") from error

    def run(batches):
        now, held = None, []

        def flushed():
            table = pa.Table.from_batches(held).combine_chunks()
            place = table.column("place").to_numpy()
            rest = table.select(list(keep)).to_batches()
            yield from read(*now, place, rest[0] if rest else pa.RecordBatch.from_arrays([], names=[]))

        for batch in batches:
            paths, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            a = 0
            while a < len(paths):
                b = a + 1
                while b < len(paths) and (paths[b], parts[b]) == (paths[a], parts[a]):
                    b += 1
                if (paths[a], parts[a]) != now:
                    if held:
                        yield from flushed()
                    now, held = (paths[a], parts[a]), []
                held.append(batch.slice(a, b - a))
                a = b
        if held:
            yield from flushed()

    return dealt.select("path", "part", "place", *[c for c in keep]).mapInArrow(run, result)


def _fields(spark: SparkSession, images_dir: str, columns: Sequence[str] | None, kind: str) -> list[T.StructField]:
    """The columns to read: those named, of one type, or all with the types that the footers tell."""
    return [f for f in _scan(spark, images_dir, columns, kind, True).schema.fields if f.name != "tile_row"]


def read_tiles(
    spark: SparkSession,
    images_dir: str,
    manifest: DataFrame,
    bands: Sequence[str],
    starts: DataFrame | None = None,
    max_bytes: int = READ_BYTES,
    kind: str = "binary",
    tolerant: bool = False,
) -> DataFrame:
    """(row_id, shard, row_in_file, *bands) for the tiles of the manifest; only their row groups are opened.

    ``starts`` saves opening the footers, where ``row_groups`` were made before.
    """
    places = located(spark, images_dir, manifest, starts, tolerant)
    return read_rows(places, ["row_id", "shard", "row_in_file"], _fields(spark, images_dir, bands, kind), max_bytes, tolerant)


def extract_subset_rows(
    spark: SparkSession,
    images_dir: str,
    manifest: DataFrame,
    bands: Sequence[str] | None = None,
    max_bytes: int = READ_BYTES,
    kind: str = "binary",
    tolerant: bool = False,
    starts: DataFrame | None = None,
) -> DataFrame:
    """(shard, tile_row, *columns): the image rows that the manifest names, each once, whole or some ``bands``.

    ``tile_row`` counts the chosen rows of a shard in their old order.  It is found on the
    addresses, so the images are neither sorted nor grouped for it.
    """
    wanted = located(spark, images_dir, manifest, starts, tolerant).drop("row_id").distinct()
    ranked = rank_within(wanted, ["shard"], ["row_in_file"], "_rn").withColumn("tile_row", F.col("_rn") - 1)
    placed = written(ranked.select("shard", "tile_row", "path", "part", "place", "n_bytes"), "rows")
    return read_rows(placed, ["shard", "tile_row"], _fields(spark, images_dir, bands, kind), max_bytes, tolerant)


def write_shards(tiles: DataFrame, dest: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """One folder per shard, with files of at most ``rows_per_file`` rows.

    Nothing is shuffled: a task writes the rows it holds, so a shard has a file at least for every
    task that holds some of it.
    """
    placed = tiles.sortWithinPartitions("shard", "tile_row")
    placed.write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(dest)


def missing_rows(spark: SparkSession, images_dir: str, manifest: DataFrame) -> DataFrame:
    """(row_id, shard, row_in_file) of manifest rows whose shard or row is absent or whose footer is unreadable.

    ``row_in_file`` is null, as there is none.  Only footers are read.
    """
    held = row_groups(spark, images_dir, manifest, tolerant=True)
    return addresses(manifest, held).filter(F.col("row_in_file").isNull())


def missing_sources(spark: SparkSession, images_dir: str, manifest: DataFrame) -> DataFrame:
    """(shard, n_rows, n_missing, complete) for every shard the manifest names."""
    found = addresses(manifest, row_groups(spark, images_dir, manifest, tolerant=True))
    return found.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("row_in_file").isNull()).alias("n_missing"),
    ).withColumn("complete", F.col("n_missing") == 0)
