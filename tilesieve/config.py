"""Parameters of a run, in the three sections data / extraction / selection."""

from __future__ import annotations

from dataclasses import dataclass, field

# Band order of a shard, and per-channel statistics the vision models were trained
# with (red, green, blue).
BAND_ORDER = ("B01", "B02", "B03", "B04", "B08", "B05", "B06", "B07", "B8A", "B09", "B11", "B12")
CHANNEL_MEAN = (0.430, 0.411, 0.296)
CHANNEL_STD = (0.213, 0.156, 0.143)

# One native tile, uint16 samples.
TILE_SIDE = 1068
TILE_BANDS = 12
BYTES_PER_SAMPLE = 2


@dataclass(frozen=True)
class DataConfig:
    metadata_path: str
    images_dir: str
    output_dir: str

    def table(self, name: str) -> str:
        return f"{self.output_dir.rstrip('/')}/{name}"


@dataclass(frozen=True)
class ExtractionConfig:
    band_indices: tuple[int, ...] = (3, 2, 1)
    nodata_threshold: float = 0.45
    sample_fraction: float = 1.0
    seed: int = 42
    model: str = "vits16"
    crop_size: int = 224
    batch_size: int = 64
    tile_height: int = TILE_SIDE
    tile_width: int = TILE_SIDE
    # Unreadable tiles: "drop" leaves them out, "zeros" embeds them as empty images, "fail" stops.
    on_error: str = "fail"
    # Parts that are extracted one after the other; a run that was stopped goes on behind the last whole one.
    slices: int = 1
    # Numbers the model gets: "float" as networks take them, or "double".
    pixels: str = "float"


@dataclass(frozen=True)
class SelectionConfig:
    method: str = "lloyd"
    n_clusters: int = 1000
    # Rounds of Lloyd's algorithm, or passes over all rows in mini-batches.
    max_iter: int = 6
    # Start: "first", "sample" or "oversampled" (rows far from each other).
    init: str = "sample"
    # Move centres without points onto far points (Lloyd); share of the heaviest centre's weight below which
    # a centre is moved onto a random row (mini-batches).
    refill: bool = False
    reassignment: float = 0.0
    max_points_per_centroid: int | None = None
    batch_size: int = 4096
    pca_components: int = 0
    seed: int = 42
    target_n_tiles: int = 530_000
    threshold: float = 0.25
    min_threshold: float = 1e-6
    threshold_decay: float = 0.5
    threshold_attempts: int = 8
    test_subset_size: int | None = None
    keep_distance: bool = False


@dataclass(frozen=True)
class RunConfig:
    data: DataConfig
    extraction: ExtractionConfig = field(default_factory=ExtractionConfig)
    selection: SelectionConfig = field(default_factory=SelectionConfig)
