"""Default vocabulary, sizes and cadences.

Every operator takes these as parameters; the module only says what happens
when the caller does not choose.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Needed unchanged for equal results.
SPLITS = ("train", "test", "val")
CATEGORIES = ("NORMAL", "PNEUMONIA")
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png")
CLASS_IDS = {"NORMAL": 0, "PNEUMONIA_BACTERIA": 1, "PNEUMONIA_VIRUS": 2}
UNKNOWN_CLASS = "UNKNOWN"
LUMINANCE_RED = 0.299
LUMINANCE_GREEN = 0.587
LUMINANCE_BLUE = 0.114
IMAGE_SIZE = 128
RESIZE_MODE = "fit"
LOCAL_ZONE = "Europe/Paris"
RUN_GAP_SECONDS = 60
CHART_BUCKETS = 600
METRICS_TAIL = 200
WARMUP_BATCHES = 2
QUARANTINE_HEAD = 10
PAGE_SIZE = 20
VAL_TARGET_PER_CLASS = 100
SAMPLE_SEED = 42
TRAIN_BATCH_SIZE = 16
STAGING_DIR = "_staging"
# End of the fixed values.

CLASS_NAMES = {class_id: name for name, class_id in CLASS_IDS.items()}

UNDECODABLE = "undecodable image"
EMPTY_FILE = "empty file"


@dataclass(frozen=True)
class StreamConfig:
    """Everything a streaming query needs besides the session and the model."""

    incoming: str
    output: str
    checkpoint: str
    rejected: str
    trigger_seconds: int = 1
    max_files_per_trigger: int = 256
    delete_processed: bool = True
    predict_batch_size: int = 64
    image_size: int = IMAGE_SIZE
    resize_mode: str = RESIZE_MODE
    splits: tuple[str, ...] = SPLITS
    categories: tuple[str, ...] = CATEGORIES
    extensions: tuple[str, ...] = IMAGE_EXTENSIONS
    class_ids: dict[str, int] = field(default_factory=lambda: dict(CLASS_IDS))
    decode_partitions: int | None = None
    until_drained: bool = False


@dataclass(frozen=True)
class AugmentConfig:
    """Ranges of the random training-time distortions, as fractions."""

    # Fixed values.
    vertical_shift: float = 0.12
    horizontal_shift: float = 0.10
    zoom_in_max: float = 0.2
    zoom_out_max: float = 0.1
    rotation: float = 0.04
    contrast: float = 0.15
    noise_stddev: float = 0.02
