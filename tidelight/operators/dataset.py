"""Preparing a labelled feature table: splits, samples, weights, checks, load sets."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelight.defaults import CLASS_IDS, SAMPLE_SEED, TRAIN_BATCH_SIZE, VAL_TARGET_PER_CLASS
from tidelight.operators.ordered import with_row_index
from tidelight.session import broadcast_if_small, settle

DEFAULT_CLASSES = tuple(sorted(CLASS_IDS.values()))

# Hex digits of the sample key that one round of the selection looks at: at most 4 096 counts per class.
_DIGITS = 3
_ALL_DIGITS = 32
# A slice with at most so many different keys may be ranked by a window.
_FEW = 1_000


def sample_key(key: str, seed: int | None = None) -> Column:
    """Pseudo-random order of rows that depends on nothing but the key and the seed."""
    text = F.col(key).cast("string")
    return F.md5(text if seed is None else F.concat(F.lit(f"{seed}|"), text))


# ---- counts ---------------------------------------------------------------


def split_class_counts(df: DataFrame, split: str = "split", label: str = "labelId") -> DataFrame:
    return df.groupBy(split, label).agg(F.count(F.lit(1)).alias("images"))


def class_ids(df: DataFrame, label: str = "labelId") -> DataFrame:
    return df.select(label).distinct()


def class_count(df: DataFrame, label: str = "labelId") -> DataFrame:
    return df.agg((F.max(label) + 1).alias("classes"))


def dense_class_counts(df: DataFrame, label: str = "labelId") -> DataFrame:
    """Rows per class id from 0 to the largest, zero for ids that do not occur."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("images"))
    facts = counts.agg(F.max(label).alias("top"), F.sum("images").alias("total")).where("top IS NOT NULL")
    grid = facts.select(F.explode(F.sequence(F.lit(0), F.col("top")).cast("array<int>")).alias(label), "top", "total")
    return grid.join(counts, label, "left").select(
        label, F.coalesce("images", F.lit(0)).cast("long").alias("images"), "top", "total"
    )


def class_weights(df: DataFrame, label: str = "labelId") -> DataFrame:
    """Weight inverse to the class frequency; NULL for a class without rows."""
    weight = F.try_divide(F.col("total"), (F.col("top") + 1) * F.col("images"))
    return dense_class_counts(df, label).select(label, "images", weight.alias("weight"))


def with_class_weight(df: DataFrame, label: str = "labelId") -> DataFrame:
    """Attach the weight of its class to each row without moving the rows."""
    weights = class_weights(df, label).select(label, "weight")
    return df.join(broadcast_if_small(weights), label, "left")


def expected_frame(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """The values as a one-column table of the type that ``df`` has."""
    kind = df.schema[name].dataType.simpleString()
    return df.sparkSession.createDataFrame([(v,) for v in values], f"{name} {kind}")


def split_sizes(df: DataFrame, expected: Sequence[str] = ("train", "val", "test"), split: str = "split") -> DataFrame:
    """Rows of each expected split, zero included."""
    counts = df.groupBy(split).agg(F.count(F.lit(1)).alias("images"))
    wanted = expected_frame(df, split, expected)
    return wanted.join(counts, split, "left").select(split, F.coalesce("images", F.lit(0)).alias("images"))


def empty_splits(df: DataFrame, expected: Sequence[str] = ("train", "val", "test"), split: str = "split") -> DataFrame:
    return split_sizes(df, expected, split).where("images = 0").select(split)


def split_frames(
    df: DataFrame, expected: Sequence[str] = ("train", "val", "test"), split: str = "split", check: bool = True
) -> dict[str, DataFrame]:
    """One filtered frame per expected split; an error when one of them is empty."""
    if check:
        missing = [row[0] for row in empty_splits(df, expected, split).collect()]
        if missing:
            raise ValueError(f"no rows in split(s): {', '.join(sorted(missing))}")
    return {name: df.where(F.col(split) == name) for name in expected}


# ---- moving train rows to validation --------------------------------------


def val_missing(
    df: DataFrame,
    target: int = VAL_TARGET_PER_CLASS,
    classes: Sequence[int] | None = DEFAULT_CLASSES,
    label: str = "labelId",
    split: str = "split",
) -> DataFrame:
    """Per class: rows in ``val``, rows in ``train``, and how many ``val`` lacks to reach the target.

    ``classes`` lists the classes that must reach it; ``None`` means those that occur.
    """
    counts = df.groupBy(label).agg(
        F.count_if(F.col(split) == "val").alias("inVal"), F.count_if(F.col(split) == "train").alias("inTrain")
    )
    if classes is not None:
        counts = expected_frame(df, label, classes).join(counts, label, "left").na.fill(0, ["inVal", "inTrain"])
    return counts.withColumn("missing", F.greatest(F.lit(0).cast("long"), target - F.col("inVal")))


def rebalance_shortfall(df: DataFrame, target: int = VAL_TARGET_PER_CLASS, **options) -> DataFrame:
    """Classes whose train rows cannot fill the target, with the number that is short."""
    need = val_missing(df, target, **options)
    label = options.get("label", "labelId")
    return need.where("missing > inTrain").select(
        label, F.col("missing").alias("required"), F.col("inTrain").alias("available")
    )


def boundary_slices(keyed: DataFrame, need: DataFrame, label: str) -> DataFrame:
    """Radix selection: per class ``bound`` and ``left``, such that the ``need`` smallest hashes are those below ``bound``
    and the ``left`` smallest of those that begin with it.

    Each round counts the rows of the open slices by their next ``_DIGITS`` hex digits, takes the slots below the one in
    which the class's number is reached, and goes on inside that slot until it holds few rows or, for a key that repeats, until
    the digits end. A round shrinks a slice about 4 096 times, so ten billion rows of a class take three. ``need`` is a
    ``(label, need)`` table with one row per class.
    """
    begun = F.greatest(F.col("need").cast("long"), F.lit(0).cast("long"))
    state = settle(need.select(label, F.lit("").alias("bound"), begun.alias("left"), (begun > 0).alias("open")))
    while True:
        inside = keyed.join(broadcast_if_small(state.where("open")), label).where(F.col("hash").startswith(F.col("bound")))
        slot = F.substring("hash", F.length("bound") + 1, F.lit(_DIGITS))
        slots = inside.groupBy(label, "left", slot.alias("slot")).agg(F.count("*").alias("n"))
        so_far = Window.partitionBy(label).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # at most 4 096 rows
        below = slots.withColumn("below", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
        reached = below.where("below < left AND left <= below + n").select(label, "slot", "n", (F.col("left") - F.col("below")).alias("rest"))
        deeper = F.concat("bound", "slot")
        whole = F.col("slot").isNull() | (F.col("n") == F.col("rest"))  # "g" comes after all hex digits
        last = (F.col("n") <= _FEW) | (F.length(deeper) >= _ALL_DIGITS)
        following = state.join(reached, label, "left").select(
            label,
            F.when(~F.col("open"), F.col("bound")).when(whole, F.concat("bound", F.coalesce("slot", F.lit("")), F.lit("g"))).otherwise(deeper).alias("bound"),
            F.when(~F.col("open"), F.col("left")).when(whole, F.lit(0).cast("long")).otherwise(F.col("rest")).alias("left"),
            (F.col("open") & ~whole & ~last).alias("open"),
        )
        state = settle(following)
        if state.where("open").isEmpty():
            return state.select(label, "bound", "left")


def _edge(keyed: DataFrame, slices: DataFrame, label: str, key: str) -> DataFrame:
    """Keys of the boundary slices that are chosen, and how many of the rows of each."""
    begins = (F.col("left") > 0) & F.col("hash").startswith(F.col("bound"))
    inside = keyed.join(broadcast_if_small(slices), label).where(begins)
    copies = inside.groupBy(label, "hash", key, "left").agg(F.count("*").alias("n"))  # few keys, whatever the copies
    so_far = Window.partitionBy(label).orderBy("hash", key).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.least("n", F.col("left") - F.coalesce(F.sum("n").over(so_far), F.lit(0)))
    return copies.withColumn("taken", taken).where("taken > 0").select(label, key, "hash", "taken")


def sample_per_class(
    df: DataFrame, need: DataFrame, key: str = "sourcePath", label: str = "labelId", seed: int | None = None
) -> DataFrame:
    """For each class the ``need`` rows of ``df`` with the smallest sample key: ``(label, key, hash)``.

    ``need`` is a ``(label, need)`` table with one row per class. Exact for any data, and no other column of ``df`` is read.
    Rows below the boundary slice (:func:`boundary_slices`) are chosen where they are; no task ranks the rows of a class.
    """
    keyed = df.select(label, key, sample_key(key, seed).alias("hash"))
    slices = boundary_slices(keyed, need, label)
    below = keyed.join(broadcast_if_small(slices), label).where(F.col("hash") < F.col("bound")).select(label, key, "hash")
    edge = _edge(keyed, slices, label, key)
    each = edge.select(label, key, "hash", F.explode(F.sequence(F.lit(1).cast("long"), "taken")).alias("_copy"))
    return below.unionByName(each.drop("_copy"))


def rebalance_validation(
    df: DataFrame,
    target: int = VAL_TARGET_PER_CLASS,
    key: str = "sourcePath",
    classes: Sequence[int] | None = DEFAULT_CLASSES,
    label: str = "labelId",
    split: str = "split",
    seed: int | None = None,
    on_shortfall: str = "error",
) -> DataFrame:
    """Move a fixed sample of train rows to ``val`` until each class has ``target`` rows there.

    Rows of ``val`` and ``test`` keep their split. The sample is the head of the
    hash order, so one cut-off per class, found by radix selection, decides for every row in place: the
    wide rows are neither shuffled nor joined by key. The cut-offs are found at
    once and written down, so later uses of the result do not repeat the search.
    With ``on_shortfall="take_all"`` a class that is too small gives what it has.
    ``key`` must identify the rows: a key that is chosen twice for a class is an error.
    """
    need = val_missing(df, target, classes, label, split)
    if on_shortfall == "error":
        text = F.concat(
            F.lit("not enough train rows for class "), F.col(label).cast("string"),
            F.lit(": required "), F.col("missing").cast("string"),
            F.lit(", available "), F.col("inTrain").cast("string"),
        )
        asked = F.when(F.col("missing") > F.col("inTrain"), F.raise_error(text).cast("long")).otherwise(
            F.col("missing")
        )
    elif on_shortfall == "take_all":
        asked = F.col("missing")
    else:
        raise ValueError(f"on_shortfall must be 'error' or 'take_all', not {on_shortfall!r}")
    train = df.where(F.col(split) == "train").select(label, key, sample_key(key, seed).alias("hash"))
    slices = boundary_slices(train, need.select(label, asked.alias("need")), label)
    edge = _edge(train, slices, label, key).groupBy(label).agg(F.max(F.struct("hash", key)).alias("_edge"))
    kind = df.schema[key].dataType
    beneath = F.struct(F.col("bound").alias("hash"), F.lit(None).cast(kind).alias(key))
    cut = settle(slices.join(edge, label, "left").select(label, F.coalesce("_edge", beneath).alias("_cut")))
    few = broadcast_if_small(cut)
    chosen = train.join(few, label).where(F.struct("hash", key) <= F.col("_cut"))
    again = chosen.groupBy(label, key).agg(F.count("*").alias("_n")).where("_n > 1").head(1)
    if again:
        raise ValueError(f"repeated key {again[0][key]}")
    marked = df.join(few, label, "left")
    moves = (F.col(split) == "train") & (F.struct(sample_key(key, seed).alias("hash"), F.col(key)) <= F.col("_cut"))
    changed = F.when(moves, "val").otherwise(F.col(split))
    return marked.withColumn(split, changed).select(*df.columns)


def remove_selected(df: DataFrame, selected: DataFrame, key: str = "sourcePath") -> DataFrame:
    """Rows of ``df`` whose key is not among the selected ones."""
    return df.join(selected.select(key).distinct(), key, "left_anti").select(*df.columns)


def reassemble(*frames: DataFrame | None) -> DataFrame:
    """All rows of the given frames; absent frames are skipped."""
    present: Iterable[DataFrame] = [f for f in frames if f is not None]
    return reduce(DataFrame.unionByName, present)


# ---- checks and tensors ----------------------------------------------------


def feature_violations(df: DataFrame, channels: int = 1) -> DataFrame:
    """Rows whose vector does not hold width x height x channels values."""
    expected = F.col("featureWidth") * F.col("featureHeight") * channels
    size = F.size("features")
    return df.where(~size.eqNullSafe(expected)).select(
        "sourcePath", size.alias("actual"), expected.alias("expected")
    )


# ---- order and numbering ---------------------------------------------------


def training_batches(
    df: DataFrame, batch_size: int = TRAIN_BATCH_SIZE, seed: int = SAMPLE_SEED, key: str = "sourcePath"
) -> DataFrame:
    """Shuffle rows by a seeded hash and number batches of consecutive rows.

    Only the keys are sorted and numbered; the wide rows move once, in the join. Rows that share a key are told apart by
    a number of their own, so every row gets one position; which of them comes first is left open.
    """
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0))).alias("_nth")
    keys = df.select(key, nth).withColumn("_order", sample_key(key, seed))
    numbered = with_row_index(keys, "_order", key, "_nth", name="position").drop("_order")
    placed = df.select("*", nth).join(numbered, [key, "_nth"]).drop("_nth")
    return placed.withColumn("batchNo", F.floor(F.col("position") / batch_size))


def load_set(originals: DataFrame, n: int, key: str = "path", extension: str = "jpeg") -> DataFrame:
    """``n`` uniquely named rows that cycle over the originals in key order."""
    indexed = with_row_index(originals, key, name="_index")
    total = indexed.count()
    if total == 0:
        raise ValueError("no originals to cycle over")
    # Fixed value: the name format.
    names = originals.sparkSession.range(n).select(
        F.format_string(f"stress_%06d.{extension}", "id").alias("fileName"),
        F.pmod("id", F.lit(total)).alias("_index"),
    )
    return names.join(indexed, "_index").drop("_index")
