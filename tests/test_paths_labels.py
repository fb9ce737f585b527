import pytest
from pyspark.sql import functions as F

from tidelight.functions.labels import class_id, class_id_error, class_name, with_target_class
from tidelight.functions.paths import (
    has_target,
    image_glob,
    keep_images,
    keep_labeled,
    relative_target,
    strip_scheme,
    unify_separators,
    with_path_columns,
)

PATHS = [
    "file:/data/set/train/NORMAL/IM-1.jpeg",
    "data\\set\\val\\PNEUMONIA\\person2_virus_3.JPG",
    "test/PNEUMONIA/person1_bacteria_2.png",
    "NORMAL/short.png",
    "alone.jpeg",
    "misc/NORMAL/a.jpeg",
    "train/OTHER/a.jpeg",
    "train/normal/a.jpeg",
    "train/NORMAL/noext",
    "train/NORMAL/jpg",
    "train/NORMAL/x.jpg.txt",
    "train.jpg/NORMAL",
    "a/b.jpg/train/NORMAL/c.PNG",
    "xtrain/NORMAL/c.png",
]


@pytest.fixture(scope="module")
def files(spark):
    return with_path_columns(spark.createDataFrame([(p,) for p in PATHS], "path string"))


def test_columns_come_from_the_last_segments(files):
    rows = {r.path: r for r in files.collect()}
    full = rows[PATHS[1]]
    assert (full.split, full.label, full.fileName, full.extension) == ("val", "PNEUMONIA", "person2_virus_3.JPG", "jpg")
    assert (rows["NORMAL/short.png"].split, rows["NORMAL/short.png"].label) == (None, "NORMAL")
    assert (rows["alone.jpeg"].label, rows["alone.jpeg"].fileName) == (None, "alone.jpeg")
    assert rows["train/NORMAL/noext"].extension == "noext"


def test_the_class_pattern_equals_the_resolved_id(files):
    resolved = {r.path for r in with_target_class(files).where("labelId IS NOT NULL").collect()}
    assert {r.path for r in files.where(has_target(F.col("path"))).collect()} == resolved and len(resolved) > 4


def test_path_patterns_equal_the_column_filters(files):
    """The pushed-down patterns keep exactly what the derived columns would."""
    by_column = F.col("extension").isin("jpg", "jpeg", "png")
    images = {r.path for r in files.where(by_column).collect()}
    assert {r.path for r in keep_images(files).collect()} == images
    labeled = (
        by_column & (F.size("segments") >= 3) & F.col("split").isin("train", "test", "val")
        & F.col("label").isin("NORMAL", "PNEUMONIA")
    )
    expected = {r.path for r in files.where(labeled).collect()}
    assert {r.path for r in keep_labeled(files).collect()} == expected
    assert len(expected) == 5


def test_other_vocabulary_is_taken_literally(spark):
    df = spark.createDataFrame([("a/t+/x.y/f.tif",), ("a/tt/xzy/f.tif",)], "path string")
    assert [r.path for r in keep_labeled(df, ["t+"], ["x.y"], ["tif"]).collect()] == ["a/t+/x.y/f.tif"]


def test_small_path_functions(files, spark):
    one = spark.createDataFrame([("file:/a\\b",)], "p string")
    assert one.select(unify_separators(strip_scheme(F.col("p")))).first()[0] == "/a/b"
    row = files.where(F.col("path") == PATHS[2]).select(relative_target("train"), relative_target("infer")).first()
    assert tuple(row) == ("test/PNEUMONIA/person1_bacteria_2.png", "person1_bacteria_2.png")
    with pytest.raises(ValueError):
        relative_target("other")
    assert image_glob(["jpg"]) == "*.{[jJ][pP][gG]}"


@pytest.mark.parametrize(
    "label, name, target, number, error",
    [
        ("NORMAL", "IM-0001.jpeg", "NORMAL", 0, None),
        ("PNEUMONIA", "person1_bacteria_2.jpeg", "PNEUMONIA_BACTERIA", 1, None),
        ("PNEUMONIA", " Person2_VIRUS_3.jpeg ", "PNEUMONIA_VIRUS", 2, None),
        ("PNEUMONIA", "virus_bacteria.png", "PNEUMONIA_BACTERIA", 1, None),
        ("PNEUMONIA", "plain.png", None, None, "Unable to resolve pneumonia subtype from filename : plain.png"),
        ("normal", "x.png", None, None, "Unsupported raw label 'normal' for file: x.png"),
        (None, "x.png", None, None, "Unsupported raw label 'null' for file: x.png"),
    ],
)
def test_class_resolution(spark, label, name, target, number, error):
    df = spark.createDataFrame([(label, name)], "label string, fileName string")
    row = with_target_class(df).first()
    assert (row.targetLabel, row.labelId, row.labelError) == (target, number, error)


def test_ids_and_names(spark):
    row = spark.range(1).select(
        class_name(F.lit(2)), class_name(F.lit(7)), class_id(F.lit("NORMAL")),
        class_id(F.lit("NORMAL"), {"OTHER": 1}), class_id_error(F.lit("NORMAL"), {"OTHER": 1}),
    ).first()
    assert tuple(row) == ("PNEUMONIA_VIRUS", "UNKNOWN", 0, None, "Missing label mapping for 'NORMAL'")
