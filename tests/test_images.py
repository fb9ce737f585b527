import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelight.defaults import UNDECODABLE, AugmentConfig
from tidelight.functions import images
from tidelight.plans.inputs import png
from tidelight.sources.files import image_scan


def brute_resample(raster, height, width):
    """Pixel by pixel, straight from the definition of the filter."""

    def kernel(x):
        x = abs(x)
        if x <= 1:
            return 1.5 * x**3 - 2.5 * x**2 + 1
        return -0.5 * x**3 + 2.5 * x**2 - 4 * x + 2 if x < 2 else 0.0

    def line(values, target):
        scale = len(values) / target
        reach = max(scale, 1.0)
        out = []
        for j in range(target):
            center = (j + 0.5) * scale
            ws = [kernel((i + 0.5 - center) / reach) for i in range(len(values))]
            out.append(sum(w * v for w, v in zip(ws, values)) / sum(ws))
        return np.array(out)

    rows = [[line(raster[:, x, c].astype(float), height) for c in range(raster.shape[2])] for x in range(raster.shape[1])]
    tall = np.array(rows).transpose(2, 0, 1)
    out = np.array([[line(tall[y, :, c], width) for c in range(raster.shape[2])] for y in range(height)])
    return np.clip(out.transpose(0, 2, 1), 0, 255)


@pytest.mark.parametrize("shape, target", [((9, 13, 3), (4, 5)), ((3, 4, 1), (7, 6)), ((1, 1, 3), (3, 3)), ((20, 2, 1), (5, 5))])
def test_resampling_equals_brute_force(shape, target):
    raster = np.random.default_rng(0).integers(0, 256, shape).astype(np.uint8)
    got = images.resample(raster, *target).astype(float)
    assert np.abs(got - brute_resample(raster, *target)).max() <= 0.51


def test_modes_place_the_image():
    wide = np.full((2, 4, 1), 200, np.uint8)
    fitted = images.resize(wide, 8, 8, "fit")[..., 0]
    assert (fitted[:2] == 0).all() and (fitted[6:] == 0).all() and (fitted[2:6] == 200).all()
    assert (images.resize(wide, 8, 8, None) == images.resize(wide, 8, 8, "whatever")).all()
    assert (images.resize(wide, 8, 8, " COVER ") == 200).all()
    assert (images.resize(wide, 8, 8, "Scale") == 200).all()
    halves = np.concatenate([np.zeros((4, 2, 1), np.uint8), np.full((4, 8, 1), 90, np.uint8), np.zeros((4, 2, 1), np.uint8)], 1)
    assert (images.resize(halves, 4, 4, "cover") == 90).all()


def test_luminance_weights():
    bgr = np.array([[[0, 0, 255], [0, 255, 0], [255, 0, 0], [255, 255, 255]]], np.uint8)
    assert images.luminance(bgr) == pytest.approx([0.299, 0.587, 0.114, 1.0], abs=1e-6)
    assert images.luminance(np.array([[[51]]], np.uint8)) == pytest.approx([0.2])
    bgra = np.array([[[10, 20, 30, 0]]], np.uint8)
    assert images.luminance(bgra) == images.luminance(bgra[..., :3])


def test_files_are_decoded_or_reported(spark, tmp_path):
    red = png(2, 1, bytes([255, 0, 0, 0, 255, 0]))
    (tmp_path / "deep").mkdir()
    (tmp_path / "_staging").mkdir()
    (tmp_path / "a.png").write_bytes(red)
    (tmp_path / "deep" / "B.PNG").write_bytes(red)
    (tmp_path / "bad.jpg").write_bytes(b"nothing")
    (tmp_path / "note.txt").write_bytes(b"text")
    (tmp_path / "_staging" / "c.png").write_bytes(red)
    done = images.vectorize(image_scan(spark, str(tmp_path)), size=2, mode="scale").collect()
    by_name = {r.path.rpartition("/")[2]: r for r in done}
    assert set(by_name) == {"a.png", "B.PNG", "bad.jpg"}
    assert by_name["a.png"].features == pytest.approx([0.299, 0.587] * 2, abs=1e-6)
    bad = by_name["bad.jpg"]
    assert (bad.ok, bad.featureWidth, bad.features, bad.error) == (False, 0, [], UNDECODABLE)


def test_native_luminance_equals_the_kernel(spark):
    rng = np.random.default_rng(3)
    rows, expected = [], []
    for n, channels in enumerate([1, 3, 4]):
        raster = rng.integers(0, 256, (3, 5, channels)).astype(np.uint8)
        rows.append((n, (f"{n}", 3, 5, channels, 0, raster.tobytes())))
        expected.append(images.luminance(raster).tolist())
    schema = "n int, image struct<origin string, height int, width int, nChannels int, mode int, data binary>"
    df = spark.createDataFrame(rows, schema).withColumn("features", images.luminance_expr())
    assert [r.features for r in df.orderBy("n").collect()] == expected


def features_frame(spark, n=5):
    rng = np.random.default_rng(0)
    rows = [(f"s{k}", 4, 4, rng.random(16).astype(np.float32).tolist()) for k in range(n)]
    return spark.createDataFrame(rows, "sourcePath string, featureWidth int, featureHeight int, features array<float>")


def test_no_distortion_keeps_the_vector(spark):
    df = features_frame(spark)
    still = AugmentConfig(0, 0, 0, 0, 0, 0, 0)
    got = images.augment(df, 2, cfg=still).collect()
    original = {r.sourcePath: r.features for r in df.collect()}
    assert len(got) == 10
    assert all(r.features == pytest.approx(original[r.sourcePath], abs=1e-6) for r in got)


def test_shift_moves_pixels_and_fills_black():
    still = dict.fromkeys(("zoomY", "zoomX", "shiftY", "shiftX", "turn", "contrast", "noise"), 0)
    vector = np.arange(1, 17, dtype=np.float32) / 16
    moved = images._distort(vector, 4, 4, still | {"shiftY": 0.25}, 0).reshape(4, 4)
    assert (moved[0] == 0).all()
    assert moved[1:] == pytest.approx(vector.reshape(4, 4)[:3])


def test_counters_give_normal_numbers_and_their_neighbours_are_independent():
    drawn = images.counter_normals(12345, 200_000)
    assert abs(drawn.mean()) < 0.01 and abs(drawn.std() - 1) < 0.01
    assert abs(np.corrcoef(drawn[:-1], drawn[1:])[0, 1]) < 0.01
    assert (images.counter_normals(12345, 10) == drawn[:10]).all()
    assert np.isfinite(images.counter_normals(2**32 - 1, 1000)).all()


def test_draws_stay_in_their_ranges_and_take_null_keys(spark):
    cfg = AugmentConfig()
    keys = spark.range(2000).select(F.when(F.col("id") > 0, F.concat(F.lit("k"), "id")).alias("key"), F.lit(3).alias("copyNo"))
    got = keys.select(images.drawn_distortion(cfg, "key", 9, "copyNo").alias("d")).select("d.*").toPandas()
    assert not got.isna().any().any() and got.noise.between(0, 2**32 - 1).all()
    for name, low, high in (("zoomY", -0.2, 0.1), ("shiftY", -0.12, 0.12), ("shiftX", -0.1, 0.1), ("turn", -0.04, 0.04), ("contrast", -0.15, 0.15)):
        assert got[name].between(low, high).all() and got[name].nunique() == 2000
        assert abs(got[name].mean() - (low + high) / 2) < 0.1 * (high - low)


def test_copies_depend_on_key_number_and_seed_only(spark):
    df = features_frame(spark)
    first = sorted(map(str, images.augment(df, 3, seed=1).collect()))
    assert first == sorted(map(str, images.augment(df.repartition(4), 3, seed=1).collect()))
    assert first != sorted(map(str, images.augment(df, 3, seed=2).collect()))
