"""Pixels: luminance, resizing, augmentation, and a scan of image files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelight.defaults import AugmentConfig
from tidelight.functions.images import COUNTER_STEP, FIRST_FACTOR, SECOND_FACTOR, augment, luminance_expr, vectorize
from tidelight.operators.dataset import rebalance_validation, split_class_counts
from tidelight.operators.outcomes import train_outcomes
from tidelight.plans import inputs as i
from tidelight.plans.catalog import Catalog
from tidelight.session import settle
from tidelight.sources.files import empty_files, image_scan, landing_files

PLANS = Catalog()

# Single-precision arithmetic in the order of the definition.
PIXELS = f"""{i.BYTES}, pixels AS (SELECT "sourcePath", label, generate_subscripts(b, 1) - 1 AS pixel, unnest(b) AS v
  FROM bytes),
luma AS (SELECT "sourcePath", label, pixel, (0.299::FLOAT * (v * 7 % 256)::FLOAT + 0.587::FLOAT * (255 - v)::FLOAT
  + 0.114::FLOAT * v::FLOAT) / 255::FLOAT AS value FROM pixels)"""


def by_pixel(df, *keep):
    """One row per pixel value, so that results compare value by value."""
    exploded = df.select(*keep, F.posexplode("features").alias("pixel", "value"))
    return exploded.withColumns({"pixel": F.col("pixel").cast("long"), "value": F.col("value").cast("double")})


@PLANS.add(f"""WITH {PIXELS} SELECT "sourcePath", pixel, CAST(value AS DOUBLE) AS value FROM luma""")
def luminance_features(spark, sf_dir):
    images = i.rasters(spark, sf_dir).select("sourcePath", "image")
    return by_pixel(vectorize(images, size=8, mode="scale"), "sourcePath")


@PLANS.add(f"""WITH {PIXELS} SELECT "sourcePath", pixel, CAST(value AS DOUBLE) AS value FROM luma""")
def luminance_native(spark, sf_dir):
    """The same values without a Python worker."""
    images = i.rasters(spark, sf_dir).select("sourcePath", "image")
    return by_pixel(images.withColumn("features", luminance_expr()), "sourcePath")


# Bicubic resampling of each whole document, spelled out per pixel. `inner` is the size after
# scaling and `crop` the part that stays; black margins add nothing to the sum of levels.
def _resized_sql(inner_h: str, inner_w: str) -> str:
    def taps(kind: str, source: str, target: str, crop: str) -> str:
        x = "abs((i + 0.5 - (j + 0.5) * scale) / reach)"
        return f"""{kind}_sizes AS (SELECT DISTINCT {source} AS source, {target} AS target, {crop} AS crop FROM shapes),
{kind}_slots AS (SELECT *, source / target AS scale, greatest(source / target, 1.0) AS reach,
  unnest(range(crop, crop + least(target, 32))) AS j FROM {kind}_sizes),
{kind}_near AS (SELECT *, unnest(range(greatest(0, CAST(floor((j + 0.5) * scale - 2 * reach) AS INT)),
  least(source, CAST(ceil((j + 0.5) * scale + 2 * reach) AS INT)))) AS i FROM {kind}_slots),
{kind}_raw AS (SELECT *, {x} AS x FROM {kind}_near),
{kind}_weight AS (SELECT *, CASE WHEN x <= 1 THEN 1.5 * x * x * x - 2.5 * x * x + 1
  WHEN x < 2 THEN -0.5 * (x * x * x - 5 * x * x + 8 * x - 4) ELSE 0 END AS w FROM {kind}_raw),
{kind}_taps AS (SELECT source, target, j, i, w / sum(w) OVER (PARTITION BY source, target, j) AS w FROM {kind}_weight)"""

    return f"""WITH texts AS (SELECT doc_id, hex(encode(text)) AS digits,
  greatest(1, CAST(ceil(octet_length(encode(text)) / 64.0) AS INT)) AS h FROM documents),
sized AS (SELECT doc_id, h, CAST(greatest(1, {inner_h}) AS INT) AS ih, CAST(greatest(1, {inner_w}) AS INT) AS iw
  FROM texts),
shapes AS (SELECT *, greatest(0, (ih - 32) // 2) AS top, greatest(0, (iw - 32) // 2) AS lft FROM sized),
pairs AS (SELECT doc_id, regexp_extract_all(rpad(digits, h * 128, '20'), '..') AS p FROM texts),
cells AS (SELECT doc_id, generate_subscripts(p, 1) - 1 AS n, CAST('0x' || unnest(p) AS INT) AS v FROM pairs),
{taps("y", "h", "ih", "top")}, {taps("x", "64", "iw", "lft")},
tall AS (SELECT doc_id, t.j AS y, n % 64 AS x, sum(v * t.w) AS v FROM cells JOIN shapes USING (doc_id)
  JOIN y_taps t ON t.source = h AND t.target = ih AND t.i = n // 64 GROUP BY ALL),
small AS (SELECT doc_id, y, t.j AS x, sum(v * t.w) AS v FROM tall JOIN shapes USING (doc_id)
  JOIN x_taps t ON t.target = iw AND t.i = tall.x GROUP BY ALL)
SELECT doc_id, 32 AS "featureWidth", 32 AS "featureHeight", true AS ok,
  CAST(sum(round_even(greatest(0, least(255, round(v, 6))), 0)) AS BIGINT) AS levels FROM small GROUP BY 1"""


def _ratio_sql(pick: str) -> tuple[str, str]:
    ratio = f"{pick}(32 / CAST(h AS DOUBLE), 32 / CAST(64 AS DOUBLE))"
    return f"round_even(h * {ratio}, 0)", f"round_even(64 * {ratio}, 0)"


def _resized(spark, sf_dir, mode):
    files = i.text_rasters(spark, sf_dir)
    done = vectorize(files.repartition("doc_id"), size=32, mode=mode)
    levels = F.aggregate("features", F.lit(0).cast("long"), lambda acc, x: acc + F.rint(x * 255).cast("long"))
    return done.select("doc_id", "featureWidth", "featureHeight", "ok", levels.alias("levels"))


@PLANS.add(_resized_sql(*_ratio_sql("least")))
def resized_fit(spark, sf_dir):
    """Whole documents as grey images, fitted on black."""
    return _resized(spark, sf_dir, "fit")


@PLANS.add(_resized_sql(*_ratio_sql("greatest")))
def resized_cover(spark, sf_dir):
    return _resized(spark, sf_dir, "cover")


@PLANS.add(_resized_sql("32", "32"))
def resized_scale(spark, sf_dir):
    return _resized(spark, sf_dir, "scale")


_LANGS = ("de", "en", "es", "fr")


@PLANS.add("""WITH rows AS (SELECT 'doc_' || doc_id AS path, list_position(['de', 'en', 'es', 'fr'], lang) - 1 AS class,
  CASE WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) IN ('0', '1') THEN 'test'
       WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) = '2' THEN 'val' ELSE 'train' END AS split FROM documents),
need AS (SELECT class, greatest(0, 100 - count(*) FILTER (WHERE split = 'val')) AS missing FROM rows GROUP BY 1),
ranked AS (SELECT path, class, row_number() OVER (PARTITION BY class ORDER BY md5(path), path) AS rank
  FROM rows WHERE split = 'train'),
moved AS (SELECT path FROM ranked JOIN need USING (class) WHERE rank <= missing)
SELECT CASE WHEN path IN (SELECT path FROM moved) THEN 'val' ELSE split END AS split, CAST(class AS INT) AS "labelId",
  count(*) AS images FROM rows GROUP BY 1, 2""")
def feature_store_rebalance(spark, sf_dir):
    """Vectorise every document as an image into a feature store, then fill up the validation split.

    The store is written once; the rebalance reads its key columns only.
    """
    files = i.text_rasters(spark, sf_dir, keep=("lang",))
    digit = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1)
    done = vectorize(files.repartition("doc_id"), size=32, mode="fit").select(
        F.concat(F.lit("doc_"), "doc_id").alias("sourcePath"),
        F.when(digit.isin("0", "1"), "test").when(digit == "2", "val").otherwise("train").alias("split"),
        (F.array_position(F.array(*map(F.lit, _LANGS)), F.col("lang")) - 1).cast("int").alias("labelId"),
        "featureWidth", "featureHeight", "features",
    )
    store = settle(done)
    return split_class_counts(rebalance_validation(store, 100, classes=range(4), on_shortfall="take_all"))


@PLANS.add(f"""WITH {i.FEATURES}, copies AS (SELECT UNNEST([0, 1]) AS "copyNo"),
values AS (SELECT "sourcePath", "copyNo", UNNEST(features) AS value, UNNEST(range(64)) AS pixel FROM features, copies)
SELECT "sourcePath", CAST("copyNo" AS INT) AS "copyNo", CAST(pixel AS INT) AS pixel,
  round(CAST(greatest(0, least(1, value)) AS DOUBLE), 6) AS value FROM values""")
def undistorted_copies(spark, sf_dir):
    """Augmentation whose ranges are all zero gives every vector as it is."""
    still = AugmentConfig(0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)
    copies = augment(i.features(spark, sf_dir).select("sourcePath", "featureWidth", "featureHeight", "features"), 2, cfg=still)
    values = copies.select("sourcePath", "copyNo", F.posexplode("features").alias("pixel", "value"))
    return values.withColumn("value", F.round(F.col("value").cast("double"), 6))


@PLANS.add(f"""WITH {i.FEATURES} SELECT "sourcePath", "labelId", CAST(c AS INT) AS "copyNo", len(features) AS size
FROM features, (SELECT unnest([0, 1]) AS c) WHERE split = 'train'""")
def augmented_rows(spark, sf_dir):
    """Two distorted copies of every train vector."""
    train = i.features(spark, sf_dir).where("split = 'train'")
    copies = augment(train.select("sourcePath", "labelId", "featureWidth", "featureHeight", "features"), copies=2)
    return copies.select("sourcePath", "labelId", "copyNo", F.size("features").alias("size"))


# The distortions spelled out per pixel of an 8 x 8 vector: numbers drawn by MD5 and by mixed counters, bilinear samples.
def _distorted_sql(cfg: AugmentConfig, side: int = 8) -> str:
    def draw(counter: int, low: float, high: float) -> str:
        digits = f"substr(md5(\"sourcePath\" || '|0|' || c || '|{counter}'), 1, 13)"
        return f"({low}::DOUBLE + CAST('0x' || {digits} AS BIGINT) / 4503599627370496.0::DOUBLE * {high - low}::DOUBLE)"

    def uniform(nth: int) -> str:
        return f"((x{nth}d + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"

    def level(down: int, right: int) -> str:
        y, x = f"(CAST(top AS INT) + {down})", f"(CAST(lft AS INT) + {right})"
        inside = f"{y} BETWEEN 1 AND {side} AND {x} BETWEEN 1 AND {side}"
        return f"CASE WHEN {inside} THEN CAST(features[({y} - 1) * {side} + {x}] AS DOUBLE) ELSE 0.0::DOUBLE END"

    half = (side - 1) / 2
    mixed = ", ".join(
        f"CAST((noise + (2 * p + {nth}) * {COUNTER_STEP}::HUGEINT) % 4294967296 AS BIGINT) AS x{nth}a" for nth in (0, 1)
    )
    steps = [("a", "b", 16, f" * {FIRST_FACTOR}::HUGEINT % 4294967296"), ("b", "c", 15, f" * {SECOND_FACTOR}::HUGEINT % 4294967296"), ("c", "d", 16, "")]
    rounds = "\n".join(
        f"mix_{new} AS (SELECT *, " + ", ".join(
            f"CAST(xor(x{nth}{old}, x{nth}{old} >> {shift}){factor} AS BIGINT) AS x{nth}{new}" for nth in (0, 1)
        ) + f" FROM mix_{old}),"
        for old, new, shift, factor in steps
    )
    return f"""drawn AS (SELECT "sourcePath", c, features, 1 + {draw(0, -cfg.zoom_in_max, cfg.zoom_out_max)} AS zy,
  1 + {draw(1, -cfg.zoom_in_max, cfg.zoom_out_max)} AS zx, {draw(2, -cfg.vertical_shift, cfg.vertical_shift)} * {side} AS sy,
  {draw(3, -cfg.horizontal_shift, cfg.horizontal_shift)} * {side} AS sx, {draw(4, -cfg.rotation, cfg.rotation)} * 2 * pi() AS turn,
  1 + {draw(5, -cfg.contrast, cfg.contrast)} AS contrast, CAST('0x' || substr(md5("sourcePath" || '|0|' || c || '|6'), 1, 8) AS BIGINT) AS noise
  FROM features, (SELECT unnest([0, 1]) AS c) WHERE split = 'train'),
pixels AS (SELECT *, unnest(range({side * side})) AS p FROM drawn),
centred AS (SELECT *, p // {side} - {half}::DOUBLE AS y, p % {side} - {half}::DOUBLE AS x FROM pixels),
placed AS (SELECT *,
  greatest(0.0::DOUBLE, least({side + 1}.0::DOUBLE, (cos(turn) * y - sin(turn) * x) * zy + {half}::DOUBLE - sy + 1)) AS py,
  greatest(0.0::DOUBLE, least({side + 1}.0::DOUBLE, (sin(turn) * y + cos(turn) * x) * zx + {half}::DOUBLE - sx + 1)) AS px FROM centred),
cells AS (SELECT *, least(floor(py), {side}) AS top, least(floor(px), {side}) AS lft FROM placed),
parts AS (SELECT *, py - top AS down, px - lft AS rgt FROM cells),
moved AS (SELECT *, ({level(0, 0)}) * (1 - down) * (1 - rgt) + ({level(1, 0)}) * down * (1 - rgt) + ({level(0, 1)}) * (1 - down) * rgt
  + ({level(1, 1)}) * down * rgt AS value FROM parts),
mix_a AS (SELECT *, avg(value) OVER (PARTITION BY "sourcePath", c) AS mean, {mixed} FROM moved),
{rounds}
distorted AS (SELECT "sourcePath", c, p, greatest(0.0::DOUBLE, least(1.0::DOUBLE, (value - mean) * contrast + mean))
  + {cfg.noise_stddev}::DOUBLE * sqrt(-2 * ln({uniform(0)})) * cos(2 * pi() * {uniform(1)}) AS value FROM mix_d)"""


@PLANS.add(f"""WITH {i.FEATURES}, {_distorted_sql(AugmentConfig())}
SELECT "sourcePath", CAST(c AS INT) AS "copyNo", CAST(p AS INT) AS pixel, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 5) AS value FROM distorted""")
def distorted_pixels(spark, sf_dir):
    """Every pixel of two distorted copies of every train vector: zoom, shift, turn, contrast and noise."""
    train = i.features(spark, sf_dir).where("split = 'train'")
    copies = augment(train.select("sourcePath", "featureWidth", "featureHeight", "features"), copies=2)
    values = copies.select("sourcePath", "copyNo", F.posexplode("features").alias("pixel", "value"))
    return values.withColumn("value", F.round(F.col("value").cast("double"), 5))


@PLANS.add(f"""WITH {i.BYTES} SELECT "sourcePath", label,
  CASE label % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS "labelId", label % 3 < 2 AS ok FROM bytes""")
def train_outcome_rows(spark, sf_dir):
    """Labelled images to outcomes: class from folder and file name, failures kept as rows."""
    files = i.rasters(spark, sf_dir).select(
        "sourcePath",
        F.col("label").alias("tableLabel"),
        F.when(F.col("label") % 3 == 0, "NORMAL").when(F.col("label") % 3 == 1, "PNEUMONIA").otherwise("OTHER").alias("label"),
        F.concat(F.lit("bacteria_"), "sourcePath", F.lit(".png")).alias("fileName"),
        "image",
    )
    done = train_outcomes(files, size=8, mode="scale")
    return done.select("sourcePath", F.col("tableLabel").alias("label"), "labelId", "ok")


@PLANS.add(f"""WITH {PIXELS} SELECT "sourcePath", pixel, CAST(value AS DOUBLE) AS value FROM luma WHERE label <> 9""")
def image_file_features(spark, sf_dir):
    """Image files written from the vectors, scanned, decoded and vectorised."""
    scanned = image_scan(spark, i.image_tree(spark, sf_dir))
    name = F.regexp_extract("path", r"([^/]+)\.png$", 1)
    done = vectorize(scanned.select(name.alias("sourcePath"), "image"), size=8, mode="fit")
    return by_pixel(done.where("ok"), "sourcePath")


@PLANS.add("""SELECT concat('vec_', vec_id, '.png') AS "fileName" FROM embeddings""")
def landing_listing(spark, sf_dir):
    """Names in a landing zone; contents are not read."""
    zone = i.image_tree(spark, sf_dir)
    waiting = landing_files(spark, zone).select("fileName")
    return waiting.union(empty_files(spark, zone).select("fileName"))
