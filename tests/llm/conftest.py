"""Documents with every awkward row, and an empty table of the same shape."""

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words int, _m string, `_doc` string, ids string, n_dropped string"


def prose(seed, words):
    rng = random.Random(seed)
    syllables = "an er on th re in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    out = []
    for n in range(words):
        word = "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
        out.append(word.capitalize() if n % 11 == 0 else word + ("." if n % 11 == 10 else ""))
    return " ".join(out)


def awkward_rows():
    license_line = "This text is under a licence that everyone repeats."
    base = prose(1, 120)
    rows = [
        (1, base), (2, base), (3, base.replace("er", "re", 1)), (4, None), (5, ""), (6, " \n\t\n "), (None, prose(2, 60)),
        (None, None), (7, prose(3, 80) + "\n" + license_line), (8, license_line + "\n" + prose(4, 90)),
        (9, "  " + license_line.upper() + "\r\n" + prose(5, 70)), (10, "x" * 20_000), (11, "word " * 4_000), (12, "mail a.b@c.example.org now"),
        (12, "mail a.b@c.example.org now"), (13, "naïve ▁ 日本語\n日本語 text " + prose(6, 50)), (14, prose(7, 3_000)),
        (15, prose(8, 30) + " " + base + " " + prose(9, 30)), (16, "a"), (17, "\n\n\n"),
    ]
    return [
        (doc_id, text, "en", None if doc_id == 9 else f"src{(doc_id or 0) % 3}", -1, 7, "m", "d", "i", "x") for doc_id, text in rows
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.range(0).select(
        F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic")
    )
