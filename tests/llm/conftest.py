import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, digest string, fp string, pid string, "
          "bucket string, kept string, length string, shard string, score string, copy_rank string, digest_key string")

LONG = " ".join(f"word{i}" for i in range(30_000))
ODD = [
    (1, None, "en", "a", None), (2, "", None, None, 0), (3, "   \n\t ", "en", "a", 6), (None, "no id here at all", "en", "a", 17),
    (4, LONG, "en", "a", len(LONG)), (5, "same words in every row of this group", "en", "a", 37),
    (5, "same words in every row of this group", "en", "a", 37), (6, "same words in every row of this group", "fr", "b", 37),
    (7, "été ŝ 漢字 🙂 \x00 \x1c", None, "b", 12), (None, None, None, None, None),
]


def frame(spark, rows):
    """Documents with further columns whose names are those that operators use inside."""
    return spark.createDataFrame([tuple(r) + ("x",) * 10 for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
