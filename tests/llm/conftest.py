import pytest

from weekloom.session import share_code

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark):
    """Whole tables of the smallest folder, read by name."""
    share_code(spark)
    return lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows, ties, and extra columns with clashing names."""
    share_code(spark)
    long_text = "Alpha beta gamma delta " * 40_000
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again", "en"),
        (1, "the quick brown fox jumps over the lazy dog again and again", "en"),
        (2, "the quick brown fox jumps over the lazy dog again and again", "de"),
        (2, "same id, other text", None),
        (None, "no id at all but mail me at a.b@c.example", None),
        (None, None, None),
        (3, None, "en"),
        (4, "", "en"),
        (5, " \n\t ", "en"),
        (6, "één ßtraße ÉÀ 漢字 \U0001f600 token = 'abcdefghijklmnop'", "xx"),
        (7, long_text, "en"),
        (8, "7" * 60_000 + " " + "1.2.3.4." * 5_000 + " " + "a" * 60_000, "en"),
    ]
    text = [(*r, 1.0, "row", 2, "key", 5, "d", 7, 8, 9) for r in rows]
    return spark.createDataFrame(text, "doc_id long, text string, lang string, score double, row string, fp int, text_key string, label int, data string, features int, piece int, learnt int")
