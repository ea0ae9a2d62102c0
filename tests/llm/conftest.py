import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DDL = "doc_id long, text string, lang string, source string, n_chars long, slot string, score string"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session
    s = build_session("local[4]", app_name="ledgerline-llm-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and
    columns whose names clash with results."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [(1, "The quick brown fox.\nfooter", "en", "a"), (1, "The quick brown fox.\nfooter", "en", "a"),
            (2, None, "en", "b"), (3, "", None, None), (4, "12 !! 34", "de", "b"), (None, "No id here\nfooter", "en", None),
            (5, long, "en", "a"), (6, "\n \n", "de", "c"), (1, "another text, same id", None, "c")]
    return spark.createDataFrame([(*r, None, "x", "y") for r in rows], DDL)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DDL)
