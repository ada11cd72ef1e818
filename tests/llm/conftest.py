import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from words import prose  # noqa: E402

# Extra columns whose names clash with those that operators make up inside.
EXTRA = "id long, fp long, key string, words string, line string, verdict string, text_sha256 string, host string, path string, canonical string, offset long, group long, run long"
DOCS = "doc_id long, text string, lang string, source string, " + EXTRA


def with_extra(*row):
    return (*row, 1, 2, "k", "w", "l", "v", "t", "h", "p", "c", 3, 4, 5)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, extra columns."""
    rng = random.Random(3)
    long_text = prose(rng, 30_000) + " " + "9" * 20_000 + " " + "a." * 2_000 + "\n" * 500
    rows = [
        with_extra(1, None, None, None),
        with_extra(2, "", "en", "s"),
        with_extra(3, " \n\t ", "en", "s"),
        with_extra(4, "Hello there, hello there! x", "en", None),
        with_extra(4, "Hello there, hello there! x", "en", None),
        with_extra(5, "Hello there, hello there! x", None, "s"),
        with_extra(None, "Hello there, hello there! x", "en", "s"),
        with_extra(None, None, None, None),
        with_extra(6, long_text, "en", "s"),
        with_extra(7, "!!! 123 ???", "en", "s"),
        with_extra(8, "Ein Müller <|endoftext|> \u00a0 é\u0301 \U0001f642", "de", "s"),
        with_extra(9, prose(rng, 120) + "\n" + prose(rng, 8), "en", "s"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
