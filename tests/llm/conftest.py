import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tablewright.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_session("local[8]", shuffle_partitions=8)


@pytest.fixture(scope="session")
def docs(spark):
    """Rows as the operators may meet them: nulls, empty and long texts, ties, repeats, clashing columns."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(60000))
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (3, base.upper() + "\n\t", "en", None), (4, None, None, None),
            (5, "", "de", "b"), (6, " \t\r\n\x0b\x0c", "de", "b"), (7, "one", "en", "c"), (8, long, "en", "c"),
            (8, long, "en", "c"), (None, base + " ä é ü", "fr", "ß"), (9, "é" * 300 + " x", "fr", "z"), (10, None, "en", "a")]
    return spark.createDataFrame(
        [(i, t, g, s, None if t is None else len(t), "x", 1) for i, t, g, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long, fp string, size int")


def rows_of(df, *order):
    return sorted((tuple(r) for r in df.select(*order).collect()), key=lambda r: [(x is None, x) for x in r])
