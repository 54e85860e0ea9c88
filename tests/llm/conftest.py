from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "text string, doc_id bigint, lang string, source string, n_chars bigint, key string, score double, n int"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in any column, empty, white, very long and repeated texts, ties, clashing columns."""
    long = " ".join(f"w{k % 700}x{k // 9}" for k in range(30_000))
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    near = base.replace("upsilon", "omega")
    texts = [
        None, "", " \t\n", base, base, near, base.upper(), long, long + " end", "one two", "one two", "x" * 50_000,
        "a line that repeats\nown line number one\nA line that repeats  \n\n", "a line that repeats\n" * 40, "É é É naïve",
        "Ünïcode line of some length\nÜnïcode line of some length",
    ]
    rows = [(t, i, ["en", None, "de"][i % 3], ["src0", None][i % 2], 3, "k", 0.5, 1) for i, t in enumerate(texts)]
    rows += [rows[3], rows[9], (base, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
