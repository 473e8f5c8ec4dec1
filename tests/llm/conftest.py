import os
import random
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

#: Columns that the operators use inside; documents may have columns of these names.
CLASHING = ("key keys block part number n sig loc digest copy rows row size start low high shard slot draws host line_key "
            "sketch words answers n_lines n_dropped payload original shared sha1 bytes ratio verdict rank rarest").split()


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source) rows, with columns whose names the operators use themselves."""

    def make(rows, extra=()):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
        for name in extra:
            df = df.selectExpr("*", f"'clash' AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and long texts, equal rows, equal texts, ties."""
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    base = " ".join(rng.choice(vocabulary) for _ in range(60))
    long = " ".join(rng.choice(vocabulary) for _ in range(30_000))
    changed = base.split()
    changed[30] = "other"
    return [
        (1, base, "a"), (2, base, "b"), (3, base.upper(), "a"), (3, base.upper(), "a"), (4, " ".join(changed), None),
        (5, None, "a"), (6, "", "b"), (7, " \t\n ", None), (8, long, "a"), (9, long + " tail", "b"), (10, "two words", "c"),
        (11, "Two  words", "c"), (None, base, "a"), (None, None, None), (12, "é\u00a0è ñ", "c"), (13, "x" * 50_000, "a"),
        (14, " ".join(changed[10:40]), "d"), (15, "one\nline\n\nmore", "d"),
    ]
