import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DATA = "/root/testdata/sf0.001"

# Rows that every operator has to cope with, and columns whose names could clash.
ODD_TEXTS = [None, "", " \t\n", "one", "one two", "One  TWO", "x" * 50_000, "a b c d e f g", "a b\nc d  e f g", "ünïcode ñandú Ωmega 中文"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, size string, key string, place string, rank string"


def odd_rows(copies=2):
    """Odd texts, each several times, with repeated rows and null keys."""
    rows = []
    for i, text in enumerate(ODD_TEXTS * copies):
        rows.append((i, text, [None, "en", "fr"][i % 3], [None, "s1", "s2", "é"][i % 4], i, "i", "s", "k", "p", "r"))
    rows.append(rows[3])
    rows += [(None, "one two", None, None, None, None, None, None, None, None)] * 2
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")
