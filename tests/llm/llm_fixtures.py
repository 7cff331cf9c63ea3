"""Fixtures and helpers of these tests. Not a conftest.py: a second module of that
name would hide the one above."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.llm.common import workers_import
    from tessera.session import get_spark
    s = get_spark("local[4]", app="tessera-tests", shuffle_partitions=4, conf={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    workers_import(s)
    yield s


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


#: texts that every operator must take: null, empty, blank, odd characters, ties, repeated and long ones
ODD = [None, "", " \n\t ", "one", "One ONE one", "a\x00b \x1c\x1f \x85 \xa0 é", "x" * 5000, "word " * 9000,
       "<|endoftext|> in <|startoftext|>text", "Ünï çödé 日本語 😀 ßẞ İi", "a\r\nb\r\nb", "one"]


@pytest.fixture(scope="session")
def odd(spark):
    """(doc_id, text, extra columns with clashing names); ids repeat and may be null."""
    rows = [(i if i != 4 else None, t, i, "s") for i, t in enumerate(ODD)] + [(3, "one", 3, "s"), (3, "other words", 3, "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids long, id string")


def empty(df):
    return df.where("1 = 0")


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
