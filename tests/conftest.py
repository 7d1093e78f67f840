import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from charloom.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def small_corpus(spark):
    from charloom.sources.tables import corpus_lines
    return corpus_lines(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).cache()


@pytest.fixture(scope="session")
def small_lines(small_corpus):
    return [r.text for r in small_corpus.orderBy("line_id").select("text").collect()]


@pytest.fixture(scope="session")
def small_dev(spark):
    from charloom.sources.tables import dev_from_table
    return dev_from_table(spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).cache()
