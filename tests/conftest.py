import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from webloom.session import build_session
    s = build_session("local[4]", app="webloom-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def pages_df(spark):
    def make(*htmls, urls=None):
        urls = urls or [f"https://example.com/p{i}" for i in range(len(htmls))]
        return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(zip(urls, htmls))],
                                     "page_id bigint, url string, html string")
    return make
