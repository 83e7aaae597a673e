import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old barn near the quiet river bend today"


@pytest.fixture
def frame(spark):
    def make(rows, schema=DOCS):
        if schema == DOCS:
            rows = [(r + (None,) * 5)[:5] for r in rows]
        return spark.createDataFrame(rows, schema)
    return make


@pytest.fixture
def edge_docs(frame):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns whose names the operators use."""
    long = " ".join(f"w{k % 977} {PROSE}" for k in range(3000))
    rows = [(1, PROSE, "en", "a", 1), (1, PROSE, "en", "a", 1), (2, None, "en", "a", None), (3, "", None, None, 0), (None, PROSE, None, "a", 2),
            (4, long, "en", None, 3), (5, "   \n\t ", "en", "a", 4), (6, "Ünïcode 日本語 😀 x", "de", "b", 5), (7, PROSE, "en", "a", 6), (7, "other words here", "en", "a", 6)]
    return frame([r + (9, "s", 1.5, True) for r in rows],
                 "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, n_tokens string, score double, _h boolean")


@pytest.fixture
def empty_docs(frame):
    return frame([])


def table(sf, name):
    import pyarrow.parquet as pq
    return pq.read_table(f"/root/testdata/{sf}/{name}.parquet").to_pandas()
