import pytest
from pyspark.sql import functions as F

from millrace.llm.batches import importable

# Names that operators use inside; a table may have columns called the same.
CLASHES = ["d", "h", "n", "s", "id", "at", "key", "band", "keys", "gone", "__gone", "__d", "n_lines", "data", "t", "group", "part"]


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) pairs, with clashing extra columns."""

    def make(rows, extra=True, partitions=3):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(partitions)
        for name in CLASHES if extra else []:
            df = df.withColumn(name, F.lit("x"))
        return df

    return make


@pytest.fixture
def words():
    """Deterministic made-up prose: words(seed, count)."""

    def make(seed, count):
        state, out = seed * 7919 + 17, []
        for _ in range(count):
            state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
            out.append("".join("abcdefghijklmnopqrstuvwxyz"[(state >> (8 + 5 * k)) % 26] for k in range(3 + (state >> 60) % 6)))
        return " ".join(out)

    return make
