import pytest
from pyspark import cloudpickle

from quotemill import llm

# The functions travel with the tasks; executors need no copy of the package.
cloudpickle.register_pickle_by_value(llm)

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def build(rows, extra=""):
        full = [(*row[:2], *(row[2:] or ("en", "src0")), len(row[1] or "")) for row in rows]
        frame = spark.createDataFrame(full, DOCUMENTS)
        for name in extra.split():
            frame = frame.selectExpr("*", f"'x' AS {name}")
        return frame

    return build


def bag(frame):
    return sorted(map(tuple, frame.collect()), key=repr)
