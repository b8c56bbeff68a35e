import pytest
from pyspark.sql import Row, SparkSession

from stockflow.llm.common import small_batches

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm_spark(spark) -> SparkSession:
    small_batches(spark)
    return spark


@pytest.fixture(scope="session")
def make_docs(llm_spark):
    """(id, text) or (id, text, source) rows as a documents table with clashing extra columns."""
    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None)
                for r in rows]
        df = llm_spark.createDataFrame(full, DOC_SCHEMA)
        if extra:
            from pyspark.sql import functions as F
            for c in ("size", "fp", "score", "length", "_g", "taken", "component_id", "u"):
                df = df.withColumn(c, F.lit(7))
        return df
    return make
