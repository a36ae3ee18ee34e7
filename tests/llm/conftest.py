import pytest
from llm_samples import DOCS


@pytest.fixture
def make_docs(spark):
    """Documents table of texts, with clashing extra columns if asked for."""
    def make(texts, ids=None, extra=False):
        ids = list(range(len(texts))) if ids is None else ids
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)], DOCS)
        if extra:
            for name in ("key", "node", "score", "margin", "lines_", "n_lines", "n_removed", "gone_lines", "toxicity", "shingle", "item", "pieces"):
                df = df.selectExpr("*", f"'keep' AS {name}")
        return df.repartition(3)
    return make


@pytest.fixture
def tables(spark, tmp_path):
    """A folder of tables like those given: tables(documents=df, ...)."""
    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write
