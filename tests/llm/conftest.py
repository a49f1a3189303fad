import pytest

from tests.llm.brute import SCHEMA, VECTORS, edge_rows, edge_vectors
from upcheck.session import scratch_path


@pytest.fixture(scope="session")
def edge_dir(spark):
    """A folder with the awkward documents, and labels for some of them."""
    path = scratch_path(spark, "edge")
    spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(26 * 3, 1), (21, 0), (24, 0), (24, None), (9999, 1), (None, 1)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(edge_vectors(), VECTORS).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.fixture(scope="session")
def edge(spark, edge_dir):
    """Its (doc_id, text) rows."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty_dir(spark):
    path = scratch_path(spark, "empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], VECTORS).write.parquet(f"{path}/embeddings.parquet")
    return path
