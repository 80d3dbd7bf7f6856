"""A corpus pipeline of training-data operators: toxicity, near copies, secrets, mixing, packing."""

from pyspark.sql import DataFrame, SparkSession

from hearthgrid import session
from hearthgrid.llm import common, jaccard, mixing, packing, secrets, toxicity

STAGES = [
    ("toxicity", lambda spark, docs, sf_dir: toxicity.stage(docs, common.table(spark, sf_dir, "labels"))),
    ("near-copies", lambda spark, docs, sf_dir: jaccard.stage(docs)),
    ("secrets", lambda spark, docs, sf_dir: secrets.stage(docs)),
    ("mixing", lambda spark, docs, sf_dir: mixing.stage(docs)),
    ("packing", lambda spark, docs, sf_dir: packing.digest(docs)),
]
#: The stages learn from labels and hash, which SQL cannot express; the tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again as the next one's input.

    What stages have written goes when the application ends.
    """
    docs = common.table(spark, sf_dir, "documents")
    base = session.scratch(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
