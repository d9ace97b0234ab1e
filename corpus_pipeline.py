"""From raw documents to packed sequences: the stages of the corpus pipeline.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from caseflow.llm.common import store
from caseflow.llm.exact_dedup import keep_one
from caseflow.llm.mixing import mixed_copies
from caseflow.llm.near_dedup import keep_first
from caseflow.llm.packing import pack
from caseflow.llm.quality import keep_good


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark, docs, sf_dir):
    """Of equal texts one stays."""
    return keep_one(docs)


def near(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return keep_first(docs)


def mixing(spark, docs, sf_dir):
    """Documents come as often as the mix takes them."""
    return mixed_copies(docs)


def packing(spark, docs, sf_dir):
    """Token ids in windows, one row per piece."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing", mixing),
    ("packing", packing),
]

# Tokens, perplexities and signatures cannot be computed in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents, each stage's rows stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
