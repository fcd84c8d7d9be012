import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text, lang) rows, with extra columns whose
    names clash with those the operators use inside."""
    def make(rows):
        df = spark.createDataFrame([(i, t, la, "s", len(t or "")) for i, t, la in rows],
                                   "doc_id long, text string, lang string, source string, n_chars long")
        return (df.withColumn("fp", F.lit("x")).withColumn("row", F.lit(1)).withColumn("score", F.lit("y"))
                  .withColumn("node", F.lit(2)).withColumn("pos", F.lit(None).cast("int")).withColumn("n", F.lit(3))
                  .withColumn("window", F.lit("w")).withColumn("toxic", F.lit("t")).withColumn("c0", F.lit("c")))
    return make


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
