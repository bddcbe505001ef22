"""Plans of the mail and graph jobs: texts tokenised once, earlier rounds deleted."""

import os

from conftest import SF_SMALL
from tripstream import operators as op
from tripstream.sources import fixtures as fx


def test_tf_idf_tokenises_once(spark):
    for docs in (fx.documents(spark, SF_SMALL), fx.documents(spark, SF_SMALL).repartition(16)):
        df = op.tf_idf(docs, "doc_id", "text")
        df.collect()
        final = df._jdf.queryExecution().executedPlan().executedPlan().toString()
        assert final.count("Generate explode") == 1
        assert "ReusedExchange" in final


def test_pagerank_keeps_its_last_table_only(spark):
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    root = base.removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 2.0), ("c", "a", 1.0), ("a", "c", 3.0)],
                                  "src string, dst string, weight double")
    ranks = op.weighted_pagerank(edges, 6, checkpoint_every=2)
    assert abs(sum(r["rank"] for r in ranks.collect()) - 1) < 1e-9
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    new = [d for d in os.listdir(root) if d.startswith("pagerank-") and d not in before]
    assert [os.listdir(os.path.join(root, d)) for d in new] == [["round-6"]]
