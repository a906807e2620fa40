import os

from orchard.operators import sparse
from orchard.plans import prepared as P
from orchard.streaming.score import score_pages_stream, start_sink
from conftest import SF_SMALL


def test_stream_scoring_matches_batch(spark, tmpdir_fresh):
    prep = P.pages(spark, SF_SMALL, nb=True)
    m = sparse.fit_sparse_naive_bayes(prep.part("train"), prep.features, 5.0)
    from orchard.sources import views as V
    src = os.path.join(tmpdir_fresh, "in")
    V.page_score(spark, SF_SMALL).write.parquet(src)
    static = V.page_score(spark, SF_SMALL)
    stream = spark.readStream.schema(static.schema).parquet(src)
    q = start_sink(score_pages_stream(stream, prep.features, m), os.path.join(tmpdir_fresh, "out"),
                   os.path.join(tmpdir_fresh, "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    got = {(r.doc_id, r.prediction) for r in spark.read.parquet(os.path.join(tmpdir_fresh, "out")).collect()}
    want = {(r.doc_id, r.prediction) for r in m.transform(prep.score).collect()}
    assert got == want
