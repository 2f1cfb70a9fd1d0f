from sparkwright.operators import tune
from sparkwright.plans import common
from sparkwright.session import scratch_path
from sparkwright.streaming import score_stream
from conftest import SF_SMALL


def test_fitted_pipeline_scores_a_stream(spark):
    train, test = common.split(spark, SF_SMALL)
    fitted = tune.regression_stages("org", (), ("km",)).fit(train)
    path = scratch_path(spark, "stream-in")
    test.select("event_id", "org", "km", "duration").write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    q = (score_stream(fitted, stream, ["event_id", "prediction"]).writeStream
         .format("memory").queryName("scored_stream").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = {r.event_id: r.prediction for r in spark.sql("select * from scored_stream").collect()}
    want = {r.event_id: r.prediction for r in fitted.transform(test).select("event_id", "prediction").collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
