import time

from pyspark.sql import functions as F

from barlake.operators.normalize import decode_trades, encode_trades
from barlake.plans import catalog
from barlake.streaming import bars_stream
from barlake.streaming import files as sfiles
from tests.conftest import SF_SMALL

WIDTH = "1 hour"


def _bars(spark, path):
    df = sfiles.ntz_bars(spark.read.parquet(path))
    return sorted((r.symbol, str(r.window_start), r.trade_count, r.open, r.close) for r in df.collect())


def _run(spark, src_dir, base):
    src = decode_trades(sfiles.record_stream(spark, src_dir))
    q = bars_stream.start_parquet_sink(bars_stream.stream_bars(src, WIDTH), f"{base}/bars", f"{base}/chk",
                                       available_now=True)
    q.awaitTermination()
    return q


def test_stream_equals_batch_minus_open_windows(spark, tmp_dir):
    trades = catalog.trades(spark, SF_SMALL)
    sfiles.write_record_files(trades, f"{tmp_dir}/in", 4)
    _run(spark, f"{tmp_dir}/in", tmp_dir)
    batch = catalog.bars(spark, SF_SMALL)
    max_ts = trades.agg(F.max("event_ts")).first()[0]
    import datetime as dt
    cutoff = max_ts.replace(microsecond=(max_ts.microsecond // 1000) * 1000) - dt.timedelta(seconds=30)
    expected = sorted((r.symbol, str(r.window_start), r.trade_count, r.open, r.close)
                      for r in batch.where(F.col("window_end") <= F.lit(cutoff)).collect())
    assert _bars(spark, f"{tmp_dir}/bars") == expected


def test_late_rows_dropped_and_counted(spark, tmp_dir):
    trades = catalog.trades(spark, SF_SMALL)
    sfiles.write_record_files(trades, f"{tmp_dir}/in", 3)
    _run(spark, f"{tmp_dir}/in", tmp_dir)
    before = _bars(spark, f"{tmp_dir}/bars")
    # a late file: the earliest rows again, far behind the watermark
    late = trades.orderBy("event_ts").limit(14).withColumn("trade_id", F.col("trade_id") + 10**9)
    encode_trades(late).coalesce(1).write.mode("append").json(f"{tmp_dir}/in")
    late_rows = bars_stream.LateRows()
    spark.streams.addListener(late_rows)
    try:
        q = _run(spark, f"{tmp_dir}/in", tmp_dir)
        assert _bars(spark, f"{tmp_dir}/bars") == before
        for _ in range(100):                              # reports arrive behind the batch
            if late_rows.of(q) > 0:
                break
            time.sleep(0.1)
        assert late_rows.of(q) > 0
    finally:
        spark.streams.removeListener(late_rows)


def test_late_rows_total_survives_more_reports_than_spark_keeps():
    from types import SimpleNamespace as N
    late_rows = bars_stream.LateRows()
    for k in range(250):
        late_rows.onQueryProgress(N(progress=N(runId="r", stateOperators=[N(numRowsDroppedByWatermark=1),
                                                                         N(numRowsDroppedByWatermark=k % 2)])))
    assert late_rows.of(N(runId="r")) == 250 + 125


def test_processing_time_trigger(spark, tmp_dir):
    trades = catalog.trades(spark, SF_SMALL)
    sfiles.write_record_files(trades, f"{tmp_dir}/in", 2)
    src = decode_trades(sfiles.record_stream(spark, f"{tmp_dir}/in"))
    q = bars_stream.start_raw_sink(src, f"{tmp_dir}/lake", f"{tmp_dir}/chk", trigger="1 second")
    try:
        for _ in range(300):
            if q.lastProgress is not None and q.lastProgress.batchId >= 1:
                break
            time.sleep(0.2)
        assert q.isActive and q.lastProgress.batchId >= 1
    finally:
        q.stop()
    assert spark.read.parquet(f"{tmp_dir}/lake/raw/trades").count() == trades.count()


def test_undecodable_records_get_a_sink(spark, tmp_dir):
    trades = catalog.trades(spark, SF_SMALL)
    sfiles.write_record_files(trades, f"{tmp_dir}/in", 2)
    bad = ['garbage', '{"trade_id":1,"price":2.0}', '{"symbol":"a","price":2.0}', '{"trade_time":5,"price":2.0}']
    spark.createDataFrame([("k", b) for b in bad], "key string, value string").coalesce(1) \
        .write.mode("append").json(f"{tmp_dir}/in")
    stream = sfiles.record_stream(spark, f"{tmp_dir}/in")
    for q in bars_stream.start_record_pipeline(stream, f"{tmp_dir}/lake", f"{tmp_dir}/chk", width=WIDTH,
                                               available_now=True):
        q.awaitTermination()
    got = {r.value: r.reason for r in spark.read.json(f"{tmp_dir}/lake/rejects/records").collect()}
    assert got == dict(zip(bad, ["malformed", "malformed", "no_event_time", "no_symbol"]))
    assert spark.read.parquet(f"{tmp_dir}/lake/raw/trades").count() == trades.count()


def test_wall_clock_watermark_is_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 12:00:00' AS event_ts")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        at = bars_stream.watermarked(df).select(F.unix_micros("event_ts")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert at == 1_704_110_400_000_000


def test_restart_on_same_checkpoint(spark, tmp_dir):
    trades = catalog.trades(spark, SF_SMALL)
    paths = sfiles.write_record_files(trades, f"{tmp_dir}/all", 4)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(paths[0]).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{tmp_dir}/in"))
    for p in paths[:2]:
        fs.rename(jvm.org.apache.hadoop.fs.Path(p), jvm.org.apache.hadoop.fs.Path(f"{tmp_dir}/in/" + p.split("/")[-1]))
    _run(spark, f"{tmp_dir}/in", tmp_dir)
    for p in paths[2:]:
        fs.rename(jvm.org.apache.hadoop.fs.Path(p), jvm.org.apache.hadoop.fs.Path(f"{tmp_dir}/in/" + p.split("/")[-1]))
    sfiles.order_files(spark, f"{tmp_dir}/in", base_ms=2_000_000_000_000)
    _run(spark, f"{tmp_dir}/in", tmp_dir)
    ref = f"{tmp_dir}/ref"
    sfiles.write_record_files(trades, f"{ref}/in", 4)
    _run(spark, f"{ref}/in", ref)
    assert _bars(spark, f"{tmp_dir}/bars") == _bars(spark, f"{ref}/bars")


def test_two_queries_share_one_source(spark, tmp_dir):
    trades = catalog.trades(spark, SF_SMALL)
    sfiles.write_record_files(trades, f"{tmp_dir}/in", 2)
    src = decode_trades(sfiles.record_stream(spark, f"{tmp_dir}/in"))
    spark.streams.resetTerminated()
    raw, bars = bars_stream.start_pipeline(src, f"{tmp_dir}/lake", f"{tmp_dir}/chk", width=WIDTH,
                                           available_now=True)
    assert bars_stream.await_any(spark, 300)          # returns once either query has ended
    raw.awaitTermination()
    bars.awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/lake/raw/trades").count() == trades.count()
    assert spark.read.parquet(f"{tmp_dir}/lake/features/bars").count() > 0


def test_rocksdb_state_store(spark, tmp_dir):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    try:
        bars_stream.use_rocksdb_state(spark)
        assert spark.conf.get(key) == bars_stream.ROCKSDB_PROVIDER
        trades = catalog.trades(spark, SF_SMALL)
        sfiles.write_record_files(trades, f"{tmp_dir}/in", 2)
        _run(spark, f"{tmp_dir}/in", tmp_dir)
        ref = f"{tmp_dir}/ref"
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
        sfiles.write_record_files(trades, f"{ref}/in", 2)
        _run(spark, f"{ref}/in", ref)
        assert _bars(spark, f"{tmp_dir}/bars") == _bars(spark, f"{ref}/bars")
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_raw_messages_stream(spark, tmp_dir):
    from barlake import fixtures as fx
    from barlake.operators.normalize import normalize_trades
    events = fx.table(spark, SF_SMALL, "events")
    msgs = fx.messages_from_events(events)
    (msgs.join(events.select(F.col("event_id").alias("msg_id"), "ts"), "msg_id")
     .repartitionByRange(3, "ts").sortWithinPartitions("ts").select("value")
     .write.mode("overwrite").text(f"{tmp_dir}/msgs"))
    sfiles.order_files(spark, f"{tmp_dir}/msgs")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{tmp_dir}/msgs")
    qs = bars_stream.start_message_pipeline(stream, f"{tmp_dir}/lake", f"{tmp_dir}/chk", width=WIDTH,
                                            available_now=True)
    for q in qs:
        q.awaitTermination()
    assert spark.read.json(f"{tmp_dir}/lake/rejects/messages").count() == events.where("event_id % 101 = 0").count()
    batch = normalize_trades(msgs, with_ingest_time=False)
    assert spark.read.parquet(f"{tmp_dir}/lake/raw/trades").count() == batch.count()
    assert spark.read.parquet(f"{tmp_dir}/lake/features/bars").count() > 0


def test_state_partitions_fixed_in_checkpoint(spark, tmp_dir):
    import glob
    import json as js
    trades = catalog.trades(spark, SF_SMALL)
    sfiles.write_record_files(trades, f"{tmp_dir}/in", 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    src = decode_trades(sfiles.record_stream(spark, f"{tmp_dir}/in"))
    q = bars_stream.start_parquet_sink(bars_stream.stream_bars(src, WIDTH), f"{tmp_dir}/bars", f"{tmp_dir}/chk",
                                       available_now=True, state_partitions=3)
    q.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    offsets = sorted(glob.glob(f"{tmp_dir}/chk/offsets/[0-9]*"))
    meta = js.loads(open(offsets[0]).read().split("\n")[1])
    assert meta["conf"]["spark.sql.shuffle.partitions"] == "3"
