import json

from pyspark.sql import Row

from barlake.operators.normalize import (decode_rejects, decode_trades, encode_trades, normalize_rejects,
                                         normalize_trades)


def payload(**changed):
    return {"e": "trade", "E": 1650000000123, "s": "SOLEUR", "t": 987, "p": "31.25", "q": "4.5",
            "T": 1650000000100, "m": True} | changed


def messages(spark, *values):
    texts = [v if isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame([Row(msg_id=i, value=t) for i, t in enumerate(texts)])


def test_wrapped_and_bare_payloads_read_alike(spark):
    df = messages(spark, {"stream": "soleur@trade", "data": payload()}, payload())
    a, b = normalize_trades(df, keep=("msg_id",)).orderBy("msg_id").collect()
    for r in (a, b):
        assert (r.symbol, r.trade_id, r.price, r.quantity) == ("soleur", 987, 31.25, 4.5)
        assert (r.trade_time, r.is_buyer_maker) == (1650000000100, True) and r.ingest_time > 0


def test_messages_that_are_no_trades_are_skipped(spark):
    df = messages(spark, payload(e="kline"), {"data": payload(e="aggTrade")}, {"result": None, "id": 1}, {},
                  {"id": 7, "note": "an \"escaped\" text"})
    assert normalize_trades(df).count() == 0
    assert normalize_rejects(df).count() == 0


def test_unreadable_text_and_bad_fields_are_rejected(spark):
    no_price = payload()
    del no_price["p"]
    df = messages(spark, "{oops", "", "[1, 2]", no_price, payload(q="x1"), payload(), "null")
    got = {r.msg_id: r.reason for r in normalize_rejects(df, keep=("msg_id",)).collect()}
    assert got == {0: "malformed", 1: "malformed", 2: "malformed", 3: "bad_field", 4: "bad_field", 6: "malformed"}
    assert [r.msg_id for r in normalize_trades(df, keep=("msg_id",)).collect()] == [5]


def test_escaped_symbol(spark):
    text = json.dumps(payload()).replace("SOLEUR", "S\\u004fLEUR")
    assert normalize_trades(messages(spark, text)).first().symbol == "soleur"


def test_encode_decode_roundtrip(spark):
    trades = normalize_trades(messages(spark, payload()), with_ingest_time=False)
    recs = encode_trades(trades)
    r = recs.first()
    assert r.key == "soleur" and json.loads(r.value)["trade_id"] == 987
    back = decode_trades(recs.select("value")).first()
    assert back.price == 31.25 and str(back.event_ts).startswith("2022-04-15 05:20:00.1")


def test_decode_leaves_out_what_decode_rejects_keeps(spark):
    df = spark.createDataFrame([Row(value=v) for v in (
        "garbage", None, '{"symbol":"a"}', '{"trade_time":1}', '{"symbol":"a","trade_time":1}')])
    assert decode_trades(df).count() == 1
    rejected = decode_rejects(df)
    assert rejected.count() == 4
    assert sorted(r.reason for r in rejected.collect()) == ["malformed", "malformed", "no_event_time", "no_symbol"]
