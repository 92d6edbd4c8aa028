from pyspark.sql import functions as F

from eventide.functions import columns as C


def test_event_key_cases(spark):
    rows = [("enwiki", "Albert Einstein"), ("dewiki", "Über_die_speziellen_Relativitätstheorie"), ("", "")]
    df = spark.createDataFrame(rows, "wiki string, title string")
    got = [r[0] for r in df.select(C.event_key()).collect()]
    assert got == ["enwiki/Albert Einstein", "dewiki/Über_die_speziellen_Relativitätstheorie", "/"]


def test_null_parts_give_empty_strings(spark):
    df = spark.createDataFrame([(None, None)], "wiki string, title string")
    assert df.select(C.event_key()).first()[0] == "/"


def test_timestamp_round_trip_utc(spark):
    df = spark.createDataFrame([(1718000000,)], "parsed_timestamp long")
    r = df.select(C.utc_text().alias("t"), C.utc_to_epoch(C.epoch_to_utc()).alias("e"),
                  C.dt_col("parsed_timestamp").alias("dt"), C.hour_col("parsed_timestamp").alias("h")).first()
    assert r.t == "2024-06-10 06:13:20"
    assert r.e == 1718000000
    assert (r.dt, r.h) == ("2024-06-10", "06")


def test_utc_text_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(1718000000,)], "parsed_timestamp long")
        assert df.select(C.utc_text()).first()[0] == "2024-06-10 06:13:20"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_should_dlq_table(spark):
    cases = [(0, 3, False), (2, 3, False), (3, 3, True), (5, 3, True), (0, 5, False), (5, 5, True)]
    df = spark.createDataFrame(cases, "c int, m int, want boolean")
    for r in df.select(C.should_dlq("c", F.col("m")).alias("got"), "want").collect():
        assert r.got == r.want


def test_error_type_table(spark):
    cases = [("decode error: short message", "decode_error"), ("unmarshal failed", "decode_error"),
             ("parse schema", "decode_error"), ("write to sink failed", "sink_error"),
             ("flush error: connection reset", "sink_error"), ("connection refused", "unknown")]
    df = spark.createDataFrame(cases, "error_message string, want string")
    for r in df.select(C.error_type().alias("got"), "want").collect():
        assert r.got == r.want


def test_header_first_match_and_missing(spark):
    h = "array<struct<key:string,value:binary>>"
    df = spark.sql(f"""SELECT CAST(array(named_struct('key','x-error-type','value',CAST('decode_error' AS BINARY)),
                                      named_struct('key','x-error-message','value',CAST('parse failed' AS BINARY)),
                                      named_struct('key','x-original-topic','value',CAST('recentchanges' AS BINARY)),
                                      named_struct('key','x-error-type','value',CAST('older' AS BINARY)))
                                AS {h}) AS headers
                       UNION ALL
                       SELECT CAST(array(named_struct('key','x-original-topic','value',CAST('test' AS BINARY)))
                                AS {h})""")
    got = [r[0] for r in df.select(C.header(C.H_ERROR_TYPE)).collect()]
    assert got == ["decode_error", ""]


def test_estimated_bytes_counts_utf8(spark):
    cols = C.SIZE_STRING_COLUMNS
    df = spark.createDataFrame([tuple(["é"] + [""] * (len(cols) - 1))], ", ".join(f"{c} string" for c in cols))
    assert df.select(C.estimated_bytes()).first()[0] == 64 + 2


def test_change_event_time_ignores_session_zone(spark):
    from eventide.sources.tables import change_events_from
    ev = spark.sql("""SELECT 1L AS event_id, TIMESTAMP_NTZ'2024-07-01 12:34:56.9' AS ts, 3L AS user_id,
                             'edit' AS event_type, 1.0 AS value, '{"k": 5}' AS props""")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = []
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got.append(change_events_from(ev).select("timestamp").first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1719837296] * 3
