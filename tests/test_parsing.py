import os

from eventide.schema import CHANGE_EVENT_V1, CHANGE_EVENT_V2, SchemaMismatch, align_schema
from eventide.sources.json_events import parse_change_event, parse_defaults, sse_frames

FRAME1 = ('{"id":12345,"type":"edit","namespace":0,"title":"Test Page","title_url":"https://en.wikipedia.org/wiki/Test_Page",'
          '"comment":"fix typo","timestamp":1718000000,"user":"Alice","bot":false,"server_url":"https://en.wikipedia.org",'
          '"server_name":"en.wikipedia.org","server_script_url":"/w","wiki":"enwiki"}')
FRAME2 = ('{"id":12346,"type":"new","namespace":0,"title":"Another","comment":"","timestamp":1718000001,'
          '"user":"Bot1","bot":true,"wiki":"frwiki"}')


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "capture.txt"), "w") as f:
        f.write(text)


def test_two_frames_two_events(spark, tmp):
    _write(tmp, f"event: message\nid: 1\ndata: {FRAME1}\n\nevent: message\ndata: {FRAME2}\n\n")
    valid, rejected = parse_change_event(sse_frames(spark, tmp))
    rows = sorted(valid.collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == [12345, 12346]
    assert [r.wiki for r in rows] == ["enwiki", "frwiki"]
    assert [r.bot for r in rows] == [False, True]
    assert rows[1].title_url == "" and rows[1].server_url == "" and rows[1].server_name == ""
    assert rows[0].parsed_timestamp == 1718000000
    assert rejected.count() == 0


def test_malformed_frame_rejected(spark, tmp):
    _write(tmp, "data: {invalid json}\n\n")
    valid, rejected = parse_change_event(sse_frames(spark, tmp))
    assert valid.count() == 0
    r = rejected.collect()
    assert len(r) == 1 and "unmarshal" in r[0].error_message


def test_frame_edge_cases(spark, tmp):
    half = len(FRAME1) // 2
    text = (": comment only\n\n"
            f"data: {FRAME1[:half]}\ndata: {FRAME1[half:]}\n\n"   # two data lines, joined
            f"data:{FRAME2}\n\n"                                  # no space: ignored
            f"id: 7\nevent: x\ndata: {FRAME2}")                   # last frame without blank line
    _write(tmp, text)
    valid, _ = parse_change_event(sse_frames(spark, tmp))
    assert sorted(r.id for r in valid.collect()) == [12345, 12346]


def test_crlf_capture(spark, tmp):
    _write(tmp, f"data: {FRAME1}\r\n\r\ndata: {FRAME2}\r\n\r\n")
    valid, _ = parse_change_event(sse_frames(spark, tmp, line_sep="\r\n\r\n"))
    assert sorted(r.id for r in valid.collect()) == [12345, 12346]


def test_wrong_type_and_empty(spark):
    df = spark.createDataFrame([('{"id":"x"}',), ('',), ('{"id":1.5}',), ('{"id":7}',)], "payload string")
    valid, rejected = parse_change_event(df)
    assert [r.id for r in valid.collect()] == [7]
    assert rejected.count() == 2          # empty payload is no event at all


def test_parse_defaults(spark):
    df = spark.createDataFrame([('{"timestamp": 60}',), ('{"wiki":"enwiki","type":"edit"}',),
                                ('{"wiki":"dewiki","type":"new","timestamp":61}',)], "payload string")
    valid, rejected = parse_defaults(df)
    got = sorted((r.wiki, r.type, r.timestamp) for r in valid.collect())
    assert got == [("dewiki", "new", 61), ("unknown", "unknown", 60)]
    assert [r.error_message for r in rejected.collect()] == ["parse: timestamp field is missing"]


def test_evolution_v1_as_v2_and_back(spark, tmp):
    v1 = spark.createDataFrame([(456,) + ("",) * 0], "id long")
    v1 = align_schema(v1.selectExpr("id", "'edit' AS type", "0 AS namespace", "'' AS title", "'' AS title_url",
                                    "'' AS comment", "CAST(1700000000 AS BIGINT) AS timestamp", "'' AS user",
                                    "false AS bot", "'' AS server_url", "'' AS server_name",
                                    "'' AS server_script_url", "'enwiki' AS wiki",
                                    "CAST(1700000000 AS BIGINT) AS parsed_timestamp"), CHANGE_EVENT_V1)
    v2 = align_schema(v1, CHANGE_EVENT_V2)
    r = v2.first()
    assert (r.id, r.minor, r.page_id) == (456, 0, None)
    v2b = v2.selectExpr("*").withColumn("page_id", v2.id * 0 + 99).withColumn("id", v2.id + 333)
    back = align_schema(v2b, CHANGE_EVENT_V1)
    assert back.columns == CHANGE_EVENT_V1.fieldNames()
    assert back.first().id == 789


def test_incompatible_schema_rejected(spark):
    df = spark.createDataFrame([(1,)], "id long")
    try:
        align_schema(df, CHANGE_EVENT_V1)
    except SchemaMismatch as e:
        assert "missing" in str(e)
    else:
        raise AssertionError("missing fields must be rejected")
    narrow = spark.createDataFrame([("a",)], "id string")
    try:
        align_schema(narrow, CHANGE_EVENT_V1.__class__([CHANGE_EVENT_V1["id"]]))
    except SchemaMismatch as e:
        assert "cannot be read" in str(e)
    else:
        raise AssertionError("narrowing must be rejected")


def test_long_lines_are_kept(spark, tmp):
    from eventide.sources.json_events import sse_frames
    big = "x" * (2 << 20)
    _write(tmp, f"data: {FRAME1}\n\ndata: {big}\n\n")
    assert sorted(len(r.payload) for r in sse_frames(spark, tmp).collect()) == sorted([len(FRAME1), len(big)])


def test_timestamps_out_of_range_are_rejects(spark):
    from eventide.sources.json_events import TS_RANGE_ERROR, parse_change_event, parse_defaults
    stamps = [9223372036854775807, 1700000000000, -5, 1700000000]
    df = spark.createDataFrame([('{"id": 1, "wiki": "a", "type": "edit", "timestamp": %d}' % t,) for t in stamps],
                               "payload string")
    for parse in (parse_change_event, parse_defaults):
        ok, bad = parse(df)
        assert [r.timestamp for r in ok.collect()] == [1700000000]
        assert [r.error_message for r in bad.collect()] == [TS_RANGE_ERROR] * 3
