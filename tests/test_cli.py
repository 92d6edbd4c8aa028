import json
import os

from eventide.__main__ import main
from eventide.plans import inject
from eventide.sources.replay import read_events
from eventide.sources.tables import change_events
from tests.conftest import SF001

COMMON = ["--shuffle-partitions", "8"]


def test_cli_store_replay_dlq(spark, tmp, capsys):
    topic, events, dlq = (os.path.join(tmp, d) for d in ("topic", "events", "dlq"))
    msgs = inject.wire_messages(change_events(spark, SF001))
    msgs.write.parquet(topic)
    main(COMMON + ["--checkpoint", os.path.join(tmp, "ck"), "store", "--topic-dir", topic,
                   "--events", events, "--dlq-dir", dlq, "--once"])
    stored = read_events(spark, events).count()
    assert stored > 0
    capsys.readouterr()
    main(COMMON + ["replay", "--events", events, "--from", "2024-01-01", "--to", "2024-12-31", "--dry-run"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["events"] == stored and out["dry_run"] is True
    main(COMMON + ["dlq-replay", "--dlq-dir", dlq, "--replay", "--dry-run"])
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert sum(x["count"] for x in lines if "count" in x) == msgs.count() - stored
    assert lines[-1]["would_replay"] == msgs.count() - stored


def test_cli_amplify_and_features(spark, tmp):
    seed = os.path.join(tmp, "seed.json")
    with open(seed, "w") as f:
        f.write(json.dumps({"id": 1, "type": "edit", "namespace": 0, "title": "Seed", "title_url": "Seed",
                            "comment": "load", "timestamp": 1700000000, "user": "u", "bot": False,
                            "server_url": "https://en.wikipedia.org", "server_name": "en.wikipedia.org",
                            "server_script_url": "/w", "wiki": "enwiki", "parsed_timestamp": 1700000000}))
    out = os.path.join(tmp, "amplified")
    main(COMMON + ["amplify", "--seed", seed, "--n", "5000", "--rate", "1000", "--out", out])
    ev = read_events(spark, out)
    assert ev.count() == 5000 and ev.select("wiki").distinct().count() == 1
    feats = os.path.join(tmp, "features")
    main(COMMON + ["features", "--events", out, "--out", feats])
    stats = spark.read.parquet(feats)
    assert stats.agg({"edits_last_hour": "sum"}).first()[0] == 5000
