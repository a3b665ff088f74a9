from __future__ import annotations

import json

import pytest
from conftest import plan_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from medallion import schemas
from medallion.plans.stream_silver import rebuild_all, refresh_from_changes
from medallion.sources import keyed, samples, versions
from medallion.sources.tables import read_table
from medallion.streaming import envelope, layers
from medallion.streaming import queries as streams

SPEC = layers.PAYLOADS["streaming_posts"]


def message(stream, payload, source=SPEC.source, **extra):
    event = {"source": source, "event_type": "post_event", "event_ts": "2024-01-01T00:00:00Z", "entity_id": 7}
    if stream is not None:
        event["stream_id"] = stream
    return json.dumps({**event, "payload_json": payload, **extra}, ensure_ascii=False)


MESSAGES = [
    message("s0", json.dumps({"id": 1, "userId": 2, "title": "t", "body": "grüße \n \"x\""}, ensure_ascii=False)),
    message("s1", "{}", source="other"),
    message("s2", None),
    message("s9", json.dumps({"id": "x", "userId": 3, "extra": [1]})),
    message(None, "not json"),
    "broken",
    "[1, 2]",
    "5",
    "",
]


def topic(spark, values, first_offset=0):
    rows = spark.createDataFrame([(v, first_offset + i) for i, v in enumerate(values)], "value string, o long")
    return samples.as_topic(rows, "o", "2024-02-01 00:00:00")


def test_envelopes_and_messages(spark):
    items = spark.createDataFrame([(1, "é", None), (2, None, True)], "id long, title string, done boolean")
    built = envelope.build_envelopes(items, "src", "s0", "kind", "id", "b", "now").collect()
    assert [json.loads(r["payload_json"]) for r in built] == [
        {"id": 1, "title": "é", "done": None},
        {"id": 2, "title": None, "done": True},
    ]
    assert {r["ingest_batch_id"] for r in built} == {"b"} and built[0]["entity_id"] == "1"
    messages = envelope.kafka_messages(envelope.build_envelopes(items, "src", "s0", "kind", "id", "b", "now"))
    rows = messages.collect()
    assert [r["key"] for r in rows] == ["s0:1", "s0:2"]
    assert json.loads(rows[0]["value"])["source"] == "src"


def test_parse_route_and_set_aside(spark):
    parsed = envelope.parse_messages(topic(spark, MESSAGES))
    good = envelope.raw_rows(envelope.accepted(parsed), F.lit("b"), F.lit("2024-02-01T00:00:00Z")).collect()
    assert [(r["stream_id"], r["tablet_index"], r["kafka_offset"]) for r in good] == [
        ("s0", 0, 0),
        ("s1", 1, 1),
        ("s2", 2, 2),
        ("s9", 0, 3),
        ("s0", 0, 4),
    ]
    assert {r["entity_id"] for r in good} == {"7"}
    bad = envelope.rejected(parsed).collect()
    assert [(r["offset"], r["message"]) for r in bad] == [(5, "broken"), (6, "[1, 2]"), (7, "5"), (8, "")]


def test_payload_types(spark):
    parsed = envelope.parse_messages(topic(spark, MESSAGES))
    raw = envelope.raw_rows(envelope.accepted(parsed), F.lit("b"), F.lit("2024-02-01T00:00:00Z"))
    rows = layers.payload_rows(layers.bronze_rows(raw, F.lit("p")), SPEC, F.lit("now")).collect()
    assert [(r["row_index"], r["post_id"], r["user_id"], r["title"], r["body"]) for r in rows] == [
        (0, 1, 2, "t", 'grüße \n "x"'),
        (3, None, 3, None, None),
        (4, None, None, None, None),
    ]
    missing = layers.bronze_rows(raw, F.lit("p")).withColumn("payload_json", F.lit(None).cast("string"))
    assert {r["post_id"] for r in layers.payload_rows(missing, SPEC, F.lit("now")).collect()} == {None}


def test_row_index_is_unique_over_topic_partitions(spark):
    df = spark.createDataFrame([(o, p) for o in range(5) for p in range(3)], "kafka_offset long, kafka_partition long")
    assert df.select(layers.row_index().alias("i")).distinct().count() == 15


def test_topics_do_not_share_keys(spark):
    parsed = envelope.parse_messages(topic(spark, MESSAGES))
    raw = envelope.raw_rows(envelope.accepted(parsed), F.lit("b"), F.lit("2024-02-01T00:00:00Z"))
    both = raw.unionByName(raw.withColumn("kafka_topic", F.lit("other")))
    assert layers.collapse(layers.topic_bronze_rows(both, F.lit("p"))).count() == 2 * raw.count()


@pytest.mark.parametrize(
    "text",
    [
        '{"source":"a"} trailing', '{"source":"a"}{"source":"b"}', "{'source':'a'}", '{"source":"a"},{"source":"b"}',
        '{"source":"a"}],[{"source":"b"}', '{"source":"a"},"n":{}', '{"source":"a"},', '{"source":"a"}}', '{"source":"a"', "null", None,
    ],
)
def test_only_single_objects_are_accepted(spark, text):
    parsed = envelope.parse_messages(topic(spark, [text, ' {"source":"a"} ']))
    assert [r["source"] for r in envelope.accepted(parsed).collect()] == ["a"]
    assert [r["message"] for r in envelope.rejected(parsed).collect()] == [text or ""]


@pytest.fixture()
def stream_dirs(tmp_path):
    return {name: str(tmp_path / name) for name in "topic raw rejects bronze silver rebuilt cp1 cp2 cp3".split()}


def run_all(spark, dirs, schema):
    source = spark.readStream.schema(schema).parquet(dirs["topic"])
    streams.topic_to_raw(source, dirs["raw"], dirs["rejects"], dirs["cp1"]).awaitTermination()
    queue = streams.read_queue(spark, dirs["raw"])
    streams.raw_to_bronze(queue, dirs["bronze"], dirs["cp2"]).awaitTermination()
    bronze = streams.stream_bronze(spark, dirs["bronze"])
    streams.bronze_to_silver(bronze, {SPEC.name: dirs["silver"]}, dirs["cp3"]).awaitTermination()


def test_streams_equal_the_rebuild_and_survive_replays(spark, stream_dirs):
    first = topic(spark, MESSAGES)
    first.write.parquet(stream_dirs["topic"])
    run_all(spark, stream_dirs, first.schema)
    assert streams.read_bronze(spark, stream_dirs["bronze"]).count() == 5
    assert read_table(spark, stream_dirs["rejects"]).count() == 4

    # The same messages once more under another file name, and one new message.
    first.write.mode("append").parquet(stream_dirs["topic"])
    topic(spark, [message("s0", json.dumps({"id": 9, "userId": 9}))], 100).write.mode("append").parquet(
        stream_dirs["topic"]
    )
    run_all(spark, stream_dirs, first.schema)
    run_all(spark, stream_dirs, first.schema)
    bronze = streams.read_bronze(spark, stream_dirs["bronze"])
    assert bronze.count() == 6 and bronze.select(*layers.BRONZE_KEY).distinct().count() == 6

    streams.rebuild_silver(spark, stream_dirs["bronze"], SPEC, stream_dirs["rebuilt"])
    streams.rebuild_silver(spark, stream_dirs["bronze"], SPEC, stream_dirs["rebuilt"])
    varying = ["processed_at", "silver_processed_at", "batch_id", "queue_timestamp"]
    rebuilt = read_table(spark, stream_dirs["rebuilt"]).drop(*varying)
    kept = streams.read_silver(spark, stream_dirs["silver"], SPEC).drop(*varying)
    assert sorted(rebuilt.select(*kept.columns).collect(), key=str) == sorted(kept.collect(), key=str)
    assert kept.count() == 4


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    raw = topic(spark, MESSAGES[:3])
    path = str(tmp_path / "out")
    for _ in range(2):
        streams.write_epoch(raw, path, "q", 4)
    streams.write_epoch(raw, path, "q", 5)
    streams.write_epoch(raw, path, "other", 4)
    assert read_table(spark, path).count() == 9


def test_two_queries_share_a_table(spark, stream_dirs, tmp_path):
    for k, part in enumerate((MESSAGES[:1], MESSAGES[1:2])):
        where = str(tmp_path / f"topic{k}")
        rows = topic(spark, part, 10 * k)
        rows.write.parquet(where)
        source = spark.readStream.schema(rows.schema).parquet(where)
        streams.topic_to_raw(source, stream_dirs["raw"], stream_dirs["rejects"], str(tmp_path / f"cp{k}")).awaitTermination()
    assert read_table(spark, stream_dirs["raw"]).count() == 2


def test_compaction_changes_no_result(spark, tmp_path):
    path = str(tmp_path / "bronze")
    parsed = envelope.parse_messages(topic(spark, MESSAGES))
    raw = envelope.raw_rows(envelope.accepted(parsed), F.lit("b"), F.lit("2024-02-01T00:00:00Z"))
    assert streams.compact(spark, path) == 0
    for epoch in range(3):
        streams.write_epoch(layers.topic_bronze_rows(raw, F.lit(f"p{epoch}")), path, "q", epoch, ["tablet_index"])
        before = sorted(streams.read_bronze(spark, path).collect())
        assert streams.compact(spark, path) in (1, 2)
        assert sorted(streams.read_bronze(spark, path).collect()) == before
        if epoch == 1:
            streams.drop_merged(spark, path)
            assert sorted(streams.read_bronze(spark, path).collect()) == before
    assert {r["processed_at"] for r in streams.read_bronze(spark, path).collect()} == {"p2"}


def numbered(spark, numbers, processed_at, source=SPEC.source):
    """Bronze rows of stream s0 with given message numbers."""
    rows = [(message("s0", json.dumps({"id": n, "title": processed_at}), source=source), n) for n in numbers]
    parsed = envelope.parse_messages(samples.as_topic(spark.createDataFrame(rows, "value string, o long"), "o", "2024-02-01 00:00:00"))
    raw = envelope.raw_rows(envelope.accepted(parsed), F.lit("b"), F.lit("2024-02-01T00:00:00Z"))
    return layers.topic_bronze_rows(raw, F.lit(processed_at))


def held(spark, path):
    return sorted((r["row_index"], r["processed_at"]) for r in streams.read_bronze(spark, path).collect())


def test_only_ranges_with_fresh_rows_are_read_and_written(spark, tmp_path):
    path, table = str(tmp_path / "bronze"), streams.keyed_table(str(tmp_path / "bronze"))
    streams.write_epoch(numbered(spark, range(40), "p0"), path, "q", 0, ["tablet_index"])
    streams.compact(spark, path, range_bits=3)
    before = versions.latest(spark, table)
    assert {keyed.range_of(f) for f in before.folders} == {f"0-{n}" for n in range(5)}
    streams.write_epoch(numbered(spark, [33, 41], "p1"), path, "q", 1, ["tablet_index"])
    # An older delivery of a key that is held already loses.
    streams.write_epoch(numbered(spark, [3], "a"), path, "r", 0, ["tablet_index"])
    expected = sorted([(n, "p1" if n in (33, 41) else "p0") for n in [*range(40), 41]])
    assert held(spark, path) == expected
    touched, others = plan_of(streams.read_bronze(spark, path)).rsplit("\n   +- ", 1)
    assert "Exchange" in touched and "FileScan" in others and "Exchange" not in others and "Window" not in others
    streams.compact(spark, path)
    after = versions.latest(spark, table)
    assert {keyed.range_of(f) for f in after.folders - before.folders} == {"0-0", "0-4", "0-5"}
    assert held(spark, path) == expected
    changed = keyed.changed_since(spark, table, streams.KEYED_BRONZE, after, before.number).collect()
    assert sorted((r["row_index"], r[keyed.FIRST], r[keyed.SINCE]) for r in changed) == [(33, 1, 2), (41, 2, 2)]
    # Nothing new: no version.
    streams.compact(spark, path)
    assert versions.latest(spark, table).number == after.number
    streams.drop_merged(spark, path)
    assert held(spark, path) == expected and streams.stored_folders(spark, path) == []


def test_narrow_ranges_are_widened_when_they_are_too_many(spark, tmp_path):
    path, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    table, many = streams.keyed_table(path), keyed.RANGES + 44
    streams.write_epoch(numbered(spark, range(5), "p0"), path, "q", 0, ["tablet_index"])
    streams.compact(spark, path, range_bits=0)
    assert len(versions.latest(spark, table).folders) == 5 and streams.apply_changes(spark, path, SPEC, silver) == 1
    streams.write_epoch(numbered(spark, range(3, many), "p1"), path, "q", 1, ["tablet_index"])
    streams.compact(spark, path)
    wide = versions.latest(spark, table)
    assert len(wide.folders) <= keyed.RANGES // keyed.FEWER and wide.notes[keyed.BITS] == 4
    expected = [(n, "p0" if n < 3 else "p1") for n in range(many)]
    assert held(spark, path) == expected
    changed = keyed.changed_since(spark, table, streams.KEYED_BRONZE, wide, 1).collect()
    assert sorted((r["row_index"], r[keyed.FIRST]) for r in changed) == [(n, 1 if n < 5 else 2) for n in range(3, many)]
    assert streams.apply_changes(spark, path, SPEC, silver) == 1
    assert [n for n, _, _ in silver_of(spark, silver)] == list(range(many))
    # From then on only ranges with fresh rows are written.
    streams.write_epoch(numbered(spark, [20], "p2"), path, "q", 2, ["tablet_index"])
    streams.compact(spark, path)
    after = versions.latest(spark, table)
    assert {keyed.range_of(f) for f in after.folders - wide.folders} == {"0-1"}
    assert held(spark, path) == [(n, "p2" if n == 20 else at) for n, at in expected]
    assert keyed.widened({f"none-{n}" for n in ("none", *range(-200, 200))}, 20) == 20


def test_of_two_compactions_one_gives_way(spark, tmp_path, monkeypatch):
    path, table = str(tmp_path / "bronze"), streams.keyed_table(str(tmp_path / "bronze"))
    streams.write_epoch(numbered(spark, range(4), "p0"), path, "q", 0, ["tablet_index"])
    plain = versions.write_attempt

    def late(*args, **kwargs):
        monkeypatch.setattr(versions, "write_attempt", plain)
        entry = plain(*args, **kwargs)
        streams.compact(spark, path)
        return entry

    monkeypatch.setattr(versions, "write_attempt", late)
    streams.compact(spark, path)
    assert versions.latest(spark, table).number == 1 and held(spark, path) == [(n, "p0") for n in range(4)]
    assert len(list((tmp_path / "bronze__keyed" / "_data").iterdir())) == 1


def test_a_failed_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    streams.write_epoch(numbered(spark, range(4), "p0"), path, "q", 0, ["tablet_index"])
    monkeypatch.setattr(versions, "publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        streams.compact(spark, path)
    monkeypatch.undo()
    streams.drop_merged(spark, path)
    assert held(spark, path) == [(n, "p0") for n in range(4)]


def silver_of(spark, path):
    rows = read_table(spark, path, SPEC.schema).collect()
    return sorted((r["row_index"], r["post_id"], r["title"]) for r in rows)


def test_silver_follows_the_changes(spark, tmp_path):
    path, silver, rebuilt = (str(tmp_path / name) for name in ("bronze", "silver", "rebuilt"))
    assert streams.apply_changes(spark, path, SPEC, silver) == 0
    # A table that was built as a whole before is taken over.
    streams.write_epoch(numbered(spark, range(20), "p0"), path, "q", 0, ["tablet_index"])
    streams.rebuild_silver(spark, path, SPEC, silver)
    steps = [
        numbered(spark, [5, 25], "p1"),
        numbered(spark, [6], "p2", source="other"),
        numbered(spark, [7, 26], "p3", source="other").unionByName(numbered(spark, [25], "p4")),
        numbered(spark, [6], "p5"),
    ]
    for epoch, rows in enumerate(steps, 1):
        streams.compact(spark, path, range_bits=2)
        assert streams.apply_changes(spark, path, SPEC, silver) == 1
        assert streams.apply_changes(spark, path, SPEC, silver) == 0
        streams.rebuild_silver(spark, path, SPEC, rebuilt)
        assert silver_of(spark, silver) == silver_of(spark, rebuilt)
        streams.write_epoch(rows, path, "q", epoch, ["tablet_index"])
    streams.compact(spark, path)
    # Several versions at once.
    late = str(tmp_path / "late")
    outcomes = refresh_from_changes(spark, path, late, str(tmp_path / "runs"))
    assert set(outcomes.values()) == {"SUCCESS"}
    assert streams.apply_changes(spark, path, SPEC, silver) == 1
    streams.rebuild_silver(spark, path, SPEC, rebuilt)
    assert silver_of(spark, silver) == silver_of(spark, rebuilt) == silver_of(spark, f"{late}/{SPEC.name}")
    assert [n for n, _, _ in silver_of(spark, silver)] == [n for n in range(20) if n != 7] + [25]


def test_one_queue_partition_alone(spark, stream_dirs):
    first = topic(spark, MESSAGES)
    first.write.parquet(stream_dirs["topic"])
    source = spark.readStream.schema(first.schema).parquet(stream_dirs["topic"])
    streams.topic_to_raw(source, stream_dirs["raw"], stream_dirs["rejects"], stream_dirs["cp1"]).awaitTermination()
    only = streams.read_queue(spark, stream_dirs["raw"], tablet_index=0, max_files=1)
    streams.raw_to_bronze(only, stream_dirs["bronze"], stream_dirs["cp2"]).awaitTermination()
    rows = streams.read_bronze(spark, stream_dirs["bronze"]).collect()
    assert {r["tablet_index"] for r in rows} == {0} and len(rows) == 3
    assert streams.read_bronze(spark, stream_dirs["bronze"] + "-none").count() == 0


def test_rebuild_of_all_tables_records_each_run(spark, stream_dirs, tmp_path):
    parsed = envelope.parse_messages(topic(spark, MESSAGES))
    raw = envelope.raw_rows(envelope.accepted(parsed), F.lit("b"), F.lit("2024-02-01T00:00:00Z"))
    streams.write_epoch(layers.topic_bronze_rows(raw, F.lit("p")), stream_dirs["bronze"], "q", 0, ["tablet_index"])
    outcomes = rebuild_all(spark, stream_dirs["bronze"], str(tmp_path / "silver"), str(tmp_path / "runs"))
    assert outcomes == dict.fromkeys(layers.PAYLOADS, "SUCCESS")
    runs = read_table(spark, str(tmp_path / "runs"), schemas.STREAMING_SILVER_RUNS).collect()
    assert {(r["task_id"], r["status"], r["rc"]) for r in runs} == {(n, "success", 0) for n in layers.PAYLOADS}
    (tmp_path / "plain").write_text("no folder")
    broken = rebuild_all(spark, stream_dirs["bronze"], str(tmp_path / "plain"), str(tmp_path / "runs2"))
    assert all(text.startswith("FAILED") for text in broken.values())
    runs = read_table(spark, str(tmp_path / "runs2"), schemas.STREAMING_SILVER_RUNS).collect()
    assert {r["rc"] for r in runs} == {1} and len(runs) == 3


def test_one_failing_queue_partition_does_not_stop_the_others(spark, stream_dirs, tmp_path):
    first = topic(spark, MESSAGES)
    first.write.parquet(stream_dirs["topic"])
    source = spark.readStream.schema(first.schema).parquet(stream_dirs["topic"])
    streams.topic_to_raw(source, stream_dirs["raw"], stream_dirs["rejects"], stream_dirs["cp1"]).awaitTermination()
    root = tmp_path / "tables"
    root.mkdir()
    (root / "bronze_t1").write_text("in the way")
    running = streams.start_isolated(spark, stream_dirs["raw"], str(root), stream_dirs["cp2"])
    for index, one in running.items():
        if index == 1:
            with pytest.raises(StreamingQueryException):
                one.awaitTermination()
        else:
            one.awaitTermination()
    counts = [streams.read_bronze(spark, streams.bronze_table(str(root), i)).count() for i in (0, 2)]
    assert counts == [3, 1]
