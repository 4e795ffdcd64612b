"""Speed layer: stream = batch, every record processed, restart from the
checkpoint, malformed messages quarantined, replay-safe upserts."""

import json
import os

import pytest
from conftest import SF_SMALL, rows

from ratinglens.sources import tables
from ratinglens.streaming import speed
from ratinglens.sources.store import compact_view, latest_snapshot, read_view, upsert_view, write_version


def _msg(seq, fide_id, std, rapid="1", blitz="2", extra=None, drop=None):
    rec = {
        "fide_id": fide_id, "first_name": "F" + fide_id, "last_name": "L" + fide_id,
        "rating_standard": std, "rating_rapid": rapid, "rating_blitz": blitz,
    }
    if extra:
        rec.update(extra)
    if drop:
        rec.pop(drop)
    return {"seq": seq, "ts": "2024-01-01T00:00:%02d" % (seq % 60), "value": json.dumps(rec)}


def _write_file(folder, name, msgs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for m in msgs:
            f.write(json.dumps(m) + "\n")


FILE1 = (
    [_msg(i, str(i % 5), str(1000 + i)) for i in range(14)]                   # 14 messages, one file
    + [{"seq": 14, "ts": "2024-01-01T00:00:14", "value": "{bad"}]             # not JSON
    + [_msg(15, "1", "3000", extra={"unknown": "x"})]                          # unknown field
    + [_msg(16, "2", "3100", drop="rating_blitz")]                             # missing field
)
FILE2 = [_msg(17, "1", "4000"), _msg(18, "7", "500")]                          # later updates


def _run(spark, src, root, name, compact_every=None):
    q = speed.start_speed_layer(
        speed.read_message_files(spark, src, max_files_per_trigger=1),
        f"{root}/view", f"{root}/ckpt", available_now=True,
        rejects_root=f"{root}/rejects", query_name=name, compact_every=compact_every,
    )
    speed.run_until_caught_up(q, 120)
    for other in spark.streams.active:
        other.awaitTermination(120)
    return speed.read_speed_state(spark, f"{root}/view")


def _batch_state(spark, src):
    msgs = spark.read.schema("seq bigint, ts timestamp, value string").json(src)
    return speed.speed_state(speed.parse_messages(msgs))


def test_stream_equals_batch_and_restart(spark, tmp_dir):
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/speed"
    _write_file(src, "f1.json", FILE1)
    first = {r.fide_id: r for r in _run(spark, src, root, "s1").collect()}
    assert first["1"].rating_standard == "3000" and first["1"].stream_count == 4
    assert first["2"].rating_standard == "3100" and first["2"].rating_blitz is None
    assert sum(r.stream_count for r in first.values()) == 16  # all but the bad one

    _write_file(src, "f2.json", FILE2)
    state = _run(spark, src, root, "s2")  # resumes from the checkpoint
    got = {r.fide_id: r for r in state.collect()}
    assert got["1"].rating_standard == "4000" and got["1"].stream_count == 5
    assert got["7"].stream_count == 1 and got["0"].stream_count == 3
    assert rows(state) == rows(_batch_state(spark, src))

    rejects = spark.read.parquet(f"{root}/rejects").collect()
    assert [r.value for r in rejects] == ["{bad"]


def test_same_result_for_one_or_many_files(spark, tmp_dir):
    one, many = f"{tmp_dir}/one", f"{tmp_dir}/many"
    _write_file(one, "all.json", FILE1 + FILE2)
    msgs = FILE1 + FILE2
    for i in range(0, len(msgs), 4):
        _write_file(many, f"f{i:03d}.json", msgs[i:i + 4])
    a = _run(spark, one, f"{tmp_dir}/a", "one")
    b = _run(spark, many, f"{tmp_dir}/b", "many")
    assert rows(a) == rows(b) == rows(_batch_state(spark, one))


def test_compaction_keeps_results_and_prunes(spark, tmp_dir):
    many = f"{tmp_dir}/many"
    msgs = FILE1 + FILE2
    for i in range(0, len(msgs), 3):
        _write_file(many, f"f{i:03d}.json", msgs[i:i + 3])
    state = _run(spark, many, f"{tmp_dir}/c", "compacted", compact_every=2)
    assert rows(state) == rows(_batch_state(spark, many))
    view = f"{tmp_dir}/c/view"
    assert latest_snapshot(spark, view) == 6
    # a read after the snapshot scans only the snapshot and later deltas
    scanned = read_view(spark, view, ["fide_id"])
    files = scanned.inputFiles()
    assert files and all("version=6/" in f for f in files)


def test_changed_snapshot_interval_loses_nothing(spark, tmp_dir):
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/speed"
    done = []
    for run, interval in enumerate([5, 2, None, 3]):
        for i in range(7):
            k = 10 * run + i
            done.append(f"b{k}")
            _write_file(src, f"f{k:03d}.json", [_msg(k, f"b{k}", str(k))])
        state = _run(spark, src, root, f"interval{run}", compact_every=interval)
        assert sorted(r.fide_id for r in state.collect()) == sorted(done)


def test_new_checkpoint_on_an_old_view_is_refused(spark, tmp_dir):
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/speed"
    _write_file(src, "f1.json", FILE1)
    before = rows(_run(spark, src, root, "old"))
    with pytest.raises(ValueError, match="another checkpoint"):
        speed.start_speed_layer(
            speed.read_message_files(spark, src), f"{root}/view", f"{root}/new-ckpt", available_now=True
        )
    assert rows(speed.read_speed_state(spark, f"{root}/view")) == before


def test_state_runs_in_all_shuffle_partitions(spark, tmp_dir):
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/speed"
    _write_file(src, "f.json", [_msg(i, str(i), str(i)) for i in range(400)])
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        state = _run(spark, src, root, "wide")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(state.inputFiles()) > 8 and state.count() == 400


def test_events_as_a_folder_of_files(spark, tmp_dir):
    one = tables.load(spark, SF_SMALL, "events")
    one.repartition(3).write.parquet(f"{tmp_dir}/sf/events.parquet")
    n = []
    for sf in (SF_SMALL, f"{tmp_dir}/sf"):
        stream = tables.stream_table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
        root = f"{tmp_dir}/run{len(n)}"
        q = speed.start_speed_layer(
            speed.to_messages(tables.submissions_from_events(stream)), f"{root}/view", f"{root}/ckpt", available_now=True
        )
        speed.run_until_caught_up(q)
        n.append(rows(speed.read_speed_state(spark, f"{root}/view")))
    assert n[0] == n[1] and n[0]


def test_compact_view_replay_is_harmless(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    schema = "fide_id string, v string"
    write_version(spark.createDataFrame([("a", "1"), ("b", "1")], schema), root, 0)
    newest = spark.createDataFrame([("a", "2")], schema)
    compact_view(spark, root, ["fide_id"], 1, newest=newest)
    compact_view(spark, root, ["fide_id"], 1, newest=newest)  # replayed batch
    write_version(spark.createDataFrame([("c", "3")], schema), root, 2)
    assert rows(read_view(spark, root, ["fide_id"])) == [("a", "2"), ("b", "1"), ("c", "3")]
    assert rows(read_view(spark, root, ["fide_id"], max_version=0)) == [("a", "1"), ("b", "1")]


def test_upsert_view_dedups(spark, tmp_dir):
    root = f"{tmp_dir}/up"
    df = spark.createDataFrame([("a", "1"), ("a", "9"), ("b", "2")], "fide_id string, v string")
    upsert_view(df, root, ["fide_id"], 0)
    assert rows(read_view(spark, root, ["fide_id"])) == [("a", "9"), ("b", "2")]


def test_view_store_upsert_and_replay(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    schema = "fide_id string, v string"
    write_version(spark.createDataFrame([("a", "1"), ("b", "1")], schema), root, 0)
    write_version(spark.createDataFrame([("a", "2")], schema), root, 1)
    write_version(spark.createDataFrame([("a", "2")], schema), root, 1)  # replayed batch
    assert rows(read_view(spark, root, ["fide_id"])) == [("a", "2"), ("b", "1")]


def test_messages_round_trip(spark):
    reports = spark.createDataFrame(
        [("1", "Ann", "Doe", "2500", "2400", "2300", 1)],
        "fide_id string, first_name string, last_name string, rating_standard string, rating_rapid string, rating_blitz string, seq long",
    ).withColumn("ts", __import__("pyspark.sql.functions", fromlist=["x"]).current_timestamp())
    msgs = speed.to_messages(reports)
    parsed = speed.parse_messages(msgs).collect()[0]
    assert (parsed.fide_id, parsed.rating_blitz) == ("1", "2300")
    assert json.loads(msgs.collect()[0].value)["last_name"] == "Doe"


def test_update_messages(spark):
    state = spark.createDataFrame([("7", 3)], "fide_id string, stream_count long")
    r = speed.update_messages(state).collect()[0]
    assert r.message == "Updated speed layer for player7" and r.stream_count == 3


def test_partitioned_order_breaks_timestamp_ties(spark, tmp_dir):
    def m(part, seq, std):
        rec = {"fide_id": "1", "first_name": "a", "last_name": "b",
               "rating_standard": std, "rating_rapid": "1", "rating_blitz": "2"}
        return {"part": part, "seq": seq, "ts": "2024-01-01T00:00:00", "value": json.dumps(rec)}

    # same timestamp in three partitions: the greatest (part, seq) is the latest
    _write_file(f"{tmp_dir}/in", "a.json", [m(0, 9, "100"), m(2, 1, "300"), m(1, 5, "200")])
    order = ("ts", "part", "seq")
    q = speed.start_speed_layer(
        speed.read_message_files(spark, f"{tmp_dir}/in", schema=speed.PARTITIONED_MESSAGE_SCHEMA),
        f"{tmp_dir}/view", f"{tmp_dir}/ckpt", order_cols=order, available_now=True,
    )
    speed.run_until_caught_up(q, 120)
    got = speed.read_speed_state(spark, f"{tmp_dir}/view").collect()[0]
    assert (got.rating_standard, got.stream_count) == ("300", 3)


def test_half_written_snapshot_hides_no_key(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    schema = "fide_id string, v string"
    write_version(spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], schema), root, 0)
    compact_view(spark, root, ["fide_id"], 1, newest=spark.createDataFrame([("a", "2")], schema))
    # a snapshot folder whose write has not committed yet: only part of the keys
    write_version(spark.createDataFrame([("a", "3")], schema), root, 2, kind="full")
    assert latest_snapshot(spark, root) == 1
    assert rows(read_view(spark, root, ["fide_id"])) == [("a", "3"), ("b", "1"), ("c", "1")]
