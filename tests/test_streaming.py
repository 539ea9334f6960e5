import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from shoptide.schemas import RAW_MESSAGE, REALTIME_VIEW
from shoptide.streaming.events import parse_activity_events
from shoptide.streaming.interest import realtime_trend_score, sliding_user_interest, trailing_window
from shoptide.streaming.speed import start_raw_append, start_speed_layer
from shoptide.sources.commits import Commits
from shoptide.streaming.view import FAN_IN, KEEP, expire_realtime_view, read_realtime_view, read_windows, upsert_realtime_view

START = int(datetime(2025, 11, 14, 10, tzinfo=timezone.utc).timestamp())
ONCE = {"availableNow": True}


def message(minute, kind="view", user="u", product="p", **other):
    return json.dumps(
        {
            "user_id": user,
            "product_id": product,
            "product_name": "name",
            "category": "Toys",
            "event_type": kind,
            "event_timestamp": (START + minute * 60) * 1000.0,
            **other,
        }
    )


def raw(spark, *messages):
    return spark.createDataFrame([(m,) for m in messages], "value string")


def scored(spark, *messages):
    return realtime_trend_score(sliding_user_interest(parse_activity_events(raw(spark, *messages))))


def minutes(rows):
    return sorted((r["computed_time"] - START) // 60 for r in rows)


def test_parsing(spark):
    frame = parse_activity_events(raw(spark, message(1), "{broken", message(0, event_timestamp=None)))
    good, broken, untimed = frame.collect()
    assert good["event_timestamp"].minute == 1 and good["event_type"] == "view"
    assert broken["user_id"] is None and broken["event_timestamp"] is None
    assert untimed["user_id"] == "u" and untimed["event_timestamp"] is None


def test_binary_values_and_odd_numbers(spark):
    frame = parse_activity_events(raw(spark, message(0, event_timestamp=float("nan"))).selectExpr("cast(value as binary) value"))
    assert frame.first()["event_timestamp"] is None


def test_an_event_is_in_five_windows(spark):
    rows = scored(spark, message(0)).collect()
    assert minutes(rows) == [1, 2, 3, 4, 5]
    assert {(r["view_count"], r["trend_score"]) for r in rows} == {(1, 0.2)}


def test_weights_and_other_event_types(spark):
    rows = scored(spark, message(0), message(0, "cart"), message(0, "purchase"), message(0, "wishlist", product="q")).collect()
    assert [r["trend_score"] for r in rows if r["product_id"] == "p"] == pytest.approx([1.7] * 5)
    other = [r for r in rows if r["product_id"] == "q"]
    assert len(other) == 5 and {r["trend_score"] for r in other} == {0.0}


def test_unusable_messages_are_in_no_window(spark):
    assert scored(spark, "{broken", message(0, event_timestamp=None)).count() == 0


def test_trailing_window(spark):
    rows = trailing_window(scored(spark, message(0), message(3), message(3, user="v"))).collect()
    assert sorted((r["user_id"], (r["computed_time"] - START) // 60, r["view_count"]) for r in rows) == [("u", 4, 2), ("v", 4, 1)]


def test_upsert_and_replay(spark, tmp_path):
    target = str(tmp_path / "view")
    assert read_realtime_view(spark, target).collect() == []
    first, second = scored(spark, message(0)), scored(spark, message(0), message(3))
    upsert_realtime_view(first, 1, target)
    assert [(minutes([r])[0], r["view_count"]) for r in read_realtime_view(spark, target).collect()] == [(1, 1)]
    upsert_realtime_view(second, 2, target)
    after = read_realtime_view(spark, target).collect()
    assert [(minutes([r])[0], r["view_count"]) for r in after] == [(4, 2)]
    upsert_realtime_view(first, 1, target)
    assert read_realtime_view(spark, target).collect() == after
    upsert_realtime_view(first, 3, target)
    assert read_realtime_view(spark, target).collect() == after


def test_failed_write_fails_the_batch(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    with pytest.raises(Exception):
        upsert_realtime_view(scored(spark, message(0)), 0, str(tmp_path / "file"))


def test_expiry(spark):
    view = scored(spark, message(0))
    assert minutes(expire_realtime_view(view, START + 13 * 60).collect()) == [4, 5]
    moment = datetime.fromtimestamp(START + 13 * 60, timezone.utc)
    assert minutes(expire_realtime_view(view, moment).collect()) == [4, 5]


def drop(folder, name, *messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(messages) + "\n")


def stream(spark, folder, files=None):
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", files) if files else reader).load(str(folder))


def test_stream_equals_batch(spark, tmp_path):
    messages = [message(m % 7, kind, user=f"u{m % 3}", product=f"p{m % 4}") for m in range(60) for kind in ("view", "cart")]
    drop(tmp_path / "in", "a", *messages, "{broken")
    query = start_speed_layer(stream(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), ONCE)
    query.awaitTermination()
    streamed = sorted(read_realtime_view(spark, str(tmp_path / "out")).select(*REALTIME_VIEW.names).collect())
    whole = sorted(trailing_window(scored(spark, *messages)).select(*REALTIME_VIEW.names).collect())
    assert streamed == whole and len(streamed) == 12
    counted = [p.observedMetrics["speed_input"] for p in query.recentProgress if "speed_input" in p.observedMetrics]
    assert (sum(c["messages"] for c in counted), sum(c["unusable"] for c in counted)) == (121, 1)


def test_late_events_are_dropped_and_a_restart_goes_on(spark, tmp_path):
    box, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    dropped = 0
    for step, (minute, product) in enumerate([(0, "a"), (30, "b"), (1, "c")]):
        drop(box, f"f{step}", message(minute, product=product))
        query = start_speed_layer(stream(spark, box, 1), out, state, ONCE)
        query.awaitTermination()
        assert query.exception() is None
        dropped += sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)
    assert {r["product_id"] for r in read_realtime_view(spark, out).collect()} == {"a", "b"}
    assert dropped > 0


def test_raw_append(spark, tmp_path):
    box, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for step in range(2):
        drop(box, f"f{step}", json.dumps({"user_id": step, "action": "view", "item_id": "i", "timestamp": 5}))
        start_raw_append(stream(spark, box), out, state, trigger=ONCE).awaitTermination()
    assert sorted(spark.read.schema(RAW_MESSAGE).parquet(out).collect()) == [(0, "view", "i", 5), (1, "view", "i", 5)]


def test_out_of_order_events_are_merged(spark, tmp_path):
    start = datetime(2025, 1, 1)
    schema = "user_id string, product_id string, product_name string, category string, event_type string, event_timestamp timestamp"

    def counted(minutes):
        rows = [("u", "p", "n", "c", "view", start + timedelta(minutes=m)) for m in minutes]
        return realtime_trend_score(sliding_user_interest(spark.createDataFrame(rows, schema)))

    minutes, seen = [3, 1, 4, 0, 2, 1], []
    for k, minute in enumerate(minutes):
        seen.append(minute)
        every = counted(seen)
        since = F.col("computed_time") - F.lit(start + timedelta(minutes=minute)).cast("long")
        upsert_realtime_view(every.filter((since > 0) & (since <= 300)), k, str(tmp_path))
        found, wanted = read_realtime_view(spark, str(tmp_path)), trailing_window(every)
        assert [tuple(r) for r in found.select(wanted.columns).collect()] == [tuple(r) for r in wanted.collect()]


def state(spark, target):
    return Commits(spark, str(target)).latest()[1]["folders"]


def stored_times(spark, target):
    """Window ends in all files on disk, in minutes."""
    return minutes(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(str(target)).collect())


def test_folders_are_merged_and_old_ones_leave_the_disk(spark, tmp_path):
    target, seen = str(tmp_path), []
    for k in range(20):
        seen.append(message(k % 7, product=f"p{k % 3}"))
        upsert_realtime_view(scored(spark, *seen), k, target, fan_in=3, keep=1)
        folders = state(spark, target)
        for level in range(4):
            assert sum(f["level"] == level for f in folders) < 3
    assert max(f["level"] for f in folders) >= 2
    on_disk = {str(p.parent.relative_to(tmp_path)) for p in tmp_path.glob("*/slice=*/*.parquet")}
    assert on_disk == {f["path"] for f in folders}
    wanted = trailing_window(scored(spark, *seen))
    assert sorted(read_realtime_view(spark, target).select(wanted.columns).collect()) == sorted(wanted.collect())


def test_expired_rows_leave_the_disk(spark, tmp_path):
    target = str(tmp_path)
    for k, minute in enumerate([0, 40, 80, 120, 121, 122]):
        now = START + minute * 60
        upsert_realtime_view(scored(spark, message(minute, product=f"p{minute}")), k, target, now - 840, slice_seconds=600, fan_in=2, keep=1)
    assert min(stored_times(spark, target)) > 122 - 14
    assert all((f["slice"] + 1) * 600 > now - 840 for f in state(spark, target))
    live = read_realtime_view(spark, target, now)
    assert sorted(r["product_id"] for r in live.collect()) == ["p120", "p121", "p122"]


def test_reads_open_only_slices_that_may_be_alive(spark, tmp_path):
    target = str(tmp_path)
    upsert_realtime_view(scored(spark, message(0), message(300), message(601)), 1, target)
    assert len(state(spark, target)) > 2
    now = START + 601 * 60
    files = read_realtime_view(spark, target, now).inputFiles()
    assert files and len(files) < len(read_windows(spark, target).inputFiles())
    assert minutes(read_realtime_view(spark, target, now).collect()) == [602]


def test_a_crash_leaves_the_last_state(spark, tmp_path, monkeypatch):
    target = str(tmp_path)
    upsert_realtime_view(scored(spark, message(0)), 0, target)
    before = read_realtime_view(spark, target).collect()

    def broken(*_):
        raise OSError("no room")

    with monkeypatch.context() as patch:
        patch.setattr(Commits, "commit", broken)
        with pytest.raises(OSError):
            upsert_realtime_view(scored(spark, message(0), message(2)), 1, target)
    assert read_realtime_view(spark, target).collect() == before
    left = {p.name for p in tmp_path.glob("batch-1-*")}
    assert len(left) == 1
    upsert_realtime_view(scored(spark, message(0), message(2)), 1, target)
    assert minutes(read_realtime_view(spark, target).collect()) == [3]
    assert not left & {p.name for p in tmp_path.iterdir()}  # the failed attempt's folder is gone


def test_files_grow_with_the_slices_not_with_tasks_times_slices(spark, tmp_path):
    target = tmp_path / "view"
    rows = [(f"u{i}", "p", "n", "c", 1, 0, 0, 0.2, 3600 * (i % 40) + 60) for i in range(640)]
    for batch_id in range(2):  # the second batch merges the slices
        batch = spark.createDataFrame(rows, REALTIME_VIEW).repartition(8, "user_id")
        upsert_realtime_view(batch, batch_id, str(target), fan_in=2)
    written = [p for p in target.rglob("*.parquet") if "flat-" not in str(p)]
    assert {p.parts[-3].split("-")[0] for p in written} == {"batch", "merged"}
    assert len(written) <= 3 * 50
    assert not list(target.glob("flat-*"))
    assert read_windows(spark, str(target)).count() == 640


def test_one_of_two_writers_of_a_version_fails(spark, tmp_path):
    log = Commits(spark, str(tmp_path))
    log.commit(1, {"a": 1})
    log.commit(1, {"a": 2})
    assert log.latest() == (1, {"a": 2}) and log.latest(below=1) is None
    log._files = lambda: []  # as a writer that has not seen the others
    with pytest.raises(Exception, match="exist"):
        log.commit(1, {"a": 3})


def test_shuffled_stream_equals_the_whole(spark, tmp_path):
    box, out = tmp_path / "in", str(tmp_path / "out")
    messages = [message((m * 37) % 50, kind, user=f"u{m % 3}", product=f"p{m % 4}") for m in range(90) for kind in ("view", "cart")]
    for k in range(6):
        drop(box, f"f{k}", *messages[k::6])
    query = start_speed_layer(stream(spark, box, 1), out, str(tmp_path / "state"), ONCE, watermark="1 day", fan_in=2)
    query.awaitTermination()
    assert sum(p.numInputRows > 0 for p in query.recentProgress) >= 5
    wanted = trailing_window(scored(spark, *messages))
    assert sorted(read_realtime_view(spark, out).select(wanted.columns).collect()) == sorted(wanted.collect())


def test_run_speed_layer_keeps_what_is_alive(spark, tmp_path):
    import time

    from shoptide.streaming.speed import run_speed_layer

    box, out = tmp_path / "in", str(tmp_path / "out")
    ago = lambda seconds: (time.time() - seconds) * 1000.0
    drop(box, "a", message(0, event_timestamp=ago(30)), message(0, product="old", event_timestamp=ago(9_000)))
    run_speed_layer(stream(spark, box), out, str(tmp_path / "state"), trigger=ONCE, watermark="1 day")
    assert {r["product_id"] for r in read_realtime_view(spark, out).collect()} == {"p"}
    assert FAN_IN > 1 and KEEP > 1


def test_a_row_that_passes_several_levels_is_written_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Commits, "prune", lambda *_: None)
    seen = []
    for k in range(4):
        seen.append(message(k % 3, product=f"p{k % 2}"))
        upsert_realtime_view(scored(spark, *seen), k, str(tmp_path), fan_in=2)
    # the second batch is merged with the first as it is written, the fourth with the third and what the second made
    assert sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.glob("*-*")) == ["batch-0", "batch-2", "merged-1", "merged-3"]
    assert [f["level"] for f in state(spark, tmp_path)] == [2]
    wanted = trailing_window(scored(spark, *seen))
    assert sorted(read_realtime_view(spark, str(tmp_path)).select(wanted.columns).collect()) == sorted(wanted.collect())


def test_rows_of_a_window_meet_in_a_slice_of_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("shoptide.streaming.view.TASK_ROWS", 20)
    rows = lambda views: [(f"u{i}", None, "n", "c", views, 0, 0, 0.2, 3600 * (i % 2) + 60 + i // 200) for i in range(300)]
    for batch_id, views in enumerate([1, 3, 2, 1]):
        upsert_realtime_view(spark.createDataFrame(rows(views), REALTIME_VIEW), batch_id, str(tmp_path), fan_in=2)
    assert len(list(tmp_path.glob("merged-3-*/slice=*/*.parquet"))) > 20
    found = read_windows(spark, str(tmp_path))
    assert sorted(map(tuple, found.select(*REALTIME_VIEW.names).collect())) == sorted(rows(3))
    on_disk = spark.read.parquet(*(f"{tmp_path}/{f['path']}" for f in state(spark, tmp_path)))
    assert on_disk.count() == 300


def test_the_view_is_read_on_one_shuffle_and_one_sort(spark, tmp_path):
    upsert_realtime_view(scored(spark, message(0), message(3)), 0, str(tmp_path))
    plan = read_realtime_view(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count(" Exchange ") == 1 and plan.count(" Sort ") == 1


def test_trailing_window_by_brute_force(spark):
    schema = "user_id string, product_id string, product_name string, category string, trend_score double, computed_time long"
    rows = [
        (user, product, name, category, 1.0, 60 * minute)
        for user in ("u", None)
        for k, product in enumerate(("p", "q", None))
        for name in (None, "a", "b")[: k + 1]
        for category in ("y", None, "x")[: 3 - k]
        for minute in range(k, 40, 3 if name else 7)
    ]
    wanted = set()
    for user, product in {r[:2] for r in rows}:
        own = [r for r in rows if r[:2] == (user, product)]
        recent = [r for r in own if r[5] >= max(r[5] for r in own) - 240]
        wanted.add(min(recent, key=lambda r: (r[5], r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")))
    found = trailing_window(spark.createDataFrame(rows, schema).repartition(5)).collect()
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted) == 6


def test_registered_streams_keep_their_state_off_the_heap(spark, tmp_path, monkeypatch):
    from shoptide.plans import queries as Q

    moment = datetime(2024, 1, 30, 12)
    events = [(i, moment - timedelta(minutes=i), i % 3, "view", '{"k": %d}' % (i % 2)) for i in range(20)]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, props string").write.parquet(
        str(tmp_path / "events.parquet")
    )
    parts = [(0, "n", "b", 1.0), (1, None, "b", 1.0)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_retailprice double").write.parquet(
        str(tmp_path / "part.parquet")
    )
    started = []

    def start(*args, **options):
        started.append(start_speed_layer(*args, **options))
        return started[-1]

    monkeypatch.setattr(Q, "start_speed_layer", start)
    before = spark.conf.getAll
    found = Q.speed_layer_batches(spark, str(tmp_path))
    assert found.count() == 6
    told = [o.customMetrics for p in started[0].recentProgress for o in p.stateOperators]
    assert told and all("rocksdbPutCount" in metrics for metrics in told)
    # a key is looked up once, not a second time to count the rows of the state
    assert all(metrics["rocksdbGetCount"] <= metrics["rocksdbPutCount"] for metrics in told)
    assert spark.conf.getAll == before
