"""Streaming = batch, replay idempotency, restart from checkpoint."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vitrine.plans import queries as Q
from vitrine.session import scratch_path
from vitrine.streaming.event_time import EventTimeJob


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_windows_equal_batch_and_native_emission(spark):
    job = Q.stream_job(spark, SF_SMALL, slices=3, keep_accepted=True)
    native = job.native()
    assert native.select("batch_id").distinct().count() >= 2      # several micro-batches emitted
    assert native.count() > 0                                     # windows closed natively
    stream = job.windows().select(*Q.WINDOW_OUT, "row_key")
    wm = Q.watermarked(spark, SF_SMALL)
    batch = Q.emitted(wm).select(*Q.WINDOW_OUT, "row_key")
    assert _rows(stream) == _rows(batch)
    # accepted events of all batches == batch late filter
    acc = job.accepted().where(F.col("event_type").isNotNull()).select("event_id")
    assert _rows(acc) == _rows(wm.where("NOT is_late").select("event_id"))
    # alerts published by the stream == batch alerts
    s_alerts = job.alert_puts().select("row_key", "alert_type", "clicks_in_window", "timestamp")
    b_alerts = Q.alert_changelog(wm).select("row_key", "alert_type", "clicks_in_window", "timestamp")
    assert _rows(s_alerts) == _rows(b_alerts)


def test_replayed_batch_is_skipped(spark):
    job = Q.stream_job(spark, SF_SMALL, slices=2, keep_accepted=True)
    before = job.accepted().count()
    state_before = _rows(job._wm_state())
    lines = spark.read.text(job.path("source", "slice=0"))
    job.accept_batch(lines, 0)                                     # replay of a committed batch
    assert job.accepted().count() == before
    assert _rows(job._wm_state()) == state_before


def test_carried_watermark_is_per_batch(spark):
    job = EventTimeJob(spark, scratch_path(spark, "carry"), tolerance_ms=10)
    a = spark.createDataFrame([('{"event_id":"a","event_type":"CLICK","event_time":100,"ingestion_time":1}',)],
                              "value string")
    b = spark.createDataFrame([('{"event_id":"b","event_type":"CLICK","event_time":80,"ingestion_time":2}',)],
                              "value string")
    job.accept_batch(a, 0)
    job.accept_batch(b, 1)
    assert job.carried_watermark(1) == 90
    late = job.late().select("event_id").collect()
    assert [r.event_id for r in late] == ["b"]


def test_crash_between_publish_and_commit_is_recovered(spark):
    """A batch that failed after publishing its data but before its commit
    record is replayed: no duplicate rows, same watermark as a clean run."""
    lines = [
        '{"event_id":"a","event_type":"CLICK","event_time":100,"ingestion_time":1,"product_id":"P"}',
        '{"event_id":"b","event_type":"CLICK","event_time":80,"ingestion_time":2,"product_id":"P"}',
        '{"event_id":"c","event_type":"CLICK","event_time":95,"ingestion_time":3,"product_id":"P"}',
    ]
    batch = spark.createDataFrame([(x,) for x in lines], "value string")
    clean = EventTimeJob(spark, scratch_path(spark, "clean"), tolerance_ms=10)
    clean.accept_batch(batch, 0)
    crashed = EventTimeJob(spark, scratch_path(spark, "crash"), tolerance_ms=10, fail_after="publish")
    try:
        crashed.accept_batch(batch, 0)
        raise AssertionError("fault injection did not fire")
    except RuntimeError:
        pass
    assert not crashed._has_state()
    crashed.fail_after = None
    crashed.accept_batch(batch, 0)                                  # the replay
    assert _rows(crashed.accepted().select("event_id")) == _rows(clean.accepted().select("event_id"))
    assert crashed.accepted().count() == 2                          # a, c accepted; b late
    assert _rows(crashed._wm_state()) == _rows(clean._wm_state())


def test_native_only_mode_keeps_more_late_clicks(spark):
    """Spark's own watermark alone is looser than the per-record rule: over
    the same arrival slices it counts at least as many clicks per window."""
    from vitrine.streaming import landing as L
    from vitrine.streaming.event_time import start_native_only
    job = Q.stream_job(spark, SF_SMALL, slices=3)
    out, chk = job.path("native_only_out"), job.path("_chk", "native_only")
    from vitrine.streaming.event_time import rows_dropped_by_watermark
    dropped = 0
    for i in range(3):
        lines = L.line_stream(spark, job.path("source", f"slice={i}"))
        q = start_native_only(spark, lines, out, chk, Q.TOLERANCE_MS, Q.WINDOW_MS, Q.SLIDE_MS)
        Q._await(q)
        dropped += rows_dropped_by_watermark(q)
    late_exact = job.late().where("event_type = 'CLICK'").count()
    assert 0 <= dropped <= late_exact                      # native drops fewer late clicks
    native = spark.read.parquet(out).groupBy("window_start", "product_id").agg(F.sum("clicks").alias("n"))
    exact = job.windows().select("window_start", "product_id", F.col("clicks").alias("e"))
    # native mode has no end-of-input flush: compare the windows it emitted
    joined = exact.join(native, ["window_start", "product_id"], "inner")
    assert joined.count() > 0
    assert joined.where(F.col("n") < F.col("e")).count() == 0


def test_follow_mode_landing_picks_up_new_files(spark):
    """Follow-forever mode (processing-time trigger): files that appear later
    are landed by the running query; the checkpoint keeps the position."""
    from vitrine.sources import json_lines as J
    from vitrine.streaming import landing as L
    root = scratch_path(spark, "follow")
    spark.createDataFrame([('{"event_id":"1","event_type":"CLICK"}',)], "value string").write.text(f"{root}/src/a")
    q = L.start_landing(L.line_stream(spark, f"{root}/src/*"), f"{root}/landing", f"{root}/_chk",
                        once=False, max_records_per_file=1000, interval_seconds=1)
    try:
        q.processAllAvailable()
        spark.createDataFrame([('{"event_id":"2","event_type":"CART_ADD"}',)], "value string").write.text(f"{root}/src/b")
        q.processAllAvailable()
    finally:
        q.stop()
    landed = J.read_tolerant(spark, f"{root}/landing")
    assert sorted(r.event_id for r in landed.collect()) == ["1", "2"]
    parts = spark.read.text(f"{root}/landing").columns
    assert {"year", "month", "day"} <= set(parts)


def test_concurrent_stages_follow_mode_equal_batch(spark):
    """Both stages running at once (follow mode), input arriving in slices
    while they run: after the flush the windows equal the batch result."""
    import time

    from vitrine.sources.driver_events import noisy_event_log
    from vitrine.streaming import landing as L
    root = scratch_path(spark, "concurrent")
    job = EventTimeJob(spark, root, Q.TOLERANCE_MS, Q.WINDOW_MS, Q.SLIDE_MS, Q.HOT_THRESHOLD)
    slices = Q.arrival_slices(Q.events(spark, SF_SMALL), 3)
    Q._write_text(noisy_event_log(slices[0]), f"{root}/source/slice=0")
    accept = job.start_accept(L.line_stream(spark, f"{root}/source/*/*.txt", max_files_per_trigger=1000),
                              once=False, interval_seconds=1)
    accept.processAllAvailable()                  # the window stage needs the first accepted batch
    windows = job.start_windows(once=False, interval_seconds=1)
    try:
        from vitrine.streaming.files import publish
        for i in (1, 2):   # published whole (write aside + rename) while the stages run
            publish(spark, noisy_event_log(slices[i]), f"{root}/source/slice={i}", f"{root}/_staging", fmt="text")
            accept.processAllAvailable()
            time.sleep(1)
        windows.processAllAvailable()
    finally:
        accept.stop()
        windows.stop()
    job.flush()
    stream = _rows(job.windows().select(*Q.WINDOW_OUT, "row_key"))
    batch = _rows(Q.emitted(Q.watermarked(spark, SF_SMALL)).select(*Q.WINDOW_OUT, "row_key"))
    assert stream == batch


CLICK = '{{"event_id":"{i}","event_type":"{kind}","event_time":{t},"ingestion_time":{i},"product_id":"P1"}}'


def _lines(spark, rows):
    return spark.createDataFrame([(CLICK.format(i=i, t=t, kind=kind),) for i, t, kind in rows], "value string")


def _live(spark, name, batches, **options):
    """Both stages over batches of (id, event time, type), one micro-batch of stage A each; no flush."""
    job = EventTimeJob(spark, scratch_path(spark, name), tolerance_ms=10, size_ms=40, slide_ms=20, threshold=1, **options)
    for k, rows in enumerate(batches):
        job.accept_batch(_lines(spark, rows), k)
        Q._await(job.start_windows(once=True))
    return job


def test_other_types_do_not_close_windows_early(spark):
    """A CART_ADD far ahead of the clicks moves the exact watermark, not that of the window stage: what it emits is closed."""
    batches = [[(1, 100, "CLICK"), (2, 100_000, "CART_ADD")], [(3, 100_000, "CLICK")], [(4, 100_070, "CLICK")]]
    job = _live(spark, "ahead", batches)
    emitted = job.native().select("window_start", "window_end", "row_key").collect()
    assert {r.window_start for r in emitted} >= {80, 100} and all(r.window_end <= job.close_watermark() for r in emitted)
    assert all(r.row_key == "Geral#P1" for r in emitted)
    job.flush()
    wm = Q.with_arrival_watermark(Q.J.good_events(Q.J.parse_json_lines(_lines(spark, sum(batches, [])))), 10)
    counts = Q.sliding_click_counts(wm.where("NOT is_late"), 40, 20)
    columns = ["window_start", "window_end", "product_id", "clicks", "row_key", "is_final", "category", "product_name"]
    assert _rows(job.windows().select(*columns)) == _rows(Q.emitted_windows(counts, wm).select(*columns))


def test_live_alerts_of_products_without_a_name(spark):
    job = _live(spark, "nameless", [[(1, 100, "CLICK")], [(2, 500, "CLICK")], [(3, 900, "CLICK")]])
    alerts = [r for r in job.alert_puts().where("alert_type = 'PRODUTO_EM_ALTA' OR product_id IS NOT NULL").collect()]
    assert alerts and {(r.product_name, r.category) for r in alerts} == {("P1", "Geral")}


def test_counters_add_up_across_a_replay(spark):
    """Observed while a batch is written; a replay whose data are published already counts the same."""
    batches = [[(1, 100, "CLICK"), (2, 80, "CLICK")], [(3, 300, "CART_ADD"), (4, 95, "CLICK")], [(5, 310, "OTHER")]]
    job = EventTimeJob(spark, scratch_path(spark, "counted"), tolerance_ms=10)
    for k, rows in enumerate(batches):
        if k == 1:
            job.fail_after = "publish"
            try:
                job.accept_batch(_lines(spark, rows), k)
                raise AssertionError("fault injection did not fire")
            except RuntimeError:
                job.fail_after = None
        job.accept_batch(_lines(spark, rows), k)
        job.accept_batch(_lines(spark, rows), k)
    got = {r.event_type: (r.total_events, r.late_events) for r in job.counters().collect()}
    assert got == {"CLICK": (3, 2), "CART_ADD": (1, 0), None: (1, 0)}


def _files(spark, path):
    import os
    return sum(len(f) for _, _, f in os.walk(path.removeprefix("file:")))


def test_many_batches_leave_few_files(spark):
    """Commit rows, and accepted files once the window stage has read them, do not pile up."""
    from vitrine.streaming import event_time as E
    job = EventTimeJob(spark, scratch_path(spark, "long"), tolerance_ms=10, size_ms=40, slide_ms=20)
    kept = []
    for k in range(36):
        job.accept_batch(_lines(spark, [(k, 1000 + 30 * k, "CLICK")]), k)
        if k % 3 == 2:
            Q._await(job.start_windows(once=True))
        if k % 12 == 11:
            kept.append((_files(spark, job.path("wm_state")), len(job._batch_ids("accepted"))))
    assert len(job._committed_ids()) <= E.KEPT_BATCHES + 1
    assert all(folders <= E.KEPT_BATCHES + 8 for _, folders in kept) and kept[-1][0] <= 4 * (E.KEPT_BATCHES + 1)
    job.flush()
    counts = Q.sliding_click_counts(spark.createDataFrame(
        [(1000 + 30 * k, None, "CLICK", "P1", None, None) for k in range(36)],
        "event_time long, ingestion_time long, event_type string, product_id string, category string, product_name string"), 40, 20)
    assert _rows(job.windows().select("window_start", "clicks")) == _rows(counts.select("window_start", "clicks"))
    assert [r.total_events for r in job.counters().collect()] == [36]


def test_restart_from_checkpoint_per_slice_equals_batch(spark):
    """Stop-at-end-of-input runs, one per arriving slice, each restarting both
    queries from their checkpoints (window state restored from the store)."""
    from vitrine.sources.driver_events import noisy_event_log
    from vitrine.streaming import landing as L
    root = scratch_path(spark, "restart")
    job = EventTimeJob(spark, root, Q.TOLERANCE_MS, Q.WINDOW_MS, Q.SLIDE_MS, Q.HOT_THRESHOLD)
    for i, part in enumerate(Q.arrival_slices(Q.events(spark, SF_SMALL), 3)):
        Q._write_text(noisy_event_log(part), f"{root}/source/slice={i}")
        Q._await(job.start_accept(L.line_stream(spark, f"{root}/source/*/*.txt"), once=True))
        Q._await(job.start_windows(once=True))
    assert len(job._committed_ids()) == 3
    job.flush()
    stream = _rows(job.windows().select(*Q.WINDOW_OUT, "row_key"))
    batch = _rows(Q.emitted(Q.watermarked(spark, SF_SMALL)).select(*Q.WINDOW_OUT, "row_key"))
    assert stream == batch
