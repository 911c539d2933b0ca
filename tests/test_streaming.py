"""Stream decode, batch-equals-stream, late data, restart and upsert replay."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cinelake.sources import fixtures as fx
from cinelake import replay
from cinelake.streaming import io, messages, windows
from cinelake.streaming.documents import DocumentStore
from cinelake.streaming.hot import HotFilmWatch, run_watched

SF = "/root/testdata/sf0.001"


def test_decode_bad_json_and_bad_field(spark):
    rows = [(b"k", b'{"userId": 1, "rating": 2.5, "timestamp": "2024-01-01 10:00:00"}'),
            (b"k", b"not json"),
            (b"k", b'{"userId": "x", "rating": 1.0}')]
    out = messages.decode(spark.createDataFrame(rows, "key binary, value binary")).collect()
    assert out[0].userId == 1 and out[0].rating == 2.5
    assert out[0].timestamp == dt.datetime(2024, 1, 1, 10, 0)
    assert all(v is None for v in out[1])
    assert out[2].userId is None and out[2].rating == 1.0


def test_encode_decode_roundtrip(spark):
    events = fx.stream_reviews(spark, SF)
    back = messages.decode(messages.encode(events), keep_key=True)
    first = back.orderBy("key").first()
    assert first.key.count("_") >= 2 and first.title.startswith("Film ")
    assert back.count() == events.count()


def _static_closed(spark, build, size_delay_s):
    """Run the stream function on a static frame and keep the windows the
    append sink would have closed: end <= max(event time) - delay."""
    events = messages.decode(replay.review_messages(spark, SF))
    movies = fx.movies(spark, SF)
    result = build(events, movies)
    cut = events.agg(F.max("timestamp")).first()[0] - dt.timedelta(seconds=size_delay_s)
    return windows.flatten_window(result.filter(F.col("window.end") <= F.lit(cut)))


@pytest.mark.parametrize("name,build,delay", [
    ("t1", lambda ev, mv: windows.film_counts(ev), 60),
    ("t4", windows.writer_ratings, 120),
])
def test_batch_equals_stream(spark, name, build, delay):
    streamed = replay.run_windowed(spark, SF, build, name)
    static = _static_closed(spark, build, delay)
    cols = sorted(streamed.columns)
    a = sorted((tuple(r) for r in streamed.select(cols).collect()), key=repr)
    b = sorted((tuple(r) for r in static.select(cols).collect()), key=repr)
    assert a == b and len(a) > 0


def test_late_rows_are_dropped_and_counted(spark):
    first, second = replay.halves(spark, SF)
    r = replay.Replay(spark, SF, "late")
    build = lambda ev, mv: windows.film_counts(ev)
    for where in (first, second):
        r.publish(where)
        r.drain(build)
    before = spark.read.parquet(r.out).count()
    r.progress.clear()
    r.publish(first)  # the whole first half again, long behind the watermark
    r.drain(build)
    assert r.dropped_late_rows() > 0
    assert spark.read.parquet(r.out).count() == before


def test_restart_without_new_data_changes_nothing(spark):
    r = replay.Replay(spark, SF, "restart")
    build = lambda ev, mv: windows.film_counts(ev)
    r.publish()
    r.drain(build)
    rows = sorted(map(tuple, spark.read.parquet(r.out).collect()))
    r.drain(build)  # same checkpoint, nothing new
    assert sorted(map(tuple, spark.read.parquet(r.out).collect())) == rows


def _docs(spark, store):
    return sorted((r.doc_id, r.v) for r in store.read().collect())


def test_upsert_batch_is_idempotent(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "docs"), order=("batch_id",))
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "doc_id string, v int")
    store.merge(batch, 0)
    store.merge(spark.createDataFrame([("a", 9)], "doc_id string, v int"), 0)  # committed: a replay changes nothing
    assert _docs(spark, store) == [("a", 1), ("b", 2)]
    store.merge(spark.createDataFrame([("a", 5)], "doc_id string, v int"), 1)
    store.merge(spark.createDataFrame([], "doc_id string, v int"), 2)
    assert _docs(spark, store) == [("a", 5), ("b", 2)]
    assert [tuple(r) for r in io.latest_documents(spark, store.path, ("batch_id",)).select("doc_id", "v").orderBy("v").collect()] == [
        ("b", 2), ("a", 5)]


def test_document_store_stays_bounded(spark, tmp_path):
    """Files do not grow with the number of batches; values are those of plain upserts."""
    store = DocumentStore(spark, str(tmp_path / "docs"), order=("batch_id",), buckets=4)
    want, files = {}, []
    for n in range(6):
        rows = [(f"d{k}", 100 * n + k) for k in range(n, n + 20)]
        want.update(rows)
        store.merge(spark.createDataFrame(rows, "doc_id string, v int"), n)
        assert dict(_docs(spark, store)) == want
        files.append(len(list(tmp_path.glob("docs/**/part-*.parquet"))))
    assert max(files[1:]) <= 2 * 4 and len(list(tmp_path.glob("docs/_commits/0*"))) == 2


def test_a_batch_lost_half_way_leaves_the_last_commit(spark, tmp_path, monkeypatch):
    store = DocumentStore(spark, str(tmp_path / "docs"), order=("batch_id",), buckets=2)
    store.merge(spark.createDataFrame([("a", 1), ("b", 2)], "doc_id string, v int"), 0)
    late = spark.createDataFrame([("a", 3), ("c", 4)], "doc_id string, v int")
    with monkeypatch.context() as m:
        m.setattr(store.versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.merge(late, 1)
    assert _docs(spark, store) == [("a", 1), ("b", 2)]
    store.merge(late, 1)
    assert _docs(spark, store) == [("a", 3), ("b", 2), ("c", 4)]
    assert len(list(tmp_path.glob("docs/v=*"))) <= 2  # what the lost batch wrote is removed


def test_unrated_group_counts_zero(spark):
    ts = dt.datetime(2024, 1, 1, 0, 0, 5)
    events = spark.createDataFrame([(1, None, ts)], "imdbId int, rating float, timestamp timestamp")
    movies = spark.createDataFrame([(1, "W1,W2")], "imdb_id int, writer string")
    out = windows.writer_ratings(events, movies).collect()
    assert sorted((r.writer_name, r.review_count, r.avg_rating) for r in out) == [
        ("W1", 0, None), ("W2", 0, None)]


def test_doc_ids(spark):
    df = spark.createDataFrame([("Drama", "English")], "genre string, language string")
    assert windows.with_doc_id(df, "genre_language").first().doc_id == "Drama_English"


def test_save_all_three_sinks(spark, tmp_path):
    r = replay.Replay(spark, SF, "sinks")
    r.publish()
    result = windows.director_counts(r.events(), r.movies)
    root = str(tmp_path / "t3")
    started = io.save_all(result, root, ["director_name"], lambda df: windows.with_doc_id(df, "director_name"))
    io.run_all(started)
    assert len(started) == 1 and len(started[0].lastProgress["sources"]) == 1
    history = spark.read.parquet(f"{root}/history").count()
    docs = io.latest_documents(spark, f"{root}/documents").count()
    assert history > 0 and 0 < docs <= history
    assert not list(tmp_path.glob("t3/_batches/*"))


def _save(spark, r, root, fail=None):
    result = windows.director_counts(r.events(), r.movies)
    if fail is None:
        io.run_all(io.save_all(result, root, ["director_name"], lambda df: windows.with_doc_id(df, "director_name")))
    else:
        with pytest.raises(Exception, match="sink is gone"):
            io.run_all(io.save_all(result, root, ["director_name"], fail))


def _saved(spark, root):
    history = windows.flatten_window(spark.read.parquet(f"{root}/history").drop("batch_id"))
    docs = windows.flatten_window(io.latest_documents(spark, f"{root}/documents").drop("batch_id", "window_end"))
    return [sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr) for df in (history, docs)]


def test_restart_after_a_failure_between_two_sinks(spark, tmp_path):
    """The batch has reached the history when its second sink fails; after restarts the
    sinks hold what an undisturbed run leaves, and what the append mode writes."""
    first, second = replay.halves(spark, SF)
    calm, broken = replay.Replay(spark, SF, "calm"), replay.Replay(spark, SF, "broken")
    for r, root in ((calm, str(tmp_path / "calm")), (broken, str(tmp_path / "broken"))):
        for where in (first, second):
            r.publish(where)
            if r is broken:
                _save(spark, r, root, lambda df: (_ for _ in ()).throw(RuntimeError("sink is gone")))
            _save(spark, r, root)
    assert _saved(spark, str(tmp_path / "calm")) == _saved(spark, str(tmp_path / "broken"))
    static = _static_closed(spark, windows.director_counts, 60)
    assert _saved(spark, str(tmp_path / "calm"))[0] == sorted(map(tuple, static.select(sorted(static.columns)).collect()), key=repr)


def test_a_replayed_batch_adds_no_row_to_an_index_without_ids(spark, tmp_path):
    r = replay.Replay(spark, SF, "ledger")
    r.publish()
    run = lambda: io.run_all([io.index(windows.director_counts(r.events(), r.movies), str(tmp_path / "c"), "parquet",
                                       {"path": str(tmp_path / "index")}, mode="append")])
    run()
    rows = spark.read.parquet(str(tmp_path / "index")).count()
    for commit in sorted((tmp_path / "c" / "commits").glob("[0-9]*"))[-2:] + sorted((tmp_path / "c" / "commits").glob(".[0-9]*"))[-2:]:
        commit.unlink()  # as if the driver was lost after the connector's write
    run()
    assert rows > 0 and spark.read.parquet(str(tmp_path / "index")).count() == rows


def test_send_time_stamp(spark):
    events = fx.stream_reviews(spark, SF).limit(3)
    stamped = messages.decode(messages.encode(events, stamp_send_time=True))
    assert all(r.timestamp.year >= 2025 for r in stamped.collect())


def test_event_inside_the_delay_is_kept(spark, tmp_path):
    """Out of order but within the watermark delay: still counted."""
    topic = io.Topic(str(tmp_path / "topic"))
    base = dt.datetime(2024, 1, 1, 12, 0, 0)

    def send(rows):
        df = spark.createDataFrame(rows, "userId int, movieId int, title string, timestamp timestamp")
        io.publish(messages.encode(df), topic)

    out, chk = str(tmp_path / "out"), str(tmp_path / "chk")
    counts = lambda: windows.film_counts(messages.decode(io.subscribe(spark, topic)))
    send([(1, 7, "Film 7", base + dt.timedelta(minutes=5))])
    io.run_all([io.append_files(counts(), out, chk)])
    # Watermark is now 12:04. 12:04:10 is late for the newest window but inside
    # the delay; 12:01 is behind the watermark and dropped.
    send([(2, 7, "Film 7", base + dt.timedelta(minutes=4, seconds=10)),
          (3, 7, "Film 7", base + dt.timedelta(minutes=1)),
          (4, 7, "Film 7", base + dt.timedelta(minutes=20))])
    io.run_all([io.append_files(counts(), out, chk)])
    got = {(r.window.start.replace(tzinfo=None), r["count"]) for r in spark.read.parquet(out).collect()}
    # Closed at watermark 12:19: both windows of 12:04:10 (kept although out of
    # order) and both of 12:05; none of the dropped 12:01; 12:20's still open.
    want = {(base + dt.timedelta(minutes=m, seconds=s), 1) for m, s in ((3, 30), (4, 0), (4, 30), (5, 0))}
    assert got == want


def test_console_sink_runs(spark, capsys):
    r = replay.Replay(spark, SF, "console")
    r.publish()
    io.run_all([io.console(windows.director_counts(r.events(), r.movies), "update",
                           checkpoint=r.checkpoint)])


def test_salted_join_equals_the_plain_one(spark):
    events = messages.decode(replay.review_messages(spark, SF))
    movies = fx.movies(spark, SF)
    hot = windows.hot_films(events, share=0.01, salts=5)
    assert 0 < len(hot.ids) <= 100
    for build in (windows.genre_language_rating, windows.director_counts, windows.writer_ratings, windows.rating_vs_audience):
        plain, salted = (sorted(map(tuple, windows.flatten_window(build(events, movies, hot=h)).collect()), key=repr)
                         for h in (None, hot))
        assert plain == salted and plain


def test_salted_stream_equals_batch(spark):
    hot = windows.HotFilms(tuple(range(1, 40)), 4)
    build = lambda ev, mv: windows.director_counts(ev, mv, hot=hot)
    streamed = replay.run_windowed(spark, SF, build, "salted")
    static = _static_closed(spark, windows.director_counts, 60)
    assert sorted(map(tuple, streamed.collect()), key=repr) == sorted(map(tuple, static.select(streamed.columns).collect()), key=repr)


def test_encoding_runs_no_job(spark):
    rows = fx.reviews(spark, SF).groupBy("movie_id").count().selectExpr(
        "1 AS userId", "CAST(movie_id AS INT) AS movieId", "timestamp'2024-01-01 00:00:00' AS timestamp")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("encode-test", "encode")
    messages.encode(rows, partitions=3)
    messages.encode(rows)
    jobs = tracker.getJobIdsForGroup("encode-test")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_send_time_without_a_time_column(spark):
    rows = fx.stream_reviews(spark, SF).limit(3).drop("timestamp")
    back = messages.decode(messages.encode(rows, stamp_send_time=True), keep_key=True).collect()
    assert len(back) == 3 and all(r.timestamp is not None and r.key.count("_") == 2 for r in back)


def test_a_failing_sink_stops_the_others(spark, tmp_path):
    r = replay.Replay(spark, SF, "failing")
    r.publish()
    result = windows.director_counts(r.events(), r.movies)
    endless = io.append_files(result, str(tmp_path / "a"), str(tmp_path / "ca"), trigger={"processingTime": "1 second"})

    def fail(batch, batch_id):
        raise RuntimeError("sink is gone")

    failing = result.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "cb")) \
        .foreachBatch(fail).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="sink is gone"):
        io.run_all([endless, failing])
    assert not endless.isActive


def test_index_sink_upserts_by_id_with_connector_options(spark, tmp_path):
    r = replay.Replay(spark, SF, "index")
    r.publish()
    result = windows.with_doc_id(windows.director_counts(r.events(), r.movies), "director_name")
    # A file format stands in for the connector; "compression" for its id option.
    io.run_all([io.index(result, str(tmp_path / "c"), "parquet", {"path": str(tmp_path / "index")})])
    got = spark.read.parquet(str(tmp_path / "index"))
    assert got.where("doc_id is null").count() == 0 and got.count() > 0


# -- hot films found in the stream ------------------------------------------------------

def test_counters_fade_and_stay_bounded(spark, tmp_path):
    watch = HotFilmWatch(spark, str(tmp_path / "hot"), share=0.1)
    watch.add(0, 1000, {1: 900, **{k: 1 for k in range(100, 200)}})
    assert watch.hot().ids == (1,) and len(watch.counts) <= watch.slots
    for n in range(1, 9):
        watch.add(n, 1000, {2: 500})
    assert watch.hot().ids == (2,)  # film 1 has faded
    again = HotFilmWatch(spark, str(tmp_path / "hot"), share=0.1)
    assert again.hot() == watch.hot() and again.seen == 8 and again.counts == watch.counts
    assert HotFilmWatch(spark, known=[7]).hot().ids == (7,) and HotFilmWatch(spark).hot() is None


def _hot_events(spark, n, hot):
    """Events of one minute: a third of them one film's, if hot."""
    base = dt.datetime(2024, 1, 1, 0, n)
    rows = [(k, 7 if hot and k % 3 == 0 else k % 60, 1.0 + k % 4, base + dt.timedelta(seconds=k % 60)) for k in range(300)]
    return spark.createDataFrame(rows, "userId int, imdbId int, rating float, timestamp timestamp").selectExpr(
        "userId", "imdbId as movieId", "rating", "concat('Film ', imdbId) as title", "imdbId", "timestamp")


def test_a_film_that_turns_hot_is_salted_from_the_next_batch_on(spark, tmp_path):
    """No film is named by hand; the result is that of the batch computation."""
    movies, topic, root = fx.movies(spark, SF), io.Topic(str(tmp_path / "topic")), str(tmp_path / "out")
    used = []
    for n in range(5):
        io.publish(messages.encode(_hot_events(spark, n, n >= 2)), topic)
        watch = HotFilmWatch(spark, f"{root}/hot", share=0.15, salts=4)

        def start(salted):
            used.append((n, salted.ids if salted else ()))
            result = windows.director_counts(watch.watched(messages.decode(io.subscribe(spark, topic))), movies, hot=salted)
            return io.save_all(result, root, ["director_name"], lambda df: windows.with_doc_id(df, "director_name"))

        run_watched(start, watch)
    assert [i for n, i in used if n <= 2][:3] == [(), (), ()] and used[-1] == (4, (7,))
    events = messages.decode(spark.read.parquet(topic.path))
    cut = events.agg(F.max("timestamp")).first()[0] - dt.timedelta(seconds=60)
    static = windows.flatten_window(windows.director_counts(events, movies).filter(F.col("window.end") <= F.lit(cut)))
    assert _saved(spark, root)[0] == sorted(map(tuple, static.select(sorted(static.columns)).collect()), key=repr)


def test_a_running_query_is_restarted_with_new_salts(spark, tmp_path):
    movies, topic, root = fx.movies(spark, SF), io.Topic(str(tmp_path / "topic")), str(tmp_path / "out")
    for n in range(4):
        io.publish(messages.encode(_hot_events(spark, n, True)).coalesce(1), topic)
    watch, used = HotFilmWatch(spark, f"{root}/hot", share=0.15, salts=4), []

    def start(salted):
        used.append(salted)
        events = messages.decode(io.subscribe(spark, topic, {"maxFilesPerTrigger": "1"}))
        return io.save_all(windows.director_counts(watch.watched(events), movies, hot=salted), root, ["director_name"])

    run_watched(start, watch)
    assert used[0] is None and used[-1].ids == (7,) or len(used) == 1  # one start if the stream ended before the first look
    history = spark.read.parquet(f"{root}/history")
    events = messages.decode(spark.read.parquet(topic.path))
    cut = events.agg(F.max("timestamp")).first()[0] - dt.timedelta(seconds=60)
    want = windows.director_counts(events, movies).filter(F.col("window.end") <= F.lit(cut))
    assert sorted(map(tuple, history.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


# -- dead letters ----------------------------------------------------------------------------

def test_every_message_is_sorted(spark, tmp_path):
    rows = [(b"k", b'{"userId": 1, "timestamp": "2024-01-01 10:00:00"}'), (b"k", b"not json"), (b"k", None), (None, b""),
            (b"k", b'{"userId": "x", "timestamp": "soon"}'), (b"k", b'{"userId": 1}'), (b"k", b"[1, 2]"), (b"k", b'{"userId": 1')]
    got = [r.reason for r in messages.triage(spark.createDataFrame(rows, "key binary, value binary")).collect()]
    assert got == [None, "undecodable", "undecodable", "undecodable", "no event time", "no event time", "undecodable", "undecodable"]


def test_diverted_events_can_be_read_as_a_topic(spark, tmp_path):
    r = replay.Replay(spark, SF, "divert")
    io.publish(replay.flawed_messages(spark, SF), r.topic)
    events, dead, checkpoint = (str(tmp_path / n) for n in ("events", "dead", "checkpoint"))
    for _ in range(2):  # the second run finds nothing new
        io.run_all([io.divert(io.subscribe(spark, r.topic), events, dead, checkpoint)])
    total = fx.stream_reviews(spark, SF).count()
    good = messages.decode(spark.read.option("recursiveFileLookup", "true").parquet(events))
    assert spark.read.parquet(dead).count() + good.count() == total and spark.read.parquet(dead).count() >= 3 * (total // 50)
    assert good.where("timestamp is null").count() == 0
    result = windows.film_counts(messages.decode(io.subscribe(spark, io.Topic(events))))
    io.run_all([io.append_files(result, str(tmp_path / "out"), str(tmp_path / "c2"))])
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
