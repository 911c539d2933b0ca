"""Job entry points over a materialised transform zone."""

import pytest
from pyspark.sql import functions as F

from cinelake import jobs, replay
from cinelake.plans import batch
from cinelake.sources import fixtures as fx
from cinelake.sources import zones

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def zone(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("zone")
    zones.write_table(fx.movies(spark, SF), str(root / "movies"))
    zones.write_table(fx.reviews(spark, SF).drop("l_orderkey", "l_linenumber"), str(root / "reviews"),
                      partition_by=["creationDate"])
    return root


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_batch_job_reads_zone_and_writes_curated(spark, zone):
    cur = str(zone / "curated")
    jobs.main(["batch", "b01", "--movies", str(zone / "movies"), "--reviews", str(zone / "reviews"),
               "--curated", cur], spark=spark)
    written = spark.read.json(f"{cur}/batch_query_1").select("creationDate", "genre", "count")
    direct = batch.top_genre_per_year(fx.movies(spark, SF), fx.reviews(spark, SF))
    assert _rows(written) == _rows(direct)


def test_b09_job_writes_two_reports(spark, zone):
    cur = str(zone / "curated9")
    jobs.main(["batch", "b09", "--movies", str(zone / "movies"), "--reviews", str(zone / "reviews"),
               "--curated", cur], spark=spark)
    pos = spark.read.json(f"{cur}/batch_query_9_positive")
    neg = spark.read.json(f"{cur}/batch_query_9_negative")
    assert pos.count() == 3 and neg.count() == 3
    assert pos.orderBy(F.desc("POSITIVE")).first().POSITIVE >= neg.orderBy(F.desc("POSITIVE")).first().POSITIVE


def test_year_filter_prunes_zone_partitions(spark, zone):
    reviews = zones.read_table(spark, str(zone / "reviews"))
    plan = batch.directors_in_years(zones.read_table(spark, str(zone / "movies")), reviews, 1998, 2000) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(creationDate" in plan


def test_stream_job_once(spark, zone):
    r = replay.Replay(spark, SF, "job")
    r.publish()
    out = str(zone / "t3")
    jobs.main(["stream", "t3", "--topic", r.topic.path, "--movies", str(zone / "movies"), "--out", out,
               "--doc-ids", "--once"], spark=spark)
    assert spark.read.parquet(f"{out}/history").count() > 0
    assert spark.read.parquet(f"{out}/documents").select("doc_id").distinct().count() > 0


def test_every_batch_plan_agrees_on_zone_and_views(spark, tmp_path):
    from cinelake import catalog
    movies_path, reviews_path = catalog.write_zone(spark, SF, str(tmp_path / "z"))
    movies, reviews = zones.read_table(spark, movies_path), zones.read_table(spark, reviews_path)
    for key, plan in catalog.BATCH_PLANS.items():
        on_zone = plan(movies, reviews)
        on_views = catalog.BATCH[key](spark, SF)
        cols = sorted(on_views.columns)
        assert _rows(on_zone.select(cols)) == _rows(on_views.select(cols)), key


def test_etl_subcommands_end_to_end(spark, tmp_path):
    """land -> clean-reviews / conform-movies / flatten through the job CLI."""
    src = tmp_path / "src"
    for name, df in {"reviews": fx.raw_reviews(spark, SF), "movies": fx.raw_movies(spark, SF),
                     "mapper": fx.mapper(spark, SF), "movies_imdb": fx.imdb(spark, SF),
                     "links": fx.links(spark, SF), "ratings": fx.ratings(spark, SF),
                     "stream_movies": fx.stream_movies(spark, SF)}.items():
        zones.write_table(df, str(src / name), "csv")
    raw = str(tmp_path / "raw")
    sources = ["reviews", "movies", "mapper", "movies_imdb", "links"]
    jobs.main(["land", "--raw", raw] + sum([["--source", f"{n}={src / n}"] for n in sources], []), spark=spark)
    jobs.main(["land", "--raw", f"{raw}/streaming", "--source", f"ratings={src / 'ratings'}",
               "--source", f"movies={src / 'stream_movies'}"], spark=spark)

    jobs.main(["clean-reviews", "--raw", f"{raw}/reviews", "--out", str(tmp_path / "t_reviews")], spark=spark)
    cleaned = zones.read_table(spark, str(tmp_path / "t_reviews"))
    assert cleaned.count() == fx.raw_reviews(spark, SF).count()
    assert set(cleaned.columns) >= {"movie_id", "creationDate", "originalScore", "scoreSentiment"}

    jobs.main(["conform-movies", "--raw", raw, "--out", str(tmp_path / "t_movies")], spark=spark)
    assert zones.read_table(spark, str(tmp_path / "t_movies")).filter(F.col("imdb_id").isNotNull()).count() > 0

    jobs.main(["flatten", "--raw", raw, "--out", str(tmp_path / "flat")], spark=spark)
    from cinelake.plans import prep
    want = prep.flatten_stream_input(fx.ratings(spark, SF), fx.links(spark, SF), fx.stream_movies(spark, SF))
    assert zones.read_table(spark, str(tmp_path / "flat"), "csv").count() == want.count()


def test_stream_job_bounded_batches(spark, zone):
    r = replay.Replay(spark, SF, "bounded")
    first, second = replay.halves(spark, SF)
    r.publish(first)
    r.publish(second)
    out = str(zone / "t1b")
    jobs.main(["stream", "t1", "--topic", r.topic.path, "--movies", str(zone / "movies"), "--out", out,
               "--once", "--max-per-trigger", "2"], spark=spark)
    assert spark.read.parquet(f"{out}/history").count() > 0


def test_publish_job_keeps_known_films(spark, zone, tmp_path):
    from cinelake.plans import prep
    from cinelake.streaming import io, messages
    flat = prep.flatten_stream_input(fx.ratings(spark, SF), fx.links(spark, SF), fx.stream_movies(spark, SF))
    zones.write_table(flat, str(tmp_path / "flat"), "csv")
    topic = str(tmp_path / "topic")
    jobs.main(["publish", "--flat", str(tmp_path / "flat"), "--movies", str(zone / "movies"), "--topic", topic,
               "--event-time", "--partitions", "3"], spark=spark)
    sent = messages.decode(spark.read.parquet(topic))
    want = prep.known_film_reviews(flat, fx.movies(spark, SF))
    assert sent.count() == want.count() < flat.count()
    assert sent.where("timestamp is null").count() == 0
    kafka = jobs._topic(jobs.parser().parse_args(["publish", "--flat", "f", "--movies", "m", "--kafka-servers", "h:1"]))
    assert kafka.write_options == {"topic": "reviews-topic"} and "subscribe" not in {**kafka.options, **kafka.write_options}
    assert isinstance(kafka, io.Topic)


def test_stream_job_upserts_by_default_and_takes_an_index(spark, zone, tmp_path):
    r = replay.Replay(spark, SF, "job-index")
    r.publish()
    out, index = str(tmp_path / "o"), str(tmp_path / "index")
    jobs.main(["stream", "t2", "--topic", r.topic.path, "--movies", str(zone / "movies"), "--out", out, "--once",
               "--index-format", "parquet", "--index-option", f"path={index}", "--hot-film", "7"], spark=spark)
    assert spark.read.parquet(index).where("doc_id is null").count() == 0
    assert spark.read.parquet(f"{out}/history").count() > 0


def test_b08_preview_prints_titles(spark, zone, capfd):
    jobs.main(["batch", "b08", "--movies", str(zone / "movies"), "--reviews", str(zone / "reviews"), "--curated",
               str(zone / "c8"), "--show", "--set", "min_positive=5"], spark=spark)
    assert "total_reviews" in capfd.readouterr().out


def test_batch_job_parameters(spark, zone):
    cur = str(zone / "curated4")
    jobs.main(["batch", "b04", "--movies", str(zone / "movies"), "--reviews", str(zone / "reviews"),
               "--curated", cur, "--set", "min_positive=5", "--set", "top_writers=2"], spark=spark)
    written = spark.read.json(f"{cur}/batch_query_4")
    assert written.select("writer").distinct().count() == 2


def test_conform_job_dedupe_flag(spark, tmp_path):
    raw = str(tmp_path / "raw")
    zones.land({"movies": fx.raw_movies(spark, SF), "mapper": fx.mapper(spark, SF),
                "movies_imdb": fx.imdb(spark, SF)}, raw)
    jobs.main(["conform-movies", "--raw", raw, "--out", str(tmp_path / "m"), "--dedupe-on-title"], spark=spark)
    assert zones.read_table(spark, str(tmp_path / "m")).count() == fx.raw_movies(spark, SF).count()
