"""Zone I/O, partition pruning and the ETL jobs."""

import pytest
from pyspark.sql import functions as F

from cinelake.plans import batch, prep
from cinelake.sources import fixtures as fx
from cinelake.sources import schemas, zones

SF = "/root/testdata/sf0.001"


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    raw = fx.raw_movies(spark, SF)
    assert raw.columns != schemas.RAW_MOVIES.names  # another order in the file
    paths = zones.land({"movies": raw}, str(tmp_path), "csv")
    back = zones.read_table(spark, paths["movies"], "csv", schemas.RAW_MOVIES)
    assert back.schema == schemas.RAW_MOVIES
    assert back.exceptAll(raw.select(back.columns)).count() == 0 and back.count() == raw.count()
    assert back.filter(F.col("boxOffice").isNull()).count() > 0


def test_csv_headers_are_checked(spark, tmp_path):
    raw = fx.raw_reviews(spark, SF)
    zones.write_table(raw.drop("isTopCritic"), str(tmp_path / "missing"), "csv")
    with pytest.raises(ValueError, match="isTopCritic"):
        zones.read_table(spark, str(tmp_path / "missing"), "csv", schemas.RAW_REVIEWS)
    zones.write_table(raw.withColumnRenamed("reviewText", "text"), str(tmp_path / "renamed"), "csv")
    with pytest.raises(ValueError, match="reviewText"):
        prep.run_clean_reviews(spark, str(tmp_path / "renamed"), str(tmp_path / "out"))
    zones.write_table(raw.withColumn("extra", F.lit("x")), str(tmp_path / "extra"), "csv")
    with pytest.raises(ValueError, match="extra"):
        zones.read_table(spark, str(tmp_path / "extra"), "csv", schemas.RAW_REVIEWS)
    kept = zones.read_table(spark, str(tmp_path / "extra"), "csv", schemas.RAW_REVIEWS, extra="keep")
    assert kept.columns == [*schemas.RAW_REVIEWS.names, "extra"] and kept.select("extra").first().extra == "x"
    dropped = zones.read_table(spark, str(tmp_path / "extra"), "csv", schemas.RAW_REVIEWS, extra="drop")
    assert dropped.schema == schemas.RAW_REVIEWS
    # Files of one folder whose columns are ordered differently do not mix.
    mixed = str(tmp_path / "mixed")
    zones.write_table(raw.select(sorted(raw.columns)).coalesce(1), mixed, "csv")
    zones.write_table(raw.select(sorted(raw.columns, reverse=True)).coalesce(1), mixed, "csv", mode="append")
    with pytest.raises(Exception, match="(?i)header"):
        zones.read_table(spark, mixed, "csv", schemas.RAW_REVIEWS).collect()


def test_reviews_without_ids_are_imputed_by_the_whole_row(spark, tmp_path):
    raw = fx.raw_reviews(spark, SF).drop("reviewId")
    zones.write_table(raw, str(tmp_path / "raw"), "csv")
    prep.run_clean_reviews(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    out = zones.read_table(spark, str(tmp_path / "out"))
    assert out.count() == raw.count() and "reviewId" not in out.columns
    assert out.where("scoreSentiment is null or originalScore is null").count() == 0


def test_clean_job_keeps_critics_and_sentiments(spark, tmp_path):
    """A raw review's own values survive the job whatever its column order."""
    raw = spark.createDataFrame([("POSITIVE", "m1", True, "r1")], "scoreSentiment string, id string, isTopCritic boolean, reviewId string")
    for f in schemas.RAW_REVIEWS:
        if f.name not in raw.columns:
            raw = raw.withColumn(f.name, F.lit("2020-05-01" if f.name == "creationDate" else "t").cast(f.dataType))
    zones.write_table(raw, str(tmp_path / "raw"), "csv")
    prep.run_clean_reviews(spark, str(tmp_path / "raw"), str(tmp_path / "out"), fmt="csv")
    back = zones.read_table(spark, str(tmp_path / "out"), "csv", schemas.REVIEWS).first()
    assert (back.movie_id, back.isTopCritic, back.scoreSentiment, back.creationDate) == ("m1", True, "POSITIVE", 2020)
    assert back.originalScore is not None


def test_times_are_read_as_epoch_or_text(spark, tmp_path):
    rows = [(1, "1136073600"), (2, "1136073600000"), (3, "2006-01-01 00:00:00"), (4, "soon"), (5, None)]
    given = spark.createDataFrame(rows, "movieId int, timestamp string").selectExpr(
        "1 AS userId", "movieId", "'3.5' AS rating", "timestamp")
    zones.write_table(given, str(tmp_path / "r"), "csv")
    got = {r.movieId: r.timestamp for r in zones.read_table(spark, str(tmp_path / "r"), "csv", schemas.RATINGS).collect()}
    assert got[1] == got[2] == got[3] and got[1].year == 2006 and got[4] is None and got[5] is None


def test_chain_from_raw_csv_to_batch_questions(spark, tmp_path):
    raw = str(tmp_path / "raw")
    zones.land({"movies": fx.raw_movies(spark, SF), "reviews": fx.raw_reviews(spark, SF),
                "mapper": fx.mapper(spark, SF), "movies_imdb": fx.imdb(spark, SF)}, raw)
    for fmt in ("parquet", "csv"):
        movies, reviews = str(tmp_path / fmt / "movies"), str(tmp_path / fmt / "reviews")
        prep.run_clean_reviews(spark, f"{raw}/reviews", reviews, fmt)
        prep.run_conform_movies(spark, raw, movies, fmt, dedupe_on_title=True)
        tables = (zones.read_table(spark, movies, fmt, schemas.MOVIES if fmt == "csv" else None),
                  zones.read_table(spark, reviews, fmt, schemas.REVIEWS if fmt == "csv" else None))
        best = batch.top_genre_per_year(*tables).collect()
        assert len(best) > 0 and batch.certified_films(*tables, min_positive=10).count() >= 0
        want = batch.top_genre_per_year(fx.movies(spark, SF), fx.reviews(spark, SF)).collect()
        assert sorted(map(tuple, best)) == sorted(map(tuple, want))


def test_partitioned_write_makes_about_one_file_a_year(spark, tmp_path):
    rows = fx.reviews(spark, SF).repartition(16)
    zones.write_table(rows, str(tmp_path / "z"), partition_by=["creationDate"])
    years = rows.select("creationDate").distinct().count()
    files = len(list((tmp_path / "z").glob("creationDate=*/*.parquet")))
    assert years <= files <= 2 * years


def test_work_folder_is_not_made_on_the_driver_of_a_cluster():
    from cinelake import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Spark:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_dir(Spark())


def test_clean_reviews_partitioned_and_pruned(spark, tmp_path):
    raw = str(tmp_path / "raw")
    zones.write_table(fx.raw_reviews(spark, SF), raw, "csv")
    out = str(tmp_path / "reviews")
    prep.run_clean_reviews(spark, raw, out)
    reviews = zones.read_table(spark, out)
    assert {p.name.split("=")[0] for p in (tmp_path / "reviews").iterdir() if "=" in p.name} == {"creationDate"}
    q = reviews.filter((F.col("creationDate") >= 1998) & (F.col("creationDate") < 2000))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(creationDate" in plan
    assert q.count() == fx.raw_reviews(spark, SF).filter(F.year("creationDate").between(1998, 1999)).count()
    assert reviews.filter(~F.col("scoreSentiment").isin("POSITIVE", "NEGATIVE")).count() == 0


def test_write_many_and_json(spark, tmp_path):
    df = fx.movies(spark, SF).select("movie_id", "title")
    targets = [{"path": str(tmp_path / "a"), "fmt": "json"}, {"path": str(tmp_path / "b")}]
    zones.write_many(df, targets)
    assert spark.read.json(targets[0]["path"]).count() == spark.read.parquet(targets[1]["path"]).count()


def test_conform_movies_fanout_and_ids(spark):
    movies = prep.conform_movies(fx.raw_movies(spark, SF), fx.mapper(spark, SF), fx.imdb(spark, SF))
    raw = fx.raw_movies(spark, SF).count()
    dup = fx.mapper(spark, SF).groupBy("title").count().filter("count > 1").count()
    assert movies.count() == raw + dup
    row = movies.filter(F.col("movie_id") == "3").first()
    assert row.imdb_id == 3 and row.tmdb_id == 100003


def test_title_joins_leave_no_side_unsplit(spark):
    """A title that an id list holds very often: its rows are dealt over salts (that they land in
    several tasks: test_a_frequent_key_is_dealt_over_tasks), as a left join splits its left side only."""
    movies = spark.createDataFrame([(1, "A", "$1M"), (2, "B", None), (3, None, None)], "id long, title string, boxOffice string")
    mapper = spark.range(25_000).selectExpr("'A' AS title", "id AS movie_id")
    imdb = spark.createDataFrame([("tt0000007", "B"), (None, "A")], "id string, name string")
    out = prep.conform_movies(movies, mapper, imdb)
    assert "__salt" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.where("title = 'A'").count() == 25_000 and out.where("title = 'A' and imdb_id is null").count() == 25_000
    rest = {r.movie_id: (r.tmdb_id, r.imdb_id) for r in out.where("movie_id <> 1").collect()}
    assert rest == {2: (None, 7), 3: (None, None)}


def test_parity_box_office_drops_billions(spark):
    raw = spark.createDataFrame([(1, "T", "$1.5B")], "id long, title string, boxOffice string")
    empty_m = spark.createDataFrame([], "title string, movie_id long")
    empty_i = spark.createDataFrame([], "id string, name string")
    ours = prep.conform_movies(raw, empty_m, empty_i).first().boxOffice
    parity = prep.conform_movies(raw, empty_m, empty_i, suffixes=("K", "M"), missing=None).first().boxOffice
    assert ours == 1.5e9 and parity is None


def test_known_film_filter_is_null_safe(spark):
    flat = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "userId int, imdbId int")
    movies = spark.createDataFrame([(10,), (None,)], "imdb_id int")
    assert sorted(r.userId for r in prep.known_film_reviews(flat, movies).collect()) == [1, 2]


def test_conform_job_and_curated_output(spark, tmp_path):
    from cinelake.plans import curated
    raw = str(tmp_path / "raw")
    zones.land({"movies": fx.raw_movies(spark, SF), "mapper": fx.mapper(spark, SF),
                "movies_imdb": fx.imdb(spark, SF)}, raw)
    coverage = prep.run_conform_movies(spark, raw, str(tmp_path / "movies")).first()
    assert 0 < coverage.films_with_id < coverage.total_films
    curated.publish_result(spark.read.parquet(str(tmp_path / "movies")), "q", str(tmp_path / "cur"))
    assert spark.read.json(str(tmp_path / "cur" / "q")).count() == coverage.total_films


def test_flatten_job(spark, tmp_path):
    raw = str(tmp_path / "raw")
    zones.land({"streaming/ratings": fx.ratings(spark, SF), "links": fx.links(spark, SF),
                "streaming/movies": fx.stream_movies(spark, SF)}, raw)
    prep.run_flatten_stream_input(spark, raw, str(tmp_path / "flat"))
    flat = zones.read_table(spark, str(tmp_path / "flat"), "csv")
    want = prep.flatten_stream_input(fx.ratings(spark, SF), fx.links(spark, SF), fx.stream_movies(spark, SF))
    assert flat.count() == want.count()


def test_curated_index_path_uses_connector_format(spark, tmp_path):
    from cinelake.plans import curated
    df = fx.movies(spark, SF).select("movie_id", "title")
    index = str(tmp_path / "index")  # a file format stands in for the connector
    curated.publish_result(df, "q1", str(tmp_path / "cur"), index_format="parquet",
                           index_options={"path": index})
    assert spark.read.parquet(index).count() == spark.read.json(str(tmp_path / "cur" / "q1")).count()


def test_conform_movies_dedupe_on_title(spark):
    movies = prep.conform_movies(fx.raw_movies(spark, SF), fx.mapper(spark, SF), fx.imdb(spark, SF),
                                 dedupe_on_title=True)
    assert movies.count() == fx.raw_movies(spark, SF).count()
    row = movies.filter(F.col("movie_id") == "30").first()
    assert row.tmdb_id == 100030  # the smaller of its two mapper ids


def test_rejected_values_go_to_the_quarantine(spark, tmp_path):
    text = "id,title,genre,director,writer,originalLanguage,releaseDateTheaters,boxOffice,audienceScore,tomatoMeter,rating," \
           "ratingContents,distributor,soundMix\n"
    rows = ["1,A,,,,,2020-01-01,$1.5M,50,7,,,,", "2,B,,,,,soon,$1M,n/a,,,,,", "3,C,,,,,, ,12.0, ,,,,"]
    (tmp_path / "movies").mkdir()
    (tmp_path / "movies" / "m.csv").write_text(text + "\n".join(rows) + "\n")
    for name, header in (("mapper", "title,movie_id\nA,7\n"), ("movies_imdb", "id,name\ntt0000009,A\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text(header)
    prep.run_conform_movies(spark, str(tmp_path), str(tmp_path / "zone"), quarantine=str(tmp_path / "quarantine"))
    got = {(r.column, r.value, "\"id\":\"2\"" in r.row) for r in spark.read.parquet(str(tmp_path / "quarantine")).collect()}
    assert got == {("releaseDateTheaters", "soon", True), ("audienceScore", "n/a", True)}
    zone = {r.movie_id: r for r in zones.read_table(spark, str(tmp_path / "zone")).collect()}
    assert zone["2"].audienceScore is None and zone["3"].audienceScore == 12 and "__rejects" not in zone["1"].asDict()
    (tmp_path / "movies" / "m.csv").write_text(text + rows[0] + "\n")  # nothing wrong: the quarantine is replaced by an empty one
    prep.run_conform_movies(spark, str(tmp_path), str(tmp_path / "zone"), quarantine=str(tmp_path / "quarantine"))
    assert spark.read.parquet(str(tmp_path / "quarantine")).count() == 0


def test_sketches_merge_over_years(spark, tmp_path):
    """20,000 films a genre over three years: within 2 %; a year that is written again replaces itself."""
    from cinelake.plans import sketches
    movies = spark.range(20_000).selectExpr("id as movie_id", "if(id % 2 = 0, 'Drama, Noir', 'Drama') as genre")
    reviews = spark.range(60_000).selectExpr("id % 20000 as movie_id", "cast(2000 + id % 3 as int) as creationDate",
                                             "if(id % 10 = 0, 'POSITIVE', 'NEGATIVE') as scoreSentiment")
    path = str(tmp_path / "sketches")
    sketches.write_rotten_sketches(movies, reviews, path)
    sketches.write_rotten_sketches(movies, reviews.where("creationDate = 2001"), path)
    got = {r.genre: r.total_rotten_movies for r in sketches.rotten_genres(spark.read.parquet(path)).collect()}
    films = reviews.where("scoreSentiment = 'NEGATIVE'").select("movie_id").distinct()
    want = {"Drama": films.count(), "Noir": films.where("movie_id % 2 = 0").count()}
    assert got.keys() == want.keys() and all(abs(got[g] / want[g] - 1) < 0.02 for g in want)
    plan = sketches.rotten_genres(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
