"""Job entry points: what the reference runs as one script per question.

    spark-submit -m cinelake.jobs batch b01 --movies M --reviews R --curated C
    spark-submit -m cinelake.jobs clean-reviews --raw RAW/reviews --out T/reviews
    spark-submit -m cinelake.jobs conform-movies --raw RAW --out T/movies
    spark-submit -m cinelake.jobs flatten --raw RAW --out DATA/streaming/reviews
    spark-submit -m cinelake.jobs publish --flat DATA/streaming/reviews --movies T/movies
                                            --topic DIR|--kafka-servers H --kafka-topic T
    spark-submit -m cinelake.jobs divert --topic DIR --events DIR --dead-letters T --checkpoint C
    spark-submit -m cinelake.jobs stream t2 --topic DIR|--kafka-servers H --subscribe T
                                            --movies T/movies --out O [--append]

Zone tables are read with declared schemas (Parquet by default, ``--format``
for CSV zones). Batch results go to the curated zone as JSON and, with
``--index-format`` and ``--index-option k=v``, to a search index too; so do stream
results. Stream questions T2-T5 upsert their documents by id (``--append``
writes closed windows instead) and run until stopped (``--once`` drains what is available and stops).
Thresholds default to the reference's values.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cinelake.plans import batch, curated, prep
from cinelake.session import tune
from cinelake.sources import schemas, zones
from cinelake.streaming import hot, io, messages, windows

BatchFn = Callable[[DataFrame, DataFrame, argparse.Namespace], dict[str, DataFrame]]


def _one(name: str, fn) -> BatchFn:
    return lambda m, r, a: {name: fn(m, r, a)}


BATCH: dict[str, BatchFn] = {
    "b01": _one("batch_query_1", lambda m, r, a: batch.top_genre_per_year(m, r, **a.params)),
    "b02": _one("batch_query_2", lambda m, r, a: (batch.rotten_genres_share if a.corrected
                                                  else batch.rotten_genres)(m, r, **a.params)),
    "b03": _one("batch_query_3", lambda m, r, a: batch.writer_box_office(m, **a.params)),
    "b04": _one("batch_query_4", lambda m, r, a: batch.certified_writer_genres(m, r, **a.params)),
    "b05": _one("batch_query_5", lambda m, r, a: batch.directors_in_years(m, r, **a.params)),
    "b06": _one("batch_query_6", lambda m, r, a: (batch.top_share if a.corrected
                                                  else batch.top_reviewed)(m, r, **a.params)),
    "b07": _one("batch_query_7", lambda m, r, a: batch.genre_scores(
        m, **{"split_mode": "clean" if a.corrected else "comma", **a.params})),
    "b08": _one("batch_query_8", lambda m, r, a: batch.certified_films(m, r, **a.params)),
    "b10": _one("batch_query_10", lambda m, r, a: batch.release_buckets(m, r, **a.params)),
}

# What ``--show`` prints instead of the written rows.
PREVIEWS = {"b08": lambda m, r, a: batch.certified_titles(m, r, **a.params)}

# The result names (here and in BATCH) and the topic's name.
DEFAULT_TOPIC = "reviews-topic"

# B9 writes two reports (top writers by POSITIVE and by NEGATIVE) from one pivot.
B09_REPORTS = {"batch_query_9_positive": "POSITIVE", "batch_query_9_negative": "NEGATIVE"}

# Stream questions: plan, document id, group columns beside the window.
STREAM = {
    "t1": (lambda ev, mv: windows.film_counts(ev), None, ("movieId", "title")),
    "t2": (windows.genre_language_rating, "genre_language", ("genre", "language")),
    "t3": (windows.director_counts, "director_name", ("director_name",)),
    "t4": (windows.writer_ratings, "writer_name", ("writer_name",)),
    "t5": (windows.rating_vs_audience, "window_title", ("title",)),
}


def _options(pairs: list[str] | None) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs or [])


def _typed(pairs: list[str] | None) -> dict:
    """``--set name=value`` parameters: int, then float, else text."""
    out = {}
    for name, text in _options(pairs).items():
        for kind in (int, float):
            try:
                out[name] = kind(text)
                break
            except ValueError:
                continue
        else:
            out[name] = text
    return out


def _source(spark: SparkSession, spec: str, fmt: str, schema) -> DataFrame:
    """A zone path, or ``table:<name>`` for a catalog table."""
    if spec.startswith("table:"):
        return spark.table(spec.removeprefix("table:"))
    return zones.read_table(spark, spec, fmt, schema if fmt == "csv" else None)


def run_batch(spark: SparkSession, args: argparse.Namespace) -> None:
    movies = _source(spark, args.movies, args.format, schemas.MOVIES)
    reviews = _source(spark, args.reviews, args.format, schemas.REVIEWS)
    if args.question == "b09":
        # Two reports from one pivot: computed once, persisted, written twice.
        pivoted = batch.writer_sentiment(movies, reviews).persist()
        try:
            for name, sentiment in B09_REPORTS.items():
                _publish(batch.writer_top(pivoted, sentiment, **args.params), name, args)
        finally:
            pivoted.unpersist()
        return
    preview = PREVIEWS.get(args.question)
    if args.show and preview:
        zones.preview(preview(movies, reviews, args))
    for name, df in BATCH[args.question](movies, reviews, args).items():
        _publish(df, name, args, show=args.show and not preview)


def _publish(df: DataFrame, name: str, args: argparse.Namespace, show: bool | None = None) -> None:
    options = _options(args.index_option)
    if args.index_format:
        options.setdefault("path", name)
    curated.publish_result(df, name, args.curated, args.index_format, options,
                           show=args.show if show is None else show)


def _topic(args: argparse.Namespace) -> io.Topic:
    if not args.kafka_servers:
        return io.Topic(path=args.topic)
    return io.Topic(fmt="kafka", options={"kafka.bootstrap.servers": args.kafka_servers},
                    read_options={"subscribe": getattr(args, "subscribe", DEFAULT_TOPIC)},
                    write_options={"topic": getattr(args, "kafka_topic", DEFAULT_TOPIC)})


def run_publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """The producer's data work (S16, ST15): reviews of known films as keyed
    JSON messages, stamped with the send time unless ``--event-time``."""
    flat = zones.read_table(spark, args.flat, args.flat_format,
                            schemas.STREAM_FLAT if args.flat_format == "csv" else None, extra="drop")
    known = prep.known_film_reviews(flat, _source(spark, args.movies, args.format, schemas.MOVIES))
    io.publish(messages.encode(known, stamp_send_time=not args.event_time, partitions=args.partitions), _topic(args))


def run_divert(spark: SparkSession, args: argparse.Namespace) -> list:
    """Messages that hold no event, with the reason, to a table; the others on to a folder topic."""
    trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
    started = [io.divert(io.subscribe(spark, _topic(args)), args.events, args.dead_letters, args.checkpoint, trigger)]
    io.run_all(started)
    return started


def run_stream(spark: SparkSession, args: argparse.Namespace) -> list:
    topic = _topic(args)
    limit = {}
    if args.max_per_trigger:
        name = "maxOffsetsPerTrigger" if topic.fmt == "kafka" else "maxFilesPerTrigger"
        limit[name] = str(args.max_per_trigger)
    movies = _source(spark, args.movies, args.format, schemas.MOVIES)
    if args.dimension_partitions:
        movies = windows.prepare_movies(movies, args.dimension_partitions)
    build, doc_kind, keys = STREAM[args.question]
    if args.doc_ids and not doc_kind:
        raise ValueError(f"{args.question} has no document ids")
    trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
    doc_id = (lambda df: windows.with_doc_id(df, doc_kind)) if doc_kind and not args.append else None
    watch = hot.HotFilmWatch(spark, f"{args.out}/checkpoints/hot_films", args.hot_share, known=args.hot_film or ())

    def start(salted: windows.HotFilms | None) -> list:
        events = watch.watched(messages.decode(io.subscribe(spark, topic, limit)))
        result = build(events, movies) if args.question == "t1" else build(events, movies, hot=salted)
        return io.save_all(result, args.out, keys, doc_id, preview=args.show, trigger=trigger,
                           index_format=args.index_format, index_options=_options(args.index_option),
                           id_option=args.index_id_option)

    if args.question == "t1":  # joins nothing
        started = start(None)
        io.run_all(started)
        return started
    return hot.run_watched(start, watch)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cinelake.jobs")
    sub = p.add_subparsers(dest="command", required=True)

    land = sub.add_parser("land", help="copy source CSVs into the raw zone (E1)")
    land.add_argument("--source", action="append", required=True, help="name=path")
    land.add_argument("--raw", required=True)

    for name, help_text in (("clean-reviews", "E2"), ("conform-movies", "E3 + E4"), ("flatten", "E5")):
        s = sub.add_parser(name, help=help_text)
        s.add_argument("--raw", required=True)
        s.add_argument("--out", required=True)
        if name == "clean-reviews":
            s.add_argument("--extra-columns", choices=("error", "keep", "drop"), default="error",
                           help="what becomes of raw columns that are not declared")
        if name != "flatten":
            s.add_argument("--quarantine", help="table for values that their declared type cannot hold")
        if name == "conform-movies":
            s.add_argument("--extra-columns", choices=("error", "keep", "drop"), default="error",
                           help="what becomes of raw columns that are not declared")
            s.add_argument("--dedupe-on-title", action="store_true",
                           help="one external id per title (no fan-out on repeated titles)")

    b = sub.add_parser("batch", help="one batch question (B1-B10)")
    b.add_argument("question", choices=sorted([*BATCH, "b09"]))
    b.add_argument("--movies", required=True, help="zone path or table:<name>")
    b.add_argument("--reviews", required=True, help="zone path or table:<name>")
    b.add_argument("--curated", required=True)
    b.add_argument("--format", default="parquet")
    b.add_argument("--corrected", action="store_true", help="asked question instead of computed one")
    b.add_argument("--index-format")
    b.add_argument("--index-option", action="append")
    b.add_argument("--show", action="store_true")
    b.add_argument("--set", dest="params", action="append", metavar="NAME=VALUE",
                   help="plan parameter, e.g. min_positive=20 or first_year=1998 (defaults: the reference's)")

    w = sub.add_parser("publish", help="send reviews of known films to the topic (S16, ST15)")
    w.add_argument("--flat", required=True, help="the flatten job's output")
    w.add_argument("--flat-format", default="csv")
    w.add_argument("--movies", required=True)
    w.add_argument("--format", default="parquet")
    w.add_argument("--topic", help="folder of key/value parquet files")
    w.add_argument("--kafka-servers")
    w.add_argument("--kafka-topic", default=DEFAULT_TOPIC)
    w.add_argument("--event-time", action="store_true", help="send the row's own time instead of the send time")
    w.add_argument("--partitions", type=int, help="spread the rows over so many tasks first")

    d = sub.add_parser("divert", help="messages that hold no event to a table, the others to a folder topic")
    d.add_argument("--topic", help="folder of key/value parquet files")
    d.add_argument("--kafka-servers")
    d.add_argument("--subscribe", default=DEFAULT_TOPIC)
    d.add_argument("--events", required=True, help="folder topic that jobs stream can read")
    d.add_argument("--dead-letters", required=True)
    d.add_argument("--checkpoint", required=True)
    d.add_argument("--once", action="store_true")
    d.add_argument("--every", default="30 seconds")

    s = sub.add_parser("stream", help="one stream question (T1-T5)")
    s.add_argument("question", choices=sorted(STREAM))
    s.add_argument("--topic", help="folder of key/value parquet files")
    s.add_argument("--kafka-servers")
    s.add_argument("--subscribe", default=DEFAULT_TOPIC)
    s.add_argument("--movies", required=True)
    s.add_argument("--format", default="parquet")
    s.add_argument("--out", required=True, help="root for history, documents and checkpoints")
    ids = s.add_mutually_exclusive_group()
    ids.add_argument("--append", action="store_true", help="append closed windows instead of upserting by id")
    ids.add_argument("--doc-ids", action="store_true", help="upsert by id (the default where a question has ids)")
    s.add_argument("--index-format", help="connector that takes the documents instead of a folder")
    s.add_argument("--index-option", action="append")
    s.add_argument("--index-id-option", help="the connector's option that names the id column")
    s.add_argument("--hot-film", type=int, action="append",
                   help="imdb id of a film known to have very many events (others are found in the stream)")
    s.add_argument("--hot-share", type=float, default=0.01, help="share of the events that makes a film hot")
    s.add_argument("--once", action="store_true")
    s.add_argument("--every", default="30 seconds")
    s.add_argument("--show", action="store_true")
    s.add_argument("--dimension-partitions", type=int,
                   help="pre-partition a film dimension too large to broadcast")
    s.add_argument("--max-per-trigger", type=int,
                   help="bound each micro-batch (Kafka offsets or topic files)")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if args.command == "batch":
        args.params = _typed(args.params)
    spark = tune(spark or SparkSession.builder.appName(f"cinelake {args.command}").getOrCreate())
    if args.command == "land":
        sources = _options(args.source)
        zones.land({n: zones.read_table(spark, p, "csv") for n, p in sources.items()}, args.raw)
    elif args.command == "clean-reviews":
        prep.run_clean_reviews(spark, args.raw, args.out, extra=args.extra_columns, quarantine=args.quarantine)
    elif args.command == "conform-movies":
        prep.run_conform_movies(spark, args.raw, args.out, dedupe_on_title=args.dedupe_on_title,
                                extra=args.extra_columns, quarantine=args.quarantine).show()
    elif args.command == "flatten":
        prep.run_flatten_stream_input(spark, args.raw, args.out)
    elif args.command == "publish":
        run_publish(spark, args)
    elif args.command == "batch":
        run_batch(spark, args)
    elif args.command == "divert":
        run_divert(spark, args)
    elif args.command == "stream":
        run_stream(spark, args)


if __name__ == "__main__":
    main()
