"""Independent SQL statement (DuckDB dialect) of every registered query.

Written from the reference's literal computation (join first, explode, then
aggregate), not from our plans, so agreement checks the pre-aggregated Spark
plans against the plain definition. Tables are the driver's parquet views;
the review-lake views are CTEs with the same definitions as
``cinelake.sources.fixtures``.
"""

from __future__ import annotations

from cinelake import params as P
from cinelake.functions.expressions import SCORE_CHOICES

# View definitions (FIXTURES.md section 3) ----------------------------------

MOVIES_TEXT = r"""
movies_text AS (
  SELECT p_partkey AS movie_id, p_name AS title,
    p_type || sep || replace(p_name, ' ', sep) AS genre,
    CASE WHEN p_partkey % 17 <> 0 THEN p_brand || sep || p_type END AS writer,
    CASE WHEN p_partkey % 19 <> 0 THEN 'Dir ' || CAST(p_partkey % 40 AS VARCHAR) || sep
         || 'Dir ' || CAST(40 + p_partkey % 7 AS VARCHAR) END AS director,
    CASE p_partkey % 3 WHEN 0 THEN 'English' WHEN 1 THEN 'French' END AS originalLanguage,
    CASE WHEN p_partkey % 13 <> 0 THEN make_date(CAST(1965 + p_partkey % 60 AS INT), 1, 1) END
      AS releaseDateTheaters,
    '$' || CAST(p_size AS VARCHAR) || '.5'
      || CASE p_partkey % 4 WHEN 0 THEN 'K' WHEN 1 THEN 'M' WHEN 2 THEN 'B' END AS boxOffice,
    CASE WHEN p_partkey % 7 <> 0 THEN p_size * 2 END AS audienceScore,
    CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey % 101 AS INT) END AS tomatoMeter,
    CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_partkey AS INT) END AS imdb_id
  FROM (SELECT *, CASE p_partkey % 3 WHEN 0 THEN ',' WHEN 1 THEN ', ' ELSE ' , ' END AS sep
        FROM part) p
)"""

MOVIES = MOVIES_TEXT + r""",
movies AS (
  SELECT * REPLACE (
    coalesce(CAST(substr(boxOffice, 2, length(boxOffice) - 2) AS DOUBLE)
      * CASE right(boxOffice, 1) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 END, 0.0)
    AS boxOffice)
  FROM movies_text
)"""

REVIEWS = r"""
reviews AS (
  SELECT l_orderkey, l_linenumber, l_partkey AS movie_id,
    CAST(year(o_orderdate) AS INT) AS creationDate,
    CASE WHEN l_linenumber <> 7 THEN l_linestatus = 'F' END AS isTopCritic,
    CASE l_returnflag WHEN 'N' THEN 'NEGATIVE' ELSE 'POSITIVE' END AS scoreSentiment
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

CERTIFIED = f"""
certified_counts AS (
  SELECT movie_id,
    count(*) FILTER (WHERE scoreSentiment = 'POSITIVE') AS positive_reviews,
    count(*) FILTER (WHERE isTopCritic) AS top_critic_reviews,
    count(*) AS total_reviews
  FROM reviews WHERE isTopCritic IS NOT NULL GROUP BY movie_id
),
certified AS (
  SELECT * FROM certified_counts
  WHERE positive_reviews / total_reviews >= {P.CERTIFIED_RATIO}
    AND top_critic_reviews >= {P.CERTIFIED_MIN_TOP_CRITICS}
    AND positive_reviews >= {P.CERTIFIED_MIN_POSITIVE}
)"""


def _split(col: str) -> str:
    return rf"string_split(regexp_replace({col}, '\s*,\s*', ',', 'g'), ',')"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


_TOP_GENRE_CTES = f"""
g AS (SELECT r.creationDate, unnest({_split('m.genre')}) AS genre
      FROM movies m JOIN reviews r ON m.movie_id = r.movie_id),
c AS (SELECT creationDate, genre, count(*) AS count FROM g GROUP BY creationDate, genre),
rk AS (SELECT *, rank() OVER (PARTITION BY creationDate ORDER BY count DESC) AS rnk FROM c)"""

_TOP_GENRE = """
SELECT creationDate, genre, count FROM rk WHERE rnk = 1
ORDER BY count DESC, creationDate, genre LIMIT 15"""

_CERTIFIED_TITLES = """
SELECT m.title, max(c.total_reviews) AS total_reviews
FROM certified c JOIN movies m ON c.movie_id = m.movie_id
GROUP BY m.title ORDER BY total_reviews DESC, m.title LIMIT 10"""

BATCH = {
    "b01_top_genre_per_year": _with(MOVIES, REVIEWS, _TOP_GENRE_CTES) + _TOP_GENRE,

    "b02_rotten_genres": _with(MOVIES, REVIEWS, f"""
j AS (SELECT m.movie_id, unnest({_split('m.genre')}) AS genre
      FROM movies m JOIN reviews r ON m.movie_id = r.movie_id WHERE r.scoreSentiment = 'NEGATIVE'),
gm AS (SELECT genre, movie_id, count(DISTINCT movie_id) AS rotten_movies FROM j GROUP BY genre, movie_id),
gg AS (SELECT genre, sum(rotten_movies) AS total_rotten_movies FROM gm GROUP BY genre
       HAVING sum(rotten_movies) / count(DISTINCT movie_id) > {P.NEGATIVE_SHARE})""") + """
SELECT genre, CAST(total_rotten_movies AS BIGINT) AS total_rotten_movies FROM gg
ORDER BY total_rotten_movies DESC, genre LIMIT 10""",

    "b02_rotten_genres_share": _with(MOVIES, REVIEWS, f"""
f AS (SELECT movie_id FROM reviews GROUP BY movie_id
      HAVING count(*) FILTER (WHERE scoreSentiment = 'NEGATIVE') / count(*) > {P.NEGATIVE_SHARE}),
j AS (SELECT m.movie_id, unnest({_split('m.genre')}) AS genre FROM movies m JOIN f ON m.movie_id = f.movie_id)""") + """
SELECT genre, count(DISTINCT movie_id) AS total_rotten_movies FROM j GROUP BY genre
ORDER BY total_rotten_movies DESC, genre LIMIT 10""",

    "b03_writer_box_office": _with(MOVIES, f"""
w AS (SELECT unnest({_split('writer')}) AS writer, boxOffice FROM movies)""") + """
SELECT writer, CAST(sum(CAST(boxOffice AS DECIMAL(20, 2))) AS DOUBLE) / 1e9 AS total_box_office_in_billions FROM w
WHERE writer IS NOT NULL GROUP BY writer
ORDER BY total_box_office_in_billions DESC, writer LIMIT 5""",

    "b04_certified_writer_genres": _with(MOVIES, REVIEWS, CERTIFIED, f"""
cw AS (SELECT c.movie_id, m.genre, unnest({_split('m.writer')}) AS writer
       FROM certified c JOIN movies m ON c.movie_id = m.movie_id),
tw AS (SELECT writer, count(*) AS num_movies FROM cw GROUP BY writer
       ORDER BY num_movies DESC, writer LIMIT 5),
cg AS (SELECT writer, unnest(string_split(genre, ', ')) AS genre FROM cw
       WHERE writer IN (SELECT writer FROM tw)),
gc AS (SELECT writer, genre, count(*) AS genre_count FROM cg GROUP BY writer, genre),
rk AS (SELECT *, row_number() OVER (PARTITION BY writer ORDER BY genre_count DESC, genre) AS genre_rank
       FROM gc)""") + """
SELECT writer, genre, genre_count, CAST(genre_rank AS INT) AS genre_rank FROM rk WHERE genre_rank <= 3""",

    "b05_directors_in_years": _with(MOVIES, REVIEWS, f"""
d AS (SELECT r.movie_id, unnest({_split('m.director')}) AS director
      FROM reviews r JOIN movies m ON r.movie_id = m.movie_id
      WHERE r.creationDate >= {P.YEARS[0]} AND r.creationDate < {P.YEARS[1]})""") + """
SELECT director, count(*) AS num_reviews FROM d GROUP BY director
ORDER BY num_reviews DESC, director LIMIT 5""",

    "b06_top_reviewed": _with(MOVIES, REVIEWS, f"""
rc AS (SELECT movie_id, count(*) AS total_reviews FROM reviews
       WHERE scoreSentiment = 'POSITIVE' GROUP BY movie_id),
pc AS (SELECT movie_id, count(*) AS positive_reviews FROM reviews
       WHERE scoreSentiment = 'POSITIVE' GROUP BY movie_id),
j AS (SELECT rc.movie_id, rc.total_reviews,
        pc.positive_reviews / rc.total_reviews * 100 AS positive_review_percentage
      FROM rc LEFT JOIN pc ON rc.movie_id = pc.movie_id
      WHERE rc.total_reviews >= {P.MIN_POSITIVE_REVIEWS}),
rk AS (SELECT *, rank() OVER (ORDER BY total_reviews DESC) AS rnk FROM j)""") + """
SELECT DISTINCT m.director, rk.positive_review_percentage, m.title, rk.total_reviews
FROM rk JOIN movies m ON rk.movie_id = m.movie_id WHERE rnk <= 5""",

    "b06_top_share": _with(MOVIES, REVIEWS, f"""
j AS (SELECT movie_id, count(*) AS total_reviews,
        count(*) FILTER (WHERE scoreSentiment = 'POSITIVE') / count(*) * 100 AS positive_review_percentage
      FROM reviews GROUP BY movie_id HAVING count(*) >= {P.MIN_POSITIVE_REVIEWS}),
rk AS (SELECT *, rank() OVER (ORDER BY positive_review_percentage DESC) AS rnk FROM j)""") + """
SELECT DISTINCT m.director, rk.positive_review_percentage, m.title, rk.total_reviews
FROM rk JOIN movies m ON rk.movie_id = m.movie_id WHERE rnk <= 5""",
}


def _genre_scores(split: str) -> str:
    return _with(MOVIES, f"""
g AS (SELECT unnest({split}) AS genre, audienceScore, tomatoMeter FROM movies),
t AS (SELECT genre, count(*) AS total_reviews FROM g GROUP BY genre),
s AS (SELECT g.genre, avg(audienceScore) AS avg_audience_score, avg(tomatoMeter) AS avg_tomato_meter
      FROM g JOIN t ON g.genre = t.genre
      WHERE t.total_reviews >= {P.MIN_GENRE_FILMS}
        AND audienceScore IS NOT NULL AND tomatoMeter IS NOT NULL
      GROUP BY g.genre)""") + """
SELECT genre, avg_audience_score, avg_tomato_meter,
  (avg_audience_score + avg_tomato_meter) / 2 AS combined_score
FROM s ORDER BY combined_score DESC, genre LIMIT 5"""


BATCH["b07_genre_scores"] = _genre_scores("string_split(genre, ',')")
BATCH["b07_genre_scores_clean"] = _genre_scores(
    rf"list_filter(list_transform({_split('genre')}, lambda x: trim(x)), lambda x: x <> '')")

# Sketches of so few films are exact.
BATCH["b02_rotten_genres_sketch"] = BATCH["b02_rotten_genres"]

BATCH["b08_certified_films"] = _with(MOVIES, REVIEWS, CERTIFIED) + """
SELECT c.movie_id, c.positive_reviews, c.top_critic_reviews, c.total_reviews, m.* EXCLUDE (movie_id)
FROM certified c JOIN movies m ON c.movie_id = m.movie_id"""

BATCH["b08_certified_titles"] = _with(MOVIES, REVIEWS, CERTIFIED) + _CERTIFIED_TITLES


def _writer_top(sentiment: str) -> str:
    return _with(MOVIES, REVIEWS, f"""
w AS (SELECT movie_id, unnest({_split('writer')}) AS writer FROM movies),
ws AS (SELECT w.writer, r.scoreSentiment, count(*) AS review_count
       FROM reviews r JOIN w ON r.movie_id = w.movie_id WHERE r.isTopCritic
       GROUP BY w.writer, r.scoreSentiment),
pv AS (SELECT writer,
         CAST(sum(review_count) FILTER (WHERE scoreSentiment = 'POSITIVE') AS BIGINT) AS POSITIVE,
         CAST(sum(review_count) FILTER (WHERE scoreSentiment = 'NEGATIVE') AS BIGINT) AS NEGATIVE
       FROM ws GROUP BY writer)""") + f"""
SELECT writer, POSITIVE, NEGATIVE FROM pv ORDER BY {sentiment} DESC NULLS LAST, writer LIMIT 3"""


BATCH["b09_writer_positive"] = _writer_top("POSITIVE")
BATCH["b09_writer_negative"] = _writer_top("NEGATIVE")

BATCH["b10_release_buckets"] = _with(MOVIES, REVIEWS, """
mb AS (SELECT movie_id, year(releaseDateTheaters) AS y FROM movies WHERE releaseDateTheaters IS NOT NULL),
bk AS (SELECT movie_id,
         CASE WHEN y BETWEEN 1970 AND 2024
              THEN CAST(y - y % 5 AS VARCHAR) || '-' || CAST(y - y % 5 + 4 AS VARCHAR)
              ELSE 'Unknown' END AS release_year_bucket FROM mb),
agg AS (SELECT release_year_bucket,
          count(*) FILTER (WHERE scoreSentiment = 'POSITIVE') AS positive_reviews,
          count(*) AS total_reviews
        FROM bk JOIN reviews r ON bk.movie_id = r.movie_id
        WHERE release_year_bucket <> 'Unknown' GROUP BY release_year_bucket)""") + """
SELECT release_year_bucket, positive_reviews, total_reviews,
  positive_reviews / total_reviews * 100 AS positive_percentage
FROM agg ORDER BY positive_percentage DESC"""


# ETL ------------------------------------------------------------------------

RAW_MOVIES = """
raw_movies AS (
  SELECT '$PG-' || CAST(movie_id % 18 AS VARCHAR) AS rating, CAST(movie_id AS VARCHAR) AS id, boxOffice,
    audienceScore, tomatoMeter, 'Title ' || CAST(movie_id AS VARCHAR) AS title,
    '[' || chr(39) || 'mild' || chr(39) || ', ' || chr(39) || 'loud' || chr(39) || ']' AS ratingContents,
    releaseDateTheaters, genre, originalLanguage, director, writer,
    'House ' || CAST(movie_id % 9 AS VARCHAR) || ', Ltd' AS distributor, 'Dolby, 5.1' AS soundMix
  FROM movies_text
)"""

RAW_REVIEWS = """
raw_reviews AS (
  SELECT CASE l_returnflag WHEN 'N' THEN 'NEGATIVE' WHEN 'R' THEN 'POSITIVE' END AS scoreSentiment,
    'He said "fine, film ' || CAST(l_partkey AS VARCHAR) || '"' AS reviewText,
    CAST(l_partkey AS VARCHAR) AS id, 'The Paper, daily' AS publicatioName,
    CAST(o_orderdate AS DATE) AS creationDate,
    CASE WHEN l_linenumber <> 7 THEN l_linestatus = 'F' END AS isTopCritic,
    'Critic ' || CAST(l_linenumber AS VARCHAR) AS criticName,
    'http://reviews.example/' || CAST(l_orderkey AS VARCHAR) AS reviewUrl,
    CAST(l_linenumber AS VARCHAR) || '/10' AS originalScore,
    CASE l_linestatus WHEN 'F' THEN 'fresh' ELSE 'rotten' END AS reviewState,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS reviewId
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

ID_LISTS = """
mapper AS (
  SELECT 'Title ' || CAST(p_partkey AS VARCHAR) AS title,
    CASE WHEN p_partkey % 3 = 0 THEN 100000 + p_partkey END AS movie_id FROM part
  UNION ALL
  SELECT 'Title ' || CAST(p_partkey AS VARCHAR), 200000 + p_partkey FROM part WHERE p_partkey % 30 = 0
),
imdb AS (
  SELECT CASE WHEN p_partkey % 4 <> 0 THEN 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') END AS id,
    'Title ' || CAST(p_partkey AS VARCHAR) AS name FROM part
)"""

CONFORMED = """
conformed AS (
  SELECT r.id AS movie_id, r.title, r.genre, r.director, r.writer, r.originalLanguage, r.releaseDateTheaters,
    coalesce(CAST(substr(r.boxOffice, 2, length(r.boxOffice) - 2) AS DOUBLE)
      * CASE right(r.boxOffice, 1) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 END, 0.0) AS boxOffice,
    r.audienceScore, r.tomatoMeter,
    mp.movie_id AS tmdb_id, TRY_CAST(substr(i.id, 3, 10) AS INT) AS imdb_id
  FROM raw_movies r LEFT JOIN mapper mp ON r.title = mp.title LEFT JOIN imdb i ON r.title = i.name
)"""

STREAM_INPUT = """
ratings AS (
  SELECT CAST(user_id AS INT) AS userId, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS movieId,
    CASE WHEN event_type <> 'error' THEN CAST(event_id % 11 AS DOUBLE) / 2 END AS rating, ts AS timestamp
  FROM events
),
links AS (
  SELECT CAST(p_partkey AS INT) AS movieId,
    CASE WHEN p_partkey % 11 <> 0 THEN CAST(100000 + p_partkey AS INT) END AS tmdbId,
    CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_partkey AS INT) END AS imdbId FROM part
),
stream_movies AS (
  SELECT CAST(p_partkey AS INT) AS movieId, p_name AS title, replace(p_name, ' ', '|') AS genres FROM part
),
flat AS (
  SELECT r.userId, r.movieId, r.rating, m.title, m.genres, l.tmdbId, l.imdbId, r.timestamp
  FROM ratings r JOIN links l ON r.movieId = l.movieId JOIN stream_movies m ON r.movieId = m.movieId
)"""

_SCORES = ", ".join(f"{v:.1f}" for v in SCORE_CHOICES)

CLEANED = f"""
cleaned AS (
  SELECT id AS movie_id, reviewId, CAST(year(creationDate) AS INT) AS creationDate, isTopCritic,
    CASE WHEN scoreSentiment IN ('POSITIVE', 'NEGATIVE') THEN scoreSentiment
         ELSE ['POSITIVE', 'NEGATIVE'][CAST('0x' || substr(md5('sentiment:' || reviewId), 1, 8) AS BIGINT) % 2 + 1]
    END AS scoreSentiment,
    CAST([{_SCORES}][CAST('0x' || substr(md5('score:' || reviewId), 1, 8) AS BIGINT) % 11 + 1] AS FLOAT)
      AS originalScore
  FROM raw_reviews
)"""

# The written zone as the batch questions see it.
ZONE = (MOVIES_TEXT, RAW_MOVIES, ID_LISTS, CONFORMED, RAW_REVIEWS, CLEANED,
        "movies AS (SELECT * FROM conformed)", "reviews AS (SELECT * FROM cleaned)")

_RATINGS = """
SELECT CAST(user_id AS INT) AS userId, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS movieId,
  CASE WHEN event_type <> 'error' THEN CAST(event_id % 11 AS DOUBLE) / 2 END AS rating, ts AS timestamp
FROM events"""

ETL = {
    "e01_land_raw_movies": _with(MOVIES_TEXT, RAW_MOVIES) + "SELECT * FROM raw_movies",
    "e01_land_raw_reviews": _with(RAW_REVIEWS) + "SELECT * FROM raw_reviews",
    "e01_land_raw_mapper": _with(ID_LISTS) + "SELECT * FROM mapper",
    "e01_land_raw_movies_imdb": _with(ID_LISTS) + "SELECT * FROM imdb",
    "e01_land_raw_links": _with(STREAM_INPUT) + "SELECT * FROM links",
    "e01_land_raw_ratings": _RATINGS,
    "e02_reviews_clean": _with(RAW_REVIEWS, CLEANED) + "SELECT * FROM cleaned",
    "e08_chain_top_genre_per_year": _with(*ZONE, _TOP_GENRE_CTES) + _TOP_GENRE,
    "e09_chain_certified_titles": _with(*ZONE, CERTIFIED) + _CERTIFIED_TITLES,
    "e10_send_time_messages": _with(STREAM_INPUT) + """
SELECT CAST(userId AS VARCHAR) || '_' || CAST(movieId AS VARCHAR) AS key, userId, movieId,
  CAST(rating AS FLOAT) AS rating, title, genres, tmdbId, imdbId, true AS stamped FROM flat""",
    "e07_reviews_zone_years": _with(RAW_REVIEWS) + f"""
SELECT CAST(year(creationDate) AS INT) AS creationDate,
  CASE WHEN scoreSentiment IN ('POSITIVE', 'NEGATIVE') THEN scoreSentiment
       ELSE ['POSITIVE', 'NEGATIVE'][CAST('0x' || substr(md5('sentiment:' || reviewId), 1, 8) AS BIGINT) % 2 + 1]
  END AS scoreSentiment,
  count(*) AS reviews
FROM raw_reviews
WHERE year(creationDate) >= {P.YEARS[0]} AND year(creationDate) < {P.YEARS[1]}
GROUP BY ALL""",
    "e03_movies_conformed": _with(MOVIES_TEXT, RAW_MOVIES, ID_LISTS, CONFORMED) + "SELECT * FROM conformed",
    "e04_id_coverage": _with(MOVIES_TEXT, RAW_MOVIES, ID_LISTS, CONFORMED) + """
SELECT count(*) FILTER (WHERE imdb_id IS NOT NULL OR tmdb_id IS NOT NULL) AS films_with_id,
  count(*) AS total_films FROM conformed""",
    "e05_stream_flat": _with(STREAM_INPUT) + "SELECT * FROM flat",
    "e06_replay_messages": _with(MOVIES, STREAM_INPUT) + """
SELECT CAST(userId AS VARCHAR) || '_' || CAST(movieId AS VARCHAR) || '_'
    || strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS key,
  userId, movieId, CAST(rating AS FLOAT) AS rating, title, genres, tmdbId, imdbId,
  date_trunc('second', timestamp) AS timestamp
FROM flat f WHERE EXISTS (SELECT 1 FROM movies m WHERE m.imdb_id IS NOT DISTINCT FROM f.imdbId)""",
}

ETL["e11_rejected_values"] = _with(MOVIES_TEXT, RAW_MOVIES) + """
SELECT id, 'audienceScore' AS "column", 'n/a' AS value FROM raw_movies WHERE CAST(id AS BIGINT) % 9 = 0
UNION ALL SELECT id, 'tomatoMeter', '9 of 10' FROM raw_movies WHERE CAST(id AS BIGINT) % 12 = 0
UNION ALL SELECT id, 'releaseDateTheaters', '2020-02-31' FROM raw_movies WHERE CAST(id AS BIGINT) % 15 = 0"""

# Streams --------------------------------------------------------------------
# Event time travels as whole seconds. Windows align to the epoch; a sliding
# window of size s and slide d starts at bucket(d) - k*d for k < s/d. Append
# output holds windows with end <= max(event time) - delay.

EVENTS = """
ev AS (
  SELECT date_trunc('second', ts) AS t,
    CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS movieId,
    CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS imdbId,
    'Film ' || regexp_extract(props, '[0-9]+', 0) AS title,
    CAST(CASE WHEN event_type <> 'error' THEN CAST(event_id % 11 AS DOUBLE) / 2 END AS FLOAT) AS rating
  FROM events
)"""


def _bucket(width: str, t: str = "ev.t") -> str:
    return f"time_bucket(INTERVAL '{width}', {t}, TIMESTAMP '1970-01-01')"


def _closed(size: str, delay: str) -> str:
    return f"ws + INTERVAL '{size}' <= (SELECT max(t) FROM ev) - INTERVAL '{delay}'"


def _window_cols(size: str) -> str:
    return f"ws AS window_start, ws + INTERVAL '{size}' AS window_end"


T01 = _with(EVENTS, f"""
s AS (SELECT movieId, title, {_bucket('30 seconds')} AS b, unnest([0, 1]) AS k FROM ev),
w AS (SELECT movieId, title, b - to_seconds(30 * k) AS ws FROM s)""") + f"""
SELECT {_window_cols('1 minute')}, movieId, title, count(*) AS count FROM w
WHERE {_closed('1 minute', '1 minute')} GROUP BY ws, movieId, title"""

STREAM = {
    "t01_film_counts": T01,
    "t02_genre_language_rating": _with(MOVIES, EVENTS, f"""
j AS (SELECT {_bucket('3 minutes')} AS ws,
        unnest(list_transform(string_split(m.genre, ','), lambda x: trim(x))) AS genre,
        CASE WHEN m.originalLanguage = 'English' THEN 'English' ELSE 'Non-English' END AS language,
        ev.rating
      FROM ev JOIN movies m ON ev.imdbId = m.imdb_id)""") + f"""
SELECT {_window_cols('3 minutes')}, genre, language, avg(rating) AS rating FROM j
WHERE rating IS NOT NULL AND {_closed('3 minutes', '3 minutes')} GROUP BY ws, genre, language""",
    "t03_director_counts": _with(MOVIES, EVENTS, f"""
j AS (SELECT {_bucket('1 minute')} AS ws, unnest(string_split(m.director, ',')) AS director_name
      FROM ev JOIN movies m ON ev.imdbId = m.imdb_id)""") + f"""
SELECT {_window_cols('1 minute')}, director_name, count(*) AS count FROM j
WHERE {_closed('1 minute', '1 minute')} GROUP BY ws, director_name""",
    "t04_writer_ratings": _with(MOVIES, EVENTS, f"""
j AS (SELECT {_bucket('2 minutes')} AS ws, unnest(string_split(m.writer, ',')) AS writer_name, ev.rating
      FROM ev JOIN movies m ON ev.imdbId = m.imdb_id)""") + f"""
SELECT {_window_cols('2 minutes')}, writer_name, count(rating) AS review_count,
  round(avg(rating), 2) AS avg_rating FROM j
WHERE {_closed('2 minutes', '2 minutes')} GROUP BY ws, writer_name""",
    "t05_rating_vs_audience": _with(MOVIES, EVENTS, f"""
s AS (SELECT ev.title, ev.rating AS imdb_rating,
        CAST(m.audienceScore AS DOUBLE) / 20.0 AS rotten_tomatoes_rating,
        {_bucket('30 seconds')} AS b, unnest([0, 1, 2, 3]) AS k
      FROM ev JOIN movies m ON ev.imdbId = m.imdb_id),
w AS (SELECT b - to_seconds(30 * k) AS ws, title, imdb_rating, rotten_tomatoes_rating FROM s
      WHERE imdb_rating IS NOT NULL AND rotten_tomatoes_rating IS NOT NULL)""") + f"""
SELECT {_window_cols('2 minutes')}, title,
  round(avg(imdb_rating), 2) AS avg_imdb_rating,
  round(avg(rotten_tomatoes_rating), 2) AS avg_rotten_tomatoes_rating
FROM w WHERE {_closed('2 minutes', '2 minutes')} GROUP BY ws, title""",
    # Update mode keeps every window; the newest window per director wins.
    "t06_latest_by_doc": _with(MOVIES, EVENTS, f"""
j AS (SELECT {_bucket('1 minute')} AS ws, unnest(string_split(m.director, ',')) AS director_name
      FROM ev JOIN movies m ON ev.imdbId = m.imdb_id),
c AS (SELECT ws, director_name, count(*) AS count FROM j GROUP BY ws, director_name),
r AS (SELECT *, row_number() OVER (PARTITION BY director_name ORDER BY ws DESC) AS rn FROM c)""") + f"""
SELECT director_name AS doc_id, {_window_cols('1 minute')}, director_name, count FROM r WHERE rn = 1""",
    # T5 upserted in update mode: every window is kept, ids are
    # "start_end_title" with the times as "yyyy-MM-dd HH:mm:ss".
    "t08_latest_by_window_title": _with(MOVIES, EVENTS, f"""
s AS (SELECT ev.title, ev.rating AS imdb_rating,
        CAST(m.audienceScore AS DOUBLE) / 20.0 AS rotten_tomatoes_rating,
        {_bucket('30 seconds')} AS b, unnest([0, 1, 2, 3]) AS k
      FROM ev JOIN movies m ON ev.imdbId = m.imdb_id),
w AS (SELECT b - to_seconds(30 * k) AS ws, title, imdb_rating, rotten_tomatoes_rating FROM s
      WHERE imdb_rating IS NOT NULL AND rotten_tomatoes_rating IS NOT NULL)""") + f"""
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') || '_' || strftime(ws + INTERVAL '2 minutes', '%Y-%m-%d %H:%M:%S')
    || '_' || title AS doc_id,
  {_window_cols('2 minutes')}, title,
  round(avg(imdb_rating), 2) AS avg_imdb_rating,
  round(avg(rotten_tomatoes_rating), 2) AS avg_rotten_tomatoes_rating
FROM w GROUP BY ws, title""",
    "t09_latest_by_genre_language": _with(MOVIES, EVENTS, f"""
j AS (SELECT {_bucket('3 minutes')} AS ws,
        unnest(list_transform(string_split(m.genre, ','), lambda x: trim(x))) AS genre,
        CASE WHEN m.originalLanguage = 'English' THEN 'English' ELSE 'Non-English' END AS language,
        ev.rating
      FROM ev JOIN movies m ON ev.imdbId = m.imdb_id),
a AS (SELECT ws, genre, language, avg(rating) AS rating FROM j WHERE rating IS NOT NULL GROUP BY ws, genre, language),
r AS (SELECT *, row_number() OVER (PARTITION BY genre, language ORDER BY ws DESC) AS rn FROM a)""") + f"""
SELECT genre || '_' || language AS doc_id, {_window_cols('3 minutes')}, genre, language, rating FROM r WHERE rn = 1""",
    "t10_latest_by_writer": _with(MOVIES, EVENTS, f"""
j AS (SELECT {_bucket('2 minutes')} AS ws, unnest(string_split(m.writer, ',')) AS writer_name, ev.rating
      FROM ev JOIN movies m ON ev.imdbId = m.imdb_id),
a AS (SELECT ws, writer_name, count(rating) AS review_count, round(avg(rating), 2) AS avg_rating
      FROM j GROUP BY ws, writer_name),
r AS (SELECT *, row_number() OVER (PARTITION BY writer_name ORDER BY ws DESC) AS rn FROM a)""") + f"""
SELECT writer_name AS doc_id, {_window_cols('2 minutes')}, writer_name, review_count, avg_rating FROM r WHERE rn = 1""",
    # Replaying the first half again after the second: every replayed row is
    # behind the watermark and dropped, so the result equals T1.
    "t07_late_rows_dropped": T01,
}


STREAM["t11_appended_batches"] = STREAM["t03_director_counts"]
# After the replay the state holds the windows that the watermark has not passed.
STREAM["t13_live_state"] = T01.replace(f"WHERE {_closed('1 minute', '1 minute')}", f"WHERE NOT ({_closed('1 minute', '1 minute')})")
STREAM["t14_dead_letters"] = """
SELECT CASE event_id % 50 WHEN 0 THEN 'undecodable' WHEN 1 THEN 'no event time' WHEN 2 THEN 'no event time' ELSE 'event' END
  AS reason, count(*) AS messages FROM events GROUP BY ALL"""
# The first rows of the one batch, as text; cells are printed without outer spaces.
STREAM["t15_live_preview"] = _with(MOVIES, EVENTS, f"""
j AS (SELECT {_bucket('1 minute')} AS ws, unnest(string_split(m.director, ',')) AS director_name
      FROM ev JOIN movies m ON ev.imdbId = m.imdb_id),
c AS (SELECT ws, director_name, count(*) AS count FROM j GROUP BY ws, director_name ORDER BY ws, director_name LIMIT 20)""") + """
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(ws + INTERVAL '1 minute', '%Y-%m-%d %H:%M:%S') AS window_end,
  trim(director_name) AS director_name, CAST(count AS VARCHAR) AS count FROM c"""
STREAM["t12_three_sinks"] = f"""
SELECT window_start, window_end, director_name, count, 'history' AS sink FROM ({STREAM["t03_director_counts"]})
UNION ALL
SELECT window_start, window_end, director_name, count, 'documents' FROM ({STREAM["t06_latest_by_doc"]})"""

CURATED = {
    "c01_curated_json": BATCH["b01_top_genre_per_year"],
    "c02_two_sinks": f"""
SELECT *, unnest(['json', 'index']) AS sink FROM ({BATCH["b09_writer_positive"]})""",
    "c03_preview": f"""
SELECT trim(title) AS title, CAST(total_reviews AS VARCHAR) AS total_reviews FROM ({BATCH["b08_certified_titles"]})""",
}


def all_sql() -> dict[str, str]:
    return {**BATCH, **ETL, **CURATED, **STREAM}
