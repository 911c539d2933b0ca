"""Hot films found in the stream itself (J8, ST13).

Each micro-batch counts its most frequent films on the way, in a bounded sketch
(``approx_top_k`` as an observed metric, so no pass of its own). The counts are added to
counters that are kept across batches and restarts: older batches fade by
``FADE``, and only the largest counters are kept. A film with ``share`` of the faded total is hot until
it falls below half of that. Adaptive execution does not split keys inside a
micro-batch, so the stream-static join salts hot films (``windows.HotFilms``); as a
running plan cannot change, the query is stopped and started anew on its
checkpoint when the set of hot films does, which its state allows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cinelake.streaming.documents import Versions
from cinelake.streaming.windows import HotFilms

METRIC = "films_seen"
FADE = 0.5


class HotFilmWatch:
    """Counters of the most frequent films. With a ``path`` they are committed there
    batch by batch, and a new watch goes on from the last commit."""

    def __init__(self, spark: SparkSession, path: str | None = None, share: float = 0.01, salts: int = 16,
                 known: Iterable[int] = ()):
        self.share, self.salts, self.known = share, salts, frozenset(known)
        self.slots = int(4 / share)
        self.versions = Versions(spark, path) if path else None
        kept = self.versions.get() if self.versions else {}
        self.total: float = kept.get("total", 0.0)
        self.counts: dict[int, float] = {int(k): v for k, v in kept.get("counts", {}).items()}
        self.ids: frozenset[int] = frozenset(kept.get("hot", []))
        self.seen = self.versions.last() if self.versions else -1

    def watched(self, events: DataFrame) -> DataFrame:
        top = F.expr(f"approx_top_k(imdbId, {self.slots}, {max(10_000, 10 * self.slots)})")
        return events.observe(METRIC, F.count("imdbId").alias("n"), top.alias("top"))

    def take(self, query: StreamingQuery) -> None:
        """Adds what the query's finished batches have observed."""
        for progress in query.recentProgress:
            seen = progress.observedMetrics.get(METRIC)
            if progress.batchId > self.seen and seen is not None and seen["n"]:
                self.add(progress.batchId, seen["n"], {r["item"]: r["count"] for r in seen["top"] if r["item"] is not None})

    def add(self, batch_id: int, rows: int, top: dict[int, int]) -> None:
        self.seen, self.total = batch_id, self.total * FADE + rows
        counts = {film: self.counts.get(film, 0.0) * FADE + top.get(film, 0) for film in self.counts.keys() | top.keys()}
        self.counts = dict(sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:self.slots])
        least = self.share * self.total
        self.ids = frozenset(f for f, n in self.counts.items() if n >= (least / 2 if f in self.ids else least))
        if self.versions:
            self.versions.commit(batch_id, {"total": self.total, "counts": self.counts, "hot": sorted(self.ids)})

    def hot(self) -> HotFilms | None:
        ids = self.ids | self.known
        return HotFilms(tuple(sorted(ids)), self.salts) if ids else None


def run_watched(start: Callable[[HotFilms | None], list[StreamingQuery]], watch: HotFilmWatch,
                poll_seconds: float = 0.5) -> list[StreamingQuery]:
    """Runs the queries that ``start`` begins, with new salts whenever the hot films
    change, until they end by themselves. The first failure stops all and is raised."""
    while True:
        used = watch.hot()
        queries = start(used)
        try:
            while any(q.isActive for q in queries) and watch.hot() == used:
                for query in queries:
                    query.awaitTermination(poll_seconds)
                    watch.take(query)
        finally:
            running = [q for q in queries if q.isActive]
            for query in running:
                query.stop()
        for query in queries:
            query.awaitTermination()
            watch.take(query)
        if not running:
            return queries
