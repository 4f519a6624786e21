"""Runs in the words of documents: stretches that repeat with a period, and their collapse.

A run is a stretch of words with smallest period q, at least ``max(6, 4 q)`` long, that no
neighbouring word extends. With ``same(i) = word i equals word i + q``, it is a maximal stretch
of places where ``same`` holds, at least 3 q long.

* Periods are solved octave by octave, q from s = 2**k to 2 s - 1. A document is cut into tiles
  for each octave; neighbours overlap by 3 s places, so wherever a run crosses, both tiles hold
  enough of it to find it, and one that fits into the overlap is whole in a tile.
* Inside a tile each place divisible by s is a boundary. A run holds three boundaries in a row,
  so the periods that agree there are the candidates. The Z-function of the words behind a
  boundary, and that of the words before it read backwards, tell how far a period holds in both
  directions, as far as the tile goes.
* The fragments of all tiles are shuffled by (document, period) and stitched where they touch.

Short documents are one tile for all octaves and solved where they are read. Long ones are
dealt out tile by tile, so one document spreads over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskspark.llm.arrow import parts, to_batch
from riskspark.llm.rolling import Prefix
from riskspark.llm.tokens import Words

LEAST, TIMES = 6, 4
#: Places that a tile owns at least; an octave's tile owns eight times its shortest period.
TILE = 1 << 16
#: Characters from which a document's tiles are dealt out over the cluster.
LONG_CHARS = 8 << 20
#: Numbers looked at by one step of the candidate search.
STEP = 1 << 20
FRAGMENT = "doc bigint, mark bigint, period int, lo int, hi int"
TILES = "doc bigint, mark bigint, octaves int, first int, at int, size int, total int, symbols binary"
NULL_ID = -(1 << 63)


@lru_cache(maxsize=8)
def _least_factors(bits: int) -> np.ndarray:
    """The smallest prime factor of each number below 2**bits."""
    least = np.arange(1 << bits)
    for p in range(2, int(2 ** (bits / 2)) + 1):
        if least[p] == p:
            own = least[p * p::p]
            own[own == np.arange(p * p, 1 << bits, p)] = p
    return least


def _candidates(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, s: int) -> Iterator[tuple]:
    """Tile, boundary and period of the octave from ``s`` that agree at three boundaries in a row."""
    count = np.maximum(0, (ends - starts - s - 1) // s + 1)  # boundaries with room for a period
    count[count < 3] = 0
    tile = np.repeat(np.arange(len(starts)), count)
    turn = np.arange(len(tile)) - np.repeat(np.cumsum(count) - count, count)
    place = starts[tile] + turn * s
    periods = np.arange(s, 2 * s)
    step = max(1, STEP // s)
    for at in range(0, len(place), step):
        here = place[at:at + step + 2]  # two more, for the boundaries that follow
        wide = here[:, None] + periods
        same = (x[wide] == x[here][:, None]) & (wide < ends[tile[at:at + step + 2], None])
        three = same[:-2] & same[1:-1] & same[2:]
        three &= (tile[at:at + step + 2][2:] == tile[at:at + step + 2][:-2])[:, None]
        rows, columns = np.nonzero(three)
        yield tile[at + rows], place[at + rows], periods[columns]


def _powerless(prefix: Prefix, place: np.ndarray, period: np.ndarray, bits: int) -> np.ndarray:
    """Whether the word block of one period is not itself a repeated shorter block."""
    rest, fine, least = period.copy(), np.ones(len(place), bool), _least_factors(bits)
    while (todo := np.flatnonzero((rest > 1) & fine)).size:
        prime = least[rest[todo]]
        shorter = period[todo] // prime
        fine[todo] &= ~prefix.repeats(place[todo], period[todo] - shorter, shorter)
        rest[todo] //= prime
    return fine


def _z_values(prefix: Prefix, place: np.ndarray, period: np.ndarray, room: np.ndarray,
              back: bool) -> np.ndarray:
    """How many places from a boundary on (or before it) the period holds, up to ``room``.

    These are values of the Z-function of the words behind the boundary (or of those before it,
    reversed), found by doubling steps over prefix hashes.
    """
    held = np.zeros(len(place), np.int64)
    for bit in reversed(range(int(room.max(initial=0)).bit_length())):
        size = 1 << bit
        todo = np.flatnonzero(held + size <= room)
        begin = place[todo] - held[todo] - size if back else place[todo] + held[todo]
        fits = prefix.repeats(begin, np.full(len(todo), size), period[todo])
        held[todo[fits]] += size
    return held


def solve(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, cut_left: np.ndarray,
          cut_right: np.ndarray, octaves: range) -> tuple[np.ndarray, ...]:
    """Fragments of the tiles [start, end) of ``x``: tile, period, and the places from lo to hi.

    Whole stretches too short for a run are left out; those cut by a tile's end are kept.
    """
    prefix = Prefix(x)
    x = np.r_[x, np.full(2 << max(octaves, default=0), -1, x.dtype)]
    found: list[tuple] = []
    for octave in octaves:
        s = 1 << octave
        for tile, place, period in _candidates(x, starts, ends, s):
            # The first such boundary of a run agrees up to two boundaries on.
            sure = prefix.repeats(place, np.full(len(place), 2 * s + 1), period) \
                if len(place) else np.zeros(0, bool)
            tile, place, period = tile[sure], place[sure], period[sure]
            if not len(place):
                continue
            fine = _powerless(prefix, place, period, octave + 1)
            tile, place, period = tile[fine], place[fine], period[fine]
            # Boundaries that follow another of their run's would find the same.
            order = np.lexsort((place, period))
            tile, place, period = tile[order], place[order], period[order]
            follows = np.r_[False, (np.diff(place) == s) & (np.diff(period) == 0)
                            & (np.diff(tile) == 0)] if len(place) else np.zeros(0, bool)
            tile, place, period = tile[~follows], place[~follows], period[~follows]
            lo = place - _z_values(prefix, place, period, place - starts[tile], True)
            hi = place + _z_values(prefix, place, period, ends[tile] - period - place, False)
            lo, hi = _checked(x, place, period, lo, hi)
            whole = ~((cut_left[tile] & (lo == starts[tile]))
                      | (cut_right[tile] & (hi == ends[tile] - period)))
            keep = ~whole | (hi - lo + period >= np.maximum(LEAST, TIMES * period))
            found.append(tuple(a[keep] for a in (tile, period, lo, hi)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _checked(x: np.ndarray, place: np.ndarray, period: np.ndarray, lo: np.ndarray,
             hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends compared word by word, should hashes of unlike words ever agree."""
    lo, hi = lo.copy(), hi.copy()
    for i, (b, q) in enumerate(zip(place.tolist(), period.tolist(), strict=True)):
        differs = np.flatnonzero(x[lo[i]:hi[i]] != x[lo[i] + q:hi[i] + q]) + lo[i]
        if len(differs):
            lo[i] = max(differs[differs < b] + 1, default=lo[i])
            hi[i] = min(differs[differs >= b], default=hi[i])
    return lo, hi


def tiles_of(size: int, tile: int = TILE) -> Iterator[tuple[range, int, int]]:
    """Octaves, first place and end of each tile of a document of ``size`` words."""
    last = max(0, (size // TIMES).bit_length() - 1)  # the octave of the longest period
    low = min(last, max(0, (tile // 8).bit_length() - 1))  # octaves below share their tiles
    for octaves in [range(low + 1), *(range(k, k + 1) for k in range(low + 1, last + 1))]:
        s = 1 << octaves[-1]
        own = max(tile, 8 * s)
        for at in range(0, max(1, size - 3 * s), own):
            yield octaves, at, min(size, at + own + 5 * s)


def _numbers(text: str | None) -> np.ndarray:
    words = (text or "").encode().split()
    return np.fromiter(map(Words().__getitem__, words), np.int32, len(words))


def _solve_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document of a part is one tile."""
    for batch in parts(batches, 8192, 4 << 20):
        numbers = Words()
        words = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
        sizes = np.array([len(w) for w in words], np.int64)
        x = np.concatenate([np.fromiter(map(numbers.__getitem__, w), np.int32, len(w))
                            for w in words])
        ends = np.cumsum(sizes)
        fits = np.flatnonzero(sizes >= LEAST)
        if not len(fits):
            continue
        longest = int(sizes.max()) // TIMES
        no = np.zeros(len(fits), bool)
        starts = (ends - sizes)[fits]
        tile, period, lo, hi = solve(x, starts, ends[fits], no, no, range(longest.bit_length()))
        if len(tile):
            row = fits[tile]
            yield _fragments(batch.column("doc").to_numpy()[row], batch.column("mark").to_numpy()[row],
                             period, lo - starts[tile], hi - starts[tile])


def _fragments(doc, mark, period, lo, hi) -> pa.RecordBatch:
    return pa.record_batch({
        "doc": pa.array(doc, pa.int64()), "mark": pa.array(mark, pa.int64()),
        "period": pa.array(period, pa.int32()), "lo": pa.array(lo, pa.int32()),
        "hi": pa.array(hi, pa.int32())})


def _cut(tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            doc, mark = batch.column("doc")[0].as_py(), batch.column("mark")[0].as_py()
            x = _numbers(batch.column("text")[0].as_py()).astype("<i4")
            for octaves, at, end in tiles_of(len(x), tile):
                yield pa.record_batch({
                    "doc": pa.array([doc], pa.int64()), "mark": pa.array([mark], pa.int64()),
                    "octaves": pa.array([len(octaves)], pa.int32()),
                    "first": pa.array([octaves[0]], pa.int32()), "at": pa.array([at], pa.int32()),
                    "size": pa.array([end - at], pa.int32()), "total": pa.array([len(x)], pa.int32()),
                    "symbols": pa.array([x[at:end].tobytes()], pa.binary())})

    return run


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            x = np.frombuffer(row["symbols"], "<i4")
            one = np.ones(1, bool)
            _, period, lo, hi = solve(
                x, np.zeros(1, np.int64), np.array([len(x)]), one & (row["at"] > 0),
                one & (row["at"] + len(x) < row["total"]),
                range(row["first"], row["first"] + row["octaves"]))
            if len(period):
                yield _fragments(np.full(len(period), row["doc"]), np.full(len(period), row["mark"]),
                                 period, lo + row["at"], hi + row["at"])


def _marked(docs: DataFrame, doc_id: str) -> DataFrame:
    """Id, hash of the text (rows alike in both are one document) and the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NULL_ID)).alias("doc"),
                       F.xxhash64(text).alias("mark"), text.alias("text"))


def _stitched(fragments: DataFrame) -> DataFrame:
    """Fragments of one document and period that touch or overlap, made one; then the runs.

    What holds with a period holds with its multiples; the smallest period of equal stretches
    is theirs.
    """
    line = Window.partitionBy("doc", "mark", "period").orderBy("lo", "hi")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    islands = (fragments.distinct()
               .withColumn("_new", (F.col("lo") > F.coalesce(F.max("hi").over(before), F.lit(-1)))
                           .cast("int"))
               .withColumn("_island", F.sum("_new").over(line)))
    joined = (islands.groupBy("doc", "mark", "period", "_island")
              .agg(F.min("lo").alias("start"), (F.max("hi") + F.col("period")).alias("end")))
    return (joined.where(F.col("end") - F.col("start") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
            .groupBy("doc", "mark", "start", "end").agg(F.min("period").alias("period")))


def _runs(marked: DataFrame, long_chars: int, tile: int) -> DataFrame:
    long_ = F.char_length("text") >= long_chars
    short = marked.where(~long_).mapInArrow(_solve_short, FRAGMENT)
    dealt = (marked.where(long_).mapInArrow(_cut(tile), TILES)
             .repartition("doc", "mark", "first", "at").mapInArrow(_solve_tiles, FRAGMENT))
    return _stitched(short.unionByName(dealt))


def collapse_runs(docs: DataFrame, doc_id: str = "doc_id", long_chars: int = LONG_CHARS,
                  tile: int = TILE) -> DataFrame:
    """Find all runs of every whole text, and drop words of runs behind their first period.

    A word goes if any run holds it after that run's first q words. Returns the id, ``runs``
    (array of start, length, period, by start, then period) and ``text`` (words that stay, joined
    by one space): one row for each row of ``docs``. A null or empty text has no words and no
    runs. Rows alike in id and text are solved once each and give equal rows. An empty table
    gives no rows. Only the id, a whole number, and ``text`` are read.
    """
    marked = _marked(docs, doc_id)
    runs = (_runs(marked, long_chars, tile).groupBy("doc", "mark")
            .agg(F.sort_array(F.collect_list(F.struct(
                F.col("start").cast("bigint").alias("start"), F.col("period").cast("bigint").alias("period"),
                (F.col("end") - F.col("start")).cast("bigint").alias("length")))).alias("runs")))
    kind = StructField(doc_id, docs.schema[doc_id].dataType)
    schema = StructType([kind, runs.schema["runs"], StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            kept, found = [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(),
                                 strict=True):
                words = text.encode().split()
                turns = np.zeros(len(words) + 1, np.int64)
                for r in own or []:
                    turns[r["start"] + r["period"]] += 1
                    turns[r["start"] + r["length"]] -= 1
                if own:
                    words = [words[i] for i in np.flatnonzero(np.cumsum(turns[:-1]) == 0)]
                kept.append(b" ".join(words))
                found.append(own or [])
            yield to_batch({doc_id: batch.column(doc_id), "runs": found,
                            "text": pa.array(kept, pa.binary()).cast(pa.string())}, schema)

    ids = F.when(F.col("doc") != NULL_ID, F.col("doc")).cast(kind.dataType)
    return (marked.join(runs, ["doc", "mark"], "left")
            .select(ids.alias(doc_id), "runs", "text").mapInArrow(run, schema))


def run_digests(collapsed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts and digests of ``collapse_runs``, and the run with the greatest length / period.

    Ties go to the smallest start, then the smallest period. Without runs its columns are null.
    """
    longs = [StructField(c, LongType()) for c in ("n_runs", "start", "length", "period", "exponent_milli")]
    schema = StructType([collapsed.schema[doc_id], *longs, StructField("runs_sha256", StringType()),
                         StructField("collapsed_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for own, text in zip(batch.column("runs").to_pylist(), batch.column("text").to_pylist(),
                                 strict=True):
                best = None
                for r in own:  # by start, then period: only a greater quotient replaces
                    if best is None or r["length"] * best["period"] > best["length"] * r["period"]:
                        best = r
                lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in own)
                rows.append((len(own), *((best["start"], best["length"], best["period"],
                                          1000 * best["length"] // best["period"]) if best else (None,) * 4),
                             hashlib.sha256(lines.encode()).hexdigest(),
                             hashlib.sha256(text.encode()).hexdigest()))
            if rows:
                yield to_batch({doc_id: batch.column(doc_id)} | dict(zip(
                    schema.names[1:], map(list, zip(*rows, strict=True)), strict=True)), schema)

    return collapsed.mapInArrow(run, schema)
