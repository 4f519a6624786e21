"""Substring dedup: difference-cover anchors find repeated passages across documents.

A window is ``window`` consecutive words. Stretches of ``window - period + 1`` words are hashed
only at places whose number modulo ``period`` lies in a difference cover: whatever the places of
two equal windows are, some shift below ``period`` brings both into the cover, so the two share
an anchor at the same place inside them. Each anchor is hashed once more with the words around
it that a window with this anchor can reach (its context).

* Anchors with equal contexts repeat each other in every window they stand in: all but those in
  the smallest document are repeats, up to the context's ends.
* Where one anchor has several contexts, the first document of each extends it: the windows
  through the anchor are hashed, and equal windows are repeats in all but the smallest document.

Documents with larger ids need not be compared among each other: a window that stands in any
smaller document stands in the smallest one, which is the first of its context.

Tasks keep one row for each (anchor, context) of a part of the texts and settle its other
documents themselves, so a passage that a third of all documents share is shuffled once a part.
Shuffled rows are sorted and read as a stream, so no group is held in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskspark.llm.arrow import parts, to_batch
from riskspark.llm.rolling import Prefix, WordHashes
from riskspark.llm.tokens import worker_memory
from riskspark.session import work_path

WINDOW = 50
#: A perfect difference set: every number modulo 31 is a difference of two of these.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Rows and bytes of text whose anchors a task looks at together.
PART_ROWS, PART_BYTES = 8192, 4 << 20
#: Stands for a null id, which is smaller than all others.
NULL_ID = -(1 << 63)
ANCHOR, SETTLED = 0, 1
ROWS = "kind tinyint, k1 bigint, k2 bigint, doc bigint, mark bigint, at int, more binary"
SPANS = "doc bigint, mark bigint, lo int, hi int, sure boolean"
SPAN = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("lo", pa.int32()),
                  ("hi", pa.int32()), ("sure", pa.bool_())])


def _marked(docs: DataFrame, doc_id: str) -> DataFrame:
    """Id, hash of the text (rows alike in both are one document) and the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NULL_ID)).alias("doc"),
                       F.xxhash64(text).alias("mark"), text.alias("text"))


def _words(batch: pa.RecordBatch) -> list[list[bytes]]:
    """Words of the last column's texts; bytes.split cuts at ASCII white space only."""
    return [(x or "").encode().split() for x in batch.column(batch.num_columns - 1).to_pylist()]


class Part:
    """The words of some documents, one after the other, and hashes of all their stretches."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        words = _words(batch)
        self.doc, self.mark = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        hashes = worker_memory(WordHashes)
        self.hashes = Prefix(np.concatenate([hashes.of(w, len(w)) for w in words])
                             if words else np.zeros(0, np.uint64), 4)

    def anchors(self, window: int, period: int, cover: tuple) -> tuple:
        """Row and place (in the document) of each anchor that stands in a window."""
        fits = np.flatnonzero(self.sizes >= window)
        last = self.sizes[fits] - (window - period + 1)
        rounds = last // period + 1
        row = np.repeat(fits, rounds * len(cover))
        turn = np.arange(len(row)) - np.repeat(np.cumsum(rounds * len(cover)) - rounds * len(cover),
                                               rounds * len(cover))
        place = turn // len(cover) * period + np.array(cover)[turn % len(cover)]
        keep = place <= np.repeat(last, rounds * len(cover))
        return row[keep], place[keep]


def _first_of(keys: tuple, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys and document; for each place in it, the place where its keys begin."""
    order = np.lexsort((doc, *reversed(keys)))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([np.diff(k[order]) != 0 for k in keys])
    return order, np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))


def _merged(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple:
    """Overlapping or touching spans of a row made one; sorted by row and place."""
    order = np.lexsort((lo, row))
    row, lo, hi = row[order], lo[order], hi[order]
    if not len(row):
        return row, lo, hi
    wide = row.astype(np.int64) << 33  # rows apart, so that one running maximum serves all
    reach = np.maximum.accumulate(wide + hi)
    new = np.r_[True, wide[1:] + lo[1:] > reach[:-1]]
    at = np.flatnonzero(new)
    last = np.r_[at[1:], len(row)] - 1
    return row[at], lo[at], reach[last] - wide[at]


def _settled(part: Part, row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> dict | None:
    """One row for each document with its spans that are known to be repeats."""
    row, lo, hi = _merged(row, lo, hi)
    if not len(row):
        return None
    at = np.flatnonzero(np.r_[True, np.diff(row) != 0])
    spans = np.stack([lo, hi], 1).astype("<i4")
    more = [spans[a:b].tobytes() for a, b in zip(at, [*at[1:], len(row)], strict=True)]
    owner = row[at]
    return {"kind": np.full(len(at), SETTLED, np.int8), "k1": part.mark[owner] ^ part.doc[owner],
            "k2": np.zeros(len(at), np.int64), "doc": part.doc[owner], "mark": part.mark[owner],
            "at": np.zeros(len(at), np.int32), "more": more}


def _keyed(part: Part, k1: np.ndarray, k2: np.ndarray, row: np.ndarray, place: np.ndarray,
           lo: np.ndarray, hi: np.ndarray) -> Iterator[dict]:
    """Rows to shuffle: the smallest document of each key; the others are settled here."""
    doc = part.doc[row]
    order, first = _first_of((k1, k2), doc)
    later = doc[order] > doc[order][first]
    known = _settled(part, row[order][later], lo[order][later], hi[order][later])
    if known:
        yield known
    order = order[~later]
    if not len(order):
        return
    # Equal rows of one document become one row with its further places.
    again, first = _first_of((k1[order], k2[order], part.mark[row[order]]), place[order])
    order = order[again]
    head = first == np.arange(len(order))
    ends = np.r_[np.flatnonzero(head)[1:], len(order)]
    heads = np.flatnonzero(head)
    places = place[order].astype("<i4")
    more: list = [None] * len(heads)
    for i in np.flatnonzero(ends - heads > 1):
        more[i] = places[heads[i] + 1:ends[i]].tobytes()
    own = order[heads]
    yield {"kind": np.full(len(own), ANCHOR, np.int8), "k1": k1[own], "k2": k2[own],
           "doc": doc[own], "mark": part.mark[row[own]], "at": places[heads].astype(np.int32),
           "more": pa.array(more, pa.binary())}


def _batch(made: dict) -> pa.RecordBatch:
    kinds = {"kind": pa.int8(), "k1": pa.int64(), "k2": pa.int64(), "doc": pa.int64(),
             "mark": pa.int64(), "at": pa.int32(), "more": pa.binary()}
    return pa.record_batch({c: x if isinstance(x := made[c], pa.Array) else pa.array(x, t)
                            for c, t in kinds.items()})


def _hash_anchors(window: int, period: int, cover: tuple):
    length, reach = window - period + 1, period - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, PART_ROWS, PART_BYTES):
            part = Part(batch)
            row, place = part.anchors(window, period, cover)
            start = part.starts[row] + place
            left = np.minimum(place, reach)
            right = np.minimum(part.sizes[row] - place - length, reach)
            k1 = part.hashes.pair(0, start, start + length)
            k2 = part.hashes.pair(2, start - left, start + length + right)
            k2 ^= (left * (reach + 1) + right) * 0x1E3779B97F4A7C15  # where the context ends
            for made in _keyed(part, k1, k2, row, place, place - left, place + length + right):
                yield _batch(made)

    return run


def _spans(doc, mark, lo, hi, sure: bool) -> pa.RecordBatch:
    return pa.record_batch([pa.array(doc, pa.int64()), pa.array(mark, pa.int64()),
                            pa.array(lo, pa.int32()), pa.array(hi, pa.int32()),
                            pa.array(np.full(len(doc), sure))], schema=SPAN)


def _places(batch: pa.RecordBatch, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The batch rows and places of the given rows, further places included."""
    at, more = batch.column("at").to_numpy(), batch.column("more")
    owner, place = [rows], [at[rows]]
    for i in rows[more.is_valid().to_numpy(zero_copy_only=False)[rows]]:
        own = np.frombuffer(more[int(i)].as_py(), "<i4")
        owner.append(np.full(len(own), i))
        place.append(own)
    return np.concatenate(owner), np.concatenate(place).astype(np.int64)


def _resolve(before: int, after: int, contexts: bool):
    """Reads rows sorted by kind, k1, k2 and doc as a stream and yields spans.

    Rows of a later document than the first of their keys are repeats. With ``contexts``, the
    first documents of a k1 that has several k2 are open spans. A span runs from ``before``
    words ahead of a row's place to ``after`` words behind it.
    """
    def spans(batch: pa.RecordBatch, rows: np.ndarray, sure: bool) -> Iterator[pa.RecordBatch]:
        if len(rows):
            owner, place = _places(batch, rows)
            yield _spans(batch.column("doc").to_numpy()[owner], batch.column("mark").to_numpy()[owner],
                         np.maximum(place - before, 0), place + after, sure)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the keys at the end of the batch before: k1, k2, first doc, several k2
        waiting: list[tuple[pa.RecordBatch, np.ndarray]] = []  # firsts of that k1's only k2
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            known = np.flatnonzero(kind == SETTLED)
            if len(known):
                doc, mark = batch.column("doc").to_numpy(), batch.column("mark").to_numpy()
                cut = [np.frombuffer(batch.column("more")[int(i)].as_py(), "<i4").reshape(-1, 2)
                       for i in known]
                owner = np.repeat(known, [len(c) for c in cut])
                both = np.concatenate(cut)
                yield _spans(doc[owner], mark[owner], both[:, 0], both[:, 1], True)
            batch = batch.filter(pa.array(kind == ANCHOR))
            if not batch.num_rows:
                continue
            k1, k2, doc = (batch.column(c).to_numpy() for c in ("k1", "k2", "doc"))
            here = np.arange(len(k1))
            new1 = np.r_[last is None or k1[0] != last[0], k1[1:] != k1[:-1]]
            new2 = new1 | np.r_[last is None or k2[0] != last[1], k2[1:] != k2[:-1]]
            at2 = np.maximum.accumulate(np.where(new2, here, -1))
            smallest = np.where(at2 >= 0, doc[at2], last[2] if last else 0)
            yield from spans(batch, np.flatnonzero(doc > smallest), True)
            if contexts:
                group = np.cumsum(new1)  # 0: goes on from the batch before
                others = np.bincount(group, new2 & ~new1, group[-1] + 1) > 0
                if not new1[0] and others[0]:
                    for firsts, rows in waiting:
                        yield from spans(firsts, rows, False)
                    waiting = []
                others[0] |= bool(last and last[3])
                first = doc == smallest
                yield from spans(batch, np.flatnonzero(first & others[group]), False)
                if new1.any():
                    waiting = []
                several = bool(others[group[-1]])
                held = np.flatnonzero(first & (group == group[-1]))
                if not several and len(held):
                    waiting.append((batch.take(pa.array(held)), np.arange(len(held))))
            last = (k1[-1], k2[-1], smallest[-1], contexts and several)

    return run


def _through_keys(rows: DataFrame, before: int, after: int, contexts: bool) -> DataFrame:
    """Deal rows out by k1 and resolve each part of them, sorted, as a stream."""
    return (rows.repartition("k1").sortWithinPartitions("kind", "k1", "k2", "doc")
            .mapInArrow(_resolve(before, after, contexts), SPANS))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(SPANS).parquet(path)


def _by_document(spans: DataFrame) -> DataFrame:
    """One row for each document with the set of its spans; copies of a row add nothing."""
    return spans.groupBy("doc", "mark").agg(F.collect_set(F.struct("lo", "hi", "sure")).alias("spans"))


def _covered(spans: list, size: int, sure: bool) -> np.ndarray:
    """Which of the words lie in a span of the given kind."""
    turns = np.zeros(size + 1, np.int64)
    own = np.array([(s["lo"], min(s["hi"], size)) for s in spans if s["sure"] == sure], np.int64)
    if len(own):
        np.add.at(turns, own[:, 0], 1)
        np.add.at(turns, own[:, 1], -1)
    return np.cumsum(turns[:-1]) > 0


def _hash_windows(window: int):
    """Rows for the windows inside open spans that are not known to be repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, PART_ROWS, PART_BYTES):
            part = Part(batch.select(["doc", "mark", "text"]))
            row, place = [], []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                size = int(part.sizes[i])
                if size < window:
                    continue
                # A window lies inside a span if it starts before the span's end less its size.
                starts = [{**s, "hi": min(s["hi"], size) - window + 1} for s in spans]
                starts = [s for s in starts if s["hi"] > s["lo"]]
                open_ = _covered(starts, size, False) & ~_covered(starts, size, True)
                place.append(np.flatnonzero(open_))
                row.append(np.full(len(place[-1]), i))
            if not row:
                continue
            row, place = np.concatenate(row), np.concatenate(place)
            start = part.starts[row] + place
            for made in _keyed(part, part.hashes.pair(0, start, start + window),
                               part.hashes.pair(2, start, start + window), row, place, place,
                               place + window):
                yield _batch(made)

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, period: int = PERIOD,
                   cover: tuple = COVER, doc_id: str = "doc_id") -> DataFrame:
    """Spans of words that windows cover which also start in a smaller document.

    Returns ``doc`` (a null id as the smallest whole number), ``mark`` (hash of the text),
    ``lo`` and ``hi``, which may lie beyond the text's end.
    """
    if any({(x - y) % period for x in cover for y in cover} ^ set(range(period))):
        raise ValueError("not a difference cover")
    if window < period:
        raise ValueError("a window must hold a whole period")
    marked = _marked(docs, doc_id)
    length = window - period + 1
    found = _written(_through_keys(marked.mapInArrow(_hash_anchors(window, period, cover), ROWS),
                                   period - 1, length + period - 1, True), "anchors")
    # Documents with open spans look at their windows one by one.
    open_ = _by_document(found).where(F.exists("spans", lambda s: ~s["sure"]))
    windows = (marked.join(open_, ["doc", "mark"]).select("doc", "mark", "spans", "text")
               .mapInArrow(_hash_windows(window), ROWS))
    extended = _written(_through_keys(windows, 0, window, False), "windows")
    return found.where("sure").unionByName(extended)


def drop_repeats(docs: DataFrame, window: int = WINDOW, period: int = PERIOD,
                 cover: tuple = COVER, doc_id: str = "doc_id") -> DataFrame:
    """Remove words covered by a window whose words also start in a document of smaller id.

    Windows are judged on the input. Returns the id, n_words and n_removed (long) and ``kept``
    (the words that stay, joined by one space): one row for each row of ``docs``. A null or empty
    text has no words; texts shorter than a window keep all. Rows of one id do not count as
    smaller than each other, so repeats within an id stay. A null id is smaller than any other.
    An empty table gives no rows. Only the id, a whole number, and ``text`` are read.
    """
    spans = _by_document(repeated_spans(docs, window, period, cover, doc_id))
    kind = StructField(doc_id, docs.schema[doc_id].dataType)
    schema = StructType([kind, StructField("n_words", LongType()),
                         StructField("n_removed", LongType()), StructField("kept", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            sizes, removed, kept = [], [], []
            for words, own in zip(_words(batch), batch.column("spans").to_pylist(), strict=True):
                gone = np.flatnonzero(_covered(own or [], len(words), True))
                drop = set(gone.tolist())
                sizes.append(len(words))
                removed.append(len(drop))
                kept.append(b" ".join(w for i, w in enumerate(words) if i not in drop)
                            if drop else b" ".join(words))
            yield to_batch({doc_id: batch.column(doc_id), "n_words": sizes, "n_removed": removed,
                            "kept": pa.array(kept, pa.binary()).cast(pa.string())}, schema)

    marked = _marked(docs, doc_id)
    ids = F.when(F.col("doc") != NULL_ID, F.col("doc")).cast(kind.dataType)
    return (marked.join(spans, ["doc", "mark"], "left")
            .select(ids.alias(doc_id), "spans", "text").mapInArrow(run, schema))
