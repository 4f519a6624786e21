"""Packing documents into sequences of a fixed number of tokens: best two fit.

A bin is filled greedily with the longest piece that still fits. Then its shortest piece gives
way to two unpacked pieces that fill the widened gap more tightly, if there are such two.
Decisions depend on lengths alone, and lengths are few, so the whole packing is planned on the
number of pieces of each length: equal bins are planned once, with a repeat count. Pieces then
find their places by their number among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StructField, StructType)

from riskspark.llm.arrow import free_name, parts, to_batch, with_fields
from riskspark.llm.slots import gapless_slots
from riskspark.llm.tokens import ENCODE_BYTES, ENCODE_ROWS, encoder
from riskspark.session import shared_dir

CAPACITY = 1024
END_ID = 2


def _widest_two(counts: np.ndarray, room: int, more_than: int) -> tuple[int, int] | None:
    """The two lengths in stock with the greatest sum up to ``room``, if above ``more_than``."""
    stock = np.flatnonzero(counts)
    stock = stock[stock < room]
    if not len(stock):
        return None
    # For each length the longest partner: itself only if two are in stock.
    at = np.searchsorted(stock, room - stock, side="right") - 1
    itself = (at >= 0) & (stock[at] == stock) & (counts[stock] < 2)
    at = at - itself
    sums = np.where(at >= 0, stock + stock[np.maximum(at, 0)], 0)
    best = int(sums.argmax())
    if sums[best] <= more_than:
        return None
    return int(stock[best]), int(stock[at[best]])


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Best two fit over ``counts[length]``: bins as (lengths, how often).

    Each entry uses a length up to where the next bin would look different, so there are a few
    thousand entries at most, however many pieces there are.
    """
    counts = counts.astype(np.int64).copy()
    plan: list[tuple[list[int], int]] = []
    while len(stock := np.flatnonzero(counts)):
        left, room, bin_ = counts.copy(), capacity, []
        while len(stock := np.flatnonzero(left[:room + 1])):
            bin_.append(int(stock[-1]))
            left[stock[-1]] -= 1
            room -= bin_[-1]
        shortest = bin_[-1]
        two = _widest_two(left, room + shortest, shortest) if room else None
        if two:
            bin_ = [*bin_[:-1], *two]
        used = np.bincount(bin_, minlength=len(counts))
        # The next bin looks the same while every length touched is in stock as often as now.
        needs = used.copy()
        if two:
            needs[shortest] += 1
        times = 1 + int(((counts - needs)[used > 0] // used[used > 0]).min())
        counts -= used * times
        plan.append((bin_, times))
    return plan


def _places(plan: list[tuple[list[int], int]], capacity: int) -> dict[int, tuple]:
    """For each length: first piece number, first sequence, pieces a bin, offsets of each run."""
    runs: dict[int, list] = {}
    taken = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for bin_, times in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in bin_:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, own in offsets.items():
            runs.setdefault(length, []).append((int(taken[length]), sequence, own))
            taken[length] += len(own) * times
        sequence += times
    out = {}
    for length, items in runs.items():
        width = max(len(o) for _, _, o in items)
        table = np.zeros((len(items), width), np.int64)
        for i, (_, _, own) in enumerate(items):
            table[i, :len(own)] = own
        out[length] = (np.array([x[0] for x in items]), np.array([x[1] for x in items]),
                       np.array([len(x[2]) for x in items]), table)
    return out


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY,
         length: str = "length") -> DataFrame:
    """Give each piece a ``sequence_id`` and its ``offset`` there, in as few sequences as it can.

    ``pieces`` should be cheap to read twice (a checkpoint). Lengths run from 1 to ``capacity``;
    only their counts, at most ``capacity`` numbers, come to the driver. No pieces give no rows;
    equal rows get places of their own.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy(length).agg(F.count(F.lit(1)).alias("n")).collect():
        if not row[0] or not 1 <= row[0] <= capacity:
            raise ValueError(f"a piece of {row[0]} tokens does not fit {capacity}")
        counts[row[0]] = row.n
    places = _places(plan_bins(counts, capacity), capacity)
    number = free_name(pieces, "_number")
    ranked = gapless_slots(pieces, [length], F.xxhash64(*order).bitwiseAND(F.lit(0x7FFFFFFF)),
                           order, int(counts.sum()), number)
    schema = with_fields(pieces.schema, ("sequence_id", LongType()), ("offset", LongType()))
    plain = [c for c in pieces.columns if c not in ("sequence_id", "offset")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(length).to_numpy()
            numbers = batch.column(number).to_numpy()
            ids, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for one in np.unique(lengths):
                mine = np.flatnonzero(lengths == one)
                first, sequence, width, table = places[int(one)]
                run = np.searchsorted(first, numbers[mine], side="right") - 1
                turn, slot = np.divmod(numbers[mine] - first[run], width[run])
                ids[mine], offsets[mine] = sequence[run] + turn, table[run, slot]
            yield to_batch({c: batch.column(c) for c in plain}
                           | {"sequence_id": ids, "offset": offsets}, schema)

    return ranked.select(*plain, number).mapInArrow(place, schema)


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
               doc_id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Tokenise whole texts and cut those longer than ``capacity``; the first piece takes the rest.

    Returns the id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked, ``ids`` (little-
    endian unsigned 32-bit). A null or empty text is the end id alone; other columns are not read.
    """
    fields = [docs.schema[doc_id], StructField("piece", IntegerType()),
              StructField("start", LongType()), StructField("length", LongType()),
              StructField("ids_crc32", LongType())]
    schema = StructType(fields + [StructField("ids", BinaryType())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in parts(batches, ENCODE_ROWS, ENCODE_BYTES):
            owner, rows, cuts = [], [], []
            every, ends = encode.encode_ragged(batch.column(1))
            every = every.astype("<u4")
            for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                ids = np.append(every[a:b], np.uint32(end_id))
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    packed = ids[a:b].tobytes()
                    owner.append(i)
                    rows.append((piece, a, b - a, zlib.crc32(packed)))
                    if with_ids:
                        cuts.append(packed)
            made = dict(zip(("piece", "start", "length", "ids_crc32"), zip(*rows), strict=True)) \
                if rows else {}
            if made:
                yield to_batch({doc_id: batch.column(0).take(pa.array(owner)), "ids": cuts}
                               | {k: list(v) for k, v in made.items()}, schema)

    return docs.select(doc_id, "text").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                   end_id: int = END_ID, doc_id: str = "doc_id") -> DataFrame:
    """Cut and pack whole documents. One row for each piece; see ``cut_pieces`` and ``pack``."""
    shared_dir(docs.sparkSession)
    pieces = cut_pieces(docs, tokenizer, capacity, end_id, doc_id).checkpoint()
    return pack(pieces, [doc_id, "piece", "ids_crc32"], capacity)
