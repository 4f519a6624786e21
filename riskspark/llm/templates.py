"""Benchmark decontamination by templates, so that questions with new numbers are found too.

A text becomes a row of tokens: words in lower case, and typed placeholders for numbers, names
and units. Names are told by their capitals, so windows with names are taken a second time with
the names as plain words, which finds copies in other letter case. Windows of ``WINDOW`` tokens with enough plain words are hashed and joined with the
windows of the benchmark items. Items shorter than a window are one window of their own length,
and documents are cut into windows of those lengths too; items without enough plain words in any
window are looked for by exact windows, without placeholders. Windows of one document and item on one diagonal (place in the
document less place in the item) belong together; there each slot value of the item must always
stand for the same value in the document, or else the diagonal, or the windows with that value,
do not count. A document is contaminated by an item once consistent
diagonals cover ``COVER`` of the item's windows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, StringType,
                               StructField, StructType)

from riskspark.llm.arrow import parts, rows_of, same, text_key, texts, to_batch
from riskspark.llm.tokens import Words, worker_memory
from riskspark.session import shared_dir

WINDOW = 8
#: Plain words that a window must have, so that rows of placeholders match nothing.
PLAIN_WORDS = 4
COVER = 0.5
#: Contaminated documents whose ids and digests (some 100 bytes each) go to every task.
BROADCAST_ROWS = 1 << 18
#: Bits of the table of benchmark windows that goes to every task, of one size whatever their
#: number, and bits of it that a task puts together.
TABLE_BITS, BLOCK_BITS = 26, 15
#: Words that a Python worker keeps.
MEMORY_WORDS = 250_000

PLAIN, NUMBER, UNIT, NAME, NOTHING = range(5)
MARKS = ("", "<num>", "<unit>", "<name>", "")
# Words taken for units when they follow a number.
UNITS = frozenset("""% $ € £ °c °f mm cm m km inch inches ft feet foot yd yard yards mile miles mg g kg
 gram grams kilogram kilograms ton tons tonne tonnes oz ounce ounces lb lbs pound pounds ml cl l liter
 liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week
 weeks month months year years cent cents dollar dollars euro euros percent degree degrees mph kmh km/h
 hz khz mhz ghz w kw watt watts v volt volts amp amps joule joules cal kcal byte bytes kb mb gb tb
""".split())
NUMBER_FORM = re.compile(r"[-+]?[$€£]?\d+(?:[.,:/]\d+)*(%|[^\W\d_]+)?")
EDGES = " \t\"'“”‘’«»()[]{}<>*#_|~`^=,;:.!?…-–—&"


ENDS, CLOSERS = ".!?…:", "\"'”’)]»"


class Lexicon:
    """What each distinct word of the texts is: kind, hash, spelling, and if it ends a sentence."""

    def __init__(self) -> None:
        self.words = Words()
        self.kind, self.capital, self.ends = (np.zeros(0, np.int8), np.zeros(0, bool),
                                              np.zeros(0, bool))
        self.code = np.zeros(0, np.uint64)
        self.plain: list[str] = []

    def learn(self) -> None:
        new = self.words.after(len(self.plain))
        kinds, capitals, ends, codes = [], [], [], []
        for word in new:
            core = word.strip(EDGES)
            text = core.lower() or word
            if core.isalpha():
                kind = UNIT if text in UNITS else PLAIN
            elif not core:
                kind = UNIT if any(c in UNITS for c in word) else NOTHING
            elif number := NUMBER_FORM.fullmatch(core):
                suffix = (number[1] or "").lower()
                kind = NUMBER if not suffix or suffix in UNITS else PLAIN
            else:
                kind = UNIT if text in UNITS else PLAIN
            kinds.append(kind)
            capitals.append(kind != NUMBER and text[:1] != core[:1] and len(core) > 1
                            and not core.isupper())
            ends.append(word[-1] in ENDS or word[-1] in CLOSERS
                        and word.rstrip(CLOSERS).endswith(tuple(ENDS)))
            codes.append(xxhash.xxh64_intdigest(text))
            self.plain.append(text)
        self.kind = np.concatenate([self.kind, np.array(kinds, np.int8)])
        self.capital = np.concatenate([self.capital, np.array(capitals, bool)])
        self.ends = np.concatenate([self.ends, np.array(ends, bool)])
        self.code = np.concatenate([self.code, np.array(codes, np.uint64)])


def lexicon() -> Lexicon:
    """The worker's lexicon, with the words it has met so far."""
    return worker_memory(Lexicon)


MARK_CODES = np.array([xxhash.xxh64_intdigest(m, 1) for m in MARKS], np.uint64)
POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(64)], np.uint64)


def canonical(lexicon: Lexicon, owned: list[list[list[int]]]):
    """Flat tokens of some texts, given as word numbers by line: owner, word, kind, code.

    Kind and code come twice: with names told by their capitals, and without names, so that they
    are the same in any letter case.
    """
    lines = list(chain.from_iterable(owned))
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    owner = np.repeat(np.repeat(np.arange(len(owned)), list(map(len, owned))), lengths)
    word = np.array(list(chain.from_iterable(lines)), np.int64)
    starts = np.zeros(len(word) + 1, bool)
    starts[np.cumsum(lengths) - lengths] = True
    folded, ends = lexicon.kind[word], lexicon.ends[word]
    opens = starts[:-1] | np.r_[True, ends[:-1]][:len(word)]
    named = np.where(lexicon.capital[word] & ~opens, NAME, folded)
    keep = named != NOTHING
    owner, word = owner[keep], word[keep]
    out = [owner, word]
    for kind in (named[keep], folded[keep]):
        after_number = np.r_[False, (kind[:-1] == NUMBER) & (owner[1:] == owner[:-1])][:len(kind)]
        kind[(kind == UNIT) & ~after_number] = PLAIN
        out.append((kind, np.where(kind == PLAIN, lexicon.code[word], MARK_CODES[kind])))
    return tuple(out)


def window_rows(texts: list[str], lexicon: Lexicon, window: int, plain_words: int,
                wanted: Callable[[np.ndarray], np.ndarray] | None,
                widths: list[int] | None = None, exact: bool | None = False,
                any_case: bool = False):
    """Windows as (owner, place, hash, template, slot values, windows of the owner, width, exact).

    Without ``widths`` a text shorter than a window is one window; with them a text has windows
    of each of these widths. ``any_case`` adds to windows that differ by it their like without
    names: to those with enough plain words beside the names, or with ``widths`` among all words.
    ``exact`` adds the windows with no placeholders and any words: None
    to texts that have no window without them, True to all.
    """
    numbers = lexicon.words.__getitem__
    owned = [[list(map(numbers, line.split())) for line in t.split("\n")] for t in texts]
    lexicon.learn()
    owner, word, (kind, code), (folded, folded_code) = canonical(lexicon, owned)
    sizes = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(owner)) - first[owner]
    if widths is None:
        width = np.minimum(sizes, window)
        all_starts = np.flatnonzero(place <= (sizes - width)[owner])
        all_widths = width[owner[all_starts]]
    else:
        found = [np.flatnonzero(place <= (sizes - w)[owner]) for w in widths]
        all_starts = np.concatenate([np.zeros(0, np.int64), *found])
        all_widths = np.repeat(np.array(widths, np.int64), list(map(len, found)))
    plain = np.r_[0, np.cumsum(kind == PLAIN)]
    own_plain = plain[all_starts + all_widths] - plain[all_starts]
    enough = own_plain >= np.minimum(plain_words, all_widths)
    layers = [(kind, code, enough)]
    if any_case:
        changed = np.r_[0, np.cumsum(kind != folded)]
        differs = changed[all_starts + all_widths] > changed[all_starts]
        if widths is None:
            layers.append((folded, folded_code, differs & enough))
        else:
            plain = np.r_[0, np.cumsum(folded == PLAIN)]
            layers.append((folded, folded_code, differs & (
                plain[all_starts + all_widths] - plain[all_starts] >= np.minimum(plain_words, all_widths))))
    if exact is not False:
        # Windows of plain words alone are the same with and without placeholders.
        more = ~enough | (own_plain < all_widths)
        if exact is None:
            more &= (np.bincount(owner[all_starts[enough]], minlength=len(texts)) == 0)[owner[all_starts]]
        layers.append((np.full(len(kind), PLAIN, np.int8), lexicon.code[word], more))
    # What is found without names counts for the window with them.
    total = sum(np.bincount(owner[all_starts[chosen]], minlength=len(texts))
                for kind, _, chosen in layers if kind is not folded)
    last = len(layers) - 1 if exact is not False else None
    for layer, (kind, code, chosen) in enumerate(layers):
        starts, own_width = all_starts[chosen], all_widths[chosen]
        value = np.zeros(len(starts), np.uint64)
        padded = np.r_[code, np.zeros(window, np.uint64)]
        for k in range(window):
            inside = own_width > k
            value += np.where(inside, padded[starts + k], np.uint64(0)) * POWERS[k]
        if wanted is not None:
            hit = wanted(value)
            starts, own_width, value = starts[hit], own_width[hit], value[hit]
        for at, wide, hash_ in zip(starts.tolist(), own_width.tolist(), value.tolist(), strict=True):
            span = range(at, at + wide)
            yield (int(owner[at]), int(place[at]), hash_,
                   " ".join(MARKS[kind[i]] or lexicon.plain[word[i]] for i in span),
                   [lexicon.plain[word[i]] for i in span if kind[i] != PLAIN], int(total[owner[at]]),
                   wide, layer == last)


class Wanted:
    """Which hashes may be the benchmark's: one bit for each value of their last bits.

    It lets through all of the benchmark's windows and few others, which the join then drops;
    the more windows the benchmark has, the more others.
    """

    def __init__(self, blocks: dict[int, bytes], table_bits: int = TABLE_BITS) -> None:
        self.bits = np.zeros(1 << (table_bits - 3), np.uint8)
        for block, own in blocks.items():
            self.bits[block * len(own):(block + 1) * len(own)] = np.frombuffer(own, np.uint8)

    @classmethod
    def of(cls, items: DataFrame, table_bits: int = TABLE_BITS) -> Wanted:
        """From the windows' hashes; tasks make the blocks, at most 2**table_bits bits come here."""
        place = F.col("hash").bitwiseAND(F.lit((1 << table_bits) - 1))
        block_bits = min(BLOCK_BITS, table_bits)

        def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            own = np.zeros(1 << block_bits, np.uint8)
            own[table.column("bit").to_numpy()] = 1
            return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array(
                [np.packbits(own, bitorder="little").tobytes()], pa.binary())})

        blocks = (items.select(F.shiftright(place, block_bits).cast("int").alias("block"),
                               place.bitwiseAND(F.lit((1 << block_bits) - 1)).cast("int").alias("bit"))
                  .distinct().groupBy("block").applyInArrow(pack, "block int, bits binary"))
        return cls({r.block: bytes(r.bits) for r in blocks.collect()}, table_bits)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        place = values & np.uint64(8 * len(self.bits) - 1)
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def windows(docs: DataFrame, key: str, window: int = WINDOW, plain_words: int = PLAIN_WORDS,
            wanted: Wanted | None = None, widths: list[int] | None = None,
            exact: bool | None = False, any_case: bool = False) -> DataFrame:
    """``key`` and, as ``window_rows`` gives them, the fields of every window that is wanted."""
    schema = StructType([
        docs.schema[key], StructField("place", IntegerType()), StructField("hash", LongType()),
        StructField("template", StringType()), StructField("slots", ArrayType(StringType())),
        StructField("n_windows", IntegerType()), StructField("width", IntegerType()),
        StructField("exact", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            if len(lexicon().words) > MEMORY_WORDS:
                worker_memory.cache_clear()
            rows = list(window_rows(texts(batch), lexicon(), window, plain_words, wanted, widths,
                                    exact, any_case))
            if not rows:
                continue
            owner, place, hash_, template, slots, n, wide, is_exact = zip(*rows, strict=True)
            yield to_batch({key: batch.column(0).take(pa.array(owner)), "place": list(place),
                            "hash": np.array(hash_, np.uint64).view(np.int64),
                            "template": list(template), "slots": list(slots),
                            "n_windows": list(n), "width": list(wide), "exact": list(is_exact)}, schema)

    return docs.select(key, "text").mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 plain_words: int = PLAIN_WORDS, cover: float = COVER, doc_id: str = "doc_id",
                 item_id: str = "item_id", by_window: bool = False,
                 table_bits: int = TABLE_BITS) -> DataFrame:
    """The documents that hold a benchmark item, with or without other numbers, names and units.

    One row for each document and item: the ids, ``windows`` of the item found, ``n_windows`` of
    the item, and ``verbatim``, whether all slots found bear the item's own values. Null texts,
    null ids (they cannot be named), texts and items without words match nothing; items with
    equal texts match alike; rows of one id are one document. An item's value that stands for two
    values on a diagonal drops the whole diagonal, or, ``by_window``, only the windows that hold
    the value, save those that bear the item's own values throughout.
    """
    shared_dir(docs.sparkSession)
    items = windows(benchmark.where(F.col(item_id).isNotNull()), item_id, window,
                    plain_words, exact=None, any_case=True).checkpoint()
    # At most one row for each width up to ``window``.
    shapes = items.groupBy("width").agg(F.bool_or("exact").alias("exact")).collect()
    widths, exact = sorted(r.width for r in shapes), any(r.exact for r in shapes)
    wanted = Wanted.of(items, table_bits)
    mine = items.select(F.col(item_id).alias("_item"), F.col("place").alias("_item_place"), "hash",
                        "template", F.col("slots").alias("_item_slots"),
                        F.col("n_windows").alias("_n"))
    own = (windows(docs.where(F.col(doc_id).isNotNull()), doc_id, window, plain_words, wanted,
                   widths, exact, any_case=True)
           .select(F.col(doc_id).alias("_doc"), "place", "hash", "template", "slots"))
    pairs = F.transform(F.arrays_zip(F.col("_item_slots").alias("theirs"), F.col("slots").alias("ours")),
                        lambda p: F.struct(p["theirs"].alias("theirs"), p["ours"].alias("ours")))
    # A diagonal holds each window of an item a few times at most, so these sets are short.
    diagonals = (own.join(mine, ["hash", "template"])
                 .groupBy("_doc", "_item", "_n", (F.col("place") - F.col("_item_place")).alias("_shift"))
                 .agg(F.collect_set(F.struct(F.col("_item_place").alias("place"), pairs.alias("pairs")))
                      .alias("_windows"))
                 .withColumn("_pairs", F.array_sort(F.array_distinct(
                     F.flatten(F.transform("_windows", lambda w: w["pairs"])))))
                 # In sorted distinct pairs, a value with two counterparts follows itself.
                 .withColumn("_broken", F.array_distinct(F.transform(
                     F.filter("_pairs", lambda p, i: (i > 0) & (
                         F.get("_pairs", i - 1)["theirs"] == p["theirs"])),
                     lambda p: p["theirs"]))))

    def own_values(pairs: Column) -> Column:
        return F.forall(pairs, lambda p: p["theirs"] == p["ours"])

    if by_window:
        good = F.filter("_windows", lambda w: own_values(w["pairs"]) | ~F.exists(
            w["pairs"], lambda p: F.array_contains("_broken", p["theirs"])))
        consistent = diagonals.withColumn("_windows", good)
    else:
        consistent = diagonals.where(F.size("_broken") == 0)
    plain = F.forall("_windows", lambda w: own_values(w["pairs"]))
    found = (consistent.select("_doc", "_item", "_n", plain.alias("_same"),
                               F.explode(F.transform("_windows", lambda w: w["place"])).alias("_place"))
             .groupBy("_doc", "_item", "_n")
             .agg(F.count_distinct("_place").alias("windows"), F.bool_and("_same").alias("verbatim")))
    return (found.where(F.col("windows") >= F.col("_n") * cover)
            .select(F.col("_doc").alias(doc_id), F.col("_item").alias(item_id),
                    F.col("windows").cast("int").alias("windows"),
                    F.col("_n").alias("n_windows"), "verbatim"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                      **options) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns.

    Each row is judged by its own text, whatever other rows share its id or have none. Ids and
    digests of up to ``BROADCAST_ROWS`` contaminated texts go to every task, so no text is
    shuffled; more of them are joined by a shuffle, with the same rows.
    """
    key = F.struct(F.col(doc_id).alias("id"), text_key(F.col("text")).alias("text"))
    bad = (contaminated(docs.select(key.alias("_key"), "text"), benchmark, doc_id="_key", **options)
           .select(F.col("_key.id").alias("_bad"), F.col("_key.text").alias("_bad_text")).distinct()
           .checkpoint())
    if rows_of(bad) <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    return docs.join(bad, same(docs[doc_id], bad["_bad"])
                     & (text_key(docs["text"]) == bad["_bad_text"]), "left_anti")
