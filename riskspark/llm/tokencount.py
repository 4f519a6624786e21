"""Token counts by rank-synchronous merging of byte pairs over ragged NumPy arrays.

The pre-tokens of a batch lie one after the other in one array of symbols. In each round every
pre-token applies its lowest-ranked pair, at all places at once; what no pair applies to any
more is counted and leaves. A batch takes as many rounds as its pre-token with the most merges.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from riskspark.llm.arrow import parts, texts, to_batch
from riskspark.llm.tokens import MEMORY_CHARS, MEMORY_WORDS, Words, worker_memory

LIMIT = 2048
#: Words whose pre-tokens are merged together.
CALL_WORDS = 20_000
NEVER = np.iinfo(np.int64).max
# str.split takes these for white space, the tokenizer's pattern does not.
SEPARATORS = re.compile("[\x1c-\x1f]")


class Merger:
    """The vocabulary and merges of a byte-pair tokenizer as arrays."""

    def __init__(self, model: dict) -> None:
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.size = max(vocab.values()) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        codes = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        codes, ranks = np.unique(codes, return_index=True)  # the first of equal pairs counts
        self.codes, self.ranks, self.made = codes, ranks.astype(np.int64), made
        points = sorted(ord(t) for t in vocab if len(t) == 1)
        self.inner = np.full(max(points) + 1, -1, np.int64)
        self.last = np.full(max(points) + 1, -1, np.int64)
        for p in points:
            self.inner[p] = vocab[chr(p)]
            self.last[p] = vocab.get(chr(p) + suffix, -1)

    def symbols(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First symbols (one for each byte) of all pre-tokens, and where each one starts."""
        lengths = np.array([len(p) for p in pretokens], np.int64)
        points = np.frombuffer("".join(pretokens).encode("utf-32-le"), "<u4")
        out = self.inner[points]
        ends = np.cumsum(lengths)
        out[ends - 1] = self.last[points[ends - 1]]
        if (out < 0).any():
            raise ValueError("a byte is missing from the vocabulary")
        return out, ends - lengths

    def counts(self, pretokens: list[str]) -> np.ndarray:
        """Symbols that are left of each (non-empty) pre-token when no merge applies."""
        result = np.zeros(len(pretokens), np.int64)
        if not pretokens:
            return result
        symbols, starts = self.symbols(pretokens)
        which = np.arange(len(pretokens))
        while len(symbols):
            ends = np.r_[starts[1:], len(symbols)]
            ranks = np.full(len(symbols), NEVER)
            pair = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.codes, pair), len(self.codes) - 1)
            known = self.codes[at] == pair
            ranks[:-1][known] = self.ranks[at[known]]
            ranks[ends - 1] = NEVER  # the last symbol has no partner in its pre-token
            best = np.minimum.reduceat(ranks, starts)
            live = best < NEVER
            result[which[~live]] = (ends - starts)[~live]
            sizes = ends - starts
            chosen = np.flatnonzero((ranks == np.repeat(best, sizes)) & (ranks < NEVER))
            # In a run of overlapping places (a a a) every other one applies, from the left.
            first = np.r_[True, np.diff(chosen) > 1] if len(chosen) else np.zeros(0, bool)
            run = np.maximum.accumulate(np.where(first, np.arange(len(chosen)), 0))
            chosen = chosen[(np.arange(len(chosen)) - run) % 2 == 0]
            symbols[chosen] = self.made[ranks[chosen]]
            keep = np.repeat(live, sizes)
            keep[chosen + 1] = False
            owner = np.repeat(np.arange(len(starts)), sizes)[keep]
            symbols, which = symbols[keep], which[live]
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) \
                else np.zeros(0, np.int64)
        return result


class Counter:
    """Tokens of whole texts for a tokenizer file whose pre-tokens hold no white space.

    Normalising and splitting are the library's own; merging and counting are done here. Since
    no pre-token reaches over white space, each distinct word is counted once and remembered.
    Special strings in a text are one token each and split it.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if (model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges")
                or model.get("continuing_subword_prefix") or model.get("dropout")):
            raise ValueError("not a plain byte-pair tokenizer")
        if any(a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"]
               for a in spec["added_tokens"]):
            raise ValueError("an added token needs more than an exact match")
        self.library = Tokenizer.from_file(path)
        self.merger = Merger(model)
        special = sorted((a["content"] for a in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.marks = {s[:2] for s in special}
        self._forget()

    def _forget(self) -> None:
        self.words, self.known, self.chars = Words(), np.zeros(0, np.int64), 0

    def _pretokens(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        return text, self.library.pre_tokenizer.pre_tokenize_str(text)

    def _learn(self, words: list[str]) -> None:
        learned = [self.known]
        for at in range(0, len(words), CALL_WORDS):
            part = words[at:at + CALL_WORDS]
            text, pretokens = self._pretokens(" ".join(part))
            spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 32)
            if len(spaces) != len(part) - 1:  # normalising made or took white space
                learned.append(np.array([self._whole(w) for w in part], np.int64))
                continue
            owner = np.searchsorted(spaces, np.array([p[1][0] for p in pretokens], np.int64))
            distinct: dict[str, int] = {}
            number = [distinct.setdefault(p[0], len(distinct)) for p in pretokens]
            counts = self.merger.counts(list(distinct))[number] if number else np.zeros(0)
            learned.append(np.bincount(owner, counts, len(part)).astype(np.int64))
            self.chars += len(text)
        self.known = np.concatenate(learned)

    def _whole(self, text: str) -> int:
        return int(self.merger.counts([p[0] for p in self._pretokens(text)[1]]).sum())

    def count(self, texts: list[str]) -> list[int]:
        if len(self.words) > MEMORY_WORDS or self.chars > MEMORY_CHARS:
            self._forget()
        numbers, found, fixed = self.words.__getitem__, [], []
        for text in texts:
            extra = 0
            if self.special and any(m in text for m in self.marks):
                text, extra = self.special.subn(" ", text)
            if SEPARATORS.search(text):
                extra, text = extra + self._whole(text), ""
            fixed.append(extra)
            found.append(list(map(numbers, text.split())))
        self._learn(self.words.after(len(self.known)))
        return [extra + int(self.known[own].sum()) if own else extra
                for own, extra in zip(found, fixed, strict=True)]


def counter(path: str) -> Counter:
    """The worker's counter for a file, with the words it has met so far."""
    return worker_memory(Counter, path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT,
                 doc_id: str = "doc_id") -> DataFrame:
    """Bytes and tokens of every whole text: the id, n_bytes, n_tokens, over_limit.

    A null text is empty and has no bytes and no tokens. One row for each row of the input, in
    any order; other columns are not read.
    """
    schema = StructType([docs.schema[doc_id], StructField("n_bytes", LongType()),
                         StructField("n_tokens", LongType()),
                         StructField("over_limit", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            own = texts(batch)
            tokens = counter(tokenizer).count(own)
            yield to_batch({doc_id: batch.column(0), "n_bytes": [len(t.encode()) for t in own],
                            "n_tokens": tokens, "over_limit": [n > limit for n in tokens]}, schema)

    return docs.select(doc_id, "text").mapInArrow(run, schema)
