"""Encoding whole texts with a tokenizer file of the tokenizers library, inside tasks."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words, and characters in them, that a Python worker keeps; beyond, its memory starts anew.
MEMORY_WORDS = 400_000
MEMORY_CHARS = 32 * MEMORY_WORDS
#: Words encoded by one call.
CALL_WORDS = 5_000
#: Rows and bytes of text that are encoded together, so that a repeated word costs once.
ENCODE_ROWS, ENCODE_BYTES = 8192, 16 << 20

# Characters that Python or Unicode take for white space; those below 0x80 come first.
SPACES = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680,
                           *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


class Words(dict):
    """Numbers words 0, 1, 2, ... as they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number

    def after(self, known: int) -> list[str]:
        """The words numbered ``known`` and up, in order."""
        return list(islice(reversed(self), len(self) - known))[::-1]


#: How byte-level tokenizers of this kind cut a text into pieces, as published with them.
PIECES = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters that no version of Unicode in use moves between letters, numbers and the rest, as a
#: class of a regular expression: ASCII, Latin, Greek, Cyrillic, punctuation, kana, CJK, Hangul.
SETTLED = ("\x00-\x7F\u00A1-\u024F\u0384-\u03FF\u0400-\u0513\u2010-\u2027\u2030-\u205E\u3041-\u3096"
           "\u3099-\u30FF\u4E00-\u9FA5\uAC00-\uD7A3")


def _byte_characters() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _gather(ids: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given rows of a ragged array, one after the other, and the size of each."""
    sizes = (bounds[1:] - bounds[:-1])[rows]
    ends = np.cumsum(sizes)
    places = np.repeat(bounds[:-1][rows] - (ends - sizes), sizes)
    places += np.arange(len(places))
    return ids[places], sizes


class Encoder:
    """``encode_ragged`` gives the ids of whole texts as the tokenizers library does.

    Byte-level tokenizers without a normalizer start a new piece wherever white space follows
    another character, so a text may be cut before each space that follows no white space, and
    every distinct word of a part needs encoding only once. Texts with other white-space runs,
    and tokenizers of another kind, go to the library whole.

    Distinct words of ``SETTLED`` characters without special strings are merged by tiktoken from
    the ranks of the same file, many words in one call; that is the same rule and gives the same
    ids (only where ranks follow the order of the merges; else the library does all). Other words,
    the first word of a text and what follows its last word go to the library itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocab = self.library.get_vocab()
        self.size = max(vocab.values()) + 1
        self.type = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        pre = spec["pre_tokenizer"] or {}
        added = spec["added_tokens"]
        self.cuts = (spec["normalizer"] is None and pre.get("type") == "ByteLevel"
                     and pre.get("use_regex", True) and not pre["add_prefix_space"]
                     and spec["post_processor"] is None
                     and not any(a["lstrip"] or a["rstrip"] or a["single_word"]
                                 or any(c in a["content"] for c in SPACES) for a in added))
        self.special_ids = {a["content"]: a["id"] for a in added}
        self.special = list(self.special_ids)
        own = {a["content"]: len(a["content"].encode()) for a in added}
        self.bytes_of = np.zeros(self.size, np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = own.get(token, len(token))  # one character stands for one byte
        self.ranked = self._ranked(spec["model"]) if self.cuts else None

    def _ranked(self, model: dict):
        """tiktoken's merging by rank, if the ids of this vocabulary are its ranks."""
        import tiktoken

        vocab, byte = model["vocab"], _byte_characters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [vocab[a + b] for a, b in merges]
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        if (made != sorted(set(made)) or len(ranks) != len(made) + 256
                or model.get("ignore_merges") or model.get("dropout")):
            return None
        # With no special string to look for, it would look at every place of a text for the empty one.
        return tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks,
                                 special_tokens=self.special_ids)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_words(self, words: pa.Array, encode: Callable[[str], np.ndarray]
                  ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, each with a space before it, and how many each word has."""
        spaced = pc.binary_join_element_wise(pa.scalar(" ", words.type), words, pa.scalar("", words.type))
        ends = np.cumsum(pc.binary_length(spaced).to_numpy(zero_copy_only=False).astype(np.int64))
        every = pc.binary_join(pa.ListArray.from_arrays(
            pa.array([0, len(spaced)], pa.int32()), spaced.cast(pa.string())), "")[0].as_buffer() \
            if len(spaced) else b""
        found, sizes, begun = [np.zeros(0, self.type)], [np.zeros(0, np.int64)], 0
        for at in range(0, len(words), CALL_WORDS):
            upto = ends[min(at + CALL_WORDS, len(words)) - 1]
            ids = encode(bytes(every[begun:upto]).decode())
            reached = np.cumsum(self.bytes_of[ids]) + begun
            last = np.searchsorted(reached, ends[at:at + CALL_WORDS])
            if last[-1] >= len(ids) or (reached[last] != ends[at:at + CALL_WORDS]).any():
                raise ValueError("the tokenizer's pieces do not end where the words do")
            found.append(ids.astype(self.type))
            sizes.append(np.diff(last + 1, prepend=0))
            begun = upto
        return np.concatenate(found), np.concatenate(sizes)

    def _table(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words as a ragged array: ids and bounds, in the words' order."""
        plain = pc.or_(pc.string_is_ascii(words), pc.invert(pc.match_substring_regex(words, f"[^{SETTLED}]"))) \
            if self.ranked else pa.array(np.zeros(len(words), bool))
        for mark in self.special:
            plain = pc.and_not(plain, pc.match_substring(words, mark))
        plain = plain.to_numpy(zero_copy_only=False).astype(bool)
        fast = self._of_words(words.filter(pa.array(plain)), lambda text: self.ranked.encode_to_numpy(
            text, disallowed_special=()))
        slow = self._of_words(words.filter(pa.array(~plain)), lambda text: np.array(
            self._whole([text])[0], np.int64))
        sizes = np.concatenate([fast[1], slow[1]])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        row = np.empty(len(words), np.int64)
        row[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(words))
        ids, sizes = _gather(np.concatenate([fast[0], slow[0]]), bounds, row)
        return ids, np.concatenate([[0], np.cumsum(sizes)])

    def encode_ragged(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after the other, and where each begins and ends.

        A null is the empty text, which has no ids.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        count = len(texts)
        if not count:
            return np.zeros(0, self.type), np.zeros(1, np.int64)
        body = pc.utf8_rtrim(texts, characters=SPACES)
        whole = np.ones(count, bool)
        if self.cuts:
            whole = pc.or_(pc.equal(body, ""), pc.match_substring_regex(body, f"[{SPACES}] ")) \
                .to_numpy(zero_copy_only=False).astype(bool)
        split = pc.split_pattern(pc.if_else(pa.array(whole), pa.scalar("", pa.large_string()), body), " ")
        starts = split.offsets.to_numpy().astype(np.int64)
        flat = split.flatten()
        head = np.zeros(len(flat), bool)
        head[starts[:-1]] = True
        coded = flat.filter(pa.array(~head)).dictionary_encode()
        ids, bounds = self._table(coded.dictionary)
        # What stands first in a text, and its last white space, by the library: distinct ones once.
        first = pc.if_else(pa.array(whole), texts, flat.take(pa.array(starts[:-1]))).dictionary_encode()
        ended = np.flatnonzero(~whole & (pc.binary_length(texts).to_numpy(zero_copy_only=False)
                                         > pc.binary_length(body).to_numpy(zero_copy_only=False)))
        tails = [t[len(b):] for t, b in zip(texts.take(pa.array(ended)).to_pylist(),
                                            body.take(pa.array(ended)).to_pylist(), strict=True)]
        more = self._whole(first.dictionary.to_pylist() + tails)
        sizes = np.array([len(m) for m in more], np.int64)
        ids = np.concatenate([ids, np.fromiter(chain.from_iterable(more), self.type, int(sizes.sum()))])
        known = len(bounds) - 1
        bounds = np.concatenate([bounds, bounds[-1] + np.cumsum(sizes)])
        rows = np.empty(len(flat), np.int64)
        rows[~head] = coded.indices.to_numpy(zero_copy_only=False)
        rows[head] = known + first.indices.to_numpy(zero_copy_only=False)
        rows = np.insert(rows, starts[1:][ended], known + len(first.dictionary) + np.arange(len(ended)))
        pieces = np.diff(starts)
        pieces[ended] += 1
        ids, sizes = _gather(ids, bounds, rows)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(pieces)])]
        return ids, ends

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian bytes."""
        ids, ends = self.encode_ragged(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]


@lru_cache(maxsize=1)
def worker_memory(make: Callable, *arguments):
    """What a Python worker keeps between tasks: one such object, so a new stage frees the last."""
    return make(*arguments)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file."""
    return worker_memory(Encoder, path)


def public_path(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)
