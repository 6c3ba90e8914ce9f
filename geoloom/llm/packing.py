"""Packing token sequences: best-fit decreasing over a segment tree of open windows.

Each task tokenizes its rows and packs them in bounded runs, so packing needs no shuffle and no
table of lengths. Overlong documents are first cut into full windows; what is left of each document
goes, longest first, into the open window with the least room that still takes it.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table

#: Pieces that one run of best-fit decreasing holds, and their tokens: 16 MB.
RUN_PIECES, RUN_TOKENS = 1 << 14, 1 << 22
#: Chunks of text whose tokens a worker remembers, and the longest of them.
MEMO_CHUNKS, MEMO_CHARS = 900_000, 48


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree of which capacities occur."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.occurs = bytearray(2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self.stacks[room].append(window)
        node = room + self.leaves
        while node and not self.occurs[node]:
            self.occurs[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, window) with the least room of at least need."""
        node = need + self.leaves
        if not self.occurs[node]:
            while node > 1 and (node & 1 or not self.occurs[node ^ 1]):  # up to the first subtree on the right
                node >>= 1
            if node <= 1:
                return None
            node ^= 1
            while node < self.leaves:
                node = 2 * node if self.occurs[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.stacks[room].pop()
        if not self.stacks[room]:
            self.occurs[node] = 0
            node >>= 1
            while node and not (self.occurs[2 * node] or self.occurs[2 * node + 1]):
                self.occurs[node] = 0
                node >>= 1
        return room, window


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each length, and how many windows were opened. Ties keep their order."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened, windows = 0, OpenWindows(capacity)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        room, at = windows.take(need) or (capacity, -1)
        if at < 0:
            at, opened = opened, opened + 1
        window[i], offset[i] = at, capacity - room
        if room > need:
            windows.add(room - need, at)
    return window, offset, opened


_SEPARATORS = re.compile("[\x1c-\x1f]")
_BLANK = re.compile(r"[ \t\n\r\x0b\x0c]+")
_MARK = "\x01"
#: What may stand behind a word; an apostrophe may belong to it.
_PUNCTUATION = ".,;:!?*%&$#"


class ChunkEncoder:
    """Token ids of texts by way of their white-space chunks, each distinct one encoded once.

    It gives what the tokenizer gives for whole texts as long as no token spans white space, which
    holds for tokenizers that drop it; the constructor checks that on a probe. Where the vocabulary
    marks the ends of words, words of letters need no separators when they are encoded together, and
    a word with punctuation behind it is put together from both.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks keep the cores busy
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = self._whole(_MARK)
        if len(mark) != 1 or self._whole("One, twoé\n3x — four") != [i for c in ("One,", "twoé", "3x", "—", "four") for i in self._whole(c)]:
            raise ValueError("this tokenizer does not drop white space")
        self.mark = mark[0]
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.worded = bool(self.ends.any())
        self.parted = self.worded and all(self._whole(w + p) == self._whole(w) + self._whole(p) for w in ("ab", "É", "Übung") for p in (*_PUNCTUATION, "!!", "?."))
        self.plain_case = self._whole("ABC Abc") == self._whole("abc abc")
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.known = 0
        self.starts, self.counts, self.single = array("q"), array("q"), bytearray()
        self.ids, self.used = np.zeros(1 << 20, np.int32), 0

    def _learn(self, chunks: list[str]) -> None:
        behind = {c: w for c in chunks if self.parted and (w := c.rstrip(_PUNCTUATION)) != c and w.isalpha()}
        parts = dict.fromkeys(x for c, w in behind.items() for x in (w, c[len(w) :]) if x not in self.at)
        plain = dict.fromkeys(c for c in chunks if c not in behind) | parts
        letters = [c for c in plain if c.isalpha()] if self.worded else []
        odd = self._learn_words(letters)
        self._learn_marked([*(c for c in plain if not (self.worded and c.isalpha())), *odd])
        # a word of more than one run of tokens holds other things than letters once normalised
        apart = [c for c, w in behind.items() if not self.single[self.at[w]]]
        for c in apart:
            del behind[c]
        self._learn_marked(apart)
        if behind:
            pair = np.array([(self.at[w], self.at[c[len(w) :]]) for c, w in behind.items()])
            ids, counts = self._gather(pair.ravel())
            self._store(list(behind), ids, counts.reshape(-1, 2).sum(axis=1))

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known chunks, one after the other, and how many each has."""
        starts, counts = np.frombuffer(self.starts, np.int64)[at], np.frombuffer(self.counts, np.int64)[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(starts - (ends - counts), counts) + np.arange(total)], counts

    def _learn_words(self, words: list[str]) -> list[str]:
        """Learn words of letters; returns those of lines in which words and word ends don't agree."""
        odd = []
        lines = [words[i : i + 256] for i in range(0, len(words), 256)]
        for line, x in zip(lines, self.tokenizer.encode_batch_fast([" ".join(n) for n in lines], add_special_tokens=False), strict=True):
            ids = np.array(x.ids, np.int32)
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) == len(line):
                self._store(line, ids, np.diff(ends, prepend=-1), single=True)
            else:
                odd += line
        return odd

    def _learn_marked(self, chunks: list[str]) -> None:
        plain, odd = [c for c in chunks if _MARK not in c], [c for c in chunks if _MARK in c]
        # a mark before each chunk, so that chunks can be told apart in the ids of a whole line
        lines = [f"{_MARK} " + f" {_MARK} ".join(plain[i : i + 256]) for i in range(0, len(plain), 256)]
        ids = [np.array(x.ids, np.int32) for x in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.concatenate([np.zeros(0, np.int32), *ids])
        marks = np.flatnonzero(flat == self.mark)
        self._store(plain, flat[flat != self.mark], np.diff(np.append(marks, len(flat))) - 1)
        for c in odd:
            own = np.array(self._whole(c), np.int32)
            self._store([c], own, np.array([len(own)]))

    def _store(self, chunks: list[str], ids: np.ndarray, counts: np.ndarray, *, single: bool = False) -> None:
        self.single.extend(bytes([single]) * len(chunks))
        self.at.update(zip(chunks, range(self.known, self.known + len(chunks)), strict=True))
        self.starts.frombytes((self.used + np.cumsum(counts) - counts).astype(np.int64).tobytes())
        self.counts.frombytes(counts.astype(np.int64).tobytes())
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + len(ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.known, self.used = self.known + len(chunks), self.used + len(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        if self.plain_case:  # fewer distinct chunks, the same ids
            texts = [low if t.isascii() and not any(s in (low := t.lower()) for s in self.special) else t for t in texts]
        split = [_BLANK.split(t.strip(" \t\n\r\x0b\x0c")) if _SEPARATORS.search(t) else t.split() for t in texts]
        flat = [c for chunks in split for c in chunks]
        new = [c for c in dict.fromkeys(flat) if c not in self.at]
        if self.known + len(new) > MEMO_CHUNKS:
            self._forget()
            new = list(dict.fromkeys(flat))
        if new:
            self._learn(new)
        at = np.fromiter(map(self.at.__getitem__, flat), np.int64, len(flat))
        ids, counts = self._gather(at)
        upto = np.concatenate([[0], np.cumsum(counts)])
        bounds = np.cumsum([0, *map(len, split)])
        for c in new:
            if len(c) > MEMO_CHARS:  # long chunks hardly recur; their ids go at the next _forget
                del self.at[c]
        return ids, np.diff(upto[bounds])


@lru_cache(2)
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


Finish = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def pack_tokens(
    df: DataFrame, *, tokenizer: str, capacity: int = 4096, end_id: int = 2, key: str = "doc_id", text: str = "text", finish: tuple[Finish, str] | None = None
) -> DataFrame:
    """Tokenize every text and pack it into sequences of at most capacity tokens.

    Returns a row per piece: key, start (the document's ids before it, long), length (long), ids
    (array of int), doc_tokens (ids of the document with end_id, long), sequence_id (long, unique
    but not dense), offset (long, gapless from 0 within a sequence).

    A null or empty text is its end_id alone. Whole texts are cut, none is dropped; a document with
    n ids has n // capacity full windows and one piece for the rest, if any. Rows that repeat are
    packed each. A null key stays null. Other columns are left out. An empty table gives no row.
    Each task packs its own rows in runs of RUN_PIECES pieces; a run leaves at most a few windows
    open, so small partitions pad more. finish, with its schema, is a function over the result's
    Arrow batches that runs in the same task, before Spark gets them.
    """
    key_field = T.StructField(key, df.schema[key].dataType)
    schema = T.StructType([key_field, *(T.StructField(n, T.LongType()) for n in ("start", "length")), T.StructField("ids", T.ArrayType(T.IntegerType())), *(T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset"))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, opened = _encoder(tokenizer), TaskContext.get().partitionId() << 40
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        pieces = tokens = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal opened
            keys = pa.concat_arrays([h[0] for h in held])
            counts, ids = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            n = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), n)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * capacity
            length = np.minimum(counts[doc] - start, capacity)
            window, offset, used = best_fit_decreasing(length, capacity)
            at = np.concatenate([[0], np.cumsum(length)])
            for i in range(0, len(doc), 4096):
                part = slice(i, i + 4096)
                lists = pa.ListArray.from_arrays(pa.array((at[i : i + len(doc[part]) + 1] - at[i]).astype(np.int32)), pa.array(ids[at[i] : at[min(i + 4096, len(doc))]]))
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(doc[part])), *map(pa.array, (start[part], length[part])), lists, *map(pa.array, (counts[doc[part]], window[part] + opened, offset[part]))], names=schema.names)
            opened += used
            held.clear()

        for batch in batches:
            texts = batch["__pk_text"].fill_null("").to_pylist()
            for i in _cuts(texts):
                ids, counts = encoder.encode(texts[i])
                ended = np.insert(ids, np.cumsum(counts), end_id)
                held.append((batch["__pk_key"].slice(i.start, i.stop - i.start), counts + 1, ended.astype(np.int32)))
                pieces, tokens = pieces + len(counts) + len(ended) // capacity, tokens + len(ended)
                if pieces >= RUN_PIECES or tokens >= RUN_TOKENS:
                    yield from close()
                    pieces = tokens = 0
        if held:
            yield from close()

    rows = df.select(F.col(key).alias("__pk_key"), F.col(text).alias("__pk_text"))
    if finish is None:
        return rows.mapInArrow(pack, schema)
    then, finished = finish
    return rows.mapInArrow(lambda batches: then(pack(batches)), finished)


def _cuts(texts: list[str], chars: int = 1 << 21) -> Iterator[slice]:
    """Runs of texts of about that many characters."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def id_checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace ids by ids_crc32: unsigned CRC-32 of the ids as little-endian 32-bit words."""
    for batch in batches:
        lists = batch["ids"]
        flat, at = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
        crcs = pa.array([zlib.crc32(flat[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.int64())
        yield batch.set_column(batch.schema.get_field_index("ids"), "ids_crc32", crcs)


def op9_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    finish = (id_checksums, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return pack_tokens(docs, tokenizer=tokenizer, finish=finish)
