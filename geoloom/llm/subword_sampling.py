"""SentencePiece encoding by Gumbel top-k without replacement, and decoding.

All segmentations of a text into pieces of a SentencePiece vocabulary form a lattice. A search in
the order of perturbed log probabilities (A* sampling with Gumbel noise) emits distinct
segmentations: the first is a sample of the distribution, each further one a sample of what is left.
No piece spans the start of a run of spaces, so a text's lattice is a chain of small lattices, one
per chunk, and equal chunks share theirs. An emitted segmentation splits the rest of its subtree
into one subtree per chunk - the same choices before it, another one there, anything behind - and
the perturbed maximum of each is a Gumbel value truncated at the emitted one.

Random numbers are hashes of the row's key, so a row gets the same samples wherever it is computed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table
from .shingles import BASE, INVERSE, mix, powers

#: Characters of text that are worked on at once.
PIECE_CHARS = 1 << 19
SPACE = "▁"
#: Stands for a U+2581 of the text itself, which becomes its UTF-8 bytes; no text holds a surrogate.
LITERAL = "\ud800"
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")


class Vocabulary:
    """Pieces of a model by hash, with log probabilities by rank: p ~ (rank + 1) ** -power.

    Models of merges carry ranks, not probabilities, so Zipf's law stands in for them; power sets how
    much frequent pieces are preferred.
    """

    def __init__(self, path: str, power: float = 1.0) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        plain = [i for i in range(size) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i))]
        shown = set(plain)
        self.bytes = np.zeros(256, np.int32)
        for i in range(size):
            if self.model.is_byte(i):
                self.bytes[int(self.model.id_to_piece(i)[3:5], 16)] = i
        log = -power * np.log(np.arange(1, len(plain) + 1) + 1)
        log -= np.logaddexp.reduce(log)
        pieces = [self.model.id_to_piece(i) for i in plain]
        self.longest = max(map(len, pieces))
        hashes = np.concatenate([Substrings(np.frombuffer(p.encode("utf-32-le"), np.uint32)).hashes(np.zeros(1, np.int64), len(p)) for p in pieces])
        order = np.argsort(hashes)
        self.hashes, self.ids, self.logs = hashes[order], np.array(plain, np.int32)[order], log[order]
        slots = self._slot(self.hashes)
        self.table = np.full(1 << 20, -1, np.int32)  # one piece of each slot
        self.table[slots] = np.arange(len(slots))
        self.crowded = np.bincount(slots, minlength=1 << 20) > 1
        self.byte_log = float(log.min())
        texts = [bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace(SPACE, " ").encode() if i in shown else b"" for i in range(size)]
        self.piece_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.piece_lengths = np.array([len(t) for t in texts])
        self.piece_starts = np.cumsum(self.piece_lengths) - self.piece_lengths

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are pieces, and the pieces' places in ids and logs."""
        slot = self._slot(hashes)
        at = self.table[slot]
        may = np.flatnonzero(at >= 0)
        at, slot, wanted = at[may], slot[may], hashes[may]
        other = np.flatnonzero((self.hashes[at] != wanted) & self.crowded[slot])
        at[other] = np.minimum(np.searchsorted(self.hashes, wanted[other]), len(self.hashes) - 1)
        hit = self.hashes[at] == wanted
        return may[hit], at[hit]


class Substrings:
    """Hashes of all substrings of one array of code points, length by length."""

    def __init__(self, codes: np.ndarray) -> None:
        values = mix(codes.astype(np.uint64) + np.uint64(0x1234567)) * powers(BASE, len(codes))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        self.shift = powers(INVERSE, len(codes) + 1)

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.shift[at] + np.uint64(length)


class Lattices:
    """Lattices of distinct chunks, as one graph: nodes are places between characters.

    Each edge has a probability given its node, in proportion to the mass of all segmentations that
    go through it; a walk from a chunk's first node is then an exact sample.
    """

    def __init__(self, chunks: list[str], vocabulary: Vocabulary) -> None:
        lengths = np.array([len(c) for c in chunks])
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        chunk = np.repeat(np.arange(len(chunks)), lengths)
        stop = np.cumsum(lengths)[chunk]
        substrings, place = Substrings(codes), np.arange(len(codes))
        froms, tos, pieces, logs = [], [], [], []
        single = np.zeros(len(codes), bool)
        inside = place
        for n in range(1, min(vocabulary.longest, int(lengths.max())) + 1):
            inside = inside[stop[inside] - inside >= n]  # substrings of that length within their chunk
            hit, found = vocabulary.find(substrings.hashes(inside, n))
            at = inside[hit]
            if n == 1:
                single[at] = True
            froms.append(at), tos.append(at + n), pieces.append(vocabulary.ids[found].astype(np.int64)), logs.append(vocabulary.logs[found])
        for found_so_far in (froms, tos, pieces, logs):
            found_so_far.reverse()  # long pieces tend to be likely: a walk then seldom looks at others
        odd = place[~single]  # a character without a piece: its UTF-8 bytes are one edge
        width = 1 + (codes[odd] >= 0x80) + (codes[odd] >= 0x800) + (codes[odd] >= 0x10000)
        froms.append(odd), tos.append(odd + 1), pieces.append(-1 - codes[odd].astype(np.int64)), logs.append(vocabulary.byte_log * width)
        order = np.argsort(np.concatenate(froms), kind="stable")
        at, to, self.piece, log = (np.concatenate(x)[order] for x in (froms, tos, pieces, logs))
        # chunks have one node more than characters
        node, self.to = at + chunk[at], to + chunk[at]
        self.base = np.cumsum(lengths + 1) - (lengths + 1)
        nodes = len(codes) + len(chunks)
        left = stop[at] - at
        mass = np.zeros(nodes)
        order = np.argsort(left.astype(np.uint16) if int(lengths.max()) < 1 << 16 else left, kind="stable")
        runs = np.append(np.flatnonzero(np.concatenate([[True], np.diff(left[order]) > 0])), len(order))
        for a, b in zip(runs, runs[1:], strict=False):  # by the distance to the chunk's end
            e = order[a:b]
            first = np.flatnonzero(np.concatenate([[True], np.diff(node[e]) > 0]))
            mass[node[e][first]] = np.logaddexp.reduceat(log[e] + mass[self.to[e]], first)
        self.log = log + mass[self.to] - mass[node]
        self.first = np.searchsorted(node, np.arange(nodes + 1))
        total = np.concatenate([[0.0], np.cumsum(np.exp(self.log))])
        self.upto = total[1:] - total[self.first[node]]
        self.upto[self.first[1:][self.first[1:] > self.first[:-1]] - 1] = 2.0  # the last edge takes what is left
        self.end = np.zeros(nodes, bool)
        self.end[self.base + lengths] = True
        self.others = self._others(node)

    def _others(self, node: np.ndarray) -> np.ndarray:
        """What the other edges of an edge's node hold: a sum of theirs, so that it is exact next to
        an edge that takes nearly all, and 0 only where there is no other."""
        share, out = np.exp(self.log), np.zeros(len(node))
        at = np.arange(len(node))
        for step in range(1, int(np.bincount(node).max(initial=0))):
            at = at[: np.searchsorted(at, len(node) - step)]
            at = at[node[at] == node[at + step]]
            out[at] += share[at + step]
            out[at + step] += share[at]  # each at + step occurs once
        return out

    def rest(self, edges: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log of what all other paths of a chunk hold, for paths one after the other: at each edge
        the choice of another one, anything behind it."""
        upto = np.cumsum(self.log[edges])
        before = upto - self.log[edges]
        before -= np.repeat(before[starts], sizes)
        with np.errstate(divide="ignore"):
            return np.log(np.add.reduceat(np.exp(before) * self.others[edges], starts))

    def walk(self, chunk: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled edges of each chunk, one chunk after the other, and how many each has."""
        node, active, step = self.base[chunk], np.arange(len(chunk)), 0
        edges, owner = [], []
        while len(active):
            step += 1
            e, u = self.first[node], uniform(noise[active], step)
            later = np.flatnonzero(u >= self.upto[e])
            while len(later):
                e[later] += 1
                later = later[u[later] >= self.upto[e[later]]]
            edges.append(e), owner.append(active)
            node = self.to[e]
            going = ~self.end[node]
            node, active = node[going], active[going]
        if not edges:
            return np.zeros(0, np.int64), np.zeros(len(chunk), np.int64)
        owner = np.concatenate(owner)
        return np.concatenate(edges)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(chunk))

    def edges_of(self, node: int) -> tuple[int, list[float]]:
        """First edge of a node, and the logs of all its edges."""
        a, b = int(self.first[node]), int(self.first[node + 1])
        return a, self.log[a:b].tolist()


class Elsewhere:
    """Paths of one chunk that are taken, as a tree, and the log of what is left beside them.

    What is left below a node is a sum over its edges: all of an edge that no taken path goes
    through, and what is left behind one that a path does. Nothing is subtracted, so the smallest
    rest is as exact as the largest, and it is -inf only if every path is taken.
    """

    def __init__(self, lattices: Lattices, chunk: int, taken: list[int]) -> None:
        self.lattices, self.node = lattices, int(lattices.base[chunk])
        self.root: dict = {}
        self.take(taken)

    @property
    def left(self) -> float:
        return self.root["left"]

    def _weights(self, node: int, taken: dict) -> tuple[int, list[float]]:
        a, logs = self.lattices.edges_of(node)
        for e, below in taken.items():
            if e != "left":
                logs[e - a] += below["left"]
        return a, logs

    def take(self, path: list[int]) -> None:
        at, trail = self.root, [(self.node, self.root)]
        for e in path:
            at = at.setdefault(e, {})
            trail.append((int(self.lattices.to[e]), at))
        at["left"] = -np.inf
        for node, taken in reversed(trail[:-1]):
            _, logs = self._weights(node, taken)
            most = max(logs)
            taken["left"] = most + math.log(sum(math.exp(x - most) for x in logs)) if most > -np.inf else -np.inf

    def sample(self, noise: np.uint64) -> list[int]:
        """A path that is not taken, in proportion to its share of what is left."""
        node, taken, path, random = self.node, self.root, [], []
        while not self.lattices.end[node]:
            if len(path) == len(random):
                random += uniform(np.full(16, noise), np.arange(len(path) + 1, len(path) + 17)).tolist()
            a, logs = self._weights(node, taken) if taken else self.lattices.edges_of(node)
            left = taken["left"] if taken else 0.0
            u, k, last = random[len(path)], 0, 0
            for k, log in enumerate(logs):
                if log > -np.inf:
                    last = k
                    u -= math.exp(log - left)
                    if u < 0:
                        break
            path.append(a + last)
            node, taken = int(self.lattices.to[a + last]), taken.get(a + last, {})
        return path


def uniform(noise: np.ndarray, stream: int | np.ndarray) -> np.ndarray:
    """Numbers in (0, 1), one per noise word and stream."""
    step = np.asarray(stream).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) if isinstance(stream, np.ndarray) else np.uint64(stream * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return ((mix(noise + step) >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


def gumbel(noise: np.ndarray, stream: int) -> np.ndarray:
    return -np.log(-np.log(uniform(noise, stream)))


def chunks_of(text: str) -> list[str]:
    """Chunks of the normalised text: a space in front, every space shown; none for an empty text."""
    return _CHUNK.findall(SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)) if text else []


def sample_segmentations(texts: list[str], seeds: np.ndarray, k: int, vocabulary: Vocabulary) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per rank: which texts have that many segmentations, their ids one after the other, how many
    each has, log probabilities and logs of inclusion probabilities."""
    split = [chunks_of(t) for t in texts]
    counts = np.array([len(s) for s in split])
    filled = np.flatnonzero(counts)
    empty = np.flatnonzero(counts == 0)
    out = []
    if not len(filled):
        return [(empty, np.zeros(0, np.int32), np.zeros(len(empty), np.int64), np.zeros(len(empty)), np.zeros(len(empty)))]
    flat_chunks = [c for s in split for c in s]
    names = dict.fromkeys(flat_chunks)
    names.update(zip(names, range(len(names)), strict=True))
    chunk = np.fromiter(map(names.__getitem__, flat_chunks), np.int64, len(flat_chunks))
    lattices = Lattices(list(names), vocabulary)
    begin = (np.cumsum(counts) - counts)[filled]
    doc = np.repeat(np.arange(len(filled)), counts[filled])
    place = np.arange(len(chunk)) - begin[doc]
    seed = mix(seeds[filled].astype(np.uint64))
    noise = mix(seed[doc] + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))

    def before(log: np.ndarray) -> np.ndarray:
        """Log probability of the chunks in front, within the text."""
        upto = np.cumsum(log) - log
        return upto - upto[begin[doc]]

    def perturbed(mass: np.ndarray, top: np.ndarray, noise: np.ndarray, stream: int) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.where(mass > -np.inf, -np.logaddexp(-top, -(mass + gumbel(noise, stream))), -np.inf)

    edges, n = lattices.walk(chunk, noise)
    pool = [edges]
    used = len(edges)
    starts, sizes = [np.cumsum(n) - n], [n]
    logs = [np.add.reduceat(lattices.log[edges], starts[0])]
    top = gumbel(seed, 1 << 20)
    values = [perturbed(before(logs[0]) + lattices.rest(edges, starts[0], n), top[doc], noise, 1 << 21)]
    elsewhere: dict[tuple[int, int], Elsewhere] = {}
    emitted = [(np.arange(len(filled)), top)]

    def path(j: int, i: int, flat: np.ndarray) -> list[int]:
        return flat[starts[j][i] : starts[j][i] + sizes[j][i]].tolist()

    for rank in range(1, k + 1):
        stack = np.stack(values)
        high = stack.max(axis=0)
        best = np.maximum.reduceat(high, begin)
        if rank == k:
            break
        alive = np.flatnonzero(best > -np.inf)
        if not len(alive):
            break
        hits = np.flatnonzero(high == best[doc])
        turn = np.full(len(filled), len(chunk))
        turn[doc[hits[::-1]]] = hits[::-1]  # the first of each text
        source = np.zeros(len(filled), np.int64)
        source[alive] = stack[:, turn[alive]].argmax(axis=0)
        flat = np.concatenate(pool)
        pool = [flat]
        everywhere = np.arange(len(chunk))
        start = np.stack(starts)[source[doc], everywhere]
        size = np.stack(sizes)[source[doc], everywhere]
        log = np.stack(logs)[source[doc], everywhere]
        is_alive = np.zeros(len(filled), bool)
        is_alive[alive] = True
        behind = np.flatnonzero(is_alive[doc] & (everywhere > turn[doc]))
        fresh, n = lattices.walk(chunk[behind], mix(noise[behind] + np.uint64(rank)))
        pool.append(fresh)
        start[behind], size[behind] = used + np.cumsum(n) - n, n
        if len(behind):
            log[behind] = np.add.reduceat(lattices.log[fresh], np.cumsum(n) - n)
        used += len(fresh)
        ahead = before(log)  # holds up to each text's turn; behind it once the turn's own path is known
        mass = np.full(len(chunk), -np.inf)
        for d in alive.tolist():
            i, j = int(turn[d]), int(source[d])
            taken = elsewhere.pop((j, i), None) or Elsewhere(lattices, int(chunk[i]), path(j, i, flat))
            values[j][i] = -np.inf
            other = taken.sample(mix(noise[i : i + 1] + np.uint64(rank))[0])
            pool.append(np.array(other))
            start[i], size[i], log[i] = used, len(other), lattices.log[other].sum()
            used += len(other)
            taken.take(other)
            elsewhere[rank, i] = taken
            mass[i] = ahead[i] + taken.left
        ahead = before(log)
        if len(behind):
            mass[behind] = ahead[behind] + lattices.rest(fresh, np.cumsum(n) - n, n)
        with np.errstate(invalid="ignore"):
            value = perturbed(mass, np.where(is_alive, best, 0.0)[doc], noise, (1 << 21) + rank)
        starts.append(start), sizes.append(size), logs.append(log), values.append(value)
        emitted.append((alive, best[alive]))
    flat = np.concatenate(pool)
    bound = best  # the perturbed value of the segmentation that would come next
    for rank, (who, _) in enumerate(emitted):
        chosen = np.zeros(len(filled), bool)
        chosen[who] = True
        mine = np.flatnonzero(chosen[doc])
        size = sizes[rank][mine]
        walked = flat[np.repeat(starts[rank][mine] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        ids, per_edge = _ids(lattices.piece[walked], vocabulary)
        upto = np.concatenate([[0], np.cumsum(np.concatenate([[0], np.cumsum(per_edge)])[np.cumsum(size)] - np.concatenate([[0], np.cumsum(per_edge)])[np.cumsum(size) - size])])
        per_text = np.diff(upto[np.concatenate([[0], np.cumsum(np.bincount(doc[mine], minlength=len(filled))[who])])])
        log = np.bincount(doc[mine], logs[rank][mine], len(filled))[who]
        over = np.where(bound[who] > -np.inf, log - bound[who], np.inf)
        with np.errstate(over="ignore", divide="ignore"):  # a small chance is e ** over itself
            inclusion = np.where(over < -30, over, np.log(-np.expm1(-np.exp(np.clip(over, -30, 700)))))
        rows = filled[who]
        if rank == 0 and len(empty):
            rows, per_text = np.concatenate([rows, empty]), np.concatenate([per_text, np.zeros(len(empty), np.int64)])
            log, inclusion = np.concatenate([log, np.zeros(len(empty))]), np.concatenate([inclusion, np.zeros(len(empty))])
        out.append((rows, ids, per_text, log, inclusion))
    return out


def _ids(pieces: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of edges, one after the other, and how many each edge has: one, or a character's bytes."""
    odd = np.flatnonzero(pieces < 0)
    if not len(odd):
        return pieces.astype(np.int32), np.ones(len(pieces), np.int64)
    known: dict[int, np.ndarray] = {int(p): vocabulary.bytes[list(chr(-1 - int(p)).replace(LITERAL, SPACE).encode("utf-8"))] for p in np.unique(pieces[odd])}
    counts = np.ones(len(pieces), np.int64)
    counts[odd] = [len(known[p]) for p in pieces[odd].tolist()]
    out = np.repeat(pieces, counts)
    at = np.cumsum(counts) - counts
    for p, own in known.items():
        where = at[odd[pieces[odd] == p]]
        for b, code in enumerate(own):
            out[where + b] = code
    return out.astype(np.int32), counts


@lru_cache(2)
def _vocabulary(path: str, power: float) -> Vocabulary:
    return Vocabulary(path, power)


Finish = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def encode_sampled(
    df: DataFrame, *, model: str, k: int = 2, power: float = 1.0, seed: int = 0, key: str = "doc_id", text: str = "text", finish: tuple[Finish, str] | None = None
) -> DataFrame:
    """Up to k distinct segmentations of every text, sampled without replacement.

    Returns a row per text and sample: key, sample (int, from 1, in the order drawn), ids (array of
    int), log_prob (double), log_inclusion (double: log of the chance that a segmentation of this
    probability is among the k drawn, given the value of the one that would have come next).

    The first sample follows the distribution of whole segmentations. A text with fewer than k
    segmentations gives them all, with a chance of 1 each, however small their share. A null or empty
    text has one, without ids. Characters without a piece, and a U+2581 of the text itself, become
    their UTF-8 bytes. Equal keys with equal texts, repeated
    rows too, get equal samples; a null key is a key like others. Texts of any length are taken
    whole. Other columns are left out. An empty table gives no row. finish, with its schema, is a
    function over the result's Arrow batches that runs in the same task, before Spark gets them.
    """
    schema = T.StructType(
        [T.StructField(key, df.schema[key].dataType), T.StructField("sample", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("log_prob", T.DoubleType()), T.StructField("log_inclusion", T.DoubleType())]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model, power)
        for batch in batches:
            texts, seeds, keys = batch["__ss_text"].fill_null("").to_pylist(), batch["__ss_seed"].to_numpy().view(np.uint64), batch["__ss_key"]
            for part in _runs(texts):
                own = keys.slice(part.start, part.stop - part.start)
                for rank, (rows, ids, n, log, inclusion) in enumerate(sample_segmentations(texts[part], seeds[part], k, vocabulary), 1):
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids))
                    yield pa.RecordBatch.from_arrays([own.take(pa.array(rows)), pa.array(np.full(len(rows), rank, np.int32)), lists, pa.array(log), pa.array(inclusion)], names=schema.names)

    rows = df.select(F.col(key).alias("__ss_key"), F.col(text).alias("__ss_text"), F.xxhash64(F.lit(seed), F.col(key)).alias("__ss_seed"))
    if finish is None:
        return rows.mapInArrow(encode, schema)
    then, finished = finish
    return rows.mapInArrow(lambda batches: then(encode(batches)), finished)


def _runs(texts: list[str]) -> Iterator[slice]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > PIECE_CHARS:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def decoded_bytes(ids: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of texts, one after the other, and where each begins and the last ends."""
    lengths = vocabulary.piece_lengths[ids]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    raw = vocabulary.piece_bytes[np.repeat(vocabulary.piece_starts[ids] - (ends - lengths), lengths) + np.arange(total)]
    begins = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    first = begins[:-1][begins[1:] > begins[:-1]]
    first = first[raw[first] == 32]  # the space that encoding puts in front
    keep = np.ones(len(raw), bool)
    keep[first] = False
    return raw[keep], begins - np.searchsorted(first, begins)


def decode(df: DataFrame, *, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of a column of ids; null ids give null. The column text is replaced if present.

    Bytes that are no UTF-8, which only ids of other origin can give, are decoded by the model.
    """
    kept = [c for c in df.columns if c != text]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(text, T.StringType())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model, 1.0)
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                lists = batch[ids]
                flat, counts = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), lists.value_lengths().fill_null(0).to_numpy()
                raw, begins = decoded_bytes(flat, counts, vocabulary)
                texts = pa.Array.from_buffers(pa.large_string(), len(counts), [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(raw)]).cast(pa.large_binary())
                try:
                    texts = texts.cast(pa.string())
                except pa.ArrowInvalid:
                    texts = pa.array([vocabulary.model.decode(x or []) for x in lists.to_pylist()], pa.string())
                yield batch.append_column(text, pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string())))

    return df.select(*kept).mapInArrow(join, schema)


def digests(model: str) -> Finish:
    """Replace ids by n_ids, ids_crc32 (little-endian 32-bit words) and decoded_crc32, in the task
    that drew them."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model, 1.0)
        for batch in batches:
            lists = batch["ids"]
            flat, n = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy().astype(np.int64)
            raw, begins = decoded_bytes(flat, n, vocabulary)
            words, at = flat.astype("<u4"), np.concatenate([[0], np.cumsum(n)])
            columns = {"n_ids": n, "ids_crc32": [zlib.crc32(words[a:b]) for a, b in zip(at, at[1:], strict=False)], "decoded_crc32": [zlib.crc32(raw[a:b]) for a, b in zip(begins, begins[1:], strict=False)]}
            rest = batch.drop_columns(["ids"])
            yield pa.RecordBatch.from_arrays([*rest.columns, *(pa.array(c, pa.int64()) for c in columns.values())], names=[*rest.schema.names, *columns])

    return digest


def op6_subword_sampling(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    finish = (digests(model), "doc_id long, sample int, log_prob double, log_inclusion double, n_ids long, ids_crc32 long, decoded_crc32 long")
    return encode_sampled(docs, model=model, k=2, seed=20240506, finish=finish).select("doc_id", "sample", "n_ids", "ids_crc32", "log_prob", "log_inclusion", "decoded_crc32")
