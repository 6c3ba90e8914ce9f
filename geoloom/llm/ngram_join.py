"""N-gram Jaccard join by prefix trees over globally ordered n-gram sets.

The global order puts rare n-grams first: by a class of the documents that hold any n-gram of the
same bucket, counted over the whole table, then by hash. Two sets over the threshold share an n-gram
of their beginnings in that order, so documents meet by those. A tree over the beginnings of all
that meet in a place, traversed with partial overlaps and bounds on what remains, leaves groups that
may be linked; a tree over the whole sets of such a group decides which are.

Equal sets are one node of the graph throughout, told apart by a 128-bit digest of the set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_texts, discard, may_hold, read_table, slots_for, sorted_groups, written
from .components import connected_components
from .prefix_tree import CLASS_BITS, CLASS_SHIFT, PrefixTree, beginning, frequency_classes, prefix_lengths, ranked
from .shingles import digest, shingle_sets

#: Sets, and n-grams, of one tree: 16 MB.
BLOCK_SETS, BLOCK_GRAMS = 1024, 2_000_000
#: Buckets of n-grams whose counts make one row.
COUNTED = 8192
#: Sets that a task remembers to pass over their copies.
REMEMBERED = 1 << 20


class _Seen:
    """Copies within a task say nothing new; what is remembered of them is bounded."""

    def __init__(self) -> None:
        self.names: set[tuple[int, int]] = set()

    def __call__(self, name: tuple[int, int]) -> bool:
        if name in self.names:
            return True
        if len(self.names) >= REMEMBERED:
            self.names.clear()
        self.names.add(name)
        return False


def _scanned(df: DataFrame, *, words: int, text: str, key: str) -> DataFrame:
    """One row per document (key, n, h1, h2, th), and rows (block, at, counts) without the others:
    how many sets of a task hold n-grams of each bucket, a run of buckets a row."""
    key_type = df.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, names = np.zeros(1 << CLASS_BITS, np.uint32), _Seen(), ["key", "n", "h1", "h2", "th", "block", "at", "counts"]
        key_arrow = None
        for batch in batches:
            key_arrow = batch["__nj_key"].type
            n, h1, h2 = [], [], []
            for grams in shingle_sets(*binary_texts(batch["__nj_text"]), words):
                name = digest(grams) if len(grams) else (None, None)
                n.append(len(grams)), h1.append(name[0]), h2.append(name[1])
                if len(grams) and not seen(name):
                    np.add.at(counts, (grams >> CLASS_SHIFT).view(np.int64), 1)
            none = [pa.nulls(batch.num_rows, kind) for kind in (pa.int64(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["__nj_key"], *(pa.array(x, pa.int64()) for x in (n, h1, h2)), batch["__nj_th"], *none], names=names)
        blocks = counts.reshape(-1, COUNTED)
        used = np.flatnonzero(blocks.any(axis=1))
        for i in range(0, len(used), 512):
            some = used[i : i + 512]
            none, (at, own) = pa.nulls(len(some), pa.int64()), zip(*(_packed(blocks[b]) for b in some), strict=True)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(some), key_arrow), none, none, none, none, pa.array(some), pa.array(at, pa.binary()), pa.array(own, pa.binary())], names=names)

    rows = df.select(F.col(key).alias("__nj_key"), F.col(text).alias("__nj_text"), F.xxhash64(text).alias("__nj_th"))
    return rows.mapInArrow(scan, f"key {key_type}, n long, h1 long, h2 long, th long, block long, at binary, counts binary")


def _packed(counts: np.ndarray) -> tuple[bytes | None, bytes]:
    """Counts of a block in few bytes: where they stand, if few are not 0, and their values."""
    used = np.flatnonzero(counts)
    few = 3 * len(used) < len(counts)
    values = counts[used] if few else counts
    return used.astype(np.uint16).tobytes() if few else None, values.astype(np.uint8 if values.max() < 256 else np.uint32).tobytes()


def _add_packed(total: np.ndarray, at: bytes | None, counts: bytes) -> None:
    where = slice(None) if at is None else np.frombuffer(at, np.uint16)
    n = len(total) if at is None else len(where)
    total[where] += np.frombuffer(counts, np.uint8 if len(counts) == n else np.uint32)


def _classes(scanned: DataFrame) -> Broadcast:
    """Frequency classes of all buckets: 2 MB reach the driver and the tasks at any size of the table.

    Blocks of counts are added up one after the other, so a task holds one sum whatever comes in.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, np.zeros(COUNTED, np.int64)
        for batch in batches:
            for b, at, counts in zip(*(batch[c].to_pylist() for c in ("block", "at", "counts")), strict=True):
                if b != block:
                    if block is not None:
                        yield pa.record_batch({"block": [block], "classes": pa.array([frequency_classes(total).tobytes()], pa.binary())})
                    block = b
                    total[:] = 0
                _add_packed(total, at, counts)
        if block is not None:
            yield pa.record_batch({"block": [block], "classes": pa.array([frequency_classes(total).tobytes()], pa.binary())})

    counted = scanned.filter("block IS NOT NULL").select("block", "at", "counts")
    sums = counted.repartition("block").sortWithinPartitions("block").mapInArrow(add, "block long, classes binary").toArrow()
    classes = np.zeros((1 << CLASS_BITS) // COUNTED * COUNTED, np.uint8).reshape(-1, COUNTED)
    for b, own in zip(sums["block"].to_pylist(), sums["classes"].to_pylist(), strict=True):
        classes[b] = np.frombuffer(own, np.uint8)
    return scanned.sparkSession.sparkContext.broadcast(classes.reshape(-1))


def _beginnings(df: DataFrame, class_of: Broadcast, *, words: int, num: int, den: int, text: str) -> DataFrame:
    """(h1, h2, n, grams) of every distinct set of a task: its first n-grams as 64-bit words. A set
    that several tasks meet has a row of each."""

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            rows = []
            for grams in shingle_sets(*binary_texts(batch["__nj_text"]), words):
                if len(grams) and not seen(name := digest(grams)):
                    rows.append((*name, len(grams), beginning(grams, prefix_lengths(len(grams), num, den)[0], class_of.value).tobytes()))
            if rows:
                h1, h2, n, first = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(n, pa.int64()), pa.array(first, pa.binary())], names=["h1", "h2", "n", "grams"])

    return df.select(F.col(text).alias("__nj_text")).mapInArrow(begin, "h1 long, h2 long, n long, grams binary")


def _words(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _meetings(beginnings: DataFrame, *, num: int, den: int) -> DataFrame:
    """(h1, n, place): sets whose beginnings share an n-gram share a place; each at most once."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, sizes = _words(batch["grams"]), batch["n"].to_numpy()
            counts = [len(g) for g in grams]
            # the last bit tells n-grams by which a set is only sought from those by which it is found
            sought = [np.arange(len(g)) >= prefix_lengths(int(n), num, den)[1] for g, n in zip(grams, sizes, strict=True)]
            size = np.repeat(sizes, counts) * 2 + np.concatenate(sought)
            yield pa.record_batch({"gram": pa.array(np.concatenate(grams).view(np.int64)), "size": pa.array(size), "h1": pa.array(np.repeat(batch["h1"].to_numpy(), counts))})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Within sorted rows: the first set that holds an n-gram names the place. Sets of one
        n-gram are cut where sizes are too far apart for a link. The first and the last n-gram of a
        task may go on in another, so there the n-gram itself is the place."""
        first = last = None
        held: tuple[np.ndarray, ...] | None = None

        def shared(gram: np.ndarray, size: np.ndarray, h1: np.ndarray) -> pa.RecordBatch:
            n = size >> 1
            edge = (gram == first) | (gram == last)
            fresh = (gram[1:] != gram[:-1]) | (~edge[1:] & (n[:-1] * den < n[1:] * num))
            begins = np.flatnonzero(np.concatenate([[True], fresh]))
            length = np.diff(np.append(begins, len(gram)))
            some = np.logical_or.reduceat((size & 1) == 0, begins) & (length > 1)
            keep = np.repeat(some, length) | edge
            place = np.where(edge, gram, np.repeat(h1[begins], length))[keep]
            return pa.RecordBatch.from_arrays([pa.array(h1[keep]), pa.array(n[keep]), pa.array(place)], names=["h1", "n", "place"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(batch[c].to_numpy() for c in ("gram", "size", "h1"))
            first = rows[0][0] if first is None else first
            if held:
                rows = tuple(np.concatenate(x) for x in zip(held, rows, strict=True))
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut:
                yield shared(*(x[:cut] for x in rows))
            held = tuple(x[cut:] for x in rows)
            if len(held[0]) > 1 << 18:  # an n-gram of very many sets: its rows leave at once, under its own name
                last = held[0][0]
                yield shared(*held)
                held = None
        if held:
            last = held[0][0]
            yield shared(*held)

    rows = beginnings.mapInArrow(spread, "gram long, size long, h1 long")
    # range partitions by all columns: an n-gram that very many sets hold is split over tasks
    dealt = rows.repartitionByRange("gram", "size", "h1").sortWithinPartitions("gram", "size", "h1")
    return dealt.mapInArrow(meet, "h1 long, n long, place long").distinct()


def _grouped(rows: DataFrame, class_of: Broadcast, *, num: int, den: int) -> DataFrame:
    """(h1, n, place): what a tree over the beginnings of a place's sets leaves, a place per group."""

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["place"]):
            place, h1, h2, n = (table[c].to_numpy() for c in ("place", "h1", "h2", "n"))
            begins = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            names, counts, groups = [], [], []
            for a, b in zip(begins, [*begins[1:], len(place)], strict=True):
                once = list({(x, y): i for i, (x, y) in enumerate(zip(h1[a:b].tolist(), h2[a:b].tolist(), strict=True))}.values())
                if len(once) < 2:
                    continue
                sets = _words(table["grams"].slice(a, b - a).take(pa.array(once)))
                label = PrefixTree(ranked(sets, class_of.value), n[a:b][once]).groups(num, den)
                label = np.unique(label, return_inverse=True)[1]
                name, size = h1[a:b][once], np.bincount(label)
                least = np.full(len(size), np.iinfo(np.int64).max)
                np.minimum.at(least, label, name)
                keep = size[label] > 1
                names.append(name[keep]), counts.append(n[a:b][once][keep]), groups.append(least[label][keep])
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (names, counts, groups)], names=["h1", "n", "place"])

    return rows.repartition("place").sortWithinPartitions("place").mapInArrow(prune, "h1 long, n long, place long")


def _linked(blocks: DataFrame, class_of: Broadcast, *, words: int, num: int, den: int) -> DataFrame:
    """Links (a, b) of a forest, from rows (place, block, node, label, h1, h2, text)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["place", "block"]):
            place, block, node, label, h1, h2 = (table[c].to_numpy() for c in ("place", "block", "node", "label", "h1", "h2"))
            begins = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (block[1:] != block[:-1])]))
            found: list[tuple[int, int]] = []
            for a, b in zip(begins, [*begins[1:], len(node)], strict=True):
                once: dict[int, tuple[int, np.ndarray]] = {}
                for i, grams in enumerate(shingle_sets(*binary_texts(table["text"].slice(a, b - a)), words), a):
                    # a text of the same key and hash that is not the node's own brings another set
                    if len(grams) and digest(grams) == (h1[i], h2[i]):
                        once[int(node[i])] = (int(label[i]), grams)
                if len(once) > 1:
                    names, (labels, sets) = np.array(list(once)), zip(*once.values(), strict=True)
                    tree = PrefixTree(ranked(list(sets), class_of.value, frequent_first=True), np.array([len(s) for s in sets]))
                    group = tree.groups(num, den, np.array(labels))
                    least = {g: names[group == g].min() for g in np.unique(group)}
                    found += [(int(x), int(least[g])) for x, g in zip(names, group, strict=True) if least[g] != x]
            if found:
                yield pa.record_batch({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return blocks.repartition("place", "block").sortWithinPartitions("place", "block").mapInArrow(join, "a long, b long")


def near_duplicate_components(df: DataFrame, *, words: int = 5, num: int = 4, den: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Components of documents under links of Jaccard similarity num / den or more.

    Returns a row per input row: key, n_shingles (size of the set of distinct word n-grams, long),
    component_id (smallest key that links reach, the row's own included).

    Words are split at ASCII white space, A-Z counts as a-z. A text with fewer words than an n-gram
    has its whole sequence as its one n-gram; a null or empty text, or one without words, has none
    and is linked with nothing. Equal sets are linked. Sets of any size are joined by all n-grams of
    their beginnings, without a cap. Rows that repeat are all returned. A null key counts only if a
    component has no other. An empty table gives an empty result. Other columns are left out.
    """
    scanned = written(_scanned(df, words=words, text=text, key=key), "shingle-scan")
    docs = scanned.filter("block IS NULL").drop("block", "at", "counts")
    nodes = docs.filter("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.min(F.struct(F.col("key").isNull().alias("last"), "key", "th")).alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", F.col("first.key").alias("first"), F.col("first.th").alias("th"), "n", "rows"), "shingle-nodes")
    class_of = _classes(scanned)
    # copies in many tasks are one row from here on, so a place holds each set once
    beginnings = _beginnings(df, class_of, words=words, num=num, den=den, text=text).repartition("h1").dropDuplicates(["h1", "h2"])
    beginnings = written(beginnings, "set-beginnings")
    meetings = written(_meetings(beginnings, num=num, den=den), "meetings")
    places = meetings.groupBy("place").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("grams")).filter("members > 1")
    places = written(places.select("place", F.expr(f"members > {BLOCK_SETS} OR grams > {BLOCK_GRAMS}").alias("large")), "meeting-places")
    met = written(meetings.join(places, "place"), "meetings-shared")
    small = beginnings.join(met.filter("NOT large").select("h1", "place").hint("shuffle_hash"), "h1")
    groups = _grouped(small, class_of, num=num, den=den).unionByName(_banded(met.filter("large"), num, den))
    groups = written(groups.distinct(), "set-groups")
    discard(meetings, beginnings, places, met)
    sizes = groups.groupBy("place").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("grams")).filter("members > 1")
    sizes = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("members") / BLOCK_SETS), F.ceil(F.col("grams") / BLOCK_GRAMS)))
    sizes = written(sizes.select("place", "blocks"), "group-sizes")
    members = written(groups.drop("n").join(sizes, "place").join(nodes.select("node", "h1"), "h1").drop("h1"), "group-members")
    slots = slots_for(members.count())
    texts = df.select(F.col(key).alias("__nj_key"), F.xxhash64(text).alias("__nj_th"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def linked(rows: DataFrame) -> DataFrame:
        """Links within blocks (place, block, node, label)."""
        rows = rows.join(nodes.select("node", "h1", "h2", "first", "th"), "node")
        wanted = texts.filter(may_hold(rows.select("th"), slots)("__nj_th"))  # most texts meet no other and stay where they are
        # the small side is hashed at every size; a broadcast would depend on it
        rows = wanted.join(rows.hint("shuffle_hash"), (F.col("th") == F.col("__nj_th")) & F.col("first").eqNullSafe(F.col("__nj_key")))
        return _linked(rows.select("place", "block", "node", "label", "h1", "h2", "text"), class_of, words=words, num=num, den=den)

    links = written(linked(members.select("place", _dealt(1).alias("block"), "node", F.col("node").alias("label"))), "links")
    large = members.filter("blocks > 1")
    if not large.isEmpty():
        links = _between_blocks(large, links, linked)
    labels = connected_components(links)
    found = _labelled(docs, nodes, labels, key)
    discard(groups, sizes, members, links)
    return found


def _banded(large: DataFrame, num: int, den: int) -> DataFrame:
    """(h1, n, place) with a large place's sets dealt by size: linked sizes are in one band or in two
    bands side by side, so each set goes to its own band and to the next."""
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(max(den / num, 1.0) + 1e-9))).cast("long")
    return large.select("h1", "n", "place", F.explode(F.array(band, band + 1)).alias("band")).select("h1", "n", F.xxhash64("place", "band").alias("place"))


def _dealt(seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "node"), F.col("blocks"))


def _between_blocks(large: DataFrame, links: DataFrame, linked: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links between the blocks of large groups.

    Another random deal into blocks joins most of what belongs together. Members of a group outside
    its largest component are then held against all of its members, block by block, so no pair of
    different components is left out.
    """
    links = written(links.unionByName(linked(large.select("place", _dealt(2).alias("block"), "node", F.col("node").alias("label")))), "links")
    labels = connected_components(links)
    named = written(large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "large-members")
    sizes = named.groupBy("place", "label").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("place").agg(F.max(F.struct("size", "label")).alias("top"), F.sum("size").alias("members"))
    odd = largest.select("place", F.col("top.label").alias("main"), (F.col("members") - F.col("top.size")).alias("others")).filter("others > 0")
    odd = written(odd.withColumn("asks", F.ceil(F.col("others") / BLOCK_SETS)), "odd-places")
    if odd.isEmpty():
        return links
    rows = written(named.join(odd, "place"), "odd-members")
    own_block, own_ask = _dealt(3), F.pmod(F.xxhash64(F.lit(4), "node"), F.col("asks"))
    against = rows.withColumn("ask", F.explode(F.sequence(F.lit(0).cast("long"), F.col("asks") - 1))).withColumn("block", own_block * F.col("asks") + F.col("ask"))
    asking = rows.filter("label <> main").withColumn("in", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("block", F.col("in") * F.col("asks") + own_ask)
    both = against.select("place", "block", "node", "label").unionByName(asking.select("place", "block", "node", "label")).distinct()
    return written(links.unionByName(linked(both)), "links")


def _labelled(docs: DataFrame, nodes: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    grouped = written(nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled-nodes")
    reach = grouped.groupBy("label").agg(F.min("first").alias("component"), F.sum("rows").alias("size")).filter("size > 1")
    # written, so that both sides are plain exchanges and a component of very many nodes can be split;
    # only what differs from the document's own key is joined back
    known = written(grouped.join(written(reach, "component-keys"), "label").select("h1", "h2", "component"), "components")
    joined = docs.join(known, ["h1", "h2"], "left")
    return joined.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component_id"))


def keep_first_of_each(df: DataFrame, *, words: int = 5, num: int = 4, den: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of df whose key is the smallest of their component; all columns as they are."""
    found = near_duplicate_components(df, words=words, num=num, den=den, text=text, key=key)
    gone = found.filter(F.col("component_id") != F.col(key)).select(F.col(key).alias("__nj_gone")).distinct()
    return df.join(gone, F.col(key) == F.col("__nj_gone"), "left_anti")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicate_components(docs, words=3, num=9, den=10)


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) END AS s FROM w),
grams AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
named AS MATERIALIZED (SELECT doc_id, n, hash(g) AS g FROM grams),
links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM named a JOIN named b ON a.g = b.g AND a.doc_id <> b.doc_id
  WHERE 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS r FROM documents
  UNION SELECT links.y, reach.r FROM reach JOIN links ON links.x = reach.x)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(r) AS component_id
FROM sets JOIN reach ON reach.x = sets.doc_id GROUP BY sets.doc_id, len(s)
"""
