"""Documents linked by the Jaccard similarity of their word n-grams, by adaptive prefixes.

A document's set is its distinct word shingles (A-Z as a-z); a text with fewer words is one
shingle, and one without words has an empty set and is linked with nothing. Two documents
link when ``100 * intersection >= percent * union``.

1. A sketch counts the shingles of all documents: ``SLOTS`` counters, whatever the number of
   documents. It gives every shingle a frequency class, and (class, hash) is the one order
   in which every set is sorted, rare shingles first. The order decides what is compared,
   never what is found.
2. Two sets of which at least ``o`` shingles must be common share at least ``l`` of the first
   ``size - o + l`` of each. So every document has its own ``l``: it starts with the plain
   prefix and lengthens it while the estimated cost of sending longer prefixes and of the
   candidates that are left, each of which must then share ``l`` of them, goes down. A pair
   with ``l`` and ``m`` must share at least the smaller of both.
3. Equal sets are one class: a task sends the prefix of a class once. Postings (shingle,
   class) meet by shingle; a list of one is dropped where it is found. Each class of a list
   is first compared with the list's hub, the class that has the shingle nearest to its
   front: it has the fewest shingles that others lack. What comes out grows with the
   postings.
4. The prefixes of a pair meet at its hub, or at one of several places of a hub with many
   partners. Pairs that share enough of them meet there again with their full sets, made
   anew from the texts. The links make components.
5. In lists that still hold several components, all pairs of classes of different components
   are looked at, in blocks of ``BLOCK`` that are spread over the tasks: sizes must allow the
   link, and the shingle must stand early enough in both to be the first of all that they
   must have in common. Such pairs are checked in turn. So no pair of different texts is
   dropped, however long the list.

Shingles are told apart by their class and 56 bits of a hash. Null doc_ids stay rows of their own; a component is named by its smallest
doc_id (null if it has none). Repeated rows are copies. An empty table gives an empty
result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tickflow.llm.components import components
from tickflow.llm.near_dups import sets, shingles
from tickflow.llm.words import LOWER, over_batches, token_chunks
from tickflow.scratch import new_folder

# Counters of the sketch: 16 MB in a task, 4 MB of classes for every worker.
SLOTS = 1 << 22
SLICES = 64
# Shared prefix shingles that a document may ask for.
STEPS = np.array([1, 2, 3, 4, 6, 8])
# Costs: of a posting, and of checking a candidate (plus one for so many shingles).
POSTING, CHECK, CHECK_SHINGLES = 1.0, 4.0, 32.0
BLOCK = 256
# Groups of up to so many rows are gone through together.
FEW = 8
# So many partners of a hub are checked in one place.
PARTNERS = 256
# At most this many classes to be checked (some 50 bytes each) are broadcast to the texts.
BROADCAST_ROWS = 500_000
NO_ID = -(2**63)

_LOW = np.uint64((1 << 56) - 1)


# --- the order ---------------------------------------------------------------------


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


def _counts(texts: DataFrame, size: int) -> np.ndarray:
    """The sketch over all rows: tasks count, slices are added up, the sums are collected."""
    width = SLOTS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.uint32)
        held, waiting = [], 0
        for batch in batches:
            for _, found in token_chunks(batch.column("text"), LOWER):
                hashes, _ = shingles(found, size)
                held.append(_slot(hashes))
                waiting += len(hashes)
                if waiting > SLOTS:
                    total += np.bincount(np.concatenate(held), minlength=SLOTS).astype(np.uint32)
                    held, waiting = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=SLOTS).astype(np.uint32)
        codec = pa.Codec("zstd")
        blobs = [codec.compress(x.tobytes(), asbytes=True) for x in total.reshape(SLICES, width)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array(blobs, pa.binary())], ["slice", "counts"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, total = pa.Codec("zstd"), {}
        for batch in batches:
            for name, blob in zip(*[batch.column(c).to_pylist() for c in ("slice", "counts")], strict=True):
                here = np.frombuffer(codec.decompress(blob, width * 4), np.uint32)
                total[name] = total.get(name, 0) + here.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(total.keys(), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
            ["slice", "counts"],
        )

    schema = "slice int, counts binary"
    found = texts.mapInArrow(count, schema).repartition("slice").mapInArrow(add, schema).collect()
    out = np.zeros((SLICES, width), np.int64)
    for row in found:
        out[row.slice] = np.frombuffer(row.counts, np.int64)
    return out.reshape(-1)


def frequency_classes(counts: np.ndarray) -> np.ndarray:
    """Half powers of two of what a counter holds beyond the others' chance share."""
    mean = counts.sum() / len(counts)
    above = np.maximum(counts - mean - 3 * np.sqrt(mean), 1.0)
    return np.minimum(np.floor(2 * np.log2(above)), 255).astype(np.uint8)


_COST = 2.0 ** (np.arange(256) / 2) - 1  # other documents that have a shingle of a class


def least_common(size: int, percent: int) -> int:
    """What a set of ``size`` must at least share with any set it links with."""
    return -(-percent * size // 100)


def needed_common(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """What sets of the sizes ``a`` and ``b`` must share to link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix(ordered: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a set in its order (class in the upper byte), and how many of its
    shingles another prefix must share."""
    n = len(ordered)
    least = least_common(n, percent)
    steps = STEPS[least >= STEPS]
    lengths = n - least + steps
    head = ordered[: lengths[-1]]
    lists = np.cumsum(_COST[(head >> np.uint64(56)).astype(np.int64)])[lengths - 1]
    cost = POSTING * lengths + lists + lists / steps * (CHECK + n / CHECK_SHINGLES)
    best = int(cost.argmin())
    return head[: lengths[best]], int(steps[best])


def _ordered(h: np.ndarray, of_slot: np.ndarray) -> np.ndarray:
    """A set of hashes in the one order of all sets."""
    out = (of_slot[_slot(h)].astype(np.uint64) << np.uint64(56)) | (h & _LOW)
    out.sort()
    return out


def _signed(docs: DataFrame, size: int, percent: int, classes: Broadcast) -> DataFrame:
    """doc_id, n (shingles), node (the set's name, null if empty), its prefix and ``need``."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        n, node, heads, need = [], [], [], []
        for _, each, names in sets(batch.column("text"), size):
            for h, name in zip(each, names.view(np.int64).tolist(), strict=True):
                n.append(len(h))
                if not len(h):
                    node.append(None), heads.append(None), need.append(None)
                    continue
                head, steps = prefix(_ordered(h, classes.value), percent)
                node.append(name), heads.append(head.tobytes()), need.append(steps)
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32())
        return [pa.array(x, kind) for x, kind in zip((n, node, heads, need), kinds, strict=True)]

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return over_batches(texts, lambda: work, ["doc_id"], "n long, node long, head binary, need int")


# --- lists -------------------------------------------------------------------------


# A posting's ``place``: the shingle's position in the order, the size of the set and ``need``.
_AT, _SIZE, _NEED = 35, 4, 15


def _place(at: np.ndarray, n: np.ndarray, need: np.ndarray) -> np.ndarray:
    return at << _AT | n << _SIZE | need


def _at(place: np.ndarray) -> np.ndarray:
    return place >> _AT


def _sizes(place: np.ndarray) -> np.ndarray:
    return (place >> _SIZE) & ((1 << (_AT - _SIZE)) - 1)


def _postings(signed: DataFrame) -> DataFrame:
    """A row for every shingle of the prefixes of a task's classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            new = []
            for i, name in enumerate(batch.column("node").to_pylist()):
                if name not in seen:
                    seen.add(name)
                    new.append(i)
            if not new:
                continue
            rows = batch.take(pa.array(new))
            heads = [np.frombuffer(x, np.int64) for x in rows.column("head").to_pylist()]
            lengths = np.array([len(h) for h in heads])
            at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            n, need, node = (np.repeat(rows.column(c).to_numpy(), lengths) for c in ("n", "need", "node"))
            key, place = np.concatenate(heads), _place(at, n, need)
            for a in range(0, len(at), 1 << 16):
                columns = [pa.array(x[a : a + (1 << 16)]) for x in (key, node, place)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "node", "place"])

    rows = signed.where("node is not null").select("node", "n", "head", "need")
    return rows.mapInArrow(run, "key long, node long, place long")


def _may_start(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether a shingle in these places can be the first that two linked sets share: sizes
    must be near, and enough must follow in both."""
    n, m = _sizes(a), _sizes(b)
    near = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    return near & (np.minimum(n - _at(a), m - _at(b)) >= needed_common(n, m, percent))


Row = tuple[np.ndarray, np.ndarray, np.ndarray]  # key, node, place


def _lists(postings: DataFrame, percent: int) -> DataFrame:
    """The postings of lists of two and more classes, each class once, with the class it is
    compared with first: the list's hub, or else the class before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Open | None = None
        for batch in batches:
            if len(batch):
                out, state = _met(tuple(batch.column(c).to_numpy() for c in ("key", "node", "place")), state, percent)
                if out is not None:
                    yield out
        if state is not None and state.joined:
            yield _list_rows(*state.row, np.array([state.first]), np.array([state.known]))

    laid = postings.repartition("key").sortWithinPartitions("key", "place", "node")
    return laid.mapInArrow(run, "key long, node long, place long, first long")


@dataclass
class _Open:
    """The last row of a batch, which waits for the next one, and its list so far."""

    row: Row
    hub: tuple[int, int]  # node and place
    first: int
    known: bool
    joined: bool  # whether the list has other rows


def _list_rows(key, node, place, first, known) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(node), pa.array(place), pa.array(first, mask=~known)],
        ["key", "node", "place", "first"],
    )


def _met(rows: Row, state: _Open | None, percent: int) -> tuple[pa.RecordBatch | None, _Open]:
    """The rows but the last of lists of two and more, and the state for the next batch."""
    if state is not None:
        rows = tuple(np.concatenate(x) for x in zip(state.row, rows, strict=True))
    key, node, place = rows
    # Copies of a class from several tasks stand together.
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node, place = key[new], node[new], place[new]
    count = len(key)
    same = np.zeros(count, bool)
    same[1:] = key[1:] == key[:-1]
    begin = np.maximum.accumulate(np.where(same, 0, np.arange(count)))
    hub, hub_place = node[begin], place[begin]
    if state is not None:
        upto = count if same[1:].all() else 1 + int(np.argmin(same[1:]))
        hub[:upto], hub_place[:upto] = state.hub
    first, first_place = hub.copy(), hub_place.copy()
    other = np.flatnonzero(same & ~_may_start(hub_place, place, percent))
    first[other], first_place[other] = node[other - 1], place[other - 1]
    known = same & (first != node) & _may_start(first_place, place, percent)
    here = same.copy()
    if state is not None:
        first[0], known[0], here[0] = state.first, state.known, state.joined
    follows = np.zeros(count, bool)
    follows[:-1] = same[1:]
    emit = (here | follows)[:-1]
    out = _list_rows(*[x[:-1][emit] for x in (key, node, place, first, known)]) if emit.any() else None
    last = (key[-1:], node[-1:], place[-1:])
    hub_of_last = (int(hub[-1]), int(hub_place[-1]))
    return out, _Open(last, hub_of_last, int(first[-1]), bool(known[-1]), bool(here[-1]))


def _cross(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs a < b of different components that may link. ``rows``: group (a list, or two
    blocks of one), side, node, place, part.

    Linked sets have a first shared shingle, which leaves room for all that they must have in
    common; so a pair comes out of the lists where sizes and positions leave it."""

    def near(columns: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of groups of a few rows, all groups at once: every row with the next, the one after
        that, and so on."""
        group, node, place, part, side = columns
        last = np.searchsorted(group, group, "right") - 1
        for d in range(1, FEW):
            x = np.flatnonzero(group[d:] == group[:-d])
            y = x + d
            # Of two blocks, one row of each.
            apart = (part[x] != part[y]) & (side[x] == 0) & (side[y] == side[last[x]])
            x, y = x[apart], y[apart]
            keep = _may_start(place[x], place[y], percent)
            yield node[x[keep]], node[y[keep]]

    def blocks(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        _, node, place, part, side = columns
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(y):
            y = x
        a, b = np.nonzero(part[x][:, None] != part[y][None, :])
        a, b = x[a], y[b]
        if y is x:
            a, b = a[a < b], b[a < b]
        keep = _may_start(place[a], place[b], percent)
        return node[a[keep]], node[b[keep]]

    def found(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        group = columns[0]
        if not len(group):
            return
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(starts, len(group)))
        few = np.repeat(sizes <= FEW, sizes)
        several = list(near([c[few] for c in columns]))
        for start, size in zip(starts[sizes > FEW].tolist(), sizes[sizes > FEW].tolist(), strict=True):
            several.append(blocks([c[start : start + size] for c in columns]))
        for a, b in several:
            low, high = np.minimum(a, b), np.maximum(a, b)
            for i in range(0, len(a), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in (low, high)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(c).to_numpy() for c in ("group", "node", "place", "part", "side")]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
            # The last group may go on in the next batch.
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            yield from found([c[:cut] for c in columns])
            rest = [c[cut:] for c in columns]
        if rest is not None:
            yield from found(rest)

    # So many tasks as are asked for: the rows are few, the work on them is not.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartition(tasks, "group").sortWithinPartitions("group", "side", "node")
    return laid.mapInArrow(run, "a long, b long")


# --- confirmation ------------------------------------------------------------------


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many elements two arrays of distinct elements have in common."""
    both = np.sort(np.concatenate([x, y]))
    return int((both[1:] == both[:-1]).sum())


def prefixes_share_enough(x: np.ndarray, y: np.ndarray, facts: tuple[tuple[int, int], ...], percent: int) -> bool:
    """Whether two prefixes share as many shingles as linked sets would; ``facts`` are size
    and ``need`` of both. Prefixes are longer than these two sizes ask for, so more must be
    shared than ``need``."""
    (n, need), (m, other) = facts
    common = int(needed_common(np.int64(n), np.int64(m), percent))
    least = common + min(need - least_common(n, percent), other - least_common(m, percent))
    return _shared(x[: n - common + least], y[: m - common + least]) >= least


def sets_link(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = _shared(x, y)
    return 100 * common >= percent * (len(x) + len(y) - common)


Send = Callable[[DataFrame], DataFrame]


def _compared(pairs: DataFrame, classes: DataFrame, send: Send, test: Callable[..., bool]) -> DataFrame:
    """The pairs (hub, node) that pass ``test(array, other, facts)``.

    ``send`` adds the column ``held`` to rows of classes with places to go to. A class goes to
    every place where it is compared; a hub has one place for ``PARTNERS`` partners."""
    sizes = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    sizes = _stored(sizes.select("hub", F.ceil(F.col("n") / F.lit(float(PARTNERS))).alias("places")), "ngram-hubs")
    place = F.xxhash64("hub", F.pmod(F.xxhash64("node"), F.col("places"))).alias("place")
    partners = pairs.join(sizes, "hub").select("node", F.struct(place, F.lit(1).alias("side")).alias("to"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("places") - 1))
    hubs = sizes.select("hub", every.alias("i")).select(
        F.col("hub").alias("node"),
        F.struct(F.xxhash64("hub", F.col("i")).alias("place"), F.lit(0).alias("side")).alias("to"),
    )
    to = partners.union(hubs).groupBy("node").agg(F.collect_list("to").alias("to"))
    wanted = _stored(to.join(classes, "node"), "ngram-sent")
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = send(F.broadcast(wanted) if few else wanted).select("node", "n", "need", "held", F.explode("to").alias("to"))
    rows = rows.select("to.place", "to.side", "node", "n", "need", "held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub, of_hub, held = None, None, None, None
        for batch in batches:
            a, b = [], []
            columns = ("place", "side", "node", "n", "need", "held")
            for place, side, node, n, need, raw in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                if side == 0:
                    at, hub, of_hub, held = place, node, (n, need), np.frombuffer(raw, np.uint64)
                elif place == at and test(held, np.frombuffer(raw, np.uint64), (of_hub, (n, need))):
                    a.append(hub), b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["hub", "node"])

    laid = rows.repartition("place").sortWithinPartitions("place", "side", "node")
    return laid.mapInArrow(run, "hub long, node long")


def _linked(
    pairs: DataFrame, docs: DataFrame, signed: DataFrame, classes: DataFrame, of_slot: Broadcast, size: int, percent: int
) -> DataFrame:
    """The pairs (hub, node) whose sets link, as edges a, b: those whose prefixes share enough
    are compared in full, for which their texts are read once more."""

    def heads(wanted: DataFrame) -> DataFrame:
        own = signed.select("node", F.col("doc_id").alias("doc"), F.col("head").alias("held"))
        same = own.node.eqNullSafe(wanted.node) & own.doc.eqNullSafe(wanted.doc)
        return wanted.join(own, same).select(wanted.node, "n", "need", "to", "held")

    def full(wanted: DataFrame) -> DataFrame:
        key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
        texts = docs.select(key.alias("key"), F.col("text").cast("string").alias("text"))
        wanted = wanted.select(F.coalesce("doc", F.lit(NO_ID)).alias("key"), "node", "n", "need", "to")

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            named, made = [], []
            for _, each, names in sets(batch.column("text"), size):
                named += names.view(np.int64).tolist()
                made += [_ordered(h, of_slot.value).tobytes() for h in each]
            return [pa.array(named, pa.int64()), pa.array(made, pa.binary())]

        # Rows of the same id may have other sets.
        found = over_batches(
            texts.join(wanted, "key"), lambda: work, ["node", "n", "need", "to"], "named long, held binary"
        )
        return found.where("named = node")

    likely = _compared(pairs, classes, heads, lambda x, y, facts: prefixes_share_enough(x, y, facts, percent))
    likely = _stored(likely.distinct(), "ngram-likely")
    found = _compared(likely, classes, full, lambda x, y, facts: sets_link(x, y, percent))
    return found.select(F.col("hub").alias("a"), F.col("node").alias("b"))


def _stored(frame: DataFrame, purpose: str) -> DataFrame:
    path = new_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


# --- the join ----------------------------------------------------------------------


def _components(docs: DataFrame, signed: DataFrame, of_slot: Broadcast, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The classes (node, doc, n, need), and node and root of all but the components' roots."""
    classes = _stored(
        signed.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("doc"), F.min("n").alias("n"), F.min("need").alias("need")
        ),
        "ngram-classes",
    )
    lists = _stored(_lists(_postings(signed), percent), "ngram-lists")
    pairs = lists.where("first is not null").select("node", F.col("first").alias("hub")).distinct()
    pairs = _stored(pairs, "ngram-pairs")
    found = _stored(components(_linked(pairs, docs, signed, classes, of_slot, size, percent)), "ngram-components")

    # Lists of several components, in blocks.
    named = lists.join(found, "node", "left").select(
        "key", "node", "place", F.coalesce("root", "node").alias("part")
    )
    named = _stored(named, "ngram-named")
    several = named.groupBy("key").agg(
        F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("size")
    )
    several = _stored(several.where("low != high").select("key", "size"), "ngram-several")
    rows = named.join(several, "key")
    blocks = F.ceil(F.col("size") / F.lit(float(BLOCK))).cast("int")
    rows = (
        rows.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(
            F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("group"),
            (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "place", "part",
        )
    )
    more = _cross(rows, percent).distinct().select(F.col("a").alias("hub"), F.col("b").alias("node"))
    more = _stored(more, "ngram-pairs")
    if more.isEmpty():
        return classes, found
    edges = _linked(more, docs, signed, classes, of_slot, size, percent)
    return classes, components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(edges))


def join(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, ``n_shingles`` and ``component_id`` of every row of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"))
    of_slot = spark.sparkContext.broadcast(frequency_classes(_counts(texts, size)))
    signed = _stored(_signed(docs, size, percent, of_slot), "ngram-signed")
    classes, found = _components(docs, signed, of_slot, size, percent)
    found = _stored(found, "ngram-components")
    rooted = classes.select("node", "doc").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = _stored(rooted.join(names, "root").select("node", "component_id"), "ngram-names")
    return signed.select("doc_id", "n", "node").join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
