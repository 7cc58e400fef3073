"""Near-duplicate documents by MinHash and an LSH forest.

A document's set is its distinct word shingles (A-Z as a-z); a text with fewer words is
one shingle, and one without words has an empty set and is linked with nothing. Documents
with a set similarity (intersection over union) of at least ``percent`` are linked, and
linked documents, directly or through others, are one component.

1. Every set becomes ``HASHES`` minimum hashes. Equal sets are one class; only classes go
   on, so copies cost one row each however many there are.
2. The signature is put in ``TREES`` cyclic orders, each starting at another hash; an order
   is a prefix tree of the classes. Classes that share a prefix of ``DEPTH`` hashes are a
   region: their longest common prefixes are the longest around. Sets with a similarity of
   0.85 share a region in one of 16 trees but for seven pairs in a million.
3. Depth adapts to each region: where more than ``CROWDED`` classes share a prefix, they
   go on to longer prefixes. In each region that is small enough, whole signatures are
   compared and a spanning forest of the likely pairs becomes candidates; in a crowded
   one, each class with the region's smallest.
4. Candidates are confirmed on full sets, and linked classes become components.
5. Regions (at ``DEPTH``) that still hold several components are gone through once more,
   all classes of one component with those of others, in blocks of ``CROWDED`` by
   ``CROWDED`` that are spread over the tasks and carry the full sets. Likely pairs are
   confirmed there, in the first tree that both share, and only links that hold components
   together come out. So no region's size drops a pair, and what comes out grows with the
   classes, not with their pairs.

Likely: at least ``LIKELY`` of the hashes agree (at a similarity of 0.85, all but about
two pairs in a million). No task holds more than two blocks; a class in very many pairs
is split by the skew join.

Null doc_ids stay rows of their own; a component is named by its smallest doc_id (null if
it has none). Repeated rows are copies. An empty table gives an empty result. Only doc_id
and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickflow.llm.components import components
from tickflow.llm.words import LOWER, Tokens, mix, over_batches, token_chunks
from tickflow.scratch import new_folder

TREES, DEPTH = 16, 4
HASHES = TREES * DEPTH
DEEPER = (8, 16, 32)
CROWDED = 256
LIKELY = 40
# At most this many ids (8 bytes each) are broadcast to pick out documents.
BROADCAST_ROWS = 1_000_000
NO_ID = -(2**63)

_FACTORS = (mix(np.arange(1, HASHES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (mix(np.arange(1001, HASHES + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


# --- sets and signatures -----------------------------------------------------------


def shingles(found: Tokens, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in the order of the text, and their bounds by row."""
    hashes, start = found.grams(size)
    short = np.flatnonzero((found.counts > 0) & (found.counts < size))
    if len(short):
        whole = np.array([
            mix(np.array([_sequence(found.hash[found.bounds[r] : found.bounds[r + 1]])], np.uint64))[0]
            for r in short
        ], np.uint64)
        hashes = np.concatenate([hashes, whole])
        start = np.concatenate([start, found.bounds[short]])
        order = np.argsort(start, kind="stable")
        hashes, start = hashes[order], start[order]
    return hashes, np.searchsorted(start, found.bounds)


def _sequence(hashes: np.ndarray) -> np.uint64:
    total = np.uint64(len(hashes))
    with np.errstate(over="ignore"):
        for h in hashes:
            total = total * np.uint64(0x9FB21C651E98DF25) + h
    return total


def sets(texts: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """First row, every row's set as sorted hashes, and the name of the set (0: empty)."""
    for row, found in token_chunks(texts, LOWER):
        hashes, bounds = shingles(found, size)
        each = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            h = np.sort(hashes[a:b])
            each.append(h[np.concatenate([[True], h[1:] != h[:-1]])] if b > a else h)
        sizes = np.array([len(h) for h in each])
        ends = np.cumsum(sizes)
        every = np.concatenate(each) if len(each) else hashes[:0]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(every + np.uint64(77)))])
        names = mix((sums[ends] - sums[ends - sizes]) + mix(sizes.astype(np.uint64)))
        yield row, each, np.where(sizes > 0, names, np.uint64(0))


def signatures(each: list[np.ndarray]) -> np.ndarray:
    """The minimum hashes of non-empty sets, one row per set."""
    bounds = np.cumsum([0, *[len(h) for h in each]])[:-1]
    x = (np.concatenate(each) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(each), HASHES), np.uint32)
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat(x * _FACTORS[i] + _SHIFTS[i], bounds)
    return out


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, print (hash of the text), n (shingles), node (the set's name, null if empty)
    and its signature."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        n, node, sig = [], [], []
        for _, each, names in sets(batch.column("text"), size):
            full = [i for i, h in enumerate(each) if len(h)]
            made = signatures([each[i] for i in full]) if full else []
            sig_of = dict(zip(full, made, strict=True))
            n += [len(h) for h in each]
            node += [int(names[i].view(np.int64)) if i in sig_of else None for i in range(len(each))]
            sig += [sig_of[i].astype(">u4").tobytes() if i in sig_of else None for i in range(len(each))]
        return [pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sig, pa.binary())]

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _print(F.col("text")).alias("print"),
        F.col("text").cast("string").alias("text"),
    )
    return over_batches(texts, lambda: work, ["doc_id", "print"], "n long, node long, sig binary")


def _print(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


# --- regions -----------------------------------------------------------------------


def _prefix(tree: Column, depth: int) -> Column:
    """A hash of the first ``depth`` hashes of the signature, read from the tree's place on."""
    turned = F.concat("sig", "sig")
    return F.xxhash64(tree, F.lit(depth), F.substr(turned, tree * (4 * DEPTH) + 1, F.lit(4 * depth)))


def _sized(rows: DataFrame) -> DataFrame:
    """Rows (region, node, tree) of regions with two classes or more, with their number
    and the smallest class."""
    crowds = rows.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("least"))
    # Written plainly: a join of two shuffled sides can split a region of many classes.
    return rows.join(_stored(crowds.where("size > 1"), "near-crowds"), "region")


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many hashes agree, for all rows of x with all of y."""
    if len(x) * len(y) <= 64:
        return (x[:, None, :] == y[None, :, :]).sum(axis=2, dtype=np.uint8)
    same = np.zeros((len(x), len(y)), np.uint8)
    for i in range(x.shape[1]):
        same += x[:, i, None] == y[None, :, i]
    return same


def _spanning(node: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Likely pairs of a region that hold it together, best first."""
    agree = _agreement(sig, sig)
    a, b = np.nonzero(np.triu(agree >= LIKELY, 1))
    order = np.argsort(-agree[a, b].astype(np.int16), kind="stable")
    root = np.arange(len(node))
    kept = []
    for i, j in zip(a[order].tolist(), b[order].tolist(), strict=True):
        x, y = root[i], root[j]
        if x != y:
            root[root == y] = x
            kept.append((i, j))
            if len(kept) == len(node) - 1:
                break
    left, right = (np.array(k, np.int64) for k in (zip(*kept, strict=True) if kept else ([], [])))
    return node[left], node[right]


def _candidates(rows: DataFrame) -> DataFrame:
    """Distinct pairs a < b that hold the regions of ``rows`` (region, node, sig) together.
    A region has at most ``CROWDED`` rows."""

    def pairs(region: np.ndarray, node: np.ndarray, sig: np.ndarray) -> pa.RecordBatch:
        cuts = np.concatenate([[0], np.flatnonzero(region[1:] != region[:-1]) + 1, [len(region)]])
        found = [_spanning(node[a:b], sig[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        left, right = (np.concatenate(x) for x in zip(*found, strict=True))
        keys = np.unique(np.column_stack([np.minimum(left, right), np.maximum(left, right)]), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not len(batch):
                continue
            here = [batch.column(c).to_numpy() for c in ("region", "node")] + [_signature_rows(batch)]
            if rest is not None:
                here = [np.concatenate(x) for x in zip(rest, here, strict=True)]
            # The last region may go on in the next batch.
            cut = int(np.searchsorted(here[0], here[0][-1]))
            if cut:
                yield pairs(*[x[:cut] for x in here])
            rest = [x[cut:] for x in here]
        if rest is not None:
            yield pairs(*rest)

    laid = rows.select("region", "node", "sig").repartition("region").sortWithinPartitions("region", "node")
    return laid.mapInArrow(run, "a long, b long").distinct()


def _signature_rows(batch: pa.RecordBatch) -> np.ndarray:
    raw = b"".join(batch.column("sig").to_pylist())
    return np.frombuffer(raw, np.uint32).reshape(len(batch), HASHES)


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets of sorted hashes are similar enough."""
    both = np.sort(np.concatenate([x, y]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _cross_links(group: pa.RecordBatch, percent: int) -> list[tuple[int, int]]:
    """Links between different components of a pair of blocks (or within the one), as few
    as hold them together. Each pair is looked at in the first tree it shares."""
    node, part, side = (group.column(c).to_numpy() for c in ("node", "part", "side"))
    if (part == part[0]).all():
        return []
    tree, sig = group.column("tree")[0].as_py(), _signature_rows(group)
    x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(y):
        y = x
    agree = _agreement(sig[x], sig[y])
    a, b = np.nonzero((agree >= LIKELY) & (part[x][:, None] != part[y][None, :]))
    order = np.argsort(-agree[a, b].astype(np.int16), kind="stable")
    a, b = x[a[order]], y[b[order]]
    root = np.unique(part, return_inverse=True)[1]
    full = [np.frombuffer(v.as_buffer(), np.uint64) for v in group.column("set")]
    out = []
    for at in range(0, len(a), 4096):
        i, j = a[at : at + 4096], b[at : at + 4096]
        earlier = (sig[i, : DEPTH * tree] == sig[j, : DEPTH * tree]).reshape(len(i), tree, DEPTH).all(axis=2).any(axis=1)
        for p, q in zip(i[~earlier].tolist(), j[~earlier].tolist(), strict=True):
            if root[p] != root[q] and _similar(full[p], full[q], percent):
                root[root == root[p]] = root[q]
                out.append((int(node[p]), int(node[q])))
    return out


def _links(rows: DataFrame, percent: int) -> DataFrame:
    """The links in all groups (``region``) of ``rows`` (region, tree, node, part, side,
    sig, set). A group has at most two blocks of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.RecordBatch] = []

        def links() -> pa.RecordBatch:
            group = pa.Table.from_batches(open_).combine_chunks().to_batches()[0]
            found = _cross_links(group, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

        for batch in batches:
            if not len(batch):
                continue
            region = batch.column("region").to_numpy()
            if open_ and open_[0].column("region")[0].as_py() != region[0]:
                yield links()
                open_ = []
            cuts = [0, *(np.flatnonzero(region[1:] != region[:-1]) + 1).tolist(), len(region)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                open_.append(batch.slice(a, b - a))
                if b < len(region):
                    yield links()
                    open_ = []
        if open_:
            yield links()

    laid = rows.repartition("region").sortWithinPartitions("region", "side", "node")
    return laid.mapInArrow(run, "a long, b long").distinct()


# --- confirmation ------------------------------------------------------------------


def _confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets (node, set) are similar enough."""
    left = full.withColumnsRenamed({"node": "a", "set": "set_a"})
    right = full.withColumnsRenamed({"node": "b", "set": "set_b"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("set_a"), batch.column("set_b"), strict=True)
            keep = [
                _similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                for x, y in both
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _full_sets(docs: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """node and set (sorted 64-bit hashes) of the classes in ``needed`` (node, doc)."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    ids = needed.select(F.coalesce("doc", F.lit(NO_ID)).alias("key")).distinct()
    n = ids.limit(BROADCAST_ROWS + 1).count()
    texts = docs.select(key.alias("key"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(ids) if n <= BROADCAST_ROWS else ids, "key", "left_semi")

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        node, made = [], []
        for _, each, names in sets(batch.column("text"), size):
            node += names.view(np.int64).tolist()
            made += [h.tobytes() for h in each]
        return [pa.array(node, pa.int64()), pa.array(made, pa.binary())]

    found = over_batches(texts, lambda: work, [], "node long, set binary")
    # Rows of the same id may have other sets; copies have the same one.
    return found.join(needed.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _stored(frame: DataFrame, purpose: str) -> DataFrame:
    path = new_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _rooted(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and the classes: node, smallest doc and the root of the component."""
    signed = _stored(_signed(docs, size), "near-signatures")
    classes = _stored(
        signed.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("doc"), F.min("sig").alias("sig")
        ),
        "near-classes",
    )

    # Prefix trees: one row per class and tree, then longer prefixes where it is crowded.
    trees = classes.select("node", "sig", F.explode(F.array(*[F.lit(t) for t in range(TREES)])).alias("tree"))
    first = _stored(
        _sized(trees.select(_prefix(F.col("tree"), DEPTH).alias("region"), "node", "tree")), "near-regions"
    )
    small = [first.where(F.col("size") <= CROWDED).select("region", "node")]
    stars = []
    crowded = first.where(F.col("size") > CROWDED)
    for depth in DEEPER:
        if crowded.isEmpty():
            break
        stars.append(crowded.select(F.col("least").alias("a"), F.col("node").alias("b")))
        deeper = crowded.select("node", "tree").join(classes.select("node", "sig"), "node")
        sized = _stored(
            _sized(deeper.select(_prefix(F.col("tree"), depth).alias("region"), "node", "tree")), "near-regions"
        )
        small.append(sized.where(F.col("size") <= CROWDED).select("region", "node"))
        crowded = sized.where(F.col("size") > CROWDED)
    stars.append(crowded.select(F.col("least").alias("a"), F.col("node").alias("b")))

    rows = small[0]
    for more in small[1:]:
        rows = rows.union(more)
    candidates = _candidates(rows.join(classes.select("node", "sig"), "node"))
    for star in stars:
        candidates = candidates.union(star.where("a != b"))
    candidates = _stored(candidates.distinct(), "near-candidates")
    nodes = candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    full = _named_sets(docs, classes, nodes, size)
    found = _stored(components(_stored(_confirmed(candidates, full, percent), "near-links")), "near-components")

    # Regions with several components, in blocks.
    named = first.join(found, "node", "left").select(
        "region", "tree", "node", "size", F.coalesce("root", "node").alias("part")
    )
    several = _stored(
        named.groupBy("region").agg(F.min("part").alias("low"), F.max("part").alias("high"))
        .where("low != high").select("region"),
        "near-several",
    )
    several = _stored(named.join(several, "region"), "near-several")
    if not several.isEmpty():
        blocks = F.ceil(F.col("size") / F.lit(float(CROWDED))).cast("int")
        block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        rest = (
            several.withColumn("blocks", blocks)
            .withColumn("block", block)
            .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            .select(
                F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other")).alias("region"),
                "tree", "node", "part",
                (F.col("block") > F.col("other")).cast("int").alias("side"),
            )
        )
        full = _named_sets(docs, classes, several.select("node").distinct(), size)
        held = full.join(classes.select("node", "sig"), "node")
        more = _links(rest.join(held, "node"), percent)
        found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))

    rooted = classes.select("node", "doc").join(found, "node", "left")
    return signed, rooted.withColumn("root", F.coalesce("root", "node"))


def group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, ``n_shingles`` and ``component_id`` of every row of ``docs``."""
    signed, rooted = _rooted(docs, size, percent)
    # Names: the smallest doc_id of all classes in a component.
    names = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = _stored(rooted.join(names, "root").select("node", "component_id"), "near-names")
    return signed.select("doc_id", "n", "node").join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _named_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    needed = _stored(classes.select("node", "doc").join(nodes, "node"), "near-needed")
    return _stored(_full_sets(docs, needed, size), "near-sets")


def drop_copies(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every component: of those with the smallest doc_id (nulls
    last) the one with the smallest hash of the text, and of repeated rows one. Rows without
    words stay."""
    signed, rooted = _rooted(docs, size, percent)
    roots = _stored(rooted.select("node", "root"), "near-roots")
    members = _stored(
        signed.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_key"), F.col("print").alias("_print"), "node")
        .join(roots, "node").groupBy("root", "_key", "_print").agg(F.count(F.lit(1)).alias("n")),
        "near-members",
    )
    first = F.min(F.struct((F.col("_key") == NO_ID).alias("no_id"), "_key", "_print")).alias("first")
    first = _stored(members.groupBy("root").agg(first).select("first._key", "first._print"), "near-first")
    marked = _stored(
        members.join(first.withColumn("_first", F.lit(True)), ["_key", "_print"], "left")
        .where("_first is null or n > 1")
        .select("_key", "_print", F.coalesce("_first", F.lit(False)).alias("_repeated")),
        "near-marked",
    )
    rows = docs.select(F.struct("*").alias("doc")).select(
        "doc",
        F.coalesce(F.col("doc.doc_id").cast("long"), F.lit(NO_ID)).alias("_key"),
        _print(F.col("doc.text")).alias("_print"),
    )
    if marked.where("_repeated").isEmpty():
        return rows.join(marked, ["_key", "_print"], "left_anti").select("doc.*")
    rows = rows.join(marked, ["_key", "_print"], "left")
    one = F.min_by("doc", F.xxhash64(F.to_json("doc"))).alias("doc")
    repeated = rows.where("_repeated").groupBy("_key", "_print").agg(one)
    return rows.where("_repeated is null").select("doc.*").union(repeated.select("doc.*"))
