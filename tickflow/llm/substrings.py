"""Substring dedup: remove every word covered by a window of ``window`` words whose
sequence also starts anywhere else, in another document or the same one.

The words of all documents are a De Bruijn graph of token k-mers, thinned out. Of each
window only the k-mer with the smallest hash matters (ties: all of them); those k-mers are
the nodes, about one in thirteen words, and the words from one to the next in a document
are an edge. Equal windows have the same smallest k-mer at the same place, so a window
can be repeated only if that node is.

1. Nodes are counted over all documents, together with whether their edges to the next
   and to the previous node are the same at every occurrence. Counts are summed per task
   before the shuffle.
2. A join gives the repeated nodes their places back, and the places go to the documents.
   An edge whose start always goes on the same way, and whose end always comes from the
   same way, branches nowhere. Runs of such edges are compacted to one path; all its
   occurrences are whole, since each node of it only occurs in it. What a path covers is
   repeated, if it is a window long, and its windows occur nowhere but in it.
3. Windows around a repeated node that leave its path are verified one by one: their
   hashes are counted over all documents, and the repeated ones go back to their source
   coordinates.

Only step 3 touches single windows, where copies begin, end or differ. Texts are shuffled
once, to meet the places of their nodes, and once more where windows were verified.
Sequences are compared by 64-bit hashes of all their words. A passage in a third of all
documents is a row per task in the counts, and its places are split by the skew join.

Null and empty texts have no words. Rows are occurrences of their own, so repeated rows
lose all that is long enough; rows are told apart by doc_id (null is an id) and text. An
empty table gives an empty result. All columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickflow.llm.words import PLAIN, POWERS, Tokens, mix, over_batches, token_chunks
from tickflow.scratch import new_folder

# Words in a node.
K = 8


class Graph:
    """The nodes, edges and windows of some rows."""

    def __init__(self, found: Tokens, window: int):
        self.found, self.window = found, window
        self.k = min(K, window)
        n = len(found.hash)
        self.powers = POWERS.upto(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(found.hash * self.powers.up[:n], out=self.sums[1:])
        self.end = np.repeat(found.bounds[1:], found.counts)
        starts = np.arange(n)
        self.whole = starts + window <= self.end
        # Node hashes, and the smallest of every window.
        node = np.full(n, np.iinfo(np.uint64).max)
        at = np.flatnonzero(starts + self.k <= self.end)
        node[at] = self.span(at, at + self.k)
        self.node = node
        reach = window - self.k + 1
        self.least = np.where(self.whole, _sliding(node, reach, np.minimum), np.uint64(0))
        # A node is kept if it is the smallest of a window that it lies in.
        padded = np.concatenate([np.zeros(reach - 1, np.uint64), self.least])
        most = _sliding(padded, reach, np.maximum)[:n]
        self.places = np.flatnonzero((most == node) & (most > 0))

    def span(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the words from ``first`` up to ``last``."""
        total = (self.sums[last] - self.sums[first]) * self.powers.down[first]
        return mix(total + mix((last - first).astype(np.uint64)))

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """For each place the hash of the edge that begins there, and if there is one."""
        at = self.places
        following = np.zeros(len(at), np.uint64)
        linked = np.zeros(len(at), bool)
        if len(at) > 1:
            linked[:-1] = self.end[at[:-1]] == self.end[at[1:]]
            i = np.flatnonzero(linked)
            following[i] = self.span(at[i], at[i + 1] + self.k)
        return following, linked


def _sliding(x: np.ndarray, reach: int, best) -> np.ndarray:
    """best of x[i : i + reach], as far as x goes."""
    out, covered = x.copy(), 1
    while covered < reach:
        step = min(covered, reach - covered)
        if step < len(out):
            out[:-step] = best(out[:-step], out[step:])
        covered += step
    return out


def _nodes(docs: DataFrame, window: int, edges: bool) -> DataFrame:
    """A row per node place: ``node``, and its edges (``following``, ``leading``) or its
    place (``doc``, ``print``, ``pos``)."""
    fields = "node long, following long, leading long" if edges else "node long, doc long, print long, pos int"
    names = [f.split(" ")[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, found in token_chunks(batch.column("text"), PLAIN):
                graph = Graph(found, window)
                at = graph.places
                node = pa.array(graph.node[at].view(np.int64))
                if edges:
                    following, linked = graph.edges()
                    leading = np.concatenate([[np.uint64(0)], following[:-1]]) if len(at) else following
                    first = ~np.concatenate([[False], linked[:-1]]) if len(at) else linked
                    columns = [
                        pa.array(following.view(np.int64), mask=~linked),
                        pa.array(leading.view(np.int64), mask=first),
                    ]
                else:
                    rows = row + np.searchsorted(found.bounds, at, "right") - 1
                    pos = (at - found.bounds[rows - row]).astype(np.int32)
                    take = pa.array(rows)
                    columns = [batch.column("doc").take(take), batch.column("print").take(take), pa.array(pos)]
                yield pa.RecordBatch.from_arrays([node, *columns], names)

    return docs.mapInArrow(run, fields)


def _paths(graph: Graph, a: int, b: int, at: np.ndarray, right: np.ndarray, left: np.ndarray):
    """Of the row with words a to b, whose repeated nodes are at ``at`` (in the row, in
    order) with the flags that their edges never vary: which words the paths cover, and
    the windows that leave the path of their node."""
    covered = np.zeros(b - a, bool)
    if not len(at):
        return covered, at
    places = graph.places[np.searchsorted(graph.places, a) : np.searchsorted(graph.places, b)] - a
    index = np.searchsorted(places, at)
    joined = (index[1:] == index[:-1] + 1) & right[:-1] & left[1:]
    first = np.flatnonzero(np.concatenate([[True], ~joined]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    start, end = at[first], at[last] + graph.k
    long = end - start >= graph.window
    for x, y in zip(start[long], end[long], strict=True):
        covered[x:y] = True
    # Windows of each repeated node that is their smallest, outside of its path.
    path = np.repeat(np.arange(len(first)), last - first + 1)
    reach = graph.window - graph.k + 1
    offsets = np.arange(-reach + 1, 1)
    windows = at[:, None] + offsets[None, :]
    inside = (windows >= start[path][:, None]) & (windows + graph.window <= end[path][:, None])
    possible = (windows >= 0) & (windows + graph.window <= b - a) & ~inside
    w, owner = windows[possible], np.broadcast_to(at[:, None], windows.shape)[possible]
    own = graph.least[a + w] == graph.node[a + owner]
    return covered, np.unique(w[own])


def _runs(covered: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()


def _kept(found: Tokens, raw: bytes, a: int, covered: np.ndarray, digest: bool) -> str:
    """The row's words that are not covered, joined by one space; the row begins at word a."""
    left = np.flatnonzero(~covered) + a
    start, end = found.start[left].tolist(), found.end[left].tolist()
    words = b" ".join([raw[x:y] for x, y in zip(start, end, strict=True)])
    return hashlib.sha256(words).hexdigest() if digest else words.decode("utf-8")


SPANS = "array<struct<first: int, last: int>>"
WINDOWS = "array<struct<hash: bigint, pos: int>>"


def _traced(frame: DataFrame, window: int, digest: bool) -> DataFrame:
    """Step 2 for documents with their repeated nodes (``nodes``): the result if nothing
    is left to verify, else the windows to verify, with what is covered already."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        nodes = batch.column("nodes")
        flat, bounds = nodes.values, nodes.offsets.to_numpy()
        pos, right, left = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("pos", "right", "left"))
        total, removed, kept, spans, asked = [], [], [], [], []
        for row, found in token_chunks(batch.column("text"), PLAIN):
            graph = Graph(found, window)
            raw = found.data.tobytes()
            for r in range(len(found.bounds) - 1):
                a, b = int(found.bounds[r]), int(found.bounds[r + 1])
                x, y = bounds[row + r], bounds[row + r + 1]
                order = np.argsort(pos[x:y])
                covered, windows = _paths(graph, a, b, pos[x:y][order].astype(np.int64), right[x:y][order], left[x:y][order])
                total.append(b - a)
                removed.append(int(covered.sum()))
                first, last = _runs(covered)
                spans.append([{"first": f, "last": g} for f, g in zip(first, last, strict=True)])
                hashes = graph.span(a + windows, a + windows + window).view(np.int64).tolist()
                asked.append([{"hash": h, "pos": p} for h, p in zip(hashes, windows.tolist(), strict=True)])
                kept.append(_kept(found, raw, a, covered, digest))
        span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        asks = pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int32())]))
        return [
            pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
            pa.array(spans, span), pa.array(asked, asks),
        ]

    fields = f"n_words long, n_removed long, kept string, spans {SPANS}, windows {WINDOWS}"
    return over_batches(frame, lambda: work, ["id", "doc", "print", "text"], fields)


def _verified(frame: DataFrame, window: int, digest: bool) -> DataFrame:
    """Step 3's end: cover the verified windows (``found``, positions) as well."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        spans, found_at = batch.column("spans").to_pylist(), batch.column("found").to_pylist()
        removed, kept = [], []
        for row, found in token_chunks(batch.column("text"), PLAIN):
            raw = found.data.tobytes()
            for r in range(len(found.bounds) - 1):
                a, b = int(found.bounds[r]), int(found.bounds[r + 1])
                covered = np.zeros(b - a, bool)
                for s in spans[row + r]:
                    covered[s["first"] : s["last"]] = True
                for p in found_at[row + r]:
                    covered[p : p + window] = True
                removed.append(int(covered.sum()))
                kept.append(_kept(found, raw, a, covered, digest))
        return [pa.array(removed, pa.int64()), pa.array(kept, pa.string())]

    return over_batches(frame, lambda: work, ["id", "n_words"], "n_removed long, kept string")


def _stored(frame: DataFrame, purpose: str) -> DataFrame:
    path = new_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def remove(docs: DataFrame, window: int = 35, digest: bool = False, columns: tuple[str, ...] = ()) -> DataFrame:
    """For every row of ``docs``: ``doc`` (its ``columns``, all by default), ``n_words``,
    ``n_removed`` and ``kept``, the words that are left, joined by one space (or, with
    ``digest``, the lowercase hex SHA-256 of that)."""
    texts = docs.select(
        F.struct(*(columns or ("*",))).alias("id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("print", F.xxhash64("text"))

    counted = _nodes(texts.select("text"), window, edges=True).groupBy("node").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("following").alias("n_f"), F.min("following").alias("low_f"), F.max("following").alias("high_f"),
        F.count("leading").alias("n_l"), F.min("leading").alias("low_l"), F.max("leading").alias("high_l"),
    )
    never = lambda s: F.coalesce(
        (F.col(f"n_{s}") == F.col("n")) & (F.col(f"low_{s}") == F.col(f"high_{s}")), F.lit(False)
    )
    repeated = _stored(
        counted.where("n > 1").select("node", never("f").alias("right"), never("l").alias("left")), "sub-nodes"
    )
    placed = _nodes(texts.select("doc", "print", "text"), window, edges=False).join(repeated, "node")
    of = (
        placed.groupBy(F.col("doc").alias("_doc"), F.col("print").alias("_print"))
        .agg(F.collect_set(F.struct("pos", "right", "left")).alias("nodes"))
    )
    none = F.expr("cast(array() as array<struct<pos: int, right: boolean, left: boolean>>)")
    met = texts.join(of, (F.col("doc") == F.col("_doc")) & (F.col("print") == F.col("_print")), "left")
    traced = _traced(
        met.select("id", "doc", "print", "text", F.coalesce("nodes", none).alias("nodes")), window, digest
    )
    # A text that is done is not needed again.
    ready = F.size("windows") == 0
    traced = _stored(traced.withColumn("text", F.when(~ready, F.col("text"))), "sub-traced")

    done = traced.where(ready).select("id", "n_words", "n_removed", "kept")
    asked = traced.where(~ready).select("doc", "print", F.explode("windows").alias("w")).select(
        "doc", "print", "w.hash", "w.pos"
    )
    twice = _stored(asked.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "sub-windows")
    found = (
        asked.join(twice, "hash")
        .groupBy(F.col("doc").alias("_doc"), F.col("print").alias("_print"))
        .agg(F.collect_set("pos").alias("found"))
    )
    rest = traced.where(~ready).drop("windows").join(
        found, (F.col("doc") == F.col("_doc")) & (F.col("print") == F.col("_print")), "left"
    )
    rest = _verified(
        rest.select("id", "text", "n_words", "spans", F.coalesce("found", F.expr("cast(array() as array<int>)")).alias("found")),
        window, digest,
    )
    return done.union(rest).withColumnRenamed("id", "doc")
