"""Source divergence, vector codes and the n-gram join, beside plain-Python versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import tickflow.llm.divergence as divergence
import tickflow.llm.ngram_join as ngram_join
from llm_tables import LOWER, documents, edge_rows, near_components, prose
from tickflow.llm import vector_codes

# --- divergence --------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_audit(rows, least_docs, most):
    said = [((r[2] or ""), (r[3] or ""), Counter(TERM.findall((r[1] or "").translate(LOWER)))) for r in rows]
    out = []
    for lang in {lang for lang, _, _ in said}:
        here = [(s, c) for g, s, c in said if g == lang]
        in_docs, whole, groups = Counter(), Counter(), defaultdict(Counter)
        for source, counts in here:
            in_docs.update(counts.keys())
            groups[source].update(counts)
        kept = sorted((t for t, n in in_docs.items() if n >= least_docs), key=str.encode)
        for counts in groups.values():
            whole.update({t: counts[t] for t in kept})

        def priced(counts, kept=kept):
            n = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // n for t in kept}

        def value(p, q):
            return (p - q) ** 2 // (p + q)

        q = priced(whole)
        p = {source: priced(counts) for source, counts in groups.items()}
        for source, counts in groups.items():
            pairs = [(sum(value(p[source][t], p[o][t]) for t in kept), o) for o in groups if o != source]
            terms = [(value(p[source][t], q[t]), t) for t in kept if counts[t] and p[source][t] > q[t]]
            for part, found, upto in (("pair", pairs, None), ("term", terms, most)):
                best = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:upto]
                out += [(lang, source, part, item, v, i + 1) for i, (v, item) in enumerate(best)]
    return Counter(out)


@pytest.mark.parametrize("slice_bytes, held", [(64 << 20, 4_000_000), (2_000, 50)])
def test_audit(spark, monkeypatch, slice_bytes, held):
    """In one slice and task, and in many slices and parts of tasks."""
    monkeypatch.setattr(divergence, "HELD", held)
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "abcdé日" for b in ("x", "Yz", "é", "ß", "q")] + ["Zulu", "ZULU", "zulu"]
    rows = edge_rows()
    for i in range(60):
        text = " ".join(rng.choice(vocabulary[: 5 + i % 28]) for _ in range(rng.randrange(40)))
        rows.append((100 + i, f"{text} 12{text}-{text}", rng.choice(["en", "fr", "", None]), rng.choice("abc"), 0))
    rows += [(200, "alone", "xx", "only", 0), (201, None, "yy", "p", 0), (202, "", "yy", "q", 0)]
    frame = documents(spark, rows).repartition(5)
    got = divergence.audit(frame, least_docs=3, most=4, slice_bytes=slice_bytes)
    assert Counter(tuple(r) for r in got.collect()) == plain_audit(rows, 3, 4)


def test_audit_of_one_hot_source(spark):
    rows = [(i, "common words here and there", "en", "hot", 0) for i in range(500)]
    rows += [(1000 + i, "common other things", "en", f"s{i % 3}", 0) for i in range(40)]
    got = divergence.audit(documents(spark, rows), 10, 10)
    assert Counter(tuple(r) for r in got.collect()) == plain_audit(rows, 10, 10)


def test_audit_of_nothing(spark):
    assert divergence.audit(documents(spark, [])).count() == 0


def test_prices_of_huge_counts_are_exact():
    counts = np.array([0, 1, 10**12 - 1, 10**13], np.int64)
    n, v = 3 * 10**13 + 7, 10**8 + 1
    want = [1 + 10**9 * (int(c) + 2) // (n + 2 * v) for c in counts]
    assert divergence.price(counts, n, v).tolist() == want


def test_pairs_price_every_term_both_ways():
    rng = np.random.default_rng(3)
    for _ in range(30):
        terms = int(rng.integers(0, 40))
        sides = []
        for _ in range(2):
            ids = np.sort(rng.choice(terms, int(rng.integers(0, terms + 1)), replace=False)).astype(np.int32)
            sides.append((ids, rng.integers(1, 9, len(ids))))
        n = tuple(int(c.sum()) + 3 for _, c in sides)
        v = terms + 5
        dense = []
        for (ids, counts), total in zip(sides, n, strict=True):
            every = np.zeros(terms, np.int64)
            every[ids] = counts
            dense.append(divergence.price(every, total, v))
        want = int(divergence.apart(*dense).sum())
        assert divergence.pair_value(sides[0], sides[1], n, v, terms) == want
        assert divergence.pair_value(sides[1], sides[0], n[::-1], v, terms) == want


# --- vector codes ------------------------------------------------------------------


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Codes, errors, label errors and the codebooks' hash, by full scans."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return Counter(), None
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    cuts = [slice(i * size // parts, (i + 1) * size // parts) for i in range(parts)]
    units = [[int(np.floor(4096 * np.float64(x))) for x in r[1]] for r in kept]
    books = [[u[c] for u in units[:entries]] for c in cuts]

    def nearest(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for j, cut in enumerate(cuts):
            members = defaultdict(list)
            for u in units:
                members[nearest(books[j], u[cut])[1]].append(u[cut])
            books[j] = [
                [sum(x) // len(x) for x in zip(*members[i], strict=True)] if i in members else e
                for i, e in enumerate(books[j])
            ]
    text = ",".join(str(x) for book in books for e in book for x in e)
    printed = hashlib.sha256(text.encode()).hexdigest()
    out, by_label = [], Counter()
    for r, u in zip(kept, units, strict=True):
        found = [nearest(books[j], u[cut]) for j, cut in enumerate(cuts)]
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), r[2]))
        by_label[r[2]] += out[-1][2]
    return Counter((*o[:3], by_label[o[3]]) for o in out), printed


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "1 as units", "2 as code", "'x' as distance", "4 as error", "5 as label_error"
    )


def vector_rows(seed, n, size):
    rng = random.Random(seed)
    # Few different values, so that many distances are equal.
    rows = [(i, [np.float32(rng.randrange(-8, 8) / 4096).item() for _ in range(size)], rng.choice([0, 1, None])) for i in range(n)]
    rows += [(n + i, rows[3][1], 7) for i in range(n)]
    rows += [
        (-5, None, 0), (-4, [float("nan")] * size, 0), (-3, [1.0] * (size - 1) + [None], 0),
        (-2, [float("inf")] + [0.0] * (size - 1), 0), (None, rows[0][1], 1), (2, rows[1][1], 1), (2, rows[1][1], 1),
        (9_999, [0.5] * (size + 1), 0), (9_998, [], 0),
    ]
    return rows


@pytest.mark.parametrize("size, n, entries", [(64, 120, 16), (16, 300, 5), (11, 60, 16), (3, 40, 4), (8, 6, 16)])
def test_codes(spark, size, n, entries):
    rows = vector_rows(size + n, n, size)
    codes, books = vector_codes.encode(vectors(spark, rows).repartition(3), entries=entries)
    got = vector_codes.with_label_errors(codes).withColumn("code", F.lower(F.hex("code")))
    want, printed = plain_codes(rows, entries=entries)
    assert Counter(tuple(r) for r in got.select("vec_id", "code", "error", "label_error").collect()) == want
    assert vector_codes.fingerprint(books) == printed


def test_codes_of_nothing(spark):
    for rows in ([], [(1, None, 0)], [(1, [float("nan")], None)]):
        codes, _ = vector_codes.encode(vectors(spark, rows))
        assert vector_codes.with_label_errors(codes).count() == 0


def test_huge_components_are_clamped(spark):
    rows = [(i, [3e38 * (-1) ** i] * 8, 0) for i in range(4)]
    codes, _ = vector_codes.encode(vectors(spark, rows), entries=1)
    assert [r.error for r in codes.collect()] == [8 * vector_codes.LARGEST**2] * 4


def test_active_entries_find_what_a_full_scan_finds():
    rng = np.random.default_rng(1)
    book = rng.integers(-4, 4, (9, 2))
    units = rng.integers(-5, 5, (500, 2))
    code, distance = vector_codes.assign(units, book, np.zeros(9, bool), None, None)
    for _ in range(20):
        moved = rng.random(9) < 0.3
        book = np.where(moved[:, None], rng.integers(-4, 4, (9, 2)), book)
        code, distance = vector_codes.assign(units, book, moved, code, distance)
        full = vector_codes.assign(units, book, moved, None, None)
        assert (code == full[0]).all() and (distance == full[1]).all()


def test_rounds_stop_when_nothing_moves(spark):
    rows = [(i, [float(i % 4)] * 8, 0) for i in range(40)]
    seen = []
    vector_codes.encode(vectors(spark, rows), entries=4, rounds=50, progress=lambda r, m: seen.append(r))
    assert len(seen) < 5


# --- n-gram join -------------------------------------------------------------------


def variants(seed, groups, each, length, changes):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(length)]
        for _ in range(each):
            text = list(base)
            for i in rng.sample(range(length), rng.randrange(changes + 1)):
                text[i] = f"x{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(text), "en", f"s{g}", 0))
    return rows


def joined(spark, rows, size, percent):
    got = ngram_join.join(documents(spark, rows).repartition(4), size, percent)
    return Counter(tuple(r) for r in got.collect())


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (3, 50), (1, 100), (2, 30)])
def test_join(spark, monkeypatch, size, percent):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rows = edge_rows() + [
        (1000 + r[0], *r[1:]) for r in variants(size, 6, 25, 60, 6) + variants(percent, 30, 4, 30, 3)
    ]
    assert joined(spark, rows, size, percent) == Counter(near_components(rows, size, percent))


def test_long_lists_of_unlinked_texts(spark, monkeypatch):
    """Pages of one template: they share most of their text and do not link, but for some."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    common = prose(7, 60).replace("\n", " ")
    rows = [(i, f"{common} {prose(100 + i, 25)}", "en", "t", 0) for i in range(150)]
    rows += [(500 + i, f"{common} {prose(100 + i, 24)} end", "en", "t", 0) for i in range(0, 150, 7)]
    assert joined(spark, rows, 4, 85) == Counter(near_components(rows, 4, 85))


def test_join_of_nothing(spark):
    assert joined(spark, [], 4, 85) == Counter()
    assert joined(spark, [(1, None, "", "", 0), (None, "  ", "", "", 0)], 4, 85) == Counter([(1, 0, 1), (None, 0, None)])


def test_linked_sets_share_enough_of_their_prefixes():
    """Any order, any two steps: the smaller one is what linked sets have in common."""
    rng = random.Random(9)
    for _ in range(400):
        percent = rng.choice([30, 50, 80, 85, 100])
        universe = [rng.randrange(2**63) | rng.randrange(60) << 56 for _ in range(70)]
        base = rng.sample(universe, rng.randrange(1, 60))
        other = [x for x in base if rng.random() < 0.95] + rng.sample(universe, rng.randrange(4))
        a, b = (np.sort(np.array(sorted(set(x)), np.uint64)) for x in (base, other or base))
        common = len(set(a.tolist()) & set(b.tolist()))
        if 100 * common < percent * (len(a) + len(b) - common):
            continue
        assert common >= ngram_join.needed_common(np.array([len(a)]), np.array([len(b)]), percent)[0]
        (p, m), (q, n) = ngram_join.prefix(a, percent), ngram_join.prefix(b, percent)
        assert len(set(p.tolist()) & set(q.tolist())) >= min(m, n)


def test_prefixes_grow_where_shingles_are_frequent():
    rare = np.arange(100, dtype=np.uint64)
    frequent = rare | np.uint64(40) << np.uint64(56)
    assert ngram_join.prefix(rare, 85)[1] == 1
    assert ngram_join.prefix(frequent, 85)[1] > 1
    for ordered in (rare, frequent):
        head, need = ngram_join.prefix(ordered, 85)
        assert len(head) == 100 - 85 + need


def test_lists_across_batches():
    """The same rows in one batch and in small ones, with copies of a class from two tasks."""
    rng = random.Random(2)
    rows = [
        (key, ngram_join._place(rng.randrange(5), rng.randrange(20, 60), 1), rng.randrange(1000))
        for key in range(40) for _ in range(rng.choice([1, 1, 2, 5]))
    ]
    rows = sorted(rows + rows[::3])
    key, place, node = (np.array(x, np.int64) for x in zip(*rows, strict=True))

    def run(step):
        out, state = [], None
        for i in range(0, len(key), step):
            found, state = ngram_join._met(tuple(x[i : i + step] for x in (key, node, place)), state, 85)
            out += found.to_pylist() if found is not None else []
        if state.joined:
            out += ngram_join._list_rows(*state.row, np.array([state.first]), np.array([state.known])).to_pylist()
        return out

    whole = run(len(key))
    sizes = Counter(k for k, _, _ in set(rows))
    assert len(whole) == sum(n for n in sizes.values() if n > 1)
    assert run(1) == run(3) == whole


def test_frequency_classes_ignore_chance():
    counts = np.full(1 << 12, 30)
    counts[5] = 5000
    classes = ngram_join.frequency_classes(counts)
    assert classes[5] > 20 and (np.delete(classes, 5) == 0).all()


def test_pairs_in_blocks_meet_once(spark, monkeypatch):
    """Every pair of a long list comes out once per list, whatever the blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    rows = [(key, node, node, ngram_join._place(0, 100, 1), 0) for key in (1, 2) for node in range(30)]
    frame = spark.createDataFrame(
        [(k, n, p, place, side) for k, n, p, place, side in rows], "group long, node long, part long, place long, side int"
    )
    got = Counter((r.a, r.b) for r in ngram_join._cross(frame, 85).collect())
    assert got == Counter({pair: 2 for pair in combinations(range(30), 2)})
