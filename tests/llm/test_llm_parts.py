"""Parts of the operators that the queries do not show."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import tickflow.llm.components as graph
import tickflow.llm.decontaminate as decontaminate_module
from llm_tables import LOWER, documents, edge_rows, near_components, prose, without_repeats, words
from tickflow.llm import chat, near_dups, quality_classifier, substrings, toxicity, warc
from tickflow.llm.decontaminate import Automaton, decontaminate, scan
from tickflow.llm.line_dedup import LineRuns, clean
from tickflow.llm.mixing import apportion, materialise, mix
from tickflow.llm.quality_rules import judge
from tickflow.llm.words import PLAIN, token_chunks
from tickflow.scratch import new_folder, remove_folders


def test_words_and_their_hashes():
    texts = pa.array([None, "", " a  b\ta", "é日 x", "b", "a b " * 400_000])
    got = {}
    for row, found in token_chunks(texts, PLAIN):
        raw = found.data.tobytes()
        for r in range(len(found.bounds) - 1):
            a, b = found.bounds[r], found.bounds[r + 1]
            spelled = [raw[s:e].decode() for s, e in zip(found.start[a:b], found.end[a:b], strict=True)]
            got[row + r] = spelled
            for word, h in zip(spelled[:50], found.hash[a:b], strict=False):
                assert got.setdefault(word, h) == h
    assert [got[i] for i in range(6)] == [words(t) for t in texts.to_pylist()]
    assert len({got[w] for w in ("a", "b", "é日", "x")}) == 4


@pytest.mark.parametrize("task_edges", [1_000_000, 50])
def test_components(spark, monkeypatch, task_edges):
    """Long paths, a star and cliques; with one contraction, and with steps over many."""
    monkeypatch.setattr(graph, "TASK_EDGES", task_edges)
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, i) for i in range(1001, 1200)]
    clique = [(i, j) for i in range(2000, 2015) for j in range(i)if j >= 2000]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in path + star + clique + clique]
    rng.shuffle(edges)
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect())
    want = {i: 0 for i in range(1, 201)} | {i: 1000 for i in range(1001, 1200)} | {i: 2000 for i in range(2001, 2015)}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _near_group(n: int, base: list[str], change: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        text = list(base)
        for i in rng.sample(range(len(text)), change):
            text[i] = f"z{rng.random()}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("crowded", [256, 8])
def test_near_dups_in_crowded_regions(spark, monkeypatch, crowded):
    """Groups of near copies, some of whose pairs are just below the limit."""
    monkeypatch.setattr(near_dups, "CROWDED", crowded)
    texts = []
    for seed, change in enumerate((1, 2, 3, 4)):
        texts += _near_group(40, words(prose(seed + 50, 110)), change, seed)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    got = near_dups.group(documents(spark, rows, extra=False), 3, 85).collect()
    assert Counter(tuple(r) for r in got) == Counter(near_components(rows, 3, 85))


def test_near_dups_with_null_ids(spark):
    rows = edge_rows()
    got = near_dups.group(documents(spark, rows), 3, 85).collect()
    assert Counter(tuple(r) for r in got) == Counter(near_components(rows, 3, 85))
    kept = near_dups.drop_copies(documents(spark, rows, extra=False))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id for r in kept.collect()} >= {None, 1, 2, 3, 4, 5, 6, 7}
    assert not {r.doc_id for r in kept.collect()} & {8, 15}


def test_drop_copies_keeps_one_row_of_every_component(spark):
    """Also without ids, of repeated rows, and where an id has two texts."""
    a, b, c, d, e = (prose(i, 60) for i in (21, 22, 23, 24, 25))
    rows = [
        (None, a, "en", "a", 0), (None, a, "en", "a", 0), (None, a.upper(), "en", "a", 0),
        (None, b, "en", "a", 0), (5, b, "en", "a", 0), (None, b, "en", "b", 0),
        (6, c, "en", "a", 0), (6, c, "en", "a", 0), (6, c, "en", "b", 0), (7, c, "en", "a", 0),
        (8, d, "en", "a", 0), (9, d, "en", "a", 0), (9, e, "en", "a", 0),
        (10, None, "en", "a", 0), (10, None, "en", "a", 0), (None, "", "en", "a", 0),
    ]
    docs = documents(spark, rows)
    got = near_dups.drop_copies(docs)
    assert got.columns == docs.columns
    kept = Counter((r.doc_id, (r.text or "").lower()) for r in got.collect())
    assert kept == Counter([(None, a), (5, b), (6, c), (8, d), (9, e), (10, ""), (10, ""), (None, "")])
    again = near_dups.drop_copies(docs.repartition(7))
    assert Counter(map(str, again.collect())) == Counter(map(str, got.collect()))


def test_substrings_with_null_ids(spark):
    rows = edge_rows()
    got = substrings.remove(documents(spark, rows), window=6, columns=("doc_id",)).collect()
    want = without_repeats([r[1] for r in rows], 6)
    assert Counter((r.doc.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == Counter(
        (r[0], *w) for r, w in zip(rows, want, strict=True)
    )


@pytest.mark.parametrize("seed", range(3))
def test_substrings_on_random_texts(spark, seed):
    """Texts cut from few words, so that paths branch, overlap and repeat themselves."""
    rng = random.Random(seed)
    pieces = [[f"{rng.choice('abc')}" for _ in range(rng.randrange(3, 30))] for _ in range(6)]
    texts = [" ".join(w for _ in range(rng.randrange(6)) for w in rng.choice(pieces)) for _ in range(60)]
    frame = documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)], extra=False)
    for window in (10, 35):
        got = {r.doc.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove(frame, window).collect()}
        assert got == dict(enumerate(without_repeats(texts, window)))


@pytest.mark.parametrize("seed", range(20))
def test_automaton_finds_every_window(seed):
    rng = random.Random(seed)
    items = [(str(i), [rng.randrange(4) for _ in range(rng.randrange(1, 15))]) for i in range(rng.randrange(1, 8))]
    text = [rng.randrange(-1, 4) for _ in range(200)]
    hit, found = set(), set()
    for i, size, sets in Automaton(5).build(items).matches(text):
        hit.update(range(i - size + 1, i + 1))
        found.update(*sets)
    want_hit, want = set(), set()
    for name, w in items:
        size = min(5, len(w))
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
        for i in range(len(text) - size + 1):
            if tuple(text[i : i + size]) in windows:
                want_hit.update(range(i, i + size))
                want.add(name)
    assert (hit, found) == (want_hit, want)


def test_decontamination_in_several_automata(spark):
    """The same result however the items are dealt out, and texts without the spans."""
    passages = [prose(n, 12).replace("\n", " ") for n in (21, 22, 23)]
    rows = [
        (1, f"Before, {passages[0]}! after {prose(30, 30)}", "en", "s", 0),
        (2, passages[1], "en", "s", 0),
        (3, f"x {passages[2].upper()} y {passages[0]} z {prose(31, 90)}", "en", "s", 0),
        (4, None, "en", "s", 0),
        (None, "clean  text\n", "en", "s", 12),
    ]
    docs = documents(spark, rows, extra=False)
    items = spark.createDataFrame([(i, p) for i, p in enumerate(passages)] + [(None, None)], "item_id long, text string")
    read = lambda frame: sorted(map(str, frame.collect()))
    whole = scan(docs, items, cut=True)
    assert read(scan(docs, items, cut=True, shard_words=5)) == read(whole)
    assert {r.doc.doc_id: r["items"] for r in whole.collect()} == {1: ["0"], 2: ["1"], 3: ["0", "2"], 4: [], None: []}
    left = {r.doc_id: (r.text, r.n_chars) for r in decontaminate(docs, items).collect()}
    assert 2 not in left and left[None] == ("clean  text\n", 12) and left[4] == (None, 0)
    assert left[1][0] == f"Before, ! after {prose(30, 30)}" and left[1][1] == len(left[1][0])


def test_line_runs_are_compacted_and_tell_fresh_keys(spark):
    runs = LineRuns(spark, fanout=2)
    batch = lambda keys, doc: spark.createDataFrame([(k, doc) for k in keys], "key long, doc long")
    fresh = []
    for doc, keys in ((9, [1, 2]), (8, [2, 3]), (7, [1, 2, 3]), (6, [4, 4]), (5, [4, 1])):
        run = runs.add(batch(keys, doc))
        fresh.append(sorted(r.key for r in run.where("holder is not null").collect()))
    assert fresh == [[1, 2], [3], [], [4], []]
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {tuple(r) for r in runs.totals().select("key", "n_docs", "holder").collect()} == {
        (1, 3, 9), (2, 3, 9), (3, 2, 8), (4, 2, 6),
    }


def test_line_dedup_with_null_ids_and_all_columns(spark):
    rows = edge_rows()
    frame = documents(spark, rows)
    got = clean(frame)
    assert got.select("doc.*").columns == frame.columns
    kept = {r.doc.doc_id: r for r in got.where("doc.doc_id is not null").collect()}
    assert kept[12].kept == "" and kept[12].n_dropped == 1 and kept[13].n_dropped == 0


@pytest.mark.parametrize("ids", [[None, 1, 2], [0, 1, 10**9], [*range(0, 10**9, 10**8), 10**9], [None, -5, 2**62], [3, 3, 4, 9]])
@pytest.mark.parametrize("batches", [1, 4])
def test_line_dedup_counts_every_document(spark, ids, batches):
    """Also those at the ends of wide ranges of ids."""
    common = "a line that all of the documents have"
    rows = [(i, f"{common}\nthe line of row {n} and of no other", "en", "a", 0) for n, i in enumerate(ids)]
    got = clean(documents(spark, rows, extra=False), batches=batches).collect()
    last = max(i for i in ids if i is not None)
    drop = len(set(ids)) >= 3
    assert Counter((r.doc.doc_id, r.n_dropped, common in r.kept) for r in got) == Counter(
        (i, int(drop and i != last), not drop or i == last) for i in ids
    )


def test_line_dedup_spreads_ids_with_an_outlier(spark, monkeypatch):
    sizes = []
    add = LineRuns.add

    def counted(self, batch):
        sizes.append(batch.select("doc").distinct().count())
        return add(self, batch)

    monkeypatch.setattr(LineRuns, "add", counted)
    rows = [(i, f"this is the line of document {i}", "en", "a", 0) for i in [None, *range(400), 1 << 62]]
    clean(documents(spark, rows, extra=False)).collect()
    assert sum(sizes) == 402 and max(sizes) < 110


def test_apportionment_by_highest_quotients(spark):
    rng = random.Random(5)
    votes = [(g, p, rng.randrange(0, 1000), seats) for g, seats in ((0, 0), (1, 1), (2, 37), (3, 1000)) for p in range(9)]
    frame = spark.createDataFrame(votes, "g long, p long, v long, s long")
    got = {(r.g, r.p): r.quota for r in apportion(frame, ["g"], "p", "v", "s").collect()}
    for g, seats in ((0, 0), (1, 1), (2, 37), (3, 1000)):
        party = {p: v for h, p, v, _ in votes if h == g}
        won = Counter()
        for _ in range(seats):
            won[max(party, key=lambda p: (party[p] / (2 * won[p] + 1), -p))] += 1
        assert {p: got[g, p] for p in party} == {p: won[p] for p in party}


def test_mix_takes_what_it_says(spark):
    rng = random.Random(8)
    rows = [(i, prose(i, rng.randrange(0, 400)), "en", rng.choice(["a", "a", "a", "b", None]), 0) for i in range(120)]
    rows += [(None, None, None, None, None), (7, "x y", "en", "a", 3), (7, "x y", "en", "a", 3)]
    docs = documents(spark, rows, extra=False)
    taken = mix(docs, block=10, shard_rows=20)
    again = mix(docs.repartition(7), block=10, shard_rows=20)
    assert Counter(map(str, taken.collect())) == Counter(map(str, again.collect()))
    total = Counter()
    for r in taken.collect():
        assert r.taken == r.passes * r.size + sum(s.last - s.first for s in r.spans)
        assert 0 <= r.taken <= 3 * r.size
        total[r.source] += r.taken
    for r in taken.select("source", "target").distinct().collect():
        assert abs(total[r.source] - r.target) <= max(30, 0.05 * r.target)
    made = materialise(docs, taken)
    assert made.columns == docs.columns
    assert sum(len(words(r.text)) for r in made.collect()) == sum(total.values())


def test_quality_limits_follow_their_group(spark):
    """What is usual in one source is out of the ordinary in another."""
    text = lambda i, mark: " ".join(f"word{i}x{j}{mark if j % 4 == 0 else ''}" for j in range(60))
    rows = [(i, text(i, "#"), "en", "code", 0) for i in range(120)]
    rows += [(1000 + i, text(i, ""), "en", "news", 0) for i in range(120)] + [(5000, text(1, "#"), "en", "news", 0)]
    rows += [(6000, None, None, None, 0), (None, "", None, None, 0)]
    got = {r.doc_id: r for r in judge(documents(spark, rows)).collect()}
    assert all(got[i].kept for i in range(120)) and all(got[1000 + i].kept for i in range(120))
    assert not got[5000].kept and not got[5000].base_failed
    assert got[6000].base_failed and not got[6000].kept


def test_one_class_gives_constant_scores(spark):
    docs = documents(spark, edge_rows())
    for label, score in ((1, 1.0), (0, 0.0), (None, 0.5)):
        labels = spark.createDataFrame([(i, label, label) for i in range(1, 9)], "doc_id long, quality int, toxic int")
        for module in (quality_classifier, toxicity):
            model = module.train(docs, labels, F.lit(False))
            got = {round(r.score, 6) for r in module.score(docs, model).collect()}
            assert got == {score}


def _rare_stems() -> list[str]:
    """Two stems with the same remainder by 1,048,573 (once the table's size): z1234 and another."""
    from itertools import product

    number = lambda w: int.from_bytes(w.encode(), "big")
    digits = "abcdefghijklmnopqrstuvwxyz0123456789"
    want = number("z1234") % 1_048_573
    other = ("".join(w) for w in product(digits, repeat=5))
    return ["z1234", next(w for w in other if w != "z1234" and number(w) % 1_048_573 == want)]


@pytest.mark.parametrize("most", [1_000_000, 5])
def test_no_stem_is_lost_to_another(spark, monkeypatch, most):
    """A toxic stem and a more frequent ordinary one; by a broadcast and by a join."""
    monkeypatch.setattr(toxicity, "BROADCAST_ROWS", most, raising=False)
    toxic, ordinary = _rare_stems()
    filler = [f"fill{i}" for i in range(9)]
    rows = [(i, " ".join(filler + [ordinary] * 8), "en", "a", 0) for i in range(200)]
    rows += [(1000 + i, " ".join(filler + [toxic] * 3), "en", "a", 0) for i in range(40)]
    rows += [(2000, f"new words {toxic} here", "en", "a", 0), (2001, f"new words {ordinary} here", "en", "a", 0)]
    rows += [(None, f"new words {toxic} here", "en", "a", 0), (2002, None, "en", "a", 0), (2002, None, "en", "a", 0)]
    labels = spark.createDataFrame([(r[0], int(r[0] >= 1000)) for r in rows[:240]], "doc_id long, toxic int")
    docs = documents(spark, rows)
    model = toxicity.train(docs, labels, F.lit(False))
    got = toxicity.score(docs, model).select("doc.doc_id", "score").collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all((r.score > 0.5) == (r.doc_id is None or 1000 <= r.doc_id <= 2000) for r in got)
    assert (model.path is None) == (most > 5)


@pytest.mark.parametrize("most", [1_000_000, 5])
def test_toxicity_weighs_all_words(spark, monkeypatch, most):
    """Moderate evidence for either class counts, by whole words and in any script."""
    monkeypatch.setattr(toxicity, "BROADCAST_ROWS", most, raising=False)
    mild, calm = [f"{c}mild" for c in "abcdef"], [f"{c}calm" for c in "abcdef"]
    rows = []
    for i in range(120):
        bad = i % 2
        text = mild * (3 if bad else 1) + calm * (1 if bad else 3)
        # The same first five bytes, and the same first five letters.
        text += ["идиот", "motherless"] * 6 if i % 4 == 1 else ["идея", "motherly"] * 6 if i % 4 == 0 else []
        rows.append((i, " ".join(text), "en", "a", 0))
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    new = ["", " ".join(mild * 3), " ".join(calm * 3), "идиот " * 3, "идея " * 3, "motherless " * 3, "motherly " * 3]
    model = toxicity.train(documents(spark, rows), labels, F.lit(False))
    asked = [(i, t, "en", "a", 0) for i, t in enumerate(new)]
    score = dict(toxicity.score(documents(spark, asked), model).select("doc.doc_id", "score").collect())
    assert score[1] > score[0] > score[2]
    assert score[3] > score[0] > score[4] and score[5] > score[0] > score[6]
    assert (model.path is None) == (most > 5)


def test_archive_files(spark):
    pages = [(i, f"http://h/{i}", f"<p>{i % 40}</p>" * 200) for i in range(300)]
    pages += [(5, "http://h/5", "<p>5</p>" * 200), (None, None, None), (None, "u", None), (7, "a", "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    read = lambda m: sorted((r.final.rsplit("/", 1)[1], r.records, r.bytes, r.sha256) for r in m.collect())
    one, two = new_folder(spark, "warc"), new_folder(spark, "warc")
    first = warc.write(frame, one, shard_bytes=100_000, roll_bytes=2_000)
    second = warc.write(frame.repartition(5), two, shard_bytes=100_000, roll_bytes=2_000)
    assert read(first) == read(second) and len(read(first)) > 10
    warc.commit(first, one)  # once more does no harm
    back = warc.read(spark, one)
    assert back.count() == len(pages)
    kinds = Counter((r.payload_digest, r.record_type) for r in back.collect())
    digests = {d for d, _ in kinds}
    assert all(kinds[d, "response"] == 1 for d in digests)
    best = {d: max((p for p, _, h in pages if warc.base32_sha1((h or "").encode()) == d and p is not None), default=None) for d in digests}
    for r in back.collect():
        if r.record_type == "response":
            assert r.page_id == best[r.payload_digest] and r.refers_to is None
            assert warc.base32_sha1(r.html.encode()) == r.payload_digest
        else:
            assert r.refers_to == best[r.payload_digest] and r.html is None


def test_escape_is_undone(spark):
    texts = ["<s>", "</s>", "[INST]", "[/INST]", "<~s>", "[~~/INST]", "<<s>>[[INST]]", "a<b>", "~<s>~", "", "</s></s>"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_examples_train_on_one_reply_each(spark):
    turns = [(1, 0, "system", "be"), (1, 1, "user", "q"), (1, 2, "assistant", "r <s>"), (1, 3, "user", "q2"),
             (1, 4, "assistant", "r2"), (1, 5, "user", "q3"), (None, 0, None, None)]
    made = chat.examples(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {(r.conv_id, r.example): (r.text[: r.loss_start], r.text[r.loss_start : r.loss_end]) for r in made.collect()}
    head = "<s>system[INST]be</s><s>user[INST]q</s><s>assistant[INST]"
    assert got[1, 0] == (head, "r <~s>")
    assert got[1, 1] == (head + "r <~s></s><s>user[INST]q2</s><s>assistant[INST]", "r2")
    assert got[1, 2][1] == "" and got[None, 0][1] == ""
    assert np.all([len(k) == 2 for k in got])


LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _plain_ratios(texts, labels):
    """The ratio of any word by class-conditional Kneser-Ney, from counted words and stems."""
    split = [LETTER_WORD.findall((t or "").translate(LOWER)) for t in texts]
    count = [Counter(w for ws, y in zip(split, labels, strict=True) if y == c for w in ws) for c in (0, 1)]
    vocabulary = set(count[0]) | set(count[1])
    kinds = Counter(w[: toxicity.STEM] for w in vocabulary)
    stem = [Counter() for _ in range(2)]
    for c in range(2):
        for w, n in count[c].items():
            stem[c][w[: toxicity.STEM]] += n
    total = [sum(c.values()) for c in count]
    word_free = [sum(min(n, toxicity.DISCOUNT) for n in c.values()) for c in count]
    stem_free = [sum(min(n, toxicity.DISCOUNT) for n in c.values()) for c in stem]

    def probability(word, c):
        s = word[: toxicity.STEM]
        backoff = kinds[s] / len(vocabulary)
        of_stem = (max(stem[c][s] - toxicity.DISCOUNT, 0) + stem_free[c] * backoff) / total[c]
        return (max(count[c][word] - toxicity.DISCOUNT, 0) + word_free[c] * of_stem / kinds[s]) / total[c]

    def ratio(word):
        if word[: toxicity.STEM] not in kinds:
            return 0.0
        return math.log(probability(word, 1) / probability(word, 0))

    return ratio


@pytest.mark.parametrize("most", [1_000_000, 5])
def test_toxicity_equals_a_plain_kneser_ney(spark, monkeypatch, most):
    """Ratios and figures, by a broadcast and by a join."""
    monkeypatch.setattr(toxicity, "BROADCAST_ROWS", most, raising=False)
    rng = random.Random(6)
    vocabulary = [f"{a}{b}{c}" for a in ("alpha", "bet", "гамма", "日本") for b in ("", "x", "yy", "é") for c in ("", "s", "ing")]
    texts = [" ".join(rng.choice(vocabulary[i % 9 :: 2]) for _ in range(rng.randrange(60))) for i in range(90)]
    texts += ["", None, "NEVER seen words " * 3, "Alpha-alphaX" * 40]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    known = {i: int(i % 9 > 5) for i in range(70)}
    labels = spark.createDataFrame(list(known.items()), "doc_id long, toxic int")
    docs = documents(spark, rows, extra=False)
    model = toxicity.train(docs, labels, F.lit(False))
    assert (model.path is None) == (most > 5)
    ratio = _plain_ratios([texts[i] for i in known], list(known.values()))
    got = {r.doc_id: r for r in toxicity._figured(docs, ["doc_id"], model).collect()}
    for i, text in enumerate(texts):
        each = sorted((ratio(w) for w in LETTER_WORD.findall((text or "").translate(LOWER))), reverse=True)
        for share, name in zip(toxicity.SHARES, toxicity.FIGURES, strict=True):
            n = max(1, math.ceil(len(each) * share))
            want = sum(each[:n]) / n if each else 0.0
            assert got[i][name] == pytest.approx(want, abs=1e-9), (i, share)


def test_a_text_is_toxic_in_a_few_places(spark):
    """One word in a hundred decides, as in a text full of it."""
    calm = [f"calm{i}" for i in range(40)]
    rng = random.Random(8)
    rows = []
    for i in range(200):
        text = [rng.choice(calm) for _ in range(150)]
        if i % 4 == 0:
            text[rng.randrange(150)] = "wicked"
        rows.append((i, " ".join(text), "en", "a", 0))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.train(documents(spark, rows), labels, F.lit(False))
    asked = [" ".join(calm * 3), " ".join(calm * 3) + " wicked", "wicked " * 50, "wickedly " + " ".join(calm * 2)]
    got = documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(asked)])
    score = dict(toxicity.score(got, model).select("doc.doc_id", "score").collect())
    assert score[0] < 0.5 < min(score[1], score[2], score[3])


@pytest.mark.parametrize("ids", [(-(2**63), 5), (-(2**63) + 5, 2**63 - 1), (-(2**63), 2**63 - 1, 0, None)])
def test_archive_of_ids_far_apart(spark, ids):
    pages = [(i, f"http://h/{i}", "<p>same</p>") for i in ids]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = new_folder(spark, "warc")
    warc.write(frame, folder, shard_bytes=300)
    back = warc.read(spark, folder).collect()
    best = max(i for i in ids if i is not None)
    assert Counter(r.page_id for r in back) == Counter(ids)
    assert {(r.page_id, r.record_type) for r in back} == {(i, "response" if i == best else "revisit") for i in ids}


def test_items_in_capitals_count_for_the_size_of_an_automaton(spark, monkeypatch):
    built = []
    of = decontaminate_module.Scanner.of
    monkeypatch.setattr(decontaminate_module.Scanner, "of", staticmethod(lambda *args: built.append(1) or of(*args)))
    items = [(i, " ".join(f"W{i}X{j}" for j in range(50))) for i in range(40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, [(1, items[7][1].lower(), "en", "a", 0)])
    found = scan(docs, benchmark, shard_words=200).collect()
    assert len(built) == 10 and found[0]["items"] == ["7"] and found[0].n_hit == 50


def test_quality_ratios_equal_plain_counts(spark):
    """The log-count ratio of every feature of a small table, counted text by text."""
    rng = random.Random(11)
    texts = [" ".join(rng.choice(["good", "fine", "bad", "naïve", "日本", "a"]) for _ in range(rng.randrange(30))) for _ in range(40)]
    texts += ["", None, "abc", "same same same same " * 5, "é" * 9]
    labels = [i % 3 % 2 for i in range(len(texts))]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id long, quality int")
    model = quality_classifier.train(documents(spark, rows).repartition(3), known, F.lit(False))

    def slots(text):
        raw = (text or "").encode()
        found = {int.from_bytes(raw[i : i + 4], "big") * 2654435769 % 2**32 >> 32 - quality_classifier.BITS for i in range(len(raw) - 3)}
        said = words(text)
        runs = [tuple(said[i : i + 3]) for i in range(len(said) - 2)]
        share = (len(runs) - len(set(runs))) / max(len(runs), 1)
        step = sum(1 for limit in quality_classifier.REPEATED if limit < share)
        return found | {(1 << quality_classifier.BITS) + step}

    seen, n = [Counter(), Counter()], Counter(labels)
    for text, label in zip(texts, labels, strict=True):
        seen[label].update(slots(text))
    for slot in set(seen[0]) | set(seen[1]):
        want = math.log((seen[1][slot] + 1) / (n[1] + 2)) - math.log((seen[0][slot] + 1) / (n[0] + 2))
        assert model.ratio[slot] == pytest.approx(want, abs=1e-9)
    # No text has the others: what an unseen feature says.
    unseen = math.log((n[0] + 2) / (n[1] + 2))
    rest = np.setdiff1d(np.arange(quality_classifier.SLOTS), list(set(seen[0]) | set(seen[1])))
    assert np.allclose(model.ratio[rest], unseen, atol=1e-9)
    got = {r["doc"].doc_id: r.score for r in quality_classifier.score(documents(spark, rows), model).collect()}
    for i, text in enumerate(texts):
        at = np.array(sorted(slots(text)))
        x = model.ratio[at]
        margin = model.weight[at] @ x / max(np.sqrt(x @ x), 1e-9) + model.intercept
        want = 1 / (1 + math.exp(-(model.curve[0] * margin + model.curve[1])))
        assert got[i] == pytest.approx(want, abs=1e-9)


def test_no_run_of_lines_stays_in_the_catalog(spark):
    def runs():
        return [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]

    assert clean(documents(spark)).count() and runs()
    remove_folders(spark)
    assert not runs()
