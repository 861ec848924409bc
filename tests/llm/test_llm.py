"""Corpus operators against brute force on small tables, and their defined results at the edges."""

import collections
import math
import random
import re
from html.parser import HTMLParser
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrid.llm import decontam, graph, html, langid, mixing, neardup, passages, quality, queries, topk, toxicity, warc
from cellgrid.llm.common import Scratch, hashed_words, shared_dir, shingle_set, shingle_sets, table, word_hashes, words

WORDS = [a + b + c for a in "bdfgklmn" for b in "aeiou" for c in ("st", "rn", "l", "nd", "p")]
DOC = "doc_id long, text string, lang string, source string"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def docs(spark, texts, ids=None, source="s", lang="en"):
    return spark.createDataFrame([(i, t, lang, source) for i, t in zip(ids or range(len(texts)), texts, strict=True)], DOC)


def shingles(text):
    w = ["".join(c.lower() if "A" <= c.upper() <= "Z" and c.isascii() else c for c in x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def components(sets):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * len(sets[i] | sets[j]):
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_loops_over_small_tables_leave_little_in_the_driver(spark):
    """A round's joins broadcast nothing, and full collections do not follow each other at once."""
    scratch = Scratch(spark, join="merge")
    edges = scratch.save(spark.createDataFrame([(2, 1), (3, 2)], "u long, v long"), "edges")
    plan = graph._round(edges)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if re.search("Old|MarkSweep", b.getName()))
    before = full()
    for _ in range(3):
        Scratch(spark).release()
    assert full() - before <= 1


@pytest.mark.parametrize("pairs, tables", [
    ([(0, i) for i in range(1, 50)] + [(i, 200) for i in range(201, 230)] + [(5, 5), (None, 3)], 2),
    ([(i * 37 % 101, (i + 1) * 37 % 101) for i in range(100)], 100),
])
def test_components_end_with_the_round_that_makes_stars(spark, pairs, tables):
    scratch = Scratch(spark)
    got = [(r.u, r.v) for r in graph.components(scratch, spark.createDataFrame(pairs, "a long, b long"), "c").collect()]
    least = {x: x for p in pairs if None not in p for x in p}
    for _ in least:
        for a, b in pairs:
            if a is not None:
                least[a] = least[b] = min(least[a], least[b])
    assert sorted(got) == sorted((x, y) for x, y in least.items() if x != y)
    assert scratch.saved <= tables  # stars were gone through once more, to see that nothing changes


def test_a_cluster_needs_a_shared_folder():
    session = lambda master, path: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: path), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master=master))
    assert shared_dir(session("yarn", "store://x")) == "store://x"
    for master in ("yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="checkpoint"):
            shared_dir(session(master, None))


# words


def test_words_and_hashes():
    texts = ["Ab c\td e  É", "", None, "\n\x0bx\x1cy", "a b c d e f", "ß\x85z"]
    h, n = hashed_words(texts)
    assert list(n) == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts] == [len(words(t)) for t in texts]
    assert len(set(h.tolist())) == len({w for t in texts for w in words(t)})
    for t, s in zip(texts, shingle_sets(texts), strict=True):
        assert len(s) == len(shingles(t)) == len(shingle_set(word_hashes(words(t))))


# near duplicates


def test_sketch_merges_and_estimates():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, 3000).astype(np.uint64), rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    x, y, both = neardup.set_sketch([np.unique(a), np.unique(np.concatenate([a[1000:], b])), np.unique(np.concatenate([a, b]))])
    assert (np.maximum(x, y) == both).all()
    est = neardup.joint_estimate(x[None], y[None], np.array([3000.0]), np.array([3000.0]))[0]
    assert abs(est - 0.5) < 5 * math.sqrt(0.25 / neardup.M)
    assert (neardup.set_sketch([np.zeros(0, np.uint64)]) == 0).all()


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(2)
    texts = []
    for _ in range(12):
        base = sentence(rng, rng.choice([3, 6, 40, 120])).split()
        for _ in range(rng.choice([1, 3, 9])):
            new = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                new[rng.randrange(len(new))] = rng.choice(WORDS)
            texts.append(" ".join(new))
    texts += ["", None, "One", "one", "one two", "ONE  TWO", "x" * 5000 + " y"]
    rng.shuffle(texts)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs(spark, texts)).collect()}
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = components(sets)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_near_duplicate_chain_and_edges(spark):
    """A chain whose ends are far apart is one component; nulls, repeated rows and clashing columns do no harm."""
    rng = random.Random(3)
    w, texts = sentence(rng, 100).split(), []
    for i in range(40):
        texts.append(" ".join(w))
        w[2 * i] = rng.choice(WORDS) + "x"
    d = docs(spark, [*texts, texts[0], None], [*range(40), 7, 50]).withColumn("rep", F.lit(1)).withColumn("component_id", F.lit("z"))
    d = d.union(spark.createDataFrame([(None, texts[0], None, None)], DOC).withColumn("rep", F.lit(1)).withColumn("component_id", F.lit("z")))
    got = neardup.near_duplicates(d).collect()
    assert len(got) == 43
    assert {r.component_id for r in got if r.doc_id is not None and r.doc_id < 40} == {0}
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert neardup.near_duplicates(docs(spark, ["a"]).limit(0)).count() == 0


# passages


def passage_docs(rng):
    say = lambda n: " ".join(sentence(rng, 8).capitalize() + "." for _ in range(n // 8 + 1))
    shared = [say(64), say(80)]
    texts = [say(200) for _ in range(12)]
    at = {0: [1, 4, 7], 1: [2, 9]}
    for p, ids in at.items():
        for i in ids:
            t = texts[i].split()
            k = rng.randrange(20, len(t) - 20)
            texts[i] = " ".join(t[:k]) + " " + shared[p] + " " + " ".join(t[k:])
    return texts, shared, at


def test_repeated_passages(spark):
    texts, shared, at = passage_docs(random.Random(4))
    rows = passages.repeated_passages(docs(spark, [*texts, "", None])).collect()
    assert {r.doc_id for r in rows} == {i for ids in at.values() for i in ids}
    assert {r.doc_id for r in rows if r.removed} == {4, 7, 9}
    for r in rows:
        # a paragraph that starts a few words before a passage is still similar to its like
        own = set(shared[0 if r.doc_id in at[0] else 1].split())
        assert sum(w not in own for w in texts[r.doc_id][r.start : r.stop].split()) <= 8
    d = docs(spark, [*texts, "", None]).withColumn("n_chars", F.length("text").cast("long"))
    out = {r.doc_id: r for r in passages.without_passages(d).collect()}
    assert len(out) == len(texts) + 2
    for i, t in enumerate(texts):
        assert out[i].text == t if i not in (4, 7, 9) else len(out[i].text.split()) <= len(t.split()) - 45 and out[i].n_chars == len(out[i].text)
    assert passages.repeated_passages(docs(spark, ["a"]).limit(0)).count() == 0


def test_edited_passage_is_found(spark):
    rng = random.Random(5)
    texts, shared, _ = passage_docs(rng)
    edited = shared[0].split()
    edited[30] = "Xyz"
    rows = passages.repeated_passages(docs(spark, [texts[0] + " " + shared[0], texts[3] + " " + " ".join(edited)])).collect()
    assert {(r.doc_id, r.removed) for r in rows} == {(0, False), (1, True)}


def test_edited_passages_match_brute_force(spark):
    """Passages of 50 words with a word changed anywhere, and one template in more variants than are compared at once."""
    rng = random.Random(21)
    texts = []
    for i in range(100):
        w = sentence(rng, 50).split()
        texts += [" ".join(w), " ".join([*w[: i % 50], "edited", *w[i % 50 + 1 :]])]
    base = sentence(rng, 25)
    for i in range(40):  # pairs of like variants; those of different pairs share half of their words but are not alike
        w = [*base.split(), *(f"v{i}x{k}" for k in range(25))]
        texts += [" ".join(w), " ".join([*w[:49], "edited"])]
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = {i for i, c in components(sets).items() if i != c}
    got = {r.doc_id for r in passages.repeated_passages(docs(spark, texts)).collect() if r.removed}
    assert len(want) == 140 and got <= want and len(got) >= 0.9 * len(want)


def test_edited_passages_in_long_texts(spark):
    """Passages in which each word is replaced with the same probability, found where they are alike."""
    rng = random.Random(22)
    texts, want = [], set()
    for i in range(120):
        w = sentence(rng, rng.choice([60, 100, 200])).split()
        edited = [rng.choice(WORDS) if rng.random() < 0.015 else x for x in w]
        a, b = shingles(" ".join(w)), shingles(" ".join(edited))
        if len(a & b) >= 0.75 * len(a | b):
            want.add(2 * i + 1)
        texts += [" ".join([sentence(rng, 80), *x, sentence(rng, 80)]) for x in (" ".join(w).split(), edited)]
    got = {r.doc_id for r in passages.repeated_passages(docs(spark, texts)).collect() if r.removed}
    assert len(want) > 90 and len(got & want) >= 0.9 * len(want) and all(i % 2 for i in got)


def test_passages_of_odd_tables(spark):
    """Texts of one id are kept apart and are no different documents; clashing columns, nulls and repeated rows do no harm."""
    rng = random.Random(26)
    shared, own = sentence(rng, 60), sentence(rng, 150)
    texts = [shared + " " + sentence(rng, 30), own, sentence(rng, 20) + " " + shared, None, "", shared]
    d = docs(spark, texts, [1, 5, 5, 6, None, None]).union(docs(spark, [texts[0]], [1]))
    for c in ("cuts", "cut", "row", "text_digest", "doc", "start", "removed"):
        d = d.withColumn(c, F.lit(c))
    out = passages.without_passages(d)
    assert out.columns == d.columns
    rows = collections.Counter((r.doc_id, r.text, r.cuts, r.row) for r in out.collect())
    assert rows == collections.Counter((i, t, "cuts", "row") for i, t in [(1, texts[0]), (1, texts[0]), (5, own), (5, " ".join(texts[2].split()[:20])), (6, None), (None, ""), (None, shared)])
    alone = docs(spark, [shared, shared + " " + own], [1, 1])
    assert passages.repeated_passages(alone).count() == 0


def test_a_line_of_many_texts_is_no_passage(spark):
    rng = random.Random(27)
    line = sentence(rng, 12)
    texts = [" ".join([sentence(rng, 60), line, sentence(rng, 60)]) for _ in range(150)]
    texts[9] = texts[8]
    assert {r.doc_id for r in passages.repeated_passages(docs(spark, texts)).collect()} == {8, 9}


def test_repeats_without_capitals(spark):
    """Repeats of 51 words in lower case and in Cyrillic are found wherever they stand, and go whole."""
    rng = random.Random(23)
    texts, spans = [], {}
    for i in range(60):
        shared, cyrillic = sentence(rng, 51), str.maketrans("abdefgiklmnoprstux", "абдефгиклмнопрстуч")
        for k in range(2):
            before, after = f"left{i}x{k}", f"right{i}x{k}"
            head, tail = sentence(rng, rng.randrange(40)), sentence(rng, rng.randrange(40))
            text, part = " ".join(x for x in (head, before, shared, after, tail) if x), shared
            if i % 3 == 0:
                text, part = text.translate(cyrillic), part.translate(cyrillic)
            spans[len(texts)] = (text.index(part), text.index(part) + len(part))
            texts.append(text)
    got = {r.doc_id: (r.start, r.stop) for r in passages.repeated_passages(docs(spark, texts)).collect() if r.removed}
    assert sorted(got) == list(range(1, len(texts), 2))
    for i, (start, stop) in got.items():
        # whole, and at most the few words beside it that a similar paragraph may hold
        assert start <= spans[i][0] and stop >= spans[i][1]
        assert len(texts[i][start : spans[i][0]].split()) <= 8 and len(texts[i][spans[i][1] : stop].split()) <= 8


def test_starts_depend_on_the_text_alone():
    rng = random.Random(24)
    texts = [" ".join(sentence(rng, rng.randrange(1, 30)) + rng.choice([" Abc", ". Abc", " x x x x x x x x"]) for _ in range(rng.randrange(9))) for _ in range(60)]
    text, at, *_ = passages.paragraphs(texts)
    first = np.append(0, np.cumsum([len(t.split()) for t in texts]))
    for i, t in enumerate(texts):
        own = passages.paragraphs([t])[1]
        assert list(own) == list(at[text == i] - first[i])
        last = len(t.split()) - passages.WIDTH - passages.SPACING + 1
        assert all(any(a <= x < a + passages.SPACING for x in own) for a in range(last + 1))


def test_sliding_minima():
    h = np.random.default_rng(1).integers(0, 1 << 60, 300).astype(np.uint64)
    at = np.arange(0, 260, 7)
    assert (passages._minima(h, at, 28) == [h[i : i + 28].min() for i in at]).all()


# decontamination


def test_common_subsequence():
    rng = random.Random(6)
    for _ in range(50):
        a, b = [[rng.choice("abcd") for _ in range(rng.randrange(30))] for _ in range(2)]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontam.common_subsequence(a, b) == t[-1][-1]


def test_contamination(spark):
    rng = random.Random(7)
    items = [sentence(rng, 40 if i == 11 else rng.choice([16, 24, 40])) for i in range(15)]
    texts = [sentence(rng, 150) for _ in range(60)]
    want = set()
    for d, i in ((3, 0), (9, 4), (9, 5), (20, 7), (41, 11)):
        t, w = texts[d].split(), items[i].split()
        if d == 41:
            w[2], w[9], w[21] = (rng.choice(WORDS) for _ in range(3))
        texts[d] = " ".join(t[:50] + w + t[50:])
        want.add((d, i))
    bench = spark.createDataFrame([*enumerate(items), (99, None), (98, "short one")], "item_id long, text string")
    got = decontam.contaminated(docs(spark, [*texts, "", None]), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(spark, texts), bench, item_block=6).collect()} == want
    assert decontam.contaminated(docs(spark, ["a"]).limit(0), bench).count() == 0
    assert decontam.contaminated(docs(spark, texts), bench.limit(0)).count() == 0


def test_short_items(spark):
    """Items below 8 words are found word by word."""
    rng = random.Random(25)
    texts = [sentence(rng, 20) for _ in range(600)]
    texts[7] += ". Who WROTE it? " + texts[8]
    texts[9] += " who wrote"
    texts[10] = "it " + texts[10] + " Why"
    bench = spark.createDataFrame([(1, "Who wrote it?"), (2, "why"), (3, "?"), (4, sentence(rng, 20)), (5, "who wrote it")], "item_id long, text string")
    got = decontam.contaminated(docs(spark, [*texts, None]), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(7, 1), (7, 5), (10, 2)]


def test_sample_is_bounded(spark):
    texts = spark.createDataFrame([(f"text {i % 60}",) for i in range(900)], "text string")
    got = [r.text for r in decontam.bounded_sample(Scratch(spark), texts, 40).collect()]
    assert len(got) == len(set(got)) == 40
    assert decontam.bounded_sample(Scratch(spark), texts.limit(0), 40).count() == 0


@pytest.mark.parametrize("edits", [0.0, 0.15])
def test_contamination_matches_brute_force(spark, edits):
    """All pairs by common subsequence, for items of 8 to 1,500 words, as they are and with words replaced; repeated rows,
    null ids and two texts of one id among them."""
    rng = random.Random(28)
    items = [sentence(rng, n) for n in (8, 12, 24, 25, 40, 60, 90, 150, 300, 700, 1500) for _ in range(2)]
    texts = [sentence(rng, 120) for _ in range(10)]
    for w in map(str.split, items):
        inner = [rng.choice(WORDS) if rng.random() < edits else x for x in w]
        texts.append(" ".join([sentence(rng, rng.randrange(5, 90)), *inner, sentence(rng, rng.randrange(90))]))
    want = set()
    for d, t in enumerate(texts):
        own = t.split()
        for i, w in enumerate(map(str.split, items)):
            region = max((decontam.common_subsequence(w, own[a : a + 2 * len(w)]) for a in range(0, len(own), max(4, len(w) // 4))), default=0)
            if region >= 0.8 * len(w):
                want.add((d, i))
    d = docs(spark, [*texts, texts[-1], texts[-1], "", None], [*range(len(texts)), len(texts) - 1, None, 0, 1]).withColumn("item_id", F.lit("x")).withColumn("digest", F.lit(1))
    got = [(r.doc_id, r.item_id) for r in decontam.contaminated(d, spark.createDataFrame([*enumerate(items)], "item_id long, text string")).collect()]
    assert len(got) == len(set(got)) and (None, len(items) - 1) in got
    named = {x for x in got if x[0] is not None}
    assert len(want) >= len(items) * (1 if not edits else 0.5) and len(named & want) >= 0.95 * len(want)
    assert all(d - 10 == i for d, i in named)


# mixing


def test_mixing_matches_sql(spark, data):
    rng = random.Random(8)
    rows = [(rng.randrange(300) if rng.random() > 0.1 else None, " ".join(["w"] * rng.randrange(60)) if rng.random() > 0.05 else None, "en", rng.choice(["a", "b", "c", "é", "z", None, "hot", "hot", "hot"])) for _ in range(400)]
    d = spark.createDataFrame(rows, DOC)
    labels = spark.createDataFrame([(i, rng.choice([0, 1, None])) for i in range(0, 300, 3)], "doc_id long, quality int")
    con = duckdb.connect()
    con.register("documents", d.toPandas().astype({"doc_id": "Int64"}))
    con.register("labels", labels.toPandas().astype({"quality": "Int64"}))
    got = mixing.mix(d, mixing.label_weights(labels))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(con.sql(mixing.SQL).fetchall(), key=key)
    per = collections.defaultdict(lambda: [0, 0.0, 0, 0])
    for r in got.collect():
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        p = per[r.source]
        p[0] += r.taken
        p[1], p[2], p[3] = r.target, r.source_size, max(p[3], r["size"])
    assert all(abs(t - target) <= most / 2 + 1e-6 and target <= 3 * s for t, target, s, most in per.values())
    assert sum(p[1] for p in per.values()) == pytest.approx(sum(p[2] for p in per.values()))
    assert mixing.mix(d.limit(0)).count() == 0


# archives


def test_archives(spark, tmp_path):
    big = "é" * 600
    rows = [(1, "http://a", big), (2, "http://b c", big), (3, None, big), (4, "u", "x" * 400), (5, "u", "x" * 400), (6, "u", None), (7, "u", "WARC/1.1\r\n\r\n\r\n" * 100), (None, "u", big), (8, "u", "a\n\nb")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("first", F.lit(1))
    got = {r.page_id: r for r in warc.archive_pages(pages, str(tmp_path / "w")).collect()}
    assert len(got) == len(rows) and all(r.intact for r in got.values())
    kinds = {i: (r.record_type, r.refers_to) for i, r in got.items()}
    assert kinds == {1: ("revisit", 3), 2: ("revisit", 3), 3: ("response", None), None: ("revisit", 3)} | {i: ("response", None) for i in (4, 5, 6, 7, 8)}
    assert {i: r.payload_bytes for i, r in got.items()} == {r[0]: len((r[2] or "").encode()) for r in rows}
    assert warc.archive_pages(pages.limit(0), str(tmp_path / "e")).count() == 0


# classifiers


def test_malformed_archives_raise(spark, tmp_path):
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert [block for _, block in warc.parse(good * 2)] == [b"abcd"] * 2
    for bad in (good[:-7], good.replace(b": 4", b": x"), good.replace(b"Content-Length: 4\r\n", b""), b"WARC/1.1\r\nWARC-Type: r"):
        with pytest.raises(ValueError, match="malformed"):
            list(warc.parse(good + bad))


def test_a_digest_of_most_pages(spark, tmp_path):
    """One payload fills a third of the pages, with repeated rows, null ids and columns of the operator's own names."""
    body = "x" * 1500
    rows = [(i, "u", body) for i in range(40)] + [(39, "v", body), (None, "u", body), (None, None, None)] + [(100 + i, "u", f"{i} " * 700) for i in range(60)] + [(200, "u", "small"), (201, "u", "small")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"id": F.lit(1), "first": F.lit("f"), "salt": F.lit(0)})
    got = warc.archive_pages(pages, str(tmp_path / "w")).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    kinds = collections.Counter((r.page_id, r.record_type, r.refers_to) for r in got if r.page_id is None or r.page_id < 100)
    assert kinds == collections.Counter([(i, "revisit", 39) for i in range(39)] + [(39, "response", None)] * 2 + [(None, "revisit", 39), (None, "response", None)])
    assert all(r.record_type == "response" for r in got if r.page_id and r.page_id >= 100)


def test_toxicity_held_out(spark):
    rng = random.Random(9)
    bad = ["zog" + x for x in ("ab", "cd", "ef")]
    texts, marks = [], []
    for _ in range(500):
        w = sentence(rng, rng.choice([10, 60, 300])).split()
        y = rng.random() < 0.25
        for _ in range(rng.randrange(2, 9) if y else 0):
            w[rng.randrange(len(w))] = rng.choice(bad)
        texts.append(" ".join(w))
        marks.append(int(y))
    d = docs(spark, [*texts, "", None])
    labels = spark.createDataFrame([(i, m) for i, m in enumerate(marks) if i < 300], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(d, labels).collect()}
    assert len(got) == 502 and not got[500].toxic and not got[501].toxic
    assert np.mean([got[i].toxic == bool(marks[i]) for i in range(300, 500)]) > 0.97
    assert all(0 <= r.severity <= 3 for r in got.values())
    assert toxicity.toxicity(d.limit(0), labels).count() == 0
    assert not any(r.toxic for r in toxicity.toxicity(d.limit(5), labels.limit(0)).collect())


def test_quality_held_out(spark, data):
    d, labels = table(spark, data, "documents"), table(spark, data, "labels")
    marks = {r.doc_id: r.quality for r in labels.collect()}
    got = quality.quality(d, labels).collect()
    held = [r for r in got if r.held_out and r.doc_id in marks]
    assert len(got) == d.count() and held
    assert np.mean([r.predicted == marks[r.doc_id] for r in held]) >= 0.8
    empty = quality.quality(docs(spark, ["", None], [None, 3]), labels).collect()
    assert all(0 <= r.score <= 1 for r in empty) and [r.held_out for r in empty if r.doc_id is None] == [False]
    assert quality.quality(d.limit(0), labels).count() == 0


def test_language_held_out(spark, data):
    d = table(spark, data, "documents")
    truth = {r.doc_id: r.lang for r in d.collect()}
    got = langid.language_id(d).collect()
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.9 and all(0 <= r.score <= 1 for r in got)
    odd = d.select("doc_id", "text", "lang").union(spark.createDataFrame([(None, None, None), (-1, "123 !!", "en"), (-2, "", None)], "doc_id long, text string, lang string"))
    rows = {r.doc_id: r.lang_pred for r in langid.language_id(odd).collect()}
    assert rows[None] == rows[-1] == rows[-2] == "und"
    assert langid.language_id(d.limit(0)).count() == 0


def test_numerals_are_no_letters(spark):
    texts = {1: "\u00b2", 2: "\u00bd \u00be \u2460", 3: "12_3", 4: "\u00bdx", 5: "\u65e5\u672c"}
    assert {i for i, t in texts.items() if langid.has_letter(t)} == {4, 5}
    rows = [(100 + i, "der die das und ist" if i % 2 else "the of and is to", "de" if i % 2 else "en") for i in range(40)] + [(i, t, None) for i, t in texts.items()]
    got = {r.doc_id: r for r in langid.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("label", F.lit(0))).collect()}
    assert all((got[i].lang_pred == "und") == (i < 4) for i in texts) and got[101].lang_pred == "de"


def test_more_than_a_thousand_languages(spark):
    """Each label that the sample holds is learned; none is left out or breaks the fit. Repeated rows are predicted alike."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda i: letters[i // 676] + letters[i // 26 % 26] + letters[i % 26]
    rows = [(i, f"{word(i % 1200)} {word(i % 1200)}", f"l{i % 1200:04}") for i in range(2400)]
    got = langid.language_id(spark.createDataFrame(rows + rows[:9], "doc_id long, text string, lang string"), passes=1).collect()
    assert len(got) == 2409 and {r.lang_pred for r in got} <= {r[2] for r in rows} and len({(r.doc_id, r.lang_pred, r.score) for r in got}) == 2400


def test_scores_follow_the_published_rule(spark):
    """The softmax of the weighted n-grams over the temperature, term by term, for every row of a small table."""
    grams = langid.gram_counts("ab")
    assert grams.sum() == 3 and langid.gram_counts(None).sum() == 0
    idf = np.linspace(1, 2, 1 << langid.BITS).astype(np.float32)
    idx, val = langid._row("abab cd", idf)
    counts = langid.gram_counts("abab cd")
    plain = {int(i): (1 + math.log(counts[i])) * float(idf[i]) for i in np.flatnonzero(counts)}
    length = math.sqrt(sum(x * x for x in plain.values()))
    assert sorted(plain) == sorted(idx.tolist()) and all(abs(v - plain[int(i)] / length) < 1e-5 for i, v in zip(idx, val, strict=True))


def test_hidden_labels_do_not_matter(spark, data):
    """Changing what is held out changes no score."""
    d, labels = table(spark, data, "documents"), table(spark, data, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(quality.quality(d, labels).collect()) == sorted(quality.quality(d, turned).collect())


# pages


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a<p>b", "a\n\nb"),
        ("<ul><li>x<li>y<ol><li>1<li>2</ol></ul>", "- x\n- y\n\n  1. 1\n  2. 2"),
        ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a   | bb\nccc | d"),
        ("a<script>var x='</p>'</script>b<style>p{}</style> <b hidden>no</b><i style='display: none'>no</i>c", "ab c"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("<pre>a\n  b</pre>", "a\n  b"),
        ("x<br>y &amp; &lt;z&gt;", "x\ny & <z>"),
        ("<!-- no --><h1>T</h1>text", "T\n\ntext"),
        ("<title>no</title><p>5 < 6 and <a href='x>y'>link</a></p>", "5 < 6 and link"),
        ("<p>unclosed <b", "unclosed"),
        ("", ""),
        (None, ""),
    ],
)
def test_render(page, text):
    assert html.render(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<table><tr><form><td>text</td></form></tr></table>", "text"),
        ("<table><tbody>a<tr>b<td>c</td><div>d</div></tr></tbody></table>", "a\nb\nd\nc"),
        ("<table><tr hidden>a<td>b</td></tr><tr><td>c</td></tr></table>", "c"),
        ("<html><head><title>t</title><h1>A</h1><p>B", "A\n\nB"),
        ("<head><meta charset=x><title>t</title>\n<style>s</style>Text", "Text"),
        ("<head><template><p>no</p></template><script>x</script></head><body>A", "A"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
        ("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e<tbody><tr><td>f<td>g</table>", "a | b | c\nd |   | e\nf | g"),
        ("<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c</table>", "a |  | b\n  |  | c"),
        ("<table><tr><td rowspan=x colspan=>a<td rowspan=-1>b<tr><td>c<td>d</table>", "a | b\nc | d"),
        ("<div style='visibility:hidden'>no<p style='visibility:visible'>yes</p><img alt=no></div>", "yes"),
        ("<div style='visibility: hidden'><b>no</b><ul><li>no<li style='visibility:visible'>yes</ul></div>", "- yes"),
        ("<div style='display:none'>no<p style='visibility:visible'>no</p></div>a", "a"),
        ("<p style='visibility:visible'>a<b style='VISIBILITY:collapse'>no</b> visibility", "a visibility"),
    ],
)
def test_render_without_optional_tags(page, text):
    assert html.render(page) == text


def test_render_survives_depth_and_noise(spark):
    assert "x" in html.render("<div>" * 5000 + "x")
    rng = random.Random(10)
    for _ in range(200):
        html.render("".join(rng.choice(["<", ">", "a", "<p>", "</p", "<td>", "\"", "'", "<table>", "<!--", "&#x", "<li>", " "]) for _ in range(60)))
    rows = html.extract(spark.createDataFrame([(1, "<p>a<p>b", 3), (None, None, 4)], "page_id long, html string, text int")).collect()
    assert {(r.page_id, r.text, r.n_lines) for r in rows} == {(1, "a\n\nb", 3), (None, "", 0)}


class Plain(HTMLParser):
    """Words of a page by a plain walk over its tags: what is in an element that hides is left out."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.open, self.words = [], []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        hides = tag in html.UNSEEN or "hidden" in a or "none" in a.get("style", "") or (tag == "dialog" and "open" not in a) or "visibility" in a.get("style", "")
        shown = not hides and not any(h for _, h in self.open)
        if shown and tag == "img":
            self.words += a.get("alt", "").split()
        if shown and tag == "input" and a.get("type", "text") in ("text", "submit", "button", "reset", "search", ""):
            self.words += a.get("value", "").split()
        if tag not in html.VOID:
            self.open.append((tag, hides))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, text):
        if not any(h for _, h in self.open):
            self.words += text.split()


def test_pages_keep_all_visible_words(spark, data):
    """Against a plain walk, on all pages: every visible word is there as often, and no other."""
    pages = table(spark, data, "pages").collect()
    marks = re.compile(r"^(-|---|\||\d+\.)$")
    for r in pages:
        want, got = (collections.Counter(w for w in ws if not marks.match(w)) for ws in (Plain(r.html).words, html.render(r.html).split()))
        assert want == got, r.page_id


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<!-->x<!-- y --!>z<!--->a<!-- - -- -->b", "xzab"),
        ("<p style='display:none;display:block'>shown</p><p style='display:block;DISPLAY : none'>no</p>", "shown"),
        ("<p style='display:none;display:bogus'>no</p><p style='display:none!important;display:block'>no</p>yes", "yes"),
        ("<p style='/*display:none*/;color:red'>shown</p>", "shown"),
        ("<dialog>no</dialog>a<dialog open>b</dialog>", "a\nb"),
        ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"),
        ("<ol reversed><li>a<li>b</ol><ol start=-1><li>x<li>y</ol>", "2. a\n1. b\n\n-1. x\n0. y"),
        ("<table><tr><td>\u65e5\u672c<td>x<tr><td>abc<td>e\u0301<td>y</table>", "\u65e5\u672c | x\nabc  | e\u0301 | y"),
        ("<div>" * 300 + "<ul><li>it<p style='display:none'>no</ul>", "- it"),
        ("<div>" * 520 + "<div hidden>" + "<div>" * 2000 + "no" + "</div>" * 2000 + "</div>yes", "yes"),
        ("<div>" * 3000 + "<p style='display:none'>no</p>" + "</div>" * 3000 + "after", "after"),
        ("<table><tr><td colspan=400>a<td>b<tr><td>c</table>", "a" + " | " * 400 + "b\nc"),
    ],
)
def test_render_as_browsers_do(page, text):
    same = lambda s: re.sub(r"[ |]+", " ", s) if "colspan" in page else s
    assert same(html.render(page)) == same(text)


# search


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    x = rng.integers(-3, 4, (700, 8))
    x[50:90] = x[50]
    rows = [(i, [int(v) for v in x[i]]) for i in range(700)]
    df = spark.createDataFrame([*rows, (None, [1] * 8), (9000, None)], "vec_id long, v array<long>")
    old = topk.SHARD, topk.BLOCK, topk.LEAF
    topk.SHARD, topk.BLOCK, topk.LEAF = 100, 16, 8
    try:
        got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, 5).collect()}
    finally:
        topk.SHARD, topk.BLOCK, topk.LEAF = old
    want = {}
    for q in range(0, 700, 20):
        s = sorted((-int(x[q] @ x[i]), i) for i in range(700) if i != q)[:5]
        want |= {(q, k + 1): (i, -v) for k, (v, i) in enumerate(s)}
    assert got == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert topk.top_k(spark.createDataFrame(rows[:3], "vec_id long, v array<long>"), F.col("vec_id") % 2 == 0).count() == 4


def test_top_k_of_groups_far_apart(spark, monkeypatch):
    """Most shards hold nothing for a block, and copies of one vector fill several shards."""
    monkeypatch.setattr(topk, "SHARD", 30)
    rng = np.random.default_rng(4)
    x = np.concatenate([1000 * np.eye(4, dtype=int)[rng.integers(0, 4, 200)] + rng.integers(-9, 10, (200, 4)), np.tile([1000, 0, 0, 0], (100, 1))])
    df = spark.createDataFrame([(i, [int(v) for v in x[i]]) for i in range(300)] + [(0, [int(v) for v in x[0]])], "vec_id long, v array<long>").withColumns({"c": F.lit(1), "shard": F.lit("s"), "block": F.lit(2)})
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, 3).collect()}
    ids = [*range(300), 0]
    x = np.concatenate([x, x[:1]])
    want = {}
    for q in range(0, 300, 10):
        s = sorted((-int(x[q] @ x[i]), ids[i]) for i in range(301) if ids[i] != q)[:3]
        want |= {(q, k + 1): (i, -v) for k, (v, i) in enumerate(s)}
    assert got == want


def test_embedding_vectors(spark):
    rows = [(1, [0.5, -0.01]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0])]
    got = topk.embedding_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert [(r.vec_id, r.v) for r in got] == [(1, [32, -1])]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    df = queries.QUERIES[name](spark, data)
    want = con.sql(queries.ORACLE_SQL[name])
    at = [want.columns.index(c) for c in df.columns]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=key)


# pipeline


def test_stages_of_odd_tables(spark, data):
    """Nulls, repeated rows, clashing columns and empty tables: each stage returns its rows with their columns."""
    import corpus_pipeline as cp

    rng = random.Random(30)
    fine = sentence(rng, 60)
    rows = [(None, fine, None, None), (None, fine, None, None), (1, None, "en", "a"), (2, "", "en", "a"), (3, sentence(rng, 50), "en", "b"), (3, sentence(rng, 50), "en", "b"), (4, "x " * 3000, None, "b")]
    extra = ["size", "taken", "target", "toxic", "severity", "row", "g_id", "text_digest", "cuts", "rep", "id", "key", "gone_id"]
    d = spark.createDataFrame(rows, DOC)
    for c in extra:
        d = d.withColumn(c, F.lit(c))
    want = collections.Counter((r[0], r[1]) for r in rows)
    for i, (name, stage) in enumerate(cp.STAGES):
        got = stage(spark, d, data)
        out = collections.Counter((r.doc_id, r.text) for r in got.collect())
        if i < 4:
            assert got.columns == d.columns and out == want, name
        else:
            assert not out - want and all(t for _, t in out) and set(got.columns) == {*d.columns, "source_size"}
            assert sum(r.taken for r in got.collect()) >= 0.5 * sum(len((t or "").split()) * k for (_, t), k in want.items())
        assert stage(spark, d.limit(0), data).count() == 0


def test_rows_without_an_id_are_judged(spark, data):
    import corpus_pipeline as cp

    item = table(spark, data, "benchmark").first().text
    d = docs(spark, ["word " * 30 + item, "clean words only"], [None, None]).union(table(spark, data, "documents").select("doc_id", "text", "lang", "source"))
    assert [r.text for r in cp.decontaminate(spark, d, data).filter("doc_id is null").collect()] == ["clean words only"]


def test_pipeline_stages(spark, data):
    """Each stage against a plain computation on what the stage before it kept."""
    import corpus_pipeline as cp

    scratch, d = Scratch(spark), table(spark, data, "documents")
    columns = d.columns
    for i, (_, stage) in enumerate(cp.STAGES):
        before, d = {r.doc_id: r for r in d.collect()}, scratch.save(stage(spark, d, data), f"t{i}")
        after = {r.doc_id: r for r in d.collect()}
        assert set(after) <= set(before)
        if i < 4:
            assert d.columns == columns
        if i == 0:
            bad = re.compile(r"\b(clown|idiot|disgusting|loser|stupid|moron|pathetic|trash|worthless|scum)\b", re.I)
            hit = {k for k, r in before.items() if bad.search(r.text)}
            assert len(hit - set(after)) >= 0.8 * len(hit)
        elif i == 1:
            want = components({k: shingles(r.text) for k, r in before.items()})
            assert set(after) == {k for k in before if want[k] == k}
        elif i == 2:
            assert set(after) == set(before) and all(len(after[k].text) <= len(before[k].text) for k in after)
        elif i == 3:
            items = [x.text.lower().split() for x in table(spark, data, "benchmark").collect()]
            held = {k for k, r in before.items() if any(" ".join(w) in " ".join(r.text.lower().split()) for w in items)}
            assert not held & set(after)
        else:
            assert set(after) and all(r.taken > 0 for r in after.values())
