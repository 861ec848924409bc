"""Operators whose plans must not depend on one long interval, one hot key or one range: against plain rules, at small sizes."""

import itertools
import math
import random
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrid.functions import scalar as S
from cellgrid.operators import barcodes, edges, graph, merge_atac, ml, ranges, rna
from cellgrid.sources import files, reports

INTERVAL = "chr string, start long, stop long, id long"


def intervals(rng, n, longest):
    """Lengths from 1 to longest, evenly over their orders of magnitude; a few empty ones and repeated rows."""
    out = []
    for i in range(n):
        start = rng.randrange(-50, 3000)
        out.append((rng.choice("ab"), start, start + int(longest ** rng.random()), i))
    return out + out[:3] + [("a", 100, 100, n), (None, 1, 5, n + 1), ("b", None, 9, n + 2)]


@pytest.mark.parametrize("how", [{}, {"closed": True}, {"ends_only": True}, {"bin_size": 1}, {"bin_size": 7, "closed": True}])
def test_overlaps_of_all_lengths(spark, how):
    rng = random.Random(3)
    a, b = intervals(rng, 70, 4000), intervals(rng, 60, 900)
    left, right = (spark.createDataFrame(x, INTERVAL).repartition(3) for x in (a, b))
    got = sorted((r.id, r.r_id) for r in ranges.overlap_join(left, right, **{"bin_size": 10, **how}).collect())

    def meets(x, y):
        if None in x[:3] or None in y[:3] or x[0] != y[0]:
            return False
        if how.get("closed"):
            return x[1] <= y[2] and y[1] <= x[2]
        return x[1] < y[2] and y[1] < x[2] and (not how.get("ends_only") or x[1] >= y[1] or x[2] <= y[2])

    assert got == sorted((x[3], y[3]) for x in a for y in b if meets(x, y))


def test_rows_of_an_interval_do_not_grow_with_its_length(spark):
    """A stretch of 50 million bases becomes as many rows as a short one: two bins for each level at most."""
    reads = spark.range(200).select(F.lit("c").alias("chr"), (F.col("id") * 1000).alias("start"), (F.col("id") * 1000 + 90).alias("stop"))
    for length in (500, 2_000_000, 50_000_000):
        long_one = spark.createDataFrame([("c", 7, 7 + length)], "chr string, start long, stop long")
        a, b = ranges._levelled(reads, 1000, False), ranges._levelled(long_one, 1000, False)
        assert ranges._placed(b, a, 1000, False).count() <= 4
        assert ranges._placed(a, b, 1000, True).count() <= 2 * 200
        assert ranges.overlap_join(reads, long_one).count() == min(200, -(-(7 + length) // 1000))


def test_blocklist_of_a_long_stretch(spark):
    reads = spark.createDataFrame([("c", 5, 9, "x"), ("c", 900, 950, "x"), ("c", 2_000_000, 2_000_050, "y"), ("d", 5, 9, "z")], "chr string, start long, stop long, read_name string")
    block = spark.createDataFrame([("c", 800, 1_000_000)], "chr string, start long, stop long")
    assert sorted(r.read_name for r in ranges.drop_blocklisted(reads, block).collect()) == ["y", "z"]


def directional(counts, threshold):
    """The published rule for the UMI pairs of one bead pair, from the commonest down: (umi1, umi2) -> (n, corrected)."""
    items, taken, out = sorted(counts, key=lambda u: (-counts[u], u)), set(), {}
    near = lambda x, y: all(len(a) == len(b) for a, b in zip(x, y)) and sum(p != q for a, b in zip(x, y) for p, q in zip(a, b)) <= threshold
    for seed in items:
        if seed in taken:
            continue
        taken.add(seed)
        todo, n, moved = [seed], counts[seed], 0
        while todo:
            at = todo.pop()
            for u in items:
                if u not in taken and near(at, u) and counts[at] >= 2 * counts[u] - 1:
                    taken.add(u)
                    todo.append(u)
                    n, moved = n + counts[u], moved + counts[u]
        out[seed] = (n, moved)
    return out


@pytest.mark.parametrize("threshold", [1, 2])
def test_umi_correction_matches_the_plain_rule(spark, threshold):
    """Random groups, one bead pair with most of the rows, UMIs of several lengths."""
    rng = random.Random(threshold)
    umi = lambda: "".join(rng.choice("ACGT") for _ in range(rng.choice([2, 3, 3])))
    counts = {}
    for pair, size in ((("a", "b"), 60), (("a", "c"), 12), (("b", "c"), 5)):
        for _ in range(size):
            counts.setdefault(pair, {})[umi(), umi()] = int(2 ** rng.uniform(0, 5))
    rows = [(p[0], u[0], p[1], u[1]) if rng.random() < 0.5 else (p[1], u[1], p[0], u[0]) for p, us in counts.items() for u, n in us.items() for _ in range(n)]
    got = {(r.bead1, r.bead2, r.umi1, r.umi2): (r.n, r.corrected) for r in edges.correct_edge_umis(spark.createDataFrame(rows, edges.EDGE), threshold).collect()}
    assert got == {(*p, *u): x for p, us in counts.items() for u, x in directional(us, threshold).items()}


def test_umi_correction_of_odd_tables(spark):
    assert edges.correct_edge_umis(spark.createDataFrame([], "bead1 string, umi1 string, bead2 string, umi2 string")).count() == 0
    rows = [("a", "", "b", ""), ("a", "", "b", ""), ("a", "A", "b", None), ("a", "C", "b", None), (None, "A", "b", "A"), (None, "C", "b", "A")]
    got = edges.correct_edge_umis(spark.createDataFrame(rows, "bead1 string, umi1 string, bead2 string, umi2 string").withColumn("node", F.lit(1)))
    assert sorted(r.n for r in got.collect()) == [1, 1, 1, 1, 2]


@pytest.mark.parametrize("block", [1024, 8, 1])
def test_pairs_of_a_hot_site(spark, block):
    """One site holds most beads: pairs are the same whatever the blocks, and no key holds more than two blocks."""
    rng = random.Random(4)
    rows = [("c", "start", 5, f"b{i:03}") for i in range(60) for _ in range(rng.randrange(1, 3))] + [("c", "stop", p, f"b{rng.randrange(60):03}") for p in range(9) for _ in range(4)] + [("c", "stop", 1, None)]
    got = {}
    for r in merge_atac.site_pairs(spark.createDataFrame(rows, "chr string, side string, pos long, bead string"), block).collect():
        got.setdefault((r.b1, r.b2), []).append(r.n)
    want = {}
    for site in {r[:3] for r in rows}:
        beads = [r[3] for r in rows if r[:3] == site and r[3]]
        for x, y in itertools.combinations(sorted(set(beads)), 2):
            want.setdefault((y, x), []).append(beads.count(x) * beads.count(y))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def thinned(points, n):
    points = sorted(points)
    s = [max(p[i] for p in points) - min(p[i] for p in points) or 1e-12 for i in (0, 1)]
    steps = [0.0] + [math.hypot(*((q[i] - p[i]) / s[i] for i in (0, 1))) for p, q in zip(points, points[1:])]
    at, total, seen, out = 0.0, sum(steps) or 1.0, set(), []
    for p, step in zip(points, steps):
        at += step
        bucket = math.floor(round(at / total, 9) * n)
        if bucket not in seen or p[0] == points[-1][0]:
            out.append(p)
        seen.add(bucket)
    return out


def test_thin_curve_over_many_ranges(spark):
    rng = random.Random(7)
    curves = {"one": [(i, 1 / (i + 1) + rng.random() / 50) for i in range(700)], "few": [(1, 2.0), (2, 1.0)], "flat": [(5, 1.0)] * 3}
    df = spark.createDataFrame([(k, float(x), float(y)) for k, ps in curves.items() for x, y in ps] + [("one", None, 1.0)], "sample string, x double, y double")
    got = {}
    for r in barcodes.thin_curve(df, "x", "y", 20).collect():
        got.setdefault(r["sample"], []).append((r.x, r.y))
    assert {k: sorted(v) for k, v in got.items()} == {k: [(float(x), float(y)) for x, y in thinned(ps, 20)] for k, ps in curves.items()}
    assert barcodes.thin_curve(df.limit(0), "x", "y", 20).count() == 0


def test_clean_peaks_match_rounds(spark):
    """Peaks of one contig over several ranges, with ties, cleaned with the default way to cut lineage."""
    rng = random.Random(8)
    rows = [("c", rng.randrange(200, 60_000), f"p{i:03}", float(rng.randrange(2, 9))) for i in range(400)] + [("d", 500, "d1", 3.0), ("d", None, "d2", 3.0), ("d", 510, "d3", None), ("chrM", 500, "m", 9.0)]
    sizes = spark.createDataFrame([("c", 60_000), ("d", 600), ("chrM", 900)], "chr string, length long")
    block = spark.createDataFrame([("c", 10_000, 12_000)], "chr string, start long, stop long")
    got = sorted(tuple(r) for r in ranges.clean_peaks(spark.createDataFrame(rows, "chr string, pos long, name string, score double"), block, sizes).collect())
    left = sorted((p - 125, n, p + 125, s) for c, p, n, s in rows if c == "c" and p >= 125 and p + 125 <= 60_000 and not (p - 125 < 12_000 and 10_000 < p + 125))
    while True:
        bad = {i for i, (start, _, stop, score) in enumerate(left) if i and left[i - 1][2] > start and left[i - 1][3] >= score or i + 1 < len(left) and left[i + 1][0] < stop and left[i + 1][3] > score}
        if not bad:
            break
        left = [p for i, p in enumerate(left) if i not in bad]
    assert got == sorted([("c", start, stop, name, score) for start, name, stop, score in left] + [("d", 375, 625, "d1", 3.0)] * (600 >= 625))


def cut(qual, cutoff):
    best, keep, total = 0, len(qual), 0
    for i in range(len(qual) - 1, -1, -1):
        total += cutoff - (ord(qual[i]) - 33)
        if total < 0:
            break
        if total > best:
            best, keep = total, i
    return keep


def test_quality_cut_of_all_lengths(spark):
    rng = random.Random(9)
    quals = ["".join(rng.choice("#+5@I") for _ in range(n)) for n in [*range(12), 40, 200, 60_000]] + ["I" * 9 + "#" * 9, "\n#I"]
    df = spark.createDataFrame([(i, q) for i, q in enumerate(quals)] + [(-1, None)], "i long, q string")
    assert {r[0]: r[1] for r in df.select("i", S.quality_cut("q")).collect()} == {-1: None} | {i: cut(q, 20) for i, q in enumerate(quals)}


def test_density_on_the_whole_grid(spark):
    rng = np.random.default_rng(2)
    x = 10 ** np.concatenate([rng.normal(-3, 0.3, 300), rng.normal(-1, 0.2, 60)])
    df = spark.createDataFrame([(float(v),) for v in x] + [(0.0,), (None,), (-1.0,)], "x double")
    grid = merge_atac.density(df, "x").orderBy("i").toPandas()
    v = np.log10(x)
    at = np.linspace(v.min(), v.max(), 10_000)
    plain = np.exp(-(((at[:, None] - v) / 0.1) ** 2) / 2).mean(axis=1) / (0.1 * math.sqrt(2 * math.pi))
    assert (grid["i"] == np.arange(10_000)).all() and np.allclose(grid["x"], at) and np.abs(grid["density"] - plain).max() < 1e-4
    low = at[(at > -2.5) & (at < -1.3)][plain[(at > -2.5) & (at < -1.3)].argmin()]
    assert merge_atac.density_threshold(merge_atac.density(df, "x")).first()["safe"] == pytest.approx(10**low, rel=0.02)
    assert merge_atac.density(df.limit(0), "x").count() == 0
    assert [tuple(r) for r in merge_atac.density(spark.createDataFrame([(0.01,), (0.01,)], "x double"), "x").collect()] == [(0, -2.0, pytest.approx(1 / (0.1 * math.sqrt(2 * math.pi))))]


@pytest.mark.parametrize("split", [97, 1000, 1 << 20])
def test_fastq_in_splits(spark, tmp_path, split):
    """Qualities full of @, in files that are read in many splits, equal the plain parse."""
    rng = random.Random(split)
    want = []
    for f in range(2):
        lengths = [rng.randrange(1, 9) for _ in range(60)]
        reads = [(f"r{f}.{i}", "".join(rng.choices("ACGT", k=n)), "".join(rng.choices("@@@I+", k=n))) for i, n in enumerate(lengths)]
        (tmp_path / f"s{f}.fastq").write_text("".join(f"@{n} more\n{s}\n+{n if i % 7 == 0 else ''}\n{q}\n" for i, (n, s, q) in enumerate(reads)))
        want += reads
    was = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        got = [(r.name, r.seq, r.qual) for r in files.read_fastq(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was[0])
        spark.conf.set("spark.sql.files.openCostInBytes", was[1])
    assert sorted(got) == sorted(want)


def test_independent_set_of_a_long_chain(spark, monkeypatch):
    """A chain of falling counts is decided by doubling, not link by link."""
    n, cuts = 3000, []
    cut = graph.checkpoint
    monkeypatch.setattr(graph, "checkpoint", lambda df, _=0: (cuts.append(1), cut(df))[1])
    nodes = spark.createDataFrame([(i, i) for i in range(n)] + [(n + 5, n + 5)], "node long, rank long")
    links = spark.createDataFrame([(i + 1, i) for i in range(n - 1)] + [(7, 7), (3, 2)], "a long, b long")
    assert sorted(r.node for r in graph.first_independent_set(nodes, links).collect()) == [*range(0, n, 2), n + 5]
    assert len(cuts) <= 40


@pytest.mark.parametrize("seed", range(3))
def test_independent_set_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    n = 60
    links = {(a, b) for a in range(n) for b in [rng.randrange(n) for _ in range(rng.randrange(3))] if a != b}
    rank = rng.sample(range(n), n)
    got = {r.node for r in graph.first_independent_set(spark.createDataFrame(list(enumerate(rank)), "node long, rank long"), spark.createDataFrame(sorted(links), "a long, b long")).collect()}
    want: set[int] = set()
    for v in sorted(range(n), key=lambda v: rank[v]):
        if not any((v, u) in links or (u, v) in links for u in want):
            want.add(v)
    assert got == want


def test_report_sections(spark, tmp_path):
    head = "# tool 1.0\n## METRICS CLASS\tx.Y\n\nCATEGORY\tTOTAL_READS\tPCT_PF\tLIBRARY\n"
    (tmp_path / "a.b_summary.txt").write_text(head + "FIRST_OF_PAIR\t10\t0.5\tlib\nSECOND_OF_PAIR\t8\t\nPAIR\t18\t1\tlib\textra\n\n## HISTOGRAM\tInteger\r\ninsert_size\tAll_Reads.fr_count\tAll_Reads.rf_count\n20\t5\t0\n30\t2\t1\n")
    (tmp_path / "c_summary.txt").write_text("## METRICS CLASS\tdup\nLIBRARY\tREADS\tPERCENT_DUPLICATION\nlib\t10\t0.25\n\n## HISTOGRAM\n")
    (tmp_path / "d_summary.txt").write_text("no section\nA\tB\n")
    s = reports.read_sections(spark, str(tmp_path))
    assert sorted(tuple(r) for r in reports.alignment_summary(s).collect()) == sorted(
        [("a", "alignment_summary", m, "total_reads", float(n)) for m, n in (("r1", 10), ("r2", 8), ("pair", 18))] + [("a", "alignment_summary", "r1", "pct_pf", 50.0), ("a", "alignment_summary", "pair", "pct_pf", 100.0)]
    )
    assert sorted(tuple(r) for r in reports.insert_size_histogram(s).collect()) == [("a", 20, "fr_count", 5), ("a", 20, "rf_count", 0), ("a", 30, "fr_count", 2), ("a", 30, "rf_count", 1)]
    assert {tuple(r) for r in reports.one_row_metrics(s).filter("sample = 'c_summary'").collect()} == {("c_summary", "reads", 10.0), ("c_summary", "percent_duplication", 25.0)}
    assert s.filter("sample = 'd_summary'").count() == 0


def test_contig_counts(spark, tmp_path):
    (tmp_path / "s1_idxstats.txt").write_text("chr1\t1000\t12\t3\n*\t0\t0\t7\nbroken line\n")
    got = reports.tidy_contig_counts(reports.contig_counts(spark, str(tmp_path))).collect()
    assert {(r.metric, r.value) for r in got} == {("chr1_contig_length", 1000.0), ("chr1_reads_aligned", 12.0), ("chr1_reads_unaligned", 3.0), ("*_contig_length", 0.0), ("*_reads_aligned", 0.0), ("*_reads_unaligned", 7.0)}


def test_a_cluster_needs_a_shared_folder():
    session = lambda master, path: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: path), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master=master))
    assert graph.shared_dir(session("yarn", "store://x")) == "store://x"
    for master in ("yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="checkpoint"):
            graph.shared_dir(session(master, None))


@pytest.mark.parametrize("threshold", [1, 2])
def test_umi_correction_by_rows_and_by_keys(spark, threshold, monkeypatch):
    """Bead pairs of few edges need no masked keys, and both ways give the same rows."""
    rng = random.Random(7)
    umi = lambda: "".join(rng.choice("AC") for _ in range(4))
    rows = [(f"b{rng.randrange(3)}", umi(), f"c{rng.randrange(3)}", rng.choice(["G", "GG", "T"])) for _ in range(400)] + [("x", "A", "y", None), (None, "A", "y", "A")]
    e = spark.createDataFrame(rows, edges.EDGE)
    mixed, by_keys = (sorted(map(tuple, edges.correct_edge_umis(e, threshold, held).collect()), key=str) for held in (50, 0))
    assert mixed == by_keys and any(r[5] for r in mixed)
    monkeypatch.setattr(edges, "umi_links", None)
    few = e.dropna()
    assert sorted(map(tuple, edges.correct_edge_umis(few, threshold).collect()), key=str) == [r for r in by_keys if None not in r]


def test_gaps_behind_the_contigs_end(spark):
    df = spark.createDataFrame([("a", 3, 5), ("a", 12, 14), ("a", 20, 22), ("b", 2, 4)], "chr string, start long, stop long")
    sizes = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10)], "chr string, length long")
    got = sorted(map(tuple, ranges.complement_intervals(df, sizes, ["chr"]).collect()))
    assert got == [("a", 0, 3), ("a", 5, 12), ("a", 14, 20), ("b", 0, 2), ("b", 4, 10), ("c", 0, 10)]


def test_vectors_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def values(i):
        made.add(1)
        return [float(i % 7), float(i % 5), float(i % 3)]

    v = spark.range(60).select(F.col("id").cast("string").alias("cell"), ml.array_to_vector(values("id")).alias("v"))
    assert ml.cluster(ml.pca(v, 2), 3).count() == 60
    assert made.value == 60


def test_cells_are_summed_without_copies_of_reads(spark):
    """No row is made for each kind of distinct count."""
    rows = [("c", "hs.1", "G", "EXON", "Assigned", "u", False), ("c", "hs.1", "G", "UTR", "Assigned", "u", True), ("c", "hs.2", "G", "EXON", "Assigned", "u", False), ("c", "hs.MT", "INTRON", "INTRON", "Assigned", None, False), ("d", "mm.1", None, None, "Unassigned_X", "u", False)]
    df = rna.expression_summary(spark.createDataFrame(rows, "cell string, contig string, gene string, feature string, status string, umi string, ribosomal boolean"), species=["hs", "mm"])
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r.cell: r for r in df.collect()}
    assert [got["c"][x] for x in ("input_reads", "genes", "umi", "transcripts", "genic_reads", "mitochondrial_reads", "rRNA_reads", "hs_umi", "mm_umi")] == [4, 3, 3, 2, 3, 1, 1, 3, 0]
    assert [got["d"][x] for x in ("input_reads", "genes", "umi", "unassigned_other_reads", "input_mm_reads", "mm_umi")] == [1, 0, 0, 1, 1, 0]


def test_bases_are_trimmed_in_arrays(spark):
    df = spark.createDataFrame([(1, "I" * 5 + "#" * 3), (2, ""), (3, None)], "i int, q string").select("i", S.quality_cut("q").alias("keep"))
    assert "ArrowEvalPython" in df._jdf.queryExecution().executedPlan().toString()
    assert dict(map(tuple, df.collect())) == {1: 5, 2: 0, 3: None}


def test_tags_are_parsed_without_patterns(spark):
    tags = {"a_EXON,b_INTRON": ("a", "EXON", 1), "a_EXON,a_UTR": ("a", "UTR", 1), "a_b_UTR": ("a_b", "UTR", 1), "EXON": ("EXON", None, 0), "a_INTRON": ("INTRON", None, 0), None: (None, None, 0)}
    df = spark.createDataFrame([(t,) for t in tags], "t string").select("t", S.assign_feature("t").alias("a")).select("t", "a.*")
    assert "regexp" not in df._jdf.queryExecution().executedPlan().toString()
    assert {r[0]: tuple(r)[1:] for r in df.collect()} == tags


def test_shares_in_peaks_by_whole_intervals(spark):
    """Fragments are told apart by all their columns, not by a digest."""
    frags = spark.createDataFrame([("a", 0, 10, "c", "x"), ("a", 0, 10, "c", "y"), ("a", 0, 50, "c", "x"), ("a", 90, 95, "c", "x")], "chr string, start long, stop long, cell string, read_name string")
    df = ranges.frip_by_cell(spark.createDataFrame([("a", 5, 8), ("a", 40, 45)], "chr string, start long, stop long"), frags)
    assert "xxhash64" not in df._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in df.collect()] == [("c", 3, 2, 2 / 3)]


def test_beads_of_a_site_move_once(spark):
    """Where no site is hot, what meets is not looked up in a join."""
    at = spark.createDataFrame([("c", "start", 5, "x"), ("c", "start", 5, "y"), ("c", "start", 5, "y"), ("c", "stop", 5, "x")], "chr string, side string, pos long, bead string")
    df = merge_atac.site_pairs(at)
    assert [tuple(r) for r in df.collect()] == [("y", "x", 2)]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_edges_of_components_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def end(i):
        made.add(1)
        return i // 4 * 4

    e = spark.range(12).select(F.col("id").alias("a"), end("id").alias("b")).union(spark.createDataFrame([(None, 40)], "a long, b long"))
    got = {r.node: r.component for r in graph.connected_components(e).collect()}
    assert got == {i: i // 4 * 4 for i in range(12)} | {None: None, 40: 40}
    assert made.value == 12


def tables_left(spark):
    """Folders of the shared folder that hold parts of a table."""
    return {str(p.parent) for p in Path(spark.conf.get("spark.checkpoint.dir")).rglob("part-*")}


def test_rounds_of_components_leave_two_tables(spark):
    before = tables_left(spark)
    links = spark.range(500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in graph.connected_components(links).collect()} == {0}
    assert len(tables_left(spark) - before) <= 2


def test_one_clean_edge_joins_beads(spark):
    rows = [("a", "A", "b", "C"), ("b", "NA", "c", "C"), ("c", "A", "d", None), ("e", "A", "f", "T"), ("f", "G", "e", "T"), ("f", "G", "f", "T")]
    df = spark.createDataFrame(rows, edges.EDGE)
    for least, pairs in ((1, {"a": "ab", "b": "ab", "e": "ef", "f": "ef"}), (2, {"e": "ef", "f": "ef"})):
        want = {(x, pairs.get(x, x)[0], len(pairs.get(x, x))) for x in "abcdef"}
        assert set(map(tuple, edges.merge_beads(df, least).collect())) == want
        plan = edges.merge_beads(df, least)._jdf.queryExecution().optimizedPlan().toString()
        assert "umi1" not in plan  # the components alone are read


def test_rows_of_a_hot_fragment_stay_where_they_are(spark):
    """Rows move once; a fragment with many rows sends one too many at most from each task. Null sites are sites of their own."""
    rows = [("c", 1, 2, f"b{i}", 1) for i in range(500)] + [("c", 1, 3, f"b{i}", 1) for i in range(6)] + [("c", None, 3, "x", None), ("c", None, 3, "y", 1)]
    df = spark.createDataFrame(rows, "chr string, start long, stop long, bead string, support long").repartition(3).localCheckpoint()
    out = merge_atac.nc_filter(df)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(*r, 6) for r in rows[500:506]] + [(*r, 2) for r in rows[506:]], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Join" not in plan


@pytest.mark.parametrize("block", [1024, 3])
def test_fragments_of_a_chain_are_made_once(spark, block, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def start(i):
        made.add(1)
        return i and 10 * i

    monkeypatch.setattr(merge_atac.site_pairs, "__defaults__", (block,))
    rows = [(i % 9, f"b{(i * i) % 11:02}") for i in range(300)] + [(None, "b01"), (None, "b02"), (2, None)]
    df = spark.createDataFrame(sorted(set(rows), key=str), "i long, bead string").select(F.lit("c").alias("chr"), start("i").alias("start"), (F.length("bead") + F.xxhash64("bead", "i") % 3).alias("stop"), "bead", F.lit(1).alias("support"))
    frags, made.value = [tuple(r) for r in df.collect()], 0
    got = set(map(tuple, merge_atac.bead_pair_jaccard(df, most_rows=9, least_both=1).select("barc1", "barc2", "n_both").collect()))
    want = {}
    for side, at in (("start", 1), ("stop", 2)):
        kept = [r for r in frags if sum(q[:3] == r[:3] for q in frags) <= 9]
        for x, y in itertools.combinations([r for r in kept if r[3] and r[at] is not None], 2):
            if x[at] == y[at] and x[3] != y[3]:
                pair = max(x[3], y[3]), min(x[3], y[3])
                want[pair] = want.get(pair, 0) + 1
    assert got == {(*k, n) for k, n in want.items()}
    assert made.value == len(frags)
