"""Known values and invariants."""

import random

import pytest
from pyspark.sql import functions as F

from cellgrid.functions import scalar as S
from cellgrid.operators import adt, atac, barcodes, edges, graph, merge_atac, numbering, ranges
from cellgrid.sources import files


def test_library_size(spark):
    df = spark.createDataFrame([(140, 139), (115559, 79827), (686, 577), (69, 63), (5, 5)], "t long, u long")
    assert [r[0] for r in df.select(S.library_size("t", "u")).collect()] == [9753, 145942, 1923, 373, None]


def test_components(spark):
    random.seed(3)
    pairs = [(random.randrange(200), random.randrange(200)) for _ in range(150)]
    got = {r[0]: r[1] for r in graph.connected_components(spark.createDataFrame(pairs, "a int, b int")).collect()}
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", range(3))
def test_star_merge(spark, seed):
    """The loop over beads in descending order of counts, against rounds of joins."""
    random.seed(seed)
    beads = [f"b{i:02}" for i in range(25)]
    counts = {b: random.randrange(5) for b in beads}
    links = {tuple(sorted(random.sample(beads, 2))) for _ in range(25)}
    drop: dict[str, int] = {}
    left = set(links)
    for b in sorted(beads, key=lambda b: (-counts[b], b)):
        if b in drop:
            continue
        near = {y if x == b else x for x, y in left if b in (x, y)}
        group = {b} | near
        for old in {drop[x] for x in group if x in drop}:
            group |= {x for x in drop if drop[x] == old}
        for x in group:
            drop[x] = len(drop) + 1000 * beads.index(b)
        number = 1000 * beads.index(b)
        for x in group:
            drop[x] = number
        left = {p for p in left if b not in p}
    want = {frozenset(x for x in beads if drop[x] == d) for d in set(drop.values())}
    got = merge_atac.merge_by_jaccard(spark.createDataFrame(list(counts.items()), "bead string, n int"), spark.createDataFrame([(b, a, 0.5) for a, b in links], "barc1 string, barc2 string, jaccard_frag double"), 0.1).collect()
    groups: dict[str, set] = {}
    for r in got:
        groups.setdefault(r["droplet"], set()).add(r["bead"])
    assert {frozenset(g) for g in groups.values()} == want
    assert all(r["n_beads"] == len(groups[r["droplet"]]) for r in got)


def test_umi_correction(spark):
    rows = [("a", "AAAA", "b", "CCCC")] * 5 + [("b", "CCCC", "a", "AAAT")] * 2 + [("a", "GGGG", "b", "CCCC")] + [("a", "AAAA", "c", "TTTT")]
    got = {(r.bead1, r.umi1, r.bead2, r.umi2): (r.n, r.corrected) for r in edges.correct_edge_umis(spark.createDataFrame(rows, edges.EDGE)).collect()}
    assert got == {("a", "AAAA", "b", "CCCC"): (7, 2), ("a", "GGGG", "b", "CCCC"): (1, 0), ("a", "AAAA", "c", "TTTT"): (1, 0)}


def test_umi_correction_follows_ties(spark):
    """Equal counts form chains, whatever the order of the UMIs."""
    umis = ["AAAA", "CCAA", "CTAA", "TAAA", "TCAA"]
    got = edges.correct_edge_umis(spark.createDataFrame([("a", u, "b", "GGGG") for u in umis], edges.EDGE)).collect()
    assert [(r.umi1, r.n, r.corrected) for r in got] == [("AAAA", 5, 4)]


def test_merged_beads_match_union_find(spark):
    rng = random.Random(31)
    rows = [(f"b{rng.randrange(60):02}", f"u{rng.randrange(4)}", f"b{rng.randrange(60):02}", f"v{i}") for i in range(70)]
    parent = {x: x for r in rows for x in (r[0], r[2]) if r[0] != r[2]}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, _, b, _ in rows:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    want = {x: find(x) for x in parent}
    got = {r.bead: (r.droplet, r.n_beads) for r in edges.merge_beads(spark.createDataFrame(rows, edges.EDGE), 1).collect()}
    assert got == {x: (d, sum(e == d for e in want.values())) for x, d in want.items()}


def test_genes_of_reads(spark):
    """Tags with introns left out and counted; ambiguous reads have no feature."""
    amb = "Unassigned_Ambiguous"
    cases = [
        ("A_INTRON", ("INTRON", None), ("A", "INTRON")),
        ("A_EXON", ("A", "EXON"), ("A", "EXON")),
        ("A_x1_UTR", ("A_x1", "UTR"), ("A_x1", "UTR")),
        ("INTERGENIC", ("INTERGENIC", None), ("INTERGENIC", None)),
        ("A_EXON,B_UTR", ("A", "EXON"), ("A", "EXON")),
        ("A_EXON,B_INTRON", ("A", "EXON"), ("A", "EXON")),
        ("A_EXON,A_UTR", ("A", "UTR"), ("A", "UTR")),
        ("A_EXON,A_INTRON", ("A", "EXON"), ("A", "EXON")),
        ("A_UTR,B_INTRON", ("A", "UTR"), (amb, None)),
        ("A_INTRON,B_INTRON", (amb, None), (amb, None)),
        ("A_EXON,B_EXON", (amb, None), (amb, None)),
        ("A_UTR,B_UTR", (amb, None), (amb, None)),
        ("A_EXON,B_EXON,C_UTR", (amb, None), (amb, None)),
        (None, (None, None), (None, None)),
    ]
    df = spark.createDataFrame([(t,) for t, *_ in cases], "tag string").select("tag", S.assign_feature("tag").alias("x"), S.assign_feature("tag", True).alias("y"))
    got = {r.tag: ((r.x.gene, r.x.feature), (r.y.gene, r.y.feature)) for r in df.collect()}
    assert got == {t: (x, y) for t, x, y in cases}


def test_cells_without_a_knee(spark):
    from cellgrid.operators import barcodes

    ranked = spark.createDataFrame([(s, f"{s}{i}", i + 1) for s, n in (("a", 400), ("b", 400), ("c", 400), ("d", 30)) for i in range(n)], "sample string, barcode string, rank int")
    knees = spark.createDataFrame([("a", None), ("c", 300), ("d", 5)], "sample string, knee int")
    got = {r.sample: r["count"] for r in barcodes.cells_rna(ranked, knees).groupBy("sample").count().collect()}
    assert got == {"a": 400, "b": 400, "c": 300, "d": 30}
    assert {r.sample: r["count"] for r in barcodes.cells_rna(ranked, knees, most=350).groupBy("sample").count().collect()}["b"] == 350


def test_ranges(spark):
    random.seed(5)
    iv = lambda n: [("c", s := random.randrange(500), s + random.randrange(1, 60)) for _ in range(n)]
    a, b = iv(60), iv(40)
    da, db = (spark.createDataFrame(x, "chr string, start long, stop long") for x in (a, b))
    got = ranges.overlap_join(da, db, bin_size=37).count()
    assert got == sum(x[1] < y[2] and y[1] < x[2] for x in a for y in b)
    cover = lambda rows: {p for _, s, e in rows for p in range(s, e)}
    minus = [tuple(r) for r in ranges.subtract_intervals(da, db, ["chr"]).collect()]
    assert cover(minus) == cover(a) - cover(b)
    sizes = spark.createDataFrame([("c", 700)], "chr string, length long")
    gaps = [tuple(r) for r in ranges.complement_intervals(da, sizes, ["chr"]).collect()]
    assert cover(gaps) == set(range(700)) - cover(a)


def test_clean_peaks_do_not_overlap(spark):
    random.seed(6)
    s = [("c", random.randrange(200, 5000), f"p{i}", random.random() * 10 + 2) for i in range(80)]
    df = spark.createDataFrame(s, "chr string, pos long, name string, score double")
    none = spark.createDataFrame([], "chr string, start long, stop long")
    got = sorted((r.start, r.stop) for r in ranges.clean_peaks(df, none, spark.createDataFrame([("c", 6000)], "chr string, length long")).collect())
    assert got and all(x[1] <= y[0] for x, y in zip(got, got[1:], strict=False))


def test_quality_trim(spark):
    df = spark.createDataFrame([("IIIII#####",), ("IIIII",), ("#####",), ("",)], "q string")
    assert [r[0] for r in df.select(S.quality_cut("q")).collect()] == [5, 5, 0, 0]


def test_zero_truncated_poisson(spark):
    assert spark.range(1, 40).select(F.sum(S.zero_truncated_poisson("id", F.lit(3.0)))).first()[0] == pytest.approx(1)


def test_sources(spark, tmp_path):
    (tmp_path / "A_S1_L001_R1_001.fastq").write_text("@r1_x 1\nACGT\n+\nIIII\n@r2_y\nTT\n+\n@I\n")
    (tmp_path / "x.sam").write_text("@HD\tVN:1\nq\t99\tchr1\t11\t60\t4M2D3M\t=\t20\t30\tACGTACG\tIIIIIII\tXB:Z:bead\tXM:Z:umi\n")
    (tmp_path / "x.gtf").write_text('#c\nchr1\ts\tExon\t11\t20\t.\t+\t.\tgene_id "g1"; gene_name "n";\n')
    (tmp_path / "m.mtx").write_text("%%MatrixMarket\n2 2 2\n1 1 5\n2 2 7\n")
    (tmp_path / "b.tsv").write_text("c1\nc2\n")
    (tmp_path / "f.tsv").write_text("g1\tn\ng2\tn\n")
    (tmp_path / "s_flagstat.txt").write_text("12 + 0 in total (QC)\n10 + 0 mapped (83%)\n")
    fq = files.merge_lanes(files.read_fastq(spark, str(tmp_path / "*.fastq"))).collect()
    assert {(r.name, r.seq, r.qual, r["sample"], r.mate) for r in fq} == {("r1_x", "ACGT", "IIII", "A_S1", 1), ("r2_y", "TT", "@I", "A_S1", 1)}
    sam = files.read_sam(spark, str(tmp_path / "x.sam")).first()
    assert (sam.pos, sam.end, sam.XB, sam.XM, sam.tlen) == (10, 19, "bead", "umi", 30)
    assert tuple(files.read_gtf(spark, str(tmp_path / "x.gtf")).first())[:7] == ("chr1", 10, 20, "+", "exon", "g1", "n")
    assert {tuple(r) for r in files.read_mtx(spark, str(tmp_path / "m.mtx"), str(tmp_path / "b.tsv"), str(tmp_path / "f.tsv")).collect()} == {("c1", "g1", 5), ("c2", "g2", 7)}
    assert {tuple(r) for r in files.parse_report(spark, "flagstat", str(tmp_path / "s_flagstat.txt")).collect()} == {("s_flagstat", "in total", 12.0), ("s_flagstat", "mapped", 10.0)}


def test_pair_mates_ignores_secondary(spark):
    rows = [("s", "c", "r", 99, 10, 50, 60, 100), ("s", "c", "r", 147, 80, 120, 60, -100), ("s", "c", "r", 99 + 256, 500, 540, 60, 0), ("s", "c", "x", 99, 1, 2, 60, 1)]
    got = atac.pair_mates(spark.createDataFrame(rows, "sample string, contig string, name string, flag int, pos long, end long, mapq int, tlen int")).collect()
    assert [(r.name, r.pos1, r.pos2, r.rev2) for r in got] == [("r", 10, 80, True)]


def test_small_readers(spark, tmp_path):
    write = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    bed = files.read_bed(spark, write("a.bed", "#c\nchr1\t5\t9\tx\t1.5\t+\nchr2\t1\t2\n")).collect()
    assert [(r.chr, r.start, r.stop, r.name) for r in bed] == [("chr1", 5, 9, "x"), ("chr2", 1, 2, None)]
    edge = files.read_edges(spark, write("e.tsv", "7\t4\t10\t1\nA\tC\t\tB\n")).collect()
    assert [tuple(r) for r in edge] == [("7", "4", "10", "1"), ("A", "C", None, "B")]
    rna = files.read_barcode_map(spark, write("m.tsv", "BeadBarcode,DropBarcode,nBeads\n1,xBC1N2,2\n")).collect()
    atac_map = files.read_barcode_map(spark, write("n.tsv", "a\tc1\nb\tc1\n"), "atac").collect()
    assert [tuple(r) for r in rna] == [("1", "xBC1N2", 2)]
    assert {tuple(r) for r in atac_map} == {("a", "c1", 2), ("b", "c1", 2)}
    assert [tuple(r) for r in files.read_allowlist(spark, write("l.csv", "x\ny\n")).collect()] == [("x", 1), ("y", 2)]
    assert [tuple(r) for r in files.read_contigs(spark, write("g.fai", "chr1\t100\t0\t60\t61\n")).collect()] == [("chr1", 100)]
    assert [tuple(r) for r in files.read_contigs(spark, write("g.fa", ">chr1 d\nACGT\n>chr2\nA\n")).collect()] == [("chr1", None), ("chr2", None)]
    table = write("dup_metrics.txt", "# x\n## METRICS CLASS\tY\nLIBRARY\tREADS\tPERCENT\nlib\t10\t0.5\n")
    assert {(r.metric, r.value) for r in files.parse_report(spark, "duplication", table).collect()} == {("READS", 10.0), ("PERCENT", 0.5)}
    empty = [files.read_metrics(spark, [write("a.csv", "sample,process,metric,value\n"), write("b.csv", "sample,process,metric,value\ns,p,m,2\n")])]
    assert [tuple(r) for r in empty[0].collect()] == [("s", "p", "m", 2.0)]


def test_empty_tables(spark):
    frags = spark.createDataFrame([], "chr string, start long, stop long, bead string, support long")
    assert merge_atac.bead_pair_jaccard(frags).count() == 0
    assert edges.merge_beads(spark.createDataFrame([], "bead1 string, umi1 string, bead2 string, umi2 string")).count() == 0
    assert ranges.merge_intervals(frags, ["chr"]).count() == 0
    assert ranges.subtract_intervals(frags, frags, ["chr"]).count() == 0


def test_numbers_follow_the_order(spark):
    """Numbers run over all ranges, with ties, nulls and an empty table."""
    rng = random.Random(7)
    rows = [(rng.choice([None, *range(50)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = {r.k: (r.a, r.b) for r in numbering.numbered(df, ["a", "b"], "k").collect()}
    assert [got[i + 1] for i in range(len(rows))] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    empty = numbering.numbered(df.filter("b < 0"), ["a"], "k")
    assert empty.columns == ["a", "b", "k"] and empty.isEmpty()


def test_rank_curve_with_many_ties(spark):
    rng = random.Random(8)
    rows = [(s, f"b{i:04d}", rng.choice([1, 1, 1, 1, 2, 9])) for s in "xy" for i in range(rng.randrange(300, 600))]
    want = {}
    for s in "xy":
        mine, total, so_far = sorted((-n, b) for t, b, n in rows if t == s), sum(n for t, _, n in rows if t == s), 0
        for i, (n, b) in enumerate(mine, 1):
            so_far -= n
            want[s, b] = (-n, i, pytest.approx(-n / total), pytest.approx(so_far / total))
    got = barcodes.rank_curve(spark.createDataFrame([*rows, ("x", "none", None)], "sample string, barcode string, n long")).collect()
    assert len(got) == len(want)
    assert {(r["sample"], r.barcode): (r.n, r["rank"], r.fraction, r.cum_fraction) for r in got} == want


def test_lines_of_several_files(spark, tmp_path):
    """Labels are numbered over part files, in the order of their names, and by place within each."""
    (tmp_path / "b").mkdir()
    for part, lines in (("part-0", ["c1", "c2"]), ("part-1", ["c3"]), ("part-2", ["c4", "c0"])):
        (tmp_path / "b" / part).write_text("".join(f"{x}\n" for x in lines))
    assert {(r.value, r.n) for r in files.line_numbers(spark, str(tmp_path / "b")).collect()} == {("c1", 1), ("c2", 2), ("c3", 3), ("c4", 4), ("c0", 5)}
    assert sorted((r["rank"], r.bead) for r in files.read_allowlist(spark, str(tmp_path / "b")).collect()) == [(1, "c1"), (2, "c2"), (3, "c3"), (4, "c4"), (5, "c0")]


def test_min_edit_distance_matches_all_pairs(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(9)
    for lengths in ((6, 7, 8), (10,), (15,), (1, 4)):
        tags = [("".join(rng.choice("ACGT") for _ in range(rng.choice(lengths))), f"t{i}") for i in range(rng.randrange(2, 9))]
        want = min(distance(a, b) for a, x in tags for b, y in tags if x < y)
        assert adt.min_edit_distance(spark.createDataFrame([*tags, (None, "z")], "sequence string, label string")).first()[0] == want
    assert adt.min_edit_distance(spark.createDataFrame([("ACGT", "a")], "sequence string, label string")).first()[0] is None


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_intervals_match_bases(spark, coalesce):
    """Unions and differences against sets of bases, with long intervals that reach over several ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        rng = random.Random(12)
        make = lambda n, most: [(rng.choice("cd"), s, s + rng.randrange(1, most)) for s in (rng.randrange(3000) for _ in range(n))]
        a, b = [*make(150, 20), ("c", 100, 2500)], make(60, 30)
        bases = lambda rows: {(c, i) for c, s, e in rows for i in range(s, e)}
        df_a, df_b = (spark.createDataFrame(x, "chr string, start long, stop long") for x in (a, b))
        merged = ranges.merge_intervals(df_a, ["chr"]).collect()
        assert bases([(r.chr, r.start, r.stop) for r in merged]) == bases(a) and sum(r.n for r in merged) == len(a)
        assert not {(r.chr, r.start) for r in merged} & {(r.chr, r.stop) for r in merged}
        left = [tuple(r) for r in ranges.subtract_intervals(df_a, df_b, ["chr"]).collect()]
        assert bases(left) == bases(a) - bases(b) and sum(e - s for _, s, e in left) == len(bases(left))
        assert not {(c, s) for c, s, _ in left} & {(c, e) for c, _, e in left}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
