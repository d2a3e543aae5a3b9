import itertools
import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contigo.functions import alignment, numeric, quality
from contigo.functions import sequence as seq
from contigo.operators import cluster, coverage, demux, graph, hits, islands, kmers, lengths, links, moments, pairing, scaffold, score, simulate
from contigo.plans import assembly, queries

COMP = str.maketrans("ACGT", "TGCA")
COMP_OF = dict(zip("ACGT", "TGCA"))


def rc(s):
    return s[::-1].translate(COMP)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()[:]


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_sequence_functions(spark):
    s = F.lit
    assert one(spark, seq.revcomp(s("ACGTNacgtRYU")), seq.canonical(s("TTT")), seq.is_palindrome(s("ACGT")), seq.trim_trailing_n(s("ACNNn"))) == ("ARYacgtNACGT", "AAA", True, "AC")
    assert one(spark, seq.kmers(s("ACGT"), 3), seq.kmers(s("A"), 3), seq.hamming(s("ACGT"), s("AGG")), seq.hamming(s(""), s("AC")), seq.similarity(s("kitten"), s("sitting"))) == (["ACG", "CGT"], [], 2, 2, 1 - 3 / 7)
    assert one(spark, seq.read_name(s("@r1/2 x")), seq.read_mate(s("r1/2 x")), seq.read_mate(s("r 1:N:0:A")), seq.read_mate(s("r")), seq.header_prefix(s(">c1|x y"))) == ("r1", 2, 1, None, "c1")
    assert one(spark, seq.subsequence(s("AACCGGTT"), s(3), s(4), s(1), 1, 1), seq.subsequence(s("AACCGGTT"), s(1), s(3), s(-1), 2, 5)) == ("ACCG", rc("AACCG"))
    assert one(spark, seq.wrap(s("ACGTAC"), 3), seq.overlap_length(s("AAACGT"), s("CGTTT"), 2, 4), seq.gc_fraction(s("GCNN"), known_only=True)) == ("ACG\nTAC", 3, 1.0)
    seq.sql_functions(spark)
    assert spark.sql("SELECT revcomp('AAC'), canonical_kmer('TTT'), cigar_len('3M2I4M')").first()[:] == ("GTT", "AAA", 7)
    assert [tuple(r) for r in spark.sql("SELECT * FROM kmers('ACGT', 3)").collect()] == [(1, "ACG"), (2, "CGT")]


def test_quality_functions(spark):
    s = F.lit
    assert one(spark, quality.phred(s("!I")), quality.shift(s("hB"), -31), quality.trim_at_low(s("ACGT"), s("II!I"), 20), quality.first_good_run(s("ACGTA"), s("!II!I"), 20, 2)) == ([0, 40], "I#", "AC", "CG")
    assert one(spark, quality.solexa_to_phred(F.array(s(-5), s(40))), quality.sliding_window_cut(F.array(*map(s, [40, 40, 2, 2, 2, 2])), 4, 15.0), quality.lead_trail(F.array(*map(s, [2, 9, 9, 1])), 3)) == ([1, 40], 1, (2, 3))
    for q in ([40, 40, 40, 2, 2], [2, 2], [40], [], [30, 10, 30, 10, 10]):
        best, at, total = 0, len(q), 0
        for k in range(len(q) - 1, -1, -1):
            total += 20 - q[k]
            if total < 0:
                break
            if total > best:
                best, at = total, k
        assert one(spark, quality.trim_tail(F.array(*map(s, q)).cast("array<int>"), 20)) == (at,)
    assert one(spark, alignment.cigar_length(s("5S10M2D3M")), alignment.is_reverse(s(83)), alignment.circular(s(11), s(10))) == (13, True, 1)


def test_numeric(spark):
    h = 8.1155384e-05
    d32, d64 = one(spark, numeric.synteny_distance(0.05, F.lit(h), True), numeric.synteny_distance(0.05, F.lit(h)))
    assert abs(d64 - 25.644830) < 1e-4 and abs(d32 - d64) < 0.01
    assert abs(one(spark, numeric.normal_cdf(F.lit(1.96)))[0] - 0.9750021) < 1e-6
    p = one(spark, numeric.scaffold_parameters(F.lit(4e6), F.lit(300.0), F.lit(300.0), F.lit(30.0), F.lit(1000.0)))[0]
    assert (p.m, p.n, p.a) == (max(15, int(math.log2(4e6) + 3.99)), int(1.25 * math.log2(300) + 0.99), 0.4) and abs(p.err - 0.6) < 1e-9


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=25))
def test_n50(spark, values):
    df = spark.createDataFrame([(v, "g") for v in values], "l int, g string")
    down, total = sorted(values, reverse=True), sum(values)
    cum = np.cumsum(down)
    gt = next(k for k in range(len(down)) if cum[k] > total / 2)
    ge = next(k for k in range(len(down)) if cum[k] >= total / 2)
    want = {"gt": down[gt], "ge": down[ge], "next": down[min(gt + 1, len(down) - 1)]}
    for rule, v in want.items():
        assert lengths.nxx(df, "l", ["g"], 0.5, rule).first().nxx == v


def test_moments(spark):
    rng = random.Random(1)
    x = [rng.randint(0, 20) for _ in range(57)]
    df = spark.createDataFrame([(v,) for v in x], "v int")
    up, n = sorted(x), len(x)
    mid = up[n // 10 : n // 10 + int(n * 0.8)]
    t = moments.trimmed_mean(df, "v", []).first()
    assert (t.n, round(t["mean"], 9), round(t.sd, 9)) == (len(mid), round(np.mean(mid), 9), round(np.std(mid, ddof=1), 9))
    assert moments.nearest_rank(df, "v", [], [0.5, 0.1]).first()[:] == (up[n // 2], up[n // 10])
    wide = spark.createDataFrame([(g, rng.random() * 10) for g in ("a", None) for _ in range(700)] + [("a", 3.5)] * 9 + [("b", None)], "g string, v double")
    got = {(r.g, r.v): (r.n, r["first"], r.total) for r in moments.ranked_histogram(wide, "v", ["g"], 8).collect()}
    for g in ("a", None):
        values = sorted(r.v for r in wide.collect() if r.g == g)
        assert {v: t for (h, v), t in got.items() if h == g} == {v: (values.count(v), values.index(v), len(values)) for v in values}
    assert {g for g, _ in got} == {"a", None}
    kde = moments.kernel_density(df, "v", 201).orderBy("at").collect()
    assert abs(sum(r.density for r in kde) * (kde[1].at - kde[0].at) - 1) < 0.02


def test_windows(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(1, 8)] + [("b", 1, 9.0)], "c string, p int, v double")
    assert rows(coverage.tumbling_windows(df, ["c"], ["p"], 3, ["v"]), "c", "window", "n", "mean_v") == [("a", 0, 3, 2.0), ("a", 1, 3, 5.0), ("a", 2, 1, 7.0), ("b", 0, 1, 9.0)]
    assert rows(coverage.tumbling_windows(df, ["c"], ["p"], -1, ["v"]), "c", "n") == [("a", 7), ("b", 1)]
    g = spark.createDataFrame([("c", "GGAT")], "n string, s string")
    assert [r.gc for r in coverage.base_profile(g, "n", "s", 3).orderBy("pos").collect()] == [1.0, 2 / 3, 1 / 3, 0.0]


def test_islands(spark):
    iv = spark.createDataFrame([("c", 1, 5), ("c", 4, 8), ("c", 12, 15), ("c", 30, 31)], "c string, a int, b int")
    assert rows(islands.merge_overlapping(iv, ["c"], "a", "b"), "a", "b", "n") == [(1, 8, 2), (12, 15, 1), (30, 31, 1)]
    assert rows(islands.gaps(iv, ["c"], "a", "b", F.lit(1), F.lit(40), 3), "gap_start", "gap_end") == [(16, 29), (32, 40), (9, 11)]
    assert rows(islands.cut_between_neighbours(iv, ["c"], "a", "b", 10), "left", "right") == [(4, 5), (8, 12)]
    near = spark.createDataFrame([("c", 1, 10), ("c", 1, 11), ("c", 50, 60)], "c string, a int, b int")
    assert rows(islands.drop_similar_neighbours(near, "c", "a", "b"), "a") == [(50,)]
    v = spark.createDataFrame([(i,) for i in range(20)], "v int")
    r = spark.createDataFrame([(3, 5), (10, 10)], "lo int, hi int")
    want = [(i,) for i in range(20) if not (3 <= i <= 5 or i == 10)]
    for bins in (None, 4.0):
        assert sorted(tuple(x) for x in islands.outside_ranges(v, "v", r, "lo", "hi", bins=bins).collect()) == want


def test_pairing(spark):
    df = spark.createDataFrame([("r1", 1, 0, "a"), ("r1", 2, 1, "b"), ("r2", 1, 2, "c"), ("r3", 2, 3, "d"), ("r2", 1, 4, "e")], "n string, m int, o int, s string")
    assert rows(pairing.repair(df, ["n"], F.col("m"), "o", ["s"]), "n", "s_1", "s_2", "state") == [("r1", "a", "b", "paired"), ("r2", "e", None, "first"), ("r3", None, "d", "second")]
    a = pairing.adjacent_pairs(df, [], ["o"], F.col("n"))
    assert [r.pair for r in a.orderBy("o").collect()] == ["first", "second", None, None, None]
    both = pairing.interleave(df.select("o", "s").where("o < 2"), df.select("o", "s").where("o < 2"), "o")
    x, y = pairing.deinterleave(both, "o")
    assert rows(x) == rows(y) == [(0, "a"), (1, "b")]


def test_hits(spark):
    h = spark.createDataFrame([("a", "b", 9.0), ("b", "a", 8.0), ("a", "c", 7.0), ("c", "a", 9.0), ("d", "d", 1.0)], "query string, subject string, bit double")
    assert rows(hits.reciprocal_best_one_table(h, [F.col("bit"), F.col("query"), F.col("subject")])) == [("a", "b")]
    assert rows(hits.self_hits(h), "query") == [("d",)]


def test_similar_names(spark, monkeypatch):
    """Every two rows of a group, also of one name, of names in several arrays, of null names and of repeated keys; distances taken by names, not by pairs of rows."""
    rng = random.Random(6)
    names = ["large ring", "hot bolt", "hot ring", "", None]
    p = [(k, rng.choice(names), rng.choice("uvw"), rng.choice([1, 2])) for k in range(120)] + [(7, "hot bolt", "u", 1), (7, "hot bolt", "u", 1), (8, "large ring", None, 1), (None, "hot bolt", "u", 1)]
    df = spark.createDataFrame(p, "k long, x string, g string, h int")
    pair = df.toDF("a", "x", "g", "h").join(df.toDF("b", "y", "g", "h"), ["g", "h"]).where("a < b").select("a", "b", F.round(seq.similarity(F.col("x"), F.col("y")), 9).alias("similarity"))
    plain = lambda t: sorted(map(tuple, t.collect()), key=repr)
    for size in (512, 3):
        monkeypatch.setattr(hits, "CHUNK", size)
        got = hits.similar_names(df, ["g", "h"], "k", "x")
        assert plain(got.select("a", "b", "similarity")) == plain(pair) and got.rdd.getNumPartitions() >= 96
    plan = queries.QUERIES["similarity"][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(keys") < plan.index("levenshtein")  # the distance lies below the pairs of rows


def test_similar_classes(spark, tmp_path):
    """The query holds every two parts of the table, whatever their brands and sizes: those of two names as similar as these, those of one name under its least key. As its SQL, also with null names and keys and with a key of two names."""
    rng = random.Random(7)
    names = ["large ring", "hot bolt", "hot ring", "old ring", "", None]
    p = [(k, rng.choice(names), rng.choice("uvw"), rng.choice([1, 2])) for k in range(60)] + [(90, "lone rod", "u", 1), (91, "hot bolt", None, None), (90, "a rod", "z", 9), (None, "hot ring", "u", 1), (None, "no key", "u", 1)]
    df = spark.createDataFrame(p, "p_partkey long, p_name string, p_brand string, p_size int")
    df.write.parquet(f"{tmp_path}/part.parquet")
    f, sql = queries.QUERIES["similarity"]
    got = [tuple(r) for r in f(spark, str(tmp_path)).select("a", "b", "x", "y", "similarity").collect()]
    said = duckdb.connect()
    said.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    assert sorted(got, key=repr) == sorted(said.execute(f"SELECT a, b, x, y, similarity FROM ({sql})").fetchall(), key=repr)
    members = {(a, x): {(a, x)} for pair in got for a, x in (pair[::2][:2], pair[1::2][:2]) if pair[2] != pair[3]}
    for a, b, x, y, _ in got:
        if x == y:
            members[a, x].add((b, y))
    found = {(frozenset([u, v]), s) for a, b, x, y, s in got if x != y for u in members[a, x] for v in members[b, y]}
    found |= {(frozenset([u, v]), None if x is None else 1.0) for (_, x), m in members.items() for u in m for v in m if u < v}
    rows_ = df.where("p_partkey IS NOT NULL").select("p_partkey", "p_name").distinct()
    each = rows_.toDF("a", "x").join(rows_.toDF("b", "y"), F.struct("a", "x") < F.struct("b", "y")).select("a", "x", "b", "y", F.round(seq.similarity(F.col("x"), F.col("y")), 9)).collect()
    assert found == {(frozenset([(a, x), (b, y)]), s) for a, x, b, y, s in each}


def test_graph_operators(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    up = list(range(60))
    for _ in range(60):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    seen = {v for e in edges for v in e}
    got = dict(rows(graph.components(spark.createDataFrame(edges, "a int, b int"))))
    assert got == {v: up[v] for v in seen}
    e = spark.createDataFrame([("s", "a", 3.0), ("s", "b", 2.0), ("a", "t", 2.0), ("b", "t", 3.0), ("a", "b", 5.0)], "src string, dst string, weight double")
    flow = graph.max_flow(e, F.col("src") == "s", F.col("dst") == "t").collect()
    assert sum(r.flow for r in flow if r.dst == "t") == 5.0
    assert graph.longest_paths(e).first().longest == 3
    d = e.select("src", "dst", F.lit(1.0).alias("distance")).unionByName(spark.createDataFrame([("s", "t", 2.0)], "src string, dst string, distance double"))
    assert ("s", "t") not in rows(graph.transitive_reduction(d), "src", "dst")
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")], "src string, dst string")
    assert rows(graph.chains(chain), "v", "head", "rank") == [("a", "a", 0), ("b", "a", 1), ("c", "a", 2), ("x", "x", 0), ("y", "x", 1)]


@pytest.mark.parametrize("a, b, want", [([[1, 2, 3]], [[1, 2, 3]], 0), ([[1, 2, 3]], [[1, -2, 3]], 1), ([[1, 2], [3]], [[1, 2, 3]], 1), ([[1, 2, 3, 4]], [[3, 4, 1, 2]], 2)])
def test_dcj(spark, a, b, want):
    g = spark.createDataFrame([("a", k, x) for k, x in enumerate(a)] + [("b", k, x) for k, x in enumerate(b)], "genome string, chromosome int, blocks array<int>")
    assert graph.dcj_distance(g, "a", "b").first().distance == want
    ends = lambda genome: {frozenset((r.l, r.r)) for r in graph.adjacencies(g).where(F.col("genome") == genome).collect()}
    steps, now = graph.dcj_operations(g, "a", "b").orderBy("component", "step").collect(), ends("a")
    for r in steps:
        now = now - {frozenset((r.p, r.x)), frozenset((r.q, r.y))} | {frozenset(e) for e in ((r.p, r.q), (r.x, r.y)) if e != (None, None)}
    assert len(steps) == want and now == ends("b")


def shuffled_genomes(spark, n, seed):
    """Two genomes of n blocks in three chromosomes each, the other one shuffled with signs at random; and the ends of each one's adjacencies."""
    rng = random.Random(seed)
    cut = lambda x: [x[: n // 5], x[n // 5 : n // 2], x[n // 2 :]]
    both = {"a": cut(list(range(n))), "b": cut([rng.choice((1, -1)) * b for b in rng.sample(range(n), n)])}
    g = spark.createDataFrame([(k, i, c) for k, x in both.items() for i, c in enumerate(x)], "genome string, chromosome int, blocks array<int>")
    end = lambda b, out: f"{abs(b)}{'h' if (b > 0) == out else 't'}"
    ends = {k: [(None, end(c[0], False)) for c in x] + [(end(c[-1], True), None) for c in x] + [(end(p, True), end(q, False)) for c in x for p, q in zip(c, c[1:])] for k, x in both.items()}
    return g, {k: {frozenset(e) - {None} for e in x} for k, x in ends.items()}


@pytest.mark.parametrize("most", [4_000_000, 20])
def test_dcj_distance_of_long_rings(spark, monkeypatch, most):
    """A few tables written, whatever the length of the rings; counts as by hand, also where edges are contracted first."""
    g, ends = shuffled_genomes(spark, 400, 5)
    up = {e: e for x in ends.values() for f in x for e in f}

    def root(e):
        while up[e] != e:
            e = up[e]
        return e

    for f in [*ends["a"], *ends["b"]]:
        up[root(min(f))] = root(max(f))
    rings, tips = {}, {}
    for e in up:
        rings.setdefault(root(e), set()).add(e)
        tips[root(e)] = tips.get(root(e), 0) + ({e} in ends["a"]) + ({e} in ends["b"])
    cycles, odd = sum(not tips[k] for k in rings), sum(tips[k] > 0 and len(x) % 2 == 1 for k, x in rings.items())
    written = []
    monkeypatch.setattr(graph, "kept", lambda df, keep=graph.kept: written.append(1) or keep(df))
    monkeypatch.setattr(graph, "MOST_EDGES", most, raising=False)
    assert tuple(graph.dcj_distance(g, "a", "b").first()) == (400, cycles, odd, 400 - cycles - odd / 2)
    assert max(map(len, rings.values())) > 100 and len(written) <= (3 if most > 1000 else 30)


@pytest.mark.parametrize("most", [4_000_000, 20])
def test_dcj_operations_of_long_rings(spark, monkeypatch, most):
    """The steps, replayed, lead to the other genome, each component's in its own order; a few tables written."""
    g, ends = shuffled_genomes(spark, 300, 6)
    written = []
    monkeypatch.setattr(graph, "kept", lambda df, keep=graph.kept: written.append(1) or keep(df))
    monkeypatch.setattr(graph, "MOST_EDGES", most, raising=False)
    steps, now = graph.dcj_operations(g, "a", "b").orderBy("component", "step").collect(), set(ends["a"])
    assert len(written) <= (3 if most > 1000 else 30)
    for r in steps:
        now = now - {frozenset((r.p, r.x)) - {None}, frozenset((r.q, r.y)) - {None}} | {frozenset(e) - {None} for e in ((r.p, r.q), (r.x, r.y)) if e != (None, None)}
    assert now == ends["b"] and len(steps) == graph.dcj_distance(g, "a", "b").first().distance
    assert all(r.component.startswith("A:") for r in steps) and len({(r.component, r.step) for r in steps}) == len(steps)


@pytest.mark.parametrize("most", [200_000, 7])
def test_dcj_operations_of_many_components(spark, monkeypatch, most):
    """Many small components and one ring in one table: the steps of each, replayed, lead to the other genome, also where a task takes up few rows at once; no call for each component."""
    rng, a, b = random.Random(7), [], []
    for k in range(0, 1200, 4):  # four blocks a chromosome, in another order and direction there
        a.append([k + 1, k + 2, k + 3, k + 4])
        b.append([rng.choice((1, -1)) * x for x in rng.sample(a[-1], 4)])
    a.append(list(range(2000, 2060)))
    b.append([rng.choice((1, -1)) * x for x in rng.sample(a[-1], 60)])
    g = spark.createDataFrame([(n, i, c) for n, x in (("a", a), ("b", b)) for i, c in enumerate(x)], "genome string, chromosome int, blocks array<int>")
    end = lambda x, out: f"{abs(x)}{'h' if (x > 0) == out else 't'}"
    ends = [{frozenset(e) for c in x for e in [(end(c[0], False),), (end(c[-1], True),), *((end(p, True), end(q, False)) for p, q in zip(c, c[1:]))]} for x in (a, b)]
    monkeypatch.setattr(graph, "MOST_ADJACENCIES", most, raising=False)
    df = graph.dcj_operations(g, "a", "b")
    steps, now = df.orderBy("component", "step").collect(), set(ends[0])
    for r in steps:
        now = now - {frozenset((r.p, r.x)) - {None}, frozenset((r.q, r.y)) - {None}} | {frozenset(e) - {None} for e in ((r.p, r.q), (r.x, r.y)) if e != (None, None)}
    assert now == ends[1] and len(steps) == graph.dcj_distance(g, "a", "b").first().distance
    by = {}
    for r in steps:
        by.setdefault(r.component, []).append(r)
    assert len(by) > 250 and all([r.step for r in x] == list(range(1, len(x) + 1)) for x in by.values())
    starts = {f"A:{min(x)}:{max(x) if len(x) > 1 else '-'}" for x in ends[0]}
    assert set(by) <= starts
    assert "FlatMapGroups" not in df._jdf.queryExecution().executedPlan().toString()


def test_searches_and_draws(spark):
    rng = random.Random(3)
    e = sorted({(rng.randrange(30), rng.randrange(30)) for _ in range(60)})
    edges = spark.createDataFrame(e, "src int, dst int")
    pairs = [(a, b) for a in range(0, 30, 3) for b in range(0, 30, 2)]
    want = {}
    for a, b in pairs:
        layer, seen, n = {a: [a]}, {a}, 0
        while layer and n <= 6:
            if b in layer:
                want[a, b] = layer[b]
                break
            step = {}
            for v, path in layer.items():
                for x, w in e:
                    if x == v and w not in seen:
                        step[w] = min(step.get(w, [99]), [*path, w])
            seen |= set(step)
            layer, n = step, n + 1
    assert {(r.start, r.goal): list(r.path) for r in graph.shortest_paths(edges, spark.createDataFrame(pairs, "start int, goal int"), 6).collect()} == want
    same = spark.createDataFrame([(i, 10.0 * i) for i in range(40)], "k int, p double")
    got = rows(simulate.mate_pairs(same, "k", "p", 100.0, 5.0, 400))
    assert len({a for a, _ in got}) == len({b for _, b in got}) == len(got) > 30
    w = spark.createDataFrame([(g, i, float(i)) for g in range(4000) for i in range(4)], "g int, i int, w double")
    n = dict(simulate.pick_by_weight(w, ["g"], "i", "w").groupBy("i").count().collect())
    assert 0 not in n and sum(n.values()) == 4000 and all(abs(n[i] / 4000 - i / 6) < 0.03 for i in (1, 2, 3))


def test_synteny_blocks(spark):
    rng = random.Random(4)
    genes = [(c, 1000 * c + i, i, f"f{c}_{i}") for c in (1, 2) for i in range(200)]
    lines = [(1000 + 20 + i, 2000 + 50 + i) for i in range(8)] + [(1000 + 120 + i, 2000 + 150 - i) for i in range(6)]
    noise = [(1000 + rng.randrange(200), 2000 + rng.randrange(200)) for _ in range(20)]
    matches = spark.createDataFrame([(a, b, 10.0) for a, b in lines + noise], "gene1 int, gene2 int, score double")
    got = cluster.synteny_blocks(spark.createDataFrame(genes, "contig int, gene int, order int, family string"), matches).orderBy("block").collect()
    assert [(r.x1, r.x2, r.y1, r.y2) for r in got if r.points >= 6] == [(21, 28, 51, 58), (121, 126, 146, 151)]
    assert got[0].p < got[1].p < 1e-3
    long = spark.createDataFrame([(rng.gauss(m, s),) for m, s, n in ((300, 60, 700), (4000, 300, 3000), (3000, 1500, 600)) for _ in range(n)], "v double")
    mean, sd = cluster.mate_pair_part(long, "v")
    assert abs(mean - 4000) < 60 and abs(sd - 300) < 60 and cluster.mate_pair_part(long.where("v < 1000"), "v") is None


def genome(n, seed):
    rng = random.Random(seed)
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_kmers_and_unitigs(spark):
    g, k = genome(300, 5), 15
    df = spark.createDataFrame([("g", g), ("n", "ACGNNACGTACG")], "name string, seq string")
    counts = dict(rows(kmers.kmer_counts(df.where("name = 'g'"), "seq", k)))
    assert sum(counts.values()) == len(g) - k + 1 and all(m == min(m, rc(m)) for m in counts)
    tigs = graph.unitigs(kmers.kmer_counts(df.where("name = 'g'"), "seq", k), k).collect()
    assert len(tigs) == 1 and tigs[0].seq in (g, rc(g)) and tigs[0].kmers == len(counts)
    masks = kmers.kmer_graph(df.where("name = 'g'"), "seq", k).collect()
    assert sum(bin(r.out_mask).count("1") + bin(r.in_mask).count("1") for r in masks) == 2 * (len(masks) - 1)
    # a short dead end, and a bubble
    branch = g[:100] + ("A" if g[100] != "A" else "C") + genome(3, 9)
    mutated = g[:200] + ("A" if g[200] != "A" else "C") + g[201:]
    noisy = spark.createDataFrame([(g,), (g,), (branch,), (mutated[180:221],)], "seq string")
    cleaned = graph.remove_tips(graph.kept(kmers.kmer_counts(noisy, "seq", k)), k, k)
    assert [r.seq for r in graph.unitigs(graph.pop_bubbles(cleaned, k), k).collect() if r.seq in (g, rc(g))]


def test_assembly_end_to_end(spark):
    g = genome(600, 8)
    contig = spark.createDataFrame([("c", g)], "name string, seq string")
    reads = simulate.simulate_pairs(contig, 30.0, 60, 150, 10, error=0.0).select(F.concat_ws("/", "name", F.col("mate").cast("string")).alias("read"), "seq")
    got = [r.seq for r in assembly.assemble_contigs(reads, [21, 25], 1, 100).collect()]
    assert len(got) == 1 and (got[0] in g or rc(got[0]) in g) and len(got[0]) > 500
    placed = kmers.seed_align(reads, spark.createDataFrame([("c", g)], "contig string, seq string"), 21)
    assert placed.count() == reads.count() and placed.where("matches < length").count() == 0
    bad = reads.limit(1).select("read", F.concat(F.lit("T" if reads.first().seq[0] != "T" else "A"), F.expr("substring(seq, 2)")).alias("seq")).collect()
    some = reads.join(spark.createDataFrame(bad, "read string, b string"), "read", "left").select("read", F.coalesce("b", "seq").alias("seq"))
    p2 = kmers.seed_align(some, spark.createDataFrame([("c", g)], "contig string, seq string"), 21)
    fixed = dict(rows(kmers.correct_reads(some, p2, kmers.consensus(kmers.base_votes(p2, some), 2))))
    assert fixed[bad[0].read] == dict(rows(reads))[bad[0].read]


def test_clusters(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(300, 20, 3000), rng.normal(2000, 100, 1500)]).round().astype(int).tolist()
    m = cluster.best_mixture(spark.createDataFrame([(x,) for x in v], "i int"), "i", 5)
    assert len(m.means) == 2 and abs(m.means[0] - 300) < 5 and abs(m.means[1] - 2000) < 20
    pts = [(i, "g", float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (1, 1), (2, 2), (3, 3), (50, 50), (51, 51), (52, 50), (200, 0)])]
    got = dict(rows(cluster.dbscan(spark.createDataFrame(pts, "k int, g string, x double, y double"), ["g"], "k", "x", "y", 1.5, 1), "k", "cluster"))
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4, 5: 4, 6: 4, 7: None}
    chain = spark.createDataFrame([("c", i, i) for i in range(5)] + [("c", 100 + i, 50 - i) for i in range(4)] + [("c", 500, 1)], "c string, x int, y int")
    assert rows(cluster.collinear_chains(chain, ["c"], "x", "y", 10.0), "block", "x") == sorted([(0, i) for i in range(5)] + [(1, 100 + i) for i in range(4)])
    t = spark.createDataFrame([("c", "f", p) for p in (1, 2, 5, 30)], "c string, f string, p int")
    assert rows(cluster.tandem_features(t, ["c"], "f", "p", 10), "p", "feature") == [(1, 1), (2, 1), (30, 30), (5, 1)]


def test_near_points_of_floats(spark):
    """Differences that are equal to eps as a float, though a little more than it as a double, also where they lie two cells of eps apart."""
    x = [0.0, 0.05, 0.1, 0.15000000596046448, 0.25, 0.3]
    points = spark.createDataFrame([(i, "g", v, 0.0) for i, v in enumerate(x)], "k int, g string, x float, y double")
    f = np.array(x, np.float32)
    want = [(i, sum(abs(a - b) <= np.float32(0.05) for j, b in enumerate(f) if j != i)) for i, a in enumerate(f)]
    assert want[0] == (0, 1) and want[1][1] == 2
    assert rows(cluster.neighbour_counts(points, ["g"], "k", "x", "y", 0.05), "k", "neighbours") == want


def test_barcodes_of_large_tables(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    codes = [(i, f"b{i}", word(rng.choice((5, 6)))) for i in range(40)]
    reads = [(i, word(rng.randint(0, 9))) for i in range(300)] + [(1000 + i, c[:i % 4] + "T" + c[i % 4 + 1 :] + "GG") for i, _, c in codes]
    b = spark.createDataFrame(codes, "ord int, ident string, barcode string")
    r = spark.createDataFrame(reads, "k int, s string")
    for options in ({}, {"mismatches": 2}, {"mismatches": 2, "partial": 1}, {"partial": 2, "at_end": True}):
        monkeypatch.setattr(demux, "MOST_BARCODES", 10_000)
        small = rows(demux.best_barcode(r, b, ["k"], "s", **options), "k", "ident", "distance")
        monkeypatch.setattr(demux, "MOST_BARCODES", 3)
        assert rows(demux.best_barcode(r, b, ["k"], "s", **options), "k", "ident", "distance") == small
        assert len(small) == len(reads) and any(x[1] for x in small) and not all(x[1] for x in small)


def test_demux(spark):
    b = spark.createDataFrame([(0, "x", "ACGT"), (1, "y", "ACGA"), (2, "z", "TTTT")], "ord int, ident string, barcode string")
    r = spark.createDataFrame([("1", "ACGTxx"), ("2", "ACGCxx"), ("3", "GGGGxx"), ("4", "CGTxx")], "k string, s string")
    assert rows(demux.best_barcode(r, b, ["k"], "s"), "k", "ident") == [("1", "x"), ("2", "x"), ("3", None), ("4", None)]
    assert rows(demux.best_barcode(r, b, ["k"], "s", partial=1), "k", "ident")[3] == ("4", "x")
    p = spark.createDataFrame([("1", "ACGTggA", "ACGTggC"), ("2", "ACGTggA", "TTTTggC"), ("3", "GGGG", "ACGTggT")], "k string, s1 string, s2 string")
    assert rows(demux.demux_pairs(p, b, "k", "s1", "s2", mismatches=0), "k", "s1", "s2", "state") == [("1", "A", "C", "paired"), ("2", "A", "C", "mispaired"), ("3", "GGGG", "T", "unpaired")]
    s = F.lit
    assert one(spark, demux.lane_and_mate(s("@M:3:1:2:9#ACG/2")))[0][:] == (3, "ACG", 2) and one(spark, demux.lane_and_mate(s("@M:1:F:4:1:2:3 1:N:0:ACG")))[0][:] == (4, "ACG", 1)
    assert one(spark, demux.trim_route(s("ACGT"), s("II!I"), 20, 2))[0][:] == ("AC", "trimmed")


def test_scaffolds(spark):
    a, b, c = genome(400, 1), genome(300, 2), genome(250, 3)
    contigs = spark.createDataFrame([("a", a, 400), ("b", b, 300), ("c", c, 250)], "name string, seq string, len int")
    l = spark.createDataFrame([("a", "f", "b", "f", 9, 90.0), ("b", "r", "a", "r", 9, 90.0), ("b", "f", "c", "r", 7, -7.0), ("c", "f", "b", "r", 7, -7.0)], "src string, src_strand string, dst string, dst_strand string, links long, gaps double")
    layout = scaffold.greedy_layout(contigs, l)
    assert rows(layout, "place", "contig", "strand") == [(0, "a", "f"), (1, "b", "f"), (2, "c", "r")]
    alone = contigs.unionByName(spark.createDataFrame([("d", "ACGT", 350), ("e", "ACGT", 350)], contigs.schema))
    assert rows(scaffold.greedy_layout(alone, l), "scaffold", "place", "contig", "links") == [(0, 0, "a", 9), (0, 1, "b", 7), (0, 2, "c", None), (1, 0, "d", None), (2, 0, "e", None)]
    whole = scaffold.join_layout(layout, contigs).first().seq
    assert whole == a + "N" * 10 + b + "n" + rc(c)
    s = spark.createDataFrame([("s", "NN" + a + "N" * 12 + b + "N" * 5 + c + "N" * 11 + "ACGT" + "N" * 20)], "name string, seq string")
    lines = scaffold.agp(s, "name", "seq").orderBy("object_beg").collect()
    assert [(r.object_beg, r.object_end, r.part, r.type) for r in lines] == [(1, 402, 1, "W"), (403, 414, 2, "N"), (415, 969, 3, "W")] or [(r.object_beg, r.type) for r in lines][0] == (1, "W")
    cut = scaffold.break_at(s, "name", "seq", spark.createDataFrame([("s", 100, 101)], "name string, left int, right int")).orderBy("part").collect()
    assert "".join(r.seq for r in cut) == s.first().seq and len(cut) == 2
    assert scaffold.extend_contig([a[i : i + 60] for i in range(0, 340, 3)], a[:50], 20, 1) == a[: 60 + 339]


def test_scores(spark):
    al = spark.createDataFrame([("AC-GT", "AGTG-")], "a string, b string")
    assert rows(score.substitution_matrix(al, "a", "b"), "x", "y", "n") == [("A", "A", 1), ("C", "G", 1), ("G", "G", 1)]
    g = spark.createDataFrame([("--A-", )], "s string")
    assert rows(score.gap_lengths(g, "s"), "length", "n") == [(1, 1), (2, 1)]
    k = spark.createDataFrame([("g", float(i), float(i)) for i in range(6)], "g string, x double, y double")
    assert score.kendall(k, "x", "y", "g").first().tau == 1.0
    refs = spark.createDataFrame([("r", 10), ("q", 5)], "ref string, length int")
    cov, gap = score.reference_coverage(spark.createDataFrame([("r", 2, 4), ("r", 4, 6)], "ref string, start int, end int"), refs)
    assert rows(cov, "ref", "covered") == [("q", 0), ("r", 5)] and rows(gap, "ref", "gap_start", "gap_end") == [("q", 1, 5), ("r", 1, 1), ("r", 7, 10)]


def test_links_and_misassembly_parts(spark):
    sam = [(f"p{i}", f, c, p, 60, "50M") for i in range(8) for f, c, p in ((0, "a", 300 + i), (16, "b", 20 + i))] + [("q", 0, "a", 5, 60, "50M"), ("q", 16, "a", 200, 60, "50M")]
    m = links.mates(spark.createDataFrame(sam, "qname string, flag int, rname string, pos int, mapq int, cigar string"))
    sizes = spark.createDataFrame([("a", 400), ("b", 300)], "n string, l int")
    full = m.join(sizes.toDF("ctg1", "clen1"), "ctg1").join(sizes.toDF("ctg2", "clen2"), "ctg2")
    got = rows(links.contig_links(full, 300.0), "src", "src_strand", "dst", "dst_strand", "links")
    assert got == [("a", "f", "b", "f", 8), ("b", "r", "a", "r", 8)]
    assert links.insert_sizes(m).first().insert == 245 and links.orientation_vote(links.insert_sizes(m)).first().orientation == 0


def test_simulation_is_repeatable(spark):
    df = spark.range(2000).withColumn("v", F.col("id"))
    a = rows(simulate.bernoulli(df, F.col("id"), 0.3, 1))
    assert a == rows(simulate.bernoulli(df.repartition(7), F.col("id"), 0.3, 1)) and 500 < len(a) < 700
    assert [r.id for r in simulate.shuffled(df, "id", 1).collect()] == [r.id for r in simulate.shuffled(df.repartition(5), "id", 1).collect()]


def test_streams(spark, tmp_path):
    from contigo.streaming import events

    rows_ = [(i, f"2024-01-01 00:{i:02d}:00", i % 3, "a" if i % 2 else "b", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows_, "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = events.windowed_counts(stream, "30 minutes").writeStream.outputMode("complete").format("memory").queryName("w").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.n for r in spark.sql("SELECT * FROM w").collect()) == [15] * 4
    assert list(itertools.islice((r.n for r in events.windowed_counts(df, "1 hour").collect()), 2)) == [30, 30]


def test_linking_pairs(spark):
    l1, l2, g, m, sd, d = 500, 400, 30, 300.0, 25.0, 0.2
    phi = lambda x: 0.5 * math.erfc(-(x - m) / sd / math.sqrt(2))
    want = d * sum(phi(i + g + l2) - phi(i + g) for i in np.arange(0.5, l1))
    row = spark.createDataFrame([(l1, l2, g, m, sd, d)], "a int, b int, g int, m double, s double, d double")
    assert abs(row.select(numeric.linking_pairs("a", "b", "g", "m", "s", "d")).first()[0] - want) < 0.01 * want
    assert one(spark, numeric.quoted_field(F.lit('job "17" "x"'), 2), numeric.quoted_field(F.lit("none"))) == ("x", None)


def brute_chains(points, distance, least):
    """Greedy longest chains by definition, each found anew among the points that are left; (block, x, y, place)."""
    pts, out = sorted(set(points)), []
    left = list(range(len(pts)))
    for block in itertools.count():
        best = None
        for sign in (1, -1):
            score, prev = {}, {}
            for i in left:
                before = [j for j in left if pts[j][0] < pts[i][0] and sign * pts[j][1] < sign * pts[i][1] and pts[i][0] - pts[j][0] + abs(pts[i][1] - pts[j][1]) < distance]
                prev[i] = max(before, key=lambda j: (score[j], j), default=None)
                score[i] = 1 + score.get(prev[i], 0)
            end = max(score, key=lambda i: (score[i], -i), default=None)
            if end is not None and (best is None or score[end] > best[0]):
                path = [end]
                while prev[path[-1]] is not None:
                    path.append(prev[path[-1]])
                best = score[end], path[::-1]
        if best is None or best[0] < least:
            return out
        out += [(block, *pts[i], place) for place, i in enumerate(best[1])]
        left = [i for i in left if i not in best[1]]


def test_collinear_chains_of_all_points(spark, tmp_path):
    from contigo.plans import queries

    rng = random.Random(8)
    items = [(rng.choice([1, 11, 21, 7]), rng.randrange(2000), rng.randrange(3000)) for _ in range(400)]
    spark.createDataFrame(items, "l_suppkey long, l_partkey long, l_orderkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = rows(queries.q_collinear_chains(spark, str(tmp_path)), "grid", "block", "x", "y", "place")
    want = [(g, *r) for g in (1, 11, 21, 7) for r in brute_chains([(p % 500, o % 500) for s, p, o in items if s == g], 120.0, 3)]
    assert got == sorted(want, key=repr) and len(got) > 200
    for least, kind in ((1, int), (2, float), (3, int)):
        pts = [(kind(rng.randrange(40)), kind(rng.randrange(40))) for _ in range(120)]
        df = spark.createDataFrame([("c", *p) for p in pts], f"c string, x {'long' if kind is int else 'double'}, y {'long' if kind is int else 'double'}")
        assert rows(cluster.collinear_chains(df, ["c"], "x", "y", 9.0, least), "block", "x", "y", "place") == sorted(brute_chains(pts, 9.0, least), key=repr)


def test_transitive_reduction_over_any_path(spark):
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "d"), ("d", "e"), ("x", "y"), ("y", "x")], "src string, dst string")
    left = graph.transitive_reduction(chain)
    assert rows(left) == [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("x", "y"), ("y", "x")] == rows(graph.unique_successors(left), "src", "dst")
    assert ("a", "d") in rows(graph.transitive_reduction(chain, steps=3))  # a and b are searched, not c
    rng = random.Random(9)
    edges = sorted({tuple(sorted(rng.sample(range(40), 2))) for _ in range(130)})
    go = {v: {b for a, b in edges if a == v} for v in range(40)}
    reach = {v: set() for v in range(40)}
    for v in reversed(range(40)):
        reach[v] = go[v].union(*(reach[w] for w in go[v]))
    want = [(a, b) for a, b in edges if not any(b in reach[w] for w in go[a] - {b})]
    got = graph.transitive_reduction(spark.createDataFrame(edges, "src int, dst int"))
    assert rows(got) == sorted(want, key=repr) and len(want) < len(edges)
    ring = spark.createDataFrame([(a, b) for a in range(6) for b in range(6) if a != b], "src int, dst int")
    left = rows(graph.transitive_reduction(ring))
    seen = {0}
    for _ in range(6):
        seen |= {b for a, b in left if a in seen}
    assert len(left) < 12 and seen == set(range(6)) and {b for _, b in left} == set(range(6))


def test_kmers_of_long_sequences_in_linear_time(spark):
    import random
    import time

    from contigo.functions import sequence
    from contigo.operators import kmers

    rng = random.Random(1)
    seq = "".join(rng.choice("ACGT") for _ in range(2503)) + "N" + "".join(rng.choice("ACGT") for _ in range(996))
    rows = [(0, seq), (1, ""), (2, None), (3, "ACG"), (4, seq[:1000]), (5, seq[:1004])]
    df = spark.createDataFrame(rows, "id int, s string")
    for k in (1, 5, 31):
        got = {r.id: r.m for r in df.select("id", sequence.kmers(F.col("s"), k).alias("m")).collect()}
        assert all(got[i] == [(s or "")[j : j + k] for j in range(len(s or "") - k + 1)] for i, s in rows)
    turned = lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    want = {}
    for _, s in rows:
        for j in range(len(s or "") - 6):
            x = s[j : j + 7]
            if "N" not in x:
                want[min(x, turned(x))] = want.get(min(x, turned(x)), 0) + 1
    assert {r.kmer: r.n for r in kmers.kmer_counts(df, "s", 7).collect()} == want
    took = []
    for n in (400_000, 1_600_000):
        one = spark.createDataFrame([("".join(rng.choices("ACGT", k=n)),)], "s string")
        began = time.time()
        kmers.kmer_counts(one, "s", 21).agg(F.sum("n")).collect()
        took.append(time.time() - began)
    assert took[1] < 12 * max(took[0], 1)


def test_local_low_coverage(spark):
    k, g = 11, genome(150, 9)
    other = g[:70] + COMP_OF[g[70]] + g[71:]
    seen = lambda text: {min(text[i : i + k], rc(text[i : i + k])) for i in range(len(text) - k + 1)}
    extra = seen(other) - seen(g)
    table = spark.createDataFrame([(x, 20) for x in seen(g)] + [(x, 2) for x in extra], "kmer string, n long")
    tigs = graph.unitigs(table, k).withColumn("id", F.md5("seq")).cache()
    around = {r.coverage: r.around for r in tigs.join(graph.local_coverage(tigs, graph.unitig_links(tigs, k), 30), "id").collect() if r.kmers == k}
    assert around == {20.0: 20.0, 2.0: 20.0}
    left = {r.kmer for r in graph.remove_local_low_coverage(table, k, 5, 20, region=30).collect()}
    assert left == seen(g)
    assert {r.kmer for r in graph.remove_local_low_coverage(table, k, 1, 20, region=30).collect()} == seen(g) | extra
    assert {r.kmer for r in graph.remove_local_low_coverage(table, k, 5, 20, region=30, by_component=True).collect()} == seen(g) | extra
    assert {r.kmer for r in graph.remove_local_low_coverage(table, k, 1, 20, region=30, by_component=True, least_size=3, most_size=3).collect()} == seen(g)
