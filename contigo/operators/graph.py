"""Graphs as edge tables: components, reachability, reduction, flow, de Bruijn compaction and cleaning.

Iterative operators are loops of joins on the driver side of the plan; every round is
written to the shared folder (spark.checkpoint.dir), which cuts lineage.
Per-component algorithms run as grouped functions over one component at a time.
"""

from __future__ import annotations

from collections import defaultdict, deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import revcomp
from .staging import kept


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """v, component: the least vertex each vertex is connected with. Neighbours' least labels, then the label's label, until nothing moves."""
    both = kept(edges.select(F.col(a).alias("v"), F.col(b).alias("w")).union(edges.select(F.col(b), F.col(a))).distinct())
    labels = kept(both.groupBy("v").agg(F.least(F.min("w"), F.first("v")).alias("c")))
    while True:
        near = both.join(labels.toDF("w", "c"), "w").groupBy("v").agg(F.min("c").alias("m"))
        step = labels.join(near, "v").select("v", F.col("c").alias("old"), F.least("c", "m").alias("m"))
        new = kept(step.join(labels.toDF("m", "up"), "m", "left").select("v", "old", F.least("m", F.coalesce("up", "m")).alias("c")))
        moved = new.where("c != old").limit(1).count()
        labels = new.select("v", "c")
        if not moved:
            return labels.toDF("v", "component")


def scaffold_edges(pairs: DataFrame, least_pairs: int) -> DataFrame:
    """src, dst, pairs, distance: read pairs grouped by oriented contigs, those with enough pairs, and their mean distance."""
    return pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("pairs"), F.avg("distance").alias("distance")).where(F.col("pairs") >= least_pairs)


def transitive_reduction(edges: DataFrame, steps: int = 500) -> DataFrame:
    """Edges (src, dst, ...) beside which no other path leads from src to dst, whatever its length: in order of src and dst, edges already taken out left out.

    A search takes up fewer vertices than steps, breadth first, neighbours in order. The order matters in rings, so one component is worked at a time.
    """
    pairs = kept(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct())
    kinds = dict(pairs.dtypes)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        after, gone = defaultdict(list), []
        for a, b in sorted(zip(pdf["src"].tolist(), pdf["dst"].tolist())):
            after[a].append(b)

        def connected(a, b) -> bool:
            """Whether a path leads from a to b without their edge."""
            seen, queue, taken = {a}, deque([a]), 0
            while queue and (taken := taken + 1) < steps:
                v = queue.popleft()
                for w in after.get(v, ()):
                    if v == a and w == b:
                        continue
                    if w == b:
                        return True
                    if w not in seen:
                        seen.add(w)
                        queue.append(w)
            return False

        for a in sorted(after):
            for b in list(after[a]):
                if len(after[a]) > 1 and connected(a, b):
                    after[a].remove(b)
                    gone.append((a, b))
        return pd.DataFrame(gone, columns=["src", "dst"])

    of = components(pairs, "src", "dst").withColumnRenamed("v", "src")
    gone = pairs.join(of, "src").groupBy("component").applyInPandas(one, f"src {kinds['src']}, dst {kinds['dst']}")
    return edges.join(gone, ["src", "dst"], "left_anti")


def two_step_reduction(edges: DataFrame, slack: float | None = None) -> DataFrame:
    """Edges (src, dst, distance) for which no path of two other edges leads from src to dst (slack: of about the same distance)."""
    first = edges.select("src", F.col("dst").alias("mid"), F.col("distance").alias("d1"))
    second = edges.select(F.col("src").alias("mid"), "dst", F.col("distance").alias("d2"))
    via = first.join(second, "mid").where("src != dst AND mid != src AND mid != dst")
    if slack is None:
        return edges.join(via.select("src", "dst").distinct(), ["src", "dst"], "left_anti")
    long = via.join(edges, ["src", "dst"]).where(F.abs(F.col("d1") + F.col("d2") - F.col("distance")) <= slack).select("src", "dst").distinct()
    return edges.join(long, ["src", "dst"], "left_anti")


def unique_successors(edges: DataFrame) -> DataFrame:
    """Edges that are the only one out of src and the only one into dst."""
    out = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("src")
    into = edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("dst")
    return edges.join(out, "src", "left_semi").join(into, "dst", "left_semi")


def chains(edges: DataFrame) -> DataFrame:
    """v, head, rank: the place of each vertex on its path of single edges (src, dst), by pointer jumping in log rounds; rings are cut before their least vertex."""
    e = edges.select("src", "dst")
    every = e.select(F.explode(F.array("src", "dst")).alias("v")).distinct()
    state = every.join(e.select(F.col("dst").alias("v"), F.col("src").alias("up")), "v", "left")
    # top: whether up is the head of a path; low: the least vertex from v on up to, not with, up
    state = kept(state.select("v", F.coalesce("up", "v").alias("up"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("d"), F.col("up").isNull().alias("top"), F.col("v").alias("low")))
    for _ in range(state.count().bit_length() + 1):
        far = state.select(F.col("v").alias("up"), F.col("up").alias("up2"), F.col("d").alias("d2"), F.col("top").alias("top2"), F.col("low").alias("low2"))
        state = kept(state.join(far, "up").select("v", F.col("up2").alias("up"), (F.col("d") + F.col("d2")).alias("d"), F.col("top2").alias("top"), F.least("low", "low2").alias("low")))
        if not state.where("NOT top").limit(1).count():
            return state.select("v", F.col("up").alias("head"), F.col("d").alias("rank"))
    rings = state.where("NOT top").select(F.col("v").alias("dst"), "low")
    cut = kept(e.join(rings, "dst").where("dst != low").select("src", "dst"))
    alone = rings.where("dst = low").select(F.col("dst").alias("v")).join(cut.select(F.explode(F.array("src", "dst")).alias("v")).distinct(), "v", "left_anti")
    whole = state.where("top").select("v", F.col("up").alias("head"), F.col("d").alias("rank"))
    whole = whole.unionByName(alone.select("v", F.col("v").alias("head"), F.lit(0).cast("long").alias("rank")))
    return whole.unionByName(chains(cut)) if cut.limit(1).count() else whole


# ---- de Bruijn graphs: tables (kmer, n), strands made explicit as oriented k-mers


def oriented(kmers: DataFrame) -> DataFrame:
    """kmer (as read), n: both strands of every canonical k-mer."""
    return kmers.select("kmer", "n").unionByName(kmers.select(revcomp(F.col("kmer")).alias("kmer"), "n")).distinct()


def successors(kmers: DataFrame, k: int) -> DataFrame:
    """src, dst: oriented k-mers that overlap by k - 1, by an equi-join on the overlap."""
    o = oriented(kmers).select("kmer")
    return o.select(F.col("kmer").alias("src"), F.expr(f"right(kmer, {k - 1})").alias("mid")).join(o.select(F.col("kmer").alias("dst"), F.expr(f"left(kmer, {k - 1})").alias("mid")), "mid").select("src", "dst")


def unitigs(kmers: DataFrame, k: int) -> DataFrame:
    """seq, kmers, total, coverage: maximal unbranched paths, one strand each (the lesser text); rings start at their least k-mer."""
    edges = unique_successors(successors(kmers, k)).where("src != dst")
    edges = edges.where(F.col("dst") != revcomp(F.col("src")))  # a turn into the own other strand ends a path
    o = oriented(kmers)
    placed = chains(edges) if edges.limit(1).count() else o.select(F.col("kmer").alias("v"), F.col("kmer").alias("head"), F.lit(0).cast("long").alias("rank")).limit(0)
    rest = o.join(placed.select(F.col("v").alias("kmer")), "kmer", "left_anti").select(F.col("kmer").alias("v"), F.col("kmer").alias("head"), F.lit(0).cast("long").alias("rank"))
    rows = placed.unionByName(rest).join(o.select(F.col("kmer").alias("v"), "n"), "v")
    paths = rows.groupBy("head").agg(F.sort_array(F.collect_list(F.struct("rank", "v"))).alias("p"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("kmers"))
    tail = F.array_join(F.transform(F.expr("slice(p, 2, size(p))"), lambda x: F.right(x["v"], F.lit(1))), "")
    seq = F.concat(F.get("p", F.lit(0))["v"], tail)
    both = paths.select(F.least(seq, revcomp(seq)).alias("seq"), "kmers", "total")
    # a ring's two strands start at different places; those of paths are equal texts
    return both.dropDuplicates(["seq"]).withColumn("coverage", F.col("total") / F.col("kmers"))


def unitig_ends(tigs: DataFrame, k: int) -> DataFrame:
    """The unitigs with left and right: how many others follow either end."""
    ends = tigs.select("seq", F.lit("right").alias("side"), F.expr(f"right(seq, {k - 1})").alias("end")).unionByName(tigs.select("seq", F.lit("left").alias("side"), revcomp(F.expr(f"left(seq, {k - 1})")).alias("end")))
    starts = tigs.select(F.expr(f"left(seq, {k - 1})").alias("end")).unionByName(tigs.select(revcomp(F.expr(f"right(seq, {k - 1})")).alias("end")))
    degree = ends.join(starts.groupBy("end").agg(F.count(F.lit(1)).alias("d")), "end", "left").groupBy("seq").agg(F.sum(F.when(F.col("side") == "left", F.coalesce("d", F.lit(0)))).alias("left"), F.sum(F.when(F.col("side") == "right", F.coalesce("d", F.lit(0)))).alias("right"))
    return tigs.join(degree, "seq")


def kmers_of(tigs: DataFrame, k: int) -> DataFrame:
    """kmer, n of unitigs, with their mean coverage: the way back after unitigs were removed."""
    from ..functions.sequence import canonical, kmers

    return tigs.select(F.explode(kmers(F.col("seq"), k)).alias("m"), "coverage").groupBy(canonical(F.col("m")).alias("kmer")).agg(F.round(F.sum("coverage")).cast("long").alias("n"))


def remove_tips(kmers: DataFrame, k: int, least: int, most_coverage: float | None = None) -> DataFrame:
    """The k-mers without dead ends shorter than least + k - 1 (and of a coverage of at most most_coverage), the limit doubling from 1 up to least."""
    limit = 1
    while True:
        limit = min(2 * limit, least)
        tigs = unitig_ends(unitigs(kmers, k), k)
        bad = (F.char_length("seq") < limit + k - 1) & ((F.col("left") == 0) != (F.col("right") == 0))
        if most_coverage is not None:
            bad = bad & (F.col("coverage") <= most_coverage)
        kmers = kept(kmers.join(kmers_of(tigs.where(bad), k).select("kmer"), "kmer", "left_anti"))
        if limit == least:
            return kmers


def remove_standalone(kmers: DataFrame, k: int, least: int) -> DataFrame:
    """The k-mers without unitigs shorter than least that nothing follows on either side."""
    tigs = unitig_ends(unitigs(kmers, k), k)
    return kmers.join(kmers_of(tigs.where((F.col("left") == 0) & (F.col("right") == 0) & (F.char_length("seq") < least)), k).select("kmer"), "kmer", "left_anti")


def remove_low_coverage(kmers: DataFrame, k: int, least: float, most_length: int | None = None) -> DataFrame:
    """The k-mers without unitigs of a mean coverage below least (and shorter than most_length)."""
    tigs = unitigs(kmers, k)
    bad = F.col("coverage") < least
    if most_length is not None:
        bad = bad & (F.char_length("seq") < most_length)
    return kept(kmers.join(kmers_of(tigs.where(bad), k).select("kmer"), "kmer", "left_anti"))


def remove_rising_coverage(kmers: DataFrame, k: int, start: float, stop: float, factor: float = 1.1) -> DataFrame:
    """Low coverage removed with a limit that grows by a factor, unitigs made anew each time."""
    while start < stop:
        kmers = remove_low_coverage(kmers, k, start, 2 * k)
        start *= factor
    return kmers


def unitig_links(tigs: DataFrame, k: int) -> DataFrame:
    """src, src_turned, dst, dst_turned: which strand of a unitig (id, seq) follows which, by an equi-join on the k - 1 bases that they share."""
    both = tigs.select("id", F.lit(False).alias("turned"), "seq").unionByName(tigs.select("id", F.lit(True).alias("turned"), revcomp(F.col("seq")).alias("seq")))
    out = both.select(F.col("id").alias("src"), F.col("turned").alias("src_turned"), F.expr(f"right(seq, {k - 1})").alias("mid"))
    return out.join(both.select(F.col("id").alias("dst"), F.col("turned").alias("dst_turned"), F.expr(f"left(seq, {k - 1})").alias("mid")), "mid").drop("mid")


def local_coverage(tigs: DataFrame, links: DataFrame, region: int) -> DataFrame:
    """id, around: mean coverage of the k-mers within a region on either side of a unitig (id, kmers, coverage), itself left out; 0 where nothing follows. Breadth first, a round of joins a step, each neighbour once a side."""
    links = kept(links)
    sizes = tigs.select(F.col("id").alias("at"), "kmers", "coverage")
    front = tigs.select("id", F.explode(F.array(F.lit(False), F.lit(True))).alias("side")).select("id", "side", F.col("id").alias("at"), F.col("side").alias("turned"), F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("covered"))
    seen = front = kept(front)
    while front.limit(1).count():
        near = front.where(F.col("d") < region).join(links.toDF("at", "turned", "dst", "dst_turned"), ["at", "turned"])
        near = near.groupBy("id", "side", F.col("dst").alias("at")).agg(F.min(F.struct("d", F.col("dst_turned").alias("turned"))).alias("m"))
        near = near.join(seen.select("id", "side", "at"), ["id", "side", "at"], "left_anti").join(sizes, "at")
        front = kept(near.select("id", "side", "at", "m.turned", (F.col("m.d") + F.col("kmers")).alias("d"), F.least("kmers", region - F.col("m.d")).alias("covered")))
        seen = seen.unionByName(front)
    weight = F.sum("covered")
    return seen.join(sizes, "at").groupBy("id").agg(F.coalesce(F.sum(F.col("covered") * F.col("coverage")) / F.nullif(weight, F.lit(0)), F.lit(0.0)).alias("around"))


def remove_local_low_coverage(kmers: DataFrame, k: int, least: float, most_length: int, ratio: float = 0.2, region: int = 1000, by_component: bool = False, least_size: int = 10, most_size: int = 30) -> DataFrame:
    """The k-mers without unbranched unitigs shorter than most_length + k - 1 whose coverage is below least and below a part ratio of that around them.

    Without by_component, short dead ends go too. With it, only components of more than least_size unitigs are cleaned, and in those of more
    than most_size also what is covered less than the component's mean.
    """
    tigs = kept(unitig_ends(unitigs(kmers, k), k).withColumn("id", F.md5("seq")))
    links = kept(unitig_links(tigs, k))
    rows = tigs.join(local_coverage(tigs, links, region), "id")
    short, plain = F.char_length("seq") < most_length + k - 1, (F.col("left") <= 1) & (F.col("right") <= 1)
    low = F.col("coverage") < F.least(F.lit(float(least)), F.col("around") * ratio)
    if by_component:
        comp = kept(components(links.select("src", "dst"), "src", "dst").toDF("id", "component"))
        mean = tigs.join(comp, "id").groupBy("component").agg(F.count(F.lit(1)).alias("size"), (F.sum("total") / F.sum("kmers")).alias("mean"))
        rows = rows.join(comp, "id").join(mean, "component").where(F.col("size") > least_size)
        bad = short & plain & (low | ((F.col("size") > most_size) & (F.col("coverage") < F.col("mean"))))
    else:
        bad = short & (plain | (F.col("left") == 0) | (F.col("right") == 0)) & low
    return kept(kmers.join(kmers_of(rows.where(bad), k).select("kmer"), "kmer", "left_anti"))


def pop_bubbles(kmers: DataFrame, k: int) -> DataFrame:
    """The k-mers with only the best covered of parallel unitigs: between the same two ends, of the same length, up to 2k long."""
    tigs = unitig_ends(unitigs(kmers, k), k).where((F.col("left") > 0) & (F.col("right") > 0) & (F.char_length("seq") <= 2 * k))
    ends = F.array_sort(F.array(F.expr(f"left(seq, {k - 1})"), revcomp(F.expr(f"right(seq, {k - 1})"))))
    best = tigs.withColumn("ends", ends).withColumn("len", F.char_length("seq")).groupBy("ends", "len").agg(F.max_by("seq", F.struct("total", "seq")).alias("best"), F.collect_list("seq").alias("all")).where(F.size("all") > 1)
    worse = best.select(F.explode("all").alias("seq"), "best").where("seq != best").select("seq")
    gone = kmers_of(worse.withColumn("coverage", F.lit(1.0)), k).select("kmer").join(kmers_of(best.select(F.col("best").alias("seq"), F.lit(1.0).alias("coverage")), k).select("kmer"), "kmer", "left_anti")
    return kept(kmers.join(gone, "kmer", "left_anti"))


def merge_similar(tigs: DataFrame, k: int, least: float = 0.98) -> DataFrame:
    """The unitigs without those that have a better covered one with the same ends and a similarity over least."""
    from ..functions.sequence import similarity

    rows = tigs.select("seq", "total", F.expr(f"left(seq, {k - 1})").alias("l"), F.expr(f"right(seq, {k - 1})").alias("r"))
    pair = rows.alias("a").join(rows.alias("b"), ["l", "r"]).where((F.struct("a.total", "a.seq") < F.struct("b.total", "b.seq")) & (similarity(F.col("a.seq"), F.col("b.seq")) > least))
    return tigs.join(pair.select(F.col("a.seq").alias("seq")).distinct(), "seq", "left_anti")


# ---- one component at a time


def _per_component(edges: DataFrame, function, schema: str) -> DataFrame:
    comp = components(edges, "src", "dst")
    return edges.join(comp.select(F.col("v").alias("src"), "component"), "src").groupBy("component").applyInPandas(function, schema)


def max_flow(edges: DataFrame, sources: Column, sinks: Column, id_type: str = "string") -> DataFrame:
    """component, src, dst, flow: greatest flows from all sources to all sinks of each component of (src, dst, weight), by shortest augmenting paths; edges without flow are left out.
    sources, sinks: conditions on src and dst that tell terminals."""
    marked = edges.withColumn("is_source", sources).withColumn("is_sink", sinks)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        cap: dict = defaultdict(lambda: defaultdict(float))
        for s, d, w in zip(pdf["src"], pdf["dst"], pdf["weight"]):
            cap[s][d] += w
            cap[d][s] += 0.0
        start, stop = object(), object()
        for v in pdf.loc[pdf["is_source"], "src"].unique():
            cap[start][v], cap[v][start] = float("inf"), 0.0
        for v in pdf.loc[pdf["is_sink"], "dst"].unique():
            cap[v][stop], cap[stop][v] = float("inf"), 0.0
        left = {a: dict(x) for a, x in cap.items()}
        while True:
            came, queue = {start: None}, deque([start])
            while queue and stop not in came:
                a = queue.popleft()
                for b, c in left.get(a, {}).items():
                    if c > 0 and b not in came:
                        came[b] = a
                        queue.append(b)
            if stop not in came:
                break
            path, v = [], stop
            while came[v] is not None:
                path.append((came[v], v))
                v = came[v]
            room = min(left[a][b] for a, b in path)
            if room == float("inf"):
                break
            for a, b in path:
                left[a][b] -= room
                left[b][a] += room
        rows = [(pdf["component"].iloc[0], a, b, c - left[a][b]) for a, x in cap.items() if a is not start for b, c in x.items() if b is not stop and b is not start and c > left[a][b]]
        return pd.DataFrame(rows, columns=["component", "src", "dst", "flow"])

    return _per_component(marked, one, f"component {id_type}, src {id_type}, dst {id_type}, flow double")


def longest_paths(edges: DataFrame, id_type: str = "string") -> DataFrame:
    """component, vertices, edges, cyclic, longest: per component, whether (src, dst) has a cycle and, if not, the edges on its longest path."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out, into = defaultdict(list), defaultdict(int)
        vertices = set(pdf["src"]) | set(pdf["dst"])
        for s, d in zip(pdf["src"], pdf["dst"]):
            out[s].append(d)
            into[d] += 1
        ready, depth, seen = deque(v for v in vertices if not into[v]), dict.fromkeys(vertices, 0), 0
        while ready:
            v = ready.popleft()
            seen += 1
            for w in out[v]:
                depth[w] = max(depth[w], depth[v] + 1)
                into[w] -= 1
                if not into[w]:
                    ready.append(w)
        cyclic = seen < len(vertices)
        return pd.DataFrame({"component": [pdf["component"].iloc[0]], "vertices": [len(vertices)], "edges": [len(pdf)], "cyclic": [cyclic], "longest": [None if cyclic else max(depth.values())]}).astype({"longest": "Int64"})

    return _per_component(edges, one, f"component {id_type}, vertices long, edges long, cyclic boolean, longest long")


def isoforms(edges: DataFrame, most_paths: int = 3, most_vertices: int = 30, id_type: str = "string") -> DataFrame:
    """component, path: up to so many source-to-sink paths (a parameter of the operator) of small components of (src, dst, weight), heaviest steps first."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out, vertices = defaultdict(list), set(pdf["src"]) | set(pdf["dst"])
        for s, d, w in sorted(zip(pdf["src"], pdf["dst"], pdf["weight"]), key=lambda e: (-e[2], e[1])):
            out[s].append(d)
        paths: list = []
        if len(vertices) < most_vertices:
            stack = [[v] for v in sorted(vertices - set(pdf["dst"]), reverse=True)]
            while stack and len(paths) < most_paths:
                path = stack.pop()
                following = [w for w in out[path[-1]] if w not in path]
                if following:
                    stack += [[*path, w] for w in reversed(following)]
                else:
                    paths.append(path)
        return pd.DataFrame({"component": [pdf["component"].iloc[0]] * len(paths), "path": paths})

    return _per_component(edges, one, f"component {id_type}, path array<{id_type}>")


def adjacencies(genomes: DataFrame) -> DataFrame:
    """genome, l, r: neighbouring block ends of genomes (genome, chromosome, blocks: signed numbers): +b runs from -b's head, written as 'bt' to 'bh'; telomeres are null."""
    end = lambda b, out: F.concat(F.abs(b).cast("string"), F.when((b > 0) == F.lit(out), "h").otherwise("t"))
    n = F.size("blocks")
    inner = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(end(F.get("blocks", i - 1), True).alias("l"), end(F.get("blocks", i), False).alias("r")))).otherwise(F.array().cast("array<struct<l:string,r:string>>"))
    none = F.lit(None).cast("string")
    tips = F.array(F.struct(none.alias("l"), end(F.get("blocks", F.lit(0)), False).alias("r")), F.struct(end(F.get("blocks", n - 1), True).alias("l"), none.alias("r")))
    each = genomes.where(n > 0).select("genome", F.explode(F.concat(inner, tips)).alias("x"))
    return each.select("genome", F.least("x.l", "x.r").alias("l"), F.when(F.col("x.l").isNotNull() & F.col("x.r").isNotNull(), F.greatest("x.l", "x.r")).alias("r"))


#: Edges of a graph of whole numbers that one task takes up (two arrays of 32 MB and some of their size).
MOST_EDGES = 4_000_000


def _contracted(edges: DataFrame, most: int) -> DataFrame:
    """v, root: a vertex of its component for each vertex of (a, b), non-negative whole numbers; a lone vertex is an edge with itself.

    While there are more than so many edges, each vertex goes to the vertex of least hash among itself and its neighbours, which halves rings and
    paths in each round; what is left is one task's.
    """

    def last(batches):
        parts = [pdf.to_numpy("int64") for pdf in batches]
        ends = np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)
        v, at = np.unique(ends, return_inverse=True)
        a, b = at.reshape(-1, 2).T
        up = np.arange(len(v))
        while len(a):
            np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))  # a and b are roots
            while (up != (far := up[up])).any():
                up = far
            a, b = up[a], up[b]
            a, b = a[a != b], b[a != b]
        for i in range(0, len(v), 100_000):
            yield pd.DataFrame({"v": v[i : i + 100_000], "root": v[up[i : i + 100_000]]})

    left, ways = kept(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).distinct()), []
    while left.where("a != b").limit(most + 1).count() > most:
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(len(ways))), F.col(c).alias("v"))
        near = left.union(left.select("b", "a")).groupBy(F.col("a").alias("v")).agg(F.min(rank("b")).alias("least"))
        ways.append(kept(near.select("v", F.least("least", rank("v"))["v"].alias("to"))))
        left = left.where("a != b").join(ways[-1].toDF("a", "x"), "a").join(ways[-1].toDF("b", "y"), "b")
        left = kept(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a != b").distinct())
    roots = kept(left.repartition(1).mapInPandas(last, "v long, root long"))
    for way in reversed(ways):
        roots = kept(way.join(roots.withColumnRenamed("v", "to"), "to", "left").select("v", F.coalesce("root", "to").alias("root")))
    return roots


def _shared_ends(genomes: DataFrame, one: str, other: str) -> DataFrame:
    """first, l, r, root of the adjacencies of two genomes: whether it is the first one's, its ends as numbers (-1: a telomere), and an end of its
    component, in which adjacencies that share a block's end are."""
    code = lambda c: F.expr(f"2 * CAST(left({c}, char_length({c}) - 1) AS BIGINT) + CAST(right({c}, 1) = 'h' AS INT)")
    adj = adjacencies(genomes.where(F.col("genome").isin(one, other)))
    adj = kept(adj.select((F.col("genome") == one).alias("first"), code("l").alias("l"), F.coalesce(code("r"), F.lit(-1)).alias("r")))
    roots = _contracted(adj.select(F.col("l").alias("a"), F.when(F.col("r") < 0, F.col("l")).otherwise(F.col("r")).alias("b")), MOST_EDGES)
    return adj.join(roots.withColumnRenamed("v", "l"), "l")


def dcj_distance(genomes: DataFrame, one: str, other: str) -> DataFrame:
    """One row: blocks n, cycles c, odd paths i, distance n - (c + i / 2) of two genomes with the same blocks, from components of their adjacency graph."""
    ends = _shared_ends(genomes, one, other).select("root", "first", (F.col("r") < 0).cast("int").alias("tip"), F.explode(F.array("l", "r")).alias("e")).where("e >= 0")
    each = ends.groupBy("root", "e").agg((F.count_if("first") * F.count_if(~F.col("first"))).alias("edges"), F.sum("tip").alias("tips"))
    per = each.groupBy("root").agg(F.sum("tips").alias("tips"), F.sum("edges").alias("edges")).where("edges > 0")
    stats = per.agg(F.count_if(F.expr("tips = 0")).alias("c"), F.count_if(F.expr("tips > 0 AND edges % 2 = 1")).alias("i"), (F.sum("edges") / 2).cast("long").alias("n"))
    return stats.select("n", "c", "i", (F.col("n") - F.col("c") - F.col("i") / 2).alias("distance"))


#: Adjacencies that a task takes up at once when it looks for steps, besides those of its largest component.
MOST_ADJACENCIES = 200_000


def dcj_operations(genomes: DataFrame, one: str, other: str) -> DataFrame:
    """component, step, p, q, x, y: joins that turn one genome into the other, as few as the distance: each joins ends p and q, and what they were joined to, x and y (null: a telomere).

    Greedy within a component of the adjacency graph, which no step leaves: first the other genome's adjacencies, then its telomeres. A task takes
    up many components together, as most are small.
    """
    most = MOST_ADJACENCIES

    def steps(root: np.ndarray, first: np.ndarray, l: np.ndarray, r: np.ndarray) -> pd.DataFrame:  # noqa: E741
        mine, two = np.flatnonzero(first), np.flatnonzero(first & (r >= 0))
        joined = dict(zip(l[mine].tolist(), r[mine].tolist()))
        joined.update(zip(r[two].tolist(), l[two].tolist()))
        goal, rows = np.flatnonzero(~first), []
        for at, p, q in zip(goal.tolist(), l[goal].tolist(), r[goal].tolist()):
            x = joined[p]
            if x == q:
                continue
            y = -1 if q < 0 else joined[q]
            rows.append((at, p, q, x, y))
            joined[p] = q
            if q >= 0:
                joined[q] = p
            if x >= 0:
                joined[x] = y
            if y >= 0:
                joined[y] = x
        at, *ends = np.array(rows, np.int64).reshape(-1, 5).T
        names, begin, of = np.unique(root, return_index=True, return_inverse=True)
        of = of[at]  # components in their order here, as rows come in order of root
        step = np.arange(len(at)) - np.searchsorted(of, np.arange(len(names)))[of] + 1
        return pd.DataFrame(dict(zip(["a", "b", "step", *"pqxy"], [l[begin[of]], r[begin[of]], step, *ends])))

    def sort(batches):
        held, n = [], 0
        for pdf in batches:
            held.append(pdf)
            n += len(pdf)
            if n >= most:
                rows = pd.concat(held, ignore_index=True)
                begin = int(np.searchsorted(rows["root"].to_numpy(), rows["root"].iloc[-1]))  # the last component may go on
                if begin:
                    yield steps(*(rows[c].to_numpy()[:begin] for c in rows))
                held = [rows.iloc[begin:]]
                n = 0 if begin == 0 else len(held[0])  # a large component is put together again once it has grown by as much
        if held:
            yield steps(*(c.to_numpy() for _, c in pd.concat(held, ignore_index=True).items()))

    name = lambda c: F.when(F.col(c) >= 0, F.concat(F.shiftright(c, 1).cast("string"), F.when(F.col(c) % 2 == 1, "h").otherwise("t")))
    ends = _shared_ends(genomes, one, other).select("root", "first", "l", "r").repartition("root")
    ends = ends.sortWithinPartitions("root", F.col("first").desc(), ~F.col("first") & (F.col("r") < 0), name("l"), F.coalesce(name("r"), F.lit("-")))
    found = ends.mapInPandas(sort, "a long, b long, step long, p long, q long, x long, y long")
    return found.select(F.concat(F.lit("A:"), name("a"), F.lit(":"), F.coalesce(name("b"), F.lit("-"))).alias("component"), "step", *(name(c).alias(c) for c in "pqxy"))


def dot(edges: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """value: the lines of a DOT graph, for a text sink."""
    return edges.select(F.format_string('"%s" -> "%s" [label="%s"];', F.col(a).cast("string"), F.col(b).cast("string"), F.col(label).cast("string")).alias("value"))


def gml(edges: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """value: the lines of a GML graph of whole-number vertices, in their order, for a text sink."""
    line = lambda part, one, two, value: F.struct(F.lit(part).alias("part"), one.cast("long").alias("one"), two.cast("long").alias("two"), value.alias("value"))
    none = F.lit(None)
    nodes = edges.select(F.explode(F.array(a, b)).alias("v")).distinct().select(line(1, F.col("v"), none, F.format_string("  node [ id %d ]", F.col("v").cast("long"))).alias("x"))
    rows = nodes.unionByName(edges.select(line(2, F.col(a), F.col(b), F.format_string('  edge [ source %d target %d label "%s" ]', F.col(a).cast("long"), F.col(b).cast("long"), F.col(label).cast("string"))).alias("x")))
    ends = edges.sparkSession.range(1).select(F.explode(F.array(line(0, none, none, F.lit("graph [")), line(0, F.lit(1), none, F.lit("  directed 1")), line(3, none, none, F.lit("]")))).alias("x"))
    return rows.unionByName(ends).select("x.*").orderBy("part", "one", "two", "value").select("value")


# ---- searches over all starts at once, a round of joins a step


def shortest_paths(edges: DataFrame, pairs: DataFrame, steps: int = 100) -> DataFrame:
    """start, goal, path: for pairs (start, goal) with a path of at most so many edges (src, dst) a shortest one, of equally short ones the least; a vertex is its own path.

    Searches that share a start share their rows; a start stops when all its goals are found.
    """
    e = kept(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct())
    left = kept(pairs.select("start", "goal").where("start IS NOT NULL AND goal IS NOT NULL").distinct())
    front = seen = kept(left.select("start", F.col("start").alias("v")).distinct().withColumn("path", F.array("v")))
    found = left.where("start = goal").select("start", "goal", F.array("start").alias("path"))
    left = left.where("start != goal")
    for _ in range(steps):
        ways = front.join(left.select("start").distinct(), "start", "left_semi").join(e.withColumnRenamed("src", "v"), "v")
        ways = ways.groupBy("start", F.col("dst").alias("v")).agg(F.min(F.concat("path", F.array("dst"))).alias("path"))
        front = kept(ways.join(seen, ["start", "v"], "left_anti"))
        if not front.limit(1).count():
            break
        seen = seen.unionByName(front)
        hit = left.join(front.withColumnRenamed("v", "goal"), ["start", "goal"])
        found = found.unionByName(hit.select("start", "goal", "path"))
        left = kept(left.join(front.select("start", F.col("v").alias("goal")), ["start", "goal"], "left_anti"))
    return found


def reach(edges: DataFrame, vertices: DataFrame, overlap: int, most: int) -> DataFrame:
    """v, reach: the most bases that a walk from the end of v can add, up to a limit; a vertex of (v, len) adds len less the overlap."""
    adds = kept(edges.select("src", "dst").distinct().join(vertices.select(F.col("v").alias("dst"), (F.col("len") - overlap).cast("long").alias("add")), "dst"))
    state = kept(vertices.select("v", F.lit(0).cast("long").alias("reach")))
    while True:
        on = adds.join(state.toDF("dst", "far"), "dst").groupBy(F.col("src").alias("v")).agg(F.max(F.least(F.col("far") + F.col("add"), F.lit(most))).alias("far"))
        new = kept(state.join(on, "v", "left").select("v", F.col("reach").alias("old"), F.greatest("reach", F.coalesce("far", "reach")).alias("reach")))
        state = new.select("v", "reach")
        if not new.where("reach != old").limit(1).count():
            return state


def converging(edges: DataFrame, vertices: DataFrame, overlap: int, most: int = 300) -> DataFrame:
    """v: vertices of (v, len) all of whose branches lead to one common vertex, with at most so many bases between; those without branches aren't among them."""
    e = kept(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct())
    adds = kept(e.join(vertices.select(F.col("v").alias("src"), F.greatest(F.col("len") - overlap, F.lit(1)).cast("long").alias("add")), "src"))
    near = front = kept(e.select(F.col("src").alias("v"), F.col("dst").alias("branch"), F.col("dst").alias("node"), F.lit(-overlap).cast("long").alias("d")))
    while front.limit(1).count():
        on = front.join(adds.withColumnRenamed("src", "node"), "node").select("v", "branch", F.col("dst").alias("node"), (F.col("d") + F.col("add")).alias("d")).where(F.col("d") <= most)
        on = on.groupBy("v", "branch", "node").agg(F.min("d").alias("d"))
        front = kept(on.join(near.withColumnRenamed("d", "known"), ["v", "branch", "node"], "left").where("known IS NULL OR d < known").drop("known"))
        near = kept(near.unionByName(front).groupBy("v", "branch", "node").agg(F.min("d").alias("d")))
    met = near.groupBy("v", "node").agg(F.count(F.lit(1)).alias("met"))
    return met.join(e.groupBy(F.col("src").alias("v")).agg(F.count(F.lit(1)).alias("branches")), "v").where("met = branches").select("v").distinct()
