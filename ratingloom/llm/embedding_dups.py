"""Near-duplicate embeddings by NN-descent.

1. Equal vectors are one node that carries their number.
2. A first neighbour graph comes from random hyperplane leaves, cut into blocks.
3. Rounds of neighbours-of-neighbours joins refine it: the members of each node's
   list, and of a bounded number of lists that hold it, meet in one local join,
   and every pair that improves either list is kept.
4. An audit compares blocks of nodes with all others until it has seen enough
   links; while too few of them were found, lists are doubled and more rounds
   follow.  If the last audit fails too, lists come from all pairs, block by block.
5. Edges at the threshold stay and form components.  A list whose every entry is
   a link is saturated: it may lack more.  Components that hold one are open.
   Their members meet those of other components in hyperplane leaves, without
   regard to lists, and components that link there merge, until none do.
6. Open components get lists as long as the component, by block products, so
   their links are complete.

Nulls and odd input: vectors that are null, empty, zero or hold a null, NaN or
infinite component link with nothing, and vectors of different lengths do not
link.  Rows whose id is null are kept with component null.  Rows that share an
id count as one id that has all their links.  An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.batches import list_column
from ratingloom.llm.components import components
from ratingloom.scratch import materialize

#: Least cosine of a link.
COSINE = 0.95
#: Entries of a neighbour list at first, and rounds between audits.
NEIGHBOURS, ROUNDS = 12, 2
#: Share of the pairs at the threshold that must meet in a leaf; the number of trees follows from it.
LEAF_RECALL = 0.99
#: Nodes of a block; leaves aim at a quarter of it.
BLOCK = 256
#: Hyperplanes of the trees that cut an overfull leaf; what they leave overfull is cut by hash.
DEEPER = 4
#: Nodes of the audit's first block, and of its largest; links it must see, recall it asks for, and most audits.
AUDITED, AUDIT_BLOCK, AUDIT_LINKS, RECALL, AUDITS = 256, 4_096, 300, 0.99, 4
#: Nodes on each side of a block product over all pairs.
PRODUCT = 1_024

_LISTS = "id long, nbrs array<long>, sims array<double>"


def _unit(column: pa.ListArray) -> np.ndarray:
    """Rows of equally long lists as unit vectors in double precision."""
    lengths = column.offsets.to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1) if len(lengths) > 1 else np.zeros((0, 0))
    # Scaled first, so that squares neither overflow nor vanish.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def grouped(batches: Iterator[pa.RecordBatch], names: list[str], rows: int) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of whole groups with about ``rows`` rows at least, and where groups begin and end."""
    held: list[pa.RecordBatch] = []
    size = 0

    def cut(last: bool) -> tuple[pa.Table, list[int], pa.Table]:
        table = pa.Table.from_batches(held).combine_chunks()
        changed = np.zeros(table.num_rows, bool)
        for name in names:
            column = table.column(name).to_numpy()
            changed[1:] |= column[1:] != column[:-1]
        begins = [0, *np.flatnonzero(changed).tolist()]
        if last:
            return table, [*begins, table.num_rows], table.slice(table.num_rows)
        return table.slice(0, begins[-1]), begins, table.slice(begins[-1])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            table, marks, rest = cut(False)
            if table.num_rows:
                yield table, marks
            held, size = rest.to_batches(), rest.num_rows
    if held:
        table, marks, _ = cut(True)
        yield table, marks


def _best(ids: np.ndarray, nbrs: np.ndarray, sims: np.ndarray, k: int) -> pa.RecordBatch:
    """The k most similar neighbours of each id, as lists; ties go to the smaller id."""
    order = np.lexsort((-sims, nbrs, ids))
    ids, nbrs, sims = ids[order], nbrs[order], sims[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (nbrs[1:] != nbrs[:-1])
    ids, nbrs, sims = ids[new], nbrs[new], sims[new]
    order = np.lexsort((nbrs, -sims, ids))
    ids, nbrs, sims = ids[order], nbrs[order], sims[order]
    begins = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1))
    lengths = np.diff(np.append(begins, len(ids)))
    kept = np.arange(len(ids)) - np.repeat(begins, lengths) < k
    return pa.RecordBatch.from_arrays([pa.array(ids[begins]), list_column(nbrs[kept], np.minimum(lengths, k)), list_column(sims[kept], np.minimum(lengths, k))], ["id", "nbrs", "sims"])


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """One list of at most k per id, from any number of partial ones."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in grouped(batches, ["id"], 20_000):
            nbrs = table.column("nbrs").combine_chunks()
            lengths = np.diff(nbrs.offsets.to_numpy())
            sims = table.column("sims").combine_chunks().flatten().to_numpy()
            yield _best(np.repeat(table.column("id").to_numpy(), lengths), nbrs.flatten().to_numpy(), sims, k)

    return lists.repartition("id").sortWithinPartitions("id").mapInArrow(merge, _LISTS)


def _block_lists(rows: DataFrame, names: list[str], k: int) -> DataFrame:
    """Per block of (…, id, vec[, worst]): pairs that enter a list, as partial lists."""
    guarded = "worst" in rows.columns

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, marks in grouped(batches, names, 2_000):
            unit = _unit(table.column("vec").combine_chunks())
            ids = table.column("id").to_numpy()
            worst = table.column("worst").to_numpy() if guarded else None
            out: list[tuple] = []
            for begin, end in zip(marks[:-1], marks[1:]):
                if end - begin < 2:
                    continue
                part = unit[begin:end]
                sims = part @ part.T
                np.fill_diagonal(sims, -2.0)
                k_here = min(k, end - begin - 1)
                best = np.argpartition(-sims, k_here - 1, axis=1)[:, :k_here]
                row = np.repeat(np.arange(end - begin), k_here)
                sim = np.take_along_axis(sims, best, axis=1).ravel()
                keep = sim > worst[begin:end][row] if guarded else np.ones(len(sim), bool)
                out.append((ids[begin:end][row[keep]], ids[begin:end][best.ravel()[keep]], sim[keep]))
            if out:
                yield _best(*[np.concatenate(x) for x in zip(*out)], k)

    return rows.repartition(*names).sortWithinPartitions(*names, "id").mapInArrow(join, _LISTS)


def _trees(depth: int, cosine: float, recall: float) -> int:
    """Hyperplane trees in which a pair at the cosine shares a leaf at least once, with probability ``recall``."""
    together = (1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi) ** depth
    return 1 if together > recall else math.ceil(math.log(1 - recall) / math.log1p(-together))


def _signed(rows: DataFrame, dim: int, depth: int, trees: int, seed: int) -> DataFrame:
    """(…, tree, leaf) for each row of (…, vec) and each tree of random hyperplanes."""
    names = [c for c in rows.columns if c != "vec"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(seed).standard_normal((dim, trees * depth))
        for batch in batches:
            side = (_unit(batch.column("vec")) @ planes > 0).reshape(batch.num_rows, trees, depth)
            code = (side * (1 << np.arange(depth))).sum(axis=2) if depth else np.zeros((batch.num_rows, trees), np.int64)
            row = pa.array(np.repeat(np.arange(batch.num_rows), trees))
            tree = pa.array(np.tile(np.arange(trees), batch.num_rows))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in names), tree, pa.array(code.ravel().astype(np.int64))], [*names, "tree", "leaf"])

    return rows.mapInArrow(sign, ", ".join(f"{c} long" for c in [*names, "tree", "leaf"]))


def _depth(n: int) -> int:
    """Hyperplanes to leaves of a quarter of a block."""
    return max(0, min(30, math.ceil(math.log2(max(1, 4 * n / BLOCK)))))


def _bridges(members: DataFrame, dim: int, n: int, cosine: float, seed: int) -> DataFrame:
    """(u, v) of components that link in a leaf, from (id, component, vec).

    Every pair of a leaf that lies in two components is compared.  A node names one
    other component a block at most: when components have merged, others show.
    """
    depth = _depth(n)
    placed = _signed(members.select("id", "component", "vec"), dim, depth, _trees(depth, cosine, LEAF_RECALL), seed)
    placed = materialize(placed, "bridge-leaves")
    counts = placed.groupBy("tree", "leaf", "component").agg(F.count("*").alias("n"))
    lead = F.max_by("component", F.struct("n", "component")).alias("lead")
    sizes = counts.groupBy("tree", "leaf").agg(lead, F.sum("n").alias("n"), (F.sum("n") - F.max("n")).alias("others")).where("others > 0")
    blocks = [F.ceil(F.col(c) / BLOCK).cast("int").alias(parts) for c, parts in (("others", "rows"), ("n", "columns"))]
    cut = materialize(placed.join(materialize(sizes.select("tree", "leaf", "lead", *blocks), "bridge-sizes"), ["tree", "leaf"]), "bridge-parts")
    part = {parts: F.pmod(F.xxhash64("id"), F.col(parts)).cast("int") for parts in ("rows", "columns")}
    every = {parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1)) for parts in ("rows", "columns")}
    kept = ["tree", "leaf", "id", "component"]
    left = cut.where("component <> lead").select(*kept, part["rows"].alias("i"), every["columns"].alias("j"), F.lit(0).alias("side"))
    right = cut.select(*kept, every["rows"].alias("i"), part["columns"].alias("j"), F.lit(1).alias("side"))
    names = ["tree", "leaf", "i", "j"]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, marks in grouped(batches, names, 2_000):
            unit = _unit(table.column("vec").combine_chunks())
            side, component = (table.column(c).to_numpy() for c in ("side", "component"))
            for begin, end in zip(marks[:-1], marks[1:]):
                middle = begin + int(np.searchsorted(side[begin:end], 1))
                if middle in (begin, end):
                    continue
                u, v = component[begin:middle], component[middle:end]
                hit = (unit[begin:middle] @ unit[middle:end].T >= cosine) & (u[:, None] != v)
                linked = np.flatnonzero(hit.any(axis=1))
                if len(linked):
                    yield pa.RecordBatch.from_arrays([pa.array(u[linked]), pa.array(v[hit[linked].argmax(axis=1)])], ["u", "v"])

    rows = left.union(right).join(members.select("id", "vec"), "id").repartition(*names).sortWithinPartitions(*names, "side", "id")
    pairs = rows.mapInArrow(multiply, "u long, v long")
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _merged_components(inside: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """(id, component) of open components, merged while any of them link."""
    seed = 1_000
    while True:
        members = inside.join(nodes.select("id", "vec"), "id")
        pairs = None
        for dim, n in sorted(members.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).collect()):
            found = _bridges(members.where(F.size("vec") == dim), dim, n, cosine, seed)
            pairs = found if pairs is None else pairs.union(found)
        if pairs is None:
            return inside
        pairs = materialize(pairs, "bridges")
        if pairs.isEmpty():
            return inside
        names = components(pairs).select(F.col("id").alias("component"), F.col("component").alias("name"))
        inside = inside.join(names, "component", "left").select("id", F.coalesce("name", "component").alias("component"))
        inside = materialize(inside, "merged-components")
        seed += 1


def _first_lists(nodes: DataFrame, dim: int, n: int, cosine: float, seed: int, k: int) -> DataFrame:
    """Neighbours within leaves of random hyperplane trees.

    A pair at the cosine shares a leaf with probability LEAF_RECALL at any n, and,
    where that leaf is overfull, one of the smaller leaves that further trees cut from it.
    """
    depth = _depth(n)
    rows = nodes.select("id", "vec")
    placed = materialize(_signed(rows, dim, depth, _trees(depth, cosine, LEAF_RECALL), seed), "leaves")
    sizes = placed.groupBy("tree", "leaf").agg(F.count("*").alias("n"))
    overfull = materialize(sizes.where(F.col("n") > BLOCK).select("tree", "leaf"), "overfull-leaves")
    fit = placed.join(overfull, ["tree", "leaf"], "left_anti").withColumns({"sub": F.lit(-1).cast("long"), "code": F.lit(0).cast("long"), "parts": F.lit(1).cast("long")})
    finer = _signed(rows, dim, DEEPER, _trees(DEEPER, cosine, LEAF_RECALL), seed + 500).toDF("id", "sub", "code")
    again = materialize(placed.join(overfull, ["tree", "leaf"], "left_semi").join(finer, "id"), "finer-leaves")
    names = ["tree", "leaf", "sub", "code"]
    parts = materialize(again.groupBy(names).agg(F.ceil(F.count("*") / BLOCK).alias("parts")), "leaf-sizes")
    cut = fit.unionByName(again.join(parts, names)).withColumn("part", F.pmod(F.xxhash64("id", "tree", "sub"), F.col("parts")))
    names.append("part")
    return _merged(_block_lists(cut.select(*names, "id").join(rows, "id"), names, k), k)


def _round(graph: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """One neighbours-of-neighbours join over all lists."""
    edges = graph.select(F.col("id").alias("centre"), F.explode("nbrs").alias("id"))
    order = Window.partitionBy("centre").orderBy(F.xxhash64("centre", "id"), "id")
    back = edges.select(F.col("id").alias("centre"), F.col("centre").alias("id"))
    back = back.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")
    own = graph.select(F.col("id").alias("centre"), "id")
    members = edges.union(back).union(own).distinct()
    worst = F.when(F.size("sims") < k, F.lit(-2.0)).otherwise(F.element_at("sims", -1))
    state = nodes.select("id", "vec").join(graph.select("id", worst.alias("worst")), "id", "left").withColumn("worst", F.coalesce("worst", F.lit(-2.0)))
    found = _block_lists(members.join(state, "id"), ["centre"], k)
    return _merged(found.union(graph.select("id", "nbrs", "sims")), k)


def _audit(nodes: DataFrame, audited: list, cosine: float) -> DataFrame:
    """(id, nbr): all links of the audited nodes, by comparison with every node."""
    ids = np.array([r["id"] for r in audited], np.int64)
    vectors = np.array([r["vec"] for r in audited], np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, PRODUCT):
                batch = whole.slice(begin, PRODUCT)
                other = batch.column("id").to_numpy()
                q, r = np.nonzero(vectors @ _unit(pa.array(batch.column("vec"))).T >= cosine)
                apart = ids[q] != other[r]
                yield pa.RecordBatch.from_arrays([pa.array(ids[q][apart]), pa.array(other[r][apart])], ["id", "nbr"])

    return nodes.select("id", "vec").mapInArrow(compare, "id long, nbr long")


def _audit_links(nodes: DataFrame, cosine: float) -> DataFrame:
    """Links of as many nodes, in hash order, as it takes to see AUDIT_LINKS of them; of all nodes if there are fewer."""
    order = F.struct(F.xxhash64("id").alias("hash"), "id").alias("place")
    dealt = materialize(nodes.select(order, "id", "vec"), "audit-order")
    truth, seen, last, size = None, 0, None, AUDITED
    while True:
        rest = dealt if last is None else dealt.where((F.col("place.hash") > last["hash"]) | ((F.col("place.hash") == last["hash"]) & (F.col("place.id") > last["id"])))
        audited = rest.orderBy("place").limit(size).collect()
        if not audited:
            return truth
        links = materialize(_audit(nodes, audited, cosine), "audit-links")
        truth = links if truth is None else truth.union(links)
        seen += links.count()
        if seen >= AUDIT_LINKS or len(audited) < size:
            return truth
        last, size = audited[-1]["place"], min(2 * size, AUDIT_BLOCK)


def _recall(graph: DataFrame, truth: DataFrame, cosine: float, k: int) -> float:
    """Share of the audited links that are in the list of either end, or both of whose lists are saturated."""
    full = (F.size("sims") >= k) & (F.element_at("sims", -1) >= cosine)
    lists = graph.select("id", "nbrs", full.alias("full"))
    other = lists.toDF("nbr", "back", "full_back")
    joined = truth.join(lists, "id", "left").join(other, "nbr", "left")
    held = F.array_contains("nbrs", F.col("nbr")) | F.array_contains("back", F.col("id")) | (F.col("full") & F.col("full_back"))
    found, total = joined.agg(F.count(F.when(held, 1)), F.count("*")).first()
    return found / total if total else 1.0


def _lists_of_all_pairs(nodes: DataFrame, n: int, k: int) -> DataFrame:
    """Exact lists: every block of nodes meets every other."""
    parts = math.ceil(n / PRODUCT)
    dealt = nodes.select("id", "vec", F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    cells = cells.select(F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "id", "vec")
    return _merged(_block_lists(cells, ["i", "j"], k), k)


def neighbour_graph(nodes: DataFrame, dim: int, n: int, cosine: float) -> tuple[DataFrame, int]:
    """(id, nbrs, sims) of nodes of one length, and the length of the lists."""
    k = NEIGHBOURS
    truth = _audit_links(nodes, cosine)
    graph = materialize(_first_lists(nodes, dim, n, cosine, 1, k), "first-lists")
    for audit in range(AUDITS):
        for _ in range(ROUNDS):
            graph = materialize(_round(graph, nodes, k), "descent-lists")
        if _recall(graph, truth, cosine, k) >= RECALL:
            return graph, k
        if audit + 1 < AUDITS:
            k *= 2  # longer lists, and leaves of other hyperplanes to start from
            more = _first_lists(nodes, dim, n, cosine, audit + 2, k)
            graph = materialize(_merged(more.union(graph.select("id", "nbrs", "sims")), k), "longer-lists")
    return materialize(_lists_of_all_pairs(nodes, n, k), "exact-lists"), k


def _component_products(members: DataFrame, cosine: float) -> DataFrame:
    """(id, links) from all pairs of each component, block by block."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    cut = members.join(sizes, "component").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    cut = materialize(cut, "component-parts")
    parts = F.sequence(F.lit(0), F.col("parts") - 1)
    left = cut.withColumn("other", F.explode(parts)).select("component", F.col("part").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"), "id", "twins", "vec")
    right = cut.withColumn("other", F.explode(parts)).select("component", F.col("other").alias("i"), F.col("part").alias("j"), F.lit(1).alias("side"), "id", "twins", "vec")
    names = ["component", "i", "j"]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, marks in grouped(batches, names, 2_000):
            unit = _unit(table.column("vec").combine_chunks())
            side, ids, twins = (table.column(c).to_numpy() for c in ("side", "id", "twins"))
            out = []
            for begin, end in zip(marks[:-1], marks[1:]):
                middle = begin + int(np.searchsorted(side[begin:end], 1))
                hit = unit[begin:middle] @ unit[middle:end].T >= cosine
                hit &= ids[begin:middle, None] != ids[None, middle:end]
                out.append((ids[begin:middle], hit @ twins[middle:end]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["id", "links"])

    rows = left.union(right).repartition(*names).sortWithinPartitions(*names, "side", "id")
    return rows.mapInArrow(multiply, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of (vec_id, embedding)."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.coalesce(sound, F.lit(False)).alias("sound"))
    prints = [F.xxhash64("embedding").alias("print1"), F.hash("embedding").alias("print2")]
    sound_rows = rows.where("sound AND vec_id IS NOT NULL").select("vec_id", "embedding", *prints)
    classes = sound_rows.groupBy("print1", "print2").agg(F.min("vec_id").alias("id"), F.count_distinct("vec_id").alias("twins"))
    classes = materialize(classes, "vector-classes")
    member = materialize(sound_rows.select("vec_id", "print1", "print2").join(classes, ["print1", "print2"]).select("vec_id", "id", "twins").distinct(), "vector-members")
    heads = sound_rows.join(classes.select("id", "twins", "print1", "print2"), ["print1", "print2"]).where("vec_id = id")
    nodes = materialize(heads.select("id", "twins", F.col("embedding").alias("vec")).dropDuplicates(["id"]), "vector-nodes")

    # Vectors of one length at a time; a corpus has one or few.
    lengths = nodes.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).collect()
    no_edges = nodes.select(F.col("id").alias("u"), F.col("id").alias("v")).limit(0)
    edges, saturated = no_edges, nodes.select("id").limit(0)
    for dim, n in sorted(lengths):
        graph, k = neighbour_graph(nodes.where(F.size("vec") == dim), dim, n, cosine)
        near = F.filter(F.arrays_zip("nbrs", "sims"), lambda e: e["sims"] >= cosine)
        linked = graph.select("id", F.explode(near).alias("e")).select("id", F.col("e.nbrs").alias("nbr"))
        edges = edges.union(linked.select(F.least("id", "nbr").alias("u"), F.greatest("id", "nbr").alias("v")))
        saturated = saturated.union(graph.where((F.size("sims") >= k) & (F.element_at("sims", -1) >= cosine)).select("id"))
    edges = materialize(edges.distinct(), "vector-links")
    found = materialize(components(edges), "vector-components")

    open_ids = found.join(saturated.distinct(), "id").select("component").distinct()
    inside = materialize(found.join(open_ids, "component", "left_semi").select("id", "component"), "open-components")
    inside = _merged_components(inside, nodes, cosine)
    found = found.join(inside.select("id"), "id", "left_anti").select("id", "component").union(inside)
    complete = _component_products(inside.join(nodes, "id"), cosine)
    rest = edges.join(inside.select(F.col("id").alias("u")), "u", "left_anti")
    both = rest.union(rest.select(F.col("v").alias("u"), F.col("u").alias("v")))
    counted = both.join(nodes.select(F.col("id").alias("v"), "twins"), "v").groupBy(F.col("u").alias("id")).agg(F.sum("twins").alias("links"))

    # A vector's class, then its rows.
    links = complete.unionByName(counted)
    named = member.join(links, "id", "left").join(found, "id", "left")
    n_links = F.coalesce("links", F.lit(0)) + F.col("twins") - 1
    each = named.groupBy("vec_id").agg(F.max(n_links).alias("n_links"), F.min(F.coalesce("component", "id")).alias("component_id"))
    out = rows.select("vec_id").join(each, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
