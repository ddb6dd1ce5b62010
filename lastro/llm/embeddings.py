"""Near-duplicate vectors by a forest of random-projection trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import Scratch
from .common import bounded_sample, spread_join
from .components import connected_components
from .perfect import mixed

#: Vectors that the first splits are fitted on, and those that split a leaf
#: again; every vector is indexed.
SAMPLE_VECTORS, LEAF_SAMPLE = 20_000, 2_000
#: A split is fitted on so many vectors at least.
LEAST_SAMPLE = 32
#: Vectors of the sample for which a close partner is made and looked for.
PROBES = 2_000
#: Vectors of a leaf that are compared in one piece.
BLOCK = 1000


@dataclass(frozen=True)
class Settings:
    """How vectors are compared.

    ``cosine``      least similarity of a link
    ``trees``       trees of the forest; more are added, up to ``most_trees``,
                    until at most ``missed`` of the pairs at the least
                    similarity meet in no leaf, by probes of the sample
    ``leaf``        vectors, about, at which a node is split no more; leaves of
                    more than twice as many are split again
    ``spill``       half the width of the band around a split whose vectors go
                    to both sides, in lengths that the difference of a pair at
                    the least similarity has along one direction
    ``share``       most of a node's vectors that lie in that band
    ``crowded``     share of a node within ``spill`` of its middle from which
                    on it is a leaf: its vectors lie too close to be parted
    """

    cosine: float = 0.95
    trees: int = 4
    most_trees: int = 32
    missed: float = 0.001
    leaf: int = 600
    spill: float = 0.5
    share: float = 0.15
    crowded: float = 0.6


def _direction(key: int, width: int) -> np.ndarray:
    """A random direction, made again wherever its key is known."""
    way = np.random.default_rng(int(key)).normal(size=width)
    return way / np.linalg.norm(way)


@dataclass(frozen=True)
class Tree:
    """Nodes in rows: the key of a direction, a threshold, half the width of
    the band around it, and two children. A child below 0 is leaf number
    -1 - child. ``closed`` leaves are not split again.
    """

    root: int
    keys: np.ndarray
    cuts: np.ndarray
    spills: np.ndarray
    children: np.ndarray
    closed: np.ndarray

    @property
    def leaves(self) -> int:
        return len(self.closed)

    @classmethod
    def grow(cls, sample: np.ndarray, total: int, settings: Settings,
             random: np.random.Generator) -> Tree:
        """Split at the median of a random projection, again and again, until a
        node stands for about ``leaf`` of all ``total`` vectors, or has too few
        of the sample to tell where to split."""
        keys, cuts, spills, children, closed = [], [], [], [], []
        worth, width = total / max(1, len(sample)), sample.shape[1]
        wide = settings.spill * np.sqrt((2 - 2 * settings.cosine) / max(1, width))

        def node(rows: np.ndarray) -> int:
            crowded = False
            if len(rows) * worth > settings.leaf and len(rows) >= LEAST_SAMPLE:
                key = int(random.integers(1 << 62))
                along = sample[rows] @ _direction(key, width)
                cut = float(np.median(along))
                off = np.abs(along - cut)
                spill = min(wide, float(np.quantile(off, settings.share)))
                low, high = along <= cut + spill, along > cut - spill
                crowded = ((off <= wide).mean() >= settings.crowded
                           or low.all() or high.all())
                if not crowded:
                    here = len(cuts)
                    keys.append(key)
                    cuts.append(cut)
                    spills.append(spill)
                    children.append((0, 0))
                    children[here] = node(rows[low]), node(rows[high])
                    return here
            closed.append(crowded)
            return -len(closed)
        root = node(np.arange(len(sample)))
        return cls(root, np.array(keys, np.int64), np.array(cuts), np.array(spills),
                   np.array(children, np.int64).reshape(-1, 2), np.array(closed, bool))

    def graft(self, grown: dict[int, Tree]) -> Tree:
        """This tree with some of its leaves replaced by trees of their own.

        The numbers of other leaves stay, those of replaced ones are no more
        used. A leaf that its tree did not split is closed.
        """
        parts, children = [self, *grown.values()], self.children.copy()
        closed, root, nodes, leaves = self.closed.copy(), self.root, len(self.cuts), self.leaves
        moved = []
        for leaf, tree in grown.items():
            own = np.where(tree.children >= 0, tree.children + nodes, tree.children - leaves)
            if tree.root < 0:
                closed[leaf] = True
            else:
                children[children == -1 - leaf] = nodes + tree.root
                root = nodes + tree.root if root == -1 - leaf else root
            moved.append(own)
            nodes, leaves = nodes + len(tree.cuts), leaves + tree.leaves
        joined = lambda name: np.concatenate([getattr(p, name) for p in parts])
        return Tree(root, joined("keys"), joined("cuts"), joined("spills"),
                    np.concatenate([children, *moved]),
                    np.concatenate([closed, *(t.closed for t in grown.values())]))

    def find(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of each leaf that each vector falls into."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = [(self.root, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if node < 0:
                found.append((rows, np.full(len(rows), -node - 1)))
                continue
            along = (vectors[rows] @ _direction(self.keys[node], vectors.shape[1])
                     - self.cuts[node])
            for child, inside in zip(self.children[node],
                                     (along <= self.spills[node], along > -self.spills[node])):
                if inside.any():
                    waiting.append((int(child), rows[inside]))
        return (np.concatenate([f[0] for f in found]),
                np.concatenate([f[1] for f in found]))


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, raw, unit) of the valid vectors: not NULL, not empty, not zero,
    without NULL or non-finite components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, units = [], []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = value.values
                if part is None or not len(part) or part.null_count:
                    continue
                x = part.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                x = x / max(np.abs(x).max(), 5e-324)  # no overflow in the norm
                norm = np.sqrt((x * x).sum())
                if norm > 0 and np.isfinite(norm):
                    ids.append(key)
                    units.append((x / norm).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(units, pa.binary())],
                ["id", "unit"])
    return (vectors.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long"), vector_col)
            .mapInArrow(run, "id long, unit binary"))


def _by_width(units: list[bytes]) -> dict[int, np.ndarray]:
    """Vectors of each dimension, in rows."""
    sizes: dict[int, list] = {}
    for unit in units:
        x = np.frombuffer(unit)
        sizes.setdefault(len(x), []).append(x)
    return {size: np.array(rows) for size, rows in sizes.items()}


def sample_vectors(units: DataFrame, rows: int, seed: int) -> dict[int, np.ndarray]:
    """``rows`` of the (id, unit) rows, by dimension; ids are chosen first, so
    no task sends vectors that are not wanted."""
    chosen = F.broadcast(bounded_sample(units.select("id"), "id", rows, seed))
    return _by_width([r[0] for r in units.join(chosen, "id", "left_semi")
                      .orderBy("id").select("unit").collect()])


def _leaves_of(forest, batch: pa.RecordBatch) -> Iterator[tuple]:
    """(place, row) arrays of a batch of (id, unit) rows, tree by tree."""
    units = [np.frombuffer(u.as_py()) for u in batch.column(1)]
    sizes = np.array([len(u) for u in units])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x = np.array([units[k] for k in rows])
        for number, tree in enumerate(forest.get(int(size), ())):
            row, leaf = tree.find(x)
            yield (int(size) << 40) + (number << 32) + leaf, rows[row]


def _counted(forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, _ in _leaves_of(forest.value, batch):
                places, counts = np.unique(place, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places), pa.array(counts)], ["place", "size"])
    return run


def _members(forest, chances):
    """(place, unit) of a sample of the members of each place in ``chances``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, chance = chances.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            draw = mixed(ids, 77) / 2.0**64
            for place, row in _leaves_of(forest.value, batch):
                at = np.minimum(np.searchsorted(places, place), len(places) - 1)
                own = (places[at] == place) & (draw[row] < chance[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[own]), batch.column(1).take(pa.array(row[own]))],
                    ["place", "unit"])
    return run


_GROWN = "place long, root long, keys binary, cuts binary, spills binary, children binary, " \
         "closed binary"


def _grown(sizes, settings: Settings, seed: int):
    """A tree for each place, from rows of its sample sorted by place."""
    def tree(place: int, units: list[bytes]) -> pa.RecordBatch:
        places, counts = sizes.value
        total = int(counts[np.searchsorted(places, place)])
        own = Tree.grow(np.array([np.frombuffer(u) for u in units]), total, settings,
                        np.random.default_rng([seed, place]))
        arrays = own.keys, own.cuts, own.spills, own.children, own.closed
        return pa.RecordBatch.from_arrays(
            [pa.array([place]), pa.array([own.root]),
             *(pa.array([x.tobytes()], pa.binary()) for x in arrays)],
            [c.split()[0] for c in _GROWN.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, units = None, []
        for batch in batches:
            for place, unit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if place != held:
                    if units:
                        yield tree(held, units)
                    held, units = place, []
                units.append(unit)
        if units:
            yield tree(held, units)
    return run


def split_again(units: DataFrame, forest: dict[int, list[Tree]], settings: Settings,
                seed: int, turns: int = 12) -> dict[int, list[Tree]]:
    """``forest`` with leaves of more than twice ``leaf`` vectors split again.

    Leaves are counted over all vectors. Large ones are fitted anew from a
    sample of their own members, each in a task, until none is left but those
    whose vectors lie too close. The driver holds the trees, 37 bytes a node,
    which is about a node for every ``leaf`` vectors and tree.
    """
    spark = units.sparkSession
    for turn in range(turns):
        sent = spark.sparkContext.broadcast(forest)
        counts = (units.select("id", "unit").mapInArrow(_counted(sent), "place long, size long")
                  .groupBy("place").agg(F.sum("size").alias("size"))
                  .where(F.col("size") > 2 * settings.leaf).orderBy("place").collect())
        large = [(r[0], r[1]) for r in counts
                 if not forest[r[0] >> 40][r[0] >> 32 & 255].closed[r[0] & (1 << 32) - 1]]
        if not large:
            break
        places, sizes = (np.array(c) for c in zip(*large))
        chances = spark.sparkContext.broadcast((places, LEAF_SAMPLE / sizes))
        totals = spark.sparkContext.broadcast((places, sizes))
        grown = (units.select("id", "unit")
                 .mapInArrow(_members(sent, chances), "place long, unit binary")
                 .repartition("place").sortWithinPartitions("place")
                 .mapInArrow(_grown(totals, settings, seed + turn), _GROWN).collect())
        by_tree: dict[tuple, dict[int, Tree]] = {}
        for r in grown:
            children = np.frombuffer(r["children"], np.int64).reshape(-1, 2)
            tree = Tree(r["root"], np.frombuffer(r["keys"], np.int64),
                        np.frombuffer(r["cuts"]), np.frombuffer(r["spills"]), children,
                        np.frombuffer(r["closed"], bool))
            by_tree.setdefault((r["place"] >> 40, r["place"] >> 32 & 255), {})[
                r["place"] & (1 << 32) - 1] = tree
        forest = {size: [t.graft(by_tree[size, k]) if (size, k) in by_tree else t
                         for k, t in enumerate(trees)] for size, trees in forest.items()}
    return forest


def missed_pairs(sample: np.ndarray, trees: list[Tree], cosine: float,
                 random: np.random.Generator) -> float:
    """The share of vectors that meet a partner, made at exactly ``cosine`` in a
    random direction, in no leaf of any tree."""
    own = sample[:PROBES]
    if own.shape[1] < 2 or not len(own):
        return 0.0
    aside = random.normal(size=own.shape)
    aside -= (aside * own).sum(axis=1, keepdims=True) * own
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    partner = cosine * own + np.sqrt(1 - cosine * cosine) * aside
    met = np.zeros(len(own), bool)
    for tree in trees:
        places = [row * np.int64(tree.leaves) + leaf
                  for row, leaf in (tree.find(own), tree.find(partner))]
        met[np.intersect1d(*places) // tree.leaves] = True
    return float(1 - met.mean())


def fit_forest(units: DataFrame, settings: Settings, seed: int = 23,
               ) -> dict[int, list[Tree]]:
    """By dimension, trees over (id, unit) rows, in which close pairs meet.

    The first splits of a tree are fitted on a bounded sample, leaves that are
    large by the count of all vectors on samples of their own. Trees are added
    until probes find that ``settings.missed`` holds.
    """
    total = units.count()
    sample = sample_vectors(units, SAMPLE_VECTORS, seed)
    drawn = max(1, sum(map(len, sample.values())))
    random = np.random.default_rng(seed)
    forest: dict[int, list[Tree]] = {size: [] for size in sample}
    wanted = dict.fromkeys(sample, settings.trees)
    for turn in range(4):
        new = {size: [Tree.grow(rows, total * len(rows) // drawn, settings, random)
                      for _ in range(wanted[size] - len(forest[size]))]
               for size, rows in sample.items()}
        new = split_again(units, new, settings, seed + 1000 * turn)
        forest = {size: forest[size] + new[size] for size in forest}
        for size, rows in sample.items():
            missed = missed_pairs(rows, forest[size], settings.cosine, random)
            if missed > settings.missed:
                each = missed ** (1 / len(forest[size]))  # of one tree alone
                more = np.log(settings.missed / 2) / np.log(min(each, 0.99))
                wanted[size] = min(settings.most_trees,
                                   max(len(forest[size]) + 1, int(np.ceil(more))))
        if all(wanted[size] == len(trees) for size, trees in forest.items()):
            break
    return forest


def _placed(forest):
    """(place, id, unit, places, weight) for each leaf of each vector.

    A place is a leaf of one tree and one dimension; ``places`` has all those
    of the vector in order, by which a pair is known where it meets first. A
    dimension that the sample missed is one leaf.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value
        for batch in batches:
            units = [np.frombuffer(u.as_py()) for u in batch.column(1)]
            sizes = np.array([len(u) for u in units])
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x = np.array([units[k] for k in rows])
                at, place = [np.empty(0, int)], [np.empty(0, int)]
                base = int(size) << 40
                for number, tree in enumerate(trees.get(int(size), ())):
                    row, leaf = tree.find(x)
                    at.append(row)
                    place.append(base + (number << 32) + leaf)
                at, place = np.concatenate(at), np.concatenate(place)
                if not len(at):
                    at, place = np.arange(len(x)), np.full(len(x), base)
                order = np.lexsort((place, at))
                at, place = at[order], place[order]
                ends = np.searchsorted(at, np.arange(len(x) + 1))
                lists = [place[s:e] for s, e in zip(ends, ends[1:])]
                take = pa.array(rows[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place), batch.column(0).take(take),
                     batch.column(1).take(take),
                     pa.array([lists[k] for k in at], pa.list_(pa.int64())),
                     batch.column(2).take(take)],
                    ["place", "id", "unit", "places", "copies"])
    return run


def _compare(least: float):
    """(id, links, root) of the vectors of each group that have a link in it.

    ``links`` counts linked vectors, copies included, of pairs that meet here
    first; ``root`` is the smallest id the vector is joined with in the group.
    A pair that meets in an earlier place was counted there.
    """
    def group_rows(rows: dict, units: list, places: list):
        x = np.array([np.frombuffer(u) for u in units])
        here, side = rows["place"][0], rows["side"]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(right)
        right = left if alone else right
        # which earlier places each vector is in, as bits
        known, number = np.unique(np.concatenate(places), return_inverse=True)
        earlier = np.zeros((len(x), max(1, int((known < here).sum()))), bool)
        owner = np.repeat(np.arange(len(x)), [len(p) for p in places])
        before = number < (known < here).sum()
        earlier[owner[before], number[before]] = True
        earlier = np.packbits(earlier, axis=1)

        links = np.zeros(len(x), np.int64)
        rank = np.empty(len(x), int)
        rank[np.argsort(rows["id"], kind="stable")] = np.arange(len(x))
        label = rank.copy()
        for k in left:
            others = right[right > k] if alone else right
            others = others[x[others] @ x[k] >= least]
            others = others[~(earlier[others] & earlier[k]).any(axis=1)]
            if len(others):
                links[k] += rows["copies"][others].sum()
                links[others] += rows["copies"][k]
                joined = np.append(label[others], label[k])
                if np.ptp(joined):
                    label[np.isin(label, joined)] = joined.min()
        some = np.flatnonzero(links)
        smallest = rows["id"][np.argsort(rank)]
        return rows["id"][some], links[some], smallest[label[some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scalars = ("place", "i", "j", "side", "id", "copies")
        held, units, places = {}, [], []

        def done(rows, u, p):
            a, b, c = group_rows(rows, u, p)
            return pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array(c)], ["id", "links", "root"])
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in scalars}
            units = units + batch.column("unit").to_pylist()
            places = places + [np.array(p.values) for p in batch.column("places")]
            if held:
                rows = {k: np.concatenate([held[k], rows[k]]) for k in rows}
            cuts = [0, *(np.flatnonzero((np.diff(rows["place"]) != 0)
                                        | (np.diff(rows["i"]) != 0)
                                        | (np.diff(rows["j"]) != 0)) + 1)]
            for s, e in zip(cuts, cuts[1:]):
                yield done({k: v[s:e] for k, v in rows.items()}, units[s:e], places[s:e])
            held = {k: v[cuts[-1]:] for k, v in rows.items()}
            units, places = units[cuts[-1]:], places[cuts[-1]:]
        if held:
            yield done(held, units, places)
    return run


def near_duplicates(vectors: DataFrame, settings: Settings = Settings(),
                    id_col: str = "vec_id", vector_col: str = "embedding",
                    ) -> DataFrame:
    """(id, n_links, component_id, kept) of each row of ``vectors``.

    Vectors of the same dimension are linked when their cosine, in double
    precision, reaches ``settings.cosine``. ``n_links`` counts the other rows
    linked directly, ``component_id`` is the smallest id reachable.

    * Equal directions become one class first. Each class falls into leaves of
      every tree, also into those beyond a split that it lies close to. Within
      leaves all pairs are compared; leaves are cut into blocks that meet two
      by two, so that a leaf may have any number of rows. A pair is counted
      only in the first leaf that both are in, and never leaves its task: each
      leaf gives a count and one edge for each vector.
    * Rows with a NULL, empty or zero vector, with NULL or non-finite components
      or without an id are linked with nothing: n_links 0, the component is
      their id. Rows that repeat an id are rows of their own that share a
      component if linked.
    * Only classes that no leaf brings together are missed; ``recall`` tells
      their share.
    """
    spark = vectors.sparkSession
    with Scratch(spark) as scratch:
        rows = scratch.stage(unit_vectors(vectors, id_col, vector_col), "units")
        classes = scratch.stage(
            rows.groupBy("unit").agg(F.min("id").alias("id"),
                                     F.count("*").alias("copies")), "classes")
        found = scratch.stage(class_links(classes, settings, scratch), "found")
        edges = found.select("id", "root")
        joined = connected_components(edges, scratch, "joined")
        counted = found.groupBy("id").agg(F.sum("links").alias("links"))
        of_class = (classes.join(counted, "id", "left").join(
            joined, F.col("id") == F.col("node"), "left")
            .select("unit", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
                    .alias("links"), F.coalesce("component", "id").alias("component")))
        known = scratch.stage(
            spread_join(rows, of_class, "unit").groupBy("id")
            .agg(F.max("links").alias("links"), F.min("component").alias("component"))
            .withColumnRenamed("id", "_id"), "known")
        result = (vectors.select(F.col(id_col)).join(
            known, F.col(id_col) == F.col("_id"), "left")
            .select(id_col, F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", F.col(id_col).cast("long"))
                    .alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))
        result = scratch.stage(result, "result")
        scratch.keep("result")
        return result


def class_links(classes: DataFrame, settings: Settings, scratch: Scratch) -> DataFrame:
    """(id, links, root) rows of the classes (unit, id, copies), by leaf."""
    spark = classes.sparkSession
    forest = spark.sparkContext.broadcast(
        fit_forest(classes.select("id", "unit"), settings))
    placed = scratch.stage(classes.select("id", "unit", "copies").mapInArrow(
        _placed(forest),
        "place long, id long, unit binary, places array<long>, copies long"), "placed")
    sizes = placed.groupBy("place").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK)
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    dealt = (spread_join(placed, sizes, "place").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
             .select("place", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j"),
                     F.when(F.col("own") <= F.col("other"), 0).otherwise(1)
                     .alias("side"), "id", "unit", "places", "copies"))
    return (dealt.repartition("place", "i", "j")
            .sortWithinPartitions("place", "i", "j")
            .mapInArrow(_compare(settings.cosine), "id long, links long, root long"))


def recall(vectors: DataFrame, found: DataFrame, settings: Settings = Settings(),
           id_col: str = "vec_id", vector_col: str = "embedding",
           queries: int = 500) -> float:
    """The share of true links that ``found`` counts, by brute force.

    The links of a bounded sample of vectors, ``queries`` of them, are counted
    against all rows and compared with their ``n_links``. 1.0 without links.
    """
    spark = vectors.sparkSession
    units = unit_vectors(vectors, id_col, vector_col)
    rows = bounded_sample(units, "id", queries, 29).collect()
    asked = spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [(k, np.frombuffer(u)) for k, u in asked.value]
        links = np.zeros(len(own), np.int64)
        for batch in batches:
            all_units = [np.frombuffer(u.as_py()) for u in batch.column(1)]
            for size in {len(u) for u in all_units}:
                x = np.array([u for u in all_units if len(u) == size])
                at = [k for k, (_, u) in enumerate(own) if len(u) == size]
                if at:
                    close = x @ np.array([own[k][1] for k in at]).T >= settings.cosine
                    links[at] += close.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in own], pa.int64()), pa.array(links)], ["id", "links"])
    true = (units.mapInArrow(run, "id long, links long").groupBy("id")
            .agg(F.sum("links").alias("links")))
    both = true.join(found, F.col("id") == F.col(id_col)).agg(
        F.sum(F.col("links") - 1), F.sum("n_links")).first()
    return float(both[1] / both[0]) if both[0] else 1.0
