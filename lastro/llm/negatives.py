"""Hard negatives of anchors, by a shuffle sorted on (anchor, score, id)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import Scratch

#: Scores of anchors against rows that are held at once in a task.
HELD = 1 << 20
_FLOAT, _WHOLE = 2.0**53, 2.0**55


@dataclass(frozen=True)
class Settings:
    """What is mined.

    ``positives``    rows of the anchor's label, the first ones, that count
    ``negatives``    rows of other labels listed for each positive
    ``low, high``    a negative's score, as percentages of the positive's
    ``scale``        components are multiplied by it and rounded down
    ``block_bytes``  anchors broadcast at once; more take further passes
    """

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256
    block_bytes: int = 32 << 20

    def __post_init__(self):
        # a negative then never comes before its positive, but for equal scores
        if not 0 <= self.low < self.high <= 100:
            raise ValueError("0 <= low < high <= 100 is needed")


def valid_rows(vectors: DataFrame, label: Column | str, id_col: str,
               vector_col: str) -> DataFrame:
    """(id, label, vector) rows that take part, one an id.

    Without an id, a label or a vector, or with a NULL or non-finite component,
    a row takes no part. Of rows that share an id, the one with the smallest
    label, then the smallest vector, stands for all.
    """
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"),
                           vector.cast("array<double>").alias("vector"), finite.alias("_ok"))
            .where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND _ok"))
    return (rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
            .select("id", F.col("row.label").cast("long").alias("label"), "row.vector"))


def _matrices(ids, labels, vectors: pa.ListArray, scale: int,
              ) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By dimension, the ids, labels and whole-number vectors, in order of id."""
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False))
    ends = np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy(
        zero_copy_only=False))]).astype(int)
    sizes, order = np.diff(ends), np.argsort(ids, kind="stable")
    found = {}
    for size in np.unique(sizes):
        rows = order[sizes[order] == size]
        at = ends[rows][:, None] + np.arange(size)
        found[int(size)] = ids[rows], labels[rows], values[at].reshape(len(rows), size)
    return found


def _of_batch(batch: pa.RecordBatch, scale: int):
    return _matrices(batch.column(0).to_numpy(zero_copy_only=False),
                     batch.column(1).to_numpy(zero_copy_only=False),
                     batch.column(2), scale)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products, as int64, of whole-number rows held as floats."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max())
    if most < _FLOAT:  # every partial sum is exact
        return (a @ b.T).astype(np.int64)
    if most < _WHOLE:
        return a.astype(np.int64) @ b.astype(np.int64).T
    raise ValueError("components are too large: scores would pass 55 bits")


class _First:
    """The first ``most`` rows of each group by descending score and id."""

    def __init__(self, groups: int, most: int):
        self.most = most
        self.least = np.full(groups, np.iinfo(np.int64).min)
        self.rows = tuple(np.empty(0, np.int64) for _ in range(3))
        self.new: list[tuple] = []

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(group):
            self.new.append((group, score, ids))
            if sum(len(n[0]) for n in self.new) > 4 * len(self.rows[0]) + 10_000:
                self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [self.rows, *self.new]
        group, score, ids = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        nth = np.arange(len(group)) - np.repeat(starts, np.diff(starts, append=len(group)))
        self.rows = tuple(x[nth < self.most] for x in (group, score, ids))
        full = nth == self.most - 1
        self.least[group[full]] = score[full]
        self.new = []
        return self.rows


def _slices(anchors: int, rows: int) -> Iterator[slice]:
    step = max(1, HELD // max(1, rows))
    return (slice(k, k + step) for k in range(0, anchors, step))


def _closest_of_label(block, settings: Settings):
    """(anchor, id, score): a task's first rows of each anchor's label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = block.value
        first = {d: _First(len(a[0]), settings.positives) for d, a in known.items()}
        for batch in batches:
            for size, (ids, labels, x) in _of_batch(batch, settings.scale).items():
                if size not in known:
                    continue
                keys, own, vectors = known[size]
                for part in _slices(len(keys), len(ids)):
                    found = scores(vectors[part], x)
                    wanted = ((own[part, None] == labels) & (keys[part, None] != ids)
                              & (found >= first[size].least[part, None]))
                    a, r = np.nonzero(wanted)
                    first[size].add(a + part.start, found[a, r], ids[r])
        for size, best in first.items():
            group, score, ids = best.settle()
            yield pa.RecordBatch.from_arrays(
                [pa.array(known[size][0][group]), pa.array(ids), pa.array(score)],
                ["anchor", "id", "score"])
    return run


def _within_windows(block, positives, settings: Settings):
    """(anchor, down, id): a task's first rows within each positive's window.

    A row that several windows of an anchor hold is given once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, windows = block.value, positives.value
        each = settings.positives
        first = {d: _First(len(a[0]) * each, settings.negatives) for d, a in known.items()}
        for batch in batches:
            for size, (ids, labels, x) in _of_batch(batch, settings.scale).items():
                if size not in known:
                    continue
                keys, own, vectors = known[size]
                for part in _slices(len(keys), len(ids)):
                    found = scores(vectors[part], x)
                    other = own[part, None] != labels
                    for k in range(each):
                        given, score = windows[size]
                        place = np.arange(len(keys))[part] * each + k
                        of = score[part, k, None]
                        wanted = (other & given[part, k, None]
                                  & (100 * found >= settings.low * of)
                                  & (100 * found <= settings.high * of)
                                  & (found >= first[size].least[place, None]))
                        a, r = np.nonzero(wanted)
                        first[size].add(place[a], found[a, r], ids[r])
        for size, best in first.items():
            place, score, ids = best.settle()
            rows = np.unique(np.stack([place // each, -score, ids]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(known[size][0][rows[0]]), pa.array(rows[1]),
                 pa.array(rows[2])], ["anchor", "down", "id"])
    return run


class _Anchor:
    """The open windows of the anchor whose rows are passing by."""

    def __init__(self, key: int, settings: Settings):
        self.key, self.settings = key, settings
        self.windows: list[list] = []  # positive, its score, negatives given
        self.level, self.ties = None, []

    def step(self, score: int, row: int, positive: bool) -> Iterator[tuple]:
        if score != self.level:
            self.level, self.ties = score, []
        if positive:
            self.windows.append([row, score, 0])
            for tie in self.ties:  # of an equal score, and a smaller id
                yield from self.offer(self.windows[-1], score, tie)
            return
        if len(self.ties) < self.settings.negatives:
            self.ties.append(row)
        for window in self.windows:
            yield from self.offer(window, score, row)

    def offer(self, window: list, score: int, row: int) -> Iterator[tuple]:
        positive, of, given = window
        s = self.settings
        if given < s.negatives and s.low * of <= 100 * score <= s.high * of:
            window[2] += 1
            yield self.key, positive, window[2], row, of, score


def _stream(settings: Settings):
    """Reads rows sorted by (anchor, descending score, id) and writes triples."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
             "negative_score"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = None
        for batch in batches:
            out: list[tuple] = []
            for key, down, row, positive in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor is None or anchor.key != key:
                    anchor = _Anchor(key, settings)
                out.extend(anchor.step(-down, row, positive))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names)
    return run


def _first_of(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows of each anchor; each task sent it that many."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "id")))
    return (found.groupBy("anchor").agg(F.slice(ranked, 1, most).alias("rows"))
            .select("anchor", F.explode("rows").alias("row"))
            .select("anchor", "row.down", "row.id"))


def hard_negatives(vectors: DataFrame, anchors: Column, label: Column | str = "label",
                   settings: Settings = Settings(), id_col: str = "vec_id",
                   vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` says which rows of ``vectors`` are anchors. A row's score is its
    exact whole-number inner product with the anchor; higher scores come first,
    then smaller ids. An anchor's positives are its first rows of the same label
    but itself; for each of them the first rows of other labels are listed whose
    score lies between ``low`` and ``high`` percent of its own.

    * All rows are compared with blocks of anchors, each broadcast within
      ``block_bytes``. A task sends no pair that it knows not to be listed: at
      most ``positives`` rows, then ``negatives`` a window, for each anchor.
    * These are shuffled by anchor and sorted within partitions by (anchor,
      descending score, id). One pass over the sorted rows opens a window at
      each positive and writes negatives as they come, and so holds a few
      windows, never an anchor's rows.
    * Rows that ``valid_rows`` leaves out, and pairs of different dimensions,
      take no part. A positive of negative score has an empty window. Empty
      tables, and anchors without positives, give no rows. Columns of the input
      besides the three used are ignored, whatever their names. Scores of more
      than 55 bits are refused.
    """
    spark = vectors.sparkSession
    with Scratch(spark) as scratch:
        asked = vectors.where(anchors).select(F.col(id_col).cast("long").alias("id"))
        rows = scratch.stage(valid_rows(vectors, label, id_col, vector_col), "rows")
        chosen = scratch.stage(rows.join(asked.distinct(), "id", "left_semi"), "anchors")
        size = chosen.agg(F.sum(F.size("vector") * 8 + 16)).first()[0] or 0
        blocks = -(-size // settings.block_bytes)
        own_block = F.pmod(F.xxhash64("id"), F.lit(max(1, blocks)))
        parts = []
        for number in range(blocks):
            batch = chosen.where(own_block == number).toArrow().combine_chunks()
            if not batch.num_rows:
                continue
            block = _matrices(*(batch.column(k).to_numpy() for k in (0, 1)),
                              batch.column(2).combine_chunks(), settings.scale)
            sent = spark.sparkContext.broadcast(block)
            found = rows.mapInArrow(_closest_of_label(sent, settings),
                                    "anchor long, id long, score long")
            positives = scratch.stage(_first_of(found, settings.positives),
                                      f"positives-{number}")
            windows = spark.sparkContext.broadcast(
                _windows(block, positives.toArrow(), settings.positives))
            pairs = rows.mapInArrow(_within_windows(sent, windows, settings),
                                    "anchor long, down long, id long")
            parts.append(scratch.stage(
                pairs.withColumn("positive", F.lit(False)).union(
                    positives.withColumn("positive", F.lit(True))), f"pairs-{number}"))
        if not parts:
            parts = [spark.createDataFrame(
                [], "anchor long, down long, id long, positive boolean")]
        pairs = parts[0]
        for part in parts[1:]:
            pairs = pairs.union(part)
        result = (pairs.repartition("anchor").sortWithinPartitions("anchor", "down", "id")
                  .mapInArrow(_stream(settings),
                              "anchor_id long, positive_id long, rank int, "
                              "negative_id long, positive_score long, negative_score long"))
        result = scratch.stage(result, "negatives")
        scratch.keep("negatives")
        return result


def _windows(block: dict, positives: pa.Table, each: int) -> dict:
    """By dimension, which of ``each`` windows an anchor has, and their scores."""
    anchor, down = (positives.column(k).to_numpy() for k in (0, 1))
    order = np.lexsort((down, anchor))
    anchor, score = anchor[order], -down[order]
    found = {}
    for size, (keys, _, _) in block.items():
        given, of = np.zeros((len(keys), each), bool), np.zeros((len(keys), each), np.int64)
        start, end = np.searchsorted(anchor, keys), np.searchsorted(anchor, keys, "right")
        for k in range(each):
            has = start + k < end
            given[:, k] = has
            of[has, k] = score[start[has] + k]
        found[size] = given, of
    return found
