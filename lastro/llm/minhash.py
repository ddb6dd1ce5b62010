"""Near-duplicate documents by MinHash signatures, banding and components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import Scratch
from .common import free, raw, spread_join, with_small
from .components import connected_components

#: Words whose hashes a worker remembers.
WORDS_KEPT = 300_000
#: Rows of one band that are compared in one piece, by signatures and by sets.
BLOCK, SET_BLOCK = 2000, 500
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """How documents are compared.

    ``width``    words of a shingle; a shorter text is one shingle
    ``percent``  least similarity, 100 * intersection / union of shingle sets
    ``bands``    groups of hashes; sharing one makes two documents candidates
    ``rows``     hashes of a group. At 80 % similarity, 32 bands of 5 rows miss
                 three pairs in a million, at 85 % six in a billion
    """

    width: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def least_equal(self) -> int:
        """Equal hashes below which a signature rules a pair out: 5 deviations."""
        p = self.percent / 100
        return int(self.hashes * p - 5 * (self.hashes * p * (1 - p)) ** 0.5)


class WordHashes(dict):
    """64-bit hash of a word, remembered for the first words seen."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < WORDS_KEPT:
            self[word] = value
        return value


_words = WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(30)
    x *= np.uint64(_MIX[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(_MIX[1])
    x ^= x >> np.uint64(31)
    return x


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a UTF-8 text.

    Upper-case A-Z count as lower-case; words are runs of anything but space
    and the controls 9 to 13. A text of fewer words is one shingle, told apart
    from longer ones; a text without words has none.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    w = min(width, n)
    s = _mixed(one[:n - w + 1] + np.uint64(w))
    for k in range(1, w):
        s = _mixed(s * _STEP + one[k:n - w + 1 + k])
    return np.unique(s)


def hash_family(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``count`` multiply-shift hash functions."""
    random = np.random.default_rng(seed)
    factor = random.integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)
    return factor, random.integers(0, 2**63, count, np.uint64)


def signature(shingles: np.ndarray, factor: np.ndarray,
              offset: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a set, as 32 bits."""
    least = np.full(len(factor), 2**64 - 1, np.uint64)
    for start in range(0, len(shingles), 512):
        part = shingles[start:start + 512, None] * factor
        part += offset
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sketches(width: int, hashes: int):
    factor, offset = hash_family(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, signatures, seen = [], [], [], 0
            for text in batch.column(1):
                s = shingle_hashes(text.as_py(), width)
                counts.append(len(s))
                digests.append(blake2b(s.tobytes(), digest_size=16).digest())
                if len(s):
                    signatures.append(signature(s, factor, offset))
                    seen += hashes
                else:
                    signatures.append(np.empty(0, np.int32))
            ends = np.cumsum([0] + [len(x) for x in signatures]).astype(np.int32)
            flat = np.concatenate([*signatures, np.empty(0, np.int32)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()),
                 pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["id", "n", "digest", "sig"])
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sets = [], []
            for text in batch.column(0):
                s = shingle_hashes(text.as_py(), width)
                digests.append(blake2b(s.tobytes(), digest_size=16).digest())
                sets.append(s.view(np.int64))
            ends = np.cumsum([0] + [len(x) for x in sets]).astype(np.int32)
            flat = np.concatenate([*sets, np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["digest", "shingles"])
    return run


def sketch(docs: DataFrame, settings: Settings, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, n, digest, sig) of each row: set size, digest of the set, minima."""
    return (docs.select(F.col(id_col).cast("long").alias("id"), raw(text_col).alias("text"))
            .mapInArrow(_sketches(settings.width, settings.hashes),
                        "id long, n long, digest binary, sig array<int>"))


def _classes(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(digest, least, node, n, sig) of each different set that a row with an id has.

    ``node`` is the smallest id with that set. Where one id is that of several
    sets, the others get a number above every id, made from their digest.
    """
    named = rows.where("id IS NOT NULL AND n > 0")
    several = scratch.stage(
        named.groupBy("digest").agg(F.min("id").alias("least")).groupBy("least")
        .agg(F.min("digest").alias("own"), F.count("*").alias("sets"))
        .where("sets > 1").select("least", "own"), "several")
    several = with_small(several, several.count())
    classes = named.groupBy("digest").agg(
        F.min("id").alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    other = F.xxhash64("digest").bitwiseAND(F.lit(2**61 - 1)) + F.lit(2**62)
    node = F.when(F.col("own") != F.col("digest"), other).otherwise(F.col("least"))
    return classes.join(several, "least", "left").select(
        "digest", "least", node.alias("node"), "n", "sig")


def _bands(settings: Settings):
    """Each band of a signature as one 64-bit key."""
    r = settings.rows
    return F.array(*(
        F.xxhash64(F.lit(b), *(F.col("sig")[b * r + k] for k in range(r)))
        for b in range(settings.bands)))


def _equal_minima():
    same = F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, x: total + x)


def _sizes_allow(settings: Settings):
    return (100 * F.least("n_a", "n_b")
            >= settings.percent * F.greatest("n_a", "n_b"))


def _of_nodes(classes: DataFrame, nodes: DataFrame, scratch: Scratch,
              label: str) -> DataFrame:
    """The signatures of some nodes, so that no others are moved for a join."""
    wanted = scratch.stage(nodes.distinct(), label)
    return classes.select("node", "n", "sig").join(
        with_small(wanted, wanted.count()), "node", "left_semi")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(
        pairs.select(F.col("b").alias("node")))


def _signatures_pass(pairs: DataFrame, classes: DataFrame, settings: Settings,
                     scratch: Scratch) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow the similarity asked for.

    ``a`` may be one class in a third of the pairs, so its side is spread.
    """
    known = _of_nodes(classes, _ends(pairs), scratch, "star-ends")

    def side(end: str) -> DataFrame:
        return known.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"),
                              F.col("sig").alias(f"sig_{end}"))
    return (spread_join(pairs, side("a"), "a").join(side("b"), "b")
            .where(_sizes_allow(settings))
            .where(_equal_minima() >= settings.least_equal)
            .select("a", "b"))


def _shingle_sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame,
                  settings: Settings, scratch: Scratch, label: str, id_col: str,
                  text_col: str) -> DataFrame:
    """(node, shingles) of the given nodes, staged under ``label``.

    Sets are made again from the texts that are compared, so sets of
    documents that resemble nothing are never written.
    """
    need = scratch.stage(
        classes.select("node", "least", "digest").join(nodes.distinct(), "node"),
        f"{label}-need")
    size = need.count()
    ids = with_small(need.select("least").distinct(), size)
    texts = (docs.select(F.col(id_col).alias("least"), raw(text_col).alias("text"))
             .join(ids, "least", "left_semi").select("text"))
    # a text may repeat under its id, and an id may have other texts
    sets = (texts.mapInArrow(_sets(settings.width),
                             "digest binary, shingles array<long>")
            .join(with_small(need.select("node", "digest"), size), "digest")
            .groupBy("node")
            .agg(F.first("shingles").alias("shingles")))
    sets = scratch.stage(sets, label)
    scratch.release(f"{label}-need")
    return sets


def _confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar enough."""
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - both
    side = lambda end: sets.select(
        F.col("node").alias(end), F.col("shingles").alias(f"shingles_{end}"))
    return (spread_join(pairs, side("a"), "a").join(side("b"), "b")
            .where(100 * both >= settings.percent * union).select("a", "b"))


def _in_blocks(rows: DataFrame, block: int, columns: list[str]) -> DataFrame:
    """Rows of a band dealt so that any two meet in one group (band, i, j).

    The members of a band, ``size`` of them, are hashed into blocks of about
    ``block``. A group holds two blocks, or one with itself, so no task holds
    more, however many documents share the band.
    """
    blocks = F.ceil(F.col("size") / block)
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1))
    return (rows.withColumn("own", own).withColumn("other", other)
            .select("band", F.least("own", "other").alias("i"),
                    F.greatest("own", "other").alias("j"),
                    F.when(F.col("own") <= F.col("other"), 0).otherwise(1)
                    .alias("side"), *columns)
            .repartition("band", "i", "j").sortWithinPartitions("band", "i", "j"))


def _groups(batches: Iterator[pa.RecordBatch], values: str,
            ) -> Iterator[tuple[dict[str, np.ndarray], list[np.ndarray]]]:
    """Sorted rows, gathered by (band, i, j): their columns and their arrays."""
    held: dict[str, np.ndarray] = {}
    lists: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {f.name: batch.column(f.name).to_numpy(zero_copy_only=False)
                for f in batch.schema if f.name != values}
        column = batch.column(values)
        flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
        ends = ends - ends[0]
        lists = lists + [flat[s:e].copy() for s, e in zip(ends, ends[1:])]
        if held:
            rows = {k: np.concatenate([held[k], rows[k]]) for k in rows}
        change = np.flatnonzero((np.diff(rows["band"]) != 0) | (np.diff(rows["i"]) != 0)
                                | (np.diff(rows["j"]) != 0)) + 1
        cuts = [0, *change]
        for s, e in zip(cuts, cuts[1:]):
            yield {k: v[s:e] for k, v in rows.items()}, lists[s:e]
        held = {k: v[cuts[-1]:] for k, v in rows.items()}
        lists = lists[cuts[-1]:]
    if held:
        yield held, lists


def _others(group: dict[str, np.ndarray], percent: int,
            ) -> Iterator[tuple[int, np.ndarray]]:
    """Each row and those it is to be compared with: after it, or of the other
    block; of other components; of a size that allows the similarity."""
    left, right = np.flatnonzero(group["side"] == 0), np.flatnonzero(group["side"] == 1)
    n, c = group["n"], group["c"]
    for x in left:
        y = right if len(right) else left[left > x]
        y = y[(c[y] != c[x]) & (100 * np.minimum(n[x], n[y])
                                >= percent * np.maximum(n[x], n[y]))]
        if len(y):
            yield x, y


def _with_candidates(settings: Settings):
    """(band, node) of rows with a partner that signatures allow.

    A pair counts in the first band that it shares.
    """
    def first_band(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        same = (x == y).reshape(len(y), settings.bands, settings.rows).all(axis=2)
        return same.argmax(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, lists in _groups(batches, "sig"):
            if (group["c"] == group["c"][0]).all():
                continue
            sig, number = np.array(lists), group["number"][0]
            marked = np.zeros(len(sig), bool)
            for x, y in _others(group, settings.percent):
                y = y[(sig[y] == sig[x]).sum(axis=1) >= settings.least_equal]
                y = y[first_band(sig[x], sig[y]) == number] if len(y) else y
                marked[y] = True
                marked[x] |= len(y) > 0
            if marked.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group["band"][marked]), pa.array(group["node"][marked])],
                    ["band", "node"])
    return run


def _linked(percent: int):
    """Links (a, b) between components, confirmed on full sets.

    Links that would join what a group has joined already are left out, so a
    group gives fewer of them than it has rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, sets in _groups(batches, "shingles"):
            if (group["c"] == group["c"][0]).all():
                continue
            group["c"] = group["c"].copy()
            flat = np.concatenate(sets)
            codes = np.unique(flat, return_inverse=True)[1]
            ends = np.cumsum([0] + [len(x) for x in sets])
            mark = np.zeros(len(flat), bool)
            n, found = group["n"], []
            for x, y in _others(group, percent):
                y = y[group["c"][y] != group["c"][x]]  # some were joined meanwhile
                if not len(y):
                    continue
                own = codes[ends[x]:ends[x + 1]]
                mark[own] = True
                both = np.add.reduceat(mark[codes], ends[:-1])[y]
                mark[own] = False
                y = y[100 * both >= percent * (n[x] + n[y] - both)]
                for k in y:
                    if group["c"][k] != group["c"][x]:
                        found.append((group["node"][x], group["node"][k]))
                        group["c"][group["c"] == group["c"][k]] = group["c"][x]
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _across_components(bands: DataFrame, part: DataFrame, docs: DataFrame,
                       classes: DataFrame, settings: Settings, scratch: Scratch,
                       id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) between documents that share a band but no component yet.

    All pairs of such a band are looked at, in its tasks, and none leaves
    them: signatures tell which rows of which bands have a partner at all, and
    only these are sent again with their full sets.
    """
    mixed = scratch.stage(
        bands.join(part, "node").groupBy("band")
        .agg(F.min("c").alias("low"), F.max("c").alias("high"),
             F.count("*").alias("size"))
        .where("low < high").select("band", "size"), "mixed")
    rows = scratch.stage(bands.select("node", "number", "band").join(mixed, "band")
                         .join(part, "node"), "mixed-rows")
    known = _of_nodes(classes, rows.select("node"), scratch, "mixed-nodes")
    rows = rows.join(known, "node")
    marked = scratch.stage(
        _in_blocks(rows, BLOCK, ["number", "node", "c", "n", "sig"])
        .mapInArrow(_with_candidates(settings), "band long, node long")
        .distinct(), "marked")
    sets = _shingle_sets(marked.select("node"), docs, classes, settings, scratch,
                         "rest-sets", id_col, text_col)
    sizes = marked.groupBy("band").agg(F.count("*").alias("size"))
    rows = (marked.join(sizes, "band").join(part, "node")
            .join(sets.withColumn("n", F.size("shingles").cast("long")), "node"))
    links = (_in_blocks(rows, SET_BLOCK, ["node", "c", "n", "shingles"])
             .mapInArrow(_linked(settings.percent), "a long, b long"))
    links = scratch.stage(links, "rest")
    scratch.release("mixed", "mixed-rows", "marked", "rest-sets")
    return links


def near_duplicates(docs: DataFrame, settings: Settings = Settings(),
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row of ``docs``.

    Documents are linked when the Jaccard similarity of their shingle sets
    reaches ``settings.percent``; a component is named by its smallest id, and
    ``kept`` is true for that id.

    * Rows whose sets are equal become one class at once. Classes that share a
      band are candidates: first each with the smallest of one of its bands;
      then, once those are linked, all pairs of a band that are still in
      different components. Signatures rule pairs out, full sets confirm them.
      Within a component no further pair is compared, and no pair that fails
      is ever written.
    * NULL and empty texts have no shingle and are linked with nothing. Rows
      without an id take no part: their component is NULL, and they are kept.
    * Rows that share an id are one document; links of any of them count.
    * Ids must be integers below 2^62. Other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        rows = scratch.stage(sketch(docs, settings, id_col, text_col), "sketch")
        classes = scratch.stage(_classes(rows, scratch), "classes")
        owned = spread_join(rows.where("n > 0").select("id", "digest"),
                            classes.select("digest", "node"), "digest")
        several = (owned.where("id IS NOT NULL").groupBy("id")
                   .agg(F.min("node").alias("a"), F.max("node").alias("most"))
                   .where("a < most").select("id", "a"))
        same_id = scratch.stage(
            owned.join(several, "id").select("a", F.col("node").alias("b")),
            "same-id")

        bands = classes.select("node", F.posexplode(_bands(settings))
                               .alias("number", "band"))
        stars = (bands.groupBy("band")
                 .agg(F.min("node").alias("a"), F.count("*").alias("size"))
                 .where("size > 1").select("band", "a"))
        shared = scratch.stage(  # bands of one document are of no use
            spread_join(scratch.stage(bands, "bands"), stars, "band"), "shared")
        scratch.release("bands")
        pairs = (shared.where("a != node")
                 .groupBy("node", "a").agg(F.count("*").alias("times"))
                 .groupBy("node").agg(F.max_by("a", F.struct("times", "a")).alias("a"))
                 .select("a", F.col("node").alias("b")))
        pairs = scratch.stage(pairs, "stars")
        passed = scratch.stage(
            _signatures_pass(pairs, classes, settings, scratch), "passed")
        sets = _shingle_sets(
            _ends(passed), docs, classes, settings, scratch, "sets", id_col, text_col)
        first = scratch.stage(_confirmed(passed, sets, settings), "first")
        scratch.release("stars", "passed", "sets")
        joined = connected_components(first.union(same_id), scratch, "joined")

        part = scratch.stage(
            shared.select("node").distinct().join(joined, "node", "left").select(
                "node", F.coalesce("component", "node").alias("c")), "part")
        second = _across_components(shared, part, docs, classes, settings, scratch,
                                    id_col, text_col)
        final = connected_components(joined.union(second), scratch, "final")

        class_of = (classes.select("digest", "node").join(final, "node", "left")
                    .select("digest", F.coalesce("component", "node").alias("found")))
        component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(
            F.coalesce("found", F.col("id")))
        result = (spread_join(rows.select("id", "n", "digest"), class_of,
                              "digest", "left")
                  .select("id", F.col("n").alias("n_shingles"),
                          component.cast("long").alias("component_id"))
                  .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))))
        return scratch_result(result, scratch, id_col)


def scratch_result(result: DataFrame, scratch: Scratch, id_col: str) -> DataFrame:
    """The result staged, with the id under its own name, and kept."""
    staged = scratch.stage(result.withColumnRenamed("id", id_col), "result")
    scratch.keep("result")
    return staged


def deduplicate(docs: DataFrame, settings: Settings = Settings(),
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one of each component.

    Rows without an id stay. Of rows that repeat the kept id, one stays.
    """
    found = near_duplicates(docs, settings, id_col, text_col)
    key = free(docs, "_key")
    dropped = found.where("NOT kept").select(F.col(id_col).alias(key)).distinct()
    repeated = (found.where(F.col(id_col).isNotNull() & F.col("kept"))
                .groupBy(F.col(id_col).alias(key)).count().where("count > 1")
                .select(key))
    same = F.col(id_col) == F.col(key)
    rows = docs.join(with_small(dropped, dropped.count()), same, "left_anti")
    times = repeated.count()
    if times == 0:  # ids are unique, as they should be
        return rows
    repeated = with_small(repeated, times)
    return rows.join(repeated, same, "left_anti").unionByName(
        rows.join(repeated, same, "left_semi").dropDuplicates([id_col]))
