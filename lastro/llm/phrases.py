"""Collocations: frequent phrases by mergeable summaries, then counted exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import Scratch
from .common import raw, spread_join

#: What parts pieces, and what parts the words of one.
_ENDS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: No byte of UTF-8: it stands for the end of a piece.
_END = b"\xff"
_TABLE = bytes(0xFF if b in _ENDS else 0x20 if b in _BLANKS else b for b in range(256))
#: Words that a task works through at once, words it knows, grams it holds.
CHUNK, KNOWN, HELD = 500_000, 1_000_000, 4_000_000
#: Counted phrases that a task holds before it sends them on.
PHRASES = 400_000
#: Bytes of a table of all languages that may be broadcast.
LANGUAGES = 8 << 20
#: Grams of one shuffled row.
ROW = 16_384
#: Ranked apart before all are, so that no task gets the phrases of a language.
_SALTS = 32


@dataclass(frozen=True)
class Settings:
    """What is mined.

    ``least``         occurrences of a candidate
    ``longest``       words of a candidate, at most
    ``covered``       percentage of a candidate's occurrences that lie in one
                      longer candidate, from which on it is dropped
    ``listed``        phrases of each language
    ``counters``      counters of the summary of one hash partition, about
    ``filter_bytes``  most that is broadcast to tell which grams may be frequent
    """

    least: int = 100
    longest: int = 5
    covered: int = 100
    listed: int = 2000
    counters: int = 1 << 18
    filter_bytes: int = 32 << 20


class _Words(dict):
    """Words to numbers from 1; 0 ends a piece. ``codes`` has their hashes."""

    def __init__(self):
        super().__init__({_END: 0})
        self.words, self._new = [b""], [0]
        self._codes = np.empty(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self._new.append(int.from_bytes(blake2b(word, digest_size=8).digest(), "little"))
        return number

    def codes(self) -> np.ndarray:
        self._codes = np.concatenate([self._codes, np.array(self._new, np.uint64)])
        self._new = []
        return self._codes

    def numbers(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The words of a text, and the piece that each is in."""
        found = text.lower().translate(_TABLE).replace(_END, b" \xff ").split()
        found = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        inside = found != 0
        return found[inside], np.cumsum(~inside)[inside]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chunks(batches: Iterator[pa.RecordBatch]):
    """(group, its known words, numbers, pieces) of about ``CHUNK`` words each.

    Texts of one group are worked through together; none is cut.
    """
    words, waiting = _Words(), {}

    def taken(group: str):
        return group, words, *words.numbers(_END.join(waiting.pop(group)[0]))
    for batch in batches:
        for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held = waiting.setdefault(group, [[], 0])
            held[0].append(text)
            held[1] += len(text)
            if held[1] > 6 * CHUNK:
                yield taken(group)
                if len(words) > KNOWN:
                    words = _Words()
    for group in list(waiting):
        yield taken(group)


class _Grams:
    """Hashes of the grams of one chunk, level by level."""

    def __init__(self, group: str, words: _Words, numbers: np.ndarray, pieces: np.ndarray):
        seed = int.from_bytes(blake2b(group.encode(), digest_size=8).digest(), "little")
        self.codes = words.codes()[numbers]
        self.pieces, self.level = pieces, 1
        self.at = np.arange(len(numbers))
        self.hashes = _mixed(self.codes + np.uint64(seed))

    def longer(self, beginning: np.ndarray | None = None) -> None:
        """Go on to grams of one word more: of all grams at hand, or of those
        in ``beginning``, a mask."""
        at, hashes = self.at, self.hashes
        if beginning is not None:
            at, hashes = at[beginning], hashes[beginning]
        end = at + self.level
        fits = end < len(self.pieces)
        fits[fits] = self.pieces[end[fits]] == self.pieces[at[fits]]
        self.at, self.level = at[fits], self.level + 1
        self.hashes = _mixed(hashes[fits] * np.uint64(0x9E3779B97F4A7C15)
                             + self.codes[end[fits]])


class _Filter:
    """Bits for the grams that may be frequent: a segment for each partition.

    Every gram that survived is in it, and few others. It has 24 bits a gram,
    or as many as its greatest size allows.
    """

    def __init__(self, partitions: int, segments: np.ndarray):
        self.shift = partitions.bit_length() - 1
        self.segments = segments

    @staticmethod
    def bits(survivors: int, partitions: int, most_bytes: int) -> int:
        """Bits of a segment: a power of two, from 64 on."""
        each = min(24 * survivors, 8 * most_bytes) // partitions
        return max(64, 1 << max(0, each.bit_length() - (24 * survivors > 8 * most_bytes)))

    @staticmethod
    def places(grams: np.ndarray, bits: int) -> np.ndarray:
        """Three places in a segment for each 32-bit gram."""
        hashes = _mixed(grams.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
        return np.stack([(hashes >> np.uint64(21 * k) if bits <= 1 << 21 else
                          _mixed(hashes + np.uint64(k))) & np.uint64(bits - 1)
                         for k in range(3)]).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        partition, gram = _placed(hashes, self.shift)
        bits = self.segments.shape[1] * 8
        found = np.ones(len(hashes), bool)
        for place in self.places(gram, bits):
            found &= (self.segments[partition, place >> 3] >> (place & 7) & 1).astype(bool)
        return found


def _placed(hashes: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The partition, and the 32-bit gram in it, of 64-bit hashes.

    Grams that share both are one to a summary, which only raises its counts.
    """
    partition = (hashes >> np.uint64(63 - shift) >> np.uint64(1)).astype(np.int64)
    return partition, ((hashes << np.uint64(shift)) >> np.uint64(32)).astype(np.uint32)


class _Tally:
    """Sorted hashes with counts, in bounded memory."""

    def __init__(self):
        self.new, self.size = [], 0
        self.hashes, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, hashes: np.ndarray) -> None:
        self.new.append(hashes)
        self.size += len(hashes)
        if self.size > HELD:
            self.settle()

    def settle(self) -> None:
        if self.new:
            hashes, counts = np.unique(np.concatenate(self.new), return_counts=True)
            self.new, self.size = [], 0
            self.hashes, self.counts = _summed(
                np.concatenate([self.hashes, hashes]), np.concatenate([self.counts, counts]))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


_SUMMARY = "part int, grams binary, counts binary"


def _summaries(levels: range, known, shift: int):
    """A task's counts of grams, cut up by partition: summaries without error.

    Grams of three words and more are taken only if all their pairs of words
    are in the filter ``known``.
    """
    def rows(tally: _Tally) -> Iterator[pa.RecordBatch]:
        part, gram = _placed(tally.hashes, shift)
        cuts = np.flatnonzero(np.diff(part)) + 1 if len(part) else []
        out = []
        for s, e in zip([0, *cuts], [*cuts, len(part)]):
            out += [(int(part[k]), gram[k:min(e, k + ROW)].tobytes(),
                     tally.counts[k:min(e, k + ROW)].astype("<u4").tobytes())
                    for k in range(s, e, ROW)]
        columns = list(zip(*out)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()))],
            ["part", "grams", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        pairs = known.value if known is not None else None
        for chunk in _chunks(batches):
            grams, followed = _Grams(*chunk), None
            while True:
                if grams.level in levels:
                    tally.add(grams.hashes)
                if grams.level == levels[-1]:
                    break
                if grams.level >= 2 and pairs is not None:
                    if followed is None:  # places at which a known pair begins
                        followed = np.zeros(len(grams.pieces) + 1, bool)
                        followed[grams.at[pairs.has(grams.hashes)]] = True
                    grams.longer(followed[grams.at] & followed[grams.at + grams.level - 1])
                else:
                    grams.longer()
            if len(tally.hashes) > HELD // 2:
                tally.settle()
                yield from rows(tally)
                tally = _Tally()
        tally.settle()
        yield from rows(tally)
    return run


class Summary:
    """A Misra-Gries summary that merges others into itself.

    Beyond its capacity, the count that one more counter would need is taken
    from all, which removes at least that many occurrences a counter; so with
    more counters than mass / ``least`` all that is taken stays below
    ``least``. Should a decrement reach it nevertheless, as the mass is not
    known before, the capacity is doubled instead. A gram of ``least``
    occurrences therefore always survives.
    """

    def __init__(self, capacity: int, least: int):
        self.capacity, self.least, self.taken = capacity, least, 0
        self.grams, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.new: list[tuple] = []
        self.waiting = 0

    def merge(self, grams: np.ndarray, counts: np.ndarray) -> None:
        self.new.append((grams, counts))
        self.waiting += len(grams)
        if self.waiting > self.capacity:
            self.settle()

    def settle(self) -> None:
        if self.new:
            self.grams, self.counts = _summed(*(
                np.concatenate([own, *(n[k] for n in self.new)])
                for k, own in enumerate((self.grams, self.counts))))
            self.new, self.waiting = [], 0
        while len(self.counts) > self.capacity:
            at = len(self.counts) - self.capacity - 1
            less = int(np.partition(self.counts, at)[at])
            if self.taken + less >= self.least:
                self.capacity *= 2
                continue
            kept = self.counts > less
            self.grams, self.counts = self.grams[kept], self.counts[kept] - less
            self.taken += less

    def survivors(self) -> np.ndarray:
        """All grams that may have ``least`` occurrences."""
        self.settle()
        return self.grams[self.counts + self.taken >= self.least]


def _merged(capacity: int, least: int):
    """(part, size, grams) of the survivors of each partition, rows sorted by it."""
    def done(part: int, summary: Summary) -> pa.RecordBatch:
        found = summary.survivors()
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([len(found)], pa.int64()),
             pa.array([found.tobytes()], pa.binary())], ["part", "size", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, summary = None, None
        for batch in batches:
            for number, grams, counts in zip(batch.column(0).to_pylist(), batch.column(1),
                                             batch.column(2)):
                if number != part:
                    if summary:
                        yield done(part, summary)
                    part, summary = number, Summary(capacity, least)
                summary.merge(np.frombuffer(grams.as_py(), "<u4"),
                              np.frombuffer(counts.as_py(), "<u4").astype(np.int64))
        if summary:
            yield done(part, summary)
    return run


def _segments(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for grams in batch.column(1):
                places = np.unique(_Filter.places(np.frombuffer(grams.as_py(), "<u4"), bits))
                own = np.zeros(bits // 8, np.uint8)
                np.bitwise_or.at(own, places >> 3, (1 << (places & 7)).astype(np.uint8))
                rows.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.binary())], ["part", "bits"])
    return run


def _filter(survivors: list[DataFrame], partitions: int, most_bytes: int) -> _Filter:
    """One filter of all ``survivors``, whose size ``most_bytes`` bounds."""
    total = sum(s.agg(F.sum("size")).first()[0] or 0 for s in survivors)
    bits = _Filter.bits(total, partitions, most_bytes)
    segments = np.zeros((partitions, bits // 8), np.uint8)
    for own in survivors:
        rows = own.select("part", "grams").mapInArrow(_segments(bits), "part int, bits binary")
        for part, data in rows.toLocalIterator():
            segments[part] |= np.frombuffer(data, np.uint8)
    return _Filter(partitions, segments)


def _key(group: str, words: int, phrase: bytes) -> bytes:
    group = group.encode()
    return len(group).to_bytes(4, "little") + group + bytes([words]) + phrase


def _of_key(key: bytes) -> tuple[str, int, bytes]:
    end = 4 + int.from_bytes(key[:4], "little")
    return key[4:end].decode(), key[end], key[end + 1:]


def _counted(known, longest: int):
    """(part, keys, counts): a task's counts of the phrases of the grams in the
    filter ``known``, and of all words as a phrase of none, many to a row."""
    def phrases(chunk, grams: _Grams) -> Iterator[tuple]:
        group, words, numbers, _ = chunk
        passing = known.value.has(grams.hashes)
        known_words, at = words.words, grams.at[passing]
        part = _placed(grams.hashes[passing], known.value.shift)[0]
        same = numbers[at]  # equal for equal phrases, whatever their hashes
        for k in range(1, grams.level):
            same = np.unique(same * len(known_words) + numbers[at + k],
                             return_inverse=True)[1]
        _, first, count = np.unique(same, return_index=True, return_counts=True)
        for own, where, times in zip(part[first].tolist(), at[first].tolist(), count.tolist()):
            yield own, _key(group, grams.level, b" ".join(
                [known_words[n] for n in numbers[where:where + grams.level].tolist()])), times

    def rows(tally: dict[int, dict[bytes, int]]) -> pa.RecordBatch:
        parts, keys, counts = [], [], []
        for part, found in tally.items():
            own, times = list(found), list(found.values())
            for k in range(0, len(own), ROW):
                parts.append(part)
                keys.append(own[k:k + ROW])
                counts.append(times[k:k + ROW])
        return pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), pa.array(keys, pa.list_(pa.binary())),
             pa.array(counts, pa.list_(pa.int64()))], ["part", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: dict[int, dict[bytes, int]] = {}
        for chunk in _chunks(batches):
            grams, followed = _Grams(*chunk), None
            found = [(0, _key(chunk[0], 0, b""), len(grams.at))]
            while True:
                for part, key, times in (*found, *phrases(chunk, grams)):
                    own = tally.setdefault(part, {})
                    own[key] = own.get(key, 0) + times
                found = []
                if grams.level == longest:
                    break
                if grams.level == 2:
                    followed = np.zeros(len(grams.pieces) + 1, bool)
                    followed[grams.at[known.value.has(grams.hashes)]] = True
                grams.longer(followed[grams.at] & followed[grams.at + grams.level - 1]
                             if followed is not None else None)
            if sum(map(len, tally.values())) > PHRASES:
                yield rows(tally)
                tally = {}
        yield rows(tally)
    return run


def _frequent(least: int):
    """(lang, words, phrase, f) of phrases counted ``least`` times in all, and of
    none, from rows sorted by partition."""
    def done(found: dict[bytes, int]) -> pa.RecordBatch:
        rows = [(*_of_key(k), f) for k, f in found.items()]
        rows = [r for r in rows if r[1] == 0 or r[3] >= least]
        columns = [*zip(*rows)] or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (
                pa.string(), pa.int32(), pa.binary(), pa.int64()))],
            ["lang", "words", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, found = None, {}
        for batch in batches:
            for number, keys, counts in zip(batch.column(0).to_pylist(), batch.column(1),
                                            batch.column(2)):
                if number != part:
                    yield done(found)
                    part, found = number, {}
                for key, count in zip(keys.as_py(), counts.as_py()):
                    found[key] = found.get(key, 0) + count
        yield done(found)
    return run


def phrase_counts(docs: DataFrame, scratch: Scratch, settings: Settings = Settings(),
                  lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, words, phrase, f) of all phrases of 1 to ``longest`` words with at
    least ``least`` occurrences, and for each lang one row of 0 words and the
    phrase "" whose f counts all its words. Staged in ``scratch``.

    Three passes read the texts. The first summarises words and pairs of words,
    the second longer grams all of whose pairs survived, by hash partition: a
    task counts its own grams, and what it counted is merged into the summary
    of each partition. The third counts the survivors exactly, as text, and
    adds up by the same partitions; what is no survivor but passes the broadcast
    filter is counted too, and left out by its exact count.
    """
    spark = docs.sparkSession
    least = max(1, settings.least)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        raw(text_col).alias("text")).where("length(text) > 0")
    # words and pairs are fewer than bytes, so this many counters are more than
    # mass / least; partitions are powers of two
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shift = max(0, (size // least // settings.counters).bit_length())
    capacity = size // least // (1 << shift) + 1

    def survivors(levels: range, known, label: str) -> DataFrame:
        summed = texts.mapInArrow(_summaries(levels, known, shift), _SUMMARY)
        return scratch.stage(
            summed.repartition("part").sortWithinPartitions("part").mapInArrow(
                _merged(capacity, least), "part int, size long, grams binary"), label)

    found = [survivors(range(1, min(2, settings.longest) + 1), None, "survivors-2")]
    if settings.longest > 2:
        pairs = spark.sparkContext.broadcast(
            _filter(found, 1 << shift, settings.filter_bytes))
        found.append(survivors(range(3, settings.longest + 1), pairs, "survivors"))
    known = spark.sparkContext.broadcast(_filter(found, 1 << shift, settings.filter_bytes))
    counted = texts.mapInArrow(_counted(known, settings.longest),
                               "part int, keys array<binary>, counts array<long>")
    exact = (counted.repartition("part").sortWithinPartitions("part")
             .mapInArrow(_frequent(least), "lang string, words int, phrase binary, f long")
             .withColumn("phrase", F.col("phrase").cast("string")))
    exact = scratch.stage(exact, "counts")
    scratch.release("survivors-2", "survivors")
    return exact


def score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 * a * n / (left * right)), exact for counts of 16 digits."""
    a, n, left, right = (f"CAST(`{c}` AS DECIMAL(16,0))" for c in (a, n, left, right))
    return F.expr(f"(CAST(1000 AS DECIMAL(4,0)) * {a} * {n}) div ({left} * {right})")


def _slice(start, length) -> Column:
    return F.array_join(F.slice("_words", start, length), " ")


def collocations(docs: DataFrame, settings: Settings = Settings(), lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases.

    Words are lower-cased (A-Z) runs of anything but blanks and tabs, phrases
    lie within pieces that ``. , ; : ! ?`` and line ends part. Candidates are
    phrases of 2 to ``longest`` words with a >= ``least`` occurrences. Cut in
    two, a phrase scores floor(1000 * a * n / (l * r)), where l and r count its
    parts and n all words of the language; its lowest-scoring cut counts, the
    first of several. Candidates lying in a longer one, dropped or not, with
    ``covered`` percent of their occurrences or more are dropped.

    NULL texts are empty, a NULL language is "und"; repeated rows count as
    often as they come; tables without candidates give no rows. Further columns
    are ignored, whatever their names. Ties are ranked by a, then by phrase.
    """
    with Scratch(docs.sparkSession) as scratch:
        counts = phrase_counts(docs, scratch, settings, lang_col, text_col)
        key = F.concat_ws("\0", "lang", "phrase")
        known = scratch.stage(counts.where("words > 0").select(
            key.alias("key"), "f"), "known")
        candidates = (counts.where("words > 1")
                      .select("lang", "phrase", "words", F.col("f").alias("a"),
                              F.split("phrase", " ").alias("_words")))
        cuts = scratch.stage(
            candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .select("lang", "phrase", "a", "k",
                    F.concat_ws("\0", "lang", _slice(F.lit(1), F.col("k"))).alias("key"),
                    F.concat_ws("\0", "lang", _slice(F.col("k") + 1, F.col("words") - F.col("k")))
                    .alias("rest")), "cuts")
        halves = scratch.stage(
            spread_join(cuts, known.withColumnRenamed("f", "l"), "key")
            .drop("key").withColumnRenamed("rest", "key"), "halves")
        all_words = counts.where("words = 0").select("lang", F.col("f").alias("n"))
        size = all_words.agg(F.sum(F.octet_length("lang") + 16)).first()[0] or 0
        if size <= LANGUAGES:  # one row a language, and few have all phrases
            all_words = F.broadcast(all_words)
        scored = (spread_join(halves, known.withColumnRenamed("f", "r"), "key")
                  .join(all_words, "lang")
                  .withColumn("score", score("a", "n", "l", "r"))
                  .groupBy("lang", "phrase", "a", "n")
                  .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
        inner = (candidates.where("words > 2")
                 .withColumn("length", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
                 .withColumn("start", F.explode(F.sequence(
                     F.lit(1), F.col("words") - F.col("length") + 1)))
                 .groupBy("lang", _slice(F.col("start"), F.col("length")).alias("phrase"))
                 .agg(F.max("a").alias("longer")))
        left = (scored.join(inner, ["lang", "phrase"], "left")
                .where(~F.coalesce(100 * F.col("longer") >= settings.covered * F.col("a"),
                                   F.lit(False)))
                .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
        order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
        salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
        some = (left.withColumn("_salt", salt).withColumn("rank", F.row_number().over(
            Window.partitionBy("lang", "_salt").orderBy(*order)))
            .where(F.col("rank") <= settings.listed))
        best = (some.withColumn("rank", F.row_number().over(
            Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= settings.listed)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
        best = scratch.stage(best, "best")
        scratch.keep("best")
        return best
