"""Repeated lines, paragraphs and sentences, removed but for the first one."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import Scratch
from .common import BROADCAST_ROWS, free, raw, spread_join, with_small

#: What ends a unit. Sentences end a line's parts at . ! ? and a blank, so a
#: passage pasted into a longer line is found as well.
UNITS = {
    "line": re.compile(rb"[^\r\n]+"),
    "paragraph": re.compile(rb"(?:[^\n]|\n(?![ \t\r]*\n))+"),
    "sentence": re.compile(rb"[^\r\n.!?]+(?:[.!?]+(?![\s\"')\]])[^\r\n.!?]+)*[.!?]*[\"')\]]*"),
}
#: A longer unit is cut before words whose checksum this many divides, so that
#: a passage without marks, pasted into other words, has pieces of its own.
LONG_UNIT, ANCHOR = 40, 12
_WORD = re.compile(rb"[^\t-\r ]+")
#: Blank lines part paragraphs.
_PARAGRAPHS = re.compile(rb"\n(?:[ \t\r]*\n)+")
#: Sentences and pieces of fewer words are no units of their own beside lines.
LEAST_SENTENCE = 6
_PIECE = "id long, unit int, start int, end int, words int, digest binary"
_UNIT = "id long, unit int, start int, end int, words int, kind int, digest binary"
#: A kind is the first of these that has the unit's extent.
KINDS = ("line", "paragraph", "sentence", "passage")
#: A run of so many words that occurred before is a passage, wherever it lies.
PASSAGE = 50
#: Words of a fingerprint. The least hash among those in each window of PASSAGE
#: words is taken, so two texts that share a window share its fingerprint.
PRINT = 16
#: In scripts without blanks each character stands for a word of a passage.
_NO_BLANKS = rb"[\xe3-\xe9][\x80-\xbf]{2}|\xe0[\xb8-\xbb][\x80-\xbf]"
_DENSE = re.compile(_NO_BLANKS)
_TOKEN = re.compile(_NO_BLANKS + rb"|(?:(?![\xe3-\xe9]|\xe0[\xb8-\xbb])[^\t-\r ])+")
_BASES = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4D
#: Bytes of a text whose words are hashed at once, and of texts cut up together.
CODED, GROUP = 1 << 20, 1 << 18
#: A digest with more than this share of all units gets its rows salted.
_HOT_SHARE, _SALTS = 1 / 2000, 64


def normal_words(unit: bytes) -> list[bytes]:
    """Lower-cased words; blanks and line ends only part them."""
    return unit.lower().split()


def _pieces(text: bytes, start: int, end: int, least_words: int):
    """(start, end, words) of a unit, or of the pieces of a long one.

    Cuts depend on the words around them alone: one is made before an anchor
    word that has at least ``least_words`` words of its piece before it and
    as many of the unit after it.
    """
    words = normal_words(text[start:end])
    if len(words) <= LONG_UNIT:
        if words:
            yield (start + len(text[start:end]) - len(text[start:end].lstrip()),
                   start + len(text[start:end].rstrip()), words)
        return
    spans = [m.span() for m in _WORD.finditer(text, start, end)]
    first = 0
    for k, word in enumerate(words):
        if (k - first >= least_words and len(words) - k >= least_words
                and crc32(word) % ANCHOR == 0):
            yield spans[first][0], spans[k - 1][1], words[first:k]
            first = k
    yield spans[first][0], spans[-1][1], words[first:]


def _units(unit: str, least_words: int):
    pattern = UNITS[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                plain = text.isascii()
                at = points = 0
                found = (piece for m in pattern.finditer(text)
                         for piece in _pieces(text, *m.span(), least_words))
                for number, (start, end, words) in enumerate(found):
                    if len(words) < least_words:
                        continue
                    if plain:
                        place = start, end
                    else:
                        points += len(text[at:start].decode("utf-8", "replace"))
                        first = points
                        points += len(text[start:end].decode("utf-8", "replace"))
                        place, at = (first, points), end
                    digest = blake2b(b" ".join(words), digest_size=16).digest()
                    rows.append((key, number, *place, len(words), digest))
                if len(rows) > 20_000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)
    return run


def _places(text: bytes):
    """Byte offsets of ``text`` to code points."""
    if text.isascii():
        return lambda at: at
    points = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return lambda at: int(points[at - 1]) if at else 0


_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[*b"\t\n\v\f\r "]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers, from 0 on, of an odd base and of its inverse, modulo 2 to the 64th."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < count:
        known = []
        for b in (base, pow(base, -1, 2**64)):
            power = np.full(max(count, 1 << 16), b, np.uint64)
            power[0] = 1
            known.append(np.cumprod(power))
        _POWERS[base] = known = tuple(known)
    return known


def _word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end, in bytes."""
    inside = np.zeros(len(text) + 2, bool)
    np.logical_not(_IS_BLANK[np.frombuffer(text, np.uint8)], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _word_codes(low: bytes, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """64-bit hashes of the words of a lower-cased text: of their bytes as a
    polynomial, and their lengths. Long texts are worked through in parts."""
    codes = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + CODED, "right")))
        first = int(start[at])
        octets = np.frombuffer(low, np.uint8, int(end[to - 1]) - first, first)
        power, back = _powers(base, len(octets) + 1)
        sums = np.zeros(len(octets) + 1, np.uint64)
        np.cumsum(octets * power[:len(octets)], out=sums[1:])
        s, e = start[at:to] - first, end[at:to] - first
        codes[at:to] = _mixed((sums[e] - sums[s]) * back[s] + e.astype(np.uint64)
                              - s.astype(np.uint64))
        at = to
    return codes


class _Anchors(dict):
    """Whether a word of a long unit may begin a piece."""

    def __missing__(self, word: bytes) -> bool:
        if len(self) > 200_000:
            self.clear()
        self[word] = marked = crc32(word) % ANCHOR == 0
        return marked


class _Text:
    """A text's words, and its lines, paragraphs, sentences and pieces by them.

    All lines and paragraphs with a word are units, however short or long, and
    as they are; sentences, and the pieces of long ones, from
    ``LEAST_SENTENCE`` words. Units of one extent are one, of the first kind.
    """

    def __init__(self, text: bytes):
        self.text, self.low = text, text.lower()
        self.starts, self.ends = _word_places(text)

    def _inside(self, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first word in each span, and the first one beyond."""
        return (np.searchsorted(self.starts, spans[:, 0]),
                np.searchsorted(self.ends, spans[:, 1], "right"))

    def units(self, anchors: _Anchors) -> tuple[np.ndarray, ...]:
        """(start, end, words, digest, kind) in order of start and end, in bytes."""
        text = self.text
        octets = np.frombuffer(text, np.uint8)
        breaks = np.flatnonzero((octets == 10) | (octets == 13))
        lines = np.stack([np.concatenate([[0], breaks + 1]),
                          np.concatenate([breaks, [len(text)]])], 1)
        ends = [0, *(x for m in _PARAGRAPHS.finditer(text) for x in m.span()), len(text)]
        paragraphs = np.array(ends).reshape(-1, 2)
        sentences = np.array([m.span() for m in UNITS["sentence"].finditer(text)],
                             np.int64).reshape(-1, 2)
        first, last, kind = [], [], []
        for number, spans in enumerate((lines, paragraphs)):
            f, e = self._inside(spans)
            first.append(f[f < e])
            last.append(e[f < e])
            kind.append(np.full(len(first[-1]), number))
        f, e = self._inside(sentences)
        # a sentence may end, or begin, within what blanks part
        count = len(self.starts)
        cut = np.zeros(len(f), bool)
        cut[f > 0] |= self.ends[f[f > 0] - 1] > sentences[f > 0, 0]
        cut[e < count] |= self.starts[e[e < count]] < sentences[e < count, 1]
        whole = ~cut & (e - f >= LEAST_SENTENCE)
        long = whole & (e - f > LONG_UNIT)
        first.append(f[whole & ~long])
        last.append(e[whole & ~long])
        kind.append(np.full(len(first[-1]), 2))
        for a, b in zip(f[long].tolist(), e[long].tolist()):
            cuts = self._cuts(a, b, anchors)
            cuts = np.array([(x, y) for x, y in zip(cuts, [*cuts[1:], b])
                             if y - x >= LEAST_SENTENCE])
            first.append(cuts[:, 0])
            last.append(cuts[:, 1])
            kind.append(np.full(len(cuts), 2))
        first, last, kind = map(np.concatenate, (first, last, kind))
        codes = [_word_codes(self.low, self.starts, self.ends, base) for base in _BASES]
        found = (self.starts[first], self.ends[last - 1], last - first,
                 _unit_digests(codes, first, last), kind)
        if cut.any():
            own = [self._alone(*span) for span in sentences[cut].tolist()]
            found = tuple(np.concatenate([x, *(o[k] for o in own)])
                          for k, x in enumerate(found))
        order = np.lexsort((found[4], found[1], found[0]))
        found = tuple(x[order] for x in found)
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(found[0]) != 0) | (np.diff(found[1]) != 0)
        return tuple(x[new] for x in found)

    def _cuts(self, first: int, last: int, anchors: _Anchors) -> list[int]:
        """The words at which the pieces of a long unit begin."""
        words = self.low[self.starts[first]:self.ends[last - 1]].split()
        cuts = [0]
        for k in np.flatnonzero(np.fromiter(map(anchors.__getitem__, words), bool,
                                            len(words))).tolist():
            if k - cuts[-1] >= LEAST_SENTENCE and len(words) - k >= LEAST_SENTENCE:
                cuts.append(k)
        return [first + k for k in cuts]

    def _alone(self, start: int, end: int) -> tuple[np.ndarray, ...]:
        """The units of a sentence that shares a word with its neighbour."""
        own = _Text(self.text[start:end])
        pieces = [(s - start, e - start) for s, e, words in
                  _pieces(self.text, start, end, LEAST_SENTENCE)
                  if len(words) >= LEAST_SENTENCE]
        first, last = own._inside(np.array(pieces, np.int64).reshape(-1, 2))
        codes = [_word_codes(own.low, own.starts, own.ends, base) for base in _BASES]
        return (own.starts[first] + start, own.ends[last - 1] + start, last - first,
                _unit_digests(codes, first, last), np.full(len(first), 2))


def _unit_digests(codes: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """128 bits of the words from ``first`` up to ``last``, of two hashes a word."""
    return np.stack([_hashes(own, base, first, last)
                     for own, base in zip(codes, _BASES)], 1)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[bytes]]]:
    """The keys and texts of a batch, as many at a time as ``GROUP`` bytes hold."""
    keys, texts, size = [], [], 0
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        keys.append(key)
        texts.append(text)
        size += len(text)
        if size > GROUP:
            yield keys, texts
            keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _all_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The units of texts that are worked through together, as one text of which
    blank lines part them: no unit goes beyond those."""
    anchors, names = _Anchors(), ["id", "unit", "start", "end", "words", "kind", "digest"]
    for batch in batches:
        for keys, texts in _groups(batch):
            whole = b"\n\n".join(texts)
            start, end, words, digest, kind = _Text(whole).units(anchors)
            if not len(start):
                continue
            begins = np.cumsum([0, *(len(t) + 2 for t in texts[:-1])])
            owner = np.searchsorted(begins, start, "right") - 1
            number = np.arange(len(start)) - np.searchsorted(owner, owner)
            begin = begins[owner]
            if not whole.isascii():
                points = np.zeros(len(whole) + 1, np.int64)
                np.cumsum((np.frombuffer(whole, np.uint8) & 0xC0) != 0x80, out=points[1:])
                start, end, begin = points[start], points[end], points[begin]
            yield from _table([(np.array(keys, np.int64)[owner], *(
                x.astype(np.int32) for x in (number, start - begin, end - begin, words, kind)),
                digest)], names)


class _Codes(dict):
    """Words to 64-bit hashes, of which those of dense scripts are remembered."""

    def of(self, text: bytes) -> np.ndarray:
        if not _DENSE.search(text):
            return _word_codes(text.lower(), *_word_places(text), _BASES[0])
        found = _TOKEN.findall(text.lower())
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = code = int(_word_codes(word, np.array([0]), np.array([len(word)]),
                                            _BASES[0])[0])
        return code


def _least_places(marks: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each ``width`` marks is, the first of equal ones.

    Marks keep 40 bits and carry their places in the other 24; windows are
    joined from two of half their width, again and again.
    """
    if len(marks) > 1 << 24:
        return (sliding_window_view(marks, width).argmin(axis=1)
                + np.arange(len(marks) - width + 1))
    low = np.uint64((1 << 24) - 1)
    least = (marks & ~low) | np.arange(len(marks), dtype=np.uint64)
    done = 1
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    return (least & low).astype(np.int64)


def _mixed(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ (codes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return codes ^ (codes >> np.uint64(29))


def _hashes(codes: np.ndarray, base: int, first: np.ndarray, last: np.ndarray,
            ) -> np.ndarray:
    """A polynomial, modulo 2 to the 64th, of codes ``first`` up to ``last``."""
    power, back = _powers(base, len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * power[:len(codes)], out=sums[1:])
    return (sums[last] - sums[first]) * back[first]


def _digests(codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return np.stack([_hashes(codes, _BASES[0], first, last),
                     _hashes(_mixed(codes), _BASES[1], first, last)], 1)


def _table(parts: list[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """One batch of the parts' columns, the last of which is 16 bytes a row."""
    if parts:
        *columns, digest = (np.concatenate(c) for c in zip(*parts))
        ends = np.arange(0, 16 * len(digest) + 1, 16, np.int32)
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, columns), pa.Array.from_buffers(
                pa.binary(), len(digest),
                [None, pa.py_buffer(ends), pa.py_buffer(digest)])], names)


_GROUP = "id long, twin long, unit int, count int, print long, digest binary"


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fingerprints of a text, each with the group of ``count`` windows, from
    word ``unit`` on, in which it is the least, and the digest of their words."""
    known = _Codes()
    for batch in batches:
        parts = []
        keys, twins = (batch.column(k).to_pylist() for k in (0, 1))
        for key, twin, text in zip(keys, twins, batch.column(2)):
            codes = known.of(text.as_py())
            if len(codes) < PASSAGE:
                continue
            start = np.arange(len(codes) - PRINT + 1)
            marks = _mixed(_hashes(codes, _BASES[0], start, start + PRINT))
            least = _least_places(marks, PASSAGE - PRINT + 1)
            # the least one's place never goes back
            first = np.flatnonzero(np.diff(least, prepend=-1))
            at, count = least[first], np.diff(first, append=len(least))
            parts.append((np.full(len(at), key), np.full(len(at), twin),
                          first.astype(np.int32), count.astype(np.int32),
                          marks[at].view(np.int64),
                          _digests(codes, first, first + count + PASSAGE - 1)))
        yield from _table(parts, ["id", "twin", "unit", "count", "print", "digest"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single windows of the groups in the last column."""
    known = _Codes()
    for batch in batches:
        parts = []
        keys, twins = (batch.column(k).to_pylist() for k in (0, 1))
        for key, twin, text, groups in zip(keys, twins, batch.column(2), batch.column(3)):
            first = np.concatenate([np.arange(g["unit"], g["unit"] + g["count"])
                                    for g in groups.as_py()])
            parts.append((np.full(len(first), key), np.full(len(first), twin),
                          first.astype(np.int32),
                          _digests(known.of(text.as_py()), first, first + PASSAGE)))
        yield from _table(parts, ["id", "twin", "unit", "digest"])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of words, in the last column, with their places and digests."""
    for batch in batches:
        rows: list[tuple] = []
        for key, text, runs in zip(batch.column(0).to_pylist(), batch.column(1),
                                   batch.column(2)):
            text = text.as_py()
            point = _places(text)
            word = _TOKEN if _DENSE.search(text) else _WORD
            spans = [m.span() for m in word.finditer(text)]
            low = text.lower()
            for run in runs.as_py():
                own = spans[run["unit"]:run["unit"] + run["words"]]
                digest = blake2b(b" ".join([low[a:b] for a, b in own]), digest_size=16)
                rows.append((key, run["unit"], point(own[0][0]), point(own[-1][1]),
                             len(own), digest.digest(), KINDS.index("passage"),
                             run["first_id"], run["first_unit"]))
        yield _batch(rows, first=True)


def _long_passages(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Runs of PASSAGE words and more that occurred before, to their true ends.

    Two texts that share a window of PASSAGE words share its fingerprint, so
    only groups of windows whose fingerprint repeats are compared, by 128 bits.
    A group that occurred before as a whole is such a run. Where a fingerprint
    has groups that differ, as at the ends of a passage, the first occurrence
    of each is compared window by window. Adjoining runs that one text had
    first are one passage, which so ends with the words that repeat.
    """
    texts = texts.select("id", F.xxhash64("text").alias("twin"), "text")
    groups = scratch.stage(texts.mapInArrow(_fingerprints, _GROUP), "groups")
    twice = scratch.stage(groups.groupBy("print").count().where("count > 1")
                          .select("print"), "twice")
    few = twice.count() <= BROADCAST_ROWS
    shared = scratch.stage(
        groups.join(F.broadcast(twice), "print") if few
        else spread_join(groups, twice, "print"), "shared").withColumn("start", F.lit(0))
    scratch.release("groups", "twice")
    varied = (shared.groupBy("print")
              .agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
              .where("low < high").select("print"))
    variants = scratch.stage(
        shared.groupBy("print", "digest")
        .agg(F.min(F.struct("id", "unit", "count", "twin")).alias("first"))
        .select("print", "first.*"), "variants")
    edges = scratch.stage(
        spread_join(variants, varied, "print").groupBy("id", "twin")
        .agg(F.collect_list(F.struct("unit", "count")).alias("groups")), "edges")
    scratch.release("variants")
    of_text = ["id", "twin"]
    windows = scratch.stage(
        texts.join(_listed(edges, "groups"), of_text)
        .select("id", "twin", "text", "groups")
        .mapInArrow(_windows, "id long, twin long, unit int, digest binary"), "windows")
    scratch.release("edges")
    single = windows.withColumns({"count": F.lit(1), "start": F.lit(0)})
    columns = ["id", "twin", "unit", "count", "first_id", "first_unit"]
    later = _later(shared, scratch, "group-digests").select(*columns).union(
        _later(single, scratch, "window-digests").select(*columns))
    by = Window.partitionBy(*of_text).orderBy("unit")
    before = F.lag(F.col("unit") + F.col("count")).over(by)
    opens = (before.isNull() | (F.col("unit") > before)
             | (F.lag("first_id").over(by) != F.col("first_id")))
    end = F.max(F.col("unit") + F.col("count"))
    runs = (later.distinct()  # texts that repeat with their id give equal rows
            .withColumn("_opens", opens.cast("int"))
            .withColumn("_run", F.sum("_opens").over(by)).groupBy(*of_text, "_run")
            .agg(F.min("unit").alias("unit"),
                 (end - F.min("unit") + PASSAGE - 1).alias("words"),
                 F.first("first_id").alias("first_id"),
                 F.min_by("first_unit", "unit").alias("first_unit"))
            .groupBy(*of_text).agg(F.sort_array(F.collect_list(F.struct(
                "unit", "words", "first_id", "first_unit"))).alias("runs")))
    runs = scratch.stage(runs, "runs")
    scratch.release("shared", "windows", "group-digests", "window-digests")
    return (texts.join(_listed(runs, "runs"), of_text).select("id", "text", "runs")
            .mapInArrow(_found, f"{_PIECE}, kind int, first_id long, first_unit int"))


def _listed(lists: DataFrame, column: str) -> DataFrame:
    """Lists a text, broadcast when all of them are short."""
    return with_small(lists, lists.agg(F.sum(F.size(column))).first()[0] or 0)


def _batch(rows: list[tuple], first: bool = False) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * (9 if first else 7)
    kinds = [pa.int64(), *[pa.int32()] * 4, pa.binary(), pa.int32(), pa.int64(),
             pa.int32()]
    names = ["id", "unit", "start", "end", "words", "digest", "kind", "first_id",
             "first_unit"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names[:len(columns)])


def units_of(docs: DataFrame, unit: str = "sentence", least_words: int = 6,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, unit, start, end, words, digest) of each unit of each text.

    ``start`` and ``end`` are code points of the original text without blanks
    around the unit; ``digest`` is of its lower-cased words. Units of more than
    ``LONG_UNIT`` words are cut into pieces at words that their checksum marks.
    Units of fewer than ``least_words`` words are left out: they repeat by
    chance.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    return (_texts(docs, id_col, text_col)
            .mapInArrow(_units(unit, least_words), _PIECE))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"),
                    raw(text_col).alias("text")))


def repeated_units(docs: DataFrame, unit: str = "sentence", least_words: int = 6,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The units that occurred before, with the place they first occurred.

    Columns: ``id_col``, unit, start, end, words, digest, first_id, first_unit.
    Occurrences rank by id and then by place; the earliest stays and is not
    listed, all others are. Repeats within one text count. Texts are read
    twice, so that no table of all units is written: digests are counted
    first, each in its task and then globally; then units are matched with
    those digests that repeat. A digest with over 1/2000 of all units, of which
    there are fewer than 2000, is matched in 64 salted parts.

    NULL and empty texts have no units; rows without an id are not compared;
    rows that repeat an id are further occurrences in the order of their
    places, those of one place in no order but counted once as the first.
    """
    found = _later(units_of(docs, unit, least_words, id_col, text_col),
                   Scratch(docs.sparkSession), "digests")
    return found.select(F.col("id").alias(id_col), "unit", "start", "end", "words",
                        "digest", "first_id", "first_unit")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """All that occurred before: lines, paragraphs, sentences, and long passages.

    Columns as of ``repeated_units``, and ``kind``. Every line and paragraph
    that holds a word is compared, of whatever length and whether or not it
    has blanks; sentences of 6 words and more, and the pieces of long ones,
    beside them. Kinds share their digests, so a sentence that was a line
    before is listed; parts of one extent are one unit, of the first kind in
    ``KINDS``. Occurrences rank as in ``repeated_units``.

    Runs of 50 words and more that occurred before are listed as well, from
    the first to the last word that repeats, wherever they lie in a text and
    across its lines. Their ``unit`` and ``first_unit`` are the numbers of
    their first words, and in scripts without blanks each character is a word
    of them. Each 50 words of a passage occurred before in ``first_id``; where
    that changes, the next passage begins. One is listed beside its units.
    """
    scratch = Scratch(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    units = texts.mapInArrow(_all_units, _UNIT)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    found = _later(units, scratch, "digests").unionByName(_long_passages(texts, scratch))
    return found.select(
        F.col("id").alias(id_col), "unit", "start", "end", "words", "digest",
        "first_id", "first_unit", kind.alias("kind"))


def _later(units: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Those of ``units`` whose digest another one by (id, unit, start) had first.

    ``first_id`` and ``first_unit`` are added. ``units`` is read twice.
    """
    counted = (units.groupBy("digest")
               .agg(F.min(F.struct("id", "unit", "start")).alias("first"),
                    F.count("*").alias("times"))
               .select("digest", "times", F.col("first.id").alias("first_id"),
                       F.col("first.unit").alias("first_unit"),
                       F.col("first.start").alias("first_start"))
               .where("times > 1"))
    counted = scratch.stage(counted, label)
    total = counted.agg(F.sum("times")).first()[0] or 0
    # at most 1 / _HOT_SHARE digests can pass, which bounds the broadcast
    often = (counted.where(F.col("times") > max(20_000, total * _HOT_SHARE))
             .select("digest", F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("id", "unit"), F.lit(_SALTS))
                  ).otherwise(0).cast("int")
    dealt = units.join(F.broadcast(often), "digest", "left").withColumn(
        "_salt", salt).drop("_hot")
    known = (counted.join(F.broadcast(often), "digest", "left")
             .withColumn("_salt", F.explode(F.when(
                 F.col("_hot"), F.sequence(F.lit(0), F.lit(_SALTS - 1)))
                 .otherwise(F.array(F.lit(0)))))
             .drop("_hot", "times"))
    here: Column = F.struct("id", "unit", "start")
    first: Column = F.struct("first_id", "first_unit", "first_start")
    return (dealt.join(known, ["digest", "_salt"]).where(here > first)
            .drop("_salt", "first_start"))


def without_repeats(docs: DataFrame, unit: str = "all", least_words: int = 6,
                    id_col: str = "doc_id", text_col: str = "text",
                    result: str = "removed") -> DataFrame:
    """``docs`` with repeated units cut out of the texts.

    ``unit`` is one of ``UNITS``, or "all" for what ``repeated_passages`` lists.
    ``result`` lists what was cut as (start, end) in the original text, by
    start. Texts without repeats, and NULL, stay as they are with an empty
    list. Of rows that share an id, each is cut at the same places, so ids
    should be unique. A column named like ``result`` is replaced.
    """
    docs = docs.drop(result)
    key, places = free(docs, "_key"), free(docs, "_places")
    found = (repeated_passages(docs, id_col, text_col) if unit == "all" else
             repeated_units(docs, unit, least_words, id_col, text_col))
    cuts = (found.groupBy(F.col(id_col).alias(key))
            .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(places)))

    def run(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        kept = []
        for text, places in zip(texts.to_pylist(), cuts.to_pylist()):
            if text is not None and places:
                parts, at = [], 0
                for place in places:
                    parts.append(text[at:place["start"]])
                    at = max(at, place["end"])
                text = "".join([*parts, text[at:]])
            kept.append(text)
        return pa.array(kept, pa.string())

    none = F.array().cast("array<struct<start:int,end:int>>")
    return (docs.join(cuts, F.col(id_col) == F.col(key), "left")
            .withColumn(text_col, F.arrow_udf(run, "string")(
                F.col(text_col), F.col(places)))
            .withColumn(result, F.coalesce(places, none)).drop(key, places))
