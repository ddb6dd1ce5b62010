"""Benchmark passages in documents, found by one Aho-Corasick automaton."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import Scratch
from .common import free, raw

#: Bytes of benchmark text that one automaton is built from. A larger
#: benchmark is cut into blocks, each with an automaton and a scan of its own.
BLOCK_BYTES = 8_000_000

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Every byte as itself in lower case if a word may hold it, else as a blank.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256))
#: A word is spelt as three characters, of one alphabet for each place, so that
#: no node of the automaton has many children and every match starts at a word.
_LETTERS, _PLACES = 128, 3
_OTHER = "\x00" * _PLACES

SPANS = ("array<struct<start:int,end:int,first_word:int,last_word:int>>")
FOUND = f"n_words long, n_hit long, items array<string>, spans {SPANS}"


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text: ASCII letters, digits, and all else
    from U+0080 on."""
    return text.translate(_NORMAL).split()


class _Vocabulary(dict):
    """The spelling of each known word; all others are spelt the same."""

    def __missing__(self, word: bytes) -> str:
        return _OTHER


def _spelling(number: int) -> str:
    if number >= _LETTERS**_PLACES:
        raise ValueError("a block of the benchmark has too many different words")
    return "".join(chr(1 + place * _LETTERS + number // _LETTERS**place % _LETTERS)
                   for place in range(_PLACES))


@dataclass
class Matcher:
    """The windows of some items, over an alphabet of their words."""

    alphabet: _Vocabulary
    automaton: ahocorasick.Automaton | None
    known: re.Pattern  # runs of known words that are long enough for a window
    lengths: list[int]
    items: list[list[str]]

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int) -> Matcher:
        alphabet, windows = _Vocabulary(), {}
        for item_id, text in items:
            spelt = []
            for word in words_of(text):
                if word not in alphabet:
                    alphabet[word] = _spelling(len(alphabet))
                spelt.append(alphabet[word])
            for k in range(max(1, len(spelt) - window + 1) if spelt else 0):
                windows.setdefault("".join(spelt[k:k + window]), set()).add(item_id)
        automaton = ahocorasick.Automaton() if windows else None
        for number, line in enumerate(windows):
            automaton.add_word(line, number)
        if automaton is not None:
            automaton.make_automaton()
        lengths = [len(x) // _PLACES for x in windows]
        shortest = min(lengths, default=1) * _PLACES
        return cls(alphabet, automaton, re.compile(f"[^\\x00]{{{shortest},}}"),
                   lengths, [sorted(x) for x in windows.values()])

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged runs of hit words (first, end) and the items that occur."""
        runs: list[tuple[int, int]] = []
        found: set[int] = set()
        if self.automaton is None:
            return [], set()
        line = "".join(map(self.alphabet.__getitem__, words))
        for part in self.known.finditer(line):
            for last, number in self.automaton.iter(line, part.start(), part.end()):
                found.add(number)
                end = (last + 1) // _PLACES
                start = end - self.lengths[number]
                while runs and start <= runs[-1][1]:
                    before = runs.pop()
                    start, end = min(start, before[0]), max(end, before[1])
                runs.append((start, end))
        return runs, {i for n in found for i in self.items[n]}


_matchers: dict[str, Matcher] = {}


def _matcher(items: list[tuple[str, bytes]], window: int) -> Matcher:
    """Built once in each worker process; the last one is remembered."""
    key = sha256(repr((window, items)).encode()).hexdigest()
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher.of(items, window)
    return _matchers[key]


def _offsets(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points [start, end) in the original text of runs of words."""
    places = [m.span() for m in _WORD.finditer(text.lower())]
    ends, at, points = [], 0, 0
    for first, end in runs:
        pair = []
        for byte in (places[first][0], places[end - 1][1]):
            points += len(text[at:byte].decode("utf-8", "replace"))
            at = byte
            pair.append(points)
        ends.append((pair[0], pair[1]))
    return ends


def _merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _scans(items, window: int):
    """(text, runs and items so far) to the same with those of one block."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = _matcher(items.value, window)
        for texts, before in batches:
            rows = []
            for text, old in zip(texts, before.to_pylist()):
                text = text.as_py()
                words = words_of(text)
                runs, found = matcher.scan(words)
                if old and (old["items"] or old["spans"]):
                    runs = _merge(runs + [(s["first_word"], s["last_word"] + 1)
                                          for s in old["spans"]])
                    found |= set(old["items"])
                rows.append({
                    "n_words": len(words), "n_hit": sum(e - s for s, e in runs),
                    "items": sorted(found),
                    "spans": [
                        {"start": a, "end": b, "first_word": s, "last_word": e - 1}
                        for (s, e), (a, b) in zip(runs, _offsets(text, runs))
                    ] if runs else []})
            yield pa.array(rows, _FOUND_TYPE)
    return F.arrow_udf(run, FOUND)


_SPAN_TYPE = pa.struct([(x, pa.int32()) for x in
                        ("start", "end", "first_word", "last_word")])
_FOUND_TYPE = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                         ("items", pa.list_(pa.string())),
                         ("spans", pa.list_(_SPAN_TYPE))])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str,
            block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items with an id, as lists that hold about ``block_bytes`` each."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item"), raw(text_col).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for number in range(blocks):
        yield [(r[0], bytes(r[1]))
               for r in items.where(block == number).orderBy("item", "text").collect()]


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", result: str = "found",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct of what occurs of the benchmark in each text.

    ``n_words`` and ``n_hit`` count words, ``items`` are the sorted ids (as
    strings) of items of which a window occurs, ``spans`` the hit passages as
    code points and word numbers of the original text. A window is ``window``
    consecutive words of an item, or the whole of a shorter item.

    The text is scanned once by an automaton over word numbers, for each block
    of a benchmark that is larger than ``block_bytes``; each block is what the
    driver and a worker hold at a time. NULL and empty texts have no words;
    items without an id are left out; items that repeat count once; an empty
    benchmark hits nothing. A column named like ``result`` is replaced.
    """
    spark = docs.sparkSession
    empty = F.lit(None).cast(f"struct<{FOUND.replace(' long', ':long').replace('items ', 'items:').replace('spans ', 'spans:')}>")
    scanned = docs.withColumn(result, empty)
    for number, items in enumerate(_blocks(benchmark, item_col, item_text_col,
                                           block_bytes)):
        if number:
            scanned = Scratch(spark).stage(scanned, f"scanned-{number}")
        scan = _scans(spark.sparkContext.broadcast(items), window)
        scanned = scanned.withColumn(result, scan(raw(text_col), F.col(result)))
    return scanned


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  most_share: float = 0.0, **columns) -> DataFrame:
    """The rows of ``docs`` whose share of hit words is at most ``most_share``."""
    name = free(docs, "_found")
    found = find_passages(docs, benchmark, window, result=name, **columns)
    hit, words = F.col(f"{name}.n_hit"), F.col(f"{name}.n_words")
    return found.where(hit <= most_share * words).drop(name)
