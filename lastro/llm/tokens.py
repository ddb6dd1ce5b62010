"""Exact token counts of every prefix of a text, by prefix dynamic programming."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How byte-level vocabularies split a text before merging.
_QUOTED = r"'s|'t|'re|'ve|'m|'ll|'d"
_BLANK = r"[\p{White_Space}]"
PIECES = (rf"{_QUOTED}| ?\p{{L}}+| ?\p{{N}}+| ?[^\p{{White_Space}}\p{{L}}\p{{N}}]+"
          rf"|{_BLANK}+(?!\P{{White_Space}})|{_BLANK}+")
#: The same for texts of ASCII characters.
ASCII_PIECES = (rf"{_QUOTED}| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+"
                r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
BLANKS = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
          "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
#: Pieces whose counts a worker remembers, and pairs of tokens it has judged.
PIECES_KEPT, PAIRS_KEPT = 400_000, 300_000
#: Longer pieces are counted but not remembered.
LONG_PIECE = 64


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return ({chr(b): b for b in plain}
            | {chr(256 + k): b for k, b in enumerate(other)})


class PrefixCounter:
    """Token counts of a byte-level BPE vocabulary.

    For each prefix of a piece the last token of its encoding is stored. It is
    the one token that ends there and that the merges would keep beside the
    last token of the prefix before it; the count is that of the preceding prefix
    and one. So each prefix costs a few look-ups, and nothing is encoded again.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or spec["normalizer"]
                or before["type"] != "ByteLevel" or before["add_prefix_space"]
                or not before.get("use_regex", True)):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        letters = _byte_letters()
        latin = lambda s: "".join(chr(letters[c]) for c in s)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(latin(a), latin(b)): k for k, (a, b) in enumerate(merges)}
        self.special = sorted((t["content"] for t in spec["added_tokens"]
                               if t["special"]), key=len, reverse=True)
        self.made = {a + b: (k, a, b) for (a, b), k in self.rank.items()}
        if len(self.made) != len(self.rank):
            raise ValueError(f"{path} makes a token in more than one way")
        special = set(self.special)
        self.tokens = ahocorasick.Automaton()
        for token in model["vocab"]:
            if token not in special:
                self.tokens.add_word(latin(token), latin(token))
        self.tokens.make_automaton()
        self.split, self.split_ascii = regex.compile(PIECES), re.compile(ASCII_PIECES)
        self.cut = (regex.compile("|".join(map(regex.escape, self.special)))
                    if self.special else None)
        self.kept: dict[str, int] = {}
        self.beside: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}

    def _whole(self, token: str) -> bool:
        """Whether a token, encoded by itself, is that one token."""
        parts, worst = list(token), len(self.rank)
        while len(parts) > 1:
            ranks = [self.rank.get(pair, worst) for pair in zip(parts, parts[1:])]
            least = min(ranks)
            if least == worst:
                return False
            merged, k = [], 0
            while k < len(parts):
                step = 2 if k < len(ranks) and ranks[k] == least else 1
                merged.append("".join(parts[k:k + step]))
                k += step
            parts = merged
        return True

    def _fit(self, a: str, b: str) -> bool:
        """Whether two tokens stay two when their bytes are encoded together.

        At each moment of the merging, one part that ends ``a`` touches one
        that begins ``b``. Going back in time from the finished tokens, the
        part made last is undone; if ever the touching parts have a merge that
        comes before those that would take them elsewhere, it would have
        crossed. Equal merges happen from left to right.
        """
        x, y, made = a, b, self.made
        x_taken = y_taken = len(self.rank)
        while True:
            crossing = self.rank.get((x, y))
            if crossing is not None and crossing < x_taken and crossing <= y_taken:
                return False
            of_x, of_y = made.get(x), made.get(y)
            if of_x is None and of_y is None:
                return True
            if of_y is None or (of_x is not None and of_x[0] > of_y[0]):
                x_taken, x = of_x[0], of_x[2]
            else:
                y_taken, y = of_y[0], of_y[1]

    def prefix_counts(self, piece: str) -> list[int]:
        """Tokens of the first 0, 1, 2 ... bytes of a piece, given as latin-1."""
        last, counts = [""] * (len(piece) + 1), [0] * (len(piece) + 1)
        beside, whole, settled = self.beside, self.whole, 0
        for at, token in self.tokens.iter(piece):  # of one end, longest first
            end = at + 1
            if end == settled:
                continue
            start = end - len(token)
            if start:
                pair = (last[start], token)
                fits = beside.get(pair)
                if fits is None:
                    fits = self._fit(*pair)
                    if len(beside) < PAIRS_KEPT:
                        beside[pair] = fits
            else:
                fits = whole.get(token)
                if fits is None:
                    fits = whole[token] = self._whole(token)
            if fits:
                last[end], counts[end], settled = token, counts[start] + 1, end
        return counts

    def count_piece(self, piece: str) -> int:
        known = self.kept.get(piece)
        if known is None:
            known = self.prefix_counts(piece.encode().decode("latin-1"))[-1]
            if len(self.kept) < PIECES_KEPT and len(piece) <= LONG_PIECE:
                self.kept[piece] = known
        return known

    def count(self, text: str) -> int:
        """Tokens of a text; special strings count as one."""
        if self.cut and any(s in text for s in self.special):
            parts = self.cut.split(text)
            return len(parts) - 1 + sum(map(self.count_ordinary, parts))
        return self.count_ordinary(text)

    def count_ordinary(self, text: str) -> int:
        split = self.split_ascii if text.isascii() else self.split
        pieces = split.findall(text)
        get, slow = self.kept.get, self.count_piece
        counts = list(map(get, pieces))
        total = 0
        for k, c in enumerate(counts):
            total += c if c is not None else slow(pieces[k])
        return total

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of each prefix of a text: ``[k]`` is the count of its first k
        characters, encoded by themselves."""
        counts = np.zeros(len(text) + 1, np.int32)
        start, before = 0, 0
        cuts = list(self.cut.finditer(text)) if self.cut else []
        for m in [*cuts, None]:
            end = m.end() if m else len(text)
            part = self._ordinary_prefixes(text[start:end])
            counts[start:end + 1] = before + part
            if m:
                before += int(part[m.start() - start]) + 1
                counts[end] = before
                start = end
        return counts

    def _ordinary_prefixes(self, text: str) -> np.ndarray:
        counts = np.zeros(len(text) + 1, np.int32)
        before, blank = 0, None  # tokens before this piece; where blanks began
        for m in self.split.finditer(text):
            piece, at = m[0], m.start()
            lead = len(piece) - len(piece.lstrip(BLANKS))
            of = self._by_character(piece)
            total = before + int(of[-1])
            if lead:
                # a prefix that ends in blanks takes all of them as one piece
                if blank is None:
                    blank = (at, before)
                run = self._by_character(text[blank[0]:at + lead])
                counts[at + 1:at + lead + 1] = blank[1] + run[at + 1 - blank[0]:]
            if lead < len(piece):
                blank = None
                counts[at + lead + 1:m.end() + 1] = before + of[lead + 1:]
                if piece in ("'re", "'ve", "'ll"):
                    # one letter short, the quote and the letter are two pieces
                    counts[at + 2] = (before + self.count_piece("'")
                                      + self.count_piece(piece[1]))
            before = total
        return counts

    def _by_character(self, piece: str) -> np.ndarray:
        data = piece.encode()
        counts = np.array(self.prefix_counts(data.decode("latin-1")), np.int32)
        if len(data) == len(piece):
            return counts
        octets = np.frombuffer(data, np.uint8)
        starts = np.flatnonzero((octets & 0xC0) != 0x80)
        return counts[np.append(starts, len(data))]


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """The vocabulary at ``path``, read once in each process."""
    return PrefixCounter(path)


def n_tokens(text: Column, path: str) -> Column:
    """Tokens of a text, NULL as empty. ``path`` exists on every machine."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(path)
        for texts in batches:
            yield pa.array([own.count(t.as_py()) for t in texts], pa.int64())
    return F.arrow_udf(run, "long")(F.coalesce(text, F.lit("")))


def prefix_tokens(text: Column, path: str) -> Column:
    """Array of the counts of all prefixes: element k, from 0, is the token
    count of the first k characters. NULL and empty texts give [0]."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(path)
        for texts in batches:
            yield pa.array([own.prefixes(t.as_py()) for t in texts],
                           pa.list_(pa.int32()))
    return F.arrow_udf(run, "array<int>")(F.coalesce(text, F.lit("")))


def tokens_before(prefixes: Column, characters: Column) -> Column:
    """Tokens of the first ``characters`` characters, from the stored counts."""
    last = F.size(prefixes) - 1
    return F.get(prefixes, F.least(F.greatest(characters, F.lit(0)), last))


def longest_within(prefixes: Column, budget: Column | int) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens.

    Counts of prefixes may fall by one where a character completes a token, so
    the last fitting prefix is looked for from the end.
    """
    budget = budget if isinstance(budget, Column) else F.lit(budget)
    fits = F.transform(prefixes, lambda n, k: F.when(n <= budget, k))
    return F.coalesce(F.array_max(fits), F.lit(0))


def truncate(docs: DataFrame, path: str, budget: int, text_col: str = "text",
             ) -> DataFrame:
    """``docs`` with each text cut to its longest prefix within ``budget``
    tokens. NULL stays NULL; a budget of 0 leaves the empty text."""
    cut = F.substring(F.col(text_col), F.lit(1),
                      longest_within(prefix_tokens(F.col(text_col), path), budget))
    return docs.withColumn(text_col, F.when(F.col(text_col).isNotNull(), cut))


def count_tokens(docs: DataFrame, path: str, limit: int = 1024,
                 text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit of each text.

    NULL counts as empty. Input columns of these names are replaced.
    """
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")
    return (docs.withColumn("n_bytes", size)
            .withColumn("n_tokens", n_tokens(F.col(text_col), path))
            .withColumn("over_limit", F.col("n_tokens") > limit))
