"""Secrets in texts: fixed patterns, and strings that look random."""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample

# The patterns of the base kinds and the least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "random")

#: A word with one of these may be assigned a secret.
_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: What is judged by the character models: longer runs of key characters.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")

#: Rows that the models are fitted on: documents of the bounded sample, and
#: strings taken from them for either model.
SAMPLE_DOCUMENTS = 4000
SAMPLE_STRINGS = 20_000

_ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-"
_CODE = {c: k for k, c in enumerate(_ALPHABET)}
_N = len(_ALPHABET)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the fixed patterns, by start, then by kind."""
    spans: list[Span] = []
    lower = text.lower()
    if any(key in lower for key in _KEYS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)
                  if len(m[0]) >= LEAST_ACCESS]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=_place)


def _place(span: Span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


@dataclass(frozen=True)
class MarkovPair:
    """Log-likelihood ratios of one character after another.

    ``ratio[a, b]`` is log P(b | a) among random strings less that among
    ordinary ones; row ``_N`` starts a string. ``threshold`` is the least mean
    ratio a character of a string taken for random.
    """

    ratio: np.ndarray
    threshold: float

    @classmethod
    def fit(cls, random: Iterable[str], ordinary: Iterable[str],
            weight: float = 0.5) -> MarkovPair:
        """First-order models of two labelled samples, smoothed by ``weight``.

        The threshold is the ratio at which the share of random strings below
        equals the share of ordinary ones above, at least 0.5.
        """
        random, ordinary = list(random), list(ordinary)

        def logs(strings: list[str]) -> np.ndarray:
            counts = np.full((_N + 1, _N), weight)
            for s in strings:
                codes = [_CODE[c] for c in s]
                np.add.at(counts, ([_N, *codes[:-1]], codes), 1)
            return np.log(counts / counts.sum(axis=1, keepdims=True))
        ratio = logs(random) - logs(ordinary)
        fitted = cls(ratio, 0.0)
        high = np.sort([fitted.score(s) for s in random] or [math.inf])
        low = np.sort([fitted.score(s) for s in ordinary] or [-math.inf])
        cuts = np.linspace(0.5, 4, 141)
        missed = np.searchsorted(high, cuts) / len(high)
        wrong = 1 - np.searchsorted(low, cuts) / len(low)
        # of equal cuts the one in the middle of the gap
        cost = missed + 10 * wrong
        best = cuts[np.isclose(cost, cost.min())]
        return cls(ratio, float(best[len(best) // 2]))

    def score(self, s: str) -> float:
        codes = [_CODE[c] for c in s]
        return float(self.ratio[[_N, *codes[:-1]], codes].mean()) if codes else -math.inf


def candidates(text: str) -> Iterator[re.Match]:
    """Runs of 16 and more key characters, of whatever kinds."""
    yield from CANDIDATE.finditer(text)


def labelled_strings(text: str) -> tuple[list[str], list[str]]:
    """(random, ordinary) strings of a text, labelled by the fixed patterns.

    Values that a pattern finds are random; runs of 8 and more key characters
    elsewhere are ordinary.
    """
    spans = base_spans(text)
    random = []
    for kind, start, end in spans:
        found = text[start:end]
        random.append(ASSIGN.match(found)[2] if kind == "assign" else found)
    random = [r for s in random for r in re.findall(r"[A-Za-z0-9+/_=-]{12,}", s)]
    ordinary = [m[0] for m in re.finditer(r"[A-Za-z0-9+/_=-]{8,}", text)
                if not any(s < m.end() and m.start() < e for _, s, e in spans)]
    return random, ordinary


def fit_models(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               documents: int = SAMPLE_DOCUMENTS, strings: int = SAMPLE_STRINGS,
               seed: int = 7) -> MarkovPair:
    """Models from strings of a bounded sample, labelled by the fixed patterns.

    ``documents`` with the smallest key hashes are read for ordinary strings,
    and as many that hold a fixed pattern for random ones; at most ``strings``
    of each come to the driver. Generated hexadecimal, base 64 and upper-case
    keys join the random ones, so that each alphabet is known even where the
    corpus has few.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, str]] = []
            for text in batch.column(0):
                random, ordinary = labelled_strings(text.as_py())
                found += [(1, s) for s in random] + [(0, s) for s in ordinary]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int32()),
                 pa.array([s for _, s in found], pa.string())], ["label", "string"])

    spark = docs.sparkSession
    some = docs.select(id_col, text_col).where(F.col(text_col).isNotNull())
    likely = some.where(F.col(text_col).rlike(
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA|[0-9a-f]{24}"))
    rows: list[tuple[int, str]] = []
    for label, source in ((0, some), (1, likely)):
        # ids are chosen without their texts, which stay where they are read
        ids = bounded_sample(source.select(id_col), id_col, documents, seed)
        ids = spark.createDataFrame(ids.distinct().collect(), ids.schema)
        sample = (some.join(F.broadcast(ids), id_col, "left_semi")
                  .select(text_col).mapInArrow(run, "label int, string string")
                  .where(F.col("label") == label).distinct()
                  .orderBy(F.xxhash64("string"), "string").limit(strings))
        rows += [(r[0], r[1]) for r in sample.collect()]
    return MarkovPair.fit(
        [s for x, s in rows if x == 1] + generated_keys(2000, seed),
        [s for x, s in rows if x == 0] + ordinary_identifiers())


def generated_keys(count: int, seed: int) -> list[str]:
    random = np.random.default_rng(seed)
    alphabets = (string.hexdigits[:16], string.ascii_letters + string.digits,
                 string.ascii_uppercase + string.digits,
                 string.ascii_letters + string.digits + "+/")
    return ["".join(random.choice(list(alphabets[k % 4]), 16 + k % 25))
            for k in range(count)]


def ordinary_identifiers() -> list[str]:
    """Names and ruled lines as programs and pages hold them: no secrets."""
    parts = ("get user name set value index page file path item count date version "
             "config default handler request response manager service test table "
             "column update create delete session account message content").split()
    names = []
    for k, a in enumerate(parts):
        for b in parts:
            c = parts[(k * 7 + 3) % len(parts)]
            names += [f"{a}_{b}_{c}", f"{a}{b.title()}{c.title()}", f"{a}-{b}-{k % 10}",
                      f"{a.upper()}_{b.upper()}_{k}", f"20{10 + k}-0{1 + k % 9}-{b}"]
    digits = ["".join(str((k * j * 7 + j * j) % 10) for j in range(1, 17 + k % 4))
              for k in range(300)]
    rules = [c * k for c in _ALPHABET for k in (16, 24, 40)]
    return names + digits + rules


def spans_of(text: str, models: MarkovPair) -> list[Span]:
    """The base spans, and the strings outside them that look random."""
    spans = base_spans(text)
    found = list(spans)
    for m in candidates(text):
        if (not any(s < m.end() and m.start() < e for _, s, e in spans)
                and models.score(m[0]) >= models.threshold):
            found.append(("random", *m.span()))
    return sorted(found, key=_place)


SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                 ("end", pa.int32())]))


def scan(docs: DataFrame, models: MarkovPair, text_col: str = "text",
         result: str = "secrets") -> DataFrame:
    """``docs`` with the spans of secrets in each text, as code points.

    NULL and empty texts have none. The sorted array holds the base kinds and
    ``random`` ones; these never overlap a base span. A column named like
    ``result`` is replaced.
    """
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(
            [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t, models)]
             for t in texts.to_pylist()], _SPAN_TYPE)
    find = F.arrow_udf(run, SPANS)
    return docs.withColumn(result, find(F.coalesce(F.col(text_col), F.lit(""))))


def redact(docs: DataFrame, models: MarkovPair, text_col: str = "text",
           mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced; texts without one stay as they are."""
    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            if text:
                parts, at = [], 0
                for _, start, end in spans_of(text, models):
                    if end <= at:
                        continue
                    if start >= at:
                        parts += [text[at:start], mark]
                    at = end
                text = "".join([*parts, text[at:]])
            rows.append(text)
        return pa.array(rows, pa.string())
    return docs.withColumn(text_col, F.arrow_udf(run, "string")(F.col(text_col)))
