"""Text quality by a sparse ensemble of rules over statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample

#: Labelled documents that the rules are fitted on.
SAMPLE_DOCUMENTS = 20_000


# What is counted in a text.
COUNTED = {
    "words": r"\S+",
    "uppers": r"\p{Lu}",
    "marks": r"[^\p{L}\p{N}\s]",
    "digits": r"\p{N}",
    "mark_runs": r"[^\p{L}\p{N}\s]{2,}",
    "lone_marks": r"(?<!\S)[^\p{L}\p{N}\s]+(?!\S)",
    "shouts": r"!",
    "sentence_ends": r"[.?](?!\S)",
    "same_as_next": r"(?<!\S)(\S++)(?=\s+\1(?!\S))",
}
STATISTICS = ("log_chars", "word_length", "upper_share", "mark_share", "digit_share",
              "mark_runs", "lone_marks", "shouts", "sentence_ends", "same_as_next",
              "distinct_words", "distinct_lines")


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``__lastro_q_<name>`` for each of ``STATISTICS``.

    All are built-in functions of the whole text; NULL counts as empty, and an
    empty text has 0 everywhere. Counts become columns first and statistics
    after them, so that each count is made once, however many rules use it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, lines = F.split(text, r"[ \t\r\n]+"), F.split(text, r"\n")
    counts = {f"__lastro_c_{name}": F.regexp_count(text, F.lit(pattern)).cast("double")
              for name, pattern in COUNTED.items()}
    counts |= {"__lastro_c_chars": F.length(text).cast("double"),
               "__lastro_c_kinds": F.size(F.array_distinct(words)).cast("double"),
               "__lastro_c_lines": F.size(lines).cast("double"),
               "__lastro_c_lines_kinds": F.size(F.array_distinct(lines)).cast("double")}

    def per(part: str, whole: str) -> Column:
        return F.when(F.col(f"__lastro_c_{whole}") > 0,
                      F.col(f"__lastro_c_{part}") / F.col(f"__lastro_c_{whole}")).otherwise(0.0)

    found = {"log_chars": F.log1p("__lastro_c_chars"),
             "word_length": per("chars", "words"),
             "upper_share": per("uppers", "chars"),
             "mark_share": per("marks", "chars"),
             "digit_share": per("digits", "chars"),
             "distinct_words": per("kinds", "words"),
             "distinct_lines": per("lines_kinds", "lines")}
    found |= {name: per(name, "words") for name in STATISTICS if name not in found}
    return (docs.withColumns(counts)
            .withColumns({f"__lastro_q_{name}": found[name] for name in STATISTICS})
            .drop(*counts))


@dataclass(frozen=True)
class Condition:
    """``statistic <= value``, or ``>`` when ``above``."""

    statistic: int
    above: bool
    value: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        column = x[:, self.statistic]
        return column > self.value if self.above else column <= self.value


Rule = tuple[Condition, ...]


def _split(x: np.ndarray, y: np.ndarray, weight: np.ndarray, bins: int,
           fewest: int, tried: np.ndarray) -> tuple[float, int, float] | None:
    """(gain, statistic, value) of the cut that lowers squared error most."""
    best = None
    mean = np.average(y, weights=weight)
    for k in tried:
        cuts = np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1]))
        place = np.searchsorted(cuts, x[:, k])
        n = np.bincount(place, minlength=len(cuts) + 1).cumsum()[:-1]
        w = np.bincount(place, weight, len(cuts) + 1).cumsum()[:-1]
        s = np.bincount(place, weight * (y - mean), len(cuts) + 1).cumsum()[:-1]
        rest = weight.sum() - w
        good = (n >= fewest) & (len(y) - n >= fewest) & (w > 0) & (rest > 0)
        if good.any():
            gain = np.where(good, s * s / np.maximum(w, 1e-12)
                            + s * s / np.maximum(rest, 1e-12), -1)
            at = int(gain.argmax())
            if best is None or gain[at] > best[0]:
                best = float(gain[at]), int(k), float(cuts[at])
    return best


def tree_paths(x: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int,
               random: np.random.Generator, path: Rule = (), fewest: int = 5,
               ) -> list[Rule]:
    """The paths to all nodes below the root of one regression tree."""
    if depth == 0 or len(y) < 2 * fewest or np.ptp(y) == 0:
        return []
    tried = random.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False)
    found = _split(x, y, weight, 32, fewest, tried)
    if found is None or found[0] <= 1e-9 * weight.sum():
        return []
    paths = []
    for above in (False, True):
        step = Condition(found[1], above, found[2])
        here = (*path, step)
        inside = step.holds(x)
        paths += [here, *tree_paths(x[inside], y[inside], weight[inside], depth - 1,
                                    random, here, fewest)]
    return paths


def lasso_logistic(z: np.ndarray, y: np.ndarray, weight: np.ndarray,
                   penalty: float = 1e-3, rounds: int = 500) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic regression with an absolute penalty,
    by accelerated proximal steps."""
    w, c = np.zeros(z.shape[1]), 0.0
    share = weight / weight.sum()
    bound = 0.25 * ((z * z * share[:, None]).sum() + 1)
    # the largest eigenvalue by power steps; the sum above bounds it loosely
    v = np.ones(z.shape[1] + 1)
    for _ in range(30):
        zv = z @ v[:-1] + v[-1]
        v = np.append(z.T @ (share * zv), (share * zv).sum())
        size = np.linalg.norm(v)
        if size == 0:
            break
        v /= size
        bound = 0.26 * size
    ahead_w, ahead_c, t = w.copy(), c, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ ahead_w + ahead_c, -40, 40)))
        slope = share * (p - y)
        new_w = ahead_w - z.T @ slope / bound
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - penalty / bound, 0)
        new_c = ahead_c - slope.sum() / bound
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w = new_w + (t - 1) / t_next * (new_w - w)
        ahead_c = new_c + (t - 1) / t_next * (new_c - c)
        w, c, t = new_w, new_c, t_next
    return w, float(c)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted conjunctive rules over named statistics."""

    names: list[str]
    rules: list[Rule]
    weights: list[float]
    offset: float

    @classmethod
    def fit(cls, names: list[str], x: np.ndarray, y: np.ndarray, trees: int = 40,
            depth: int = 3, penalty: float = 1e-3, seed: int = 17) -> RuleEnsemble:
        """Rules from trees on half of the rows each, then lasso weights.

        Both labels weigh the same. With one label only there are no rules,
        and the score says that label; without labels it is a half.
        """
        y = y.astype(float)
        if len(y) == 0 or y.min() == y.max():
            offset = 0.0 if len(y) == 0 else (4.0 if y[0] == 1 else -4.0)
            return cls(names, [], [], offset)
        random = np.random.default_rng(seed)
        weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        seen: dict[bytes, Rule] = {}
        for _ in range(trees):
            half = random.choice(len(y), max(2, len(y) // 2), replace=False)
            for rule in tree_paths(x[half], y[half], weight[half], depth, random,
                                   fewest=max(3, len(y) // 1000)):
                rows = cls._holds(rule, x)
                if 0 < rows.sum() < len(y):
                    key = rows.tobytes()
                    if key not in seen or len(rule) < len(seen[key]):
                        seen[key] = rule
        rules = list(seen.values())
        z = np.array([cls._holds(r, x) for r in rules], float).T.reshape(len(y), -1)
        w, c = lasso_logistic(z, y, weight, penalty)
        kept = np.flatnonzero(np.abs(w) > 1e-6)
        return cls(names, [rules[k] for k in kept], [float(w[k]) for k in kept], c)

    @staticmethod
    def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
        rows = np.ones(len(x), bool)
        for condition in rule:
            rows &= condition.holds(x)
        return rows

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.offset)
        for rule, weight in zip(self.rules, self.weights):
            z += weight * self._holds(rule, x)
        return 1 / (1 + np.exp(-z))

    def column(self) -> Column:
        """The score as one column expression over the statistics' columns."""
        terms = [F.lit(self.offset)]
        for rule, weight in zip(self.rules, self.weights):
            whole = F.lit(True)
            for c in rule:
                value = F.col(f"__lastro_q_{self.names[c.statistic]}")
                whole = whole & (value > c.value if c.above else value <= c.value)
            terms.append(F.when(whole, weight).otherwise(0.0))
        while len(terms) > 1:  # a balanced sum keeps the expression shallow
            terms = [sum(terms[k + 1:k + 2], terms[k]) for k in range(0, len(terms), 2)]
        return 1 / (1 + F.exp(-terms[0]))

    def __str__(self) -> str:
        lines = [f"{w:+.3f}  if " + " and ".join(
            f"{self.names[c.statistic]} {'>' if c.above else '<='} {c.value:.4g}"
            for c in rule) for rule, w in zip(self.rules, self.weights)]
        return "\n".join([f"{self.offset:+.3f}", *lines])


def fit_model(docs: DataFrame, labels: DataFrame, train: Column,
              id_col: str = "doc_id", label_col: str = "quality",
              text_col: str = "text", documents: int = SAMPLE_DOCUMENTS,
              seed: int = 19) -> RuleEnsemble:
    """An ensemble from the labelled rows for which ``train`` holds.

    At most ``documents`` of them, those with the smallest hashes of their
    ids, are joined with their texts; their statistics come to the driver.
    """
    spark = docs.sparkSession
    known = bounded_sample(
        labels.where(train & F.col(label_col).isNotNull())
        .select(F.col(id_col), F.col(label_col).cast("int").alias("_label")),
        id_col, documents, seed).select(F.col(id_col).alias("_id"), "_label")
    known = spark.createDataFrame(known.collect(), known.schema)
    rows = docs.select(id_col, text_col).join(F.broadcast(known), F.col(id_col) == F.col("_id"))
    columns = [f"__lastro_q_{name}" for name in STATISTICS]
    found = (with_statistics(rows.select("_id", "_label", text_col), text_col)
             .select("_label", *columns, "_id").orderBy("_id", "_label", *columns)
             .collect())
    table = np.array([r[:-1] for r in found], float).reshape(-1, len(columns) + 1)
    return RuleEnsemble.fit(list(STATISTICS), table[:, 1:], table[:, 0])


def score(docs: DataFrame, model: RuleEnsemble, text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted, 1 from ``threshold`` on.

    Statistics and rules are built-in expressions over the whole text, which
    is read where it lies. NULL counts as an empty text. Columns named score
    or predicted are replaced.
    """
    # The row number is never NULL, so it changes nothing. It keeps filters on
    # the result from being rewritten over the texts, where each rule would
    # count everything again.
    scored = with_statistics(docs, text_col).withColumns(
        {"__lastro_raw": model.column(), "__lastro_row": F.monotonically_increasing_id()})
    known = F.when(F.col("__lastro_row") >= 0, F.col("__lastro_raw"))
    return (scored.withColumns({"score": known,
                                "predicted": (known >= threshold).cast("int")})
            .drop("__lastro_raw", "__lastro_row", *(f"__lastro_q_{name}" for name in STATISTICS)))
