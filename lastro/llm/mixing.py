"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import Scratch
from .common import free, spread_join, with_small

#: Documents of a source that are rounded together.
BIN_ROWS = 2000
#: Documents of a bin, and ways to round them, up to which all are compared.
FEW, WAYS = 12, 600_000
#: Relative gap between a constraint and its target that ends the iterations.
TOLERANCE = 1e-9


def words(text: str | Column) -> Column:
    """Runs of anything but space and the controls 9 to 13; NULL has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weighted_targets(totals: DataFrame, group: str, total: str,
                     weights: tuple[float, ...] = (5, 2, 1),
                     share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``totals``, one row a group, with a ``target`` for each.

    Groups by code point, NULL last, have the weights in turn and divide
    ``share`` times all totals by weight. A target stops at ``most`` times its
    group's total, and the rest is divided again until none is above: the
    common level L is found for which the sum of min(most * total, weight * L)
    is what there is to give. Sums over the groups, sorted by the level at
    which each stops, give L without a loop. There is one row a group here, so
    windows over all of them are small.
    """
    everywhere = Window.rowsBetween(Window.unboundedPreceding,
                                    Window.unboundedFollowing)
    # strings are ordered by their UTF-8 bytes, which is by code point
    order = F.row_number().over(Window.orderBy(F.col(group).asc_nulls_last()))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    turn = F.pmod(order - 1, F.lit(len(weights))) + 1
    ranked = totals.select(
        "*", (share * F.sum(total).over(everywhere)).alias("_give"),
        (most * F.col(total)).alias("_most"),
        F.element_at(cycle, turn.cast("int")).alias("_weight"))
    stopping = Window.orderBy(F.col("_most") / F.col("_weight"),
                              F.col(group).asc_nulls_last())
    stopped = F.sum("_most").over(
        stopping.rowsBetween(Window.unboundedPreceding, -1))
    dividing = F.sum("_weight").over(
        stopping.rowsBetween(0, Window.unboundedFollowing))
    # the level if all before a group stop; it rises up to the right group
    # and falls after it
    level = (F.col("_give") - F.coalesce(stopped, F.lit(0.0))) / dividing
    return (ranked.withColumn("_level", level)
            .withColumn("target", F.least("_most", F.col("_weight")
                                          * F.max("_level").over(everywhere)))
            .drop("_give", "_most", "_weight", "_level"))


def balance(cells: DataFrame, size: str, constraints: dict[str, str],
            scratch: Scratch, most: float = 2.0, rounds: int = 200,
            count: str | None = None) -> DataFrame:
    """``cells`` with a ``rate`` of copies that meets token constraints.

    A cell stands for ``count`` documents (one, without it) of ``size`` tokens.
    Rates minimise the relative entropy to one copy of each document, with at
    most ``most`` copies. The convex dual gives them as exp(multiplier * size),
    or ``most`` if that is less, where a cell's multiplier is the sum of those
    of the constraints it is under: documents are tilted by their sizes.
    ``constraints`` maps a column that names groups to one that holds the
    group's target of tokens, the same in all its rows.

    One round takes a Newton step for the multipliers of each constraint in
    turn. Within a constraint groups share no cell, so the dual's Hessian is
    diagonal there and a step is one grouped sum, distributed over cells: the
    gap to the target over the tokens times size of the rates below ``most``.
    With one constraint a step that leaves the bounds known so far goes to
    their middle instead; with several, steps tilt no document of the group by
    more than a factor of e. Each round is written to the shared folder.

    A group with nothing to take or to give gets rate 0, one whose target is
    all it can give gets ``most``. Groups are met within ``TOLERANCE``, or as
    near as ``rounds`` bring them.
    """
    weight = F.col(count) if count else F.lit(1)
    alone = len(constraints) == 1
    tilt = F.exp(F.col("_dual") * F.col(size))
    rate = F.least(F.lit(float(most)), tilt)
    length = F.col(size).cast("double")
    state = {"_dual": F.lit(0.0), "_low": F.lit(float("-inf")), "_high": F.lit(float("inf"))}
    current = scratch.stage(cells.withColumns(state), "balance-start")
    for turn in range(rounds):
        gaps = []
        for number, (group, target) in enumerate(constraints.items()):
            free_slope = F.when(tilt < most, weight * length * length * tilt)
            sums = (current.where(F.col(size) > 0).groupBy(group).agg(
                F.sum(weight * length * rate).alias("_taken"),
                F.coalesce(F.sum(free_slope), F.lit(0.0)).alias("_slope"),
                F.sum(weight * length).alias("_all"), F.max(target).alias("_target"),
                F.min(length).alias("_least"), F.max(length).alias("_most"),
                F.max("_dual").alias("_at"), F.max("_low").alias("_l"),
                F.min("_high").alias("_h")))
            gap = F.col("_target") - F.col("_taken")
            open_ = ((F.col("_target") > 0)
                     & (F.col("_target") < most * F.col("_all") * (1 - TOLERANCE)))
            step = F.try_divide(gap, F.col("_slope"))
            if alone:
                # at these all documents have no copies, or ``most``
                low = F.greatest("_l", F.when(gap > 0, F.col("_at")).otherwise(
                    -700 / F.col("_least")))
                high = F.least("_h", F.when(gap < 0, F.col("_at")).otherwise(
                    F.lit(float(np.log(most))) / F.col("_least")))
                to = F.col("_at") + step
                step = F.when((to > low) & (to < high), to).otherwise(
                    (low + high) / 2) - F.col("_at")
            else:
                low, high = F.lit(float("-inf")), F.lit(float("inf"))
                step = F.greatest(-1 / F.col("_most"), F.least(1 / F.col("_most"), step))
            met = F.abs(gap) <= TOLERANCE * F.col("_target")
            sums = sums.select(
                F.col(group).alias("_group"),
                F.when(open_ & ~met, F.coalesce(step, F.lit(0.0))).otherwise(0.0).alias("_step"),
                F.when(open_, F.abs(gap) / F.col("_target")).otherwise(0.0).alias(f"_gap_{number}"),
                low.alias("_low"), high.alias("_high"), (~open_).alias(f"_full_{number}"))
            current = (current.drop("_low", "_high", f"_gap_{number}", f"_full_{number}")
                       .join(sums, F.col(group).eqNullSafe(F.col("_group")), "left")
                       .withColumn("_dual", F.col("_dual") + F.coalesce("_step", F.lit(0.0)))
                       .drop("_group", "_step"))
            gaps.append(F.max(f"_gap_{number}"))
        current = scratch.stage(current, f"balance-{turn}")
        worst = max((g or 0.0) for g in current.agg(*gaps).first())
        scratch.release("balance-start" if turn == 0 else f"balance-{turn - 1}")
        if worst <= TOLERANCE:
            break
    none, full = F.col(size) <= 0, F.lit(False)
    for number, target in enumerate(constraints.values()):
        none = none | (F.col(target) <= 0)
        full = full | F.coalesce(f"_full_{number}", F.lit(False))
    current = current.withColumn(
        "rate", F.when(none, 0.0).when(full, float(most)).otherwise(rate))
    return current.select(*cells.columns, "rate")


def _settle(copies: np.ndarray, size: np.ndarray, whole: np.ndarray, rate: np.ndarray,
            owed: float, most: int, most_steps: int = 20) -> None:
    """Give or take single copies, or one for another, while less is owed.

    Each document stays at its rate rounded down or up, but for a bin of a
    handful, which gets the copies that come nearest to what it should give,
    and of these the ones nearest to the rates.
    """
    real = np.flatnonzero(size > 0)
    if 0 < len(real) <= FEW and (most + 1) ** len(real) <= WAYS:  # a handful: all ways
        ways = np.stack(np.meshgrid(*[np.arange(most + 1)] * len(real), indexing="ij"),
                        -1).reshape(-1, len(real))
        off = np.abs(owed + (copies[real] - ways) @ size[real])
        near = np.flatnonzero(off <= off.min() + 1e-9)
        tilted = np.abs(ways[near] - rate[real]) @ size[real]
        copies[real] = ways[near[tilted.argmin()]]
        return
    free_rows = np.flatnonzero((rate > whole) & (size > 0))
    for _ in range(most_steps):
        up = free_rows[copies[free_rows] == whole[free_rows]]
        down = free_rows[copies[free_rows] > whole[free_rows]]
        up = up[np.argsort(size[up], kind="stable")]
        best = abs(owed) - 0.5, -1, -1
        for d in (-1, *down):
            wanted = owed + (size[d] if d >= 0 else 0)
            near = np.searchsorted(size[up], wanted)
            for u in (-1, *up[max(0, near - 1):near + 1]):
                left = abs(wanted - (size[u] if u >= 0 else 0))
                if left < best[0]:
                    best = left, u, d
        _, u, d = best
        if u < 0 and d < 0:
            return
        if u >= 0:
            copies[u] += 1
            owed -= size[u]
        if d >= 0:
            copies[d] -= 1
            owed += size[d]


def _round_bin(columns: list[str], most: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        size = (rows["size"] * rows["repeats"]).to_numpy(float)
        order = np.lexsort((rows["id"].astype(str).to_numpy(), -size))
        rows, size = rows.iloc[order], size[order]
        rate = np.minimum(rows["rate"].to_numpy(float), most)
        whole = np.floor(rate + 1e-9)
        owed, copies = 0.0, np.empty(len(rows), np.int64)
        for k in range(len(rows)):
            owed += (rate[k] - whole[k]) * size[k]
            more = size[k] > 0 and whole[k] < most and 2 * owed >= size[k]
            copies[k] = whole[k] + more
            owed -= more * size[k]
        _settle(copies, size, whole, rate, owed, most)
        return rows[columns].assign(copies=np.where(size > 0, copies, 0))
    return run


def units_of(docs: DataFrame, id_col: str, group: str, size: Column) -> DataFrame:
    """(id, group, size, repeats): documents, rows that agree in all three once."""
    return (docs.select(F.col(id_col).alias("id"), F.col(group).alias("group"),
                        size.alias("size"))
            .groupBy("id", "group", "size").agg(F.count("*").alias("repeats")))


def mix(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id",
        group: str = "source", text_col: str = "text",
        weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
        most: int = 2) -> DataFrame:
    """(id, group, size, repeats, group_size, target, rate, copies) of documents.

    Sizes are words. Targets are those of ``weighted_targets``, rates those of
    ``balance`` over the sizes that each group has, and copies are rates made
    whole:

    the documents of a group are dealt by a hash of their id into bins of about
    ``BIN_ROWS``, however many there are. In a bin, from the largest document
    to the smallest, one more copy is taken whenever at least half of it is
    owed; then single copies are exchanged while that lowers what is owed. It
    ends at less than half of a small document, and a group misses its target
    by that for each bin. Ids decide ties, so reruns agree.

    Rows that agree in id, group and size are taken alike, as one unit with
    ``repeats``; so are rows without an id. NULL and empty texts have size 0
    and no copies. An empty table gives no rows. The result is staged under
    ``mix`` in ``scratch``.
    """
    units = scratch.stage(units_of(docs, id_col, group, words(text_col)), "units")
    totals = units.groupBy("group").agg(
        F.sum(F.col("size") * F.col("repeats")).alias("group_size"),
        F.count("*").alias("rows"))
    cells = weighted_targets(
        scratch.stage(totals, "totals"), "group", "group_size", weights, share, most)
    # documents of one source and size are tilted alike
    sizes = units.groupBy("group", "size").agg(F.sum("repeats").alias("documents"))
    key = F.coalesce(F.concat(F.lit("="), F.col("group").cast("string")), F.lit(""))
    sizes = spread_join(scratch.stage(sizes.withColumn("_key", key), "sizes"),
                        cells.withColumn("_key", key).drop("group"), "_key").drop("_key")
    rates = balance(scratch.stage(sizes, "cells"), "size", {"group": "target"}, scratch,
                    most, count="documents")
    rates = scratch.stage(rates.drop("documents"), "rates")
    # a source and a size may hold a third of all rows: their key goes with a salt
    key = F.concat_ws("\0", F.col("size").cast("string"), key)
    dealt = spread_join(
        scratch.stage(units.withColumn("_key", key), "keyed"),
        rates.withColumn("_key", key).drop("group", "size"), "_key").drop("_key")
    dealt = dealt.withColumn(
        "bin", F.pmod(F.xxhash64("id"), F.ceil(F.col("rows") / BIN_ROWS)))
    columns = ["id", "group", "size", "repeats", "group_size", "target", "rate"]
    kinds = dict(dealt.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", copies long"
    result = (dealt.select(*columns, "bin").groupBy("group", "bin")
              .applyInPandas(_round_bin(columns, most), schema))
    return scratch.stage(result, "mix")


def apply_mix(docs: DataFrame, id_col: str = "doc_id", group: str = "source",
              text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` repeated as the mix takes them, numbered by ``copy``.

    Rows of no copies go. A column ``copy`` of the input is replaced.
    """
    with Scratch(docs.sparkSession) as scratch:
        mixed = mix(docs, scratch, id_col, group, text_col, **options)
        scratch.keep("mix")
    docs = docs.drop("copy")
    key, own_group, own_size, times, size = (
        free(docs, f"_{x}") for x in ("key", "group", "own_size", "times", "size"))
    taken = mixed.where("copies > 0").select(
        F.col("id").alias(key), F.col("group").alias(own_group),
        F.col("size").alias(own_size), F.col("copies").cast("int").alias(times))
    matched = docs.withColumn(size, words(text_col)).join(
        with_small(taken, taken.count()), F.col(id_col).eqNullSafe(F.col(key))
        & F.col(group).eqNullSafe(F.col(own_group)) & (F.col(size) == F.col(own_size)))
    return (matched.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(times))))
            .drop(key, own_group, own_size, times, size))
