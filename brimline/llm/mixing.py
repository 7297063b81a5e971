"""Mixing sources to target weights by iterative proportional fitting.

The documents' tokens form a table by source, language and topic. Its cells are scaled in
turn until the totals of each source, language and topic meet their targets (raking); the
scale of a cell, over the largest scale, is the probability with which its documents stay.
Whether one stays follows from a hash of its id, so any run takes the same documents.

A rare value has a scale without bound, so the largest scale alone would let one odd document
decide how much of the corpus stays. At least ``KEPT`` of the tokens therefore stay: where the
largest scale leaves less, scales are divided by the number that leaves just that share, and
cells above it stay whole. Their values fall short of their targets then, and others go beyond;
each document's row says by how much for its source, language and topic (``short_*``), and
``margins_kept`` for all values.

The cells are one row per combination, summed before any shuffle. Up to ``DRIVER_CELLS`` of them are
raked as arrays on the driver; for more, a scale per value of each margin is kept beside them, and
each step joins the cells with two of these tables and writes the third anew; rounds and weights
are the same. Targets default to the present shares raised to a power (``TEMPER``)
and may be given as tables ``name, share``.

Nulls: NULL source, language or topic count as the value ``""``; a NULL text has no tokens. Cells
without tokens keep their documents (probability 1). An empty table gives no rows. Repeated
rows share one draw and stay or go together.
"""

from __future__ import annotations

import logging
import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brimline.llm.common import BLANKS, settled, text_of

log = logging.getLogger(__name__)

MARGINS = ("source", "lang", "topic")
#: Exponent on the present share of each value; below 1 it lifts small ones, 1 keeps them.
TEMPER = {"source": 0.7, "lang": 0.85, "topic": 1.0}
#: Rounds at least, and at most if totals are further than ``TOLERANCE`` from their targets.
ROUNDS = 6
MOST_ROUNDS = 2_000
#: Largest relative error of any value's total against its target.
TOLERANCE = 1e-4
#: Rounds in which the error must fall by a hundredth; targets that exclude each other end there.
STALLED = 500
#: Up to so many cells are raked on the driver, where a round takes no job.
DRIVER_CELLS = 200_000
#: Least share of the tokens that stays in expectation.
KEPT = 0.75
#: Divisors tried in one pass over the cells, and the ratio of neighbours that ends the search.
TRIED, NEAR = 32, 1e-9
#: What stands for zero where targets that exclude each other empty a cell.
LEAST = 1e-100
DRAW_DIGITS = 12


def tokens(text: Column) -> Column:
    """Words, as the unit of weight."""
    return F.regexp_count(text, F.lit(f"[^{BLANKS}]+")).cast("long")


def topic(text: Column) -> Column:
    """A coarse kind of text by its characters: table rows, digits, short notes, prose."""
    n = F.length(text)
    share = lambda chars: (n - F.length(F.translate(text, chars, ""))) / F.greatest(n, F.lit(1))
    return (
        F.when(share("|\t") > 0.02, "table").when(share("0123456789") > 0.1, "numeric")
        .when(n < 500, "note").otherwise("prose")
    )


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) fixed by the id."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**DRAW_DIGITS))


def weighed(docs: DataFrame, topic_column: str | None = None, whole: bool = False) -> DataFrame:
    """``_id, source, lang, topic, n_tokens`` of each document, and the row itself as ``_row``."""
    text = text_of()
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if whole else []
    return docs.select(
        *row, F.col("doc_id").cast("long").alias("_id"), value("source").alias("source"), value("lang").alias("lang"),
        (value(topic_column) if topic_column else topic(text)).alias("topic"), tokens(text).alias("n_tokens"),
    )


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*MARGINS).agg(F.sum("n_tokens").cast("double").alias("now"))


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """``margin, _share``: shares of the tokens raised to a power, unscaled."""
    return cells.groupBy(margin).agg(F.pow(F.sum("now"), F.lit(power)).alias("_share"))


def given(targets: DataFrame, margin: str) -> DataFrame:
    return targets.select(F.col("name").cast("string").alias(margin), F.col("share").cast("double").alias("_share"))


def raked_on_driver(cells: DataFrame, goals: dict[str, DataFrame], rounds: int) -> tuple[DataFrame, float]:
    """The cells with ``w`` by rounds over arrays, and the error left."""
    goal = {m: {r[m]: r["_goal"] for r in goals[m].collect()} for m in MARGINS}
    rows = [r for r in cells.select(*MARGINS, "now").collect() if all(r[m] in goal[m] for m in MARGINS)]
    w = np.array([r["now"] for r in rows], dtype=np.float64)
    at, want = {}, {}
    for m in MARGINS:
        names = sorted({r[m] for r in rows})
        place = {v: i for i, v in enumerate(names)}
        at[m] = np.array([place[r[m]] for r in rows], dtype=np.int64)
        want[m] = np.array([goal[m][v] for v in names], dtype=np.float64)
    error = earlier = math.inf if rows else 0.0
    for done in range(1, MOST_ROUNDS + 1 if rows else 1):
        for m in MARGINS:
            w = w * (want[m] / np.bincount(at[m], weights=w))[at[m]]
        if done < rounds:
            continue
        off = [np.bincount(at[m], weights=w) / w.sum() * want[m].sum() / want[m] - 1 for m in MARGINS]
        error = max(float(np.abs(x).max()) for x in off)
        if error <= TOLERANCE or (done % STALLED == 0 and error > 0.99 * earlier):
            break
        earlier = error if done % STALLED == 0 else earlier
    out = [(*(r[m] for m in MARGINS), r["now"], max(x, LEAST)) for r, x in zip(rows, w.tolist())]
    columns = ", ".join(f"{m} string" for m in MARGINS)
    return cells.sparkSession.createDataFrame(out, f"{columns}, now double, w double"), error


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, temper: dict[str, float] | None = None,
         rounds: int = ROUNDS) -> DataFrame:
    """The cells with ``w``, whose totals by each margin are in proportion to the targets.

    Values without a target keep nothing. Rounds go on, ``rounds`` at least, until every total is
    within ``TOLERANCE`` of its target. Targets that cannot be met together end at a bound with a
    warning that names the error left; the last margin is met exactly even then.
    """
    cells = settled(cells.filter("now > 0"), "cells")
    goals = {}
    for m in MARGINS:
        t = given(targets[m], m).filter("_share > 0") if targets and m in targets else tempered(cells, m, (temper or TEMPER)[m])
        one = t.agg(F.sum("_share").alias("_all"))
        goals[m] = settled(t.crossJoin(F.broadcast(one)).select(m, (F.col("_share") / F.col("_all")).alias("_goal")), f"goal-{m}")
    scales = {m: goals[m].select(m, F.lit(1.0).alias("_f")) for m in MARGINS}

    def scaled(but: str | None = None) -> DataFrame:
        out = cells.withColumn("w", F.col("now"))
        for m in MARGINS:
            if m != but:
                out = out.join(scales[m], m).withColumn("w", F.col("w") * F.col("_f")).drop("_f")
        return out

    def error_left() -> float:
        """Shares are those of the values that have cells, as only they can have tokens."""
        worst = []
        for m in MARGINS:
            met = scaled().groupBy(m).agg(F.sum("w").alias("_w")).join(goals[m], m)
            all_of = met.agg(F.sum("_w").alias("_ws"), F.sum("_goal").alias("_goals"))
            error = F.abs(F.col("_w") / F.col("_ws") * F.col("_goals") / F.col("_goal") - 1)
            worst.append(met.crossJoin(F.broadcast(all_of)).agg(F.max(error)).first()[0] or 0.0)
        return max(worst)

    if cells.count() <= DRIVER_CELLS:
        out, error = raked_on_driver(cells, goals, rounds)
    else:
        earlier = math.inf
        for done in range(1, MOST_ROUNDS + 1):
            for m in MARGINS:
                total = scaled(but=m).groupBy(m).agg(F.sum("w").alias("_w"))
                found = total.join(goals[m], m).select(m, (F.col("_goal") / F.col("_w")).alias("_f"))
                scales[m] = settled(found, f"scale-{m}")
            if done < rounds:
                continue
            error = error_left()
            if error <= TOLERANCE or (done % STALLED == 0 and error > 0.99 * earlier):
                break
            earlier = error if done % STALLED == 0 else earlier
        out = scaled().select(*MARGINS, "now", "w")
    if error > TOLERANCE:
        log.warning("raking stopped with totals up to %.2g of their targets off", error)
    return out


def divisor(scale: DataFrame, kept: float = KEPT) -> float | None:
    """What the scales ``_s`` of cells with ``now`` tokens are divided by: the largest, or where
    that leaves less than ``kept`` of the tokens, the number that leaves this share.

    What stays falls with the divisor, in pieces: the tokens of cells above it, and the scaled
    ones of the others over it. The piece is found in passes over all cells, and solved.
    """
    left = lambda d: F.sum(F.col("now") * F.least(F.lit(1.0), F.col("_s") / F.lit(d)))
    low, high, total = scale.agg(F.min("_s"), F.max("_s"), F.sum("now")).first()
    if high is None or scale.agg(left(high)).first()[0] >= kept * total:
        return high
    low = max(low, high * LEAST)
    while high > low * (1 + NEAR):
        tried = [low * (high / low) ** (i / TRIED) for i in range(TRIED + 1)]
        found = scale.agg(*[left(d).alias(f"d{i}") for i, d in enumerate(tried)]).first()
        at = max((i for i in range(TRIED) if found[i] >= kept * total), default=0)
        low, high = tried[at], tried[at + 1]
    whole = F.col("_s") > math.sqrt(low * high)
    above, others = scale.agg(F.sum(F.when(whole, F.col("now"))), F.sum(F.when(~whole, F.col("now") * F.col("_s")))).first()
    wanted = kept * total - (above or 0.0)
    return others / wanted if others and wanted > 0 else low


def probabilities(raked: DataFrame, kept: float = KEPT) -> DataFrame:
    """``source, lang, topic, probability``: the scale of each cell over the divisor, at most 1."""
    scale = raked.select(*MARGINS, "now", (F.col("w") / F.col("now")).alias("_s"))
    over = F.col("_s") / F.lit(divisor(scale, kept)).cast("double")
    return scale.select(*MARGINS, F.least(F.lit(1.0), over).alias("probability"))


def margins_kept(raked: DataFrame, table: DataFrame) -> DataFrame:
    """``margin, value, now, kept, share, goal``: the tokens of each value, those that stay in
    expectation, their share of all that stay and the share the raked cells call for."""
    cells = raked.join(table, list(MARGINS))
    parts = [
        cells.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value"))
        .agg(F.sum("now").alias("now"), F.sum(F.col("now") * F.col("probability")).alias("kept"), F.sum("w").alias("w"))
        for m in MARGINS
    ]
    out = reduce(DataFrame.unionByName, parts)
    all_of = out.groupBy("margin").agg(F.sum("kept").alias("_kept"), F.sum("w").alias("_w"))
    return out.join(F.broadcast(all_of), "margin").select(
        "margin", "value", "now", "kept", (F.col("kept") / F.col("_kept")).alias("share"), (F.col("w") / F.col("_w")).alias("goal")
    )


def chances(rows: DataFrame, targets: dict[str, DataFrame] | None = None, temper: dict[str, float] | None = None,
            rounds: int = ROUNDS, kept: float = KEPT) -> DataFrame:
    """``source, lang, topic, probability, short_source, short_lang, short_topic`` of every cell of
    weighed rows with tokens, written to the shared folder: Spark then knows its size when it
    chooses how to join it. ``short_*`` is the part of its target that the value of the cell
    misses among the tokens that stay in expectation; below zero it has more.
    """
    raked = settled(rake(cells_of(rows), targets, temper, rounds), "raked")
    table = settled(probabilities(raked, kept), "probabilities")
    margins = settled(margins_kept(raked, table).withColumn("_short", 1 - F.col("share") / F.col("goal")), "margins")
    for r in margins.groupBy("margin").agg(
        F.sum("now").alias("now"), F.sum("kept").alias("kept"), F.max("_short").alias("most")
    ).collect():
        log.info("%s: %.0f of %.0f tokens stay; largest shortfall %.3f", r.margin, r.kept, r["now"], r.most)
    for m in MARGINS:
        table = table.join(margins.filter(F.col("margin") == m).select(F.col("value").alias(m), F.col("_short").alias(f"short_{m}")), m)
    return settled(table.select(*MARGINS, "probability", *[f"short_{m}" for m in MARGINS]), "chances")


def drawn(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Weighed rows with ``probability``, ``short_*`` and ``kept``."""
    same = reduce(lambda a, b: a & b, [F.col(f"r.{m}") == F.col(f"p.{m}") for m in MARGINS])
    chance = (
        F.when(F.col("n_tokens") == 0, F.coalesce("probability", F.lit(1.0)))
        .otherwise(F.coalesce("probability", F.lit(0.0)))
    )
    short = [F.coalesce(c, F.lit(0.0)).alias(c) for c in (f"short_{m}" for m in MARGINS) if c in table.columns]
    out = rows.alias("r").join(table.alias("p"), same, "left").select("r.*", chance.alias("probability"), *short)
    return out.withColumn("kept", draw(F.col("_id")) < F.col("probability"))


def kept_documents(docs: DataFrame, topic_column: str | None = None, **options) -> DataFrame:
    """The documents drawn, with their columns."""
    table = chances(weighed(docs, topic_column), **options)
    return drawn(weighed(docs, topic_column, whole=True), table).filter("kept").select("_row.*")
