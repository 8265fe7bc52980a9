"""Source mixtures by iterative proportional fitting of token weights, then calibrated sampling."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.session import stored

SEED = "mix-1"
TEMPERATURE = 0.9          # below one, small sources, languages and topics get more than their share
TOLERANCE = 1e-11
MAX_CYCLES = 500
CONFLICT = 1e-6            # scalings that stay this far from one, cycle after cycle, tell of targets in conflict
MARGINS = ("source", "lang", "topic")
WORD = r"[^\x20\x09-\x0D]+"
# Topics by the first pattern found in the text, in this order; none found: prose.
TOPICS = (
    ("licence", r"(?i)licen[sc]ed? under|copyright|all rights reserved"),
    ("contact", r"\w@[\w-]+\.\w|\d{3}[ -]\d{3,4}"),
    ("table", r" \| \S+ \| "),
    ("markup", r"[*#%$&!]{2}"),
)
_NONE = "prose"


def topic_of(text: Column, topics: tuple[tuple[str, str], ...] = TOPICS) -> Column:
    out = F.lit(_NONE)
    for name, pattern in reversed(topics):
        out = F.when(F.regexp_like(text, F.lit(pattern)), name).otherwise(out)
    return out


def _level(c: Column) -> Column:
    """A category as text that is never null: null is a category of its own."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))


def _profile_columns(row: Column) -> list[Column]:
    text = F.coalesce(row["text"], F.lit(""))
    return [_level(row["source"]).alias("source"), _level(row["lang"]).alias("lang"),
            _level(topic_of(text)).alias("topic"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens")]


def profile(docs: DataFrame) -> DataFrame:
    """``doc_id, source, lang, topic, tokens``: categories as never-null text, tokens as words of the whole text."""
    return docs.select("doc_id", *_profile_columns(docs))


def targets(cells: DataFrame, temperature: float = TEMPERATURE) -> dict[str, DataFrame]:
    """Target share per level of each margin: the margins of the table whose cells are raised to ``temperature``.

    That table has the same cells, so the targets can always be met together,
    also where a source has one language only.
    """
    raised = stored(cells.select(*MARGINS, F.pow(F.col("tokens").cast("double"), F.lit(temperature)).alias("raised")), "raised")
    whole = raised.agg(F.sum("raised")).first()[0]
    return {m: stored(raised.groupBy(m).agg((F.sum("raised") / whole).alias("target")), f"{m}-target") for m in MARGINS}


def asked_targets(cells: DataFrame, asked: Mapping[str, Mapping[str | None, float]],
                  temperature: float = TEMPERATURE) -> dict[str, DataFrame]:
    """Targets per margin from shares that are asked for by name, as ``{"lang": {"en": 0.5, None: 0.1}}``.

    Keys are the categories as the table has them (topics by their names, None
    for null). Levels that a margin's shares leave out divide the rest in
    proportion to their tempered targets, and so do all levels of a margin that
    is left out. Levels without tokens cannot be met; the others are scaled up.
    Shares below zero, or of a sum above one, and margins that do not exist raise.
    """
    unknown = set(asked) - set(MARGINS)
    if unknown:
        raise ValueError(f"no such margins: {sorted(unknown)}")
    spark, own = cells.sparkSession, targets(cells, temperature)
    for m, shares in asked.items():
        left = 1.0 - sum(shares.values())
        if left < -1e-9 or any(v < 0 for v in shares.values()):
            raise ValueError(f"shares of {m} have to be at least 0 and at most 1 together")
        levels = [("-" if k is None else f"={k}", float(v)) for k, v in shares.items()]
        named = spark.createDataFrame(levels, f"{m} string, share double")
        open_share = own[m].join(named, m, "left_anti").agg(F.sum("target")).first()[0]
        other = F.col("target") * F.lit(max(0.0, left) / open_share if open_share else 0.0)
        share = own[m].join(named, m, "left").select(m, F.coalesce("share", other).alias("target"))
        whole = share.agg(F.sum("target")).first()[0]
        if not whole:
            raise ValueError(f"no level of {m} with a share has tokens")
        own[m] = stored(share.withColumn("target", F.col("target") / F.lit(whole)), f"{m}-target")
    return own


def reached(cells: DataFrame, raked: DataFrame, wanted: dict[str, DataFrame]) -> DataFrame:
    """``margin, level, target, share, residual`` of a fit: what each level was to get, what it gets, and the difference."""
    whole = cells.agg(F.sum("tokens")).first()[0]
    out = None
    for m in MARGINS:
        shares = cells.join(raked, list(MARGINS)).groupBy(m).agg(
            (F.sum(F.col("tokens") * F.col("weight")) / F.lit(whole)).alias("share"))
        own = wanted[m].join(shares, m).select(
            F.lit(m).alias("margin"), F.col(m).alias("level"), "target", "share",
            (F.col("share") - F.col("target")).alias("residual"))
        out = own if out is None else out.unionByName(own)
    return out


def rake(cells: DataFrame, wanted: dict[str, DataFrame], tolerance: float = TOLERANCE,
         max_cycles: int = MAX_CYCLES, strict: bool = True) -> DataFrame:
    """``source, lang, topic, weight``: a weight per token of each cell, so that all margins meet their targets.

    ``cells(source, lang, topic, tokens)`` are totals with tokens above zero.
    For one margin after the other the cells are summed by its levels (partial
    sums first) and scaled to the target. One job does a cycle over all margins:
    the sums are small and their shuffles are used again within the job, and the
    stored result starts the next cycle. It ends when no scaling in a cycle is
    further than ``tolerance`` from one. Targets that cannot be met together
    raise after ``max_cycles`` if ``strict``. Otherwise the fit reached is the
    result: the cycles end early once their largest scaling no longer changes,
    the last margin is met, and ``reached`` tells how far off the others are.
    Levels without tokens have no cells and take no part. The mean weight of a
    token is one; a cell whose level is to get nothing weighs nothing.
    """
    whole = cells.agg(F.sum("tokens")).first()[0]
    state = cells.withColumn("mass", F.col("tokens").cast("double"))
    for m in MARGINS:
        state = state.join(wanted[m].select(m, (F.col("target") * whole).alias(f"want_{m}")), m)
    state = stored(state.withColumn("moved", F.lit(0.0)), "raking")
    last = None
    for _ in range(max_cycles):
        step = state.withColumn("moved", F.lit(0.0))
        for m in MARGINS:
            sums = step.groupBy(m).agg(F.sum("mass").alias("sum"))
            # A level that weighs nothing already stays so.
            ratio = F.when(F.col("sum") > 0, F.col(f"want_{m}") / F.col("sum")).otherwise(1.0)
            step = step.join(sums, m).select(
                *MARGINS, "tokens", *[f"want_{x}" for x in MARGINS], (F.col("mass") * ratio).alias("mass"),
                F.greatest("moved", F.abs(ratio - 1)).alias("moved"))
        state = stored(step, "raking")
        moved = state.agg(F.max("moved")).first()[0]
        stuck = last is not None and moved > CONFLICT and abs(moved - last) <= tolerance
        if moved <= tolerance or (stuck and not strict):
            break
        last = moved
    else:
        if strict:
            raise RuntimeError("the marginals cannot be met together")
    # Targets in conflict with zeros may leave a little less than all mass.
    mass = state.agg(F.sum("mass")).first()[0]
    scale = 1.0 if strict or not mass else whole / mass
    return state.select(*MARGINS, (F.col("mass") * F.lit(scale) / F.col("tokens")).alias("weight"))


def roll(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that hangs on the document's id and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def _calibrated(own: DataFrame, temperature: float, tolerance: float,
                asked: Mapping | None = None) -> tuple[DataFrame, float]:
    """The weight of every cell of a profile, and the largest weight."""
    cells = stored(own.where("tokens > 0").groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    if cells.isEmpty():
        return cells.select(*MARGINS, F.lit(1.0).alias("weight")), 1.0
    if asked is None:
        raked = stored(rake(cells, targets(cells, temperature), tolerance), "raked")
    else:
        raked = stored(rake(cells, asked_targets(cells, asked, temperature), tolerance, strict=False), "raked")
    return raked, raked.agg(F.max("weight")).first()[0]


def _judged(own: DataFrame, raked: DataFrame, top: float, seed: str) -> DataFrame:
    """A profile with ``weight, probability, kept``; rows without a word keep weight one."""
    empty = F.col("tokens") == 0
    weight = F.when(empty, 1.0).otherwise(F.col("weight"))
    chance = F.when(empty, 1.0).otherwise(F.col("weight") / F.lit(top))
    return (own.join(raked, list(MARGINS), "left")
            .withColumns({"weight": weight, "probability": chance})
            .withColumn("kept", roll(F.col("doc_id"), seed) < F.col("probability")))


def mixture(docs: DataFrame, temperature: float = TEMPERATURE, seed: str = SEED,
            tolerance: float = TOLERANCE, asked: Mapping[str, Mapping[str | None, float]] | None = None) -> DataFrame:
    """One row per document: ``doc_id, source, lang, topic, tokens, weight, probability, kept``.

    ``weight`` is the calibrated weight of each of its tokens; ``probability`` is
    that weight over the largest, so that the best-wanted cell is kept whole and
    the kept tokens meet all marginals in expectation; ``kept`` compares it with
    a roll on the doc_id. Null categories are levels of their own (written
    ``-``, others after ``=``). Documents without a word weigh nothing in any
    margin and are kept with weight one. Rows that share a doc_id share a roll.
    Other columns are not read; an empty table gives an empty table. ``asked``
    names target shares (see ``asked_targets``); without it all targets are the
    tempered ones. Shares in conflict give the nearest fit that raking reaches.
    """
    own = stored(profile(docs), "profile")
    raked, top = _calibrated(own, temperature, tolerance, asked)
    return _judged(own, raked, top, seed).select("doc_id", *MARGINS, "tokens", "weight", "probability", "kept")


def sampled(docs: DataFrame, temperature: float = TEMPERATURE, seed: str = SEED,
            tolerance: float = TOLERANCE, asked: Mapping[str, Mapping[str | None, float]] | None = None) -> DataFrame:
    """The documents that the mixture keeps, with their columns as they are, whatever their names.

    Weights come from the whole table; each row is then judged where it lies, so
    no text moves.
    """
    raked, top = _calibrated(profile(docs), temperature, tolerance, asked)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    own = rows.select("row", F.col("row.doc_id").alias("doc_id"), *_profile_columns(rows.row))
    return _judged(own, raked, top, seed).where("kept").select("row.*")
