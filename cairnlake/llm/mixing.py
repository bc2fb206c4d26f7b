"""Sources mixed to target shares of all tokens.

Method: documents fall into cells of source, language and topic. Iterative proportional fitting rakes the cells' weights (how
often a document is used) to the sources' target shares and to the languages' and topics' own shares, never beyond a
source's most uses; the sources come last and are met exactly where their documents suffice. Documents are then drawn with
the calibrated weights: the whole part of a weight for certain, the rest by systematic sampling in order of size, so that
a source's tokens come out within about one document of what they should be.

The total is the largest at which no source with documents falls short, but at least ``least_total`` of the sources' tokens:
a source too small for that falls short and says so. A source without documents always falls short; then the others keep
their proportions to one another.

Defined results: sources are compared trimmed and lower-cased; null and unknown sources, and null, empty and blank texts
without tokens, are not used; null languages and topics are cells of their own; repeated rows count once; sources without
documents come out with share 0; no targets or no documents give an empty mix; other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnlake.lineage import cut_lineage
from cairnlake.skew import broadcast_if_small

#: Least number of buckets over which each size class of a source is spread for drawing.
BUCKETS = 64
#: Documents for each of which there is one more bucket.
PER_BUCKET = 1_000_000
#: Cells that the driver fits at most (about 100 MB and a minute); with more the mix is refused and never cut. Sources,
#: languages and topics are short lists by definition: 200,000 cells are 20 sources by 50 languages by 200 topics.
MOST_CELLS = 200_000
ROUNDS = 200


@dataclass
class Fit:
    """Weight of each cell, and the total aimed at."""

    weights: np.ndarray
    total: float


def fill(tokens: np.ndarray, weights: np.ndarray, cap: float, wanted: float) -> np.ndarray:
    """``weights`` scaled by one factor, held to ``cap``, so that tokens times weights come to ``wanted`` or as near as they can."""
    if wanted >= cap * tokens.sum():
        return np.full(len(tokens), cap, float)
    free, out = np.ones(len(tokens), bool), np.zeros(len(tokens))
    while free.any():
        rest = wanted - cap * tokens[~free].sum()
        base = (tokens[free] * weights[free]).sum()
        out[free] = weights[free] * (rest / base if base > 0 else 0)
        over = free & (out > cap)
        if not over.any():
            break
        out[over] = cap
        free &= ~over
    return out


def rake(tokens: np.ndarray, margins: list[tuple[np.ndarray, np.ndarray]], source: np.ndarray, shares: np.ndarray, caps: np.ndarray, total: float, rounds: int = ROUNDS) -> np.ndarray:
    """Iterative proportional fitting of cell weights; margins: (class of each cell, share of each class), the sources last."""
    w = np.ones(len(tokens))
    for _ in range(rounds):
        before = w
        for classes, wanted in margins:
            now = np.bincount(classes, tokens * w, len(wanted))
            w = np.minimum(w * np.divide(wanted * total, now, out=np.ones(len(wanted)), where=now > 0)[classes], caps[source])
        w = w.copy()
        for s in np.unique(source):
            own = source == s
            w[own] = fill(tokens[own], np.maximum(w[own], 1e-9), caps[s], shares[s] * total)
        if np.abs(w - before).max() < 1e-9:
            break
    return w


def fit(tokens: np.ndarray, source: np.ndarray, others: list[np.ndarray], shares: np.ndarray, caps: np.ndarray, least_total: float) -> Fit:
    """Weights for cells with ``tokens`` tokens of ``source`` and classes of the other dimensions."""
    have = np.bincount(source, tokens, len(shares))
    some = (have > 0) & (shares > 0)
    if not some.any():
        return Fit(np.zeros(len(tokens)), 0.0)
    total = max(float((have[some] * caps[some] / shares[some]).min()), least_total * float(have.sum()))
    total = min(total, float((have[some] * caps[some] / shares[some]).max()))
    margins = [(c, np.bincount(c, tokens) / tokens.sum()) for c in others]
    return Fit(rake(tokens, margins, source, shares, caps, total), total)


def mixed(sized: DataFrame, targets: DataFrame, least_total: float = 0.1, buckets: int = BUCKETS, seed: int = 7) -> DataFrame:
    """doc_id, source, tokens, repeats of every document used.

    sized: doc_id, source, lang, topic, tokens; targets: source, target_share, max_repeats, one row per source.
    """
    wanted = [(r.source, r.target_share, r.max_repeats) for r in targets.select(F.lower(F.trim("source")).alias("source"), "target_share", "max_repeats").limit(MOST_CELLS + 1).collect()]
    if len(wanted) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} targets")
    names = {s: i for i, (s, _, _) in enumerate(wanted)}
    pool = sized.withColumn("source", F.lower(F.trim("source"))).where(F.col("source").isin(list(names)) & (F.col("tokens") > 0))
    pool = cut_lineage(pool.select("doc_id", "source", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("topic", F.lit("")).alias("topic"), "tokens").distinct())
    cells = pool.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents")).limit(MOST_CELLS + 1).collect()
    buckets = max(buckets, sum(c.documents for c in cells) // PER_BUCKET)
    if len(cells) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} cells of source, language and topic")
    classes = [np.unique([c[k] for c in cells], return_inverse=True)[1] for k in ("lang", "topic")] if cells else []
    got = fit(
        np.array([c.tokens for c in cells], float), np.array([names[c.source] for c in cells], int), classes,
        np.array([t[1] for t in wanted], float), np.array([t[2] for t in wanted], float), least_total,
    )
    spark = sized.sparkSession
    weights = spark.createDataFrame([(c.source, c.lang, c.topic, float(w)) for c, w in zip(cells, got.weights)], "source string, lang string, topic string, weight double")
    # one row a cell: checked above
    known = pool.join(broadcast_if_small(weights)[0], ["source", "lang", "topic"]).withColumns({
        "class": F.floor(F.log2("tokens") * 4), "hash": F.xxhash64(F.lit(seed), "doc_id"), "whole": F.floor("weight"),
    }).withColumns({"rest": F.col("weight") - F.col("whole"), "bucket": F.pmod("hash", F.lit(buckets))})
    # rest parts run on from group to group; the groups' sums are few, the running sums within groups are short
    sums = known.groupBy("source", "class", "bucket").agg(F.sum("rest").alias("sum"))
    ahead = Window.partitionBy("source").orderBy("class", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("sum").over(ahead), F.lit(0.0)) + F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1000)) / 1000.0).drop("sum")
    within = Window.partitionBy("source", "class", "bucket").orderBy("hash", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    run = known.join(starts, ["source", "class", "bucket"]).withColumn("end", F.col("start") + F.sum("rest").over(within))
    repeats = F.col("whole") + F.floor("end") - F.floor(F.col("end") - F.col("rest"))
    return run.select("doc_id", "source", "tokens", repeats.cast("int").alias("repeats")).where("repeats > 0")


def shares(mix: DataFrame, sized: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, documents, tokens_available, tokens_taken, share, short: what was reached."""
    have = sized.groupBy(F.lower(F.trim("source")).alias("source")).agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens_available"))
    took = mix.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens_taken"))
    rows = targets.select(F.lower(F.trim("source")).alias("source"), "target_share", "max_repeats").join(have, "source", "left").join(took, "source", "left")
    rows = rows.fillna(0, ["documents", "tokens_available", "tokens_taken"])
    total = Window.partitionBy()  # one row per target
    rows = rows.withColumn("share", F.col("tokens_taken") / F.nullif(F.sum("tokens_taken").over(total), F.lit(0)))
    return rows.withColumn("short", F.coalesce(F.col("share"), F.lit(0.0)) < F.col("target_share") * 0.99)
