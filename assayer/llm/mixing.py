"""Mixing sources to target weights by entropy balancing.

Every source has a token target. Among all document rates that meet the targets, entropy balancing takes the ones
closest in relative entropy to "each document once", capped at ``most`` copies. They are exponentially tilted: within a
source with multiplier lambda, a document of size c has the rate min(most, exp(lambda * c / mean size)). The multipliers
solve the convex dual, which falls apart by source; safeguarded Newton steps run for all sources at once, each step being
one aggregation over a histogram of (source, size). The rates are then rounded into whole copies.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import reachable, text_or_empty, words_of, written

#: Newton steps stop when every source is this near its target (words, and share of the target).
NEAR_WORDS, NEAR_SHARE = 0.5, 1e-9
#: Steps after which the multipliers are taken as they are; bisection alone has then used up a double's precision.
MOST_STEPS = 80
#: A class of equally long documents of a source is split beyond this many rows.
CLASS_ROWS = 1_000


def word_count(text: str = "text") -> Column:
    return F.size(words_of(text_or_empty(text))).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``_key, source_size, target`` of a table of ``_key, source_size``.

    Keys in code-point order take ``weights`` in turn. All together get ``share`` of all sizes; what a source would get
    beyond ``most`` times its own size goes to the others by weight, until none is above.
    """
    # One row per source: numbering them needs one task, which never sees documents.
    turn = (F.row_number().over(Window.orderBy("_key")) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    weighted = written(sizes.withColumn("_weight", weight), "mix-sources")
    limit = F.col("source_size") * F.lit(float(most))
    level, before = 0.0, None
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    # Per round two sums reach the driver. The level only rises, and each round but the last caps one more source.
    while level != before:
        before = level
        full = limit <= F.col("_weight") * F.lit(before)
        capped, open_weight = weighted.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("_weight")))).first()
        if open_weight:
            level = max(before, (share * total - (capped or 0.0)) / open_weight)
    return weighted.select("_key", "source_size", F.least(limit, F.col("_weight") * F.lit(level)).alias("target"))


def _next_multiplier(most: float) -> dict[str, Column]:
    """The state after one Newton step, from the current state and the sums ``_mass`` and ``_slope``."""
    over = F.col("_mass") - F.col("target")
    low = F.when(over < 0, F.col("_lambda")).otherwise(F.col("_low"))
    high = F.when(over > 0, F.col("_lambda")).otherwise(F.col("_high"))
    reach = F.greatest(F.lit(1.0), F.abs("_lambda"))
    newton = F.col("_lambda") - F.greatest(-reach, F.least(reach, over / F.col("_slope")))
    inside = (F.col("_slope") > 0) & (newton > F.col("_newlow")) & (newton < F.col("_newhigh"))
    middle = (
        F.when(F.col("_newhigh") == F.lit(float("inf")), F.col("_newlow") + reach)
        .when(F.col("_newlow") == F.lit(float("-inf")), F.col("_newhigh") - reach)
        .otherwise((F.col("_newlow") + F.col("_newhigh")) / 2)
    )
    near = F.abs(over) <= F.greatest(F.lit(NEAR_WORDS), F.col("target") * NEAR_SHARE)
    return {
        "_done": F.col("_done") | near,
        "_newlow": low,
        "_newhigh": high,
        "_step": F.when(F.col("_done") | near, F.col("_lambda")).when(inside, newton).otherwise(middle),
    }


def multipliers(histogram: DataFrame, targets: DataFrame, most: float) -> DataFrame:
    """``_key, source_size, target, _mean, _lambda`` from the histogram ``_key, size, n`` and the targets."""
    means = histogram.groupBy("_key").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("_mean"))
    # A target of all copies (or of nothing) needs no solving: the rate is then the limit itself.
    filled = F.col("target") >= F.col("source_size") * F.lit(float(most) * (1 - 1e-12))
    state = written(
        targets.join(means, "_key").select(
            "_key",
            "source_size",
            "target",
            "_mean",
            F.when(filled, F.lit(float("inf"))).otherwise(F.lit(0.0)).alias("_lambda"),
            F.lit(float("-inf")).alias("_low"),
            F.lit(float("inf")).alias("_high"),
            filled.alias("_done"),
        ),
        "mix-state",
    )
    for _ in range(MOST_STEPS):
        if not state.filter(~F.col("_done")).limit(1).count():
            break
        part = F.col("size") / F.col("_mean")
        rate = F.exp(F.col("_lambda") * part)
        words = F.col("n") * F.col("size")
        sums = (
            histogram.join(state.filter(~F.col("_done")).select("_key", "_mean", "_lambda"), "_key")
            .groupBy("_key")
            .agg(
                F.sum(words * F.least(F.lit(float(most)), rate)).alias("_mass"),
                F.sum(F.when(rate < F.lit(float(most)), words * part * rate).otherwise(F.lit(0.0))).alias("_slope"),
            )
        )
        step = _next_multiplier(most)
        moved = state.join(sums, "_key", "left").withColumns({k: step[k] for k in ("_newlow", "_newhigh")})
        state = written(
            moved.select(
                "_key",
                "source_size",
                "target",
                "_mean",
                F.when(F.col("_done"), F.col("_lambda")).otherwise(step["_step"]).alias("_lambda"),
                F.col("_newlow").alias("_low"),
                F.col("_newhigh").alias("_high"),
                step["_done"].alias("_done"),
            ),
            "mix-state",
        )
    return state.select("_key", "source_size", "target", "_mean", "_lambda")


def _whole_copies(rates: pd.DataFrame, most: int) -> pd.DataFrame:
    """Copies for each class of one source, the longest documents first; what a class rounds off goes to the next."""
    rates = rates.sort_values("size", ascending=False)
    size, n, rate = (rates[c].to_numpy(float) for c in ("size", "n", "_rate"))
    carried, copies = 0.0, np.zeros(len(rates), dtype=np.int64)
    for i in range(len(rates)):
        wanted = n[i] * rate[i] + (carried / size[i] if size[i] else 0.0)
        copies[i] = min(most * n[i], max(0.0, round(wanted)))
        carried += (n[i] * rate[i] - copies[i]) * size[i]
    return pd.DataFrame({"_key": rates["_key"], "size": rates["size"], "n": rates["n"], "_rate": rates["_rate"], "_copies": copies})


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: int = 2,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, copies, rate``.

    ``size`` is the number of words (0 for a null text), ``target`` the words its source is to give, ``copies`` (0 to
    ``most``) how often the document is taken and ``taken`` = size * copies. A source misses its target by no more
    than about half its shortest document, unless rates at the limits leave no room or a few documents are most of the
    source: documents are taken whole. Documents of the same source and
    size share a rate; which of them get one copy more is settled by a hash of ``key``, so reruns agree.

    Null sources are one source, the last. Repeated rows count as rows of their own. Documents without words are taken
    once and count nothing. Columns other than the three named are ignored. An empty table gives an empty result.
    """
    return mixed_rows(docs, weights, share, most, key, text, source).drop("_key", "text_hash")


def taken_copies(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: int = 2,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with all its columns."""
    counted = mixed_rows(docs, weights, share, most, key, text, source).groupBy("doc_id", "text_hash", "_key")
    counted = written(counted.agg(F.sum("copies").alias("taken"), F.count(F.lit(1)).alias("times")), "mix-copies")
    # Rows travel as one struct, so that their column names clash with nothing.
    rows = docs.select(
        F.struct("*").alias("row"), F.col(key).alias("of"), F.xxhash64(F.col(text).cast("string")).alias("hash"), source_key(source).alias("from")
    )
    same = F.col("of").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")) & (F.col("from") == F.col("_key"))
    taken = rows.join(counted.filter(F.col("taken") > 0), same)
    once = taken.filter(F.col("times") == 1)
    if not counted.filter(F.col("times") > 1).isEmpty():
        # Rows repeated with id, text and source share their copies.
        once = once.unionByName(taken.filter(F.col("times") > 1).dropDuplicates(["doc_id", "text_hash", "_key"]))
    return once.select("row", F.explode(F.sequence(F.lit(1), F.col("taken").cast("int")))).select("row.*")


def source_key(source: str) -> Column:
    """One non-null key in the order of code points, null last."""
    name = F.col(source).cast("string")
    return F.when(name.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), name))


def mixed_rows(
    docs: DataFrame,
    weights: tuple[float, ...],
    share: float,
    most: int,
    key: str,
    text: str,
    source: str,
) -> DataFrame:
    """The rows of ``mix`` with ``_key``, the source's key, and ``text_hash``, the hash of the text as it stands."""
    plain = docs.select(
        F.col(key).alias("doc_id"),
        source_key(source).alias("_key"),
        F.xxhash64(F.col(text).cast("string")).alias("text_hash"),
        word_count(text).alias("size"),
        F.xxhash64(F.col(key)).alias("_hash"),
    )
    sized = written(plain, "mix-sizes")
    histogram = written(sized.groupBy("_key", "size").agg(F.count(F.lit(1)).alias("n")), "mix-histogram")
    totals = histogram.groupBy("_key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    solved = written(multipliers(histogram, source_targets(totals, weights, share, most), most), "mix-multipliers")
    tilt = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(float(most)), F.exp(F.col("_lambda") * F.col("size") / F.col("_mean")))
    )
    rates = histogram.join(solved, "_key").select("_key", "size", "n", tilt.alias("_rate"))
    reachable(docs.sparkSession)
    classes = written(
        rates.groupBy("_key").applyInPandas(
            lambda group: _whole_copies(group, most), "_key string, size bigint, n bigint, _rate double, _copies bigint"
        ),
        "mix-classes",
    )
    # The base copies go to all of a class, the rest to the first by hash. Large classes are cut into even parts whose
    # own rest is rounded by a fixed fraction for each part.
    parts = F.ceil(F.col("n") / CLASS_ROWS).cast("bigint")
    placed = sized.join(classes, ["_key", "size"]).withColumn("_part", F.when(parts <= 1, 0).otherwise(F.pmod("_hash", parts)))
    part = Window.partitionBy("_key", "size", "_part")
    at = F.row_number().over(part.orderBy("_hash", "doc_id"))
    here = F.count(F.lit(1)).over(part)
    base = F.floor(F.col("_copies") / F.col("n"))
    rest = F.col("_copies") - base * F.col("n")
    dither = F.pmod(F.xxhash64("_key", "size", "_part"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    quota = F.when(F.col("n") == here, rest).otherwise(F.floor(rest * here / F.col("n") + dither))
    copies = (base + F.when(at <= quota, 1).otherwise(0)).cast("bigint")
    return (
        placed.withColumn("copies", copies)
        .join(solved.select("_key", "source_size", "target"), "_key")
        .select(
            "doc_id",
            "size",
            F.col("source_size").cast("bigint").alias("source_size"),
            "target",
            (F.col("size") * F.col("copies")).alias("taken"),
            "copies",
            F.col("_rate").alias("rate"),
            "_key",
            "text_hash",
        )
    )
