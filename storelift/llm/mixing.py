"""Mixing sources to target weights by iterative proportional fitting.

Built-in DataFrame functions only.  Documents are summed into cells of
(source, language, topic); the cells' token weights are raked in turn to the
source, language and topic targets until every marginal holds, or until sweeps
no longer bring them closer, as with targets that contradict each other (one
source per language); a document is then kept with its cell's calibrated
probability.  A cell's probability ends at 1, so the sample can miss targets
that the weights meet.  What remains of either deviation is logged as a warning.

Only the cell table is iterated over, by window sums that Spark partitions by
the raked dimension; a hot source is summed map-side before any shuffle.  The
texts are read in the cell sum and in the final pass and are never shuffled:
the cells join as whatever their size allows (broadcast below Spark's byte
threshold, else a shuffle join).

Defined cases: a null source or language counts as the empty name.  A null
or empty text has no tokens, no weight and probability 0.  Rows with the same
doc_id get the same draw.  An empty table gives an empty result.  Further
columns of the input pass through ``sample``; names that clash with the added
columns are not read.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

DIMENSIONS = ("source", "lang", "topic")
#: Default targets: each marginal's token share, flattened by this power.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
#: Share of all tokens that a sample holds in expectation.
KEEP_SHARE = 0.5
#: Sweeps between two convergence checks.
SWEEPS_PER_CHECK = 4
#: Targets contradict if between two checks the largest deviation falls by a smaller
#: part than the first value and no cell's weight grows by a larger part than the second.
LEAST_GAIN, LEAST_GROWTH = 1e-3, 1e-6
#: Largest accepted deviation of a marginal from its target share.
TOLERANCE = 1e-11

_log = logging.getLogger(__name__)


def token_count(text: Column) -> Column:
    """Number of words (runs outside ASCII white space)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def text_form(text: Column, n_tokens: Column) -> Column:
    """The default topic: the form of the text."""
    return (F.when(F.coalesce(F.contains(text, F.lit(" | ")), F.lit(False)), F.lit("table"))
             .when(n_tokens >= 1000, F.lit("long"))
             .when(n_tokens >= 200, F.lit("article"))
             .otherwise(F.lit("short")))


def uniform(doc_id: Column) -> Column:
    """A draw in [0, 1) fixed by the document's id: 52 bits of its MD5."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def cells_of(docs: DataFrame) -> DataFrame:
    """Token and document counts of each (source, lang, topic)."""
    return docs.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))


def rake(cells: DataFrame, powers: dict[str, float] = POWERS) -> DataFrame:
    """``cells`` with ``weight``, the raked token share of each cell.

    The target share of a marginal value is its token count to the power of
    ``powers[dimension]``, normalised.  Cells without tokens are left out.
    """
    cells = stored(cells.where("tokens > 0"), "mix-cells")
    for dim in DIMENSIONS:
        marginal = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), F.lit(powers[dim])).alias("_m"))
        total = marginal.agg(F.sum("_m")).first()[0] or 1.0
        cells = cells.join(marginal.select(F.col(dim), (F.col("_m") / F.lit(total)).alias(f"target_{dim}")), dim)
    cells = stored(cells.withColumn("weight", F.col("tokens").cast("double")), "mix-cells")
    before = float("inf")
    while True:
        cells = cells.withColumn("_before", F.col("weight"))
        for _ in range(SWEEPS_PER_CHECK):
            for dim in DIMENSIONS:
                cells = cells.withColumn("weight", F.col("weight") * F.col(f"target_{dim}")
                                         / F.sum("weight").over(Window.partitionBy(dim)))
        cells = stored(cells, "mix-cells")
        off = deviations(cells, F.col("weight"))
        worst = max(off.values())
        if worst <= TOLERANCE:
            return cells.drop("_before")
        growth = cells.where("_before > 0").agg(F.max(F.col("weight") / F.col("_before"))).first()[0] - 1
        if worst > before * (1 - LEAST_GAIN) and growth <= LEAST_GROWTH:
            _log.warning("mixing: targets not met by raking, largest deviation of a marginal share: %s", off)
            return cells.drop("_before")
        before = worst


def deviations(cells: DataFrame, amount: Column) -> dict[str, float]:
    """Largest deviation of a marginal's share of ``amount`` from its target, by dimension."""
    shares = cells.withColumn("_a", amount)
    total = shares.agg(F.sum("_a")).first()[0] or 1.0
    off = [shares.groupBy(dim).agg(F.abs(F.sum("_a") / F.lit(total) - F.first(f"target_{dim}")).alias("d")).agg(
        F.lit(dim).alias("dim"), F.coalesce(F.max("d"), F.lit(0.0)).alias("d")) for dim in DIMENSIONS]
    return {dim: d for dim, d in reduce(DataFrame.unionAll, off).collect()}


def probabilities(cells: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """``cells`` with ``probability`` = min(1, scale * weight / tokens).

    The scale solves: expected kept tokens = ``keep_share`` of all tokens.
    Starting from no cell at 1, the set of cells at 1 only grows, so the
    steps end after as many as there are distinct groups of capped cells;
    each is one small aggregate.
    """
    ratio = F.col("weight") / F.col("tokens")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    scale = keep_share * total
    while True:
        full = F.lit(scale) * ratio >= 1
        at_one, free = cells.agg(
            F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)).cast("double"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        step = (keep_share * total - at_one) / free if free > 0 else scale
        if step <= scale * (1 + 1e-15):
            break
        scale = step
    return cells.withColumn("probability", F.least(F.lit(1.0), F.lit(scale) * ratio))


def calibrated(cells: DataFrame, powers: dict[str, float] = POWERS, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Raked ``cells`` with ``probability``; warns when the expected sample misses its targets."""
    cells = probabilities(rake(cells, powers), keep_share)
    off = deviations(cells, F.col("probability") * F.col("tokens"))
    if max(off.values()) > 1e-9:
        _log.warning("mixing: largest deviation of a marginal share of the expected sample from its target: %s", off)
    return cells


def with_cell(docs: DataFrame) -> DataFrame:
    """Documents reduced to id, cell and token count."""
    n = token_count(F.col("text"))
    return docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
        n.alias("n_tokens"), text_form(F.col("text"), n).alias("topic"))


def mix(docs: DataFrame, powers: dict[str, float] = POWERS, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Every document with its cell, probability and draw.

    Returns doc_id, source, lang, topic, n_tokens, probability, sampled.
    """
    keyed = with_cell(docs)
    cells = calibrated(cells_of(keyed), powers, keep_share)
    p = F.coalesce("probability", F.lit(0.0))
    return (keyed.join(cells.select(*DIMENSIONS, "probability"), list(DIMENSIONS), "left")
                 .select("doc_id", "source", "lang", "topic", "n_tokens", p.alias("probability"),
                         (uniform(F.col("doc_id")) < p).alias("sampled")))


def sample(docs: DataFrame, powers: dict[str, float] = POWERS, keep_share: float = KEEP_SHARE) -> DataFrame:
    """The sampled rows of ``docs``, with the columns of ``docs``."""
    cells = calibrated(cells_of(with_cell(docs)), powers, keep_share)
    keys = cells.select(*[F.col(d).alias(f"_cell_{d}") for d in DIMENSIONS], F.col("probability").alias("_cell_p"))
    n = token_count(F.col("text"))
    here = {"source": F.coalesce("source", F.lit("")), "lang": F.coalesce("lang", F.lit("")), "topic": text_form(F.col("text"), n)}
    match = reduce(Column.__and__, [here[d] == F.col(f"_cell_{d}") for d in DIMENSIONS])
    return docs.join(keys, match).where(uniform(F.col("doc_id")) < F.col("_cell_p")).select(*docs.columns)
