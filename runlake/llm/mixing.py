"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents are summed into cells, one per combination of the marginal columns (source,
language, topic). Each round scales the cells' token weights to the target shares of one
marginal after the other, until all hold at once. A document's probability is its cell's
fitted weight over its own weight, times one constant, so a sample by these
probabilities has the target shares in expectation. The constant is the largest
that leaves no probability above 1, or less for a smaller ``budget``.

The cells are a small table beside the documents, but no bound is assumed: they are
reduced and joined as tables, each round is written to the shared folder, and only the
largest deviation reaches the driver. Spark broadcasts the cells to the documents if
their measured size allows.

Defined cases: NULL is a value of its own in every marginal. A NULL or empty text weighs
nothing; a cell that weighs nothing keeps probability 1 times the constant. A value without a target keeps its
share. A draw depends on ``doc_id`` and seed only, so rows that repeat a ``doc_id`` in one cell share
their fate, and NULL is one such ``doc_id``. Further columns pass through. An empty table
gives an empty result.
"""

from pyspark.sql import Column, DataFrame, functions as F

from runlake.session import materialize

ROUNDS, TOLERANCE = 50, 1e-4


def tokens(text: Column) -> Column:
    """About four bytes a token."""
    return F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4).cast("double")


def topic(text: Column) -> Column:
    """A coarse topic of a text by what it holds."""
    return (F.when(text.contains(" | "), "table").when(text.rlike("[#$%&*!]{2}"), "noise")
            .when(text.rlike("[Ll]icen[cs]e"), "licence").when(text.rlike("@|[0-9]{3}"), "contact").otherwise("prose"))


def _value(c: Column) -> Column:
    return F.when(c.isNull(), "n").otherwise(F.concat(F.lit("v"), c.cast("string")))


def tempered(cells: DataFrame, column: str, power: float) -> DataFrame:
    """(value, share) targets: the present shares raised to ``power`` below 1, which lifts small values."""
    by = cells.groupBy(F.col(column).alias("value")).agg(F.sum("weight").alias("s")).filter("s > 0")
    raised = F.pow("s", F.lit(power))
    total = by.agg(F.sum(raised)).first()[0] or 1.0
    return by.select("value", (raised / total).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` (marginal columns, weight) with ``fitted``, the weights scaled to every target (value, share)."""
    total = cells.agg(F.sum("weight")).first()[0] or 0.0
    # Targets stand beside the cells from the start: every join is a table broadcast, so made at the driver, in every round.
    aimed = cells.withColumn("fitted", F.col("weight"))
    for i, (column, target) in enumerate(targets.items()):
        goal = target.filter("share > 0").select(F.col("value").alias(column), F.col("share").alias(f"share_{i}"))
        aimed = aimed.join(goal, column, "left")
    now = materialize(aimed, "cells")
    for _ in range(ROUNDS):
        step, drift = now, F.lit(0.0)
        for i, column in enumerate(targets):
            have = step.groupBy(column).agg(F.sum("fitted").alias("have"))
            scale = F.when((F.col("have") > 0) & F.col(f"share_{i}").isNotNull(), F.col(f"share_{i}") * total / F.col("have")).otherwise(1.0)
            step = step.join(have, column).withColumn(f"scale_{i}", scale).withColumn(
                "fitted", F.col("fitted") * F.col(f"scale_{i}")).drop("have")
            drift = F.greatest(drift, F.abs(F.col(f"scale_{i}") - 1))
        done = materialize(step.withColumn("drift", drift), "cells")
        worst = done.filter("weight > 0").agg(F.max("drift")).first()[0]
        now = done.select(*now.columns)
        if worst is None or worst < TOLERANCE:
            break
    return now.select(*cells.columns, "fitted")


def mix(docs: DataFrame, marginals: dict[str, Column], powers: dict[str, float] | None = None,
        targets: dict[str, DataFrame] | None = None, budget: float = 1.0, seed: int = 17) -> DataFrame:
    """(row, weight, probability, draw, kept) of every row of ``docs``; ``row`` holds all its columns.

    Targets are given as (value, share) per marginal, NULL as value 'n' and any other
    with a 'v' before it, or made by raising present shares to ``powers``. ``budget`` is the largest share of all
    tokens to keep.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id"),
                       *[_value(c).alias(f"m_{name}") for name, c in marginals.items()], tokens(F.col("text")).alias("weight"))
    names = [f"m_{name}" for name in marginals]
    cells = materialize(rows.groupBy(*names).agg(F.sum("weight").alias("weight")), "cells")
    goals = {f"m_{name}": tempered(cells, f"m_{name}", p) for name, p in (powers or {}).items()}
    goals |= {f"m_{name}": t for name, t in (targets or {}).items()}
    fitted = rake(cells, goals).withColumn("lift", F.when(F.col("weight") > 0, F.col("fitted") / F.col("weight")).otherwise(1.0))
    most = fitted.agg(F.max("lift")).first()[0] or 1.0
    chance = F.least(F.lit(1.0), F.col("lift") * min(budget, 1 / most))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) / F.lit(float(1 << 53))
    joined = rows.join(fitted.select(*names, chance.alias("probability")), names)
    return joined.select("row", "weight", "probability", draw.alias("draw"), (draw < F.col("probability")).alias("kept"))
