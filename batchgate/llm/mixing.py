"""Mixing sources to target weights by entropy balancing, DataFrame functions only.

Each source gets a share of the token budget by its weight (water-filled
under a cap on repetition). Document rates r then minimise the relative
entropy  sum r log r - r + 1  over documents, subject to the token constraint
sum r * size = target of every source and to r <= cap. The convex dual has one
multiplier per source and gives exponentially tilted rates
r = min(cap, exp(lambda * c)), where c is the document's size over the
source's mean size. The multipliers are found by Newton steps (kept inside a
bracket by bisection); each step is one aggregate over the atoms of all
sources. Rates are then rounded into whole copies.

Atoms: rows are first combined into (source, size class) counts. A class is
one size up to 1,024 words; above it sizes share a class when their leading
ten bits agree, so a source has at most 512 classes an octave (some 16
thousand up to a billion words) however many documents it holds. All documents
of a class share one rate.

Rounding: over the classes of a source from large to small, copies are rounded
with the error carried on to the next class, so that a source misses its
target by about one small document. The copies of a class go to its documents
in hash order, in cells of about 1,024 documents, so a class that holds a third
of all rows is spread over many tasks. Documents of size 0 need no rank, and
rows of one id and size enter a cell as one counted row.

Defined results
  * NULL text has size 0; sizes of 0 take 0 words. A NULL source is a source
    of its own and sorts last; ids may be NULL or repeat (repeated rows are
    interchangeable). An empty table gives an empty result.
  * Reruns agree, however rows are dealt: sums are exact, ties are ordered by a
    hash of id and size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from batchgate.llm.common import word_count, written

KEY = ["src", "src_null"]
CELL = 1024
BLOCK = 10_000                      # rows that one counted row is opened into at a time
TOLERANCE = 1e-7
EXACT = "decimal(38,12)"            # sums that do not depend on the order of their terms
MAX_STEPS = 80


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source key, size and size class of every row (the only read of the texts)."""
    octave = "cast(floor(log2(size)) AS int) - 9"
    cls = f"CASE WHEN size <= 1024 THEN size ELSE shiftleft(shiftright(size, {octave}), {octave}) END"
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"),
                       F.col(source_col).isNull().alias("src_null"), word_count(F.col(text_col)).alias("size"))
    return written(rows.withColumn("cls", F.expr(cls).cast("long")), "mix_sizes")


def source_targets(atoms: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Tokens and target of every source.

    Water-filling in closed form: sources are ordered by cap * size / weight;
    those below the common level get their cap, the rest weight * level. The
    two windows run over one row per source, not over documents.
    """
    src = atoms.groupBy(*KEY).agg(F.sum("tokens").alias("tokens"), F.sum("n").alias("docs"))
    ordinal = F.row_number().over(W.orderBy("src_null", "src")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (ordinal % len(weights) + 1).cast("int"))
    src = src.withColumn("weight", weight).withColumn("most", F.col("tokens") * F.lit(float(cap)))
    every = W.partitionBy()
    filled = W.orderBy(F.col("most") / F.col("weight"), "src_null", "src").rowsBetween(W.unboundedPreceding, -1)
    src = src.withColumns({
        "ratio": F.col("most") / F.col("weight"),
        "level": ((F.sum("tokens").over(every) * F.lit(float(share)) - F.coalesce(F.sum("most").over(filled), F.lit(0.0)))
                  / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0)))),
    })
    # The first source (by ratio) that is not above its cap sets the level.
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(every)["level"]
    return (src.withColumn("tau", level)
               .withColumn("target", F.least("most", F.coalesce(F.col("weight") * F.col("tau"), F.col("most"))))
               .select(*KEY, "tokens", "docs", "target"))


def balance(atoms: DataFrame, targets: DataFrame, cap: float,
            tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS) -> DataFrame:
    """Newton's method on the dual: the multiplier of every source."""
    live = atoms.where("tokens > 0")
    low = live.groupBy(*KEY).agg(F.min("cls").alias("min_cls"), (F.sum("tokens") / F.sum("n")).alias("mean"))
    state = targets.where("tokens > 0").join(low, KEY).withColumns({
        "min_c": F.col("min_cls") / F.col("mean"), "ratio": F.col("target") / F.col("tokens")})
    # At `top` every document is at its cap; at `bottom` no document is above target / tokens.
    top = F.log(F.lit(float(cap))) / F.col("min_c")
    bottom = F.when(F.col("ratio") < 1, F.log("ratio") / F.col("min_c")).otherwise(0.0)
    full = F.col("ratio") >= F.lit(cap * (1 - 1e-12))
    state = written(state.select(*KEY, "tokens", "target", "mean",
                                 F.when(full, top).otherwise(bottom).alias("lo"), top.alias("hi"),
                                 F.when(full, top).otherwise(F.log("ratio")).alias("lam")), "mix_state")
    for _ in range(max_steps):
        c = F.col("cls") / F.col("mean")
        raw = F.exp(F.least(F.col("lam") * c, F.lit(50.0)))
        sums = (live.join(state.select(*KEY, "mean", "lam"), KEY)
                    .select(*KEY, (F.col("tokens") * F.least(raw, F.lit(float(cap)))).cast(EXACT).alias("f"),
                            F.when(raw < F.lit(float(cap)), F.col("tokens") * c * raw).otherwise(0.0).cast(EXACT).alias("h"))
                    .groupBy(*KEY).agg(F.sum("f").cast("double").alias("f"), F.sum("h").cast("double").alias("h")))
        step = state.join(sums, KEY).withColumn("gap", F.col("f") - F.col("target"))
        done = F.abs(F.col("gap")) <= F.col("target") * F.lit(tolerance)
        step = step.withColumns({"lo": F.when((F.col("gap") < 0) & ~done, F.col("lam")).otherwise(F.col("lo")),
                                 "hi": F.when((F.col("gap") > 0) & ~done, F.col("lam")).otherwise(F.col("hi"))})
        newton = F.when(F.col("h") > 0, F.col("lam") - F.col("gap") / F.col("h"))
        inside = newton.isNotNull() & (newton > F.col("lo")) & (newton < F.col("hi"))
        step = written(step.select(*KEY, "tokens", "target", "mean", "lo", "hi", done.alias("done"),
                                   F.when(done, F.col("lam")).when(inside, newton)
                                    .otherwise((F.col("lo") + F.col("hi")) / 2).alias("lam")), "mix_state")
        state = step.drop("done")
        if step.where(~F.col("done")).isEmpty():
            break
    return state.select(*KEY, "lam", "mean")


def copies_of_classes(atoms: DataFrame, targets: DataFrame, dual: DataFrame, cap: float) -> DataFrame:
    """Whole copies for every class, the rounding error carried from large to small sizes."""
    rate = F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * F.col("cls") / F.col("mean"), F.lit(50.0))))
    rated = atoms.where("tokens > 0").join(dual, KEY).withColumn("rate", rate)
    lists = (rated.groupBy(*KEY).agg(F.reverse(F.array_sort(F.collect_list(F.struct("cls", "n", "tokens", "rate")))).alias("a"))
                  .join(targets.select(*KEY, "target"), KEY))
    fold = f"""aggregate(a, named_struct('due', 0D, 'm', cast(array() AS array<bigint>)), (s, x) ->
        named_struct(
          'due', s.due + x.tokens * x.rate - x.tokens / x.n * least(floor({float(cap)}D * x.n),
                 greatest(0L, cast(round((s.due + x.tokens * x.rate) * x.n / x.tokens) AS bigint))),
          'm', concat(s.m, array(least(cast(floor({float(cap)}D * x.n) AS bigint),
                 greatest(0L, cast(round((s.due + x.tokens * x.rate) * x.n / x.tokens) AS bigint)))))))"""
    folded = lists.withColumn("m", F.expr(fold)["m"])
    pairs = folded.select(*KEY, F.explode(F.arrays_zip("a", "m")).alias("x"))
    return pairs.select(*KEY, F.col("x.a.cls").alias("cls"), F.col("x.a.n").alias("n"),
                        F.col("x.a.rate").alias("rate"), F.col("x.m").alias("m"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, size, source_size, target, rate, copies, taken."""
    rows = _sizes(docs, id_col, text_col, source_col)
    atoms = written(rows.groupBy(*KEY, "cls").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens")), "mix_atoms")
    targets = written(source_targets(atoms, weights, share, cap), "mix_targets")
    dual = balance(atoms, targets, cap)
    classes = written(copies_of_classes(atoms, targets, dual, cap), "mix_classes")

    t = targets.select(*KEY, F.col("tokens").alias("source_size"), "target")
    none = rows.where("size = 0").withColumns({"rate": F.lit(0.0), "copies": F.lit(0).cast("long")})
    dealt = _deal(rows.where("size > 0").join(classes, [*KEY, "cls"])).unionByName(none.select(*KEY, "id", "size", "rate", "copies"))
    return dealt.join(t, KEY).select("id", "size", "source_size", F.col("target").cast("double").alias("target"), "rate",
                                     "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _deal(rows: DataFrame) -> DataFrame:
    """Copies of a class to its documents: in cells by hash, those first in hash
    order get one more. Rows of one id and size are interchangeable; they enter
    a cell as one counted row, so ids that repeat (or lack) make no cell larger."""
    same = [*KEY, "cls", "id", "size"]
    j = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("c"), *[F.first(x).alias(x) for x in ("n", "m", "rate")])
    h = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), "size")
    j = j.withColumns({"h": h, "cells": F.ceil(F.col("n") / CELL)}).withColumn("cell", F.pmod("h", "cells"))
    cell = W.partitionBy(*KEY, "cls", "cell")
    base = F.floor(F.col("m") / F.col("n"))
    phase = F.when(F.col("cells") == 1, 0.5).otherwise(
        F.pmod(F.xxhash64("src", "cls", "cell"), F.lit(1 << 20)) / float(1 << 20))
    quota = F.floor((F.col("m") - base * F.col("n")) / F.col("n") * F.sum("c").over(cell) + phase)
    before = F.sum("c").over(cell.orderBy("h", "id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("c")
    more = F.least(F.col("c"), F.greatest(F.lit(0).cast("long"), quota - before))
    j = j.select(*KEY, "id", "size", "rate", "c", base.alias("base"), more.alias("more"))
    one = j.where("c = 1").select(*KEY, "id", "size", "rate", (F.col("base") + F.col("more")).cast("long").alias("copies"))
    # Counted rows become rows again, a block at a time; blocks are dealt before they are opened.
    blocks = j.where("c > 1").withColumn("b", F.explode(F.expr(f"sequence(0L, (c - 1) div {BLOCK}L)")))
    blocks = blocks.repartition(*KEY, "id", "size", "b").withColumn(
        "i", F.explode(F.expr(f"sequence(b * {BLOCK}L, least(c, (b + 1) * {BLOCK}L) - 1)")))
    many = blocks.select(*KEY, "id", "size", "rate",
                         (F.col("base") + F.when(F.col("i") < F.col("more"), 1).otherwise(0)).cast("long").alias("copies"))
    return one.unionByName(many)
