"""Mixing sources to target weights: budgets met by subset sums over document lengths.

Each source gets a target: its weight's share of a total budget, at most
``max_repeats`` times its own size, the excess dealt again by weight (water-filling).
A target is met with copies of whole documents: full rounds of the source, then a
subset whose lengths add up to the rest. The subset is found on counts of documents
by exact length, by a bounded-knapsack dynamic program; of budgets over KNAPSACK_WORDS
an even share of each length is taken first, and the program fits what remains. Documents of a length
are taken in order of a seeded hash.

Sizes are numbers of ``[^\\x20\\x09-\\x0D]+`` words; null and empty texts have size 0 and
are never taken. A null source is a source of its own, after all others. Rows that
repeat are separate documents, and of rows of equal id the text decides the order. A source whose documents are all empty has target 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.common import quoted, written

#: Words of budget that the dynamic program covers, and bytes of sums within which it covers any budget.
KNAPSACK_WORDS, KNAPSACK_BYTES = 1 << 16, 1 << 27
#: Documents of one source and size that are ranked together.
RANKED_TOGETHER = 4096


def words(text: str | Column) -> Column:
    """Number of words between ASCII white space."""
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """(source, source_size, target): weights repeat over the sources in code-point order, null last.

    A source is full below a level of budget a weight; the level solves
    sum(min(weight * level, cap)) = budget and is found from running sums in order of cap / weight.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int") + 1)
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source")).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    s = s.withColumn("full", F.coalesce(F.sum("cap").over(by_level), F.lit(0.0))).withColumn("open", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(by_level), F.lit(0.0)))
    # the level if exactly the sources before this one were full; the first source that it leaves below its cap has the right one
    s = s.withColumn("level", (F.col("budget") - F.col("full")) / F.col("open"))
    level = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "level"))).over(everything)["level"]
    s = s.withColumn("target", F.coalesce(F.least(F.col("w") * level, "cap"), F.col("cap")))
    return s.select("source", "source_size", "target")


def fit_counts(lengths: np.ndarray, counts: np.ndarray, target: int) -> np.ndarray:
    """How many documents of each length to take (at most counts) so that their words come nearest to target.

    The dynamic program covers a budget of KNAPSACK_WORDS exactly, and a larger one if its sums take no more than KNAPSACK_BYTES
    (few lengths). Else an even share of each length, then the longest that fit, are taken first, and it covers what remains.
    """
    lengths, counts = lengths.astype(np.int64), np.where(lengths > 0, counts, 0).astype(np.int64)
    total = int((lengths * counts).sum())
    target = max(0, min(int(target), total))
    take = np.zeros_like(counts)
    left = target
    if target > KNAPSACK_WORDS and target / 4 * np.ceil(np.log2(counts + 1)).sum() > KNAPSACK_BYTES:
        take = np.minimum(counts, (counts * ((target - KNAPSACK_WORDS // 2) / total)).astype(np.int64))
        left = target - int((lengths * take).sum())
        for k in np.argsort(-lengths, kind="stable"):
            if left <= KNAPSACK_WORDS:
                break
            more = min(int(counts[k] - take[k]), (left - KNAPSACK_WORDS // 2) // max(1, int(lengths[k])))
            if more > 0 and lengths[k] > 0:
                take[k] += more
                left -= more * int(lengths[k])
    return take + nearest_sum(lengths, counts - take, left)


def nearest_sum(lengths: np.ndarray, counts: np.ndarray, goal: int) -> np.ndarray:
    """A bounded knapsack: the choice whose sum is nearest to goal, of two equally near the lower one.

    Sums are bits of one number, up to twice the goal (a sum beyond that is further off than none). A count is split into
    powers of two and a rest, so each length shifts the bits a few times; the program stops when the goal is reached.
    """
    mask = (1 << (2 * goal + 1)) - 1
    reached, steps = 1, []
    for place in np.argsort(-lengths, kind="stable"):
        n, c, k = int(lengths[place]), int(counts[place]), 1
        while n > 0 and c > 0 and not reached >> goal & 1:
            k = min(k, c)
            after = reached | (reached << (n * k)) & mask
            if after != reached:
                steps.append((reached, int(place), n, k))
            reached, c, k = after, c - k, 2 * k
    low = (reached & ((1 << (goal + 1)) - 1)).bit_length() - 1
    above = reached >> (goal + 1)
    high = goal + (above & -above).bit_length() if above else None
    best = high if high is not None and high - goal < goal - low else low
    take = np.zeros(len(lengths), np.int64)
    for before, place, n, k in reversed(steps):
        if not before >> best & 1:
            take[place] += k
            best -= n * k
    return take


def plan_copies(docs: DataFrame, size: Column, doc_id: str = "doc_id", source: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2, seed: int = 17, text: str = "text") -> DataFrame:
    """(row, source, size, source_size, target, copies): each document as the struct ``row`` and how often the mix takes it.

    Of the documents of one source and size the first in the order of two hashes are taken once more. Only the
    hashes are ranked; the documents themselves are compared with the last pair of hashes taken, one row for each source and size.
    """
    lucky = [F.xxhash64(F.lit(seed + k), F.col(quoted(doc_id)), F.col(quoted(text))) for k in (0, 1)]
    columns = [F.col(quoted(source)).cast("string").alias("source"), size.cast("long").alias("size"), lucky[0].alias("h"), lucky[1].alias("h2")]
    narrow = written(docs.select(*columns), "sizes")
    histogram = narrow.groupBy("source", "size").agg(F.count("*").alias("n"))
    targets = source_targets(histogram.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, max_repeats)
    plan = histogram.alias("h").join(targets.alias("t"), F.col("h.source").eqNullSafe(F.col("t.source"))).select("t.source", "source_size", "target", "size", "n")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        # one row for each length of a source, so the group is bounded by the longest text, not by the documents
        pdf = pdf.sort_values("size", kind="stable")
        own, goal = int(pdf["source_size"].iloc[0]), round(float(pdf["target"].iloc[0]))
        rounds = min(goal // own, max_repeats) if own else 0
        more = fit_counts(pdf["size"].to_numpy(), pdf["n"].to_numpy(), goal - rounds * own) if rounds < max_repeats else np.zeros(len(pdf), np.int64)
        return pdf.assign(rounds=rounds, more=more)[["source", "source_size", "target", "size", "n", "rounds", "more"]]

    schema = "p_source string, source_size long, target double, p_size long, n long, rounds long, more long"
    plan = written(plan.groupBy("source").applyInPandas(lambda pdf: fit(pdf).set_axis(["p_source", "source_size", "target", "p_size", "n", "rounds", "more"], axis=1), schema), "plan")
    of_plan = F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size"))
    # ranges of hashes of bounded size are ranked one by one, so that a hot size is no single task
    ranges = F.floor(F.col("n") / RANKED_TOGETHER) + 1
    spread = F.least(F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * ranges), ranges - 1)
    open_ = narrow.join(plan.filter("more > 0 and more < n"), of_plan).select("source", "size", "h", "h2", "more", spread.alias("range"))
    before = Window.partitionBy("source", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counted = open_.groupBy("source", "size", "range").agg(F.count("*").alias("here"), F.first("more").alias("more"))
    # the range in which the last document is taken
    quota = counted.withColumn("quota", F.col("more") - F.coalesce(F.sum("here").over(before), F.lit(0))).filter("quota > 0 and quota <= here")
    quota = quota.select(F.col("source").alias("q_source"), F.col("size").alias("q_size"), F.col("range").alias("q_range"), "quota")
    last = open_.join(quota, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("size") == F.col("q_size")) & (F.col("range") == F.col("q_range")))
    w = Window.partitionBy("source", "size", "range").orderBy("h", "h2")
    last = last.withColumn("place", F.row_number().over(w)).withColumn("rank", F.rank().over(w)).filter(F.col("place") == F.col("quota"))
    last = last.select(F.col("source").alias("l_source"), F.col("size").alias("l_size"), F.col("h").alias("last_h"), F.col("h2").alias("last_h2"), (F.col("quota") - F.col("rank") + 1).alias("ties"))
    cuts = written(plan.join(last, F.col("p_source").eqNullSafe(F.col("l_source")) & (F.col("p_size") == F.col("l_size")), "left").drop("l_source", "l_size"), "cuts")
    tied = (F.col("h") == F.col("last_h")) & (F.col("h2") == F.col("last_h2"))
    sized = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), *columns).join(cuts, of_plan)
    taken = F.when(F.col("last_h").isNull(), F.col("more") > 0).otherwise((F.col("h") < F.col("last_h")) | ((F.col("h") == F.col("last_h")) & (F.col("h2") < F.col("last_h2"))) | F.coalesce(tied & (F.col("place") <= F.col("ties")), F.lit(False)))
    # rows that are equal in id and text to the last one taken are numbered, if there is more than one anywhere
    equal = narrow.join(cuts.filter("last_h is not null"), of_plan & tied).groupBy("p_source", "p_size").agg(F.count("*").alias("c")).filter("c > 1")
    if equal.head(1):
        held = F.coalesce(tied, F.lit(False))
        numbered = sized.filter(held).withColumn("place", F.row_number().over(Window.partitionBy("source", "size", "h", "h2").orderBy(F.lit(1))))
        sized = sized.filter(~held).withColumn("place", F.lit(1)).unionByName(numbered)
    else:
        sized = sized.withColumn("place", F.lit(1))
    copies = F.col("rounds") + F.when(taken, 1).otherwise(0)
    return sized.select("row", "source", "size", "source_size", "target", copies.alias("copies"))


def mix_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken): one row for each document; taken is its size times its copies."""
    narrow = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(source)).alias("source"), words(F.col(quoted(text))).alias("size"), F.xxhash64(F.col(quoted(text))).alias("text"))
    plan = plan_copies(narrow, F.col("size"), **options)
    return plan.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that the mix takes, with their own columns, each as often as it is taken."""
    plan = plan_copies(docs, words(F.col(quoted(text))), text=text, **options)
    return plan.select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")
