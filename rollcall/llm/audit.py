"""Interaction of filters by path counting over the lattice of filter sets.

A document is described by the set of filters that it fails, and a part by the
number of its documents per such set. The states of the lattice are the sets of
filters already applied; an edge applies one more. What an edge removes, leaves
and meets again follows from the counts alone, so every order of the filters is
read from the same edges, without looking at documents again. The orders that
reach a state are counted forward from the empty set and those that leave it
backward from the full one; an edge lies on (reaching its start) x (leaving its
end) orders, which is its weight in the sum over all orders.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import discard, staged

#: Fixed: what counts as white space between words.
SPACE = r"[\x20\x09-\x0D]+"


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """Per state (a set of the ``n`` filters as bits): the number of orders of
    its own filters, and of the filters that are still to come."""
    full = (1 << n) - 1
    reaching, leaving = [0] * (full + 1), [0] * (full + 1)
    reaching[0] = leaving[full] = 1
    for state in range(full + 1):
        for f in range(n):
            if not state >> f & 1:
                reaching[state | 1 << f] += reaching[state]
    for state in range(full, -1, -1):
        for f in range(n):
            if not state >> f & 1:
                leaving[state] += leaving[state | 1 << f]
    return reaching, leaving


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that need only the text: under 50 words; fewer than
    65 distinct words in 100; over 5 capitals A-Z in 100 characters; a listed
    sign."""
    words = F.array_remove(F.split(text, SPACE), "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)) * 100 < n * 65,
        "C": capitals * 100 > F.length(text) * 5,
        "D": text.rlike(r"[#$%&*|]"),
    }


def failures(df: DataFrame, part_column: str = "source") -> DataFrame:
    """``content, doc_id, part, mask, n``: the rows of ``df`` with the SHA-256
    of their text and the set of text filters that it fails (bit i: the filter
    of that place)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    conditions = text_filters(F.col("text"))
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions.values())), F.lit(0))
    rows = (
        df.select("doc_id", text.alias("text"), F.coalesce(F.col(f"`{part_column}`").cast("string"), F.lit("")).alias("part"))
        .select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("content"))
    )
    return rows.groupBy("content", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))


def failure_counts(failed: DataFrame, labels: DataFrame, repeats: int = 4) -> DataFrame:
    """``part, mask, n, good, toxic``: documents per part and set of failed
    filters, where bit ``repeats`` says that some smaller id has the same text.

    Texts are here as their SHA-256 only. Rows are added up before each shuffle,
    the smallest id of a text is a partial aggregate, and it is joined on (text,
    id), so a text, a part or an id with a third of the rows is in no one task.
    """
    first = failed.groupBy("content").agg(F.min("doc_id").alias("doc_id")).where(F.col("doc_id").isNotNull())
    # a row without id has no smaller id, and is none
    again = F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), F.lit(1 << repeats)).otherwise(F.lit(0))
    marked = failed.join(first.withColumn("first", F.lit(True)), ["content", "doc_id"], "left")
    marked = marked.withColumn("mask", F.col("mask") + again).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))

    def has(column: str) -> Column:
        return F.max(F.when(F.col(column) == 1, F.lit(1)).otherwise(F.lit(0))).alias(column)

    known = labels.where(F.col("doc_id").isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
    known = known.groupBy("doc_id").agg(has("quality"), has("toxic"))
    n = F.col("n")
    return (
        marked.join(known, "doc_id", "left").groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), F.sum(F.coalesce("quality", F.lit(0)) * n).alias("good"),
             F.sum(F.coalesce("toxic", F.lit(0)) * n).alias("toxic"))
    )


def lattice_edges(counts: DataFrame, letters: str) -> DataFrame:
    """Per part one row per edge (``state``, ``filter``): ``kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, weight``."""
    size = len(letters)
    reaching, leaving = path_counts(size)
    edges = [(state, f, reaching[state] * leaving[state | 1 << f])
             for state in range(1 << size) for f in range(size) if not state >> f & 1]
    edge = F.explode(F.array(*[F.struct(F.lit(s).alias("state"), F.lit(1 << f).alias("bit"), F.lit(letters[f]).alias("filter"),
                                        F.lit(w).cast("long").alias("weight")) for s, f, w in edges]))
    rows = counts.withColumn("edge", edge).select("part", "mask", "n", "good", "toxic", "edge.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("state")) != 0

    def total(when: Column, value: str, name: str) -> Column:
        return F.sum(F.when(when, F.col(value)).otherwise(F.lit(0))).cast("long").alias(name)

    return rows.groupBy("part", "state", "filter", "weight").agg(
        total(~fails & ~gone, "n", "kept"), total(fails & ~gone, "n", "removed"), total(fails & gone, "n", "redundant"),
        total(F.col("mask") == F.col("bit"), "n", "unique_fails"),
        total(fails & ~gone, "good", "good_lost"), total(fails & ~gone, "toxic", "toxic_lost"))


def read_orders(edges: DataFrame, letters: str) -> DataFrame:
    """A row per part, order and step, each read from its edge; ``shapley`` is
    the filter's edges' removals by their weights."""
    size = len(letters)
    steps = []
    for order in permutations(range(size)):
        state = 0
        for step, f in enumerate(order, 1):
            steps.append((state, letters[f], "".join(letters[g] for g in order), step))
            state |= 1 << f
    # as many rows as the filters have orders and steps, whatever the data
    on_edge = edges.sparkSession.createDataFrame(steps, "state int, filter string, filter_order string, step int")
    over = edges.groupBy("part", "filter").agg(F.sum(F.col("weight") * F.col("removed")).alias("shapley"))
    return (
        edges.join(over, ["part", "filter"]).join(F.broadcast(on_edge), ["state", "filter"])
        .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    )


def audit_filters(df: DataFrame, labels: DataFrame, part_column: str = "source") -> DataFrame:
    """Five filters applied in all 120 orders, per part: ``part, filter_order,
    step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley`` (see :func:`text_filters`; E: some smaller id has the same text).

    ``part`` is the source, the empty string for null. A null text counts as
    empty; equal rows count one each, and a row without id never fails E and
    makes no other fail it. An id with several label rows is good or toxic if
    one of them says so. An empty table gives no rows. Other columns are not
    read.
    """
    letters = "ABCDE"
    failed = staged(failures(df, part_column), "audit-failures")
    edges = staged(lattice_edges(failure_counts(failed, labels), letters), "audit-edges")
    discard(failed)
    return read_orders(edges, letters)
