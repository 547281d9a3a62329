"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; ``target / source words`` is the
expected number of copies of each of its documents. The whole part is taken
for sure. The fractions are rounded together: two documents at a time, words
move at random from one fraction to the other until one of them is 0 or 1
(the sum of words stays the same and each expectation too). A task folds one
small group of documents and passes on the one fraction that is left; those
residuals are grouped again, level by level, until each source has one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .staging import free_name, join_groups, staged, uniform

#: Fractions folded in one group of the reduction tree.
FAN_IN = 64
WORD = r"[^\x20\x09-\x0D]+"
#: Documents over these multiples of their source's mean size are rounded first,
#: in this order; what they miss is spread over the fractions of the smaller ones.
BANDS = (8.0, 1.0)
#: A fraction this near to 0 or 1 is that number.
TINY = 1e-12


def word_count(text: Column) -> Column:
    """Number of maximal runs without ASCII white space; a null text has 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """One row per source: ``source, n_rows, source_size, target``.

    Sources in code-point order (null last) take ``weights`` in turn and share
    all words by weight; a target stops at ``most`` times its source and the
    excess is shared again by weight. The cap holds for the sources with the
    smallest ``most * size / weight``; the shared rate of the others follows
    from running sums in that order. The windows run over one row per source.
    """
    per = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("w", F.element_at(turn, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    cap = F.lit(float(most)) * F.col("source_size")
    per = per.withColumn("cap", cap).withColumn("reach", F.col("cap") / F.col("w"))
    order = Window.orderBy("reach", F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole).cast("double")
    used = F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    left = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(upto), F.lit(0.0))
    per = per.withColumn("rate", (total - used) / left)
    # the first source in this order that its cap does not bind sets the rate
    free = F.min(F.when(F.col("rate") <= F.col("reach"), F.struct("reach", "source", "rate"))).over(whole)
    per = per.withColumn("rate", free["rate"])
    share = F.col("rate") * F.col("w")
    target = F.when(share.isNull() | (share >= F.col("cap")), F.col("cap")).otherwise(share)
    return per.select("source", "n_rows", "source_size", target.alias("target"))


_STEP = """
aggregate(
  array_sort(members),
  named_struct('held', cast(null as struct<rank bigint, id {id}, size double, p double>),
               'done', cast(array() as array<struct<id {id}, up int>>)),
  (acc, b) -> CASE WHEN acc.held IS NULL THEN named_struct('held', b, 'done', acc.done) ELSE
    element_at(transform(
      array(named_struct('a', acc.held, 'b', b,
        'up', least((1 - acc.held.p) * acc.held.size, b.p * b.size),
        'down', least(acc.held.p * acc.held.size, (1 - b.p) * b.size))),
      s -> element_at(transform(
        array(CASE WHEN {u} * (s.up + s.down) < s.down
          THEN named_struct(
            'pa', CASE WHEN (1 - s.a.p) * s.a.size <= s.b.p * s.b.size THEN 1D ELSE s.a.p + s.up / s.a.size END,
            'pb', CASE WHEN (1 - s.a.p) * s.a.size >= s.b.p * s.b.size THEN 0D ELSE s.b.p - s.up / s.b.size END)
          ELSE named_struct(
            'pa', CASE WHEN s.a.p * s.a.size <= (1 - s.b.p) * s.b.size THEN 0D ELSE s.a.p - s.down / s.a.size END,
            'pb', CASE WHEN s.a.p * s.a.size >= (1 - s.b.p) * s.b.size THEN 1D ELSE s.b.p + s.down / s.b.size END)
        END),
        t -> named_struct(
          'held', CASE WHEN t.pa > {tiny} AND t.pa < 1 - {tiny}
                       THEN named_struct('rank', s.a.rank, 'id', s.a.id, 'size', s.a.size, 'p', t.pa)
                       WHEN t.pb > {tiny} AND t.pb < 1 - {tiny}
                       THEN named_struct('rank', s.b.rank, 'id', s.b.id, 'size', s.b.size, 'p', t.pb) END,
          'done', concat(acc.done,
            CASE WHEN t.pa <= {tiny} OR t.pa >= 1 - {tiny}
                 THEN array(named_struct('id', s.a.id, 'up', cast(round(t.pa) as int))) ELSE array() END,
            CASE WHEN t.pb <= {tiny} OR t.pb >= 1 - {tiny}
                 THEN array(named_struct('id', s.b.id, 'up', cast(round(t.pb) as int))) ELSE array() END))
      ), 1)), 1) END)
"""


def pivotal_rounding(fractions: DataFrame, seed: int = 5) -> DataFrame:
    """Round ``p`` to 0 or 1 within each ``stratum``.

    ``fractions``: ``stratum, n_rows`` (rows of the stratum, at least those
    given here), ``id`` (any struct, unique), ``rank`` (a well-spread long of
    the row), ``size`` (positive double) and ``p`` (0 < p < 1). Returns
    ``stratum, id, up``. The sum of ``size * p`` of a stratum changes by less
    than one size. Each level is one shuffle of at most ``n / FAN_IN ** level``
    rows, and every group has about ``FAN_IN`` members whatever the stratum's
    share of all rows.
    """
    id_type = dict(fractions.dtypes)["id"]
    step = F.expr(_STEP.format(
        id=id_type, tiny=TINY,
        u=f"((shiftrightunsigned(xxhash64(s.a.rank, s.b.rank, {seed}L), 12) + 0.5D) / {float(1 << 52)!r}D)"))
    largest = fractions.agg(F.max("n_rows")).first()[0] or 0
    groups = F.ceil(F.col("n_rows") / FAN_IN).cast("bigint")
    level, out = 0, []
    while largest > 1:
        largest = -(-largest // FAN_IN)
        folded = staged(
            fractions.withColumn("groups", groups)
            .groupBy("stratum", "groups", F.pmod(F.xxhash64("rank", F.lit(seed + level)), F.col("groups")).alias("leaf"))
            .agg(F.collect_list(F.struct("rank", "id", "size", "p")).alias("members"))
            .select("stratum", F.col("groups").alias("n_rows"), step.alias("s")),
            f"pivotal-{level}")
        out.append(folded.select("stratum", F.explode("s.done").alias("d")).select("stratum", "d.id", "d.up"))
        fractions = folded.where("s.held is not null").select("stratum", "n_rows", "s.held.*")
        level += 1
    last = fractions.select("stratum", "id", (uniform(F.col("rank"), seed, 99) < F.col("p")).cast("int").alias("up"))
    for part in out:
        last = last.unionAll(part)
    return last


def _round_by_band(rows: DataFrame, seed: int) -> DataFrame:
    """Round the fractions ``rest`` band by band. The words that the bands so
    far took beyond (or short of) their expectation come off the expectation
    of the rows still open, in equal proportion of their size; it is zero on
    average. So a source ends within about one small document of its target
    where its small documents can make up for the large ones."""
    keep = F.struct("doc_id", "row_hash", "size", "source_size", "target", "whole", "rest")
    last = len(BANDS)
    sums = [F.sum(F.when(F.col("band") >= b, F.col("size"))).alias(f"open_{b}") for b in range(last + 1)]
    sums = staged(rows.groupBy("source").agg(*sums), "mix-open")
    over, done = None, []
    for b in range(last + 1):
        part = rows.where(F.col("band") == b).join(
            sums.select(F.col("source").alias("s"), F.col(f"open_{b}").alias("open")), F.col("source").eqNullSafe(F.col("s")))
        if over is None:
            part = part.withColumn("miss", F.lit(0.0))
        else:
            part = part.join(over, F.col("source").eqNullSafe(F.col("o")), "left")
        p = F.col("rest") - F.coalesce(F.col("miss"), F.lit(0.0)) / F.col("open")
        part = part.select(
            F.col("source").alias("stratum"), "n_rows", keep.alias("id"),
            F.xxhash64("doc_id", "row_hash", "dup", F.lit(seed)).alias("rank"),
            F.col("size").cast("double").alias("size"), p.alias("p"))
        open_ = (F.col("p") > TINY) & (F.col("p") < 1 - TINY)
        sure = part.where(~open_).select("stratum", "id", F.when(F.col("p") > 0.5, 1).otherwise(0).alias("up"))
        done.append(staged(sure.unionAll(pivotal_rounding(part.where(open_), seed + 1000 * b)), f"mix-band-{b}"))
        errors = [d.select("stratum", (F.col("id.size") * (F.col("up") - F.col("id.rest"))).alias("e")) for d in done]
        over = reduce(DataFrame.unionAll, errors).groupBy(F.col("stratum").alias("o")).agg(F.sum("e").alias("miss"))
    return reduce(DataFrame.unionAll, done).select(F.col("stratum").alias("source"), "id.*", "up")


def mix_sources(
    df: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    most: int = 3,
    seed: int = 5,
) -> DataFrame:
    """Copies of every document that bring each source near its target words.

    Reads ``doc_id, text, source``. Returns one row per input row: ``doc_id,
    row_hash, source, size, source_size, target, copies, taken`` (``taken`` is
    ``copies * size``). ``copies`` is at most ``most``. A null text has size 0;
    a document of size 0 gets the whole part of its source's factor. A null
    source is a source of its own. Equal rows are rounded separately. An
    empty table gives an empty result.
    """
    sized = df.select(
        "doc_id", "source", F.xxhash64("doc_id", "source", "text").alias("row_hash"), word_count(F.col("text")).alias("size")
    )
    # equal rows become one row with a count before anything is shuffled
    rows = sized.groupBy("doc_id", "source", "row_hash", "size").agg(F.count(F.lit(1)).alias("n"))
    rows = staged(rows.withColumn("dup", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))).drop("n"), "mix-rows")
    plan = staged(source_targets(rows, weights, most).coalesce(1), "mix-targets")
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.least(F.floor(factor + TINY), F.lit(most))
    rest = F.greatest(factor - whole, F.lit(0.0))
    fields = [F.col("r.doc_id"), F.col("r.source"), F.col("r.row_hash"), F.col("r.size"), F.col("r.dup"),
              "n_rows", "source_size", "target", whole.cast("int").alias("whole"), rest.alias("rest")]
    all_rows = rows.alias("r").join(plan.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(*fields)
    tossed = (F.col("size") > 0) & (F.col("rest") > TINY) & (F.col("rest") < 1 - TINY) & (F.col("whole") < most)
    ratio = F.col("size") * F.col("n_rows") / F.col("source_size")
    band = F.lit(len(BANDS))
    for i in reversed(range(len(BANDS))):
        band = F.when(ratio > BANDS[i], F.lit(i)).otherwise(band)
    all_rows = all_rows.withColumn("band", F.when(tossed, band))
    rounded = _round_by_band(all_rows.where("band is not null"), seed)
    fixed = all_rows.where("band is null").withColumn("up", F.when(F.col("rest") >= 1 - TINY, 1).otherwise(0))
    names = ["doc_id", "row_hash", "source", "size", "source_size", "target"]
    copies = F.least(F.col("whole") + F.col("up"), F.lit(most))
    both = fixed.select(*names, copies.alias("copies")).unionAll(rounded.select(*names, copies.alias("copies")))
    return both.withColumn("taken", F.col("copies") * F.col("size"))


def repeat_rows(df: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``df``, each as often as ``mixed`` (of the same rows) says.

    Rows that are equal in ``doc_id, source, text`` share the copies of all of
    them as evenly as can be; every column of ``df`` is kept. Only such rows'
    hashes and places are numbered, first within a partition and then over the
    partitions' counts, so a row that fills a third of the table is in no one
    task. ``df`` is read more than once and must have its rows in the same
    places each time, as a stored table has.
    """
    names = [free_name(df, n) for n in ("row_hash", "row_place", "row_total", "row_equals", "row_number")]
    key, place, total, equals, number = names
    sums = mixed.groupBy(F.col("row_hash").alias(key)).agg(F.sum("copies").alias(total), F.count(F.lit(1)).alias(equals))
    rows = df.withColumn(key, F.xxhash64("doc_id", "source", "text")).withColumn(place, F.monotonically_increasing_id())
    rows = join_groups(rows, sums.where(F.col(total) > 0), [key], equals).where(F.col(total) > 0)
    many = rows.where(F.col(equals) > 1).select(key, place).withColumn("part", F.shiftright(place, 33))
    inside = many.withColumn("k", F.row_number().over(Window.partitionBy(key, "part").orderBy(place)))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = many.groupBy(key, "part").agg(F.count(F.lit(1)).alias("n")).select(
        key, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbers = inside.join(offsets, [key, "part"]).select(key, place, (F.col("offset") + F.col("k")).alias(number))
    shared = rows.where(F.col(equals) > 1).join(numbers, [key, place])
    share = F.floor(F.col(total) / F.col(equals))
    copies = share + F.when(F.col(number) <= F.col(total) - share * F.col(equals), F.lit(1)).otherwise(F.lit(0))
    out = rows.where(F.col(equals) == 1).select(*[F.col(f"`{c}`") for c in df.columns], F.col(total).alias(number)).unionAll(
        shared.select(*[F.col(f"`{c}`") for c in df.columns], copies.alias(number)))
    out = out.where(F.col(number) > 0).withColumn(place, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(number).cast("bigint"))))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
