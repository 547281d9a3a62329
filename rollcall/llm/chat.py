"""Chat formatting with Spark expressions only.

A conversation's rows are collected as (turn, role, text) structs, sorted,
merged where neighbours have the same role, and concatenated:

    <s:ROLE>text<+>text</s><s:ROLE>text</s>

``<+>`` parts the texts of merged turns. ``&`` and ``<`` inside roles and texts
become ``&amp;`` and ``&lt;``, so no ``<`` in the output comes from a text and
the format can be read back exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import free_name

HEAD, HEAD_END, PART, END = "<s:", ">", "<+>", "</s>"
#: Pieces whose offsets are added up one after the other, and code points of a
#: cut of the formatted text: work grows with the turns, not with their square.
RUN, CUT = 256, 4096


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where ``value`` is worked out once, however often and
    deep in other lambdas it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(sizes: Column) -> Column:
    """``start, end`` of the loss bodies, from the pieces' ``lead, body, tail``
    lengths: per run of pieces, from where the runs before it end."""

    def run_spans(run: Column, start: Column) -> Column:
        return F.aggregate(
            run,
            F.struct(start.alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
            lambda acc, x: F.struct(
                (acc["at"] + x["lead"] + x["body"] + x["tail"]).alias("at"),
                F.when(x["loss"], F.concat(acc["spans"], F.array(F.struct(
                    (acc["at"] + x["lead"]).alias("start"), (acc["at"] + x["lead"] + x["body"]).alias("end"),
                )))).otherwise(acc["spans"]).alias("spans"),
            ),
            lambda acc: acc["spans"],
        )

    def of_runs(runs: Column) -> Column:
        lengths = F.transform(runs, lambda r: F.aggregate(r, F.lit(0).cast("bigint"), lambda n, x: n + x["lead"] + x["body"] + x["tail"]))
        starts = F.aggregate(lengths, F.array(F.lit(0).cast("bigint")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.zip_with(runs, F.slice(starts, 1, F.size(runs)), run_spans))

    def of_sizes(all_sizes: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(all_sizes), F.lit(1)), F.lit(RUN))
        return _let(F.transform(firsts, lambda i: F.slice(all_sizes, i, RUN)), of_runs)

    return _let(sizes, of_sizes)


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("&gt;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&gt;"), F.lit(">")))


def format_conversations(df: DataFrame, loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per ``conv_id``: ``conv_id, formatted, loss_spans``.

    ``loss_spans`` holds ``start, end`` code-point offsets into ``formatted``,
    one per text of a role in ``loss_roles``, in order: the loss mask. Turns
    are ordered by ``turn`` (null first), then role, then text; repeated rows
    stay. Null roles and texts count as empty. A null ``conv_id`` is one
    conversation. Other columns are ignored; an empty table gives no rows. A
    conversation becomes one string, so it is the unit of work.
    """
    turns = F.array_sort(F.collect_list(F.struct(
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )))
    t, before = F.col("turns"), F.col("turns_before")
    loss = F.array(*[F.lit(r) for r in loss_roles]).cast("array<string>")
    pieces = F.transform(
        F.arrays_zip(t.alias("t"), before.alias("b"), F.col("turns_after").alias("a")),
        lambda x: F.struct(
            F.when((x["b"].isNotNull()) & (x["b"] == x["t"]["role"]), F.lit(PART))
            .otherwise(F.concat(F.lit(HEAD), _escape_role(x["t"]["role"]), F.lit(HEAD_END))).alias("lead"),
            escape(x["t"]["text"]).alias("body"),
            F.when((x["a"].isNotNull()) & (x["a"] == x["t"]["role"]), F.lit("")).otherwise(F.lit(END)).alias("tail"),
            F.array_contains(loss, x["t"]["role"]).alias("loss"),
        ),
    )
    roles = F.transform(t, lambda x: x["role"])
    none = F.array(F.lit(None).cast("string"))
    grouped = (
        df.groupBy("conv_id").agg(turns.alias("turns"))
        .withColumn("turns_before", F.concat(none, F.slice(roles, 1, F.greatest(F.size(roles) - 1, F.lit(0)))))
        .withColumn("turns_after", F.concat(F.slice(roles, 2, F.size(roles)), none))
        .select("conv_id", pieces.alias("p"))
    )
    sizes = F.transform("p", lambda x: F.struct(
        *[F.length(x[c]).cast("bigint").alias(c) for c in ("lead", "body", "tail")], x["loss"].alias("loss")))
    whole = F.array_join(F.transform("p", lambda x: F.concat(x["lead"], x["body"], x["tail"])), "")
    return grouped.select("conv_id", whole.alias("formatted"), _spans(sizes).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns (structs ``role, text``) of a formatted conversation."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        cut = F.locate(HEAD_END, block)
        role = _unescape_role(F.substring(block, F.lit(len(HEAD) + 1), cut - len(HEAD) - 1))
        body = F.substring(block, cut + 1, F.length(block))
        return F.transform(F.split(body, r"<\+>", -1), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""

    def part(cuts: Column, s: Column) -> Column:
        first = F.floor(s["start"] / CUT).cast("int")
        last = F.floor(F.greatest(s["end"] - 1, s["start"]) / CUT).cast("int")
        near = F.array_join(F.slice(cuts, first + 1, last - first + 1), "")
        return F.substring(near, (s["start"] - first * CUT + 1).cast("int"), (s["end"] - s["start"]).cast("int"))

    cuts = F.split(formatted, f"(?s)(?<=\\G.{{{CUT}}})", -1)
    return _let(cuts, lambda c: unescape(F.array_join(F.transform(spans, lambda s: part(c, s)), "")))


def conversation_digest(df: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted text: ``conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    out = format_conversations(df)
    work = free_name(out, "turns")
    said = F.transform(work, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return (
        out.withColumn(work, read_turns(F.col("formatted")))
        .withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
        .select(
            "conv_id",
            F.size(work).cast("bigint").alias("n_turns"),
            F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
            F.length("loss").cast("bigint").alias("loss_chars"),
            F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
            F.length("formatted").cast("bigint").alias("formatted_chars"),
        )
    )
