"""Chat formatting with Spark expressions only (operator 8).

A conversation becomes one string of blocks ``<turn>ROLE<text>PART<part>PART</turn>\\n``: its rows sorted by turn, and
adjacent rows of the same role merged into one block whose parts stay apart. Inside roles and texts a backslash is written
as two and ``<`` as backslash and ``l``; so no text can hold a control string, and ``read_turns`` gets the rows back exactly.
``loss_spans`` are the code-point ranges (end exclusive) of the parts of assistant blocks.

Defined results: null text and null role count as empty strings, an empty role is never under the mask. Rows with the
same turn are sorted by role, then text; a null turn comes first. Rows whose conversation is null form one conversation
of their own. Repeated rows are kept. Other columns of the input are ignored. An empty table gives no rows.
A conversation is one string, so its rows meet in one task; sums of lengths are taken by blocks, so a row costs a bounded number of
additions up to millions of rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, PART, END = "<turn>", "<text>", "<part>", "</turn>\n"
BLOCK = 256


def escape(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(x: Column) -> Column:
    """A run of backslashes starts with whole pairs, so cutting at pairs from the left leaves only ``\\l`` to replace."""
    pieces = F.split(x, r"\\\\", -1)
    return F.array_join(F.transform(pieces, lambda s: F.replace(s, F.lit("\\l"), F.lit("<"))), "\\")


def let(x: Column, body: Callable[[Column], Column]) -> Column:
    """``body(x)`` with x computed once: what a lambda refers to from outside would be computed anew for each element."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def starts_of(lengths: Column) -> Column:
    """Sums of all earlier elements, by three levels of blocks: an element costs at most ``BLOCK`` additions on each."""
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    own = lambda xs: F.transform(xs, lambda _, i: total(F.slice(xs, F.lit(1), i)))

    def cut(xs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(xs) / BLOCK).cast("int") - 1, F.lit(0))), lambda b: F.slice(xs, b * BLOCK + 1, BLOCK))

    def spread(blocks: Column, starts: Column) -> Column:
        return F.flatten(F.zip_with(blocks, starts, lambda xs, a: F.transform(own(xs), lambda x: a + x)))

    def of_blocks(sums: Column) -> Column:
        return let(cut(sums), lambda wide: spread(wide, let(F.transform(wide, total), own)))

    return let(lengths, lambda xs: let(cut(xs), lambda blocks: spread(blocks, let(F.transform(blocks, total), of_blocks))))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans`` for every conversation."""
    row = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("t"))
    heads = F.filter(F.sequence(F.lit(1), F.size("t")), lambda i: (i == 1) | (F.get("t", i - 1)["role"] != F.get("t", i - 2)["role"]))
    merged = F.transform(
        F.col("h"),
        lambda i, k: F.struct(
            F.get("t", i - 1)["role"].alias("role"),
            F.transform(F.slice("t", i, F.coalesce(F.get("h", k + 1), F.size("t") + 1) - i), lambda r: escape(r["text"])).alias("parts"),
        ),
    )
    # One string for each part, with the control strings that stand before and after it.
    strings = F.flatten(
        F.transform(
            F.col("blocks"),
            lambda b: F.transform(
                b["parts"],
                lambda p, j: F.struct(
                    F.when(j == 0, F.concat(F.lit(TURN), escape(b["role"]), F.lit(TEXT))).otherwise(F.lit(PART)).alias("before"), p.alias("part"),
                    F.when(j == F.size(b["parts"]) - 1, F.lit(END)).otherwise(F.lit("")).alias("after"), (b["role"] == learn).alias("learn"),
                ),
            ),
        )
    )
    whole = F.transform(F.col("s"), lambda x: F.concat(x["before"], x["part"], x["after"]))
    spans = F.transform(
        F.filter(
            F.zip_with("s", "starts", lambda x, a: F.struct(x["learn"].alias("learn"), (a + F.length(x["before"])).alias("start"), F.length(x["part"]).alias("n"))),
            lambda x: x["learn"],
        ),
        lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["n"]).alias("end")),
    )
    return (
        rows.withColumn("h", heads).withColumn("blocks", merged).withColumn("s", strings)
        .withColumn("starts", starts_of(F.transform("s", lambda x: (F.length(x["before"]) + F.length(x["part"]) + F.length(x["after"])).cast("long"))))
        .select("conv_id", F.array_join(whole, "").alias("formatted"), spans.alias("loss_spans"))
    )


def read_turns(formatted: Column) -> Column:
    """The rows again: an array of ``role, text``, one for each row that went in."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: F.startswith(b, F.lit(TURN)))
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.split_part(b, F.lit(TEXT), F.lit(2)), PART, -1),
                lambda p: F.struct(unescape(F.substr(F.split_part(b, F.lit(TEXT), F.lit(1)), F.lit(len(TURN) + 1))).alias("role"), unescape(p).alias("text")),
            ),
        )
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the mask, unescaped. Ranges are cut from four-byte code points, which needs no walk from the start."""
    points = F.encode(formatted, "UTF-32")
    cut = F.transform(spans, lambda s: F.substr(points, (s["start"] * 4 + 1).cast("int"), ((s["end"] - s["start"]) * 4).cast("int")))
    # The letter before keeps a byte order mark at the start of a text from being taken for one of the encoding.
    text = F.transform(cut, lambda c: F.substr(F.decode(F.concat(F.encode(F.lit("A"), "UTF-32"), c), "UTF-32"), F.lit(2)))
    return unescape(F.array_join(text, ""))
