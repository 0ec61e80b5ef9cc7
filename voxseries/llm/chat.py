"""Chat formatting in Spark expressions only: turns in order, equal neighbours merged, a loss mask of spans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Our template's control strings. Published ones of other templates are escaped too.
START, ROLE, NEXT, END = "<|im_start|>", "<|im_role|>", "<|im_next|>", "<|im_end|>"
CONTROL = [START, ROLE, NEXT, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

_STEP = 256


def escape(text: Column) -> Column:
    """Double each backslash, and put one after the first character of each control string. Null is empty."""
    tails = "|".join(f"(?<={_quoted(c[0])}){_quoted(c[1:])}" for c in CONTROL)
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({tails})", "\\\\$1")


def unescape(text: Column) -> Column:
    """A backslash gives way to the backslash after it, or to nothing."""
    return F.regexp_replace(text, "\\\\(\\\\?)", "$1")


def _quoted(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != "_" else c for c in text)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value, so that lambdas use it without making it again for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(sizes: Column) -> Column:
    """For each element the sum of those before it: sums of whole steps first, so long arrays stay near linear."""
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, y: a + y)

    def chunks(all_sizes: Column) -> Column:
        last = F.floor((F.size(all_sizes) - 1) / _STEP).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda j: F.slice(all_sizes, j * _STEP + 1, F.lit(_STEP)))

    def spread(parts: Column) -> Column:
        heads = let(F.transform(parts, total), lambda sums: F.transform(
            sums, lambda x, j: total(F.slice(sums, F.lit(1), j))))
        return F.flatten(F.zip_with(parts, heads, lambda part, head: F.transform(
            part, lambda x, i: head + total(F.slice(part, F.lit(1), i)))))

    return let(sizes, lambda bound: let(chunks(bound), spread))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 trained: str = "assistant") -> DataFrame:
    """One row per conversation: conv, formatted (string), loss_spans (array of start, size in code points).

    Turns are sorted by turn, role, text (null turns first; null role or text: empty). Repeated rows are turns of their
    own. Neighbours of one role become one block, `START role ROLE text NEXT text END`; NEXT keeps the seam, so the turns
    can be read back. The loss covers the texts of the trained role, not the marks. Rows with a null conversation form
    one. Other columns are ignored. An empty table gives an empty result. One shuffle, by conversation.
    """
    item = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                    F.coalesce(F.col(text), F.lit("")).alias("text"))
    grouped = turns.groupBy(conv).agg(F.sort_array(F.collect_list(item)).alias("turns"))

    def marks(all_turns: Column) -> Column:
        def mark(t: Column, i: Column) -> Column:
            head = F.concat(F.lit(START), escape(t["role"]), F.lit(ROLE))
            return F.when(i == 0, head).when(F.get(all_turns, i - 1)["role"] == t["role"], F.lit(NEXT)).otherwise(
                F.concat(F.lit(END), head))
        return F.transform(all_turns, mark)

    def lay(all_turns: Column) -> Column:
        pieces = F.arrays_zip(marks(all_turns).alias("mark"), F.transform(all_turns, lambda t: escape(t["text"])).alias("text"),
                              F.transform(all_turns, lambda t: t["role"] == trained).alias("trained"))
        return let(pieces, lambda ps: F.struct(
            F.concat(F.array_join(F.transform(ps, lambda p: F.concat(p["mark"], p["text"])), ""), F.lit(END)).alias("formatted"),
            F.transform(F.filter(F.zip_with(ps, prefix_sums(F.transform(
                ps, lambda p: (F.length(p["mark"]) + F.length(p["text"])).cast("long"))), lambda p, at: F.struct(
                    (at + F.length(p["mark"])).cast("int").alias("start"), F.length(p["text"]).alias("size"),
                    p["trained"].alias("trained"))), lambda x: x["trained"]),
                lambda x: F.struct(x["start"], x["size"])).alias("loss_spans")))

    laid = grouped.select(conv, let(F.col("turns"), lay).alias("laid"))
    return laid.select(conv, "laid.formatted", "laid.loss_spans")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    blocks = F.filter(F.split(formatted, _quoted(START)), lambda b: b != "")

    def turns(block: Column) -> Column:
        body = F.replace(F.substring_index(block, ROLE, -1), F.lit(END), F.lit(""))
        return F.transform(F.split(body, _quoted(NEXT)), lambda t: F.struct(
            unescape(F.substring_index(block, ROLE, 1)).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return let(formatted, lambda text: F.array_join(
        F.transform(spans, lambda s: unescape(F.substr(text, s["start"] + 1, s["size"]))), ""))
