"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations only.

A tree of domain, language and source has a weight at each node. The budget of tokens flows from the root: at each node the
children share it by weight, none gets more than its subtree can give (its tokens times `max_epochs`), and what a short
child leaves goes to its siblings first; only what a whole node cannot take goes to the node's own siblings. Each leaf then
gives a prefix of its tokens, in an order that a seed and the epoch decide.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxseries.llm.common import Stages, text_digest

LEVELS = ("domain", "lang", "source")


def _weight(level: str, weights: dict[str, float], other: float) -> Column:
    """The weight of a node by its name."""
    return reduce(lambda rest, kv: F.when(F.col(level) == kv[0], F.lit(float(kv[1]))).otherwise(rest),
                  weights.items(), F.lit(float(other)))


def _fill(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Share `budget` of each parent among its rows by `weight`, at most `room` each: adds `share`.

    In order of room per weight, a row is full if the rows up to it fit at its own level; the others share what is left.
    """
    by = Window.partitionBy(*parents)
    order = by.orderBy("__level", "__name").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = F.when(F.col("weight") > 0, F.col("room") / F.col("weight")).otherwise(F.lit(float("inf")))
    out = (nodes.withColumn("__level", level)
           .withColumn("__used", F.sum("room").over(order))
           .withColumn("__behind", F.sum("weight").over(by) - F.sum("weight").over(order))
           .withColumn("__full", (F.col("weight") > 0)
                       & (F.col("__used") + F.col("__level") * F.col("__behind") <= F.col("budget") * (1 + 1e-12))))
    spare = F.col("budget") - F.sum(F.when(F.col("__full"), F.col("room")).otherwise(0.0)).over(by)
    open_weight = F.sum(F.when(F.col("__full"), 0.0).otherwise(F.col("weight"))).over(by)
    share = F.when(F.col("__full"), F.col("room")).when(
        open_weight > 0, F.least(F.col("room"), spare * F.col("weight") / open_weight)).otherwise(0.0)
    return out.withColumn("share", share).drop("__level", "__used", "__behind", "__full")


def budgets(leaves: DataFrame, total: Column, weights: dict[str, dict[str, float]], other: float = 1.0,
            max_epochs: int = 1) -> DataFrame:
    """Leaves (domain, lang, source, available) with `target`, the tokens each is to give.

    A name without a weight of its own gets `other`; weight 0 gives nothing. `total` beyond what the tree can give is cut
    to that. One row per leaf moves, nothing else.
    """
    table = leaves.withColumn("room", F.when(_usable(weights, other), F.col("available") * float(max_epochs)).otherwise(0.0))
    root = Window.partitionBy(F.lit(0))
    domains = table.groupBy("domain").agg(F.sum("room").alias("room"), F.sum("available").alias("available"))
    domains = domains.withColumn("available", F.sum("available").over(root)).withColumn(
        "budget", F.least(total.cast("double"), F.sum("room").over(root)))
    given = _fill(domains.withColumn("weight", _weight("domain", weights.get("domain", {}), other))
                  .withColumn("__name", F.col("domain")).withColumn("__root", F.lit(0)), ["__root"])
    given = given.select("domain", F.col("share").alias("budget"))
    langs = table.groupBy("domain", "lang").agg(F.sum("room").alias("room"))
    langs = _null_safe(langs, given, ["domain"])
    langs = _fill(langs.withColumn("weight", _weight("lang", weights.get("lang", {}), other))
                  .withColumn("__name", F.col("lang")), ["domain"]).select("domain", "lang", F.col("share").alias("budget"))
    leaf = _null_safe(table, langs, ["domain", "lang"])
    leaf = _fill(leaf.withColumn("weight", _weight("source", weights.get("source", {}), other))
                 .withColumn("__name", F.col("source")), ["domain", "lang"])
    return leaf.select("domain", "lang", "source", "available", F.floor(F.col("share") + 1e-6).alias("target"))


def _usable(weights: dict[str, dict[str, float]], other: float) -> Column:
    return reduce(lambda a, level: a & (_weight(level, weights.get(level, {}), other) > 0), LEVELS, F.lit(True))


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    renamed = right.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(renamed, on).drop(*[f"__{k}" for k in keys])


#: All characters but blanks and the blocks of scripts written without blanks: Thai, Lao, Myanmar, Khmer, U+3000 to U+9FFF
#: (Han, Kana and their signs), U+F900 to U+FAFF, U+20000 to U+3FFFF. The common ones come first.
_SPACED = (r"\x21-\u0DFF\x00-\x08\x0E-\x1F\u0F00-\u0FFF\u10A0-\u177F\u1800-\u2FFF\uA000-\uD7FF\uE000-\uF8FF\uFB00-\uFFFF"
           r"\x{10000}-\x{1FFFF}\x{40000}-\x{10FFFF}")


def pieces(text: Column) -> Column:
    """How many pieces a text has, which follows its length with or without blanks: each character of a script written without
    blanks is one, and any other run between blanks is one for each 12 characters begun.
    """
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(rf"[{_SPACED}]{{1,12}}|[^\x20\x09-\x0D]")).cast("long")


def select(docs: DataFrame, domain: Column, weights: dict[str, dict[str, float]], share: float, other: float = 1.0,
           max_epochs: int = 1, seed: int = 0, slices: int = 4096, id_column: str = "doc_id", text: str = "text",
           marked: bool = False, tokens: Column | None = None) -> DataFrame:
    """One row per document and epoch taken: id, domain, lang, source, tokens, epoch, tokens_taken.

    The budget is `share` of all tokens: `tokens`, a count of the caller's (none below 0), else words between blanks. Whole epochs come first; the last one ends inside a
    document, of which `tokens_taken` tells the part. Null lang or source is a name of its own; null or blank texts have no
    tokens and are never taken; repeated rows are documents of their own; an empty table gives an empty result. `marked` adds the digest of the text, which keep_taken needs.

    Texts are read once, to count. Running sums are made over `slices` hash ranges of a leaf first, then over the rows of the
    one slice where the prefix ends: a leaf with a third of the rows is never ordered as a whole.
    """
    stages = Stages(docs.sparkSession, "mixing")
    if tokens is None:
        tokens = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    rows = stages.write(docs.select(
        F.col(id_column).alias("id"), domain.alias("domain"), "lang", "source", F.coalesce(tokens.cast("long"), F.lit(0)).alias("tokens"),
        text_digest(F.col(text)).alias("mark"), F.monotonically_increasing_id().alias("row")), "counted")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("available"))
    leaves = stages.write(leaves, "leaves")
    total = F.col("available") * float(share)
    plan = stages.write(budgets(leaves, total, weights, other, max_epochs).filter("target > 0 AND available > 0")
                        .withColumn("whole", F.floor(F.col("target") / F.col("available")).cast("int"))
                        .withColumn("rest", F.col("target") % F.col("available")), "plan")
    planned = _null_safe(rows.filter("tokens > 0"), plan.drop("available", "target"), list(LEVELS))
    whole = (planned.filter("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))
             .withColumn("tokens_taken", F.col("tokens")))
    # Neither file splits nor partitions decide: row numbers only order rows alike in id and text.
    point = F.xxhash64("id", "mark", F.lit(seed), F.col("whole"))
    last = planned.filter("rest > 0").withColumn("point", point).withColumn(
        "slice", F.pmod(F.shiftright("point", 20), F.lit(slices)).cast("int"))
    sums = last.groupBy(*LEVELS, "slice", "rest").agg(F.sum("tokens").alias("here"))
    ahead = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("here").over(ahead), F.lit(0))).filter(F.col("ahead") < F.col("rest"))
    placed = _null_safe(last, sums.drop("rest"), [*LEVELS, "slice"])
    inner = placed.filter(F.col("ahead") + F.col("here") <= F.col("rest")).withColumn("tokens_taken", F.col("tokens"))
    order = Window.partitionBy(*LEVELS).orderBy("point", "id", "mark", "row").rowsBetween(Window.unboundedPreceding, -1)
    edge = (placed.filter(F.col("ahead") + F.col("here") > F.col("rest"))
            .withColumn("before", F.col("ahead") + F.coalesce(F.sum("tokens").over(order), F.lit(0)))
            .filter(F.col("before") < F.col("rest"))
            .withColumn("tokens_taken", F.least(F.col("tokens"), F.col("rest") - F.col("before"))))
    shape = [F.col("id").alias(id_column), *LEVELS, "tokens", "epoch", "tokens_taken", *["mark"] * marked]
    ends = [x.withColumn("epoch", F.col("whole")).select(*shape) for x in (inner, edge)]
    return whole.select(*shape).unionByName(ends[0]).unionByName(ends[1])


def keep_taken(docs: DataFrame, taken: DataFrame, domain: Column, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of which a part was taken, whole, with their own columns. `taken` comes from select(marked=True).

    Rows are told apart by id, digest of the text and leaf; of rows alike in all of them as many stay as were taken.
    """
    stages = Stages(docs.sparkSession, "taken")
    keys = ["__id", "__mark", *(f"__{level}" for level in LEVELS)]
    tagged = docs.withColumns(dict(zip(keys, [F.col(id_column), text_digest(F.col(text)), domain, F.col("lang"), F.col("source")])))
    # Each document of which anything was taken is in epoch 0.
    took = taken.filter("epoch = 0").groupBy(
        *[F.col(c).alias(k) for c, k in zip([id_column, "mark", *LEVELS], keys)]).agg(F.count("*").alias("took"))
    alike = tagged.groupBy(*[F.col(k).alias(f"{k}_") for k in keys]).agg(F.count("*").alias("alike")).filter("alike > 1")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])
    took = stages.write(took.join(alike, same, "left").select(
        *[F.col(k).alias(f"{k}_") for k in keys], "took", F.coalesce(F.col("took") < F.col("alike"), F.lit(False)).alias("part")),
        "took")
    part = stages.write(took.filter("part"), "part")
    # A leaf's prefix ends in one group of alike rows at most, so few groups are numbered.
    order = Window.partitionBy(*keys).orderBy(F.lit(0))
    some = tagged.join(part, same).withColumn("__at", F.row_number().over(order)).filter(F.col("__at") <= F.col("took"))
    return (tagged.join(took.filter("NOT part"), same, "left_semi").select(*docs.columns)
            .unionByName(some.select(*docs.columns)))
