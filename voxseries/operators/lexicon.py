"""Lexicon sentiment as joins over exploded tokens (rules of Hutto and Gilbert, 2014).

Input text is lower-cased, so the rules for capitals never apply, and ! and ? are not counted.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries import constants as K
from voxseries.functions.text import words
from voxseries.operators import joins


#: Words of a lexicon that may stand in a plan as a literal set.
LITERAL = 50_000


def is_small(lexicon: DataFrame) -> bool:
    """Whether a lexicon, once measured, may stand in a plan as a literal set."""
    return joins.is_small(lexicon, LITERAL)


def _listed(term: str, names) -> str:
    """SQL test whether a term is one of the names."""
    quoted = ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in names)
    return f"coalesce({term} IN ({quoted}), false)" if quoted else "false"


def _weight(term: str, mapping) -> str:
    """SQL weight of a word or phrase, null if it has none: one membership test per weight."""
    by_weight: dict[float, list[str]] = {}
    for name, weight in mapping.items():
        by_weight.setdefault(float(weight), []).append(name)
    arms = "".join(f" WHEN {_listed(term, names)} THEN {w}D" for w, names in by_weight.items())
    return f"CASE{arms} END" if arms else "CAST(NULL AS DOUBLE)"


def _phrase(*names: str) -> str:
    """SQL text of neighbouring words as one phrase; null if one of them is missing."""
    return "concat(" + ", ' ', ".join(names) + ")"


def token_contexts(df: DataFrame, text_col: str, key) -> DataFrame:
    """One row per token with its three predecessors and two successors.

    Shifted copies of the row's own token array are zipped before it is exploded, so no window
    and no shuffle is needed. An empty token closes every row, which keeps rows without any hit.
    """
    # Found before the explode: afterwards it would be searched for once per token.
    cut = df.select(*key, words(F.col(text_col)).alias("_words"))
    but = F.array_position("_words", F.lit("but")) - 1
    cut = cut.withColumn("but", F.when(but >= 0, but))
    own = F.col("_words")

    def later(n):
        return F.concat(F.array(*[F.lit(None).cast("string")] * n), own)

    def sooner(n):
        return F.slice(own, n + 1, F.size(own))

    shifted = F.arrays_zip(
        F.concat(own, F.array(F.lit(""))).alias("w"),
        later(1).alias("p1"), later(2).alias("p2"), later(3).alias("p3"),
        sooner(1).alias("n1"), sooner(2).alias("n2"),
    )
    tokens = cut.select(*key, "but", F.posexplode(shifted).alias("pos", "_token"))
    # The shifted copies run past the end; those places hold no token.
    return tokens.select(*key, "but", "pos", "_token.*").filter(F.col("w").isNotNull())


def hit_contexts(df: DataFrame, text_col: str, key, listed) -> DataFrame:
    """The same rows for tokens that are among the ``listed`` words only, with a flag for each neighbour that is.

    Membership is tested against a literal set inside the row, before anything is exploded: a row leaves as many rows as it
    has hits, and one that closes it.
    """
    def among(word: str) -> str:
        return _listed(word, listed)

    cut = df.select(*key, words(F.col(text_col)).alias("_words"))
    but = F.array_position("_words", F.lit("but")) - 1
    at = F.expr(f"filter(transform(_words, (w, i) -> IF({among('w')}, i, -1)), i -> i >= 0)")
    # The positions leave through a generator, so that the words are not searched again for what follows.
    found = cut.select(*key, "_words", F.when(but >= 0, but).alias("but"), F.inline(F.array(F.struct(at.alias("_at")))))
    near = ", ".join(f"get(_words, i {step}) AS {name}" for name, step in (
        ("w", "+ 0"), ("p1", "- 1"), ("p2", "- 2"), ("p3", "- 3"), ("n1", "+ 1"), ("n2", "+ 2")))
    tokens = F.expr(f"""concat(transform(_at, i -> struct(i AS pos, {near})),
        array(struct(size(_words) AS pos, '' AS w, string(null) AS p1, string(null) AS p2, string(null) AS p3,
                     string(null) AS n1, string(null) AS n2)))""")
    hits = found.select(*key, "but", F.inline(tokens))
    return hits.withColumns({f"{n}_known": F.expr(f"IF({among(n)}, true, null)") for n in ("p1", "p2", "p3", "n1")})


def _nearby(hits: DataFrame, lexicon: DataFrame, side) -> DataFrame:
    """Whether each neighbour is a lexicon word: the same small table again, on hits only."""
    for name in ("p1", "p2", "p3", "n1"):
        known = lexicon.select(F.col("word").alias(name), F.lit(True).alias(f"{name}_known"))
        hits = hits.join(side(known), name, "left")
    return hits


def _step(hits: DataFrame, k: int, boosters, negators) -> DataFrame:
    """Effect of the k-th word before a hit; a word with a valence of its own has none."""
    near, between = f"p{k}", [f"p{i}" for i in range(1, k)]
    acts = f"({near} IS NOT NULL AND {near}_known IS NULL)"
    degree = f"coalesce({_weight(near, boosters)}, 0D) * IF(score < 0, -1D, 1D)"
    negates = f"({_listed(near, negators)} OR contains({near}, 'n\\'t'))"
    arms = f"WHEN NOT {acts} THEN 1D"
    if between:
        so = " OR ".join(_listed(b, ["so", "this"]) for b in between)
        doubt = " OR ".join(_listed(b, ["doubt"]) for b in between)
        arms += f" WHEN {near} = 'never' AND ({so}) THEN {K.NEVER_SO_WEIGHT}D"
        arms += f" WHEN {near} = 'without' AND ({doubt}) THEN 1D"
    arms += f" WHEN {negates} THEN {K.NEGATION_WEIGHT}D"
    return hits.withColumn("score", F.expr(
        f"(score + IF({acts}, {degree} * {K.DISTANCE_DAMPING[k - 1]}D, 0D)) * (CASE {arms} ELSE 1D END)"
    ))


def _phrases(hits: DataFrame, boosters, idioms) -> DataFrame:
    """Multi-word expressions that end in, or start at, the hit."""
    after = [("w", "n1", "n2"), ("w", "n1")]
    before = [("p1", "w"), ("p2", "p1", "w"), ("p2", "p1"), ("p3", "p2", "p1"), ("p3", "p2")]
    own = ", ".join(_weight(_phrase(*names), idioms) for names in [*after, *before])
    spaced = {name: weight for name, weight in boosters.items() if " " in name}
    degree = " + ".join(
        f"coalesce({_weight(_phrase(*names), spaced)}, 0D)"
        for names in [("p3", "p2", "p1"), ("p3", "p2"), ("p2", "p1")]
    )
    applies = "p3 IS NOT NULL AND p3_known IS NULL"
    return hits.withColumn("score", F.expr(f"IF({applies}, coalesce({own}, score) + {degree}, score)"))


def lexicon_score(
    df: DataFrame,
    text_col: str,
    lexicon: DataFrame,
    key,
    boosters=K.BOOSTERS,
    negators=K.NEGATORS,
    idioms=K.IDIOMS,
    out_col: str = "vader_score",
    copies_col: str | None = None,
) -> DataFrame:
    """Compound score in [-1, 1] of each row's whole text, beside its ``key`` columns.

    The key must be unique, unless ``copies_col`` is given: then rows that agree in key and text
    become one row with their number in that column, for an aggregation to weigh it by.

    ``lexicon`` is a table of ``word, valence`` with one row per word. It is measured first: a small one (``LITERAL``
    words at most) becomes a literal set, so that only hits leave their row, and is broadcast for their valences; a larger
    one is joined, with all tokens, like any other table. The only shuffle is of one partial sum per row and task: all tokens
    of a row sit in one task, so the map side has already added them up. Null and empty text scores 0.
    """
    lexicon = lexicon.select("word", F.col("valence").cast("double").alias("valence"))
    small = is_small(lexicon)
    side = F.broadcast if small else (lambda table: table)
    closing = df.sparkSession.range(1).select(F.lit("").alias("w"), F.lit(0.0).alias("valence"))
    known = lexicon.select(F.col("word").alias("w"), "valence").union(closing)

    if copies_col:
        key = [*key, "_digest"]
        df = df.withColumn("_digest", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    if small:
        listed = [row.word for row in lexicon.select("word").collect() if row.word is not None]
        hits = hit_contexts(df, text_col, key, listed).join(side(known), "w")
    else:
        hits = _nearby(token_contexts(df, text_col, key).join(known, "w"), lexicon, side)
    plain = [b for b in boosters if " " not in b]
    hits = hits.filter(f"NOT ({_listed('w', plain)} OR (w = 'kind' AND coalesce(n1 = 'of', false)))")
    after_no = "p1 = 'no' OR p2 = 'no' OR (p3 = 'no' AND p1 IN ('or', 'nor'))"
    hits = hits.withColumn("score", F.expr(
        f"CASE WHEN {after_no} THEN valence * {K.NEGATION_WEIGHT}D"
        " WHEN w = 'no' AND n1_known THEN 0D ELSE valence END"
    ))
    for k in (1, 2, 3):
        hits = _step(hits, k, boosters, negators)
    hits = _phrases(hits, boosters, idioms)
    least = "p1 = 'least' AND p1_known IS NULL AND coalesce(p2 NOT IN ('at', 'very'), true)"
    part = F.expr(
        f"score * IF({least}, {K.NEGATION_WEIGHT}D, 1D)"
        f" * CASE WHEN pos < but THEN {K.BEFORE_BUT_WEIGHT}D WHEN pos > but THEN {K.AFTER_BUT_WEIGHT}D ELSE 1D END"
    )
    closes = F.col("w") == ""
    hits = hits.select(*key, F.when(closes, 0.0).otherwise(part).alias("part"), closes.alias("closes"))
    # Every row has one closing token, so their number is the number of equal rows.
    total = hits.groupBy(*key).agg(F.sum("part").alias("s"), F.count_if("closes").alias("copies"))
    s = F.col("s") / F.col("copies") if copies_col else F.col("s")
    total = total.withColumn("s", s)
    compound = F.round(F.col("s") / F.sqrt(F.col("s") * F.col("s") + K.NORMALISER), 4)
    copies = [F.col("copies").alias(copies_col)] if copies_col else []
    return total.select(*[k for k in key if k != "_digest" or not copies_col], compound.alias(out_col), *copies)


def with_lexicon_score(
    df: DataFrame, text_col: str, lexicon: DataFrame, out_col: str = "vader_score", **rules
) -> DataFrame:
    """All columns of ``df`` with the score of ``text_col`` added.

    Needs no key: each distinct text is scored once under its digest and joined back, so rows
    may repeat. Copies of one text are folded before the shuffle, and a digest that many rows
    share is split by AQE in the join. ``df`` is read twice: best a stored table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.withColumn("_digest", F.sha2(text, 256))
    distinct = df.select(text.alias("_text")).distinct().withColumn("_digest", F.sha2("_text", 256))
    scores = lexicon_score(distinct, "_text", lexicon, ["_digest"], out_col=out_col, **rules)
    return rows.join(scores, "_digest", "left").drop("_digest").withColumn(
        out_col, F.coalesce(out_col, F.lit(0.0))
    )
