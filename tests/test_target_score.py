import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxseries.operators.classify import classify, classify_with, train_classifier
from voxseries.operators.joins import is_small
from voxseries.operators.lexicon import lexicon_score, with_lexicon_score
from voxseries.operators.target import targeted, targeted_comments

WORDS = {"pp": ["pp", "right-wing"], "ndp": ["ndp"]}


def found(spark, text, dictionary=WORDS):
    df = spark.createDataFrame([(1, text)], "id int, t string")
    return {r.party: r.targeted_sentence for r in targeted(df, "t", dictionary).collect()}


def test_sentences_that_name_a_group(spark):
    text = "Carney wins! So the right-wing PP lost.  ok ppx? pp"
    assert found(spark, text) == {"pp": "so the right-wing pp lost. pp"}


@pytest.mark.parametrize("text,groups", [
    ("éndp x", set()), ("ndp's day", {"ndp"}), ("the NDP and the PP", {"ndp", "pp"}),
    (None, set()), ("...!?", set()), ("", set()), ("right\nwing", set()), ("ndp", {"ndp"}),
    ("a\nndp\nb", {"ndp"}),
])
def test_who_is_named(spark, text, groups):
    assert set(found(spark, text)) == groups


def test_newline_does_not_cut(spark):
    assert found(spark, "x ndp\ny. z")["ndp"] == "x ndp\ny"


def test_title_names_the_group_for_every_comment(spark):
    df = spark.createDataFrame(
        [("a", "On Carney", "fine", 1735689600), ("b", "", "nothing", 1735689600)],
        "id string, title string, body string, created_utc long")
    rows = targeted_comments(df, zone="America/Vancouver").collect()
    assert [(r.id, r.party, r.targeted_sentence, str(r.date), r.week) for r in rows] == [
        ("a", "Liberal", "on carney fine", "2024-12-31", 1)]
    assert rows[0].full_text == "On Carney fine"


def test_targeting_needs_no_shuffle(spark):
    df = spark.createDataFrame([(1, "ndp")], "id int, t string")
    plan = targeted(df, "t", WORDS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


LEXICON = {
    "smart": 1.7, "handsome": 2.2, "funny": 1.9, "horrible": -2.5, "good": 1.9, "great": 3.1,
    "kind": 2.4, "bad": -2.5, "uncompelling": -0.9, "no": -1.2, "doubt": -1.5, "yeah": 1.2,
}


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(list(LEXICON.items()), "word string, valence double")


def score_all(spark, lexicon, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    return [r.vader_score for r in lexicon_score(df, "t", lexicon, ["id"]).orderBy("id").collect()]


# Published examples of the method, and cases worked out by hand from its rules.
CASES = [
    ("VADER is smart, handsome, and funny.", 0.8316),
    ("VADER is very smart, handsome, and funny.", 0.8545),
    ("VADER is not smart, handsome, nor funny.", -0.7424),
    ("At least it isn't a horrible book.", 0.431),
    ("The book was only kind of good.", 0.3832),
    ("The plot was good, but the characters are uncompelling and the dialog is not great.", -0.7042),
    ("Not bad at all", 0.431),
    ("The book was good.", 0.4404),
    (None, 0.0), ("", 0.0), ("   ", 0.0), ("nothing known here", 0.0),
]


def test_published_scores(spark, lexicon):
    got = score_all(spark, lexicon, [t for t, _ in CASES])
    assert got == pytest.approx([s for _, s in CASES], abs=1e-9)


def brute(text, lexicon=LEXICON):
    """The rules once more, one token at a time, for random texts."""
    from voxseries import constants as K

    def bare(t):
        s = t.strip(K.PUNCTUATION)
        return s if len(s) > 2 else t

    ws = [bare(t) for t in text.lower().split()]
    at = lambda i: ws[i] if 0 <= i < len(ws) else None
    but = ws.index("but") if "but" in ws else None
    total = 0.0
    for i, w in enumerate(ws):
        if w not in lexicon or w in K.BOOSTERS or (w == "kind" and at(i + 1) == "of"):
            continue
        p = [None, at(i - 1), at(i - 2), at(i - 3)]
        v = lexicon[w]
        if "no" in (p[1], p[2]) or (p[3] == "no" and p[1] in ("or", "nor")):
            v = v * K.NEGATION_WEIGHT
        elif w == "no" and at(i + 1) in lexicon:
            v = 0.0
        for k in (1, 2, 3):
            q = p[k]
            if q is None or q in lexicon:
                continue
            d = K.BOOSTERS.get(q, 0.0) * K.DISTANCE_DAMPING[k - 1]
            v += -d if v < 0 else d
            between = p[1:k]
            if k > 1 and q == "never" and any(b in ("so", "this") for b in between):
                v *= K.NEVER_SO_WEIGHT
            elif k > 1 and q == "without" and "doubt" in between:
                pass
            elif q in K.NEGATORS or "n't" in q:
                v *= K.NEGATION_WEIGHT
        if p[3] is not None and p[3] not in lexicon:
            join = lambda *t: " ".join(t) if None not in t else None
            n1, n2 = at(i + 1), at(i + 2)
            for t in ((w, n1, n2), (w, n1), (p[1], w), (p[2], p[1], w), (p[2], p[1]),
                      (p[3], p[2], p[1]), (p[3], p[2])):
                if join(*t) in K.IDIOMS:
                    v = K.IDIOMS[join(*t)]
                    break
            for t in ((p[3], p[2], p[1]), (p[3], p[2]), (p[2], p[1])):
                v += K.BOOSTERS.get(join(*t), 0.0) if " " in join(*t) else 0.0
        if p[1] == "least" and p[1] not in lexicon and p[2] not in ("at", "very"):
            v *= K.NEGATION_WEIGHT
        if but is not None:
            v *= K.BEFORE_BUT_WEIGHT if i < but else K.AFTER_BUT_WEIGHT if i > but else 1.0
        total += v
    return round(total / (total * total + K.NORMALISER) ** 0.5, 4)


def random_texts(n=400):
    rng = np.random.default_rng(5)
    pool = [*LEXICON, "very", "never", "so", "this", "without", "isn't", "not", "but", "least", "at", "or",
            "kind", "of", "hardly", "right", "the", "shit", "plain", "word,", "(good)", "to", "die", "for"]
    return [" ".join(rng.choice(pool, rng.integers(1, 14))) for _ in range(n)]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_rules_against_brute_force(spark, lexicon, threshold, monkeypatch):
    """Also with no broadcast at all, as for a lexicon too large for one."""
    import voxseries.operators.lexicon as module

    if threshold == "-1":
        monkeypatch.setattr(module, "is_small", lambda table: False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        texts = random_texts()
        assert score_all(spark, lexicon, texts) == pytest.approx([brute(t) for t in texts], abs=1.01e-4)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_equal_rows_fold_into_copies(spark, lexicon):
    df = spark.createDataFrame(
        [("a", "good"), ("a", "good"), ("a", "bad"), ("b", "good"), ("b", None), ("b", None)], "g string, t string")
    rows = lexicon_score(df, "t", lexicon, ["g"], copies_col="n").collect()
    assert sorted((r.g, r.vader_score, r.n) for r in rows) == [
        ("a", -0.5423, 1), ("a", 0.4404, 2), ("b", 0.0, 2), ("b", 0.4404, 1)]
    wide = with_lexicon_score(df, "t", lexicon).collect()
    assert sorted((r.g, r.vader_score) for r in wide) == [
        ("a", -0.5423), ("a", 0.4404), ("a", 0.4404), ("b", 0.0), ("b", 0.0), ("b", 0.4404)]


def test_broadcast_only_what_was_measured(spark, lexicon):
    assert is_small(lexicon) and not is_small(lexicon, rows=3) and not is_small(lexicon, chars=10)
    plan = lexicon_score(
        spark.createDataFrame([(1, "x")], "id int, t string"), "t", lexicon, ["id"]
    )._jdf.queryExecution().executedPlan().toString()
    # One shuffle, of the sums; the tokens are joined where they are.
    assert plan.count("Exchange hashpartitioning") == 1


def test_classes_of_a_hook(spark):
    def fake_model():
        return lambda texts: np.array([[float("bad" in t), 0.5, float("good" in t)] for t in texts])

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["bad", "good", "x", None, "", "  "])], "id int, t string")
    got = [r.trans_sentiment for r in classify(df, "t", fake_model, batch=2).orderBy("id").collect()]
    assert got == [0, 2, 1, 1, 1, 1]


def test_default_classifier(spark):
    rows = [(f"{w} {x}", c) for (w, c), x in itertools.product(
        [("awful thing", 0), ("plain thing", 1), ("lovely thing", 2)], "abcd")]
    model = train_classifier(spark.createDataFrame(rows, "t string, y int"), "t", "y", features=256)
    df = spark.createDataFrame([("awful z",), ("lovely z",), (None,), (" ",), ("z z z z lovely",)], "t string")
    got = [r.trans_sentiment for r in classify_with(df, "t", model).collect()]
    assert got[:4] == [0, 2, 1, 1] and got[4] == 2
    short = df.filter(F.col("t").contains("z z"))
    assert classify_with(short, "t", model, max_tokens=2).count() == 1
