"""Default parameters. Every one of them can be replaced by an argument."""

# Communities whose discussion is kept.
COMMUNITIES = [
    "canada", "canadanews", "canadapolitics", "canadianpolitics",
    "lpc", "cpc", "ndp", "canadianconservative",
]

# Texts that stand for a removed comment.
PLACEHOLDERS = ["[deleted]", "[removed]"]

# Keys a raw record must carry.
COMMENT_KEYS = [
    "id", "link_id", "parent_id", "subreddit", "author",
    "created_utc", "score", "body", "permalink",
]
SUBMISSION_KEYS = ["id", "subreddit", "title"]

# Prefix of a thread reference.
THREAD_PREFIX = "t3_"

# Keywords that name each group.
GROUP_KEYWORDS = {
    "Liberal": [
        "trudeau", "justin trudeau", "liberal", "liberals",
        "lpc", "carney", "freeland", "chrystia freeland",
    ],
    "Conservative": [
        "poilievre", "pierre poilievre", "conservative", "conservatives",
        "cpc", "tory", "tories", "trump", "maga", "right wing", "right-wing",
        "right populist", "far right", "lower taxes", "inflation", "pp",
    ],
    "NDP": [
        "ndp", "new democratic", "singh", "jagmeet", "jagmeet singh",
        "orange crush", "progressive left", "left wing", "left-wing",
    ],
}

# Poll column of each group, poll columns, and the two sentiment measures.
POLL_COLUMNS = {"Liberal": "lpc", "Conservative": "cpc", "NDP": "ndp"}
POLL_VALUES = ["lpc", "cpc", "ndp", "oth"]
MEASURES = ["vader_avg", "trans_pos_ratio"]

# Class codes of the three-class scorer.
NEGATIVE, NEUTRAL, POSITIVE = 0, 1, 2

# Lags tried per grain, event day, last charted week, first day of week label 1.
WEEKLY_LAGS = [0, 1]
DAILY_LAGS = [0, 1, 2, 3, 4, 5]
EVENT_DAY = "2025-04-27"
LAST_WEEK = 17
WEEK_ONE = "2025-01-06"

# Code points Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# ASCII punctuation trimmed from a token by the lexicon scorer.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Negating words (Hutto and Gilbert, 2014).
NEGATORS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt",
    "ain't", "aren't", "can't", "couldn't", "daren't", "didn't", "doesn't",
    "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither",
    "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't",
    "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing", "nowhere",
    "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
    "oughtn't", "shan't", "shouldn't", "uh-uh", "wasn't", "weren't",
    "without", "wont", "wouldnt", "won't", "wouldn't", "rarely", "seldom", "despite",
]

# Degree words that strengthen or weaken what follows (same source).
STRENGTHENERS = [
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably",
    "decidedly", "deeply", "effing", "enormous", "enormously", "entirely", "especially",
    "exceptional", "exceptionally", "extreme", "extremely", "fabulously", "flipping",
    "flippin", "frackin", "fracking", "fricking", "frickin", "frigging", "friggin",
    "fully", "fuckin", "fucking", "fuggin", "fugging", "greatly", "hella", "highly",
    "hugely", "incredible", "incredibly", "intensely", "major", "majorly", "more", "most",
    "particularly", "purely", "quite", "really", "remarkably", "so", "substantially",
    "thoroughly", "total", "totally", "tremendous", "tremendously", "uber",
    "unbelievably", "unusually", "utter", "utterly", "very",
]
WEAKENERS = [
    "almost", "barely", "hardly", "just enough", "kind of", "kinda", "kindof", "kind-of",
    "less", "little", "marginal", "marginally", "occasional", "occasionally", "partly",
    "scarce", "scarcely", "slight", "slightly", "somewhat",
    "sort of", "sorta", "sortof", "sort-of",
]
DEGREE_STEP = 0.293
BOOSTERS = {w: DEGREE_STEP for w in STRENGTHENERS} | {w: -DEGREE_STEP for w in WEAKENERS}

# Phrases with a valence of their own, and the rule weights (same source).
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0,
    "yeah right": -2.0, "kiss of death": -1.5, "to die for": 3.0,
    "beating heart": 3.1, "broken heart": -2.9,
}
NEGATION_WEIGHT = -0.74
NEVER_SO_WEIGHT = 1.25
DISTANCE_DAMPING = [1.0, 0.95, 0.9]
BEFORE_BUT_WEIGHT, AFTER_BUT_WEIGHT = 0.5, 1.5
NORMALISER = 15.0
