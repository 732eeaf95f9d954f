"""Fixed word lists and small dictionaries.

FIXED VALUES — these must equal the lists the review-mining rules were
written against; they are data, kept here in natural order.
"""

# FIXED VALUES: product pronouns (aspect "product" substitution and the
# stop-word exemption), in this order.
PRODUCT_PRONOUNS = ["it", "this", "that", "they", "these", "those"]

# FIXED VALUES: negation words of the determiner rule (amod rule).
NEGATION_WORDS = ["no", "not", "none", "nobody", "nothing", "neither",
                  "nowhere", "never", "hardly", "scarcely"]

# FIXED VALUES: class code of a rating: >= 4 positive, > 2 neutral, else negative.
POSITIVE_THRESHOLD = 4
NEGATIVE_THRESHOLD = 2
CLASS_NAMES = ["negative", "neutral", "positive"]

# FIXED VALUES: scalars of the published lexicon-based phrase scorer
# (Hutto & Gilbert, ICWSM 2014): booster increment, negation scalar,
# normalisation constant alpha, and the decay of boosters two and three
# words back.
BOOSTER_INCREMENT = 0.293
NEGATION_SCALAR = -0.74
NORMALIZE_ALPHA = 15.0
BOOSTER_DECAY = [1.0, 0.95, 0.9]

# FIXED VALUES: negation words of the published phrase scorer.
SCORER_NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt",
    "ain't", "aren't", "can't", "couldn't", "daren't", "didn't", "doesn't",
    "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither",
    "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't",
    "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing", "nowhere",
    "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
    "oughtn't", "shan't", "shouldn't", "uh-uh", "wasn't", "weren't",
    "without", "wont", "wouldnt", "won't", "wouldn't", "rarely", "seldom", "despite",
]

# FIXED VALUES: booster words of the published phrase scorer (one word each;
# its entries of several words never match a single word).
BOOSTERS_UP = [
    "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly",
    "deeply", "effing", "enormously", "entirely", "especially", "exceptionally",
    "extremely", "fabulously", "flipping", "flippin", "fricking", "frickin",
    "frigging", "friggin", "fully", "fucking", "greatly", "hella", "highly", "hugely",
    "incredibly", "intensely", "majorly", "more", "most", "particularly", "purely",
    "quite", "really", "remarkably", "so", "substantially", "thoroughly", "totally",
    "tremendously", "uber", "unbelievably", "unusually", "utterly", "very",
]
BOOSTERS_DOWN = [
    "almost", "barely", "hardly", "kinda", "kindof", "kind-of", "less", "little",
    "marginally", "occasionally", "partly", "scarcely", "slightly", "somewhat",
    "sorta", "sortof", "sort-of",
]
DEFAULT_BOOSTERS = [(w, BOOSTER_INCREMENT) for w in BOOSTERS_UP] + [(w, -BOOSTER_INCREMENT) for w in BOOSTERS_DOWN]

# FIXED VALUES: boosters of two words, idioms and their valences, emphasis of
# capitals and of marks, and the weights of "never so / this" and "but" in the
# published phrase scorer.
BOOSTER_PHRASES = [("just enough", -0.293), ("kind of", -0.293), ("sort of", -0.293)]
IDIOMS = [
    ("the shit", 3.0), ("the bomb", 3.0), ("bad ass", 1.5), ("yeah right", -2.0),
    ("cut the mustard", 2.0), ("kiss of death", -1.5), ("hand to mouth", -2.0),
]
CAPITALS_INCREMENT = 0.733
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, MANY_QUESTIONS = 0.18, 0.96
NEVER_SO = [1.5, 1.25]
BEFORE_BUT, AFTER_BUT = 0.5, 1.5

# FIXED VALUES: emoticons removed by the cleaning step, in this order.
EMOTICONS = [":|", ":)", ":(", ":/"]

# FIXED VALUES: ASCII punctuation removed by the cleaning step (Python's
# string.punctuation, in its order).
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Fixed-length encoding: special ids, then words by descending frequency.
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
FIRST_WORD_ID = 4
MAX_LEN = 512
