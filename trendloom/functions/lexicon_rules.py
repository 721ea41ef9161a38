"""Fixed values of the published lexicon-and-rule sentiment method (Hutto and Gilbert, 2014)."""

# Degree words and their effect on the next sentiment word.
BOOST = 0.293
INTENSIFIERS: tuple[str, ...] = (
    "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply", "effing",
    "enormously", "entirely", "especially", "exceptionally", "extremely", "fabulously", "flipping",
    "flippin", "fricking", "frickin", "frigging", "friggin", "fully", "fucking", "greatly", "hella",
    "highly", "hugely", "incredibly", "intensely", "majorly", "more", "most", "particularly", "purely",
    "quite", "really", "remarkably", "so", "substantially", "thoroughly", "totally", "tremendously",
    "uber", "unbelievably", "unusually", "utterly", "very",
)
DAMPENERS: tuple[str, ...] = (
    "almost", "barely", "hardly", "kinda", "kind-of", "less", "little", "marginally", "occasionally",
    "kindof", "partly", "scarcely", "slightly", "somewhat", "sorta", "sortof", "sort-of",
)
DAMPENER_PAIRS: tuple[str, ...] = ("just enough", "kind of", "sort of")

# Words that turn the following sentiment around.
NEGATIONS: tuple[str, ...] = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "ain't", "aren't",
    "can't", "couldn't", "daren't", "didn't", "doesn't", "dont", "hadnt", "hasnt", "havent", "isnt",
    "mightnt", "mustnt", "neither", "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't",
    "mustn't", "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing", "nowhere",
    "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent", "oughtn't", "shan't", "shouldn't",
    "uh-uh", "wasn't", "weren't", "without", "wont", "wouldnt", "won't", "wouldn't", "rarely",
    "seldom", "despite",
)

# Phrases with a valence of their own.
IDIOMS: dict[str, float] = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "yeah right": -2.0, "cut the mustard": 2.0,
    "kiss of death": -1.5, "hand to mouth": -2.0,
}

# Marks that may cling to one side of a word.
CLINGING_MARKS: tuple[str, ...] = (
    ".", "!", "?", ",", ";", ":", "-", "'", '"', "!!", "!!!", "??", "???", "?!?", "!?!", "?!?!", "!?!?",
)

# Scalars of the rules.
NEGATION_FACTOR = -0.74
CAPITALS = 0.733
DISTANCE_WEIGHTS = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
NEVER_SO_FACTORS = (1.5, 1.25)
EXCLAMATION, EXCLAMATION_LIMIT = 0.292, 4
QUESTION, QUESTION_LIMIT, QUESTION_MANY = 0.18, 3, 0.96
NORMALISER = 15.0
COMPOUND_DIGITS = 4
