"""Fixed English word lists used by the text functions.

Every value below is a fixed value: the top-word and sentiment results are
only comparable with other tools when these lists are exactly the published
ones (the customary English stop-word list; the modifier lists of the VADER
sentiment rule, Hutto & Gilbert 2014).  The valence lexicon itself is caller
data and is not kept here.
"""

# English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so
than too very s t can will just don don't should should've now d ll m o re ve
y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't
shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn
wouldn't
""".split()

# Words that negate the word after them.
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't
daren't didn't doesn't dont hadnt hasnt havent isnt mightnt mustnt neither
don't hadn't hasn't haven't isn't mightn't mustn't neednt needn't never none
nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't
shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't wouldn't
rarely seldom despite
""".split()

# Words that strengthen the word after them.
INTENSIFIERS = """
absolutely amazingly awfully completely considerably decidedly deeply effing
enormously entirely especially exceptionally extremely fabulously flipping
flippin fricking frickin frigging friggin fully fucking greatly hella highly
hugely incredibly intensely majorly more most particularly purely quite really
remarkably so substantially thoroughly totally tremendously uber unbelievably
unusually utterly very
""".split()

# Words that weaken the word after them, and such word pairs.
DAMPENERS = """
almost barely hardly kinda kindof kind-of less little marginally occasionally
partly scarcely slightly somewhat sorta sortof sort-of
""".split()
DAMPENER_PAIRS = ["just enough", "kind of", "sort of"]

# Idioms whose valence replaces that of their words.
IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "yeah right": -2.0,
    "cut the mustard": 2.0,
    "kiss of death": -1.5,
    "hand to mouth": -2.0,
}

# The punctuation that may hang on one side of a word.
HANGING_PUNCTUATION = [
    ".", "!", "?", ",", ";", ":", "-", "'", '"',
    "!!", "!!!", "??", "???", "?!?", "!?!", "?!?!", "!?!?",
]

# Weights of the sentiment rule.
BOOST = 0.293
CAPS_BOOST = 0.733
NEGATION_FACTOR = -0.74
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
EXCLAMATION_WEIGHT = 0.292
MAX_EXCLAMATIONS = 4
QUESTION_WEIGHT = 0.18
MAX_QUESTION_WEIGHT = 0.96
NORMALISER = 15.0
POSITIVE_FROM = 0.05
NEGATIVE_UP_TO = -0.05
