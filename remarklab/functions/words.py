"""A small English seed lexicon and modifier list, for use where no lexicon table is given.

Valences and their words are our own choice. Negations and boosters are common English function words
and adverbs in the sense of the published VADER paper (Hutto and Gilbert, 2014; its word lists are under
the MIT licence), without its multi-word entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Our own seed valences on a scale from -4 to 4.
SEED_VALENCES = {
    3.0: "amazing awesome brilliant excellent fantastic love outstanding perfect superb wonderful",
    2.2: "beautiful best delighted enjoy glad grateful great happy impressive joy proud success thrilled win",
    1.5: "agree benefit better cheerful clean fair friendly fun good help helpful hope hopeful improve kind "
         "like nice peace protect safe smart solve solution strong support thank thanks true trust welcome wise",
    0.8: "fine interesting okay progress ready sure useful",
    -0.8: "doubt late odd slow unsure weird",
    -1.5: "angry annoying bad boring concern confused damage deny dirty dumb fail false fake fear ignore lack lazy "
          "loss lost mess poor problem risk sad scared sorry stupid threat ugly unfair upset weak worried worry wrong",
    -2.2: "abuse attack awful corrupt crisis cruel danger dangerous disaster disgusting harm hurt lie lies pain "
          "pollute shame suffer terrible toxic tragic violence worse",
    -3.0: "catastrophe death destroy devastating die evil hate horrible horrific kill murder worst",
}
SEED_NEGATIONS = (
    "aint arent cannot cant couldnt didnt doesnt dont hadnt hasnt havent isnt neither never no nobody none nope "
    "nor not nothing nowhere rarely seldom shouldnt wasnt werent without wont wouldnt"
)
SEED_BOOSTERS = {
    0.293: "absolutely amazingly completely considerably decidedly deeply enormously entirely especially "
           "extremely fully greatly highly hugely incredibly intensely particularly purely quite really "
           "remarkably so substantially thoroughly totally tremendously unbelievably utterly very",
    -0.293: "almost barely hardly kinda less little marginally occasionally partly scarcely slightly somewhat",
}


def seed_lexicon(spark: SparkSession) -> DataFrame:
    rows = [(word, value) for value, words in SEED_VALENCES.items() for word in words.split()]
    return spark.createDataFrame(rows, "token string, valence double")


def seed_modifiers(spark: SparkSession) -> DataFrame:
    rows = [(word, "negate", None) for word in SEED_NEGATIONS.split()]
    rows += [(word, "booster", weight) for weight, words in SEED_BOOSTERS.items() for word in words.split()]
    return spark.createDataFrame(rows, "token string, kind string, weight double")
