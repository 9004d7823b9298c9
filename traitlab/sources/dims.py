"""Fixed dimensions: questionnaire items (S4) and the country table (S3).

Both are tiny, fixed-size tables; joins against them use ``F.broadcast``
because their size is bounded by construction (50 and at most a few
hundred rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The five item prefixes in raw-file order and the trait score
# each prefix feeds.
PREFIXES = ["EXT", "EST", "AGR", "CSN", "OPN"]
SCORE_OF_PREFIX = {"OPN": "o_score", "CSN": "c_score", "EXT": "e_score", "AGR": "a_score", "EST": "n_score"}
SCORES = ["o_score", "c_score", "e_score", "a_score", "n_score"]
ITEMS = [f"{p}{j}" for p in PREFIXES for j in range(1, 11)]
TIMES = [f"{i}_E" for i in ITEMS]

# Quiz wording and reverse keying per trait, in quiz order.
QUESTIONS = {
    "OPN": [
        ("I have a vivid imagination.", False),
        ("I have excellent ideas.", False),
        ("I am full of ideas.", False),
        ("I am quick to understand things.", False),
        ("I use difficult words.", False),
        ("I spend time reflecting on things.", False),
        ("I am interested in abstract ideas.", False),
        ("I do not have a good imagination.", True),
        ("I have difficulty understanding abstract ideas.", True),
        ("I do not enjoy thinking about theoretical ideas.", True),
    ],
    "CSN": [
        ("I am always prepared.", False),
        ("I follow a schedule.", False),
        ("I get chores done right away.", False),
        ("I pay attention to details.", False),
        ("I like order.", False),
        ("I make plans and stick to them.", False),
        ("I do things according to a plan.", False),
        ("I waste my time.", True),
        ("I do not finish what I start.", True),
        ("I find it difficult to get down to work.", True),
    ],
    "EXT": [
        ("I am the life of the party.", False),
        ("I talk a lot.", False),
        ("I keep in the background.", True),
        ("I do not talk a lot.", True),
        ("I feel comfortable around people.", False),
        ("I start conversations.", False),
        ("I have little to say.", True),
        ("I don’t mind being the center of attention.", False),
        ("I am quiet around strangers.", True),
        ("I am reserved.", True),
    ],
    "AGR": [
        ("I am interested in people.", False),
        ("I sympathize with others’ feelings.", False),
        ("I have a soft heart.", False),
        ("I take time out for others.", False),
        ("I make people feel at ease.", False),
        ("I feel others' emotions.", False),
        ("I have difficulty understanding others.", True),
        ("I am not really interested in others.", True),
        ("I insult people.", True),
        ("I feel little concern for others.", True),
    ],
    "EST": [
        ("I get stressed out easily.", False),
        ("I worry a lot.", False),
        ("I am easily disturbed.", False),
        ("I get upset easily.", False),
        ("I have frequent mood swings.", False),
        ("I get irritated easily.", False),
        ("I often feel blue.", False),
        ("I am relaxed most of the time.", True),
        ("I seldom feel blue.", True),
        ("I do not get stressed out easily.", True),
    ],
}

# Trait descriptions by item prefix, and the fallback text.
TRAIT_DESCRIPTIONS = {
    "EXT": "Extraversion reflects how outgoing, sociable, and energetic a person is. High scorers tend to be assertive and thrive in social environments.",
    "EST": "Emotional Stability relates to emotional volatility. Higher scores indicate greater sensitivity to stress and mood swings.",
    "AGR": "Agreeableness measures warmth, kindness, and cooperation. High scorers are generally empathetic, generous, and supportive.",
    "CSN": "Conscientiousness describes how organized, reliable, and goal-driven a person is. High scorers are often focused, hardworking, and disciplined.",
    "OPN": "Openness to Experience reflects imagination, curiosity, and a preference for variety and novelty.",
}
TRAIT_DESCRIPTION_DEFAULT = "This trait is part of the Big Five personality model."

# Cluster id -> (title, description); unknown ids get the default.
CLUSTER_NAMES = {
    0: ("Cluster 0: The Easygoing Idealist", "You're organized, thoughtful, and emotionally stable. You enjoy structure and value depth over spontaneity.You're intellectually curious and socially cooperative, with decent emotional stability. This combination makes you a flexible team player who can navigate both new ideas and interpersonal dynamics effectively."),
    1: ("Cluster 1:The Content Loner", "You’re imaginative and curious. You march to the beat of your own drum, exploring ideas and concepts with a laid-back attitude and less concern for social conventions."),
    2: ("The Friendly Intellectual", "You’re curious and open-minded, yet grounded. You may be introverted but emotionally secure and thoughtful."),
    3: ("Cluster 3:The People Pleaser", "Practical and emotionally steady, you approach life with measured confidence. You may not seek the spotlight, but you shine in your own way."),
}
CLUSTER_DEFAULT = ("Unknown Cluster", "We couldn’t confidently assign you to a cluster. Try retaking the quiz!")

# Country rows (name, ISO code, region, sub-region,
# intermediate region) for the codes the survey fixture uses.  The full
# 249-row table is read from its CSV with ``country_dim(spark, path)``.
COUNTRIES = [
    ("Antarctica", "AQ", None, None, None),
    ("Australia", "AU", "Oceania", "Australia and New Zealand", None),
    ("Brazil", "BR", "Americas", "Latin America and the Caribbean", "South America"),
    ("Canada", "CA", "Americas", "Northern America", None),
    ("Finland", "FI", "Europe", "Northern Europe", None),
    ("France", "FR", "Europe", "Western Europe", None),
    ("Germany", "DE", "Europe", "Western Europe", None),
    ("India", "IN", "Asia", "Southern Asia", None),
    ("Ireland", "IE", "Europe", "Northern Europe", None),
    ("Italy", "IT", "Europe", "Southern Europe", None),
    ("Malaysia", "MY", "Asia", "South-eastern Asia", None),
    ("Mexico", "MX", "Americas", "Latin America and the Caribbean", "Central America"),
    ("Namibia", "NA", "Africa", "Sub-Saharan Africa", "Southern Africa"),
    ("Netherlands, Kingdom of the", "NL", "Europe", "Western Europe", None),
    ("New Zealand", "NZ", "Oceania", "Australia and New Zealand", None),
    ("Norway", "NO", "Europe", "Northern Europe", None),
    ("Philippines", "PH", "Asia", "South-eastern Asia", None),
    ("Singapore", "SG", "Asia", "South-eastern Asia", None),
    ("South Africa", "ZA", "Africa", "Sub-Saharan Africa", "Southern Africa"),
    ("Spain", "ES", "Europe", "Southern Europe", None),
    ("Sweden", "SE", "Europe", "Northern Europe", None),
    ("Taiwan, Province of China", "TW", None, None, None),
    ("United Kingdom of Great Britain and Northern Ireland", "GB", "Europe", "Northern Europe", None),
    ("United States of America", "US", "Americas", "Northern America", None),
]

COUNTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("sub_region", T.StringType()),
        T.StructField("intermediate_region", T.StringType()),
    ]
)

SCORING_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("prefix", T.StringType(), False),
        T.StructField("item", T.IntegerType(), False),
        T.StructField("reverse_keyed", T.BooleanType(), False),
        T.StructField("question", T.StringType(), False),
    ]
)


def scoring_rows(use_quiz_keys: bool = False) -> list[tuple]:
    """(id, prefix, item, reverse_keyed, question) for the 50 items.

    ``use_quiz_keys`` takes the reverse flags from the quiz; by default all
    items are forward-keyed, which is how the training scores are summed."""
    rows = []
    for p in PREFIXES:
        for j, (q, rev) in enumerate(QUESTIONS[p], start=1):
            rows.append((f"{p}{j}", p, j, bool(rev) if use_quiz_keys else False, q))
    return rows


def scoring_dim(spark: SparkSession, use_quiz_keys: bool = False) -> DataFrame:
    """The 50-row item dimension."""
    return spark.createDataFrame(scoring_rows(use_quiz_keys), SCORING_SCHEMA)


def country_fixture(spark: SparkSession) -> DataFrame:
    """The country rows the survey fixture needs (same columns as the CSV)."""
    return spark.createDataFrame(COUNTRIES, COUNTRY_SCHEMA)
