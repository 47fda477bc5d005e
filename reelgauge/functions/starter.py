"""A small English lexicon to start with; real runs bring their own table or model."""

POSITIVE = [
    "amazing", "awesome", "beautiful", "best", "brilliant", "cool", "excellent", "excited",
    "fantastic", "fun", "good", "great", "happy", "hyped", "incredible", "love", "masterpiece",
    "nice", "perfect", "stunning", "superb", "wonderful", "wow",
]

NEGATIVE = [
    "awful", "bad", "boring", "cringe", "disappointed", "disappointing", "dull", "fail", "garbage",
    "hate", "horrible", "lame", "mess", "mid", "poor", "ridiculous", "sad", "stupid", "terrible",
    "trash", "ugly", "waste", "worst",
]
