"""Fixed values that results depend on."""

# Publishers whose videos are analysed.
STUDIOS = [
    "Warner Bros.", "DC", "Marvel Entertainment", "Netflix", "Sony Pictures Entertainment",
    "20th Century Studios", "Universal Pictures", "Paramount Pictures", "Disney", "Pixar",
    "Lionsgate Movies", "Legendary", "New Line Cinema",
]

# Phrases a video title is searched for.
SEARCH_PHRASES = [
    "official trailer", "teaser trailer", "official teaser", "movie trailer", "new trailer",
    "film trailer", "teaser clip", "upcoming movie", "official clip",
]

# Address prefix, cut word of the movie key, working parameters.
WATCH_URL = "https://www.youtube.com/watch?v="
CUT_WORD = "trailer"
PERIOD_DAYS = 90
TOP_VIDEOS = 100
NEW_COMMENT_CAP = 200_000
TOP_ENTITIES = 10
NUM_TOPICS = 5
TOPIC_ITERATIONS = 10
VOCABULARY_SIZE = 500
MIN_DOCUMENTS = 5
TERMS_PER_TOPIC = 10
LEARNING_OFFSET = 1024.0
LEARNING_DECAY = 0.51
SUBSAMPLING_RATE = 0.05

LABELS = ["positive", "negative", "neutral"]

# The default English stop words of Spark's StopWordsRemover.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd",
    "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's",
    "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
]
