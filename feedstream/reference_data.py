"""Fixed values of the data model: word lists, registries, labels and limits.

The order of every mapping is part of its meaning: the first match wins and ties go to the
first declared name.
"""

# --- fixed values -------------------------------------------------------------------------

FEED_REGISTRY = {
    "Actualité": [
        "https://www.lemonde.fr/rss/une.xml",
        "https://www.france24.com/fr/rss",
        "https://www.reutersagency.com/feed/?best-topics=business-finance&post_type=best",
        "https://feeds.bbci.co.uk/news/rss.xml",
    ],
    "Technologie": [
        "https://rss.nytimes.com/services/xml/rss/nyt/Technology.xml",
        "https://www.theverge.com/rss/index.xml",
        "https://feeds.arstechnica.com/arstechnica/technology",
        "https://techcrunch.com/feed/",
    ],
    "Finance": [
        "https://www.ft.com/?format=rss",
        "https://www.bloomberg.com/feed/podcast/etf-report.xml",
    ],
    "Science": [
        "https://www.sciencemag.org/rss/news_current.xml",
        "https://www.nature.com/nature.rss",
    ],
    "Startups": [
        "https://www.startupmagazine.fr/feed/",
        "https://www.eu-startups.com/feed/",
    ],
}

# Substring keywords that tag an article while it is ingested.
INGEST_KEYWORDS = {
    "Actualité": ["actualité", "france", "monde", "news"],
    "Technologie": ["tech", "ai", "machine learning", "software", "startup", "innovation"],
    "Finance": ["finance", "stock", "market", "business", "deal", "investment"],
    "Science": ["science", "research", "space", "physics", "biology", "covid", "medical"],
    "Startups": ["startup", "innovation", "entrepreneur", "founder"],
}
DEFAULT_CATEGORY = "General"
HN_DEFAULT_CATEGORY = "HN"

# Categories of the classifier: the six of the main job, the five of the older one.
CATEGORIES_MAIN = {
    "AI & Machine Learning": [
        "machine learning", "deep learning", "neural", "ai", "artificial intelligence",
        "transformer", "llm", "gpt",
    ],
    "Cybersecurity": [
        "security", "hacking", "phishing", "malware", "breach", "vulnerability", "exploit",
        "encryption",
    ],
    "Finance & Crypto": [
        "stock", "market", "price", "deal", "bitcoin", "crypto", "trading", "investment",
    ],
    "Health & Medicine": [
        "covid", "vaccine", "health", "virus", "medical", "disease", "treatment", "pandemic",
    ],
    "Technology": [
        "programming", "software", "developer", "code", "github", "cloud", "api", "framework",
    ],
    "Science": [
        "research", "study", "discovery", "experiment", "quantum", "physics", "biology",
    ],
}
CATEGORIES_OLDER = {
    "AI": ["machine learning", "deep learning", "neural", "ai", "artificial intelligence"],
    "Cybersecurity": ["security", "hacking", "phishing", "malware"],
    "Finance": ["stock", "market", "price", "deal"],
    "Health": ["covid", "vaccine", "health", "virus"],
    "Sports": ["football", "nba", "soccer", "tennis"],
}

# Class index -> label of the sentiment model.
SENTIMENT_LABELS = ["negative", "neutral", "positive"]

# What the results view shows for a missing key.
RESULT_DEFAULTS = {
    "source": "unknown",
    "title": "No title",
    "sentiment": "neutral",
    "predicted_category": "uncategorized",
    "by": "unknown",
    "word_count": 0,
}

INPUT_TOPIC = "rss_hn_feed"
RESULTS_TOPIC = "analyzed_results"
ANALYSIS_TRIGGER = "10 seconds"
POLL_TRIGGER = "30 seconds"
VIEW_TRIGGER = "2 seconds"
LINGER_MS = 500
HN_LIST_LENGTH = 200
MIN_TEXT_LENGTH = 10
MODEL_TEXT_CHARS = 512
TITLE_CHARS = 100
RECENT_KEPT = 500
RECENT_SHOWN = 15
TIMELINE_POINTS = 100
TOP_CATEGORIES = 5
CONSOLE_ROWS = 3

# Characters that count as white space when the ends of a text are stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- own values ---------------------------------------------------------------------------

# Default words of the lexicon scorer; any other lists can be passed instead.
POSITIVE_WORDS = [
    "good", "great", "excellent", "best", "better", "love", "loved", "happy", "success",
    "successful", "win", "wins", "won", "growth", "gain", "gains", "improve", "improved",
    "amazing", "awesome", "positive", "breakthrough", "strong", "benefit",
]
NEGATIVE_WORDS = [
    "bad", "worse", "worst", "terrible", "awful", "hate", "hated", "sad", "fail", "failed",
    "failure", "loss", "losses", "lost", "decline", "crash", "crisis", "negative", "weak",
    "war", "attack", "breach", "fraud", "problem",
]
