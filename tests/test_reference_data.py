"""The fixed values, written out a second time: the SQL reads the lists it is compared with."""

from feedstream import reference_data as fixed


def test_labels_limits_and_names():
    assert fixed.SENTIMENT_LABELS == ["negative", "neutral", "positive"]
    assert (fixed.INPUT_TOPIC, fixed.RESULTS_TOPIC) == ("rss_hn_feed", "analyzed_results")
    assert (fixed.RECENT_KEPT, fixed.TIMELINE_POINTS, fixed.RECENT_SHOWN, fixed.TOP_CATEGORIES) == (500, 100, 15, 5)
    assert (fixed.HN_LIST_LENGTH, fixed.TITLE_CHARS, fixed.MIN_TEXT_LENGTH, fixed.MODEL_TEXT_CHARS) == (200, 100, 10, 512)
    assert (fixed.ANALYSIS_TRIGGER, fixed.POLL_TRIGGER, fixed.LINGER_MS) == ("10 seconds", "30 seconds", 500)


def test_word_lists():
    assert list(fixed.CATEGORIES_OLDER) == ["AI", "Cybersecurity", "Finance", "Health", "Sports"]
    assert fixed.CATEGORIES_OLDER["Sports"] == ["football", "nba", "soccer", "tennis"]
    assert list(fixed.CATEGORIES_MAIN)[0] == "AI & Machine Learning" and len(fixed.CATEGORIES_MAIN) == 6
    assert fixed.INGEST_KEYWORDS["Startups"] == ["startup", "innovation", "entrepreneur", "founder"]
    assert sum(map(len, fixed.FEED_REGISTRY.values())) == 14
