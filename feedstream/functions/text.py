"""Text clean-up and measures."""

from pyspark.sql import functions as F

from feedstream.reference_data import WHITESPACE


def combine_text(title, summary):
    """Title, a space, summary; line breaks become spaces; the ends are stripped."""
    joined = F.concat(
        F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(summary, F.lit(""))
    )
    one_line = F.replace(F.replace(joined, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(" "))
    return F.btrim(one_line, F.lit(WHITESPACE))


def word_count(text):
    """Pieces between single spaces: '' has one, 'a  b ' has four, NULL has NULL."""
    return F.size(F.split(text, " "))


def model_text(text, max_chars=None):
    """What a classifier sees: never NULL, whole unless max_chars is given."""
    filled = F.coalesce(text, F.lit(""))
    return filled if max_chars is None else F.substring(filled, 1, max_chars)


def letter_words(text):
    """Lower-case runs of letters; a text that starts or ends otherwise adds empty pieces.

    The possessive form never looks back and is the fastest of the equivalent patterns.
    """
    return F.split(F.lower(text), r"\P{L}++")


def words_in(text, vocabulary):
    """The words of the text that occur in the vocabulary, repeats kept."""
    return F.filter(letter_words(text), lambda word: word.isin(list(vocabulary)))
