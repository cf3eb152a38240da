from pyspark.sql import Column
from pyspark.sql import functions as F

# What holds a word together, and which words are kept.
# A combining mark belongs to a word only when it follows a letter or a digit.
# The quantifiers are possessive, so the matcher neither backtracks nor recurses
# on very long runs such as a line of underscores.
WORD_RUN = r"(?:[\p{L}\p{Nd}]++\p{Mn}*+|_++)++"
PLAIN_WORD = r"[a-z]++(?![\p{L}\p{Nd}_\p{Mn}])"


def plain_words(text: Column) -> Column:
    """Array of the lower-cased words of ``text`` that consist of ``a-z`` only.

    Letters, digits and ``_`` hold together, so ``foo_bar``, ``abc1`` and ``café``
    are one word each and dropped whole, while ``don't`` is two. Every match takes
    a whole run; only plain ones are captured. Lower-casing the text once moves no
    word boundary and is cheaper than lower-casing each word.
    """
    captured = F.regexp_extract_all(F.lower(text), F.lit(f"({PLAIN_WORD})|{WORD_RUN}"), F.lit(1))
    return F.filter(captured, lambda word: word != "")
