"""Line-first quality rules.

Every line is judged on its own: separators of menus, stock phrases, symbols, shouting,
repetition and the punctuation at its end. Failing lines go, and a document that loses
too much of its text with them is rejected.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.llm.lattice import values

SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›·•"
# Phrases of page furniture, in lower case.
PHRASES = (
    "accept all cookies",
    "add to cart",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "forgot your password",
    "javascript is disabled",
    "log in to",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "share on facebook",
    "sign up for",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "use of cookies",
)
ENDING = re.compile(r"""[.!?…:;]["'”’»)\]]*$""")
SENTENCE = re.compile(r"""[.!?…]["'”’»)\]]* """)
WHITE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class QualityRules:
    """Limits of the line rules and of the verdict."""

    min_separators: int = 3
    words_per_separator: int = 5
    words_per_symbol: int = 2
    min_words_to_judge: int = 3
    repeated_line_words: int = 10
    repeated_line_share: float = 0.2
    paragraph_words: int = 20
    min_kept_share: float = 0.5


def line_fault(line: str, rules: QualityRules, with_phrases: bool = True) -> str:
    """The first rule that a line breaks, or an empty string. Blank lines break none."""
    line = line.strip(WHITE)
    if not line:
        return ""
    words = line.encode().split()
    n = len(words)
    separators = sum(map(line.count, SEPARATORS))
    if separators >= rules.min_separators and separators * rules.words_per_separator >= n:
        return "navigation"
    if with_phrases:
        low = line.lower()
        if any(p in low for p in PHRASES):
            return "boilerplate"
    if n >= rules.min_words_to_judge:
        if sum(map(line.count, SYMBOLS)) * rules.words_per_symbol > n:
            return "symbols"
        if line.isupper():
            return "shouting"
    if n >= rules.repeated_line_words and len(set(words)) < rules.repeated_line_share * n:
        return "repetition"
    if ENDING.search(line) or (n >= rules.paragraph_words and SENTENCE.search(line)):
        return ""  # the end of a paragraph of sentences may be cut off
    return "punctuation"


def repeated_words(words: list[bytes]) -> int:
    """Words inside any window of three words that the text holds twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    w = np.fromiter((numbers.setdefault(x, len(numbers)) for x in words), np.int64, len(words))
    _, pair = np.unique(w[:-1] * len(numbers) + w[1:], return_inverse=True)
    _, which, n = np.unique(pair[:-1] * len(numbers) + w[2:], return_inverse=True, return_counts=True)
    again = n[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def judge(text: str | None, rules: QualityRules) -> tuple:
    text = text or ""
    words = text.encode().split()
    n = len(words)
    lines = text.split("\n")
    seen: set[str] = set()
    dup_lines = kept_chars = all_chars = 0
    low = text.lower()
    phrases = any(p in low for p in PHRASES)
    clean = []
    for line in lines:
        if bare := line.strip(WHITE):
            dup_lines += line in seen
            seen.add(line)
            all_chars += len(bare)
            if line_fault(line, rules, phrases):
                continue
            kept_chars += len(bare)
        clean.append(line)
    repeats = repeated_words(words)
    failed = n < 50 or 100 * repeats > 50 * n
    white = sum(map(text.count, WHITE))
    kept = not failed and kept_chars >= rules.min_kept_share * all_chars
    return (
        n,
        len(text) - white,
        sum(map(text.count, SYMBOLS)),
        dup_lines,
        repeats,
        failed,
        kept,
        len(lines) - len(clean),
        kept_chars / all_chars if all_chars else 1.0,
        "\n".join(clean),
    )


RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines_dropped long, kept_share double, clean_text string"
)
ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: QualityRules = QualityRules()
) -> DataFrame:
    """Judge every document; one row per input row, in the columns of ``RESULT`` after ``doc_id``.

    ``clean_text`` is the text without its failing lines. A null text is an empty one: it has
    no words, so ``base_failed`` is true and ``kept`` false. Repeated ids are judged row by row;
    other columns of the input are ignored. An empty table gives an empty result.
    """
    fields = [part.split() for part in RESULT.split(", ")]

    @F.arrow_udf(RESULT)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            columns = zip(*(judge(t, rules) for t in values(texts)), strict=True) if len(texts) else [[]] * len(fields)
            arrays = [pa.array(c, ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
            yield pa.StructArray.from_arrays(arrays, [name for name, _ in fields])

    return docs.select(F.col(id_col).alias("doc_id"), judged(F.col(text_col)).alias("judged")).select(
        "doc_id", "judged.*"
    )
