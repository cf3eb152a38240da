"""Personal data: fixed patterns, and a conditional random field over word shapes for the rest.

The patterns find what is written in the usual way. The field is trained from a small labelled
table of word shapes and adds what they miss: masked or spelled-out addresses, national phone
numbers, cards with other separators, access tokens. Its spans are checked for the digits and
marks of their kind, and never touch a span of the patterns.
"""

import random
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.llm.crf import ChainCRF
from tallygraph.llm.lattice import blocks, values

KINDS = ("email", "ip", "card", "phone", "secret")
BACKGROUND = "none"
# A value's first token has its kind as label, the others are inside. So values side by side stay apart.
INSIDE = "+"
LABELS = [BACKGROUND, *KINDS, *(kind + INSIDE for kind in KINDS)]
MAX_EXAMPLES = 2_000

# The patterns. No start inside a run of digits can do better than the run's own.
MAIL_LEFT = re.compile(r"[A-Za-z0-9._%+-]")
MAIL_RIGHT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
# A line without these has plain words only.
UNUSUAL = re.compile(r"[0-9@]|[\[({<](?:at|dot)[\])}>]", re.I)
NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        if found := MAIL_RIGHT.match(text, at):
            start = at
            while start > end and MAIL_LEFT.match(text[start - 1]):
                start -= 1
            if start < at:
                end = found.end()
                yield start, end
        at = text.find("@", max(at + 1, end))


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _is_card(digits: str) -> bool:
    return 12 <= len(digits) <= 19 and luhn(digits)


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by start, then kind, each kind leftmost and without overlap."""
    spans = [("email", *span) for span in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if _is_ip(m.group()):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and _is_card(NOT_DIGITS.sub("", m.group())):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGITS.sub("", m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return sorted(spans, key=_in_order)


def _in_order(span: tuple[str, int, int]) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


# The word shapes that the field knows, each a pattern for a whole token.
SHAPES = [
    re.compile(p, re.I)
    for p in (
        r"[^0-9@]*",
        r".*@.*",
        r".*@[\w-]+(\.[\w-]+)*\W*",
        r"[\w.%+-]+[\[({<]at[\])}>][\w.\[\](){}<>-]+\W*",
        r"[\[({<]at[\])}>]",
        r"[\[({<]dot[\])}>]",
        r".*[\[({<]dot[\])}>].*",
        r"[a-z][\w-]*",
        r"\W*\d+\W*",
        r"\W*\d{1,2}\W*",
        r"\W*\d{3}\W*",
        r"\W*\d{4}\W*",
        r"\W*\d{5,8}\W*",
        r"\W*\d{9,11}\W*",
        r"\W*\d{12,19}\W*",
        r"\+.*\d.*",
        r"\(\d+\)\W*",
        r"\(?\d{3}\)?[-./]\d{3}[-./]\d{4}\W*",
        r"\(\d{3}\)\d{3}[-./]\d{4}\W*",
        r"\(?\d+\)?([-./]\d{2,})+\W*",
        r"\d{3}-\d{4}\W*",
        r"(\d{4}[.\-_/]){3}\d{4}\W*",
        r"\W*\d+(\.\d+)?%?\W*",
        r"\d+(\.\d+){3}\W*",
        r"\d+([\[(]?\.[\])]?\d+){3}\W*",
        r"\d{4}[-./]\d{1,2}[-./]\d{1,2}\W*",
        r"\d{1,2}[-./]\d{1,2}[-./]\d{2,4}\W*",
        r"\d{1,2}(:\d{2})+\W*",
        r"""["'(]?(?=[0-9a-z_-]*\d)(?=[0-9a-z_-]*[a-z])[0-9a-z_-]{20,}\W*""",
        r"""["'(]?[0-9a-f]{32,}\W*""",
        r"\W*[a-z]+-?\d{1,6}[a-z]?\W*",
        r"(tel|phone|fax|call|mobile)\W*",
        r"(card|visa|account)\W*",
        r"(token|key|secret|password)\W*",
        r".*[.,;:!?]",
        r"[=:]",
    )
]


def word_shape(token: str) -> tuple[int, ...]:
    """The numbers of the shapes that a token has."""
    return tuple(i for i, shape in enumerate(SHAPES) if shape.fullmatch(token))


def labelled_examples(spark: SparkSession, per_way: int = 8, seed: int = 11) -> DataFrame:
    """The small labelled table: ``tokens, labels``, made from a rule. Rows hold one to three values of
    some kind among plain words, or numbers and marks that are no personal data."""
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choices("aeioulnrst", k=rng.randint(2, 9)))

    def digits(n: int) -> str:
        return "".join(rng.choices("0123456789", k=n))

    def part() -> str:
        return str(rng.randint(0, 255))

    def hexed(n: int) -> str:
        return "".join(rng.choices("0123456789abcdef", k=n))

    makers = {
        "email": [
            lambda: f"{word()}.{digits(2)}@{word()}.example.com",
            lambda: f"{word()}@{word()}",
            lambda: f"{word()}[at]{word()}.org",
            lambda: f"{word()} (at) {word()}.org",
            lambda: f"{word()} [at] {word()} [dot] com",
            lambda: f"{word()}(at){word()}(dot)net",
        ],
        "ip": [
            lambda: ".".join(part() for _ in range(4)),
            lambda: "[.]".join(part() for _ in range(4)),
            lambda: "(.)".join(part() for _ in range(4)),
        ],
        "card": [
            lambda: " ".join(digits(4) for _ in range(4)),
            lambda: "-".join(digits(4) for _ in range(4)),
            lambda: ".".join(digits(4) for _ in range(4)),
            lambda: "/".join(digits(4) for _ in range(4)),
        ],
        "phone": [
            lambda: f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}",
            lambda: f"({digits(3)}) {digits(3)}-{digits(4)}",
            lambda: f"{digits(3)}-{digits(3)}-{digits(4)}",
            lambda: f"({digits(3)}){digits(3)}-{digits(4)}",
            lambda: f"{digits(3)}.{digits(3)}.{digits(4)}",
        ],
        "secret": [lambda: f'"{hexed(40)}"', lambda: hexed(32), lambda: f"{hexed(12)}_{hexed(16)}x7"],
    }
    nothing = [
        lambda: digits(16),
        lambda: digits(rng.randint(1, 11)),
        lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 9)}",
        lambda: f"{word()} {rng.randint(1, 9)}.0.",
        lambda: f"{digits(4)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: f"{rng.randint(1, 12)}:{digits(2)}",
        lambda: f"{digits(2)}.{digits(2)}.{digits(4)}",
        lambda: f"@{word()}",
        lambda: f"{word()}{digits(2)}",
        lambda: f"{digits(3)},{digits(3)}",
        lambda: f"{digits(3)} {word()} {digits(4)}",
        lambda: f"{digits(2)}%",
        lambda: f"{digits(1)}.{digits(1)}.{digits(1)}",
        lambda: f"${digits(2)}.{digits(2)}",
        lambda: f"{digits(3)}-{digits(3)}",
        lambda: f"({digits(4)})",
        lambda: f"[{digits(1)}]",
        lambda: word() + " @ " + digits(2),
    ]
    rows = []
    for kind, ways in [*makers.items(), (BACKGROUND, nothing)]:
        # Every third row of a kind has several values side by side, of one way or of two.
        for n in range(per_way * len(ways)):
            beside = rng.randint(1, 2) if kind != BACKGROUND and n // len(ways) % 3 == 2 else 0
            tokens, labels = [word() for _ in range(rng.randint(0, 5))], []
            labels += [BACKGROUND] * len(tokens)
            for k in range(1 + beside):
                value = (rng.choice(ways) if k and rng.random() < 0.3 else ways[n % len(ways)])().split(" ")
                value[-1] += rng.choice(["", "", ".", ","])
                tokens += value
                labels += [kind] + [kind if kind == BACKGROUND else kind + INSIDE] * (len(value) - 1)
            after = [word() + rng.choice(["", "."]) for _ in range(rng.randint(0, 5))]
            rows.append((tokens + after, labels + [BACKGROUND] * len(after)))
    return spark.createDataFrame(rows, "tokens array<string>, labels array<string>")


def fit_field(examples: DataFrame) -> ChainCRF:
    """Train the field from a table of ``tokens, labels`` (arrays of one length, labels out of
    ``LABELS``). The table must be small: at most ``MAX_EXAMPLES`` rows."""
    rows = examples.select("tokens", "labels").limit(MAX_EXAMPLES + 1).collect()
    if len(rows) > MAX_EXAMPLES:
        raise ValueError(f"more than {MAX_EXAMPLES} labelled rows")
    rows.sort(key=lambda r: (r.tokens, r.labels))
    field = ChainCRF(LABELS, word_shape, len(SHAPES))
    return field.fit([r.tokens for r in rows], [r.labels for r in rows])


def _holds(kind: str, value: str) -> bool:
    """Whether a span of the field has the digits and marks of its kind."""
    digits = NOT_DIGITS.sub("", value)
    if kind == "email":
        return bool(re.search(r"\w\s*(@|[\[({<]at[\])}>])\s*\w", value, re.I))
    if kind == "ip":
        return len(re.findall(r"[0-9]+", value)) == 4 and _is_ip(re.sub(r"[^0-9]+", ".", value))
    if kind == "card":
        return _is_card(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15 and len(re.findall(r"[0-9]+", value)) >= 3 and not re.search("[A-Za-z]", value)
    return len(value) >= 20 and bool(digits) and bool(re.search("[A-Za-z]", value))


class _Finder:
    def __init__(self, field: ChainCRF):
        self.field = field
        self.decode = field.decoder()
        # Lines of plain words are left out; that is exact as long as the field finds nothing there.
        plain = self.decode([["word"] * n for n in range(1, 65)])
        self.skips = not any(labels.any() for labels in plain)

    def __call__(self, texts: list[str]) -> list[list[tuple[str, int, int, bool]]]:
        found = [[(*s, True) for s in pattern_spans(t)] for t in texts]
        owners, rows, places = [], [], []
        for i, text in enumerate(texts):
            if self.skips and not UNUSUAL.search(text):
                continue
            start = 0
            for line in text.split("\n"):
                if not self.skips or UNUSUAL.search(line):
                    tokens = [(m.group(), start + m.start()) for m in TOKEN.finditer(line)]
                    owners.append(i)
                    rows.append([t for t, _ in tokens])
                    places.append([p for _, p in tokens])
                start += len(line) + 1
        for i, tokens, at, labels in zip(owners, rows, places, self.decode(rows), strict=True):
            for span in self._spans(texts[i], tokens, at, labels):
                if not any(span[1] < e and s < span[2] for _, s, e, own in found[i] if own):
                    found[i].append((*span, False))
        return [sorted(spans, key=_in_order) for spans in found]

    def _spans(self, text: str, tokens: list[str], at: list[int], labels: np.ndarray) -> Iterator[tuple[str, int, int]]:
        marked, next_free = np.flatnonzero(labels).tolist(), 0
        for a in marked:
            if a < next_free:
                continue
            number = (labels[a] - 1) % len(KINDS)
            b = a + 1
            while b < len(labels) and labels[b] == 1 + len(KINDS) + number:
                b += 1
            next_free = b
            kind, start, end = KINDS[number], at[a], at[b - 1] + len(tokens[b - 1])
            while start < end and not (text[start].isalnum() or text[start] in "+(["):
                start += 1
            while start < end and not (text[end - 1].isalnum() or text[end - 1] in "])"):
                end -= 1
            if _holds(kind, text[start:end]):
                yield kind, start, end


SPANS = "array<struct<kind: string, start: int, `end`: int, by_pattern: boolean>>"


def _finder_of(docs: DataFrame, field: ChainCRF) -> Callable[[], _Finder]:
    """Makes a finder in a task, from a field that is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast((field.weights, field.moves, field.first))

    def finder() -> _Finder:
        own = ChainCRF(LABELS, word_shape, len(SHAPES))
        own.weights, own.moves, own.first = shared.value
        return _Finder(own)

    return finder


def personal_spans(docs: DataFrame, text: Column, field: ChainCRF) -> Column:
    """Spans of a text by start, then kind: code points, end exclusive. Those of the patterns may
    overlap between kinds; those of the field overlap none of them. A null text has none."""
    make = _finder_of(docs, field)

    @F.arrow_udf(SPANS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = ("kind", "start", "end", "by_pattern")
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.bool_())
        result = pa.list_(pa.struct(list(zip(names, kinds, strict=True))))
        finder = make()
        for batch in batches:
            out: list = []
            for _, block in blocks(values(batch)):
                out += [[dict(zip(names, s, strict=True)) for s in spans] for spans in finder(block)]
            yield pa.array(out, result)

    return find(text)


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", examples: DataFrame | None = None
) -> DataFrame:
    """``doc_id, spans`` for every row; ``examples`` replaces the labelled table.

    Rows that repeat an id are searched one by one; other columns are ignored; an empty table gives
    an empty result. A null or empty text has no spans; very long texts are searched whole, about a
    million characters at a time in a task. Spans that start together come in the order of ``KINDS``; a field
    span that touches one of the patterns' is left out.
    """
    field = fit_field(labelled_examples(docs.sparkSession) if examples is None else examples)
    return docs.select(F.col(id_col).alias("doc_id"), personal_spans(docs, F.col(text_col), field).alias("spans"))


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each span replaced by its kind in brackets. Spans that overlap are one, named
    after the first. Null stays null."""
    if text is None:
        return None
    out, end = [], 0
    for kind, start, stop in sorted(spans, key=_in_order):
        if start >= end:
            out += [text[end:start], f"[{kind.upper()}]"]
        end = max(end, stop)
    return "".join(out) + text[end:]


def redacted(docs: DataFrame, text: Column, field: ChainCRF) -> Column:
    """The text with its spans replaced as by ``redact``, found and replaced in one go. Null stays null."""
    make = _finder_of(docs, field)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = make()
        for batch in batches:
            out: list = []
            for _, block in blocks(values(batch)):
                found = zip(block, finder(block), strict=True)
                out += [redact(t, [s[:3] for s in spans]) if spans else t for t, spans in found]
            yield pa.array(out, pa.string())

    return F.when(text.isNotNull(), run(text))
