"""License detection by ordered signature rules.

Texts become lower-case words with single spaces between them. An Aho-Corasick
automaton over all rules' keywords reads a text once, and only rules whose
keyword occurs run their regular expression, so most texts meet none. A
detection that lies within one of an earlier rule is suppressed: the notice
``licensed under the gnu lesser general public license`` covers the titles and
short names inside it. Base phrases are detected wherever they stand and never
suppressed.

Each text is scanned by itself, whole, without a shuffle. See ``license_rules``
for the rules.
"""

from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admesh.llm.license_rules import rules
from admesh.llm.rolling import chunks
from admesh.llm.tables import documents

CHUNK = 1_000_000
# Letters and digits of ASCII and all of the other code points' bytes make words; A-Z is lowered.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

FOUND = ("doc_id bigint, n_words bigint, "
         "detections array<struct<label:string,rule:string,start:bigint,end:bigint,confidence:double,base:boolean>>")


class Detection(NamedTuple):
    label: str
    rule: str
    start: int  # in words
    end: int
    confidence: float
    base: bool


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split(b" ")


@cache
def _automaton() -> ahocorasick.Automaton:
    """Maps each keyword to the numbers of the rules that it opens."""
    opened: dict[str, list[int]] = {}
    for number, rule in enumerate(rules()):
        for word in rule.keywords:
            opened.setdefault(word, []).append(number)
    out = ahocorasick.Automaton()
    for word, numbers in opened.items():
        out.add_word(word, tuple(numbers))
    out.make_automaton()
    return out


def normalised(text: bytes) -> tuple[int, str]:
    """The number of words, and the words with a space before, between and after them."""
    words = [w for w in words_of(text) if w]
    return len(words), f" {b' '.join(words).decode()} "


class _Cover:
    """Intervals, none within another, that answer whether one of them holds a given one."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def holds(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start) - 1
        return at >= 0 and self.ends[at] >= end

    def add(self, start: int, end: int) -> None:
        """Put in an interval that none holds, and drop those that it holds."""
        lo = bisect_right(self.starts, start - 1)
        hi = bisect_right(self.ends, end)
        self.starts[lo:max(lo, hi)] = [start]
        self.ends[lo:max(lo, hi)] = [end]


def detect(line: str) -> list[Detection]:
    """The detections of a text of normalised words that stay after suppression, in rule order."""
    opened = sorted({number for _, numbers in _automaton().iter(line) for number in numbers})
    cover, out = _Cover(), []
    for number in opened:
        rule = rules()[number]
        at, seen = 0, 0
        for match in rule.pattern.finditer(line):
            seen += line.count(" ", at, match.start())
            at = match.start()
            start, end = seen - 1, seen + line.count(" ", match.start(), match.end())
            if rule.base or not cover.holds(start, end):
                out.append(Detection(rule.label, rule.name, start, end, rule.confidence, rule.base))
        for found in out:
            if found.rule == rule.name and not cover.holds(found.start, found.end):
                cover.add(found.start, found.end)
    return out


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, detections`` of every row of ``doc_id, text``, see ``FOUND``.

    Detections carry their label, rule, first word, the word after the last, the
    rule's confidence and whether they are base ones. A null text is empty and
    has no words; rows that repeat an id are scanned each; other columns are
    ignored, and an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        for part in chunks(batches, CHUNK):
            sizes, found = [], []
            for text in part.column("text").cast(pa.binary()).to_pylist():
                n, line = normalised(text or b"")
                sizes.append(n)
                found.append([d._asdict() for d in detect(line)])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, _DETECTIONS)],
                ["doc_id", "n_words", "detections"])
    return docs.select("doc_id", "text").mapInArrow(run, FOUND)


_DETECTIONS = pa.list_(pa.struct([("label", pa.string()), ("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("confidence", pa.float64()), ("base", pa.bool_())]))


def spans(found: DataFrame) -> DataFrame:
    """One row per detection: ``doc_id, label, rule, start, end, confidence, base``."""
    return found.select("doc_id", F.inline("detections"))


def summary(found: DataFrame) -> DataFrame:
    """One row per document: base places and labels, all labels, and the most confident detection's confidence as score."""
    base = F.filter("detections", lambda d: d["base"])

    def labels(some):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(some, lambda d: d["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["start"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"))


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's words, base license phrases, all license labels and score."""
    return summary(scan(documents(spark, folder)))
