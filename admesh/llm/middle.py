"""Fill-in-the-middle transformation by a secondary sort of text pieces.

A text is cut into units (runs of ASCII letters, else single code points) and
its units into a prefix, a middle and a suffix; the output names each by a mark
and puts the middle last. No task builds an output: every section leaves in
pieces of at most ``UNITS`` units, keyed by document and output position. One
shuffle by document with a sort by position within the partitions (the
DataFrame form of ``repartitionAndSortWithinPartitions``) lets the reader
stream the pieces of one document after the other into incremental digests.

For restoration the reader parses the marks out of the stream, gives what lies
between them its place in the text and hands it on; the pieces are sorted again
by that place within the same partitions, without a second shuffle, and stream
into a second digest. A document is only ever held a piece at a time, and the
sorts spill like any other of Spark's.

Rows are documents, also where they repeat an id or a text. A null text counts
as empty, a null id as an empty one in the draws of cuts and form. Other columns
are ignored, and an empty table gives no rows.
"""

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from admesh.llm.rolling import chunks
from admesh.llm.tables import documents

UNITS = 4_096  # units of a piece
PIECE = 65_536  # bytes of a piece; a longer unit is split
PLAIN, SPM = 90, 20  # of 100 draws: from here on plain; below, suffix first
CHUNK = 4_000_000  # bytes of texts or pieces handled together

PREFIX, MIDDLE, SUFFIX = range(3)  # by place in the text
MARKS = {PREFIX: b"<P>", SUFFIX: b"<S>", MIDDLE: b"<M>"}
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

PIECES = "doc_id bigint, row bigint, place bigint, n bigint, form string, data binary"
TEXTS = "doc_id bigint, n bigint, form string, text string"
DIGESTS = ("doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
           "output_sha256 string, restored_sha256 string")

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SECTION = 1 << 48  # places between the sections of a restored text


def unit_starts(text: bytes) -> np.ndarray:
    """Byte positions at which the units of a UTF-8 text start."""
    data = np.frombuffer(text, np.uint8)
    letter = _LETTER[data]
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def draws(doc_id: int | None) -> list[int]:
    """The four numbers that decide a document's cuts and form."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4]) for i in range(0, 16, 4)]


def form_of(text: bytes, h3: int, h4: int) -> str:
    if not text or h3 % 100 >= PLAIN or any(mark in text for mark in MARKS.values()):
        return "plain"
    return "spm" if h4 % 100 < SPM else "psm"


def pieces_of(text: bytes, starts: np.ndarray, form: str, h1: int, h2: int) -> Iterator[bytes]:
    """The output in order, each section in pieces that begin and end with a unit."""
    def pieces(first, last, mark):
        held = mark
        for unit in range(first, last, UNITS):
            lo = int(starts[unit])
            hi = int(starts[min(unit + UNITS, last)]) if min(unit + UNITS, last) < len(starts) else len(text)
            for at in range(lo, hi, PIECE):
                yield held + text[at:min(at + PIECE, hi)]
                held = b""
        if held or first == last == 0 and not mark:
            yield held
    n = len(starts)
    if form == "plain":
        yield from pieces(0, n, b"")
        return
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    spans = {PREFIX: (0, one), MIDDLE: (one, two), SUFFIX: (two, n)}
    for section in ORDER[form]:
        yield from pieces(*spans[section], MARKS[section])


def cut(docs: DataFrame) -> DataFrame:
    """The pieces of every row's output, see ``PIECES``; an empty text has one empty piece."""
    def run(batches: Iterator[pa.RecordBatch]):
        row = TaskContext.get().partitionId() << 40  # names a row, so that repeated ids stay apart
        for part in chunks(batches, CHUNK):
            out = {name: [] for name in ("doc_id", "row", "place", "n", "form", "data")}
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                text = text or b""
                starts = unit_starts(text)
                h1, h2, h3, h4 = draws(doc_id)
                form = form_of(text, h3, h4)
                for place, data in enumerate(pieces_of(text, starts, form, h1, h2)):
                    for name, value in zip(out, (doc_id, row, place, len(starts), form, data)):
                        out[name].append(value)
                row += 1
            yield _batch(out, _PIECES)
    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


_PIECES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("place", pa.int64()), ("n", pa.int64()),
                     ("form", pa.string()), ("data", pa.binary())])


def _batch(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def by_output(pieces: DataFrame) -> DataFrame:
    """The pieces brought together and into order by one shuffle, whatever tasks made them."""
    return pieces.repartition("doc_id", "row").sortWithinPartitions("doc_id", "row", "place")


class Piece(NamedTuple):
    doc_id: int | None
    row: int
    n: int
    form: str
    data: bytes
    place: int


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, Piece]]:
    """Sorted pieces in small slices; true with the first of a document. ``None`` ends a slice."""
    last = None
    for batch in batches:
        for part in chunks(iter([batch]), CHUNK, "data"):
            for values in zip(*(part.column(c).to_pylist() for c in Piece._fields)):
                piece = Piece(*values)
                key = piece.doc_id, piece.row
                yield key != last, piece
                last = key
            yield False, None


class Parser:
    """Finds the sections of an output that arrives in pieces split anywhere."""

    def __init__(self, form: str):
        self.plain = form == "plain"
        self.ahead = [] if self.plain else list(ORDER[form])
        self.section = PREFIX
        self.held = b""

    def feed(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        """``section, bytes`` of what is certain so far."""
        data = self.held + data
        while self.ahead:
            at = data.find(MARKS[self.ahead[0]])
            if at < 0:
                break
            if at:
                yield self.section, data[:at]
            self.section = self.ahead.pop(0)
            data = data[at + 3:]
        keep = 2 if self.ahead else 0  # may be the start of a mark
        done = max(len(data) - keep, 0)
        self.held = data[done:]
        if done:
            yield self.section, data[:done]

    def end(self) -> Iterator[tuple[int, bytes]]:
        if self.ahead:
            raise ValueError(f"an output ends before {MARKS[self.ahead[0]]!r}")
        yield from ()


def _chars(data: bytes) -> int:
    """Code points that start in the bytes."""
    return len(data) - int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))


def digested(ordered: DataFrame) -> DataFrame:
    """Digest, section lengths and restored text's digest of every ordered output, see ``DIGESTS``."""
    def assemble(batches):
        """Digest the outputs; hand their sections on by place in the text, after a row of findings (place -1)."""
        columns = {name: [] for name in _PIECES.names}

        def put(piece, place, data):
            for name, value in zip(_PIECES.names, (piece.doc_id, piece.row, place, piece.n, piece.form, data)):
                columns[name].append(value)

        def finish():
            list(parser.end())
            findings = f"{digest.hexdigest()} {chars[PREFIX]} {chars[MIDDLE]}"
            put(current, -1, findings.encode())
        current = None
        for first, piece in _streamed(batches):
            if piece is None:
                yield _batch(columns, _PIECES)
                columns = {name: [] for name in _PIECES.names}
                continue
            if first:
                if current:
                    finish()
                digest, parser, sizes, chars = hashlib.sha256(), Parser(piece.form), [0] * 3, [0] * 3
            current = piece
            digest.update(piece.data)
            for section, data in parser.feed(piece.data):
                put(piece, section * _SECTION + sizes[section], data)
                sizes[section] += len(data)
                chars[section] += _chars(data)
        if current:
            finish()
            yield _batch(columns, _PIECES)

    def restore(batches):
        """Digest the restored texts."""
        columns = {f: [] for f in _DIGESTS.names}

        def finish():
            output, prefix, middle = findings.decode().split(" ")
            plain = current.form == "plain"
            for name, value in zip(columns, (current.doc_id, current.n, current.form, None if plain else int(prefix),
                                             None if plain else int(middle), output, digest.hexdigest())):
                columns[name].append(value)
        current = None
        for first, piece in _streamed(batches):
            if piece is None:
                yield _batch(columns, _DIGESTS)
                columns = {f: [] for f in _DIGESTS.names}
                continue
            if first:
                if current:
                    finish()
                current, digest, findings = piece, hashlib.sha256(), piece.data
            else:
                digest.update(piece.data)
        if current:
            finish()
            yield _batch(columns, _DIGESTS)
    sections = ordered.mapInArrow(assemble, PIECES)
    return sections.sortWithinPartitions("doc_id", "row", "place").mapInArrow(restore, DIGESTS)


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                      ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_TEXTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("text", pa.string())])


def transform(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, text`` with the transformed text of every row."""
    def join(batches):
        columns = {f: [] for f in _TEXTS.names}
        current, parts = None, []
        for first, piece in _streamed(batches):
            if piece is None:
                yield _batch(columns, _TEXTS)
                columns = {f: [] for f in _TEXTS.names}
                continue
            if first and current:
                _put_text(columns, current, parts)
                parts = []
            current = piece
            parts.append(piece.data)
        if current:
            _put_text(columns, current, parts)
            yield _batch(columns, _TEXTS)
    return by_output(cut(docs)).mapInArrow(join, TEXTS)


def _put_text(columns, piece, parts):
    for name, value in zip(_TEXTS.names, (piece.doc_id, piece.n, piece.form, b"".join(parts).decode())):
        columns[name].append(value)


def restored(text: str, form: str) -> str:
    """The text of one output; an error if its marks do not fit the form."""
    parser, sections = Parser(form), [[], [], []]
    for section, data in [*parser.feed(text.encode()), *parser.end()]:
        sections[section].append(data)
    return b"".join(b"".join(s) for s in sections).decode()


def restore(outputs: DataFrame) -> DataFrame:
    """``doc_id, form, text`` of ``doc_id, form, text`` with the outputs turned back into texts, row by row."""
    def run(batches):
        for part in chunks(batches, CHUNK):
            texts = [restored(t or "", f) for t, f in zip(part.column("text").to_pylist(), part.column("form").to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("form"), pa.array(texts, pa.string())],
                                             ["doc_id", "form", "text"])
    return outputs.select("doc_id", "form", "text").mapInArrow(run, "doc_id bigint, form string, text string")


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's cuts, and digests of its output and of the text restored from it."""
    return digested(by_output(cut(documents(spark, folder))))


ORACLE = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
t AS (
    SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
    SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS one,
        greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS two,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
s AS (
    SELECT *, array_to_string(units[1:one], '') AS p, array_to_string(units[one + 1:two], '') AS m,
        array_to_string(units[two + 1:], '') AS s FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM s
"""
