"""Chat formatting in token-budgeted windows with a loss mask.

Each turn becomes ``### role: text</turn>`` and a line feed. A backslash before
a control string (``###``, ``</turn>``), a backslash, or a colon of the role
makes it plain text, so the format can be read back exactly.

Conversations that exceed the token budget are cut between turns into windows.
Prefix sums of the turns' tokens place the cuts. Every window begins with the
conversation's leading system turn and with as many of the latest turns as fit
the history budget. Those repeated turns carry no loss, so each assistant text
is a target exactly once. A turn that exceeds the budget alone stays whole.
"""

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admesh.llm.tables import table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
BUDGET = 2048
HISTORY = 512

END = "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_STOP = re.compile(r"\\(?:\\|###|</turn>|:)|(</turn>\n)")

COUNTED = "conv_id bigint, turn bigint, role string, text string, tokens bigint"
WINDOWS = ("conv_id bigint, window bigint, text string, repeated int, tokens bigint, "
           "loss array<struct<start:bigint,stop:bigint>>")
READ_BACK = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
             "formatted_chars bigint, n_windows bigint")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as it stands in a window, and where its text starts and stops."""
    head = "### " + _ROLE_CONTROL.sub(lambda m: "\\" + m[0], role) + ": "
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse_turns(window: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, and the text's start and stop of every turn of a window."""
    at = 0
    while at < len(window):
        stop = next(m for m in _STOP.finditer(window, at) if m[1])
        colon = next(m for m in re.finditer(r"\\(?:\\|###|</turn>|:)|(:)", window[at:stop.start()]) if m[1])
        start = at + colon.end() + 1
        yield unescape(window[at + 4:at + colon.start()]), unescape(window[start:stop.start()]), start, stop.start()
        at = stop.end()


def encoder(path: str):
    """Token counter of a public byte-level vocabulary, loaded once per worker."""
    import base64

    import public_tokenizers
    import tiktoken

    if path not in _ENCODERS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODERS[path] = tiktoken.Encoding(
            "chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


_ENCODERS: dict = {}


class _Cutter:
    """Cuts one conversation's turns, given in order, into windows.

    Holds the turns of the open window only; ``sums`` are prefix sums of their tokens.
    """

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system = None
        self.turns: list[tuple[str, str, int]] = []
        self.sums = [0]
        self.repeated = self.window = 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[dict]:
        first = not self.turns and not self.window
        if len(self.turns) > self.repeated and self.sums[-1] + tokens > self.budget:
            yield self.close()
            self._open(tokens)
        if first and role == "system":
            self.system = (role, text, tokens)
        self._append((role, text, tokens))

    def _append(self, turn):
        self.turns.append(turn)
        self.sums.append(self.sums[-1] + turn[2])

    def _open(self, tokens: int):
        """Start a window with the system turn and the latest turns that leave room for ``tokens``."""
        head = [self.system] if self.system else []
        room = min(self.history, self.budget - tokens - sum(t[2] for t in head))
        # The shortest suffix cut whose tokens fit: the first prefix sum that is large enough.
        cut = bisect.bisect_left(self.sums, self.sums[-1] - room) if room > 0 else len(self.turns)
        if self.system and self.turns[0] is self.system:
            cut = max(cut, 1)
        kept, self.turns, self.sums = head + self.turns[cut:], [], [0]
        for turn in kept:
            self._append(turn)
        self.repeated = len(kept)

    def close(self) -> dict:
        parts, loss, at = [], [], 0
        for i, (role, text, _) in enumerate(self.turns):
            part, start, stop = format_turn(role, text)
            if i >= self.repeated and role == "assistant":
                loss.append({"start": at + start, "stop": at + stop})
            parts.append(part)
            at += len(part)
        self.window += 1
        return {"conv_id": self.conv_id, "window": self.window - 1, "text": "".join(parts),
                "repeated": self.repeated, "tokens": self.sums[-1], "loss": loss}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY,
                 tokenizer: str = TOKENIZER) -> DataFrame:
    """Format ``conv_id, turn, role, text`` into windows: one row per window.

    ``repeated`` turns at the start of a window are history without loss,
    ``loss`` lists the target texts as code point ranges of ``text``. Rows are
    ordered by turn, then role and text where a turn number repeats; null turn
    numbers come first, null roles and texts count as empty, and rows with a null
    ``conv_id`` form a conversation of their own. Other columns are ignored. An
    empty table gives no windows. Tokens are counted before the rows are
    shuffled; afterwards a task streams over sorted turns and holds one window
    at a time, however long a conversation is.
    """
    def count(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                row["tokens"] = len(encode.encode_ordinary(format_turn(row["role"], row["text"])[0]))
            yield pa.RecordBatch.from_pylist(rows, counted)

    def cut(batches):
        def windows():
            cutter = None
            for row in _rows(batches):
                if cutter is None or cutter.conv_id != row["conv_id"]:
                    if cutter is not None:
                        yield cutter.close()
                    cutter = _Cutter(row["conv_id"], budget, history)
                yield from cutter.add(row["role"], row["text"], row["tokens"])
            if cutter is not None:
                yield cutter.close()
        return _batches(windows(), out)

    counted = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                         ("text", pa.string()), ("tokens", pa.int64())])
    out = pa.schema([("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()),
                     ("repeated", pa.int32()), ("tokens", pa.int64()),
                     ("loss", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
    empty = F.lit("")
    return (
        conversations.select("conv_id", "turn", F.coalesce("role", empty).alias("role"),
                             F.coalesce("text", empty).alias("text"))
        .mapInArrow(count, COUNTED)
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(cut, WINDOWS)
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Parse the windows of ``chat_windows`` again and digest each conversation's turns and targets."""
    out = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                     ("n_windows", pa.int64())])

    def digest(batches):
        def conversations():
            now = None
            for row in _rows(batches):
                if now is None or row["window"] == 0:
                    if now is not None:
                        yield finish(now)
                    now = {"conv_id": row["conv_id"], "n_turns": 0, "loss_chars": 0, "formatted_chars": 0,
                           "n_windows": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256()}
                now["n_windows"] += 1
                now["formatted_chars"] += len(row["text"])
                for i, (role, text, _, _) in enumerate(parse_turns(row["text"])):
                    if i >= row["repeated"]:
                        now["n_turns"] += 1
                        now["turns"].update(f"{role}\n{text}\n".encode())
                for span in row["loss"]:
                    target = unescape(row["text"][span["start"]:span["stop"]])
                    now["loss_chars"] += len(target)
                    now["loss"].update(target.encode())
            if now is not None:
                yield finish(now)

        def finish(now):
            return {k: now[k] for k in ("conv_id", "n_turns", "loss_chars", "formatted_chars", "n_windows")} | {
                "turns_sha256": now["turns"].hexdigest(), "loss_sha256": now["loss"].hexdigest()}
        return _batches(conversations(), out)

    return windows.mapInArrow(digest, READ_BACK)


def op10_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts hold the template's control strings, formatted and read back."""
    said = "\\### Assistant: </turn> ok"
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return read_back(chat_windows(table(spark, folder, "conversations").unionByName(probe)))
