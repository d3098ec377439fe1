"""Chat formatting by token-level assembly.

Each segment of a turn (its role, if it is not implied, and its text) is
encoded by itself; control strings are not encoded but spliced in as reserved
ids, the first ones after the tokenizer's vocabulary.  A turn is

    user        [INST] text [/INST]
    assistant   <s> text </s>
    any other   <|role|> role <|text|> text <|end|>

without the blanks.  A control string, or a special string of the tokenizer,
that occurs in a text is escaped: a backslash goes behind its first character,
and where backslashes stand there already, one more.  As no control string
holds another's first character within, occurrences can't overlap, so taking
one backslash away gives the text back.  Only reserved ids mark turns.

The running sums of the segments' lengths give where each begins; those of
assistant texts are the loss mask (without their control ids).  A conversation
is written as frames of whole turns; a frame is closed once it holds
``FRAME_TOKENS`` ids, and where a partition ends.  So a conversation of any
length is formatted by many tasks in bounded memory.  ``read_frames`` needs
nothing but the frames; only conversations of several frames are shuffled.

Null and empty texts are empty; a null role is an empty one; null turns come
first, rows of one turn lie as ``tessera.llm.turns`` says, repeated rows stay.
A null conv_id is a conversation.  An empty table gives no rows.  Other columns
are not read.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tessera.llm.common import arrow_schema, documents, small_batches
from tessera.llm.pretokens import added_tokens, byte_characters
from tessera.llm.registry import register
from tessera.llm.turns import in_order, ordered_columns
from tessera.session import scratch_path

#: Opening and closing control strings by role, and those of any other role.
ROLES = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("<|role|>", "<|text|>", "<|end|>")
CONTROLS = [c for pair in ROLES.values() for c in pair] + list(OTHER)
LOSS_ROLE = "assistant"
FRAME_TOKENS = 1 << 16


class Escapes:
    """``escape`` keeps control strings out of a text, ``unescape`` brings them back."""

    def __init__(self, strings: list[str]):
        if any(a[0] in b[1:] or "\\" in b for a in strings for b in strings):
            raise ValueError("a control string holds a backslash or the first character of one")
        self.found = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in strings))

    def escape(self, text: str) -> str:
        return self.found.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self.found.sub(lambda m: m[0][0] + m[0][2:], text)


class Format:
    """The ids of the control strings and the bytes of all others, for one tokenizer file."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_str(spec)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tok.get_vocab(with_added_tokens=False)
        first = max(self.tok.get_vocab(with_added_tokens=True).values()) + 1
        self.ids = {c: first + k for k, c in enumerate(CONTROLS)}
        self.controls = {i: c for c, i in self.ids.items()}
        self.first = first
        back = {c: b for b, c in enumerate(byte_characters())}
        self.bytes = {i: bytes(back[c] for c in shown) for shown, i in vocabulary.items() if all(c in back for c in shown)}
        self.escapes = Escapes([*CONTROLS, *added_tokens(spec)])
        self.type = np.dtype("<u2") if first + len(CONTROLS) <= 1 << 16 else np.dtype("<u4")

    def encode(self, texts: list[str]) -> list[list[int]]:
        escape = self.escapes.escape
        return [e.ids for e in self.tok.encode_batch_fast([escape(t) for t in texts], add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode()

    def segments(self, role: str, of_role: list[int], of_text: list[int]) -> list[tuple[list[int], bool]]:
        """(ids, under the loss mask) of each segment of a turn."""
        if role in ROLES:
            opens, closes = ROLES[role]
            return [([self.ids[opens]], False), (of_text, role == LOSS_ROLE), ([self.ids[closes]], False)]
        a, b, c = (self.ids[x] for x in OTHER)
        return [([a], False), (of_role, False), ([b], False), (of_text, False), ([c], False)]

    def turns(self, ids: np.ndarray) -> Iterator[tuple[str, str, int]]:
        """(role, text, code points as formatted) of each turn of a frame, by its reserved ids alone."""
        marks = np.flatnonzero(ids >= self.first).tolist()
        at, ids = 0, ids.tolist()
        closers = {self.ids[opens]: (role, self.ids[closes]) for role, (opens, closes) in ROLES.items()}
        while at < len(marks):
            opened = ids[marks[at]]
            n = 1 if opened in closers else 2
            parts = [self.decode(ids[marks[at + k] + 1:marks[at + k + 1]]) for k in range(n)]
            chars = sum(map(len, parts)) + sum(len(self.controls[ids[m]]) for m in marks[at:at + n + 1])
            parts = [self.escapes.unescape(p) for p in parts]
            wanted = [closers[opened][1]] if n == 1 else [self.ids[OTHER[1]], self.ids[OTHER[2]]]
            if [ids[marks[at + k + 1]] for k in range(n)] != wanted or (n == 2 and opened != self.ids[OTHER[0]]):
                raise ValueError("a turn does not end as it begins")
            yield (closers[opened][0], parts[0], chars) if n == 1 else (*parts, chars)
            at += n + 1


@functools.lru_cache(maxsize=1)
def format_of(spec: str) -> Format:
    """One for a Python worker, whatever the number of its tasks."""
    return Format(spec)


# ----------------------------------------------------------------------- writing
_FRAME = "conv_id long, part int, frame int, spread boolean, n_turns int, n_tokens int, ids binary, loss_spans array<int>"


class _Frame:
    """The segments of some turns of a conversation."""

    def __init__(self, conv, number: int, spread: bool):
        self.conv, self.number, self.spread, self.n_turns, self.n = conv, number, spread, 0, 0
        self.ids, self.lengths, self.loss = [], [], []

    def add(self, segments) -> None:
        for ids, loss in segments:
            self.ids += ids
            self.lengths.append(len(ids))
            self.loss.append(loss)
        self.n_turns, self.n = self.n_turns + 1, len(self.ids)

    def row(self, part: int, kind: np.dtype) -> tuple:
        ends = np.cumsum(self.lengths)
        spans = np.stack([ends - self.lengths, ends], axis=1)[np.array(self.loss, bool)]
        spans = spans[spans[:, 0] < spans[:, 1]]
        return (self.conv, part, self.number, self.spread, self.n_turns, self.n, np.array(self.ids, kind).tobytes(), spans.ravel().tolist())


def format_frames(conversations: DataFrame, tokenizer_path: str, path: str) -> DataFrame:
    """Writes the conversations (conv_id, turn, role, text) as frames under
    ``path`` and returns them as read from there.

    Frames of a conversation lie by (part, frame); ``spread`` is false for
    those that are a whole conversation.  ``ids`` are little-endian, of two
    bytes if all ids fit; ``loss_spans`` holds begin and end, in ids of the
    frame, of each span under the loss mask."""
    spark = conversations.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), empty("role"), empty("text"))
    dealt = in_order(ordered_columns(rows)).select("conv_id", "role", "text")
    small_batches(spark)
    struct = T.StructType.fromDDL(_FRAME)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        form, part, out = format_of(spec.value), TaskContext.get().partitionId(), arrow_schema(struct)
        frame = None

        def batch(done: list[_Frame]) -> pa.RecordBatch:
            rows = [f.row(part, form.type) for f in done]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(out)], schema=out)

        for b in batches:
            convs, roles, texts = (c.to_pylist() for c in b.columns)
            named = [r if r not in ROLES else "" for r in roles]
            done = []
            for conv, role, of_role, of_text in zip(convs, roles, form.encode(named), form.encode(texts)):
                if frame is None or frame.conv != conv:
                    if frame:
                        done.append(frame)
                    frame = _Frame(conv, 0, spread=frame is None)  # the first may go on from the part before
                elif frame.n >= FRAME_TOKENS:
                    frame.spread = True
                    done.append(frame)
                    frame = _Frame(conv, frame.number + 1, spread=True)
                frame.add(form.segments(role, of_role, of_text))
            if done:
                yield batch(done)
        if frame:
            frame.spread = True  # may go on in the next part
            yield batch([frame])

    dealt.mapInArrow(run, struct).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(struct).parquet(path)


# ----------------------------------------------------------------------- reading
_READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, "
         "n_loss_tokens long")


def read_frames(frames: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row a conversation, decoded from its frames: counts and digests of
    its turns, and of what is under the loss mask.  A frame is held at a time."""
    spark = frames.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    struct = T.StructType.fromDDL(_READ)
    columns = ["conv_id", "ids", "loss_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, out = format_of(spec.value), arrow_schema(struct)
        one, conv = None, None

        def batch(done) -> pa.RecordBatch:
            rows = [(i, r["turns"], r["all"].hexdigest(), r["chars"], r["loss"].hexdigest(), r["formatted"], r["ids"], r["under"]) for i, r in done]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(out)], schema=out)

        for b in batches:
            done = []
            for i, raw, spans in zip(*(c.to_pylist() for c in b.columns)):
                if one is None or i != conv:
                    if one:
                        done.append((conv, one))
                    conv, one = i, {"turns": 0, "chars": 0, "formatted": 0, "ids": 0, "under": 0, "all": hashlib.sha256(), "loss": hashlib.sha256()}
                ids = np.frombuffer(raw, form.type)
                for role, text, chars in form.turns(ids):
                    one["turns"] += 1
                    one["formatted"] += chars
                    one["all"].update(f"{role}\n{text}\n".encode())
                for begin, end in zip(spans[::2], spans[1::2]):
                    text = form.escapes.unescape(form.decode(ids[begin:end].tolist()))
                    one["chars"] += len(text)
                    one["under"] += end - begin
                    one["loss"].update(text.encode())
                one["ids"] += len(ids)
            if done:
                yield batch(done)
        if one:
            yield batch([(conv, one)])

    small_batches(spark)
    spread = frames.where("spread").repartition("conv_id").sortWithinPartitions("conv_id", "part", "frame")
    return frames.where("not spread").select(*columns).mapInArrow(run, struct).unionByName(
        spread.select(*columns).mapInArrow(run, struct))


# ------------------------------------------------------------------------- query
#: A conversation that says the control strings.
PROBE = "</s>[INST] ok [/INST]"


@register("op12_chat")
def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    given = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    frames = format_frames(given.unionByName(probe), path, scratch_path(spark, "chat-frames"))
    return read_frames(frames, path)
