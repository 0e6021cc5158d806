"""Chat formatting at token level.

A turn becomes ``TURN ids(role) TEXT ids(text) END``: role and text are encoded
as separate segments and the reserved ids, which stand above the vocabulary, are
spliced between them, so no text can ever make a reserved id. Control strings
that occur in a text (markers of this and of other common templates) are escaped
all the same, for whoever renders the ids as text: a backslash goes after their
first character, and one more where backslashes stand already, which is undone
exactly. The loss mask is the span of an assistant text; its place, like that of
every segment, is a prefix sum of segment lengths.

Scale. Turns are ordered by ranges of (conversation, turn), so a conversation of any
length is spread over tasks, and encoded there; each task sums the lengths of its rows, and what a conversation brings from earlier
ranges is added afterwards: at most one conversation continues into a range, so
that table has no more rows than there are ranges and is broadcast. Reading the
text of a conversation back for a digest is a stream in order: SHA-256 must see a
conversation's bytes one after another, in one task, with the digest's state as
all it holds.

Defined results: a null text or role is an empty one; turns go by ``turn`` (null
first), equal ones by a hash of role and text; repeated rows are repeated turns; a
null ``conv_id`` is a conversation of its own; an empty table gives no row;
roles are any strings; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitals.llm.common import once, only, read, written
from vitals.llm.packing import Ids

TURN, TEXT, END = 50_300, 50_301, 50_302
#: how the reserved ids read
NAMES = {TURN: "<|turn|>", TEXT: "<|text|>", END: "<|end|>"}
LEARNED_ROLE = "assistant"
#: FIXED VALUES: control strings of common chat templates after their first character
_CONTROL = r"s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|[A-Za-z_]\w*\|>"
_PLAIN = re.compile(rf"([<\[])(\\*)({_CONTROL})")
_ESCAPED = re.compile(rf"([<\[])(\\*)\\({_CONTROL})")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def encode_turn(ids_of: Ids, role: str, text: str) -> tuple[np.ndarray, int, int]:
    """Ids of a turn and the span (from, to) of its text."""
    parts = [[TURN], ids_of(escape(role)), [TEXT], ids_of(escape(text)), [END]]
    ends = np.cumsum([len(p) for p in parts])
    return np.concatenate([np.asarray(p, dtype="<u4") for p in parts]), int(ends[2]), int(ends[3])


class Reader:
    """Texts of ids."""

    def __init__(self, ids_of: Ids):
        self.ids_of = ids_of

    def text(self, ids: np.ndarray) -> str:
        """The text of ids without reserved ones."""
        return self.ids_of.fast.decode_bytes(ids.tolist()).decode("utf-8", "surrogatepass")

    def turn(self, ids: np.ndarray) -> tuple[str, str, int]:
        """(role, text) of a turn's ids, and its length as formatted text."""
        middle = int(np.flatnonzero(ids == TEXT)[0])
        role, text = self.text(ids[1:middle]), self.text(ids[middle + 1:-1])
        return unescape(role), unescape(text), len(role) + len(text) + sum(map(len, NAMES.values()))


def _tokenizer(file: str, ranks: str) -> Ids:
    return once(("ids", file, ranks), lambda: Ids(file, ranks))


_ENCODED = "conv_id long, turn long, tie long, ids binary, loss_from int, loss_to int"
_PLACED = "conv_id long, turn long, ids binary, n_ids int, before long, index long, loss_from int, loss_to int"


def _encode(file: str, ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _tokenizer(file, ranks)
        for b in batches:
            out: list[list] = [[], [], []]
            for role, text in zip(b.column("role").to_pylist(), b.column("text"), strict=True):
                ids, start, end = encode_turn(ids_of, role, text.as_py())
                learned = role == LEARNED_ROLE
                for column, value in zip(out, (ids.tobytes(), start if learned else 0, end if learned else 0), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), b.column("tie"), pa.array(out[0], pa.binary()),
                 pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32())],
                names=["conv_id", "turn", "tie", "ids", "loss_from", "loss_to"])
    return run


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over a range's rows of a conversation that come before a row."""
    now, tokens, turns = object(), 0, 0
    for b in batches:
        before, index, size = [], [], []
        for conv, ids in zip(b.column("conv_id").to_pylist(), b.column("ids"), strict=True):
            if conv != now:
                now, tokens, turns = conv, 0, 0
            n = len(ids.as_buffer()) // 4
            before.append(tokens)
            index.append(turns)
            size.append(n)
            tokens, turns = tokens + n, turns + 1
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("turn"), b.column("ids"), pa.array(size, pa.int32()), pa.array(before, pa.int64()),
             pa.array(index, pa.int64()), b.column("loss_from"), b.column("loss_to")],
            names=["conv_id", "turn", "ids", "n_ids", "before", "index", "loss_from", "loss_to"])


def format_turns(turns: DataFrame, file: str, ranks: str) -> DataFrame:
    """One row per turn of ``turns`` (conv_id, turn, role, text): its place in
    the conversation (``turn_index``; ``start``, ``n_ids`` in tokens), its ids as
    little-endian unsigned 32-bit binary, and the token span under the loss mask
    (``loss_start``, ``loss_end``; empty unless the assistant speaks)."""
    own = only(turns, conv_id="long", turn="long", role="string", text="string").fillna("", ["role", "text"])
    own = own.withColumn("tie", F.xxhash64("role", "text"))
    order = ["conv_id", "turn", "tie"]
    # ranges first: drawing their bounds reads the turns once more, which must not encode them
    ranged = own.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_encode(file, ranks), _ENCODED)
    placed = written(ranged.mapInArrow(_place, _PLACED).withColumn("part", F.spark_partition_id()), "chat-turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (placed.groupBy("conv_id", "part").agg(F.sum("n_ids").alias("t"), F.count(F.lit(1)).alias("c"))
             .select(F.col("conv_id").alias("of"), F.col("part").alias("at"), F.sum("t").over(earlier).alias("t"), F.sum("c").over(earlier).alias("c"))
             .where("t IS NOT NULL"))
    start = (F.col("before") + F.coalesce("t", F.lit(0))).alias("start")
    return (placed.join(F.broadcast(carry), F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at")), "left")
            .select("conv_id", "turn", (F.col("index") + F.coalesce("c", F.lit(0))).alias("turn_index"), start, "n_ids", "ids",
                    (start + F.col("loss_from")).alias("loss_start"), (start + F.col("loss_to")).alias("loss_end")))


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(file: str, ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(_tokenizer(file, ranks))
        now, state = object(), None
        rows: list[tuple] = []

        def done() -> None:
            if state is not None:
                turns, all_, loss_chars, loss, chars = state
                rows.append((now, turns, all_.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def out() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [c.split()[0] for c in _READ.split(", ")]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for b in batches:
            for conv, start, lo, hi, data in zip(*(b.column(c).to_pylist() for c in ("conv_id", "start", "loss_start", "loss_end")),
                                                 b.column("ids"), strict=True):
                if conv != now:
                    done()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.frombuffer(data.as_buffer(), dtype="<u4")
                role, text, chars = reader.turn(ids)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                under = unescape(reader.text(ids[lo - start:hi - start]))
                state[2] += len(under)
                state[3].update(under.encode("utf-8", "surrogatepass"))
                state[4] += chars
            if rows:
                yield out()
        done()
        if rows:
            yield out()
    return run


def read_back(formatted: DataFrame, file: str, ranks: str) -> DataFrame:
    """Per conversation, what its ids say."""
    return (formatted.select("conv_id", "start", "loss_start", "loss_end", "ids").repartition("conv_id")
            .sortWithinPartitions("conv_id", "start").mapInArrow(_read_back(file, ranks), _READ))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public
    file, ranks = public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken")
    turns = only(read(spark, sf_dir, "conversations"), conv_id="long", turn="long", role="string", text="string")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], turns.schema)
    return read_back(format_turns(turns.unionByName(extra), file, ranks), file, ranks)


#: The rule in SQL, from the texts: what the ids must read back as.
CHAT_FORMAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(regexp_replace(role || chr(10) || text, '([<\[])(\\*)(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|[A-Za-z_]\w*\|>)',
                                  '\1\2\\\3', 'g')) - 1 AS chars
  FROM turns)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) + 23 * count(*) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
