"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole by a template, encoded once with character offsets, and its sorted turn spans are met
with the sorted token spans by binary search: that gives the loss mask over tokens and the spans of characters under it.

Template, turn by turn: ``### ROLE: TEXT </turn>`` and a line feed. Inside roles and texts a backslash stands before each
backslash, ``###`` and ``</turn>`` (in roles also before ``:`` and line feeds), so ``unescape`` and ``read_back`` restore
every conversation exactly.

Null text and null role count as empty. Turns are ordered by turn number (null first), then role and text, so tied and
repeated rows have a fixed order; each row is a turn. Rows with a null conversation id form one conversation. Empty
texts give empty spans. An empty table gives no conversation. Further columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, IntegerType, LongType, StringType, StructField, StructType

HEAD, MIDDLE, TAIL = "### ", ": ", " </turn>\n"
_IN_TEXT = re.compile(r"\\|###|</turn>")
_IN_ROLE = re.compile(r"\\|###|</turn>|[:\n]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*) </turn>\n", re.S)
#: conversations encoded at a time, in characters
BATCH_CHARS = 4 << 20


def escape(text: str, role: bool = False) -> str:
    return (_IN_ROLE if role else _IN_TEXT).sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the span of each turn's (escaped) text in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = HEAD + escape(role, True) + MIDDLE, escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, TAIL)
        at = spans[-1][1] + len(TAIL)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, unescaped."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Tokens that meet one of the spans, and the characters of each span that its tokens cover.

    ``starts`` and ``ends`` are sorted; several tokens may share the characters of one code point.
    """
    mask, covered = np.zeros(len(starts), np.int8), []
    if spans and len(starts):
        span = np.array(spans, np.int64)
        first = np.searchsorted(ends, span[:, 0], side="right")
        last = np.searchsorted(starts, span[:, 1], side="left")
        for (a, b), i, j in zip(spans, first.tolist(), last.tolist()):
            if b > a and j > i:
                mask[i:j] = 1
                covered.append((max(a, int(starts[i])), min(b, int(ends[j - 1]))))
    return mask, covered


_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])


def format_chats(df: DataFrame, tokenizer: str, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: its formatted text, token ids, loss mask and the character spans under the mask.

    ``df`` has conv_id, turn, role, text. ``tokenizer`` is the path of a tokenizers file with offsets.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = df.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    out = StructType([
        StructField("conv_id", df.schema["conv_id"].dataType), StructField("formatted", StringType()),
        StructField("input_ids", ArrayType(IntegerType())), StructField("loss_mask", ArrayType(ByteType())),
        StructField("loss_spans", ArrayType(_SPAN)),
    ])

    def encoded(ids: list, chats: list) -> pa.RecordBatch:
        tokens, masks, spans = [], [], []
        for e, (text, turn_spans) in zip(_tokenizer(tokenizer).encode_batch([c[0] for c in chats], add_special_tokens=False), chats):
            at = np.array(e.offsets, np.int64).reshape(-1, 2)
            mask, covered = token_mask(at[:, 0], at[:, 1], turn_spans)
            tokens.append(np.array(e.ids, np.int32))
            masks.append(mask)
            spans.append([{"start": a, "end": b} for a, b in covered])
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns = [ids, pa.array([c[0] for c in chats], pa.string()), pa.array(tokens, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8())), pa.array(spans, span_type)]
        return pa.RecordBatch.from_arrays(columns, names=out.fieldNames())

    def run(batches):
        for b in batches:
            done, chats, chars = 0, [], 0
            for i, turns in enumerate(b.column("turns")):
                rows = [(t["role"], t["text"]) for t in turns.as_py()]
                formatted, spans = render(rows)
                chats.append((formatted, [s for s, r in zip(spans, rows) if r[0] in loss_roles]))
                chars += len(formatted)
                if chars >= BATCH_CHARS or i + 1 == b.num_rows:
                    yield encoded(b.column("conv_id").slice(done, len(chats)), chats)
                    done, chats, chars = i + 1, [], 0

    return chats.mapInArrow(run, out)


def digests(formatted: DataFrame) -> DataFrame:
    """Figures read back from the output of ``format_chats``."""
    out = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long"

    def run(batches):
        for b in batches:
            rows = []
            for c in b.to_pylist():
                turns = read_back(c["formatted"])
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(unescape(c["formatted"][s["start"] : s["end"]]) for s in c["loss_spans"])
                rows.append((
                    c["conv_id"], len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), len(c["formatted"]), len(c["input_ids"]), sum(c["loss_mask"]),
                ))
            names = [f.split()[0] for f in out.split(", ")]
            types = [pa.string() if "sha256" in n else pa.int64() for n in names]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return formatted.mapInArrow(run, out)


PROBE = r"\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema)
    chats = format_chats(rows.unionByName(probe), public_tokenizers.path("byte_bpe_50k.json"))
    return digests(chats).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### : ' || ' </turn>') + 1 + length(regexp_replace(role, '(\\|###|</turn>|[:\n])', '\\\1', 'g'))
      + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
