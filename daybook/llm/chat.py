"""Conversations as training text: marked turns, reversibly escaped, with the spans that a model learns.

A template (see template.py) writes each turn. Rows are dealt into ranges of (conversation, turn, role,
text) of equal size and sorted, so that a conversation that holds a third of all rows is spread over many
tasks. A pass over the sorted rows numbers them within their conversation as far as the range goes; the
conversations that a range shares with its neighbours, two at most, are listed beside (two rows a range),
and sums over that list say where a range begins in them. So each turn knows its number, and whether it is
the first or the last, wherever it lies. What a task writes are pieces: runs of turns of one conversation,
up to PIECE_CHARS or one turn that is longer. Most conversations are one piece.

Control strings inside texts and roles get a backslash before each place where one begins, backslashes
are doubled, and in a role, which a line end closes, line ends get one too. So a control string without a
backslash is the template's own, and reading a piece back gives roles and texts as they were.

Null texts and roles are empty. Null turns come first; rows that share a turn are ordered by role and a hash
of the text, and repeated rows are turns of their own. Null ids are one conversation. Very long texts are written whole.
Empty tables give no rows. Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import small_parts, table, written
from .template import FILTERS, Sheet, Template, Turn

#: Fixed values of the format.
TURN, END, CONTROLS = "### ", "</turn>\n", ("###", "</turn>")
TEMPLATE = """{# every turn is marked; what assistants say is learned #}{% for turn in turns %}{{ '### ' ~ (turn.role | label) }}
{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}{% else %}{{ turn.text | escape }}{% endif %}</turn>
{% endfor %}"""
#: Characters after which a piece ends with its turn.
PIECE_CHARS = 1 << 20

_BEGINS = "|".join(f"(?={re.escape(c)})" for c in CONTROLS)
_ESCAPED, _LABELLED = re.compile(rf"\\|{_BEGINS}"), re.compile(rf"\\|\n|{_BEGINS}")
_PLAIN = re.compile(r"\\(.)", re.S)
_MARKS = re.compile(rf"\\.|{re.escape(TURN)}|{re.escape(END)}", re.S)


def escape(text: str) -> str:
    return _ESCAPED.sub(r"\\\g<0>", text)


def label(role: str) -> str:
    return _LABELLED.sub(r"\\\g<0>", role)


def unescape(text: str) -> str:
    return _PLAIN.sub(r"\1", text)


CHAT_FILTERS = FILTERS | {"escape": escape, "label": label}


def read_turns(text: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn of a formatted piece, unescaped."""
    turns, begun = [], None
    for m in _MARKS.finditer(text):
        if m[0] == TURN:
            begun = m.end()
        elif m[0] == END:
            own = text[begun : m.start()]
            cut = next(x.start() for x in re.finditer(r"\\.|\n", own, re.S) if x[0] == "\n")
            turns.append((unescape(own[:cut]), unescape(own[cut + 1 :])))
    return turns


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a range's sorted rows: its number, the run of equal conversations, the number in it, whether it ends here. At the end a row without text for the first and the last run, with its length."""
    import numpy as np
    import pyarrow.compute as pc
    from pyspark import TaskContext

    names = ["conv", "role", "text", "part", "run", "k", "ends", "kind"]
    part = TaskContext.get().partitionId()
    run, count, last, held, first = -1, 0, None, None, None

    def batch(rows: pa.RecordBatch, run, k, ends) -> pa.RecordBatch:
        n = rows.num_rows
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(n, part)), pa.array(run), pa.array(k), pa.array(ends), pa.array(np.zeros(n, np.int32))], names=names)

    for rows in small_parts(batches, 4096):
        ids = rows.column(0)
        new = np.ones(rows.num_rows, bool)
        if rows.num_rows > 1:
            a, b = ids.slice(1), ids.slice(0, rows.num_rows - 1)
            both_null = pc.and_(pc.is_null(a), pc.is_null(b))
            new[1:] = ~pc.if_else(both_null, True, pc.fill_null(pc.equal(a, b), False)).to_numpy(zero_copy_only=False)
        new[0] = run < 0 or ids[0].as_py() != last
        if held is not None:  # the row before, which waited for this one
            yield batch(*held, np.array([bool(new[0])]))
        runs = run + np.cumsum(new)
        starts = np.nonzero(new)[0]
        k = np.arange(rows.num_rows) - np.maximum.accumulate(np.where(new, np.arange(rows.num_rows), -count))
        if first is None:
            first = ids[0].as_py()
        if run <= 0:
            in_first = int((runs == 0).sum())
            first_count = in_first + (count if run == 0 else 0)
        ends = np.r_[new[1:], False]
        run, last, count = int(runs[-1]), ids[rows.num_rows - 1].as_py(), int(k[-1]) + 1
        yield batch(rows.slice(0, rows.num_rows - 1), runs[:-1], k[:-1], ends[:-1])
        held = (rows.slice(rows.num_rows - 1, 1), runs[-1:], k[-1:])
    if held is not None:
        yield batch(*held, np.array([True]))
        edges = [(first, 0, first_count)] + ([(last, run, count)] if run else [])
        none = [None] * len(edges)
        columns = [[e[0] for e in edges], none, none, [part] * len(edges), [e[1] for e in edges], [e[2] for e in edges], [False] * len(edges), [1] * len(edges)]
        kinds = [held[0].schema.field(0).type, pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def numbered_turns(rows: DataFrame) -> DataFrame:
    """conv, role, text, part, run, n (number of the turn in its conversation), first, last; sorted stretches of rows (conv, turn, role, text)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = rows.withColumn("_row", F.monotonically_increasing_id())  # repeated rows are spread, too
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role"]
    dealt = marked.repartitionByRange(parts, *order, F.xxhash64("text"), "_row").sortWithinPartitions(*order, F.xxhash64("text"), "text")
    kinds = f"conv {rows.schema['conv'].dataType.simpleString()}, role string, text string, part long, run long, k long, ends boolean, kind int"
    found = written(dealt.select("conv", "role", "text").mapInArrow(_numbered, kinds), "turns")
    # Two rows a range.
    at = W.partitionBy("conv").orderBy("part")
    before = F.coalesce(F.sum("k").over(at.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    edges = found.filter("kind = 1").select("part", "run", before.alias("before"), F.lag("part").over(at).isNull().alias("opens"), F.lead("part").over(at).isNull().alias("closes"))
    out = found.filter("kind = 0").join(F.broadcast(edges), ["part", "run"], "left")
    number = F.col("k") + F.coalesce("before", F.lit(0))
    return out.select("conv", "role", "text", "part", "run", number.alias("n"), (number == 0).alias("first"), (F.col("ends") & F.coalesce("closes", F.lit(True))).alias("last"))


PIECES = "start long, n_turns long, last boolean, text string, spans array<struct<begin:long,end:long>>"


def format_conversations(rows: DataFrame, template: str = TEMPLATE, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """key, start, n_turns, last, text, spans: pieces of formatted conversations.

    start: the number of a piece's first turn; last: whether it ends its conversation; spans: the characters
    of the text that a model learns. Pieces of a conversation in order of start are its whole text.
    """
    Template(template, CHAT_FILTERS)  # refused here, not in a task
    turns = numbered_turns(rows.select(F.col(key).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    kind = turns.schema["conv"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = Template(template, CHAT_FILTERS).write
        names = ["conv", "start", "n_turns", "last", "text", "spans"]
        done: list[tuple] = []
        size, at, sheet, start, count = 0, None, Sheet(), 0, 0

        def close(ended: bool) -> None:
            nonlocal size, sheet, count
            if count:
                done.append((at[0], start, count, ended, sheet.text(), [{"begin": a, "end": b} for a, b in sheet.spans]))
                size += sheet.size
            sheet, count = Sheet(), 0

        def batch() -> pa.RecordBatch:
            nonlocal size
            kinds = [conv_type, pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)
            done.clear()
            size = 0
            return out

        for rows in small_parts(batches):
            conv_type = rows.schema.field("conv").type
            for conv, role, text, part, run, n, first, last in zip(*(c.to_pylist() for c in rows.columns)):
                own = (conv, part, run)
                if count and (own != at or n != start + count or sheet.size >= piece_chars):
                    close(False)
                if not count:
                    at, start = own, n
                write(Turn(role, text, first, last, n), sheet.emit)
                count += 1
                if last:
                    close(True)
                if size >= 4 * PIECE_CHARS or len(done) >= 4096:
                    yield batch()
        close(False)
        if done:
            yield batch()

    out = turns.mapInArrow(pieces, f"conv {kind}, {PIECES}")
    return out.withColumnRenamed("conv", key)


_READ = "start long, n_turns long, last boolean, chars long, loss_chars long, whole boolean, turns string, loss string"


def read_back(pieces: DataFrame, key: str = "conv_id") -> DataFrame:
    """key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of whole conversations, read from their formatted pieces.

    Conversations of one piece are digested where they lie, so only those of several are sent, in order, to
    the task that digests them piece by piece: a digest is a chain, which no two tasks can share.
    """
    kind = pieces.schema[key].dataType.simpleString()
    names = [key, *(x.split()[0] for x in _READ.split(", "))]

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in small_parts(batches, 256):
            out = []
            for conv, start, n, last, text, spans in zip(*(c.to_pylist() for c in rows.columns)):
                turns = "".join(f"{role}\n{said}\n" for role, said in read_turns(text))
                loss = "".join(unescape(text[s["begin"] : s["end"]]) for s in spans)
                whole = last and start == 0
                size = len(loss)
                if whole:
                    turns, loss = (hashlib.sha256(x.encode()).hexdigest() for x in (turns, loss))
                out.append((conv, start, n, last, len(text), size, whole, turns, loss))
            kinds = [rows.schema.field(0).type, pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for rows in small_parts(batches, 256):
            out = []
            for conv, start, n, last, chars, loss_chars, whole, turns, loss in zip(*(c.to_pylist() for c in rows.columns)):
                if whole:
                    out.append((conv, n, turns, loss_chars, loss, chars))
                    continue
                if start == 0:
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for k, x in ((0, n), (2, loss_chars), (4, chars)):
                    state[k] += x
                state[1].update(turns.encode())
                state[3].update(loss.encode())
                if last:
                    out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
            if out:
                kinds = [rows.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    read = pieces.select(key, "start", "n_turns", "last", "text", "spans").mapInArrow(parsed, f"`{key}` {kind}, {_READ}")
    read = read.repartition(key).sortWithinPartitions(key, "start")
    return read.mapInArrow(chained, f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    fixed = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return read_back(format_conversations(rows.union(fixed)))


def oracle() -> str:
    """What comes back, and how long the marks, escapes and texts are, without a template."""
    blank = r"\### Assistant: </turn> ok"
    return f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '{blank}' UNION ALL SELECT -7, 1, 'assistant', '{blank}'),
        sized AS (
            SELECT *, length(text) + length(regexp_replace(text, '[^\\\\]', '', 'g')) + len(list_filter(range(1, length(text) + 1), lambda i: substr(text, i, 3) = '###' OR substr(text, i, 7) = '</turn>')) AS text_chars,
                   length(role) + length(regexp_replace(role, '[^\\\\\\n]', '', 'g')) + len(list_filter(range(1, length(role) + 1), lambda i: substr(role, i, 3) = '###' OR substr(role, i, 7) = '</turn>')) AS role_chars
            FROM rows)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(4 + role_chars + 1 + text_chars + 8) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id"""
