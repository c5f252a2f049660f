r"""Chat formatting with prefix-target expansion.

A conversation becomes one transcript, ``<|im_start|>role\n text <|im_end|>\n`` a turn.  Control strings inside
roles and texts are escaped reversibly: every ``<``, backslashes, ``|`` gains one backslash, so ``<|`` marks
control strings only.  Every assistant turn is an example of its own: its context is the transcript before the
turn, its target the reply.  The transcript is kept once, with every example's offsets into it, so a conversation of n turns
needs n rows and not n * n / 2 texts.  ``expanded`` explodes it into the examples, each with its target and the digest of its whole
context; ``materialised`` spells the contexts out.

Rows are dealt by conversation, sorted by turn and streamed: one batch is held at a time, whatever the length
of the conversation.  A digest of a conversation is sequential by nature, so its rows pass through one task.

Defined cases: a null text or role is empty; rows with a null id form one conversation with a null id; a null
turn comes first; rows of equal turn come by role, then text, and each counts, repeated rows too; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"

_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<(\\*)\\\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*)" + re.escape(END) + "\n", re.DOTALL)


def escaped(text: str) -> str:
    return _OPEN.sub(r"<\1\\|", text)


def unescaped(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def formatted_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's part of the transcript, and where its text starts and ends in that part."""
    # a line break in a role would end it early
    head = START + escaped(role.replace("%", "%25").replace("\n", "%0A")) + "\n"
    body = escaped(text)
    return head + body + END + "\n", len(head), len(head) + len(body)


def parsed_turn(part: str) -> tuple[str, str]:
    m = _TURN.fullmatch(part)
    return unescaped(m[1]).replace("%0A", "\n").replace("%25", "%"), unescaped(m[2])


def _parts(batches):
    """Sorted turns to transcript rows: part, offset in the transcript, and the span under the loss mask."""
    key, seq, at = object(), 0, 0
    for b in batches:
        ids, roles, texts = (b.column(i).to_pylist() for i in (0, 2, 3))
        out = []
        for i, role, text in zip(ids, roles, texts):
            if i != key:
                key, seq, at = i, 0, 0
            part, s, e = formatted_turn(role or "", text or "")
            mine = role == ASSISTANT
            out.append((i, seq, part, at, at + s if mine else None, at + e if mine else None))
            seq, at = seq + 1, at + len(part)
        cols = list(zip(*out)) if out else [[]] * 6
        kinds = (b.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)],
            ["conv_id", "part_no", "part", "part_start", "target_start", "target_end"],
        )


def formatted(turns: DataFrame) -> DataFrame:
    """Transcript rows of ``turns`` (conv_id, turn, role, text), each conversation in order within a partition.

    A row with ``target_start`` is an example: the transcript up to ``target_start`` is its context, and
    [target_start, target_end) is the only part that is trained on.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    dealt = turns.select("conv_id", "turn", "role", "text").repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        _parts,
        f"conv_id {kind}, part_no long, part string, part_start long, target_start long, target_end long",
    )


def materialised(parts: DataFrame, conv_ids: list | None = None) -> DataFrame:
    """The examples as texts, of all or of some conversations: conv_id, part_no, context, target (escaped).

    Every example repeats all turns before it, so a conversation's examples grow with the square of its turns.
    """
    some = parts if conv_ids is None else parts.where(F.col("conv_id").isin(conv_ids))
    whole = some.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part_no", "part"))), lambda x: x["part"]), "").alias("__t")
    )
    return (
        some.where("target_start IS NOT NULL")
        .join(whole.withColumnRenamed("conv_id", "__id"), F.col("conv_id").eqNullSafe(F.col("__id")))
        .selectExpr(
            "conv_id",
            "part_no",
            "substring(__t, 1, cast(target_start AS int)) AS context",
            "substring(__t, cast(target_start + 1 AS int), cast(target_end - target_start AS int)) AS target",
        )
    )


_EXAMPLES = "conv_id {kind}, example long, context_turns long, context_chars long, context_sha256 string, target string, formatted_chars long"


def _expanded(batches):
    """Sorted transcript rows to examples: the digest of a context is that of the transcript so far, taken as it grows."""
    names = ["conv_id", "example", "context_turns", "context_chars", "context_sha256", "target", "formatted_chars"]
    kind, key, state = None, object(), None
    for b in batches:
        kind, out = b.schema.field(0).type, []
        for i, n, part, at, s, e in zip(*(b.column(c).to_pylist() for c in range(6))):
            if state is None or i != key:
                key, state = i, [0, 0, hashlib.sha256()]
            if n != state[0]:
                raise ValueError("the parts of a conversation must come together, in their order")
            if s is not None:
                context = state[2].copy()
                context.update(part[: s - at].encode("utf-8", "surrogatepass"))
                target = unescaped(part[s - at : e - at])
                out.append((i, state[1], n, s, context.hexdigest(), target, at + len(part)))
                state[1] += 1
            state[2].update(part.encode("utf-8", "surrogatepass"))
            state[0] += 1
        cols = list(zip(*out)) if out else [[]] * 7
        kinds = (kind, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def _in_order(parts: DataFrame) -> DataFrame:
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part_no")


def expanded(parts: DataFrame, ordered: bool = False) -> DataFrame:
    """One row an assistant turn: what it is trained on (unescaped), and its context as turns, characters and digest.

    The context is the transcript from its start up to the target, whole; it is known by its digest, and ``materialised``
    spells it out.  ``ordered`` says that ``parts`` come as ``formatted`` gives them; it is checked, and else they are sorted.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()
    return (parts if ordered else _in_order(parts)).mapInArrow(_expanded, _EXAMPLES.format(kind=kind))


def _digested(batches):
    """Reads transcript rows back: one row a conversation, from the written parts and masks alone.

    Every assistant turn is an example; ``contexts_sha256`` is over the digests of the examples' contexts in order.
    """
    names = [x.split()[0] for x in _DIGESTS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    types = [kinds[x.split()[1]] for x in _DIGESTS.split(", ")[1:]]
    kind, key, state = None, object(), None

    def row():
        n, turns, chars, loss, size, examples, context_chars, contexts, _ = state
        return key, n, turns.hexdigest(), chars, loss.hexdigest(), size, examples, context_chars, contexts.hexdigest()

    def batch(rows):
        cols = list(zip(*rows)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [kind, *types])], names)

    for b in batches:
        kind, done = b.schema.field(0).type, []
        for i, place, part, at, s, e in zip(*(b.column(c).to_pylist() for c in range(6))):
            if state is None or i != key:
                if state is not None:
                    done.append(row())
                key, state = i, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0, hashlib.sha256(), hashlib.sha256()]
            if place != state[0]:
                raise ValueError("the parts of a conversation must come together, in their order")
            role, text = parsed_turn(part)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if s is not None:
                masked = unescaped(part[s - at : e - at])
                state[2] += len(masked)
                state[3].update(masked.encode("utf-8", "surrogatepass"))
                context = state[8].copy()
                context.update(part[: s - at].encode("utf-8", "surrogatepass"))
                state[5] += 1
                state[6] += s
                state[7].update(context.digest())
            state[4] += len(part)
            state[8].update(part.encode("utf-8", "surrogatepass"))
        yield batch(done)
    if state is not None:
        yield batch([row()])


_DIGESTS = (
    "conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long,"
    " n_examples long, context_chars long, contexts_sha256 string"
)


def digests(parts: DataFrame, ordered: bool = False) -> DataFrame:
    """One row a conversation, read back from its transcript rows and the examples in them; ``ordered`` as of ``expanded``."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    return (parts if ordered else _in_order(parts)).mapInArrow(_digested, _DIGESTS.format(kind=kind))


#: Characters of a transcript up to which an example has its whole context; and of a row that continues the one before.
WHOLE = 1 << 16
_EXAMPLE_ROWS = "conv_id {kind}, row_no long, base long, prefix string, target string"


def _spelled(batches):
    """Sorted transcript rows to rows of ``examples``."""
    names = [x.split()[0] for x in _EXAMPLE_ROWS.split(", ")]
    kind, key, state = None, object(), None  # parts, rows, whole transcript or None, what follows the last row

    def batch(rows):
        cols = list(zip(*rows)) if rows else [[]] * 5
        kinds = (kind, pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    def row(prefix, target, whole=False):
        n = state[1]
        state[1] += 1
        return key, n, n - 1 if n and not whole else None, prefix, target

    for b in batches:
        kind, out, size = b.schema.field(0).type, [], 0
        for i, n, part, at, s, e in zip(*(b.column(c).to_pylist() for c in range(6))):
            if state is None or i != key:
                if state is not None:
                    out.append(row(state[3], None))
                key, state = i, [0, 0, "", ""]
            if n != state[0]:
                raise ValueError("the parts of a conversation must come together, in their order")
            state[0] += 1
            if s is not None:
                head, target = part[: s - at], part[s - at : e - at]
                whole = state[2] is not None
                out.append(row((state[2] if whole else state[3]) + head, target, whole))
                size += len(out[-1][3]) + len(target)
                state[3] = part[e - at :]
            else:
                state[3] += part
                if len(state[3]) > WHOLE:
                    out.append(row(state[3], None))
                    state[3] = ""
            state[2] = state[2] + part if state[2] is not None and at + len(part) <= WHOLE else None
            if size > 16 * WHOLE:
                yield batch(out)
                out, size = [], 0
        yield batch(out)
    if state is not None:
        yield batch([row(state[3], None)])


def examples(parts: DataFrame, ordered: bool = False) -> DataFrame:
    """Prefix-target expansion, spelled out: a row an assistant turn with its ``prefix`` and its ``target`` (escaped).

    A row without ``base`` has its whole context as prefix.  Where a transcript is longer than WHOLE, so that contexts would grow with the
    square of the turns, the context of a row is that of row ``base``, that row's target and the prefix.  Rows without target
    carry what no example ends with.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()
    return (parts if ordered else _in_order(parts)).mapInArrow(_spelled, _EXAMPLE_ROWS.format(kind=kind))


_WRITTEN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def _read_examples(batches):
    """Sorted rows of ``examples`` to the columns of ``digests``, from their prefixes and targets alone."""
    names = [x.split()[0] for x in _DIGESTS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    types = [kinds[x.split()[1]] for x in _DIGESTS.split(", ")[1:]]
    kind, key, x = None, object(), None

    def start():
        return {"rows": 0, "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "size": 0, "examples": 0,
                "context": 0, "contexts": hashlib.sha256(), "run": hashlib.sha256(), "open": ""}

    def fed(text):
        x["run"].update(text.encode("utf-8", "surrogatepass"))
        x["size"] += len(text)
        x["open"] += text
        end = 0
        while m := _WRITTEN.match(x["open"], end):
            role, said = unescaped(m[1]).replace("%0A", "\n").replace("%25", "%"), unescaped(m[2])
            x["turns"].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            x["n"], end = x["n"] + 1, m.end()
        x["open"] = x["open"][end:]

    def row():
        if x["open"]:
            raise ValueError("a turn does not end")
        return key, x["n"], x["turns"].hexdigest(), x["chars"], x["loss"].hexdigest(), x["size"], x["examples"], x["context"], x["contexts"].hexdigest()

    def batch(rows):
        cols = list(zip(*rows)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [kind, *types])], names)

    for b in batches:
        kind, done = b.schema.field(0).type, []
        for i, n, base, prefix, target in zip(*(b.column(c).to_pylist() for c in range(5))):
            if x is None or i != key:
                if x is not None:
                    done.append(row())
                key, x = i, start()
            if n != x["rows"]:
                raise ValueError("the rows of a conversation must come together, in their order")
            x["rows"] += 1
            if base is None:  # a whole context begins with all that came before
                if hashlib.sha256(prefix[: x["size"]].encode("utf-8", "surrogatepass")).digest() != x["run"].digest():
                    raise ValueError("a context does not continue the transcript")
                prefix = prefix[x["size"] :]
            fed(prefix)
            if target is not None:
                x["examples"] += 1
                x["context"] += x["size"]
                x["contexts"].update(x["run"].digest())
                said = unescaped(target)
                x["chars"] += len(said)
                x["loss"].update(said.encode("utf-8", "surrogatepass"))
                fed(target)
        yield batch(done)
    if x is not None:
        yield batch([row()])


def example_digests(rows: DataFrame) -> DataFrame:
    """One row a conversation as of ``digests``, read back from the rows of ``examples`` as they come."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(_read_examples, _DIGESTS.format(kind=kind))
