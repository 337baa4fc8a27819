"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string. Nothing is
known about it: the successive prefixes of a conversation are rendered, and
what each output adds to the one before is the span of the newest turn. Inside
a span the text's own place is found by rendering the turn with two probe
texts and comparing what stays equal on both sides. If an output does not
continue the one before, the template rewrites history. The first such turn is
reported, and the places of all texts are found by probing the whole
conversation; a turn's span is then its text's place, and a text the template
has dropped has an empty place at the end.

``inst_template`` is the template of the query. It marks every turn and puts a
backslash into control strings that occur in a text, so that ``read_back``
gives the turns exactly.

A conversation's turns are rendered in one task, which streams over
conversations sorted by id and turn; it holds one conversation at a time.
Rendering all prefixes costs the square of a conversation's length.

Defined results: NULL text or role counts as empty; turns of one number follow
in the order of role and text, NULL turns first; repeated rows are turns of
their own; rows without ``conv_id`` are one conversation with a NULL id; an
empty table gives no rows. Only the four columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestrata.llm.common import Batches, pylist

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

PROBES = ("\ue000", "\ue001")

# Control strings of the template.
CONTROL = ["<</ROLE>>", "<</SYS>>", "<<SYS>>", "<<ROLE", "[/INST]", "[INST]", "</s>", "<s>"]
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n\n"
    r"|<<ROLE (?P<role>.*?)>>\n(?P<other>.*?)\n<</ROLE>>\n| (?P<assistant>.*?) </s>",
    re.DOTALL,
)


def escaped(text: str) -> str:
    """No control string is left; ``unescaped`` undoes it."""
    return _CONTROL.sub(lambda m: m.group()[0] + "\\" + m.group()[1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def _role(role: str) -> str:
    """A role's name, with ``>`` escaped too, since it ends the mark."""
    return escaped(role).replace(">", "\\>")


def inst_template(turns: Turns) -> str:
    parts = ["<s>"]
    for role, text in turns:
        body = escaped(text)
        if role == "user":
            parts.append(f"[INST] {body} [/INST]")
        elif role == "assistant":
            parts.append(f" {body} </s>")
        elif role == "system":
            parts.append(f"<<SYS>>\n{body}\n<</SYS>>\n\n")
        else:
            parts.append(f"<<ROLE {_role(role)}>>\n{body}\n<</ROLE>>\n")
    return "".join(parts)


def read_back(formatted: str) -> Turns:
    """The turns of an output of ``inst_template``."""
    turns: Turns = []
    at = len("<s>")
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        role = unescaped(m.group("role")) if kind == "other" else kind
        turns.append((role, unescaped(m.group(kind))))
        at = m.end()
    return turns


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while low + 1 < high:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _place(template: Template, turns: Turns, k: int, length: int) -> tuple[int, int]:
    """Where the text of turn ``k`` lies in the output for ``turns``."""
    role = turns[k][0]
    one, two = (template([*turns[:k], (role, probe), *turns[k + 1 :]]) for probe in PROBES)
    before = common_prefix(one, two)
    after = common_prefix(one[before:][::-1], two[before:][::-1])
    return before, max(before, length - after)


def render(turns: Turns, template: Template) -> tuple[str, list[tuple[int, int, int, int]], int | None]:
    """The output, (start, end, text start, text end) of every turn, and the
    first turn whose rendering changed what was there before, if any."""
    spans: list[tuple[int, int, int, int]] = []
    before = ""
    rewritten = None
    for k in range(len(turns)):
        output = template(turns[: k + 1])
        start = common_prefix(before, output)
        if start < len(before) and rewritten is None:
            rewritten = k
        if rewritten is None:
            spans.append((start, len(output), *_place(template, turns[: k + 1], k, len(output))))
        before = output
    if rewritten is not None:
        places = [_place(template, turns, k, len(before)) for k in range(len(turns))]
        spans = [(low, high, low, high) for low, high in places]
    return before, spans, rewritten


FORMATTED = (
    "conv_id long, formatted string, roles array<string>, "
    "spans array<struct<start:bigint,end:bigint,text_start:bigint,text_end:bigint>>, rewritten_at int"
)


def _rendered(template: Template):
    span = pa.struct([(n, pa.int64()) for n in ("start", "end", "text_start", "text_end")])
    names = ["conv_id", "formatted", "roles", "spans", "rewritten_at"]
    kinds = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(span), pa.int32()]

    def batch_of(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    def finished(conv_id, turns: Turns) -> tuple:
        output, spans, rewritten = render(turns, template)
        rows = [dict(zip(("start", "end", "text_start", "text_end"), s)) for s in spans]
        return conv_id, output, [r for r, _ in turns], rows, rewritten

    def run(batches: Batches) -> Batches:
        own: tuple | None = None
        turns: Turns = []
        for batch in batches:
            done = []
            for conv_id, role, text in zip(pylist(batch, "conv_id"), pylist(batch, "role"), pylist(batch, "text")):
                if own is not None and own[0] != conv_id:
                    done.append(finished(own[0], turns))
                    turns = []
                own = (conv_id,)
                turns.append((role, text))
            if done:
                yield batch_of(done)
        if own is not None:
            yield batch_of([finished(own[0], turns)])

    return run


def format_conversations(rows: DataFrame, template: Template = inst_template) -> DataFrame:
    """One row per conversation: the formatted text, its roles, the place of
    every turn and of its text, and where the template rewrote history."""
    source = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    ordered = source.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_rendered(template), FORMATTED)


def loss_text(formatted: str, roles: list[str], spans: list[dict]) -> str:
    """What the loss is taken over: the assistant's texts, as they were."""
    return "".join(
        unescaped(formatted[s["text_start"] : s["text_end"]]) for role, s in zip(roles, spans) if role == "assistant"
    )
