"""Chat formatting by incremental rendering of a template that is treated as a black box.

A template is any function from a list of ``(role, text)`` to a string. Successive prefixes of a conversation
are rendered and consecutive outputs compared: what a turn appends is its span. The text inside the span is
found by rendering the prefix with two probe texts in its place; what both outputs share in front and behind
is markup. If an output does not begin with the output before, the template rewrites history: the turns it
touched are marked and carry no loss.

Every prefix is rendered, which costs the square of the number of turns. A caller who knows that the template never
rewrites may ask for a ``window``: prefixes of longer conversations are then rendered within windows of the latest
turns, and the pieces are checked against one rendering of the whole conversation. A template that fails the
check gets every prefix rendered after all, but a rewrite that a later turn undoes stays unseen.

Conversations are streamed: a task holds one conversation at a time, which is one output string by definition.
"""

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import as_text, map_groups

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
PROBES = ("A", "B")

HEAD, COLON, TAIL = "### ", ": ", " </turn>\n"
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*) </turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """No control string of the template is left: ``#`` and ``</`` get a backslash, backslashes are doubled."""
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</", "<\\/")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def turn_template(turns: list[Turn]) -> str:
    """``### role: text </turn>`` and a newline for each turn, role and text escaped."""
    return "".join(f"{HEAD}{escape(role).replace(':', chr(92) + ':')}{COLON}{escape(text)}{TAIL}" for role, text in turns)


def read_turn(segment: str) -> Turn:
    """Role and text of one turn of ``turn_template``."""
    found = TURN.fullmatch(segment)
    if not found:
        raise ValueError("not one formatted turn")
    return unescape(found[1]), unescape(found[2])


@dataclass
class Span:
    """Where a turn stands in the output (``start``, ``end``), and its text inside (``text_start``, ``text_end``)."""

    start: int
    end: int
    text_start: int
    text_end: int
    rewritten: bool = False


def common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _probe(before: list[Turn], role: str, render: Template) -> tuple[int, int]:
    """Lengths of the markup in front of and behind the text of a last turn with this role."""
    a, b = (render([*before, (role, p)]) for p in PROBES)
    front = common_prefix(a, b)
    behind = common_prefix(a[front:][::-1], b[front:][::-1])
    return front, behind


def _prefixes(turns: list[Turn], render: Template, context: list[Turn]) -> tuple[str, str, list[Span]]:
    """(output of the context, output with all turns, spans of the turns) by rendering each prefix behind ``context``."""
    base = out = render(context)
    spans: list[Span] = []
    for k, (role, _) in enumerate(turns):
        before = [*context, *turns[:k]]
        longer = render([*before, turns[k]])
        kept = common_prefix(out, longer)
        if kept < len(out):
            for span in spans:
                span.rewritten |= span.end > kept
        front, behind = _probe(before, role, render)
        start = min(max(front, kept), len(longer))
        spans.append(Span(kept, len(longer), start, max(start, len(longer) - behind)))
        out = longer
    return base, out, spans


def locate(turns: list[Turn], render: Template, window: int | None = None) -> tuple[str, list[Span]]:
    """The formatted conversation and the span of each turn in it."""
    if window is None or len(turns) <= window:
        _, out, spans = _prefixes(turns, render, [])
        return out, spans
    whole = render(turns)
    at, spans = len(render([])), []
    for first in range(0, len(turns), window):
        context = turns[max(0, first - window) : first]
        base, out, own = _prefixes(turns[first : first + window], render, context)
        added = out[len(base) :]
        if not out.startswith(base) or whole[at : at + len(added)] != added or any(s.start < len(base) for s in own):
            break
        shift = at - len(base)
        spans += [Span(s.start + shift, s.end + shift, s.text_start + shift, s.text_end + shift, s.rewritten) for s in own]
        at += len(added)
    else:
        if at == len(whole):
            return whole, spans
    _, out, spans = _prefixes(turns, render, [])
    return out, spans


SPAN_TYPE = pa.struct(
    [
        ("role", pa.string()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("text_start", pa.int64()),
        ("text_end", pa.int64()),
        ("loss", pa.bool_()),
        ("rewritten", pa.bool_()),
    ]
)
SPAN_SQL = (
    "array<struct<role:string,start:bigint,end:bigint,text_start:bigint,text_end:bigint,loss:boolean,rewritten:boolean>>"
)


def format_conversations(
    turns: DataFrame,
    template: Template = turn_template,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = "assistant",
    window: int | None = None,
) -> DataFrame:
    """``conv_id, n_turns, formatted, spans, rewrites`` for each conversation of a table with one row per turn.

    Turns are ordered by number (null first), then role and text, so that repeated numbers have a fixed order;
    repeated rows are turns of their own. A null role or text is empty. Rows without a conversation id form one
    conversation whose id is null. ``spans`` locate each turn and its text in ``formatted`` (code points);
    ``loss`` marks the text of ``trained_role`` unless a later prefix rewrote it; ``rewrites`` tells if any turn was
    rewritten. An empty table gives no rows; other columns are not read.
    """
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def one(key, table):
        messages = list(zip(table.column("role").to_pylist(), table.column("text").to_pylist(), strict=True))
        out, spans = locate(messages, template, window)
        found = [
            {**vars(s), "role": role, "loss": role == trained_role and not s.rewritten}
            for s, (role, _) in zip(spans, messages, strict=True)
        ]
        return pa.table(
            {
                "conv_id": pa.array([key[0]], pa.int64()),
                "n_turns": pa.array([len(messages)], pa.int64()),
                "formatted": pa.array([out], pa.string()),
                "spans": pa.array([found], pa.list_(SPAN_TYPE)),
                "rewrites": pa.array([any(s.rewritten for s in spans)], pa.bool_()),
            }
        )

    return map_groups(
        rows,
        ["conv_id"],
        ["turn", "role", "text"],
        one,
        f"conv_id long, n_turns long, formatted string, spans {SPAN_SQL}, rewrites boolean",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites`` from formatted output
    of ``turn_template``: turns are parsed from their spans, the loss text is cut out by the mask."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text = as_text(text)
                turns, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                for s in spans or []:
                    role, said = read_turn(text[s["start"] : s["end"]])
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    if s["loss"]:
                        trained = unescape(text[s["text_start"] : s["text_end"]])
                        loss.update(trained.encode("utf-8", "surrogatepass"))
                        chars += len(trained)
                rows.append((len(spans or []), turns.hexdigest(), chars, loss.hexdigest(), len(text)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.string()),
                    pa.array(columns[4], pa.int64()),
                    batch.column(3),
                ],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"],
            )

    return formatted.select("conv_id", "formatted", "spans", "rewrites").mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long,"
        " rewrites boolean",
    )
