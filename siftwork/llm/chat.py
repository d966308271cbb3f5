"""Chat formatting: a state machine over roles and a declarative template.

The turns of a conversation pass through a finite-state machine that says whether each role may follow, and come out as
text segments with a loss flag: header, body and end of each turn. Control strings of the template that occur inside a
text are escaped, so the formatted text can be read back exactly (:func:`read_back`).

The work is one shuffle by conversation and one sort inside partitions; then turns stream through a task, which holds only
the state of the conversation at hand. So a conversation of any length needs no more memory than its longest turn.

Defined results: null roles and texts are empty strings; a role the template does not know gets a generic header and is
invalid; turns are ordered by turn (nulls first), then role, then text; repeated turns all stay; rows with a null
conversation form one conversation. Conversations that break the turn order are formatted too, with ``valid`` false from
the first turn on that may not follow.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class ChatTemplate:
    """Headers by role, the end of a turn, the roles whose text carries loss, and the allowed successions of roles."""

    headers: dict[str, str] = field(
        default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
    )
    #: Header of any other role, which stands escaped between the two strings.
    other: tuple[str, str] = ("### Role <", ">: ")
    end: str = "</turn>\n"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    #: State to the roles that may follow; a role is the next state.
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )

    def __post_init__(self):
        controls = self.controls
        if any(not c.strip() or ESCAPE in c for c in controls):
            raise ValueError("control strings must not be blank or hold the escape character")
        if len(set(self.headers.values())) < len(self.headers) or any(h.startswith(self.other[0]) for h in self.headers.values()):
            raise ValueError("headers must differ from each other and from the generic header")
        # else the last characters of a text and the first of the control string after it could be read as that string
        stripped = self.end.strip()
        if any(stripped.startswith(stripped[k:]) for k in range(1, len(stripped))):
            raise ValueError("the end of a turn must not overlap itself")

    @property
    def controls(self) -> list[str]:
        """Strings that must not occur unescaped in a text (without the white space around them)."""
        return sorted({*(h.strip() for h in self.headers.values()), self.other[0], self.other[1].strip(), self.end.strip()})


class _Rules:
    """The regular expressions of a template; made once per task."""

    def __init__(self, template: ChatTemplate):
        self.template = template
        self.special = re.compile("|".join(map(re.escape, [ESCAPE, *sorted(template.controls, key=len, reverse=True)])))
        body = r"((?:[^\\]|\\.)*?)"
        known = "|".join(re.escape(h) for h in sorted(template.headers.values(), key=len, reverse=True))
        start, stop = map(re.escape, template.other)
        self.turn = re.compile(f"(?:({known})|{start}{body}{stop}){body}{re.escape(template.end)}", re.S)
        self.roles = {h: r for r, h in template.headers.items()}

    def escape(self, text: str) -> str:
        return self.special.sub(lambda m: ESCAPE + m[0], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def header(self, role: str) -> str:
        known = self.template.headers.get(role)
        return known if known is not None else self.template.other[0] + self.escape(role) + self.template.other[1]


SEGMENTS = "seq bigint, part string, segment string, loss boolean, valid boolean"


def format_turns(
    df: DataFrame, template: ChatTemplate | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``(conv, seq, part, segment, loss, valid)``: three segments per turn, numbered inside the conversation.

    ``part`` is ``header``, ``body`` or ``end``; the formatted conversation is its segments in order of ``seq``. Rows come
    out grouped by conversation and in order.
    """
    template = template or ChatTemplate()
    kind = dict(df.dtypes)[conv]
    rows = df.select(
        F.col(conv).alias("_c"), F.col(turn).alias("_t"), F.coalesce(role, F.lit("")).alias("_r"),
        F.coalesce(text, F.lit("")).alias("_x"),
    )
    ordered = rows.repartition("_c").sortWithinPartitions("_c", "_t", "_r", "_x")

    def run(batches):
        rules = _Rules(template)
        current, seq, state, valid = object(), 0, "", True
        for batch in batches:
            out = {k: [] for k in ("row", "seq", "part", "segment", "loss", "valid")}
            for i, (c, r, x) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("_c", "_r", "_x")))):
                if c != current:
                    current, seq, state, valid = c, 0, "", True
                valid = valid and r in template.follows.get(state, ())
                state = r
                for part, segment in (("header", rules.header(r)), ("body", rules.escape(x)), ("end", template.end)):
                    for k, v in zip(out, (i, seq, part, segment, part == "body" and r in template.loss_roles, valid)):
                        out[k].append(v)
                    seq += 1
            keys = batch.column("_c").take(pa.array(out.pop("row"), pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, *[pa.array(v) for v in out.values()]], names=[conv, *out])

    return ordered.mapInArrow(run, f"{conv} {kind}, {SEGMENTS}")


def read_back(segments: DataFrame, template: ChatTemplate | None = None, conv: str = "conv_id") -> DataFrame:
    """One row per conversation, read from the formatted text alone.

    ``n_turns``, ``turns_sha256`` (of role, line feed, text and line feed of each turn), ``loss_chars`` and ``loss_sha256``
    (of the unescaped text under the loss mask), ``formatted_chars``, ``valid``. Fails on text that is not as formatted.
    """
    template = template or ChatTemplate()
    kind = dict(segments.dtypes)[conv]
    ordered = segments.repartition(conv).sortWithinPartitions(conv, "seq")
    schema = (f"{conv} {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
              "formatted_chars bigint, valid boolean")

    def run(batches):
        rules = _Rules(template)
        names = [f.split()[0] for f in schema.split(", ")]
        keys, rows, now = [], [], None

        class Reading:
            def __init__(self):
                self.n = self.loss_chars = self.chars = 0
                self.turns, self.loss, self.valid, self.text, self.masked = hashlib.sha256(), hashlib.sha256(), True, [], []

            def close_turn(self):
                found = rules.turn.fullmatch("".join(self.text))
                if not found:
                    raise ValueError("a formatted turn cannot be read back")
                r = rules.roles[found[1]] if found[1] is not None else rules.unescape(found[2])
                self.turns.update(f"{r}\n{rules.unescape(found[3])}\n".encode())
                learned = rules.unescape("".join(self.masked))
                self.loss.update(learned.encode())
                self.loss_chars += len(learned)
                self.n, self.text, self.masked = self.n + 1, [], []

            def row(self):
                if self.text:
                    raise ValueError("a formatted conversation ends inside a turn")
                return (self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid)

        def emit():
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(keys, key_type), *map(pa.array, columns)], names=names)

        current, key_type = None, None
        for batch in batches:
            key_type = batch.schema.field(conv).type
            columns = (batch.column(k).to_pylist() for k in (conv, "part", "segment", "loss", "valid"))
            for c, part, segment, loss, valid in zip(*columns):
                if now is None or c != current:
                    if now is not None:
                        keys.append(current)
                        rows.append(now.row())
                    current, now = c, Reading()
                now.chars += len(segment)
                now.valid = now.valid and valid
                now.text.append(segment)
                if loss:
                    now.masked.append(segment)
                if part == "end":
                    now.close_turn()
            if rows:
                yield emit()
                keys, rows = [], []
        if now is not None:
            keys.append(current)
            rows.append(now.row())
            yield emit()

    return ordered.mapInArrow(run, schema)
