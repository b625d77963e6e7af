"""Chat records of many layouts to canonical turns, and turns to training text.

A record's layout is told by its fingerprint, the hash of its nested field paths.  A registry maps
fingerprints to declarative mappings, which say where the conversation, the order, the roles and
the texts stand; no layout has code of its own.

Template: ``<|im_start|>`` role line end text ``<|im_end|>`` line end, turn after turn.  Inside
roles and texts, ``<`` with any number of backslashes before a ``|`` gets one backslash more, so no
control string can arise and unescaping takes exactly that one away.  In roles, line ends are ``\\n``
and backslashes ``\\\\``, before that.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
#: Characters of formatted text in one output row at most, but for a longer single turn.
CHUNK_CHARS = 1 << 20
_NONE = object()
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps a conversation.

    ``key``: field of the conversation id.  Either ``turns`` names the list whose elements hold
    ``role`` and ``text``, or ``order`` the field of a turn's number in a record that is one turn,
    or ``fixed`` lists (role, fields) pairs: a turn for each, of the fields that are not empty,
    joined by a blank line.
    """

    key: str
    turns: str | None = None
    order: str | None = None
    role: str = "role"
    text: str = "text"
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    rename: dict[str, str] = field(default_factory=dict, hash=False)


def paths(value: object, prefix: str = "") -> set[str]:
    """Nested field paths; list elements share the path ``[]``."""
    if isinstance(value, dict):
        found = set()
        for name, inner in value.items():
            found |= paths(inner, f"{prefix}.{name}" if prefix else name)
        return found
    if isinstance(value, list):
        return set().union({f"{prefix}[]"}, *(paths(inner, f"{prefix}[]") for inner in value))
    return {prefix}


def fingerprint(fields: set[str]) -> str:
    """Hash of field paths, whatever their order."""
    return hashlib.sha256("\n".join(sorted(fields)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def required(mapping: Mapping) -> set[str]:
    """Field paths without which a mapping cannot read a record."""
    if mapping.fixed:
        return {mapping.key, *(name for _, names in mapping.fixed for name in names)}
    if mapping.turns:
        inner = f"{mapping.turns}[]"
        return {mapping.key, inner, f"{inner}.{mapping.role}", f"{inner}.{mapping.text}"}
    return {mapping.key, mapping.order, mapping.role, mapping.text}


def chosen(fields: frozenset[str], layouts: dict[str, Mapping]) -> tuple[str, Mapping | None]:
    """A record's fingerprint and mapping: the one registered for just these paths, or else the one that requires the most of them.

    Of several that require as many the one with the smallest fingerprint is taken; none that has all it requires: None.
    """
    mark = fingerprint(set(fields))
    if mark in layouts:
        return mark, layouts[mark]
    fitting = [(-len(needs), key) for key, mapping in layouts.items() if (needs := required(mapping)) <= fields]
    return mark, layouts[min(fitting)[1]] if fitting else None


def conversation_id(value: object) -> int | None:
    """Whole numbers that fit a long, and texts of one, are themselves; null stays null.

    Every other id becomes a number below -2^62 by its hash, the same for the same id everywhere.
    """
    number = whole(value)
    if value is None or number is not None:
        return number
    digest = hashlib.sha256(json.dumps(value, sort_keys=True).encode()).digest()
    return -(1 << 62) - (int.from_bytes(digest[:8], "big") >> 2) - 1


def whole(value: object) -> int | None:
    """A whole number that fits a long, also as a text; else None."""
    if isinstance(value, str) and re.fullmatch(r"-?[0-9]{1,19}", value):
        value = int(value)
    fits = isinstance(value, int) and not isinstance(value, bool) and -(1 << 63) <= value < 1 << 63
    return value if fits else None


def layout(fields: list[str], mapping: Mapping) -> dict[str, Mapping]:
    return {fingerprint(set(fields)): mapping}


_SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant"}
#: Known layouts; callers add their own by ``| layout([...], Mapping(...))``.
LAYOUTS: dict[str, Mapping] = (
    layout(["conv_id", "turn", "role", "text"], Mapping("conv_id", order="turn"))
    | layout(["id", "messages[]", "messages[].role", "messages[].content"], Mapping("id", turns="messages", text="content"))
    | layout(["id", "messages[]"], Mapping("id", turns="messages", text="content"))
    | layout(
        ["id", "conversations[]", "conversations[].from", "conversations[].value"],
        Mapping("id", turns="conversations", role="from", text="value", rename=_SPEAKERS),
    )
    | layout(["id", "prompt", "response"], Mapping("id", fixed=(("user", ("prompt",)), ("assistant", ("response",)))))
    | layout(["id", "prompt", "completion"], Mapping("id", fixed=(("user", ("prompt",)), ("assistant", ("completion",)))))
    | layout(
        ["id", "instruction", "input", "output"],
        Mapping("id", fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    )
    | layout(
        ["id", "system", "instruction", "input", "output"],
        Mapping("id", fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    )
)


def _text(value: object) -> str:
    """A text as it is, null as empty, anything else as JSON; halves of surrogate pairs become U+FFFD."""
    said = "" if value is None else value if isinstance(value, str) else json.dumps(value)
    return said.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def turns_of(record: dict, mapping: Mapping) -> list[tuple[int | None, int | None, str, str]]:
    """(conversation, order, role, text) of each turn of a record.

    A list element that is no object is a turn without a role, whose text it is.  A turn's number that
    is no whole number has no place: it is null and comes first.
    """
    key = conversation_id(record.get(mapping.key))
    if mapping.fixed:
        joined = ((role, "\n\n".join(t for f in fields if (t := _text(record.get(f))))) for role, fields in mapping.fixed)
        found = list(joined)
        return [(key, k, role, said) for k, (role, said) in enumerate(found) if said or role != "system"]
    listed = record.get(mapping.turns) or [] if mapping.turns else [record]
    out = []
    for k, turn in enumerate(listed):
        if not isinstance(turn, dict):
            turn = {mapping.text: turn}
        role = _text(turn.get(mapping.role))
        order = whole(turn.get(mapping.order)) if mapping.order else k
        out.append((key, order, mapping.rename.get(role, role), _text(turn.get(mapping.text))))
    return out


def canonical_turns(records: DataFrame, layouts: dict[str, Mapping] | None = None) -> DataFrame:
    """conv_id, turn, role, text and layout of every turn of the JSON objects in column ``record``.

    Null fields count as fields; null roles and texts are empty.  A layout is known if its fingerprint is
    registered, or if a mapping finds all paths it requires among others.  A record that is null, no JSON
    object or of an unknown layout gives one row with its fingerprint (null if it is no object)
    and null elsewhere, so that nothing is dropped unseen; ``unknown_layouts`` counts them.  For ids and
    turns of other types see ``conversation_id`` and ``turns_of``.  Other columns are not read.
    """
    known = LAYOUTS if layouts is None else layouts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[frozenset, tuple[str, Mapping | None]] = {}
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column("record").to_pylist():
                try:
                    record = json.loads(text) if text is not None else None
                    fields = frozenset(paths(record))
                except (ValueError, RecursionError):
                    record = None
                if not isinstance(record, dict):
                    rows.append((None, None, None, None, None))
                    continue
                if fields not in seen:
                    if len(seen) > 10_000:
                        seen.clear()
                    seen[fields] = chosen(fields, known)
                mark, mapping = seen[fields]
                if mapping is None:
                    rows.append((None, None, None, None, mark))
                else:
                    rows += [(*turn, mark) for turn in turns_of(record, mapping)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TURN_TYPES, strict=True)], _TURN_NAMES)

    return records.select(F.col("record").cast("string").alias("record")).mapInArrow(
        run, "conv_id long, turn long, role string, text string, layout string"
    )


def unknown_layouts(turns: DataFrame) -> DataFrame:
    """layout and records: what ``canonical_turns`` could not read, by fingerprint (null: no JSON object)."""
    return turns.where("role is null").groupBy("layout").agg(F.count("*").alias("records"))


_TURN_NAMES = ["conv_id", "turn", "role", "text", "layout"]
_TURN_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, part, formatted, loss_starts and loss_ends of canonical turns.

    Turns follow by number, then role and text, so that ties and repeated rows have one order.  A
    conversation is one row, or several consecutive parts once it passes CHUNK_CHARS: it is
    streamed from sorted partitions and never held whole, however many turns it has.  The loss
    mask is ranges of code points within the part that hold the texts of TRAINED_ROLE.  Turns with
    a null conv_id are one conversation; rows without a role, which ``canonical_turns`` gives for
    unknown layouts, are no turns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None | object = _NONE
        part, pieces, length, starts, ends = 0, [], 0, [], []

        def close() -> pa.RecordBatch:
            nonlocal part, length
            out = pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), pa.array([part], pa.int32()), pa.array(["".join(pieces)]),
                 pa.array([list(starts)], _RANGES), pa.array([list(ends)], _RANGES)],
                ["conv_id", "part", "formatted", "loss_starts", "loss_ends"],
            )
            part, length = part + 1, 0
            pieces.clear(), starts.clear(), ends.clear()
            return out

        for batch in batches:
            ready = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conv != now:
                    if pieces:
                        ready.append(close())
                    now, part = conv, 0
                head, said = f"{OPEN}{_role_out(role)}\n", escape(text)
                if role == TRAINED_ROLE:
                    starts.append(length + len(head))
                    ends.append(length + len(head) + len(said))
                pieces += [head, said, f"{CLOSE}\n"]
                length += len(head) + len(said) + len(CLOSE) + 1
                if length >= CHUNK_CHARS:
                    ready.append(close())
            if ready:
                yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]
        if pieces:
            yield close()

    ordered = turns.where("role is not null").select("conv_id", "turn", "role", "text")
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, "conv_id long, part int, formatted string, loss_starts array<int>, loss_ends array<int>")


_RANGES = pa.list_(pa.int32())


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of formatted turns."""
    at = 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        stop = formatted.index(CLOSE, line)
        yield _role_in(formatted[at + len(OPEN) : line]), unescape(formatted[line + 1 : stop])
        at = stop + len(CLOSE) + 1


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from formatted parts.

    Takes ``format_turns`` output as it comes: parts of a conversation follow each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None | object = _NONE
        turns, loss, n, trained, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

        def row() -> tuple:
            return now, n, turns.hexdigest(), trained, loss.hexdigest(), chars

        for batch in batches:
            rows = []
            for conv, text, starts, ends in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_starts", "loss_ends")), strict=True
            ):
                if conv != now:
                    if now is not _NONE:
                        rows.append(row())
                    now, turns, loss, n, trained, chars = conv, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for role, said in parse(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for a, b in zip(starts, ends, strict=True):
                    said = unescape(text[a:b])
                    loss.update(said.encode())
                    trained += len(said)
                chars += len(text)
            if rows:
                yield _digest_batch(rows)
        if now is not _NONE:
            yield _digest_batch([row()])

    return formatted.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
