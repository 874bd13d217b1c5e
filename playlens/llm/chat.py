r"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>role\ntext<|im_end|>\n``. A deterministic parser reads the
rendered text back and the turn is compared to the source. Where they differ, because the
content holds marks, its control strings get one more back slash after ``<|`` each
(``<|im_end|>`` becomes ``<|\im_end|>``, and what is there already as ``<|\im_end|>`` becomes
``<|\\im_end|>``), and the turn is rendered and compared again; a turn that would still
differ raises.

The grammar: a conversation is a sequence of turns. A turn is the start mark, a role without
line ends and marks, a line end, content without marks, the end mark and a line end. The
content of an escaped turn is announced by ``\!`` after the role, so other turns stay as
they are.

Rows are sorted by conversation and turn within the partition of the conversation and pass
through as a stream: only one turn is in memory, whatever the length of a conversation.

Defined results: null texts and roles count as empty. Line ends, ``<`` and back slashes in a
role are escaped too. Rows of equal conversation and turn go by role, then text. Rows without a
conversation id form a conversation of their own, and turns without a number come first.
Other columns are ignored.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import functions as F

#: The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"
#: Roles whose texts are under the loss mask.
LEARNED = ("assistant",)

_CONTROL = re.compile(r"<\|(\\*)(?=im_start\|>|im_end\|>)")
_ESCAPED = re.compile(r"<\|\\(\\*)(?=im_start\|>|im_end\|>)")
_HEAD = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\[\\nl])*)(\\!)?\n")
_MARK = re.compile(r"<\|im_(?:start|end)\|>")


def escape(text):
    return _CONTROL.sub(lambda m: "<|\\" + m[1], text)


def unescape(text):
    return _ESCAPED.sub(lambda m: "<|" + m[1], text)


def render(role, text):
    """(rendered turn, start and end of the content in it)."""
    shown = role.replace("\\", "\\\\").replace("\n", "\\n").replace("<", "\\l")
    for mark, content in (("", text), ("\\!", escape(text))):
        head = f"{START}{shown}{mark}\n"
        whole = f"{head}{content}{END}\n"
        try:
            found = [turn[:2] for turn in parse(whole)]
        except ValueError:
            continue
        if found == [(role, text)]:
            return whole, len(head), len(head) + len(content)
    raise ValueError("a turn can't be read back")


def unescape_role(role):
    return re.sub(r"\\([\\nl])", lambda m: {"n": "\n", "l": "<"}.get(m[1], m[1]), role)


def parse(rendered):
    """(role, text, start and end of the content) of each turn; raises where there is none."""
    at = 0
    while at < len(rendered):
        head = _HEAD.match(rendered, at)
        mark = head and _MARK.search(rendered, head.end())
        if not mark or mark[0] != END or not rendered.startswith("\n", mark.end()):
            raise ValueError(f"no turn at {at}")
        content = rendered[head.end():mark.start()]
        yield (unescape_role(head[1]), unescape(content) if head[2] else content,
               head.end(), mark.start())
        at = mark.end() + 1


def ordered(rows):
    """Rows in the order of conversations and turns, nulls as the contract has them."""
    columns = [F.col("conv_id").cast("long"), F.col("turn").cast("long"),
               *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))]
    return rows.select(*columns).repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text")


def format_turns(rows):
    """conv_id, turn, rendered, mask_start, mask_end per turn, sorted within partitions.

    A conversation's formatted text is the ``rendered`` of its turns in order; the mask is the
    content of turns to learn from (characters of ``rendered``), null for other turns."""
    def formatted(batches):
        for batch in batches:
            out = {"rendered": [], "mask_start": [], "mask_end": []}
            for role, text in zip(batch.column("role").to_pylist(),
                                  batch.column("text").to_pylist()):
                whole, start, end = render(role, text)
                learn = role in LEARNED
                out["rendered"].append(whole)
                out["mask_start"].append(start if learn else None)
                out["mask_end"].append(end if learn else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(out["rendered"], pa.string()),
                 pa.array(out["mask_start"], pa.int64()), pa.array(out["mask_end"], pa.int64())],
                names=["conv_id", "turn", *out])
    return ordered(rows).mapInArrow(
        formatted, "conv_id long, turn long, rendered string, mask_start long, mask_end long")


class _Digest:
    """What is read back of one conversation, turn by turn."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered, start, end):
        for role, text, _, _ in parse(rendered):
            self.turns += 1
            self.turns_hash.update(f"{role}\n{text}\n".encode())
        if start is not None:
            masked = rendered[start:end]
            if rendered[:start].endswith("\\!\n"):
                masked = unescape(masked)
            self.loss_chars += len(masked)
            self.loss_hash.update(masked.encode())
        self.chars += len(rendered)

    def row(self):
        return (self.conv_id, self.turns, self.turns_hash.hexdigest(), self.loss_chars,
                self.loss_hash.hexdigest(), self.chars)


def read_back(formatted):
    """Per conversation: its turns and masked texts as parsed from the formatted text.

    ``formatted`` is what ``format_turns`` returns, a conversation's turns in one partition."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def read(batches):
        now = None
        for batch in batches:
            done = []
            for conv_id, rendered, start, end in zip(*(
                    batch.column(c).to_pylist()
                    for c in ("conv_id", "rendered", "mask_start", "mask_end"))):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv_id)
                now.add(rendered, start, end)
            yield _batch(done, names, types)
        if now is not None:
            yield _batch([now.row()], names, types)
    return formatted.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, "
                                      "loss_chars long, loss_sha256 string, formatted_chars long")


def _batch(rows, names, types):
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=names)
