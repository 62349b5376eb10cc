"""Chat formatting at the level of tokens, with a loss mask, and its way back.

A conversation is laid out as ``<turn>role<says>text</turn>`` for each turn. The three control
strings are reserved ids after the vocabulary's own; role and text are encoded separately, as
plain text, and the reserved ids spliced in between, so no text can produce one. In case tokens
are turned into text and back by others, control strings inside contents are escaped as well: a
backslash is put behind each backslash and behind the ``<`` of a control string, and taken out
when read (a backslash stands for the character after it). Loss is on the texts of chosen roles:
+1 where such a text begins, -1 behind its end, and the prefix sum is the mask.

Rows are encoded where they are read; then conversations are brought together by their id, in
order of turn, and pass through a task as a stream: at no time is a whole conversation held. The
output is a table of pieces of bounded size (conv_id, piece, ids, mask), and reading it back is a
stream too, with running digests.

Defined cases: a null text or role is empty; rows without conv_id are one conversation with a
null id; a null turn comes first; rows with equal turns come in order of role, then of a hash of
the text, and repeated rows are turns of their own; an empty table writes nothing and gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import common as C
from gridlake.llm.vocabulary import ByteLevel, pieces_of

#: A public vocabulary: where the box keeps it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
TURN, SAYS, END = "<turn>", "<says>", "</turn>"
#: Roles whose texts are trained on.
LOSS_ROLES = ("assistant",)
#: Tokens of a piece of the output.
PIECE = 1 << 16
ESCAPED = re.compile(r"\\|<(?=turn>|says>|/turn>)")
UNESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return UNESCAPED.sub(r"\1", text)


class Template:
    """Vocabulary, reserved ids behind it, and the bytes of every id."""

    def __init__(self, path: str = VOCABULARY):
        self.model = ByteLevel(path)
        first = len(self.model.spell)
        self.turn, self.says, self.end = first, first + 1, first + 2
        self.spell = [*self.model.spell, TURN.encode(), SAYS.encode(), END.encode()]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of the escaped texts; a long text is cut where no token goes across."""
        parts = [pieces_of(escape(t)) for t in texts]
        ids = iter(self.model.encode(list(chain.from_iterable(parts))))
        return [list(chain.from_iterable(next(ids) for _ in p)) for p in parts]


def assemble(template: Template, roles: list[list[int]], texts: list[list[int]], loss: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Turns' segments -> ids with the reserved ones spliced in, and the mask."""
    sizes = np.array([[1, len(r), 1, len(t), 1] for r, t in zip(roles, texts)], np.int64)
    stops = np.cumsum(sizes.ravel()).reshape(sizes.shape)
    ids = np.empty(int(stops[-1, -1]), np.int32)
    ids[stops[:, 0] - 1], ids[stops[:, 2] - 1], ids[stops[:, 4] - 1] = template.turn, template.says, template.end
    step = np.zeros(len(ids) + 1, np.int32)
    on = np.array(loss, bool)
    np.add.at(step, stops[on, 2], 1)  # the text begins
    np.add.at(step, stops[on, 3], -1)  # and has ended
    for k in range(len(roles)):
        ids[stops[k, 0] : stops[k, 1]] = roles[k]
        ids[stops[k, 2] : stops[k, 3]] = texts[k]
    return ids, np.cumsum(step[:-1]).astype(bool)


def _encode(vocabulary: str):
    """conv_id, turn, role, text -> conv_id, turn, role, tie (hash of the text) and the ids of role and text."""

    def run(batches):
        template = Template(vocabulary)
        for batch in batches:
            roles, texts = ([x or "" for x in batch.column(c).to_pylist()] for c in ("role", "text"))
            ties = [hashlib.sha256(t.encode()).digest()[:16] for t in texts]
            ids = [pa.array([np.array(x, np.int32) for x in template.encode(t)], pa.list_(pa.int32())) for t in (roles, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(roles), pa.array(ties, pa.binary()), *ids],
                names=["conv_id", "turn", "role", "tie", "role_ids", "ids"],
            )

    return run


def _runs(batches, key: str = "conv_id"):
    """(value, rows of one batch) for every run of equal keys; runs go on from batch to batch."""
    for batch in batches:
        keys, start = batch.column(key).to_pylist(), 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                yield keys[start], batch.slice(start, i - start)
                start = i


def _lay_out(vocabulary: str, loss_roles: tuple, size: int, id_type: pa.DataType):
    """Encoded turns in order -> pieces of the formatted conversations."""

    def pieces(key, number, ids, mask):
        return pa.RecordBatch.from_arrays(
            [pa.array([key], id_type), pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int32())), pa.array([mask], pa.list_(pa.bool_()))],
            names=["conv_id", "piece", "ids", "mask"],
        )

    def run(batches):
        template = Template(vocabulary)
        now, number, ids, mask = object(), 0, np.zeros(0, np.int32), np.zeros(0, bool)
        for key, rows in _runs(batches):
            if key != now:
                if len(ids):
                    yield pieces(now, number, ids, mask)
                now, number, ids, mask = key, 0, ids[:0], mask[:0]
            roles = rows.column("role").to_pylist()
            segments = [[x.values.to_numpy() for x in rows.column(c)] for c in ("role_ids", "ids")]
            more = assemble(template, *segments, [r in loss_roles for r in roles])
            ids, mask = np.concatenate([ids, more[0]]), np.concatenate([mask, more[1]])
            while len(ids) >= size:
                yield pieces(now, number, ids[:size], mask[:size])
                number, ids, mask = number + 1, ids[size:], mask[size:]
        if len(ids):
            yield pieces(now, number, ids, mask)

    return run


def _in_order(rows: DataFrame, parts: int, *order: str) -> DataFrame:
    """Conversations whole and in order inside partitions."""
    return rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", *order)


def write(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    loss_roles: tuple = LOSS_ROLES,
    piece: int = PIECE,
    folder: str | None = None,
) -> DataFrame:
    """Format all conversations; the written table: conv_id, piece, ids, mask."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = conversations.sparkSession
    C.bounded_batches(spark)
    rows = conversations.select(*[F.col(c).alias(n) for c, n in ((conv_id, "conv_id"), (turn, "turn"), (role, "role"), (text, "text"))])
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    id_kind = kinds["conv_id"].simpleString()
    schema = f"conv_id {id_kind}, turn {kinds['turn'].simpleString()}, role string, tie binary, role_ids array<int>, ids array<int>"
    encoded = rows.mapInArrow(_encode(vocabulary), schema)
    ordered = _in_order(encoded, _parts(spark), "turn", "role", "tie")
    laid = ordered.mapInArrow(
        _lay_out(vocabulary, tuple(loss_roles), piece, to_arrow_type(kinds["conv_id"])), f"conv_id {id_kind}, piece long, ids array<int>, mask array<boolean>"
    )
    path = folder or C.scratch_path(spark, "chat")
    laid.write.parquet(path)
    return spark.read.schema(laid.schema).parquet(path)


def _parts(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class _Reader:
    """A formatted conversation, read piece by piece."""

    def __init__(self, template: Template):
        self.template = template
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.raw, self.masked, self.part = [], [], None  # of the segment that is open

    def feed(self, ids: np.ndarray, mask: np.ndarray) -> None:
        t, start = self.template, 0
        for stop in [*np.flatnonzero(ids >= t.turn).tolist(), len(ids)]:
            spelt = t.spell
            self.raw.append(b"".join(spelt[i] for i in ids[start:stop].tolist()))
            held = mask[start:stop]
            self.masked.append(self.raw[-1] if held.all() else b"".join(spelt[i] for i in ids[start:stop][held].tolist()))
            if stop < len(ids):
                self.close(int(ids[stop]))
            start = stop + 1

    def close(self, reserved: int) -> None:
        t = self.template
        segment, masked = b"".join(self.raw).decode(), b"".join(self.masked).decode()
        self.raw, self.masked = [], []
        self.chars += len(segment) + len(t.spell[reserved])
        if reserved == t.turn:
            self.turns += 1
        else:
            self.all.update((unescape(segment) + "\n").encode())
        if masked:
            shown = unescape(masked)
            self.loss.update(shown.encode())
            self.loss_chars += len(shown)

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


READ = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(vocabulary: str, id_type: pa.DataType):
    def shown(keys, readers):
        columns = list(zip(*(r.row() for r in readers)))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = [c.split()[0] for c in READ.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(keys, id_type), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["conv_id", *names])

    def run(batches):
        template, keys, readers = Template(vocabulary), [], []
        for key, rows in _runs(batches):
            if not readers or key != keys[-1]:
                if len(readers) >= 1000:
                    yield shown(keys, readers)
                    keys, readers = [], []
                keys.append(key), readers.append(_Reader(template))
            for ids, mask in zip(rows.column("ids"), rows.column("mask")):
                readers[-1].feed(ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False))
        if readers:
            yield shown(keys, readers)

    return run


def read(pieces: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Read formatted conversations back, one row each: conv_id, n_turns, turns_sha256 (of role,
    line break, text, line break of each turn), loss_chars and loss_sha256 (of the texts under
    the mask, one behind the other) and formatted_chars, all but the last with escapes undone."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = pieces.sparkSession
    kind = pieces.schema["conv_id"].dataType
    ordered = _in_order(pieces.select("conv_id", "piece", "ids", "mask"), _parts(spark), "piece")
    return ordered.mapInArrow(_read(vocabulary, to_arrow_type(kind)), f"conv_id {kind.simpleString()}, {READ}")


def _turns(vocabulary: str, id_type: pa.DataType):
    """Pieces in order -> conv_id, turn (counted from 0), role, text."""

    def run(batches):
        template = Template(vocabulary)
        now, number, open_raw, role = object(), -1, [], ""
        for key, rows in _runs(batches):
            if key != now:
                now, number, open_raw = key, -1, []
            out = []
            for piece in rows.column("ids"):
                ids, start = piece.values.to_numpy(), 0
                for stop in [*np.flatnonzero(ids >= template.turn).tolist(), len(ids)]:
                    open_raw.append(b"".join(template.spell[i] for i in ids[start:stop].tolist()))
                    start = stop + 1
                    if stop == len(ids):
                        break
                    segment, open_raw = unescape(b"".join(open_raw).decode()), []
                    if ids[stop] == template.turn:
                        number += 1
                    elif ids[stop] == template.says:
                        role = segment
                    else:
                        out.append((number, role, segment))
            turns, roles, texts = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array([now] * len(out), id_type), pa.array(turns, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())],
                names=["conv_id", "turn", "role", "text"],
            )

    return run


def turns(pieces: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The turns of formatted conversations as they were: conv_id, turn (0, 1, …), role, text."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = pieces.schema["conv_id"].dataType
    ordered = _in_order(pieces.select("conv_id", "piece", "ids"), _parts(pieces.sparkSession), "piece")
    return ordered.mapInArrow(_turns(vocabulary, to_arrow_type(kind)), f"conv_id {kind.simpleString()}, turn long, role string, text string")


C.ship(__name__)
