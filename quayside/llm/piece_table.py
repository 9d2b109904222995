"""Fill-in-middle transformation with piece tables.

A document is never rewritten while it is worked on. It is a list of descriptors ``(buffer, start,
length)`` over two buffers that do not change: its text and the sentinels. A cut splits one
descriptor in two, an arrangement is a permutation of descriptors with sentinels between them, and
the inverse permutation brings the text back. Hashes stream over the descriptors, so neither the
arranged nor the restored text has to be put together for them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
#: Hundredths of the documents that are arranged, and of these the ones whose suffix comes first.
ARRANGED, SUFFIX_FIRST = 100, 50
SEED = 7
#: The order in which a form puts prefix (0), middle (1) and suffix (2).
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
TEXT_BUFFER, SENTINEL_BUFFER = 0, 1


class Piece(NamedTuple):
    """``length`` bytes of a buffer from ``start`` on."""

    buffer: int
    start: int
    length: int


#: The sentinel of each part.
MARKS = tuple(Piece(SENTINEL_BUFFER, SENTINELS.index(mark), len(mark)) for mark in (PREFIX, MIDDLE, SUFFIX))


def cut(pieces: Sequence[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The pieces before and after a byte of what they spell; the piece across it is split."""
    before: list[Piece] = []
    for place, piece in enumerate(pieces):
        if at < piece.length:
            head = [piece._replace(length=at)] if at else []
            tail = piece._replace(start=piece.start + at, length=piece.length - at)
            return before + head, [tail, *pieces[place + 1 :]]
        at -= piece.length
        before.append(piece)
    return before, []


def arranged(parts: Sequence[Sequence[Piece]], order: Sequence[int]) -> list[Piece]:
    """The parts in the given order, each after its sentinel."""
    return [piece for part in order for piece in (MARKS[part], *parts[part])]


def restored(output: bytes, order: Sequence[int]) -> list[Piece]:
    """Pieces over an arranged output that spell the text it was made of.

    The parts lie between the sentinels, which come in the order of the form and nowhere else.
    """
    ends = [output.index(SENTINELS[MARKS[part].start : MARKS[part].start + MARKS[part].length]) for part in order]
    starts = [end + MARKS[part].length for end, part in zip(ends, order, strict=True)]
    found = [Piece(TEXT_BUFFER, s, e - s) for s, e in zip(starts, [*ends[1:], len(output)], strict=True)]
    back = np.argsort(order)
    return [found[place] for place in back]


def spelled(text: bytes, pieces: Iterable[Piece]) -> Iterable[memoryview]:
    """The bytes of each piece, without a copy."""
    buffers = memoryview(text), memoryview(SENTINELS)
    return (buffers[buffer][start : start + length] for buffer, start, length in pieces)


def digest(text: bytes, pieces: Iterable[Piece]) -> str:
    """SHA-256 of what the pieces spell, fed piece by piece."""
    total = hashlib.sha256()
    for held in spelled(text, pieces):
        total.update(held)
    return total.hexdigest()


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends, its line break included; what follows the last break is a line too."""
    ends = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 10) + 1
    return ends if not text or text.endswith(b"\n") else np.append(ends, len(text))


def code_points(text: bytes) -> int:
    """Characters of UTF-8 bytes: all bytes but those that go on with one."""
    held = np.frombuffer(text, dtype=np.uint8)
    return int(np.count_nonzero((held & 0xC0) != 0x80))


class Cut(NamedTuple):
    """A document as pieces, with its lines, form and the characters of prefix and middle (none if plain)."""

    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    pieces: list[Piece]


def cut_document(text: bytes, draws: Sequence[int], share: int = ARRANGED, suffix_first: int = SUFFIX_FIRST) -> Cut:
    """Cut a text after two drawn lines and arrange its parts.

    Empty texts, texts that hold a sentinel, and those that the third draw leaves out stay plain.
    """
    ends, whole = line_ends(text), [Piece(TEXT_BUFFER, 0, len(text))] if text else []
    n = len(ends)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or draws[2] % 100 >= share:
        return Cut(n, "plain", None, None, whole)
    first, second = (int(ends[at - 1]) if at else 0 for at in sorted(draw % (n + 1) for draw in draws[:2]))
    rest, suffix = cut(whole, second)
    prefix, middle = cut(rest, first)
    form = "spm" if draws[3] % 100 < suffix_first else "psm"
    pieces = arranged((prefix, middle, suffix), ORDERS[form])
    return Cut(n, form, code_points(text[:first]), code_points(text[first:second]), pieces)


def restored_digest(output: bytes, form: str) -> str:
    """SHA-256 of the text that an output of this form was made of."""
    pieces = restored(output, ORDERS[form]) if form in ORDERS else [Piece(TEXT_BUFFER, 0, len(output))]
    return digest(output, pieces)


PIECE = T.StructType([T.StructField(name, T.LongType(), False) for name in Piece._fields])
CUT = T.StructType(
    [
        T.StructField("n", T.LongType(), False),
        T.StructField("form", T.StringType(), False),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("pieces", T.ArrayType(PIECE, False), False),
    ]
)
_PIECES = pa.list_(pa.struct([pa.field(name, pa.int64(), False) for name in Piece._fields]))


def draws(identity: Column, seed: int = SEED) -> Column:
    """Four numbers of 32 bits that depend on the id and the seed only; a null id counts as ``null``."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("null"))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digits, 1 + 8 * at, 8), 16, 10).cast("long") for at in range(4)])


def _texts(column: pa.Array) -> list[bytes]:
    return [text or b"" for text in column.to_pylist()]


def _cutter(share: int, suffix_first: int):
    def cut_all(texts: pa.Array, drawn: pa.Array) -> pa.Array:
        found = [
            cut_document(text, row, share, suffix_first) for text, row in zip(_texts(texts), drawn.to_pylist(), strict=True)
        ]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), _PIECES]
        columns = list(zip(*found, strict=True)) if found else [[]] * len(kinds)
        columns[-1] = [[piece._asdict() for piece in pieces] for pieces in columns[-1]]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=CUT.names)

    return F.arrow_udf(cut_all, CUT)


def _pieces(column: pa.Array) -> list[list[Piece]]:
    return [[Piece(**piece) for piece in pieces] for pieces in column.to_pylist()]


def _rendered(texts: pa.Array, pieces: pa.Array) -> pa.Array:
    return pa.array(
        [b"".join(spelled(text, row)) for text, row in zip(_texts(texts), _pieces(pieces), strict=True)], pa.binary()
    )


def _digested(texts: pa.Array, pieces: pa.Array) -> pa.Array:
    return pa.array([digest(text, row) for text, row in zip(_texts(texts), _pieces(pieces), strict=True)], pa.string())


def _restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    found = zip(_texts(outputs), forms.to_pylist(), strict=True)
    return pa.array([b"".join(spelled(o, restored(o, ORDERS[f]))) if f in ORDERS else o for o, f in found], pa.binary())


def _restored_digests(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    return pa.array([restored_digest(o, f) for o, f in zip(_texts(outputs), forms.to_pylist(), strict=True)], pa.string())


def cut_column(text: Column, identity: Column, share: int = ARRANGED, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> Column:
    """A struct of ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``pieces`` of a text."""
    return _cutter(share, suffix_first)(text.cast("binary"), draws(identity, seed))


def output_of(text: Column, pieces: Column) -> Column:
    """What the pieces spell, as text."""
    return F.arrow_udf(_rendered, T.BinaryType())(text.cast("binary"), pieces).cast("string")


def text_of(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of."""
    return F.arrow_udf(_restored, T.BinaryType())(output.cast("binary"), form).cast("string")


def filled_in(docs: DataFrame, share: int = ARRANGED, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """``docs`` with ``text`` arranged for filling in the middle; all other columns stay.

    Null and empty texts come out empty, texts that hold a sentinel come out as they are. Rows that
    repeat are arranged alike, as the draws depend on the id alone; documents without an id share
    their draws. Nothing is moved: the arrangement is a projection.
    """
    text = F.col("text")
    return docs.withColumn("text", output_of(text, cut_column(text, F.col("doc_id"), share, suffix_first, seed)["pieces"]))


def report(docs: DataFrame) -> DataFrame:
    """Per document its lines, form, the characters of prefix and middle, and the digests of output and restored text.

    An empty table has no rows; see ``filled_in`` for nulls, empty texts and rows that repeat.
    """
    made = docs.select(
        F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    ).withColumn("cut", cut_column(F.col("text"), F.col("doc_id")))
    cut_ = F.col("cut")
    output = F.arrow_udf(_rendered, T.BinaryType())(F.col("text"), cut_["pieces"])
    return made.select(
        "doc_id",
        cut_["n"].alias("n"),
        cut_["form"].alias("form"),
        cut_["prefix_chars"].alias("prefix_chars"),
        cut_["middle_chars"].alias("middle_chars"),
        F.arrow_udf(_digested, T.StringType())(F.col("text"), cut_["pieces"]).alias("output_sha256"),
        F.arrow_udf(_restored_digests, T.StringType())(output, cut_["form"]).alias("restored_sha256"),
    )
