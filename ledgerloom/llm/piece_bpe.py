"""SentencePiece encoding and decoding through a table of each prefix's last token.

In byte-pair encoding by merge priority, every prefix of a text has one encoding, and two
neighbours in an encoding are always a compatible pair: merged on their own, their joined
text falls into just these two. So the last token of each prefix is the one token, among
those that end there, that is compatible with the last token of the prefix before it. An
automaton over the vocabulary names the tokens that end at a place, a small table remembers
which pairs are compatible, and the ids follow from walking the last tokens backwards. The
work grows with the length of the text and not with the number of merges.

No token spans the place before a blank that follows another character, a character that is
no token itself, or two characters that stand side by side in no piece. So a text falls into
units that are encoded alone: blanks and the letters after them, or signs. Short units come
again and again; their ids are kept, in a bounded number.
"""

from __future__ import annotations

import itertools
import re
import struct
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

# Fixed values of the model format: kinds of pieces, the byte-pair model, the blank's sign,
# what an unknown piece looks like in text, and the sign for bytes that are no character.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BYTE_PAIR_MODEL = 2
BLANK = "▁"
UNKNOWN_TEXT = " ⁇ "
NO_CHARACTER = "�"

# Bounds of what one task keeps: units of up to KEPT_LENGTH characters (in two halves), and
# pairs.
KEPT_UNITS = 400_000
KEPT_LENGTH = 48
KEPT_PAIRS = 250_000
# Rows that are worked on at a time, so that an Arrow batch isn't held several times over.
SOME_ROWS = 512


# ---- the model file -------------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


@dataclass(frozen=True)
class PieceModel:
    """Pieces by id with priority and kind, and whether a blank goes before a text."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    blank_first: bool = True

    @classmethod
    def load(cls, path: str) -> PieceModel:
        """Read a model file. What the method doesn't cover is refused: other models than
        byte pairs with byte fallback, normalised text, own symbols, unused pieces."""
        pieces, scores, kinds = [], [], []
        trainer: dict[int, int | bytes] = {}
        normaliser: dict[int, int | bytes] = {}
        with open(path, "rb") as file:
            for number, value in _fields(file.read()):
                if number == 1:
                    piece = dict(_fields(value))
                    pieces.append(piece[1].decode())
                    scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                    kinds.append(piece.get(3, NORMAL))
                elif number == 2:
                    trainer = dict(_fields(value))
                elif number == 3:
                    normaliser = dict(_fields(value))
        wanted = {
            "byte pairs": trainer.get(3, 1) == BYTE_PAIR_MODEL,
            "byte fallback": kinds.count(BYTE) == 256,
            "kinds of pieces": set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE},
            "text as it is": not normaliser.get(2) and not normaliser.get(4, 1) and normaliser.get(5, 1) == 1,
            "blanks before words": not trainer.get(24, 0),
            "sign of the unknown": trainer.get(44, UNKNOWN_TEXT.encode()) == UNKNOWN_TEXT.encode(),
        }
        if not all(wanted.values()):
            raise ValueError(f"{path}: not covered: {[k for k, v in wanted.items() if not v]}")
        return cls(tuple(pieces), tuple(scores), tuple(kinds), normaliser.get(3, 1) == 1)


# ---- text to ids ----------------------------------------------------------------------


class Encoder:
    """Ids of texts, as the model's merges give them."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.pieces = model.pieces
        self.ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == NORMAL}
        self.rank = {p: model.scores[i] for p, i in self.ids.items()}
        self.bytes_ = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == BYTE}
        self.ends = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.ends.add_word(piece, (len(piece), i))
        self.ends.make_automaton()
        self.units = re.compile(self._unit_pattern(), re.DOTALL).findall
        self.lengths = [len(p) for p in self.pieces]
        # What is known of the tokens after each one; -1 is the start of a unit.
        self.pairs: defaultdict[int, dict[int, bool]] = defaultdict(dict)
        self.pairs_kept = 0
        self.kept = _Kept(self.unit_ids)

    def _unit_pattern(self) -> str:
        """Units as a pattern: blanks with a run of characters that pieces join to each other,
        or with a single other one; blanks alone; one unknown character."""
        group = {p: p for p in self.ids if len(p) == 1 and p != BLANK}

        def root(c: str) -> str:
            while group[c] != c:
                group[c] = group[group[c]]
                c = group[c]
            return c

        joined = set()
        for piece in self.ids:
            text = piece.lstrip(BLANK)
            if BLANK in text:
                return "(?s:.+)"  # pieces go on over blanks: a text is one unit
            for a, b in zip(text, text[1:]):
                if a in group and b in group:
                    joined.add(a)
                    group[root(a)] = root(b)
        runs: dict[str, list[str]] = {}
        for c in group:
            runs.setdefault(root(c), []).append(re.escape(c))
        several = [f"[{''.join(x)}]+" for r, x in runs.items() if len(x) > 1 or r in joined]
        single = "".join(x[0] for r, x in runs.items() if len(x) == 1 and r not in joined)
        word = "|".join([*sorted(several, key=len, reverse=True), *([f"[{single}]"] if single else [])])
        return f"{BLANK}*(?:{word})|{BLANK}+|." if word else f"{BLANK}+|."

    def merged(self, text: str) -> list[str]:
        """The plain definition, for short texts: the best pair is merged, leftmost first,
        until no pair makes a piece."""
        parts = list(text)
        while True:
            joined = [self.rank.get(a + b) for a, b in zip(parts, parts[1:])]
            best = max((r for r in joined if r is not None), default=None)
            if best is None:
                return parts
            at = joined.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two may be neighbours, worked out and remembered."""
        pair = [self.pieces[i] for i in (left, right) if i >= 0]
        if self.pairs_kept >= KEPT_PAIRS:
            self.pairs.clear()
            self.pairs_kept = 0
        self.pairs_kept += 1
        fits = self.pairs[left][right] = self.merged("".join(pair)) == pair
        return fits

    def unit_ids(self, unit: str) -> bytes:
        """Ids of one unit, from its table of last tokens."""
        size = len(unit)
        if size == 1 and unit not in self.ids:
            return array("i", [self.bytes_[b] for b in unit.encode()]).tobytes()
        # Of the prefix that ends at each character: its last token, and what may follow that.
        # The place before the first character is the one at the end of the lists.
        last, after = [-1] * (size + 1), [None] * (size + 1)
        pairs = self.pairs
        after[-1] = pairs[-1]
        for end, (length, i) in self.ends.iter(unit):
            if after[end] is None and (known := after[end - length]) is not None:
                fits = known.get(i)
                if fits is None:
                    fits = self.compatible(last[end - length], i)
                if fits:
                    last[end], after[end] = i, pairs[i]
        ids, at = [], size - 1
        while at >= 0:
            i = last[at]
            if i < 0:
                raise ValueError(f"no last token at {at} of {unit[:80]!r}")
            ids.append(i)
            at -= self.lengths[i]
        ids.reverse()
        return array("i", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text, 32 bits each."""
        if not text:
            return b""
        text = text.replace(" ", BLANK)
        return b"".join(map(self.kept.__getitem__, self.units(BLANK + text if self.model.blank_first else text)))


class _Kept(dict):
    """Values made from their keys and kept. When half of the room is used up, what was asked
    for since the last time stays and the rest goes."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= KEPT_LENGTH:
            if len(self) >= KEPT_UNITS // 2:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found


# ---- ids to text ----------------------------------------------------------------------


class Decoder:
    """Texts of ids: blanks' signs become blanks, the first one goes, bytes become characters."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.size = len(model.pieces)
        self.is_byte = [k == BYTE for k in model.kinds]
        self.silent = {i for i, k in enumerate(model.kinds) if k == CONTROL}
        self.parts = [self._part(p, k) for p, k in zip(model.pieces, model.kinds, strict=True)]

    @staticmethod
    def _part(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return (UNKNOWN_TEXT if kind == UNKNOWN else piece.replace(BLANK, " ")).encode()

    def decode(self, ids: list[int]) -> str:
        """The text of some ids. An id that the model doesn't have raises."""
        if ids and not 0 <= min(ids) <= max(ids) < self.size:
            raise ValueError("ids outside the vocabulary")
        data = b"".join(map(self.parts.__getitem__, ids))
        try:
            if self.silent.isdisjoint(ids):
                text = data.decode()
            else:
                text = self._by_runs(ids)
        except UnicodeDecodeError:
            text = self._by_runs(ids)
        if self.model.blank_first and text[:1] == " ":
            first = next(i for i in ids if i not in self.silent)
            # The sign of the unknown piece keeps its blank, and so does a blank made of bytes.
            if self.model.kinds[first] == NORMAL:
                text = text[1:]
        return text

    def _by_runs(self, ids: list[int]) -> str:
        """Bytes next to each other become characters; any other piece ends their run."""
        out = []
        for bytes_, run in itertools.groupby(ids, key=self.is_byte.__getitem__):
            data = b"".join(map(self.parts.__getitem__, run))
            out.append(_characters(data) if bytes_ else data.decode())
        return "".join(out)


def _characters(data: bytes) -> str:
    """UTF-8 to text, each byte that belongs to no character as a sign of its own."""
    out, at = [], 0
    while at < len(data):
        # A character has four bytes at most: only a window is looked at.
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            size = 1
            out.append(NO_CHARACTER)
        at += size
    return "".join(out)


# ---- operators ------------------------------------------------------------------------


def encode_documents(docs: DataFrame, model_path: str, text_column: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with ``out``, the ids of each whole text; a null or empty text has none.

    No begin or end ids, no sampling. Rows are independent of each other: there is no
    shuffle, and repeated rows, null ids and an empty table need no care. Other columns come
    through; a column already called ``out`` is replaced. The model is read once, on the
    driver; a vocabulary is all that tasks are sent.
    """
    model = PieceModel.load(model_path)
    schema = StructType([f for f in docs.schema.fields if f.name != out]).add(out, ArrayType(IntegerType(), False))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in _some_rows(batches):
            found = [encoder.encode(text or "") for text in batch.column(text_column).to_pylist()]
            yield _with(batch, out, _lists(found))

    return docs.mapInArrow(encode, schema)


def _some_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SOME_ROWS):
            yield batch.slice(at, SOME_ROWS)


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int64) // 4
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    """The batch with a column at its end, in place of one of that name."""
    kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != name]
    return pa.RecordBatch.from_arrays([*(c for _, c in kept), column], names=[*(n for n, _ in kept), name])


def decode_documents(docs: DataFrame, model_path: str, ids_column: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``, the text of each row's ids; null for null, empty for none.

    Ids may be any of the model, in any order: control pieces are silent, the unknown piece
    has a sign, bytes that make no character become U+FFFD one by one. A null among the ids,
    or an id that the model doesn't have, stops the job. A column called ``out`` is replaced.
    """
    model = PieceModel.load(model_path)
    schema = StructType([f for f in docs.schema.fields if f.name != out]).add(out, StringType())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in _some_rows(batches):
            lists = (x.values.to_numpy().tolist() if x.is_valid else None for x in batch.column(ids_column))
            texts = [None if ids is None else decoder.decode(ids) for ids in lists]
            yield _with(batch, out, pa.array(texts, type=pa.string()))

    return docs.mapInArrow(decode, schema)
