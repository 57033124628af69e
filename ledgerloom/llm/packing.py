"""Token sequences of one length, packed by minimum bin slack.

A document's token ids are cut into pieces of the window length and a rest. A full piece is a
sequence of its own. The rests are packed: for one window at a time, subset-sum dynamic
programming over bitsets tells which sums the remaining lengths can make with the longest of
them in place, and the sum closest to the capacity wins. Walking back through the bitsets
gives how many pieces of each length fill it. The same filling is used again as long as the
remaining counts allow.

Tokens never move between machines: ids stay in the task that made them, unless asked for,
and only pieces (a few numbers each) are grouped. A group has a bounded number of documents,
so every packing is a task of bounded size, and at most its last sequence is far from full.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.llm.common import free_names, stored, text_of, worker_tool

GROUP_PIECES = 8192
KEPT_WORDS = 600_000


class Kept(dict):
    """Values made from their keys and kept. When half of the room is used up, what was asked
    for since the last time stays, the rest goes."""

    def __init__(self, make, room: int) -> None:
        self.make, self.room, self.older = make, room, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.room // 2:
            self.older = dict(self)
            self.clear()
        if len(key) <= 32:
            self[key] = found
        return found


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write a byte as a letter: visible ones as themselves, the others,
    in their order, as the letters from 256 on."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: chr(256 + n) for n, b in enumerate(hidden)}


def text_encoder(path: str, end_id: int):
    """A function from a text to its ids and the end's, as little-endian bytes.

    Blanks and line feeds end a token, so that a text can be done word by word. In a text of
    Latin letters (composed, with one lower-case form whatever is around them), signs and
    digits, words are divided as the tokenizer divides them and go to its model; words of
    other texts go through the whole tokenizer. Both kinds are kept.
    """
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model, letters = tokenizer.model, _byte_letters()
    # Fixed value: how this tokenizer divides a text.
    divide = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
    odd = regex.compile("[^\n\x20-\x7e\u00a1-\u0129\u0131-\u024f]|<\\|").search

    def part(text: str) -> bytes:
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(letters)
        return _packed([t.id for t in model.tokenize(text)])

    def word(text: str) -> bytes:
        if text.isalpha():
            return part(text)
        if text[:-1].isalpha() and text[-1] in ".,":
            return plain[text[:-1]] + plain[text[-1]]
        pieces = divide(text)
        return b"".join(map(plain.__getitem__, pieces)) if len(pieces) > 1 else b"".join(map(part, pieces))

    plain = Kept(word, KEPT_WORDS)
    other = Kept(lambda text: _packed(tokenizer.encode(text, add_special_tokens=False).ids), KEPT_WORDS)
    end = _packed([end_id])

    def ids(text: str) -> bytes:
        words, by = (other, text) if odd(text) else (plain, text.lower())
        return b"".join(map(words.__getitem__, by.replace("\n", " ").split(" "))) + end

    return ids


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 4096,
    end_id: int = 2,
    keep_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every document cut into pieces of ``window`` tokens and a rest.

    Columns: ``doc_id``, ``start``, ``length``, ``ids_crc32`` (of the ids as little-endian
    unsigned 32-bit numbers), ``doc_tokens`` and, with ``keep_ids``, ``ids``.
    """
    schema = "doc_id {}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint".format(
        docs.schema[id_column].dataType.simpleString()
    ) + (", ids array<int>" if keep_ids else "")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = ("encoder", tokenizer_path, end_id)
        ids_of = worker_tool(key, lambda: text_encoder(tokenizer_path, end_id))
        for batch in batches:
            rows = []
            for at, text in enumerate(batch["text"]):
                ids = ids_of(text)
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    row = (at, start, len(piece) // 4, zlib.crc32(piece), total)
                    rows.append((*row, np.frombuffer(piece, dtype="<u4").astype(np.int32)) if keep_ids else row)
            names = ["at", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * keep_ids]
            out = pd.DataFrame(rows, columns=names)
            # The id by position: a null stays a null.
            out.insert(0, "doc_id", batch["doc_id"].astype(object).take(out["at"].astype(int)).array)
            yield out.drop(columns="at")

    plain = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    return plain.mapInPandas(cut, schema)


def best_filling(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """The (length, count) pairs that hold the longest length and fill most of ``capacity``.

    Bit s of a bitset says that the lengths so far can make the sum s. A length that may be
    used c times takes steps of 1, 2, 4, ... and the remainder, a bitset for each.
    """
    longest = max(counts)
    mask = (1 << (capacity + 1)) - 1
    sums, steps = 1 << longest, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), (capacity - longest) // length)
        take = 1
        while left > 0:
            take = min(take, left)
            steps.append((length, take, sums))
            sums |= (sums << (length * take)) & mask
            left, take = left - take, take * 2
        if sums >> capacity & 1:
            break
    total = sums.bit_length() - 1
    used = {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return sorted(used.items(), reverse=True)


def fill_windows(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length. All lengths are 1 to ``capacity``."""
    waiting: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        waiting.setdefault(lengths[i], []).append(i)
    bins, offsets, made = [0] * len(lengths), [0] * len(lengths), 0
    while waiting:
        filling = best_filling({k: len(v) for k, v in waiting.items()}, capacity)
        for _ in range(min(len(waiting[k]) // n for k, n in filling)):
            offset = 0
            for k, n in filling:
                for _ in range(n):
                    i = waiting[k].pop()
                    bins[i], offsets[i] = made, offset
                    offset += k
            made += 1
        waiting = {k: v for k, v in waiting.items() if v}
    return bins, offsets


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 4096,
    end_id: int = 2,
    keep_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """``token_pieces`` with ``sequence_id``, ``offset`` and ``sequence_tokens``.

    Every id of every document lies in one piece, every piece in one sequence of at most
    ``window`` tokens; offsets begin at 0 and leave no gap. A sequence is padded to the window
    unless its ``sequence_tokens`` are a power of two.

    Defined results: a null or empty text is its end id alone; null ids, ties and repeated
    rows are packed like others (each row is a document); an empty table gives an empty table;
    other columns are left out.
    """
    pieces = token_pieces(docs, tokenizer_path, window, end_id, keep_ids, id_column, text_column)
    dealt, near = free_names(pieces, "_group", "_order")
    order = F.xxhash64("doc_id", "start", "ids_crc32", "length")
    pieces = stored(pieces.withColumn(near, order), "pack-pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    pieces = pieces.withColumn(dealt, F.pmod(F.col(near), F.lit(groups)))
    schema = StructType(list(pieces.schema.fields))
    for name in ("sequence_id", "offset", "sequence_tokens"):
        schema = schema.add(name, "long")

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        keys = [near, "start", "ids_crc32", "length"]
        part = part.sort_values(keys, kind="stable", ignore_index=True)
        lengths = part["length"].tolist()
        small = [i for i, n in enumerate(lengths) if n < window]
        bins, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
        got, at = fill_windows([lengths[i] for i in small], window)
        bins[small], offset[small] = got, at
        full = [i for i, n in enumerate(lengths) if n == window]
        bins[full] = np.arange(len(full)) + (max(got) + 1 if got else 0)
        part["sequence_id"] = (int(part[dealt].iloc[0]) << 32) + bins
        part["offset"] = offset
        part["sequence_tokens"] = np.bincount(bins, weights=lengths)[bins].astype(np.int64)
        return part

    packed = pieces.groupBy(dealt).applyInPandas(pack, schema)
    return packed.drop(dealt, near)
