"""Packing documents into sequences of a fixed number of tokens by the sum-of-squares rule.

Method: a piece goes to the open bin, or a new one, for which the sum over residual gaps of the squared number of open
bins with that gap becomes smallest. Pieces are dealt by hash to groups of about GROUP pieces, each packed by one task;
bins still open at a group's end are emptied and their pieces placed again, largest first into the tightest gap, which
leaves a group a few unfilled bins at most. Only (id, piece, start, length, checksum) rows move, never text.

Defined results: null and empty texts are the closing token alone; null ids stay null; rows that repeat an id are
packed each; other columns are not carried.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import id_and_text, original_id, stored

LENGTH, CLOSING = 4096, 1
GROUP = 50_000
#: Bytes of each of the two generations of a worker's memory of words, and what an entry takes beside its bytes.
MEMORY, ENTRY = 60_000_000, 160

_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: printable bytes are themselves, others follow from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table = {b: chr(b) for b in own}
    return table | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in table)}


class Recent:
    """A dictionary of bounded size in two generations: when the younger is full the older goes, and what is asked for
    moves to the younger. Frequent entries are never lost."""

    def __init__(self, limit: int = MEMORY):
        self.limit, self.size, self.young, self.old = limit, 0, {}, {}

    def find(self, key) -> bytes | None:
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value: bytes) -> None:
        if len(key) > 64:
            return
        if self.size >= self.limit:
            self.size, self.young, self.old = 0, {}, self.young
        self.young[key] = value
        self.size += ENTRY + len(key) + len(value)


class WordIds:
    """Token ids of white-space separated chunks, remembered. The tokenizer splits at white space before all else, so
    a text's ids are those of its chunks in a row; a chunk of Latin letters and closing marks is a word and its marks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.chunks, self.parts = Recent(), Recent()

    def _part(self, part: str, letters: bool) -> bytes:
        ids = self.parts.find(part)
        if ids is None:
            if letters:
                shown = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
                found = [t.id for t in self.model.tokenize(shown)]
            else:
                found = self.whole.encode(part, add_special_tokens=False).ids
            ids = struct.pack(f"<{len(found)}I", *found)
            self.parts.keep(part, ids)
        return ids

    def _chunk(self, chunk: bytes) -> bytes:
        ids = self.chunks.find(chunk)
        if ids is not None:
            return ids
        text = chunk.decode("utf-8", "replace")
        word = _WORD.fullmatch(text)
        if word:
            letters, marks = word.groups()
            ids = self._part(letters.lower(), True)
            if marks:
                ids += self._part(marks, False)
        else:
            ids = self._part(text, False)
        self.chunks.keep(chunk, ids)
        return ids

    def __call__(self, body: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids. Bytes split at ASCII white space, which the tokenizer drops."""
        get, chunk = self.chunks.young.get, self._chunk
        return b"".join([get(w) or chunk(w) for w in body.split()])


_OPEN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _OPEN:
        _OPEN[path] = WordIds(path)
    return _OPEN[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenized_pieces(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                     length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document's pieces of at most ``length`` tokens."""
    path = tokenizer or default_tokenizer()
    kinds = [("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(kinds + [("ids", pa.list_(pa.int32()))] * with_ids)
    closing = np.array([CLOSING], "<u4").tobytes()

    def over(batches):
        encode = word_ids(path)
        for batch in batches:
            rows, held = [], 0
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(body) + closing
                for n, at in enumerate(range(0, len(ids), 4 * length)):
                    own = ids[at : at + 4 * length]
                    rows.append((i, n, at // 4, len(own) // 4, zlib.crc32(own)) + (np.frombuffer(own, "<i4"),) * with_ids)
                    held += len(own) * with_ids
                if held > 1 << 25:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return id_and_text(df, key, text).mapInArrow(over, "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


class Bins:
    """Open bins by gap. ``pieces`` has each bin's pieces."""

    def __init__(self, size: int):
        self.size, self.count = size, np.zeros(size + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.pieces: list[list[int]] = []

    def put(self, piece: int, length: int, gap: int) -> None:
        if gap == self.size:
            self.pieces.append([])
            own = len(self.pieces) - 1
        else:
            own = self.open[gap].pop()
            self.count[gap] -= 1
        self.pieces[own].append(piece)
        if gap > length:
            self.open[gap - length].append(own)
            self.count[gap - length] += 1

    def smallest_squares(self, length: int) -> int:
        """The gap to use. Moving a bin from gap g to h changes the sum by 2 (n_h - n_g) + 2, filling one by
        1 - 2 n_g, opening one by 2 n_h + 1; of equal changes the tightest gap is taken."""
        if length == self.size:
            return self.size
        n, gaps = self.count, np.flatnonzero(self.count[length:]) + length
        if not len(gaps):
            return self.size
        change = 2 * (n[gaps - length] - n[gaps]) + 2
        if gaps[0] == length:
            change[0] = 1 - 2 * n[length]
        k = int(change.argmin())
        return int(gaps[k]) if change[k] <= 2 * n[self.size - length] + 1 else self.size

    def tightest(self, length: int) -> int:
        gaps = np.flatnonzero(self.count[length:])
        return int(gaps[0]) + length if len(gaps) else self.size


def pack(lengths: np.ndarray, size: int = LENGTH) -> list[list[int]]:
    """The bins, each a list of positions in ``lengths``."""
    bins = Bins(size)
    for piece, length in enumerate(lengths.tolist()):
        bins.put(piece, length, bins.smallest_squares(length))
    left = sorted({b for own in bins.open for b in own})
    again = Bins(size)
    for piece in sorted((p for b in left for p in bins.pieces[b]), key=lambda p: -lengths[p]):
        again.put(piece, int(lengths[piece]), again.tightest(int(lengths[piece])))
    if len(again.pieces) > len(left):
        return bins.pieces
    gone = set(left)
    return [p for b, p in enumerate(bins.pieces) if b not in gone] + again.pieces


def _pack_group(size: int):
    def run(key, group):
        order = group.sort_by([("mix", "ascending"), ("id", "ascending"), ("piece", "ascending")]).drop_columns(["mix"])
        lengths = order.column("length").to_numpy()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for n, own in enumerate(pack(lengths, size)):
            sequence[own] = (key[0].as_py() << 32) + n
            offset[own] = np.cumsum(lengths[own]) - lengths[own]
        return order.drop_columns(["group"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
    return run


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, length: int = LENGTH,
                   group: int = GROUP, with_ids: bool = False) -> DataFrame:
    """Per piece: the id, piece, start, length, ids_crc32[, ids], and its place: sequence_id and offset."""
    pieces = stored(tokenized_pieces(df, key, text, tokenizer, length, with_ids), "pieces")
    groups = max(1, round(pieces.count() / group))
    mix = F.xxhash64("id", "piece", "ids_crc32")
    dealt = pieces.withColumn("mix", mix).withColumn("group", F.pmod(F.col("mix"), F.lit(groups)))
    kinds = ", ".join(f"{n} {t}" for n, t in pieces.dtypes)
    packed = dealt.groupBy("group").applyInArrow(_pack_group(length), f"{kinds}, sequence_id long, offset long")
    return packed.withColumn("id", original_id()).withColumnRenamed("id", key)
