"""Bounded-space online packing of token sequences.

One pass per partition: every document's ids, then one end-of-text id, are cut
into full windows plus a rest.  The rest goes to the open window in which it
leaves the least room (best fit).  When it fits none, the fullest window is
emitted; if that window has room for ``min_cut`` ids or more, the rest's head
fills it first.  A fixed number of windows is open at a time, so memory does
not depend on the input.  What is open at a partition's end is a leftover.

Leftovers are merged by the same rule in rounds: groups of ``fan_in``
partitions, then groups of groups, until one is left.  A merge task reads at
most ``fan_in * open_windows`` windows, whatever the input's size.  The very
last open windows are poured together, so few stay part empty.

The different units of some MB of texts are encoded once.  Those that are one
piece of the pre-split go to the file's model many at a time.

Every id lies in exactly one piece.  Pieces carry their ids.  ``sequence_id``
is made of round, partition and a counter; it's unique and, for the same file
splits, the same when a task is repeated.  A null text counts as empty (its
piece holds the end-of-text id only); repeated ``doc_id`` values are packed
row by row; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import codecs
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendstar.llm.common import read_table, stored
from lendstar.llm.units import UnitMemo, release_memory, trim_memory, unit_array

VOCABULARY = "byte_bpe_50k.json"
EOS_ID = 1
WINDOW = 2048
OPEN_WINDOWS = 32
MIN_CUT = 64
FAN_IN = 32
MEMO_UNITS = 400_000  # of each of two generations: up to 170 MB a worker

PIECE = ("doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary, "
         "sequence_id long, offset long")
_PART = PIECE + ", leftover boolean, part int"
_BATCH_BYTES = 8 << 20
_TEXT_BYTES = 16 << 20  # of texts encoded at once
_TEXTS_AT_ONCE = 256
_WORDS_AT_ONCE = 256


# Byte-level models write a byte as itself where it prints, else as the next
# character from U+0100 on.
_PRINTS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTS)}
_CHARS = "".join(chr(_BYTE_CHARS.get(b, b)) for b in range(256))
_APART = b"\xff"  # never in UTF-8
_PROBE = [" the", " Gr\u00f6\u00dfe", " \u043c\u0438\u0440", " xyzzyqq", " \u4e2d\u6587", "the", " 2024", "7", ",", " ...", "&&&"]
# One piece of the pre-split, so the merges alone; not of its contractions.
_ONE_PIECE = r"^ ?(\p{L}+|\p{N}+|[!-/:-@\[-`{-~]+)$"


class _Words:
    """Ids of units that are one piece of the pre-split, many in one call of the
    file's model: they stand apart by a byte of no merge."""

    def __init__(self, tok: Tokenizer, whole):
        self.model, self.apart = tok.model, tok.token_to_id(_CHARS[0xFF])
        # Else the model isn't byte level, or its merges depend on more than the piece.
        self.usable = (self.apart is not None and sum(_CHARS[0xFF] in t for t in tok.get_vocab()) == 1
                       and not self.model.ignore_merges and self.model.dropout is None
                       and self(pa.array(_PROBE, pa.large_string())).to_pylist() == [whole(s) for s in _PROBE])

    def __call__(self, words: pa.Array) -> pa.Array:
        found = [np.empty(0, "<u4")]
        for lo in range(0, len(words), _WORDS_AT_ONCE):
            raw = _APART.join(words.slice(lo, _WORDS_AT_ONCE).cast(pa.large_binary()).to_numpy(zero_copy_only=False))
            ids = [t.id for t in self.model.tokenize(codecs.charmap_decode(raw, "strict", _CHARS)[0])]
            found.append(np.array([*ids, self.apart], "<u4"))
        flat = np.concatenate(found)
        ends = np.flatnonzero(flat == self.apart)
        return _binary(flat[flat != self.apart], ends - np.arange(len(ends)))


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Bytes of ids; each value's end in ids."""
    offsets = 4 * np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


@lru_cache(maxsize=2)
def _memo(path: str, units: int) -> UnitMemo:
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True  # units have none of their strings, see ``_Encoder``
    return UnitMemo(lambda s: tok.encode(s, add_special_tokens=False).ids, max_units=units)


class _Encoder:
    """Ids as of the tokenizer as loaded: the strings of the file's added tokens
    are tokens of their own, and what's between them is encoded on its own."""

    def __init__(self, path: str, units: int = MEMO_UNITS):
        self.memo, self.tok = _memo(path, units), Tokenizer.from_file(path)
        self.words = _Words(self.tok, self.memo.encode)
        added = self.tok.get_added_tokens_decoder()
        plain = {t.content: i for i, t in added.items() if not (t.lstrip or t.rstrip or t.single_word or t.normalized)}
        self.ids = {c: struct.pack("<I", i) for c, i in plain.items()}
        longest = sorted(plain, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if plain else None
        # Tokens that take white space or word edges into account: the library's whole work.
        self.odd = [t.content for t in added.values() if t.content not in plain]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(c in text for c in self.odd):
            ids = self.tok.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if self.cut is None or not any(c in text for c in self.ids):
            return self.memo.encode(text)
        return b"".join(self.ids.get(part) or self.memo.encode(part) for part in self.cut.split(text))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` of every text; different units of some MB of texts are encoded once."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _TEXT_BYTES, "right")))
            part = pc.fill_null(texts.slice(lo, hi - lo).cast(pa.large_string()), "")
            own = np.zeros(len(part), bool)  # texts with added tokens: each on its own
            for c in [*self.ids, *self.odd]:
                own |= pc.match_substring(part, c).to_numpy(zero_copy_only=False)
            for i, ids in enumerate(self._by_units(pc.if_else(pa.array(own), "", part))):
                yield self.encode(part[i].as_py()) if own[i] else ids
            lo = hi

    def _by_units(self, texts: pa.Array) -> Iterator[bytes]:
        units, first = unit_array(texts)
        coded = units.dictionary_encode()
        one = pc.match_substring_regex(coded.dictionary, _ONE_PIECE)
        if not self.words.usable:
            one = pc.and_(one, False)
        rest = [self.memo.encode(u) for u in coded.dictionary.filter(pc.invert(one)).to_pylist()]
        ids = pa.concat_arrays([self.words(coded.dictionary.filter(one)), pa.array(rest, pa.large_binary())])
        one = one.to_numpy(zero_copy_only=False)
        at = np.where(one, np.cumsum(one) - 1, len(ids) - len(rest) + np.cumsum(~one) - 1)  # in ids
        at = at[coded.indices.to_numpy()]
        for lo in range(0, len(texts), _TEXTS_AT_ONCE):  # ids may be larger than the texts
            part = first[lo:lo + _TEXTS_AT_ONCE + 1]
            taken = ids.take(pa.array(at[part[0]:part[-1]]))
            _, offsets, data = taken.buffers()
            ends = np.frombuffer(offsets, np.int64)[part - part[0]].tolist() if len(taken) else [0] * len(part)
            data = memoryview(data or b"")
            for a, b in zip(ends, ends[1:]):
                yield bytes(data[a:b])


@lru_cache(maxsize=2)
def _encoder(path: str, units: int) -> _Encoder:
    return _Encoder(path, units)


class OpenWindows:
    """At most ``count`` open windows; a window is its pieces and its length.

    A piece is (doc_id, start, ids, doc_tokens); ids are 4 bytes each.
    """

    def __init__(self, window: int, count: int, min_cut: int):
        self.window, self.count, self.min_cut = window, count, min_cut
        self.open: list[tuple[int, list]] = []

    def best(self, n: int) -> int:
        """Index of the fullest window with room for ``n``, or -1."""
        at, most = -1, -1
        for i, (used, _) in enumerate(self.open):
            if most < used <= self.window - n:
                at, most = i, used
        return at

    def put(self, pieces: list, n: int) -> Iterator[list]:
        """Place ``n`` ids; yields the windows that are closed meanwhile."""
        while n:
            at = self.best(n)
            if at >= 0:
                used, have = self.open[at]
                have.extend(pieces)
                if used + n == self.window:
                    self.open.pop(at)
                    yield have
                else:
                    self.open[at] = (used + n, have)
                return
            if len(self.open) < self.count:
                self.open.append((n, list(pieces)))
                return
            fullest = max(range(len(self.open)), key=lambda i: self.open[i][0])
            used, have = self.open.pop(fullest)
            room = self.window - used
            if room >= self.min_cut:
                head, pieces = _cut(pieces, room)
                have.extend(head)
                n -= room
            yield have

    def pour(self) -> None:
        """Fill the fullest windows from the emptiest ones (the very last windows)."""
        self.open.sort(key=lambda w: -w[0])
        i = 0
        while i < len(self.open) - 1:
            (used, have), (n, source) = self.open[i], self.open[-1]
            room = min(self.window - used, n)
            if room >= min(self.min_cut, n):
                head, source = _cut(source, room)
                self.open[i] = (used + room, have + head)
                self.open[-1] = (n - room, source)
                if n == room:
                    self.open.pop()
                    continue
            i += 1

    def rest(self) -> list[list]:
        out, self.open = [w for _, w in self.open], []
        return out


def _cut(pieces: list, n: int) -> tuple[list, list]:
    """The first ``n`` ids of ``pieces``, and what follows."""
    head, k = [], 0
    for k, (doc, start, ids, total) in enumerate(pieces):
        have = len(ids) // 4
        if have > n:
            if n:
                head.append((doc, start, ids[:4 * n], total))
            return head, [(doc, start + n, ids[4 * n:], total), *pieces[k + 1:]]
        head.append(pieces[k])
        n -= have
    return head, []


class _Out:
    """Collects rows of pieces and turns them into Arrow batches."""

    def __init__(self, part: int, base: int):
        self.part, self.next, self.rows, self.bytes = part, base, [], 0

    def add(self, window: list, leftover: bool) -> None:
        at = 0
        for doc, start, ids, total in window:
            n = len(ids) // 4
            self.rows.append((doc, start, n, total, zlib.crc32(ids), ids, self.next, at, leftover, self.part))
            self.bytes += len(ids) + 80
            at += n
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows))
        kinds = [pa.int64()] * 5 + [pa.binary()] + [pa.int64()] * 2 + [pa.bool_(), pa.int32()]
        names = [f.split()[0] for f in _PART.split(", ")]
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def _first_pass(path: str, window: int, count: int, min_cut: int, eos: int, units: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        part = TaskContext.get().partitionId()
        encoder, end = _encoder(path, units), eos.to_bytes(4, "little")
        open_, out = OpenWindows(window, count, min_cut), _Out(part, part << 32)
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), encoder.encode_all(b.column(1))):
                ids += end
                total = len(ids) // 4
                full = total - total % window
                for s in range(0, full, window):
                    out.add([(doc, s, ids[4 * s:4 * (s + window)], total)], False)
                if total > full:
                    for w in open_.put([(doc, full, ids[4 * full:], total)], total - full):
                        out.add(w, False)
                if out.bytes >= _BATCH_BYTES:
                    yield out.batch()
        for w in open_.rest():
            out.add(w, True)
        if out.rows:
            yield out.batch()

    return run


def _merge_pass(window: int, count: int, min_cut: int, rnd: int, last: bool):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        release_memory()  # the words of the first pass
        group = key[0].as_py()
        open_, out = OpenWindows(window, count, min_cut), _Out(group, (rnd << 56) | (group << 32))
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        windows: dict[int, list] = {}
        for r in table.select(["sequence_id", "doc_id", "start", "ids", "doc_tokens"]).to_pylist():
            windows.setdefault(r["sequence_id"], []).append((r["doc_id"], r["start"], r["ids"], r["doc_tokens"]))
        sized = [(sum(len(p[2]) for p in w) // 4, w) for w in windows.values()]
        for n, w in sorted(sized, key=lambda x: -x[0]):  # a bounded group: largest first
            for done in open_.put(w, n):
                out.add(done, False)
        if last:
            open_.pour()
        for w in open_.rest():
            out.add(w, not last)
        return pa.Table.from_batches([out.batch()])

    return run


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
         eos_id: int = EOS_ID, window: int = WINDOW, open_windows: int = OPEN_WINDOWS,
         min_cut: int = MIN_CUT, fan_in: int = FAN_IN, memo_units: int = MEMO_UNITS) -> DataFrame:
    """Pieces of packed sequences: ``PIECE`` columns, ids as little-endian
    unsigned 32-bit bytes, ``offset`` gapless from 0 within a sequence.  Units that aren't
    one piece of the pre-split are kept in a memo of ``memo_units``: a smaller one takes
    less memory of the workers and more time; results are the same."""
    path = tokenizer_path or public_tokenizers.path(VOCABULARY)
    src = df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    names = [f.split()[0] for f in PIECE.split(", ")]
    first = stored(src.mapInArrow(_first_pass(path, window, open_windows, min_cut, eos_id, memo_units), _PART), "pack")
    done = first.filter(~F.col("leftover")).select(*names)
    left = first.filter("leftover")
    # One aggregate row to the driver: how many partitions have leftovers.
    groups = (left.agg(F.max("part").alias("m")).first()["m"] or 0) + 1
    rnd = 1
    while True:
        groups = -(-groups // fan_in)
        last = groups == 1
        keyed = left.withColumn("group", F.floor(F.col("part") / fan_in).cast("int"))
        merged = keyed.groupBy("group").applyInArrow(
            _merge_pass(window, open_windows, min_cut, rnd, last), _PART)
        if last:
            return done.unionByName(merged.select(*names))
        merged = stored(merged, "pack-merge")
        done = done.unionByName(merged.filter(~F.col("leftover")).select(*names))
        left, rnd = merged.filter("leftover"), rnd + 1


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of ``documents`` packed into sequences of at most 2048 tokens."""
    pieces = pack(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
