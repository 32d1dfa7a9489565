"""Packing token sequences by Karmarkar-Karp multiway differencing.

Every document becomes its token ids plus an end id and is cut into pieces: whole windows as long as they last, and
the rest in pieces of at most `piece` tokens. Whole windows stand alone. The rests of a block of documents are dealt to
k windows by differencing: each partial partition is a vector of window sums, the two with the widest spread are merged
largest sum against smallest, until one is left. k starts at the least count that can hold the tokens and rises while
a window exceeds the capacity. Blocks come from hashes of doc_id and the piece, and the row count, so the result does not
depend on how Spark partitions the input; the rows of an id that more than a thousand rows have (or of null) are dealt by
their place in the input besides, so that no block grows with them. Token ids never cross a shuffle, only piece rows do.

Defined cases: null text counts as empty; an empty text is the end id alone; repeated rows are packed once each;
null doc_id is a document like others; ties in length are ordered by id, place and checksum; a text of any length is
encoded whole by one task, and cut; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import Remembered, hash_bucket, lean, let_go, materialize, per_process, small_batches, table, told_apart

CAPACITY = 1024
PIECE = 256
DOCS_PER_BLOCK = 256
END_ID = 0
#: Words and units whose ids a worker remembers.
CACHED_WORDS = 400_000
#: Texts that go to a Python worker at once.
TEXTS_AT_ONCE = 1000
#: Characters of text that are encoded at once; a longer text is alone.
ENCODED_AT_ONCE = 4_000_000
#: Words whose ids are written out at once: a few such arrays of ids and places are held besides the words.
WRITTEN_AT_ONCE = 65_536

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PACKED = _PIECES + ", sequence_id long, offset long"
#: A word as the fast path knows it: no white space but one blank before it.
_WORD = re.compile(r" ?\S+")
#: The units of a word without apostrophes (which begin units of their own) whose digits and marks are ASCII.
_UNITS = re.compile(r" ?(?:[^\W\d_]+|[0-9]+|[!-&(-/:-@\[-`{-~]+)")


def _byte_letters() -> dict[int, str]:
    """The characters that byte-level vocabularies write for bytes: printable Latin-1 as it is, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Token ids of texts as little-endian uint32 bytes, by `tokenizers`, with the ids of words remembered.

    The vocabulary's pre-tokenizer starts a new unit at each single blank and newline, so ids of words joined are the
    ids of the text; texts with other white space take the whole-text path. A word of letters is one unit and goes to
    the merges at once.
    """

    def __init__(self, path: str, remembered: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))).search if added else lambda text: None
        self.merges, self.letters = self.tokenizer.model, _byte_letters()
        self.words = Remembered(self._word, remembered)

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _unit(self, unit: str) -> bytes:
        mapped = unit.encode("utf-8").decode("latin-1").translate(self.letters)
        return struct.pack(f"<{len(found)}I", *[t.id for t in found]) if (found := self.merges.tokenize(mapped)) else b""

    def _word(self, word: str) -> bytes | None:
        """None: the word stands in unusual white space, and its text must be encoded whole."""
        if word == "\n":
            return self._unit(word)
        if not _WORD.fullmatch(word):
            return None
        letters = word[1:] if word[0] == " " else word
        if letters.isalpha():
            return self._unit(word)
        units = _UNITS.findall(word)
        if sum(map(len, units)) < len(word) or any(not (u.isascii() or u.lstrip(" ").isalpha()) for u in units):
            return self._plain(word)
        if len(units) == 1:
            return self._unit(word)
        return b"".join(map(self.words.__getitem__, units))

    def encode(self, text: str) -> bytes:
        self.words.trim()
        if "\0" in text or self.added(text):  # the mark between words below; tokens that are no words
            return self._plain(text)
        try:
            return b"".join(map(self.words.__getitem__, text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")))
        except TypeError:  # an unusual word among them
            return self._plain(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """`encode` of each text; a word that the texts repeat is looked up once."""
        self.words.trim()
        out: list[bytes | None] = [self._plain(t) if "\0" in t or self.added(t) else None for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        if not rest:
            return out
        split = pc.split_pattern(pa.array([texts[i].replace("\n", "\0\n\0").replace(" ", "\0 ") for i in rest], pa.large_string()), "\0")
        marks, words = split.offsets.to_numpy(), split.values.dictionary_encode()  # no text is without a word, if an empty one
        del split
        found = list(map(self.words.__getitem__, words.dictionary.to_numpy(zero_copy_only=False)))  # much sooner listed than by to_pylist
        at, ids = words.indices.to_numpy(), np.frombuffer(b"".join(f or b"" for f in found), "<u4")
        lengths = np.array([len(f or b"") // 4 for f in found], dtype=np.int64)
        begins = np.cumsum(lengths) - lengths
        unusual = np.logical_or.reduceat(np.array([f is None for f in found])[at], marks[:-1])
        for a, b in _slices(np.diff(marks).tolist(), WRITTEN_AT_ONCE, int):
            run = at[marks[a] : marks[b]]
            n = lengths[run]
            ends = np.cumsum(n)
            written = ids[np.arange(ends[-1]) + np.repeat(begins[run] - ends + n, n)]
            stops = ends[marks[a + 1 : b + 1] - marks[a] - 1]
            for i, c, d, whole in zip(rest[a:b], np.append(0, stops[:-1]), stops, unusual[a:b], strict=True):
                out[i] = self._plain(texts[i]) if whole else written[c:d].tobytes()
        return out


def _slices(items: list, most: int, size: Callable = len) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of items whose sizes (of texts: characters) make at most so much, or with one item."""
    begin = total = 0
    for i, n in enumerate(map(size, items)):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if items:
        yield begin, len(items)


def cuts(n: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole windows, then the rest in near-equal pieces."""
    whole = n // capacity * capacity
    out = [(s, capacity) for s in range(0, whole, capacity)]
    if rest := n - whole:
        k = -(-rest // piece)
        marks = [whole + rest * i // k for i in range(k + 1)]
        out += [(a, b - a) for a, b in zip(marks, marks[1:])]
    return out


def difference(lengths: list[int], k: int) -> list[list[int]]:
    """k windows of item numbers with near-equal sums, by multiway differencing; empty windows stay in the list."""
    if not lengths:
        return [[] for _ in range(k)]
    # a partial partition: its window sums in descending order (zeros left out) with nested pairs of items
    heap = [(-x, i, [(x, i)]) for i, x in enumerate(lengths)]
    heapq.heapify(heap)
    serial = len(lengths)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        lone = k - len(b)  # so many of a's largest windows meet none of b's
        merged = a[:lone]
        if len(a) > lone:
            merged += [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[lone:], reversed(b))]
            merged += b[: len(b) - (len(a) - lone)]
        else:
            merged += b
        merged.sort(key=lambda w: -w[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        heapq.heappush(heap, (-spread, serial, merged))
        serial += 1
    windows = []
    for _, nest in heap[0][2]:
        flat, stack = [], [nest]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            else:
                flat.append(x)
        windows.append(flat)
    return windows + [[] for _ in range(k - len(windows))]


def windows_for(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        windows = difference(lengths, k)
        if all(sum(lengths[i] for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        k += 1


def _pieces(path: str, capacity: int, piece: int, remembered: int = CACHED_WORDS):
    name = f"encoder {path} {remembered}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(name, lambda: Encoder(path, remembered))
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for a, b in _slices(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist(), ENCODED_AT_ONCE, int):
                ids_of, texts, copies = (c.to_pylist() for c in batch.slice(a, b - a).columns)
                rows = []
                for doc_id, ids, copy in zip(ids_of, encoder.encode_all([t or "" for t in texts]), copies, strict=True):
                    ids += end
                    n = len(ids) // 4
                    rows += [(doc_id, s, m, zlib.crc32(ids[4 * s : 4 * (s + m)]), n, copy) for s, m in cuts(n, capacity, piece)]
                pa.default_memory_pool().release_unused()  # else a worker keeps what the words of the largest run took
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "copy"])

    return lean(run, keeps=name)


def _pack(capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        let_go()  # all texts are encoded by now
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        lengths = rows["length"].tolist()
        whole = sum(x == capacity for x in lengths)
        sequence, offset = np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64)
        for k, window in enumerate(windows_for(lengths[whole:], capacity)):
            at = 0
            for i in sorted(window):
                sequence[whole + i], offset[whole + i] = whole + k, at
                at += lengths[whole + i]
        rows["sequence_id"], rows["offset"] = (int(key[0]) << 32) + sequence, offset
        return rows.drop(columns="_block")

    return run


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, piece: int = PIECE, docs_per_block: int = DOCS_PER_BLOCK, texts_at_once: int = TEXTS_AT_ONCE, remembered: int = CACHED_WORDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    texts_at_once, remembered: texts of a batch and words that a Python worker holds; fewer take less memory and more time,
    and change no row."""
    rows = told_apart(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "doc_id", "copy")
    # a batch of texts stands in the executor and in its Python worker at once
    with small_batches(docs.sparkSession, texts_at_once):
        pieces = materialize(rows.select("doc_id", "text", "copy").mapInArrow(_pieces(tokenizer_path, capacity, piece, remembered), _PIECES + ", copy long"), "pieces")
    blocks = max(1, -(-docs.count() // docs_per_block))
    block = hash_bucket(blocks, "doc_id", "copy", "start", "ids_crc32").alias("_block")
    return pieces.select(*[x.split()[0] for x in _PIECES.split(", ")], block).groupBy("_block").applyInPandas(_pack(capacity), _PACKED)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
