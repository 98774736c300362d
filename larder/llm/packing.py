"""Packing of tokenized documents into windows by Karmarkar-Karp multiway differencing.

1. Texts are tokenized where they lie and an end token is added. Every full window
   of a long document is a sequence by itself; only what is left of a document,
   less than a window, travels on.
2. What is left is dealt at random into groups of about ``group_tokens`` tokens.
   Inside a group, the pieces are partitioned into windows of near-equal sums: each
   piece starts as a partial partition with one window in use; the two partial
   partitions with the greatest difference between their fullest and emptiest
   window are merged, the fullest window of one meeting the emptiest of the other,
   until one is left. Where its fullest window is over capacity, the number of
   windows rises. It begins at the least that the tokens need, so a group wastes
   about one window; if it has risen by more than ``waste``, documents are cut into
   smaller pieces and the count starts again.
3. Sequence ids are the group's number and the window's; they do not depend on
   where a group is packed. A piece's place in its window follows its order in the
   group.

A group holds the tokens of its documents, never those of long documents, and
no window or group crosses tasks; equal documents are dealt apart.

Tokens of words that occur again are looked up instead of computed, and words of
lower-case letters skip the steps that leave them as they are. That needs a byte-level
vocabulary whose tokens never cross white space, that keeps runs of letters whole and
takes runs of punctuation by themselves; for others set ``by_word`` false.

Cases: a null text is empty and holds the end token alone; rows with the same or a
null id are documents of their own; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import text as tx
from larder.llm.columns import text_of
from larder.sources.scratch import materialize


@dataclass(frozen=True)
class Settings:
    vocabulary: str  # path of a tokenizers file, the same on all machines
    capacity: int = 4096
    end: int = 2
    group_tokens: int = 1 << 21
    group_rows: int = 1 << 16
    waste: float = 0.005
    by_word: bool = True
    lower_case: bool = True  # the vocabulary knows lower case only
    kept_words: int = 1_000_000  # words whose tokens a worker remembers


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each piece, by largest differencing of partial partitions into ``windows`` sums."""
    n = len(sizes)
    # a partial partition: sums in falling order and a node per sum; a node is a piece or a union of two nodes
    heap = [(-int(size), k, np.array([size]), np.array([k])) for k, size in enumerate(sizes)]
    heapq.heapify(heap)
    unions: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    nodes, turn = n, n
    while len(heap) > 1:
        _, _, sums, names = heapq.heappop(heap)
        _, _, other, other_names = heapq.heappop(heap)
        both = len(sums) + len(other) - windows
        if both <= 0:
            sums, names = np.concatenate([sums, other]), np.concatenate([names, other_names])
        else:
            # the least full of one meets the fullest of the other; the rest meet empty windows
            meet, rest = len(sums) - both, len(other) - both
            left, right = names[meet:], other_names[rest:][::-1]
            fresh = np.arange(nodes, nodes + both)
            nodes += both
            unions.append((fresh, left, right))
            sums = np.concatenate([sums[:meet], sums[meet:] + other[rest:][::-1], other[:rest]])
            names = np.concatenate([names[:meet], fresh, other_names[:rest]])
        order = np.argsort(-sums, kind="stable")
        sums, names = sums[order], names[order]
        spread = int(sums[0] - (sums[-1] if len(sums) == windows else 0))
        heapq.heappush(heap, (-spread, turn, sums, names))
        turn += 1
    window = np.zeros(nodes, dtype=np.int64)
    if heap:
        window[heap[0][3]] = np.arange(len(heap[0][3]))
    for fresh, left, right in reversed(unions):
        window[left] = window[right] = window[fresh]
    return window[:n]


def cut(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of pieces of at most ``limit`` tokens, equal in length within a document up to one."""
    count = -(-sizes // limit)
    doc = np.repeat(np.arange(len(sizes)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = k * sizes[doc] // count[doc]
    return doc, start, (k + 1) * sizes[doc] // count[doc] - start


def pack(sizes: np.ndarray, capacity: int, waste: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, window) of the pieces of documents of at most ``capacity`` tokens."""
    least = max(1, -(-int(sizes.sum()) // capacity))
    limit = capacity
    while True:
        doc, start, length = cut(sizes, limit)
        for windows in range(least, least + 2 + int(least * waste)):
            window = differencing(length, windows)
            if np.bincount(window, weights=length).max() <= capacity:
                return doc, start, length, window
        limit = max(limit // 2, 1)


class Tokens:
    """Token ids of texts, those of words that occurred before being remembered."""

    def __init__(self, s: Settings):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(s.vocabulary)
        # words of lower-case letters need no normalizing and no splitting
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.s = s
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 and s.end < 1 << 16 else "<u4"
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool, self.filled = np.zeros(1 << 16, np.uint32), 0
        self.start, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        """Put the ids of new words into the pool: first those of letters only, then the others."""
        texts = [word.decode() for word in words]
        # lower case of these letters is one letter each
        plain = [w.isalpha() and max(w) < "\u0250" and "\u0130" not in w for w in texts]
        order = [k for k, easy in enumerate(plain) if easy]
        easy = len(order)
        order += [k for k, easy in enumerate(plain) if not easy]
        counts, ids = [], []
        for first in range(0, len(order), 4096):
            part = [texts[k] for k in order[first : min(first + 4096, easy)]] if first < easy else []
            if part:
                found = self.letters.encode([w.lower() for w in part], is_pretokenized=True, add_special_tokens=False)
                counts.append(np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(part)))
                ids.append(np.array(found.ids, dtype=np.uint32))
            for found in self.tokenizer.encode_batch([texts[k] for k in order[max(first, easy) : first + 4096]], add_special_tokens=False):
                counts.append(np.array([len(found.ids)]))
                ids.append(np.array(found.ids, dtype=np.uint32))
        count, flat = np.concatenate(counts), np.concatenate(ids)
        n, total = len(self.known), self.filled + len(flat)
        if total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(total, np.uint32)])
        if n + len(words) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros(n + len(words), np.int64)])
            self.count = np.concatenate([self.count, np.zeros(n + len(words), np.int64)])
        self.pool[self.filled : total] = flat
        self.start[n : n + len(words)] = self.filled + np.cumsum(count) - count
        self.count[n : n + len(words)] = count
        self.known.update(zip([words[k] for k in order], range(n, n + len(words)), strict=True))
        self.filled = total

    def _spelled(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """(words of all texts, first word of each text)."""
        blank = np.ones(len(data) + 2, dtype=bool)
        blank[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
        begins, stops = ~blank[1:] & blank[:-1], blank[1:] & ~blank[:-1]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[inner] = edge[len(data)] = True
        crossing = inner[~blank[inner] & ~blank[inner + 1]]
        begins[crossing] = stops[crossing] = True
        # punctuation from a letter to white space or to the end of its text is a word by itself
        run = np.zeros(len(data) + 2, dtype=bool)
        run[1:-1] = _PUNCTUATION[data]
        heads = np.flatnonzero(run[1:-1] & ~(run[:-2] & ~edge[:-1]))
        tails = np.flatnonzero(run[1:-1] & ~(run[2:] & ~edge[1:])) + 1
        ends_word = (heads > 0) & ~edge[heads] & (blank[tails + 1] | edge[tails])
        heads = heads[ends_word]
        last, before = data[heads - 1], data[np.maximum(heads - 2, 0)]
        latin = (heads > 1) & (before == 0xC3) & (last != 0x97) & (last != 0xB7)
        split = heads[latin | (((last | 32) >= 97) & ((last | 32) <= 122))]
        begins[split] = stops[split] = True
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
        at = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(ends - starts, out=at[1:])
        letters = data[~blank[1:-1]]
        if self.s.lower_case:
            letters = np.where((letters >= 65) & (letters <= 90), letters + 32, letters).astype(np.uint8)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(letters)])
        return words, np.searchsorted(starts, offsets)

    def _by_word(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words, firsts = self._spelled(data, offsets)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > self.s.kept_words:
            self._forget()
        place = np.array([self.known.get(word, -1) for word in distinct], dtype=np.int64)
        new = np.flatnonzero(place < 0).tolist()
        if new:
            self._learn([distinct[k] for k in new])
            place[new] = [self.known[distinct[k]] for k in new]
        index = place[np.asarray(coded.indices)]
        length = self.count[index]
        ends = np.concatenate([[0], np.cumsum(length)])
        ids = self.pool[np.repeat(self.start[index] - ends[:-1], length) + np.arange(int(ends[-1]))]
        return ids, ends[firsts]

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text); one long text is taken in parts of bounded size."""
        if not self.s.by_word:
            texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            ids = [found.ids for found in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            return np.array([x for found in ids for x in found], np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        if len(offsets) > 2:
            return self._by_word(data, offsets)
        found = []
        while len(data) > tx.CHUNK_BYTES:
            gaps = np.flatnonzero(data[: tx.CHUNK_BYTES] == 32)
            if not len(gaps):
                break
            found.append(self._by_word(data[: gaps[-1]], np.array([0, gaps[-1]]))[0])
            data = data[gaps[-1] :]
        ids = np.concatenate([*found, self._by_word(data, np.array([0, len(data)]))[0]])
        return ids, np.array([0, len(ids)])


PIECES = "n long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
_PIECES = pa.schema([
    ("n", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()),
])
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
_PACKED = pa.schema([(name.split()[0], pa.binary() if name.endswith("binary") else pa.int64()) for name in PACKED.split(", ")])
WINDOW_BITS = 24
# ASCII punctuation but for what the names of special tokens are made of
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[*b"!#$%&()*+,-./:;=?@[]^_`{}~", 34, 39, 92]] = True
CHUNK = 4 << 20
_shared: dict[Settings, Tokens] = {}


def _tokenize(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Full windows of every document, and what is left of it; the number of a piece is unique."""
    if s not in _shared:
        _shared[s] = Tokens(s)  # words stay known to the next task of the same worker
    tokens = _shared[s]
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        ids = batch.column(0)
        for first, last, data, offsets in tx.chunks(batch.column(1), CHUNK):
            columns: list[list] = [[] for _ in _PIECES.names]
            names = ids.slice(first, last - first).to_pylist()
            flat, firsts = tokens.of(data, offsets)
            for k, name in enumerate(names):
                own = np.append(flat[firsts[k] : firsts[k + 1]], np.uint32(s.end)).astype("<u4")
                for start in range(0, len(own), s.capacity):
                    part = own[start : start + s.capacity]
                    row = (number, name, start, len(part), zlib.crc32(part), len(own), part.astype(tokens.width).tobytes())
                    number += 1
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES, strict=True)], schema=_PIECES)


def _group(key: tuple, table: pa.Table, s: Settings, with_ids: bool) -> pa.Table:
    """The pieces of one group with their windows and places, and their ids if asked for."""
    table = table.combine_chunks().sort_by("n")
    length = np.asarray(table["length"])
    full = length == s.capacity
    left = np.flatnonzero(~full)
    doc, start, size, window = np.zeros((4, 0), np.int64)
    if len(left):
        doc, start, size, window = pack(length[left], s.capacity, s.waste)
        doc = left[doc]
    whole = np.flatnonzero(full)
    windows = int(window.max()) + 1 if len(window) else 0
    doc, start = np.concatenate([doc, whole]), np.concatenate([start, np.zeros(len(whole), np.int64)])
    size = np.concatenate([size, length[whole]])
    window = np.concatenate([window, windows + np.arange(len(whole))])
    if windows + len(whole) >> WINDOW_BITS:
        raise ValueError("a group has too many windows")
    order = np.lexsort((np.arange(len(doc)), window))
    doc, start, size, window = doc[order], start[order], size[order], window[order]
    ends = np.cumsum(size)
    head = np.concatenate([[True], window[1:] != window[:-1]])
    offset = ends - size - np.repeat((ends - size)[head], np.diff(np.append(np.flatnonzero(head), len(window))))
    at = pa.array(doc)
    texts, crc = table["ids"].take(at), np.asarray(table["ids_crc32"].take(at)).copy()
    base = np.asarray(table["start"].take(at))
    ids: list[bytes | None] = [None] * len(doc)
    for k in range(len(doc)) if with_ids else np.flatnonzero(size < length[doc]):
        raw = texts[k].as_buffer()
        part = np.frombuffer(raw, f"<u{len(raw) // length[doc[k]]}")[start[k] : start[k] + size[k]].astype("<u4")
        crc[k] = zlib.crc32(part)
        ids[k] = part.tobytes() if with_ids else None
    sequence = (int(key[0].as_py()) << WINDOW_BITS) + window
    return pa.table([
        table["doc_id"].take(at), pa.array(base + start), pa.array(size), pa.array(crc), table["doc_tokens"].take(at),
        pa.array(sequence), pa.array(offset), pa.array(ids, pa.binary()),
    ], schema=_PACKED)


def packed(docs: DataFrame, settings: Settings, with_ids: bool = True) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32 bits) if asked for, window by window: ``sequence_id`` and ``offset``."""
    s = settings
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    pieces = materialize(texts.mapInArrow(lambda batches: _tokenize(batches, s), PIECES), "tokens")
    total = pieces.agg(F.coalesce(F.sum(F.when(F.col("length") < s.capacity, F.col("length"))), F.lit(0)).alias("tokens"), F.count("*").alias("rows")).first()
    groups = max(1, round(total["tokens"] / s.group_tokens), -(-total["rows"] // s.group_rows))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("n"), F.lit(groups)))
    # the columns of the group are those of the pieces and its number
    return dealt.groupBy("_group").applyInArrow(lambda key, table: _group(key, table, s, with_ids), PACKED)


def pack_documents(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""
    return packed(docs, settings, with_ids=False).drop("ids")
