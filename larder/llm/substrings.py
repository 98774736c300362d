"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere.

Every window of LENGTH bytes is assigned to an anchor: the ANCHOR bytes in it
with the smallest hash, leftmost on ties. Equal windows have equal anchors at
equal offsets, so two places need comparing only where anchors are equal, and
consecutive windows with one anchor make one mark. Equal marks that follow each
other in a document are stored as one with the length of their run. Marks go
through three steps:

1. Marks whose anchor occurs once are left out, by a count of anchors that is
   combined before it is shuffled.
2. Marks equal in anchor and in all bytes their windows touch form a class. A
   class of two or more has all its windows repeated, whatever its size; copies
   are never compared in pairs.
3. A class of one is compared with the other classes of its anchor. The texts
   to the right of the anchors are ordered by the suffix array of their task
   (``suffixes``: linear grouping), so that those sharing their first bytes are
   neighbours, and windows that begin the same number of bytes before the
   anchor are equal if they share that range and the bytes to the left. Where an
   anchor has more than HOT classes, its windows are counted one by one by their
   hashes over all tasks instead, so no task holds the group.

The marked windows of a document are merged, and the bytes outside kept.

Marks, anchors, classes and groups are stored as they are made: marks are made
once, and their joins have stored rows on both sides, so that adaptive
execution can split the rows of one frequent anchor or class.

Bytes are those of the UTF-8 text. Windows are equal when 128 bits of hashes
are; contexts are compared by their bytes to the right of an anchor and by a
64-bit hash to its left.

Cases: a null text is empty; texts under LENGTH bytes lose nothing; rows equal
in id and text are copies of each other, and both lose what repeats; matches
never cross documents; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import text as tx
from larder.llm.columns import content_key, same_key, text_of
from larder.llm.suffixes import suffix_array
from larder.sources.scratch import materialize

LENGTH = 400
ANCHOR = 160
HOT = 2048
BATCH = 8192
BLOCK = 120  # bytes of one symbol of the suffix arrays
SPAN = LENGTH - ANCHOR + 1  # anchors in a window


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values, from minima of blocks to either side."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def marks_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, anchor place in the row, nearest and farthest window start before it, anchor hash, context hash, run).

    Equal marks in a row, as a text that repeats itself without a break has
    them, are one; ``run`` is how far the last one's anchor lies behind the first one's.
    """
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < LENGTH:
        return (empty,) * 7
    sums = tx.prefix_sums(tx.BYTE_CODES[data])
    spots = np.arange(n - ANCHOR + 1)
    hashes = tx.span_hashes(sums, spots, spots + ANCHOR)
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | spots.astype(np.uint64)
    lowest = sliding_min(keys, SPAN)
    inside = np.zeros(n + 1, dtype=np.int32)
    long = np.diff(offsets) >= LENGTH
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside)[: n - LENGTH + 1] > 0)
    if not len(starts):
        return (empty,) * 7
    anchors = (lowest[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    new = np.flatnonzero(np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])]))
    head, tail = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    at, row = anchors[new], rows[new]
    context = tx.span_hashes(sums, head, tail + LENGTH)
    context = tx.mix(context + tx.mix(((at - head) * SPAN + (at - tail)).astype(np.uint64)))
    anchor, near, far = hashes[at], at - tail, at - head
    first = np.flatnonzero(
        np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1]) | (row[1:] != row[:-1])])
    )
    run = at[np.append(first[1:], len(at)) - 1] - at[first]
    at = at - offsets[row]
    return row[first], at[first], near[first], far[first], anchor[first].view(np.int64), context[first].view(np.int64), run


def pieces(column: pa.Array, limit: int = tx.CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, row offsets, place in the row) of pieces of bounded size whose windows cover those of all rows."""
    for first, _, data, offsets in tx.chunks(column, limit):
        if len(data) <= 2 * limit:
            yield first, data, offsets, 0
            continue
        for begin in range(0, max(len(data) - LENGTH + 1, 1), limit):
            part = data[begin : begin + limit + LENGTH - 1]
            yield first, part, np.array([0, len(part)]), begin


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, offsets, begin in pieces(batch.column(2)):
            row, at, near, far, anchor, context, run = marks_of(data, offsets)
            if len(row):
                where = pa.array(row + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(where), batch.column(1).take(where), pa.array(at + begin, pa.int64()),
                        pa.array(near, pa.int32()), pa.array(far, pa.int32()), pa.array(anchor), pa.array(context),
                        pa.array(run, pa.int64()),
                    ],
                    names=["_id", "_content", "at", "near", "far", "anchor", "context", "run"],
                )


def marks(texts: DataFrame) -> DataFrame:
    return texts.mapInArrow(
        _mark, "_id long, _content long, at long, near int, far int, anchor long, context long, run long"
    )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around every listed mark."""
    names = ["_id", "_content", "at", "near", "far", "anchor", "single", "around"]
    for batch in batches:
        texts, lists = batch.column(2), batch.column(3)
        flat, lengths = lists.flatten(), np.diff(np.asarray(lists.offsets))
        row = np.repeat(np.arange(len(batch)), lengths)
        at, near, far, anchor, single = (np.asarray(flat.field(k)) for k in range(5))
        around = []
        last, whole = -1, b""
        for r, p, a, b in zip(row.tolist(), at.tolist(), near.tolist(), far.tolist(), strict=True):
            if r != last:
                last, whole = r, texts[r].as_py().encode()
            around.append(whole[p - b : p - a + LENGTH])
        where = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(where), batch.column(1).take(where), pa.array(at), pa.array(near), pa.array(far),
                pa.array(anchor), pa.array(single), pa.array(around, pa.binary()),
            ],
            names=names,
        )


def suffix_order(right: np.ndarray) -> np.ndarray:
    """Rows in the order of their bytes, from the suffix array of all rows as symbols of BLOCK bytes."""
    n, width = right.shape
    blocks = -(-width // BLOCK)
    table = np.zeros((n, blocks * BLOCK), dtype=np.uint8)
    table[:, :width] = right
    ranks = np.unique(table.reshape(n * blocks, BLOCK).view(f"S{BLOCK}").ravel(), return_inverse=True)[1]
    symbols = np.ones((n, blocks + 1), dtype=np.int64)
    symbols[:, :blocks] = ranks.reshape(n, blocks) + 2
    starts = np.array(suffix_array([*symbols.ravel().tolist(), 0]))
    heads = starts[starts % (blocks + 1) == 0]
    return heads[heads < n * (blocks + 1)] // (blocks + 1)  # the end sign is no row


def repeated_windows(near: np.ndarray, far: np.ndarray, around: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(member, offset): the windows, as bytes before the anchor, that another member has as well."""
    n = len(around)
    lengths = np.array([len(x) for x in around])
    data = np.frombuffer(b"".join(around), dtype=np.uint8)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    anchors = begins + far
    spread = np.arange(LENGTH)
    places = anchors[:, None] + spread
    right = np.where(spread < (lengths - far)[:, None], data[np.minimum(places, len(data) - 1)], 0).astype(np.uint8)
    order = suffix_order(right)
    sorted_right = right[order]
    differ = sorted_right[1:] != sorted_right[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)
    sums = tx.prefix_sums(tx.BYTE_CODES[data])
    members, offsets = [], []
    near, far, anchors = near[order], far[order], anchors[order]
    for offset in range(int(near.min()), int(far.max()) + 1):
        live = np.flatnonzero((near <= offset) & (offset <= far))
        if len(live) < 2:
            continue
        ranges = np.concatenate([[0], np.cumsum(common < LENGTH - offset)])[live].astype(np.uint64)
        left = tx.span_hashes(sums, anchors[live] - offset, anchors[live])
        _, group, count = np.unique(tx.mix(left + tx.mix(ranges + np.uint64(1))), return_inverse=True, return_counts=True)
        hit = live[count[group] > 1]
        members.append(order[hit])
        offsets.append(np.full(len(hit), offset))
    none = np.zeros(0, np.int64)
    return (np.concatenate(members), np.concatenate(offsets)) if members else (none, none)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows among marks that arrive sorted by anchor; a batch ends between anchors."""
    waiting: list[pa.RecordBatch] = []

    def run(table: pa.Table) -> pa.RecordBatch:
        near, far, at = (np.asarray(table.column(k).combine_chunks()) for k in ("near", "far", "at"))
        member, offset = repeated_windows(near, far, table.column("around").to_pylist())
        own = np.asarray(table.column("single").combine_chunks())[member]
        member, offset = member[own], offset[own]
        keys = np.lexsort((-offset, member))
        member, begin = member[keys], at[member[keys]] - offset[keys]
        fresh = np.flatnonzero(np.concatenate([[True], (member[1:] != member[:-1]) | (begin[1:] != begin[:-1] + 1)])) if len(member) else np.zeros(0, np.int64)
        ends = begin[np.append(fresh[1:], len(begin)) - 1] + LENGTH if len(member) else np.zeros(0, np.int64)
        where = pa.array(member[fresh])
        return pa.RecordBatch.from_arrays(
            [
                table.column("_id").combine_chunks().take(where), table.column("_content").combine_chunks().take(where),
                pa.array(begin[fresh], pa.int64()), pa.array(ends, pa.int64()),
            ],
            names=["_id", "_content", "s", "e"],
        )

    for batch in batches:
        waiting.append(batch)
        table = pa.Table.from_batches(waiting)
        if len(table) < BATCH:
            continue
        anchor = np.asarray(table.column("anchor").combine_chunks())
        cuts = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        if len(cuts):
            done = 0
            for cut in [*cuts[np.searchsorted(cuts, np.arange(BATCH, cuts[-1], BATCH))], cuts[-1]]:
                if cut > done:
                    yield run(table.slice(done, cut - done))
                    done = int(cut)
            waiting = table.slice(done).combine_chunks().to_batches()
    if waiting and sum(map(len, waiting)):
        yield run(pa.Table.from_batches(waiting))


_OTHER_CODES = tx.mix(tx.BYTE_CODES + np.uint64(77))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of every mark, by two hashes."""
    for batch in batches:
        around = batch.column(7).to_pylist()
        at, near, far = (np.asarray(batch.column(k)) for k in (2, 3, 4))
        lengths = np.array([len(x) for x in around])
        data = np.frombuffer(b"".join(around), dtype=np.uint8)
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        count = far - near + 1
        row = np.repeat(np.arange(len(around)), count)
        within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        starts = begins[row] + within
        hashes = [tx.span_hashes(tx.prefix_sums(codes[data]), starts, starts + LENGTH).view(np.int64) for codes in (tx.BYTE_CODES, _OTHER_CODES)]
        where = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(where), batch.column(1).take(where), pa.array((at - far)[row] + within, pa.int64()),
                batch.column(6).take(where), *map(pa.array, hashes),
            ],
            names=["_id", "_content", "s", "single", "a", "b"],
        )


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(_id, _content, s, e): spans whose union is every byte to remove."""
    found = materialize(marks(texts), "marks")
    times = F.sum(F.when(F.col("run") > 0, 2).otherwise(1))  # one, or more than one
    often = found.groupBy("anchor").agg(times.alias("_n")).where("_n > 1").select("anchor")
    shared = found.join(materialize(often, "anchors"), "anchor")
    place = F.struct("_id", "_content", "at", "near", "far")
    kinds = shared.groupBy("anchor", "context").agg(times.alias("n"), F.min(place).alias("one"))
    classes = materialize(kinds, "classes")
    copies = found.join(classes.where("n > 1").select("anchor", "context"), ["anchor", "context"]).select(
        "_id", "_content", (F.col("at") - F.col("far")).alias("s"),
        (F.col("at") + F.col("run") - F.col("near") + LENGTH).alias("e"),
    )
    groups = classes.groupBy("anchor").agg(F.count("*").alias("classes"), F.min("n").alias("least")).where("classes > 1 and least = 1")
    members = classes.join(materialize(groups, "groups"), "anchor").select(
        "one._id", "one._content",
        F.struct("one.at", "one.near", "one.far", "anchor", (F.col("n") == 1).alias("single")).alias("mark"),
        (F.col("classes") > HOT).alias("hot"),
    )
    listed = members.groupBy("_id", "_content", "hot").agg(F.collect_list("mark").alias("_marks"))
    wide = texts.join(listed, same_key(texts, listed)).select(texts["_id"], texts["_content"], "_text", "_marks", "hot")
    schema = "_id long, _content long, at long, near int, far int, anchor long, single boolean, around binary"
    around = lambda hot: wide.where(F.col("hot") == hot).drop("hot").mapInArrow(_contexts, schema)
    cool = around(False).repartition("anchor").sortWithinPartitions("anchor")
    compared = cool.mapInArrow(_compared, "_id long, _content long, s long, e long")
    windows = around(True).mapInArrow(_windows, "_id long, _content long, s long, single boolean, a long, b long")
    twice = windows.groupBy("a", "b").agg(F.count("*").alias("_n")).where("_n > 1").select("a", "b")
    counted = windows.where("single").join(twice, ["a", "b"]).select("_id", "_content", "s", (F.col("s") + LENGTH).alias("e"))
    return copies.unionByName(compared).unionByName(counted)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lists = batch.column(1), batch.column(2)
        n_bytes, n_removed, n_spans, digests, kept_texts = [], [], [], [], []
        for text, spans in zip(texts, lists, strict=True):
            whole = text.as_py().encode()
            removed = count = reach = 0
            kept = []
            if spans.is_valid:
                flat = spans.values
                s, e = np.asarray(flat.field(0)), np.asarray(flat.field(1))
                order = np.argsort(s, kind="stable")
                for begin, end in zip(s[order].tolist(), e[order].tolist(), strict=True):
                    if begin > reach or not count:
                        kept.append(whole[reach:begin])
                        count += 1
                        removed += end - begin
                        reach = end
                    elif end > reach:
                        removed += end - reach
                        reach = end
            kept.append(whole[reach:])
            left = b"".join(kept)
            n_bytes.append(len(whole))
            n_removed.append(removed)
            n_spans.append(count)
            digests.append(hashlib.sha256(left).hexdigest())
            kept_texts.append(left)
        columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(digests, pa.string()), pa.array(kept_texts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept: the bytes that stay."""
    text = text_of(docs)
    texts = docs.select(*content_key(docs, text), text.alias("_text"))
    spans = repeated_spans(texts).groupBy("_id", "_content").agg(F.collect_list(F.struct("s", "e")).alias("_spans"))
    joined = texts.join(spans, same_key(texts, spans), "left").select(texts["_id"], "_text", "_spans")
    return joined.mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
