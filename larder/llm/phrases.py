"""Phrase collocation mining with weighted acyclic automata over words.

1. Every shard of texts becomes a count transducer: an acyclic automaton that
   reads lang, word, word, ... and whose states carry how often the words read so
   far occur in a row. Its n-grams come sorted, so a level is appended at a time:
   the states of one level are the distinct pairs of a state above and a word, in
   order, and a state's arcs lie next to each other.
2. A transducer is cut by ranges of its prefixes, in the order of their hashes, so
   ranges are even without a look at the data; a state goes where its own prefix
   belongs and takes its arcs along. The pieces, small blocks of whole numbers with
   the words they use, are shuffled by range and united: weights of the same prefix
   are added, and so are those of the same arc. Only one range is held at once. A part of a phrase occurs at
   least as often as the phrase, so what is below ``least`` is left out of the result
   without loss.
3. The candidates are composed with the united counts: a candidate's cut reads
   its first part on one side and the rest on the other, and both are looked up
   as the shared tape of the composition, a join on (lang, part).

A text is lower-cased (A to Z), cut into pieces at ``. , ; : ! ?`` and the bytes
0A to 0D, and pieces into words at blanks and tabs. Everything is per lang.

Cases: a null text is empty, a null lang is ``und``; rows that repeat count as
often as they stand there; ties go to the higher count, then to the smaller
phrase in byte order; a lang without candidates has no rows; other columns are
not looked at. Counts are whole numbers; products are DECIMAL(38,0), exact for
counts below 10**16.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm import text as tx
from larder.llm.columns import text_of
from larder.sources.scratch import materialize


@dataclass(frozen=True)
class Settings:
    max_words: int = 3
    least: int = 10  # occurrences of a candidate
    cover: int = 50  # percent of a phrase's occurrences inside one longer phrase that drop it
    top: int = 2000
    shard_bytes: int = 8 << 20
    range_bytes: int = 4 << 20  # of text for each prefix range; blocks number shards x ranges, so raise both with the data
    states_at_once: int = 1 << 20  # states and arcs of a range that are held before they are united
    buckets: int = 32  # first round of the ranking, per lang


BLOCKS = "range int, block binary"
COUNTS = "lang string, phrase string, size int, f long"

_CUTS = np.zeros(256, dtype=bool)
_CUTS[[*b".,;:!?", *range(10, 14)]] = True
_GAPS = _CUTS.copy()
_GAPS[[32, 9]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Level:
    """States in sorted order: the state above, the word read last, the weight."""

    up: np.ndarray
    label: np.ndarray
    weight: np.ndarray


def spell(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words sorted, word of each place, row of each place, whether the next place follows in its piece)."""
    gaps = np.ones(len(data) + 2, dtype=bool)
    gaps[1:-1] = _GAPS[data]
    begins, stops = ~gaps[1:] & gaps[:-1], gaps[1:] & ~gaps[:-1]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    crossing = inner[~gaps[inner] & ~gaps[inner + 1]]
    begins[crossing] = stops[crossing] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    row = np.searchsorted(offsets, starts, side="right") - 1
    cut = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_CUTS[data], out=cut[1:])
    follows = (row[1:] == row[:-1]) & (cut[starts[1:]] == cut[starts[:-1]])
    at = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=at[1:])
    letters = _LOWER[data[~gaps[1:-1]]]
    spelled = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(letters)])
    coded = spelled.dictionary_encode()
    order = np.asarray(pc.sort_indices(coded.dictionary))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    words = coded.dictionary.take(pa.array(order)).cast(pa.large_string()).cast(pa.string())
    return words, rank[np.asarray(coded.indices)], row, follows


def automaton(lang: np.ndarray, word: np.ndarray, follows: np.ndarray, n_words: int, depth: int) -> list[Level]:
    """The count transducer of all runs of up to ``depth`` words, one level for each number of words."""
    levels: list[Level] = []
    state, places = lang, np.arange(len(word))
    for d in range(depth):
        keys, state, weight = np.unique(state * n_words + word[places + d], return_inverse=True, return_counts=True)
        levels.append(Level(keys // max(n_words, 1), keys % max(n_words, 1), weight.astype(np.int64)))
        longer = places + d < len(follows)
        longer[longer] = follows[places[longer] + d]
        state, places = state[longer], places[longer]
    return levels


@dataclass
class Block:
    """Part of a transducer: states by size with the words that lead to them, and the arcs below the largest."""

    langs: list[str]
    words: pa.Array
    lang: list[np.ndarray]  # of the states of 1, 2, ... words
    path: list[list[np.ndarray]]  # words of the states of 1, 2, ... words
    weight: list[np.ndarray]
    owner: np.ndarray  # the state above each arc, in order
    label: np.ndarray
    count: np.ndarray

    def size(self) -> int:
        return sum(map(len, self.weight)) + len(self.label)


def pack_arrays(arrays: list[np.ndarray]) -> bytes:
    """Whole numbers from 0 in as few bytes as each array needs, compressed."""
    narrow = [a.astype(np.min_scalar_type(int(a.max(initial=0)))) for a in arrays]
    head = np.array([[len(a), a.dtype.itemsize] for a in narrow], dtype="<i8")
    raw = b"".join([len(arrays).to_bytes(8, "little"), head.tobytes(), *[a.tobytes() for a in narrow]])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_arrays(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    n = int.from_bytes(raw[:8], "little")
    at, found = 8 + 16 * n, []
    for length, width in np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2).tolist():
        found.append(np.frombuffer(raw, f"<u{width}", length, at).astype(np.int64))
        at += length * width
    return found


def dump(block: Block) -> bytes:
    names = [pa.array(block.langs, pa.string()), block.words]
    text = [np.frombuffer(b"".join(x.encode() for x in part.to_pylist()), np.uint8) for part in names]
    lengths = [np.asarray(pc.binary_length(part)).astype(np.int64) for part in names]
    arrays = [*text, *lengths, block.owner, block.label, block.count]
    for lang, path, weight in zip(block.lang, block.path, block.weight, strict=True):
        arrays += [lang, *path, weight]
    return pack_arrays(arrays)


def _strings(letters: np.ndarray, lengths: np.ndarray) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(letters.astype(np.uint8))])


def load(data: bytes) -> Block:
    a = unpack_arrays(data)
    lang, path, weight, at = [], [], [], 7
    while at < len(a):
        size = len(path) + 1
        lang.append(a[at])
        path.append(a[at + 1 : at + 1 + size])
        weight.append(a[at + 1 + size])
        at += size + 2
    return Block(_strings(a[0], a[2]).to_pylist(), _strings(a[1], a[3]), lang, path, weight, a[4], a[5], a[6])


def ranges(levels: list[Level], words: pa.Array, langs: pa.Array, n: int) -> list[np.ndarray]:
    """The prefix range of every state but the deepest: its place among the hashes of prefixes, in n parts."""
    spelled = [_hashes(langs), _hashes(words)]
    found, above = [], spelled[0]
    for level in levels[:-1]:
        above = tx.mix(above[level.up] * np.uint64(0xD6E8FEB86659FD93) + spelled[1][level.label])
        found.append(((above >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64))
    return found


def _hashes(strings: pa.Array) -> np.ndarray:
    lengths = np.asarray(pc.binary_length(strings)).astype(np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(x.encode() for x in strings.to_pylist()), np.uint8)
    return tx.span_hashes(tx.prefix_sums(tx.BYTE_CODES[data]), ends - lengths, ends) if len(data) else np.zeros(len(strings), np.uint64)


def cut_by_range(levels: list[Level], words: pa.Array, langs: pa.Array, n: int) -> Iterator[tuple[int, Block]]:
    """The blocks of one transducer, by prefix range."""
    place = ranges(levels, words, langs, n)
    lang, path = [levels[0].up], [[levels[0].label]]
    for level in levels[1:-1]:
        lang.append(lang[-1][level.up])
        path.append([*[column[level.up] for column in path[-1]], level.label])
    sorted_by = [np.argsort(p, kind="stable") for p in place]
    bounds = [np.searchsorted(p[o], np.arange(n + 1)) for p, o in zip(place, sorted_by, strict=True)]
    last = levels[-1]
    first = np.searchsorted(last.up, np.arange(len(levels[-2].weight) + 1))
    for r in np.unique(np.concatenate(place)).tolist():
        own = [o[b[r] : b[r + 1]] for o, b in zip(sorted_by, bounds, strict=True)]
        arcs = first[own[-1] + 1] - first[own[-1]]
        at = np.repeat(first[own[-1]] - (np.cumsum(arcs) - arcs), arcs) + np.arange(int(arcs.sum()))
        columns = [[column[o] for column in labels] for labels, o in zip(path, own, strict=True)]
        used = np.unique(np.concatenate([c for labels in columns for c in labels] + [last.label[at]]))
        new = lambda label: np.searchsorted(used, label)  # noqa: E731, B023
        yield r, Block(
            langs.to_pylist(), words.take(pa.array(used)), [x[o] for x, o in zip(lang, own, strict=True)],
            [[new(c) for c in labels] for labels in columns], [level.weight[o] for level, o in zip(levels, own, strict=False)],
            np.repeat(np.arange(len(arcs)), arcs), new(last.label[at]), last.weight[at],
        )


def _shards(batches: Iterator[pa.RecordBatch], s: Settings, n: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the transducers of consecutive rows of bounded size, a long text being cut between its pieces."""
    held: list[tuple[str, np.ndarray]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        names = sorted({name for name, _ in held})
        number = {name: k for k, name in enumerate(names)}
        offsets = np.concatenate([[0], np.cumsum([len(part) for _, part in held])]).astype(np.int64)
        words, word, row, follows = spell(np.concatenate([part for _, part in held]), offsets)
        if len(word):
            lang = np.array([number[name] for name, _ in held], dtype=np.int64)[row]
            levels = automaton(lang, word, follows, len(words), s.max_words)
            for r, block in cut_by_range(levels, words, pa.array(names, pa.string()), n):
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([dump(block)], pa.binary())], names=["range", "block"])

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for first, last, data, offsets in tx.chunks(batch.column(1)):
            for k in range(first, last):
                for part in _between_pieces(data[offsets[k - first] : offsets[k - first + 1]], s.shard_bytes):
                    held.append((langs[k], part))
                    size += len(part)
                    if size >= s.shard_bytes:
                        yield from flush()
                        held, size = [], 0
    if held:
        yield from flush()


def _between_pieces(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    while len(data) > limit:
        cuts = np.flatnonzero(_CUTS[data[:limit]])
        if not len(cuts):
            later = np.flatnonzero(_CUTS[data[limit:]])
            if not len(later):
                break
            cuts = later[:1] + limit
        yield data[: cuts[-1] + 1]
        data = data[cuts[-1] + 1 :]
    yield data


def unite(blocks: list[Block]) -> Block:
    """The union of blocks of the same range: each state and arc once, with the sum of its weights."""
    langs = sorted({name for block in blocks for name in block.langs})
    number = {name: k for k, name in enumerate(langs)}
    coded = pa.concat_arrays([block.words for block in blocks]).dictionary_encode()
    order = np.asarray(pc.sort_indices(coded.dictionary))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    index, width = rank[np.asarray(coded.indices)], max(len(order), 1)
    start = np.concatenate([[0], np.cumsum([len(block.words) for block in blocks])])
    word = lambda k, label: index[start[k] + label]
    lang, path, weight = [], [], []
    for d in range(len(blocks[0].path)):
        columns = [np.concatenate([np.array([number[x] for x in b.langs], dtype=np.int64)[b.lang[d]] for b in blocks])]
        columns += [np.concatenate([word(k, b.path[d][j]) for k, b in enumerate(blocks)]) for j in range(d + 1)]
        # pairs are numbered word by word, so keys stay below states x words
        key = columns[0]
        for column in columns[1:]:
            key = np.unique(key * width + column, return_inverse=True)[1]
        _, first = np.unique(key, return_index=True)
        total = np.zeros(len(first), dtype=np.int64)
        np.add.at(total, key, np.concatenate([b.weight[d] for b in blocks]))
        lang.append(columns[0][first])
        path.append([column[first] for column in columns[1:]])
        weight.append(total)
    above = np.cumsum([0] + [len(b.weight[-1]) for b in blocks])
    owner = np.concatenate([key[above[k] + b.owner] for k, b in enumerate(blocks)])
    label = np.concatenate([word(k, b.label) for k, b in enumerate(blocks)])
    arcs, at = np.unique(owner * width + label, return_inverse=True)
    count = np.zeros(len(arcs), dtype=np.int64)
    np.add.at(count, at, np.concatenate([b.count for b in blocks]))
    return Block(langs, coded.dictionary.take(pa.array(order)), lang, path, weight, arcs // width, arcs % width, count)


def frequent(block: Block, least: int) -> Iterator[pa.RecordBatch]:
    """Phrases of at least ``least`` occurrences, and the words of each lang under the empty phrase."""
    langs = pa.array(block.langs, pa.string())

    def rows(lang: np.ndarray, phrase: pa.Array, size: int, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(f):
            columns = [langs.take(pa.array(lang)), phrase, pa.array(np.full(len(f), size, np.int32)), pa.array(f)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "size", "f"])

    def spelled(columns: list[np.ndarray]) -> pa.Array:
        return pc.binary_join_element_wise(*[block.words.take(pa.array(c)) for c in columns], " ")

    words = np.zeros(len(langs), dtype=np.int64)
    np.add.at(words, block.lang[0], block.weight[0])
    yield from rows(np.arange(len(langs)), pa.array([""] * len(langs), pa.string()), 0, words)
    for d, (lang, path, weight) in enumerate(zip(block.lang, block.path, block.weight, strict=True)):
        keep = np.flatnonzero(weight >= least)
        yield from rows(lang[keep], spelled([c[keep] for c in path]), d + 1, weight[keep])
    keep = np.flatnonzero(block.count >= least)
    owner = block.owner[keep]
    yield from rows(block.lang[-1][owner], spelled([*[c[owner] for c in block.path[-1]], block.label[keep]]), len(block.path) + 1, block.count[keep])


def _unite(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """The frequent phrases of each prefix range, whose blocks come one after the other."""
    held: list[Block] = []
    place, size = None, 0
    for batch in batches:
        for r, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if r != place and held:
                yield from frequent(unite(held), s.least)
                held, size = [], 0
            place = r
            held.append(load(data))
            size += held[-1].size()
            if size >= s.states_at_once and len(held) > 1:
                held = [unite(held)]
                # what does not shrink is not united again for every block
                size = held[0].size() // 2
    if held:
        yield from frequent(unite(held), s.least)


def count_phrases(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """lang, phrase, size and f of all runs of 1 to ``max_words`` words with f >= ``least``; size 0 counts a lang's words."""
    if s.max_words < 2 or s.least < 1:
        raise ValueError("max_words is at least 2 and least at least 1")
    lang = F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang")
    texts = docs.select(lang, text_of(docs).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-size // s.range_bytes))
    blocks = texts.mapInArrow(lambda batches: _shards(batches, s, n), BLOCKS)
    ranged = blocks.repartition("range").sortWithinPartitions("range")
    return materialize(ranged.mapInArrow(lambda batches: _unite(batches, s), COUNTS), "phrases")


def compose(cuts: DataFrame, counts: DataFrame, part: str, out: str) -> DataFrame:
    """Rows of ``cuts`` with the weight that ``counts`` gives to what they read in ``part``."""
    looked_up = counts.where("size > 0").select("lang", F.col("phrase").alias(part), F.col("f").alias(out))
    return cuts.join(looked_up, ["lang", part])


def _part(first: Column | int, length: Column) -> Column:
    return F.array_join(F.slice("words", first, length), " ")


def scored(counts: DataFrame) -> DataFrame:
    """Every candidate with the cut of the lowest score."""
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    cuts = (
        counts.where("size >= 2")
        .select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .select("lang", "phrase", "size", "a", "k", _part(1, F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    )
    both = compose(compose(cuts, counts, "first", "l"), counts, "rest", "r")
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (_a * _a)) div (_l * _r)").cast("long")
    rated = both.withColumns({"_a": wide("a"), "_l": wide("l"), "_r": wide("r")}).withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return rated.groupBy("lang", "phrase", "size", "a").agg(lowest).select("lang", "phrase", "size", "a", "cut.*")


def covered(counts: DataFrame, s: Settings) -> DataFrame:
    """lang, phrase and how often the most frequent longer candidate around it occurs."""
    spans = lambda size: F.expr(
        f"transform(sequence(1, size - {size} + 1), i -> array_join(slice(words, i, {size}), ' '))"
    )
    # a place is an array per shorter size, empty where the phrase is no longer than it
    inside = F.flatten(F.array(*[F.when(F.col("size") > k, spans(k)).otherwise(F.array().cast("array<string>")) for k in range(2, s.max_words)]))
    return (
        counts.where("size >= 3")
        .select("lang", "f", "size", F.split("phrase", " ").alias("words"))
        .select("lang", "f", F.explode(F.array_distinct(inside)).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("_longer"))
    )


def phrases(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score and k: the first ``top`` phrases of each lang."""
    s = settings
    counts = count_phrases(docs, s)
    found = scored(counts)
    if s.max_words > 2:
        longer = covered(counts, s)
        found = found.join(longer, ["lang", "phrase"], "left").where(
            F.col("_longer").isNull() | (F.col("_longer").cast("decimal(21,0)") * 100 < F.col("a").cast("decimal(21,0)") * s.cover)
        )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first inside buckets of each lang, then among the bucket winners: no task ranks a whole lang
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(s.buckets))
    near = F.row_number().over(Window.partitionBy("lang", "_bucket").orderBy(*order))
    last = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best = found.withColumn("_bucket", bucket).withColumn("_near", near).where(F.col("_near") <= s.top)
    words = counts.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    ranked = best.withColumn("rank", last.cast("long")).where(F.col("rank") <= s.top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("k").cast("long").alias("k"))


def sql(s: Settings = Settings()) -> str:
    """The query as DuckDB SQL, for at most three words."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    longer = " UNION ALL ".join(
        f"SELECT lang, w[i:i + {d - 1}] AS g FROM pieces, unnest(range(1, len(w) - {d} + 2)) AS u(i)" for d in range(1, s.max_words + 1)
    )
    cuts = " UNION ALL ".join(
        f"SELECT lang, g, f, {k} AS k, g[1:{k}] AS x, g[{k + 1}:] AS y FROM counted WHERE len(g) > {k} AND f >= {s.least}" for k in range(1, s.max_words)
    )
    return rf"""WITH texts AS (
      SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents),
    pieces AS (
      SELECT lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda x: x <> '') AS w
      FROM texts, unnest(regexp_split_to_array(t, '[.,;:!?\n\x0B\x0C\r]')) AS u(p)),
    counted AS (SELECT lang, g, count(*) AS f FROM ({longer}) GROUP BY ALL),
    sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE len(g) = 1 GROUP BY lang),
    cuts AS ({cuts}),
    rated AS (
      SELECT c.lang, c.g, c.f AS a, c.k, p.f AS l, q.f AS r,
             CAST(1000000::HUGEINT * c.f * c.f // (p.f::HUGEINT * q.f) AS BIGINT) AS score
      FROM cuts c JOIN counted p ON p.lang = c.lang AND p.g = c.x JOIN counted q ON q.lang = c.lang AND q.g = c.y),
    cut AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    longer AS (
      SELECT lang, w AS g, max(f) AS longer FROM (
        SELECT lang, f, g[i:i + d - 1] AS w FROM counted, unnest(range(2, {s.max_words})) AS v(d), unnest(range(1, len(g) - d + 2)) AS u(i)
        WHERE f >= {s.least} AND len(g) > d) GROUP BY ALL),
    ranked AS (
      SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, array_to_string(c.g, ' ')) AS rank,
             array_to_string(c.g, ' ') AS phrase, a, l, r, n, score, CAST(k AS BIGINT) AS k
      FROM cut c JOIN sizes USING (lang) LEFT JOIN longer x ON x.lang = c.lang AND x.g = c.g
      WHERE longer IS NULL OR 100 * longer < {s.cover} * a)
    SELECT * FROM ranked WHERE rank <= {s.top}"""
