"""Language-model scores by context-tree weighting over binary-decomposed bytes.

Each byte is eight binary decisions; a decision's node is the byte's prefix so far (255 nodes), its
context the bytes before. At every context of 0 to `depth` bytes a node holds a
Krichevsky-Trofimov estimate, and context-tree weighting mixes all depths: a node's weight against
its deeper contexts is the posterior of the training text under either. The trained tree is frozen,
so the probability of the next byte depends on the `depth` bytes before it alone: on its gram, the
context and the byte.

The model is a table of grams that grows with the corpus; no task and no broadcast holds it. Contexts
that agree in their last two bytes form a subtree, and a row holds the grams of one subtree, sorted
and packed. A chunk of texts stages a row per subtree with its distinct grams and their training
counts; the rows of a subtree meet in one task, which sums them. A task takes whole subtrees, several
at a time, and mixes one depth after the other, upwards for the weights and downwards for the
probabilities. Only contexts of less than two bytes (at most 257 x 255 nodes, whatever the corpus)
are put together on the driver. Grams that only held-out texts have are in the table with a count of
zero, which changes no weight. Then a subtree's row meets those of the chunks, and each chunk's comes
back with the scores of its grams. The code length is exact over the
closed text: start marks before it, an end mark after it (byte 0xFF, which UTF-8 never uses).

The base score needs the count of every word in the training set, also a table without a bound. A
task numbers the words of its texts chunk by chunk, so the rows of a word, one per chunk, are summed
where they meet, and a chunk's documents then look up numbers, not words.

A chunk's texts are written to a file once and read by the task that scores them. Files are named by
chunk and attempt; only names that reach the staged rows count.

Edge cases: NULL and empty texts consist of their end. A NULL id is trained on. Repeated rows count
and are scored once per row. If no document is trained on, every byte has the uniform probability.
An empty table gives no rows. Other columns are never looked at.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import ASCII_LOWER, open_store, staged
from orderloom.session import new_folder

FOLDS, HELD_OUT_FOLD = 7, 2
MARK = 0xFF
BYTES_AT_ONCE = 2 << 20
LOOKED_UP_AT_ONCE = 1 << 19
TEXTS_AT_ONCE = 512
CHUNK_BYTES = 24 << 20
CHUNK_WORDS = 400_000
CHUNK_GRAMS = 2_000_000
TREE_GRAMS = 500_000
MOST_DEPTH = 7  # a gram is kept in the eight bytes of a long
LOG10_HALF = float(np.log10(0.5))
WORDS, GRAMS, TEXTS = 0, 1, 2

ROOTS = "last int, before int, node int, zeros long, ones long, log_weighted double"
SUMS = "tree long, grams binary, counts binary"
TABLE = "tree long, grams binary, logs binary"
ANSWERS = "chunk long, number long, grams binary, logs binary"
STAGED = "chunk long, kind int, number long, word binary, train long, grams binary, counts binary, name string"
FILED = "doc_id long, held_out boolean, text binary"
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double, bits_per_byte double"
)
_KINDS = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "string": pa.string(),
}


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(part.split() for part in schema.split(",")))
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds)
    ]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def held_out(id_: Column) -> Column:
    text = F.coalesce(id_.cast("string"), F.lit(""))
    return F.crc32(text) % FOLDS == HELD_OUT_FOLD


# ---- training -----------------------------------------------------------------------------------


def _closed(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The texts between marks, one after the other, where each begins, and where the last ends."""
    marks = b"\xff" * depth
    joined = b"".join(marks + t + b"\xff" for t in texts)
    starts = np.cumsum([0] + [len(t) + depth + 1 for t in texts[:-1]])
    return np.frombuffer(joined + bytes(8), dtype=np.uint8), starts, len(joined)


def _grams(data: np.ndarray, low: int, high: int, depth: int) -> np.ndarray:
    """Context and byte at each position of [low, high); the first positions have no context."""
    low = max(low, depth)
    eight = np.ndarray((max(high - low, 0),), ">u8", data, low - depth, (1,))
    return eight.astype(np.uint64) >> np.uint64(8 * (MOST_DEPTH - depth))


def _pieces(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Lower-cased texts, some megabytes at a time, with the row where each piece begins."""
    piece, size, first = [], 0, 0
    parts = (column.slice(low, TEXTS_AT_ONCE) for low in range(0, len(column), TEXTS_AT_ONCE))
    for row, text in enumerate(text for part in parts for text in part.to_pylist()):
        data = (text or "").encode().translate(ASCII_LOWER)
        if piece and size + len(data) > BYTES_AT_ONCE:
            yield first, piece
            piece, size, first = [], 0, row
        piece.append(data)
        size += len(data)
    if piece:
        yield first, piece


class GramCounts:
    """Distinct grams and their training counts, gathered from pieces of texts."""

    def __init__(self, depth: int) -> None:
        self._depth = depth
        self.clear()

    def clear(self) -> None:
        self._parts: list[tuple[np.ndarray, np.ndarray]] = []
        self._pending = 0

    def add(self, texts: list[bytes], trained: bool) -> None:
        data, starts, size = _closed(texts, self._depth)
        begin = np.zeros(size, dtype=bool)
        for shift in range(self._depth):
            begin[starts + shift] = True
        for low in range(0, size, BYTES_AT_ONCE):
            high = min(low + BYTES_AT_ONCE, size)
            keys = _grams(data, low, high, self._depth)[~begin[max(low, self._depth) : high]]
            keys, n = np.unique(keys, return_counts=True)
            self._parts.append((keys, n if trained else np.zeros_like(n)))
            self._pending += len(keys)
            if self._pending > CHUNK_GRAMS + CHUNK_GRAMS // 2:
                self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self._parts) != 1:
            self._parts = [_summed(self._parts)]
        self._pending = len(self._parts[0][0])
        return self._parts[0]

    def full(self) -> bool:
        return self._pending > CHUNK_GRAMS and len(self.merged()[0]) > CHUNK_GRAMS


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in ascending order and the sums of their counts."""
    keys = np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in parts)])
    n = np.concatenate([np.zeros(0, np.int64), *(n for _, n in parts)])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(_changes(keys))
    return keys[first], np.add.reduceat(n, first) if len(n) else n


def _packed(values: np.ndarray) -> bytes:
    """Values of eight bytes, the first bytes of all of them before the second ones, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], 8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view(kind)[:, 0]


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys, by their differences."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


def _changes(values: np.ndarray) -> np.ndarray:
    """True where a sorted array begins another value."""
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series behind a shift by eight; numpy has no such function."""
    shift = sum(np.log(x + i) for i in range(8))
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The Krichevsky-Trofimov probability (log) of a sequence with these counts."""
    half = np.log(np.pi)  # twice the log gamma of one half
    whole = log_gamma(zeros + ones + 1.0)
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - half - whole


_TABLED = 1 << 16
_HALVES = log_gamma(np.arange(_TABLED) + 0.5)
_WHOLES = log_gamma(np.arange(_TABLED) + 1.0)


def _log_gammas(known: np.ndarray, counts: np.ndarray, more: float) -> np.ndarray:
    out = known[np.minimum(counts, _TABLED - 1)]
    big = np.flatnonzero(counts >= _TABLED)
    out[big] = log_gamma(counts[big] + more)
    return out


def log_kt_counts(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """`log_kt` of whole numbers, most of them looked up."""
    both = _log_gammas(_HALVES, zeros, 0.5) + _log_gammas(_HALVES, ones, 0.5)
    return both - np.log(np.pi) - _log_gammas(_WHOLES, zeros + ones, 1.0)


def node_counts(bytes_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(..., 256) byte counts to zeros and ones at the 255 nodes, in the order of `byte_logs`."""
    zeros, ones = [], []
    for level in range(8):
        blocks = bytes_.reshape(*bytes_.shape[:-1], 1 << level, 2, -1).sum(axis=-1)
        zeros.append(blocks[..., 0])
        ones.append(blocks[..., 1])
    return np.concatenate(zeros, axis=-1), np.concatenate(ones, axis=-1)


def byte_logs(p_one: np.ndarray) -> np.ndarray:
    """(..., 255) node probabilities of a one to the (..., 256) logs (base 10) of the bytes."""
    out = np.zeros((*p_one.shape[:-1], 1))
    at = 0
    for level in range(8):
        one = p_one[..., at : at + (1 << level)]
        at += 1 << level
        both = np.stack([np.log10(1 - one), np.log10(one)], axis=-1)
        out = (out[..., None] + both).reshape(*out.shape[:-1], -1)
    return out


def _share(log_own: np.ndarray, log_deeper: np.ndarray) -> np.ndarray:
    """A node's posterior weight against its deeper contexts."""
    return 1 / (1 + np.exp(np.clip(log_deeper - log_own, -700, 700)))


def last_byte_part(counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """For one last byte, counts (256 bytes before it, 256 bytes after it): its 255 nodes.

    This is the dense form of a tree of two bytes, node by node; `Subtrees` is the one in use.
    Returns zeros, ones, the weighted log probability, and the mixture's probability of a one in
    each of the 256 contexts.
    """
    zeros, ones = node_counts(counts.astype(np.float64))
    leaf = log_kt(zeros, ones).sum(axis=0)
    all_zeros, all_ones = zeros.sum(axis=0), ones.sum(axis=0)
    own = log_kt(all_zeros, all_ones)
    weighted = np.logaddexp(own, leaf) + np.log(0.5)
    share = _share(own, leaf)
    p_leaf = (ones + 0.5) / (zeros + ones + 1.0)
    p_own = (all_ones + 0.5) / (all_zeros + all_ones + 1.0)
    return all_zeros, all_ones, weighted, share * p_own + (1 - share) * p_leaf


def _backwards(grams: np.ndarray, depth: int) -> np.ndarray:
    """The context's bytes from the last to the first, then the byte, so that subtrees sort; and back."""
    turned = grams.byteswap() << np.uint64(8)
    turned >>= np.uint64(8 * (MOST_DEPTH - depth))
    return turned | (grams & np.uint64(255))


class Upper:
    """The contexts of no and of one byte: shares and probabilities of a one at their nodes."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, deeper: np.ndarray) -> None:
        """Sums over the subtrees, (256 last bytes, 255 nodes)."""
        own = log_kt(zeros, ones)
        self.share, self.p = _share(own, deeper), (ones + 0.5) / (zeros + ones + 1.0)
        below = (np.logaddexp(own, deeper) + np.log(0.5)).sum(axis=0)
        zeros, ones = zeros.sum(axis=0), ones.sum(axis=0)
        self.root_share = _share(log_kt(zeros, ones), below)
        self.root_p = (ones + 0.5) / (zeros + ones + 1.0)


class Subtrees:
    """Whole subtrees below contexts of two bytes, from their distinct grams (backwards) and counts.

    A node is a context and a prefix of the byte. The nodes of the eight prefix lengths never meet,
    so they are worked out one length after the other, over all subtrees together.
    """

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int) -> None:
        self._order = np.argsort(keys, kind="stable")
        keys, n = keys[self._order], n[self._order]
        # From the deepest contexts to those of two bytes: grams, counts, each one's shorter gram.
        self._depths: list[tuple[np.ndarray, np.ndarray, np.ndarray | None]] = []
        eight, byte = np.uint64(8), np.uint64(255)
        for _ in range(depth - 2):
            shorter = keys >> np.uint64(16) << eight | keys & byte
            shorter, up = np.unique(shorter, return_inverse=True)
            self._depths.append((keys, n, up))
            total = np.zeros(len(shorter), dtype=np.int64)
            np.add.at(total, up, n)
            keys, n = shorter, total
        self._depths.append((keys, n, None))

    def _nodes(self, length: int) -> list[tuple]:
        """Per depth, deepest first: node of each gram, first gram, counts, weights, way up."""
        out, up, child, weighted = [], None, None, None
        for keys, n, next_up in self._depths:
            new = _changes(keys >> np.uint64(8 - length))
            first, node = np.flatnonzero(new), np.cumsum(new) - 1
            one = (keys >> np.uint64(7 - length) & np.uint64(1)).astype(np.int64)
            total, ones = np.add.reduceat(n, first), np.add.reduceat(n * one, first)
            own = log_kt_counts(total - ones, ones)
            p, share, parent = (ones + 0.5) / (total + 1.0), None, None
            if weighted is None:
                weighted = own
            else:
                parent = node[up[child]]
                deeper = np.bincount(parent, weighted, len(first))
                share = _share(own, deeper)
                weighted = np.logaddexp(own, deeper) + np.log(0.5)
            out.append((node, one, first, total, ones, weighted, p, share, parent))
            up, child = next_up, first
        return out

    def _named(self, first: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
        """Last byte, the byte before it and the node's place among the 255, of two-byte nodes."""
        keys = self._depths[-1][0][first].astype(np.int64)
        return keys >> 16, keys >> 8 & 255, (1 << length) - 1 + ((keys & 255) >> (8 - length))

    def roots(self) -> Iterator[list[np.ndarray]]:
        """The columns of ROOTS for the trained nodes of two-byte contexts."""
        for length in range(8):
            _, _, first, total, ones, weighted, *_ = self._nodes(length)[-1]
            columns = [*self._named(first, length), total - ones, ones, weighted]
            yield [c[total > 0] for c in columns]

    def log10_p(self, upper: Upper) -> np.ndarray:
        """The log10 probability of each gram's byte in its context."""
        probability = np.ones(len(self._order))
        for length in range(8):
            (node, one, first, *_, p, _, _), *shorter = depths = self._nodes(length)
            at = np.arange(len(first))
            for *_, own, share, parent in shorter:
                at = parent[at]
                p = share[at] * own[at] + (1 - share[at]) * p
            last, _, place = self._named(depths[-1][2], length)
            last, place = last[at], place[at]
            share = upper.share[last, place]
            p = share * upper.p[last, place] + (1 - share) * p
            share = upper.root_share[place]
            p = share * upper.root_p[place] + (1 - share) * p
            p = p[node]
            probability *= np.where(one == 1, p, 1 - p)
        out = np.empty(len(probability))
        out[self._order] = np.log10(probability)
        return out


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, np.ndarray, np.ndarray]]:
    """Rows of SUMS, some at a time: their trees and packed grams, and all their grams and counts."""
    trees, packed, parts, size = [], [], [], 0
    for batch in batches:
        for tree, grams, counts in zip(*(c.to_pylist() for c in batch.columns)):
            trees.append(tree)
            packed.append(grams)
            parts.append((_unpacked_keys(grams), _unpacked(counts, np.int64)))
            size += len(parts[-1][0])
            if size >= TREE_GRAMS:
                yield trees, packed, *(np.concatenate(c) for c in zip(*parts))
                trees, packed, parts, size = [], [], [], 0
    if parts:
        yield trees, packed, *(np.concatenate(c) for c in zip(*parts))


def _in_batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows of packed values, as many in a batch as take some megabytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if size > BYTES_AT_ONCE or len(held) == 10_000:
            yield _batch(list(map(list, zip(*held))), schema)
            held, size = [], 0
    if held:
        yield _batch(list(map(list, zip(*held))), schema)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """A row of SUMS per subtree, from the rows of its chunks, which follow one another."""
    tree, parts, size, least = None, [], 0, 0

    def row() -> tuple:
        keys, n = _summed(parts)
        return tree, _packed_keys(keys), _packed(n)

    for batch in batches:
        for next_tree, grams, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if next_tree != tree:
                if parts:
                    yield row()
                tree, parts, size, least = next_tree, [], 0, 0
            parts.append((_unpacked_keys(grams), _unpacked(counts, np.int64)))
            size += len(parts[-1][0])
            if size > 2 * least + TREE_GRAMS:
                parts = [_summed(parts)]
                size = least = len(parts[0][0])
    if parts:
        yield row()


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of the chunks with their logs; a subtree's row of TABLE comes before them."""
    for batch in batches:
        for tree, chunk, grams, logs in zip(*(c.to_pylist() for c in batch.columns)):
            if logs is not None:
                known, known_logs = _unpacked_keys(grams), _unpacked(logs, np.float64)
                continue
            found = known_logs[np.searchsorted(known, _unpacked_keys(grams))]
            yield chunk, tree, grams, _packed(found)


def train(grams: DataFrame, depth: int) -> DataFrame:
    """TABLE from the chunks' (tree, grams, counts), a row per subtree of the corpus."""
    own = grams.select("tree", "grams", "counts").repartition("tree").sortWithinPartitions("tree")
    trees = staged(own.mapInArrow(lambda batches: _in_batches(_sums(batches), SUMS), SUMS), "grams")

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, *part in _subtrees(batches):
            for columns in Subtrees(*part, depth).roots():
                yield _batch(columns, ROOTS)

    # Summed in a fixed order, so that no digit depends on how the rows were dealt out.
    deeper = F.aggregate(
        F.sort_array(F.collect_list(F.struct("before", "log_weighted"))),
        F.lit(0.0),
        lambda total, part: total + part["log_weighted"],
    )
    nodes = trees.mapInArrow(roots, ROOTS).groupBy("last", "node")
    nodes = nodes.agg(F.sum("zeros").alias("z"), F.sum("ones").alias("o"), deeper.alias("d"))
    sums = np.zeros((3, 256, 255))
    for last, node, *values in nodes.collect():  # 256 x 255 rows at most
        sums[:, last, node] = values
    shared = grams.sparkSession.sparkContext.broadcast(Upper(*sums))

    def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for names, packed, keys, n in _subtrees(batches):
            found, at = Subtrees(keys, n, depth).log10_p(shared.value), 0
            for tree, own in zip(names, packed):
                size = int.from_bytes(own[:8], "little")
                yield tree, own, _packed(found[at : at + size])
                at += size

    return trees.mapInArrow(lambda batches: _in_batches(logs(batches), TABLE), TABLE)


def answered(grams: DataFrame, model: DataFrame) -> DataFrame:
    """ANSWERS: the chunks' (tree, chunk, grams) with the log10 probabilities of their grams."""
    asked = grams.select("tree", "chunk", "grams", F.lit(None).cast("binary").alias("logs"))
    known = model.select("tree", F.lit(-1).cast("long").alias("chunk"), "grams", "logs")
    by_tree = known.union(asked).repartition("tree").sortWithinPartitions("tree", "chunk")
    return by_tree.mapInArrow(lambda batches: _in_batches(_answers(batches), ANSWERS), ANSWERS)


class Lookup:
    """The log10 probabilities of a chunk's grams, by an open table of hashes."""

    def __init__(self, grams: np.ndarray, logs: np.ndarray) -> None:
        bits = max(4, 2 + int(len(grams)).bit_length())
        self._shift = np.uint64(64 - bits)
        order = np.argsort(grams)
        self._grams, self._logs = grams[order], logs[order]
        self._at = np.zeros(1 << bits, dtype=np.int32)
        self._at[self._slots(self._grams)] = np.arange(len(grams), dtype=np.int32)

    def _slots(self, grams: np.ndarray) -> np.ndarray:
        return grams * np.uint64(0x9E3779B97F4A7C15) >> self._shift

    def _of(self, grams: np.ndarray) -> np.ndarray:
        at = self._at[self._slots(grams)]
        other = np.flatnonzero(self._grams[at] != grams)  # grams that share a slot
        at[other] = np.searchsorted(self._grams, grams[other])
        return self._logs[at]

    def score(self, texts: list[bytes], depth: int) -> np.ndarray:
        """The log10 probability of each closed text."""
        data, starts, size = _closed(texts, depth)
        sums = np.zeros(len(texts))
        ends = np.append(starts[1:], size)
        begin = np.zeros(size, dtype=bool)
        for shift in range(depth):
            begin[starts + shift] = True
        step = min(BYTES_AT_ONCE, LOOKED_UP_AT_ONCE)
        for low in range(0, size, step):
            high = min(low + step, size)
            logs = np.zeros(high - low)
            coded = np.flatnonzero(~begin[low:high])
            skip = max(low, depth) - low
            logs[coded] = self._of(_grams(data, low, high, depth)[coded - skip])
            first, stop = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high)
            cuts = np.maximum(starts[first:stop] - low, 0)
            sums[first:stop] += np.add.reduceat(logs, cuts)
        return sums


# ---- scoring ------------------------------------------------------------------------------------


def _scored(docs: DataFrame, depth: int) -> DataFrame:
    """A row per chunk's file of texts, per chunk's distinct word and per chunk's subtree with its grams."""
    folder = new_folder(docs.sparkSession, "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        numbers: dict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        train, grams = np.zeros(0, dtype=np.int64), GramCounts(depth)
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        name, out, trained_texts, size = None, None, 0, 0

        def by_tree() -> Iterator[tuple]:
            forward, counts = grams.merged()
            keys = _backwards(forward, depth)
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            trees = keys >> np.uint64(8 * (depth - 1))
            cuts = np.append(np.flatnonzero(_changes(trees)), len(keys)).tolist()
            for low, high in zip(cuts, cuts[1:]):
                packed = _packed_keys(keys[low:high]), _packed(counts[low:high])
                yield chunk, GRAMS, int(trees[low]), None, None, *packed, None

        def gathered() -> Iterator[pa.RecordBatch]:
            out[0].close()
            out[1].close()
            yield _batch([[v] for v in (chunk, TEXTS, 0, None, trained_texts, None, None, name)], STAGED)
            known = list(numbers)
            for low in range(0, len(known), 10_000):
                part = known[low : low + 10_000]
                n = len(part)
                values = [[chunk] * n, [WORDS] * n, range(low, low + n), part, train[low : low + n]]
                rest = (pa.binary(), pa.binary(), pa.string())
                yield _batch([*values, *(pa.nulls(n, k) for k in rest)], STAGED)
            yield from _in_batches(by_tree(), STAGED)

        for batch in batches:
            ids_, outs = batch.column(0), batch.column(1).to_pylist()
            for first, texts in _pieces(batch.column(2)):
                n = len(texts)
                rows = [np.fromiter(map(numbers.__getitem__, w), np.uint32, len(w)) for w in map(bytes.split, texts)]
                train = np.concatenate([train, np.zeros(len(numbers) - len(train), np.int64)])
                held = outs[first : first + n]
                own = [r for r, o in zip(rows, held) if not o]
                if own:
                    train += np.bincount(np.concatenate(own), minlength=len(train))
                for trained in (True, False):
                    part = [t for t, o in zip(texts, held) if o is not trained]
                    if part:
                        grams.add(part, trained)
                filed = _batch([ids_.slice(first, n), held, texts], FILED)
                if out is None:
                    name = f"{chunk:016x}-{uuid.uuid4().hex}.arrow"
                    file = store.open_output_stream(f"{root}/{name}")
                    packing = pa.ipc.IpcWriteOptions(compression="zstd")
                    out = pa.ipc.new_stream(file, filed.schema, options=packing), file
                out[0].write_batch(filed)
                trained_texts += len(own)
                size += sum(map(len, texts))
                if size > CHUNK_BYTES or len(numbers) > CHUNK_WORDS or grams.full():
                    yield from gathered()
                    numbers.clear()
                    grams.clear()
                    train, chunk, out, trained_texts, size = train[:0], chunk + 1, None, 0, 0
        if out is not None:
            yield from gathered()

    rows = staged(docs.mapInArrow(run, STAGED), "scored", compression="zstd")
    return rows.withColumn("folder", F.lit(folder))


def _with_scores(
    rows: DataFrame, depth: int, train_tokens: int, distinct: int, ends: int
) -> DataFrame:
    """Sums both scores; a chunk's words and grams come before its texts."""
    smooth = float(np.log10(train_tokens + distinct + 1))
    end_log, end_known = float(np.log10(ends + 1)) - smooth, int(ends > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, counts, grams = None, [], []
        numbers: dict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        logs, known, model = None, None, None

        def scored(filed: pa.RecordBatch) -> pa.RecordBatch:
            texts = filed.column(2).to_pylist()
            ids = [np.fromiter(map(numbers.__getitem__, w), np.uint32, len(w)) for w in map(bytes.split, texts)]
            score, n_bytes = model.score(texts, depth), np.array([len(t) for t in texts])
            bits = np.full(len(texts), np.nan)
            np.divide(-score, n_bytes * -LOG10_HALF, out=bits, where=n_bytes > 0)
            values = [
                filed.column(0),
                filed.column(1),
                [len(i) + 1 for i in ids],
                [int(known[i].sum()) + end_known for i in ids],
                [train_tokens] * len(texts),
                [float(logs[i].sum()) - len(i) * smooth + end_log for i in ids],
                score,
                pa.array(bits, pa.float64(), mask=np.isnan(bits)),
            ]
            return _batch(values, SCORES)

        for batch in batches:
            chunks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(chunks) != 0) | (np.diff(kinds) != 0)) + 1
            for low, high in zip([0, *edges], [*edges, batch.num_rows]):
                part = batch.slice(low, high - low)
                if chunks[low] != chunk:
                    chunk, counts, grams, logs, known, model = chunks[low], [], [], None, None, None
                    numbers.clear()
                if kinds[low] == WORDS:
                    counts.append(part.column(3).to_numpy())
                    continue
                if kinds[low] == GRAMS:
                    for own, found in zip(part.column(4).to_pylist(), part.column(5).to_pylist()):
                        keys = _backwards(_unpacked_keys(own), depth)
                        grams.append((keys, _unpacked(found, np.float64)))
                    continue
                all_counts = np.concatenate([*counts, np.zeros(0, np.int64)])
                logs, known, counts = np.log10(all_counts + 1.0), all_counts > 0, []
                model, grams = Lookup(*(np.concatenate(c) for c in zip(*grams))), []
                store, root = open_store(part.column(6)[0].as_py())
                with store.open_input_stream(f"{root}/{part.column(7)[0].as_py()}") as file:
                    for filed in pa.ipc.open_stream(file):
                        yield scored(filed)

    by_chunk = rows.repartition("chunk").sortWithinPartitions("chunk", "kind", "number")
    return by_chunk.mapInArrow(run, SCORES)


def scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 2
) -> DataFrame:
    """The columns of SCORES per row, learned from the rows that are not held out."""
    if not 2 <= depth <= MOST_DEPTH:
        raise ValueError(f"depth must be 2 to {MOST_DEPTH}")
    out = held_out(F.col(id_col))
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), out.alias("out"), F.col(text_col).alias("text")
    )
    # The more text a chunk has, the fewer grams it has for each byte.
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // CHUNK_BYTES))
    rows = _scored(own.coalesce(tasks), depth)
    words, texts = rows.where(F.col("kind") == WORDS), rows.where(F.col("kind") == TEXTS)
    grams = rows.where(F.col("kind") == GRAMS)
    grams = grams.select(F.col("number").alias("tree"), "chunk", "grams", "counts")
    # A word has a row per chunk; one of them stands for it in the totals.
    same = Window.partitionBy("word")
    counted = words.select(
        "chunk",
        "number",
        F.sum("train").over(same).alias("n"),
        (F.row_number().over(same.orderBy("chunk")) == 1).alias("stands"),
    )
    counted = staged(counted, "word-counts", compression="zstd")
    total = counted.where("stands").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0))
    tokens, distinct = total.first()
    ends = texts.agg(F.coalesce(F.sum("train"), F.lit(0))).first()[0]
    names = {"n": "long", "grams": "binary", "logs": "binary", "folder": "string", "name": "string"}

    def padded(part: DataFrame, kind: int) -> DataFrame:
        given = set(part.columns)
        more = [F.col(c) if c in given else F.lit(None).cast(k).alias(c) for c, k in names.items()]
        return part.select("chunk", F.lit(kind).alias("kind"), "number", *more)

    known = padded(answered(grams, train(grams, depth)), GRAMS)
    both = padded(counted, WORDS).unionByName(known).unionByName(padded(texts.drop("grams"), TEXTS))
    return _with_scores(both, depth, tokens + ends, distinct + (ends > 0), ends)
