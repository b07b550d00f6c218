import math
import random

import numpy as np
import pytest

from orderloom.llm import context_tree as ct
from orderloom.llm import queries

from .frames import docs
from .test_context_tree import LOWER, PlainTree, is_out


class DeepTree(PlainTree):
    """The recursion over contexts of any length."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.memo = depth, {}, {}
        for t in texts:
            data = self.coded(t)
            for i in range(depth, len(data)):
                for length in range(depth + 1):
                    for node, bit in self.path(data[i]):
                        self.counts.setdefault((data[i - length : i], node), [0, 0])[bit] += 1

    def coded(self, text):
        return b"\xff" * self.depth + (text or "").translate(LOWER).encode() + b"\xff"

    def weighted(self, key):
        if len(key[0]) == self.depth:
            return self.own(key)
        a, b = self.own(key), self.deeper(key)
        return max(a, b) + math.log1p(math.exp(-abs(a - b))) + math.log(0.5)

    def p(self, context, node, bit, depth=0):
        key = (context[len(context) - depth :], node)
        a, b = self.counts.get(key, (0, 0))
        own = ((b if bit else a) + 0.5) / (a + b + 1)
        if depth == self.depth:
            return own
        share = 1 / (1 + math.exp(min(self.deeper(key) - self.own(key), 700)))
        return share * own + (1 - share) * self.p(context, node, bit, depth + 1)

    def score(self, text):
        data, d = self.coded(text), self.depth
        return sum(
            math.log10(self.p(data[i - d : i], node, bit))
            for i in range(d, len(data))
            for node, bit in self.path(data[i])
        )


@pytest.mark.parametrize("depth", [3, 6, 7])
def test_deep_trees_equal_the_recursion(spark, monkeypatch, depth):
    pick = random.Random(depth)
    texts = [None, "", "A", "aA é", "ÿ\x00"] + [
        "".join(pick.choice("ab ") for _ in range(pick.randrange(60))) for _ in range(40)
    ]
    monkeypatch.setattr(ct, "CHUNK_GRAMS", 30)
    monkeypatch.setattr(ct, "TREE_GRAMS", 20)
    monkeypatch.setattr(ct, "BYTES_AT_ONCE", 101)
    tree = DeepTree([t for i, t in enumerate(texts) if not is_out(i)], depth)
    found = ct.scores(docs(spark, texts), depth=depth).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(texts)))
    for r in found:
        assert r.score == pytest.approx(tree.score(texts[r.doc_id]), rel=1e-9)


def test_contexts_beyond_two_bytes_are_learned(spark):
    # After "xx" the next byte is settled by the byte before it, three bytes back.
    pick = random.Random(5)
    texts = ["".join(pick.choice(["axxb", "cxxd"]) for _ in range(100)) for _ in range(60)]
    assert queries.TREE_DEPTH > 2
    mean = {
        depth: np.mean([r.bits_per_byte for r in ct.scores(docs(spark, texts), depth=depth).collect()])
        for depth in (2, queries.TREE_DEPTH)
    }
    assert mean[queries.TREE_DEPTH] < 0.35 < 0.45 < mean[2]


def test_large_counts_are_not_looked_up():
    counts = np.array([0, 1, 65_535, 65_536, 10**9])
    assert np.allclose(ct.log_kt_counts(counts, counts[::-1]), ct.log_kt(counts, counts[::-1]))


def test_a_chunk_stages_a_packed_row_per_subtree(spark):
    pick = random.Random(11)
    texts = ["".join(pick.choice("abcdefg ") for _ in range(3000)) for _ in range(40)]
    own = docs(spark, texts).coalesce(1).selectExpr("cast(doc_id as long)", "doc_id % 7 = 2 AS out", "text")
    rows = ct._scored(own, 6).where(f"kind = {ct.GRAMS}").collect()
    closed = [b"\xff" * 6 + t.encode() + b"\xff" for t in texts]
    expected = {}
    for i, data in enumerate(closed):
        for at in range(6, len(data)):
            tree = data[at - 1] << 8 | data[at - 2]
            key = int.from_bytes(data[at - 6 : at][::-1] + data[at : at + 1])
            grams = expected.setdefault(tree, {})
            grams[key] = grams.get(key, 0) + (i % 7 != 2)
    found = {
        r.number: dict(zip(ct._unpacked_keys(r.grams).tolist(), ct._unpacked(r.counts, np.int64).tolist())) for r in rows
    }
    assert len(rows) == len(expected) and found == expected
    # A gram takes a few bytes, not a row.
    assert sum(len(r.grams) + len(r.counts) for r in rows) < 5 * sum(map(len, expected.values()))


def test_packed_values_come_back():
    keys = np.array([0, 3, 2**40, 2**64 - 1], np.uint64)
    for some in (keys, keys[:0]):
        assert ct._unpacked_keys(ct._packed_keys(some)).tolist() == some.tolist()
    logs = np.array([-0.25, -1e-300, -np.inf, 0.0])
    assert ct._unpacked(ct._packed(logs), np.float64).tolist() == logs.tolist()
