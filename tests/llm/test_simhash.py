import random
import re
from collections import Counter

import numpy as np
import xxhash

import __spark_entry__ as contract
from orderloom.llm import components as cc
from orderloom.llm import simhash as sh

from .frames import clashing, docs

SF_DIR = "/root/testdata/sf0.001"
ALPHABET = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ALPHABET))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(ids, prints):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[root(i)] = min(x, least.get(root(i), x))
    return [least.get(root(i)) for i in range(len(ids))]


def check(found, ids, texts):
    prints = [plain_fingerprint(t) for t in texts]
    expected = zip(ids, [f"{p:016x}" for p in prints], plain_components(ids, prints))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_query_on_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = contract.queries()["op6_simhash"](spark, SF_DIR)
    check(found, [r.doc_id for r in rows], [r.text for r in rows])


def test_near_copies_ties_nulls_and_repeats(spark):
    pick = random.Random(3)
    base = [f"word{pick.randrange(500)}" for _ in range(1500)]
    texts = [None, "", "  \n", "One Two", "one two", "a"]
    for _ in range(60):
        copy = list(base)
        copy[pick.randrange(len(copy))] = "other"
        texts.append(" ".join(copy))
    texts += texts[:10] + ["X" * 100_000, "wide " * 70_000]
    df = clashing(docs(spark, texts))
    check(sh.near_duplicates(df), list(range(len(texts))), texts)
    kept = sh.one_per_group(df)
    assert kept.columns == df.columns
    prints = [plain_fingerprint(t) for t in texts]
    parts = plain_components(range(len(texts)), prints)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(parts))


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (4, "x y z"), (4, "x y z"), (4, "p q r s"), (2, "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(sh.near_duplicates(df), [r[0] for r in rows], [r[1] for r in rows])
    kept = sorted(map(tuple, sh.one_per_group(df).collect()), key=repr)
    assert kept == [(2, "x y z"), (4, "p q r s"), (None, "a b c d")]
    assert sh.near_duplicates(df.limit(0)).count() == sh.one_per_group(df.limit(0)).count() == 0


def test_links_connect_exactly_what_two_bits_connect(spark):
    """Dense clusters, in which one list holds many members."""
    pick = random.Random(5)
    prints = set()
    for _ in range(6):
        center, loose = pick.getrandbits(64), pick.sample(range(64), 9)
        for _ in range(120):
            prints.add(center ^ sum(1 << b for b in loose if pick.random() < 0.5))
    prints = sorted(prints)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    found = sh.links(df).collect()
    unsigned = [(a % 2**64, b % 2**64) for a, b in found]
    assert all((a ^ b).bit_count() <= 2 for a, b in unsigned)
    roots = {r.vertex: r.root for r in cc.components(sh.links(df)).collect()}
    parts = plain_components(range(len(prints)), prints)
    joined = Counter(zip((roots.get(s, s) for s in signed), parts))
    assert len(joined) == len(set(parts)) == len({a for a, _ in joined})


def test_components_of_long_chains_and_stars(spark):
    chain = [(i + 1, i) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1200)]
    odd = [(5, 5), (None, 3), (3, None), (7, 1000), (1000, 7)]
    df = spark.createDataFrame(chain + star + odd, "a long, b long")
    got = dict(map(tuple, cc.components(df).collect()))
    expected = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(1000, 1200)]}
    assert got == expected
    assert cc.components(df.limit(0)).count() == 0


def clustered(pick, members):
    """Fingerprints around a few centers, up to nine bits from theirs, and some far from all."""
    prints = {pick.getrandbits(64) for _ in range(200)}
    for _ in range(6):
        center, loose = pick.getrandbits(64), pick.sample(range(64), 9)
        prints |= {center ^ sum(1 << b for b in loose if pick.random() < 0.5) for _ in range(members)}
    return sorted(prints)


def test_the_count_filter_drops_pairs_and_no_near_one(spark):
    pick = random.Random(8)
    prints = np.array(clustered(pick, 40), dtype=np.uint64)
    shared = np.array([[sum((int(a ^ b) >> 8 * i) & 255 == 0 for i in range(8)) for b in prints] for a in prints])
    near = {(a, b) for a in range(len(prints)) for b in range(a) if int(prints[a] ^ prints[b]).bit_count() <= 2}
    met, met_near, reached = set(), set(), 0
    for number in range(len(sh.LISTED)):
        keys = [tuple(int(p) >> 8 * (7 - i) & 255 for i in sh.LISTED[number]) for p in prints]
        order = sorted(range(len(prints)), key=lambda i: keys[i])
        lists = np.unique([keys[i] for i in order], axis=0, return_inverse=True)[1].astype(np.int64).ravel()
        members = prints[order].view(np.int64)
        found, counts = sh.tallied(lists, members)
        pairs = {(max(order[x], order[y]), min(order[x], order[y])) for xs, ys in sh._pairs(lists) for x, y in zip(xs, ys)}
        assert counts[0] == len(pairs) and counts[1] == sum(shared[p] >= 6 for p in pairs)
        met |= pairs
        reached += counts[1]
        met_near |= {(max(order[x], order[y]), min(order[x], order[y])) for xs, ys in found for x, y in zip(xs, ys)}
    assert met_near == near
    assert sum(shared[p] < 6 for p in met) > 100
    signed = prints.view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.crowded: r for r in sh.filter_counts(df).collect()}
    assert got[False].met > got[False].reached >= got[False].near > 0


def test_long_lists_are_cut_and_lose_no_link(spark):
    pick = random.Random(9)
    prints = clustered(pick, 300)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(5)
    sizes = sh.postings(df, sh.LISTED).groupBy("list").count().agg({"count": "max"}).first()[0]
    assert sizes > sh.LONG
    assert {r.crowded: r.near for r in sh.filter_counts(df).collect()}[True] > 0
    roots = {r.vertex: r.root for r in cc.components(sh.links(df)).collect()}
    parts = plain_components(range(len(prints)), prints)
    joined = set(zip((roots.get(s, s) for s in signed), parts))
    assert len(joined) == len(set(parts)) == len({a for a, _ in joined})
