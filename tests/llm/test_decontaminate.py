import hashlib
import random
import re

from orderloom.llm import decontaminate as de

from .frames import clashing, docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(texts, items):
    """Every window of every item tried at every place."""
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(10, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= set() if item is None else {str(item)}
        names = ",".join(sorted(found))
        digest = hashlib.sha256(names.encode()).hexdigest()
        out.append((len(w), len(hit), len(found), digest, bool(hit)))
    return out


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_random_texts_equal_brute_force(spark):
    pick = random.Random(9)
    sea = [f"{c}{n}" for c in "abcdé" for n in range(4)]
    prose = lambda n: "".join(pick.choice(sea) + pick.choice([" ", ", ", "\n", " - "]) for _ in range(n))
    items = [(i, prose(pick.randrange(10, 40))) for i in range(12)]
    items += [(12, "Ab c1"), (13, "a1"), (14, None), (15, ""), (None, items[0][1]), (3, items[3][1]), (100, items[4][1].upper())]
    texts = [None, "", "!!!", "x", prose(5)]
    for _ in range(60):
        passage = re.split(r"(?<= )", pick.choice(items[:12])[1])
        cut = "".join(passage[pick.randrange(5) : pick.randrange(12, 30)])
        texts.append(prose(pick.randrange(40)) + " " + cut + " " + prose(pick.randrange(40)))
    texts += [texts[6].upper(), texts[7] * 3, "filler " * 60_000 + items[1][1]]
    df = clashing(docs(spark, texts))
    got = {r.doc_id: tuple(r)[1:6] for r in de.contamination(df, bench(spark, items)).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, items)
    contaminated = {i for i, r in enumerate(plain(texts, items)) if r[4]}
    left = de.without_documents(df, bench(spark, items))
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == set(range(len(texts))) - contaminated


def test_spans_are_cut(spark):
    item = "one two three four five six seven eight nine ten eleven"
    texts = [f"Before it, {item.title()}! After it.", f"({item}", "clean text", None, f"{item} {item}"]
    df = clashing(docs(spark, texts))
    out = de.without_spans(df, bench(spark, [(1, item)]))
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        0: "Before it, After it.", 1: "(", 2: "clean text", 3: None, 4: ""
    }


def test_repeats_nulls_and_empty_tables(spark):
    item = "a b c d e f g h i j k"
    rows = [(1, item), (1, item), (1, "clean"), (None, item), (None, "clean")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = bench(spark, [(5, item), (5, item)])
    got = sorted(((r.doc_id, r.n_hit) for r in de.contamination(df, items).collect()), key=repr)
    assert got == sorted([(1, 11), (1, 11), (1, 0), (None, 11), (None, 0)], key=repr)
    assert sorted(map(tuple, de.without_documents(df, items).collect()), key=repr) == [(1, "clean"), (None, "clean")]
    assert {r.n_hit for r in de.contamination(df, items.limit(0)).collect()} == {0}
    assert de.without_documents(df, items.limit(0)).count() == 5
    assert de.contamination(df.limit(0), items).count() == 0


def test_limits_do_not_change_the_result(spark, monkeypatch):
    pick = random.Random(1)
    items = [(i, " ".join(pick.choice("abcd") for _ in range(30))) for i in range(20)]
    texts = [" ".join(pick.choice("abcd") for _ in range(60)) + " " + items[i % 20][1] for i in range(40)]
    monkeypatch.setattr(de, "MOST_BITS", 1 << 12)
    monkeypatch.setattr(de, "MOST_BROADCAST", 1)
    got = {r.doc_id: tuple(r)[1:6] for r in de.contamination(docs(spark, texts), bench(spark, items)).collect()}
    assert [got[i] for i in range(40)] == plain(texts, items)
