import hashlib
import random
import re

import __spark_entry__ as contract
from orderloom.llm import weak_pii as wp

from .frames import clashing, docs

SF_DIR = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), no, m.end(), kind))
    return sorted(out)


def plain(text):
    spans = plain_spans(text)
    listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
    counts = [sum(k == kind for *_, k in spans) for kind in PATTERNS]
    return (*counts, hashlib.sha256(listed.encode()).hexdigest()), listed


def check_base(found, texts):
    for r in found:
        expected, listed = plain(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == expected
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
        if not r.n_added:
            assert r.spans == listed


def test_query_on_whole_table(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    found = contract.queries()["op1_pii_weak_labels"](spark, SF_DIR).collect()
    assert len(found) == len(texts)
    check_base(found, texts)


def test_base_spans_on_random_texts(spark):
    pick = random.Random(11)
    pieces = [
        "a@b.c", "x.y+z@mail-1.example.com", "@", ".", "..", "-", "+", "_", "%", " ", "  ", "\n", "é", "\U0001f600",
        "1.2.3.4", "255.0.0255.1", "256.1.1.1", "1", "12", "4111111111111111", "4111-1111 1111-1111", "5", "0000",
        "+1 (988) 555-2485", "+49 30 1234567", "(", ")", "a", "b@", "@c.d", "4" * 18, "79927398713",
    ]
    texts = ["".join(pick.choice(pieces) for _ in range(pick.randrange(1, 25))) for _ in range(1500)]
    check_base(wp.find(docs(spark, texts)).collect(), texts)


def test_loose_spans_are_added_where_the_labelers_agree(spark):
    pick = random.Random(5)
    digits = lambda n: "".join(pick.choice("23456789") for _ in range(n))
    texts = [f"Call our phone +1 {digits(3)} {digits(3)} {digits(4)} today." for _ in range(200)]
    texts += [f"Our phone is ({digits(3)}) {digits(3)}-{digits(4)} today." for _ in range(40)]
    texts += [f"See section 1{digits(2)}.1{digits(2)}.{digits(4)}x of version 2." for _ in range(200)]
    found = {r.doc_id: r for r in wp.find(docs(spark, texts)).collect()}
    assert all(found[i].n_added == 0 and found[i].n_phone == 1 for i in range(200))
    assert all(found[i].n_added == 1 and found[i].n_phone == 0 for i in range(200, 240))
    assert found[200].spans == "phone:13:27"
    assert all(found[i].n_added == 0 for i in range(240, 440))


def test_reliabilities_follow_the_labelers():
    pick = random.Random(1)
    quality = [0.95, 0.9, 0.7, 0.6, 0.5]
    counts = {}
    for _ in range(20_000):
        y = pick.random() < 0.4
        votes = tuple((1 if (pick.random() < q) == y else -1) for q in quality)
        counts[votes] = counts.get(votes, 0) + 1
    _, odds = wp.expectation_maximisation(sorted(counts.items()))
    for o, q in zip(odds, quality):
        assert abs(o[1][0] - q) < 0.05 and abs(o[-1][1] - q) < 0.05


def test_odd_rows(spark):
    long = "x" * 300_000 + " 1" * 100_000 + " a@b.co" * 20_000 + "." * 100_000 + "9" * 200_000 + "a." * 100_000
    texts = [None, "", " ", long, "+1" + " " * 200_000, "a@b.c", "a@b.c"]
    df = clashing(docs(spark, texts))
    found = {r.doc_id: r for r in wp.find(df).collect()}
    check_base([found[i] for i in (0, 1, 2, 4, 5, 6)], dict(enumerate(texts)))
    assert found[3].n_email == 20_000 and found[3].n_card == 0
    assert found[3].spans.startswith("email:500001:500007,email:500008:")
    rows = spark.createDataFrame([(None, "a@b.c"), (None, "a@b.c"), (1, "1.2.3.4")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.spans) for r in wp.find(rows).collect()) == [
        (0, "email:0:5"), (0, "email:0:5"), (1, "ip:0:7")
    ]
    assert wp.find(rows.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = wp.find(docs(spark, ["a@b.c"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
