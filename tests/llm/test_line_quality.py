import random
import re
from collections import Counter

import pytest

import __spark_entry__ as contract
from orderloom.llm import line_quality as lq

from .frames import clashing, docs

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "The report was read by the board. It was kept for the next year, as before.\n"


def plain_counts(text):
    """The whole-text counts by their definitions, word by word."""
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    dups = sum(line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dups, len(covered), failed


def test_counts_equal_their_definitions_on_random_texts():
    pick = random.Random(7)
    for _ in range(300):
        alphabet = pick.choice(["ab ", "abc \n", "é# \t\n|.", "\x0b\x0c\r a\n", " x y "])
        text = "".join(pick.choice(alphabet) for _ in range(pick.randrange(400)))
        m = lq.measure(text)
        assert (*m[:5], m[8]) == plain_counts(text)


def test_query_on_whole_table(spark):
    rows = contract.queries()["op2_line_quality"](spark, SF_DIR).collect()
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    for r in rows:
        got = r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed
        assert got == plain_counts(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("The report was read by the board.", False),
        ('He said: "It is done."', False),
        ("Home | About | Contact | Login.", True),
        ("home about contact.", True),
        ("no sentence mark here", True),
        ("WIN!! NOW!! CALL!! US!!", True),
        ("All rights reserved.", True),
        ("Ça va? Oui", False),
    ],
)
def test_line_rules(line, fails):
    assert lq.line_fails(line, line.split()) is fails


def test_failing_lines_go_and_documents_losing_too_much_go(spark):
    prose = "".join(f"Report{i} came{i} here{i}, year{i} for a{i} b{i} c{i} d{i}.\n" for i in range(8))
    menu = "Home | About | Login | Blog\n"
    good, bad = menu + prose, "".join(f"shop{i} | item{i} | cart{i}\n" for i in range(40)) + prose
    df = clashing(docs(spark, [good, bad, prose, prose]))
    got = {r.doc_id: r.text for r in lq.cleaned(df).collect()}
    assert got == {0: prose, 2: prose, 3: prose}
    assert lq.kept(df).columns == df.columns
    assert {r.doc_id: r.text for r in lq.kept(df).collect()} == {0: good, 2: prose, 3: prose}


def test_odd_rows(spark):
    long = "".join(f"Word{i} is number {i}. " for i in range(200_000))
    texts = [None, "", " \n\t", long, "\n" * 10]
    rows = {r.doc_id: r for r in lq.judged(docs(spark, texts)).collect()}
    assert [rows[i].kept for i in range(5)] == [False, False, False, True, False]
    assert [rows[i].n_words for i in (0, 1, 2, 4)] == [0] * 4
    assert rows[0].cleaned is None and rows[2].cleaned == " \n\t"
    assert rows[3].n_words == 800_000 and rows[3].cleaned == long
    same = docs(spark, [PROSE * 2]).unionAll(docs(spark, [PROSE * 2]))
    assert lq.judged(same).count() == 2
    no_id = same.selectExpr("cast(null as long) doc_id", "text")
    assert [r.doc_id for r in lq.judged(no_id).collect()] == [None, None]
    assert lq.judged(same.limit(0)).count() == lq.kept(same.limit(0)).count() == 0
