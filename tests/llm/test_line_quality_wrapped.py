import random
import textwrap

import duckdb
import pandas as pd
import pytest

from orderloom.llm import line_quality as lq
from orderloom.llm import oracle

from .frames import docs

STORY = " ".join(
    f"When the {a} came to the old town of Northfield, Anna Smith wrote a long letter about the {b}"
    f" and the people of {c} kept it for many years after that."
    for a, b, c in zip("abcdefgh", "ijklmnop", "QRSTUVWX")
)


@pytest.mark.parametrize("mark", "।؟۔።։។။")
def test_marks_of_other_scripts_end_sentences(mark):
    line = f"aaa bbb ccc{mark}"
    assert not lq.line_fails(line, line.split())


def test_wrapped_prose_stays_whole(spark):
    texts = ["\n".join(textwrap.wrap(STORY, width)) for width in (40, 72)]
    lines = texts[1].split("\n")
    assert any(lq.line_fails(line, line.split()) for line in lines)
    got = {r.doc_id: r.cleaned for r in lq.judged(docs(spark, texts)).collect()}
    assert got == dict(enumerate(texts))


def test_headings_menus_and_lists_next_to_prose_still_go():
    prose = "The report was read by the board and kept.\nIt was long, and all of them liked it."
    for other in (
        "An introduction to the report",
        "home about contact login",
        "shop | item | cart | more",
        "red apples from the south\ngreen pears from the north",
        "and so on",
    ):
        assert lq.measure(f"{prose}\n\n{other}\n\n{prose}")[10] == f"{prose}\n\n\n{prose}"
        assert lq.measure(f"{prose}\n{other}\n{prose}")[10] == f"{prose}\n{prose}"


def by_sql(texts):
    db = duckdb.connect()
    db.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    names = [part.split()[0] for part in lq.MEASURES.split(",")][:-1]
    found = db.execute(f"SELECT {', '.join(names)} FROM ({oracle.LINE_QUALITY}) ORDER BY doc_id").fetchall()
    return found


def test_the_sql_has_the_rules_for_wrapped_lines_and_other_scripts():
    wrapped = ["\n".join(textwrap.wrap(STORY, width)) for width in (40, 60, 72, 100)]
    # A rule that looks for the Latin marks alone, line by line, removes most of these.
    latin = [line for text in wrapped for line in text.split("\n") if not lq._sentence_mark.search(line)]
    assert len(latin) > 20
    other = [STORY.replace(".", mark).replace(f"{mark} ", f"{mark}\n") for mark in "।؟۔።"]
    got = by_sql([*wrapped, *other])
    assert got == [lq.measure(t)[:-1] for t in [*wrapped, *other]]
    assert all(row[6] == row[7] == 0 for row in got)


def test_the_sql_equals_the_code_on_mixed_lines():
    pick = random.Random(5)
    pool = [
        "The report was read by the board", "and kept for many years.", "It was long", "home about contact login",
        "shop | item | cart | more", "", "  ", "Ⅷ was the number of it all", "(and so on with it", "«Était-ce vrai? non",
        "— 12 of them were lost at sea", "!!! *** ### !!!", "All rights reserved by them all.", "x", "ends here.\r",
        "wahr ist es nicht। aber", "one two three four five six seven", "Ends with quote.”  ", "ﬁnal words of it all go",
    ]
    texts = ["\n".join(pick.choice(pool) for _ in range(pick.randint(0, 14))) for _ in range(1500)]
    texts += ["\n".join(textwrap.wrap(" ".join(pick.choice(pool) for _ in range(30)), pick.randint(20, 60))) for _ in range(300)]
    rules = [lq.measure(t)[:-1] for t in texts]
    assert by_sql(texts) == rules
    assert len({row[6] for row in rules}) > 5
