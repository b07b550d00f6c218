"""Each stage against a brute-force version on what the stage before kept."""

import random

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import line_quality
from orderloom.llm.common import staged, table

from .frames import clashing, docs
from .test_curriculum import plain_targets
from .test_decontaminate import plain as plain_hits
from .test_records import plain_tokens
from .test_simhash import plain_components, plain_fingerprint

SF_DIR = "/root/testdata/sf0.001"
assert public_tokenizers


def stages(spark, df):
    out = [df]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SF_DIR), "test"))
    return out


def test_stages_equal_brute_force(spark):
    start = table(spark, SF_DIR, "documents")
    raw, clean, single, fresh, mix, last = stages(spark, start)
    for df in (clean, single, fresh, mix):
        assert df.columns == start.columns
    expected = {}
    for r in raw.collect():
        m = line_quality.measure(r.text)
        if m[9]:
            expected[r.doc_id] = m[10]
    rows = clean.collect()
    assert {r.doc_id: r.text for r in rows} == expected and len(rows) == len(expected)
    assert all(r.n_chars == len(r.text) for r in rows)

    ids = [r.doc_id for r in rows]
    parts = plain_components(ids, [plain_fingerprint(r.text) for r in rows])
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(parts))

    rows = single.collect()
    items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    hits = plain_hits([r.text for r in rows], items)
    clear = [r.doc_id for r, h in zip(rows, hits) if not h[4]]
    assert len(clear) < len(rows)
    rows = fresh.collect()
    assert sorted(r.doc_id for r in rows) == sorted(clear)

    size = {r.doc_id: len(r.text.encode().split()) for r in rows}
    sources = sorted({r.source for r in rows})
    own = {s: [r.doc_id for r in rows if r.source == s] for s in sources}
    totals = [sum(size[d] for d in own[s]) for s in sources]
    taken = mix.collect()
    texts = {r.doc_id: r.text for r in rows}
    assert all(r.text == texts[r.doc_id] for r in taken)
    for s, target in zip(sources, plain_targets(totals)):
        words = sum(size[r.doc_id] for r in taken if r.source == s)
        assert abs(words - target) <= max(size[d] for d in own[s]) / 2

    pairs = [(r.doc_id, r.text) for r in taken]
    assert sorted(map(tuple, last.collect())) == plain_tokens(pairs)


def test_run_gives_the_last_stage(spark):
    again = corpus_pipeline.run(spark, SF_DIR)
    last = stages(spark, table(spark, SF_DIR, "documents"))[-1]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, last.collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_rows_pass_all_stages(spark):
    pick = random.Random(8)
    prose = lambda n: "".join(f"Then w{pick.randrange(9**9)} met w{pick.randrange(9**9)}. " for _ in range(n))
    same = prose(40)
    texts = [None, "", " \n", prose(30), same, same, prose(60_000), "| x | y |\n" * 60]
    df = clashing(docs(spark, texts, [None, "a", None, None, "a", "b", "c", "c"]))
    df = df.unionAll(df.where("doc_id = 5")).unionAll(df.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    out = stages(spark, df)
    assert [sorted({r.doc_id for r in x.collect()}, key=repr) for x in out[1:4]] == [
        [3, 4, 5, 6, None], [3, 4, 6], [3, 4, 6]
    ]
    assert out[4].columns == df.columns
    assert {r.doc_id for r in out[5].collect()} <= {3, 4, 6}
    assert [x.count() for x in stages(spark, df.limit(0))] == [0] * 6
