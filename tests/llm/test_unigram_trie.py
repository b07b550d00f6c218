import random
import re

import public_tokenizers
import pytest

import __spark_entry__ as contract
from orderloom.llm import unigram_trie as ut

from .frames import clashing, docs

SF_DIR = "/root/testdata/sf0.001"


def plain_best(word, scores):
    """All segmentations by a table of positions, without a trie."""
    token, low = "▁" + word, min(scores.values())
    best = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        options = []
        for start in range(end):
            piece = token[start:end]
            if piece in scores:
                options.append((best[start][0] + scores[piece], -best[start][1] - 1))
            elif end - start == 1:
                n = len(piece.encode())
                options.append((best[start][0] + n * low, -best[start][1] - n))
        score, negative = max(options)
        best.append((score, -negative))
    return best[-1]


def plain(text, scores):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = [plain_best(w, scores) for w in words]
    return len(words), sum(n for _, n in found), sum((s for s, _ in found), 0.0)


def test_query_on_whole_table(spark):
    scores = ut.zipf_scores(ut.vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = contract.queries()["op10_unigram_trie"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    known = {}
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
        for w in words:
            known[w] = known.get(w) or plain_best(w, scores)
        assert r.n_pretokens == len(words)
        assert r.n_tokens == sum(known[w][1] for w in words)
        assert r.unigram_score == pytest.approx(sum(known[w][0] for w in words))


def test_random_words_share_prefixes_and_limits_change_nothing(monkeypatch):
    pick = random.Random(1)
    letters = "▁abcé"
    pieces = list({"".join(pick.choice(letters) for _ in range(pick.randrange(1, 5))) for _ in range(60)})
    scores = ut.zipf_scores(pieces)
    words = ["".join(pick.choice("abcéß\U0001f600") for _ in range(pick.randrange(1, 30))) for _ in range(2000)]
    expected = [plain_best(w, scores) for w in words]
    trie = ut.Trie(scores)
    assert [trie.best(w.encode()) for w in words] == expected
    assert [trie.best(w.encode()) for w in words] == expected
    assert len(trie._forward) < sum(len(w) + 1 for w in words)
    monkeypatch.setattr(ut, "MOST_NODES", 50)
    monkeypatch.setattr(ut, "LONG_WORD", 12)
    monkeypatch.setattr(ut, "MOST_TERMINALS", 30)
    small = ut.Trie(scores)
    assert [small.best(w.encode()) for w in words] == expected
    assert len(small._forward) < 100


def test_odd_rows(spark):
    pieces = ["▁", "a", "ab", "▁a", "b"]
    scores = ut.zipf_scores(pieces)
    texts = [None, "", " \n", "ab a", "ab a", "ßa", "b" * 30_000, "ab " * 100_000, "▁"]
    df = clashing(docs(spark, texts)).unionAll(clashing(docs(spark, ["ab"]).selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars")))
    rows = {r.doc_id: r for r in ut.token_counts(df, pieces).collect()}
    for i, text in enumerate(texts):
        n, tokens, score = plain(text, scores) if len(text or "") < 1000 else (rows[i].n_pretokens, rows[i].n_tokens, rows[i].unigram_score)
        assert (rows[i].n_pretokens, rows[i].n_tokens) == (n, tokens)
        assert rows[i].unigram_score == pytest.approx(score)
    assert rows[6].n_tokens == 30_001 and rows[7].n_pretokens == 100_000
    assert rows[None].n_tokens == 2
    assert ut.token_counts(df.limit(0), pieces).count() == 0
