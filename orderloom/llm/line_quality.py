"""Line-first quality cleaning: judge lines, remove the failing ones, reject what loses too much.

Every line of a text is judged by three families of rules:

* punctuation: the line holds no sentence mark (of any script) at the end of a word, or at least a
  third of its words end in a run of symbols;
* navigation: at least a quarter of its words are separators, or it consists of menu words only;
* boilerplate: a line of at most `boilerplate_words` words holds a stock phrase.

A line of several words that only lacks a sentence mark stays if it is part of a wrapped sentence.
Neighbouring lines hang together when the first does not end a sentence and the second goes on: it
begins with no capital letter, or the block of lines is broken at a fixed width and its first word
would not have fitted the first line. Lines that hang together, of which one passes alone, are prose.

Failing lines are removed. A document is kept if it passes the counts of the whole text (enough
words, not mostly repeated windows) and the removed lines hold at most `most_lost` of its
word characters.

Edge cases: a NULL or empty text has no words, counts zero everywhere and is not kept; its cleaned
text is NULL or empty. Lines without a word are never removed. Repeated rows are judged one by one
and stay. Other columns are never looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.dedup import unused

# The rules. They are written so that Python's re and SQL's RE2 read them alike.
SENTENCE_MARK = r"""[.!?…。！？]["'”’»)\]]*([\x20\x09-\x0D]|$)"""
# What ends sentences in other scripts: Armenian, Hebrew, Arabic, Urdu, Syriac, Devanagari, Tibetan,
# Burmese, Ethiopic, Khmer, Mongolian; Greek's question mark; doubled, half- and full-width forms.
MORE_MARKS = "\u0589\u05c3\u061f\u06d4\u0700\u0701\u0702\u0964\u0965\u0f0d\u0f0e\u104b\u1362\u1367\u1368\u17d4\u17d5\u1803\u1809\u037e\u203c\u203d\u2047\u2048\u2049\uff0e\uff61"
SYMBOL_RUN = r"[#*$%&|<>!?~=^]{2,}([\x20\x09-\x0D]|$)"
SEPARATOR_WORD = r"[|»›>·•→/~-]+"
MENU_LINE = (
    r"[\x20\x09-\x0D]*((home|menu|about|contact|login|logout|register|search|sitemap|blog|news"
    r"|next|previous|back|top|share|print|help|faq|more|us|up|in|sign|skip|to|content)"
    r"[.:,]*[\x20\x09-\x0D]*)+"
)
BOILERPLATE = (
    r"all rights reserved|copyright \(c\)|©|cookie policy|privacy policy|terms of (use|service)"
    r"|uses cookies|accept (all )?cookies|enable javascript|javascript is disabled|lorem ipsum"
    r"|click here|read more|subscribe to|sign up for|licensed under|powered by"
)

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_lines long, n_lines_removed long, lost_chars long, base_failed boolean, kept boolean,"
    " cleaned string"
)


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict; the defaults are the production values."""

    least_words: int = 50
    most_repeat_percent: int = 50
    most_lost: float = 0.5
    boilerplate_words: int = 40
    wrapped_words: int = 4


# The marks of every script at the end of a word, and at the end of a line.
ANY_MARK = SENTENCE_MARK.replace("[.", f"[{MORE_MARKS}.", 1)
MARK_AT_END = ANY_MARK.replace(r"([\x20\x09-\x0D]|$)", r"[\x20\x09-\x0D]*$")

_sentence_mark = re.compile(ANY_MARK)
_sentence_end = re.compile(MARK_AT_END)
_symbol_run = re.compile(SYMBOL_RUN)
_separator = re.compile(SEPARATOR_WORD)
_menu = re.compile(MENU_LINE)
_boilerplate = re.compile(BOILERPLATE)
_symbols = re.compile(r"[#*$%&|<>]")
_spaces = re.compile(r"[\x20\x09-\x0D]")
_lower = {c: c + 32 for c in range(65, 91)}


def line_fails(line: str, words: list[str], rules: Rules = Rules()) -> bool:
    """Whether the line fails when it is judged alone."""
    return not _sentence_mark.search(line) or _no_prose(line, words, rules)


def _no_prose(line: str, words: list[str], rules: Rules) -> bool:
    n = len(words)
    if 3 * sum(1 for _ in _symbol_run.finditer(line)) >= n:
        return True
    if 4 * sum(1 for w in words if _separator.fullmatch(w)) >= n:
        return True
    low = line.translate(_lower)
    if n <= rules.boilerplate_words and (_menu.fullmatch(low) or _boilerplate.search(low)):
        return True
    return False


def _at_width(words: list[list[str]]) -> list[bool]:
    """Per line of a block whether it is broken at a fixed width; half of the lines must be."""
    sizes = [len(" ".join(w)) for w in words] or [0]
    full = [n + 1 + len(w[0]) > max(sizes) for n, w in zip(sizes, words[1:])]
    fixed = sum(full) >= max(3, len(full) / 2)
    return [f and fixed for f in full]


def _goes_on(line: str, after: list[str], at_width: bool) -> bool:
    """Whether a line's sentence goes on in the next line, whose words are `after`."""
    if _sentence_end.search(line):
        return False
    start = next((c for c in after[0] if c.isalnum()), "")
    return at_width or bool(start) and not start.isupper()


def lines_fail(lines: list[str], words: list[list[str]], rules: Rules = Rules()) -> list[bool]:
    """For each line of a text whether it fails; lines without a word never do."""
    marked = [bool(_sentence_mark.search(line)) for line in lines]
    prose = [bool(w) and not _no_prose(line, w, rules) for line, w in zip(lines, words)]
    fails = [bool(w) and not (m and p) for w, m, p in zip(words, marked, prose)]
    wrapped = [p and (m or len(w) >= rules.wrapped_words) for w, m, p in zip(words, marked, prose)]
    if all(m or not p for m, p in zip(marked, prose)):
        return fails
    at, n = 0, len(lines)
    while at < n:
        end = at  # a block: neighbouring lines that may be parts of prose
        while end < n and wrapped[end]:
            end += 1
        at_width, low = _at_width(words[at:end]), at
        for i in range(at, end):
            if i + 1 < end and _goes_on(lines[i], words[i + 1], at_width[i - at]):
                continue
            if any(marked[low : i + 1]):
                fails[low : i + 1] = [False] * (i + 1 - low)
            low = i + 1
        at = end + 1
    return fails


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(number) < 1 << 21:
        keys = ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:]
    else:
        _, pairs = np.unique(ids[:-2] * len(number) + ids[1:-1], return_inverse=True)
        keys = pairs * len(number) + ids[2:]
    ordered = np.sort(keys)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    hit = np.isin(keys, again)
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(hit)] |= hit
    return int(covered.sum())


def measure(text: str | None, rules: Rules = Rules()) -> tuple:
    """The columns of MEASURES for one text."""
    whole = text or ""
    words = whole.encode("utf-8", "surrogatepass").split()
    word_chars = len(_spaces.sub("", whole))
    symbols = sum(1 for _ in _symbols.finditer(whole))
    repeats = repeated_words(words)
    seen: set[str] = set()
    good, lines, dups, removed, lost = [], 0, 0, 0, 0
    split = whole.split("\n")
    words_of = [[w for w in _spaces.split(line) if w] for line in split]
    for line, tokens, fails in zip(split, words_of, lines_fail(split, words_of, rules)):
        if not tokens:
            good.append(line)
            continue
        lines += 1
        dups += line in seen
        seen.add(line)
        if fails:
            removed += 1
            lost += sum(map(len, tokens))
        else:
            good.append(line)
    n = len(words)
    failed = n < rules.least_words or 100 * repeats > rules.most_repeat_percent * n
    kept = not failed and lost <= rules.most_lost * word_chars
    cleaned = None if text is None else "\n".join(good)
    return n, word_chars, symbols, dups, repeats, lines, removed, lost, failed, kept, cleaned


def measures(text: Column, rules: Rules = Rules(), with_cleaned: bool = True) -> Column:
    """A struct of MEASURES for a text column."""
    kind = MEASURES if with_cleaned else MEASURES.removesuffix(", cleaned string")
    names = [part.split()[0] for part in kind.split(",")]

    @F.pandas_udf(kind)
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = [measure(t, rules)[: len(names)] for t in texts]
        return pd.DataFrame(rows, columns=names)

    # Else a filter on a part of the struct would be pushed down with a second evaluation.
    return of.asNondeterministic()(text)


def judged(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()
) -> DataFrame:
    """One row per input row: the id as `doc_id` and every measure, the cleaned text included."""
    own = docs.select(
        F.col(id_col).alias("doc_id"), measures(F.col(text_col), rules).alias("m")
    )
    return own.select("doc_id", "m.*")


def kept(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of `docs` whose text passes, all columns and texts as they were."""
    return docs.where(measures(docs[text_col], rules, with_cleaned=False)["kept"])


def cleaned(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The passing rows, with the failing lines removed from `text_col`."""
    name = unused("_measures", docs.columns)
    judged = docs.withColumn(name, measures(docs[text_col], rules)).where(F.col(name)["kept"])
    return judged.withColumn(text_col, F.col(name)["cleaned"]).select(*docs.columns)
