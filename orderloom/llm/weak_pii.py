"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a classifier decides.

Candidates are the spans of eight patterns: a strict and a loose one for each kind. The valid matches
of the strict patterns are the base; they stay whatever the model says. The loose ones (obfuscated
mail addresses, phone numbers without a country code, cards with unusual separators, IPv6) are
added where they touch no base span and the trained classifier is sure.

Five labelers vote for, against, or not at all on every candidate: the strict regex, a checksum or
shape test, a gazetteer (top-level domains, issuer digits, area codes, reserved ranges), words of the
context, and what adjoins the span. Votes of all documents are counted by kind and pattern of votes,
at most 4 x 2 x 3^5 rows; on that table expectation-maximisation estimates each labeler's reliability
per kind and the posterior of each pattern, and a logistic classifier per kind is fitted to the
posteriors. Its coefficients go back into the plan as literals. Everything that touches documents
is DataFrame code.

Offsets are code points, ends exclusive. A match's place follows from the lengths of the pieces
between matches, summed by a window over the matches of one text, so long texts stay linear. The
strict patterns are the stated ones with possessive repeats and anchored starts, which match the
same spans without backtracking.

Edge cases: NULL and empty texts have no spans. Repeated rows and NULL ids are rows of their own. An
empty table gives no rows. Other columns are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, fsum, log

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import ascii_lower, staged

KINDS = ("email", "ip", "card", "phone")
LEFT, RIGHT = 40, 10
LABELERS = ("regex", "shape", "gazetteer", "context", "border")
SURE = 0.95
EM_ROUNDS = 60

# The patterns. `\G` lets a match begin where the one before it ended.
_LOCAL = "[A-Za-z0-9._%+-]"
_DOMAIN = "[A-Za-z0-9-]"
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}\x20?[(\[{{]at[)\]}}]\x20?{_DOMAIN}{{1,63}}"
    rf"(?:\x20?(?:[(\[{{]dot[)\]}}]|\.)\x20?{_DOMAIN}{{1,63}}){{1,8}}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
# A text without this cannot match, which spares most texts the regex.
NEEDS = {
    ("email", True): r"@",
    ("ip", True): r"[0-9]\.[0-9]",
    ("card", True): r"[0-9][\x20-]?[0-9][\x20-]?[0-9]",
    ("phone", True): r"\+[0-9]",
    ("email", False): r"[(\[{]at[)\]}]",
    ("ip", False): r"[0-9A-Fa-f]:[0-9A-Fa-f]",
    ("card", False): r"[0-9]{4}[./_][0-9]{4}",
    ("phone", False): r"[0-9]{3}[\x20.-][0-9]{4}",
}
# Gazetteers and context words.
TOP_LEVEL = "com|org|net|edu|gov|mil|int|info|biz|io|de|fr|es|uk|it|nl|eu|us|ca|br|mx|ru|cn|jp|in|au|ch|at|pl"
FOR = {
    "email": r"e-?mail|mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|client|login|adresse",
    "card": r"card|visa|master|amex|credit|karte|carte|tarjeta|payment",
    "phone": r"phone|tel\b|telefon|call|fax|mobile|cell|whatsapp|rufnummer|llame",
}
AGAINST = r"version|isbn|issn|invoice|order no|serial|section|chapter|figure|ticket|\bsku\b|\bdoi\b|part no"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when((n - i) % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    """The stated tests of a strict match."""
    digits = _digits(match)
    n = F.length(digits)

    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    card = F.when((n >= 14) & (n <= 19), luhn(digits)).otherwise(False)
    return (
        F.when(kind == "ip", F.forall(F.split(match, r"\."), small))
        .when(kind == "card", card)
        .when(kind == "phone", (n >= 10) & (n <= 15))
        .otherwise(True)
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, 1).when(bad, -1).otherwise(0)


def _votes(kind: Column, strict: Column, valid: Column, match: Column, left: Column, right: Column):
    """One vote of each labeler, in their order."""
    low, digits = ascii_lower(match), _digits(match)
    top = F.regexp_extract(low, r"([a-z0-9-]+)[)\]}]?$", 1)
    shape = (
        F.when(kind == "email", top.rlike("^[a-z]{2,24}$"))
        .when(kind == "card", F.when(F.length(digits) <= 19, luhn(digits)).otherwise(False))
        .when(kind == "ip", F.when(strict, valid).otherwise(True))
        .otherwise((F.length(digits) >= 10) & (F.length(digits) <= 15))
    )
    local = F.regexp_replace(digits, "^1(?=[0-9]{10}$)", "")
    known = (
        F.when(kind == "email", top.rlike(f"^({TOP_LEVEL})$"))
        .when(kind == "card", digits.rlike("^[3-6]"))
        .when(kind == "ip", ~low.rlike(r"^(0|127|255|224)\.|^0*:"))
        .otherwise(local.rlike("^[2-9][0-9]{2}[2-9]") | (F.length(local) != 10))
    )
    unknown = F.when(kind == "email", F.lit(False)).otherwise(~known)
    words = ascii_lower(left)
    near = F.lit(False)
    for name, pattern in FOR.items():
        near = F.when(kind == name, words.rlike(pattern)).otherwise(near)
    free = ~left.rlike(r"[A-Za-z0-9#$%*_=/]$") & ~right.rlike(r"^[A-Za-z0-9#$%*_=/@]")
    return [
        _vote(strict & valid, strict & ~valid),
        _vote(shape, ~shape),
        _vote(known, unknown),
        _vote(near & ~words.rlike(AGAINST), words.rlike(AGAINST)),
        _vote(free, ~free),
    ]


def candidates(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): a numbered row per input row, and a row per candidate span."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    patterns = [(k, s, (STRICT if s else LOOSE)[k]) for k in KINDS for s in (True, False)]
    own = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
    )
    cut = []
    for i, (kind, strict, pattern) in enumerate(patterns):
        may = F.col("text").rlike(NEEDS[kind, strict])
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        cut.append(F.when(may, found).alias(f"m{i}"))
        cut.append(F.when(may, F.split("text", pattern, -1)).alias(f"p{i}"))
    pieces = own.select("row", "doc_id", *cut)

    def entries(i: int, kind: str, strict: bool) -> Column:
        def entry(n: Column) -> Column:
            piece = F.get(f"p{i}", n)
            return F.struct(
                F.lit(kind).alias("kind"),
                F.lit(strict).alias("strict"),
                n.alias("n"),
                F.length(piece).alias("before"),
                F.right(piece, F.lit(LEFT)).alias("left"),
                F.get(f"m{i}", n).alias("match"),
                F.left(F.get(f"p{i}", n + 1), F.lit(RIGHT)).alias("right"),
            )

        some = F.sequence(F.lit(0), F.size(f"m{i}") - 1)
        none = F.array().cast("array<int>")
        return F.transform(F.when(F.size(f"m{i}") > 0, some).otherwise(none), entry)

    all_entries = [entries(i, kind, strict) for i, (kind, strict, _) in enumerate(patterns)]
    cached = staged(pieces.select("row", "doc_id", F.concat(*all_entries).alias("found")), "spans")
    each = cached.select("row", F.inline("found"))
    earlier = Window.partitionBy("row", "kind", "strict").orderBy("n")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("match")
    end = F.sum(F.col("before") + size).over(earlier)
    spans = each.withColumn("end", end).withColumn("start", F.col("end") - size)
    spans = spans.withColumn("valid", F.col("strict") & _valid(F.col("kind"), F.col("match")))
    names = ("kind", "strict", "valid", "match", "left", "right")
    votes = F.array(*_votes(*[F.col(c) for c in names]))
    kept = ["row", "kind", "strict", "valid", "start", "end"]
    return cached.select("row", "doc_id"), staged(spans.select(*kept, votes.alias("votes")), "votes")


# ---- the model, on the table of vote patterns ---------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Per kind: each labeler's odds of its votes under both classes, and the classifier."""

    reliabilities: dict[str, list[dict[int, tuple[float, float]]]]
    weights: dict[str, list[float]]

    def score(self, kind: Column, strict: Column, votes: Column) -> Column:
        """The classifier's probability that a span is personal data."""
        p = F.lit(0.0)
        for name, (bias, loose, *by_vote) in self.weights.items():
            z = F.lit(bias) + F.when(strict, 0.0).otherwise(loose)
            for i, w in enumerate(by_vote):
                z = z + F.lit(w) * F.get(votes, F.lit(i))
            p = F.when(kind == name, 1 / (1 + F.exp(-z))).otherwise(p)
        return p


def _sigmoid(z: float) -> float:
    return 1 / (1 + exp(-max(-30.0, min(30.0, z))))


def expectation_maximisation(patterns: list[tuple], rounds: int = EM_ROUNDS) -> tuple:
    """Posteriors of vote patterns (votes, n), and P(vote | class) per labeler, of one kind.

    Votes start as equally good; the start decides which class is which. Every probability is
    smoothed by one row.
    """
    total = fsum(n for _, n in patterns)
    posterior = [_sigmoid(1.0 * sum(votes)) for votes, _ in patterns]
    odds: list[dict[int, tuple[float, float]]] = []
    for _ in range(rounds):
        yes = fsum(p * n for p, (_, n) in zip(posterior, patterns))
        prior = (yes + 1) / (total + 2)
        odds = []
        for j in range(len(LABELERS)):
            by_vote = {}
            for v in (-1, 0, 1):
                rows = [(p, n) for p, (votes, n) in zip(posterior, patterns) if votes[j] == v]
                good, bad = fsum(p * n for p, n in rows), fsum((1 - p) * n for p, n in rows)
                by_vote[v] = ((good + 1) / (yes + 3), (bad + 1) / (total - yes + 3))
            odds.append(by_vote)
        start = log(prior / (1 - prior))
        posterior = [
            _sigmoid(start + fsum(log(o[v][0] / o[v][1]) for o, v in zip(odds, votes)))
            for votes, _ in patterns
        ]
    return posterior, odds


def logistic(features: np.ndarray, soft: np.ndarray, weights: np.ndarray) -> list[float]:
    """Ridge logistic regression to soft labels, by Newton's steps."""
    beta = np.zeros(features.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        slope = features.T @ (weights * (soft - p)) - beta
        curve = (features * (weights * p * (1 - p))[:, None]).T @ features + np.eye(len(beta))
        beta += np.linalg.solve(curve, slope)
    return beta.tolist()


def train(spans: DataFrame) -> Model:
    """At most 1,944 rows reach the driver, however many spans there are."""
    counted = spans.groupBy("kind", "strict", "votes").count().collect()
    reliabilities, weights = {}, {}
    for kind in KINDS:
        rows = sorted((tuple(r["votes"]), r["strict"], r["count"]) for r in counted if r["kind"] == kind)
        if not rows:
            continue
        posterior, reliabilities[kind] = expectation_maximisation([(v, n) for v, _, n in rows])
        features = np.array([[1.0, float(not s), *map(float, v)] for v, s, _ in rows])
        n = np.array([float(n) for _, _, n in rows])
        weights[kind] = logistic(features, np.array(posterior), n)
    return Model(reliabilities, weights)


# ---- the result ---------------------------------------------------------------------------------


def _listed(spans: Column) -> Column:
    """kind:start:end, by start, then kind as listed, then end."""
    parts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(
            ":", F.get(F.array(*map(F.lit, KINDS)), s["no"]), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(parts, ",")


def find(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sure: float = SURE
) -> DataFrame:
    """Per row: the base spans by kind and their digest, all spans, and how many were added."""
    rows, spans = candidates(docs, id_col, text_col)
    model = train(spans)
    base = F.col("strict") & F.col("valid")
    # A loose span that touches a base span is that span, seen less sharply.
    by_start = Window.partitionBy("row").orderBy("start", "end")
    before = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = by_start.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    reach = F.coalesce(F.max(F.when(base, F.col("end"))).over(before), F.lit(0))
    next_ = F.min(F.when(base, F.col("start"))).over(after)
    touches = (reach > F.col("start")) | F.coalesce(next_ < F.col("end"), F.lit(False))
    p = model.score(F.col("kind"), F.col("strict"), F.col("votes"))
    added = ~F.col("strict") & ~touches & (p >= sure)
    number = F.lit(-1)
    for i, kind in enumerate(KINDS):
        number = F.when(F.col("kind") == kind, i).otherwise(number)
    chosen = spans.withColumns({"base": base, "added": added}).where("base OR added")
    span = F.struct("start", number.alias("no"), "end")
    per_row = chosen.groupBy("row").agg(
        *[F.count_if(base & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        F.collect_list(F.when(F.col("base"), span)).alias("base"),
        F.collect_list(span).alias("all"),
        F.count_if("added").alias("n_added"),
    )
    own = per_row.select(
        F.col("row").alias("_row"),
        *[f"n_{k}" for k in KINDS],
        _listed(F.col("base")).alias("base"),
        _listed(F.col("all")).alias("spans"),
        "n_added",
    )
    none, zero = F.lit(""), F.lit(0).cast("long")
    return rows.join(own, rows["row"] == own["_row"], "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", none), 256).alias("base_sha256"),
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("n_added", zero).alias("n_added"),
    )
