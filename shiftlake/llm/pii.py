"""PII: weak-supervision aggregation over regex, gazetteer and context labelers. DataFrame functions only.

Method: base patterns (email, ip, card, phone; with checks) and looser
patterns (local phone numbers, social security numbers, secrets) propose
spans. Three labelers vote on every proposal: its strict shape (regex), a
gazetteer of known prefixes and reserved ranges, and the words before it
(context); each says yes, no or nothing. Votes of all spans are counted per
kind and vote pattern in Spark. Expectation-maximisation over these counts
estimates each labeler's reliability and the probability that a pattern is
personal data; a logistic span classifier over kind and votes is trained on
these soft labels and decides on the looser spans. Base spans always stay; a
looser span that overlaps one is dropped.

Positions are code points, end exclusive, computed from the pieces between
matches. Patterns use possessive repeats and start at run boundaries, so
they take linear time and no deep stack on long runs.

Scale: the patterns run once, in one map; proposals are written. What the
driver gets is one count per kind and vote pattern (at most 7 * 27 rows).
Redaction reads the written rows. No text is shuffled.

Defined cases: a null text is empty and has no spans (redaction leaves it
null); repeated rows are judged each; null ids are kept; empty tables give
no rows; columns of the input are kept, so it must not have the columns
``pii`` and ``pii_proposed``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlake.llm.common import Scratch

BASE = ("email", "ip", "card", "phone")
ADDED = ("local_phone", "ssn", "secret")
KINDS = BASE + ADDED
LABELERS = ("shape", "gazetteer", "context")

_LOCAL, _DOMAIN = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local_phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)[\x20]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?i:(?<![A-Za-z0-9])(?:password|passwd|secret|token|api_?key)[\"']?+[\x20\t]*+[=:][\x20\t]*+[\"']?+[A-Za-z0-9+/_-]{8,}+)"
              r"|(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[opsu]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9]{20,}+)(?![A-Za-z0-9])",
}
#: A piece of each kind's pattern that a text must hold.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "local_phone": None, "ssn": "-", "secret": None}
#: Words before a span that speak for its kind.
CONTEXT = {
    "email": "mail|contact|write|reach", "ip": "ip|address|host|server|login", "card": "card|visa|credit|payment|account",
    "phone": "phone|tel|call|mobile|fax", "local_phone": "phone|tel|call|mobile|fax", "ssn": "ssn|social|security",
    "secret": "key|secret|password|token|login|credential",
}
LOOK_BACK = 32
EM_STEPS = 50
FIT_STEPS = 400


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _sound(kind: str, v: Column) -> Column:
    """Checks of the base kinds."""
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(v, "\\.", -1), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(F.substring(part(p), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(v)).between(14, 19) & _luhn(_digits(v))
    if kind == "phone":
        return F.length(_digits(v)).between(10, 15)
    return F.lit(True)


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _shape(kind: str, v: Column) -> Column:
    if kind == "email":
        return _vote(v.rlike(r"^[A-Za-z][A-Za-z0-9._-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"), v.rlike(r"\.[0-9]+$"))
    if kind == "ip":
        return _vote(~v.rlike(r"(^|\.)0[0-9]"), F.lit(True))
    if kind == "card":
        return _vote(F.length(_digits(v)).isin(15, 16), F.lit(False))
    if kind == "phone":
        return _vote(v.rlike(r"^\+[0-9]{1,3}[\x20(.-]"), F.lit(False))
    if kind == "local_phone":
        return _vote(v.rlike(r"^\(?[2-9][0-9]{2}\)?[\x20.-]?[2-9]"), F.lit(True))
    if kind == "ssn":
        return _vote(~v.rlike(r"^000|-00-|-0000$"), F.lit(True))
    return _vote(v.rlike("[0-9]") & v.rlike("[A-Za-z]"), F.lit(True))


def _gazetteer(kind: str, v: Column) -> Column:
    if kind == "email":
        return _vote(v.rlike(r"(?i)\.(com|org|net|edu|gov|info|de|fr|es|uk|io)$"), F.lit(False))
    if kind == "ip":
        return _vote(F.lit(False), v.rlike(r"^(0|127|255)\."))
    if kind == "card":
        return _vote(v.rlike("^(4|5[1-5]|3[47]|6011|65)"), v.rlike("^[0179]"))
    if kind == "phone":
        return _vote(v.rlike(r"^\+(1|7|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"), F.lit(False))
    if kind == "local_phone":
        return _vote(F.lit(False), v.rlike(r"^\(?(000|[0-9]11)"))
    if kind == "ssn":
        return _vote(F.lit(False), v.rlike("^(666|9)"))
    # after a blank, words of prose ("token: classification") are proposed too: a name counts with a digit in the value
    return _vote(v.rlike("^(AKIA|gh[opsu]_|sk-)") | v.rlike("(?i)^(password|passwd|secret|token|api_?key)[^0-9]*+[0-9]"), F.lit(False))


def _proposals(text: Column, kind: str) -> Column:
    """Array of (start, kind, end, votes...) of one kind; a match's place follows from the pieces before it."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,v:string,c:string>>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        at = state["at"] + F.length(x["p"])
        before = F.lower(F.right(x["p"], F.lit(LOOK_BACK)))
        return F.struct(
            (at + F.coalesce(F.length(x["m"]), F.lit(0))).alias("at"),
            F.when(x["m"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(F.struct(at.alias("s"), x["m"].alias("v"), before.alias("c"))))).alias("out"),
        )

    pairs = F.zip_with(pieces, found, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    placed = F.aggregate(pairs, start, step, lambda s: s["out"])
    sound = F.filter(placed, lambda x: _sound(kind, x["v"]))
    votes = F.transform(sound, lambda x: F.struct(
        x["s"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (x["s"] + F.length(x["v"])).alias("end"),
        _shape(kind, x["v"]).alias("shape"), _gazetteer(kind, x["v"]).alias("gazetteer"),
        _vote(x["c"].rlike(CONTEXT[kind]), F.lit(False)).alias("context"),
    ))
    return votes


_SPAN = "struct<start:int,kind:int,end:int,shape:int,gazetteer:int,context:int>"


def propose(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with ``pii_proposed``: all spans of all kinds with their votes, by start and kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = []
    for kind in KINDS:
        some = _proposals(text, kind).cast(f"array<{_SPAN}>")
        need = text.contains(NEEDS[kind]) if NEEDS[kind] else text.rlike(PATTERNS[kind])
        parts.append(F.when(need, some).otherwise(F.array().cast(f"array<{_SPAN}>")))
    return docs.withColumn("pii_proposed", F.array_sort(F.concat(*parts)))


#: What a labeler says of personal data and of other text before any count is seen, worth PSEUDO spans.
SAYS = {1: {1: 0.6, 0: 0.35, -1: 0.05}, 0: {1: 0.25, 0: 0.45, -1: 0.3}}
PRIOR_BASE, PRIOR_ADDED, PSEUDO = 0.9, 0.3, 20.0


def estimate(counts: list[tuple[int, tuple[int, ...], int]], steps: int = EM_STEPS) -> dict[tuple[int, tuple[int, ...]], float]:
    """Probability of (kind, votes) by EM over two classes; a labeler's reliability is estimated for each kind."""
    post: dict = {}
    for kind in sorted({k for k, _, _ in counts}):
        rows = [(votes, n) for k, votes, n in counts if k == kind]
        expected = PRIOR_BASE if kind < len(BASE) else PRIOR_ADDED
        prior, say = expected, {(j, c, v): p for j in range(len(LABELERS)) for c, row in SAYS.items() for v, p in row.items()}
        for _ in range(steps):
            for votes, _n in rows:
                yes, no = prior, 1 - prior
                for j, v in enumerate(votes):
                    yes, no = yes * say[j, 1, v], no * say[j, 0, v]
                post[kind, votes] = yes / (yes + no)
            prior = (sum(post[kind, v] * n for v, n in rows) + PSEUDO * expected) / (sum(n for _, n in rows) + PSEUDO)
            for j in range(len(LABELERS)):
                for c, row in SAYS.items():
                    weight = {v: PSEUDO * p for v, p in row.items()}
                    for votes, n in rows:
                        weight[votes[j]] += n * (post[kind, votes] if c else 1 - post[kind, votes])
                    total = sum(weight.values())
                    say.update({(j, c, v): w / total for v, w in weight.items()})
    return post


def _features(kind: int, votes: tuple[int, ...]) -> list[float]:
    return [1.0, *[float(kind == k) for k in range(len(KINDS))], *[float(v == s) for v in votes for s in (1, -1)]]


def fit_classifier(counts: list[tuple[int, tuple[int, ...], int]], soft: dict, steps: int = FIT_STEPS) -> list[float]:
    """Logistic regression on the soft labels, each pattern weighted by the square root of its count."""
    rows = [(_features(k, v), soft[k, v], math.sqrt(n)) for k, v, n in counts]
    weights = [0.0] * (1 + len(KINDS) + 2 * len(LABELERS))
    total = sum(n for _, _, n in rows) or 1.0
    for _ in range(steps):
        grad = [1e-3 * w for w in weights]
        for x, y, n in rows:
            miss = n / total * (1 / (1 + math.exp(-sum(a * b for a, b in zip(weights, x, strict=True)))) - y)
            grad = [g + miss * a for g, a in zip(grad, x, strict=True)]
        weights = [w - 2.0 * g for w, g in zip(weights, grad, strict=True)]
    return weights


def _score(weights: list[float], x: Column) -> Column:
    total = F.lit(weights[0]) + F.element_at(F.array(*[F.lit(w) for w in weights[1 : 1 + len(KINDS)]]), x["kind"] + 1)
    for j, name in enumerate(LABELERS):
        yes, no = weights[1 + len(KINDS) + 2 * j : 3 + len(KINDS) + 2 * j]
        total = total + F.when(x[name] == 1, yes).when(x[name] == -1, no).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with ``pii``: array of (start, kind, end, name, base, score), by start and then kind."""
    scratch = Scratch(docs.sparkSession, "pii")
    rows = scratch.save(propose(docs, text_col), "proposed")
    votes = rows.select(F.explode("pii_proposed").alias("x")).groupBy("x.kind", *[f"x.{n}" for n in LABELERS]).count()
    counts = sorted((r[0], tuple(r[1:4]), r[4]) for r in votes.collect())
    weights = fit_classifier(counts, estimate(counts))
    base = F.filter("pii_proposed", lambda x: x["kind"] < len(BASE))
    clear = lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    kept = F.filter("pii_proposed", lambda x: (x["kind"] < len(BASE)) | ((_score(weights, x) >= 0.5) & clear(x)))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(kept, lambda x: F.struct(
        x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), F.element_at(names, x["kind"] + 1).alias("name"),
        (x["kind"] < len(BASE)).alias("base"), _score(weights, x).alias("score"),
    ))
    return rows.withColumn("pii", spans).drop("pii_proposed")


def redact(found: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``find_pii`` with each span replaced by its name in brackets (overlapping spans by the first one's)."""
    def step(state: Column, x: Column) -> Column:
        inner = x["start"] < state["at"]
        return F.struct(
            F.greatest(state["at"], x["end"]).alias("at"),
            F.when(inner, state["out"]).otherwise(F.concat(
                state["out"], F.substring(F.col(text_col), state["at"] + 1, x["start"] - state["at"]), F.lit("["), F.upper(x["name"]), F.lit("]"))).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = lambda s: F.concat(s["out"], F.substring(F.col(text_col), s["at"] + 1, F.length(text_col)))
    return found.withColumn(text_col, F.when(F.size("pii") > 0, F.aggregate("pii", start, step, end)).otherwise(F.col(text_col))).drop("pii")


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with personal data in the text replaced by its kind; the columns stay, whatever their names."""
    others = [c for c in docs.columns if c != text_col]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    clean = redact(find_pii(docs.select(rest.alias("row"), F.col(text_col).alias("text"))))
    return clean.select(*[(F.col("text") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
