"""Personal data by weak supervision.

Spans come from strict patterns (email, ip, card, phone) and looser ones (also
of further kinds).  Three labelers vote on each: the regex labeler (for a
strict match), a gazetteer labeler (mail domains' ends, card issuers, calling
codes; against reserved networks and unknown issuers) and a context labeler
(cue words before the span).  Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is and how likely each pattern is
personal data; a logistic span classifier is trained on those likelihoods.
Strict spans stay; the classifier decides on the others, which must not overlap
a strict span.

All that touches rows is SQL expressions within the row.  What reaches the
driver are counts by kind, votes and length class: at most a few thousand rows
whatever the input.

Patterns don't backtrack over long runs: runs are possessive and start where a
run starts (or where the last match ended), which leaves the leftmost
non-overlapping matches of the plain patterns unchanged.

Nulls and empty texts have no spans; a null ``doc_id`` is kept.  Repeated rows
are judged each; an empty table gives no rows, and a table without spans a
classifier that adds none.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone", "ssn", "iban")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# looser patterns
EMAIL_WORDS = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
               r"(?:\x20?(?:\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++")
PHONE_BARE = r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?![A-Z0-9])"
# gazetteers and cues (fixed values)
DOMAIN_ENDS = ("com", "org", "net", "edu", "gov", "int", "info", "io", "de", "fr", "es", "uk", "eu", "ch", "at", "it", "nl")
RESERVED_NETWORKS = r"^0*(0|10|127|224|255)\.|^192\.168\.|^169\.254\."
CARD_ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)"
CALLING_CODES = r"^\+?(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CUES = {"email": "mail|contact|write|reach", "ip": "ip|host|server|address", "card": "card|visa|master|credit|pay",
        "phone": "phone|call|tel|mobile|fax|contact", "ssn": "ssn|social|security", "iban": "iban|bank|account"}
COUNTER_CUES = "version|isbn|order no|invoice|figure|section|release|build"
_CONTEXT = 40


def matches(text: Column, pattern: str, kind: str, strict: bool, valid: Callable[[Column], Column],
            needs: Column) -> Column:
    """Spans (start, end, kind, strict, match) of the pattern's leftmost matches that are valid."""
    spot = "array<struct<start:int,end:int,kind:string,strict:boolean,match:string>>"
    none = F.expr(f"cast(array() as {spot})")
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, m: F.struct(F.char_length(gap).alias("gap"), m.alias("m")))

    def add(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.char_length(x["m"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), F.lit(strict).alias("strict"),
                        x["m"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))
    # the text after the last match has no partner
    spans = F.aggregate(F.filter(pairs, lambda x: x["m"].isNotNull()), zero, add, lambda acc: acc["out"])
    return F.when(needs, F.filter(spans, lambda x: valid(x["match"]))).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def digit(i):
        d = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, F.lit(2)).otherwise(F.lit(1))
        return F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda a, i: a + digit(i)) % 10 == 0


def _length(c: Column, lo: int, hi: int) -> Column:
    return F.char_length(c).between(lo, hi)


def _everything(m: Column) -> Column:
    return F.lit(True)


def candidates(text: Column) -> Column:
    """All spans of a text with the votes on them: array of struct (start, end, kind, strict, gazetteer, context, size)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    at, digit = F.contains(text, F.lit("@")), text.rlike("[0-9]")
    part = r"^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
    strict = F.concat(
        matches(text, EMAIL, "email", True, _everything, at),
        matches(text, IP, "ip", True, lambda m: F.forall(F.split(m, r"\."), lambda p: p.rlike(part)), digit),
        matches(text, CARD, "card", True,
                lambda m: F.when(_length(_digits(m), 14, 19), luhn(_digits(m))).otherwise(F.lit(False)), digit),
        matches(text, PHONE, "phone", True, lambda m: _length(_digits(m), 10, 15), digit & F.contains(text, F.lit("+"))))
    loose = F.concat(
        matches(text, EMAIL_WORDS, "email", False, _everything, text.rlike(r"[(\[]at[)\]]")),
        matches(text, PHONE_BARE, "phone", False, _everything, digit),
        matches(text, SSN, "ssn", False, _everything, digit & F.contains(text, F.lit("-"))),
        matches(text, IBAN, "iban", False, _everything, digit))

    def both(sure):
        apart = F.filter(loose, lambda x: ~F.exists(sure, lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"])))
        return F.transform(F.concat(sure, apart), lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["strict"].alias("strict"),
            gazetteer(x["kind"], x["match"]).alias("gazetteer"),
            context(x["kind"], F.substring(text, F.greatest(x["start"] - _CONTEXT, F.lit(0)) + 1,
                                           F.least(x["start"], F.lit(_CONTEXT)))).alias("context"),
            F.least(F.floor((x["end"] - x["start"]) / 6), F.lit(7)).cast("int").alias("size")))

    return F.element_at(F.transform(F.array(strict), both), 1)


def _by_kind(kind: Column, values: dict[str, Column], other: Column) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(kind == k, v) if out is None else out.when(kind == k, v)
    return out.otherwise(other)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def gazetteer(kind: Column, m: Column) -> Column:
    ends = rf"(?i)(\.|dot[)\]]\x20?)({'|'.join(DOMAIN_ENDS)})$"
    return _by_kind(kind, {
        "email": _vote(m.rlike(ends), F.lit(False)),
        "ip": _vote(~m.rlike(RESERVED_NETWORKS), F.lit(True)),
        "card": _vote(_digits(m).rlike(CARD_ISSUERS), F.lit(True)),
        "phone": _vote(m.startswith("+") & m.rlike(CALLING_CODES), F.lit(False)),
        "ssn": _vote(~m.rlike("^(000|666|9)"), F.lit(True)),
    }, F.lit(0))


def context(kind: Column, before: Column) -> Column:
    low = F.lower(before)
    cues = {k: _vote(low.rlike(rf"\b({c})"), low.rlike(rf"\b({COUNTER_CUES})")) for k, c in CUES.items()}
    return _by_kind(kind, cues, F.lit(0))


# --- reliabilities and the span classifier, over counts ----------------------------

FEATURES = ("strict", "gazetteer_yes", "gazetteer_no", "context_yes", "context_no", "size", *KINDS)


@dataclass(frozen=True)
class Classifier:
    """reliability[labeler][z][vote + 1] = P(vote | z), z: 1 for personal data; weights: the bias, then FEATURES."""

    reliability: tuple
    prior: dict
    weights: tuple

    def probability(self, span: Column) -> Column:
        is_ = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
        values = [is_(span["strict"]), is_(span["gazetteer"] == 1), is_(span["gazetteer"] == -1),
                  is_(span["context"] == 1), is_(span["context"] == -1), span["size"].cast("double"),
                  *(is_(span["kind"] == k) for k in KINDS)]
        z = F.lit(float(self.weights[0]))
        for w, v in zip(self.weights[1:], values):
            z = z + F.lit(float(w)) * v
        return 1 / (1 + F.exp(-z))


def expectation_maximisation(patterns: dict[tuple, float], rounds: int = 100):
    """From counts of (kind, votes): P(vote | z) of each labeler, P(z = 1) of each kind, and of each pattern."""
    n_labelers = len(next(iter(patterns))[1]) if patterns else 3
    rel = [[[0.35, 0.45, 0.20], [0.10, 0.45, 0.45]] for _ in range(n_labelers)]
    prior = {k: 0.5 for k, _ in patterns}
    post = {}
    for _ in range(rounds):
        for key in patterns:
            kind, votes = key
            p = [1 - prior[kind], prior[kind]]
            for j, v in enumerate(votes):
                p = [p[z] * rel[j][z][v + 1] for z in (0, 1)]
            post[key] = p[1] / (p[0] + p[1])
        rel = [[[1.0 + sum(n * (post[k] if z else 1 - post[k]) for k, n in patterns.items() if k[1][j] == v - 1)
                 for v in range(3)] for z in (0, 1)] for j in range(n_labelers)]
        rel = [[[x / sum(row) for x in row] for row in one] for one in rel]
        prior = {kind: (1 + sum(n * post[k] for k, n in patterns.items() if k[0] == kind))
                 / (2 + sum(n for k, n in patterns.items() if k[0] == kind)) for kind in prior}
    return rel, prior, post


def logistic(rows: list[tuple[list[float], float, float]], ridge: float = 1.0, rounds: int = 25) -> list[float]:
    """Weights (bias first) from (features, target, count), by Newton steps."""
    size = len(FEATURES) + 1
    w = [0.0] * size
    for _ in range(rounds if rows else 0):
        g = [-ridge * x for x in w]
        h = [[ridge if i == j else 0.0 for j in range(size)] for i in range(size)]
        for x, y, n in rows:
            x = [1.0, *x]
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))))
            on = [i for i in range(size) if x[i]]
            for i in on:
                g[i] += n * (y - p) * x[i]
                for j in on:
                    h[i][j] += n * p * (1 - p) * x[i] * x[j]
        w = [a + b for a, b in zip(w, _solve(h, g))]
    return w if rows else [-10.0] + [0.0] * (size - 1)


def _solve(a: list[list[float]], b: list[float]) -> list[float]:
    a = [[*row, v] for row, v in zip(a, b)]
    for i in range(len(a)):
        top = max(range(i, len(a)), key=lambda r: abs(a[r][i]))
        a[i], a[top] = a[top], a[i]
        for r in range(len(a)):
            if r != i:
                f = a[r][i] / a[i][i]
                a[r] = [x - f * y for x, y in zip(a[r], a[i])]
    return [row[-1] / row[i] for i, row in enumerate(a)]


def train(found: DataFrame, column: str = "candidates") -> Classifier:
    """From the counts of all candidate spans of a table."""
    spans = found.select(F.explode(column).alias("s")).select("s.*")
    counts = (spans.groupBy("kind", "strict", "gazetteer", "context", "size").agg(F.count("*").alias("n"))
              .orderBy("kind", "strict", "gazetteer", "context", "size").collect())  # 6 * 2 * 3 * 3 * 8 at most
    patterns: dict[tuple, float] = {}
    votes = lambda r: (r.kind, (1 if r.strict else 0, r.gazetteer, r.context))
    for r in counts:
        patterns[votes(r)] = patterns.get(votes(r), 0) + r.n
    rel, prior, post = expectation_maximisation(patterns)
    rows = [([float(r.strict), float(r.gazetteer == 1), float(r.gazetteer == -1), float(r.context == 1),
              float(r.context == -1), float(r["size"]), *(float(r.kind == k) for k in KINDS)], post[votes(r)], float(r.n))
            for r in counts]
    return Classifier(tuple(map(tuple, rel)), prior, tuple(logistic(rows)))


def spans(found: Column, classifier: Classifier) -> Column:
    """The candidates that count as personal data, by start, then kind."""
    kept = F.filter(found, lambda x: x["strict"] | (classifier.probability(x) >= 0.5))
    place = F.array(*map(F.lit, KINDS))
    return F.array_sort(F.transform(kept, lambda x: F.struct(
        x["start"].alias("start"), F.array_position(place, x["kind"]).alias("place"), x["end"].alias("end"),
        x["kind"].alias("kind"), x["strict"].alias("strict"))))


def digest(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                 x["end"].cast("string"))), ",")


def detect(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row: doc_id, spans (start, place, end, kind, strict), after training on all rows."""
    found = stored(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), candidates(F.col(f"`{text}`")).alias("candidates")),
                   "pii-candidates")
    return found.select("doc_id", spans(F.col("candidates"), train(found)).alias("spans"))


def redacted(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans by the first one's."""
    def step(acc, x):
        new = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]),
                       F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.when(x["start"] < acc["at"], acc["out"]).otherwise(new).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(found) == 0, text).otherwise(F.aggregate(
        found, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))))


def redact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns, personal data in the text replaced."""
    body = F.col(f"`{text}`")
    classifier = train(docs.select(candidates(body).alias("candidates")))
    once = F.element_at(F.transform(F.array(spans(candidates(body), classifier)), lambda found: redacted(body, found)), 1)
    new = F.when(body.isNotNull(), once)
    return docs.select(*(new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))
