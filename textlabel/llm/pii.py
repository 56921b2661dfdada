"""Personal data by weak supervision, in native expressions only.

Candidates are the base matches of four patterns (email, ip, card, phone) and, where no valid base match is, looser shapes of
them: an email written with "at" and "dot", a phone number without ``+`` or with other numbers right after it, a card
number among other digit groups. Three labelers vote on each candidate: the strict pattern with its check, a gazetteer (top-level
domains, country codes, card issuers, address ranges) and the words before it. Votes are 1, -1 or 0 (none).

The votes of all documents are counted by pattern, at most 27 for each kind. Expectation-maximisation over these counts
estimates how reliable each labeler is (a two-class model with independent labelers); the span classifier is then trained on the
expected labels: log-odds of votes and of the candidate's shape. Base spans always stay; other candidates are added where the
classifier is ``sure`` and a labeler other than the pattern speaks for them.

Null texts count as empty. Positions are code points, the end is exclusive. Rows may repeat; columns other than key and
text are only carried along.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "gazetteer", "context")
SURE = 0.9

#: fixed values: the base patterns. They match what the plain forms match; guards and possessive quantifiers only keep
#: the matcher from trying again inside a run that has failed, and from recursing over long runs
_RUN = r"A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_RUN}]))[{_RUN}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?i)(?<![A-Za-z0-9])[A-Za-z0-9._-]{2,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{2,63} ?[\[(] ?dot ?[\])] ?[A-Za-z]{2,12}(?![A-Za-z])",
    "card": r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])",
    "phone": r"(?:\+[0-9]{1,3}[ -]?|(?<![0-9+().-])(?<![0-9+] ))(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
}
#: cheap conditions that every match implies, tried first: most texts hold no candidate
_DIGITS = "{t} rlike r'[0-9](?:[ -]?[0-9]){{13}}'"
_TRIGGER = {
    (True, "email"): "contains({t}, '@')",
    (True, "ip"): "{t} rlike r'[0-9]\\.[0-9]'",
    (True, "card"): _DIGITS,
    (True, "phone"): "contains({t}, '+')",
    (False, "email"): "{t} rlike r'(?i)[\\[(] ?dot'",
    (False, "card"): _DIGITS,
    (False, "phone"): "{t} rlike r'[0-9]{{3}}[.-][0-9]{{4}}'",
}
#: fixed values: gazetteers and context words
_KNOWN = {
    "email": r"(?i)[.) ](?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$",
    "ip": r"^(?!0|127\.|22[4-9]\.|2[3-5][0-9]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)",
    "phone": r"^\+?\(?(?:1|33|34|49|44|[2-9][0-9]{2}\))",
}
_BEFORE = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write)\b\W{0,8}$",
    "ip": r"(?i)\b(?:ip|host|server|address|addr)\b\W{0,8}$",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|payment)\b\W{0,8}$",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax)\b\W{0,8}$",
}
_AGAINST = {
    "email": r"(?i)\b(?:example|user)\b\W{0,8}$",
    "ip": r"(?i)\b(?:version|release|section|v)\b\W{0,8}$",
    "card": r"(?i)\b(?:id|ref|isbn|order|token|number|no)\b\W{0,8}$",
    "phone": r"(?i)\b(?:id|ref|isbn|order|token)\b\W{0,8}$",
}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _checked(kind: str, match: str) -> str:
    """SQL: does the base match pass its kind's check?"""
    digits = f"regexp_replace({match}, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": f"{match} rlike r'^{_PART}\\.{_PART}\\.{_PART}\\.{_PART}$'",
        "card": f"luhn_check({digits})",
        "phone": f"length({digits}) between 10 and 15",
    }[kind]


def _located(pattern: str, text: str, trigger: str) -> str:
    """SQL: array of (a, b, s) for every match: start, end, the string. Only texts with a match are split."""
    matches, gaps = f"regexp_extract_all({text}, r'{pattern}', 0)", f"split({text}, r'{pattern}', -1)"
    none = "cast(array() as array<struct<a:int,b:int,s:string>>)"
    step = ("named_struct('at', acc.at + length(x.g) + length(x.m), 'out', concat(acc.out, array(named_struct("
            "'a', acc.at + length(x.g), 'b', acc.at + length(x.g) + length(x.m), 's', x.m))))")
    return (f"case when {trigger} and {text} rlike r'{pattern}' then aggregate(zip_with({matches}, {gaps}, (m, g) -> named_struct('m', m, 'g', g)), "
            f"named_struct('at', 0, 'out', {none}), (acc, x) -> case when x.m is null then acc else {step} end, acc -> acc.out) else {none} end")


def _candidates(kind: str, base: bool, text: str) -> str:
    """SQL: array of candidates of a kind with the votes on each."""
    before = f"substring({text}, greatest(1, c.a - 23), least(24, c.a))"
    strict = f"case when {_checked(kind, 'c.s')} then {int(base)} else -1 end" if base or kind == "card" else "0"
    known = f"case when c.s rlike r'{_KNOWN[kind]}' then 1 else -1 end"
    context = f"case when {before} rlike r'{_BEFORE[kind]}' then 1 when {before} rlike r'{_AGAINST[kind]}' then -1 else 0 end"
    shape = "case when c.s rlike '^[0-9]+$' then 0 when c.s rlike '[A-Za-z]' then 1 when c.s rlike '[(]' then 2 else 3 end"
    number = KINDS.index(kind)
    return (f"transform({_located((BASE if base else LOOSE)[kind], text, _TRIGGER[base, kind].format(t=text))}, c -> named_struct('a', c.a, 'kind', {number}, 'b', c.b, "
            f"'strict', {strict}, 'gazetteer', {known}, 'context', {context}, 'shape', {shape}))")


def candidates(df: DataFrame, key: str, text: str, carry=()) -> DataFrame:
    """(key, *carry, c): every candidate of every whole text with its votes, by start and kind."""
    base, loose = ([_candidates(k, b, "_text") for k in which] for b, which in ((True, KINDS), (False, LOOSE)))
    apart = "c -> not exists(_base, x -> x.strict = 1 and x.kind = c.kind and x.a < c.b and c.a < x.b)"
    src = df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"), *[F.col(c) for c in carry if c != key])
    kept = [c for c in carry if c != key]
    found = src.select(key, *kept, F.expr(f"concat({', '.join(base)})").alias("_base"), F.expr(f"concat({', '.join(loose)})").alias("_loose"))
    return found.select(key, *kept, F.expr(f"case when size(_loose) = 0 then array_sort(_base) else array_sort(concat(_base, filter(_loose, {apart}))) end").alias("_found"))


def expected_labels(counts: dict[tuple, float], rounds: int = 50) -> dict[tuple, float]:
    """Probability that a candidate with each vote pattern is real, by expectation-maximisation.

    counts: {(strict, gazetteer, context): candidates}. A labeler that abstains says nothing; its reliability is the chance
    to vote 1 on real ones and -1 on others, started at 0.8 and smoothed by two votes."""
    prior, real, other = 0.5, [0.8] * 3, [0.8] * 3
    p = dict.fromkeys(counts, 0.5)
    for _ in range(rounds):
        for votes in counts:
            odds = math.log(prior / (1 - prior))
            for j, v in enumerate(votes):
                if v:
                    odds += math.log(real[j] / (1 - other[j])) if v > 0 else math.log((1 - real[j]) / other[j])
            p[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        total = sum(counts.values())
        prior = (sum(n * p[v] for v, n in counts.items()) + 1) / (total + 2)
        for j in range(3):
            cast = [(v, n) for v, n in counts.items() if v[j]]
            yes, no = sum(n * p[v] for v, n in cast), sum(n * (1 - p[v]) for v, n in cast)
            real[j] = (sum(n * p[v] for v, n in cast if v[j] > 0) + 1.6) / (yes + 2)
            other[j] = (sum(n * (1 - p[v]) for v, n in cast if v[j] < 0) + 1.6) / (no + 2)
            # a labeler is taken to be better than chance, so that the classes keep their meaning
            real[j], other[j] = min(0.98, max(0.55, real[j])), min(0.98, max(0.55, other[j]))
    return p


def train(counted: list[tuple]) -> dict[tuple, float]:
    """The span classifier from rows (kind, strict, gazetteer, context, shape, candidates): the probability for every combination of
    kind, votes and shape, by log-odds of each feature under the expected labels."""
    model: dict[tuple, float] = {}
    for kind in range(len(KINDS)):
        rows = [r for r in counted if r[0] == kind]
        patterns: dict[tuple, float] = {}
        for r in rows:
            patterns[r[1:4]] = patterns.get(r[1:4], 0.0) + r[5]
        p = expected_labels(patterns)
        yes, no = sum(r[5] * p[r[1:4]] for r in rows), sum(r[5] * (1 - p[r[1:4]]) for r in rows)

        def weight(feature: int, value: int) -> float:
            a = sum(r[5] * p[r[1:4]] for r in rows if r[1 + feature] == value)
            b = sum(r[5] * (1 - p[r[1:4]]) for r in rows if r[1 + feature] == value)
            return math.log((a + 1) / (yes + 4)) - math.log((b + 1) / (no + 4))

        for features in product((-1, 0, 1), (-1, 0, 1), (-1, 0, 1), (0, 1, 2, 3)):
            odds = math.log((yes + 1) / (no + 1)) + sum(weight(j, v) for j, v in enumerate(features))
            model[(kind, *features)] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return model


def vote_counts(found: DataFrame) -> list[tuple]:
    """Candidates by kind, votes and shape: at most 4 x 27 x 4 rows."""
    c = found.select(F.explode("_found").alias("c")).select("c.*")
    rows = c.groupBy("kind", *LABELERS, "shape").agg(F.count(F.lit(1)).alias("n")).collect()
    return [(r["kind"], *(r[x] for x in LABELERS), r["shape"], r["n"]) for r in rows]


def _accepted(model: dict[tuple, float], sure: float) -> list[int]:
    """Codes of the combinations beyond the base spans that the classifier accepts."""
    return [_code(k) for k, p in model.items() if k[1] == 0 and p >= sure and (k[2] > 0 or k[3] > 0) and k[3] >= 0]


def _code(features: tuple) -> int:
    kind, strict, known, context, shape = features
    return (((kind * 3 + strict + 1) * 3 + known + 1) * 3 + context + 1) * 4 + shape


def _with_spans(found: DataFrame, accepted: list[int]) -> DataFrame:
    code = "(((c.kind * 3 + c.strict + 1) * 3 + c.gazetteer + 1) * 3 + c.context + 1) * 4 + c.shape"
    span = "c -> named_struct('a', c.a, 'kind', c.kind, 'b', c.b)"
    return (found.withColumn("_ok", F.array(*map(F.lit, accepted or [-1])))
            .withColumn("base", F.expr(f"transform(filter(_found, c -> c.strict = 1), {span})"))
            .withColumn("spans", F.expr(f"transform(filter(_found, c -> c.strict = 1 or array_contains(_ok, {code})), {span})")).drop("_found", "_ok"))


def find_pii(df: DataFrame, key: str = "doc_id", text: str = "text", sure: float = SURE) -> DataFrame:
    """(key, base, spans): arrays of (a, kind, b) of the base spans and of all spans, by start and kind."""
    found = stored(candidates(df, key, text))  # narrow: no texts
    return _with_spans(found, _accepted(train(vote_counts(found)), sure))


def redact(df: DataFrame, key: str = "doc_id", text: str = "text", sure: float = SURE) -> DataFrame:
    """Every row of the table with each span of its text replaced by ``<EMAIL>``, ``<IP>``, ``<CARD>`` or ``<PHONE>``; of
    overlapping spans by the first one's mark. The texts are searched twice, to train and to replace, and never shuffled."""
    accepted = _accepted(train(vote_counts(candidates(df, key, text))), sure)
    whole = df.select(F.struct(*df.columns).alias("_row"), F.col(key), F.col(text))
    found = _with_spans(candidates(whole, key, text, ("_row",)), accepted)
    names = ", ".join(f"'<{k.upper()}>'" for k in KINDS)
    marked = F.expr(
        f"aggregate(spans, named_struct('at', 0, 'out', ''), (acc, c) -> named_struct('at', greatest(acc.at, c.b), 'out', case when c.a < acc.at then acc.out "
        f"else concat(acc.out, substring(_whole, acc.at + 1, c.a - acc.at), element_at(array({names}), c.kind + 1)) end), acc -> concat(acc.out, substring(_whole, acc.at + 1)))")
    return (found.withColumn("_whole", F.col("_row")[text]).withColumn("_marked", F.when(F.size("spans") == 0, F.col("_whole")).otherwise(marked))
            .select(*[F.col("_marked").alias(c) if c == text else F.col("_row")[c].alias(c) for c in df.columns]))


def joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, c -> concat(element_at(array({names}), c.kind + 1), ':', c.a, ':', c.b)), ',')")
