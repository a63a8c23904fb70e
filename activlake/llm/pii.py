"""Personal data by weak supervision, from DataFrame functions alone.

Base kinds (email, ip, card, phone) are patterns with exact checks. Beyond them the texts are
searched for candidates: long mixed identifiers (``secret``), national numbers, local phone
numbers, account numbers, and base matches of ten characters or more that failed their check (digit
runs: of ten digits or more). All of these hold digits: names, addresses and secrets without a digit
are not looked for. Labelers vote on every
candidate with 1, 0 or abstain (-1): patterns look at its shape, gazetteers at the words before
it, context rules at the characters around it. Expectation-maximisation over the vote patterns
estimates how reliable each labeler is and how likely each pattern is personal; a logistic
classifier over votes, kind and shape is trained on these likelihoods and decides. Base spans
always stay; candidates that pass and lie in no base span are added.

The texts are read once. Their spans and candidates are stored (checkpoint), which is small
against the texts, and all else works on that table. The model sees counts by pattern only: votes,
kind and two shape classes, of which there are 3**7 * 5 * 3 * 3 at most, whatever the corpus.

All patterns run in linear time: quantifiers are possessive, and a match may start only where its
run starts or the last match ended, which finds the same matches.

Edge cases: a null or empty text has no spans; repeated rows and ids give repeated results; without
candidates nothing is added; an empty table gives an empty result; other columns are kept by
``redact`` and ignored by ``find``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.llm.common import by_name, checkpointed, once, table

#: Base kinds in their order, with the pattern and a cheaper test that a text may hold it.
BASE = {
    "email": (
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
    ),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){9}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
CANDIDATE = "|".join(
    (
        r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Z0-9])",
        r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}",
        r"(?<![0-9+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        r"(?<![0-9+)(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    )
)
KINDS = ("secret", "account", "national_id", "phone_local", "failed")
# Field names and words around values, in several languages.
SECRET_NAMES = (
    "token secret password passwd passwort contraseña pwd passphrase credential credentials "
    "api_key apikey api-key access_key private_key auth bearer authorization jeton clave"
).split()
PERSON_NAMES = (
    "ssn social passport iban account konto compte cuenta tel telefon téléphone teléfono phone "
    "mobile fax call card karte carte tarjeta"
).split()
OTHER_NAMES = (
    "sha sha1 sha256 md5 commit checksum digest hash version isbn issn doi uuid license build "
    "revision order invoice"
).split()
AROUND = 32
ABSTAIN = -1


def _matches(df: DataFrame, name: str, pattern: str, may_hold: Column) -> DataFrame:
    """Add the matches of a pattern in column ``text``: start, end (code points), value and the
    text before and after. Positions follow from the pieces between the matches."""
    none = F.array().cast("array<string>")
    df = once(
        df,
        m=F.when(may_hold, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none),
    )
    df = once(
        df, p=F.when(F.size("m") > 0, F.split("text", pattern, -1)).otherwise(none)
    )
    walk = (
        "CASE WHEN size(m) = 0 THEN CAST(array() AS array<int>) ELSE"
        " aggregate(sequence(1, size(m)),"
        " named_struct('at', 0, 'out', CAST(array() AS array<int>)),"
        " (s, i) -> named_struct('at', s.at + length(p[i - 1]) + length(m[i - 1]),"
        " 'out', concat(s.out, array(s.at + length(p[i - 1])))), s -> s.out) END"
    )
    df = once(df, starts=F.expr(walk))
    found = F.expr(
        "transform(m, (x, i) -> named_struct('start', starts[i], 'end', starts[i] + length(x),"
        f" 'value', x, 'before', right(p[i], {AROUND}), 'after', left(p[i + 1], 4)))"
    )
    return df.withColumn(name, found).drop("m", "p", "starts")


def _valid(kind: str) -> str:
    """SQL condition on the match ``x``."""
    digits = "regexp_replace(x.value, '[^0-9]', '')"
    if kind == "ip":
        part = "trim(LEADING '0' FROM y)"
        return (
            rf"forall(split(x.value, '[.]'), y -> length({part}) <= 3"
            f" AND coalesce(try_cast({part} AS INT), 0) <= 255)"
        )
    if kind == "card":
        digit = f"CAST(substring({digits}, length({digits}) - i + 1, 1) AS INT)"
        return (
            f"length({digits}) BETWEEN 14 AND 19 AND aggregate(sequence(1, length({digits})), 0,"
            f" (a, i) -> a + CASE WHEN i % 2 = 1 THEN {digit}"
            f" WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END) % 10 = 0"
        )
    if kind == "phone":
        return f"length({digits}) BETWEEN 10 AND 15"
    return "true"


def _words(names: Sequence[str]) -> str:
    return "(?i)(?:^|[^\\\\p{L}])(?:" + "|".join(names) + ")(?:$|[^\\\\p{L}])"


def _labelers() -> dict[str, str]:
    """SQL votes on the candidate ``x`` (with ``kind``), in the order of the vote pattern."""

    def vote(yes: str, no: str = "false") -> str:
        return f"CASE WHEN {yes} THEN 1 WHEN {no} THEN 0 ELSE {ABSTAIN} END"

    distinct = "size(array_distinct(split(x.value, '')))"
    digits = "length(regexp_replace(x.value, '[^0-9]', ''))"
    return {
        "regex_shape": vote(
            "(x.kind = 'secret' AND x.value RLIKE"
            " '^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}|"
            "(?:ghp_|sk-|AKIA|xox)[A-Za-z0-9_-]+)$')"
            " OR x.kind IN ('account', 'national_id', 'phone_local')",
            "x.kind = 'failed'",
        ),
        "regex_mix": vote(
            f"x.kind = 'secret' AND 10 * {digits} BETWEEN 2 * length(x.value) AND 9 * length(x.value)",
            f"x.kind = 'secret' AND 10 * {digits} < length(x.value)",
        ),
        "gazetteer_secret": vote(f"x.before RLIKE '{_words(SECRET_NAMES)}'"),
        "gazetteer_person": vote(
            f"x.kind != 'secret' AND x.before RLIKE '{_words(PERSON_NAMES)}'"
        ),
        "gazetteer_other": vote("false", f"x.before RLIKE '{_words(OTHER_NAMES)}'"),
        "context_assigned": vote(
            "x.before RLIKE '[:=]\\\\s*[\"\\'`]?$'", "x.before RLIKE '[/#]$'"
        ),
        "context_random": vote(
            f"x.kind = 'secret' AND {distinct} >= 10",
            f"{distinct} <= 3 OR x.value RLIKE '0123456|1234567|abcdef0|xxxx|XXXX'",
        ),
    }


LABELERS = tuple(_labelers())


def candidates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document its ``base`` spans (kind, start, end; sorted) and its ``candidates``
    (the same with ``votes``, ``long`` and ``mixed``)."""
    return _searched(documents, text, {"doc_id": doc_id})


def _searched(documents: DataFrame, text: str, kept: dict[str, str]) -> DataFrame:
    """``base``, ``candidates`` and the columns ``kept``, new names for columns of documents."""
    df = documents.select(
        *(by_name(documents, c).alias(new) for new, c in kept.items()),
        F.coalesce(by_name(documents, text), F.lit("")).alias("text"),
    )
    df = once(df, has_digit=F.col("text").rlike("[0-9]"))
    for kind, (pattern, test) in BASE.items():
        may = F.contains("text", F.lit("@")) if test == "@" else F.col("text").rlike(test)
        df = _matches(df, kind, pattern, may if test == "@" else F.col("has_digit") & may)
    df = _matches(df, "other", CANDIDATE, F.col("has_digit"))
    span = "named_struct('start', x.start, 'order', {order}, 'kind', '{kind}', 'end', x.end)"
    base = F.array_sort(
        F.concat(
            *(
                F.expr(
                    f"transform(filter({k}, x -> {_valid(k)}), x -> {span.format(order=i, kind=k)})"
                )
                for i, k in enumerate(BASE)
            )
        )
    )
    kind = (
        "CASE WHEN x.value RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$' THEN 'national_id'"
        " WHEN x.value RLIKE '^[(]?[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}$' THEN 'phone_local'"
        " WHEN x.value RLIKE '^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$' THEN 'account'"
        " ELSE 'secret' END"
    )
    named = "named_struct('start', x.start, 'end', x.end, 'value', x.value, 'before', x.before, 'after', x.after, 'kind', {})"
    failed = [
        F.expr(
            f"transform(filter({k}, x -> {size} > 9 AND NOT ({_valid(k)})"
            " AND NOT (x.before RLIKE '[A-Za-z0-9]$' OR x.after RLIKE '^[A-Za-z0-9]')),"
            f" x -> {named.format(repr('failed'))})"
        )
        for k, size in (
            ("card", "length(regexp_replace(x.value, '[^0-9]', ''))"),
            ("phone", "length(x.value)"),
        )
    ]
    df = once(
        df.select(
            *kept,
            base.alias("base"),
            F.concat(F.expr(f"transform(other, x -> {named.format(kind)})"), *failed).alias("c"),
        ),
        base_=F.col("base"),
    ).drop("base")
    votes = ", ".join(_labelers().values())
    shape = (
        "CASE WHEN length(x.value) < 20 THEN 0 WHEN length(x.value) < 36 THEN 1 ELSE 2 END AS long,"
        " CASE WHEN x.value RLIKE '^[^A-Za-z]*$' THEN 0"
        " WHEN x.value RLIKE '[a-z]' AND x.value RLIKE '[A-Z]' THEN 1 ELSE 2 END AS mixed"
    )
    free = "NOT exists(base_, b -> b.start <= x.start AND x.end <= b.end)"
    return df.select(
        *kept,
        F.col("base_").alias("base"),
        F.expr(
            f"transform(filter(c, x -> {free}), x -> struct(x.start AS start, x.kind AS kind,"
            f" x.end AS end, array({votes}) AS votes, {shape}))"
        ).alias("candidates"),
    )


@dataclass(frozen=True)
class Reliability:
    """What expectation-maximisation found: the share of personal candidates and, for each
    labeler, the probabilities of its votes -1, 0, 1 for other and for personal candidates."""

    share: float
    votes: tuple[tuple[tuple[float, ...], tuple[float, ...]], ...]

    def posterior(self, pattern: Sequence[int]) -> float:
        odds = math.log(self.share) - math.log(1 - self.share)
        for (other, personal), vote in zip(self.votes, pattern, strict=True):
            odds += math.log(personal[vote + 1]) - math.log(other[vote + 1])
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def estimate(patterns: dict[tuple[int, ...], int], rounds: int = 100) -> Reliability:
    """Expectation-maximisation over counted vote patterns, started at the majority votes."""
    if not patterns:
        even = (1 / 3, 1 / 3, 1 / 3)
        return Reliability(0.5, tuple((even, even) for _ in LABELERS))
    width = len(next(iter(patterns)))
    likely = {
        p: (1 + 2 * p.count(1)) / (2 + 2 * p.count(1) + 2 * p.count(0) + 0.5 * (p.count(1) == 0))
        for p in patterns
    }
    found = None
    for _ in range(rounds):
        total = sum(patterns.values())
        share = (sum(likely[p] * n for p, n in patterns.items()) + 1) / (total + 2)
        votes = []
        for i in range(width):
            # The prior lets a vote for a class speak for it unless the data say otherwise.
            sides = ([1.0, 2.0, 0.5], [1.0, 0.5, 2.0])
            for p, n in patterns.items():
                sides[0][p[i] + 1] += (1 - likely[p]) * n
                sides[1][p[i] + 1] += likely[p] * n
            votes.append(tuple(tuple(x / sum(s) for x in s) for s in sides))
        found = Reliability(share, tuple(votes))
        likely = {p: found.posterior(p) for p in patterns}
    return found


@dataclass(frozen=True)
class Classifier:
    """Weights of the final span classifier."""

    bias: float
    votes: tuple[tuple[float, float], ...]
    kinds: dict[str, float]
    long: tuple[float, ...]
    mixed: tuple[float, ...]

    def accepts(self) -> str:
        """SQL condition on a candidate ``x``."""
        terms = [repr(self.bias)]
        for i, (no, yes) in enumerate(self.votes):
            terms.append(
                f"CASE x.votes[{i}] WHEN 0 THEN {no!r} WHEN 1 THEN {yes!r} ELSE 0.0 END"
            )
        for name, values in (("long", self.long), ("mixed", self.mixed)):
            cases = " ".join(f"WHEN {i} THEN {v!r}" for i, v in enumerate(values))
            terms.append(f"CASE x.{name} {cases} ELSE 0.0 END")
        cases = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in self.kinds.items())
        terms.append(f"CASE x.kind {cases} ELSE 0.0 END")
        return "CAST(" + " + ".join(f"CAST({t} AS DOUBLE)" for t in terms) + " AS DOUBLE) > 0"


def train(rows: Sequence, reliability: Reliability, rounds: int = 300) -> Classifier:
    """Logistic regression on the likelihoods; ``rows`` hold votes, kind, long, mixed and n."""
    width = 1 + 2 * len(LABELERS) + len(KINDS) + 6

    def inputs(row) -> list[int]:
        on = [0]
        on += [1 + 2 * i + v for i, v in enumerate(row.votes) if v != ABSTAIN]
        at = 1 + 2 * len(LABELERS)
        return [*on, at + KINDS.index(row.kind), at + len(KINDS) + row.long,
                at + len(KINDS) + 3 + row.mixed]

    cases = [(inputs(r), reliability.posterior(r.votes), r.n) for r in rows]
    total = max(1, sum(n for *_, n in cases))
    w, memory = [0.0] * width, [1e-8] * width
    for _ in range(rounds):
        slope = [-0.0005 * x for x in w]
        for on, likely, n in cases:
            z = sum(w[i] for i in on)
            off = (likely - 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))) * n / total
            for i in on:
                slope[i] += off
        for i, g in enumerate(slope):
            memory[i] += g * g
            w[i] += 0.3 * g / math.sqrt(memory[i])
    at = 1 + 2 * len(LABELERS)
    return Classifier(
        w[0] if cases else -1.0,
        tuple((w[1 + 2 * i], w[2 + 2 * i]) for i in range(len(LABELERS))),
        dict(zip(KINDS, w[at : at + len(KINDS)], strict=True)),
        tuple(w[at + len(KINDS) : at + len(KINDS) + 3]),
        tuple(w[at + len(KINDS) + 3 :]),
    )


def fit(found: DataFrame) -> tuple[Reliability, Classifier]:
    """Estimate the labelers and train the classifier from a table of candidates."""
    rows = (
        found.select(F.explode("candidates").alias("c"))
        .groupBy("c.votes", "c.kind", "c.long", "c.mixed")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("votes", "kind", "long", "mixed")
        .collect()  # at most one row for each pattern of votes, kind and shape
    )
    patterns: dict[tuple[int, ...], int] = {}
    for r in rows:
        patterns[tuple(r.votes)] = patterns.get(tuple(r.votes), 0) + r.n
    reliability = estimate(patterns)
    return reliability, train(rows, reliability)


def find(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and all ``spans`` (arrays of kind, start and end) of every document."""
    found = checkpointed(candidates(documents, doc_id, text))
    _, classifier = fit(found)
    return found.select("doc_id", *_spans(classifier))


def _spans(classifier: Classifier) -> tuple[Column, Column]:
    order = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {i + 4}" for i, k in enumerate(KINDS)) + " END"
    added = (
        f"transform(filter(candidates, x -> {classifier.accepts()}), x -> named_struct("
        f"'start', x.start, 'order', {order}, 'kind', x.kind, 'end', x.end))"
    )
    plain = "transform({}, x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end))"
    return (
        F.expr(plain.format("base")).alias("base"),
        F.expr(plain.format(f"array_sort(concat(base, {added}))")).alias("spans"),
    )


def redact(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets."""
    _, classifier = fit(checkpointed(candidates(documents, doc_id, text)))
    # The same row-wise search again, with the whole row beside it: no join, no shuffle.
    kept = {f"own_{i}": c for i, c in enumerate(documents.columns)}
    given = next(new for new, c in kept.items() if c.lower() == text.lower())
    df = _searched(documents, text, kept).select(*kept, _spans(classifier)[1])
    merged = (
        "aggregate(spans, CAST(array() AS array<struct<kind:string,start:int,end:int>>), (m, x) ->"
        " CASE WHEN size(m) > 0 AND element_at(m, -1).end > x.start"
        " THEN concat(slice(m, 1, size(m) - 1), array(named_struct('kind', element_at(m, -1).kind,"
        " 'start', element_at(m, -1).start, 'end', greatest(element_at(m, -1).end, x.end))))"
        " ELSE concat(m, array(x)) END)"
    )
    df = once(df.withColumn("t", F.col(given)), s=F.expr(merged))
    parts = (
        "transform(s, (x, i) -> concat(substring(t, coalesce(get(s, i - 1).end, 0) + 1,"
        " x.start - coalesce(get(s, i - 1).end, 0)), '<', upper(x.kind), '>'))"
    )
    joined = (
        f"CASE WHEN size(s) = 0 THEN t ELSE concat(array_join({parts}, ''),"
        " substring(t, element_at(s, -1).end + 1)) END"
    )
    return df.select(
        *((F.expr(joined) if new == given else F.col(new)).alias(c) for new, c in kept.items())
    )


def _joined(spans: str) -> Column:
    return F.expr(
        f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
    )


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document, with counts and a digest of the base kinds."""
    found = find(table(spark, sf_dir, "documents"))
    counts = [
        F.expr(f"CAST(size(filter(base, x -> x.kind = '{k}')) AS BIGINT)").alias(f"n_{k}")
        for k in BASE
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans")
    )
