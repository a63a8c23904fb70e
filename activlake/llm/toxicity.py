"""Toxic spans and document scores from a linear-chain conditional random field.

Training reads a bounded sample of labelled documents (``sample_docs``, the rows with the smallest
hashes). Spark counts in how many toxic and clean documents each token feature occurs (the whole
word, and its beginnings of four to eight letters); the features whose log-likelihood ratio passes
``least_evidence`` form the lexicon, ``max_features`` at most. Tokens of toxic documents whose
features lean towards toxic are labelled 1, all other tokens 0, and a two-state field is fitted to
windows of these labelled tokens (``max_windows`` at most) by gradient ascent on the likelihood.
At last a logistic curve from marginals to document labels is fitted on the sample.

Scoring runs the forward-backward recursion over every token of every text. Tokens without a
feature of the lexicon share one step matrix, so that a run of them is one matrix power. The
document score is the logistic curve over the sum, the maximum and the density of the tokens'
marginals; tokens with a marginal of one half or more form the offending spans.

The sample's bound is the only bound; the model is a few thousand numbers and travels with the
task. Scoring is one call per batch of rows: nothing is shuffled, any task can be repeated.

Edge cases: null and empty texts score as texts without tokens; a null id is neither held out nor
labelled; labels of one id that differ count as toxic; without labelled rows of both kinds every
score is the share of toxic labels (0 without labels); repeated rows are scored each; an empty
table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.llm.common import by_name, checkpointed, crc32_mod, free_name, table

TOKEN = re.compile(r"[^\W\d_]+")
BEGINNINGS = range(4, 9)
HEAD = min(BEGINNINGS)
AROUND = 4


def features(word: str) -> list[str]:
    """The whole word and its beginnings."""
    return ["=" + word, *("^" + word[:n] for n in BEGINNINGS if len(word) >= n)]


@dataclass
class Model:
    """Weights of the field and of the document curve."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    moves: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))
    curve: tuple[float, ...] = ()
    share: float = 0.0

    def __post_init__(self):
        self.heads = {f[1 : 1 + HEAD] for f in self.weights}
        step = np.exp(np.array(self.moves)) * np.array([1.0, math.exp(self.bias)])
        values, vectors = np.linalg.eig(step)
        order = np.argsort(-values.real)
        self._values = values.real[order]
        self._vectors = vectors.real[:, order]
        self._inverse = np.linalg.inv(self._vectors)
        self._powers: dict[int, tuple[float, float, float, float]] = {}

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def power(self, n: int) -> tuple[float, float, float, float]:
        """The step matrix of a token without features to the power n, up to a factor."""
        found = self._powers.get(n)
        if found is None:
            ratio = (self._values[1] / self._values[0]) ** n
            m = self._vectors @ np.diag([1.0, ratio]) @ self._inverse
            found = tuple(np.maximum(m, 1e-300).ravel().tolist())
            if len(self._powers) > 10_000:
                self._powers.clear()
            self._powers[n] = found
        return found

    def marginals(self, places: list[int], scores: list[float], n: int) -> list[float]:
        """Probability of the toxic state at ``places``, of ``n`` tokens in all."""
        (a, b), (c, d) = np.exp(np.array(self.moves)).tolist()
        forward, x, y, last = [], 1.0, 1.0, -1
        for place, score in zip(places, scores, strict=True):
            run = place - last - 1
            if last < 0 and run:
                x, y, run = 1.0, math.exp(self.bias), run - 1
            if run:
                p, q, r, s = self.power(run)
                x, y = x * p + y * r, x * q + y * s
            e = math.exp(min(score, 500.0))
            x, y = (1.0, e) if place == 0 else (x * a + y * c, (x * b + y * d) * e)
            x, y = x / (x + y), y / (x + y)
            forward.append((x, y))
            last = place
        backward, x, y, following, score = [], 1.0, 1.0, n, 0.0
        for place, own in zip(reversed(places), reversed(scores), strict=True):
            if following < n:  # over the token with features that follows
                e = math.exp(min(score, 500.0))
                x, y = a * x + b * y * e, c * x + d * y * e
            run = following - place - 1
            if run:
                p, q, r, s = self.power(run)
                x, y = p * x + q * y, r * x + s * y
            x, y = x / (x + y), y / (x + y)
            backward.append((x, y))
            following, score = place, own
        out = []
        for (fx, fy), (bx, by) in zip(forward, reversed(backward), strict=True):
            out.append(fy * by / (fx * bx + fy * by))
        return out

    def hits(self, text: str) -> tuple[list[int], list[str], int]:
        """Numbers of the tokens with features, these tokens, and how many tokens there are."""
        tokens = TOKEN.findall(text.lower())
        heads = self.heads
        places = [i for i, w in enumerate(tokens) if w[:HEAD] in heads]
        return places, [tokens[i] for i in places], len(tokens)

    def inputs(self, text: str) -> tuple[list[float], list[int], list[float]]:
        """Inputs of the document curve, the places and their marginals."""
        places, tokens, n = self.hits(text)
        if not places:
            return [0.0, 0.0, 0.0, 0.0], [], []
        m = self.marginals(places, [self.emission(w) for w in tokens], n)
        total = sum(m)
        kinds = len({w for w, p in zip(tokens, m, strict=True) if p >= 0.5})
        return [math.log1p(total), max(m), min(1.0, 20.0 * total / n), math.log1p(kinds)], places, m

    def score(self, text: str) -> tuple[float, list[dict]]:
        """The document score and the offending spans (code points, end exclusive)."""
        if not self.curve:
            return self.share, []
        inputs, places, marginals = self.inputs(text)
        z = self.curve[0] + sum(w * x for w, x in zip(self.curve[1:], inputs, strict=True))
        chosen = {i: p for i, p in zip(places, marginals, strict=True) if p >= 0.5}
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z)))), self._spans(text, chosen)

    @staticmethod
    def _spans(text: str, chosen: dict[int, float]) -> list[dict]:
        spans: list[dict] = []
        if not chosen:
            return spans
        lower = text.lower()
        if len(lower) == len(text):
            found = ((m.start(), m.end()) for m in TOKEN.finditer(lower))
        else:  # a letter whose lower case is longer: bring the places back to the text
            back = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
            found = ((back[m.start()], back[m.end() - 1] + 1) for m in TOKEN.finditer(lower))
        before = -2
        for i, (start, end) in enumerate(found):
            p = chosen.get(i)
            if p is None:
                continue
            if i == before + 1:
                spans[-1]["end"] = end
                spans[-1]["marginal"] = max(spans[-1]["marginal"], p)
            else:
                spans.append({"start": start, "end": end, "marginal": p})
            before = i
        return spans


def _evidence(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Signed log-likelihood ratio of a feature against the share of toxic documents."""
    n, share = toxic + clean, all_toxic / (all_toxic + all_clean)

    def part(k: float, expected: float) -> float:
        return k * math.log(k / expected) if k else 0.0

    value = 2 * (part(toxic, n * share) + part(clean, n * (1 - share)))
    return value if toxic > n * share else -value


def _lexicon(
    sample: DataFrame, totals: dict[int, int], least_evidence: float, max_features: int
) -> dict[str, float]:
    """Features with their log-odds; counted by Spark, chosen where the evidence is enough."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(part["text"], part["toxic"], strict=True):
                own = {f for w in set(TOKEN.findall((text or "").lower())) for f in features(w)}
                seen[int(toxic)].update(own)
            names = list(seen[0].keys() | seen[1].keys())
            if not names:  # only texts without tokens
                continue
            yield pd.DataFrame(
                {
                    "f": names,
                    "toxic": [seen[1][f] for f in names],
                    "clean": [seen[0][f] for f in names],
                }
            )

    all_toxic, all_clean = totals[1], totals[0]
    share = all_toxic / (all_toxic + all_clean)
    n = F.col("toxic") + F.col("clean")
    counted = (
        sample.mapInPandas(count, "f string, toxic long, clean long")
        .groupBy("f")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((n >= 3) & (F.col("toxic") > n * share))
        .orderBy((F.col("toxic") * F.col("toxic") / n).desc(), "f")
        .limit(4 * max_features)
        .collect()
    )
    strong = [
        r for r in counted if _evidence(r.toxic, r.clean, all_toxic, all_clean) >= least_evidence
    ][:max_features]
    return {
        r.f: math.log((r.toxic + 0.5) / (all_toxic + 1) / ((r.clean + 0.5) / (all_clean + 1)))
        for r in strong
    }


def _windows(
    sample: DataFrame, lexicon: dict[str, float], most: int
) -> list[tuple[list[str], int]]:
    """Windows of labelled tokens around the tokens with features, and some without."""
    finder = Model(weights=lexicon)

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for key, text, toxic in zip(part["key"], part["text"], part["toxic"], strict=True):
                places, _, n = finder.hits(text or "")
                tokens = TOKEN.findall((text or "").lower())
                chosen = places[:: max(1, len(places) // 4)][:4] or ([n // 2] if n else [])
                end = -1
                for place in chosen:
                    start = max(end, place - AROUND)
                    end = min(n, max(place, start) + AROUND + 1)
                    if end > start:
                        rows.append((key, start, tokens[start:end], int(toxic)))
            if rows:
                yield pd.DataFrame(rows, columns=["key", "start", "tokens", "toxic"])

    schema = "key long, start int, tokens array<string>, toxic int"
    chosen = sample.mapInPandas(cut, schema).orderBy("key", "start").limit(most)
    found = chosen.select("tokens", "toxic").toArrow()
    return list(zip(found["tokens"].to_pylist(), found["toxic"].to_pylist(), strict=True))


def _fit_field(
    windows: list[tuple[list[str], int]], lexicon: dict[str, float], rounds: int = 150
) -> Model:
    """Maximum likelihood with a small penalty, by adaptive gradient ascent."""
    names = list(lexicon)
    # Words whose beginning is in the lexicon get a weight of their own: they may be innocent.
    seen = Counter(
        "=" + w for own, _ in windows for w in own if any(f in lexicon for f in features(w)[1:])
    )
    names += [f for f, n in sorted(seen.items()) if n >= 3 and f not in lexicon]
    index = {f: i for i, f in enumerate(names)}
    rows, length = len(windows), max((len(own) for own, _ in windows), default=1)
    tag = np.zeros((rows, length))
    real = np.zeros((rows, length))
    r_at, t_at, f_at = [], [], []
    for r, (tokens, toxic_text) in enumerate(windows):
        for t, word in enumerate(tokens):
            real[r, t] = 1
            own = [f for f in features(word) if f in index]
            lean = next((lexicon[f] for f in own if f in lexicon), 0.0)
            tag[r, t] = float(toxic_text and lean > 0)
            for f in own:
                r_at.append(r), t_at.append(t), f_at.append(index[f])
    r_at, t_at, f_at = (np.array(x, dtype=int) for x in (r_at, t_at, f_at))
    k = len(names)
    w = np.concatenate([np.zeros(k), [-1.0], np.zeros(4)])
    memory = np.full(w.shape, 1e-8)
    after = real[:, 1:] * real[:, :-1]
    for _ in range(rounds):
        emit = np.zeros((rows, length))
        np.add.at(emit, (r_at, t_at), w[f_at])
        emit += w[k]
        moves = w[k + 1 :].reshape(2, 2)
        alpha = np.zeros((rows, length, 2))
        beta = np.zeros((rows, length, 2))
        alpha[:, 0, 1] = emit[:, 0]
        for t in range(1, length):
            step = np.logaddexp(
                alpha[:, t - 1, :1] + moves[0], alpha[:, t - 1, 1:] + moves[1]
            )
            step[:, 1] += emit[:, t]
            alpha[:, t] = np.where(real[:, t : t + 1] > 0, step, alpha[:, t - 1])
        for t in range(length - 2, -1, -1):
            ahead = beta[:, t + 1] + np.stack([np.zeros(rows), emit[:, t + 1]], axis=1)
            step = np.logaddexp(ahead[:, :1] + moves[:, 0], ahead[:, 1:] + moves[:, 1])
            beta[:, t] = np.where(real[:, t + 1 : t + 2] > 0, step, beta[:, t + 1])
        norm = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])[:, None]
        toxic = np.exp(alpha[:, :, 1] + beta[:, :, 1] - norm) * real
        off = (tag - toxic) * real
        gradient = np.zeros(w.shape)
        np.add.at(gradient, f_at, off[r_at, t_at])
        gradient[k] = off.sum()
        for i in (0, 1):
            for j in (0, 1):
                ahead = beta[:, 1:, j] + (emit[:, 1:] if j else 0.0)
                pair = np.exp(alpha[:, :-1, i] + moves[i, j] + ahead - norm) * after
                said = (tag[:, :-1] == i) * (tag[:, 1:] == j) * after
                gradient[k + 1 + 2 * i + j] = (said - pair).sum()
        gradient -= 0.5 * w
        memory += gradient**2
        w += 0.5 * gradient / np.sqrt(memory)
    moves = w[k + 1 :].reshape(2, 2).tolist()
    weights = {f: float(v) for f, v in zip(names, w[:k], strict=True) if abs(v) > 1e-9}
    return Model(weights, float(w[k]), tuple(map(tuple, moves)))


def _fit_curve(inputs: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small penalty."""
    x = np.hstack([np.ones((len(inputs), 1)), inputs])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (toxic - p) - 0.01 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
    return tuple(map(float, w))


def train(
    documents: DataFrame,
    labels: DataFrame,
    sample_docs: int = 20_000,
    max_windows: int = 12_000,
    max_features: int = 4_096,
    least_evidence: float = 25.0,
) -> Model:
    """Fit the model to labelled documents: ``labels`` holds ``doc_id`` and ``toxic``."""
    key = F.xxhash64("doc_id")
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(key, "doc_id")
        .limit(sample_docs)
    )
    sample = checkpointed(
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # sample_docs rows at most
        .select(key.alias("key"), "text", "toxic")
    )
    totals = {0: 0, 1: 0} | {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    share = totals[1] / max(1, totals[0] + totals[1])
    if not totals[0] or not totals[1]:
        return Model(share=share)
    lexicon = _lexicon(sample, totals, least_evidence, max_features)
    if not lexicon:
        return Model(share=share)
    model = _fit_field(_windows(sample, lexicon, max_windows), lexicon)

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame(
                [(*model.inputs(t or "")[0], k) for t, k in zip(part["text"], part["toxic"], strict=True)],
                columns=["a", "b", "c", "d", "toxic"],
            )

    measured = sample.mapInPandas(measure, "a double, b double, c double, d double, toxic int")
    rows = np.column_stack([column.to_numpy() for column in measured.toArrow().columns])
    model.curve = _fit_curve(rows[:, :4], rows[:, 4])
    model.share = share
    return model


SPANS = "array<struct<start:int,end:int,marginal:double>>"


def score(
    documents: DataFrame, model: Model, text: str = "text", into: str = "toxicity"
) -> DataFrame:
    """All columns of the documents and ``into``, a struct of ``score`` and ``spans``; a column
    that has this name already is replaced."""

    @F.pandas_udf(f"score double, spans {SPANS}")
    def scored(texts: pd.Series) -> pd.DataFrame:
        found = [model.score(t or "") for t in texts]
        return pd.DataFrame({"score": [s for s, _ in found], "spans": [p for _, p in found]})

    kept = [by_name(documents, c) for c in documents.columns if c.lower() != into.lower()]
    return documents.select(*kept, scored(by_name(documents, text)).alias(into))


def held_out() -> Column:
    """Documents whose labels the corpus model never sees."""
    return F.coalesce(crc32_mod(F.col("doc_id"), 5) == 0, F.lit(False))


def corpus_model(documents: DataFrame, labels: DataFrame) -> Model:
    """The model of a corpus, from all labels that are not held out."""
    return train(documents, labels.where(~held_out()))


def reject(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    mark = free_name(documents, "toxicity")
    scored = score(documents, corpus_model(documents, labels), into=mark)
    return scored.where(F.col(f"{mark}.score") < threshold).drop(mark)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, verdict and offending spans of every document."""
    documents = table(spark, sf_dir, "documents")
    rows = score(documents, corpus_model(documents, table(spark, sf_dir, "labels")))
    return rows.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.transform("toxicity.spans", lambda s: F.struct(s["start"], s["end"])).alias("spans"),
    )
