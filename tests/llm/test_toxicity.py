import itertools
import math

import pytest

from activlake.llm.toxicity import Model, corpus_model, held_out, op4_toxicity, reject, score, train


def brute(model, places, scores, n):
    """Marginals by summing over all tag sequences."""
    total, toxic = 0.0, [0.0] * len(places)
    emission = [model.bias] * n
    for p, s in zip(places, scores, strict=True):
        emission[p] = s
    for tags in itertools.product((0, 1), repeat=n):
        z = sum(e for e, t in zip(emission, tags, strict=True) if t)
        z += sum(model.moves[a][b] for a, b in zip(tags, tags[1:], strict=False))
        total += math.exp(z)
        for i, p in enumerate(places):
            toxic[i] += tags[p] * math.exp(z)
    return [t / total for t in toxic]


@pytest.mark.parametrize("places", [[0], [3], [7], [0, 1], [2, 5], [0, 3, 4, 7], list(range(8))])
def test_marginals_against_all_sequences(places):
    model = Model({"=x": 1.0}, -1.3, ((0.4, -0.7), (-0.2, 1.1)), (0.0,) * 5)
    scores = [(-1) ** i * 0.8 * i + 0.3 for i in range(len(places))]
    got = model.marginals(places, scores, 8)
    assert got == pytest.approx(brute(model, places, scores, 8), rel=1e-9)


def test_marginals_of_a_long_text_stay_finite():
    model = Model({"=x": 1.0}, -6.0, ((0.1, -0.1), (0.2, 1.0)), (0.0,) * 5)
    got = model.marginals([10, 900_000], [4.0, 400.0], 1_000_000)
    assert all(0 <= p <= 1 for p in got) and got[1] > 0.99


def test_spans_are_code_points_of_the_text():
    model = Model({"=idiot": 9.0, "^idio": 3.0}, -3.0, curve=(-4.0, 2.0, 6.0, 0.0, 0.0))
    text = "🙂 You IDIOT idiot, fine. İİ Idiot"
    found = model.score(text)
    assert found[0] > 0.5
    assert [text[s["start"] : s["end"]] for s in found[1]] == ["IDIOT idiot", "Idiot"]


def labelled(spark):
    rows, labels = [], []
    for i in range(400):  # every fourth is toxic
        bad = i % 4 == 0
        text = " ".join(f"w{chr(97 + (i * j) % 26)}{chr(97 + j % 26)}" for j in range(40))
        ends = (chr(97 + i % 23) + chr(97 + i % 19), chr(97 + i % 17) + chr(97 + i % 13))
        more = f" grumble{ends[0]} you grumble{ends[1]}" if bad else " you"
        rows.append((i, text + more, 7, "s"))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity int, held_out string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_beginnings_generalise_and_clean_texts_stay(spark):
    docs, labels = labelled(spark)
    model = train(docs, labels)
    assert model.score("a fine day")[0] < 0.1 < 0.5 < model.score("a grumblequx and grumbleqab")[0]
    assert model.score("")[0] == model.score("a fine day")[0]


def test_nulls_repeats_labels_that_differ_and_empty_tables(spark):
    docs, labels = labelled(spark)
    odd = spark.createDataFrame([(None, None, 1, "x"), (1, "", 1, "x"), (1, "", 1, "x")], docs.schema)
    more = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], labels.schema)
    every = docs.union(odd)
    got = score(every, corpus_model(every, labels.union(more)))
    assert got.count() == 403
    nulls = got.where("doc_id IS NULL").select("toxicity.score", held_out().alias("out")).collect()
    assert [(r.out, 0 <= r.score <= 1) for r in nulls] == [(False, True)]
    assert score(docs.limit(0), corpus_model(docs.limit(0), labels)).count() == 0
    unlabelled = score(docs, corpus_model(docs, labels.limit(0)))
    assert {r.toxicity.score for r in unlabelled.collect()} == {0.0}
    kept = reject(every, labels)
    assert kept.columns == docs.columns and kept.where("toxicity = 7").count() == 300
    assert kept.where("doc_id IS NULL").count() == 1
    one_kind = train(docs, labels.where("toxic = 1"))
    assert one_kind.score("anything")[0] == 1.0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    try:
        labels = spark.read.parquet(f"{sf}/labels.parquet")
    except Exception:
        pytest.skip("driver tables are not on this machine")
    rows = op4_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert right >= 0.93 * len(rows)
    assert sum(r.predicted and not r.toxic for r in rows) <= 2


def test_scores_do_not_depend_on_other_columns(spark):
    docs, labels = labelled(spark)
    model = train(docs, labels)
    a = score(docs.select("doc_id", "text"), model)
    assert {r.doc_id: r.toxicity.score for r in a.collect()} == {
        r.doc_id: r.toxicity.score for r in score(docs, model).collect()
    }
