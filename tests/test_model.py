import random
from collections import Counter, defaultdict

import pytest

from fundgraph.operators import classify as K
from fundgraph.operators import features as FT
from fundgraph.operators import metrics as M


def test_split_has_exact_class_shares_and_is_repeatable(spark):
    df = spark.createDataFrame([(f"e{i}", int(i % 4 == 0)) for i in range(203)], "ein string, label int")
    a = FT.stratified_split(df)
    got = Counter((r.label, r.split) for r in a.collect())
    for label, n in Counter(int(i % 4 == 0) for i in range(203)).items():
        test = int(n * 0.2 + 0.5)
        val = int((n - test) * 0.15 + 0.5)
        assert got[label, "test"] == test and got[label, "val"] == val and got[label, "train"] == n - test - val
    assert {(r.ein, r.split) for r in a.collect()} == {(r.ein, r.split) for r in FT.stratified_split(df).collect()}


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = [(r.a, r.b) for r in FT.standardize(df, ["a", "b"]).orderBy("a").collect()]
    assert got[2][0] == pytest.approx(1.2247448714) and [g[1] for g in got] == [0.0, 0.0, 0.0]


def test_propagation_against_plain_means(spark):
    rnd = random.Random(3)
    f = {f"f{i}": rnd.random() for i in range(12)}
    m = {f"m{i}": rnd.random() for i in range(5)}
    e = [(rnd.choice(sorted(f)), rnd.choice(sorted(m))) for _ in range(25)] + [("f0", "gone")]
    got = {r.ein: r for r in FT.propagate(
        spark.createDataFrame(sorted(f.items()), "ein string, x double"), spark.createDataFrame(sorted(m.items()), "ein string, y double"),
        spark.createDataFrame(e, "fund_ein string, manager_ein string"), 3).collect()}
    e = e[:-1]
    hop_f, hop_m = dict(f), dict(m)
    for i in range(1, 4):
        at_f, at_m = defaultdict(list), defaultdict(list)
        for a, b in e:
            if b in hop_m:
                at_f[a].append(hop_m[b])
            if a in hop_f:
                at_m[b].append(hop_f[a])
        hop_f = {a: sum(v) / len(v) for a, v in at_f.items()}
        hop_m = {b: sum(v) / len(v) for b, v in at_m.items()}
        name = f"{'y' if i % 2 else 'x'}_h{i}"
        for a in f:
            assert got[a][name] == pytest.approx(hop_f.get(a, 0.0))


def test_metrics_against_counting(spark):
    rnd = random.Random(9)
    data = [(rnd.randrange(2), rnd.randrange(2), rnd.randrange(1, 10) / 10) for _ in range(80)]
    p = spark.createDataFrame(data, "label int, prediction int, probability_1 double")
    pos, neg = [s for y, _, s in data if y], [s for y, _, s in data if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert M.roc_auc(p).first().auc == pytest.approx(want)
    acc = sum(y == z for y, z, _ in data) / len(data)
    w = M.weighted_prf(p).first()
    assert w.recall == pytest.approx(acc)
    assert {r.row for r in M.classification_report(p).collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}


def test_metrics_with_one_class_and_a_class_never_predicted(spark):
    one = spark.createDataFrame([(1, 1, 0.5), (1, 1, 0.6)], "label int, prediction int, probability_1 double")
    assert M.roc_auc(one).first().auc == 0.0
    never = spark.createDataFrame([(0, 1, 0.5), (1, 1, 0.6)], "label int, prediction int, probability_1 double")
    by = {r["class"]: r.precision for r in M.per_class(never).collect()}
    assert by == {0: 0.0, 1: 0.5}
    assert M.weighted_prf(never).first().precision == pytest.approx(0.25)


@pytest.mark.parametrize("kind", ["logistic", "forest", "perceptron"])
def test_classifiers_learn_save_and_load(spark, tmp_path, kind):
    rnd = random.Random(1)
    data = [(float(x), float(rnd.random()), int(x > 7)) for x in [rnd.random() * 10 for _ in range(200)]]
    df = spark.createDataFrame(data, "a double, b double, label int")
    model = K.fit_classifier(df, ["a", "b"], kind, **({"numTrees": 5} if kind == "forest" else {}))
    K.save_model(model, str(tmp_path / kind))
    pred = K.predict(K.load_model(str(tmp_path / kind)), df)
    assert K.evaluate(pred)["auc"] > 0.9
    assert pred.columns == ["a", "b", "label", "prediction", "probability_1"]


def test_best_by(spark):
    r = K.results_table(spark.range(1), [(1, dict(f1=0.5, auc=0.0, precision=0.0, recall=0.0)), (2, dict(f1=0.7, auc=0.0, precision=0.0, recall=0.0)), (3, dict(f1=0.7, auc=0.0, precision=0.0, recall=0.0))], "layers")
    assert M.best_by(r.withColumn("auc", r.auc.cast("double")), "layers", "f1").first().layers == 2
