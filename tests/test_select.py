"""Chi-square, associations, stratified split."""

import math

import pytest

from outletlab.functions import stats
from outletlab.functions.stats import chi2_sf_scalar
from outletlab.operators import select as sel


def test_chi2_survival_known_values():
    assert abs(chi2_sf_scalar(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(chi2_sf_scalar(9.210340371976184, 2) - 0.01) < 1e-12   # exp(-x/2) for dof 2
    assert abs(chi2_sf_scalar(4.0, 2) - math.exp(-2.0)) < 1e-12
    for x, dof in [(30.0, 40), (3.0, 10), (80.0, 60), (0.5, 4)]:
        m, h = dof // 2, x / 2  # even dof: exp(-x/2) * sum_{i<m} (x/2)^i / i!
        exact = math.exp(-h) * sum(h ** i / math.factorial(i) for i in range(m))
        assert abs(chi2_sf_scalar(x, dof) - exact) < 1e-10
    assert chi2_sf_scalar(0.0, 3) == 1.0 and chi2_sf_scalar(5.0, 0) == 1.0


def test_chi2_survival_at_any_size():
    """No cap: statistic half a deviation under the mean, up to 1e9 degrees of freedom."""
    for dof in (1e3, 1e4, 1e5, 1e6, 1e7, 1e8, 1e9):
        for z in (-3.0, -0.5, 0.0, 2.0):
            x = dof + z * math.sqrt(2 * dof)
            t = (x / dof) ** (1 / 3)  # cube-root approximation, good to 1 / dof
            approx = 0.5 * math.erfc((t - (1 - 2 / (9 * dof))) / math.sqrt(2 / (9 * dof)) / math.sqrt(2))
            assert abs(chi2_sf_scalar(x, dof) - approx) < 3e-4 / math.sqrt(dof / 1e3)
    for dof in (9_990, 10_000, 10_010):  # the two methods meet
        assert abs(stats._upper_uniform(dof / 2, 4_970.0) - (1 - stats._lower_series(dof / 2, 4_970.0))) < 1e-9
    assert chi2_sf_scalar(float("inf"), 3) == 0.0 and math.isnan(chi2_sf_scalar(float("nan"), 3))


def expected_chi2(table, yates):
    rows = [sum(r) for r in table]
    cols = [sum(c) for c in zip(*table)]
    n = sum(rows)
    s = 0.0
    for i, r in enumerate(table):
        for j, o in enumerate(r):
            e = rows[i] * cols[j] / n
            d = abs(o - e)
            if yates:
                d -= min(0.5, d)
            s += d * d / e
    return s


def frame(spark, table, xs, ys):
    rows = []
    for i, y in enumerate(ys):
        for j, x in enumerate(xs):
            rows += [(x, y)] * table[i][j]
    return spark.createDataFrame(rows, "x string, y string")


def test_chi_square_2x2_uses_yates(spark):
    t = [[10, 2], [3, 15]]
    out = sel.chi_square(frame(spark, t, ["a", "b"], ["p", "q"]), ["x"], "y").first()
    assert out.dof == 1
    assert abs(out.chi2 - expected_chi2(t, True)) < 1e-9
    assert out.important


def test_chi_square_larger_table_with_empty_cell_and_null_category(spark):
    t = [[5, 0, 7], [3, 9, 1]]
    df = frame(spark, t, ["a", "b", None], ["p", "q"])
    out = sel.chi_square(df, ["x"], "y").first()
    assert out.dof == 2
    assert abs(out.chi2 - expected_chi2(t, False)) < 1e-9
    assert abs(out.p_value - chi2_sf_scalar(out.chi2, 2)) < 1e-12


def test_chi_square_single_value_feature(spark):
    df = spark.createDataFrame([("a", "p"), ("a", "q"), ("a", "q")], "x string, y string")
    out = sel.chi_square(df, ["x"], "y").first()
    assert out.dof == 0 and abs(out.chi2) < 1e-12 and out.p_value == 1.0


def test_associations_and_signed_pruning(spark):
    rows = [(float(i), 2.0 * i + 1, -3.0 * i, float(i % 3), "u" if i % 2 else "v", "s" if i % 2 else "t")
            for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, k string, m string")
    feats = ["a", "b", "c", "d", "k", "m"]
    assoc = sel.associations(df, feats)
    got = {(r.feature_a, r.feature_b): r for r in assoc.collect()}
    assert len(got) == 15
    assert abs(got[("a", "b")].assoc - 1.0) < 1e-12 and got[("a", "b")].kind == "pearson"
    assert abs(got[("a", "c")].assoc + 1.0) < 1e-12
    assert abs(got[("k", "m")].assoc - 1.0) < 1e-12 and got[("k", "m")].kind == "cramers_v"
    assert got[("d", "k")].kind == "eta" and 0 <= got[("d", "k")].assoc <= 1
    pruned = {r.feature: r.dropped for r in sel.association_prune(assoc, feats).collect()}
    assert pruned["b"] and not pruned["c"] and pruned["m"] and not pruned["a"]
    absolute = {r.feature: r.dropped for r in sel.association_prune(assoc, feats, absolute=True).collect()}
    assert absolute["c"]


@pytest.mark.parametrize("parts", [1, 7])
def test_stratified_split_properties(spark, parts):
    rows = [(f"{i:010d}", "A" if i % 3 else ("B" if i % 2 else None)) for i in range(500)]
    df = spark.createDataFrame(rows, "CUSTOMER string, label string").repartition(parts)
    tagged = sel.split_labels(df, "label", "CUSTOMER", 0.8, bucket_hex=2)
    got = {r.CUSTOMER: r.split for r in tagged.collect()}
    assert len(got) == 500
    by_label = {}
    for key, lab in rows:
        by_label.setdefault(lab, []).append(key)
    import hashlib
    for lab, keys in by_label.items():
        order = sorted(keys, key=lambda k: (hashlib.md5(k.encode()).hexdigest(), k))
        k = math.floor(0.8 * len(keys))
        assert {x for x in order[:k]} == {x for x in keys if got[x] == "train"}
    train, test = sel.stratified_split_train_test(df, 0.8, "label", "CUSTOMER")
    tr = {r.CUSTOMER for r in train.collect()}
    te = {r.CUSTOMER for r in test.collect()}
    assert not (tr & te) and len(tr | te) == 500


def test_null_and_repeated_keys_are_in_one_part(spark):
    rows = [(None, "A"), ("a", "A"), ("c", "A"), ("d", "A"), ("e", "A"), ("e", "A"), ("z", None), ("y", None)]
    df = spark.createDataFrame(rows, "CUSTOMER string, label string")
    train, test = sel.stratified_split_train_test(df, 0.5, "label", "CUSTOMER")
    tr, te = ([(r.CUSTOMER, r.label) for r in part.collect()] for part in (train, test))
    assert sorted(map(str, tr + te)) == sorted(map(str, rows)) and not set(tr) & set(te)
    assert (None, "A") in tr


def test_eta_does_not_depend_on_the_offset(spark):
    rows = [(str(i % 7), (i * 37 % 101) / 10 + (i % 7)) for i in range(1000)]
    eta = []
    for offset in (0.0, 1e9):
        df = spark.createDataFrame([(k, y + offset) for k, y in rows], "k string, y double")
        eta.append(sel.associations(df, ["k", "y"]).first().assoc)
    assert abs(eta[0] - eta[1]) < 1e-6 and 0.3 < eta[0] < 1


def test_associations_equal_sums_written_out(spark):
    """All kinds, with nulls, a constant, a column without values and many categories."""
    import random

    rng = random.Random(3)
    rows = []
    for i in range(700):
        x = rng.gauss(1e6, 3) if rng.random() > 0.1 else None
        rows.append((x, None if x is None else x * 0.5 + rng.gauss(0, 1), 7.25, None, rng.choice(["a", "b", None]), rng.choice("wxyz"),
                     f"v{rng.randrange(300)}", "one", i % 4))
    df = spark.createDataFrame(rows, "x double, y double, c double, e double, k string, m string, v string, o string, d int").repartition(5)
    feats = ["x", "k", "y", "c", "m", "e", "v", "o", "d"]
    got = {(r.feature_a, r.feature_b): (r.kind, r.assoc) for r in sel.associations(df, feats).collect()}
    column = {f: [r[i] for r in rows] for i, f in enumerate(["x", "y", "c", "e", "k", "m", "v", "o", "d"])}
    numbers = {"x", "y", "c", "e", "d"}
    for i, a in enumerate(feats):
        for b in feats[i + 1:]:
            both = [(p, q) for p, q in zip(column[a], column[b], strict=True) if p is not None and q is not None]
            if a in numbers and b in numbers:
                want = pearson(both)
                assert got[(a, b)][0] == "pearson"
            elif a in numbers or b in numbers:
                want = eta([(q, p) for p, q in both] if a in numbers else both)
                assert not both or got[(a, b)][0] == "eta"
            else:
                want = cramer(both)
                assert got[(a, b)][0] == "cramers_v"
            value = got.get((a, b), (None, None))[1]
            assert (value is None) == (want is None), (a, b, value, want)
            assert want is None or abs(value - want) < 1e-9, (a, b, value, want)


def pearson(rows):
    if not rows:
        return None
    ma, mb = (sum(c) / len(rows) for c in zip(*rows, strict=True))
    saa, sbb = sum((a - ma) ** 2 for a, _ in rows), sum((b - mb) ** 2 for _, b in rows)
    return sum((a - ma) * (b - mb) for a, b in rows) / math.sqrt(saa * sbb) if saa > 1e-9 and sbb > 1e-9 else None


def eta(rows):
    if not rows:
        return None
    groups = {}
    for k, y in rows:
        groups.setdefault(k, []).append(y)
    mean = sum(y for _, y in rows) / len(rows)
    total = sum((y - mean) ** 2 for _, y in rows)
    between = sum(len(g) * (sum(g) / len(g) - mean) ** 2 for g in groups.values())
    return math.sqrt(between / total) if total > 1e-9 else None


def cramer(rows):
    names = [sorted(set(c)) for c in zip(*rows, strict=True)]
    k = min(map(len, names)) - 1
    table = [[sum(1 for r in rows if r == (a, b)) for b in names[1]] for a in names[0]]
    return math.sqrt(expected_chi2(table, False) / (len(rows) * k)) if k > 0 else None


def test_associations_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x double, y double, k string, m string")
    assert [(r.feature_a, r.feature_b, r.assoc) for r in sel.associations(df, ["x", "y", "k", "m"]).collect()] == [("x", "y", None)]
