import random

from conftest import rows
from test_columns import lcs

from fundgraph.operators import entity as E


def score(a, b):
    return 100.0 if a == b else 200.0 * lcs(a, b) / (len(a) + len(b))


def names(rnd, n):
    base = ["".join(rnd.choice("ABCDEFGH") for _ in range(rnd.choice([1, 2, 3, 4, 6, 9, 14, 25]))) for _ in range(n)]
    out = set(base)
    for b in base:
        s = list(b)
        for _ in range(rnd.choice([1, 1, 2])):
            i = rnd.randrange(len(s) + 1)
            s[i:i + rnd.randrange(2)] = [rnd.choice("ABCDEFGH")] if rnd.random() < 0.7 else []
        out.add("".join(s))
    return sorted(x for x in out if x)


def test_blocking_loses_no_pair(spark):
    ns = names(random.Random(3), 120)
    df = spark.createDataFrame([(n,) for n in ns], "name string")
    for threshold in (85, 70):
        got = {(r.a, r.b): r.score for r in E.similar_names(df, threshold=threshold).collect()}
        want = {(a, b): score(a, b) for i, a in enumerate(ns) for b in ns[i + 1:] if score(a, b) >= threshold}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def sequential(rows_, threshold=85):
    """The plain loop: (ein, sorted_name) rows in order."""
    group, next_id = {}, 0
    for ein, name in rows_:
        if ein in group:
            continue
        for other, other_name in rows_:
            if other not in group and score(name, other_name) >= threshold:
                group[other] = next_id
        next_id += 1
    return group


def run(spark, data):
    df = spark.createDataFrame([(e, n, n) for e, n in data], "ein string, name string, sorted_name string")
    return {r.ein: r.parent_group_id for r in E.greedy_groups(df, E.similar_names(df, "sorted_name")).collect()}


def test_grouping_depends_on_order(spark):
    data = [("1", "ABCDEFGHIJKLMNOPQRST"), ("2", "ABCDEFGHIJKLMNOPQXYZ"), ("3", "ABCDEFGHIJKLMXXXQXYZ")]
    assert score(data[0][1], data[1][1]) >= 85 > score(data[0][1], data[2][1]) and score(data[1][1], data[2][1]) >= 85
    assert run(spark, data) == {"1": 0, "2": 0, "3": 1}
    df = spark.createDataFrame(data, "ein string, sorted_name string")
    comp = E.component_groups(df, E.similar_names(df, "sorted_name"))
    assert rows(comp, "ein", "component") == [("1", "1"), ("2", "1"), ("3", "1")]


def test_parallel_groups_equal_the_sequential_loop(spark):
    for seed in (1, 2):
        rnd = random.Random(seed)
        pool = names(rnd, 25) + [""]
        data = sorted({(f"{rnd.randrange(40):03d}", rnd.choice(pool)) for _ in range(110)})
        assert run(spark, data) == sequential(data)


def test_one_ein_with_two_spellings_is_flagged_alone(spark):
    m = spark.createDataFrame([("1", "ACME FUND ONE", 1.0, 1), ("1", "ACME FUND OONE", 1.0, 1), ("2", "Jane Doe", 1.0, 1)], "ein string, name string, total_fees double, num_clients int")
    out = E.enrich_managers(m)
    assert rows(out, "ein", "parent_group_id", "group_size", "same_parent_flag") == [("1", 0, 2, 1)] * 2
    from fundgraph.operators.aggregates import group_sizes

    assert rows(group_sizes(out), "group_size", "distinct_eins") == [(2, 1)]


def test_candidates_grow_with_the_names_not_with_their_square(spark):
    rnd = random.Random(5)
    drawn = {"".join(rnd.choice("ABCD") for _ in range(16)) for _ in range(1500)}
    near = {n[:3] + n[4:] for n in sorted(drawn)[:100]}
    df = spark.createDataFrame([(n, len(n)) for n in sorted(drawn | near)], "name string, len int")
    got = {(r.a, r.b) for r in E.candidate_pairs(df, E.Bounds(85)).collect()}
    assert {tuple(sorted((n, n[:3] + n[4:]))) for n in sorted(drawn)[:100]} <= got
    # nothing but pairs that reach the threshold: names in few letters share many short grams
    assert all(score(a, b) >= 85 for a, b in got)


def test_grams_and_subsequences_share_the_length_sums(spark):
    ns = names(random.Random(8), 100) + ["ABCDEFGH" * 4, "ABCDEFGH" * 4 + "A", "HGFEDCBA" * 4]
    df = spark.createDataFrame([(n, len(n)) for n in ns], "name string, len int")
    bounds = E.Bounds(85)
    settled, left_out = bounds.by_subsequence({len(n) for n in ns})
    assert settled and left_out and 65 not in settled
    got = [(r.a, r.b) for r in E.candidate_pairs(df, bounds).collect()]
    want = {(a, b) for i, a in enumerate(sorted(ns)) for b in sorted(ns)[i + 1:] if score(a, b) >= 85}
    assert want <= set(got) and len(got) == len(set(got))
