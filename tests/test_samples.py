"""Names that contain patterns, against brute force over all pairs."""

import random

import pytest
from tesserae.operators import samples as people
from tesserae.plans import queries

RNG = random.Random(4)
NAMES = [None, "", "a", "éa", "aaaa", "S#001", "S#001", "日本b", *("".join(RNG.choices("abé#", k=k % 9)) for k in range(60))]
PATTERNS = [(None, "0", 90), ("", "1", 91), ("a", None, 92), ("aa", "1", 93), ("aa", "1", 94), ("é", "0", None), ("本b", "2", 95), ("longer than any name", "0", 96), ("001", "0", 97)]
PATTERNS += [("".join(RNG.choices("abé#", k=2 + k % 3)), str(k % 3), k) for k in range(20)]


def tables(spark):
    names = spark.createDataFrame([(n,) for n in NAMES], "name string").repartition(3)
    return names, spark.createDataFrame(PATTERNS, "pattern string, status string, line long")


def pairs(patterns=PATTERNS):
    return [(n, *p) for n in NAMES for p in patterns if n is not None and p[0] is not None and p[0] in n]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast_rows", [100_000, 3])
def test_every_name_with_every_pattern_in_it(spark, broadcast_rows):
    names, patterns = tables(spark)
    found = people.match_patterns(names, patterns, broadcast_rows)
    assert found.columns == ["name", "pattern", "status", "line"]
    assert ordered(found.collect()) == ordered(pairs())
    assert "NestedLoop" not in plan(found)
    assert people.match_patterns(names, patterns.limit(0), broadcast_rows).count() == 0


def met(df):
    """Rows of names and patterns that meet in ``df``, by its executed plan."""
    df.collect()
    steps, found = [df._jdf.queryExecution().executedPlan()], []
    while steps:
        step = steps.pop()
        if step.nodeName() == "AdaptiveSparkPlan":
            steps.append(step.executedPlan())
        elif step.nodeName().endswith("QueryStage"):
            steps.append(step.plan())
        if "Join" in step.nodeName() and "_piece" in step.toString().split("\n")[0]:
            found.append(step.metrics().apply("numOutputRows").value())
        steps += [step.children().apply(k) for k in range(step.children().size())]
    assert len(found) == 1
    return found[0]


def copies(spark):
    """Names and patterns, each row twice more."""
    names, patterns = tables(spark)
    return names.unionByName(names).unionByName(names), patterns.unionByName(patterns).unionByName(patterns)


def test_case_control_counts_equal_patterns_once(spark):
    expected = []
    for n in NAMES:
        held = [p for m, p, s, _ in pairs() if m == n]
        status = {s for m, _, s, _ in pairs() if m == n}
        expected.append((n, int(*status) if len(held) == 1 and status <= {"0", "1"} else None))
    assert ordered(people.case_control(*tables(spark)).collect()) == ordered(expected)
    assert any(status is not None for _, status in expected)
    many = people.case_control(*copies(spark))
    assert met(many) == len({(n, p) for n, p, _, _ in pairs()})
    assert ordered(many.collect()) == ordered([(n, None) for n in NAMES] * 3)


def test_case_flags_counts_equal_patterns_once(spark):
    held = [sum(1 for m, *_ in pairs() if m == n) for n in NAMES]
    assert ordered(people.case_flags(*tables(spark)).collect()) == ordered([(n, k > 0, k) for n, k in zip(NAMES, held)])
    many = people.case_flags(*copies(spark))
    assert met(many) == len({(n, p) for n, p, _, _ in pairs()})
    assert ordered(many.collect()) == ordered([(n, k > 0, 9 * k) for n, k in zip(NAMES, held)] * 3)


def test_phenotype_takes_the_last_line(spark):
    names, patterns = tables(spark)
    table = patterns.withColumnRenamed("status", "value")
    lines = [max(((line, value) for m, _, value, line in pairs() if m == n and line is not None), default=(None, None)) for n in NAMES]
    assert ordered(people.phenotype(names, table).collect()) == ordered((n, value) for n, (_, value) in zip(NAMES, lines))
    rows, patterns = copies(spark)
    many = people.phenotype(rows, patterns.withColumnRenamed("status", "value"))
    assert met(many) == len({(n, p) for n, p, _, line in pairs() if line is not None})
    assert ordered(many.collect()) == ordered([(n, value) for n, (_, value) in zip(NAMES, lines)] * 3)


def test_phenotype_query_has_each_name_once(spark, tmp_path):
    spark.createDataFrame([("Customer#001",), ("Customer#001",), ("none",), (None,), (None,)], "c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, "first"), (10, "second")], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    found = queries.QUERIES["phenotype"](spark, str(tmp_path))
    assert ordered(found.collect()) == ordered([("Customer#001", "first"), ("none", None), (None, None)])
