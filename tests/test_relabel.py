from logloom.operators.relabel import Rule, relabel


def run(spark, labels, *rules):
    df = spark.createDataFrame([(labels,)], "labels map<string,string>")
    rows = relabel(df, rules).collect()
    return rows[0].labels if rows else None


def test_rules(spark):
    base = {"a": "Node;x", "__pod_team": "red", "empty": ""}
    assert run(spark, base, Rule("keep", ("a",), "Node.*")) == base
    assert run(spark, base, Rule("keep", ("a",), "Nod")) is None
    assert run(spark, base, Rule("drop", ("a",), "Node.*")) is None
    got = run(spark, base, Rule(source=("a",), regex="Node;(.*)", target="node", replacement="${1}-n"))
    assert got == {**base, "node": "x-n"}
    assert run(spark, base, Rule(source=("a",), regex="Pod;(.*)", target="pod")) == base
    # an empty value removes the target; a missing source is empty
    assert "a" not in run(spark, base, Rule(source=("empty",), target="a"))
    assert "a" not in run(spark, base, Rule(source=("none",), target="a"))
    got = run(spark, base, Rule("labelmap", regex="__pod_(.+)"))
    assert got == {**base, "team": "red"}


def test_rules_see_earlier_rules(spark):
    got = run(
        spark, {"x": "1"}, Rule(source=("x",), target="y"),
        Rule(source=("y", "x"), regex="(.);(.)", target="z", replacement="$2$1!"),
        Rule("labelmap", regex="(z)", replacement="copy_$1"),
        Rule(source=("copy_z",), target="y"), Rule("keep", ("y",), "11!"),
    )
    assert got == {"x": "1", "y": "11!", "z": "11!", "copy_z": "11!"}
