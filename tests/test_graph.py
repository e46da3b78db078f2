import pytest
from pyspark.sql import functions as F

from qirtas.graph import Graph, last_per
from qirtas.operators import joins, quality, resolve
from qirtas.operators.skew import salted_join


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def graph(spark):
    g = Graph().create_nodes("A", frame(spark, [(1, "x"), (2, "y"), (3, "z")], "a int, name string"), "a")
    g = g.create_nodes("B", frame(spark, [(10,), (20,)], "b int"), "b")
    return g.create_edges("E", "A", "B", frame(spark, [(1, 10), (2, 10), (2, 20), (9, 10), (3, None)], "src_key int, dst_key int"))


def test_edges_without_ends_are_dropped(graph, spark):
    assert graph.edges["E", "A", "B"].count() == 3
    outcome = graph.edge_outcome("A", "B", frame(spark, [(1, 10), (9, 10), (1, None)], "src_key int, dst_key int")).first()
    assert tuple(outcome) == (3, 1, 2)


def test_match_reverse_chain(graph):
    assert {(r.s_name, r.dst_key) for r in graph.match("E", "A", "B", ["name"]).collect()} == {("x", 10), ("y", 10), ("y", 20)}
    turned = graph.reverse("E", "A", "B", "R", rank=1)
    assert {tuple(r) for r in turned.edges["R", "B", "A"].select("src_key", "dst_key", "rank").collect()} == {(10, 1, 1), (10, 2, 1), (20, 2, 1)}
    assert turned.chain(("R", "B", "A")).count() == 3


def test_delete_and_orphans(graph):
    assert [r.a for r in graph.orphans("A", [("E", "A", "B")]).collect()] == [3]
    less = graph.delete_scope([("E", "A", "B")], F.col("b") == 20)
    assert {r.a for r in less.nodes["A"].collect()} == {1, 3}
    assert less.edges["E", "A", "B"].count() == 1
    assert graph.drop_orphans("A", [("E", "A", "B")]).nodes["A"].count() == 2
    assert graph.clear("B").edges == {}


def test_merge_is_idempotent(graph, spark):
    rows = frame(spark, [(1, 10, "p", 1, 1), (1, 10, "q", 2, 2), (1, 10, "p", 3, 3)], "src_key int, dst_key int, label string, v int, seq int")
    g = Graph(graph.nodes, {}, graph.keys)
    once = g.merge_edges_set("M", "A", "B", rows, ["seq"], ["label"])
    twice = once.merge_edges_set("M", "A", "B", rows, ["seq"], ["label"])
    for x in (once, twice):
        assert {(r.label, r.v) for r in x.edges["M", "A", "B"].collect()} == {("p", 3), ("q", 2)}
    ends = g.merge_edges_set("M", "A", "B", rows, ["seq"])
    assert [(r.label, r.v) for r in ends.edges["M", "A", "B"].collect()] == [("p", 3)]
    assert g.merge_edges("M", "A", "B", rows.select("src_key", "dst_key")).edges["M", "A", "B"].count() == 1


def test_read_only_and_files(graph, spark, tmp_path):
    with pytest.raises(ValueError):
        Graph(writable=False).merge_edges("E", "A", "B", None)
    graph.save(f"file://{tmp_path}/g")
    again = Graph.load(spark, f"file://{tmp_path}/g", {"A": "a", "B": "b"}, [("E", "A", "B")])
    assert {tuple(r) for r in again.counts().collect()} == {("node", "A", 3), ("node", "B", 2), ("edge", "E:A:B", 3)}
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        graph.save(f"file://{tmp_path}/g")
    assert Graph.empty(spark, ["Lemma", "Root"], [("HAS_ROOT", "Lemma", "Root")]).edges["HAS_ROOT", "Lemma", "Root"].columns == ["src_key", "dst_key"]


def test_last_per_keeps_null_keys(spark):
    rows = frame(spark, [(None, 1, "a"), (None, 2, "b"), ("k", 1, None)], "k string, o int, v string")
    assert {(r.k, r.v) for r in last_per(rows, ["k"], ["o"]).collect()} == {(None, "b"), ("k", None)}


def test_unique_match_and_outcomes(spark):
    index = frame(spark, [("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    rows = frame(spark, [("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    matched = joins.unique_match(rows, index, ["k"], "v")
    assert sorted((r.k or "", r.v) for r in matched.collect() if r.v) == [("a", 1), ("a", 1)]
    assert {tuple(r) for r in joins.match_outcomes(matched, "v", ["v"]).collect()} == {("linked", 1), ("duplicate", 1), ("skipped", 3)}


def test_null_safe_remap(spark):
    mapping = frame(spark, [(None, 5), ("a", 6)], "k string, v int")
    rows = frame(spark, [(None,), ("a",)], "k string")
    assert {(r.k, r.v) for r in joins.null_safe_remap(rows, mapping, "k", "v").collect()} == {(None, 5), ("a", 6)}
    with pytest.raises(Exception, match="no new key for b"):
        joins.null_safe_remap(frame(spark, [("b",)], "k string"), mapping, "k", "v").collect()
    assert joins.null_safe_remap(frame(spark, [("b",)], "k string"), mapping, "k", "v", strict=False).count() == 0


def test_merge_sides(spark):
    blocks = frame(spark, [("b1", ["1", "2", "3"]), ("b2", ["9"]), ("b3", ["4"])], "block_key string, keys array<string>")
    side = frame(spark, [("1", "g", "A", 1), ("2", "g", "A2", 1), ("3", "h", "old", 1), ("3", "h", "B", 2), ("4", "i", None, 1)], "key string, group_key string, text string, o int")
    assert {tuple(r) for r in joins.merge_sides(blocks, side, ["o"]).collect()} == {("b1", "A\n\nB"), ("b2", None), ("b3", None)}


def test_merge_lemmas(spark):
    schema = "old_id int, text string, pos string, frequency long, source string"
    verse = frame(spark, [(1, "نُور", None, None, None)], schema)
    other = frame(spark, [(7, "علم", None, None, None)], schema)
    rich = frame(spark, [(3, "نور2", "n", 4, "s"), (4, "نور3", "v", 9, "t"), (5, "قلم1", None, None, None), (6, None, None, None, None)], schema)
    lemmas, ids = resolve.merge_lemmas([verse, other, rich], 2)
    got = [tuple(r) for r in lemmas.orderBy("lemma_id").collect()]
    assert got == [(0, "نُور", "n", 4, "s"), (1, "علم", None, None, None), (2, "قلم", None, None, None), (3, None, None, None, None)]
    assert {tuple(r) for r in ids.collect()} == {(0, 1, 0), (1, 7, 1), (2, 3, 0), (2, 4, 0), (2, 5, 2), (2, 6, 3)}


def test_majority_ties(spark):
    rows = frame(spark, [("l", 2, "1"), ("l", 1, "2"), ("l", 1, "3"), ("l", 2, "4"), ("m", 3, "9")], "k string, v int, at string")
    assert {tuple(r) for r in resolve.majority(rows, "k", "v", "at").collect()} == {("l", 2, 2, 2), ("m", 3, 1, 1)}


def test_ids(spark):
    rows = frame(spark, [("b",), ("a",), ("c",)], "t string")
    assert [r.i for r in resolve.dense_ids(rows, ["t"], "i", 5).orderBy("t").collect()] == [5, 6, 7]
    assert resolve.dense_ids(rows.limit(0), ["t"], "i").collect() == []
    known = frame(spark, [("a", 4)], "t string, i long")
    seen = frame(spark, [("b", 2), ("c", 1), ("c", 9), ("a", 0)], "t string, at int")
    assert {(r.t, r.i) for r in resolve.next_ids(seen, known, "t", ["at"], "i").collect()} == {("c", 5), ("b", 6)}


def test_salted_join_equals_join(spark):
    probe = frame(spark, [(k, i) for i in range(300) for k in (["h"] * 3 + ["l"])] + [(None, 1)], "k string, i int")
    keys = frame(spark, [("h", 900), ("l", 300), ("z", 0)], "k string, n long")
    for how in ("left_semi", "inner"):
        assert salted_join(probe, keys, ["k"], "n", "i", how, heavy=500, salts=4).count() == 1200


def test_quality(spark):
    rows = frame(spark, [("x", 11)], "name string, n long")
    expected = frame(spark, [("x", 10), ("y", 5), ("z", 0)], "name string, expected long")
    assert {r.name: r.ok for r in quality.check_counts(rows, expected, 0.1).collect()} == {"x": True, "y": False, "z": True}
    assert {r.name: r.ok for r in quality.check_counts(rows, expected).collect()} == {"x": False, "y": False, "z": True}
    assert quality.shrunk(rows, [rows, rows]).first().ok
    with pytest.raises(ValueError):
        quality.require_rows({"a": rows.limit(0)})
    with pytest.raises(ValueError):
        quality.require_known(["q"], ["x"])
    names = frame(spark, [("إ",), ("أ",)], "name string")
    with pytest.raises(ValueError):
        quality.require_unique(joins.fold_collisions(names, "name", lambda c: F.translate(c, "إأ", "اا")), "folded name")


def test_merge_keeps_what_is_there(graph, spark):
    rows = frame(spark, [(1, 10, "new"), (1, 10, "other"), (3, 20, "b"), (3, 20, "a")], "src_key int, dst_key int, v string")
    g = Graph(graph.nodes, {("M", "A", "B"): frame(spark, [(1, 10, "old")], "src_key int, dst_key int, v string")}, graph.keys)
    assert {tuple(r) for r in g.merge_edges("M", "A", "B", rows).edges["M", "A", "B"].collect()} == {(1, 10, "old"), (3, 20, "a")}


def test_create_under_star_and_answers(graph, spark):
    rows = frame(spark, [(7, 1, "p"), (8, 9, "q")], "c int, parent int, v string")
    g = graph.create_under("C", rows, "c", "UNDER", "A", "parent")
    assert [tuple(r) for r in g.nodes["C"].collect()] == [(7, "p")] and [tuple(r) for r in g.edges["UNDER", "C", "A"].collect()] == [(7, 1)]
    with pytest.raises(ValueError):
        Graph().create_nodes("A", frame(spark, [(1,), (1,)], "a int"), "a").create_under("C", rows, "c", "UNDER", "A", "parent")
    assert {tuple(r) for r in graph.star(("E", "A", "B"), ("E", "A", "B")).collect()} == {(1, 10, 10), (2, 10, 10), (2, 10, 20), (2, 20, 10), (2, 20, 20)}
    assert graph.clear("B", answer="n") is graph and "B" not in graph.clear("B", answer=" YES ").nodes
    assert graph.match("E", "A", "B", ["name"], source_where={"name": "x"}).count() == 1
    assert Graph().copy_from(graph, ["A", "B"], [("E", "A", "B")]).edges["E", "A", "B"].count() == 3
    assert graph.rename_properties("A", {"a": "id"}, kind="k").keys["A"] == "id"


def test_hot_keys_beyond_the_bound(spark, monkeypatch):
    from qirtas.operators import skew

    monkeypatch.setattr(skew, "MOST", 1)
    probe = frame(spark, [(k, i) for i in range(60) for k in "aabbc"], "k string, i int")
    keys = frame(spark, [("a", 120), ("b", 120), ("c", 60)], "k string, n long")
    assert salted_join(probe, keys, ["k"], "n", "i", "inner", heavy=100, salts=4).count() == 300


def test_large_key_tables_are_not_broadcast(spark, monkeypatch):
    from qirtas.operators import skew

    probe = frame(spark, [(k, i) for i in range(60) for k in "aabbc"], "k string, i int")
    keys = frame(spark, [("a", 120), ("b", 120), ("c", 60)], "k string, n long")
    for small, heavy in ((2, 10**6), (2, 100), (10, 100)):
        monkeypatch.setattr(skew, "SMALL", small)
        joined = salted_join(probe, keys, ["k"], "n", "i", "inner", heavy=heavy, salts=4)
        assert joined.count() == 300 and joined.columns == ["k", "i"]
    monkeypatch.setattr(skew, "SMALL", 2)
    plan = salted_join(probe, keys, ["k"], "n", "i", "inner")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
