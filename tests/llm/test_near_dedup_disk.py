"""Sketches are wide: near_dedup shuffles them for its nodes once, not for every step."""

from beaconlake.llm import near_dedup


def test_steps_read_the_nodes_without_a_shuffle_of_all_sketches(spark, monkeypatch):
    words = [f"word{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "more"])), (3, "something else"), (4, None)]
    plans = []

    def watching(pairs, nodes, likely=near_dedup.likely):
        plans.append(nodes._jdf.queryExecution().executedPlan().toString())
        return likely(pairs, nodes)

    monkeypatch.setattr(near_dedup, "likely", watching)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Join" not in plans[0]
