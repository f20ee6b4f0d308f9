"""Small sets of edges are reduced in few tasks, however many shuffle partitions there are."""

from rowloom.llm import components as C


def test_few_tasks_and_right_components(spark, monkeypatch):
    parts, cut = [], C.cut_lineage
    monkeypatch.setattr(C, "cut_lineage", lambda df: (parts.append(df.rdd.getNumPartitions()), cut(df))[1])
    names = {"spark.sql.shuffle.partitions": "37", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        edges = [(k, k + 1) for k in range(20)] + [(30, 40), (35, 40), (7, 7), (50, 50), (None, 3)]
        found = C.connected_components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)).collect()
        assert {(r["node"], r["component"]) for r in found} == {(k, 0) for k in range(21)} | {(30, 30), (35, 30), (40, 30), (50, 50)}
        assert max(parts[1:]) == 1, parts  # the first table is still as its edges were given
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
