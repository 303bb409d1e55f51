from tidemark.llm import shared
from tidemark.llm.components import connected_components
from tidemark.llm.shared import Scratch


def test_rounds_are_kept_in_few_files(spark, monkeypatch):
    """Where the shuffle has many partitions that aren't joined, a round's small table isn't as many files."""
    files = {}

    class Counted(Scratch):
        def keep(self, df, name, partition_by=None):
            out = super().keep(df, name, partition_by)
            files[name] = max(files.get(name, 0), len(out.inputFiles()))
            return out

    monkeypatch.setattr(shared, "FILE_TASKS", 1, raising=False)
    most = spark.sparkContext.defaultParallelism
    conf = {"spark.sql.shuffle.partitions": str(8 * most), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        edges = spark.range(500).selectExpr("id as a", "id + 500 * (1 + id % 2) as b").union(spark.range(0, 400).selectExpr("id as a", "id + 2 as b"))
        got = {r.node: r.component for r in connected_components(edges, Counted(spark, "counted")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    root = lambda i: i % 2 if i <= 401 else i
    want = {i: root(i) for i in range(2, 402)} | {i + 500 * (1 + i % 2): root(i) for i in range(500)}
    assert got == want
    assert max(files["large"], files["small"]) <= most, files
