"""Workers that live on after a task don't keep its memory."""

import pyarrow as pa
from pyspark.sql import functions as F

from catchment.llm import common, components, packing, toxicity


class Frame:
    """Stands for a frame; keeps what would run in a task."""

    columns = ["doc_id", "text"]

    class schema:
        fields: list = []

    def mapInArrow(self, function, schema):
        return function


def test_scoring_gives_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(toxicity, "give_back", lambda: given.append(1))
    scored = toxicity.toxicity(Frame(), toxicity.Lexicon(((" bad ", 1.0),)))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a bad text", None])], names=["doc_id", "text"])
    rows = [row for out in scored(iter([batch, batch])) for row in out.to_pylist()]
    assert [row["doc_id"] for row in rows] == [1, 2, 1, 2] and rows[0]["_score"] > rows[1]["_score"] and given == [1]


def test_a_worker_forgets_what_other_operators_remember(monkeypatch):
    made = []
    monkeypatch.setattr(packing, "WordIds", lambda path: made.append(path) or object())
    packing.word_ids.cache_clear()
    held = packing.word_ids("a")
    common.give_back(packing.word_ids)
    assert packing.word_ids("a") is held
    common.give_back()
    assert packing.word_ids("a") is not held and made == ["a", "a"]
    packing.word_ids.cache_clear()


def test_rounds_of_components_write_few_files(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "pin", lambda df: written.append(df.rdd.getNumPartitions()) or df.localCheckpoint())
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 2).alias("b"))
        found = {row["node"]: row["component"] for row in components.components(edges).collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found == {node: node % 2 for node in range(62)}
    assert len(written) > 2 and max(written[1:]) <= spark.sparkContext.defaultParallelism < written[0]
