"""Near-dedup moves few texts and writes few files, however many shuffle partitions there are."""

from __future__ import annotations

from pyspark.sql import functions as F

from test_llm import counted, groups
from tierlake import scratch
from tierlake.llm import near_dedup


def stored_files(spark, tmp_path, monkeypatch, rows) -> dict[str, int]:
    """Files of each purpose that near-dedup stores for some rows, the most where it stores several tables."""
    monkeypatch.setattr(scratch, "_root", lambda _: str(tmp_path))
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = near_dedup.group_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert counted(found) == counted(groups(rows))
    files = {}
    for path in tmp_path.iterdir():
        purpose = path.name.rsplit("-", 1)[0]
        files[purpose] = max(files.get(purpose, 0), len(list(path.glob("part-*"))))
    return files


def test_near_dedup_stores_small_tables_in_few_files(spark, tmp_path, monkeypatch):
    words = [f"c{k}" for k in range(400)]
    rows = [(k, " ".join(words[k * 6 : k * 6 + 200])) for k in range(30)] + [(100 + k, f"alone {k} of some words") for k in range(60)]
    files = stored_files(spark, tmp_path, monkeypatch, rows)
    assert {p: files[p] for p in ("classes", "edges", "components")} == {"classes": 1, "edges": 1, "components": 1}
    assert files["pairs"] == 1


def test_near_dedup_moves_only_texts_that_it_may_need(spark):
    rows = [(None if k == 7 else k, f"text {k}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    keyed = near_dedup._keyed(docs)
    asked = keyed.filter("doc_id is null or doc_id % 40 = 3").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    sifted = near_dedup._sifted(keyed, ("doc_id", "key"), asked, ("_id", "_key"))
    assert sifted.columns == [*keyed.columns, "_maybe"] and sifted.count() == 400
    maybe = {r.doc_id for r in sifted.filter("_maybe").collect()}
    assert maybe >= {None, *range(3, 400, 40)} and len(maybe) < 20
    assert near_dedup._sifted(keyed, ("doc_id", "key"), asked.filter("false"), ("_id", "_key")).filter("_maybe").count() == 0
