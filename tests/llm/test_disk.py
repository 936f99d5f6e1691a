"""What the joins leave on disk, and what their rounds store."""

import random
import uuid
from pathlib import Path

import pytest
from pyarrow import parquet
from pyspark.sql import functions as F

import corpus_pipeline
from locusframe.llm import common, components, ngramjoin, suffixarray


def words(chance: random.Random, count: int) -> list[str]:
    return ["".join(chance.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(count)]


@pytest.fixture
def tables(tmp_path, monkeypatch):
    """Labels of the stored tables that hold rows."""
    monkeypatch.setattr(common, "shared_path", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    held = lambda folder: sum(parquet.read_metadata(f).num_rows for f in Path(folder).glob("*.parquet"))
    return lambda: sorted(p.name[:-33] for p in tmp_path.iterdir() if held(p))


def similar(chance: random.Random) -> list[str]:
    """Near copies, and pairs that share a passage."""
    base, passage = words(chance, 60), " ".join(words(chance, 40))
    near = [" ".join(base[:i] + words(chance, 1) + base[i + 1 :]) for i in (5, 20, 40, 59)]
    return [*near, *(" ".join([*words(chance, 20), passage, *words(chance, 20)]) for _ in range(4)), " ".join(base), " ".join(base)]


def test_cut_keeps_only_its_spans(spark, sf, tables):
    docs = spark.createDataFrame(list(enumerate([*similar(random.Random(1)), "short", None])), "doc_id long, text string")
    rows = corpus_pipeline.cut_repeated(spark, docs, sf)
    assert tables() == ["spans"]
    kept = {r["doc_id"]: r["text"] for r in rows.collect()}
    assert len(kept) == 12 and kept[10] == "short" and kept[11] is None and kept[8] == kept[9] == ""
    assert all(0 < len(kept[i]) < 420 for i in (4, 5, 6, 7))


def test_join_keeps_only_its_result(spark, tables):
    docs = spark.createDataFrame(list(enumerate(similar(random.Random(2)))), "doc_id long, text string")
    found = ngramjoin.near_duplicates(docs, 4, 85)
    assert set(tables()) <= {"members", "components", "links"} and "members" in tables()
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {i: 0 if i < 4 or i > 7 else i for i in range(10)}


def test_groups_of_two_are_decided_in_the_first_round(spark, monkeypatch):
    """Pairs below the threshold whose prefixes share n-grams: no group has a third class."""
    chance, texts, rows = random.Random(3), [], {}
    for _ in range(20):
        shared = words(chance, 56)
        texts += [" ".join(shared + words(chance, 7)) for _ in range(2)]

    def counted(frame, label):
        back = common.stored(frame, label)
        rows[label] = max(rows.get(label, 0), back.count())
        return back

    monkeypatch.setattr(ngramjoin, "stored", counted)
    found = ngramjoin.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 85)
    assert rows["shared-grams"] > 0 and rows["open-grams"] == 0
    assert all(r["doc_id"] == r["component_id"] for r in found.collect())


def test_released_tables_are_not_read_as_empty(spark, tables):
    frame = common.stored(spark.range(10).repartition(3), "some")
    common.release(frame)
    assert not tables()
    with pytest.raises(Exception, match="(?i)exist|read"):
        frame.collect()


def test_marks_have_all_keys(spark):
    keys = spark.range(0, 3000, 3).withColumn("id", F.when(F.col("id") > 0, F.col("id")))
    rows = spark.range(3000).withColumn("id", F.when(F.col("id") > 0, F.col("id")))
    found, rest = ({r["id"] for r in common.marked(rows, F.col("id"), keys, inside).collect()} for inside in (True, False))
    assert found >= {None, *range(3, 3000, 3)} and len(found) < 1100
    assert not found & rest and len(found | rest) == 3000
    assert common.marked(rows, F.col("id"), keys.limit(0)).isEmpty()


def test_chains_leave_one_table(spark, tables, monkeypatch):
    monkeypatch.setattr(components, "LOCAL_NODES", 10)
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long").repartition(8)
    rows = components.components(chain, "chain")
    assert tables() == ["chain"] and {r["component"] for r in rows.collect()} == {0}


def test_texts_without_spans_are_not_shuffled(spark, monkeypatch):
    chance = random.Random(4)
    texts = [" ".join(words(chance, 40)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[7]])], "doc_id long, text string")
    spans = suffixarray.repeated_spans(docs, 200)
    assert suffixarray.distinct_texts(docs, "text", spans).count() == 1
