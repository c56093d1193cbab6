import json
import pathlib

import pytest

from lorekeel.sources import catalog
from lorekeel.sources.datasets import KINDS, Datasets, sidecar


def test_kinds_are_typed_and_fall_back(spark, tmp_path):
    sets = Datasets(spark, str(tmp_path))
    for kind, k in KINDS.items():
        assert sets.load(kind, None if k.shared else "s").schema == spark.createDataFrame([], k.schema).schema
        assert k.key in spark.createDataFrame([], k.schema).columns and (k.stead is None or k.stead in KINDS)
    old = spark.createDataFrame([("d1", "a", 3), ("d2", None, None)], "document_id string, text string, other int")
    sets.save("entities", old, "s")
    got = sets.load("mentions", "s", mention_type="ORG")
    assert got.schema == spark.createDataFrame([], KINDS["entities"].schema).schema and sorted(r["document_id"] for r in got.collect()) == ["d1", "d2"]
    sets.save("mentions", spark.createDataFrame([(1, "ORG"), (2, "LAW"), (3, None)], "mention_id int, mention_type string"), "s", location="other")
    assert [r["mention_id"] for r in sets.load("mentions", "s", mention_type="ORG").collect()] == ["1"] and sets.load("mentions", "s").count() == 3
    with pytest.raises(ValueError):
        sets.load("mentions")
    with pytest.raises(ValueError):
        sets.load("assertion_graph", "s")


def test_partitions_configs_and_rewrites(spark, tmp_path):
    sets = Datasets(spark, str(tmp_path))
    rows = lambda *ids: spark.createDataFrame([(i, "t") for i in ids], "id string, title string")
    sets.save("documents", rows("b", "a"), "s", partition="1")
    sets.save("documents", rows("c"), "s", partition="2")
    sets.save("documents", rows("z"), "s_t")
    assert sorted(r["id"] for r in sets.load("documents", "s").collect()) == ["a", "b", "c"]
    assert [r["id"] for r in sets.load("documents", "s", partition="2").collect()] == ["c"] and sets.load("documents", "s", partition="3").count() == 0
    at = sets.save("documents", rows("d", "e", "f"), "s", partition="2")
    assert [r["id"] for r in sets.shown("documents", "s", limit=4).collect()] == ["a", "b", "d", "e"] and sidecar(spark, at)["count"] == 3
    assert sets.save("documents", rows().limit(0), "none") and sets.load("documents", "none").count() == 0
    sets.save("chunks", spark.createDataFrame([("c1", 0)], "chunk_id string, chunk_index int"), "s", config="cs400", partition="x")
    assert sets.load("chunks", "s", config="cs400").count() == 1 and sets.load("chunks", "s", config="cs800").count() == 0
    said = {(r["asset"], r["config"], r["partition"]): r["count"] for r in sets.described().collect()}
    assert said == {("s_documents", None, "1"): 2, ("s_documents", None, "2"): 3, ("s_t_documents", None, None): 1, ("none_documents", None, None): 0, ("s_chunks", "cs400", "x"): 1}


def test_a_write_that_breaks_off_is_not_found(spark, tmp_path):
    sets = Datasets(spark, str(tmp_path))
    sets.save("documents", spark.createDataFrame([("a",)], "id string"), "s")
    with pytest.raises(Exception, match="broken"):
        sets.save("documents", spark.range(3).selectExpr("raise_error('broken') as id"), "s")
    assert sets.load("documents", "s").count() == 0 and sets.listed().count() == 0


def test_sidecars_and_listing(spark, tmp_path):
    for folder, text in (("gold/loc/g/a_mentions", json.dumps({"kind": "mentions", "count": 2, "more": [1]})), ("gold/loc/g/a_mentions/config=x/year=2020/month=01/day=02", "[1]"), ("gold/loc/short", "{}"), ("gold/loc/g/b_chunks", "no json")):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / "_metadata.json").write_text(text)
    (tmp_path / "gold/loc/g/a_mentions/_manifest.json").write_text('{"runs": 1}')
    root = f"file:{tmp_path}"
    got = {(r["layer"], r["code_location"], r["group"], r["asset"], pathlib.Path(r["root"].removeprefix("file:")).name) for r in catalog.list_datasets(spark, root).collect()}
    assert got == {("gold", "loc", "g", "a_mentions", "a_mentions"), ("gold", "loc", "g", "a_mentions", "day=02"), ("gold", "loc", "g", "b_chunks", "b_chunks")}
    assert sidecar(spark, f"{root}/gold/loc/g/a_mentions", "_manifest.json") == {"runs": 1}
    assert sidecar(spark, f"{root}/gold/loc/g/b_chunks") is None and sidecar(spark, f"{root}/nowhere") is None
    assert sidecar(spark, f"{root}/gold/loc/g/a_mentions/config=x/year=2020/month=01/day=02") is None
    assert {r["kind"] for r in Datasets(spark, root).described().collect()} == {"mentions", None}
    assert catalog.list_datasets(spark, f"{root}/none").count() == 0
