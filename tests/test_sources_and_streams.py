import io
import json
import urllib.error
import zipfile

from pyspark.sql import functions as F

from lorekeel.sources import archives, catalog, records
from lorekeel.sources.paged import PagedReader, PagedSource, fetch
from lorekeel.streaming import metrics

CABLES = '''header,line
"1","2/24/2010 9:00","REF1","Embassy Paris","CONFIDENTIAL","refs","head","first line
SUBJECT: On trade
TAGS: PREL, PGOV
he said ""no"" today"
"2","12/1/2009 14:30","REF2","Embassy Rome","SECRET","refs","head","body"
"3","1/1/2009 1:00","only"
'''


def test_cables(spark, tmp_path):
    (tmp_path / "cables.csv").write_text(CABLES)
    rows = {r["id"]: r for r in records.cable_records(records.read_lines(spark, str(tmp_path))).collect()}
    assert set(rows) == {"1", "2"} and rows["1"]["origin"] == "Embassy Paris" and rows["1"]["classification"] == "CONFIDENTIAL"
    assert rows["1"]["subject"] == "On trade" and rows["1"]["tags"] == ["PREL", "PGOV"] and 'said "no"' in rows["1"]["content"] and rows["2"]["content"] == "body"


def test_a_cable_of_a_megabyte(spark, tmp_path):
    lines = ["SUBJECT: long", "x" * 500_000, 'say \\"so\\" ' * 60_000, '""quoted""' * 20_000, "", "end" + " " * 300_000]
    (tmp_path / "long.csv").write_text('"7","2/7/1972 0:00","REF","Embassy","SECRET","","header","' + "\n".join(lines) + '"\n"8","2/8/1972 0:00","R","E","S","","h","short"\n')
    rows = {r["id"]: r for r in records.cable_records(records.read_lines(spark, str(tmp_path / "long.csv"))).collect()}
    expected = "\n".join(lines).replace('""', '"').replace('\\"', '"')
    assert rows["7"]["content"] == expected and rows["7"]["subject"] == "long" and rows["8"]["content"] == "short"


def test_cables_of_a_file_read_in_parts(spark, tmp_path):
    bodies = [f"line {k}\r\nmore {'x' * (7 * k % 50)}\n\nend of {k}" for k in range(40)]
    text = "no record\n" + "\n".join(f'"{k}","2/7/1972 0:00","ref","Embassy","SECRET","","h","{b}"' for k, b in enumerate(bodies)) + "\n"
    (tmp_path / "long.csv").write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    try:
        lines = records.read_lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 10
        got = {int(r["id"]): r["content"] for r in records.cable_records(lines).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {k: b.replace("\r", "") for k, b in enumerate(bodies)}


def test_archive(spark, tmp_path):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("nodes-entities.csv", "﻿node_id,name,jurisdiction\n1,A,X\n2,B,\n")
        z.writestr("nodes-officers.csv", "id,name\n3,C\n")
        z.writestr("relationships.csv", "START_ID,END_ID,TYPE\n1,3,owns\n")
    (tmp_path / "a.zip").write_bytes(raw.getvalue())
    rows = records.read_archive(spark, str(tmp_path)).cache()
    assert sorted((r["id"], r["name"], r["entity_type"]) for r in records.offshore_entities(rows).collect()) == [("1", "A", "entity"), ("2", "B", "entity"), ("3", "C", "officer")]
    assert records.offshore_entities(rows, 1).count() == 1
    assert [tuple(r)[:4] for r in records.offshore_relationships(rows).collect()] == [("0", "1", "3", "owns")]


def test_archive_members_are_partitions_and_stream(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "CHUNK_ROWS", 7)
    (tmp_path / "below").mkdir()
    for k in range(2):
        with zipfile.ZipFile(tmp_path / "below" / f"{k}.ZIP", "w", zipfile.ZIP_DEFLATED) as z:
            for m in range(3):
                z.writestr(f"in/{m}.csv", "a,b\n" + "".join(f'{k}{m}{i},"x, ""{i}""\ny"\n' for i in range(20)))
            z.writestr("empty.csv", "")
            z.writestr("only_header.csv", "a,b\n")
            z.writestr("readme.txt", "a,b\n1,2\n")
    reader = archives.ArchiveReader(str(tmp_path), ".csv")
    assert len(reader.partitions()) == 10
    batches = list(reader.read(next(p for p in reader.partitions() if p.member == "in/0.csv")))
    assert [b.num_rows for b in batches] == [7, 7, 6]
    rows = records.read_archive(spark, str(tmp_path)).collect()
    assert len(rows) == 120 and {(r["member"], r["ordinal"]): r["fields"] for r in rows if "/1.ZIP" in r["archive"]}["2.csv", 5] == {"a": "125", "b": 'x, "5"\ny'}
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    assert records.read_archive(spark, str(tmp_path / "none.zip")).count() == 0
    plain = lambda df: sorted((r["archive"], r["member"], r["ordinal"], sorted(r["fields"].items())) for r in df.collect())
    assert plain(records.read_archive(spark, "file://" + str(tmp_path))) == sorted((r["archive"], r["member"], r["ordinal"], sorted(r["fields"].items())) for r in rows)


def test_media_prompts_and_lines(spark, tmp_path):
    media = tmp_path / "m" / "sub"
    media.mkdir(parents=True)
    (media / "A.MP4").write_bytes(b"12345")
    (media / "b.txt").write_bytes(b"1")
    files = records.media_files(spark, str(tmp_path / "m"))
    assert [(r["filename"], r["extension"], r["size_bytes"]) for r in files.collect()] == [("A.MP4", ".mp4", 5)] and records.media_totals(files).first()["n_files"] == 1
    prompts = tmp_path / "p"
    prompts.mkdir()
    (prompts / "one.md").write_text("---\nname: x\n---\nBody here\n")
    (prompts / "two.md").write_text("Only body")
    got = {r["name"]: (r["front_matter"], r["body"]) for r in records.prompts(spark, str(prompts)).collect()}
    assert got == {"one": ("name: x", "Body here"), "two": ("", "Only body")}
    lines = tmp_path / "l.jsonl"
    lines.write_text('{"a": 1}\n\n{"a": "x"\n')
    rows = records.json_lines(spark, str(lines), "a int").cache().collect()
    assert len(rows) == 2 and sum(r["_corrupt_record"] is not None for r in rows) == 1


def test_api_projections(spark):
    bill = spark.createDataFrame([(json.dumps({"congress": 118, "type": "HR", "number": "5", "title": "T", "introducedDate": "2023-01-02", "policyArea": {"name": "P"}}),)], "value string")
    b = records.bills_from_api(bill).first()
    assert (b["id"], b["policy_area"], str(b["introduced_date"])) == ("HR5-118", "P", "2023-01-02")
    member = spark.createDataFrame([(json.dumps({"bioguideId": "B1", "name": "N", "partyName": "Green", "terms": {"item": [{"chamber": "House"}, {"chamber": "Senate"}]}}),)], "value string")
    m = records.members_from_api(member).first()
    assert (m["party"], m["chamber"], m["terms_served"]) == ("G", "Senate", 2)
    probe = spark.createDataFrame([("f", json.dumps({"format": {"duration": "1.5"}, "streams": [{"codec_type": "audio", "codec_name": "aac", "channels": 2}]})), ("g", None)], "path string, probe string")
    got = {r["path"]: (r["duration_seconds"], r["has_video"], r["has_audio"], r["audio_codec"]) for r in records.probe_metadata(probe).collect()}
    assert got == {"f": (1.5, False, True, "aac"), "g": (0.0, False, False, "")}


def test_paged_source(spark):
    items = [{"k": k} for k in range(57)]

    def get(url):
        q = dict(p.split("=") for p in url.split("?")[1].split("&"))
        a, n = int(q["offset"]), int(q["limit"])
        return json.dumps({"items": items[a : a + n], "page": {"total": 57}}).encode()

    for options in ({"total_key": "page.total"}, {}, {"max_items": "33"}, {"total_key": "page.total", "max_items": "12"}):
        reader = PagedReader({"url": "http://x", "page_size": "10", "pages_per_partition": "2", **options}, get)
        rows = [r for p in reader.partitions() for r in reader.read(p)]
        most = int(options.get("max_items", 57))
        assert [r[0] for r in rows] == list(range(most)) and json.loads(rows[-1][1]) == {"k": most - 1}
    spark.dataSource.register(PagedSource)
    waits = []

    def broken(url):
        if len(waits) < 2:
            raise urllib.error.URLError("down")
        return b"ok"

    assert fetch("http://x", broken, wait=waits.append) == b"ok" and waits == [1.0, 2.0]


def test_catalog(spark, tmp_path):
    for p in ("silver/loc/grp/loc_documents", "gold/loc/grp/loc_entity_candidates", "platinum/kg/kg/canonical_entities"):
        (tmp_path / p).mkdir(parents=True)
        (tmp_path / p / "_metadata.json").write_text("{}")
    found = catalog.list_datasets(spark, str(tmp_path))
    assert {(r["layer"], r["asset"]) for r in found.collect()} == {("silver", "loc_documents"), ("gold", "loc_entity_candidates"), ("platinum", "canonical_entities")}
    assert [r["source"] for r in catalog.list_sources(found).collect()] == ["loc"]
    paths = spark.createDataFrame([("/a/config=x/data",), ("/a/data",)], "path string")
    assert [r["config"] for r in catalog.list_configs(paths).collect()] == ["default", "x"]
    assert [r["config"] for r in catalog.list_configs(paths.limit(0)).collect()] == ["default"]
    spark.range(3).write.parquet(str(tmp_path / "here"))
    assert catalog.load(spark, str(tmp_path / "missing"), fallback=str(tmp_path / "here")).count() == 3


def test_stream_agrees_with_batch(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    source = tmp_path / "in"
    events.repartition(3).write.parquet(str(source))
    stream = metrics.timed(spark.readStream.schema(events.schema).parquet(str(source)), late="10 minutes")
    sink = str(tmp_path / "out")
    metrics.run_to_end(metrics.rate(stream, ["event_type"]), sink, str(tmp_path / "ck"))
    batch = metrics.rate(metrics.timed(events), ["event_type"])
    done = spark.read.parquet(sink)
    final = batch.join(done.agg(F.max("window_end").alias("last")), F.col("window_end") <= F.col("last"))
    assert done.count() == final.count() > 0 and done.exceptAll(batch).count() == 0


def test_counters_and_quantiles(spark):
    rows = [("a", "2024-01-01 00:00:00", 5.0), ("a", "2024-01-01 00:01:00", 9.0), ("a", "2024-01-01 00:02:00", 2.0)]
    df = metrics.timed(spark.createDataFrame(rows, "k string, ts string, value double"))
    assert metrics.counter_rate(df, ["k"]).first()["increase"] == 6.0
    assert metrics.quantiles(df, "value", [0.5], "1 hour").first()["q0"] == 5.0
    assert metrics.first_seen(df.select("k"), "k").count() == 1
