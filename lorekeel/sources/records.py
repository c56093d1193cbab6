"""Readers of raw records: cables, offshore entities and relationships, media files, prompts, JSON lines."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.functions.scalars import extension, file_name, first_truthy, stripped, subject_line, tag_list
from lorekeel.sources import archives

# The node files of the offshore archive in their order, and the entity type of each.
NODE_FILES = [
    ("nodes-entities.csv", "entity"), ("nodes-officers.csv", "officer"), ("nodes-intermediaries.csv", "intermediary"),
    ("nodes-addresses.csv", "address"), ("nodes-others.csv", "other"),
]
#: Extensions of media files.
MEDIA_EXTENSIONS = [".mp4", ".mkv", ".webm", ".avi", ".mov", ".mp3", ".m4a", ".wav", ".flac"]
#: A field in quotes, with escaped or doubled quotes inside; possessive, so that a body of any length takes no recursion.
_FIELD = r'(?s)"([^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+)"(?:,|\s*+$)'
_START = r'^"(\d+)","\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}"'


def cable_records(lines: DataFrame) -> DataFrame:
    """Cables from ``lines`` (file, line_no, value, and block where a file was read in parts) of an archive whose bodies span lines.

    A record starts on a line with an id and a time in quotes; all lines up to the next start belong to it. Lines before the first start, and
    records with fewer than six fields, are left out. Starts are found part by part; lines before the first start of a part belong to the
    last start before it, which a row for each part tells, so that no task holds a file.
    """
    rows = lines if "block" in lines.columns else lines.withColumn("block", F.lit(0))
    started = rows.withColumn("_start", F.when(F.col("value").rlike(_START), F.col("line_no")))
    order = Window.partitionBy("file", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = started.withColumn("_own", F.last("_start", ignorenulls=True).over(order))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = started.groupBy("file", "block").agg(F.max("_start").alias("_last")).select("file", "block", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    numbered = own.join(parts, ["file", "block"]).withColumn("record", F.coalesce("_own", "_before")).where("record is not null")
    parts = F.array_sort(F.collect_list(F.struct("line_no", "value")))["value"]
    whole = numbered.groupBy("file", "record").agg(F.array_join(parts, "\n").alias("raw"))
    fields = F.regexp_extract_all("raw", F.lit(_FIELD), F.lit(1))
    rows = whole.withColumn("f", F.transform(fields, lambda x: F.regexp_replace(F.replace(x, F.lit('""'), F.lit('"')), r'\\"', '"'))).where(F.size("f") >= 6)
    field = lambda k: F.coalesce(F.try_element_at("f", F.lit(k + 1)), F.lit(""))
    body = F.array_join(F.slice("f", 8, F.greatest(F.size("f") - 7, F.lit(0))), "\n")
    out = rows.select(field(0).alias("id"), field(1).alias("date"), field(2).alias("reference"), field(3).alias("origin"), field(4).alias("classification"), F.when(body == "", field(6)).otherwise(body).alias("content"))
    return out.select("*", subject_line("content").alias("subject"), tag_list("content").alias("tags"), F.concat(F.lit("cable:"), "id").alias("source_url"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line_no, value) of text files, by the order of their lines; a file is read in as many parts as it has splits.

    ``block`` is where a part starts in its file, and ``line_no`` orders the lines of a file: a struct of block and place.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    block = F.col("_metadata.file_block_start")
    line = F.struct(block.alias("block"), F.monotonically_increasing_id().alias("place"))
    return text.select(F.col("_metadata.file_path").alias("file"), block.alias("block"), line.alias("line_no"), F.regexp_replace("value", "\r$", "").alias("value"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, ordinal, fields) of every row of every CSV file in ZIP archives at or below a path; ``fields`` maps column to text.

    Each member is a task and streams from the file system. On a path that only Spark's own readers know, an archive is one row of theirs (2 GB at most) and one task.
    """
    try:
        archives.file_system(path)
    except ValueError:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[zZ][iI][pP]").load(path).select("path", "content")
        return files.mapInPandas(_unpacked, archives.SCHEMA)
    spark.dataSource.register(archives.ArchiveSource)
    return spark.read.format("zip_csv").option("path", path).load()


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        for archive, raw in zip(frame["path"], frame["content"]):
            with zipfile.ZipFile(io.BytesIO(raw)) as z:
                for member in sorted(n for n in z.namelist() if n.lower().endswith(".csv")):
                    at = 0
                    with z.open(member) as f:
                        for part in pd.read_csv(f, dtype=str, keep_default_na=False, encoding="utf-8-sig", chunksize=archives.CHUNK_ROWS):
                            yield pd.DataFrame({"archive": archive, "member": member.rsplit("/", 1)[-1], "ordinal": range(at, at + len(part)), "fields": part.to_dict("records")})
                            at += len(part)


def _present(*names: str):
    """The value of the first column that the file has, be it empty."""
    return F.coalesce(*(F.try_element_at("fields", F.lit(n)) for n in names), F.lit(""))


def offshore_entities(rows: DataFrame, most: int = 0) -> DataFrame:
    """Entities from the node files of ``read_archive``; ``most`` (0: all) counts over all files in their order."""
    types = F.create_map(*(F.lit(x) for kv in NODE_FILES for x in kv))
    place = F.array_position(F.array(*(F.lit(n) for n, _ in NODE_FILES)), F.col("member"))
    nodes = rows.withColumn("place", place).where("place > 0")
    if most > 0:
        nodes = nodes.orderBy("archive", "place", "ordinal").limit(most)
    return nodes.select(
        _present("node_id", "id").alias("id"), _present("name").alias("name"), F.element_at(types, F.col("member")).alias("entity_type"), _present("jurisdiction", "jurisdiction_description").alias("jurisdiction"),
        _present("countries", "country_codes").alias("country"), _present("status").alias("status"), _present("incorporation_date").alias("incorporation_date"),
        first_truthy(_present("sourceID"), F.lit("unknown")).alias("source_dataset"), F.lit(None).cast("string").alias("source_url"),
    )


def offshore_relationships(rows: DataFrame, member: str = "relationships.csv") -> DataFrame:
    """Relationships with the row's ordinal as id; column names of either case of the archive."""
    edges = rows.where(F.col("member") == member)
    return edges.select(F.col("ordinal").cast("string").alias("id"), _present("node_id_start", "START_ID").alias("start_id"), _present("node_id_end", "END_ID").alias("end_id"), _present("rel_type", "TYPE").alias("rel_type"), _present("link").alias("link"))


def media_files(spark: SparkSession, path: str, extensions: list[str] = MEDIA_EXTENSIONS) -> DataFrame:
    """path, filename, extension, size_bytes, mtime and source_dir of media files below ``path``; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    rows = found.select("path", file_name("path").alias("filename"), extension("path").alias("extension"), F.col("length").alias("size_bytes"), F.col("modificationTime").cast("double").alias("mtime"))
    return rows.where(F.col("extension").isin(extensions)).withColumn("source_dir", F.lit(path))


def media_totals(files: DataFrame) -> DataFrame:
    """Number and GiB (two places) of files."""
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.round(F.coalesce(F.sum("size_bytes"), F.lit(0)) / 2**30, 2).alias("gib"))


def media_breakdown(files: DataFrame) -> DataFrame:
    """(facet, value, n, gib): files by extension and by source folder."""
    facets = F.explode(F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in ("extension", "source_dir")))).alias("f")
    counts = files.select(facets, "size_bytes").groupBy("f.facet", "f.value").agg(F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("b"))
    return counts.select("facet", "value", "n", F.round(F.col("b") / 2**30, 2).alias("gib"))


def probe_totals(probed: DataFrame) -> DataFrame:
    """One row: files, files whose probe failed (``error``), files with video and with sound, hours to two places."""
    return probed.agg(
        F.count(F.lit(1)).alias("n_files"), F.count("error").alias("n_errors"), F.count_if("has_video").alias("with_video"), F.count_if("has_audio").alias("with_audio"),
        F.round(F.coalesce(F.sum("duration_seconds"), F.lit(0.0)) / 3600, 2).alias("hours"),
    )


def spoken(transcripts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transcripts with a text, and one row ``n_skipped``: how many have none."""
    has = F.coalesce("text", F.lit("")) != ""
    return transcripts.where(has), transcripts.agg(F.count_if(~has).alias("n_skipped"))


def front_matter(prompts: DataFrame) -> DataFrame:
    """``prompts`` with ``entries``: the ``key: value`` lines of their front matter, quotes around a value dropped."""
    lines = F.filter(F.split(F.coalesce("front_matter", F.lit("")), "\n"), lambda x: F.contains(x, F.lit(":")))
    key, value = lambda x: stripped(F.substring_index(x, ":", 1)), lambda x: F.regexp_replace(stripped(F.regexp_replace(x, "^[^:]*:", "")), r"""^(['"])(.*)\1$""", "$2")
    return prompts.withColumn("entries", F.map_from_entries(F.transform(lines, lambda x: F.struct(key(x), value(x)))))


def prompts(spark: SparkSession, path: str) -> DataFrame:
    """name, front_matter and body of prompt files; a file without front matter is all body."""
    files = spark.read.text(path, wholetext=True).select("value", F.input_file_name().alias("path"))
    front = F.regexp_extract("value", r"(?s)^---\s*\n(.*?)\n---\s*\n?", 1)
    return files.select(
        F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1).alias("name"), front.alias("front_matter"), stripped(F.regexp_replace("value", r"(?s)\A---\s*\n.*?\n---\s*\n?", "")).alias("body")
    )


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a schema; lines that do not fit it stay, in ``_corrupt_record``, and blank ones do not count."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)


def bills_from_api(payloads: DataFrame) -> DataFrame:
    """Bills from ``payloads`` (value: the JSON of one bill)."""
    schema = "congress int, type string, number string, title string, originChamber string, introducedDate string, url string, policyArea struct<name:string>, latestAction struct<text:string,actionDate:string>, summary string"
    b = payloads.select(F.from_json("value", schema).alias("b")).select("b.*")
    return b.select(
        F.concat(F.col("type"), F.col("number"), F.lit("-"), F.col("congress").cast("string")).alias("id"), "congress", F.col("type").alias("bill_type"), F.col("number").cast("int").alias("number"), F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("originChamber", F.lit("")).alias("chamber"), "summary", F.col("policyArea.name").alias("policy_area"), F.try_to_date(F.substring("introducedDate", 1, 10)).alias("introduced_date"),
        F.col("latestAction.text").alias("latest_action_text"), F.col("url").alias("source_url"),
    )


def members_from_api(payloads: DataFrame) -> DataFrame:
    """Members from ``payloads``: the first letter of the party, the chamber of the last term."""
    schema = "bioguideId string, name string, partyName string, state string, district int, url string, terms struct<item:array<struct<chamber:string,startYear:int,endYear:int>>>"
    m = payloads.select(F.from_json("value", schema).alias("m")).select("m.*")
    last = F.try_element_at("terms.item", F.lit(-1))
    return m.select(
        F.col("bioguideId").alias("id"), F.col("bioguideId").alias("bioguide_id"), F.coalesce("name", F.lit("")).alias("name"), F.substring("partyName", 1, 1).alias("party"), "state", "district",
        last["chamber"].alias("chamber"), F.coalesce(F.size("terms.item"), F.lit(0)).alias("terms_served"), F.col("url").alias("source_url"),
    )


def committees_from_api(payloads: DataFrame) -> DataFrame:
    """Committees from ``payloads`` (value: the JSON of one committee); the code is the id."""
    schema = "systemCode string, name string, chamber string, committeeTypeCode string, parent struct<systemCode:string>, url string"
    c = payloads.select(F.from_json("value", schema).alias("c")).select("c.*")
    code = F.coalesce("systemCode", F.lit(""))
    return c.select(
        code.alias("id"), code.alias("system_code"), F.coalesce("name", F.lit("")).alias("name"), "chamber", F.col("committeeTypeCode").alias("committee_type"),
        F.col("parent.systemCode").alias("parent_committee"), F.col("url").alias("source_url"),
    )


def filings_from_api(payloads: DataFrame) -> DataFrame:
    """Court filings from ``payloads`` (ordinal, value: the JSON of one filing); one without an id has its ordinal."""
    schema = "id string, title string, slug string, case_number string, document_type string, document_date string, excerpt string, page_count string, source_url string, file_url string"
    f = payloads.select("ordinal", F.from_json("value", schema).alias("f")).select("ordinal", "f.*")
    empty = F.lit("")
    return f.select(
        F.coalesce("id", F.col("ordinal").cast("string")).alias("id"), F.coalesce("title", "slug", empty).alias("title"), F.coalesce("case_number", empty).alias("case_number"),
        F.coalesce("document_type", empty).alias("document_type"), F.coalesce("document_date", empty).alias("date_filed"), F.coalesce("excerpt", empty).alias("content"),
        F.coalesce(F.expr("try_cast(page_count as int)"), F.lit(0)).alias("page_count"), F.coalesce("source_url", "file_url").alias("source_url"),
    )


def probe_metadata(files: DataFrame) -> DataFrame:
    """``files`` (probe: the JSON of a media probe) with duration and the first video and audio streams; what is missing is 0, empty or false."""
    schema = "format struct<duration:string,format_name:string>, streams array<struct<codec_type:string,codec_name:string,width:int,height:int,channels:int,sample_rate:string>>"
    p = files.withColumn("p", F.from_json("probe", schema))
    first = lambda kind: F.try_element_at(F.filter("p.streams", lambda s: s["codec_type"] == kind), F.lit(1))
    v, a = first("video"), first("audio")
    return p.select(
        *files.columns, F.coalesce(F.expr("try_cast(p.format.duration as double)"), F.lit(0.0)).alias("duration_seconds"), v.isNotNull().alias("has_video"), a.isNotNull().alias("has_audio"),
        F.coalesce(v["codec_name"], F.lit("")).alias("video_codec"), F.coalesce(v["width"], F.lit(0)).alias("width"), F.coalesce(v["height"], F.lit(0)).alias("height"),
        F.coalesce(a["codec_name"], F.lit("")).alias("audio_codec"), F.coalesce(a["channels"], F.lit(0)).alias("channels"),
    )
