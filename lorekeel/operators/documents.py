"""Projections of raw records into unified documents.

Every function returns the columns of ``DOCUMENT`` and is one ``select``. A record's optional parts
join its content only if they are neither null nor empty; the first part is always there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekeel.functions.scalars import falsy, first_truthy, stem, text_hash

#: Columns of a document, in order.
DOCUMENT = ["id", "title", "content", "source", "source_url", "document_type", "domain", "entity_type", "metadata", "sections", "content_hash"]


def joined(separator: str, first, *optional: tuple[str, Column | str]) -> Column:
    """``first`` (null: empty), then every (label, value) whose value is there, as label + value."""
    parts = [F.coalesce(F.col(first) if isinstance(first, str) else first, F.lit(""))]
    for label, value in optional:
        parts.append(F.concat(F.lit(label), falsy(value)))
    return F.concat_ws(separator, *parts)


def _map(**entries) -> Column:
    pairs = [x for k, v in entries.items() for x in (F.lit(k), (F.col(v) if isinstance(v, str) else v).cast("string"))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def _document(df: DataFrame, *, id, title, content, source, url, kind, domain, entity, metadata, sections=None) -> DataFrame:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.select(
        id.alias("id"), title.alias("title"), content.alias("content"), lit(source).alias("source"), url.alias("source_url"),
        F.lit(kind).alias("document_type"), lit(domain).alias("domain"), F.lit(entity).alias("entity_type"),
        metadata.alias("metadata"), (sections if sections is not None else _map()).alias("sections"),
    ).withColumn("content_hash", text_hash("content"))


def bill_documents(bills: DataFrame) -> DataFrame:
    head = F.concat(F.lit("Bill "), F.col("number").cast("string"), F.lit(" ("), F.coalesce("chamber", F.lit("")), F.lit(")"))
    return _document(
        bills, id=F.concat(F.lit("congress-bill-"), "id"), title=F.col("title"), content=joined(". ", head, ("", "summary"), ("", "title")),
        source="congress.gov", url=F.col("source_url"), kind="bill", domain="congress", entity="Bill",
        metadata=_map(congress="congress", bill_type="bill_type", chamber="chamber", policy_area="policy_area", introduced_date="introduced_date"),
        sections=_map(latest_action=F.coalesce("latest_action_text", F.lit(""))),
    )


def member_documents(members: DataFrame) -> DataFrame:
    seat = F.concat(falsy("party"), F.lit("-"), falsy("state"))
    return _document(
        members, id=F.concat(F.lit("congress-member-"), "id"), title=F.col("name"), content=joined(". ", "name", ("", seat), ("Chamber: ", "chamber")),
        source="congress.gov", url=F.col("source_url"), kind="member_profile", domain="congress", entity="Member",
        metadata=_map(bioguide_id="bioguide_id", party="party", state="state", district="district", terms_served="terms_served"),
    )


def committee_documents(committees: DataFrame) -> DataFrame:
    return _document(
        committees, id=F.concat(F.lit("congress-committee-"), "id"), title=F.col("name"),
        content=joined(". ", "name", ("Chamber: ", "chamber"), ("Type: ", "committee_type")),
        source="congress.gov", url=F.col("source_url"), kind="committee_profile", domain="congress", entity="Committee",
        metadata=_map(system_code="system_code", chamber="chamber", committee_type="committee_type", parent_committee="parent_committee"),
    )


def cable_documents(cables: DataFrame) -> DataFrame:
    return _document(
        cables, id=F.concat(F.lit("wikileaks-cable-"), "id"), title=first_truthy("subject", F.concat(F.lit("Cable "), "id")),
        content=joined("\n\n", "subject", ("Origin: ", "origin"), ("", "content")),
        source="wikileaks", url=F.col("source_url"), kind="cable", domain="open_leaks", entity="Cable",
        metadata=_map(date="date", origin="origin", classification="classification", tags=F.to_json("tags")),
    )


def offshore_documents(entities: DataFrame) -> DataFrame:
    source = F.concat(F.lit("icij-"), "source_dataset")
    return _document(
        entities, id=F.concat(source, F.lit("-"), "id"), title=first_truthy("name", F.concat(F.lit("Entity "), "id")),
        content=joined(". ", "name", ("Jurisdiction: ", "jurisdiction"), ("Country: ", "country"), ("Status: ", "status")),
        source=source, url=F.col("source_url"), kind="offshore_entity", domain="open_leaks", entity="OffshoreEntity",
        metadata=_map(entity_type="entity_type", jurisdiction="jurisdiction", country="country", source_dataset="source_dataset", incorporation_date="incorporation_date"),
    )


def court_documents(filings: DataFrame) -> DataFrame:
    return _document(
        filings, id=F.concat(F.lit("epstein-"), "id"), title=first_truthy("title", F.concat(F.lit("Document "), "id")),
        content=joined("\n\n", "title", ("Case: ", "case_number"), ("", "content")),
        source="epstein-court-files", url=F.col("source_url"), kind="court_document", domain="open_leaks", entity="CourtDocument",
        metadata=_map(case_number="case_number", document_type="document_type", date_filed="date_filed", page_count="page_count"),
    )


def media_documents(files: DataFrame) -> DataFrame:
    """``files``: path, filename, extension, size_bytes, source_dir and a metadata map whose entries win over those of the file."""
    own = _map(path="path", extension="extension", size_bytes="size_bytes", source_dir="source_dir")
    later = F.coalesce("metadata", _map())
    merged = F.map_concat(F.map_filter(own, lambda k, _: ~F.array_contains(F.map_keys(later), k)), later)
    return _document(
        files, id=F.concat(F.lit("media-"), F.substring(F.sha2("path", 256), 1, 16)), title=stem("filename"), content=F.lit(""),
        source=F.when(F.contains(F.lower("source_dir"), F.lit("metube")), "metube").otherwise("tubesync"), url=F.lit(None).cast("string"),
        kind="media", domain="media", entity="Media", metadata=merged,
    )


def union_documents(*parts: DataFrame) -> DataFrame:
    """All documents of several kinds."""
    return reduce(DataFrame.unionByName, parts)


def duplicate_groups(docs: DataFrame, text_col: str = "content", id_col: str = "id") -> DataFrame:
    """content_hash, copies and first_id of every non-empty text found more than once."""
    hashed = docs.select(text_hash(text_col).alias("content_hash"), F.col(id_col).alias("id")).where("content_hash <> ''")
    return hashed.groupBy("content_hash").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id")).where("copies > 1")
