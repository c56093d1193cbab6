"""Look-ups of mentions, assertions, entities and files by name, document or facet.

Those for many names at once are equi-joins on normalised names; conditions are columns, so that they are pushed into scans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.functions.scalars import falsy, file_name, stem
from lorekeel.operators.explore import contains_fold
from lorekeel.operators.textjoin import containing_pairs


def _names(*columns) -> Column:
    """Lower-cased name and aliases, without nulls, once each."""
    name, aliases = columns
    every = F.concat(F.array(name), F.coalesce(aliases, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(F.transform(every, lambda n: F.lower(n)), lambda n: n.isNotNull()))


def multi_source(locations: str = "source_code_locations") -> Column:
    """Entities that more than one location knows."""
    return F.size(locations) > 1


def candidate_filter(kind: str | None = None, search: str | None = None, least: int = 1) -> Column:
    """Candidates by type (case aside), by a part of their name or an alias, and by mentions."""
    tests = [F.lit(True)]
    if kind:
        tests.append(F.upper("candidate_type") == kind.upper())
    if search:
        tests.append(contains_fold("canonical_name", search) | F.exists("aliases", lambda a: F.contains(F.lower(a), F.lit(search.lower()))))
    if least > 1:
        tests.append(F.coalesce("mention_count", F.lit(0)) >= least)
    return reduce(lambda a, b: a & b, tests)


def mention_filter(kinds: list[str] | None = None, part: str | None = None) -> Column:
    """Mentions of some types (none given: of any) whose text holds a part, case aside."""
    of_kind = F.coalesce("mention_type", F.lit("")).isin(kinds) if kinds else F.lit(True)
    return of_kind & (contains_fold(F.coalesce("text", F.lit("")), part) if part else F.lit(True))


def faceted(**wanted: str | None) -> Column:
    """Rows whose facets equal those given; a facet that is None is not asked."""
    return reduce(lambda a, b: a & b, (F.col(c) == v for c, v in wanted.items() if v is not None), F.lit(True))


def assets_of(layer: str, part: str) -> Column:
    """Assets of a layer whose name holds a part."""
    return (F.col("layer") == layer) & contains_fold("name", part)


def low_confidence(below: float = 0.5, column: str = "confidence") -> Column:
    """Rows to be warned of; one without a confidence is not."""
    return F.coalesce(F.col(column) < below, F.lit(False))


def document_mentions(mentions: DataFrame, documents: DataFrame) -> DataFrame:
    """``mentions`` of ``documents`` (document_id) with ``place``: the order of their spans in the document, one without a start as at 0, of equals by ordinal."""
    order = Window.partitionBy("document_id").orderBy(F.coalesce("span_start", F.lit(0)), "ordinal")
    return mentions.join(documents.select("document_id").distinct(), "document_id", "left_semi").withColumn("place", F.row_number().over(order))


def assertions_about(assertions: DataFrame, names: DataFrame, subject: str = "subject_text", object_: str = "object_text") -> DataFrame:
    """``assertions`` with ``name`` for every name of ``names`` that is their subject or object, case aside; once for a name that is both."""
    asked = names.select("name", F.lower("name").alias("key")).distinct()
    ends = F.array_distinct(F.array(F.lower(subject), F.lower(object_)))
    return assertions.withColumn("key", F.explode(ends)).join(asked, "key").drop("key")


def entities_named(entities: DataFrame, names: DataFrame, aliases: bool = False) -> DataFrame:
    """(name, canonical_id) of the first entity by ordinal that has each name, case aside, or with ``aliases`` has it as an alias."""
    known = _names("canonical_name", "aliases") if aliases else F.array(F.lower("canonical_name"))
    keyed = entities.select("ordinal", "canonical_id", F.explode(known).alias("key"))
    first = keyed.groupBy("key").agg(F.min_by("canonical_id", "ordinal").alias("canonical_id"))
    return names.select("name", F.lower("name").alias("key")).distinct().join(first, "key").select("name", "canonical_id")


def document_entities(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """``rows`` with ``asked`` for every document of ``documents`` that is their document_id or source_doc_id."""
    ids = F.array_distinct(F.array("document_id", "source_doc_id"))
    return rows.withColumn("asked", F.explode(ids)).join(documents.select(F.col("document_id").alias("asked")).distinct(), "asked", "left_semi")


def entity_context(chunks: DataFrame, mentions: DataFrame, names: DataFrame) -> DataFrame:
    """(name, and the columns of ``chunks``) for every chunk with a mention of each name, case aside, once for a chunk."""
    asked = names.select("name", F.lower("name").alias("key")).distinct()
    found = mentions.where("chunk_id is not null").select("chunk_id", F.lower("text").alias("key")).join(asked, "key").select("name", "chunk_id").distinct()
    return chunks.join(found, "chunk_id")


def candidate_mentions(candidates: DataFrame, mentions: DataFrame) -> DataFrame:
    """(candidate_id, mention_id): mentions that name their candidate; for candidates that none names, mentions whose text is their name or an alias, case aside."""
    named = mentions.where(falsy("candidate_id").isNotNull()).select("candidate_id", "mention_id").join(candidates.select("candidate_id").distinct(), "candidate_id", "left_semi")
    bare = candidates.join(named.select("candidate_id").distinct(), "candidate_id", "left_anti")
    keys = bare.select("candidate_id", F.explode(_names("canonical_name", "aliases")).alias("key"))
    by_text = keys.join(mentions.select("mention_id", F.lower("text").alias("key")), "key").select("candidate_id", "mention_id")
    return named.unionByName(by_text)


def transcripts_of(files: DataFrame, transcripts: DataFrame) -> DataFrame:
    """(path, document_id) of every transcript (document_id, filename) whose file name holds a media file's stem, case aside; ``files`` (path).

    Stems shorter than a trigram are looked up whole, as in ``containing_pairs``.
    """
    one = F.lit(0).alias("group")
    stems = files.select("path", F.lower(stem("path")).alias("inner"))
    named = transcripts.select("document_id", F.lower("filename").alias("outer"))
    pairs = containing_pairs(stems.select(one, F.col("inner").alias("text")), named.select(one, F.col("outer").alias("text")))
    return pairs.join(stems, "inner").join(named, "outer").select("path", "document_id")


def metadata_of(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """(path, and the columns of ``metadata``) by equal file names."""
    named = files.select("path", file_name("path").alias("filename"))
    return named.join(metadata, "filename")
