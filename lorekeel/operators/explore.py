"""Filters, counts and statistics over assertions, mentions, documents and entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.functions.scalars import any_of, falsy, first_truthy, stripped
from lorekeel.session import dealt, parts_for

#: Qualifiers whose coverage is counted, and layers in their order.
QUALIFIERS = ["time", "location", "condition", "manner", "purpose"]
LAYERS = ["bronze", "silver", "gold", "platinum"]


def contains_fold(text, part) -> Column:
    """Whether a text holds a part, case aside."""
    return F.contains(F.lower(text), F.lower(F.lit(part) if isinstance(part, str) else part))


def confident_at_least(x, least: float) -> Column:
    """Confidence of at least ``least``; one that is not known passes."""
    return F.col(x).isNull() | (F.col(x) >= least)


def endpoints_present(subject: str = "subject_text", object_: str = "object_text") -> Column:
    return (stripped(F.coalesce(subject, F.lit(""))) != "") & (stripped(F.coalesce(object_, F.lit(""))) != "")


def focused(entity: str, columns: list[str]) -> Column:
    """Whether any of the columns holds the entity, case aside."""
    return any_of([F.coalesce(contains_fold(c, entity), F.lit(False)) for c in columns])


def labelled(subject: str, object_: str, labels: list[str], all_selected: bool = False) -> Column:
    """Whether either end has one of the labels or none that is known; all pass if all labels are selected."""
    if all_selected:
        return F.lit(True)
    wanted = [*labels, "UNKNOWN"]
    return F.col(subject).isin(wanted) | F.col(object_).isin(wanted)


def located(column: str, locations: list[str]) -> Column:
    """One of the locations, or none given."""
    return falsy(column).isNull() | F.col(column).isin(locations)


def matching_text(pattern: str, columns: list[str]) -> Column:
    """Whether a regular expression, case aside, is found in any column."""
    return any_of([F.coalesce(F.col(c).cast("string").rlike("(?i)" + pattern), F.lit(False)) for c in columns])


def entity_filter(kind: str | None = None, source: str | None = None, search: str | None = None) -> Column:
    """Canonical entities by type, by a source location they have, and by a part of their name or an alias."""
    tests = [F.lit(True)]
    if kind:
        tests.append(F.col("entity_type") == kind)
    if source:
        tests.append(F.array_contains("source_code_locations", source))
    if search:
        tests.append(contains_fold("canonical_name", search) | F.exists("aliases", lambda a: F.contains(F.lower(a), F.lit(search.lower()))))
    return reduce(lambda a, b: a & b, tests)


def facet_counts(rows: DataFrame, facet: str) -> DataFrame:
    """(value, n) of a facet; null and empty count as ``unknown``."""
    return rows.groupBy(first_truthy(facet, F.lit("unknown")).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def layer_counts(assets: DataFrame, layer: str = "layer", order: list[str] = LAYERS) -> DataFrame:
    """(layer, n, place): counts by layer in a fixed order; others come last."""
    place = F.array_position(F.array(*(F.lit(x) for x in order)), F.col("layer")).cast("int")
    counts = assets.groupBy(F.col(layer).alias("layer")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("place", F.when(F.coalesce(place, F.lit(0)) == 0, len(order) + 1).otherwise(place)).orderBy("place", "layer")


def top_counts(rows: DataFrame, column, n: int, name: str = "value") -> DataFrame:
    """The ``n`` commonest values, of equals the first."""
    column = F.col(column) if isinstance(column, str) else column
    return rows.groupBy(column.alias(name)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name).limit(n)


def flag_breakdown(assertions: DataFrame) -> DataFrame:
    """total, negated, hedged and confident = total - negated - hedged; an assertion with both flags is taken away twice."""
    out = assertions.agg(F.count(F.lit(1)).alias("total"), F.count_if("negated").alias("negated"), F.count_if("hedged").alias("hedged"))
    return out.withColumn("confident", F.col("total") - F.col("negated") - F.col("hedged"))


def average_confidence(assertions: DataFrame, column: str = "confidence") -> DataFrame:
    return assertions.agg(F.coalesce(F.avg(column), F.lit(0.0)).alias("avg_confidence"))


def qualifier_coverage(assertions: DataFrame, names: list[str] = QUALIFIERS, column: str = "qualifiers") -> DataFrame:
    """(qualifier, n) of assertions that have a non-empty value for it; qualifiers that none has are rows with 0."""
    counts = assertions.agg(*(F.count_if(F.coalesce(F.element_at(column, q), F.lit("")) != "").alias(q) for q in names))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(q).alias("qualifier"), F.col(q).alias("n")) for q in names))).alias("r")).select("r.*")


def node_degree(edges: DataFrame, subject: str = "subject_text", object_: str = "object_text") -> DataFrame:
    """(node, degree): how often a node is an end of an edge; a loop counts twice."""
    ends = edges.select(F.explode(F.array(subject, object_)).alias("node")).where("node is not null")
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def node_size(degrees: DataFrame) -> DataFrame:
    """Degrees with ``size``: 15 plus up to 25 by the share of the largest degree, cut to whole numbers."""
    most = degrees.agg(F.greatest(F.max("degree"), F.lit(1)).alias("most"))
    return degrees.join(F.broadcast(most)).withColumn("size", F.floor(15 + F.col("degree") / F.col("most") * 25).cast("int")).drop("most")


def histogram(rows: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, n) of ``bins`` equal parts of the range, the last one closed; parts without rows have 0.

    Where all values are equal the range is half a unit to either side.
    """
    x = F.col(column).cast("double")
    ends = rows.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).where("lo is not null")
    ends = ends.select(F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"), F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    placed = rows.where(x.isNotNull()).select(x.alias("x")).join(F.broadcast(ends)).groupBy(F.least(F.width_bucket("x", "lo", "hi", F.lit(bins)), F.lit(bins)).cast("int").alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    every = ends.select("lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    out = every.join(placed.agg(F.count(F.lit(1)).alias("n")), "bin", "left")
    return out.select("bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("low"), (F.col("lo") + F.col("bin") * width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def mention_statistics(mentions: DataFrame) -> DataFrame:
    """total, distinct documents and distinct texts."""
    return mentions.agg(F.count(F.lit(1)).alias("total"), F.countDistinct("document_id").alias("n_documents"), F.countDistinct("text").alias("n_texts"))


def occurrence_counts(mentions: DataFrame) -> DataFrame:
    """(text, mention_type, n)."""
    return mentions.groupBy("text", "mention_type").agg(F.count(F.lit(1)).alias("n"))


def cooccurrence(mentions: DataFrame, targets: DataFrame | None = None, unit: str = "chunk_id", entity: str = "entity") -> DataFrame:
    """(a, b, n): in how many units two entities occur together, a before b; only pairs of ``targets`` (entity), if given.

    Each entity counts once a unit. Pairs are made within units, which are chunks, and are combined before the shuffle.
    """
    rows = mentions.select(F.col(unit).alias("u"), F.col(entity).alias("e")).where("e is not null")
    if targets is not None:
        rows = rows.join(targets.select(F.col(entity).alias("e")).distinct(), "e", "left_semi")
    # one row: how many pairs there can be, which says how many tasks they are worth
    rows_of_units = rows.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    most = rows_of_units.agg(F.sum(F.col("n") * (F.col("n") + 1) / 2)).first()[0] or 0
    parts = parts_for(int(most))
    rows = rows.repartition(parts, "u").distinct()
    a, b = rows.withColumnRenamed("e", "a"), rows.withColumnRenamed("e", "b")
    return a.join(dealt(b), "u").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def first_by(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an order."""
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_place = 1").drop("_place")


def page(rows: DataFrame, order: list, number: int, size: int = 100) -> DataFrame:
    """Page ``number`` (from 0) of an order."""
    return rows.orderBy(*order).offset(number * size).limit(size)


def joined_label(entities: DataFrame, labels: DataFrame, key: str = "text") -> DataFrame:
    """``entities`` with the last label given to each (``labels``: key, label, ordinal), ``UNKNOWN`` without one."""
    last = labels.groupBy(key).agg(F.max_by("label", "ordinal").alias("label"))
    return entities.join(last, key, "left").withColumn("label", F.coalesce("label", F.lit("UNKNOWN")))


def alignments_of(edges: DataFrame, entity_id: str, names: DataFrame) -> DataFrame:
    """Edges at an entity with ``other_id`` and ``other_name`` (the id where no name is known)."""
    mine = edges.where((F.col("source_entity_id") == entity_id) | (F.col("target_entity_id") == entity_id))
    other = F.when(F.col("source_entity_id") == entity_id, F.col("target_entity_id")).otherwise(F.col("source_entity_id"))
    named = mine.withColumn("other_id", other).join(names.select(F.col("canonical_id").alias("other_id"), "canonical_name"), "other_id", "left")
    return named.withColumn("other_name", F.coalesce("canonical_name", "other_id")).drop("canonical_name")


def with_mentions(chunks: DataFrame, mentions: DataFrame, most: int = 12) -> DataFrame:
    """Chunks with ``mentions``: the first ``most`` different (text, type) of each, in order."""
    once = first_by(mentions, ["chunk_id", "text", "mention_type"], ["ordinal"])
    place = F.row_number().over(Window.partitionBy("chunk_id").orderBy("ordinal"))
    kept = once.withColumn("_p", place).where(F.col("_p") <= most)
    listed = kept.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "text", "mention_type"))).alias("mentions"))
    return chunks.join(listed, "chunk_id", "left")


def counts_by(rows: DataFrame, *columns: str) -> DataFrame:
    """(columns, n): how many rows have each combination; nulls are a value."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def alignment_counts(edges: DataFrame) -> DataFrame:
    """One row: edges of each of the two kinds."""
    kinds = {"same_as": "sameAs", "possible_same_as": "possibleSameAs"}
    return edges.agg(*(F.count_if(F.col("alignment_type") == k).alias(c) for c, k in kinds.items()))


def reduction_ratio(mentions: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: distinct surfaces (text and type), candidates, and candidates for each surface to three places."""
    surfaces = mentions.select(F.lower("text").alias("t"), "mention_type").distinct().agg(F.count(F.lit(1)).alias("n_surfaces"))
    found = candidates.agg(F.count(F.lit(1)).alias("n_candidates"))
    both = surfaces.join(F.broadcast(found))
    return both.withColumn("ratio", F.round(F.col("n_candidates") / F.greatest("n_surfaces", F.lit(1)), 3))


def label_degrees(degrees: DataFrame, labels: DataFrame, most: int = 20) -> DataFrame:
    """(label, node, degree, place): the nodes of most degree under each label, of equals the first by name; a node without a label is UNKNOWN.

    ``labels``: (key, label, ordinal) by lower-cased name; the last label given counts.
    """
    last = labels.groupBy("key").agg(F.max_by("label", "ordinal").alias("label"))
    named = degrees.withColumn("key", F.lower("node")).join(last, "key", "left").withColumn("label", F.coalesce("label", F.lit("UNKNOWN")))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("degree"), "node"))
    return named.withColumn("place", place).where(F.col("place") <= most).select("label", "node", "degree", "place")


def entity_averages(entities: DataFrame) -> DataFrame:
    """One row: entities, mentions and aliases for each; 0 where there are none."""
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    aliases = F.sum(F.size(F.coalesce("aliases", F.array().cast("array<string>"))))
    return entities.agg(
        F.count(F.lit(1)).alias("n"), (F.coalesce(F.sum("mention_count"), F.lit(0)) / n).alias("mentions_each"), (F.coalesce(aliases, F.lit(0)) / n).alias("aliases_each"),
    )


def known_languages(rows: DataFrame, column: str = "language") -> DataFrame:
    """(language) of all rows, once each, without ``unknown`` and nulls."""
    return rows.select(F.col(column).alias("language")).where("language <> 'unknown'").distinct()


def ordered(rows: DataFrame, by: str, name: str = "canonical_name", count: str = "mention_count", aliases: str = "aliases", ordinal: str = "ordinal") -> DataFrame:
    """Rows by ``count`` or ``aliases`` (most first), ``name`` (case aside) or ``length`` of the name (longest first); equals stay as they came."""
    keys = {"count": F.desc(F.coalesce(count, F.lit(0))), "aliases": F.desc(F.size(aliases)), "name": F.asc(F.lower(name)), "length": F.desc(F.length(name))}
    return rows.orderBy(keys[by], ordinal)


def with_lineage(**parts: DataFrame) -> DataFrame:
    """Rows of several sources with ``_source``: the source that a row names itself, else the one it came from."""
    named = []
    for source, rows in parts.items():
        own = F.col("_source") if "_source" in rows.columns else F.lit(None).cast("string")
        named.append(rows.withColumn("_source", F.coalesce(own, F.lit(source))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
