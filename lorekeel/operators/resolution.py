"""Entity resolution: mentions to candidates, candidates to aligned and canonical entities, assertions to entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.functions.scalars import content_hash, deterministic_id, jaccard, normalised, stripped, tokens
from lorekeel.operators.components import components_of
from lorekeel.operators.textjoin import containing_pairs, similar_pairs
from lorekeel.operators.vectors import similar_vectors
from lorekeel.session import cut, dealt

#: Words two surfaces must share; similarity of their word sets; cosine of their vectors.
SHARED_WORDS, WORD_SIMILARITY, VECTOR_SIMILARITY = 2, 0.6, 0.85
#: Scores of the signals of an alignment, what each further signal adds, and the scores from which on a pair is (possibly) the same.
SIGNALS = {"exact_name": 0.95, "substring": 0.80, "jaccard": 0.70, "embedding": 0.75}
BONUS, SAME, POSSIBLY_SAME = 0.05, 0.90, 0.65
ALIGN_SIMILARITY, ALIGN_COSINE = 0.5, 0.80


def surfaces(mentions: DataFrame) -> DataFrame:
    """(group, key, words, ordinal): the distinct normalised texts of each mention type, with the first ordinal."""
    keyed = mentions.select(F.col("mention_type").alias("group"), normalised("text").alias("key"), "ordinal")
    return keyed.groupBy("group", "key").agg(F.min("ordinal").alias("ordinal")).withColumn("words", tokens("key"))


def contained_pairs(names: DataFrame, least: int = SHARED_WORDS) -> DataFrame:
    """Distinct (group, a, b) of surfaces of which one holds the other and that share ``least`` words or more.

    Containment is much rarer than shared words, so it is looked up first.
    """
    texts = names.select("group", F.col("key").alias("text"))
    inside = containing_pairs(texts, texts).where("inner <> outer")
    words = lambda side: names.select("group", F.col("key").alias(side), F.col("words").alias(f"words_{side}"))
    both = inside.join(dealt(words("inner")), ["group", "inner"]).join(dealt(words("outer")), ["group", "outer"]).where(F.size(F.array_intersect("words_inner", "words_outer")) >= least)
    return both.select("group", F.least("inner", "outer").alias("a"), F.greatest("inner", "outer").alias("b")).distinct()


def surface_edges(names: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """Distinct (group, a, b) of surfaces that are the same entity: containment or word similarity, each with shared words, or vector similarity."""
    names = cut(names.select("group", "key", "words"))
    contained = contained_pairs(names, SHARED_WORDS)
    similar = similar_pairs(names, WORD_SIMILARITY, SHARED_WORDS).drop("similarity")
    edges = contained.unionByName(similar)
    if vectors is not None:
        known = names.select("group", "key").join(vectors.select(F.col("norm").alias("key"), "embedding"), "key")
        keyed = known.withColumn("id", F.struct("group", "key").cast("string"))
        ids = keyed.select("id", "group", "key")
        near = similar_vectors(keyed, VECTOR_SIMILARITY, "id", "embedding", "group")
        named = near.join(ids.select(F.col("id").alias("a"), "group", F.col("key").alias("key_a")), "a").join(ids.select(F.col("id").alias("b"), F.col("key").alias("key_b")), "b")
        edges = edges.unionByName(named.select("group", F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b")))
    return edges.distinct()


def _joined_mentions(mentions: DataFrame, vectors: DataFrame | None) -> DataFrame:
    """``mentions`` with norm and component, the (group, key) that stands for all surfaces of one entity."""
    names = cut(surfaces(mentions))
    node = F.struct("group", "key")
    edges = surface_edges(names, vectors)
    links = edges.select(F.struct("group", F.col("a").alias("key")).alias("u"), F.struct("group", F.col("b").alias("key")).alias("v"))
    linked = components_of(links)
    known = names.select(node.alias("node")).join(linked, "node", "left").select(F.col("node.group").alias("mention_type"), F.col("node.key").alias("norm"), F.coalesce("component", "node").alias("component"))
    return cut(mentions.withColumn("norm", normalised("text")).join(dealt(known), ["mention_type", "norm"]))


def entity_members(mentions: DataFrame, code_location: str, vectors: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Entities of ``mentions`` (ordinal, mention_id, document_id, text, mention_type) as one row each, and their members as rows of their own.

    The first: ordinal, candidate_id, canonical_name, candidate_type, mention_count, document_count, alias_count and code_location, each by aggregates that combine before their
    shuffle; the second: candidate_id, mention_id, document_id, text and ordinal of every mention. Entities are those of ``resolve_mentions``, but nothing
    lists an entity's mentions in one row, so one that a third of all mentions are of is no row too large.
    """
    rows = _joined_mentions(mentions, vectors)
    texts = cut(rows.groupBy("component", "text").agg(F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("first")))
    best = texts.groupBy("component").agg(F.min_by("text", F.struct((-F.col("n")).alias("n"), "first")).alias("canonical_name"), (F.count(F.lit(1)) - 1).alias("alias_count"), F.min("first").alias("ordinal"))
    # distinct first, so that a hot entity's mentions and documents are counted from many tasks
    ids = rows.select("component", "mention_id").distinct().groupBy("component").agg(F.count("mention_id").alias("mention_count"))
    documents = rows.select("component", "document_id").distinct().groupBy("component").agg(F.count("document_id").alias("document_count"))
    candidate = deterministic_id("canonical_name", "component.group", F.lit(code_location)).alias("candidate_id")
    named = cut(best.join(ids, "component").join(documents, "component").select("component", "ordinal", candidate, "canonical_name", F.col("component.group").alias("candidate_type"), "mention_count", "document_count", "alias_count"))
    members = rows.join(named.select("component", "candidate_id"), "component").select("candidate_id", "mention_id", "document_id", "text", "ordinal")
    return named.drop("component").withColumn("code_location", F.lit(code_location)), members


def resolve_mentions(mentions: DataFrame, code_location: str, vectors: DataFrame | None = None) -> DataFrame:
    """Entity candidates of ``mentions`` (ordinal, mention_id, document_id, text, mention_type); ``vectors``: (norm, embedding), optional.

    Mentions of one type with the same normalised text are one entity; surfaces join by ``surface_edges`` and whatever
    that connects. The canonical name is the commonest text, of equals the first seen; ids are in the order of the mentions. A row lists all of an entity's mentions and documents: where one may have very many, take ``entity_members``.
    """
    rows = _joined_mentions(mentions, vectors)

    texts = rows.groupBy("component", "text").agg(F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("first"))
    best = texts.groupBy("component").agg(F.min_by("text", F.struct((-F.col("n")).alias("n"), "first")).alias("canonical_name"), F.collect_set("text").alias("texts"))
    ids = rows.groupBy("component", "mention_id").agg(F.min("ordinal").alias("first"))
    ids = ids.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("first", "mention_id")))["mention_id"].alias("mention_ids"))
    rest = rows.groupBy("component").agg(F.array_sort(F.collect_set("document_id")).alias("source_documents"), F.min("ordinal").alias("ordinal"))
    out = best.join(ids, "component").join(rest, "component")
    out = out.select(
        "ordinal", deterministic_id("canonical_name", "component.group", F.lit(code_location)).alias("candidate_id"), "canonical_name",
        F.col("component.group").alias("candidate_type"), F.array_sort(F.array_remove("texts", F.col("canonical_name"))).alias("aliases"), "mention_ids",
        F.size("mention_ids").alias("mention_count"), F.create_map().cast("map<string,string>").alias("external_ids"), "source_documents", F.lit(code_location).alias("code_location"),
    )
    out = out.withColumn("content_hash", content_hash("canonical_name", "candidate_type", "code_location", F.array_join(F.array_sort("aliases"), ",")))
    if vectors is None:
        return out.withColumn("embedding", F.lit(None).cast("array<float>"))
    return out.withColumn("norm", normalised("canonical_name")).join(vectors.select("norm", "embedding").dropDuplicates(["norm"]), "norm", "left").drop("norm")


def name_groups(mentions: DataFrame) -> DataFrame:
    """(canonical, label, aliases, count) of ``mentions`` (ordinal, text, mention_type): names that are one entity across types.

    Names equal but for case and outer blanks are one whatever their type; containment and word similarity join names of one type, and
    groups run on over all types. The canonical name is the commonest, of equals the first seen; its label is the last one that it was given.
    """
    texts = mentions.select("ordinal", stripped("text").alias("text"), F.coalesce("mention_type", F.lit("")).alias("mention_type")).where("text <> ''")
    names = cut(surfaces(texts))
    linked = components_of(surface_edges(names).select("a", "b"), "a", "b")
    keys = names.select("key").distinct().join(linked.withColumnRenamed("node", "key"), "key", "left").select(F.col("key").alias("norm"), F.coalesce("component", "key").alias("component"))
    each = texts.groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("first"), F.max_by("mention_type", "ordinal").alias("label"))
    rows = each.withColumn("norm", normalised("text")).join(dealt(cut(keys)), "norm")
    best = F.min_by(F.struct("text", "label"), F.struct((-F.col("n")).alias("n"), "first")).alias("best")
    groups = rows.groupBy("component").agg(best, F.sum("n").alias("count"), F.array_sort(F.collect_list(F.struct("first", "text")))["text"].alias("texts"))
    return groups.select(F.col("best.text").alias("canonical"), F.col("best.label").alias("label"), F.array_remove("texts", F.col("best.text")).alias("aliases"), "count")


def align(candidates: DataFrame, locations: list[str]) -> DataFrame:
    """Alignment edges between candidates (candidate_id, canonical_name, candidate_type, aliases, code_location, embedding) of different locations.

    Every pair that has a signal is found by a join that the signal implies (a shared name, a name inside another, similar
    words, similar vectors), and then all its signals are scored. A pair's first candidate is of the location named first.
    """
    place = F.array_position(F.array(*(F.lit(x) for x in locations)), F.col("code_location"))
    names = F.array_distinct(F.transform(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>"))), lambda n: normalised(n)))
    rows = candidates.select("candidate_id", F.col("candidate_type").alias("group"), place.alias("place"), names.alias("names"), "embedding").where("place > 0")
    rows = cut(rows.withColumn("words", F.array_distinct(F.flatten(F.transform("names", lambda n: tokens(n))))))

    each = rows.select("group", "candidate_id", "place", F.explode("names").alias("name"))
    name_of = lambda side: each.select("group", F.col("candidate_id").alias(side), F.col("place").alias(f"place_{side}"), F.col("name").alias(f"name_{side}"))
    exact = name_of("a").join(name_of("b").withColumnRenamed("name_b", "name_a"), ["group", "name_a"]).where("place_a < place_b").select("a", "b")
    all_names = each.select("group", F.col("name").alias("text")).distinct()
    inside = cut(containing_pairs(all_names, all_names).where("inner <> outer"))
    both_ways = inside.select("group", F.col("inner").alias("name_a"), F.col("outer").alias("name_b")).unionByName(inside.select("group", F.col("outer").alias("name_a"), F.col("inner").alias("name_b")))
    substring = name_of("a").join(both_ways, ["group", "name_a"]).join(name_of("b"), ["group", "name_b"]).where("place_a < place_b").select("a", "b")
    similar = similar_pairs(rows.select("group", F.struct("place", "candidate_id").alias("key"), "words"), ALIGN_SIMILARITY, apart="place")
    similar = similar.select(F.col("a.candidate_id").alias("a"), F.col("b.candidate_id").alias("b"))
    vectors = rows.where("embedding is not null and size(embedding) > 0")
    near = similar_vectors(vectors, ALIGN_COSINE, "candidate_id", "embedding", "group").select("a", "b")
    places = rows.select("candidate_id", "place")
    near = near.join(places.select(F.col("candidate_id").alias("a"), F.col("place").alias("pa")), "a").join(places.select(F.col("candidate_id").alias("b"), F.col("place").alias("pb")), "b")
    near = near.where("pa <> pb").select(F.when(F.col("pa") < F.col("pb"), F.col("a")).otherwise(F.col("b")).alias("a"), F.when(F.col("pa") < F.col("pb"), F.col("b")).otherwise(F.col("a")).alias("b"))

    found = None
    for signal, pairs in (("exact_name", exact), ("substring", substring), ("jaccard", similar), ("embedding", near)):
        pairs = pairs.select("a", "b", F.lit(signal).alias("signal"))
        found = pairs if found is None else found.unionByName(pairs)
    signals = found.groupBy("a", "b").agg(F.collect_set("signal").alias("s"))
    return _scored(signals)


def _scored(signals: DataFrame) -> DataFrame:
    """Edges of (a, b, s): containment counts only without a shared name; the best signal's score and a bonus for every other."""
    order = F.array(*(F.lit(x) for x in SIGNALS))
    kept = F.when(F.array_contains("s", "exact_name"), F.array_remove("s", "substring")).otherwise(F.col("s"))
    rows = signals.withColumn("evidence", F.array_intersect(order, kept))
    score = F.array_max(F.transform("evidence", lambda s: F.element_at(F.create_map(*(F.lit(x) for kv in SIGNALS.items() for x in kv)), s)))
    rows = rows.withColumn("score", F.round(F.least(F.lit(1.0), score + BONUS * (F.size("evidence") - 1)), 3))
    kind = F.when(F.col("score") >= SAME, "sameAs").when(F.col("score") >= POSSIBLY_SAME, "possibleSameAs")
    rows = rows.withColumn("alignment_type", kind).where("alignment_type is not null")
    return rows.select(
        deterministic_id(F.least("a", "b"), F.greatest("a", "b"), "alignment_type").alias("edge_id"), F.col("a").alias("source_entity_id"), F.col("b").alias("target_entity_id"),
        "alignment_type", "score", "evidence", F.lit("cross_source_aligner_v1").alias("method"),
    )


def canonical_entities(candidates: DataFrame, alignments: DataFrame) -> DataFrame:
    """Candidates joined over ``sameAs`` edges; one without an edge stays alone.

    The name, type and vector are those of the member with most mentions, of equals the first. The id is made of the sorted
    candidate ids, so that a rerun gives the same one.
    """
    same = alignments.where("alignment_type = 'sameAs'")
    linked = components_of(same, "source_entity_id", "target_entity_id")
    rows = candidates.join(linked.withColumnRenamed("node", "candidate_id"), "candidate_id", "left").withColumn("component", F.coalesce("component", "candidate_id"))
    first = F.struct((-F.col("mention_count")).alias("n"), "ordinal")
    grouped = rows.groupBy("component").agg(
        F.min_by(F.struct("canonical_name", "candidate_type", "embedding"), first).alias("p"),
        F.array_distinct(F.flatten(F.collect_list(F.concat(F.array("canonical_name"), "aliases")))).alias("names"),
        F.array_sort(F.collect_list(F.struct("ordinal", "candidate_id")))["candidate_id"].alias("source_candidate_ids"),
        F.array_sort(F.collect_set("code_location")).alias("source_code_locations"), F.sum("mention_count").cast("long").alias("mention_count"), F.min("ordinal").alias("ordinal"),
    )
    return grouped.select(
        "ordinal", F.substring(F.sha2(F.array_join(F.array_sort("source_candidate_ids"), "|"), 256), 1, 16).alias("canonical_id"), F.col("p.canonical_name").alias("canonical_name"),
        F.col("p.candidate_type").alias("entity_type"), F.array_sort(F.array_remove("names", F.col("p.canonical_name"))).alias("aliases"),
        "source_candidate_ids", "source_code_locations", "mention_count", F.col("p.embedding").alias("embedding"),
    )


def name_index(entities: DataFrame) -> DataFrame:
    """(key, canonical_id, place): each normalised name or alias with the entity that had it first; names go before aliases."""
    each = entities.select("ordinal", "canonical_id", F.posexplode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("pos", "name"))
    place = F.struct("ordinal", "pos")
    return each.groupBy(normalised("name").alias("key")).agg(F.min_by("canonical_id", place).alias("canonical_id"), F.min(place).alias("place"))


def link_keys(keys: DataFrame, index: DataFrame) -> DataFrame:
    """(key, canonical_id) of each distinct key: the entity of that name, else of the first name in index order that holds it or lies in it."""
    keys = cut(keys.select("key").where("key is not null").distinct())
    index = cut(index)
    exact = keys.join(index.select("key", "canonical_id"), "key")
    missed = keys.join(index, "key", "left_anti").where("key <> ''")
    one = F.lit(0).alias("group")
    asked, names = missed.select(one, F.col("key").alias("text")), index.select(one, F.col("key").alias("text"))
    inside = containing_pairs(asked, names).select(F.col("inner").alias("key"), F.col("outer").alias("name"))
    around = containing_pairs(names, asked).select(F.col("outer").alias("key"), F.col("inner").alias("name"))
    near = inside.unionByName(around).join(index.withColumnRenamed("key", "name"), "name")
    return exact.unionByName(near.groupBy("key").agg(F.min_by("canonical_id", "place").alias("canonical_id")))


def link_assertions(assertions: DataFrame, entities: DataFrame) -> DataFrame:
    """``assertions`` (subject_text, object_text, ...) with subject_canonical_id and object_canonical_id, null where no entity fits.

    Each distinct text is looked up once; a subject that a third of all rows share costs one lookup.
    """
    keyed = assertions.withColumn("_s", normalised("subject_text")).withColumn("_o", normalised("object_text"))
    keys = keyed.select(F.col("_s").alias("key")).unionByName(keyed.select(F.col("_o").alias("key")))
    found = cut(link_keys(keys, name_index(entities)))
    out = keyed.join(found.select(F.col("key").alias("_s"), F.col("canonical_id").alias("subject_canonical_id")), "_s", "left")
    out = out.join(found.select(F.col("key").alias("_o"), F.col("canonical_id").alias("object_canonical_id")), "_o", "left")
    return out.drop("_s", "_o")


def with_entity_names(linked: DataFrame, entities: DataFrame) -> DataFrame:
    """``linked`` assertions with subject_name and object_name: the canonical name of a linked end, the text as it was of one that is not.

    Entities of one id are one row here; an entity that a third of all assertions name is a hot key of a join that adaptive execution splits.
    """
    names = cut(entities.groupBy("canonical_id").agg(F.min_by("canonical_name", "ordinal").alias("name")))
    of = lambda end: names.select(F.col("canonical_id").alias(f"{end}_canonical_id"), F.col("name").alias(f"_{end}"))
    out = linked.join(of("subject"), "subject_canonical_id", "left").join(of("object"), "object_canonical_id", "left")
    return out.select(*linked.columns, F.coalesce("_subject", "subject_text").alias("subject_name"), F.coalesce("_object", "object_text").alias("object_name"))


def link_status():
    """full, partial or none, by which canonical ids are there."""
    s, o = F.col("subject_canonical_id").isNotNull(), F.col("object_canonical_id").isNotNull()
    return F.when(s & o, "full").when(s | o, "partial").otherwise("none")


def link_counts(linked: DataFrame) -> DataFrame:
    status = linked.select(link_status().alias("s"))
    return status.agg(*(F.count_if(F.col("s") == s).alias(f"n_{s}") for s in ("full", "partial", "none")))


def word_similarity(a, b):
    """Jaccard similarity of the words of two texts."""
    return jaccard(tokens(a), tokens(b))


def top_group_names(rows: DataFrame, group: str, name: str, n: int) -> DataFrame:
    """The ``n`` commonest names of each group, of equals the first by name."""
    counts = rows.groupBy(group, name).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), name))
    return counts.withColumn("place", place).where(F.col("place") <= n)
