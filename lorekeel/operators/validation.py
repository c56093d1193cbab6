"""Contract validation: rules over rows give coded errors; verdicts and repairs follow from them.

A rule is a condition with a code. All rules of a batch's rows are evaluated in one pass, as one array
expression whose entries are null where a rule holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.functions.scalars import MENTION_TYPES, alias_type, clamp01, falsy, h3_resolution, is_snake_case, is_wkt
from lorekeel.session import dealt

# What repairs an error of each code: action, and whether it can be applied without asking.
REPAIRS = {
    "SPAN_MISMATCH": ("replace", False),
    "INVALID_TYPE": ("coerce", False),
    "CONFIDENCE_OUT_OF_RANGE": ("coerce", True),
    "DUPLICATE_SPAN": ("delete", True),
    "INVALID_REFERENCE": ("delete", False),
    "COORDINATE_OUT_OF_RANGE": ("coerce", False),
    "SCORE_OUT_OF_RANGE": ("coerce", True),
    "UNKNOWN_ENTITY": ("delete", False),
}
#: Codes whose values are brought back into 0 to 1.
CLAMPED = ("CONFIDENCE_OUT_OF_RANGE", "SCORE_OUT_OF_RANGE")
# Kinds of mathematical statements and objects.
STATEMENT_KINDS = ["equation", "inequality", "definition", "theorem", "axiom", "conjecture"]
OBJECT_KINDS = ["variable", "constant", "function", "operator", "set", "relation"]


def rule(broken: Column, code: str, path: Column | str, message: Column | str, warning: bool = False) -> Column:
    """An error row where ``broken`` is true, else null; a null condition breaks nothing."""
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    found = F.struct(text(path).alias("path"), F.lit(code).alias("code"), text(message).alias("message"), F.lit(warning).alias("is_warning"))
    return F.when(broken, found)


def _errors(rows: DataFrame, rules: list[Column], keep: list[str]) -> DataFrame:
    """One row for each broken rule: ``keep`` and path, code, message, is_warning."""
    found = F.filter(F.array(*rules), lambda e: e.isNotNull())
    return rows.select(*keep, F.explode(found).alias("e")).select(*keep, "e.*")


def outside01(x) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return (x < 0) | (x > 1)


def at(kind: str, field: str) -> Column:
    """The path of a field of the item at ``pos``."""
    return F.concat(F.lit(f"{kind}["), F.col("pos").cast("string"), F.lit(f"].{field}"))


def mention_errors(mentions: DataFrame, texts: DataFrame) -> DataFrame:
    """Errors of ``mentions`` (batch_id, pos, text, mention_type, span_start, span_end, confidence, evidence) against ``texts`` (batch_id, text).

    A batch of ``texts`` without a mention has one EMPTY_EXTRACTION. Of mentions with one span all but the first are duplicates.
    """
    source = texts.select("batch_id", F.col("text").alias("_source"), F.length("text").alias("_length"))
    s, e = F.col("span_start"), F.col("span_end")
    in_range = (s >= 0) & (s < e) & (e <= F.coalesce("_length", F.lit(0)))
    again = F.row_number().over(Window.partitionBy("batch_id", "span_start", "span_end").orderBy("pos")) > 1
    # texts come last, so that they are not dealt out with every mention
    rows = mentions.withColumn("_again", again & s.isNotNull() & e.isNotNull()).join(dealt(source), "batch_id", "left")
    kind = alias_type("mention_type")
    slice_ = F.call_function("substring", F.col("_source"), s + 1, e - s)
    rules = [
        rule(falsy("text").isNull(), "MISSING_REQUIRED_FIELD", at("mentions", "text"), "text is missing"),
        rule(falsy("mention_type").isNull(), "MISSING_REQUIRED_FIELD", at("mentions", "mention_type"), "mention_type is missing"),
        rule(in_range & (slice_ != F.col("text")), "SPAN_MISMATCH", at("mentions", "span"), F.concat(F.lit("span holds "), slice_)),
        rule(s.isNotNull() & e.isNotNull() & ~in_range, "SPAN_MISMATCH", at("mentions", "span"), "span is out of range"),
        rule(falsy("mention_type").isNotNull() & ~kind.isin(MENTION_TYPES), "INVALID_TYPE", at("mentions", "mention_type"), "unknown type"),
        rule(outside01("confidence"), "CONFIDENCE_OUT_OF_RANGE", at("mentions", "confidence"), "confidence is outside 0 to 1"),
        rule(F.col("_again"), "DUPLICATE_SPAN", at("mentions", "span"), "span was used before"),
    ]
    if "evidence" in mentions.columns:
        uneven = F.exists("evidence", lambda v: F.length(v["text"]) != v["span_end"] - v["span_start"])
        rules.append(rule(uneven, "EVIDENCE_LENGTH", at("mentions", "evidence"), "evidence is not as long as its span", warning=True))
    found = _errors(rows, rules, ["batch_id", "pos"])
    empty = texts.join(dealt(mentions.select("batch_id").distinct()), "batch_id", "left_anti").select("batch_id", F.lit(None).cast("int").alias("pos"), F.lit("mentions").alias("path"), F.lit("EMPTY_EXTRACTION").alias("code"), F.lit("no mentions").alias("message"), F.lit(False).alias("is_warning"))
    return found.unionByName(empty)


def proposition_errors(propositions: DataFrame, known: DataFrame) -> DataFrame:
    """Errors of ``propositions`` (batch_id, pos, four ids, predicate, confidence, arguments) against ``known`` (batch_id, id).

    An id that is there, be it empty, must be known; so must the mention of each argument.
    """
    ids = ["subject_id", "object_id", "subject_mention_id", "object_mention_id"]
    refs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("id")) for c in ids))
    if "arguments" in propositions.columns:
        args = F.transform(F.coalesce("arguments", F.expr("cast(array() as array<struct<role:string,mention_id:string,text:string>>)")), lambda a: F.struct(F.lit("arguments").alias("field"), a["mention_id"].alias("id")))
        refs = F.concat(refs, args)
    asked = propositions.select("batch_id", "pos", F.explode(refs).alias("r")).select("batch_id", "pos", "r.*").where("id is not null")
    unknown = asked.join(known.select("batch_id", "id").distinct(), ["batch_id", "id"], "left_anti")
    bad = unknown.select("batch_id", "pos", F.concat(F.lit("propositions["), F.col("pos").cast("string"), F.lit("]."), "field").alias("path"), F.lit("INVALID_REFERENCE").alias("code"), F.concat(F.lit("unknown id "), "id").alias("message"), F.lit(False).alias("is_warning"))
    rules = [
        rule(~is_snake_case("predicate"), "PREDICATE_FORMAT", at("propositions", "predicate"), "predicate is not in snake case", warning=True),
        rule(outside01("confidence"), "CONFIDENCE_OUT_OF_RANGE", at("propositions", "confidence"), "confidence is outside 0 to 1"),
    ]
    return bad.unionByName(_errors(propositions, rules, ["batch_id", "pos"]))


def spatial_errors(candidates: DataFrame, max_resolution: int = 15) -> DataFrame:
    """Errors of groundings (batch_id, pos, lat, lon, h3_index, geometry_wkt, confidence); an index that is not hexadecimal has no resolution."""
    limit = F.coalesce("max_supported_precision", F.lit(max_resolution)) if "max_supported_precision" in candidates.columns else F.lit(max_resolution)
    rules = [
        rule((F.col("lat") < -90) | (F.col("lat") > 90), "COORDINATE_OUT_OF_RANGE", at("candidates", "lat"), "latitude is outside -90 to 90"),
        rule((F.col("lon") < -180) | (F.col("lon") > 180), "COORDINATE_OUT_OF_RANGE", at("candidates", "lon"), "longitude is outside -180 to 180"),
        rule(h3_resolution("h3_index") > limit, "PRECISION_EXCEEDED", at("candidates", "h3_index"), "cell is finer than supported"),
        rule(falsy("geometry_wkt").isNotNull() & ~is_wkt("geometry_wkt"), "INVALID_GEOMETRY", at("candidates", "geometry_wkt"), "no well-known text"),
        rule(outside01("confidence"), "CONFIDENCE_OUT_OF_RANGE", at("candidates", "confidence"), "confidence is outside 0 to 1"),
    ]
    return _errors(candidates, rules, ["batch_id", "pos"])


def math_errors(statements: DataFrame) -> DataFrame:
    """Errors of statements (batch_id, pos, kind, statement, objects of symbol and kind)."""
    objects = F.col("objects")
    rules = [
        rule(F.coalesce(~F.col("kind").isin(STATEMENT_KINDS), F.lit(True)), "INVALID_TYPE", at("statements", "kind"), "unknown kind"),
        rule(F.trim(F.coalesce("statement", F.lit(""))) == "", "MISSING_EVIDENCE", at("statements", "statement"), "statement is blank"),
        rule(F.exists(objects, lambda o: ~F.coalesce(o["kind"].isin(OBJECT_KINDS), F.lit(False))), "INVALID_TYPE", at("statements", "objects.kind"), "unknown kind of object"),
        rule(F.exists(objects, lambda o: F.trim(F.coalesce(o["symbol"], F.lit(""))) == ""), "MISSING_EVIDENCE", at("statements", "objects.symbol"), "object without a symbol"),
    ]
    return _errors(statements, rules, ["batch_id", "pos"])


def concordance_errors(sets: DataFrame, known: DataFrame) -> DataFrame:
    """Errors of concordance sets (batch_id, pos, candidates of entity_id and five scores) against ``known`` (entity_id)."""
    parts = ["exact", "substring", "jaccard", "cosine"]
    each = sets.select("batch_id", "pos", F.explode("candidates").alias("c")).select("batch_id", "pos", "c.*")
    unknown = each.where(falsy("entity_id").isNotNull()).join(known.select("entity_id").distinct(), "entity_id", "left_anti")
    bad = unknown.select("batch_id", "pos", F.concat(F.lit("sets["), F.col("pos").cast("string"), F.lit("].entity_id")).alias("path"), F.lit("UNKNOWN_ENTITY").alias("code"), F.concat(F.lit("unknown entity "), "entity_id").alias("message"), F.lit(False).alias("is_warning"))
    rules = [rule(outside01(c), "SCORE_OUT_OF_RANGE", at("sets", c), f"{c} is outside 0 to 1") for c in [*parts, "combined"]]
    rules.append(rule(F.col("combined") > F.greatest(*parts) + 0.01, "INCONSISTENT_SCORES", at("sets", "combined"), "combined is above every part", warning=True))
    return bad.unionByName(_errors(each, rules, ["batch_id", "pos"]))


def verdicts(items: DataFrame, errors: DataFrame, batches: DataFrame | None = None, empty: str = "valid") -> DataFrame:
    """(batch_id, verdict, valid_count, invalid_count, valid_items, invalid_items) of every batch.

    An item with an error that is no warning is invalid. valid: no item is; invalid: every item is; else ambiguous. A batch of
    ``batches`` without items has the verdict ``empty``. Item lists are as long as a batch.
    """
    bad = errors.where("not is_warning and pos is not null").select("batch_id", "pos", F.lit(True).alias("bad")).distinct()
    rows = items.select("batch_id", "pos").join(bad, ["batch_id", "pos"], "left").withColumn("bad", F.coalesce("bad", F.lit(False)))
    listed = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("pos"))))
    out = rows.groupBy("batch_id").agg(F.count_if(~F.col("bad")).alias("valid_count"), F.count_if(F.col("bad")).alias("invalid_count"), listed(~F.col("bad")).alias("valid_items"), listed(F.col("bad")).alias("invalid_items"))
    verdict = F.when(F.col("invalid_count") == 0, "valid").when(F.col("valid_count") == 0, "invalid").otherwise("ambiguous")
    out = out.select("batch_id", verdict.alias("verdict"), "valid_count", "invalid_count", "valid_items", "invalid_items")
    if batches is None:
        return out
    none = F.array().cast("array<int>")
    missing = batches.select("batch_id").distinct().join(out, "batch_id", "left_anti")
    return out.unionByName(missing.select("batch_id", F.lit(empty).alias("verdict"), F.lit(0).cast("long").alias("valid_count"), F.lit(0).cast("long").alias("invalid_count"), none.alias("valid_items"), none.alias("invalid_items")))


def repair_plan(errors: DataFrame) -> DataFrame:
    """A repair for each error (path, code, message, and optionally current_value): action, suggested_value, reason, auto_applicable.

    Numbers out of range are clamped, and only then is a coercion applied without asking. Unknown codes are replaced by hand.
    """
    current = F.col("current_value").cast("string") if "current_value" in errors.columns else F.lit(None).cast("string")
    number = F.expr("try_cast(_current as double)")
    table = lambda k: F.create_map(*(F.lit(x) for code, v in REPAIRS.items() for x in (code, v[k])))
    rows = errors.withColumn("_current", current)
    clamped = F.when(F.col("code").isin(*CLAMPED) & number.isNotNull(), clamp01(number).cast("string"))
    auto = F.coalesce(F.element_at(table(1), F.col("code")), F.lit(False)) & (~F.col("code").isin(*CLAMPED) | number.isNotNull())
    return rows.select(
        *[c for c in ("batch_id", "pos") if c in errors.columns], "path", F.coalesce(F.element_at(table(0), F.col("code")), F.lit("replace")).alias("action"), F.col("_current").alias("current_value"),
        clamped.alias("suggested_value"), F.concat_ws(": ", "code", "message").alias("reason"), auto.alias("auto_applicable"),
    )
