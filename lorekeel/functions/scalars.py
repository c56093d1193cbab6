"""Column functions shared by the operators: identifiers, text normalisation, similarity and small parsers.

All of them are built from Spark's own functions and stay in the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The kinds a mention may have, and other spellings of them.
MENTION_TYPES = ["PERSON", "ORG", "GPE", "LOC", "DATE", "LAW", "EVENT", "MONEY", "NORP", "FACILITY", "OTHER"]
TYPE_ALIASES = {
    "ORGANIZATION": "ORG",
    "LOCATION": "LOC",
    "GEOPOLITICAL_ENTITY": "GPE",
    "GEO_POLITICAL_ENTITY": "GPE",
    "GEOGRAPHIC": "LOC",
    "COMPANY": "ORG",
    "COUNTRY": "GPE",
    "CITY": "GPE",
    "STATE": "GPE",
}

# Canonical predicates of the legislative and of the leaked documents.
LEGISLATIVE_PREDICATES = {
    "is a member of": "member_of",
    "is member of": "member_of",
    "belongs to": "member_of",
    "sponsored": "sponsors",
    "co-sponsored": "co_sponsors",
    "cosponsored": "co_sponsors",
    "introduced": "introduces",
    "voted for": "votes_for",
    "voted against": "votes_against",
    "chairs": "chairs",
    "chaired": "chairs",
    "opposes": "opposes",
    "opposed": "opposes",
    "supports": "supports",
    "supported": "supports",
}
LEAK_PREDICATES = {
    "is owned by": "owned_by",
    "owns": "owns",
    "directed": "directs",
    "directs": "directs",
    "transferred to": "transfers_to",
    "transferred funds to": "transfers_to",
    "is registered in": "registered_in",
    "registered in": "registered_in",
    "incorporated in": "registered_in",
    "associated with": "associated_with",
    "is associated with": "associated_with",
    "linked to": "associated_with",
    "reports to": "reports_to",
    "financed": "finances",
    "finances": "finances",
    "funded": "finances",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def falsy(x) -> Column:
    """Null where a string is null or empty, so that ``coalesce`` skips both."""
    return F.nullif(_c(x), F.lit(""))


def first_truthy(*columns) -> Column:
    """The first string that is neither null nor empty."""
    return F.coalesce(*(falsy(c) for c in columns))


def deterministic_id(*parts) -> Column:
    """First 16 hexadecimal digits of the SHA-256 of the parts joined by ``|``; nulls count as empty."""
    joined = F.concat_ws("|", *(F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts))
    return F.substring(F.sha2(joined, 256), 1, 16)


def content_hash(*parts) -> Column:
    """SHA-256 of the parts joined by ``|``; nulls count as empty."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts)), 256)


def text_hash(text) -> Column:
    """SHA-256 of a text; empty for a null or empty one."""
    return F.when(falsy(text).isNotNull(), F.sha2(_c(text), 256)).otherwise("")


def flag_text(flag) -> Column:
    """``True`` or ``False`` with a capital, as identifiers spell flags."""
    return F.when(_c(flag), "True").otherwise("False")


def stripped(text) -> Column:
    """Without white space of any script at either end; a run of blanks inside is walked once."""
    return F.regexp_replace(_c(text), r"(?U)^\s++|(?<!\s)\s++$", "")


def normalised(text) -> Column:
    """Lower case, stripped: the key by which names are compared."""
    return stripped(F.lower(_c(text)))


def tokens(text) -> Column:
    """Distinct lower-cased words, in order; none for a blank text."""
    norm = normalised(text)
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(norm, r"(?U)\s+")))


def jaccard(a, b) -> Column:
    """Shared part of two word lists; 0 if either is empty."""
    a, b = _c(a), _c(b)
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def dot(a, b) -> Column:
    """Inner product in double precision, left to right."""
    pairs = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def cosine(a, b) -> Column:
    """Cosine of two vectors; 0 if lengths differ, or either is null, empty or without length."""
    a, b = _c(a), _c(b)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    usable = a.isNotNull() & b.isNotNull() & (F.size(a) == F.size(b)) & (F.size(a) > 0)
    return F.when(usable & (norms > 0), dot(a, b) / norms).otherwise(0.0)


def mapped(value, table: dict[str, str], default: Column | None = None) -> Column:
    """``table`` as a lookup; ``default`` (or the value) where it has no entry."""
    found = F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), _c(value))
    return F.coalesce(found, _c(value) if default is None else default)


def canonical_predicate(raw, table: dict[str, str]) -> Column:
    """The predicate that ``table`` has for a normalised one, or the normalised one itself."""
    return mapped(normalised(raw), table)


def mention_type(raw) -> Column:
    """Upper case, stripped; ``OTHER`` if that is no known kind."""
    upper = stripped(F.upper(_c(raw)))
    return F.when(upper.isin(MENTION_TYPES), upper).otherwise("OTHER")


def alias_type(raw) -> Column:
    """Upper case, with other spellings resolved; unknown kinds stay."""
    return mapped(F.upper(_c(raw)), TYPE_ALIASES)


def iso_date(text) -> Column:
    """A date from the first ten characters; null if they are none."""
    return F.try_to_date(F.substring(_c(text), 1, 10))


def year_date(year, end: bool = False) -> Column:
    """January 1 or December 31 of a year; null without one."""
    return F.try_to_date(F.concat(_c(year).cast("string"), F.lit("-12-31" if end else "-01-01")))


def subject_line(body) -> Column:
    """What follows SUBJECT: or SUBJ: on the first line that starts so; empty if none does."""
    return F.coalesce(stripped(F.regexp_extract(_c(body), r"(?im)^[^\S\r\n]*(?:SUBJECT|SUBJ):(.*)$", 1)), F.lit(""))


def tag_list(body) -> Column:
    """Comma-separated entries of the first line that starts with TAGS:, without blank ones."""
    line = F.regexp_extract(F.coalesce(_c(body), F.lit("")), r"(?im)^[^\S\r\n]*TAGS:(.*)$", 1)
    return F.filter(F.transform(F.split(line, ","), stripped), lambda t: t != "")


def is_snake_case(text) -> Column:
    return _c(text).rlike(r"^[a-z][a-z0-9]*+(?:_[a-z0-9]++)*+$")


def is_wkt(text) -> Column:
    """Well-known text of one of the seven geometry kinds."""
    return _c(text).rlike(r"(?is)^(POINT|LINESTRING|POLYGON|MULTIPOINT|MULTILINESTRING|MULTIPOLYGON|GEOMETRYCOLLECTION)\s*\(.*\)$")


def h3_resolution(cell) -> Column:
    """Bits 52 to 55 of a hexadecimal cell index; null if it is not hexadecimal."""
    cell = _c(cell)
    number = F.conv(cell, 16, 10).cast("decimal(20,0)")
    high = F.floor(number / F.lit(2**52).cast("decimal(20,0)")).cast("long")
    return F.when(cell.rlike("^[0-9a-fA-F]{1,16}$"), F.pmod(high, F.lit(16)).cast("int"))


def clamp01(x) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), _c(x)))


def json_at(payload, path: str) -> Column:
    """The string at a dotted or bracketed path of a JSON text; null where it is missing or the text is no JSON."""
    return F.call_function("try_variant_get", F.call_function("try_parse_json", _c(payload)), F.lit("$." + path), F.lit("string"))


def without_fences(text) -> Column:
    """The inside of the first fenced block, if there is one; else the stripped text."""
    inside = F.regexp_extract(_c(text), r"(?s)```(?:json)?(.*?)```", 1)
    return F.coalesce(falsy(F.regexp_replace(inside, r"^\s++|(?<!\s)\s++$", "")), stripped(text))


def quoted(text) -> Column:
    """A pattern that finds ``text`` as it is, case aside; places of hits are those of the text searched, whatever the length of its lower case."""
    return F.concat(F.lit(r"(?iu)\Q"), F.replace(_c(text), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def keyword_in_context(context, entity, window: int) -> list[Column]:
    """(left, hit, right) around the first hit, case aside; without one the context's tail, the entity and nothing. An empty entity is found at the start."""
    context, entity = _c(context), _c(entity)
    parts = F.split(context, quoted(entity), 2)
    at = F.when(entity == "", 1).when(F.size(parts) > 1, F.length(parts[0]) + 1).otherwise(0)
    size, n = F.length(context), F.length(entity)
    start = F.greatest(at - window, F.lit(1))
    left = F.when(at > 0, F.call_function("substring", context, start, at - start)).otherwise(F.call_function("substring", context, F.greatest(size - window + 1, F.lit(1)), F.lit(window)))
    hit = F.when(at > 0, F.call_function("substring", context, at, n)).otherwise(entity)
    right = F.when(at > 0, F.call_function("substring", context, at + n, F.lit(window))).otherwise("")
    return [left, hit, right]


def file_name(path) -> Column:
    """What follows the last slash."""
    return F.substring_index(_c(path), "/", -1)


def _before_extension(name: Column) -> Column:
    """What stands before the last dot; null if there is no dot, or only dots before it."""
    before = F.call_function("left", name, F.length(name) - F.length(F.substring_index(name, ".", -1)) - 1)
    return F.when(before.rlike("[^.]"), before)


def extension(path) -> Column:
    """Lower-cased extension with its dot; empty without one. A leading dot starts none."""
    name = file_name(path)
    return F.when(name.isNotNull(), F.coalesce(F.lower(F.substring(name, F.length(_before_extension(name)) + 1, F.length(name))), F.lit("")))


def stem(path) -> Column:
    """File name without folders and its last extension."""
    name = file_name(path)
    return F.coalesce(_before_extension(name), name)


def preview(text, n: int, more: str = "...") -> Column:
    return F.when(F.length(_c(text)) > n, F.concat(F.substring(_c(text), 1, n), F.lit(more))).otherwise(_c(text))


def config_key(chunk_size, overlap, model, dimensions, aliases: dict[str, str]) -> Column:
    """``cs{size}_co{overlap}_{model}`` with ``_d{dimensions}`` if there are any; a model without an alias keeps eight of its letters and digits."""
    plain = F.substring(F.regexp_replace(F.lower(_c(model)), "[^a-z0-9]", ""), 1, 8)
    slug = mapped(model, aliases, first_truthy(plain, F.lit("unk")))
    tail = F.when(_c(dimensions).isNotNull(), F.concat(F.lit("_d"), _c(dimensions).cast("string"))).otherwise("")
    return F.concat(F.lit("cs"), _c(chunk_size).cast("string"), F.lit("_co"), _c(overlap).cast("string"), F.lit("_"), slug, tail)


def config_hash(chunk_size, overlap, model, dimensions, prepend_title, strategy) -> Column:
    """The first 8 hexadecimal digits of the SHA-256 of all settings between colons, where a missing one is ``None`` and a switch ``True`` or ``False``."""
    switch = F.when(_c(prepend_title), "True").otherwise("False")
    parts = [_c(chunk_size), _c(overlap), _c(model), _c(dimensions), switch, _c(strategy)]
    return F.substring(F.sha2(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("None")) for p in parts)), 256), 1, 8)


def hive_segment(value) -> Column:
    """year=/month=/day= folders of a day or month; any other value as it is."""
    value = _c(value)
    y, m, d = (F.substring(value, a, n) for a, n in ((1, 4), (6, 2), (9, 2)))
    month = F.concat(F.lit("year="), y, F.lit("/month="), m)
    return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(month, F.lit("/day="), d)).when(value.rlike(r"^\d{4}-\d{2}$"), month).otherwise(value)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
