"""Spans over texts: greedy sweeps without overlap, entity mentions found by an automaton of names, and what a span may be."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.functions.scalars import falsy, quoted
from lorekeel.session import cut

#: Code points of a family's texts that one task walks.
PART_CHARS = 64_000_000


def valid_span(start, end, text) -> Column:
    """0 <= start < end <= length of the text."""
    return span_within(start, end, F.length(text))


def span_within(start, end, length) -> Column:
    """0 <= start < end <= a length, where a text's length goes on without the text."""
    s, e, n = (F.col(x) if isinstance(x, str) else x for x in (start, end, length))
    return (s >= 0) & (s < e) & (e <= n)


def greedy(spans: Column) -> Column:
    """Of an array of structs that starts with ``start`` and ``end``, sorted, those that begin no earlier than the last kept one ends."""
    empty = F.slice(spans, 1, 0)

    def step(kept: Column, s: Column) -> Column:
        last = F.when(F.size(kept) == 0, F.lit(-1).cast("long")).otherwise(F.try_element_at(kept, F.lit(-1))["end"].cast("long"))
        return F.when(s["start"] >= last, F.concat(kept, F.array(s))).otherwise(kept)

    return F.aggregate(spans, empty, step)


def non_overlapping(rows: DataFrame, key: str, start: str = "start", end: str = "end", longest_first: bool = False) -> DataFrame:
    """(key, start, end) kept by a sweep over the spans of each key; of spans with one start the longest or the first comes first.

    The spans of a key are those of one text.
    """
    s, e = F.col(start).cast("long").alias("start"), F.col(end).cast("long").alias("end")
    order = F.struct(s, (-F.col(end) if longest_first else F.col(end)).cast("long").alias("o"), e)
    listed = rows.groupBy(key).agg(F.array_sort(F.collect_list(order)).alias("spans"))
    plain = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return listed.select(key, F.explode(greedy(plain)).alias("s")).select(key, "s.start", "s.end")


def occurrences(texts: DataFrame, entities: DataFrame, key: str = "id") -> DataFrame:
    """(key, entity, start, end) of every hit of an entity of the same key in its text, case aside; ``texts`` (key, text), ``entities`` (key, entity).

    Hits of one entity do not overlap each other. Places are code points of the text itself.
    """
    rows = texts.select(key, "text").join(entities.select(key, "entity").where(falsy("entity").isNotNull()).distinct(), key)
    parts = rows.select(key, "entity", F.transform(F.split("text", quoted("entity"), -1), F.length).alias("parts")).where(F.size("parts") > 1)
    each = parts.select(key, "entity", F.size("parts").alias("n"), F.posexplode("parts").alias("pos", "size"))
    before = Window.partitionBy(key, "entity").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = (F.sum("size").over(before) + F.col("pos") * F.length("entity")).cast("int")
    hits = each.withColumn("start", start).where("pos < n - 1")
    return hits.select(key, "entity", "start", (F.col("start") + F.length("entity")).alias("end"))


class _Folds(dict):
    """Code point to the one that stands for it where case does not count; one for one, so that places stay."""

    def __missing__(self, point: int) -> int:
        c = chr(point)
        up = c.upper()
        up = up if len(up) == 1 else c
        low = up.lower()
        self[point] = ord(low if len(low) == 1 else up)
        return self[point]


_FOLDS = _Folds()


def folded_case(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_FOLDS)


class NameAutomaton:
    """All names of a family as one automaton; a text is walked once, however many they are."""

    def __init__(self, names: Iterable[str]) -> None:
        self.found = ahocorasick.Automaton()
        by_fold: dict[str, str] = {}
        for name in names:
            key = folded_case(name)
            by_fold[key] = min(name, by_fold.get(key, name))
        for key, name in by_fold.items():
            self.found.add_word(key, (len(key), name))
        if by_fold:
            self.found.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, name) by end; hits of one name do not overlap each other."""
        out, last = [], {}
        if len(self.found):
            for end, (size, name) in self.found.iter(folded_case(text)):
                if end + 1 - size >= last.get(name, 0):
                    last[name] = end + 1
                    out.append((end + 1 - size, end + 1, name))
        return out

    def annotations(self, text: str) -> list[tuple[int, int, str]]:
        """Hits that a sweep keeps: in the order of their starts, the longest first, each that begins no earlier than the last kept one ends."""
        kept, last = [], 0
        for start, end, name in sorted(self.hits(text), key=lambda h: (h[0], -h[1])):
            if start >= last:
                kept.append((start, end, name))
                last = end
        return kept


def _annotating(all_hits: bool):
    """Rows of one family after another, its names before its texts; nothing is kept but one automaton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, names, automaton = None, [], None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("family", "part", "name", "text")]
            of, hits = [], []
            for k, (mine, part, name, text) in enumerate(zip(*columns)):
                if (mine, part) != family:
                    family, names, automaton = (mine, part), [], None
                if name is not None:
                    names.append(name)
                    continue
                automaton = automaton or NameAutomaton(names)
                found = automaton.hits(text) if all_hits else automaton.annotations(text)
                of += [k] * len(found)
                hits += found
            starts, ends, entities = (list(x) for x in zip(*hits)) if hits else ([], [], [])
            rows = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(rows), pa.array(entities, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["id", "entity", "start", "end"])

    return run


def annotated(texts: DataFrame, entities: DataFrame, key: str = "id", family: str | None = None, all_hits: bool = False, part_chars: int = PART_CHARS) -> DataFrame:
    """(key, entity, start, end) of the hits that a sweep keeps of the names of a text's family, the longest of those with one start; with ``all_hits`` of every hit.

    ``texts`` (key, text, and family), ``entities`` (family, entity); without a family each text has names of its own, by its key. Case is left aside, places are code points of the text
    itself, and of names that differ in case the first is given. The names of a family are one automaton, which walks each text once, so the work is
    that of reading texts and writing hits, however many names there are. A family of more than ``part_chars`` code points is dealt over several tasks, its names to each.
    Null texts, null and empty names and null families match nothing; repeated rows are annotated each.
    """
    family = family or key
    rows = texts.where(F.col("text").isNotNull() & F.col(family).isNotNull()).select(F.col(family).alias("family"), F.col(key).alias("id"), "text")
    names = entities.where(falsy("entity").isNotNull()).select(F.col(family).alias("family"), F.col("entity").alias("name")).distinct()
    # only families that one task should not walk alone; written first, so that the joins can be split
    large = cut(rows.groupBy("family").agg(F.ceil(F.sum(F.length("text")) / part_chars).cast("int").alias("parts")).where("parts > 1"))
    dealt = rows.join(large, "family", "left").withColumn("part", F.pmod(F.xxhash64("id", "text"), F.coalesce("parts", F.lit(1))).cast("int"))
    spread = names.join(large, "family", "left").select("family", "name", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    kind = rows.schema["id"].dataType
    both = dealt.select("family", "part", F.lit(None).cast("string").alias("name"), "id", "text").unionByName(spread.select("family", "part", "name", F.lit(None).cast(kind).alias("id"), F.lit(None).cast("string").alias("text")))
    ordered = both.repartition("family", "part").sortWithinPartitions("family", "part", F.col("name").isNull())
    return ordered.mapInArrow(_annotating(all_hits), f"id {kind.simpleString()}, entity string, start int, end int").withColumnRenamed("id", key)
