"""Joins of strings by shared words or containment, without comparing all pairs.

Both joins turn the condition into an equi-join that loses no match, then verify. Rows
are joined on a key that few others have: several of the rarest words of a name, or the rarest
piece of the shorter string.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekeel.session import cut, dealt

#: Code points of the pieces that containment is looked up by, the largest that a string reaches.
GRAMS = [1, 2, 3, 8]


def ranked_words(names: DataFrame, word_list: str = "words", key: str = "key") -> tuple[DataFrame, DataFrame]:
    """Numbered names (id, key) and their words as numbers (group, id, w, n), from rare to frequent within the group; names without words are only in the first.

    A word's number is its place among all words of its group by how often it is used, so words are compared and sorted as numbers, and no string meets another.
    """
    numbered = cut(names.select("group", F.col(key).alias("key"), F.col(word_list).alias("words")).withColumn("id", F.monotonically_increasing_id()))
    each = numbered.select("group", "id", F.explode("words").alias("word"))
    # written first: a join beside an aggregate on the same key could not be split where a word is hot
    often = each.groupBy("group", "word").agg(F.count(F.lit(1)).alias("often"))
    places = cut(often.repartitionByRange("often", "group", "word").sortWithinPartitions("often", "group", "word").select("group", "word", F.monotonically_increasing_id().alias("place")))
    order = each.join(dealt(places), ["group", "word"]).groupBy("group", "id").agg(F.sort_array(F.collect_list("place")).alias("w"))
    return numbered.select("id", "key"), order.select("group", "id", "w", F.size("w").alias("n"))


def _met(a: DataFrame, b: DataFrame, met: Column, k: Column) -> DataFrame:
    """(group, id_a, id_b, shared, n_a, n_b) of rows of heads that meet under a key, at the first ``k`` words that they share only, so once a pair."""
    found = a.join(dealt(b), met).withColumn("both", F.array_intersect("w_a", "w_b"))
    found = found.where((F.slice("both", 1, k) == F.col("x_a")) & (F.col("x_a") == F.col("x_b")))
    return found.select(F.col("group_a").alias("group"), "id_a", "id_b", F.size("both").alias("shared"), "n_a", "n_b")


def _side(head: DataFrame, side: str) -> DataFrame:
    return head.select(*(F.col(c).alias(f"{c}_{side}") for c in head.columns))


def _sharing(ranked: DataFrame, prefix: Column, together: int, further: Column | None = None) -> DataFrame:
    """Pairs of ``ranked`` names that share the ``together`` (1 or 2) rarest of their common words within their first ``prefix`` words.

    ``further`` may hold n_a, n_b and the places of the last word of a key, place_a and place_b. Names of different sides meet only, where sides are given.
    """
    rows = ranked.withColumn("p", F.least(prefix, F.col("n")).cast("int")).where(F.col("p") >= together)
    if together == 1:
        places = F.expr("transform(sequence(1, p), i -> struct(array(w[i - 1]) as x, i as place))")
    else:
        places = F.expr("flatten(transform(sequence(1, p - 1), i -> transform(sequence(i + 1, p), j -> struct(array(w[i - 1], w[j - 1]) as x, j as place))))")
    # a number of a word is of one group, so that words alone tell groups apart
    head = rows.select(*ranked.columns, F.explode(places).alias("e")).select(*ranked.columns, "e.*").withColumn("key", F.xxhash64("x"))
    met = (F.col("key_a") == F.col("key_b")) & (F.col("id_a") < F.col("id_b")) & _apart(ranked)
    return _met(_side(head, "a"), _side(head, "b"), met if further is None else met & further, F.lit(together))


def _apart(ranked: DataFrame) -> Column:
    return F.col("side_a") != F.col("side_b") if "side" in ranked.columns else F.lit(True)


#: Names up to so many words meet by size; most keys that a name then has for each size of a partner.
BY_SIZE, KEYS = 16, 16


def _least_shared(n: int, m: int, over: float, least: int) -> int:
    """Words that names of ``n`` and ``m`` words must share to be similar enough; more than either has if they never are."""
    return next((o for o in range(least, min(n, m) + 1) if o / (n + m - o) > over), min(n, m) + 1)


def _plan(sizes: list[int], over: float, least: int) -> list[tuple[int, int, int, list[int]]]:
    """(n, lo, hi, places): the places of the words that a name of ``n`` words is looked up by, among names of ``lo`` and ``hi`` words.

    Of two such names that share ``o`` words, each has the first k of them among its first n - o + k, whatever k. The more words together, the
    rarer; k is the largest that leaves a name ``KEYS`` keys. With k = o, as in short names, every pair that meets is one.
    """
    plan = []
    for lo, hi in itertools.combinations_with_replacement(sizes, 2):
        o = _least_shared(lo, hi, over, least)
        if o <= lo:
            k = max((k for k in range(1, o + 1) if math.comb(hi - o + k, k) <= KEYS), default=min(least, 2))
            plan += [(n, lo, hi, list(places)) for n in {lo, hi} for places in itertools.combinations(range(n - o + k), k)]
    return plan


def _sharing_by_size(ranked: DataFrame, sizes: list[int], over: float, least: int) -> DataFrame:
    """Pairs of ``ranked`` names of these ``sizes`` (few and small) that share enough words, perhaps with others."""
    # the plan holds at most BY_SIZE * BY_SIZE * KEYS rows
    plan = ranked.sparkSession.createDataFrame(_plan(sizes, over, least), "n int, lo int, hi int, places array<int>")
    rows = ranked.join(F.broadcast(plan), "n").withColumn("x", F.transform("places", lambda i: F.get("w", i))).drop("places")
    head = rows.withColumn("key", F.xxhash64("lo", "hi", "x"))
    a, b = _side(head.where("n = lo"), "a"), _side(head.where("n = hi"), "b")
    met = (F.col("key_a") == F.col("key_b")) & (F.col("lo_a") == F.col("lo_b")) & (F.col("hi_a") == F.col("hi_b")) & ((F.col("lo_a") < F.col("hi_a")) | (F.col("id_a") < F.col("id_b")))
    return _met(a, b, met & _apart(ranked), F.size("x_a"))


def _named(pairs: DataFrame, numbered: DataFrame, *more: str) -> DataFrame:
    """(group, a, b, more): numbers as the names that they stand for, the lesser first."""
    of = lambda side: numbered.select(F.col("id").alias(f"id_{side}"), F.col("key").alias(f"key_{side}"))
    both = pairs.join(dealt(of("a")), "id_a").join(dealt(of("b")), "id_b")
    return both.select("group", F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"), *more)


def sharing_pairs(names: DataFrame, least: int = 2, key: str = "key") -> DataFrame:
    """(group, a, b), a before b, of names (group, key, words) with ``least`` words or more in common.

    Of two names that share so many, each has one of the shared words among all but its ``least`` - 1 most frequent ones.
    """
    numbered, ranked = ranked_words(names, key=key)
    return _named(_sharing(cut(ranked), F.col("n") - (least - 1), 1).where(F.col("shared") >= least), numbered)


def similar_pairs(names: DataFrame, over: float, least: int = 1, key: str = "key", apart: str | None = None) -> DataFrame:
    """(group, a, b, similarity), a before b, of names whose word sets have a Jaccard similarity above ``over`` and share ``least`` words or more.

    Names of up to ``BY_SIZE`` words meet by their two sizes and several shared words at once (``_plan``). A longer name of n words shares more than ``over`` * n with a
    partner, so the first common word is among its first words by rarity, and so are the first two if two must be shared. ``apart`` names a field of the
    key in which the names of a pair must differ.
    """
    numbered, ranked = ranked_words(names, key=key)
    if apart is not None:
        ranked = ranked.join(dealt(numbered.select("id", F.col("key")[apart].alias("side"))), "id")
    ranked = cut(ranked)
    found = sorted(r["n"] for r in ranked.select(F.least("n", F.lit(BY_SIZE + 1)).alias("n")).distinct().collect())
    pairs = _sharing_by_size(ranked, [n for n in found if n <= BY_SIZE], over, least)
    if found and found[-1] > BY_SIZE:
        together = min(least, 2)
        shared = F.greatest(F.floor(F.col("n") * over + 1e-9) + 1, F.lit(least))
        # no other word up to the last of the first common ones is shared, which bounds how many can be
        reach = together + F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
        enough = (reach * (1 + over) >= over * (F.col("n_a") + F.col("n_b")) - 1e-9) & (F.greatest("n_a", "n_b") > BY_SIZE)
        large = ranked.where(F.col("n") > BY_SIZE * over)
        pairs = pairs.unionByName(_sharing(large, F.col("n") - shared + together, together, enough))
    scored = pairs.where(F.col("shared") >= least).withColumn("similarity", F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared")))
    return _named(scored.where(F.col("similarity") > over), numbered, "similarity")


def _grams(text: Column, size: int) -> Column:
    """Hashes of the distinct pieces of ``size`` code points; the strings themselves are compared later."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - (size - 1)), lambda i: F.xxhash64(F.call_function("substring", text, i, F.lit(size)))))


def containing_pairs(short: DataFrame, long: DataFrame) -> DataFrame:
    """Distinct (group, inner, outer) with ``inner`` of ``short`` inside ``outer`` of ``long``; both (group, text), empty texts match nothing.

    If a string lies in another, so do all its pieces; it is looked up by that one which the fewest strings of ``long`` have, among pieces of the largest size of ``GRAMS``
    that it reaches. Long pieces are much rarer than trigrams, and sizes that no string of ``short`` asks for are not made.
    """
    numbered = lambda df, name: cut(df.select("group", F.col("text").alias(name)).where(f"{name} <> ''").distinct().withColumn(f"{name}_id", F.monotonically_increasing_id()))
    inner, outer = numbered(short, "inner"), numbered(long, "outer")
    inner = inner.withColumn("size", F.array_max(F.filter(F.array(*map(F.lit, GRAMS)), lambda g: g <= F.length("inner"))))
    own = pieces = None
    for size in sorted(r["size"] for r in inner.select("size").distinct().collect()):  # one row for each of GRAMS at most
        of = inner.where(F.col("size") == size).select("group", "inner_id", "size", F.explode(_grams(F.col("inner"), size)).alias("gram"))
        part = outer.where(F.length("outer") >= size).select("group", "outer_id", F.lit(size).alias("size"), F.explode(_grams(F.col("outer"), size)).alias("gram"))
        own, pieces = (of, part) if own is None else (own.unionByName(of), pieces.unionByName(part))
    if own is None:
        return inner.join(outer.select("outer_id", "outer"), F.lit(False)).select("group", "inner", "outer")
    at = ["group", "size", "gram"]
    often = cut(pieces.groupBy(*at).agg(F.count(F.lit(1)).alias("often")))
    # a piece that no string of ``long`` has rules the string out, so it comes first
    asked = own.join(dealt(often), at, "left").groupBy("group", "size", "inner_id").agg(F.min_by("gram", F.struct(F.coalesce("often", F.lit(0)).alias("n"), F.col("gram").alias("g"))).alias("gram"))
    # only numbers met so far; the strings of those that did are looked at once, and a pair meets at one piece only
    met = asked.join(dealt(pieces), at).select("group", "inner_id", "outer_id")
    both = met.join(dealt(inner.select("inner_id", "inner")), "inner_id").join(dealt(outer.select("outer_id", "outer")), "outer_id")
    return both.where(F.contains("outer", "inner")).select("group", "inner", "outer")
