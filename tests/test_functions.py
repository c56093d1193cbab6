import hashlib

from pyspark.sql import functions as F

from lorekeel.functions import scalars as S


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if not isinstance(v, (list, float)) else 'array<string>' if isinstance(v, list) and v and isinstance(v[0], str) else 'array<double>' if isinstance(v, list) else 'double'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


def test_ids_and_hashes(spark):
    expected = hashlib.sha256(b"a||b").hexdigest()
    assert one(spark, S.deterministic_id("a", "n", "b"), a="a", n=None, b="b") == expected[:16]
    assert one(spark, S.content_hash("a", "n", "b"), a="a", n=None, b="b") == expected
    assert [one(spark, S.text_hash("a"), a=v) for v in ("", None)] == ["", ""]


def test_names_and_words(spark):
    assert one(spark, S.normalised("a"), a="  ACME Corp \n") == "acme corp"
    assert [one(spark, S.tokens("a"), a=v) for v in ("  ", "b A b\tc")] == [[], ["b", "a", "c"]]
    assert one(spark, S.jaccard("a", "b"), a=["x", "y"], b=["y", "z"]) == 1 / 3
    assert one(spark, S.jaccard(S.tokens("a"), S.tokens("b")), a="", b="x") == 0


def test_cosine(spark):
    assert abs(one(spark, S.cosine("a", "b"), a=[1.0, 0.0], b=[1.0, 1.0]) - 0.5**0.5) < 1e-12
    assert one(spark, S.cosine("a", "b"), a=[0.0, 0.0], b=[1.0, 1.0]) == 0 and one(spark, S.cosine("a", "b"), a=[1.0], b=[1.0, 1.0]) == 0


def test_types_predicates_and_dates(spark):
    assert [one(spark, S.mention_type("a"), a=v) for v in (" org", "thing")] == ["ORG", "OTHER"]
    assert [one(spark, S.alias_type("a"), a=v) for v in ("company", "City", "xyz")] == ["ORG", "GPE", "XYZ"]
    assert one(spark, S.canonical_predicate("a", S.LEAK_PREDICATES), a=" Is Owned By ") == "owned_by"
    assert one(spark, S.canonical_predicate("a", S.LEGISLATIVE_PREDICATES), a="Ran Past") == "ran past"
    assert str(one(spark, S.iso_date("a"), a="2024-02-03T10:00")) == "2024-02-03" and one(spark, S.iso_date("a"), a="soon") is None
    assert [str(one(spark, S.year_date("a", e), a="1999")) for e in (False, True)] == ["1999-01-01", "1999-12-31"]


def test_cable_fields(spark):
    body = "REF 1\nsubj: On things \nTAGS: PREL, ,PGOV\nTAGS: NO"
    assert one(spark, S.subject_line("a"), a=body) == "On things" and one(spark, S.subject_line("a"), a="none") == ""
    assert one(spark, S.tag_list("a"), a=body) == ["PREL", "PGOV"] and one(spark, S.tag_list("a"), a="none") == []


def test_shapes(spark):
    assert [one(spark, S.is_snake_case("a"), a=v) for v in ("ab_c1", "Ab", "a__b")] == [True, False, False]
    assert [one(spark, S.is_wkt("a"), a=v) for v in ("point (1 2)", "CIRCLE(1)", "POINT")] == [True, False, False]
    assert [one(spark, S.h3_resolution("a"), a=v) for v in ("872830828ffffff", "f0000000000000", "not_a_hex_value", None)] == [7, 15, None, None]
    assert one(spark, S.json_at("a", "b[0].c"), a='{"b":[{"c":"x"}]}') == "x" and one(spark, S.json_at("a", "q"), a="{") is None
    assert [one(spark, S.without_fences("a"), a=v) for v in ("x ```json\n{}\n``` y", " {} ")] == ["{}", "{}"]


def test_keyword_in_context(spark):
    df = spark.createDataFrame([("The big Dog ran off", "dog"), ("nothing", "dog")], "c string, e string")
    rows = [tuple(r) for r in df.select(*(c.alias(n) for c, n in zip(S.keyword_in_context("c", "e", 4), "lhr"))).collect()]
    assert rows == [("big ", "Dog", " ran"), ("hing", "dog", "")]


def test_files_and_keys(spark):
    assert [one(spark, S.extension("a"), a=v) for v in ("/x/A.MP4", "/x.y/b", "/x/.hidden", "/x/a.b.mkv")] == [".mp4", "", "", ".mkv"]
    assert [one(spark, S.stem("a"), a=v) for v in ("/x/A.b.mp4", "/x.y/b")] == ["A.b", "b"]
    assert one(spark, S.config_key(F.lit(400), F.lit(100), "a", F.lit(64), {"big": "b1"}), a="My-Model_2024") == "cs400_co100_mymodel2_d64"
    assert [one(spark, S.hive_segment("a"), a=v) for v in ("2024-03-05", "2024-03", "x")] == ["year=2024/month=03/day=05", "year=2024/month=03", "x"]
    assert one(spark, S.first_truthy("a", "b"), a="", b="y") == "y" and one(spark, S.preview("a", 3), a="abcdef") == "abc..."


def test_places_of_hits_where_lower_case_is_longer(spark):
    from lorekeel.functions.scalars import keyword_in_context
    from lorekeel.operators.spans import annotated, occurrences

    rows = spark.createDataFrame([("İİ acme end", "ACME"), ("none here", "acme"), (r"a \E+ b", r"\e+"), ("x", "")], "c string, e string")
    parts = keyword_in_context("c", "e", 3)
    got = [tuple(r) for r in rows.select(*(p.alias(str(k)) for k, p in enumerate(parts))).collect()]
    assert got == [("İİ ", "acme", " en"), ("ere", "acme", ""), ("a ", r"\E+", " b"), ("", "", "x")]
    texts = spark.createDataFrame([(1, "İİ acme end, Acme! acme corp")], "id int, text string")
    names = spark.createDataFrame([(1, "acme"), (1, "ACME corp"), (1, ""), (1, None)], "id int, entity string")
    assert sorted(tuple(r)[1:] for r in occurrences(texts, names).collect()) == [("ACME corp", 19, 28), ("acme", 3, 7), ("acme", 13, 17), ("acme", 19, 23)]
    assert sorted(tuple(r)[1:] for r in annotated(texts, names).select("id", "entity", "start", "end").collect()) == [("ACME corp", 19, 28), ("acme", 3, 7), ("acme", 13, 17)]


def test_long_values_take_linear_time_and_no_recursion(spark):
    million = spark.range(1).select(F.repeat(F.lit(" "), 1_000_000).alias("blanks"), F.repeat(F.lit("_a1"), 100_000).alias("parts"), F.repeat(F.lit("a/"), 300_000).alias("path"))
    row = million.select(
        F.length(S.stripped(F.concat(F.lit("  a"), "blanks", F.lit("b \n")))).alias("kept"), F.length(S.stripped("blanks")).alias("none"),
        S.is_snake_case(F.concat(F.lit("a"), "parts")).alias("snake"), S.is_snake_case(F.concat(F.lit("a"), "parts", F.lit("_"))).alias("odd"),
        F.length(S.without_fences(F.concat(F.lit("```json\n"), "blanks", F.lit("x"), "blanks", F.lit("y"), "blanks", F.lit("```")))).alias("fenced"),
        F.length(S.without_fences(F.concat(F.lit("``` "), "blanks", F.lit("x")))).alias("open"),
        S.extension(F.concat("path", F.repeat(F.lit("b"), 200_000))).alias("no_extension"), S.extension(F.concat("path", F.repeat(F.lit("b."), 200_000), F.lit("TXT"))).alias("extension"),
        F.length(S.stem(F.concat("path", F.repeat(F.lit("b."), 200_000), F.lit("TXT")))).alias("stem"),
    ).first()
    assert row.asDict() == {"kept": 1_000_002, "none": 0, "snake": True, "odd": False, "fenced": 1_000_002, "open": 1_000_005, "no_extension": "", "extension": ".txt", "stem": 399_999}


def test_stripping_by_script_and_names_of_files(spark):
    assert [one(spark, S.stripped("a"), a=v) for v in ("\u2003a \u00a0b\u2003\n", "", " \t", None, "a")] == ["a \u00a0b", "", "", None, "a"]
    names = {"/x/a.TXT": (".txt", "a"), "a": ("", "a"), ".hidden": ("", ".hidden"), "..b": ("", "..b"), "a..b": (".b", "a."), "x.y/": ("", ""), "d.e/f": ("", "f"), "a.": (".", "a"), ".a.b": (".b", ".a"), None: (None, None)}
    for name, expected in names.items():
        assert (one(spark, S.extension("a"), a=name), one(spark, S.stem("a"), a=name)) == expected, name


def test_scratch_folders_go(spark):
    from lorekeel.session import scratch
    from lorekeel.sources.catalog import exists

    with scratch(spark, "some") as path:
        spark.range(3).write.parquet(path)
        assert exists(spark, path)
    assert not exists(spark, path)
