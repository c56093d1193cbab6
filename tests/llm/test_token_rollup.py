import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lorekeel.llm.token_rollup import Rollup, count_tokens
from lorekeel.session import shared_dir

SCHEMA = "op string, doc_id long, source string, lang string, version string, n_tokens long, seq int"


@pytest.fixture()
def rollup(spark, request):
    return Rollup(spark, f"{shared_dir(spark)}/{request.node.name}")


def changes(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def totals(rollup):
    return {(r["source"], r["lang"], r["version"]): (r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect()}


def test_batches_agree_with_plain_state(spark, rollup):
    rng = random.Random(9)
    state = {}
    for batch in range(1, 5):
        rows = []
        for seq in range(40):
            key = rng.choice([*range(12), None]), rng.choice(["v1", "v2", None])
            op = rng.choice(["insert", "revise", "delete"])
            source, lang, n = rng.choice(["s1", "s2", None]), rng.choice(["en", None]), rng.randrange(100)
            rows.append((op, key[0], source, lang, key[1], n, seq))
            state[key] = None if op == "delete" else (source, lang, n)
        assert rollup.commit(batch, changes(spark, rows))
        assert not rollup.commit(batch, changes(spark, rows))
        expected, docs = Counter(), Counter()
        for (_, version), v in state.items():
            if v is not None:
                expected[v[0], v[1], version] += v[2]
                docs[v[0], v[1], version] += 1
        assert totals(rollup) == {k: (docs[k], expected[k]) for k in docs}


def test_broken_off_batch_does_not_count_and_can_be_written_again(spark, rollup):
    row = ("insert", 1, "s", "en", "v", 5, 0)
    rollup.commit(1, changes(spark, [row]))
    changes(spark, [("insert", 2, "s", "en", "v", 7, 0)]).drop("op", "seq").write.parquet(rollup._path("changes", 2))
    spark.createDataFrame([("s", "en", "v", 1, 7)], "source string, lang string, version string, n_docs long, n_tokens long").write.parquet(rollup._path("deltas", 2))
    assert totals(rollup) == {("s", "en", "v"): (1, 5)}
    rollup.commit(2, changes(spark, [("insert", 2, "s", "en", "v", 8, 0)]))
    assert totals(rollup) == {("s", "en", "v"): (2, 13)}


def test_commits_are_found_without_a_list_of_them(spark, rollup):
    """Hundreds of commits, with gaps between their numbers: the last, members and strangers; looks grow with the logarithm; a folder without a file is no commit."""
    batches = [3 * k + 1 for k in range(300)]
    rows = [(k + 1, b, batches[max(0, k - 3) : k + 1]) for k, b in enumerate(batches)]
    spark.createDataFrame(rows, "place int, batch int, recent array<int>").repartition(4).write.partitionBy("place").parquet(f"{rollup.root}/commits")
    looks = []
    there = rollup._there
    rollup._there = lambda place: looks.append(place) or there(place)
    assert rollup._head() == (300, batches[-4:]) and len(looks) <= 20
    assert rollup._is_committed(1, 300) and rollup._is_committed(898, 300) and rollup._is_committed(451, 300) and not rollup._is_committed(450, 300) and not rollup._is_committed(0, 300)
    assert not rollup.commit(451, changes(spark, []))
    with pytest.raises(ValueError):
        rollup.commit(450, changes(spark, []))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{rollup.root}/commits/place=301/_temporary")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    assert rollup._head()[0] == 300 and rollup.committed() == batches


def test_edge_cases(spark, rollup):
    assert rollup.totals().count() == 0
    assert rollup.commit(3, changes(spark, [])) and totals(rollup) == {}
    assert rollup.commit(4, changes(spark, [("delete", 9, "s", "en", "v", None, 0), ("insert", 8, "s", "en", "v", None, 0)])) and totals(rollup) == {}
    with pytest.raises(ValueError):
        rollup.commit(2, changes(spark, []))
    assert rollup.commit(5, changes(spark, [("insert", 1, "s", "en", "v", 3, 0), ("insert", 1, "s", "en", "v", 4, 0)]))
    assert totals(rollup) == {("s", "en", "v"): (1, 4)}


def test_counts_and_query(spark, small, given, given_rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    n = {i: len(plain.encode(t or "", add_special_tokens=False).ids) for i, t, _ in given_rows}
    assert {r["doc_id"]: r["n_tokens"] for r in count_tokens(given, path, "v").collect()} == n
    from lorekeel.llm.queries import QUERIES, VERSION

    gone = {r["doc_id"] for r in spark.read.parquet(f"{small}/labels.parquet").where("toxic = 1 or quality = 0").collect()}
    tokens, docs = Counter(), Counter()
    for r in given.select("doc_id", "source", "lang").collect():
        if r["doc_id"] not in gone:
            tokens[r["source"], r["lang"], VERSION] += n[r["doc_id"]] + 1
            docs[r["source"], r["lang"], VERSION] += 1
    rows = QUERIES["op10_token_counts"](spark, small).collect()
    assert {(r["source"], r["lang"], r["version"]): (r["n_docs"], r["n_tokens"]) for r in rows} == {k: (docs[k], tokens[k]) for k in docs}


def test_many_batches_are_merged_and_look_ups_stay_few(spark, rollup):
    rng, state = random.Random(2), {}
    for batch in range(1, 18):
        rows = [(rng.choice(["insert", "delete"]), rng.randrange(30), rng.choice("ab"), "en", "v", rng.randrange(50), k) for k in range(3)]
        for op, key, source, _, _, n, _ in rows:
            state[key] = None if op == "delete" else (source, n)
        rollup.commit(batch, changes(spark, rows))
    runs = rollup._runs(rollup.committed())
    assert len(runs) == 2 and sum("/merged/" in r for r in runs) == 1
    expected, docs = Counter(), Counter()
    for v in state.values():
        if v is not None:
            expected[v[0], "en", "v"] += v[1]
            docs[v[0], "en", "v"] += 1
    assert totals(rollup) == {k: (docs[k], expected[k]) for k in docs}
    now = {r["doc_id"]: r["n_tokens"] for r in rollup.current(rollup.committed()).collect()}
    assert now == {k: v and v[1] for k, v in state.items()}
    taken = rollup.take()
    assert {r["source"] for r in taken.collect()} == {k[0] for k in docs}
    assert not any("changes" in str(p) for p in __import__("pathlib").Path(rollup.root.removeprefix("file:")).rglob("*.parquet"))
