"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

Every stage works on all that its predecessor kept. The first four return the
columns of ``documents`` as they came; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

import uuid
from decimal import Decimal

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from lorekeel.llm import language_id, private_data
from lorekeel.llm.batches import free_name
from lorekeel.llm.exact_dedup import exact_dedup, normalised
from lorekeel.llm.near_dedup import near_dedup
from lorekeel.llm.packing import pack, token_pieces
from lorekeel.session import cut, removed, shared_dir


#: Words in a shingle of the pipeline's near-duplicates, and the similarity in percent from which two documents are.
SHINGLE_WORDS, SIMILAR = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, whose language stays undetermined, go; a missing ``lang`` is filled with the one found.

    A null or empty text has no letter. A text of any length is judged whole. Repeated rows stay repeated, all columns stay as they are, whatever their names, and an empty table stays empty.
    """
    model = language_id.learn(docs.where(~language_id.held_out()).select("doc_id", "text", "lang"))
    name = free_name(docs.columns, "found")
    found = language_id.with_language(docs, model, into=name).where(F.col(name) != language_id.UNDETERMINED)
    return found.withColumn("lang", F.coalesce("lang", name)).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal texts, the one document that stays; also of rows that have one id and one text.

    Null and empty texts are one group, texts of any length are compared whole; of equal lengths the smallest doc_id stays. Rows with a null id, or with one id and different texts, are told apart by their texts. All
    columns stay as they are, whatever their names, and an empty table stays empty.
    """
    kept = cut(exact_dedup(docs).where("kept").select("doc_id", "text_sha256"))
    ids = kept.select("doc_id").distinct()
    stay = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    # an id whose rows are not all told by it: only there the texts decide
    rows = cut(docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").select("doc_id"))
    if rows.isEmpty():
        return stay.select(*docs.columns)
    sha, place = free_name(docs.columns, "sha"), free_name(docs.columns, "place")
    clear = stay.join(rows, stay["doc_id"].eqNullSafe(rows["doc_id"]), "left_anti")
    some = stay.join(rows, stay["doc_id"].eqNullSafe(rows["doc_id"]), "left_semi").withColumn(sha, F.sha2(normalised(F.col("text")).cast("binary"), 256))
    some = some.join(kept, some["doc_id"].eqNullSafe(kept["doc_id"]) & (some[sha] == kept["text_sha256"]), "left_semi")
    first = Window.partitionBy("doc_id", sha).orderBy(F.desc(F.length("text")))
    once = some.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1)
    return clear.select(*docs.columns).unionByName(once.select(*docs.columns))


def _row_key(docs: DataFrame) -> Column:
    """A number for each id and text: rows differ in it if they differ in one of them, and it is in the order of whole-number ids; null ids come first, told apart by two hashes of the text."""
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        ids = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.lit(1), "doc_id"))
    else:
        ids = F.col("doc_id")
    wide = lambda x: x.cast("decimal(19,0)")
    part = lambda seed: F.pmod(F.xxhash64(F.lit(seed), F.col("text")), F.lit(10**18))
    nameless = F.lit(Decimal(-93 * 10**36)) - (wide(part(1)) * F.lit(Decimal(10**18)) + wide(part(2)))
    return F.coalesce(wide(ids) * F.lit(Decimal(10**19)) + wide(part(1)), nameless).cast("decimal(38,0)")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, one row: that with the least id.

    Rows are told apart by id and text, so rows with a null id or one id are judged by themselves, and of rows with one id and one text one stays. Documents without
    words stay, and texts of any length are compared whole. All columns stay as they are, whatever their names, and an empty table stays empty.
    """
    key = free_name(docs.columns, "key")
    rows = docs.withColumn(key, _row_key(docs))
    kept = near_dedup(rows, id_col=key, width=SHINGLE_WORDS, percent=SIMILAR).where("kept").select(F.col("doc_id").alias(key)).distinct()
    stay = rows.join(kept, key, "left_semi")
    twice = cut(rows.groupBy(key).count().where("count > 1").select(key))
    if not twice.isEmpty():
        stay = stay.join(twice, key, "left_anti").unionByName(stay.join(twice, key, "left_semi").dropDuplicates([key]))
    return stay.select(*docs.columns)


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by its kind; n_chars, if there, follows.

    A null text stays null, and its n_chars becomes null; texts of any length are read whole. All rows, also repeated ones, and all other columns stay, and an empty table stays empty.
    """
    redacted = private_data.redact(docs, private_data.learn(docs))
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else redacted


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences: doc_id, start, length, ids_crc32, doc_tokens, tokens (little-endian unsigned 32-bit ids), sequence_id, offset.

    A null or empty text is one piece with the end id. Repeated rows have pieces of their own; columns besides doc_id and text are not read, and an empty table gives no rows.
    """
    pieces = token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "tokens"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("private_data", redact_private),
    ("packing", pack_windows),
]
#: Language models, components and sequence numbers are beyond SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what lies between two stages is written to the folder that the cluster shares, and goes when the result is there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    between = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{between}/{k}-{name}")
            docs = spark.read.parquet(f"{between}/{k}-{name}")
    docs = cut(docs)
    removed(spark, between)
    return docs
