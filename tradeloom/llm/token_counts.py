"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A change is a row with signs: an inserted document adds 1 document and its
tokens, a deleted one takes them away, a revised count adds the difference.  A
batch of changes is folded to one row per key and added to the stored totals;
its number makes it count once however often it is committed.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.words import slices
from tradeloom.plans.snapshots import SnapshotTable

KEYS = ["source", "lang", "tokenizer"]
MEASURES = ["documents", "tokens"]
SCHEMA = "source string, lang string, tokenizer string, documents bigint, tokens bigint"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
BUCKETS = 16
# White space by Unicode, as the cutting pattern takes it, in runs that are cut out before.
_LONG_BLANK = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


def load_tokenizer(vocabulary: str = VOCABULARY) -> tiktoken.Encoding:
    """Byte-level BPE from a file of ranks: a token in base64 and its rank per line."""
    ranks = {}
    for line in Path(vocabulary).read_bytes().splitlines():
        if line:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    # Fixed value: how the vocabulary's texts were cut before merging.
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(tokenizer: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text whose runs of white space may be of any length.

    The cutting pattern fails on runs near a million.  Before a word it takes
    all but the last blank of a run as one piece, at the end the whole run; so
    long runs are cut out here and given to the tokenizer as pieces.
    """
    out, done = [], 0
    for run in _LONG_BLANK.finditer(text):
        stop = run.end() - (run.end() < len(text))
        out += tokenizer.encode_ordinary(text[done : run.start()]) + tokenizer._encode_single_piece(text[run.start() : stop])
        done = stop
    return out + tokenizer.encode_ordinary(text[done:])


def with_tokens(docs: DataFrame, name: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, source, lang, tokenizer, copy, n_bytes, tokens)`` per row; null texts have no tokens.

    Repeated rows and rows without an id each count.  The vocabulary is read where the tasks run: a file that every machine has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = None
        for part in slices(batches):
            tokenizer = tokenizer or load_tokenizer(vocabulary)
            n = np.fromiter((len(encode(tokenizer, t)) for t in part.column("text").to_pylist()), dtype=np.int64, count=part.num_rows)
            kept = [part.column(c) for c in ("doc_id", "source", "lang", "tokenizer", "copy", "n_bytes")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n)], names=["doc_id", "source", "lang", "tokenizer", "copy", "n_bytes", "tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.lit(name).alias("tokenizer"),
        F.xxhash64(text).alias("copy"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        text.alias("text"),
    )
    return rows.mapInArrow(
        run, "doc_id bigint, source string, lang string, tokenizer string, copy bigint, n_bytes bigint, tokens bigint"
    )


def inserted(rows: DataFrame, tokens: Column | str = "tokens") -> DataFrame:
    return rows.select(*KEYS, F.lit(1).cast("bigint").alias("documents"), (F.col(tokens) if isinstance(tokens, str) else tokens).cast("bigint").alias("tokens"))


def deleted(rows: DataFrame, tokens: Column | str = "tokens") -> DataFrame:
    plus = inserted(rows, tokens)
    return plus.select(*KEYS, *[(-F.col(m)).alias(m) for m in MEASURES])


def repeated(rows: DataFrame) -> DataFrame:
    """Changes that delete all but one row of equal ``copy``: the first by doc_id, source and language, nulls last.

    Rows are folded to one a text, source and language before they meet, so a
    text that a third of all rows have is a few rows.
    """
    last = lambda c: [F.col(c).isNull().alias(f"no_{c}"), F.col(c)]
    folded = rows.groupBy("copy", *KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.min("tokens").alias("tokens"), F.min(F.struct(*last("doc_id"), *last("source"), *last("lang"))).alias("first")
    )
    kept = folded.groupBy("copy").agg(F.min("first").alias("kept"))
    extra = folded.join(kept, "copy").withColumn("n", F.col("n") - F.when(F.col("first") == F.col("kept"), 1).otherwise(0))
    return extra.where("n > 0").select(*KEYS, (-F.col("n")).alias("documents"), (-F.col("n") * F.col("tokens")).alias("tokens"))


def revised(rows: DataFrame, before: Column | str, after: Column | str) -> DataFrame:
    """A new count for documents that are there already."""
    plus, minus = (F.col(c) if isinstance(c, str) else c for c in (after, before))
    return rows.select(*KEYS, F.lit(0).cast("bigint").alias("documents"), (plus - minus).cast("bigint").alias("tokens"))


class TokenTotals:
    """Stored totals; ``path`` is a folder all executors share.

    Rows lie in buckets of their key, so a batch rewrites only the buckets of
    the keys it changes.  Null sources and languages are keys of their own.
    """

    def __init__(self, spark: SparkSession, path: str):
        bucket = F.pmod(F.xxhash64(*KEYS), F.lit(BUCKETS))
        self.table = SnapshotTable(spark, path, SCHEMA, KEYS, bucket)

    def commit(self, batch_id: int, changes: DataFrame) -> bool:
        """Add a batch; False if it (or a later one) is in already.

        Batches are numbered upwards.  A batch is folded before it is shuffled,
        so a source with a third of all rows is one row per task.
        """
        folded = changes.groupBy(*KEYS).agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES])
        return self.table.add(folded, MEASURES, batch_id)

    def read(self) -> DataFrame:
        """``(source, lang, tokenizer, documents, tokens)``; keys whose documents are all deleted are left out."""
        return self.table.read().where("documents <> 0 or tokens <> 0")
