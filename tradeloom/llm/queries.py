"""The registered queries of this subpackage, with check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import alignment, decontamination, infill, language, minhash, mixing, near_links, quality, repeated_lines, repeats, sharding, simhash, token_counts, url_filters
from tradeloom.plans.staging import new_folder, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_PASSAGES_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM p) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM r),
one AS (SELECT doc_id, j, w[j] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM w)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS k, count(*) AS n FROM one ANTI JOIN gone USING (doc_id, j) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


@query("op5_repeated_passages", _PASSAGES_SQL)
def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    kept = repeats.without_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_simhash_groups")
def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _tree_sql(shards: int, rows: str, name: str) -> str:
    """Descend the tree of equal weights: the child with the smallest draw at every node."""

    def pick(level: str, weights: dict[int, float]) -> str:
        if len(weights) == 1:
            return str(next(iter(weights)))
        draw = "-ln((('0x' || substr(md5('{0}{1}:' || key), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / {2}::DOUBLE"
        children = ", ".join(f"{{'draw': {draw.format(level, n, w)}, 'child': {n}}}" for n, w in weights.items())
        return f"list_sort([{children}])[1].child"

    def by(chosen: str, picks: dict[int, str]) -> str:
        return f"CASE {chosen} " + " ".join(f"WHEN {n} THEN {x}" for n, x in picks.items()) + " END"

    regions = sharding.tree([1.0] * shards)
    leaves = {r: {n: float(len(rack)) for n, rack in region.items()} for r, region in regions.items()}
    region = pick("region", {r: sum(x.values()) for r, x in leaves.items()})
    rack = by("region", {r: pick("rack", x) for r, x in leaves.items()})
    shard = by("rack", {n: pick("shard", rack) for region in regions.values() for n, rack in region.items()})
    steps = f"SELECT *, {rack} AS rack FROM (SELECT *, {region} AS region FROM {rows})"
    return f"SELECT * EXCLUDE (region, rack), {shard} AS {name} FROM ({steps})"


# CRC-32 byte by byte, with its table made by the rule.
_SHARDS_SQL = f"""
WITH t AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
b AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size, coalesce(CAST(doc_id AS VARCHAR), '') AS key, text IS NULL AS none,
         list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM documents),
c AS (
  SELECT doc_id, size, key, CASE WHEN NOT none THEN xor(list_reduce(list_prepend(4294967295, bytes),
           lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS BIGINT) + 1])), 4294967295) END AS text_crc32 FROM b, t),
p AS ({_tree_sql(16, "c", "shard")}),
g AS ({_tree_sql(17, "p", "grown_shard")})
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5(key || ':' || size), 1, 2), doc_id, size, text_crc32) - 1 AS slot
FROM g"""


@query("op1_hash_tree_shards", _SHARDS_SQL)
def hash_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_plan(table(spark, folder, "documents"))


_CONTAINED_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
bs AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 5) AS n, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ds AS (
  SELECT DISTINCT doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN (SELECT DISTINCT n FROM bs) ON len(w) >= n)),
q AS (SELECT item_id, count(*) AS q FROM bs GROUP BY 1)
SELECT doc_id, item_id, q AS item_shingles, count(*) AS found, count(*)::DOUBLE / q AS containment
FROM ds JOIN bs USING (n, s) JOIN q USING (item_id)
GROUP BY doc_id, item_id, q HAVING count(*) >= ceil(q * 0.8::DOUBLE - 1e-9)"""


@query("op6_benchmark_leaks", _CONTAINED_SQL)
def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op9_pivotal_mix")
def pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.copies(table(spark, folder, "documents"))
    taken = F.col("copies") * F.col("size") + F.col("part")
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "copies", "part")


@query("op8_minhash_fingerprints")
def minhash_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.compared_with_next(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


@query("near_duplicate_links")
def near_duplicate_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links of operator 8's bands: every document with the number of different texts of similarity 0.8 or more."""
    return near_links.near_links(table(spark, folder, "documents"))


@query("op2_language")
def language_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    return language.identified(table(spark, folder, "documents"))


@query("op7_url_verdicts")
def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judged(table(spark, folder, "pages"))


@query("op4_quality")
def document_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judged(docs, quality.train(docs, table(spark, folder, "labels"))).drop("copy")


@query("op3_token_totals")
def token_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of the different texts, as three batches leave them.

    All documents come in with a count estimated from their bytes; the
    tokenizer's counts then revise them; last, all but one row of equal texts
    are deleted.  The first by doc_id, source and language stays, nulls last;
    repeated rows and rows without an id are rows like others, and null texts
    equal empty ones.  Every batch is committed twice.
    """
    counted = stage(token_counts.with_tokens(table(spark, folder, "documents"), "byte_bpe_50k"), "counted")
    guess = F.ceil(F.col("n_bytes") / 4)
    copies = token_counts.repeated(counted)
    totals = token_counts.TokenTotals(spark, new_folder(spark, "token-totals"))
    batches = [token_counts.inserted(counted, guess), token_counts.revised(counted, guess, "tokens"), copies]
    for number, changes in enumerate(batches):
        for _ in range(2):
            totals.commit(number, changes)
    return totals.read()


_INFILL_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
r AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS pre, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS mid,
         array_to_string(u[greatest(a, b) + 1:], '') AS suf FROM r)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""


@query("op12_infill", _INFILL_SQL)
def infilled_documents(spark: SparkSession, folder: str) -> DataFrame:
    cut = infill.infilled(table(spark, folder, "documents"))
    again = infill.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256")
    )


_LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, generate_subscripts(s, 1) AS i, unnest(s) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
r AS (SELECT key, min(doc_id) AS least FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT doc_id, i, line, coalesce(least < doc_id, false) AS gone FROM l LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


@query("op11_repeated_lines", _LINES_SQL)
def repeated_line_texts(spark: SparkSession, folder: str) -> DataFrame:
    kept = repeated_lines.without_repeated_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_aligned_tokens")
def aligned_tokens(spark: SparkSession, folder: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    found = alignment.aligned(table(spark, folder, "documents"), digest)
    return found.withColumnRenamed("groups", "groups_sha256")
