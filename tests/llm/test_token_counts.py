from collections import Counter

from pyspark.sql import functions as F

from tests.llm.conftest import ODD, frame
from tradeloom.llm import token_counts


def totals(table):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in table.read().collect()}


def test_batches_add_up_and_count_once(spark, odd, tmp_path):
    encode = token_counts.load_tokenizer().encode_ordinary
    counted = token_counts.with_tokens(odd, "v1")
    assert sorted((repr(r.doc_id), r.tokens) for r in counted.collect()) == sorted((repr(i), len(encode(t or ""))) for i, t, _, _ in ODD)
    table = token_counts.TokenTotals(spark, str(tmp_path / "totals"))
    assert totals(table) == {}
    want, n = Counter(), Counter()
    for i, t, g, s in ODD:
        want[(s, g, "v1")] += len(encode(t or ""))
        n[(s, g, "v1")] += 1
    assert table.commit(0, token_counts.inserted(counted))
    assert not table.commit(0, token_counts.inserted(counted))
    assert totals(table) == {k: (n[k], want[k]) for k in n}

    # Counts of source a are revised to twice their size, then its documents are deleted.
    of_a = counted.where("source = 'a'")
    assert table.commit(1, token_counts.revised(of_a, "tokens", F.col("tokens") * 2))
    assert totals(table) == {k: (n[k], want[k] * (2 if k[0] == "a" else 1)) for k in n}
    assert table.commit(2, token_counts.deleted(of_a, F.col("tokens") * 2))
    assert not table.commit(1, token_counts.deleted(of_a))
    assert totals(table) == {k: (n[k], want[k]) for k in n if k[0] != "a"}

    # A new tokenizer version has totals of its own; a batch of nothing is a batch.
    assert table.commit(3, token_counts.inserted(counted.withColumn("tokenizer", F.lit("v2")), F.lit(1)))
    assert table.commit(4, token_counts.inserted(counted.limit(0)))
    assert sum(d for (_, _, v), (d, _) in totals(table).items() if v == "v2") == len(ODD)


def test_state_of_another_writer_is_kept(spark, odd, tmp_path):
    one = token_counts.TokenTotals(spark, str(tmp_path / "t"))
    two = token_counts.TokenTotals(spark, str(tmp_path / "t"))
    rows = token_counts.inserted(token_counts.with_tokens(odd, "v1"))
    assert one.commit(0, rows) and two.commit(1, rows)
    assert sum(d for d, _ in totals(one).values()) == 2 * len(ODD)


def test_long_runs_of_blanks_have_the_librarys_tokens():
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    one = token_counts.load_tokenizer()
    blank = " " * 20_000
    texts = [blank, f"a{blank}b", f"{blank}b", f"a b{blank}", f"a\n{blank}\tb c{blank}\u3000{blank}x", "a" + "\n" * 15_000 + "'s 12", " " * 1_000_000, "x" + " " * 1_000_000 + "y"]
    assert [token_counts.encode(one, t) for t in texts] == [slow.encode(t, add_special_tokens=False).ids for t in texts]


def test_one_row_of_equal_texts_stays(spark):
    rows = [(1, "four words are here", "en", "a"), (1, "four words are here", "en", "a"), (None, "four words are here", "en", "a"), (2, "four words are here", "de", "b")]
    rows += [(None, "no id", "en", "a")] * 3 + [(5, None, "en", "a"), (4, "", None, "a"), (6, "only one", None, None)]
    counted = token_counts.with_tokens(frame(spark, rows), "v").cache()
    left = counted.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("d"), F.sum("tokens").alias("t"))
    gone = token_counts.repeated(counted).groupBy("source", "lang").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    total = {}
    for r in [*left.collect(), *gone.collect()]:
        d, t = total.get((r.source, r.lang), (0, 0))
        total[(r.source, r.lang)] = (d + r.d, t + r.t)
    size = lambda t: len(token_counts.load_tokenizer().encode_ordinary(t))
    assert total == {("a", "en"): (2, size("four words are here") + size("no id")), ("b", "de"): (0, 0), ("a", None): (1, 0), (None, None): (1, size("only one"))}


def test_query_gives_the_totals_of_different_texts(spark):
    from tradeloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    encode = token_counts.load_tokenizer().encode_ordinary
    seen, tokens, n = set(), Counter(), Counter()
    for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect():
        if r.text not in seen:
            seen.add(r.text)
            tokens[(r.source, r.lang)] += len(encode(r.text or ""))
            n[(r.source, r.lang)] += 1
    got = {(r.source, r.lang): (r.documents, r.tokens) for r in QUERIES["op3_token_totals"](spark, folder).collect()}
    assert got == {k: (n[k], tokens[k]) for k in n}
