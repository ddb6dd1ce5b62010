import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lastro.llm import queries, tokens
from tests.llm.helpers import awkward, docs, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = st.sampled_from([
    "a", "b", " ", "  ", "\n", "\t", "'", "re", "'ll", "'ve", "ll", "é", "ß", "1", "23",
    "!", "==", "日本", "the", "<|endoftext|>", "<|end", "\x1c", "\x85", " ", "😀",
    "​", "²", "aaa", "'S", " ", "\r\n", "İ", "ing"])


def true(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_every_prefix_counts_as_the_library_counts_it(text):
    own = tokens.counter(PATH)
    assert own.prefixes(text).tolist() == [true(text[:k]) for k in range(len(text) + 1)]
    assert own.count(text) == true(text)


@pytest.mark.parametrize("text", [
    "a" * 3000, "=" * 5000, " " * 4000, "\n" * 999 + "x", "日本語" * 500, "aab" * 700,
    "".join(chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000)])
def test_long_and_odd_texts(text):
    assert tokens.counter(PATH).count(text) == true(text)
    assert tokens.counter(PATH).prefixes(text[:400])[-1] == true(text[:400])


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet")
                 .select("doc_id", "text").collect())
    rows = queries.op6_tokens(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (
            len(text.encode()), true(text), true(text) > 1024)


def test_stored_prefixes_answer_budgets(spark):
    text = "Don't stop  believing, été 2024!\n\nThe end."
    table = docs(spark, [(1, text), (2, None), (3, "")])
    stored = table.withColumn("p", tokens.prefix_tokens(F.col("text"), PATH))
    for k in (0, 1, 5, 11, 99):
        row = stored.select(tokens.tokens_before(F.col("p"), F.lit(k))).orderBy("doc_id")
        assert row.first()[0] == true(text[:k])
    for budget in (0, 1, 3, 7, 100):
        cut = {r.doc_id: r.text for r in tokens.truncate(table, PATH, budget).collect()}
        best = max(k for k in range(len(text) + 1) if true(text[:k]) <= budget)
        assert cut == {1: text[:best], 2: None, 3: ""}


def test_awkward_rows(spark):
    table = awkward(spark, "n_tokens n_bytes over_limit tokens")
    rows = tokens.count_tokens(table, PATH).select("text", "n_tokens", "n_bytes").collect()
    assert len(rows) == 11
    assert all(r.n_tokens == true(r.text or "") for r in rows)
    assert tokens.count_tokens(empty(spark), PATH).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tokens.PrefixCounter(public_tokenizers.path("word_bpe_49k.json"))
