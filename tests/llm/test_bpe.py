import pytest

from vaunu.llm.bpe import TOKENIZERS, encode, token_counts

tokenizers = pytest.importorskip("tokenizers")
TEXTS = [
    None, "", " ", "Hei  maailma!\r\n\n  ok ", "<|endoftext|> don't I'LL", "aaaaaaaaaaaaaaab" * 300, "Ä😀 ½ e5*2007/46*181504*23 \t\t", "漢字 ß ﬁ",
    "x" * 20_000, "Ä😀 ½ e5*2007/46*181504*23 \t\t", "a\u0000b",
]


def test_equals_the_library(spark):
    library = tokenizers.Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    library.encode_special_tokens = True
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string").repartition(3)
    got = {r.doc_id: r.ids for r in encode(df).collect()}
    want = [e.ids for e in library.encode_batch([t or "" for t in TEXTS], add_special_tokens=False)]
    assert got == dict(enumerate(want))
    assert {r.doc_id: r.n_tokens for r in token_counts(df, ["doc_id"]).collect()} == {i: len(w) for i, w in enumerate(want)}
    assert encode(df.limit(0)).collect() == []


def test_whole_table_equals_the_library(spark, sf):
    library = tokenizers.Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    library.encode_special_tokens = True
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    want = {d: e.ids for d, e in zip(texts, library.encode_batch(list(texts.values()), add_special_tokens=False))}
    assert {r.doc_id: r.ids for r in encode(docs).collect()} == want
