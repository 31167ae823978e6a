import public_tokenizers
import pytest
from pyspark.sql import functions as F

from searchloom.llm import token_counts

TEXTS = [None, "", " ", "  ", "a", "a ", " a  b   ", "▁x ▁▁ y", "Hello\n\n world\t<s> </s> <unk>", "é 日本 \x00 ﬁ", "word " * 3000, "x" * 20_000, "the cat sat on the mat. " * 50]


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_counts_as_the_library(spark, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
    else:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (4, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    want = sorted(((i, len((t or "").encode()), len(encode(t or "")), len(encode(t or "")) > 4096) for i, t in rows), key=str)
    for sample in (0, 5, 100):
        got = token_counts.count_tokens(docs, path, sample_rows=sample)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert token_counts.count_tokens(docs.limit(0), path).collect() == []


def test_the_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 3)
    lengths = token_counts.Lengths(lambda t: [0] * len(t), {" a": 1})
    assert [lengths[" " + "x" * n] for n in range(1, 10)] == list(range(1, 10))
    assert len(lengths) <= 4 and lengths[" a"] == 1
