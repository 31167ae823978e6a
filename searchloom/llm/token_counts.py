"""Token counts by a two-tier lookup on the map side.

The first tier is a compact hash table of frequent pre-tokens and their lengths in tokens, sent
to every worker. The second is a bounded cache in each worker; only what neither knows is
encoded. Pre-tokens are never shuffled and no row leaves its task.

A text may be cut into pre-tokens only where no token can reach across. For a sentencepiece BPE
model without normalisation rules that is between any character and a following space, provided
that no piece holds a space after another character; the model is checked for this, and whole
texts are encoded where it does not hold. Other libraries' files encode whole texts.

The frequent pre-tokens are those of at most ``sample_rows`` rows of at most ``SAMPLE_CHARS``
characters, at most ``frequent`` of them and ``MAX_CACHED_CHARS`` characters each. They only save
time: counts never depend on them.

Defined cases: a null text is an empty one of 0 bytes and 0 tokens. Rows are counted one by one,
so repeated rows and rows without id give one result each. Texts are never cut short. Empty tables
give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bounds of the sample that names frequent pre-tokens: rows, and characters of a row
SAMPLE_ROWS, SAMPLE_CHARS = 1_000, 20_000
FREQUENT = 30_000
CACHED = 200_000
MAX_CACHED_CHARS = 64
#: texts at a time, so that a task holds few of them
BATCH = 256
# a space, or the mark that the model writes for one; then all up to the next space
PRE_TOKEN = re.compile("[ ▁]+[^ ▁]*")


class Lengths(dict):
    """Length in tokens by pre-token: frequent ones, then those met lately, then the encoder."""

    def __init__(self, encode, frequent: dict[str, int]):
        super().__init__(frequent)
        self._encode, self._room = encode, len(frequent) + CACHED
        self._frequent = frequent

    def __missing__(self, pre_token: str) -> int:
        # the encoder puts one space before what it gets
        n = len(self._encode(pre_token[1:])) if len(pre_token) > 1 else 1
        if len(pre_token) <= MAX_CACHED_CHARS:
            if len(self) >= self._room:
                self.clear()
                self.update(self._frequent)
            self[pre_token] = n
        return n


def load(name: str, content: bytes):
    """(encode, whether pre-tokens may be encoded one by one) of a tokenizer file."""
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(content)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return (lambda text: tokenizer.encode(text, add_special_tokens=False).ids), False
    import sentencepiece

    encoder = sentencepiece.SentencePieceProcessor(model_proto=content)
    return encoder.encode, _separable(encoder)


def _separable(encoder) -> bool:
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto.FromString(encoder.serialized_model_proto())
    rules, how = model.normalizer_spec, model.trainer_spec
    plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
    plain = plain and not rules.precompiled_charsmap and not how.treat_whitespace_as_suffix and how.model_type == how.BPE
    kinds = model.SentencePiece
    # a lone space must be a token, and no token may hold a space after another character
    known = any(p.piece == "▁" and p.type == kinds.NORMAL for p in model.pieces)
    return plain and known and not any(p.type == kinds.USER_DEFINED or re.search("[^▁]▁", p.piece) for p in model.pieces)


def _counter(name: str, content: bytes, frequent: dict[str, int]):
    """A function from text to its number of tokens, made once per task."""
    encode, separable = load(name, content)
    if not separable:
        return lambda text: len(encode(text))
    lengths = Lengths(encode, frequent)
    return lambda text: sum(map(lengths.__getitem__, PRE_TOKEN.findall(" " + text))) if text else 0


def frequent_lengths(documents: DataFrame, tokenizer_file: str, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, frequent: int = FREQUENT) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a bounded sample."""
    content = _content(tokenizer_file)
    encode, separable = load(tokenizer_file, content)
    if not separable:
        return {}

    found = Counter()
    for row in documents.select(F.col(text_col)).where(F.length(text_col) <= SAMPLE_CHARS).take(sample_rows):
        found.update(p for p in PRE_TOKEN.findall(" " + row[0]) if len(p) <= MAX_CACHED_CHARS)
    lengths = Lengths(encode, {})
    return {p: lengths[p] for p, _ in found.most_common(frequent)}


def _content(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def count_tokens(documents: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, sample_rows: int = SAMPLE_ROWS, frequent: int = FREQUENT) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    ``tokenizer_file`` is read on the driver and sent to the workers.
    """
    context = documents.sparkSession.sparkContext
    shared = context.broadcast((tokenizer_file, _content(tokenizer_file), frequent_lengths(documents, tokenizer_file, text_col, sample_rows, frequent)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _counter(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                counts = [tokens(t) for t in texts]
                sizes = [len(t.encode()) for t in texts]
                columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = documents.schema[id_col].dataType.simpleString()
    counted = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumnRenamed("id", id_col)
