"""Personal data: fixed patterns, and identifiers found from their contexts by bootstrapping.

The patterns give seed entities. Every identifier-like token (4 and more digits or an @, 6 to 64
characters) is an instance, the words around it with its outer form are lexical patterns, and the
two make a bipartite graph over the whole corpus. Scores go to and fro: a pattern scores, for each
kind, the smoothed share of its distinct instances that are of the kind; an instance scores the
best of its patterns. A pattern counts in a round if enough of its distinct instances are seeds or
scored above the threshold in the round before, so what was found teaches further patterns; after
``ROUNDS`` rounds they go on for as long as one finds more. Instances that end above the
threshold, and were no seeds, are identifiers that the fixed patterns missed; they are reported
wherever they stand.

Texts are read once, in Python within their partition; the graph is plain joins and sums, with
tables written between rounds. Spans count code points; ends are exclusive.

Defined cases: a null text is an empty one and has no spans. Rows are judged one by one, so
repeated rows and rows without id give one result each (though a repeated context counts once: the
graph holds distinct pairs). Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom.llm.texts import hex_digest, whole
from searchloom.sinks.tables import staged

KINDS = ["email", "ip", "card", "phone"]
FOUND = [f"like_{k}" for k in KINDS]
ROUNDS, MIN_SEEDS, SMOOTHING, THRESHOLD = 3, 3, 1.0, 0.75
MIN_TOKEN, MAX_TOKEN, MIN_DIGITS = 6, 64, 4
CONTEXT_CHARS = 64
BATCH = 256

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits matches from its start or not at all, so later starts need no try
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile("[0-9@]")
_DIGITS = re.compile("[^0-9]+")
_SPACES = frozenset(" \t\n\v\f\r")
_EDGES = ".,;:!?()[]{}<>\"'`"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ to the left as far as the local part goes: the leftmost start, without a try at every character."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            yield start, match.end()
        low = match.end() if match else at + 1
        at = text.find("@", low)


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(rank of the kind, start, end), sorted."""
    spans = [(0, a, b) for a, b in emails(text)]
    if _MARK.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) < 4 and int(p or 0) < 256 for p in parts):
                spans.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = _DIGITS.sub("", m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                spans.append((2, m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                spans.append((3, m.start(), m.end()))
    return spans


def _word(word: str) -> str:
    return word.strip(_EDGES).lower()


def _form(token: str) -> str:
    """The outer form: mail-like, numbers and signs, or letters and digits."""
    if "@" in token:
        return "@"
    return "a9" if any(map(str.isalpha, token)) else "9"


def instances(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, str, list[str]]]:
    """(start, end, rank of the seed's kind or -1, token, patterns). A seed keeps its own borders."""
    seeds = sorted((a, b, k) for k, a, b in spans)
    at, i, n = 0, 0, len(text)
    while mark := _MARK.search(text, at):
        p = mark.start()
        while i < len(seeds) and seeds[i][1] <= p:
            i += 1
        if i < len(seeds) and seeds[i][0] <= p:
            start, end, kind = seeds[i]
            at = end
        else:
            start, end, kind = p, p + 1, -1
            stop = seeds[i][0] if i < len(seeds) else n
            while start > at and text[start - 1] not in _SPACES:
                start -= 1
            while end < stop and text[end] not in _SPACES:
                end += 1
            at = end
            while start < end and text[start] in _EDGES:
                start += 1
            while end > start and text[end - 1] in _EDGES:
                end -= 1
        token = text[start:end]
        if not MIN_TOKEN <= len(token) <= MAX_TOKEN or not ("@" in token or len(_DIGITS.sub("", token)) >= MIN_DIGITS):
            continue
        left = [_word(w) for w in text[max(0, start - CONTEXT_CHARS) : start].split()[-2:]]
        right = [_word(w) for w in text[end : end + CONTEXT_CHARS].split()[:1]]
        form = _form(token)
        patterns = []
        if len(left) == 2:
            patterns.append(f"{left[0]} {left[1]} <{form}>")
        if left and right:
            patterns.append(f"{left[-1]} <{form}> {right[0]}")
        yield start, end, kind, token, patterns


_SPAN = pa.struct([("rank", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_SEEN = pa.struct([("rank", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("token", pa.string()), ("patterns", pa.list_(pa.string()))])
_DDL = "base array<struct<rank:int,start:long,end:long>>, seen array<struct<rank:int,start:long,end:long,token:string,patterns:array<string>>>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for all_rows in batches:
        for at in range(0, all_rows.num_rows, BATCH):
            batch = all_rows.slice(at, BATCH)
            base, seen = [], []
            for text in batch.column(2).to_pylist():
                spans = base_spans(text)
                base.append([dict(zip(("rank", "start", "end"), s)) for s in spans])
                seen.append([{"start": a, "end": b, "rank": k, "token": t, "patterns": p} for a, b, k, t, p in instances(text, spans)])
            columns = [batch.column(0), batch.column(1), pa.array(base, pa.list_(_SPAN)), pa.array(seen, pa.list_(_SEEN))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "base", "seen"])


def read(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, base, seen): pattern spans and instances of each text."""
    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return rows.mapInArrow(_read, f"row long, id {kind}, {_DDL}")


def scored(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(token, rank): instances that are no seeds but score above the threshold for one kind."""
    seen = rows.select(F.explode("seen").alias("s")).select("s.token", "s.rank", F.explode("s.patterns").alias("pattern"))
    edges = seen.groupBy("pattern", "token").agg(F.max("rank").alias("rank"))
    # a pattern of too few instances can never pass on a score, even if all of them are found
    rich = edges.groupBy("pattern").count().where(F.col("count") >= MIN_SEEDS)
    edges = staged(edges.join(rich.select("pattern"), "pattern", "left_semi"), "pii-edges")

    ranks = range(len(KINDS))
    seeds = edges.where("rank >= 0").groupBy("token").agg(F.max("rank").alias("rank"))
    scores = seeds.select("token", F.lit(True).alias("seed"), *[(F.col("rank") == k).cast("double").alias(f"s{k}") for k in ranks])
    top = F.greatest(*[F.col(f"s{k}") for k in ranks])
    round_, before, now = 0, -1, 0
    # scores never fall, so neither does what is found
    while round_ < rounds or now > before:
        known = edges.join(scores, "token", "left")
        share = [(F.sum(F.coalesce(f"s{k}", F.lit(0.0))) / (F.count("*") + SMOOTHING)).alias(f"c{k}") for k in ranks]
        teachers = F.count_if(F.col("seed") | (top >= THRESHOLD)).alias("teachers")
        trusted = known.groupBy("pattern").agg(teachers, *share).where(F.col("teachers") >= MIN_SEEDS)
        best = edges.where("rank < 0").join(trusted, "pattern").groupBy("token").agg(*[F.max(f"c{k}").alias(f"s{k}") for k in ranks])
        best = best.join(seeds.select("token"), "token", "left_anti").select("token", F.lit(False).alias("seed"), *[f"s{k}" for k in ranks])
        first = seeds.select("token", F.lit(True).alias("seed"), *[(F.col("rank") == k).cast("double").alias(f"s{k}") for k in ranks])
        scores = staged(first.unionByName(best), f"pii-scores-{round_}")
        round_ += 1
        if round_ >= rounds:
            before, now = now, scores.where(~F.col("seed") & (top >= THRESHOLD)).count()
    rank = F.coalesce(*[F.when(F.col(f"s{k}") == top, k) for k in ranks])
    return scores.where(~F.col("seed") & (top >= THRESHOLD)).select("token", (rank + len(KINDS)).alias("rank"))


def find(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Per row: ``id``, ``base`` and ``spans`` (base spans and those found from contexts), each sorted by kind and start."""
    rows = staged(read(documents, id_col, text_col), "pii-rows")
    unseen = rows.select("row", F.explode("seen").alias("s")).where("s.rank < 0")
    found = unseen.join(scored(rows, rounds), F.col("s.token") == F.col("token")).groupBy("row").agg(
        F.collect_list(F.struct("rank", F.col("s.start").alias("start"), F.col("s.end").alias("end"))).alias("more")
    )
    # one text's own spans, so bounded by its length
    more = F.coalesce("more", F.array().cast("array<struct<rank:int,start:long,end:long>>"))
    return rows.join(found, "row", "left").select("id", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", more)).alias("spans"))


def _listed(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS + FOUND])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def _of_rank(rank: int) -> Column:
    return F.filter("base", lambda s: s["rank"] == rank)


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts by kind, digest of the pattern spans, all spans as text."""
    counts = [F.size(_of_rank(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    found = find(documents, id_col, text_col)
    return found.select(F.col("id").alias(id_col), *counts, hex_digest(_listed("base")).alias("base_sha256"), _listed("spans").alias("spans"))
