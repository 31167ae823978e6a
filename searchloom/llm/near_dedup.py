"""Near-duplicate documents: MinHash, banding, verification, connected components.

1. Each text becomes the set of its distinct word shingles (64-bit hashes), a fingerprint of that
   set and ``BANDS * ROWS`` universal hash minima, in arrays within its partition.
2. Equal sets collapse to one class, so exact copies cost one row from here on.
3. Classes that share a band key are candidates. In each bucket every class is paired with the
   smallest one; pairs whose signatures agree too little go, the rest are confirmed on the full
   sets of their texts. Components of confirmed links follow by large-star and small-star.
4. A bucket that now lies in one component cannot add anything. In the others, classes outside the
   bucket's largest component meet all classes of other components block by block. A block compares
   signatures, confirms on full sets, and gives at most one link for two components. So every
   pair of a bucket has been tested or is known to be connected, and no pairs are listed.

With 30 bands of 5 rows a pair of similarity 0.8 shares no band with a chance below 1 in 100,000.
A signature of a pair of that similarity falls below ``SLACK`` of the threshold with a chance of
about 2 in 100,000.

Defined cases: a text without words (or null) has an empty set and is linked with nothing. Fewer
words than a shingle make one shingle of all. Rows that share an id are one document: their sets
count as linked. Rows without id are linked with nothing, have no component and are kept. Empty
tables give no rows. Other columns are not read, or are carried along whatever they are called.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchloom.llm import shingles
from searchloom.llm.components import components
from searchloom.llm.texts import named
from searchloom.sinks.tables import staged

WORDS, PERCENT = 5, 80
BANDS, ROWS = 30, 5
SLACK = 0.83
BATCH = 128
#: classes of a bucket that meet in one block
BLOCK = 128
#: ids up to this many are broadcast to pick out texts (8 bytes each); more are joined by shuffle
MAX_BROADCAST_IDS = 1_000_000


def signatures(documents: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, n, h1, h2, sig): set size, fingerprint and minima of each text; sig is null for empty sets."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, BATCH):
                batch = rows.slice(at, BATCH)
                sets = shingles.shingle_sets(batch.column(1).to_pylist(), words)
                full = [s for s in sets if len(s)]
                marks = [shingles.fingerprint(s) for s in sets]
                minima = iter(shingles.minima(full, BANDS * ROWS))
                sig = [next(minima).tobytes() if len(s) else None for s in sets]
                columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()), pa.array(sig, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "h1", "h2", "sig"])

    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(named(id_col).alias("id"), named(text_col).alias("text"))
    return rows.mapInArrow(make, f"id {kind}, n long, h1 long, h2 long, sig binary")


def _band_rows(classes: DataFrame) -> DataFrame:
    """(key, node): a row for each band of each class."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                keys = shingles.band_keys(sigs, BANDS)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(keys), pa.list_(pa.int64()))], ["node", "keys"])

    kind = classes.schema["node"].dataType.simpleString()
    return classes.select("node", "sig").mapInArrow(make, f"node {kind}, keys array<long>").select("node", F.explode("keys").alias("key"))


@F.pandas_udf(T.IntegerType())
def _agreeing(a: pd.Series, b: pd.Series) -> pd.Series:
    """Minima that two signatures have in common."""
    if not len(a):
        return pd.Series([], dtype="int32")
    left, right = (np.frombuffer(b"".join(x), np.uint32).reshape(len(x), -1) for x in (a, b))
    return pd.Series((left == right).sum(axis=1).astype("int32"))


def _least_agreeing(percent: int) -> int:
    return int(BANDS * ROWS * percent / 100 * SLACK)


def _alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose signatures agree enough."""
    sigs = classes.select("node", "sig")
    both = pairs.join(sigs.select(F.col("node").alias("u"), F.col("sig").alias("sig_u")), "u").join(sigs.select(F.col("node").alias("v"), F.col("sig").alias("sig_v")), "v")
    return both.where(_agreeing("sig_u", "sig_v") >= _least_agreeing(percent)).select("u", "v").distinct()


class _Sets:
    """Shingle sets of the texts met last; a text that many pairs name is cut up once in a row."""

    def __init__(self, words: int, room: int = 64):
        self._words, self._room, self._kept = words, room, OrderedDict()

    def of(self, text: str) -> np.ndarray:
        found = self._kept.pop(text, None)
        if found is None:
            found = shingles.shingle_sets([text], self._words)[0]
        self._kept[text] = found
        if len(self._kept) > self._room:
            self._kept.popitem(last=False)
        return found


def _enough(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough: 100 * common >= percent * union."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(words)
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = sets.of(a.as_py()), sets.of(b.as_py())
                keep.append(_enough(x, y, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    pairs = staged(pairs, "near-pairs")
    ids = staged(pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct(), "near-ids")
    needed = _texts_of(ids, texts)
    both = pairs.join(needed.select(F.col("id").alias("u"), F.col("text").alias("a")), "u").join(needed.select(F.col("id").alias("v"), F.col("text").alias("b")), "v")
    kind = pairs.schema["u"].dataType.simpleString()
    return both.select("u", "v", "a", "b").mapInArrow(check, f"u {kind}, v {kind}").distinct()


def _texts_of(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts of the staged ids; only those are moved."""
    return texts.join(F.broadcast(nodes) if nodes.count() <= MAX_BROADCAST_IDS else nodes, "id", "left_semi")


def _rest(shared: DataFrame, found: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (u, v) between classes of different components that share a bucket, block by block.

    A bucket's classes outside its largest component meet all others. Buckets of the same
    classes count once.
    """
    kind = classes.schema["node"].dataType.simpleString()
    rows = shared.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    sizes = rows.groupBy("key", "component").count()
    open_ = sizes.groupBy("key").agg(F.sum("count").alias("n"), F.count("*").alias("parts"), F.max_by("component", F.struct("count", "component")).alias("main"), F.max("count").alias("most"))
    # two classes have been tested already: one of them is the smallest
    open_ = open_.where("parts > 1 and n > 2")
    rows = rows.join(open_, "key")
    same = rows.groupBy("key").agg(F.bit_xor(F.xxhash64("node")).alias("mark"), F.first("n").alias("n")).groupBy("mark", "n").agg(F.min("key").alias("key"))
    rows = staged(rows.join(same.select("key"), "key", "left_semi"), "near-open")
    ids = staged(rows.select(F.col("node").alias("id")).distinct(), "near-ids")
    known = classes.join(ids.withColumnRenamed("id", "node"), "node", "left_semi").select("node", "sig").join(_texts_of(ids, texts).withColumnRenamed("id", "node"), "node")
    known = known.groupBy("node").agg(F.first("sig").alias("sig"), F.first("text").alias("text"))
    rows = rows.join(known, "node")
    split = lambda n: F.ceil(n / BLOCK).cast("int")
    outer, all_ = split(F.col("n") - F.col("most")), split(F.col("n"))
    place = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    each = lambda n: F.sequence(F.lit(0), n - 1)
    # each row once for every block that it takes part in, on the left, the right or both
    as_left = F.when(F.col("component") != F.col("main"), F.transform(each(all_), lambda j: F.struct(place(outer).alias("i"), j.alias("j"), F.lit(True).alias("left"))))
    as_right = F.transform(each(outer), lambda i: F.struct(i.alias("i"), place(all_).alias("j"), F.lit(False).alias("left")))
    none = F.array().cast("array<struct<i:int,j:int,left:boolean>>")
    rows = rows.select("key", "node", "component", "sig", "text", F.explode(F.concat(F.coalesce(as_left, none), as_right)).alias("at"))
    rows = rows.select("key", "at.i", "at.j", "at.left", "node", "component", "sig", "text")
    least = _least_agreeing(percent)

    def meet(block: pd.DataFrame) -> pd.DataFrame:
        sigs = np.frombuffer(b"".join(block["sig"]), np.uint32).reshape(len(block), -1)
        side, nodes, texts = block["left"].to_numpy(), block["node"].to_numpy(), block["text"].to_numpy()
        parts = pd.factorize(block["component"])[0]
        sets: dict[int, np.ndarray] = {}

        def shingles_of(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = shingles.shingle_sets([texts[row]], words)[0]
            return sets[row]

        there, links = np.flatnonzero(~side), []
        for i in np.flatnonzero(side):
            for j in there[(parts[there] != parts[i]) & ((sigs[there] == sigs[i]).sum(axis=1) >= least)]:
                if parts[i] != parts[j] and _enough(shingles_of(i), shingles_of(j), percent):
                    links.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
                    parts[parts == parts[j]] = parts[i]
        return pd.DataFrame(links, columns=["u", "v"])

    return rows.groupBy("key", "i", "j").applyInPandas(meet, f"u {kind}, v {kind}").distinct()


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id it is linked with) and ``kept``."""
    sigs = staged(signatures(documents, id_col, text_col, words), "near-signatures")
    usable = sigs.where(F.col("n").cast("boolean") & F.col("id").isNotNull())
    classes = staged(usable.groupBy("h1", "h2", "n").agg(F.min("id").alias("node"), F.first("sig").alias("sig")), "near-classes")

    bands = _band_rows(classes)
    buckets = bands.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    shared = staged(bands.join(buckets.select("key", "least"), "key"), "near-shared")
    pairs = shared.where("least < node").select(F.col("least").alias("u"), F.col("node").alias("v")).distinct()
    texts = documents.select(named(id_col).alias("id"), named(text_col).alias("text"))
    # copies of a class member hold the same set, so the text of the named row stands for all
    links = staged(_confirmed(_alike(pairs, classes, percent), texts, words, percent), "near-links")

    nodes = usable.join(classes.select("h1", "h2", "n", "node"), ["h1", "h2", "n"]).select("id", "node")
    several = nodes.groupBy("id").agg(F.min("node").alias("u"), F.max("node").alias("w")).where("u < w")
    own = nodes.join(several.select("id", "u"), "id").where("u < node").select("u", F.col("node").alias("v"))
    links = staged(links.union(own), "near-links")
    found = components(links)
    more = staged(_rest(shared, found, classes, texts, words, percent), "near-more")
    if not more.isEmpty():
        found = components(links.union(more))

    found = staged(found, "near-components")
    rows = sigs.join(classes.select("h1", "h2", "n", "node"), ["h1", "h2", "n"], "left").join(found, "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def representatives(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents with the smallest id of their component, and those without id; all columns as they were."""
    gone = staged(report(documents, id_col, text_col, words, percent).where(~F.col("kept")).select(F.col(id_col).alias("_gone")).distinct(), "near-gone")
    return documents.join(gone, documents[id_col] == gone["_gone"], "left_anti")
