"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. Token weights of the cells are raked in
turn to the target shares of each of the three until all fit, starting from the tokens that
are there, so what the targets leave open stays as it is. A document is then kept with the
probability of its cell, by a hash of its id; cells that would need more than all of their tokens
keep all of them, and ``weight`` says how much more each should count.

Targets are a table of (dimension, value, share), or shares in proportion to tokens raised to
``TEMPERATURE``. Values that a table does not name get nothing; shares of values that no document
has go to the others in proportion.

Only cells are raked, one row for each combination that occurs, summed before anything is
shuffled. Texts are never shuffled. Every few rounds are written to the shared folder.

Defined cases: null and empty values are one value, the empty one. A document without words has no
tokens; cells without any tokens are kept whole, as they weigh nothing. A row without id is
sampled by its text. Repeated rows share one decision. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from searchloom.llm.texts import SPACES, named, row_of, split_words, whole
from searchloom.sinks.tables import staged

DIMENSIONS = ["source", "lang", "topic"]
TEMPERATURE, FRACTION, SEED = 0.7, 0.8, "mix"
TOLERANCE, MAX_ROUNDS, ROUNDS_AT_ONCE = 1e-12, 200, 4
#: cells up to this many are broadcast to the documents; more are joined by shuffle
MAX_BROADCAST_CELLS = 100_000


def form_topic(text: Column) -> Column:
    """A topic by outer form, where no better one is known."""
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    topic = F.when(F.contains(text, F.lit("|")), "table").when(F.contains(text, F.lit("@")), "contact")
    topic = topic.when(F.lower(text).contains("licens"), "notice").when(lines * 200 > F.length(text), "short lines")
    return topic.otherwise("prose")


def features(text_col: str, topic: Column | None = None) -> list[Column]:
    text = whole(named(text_col))
    topic = form_topic(text) if topic is None else topic
    values = [F.coalesce(named(d).cast("string"), F.lit("")).alias(d) for d in DIMENSIONS[:2]]
    return [*values, F.coalesce(topic, F.lit("")).alias("topic"), F.size(split_words(text, SPACES)).cast("bigint").alias("n_tokens")]


def chance(id_col: str, text_col: str, seed: str = SEED) -> Column:
    """A fixed number from 0 to 1 for each document: 52 bits of a digest."""
    key = F.coalesce(named(id_col).cast("string"), F.sha2(whole(named(text_col)).cast("binary"), 256))
    digest = F.sha2(F.concat(F.lit(seed + ":"), key).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)


def natural_targets(cells: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """(dimension, value, share): tokens to the power of ``temperature``."""
    parts = [cells.groupBy(d).agg(F.sum("tokens").alias("t")).select(F.lit(d).alias("dimension"), F.col(d).alias("value"), F.pow(F.col("t").cast("double"), F.lit(temperature)).alias("share")) for d in DIMENSIONS]
    return parts[0].union(parts[1]).union(parts[2])


def raked(cells: DataFrame, targets: DataFrame, tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """The cells (source, lang, topic, tokens …) with ``share``: fitted shares that sum to 1.

    Ends when no share of a dimension is off by more than ``tolerance``, or, as targets can
    contradict each other in sparse tables, after ``max_rounds``.
    """
    goals = {}
    for d in DIMENSIONS:
        present = cells.groupBy(d).agg(F.sum("tokens").alias("t")).where("t > 0")
        mine = targets.where((F.col("dimension") == d) & (F.col("share") > 0)).select(F.coalesce("value", F.lit("")).alias(d), "share")
        mine = mine.groupBy(d).agg(F.sum("share").alias("share")).join(present.select(d), d)
        total = mine.agg(F.sum("share")).first()[0]
        goals[d] = staged(mine.select(d, (F.col("share") / F.lit(total or 1.0)).alias("goal")), f"mix-goals-{d}")
    # what a target leaves out is out in all rounds
    state = cells.where("tokens > 0").withColumn("w", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        state = state.join(goals[d].withColumnRenamed("goal", f"goal_{d}"), d)
    state = staged(state, "mix-cells")
    for round_ in range(0, max_rounds, ROUNDS_AT_ONCE):
        for _ in range(ROUNDS_AT_ONCE):
            off = F.lit(0.0)
            for d in DIMENSIONS:
                # one row for each cell of a value, whatever the number of documents
                factor = F.col(f"goal_{d}") / F.sum("w").over(W.partitionBy(d))
                state = state.withColumn(f"f_{d}", factor).withColumn("w", F.col("w") * F.col(f"f_{d}"))
                off = F.greatest(off, F.abs(F.col(f"f_{d}") - 1))
        state = staged(state.withColumn("off", off).drop(*[f"f_{d}" for d in DIMENSIONS]), f"mix-round-{round_}")
        worst = state.agg(F.max("off")).first()[0]
        state = state.drop("off")
        if worst is None or worst <= tolerance:
            break
    fitted = state.select(*DIMENSIONS, F.col("w").alias("share"))
    return cells.join(fitted, DIMENSIONS, "left").withColumn("share", F.coalesce("share", F.lit(0.0)))


def cell_rates(rows: DataFrame, targets: DataFrame | None = None, fraction: float = FRACTION, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, lang, topic, probability, weight) from rows with ``features``."""
    cells = staged(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "mix-counts")
    fitted = raked(cells, natural_targets(cells, temperature) if targets is None else targets)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    rate = F.when(F.col("tokens") > 0, F.col("share") * float(total * fraction) / F.col("tokens")).otherwise(1.0)
    rates = fitted.select(*DIMENSIONS, rate.alias("rate"))
    return staged(rates.select(*DIMENSIONS, F.least("rate", F.lit(1.0)).alias("probability"), F.greatest("rate", F.lit(1.0)).alias("weight")), "mix-rates")


def _rated(rows: DataFrame, rates: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(rates) if rates.count() <= MAX_BROADCAST_CELLS else rates, DIMENSIONS)


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", targets: DataFrame | None = None, fraction: float = FRACTION) -> DataFrame:
    """Per row: id, cell, ``n_tokens``, ``probability`` and ``weight`` (6 decimals), ``kept``."""
    rows = staged(documents.select(named(id_col).alias("_id"), chance(id_col, text_col).alias("chance"), *features(text_col)), "mix-rows")
    rated = _rated(rows, cell_rates(rows, targets, fraction))
    return rated.select(
        F.col("_id").alias(id_col), *DIMENSIONS, "n_tokens", F.round("probability", 6).alias("probability"), F.round("weight", 6).alias("weight"),
        (F.col("chance") < F.col("probability")).alias("kept"),
    )


def sampled(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", targets: DataFrame | None = None, fraction: float = FRACTION) -> DataFrame:
    """The documents that are kept, all columns as they were."""
    rates = cell_rates(documents.select(*features(text_col)), targets, fraction)
    rows = documents.select(row_of(documents.columns).alias("_row"), chance(id_col, text_col).alias("chance"), *features(text_col))
    return _rated(rows, rates).where(F.col("chance") < F.col("probability")).select("_row.*")
