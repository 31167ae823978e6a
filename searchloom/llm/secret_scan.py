"""Secret scans: fixed patterns, and a randomness test battery with false-discovery control.

Patterns find what announces itself (assignments, access keys, long hex). For the rest, every run
of 20 and more token characters is a candidate. Its encoding is inferred (hex, base 32, letters
and digits of one or both cases, base 64), and three tests ask whether its characters look drawn
at random from that alphabet: chi-squared uniformity, number of runs above and below the middle
of the alphabet, and serial correlation of neighbours. A candidate that all three tests accept is
then tested against ordinary text: with the letter repetition of prose, chi-squared would be
larger. Those p-values go through Benjamini-Hochberg control within strata of encoding and
length, as short candidates tell less. Spans count code points; ends are exclusive.

Two passes: scan every text once and store spans and candidate statistics, then take thresholds
from a histogram of all candidates and apply them. No row is shuffled; thresholds are one row per
stratum.

Defined cases: a null text is an empty one and has no spans. Rows are scanned one by one, so
repeated rows and rows without id give one result each. Candidates inside a pattern's span add
nothing. Digits alone are no candidate. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom.llm.texts import hex_digest, row_of, whole
from searchloom.sinks.tables import staged

# fixed values of the base patterns
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_MIN = 6
# runs are maximal, so asking for the least length in the pattern finds the same spans
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: encoding: (pattern of its tokens, alphabet, chance that two characters of ordinary text agree); the first that fits counts
ENCODINGS = {
    "hex": (r"^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef", 0.2),
    "base32": (r"^[A-Z2-7]+$", UPPER + "234567", 0.065),
    "single_case": (r"^([0-9a-z]+|[0-9A-Z]+)$", DIGITS + LOWER, 0.065),
    "alphanumeric": (r"^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER, 0.065),
    "base64": (r"^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/", 0.065),
}
#: lower ends of the length strata
LENGTHS = [20, 28, 40, 64, 128]
#: level of the battery, over its three tests together; and the share of false discoveries allowed
BATTERY_LEVEL, FALSE_DISCOVERIES = 0.01, 0.01
BINS_PER_DECADE, MAX_BIN = 20, 2000
BLOCK = 256


def _sums_before(lengths: Column) -> Column:
    """For each element the sum of those before it, block by block so that long arrays stay cheap."""
    empty = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("sum"))

    def step(state, x):
        return F.struct(F.concat(state["out"], F.array(state["sum"])).alias("out"), (state["sum"] + x).alias("sum"))

    before = lambda xs: F.aggregate(xs, empty, step, lambda s: s["out"])
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))
    offsets = before(F.transform(blocks, total))
    joined = F.flatten(F.zip_with(blocks, offsets, lambda block, o: F.transform(before(block), lambda x: x + o)))
    return F.when(F.size(lengths) > 0, joined).otherwise(F.array().cast("array<bigint>"))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """(start, end, part) of every match: what splitting leaves between matches gives the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    sizes = F.zip_with(F.split(text, pattern, -1), found, lambda gap, m: F.struct(F.length(gap).cast("bigint").alias("gap"), F.coalesce(F.length(m), F.lit(0)).cast("bigint").alias("own")))
    sizes = F.slice(sizes, 1, F.size(found))
    starts = F.zip_with(_sums_before(F.transform(sizes, lambda s: s["gap"] + s["own"])), sizes, lambda at, s: F.struct((at + s["gap"]).alias("start"), (at + s["gap"] + s["own"]).alias("end")))
    spans = F.zip_with(starts, parts, lambda s, p: F.struct(s["start"].alias("start"), s["end"].alias("end"), p.alias("part")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,part:string>>")
    return F.when(text.rlike(pattern), spans).otherwise(none)


def _upper_normal(z: Column) -> Column:
    """P(Z > z), by a rational approximation of the error function."""
    x = F.abs(z) / 2**0.5
    t = F.lit(1.0) / (F.lit(1.0) + x * 0.3275911)
    poly = ((((t * 1.061405429 - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t
    tail = poly * F.exp(-x * x) / 2
    return F.when(z >= 0, tail).otherwise(F.lit(1.0) - tail)


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), _upper_normal(F.abs(z)) * 2)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def _tested(token: Column, name: str) -> Column:
    """(p of the battery, p against ordinary text) of a token in one encoding; each step goes over the token once."""
    token = F.translate(token, "-_", "+/")
    token = F.lower(token) if name in ("hex", "single_case") else token
    half = len(ENCODINGS[name][1]) // 2
    low = F.translate(token, ENCODINGS[name][1], "0" * half + "1" * (len(ENCODINGS[name][1]) - half))
    return _let(F.struct(token.alias("token"), low.alias("low"), F.split(token, "").alias("chars")), lambda t: _counted(t, name))


def _counted(t: Column, name: str) -> Column:
    count = lambda c: (F.length(t["token"]) - F.length(F.replace(t["token"], c, F.lit("")))).cast("double")
    values = F.transform(t["chars"], lambda c: F.instr(F.lit(ENCODINGS[name][1]), c).cast("double"))
    counts = F.struct(
        F.length(t["token"]).cast("double").alias("n"),
        _total(F.transform(F.array_distinct(t["chars"]), lambda c: F.pow(count(c), F.lit(2.0)))).alias("squares"),
        F.length(F.replace(t["low"], F.lit("0"), F.lit(""))).cast("double").alias("n1"),
        F.regexp_count(t["low"], F.lit("0+|1+")).cast("double").alias("runs"),
        values.alias("values"),
    )
    return _let(counts, lambda c: _let(_moments(c), lambda m: _p_values(c, m, name)))


def _moments(c: Column) -> Column:
    v = c["values"]
    return F.struct(
        _total(v).alias("sum"), _total(F.transform(v, lambda x: x * x)).alias("squares"), F.get(v, F.lit(0)).alias("first"), F.get(v, F.size(v) - 1).alias("last"),
        _total(F.zip_with(v, F.slice(v, 2, F.size(v)), lambda x, y: x * F.coalesce(y, F.lit(0.0)))).alias("lagged"),
    )


def _p_values(c: Column, m: Column, name: str) -> Column:
    _, alphabet, same = ENCODINGS[name]
    k, n = float(len(alphabet)), c["n"]
    chi = c["squares"] * k / n - n
    # random: the cube root of chi-squared per degree of freedom is close to normal
    df, spread = k - 1, 2 / (9 * (k - 1))
    p_chi = _upper_normal((F.pow(chi / df, F.lit(1 / 3)) - (1 - spread)) / spread**0.5)
    expected = c["n1"] * (n - c["n1"]) * 2 / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    p_runs = F.when(variance > 0, _two_sided((c["runs"] - expected) / F.sqrt(variance))).otherwise(F.lit(0.0))
    mean = m["sum"] / n
    power = m["squares"] - n * mean * mean
    lagged = m["lagged"] - mean * (m["sum"] * 2 - m["first"] - m["last"]) + (n - 1) * mean * mean
    p_serial = F.when(power > 0, _two_sided(lagged / power * F.sqrt(n))).otherwise(F.lit(0.0))
    p_random = F.least(F.lit(1.0), F.least(p_chi, p_runs, p_serial) * 3)
    # ordinary text: two characters agree with chance ``same``
    ordinary = (n - 1) * (k * same) + k - n
    spread_ordinary = F.sqrt(n * (4 * (k * same - 1)) + 2 * (k - 1))
    return F.struct(p_random.alias("random"), (F.lit(1.0) - _upper_normal((chi - ordinary) / spread_ordinary)).alias("ordinary"))


def _ranked(kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"))


def _of_kind(kind: str) -> Column:
    return F.filter("base", lambda s: s["kind"] == kind)


def scanned(documents: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Per row: ``keep``, the pattern spans and the tested candidates."""
    text = F.col("_text")
    source = documents.select(row_of(keep).alias("kept"), whole(text_col).alias("_text"))
    found = source.select(
        "kept",
        F.filter(_matches(text, ASSIGN, 2), lambda s: F.length(s["part"]) >= ASSIGN_MIN).alias("assign"),
        _matches(text, ACCESS).alias("access"), _matches(text, HEX).alias("hex"), _matches(text, CANDIDATE).alias("candidates"),
    )
    base = F.array_sort(F.concat(*[
        F.transform(kind, _ranked(kind)) for kind in KINDS[:3]
    ]))

    def tested(c):
        token = F.regexp_replace(c["part"], "=+$", "")
        encoding, tests = F.lit(None).cast("string"), F.lit(None).cast("struct<random:double,ordinary:double>")
        for name, (pattern, _, _) in reversed(ENCODINGS.items()):
            fits = F.translate(token, "-_", "+/").rlike(pattern)
            encoding, tests = F.when(fits, name).otherwise(encoding), F.when(fits, _tested(token, name)).otherwise(tests)
        stratum = F.lit(0)
        for at in LENGTHS[1:]:
            stratum = stratum + (F.length(token) >= at).cast("int")
        least = lambda p: F.least(F.lit(MAX_BIN), F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BINS_PER_DECADE)).cast("int")
        rank = _let(tests, lambda p: F.when(p["random"] >= BATTERY_LEVEL, least(p["ordinary"])).otherwise(0))
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), F.concat_ws(":", encoding, stratum).alias("stratum"), rank.alias("bin"))

    candidates = F.transform(F.filter("candidates", lambda c: ~c["part"].rlike("^[0-9]+$")), tested)
    return found.select("kept", base.alias("base"), candidates.alias("candidates"))


def thresholds(scan: DataFrame, level: float = FALSE_DISCOVERIES) -> DataFrame:
    """(stratum, least bin that counts): the Benjamini-Hochberg step on a histogram, with the upper end of each bin as its p-value."""
    counts = scan.select(F.explode("candidates").alias("c")).groupBy("c.stratum", "c.bin").count()
    totals = counts.groupBy("stratum").agg(F.sum("count").alias("total"), F.collect_list(F.struct("bin", "count")).alias("bins"))
    # a stratum has at most MAX_BIN + 1 bins
    steps = totals.select("stratum", "total", F.explode("bins").alias("b"), "bins").select(
        "stratum", "b.bin", "total", F.aggregate(F.filter("bins", lambda x: x["bin"] >= F.col("b.bin")), F.lit(0).cast("bigint"), lambda a, x: a + x["count"]).alias("above")
    )
    passing = F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE) * F.col("total") <= F.col("above") * level
    return steps.where(passing & (F.col("bin") > 0)).groupBy("stratum").agg(F.min("bin").alias("least"))


def _spans(documents: DataFrame, keep: list[str], text_col: str, level: float = FALSE_DISCOVERIES) -> DataFrame:
    """(kept, base, found) for each row: the named columns as one struct, spans of the patterns, all spans."""
    stored = staged(scanned(documents, keep, text_col), "secret-scan")
    # one row per encoding and length stratum
    limits = {r["stratum"]: r["least"] for r in thresholds(stored, level).collect()}

    def enough(c):
        least = F.lit(None).cast("int")
        for stratum, bin_ in limits.items():
            least = F.when(c["stratum"] == stratum, bin_).otherwise(least)
        return F.coalesce(c["bin"] >= least, F.lit(False))

    covered = lambda c: F.exists("base", lambda b: (b["start"] <= c["start"]) & (c["end"] <= b["end"]))
    more = F.transform(F.filter("candidates", lambda c: enough(c) & ~covered(c)), _ranked("random"))
    return stored.select("kept", "base", F.array_sort(F.concat("base", more)).alias("found"))


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: float = FALSE_DISCOVERIES) -> DataFrame:
    """Per row: id and ``found``, the sorted spans (start, rank, kind, end) of patterns and battery."""
    return _spans(documents, [id_col], text_col, level).select(F.col("kept").getField(id_col).alias(id_col), "base", "found")


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts by kind, digest of the pattern spans, all spans as text."""
    found = scan(documents, id_col, text_col)
    counts = [F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select(id_col, *counts, hex_digest(_listed("base")).alias("base_sha256"), _listed("found").alias("spans"))


def redacted(documents: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by ``mark``. Each row carries its own spans, so ids may repeat or be missing."""
    names = documents.columns
    whole_text = F.col("kept").getField(text_col)
    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit("").alias("text"))

    def add(state, s):
        gap = F.substring(whole_text, (state["end"] + 1).cast("int"), F.greatest(s["start"] - state["end"], F.lit(0)).cast("int"))
        text = F.when(s["end"] <= state["end"], state["text"]).otherwise(F.concat(state["text"], gap, F.lit(mark)))
        return F.struct(F.greatest(s["end"], state["end"]).alias("end"), text.alias("text"))

    rest = lambda s: F.concat(s["text"], F.substring(whole_text, (s["end"] + 1).cast("int"), F.length(whole_text)))
    text = F.when(F.size("found") > 0, F.aggregate("found", zero, add, rest)).otherwise(whole_text)
    found = _spans(documents, names, text_col)
    return found.select(*[(text if c == text_col else F.col("kept").getField(c)).alias(c) for c in names])
