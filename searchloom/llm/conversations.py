"""Conversation structure repair: cheapest edits to a well-formed order of roles, by parallel Viterbi.

A well-formed conversation is empty, or an optional system row and then user and assistant rows in
turn, ending with an assistant row. Rows may be kept (0), given another role (3) or deleted (4);
empty user and assistant rows may be inserted anywhere (3). Blank rows and repeats of an earlier row
must be deleted; a row that stays although it is cut off adds 3. Of the cheapest lists of edits the
one whose initials are least in ASCII counts.

1. Rows become narrow marks (keys and bits, 128 bits for a text); equal rows of a turn are one mark
   with a count. Marks are dealt out in ranges of conversation and turn, so a long conversation
   spans many tasks; what one range holds of one conversation is a chunk.
2. The cost to go from each of four states, backwards over the rows, is a vector of four numbers.
   A chunk that ends its conversation starts from the true one; all others start at once from a
   speculative one.
3. Fix-up passes rerun chunks whose speculation was wrong from the vector their successor has found,
   back to the row where the new vector differs from the old one by a constant only: before that
   row the old ones hold, as only differences decide. Passes end when no chunk starts from a
   vector that is not parallel to its successor's. Vectors are kept less their least entry, so
   parallel ones are equal.
4. Stitched like that the vectors drive the tracing: each chunk maps every state it may be entered
   with to the state it is left with, these maps are chained along a conversation, and each chunk
   traces its edits from the state it is really entered with, at each step by the first letter
   that costs no more than the vector says.
5. Kept rows are never repeats, so their texts are found by conversation, role and text.

Most conversations lie in one chunk and are done without a fix-up. What is gathered for a
conversation is one small row for each chunk, and its audit, which is one string by definition.

Defined cases: null roles and texts are one space. Null turns come first. A null conversation id is
a conversation of its own. Rows of one turn follow each other by role, then by 128 bits of their
text. A very long text is one row; a very long conversation many chunks. Empty tables give no
rows. Other columns are not read, whatever they are called.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from searchloom.llm.texts import named
from searchloom.sinks.tables import staged

START, SYSTEM, USER, ASSISTANT = range(4)
OTHER = 4
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: bits of a mark beside the three of its role
BLANK, CUT, REPEATED = 8, 16, 32
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3

Vector = tuple[int, int, int, int]
#: cost to go after the last row: what must still be inserted
END: Vector = (0, 2 * INSERT, INSERT, 0)


# -- costs and edits of one row; tables over few bits, states and differences, so each is worked out once


def _inserted(state: int) -> int:
    """The state after an inserted row, and after one that was given a fitting role."""
    return ASSISTANT if state == USER else USER


def _choices(bits: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one row."""
    yield "D", DELETE, state
    if not bits & (BLANK | REPEATED):
        more = CUT_OFF if bits & CUT else 0
        role = bits & 7
        if role in (USER, ASSISTANT) and role == _inserted(state) or role == SYSTEM and state == START:
            yield "K", more, role
        yield "R", REROLE + more, _inserted(state)


class Costs:
    """Vectors before a row from those after it, and the edits that they choose."""

    def __init__(self):
        self._before: dict[tuple[int, Vector], Vector] = {}
        self._edits: dict[tuple[int, Vector, int], tuple[tuple[tuple[str, int], ...], int, int]] = {}

    def _exact(self, bits: int, after: Vector) -> Vector:
        v = [min(cost + after[to] for _, cost, to in _choices(bits, state)) for state in range(4)]
        user, assistant = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
        return min(v[START], INSERT + user), min(v[SYSTEM], INSERT + user), user, assistant

    def before(self, bits: int, after: Vector) -> Vector:
        """The vector before a row, less its least entry."""
        key = bits, after
        if key not in self._before:
            v = self._exact(bits, after)
            self._before[key] = tuple(c - min(v) for c in v)
        return self._before[key]

    def edits(self, bits: int, after: Vector, state: int) -> tuple[tuple[tuple[str, int], ...], int, int]:
        """(letters with the state each leads to, state after the row, cost): inserts before a row, then its own edit."""
        key = bits, after, state
        if key not in self._edits:
            before, out, spent = self._exact(bits, after), [], 0
            while True:
                choices = {letter: (cost, to) for letter, cost, to in _choices(bits, state) if cost + after[to] == before[state]}
                if INSERT + before[_inserted(state)] == before[state]:
                    choices["I"] = INSERT, _inserted(state)
                letter = min(choices)
                cost, state = choices[letter]
                out.append((letter, state))
                spent += cost
                if letter != "I":
                    break
            self._edits[key] = tuple(out), state, spent
        return self._edits[key]


def _vectors(costs: Costs, bits: list[int], tail: Vector, known: list[Vector] | None = None) -> list[Vector]:
    """Vectors before each row and after the last, backwards from ``tail``; stops at the first row from where known ones hold."""
    out = list(known) if known else [END] * (len(bits) + 1)
    out[-1] = tail
    for i in range(len(bits) - 1, -1, -1):
        v = costs.before(bits[i], out[i + 1])
        if known and v == known[i]:
            break
        out[i] = v
    return out


def _packed(vectors: list[Vector]) -> bytes:
    return bytes(c for v in vectors for c in v)


def _unpacked(data: bytes) -> list[Vector]:
    return [tuple(data[i : i + 4]) for i in range(0, len(data), 4)]


# -- marks


def _bits(role: Column, text: Column) -> Column:
    initial = F.substring(role, 1, 1)
    kind = F.lit(OTHER)
    for letter, state in INITIALS.items():
        kind = F.when(initial == letter, state).otherwise(kind)
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    cut = text.rlike(r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z")
    return (kind + F.when(blank, BLANK).otherwise(0) + F.when(cut, CUT).otherwise(0)).cast("int")


def _rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    filled = lambda c: F.coalesce(named(c).cast("string"), F.lit(" "))
    out = rows.select(named(conv_col).alias("conv"), named(turn_col).alias("turn"), filled(role_col).alias("role"), filled(text_col).alias("text"))
    return out.select("conv", "turn", "role", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, nulls included; the keys of the right side are not kept."""
    right = right.select(*[F.col(c).alias(f"_{c}") if c in on else F.col(c) for c in right.columns])
    same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on])
    return left.join(right, same, how).drop(*[f"_{c}" for c in on])


def marks(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, h1, h2, bits, copies, part): distinct rows with the range they lie in."""
    key = ["conv", "role", "h1", "h2"]
    narrow = rows.select("conv", "turn", "role", "h1", "h2", _bits(F.col("role"), F.col("text")).alias("bits"))
    narrow = staged(narrow.groupBy("conv", "turn", "role", "h1", "h2", "bits").agg(F.count("*").alias("copies")), "talk-marks")
    # structs, as the least of them may hold a null turn
    again = narrow.groupBy(*key).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    later = F.col("first").isNotNull() & (F.struct("turn") > F.col("first"))
    seen = _joined(narrow, again, key, "left").withColumn("bits", F.col("bits") + F.when(later, REPEATED).otherwise(0)).select(*narrow.columns)
    return staged(seen.repartitionByRange("conv", "turn", "role", "h1", "h2").withColumn("part", F.spark_partition_id()), "talk-ordered")


_CHUNK = ["conv", "part", "items", "following", "before"]


def _chunks(found: DataFrame) -> DataFrame:
    """(conv, part, items, following, before): the rows of each chunk in order, the next chunk, and the last role of the one before."""
    item = F.struct("turn", "role", "h1", "h2", "bits", "copies")
    chunks = found.groupBy("conv", "part").agg(F.sort_array(F.collect_list(item)).alias("items"))
    ends = found.groupBy("conv", "part").agg(F.max(F.struct("turn", "role", "h1", "h2", "bits"))["bits"].alias("end"))
    along = Window.partitionBy("conv").orderBy("part")
    ends = ends.select("conv", "part", F.lead("part").over(along).alias("following"), F.lag("end").over(along).alias("before"))
    ends = ends.where("following is not null or before is not null")
    return _joined(chunks, ends, ["conv", "part"], "left").select(*_CHUNK)


def _mapped(frame: DataFrame, make, names: list[str], more: str) -> DataFrame:
    """``mapInArrow`` row by row: the named columns go on, the rest follows from ``make(row)``."""
    new = [f.strip().split(" ")[0] for f in more.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make()
        for batch in batches:
            rows = [made(r) for r in batch.to_pylist()]
            columns = [batch.column(n) for n in names]
            for k, n in enumerate(new):
                columns.append(pa.array([r[k] for r in rows], kinds[n]))
            yield pa.RecordBatch.from_arrays(columns, names + new)

    schema = ", ".join([f"{n} {frame.schema[n].dataType.simpleString()}" for n in names] + [more])
    empty = frame.sparkSession.createDataFrame([], more).schema
    kinds = {f.name: to_arrow_type(f.dataType) for f in empty.fields}
    return frame.mapInArrow(run, schema)


def _first_pass():
    costs = Costs()
    return lambda r: (_packed(_vectors(costs, [i["bits"] for i in r["items"]], END)),)


def _fix_up():
    costs = Costs()
    return lambda r: (_packed(_vectors(costs, [i["bits"] for i in r["items"]], tuple(r["head"]), _unpacked(r["path"]))),)


def _solved(chunks: DataFrame) -> DataFrame:
    """Chunks with the vectors (``path``) before each of their rows and after the last, true but for constants."""
    paths = staged(_mapped(chunks, _first_pass, _CHUNK, "path binary"), "talk-paths")
    done = paths.where("following is null and before is null")
    several = paths.where("following is not null or before is not null")
    if several.isEmpty():
        return done
    while True:
        several = staged(several, "talk-several")
        heads = several.select(F.col("conv").alias("c"), F.col("part").alias("p"), F.substring("path", 1, 4).alias("head"))
        ahead = several.join(heads, several["conv"].eqNullSafe(heads["c"]) & (several["following"] == heads["p"]), "left")
        wrong = F.col("head").isNotNull() & (F.col("head") != F.expr("substring(path, length(path) - 3, 4)"))
        ahead = staged(ahead.select(*_CHUNK, "path", F.when(wrong, F.col("head")).alias("head")), "talk-ahead")
        stale = ahead.where("head is not null")
        if stale.isEmpty():
            return done.unionByName(several)
        fixed = _mapped(stale, _fix_up, _CHUNK, "new binary").withColumnRenamed("new", "path")
        several = ahead.where("head is null").drop("head").unionByName(fixed)


def _walk(costs: Costs, bits: list[int], path: list[Vector], state: int):
    """(edits, state) row by row from a state."""
    for i, b in enumerate(bits):
        letters, state, cost = costs.edits(b, path[i + 1], state)
        yield letters, state, cost


def _exits():
    costs = Costs()

    def make(r):
        bits, path, out = [i["bits"] for i in r["items"]], _unpacked(r["path"]), []
        for state in range(4):
            for _, state, _ in _walk(costs, bits, path, state):
                pass
            out.append(state)
        return (out,)

    return make


def _traced():
    costs = Costs()

    def make(r):
        bits, path = [i["bits"] for i in r["items"]], _unpacked(r["path"])
        state, audit, cost, kept = r["entry"], [], 0, []
        for item, (letters, state, spent) in zip(r["items"], _walk(costs, bits, path, state)):
            cost += spent + DELETE * (item["copies"] - 1)
            for letter, to in letters:
                audit.append(letter)
                if letter == "I":
                    kept.append(("I", ROLES[to], None, None, None))
                elif letter != "D":
                    kept.append((letter, item["role"] if letter == "K" else ROLES[to], item["role"], item["h1"], item["h2"]))
            # further copies are repeats: deleting them changes no difference between states, and D is the least letter
            audit.append("D" * (item["copies"] - 1))
        if r["following"] is None:
            while state not in (START, ASSISTANT):
                state = _inserted(state)
                audit.append("I")
                cost += INSERT
                kept.append(("I", ROLES[state], None, None, None))
        kinds = [b & 7 for b in bits]
        pairs = list(zip(kinds, kinds[1:])) + ([(r["before"] & 7, kinds[0])] if r["before"] is not None else [])
        illegal = sum(p not in LEGAL for p in pairs) + sum(i["copies"] - 1 for i in r["items"])
        edits = [dict(zip(("edit", "role", "was", "h1", "h2"), k)) for k in kept]
        return "".join(audit), cost, illegal, edits

    return make


def plans(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv, part, start, audit, cost, illegal, edits): what each chunk does; ``start`` counts the repaired rows before it."""
    solved = _solved(_chunks(found))
    single, several = solved.where("following is null and before is null"), solved.where("following is not null or before is not null")
    traced = single.withColumn("entry", F.lit(START))
    if not several.isEmpty():
        exits = staged(_mapped(several, _exits, [*_CHUNK, "path"], "exits array<int>"), "talk-exits")
        steps = exits.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "exits"))).alias("steps"))
        states = F.aggregate("steps", F.array(F.lit(START)), lambda have, s: F.concat(have, F.array(F.get(s["exits"], F.element_at(have, -1)))))
        entries = steps.select("conv", F.explode(F.arrays_zip(F.col("steps.part").alias("part"), F.slice(states, 1, F.size("steps")).alias("entry"))).alias("at"))
        entries = entries.select("conv", "at.part", "at.entry")
        traced = traced.unionByName(_joined(exits.drop("exits"), entries, ["conv", "part"]))
    edits = "edits array<struct<edit:string,role:string,was:string,h1:bigint,h2:bigint>>"
    out = staged(_mapped(traced, _traced, ["conv", "part"], f"audit string, cost bigint, illegal bigint, {edits}"), "talk-plans")
    sizes = out.select("conv", "part", F.size("edits").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("conv", "part", before.alias("start")).where("start > 0")
    return _joined(out, starts, ["conv", "part"], "left").fillna(0, ["start"])


def _written(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv, no, edit, role, text): the repaired rows in order, counted from 0."""
    edits = planned.select("conv", "start", F.posexplode("edits").alias("at", "e"))
    edits = edits.select("conv", (F.col("start") + F.col("at")).alias("no"), "e.edit", F.col("e.role").alias("role"), "e.was", "e.h1", "e.h2")
    inserted = edits.where("edit = 'I'").select("conv", "no", "edit", "role", F.lit("").alias("text"))
    kept = edits.where("edit != 'I'")
    texts = rows.groupBy("conv", F.col("role").alias("was"), "h1", "h2").agg(F.max("text").alias("text"))
    found = _joined(kept, texts, ["conv", "was", "h1", "h2"])
    return found.select("conv", "no", "edit", "role", "text").unionByName(inserted)


def repaired(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations: conversation, ``no`` (from 0), ``edit`` (K, R or I), role and text."""
    own = _rows(rows, conv_col, turn_col, role_col, text_col)
    out = _written(own, plans(own, marks(own)))
    return out.select(F.col("conv").alias(conv_col), "no", "edit", F.col("role").alias(role_col), F.col("text").alias(text_col))


def _digests(written: DataFrame) -> DataFrame:
    """(conv, digest): SHA-256 of ``role:text`` of the rows of a conversation, newline-joined; a task holds one batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, conv, digest = False, None, None
        for batch in batches:
            done = []
            for c, role, text in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if open_ and c.as_py() == conv:
                    digest.update(b"\n")
                else:
                    if open_:
                        done.append((conv, digest.hexdigest()))
                    open_, conv, digest = True, c.as_py(), hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.schema.field(0).type), pa.array([d[1] for d in done], pa.string())], ["conv", "digest"])
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array([conv], batch.schema.field(0).type), pa.array([digest.hexdigest()], pa.string())], ["conv", "digest"])

    kind = written.schema["conv"].dataType.simpleString()
    ordered = written.repartition("conv").sortWithinPartitions("conv", "no").select("conv", "role", "text")
    return ordered.mapInArrow(run, f"conv {kind}, digest string")


def report(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: ``gaps``, first faults (``blank``, ``duplicate``, ``truncated``), ``illegal``, ``cost``, ``audit``, ``repaired_sha256``."""
    own = _rows(rows, conv_col, turn_col, role_col, text_col)
    found = marks(own)
    planned = staged(plans(own, found), "talk-planned")
    blank = F.col("bits").bitwiseAND(BLANK) != 0
    first = F.col("bits").bitwiseAND(REPEATED) == 0
    counts = found.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(blank, F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(blank, 0).when(first, F.col("copies") - 1).otherwise(F.col("copies"))).alias("duplicate"),
        F.sum(F.when(~blank & first & (F.col("bits").bitwiseAND(CUT) != 0), 1).otherwise(0)).alias("truncated"),
    )
    whole = planned.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(F.sort_array(F.collect_list(F.struct("part", "audit")))["audit"], "").alias("audit")
    )
    digests = _digests(_written(own, planned))
    out = _joined(_joined(counts, whole, ["conv"]), digests, ["conv"], "left")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return out.select(F.col("conv").alias(conv_col), *names, F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows with faults by ``crc32("conv:turn") % 20``: 0 drops, 1 empties, 2 removes ends of sentences, 3 repeats, 4 makes it the user's."""
    filled = lambda c: F.coalesce(named(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(filled(conv_col), F.lit(":"), filled(turn_col)).cast("binary")) % 20
    out = rows.select(named(conv_col).alias("conv"), named(turn_col).alias("turn"), filled(role_col).alias("role"), filled(text_col).alias("text"), fault.alias("fault")).where("fault != 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    out = out.select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time"))
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), F.col("text").alias(text_col))
