import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
import xxhash
from pyspark.sql import functions as F

from searchloom.llm import conversations as CV
from searchloom.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def bits128(text):
    signed = lambda h: h - (h >> 63 << 64)
    plain = xxhash.xxh64(text.encode(), seed=42).intdigest()
    seed = xxhash.xxh64((1).to_bytes(4, "little"), seed=42).intdigest()
    return signed(plain), signed(xxhash.xxh64(text.encode(), seed=seed).intdigest())


def in_order(rows):
    """Rows of one conversation as (turn, role, text), nulls filled."""
    filled = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(filled, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), *bits128(r[2])))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]+", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, repaired rows) by trying every list of edits with up to three inserts in a row; results are kept by row and last role."""

    @lru_cache(None)
    def with_inserts(i, state, left):
        out = [step(i, state, left)]
        if left:
            for new in ("user", "assistant"):
                if follows(state, new[0]):
                    cost, audit, rest = with_inserts(i, new[0], left - 1)
                    out.append((cost + 3, "I" + audit, ((new, ""), *rest)))
        return min(out, key=lambda o: o[:2])

    def step(i, state, left):
        out = []
        if i == len(rows):
            return (0, "", ()) if state in ("", "a") else (10**9, "", ())
        _, role, text = rows[i]
        cost, audit, rest = with_inserts(i + 1, state, 3)
        out.append((cost + 4, "D" + audit, rest))
        if found[i] not in ("blank", "duplicate"):
            extra = 3 if found[i] == "truncated" else 0
            for letter, new, price in [("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)]:
                if follows(state, new[:1]):
                    cost, audit, rest = with_inserts(i + 1, new[:1], 3)
                    out.append((cost + price + extra, letter + audit, ((new, text), *rest)))
        return min(out, key=lambda o: o[:2])

    def follows(state, initial):
        return initial == "s" and state == "" or initial == "u" and state != "u" or initial == "a" and state == "u"

    return with_inserts(0, "", 3)


def brute(rows):
    """The report of rows (conv, turn, role, text)."""
    out = []
    for conv in {r[0] for r in rows}:
        own = in_order([r[1:] for r in rows if r[0] == conv])
        found = faults(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = cheapest(tuple(own), found)
        assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in kept))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, digest))
    return sorted(out, key=str)


def fixture(n=120, seed=1):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        size = rng.choice([1, 2, 3, 5, 8, 13])
        turns = [rng.randrange(20) if rng.random() < 0.9 else None for _ in range(size)]
        for t in turns:
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "aside"])
            text = rng.choice(["Yes.", "No!", "cut off", " \n\t", "", None, "Long ends. \n", "é?", f"own {rng.randrange(50)}.", "sentence. then"])
            rows.append((conv if conv else None, t, role, text))
    return rows


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_matches_brute_force(spark):
    rows = fixture()
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit("x")).withColumn("bits", F.lit(1)).withColumn("a.b", F.lit(2)).repartition(3)
    got = CV.report(frame)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert collected(got) == brute(rows)


@pytest.fixture
def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def long_rows(kind, n=260):
    rng = random.Random(n)
    if kind == "alternating":  # a slip in the middle: which side gives way is known at the ends only
        roles = ["user", "assistant"] * (n // 2)
        del roles[n // 2]
    elif kind == "one role":
        roles = ["assistant"] * n
    else:
        roles = [rng.choice(["system", "user", "assistant", "tool"]) for _ in range(n)]
    return [(7, t, r, f"row {t}." if rng.random() < 0.9 or kind != "mixed" else "again") for t, r in enumerate(roles)]


@pytest.mark.parametrize("kind", ["alternating", "one role", "mixed"])
def test_long_conversations_span_chunks(spark, many_parts, kind):
    rows = long_rows(kind) + fixture(10)
    own = CV._rows(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text")
    assert CV.marks(own).where("conv = 7").select("part").distinct().count() > 5
    rows = [r for r in rows if r[0] == 7 or r[0] is None] + [r for r in rows if r[0] not in (7, None)]
    assert collected(CV.report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_repeated_rows(spark):
    rows = [(1, 0, "user", "Same.")] * 120 + [(1, 1, "assistant", "Answer.")] * 3 + [(2, None, "user", "x")] * 2
    assert collected(CV.report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "user", "More."), (2, 0, "assistant", ""), (3, 5, "assistant", "long " * 50_000 + ".")]
    got = sorted(tuple(r) for r in CV.repaired(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [r[:4] for r in got] == [(1, 0, "K", "system"), (1, 1, "K", "user"), (1, 2, "R", "assistant"), (3, 0, "I", "user"), (3, 1, "K", "assistant")]
    assert got[-1][4] == rows[-1][3]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert CV.report(none).collect() == [] and CV.repaired(none).collect() == [] and CV.damaged(none).collect() == []


def test_query_damages_and_keeps_all_conversations(spark, tmp_path):
    rows = [r for r in fixture(150, seed=3)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    text = lambda v: " " if v is None else str(v)
    hurt, want = [], []
    for conv, turn, role, body in rows:
        fault = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        row = (conv, turn, "user" if fault == 4 else text(role), "" if fault == 1 else re.sub("[.!?]", "", text(body)) if fault == 2 else text(body))
        hurt += [row] * (0 if fault == 0 else 2 if fault == 3 else 1)
    want = brute(hurt)
    lost = {r[0] for r in rows} - {r[0] for r in hurt}
    assert lost
    want += [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in lost]
    assert collected(queries.op12_conversation_repair(spark, str(tmp_path))) == sorted(want, key=str)
