import random
import re
from collections import Counter, defaultdict
from math import log, sqrt

import pytest
from pyspark.sql import functions as F

from searchloom.llm import url_templates as U

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOWER), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def rule_of(host, path):
    fits = [(len(r), r, v) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


def typed(segment):
    for pattern, name in U.TYPED:
        if re.search(pattern, segment):
            return re.sub(pattern, name, segment, count=1)
    return segment


def shape_of(path):
    segments = path.split("/")
    return [typed(s) for s in segments[: U.MAX_DEPTH]] + ["**"] * (len(segments) > U.MAX_DEPTH)


def brute(urls, given=None):
    rows = [(*parse(u), *rule_of(*parse(u))) for u in urls]
    bad_of = [{"block": 1, "allow": 0}.get(v, (given or {}).get(i)) for i, (_, _, _, v) in enumerate(rows)]
    labelled = [b for b in bad_of if b is not None]
    base = sum(labelled) / len(labelled) if labelled else 0.0
    shapes = [shape_of(path) for _, path, *_ in rows]
    prefix = [()] * len(rows)
    for d in range(U.MAX_DEPTH + 1):
        nodes = defaultdict(lambda: defaultdict(list))
        for r, (host, *_) in enumerate(rows):
            if d < len(shapes[r]):
                nodes[host, prefix[r]][shapes[r][d]].append(bad_of[r])
        step = {(node, child): name for node, children in nodes.items() for child, name in steps(children).items()}
        prefix = [p + (step[(rows[r][0], p), shapes[r][d]],) if d < len(shapes[r]) else p for r, p in enumerate(prefix)]
    template = [(row[0], "/".join(p)) for row, p in zip(rows, prefix)]
    sums = defaultdict(lambda: [0, 0])
    for t, b in zip(template, bad_of):
        sums[t][0] += b or 0
        sums[t][1] += b is not None
    out = []
    for i, ((host, path, rule, verdict), t) in enumerate(zip(rows, template)):
        bad, n = sums[t]
        purity = (bad + base * U.PRIOR_WEIGHT) / (n + U.PRIOR_WEIGHT)
        method = "block" if purity >= U.REJECT and lower(bad, n) >= U.LEAST else "allow"
        out.append((i, host, path, rule, verdict or method, t[1], round(purity, 6)))
    return out


def lower(bad, n, z=1.645):
    if not n:
        return 0.0
    p = bad / n
    return (p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def steps(children):
    typed_ = {c for c in children if c.startswith(("{", "**"))}
    known = {c: [b for b in bs if b is not None] for c, bs in children.items()}
    tested = [c for c in children if c not in typed_ and len(known[c]) >= U.MIN_LABELS]
    sections = sum(len(bs) >= U.MIN_CHILD for c, bs in children.items() if c not in typed_)
    alike, out = [], {}
    for c in tested:
        rest = [b for o in tested if o != c for b in known[o]]
        p = (sum(known[c]) + sum(rest)) / (len(known[c]) + len(rest))
        far = bool(rest) and abs(sum(known[c]) / len(known[c]) - sum(rest) / len(rest)) > sqrt(p * (1 - p) * (1 / len(known[c]) + 1 / len(rest))) * (sqrt(2 * log(len(tested))) + U.APART_Z)
        out[c] = c
        if not far:
            alike.append(c)
    if len(alike) > 1:
        out |= {c: f"{min(alike)}|+{len(alike) - 1}" for c in alike}
    for c, bs in children.items():
        out.setdefault(c, "*" if c not in typed_ and (len(bs) < U.MIN_CHILD or sections > U.SECTIONS) else c)
    return out


def urls():
    rng = random.Random(8)
    out = [None, "", "no scheme", "a://", "HTTP://WWW.Example.COM/en/x?y=/z", "http://example.com", "http://example.com?q", "x://b://c/d", "http://É.net/es/1", "http://n.net/es", "http://h.org/" + "a/" * 30, "http://q.org/\n/x"]
    for _ in range(500):
        host = rng.choice(["m.example.com", "www.example.com", "a.net", "b.net", "spam.org", "spam.org", "spam.org"])
        lang = rng.choice(["en", "es", "fr", "de"])
        tail = rng.choice([str(rng.randrange(999)), f"{rng.randrange(99)}.html", f"post-{rng.randrange(400)}", "about", "2024-01-02/x", "deadbeef01", "", "AbCdEf012345xyz"])
        out.append(f"https://{host}/{lang}/{tail}{rng.choice(['', '#t', '?a=/b'])}")
    return out


@pytest.mark.parametrize("with_labels", [False, True])
def test_matches_brute_force(spark, with_labels):
    all_urls = urls()
    given = {i: int("/es/" in u or i % 9 == 0) for i, u in enumerate(all_urls) if u and "spam.org" in u} if with_labels else None
    labels = spark.createDataFrame(list(given.items()), "page_id long, bad int") if given else None
    pages = spark.createDataFrame(list(enumerate(all_urls)), "page_id long, url string").withColumn("host", F.lit(1)).withColumn("n", F.lit(2))
    got = sorted(tuple(r) for r in U.judged(pages, RULES, labels=labels).collect())
    want = brute(all_urls, given)
    assert [g[:6] for g in got] == [w[:6] for w in want]
    assert [g[6] for g in got] == pytest.approx([w[6] for w in want], abs=2e-6)
    if with_labels:
        assert Counter(g[4] for g in got if g[1] == "spam.org" and "/es/" in g[2]).most_common(1)[0][0] == "block"


def test_empty_tables_and_repeats(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (None, None)], "page_id long, url string")
    assert U.judged(pages, RULES).count() == 3
    assert U.judged(pages.limit(0), RULES).collect() == []


def verdicts(spark, urls_, given=None):
    pages = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    labels = spark.createDataFrame(list(given.items()), "page_id long, bad int") if given else None
    return {r.page_id: (r.verdict, r.template) for r in U.judged(pages, RULES, labels=labels).collect()}


def test_labels_do_not_speak_for_other_sections(spark):
    urls_ = [f"http://a.net/es/{c}" for c in "abcdef"] + [f"http://a.net/en/p{i}x" for i in range(40)] + [f"http://b.net/{s}/x" for s in ("es", "fr") for _ in range(20)]
    got = verdicts(spark, urls_)
    assert [got[i][0] for i in range(6)] == ["block"] * 6 and {got[i] for i in range(6, 46)} == {("allow", "/en/*")}
    assert got[50][1] == "/es|+1/x"


def test_a_bad_section_among_many_is_rejected(spark):
    urls_ = [f"http://h.org/s{k}/page{i}of" for k in range(30) for i in range(60)]
    got = verdicts(spark, urls_, {i: 1 for i in range(7 * 60, 7 * 60 + 30)})
    assert {got[i][0] for i in range(420, 480)} == {"block"} and {got[i] for i in range(1800) if not 420 <= i < 480} == {("allow", "/*/*")}
    # so it is beside sections with labels, a share of a hundredth, and next to many alike
    many = [f"http://h.org/s{k}/page{i}of" for k in range(100) for i in range(60)]
    given = {k * 60 + i: int(k == 7) for k in range(100) for i in range(30)}
    got = verdicts(spark, many, given)
    assert {got[i] for i in range(420, 480)} == {("block", "/s7/*")} and {v for i, (v, _) in got.items() if not 420 <= i < 480} == {"allow"}


def test_pools_below_wildcards(spark):
    urls_ = [f"http://h.org/u/name{k}a/{what}" for k in range(200) for what in ("photos", "spam")]
    got = verdicts(spark, urls_, {2 * k: 0 for k in range(200)} | {2 * k + 1: 1 for k in range(150)})
    assert {got[2 * k] for k in range(200)} == {("allow", "/u/*/photos")} and {got[2 * k + 1] for k in range(200)} == {("block", "/u/*/spam")}


def test_few_labels_reject_nothing(spark):
    urls_ = [f"http://h.org/x/p{i}a" for i in range(50)]
    assert {v for v, _ in verdicts(spark, urls_, {0: 1, 1: 1, 2: 1}).values()} == {"allow"}
    assert {v for v, _ in verdicts(spark, urls_, {i: 1 for i in range(9)}).values()} == {"block"}
