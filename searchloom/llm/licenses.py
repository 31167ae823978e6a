"""License scans: parts of a text against licence templates by Dice over word bigrams.

Templates and texts become lower-case words and their bigrams. Every window of a text's words, whatever
the line breaks are, is a match if its Dice with a template reaches the threshold. With ``a`` and ``b``
bigrams Dice is at most ``2 min(a, b) / (a + b)``, which bounds a window's size, and a window that begins
and ends with a bigram of the template scores no less than one with more around it; so only those
are scored, and only where the longest window from a place shares enough bigrams. Of matches with
words in common the one stays that has most shared bigrams less those of one side only.

Texts are read in Python within their partition. Templates are (name, text) pairs, several of one name being variants;
they come from ``license_texts`` or from a table, which is sent to every task and so may hold at most
``MAX_TEMPLATE_BYTES``. A notice of a few words has so few bigrams that only its exact words reach the threshold, so
its wordings are listed as variants; full texts may differ in places.

Defined cases: a null text is an empty one and holds no licence. Repeated rows and rows without id give one result each. Empty
tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.llm.license_texts import all_templates
from searchloom.llm.texts import named

THRESHOLD = 0.9
BATCH = 256
#: bytes of a table of templates
MAX_TEMPLATE_BYTES = 16 << 20
_WORD = re.compile(r"\w+")
_BREAK = re.compile(r"\n")


def bigrams(text: str) -> Counter:
    words = _WORD.findall(text.lower())
    return Counter(zip(words, words[1:]))


def dice(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


class Scanner:
    """Finds templates, (name, text) pairs or a dict of them, in texts. Templates of fewer than two words match nothing."""

    def __init__(self, templates: dict[str, str] | Iterable[tuple[str, str]], threshold: float = THRESHOLD):
        pairs = list(templates.items() if isinstance(templates, dict) else templates)
        self._names = [name for name, _ in pairs]
        self._grams = [bigrams(text) for _, text in pairs]
        self._owners: dict[tuple[str, str], list[int]] = {}
        for which, grams in enumerate(self._grams):
            for gram in grams:
                self._owners.setdefault(gram, []).append(which)
        self._threshold = threshold
        low, high = threshold / (2 - threshold), (2 - threshold) / threshold
        self._bounds = [(g.total() * low, g.total() * high) for g in self._grams]

    def _windows(self, which: int, grams: list[tuple[str, str]], at: list[int]) -> Iterator[tuple[int, int, int]]:
        """(first bigram, bigram after the last, shared bigrams) of all windows that match; ``at`` are the places of the template's bigrams."""
        template, (low, high) = self._grams[which], self._bounds[which]
        size, right, ahead, shared = template.total(), 0, Counter(), 0
        for left, start in enumerate(at):
            while right < len(at) and at[right] - start + 1 <= high:
                gram = grams[at[right]]
                ahead[gram] += 1
                shared += ahead[gram] <= template[gram]
                right += 1
            if shared >= low:
                seen, common = Counter(), 0
                for end in at[left:right]:
                    seen[grams[end]] += 1
                    common += seen[grams[end]] <= template[grams[end]]
                    if 2 * common / (end - start + 1 + size) >= self._threshold:
                        yield start, end + 1, common
            shared -= ahead[grams[start]] <= template[grams[start]]
            ahead[grams[start]] -= 1

    def scan(self, text: str) -> list[tuple[str, int, int, float]]:
        """(template, first line, line after the last, Dice), by place."""
        words = _WORD.findall(text.lower())
        grams, owners = list(zip(words, words[1:])), self._owners
        places: dict[int, list[int]] = {}
        for n, gram in enumerate(grams):
            if gram in owners:
                for which in owners[gram]:
                    places.setdefault(which, []).append(n)
        found = []
        for which, at in places.items():
            size = self._grams[which].total()
            if len(at) >= self._bounds[which][0]:
                found += [(3 * k - (b - a) - size, 2 * k / (b - a + size), self._names[which], a, b) for a, b, k in self._windows(which, grams, at)]
        if not found:
            return []
        best, taken = [], bytearray(len(words))
        for _, score, name, a, b in sorted(found, key=lambda x: (-x[0], -x[1], x[3], x[2])):
            # bigrams a to b - 1 are words a to b
            if not any(taken[a : b + 1]):
                taken[a : b + 1] = b"\1" * (b + 1 - a)
                best.append((a, b, name, score))
        line_of = [n for n, line in enumerate(_BREAK.split(text)) for _ in _WORD.findall(line.lower())]
        return [(name, line_of[a], line_of[b] + 1, score) for a, b, name, score in sorted(best)]


def template_table(table: DataFrame, name_col: str = "name", text_col: str = "text") -> list[tuple[str, str]]:
    """Templates of a table, rows without name or text left out; refuses more than ``MAX_TEMPLATE_BYTES``."""
    rows = table.select(named(name_col).cast("string").alias("name"), named(text_col).alias("text")).where("name IS NOT NULL AND text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("name") + F.octet_length("text"))).first()[0] or 0
    if size > MAX_TEMPLATE_BYTES:
        raise ValueError(f"templates of {size} bytes are too many to send to every task")
    return sorted((r["name"], r["text"]) for r in rows.distinct().collect())


def scan(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    templates: DataFrame | dict[str, str] | Iterable[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: id, ``n_found``, ``licenses`` (names, sorted, each once, comma-joined), ``best_dice`` (4 decimals), ``parts`` (name:first line:end)."""
    if isinstance(templates, DataFrame):
        templates = template_table(templates)
    templates = all_templates() if templates is None else list(templates.items() if isinstance(templates, dict) else templates)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)
        for rows in batches:
            for at in range(0, rows.num_rows, BATCH):
                batch = rows.slice(at, BATCH)
                found = [scanner.scan(t or "") for t in batch.column(1).to_pylist()]
                columns = [
                    batch.column(0), pa.array([len(f) for f in found], pa.int64()), pa.array([",".join(sorted({x[0] for x in f})) for f in found], pa.string()),
                    pa.array([round(max((x[3] for x in f), default=0.0), 4) for f in found], pa.float64()), pa.array([",".join(f"{x[0]}:{x[1]}:{x[2]}" for x in f) for f in found], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_found", "licenses", "best_dice", "parts"])

    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(named(id_col).alias("id"), named(text_col).alias("text"))
    return rows.mapInArrow(read, f"id {kind}, n_found long, licenses string, best_dice double, parts string").withColumnRenamed("id", id_col)
