"""Personal data by rules, and by contexts learned from what the rules find.

Rules find emails, IP addresses, card and phone numbers. These seeds teach
lexical patterns, from special to general: three and two words before an identifier,
a word on either side, two words after it, and, as a back-off, the word before it,
that word with the identifier's shape (digits as 0, letters as a), and the shape alone. Patterns and the
identifier-like words that stand in them form a graph; Spark scores it in
rounds: a pattern's score for a kind is the belief in its distinct instances
over their number, an instance's belief the best score of its patterns, seeds
stay at 1. Patterns that score ``SCORE`` or more with ``SEEDS`` distinct instances'
worth of belief extract what no rule takes (the back-off ones need ``SURE`` and ``BACK_OFF``
times the belief, as chance suffices for less), if its form suits the kind: words, and
runs of digits with the separators of the rules (blank, dot, bracket, dash, colon).
So numbers of a seed's form that no rule takes, such as a failed check digit, count against a pattern.
A run is read up to its first word if that has a form, else as far as it has one;
where a found run holds a found word, the run counts.

Texts are read once; per document only spans and words and runs that have a form go on. Scores are aggregates and joins over
distinct (pattern, instance) pairs, so a hot pattern or instance spreads.

Defined cases: null text counts as empty and has no spans. Ties between kinds go
to the first of ``KINDS``. Repeated rows each get their spans, and count once as
an instance. A context word of more than ``NAMED`` characters is known by the
``NAMED`` next to the identifier. A found span never overlaps a rule's span, which all stay. Very long
texts are read whole. An empty table gives an empty result. Only the id and the
text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SCORE = 0.8
SEEDS = 3.0
#: Score, and times ``SEEDS``, of the patterns of one word or none.
SURE, BACK_OFF = 0.9, 4.0
#: Characters that name a context word.
NAMED = 64

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_WORD = re.compile(r"\S+")
#: Digits and separators, from a word's start.
_RUN = re.compile(r"(?<![\w@.%+-])[(+]*[0-9][0-9().:+-]*(?: +[0-9().:+-]+)*")
_DIGIT, _LETTERS = re.compile(r"\d"), re.compile(r"[^\W\d_]+")
_EDGE = ".,;:!?()[]{}<>\"'`|"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part left of each at sign, as far as the last match allows, and a domain right of it."""
    free = 0
    at = text.find("@")
    while at >= 0:
        s = at
        while s > free and text[s - 1] in _LOCAL:
            s -= 1
        if s < at and (m := _DOMAIN.match(text, at + 1)):
            yield s, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def rule_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    if not text or not _ANY.search(text):
        return []
    out = [(0, s, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def forms(word: str) -> int:
    """Bits of the kinds whose form an identifier-like word has."""
    d = len(_digits(word))
    plain = all(c in "0123456789 ().+-/" for c in word)
    return ("@" in word) | (re.fullmatch(r"[0-9]+(?:[.:-][0-9]+){3}", word) is not None) << 1 \
        | (plain and 13 <= d <= 19) << 2 | (plain and 7 <= d <= 15) << 3


class _Contexts:
    """The patterns of a text's places; its words are looked up when there is a place."""

    def __init__(self, text: str):
        self.text, self._words = text, None

    def _around(self, start: int, end: int) -> tuple[list[str], list[str]]:
        """Three words before and two after a place, lower-cased; parts of its own word are words."""
        text = self.text
        if self._words is None:
            self._words = [m.span() for m in _WORD.finditer(text)]
        words = self._words
        i = bisect_left(words, (start,))  # words before start at words[:i]
        left = [text[max(s, min(e, start) - NAMED):min(e, start)].lower() for s, e in words[max(0, i - 3):i]]
        right, j = [], max(0, bisect_left(words, (end,)) - 1)
        while j < len(words) and len(right) < 2:
            s, e = words[j]
            s = max(s, end)
            if s < e and (w := text[s:min(e, s + NAMED)].strip(_EDGE)):
                right.append(w.lower())
            j += 1
        return left, right

    def patterns(self, start: int, end: int, begin: int | None = None) -> Iterator[str]:
        """Those of the place; the words before it are those before ``begin``. Two words before it
        stand as they are, others after their sort and a tab, which no word holds."""
        left, right = self._around(start if begin is None else begin, end)
        if len(left) > 2:
            yield "left\t" + " ".join(left)
        if len(left) > 1:
            yield " ".join(left[-2:])
        if left and right:
            yield f"around\t{left[-1]} {right[0]}"
        if len(right) > 1:
            yield "right\t" + " ".join(right)
        if left:
            yield f"word\t{left[-1]}"
        if end - start <= NAMED:
            shape = _LETTERS.sub("a", _DIGIT.sub("0", self.text[start:end]))
            yield f"shape\t{shape}"
            if left:
                yield f"shaped\t{left[-1]} {shape}"


def _reading(run: str) -> str:
    """The part of a run, from its start, that has a form: its first word or as much as can be."""
    found, digits = "", 0
    for m in _WORD.finditer(run):
        if not (n := len(_digits(m[0]))):
            continue
        digits += n
        if digits > 19:
            break
        part = run[:m.end()].rstrip(" ().:+-")
        part = part if ")" in part else part.lstrip("(")
        if forms(part):
            if " " not in part:
                return part
            found = part
    return found


def _runs(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start of the run, start, end) of the readings of runs beside the ``taken`` spans."""
    i = 0
    for m in _RUN.finditer(text):
        s, e = m.span()
        if e < len(text) and not text[e].isspace() and text[e] not in _EDGE:  # its last word goes on
            e = max(s, text.rfind(" ", s, e))
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        for x, y in [*(t for t in taken[max(0, i - 3):i] if t[1] > s), *_until(taken, i, e), (e, e)]:
            part = text[s:x]
            if x > s and (own := _reading(part.lstrip(" .:)-"))):
                at = text.index(own, s)
                yield s + len(part) - len(part.lstrip(" .:)-")), at, at + len(own)
            s = max(s, y)


def _until(taken: list[tuple[int, int]], i: int, end: int) -> Iterator[tuple[int, int]]:
    while i < len(taken) and taken[i][0] < end:
        yield taken[i]
        i += 1


def _line(text: str) -> tuple[list[dict], list[dict]]:
    """The rules' spans, and the words and spans that take part in the graph."""
    spans = rule_spans(text)
    if not text or not _ANY.search(text):
        return [], []
    at = _Contexts(text)
    graph = []

    def add(kind: int, form: int, s: int, e: int, begin: int | None = None) -> None:
        graph.extend({"pattern": p, "instance": text[s:e].lower(), "kind": kind, "form": form, "s": s, "e": e}
                     for p in at.patterns(s, e, begin))

    for k, s, e in spans:
        add(k, 1 << k, s, e)
    taken = sorted((s, e) for _, s, e in spans)
    first = set()
    for start, s, e in _runs(text, taken):
        first.update(range(start, s + len(text[s:e]) - len(text[s:e].lstrip("(+")) + 1))
        add(-1, forms(text[s:e]), s, e, start)
    i = 0
    for m in _WORD.finditer(text):
        if not _ANY.search(m[0]):
            continue
        word = m[0].strip(_EDGE)
        s = m.start() + m[0].find(word)
        e = s + len(word)
        if s in first:  # read as a run
            continue
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if any(x < e for x, _ in taken[i:i + 1]) or any(x < e and y > s for x, y in taken[max(0, i - 3):i]):
            continue
        if f := forms(word):
            add(-1, f, s, e)
    return [{"kind": k, "s": s, "e": e} for k, s, e in spans], graph


SPAN = "array<struct<kind:int,s:long,e:long>>"
GRAPH = "array<struct<pattern:string,instance:string,kind:int,form:int,s:long,e:long>>"


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    span = pa.list_(pa.struct([("kind", pa.int32()), ("s", pa.int64()), ("e", pa.int64())]))
    graph = pa.list_(pa.struct([("pattern", pa.string()), ("instance", pa.string()), ("kind", pa.int32()), ("form", pa.int32()),
                                ("s", pa.int64()), ("e", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [_line(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([g[0] for g in got], span), pa.array([g[1] for g in got], graph)],
                                             names=["id", "rules", "graph"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, rules {SPAN}, graph {GRAPH}") \
        .withColumn("row", F.monotonically_increasing_id())


def score_patterns(graph: DataFrame, rounds: int = ROUNDS, score: float = SCORE, seeds: float = SEEDS) -> DataFrame:
    """(pattern, kind, score) of the patterns that extract, from (pattern, instance, kind, form)."""
    edges = staged(graph.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.bit_or("form").alias("form")), "pii_graph")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("size"))
    sure = edges.where("kind >= 0").select("instance", "kind", F.lit(1.0).alias("belief")).distinct()
    belief, strong = sure, None
    general = F.col("pattern").rlike("^(word|shape|shaped)\t")
    enough = F.when(general, F.lit(seeds * BACK_OFF)).otherwise(F.lit(seeds))
    share = F.when(general, F.greatest(F.lit(score), F.lit(SURE))).otherwise(F.lit(score))
    for k in range(rounds):
        strong = edges.select("pattern", "instance").join(belief, "instance").groupBy("pattern", "kind") \
            .agg(F.sum("belief").alias("sum")).join(sizes, "pattern") \
            .where((F.col("sum") >= enough) & (F.col("sum") >= share * F.col("size"))) \
            .select("pattern", "kind", (F.col("sum") / F.col("size")).alias("score"))
        strong = staged(strong, "pii_patterns")
        if k < rounds - 1:
            fits = F.col("form").bitwiseAND(F.expr("shiftleft(1, k)")) != 0
            new = edges.where("kind < 0").select("pattern", "instance", "form") \
                .join(strong.withColumnRenamed("kind", "k"), "pattern").where(fits) \
                .groupBy("instance", F.col("k").alias("kind")).agg(F.max("score").alias("belief"))
            belief = staged(sure.unionByName(new).groupBy("instance", "kind").agg(F.max("belief").alias("belief")), "pii_belief")
    return strong


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, score: float = SCORE,
         seeds: float = SEEDS) -> DataFrame:
    """One row per document: id, ``rules`` and ``spans`` (rules' and found ones), each
    an array of (kind, s, e) ordered by kind, then start; ends exclusive."""
    read = staged(_read(docs, id_col, text_col), "pii_rows")
    graph = read.select("row", F.explode("graph").alias("g")).select("row", "g.*")
    strong = score_patterns(graph, rounds, score, seeds)
    fits = F.col("form").bitwiseAND(F.expr("shiftleft(1, k)")) != 0
    best = graph.where("kind < 0").join(strong.withColumnRenamed("kind", "k"), "pattern").where(fits) \
        .groupBy("row", "s", "e").agg(F.max(F.struct("score", (-F.col("k")).alias("k"))).alias("b"))
    ahead = F.max("e").over(Window.partitionBy("row").orderBy("s").rowsBetween(Window.unboundedPreceding, -1))
    best = best.withColumn("ahead", ahead).where("ahead IS NULL OR ahead <= s")
    found = best.groupBy("row").agg(F.collect_list(F.struct((-F.col("b.k")).alias("kind"), "s", "e")).alias("found"))
    return read.select("row", "id", "rules").join(found, "row", "left").select(
        F.col("id").alias(id_col), "rules",
        F.array_sort(F.concat("rules", F.coalesce("found", F.array().cast(SPAN)))).alias("spans"))


def of_kind(kind: int) -> Callable[[Column], Column]:
    """A test of a span, for ``filter``."""
    return lambda span: span["kind"] == kind


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
