"""Personal data by bootstrapped contextual extraction (operator 10).

Seeds are what the base expressions find: e-mail addresses, IP addresses, payment cards
that pass the Luhn check, and phone numbers; and runs of letters and digits that look like
keys or tokens (kind ``secret``, in ``spans`` but no base span). The words around the seeds
induce lexical patterns (one or two words to the left, or one on either side). Patterns and instances
form a graph: a pattern is as trustworthy as the share of its distinct instances that
are known to be of one kind, of those that are known or dropped; unseen ones count
``UNSEEN_WEIGHT`` each, as they are what the pattern is to find. An unseen identifier is
as trustworthy as the patterns around it that are trusted, taken together. Spark scores
both in turn until no new identifier passes ``MIN_INSTANCE``; those that pass join the
known ones for good and support further patterns.

An unseen identifier is a token with at least ``MIN_DIGITS`` digits outside all base
matches, or several short groups of capitals and digits with a space between. What a base
expression matched but its check dropped counts against a pattern, unless it is the rest
of such groups that begin with a letter.

Defined cases: a null text is an empty one; whole texts are read, in time linear in their
length; a text's spans are found once per distinct text, so copies and rows with repeated
or null ids are treated alike; the same identifier in many copies is one instance; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerframe.llm.common import cut

KINDS = ("email", "ip", "card", "phone")
SPAN_KINDS = (*KINDS, "secret")
SECRET = len(KINDS)
#: A seed of kind secret: an unbroken run of this many letters and digits or more, with both
#: of them, and of this many bits a character or more (hexadecimal and richer alphabets apart).
SECRET_HEX, SECRET_MIXED = 32, 24
HEX_BITS, MIXED_BITS = 3.0, 3.8
MIN_PATTERN = 0.8
MIN_SUPPORT = 3
MIN_INSTANCE = 0.9
#: An unseen instance's share of one that is known or dropped.
UNSEEN_WEIGHT = 0.1
MIN_DIGITS = 4
MIN_LENGTH = 6
#: A longer word is no context but data of some kind.
MAX_WORD = 64

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# digits are taken whole: what starts inside a run of digits also starts where the run does
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9@._+/-]*")
_TOKEN_CHAR = re.compile(r"[A-Za-z0-9@._+/-]")
_GROUPS = re.compile(r"(?<![A-Za-z0-9@._+/-])[A-Z0-9]{2,5}(?:\x20[A-Z0-9]{2,5})+(?![A-Za-z0-9@+/-])")
_WORD = re.compile(r"[^\s]+")
_RUN = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{24,}(?![A-Za-z0-9_+/=-])")
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each @ outwards."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """``(kind, start, end)`` of the base expressions, and the matches that a check dropped."""
    found = [(0, *span) for span in emails(text)]
    dropped = []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            ok = all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))
            found.append((1, *m.span())) if ok else dropped.append(m.span())
        for m in _CARD.finditer(text):
            if m.end() - m.start() < 16:
                continue
            digits = m[0].replace(" ", "").replace("-", "")
            ok = 16 <= len(digits) <= 19 and luhn(digits)
            found.append((2, *m.span())) if ok else dropped.append(m.span())
        for m in _PHONE.finditer(text):
            ok = 8 <= sum(c.isdigit() for c in m[0]) <= 15
            found.append((3, *m.span())) if ok else dropped.append(m.span())
    return found, dropped


def entropy(run: str) -> float:
    """Bits a character of a run of characters."""
    return sum(-n / len(run) * math.log2(n / len(run)) for n in Counter(run).values())


def secrets(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs that look like keys or tokens and don't overlap the spans in ``taken``.

    Hexadecimal runs need letters and digits, others capitals and small letters as well, so
    words, numbers, paths and names in one case are none.
    """
    out, k, taken, upto = [], 0, sorted(taken), 0
    for m in _RUN.finditer(text):
        run = m[0].rstrip("=")
        while k < len(taken) and taken[k][0] < m.end():
            upto = max(upto, taken[k][1])
            k += 1
        if m.start() < upto or not _DIGIT.search(run):
            continue
        if _HEX.fullmatch(run):
            ok = len(run) >= SECRET_HEX and not run.isdigit() and entropy(run) >= HEX_BITS
        else:
            ok = (run.lower() != run and run.upper() != run and run.count("-") + run.count("/") <= len(run) // 8
                  and entropy(run) >= MIXED_BITS)
        if ok:
            out.append((m.start(), m.start() + len(run)))
    return out


def grouped(text: str) -> list[tuple[int, int]]:
    """Identifiers written in groups: neighbouring groups that each hold a digit."""
    out = []
    for m in _GROUPS.finditer(text) if _DIGIT.search(text) else ():
        run, at = [], m.start()
        for group in [*m[0].split(" "), ""]:
            if _DIGIT.search(group):
                run.append((at, at + len(group)))
            else:
                if len(run) > 1 and sum(c in "0123456789" for c in text[run[0][0]:run[-1][1]]) >= MIN_DIGITS:
                    out.append((run[0][0], run[-1][1]))
                run = []
            at += len(group) + 1
    return out


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Identifier-like tokens that don't overlap the spans in ``taken``."""
    spaced, ends = [], -1
    for kind, start, end in sorted([(0, a, b) for a, b in taken] + [(1, a, b) for a, b in grouped(text)],
                                   key=lambda x: x[1:]):
        if kind and start >= ends:
            spaced.append((start, end))
        if kind == 0:
            while spaced and spaced[-1][1] > start:
                spaced.pop()
            ends = max(ends, end)
    out, taken, k, at = [], sorted([*taken, *spaced]), 0, 0
    upto = 0  # furthest end of the taken spans passed
    while m := _DIGIT.search(text, at):
        start = m.start()
        while start > at and _TOKEN_CHAR.match(text[start - 1]):
            start -= 1
        token = _TOKEN.search(text, start)
        start, at = token.start(), max(token.end(), m.end())
        end = start + len(token[0].rstrip("@._+/-"))
        while k < len(taken) and taken[k][0] < end:
            upto = max(upto, taken[k][1])
            k += 1
        if start >= upto and end - start >= MIN_LENGTH \
                and sum(c in "0123456789" for c in text[start:end]) >= MIN_DIGITS:
            out.append((start, end))
    return sorted(out + spaced)


class Words:
    """The words of a text with their lines, found in one pass; ``patterns`` looks around a span.

    What adjoins a span without white space is a word of its own.
    """

    def __init__(self, text: str) -> None:
        self.text, self.first, self.last, self.line = text, [], [], []
        line = upto = 0
        for m in _WORD.finditer(text):
            line += text.count("\n", upto, m.start())
            upto = m.end()
            self.first.append(m.start())
            self.last.append(upto)
            self.line.append(line)

    def _word(self, start: int, end: int) -> str | None:
        """The word, unless it is too long or holds a digit: that is an instance rather than context."""
        word = self.text[start:end] if end - start <= MAX_WORD else "0"
        return None if _DIGIT.search(word) else word.lower()

    def patterns(self, start: int, end: int) -> list[str]:
        """Lexical patterns around a span, on its own line."""
        at, past = bisect_right(self.first, start) - 1, bisect_left(self.last, end)
        here, there = self.line[at], self.line[past]
        left = []
        if self.first[at] < start:
            left.append((self.first[at], start))
        for k in range(at - 1, max(-1, at - 3), -1):
            if self.line[k] == here:
                left.append((self.first[k], self.last[k]))
        near = self._word(*left[0]) if left else None
        if near is None:
            return []
        out = [f"{near} _"]
        if len(left) > 1 and (far := self._word(*left[1])) is not None:
            out.append(f"{far} {near} _")
        right = None
        if self.last[past] > end:
            right = self._word(end, self.last[past])
        elif past + 1 < len(self.first) and self.line[past + 1] == there:
            right = self._word(self.first[past + 1], self.last[past + 1])
        if right is not None:
            out.append(f"{near} _ {right}")
        return out


def mentions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``id, t1, t2, base, seen``; t stands for the text, kind -1 for a dropped match, -2 for unseen."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {id_type}, t1 long, t2 long, base array<struct<kind:int,start:int,stop:int>>, "
              "seen array<struct<kind:int,start:int,stop:int,surface:string,patterns:array<string>>>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, seen = [], []
            for text in batch["t"]:
                text = text or ""
                found, dropped = base_spans(text)
                # a match that is the rest of groups beginning with a letter is none of its own
                whole = [g for g in grouped(text) if text[g[0]].isalpha()] if dropped else []
                dropped = [d for d in dropped if not any(a < d[0] and d[1] <= b for a, b in whole)]
                keys = secrets(text, [s[1:] for s in found])
                dropped = [d for d in dropped if not any(a <= d[0] and d[1] <= b for a, b in keys)]
                rest = candidates(text, [s[1:] for s in found] + dropped + keys)
                base.append([{"kind": k, "start": a, "stop": b} for k, a, b in found])
                spans = [*found, *((SECRET, *s) for s in keys), *((-1, *s) for s in dropped), *((-2, *s) for s in rest)]
                around = Words(text) if spans else None
                seen.append([{"kind": k, "start": a, "stop": b, "surface": text[a:b], "patterns": around.patterns(a, b)}
                             for k, a, b in spans])
            yield pd.DataFrame({"id": batch["id"], "t1": batch["t1"], "t2": batch["t2"], "base": base, "seen": seen})

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t1"), F.crc32(text).alias("t2"),
                       text.alias("t")).mapInPandas(run, schema)


def discovered(seen: DataFrame) -> DataFrame:
    """``(surface, kind)`` of the unseen identifiers that trusted patterns reach.

    ``seen`` has ``kind, surface, pattern``; kind is -1 for dropped and -2 for unseen.
    """
    edges = cut(seen.select("pattern", "surface", "kind").distinct())
    instances = edges.select("surface", "kind").distinct()
    known = instances.where("kind >= 0").withColumn("trust", F.lit(1.0))
    unseen = instances.where("kind = -2").select("surface").join(
        instances.where("kind != -2").select("surface"), "surface", "left_anti")
    weight = F.when(F.max("kind") == -2, F.lit(UNSEEN_WEIGHT)).otherwise(F.lit(1.0))
    weights = instances.groupBy("surface").agg(weight.alias("weight"))
    size = cut(edges.select("pattern", "surface").distinct().join(weights, "surface").groupBy("pattern")
               .agg(F.count("*").alias("n"), F.sum("weight").alias("size"))
               .where(F.col("n") >= MIN_SUPPORT).drop("n"))
    reach = cut(edges.join(unseen, "surface", "left_semi").select("pattern", "surface")
                .join(size.select("pattern"), "pattern", "left_semi"))
    links = cut(edges.select("pattern", "surface").distinct()
                .join(size.select("pattern"), "pattern", "left_semi"))
    found, n_found = known.where("false").select("surface", "kind", "trust"), 0
    while True:
        # an identifier found before is one that is known
        more = (reach.join(found, "surface").groupBy("pattern").agg(F.count("*").alias("more")))
        sizes = size.join(more, "pattern", "left").select(
            "pattern", (F.col("size") + F.coalesce("more", F.lit(0)) * (1 - UNSEEN_WEIGHT)).alias("size"))
        trusted = (links.join(known.unionByName(found), "surface")
                   .groupBy("pattern", "kind").agg(F.sum("trust").alias("right"), F.count("*").alias("support"))
                   .join(sizes, "pattern").withColumn("trust", F.col("right") / F.col("size"))
                   .where((F.col("support") >= MIN_SUPPORT) & (F.col("trust") >= MIN_PATTERN)))
        scored = (reach.join(trusted.select("pattern", "kind", "trust"), "pattern")
                  .join(found.select("surface"), "surface", "left_anti")
                  .groupBy("surface", "kind")
                  .agg((1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.99)))))).alias("trust")))
        best = (scored.groupBy("surface").agg(F.max(F.struct("trust", (-F.col("kind")).alias("k"))).alias("x"))
                .select("surface", (-F.col("x.k")).alias("kind"), F.col("x.trust").alias("trust")))
        found = cut(found.unionByName(best.where(F.col("trust") >= MIN_INSTANCE)))
        now = found.count()
        if now == n_found:
            break
        n_found = now
    return found.select("surface", "kind")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, base, spans)`` per input row; both are arrays of ``(kind, start, stop)``, in order."""
    rows = cut(mentions(docs, id_col, text_col))
    # equal texts have equal mentions: folded before they are joined by text
    seen = rows.select("t1", "t2", F.explode("seen").alias("x")).select("t1", "t2", "x.*").distinct()
    found = discovered(seen.select("kind", "surface", F.explode("patterns").alias("pattern")))
    added = (seen.where("kind = -2").select("t1", "t2", "surface", "start", "stop").join(found, "surface")
             .groupBy("t1", "t2").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("added")))
    base = F.array_sort("base")
    empty = F.array().cast("array<struct<kind:int,start:int,stop:int>>")
    keys = F.transform(F.filter("seen", lambda x: x["kind"] == SECRET),
                       lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")))
    return (rows.select("id", "t1", "t2", "base", keys.alias("keys")).join(added, ["t1", "t2"], "left")
            .select("id", base.alias("base"),
                    F.array_sort(F.concat(base, "keys", F.coalesce("added", empty))).alias("spans")))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns: counts of base spans, their hash, and all spans as text."""
    found = find_personal_data(docs, id_col, text_col)
    names = F.array(*map(F.lit, SPAN_KINDS))

    def joined(col: str):
        return F.array_join(F.transform(col, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(F.col("id").alias(id_col), *counts, F.sha2(joined("base"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"))
