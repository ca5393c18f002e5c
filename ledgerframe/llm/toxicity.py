"""Toxicity by weak supervision (operator 7).

1. Many voters look at a text: a lexicon mined from all labelled training rows, cut by
   reliability into ``LEXICON_VOTERS`` voters, a small general insult lexicon, and text
   patterns. A text's votes are one bit each of a mask.
2. A generative label model is fitted on the counts of all documents' masks, with the
   labelled training rows, all of them, as anchors of the same total weight. It estimates each voter's accuracy, and which
   voters are correlated given the label: a maximum spanning tree over the voters'
   conditional mutual information, with a table for each dependent pair.
3. A linear classifier (logistic regression) is trained on the posterior labels of a
   bounded sample of labelled training rows, over mined terms and votes, and scores
   every text. A row's given label counts there as one more voter, right in
   ``LABEL_ACCURACY`` of all cases.

Labels, language, source and id are never inputs of a score; ids only say which rows
are held out. At most ``2 ** len(VOTERS)`` masks reach the driver.

Defined cases: a null or empty text has no terms and no votes and gets the score of
such a text; labels that are null or held out are not used, of repeated labels of a
document the highest counts; without training rows of both labels the general voters
alone decide, with fixed weights; an empty table gives an empty result; other columns
are passed through ``keep_clean`` untouched and not read otherwise.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerframe.llm.common import BitTable, cut, stored

#: Rows of labelled text that the classifier is fitted on, on average at most.
FIT_ROWS = 20_000
#: log2 of the bits in the table of labelled ids.
TABLE_BITS = 26
LEXICON_TERMS = 256
LEXICON_VOTERS = 8
MIN_TOXIC_ROWS = 3
MIN_LIFT = 8.0
EVIDENCE = 15.0
LABEL_ACCURACY = 0.95
PREFIXES = (4, 5)
THRESHOLD = 0.5
#: Mutual information (nats) above which two voters count as dependent.
DEPENDENT = 1e-3

#: A general insult lexicon and general patterns.
INSULTS = frozenset("""
    idiot idiots moron morons stupid dumb loser losers scum trash pathetic worthless
    disgusting clown imbecile bastard asshole bitch fuck shit
    dummkopf trottel arschloch abschaum dreckskerl
    connard salaud crétin abruti
    imbécil estúpido pendejo cabrón basura
""".split())
PATTERNS = {
    "attack": r"\byou(?:'re| are)\s+(?:an?|such|nothing|so)\b|\bshut up\b|\bgo to hell\b|\bkill yourself\b",
    "threat": r"\bi(?:'ll| will)\s+(?:kill|hurt|find|beat)\s+you\b",
    "masked": r"\b[a-z][*#$@!]{2,}[a-z]?\b",
    "shouting": r"(?:\b[A-Z]{4,}\b[^\w]+){3,}|!{3,}",
}
VOTERS = tuple(f"lexicon_{k}" for k in range(LEXICON_VOTERS)) + ("insults", *PATTERNS, "several_terms")

_WORD = re.compile(r"\w+")
_PATTERN = {name: re.compile(p, 0 if name == "shouting" else re.I) for name, p in PATTERNS.items()}
#: A text without any of these strings (lower case) can't match; looked up before the pattern.
_HINTS = {"attack": ("you", "shut up", "go to hell"), "threat": ("i'll ", "i will "), "masked": "*#$@!"}
_LOUD = re.compile("[A-Z]{4}|!!!")


def held_out(id_: Column) -> Column:
    return (F.crc32(id_.cast("string")) % 5) == 0


def terms_of(text: str | None) -> set[str]:
    """Distinct words and their prefixes (stems of compounding or inflecting languages)."""
    words = set(_WORD.findall(text.lower())) if text else set()
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in PREFIXES))


class Lexicon(dict):
    """Term -> rank, with its prefixes at hand by length."""

    def __init__(self, terms: list[str]) -> None:
        super().__init__((t, k) for k, t in enumerate(terms))
        # terms come in order of reliability; like ones share a voter
        self.voter = [k * LEXICON_VOTERS // len(terms) for k in range(len(terms))]
        self.words = {t for t in terms if t[-1] != "*"}
        self.prefixes = {n: {t[:-1] for t in terms if t[-1] == "*" and len(t) == n + 1} for n in PREFIXES}

    def hits(self, words: set[str]) -> list[int]:
        """Ranks of the terms that a text with these words has."""
        out = [self[w] for w in words & self.words]
        for n, some in self.prefixes.items():
            if some:
                out += [self[p + "*"] for p in {w[:n] for w in words if len(w) > n} & some]
        return out


def look(text: str | None, lexicon: Lexicon) -> tuple[int, list[int]]:
    """The voters' bits, and the ranks of the lexicon's terms in the text."""
    if not text:
        return 0, []
    low = text.lower()
    words = set(_WORD.findall(low))
    hits = lexicon.hits(words)
    bits = 0
    for rank in hits:
        bits |= 1 << lexicon.voter[rank]
    if not INSULTS.isdisjoint(words):
        bits |= 1 << LEXICON_VOTERS
    for k, (name, pattern) in enumerate(_PATTERN.items(), start=LEXICON_VOTERS + 1):
        likely = _LOUD.search(text) if name == "shouting" else any(h in low for h in _HINTS[name])
        if likely and pattern.search(text):
            bits |= 1 << k
    if len(hits) > 3:
        bits |= 1 << len(VOTERS) - 1
    return bits, hits


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(y, t, place)``: all labelled rows that are not held out; place is a hash of the id in 0..1."""
    usable = (labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
              .groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").alias("y")))
    table = BitTable(usable.select(F.xxhash64(F.col("_id").cast(docs.schema[id_col].dataType)).alias("h")), "h", TABLE_BITS)

    @F.pandas_udf("boolean")
    def named(h: pd.Series) -> pd.Series:
        return pd.Series(table.has(h.to_numpy(np.int64).view(np.uint64)))

    # texts without a label stay out of the join
    some = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("t")).where(named(F.xxhash64("_id")))
    place = F.pmod(F.xxhash64(F.lit("fit"), "_id"), F.lit(1 << 30)) / (1 << 30)
    # labels grow with the documents, so they are never broadcast: the same join at every size
    return some.join(usable.hint("merge"), "_id").select("y", "t", place.alias("place"))


def term_counts(rows: DataFrame, min_toxic: int = MIN_TOXIC_ROWS) -> DataFrame:
    """``(term, a, b)``: toxic and other rows that hold a term, of all terms in ``min_toxic`` toxic rows.

    Terms of toxic rows are counted first. Those that enough of them hold are few next to
    the terms of all rows; a bit table of them thins out the others' terms before these
    are shuffled, and a join with the terms themselves makes the counts exact.
    """
    def counted(batches: Iterator[pd.DataFrame], table: BitTable | None) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = Counter()
            for text in batch["t"]:
                terms = list(terms_of(text))
                if table is not None and terms:
                    hashes = np.array([xxhash.xxh64_intdigest(t.encode(), 42) for t in terms], np.uint64)
                    terms = [terms[k] for k in np.flatnonzero(table.has(hashes)).tolist()]
                held.update(terms)
            yield pd.DataFrame({"term": list(held.keys()), "n": list(held.values())})

    def count(y: int, name: str, table: BitTable | None) -> DataFrame:
        return (rows.where(F.col("y") == y).select("t")
                .mapInPandas(lambda batches: counted(batches, table), "term string, n long")
                .groupBy("term").agg(F.sum("n").alias(name)))

    toxic = cut(count(1, "a", None).where(F.col("a") >= min_toxic))
    table = BitTable(toxic.select(F.xxhash64("term").alias("h")), "h", TABLE_BITS)
    other = count(0, "b", table)
    return toxic.join(other, "term", "left").select("term", "a", F.coalesce("b", F.lit(0)).alias("b"))


def mine_lexicon(rows: DataFrame, size: int = LEXICON_TERMS) -> list[str]:
    """Terms that mark toxic rows, the most reliable first.

    Candidates are terms that toxic rows hold ``MIN_LIFT`` times as often as others. Those
    that chance cannot explain (``EVIDENCE``, a divergence in nats) are all taken. Rarer
    ones are taken only as far as they cover toxic rows that no taken term covers, the
    best first; so the many rare words that toxic rows share by chance stay out.
    """
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return []
    counts = term_counts(rows)
    pos, neg = n[1], n[0]
    share = pos / (pos + neg)
    p, q = (F.col("a") + 0.5) / (pos + 1.0), (F.col("b") + 0.5) / (neg + 1.0)
    both = F.col("a") + F.col("b")
    evidence = F.col("a") * F.log(F.col("a") / both / share) + F.when(
        F.col("b") > 0, F.col("b") * F.log(F.col("b") / both / (1 - share))).otherwise(0.0)
    best = (counts.where(p / q >= MIN_LIFT).select("term", "b", evidence.alias("evidence"), (p / q).alias("lift"))
            .orderBy(F.col("evidence").desc(), "term").limit(4 * size)).collect()
    taken = [r["term"] for r in best if r["evidence"] >= EVIDENCE][:size]
    rest = [r for r in best if r["evidence"] < EVIDENCE]
    lexicon = Lexicon([r["term"] for r in best])

    known = {lexicon[t] for t in taken}
    wanted = {lexicon[r["term"]] for r in rest}

    def toxic_hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hits = [set(look(t, lexicon)[1]) for t in batch["t"]]
            found = [sorted(h & wanted) for h in hits if h & wanted and not h & known]
            yield pd.DataFrame({"hits": pd.Series(found, dtype=object)})

    # rows that only rare terms mark, as a few numbers: each term has few, or chance could not explain it
    bare = [set(r["hits"]) for r in rows.where("y = 1").mapInPandas(toxic_hits, "hits array<int>").collect()]
    while rest and len(taken) < size:
        held = Counter(rank for h in bare for rank in h)
        gain, term = max((held[lexicon[r["term"]]] / (1.0 + r["b"]), r["term"]) for r in rest)
        if held[lexicon[term]] < MIN_TOXIC_ROWS:
            rest = [r for r in rest if r["term"] != term]
            continue
        taken.append(term)
        bare = [h for h in bare if lexicon[term] not in h]
    lift = {r["term"]: r["lift"] for r in best}
    return sorted(taken, key=lambda t: (-lift[t], t))


@dataclass
class LabelModel:
    """Class-conditional tree over the voters' bits, with the label as a common parent."""

    prior: float = 0.1
    parent: list[int] = field(default_factory=list)  # -1: depends on the label alone
    table: np.ndarray | None = None  # [label, parent's bit, voter]: chance of a vote
    correlation: dict[tuple[int, int], float] = field(default_factory=dict)

    def log_joint(self, bits: np.ndarray) -> np.ndarray:
        """[mask, label] for rows of 0/1 votes."""
        out = np.empty((len(bits), 2))
        for y in (0, 1):
            p = np.empty(bits.shape)
            for v, up in enumerate(self.parent):
                given = bits[:, up] if up >= 0 else np.zeros(len(bits), int)
                p[:, v] = self.table[y, given, v]
            out[:, y] = np.log(np.where(bits == 1, p, 1 - p)).sum(axis=1) + math.log(self.prior if y else 1 - self.prior)
        return out

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        joint = self.log_joint(bits)
        return 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -500, 500)))

    def accuracy(self, share: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """Each voter's estimated chance to agree with the label."""
        p = self.posterior(bits)
        return ((share * p) @ bits + (share * (1 - p)) @ (1 - bits)) / share.sum()


def _tree(bits: np.ndarray, w: np.ndarray) -> tuple[list[int], dict[tuple[int, int], float]]:
    """Maximum spanning forest over mutual information given the label; w: [mask, label]."""
    n = bits.shape[1]
    info = np.zeros((n, n))
    total = w.sum()
    for y in (0, 1):
        wy = w[:, y]
        if wy.sum() <= 0:
            continue
        both = (bits * wy[:, None]).T @ bits / wy.sum()
        one = np.diag(both)
        for s in (0, 1):
            for t in (0, 1):
                p = (both if s and t else one[:, None] - both if s else one[None, :] - both if t
                     else 1 - one[:, None] - one[None, :] + both)
                q = np.outer(one if s else 1 - one, one if t else 1 - one)
                good = (p > 1e-12) & (q > 1e-12)
                info += np.where(good, p * np.log(np.where(good, p / np.where(good, q, 1), 1)), 0) * wy.sum() / total
    parent, inside = [-1] * n, [0]
    while len(inside) < n:
        outside = [v for v in range(n) if v not in inside]
        u, v = max(((u, v) for u in inside for v in outside), key=lambda e: info[e])
        parent[v] = u if info[u, v] > DEPENDENT else -1
        inside.append(v)
    return parent, {(parent[v], v): float(info[parent[v], v]) for v in range(n) if parent[v] >= 0}


def fit_label_model(masks: np.ndarray, known: np.ndarray, counts: np.ndarray, rounds: int = 15) -> LabelModel:
    """EM over mask counts; known: 1, 0, or -1 where the label is not given."""
    n = len(VOTERS)
    bits = (masks[:, None] >> np.arange(n)) & 1
    anchored = known >= 0
    # without this, the classes could drift to whatever else splits the unlabelled rows
    counts = np.where(anchored, counts * max(1.0, counts[~anchored].sum() / max(1.0, counts[anchored].sum())), counts)
    truth = np.where(anchored, known, 0).astype(float)
    share = (counts * anchored * truth).sum() / max(1.0, (counts * anchored).sum())
    model = LabelModel(prior=min(0.9, max(0.001, share)), parent=[-1] * n)

    def maximise(p: np.ndarray) -> np.ndarray:
        w = np.stack([counts * (1 - p), counts * p], axis=1)
        model.prior = float(np.clip(w[:, 1].sum() / max(1e-9, w.sum()), 1e-3, 0.9))
        if anchored.any():  # how often clean texts draw a vote is known from clean rows alone:
            w[~anchored, 0] = 0  # toxic texts with few votes would otherwise come to count as clean
        model.table = np.empty((2, 2, n))
        for v, up in enumerate(model.parent):
            for y in (0, 1):
                for given in (0, 1):
                    some = w[:, y] * ((bits[:, up] == given) if up >= 0 else 1)
                    model.table[y, given, v] = ((some * bits[:, v]).sum() + 0.1) / (some.sum() + 1.0)
        return w

    # start from the anchors: rows without a label count through their likeness to these
    keep, counts = counts, counts * anchored
    maximise(truth)
    counts = keep
    for round_ in range(rounds):
        p = np.where(anchored, truth, model.posterior(bits))
        w = maximise(p)
        if round_ == rounds // 2:
            model.parent, model.correlation = _tree(bits, w)
            maximise(p)
    return model


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray  # of the lexicon's terms, then of the voters
    intercept: float
    labels: LabelModel | None = None

    def score(self, text: str | None) -> float:
        bits, hits = look(text, self.lexicon)
        z = self.intercept + self.weights[hits].sum()
        z += sum(self.weights[len(self.lexicon) + v] for v in range(len(VOTERS)) if bits >> v & 1)
        return float(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Mines lexicons, fits the label model on all documents' votes, trains the classifier."""
    rows = stored(training_rows(docs, labels, id_col, text_col))
    terms = mine_lexicon(rows)
    lexicon = Lexicon(terms)
    general = np.zeros(len(terms) + len(VOTERS))
    general[len(terms) + LEXICON_VOTERS:len(terms) + len(VOTERS) - 1] = 3.0
    plain = ToxicityModel(lexicon, general, -3.0)
    if not terms:
        return plain

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = [look(t, lexicon) for t in batch["t"]]
            yield pd.DataFrame({"y": batch["y"], "place": batch["place"], "mask": [m for m, _ in seen],
                                "hits": [h for _, h in seen]})

    schema = "y int, place double, mask int, hits array<int>"
    fitted = cut(rows.mapInPandas(vote, schema))
    everywhere = docs.select(F.lit(-1).alias("y"), F.lit(0.0).alias("place"), F.col(text_col).alias("t")) \
        .mapInPandas(vote, schema)
    counts = fitted.groupBy("y", "mask").agg(F.count("*").alias("n")).unionByName(
        everywhere.groupBy("y", "mask").agg(F.count("*").alias("n"))).toPandas()
    model = fit_label_model(counts["mask"].to_numpy(), counts["y"].to_numpy(), counts["n"].to_numpy(float))

    masks = np.unique(counts["mask"].to_numpy())
    bits = (masks[:, None] >> np.arange(len(VOTERS))) & 1
    joint = model.log_joint(bits)
    odds = (joint[:, 1] - joint[:, 0])[None, :] + math.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY)) * np.array([[-1], [1]])
    posterior = docs.sparkSession.createDataFrame(pd.DataFrame({
        "y": np.repeat([0, 1], len(masks)).astype(np.int32), "mask": np.tile(masks, 2),
        "p": 1 / (1 + np.exp(-np.clip(odds, -500, 500))).ravel()}))
    n = len(terms)
    lexical = F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                          lambda k: F.array_contains("hits", k.cast("int")).cast("double"))
    voted = F.array(*[F.shiftright("mask", v).bitwiseAND(F.lit(1)).cast("double") for v in range(len(VOTERS))])
    # a posterior label is a row of each label, weighted
    share = min(1.0, fit_rows / max(1, fitted.count()))
    train = (fitted.where(F.col("place") < share).join(F.broadcast(posterior), ["y", "mask"])  # at most 2 ** (voters + 1) rows
             .select(array_to_vector(F.concat(lexical, voted)).alias("features"), "p")
             .select("features", F.explode(F.array(
                 F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")),
                 F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")))).alias("x"))
             .select("features", "x.label", "x.weight").where("weight > 1e-6"))
    fitted_model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=40,
                                      aggregationDepth=2).fit(train)
    return ToxicityModel(lexicon, fitted_model.coefficients.toArray(), float(fitted_model.intercept), model)


def scorer(model: ToxicityModel):
    """Column function: text -> score."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in text], dtype="float64")

    return score


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, score, predicted)``, one row per input row."""
    out = docs.select(id_col, F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"),
                      scorer(model)(F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with their own columns."""
    return docs.where(scorer(model)(F.col(text_col)) < THRESHOLD)
