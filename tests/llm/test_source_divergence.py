import random
import re
from collections import Counter, defaultdict

from ledgerframe.llm import source_divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, min_docs=30, top=50):
    count, docs, langs, groups = Counter(), Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        for t in terms:
            count[lang, source, t] += 1
            langs[lang, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    kept = defaultdict(list)
    for (lang, t), n in docs.items():
        if n >= min_docs:
            kept[lang].append(t)

    def shares(lang, get):
        v, n = len(kept[lang]), sum(get(t) for t in kept[lang])
        return {t: 1 + (10 ** 9 * (get(t) + 5)) // (n + 5 * v) for t in kept[lang]}

    p = {g: shares(g[0], lambda t, g=g: count[*g, t]) for g in groups}
    out = []
    for lang, source in groups:
        q = shares(lang, lambda t: langs[lang, t])
        mine = p[lang, source]
        pairs = [(s, sum(abs(mine[t] - p[lang, s][t]) for t in mine)) for l, s in groups if l == lang and s != source]
        terms = [(t, mine[t] - q[t]) for t in mine if count[lang, source, t] and mine[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return sorted(out)


def found(docs, **options):
    return sorted(tuple(r) for r in D.audit(docs, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def made(rng, many):
    rows = []
    for _ in range(many):
        source = rng.choice(["hot", "hot", "hot", "s1", "s2", "S2", "é", None])
        base = rng.randrange(40)
        text = " ".join(rng.choice("ab") + chr(97 + min(25, int(rng.expovariate(0.2)) + base % 5)) + "Äß"[rng.randrange(2)]
                        for _ in range(rng.randrange(60)))
        rows.append((text, rng.choice(["en", "en", "de", None]), source))
    return rows


def test_matches_plain_version(spark):
    rows = made(random.Random(1), 400)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(6)
    assert found(docs) == plain(rows)


def test_blocks_add_up(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_CELLS", 7)
    monkeypatch.setattr(D, "_SCATTER", 5)
    monkeypatch.setattr(D, "_HELD", 50)
    rows = made(random.Random(2), 300)
    assert found(spark.createDataFrame(rows, "text string, lang string, source string")) == plain(rows)


def test_many_terms_keep_the_first_fifty(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    rows = [(" ".join(rng.sample(vocabulary[:150] if k % 2 else vocabulary[50:], 90)), "en", f"s{k % 2}") for k in range(120)]
    got = found(spark.createDataFrame(rows, "text string, lang string, source string"))
    assert got == plain(rows)
    assert sum(r[2] == "term" and r[1] == "s0" for r in got) == 50


def test_groups_and_languages_without_terms(spark):
    rows = [("x1 2", "en", "a"), (None, "en", "b"), ("", None, None), ("words that few documents hold", "fr", "c")]
    rows += [("often here", "de", "a")] * 30 + [(None, "de", "b"), ("123", "de", "c")]
    got = found(spark.createDataFrame(rows, "text string, lang string, source string"))
    assert got == plain(rows)
    assert ("en", "a", "pair", "b", 0, 1) in got


def test_edge_rows(edge_docs, clashing_docs, edge_rows):
    want = plain([(r[1], r[2], r[3]) for r in edge_rows], min_docs=2)
    assert found(edge_docs, min_docs=2) == want
    assert found(clashing_docs, min_docs=2) == want


def test_empty_table(no_docs):
    assert found(no_docs) == []
