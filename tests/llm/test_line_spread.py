import random
from collections import defaultdict

from conftest_llm import words

from ledgerframe.llm import line_spread as L

STRIP = " \t\r\x0b\x0c"


def plain(rows, min_sites=L.MIN_SITES):
    sites, of_text = defaultdict(set), defaultdict(set)
    for _, text, _, source, _ in rows:
        of_text[text].add("" if source is None else "=" + source)
    for text, some in of_text.items():  # copies count as one text
        for line in (text or "").split("\n"):
            if line.strip(STRIP):
                sites[line.strip(STRIP)].add(min(some))
    out = []
    for doc, text, _, _, _ in rows:
        if text is None:
            out.append((doc, None, 0))
            continue
        old = text.split("\n")
        new = [x for x in old if len(sites[x.strip(STRIP)]) < min_sites]
        less = "\n".join(new)
        gone = len(old) - len(new)
        out.append((doc, less, gone))
    return out


def got(docs):
    return sorted(((r["row"]["doc_id"], r["text"], r["removed"]) for r in L.remove_boilerplate(docs).collect()), key=str)


def test_matches_exact_counts_around_the_threshold(spark, no_docs):
    rng = random.Random(2)
    spread = {f"boiler {n} {k}": n for n in range(1, 41) for k in range(3)}
    rows = []
    for i in range(1500):
        site = f"site{i % 60}" if i % 3 else "site0"
        number = int(site[4:])
        mine = [b for b, n in spread.items() if number < n and rng.random() < 0.5]
        text = "\n".join([words(rng, 40), *rng.sample(mine, min(4, len(mine))), "", words(rng, 40) + " "])
        rows.append((i, text, "en", site, len(text)))
    for b, n in spread.items():  # every line on exactly n sites
        rows += [(10_000 + len(rows), f"{words(rng, 30)}\n\t{b} \n{words(rng, 30)}", "en", f"site{s}", 0) for s in range(n)]
    assert got(spark.createDataFrame(rows, no_docs.schema)) == sorted(plain(rows), key=str)


def test_copied_pages_stay_whole(spark, no_docs):
    page = "\n".join(f"line {k} of a page that is mirrored" for k in range(8))
    rows = [(i, page, "en", f"s{i}", 0) for i in range(20)]
    rows += [(100 + i, f"own text number {i} which is longer than the line\nall rights reserved", "en", f"s{i}", 0)
             for i in range(20)]
    docs = spark.createDataFrame(rows, no_docs.schema)
    assert got(docs) == sorted(plain(rows), key=str)
    assert {r[2] for r in got(docs)} == {0, 1}


def test_half_boilerplate_is_cleaned_and_copies_do_not_spread_it(spark, no_docs):
    """Boilerplate goes whatever its share; a mirrored page's lines stay, a hot text included."""
    notice = "all rights reserved by the owners of this and many other pages of the network, see terms"
    rows = [(i, f"{notice}\nown text {i}\n{notice}", "en", f"s{i}", 0) for i in range(12)]
    page = "a mirrored line of some length\nanother line of the page"
    rows += [(100 + i, page, "en", f"s{i}", 0) for i in range(40)]
    rows += [(200, notice, "en", "s1", 0), (None, f"{page}\n{notice}", "en", None, 0)]
    docs = spark.createDataFrame(rows, no_docs.schema)
    found = got(docs)
    assert found == sorted(plain(rows), key=str)
    assert (3, "own text 3", 2) in found and (100, page, 0) in found and (200, "", 1) in found


def test_defined_cases(edge_docs, edge_rows, clashing_docs, no_docs, rows_of):
    assert got(edge_docs) == sorted(plain(edge_rows), key=str)
    cleaned = L.clean(edge_docs)
    assert cleaned.schema == edge_docs.schema
    assert rows_of(cleaned) == rows_of(edge_docs)
    assert got(no_docs) == [] and L.clean(no_docs).columns == no_docs.columns


def test_clashing_names_pass_through(spark, clashing_docs, rows_of):
    cleaned = L.clean(clashing_docs)
    assert cleaned.columns == clashing_docs.columns and rows_of(cleaned) == rows_of(clashing_docs)


def test_null_sites_are_one_site(spark, no_docs):
    rows = [(i, "banner\nlong enough text of the document %d" % i, "en", None if i % 2 else f"s{i}", 0) for i in range(14)]
    assert got(spark.createDataFrame(rows, no_docs.schema)) == sorted(plain(rows), key=str)


def test_length_follows_the_text(spark, no_docs):
    rows = [(i, f"banner\nlong enough text of the document {i}", "en", f"s{i}", 99) for i in range(10)]
    out = L.clean(spark.createDataFrame(rows, no_docs.schema)).collect()
    assert all(r["n_chars"] == len(r["text"]) and "banner" not in r["text"] for r in out)
