import hashlib
import random
import re
import time

from conftest_llm import words
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerframe.llm import pii_bootstrap as P

#: The contract's expressions as they stand.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, expression in BASE.items():
        for m in re.finditer(expression, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card":
                total = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(digits[::-1]))
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def named(spans):
    return [f"{P.KINDS[k]}:{a}:{b}" for k, a, b in spans]


FIXED = ["a@b.c_x@y.org", "a@b@c.d", "@x.y a@ .@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 1.2.3", "4111 1111 1111 1111",
         "4111-1111-1111-1111 12", "+1 (456) 555-2186 x +12 3 +1234567890123456", "ünï a.b@c-d.ef, 10.0.0.1", "1" * 3000,
         "4111111111111111111", "x" * 3000 + "@", "a@b.c@d.e", "a%b+c@d.e.f.", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6"]


def test_fixed_texts():
    for text in FIXED:
        assert named(P.base_spans(text)[0]) == plain(text), text


@settings(max_examples=1500, deadline=None)
@given(st.text("ab@.%-+ ()0123456789é\n", max_size=60))
def test_any_text(text):
    assert named(P.base_spans(text)[0]) == plain(text)


@settings(max_examples=400, deadline=None)
@given(st.text("ab@.-+ 0123456789/\n", max_size=80))
def test_candidates_are_separate_tokens_outside_of_what_is_taken(text):
    found, dropped = P.base_spans(text)
    taken = [s[1:] for s in found] + dropped
    out = P.candidates(text, taken)
    assert all(a >= d or b <= c for a, b in out for c, d in taken)
    assert all(b <= c for (_, b), (c, _) in zip(out, out[1:]))
    assert all(sum(x.isdigit() for x in text[a:b]) >= P.MIN_DIGITS for a, b in out)


def test_context_finds_unseen_identifiers_and_leaves_others(spark, no_docs):
    rng = random.Random(6)
    rows = []
    for i in range(40):  # seeds after "reach me", which also stands before an unseen form
        rows.append((i, f"{words(rng, 5)} reach me +1 (456) 555-{1000 + i} today. {words(rng, 5)}", "en", "s", 0))
    rows.append((100, "please reach me 0456-555-9999 today, invoice 2024-555-1234 was paid", "en", "s", 0))
    rows += [(200 + i, f"order number {10_000 + i} invoice {2000 + i}-555-1234 was sent", "en", "s", 0) for i in range(20)]
    out = {r["doc_id"]: r for r in P.digest(spark.createDataFrame(rows, no_docs.schema)).collect()}
    text = rows[40][1]
    at = text.index("0456")
    assert out[100]["spans"] == f"phone:{at}:{at + 13}" and out[100]["n_phone"] == 0
    assert all(out[200 + i]["spans"] == "" for i in range(20))
    assert all(out[i]["n_phone"] == 1 for i in range(40))


def test_dropped_matches_count_against_a_pattern(spark, no_docs):
    rng = random.Random(6)
    rows = [(i, f"{words(rng, 5)} host at 10.0.0.{i} now", "en", "s", 0) for i in range(10)]
    rows += [(50 + i, f"{words(rng, 5)} host at 999.0.0.{i} now", "en", "s", 0) for i in range(10)]
    rows.append((90, "the host at node-77123 now", "en", "s", 0))
    out = {r["doc_id"]: r["spans"] for r in P.digest(spark.createDataFrame(rows, no_docs.schema)).collect()}
    assert out[90] == ""


def test_defined_cases(edge_docs, edge_rows, clashing_docs, no_docs, spark, rows_of):
    more = [(20, t, "en", "s", 0) for t in FIXED] + [(21, "mail a@b.cd" + " x" * 100_000 + " 1.2.3.4", "en", "s", 0)]
    rows = edge_rows + more + more[:3]
    docs = spark.createDataFrame(rows, no_docs.schema)
    got = sorted(((r["doc_id"], r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"])
                  for r in P.digest(docs).collect()), key=str)
    expected = []
    for r in rows:
        spans = plain(r[1])
        n = [sum(s.startswith(k) for s in spans) for k in P.KINDS]
        expected.append((r[0], hashlib.sha256(",".join(spans).encode()).hexdigest(), *n))
    assert got == sorted(expected, key=str)
    assert rows_of(P.digest(clashing_docs)) == rows_of(P.digest(edge_docs))
    assert P.digest(no_docs).collect() == []


def test_contexts_where_a_quarter_to_half_is_unseen(spark, no_docs):
    rng = random.Random(8)
    for seeds, unseen in ((30, 10), (30, 30)):
        rows = [(i, f"{words(rng, 5)} reach me +1 (456) 555-{1000 + i} today. {words(rng, 5)}", "en", "s", 0)
                for i in range(seeds)]
        rows += [(100 + i, f"{words(rng, 5)} reach me 0456-555-{1000 + i} today. {words(rng, 5)}", "en", "s", 0)
                 for i in range(unseen)]
        out = {r["doc_id"]: r["spans"] for r in P.digest(spark.createDataFrame(rows, no_docs.schema)).collect()}
        for doc, text, *_ in rows[seeds:]:
            at = text.index("0456-")
            assert out[doc] == f"phone:{at}:{at + 13}"


def test_rounds_go_on_until_nothing_new_is_found(spark):
    # each context holds identifiers of the one before and a few that only it reaches
    seen = [(3, f"seed{k}", f"p0{side}") for k in range(5) for side in "ab"]
    for step in range(6):
        names = [f"id{step}-{k}" for k in range(5)]
        seen += [(-2, name, p + side) for name in names for p in (f"p{step}", f"p{step + 1}") for side in "ab"]
    got = {r["surface"] for r in P.discovered(spark.createDataFrame(seen, "kind int, surface string, pattern string")).collect()}
    assert got == {s for k, s, _ in seen if k == -2}


def test_identifiers_in_groups_are_candidates():
    text = "transfer to DE89 3704 0044 0532 0130 00 please"
    at = text.index("DE89")
    assert P.grouped(text) == [(at, at + 27)] == P.candidates(text, [])
    assert P.candidates("ref AB12 3456 on 4 MAY", []) == [(4, 13)]


def test_secrets_are_seeds_and_bring_in_unlike_ones(spark, no_docs):
    """Keys and tokens become spans of their own kind; base columns don't change."""
    rng = random.Random(21)

    def made(chars, n):
        return "".join(rng.choice(chars) for _ in range(n))

    low, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    tokens = [made(low, 40) for _ in range(30)] + ["aZ9" + made(mixed, 33) for _ in range(10)]
    rows = [(k, f'{words(rng, 5)}\ntoken = "{t}" in the file', "en", "s", 0) for k, t in enumerate(tokens)]
    # too short to be a seed, found by its context
    rows.append((100, f'{words(rng, 5)}\ntoken = "{made("0123456789", 9)}" in the file', "en", "s", 0))
    clean = ["a" * 50, "1" * 40, "the-quick-brown-fox-jumps-over-12-lazy-dogs", "/usr/share/Lib/python3/dist/packages/x",
             "internationalisation of 2024 Donaudampfschifffahrtsgesellschaft"]
    rows += [(200 + k, t, "en", "s", 0) for k, t in enumerate(clean)]
    got = {r["doc_id"]: r for r in P.digest(spark.createDataFrame(rows, no_docs.schema)).collect()}
    for k, t in enumerate(tokens):
        at = rows[k][1].index(t)
        assert got[k]["spans"] == f"secret:{at}:{at + len(t)}"
        assert got[k]["base_sha256"] == got[200]["base_sha256"] and got[k]["n_card"] == 0
    assert got[100]["spans"].startswith("secret:")
    assert all(got[200 + k]["spans"] == "" for k in range(len(clean)))


def test_given_secrets_are_found(spark):
    from ledgerframe.llm.common import read_table
    import os
    import re
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        return
    docs = read_table(spark, sf, "documents")
    spans = {r["doc_id"]: r["spans"].split(",") for r in P.digest(docs).select("doc_id", "spans").collect()}
    found = 0
    for r in docs.select("doc_id", "text").collect():
        for m in re.finditer(r'token = "([0-9a-f]{40})"', r["text"] or ""):
            found += 1
            assert f"secret:{m.start(1)}:{m.end(1)}" in spans[r["doc_id"]]
    assert found


def plain_patterns(text, start, end):
    """The words that a plain split finds on either side of the span."""
    lines_before, after = text[:start].rpartition("\n")[2], text[end:].partition("\n")[0]

    def usable(word):
        return len(word) <= P.MAX_WORD and not any(c.isdigit() for c in word)

    left, right = lines_before.split(), after.split()
    if not left or not usable(left[-1]):
        return []
    out = [f"{left[-1]} _".lower()]
    if len(left) > 1 and usable(left[-2]):
        out.append(f"{left[-2]} {left[-1]} _".lower())
    if right and usable(right[0]):
        out.append(f"{left[-1]} _ {right[0]}".lower())
    return out


def test_patterns_match_a_plain_split():
    rng = random.Random(21)
    parts = ["Mail", "to:", "id=", " ", " " * 90, "\n", "\t", "x" * 64, "x" * 65, "y" * 200, "Call", "7", "(", ")", "Ä"]
    for _ in range(3000):
        before = "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
        after = "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
        span = rng.choice(["a@b.co", "4000 1234 9999", "+41 44"])
        text = before + span + after
        start, end = len(before), len(before) + len(span)
        assert P.Words(text).patterns(start, end) == plain_patterns(text, start, end), text


def test_patterns_of_many_spans_in_one_word_take_linear_time():
    text = "k=" + "123456789;" * 200_000
    around, began = P.Words(text), time.monotonic()
    assert all(around.patterns(a, a + 9) == [] for a in range(12, len(text), 10))
    assert time.monotonic() - began < 20
