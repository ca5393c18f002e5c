"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerframe.llm import (
    ann_srs, decontaminate, importance, license_rules, line_spread, minmax_dedup, mixing, pii_bootstrap, simhash,
    source_divergence, substring_windows, token_counts, toxicity)
from ledgerframe.llm.common import read_table


QUERY_STEP = 20  # the contract's query set


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann_srs.neighbours(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


def op2_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_windows.shared_passages(read_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.report(read_table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op9_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_spread.remove_boilerplate(read_table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", F.col("removed").alias("removed_lines"), F.col("text").alias("clean_text"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.digest(read_table(spark, sf_dir, "documents"))


def op11_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_shared_passages": op2_shared_passages,
    "op3_token_counts": op3_token_counts,
    "op4_licenses": op4_licenses,
    "op5_mix_sources": op5_mix_sources,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_line_spread": op9_line_spread,
    "op10_personal_data": op10_personal_data,
    "op11_minmax": op11_minmax,
    "op12_resample": op12_resample,
    "op13_divergence": op13_divergence,
}

#: The distinct-site rule of operator 9, counted exactly.
_LINE_SPREAD_SQL = f"""
with docs as (
    select row_number() over () as r, doc_id, coalesce('=' || source, '') as site, text from documents),
texts as (select text, min(site) as site from docs group by text),
cut as (
    select r, docs.text, texts.site, unnest(string_split(docs.text, chr(10))) as raw,
           generate_subscripts(string_split(docs.text, chr(10)), 1) as pos
    from docs join texts on docs.text = texts.text),
lines as (select *, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) as line from cut),
wide as (
    select line from lines where line <> '' group by line
    having count(distinct site) >= {line_spread.MIN_SITES}),
marked as (select lines.*, wide.line is not null as goes from lines left join wide using (line)),
less as (
    select r, coalesce(string_agg(raw, chr(10) order by pos) filter (where not goes), '') as rest,
           count(*) filter (where goes) as n
    from marked group by r)
select doc_id, coalesce(n, 0) as removed_lines, if(coalesce(n, 0) > 0, rest, text) as clean_text
from docs left join less using (r)
"""

#: All pairs of sets that share a shingle, counted; components by closure.
_MINMAX_SQL = r"""
with recursive docs as (
    select row_number() over () as r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x20\x09-\x0D]+') as w
    from documents),
sets as (
    select r, doc_id, list_sort(list_distinct(
        case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
             else [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)] end)) as s
    from docs),
classes as (
    select min(r) as c, min(doc_id) as first, s, len(s) as n from sets where len(s) > 0 group by s),
grams as (select c, n, unnest(s) as g from classes),
links as (
    select a.c as a, b.c as b
    from grams a join grams b on a.g = b.g and a.c <> b.c and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    group by a.c, b.c, a.n, b.n
    having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach as (
    select c as a, c as b from classes
    union
    select reach.a, links.b from reach join links on reach.b = links.a),
least as (
    select reach.a as c, min(classes.first) as component_id
    from reach join classes on reach.b = classes.c group by 1)
select doc_id, len(sets.s) as n_shingles,
       case when len(sets.s) = 0 then doc_id else component_id end as component_id,
       doc_id is not distinct from case when len(sets.s) = 0 then doc_id else component_id end as kept
from sets left join classes using (s) left join least using (c)
"""

#: Shares of all kept terms in all groups, written out.
_DIVERGENCE_SQL = r"""
with docs as (
    select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words
    from documents),
groups as (select distinct lang, source from docs),
seen as (select r, lang, source, unnest(words) as term from docs),
counted as (select lang, source, term, count(*) as n from seen group by all),
kept as (
    select lang, term, count(*) as n from seen group by lang, term
    having count(distinct r) >= 30),
sizes as (select lang, count(*) as v, sum(n) as total from kept group by lang),
cells as (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.n as lang_n
    from groups g join kept k on g.lang = k.lang
    left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term),
totals as (select lang, source, sum(n) as total from cells group by lang, source),
shares as (
    select lang, source, term, cells.n,
           1 + (1000000000 * (cells.n::hugeint + 5)) // (totals.total + 5 * v) as p,
           1 + (1000000000 * (lang_n::hugeint + 5)) // (sizes.total + 5 * v) as q
    from cells join totals using (lang, source) join sizes using (lang)),
apart as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by all),
found as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join apart on apart.lang = a.lang and apart.source = a.source and apart.item = b.source
    union all
    select lang, source, 'term', term, p - q from shares where n > 0 and p > q),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from found)
select lang, source, part, item, value::bigint as value, rank::integer as rank
from ranked where part = 'pair' or rank <= 50
"""

ORACLES = {"op9_line_spread": _LINE_SPREAD_SQL, "op11_minmax": _MINMAX_SQL, "op13_divergence": _DIVERGENCE_SQL}
