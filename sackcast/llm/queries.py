"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import collocations, decontaminate, html_text, jaccard_join, licenses, mixing, packing, quality, secret_scan, substring_dedup, suffix_dedup, topk, turn_trie


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup_bytes(_table(spark, sf_dir, "documents")).drop("kept")


def op2_license_scan(spark, sf_dir):
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark, sf_dir):
    return substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents")).drop("kept")


def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op5_mixing(spark, sf_dir):
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op6_exact_topk(spark, sf_dir):
    return topk.exact_top_k(topk.scaled_vectors(_table(spark, sf_dir, "embeddings")))


def op7_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, _table(spark, sf_dir, "labels"))
    return quality.rate_quality(docs.select("doc_id", "text"), model).drop("text")


def op8_secret_scan(spark, sf_dir):
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))


def op9_html_text(spark, sf_dir):
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op10_decontamination(spark, sf_dir):
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_turn_trie(spark, sf_dir):
    return turn_trie.shared_openings(_table(spark, sf_dir, "conversations"))


def op12_collocations(spark, sf_dir):
    return collocations.mine_collocations(_table(spark, sf_dir, "documents"))


def op13_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_license_scan, op3_substring_dedup, op4_jaccard_join, op5_mixing, op6_exact_topk, op7_quality, op8_secret_scan, op9_html_text, op10_decontamination, op11_turn_trie, op12_collocations, op13_packing)}

#: Places of every phrase of 1 to 3 words by plain n-grams, then cuts and ranks as the operator's contract says.
_COLLOCATIONS = """
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
lists as (select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from pieces),
grams as materialized (
  select lang, m, unnest(list_transform(range(1, len(w) + 2 - m), lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
  from lists cross join (values (1), (2), (3)) v(m) where len(w) >= m),
f as materialized (select lang, m, phrase, count(*) as c from grams group by all),
totals as (select lang, sum(c) as n from f where m = 1 group by lang),
cand as materialized (select lang, m, phrase, c as a, string_split(phrase, ' ') as w from f where m >= 2 and c >= 10),
parts as (
  select lang, m, phrase, a, k, array_to_string(w[1:k], ' ') as head, array_to_string(w[k + 1:m], ' ') as rest
  from cand cross join (values (1), (2)) v(k) where k < m),
cuts as (
  select parts.*, x.c as l, y.c as r, (1000000::hugeint * a * a) // (x.c::hugeint * y.c) as score
  from parts join f x on x.lang = parts.lang and x.phrase = parts.head join f y on y.lang = parts.lang and y.phrase = parts.rest),
least as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
  select lang, phrase, max(a) as whole from (
    select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase from cand where m = 3)
  group by lang, phrase),
kept as (
  select least.* from least left join inside using (lang, phrase)
  where inside.whole is null or m = 3 or 100 * inside.whole < 50 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
       cast(n as bigint) as n, cast(score as bigint) as score
from ranked join totals using (lang) where rank <= 2000
"""

#: Every prefix of the rebuilt conversations as a list; the checksum that deals the openings, bit by bit.
_TRIE = """
with recursive rows_ as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, role, text) as k,
         coalesce(role, '') as r, coalesce(text, '') as x
  from conversations where conv_id is not null),
ids as (select distinct c from rows_),
crc as (
  select c, cast(c as varchar) as s, 0 as i, cast(4294967295 as bigint) as v from ids
  union all
  select c, s, i + 1, list_reduce(
    [xor(v, cast(ascii(s[i + 1]) as bigint)), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: case when a % 2 = 1 then xor(a // 2, cast(3988292384 as bigint)) else a // 2 end)
  from crc where i < length(s)),
h as (select c, xor(v, cast(4294967295 as bigint)) % 4 as h, c - ((c % 20) + 20) % 20 as b from crc where i = length(s)),
turns as (
  select h.c, 0 as src, t.k, t.r, t.x from h join rows_ t on t.c = h.b and t.k <= h.h
  union all
  select h.c, 1 as src, t.k, t.r, t.x from h join rows_ t on t.c = h.c and t.k > h.h),
paths as (
  select c, row_number() over w as d, list({'r': r, 'x': x}) over w as p, x
  from turns window w as (partition by c order by src, k rows between unbounded preceding and current row)
  union all
  select c, 0 as d, [] as p, '' as x from ids),
long_ as (select c, max(d) as len from paths group by c),
named as (select p.c, p.d, p.x, l.len, min(p.c) over (partition by p.d, p.p) as node from paths p join long_ l using (c)),
nodes as (
  select node, d, count(*) as n, len(list_filter(string_split_regex(any_value(x), '[\\x20\\x09-\\x0D]+'), lambda y: y <> '')) as words,
         sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where len = d), '')) as ends_sha256
  from named group by node, d),
parents as (select n.node, n.d, m.node as parent from nodes n join named m on m.c = n.node and m.d = n.d - 1),
kids as (select parent as node, d - 1 as d, count(*) as n_children from parents group by all),
full_ as (select n.*, coalesce(k.n_children, 0) as n_children from nodes n left join kids k using (node, d)),
sums as (
  select a.node, a.d, sum(case when f.n_children = 0 then 1 else 0 end) as n_leaves, sum((f.n - 1) * f.words) as saved
  from full_ f join named a on a.c = f.node and a.d <= f.d group by a.node, a.d)
select f.node as conv_id, cast(f.d as bigint) as depth, p.parent as parent_conv_id, cast(f.n as bigint) as n_convs,
       cast(f.n_children as bigint) as n_children, cast(s.n_leaves as bigint) as n_leaves, cast(s.saved as bigint) as saved_tokens, f.ends_sha256
from full_ f left join parents p using (node, d) join sums s using (node, d)
"""

#: Every window of 20 words; those that also start earlier cover the words that go.
_REPEATED = """
with docs as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
starts as (select doc_id, unnest(range(1, len(w) - 18)) as i, w from docs where len(w) >= 20),
windows as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as run from starts),
again as (select doc_id, i from windows qualify row_number() over (partition by run order by doc_id, i) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as j from again),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as j from docs),
kept as (
  select w.doc_id, count(g.j) as n_removed, coalesce(string_agg(word, ' ' order by w.j) filter (where g.j is null), '') as rest
  from words w left join gone g on g.doc_id = w.doc_id and g.j = w.j group by w.doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(rest, '')) as kept_sha256
from docs d left join kept using (doc_id)
"""

#: All inner products of whole numbers.
_TOP = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as c
  from embeddings where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select q.vec_id as query_id, v.vec_id, list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * v.c[i])) as score
  from v q join v on v.vec_id <> q.vec_id and len(v.c) = len(q.c) where q.vec_id % 100 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, cast(score as bigint) as score
from scores qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
"""

#: All pairs that share a shingle, then everything reachable by links.
_LINKED = """
with recursive docs as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as materialized (
  select doc_id, case when len(w) >= 4 then list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from docs),
spread as materialized (select doc_id, len(s) as n, unnest(s) as shingle from sets),
shared as (
  select a.doc_id as x, b.doc_id as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as common
  from spread a join spread b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
links as materialized (
  select x, y from shared where 100 * common >= 85 * (nx + ny - common)
  union all select y, x from shared where 100 * common >= 85 * (nx + ny - common)),
reach as (
  select x as doc_id, x as r from links
  union
  select l.y, reach.r from reach join links l on l.x = reach.doc_id)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(c.component_id, s.doc_id) as component_id,
       case when len(s.s) = 0 then s.doc_id else min(s.doc_id) over (partition by list_sort(s.s)) end as class_id
from sets s left join (select doc_id, min(r) as component_id from reach group by doc_id) c on c.doc_id = s.doc_id
"""

ORACLE: dict[str, str] = {"op4_jaccard_join": _LINKED, "op3_substring_dedup": _REPEATED, "op6_exact_topk": _TOP, "op11_turn_trie": _TRIE, "op12_collocations": _COLLOCATIONS}
