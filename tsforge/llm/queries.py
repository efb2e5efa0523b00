"""The registered queries opN_<name>: name -> f(spark, sf_dir) -> DataFrame, and
the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.llm import (bpe, decontaminate, fim, html_extract, jaccard_join, lm_score, pii, prefix_trie,
                         quality_rules, rules_classifier, secrets, sharding, substring_dedup)
from tsforge.llm.common import id_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return deco


@query("op4_hypergeometric_shards")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    out = sharding.shard(rows, [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op7_line_frequency")
def op7(spark, sf_dir):
    out = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
                      "quality.n_repeat_words", "quality.base_failed", "quality.kept")


@query("op8_bpe_tree_concatenation")
def op8(spark, sf_dir, tokenizer: str | None = None):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"), ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op9_markov_secrets")
def op9(spark, sf_dir):
    out = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex",
                      F.sha2(F.col("secrets.base").cast("binary"), 256).alias("base_sha256"), "secrets.spans")


@query("op3_spaced_seeds")
def op3(spark, sf_dir):
    """The documents that overlap a benchmark item, with the items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.overlaps(docs, table(spark, sf_dir, "benchmark"))
    best = found.groupBy(F.col("doc.doc_id").alias("doc_id"), "doc_key", "item").agg(
        F.max(F.struct("equal", "of", F.col("at").alias("at"))).alias("b"))
    return best.groupBy("doc_id", "doc_key").agg(
        F.array_sort(F.collect_list("item")).alias("item_ids"), F.count("*").alias("n_items"),
        F.max("b.equal").alias("best_equal"), F.max("b.of").alias("best_of")).drop("doc_key")


@query("op10_rule_ensemble")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(id_mod(F.col("doc_id"), 4) != 2)
    out = rules_classifier.score(docs, rules_classifier.fit(docs, labels))
    return out.select("doc_id", (id_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op6_weak_supervision_pii")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.find(docs, pii.fit(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["base"])
    return out.select("doc_id", *[number(k) for k in pii.KINDS], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


@query("op1_consensus_html")
def op1(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = html_extract.extract(pages)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op5_backoff_automaton")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = lm_score.train(docs, id_mod(F.col("doc_id"), 10) != 0)
    out = lm_score.score(docs, model, counts)
    return out.select("doc_id", (id_mod(F.col("doc_id"), 10) == 0).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


@query("op2_minhash_forest")
def op2(spark, sf_dir):
    return jaccard_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op11_sparse_fim", sql=r"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents),
l as (
  select *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as u,
    ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
    ('0x' || substr(h, 25, 8))::bigint as h4 from d),
c as (
  select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a,
    greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b from l),
p as (
  select *, array_to_string(u[1:a], '') as pre, array_to_string(u[a + 1:b], '') as mid,
    array_to_string(u[b + 1:], '') as suf,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain'
      when h4 % 100 < 50 then 'spm' else 'psm' end as form from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(pre) end as prefix_chars,
  case when form <> 'plain' then length(mid) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
    else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(t) as restored_sha256
from p""")
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = fim.transform(docs).select("doc_id", "fim.*")
    back = fim.restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


@query("op12_fm_substrings", sql=r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents),
g as (
  select doc_id, s, array_to_string(w[s:s + 19], ' ') as words
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as s from d)),
later as (
  select doc_id, s from (select *, row_number() over (partition by words order by doc_id, s) as k from g) where k > 1),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as p from later),
lists as (select doc_id, list(p order by p) as ps, count(*) as n from gone group by doc_id),
kept as (
  select d.doc_id, string_agg(word, ' ' order by p) as t
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d) d
  where not exists (select 1 from gone where gone.doc_id = d.doc_id and gone.p = d.p) group by d.doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join lists using (doc_id) left join kept using (doc_id)""")
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.deduplicated(docs)
    return out.select("doc_id", "dedup.n_words", "dedup.n_removed",
                      F.sha2(F.col("dedup.kept").cast("binary"), 256).alias("kept_sha256"))


@query("op13_rollup_trie", sql="""
with t as (
  select conv_id as c, coalesce(text, '') as x, strlen(coalesce(text, '')) as size,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id, turn
  from conversations where conv_id is not null),
o as (select *, row_number() over (partition by c order by turn nulls first, id, size) - 1 as p from t),
k as (
  select c, c - c % 5 as base, xor(list_reduce(
    flatten(list_transform(string_split(c::varchar, ''), lambda ch: [ascii(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, s: case when s >= 0 then xor(a, s) else xor(a >> 1, case when a % 2 = 1 then 3988292384 else 0 end) end,
    4294967295::bigint), 4294967295) % 9 as h
  from (select distinct c from t)),
r as (
  select k.c, 0 as part, o.p, o.id, o.size from k join o on o.c = k.base where o.p < k.h
  union all select k.c, 1, o.p, o.id, o.size from k join o on o.c = k.c where o.p >= k.h),
paths as (
  select k.c, coalesce(list(r.id order by part, p) filter (id is not null), []) as ids,
    coalesce(list(r.size order by part, p) filter (id is not null), []) as sizes
  from k left join r on r.c = k.c group by k.c),
m as (
  select c, d, len(ids) as n, array_to_string(ids[1:d], '') as prefix, case when d > 0 then sizes[d] else 0 end as size
  from (select *, unnest(range(0, len(ids) + 1)) as d from paths)),
nodes as (
  select prefix, d, min(c) as c, count(*) as n, max(size) as size, sha256(coalesce(string_agg(c::varchar, ',' order by c)
    filter (n = d), '')) as ends_sha256
  from m group by prefix, d),
kids as (select substr(prefix, 1, 32 * (d - 1)) as prefix, count(*) as n from nodes where d > 0 group by 1),
own as (
  select nodes.*, coalesce(kids.n, 0) as n_children, (nodes.n - 1) * size as saved
  from nodes left join kids on kids.prefix = nodes.prefix),
subtree as (
  select substr(prefix, 1, 32 * up) as prefix, sum((n_children = 0)::bigint)::bigint as n_leaves,
    sum(saved)::bigint as saved_tokens
  from (select *, unnest(range(0, d + 1)) as up from own) group by 1)
select own.c as conv_id, own.d as depth, parent.c as parent_conv_id, own.n as n_convs, own.n_children, n_leaves,
  saved_tokens, own.ends_sha256
from own join subtree on subtree.prefix = own.prefix
left join nodes as parent on own.d > 0 and parent.prefix = substr(own.prefix, 1, 32 * (own.d - 1))
""")
def op13(spark, sf_dir):
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.rebuilt(turns))
