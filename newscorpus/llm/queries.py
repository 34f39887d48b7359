"""The operators of this package on the given tables, as registered queries."""

from __future__ import annotations

import math

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newscorpus.llm import (
    alignment,
    classifier,
    decontaminate,
    filter_audit,
    langid,
    lm,
    pieces,
    quality,
    secrets,
    simhash,
    suffix_trees,
    suffixes,
    tokencount,
)
from newscorpus.llm.common import held_out, table
from newscorpus.sources.scratch import new_path


def op4_tokens(spark: SparkSession, sf: str) -> DataFrame:
    found = tokencount.token_counts(
        table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit")
    )


def op5_lines(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.line_clean(table(spark, sf, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lost_words",
    )


def op6_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    found = suffixes.repeats(table(spark, sf, "documents"), window=50)
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def encoded(docs: DataFrame) -> DataFrame:
    """Ids of every text in digest form, and whether they decode to it again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(docs, model, decoded=True).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_ids"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


def op7_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return encoded(table(spark, sf, "documents"))


def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf, "documents"), shingle=3, radius=3)
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op1_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    ledger = new_path(spark, "ledger")
    secrets.commit(docs, ledger)
    found = secrets.findings(docs, ledger)
    base = F.filter("findings", lambda f: f["kind"].isin(*secrets.BASE))

    def of(kind: str):
        n = F.size(F.filter("findings", lambda f: f["kind"] == kind))
        return n.cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *map(of, secrets.BASE),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("findings")).alias("spans"),
    )


def language_profiles(docs: DataFrame) -> langid.Profiles:
    """Learned from the documents that are not held out."""
    return langid.train(docs.where(~held_out("doc_id", 5, 0)))


def op2_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = langid.identify(docs, language_profiles(docs))
    return found.select(
        F.col("id").alias("doc_id"), held_out("id", 5, 0).alias("held_out"), "lang_pred", "score"
    )


def op3_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.decontaminate(
        table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=10, gram=5
    )
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = lm.train(docs.where(~held_out("doc_id", 10, 0)))
    found = lm.score(docs, model)
    return found.select(
        F.col("id").alias("doc_id"),
        held_out("id", 10, 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        (F.col("bits") * -math.log10(2)).alias("score"),
        "bits_per_byte",
    )


def op10_boosting(spark: SparkSession, sf: str) -> DataFrame:
    described = classifier.describe(table(spark, sf, "documents"))
    labels = table(spark, sf, "labels").where(~held_out("doc_id", 3, 1))
    found = classifier.score(described, classifier.fit(described, labels))
    return found.select(
        F.col("id").alias("doc_id"),
        held_out("id", 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    found = alignment.align(
        table(spark, sf, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    return found.select(
        F.col("id").alias("doc_id"),
        *["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"],
        F.when(F.col("n_groups") == 0, "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
    )


def op12_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = filter_audit.described(table(spark, sf, "documents"), "doc_id", "text", "lang")
    rows = filter_audit.repeats_smaller(rows, "id", "digest", "repeated")
    rows = filter_audit.with_marks(rows, table(spark, sf, "labels"), "doc_id", ["quality", "toxic"])
    found = filter_audit.audit(
        rows,
        {
            "A": F.col("n_words") < 100,
            "B": 100 * F.col("n_distinct") < 80 * F.col("n_words"),
            "C": 100 * F.col("n_capitals") > 10 * F.col("n_chars"),
            "D": F.col("symbols"),
            "E": F.col("repeated"),
        },
        F.col("part"),
        {"good": F.col("quality"), "toxic": F.col("toxic")},
    )
    return found.withColumnsRenamed({"lost_good": "good_lost", "lost_toxic": "toxic_lost"})


def op13_suffix_trees(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_trees.repeats(table(spark, sf, "documents"), window=20)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_language": op2_language,
    "op3_winnowing": op3_winnowing,
    "op4_tokens": op4_tokens,
    "op5_lines": op5_lines,
    "op6_suffixes": op6_suffixes,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_boosting": op10_boosting,
    "op11_alignment": op11_alignment,
    "op12_audit": op12_audit,
    "op13_suffix_trees": op13_suffix_trees,
}


_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL: dict[str, str] = {
    "op3_winnowing": rf"""
with d as (select doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
win as (select distinct item_id, least(len(w), 10) as n,
               array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') as g
        from b, unnest(range(greatest(len(w) - 9, 1))) t(i) where len(w) > 0),
lengths as (select distinct n from win),
grams as (select doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') as g
          from d, lengths, unnest(range(len(w) - n + 1)) t(i) where len(w) >= n),
hits as (select g.doc_id, g.i, g.n, win.item_id from grams g join win on g.n = win.n and g.g = win.g),
words as (select doc_id, count(distinct i + k) as n_hit from hits, unnest(range(n)) t(k) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
          from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)""",
    "op5_lines": r"""
with d as (
  select doc_id, coalesce(text, '') as t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
g as (select doc_id, i, array_to_string(w[i + 1 : i + 3], ' ') as g
      from d, unnest(range(len(w) - 2)) t(i) where len(w) > 2),
twice as (select doc_id, unnest(list(i)) as i from g group by doc_id, g having count(*) > 1),
rep as (select doc_id, count(distinct i + k) as n from twice, unnest(range(3)) t(k) group by doc_id),
lines as (select doc_id, unnest(l) as x from d),
m as (
  select doc_id, x, len(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) as n,
         length(x) as c, length(regexp_replace(x, '\P{L}+', '', 'g')) as letters,
         length(regexp_replace(x, '\P{Lu}+', '', 'g')) as capitals,
         length(x) - length(regexp_replace(x, '[#*$%&|<>{}\\^~=_]', '', 'g')) as symbols,
         regexp_matches(x, '(?i)^\s*(home|menu|search|log ?in|sign (in|up)|next|previous|back|skip to content|read more|click here|share|subscribe|contact( us)?|about( us)?|sitemap)\s*[|>»·:]?\s*$|(\s[|>»·]\s[^|>»·]*){3}') as navigation,
         regexp_matches(x, '(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie policy|use cookies|enable javascript|lorem ipsum|powered by|licensed under|copyright \(c\))|©') as boilerplate,
         regexp_matches(x, '[.!?…:;。！？"”’'')\]]\s*$|[.!?…。！？]["”’'')\]]?\s') as ended
  from lines),
lost as (
  select doc_id, sum(n) as n from m
  where navigation or boilerplate or symbols * 100 > c * 10
     or (capitals * 100 > letters * 60 and letters >= 20) or (n >= 8 and not ended)
  group by doc_id),
base as (
  select d.doc_id, cast(len(w) as bigint) as n_words,
         cast(length(array_to_string(w, '')) as bigint) as word_chars,
         cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols,
         cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
         cast(coalesce(rep.n, 0) as bigint) as n_repeat_words,
         cast(coalesce(lost.n, 0) as bigint) as n_lost_words
  from d left join rep using (doc_id) left join lost using (doc_id))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
       and 100 * n_lost_words <= 50 * n_words as kept
from base""",
    "op12_audit": r"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
f as (
  select doc_id, part, len(w) < 100 as a, 100 * len(list_distinct(w)) < 80 * len(w) as b,
         100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) as c,
         regexp_matches(t, '[#$%&*|]') as d, doc_id > min(doc_id) over (partition by t) as e
  from d),
l as (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id),
m as (
  select part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as mask, count(*) as n,
         count(*) filter (quality = 1) as good, count(*) filter (toxic = 1) as toxic
  from f left join l using (doc_id) group by all),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as name, unnest([1, 2, 4, 8, 16]) as bit),
orders as (
  select [p, q, r, s, t] as o, p.name || q.name || r.name || s.name || t.name as filter_order
  from x p, x q, x r, x s, x t
  where len(list_distinct([p.bit, q.bit, r.bit, s.bit, t.bit])) = 5),
steps as (
  select filter_order, k as step, o[k].name as name, o[k].bit as bit,
         coalesce(list_sum(list_transform(o[1 : k - 1], lambda y: y.bit)), 0)::int as before
  from orders, unnest([1, 2, 3, 4, 5]) u(k)),
per_step as (
  select part, filter_order, step, name,
         cast(sum(n) filter (mask & (before | bit) = 0) as bigint) as kept,
         cast(sum(n) filter (mask & before = 0 and mask & bit > 0) as bigint) as removed,
         cast(sum(n) filter (mask & before > 0 and mask & bit > 0) as bigint) as redundant,
         cast(sum(n) filter (mask = bit) as bigint) as unique_fails,
         cast(sum(good) filter (mask & before = 0 and mask & bit > 0) as bigint) as good_lost,
         cast(sum(toxic) filter (mask & before = 0 and mask & bit > 0) as bigint) as toxic_lost
  from m, steps group by all)
select part, filter_order, step, coalesce(kept, 0) as kept, coalesce(removed, 0) as removed,
       coalesce(redundant, 0) as redundant, coalesce(unique_fails, 0) as unique_fails,
       coalesce(good_lost, 0) as good_lost, coalesce(toxic_lost, 0) as toxic_lost,
       cast(sum(coalesce(removed, 0)) over (partition by part, name) as bigint) as shapley
from per_step""",
}
