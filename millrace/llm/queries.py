"""Named queries of this package over the test tables, and the SQL that some must equal."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    cover_tree, language_id, language_model, licenses, packing, pfair, phrases, quality, quotations,
    simhash, toxicity, url_rules, variants,
)
from millrace.llm.common import crc_remainder, read
from millrace.plans.registry import query

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: Fixed values of the contract: host, path, verdict.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

QUALITY_SQL = r"""
with words as (
  select rowid as row, doc_id, coalesce(text, '') as body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from (select row_number() over () as rowid, * from documents)
), runs as (
  select row, i, w[i:i+4] as run
  from words, unnest(generate_series(1, len(w) - 4)) as t(i)
), repeated as (
  select row, i from (
    select row, i, count(*) over (partition by row, run) as n from runs
  ) where n > 1
), covered as (
  select row, count(distinct i + k) as n_repeat_words
  from repeated, unnest([0, 1, 2, 3, 4]) as t(k) group by row
), lines as (
  select row, list_filter(string_split(body, chr(10)),
                          lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from words
), measured as (
  select words.row, doc_id, len(w)::bigint as n_words,
         length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         len(l)::bigint as n_lines,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from words join lines using (row) left join covered using (row)
), bits as (
  select *,
    (case when n_words < 10 then 1 else 0 end
     + case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end
     + case when 10 * n_symbols > word_chars then 4 else 0 end
     + case when n_lines >= 4 and 2 * n_dup_lines > n_lines then 8 else 0 end
     + case when word_chars < 2 * n_words then 16 else 0 end
     + case when word_chars > 20 * n_words then 32 else 0 end)::bigint as failed_bits
  from measured
)
select doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
       failed_bits,
       (case when bit_count(failed_bits) = 1 then failed_bits else 0 end)::bigint as sole_bits,
       (failed_bits & 3) <> 0 as base_failed, failed_bits = 0 as kept
from bits
"""


@query(QUALITY_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query()
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(read(spark, sf_dir, "documents"), licenses.train())


#: Rounding apart, the links are those of all pairs; the components are a recursive query.
EMBEDDING_SQL = """
with recursive valid as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b
  from valid a join valid b
    on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
   and list_dot_product(a.v, b.v)
       >= 0.95 * sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))
), reach(node, least) as (
  select vec_id, vec_id from embeddings
  union
  select links.b, reach.least from reach join links on reach.node = links.a
   where reach.least < links.b
), counts as (
  select a, count(*) as n from links group by a
)
select vec_id, coalesce(any_value(n), 0)::bigint as n_links, min(least)::bigint as component_id,
       vec_id = min(least) as kept
from embeddings join reach on node = vec_id left join counts on a = vec_id
group by vec_id
"""


@query(EMBEDDING_SQL)
def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.linked(read(spark, sf_dir, "embeddings"))


@query()
def op4_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.conversations(read(spark, sf_dir, "conversations"))


@query()
def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(read(spark, sf_dir, "documents"))


URL_SQL = r"""
with rules(rule_host, rule_path, rule_verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
         ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), rests as (
  select page_id, case when contains(url, '://')
                       then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), urls as (
  select page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from rests
)
select page_id, host, path, fit[2] as rule, coalesce(fit[3], 'allow') as verdict
from (
  select page_id, host, path, (
    select max([lpad((length(rule_host) + length(rule_path))::varchar, 9, '0'),
                rule_host || rule_path, rule_verdict])
    from rules
    where (host = rule_host or ends_with(host, '.' || rule_host))
      and starts_with(path, rule_path)
  ) as fit
  from urls
)
"""


@query(URL_SQL)
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rules_table(spark, URL_RULES)
    return url_rules.match_rules(read(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@query()
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return pfair.schedule(docs).drop("text")


@query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), TOKENIZER)


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id",
        (crc_remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query()
def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(read(spark, sf_dir, "documents"))


PHRASES_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), spelled as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), totals as (
  select lang, sum(len(w))::bigint as n from spelled group by lang
), counts as (
  select lang, words, count(*) as f
  from (select lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda m: list_transform(
          generate_series(1, len(w) - m + 1), lambda i: w[i:i + m - 1])))) as words
        from spelled)
  group by 1, 2 having count(*) >= 30
), cuts as (
  select c.lang, c.words, a, k, l.f as l, r.f as r,
         ((2000000::hugeint * a) // (l.f + r.f))::bigint as score
  from (
    select lang, words, f as a, k, words[1:k] as head, words[k + 1:] as tail
    from (select *, unnest(generate_series(1, len(words) - 1)) as k from counts)
  ) c
  join counts l on l.lang = c.lang and l.words = head
  join counts r on r.lang = c.lang and r.words = tail
), best as (
  select * from cuts qualify row_number() over (partition by lang, words order by score, k) = 1
), inner_words as (
  select lang, part as words, max(f) as longer
  from (select lang, f, unnest(flatten(list_transform(generate_series(2, len(words) - 1),
          lambda m: list_transform(generate_series(1, len(words) - m + 1),
                                   lambda i: words[i:i + m - 1])))) as part
        from counts)
  group by 1, 2
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
       phrase, a, l, r, n, score
from (
  select lang, array_to_string(words, ' ') as phrase, a, l, r, score
  from best left join inner_words using (lang, words)
  where longer is null or 100 * longer < 80 * a
) join totals using (lang)
qualify rank <= 2000
"""


@query(PHRASES_SQL)
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


@query()
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    known = language_id.learn(docs)
    judged = language_id.identified(docs.select("doc_id", "text"), known)
    return judged.select(
        "doc_id", (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "lang_pred", "score", "rejected",
    )
