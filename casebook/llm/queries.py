"""The operators of this package as registered queries, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casebook.llm import (
    alignment,
    byte_bpe,
    decontamination,
    fill_in_middle,
    jaccard_join,
    mixing,
    repeats,
    secrets,
    sharding,
    token_counts,
    token_files,
    top_k,
    toxicity,
)
from casebook.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: Shares of the bytes; all other sources share the rest in proportion to their sizes.
TARGETS = {"src0": 0.2, "src1": 0.1, "src2": 0.02}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), TARGETS)


#: Rows are told by their ids, which all rows of these tables have.
OP1_SQL = """
with d as (
  select *, case when source in ('src0', 'src1', 'src2') then source end as g,
    ((('0x' || substr(md5('mix|' || coalesce(cast(doc_id as varchar), '')), 1, 13))::bigint)::double + 0.5)
      / 4503599627370496.0 as u
  from documents),
sized as (select g, sum(coalesce(strlen(text), 0))::double as bytes from d group by g),
rated as (
  select g, coalesce(w * sum(bytes) over () / nullif(bytes, 0), 0) as rate
  from (select *, case g when 'src0' then 0.2::double when 'src1' then 0.1::double when 'src2' then 0.02::double
          else 1.0::double - (0.2::double + 0.1::double + 0.02::double) end as w from sized)),
terms as (
  select g, rate, k, case when rate > 0 then exp(k * ln(rate) - rate - lf) when k = 0 then 1.0 else 0.0 end as p
  from (
    select g, rate, k, sum(case when k > 0 then ln(k) else 0.0 end) over (partition by g order by k) as lf
    from (select g, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::bigint + 1)) as k from rated))),
reached as (
  select g, rate, list(c order by k) as cs
  from (select g, rate, k, sum(p) over (partition by g order by k) as c from terms) group by g, rate),
counted as (
  select d.*, rate, len(list_filter(cs, lambda c: c <= d.u))::integer as repeats
  from d join reached r on d.g is not distinct from r.g),
copies as (select *, unnest(range(1, repeats::bigint + 1))::integer as copy_no from counted where repeats > 0)
select * exclude (g, u), md5('mix|' || coalesce(cast(doc_id as varchar), '') || '|' || copy_no) as shuffle_key
from copies
"""


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
  from scored)
select * from ranked where rank <= 10
"""


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
with texts as (
  select 'd' as kind, doc_id as id, text from documents union all select 'b', item_id, text from benchmark),
worded as (
  select kind, id,
    list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w
  from texts),
shingled as (
  select distinct kind, id, array_to_string(w[i : i + 4], ' ') as s
  from (select kind, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from worded where len(w) > 0)
  union
  select kind, id, array_to_string(w[i : i + m - 1], ' ')
  from (select kind, id, w, m, unnest(range(1, len(w) - m + 2)) as i
        from worded, (select distinct len(w) as m from worded where kind = 'b' and len(w) between 1 and 4)
        where kind = 'd' and len(w) > m)),
asked as (select id, s, count(*) over (partition by id) as n from shingled where kind = 'b'),
shared as (
  select d.id as doc_id, a.id as item_id, a.n::integer as item_shingles, count(*)::integer as shared_shingles
  from shingled d join asked a on d.s = a.s where d.kind = 'd' group by d.id, a.id, a.n)
select *, shared_shingles / item_shingles as containment from shared
where 100 * shared_shingles >= 80 * item_shingles
"""


def vocabulary(spark: SparkSession, name: str) -> str:
    """Where a public tokenizer's file lies: below spark.casebook.tokenizers, or in the installed package."""
    folder = spark.conf.get("spark.casebook.tokenizers", None)
    if folder:
        return f"{folder.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary(spark, "word_bpe_49k.json"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokenize_to_files(table(spark, sf_dir, "documents"), vocabulary(spark, "byte_bpe_50k.json"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


#: Grams are told by their md5; the parts only keep the texts short from which they are cut.
OP7_SQL = r"""
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, ''))::bigint as n from documents),
parts as (
  select doc_id, q, h[2 * q + 1 : 2 * q + 2 * 1049] as part, least(1000, n - 49 - q) as here
  from (select *, unnest(range(0, n - 49, 1000)) as q from texts where n >= 50)),
grams as (
  select doc_id, q + i as p, md5_number(part[2 * i + 1 : 2 * i + 100]) as g
  from (select *, unnest(range(0, here)) as i from parts)),
covered as (
  select doc_id, p from (select *, min(doc_id) over (partition by g) as first_id from grams) where first_id < doc_id),
runs as (
  select doc_id, min(p) as a, max(p) + 50 as b, run
  from (select *, sum(fresh) over (partition by doc_id order by p rows unbounded preceding) as run
        from (select *, case when p <= lag(p) over (partition by doc_id order by p) + 50 then 0 else 1 end as fresh from covered))
  group by doc_id, run),
cut as (
  select doc_id, count(*) as n_spans, sum(b - a) as n_removed, list(b order by a) as ends, list(a order by a) as starts
  from runs group by doc_id)
select t.doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(case when starts is null then h else
    array_to_string(list_transform(range(0, len(starts) + 1),
      lambda i: h[2 * (case when i = 0 then 0 else ends[i] end) + 1 : 2 * (case when i = len(starts) then n else starts[i + 1] end)]), '') end))
    as kept_sha256
from texts t left join cut using (doc_id)
"""


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingled as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from worded where len(w) > 0)),
sized as (
  select d.doc_id, count(s) as n from documents d left join shingled s on d.doc_id = s.doc_id group by d.doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as same
  from shingled a join shingled b on a.s = b.s and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
links as (
  select a, b from shared join sized x on x.doc_id = a join sized y on y.doc_id = b
  where 100 * same >= 80 * (x.n + y.n - same)),
reached as (
  select doc_id, doc_id as component_id from sized
  union
  select b, component_id from reached join links on a = doc_id)
select doc_id, any_value(n)::bigint as n_shingles, min(component_id) as component_id
from reached join sized using (doc_id) group by doc_id
"""


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.rearranged(table(spark, sf_dir, "documents")))


OP11_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
lined as (
  select *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') as lines, ('0x' || substr(h, 1, 8))::bigint as h1,
    ('0x' || substr(h, 9, 8))::bigint as h2, ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
  from d),
ranked as (
  select *, len(lines) as n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) as a,
    greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100
      then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form
  from lined),
cut as (
  select *, array_to_string(lines[1 : a], '') as prefix, array_to_string(lines[a + 1 : b], '') as middle,
    array_to_string(lines[b + 1 :], '') as suffix
  from ranked)
select doc_id, n::bigint as n, form,
  case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(prefix || middle || suffix) as restored_sha256
from cut
"""


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary(spark, "byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"), path, byte_pattern()), path))


def byte_pattern() -> str:
    """How texts are cut before the merges of the rank files, as the tokenizers' package has it."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte, piece = vocabulary(spark, "byte_bpe_50k.json"), vocabulary(spark, "piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), byte, piece)


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_top_k": op2_top_k,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_token_files": op5_token_files,
    "op6_sharding": op6_sharding,
    "op7_repeats": op7_repeats,
    "op8_secrets": op8_secrets,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_alignment": op13_alignment,
}
ORACLE_SQL: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op2_top_k": OP2_SQL,
    "op3_decontamination": OP3_SQL,
    "op7_repeats": OP7_SQL,
    "op9_jaccard_join": OP9_SQL,
    "op11_fill_in_middle": OP11_SQL,
}
