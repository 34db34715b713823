"""One query per operator of this folder, with production settings, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stayscope.llm import (
    bpe,
    conversation_repair,
    decontaminate,
    html_density,
    kneser_ney,
    language_zstd,
    reversed_search,
    simhash_bktree,
    substring_dedup,
    token_counts,
    token_store,
    topk_tiles,
    warc_archive,
)
from stayscope.session import shared_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every text without the 50-word windows of earlier documents; see `substring_dedup`."""
    return substring_dedup.digests(substring_dedup.remove_repeats(_table(spark, folder, "documents"), length=50))


OP1_SQL = r"""
with words as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents
), windows as (
  select doc_id, p, array_to_string(w[p:p + 49], ' ') as body
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as p from words where len(w) >= 50)
), seen as (
  select md5(body) as body, min(doc_id) as least from windows group by 1
), repeated as (
  select distinct doc_id, p from windows x join seen on md5(x.body) = seen.body where x.doc_id > least
), places as (
  select doc_id, w, unnest(range(1, len(w) + 1)) as i from words
), covered as (
  select doc_id, i from repeated, unnest(range(p, p + 50)) t(i) group by 1, 2
), marked as (
  select p.doc_id, p.i, p.w[p.i] as word, c.i is not null as gone
  from places p left join covered c on c.doc_id = p.doc_id and c.i = p.i
), summed as (
  select doc_id, count(*) as n_words, count(*) filter (gone) as n_removed,
         string_agg(word, ' ' order by i) filter (not gone) as kept
  from marked group by 1
)
select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from documents d left join summed s on s.doc_id = d.doc_id
"""


def op2_simhash_bktree(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of 3-word shingles and component at 2 bits of every text; see `simhash_bktree`."""
    found = simhash_bktree.near_duplicates(_table(spark, folder, "documents"), shingle=3, radius=2)
    return simhash_bktree.digests(found)


def op3_html_density(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page; see `html_density`."""
    return html_density.extract(_table(spark, folder, "pages"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items that stand in every text, up to an edit per 16 characters; see `decontaminate`."""
    found = decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return decontaminate.digests(found)


def op5_language_zstd(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text by dictionaries fitted on three quarters of the ids; see `language_zstd`."""
    docs = _table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    found = language_zstd.identify(docs, language_zstd.fit_dictionaries(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin")


def op6_topk_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best candidates of every twentieth vector; see `topk_tiles`."""
    vectors = topk_tiles.quantised(_table(spark, folder, "embeddings"), scale=64)
    return topk_tiles.top_k(vectors.filter("vec_id % 20 = 0"), vectors, k=20)


OP6_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as e
  from embeddings
  where embedding is not null and list_count(embedding) = len(embedding)
    and len(list_filter(embedding, lambda x: not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id and len(c.e) = len(q.e)
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every text from counts per distinct pre-token; see `token_counts`."""
    return token_counts.token_counts(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512
    )


def op8_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Every text's ids written to the coded files and read back; see `token_store`."""
    store = shared_folder(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_store.write_store(_table(spark, folder, "documents"), path, store, end_id=0)
    return token_store.read_digests(spark, store)


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text by the multi-language ranks, decoded again; see `bpe`."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(_table(spark, folder, "documents"), path)
    return bpe.digests(bpe.decode(encoded, path))


def op10_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity of every text under a model of the trusted ones, and the verdict; see `kneser_ney`."""
    trusted = _table(spark, folder, "labels").filter("quality = 1 and toxic = 0").select("doc_id")
    return kneser_ney.judge(_table(spark, folder, "documents"), trusted, quantile=0.995, folds=4, word_quantile=0.995).drop("text_key")


def op11_reversed_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item; see `reversed_search`."""
    return reversed_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), k=10)


OP11_SQL = r"""
with counted as (
  select row, doc_id, term, count(*) as tf
  from (
    select row_number() over () as row, doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
  )
  group by all
), docs as (
  select row, cast(sum(tf) as bigint) as n from counted group by row
), whole as (
  select count(*) as big_n, cast(sum(n) as bigint) as big_l from docs
), asked as (
  select distinct item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), weighed as (
  select term, cast(floor(1000 * ln(cast(2 * big_n + 2 as double) / (2 * count(*) + 1))) as bigint) as w
  from counted, whole group by term, big_n
), scored as (
  select item_id, a.text, c.row, any_value(c.doc_id) as doc_id,
         cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l)))) as bigint) as score
  from asked a join counted c using (term) join weighed using (term) join docs using (row), whole
  group by 1, 2, 3
), ranked as (
  select item_id, doc_id, score, cast(row_number() over (
    partition by item_id, text order by score desc, doc_id nulls last) as integer) as rank
  from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a WARC record, archived by content and read back; see `warc_archive`."""
    archive = shared_folder(spark)
    warc_archive.write_archive(warc_archive.page_records(_table(spark, folder, "pages")), archive)
    return warc_archive.page_facts(warc_archive.read_archive(spark, archive))


OP12_SQL = """
with records as (
  select page_id, coalesce(url, '') as url, coalesce(html, '') as html, md5(coalesce(html, '')) as body,
         row_number() over () as place
  from pages
), ranked as (
  select *, octet_length(encode(html)) as payload_bytes,
         row_number() over (partition by body order by page_id desc nulls last, url desc, place) as nth,
         first_value(page_id) over (partition by body order by page_id desc nulls last, url desc, place) as top
  from records
)
select page_id, replace(replace(url, chr(13), '%0D'), chr(10), '%0A') as url,
       cast(payload_bytes as bigint) as payload_bytes, sha1(html) as payload_digest,
       case when payload_bytes < 1000 or nth = 1 then 'response' else 'revisit' end as record_type,
       case when payload_bytes >= 1000 and nth > 1 then top end as refers_to
from ranked
"""


def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation hurt by the hash of its rows' names, its faults and its repair; see `conversation_repair`."""
    return conversation_repair.summaries(conversation_repair.damaged(_table(spark, folder, "conversations")))


OP13_SQL = r"""
with recursive rows_ as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name
  from conversations
), fated as (
  select *, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), flatten(list_transform(
      range(1, length(name) + 1), lambda i: list_transform(range(0, 8), lambda b: (cast(ascii(name[i]) as bigint) >> b) & 1)))),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) % 20 as fate
  from rows_
), hurt as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
         case fate when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when fate = 3 then [0, 1] else [0] end) as copy
  from fated where fate <> 0
), placed as (
  select *, rtrim(text, e' \t\n\x0b\x0c\r') as body, left(role, 1) as initial, row_number() over (
    partition by conv_id order by turn nulls first, sha256(length(role) || ':' || role || text), copy) as i
  from hurt
), faulty as (
  select conv_id, turn, role, text, initial, i, count(*) over (partition by conv_id) as n,
         lag(initial) over (partition by conv_id order by i) || initial as pair,
         case when body = '' then 'b'
              when row_number() over (partition by conv_id, role, text order by i) > 1 then 'd'
              when right(body, 1) in ('.', '!', '?') then '.' else 't' end as fault
  from placed
), steps as (
  -- Cheapest edits of the rows from i on, by the state before: nothing, after s, after u, after a.
  select conv_id, max(n) + 1 as i, {'c': 0, 'a': '', 'r': ''} as v0,
         {'c': 4, 'a': 'II', 'r': e'\nuser:\nassistant:'} as v1,
         {'c': 2, 'a': 'I', 'r': e'\nassistant:'} as v2, {'c': 0, 'a': '', 'r': ''} as v3
  from faulty group by conv_id
  union all
  select conv_id, i,
         list_sort([w0, {'c': 2 + w2.c, 'a': 'I' || w2.a, 'r': e'\nuser:' || w2.r},
                    {'c': 4 + w3.c, 'a': 'II' || w3.a, 'r': e'\nuser:\nassistant:' || w3.r}])[1],
         list_sort([w1, {'c': 2 + w2.c, 'a': 'I' || w2.a, 'r': e'\nuser:' || w2.r},
                    {'c': 4 + w3.c, 'a': 'II' || w3.a, 'r': e'\nuser:\nassistant:' || w3.r}])[1],
         list_sort([w2, {'c': 2 + w3.c, 'a': 'I' || w3.a, 'r': e'\nassistant:' || w3.r}])[1],
         list_sort([w3, {'c': 2 + w2.c, 'a': 'I' || w2.a, 'r': e'\nuser:' || w2.r}])[1]
  from (
    select conv_id, i,
           list_sort([del0, {'c': v2.c + given, 'a': 'R' || v2.a, 'r': e'\nuser:' || text || v2.r},
             case initial when 's' then {'c': v1.c + stay, 'a': 'K' || v1.a, 'r': line || v1.r}
                          when 'u' then {'c': v2.c + stay, 'a': 'K' || v2.a, 'r': line || v2.r} else del0 end])[1] as w0,
           list_sort([del1, {'c': v2.c + given, 'a': 'R' || v2.a, 'r': e'\nuser:' || text || v2.r},
             case initial when 'u' then {'c': v2.c + stay, 'a': 'K' || v2.a, 'r': line || v2.r} else del1 end])[1] as w1,
           list_sort([del2, {'c': v3.c + given, 'a': 'R' || v3.a, 'r': e'\nassistant:' || text || v3.r},
             case initial when 'a' then {'c': v3.c + stay, 'a': 'K' || v3.a, 'r': line || v3.r} else del2 end])[1] as w2,
           list_sort([del3, {'c': v2.c + given, 'a': 'R' || v2.a, 'r': e'\nuser:' || text || v2.r},
             case initial when 'u' then {'c': v2.c + stay, 'a': 'K' || v2.a, 'r': line || v2.r} else del3 end])[1] as w3
    from (
      select s.conv_id, f.i, f.initial, f.text, e'\n' || f.role || ':' || f.text as line, s.v1, s.v2, s.v3,
             case fault when 'b' then 1000000 when 'd' then 1000000 when 't' then 1 else 0 end as stay,
             case fault when 'b' then 1000000 when 'd' then 1000000 when 't' then 3 else 2 end as given,
             {'c': 3 + v0.c, 'a': 'D' || v0.a, 'r': v0.r} as del0, {'c': 3 + v1.c, 'a': 'D' || v1.a, 'r': v1.r} as del1,
             {'c': 3 + v2.c, 'a': 'D' || v2.a, 'r': v2.r} as del2, {'c': 3 + v3.c, 'a': 'D' || v3.a, 'r': v3.r} as del3
      from steps s join faulty f on f.conv_id is not distinct from s.conv_id and f.i = s.i - 1
    )
  )
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
         count(*) filter (fault = 't') as truncated,
         count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal
  from faulty group by conv_id
)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(v0.c, 0) as bigint) as cost,
       coalesce(v0.a, '') as audit, sha256(coalesce(substr(v0.r, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join counted k on k.conv_id is not distinct from c.conv_id
left join (select * from steps where i = 1) s on s.conv_id is not distinct from c.conv_id
"""


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_simhash_bktree": op2_simhash_bktree,
    "op3_html_density": op3_html_density,
    "op4_decontaminate": op4_decontaminate,
    "op5_language_zstd": op5_language_zstd,
    "op6_topk_tiles": op6_topk_tiles,
    "op7_token_counts": op7_token_counts,
    "op8_token_store": op8_token_store,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_reversed_search": op11_reversed_search,
    "op12_warc": op12_warc,
    "op13_conversations": op13_conversations,
}
ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op6_topk_tiles": OP6_SQL,
    "op11_reversed_search": OP11_SQL,
    "op12_warc": OP12_SQL,
    "op13_conversations": OP13_SQL,
}
