"""The same questions in SQL, for an independent engine over the same tables."""

from __future__ import annotations

# The English stop words of Spark ML's StopWordsRemover.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while
of at by for with about against between into through during before after above below to from up down in out
on off over under again further then once here there when where why how all any both each few more most
other some such no nor not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've
we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's
where's who's why's would
""".split()

WORDS = r"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"

BUYERS = """
buyers as (
  select o_orderkey, o_orderstatus, o_orderdate, c_name, n_name,
         cast(substr(o_orderpriority, 1, 1) as double) as stars
  from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey)"""

CATALOG = """
catalog as (
  select n_name as state_code, r_name as region, r_name || ' ' || (n_nationkey % 2) as division
  from nation join region on n_regionkey = r_regionkey where n_nationkey < 20)"""

REVIEWS = BUYERS + """,
reviews as (
  select doc_id, lang, source as hotel_name, n_name as city, n_name as province,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as review_date, stars as rating, text as review_text,
         case when o_orderstatus <> 'P' then o_orderstatus end as review_title, c_name as username
  from documents join buyers on doc_id = o_orderkey)"""

FULL_TEXT = "case when review_title is null then review_text else review_title || ' ' || review_text end"

CLEAN = REVIEWS + "," + CATALOG + f""",
clean as (
  select hotel_name, city, province, review_date, rating, {FULL_TEXT} as review_full_text,
         cast(case when rating >= 4 then 1 else 0 end as integer) as sentiment, region, division
  from (select distinct hotel_name, city, province, review_date, rating, review_text, review_title, username
        from reviews where lang = 'en' and review_text is not null and rating between 1 and 5)
  join catalog on province = state_code)"""

CHARTS = BUYERS + "," + CATALOG + """,
charted as (
  select n_name as city, o_orderdate as review_date, stars as rating, region,
         cast(case when stars >= 4 then 1 else 0 end as integer) as sentiment
  from buyers join catalog on n_name = state_code where stars between 1 and 5)"""

RULED = """
ruled as (
  select quality as sentiment, case when n_chars > 2000 then 1.0::double else 0.0::double end as prediction
  from labels join documents using (doc_id)),
conf as (select sentiment, prediction, count(*) as n from ruled group by 1, 2)"""

CLASS_METRICS = RULED + """,
classes as (select distinct cast(sentiment as double) as c from conf union select distinct prediction from conf),
sides as (
  select c,
    coalesce((select sum(n) from conf where sentiment = c), 0) as actual,
    coalesce((select sum(n) from conf where prediction = c), 0) as predicted,
    coalesce((select sum(n) from conf where prediction = c and sentiment = c), 0) as hits
  from classes),
rates as (
  select *, case when predicted > 0 then hits / predicted else 0 end as p,
            case when actual > 0 then hits / actual else 0 end as r from sides),
found as (
  select round(sum(hits) / sum(actual), 6) as accuracy,
         round(sum(actual * p) / sum(actual), 6) as precision,
         round(sum(actual * r) / sum(actual), 6) as recall,
         round(sum(case when p + r > 0 then actual * 2 * p * r / (p + r) else 0 end) / sum(actual), 6) as f1
  from rates)"""

ROC = """
scores as (
  select value as score, count(*) filter (event_type = 'error') as pos,
         count(*) filter (event_type <> 'error') as neg
  from events group by 1),
ranked as (
  select score, pos, neg,
         cast(sum(pos) over (order by score desc rows unbounded preceding) as bigint) as tp,
         cast(sum(neg) over (order by score desc rows unbounded preceding) as bigint) as fp
  from scores)"""


def hashed(vocabulary: str, slots: int) -> str:
    """CTEs that give each `t` of a vocabulary table its slot, as a hashing term counter does.

    MurmurHash3 (32 bit, seed 42) over the UTF-8 bytes, as a signed number, modulo the slots.
    """
    return f"""
h0 as (select t, hex(encode(t)) as x, octet_length(encode(t))::bigint as len from (select distinct t from {vocabulary})),
h1 as (
  select t, len,
    list_transform(range(0, len // 4), lambda i:
      ('0x' || x[8*i+7:8*i+8] || x[8*i+5:8*i+6] || x[8*i+3:8*i+4] || x[8*i+1:8*i+2])::ubigint) as body,
    case len % 4
      when 0 then 0
      when 1 then ('0x' || x[2*len-1:2*len])::ubigint
      when 2 then ('0x' || x[2*len-1:2*len] || x[2*len-3:2*len-2])::ubigint
      else ('0x' || x[2*len-1:2*len] || x[2*len-3:2*len-2] || x[2*len-5:2*len-4])::ubigint
    end::ubigint as tail
  from h0),
h2 as (
  select t, len, list_transform(list_append(body, tail), lambda k:
    (k * 3432918353::ubigint) % 4294967296::ubigint) as ks from h1),
h3 as (
  select t, len, list_transform(ks, lambda k:
    (((k * 32768::ubigint) % 4294967296::ubigint + k // 131072::ubigint) * 461845907::ubigint)
    % 4294967296::ubigint) as ks from h2),
h4 as (
  select t, len, ks[len(ks)] as tail, list_reduce(ks[1:len(ks)-1], lambda h, k:
    (((xor(h, k) * 8192::ubigint) % 4294967296::ubigint + xor(h, k) // 524288::ubigint) * 5::ubigint
     + 3864292196::ubigint) % 4294967296::ubigint, 42::ubigint) as h from h3),
h5 as (select t, xor(xor(h, tail), len::ubigint) as h from h4),
h6 as (select t, (xor(h, h // 65536::ubigint) * 2246822507::ubigint) % 4294967296::ubigint as h from h5),
h7 as (select t, (xor(h, h // 8192::ubigint) * 3266489909::ubigint) % 4294967296::ubigint as h from h6),
h8 as (select t, xor(h, h // 65536::ubigint)::bigint as h from h7),
slots as (
  select t, cast(((case when h >= 2147483648 then h - 4294967296 else h end) % {slots} + {slots}) % {slots}
                 as integer) as slot
  from h8)"""


def _vectors(source: str, id_col: str, prefix: str = "") -> str:
    """CTE `<prefix>cells`: id, dim, weight of the hashed vectors, using `slots`."""
    return f"""
{prefix}folded as (
  select id, slot % 384 as dim, sum(case when slot < 384 then n else -n end)::double as x
  from {source} join slots using (t) group by 1, 2),
{prefix}cells as (
  select id, dim, cast(x / sqrt(sum(x * x) over (partition by id)) as float) as weight
  from {prefix}folded where x <> 0)"""


def _word_counts(name: str, table: str, id_col: str) -> str:
    return f"""
{name} as (
  select id, t, count(*) as n
  from (select {id_col} as id, unnest({WORDS.format(text='text')}) as t from {table}) group by 1, 2)"""


def bm25(documents: str) -> str:
    """CTE `bm25`: the five best of a table with doc_id and text for every benchmark item."""
    return _word_counts("postings", documents, "doc_id") + "," + _word_counts(
        "asked", "(select * from benchmark where trim(text) <> '')", "item_id"
    ) + """,
lengths as (select id, sum(n) as doc_len from postings group by 1),
corpus as (select count(*) as docs, avg(doc_len) as mean_len from lengths),
rare as (select t, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) as idf
         from postings, corpus group by t, docs),
matched as (
  select a.id as query_id, p.id as doc_id,
         sum(cast(a.n * idf * p.n * 2.2 / (p.n + 1.2 * (0.25 + 0.75 * doc_len / mean_len)) as decimal(28, 15))) as score
  from asked a join postings p using (t) join rare using (t) join lengths l on l.id = p.id, corpus
  group by 1, 2),
bm25 as (
  select query_id, doc_id, round(score::double, 6) as score, rank from (
    select *, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank
    from matched) where rank <= 5)"""


BM25 = bm25("documents")

NEAR = """
cells as (
  select vec_id, label, unnest(range(0, len(embedding))) as dim, unnest(embedding)::double as x from embeddings),
centre as (select label, dim, avg(x) as c from cells group by 1, 2),
unit_centre as (select label, dim, c / sqrt(sum(c * c) over (partition by label)) as c from centre),
unit_row as (select vec_id, dim, x / sqrt(sum(x * x) over (partition by vec_id)) as x from cells),
near as (
  select label::bigint as query_id, vec_id as doc_id, sum(c * x) as score
  from unit_centre join unit_row using (dim) group by 1, 2)"""

# Sums differ in their last digits by the order of summation.
BEST_FIVE = """
select query_id, doc_id, round(score, 6) as score, rank from (
  select *, cast(row_number() over (partition by query_id order by round(score, 12) desc, doc_id) as integer) as rank
  from {table}) where rank <= 5"""

KNN = f"with {NEAR} {BEST_FIVE.format(table='near')}"

KNN_HASHED = f"""
with {NEAR},
planes as (
  select h, dim, case when substr(md5(h || ':' || dim), 1, 1) < '8' then 1.0 else -1.0 end as s
  from range(0, 24 * 6) p(h), (select distinct dim from cells)),
row_keys as (
  select id, h // 6 as band, sum(case when side > 0 then 1 << (h % 6)::integer else 0 end) as key
  from (select vec_id as id, h, sum(x * s) as side from unit_row join planes using (dim) group by 1, 2) group by 1, 2),
asked_keys as (
  select id, h // 6 as band, sum(case when side > 0 then 1 << (h % 6)::integer else 0 end) as key
  from (select label as id, h, sum(c * s) as side from unit_centre join planes using (dim) group by 1, 2) group by 1, 2),
offered as (
  select query_id, doc_id from (
    select a.id::bigint as query_id, r.id as doc_id,
           row_number() over (partition by a.id order by count(*) desc, r.id) as place
    from asked_keys a join row_keys r using (band, key) group by a.id, r.id) where place <= 100),
scored as (select * from near join offered using (query_id, doc_id))
{BEST_FIVE.format(table='scored')}"""

#: Every twentieth vector against all rows, itself included.
KNN_TWENTIETH = """
with pointed as (
  select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings),
units as (select vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) as u from pointed),
scored as (
  select q.vec_id as query_id, r.vec_id as doc_id, list_inner_product(q.u, r.u) as score
  from units q join units r on q.vec_id % 20 = 0),
ranked as (
  select *, cast(row_number() over (partition by query_id order by round(score, 12) desc, doc_id) as integer) as rank
  from scored)"""

SPLIT_SIDE = "('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint % 100 < 80"

KEYWORD_LIST = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)

TOKENS = f"""
tokens as (
  select doc_id, list_filter(string_split_regex(lower(text), '\\s'), lambda w: w not in ({KEYWORD_LIST})) as kept
  from (select doc_id, regexp_replace(text, '\\s+$', '') as text from documents)),
counts as (select doc_id, t, count(*) as n from (select doc_id, unnest(kept) as t from tokens) group by 1, 2),
{hashed('counts', 2 ** 15)},
tf as (select doc_id, slot, sum(n)::double as tf from counts join slots using (t) group by 1, 2)"""

LETTERS = r"trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g'))"

LANGUAGE = f"""
with bare as (select doc_id, lang, {LETTERS} as b from documents),
characters as (select doc_id, lang, string_split(' ' || b || ' ', '') as c from bare where b <> ''),
grams as (
  select doc_id, lang, t, count(*) as n from (
    select doc_id, lang,
           unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || ' ' || c[i+1] || ' ' || c[i+2])) as t
    from characters) group by 1, 2, 3),
{hashed('grams', 2 ** 18)},
cells as (select doc_id, lang, slot, sum(n) as n from grams join slots using (t) group by 1, 2, 3),
per_lang as (select lang, slot, sum(n) as n from cells group by 1, 2),
totals as (select lang, sum(n) as n from per_lang group by 1),
priors as (
  select lang, ln(count(*) + 1) - ln((select count(*) from characters) + (select count(distinct lang) from characters)) as p
  from characters group by 1),
model as (
  select p.lang, s.slot, ln(coalesce(l.n, 0) + 1) - ln(t.n + {2 ** 18}) as w
  from (select distinct slot from per_lang) s cross join totals p
  join totals t on t.lang = p.lang left join per_lang l on l.lang = p.lang and l.slot = s.slot),
scored as (
  select doc_id, m.lang, sum(c.n * m.w) + any_value(priors.p) as score
  from cells c join model m using (slot) join priors on priors.lang = m.lang group by 1, 2),
told as (select doc_id, arg_max(lang, score) as detected from scored group by 1)
select doc_id, coalesce(detected, 'unknown') as detected from documents left join told using (doc_id)"""


# Model -1 has learned all folds, model f all but fold f; none has learned Spanish.
LANGUAGE_REFUSED = f"""
with bare as (
  select doc_id, lang, {LETTERS} as b, cast(('0x' || substr(md5(text), 1, 8))::bigint % 4 as integer) as fold
  from documents),
characters as (select doc_id, lang, fold, string_split(' ' || b || ' ', '') as c from bare where b <> ''),
grams as (
  select doc_id, t, count(*) as n from (
    select doc_id,
           unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || ' ' || c[i+1] || ' ' || c[i+2])) as t
    from characters) group by 1, 2),
{hashed('grams', 2 ** 18)},
cells as (select doc_id, slot, sum(n) as n from grams join slots using (t) group by 1, 2),
sizes as (select doc_id, sum(n) as n from cells group by 1),
learned as (select doc_id, lang, fold from characters where lang <> 'es'),
models as (select unnest([-1, 0, 1, 2, 3]) as m),
texts as (select m, lang, count(*) as n from models join learned on fold <> m group by 1, 2),
priors as (select m, lang, ln(n + 1) - ln(sum(n) over (partition by m) + count(*) over (partition by m)) as p from texts),
per_fold as (select lang, fold, slot, sum(n) as n from cells join learned using (doc_id) group by 1, 2, 3),
per_model as (select m, lang, slot, sum(n) as n from models join per_fold on fold <> m group by 1, 2, 3),
totals as (select m, lang, ln(sum(n) + {2 ** 18}) as w from per_model group by 1, 2),
-- A trigram that a model has not seen in a language counts one; the seen ones add to that.
seen as (select m, lang, slot, ln(n + 1) as w from per_model),
own as (
  select l.doc_id, l.lang, sum(c.n * s.w) as w
  from learned l join cells c using (doc_id) join seen s on s.m = l.fold and s.lang = l.lang and s.slot = c.slot
  group by 1, 2),
held as (
  select l.lang, z.n, coalesce(own.w, 0) - z.n * t.w + p.p as score
  from learned l join sizes z using (doc_id) join totals t on t.m = l.fold and t.lang = l.lang
  join priors p on p.m = l.fold and p.lang = l.lang left join own on own.doc_id = l.doc_id),
averages as (select lang, sum(score) / sum(n) as a from held group by 1),
bounds as (
  select lang, a, quantile_disc((score + 20 * a) / (n + 20), 0.005) as bound from held join averages using (lang) group by 1, 2),
scored as (
  select c.doc_id, s.lang, sum(c.n * s.w) as w from cells c join seen s on s.m = -1 and s.slot = c.slot group by 1, 2),
all_scores as (
  select z.doc_id, z.n, t.lang, coalesce(s.w, 0) - z.n * t.w + p.p as score
  from sizes z join totals t on t.m = -1 join priors p on p.m = -1 and p.lang = t.lang
  left join scored s on s.doc_id = z.doc_id and s.lang = t.lang),
told as (select doc_id, any_value(n) as n, arg_max(lang, score) as lang, max(score) as score from all_scores group by 1)
select d.doc_id, case when (score + 20 * a) / (n + 20) >= bound then told.lang else 'unknown' end as detected
from documents d left join told on told.doc_id = d.doc_id left join bounds on bounds.lang = told.lang"""


def _category(field: str) -> str:
    return f"""
{field}_order as (
  select {field}, cast(row_number() over (order by n desc, {field}) - 1 as double) as {field}_index
  from (select {field}, count(*) as n from documents group by 1))"""


REGIONS = """
by_region as (select region, sentiment, count(*) as n from charted group by 1, 2),
largest as (select region from by_region group by 1 order by sum(n) desc, region limit {n})"""

CITIES = """
largest as (select city from charted group by 1 order by count(rating) desc, city limit 10),
cities as (
  select case when l.city is null then 'Other' else c.city end as city,
         count(rating) as ratings, median(rating) as median_rating
  from charted c left join largest l on l.city = c.city group by 1)"""

MONTHS = """
dated as (select * from charted
          where review_date between timestamp '1981-01-01' and timestamp '2000-12-31'),
months as (
  select unnest(generate_series(date_trunc('month', min(review_date)), date_trunc('month', max(review_date)),
                                interval 1 month))::date as period from dated),
per_month as (
  select strftime(period, '%Y-%m-%d') as period, count(review_date) as count
  from months left join dated on date_trunc('month', review_date)::date = period group by 1)"""

REGION_ROWS = """
  select case when l.region is null then 'Other' else b.region end as region, sentiment,
         cast(sum(n) as bigint) as count
  from by_region b left join largest l on l.region = b.region group by 1, 2"""


def histogram(table: str, width: str) -> str:
    return f"""
  select s * {width}::double as bucket, count(rating) as count
  from (select unnest(range(cast(floor(min(rating) / {width}) as bigint),
                            cast(floor(max(rating) / {width}) as bigint) + 1)) as s from {table})
  left join {table} on floor(rating / {width}) = s group by s"""


KEYED = CLEAN + """,
keyed as (
  select * exclude (n) from (
    select *, md5(hotel_name || '|' || review_date || '|' || review_full_text) as doc_id,
      row_number() over (
        partition by hotel_name, review_date, review_full_text
        order by rating desc, city desc, province desc, sentiment desc, region desc, division desc) as n
    from clean) where n = 1)"""

# The language model of the documents, asked about the reviews' full texts.
CLEAN_DETECTED = REVIEWS + "," + CATALOG + f""",
any_clean as (
  select hotel_name, city, province, review_date, rating, {FULL_TEXT} as review_full_text,
         cast(case when rating >= 4 then 1 else 0 end as integer) as sentiment, region, division
  from (select distinct hotel_name, city, province, review_date, rating, review_text, review_title, username
        from reviews where review_text is not null and rating between 1 and 5)
  join catalog on province = state_code),
both_texts as (
  select 'd' || doc_id as id, lang, text from documents
  union all select 'r' || row_number() over (), null, text
  from (select distinct review_full_text as text from any_clean)),
bare as (select id, lang, text, {LETTERS} as b from both_texts),
characters as (select id, lang, string_split(' ' || b || ' ', '') as c from bare where b <> ''),
grams as (
  select id, lang, t, count(*) as n from (
    select id, lang,
           unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || ' ' || c[i+1] || ' ' || c[i+2])) as t
    from characters) group by 1, 2, 3),
{hashed('grams', 2 ** 18)},
gram_cells as (select id, lang, slot, sum(n) as n from grams join slots using (t) group by 1, 2, 3),
per_lang as (select lang, slot, sum(n) as n from gram_cells where lang is not null group by 1, 2),
totals as (select lang, sum(n) as n from per_lang group by 1),
priors as (
  select lang, ln(count(*) + 1) - ln(sum(count(*)) over () + count(*) over ()) as p
  from characters where lang is not null group by 1),
scored as (
  select c.id, t.lang, sum(c.n * (ln(coalesce(l.n, 0) + 1) - ln(t.n + {2 ** 18}))) + any_value(priors.p) as score
  from gram_cells c cross join totals t join priors on priors.lang = t.lang
  left join per_lang l on l.lang = t.lang and l.slot = c.slot where c.lang is null group by 1, 2),
english as (select text from bare join (select id, arg_max(lang, score) as told from scored group by 1) using (id)
            where told = 'en')"""


def _test_rows(name: str) -> str:
    """What the saved results of a model must say: its test rows, by the hash of all model columns."""
    side = "('0x' || substr(md5(text || '|' || quality || '|' || source || '|' || lang), 1, 8))::bigint % 100"
    return f"""
select '{name}' as model, count(*) as test_rows, true as agrees, true as outcome_fits
from labels join documents using (doc_id) where {side} >= 80"""


PREDICTED = f"""
select doc_id, quality as sentiment, true as agrees, true as in_range
from labels join documents using (doc_id) where not ({SPLIT_SIDE})"""

ORACLES = {
    "reviews_project": f"with {REVIEWS} select hotel_name, city, province, review_date, rating, review_text, review_title, username from reviews",
    "reviews_clean": f"with {CLEAN} select * from clean",
    "rename_sanitised": f"""
with {REVIEWS}, {CATALOG}
select hotel_name as name, city, province, review_date as reviews_date, rating as reviews_rating,
       review_text as reviews_text, review_title as reviews_title, username as reviews_username, doc_id,
       state_code as state, state_code, region, division
from reviews join catalog on province = state_code""",
    "drop_duplicates": "select distinct text, lang, source, n_chars from documents",
    "rating_range": f"with {REVIEWS} select doc_id, rating from reviews where rating between 2 and 4",
    "sentiment_label": f"with {REVIEWS} select doc_id, rating, cast(case when rating >= 4 then 1 else 0 end as integer) as sentiment from reviews",
    "full_text": f"with {REVIEWS} select doc_id, {FULL_TEXT} as review_full_text from reviews",
    "drop_null_rows": f"""
with {REVIEWS}
select doc_id, review_title, quality from reviews left join labels using (doc_id)
where doc_id is not null and review_title is not null and quality is not null""",
    "enrich_join": f"with {REVIEWS}, {CATALOG} select doc_id, province, region, division from reviews join catalog on province = state_code",
    "hash_split": f"select doc_id, case when {SPLIT_SIDE} then 'train' else 'test' end as side from documents",
    "nan_to_null": "select event_id, case when event_type <> 'error' then value end as value from events",
    "iso_date": "select o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as iso_date from orders",
    "doc_key": f"""
with {REVIEWS}
select username, md5(hotel_name || '|' || review_date || '|' || review_text) as doc_key,
       md5(hotel_name || '|' || coalesce(review_title, 'None')) as title_key from reviews""",
    "keyed_upsert": """
select doc_id, lang, source, md5(text) as key from (
  select *, row_number() over (partition by text order by doc_id desc) as n from documents) where n = 1""",
    "held_set_loads": """
with first as (select *, row_number() over (partition by text order by doc_id desc) as n from documents),
again as (
  select *, row_number() over (partition by text order by doc_id desc) as n from documents where lang in ('fr', 'de'))
select doc_id, lang, source, md5(text) as key from first
where n = 1 and not exists (select 1 from again where again.text is not distinct from first.text)
union all
select doc_id, lang, 'again', md5(text) from again where n = 1 and lang = 'fr'""",
    "schema_contract": f"with {CLEAN} select * from clean",
    "parquet_roundtrip": """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as o_orderdate,
       o_orderpriority, (select count(*) from orders) as written from orders""",
    "csv_roundtrip": "select * from documents",
    "large_csv_roundtrip": "select * from documents",
    "report_roundtrip": f"with {CHARTS} select region, sentiment, count(*) as count from charted group by 1, 2",
    "language_detect": LANGUAGE,
    "language_refused": LANGUAGE_REFUSED,
    "reviews_clean_detected": f"with {CLEAN_DETECTED} select * from any_clean where review_full_text in (select text from english)",
    "lr_predict": PREDICTED,
    "rf_predict": PREDICTED,
    "model_comparison": _test_rows("Logistic Regression") + " union all " + _test_rows("Random Forest"),
    "search_answers": f"""
with {KEYED}, {bm25("(select doc_id, review_full_text as text from keyed)")}
select query_id, bm25.doc_id, score, rank, hotel_name, review_full_text, rating
from bm25 join keyed on keyed.doc_id = bm25.doc_id""",
    "embed_hash": f"""
with {_word_counts('counts', 'documents', 'doc_id')}, {hashed('counts', 768)}, {_vectors('counts', 'doc_id')}
select id as doc_id, cast(dim as integer) as dim, round(weight::double, 6) as weight from cells""",
    "embed_udf": """
with cells as (
  select doc_id, i as dim, (length(text) - length(replace(text, chr(97 + i), '')))::double as x
  from documents, (select unnest(range(0, 26))::integer as i))
select doc_id, dim, round((x / length_all)::float::double, 6) as weight
from (select *, sqrt(sum(x * x) over (partition by doc_id)) as length_all from cells) where x > 0""",
    "bm25_index": f"""
with {_word_counts('postings', 'documents', 'doc_id')}
select id as doc_id, t as term, cast(n as integer) as tf,
       cast(sum(n) over (partition by id) as integer) as doc_len from postings""",
    "bm25_terms": f"with {_word_counts('postings', 'documents', 'doc_id')} select t as term, count(*) as df from postings group by 1",
    "bm25_topk": f"with {BM25} select * from bm25",
    "bm25_skipping": f"with {BM25} select * from bm25",
    "knn_exact": KNN,
    "knn_lsh": KNN_HASHED,
    "knn_ivf": f"{KNN_TWENTIETH} select query_id, doc_id, round(score, 6) as score, rank from ranked where rank <= 5",
    "knn_ivf_recall": f"""{KNN_TWENTIETH}
select count(distinct query_id) as questions, count(*) as hits, true as recall_reached from ranked where rank <= 5""",
    "search_hydrate": f"with {BM25} select query_id, bm25.doc_id, score, rank, source, text, lang from bm25 join documents d on d.doc_id = bm25.doc_id",
    "search_compare": f"""
with {BM25},
vocabulary as (select t from postings union select t from asked),
{hashed('vocabulary', 768)}, {_vectors('postings', 'doc_id', 'row_')}, {_vectors('asked', 'item_id', 'asked_')},
near as (
  select a.id as query_id, r.id as doc_id,
         sum(a.weight::double * r.weight::double) / (any_value(a.size) * any_value(r.size)) as score
  from (select *, sqrt(sum(weight::double * weight::double) over (partition by id)) as size from asked_cells) a
  join (select *, sqrt(sum(weight::double * weight::double) over (partition by id)) as size from row_cells) r
  using (dim) group by 1, 2),
all_pairs as (
  select q.id as query_id, d.id as doc_id, coalesce(score, 0) as score
  from (select distinct id from asked_cells) q cross join (select distinct id from row_cells) d
  left join near on near.query_id = q.id and near.doc_id = d.id),
vector_hits as (
  select query_id, doc_id, rank from (
    select *, cast(row_number() over (partition by query_id order by round(score, 12) desc, doc_id) as integer) as rank
    from all_pairs) where rank <= 5)
select query_id, doc_id, bm25.rank as keyword_rank, vector_hits.rank as vector_rank,
       round(count(*) filter (bm25.rank is not null and vector_hits.rank is not null)
             over (partition by query_id) / 5.0::double, 6) as overlap
from bm25 full join vector_hits using (query_id, doc_id)""",
    "tokens_stopwords": f"with {TOKENS} select doc_id, array_to_string(kept, '|') as tokens from tokens",
    "hashed_tf": f"with {TOKENS} select doc_id, slot, tf from tf",
    "tfidf": f"""
with {TOKENS},
idf as (select slot, ln(((select count(*) from documents) + 1.0) / (count(*) + 1.0)) as idf from tf group by 1)
select doc_id, slot, round(tf * idf, 6) as weight from tf join idf using (slot) where tf * idf <> 0""",
    "string_index": f"""
with {_category('source')}, {_category('lang')}
select doc_id, source, lang, source_index, lang_index
from documents join source_order using (source) join lang_order using (lang)""",
    "frequency_index": f"""
with {_category('source')}, {_category('lang')}
select doc_id, source, lang, source_index, lang_index
from documents join source_order using (source) join lang_order using (lang)""",
    "one_hot": f"""
with {_category('source')}, {_category('lang')}
select doc_id, 'source' as field, cast(source_index as integer) as slot, 1.0::double as flag
from documents join source_order using (source)
union all
select doc_id, 'lang', cast(lang_index as integer), 1.0::double from documents join lang_order using (lang)""",
    "confusion_matrix": f"with {RULED} select sentiment, prediction, n as count from conf",
    "confusion_pivot": f"""
with {RULED}
select sentiment, cast(coalesce(sum(n) filter (prediction = 0), 0) as bigint) as predicted_0,
       cast(coalesce(sum(n) filter (prediction = 1), 0) as bigint) as predicted_1 from conf group by 1""",
    "class_metrics": f"with {CLASS_METRICS} select * from found",
    "metrics_unpivot": f"""
with {CLASS_METRICS}
select 'rule' as model, 'accuracy' as metric, accuracy as value from found
union all select 'rule', 'precision', precision from found
union all select 'rule', 'recall', recall from found
union all select 'rule', 'f1', f1 from found""",
    "roc_points": f"""
with {ROC}
select score, tp, fp, round(tp / (select sum(pos) from scores), 6) as tpr,
       round(fp / (select sum(neg) from scores), 6) as fpr from ranked""",
    "roc_bounded": f"""
with {ROC}
select min(score) as score, max(tp) as tp, max(fp) as fp, round(max(tp) / (select sum(pos) from scores), 6) as tpr,
       round(max(fp) / (select sum(neg) from scores), 6) as fpr
from ranked group by (tp + fp - 1) * 100 // (select cast(sum(pos + neg) as bigint) from scores)""",
    "auc": f"""
with {ROC}
select round(sum(neg * (tp - pos / 2)) / (sum(pos)::double * sum(neg)::double), 6) as auc_roc from ranked""",
    "sentiment_by_region": f"with {CHARTS} select region, sentiment, count(*) as count from charted group by 1, 2",
    "sentiment_pivot": f"""
with {CHARTS}
select region, count(*) filter (sentiment = 0) as negative, count(*) filter (sentiment = 1) as positive
from charted group by 1""",
    "rating_histogram": f"with {CHARTS} {histogram('charted', '0.5')}",
    "region_topn_other": f"with {CHARTS}, {REGIONS.format(n=3)} {REGION_ROWS}",
    "fitting_histogram": """
with ends as (select min(l_extendedprice) as low, max(l_extendedprice) as high from lineitem),
fitting as (
  select min(m * pow(10.0, e)) as width from range(-6, 12) t(e), (values (1), (2), (5)) as s(m), ends
  where floor(high / (m * pow(10.0, e))) - floor(low / (m * pow(10.0, e))) + 1 <= 50),
steps as (
  select unnest(range(cast(floor(low / width) as bigint), cast(floor(high / width) as bigint) + 1)) as s, width
  from ends, fitting),
counted as (select floor(l_extendedprice / width) as s, count(*) as n from lineitem, fitting group by 1)
select steps.s * width as bucket, coalesce(n, 0) as count from steps left join counted on counted.s = steps.s""",
    "fitting_periods": """
with units as (
  select * from (values ('second', 1, interval 1 second), ('minute', 60, interval 1 minute), ('hour', 3600, interval 1 hour),
    ('day', 86400, interval 1 day), ('week', 604800, interval 7 day), ('month', 2419200, interval 1 month),
    ('year', 31536000, interval 1 year)) as u(unit, seconds, stride)),
ends as (select min(ts) as low, max(ts) as high from events),
fitting as (
  select unit, stride, low, high from units, ends
  where (epoch_us(high) - epoch_us(low)) // 1000000 // seconds + 2 <= 100 order by seconds limit 1),
periods as (
  select unnest(generate_series(cast(date_trunc(unit, low) as timestamp), cast(date_trunc(unit, high) as timestamp), stride)) as period
  from fitting),
counted as (select cast(date_trunc(unit, ts) as timestamp) as period, count(*) as n from events, fitting group by 1)
select strftime(periods.period, '%Y-%m-%d %H:%M:%S') as period, coalesce(n, 0) as count
from periods left join counted on counted.period = periods.period""",
    "reviews_per_month": f"with {CHARTS}, {MONTHS} select * from per_month",
    "events_in_window": """
select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as ts from events
where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-15' + interval 1 day""",
    "positive_share": f"""
with {CHARTS}
select sentiment, count(*) as count, round(100 * count(*) / (select count(*) from charted), 6) as percent
from charted group by 1""",
    "top_cities": f"with {CHARTS}, {CITIES} select * from cities",
    "board": f"""
with {CHARTS.replace('charted as', 'all_charted as')},
charted as (select * from all_charted
            where review_date between timestamp '1981-01-01' and timestamp '2000-12-31'),
{MONTHS}, {REGIONS.format(n=5)}, {CITIES.replace('largest', 'largest_cities')}
select 'rating_histogram' as chart, bucket::double::varchar as bar, count::double as height
from ({histogram('charted', '1.0')})
union all select 'region_topn_other', region || '/' || sentiment, count::double from ({REGION_ROWS})
union all select 'reviews_per_month', period, count::double from per_month
union all select 'positive_share', sentiment::varchar,
  round(100 * count(*) / (select count(*) from charted), 6) from charted group by sentiment
union all select 'top_cities', city, median_rating from cities""",
    "materialised_sets": f"""
with {CLEAN}
select doc_id, hotel_name, city, review_date, rating, sentiment, region from (
  select *, md5(hotel_name || '|' || review_date || '|' || review_full_text) as doc_id,
    row_number() over (
      partition by hotel_name, review_date, review_full_text
      order by rating desc, city desc, province desc, sentiment desc, region desc, division desc) as n
  from clean) where n = 1""",
}

# Two loads show what one does.
ORACLES["board_loads"] = ORACLES["board"]
