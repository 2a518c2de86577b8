"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, kneser_ney, licenses, packing, rules, secrets, simhash, toxicity, tries, urls, warc, whitening, winnow
from .common import table

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    coded = bpe.round_trip_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, ["doc_id"])
    return coded.select("doc_id", bpe.token_count().alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


#: Dated list entries: hosts cover their subdomains, entries with a path cover what stands under it.
URL_LIST = (
    ("spam-farm.example.org", "spam", "add", "2024-01-01 00:00:00"),
    ("spam-farm.example.org", "spam", "remove", "2024-01-01 02:00:00"),
    ("spam-farm.example.org", "spam", "add", "2024-01-01 06:00:00"),
    ("blog.example.com", "blogs", "add", "2024-01-01 00:00:00"),
    ("example.net", "network", "add", "2024-01-01 01:00:00"),
    ("example.net", "network", "remove", "2024-01-01 01:30:00"),
    ("example.net", "network", "add", "2024-01-01 10:00:00"),
    ("spam-farm.example.org/en", "paths", "add", "2024-01-01 03:00:00"),
    ("spam-farm.example.org/en", "paths", "remove", "2024-01-01 05:00:00"),
    ("spam-farm.example.org/de", "paths", "add", "2024-01-01 00:10:00"),
)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = spark.createDataFrame(URL_LIST, "entry string, category string, action string, dated string").withColumn("dated", F.col("dated").cast("timestamp"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.timestamp_seconds(F.unix_timestamp(F.lit(warc.FIRST_CAPTURE).cast("timestamp")) + F.col("page_id")).alias("fetched"))
    judged = urls.filter_captures(pages, entries)
    return judged.select("page_id", "url", "blocked", F.array_join("matched", ",").alias("matched"), F.array_join("categories", ",").alias("categories"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fp(F.col("fp")).alias("fingerprint"), "component_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = warc.capture_index(table(spark, sf_dir, "pages"))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", F.date_format("captured", "yyyy-MM-dd HH:mm:ss").alias("captured"), "place")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    spans = F.col("spans")
    counts = [secrets.count_of(spans, r.kind).alias(f"n_{r.kind}") for r in secrets.BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(secrets.rendered(secrets.of_base(spans)), 256).alias("base_sha256"), secrets.rendered(spans).alias("spans"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    items = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), "contaminated")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), ["doc_id"])


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    judged = rules.apply_rules(table(spark, sf_dir, "documents"), good, ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(tries.rebuilt(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_url_filters, op3_simhash, op4_warc, op5_quality, op6_secrets, op7_decontamination, op8_licenses, op9_toxicity, op10_quality_rules, op11_whitening, op12_packing, op13_prefix_trie)}


def _span_sql() -> str:
    parts = []
    for k, r in enumerate(secrets.RULES):
        pattern = r.pattern.replace("'", "''").replace("(?i:password|passwd|secret|token|api_?key)", "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]")
        value = f"regexp_extract(m, '{pattern}', {r.value})" if r.value else "m"
        parts.append(f"""select doc_id, {k} as o, '{r.kind}' as kind, length(m) as size, length({value}) >= {r.least} as ok,
  list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(a[1:i - 1], lambda x: length(x))), 0) as start
from (select doc_id, a, p, unnest(a) as m, unnest(range(1, len(a) + 1)) as i from (select doc_id, regexp_extract_all(t, '{pattern}') as a, string_split_regex(t, '{pattern}') as p from d))""")
    return " union all ".join(parts)


def _cdf(x: str, n: str) -> str:
    r = rules.RISK
    return f"""case when {x} < {n} * {r} then list_sum(list_transform(range({x}::bigint + 1), lambda i: exp(lgamma({n} + 1) - lgamma(i + 1) - lgamma({n} - i + 1) + i * ln({r}) + ({n} - i) * ln(1 - {r})))) else 1 end"""


#: CRC-32 of a decimal number: the polynomial's reflected division, a bit at a time.
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(range(8 * length(D)), lambda i: case when i % 8 = 0 then ascii(substr(D, i // 8 + 1, 1)) else 0 end)),
  lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295)"""

ORACLE_SQL = {
    "op2_url_filters": f"""
with e as (select * from (values {", ".join(f"('{a}', '{b}', '{c}', timestamp '{d}')" for a, b, c, d in URL_LIST)}) v(entry, category, action, dated)),
iv as (select * from (select *, lead(dated) over (partition by entry, category order by dated) as valid_to from e) where action = 'add'),
p as (select page_id, url, timestamp '{warc.FIRST_CAPTURE}' + to_seconds(page_id) as fetched,
  lower(regexp_replace(regexp_replace(regexp_extract(url, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\s]*)', 1), '^.*@', ''), '\\.?(:[0-9]*)?$', '')) as host,
  regexp_extract(url, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#\\s]*(/[^?#\\s]*)', 1) as path from pages),
m as (select page_id, url, fetched, entry, category from p join iv on fetched >= dated and (valid_to is null or fetched < valid_to)
  and (case when contains(entry, '/') then starts_with(regexp_replace(host || path, '/+', '/', 'g') || '/', entry || '/') else ends_with('.' || host, '.' || entry) end)),
g as (select page_id, url, array_to_string(list_sort(list_distinct(list(entry))), ',') as matched, array_to_string(list_sort(list_distinct(list(category))), ',') as categories from m group by all)
select p.page_id, p.url, g.matched is not null as blocked, coalesce(g.matched, '') as matched, coalesce(g.categories, '') as categories
from p left join g on p.page_id = g.page_id and p.url = g.url""",
    "op4_warc": """
with d as (select page_id, coalesce(html, '') as html, max(page_id) over (partition by coalesce(html, '')) as top, timestamp '{FIRST}' + to_seconds(page_id) as captured,
  lower(array_to_string(list_reverse(string_split(regexp_replace(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1), '^www[.]', ''), '.')), ',') || ')' || coalesce(nullif(regexp_extract(url, '^[A-Za-z]+://[^/?#]*(/[^?#]*)', 1), ''), '/') || regexp_extract(url, '([?][^#]+)', 1)) as urlkey from pages),
b as (select *, array_to_string(list_transform(string_split(sha1(html), ''), lambda c: right(format('{:b}', 16 + instr('0123456789abcdef', c) - 1), 4)), '') as bits from d)
select page_id, octet_length(encode(html))::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda j: substr(bits, (5 * i + j + 1)::bigint, 1)::int * (16 >> j::int)))::bigint, 1)), '') as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type, case when page_id <> top then top end as refers_to,
  urlkey, strftime(captured, '%Y-%m-%d %H:%M:%S') as captured, row_number() over (order by urlkey, captured, page_id) - 1 as place
from b""".replace("{FIRST}", warc.FIRST_CAPTURE),
    "op6_secrets": f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
s as ({_span_sql()}),
g as (select doc_id, count(*) filter (o = 0) as n_assign, count(*) filter (o = 1) as n_access, count(*) filter (o = 2) as n_hex,
  string_agg(kind || ':' || start::bigint || ':' || (start + size)::bigint, ',' order by start, o) filter (o < {len(secrets.BASE_RULES)}) as base,
  string_agg(kind || ':' || start::bigint || ':' || (start + size)::bigint, ',' order by start, o) as spans from s where ok group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g on d.doc_id = g.doc_id""",
    "op7_decontamination": """
with w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
bw as (select distinct item_id, n, array_to_string(ws[i : i + n - 1], ' ') as gram from (select item_id, ws, least(10, len(ws)) as n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) as i from b where len(ws) > 0)),
sizes as (select distinct n from bw),
dw as (select doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') as gram from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from w cross join sizes where len(ws) >= n)),
hits as (select doc_id, item_id, dw.n, i from dw join bw on dw.gram = bw.gram and dw.n = bw.n),
words as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from hits) group by doc_id),
items as (select doc_id, count(distinct item_id) as n_items, array_to_string(list_sort(list_distinct(list(item_id::varchar))), ',') as names from hits group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join words on w.doc_id = words.doc_id left join items on w.doc_id = items.doc_id""",
    "op8_licenses": f"""
with x as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
d as (select doc_id, ws, ' ' || array_to_string(ws, ' ') || ' ' as s from x),
tpl as (select * from (values {", ".join(f"({t}, '{name}', '{words}', '{key}', {licenses.lookups(words)})" for t, (name, words, key) in enumerate(licenses.TEMPLATES))}) v(t, label, words, phrase, size)),
idx as (select * from (select t, unnest(string_split(words, ' ')) as word, unnest(range(len(string_split(words, ' ')))) as spot from tpl) where word not in ({", ".join(f"'{w}'" for w in sorted(licenses.COMMON))})),
df as (select word, count(*) as df from (select distinct doc_id, unnest(ws) as word from d) where word in (select word from idx) group by word),
k as (select doc_id, t, ws from d join tpl on contains(s, ' ' || phrase || ' ')),
chosen as (select * from (select doc_id, k.t, i.word, row_number() over (partition by doc_id, k.t order by df, i.word) as r from k join (select distinct t, word from idx) i on k.t = i.t join df on df.word = i.word where list_contains(ws, i.word)) where r <= {licenses.LOOKED_UP}),
o as (select doc_id, unnest(ws) as word, unnest(range(len(ws))) as pos from (select distinct doc_id, ws from k)),
votes as (select doc_id, t, max(n) as n from (select c.doc_id, c.t, pos - spot as off, count(distinct c.word) as n from chosen c join o on o.doc_id = c.doc_id and o.word = c.word join idx on idx.t = c.t and idx.word = c.word group by all) group by all having max(n) >= {licenses.MIN_AGREEING}),
found as (select doc_id, list_distinct(list(label)) as labels, max(n / size) as score from votes join tpl using (t) group by doc_id),
p as (select * from (values {", ".join(f"('{phrase}', '{label}')" for phrase, label in licenses.PHRASES)}) v(phrase, label)),
places as (select doc_id, label, unnest(list_filter(range(len(ws)), lambda i: array_to_string(ws[i + 1 : i + len(string_split(phrase, ' '))], ' ') = phrase)) as spot from d join p on contains(s, ' ' || phrase || ' ')),
b as (select doc_id, count(*) as n_base, min(spot) as first_word, max(spot) as last_word, list_sort(list_distinct(list(label))) as labels from places group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(array_to_string(b.labels, ','), '') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(found.labels, [])))), ',') as labels, greatest(coalesce(score, 0), case when n_base > 0 then 0.5 else 0 end)::double as score
from d left join b on d.doc_id = b.doc_id left join found on d.doc_id = found.doc_id""",
    "op10_quality_rules": f"""
with t as (select doc_id, lang, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from documents),
g as (select doc_id, i, array_to_string(ws[i : i + 2], ' ') as gram from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from t where len(ws) > 2)),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, gram) as n from g) where n > 1),
r as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + 3)) as j from twice) group by doc_id),
c as (select t.doc_id, lang, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
  (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, len(ls) as n_lines, coalesce(r.n, 0)::bigint as n_repeat_words, len(regexp_extract_all(t, '\\p{{Lu}}')) as n_upper
  from t left join r on t.doc_id = r.doc_id),
m as (select *, n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words as base_failed,
  1000 * n_symbols // greatest(n_words, 1) as symbol_rate, 1000 * n_upper // greatest(word_chars, 1) as upper_rate, 1000 * n_dup_lines // greatest(n_lines, 1) as dup_line_rate,
  1000 * n_repeat_words // greatest(n_words, 1) as repeat_rate, 1000 * word_chars // greatest(n_words, 1) as word_length from c),
over as (select m.doc_id, min(k) as first from m join (values {", ".join(f"({k}, '{m}', {c})" for k, (m, c) in enumerate(rules.STEPS))}) s(k, rule, cutoff)
  on case rule {" ".join(f"when '{m}' then {m}" for m in rules.GRID)} end > cutoff group by m.doc_id),
hold as (select lang, first from m left join over on m.doc_id = over.doc_id where not base_failed and m.doc_id in (select doc_id from labels where quality = 1)),
x as (select lang, k, count(*) as n, count(*) filter (first <= k) as x from hold cross join range({len(rules.STEPS)}) s(k) group by all),
y as (select *, sum(n) over (partition by k) as n_all, sum(x) over (partition by k) as x_all, {rules.LEVEL} / ((select count(distinct coalesce(lang, '')) from hold) + 1) as bound from x),
p as (select *, {_cdf("x", "n")} as p_own, {_cdf("x_all", "n_all")} as p_all from y),
last as (select lang, coalesce(min(k) filter (not case when pow({1 - rules.RISK}, n) <= bound then p_own <= bound else p_all <= bound and x <= n * {rules.RISK} end), {len(rules.STEPS)}) - 1 as step from p group by lang)
select m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not coalesce(first <= step, false) as kept
from m left join over on m.doc_id = over.doc_id left join last on m.lang is not distinct from last.lang""",
    "op13_prefix_trie": f"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first) as p from conversations where conv_id is not null),
c as (select conv_id, list(sha256(octet_length(encode(role)) || ':' || role || text) order by p) as ks, list(octet_length(encode(text))::bigint order by p) as bs from t group by conv_id),
h as (select *, conv_id - conv_id % 5 as start, ({_CRC.replace("D", "conv_id::varchar")} % 9)::bigint as h from c),
b as (select h.conv_id, list_concat(coalesce(d.ks[1:h.h], []), h.ks[h.h + 1:]) as ks, list_concat(coalesce(d.bs[1:h.h], []), h.bs[h.h + 1:]) as bs from h left join c d on d.conv_id = h.start),
n as (select conv_id, d, sha256(array_to_string(ks[1:d], '')) as node, case when d > 0 then sha256(array_to_string(ks[1:d - 1], '')) end as up, bs[d] as bytes, len(ks) = d as ended from (select *, unnest(range(len(ks) + 1)) as d from b)),
g as (select node, d, up, min(conv_id) as conv_id, count(*) as n_convs, min(bytes) as bytes, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends from n group by node, d, up),
k as (select up as node, count(*) as n from g where up is not null group by up),
s as (select n.node, count(*) filter (k.n is null) as n_leaves, sum(case when g.d > 0 then (g.n_convs - 1) * g.bytes else 0 end)::bigint as saved from g left join k on g.node = k.node join n on n.conv_id = g.conv_id and n.d <= g.d group by n.node)
select g.conv_id, g.d as depth, o.conv_id as parent_conv_id, g.n_convs, coalesce(k.n, 0) as n_children, n_leaves, saved as saved_tokens, g.ends as ends_sha256
from g left join g o on g.up = o.node left join k on g.node = k.node join s on g.node = s.node""",
}
