"""The registered queries of the operators: thin, whole tables, all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tastes.llm.alignment import align_tokenizers
from tastes.llm.bpe import round_trip
from tastes.llm.common import remainder, table
from tastes.llm.decontaminate import contaminated
from tastes.llm.html_text import extract
from tastes.llm.language import fit_languages, identify
from tastes.llm.minhash import near_duplicates
from tastes.llm.order_minhash import fingerprint_edits
from tastes.llm.prefix_trie import prefix_trie
from tastes.llm.quality import STOP_WORDS, judge
from tastes.llm.substring import substring_dedup
from tastes.llm.toxicity import fit_lexicon, score_toxicity
from tastes.llm.url_filters import filter_urls, host_of
from tastes.llm.warc import archive_pages


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = fit_lexicon(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    return score_toxicity(docs, lexicon).select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "toxicity.*",
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.select(
        "page_id",
        "url",
        F.col("main_text").alias("text"),
        F.length("main_text").cast("long").alias("n_chars"),
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contaminated(docs, items)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "text", "removed", "n_removed")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_pages(table(spark, sf_dir, "pages"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select(
        "doc_id",
        (F.length("coded.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs, remainder("doc_id", 4) != 2)
    return identify(docs, model).select(
        "doc_id",
        F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "language.*",
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def captures(pages: DataFrame) -> DataFrame:
    """Captures from `pages`, which has no fetch time: a day of 2024 by the id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched"))


def list_events(pages: DataFrame) -> DataFrame:
    """Dated list entries of the hosts in `pages` and their domains, by a hash of the name."""

    def number(name: str):
        return F.conv(F.substring(F.md5(F.col(name).cast("binary")), 1, 6), 16, 10).cast("int")

    def event(chosen, list_name: str, verdict: str, action: str, day):
        made = F.struct(
            F.lit(list_name).alias("list_name"),
            F.lit(verdict).alias("verdict"),
            F.lit(action).alias("action"),
            F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).alias("effective"),
        )
        return F.when(chosen, made)

    hosts = pages.select(host_of(F.col("url")).alias("pattern")).where("pattern is not null").distinct()
    n = F.col("n")
    of_host = hosts.withColumn("n", number("pattern")).select(
        "pattern",
        F.explode(
            F.array(
                event(n % 4 == 0, "spam", "block", "add", n % 300),
                event(n % 4 == 0, "spam", "block", "remove", n % 300 + 20 + n % 90),
                event(n % 8 == 0, "spam", "block", "add", n % 300 + 150),
                event(n % 7 == 0, "trusted", "allow", "add", n % 200),
            )
        ).alias("e"),
    )
    domains = hosts.select(F.substring_index("pattern", ".", -2).alias("pattern")).distinct()
    of_domain = domains.withColumn("n", number("pattern")).select(
        "pattern",
        F.explode(
            F.array(
                event(n % 2 == 0, "adult", "block", "add", n % 250),
                event(n % 2 == 0, "adult", "block", "remove", n % 250 + 60),
            )
        ).alias("e"),
    )
    return of_host.union(of_domain).where("e is not null").select("pattern", "e.*")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(captures(pages), list_events(pages))


def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_html_extraction": op2_html_extraction,
        "op3_benchmark_decontamination": op3_benchmark_decontamination,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_minhash_near_dedup": op5_minhash_near_dedup,
        "op6_warc": op6_warc,
        "op7_byte_level_bpe": op7_byte_level_bpe,
        "op8_language_id": op8_language_id,
        "op9_quality_rules": op9_quality_rules,
        "op10_url_filters": op10_url_filters,
        "op11_order_minhash": op11_order_minhash,
        "op12_tokenizer_alignment": op12_tokenizer_alignment,
        "op13_prefix_trie": op13_prefix_trie,
        "pipeline": pipeline,
    }


_WORDS_SQL = r"""
with texts as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
words as (
  select r, doc_id, text, list_filter(
    string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from texts),
places as (
  select r, unnest(range(len(w))) + 1 as i, w from words),
windows as (
  select r, i, count(*) over (partition by r, w[i], w[i + 1], w[i + 2]) as n
  from places where i + 2 <= len(w)),
covered as (
  select r, count(distinct i + d) as n
  from windows, (values (0), (1), (2)) as x(d) where n > 1 group by r),
lines as (
  select r, unnest(string_split(text, chr(10))) as line from texts),
line_counts as (
  select r, count(*) as n, count(*) - count(distinct line) as dup
  from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
measured as (
  select doc_id, text, len(w)::bigint as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (length(text) - length(replace(text, '!', '')))::bigint as n_bangs,
    coalesce(l.n, 0)::bigint as n_lines, coalesce(l.dup, 0)::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words
  from words left join covered c using (r) left join line_counts l using (r)),
based as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured)
"""

_QUALITY_SQL = (
    _WORDS_SQL
    + r"""select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and n_symbols <= 0.3 * n_words and n_bangs <= 0.3 * n_words
  and word_chars >= 2 * n_words and word_chars <= 15 * n_words
  and n_dup_lines <= 0.5 * n_lines and n_repeat_words <= 0.5 * n_words
  and (n_words < 100 or regexp_matches(lower(text), '(^|[^\p{L}])("""
    + "|".join(STOP_WORDS)
    + r""")([^\p{L}]|$)')) as kept
from based"""
)

_WARC_SQL = """
with p as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes,
         sha1(coalesce(html, '')) as payload_digest from pages),
g as (
  select payload_digest, max(page_id) as original from p
  where payload_bytes >= 1000 group by payload_digest having count(*) > 1)
select p.page_id, payload_bytes, p.payload_digest,
  case when original is null or original is not distinct from p.page_id
       then 'response' else 'revisit' end as record_type,
  case when original is distinct from p.page_id then original end as refers_to
from p left join g on g.payload_digest = p.payload_digest and p.payload_bytes >= 1000
"""

_URL_SQL = r"""
with c as (
  select page_id, url, date '2024-01-01' + (page_id * 37 % 366)::int as fetched,
    nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '')
      as host from pages),
h as (
  select host as pattern, ('0x' || substr(md5(host), 1, 6))::int as n
  from (select distinct host from c where host is not null)),
d as (
  select pattern, ('0x' || substr(md5(pattern), 1, 6))::int as n from (
    select distinct array_to_string(string_split(pattern, '.')[-2:], '.') as pattern from h)),
spans as (
  select 'spam' as list_name, pattern, 'block' as verdict, n % 300 as a, n % 300 + 20 + n % 90 as b
  from h where n % 4 = 0 and not (n % 8 = 0 and 150 <= 20 + n % 90)
  union all
  select 'spam', pattern, 'block', n % 300 + 150, null from h where n % 8 = 0
  union all
  select 'trusted', pattern, 'allow', n % 200, null from h where n % 7 = 0
  union all
  select 'adult', pattern, 'block', n % 250, n % 250 + 60 from d where n % 2 = 0),
keys as (
  select host, fetched, array_to_string(l[i:], '.') as pattern from (
    select host, fetched, l, unnest(range(1, len(l) + 1)) as i from (
      select distinct host, fetched, string_split(host, '.') as l from c
      where host is not null and fetched is not null))),
best as (
  select k.host, k.fetched, arg_min(row(s.list_name, s.pattern, s.verdict, s.a),
    row(-length(s.pattern), s.verdict, s.list_name)) as e
  from keys k join spans s on k.pattern = s.pattern
    and date '2024-01-01' + s.a <= k.fetched
    and (s.b is null or k.fetched < date '2024-01-01' + s.b)
  group by k.host, k.fetched)
select c.page_id, c.url, c.fetched, c.host, coalesce(e[3], 'allow') as verdict,
  e[1] as list_name, e[2] as pattern, date '2024-01-01' + e[4] as listed
from c left join best on best.host = c.host and best.fetched = c.fetched
"""


# The checksum of the id's decimal digits, bit by bit; then the rebuilt turns, a
# node per distinct prefix, and the sums over its subtree through the members'
# turns (c) and through the nodes' smallest members (below).
_TRIE_SQL = r"""
with ids as (
  select conv_id, xor(list_reduce(list_prepend(4294967295::bigint,
      [ord(x)::bigint for x in string_split(conv_id::varchar, '')]),
    lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0::bigint for i in range(8)]),
      lambda b, z: xor(b >> 1, (b & 1) * 3988292384))), 4294967295::bigint) % 9 as h
  from (select distinct conv_id from conversations where conv_id is not null)),
own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first,
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as i
  from conversations where conv_id is not null),
turns as (
  select ids.conv_id, i, role, text from ids
  join own on own.conv_id = ids.conv_id - ids.conv_id % 5 and i <= h
  union all
  select ids.conv_id, i, role, text from ids join own using (conv_id) where i > h),
steps as (
  select conv_id, strlen(text)::bigint as size,
    row_number() over (partition by conv_id order by i)::bigint as depth,
    string_agg(md5(length(role) || ':' || role || text), '') over (partition by conv_id order by i) as path
  from turns),
paths as (
  select conv_id, depth, path, size from steps union all select conv_id, 0, '', 0 from ids),
ends as (
  select conv_id, max(depth) as depth, arg_max(path, depth) as path from paths group by conv_id),
nodes as (
  select path, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size
  from paths group by path, depth),
c as (select p.path, p.depth, sum(q.size) as tokens
  from paths p join paths q on p.conv_id = q.conv_id and q.depth >= p.depth group by p.path, p.depth),
below as (
  select p.path, p.depth, sum(n.size) as once,
    count(*) filter (n.depth = p.depth + 1) as n_children,
    count(*) filter (not exists (
      select 1 from nodes m where m.depth = n.depth + 1 and left(m.path, len(n.path)) = n.path)) as n_leaves
  from nodes n join paths p on p.conv_id = n.conv_id and p.depth <= n.depth
  group by p.path, p.depth),
closed as (
  select path, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends_sha256
  from ends group by path)
select n.conv_id, n.depth, o.conv_id as parent_conv_id, n.n_convs::bigint as n_convs,
  n_children::bigint as n_children, n_leaves::bigint as n_leaves,
  (tokens - once)::bigint as saved_tokens, coalesce(ends_sha256, sha256('')) as ends_sha256
from nodes n join c using (path, depth) join below using (path, depth)
left join nodes o on o.depth = n.depth - 1 and o.path = left(n.path, len(n.path) - 32)
left join closed e on e.path = n.path
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL expresses; the others have tests in tests/llm."""
    return {
        "op6_warc": _WARC_SQL,
        "op9_quality_rules": _QUALITY_SQL,
        "op10_url_filters": _URL_SQL,
        "op13_prefix_trie": _TRIE_SQL,
    }
